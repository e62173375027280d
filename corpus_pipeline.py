"""From raw documents to packed training sequences, in stages.

Each stage reads what its predecessor kept and returns the columns of documents, the last one the pieces of sequences.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthside.llm import toxicity
from hearthside.llm.common import stored
from hearthside.llm.decontaminate import find_leaks
from hearthside.llm.exact_dedup import exact_groups
from hearthside.llm.minhash import near_groups
from hearthside.llm.packing import pack
from hearthside.llm.queries import tokenizer_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with a ``key`` of its own for every row: its doc_id, or a number above 2^62 for rows without an id and for all
    rows of an id that several rows share. So these rows come after all others, and of equal ones only one stays.

    Numbers belong to rows of a written table, so they are the same in every later read; without such rows nothing is
    written.
    """
    ids = docs.groupBy("doc_id").agg(F.count("*").alias("rows"))
    shared = ids.where("rows > 1 OR doc_id IS NULL")
    if shared.isEmpty():
        return docs.withColumn("key", F.col("doc_id").cast("long"))
    marked = docs.join(shared.withColumnRenamed("doc_id", "of"), F.col("doc_id").eqNullSafe(F.col("of")), "left")
    own = F.when(F.col("rows").isNull(), F.col("doc_id").cast("long")).otherwise(F.monotonically_increasing_id() + F.lit(1 << 62))
    return stored(marked.select(*docs.columns, own.alias("key")), "keyed")


def of_keys(rows: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    return rows.join(keys, "key", how).select(COLUMNS)


def by_key(rows: DataFrame) -> DataFrame:
    return rows.select(F.col("key").alias("doc_id"), "text")


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject; it learns from the labelled ones among them.

    Null and empty texts get the score of a text without terms. Rows without an id have no label and are scored like all
    others, rows that repeat an id each by their own text. No rows give no rows; other columns go.
    """
    labels = toxicity.learnable(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = toxicity.score(docs.select(COLUMNS), toxicity.fit(docs, labels))
    return scored.where("toxicity < 0.5").select(COLUMNS)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal up to white space the document with the smallest id; null and empty texts are equal.

    Rows without an id, and all rows of an id that several rows share, come after all others; of equal ones one stays.
    No rows give no rows; other columns go.
    """
    rows = keyed(docs)
    return of_keys(rows, exact_groups(by_key(rows)).where("kept").select(F.col("doc_id").alias("key")), "left_semi")


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near-duplicates (five-word shingles, similarity 0.8 or more), the smallest id.

    Null, empty and wordless texts are linked with nothing and stay. Rows without an id, and all rows of an id that
    several rows share, come after all others. No rows give no rows; other columns go.
    """
    rows = keyed(docs)
    groups = near_groups(by_key(rows), size=5, percent=80)
    return of_keys(rows, groups.where("kept").select(F.col("doc_id").alias("key")), "left_semi")


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item, whether or not they have an id of their own. Null and empty texts stay. No rows
    give no rows, no items all rows; other columns go."""
    rows = keyed(docs)
    leaks = find_leaks(by_key(rows), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return of_keys(rows, leaks.select(F.col("doc_id").alias("key")).distinct(), "left_anti")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, cut and placed into sequences of at most 2048 tokens; ``ids`` holds the piece's token ids.

    A null or empty text is its end token alone. Every row is packed, whatever its id. No rows give no rows.
    """
    return pack(docs, tokenizer_path())


STAGES = [
    ("toxicity", clean),
    ("exact dedup", exact),
    ("MinHash near-dedup", near),
    ("benchmark decontamination", decontaminated),
    ("packing", packed),
]

# learned scores, MinHash candidates and token ids have no SQL; tests/llm/test_pipeline.py checks every stage
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
