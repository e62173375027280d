"""The second extraction pass: pick rows with gaps, batch them, merge the replies."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from hearthside import vocab
from hearthside.functions.text import strip
from hearthside.functions.truth import any_missing, fill_missing
from hearthside.operators.sequence import batches
from hearthside.schemas import EXTRACTED


def rows_with_gaps(df: DataFrame, features: list[str] = vocab.GAP_FEATURES) -> DataFrame:
    return df.where(any_missing(df, features))


def not_yet_done(df: DataFrame, done: DataFrame, key: str) -> DataFrame:
    return df.join(done.select(key), key, "left_anti")


def request_texts(
    df: DataFrame, key: str, order_by: list, size: int = vocab.REQUEST_BATCH, chars: int | None = vocab.REQUEST_TEXT_CHARS
) -> DataFrame:
    """One row per batch: ``batch, keys, n, prompt``. A batch holds at most ``size`` rows.

    Of each text the first ``chars`` characters are sent, as the published prompt does; None sends whole texts.
    """
    numbered = batches(df, order_by, size)
    text = F.concat(
        F.coalesce(F.col("title"), F.lit("")), F.lit("\n"), F.coalesce(F.col("description"), F.lit(""))
    )
    body = strip(text) if chars is None else F.substring(strip(text), 1, chars)
    head, tail = vocab.REQUEST_BLOCK.split("{i}")
    block = F.concat(F.lit(head), (F.col("position") + 1).cast("string"), F.lit(tail), body)
    grouped = numbered.select("batch", "position", F.col(key).alias("key"), block.alias("block")).groupBy("batch")
    rows = grouped.agg(F.sort_array(F.collect_list(F.struct("position", "key", "block"))).alias("rows"))
    n = F.size("rows").cast("string")
    header = F.replace(F.lit(vocab.REQUEST_HEADER), F.lit("{n}"), n)
    return rows.select(
        "batch",
        F.col("rows.key").alias("keys"),
        F.size("rows").alias("n"),
        F.concat(header, F.array_join(F.col("rows.block"), "\n\n")).alias("prompt"),
    )


def parse_replies(replies: DataFrame, column: str = "reply") -> DataFrame:
    """Read the reply text as an array; a lone object is an array of one, anything else is null."""
    text = F.trim(F.col(column))
    whole = ArrayType(EXTRACTED)
    found = (
        F.when(text.startswith("["), F.from_json(text, whole, {"mode": "PERMISSIVE"}))
        .when(text.startswith("{"), F.array(F.from_json(text, EXTRACTED, {"mode": "PERMISSIVE"})))
    )
    return replies.withColumn("items", found)


def accepted(replies: DataFrame) -> DataFrame:
    """One row per listing of every batch whose reply has as many items as the batch has rows."""
    fits = F.size("items") == F.size("keys")
    pairs = F.posexplode(F.arrays_zip("keys", "items"))
    return (
        replies.where(F.col("items").isNotNull() & fits)
        .select("batch", pairs.alias("position", "pair"))
        .select("batch", "position", F.col("pair.keys").alias("key"), F.col("pair.items").alias("item"))
    )


def merge_replies(df: DataFrame, answers: DataFrame, key: str) -> DataFrame:
    """Fill gaps from accepted answers; existing values win."""
    renamed = answers.select(F.col("key").alias(key), "item")
    joined = df.join(renamed, key, "left")
    merged = {
        f.name: fill_missing(F.col(f.name), F.col(f"item.{f.name}"), f.dataType)
        for f in EXTRACTED.fields
        if f.name in df.columns
    }
    return joined.withColumns(merged).drop("item")
