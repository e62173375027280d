"""Readers and sinks: tables written to the shared folder and read back.

Every query writes what a source would hold, faults included, and its SQL gives the
rows that must come back from the given tables.
"""

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hearthside import schemas
from hearthside.operators import encode
from hearthside.plans.fixture import listings, read
from hearthside.plans.ingest_queries import _ONCE, _SCHEMA, _records, _result
from hearthside.plans.model_queries import _ENCODED
from hearthside.plans.registry import KEY, ORACLES, query
from hearthside.session import shared_folder
from hearthside.sources import readers, writers
from hearthside.streaming.ingest import ingest, stream_records


def _typed(ddl: str) -> StructType:
    return StructType.fromDDL(ddl)


def _lines(spark, sf_dir):
    """Events as JSON lines."""
    return _records(spark, sf_dir).select("event_id", F.to_json(F.struct("*")).alias("value"))


@query("records_tolerant", _ONCE, listings=False)
def records_tolerant(spark, sf_dir):
    """Blank, cut and foreign lines stand between the records."""
    path = shared_folder(spark, "lines")
    cut = F.substring("value", 1, 12)
    faults = F.array("value", F.lit(""), F.when(F.col("event_id") % 3 == 0, cut), F.when(F.col("event_id") % 5 == 0, F.lit("not json")))
    _lines(spark, sf_dir).select(F.explode(F.array_compact(faults)).alias("value")).write.text(path)
    return readers.read_records(spark, path, _typed(_SCHEMA))


@query("records_strict", _ONCE, listings=False)
def records_strict(spark, sf_dir):
    path = shared_folder(spark, "lines")
    _lines(spark, sf_dir).select("value").write.text(path)
    return readers.read_records_strict(spark, path, _typed(_SCHEMA))


@query("records_appended", "SELECT event_id, event_type, copies FROM events, (SELECT unnest([1, 2]) AS copies)", listings=False)
def records_appended(spark, sf_dir):
    """Two appends to one place; fields without a value are written too."""
    path = shared_folder(spark, "appended")
    for copy in (1, 2):
        writers.append_records(_records(spark, sf_dir).select("event_id", "event_type", F.lit(copy).alias("copies")), path)
    return spark.read.schema("event_id bigint, event_type string, copies int").json(path)


@query(
    "csv_round_trip",
    """SELECT row_key AS url, concat(title, chr(10), '"', city, '", ', description) AS description,
    CASE WHEN part_no % 7 <> 0 THEN price_numeric END AS price_numeric, CAST(size_no AS STRING) AS size_no FROM listings_fx""",
)
def csv_round_trip(spark, sf_dir):
    """Quotes, commas, line breaks and NaN survive; a column outside the canonical order comes last."""
    path = shared_folder(spark, "csv")
    text = F.concat("title", F.lit('\n"'), "city", F.lit('", '), "description")
    price = F.when(F.col("part_no") % 7 == 0, F.lit(float("nan"))).otherwise(F.col("price_numeric"))
    df = listings(spark, sf_dir).select(
        F.col("size_no").cast("string").alias("size_no"), F.col("row_key").alias("url"), text.alias("description"), price.alias("price_numeric")
    )
    writers.write_csv(df, path)
    schema = _typed(", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schemas.RAW.fields) + ", size_no string")
    return readers.read_csv(spark, path, schema).select("url", "description", "price_numeric", "size_no")


@query(
    "enriched_files",
    "SELECT 'json' AS kind, row_key AS url, finish_truth AS finish_type, CAST(NULL AS BOOLEAN) AS has_pool FROM listings_fx UNION ALL SELECT 'csv', row_key, finish_truth, NULL FROM listings_fx",
)
def enriched_files(spark, sf_dir):
    """Every feature column is there in both files, also those no row has."""
    folder = shared_folder(spark, "enriched")
    df = listings(spark, sf_dir).select(F.col("row_key").alias("url"), F.col("finish_truth").alias("finish_type"))
    writers.write_enriched(df, f"{folder}/json", f"{folder}/csv", "gzip")
    schema = writers.with_all_features(df).schema
    shown = ["url", "finish_type", "has_pool"]
    lines = readers.read_records_strict(spark, f"{folder}/json", schema).select(F.lit("json").alias("kind"), *shown)
    return lines.union(readers.read_csv(spark, f"{folder}/csv", schema).select(F.lit("csv").alias("kind"), *shown))


@query("processed_files", "SELECT row_key, city, price_numeric, bedrooms FROM listings_fx")
def processed_files(spark, sf_dir):
    path = shared_folder(spark, "processed")
    writers.write_processed(listings(spark, sf_dir).select("row_key", "city", "price_numeric", "bedrooms"), path, "csv")
    return readers.read_csv(spark, path, _typed("row_key string, city string, price_numeric double, bedrooms int"))


@query("json_round_trip", "SELECT row_key, title, furnished, latitude FROM listings_fx")
def json_round_trip(spark, sf_dir):
    path = shared_folder(spark, "json")
    writers.write_json(listings(spark, sf_dir).select("row_key", "title", "furnished", "latitude"), path)
    return readers.read_records_strict(spark, path, _typed("row_key string, title string, furnished string, latitude double"))


@query("ledger_round_trip", "SELECT DISTINCT url FROM pages", listings=False)
def ledger_round_trip(spark, sf_dir):
    """Appended twice, with blanks around and blank lines between; an absent ledger is empty."""
    folder = shared_folder(spark, "ledger")
    pages = read(spark, sf_dir, "pages")
    writers.append_ledger(pages, f"{folder}/seen")
    padded = pages.select(F.explode(F.array(F.concat(F.lit("  "), "url", F.lit(" ")), F.lit("   "), F.lit(""))).alias("url"))
    writers.append_ledger(padded, f"{folder}/seen")
    return readers.read_ledger(spark, f"{folder}/seen").union(readers.read_ledger(spark, f"{folder}/none"))


@query(
    "ingest_states",
    """SELECT event_type AS completed_tasks, CAST(NULL AS STRING) AS current_task, CAST(max(user_id) AS INT) AS current_task_page, CAST(count(*) AS INT) AS total_records
    FROM events GROUP BY event_type UNION ALL SELECT '[]', NULL, 0, 0""",
    listings=False,
)
def ingest_states(spark, sf_dir):
    """Saved states, and the default where none was saved."""
    folder = shared_folder(spark, "state")
    states = _records(spark, sf_dir).groupBy(F.col("event_type").alias("completed_tasks")).agg(
        F.max("user_id").cast("int").alias("current_task_page"), F.count("*").cast("int").alias("total_records")
    )
    writers.write_json(states, f"{folder}/saved")
    return readers.read_state(spark, f"{folder}/saved").union(readers.read_state(spark, f"{folder}/none"))


@query(
    "first_records",
    "SELECT row_key, price_numeric, description FROM listings_fx ORDER BY row_key, price_numeric, description LIMIT 250",
)
def first_records(spark, sf_dir):
    """The sample option of the enrichment run: its row count is the feature."""
    return readers.first_records(listings(spark, sf_dir).select(*KEY), KEY, 250)


@query(
    "seeded_table",
    "SELECT row_number() OVER (ORDER BY row_key, price_numeric, description) AS id, row_key, price_numeric, description FROM listings_fx",
)
def seeded_table(spark, sf_dir):
    """The second seed finds rows and leaves them."""
    path = shared_folder(spark, "seed")
    df = listings(spark, sf_dir).select(*KEY, "governorate", "city")
    for part in (df, df.where("city = 'none'")):
        writers.seed_search_table(spark, part, path, KEY)
    return readers.read_table(spark, path).select("id", *KEY)


@query("ingest_snapshots", _ONCE, listings=False)
def ingest_snapshots(spark, sf_dir):
    """A snapshot of all rows so far after every batch; the last one has them all."""
    folder = shared_folder(spark, "snapshots")
    _records(spark, sf_dir).repartition(6).write.json(f"{folder}/in")
    ingest(
        stream_records(spark, f"{folder}/in", _SCHEMA, files_per_batch=2),
        key="event_id", order=["event_id"], out=f"{folder}/out", ledger=f"{folder}/ledger", checkpoint=f"{folder}/state",
        snapshot=(1, lambda rows: rows.drop("batch").write.mode("overwrite").parquet(f"{folder}/snapshot")),
    ).awaitTermination()
    return _result(spark, folder).join(spark.read.parquet(f"{folder}/snapshot").select("event_id"), "event_id", "left_semi")


@query("target_encoded_reloaded")
def target_encoded_reloaded(spark, sf_dir):
    """Codes that were saved and loaded again."""
    path = shared_folder(spark, "encoding")
    df = encode.with_target(listings(spark, sf_dir)).select("row_key", "target", *_ENCODED)
    train, test = encode.split(df, "row_key")
    encode.fit_target_encoding(train, _ENCODED).save(path)
    coded = encode.TargetEncoding.load(spark, path).apply(test)
    return coded.select("row_key", *[F.round(c, 6).alias(c) for c in _ENCODED])


ORACLES["target_encoded_reloaded"] = ORACLES["target_encoded"]
