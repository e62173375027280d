"""Incremental ingest: event files replayed as a stream into the shared folder."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthside.plans.fixture import listings, read
from hearthside.plans.registry import query
from hearthside.session import shared_folder
from hearthside.streaming.ingest import ingest, ingest_with_state, read_version, stream_records
from hearthside.streaming.key_ledger import KeyLedger
from hearthside.streaming.market_state import MarketState

_SCHEMA = "event_id bigint, user_id bigint, event_type string, value double"
_ONCE = "SELECT event_id, user_id, event_type, value FROM events"


def _records(spark, sf_dir) -> DataFrame:
    return read(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")


def _run(spark, folder) -> None:
    ingest(
        stream_records(spark, f"{folder}/in", _SCHEMA, files_per_batch=4),
        key="event_id", order=["event_id"], out=f"{folder}/out", ledger=f"{folder}/ledger", checkpoint=f"{folder}/state",
    ).awaitTermination()


def _result(spark, folder) -> DataFrame:
    return spark.read.parquet(f"{folder}/out").select("event_id", "user_id", "event_type", "value")


@query("incremental_ingest", _ONCE, listings=False)
def incremental_ingest(spark, sf_dir):
    """Every record arrives twice, spread over several micro-batches, and is kept once."""
    folder = shared_folder(spark, "ingest")
    events = _records(spark, sf_dir)
    for _ in range(2):
        events.repartition(3).write.mode("append").json(f"{folder}/in")
    _run(spark, folder)
    return _result(spark, folder)


@query("resumed_ingest", _ONCE, listings=False)
def resumed_ingest(spark, sf_dir):
    """A second run continues where the first stopped and skips what it has seen."""
    folder = shared_folder(spark, "ingest")
    events = _records(spark, sf_dir)
    events.where("event_id % 3 = 0").write.mode("append").json(f"{folder}/in")
    _run(spark, folder)
    events.repartition(5).write.mode("append").json(f"{folder}/in")
    _run(spark, folder)
    return _result(spark, folder)


@query(
    "ingest_versions",
    "SELECT v AS version, event_id, user_id, event_type, value FROM events, (SELECT unnest([0, 1, 2]) AS v) WHERE event_id % 3 <= v",
    listings=False,
)
def ingest_versions(spark, sf_dir):
    """The output after each of three batches, read back by version once all are in."""
    folder = shared_folder(spark, "ingest")
    events = _records(spark, sf_dir)
    for part in range(3):
        # every batch repeats all earlier records
        events.where(f"event_id % 3 <= {part}").coalesce(1).write.mode("append").json(f"{folder}/in")
        _run(spark, folder)
    rows = [read_version(spark, f"{folder}/out", events.schema, v).withColumn("version", F.lit(v)) for v in range(3)]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


@query(
    "ledger_unseen",
    "SELECT count(*) AS events, count(*) FILTER (user_id % 10 > 3) AS unseen FROM events",
    listings=False,
)
def ledger_unseen(spark, sf_dir):
    """Users of four batches in the bucketed ledger; how many events are of other users."""
    ledger = KeyLedger(spark, shared_folder(spark, "ledger"), buckets=8, fan=3)
    events = _records(spark, sf_dir)
    for batch in range(4):
        ledger.add(events.where(f"user_id % 10 = {batch}"), "user_id", batch)
    left = ledger.unseen(events, "user_id")
    return left.agg(F.count("*").alias("unseen")).select(F.lit(events.count()).alias("events"), "unseen")


@query(
    "merged_statistics",
    """, v AS (SELECT unnest([2, 4]) AS version), l AS (SELECT * FROM v JOIN listings_fx ON order_no % 5 <= version),
    b AS (SELECT version, governorate, CAST(floor(price_numeric / 5000) AS BIGINT) AS bin, count(*) AS n FROM l GROUP BY ALL),
    c AS (SELECT *, sum(n) OVER (PARTITION BY version, governorate ORDER BY bin) AS upto, sum(n) OVER (PARTITION BY version, governorate) AS total FROM b)
    SELECT l.version, l.governorate, count(*) AS rows, count(price_numeric) AS n_price_numeric, round(CAST(sum(CAST(price_numeric AS DECIMAL(28, 4))) AS DOUBLE) / count(price_numeric), 4) AS mean_price_numeric,
      min(price_numeric) AS min_price_numeric, max(price_numeric) AS max_price_numeric,
      (SELECT min(bin) FROM c WHERE c.version = l.version AND c.governorate = l.governorate AND upto >= ceil(total / 2)) AS middle_price_numeric, count(DISTINCT city) AS distinct_city
    FROM l GROUP BY l.version, l.governorate""",
)
def merged_statistics(spark, sf_dir):
    """Statistics after the third and the fifth batch, from the states of the batches alone."""
    state = MarketState(spark, shared_folder(spark, "market"), "governorate", {"price_numeric": 5000.0}, ["city"], fan=2)
    rows = listings(spark, sf_dir).select("governorate", "city", "price_numeric", "order_no")
    for batch in range(5):
        state.add(rows.where(f"order_no % 5 = {batch}"), batch)
    wide = [state.statistics(v).withColumn("version", F.lit(v)) for v in (2, 4)]
    return wide[0].unionByName(wide[1]).withColumn("mean_price_numeric", F.round("mean_price_numeric", 4))


@query("stateful_ingest", _ONCE, listings=False)
def stateful_ingest(spark, sf_dir):
    folder = shared_folder(spark, "ingest")
    events = _records(spark, sf_dir)
    for _ in range(2):
        events.repartition(3).write.mode("append").json(f"{folder}/in")
    ingest_with_state(
        stream_records(spark, f"{folder}/in", _SCHEMA, files_per_batch=4), key="event_id", out=f"{folder}/out", checkpoint=f"{folder}/state"
    ).awaitTermination()
    return _result(spark, folder)
