"""Incremental acquisition with Structured Streaming.

Each micro-batch is written to its own ``batch=N`` folder with overwrite. A batch that
is replayed after a crash replaces what its first try left behind, so no record is
lost or doubled. The checkpoint remembers which input files are done.
"""

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from hearthside.operators.sequence import first_per_key
from hearthside.sources.files import Manifests
from hearthside.streaming.key_ledger import KeyLedger


def stream_records(spark: SparkSession, path: str, schema: StructType, files_per_batch: int = 100) -> DataFrame:
    return (
        spark.readStream.schema(schema)
        .option("mode", "DROPMALFORMED")
        .option("maxFilesPerTrigger", files_per_batch)
        .json(path)
    )


def _add_batch(rows: DataFrame, batch: int, *, key: str, order: list[str], out: str, ledger: str, snapshot) -> None:
    spark = rows.sparkSession
    ordering = F.struct(*order) if len(order) > 1 else F.col(order[0])
    seen, log = KeyLedger(spark, ledger), snapshot_log(spark, out)
    # repeats inside the batch are reduced before the comparison, so a hot key is one row by then
    fresh = first_per_key(rows.where(F.coalesce(F.col(key).cast("string"), F.lit("")) != ""), key, ordering)
    # a batch that is repeated must not see what its first try added
    seen.unseen(fresh, key, batch).write.mode("overwrite").parquet(f"{out}/batch={batch}")
    seen.add(spark.read.schema(rows.schema).parquet(f"{out}/batch={batch}"), key, batch)
    log.write(batch, [*log.read(log.latest(batch)), {"folder": f"batch={batch}"}])
    if snapshot is not None:
        every, write = snapshot
        if (batch + 1) % every == 0:
            write(spark.read.parquet(out))


def snapshot_log(spark: SparkSession, out: str) -> Manifests:
    """The versions of an ingest's output: version N lists the batch folders after batch N. Readers skip its folder."""
    return Manifests(spark, f"{out}/_versions")


def read_version(spark: SparkSession, out: str, schema: StructType, version: int | None = None) -> DataFrame:
    """The output as it was after a batch (default: the last one). A version is a list of folders; no row is written twice."""
    log = snapshot_log(spark, out)
    folders = [e["folder"] for e in log.read(log.latest() if version is None else version)]
    return spark.read.schema(schema).parquet(*[f"{out}/{f}" for f in folders]) if folders else spark.createDataFrame([], schema)


def ingest(
    records: DataFrame,
    *,
    key: str,
    order: list[str],
    out: str,
    ledger: str,
    checkpoint: str,
    snapshot=None,
) -> StreamingQuery:
    """Append records whose key was never seen, then stop when the input is used up.

    ``order`` decides which of several equal keys in one batch is kept. Every batch is a version that ``read_version``
    reads. ``snapshot`` is ``(every, write)``: after every so many batches ``write`` gets all rows so far. Starting again
    with the same folders continues where it stopped.
    """
    step = partial(_add_batch, key=key, order=order, out=out, ledger=ledger, snapshot=snapshot)
    return (
        records.writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def ingest_with_state(records: DataFrame, *, key: str, out: str, checkpoint: str) -> StreamingQuery:
    """The same result from Spark's own keyed state, for key sets that fit the state store."""
    return (
        records.where(F.col(key).isNotNull())
        .dropDuplicates([key])
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
