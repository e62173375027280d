"""Session settings the library expects, and the shared folder for lineage cuts."""

import os
import tempfile
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

_settled: list[DataFrame] = []
_LARGE = 64 << 20  # bytes of a written table from which on its shuffle files are worth a collection


def build_session(app: str = "hearthside", master: str | None = None, **conf) -> SparkSession:
    """A session with adaptive execution, skew handling and UTC time.

    Partition counts are left to the cluster; ``conf`` overrides any setting.
    """
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        # a very deep page of a sorted result becomes a distributed sort, not a driver heap
        "spark.sql.execution.topKSortFallbackThreshold": "200000",
        # above this bytecode size the JVM never compiles a method; smaller ones are worth a split
        "spark.sql.codegen.hugeMethodLimit": "8000",
        # pages can be large: Arrow batches for Python are bounded by rows as well as bytes
        "spark.sql.execution.arrow.maxRecordsPerBatch": "500",
        # keyed streaming state grows with the keys ever seen, so it belongs on disk
        "spark.sql.streaming.stateStore.providerClass": (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        ),
        "spark.ui.showConsoleProgress": "false",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def compiled_methods(spark: SparkSession) -> None:
    """Keep the generated code of wide rows within what the JVM compiles, in a session that ``build_session`` did not make.

    Spark's own limit lets through methods that then run interpreted for every row. It is a run-time setting of the session.
    """
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder named in ``spark.checkpoint.dir``; pick one only in local mode."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        sc.setCheckpointDir(named)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(os.path.join(tempfile.mkdtemp(prefix="hearthside-"), "checkpoints"))
    else:
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder name inside the shared checkpoint folder."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{purpose}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and go on from the written table.

    A lost executor can then no longer change rows or row numbers, and later passes
    read only the columns they need. The shuffle files behind a large table are freed.
    """
    path = shared_folder(df.sparkSession, "table")
    df.write.parquet(path)
    free_shuffles(df.sparkSession, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_shuffles(spark: SparkSession, path: str) -> None:
    """Let Spark delete the shuffle files that a large table written to ``path`` has needed.

    Spark deletes them once the driver's garbage collection finds the write's plan unused, which may otherwise be hours later.
    """
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if files.getContentSummary(folder).getLength() >= _LARGE:
        jvm.System.gc()


def settle(df: DataFrame) -> DataFrame:
    """Compute a small, deterministic summary once and let Catalyst see its real size.

    After the count the join planner knows the exact number of bytes: it
    broadcasts the summary only below ``spark.sql.autoBroadcastJoinThreshold`` and
    falls back to a (skew-split) shuffle join above it. The summary is
    deterministic, so blocks lost with an executor are rebuilt with equal values.
    """
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    kept.count()
    _settled.append(kept)
    return kept


def release() -> int:
    """Free the summaries kept so far, once the results that use them are written."""
    freed = len(_settled)
    while _settled:
        _settled.pop().unpersist()
    return freed
