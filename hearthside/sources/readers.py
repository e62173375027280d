"""Scans. Every reader takes a declared schema."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hearthside import schemas
from hearthside.functions.truth import without_nan
from hearthside.sources.files import exists


def spread(df: DataFrame) -> DataFrame:
    """Deal a plain file scan out to all cores when its splits do not keep them busy.

    A row group is read by one split, so a table with few row groups leaves most splits empty however many there are. What
    the splits hold is counted, which reads no column. A table whose fullest split has at most twice its share of a core is
    returned unchanged.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < cores:
        return df.repartition(cores)
    held = df.groupBy(F.spark_partition_id().alias("split")).agg(F.count("*").alias("n"))
    fullest, rows = held.agg(F.max("n"), F.sum("n")).first()
    return df if not rows or fullest * cores <= 2 * rows else df.repartition(cores)


def read_csv(spark: SparkSession, path: str, schema: StructType = schemas.PROCESSED) -> DataFrame:
    """Header, quoted line breaks, NaN as null."""
    options = {"header": True, "multiLine": True, "escape": '"', "enforceSchema": False, "nanValue": "nan"}
    return without_nan(spark.read.schema(schema).options(**options).csv(path))


def read_records(spark: SparkSession, path: str, schema: StructType = schemas.RAW) -> DataFrame:
    """JSON lines; blank and malformed lines are skipped. No file means no rows."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(path, mode="DROPMALFORMED", multiLine=False)


def read_records_strict(spark: SparkSession, path: str, schema: StructType = schemas.RAW) -> DataFrame:
    """JSON lines; a malformed line fails the job."""
    return spark.read.schema(schema).json(path, mode="FAILFAST")


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """Distinct trimmed lines as ``url``. No file means an empty ledger."""
    if not exists(spark, path):
        return spark.createDataFrame([], "url string")
    return spark.read.text(path).select(F.trim("value").alias("url")).where("url != ''").distinct()


def read_state(spark: SparkSession, path: str) -> DataFrame:
    """Ingest state, or the empty state when there is none."""
    if exists(spark, path):
        return spark.read.schema(schemas.INGEST_STATE).json(path)
    return spark.createDataFrame([("[]", None, 0, 0)], schemas.INGEST_STATE)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("page_id bigint, url string, html string").parquet(path)


def read_table(spark: SparkSession, name_or_path: str) -> DataFrame:
    """A saved table by name, or Parquet files by path."""
    if "/" in name_or_path:
        return spark.read.parquet(name_or_path)
    return spark.table(name_or_path)


def first_records(df: DataFrame, key: list[str], n: int) -> DataFrame:
    """The first ``n`` rows in key order (a distributed top-n); 0 keeps everything."""
    return df.orderBy(*key).limit(n) if n > 0 else df
