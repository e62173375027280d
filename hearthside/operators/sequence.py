"""Contiguous row numbers and fixed-size batches without a single-task window."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from hearthside import vocab
from hearthside.session import cut_lineage, settle


def contiguous_id(df: DataFrame, order_by: list, name: str = "id") -> DataFrame:
    """Number rows 1, 2, 3 … in the given order.

    ``order_by`` must be unique, so the range sort can split rows that share a
    leading value. The sorted rows are written to the shared folder first: the
    partition a row sits in then stays fixed while the partition sizes are added up.
    """
    spot = F.monotonically_increasing_id()
    ordered = cut_lineage(df.orderBy(*order_by).withColumn("_spot", spot))
    part, place = F.shiftright("_spot", 33), F.col("_spot").bitwiseAND((1 << 33) - 1)
    sizes = ordered.groupBy(part.alias("_part")).agg(F.count("*").alias("_size"))
    # one row per partition, so this window stays small whatever the table holds
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    starts = settle(sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_first")))
    return (
        ordered.withColumn("_part", part)
        .withColumn("_place", place)
        .join(starts, "_part")
        .select(
            (F.col("_first") + F.col("_place") + 1).alias(name),
            *[F.col(f"`{c}`") for c in df.columns if c != name],
        )
    )


def batches(df: DataFrame, order_by: list, size: int = vocab.REQUEST_BATCH) -> DataFrame:
    """Add ``batch`` (0-based) and ``position`` (0-based inside the batch)."""
    numbered = contiguous_id(df, order_by, "_row")
    zero_based = F.col("_row") - 1
    return (
        numbered.withColumn("batch", F.floor(zero_based / F.lit(float(size))))
        .withColumn("position", (zero_based % size).cast("int"))
        .drop("_row")
    )


def first_per_key(df: DataFrame, key: str, order: Column) -> DataFrame:
    """First row per non-blank key; rows with a blank or null key are all kept.

    An aggregate, not a window: map tasks already reduce a repeated key to one row,
    so a key with a third of the table is no hot spot. Blank keys skip the shuffle.
    """
    blank = F.coalesce(F.col(key).cast("string"), F.lit("")) == ""
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    firsts = df.where(~blank).groupBy(F.col(key).alias("_key")).agg(F.min_by(row, order).alias("_row"))
    return firsts.select("_row.*").unionByName(df.where(blank))
