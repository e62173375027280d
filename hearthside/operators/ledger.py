"""What has been seen: set operations between a batch and the URL ledger."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthside.operators.sequence import first_per_key


def unseen(batch: DataFrame, seen: DataFrame, key: str = "url") -> DataFrame:
    """Rows of the batch that the ledger does not hold."""
    return batch.join(seen.select(key), key, "left_anti")


def already_seen(batch: DataFrame, seen: DataFrame, key: str = "url") -> DataFrame:
    return batch.join(seen.select(key), key, "left_semi")


def first_unseen(batch: DataFrame, seen: DataFrame, order, key: str = "url") -> DataFrame:
    """As :func:`unseen`, with repeats inside the batch reduced before the join."""
    return unseen(first_per_key(batch.where(F.col(key) != ""), key, order), seen, key)


def all_seen(*sources: DataFrame, key: str = "url") -> DataFrame:
    """Set union of ledgers and data files."""
    merged = sources[0].select(key)
    for other in sources[1:]:
        merged = merged.unionByName(other.select(key))
    return merged.where(F.col(key) != "").distinct()


def missing_from_ledger(data: DataFrame, ledger: DataFrame, key: str = "url") -> DataFrame:
    """One row: how many URLs of the data file the ledger lacks."""
    return (
        data.select(key).where(F.col(key) != "").subtract(ledger.select(key)).agg(F.count("*").alias("new_urls"))
    )
