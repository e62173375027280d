"""Sinks."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthside import vocab
from hearthside.operators.sequence import contiguous_id
from hearthside.schemas import EXTRACTED
from hearthside.session import cut_lineage
from hearthside.sources.readers import exists


def append_records(df: DataFrame, path: str) -> None:
    df.write.mode("append").option("ignoreNullFields", "false").json(path)


def ordered_columns(df: DataFrame) -> list[str]:
    """Canonical columns first, the others behind them in their own order."""
    extras = [c for c in df.columns if c not in vocab.RECORD_ORDER]
    return vocab.RECORD_ORDER + extras


def write_csv(df: DataFrame, path: str) -> None:
    """All canonical columns (null where absent), then the rest, with a header."""
    absent = {c: F.lit(None).cast("string") for c in vocab.RECORD_ORDER if c not in df.columns}
    full = df.withColumns(absent) if absent else df
    full.select(*[F.col(f"`{c}`") for c in ordered_columns(full)]).write.mode("overwrite").csv(
        path, header=True, escape='"', emptyValue=""
    )


def write_json(df: DataFrame, path: str, compression: str = "none") -> None:
    """One object per line. A single JSON array would need one writer for the whole table."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path, compression=compression)


def with_all_features(df: DataFrame) -> DataFrame:
    absent = {f.name: F.lit(None).cast(f.dataType) for f in EXTRACTED.fields if f.name not in df.columns}
    return df.withColumns(absent) if absent else df


def write_enriched(df: DataFrame, json_path: str, csv_path: str, compression: str = "none") -> None:
    """The JSON file names every feature in every record, most of them null: ``gzip`` makes a large table a tenth as long, and
    readers undo it by the files' names.

    The features are stored once, so what makes them does not run again for the second file.
    """
    full = with_all_features(cut_lineage(df))
    write_json(full, json_path, compression)
    full.write.mode("overwrite").csv(csv_path, header=True, escape='"', emptyValue="", compression=compression)


def write_processed(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer.csv(path, header=True, escape='"', emptyValue="")
    else:
        writer.format(fmt).save(path)


def append_ledger(df: DataFrame, path: str, key: str = "url") -> None:
    df.select(key).where(F.col(key) != "").write.mode("append").text(path)


def save_search_table(df: DataFrame, path: str, order_by: list[str]) -> None:
    """Replace the search table: contiguous ids, sorted so that file statistics prune.

    Row-group minima and maxima of the filter columns take the place of indexes; a
    search by governorate or price reads few files. Partitioning by a place name is
    avoided because one place may hold a third of the rows.
    """
    numbered = contiguous_id(df, order_by)
    clustered = numbered.repartitionByRange("governorate", "city", "price_numeric", "id").sortWithinPartitions(
        "governorate", "city", "price_numeric"
    )
    clustered.write.mode("overwrite").parquet(path)


def seed_search_table(spark: SparkSession, df: DataFrame, path: str, order_by: list[str]) -> bool:
    """Write the search table unless it already has rows; tells whether it wrote."""
    if exists(spark, path) and not spark.read.parquet(path).isEmpty():
        return False
    save_search_table(df, path, order_by)
    return True
