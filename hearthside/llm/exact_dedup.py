"""Exact deduplication by a tree merge of sorted digest runs.

Every partition writes a sorted run of the digests of its texts, each with the smallest id and the number of its rows.
Runs are cut into slices of the digest space. In each round up to ``fan_in`` runs of a slice meet in one task, which
merges them as streams and keeps, per digest, the smallest id and the sum of the rows; the rounds end with one run per
slice. A text that half of all rows share is one entry of each run, so no round has a hot task. The result goes back
to (block, digest) pairs, which are as even as the blocks.
"""

import heapq
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthside.llm.common import LAST_ID, parts, row_id, stored

RUN = "slice int, node long, digest string, check long, keep long, size long"
SPACE = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    """Null counts as empty; every run of white space is one space."""
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), SPACE, " ")


def _entries(rows: pd.DataFrame) -> list[Iterator[tuple]]:
    """The group's runs, each a sorted stream."""
    streams = []
    for _, run in rows.groupby("node", sort=True):
        run = run.sort_values(["digest", "check"])
        streams.append(zip(run["digest"], run["check"], run["keep"], run["size"]))
    return streams


def merged(rows: pd.DataFrame, parent: int) -> pd.DataFrame:
    """Multiway merge of sorted runs; equal entries become one. An entry is a digest with its check value, so two texts
    whose digests are equal but whose checks differ stay apart."""
    out: list[list] = []
    for digest, check, keep, size in heapq.merge(*_entries(rows)):
        if out and out[-1][0] == digest and out[-1][1] == check:
            out[-1][2] = min(out[-1][2], keep)
            out[-1][3] += size
        else:
            out.append([digest, check, keep, size])
    found = pd.DataFrame(out, columns=["digest", "check", "keep", "size"])
    found.insert(0, "node", parent)
    found.insert(0, "slice", rows["slice"].iloc[0])
    return found


def tree_merge(runs: DataFrame, n_runs: int, fan_in: int = 8) -> DataFrame:
    """One run per slice from ``n_runs`` runs (column node: 0 … n_runs-1)."""
    while n_runs > 1:
        level = runs.withColumn("parent", F.floor(F.col("node") / fan_in).cast("long"))

        def step(key, rows: pd.DataFrame) -> pd.DataFrame:
            return merged(rows, int(key[1]))

        runs = stored(level.groupBy("slice", "parent").applyInPandas(step, RUN), "runs")
        n_runs = -(-n_runs // fan_in)
    return runs


def exact_groups(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", fan_in: int = 8) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after every white-space run became one space; null counts as empty. The smallest id
    of a group stays. Rows without an id come after all others (their keep_id is null only if the whole group has no
    id). Rows that repeat an id: all count in group_size, and each carries the same answer. An empty table gives no
    rows. Other columns are not read, whatever their names.
    """
    spark = docs.sparkSession
    n = parts(spark)
    text = normalised(F.col(text_column))
    digests = stored(
        docs.select(row_id(id_column).alias("id"), text.alias("t"))
        .select(
            "id",
            F.sha2(F.col("t").cast("binary"), 256).alias("digest"),
            F.xxhash64("t", F.octet_length("t")).alias("check"),
            F.spark_partition_id().cast("long").alias("block"),
        ),
        "digests",
    )
    slices = F.pmod(F.conv(F.substring("digest", 1, 8), 16, 10).cast("long"), F.lit(n)).cast("int")
    runs = digests.groupBy("block", "digest", "check").agg(F.min("id").alias("keep"), F.count("*").alias("size"))
    last = digests.agg(F.max("block")).first()[0]
    first = runs.select(slices.alias("slice"), F.col("block").alias("node"), "digest", "check", "keep", "size")
    top = tree_merge(first, 0 if last is None else last + 1, fan_in)
    answers = runs.select("block", "digest", "check").join(top.select("digest", "check", "keep", "size"), ["digest", "check"])
    real = F.when(F.col("id") != F.lit(LAST_ID), F.col("id"))
    keep = F.when(F.col("keep") != F.lit(LAST_ID), F.col("keep"))
    return digests.join(answers, ["block", "digest", "check"]).select(
        real.alias("doc_id"),
        keep.alias("keep_id"),
        F.col("size").alias("group_size"),
        (F.col("id") == F.col("keep")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )
