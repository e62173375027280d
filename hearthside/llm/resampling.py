"""Importance resampling towards a target distribution.

Features are runs of one to three words, hashed (CRC-32) into buckets. Tasks count buckets into arrays; Spark adds them up.
A bucket's gain is the log ratio of its smoothed shares in the target and in the source, a document's weight the sum over
its features, looked up in the array of gains. The CRC-32 of a run of words is composed from those of its words: appending
bytes is a linear map of 32 bits, kept as tables for 1, 2, 4, 8 … bytes.

Weights get seeded Gumbel noise, so the highest scores are a sample without replacement by weight. The k-th highest is
found by a distributed quickselect: random pivot keys, an exact count of the rows below, at and between them, and the next
round on the rows between the two pivots that enclose it. Only the winners are sorted and ranked.
"""

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthside.llm.common import _LOWER, LAST_ID, row_id, slices, stored, text_bytes, tokens
from hearthside.operators.sequence import contiguous_id

BUCKETS, RUN = 10_000, 3
PIVOTS = 24

# fixed value: the reversed polynomial of CRC-32
POLYNOMIAL = 0xEDB88320
_SHORT = 64
_BLANK = np.uint32(zlib.crc32(b" "))


def _appended(code: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The linear map ``table`` (4 x 256: by byte of the code) of each code."""
    out = table[0][code & np.uint32(255)]
    for k in range(1, 4):
        out = out ^ table[k][(code >> np.uint32(8 * k)) & np.uint32(255)]
    return out


def _maps() -> list[np.ndarray]:
    """Maps of a code when 1, 2, 4, … 2^31 zero bytes are appended."""
    one = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        one = np.where(one & np.uint32(1), (one >> np.uint32(1)) ^ np.uint32(POLYNOMIAL), one >> np.uint32(1))
    byte = np.arange(256, dtype=np.uint32)
    # a code without its low byte moves down by one byte
    maps = [np.stack([one, byte, byte << np.uint32(8), byte << np.uint32(16)])]
    while len(maps) < 32:
        maps.append(_appended(maps[-1], maps[-1]))
    return maps


_MAPS = _maps()


def word_codes(buf: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """CRC-32 of each word's bytes."""
    size = last - first
    out = np.zeros(len(first), np.uint32)
    order = np.argsort(-np.minimum(size, _SHORT + 1), kind="stable")
    ends = np.searchsorted(-np.minimum(size, _SHORT + 1)[order], -np.arange(_SHORT + 1), side="left")
    long = int(np.count_nonzero(size > _SHORT))
    code = np.full(len(first), 0xFFFFFFFF, np.uint32)
    for k in range(_SHORT):
        mine = order[long : ends[k]]  # words with more than k bytes
        if not len(mine):
            break
        now = code[mine] ^ buf[first[mine] + k]
        code[mine] = _MAPS[0][0][now & np.uint32(255)] ^ (now >> np.uint32(8))
    out[:] = ~code
    for i in order[:long].tolist():
        out[i] = zlib.crc32(buf[first[i] : last[i]])
    return out


def joined(code: np.ndarray, next_code: np.ndarray, next_size: np.ndarray) -> np.ndarray:
    """CRC-32 of a string, a space and a next string, from both codes and the next one's size."""
    code = _appended(code, _MAPS[0]) ^ _BLANK
    for k in range(32):
        if not (next_size >> k).any():
            break
        code = np.where((next_size >> k) & 1, _appended(code, _MAPS[k]), code)
    return code ^ next_code


def features(texts: pa.Array, longest: int = RUN) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Number of words of each text, and for runs of 1, 2, … words the code and the text of each run."""
    buf, offsets = text_bytes(texts)
    buf = _LOWER[buf]
    first, last, rows = tokens(buf, offsets)
    size, code = last - first, word_codes(buf, first, last)
    runs, out = code, [(code, rows)]
    for k in range(1, longest):
        n = max(0, len(code) - k)
        runs = joined(runs[:n], code[k:], size[k:])
        whole = rows[:n] == rows[k:]
        out.append((runs[whole], rows[:n][whole]))
    return np.bincount(rows, minlength=len(offsets) - 1), out


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, longest: int = RUN) -> np.ndarray:
    """How often each bucket occurs in the column ``text``; tasks send one array each, Spark adds them up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in slices(batches, 0, 2 << 20):
            for code, _ in features(batch.column(0), longest)[1]:
                total += np.bincount(code % np.uint32(buckets), minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    rows = texts.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for row in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # one row per bucket at most
        out[row["bucket"]] = row["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log of each bucket's smoothed share in the target over that in the source."""
    n, s, t = len(source), source.astype(float), target.astype(float)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + n) / ((s + 1) * (t.sum() + n)))).astype(np.int64)


def weighted(docs: DataFrame, gain: np.ndarray, longest: int = RUN) -> DataFrame:
    """id, n_words, n_features and weight of every row of ``docs`` (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, size=2 << 20):
            n_words, runs = features(batch.column(1), longest)
            n, weight = np.zeros(len(n_words), np.int64), np.zeros(len(n_words), np.int64)
            for code, rows in runs:
                n += np.bincount(rows, minlength=len(n))
                # whole numbers below 2^53: the sums are exact
                weight += np.bincount(rows, gain[code % np.uint32(len(gain))], len(n)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words), pa.array(n), pa.array(weight)], names=["id", "n_words", "n_features", "weight"]
            )

    rows = docs.select(row_id().alias("id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "id long, n_words long, n_features long, weight long")


def noise(seed: int) -> Column:
    """Thousandths of Gumbel noise from the id and the seed; a row without an id hashes ``seed:``."""
    text = F.concat(F.lit(f"{seed}:"), F.when(F.col("id") != F.lit(LAST_ID), F.col("id").cast("string")).otherwise(""))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def _above(key: list[str], than: tuple) -> str:
    """key > than, column by column, as SQL."""
    out = "false"
    for column, value in reversed(list(zip(key, than))):
        out = f"({column} > {value} OR ({column} = {value} AND {out}))"
    return out


def _equal(key: list[str], to: tuple) -> str:
    return "(" + " AND ".join(f"{column} = {value}" for column, value in zip(key, to)) + ")"


def kth_key(rows: DataFrame, key: list[str], k: int, seed: int = 0, pivots: int = PIVOTS) -> tuple | None:
    """The k-th smallest (1-based) key of ``rows`` by the columns ``key``, which are long and together unique.

    Quickselect: each round draws ``pivots`` random keys, counts the rows below, at and between them, and goes on with
    the written rows between the two that enclose the k-th. No round sorts the rows or sends more than the pivots and their
    counts. None if there are fewer than k rows or k is 0.
    """
    pool, left, turn = rows.select(*key), k, 0
    while left > 0:
        # the rows with the smallest hashes of key and round: random, and the same when a task runs again
        drawn = pool.orderBy(F.xxhash64(*key, F.lit(seed), F.lit(turn)), *key).limit(pivots).collect()
        bounds = sorted(map(tuple, drawn))
        if not bounds:
            return None
        place = " + ".join(f"CASE WHEN {_above(key, b)} THEN 2 WHEN {_equal(key, b)} THEN 1 ELSE 0 END" for b in bounds)
        counts = {r["place"]: r["count"] for r in pool.groupBy(F.expr(place).alias("place")).count().collect()}
        for at in range(2 * len(bounds) + 1):
            if left <= counts.get(at, 0):
                break
            left -= counts.get(at, 0)
        else:
            return None
        if at % 2:
            return bounds[at // 2]
        low, high = (bounds[at // 2 - 1] if at else None), (bounds[at // 2] if at < 2 * len(bounds) else None)
        if low:
            pool = pool.where(f"{key[0]} >= {low[0]} AND {_above(key, low)}")
        if high:
            pool = pool.where(f"{key[0]} <= {high[0]} AND NOT {_above(key, high)} AND NOT {_equal(key, high)}")
        pool, turn = stored(pool, "pool"), turn + 1
    return None


def resample(docs: DataFrame, target: DataFrame, percent: int = 5, least_words: int = 20, seed: int = 42) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_features, weight, score, rank.

    ``docs``: doc_id, text; ``target``: text. A-Z are lower-cased, words are runs of letters, digits and characters above
    127; null and empty texts have none, weight 0 and their noise as score. Of the rows with at least ``least_words``
    words, ``percent`` of a hundred (rounded down) with the highest scores are drawn and ranked 1, 2, 3 …; ties go to the
    smaller doc_id, rows without an id come last, and rows that repeat a doc_id and a score go in the order read. Other
    rows have no rank. An empty target leaves the counts of the source to decide; an empty table gives no rows. Other
    columns are not read.
    """
    gain = gains(bucket_counts(docs), bucket_counts(target))
    scored = weighted(docs, gain).withColumns({"score": F.col("weight") + noise(seed), "row": F.monotonically_increasing_id()})
    scored = stored(scored.withColumn("lack", -F.col("score")), "scores")
    able = F.col("n_words") >= least_words
    key = ["lack", "id", "row"]
    last = kth_key(scored.where(able), key, scored.where(able).count() * percent // 100, seed)
    columns = [F.when(F.col("id") != F.lit(LAST_ID), F.col("id")).alias("doc_id"), "n_words", "n_features", "weight", "score"]
    if last is None:
        return scored.select(*columns, F.lit(None).cast("long").alias("rank"))
    wins = able & ~F.expr(_above(key, last))
    ranked = contiguous_id(scored.where(wins), key, "rank")
    return ranked.select(*columns, "rank").union(scored.where(~wins).select(*columns, F.lit(None).cast("long").alias("rank")))
