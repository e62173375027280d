"""Helpers that the corpus operators share: stored tables, Arrow text as numpy bytes, word hashes, packed rows."""

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthside.session import shared_folder

# fixed values: odd multipliers of the 64-bit hashes; every task of a job must use the same ones
MIX = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93))

#: The place of rows without an id: after all others.
LAST_ID = 2**63 - 1

#: Within ``stored``: a finished job's shuffle files go at once, since its rows are in a written table by then, and a scan that
#: is joined with a small part of its keys passes a Bloom filter of these before the shuffle, whatever its size.
_WRITING = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0",
}


@contextmanager
def _settings(spark: SparkSession, wanted: dict[str, str]):
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def stored(df: DataFrame, purpose: str = "corpus") -> DataFrame:
    """Write ``df`` to the shared folder (``spark.checkpoint.dir``) and go on from the written table.

    This cuts the lineage: an executor that is lost later takes no finished work with it.
    """
    spark = df.sparkSession
    path = shared_folder(spark, purpose)
    with _settings(spark, _WRITING):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def parts(spark: SparkSession) -> int:
    """Number of buckets that the operators deal rows into; it follows ``spark.sql.shuffle.partitions``."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def row_id(column: str = "doc_id") -> Column:
    return F.coalesce(F.col(column).cast("long"), F.lit(LAST_ID))


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column end to end, and the offsets of its rows (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def slices(batches: Iterator[pa.RecordBatch], column: int = 1, size: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut into slices of about ``size`` bytes of text (a longer text is a slice of its own), without a copy.

    Arrays per byte or word of a slice then stay small, whatever the number of rows in a batch.
    """
    for batch in batches:
        _, offsets = text_bytes(batch.column(column))
        a = 0
        while a < batch.num_rows:
            b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + size, side="right")) - 1)
            yield batch.slice(a, b - a)
            a = b


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers."""
    x = x ^ (x >> np.uint64(30))
    x *= MIX[1]
    x ^= x >> np.uint64(27)
    x *= MIX[2]
    return x ^ (x >> np.uint64(31))


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def words(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every word ``[^\\x20\\x09-\\x0D]+``; rows never run into each other."""
    return _stretches(~_SPACE[buf], offsets)


def _stretches(mine: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = len(mine)
    edge = np.zeros(n + 2, bool)
    edge[1 : n + 1] = mine
    row_start, row_end = np.zeros(n + 1, bool), np.zeros(n + 1, bool)
    row_start[offsets[:-1]] = True
    row_end[offsets[1:]] = True
    first = np.flatnonzero(edge[1 : n + 1] & (~edge[:n] | row_start[:n]))
    last = np.flatnonzero(edge[1 : n + 1] & (~edge[2:] | row_end[1 : n + 1])) + 1
    return first, last, np.searchsorted(offsets, first, side="right") - 1


_PART = np.ones(256, bool)
_PART[[c for c in range(128) if not chr(c).isalnum()]] = False


def tokens(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of the runs of letters, digits and bytes above 127."""
    return _stretches(_PART[buf], offsets)


_PIECE = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
_LONG = 1024


def word_names(buf: np.ndarray, first: np.ndarray, last: np.ndarray, lower: bool = False, family: int = 0) -> np.ndarray:
    """A 64-bit name of each word's bytes, scrambled after every eight bytes; words of one size up to eight never share one.

    Names of another ``family`` are independent: two words that share a name of each are equal but for one chance in 2^128.
    """
    size = last - first
    data = np.concatenate([_LOWER[buf] if lower else buf, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(data) - 7,), "<u8", data, 0, (1,))
    out = mixed((size.astype(np.uint64) + MIX[family]) * MIX[3 - family])
    mine, at = np.flatnonzero((size > 0) & (size <= _LONG)), 0
    while len(mine):
        piece = eight[first[mine] + at] & _PIECE[np.minimum(size[mine] - at, 8)]
        out[mine] = mixed(out[mine] ^ piece)
        at += 8
        mine = mine[size[mine] > at]
    for i in np.flatnonzero(size > _LONG).tolist():
        out[i] = xxhash.xxh64_intdigest(data[first[i] : last[i]].tobytes(), int(out[i]))
    return out


def cuts(keys: np.ndarray) -> np.ndarray:
    """Where runs of equal values of a sorted array begin, and its length."""
    if not len(keys):
        return np.zeros(1, np.int64)
    return np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]])


def unpacked(column, kind) -> np.ndarray:
    """The numbers of a binary column's rows, end to end."""
    return np.frombuffer(b"".join(column), kind)
