"""Near-duplicates of SimHash fingerprints by Golay-code fuzzy hashing.

A fingerprint has 64 bits; two of them are linked when at most three bits differ. Every 23-bit word lies within three bits
of exactly one word of the perfect Golay code, so the number of that codeword is a hash that forgives small changes. A
word's nearby codewords, those within four bits, are one or six; of two words that differ in at most one bit, the codeword
of one is among the nearby ones of the other.

Three differing bits leave one of four 16-bit segments as it is (pigeonhole). The other 48 bits make two halves, and one of
these holds at most one of the three. So the key (segment, its 16 bits, half, codeword of the half) of one fingerprint
equals one of the (segment, its 16 bits, half, nearby codeword) of the other, and no link is missed. Keys are dealt into
buckets, packed; a bucket compares the fingerprints of equal keys, contracts the links found and gives a star for each
component, never all pairs. Keys of very many fingerprints are cut into tiles that are dealt out once more.
"""

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthside.llm.common import _LOWER, LAST_ID, cuts, mixed, parts, row_id, slices, stored, text_bytes, unpacked, words
from hearthside.llm.components import components

DIFFER = 3
#: Pairs that are compared at a time, and pairs from which a key is cut into tiles.
_CHUNK, _HOT, _TILE = 1 << 18, 1 << 26, 1 << 13
KEYS = "bucket int, keys binary, prints binary"
MEET = "a long, b long, left binary, right binary"
LINKS = "a long, b long"

# fixed value: generator polynomial x^11 + x^9 + x^7 + x^6 + x^5 + x + 1 of the binary Golay code of length 23
GENERATOR = 0xAE3
LENGTH, CHECKS = 23, 11


def _rest(word: int) -> int:
    """The word as a polynomial modulo the generator."""
    for k in range(LENGTH - 1, CHECKS - 1, -1):
        if word >> k & 1:
            word ^= GENERATOR << (k - CHECKS)
    return word


def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Syndromes of the low 12 and the high 11 bits, and per syndrome the error patterns of at most four bits (the
    lightest first; -1: there is no further one)."""
    unit = [_rest(1 << k) for k in range(LENGTH)]

    def sums(first: int, bits: int) -> np.ndarray:
        out = np.zeros(1 << bits, np.int64)
        for k in range(bits):
            out[1 << k : 2 << k] = out[: 1 << k] ^ unit[first + k]
        return out

    errors = np.full((1 << CHECKS, 6), -1, np.int64)
    used = np.zeros(1 << CHECKS, np.int64)
    for weight in range(5):
        for places in combinations(range(LENGTH), weight):
            s = 0
            for k in places:
                s ^= unit[k]
            errors[s, used[s]] = sum(1 << k for k in places)
            used[s] += 1
    return sums(0, 12), sums(12, 11), errors


_LOW, _HIGH, _ERRORS = _tables()


def decode(word: np.ndarray) -> np.ndarray:
    """The number of the codeword within three bits of each 23-bit word."""
    return (word ^ _ERRORS[_LOW[word & 0xFFF] ^ _HIGH[word >> 12], 0]) >> CHECKS


def nearby(word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place in ``word`` and number of every codeword within four bits: one or six a word."""
    errors = _ERRORS[_LOW[word & 0xFFF] ^ _HIGH[word >> 12]]
    place, column = np.nonzero(errors >= 0)
    return place, (word[place] ^ errors[place, column]) >> CHECKS


def parted(prints: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Number, exact 16 bits and 23-bit word of the eight ways to look at a fingerprint."""
    for i in range(4):
        exact = (prints >> np.uint64(16 * i)) & np.uint64(0xFFFF)
        low = prints & np.uint64((1 << 16 * i) - 1)
        high = (prints >> np.uint64(16 * i)) >> np.uint64(16)
        rest = low | (high << np.uint64(16 * i))
        for half in range(2):
            yield 2 * i + half, exact.astype(np.int64), ((rest >> np.uint64(24 * half)) & np.uint64(0x7FFFFF)).astype(np.int64)


def keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys (28 bits and the way, then a bit: 0 own codeword, 1 nearby one) and the place of the fingerprint of each."""
    out, at = [], []
    for way, exact, word in parted(prints):
        base = (way << 28) | (exact << 12)
        place, code = nearby(word)
        out += [(base | decode(word)) << 1, ((base[place] | code) << 1) | 1]
        at += [np.arange(len(prints)), place]
    return np.concatenate(out).astype(np.uint32), np.concatenate(at)


def _joined_words(batch_text: pa.Array) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray, int]:
    """Lower-cased words with one space behind each, their starts and ends there, their rows, number of rows."""
    buf, offsets = text_bytes(batch_text)
    first, last, rows = words(buf, offsets)
    size = last - first + 1
    end = np.cumsum(size)
    start = end - size
    place = np.arange(int(end[-1]) if len(end) else 0) + np.repeat(first - start, size)
    data = _LOWER[np.append(buf, np.uint8(32))[place]] if len(place) else np.zeros(0, np.uint8)
    data[end - 1] = 32
    return data.tobytes(), start, end - 1, rows, len(offsets) - 1


def fingerprint(texts: pa.Array, size: int) -> np.ndarray:
    """64-bit fingerprint of each text: a bit is set where more than half of the shingles' XXH64 (seed 42) have it."""
    data, start, end, rows, n = _joined_words(texts)
    count = np.bincount(rows, minlength=n)
    at = np.concatenate([[0], np.cumsum(count)])
    whole = np.flatnonzero(rows[: max(0, len(rows) - size + 1)] == rows[size - 1 :]) if len(rows) >= size else np.zeros(0, np.int64)
    few = np.flatnonzero((count > 0) & (count < size))
    begin = np.concatenate([start[whole], start[at[few]]])
    stop = np.concatenate([end[whole + size - 1], end[at[few + 1] - 1]])
    owner = np.concatenate([rows[whole], few])
    view, one = memoryview(data), xxhash.xxh64_intdigest
    hashes = np.fromiter((one(view[a:b], 42) for a, b in zip(begin.tolist(), stop.tolist())), np.uint64, len(begin))
    votes, total = np.zeros((n, 64), np.int64), np.bincount(owner, minlength=n)
    for a in range(0, len(hashes), 1 << 15):
        mine, bits = owner[a : a + (1 << 15)], np.unpackbits(hashes[a : a + (1 << 15)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        edge = cuts(mine)
        # a row may have one run among the whole shingles and one among the short texts, never two in one sum
        np.add.at(votes, mine[edge[:-1]], np.add.reduceat(bits, edge[:-1], axis=0, dtype=np.int64))
    return np.packbits(2 * votes > total[:, None], axis=1, bitorder="little").view("<u8").reshape(-1)


class _Joined:
    """Components of the fingerprints of a task: the links found are contracted at once and never kept."""

    def __init__(self, prints: np.ndarray):
        self.values = np.unique(prints)
        self.label = np.arange(len(self.values))

    def compare(self, x: np.ndarray, y: np.ndarray) -> None:
        """Join the pairs of places (x, y) that differ in few bits."""
        open_ones = self.label[x] != self.label[y]
        x, y = x[open_ones], y[open_ones]
        near = np.bitwise_count(self.values[x] ^ self.values[y]) <= DIFFER
        x, y = x[near], y[near]
        while len(x):
            a, b = self.label[x], self.label[y]
            np.minimum.at(self.label, np.maximum(a, b), np.minimum(a, b))
            while (deeper := self.label[self.label]).tobytes() != self.label.tobytes():
                self.label = deeper
            differ = self.label[x] != self.label[y]
            x, y = x[differ], y[differ]

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """One for every fingerprint but the smallest of each component, to that one."""
        other = np.flatnonzero(self.label != np.arange(len(self.values)))
        return self.values[other].view(np.int64), self.values[self.label[other]].view(np.int64)


def _send(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = np.asarray(batch.column(0)).view(np.uint64)
        key, at = keys(prints)
        bucket = (mixed((key >> np.uint32(1)).astype(np.uint64)) % np.uint64(n)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        edge = cuts(bucket[order])
        rows = [order[a:b] for a, b in zip(edge[:-1], edge[1:])]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([int(bucket[r[0]]) for r in rows], pa.int32()),
                pa.array([key[r].tobytes() for r in rows], pa.binary()),
                pa.array([prints[at[r]].tobytes() for r in rows], pa.binary()),
            ],
            names=["bucket", "keys", "prints"],
        )


def _meet(group: pa.Table, hot: int, tile: int) -> pa.Table:
    """Links between fingerprints of equal keys of a bucket; the tiles of keys with more than ``hot`` pairs."""
    key, prints = unpacked(group["keys"].to_pylist(), np.uint32), unpacked(group["prints"].to_pylist(), np.uint64)
    order = np.argsort(key, kind="stable")
    key, prints = key[order], prints[order]
    edge = cuts(key >> np.uint32(1))
    own = np.add.reduceat((key & np.uint32(1)) == 0, edge[:-1], dtype=np.int64) if len(key) else np.zeros(0, np.int64)
    near = np.diff(edge) - own
    found, left, right = _Joined(prints), [], []
    at = np.searchsorted(found.values, prints)
    for g in np.flatnonzero(own * near > hot):
        a, b, c = int(edge[g]), int(edge[g] + own[g]), int(edge[g + 1])
        for i in range(a, b, tile):
            for j in range(b, c, 4 * tile):
                left.append(prints[i : min(b, i + tile)].tobytes())
                right.append(prints[j : min(c, j + 4 * tile)].tobytes())
    place = np.flatnonzero(key & np.uint32(1))
    each = np.repeat(np.where(own * near <= hot, own, 0), near)  # own codewords that each nearby one meets
    start = np.repeat(edge[:-1], near)
    sums = np.concatenate([[0], np.cumsum(each)])
    i = 0
    while i < len(place):
        j = max(i + 1, int(np.searchsorted(sums, sums[i] + _CHUNK, side="right")) - 1)
        n = each[i:j]
        nth = np.arange(sums[j] - sums[i]) - np.repeat(sums[i:j] - sums[i], n)
        found.compare(np.repeat(at[place[i:j]], n), at[np.repeat(start[i:j], n) + nth])
        i = j
    a, b = found.links()
    rest = np.zeros(len(left), np.int64)
    return pa.table(
        [
            pa.array(np.concatenate([a, rest])), pa.array(np.concatenate([b, rest])),
            pa.array([None] * len(a) + left, pa.binary()), pa.array([None] * len(a) + right, pa.binary()),
        ],
        names=["a", "b", "left", "right"],
    )


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for left, right in zip(batch.column(0), batch.column(1)):
            x, y = (np.frombuffer(v.as_py(), np.uint64) for v in (left, right))
            found = _Joined(np.concatenate([x, y]))
            x, y = np.searchsorted(found.values, x), np.searchsorted(found.values, y)
            step = max(1, _CHUNK // max(1, len(y)))
            for i in range(0, len(x), step):
                part = x[i : i + step]
                found.compare(np.repeat(part, len(y)), np.tile(y, len(part)))
            a, b = found.links()
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def links(prints: DataFrame, hot: int = _HOT, tile: int = _TILE) -> DataFrame:
    """(a, b) that join the distinct fingerprints (column fp) which chains of three differing bits or less connect.

    Enough of them, not all: a task sends one for every fingerprint but the smallest of each of its components.
    """
    spark = prints.sparkSession
    n = parts(spark)
    sent = prints.select("fp").mapInArrow(lambda b: _send(b, n), KEYS)
    met = stored(sent.groupBy("bucket").applyInArrow(lambda g: _meet(g, hot, tile), MEET), "fingerprint-links")
    tiles = met.where("left is not null").select("left", "right").repartition(n, F.xxhash64("left", "right"))
    rest = stored(tiles.mapInArrow(_tiles, LINKS), "tile-links")
    return met.where("left is null").select("a", "b").union(rest)


def fingerprints(docs: DataFrame, size: int = 3) -> DataFrame:
    """(id, block, fp) of every row of ``docs`` (doc_id, text); block: the part of the input that the row came from."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, size=2 << 20):
            prints = fingerprint(batch.column(1), size)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(prints.view(np.int64))], names=["id", "block", "fp"])

    rows = docs.select(row_id().alias("id"), F.col("text").cast("string").alias("text"), F.spark_partition_id().alias("block"))
    return rows.mapInArrow(run, "id long, block int, fp long")


def fuzzy_groups(docs: DataFrame, size: int = 3) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hexadecimal digits), component_id, kept.

    ``docs``: doc_id, text. A-Z are lower-cased, words are runs of anything but space and the bytes 9 to 13, shingles are
    ``size`` consecutive words joined by a space, repeats included; a text of fewer words is one shingle. Null, empty and
    wordless texts have the fingerprint zero and are linked like any other, with each other too. Rows whose fingerprints
    differ in at most three bits are linked; component_id is the smallest doc_id that links reach, and its row stays.
    Rows without an id come after all others: their group's id is null only if no row of the group has one (kept is
    true for all of them then). Rows that repeat a doc_id are rows of their own. An empty table gives no rows; other
    columns are not read.
    """
    rows = stored(fingerprints(docs, size), "fingerprints")
    classes = stored(rows.groupBy("fp").agg(F.min("id").alias("id")), "distinct-fingerprints")
    found = stored(components(links(classes)), "fingerprint-components")
    placed = classes.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    placed = stored(placed.select("fp", "component", "id"), "placed-fingerprints")
    lowest = placed.groupBy("component").agg(F.min("id").alias("least"))
    answer = placed.select("fp", "component").join(lowest, "component").select("fp", "least")
    # a fingerprint that a third of all rows share is one row of each block here
    spread = rows.select("block", "fp").distinct().join(answer, "fp")
    real = lambda c: F.when(F.col(c) != F.lit(LAST_ID), F.col(c))
    return rows.join(spread, ["block", "fp"]).select(
        real("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        real("least").alias("component_id"), (F.col("id") == F.col("least")).alias("kept"),
    )
