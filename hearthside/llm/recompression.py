"""Removal of repeated word windows by recompression.

Words get names (64-bit hashes of their bytes, so names agree everywhere without a dictionary). Levels then shorten the
sequence of names: runs of one name become one symbol, and neighbours whose sides are left and right become a pair
symbol. The rule looks only at the symbols themselves and their neighbours, so equal word sequences are parsed equally
inside and get the same interior symbols wherever they occur. A symbol's name is a hash of its parts' names, so it is a
global name as well. Each symbol knows the words its making depended on; a window can use it when these lie inside. A
window's label is the least of its usable symbols (in scrambled order) of the highest level that has one, or its own name
if no level has (a window inside one long run, say), so that neighbouring windows mostly share a label.

A first Spark round finds the labels that several documents share. In a second one the blocks name every window with a
shared label by its whole word sequence, by two independent names of 64 and 32 bits, and the smallest doc_id of each pair of names is
found: that verifies the repeats that shared symbols reveal.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthside.llm.common import LAST_ID, MIX, cuts, mixed, slices, stored, text_bytes, unpacked, word_names, words
from hearthside.llm.exchange import (
    REPLY, SENT, among, blocked, blocks_for, bucket_of, found_pairs, lowest, of_kind, replies, sent, shared_names,
)

NAMED = "bucket int, block int, names binary, checks binary, low binary"
RESULT = "doc_id long, n_words long, spans array<struct<start:long,length:long>>, kept binary"
#: Levels of symbols. One of the third level depends on some twenty words and would hardly ever fit a window of 13.
LEVELS = 2
#: Bytes of text that are parsed at a time; arrays per word exist for one slice only.
_SLICE = 2 << 20


def _runs(names, rows, first, last, lo, hi):
    """Runs of equal neighbours in a row become one symbol each. lo, hi: the words a symbol's making depended on."""
    new = np.ones(len(names), bool)
    new[1:] = (names[1:] != names[:-1]) | (rows[1:] != rows[:-1])
    at = np.flatnonzero(new)
    end = np.append(at[1:], len(names)) - 1
    size = (end - at + 1).astype(np.uint64)
    symbol = np.where(size > 1, mixed(names[at] * MIX[2] + size), names[at])
    # that a run is complete is known from the symbols next to it
    left = np.where(at > 0, lo[np.maximum(at - 1, 0)], first[at] - 1)
    right = np.where(end < len(names) - 1, hi[np.minimum(end + 1, len(names) - 1)], last[end] + 1)
    return symbol, names[at], rows[at], first[at], last[end], np.minimum(left, lo[at]), np.maximum(right, hi[end])


def _pairs(symbol, base, rows, first, last, lo, hi, level: int):
    """Left and right neighbours become one symbol. The side is a bit of the run's letter, so that it is known early."""
    right_side = ((mixed(base ^ MIX[level % 4]) >> np.uint64(33)) & np.uint64(1)).astype(bool)
    joined = np.zeros(len(symbol), bool)  # with the next one
    joined[:-1] = ~right_side[:-1] & right_side[1:] & (rows[1:] == rows[:-1])
    start = np.ones(len(symbol), bool)
    start[1:] = ~joined[:-1]
    at = np.flatnonzero(start)
    other = np.minimum(at + joined[at], len(symbol) - 1)
    name = np.where(joined[at], mixed(symbol[at] * MIX[3] + symbol[other] * MIX[1] + np.uint64(level)), symbol[at])
    # a symbol stays single because of its neighbours' sides
    left = np.where(joined[at] | (at == 0), first[at] - 1, lo[np.maximum(at - 1, 0)])
    right = np.where(joined[at] | (at == len(symbol) - 1), last[other] + 1, hi[np.minimum(at + 1, len(symbol) - 1)])
    return name, rows[at], first[at], last[other], np.minimum(left, lo[at]), np.maximum(right, hi[other])


def symbols(names: np.ndarray, rows: np.ndarray, levels: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per level: name, first and last word that matter of every symbol. Both places never fall from symbol to symbol."""
    first = np.arange(len(names))
    last, lo, hi = first.copy(), first.copy(), first.copy()
    for level in range(levels if len(names) else 0):
        runs = _runs(names, rows, first, last, lo, hi)
        names, rows, first, last, lo, hi = _pairs(*runs, level)
        yield names, lo, hi


def _least(values: np.ndarray, first: np.ndarray, after: np.ndarray) -> np.ndarray:
    """The smallest of the values in each range, from tables of the minima of 1, 2, 4 … neighbours."""
    size, out = after - first, np.empty(len(first), np.uint64)
    reach = 1
    while len(values):
        mine = (size >= reach) & (size < 2 * reach)
        out[mine] = np.minimum(values[first[mine]], values[after[mine] - reach])
        if not (size >= 2 * reach).any():
            break
        values = np.minimum(values[:-reach], values[reach:])
        reach *= 2
    return out


class Sequence:
    """The words of a slice of texts."""

    def __init__(self, column, size: int):
        self.buf, self.offsets = text_bytes(column)
        self.size = size
        self.first, self.last, self.rows = words(self.buf, self.offsets)
        self.n = n = len(self.first)
        self.places = np.flatnonzero(self.rows[: max(0, n - size + 1)] == self.rows[size - 1 :]) if n >= size else np.zeros(0, np.int64)

    def names(self, family: int = 0) -> np.ndarray:
        return word_names(self.buf, self.first, self.last, family=family)

    def labels(self) -> np.ndarray:
        """The label of the window at each of ``places``."""
        names, label, todo = self.names(), np.zeros(len(self.places), np.uint64), np.arange(len(self.places))
        parsed = list(symbols(names, self.rows, LEVELS)) if len(todo) else []
        for level in reversed(range(len(parsed))):
            name, lo, hi = parsed[level]
            at = self.places[todo]
            first, after = np.searchsorted(lo, at), np.searchsorted(hi, at + self.size)
            usable = after > first
            label[todo[usable]] = _least(mixed(name + np.uint64(level)), first[usable], after[usable])
            todo = todo[~usable]
        label[todo] = self.windows(self.places[todo], names)
        return label

    def windows(self, at: np.ndarray, names: np.ndarray) -> np.ndarray:
        """Name of the word sequence of the window at each place."""
        out = np.zeros(len(at), np.uint64)
        for k in range(self.size):
            out = mixed(out * MIX[3] + names[at + k])
        return out

    def checks(self, at: np.ndarray) -> np.ndarray:
        """A second name of each window, independent of the first: a sum of its words' names of the other family."""
        names, out = self.names(1), np.zeros(len(at), np.uint64)
        for k, odd in enumerate((mixed(np.arange(self.size, dtype=np.uint64)) | np.uint64(1)).tolist()):
            out += names[at + k] * np.uint64(odd)
        return (mixed(out) >> np.uint64(32)).astype(np.uint32)


def _send(batches: Iterator[pa.RecordBatch], size: int, n: int) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, size=_SLICE):
        text = Sequence(batch.column(1), size)
        label = text.labels()
        rows = text.rows[text.places]
        new = np.ones(len(label), bool)
        new[1:] = (label[1:] != label[:-1]) | (rows[1:] != rows[:-1])
        yield sent(label[new], rows[new], np.asarray(batch.column(2))[rows[new]], n)


def _shared_windows(docs: pa.Table, reply: pa.Table, size: int):
    """Of the block's windows with a shared label: both names, ids, slice and place."""
    wanted = np.unique(of_kind(reply, 0))
    found = [[np.zeros(0, kind)] for kind in (np.uint64, np.uint32, np.int64, np.int32, np.int32)]
    for number, batch in enumerate(slices(docs.to_batches(), size=_SLICE)):
        text = Sequence(batch.column(1), size)
        at = text.places[among(text.labels(), wanted)]
        if len(at):
            ids = np.asarray(batch.column(0))[text.rows[at]]
            for f, x in zip(found, (text.windows(at, text.names()), text.checks(at), ids, np.full(len(at), number, np.int32), at.astype(np.int32))):
                f.append(x)
    return [np.concatenate(f) for f in found]


def _name(docs: pa.Table, reply: pa.Table, size: int, n: int) -> pa.Table:
    names, checks, ids, _, _ = _shared_windows(docs, reply, size)
    first, _ = lowest(names, checks, ids)
    first = first[np.argsort(ids[first], kind="stable")]  # ids in order cost next to nothing once compressed
    names, checks, low = names[first], checks[first], ids[first]
    bucket = bucket_of(names, n)
    order = np.argsort(bucket, kind="stable")
    edge = cuts(bucket[order])
    number = int(docs["block"][0].as_py()) if docs.num_rows else 0
    out = [[], [], [], [], []]
    for a, b in zip(edge[:-1], edge[1:]):
        mine = order[a:b]
        cells = (names[mine].tobytes(), checks[mine].tobytes(), low[mine].astype(np.int64).tobytes())
        for o, v in zip(out, (int(bucket[mine[0]]), number, *cells)):
            o.append(v)
    kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    return pa.table([pa.array(o, k) for o, k in zip(out, kinds)], names=["bucket", "block", "names", "checks", "low"])


def _earlier(group: pa.Table) -> pa.Table:
    """For every block, the names that also start in a document below the block's lowest one."""
    names, checks = (unpacked(group[c].to_pylist(), kind) for c, kind in (("names", np.uint64), ("checks", np.uint32)))
    low = unpacked(group["low"].to_pylist(), np.int64)
    blocks = np.repeat(np.asarray(group["block"]), [len(c) // 8 for c in group["names"].to_pylist()])
    first, number = lowest(names, checks, low)
    mine = low > low[first][number]
    return replies(blocks[mine], np.full(int(mine.sum()), 2), names[mine], checks[mine])


def _cover(docs: pa.Table, reply: pa.Table, size: int) -> pa.Table:
    names, checks, ids, number, place = _shared_windows(docs, reply, size)
    first, pair = lowest(names, checks, ids)
    later = ids > ids[first][pair]
    later |= found_pairs(names, checks, of_kind(reply, 2), of_kind(reply, 2, "checks", np.uint32))[0]
    number, place = number[later], place[later].astype(np.int64)
    out = []
    for i, batch in enumerate(slices(docs.to_batches(), size=_SLICE)):
        a, b = np.searchsorted(number, [i, i + 1])
        out.append(_covered(Sequence(batch.column(1), size), np.asarray(batch.column(0)), place[a:b]))
    return pa.concat_tables(out) if out else _covered(Sequence(docs["text"], size), np.asarray(docs["id"]), place)


def _covered(text: Sequence, ids: np.ndarray, at: np.ndarray) -> pa.Table:
    """The rows of a slice without the words covered by the windows at the places ``at``."""
    edge = np.bincount(at, minlength=text.n + 1).astype(np.int64)
    edge -= np.bincount(at + text.size, minlength=text.n + 1)[: text.n + 1]
    covered = np.cumsum(edge[: text.n]) > 0
    n_rows = len(text.offsets) - 1
    bounds = np.searchsorted(text.rows, np.arange(n_rows + 1))
    begins = np.zeros(text.n + 1, bool)
    begins[bounds] = True
    before = np.concatenate([[False], covered[:-1]]) if text.n else covered
    after = np.concatenate([covered[1:], [False]]) if text.n else covered
    s = np.flatnonzero(covered & (~before | begins[: text.n]))
    e = np.flatnonzero(covered & (~after | begins[1:])) + 1
    spans = pa.StructArray.from_arrays([pa.array(s - bounds[text.rows[s]]), pa.array(e - s)], names=["start", "length"])
    per_row = np.searchsorted(text.rows[s], np.arange(n_rows + 1))
    # the words left, each with a space behind it; the last space of a row goes
    left = np.flatnonzero(~covered)
    sizes = text.last[left] - text.first[left] + 1
    ends = np.cumsum(sizes)
    where = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(text.first[left] - (ends - sizes), sizes)
    data = np.append(text.buf, np.uint8(32))[where]
    data[ends - 1] = 32
    at_row = np.concatenate([[0], ends])[np.searchsorted(text.rows[left], np.arange(n_rows + 1))]
    raw = data.tobytes()
    kept = [raw[a : max(a, b - 1)] for a, b in zip(at_row[:-1].tolist(), at_row[1:].tolist())]
    return pa.table(
        [
            pa.array(ids, mask=ids == LAST_ID), pa.array(np.diff(bounds)),
            pa.ListArray.from_arrays(pa.array(per_row, pa.int32()), spans), pa.array(kept, pa.binary()),
        ],
        names=["doc_id", "n_words", "spans", "kept"],
    )


def remove_repeats(docs: DataFrame, size: int = 13, blocks: int | None = None) -> DataFrame:
    """doc_id, n_words, spans (first word and number of words of the removed runs) and kept (the words left, UTF-8,
    joined by one space) of every row.

    ``docs``: doc_id, text. Words are runs of anything but space and the bytes 9 to 13, unchanged; null has none. A word
    goes when a window of ``size`` words covers it whose word sequence also starts in a row with a smaller doc_id;
    windows are judged on the input. Rows with equal ids don't remove from each other; rows without an id come after
    all others. An empty table gives no rows; other columns are not read. Word sequences are
    compared by two independent names of 64 and 32 bits.
    """
    n = blocks or blocks_for(docs)
    rows = blocked(docs, n)
    shared = stored(shared_names(rows.mapInArrow(lambda b: _send(b, size, n), SENT)), "shared-symbols")

    def both(right: DataFrame, run, schema: str) -> DataFrame:
        return rows.groupBy("block").cogroup(right.groupBy("block")).applyInArrow(run, schema)

    named = both(shared, lambda d, r: _name(d, r, size, n), NAMED)
    earlier = stored(named.groupBy("bucket").applyInArrow(_earlier, REPLY), "earlier-windows")
    return both(shared.union(earlier), lambda d, r: _cover(d, r, size), RESULT)


def digests(found: DataFrame) -> DataFrame:
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["length"])
    return found.select("doc_id", "n_words", removed.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))
