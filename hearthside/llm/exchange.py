"""Names that recur between documents, found in two packed exchanges.

Documents live in blocks (hash of the id). A task sends each name once per block and batch, packed by name bucket; a
bucket counts documents and answers every block with the names it shares with another document. However often a name
occurs, a bucket sees it at most once per block and batch.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthside.llm.common import cuts, mixed, parts, row_id, unpacked

SENT = "bucket int, names binary, blocks binary, docs binary"
#: kind 0: names shared with another document; 1: those of so many documents that their windows are dealt out singly;
#: 2: window masks
REPLY = "block int, kind int, names binary, checks binary, bits binary"
#: Bytes of text that a block should hold.
BLOCK_BYTES = 16 << 20


def blocks_for(docs: DataFrame) -> int:
    """Number of blocks: one a shuffle partition, and more where these would hold more than ``BLOCK_BYTES`` of text."""
    size = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0]
    return max(parts(docs.sparkSession), -(-(size or 0) // BLOCK_BYTES))


def block_of(n: int) -> Column:
    """Rows of one id, and rows without one, are spread by their texts."""
    return F.pmod(F.xxhash64("id", "text"), F.lit(n)).cast("int")


def blocked(docs: DataFrame, n: int, missing: str | None = None) -> DataFrame:
    """id, text and block of ``docs`` (doc_id, text); ``missing`` names a column that tells rows without an id."""
    rows = docs.select(row_id().alias("id"), F.col("text").cast("string").alias("text"), F.col("doc_id").cast("long").isNull().alias("missing"))
    return rows.select("id", "text", block_of(n).alias("block"), *([F.col("missing").alias(missing)] if missing else []))


def bucket_of(names: np.ndarray, n: int) -> np.ndarray:
    return (mixed(names) % np.uint64(n)).astype(np.int64)


def sent(names: np.ndarray, docs: np.ndarray, blocks: np.ndarray, n: int) -> pa.RecordBatch:
    """Distinct (name, block) with the number of documents (255: that many or more), a row per bucket.

    ``docs`` numbers the documents of the batch in the order of the names.
    """
    order = np.lexsort((docs, blocks, names))
    names, docs, blocks = names[order], docs[order], blocks[order]
    new_pair = np.ones(len(names), bool)
    new_pair[1:] = (names[1:] != names[:-1]) | (blocks[1:] != blocks[:-1])
    new_doc = new_pair.copy()
    new_doc[1:] |= docs[1:] != docs[:-1]
    at = np.flatnonzero(new_pair)
    count = np.add.reduceat(new_doc, at, dtype=np.int64) if len(at) else np.zeros(0, np.int64)
    names, blocks, count = names[at], blocks[at].astype(np.uint32), np.minimum(count, 255).astype(np.uint8)
    bucket = bucket_of(names, n)
    order = np.argsort(bucket, kind="stable")
    edge = cuts(bucket[order])
    out = [[], [], [], []]
    for a, b in zip(edge[:-1], edge[1:]):
        mine = order[a:b]
        for o, v in zip(out, (int(bucket[mine[0]]), names[mine].tobytes(), blocks[mine].tobytes(), count[mine].tobytes())):
            o.append(v)
    kinds = [pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(o, k) for o, k in zip(out, kinds)], names=["bucket", "names", "blocks", "docs"])


def replies(blocks: np.ndarray, kinds: np.ndarray, names: np.ndarray, checks: np.ndarray | None = None, bits: np.ndarray | None = None) -> pa.Table:
    """Names, their second names and bits packed by block and kind."""
    key = blocks.astype(np.int64) * 4 + kinds
    order = np.argsort(key, kind="stable")
    edge = cuts(key[order])
    out = [[], [], [], [], []]
    for a, b in zip(edge[:-1], edge[1:]):
        mine = order[a:b]
        cells = [b"" if x is None else x[mine].tobytes() for x in (names, checks, bits)]
        for o, v in zip(out, (int(key[mine[0]]) >> 2, int(key[mine[0]]) & 3, *cells)):
            o.append(v)
    types = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    return pa.table([pa.array(o, k) for o, k in zip(out, types)], names=["block", "kind", "names", "checks", "bits"])


def shared_names(rows: DataFrame, many: int | None = None) -> DataFrame:
    """Of the names sent, those of at least two documents, for every block that sent them (``REPLY`` rows).

    Names of ``many`` documents or more come as kind 1.
    """

    def run(group: pa.Table) -> pa.Table:
        names = unpacked(group["names"].to_pylist(), np.uint64)
        blocks = unpacked(group["blocks"].to_pylist(), np.uint32)
        docs = unpacked(group["docs"].to_pylist(), np.uint8).astype(np.int64)
        order = np.argsort(names, kind="stable")
        names, blocks, docs = names[order], blocks[order], docs[order]
        edge = cuts(names)
        total = np.repeat(np.add.reduceat(docs, edge[:-1]) if len(names) else docs, np.diff(edge))
        keep = total >= 2
        names, blocks, total = names[keep], blocks[keep], total[keep]
        kinds = np.zeros(len(names), np.int64) if many is None else (total >= many).astype(np.int64)
        return replies(blocks, kinds, names)

    return rows.groupBy("bucket").applyInArrow(run, REPLY)


def of_kind(reply: pa.Table, kind: int, column: str = "names", dtype=np.uint64) -> np.ndarray:
    """The names (or bits) of one kind, in the order received."""
    if not reply.num_rows:
        return np.zeros(0, dtype)
    mine = np.asarray(reply["kind"]) == kind
    return unpacked([c for c, m in zip(reply[column].to_pylist(), mine) if m], dtype)


def among(values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Which of ``values`` are in the array ``wanted`` (need not be sorted)."""
    return found_at(values, np.unique(wanted))[0]


def found_at(values: np.ndarray, ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(ordered):
        return np.zeros(len(values), bool), np.zeros(len(values), np.int64)
    at = np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)
    return ordered[at] == values, at


def found_pairs(names: np.ndarray, checks: np.ndarray, of: np.ndarray, of_checks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which pairs (name, second name) are among the pairs ``of``, and where."""
    order = np.lexsort((of_checks, of))
    of, of_checks = of[order], of_checks[order]
    hit, at = found_at(names, of)
    todo = np.flatnonzero(hit)
    while len(todo):  # further pairs of a name are rare
        todo = todo[of_checks[at[todo]] != checks[todo]]
        at[todo] += 1
        ends = at[todo] >= len(of)
        ends[~ends] = of[at[todo[~ends]]] != names[todo[~ends]]
        hit[todo[ends]] = False
        todo = todo[~ends]
    return hit, order[np.minimum(at, len(of) - 1)] if len(of) else at


def lowest(keys: np.ndarray, checks: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The place of the first row by id of each distinct pair (key, check), and for every row its pair's number."""
    order = np.argsort(keys)
    k, c = keys[order], checks[order]
    new = np.ones(len(keys), bool)
    new[1:] = k[1:] != k[:-1]
    if ((c[1:] != c[:-1]) & ~new[1:]).any():  # a key with several checks, which is rare
        order = np.lexsort((checks, keys))
        k, c = keys[order], checks[order]
        new[1:] = (k[1:] != k[:-1]) | (c[1:] != c[:-1])
    group = np.cumsum(new) - 1
    number = np.empty(len(keys), np.int64)
    number[order] = group
    if not len(keys):
        return order, number
    least = np.minimum.reduceat(ids[order], np.flatnonzero(new))
    hits = np.flatnonzero(ids[order] == least[group])
    first = np.ones(len(hits), bool)
    first[1:] = group[hits[1:]] != group[hits[:-1]]
    return order[hits[first]], number
