"""Toxicity by a factorization machine over hashed terms.

Terms are the distinct lower-cased words of a text and their beginnings, hashed. The machine adds a weight per term and
a weight per pair of terms, the dot product of two learned factors, so that a harmless word counts as an insult only
beside another one. It is fitted with Adam on a bounded sample of labelled rows; scoring is one pass over the text.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from hearthside.llm.common import MIX, mixed, slices, stored, text_bytes, tokens, unpacked, word_names

BITS = 26
STEM = 5  # bytes of a word's beginning
_SLICES = 16
_SLICE = 1 << 20  # bytes of text whose words are held at once


def terms(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(row, hashed term), sorted and distinct, of whole texts; null and empty texts have none."""
    buf, offsets = text_bytes(column)
    first, last, rows = tokens(buf, offsets)
    whole = word_names(buf, first, last, lower=True)
    long = last - first > STEM
    stem = mixed(word_names(buf, first[long], first[long] + STEM, lower=True) ^ MIX[0])
    keys = np.concatenate([whole, stem]) >> np.uint64(64 - BITS)
    both = np.unique(np.concatenate([rows, rows[long]]).astype(np.uint64) << np.uint64(BITS) | keys)
    return (both >> np.uint64(BITS)).astype(np.int64), (both & np.uint64((1 << BITS) - 1)).astype(np.int64)


@dataclass
class FactorizationMachine:
    """score = sigmoid(bias + sum of weights + sum over pairs of factor products) of the known terms present."""

    keys: np.ndarray  # sorted hashed terms
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def raw(self, rows: np.ndarray, index: np.ndarray, n: int) -> np.ndarray:
        out = np.full(n, self.bias)
        np.add.at(out, rows, self.weights[index])
        sums = np.zeros((n, self.factors.shape[1]))
        np.add.at(sums, rows, self.factors[index])
        own = np.zeros(n)
        np.add.at(own, rows, (self.factors[index] ** 2).sum(axis=1))
        return out + 0.5 * ((sums**2).sum(axis=1) - own)

    def known(self, rows: np.ndarray, hashed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.keys):
            return rows[:0], hashed[:0]
        at = np.minimum(np.searchsorted(self.keys, hashed), len(self.keys) - 1)
        hit = self.keys[at] == hashed
        return rows[hit], at[hit]

    def score(self, column: pa.Array) -> np.ndarray:
        raw = self.raw(*self.known(*terms(column)), len(column))
        return 1 / (1 + np.exp(-np.clip(raw, -500, 500)))


def fit_machine(keys, rows, index, labels, size: int = 8, epochs: int = 30, rate: float = 0.02, decay: float = 1e-4, seed: int = 7):
    """Adam on the logistic loss, in batches of rows. ``rows`` is sorted; ``index`` points into ``keys``."""
    rng = np.random.default_rng(seed)
    n, m = len(labels), len(keys)
    mean = min(max(labels.mean() if n else 0.0, 1e-3), 1 - 1e-3)
    at = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=n))]) if n else np.zeros(1, np.int64)
    state = [np.array([np.log(mean / (1 - mean))]), np.zeros(m), rng.normal(0, 0.01, (m, size))]
    first, second, step = [np.zeros_like(x) for x in state], [np.zeros_like(x) for x in state], 0
    for _ in range(epochs if n and m else 0):
        order = rng.permutation(n)
        for begin in range(0, n, 512):
            chosen = order[begin : begin + 512]
            spans = [np.arange(at[i], at[i + 1]) for i in chosen]
            local = np.repeat(np.arange(len(chosen)), [len(s) for s in spans])
            ids = index[np.concatenate(spans)]
            machine = FactorizationMachine(keys, state[0][0], state[1], state[2])
            p = 1 / (1 + np.exp(-np.clip(machine.raw(local, ids, len(chosen)), -500, 500)))
            error = (p - labels[chosen]) / len(chosen)
            sums = np.zeros((len(chosen), size))
            np.add.at(sums, local, state[2][ids])
            grads = [np.array([error.sum()]), decay * state[1], decay * state[2]]
            np.add.at(grads[1], ids, error[local])
            np.add.at(grads[2], ids, error[local, None] * (sums[local] - state[2][ids]))
            step += 1
            for k, g in enumerate(grads):
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                state[k] = state[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return FactorizationMachine(keys, float(state[0][0]), state[1], state[2])


def learnable(labels: DataFrame) -> DataFrame:
    """Rows a model may learn from: crc32 of the id as text, mod 5, is not 0."""
    return labels.where(F.col("doc_id").isNotNull() & (F.crc32(F.col("doc_id").cast("string")) % 5 != 0))


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = 40_000, max_terms: int = 4096) -> FactorizationMachine:
    """Learn ``labels.toxic`` from at most ``max_rows`` labelled rows (those with the smallest hash of their id).

    ``labels`` are filtered by the caller (see ``learnable``); rows with a null id or label and ids whose labels
    contradict each other are left out. Of the terms, the at most ``max_terms`` whose presence tells the label best
    (chi-square over the sample, 8 at least) enter the machine. Without labelled rows the score is constant.
    """
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(
        F.min("toxic").alias("y"), F.max("toxic").alias("y2")
    )
    sample = known.where("y = y2").select("doc_id", "y").orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, size=_SLICE):
            rows, hashed = terms(batch.column(1))
            at = np.searchsorted(rows, np.arange(batch.num_rows + 1))
            packed = [hashed[a:b].astype(np.int32).tobytes() for a, b in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], names=["y", "terms"])

    # the sample has at most max_rows rows of two numbers: small enough to send to every task
    text = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select(F.col("y").cast("int").alias("y"), "text")
    data = stored(text.mapInArrow(rows_of, "y int, terms binary"), "toxic-sample")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = np.asarray(batch.column(0))
            cells = batch.column(1).to_pylist()
            out = [[], [], []]
            for label in (0, 1):
                ids, n = np.unique(unpacked([c for c, v in zip(cells, y) if v == label], np.int32), return_counts=True)
                for part in range(_SLICES):
                    mine = ids % _SLICES == part
                    if mine.any():
                        for o, v in zip(out, (part, label, np.stack([ids[mine], n[mine].astype(np.int32)]).tobytes())):
                            o.append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.int32()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.binary())], names=["part", "y", "counts"]
            )

    totals = {r["y"]: r["count"] for r in data.groupBy("y").count().collect()}
    n1, n0 = totals.get(1, 0), totals.get(0, 0)

    def best(key, cells: pd.DataFrame) -> pd.DataFrame:
        sums = []
        for label in (0, 1):
            pairs = [np.frombuffer(c, np.int32).reshape(2, -1) for c, y in zip(cells["counts"], cells["y"]) if y == label]
            ids = np.concatenate([p[0] for p in pairs]) if pairs else np.zeros(0, np.int32)
            n = np.concatenate([p[1] for p in pairs]) if pairs else np.zeros(0, np.int32)
            ids, back = np.unique(ids, return_inverse=True)
            sums.append(pd.Series(np.bincount(back, n, len(ids)), ids))
        both = pd.concat(sums, axis=1, keys=["c0", "c1"]).fillna(0)
        a, b = both["c1"].to_numpy(), both["c0"].to_numpy()
        total, have = n1 + n0, a + b
        chi = total * (a * (n0 - b) - b * (n1 - a)) ** 2 / np.maximum(1.0, have * (total - have) * float(n1) * n0)
        found = pd.DataFrame({"term": both.index.astype("int64"), "chi": chi})
        return found[found["chi"] >= 8].sort_values(["chi", "term"], ascending=[False, True]).head(max_terms)

    scored = data.mapInArrow(counted, "part int, y int, counts binary").groupBy("part").applyInPandas(best, "term long, chi double")
    keys = np.array(sorted(r["term"] for r in scored.orderBy(F.desc("chi"), "term").limit(max_terms).collect()), np.int64)
    machine = FactorizationMachine(keys, 0.0, np.zeros(len(keys)), np.zeros((len(keys), 1)))

    def narrowed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = batch.column(1).to_pylist()
            rows = np.repeat(np.arange(len(cells)), [len(c) // 4 for c in cells])
            rows, index = machine.known(rows, unpacked(cells, np.int32).astype(np.int64))
            at = np.searchsorted(rows, np.arange(len(cells) + 1))
            packed = [index[a:b].astype(np.int16).tobytes() for a, b in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], names=["y", "terms"])

    few = data.mapInArrow(narrowed, "y int, terms binary").toPandas()  # at most max_rows rows of at most max_terms numbers
    few = few.sort_values(["y", "terms"])  # an order that does not depend on the tasks
    rows = np.repeat(np.arange(len(few)), [len(c) // 2 for c in few["terms"]])
    return fit_machine(keys, rows, unpacked(few["terms"], np.int16).astype(np.int64), few["y"].to_numpy(float))


def score(docs: DataFrame, machine: FactorizationMachine) -> DataFrame:
    """Every row and column of ``docs`` with ``toxicity`` (0 to 1). Null and empty texts have the score of no term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, at, _SLICE):
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(machine.score(batch.column(at)))], names=[*batch.schema.names, "toxicity"])

    docs = docs.drop("toxicity")
    at = docs.columns.index("text")
    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField("toxicity", DoubleType())]))
