"""Benchmark items found in documents, also paraphrased, by latent semantic retrieval.

Items are cut into passages of at most ``WINDOW`` words. Their TF-IDF matrix (document frequencies counted over all
documents) gets a randomised SVD whose products are Spark joins and sums; its right vectors map words to a latent
space. One pass over the documents takes candidates by two routes: windows that hold a large share of the weight of a
passage's own words, which a contained passage always meets, and windows with a large cosine in the latent space and a
large share of the passage's energy. Each is checked by the longest common subsequence of words and of the answer, the
passage's last sentence.
"""

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthside.llm.common import slices, stored, text_bytes, tokens, word_names

WINDOW, STRIDE = 64, 32
#: Bytes of text searched at a time: a weighted word takes a latent row, which is some hundred times as much as the word.
_SLICE = 1 << 20
#: Sums of weights (block, passage) held at a time.
_CELLS = 1 << 20
HITS = "doc_id long, item_id long, first_word long, cosine double, lcs double, answer double"


@dataclass
class Passage:
    item_id: int | None
    words: np.ndarray  # names
    answer: int  # the answer begins at this word


def passages_of(item_id, text: str | None) -> list[Passage]:
    buf, offsets = text_bytes(pa.array([text], pa.string()))
    first, last, _ = tokens(buf, offsets)
    names = word_names(buf, first, last, lower=True)
    if not len(names):
        return []
    raw = buf.tobytes()
    # the answer is the last sentence with at least two words, at most half of the passage
    ends = [i for i in range(len(names) - 2) if any(c in raw[last[i] : first[i + 1]] for c in b".?!:\n")]
    start = (ends[-1] + 1) if ends else 0
    start = max(start, len(names) // 2)
    out = []
    for a in range(0, max(1, len(names) - STRIDE) if len(names) > WINDOW else 1, STRIDE):
        part = names[a : a + WINDOW]
        at = start - a
        out.append(Passage(item_id, part, at if 0 <= at < len(part) else len(part) // 2))
    return out


def common_subsequence(x: np.ndarray, y: np.ndarray) -> int:
    """Length of the longest common subsequence, bit-parallel over ``x``."""
    places: dict[int, int] = defaultdict(int)
    for i, v in enumerate(x.tolist()):
        places[v] |= 1 << i
    full = (1 << len(x)) - 1
    row = full
    for v in y.tolist():
        m = places.get(v, 0)
        if m:
            u = row & m
            row = ((row + u) | (row - u)) & full
    return len(x) - row.bit_count()


def _noise(word: int, width: int) -> np.ndarray:
    return np.random.default_rng(word & (2**63 - 1)).standard_normal(width)


def right_vectors(entries: DataFrame, width: int, power: int = 2) -> DataFrame:
    """(word, vector): orthonormal basis of the leading right singular space of a sparse matrix (row, word, x).

    Randomised range finder with power iteration. Both products are joins on the word or row followed by sums; only
    the width by width Gram matrix comes to the driver.
    """
    pack = lambda m: m.astype(np.float64).tobytes()

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = [pack(_noise(w, width)) for w in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(vectors, pa.binary())], names=["word", "vector"])

    def summed(key: str):
        def run(k, group: pd.DataFrame) -> pd.DataFrame:
            m = np.frombuffer(b"".join(group["vector"]), np.float64).reshape(-1, width)
            return pd.DataFrame({key: [k[0]], "vector": [pack(group["x"].to_numpy() @ m)]})

        return run

    def orthonormal(z: DataFrame) -> DataFrame:
        def squared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            gram = np.zeros((width, width))
            for batch in batches:
                m = text_bytes(batch.column(1))[0].view(np.float64).reshape(-1, width)
                gram += m.T @ m
            yield pa.RecordBatch.from_arrays([pa.array([gram.tobytes()], pa.binary())], names=["gram"])

        parts = z.mapInArrow(squared, "gram binary").coalesce(64).toLocalIterator()
        gram = sum((np.frombuffer(r["gram"], np.float64).reshape(width, width) for r in parts), np.zeros((width, width)))
        values, turn = np.linalg.eigh(gram)
        keep = values > max(values.max(), 1e-12) * 1e-10
        scale = np.where(keep, 1 / np.sqrt(np.where(keep, values, 1)), 0)
        turned = turn * scale

        def rotated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                m = text_bytes(batch.column(1))[0].view(np.float64).reshape(-1, width) @ turned
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([pack(v) for v in m], pa.binary())], names=["word", "vector"])

        return stored(z.mapInArrow(rotated, "word long, vector binary"), "basis")

    z = stored(entries.select("word").distinct().mapInArrow(start, "word long, vector binary"), "noise")
    for _ in range(power):
        y = entries.join(z, "word").groupBy("row").applyInPandas(summed("row"), "row long, vector binary")
        z = orthonormal(stored(entries.join(y, "row").groupBy("word").applyInPandas(summed("word"), "word long, vector binary"), "products"))
    return z


@dataclass
class LatentItems:
    """What a task needs to search: one block of items, whose number is a parameter."""

    passages: list[Passage]
    vocabulary: np.ndarray  # sorted names of the weighted words
    space: np.ndarray  # a latent row for each, weighted
    vectors: np.ndarray  # passages in the latent space
    energy: np.ndarray  # their squared length there
    weight: np.ndarray  # of the weighted words
    starts: np.ndarray  # where each word's passages begin in holders
    holders: np.ndarray  # the passages with a word, word by word
    whole: np.ndarray  # weight of the distinct weighted words of a passage


def _windows(column, vocabulary: np.ndarray):
    buf, offsets = text_bytes(column)
    first, last, rows = tokens(buf, offsets)
    names = word_names(buf, first, last, lower=True)
    at = np.minimum(np.searchsorted(vocabulary, names), max(0, len(vocabulary) - 1))
    hit = np.flatnonzero(vocabulary[at] == names) if len(vocabulary) else np.zeros(0, np.int64)
    bounds = np.searchsorted(rows, np.arange(len(offsets)))
    return names, rows, bounds, hit, at[hit]


def document_frequencies(docs: DataFrame, vocabulary: np.ndarray) -> tuple[np.ndarray, int]:
    """In how many rows of ``docs`` (doc_id, text) each word occurs, and the number of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, seen = np.zeros(len(vocabulary), np.int64), 0
        for batch in slices(batches, size=_SLICE):
            _, rows, _, hit, at = _windows(batch.column(1), vocabulary)
            pairs = np.unique(rows[hit].astype(np.int64) * len(vocabulary) + at)
            count += np.bincount(pairs % max(1, len(vocabulary)), minlength=len(vocabulary))
            seen += batch.num_rows
        some = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(some, -1)), pa.array(np.append(count[some], seen))], names=["at", "n"])

    total, n = np.zeros(len(vocabulary), np.int64), 0
    for r in docs.mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toLocalIterator():
        if r["at"] < 0:
            n = r["n"]
        else:
            total[r["at"]] = r["n"]
    return total, n


def latent_items(docs: DataFrame, passages: list[Passage], width: int, common: float) -> LatentItems:
    spark = docs.sparkSession
    every = np.unique(np.concatenate([p.words for p in passages]))
    frequency, n = document_frequencies(docs, every)
    idf = np.log((1 + n) / (1 + frequency))
    rare = frequency <= common * max(1, n)
    # words of very many documents say little; a passage with few others keeps all of its words
    wanted = np.zeros(len(every), bool)
    for p in passages:
        at = np.searchsorted(every, np.unique(p.words))
        wanted[at[rare[at]] if rare[at].sum() >= 5 else at] = True
    vocabulary, weight = every[wanted], np.maximum(idf[wanted], 0.05)
    rows = []
    for i, p in enumerate(passages):
        names, tf = np.unique(p.words, return_counts=True)
        at = np.searchsorted(vocabulary, names)
        ok = (at < len(vocabulary)) & (vocabulary[np.minimum(at, len(vocabulary) - 1)] == names)
        rows += [(i, int(a), float(x)) for a, x in zip(at[ok], weight[at[ok]] * np.sqrt(tf[ok]))]
    entries = stored(spark.createDataFrame(rows, "row long, word long, x double"), "tf-idf")
    basis = np.zeros((len(vocabulary), width), np.float32)
    for r in right_vectors(entries, width).toLocalIterator():  # a row per word of the item block
        basis[r["word"]] = np.frombuffer(r["vector"], np.float64)
    vectors = np.zeros((len(passages), width), np.float32)
    for i, a, x in rows:
        vectors[i] += x * basis[a]
    holders, held = np.array([(i, a) for i, a, _ in rows], np.int64).reshape(-1, 2).T
    order = np.argsort(held, kind="stable")
    return LatentItems(
        passages, vocabulary, basis * weight[:, None].astype(np.float32), vectors, (vectors**2).sum(axis=1),
        weight, np.searchsorted(held[order], np.arange(len(vocabulary) + 1)), holders[order],
        np.bincount(holders, weight[held], len(passages)),
    )


def _holding(blocks: np.ndarray, words: np.ndarray, n: int, model: LatentItems, present: float) -> Iterator[tuple[int, int]]:
    """(block, passage) where the block and the two after it may hold ``present`` of the weight of the passage's words.

    ``blocks`` and ``words`` are the weighted words of the text by block. A word counts once a block, so the sum over
    three blocks is never below the weight that is there. A passage that begins in a block ends in the second after it.
    """
    pairs = np.unique(blocks * len(model.vocabulary) + words)
    blocks, words = np.divmod(pairs, len(model.vocabulary))
    width, least = len(model.passages), model.whole * present * (1 - 1e-9)
    step = max(64, _CELLS // width)
    for a in range(0, n, step):
        i, j = np.searchsorted(blocks, (a, a + step + 2))
        if i == j:
            continue
        w = words[i:j]
        copies = model.starts[w + 1] - model.starts[w]
        at = np.repeat(model.starts[w] - (np.cumsum(copies) - copies), copies) + np.arange(copies.sum())
        cells = np.repeat((blocks[i:j] - a) * width, copies) + model.holders[at]
        held = np.bincount(cells, np.repeat(model.weight[w], copies), (step + 2) * width).reshape(-1, width)
        for b, p in zip(*np.nonzero(held[:-2] + held[1:-1] + held[2:] >= least)):
            if a + b < n:
                yield int(a + b), int(p)


def search(column, model: LatentItems, cosine: float, share: float, least: float, present: float):
    """(row, passage, first word, cosine, lcs, answer) of the passages found in whole texts."""
    names, rows, bounds, hit, at = _windows(column, model.vocabulary)
    if not len(hit):
        return
    in_row = hit - bounds[rows[hit]]
    n_blocks = -(-np.diff(bounds) // STRIDE)
    base = np.cumsum(n_blocks) - n_blocks
    block = base[rows[hit]] + in_row // STRIDE
    for b, p in _holding(block, at, int(n_blocks.sum()), model, present):
        row = int(np.searchsorted(base, b, side="right")) - 1
        lo = int(bounds[row] + (b - base[row]) * STRIDE)
        hi = min(int(bounds[row + 1]), lo + WINDOW + STRIDE)
        passage, text = model.passages[p], names[lo:hi]
        if np.isin(passage.words, text).sum() < least * len(passage.words):
            continue
        lcs = common_subsequence(passage.words, text) / len(passage.words)
        if lcs < least:
            continue
        vector = model.space[at[slice(*np.searchsorted(hit, (lo, hi)))]].sum(axis=0)
        alike = vector @ model.vectors[p] / max(1e-9, float(np.linalg.norm(vector)) * float(np.sqrt(model.energy[p])))
        answer = passage.words[passage.answer :]
        yield row, p, lo - int(bounds[row]), float(alike), lcs, common_subsequence(answer, text) / len(answer)
    edge = np.concatenate([[0], np.flatnonzero(np.diff(block)) + 1])
    sums = np.add.reduceat(model.space[at], edge, axis=0)
    ids = block[edge]
    # a window is a block and the next one of the same row; the last block of a row stands alone as well
    both = sums.copy()
    follows = np.flatnonzero((np.diff(ids) == 1) & (np.diff(rows[hit[edge]]) == 0))
    both[follows] += sums[follows + 1]
    norm = np.sqrt((both**2).sum(axis=1))
    size = np.sqrt(np.maximum(model.energy, 1e-12))
    for a in range(0, len(both), 4096):
        dots = both[a : a + 4096] @ model.vectors.T
        good = (dots >= cosine * norm[a : a + 4096, None] * size[None, :]) & (dots >= share * model.energy[None, :]) & (model.energy > 0)[None, :]
        for w, p in zip(*np.nonzero(good)):
            row = int(rows[hit[edge[a + w]]])
            begin = int(bounds[row] + (ids[a + w] - base[row]) * STRIDE)
            lo, hi = max(int(bounds[row]), begin - STRIDE // 2), min(int(bounds[row + 1]), begin + WINDOW + STRIDE // 2)
            passage = model.passages[p]
            text = names[lo:hi]
            lcs = common_subsequence(passage.words, text) / len(passage.words)
            if lcs < least:
                continue
            answer = passage.words[passage.answer :]
            yield row, int(p), lo - int(bounds[row]), float(dots[w, p] / max(1e-9, norm[a + w] * size[p])), lcs, common_subsequence(answer, text) / len(answer)


def _hits(batches: Iterator[pa.RecordBatch], model: LatentItems, cosine: float, share: float, least: float, present: float, answer: float):
    for batch in slices(batches, size=_SLICE):
        hits = [h for h in search(batch.column(1), model, cosine, share, least, present) if h[5] >= answer]
        ids = batch.column(0)
        cols = [
            pa.array([ids[h[0]].as_py() for h in hits], pa.int64()),
            pa.array([model.passages[h[1]].item_id for h in hits], pa.int64()),
            pa.array([h[2] for h in hits], pa.int64()),
            *(pa.array([h[k] for h in hits], pa.float64()) for k in (3, 4, 5)),
        ]
        yield pa.RecordBatch.from_arrays(cols, names=[x.split()[0] for x in HITS.split(", ")])


def find_leaks(
    docs: DataFrame, items: DataFrame, width: int = 128, cosine: float = 0.35, share: float = 0.3, least: float = 0.6,
    answer: float = 0.5, common: float = 0.1, items_per_pass: int = 2000, present: float = 0.6,
) -> DataFrame:
    """(doc_id, item_id, first_word, cosine, lcs, answer): the best match of every item found in a document.

    ``docs``: doc_id, text; ``items``: item_id, text. Whole texts are searched, words are lower-cased runs of letters
    and digits. A passage is compared where ``present`` of the weight of its words stands within three blocks of words,
    or where the cosine and its ``share`` are large. It matches when its common subsequence with the text around the window has at least ``least`` of
    its words and the answer at least ``answer`` of its own. Null and empty texts match nothing, on either side; null
    ids pass through; rows that repeat an id are one document. Of equally long matches the first place counts. Empty
    tables give no rows; other columns are not read. Items are searched in blocks of ``items_per_pass``, which bounds
    what is sent to a task.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found, block = [], []

    def searched(block: list[Passage]) -> DataFrame:
        sent = spark.sparkContext.broadcast(latent_items(rows, block, width, common))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            yield from _hits(batches, sent.value, cosine, share, least, present, answer)

        return stored(rows.mapInArrow(run, HITS), "leaks")

    for item in items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).toLocalIterator():
        block += passages_of(item["item_id"], item["text"])
        if len(block) >= items_per_pass:
            found.append(searched(block))
            block = []
    if block:
        found.append(searched(block))
    if not found:
        return spark.createDataFrame([], HITS)
    whole = found[0]
    for more in found[1:]:
        whole = whole.union(more)
    best = F.max_by(F.struct("first_word", "cosine", "lcs", "answer"), F.struct("lcs", "answer", -F.col("first_word")))
    return whole.groupBy("doc_id", "item_id").agg(best.alias("m")).select("doc_id", "item_id", "m.*")


def without_leaks(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` in which no item is found."""
    return docs.join(find_leaks(docs, items, **options).select("doc_id").distinct(), "doc_id", "left_anti")
