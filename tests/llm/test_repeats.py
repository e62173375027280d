"""Byte and word repeats against brute force."""

import hashlib
import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from hearthside.llm import exchange, recompression, suffix_dedup
from hearthside.llm.common import word_names

ODD = [(None, "x" * 60), (900, None), (901, ""), (902, "ab" * 200), (903, "x" + "ab" * 100), (904, "a" * 500), (905, "a" * 49), (906, "a" * 50),
       (906, "a" * 50), (907, "w " * 40), (908, "w " * 13 + "v"), (909, "\x0b w\t\n" * 30), (910, "é" * 40), (911, "x" + "é" * 40), (912, "p q " * 30), (913, "q p " * 30)]


def texts(seed=5, n=60):
    rng = random.Random(seed)
    syllables = ["an", "to", "re", "ing", "ou", "ly", "é"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 3)))
    shared = [" ".join(word() for _ in range(rng.randint(8, 40))) for _ in range(6)]
    rows = []
    for i in range(n):
        parts = [" ".join(word() for _ in range(rng.randint(0, 30))) for _ in range(3)]
        parts.insert(rng.randint(0, 3), rng.choice(shared))
        if rng.random() < 0.3:
            parts.append(rng.choice([r[1] for r in rows] or ["x"]))
        if rng.random() < 0.2:
            parts.append("na " * rng.randint(5, 40))
        rows.append((i * 3 % 97, rng.choice([" ", "\n", "  "]).join(parts)))
    return rows + ODD


def place(doc_id):
    return 2**63 if doc_id is None else doc_id


def brute(rows, split, size):
    units = [(place(d), split(t or "")) for d, t in rows]
    first = {}
    for d, u in units:
        for i in range(len(u) - size + 1):
            key = tuple(u[i : i + size])
            first[key] = min(first.get(key, d), d)
    out = []
    for d, u in units:
        gone = [False] * len(u)
        for i in range(len(u) - size + 1):
            if first[tuple(u[i : i + size])] < d:
                gone[i : i + size] = [True] * size
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((None if d == 2**63 else d, len(u), sum(gone), spans, [x for x, g in zip(u, gone) if not g]))
    return out


@pytest.mark.parametrize("many", [50_000, 3])
def test_bytes(spark, many):
    rows = texts()
    want = sorted(
        ((d, n, g, s, hashlib.sha256(bytes(k)).hexdigest()) for d, n, g, s, k in brute(rows, lambda t: list(t.encode()), 50)), key=str
    )
    docs = spark.createDataFrame([(d, t, "clash", 1) for d, t in rows], "doc_id long, text string, block string, id int").repartition(4)
    got = suffix_dedup.digests(suffix_dedup.remove_repeats(docs, many=many, blocks=5)).collect()
    assert sorted(map(tuple, got), key=str) == want


def test_words(spark):
    rows = texts(6)
    split = lambda t: [w for w in re.split(r"[\x20\x09-\x0D]+", t) if w]
    want = sorted(
        ((d, n, g, hashlib.sha256(" ".join(k).encode()).hexdigest()) for d, n, g, _, k in brute(rows, split, 13)), key=str
    )
    docs = spark.createDataFrame([(d, t, "clash") for d, t in rows], "doc_id long, text string, names string").repartition(4)
    got = recompression.digests(recompression.remove_repeats(docs, blocks=5)).collect()
    assert sorted(map(tuple, got), key=str) == want


@pytest.mark.parametrize("operator", [suffix_dedup, recompression])
def test_empty_table(spark, operator):
    assert operator.digests(operator.remove_repeats(spark.createDataFrame([], "doc_id long, text string"))).collect() == []


def test_spans_and_kept_rebuild_the_text(spark):
    docs = spark.createDataFrame([(1, "a" * 30 + "b" * 30), (2, "zz" + "a" * 30 + "b" * 30 + "yy")], "doc_id long, text string")
    row = suffix_dedup.remove_repeats(docs).where("doc_id = 2").first()
    assert [tuple(s) for s in row["spans"]] == [(2, 60)] and bytes(row["kept"]) == b"zzyy"


@pytest.mark.parametrize("length", [5, 12, 50])
def test_refined_buckets_are_equal_substrings(length):
    text = np.random.default_rng(length).integers(0, 2, 300).astype(np.uint8)
    pointer = suffix_dedup.refine(text, length)
    padded = text.tobytes() + bytes(length)
    keys = [padded[i : i + length] for i in range(300)]
    groups = {}
    for k, p in zip(keys, pointer.tolist()):
        assert groups.setdefault(k, p) == p
    assert len(set(groups.values())) == len(groups)


def test_equal_word_sequences_get_equal_inner_symbols():
    rng = np.random.default_rng(3)
    core = rng.integers(0, 3, 400)
    found = [[] for _ in range(4)]
    for _ in range(20):
        left, right = (rng.integers(0, 3, rng.integers(0, 9)) for _ in range(2))
        names = np.concatenate([left, core, right]).astype(np.uint64)
        for level, (name, lo, hi) in enumerate(recompression.symbols(names, np.zeros(len(names), np.int64), 4)):
            assert (np.diff(lo) >= 0).all() and (np.diff(hi) >= 0).all()
            inside = (lo >= len(left)) & (hi < len(left) + len(core))
            found[level].append(set(zip(name[inside].tolist(), (lo[inside] - len(left)).tolist(), (hi[inside] - len(left)).tolist())))
    for level in found:
        shared = set.intersection(*level)
        assert all(f == shared for f in level) and shared


def thue_morse(n):
    word = "a"
    while len(word) < n:
        word += word.translate({97: 98, 98: 97})
    return word


@pytest.mark.parametrize("n", [8, 64, 1024, 2048, 8192])
@pytest.mark.parametrize("family", [0, 1])
def test_thue_morse_words_have_different_names(n, family):
    word = thue_morse(n)
    pair = [word.encode(), word.translate({97: 98, 98: 97}).encode()]
    buf, size = np.frombuffer(b"".join(pair), np.uint8), len(word)
    names = word_names(buf, np.array([0, size]), np.array([size, 2 * size]), family=family)
    assert names[0] != names[1]


def test_thue_morse_windows_are_kept(spark):
    word = thue_morse(1024)
    other = word.translate({97: 98, 98: 97})
    docs = spark.createDataFrame([(1, " ".join([word] * 13)), (2, " ".join([other] * 13)), (3, f"x {word}"), (4, f"x {other}")], "doc_id long, text string")
    assert [r["n_removed"] for r in recompression.digests(recompression.remove_repeats(docs)).collect()] == [0] * 4
    got = {r["doc_id"]: r["n_removed"] for r in suffix_dedup.digests(suffix_dedup.remove_repeats(docs)).collect()}
    want = {d: g for d, _, g, _, _ in brute([(r[0], r[1]) for r in docs.collect()], lambda t: list(t.encode()), 50)}
    assert got == want


def test_names_with_one_first_half_stay_apart():
    names, checks = np.array([5, 5, 5, 9], np.uint64), np.array([1, 2, 1, 1], np.uint64)
    first, number = exchange.lowest(names, checks, np.array([7, 1, 3, 2]))
    assert first.tolist() == [2, 1, 3] and number.tolist() == [0, 1, 0, 2]
    hit, at = exchange.found_pairs(names, checks, np.array([9, 5, 5], np.uint64), np.array([2, 2, 3], np.uint64))
    assert hit.tolist() == [False, True, False, False] and at[1] == 1


def test_rows_without_id_and_of_one_id_are_spread(spark):
    rows = [(None, f"text {i} " * 9) for i in range(400)] + [(7, f"word {i} " * 9) for i in range(400)]
    blocks = exchange.blocked(spark.createDataFrame(rows, "doc_id long, text string"), 8).groupBy("block").count().collect()
    assert len(blocks) == 8 and max(r["count"] for r in blocks) < 200


def test_the_largest_long_is_an_id(spark):
    largest = 2**63 - 1
    rows = [(1, "a" * 60), (largest, "a" * 60), (largest, "b" * 70), (None, "c" * 20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r["doc_id"], r["n_bytes"], r["n_removed"]) for r in suffix_dedup.digests(suffix_dedup.remove_repeats(docs, blocks=3)).collect()]
    assert sorted(got, key=str) == sorted([(1, 60, 0), (largest, 60, 60), (largest, 70, 0), (None, 20, 0)], key=str)


def test_bytes_taken_by_a_block_and_a_bucket():
    """Covering a block and sorting a bucket take a bounded number of bytes a byte of text."""
    rng = np.random.default_rng(3)
    texts = ["".join(map(chr, row)) for row in rng.integers(97, 101, (400, 10_000))]
    docs = pa.table({"id": pa.array(range(400)), "text": pa.array(texts), "missing": pa.array([False] * 400)})
    n = sum(map(len, texts))
    block, covered = suffix_dedup.Bytes(*suffix_dedup.text_bytes(docs["text"]), 50), np.zeros(n, bool)
    covered[5_000:30_000] = covered[39_950:40_000] = True

    def peak(run):
        tracemalloc.start()
        out = run()
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return out, most / n

    found, taken = peak(lambda: suffix_dedup._result(docs["id"], docs["missing"], block, covered))
    assert taken < 12, taken
    assert found["spans"].to_pylist()[:5] == [[{"start": 5000, "length": 5000}], [{"start": 0, "length": 10_000}], [{"start": 0, "length": 10_000}], [{"start": 9950, "length": 50}], []]
    assert [len(k) for k in found["kept"].to_pylist()[:5]] == [5000, 0, 0, 9950, 10_000]
    _, taken = peak(lambda: suffix_dedup.refine(np.tile(block.data[: n // 2], 2), 50))
    assert taken < 60, taken
    reply = pa.table([pa.array([], pa.int32())] * 2 + [pa.array([], pa.binary())] * 3, names=["block", "kind", "names", "checks", "bits"])
    docs = docs.append_column("block", pa.array([0] * 400, pa.int32()))
    _, taken = peak(lambda: suffix_dedup._cover(docs, reply, 50))
    assert taken < 16, taken
