"""Exact and near deduplication against brute force."""

import hashlib
import random
import re

import numpy as np
import pandas as pd
import pytest

from hearthside.llm import minhash
from hearthside.llm.components import components
from hearthside.llm.exact_dedup import exact_groups, merged
from hearthside.llm.minhash import near_groups

SPACE = re.compile(r"[\x20\x09-\x0D]+")


def test_exact(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice(["a b", "a  b", "a\tb", "", None, " ", "long " * 3000, f"own {i}"])) for i in range(80)]
    rows += [(3, rows[3][1]), (None, "a b"), (None, "alone"), (None, "alone")]
    docs = spark.createDataFrame([(d, t, "x", 5) for d, t in rows], "doc_id long, text string, digest string, block int").repartition(7)
    groups = {}
    for d, t in rows:
        groups.setdefault(SPACE.sub(" ", t or ""), []).append(d)
    want = []
    for d, t in rows:
        norm = SPACE.sub(" ", t or "")
        ids = [x for x in groups[norm] if x is not None]
        keep = min(ids) if ids else None
        want.append((d, keep, len(groups[norm]), d == keep, hashlib.sha256(norm.encode()).hexdigest()))
    for fan_in in (2, 8):
        assert sorted(map(tuple, exact_groups(docs, fan_in=fan_in).collect()), key=str) == sorted(want, key=str)


def test_merge_keeps_texts_apart_whose_checks_differ():
    run = pd.DataFrame({"slice": 0, "node": [0, 0, 1], "digest": ["d"] * 3, "check": [1, 2, 1], "keep": [5, 1, 3], "size": [1, 1, 4]})
    assert merged(run, 0)[["check", "keep", "size"]].values.tolist() == [[1, 3, 5], [2, 1, 1]]


def shingles(text, size):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = [x for x in SPACE.split(lower) if x]
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1)))


def brute(rows, size, percent):
    sets = {d: shingles(t, size) for d, t in rows}
    ids = sorted(sets)
    parent = {d: d for d in ids}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = sorted((top(a), top(b)))
                parent[q] = p
    return [(d, len(sets[d]), top(d), top(d) == d) for d in ids]


def near_rows(seed=2):
    rng = random.Random(seed)
    word = lambda: "w" + str(rng.randint(0, 400))
    rows = []
    for _ in range(6):
        base = [word() for _ in range(rng.choice([3, 40, 120]))]
        rows.append(list(base))
        for _ in range(18):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 12))):
                copy[rng.randrange(len(copy))] = word()
            rows.append(copy)
        chain = list(base)  # each like the one before, the ends unlike
        for k in range(8):
            for _ in range(max(1, len(chain) // 25)):
                chain[rng.randrange(len(chain))] = word()
            rows.append(list(chain))
    rng.shuffle(rows)
    out = [(i + 10, " ".join(r).upper() if i % 2 else "  ".join(r)) for i, r in enumerate(rows)]
    return out + [(1, None), (2, ""), (3, " \n"), (4, "one"), (5, "ONE"), (6, "two")]


@pytest.mark.parametrize("size,tile", [(2, 512), (5, 512), (2, 4)])
def test_near(spark, monkeypatch, size, tile):
    monkeypatch.setattr(minhash, "TILE", tile)
    monkeypatch.setattr(minhash, "TILE_BYTES", tile * 1000)
    rows = near_rows()
    docs = spark.createDataFrame([(d, t, "clash") for d, t in rows], "doc_id long, text string, signature string").repartition(3)
    assert sorted(map(tuple, near_groups(docs, size, 80).collect())) == brute(rows, size, 80)


def test_near_without_ids_and_rows(spark):
    rows = [(None, "a b c"), (None, "a b c"), (7, "a b c"), (7, "a b c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, near_groups(docs, 2).collect()), key=str)
    assert got == sorted([(None, 2, None, True)] * 2 + [(7, 2, 7, True)] * 2, key=str)
    assert near_groups(docs.limit(0)).collect() == []
    assert exact_groups(docs.limit(0)).collect() == []


def test_components_of_a_long_chain(spark):
    n = 200
    links = spark.createDataFrame([(i + 1, i) for i in range(n)] + [(1000, 1001)], "a long, b long")
    got = {r["node"]: r["component"] for r in components(links).collect()}
    assert got == {i: 0 for i in range(n + 1)} | {1000: 1000, 1001: 1000}


def test_estimate_is_corrected_for_chance():
    rng = np.random.default_rng(0)
    x, y = rng.integers(0, 256, (2, 20_000)).astype(np.uint8)
    assert abs(minhash.estimate(x, y)) < 0.01 and minhash.estimate(x, x) == 1



def test_disjoint_sets_of_look_alike_words_are_not_linked(spark):
    word = "a"
    while len(word) < 2048:
        word += word.translate({97: 98, 98: 97})
    other = word.translate({97: 98, 98: 97})
    docs = spark.createDataFrame([(1, f"{word} {word} {word}"), (2, f"{other} {other} {other}")], "doc_id long, text string")
    assert sorted(map(tuple, near_groups(docs, 2).collect())) == [(1, 1, 1, True), (2, 1, 2, True)]
