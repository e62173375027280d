"""Resampling, fuzzy fingerprints and the Merkle manifest against brute force."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from hearthside.llm import merkle, resampling, selection_queries, simhash
from hearthside.llm.registry import table

LOWER = {c: c + 32 for c in range(65, 91)}
ODD = [(None, None), (None, "a b c d"), (900, None), (901, ""), (902, " \t\n"), (903, "One"), (903, "One"), (904, "ONE two"), (905, "é" * 300 + " x"),
       (906, "word " * 3000), (907, "x" * 5000), (908, "a-b_c.d"), (-5, "a b c d")]


def texts(n=80, seed=3):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeÉéX9") for _ in range(rng.randint(1, 9))) for _ in range(60)]
    rows = [(i * 7 % 101, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 90)))) for i in range(n)]
    for i in range(n // 2):  # near copies: one word changed
        words = rng.choice(rows)[1].split(" ")
        words[rng.randrange(len(words))] = rng.choice(vocabulary)
        rows.append((200 + i, rng.choice([" ", "  "]).join(words)))
    return rows + ODD


def frame(spark, rows):
    kinds = "doc_id long, text string, id string, fp string, tree int"
    return spark.createDataFrame([(d, t, "clash", "clash", 1) for d, t in rows], kinds).repartition(5)


def by_text(rows):
    return sorted(map(tuple, rows), key=str)


# SimHash


def plain_print(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").translate(LOWER)) if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    left, out = set(prints), {}
    while left:
        group, todo = set(), [left.pop()]
        while todo:
            x = todo.pop()
            group.add(x)
            near = {y for y in left if (x ^ y).bit_count() <= 3}
            left -= near
            todo += near
        out |= {x: min(group) for x in group}
    return out


def test_fuzzy_groups(spark):
    rows = texts()
    place = lambda d: math.inf if d is None else d
    prints = [plain_print(t) for _, t in rows]
    component = plain_components(prints)
    least = {}
    for (d, _), p in zip(rows, prints):
        least[component[p]] = min(least.get(component[p], math.inf), place(d))
    want = []
    for (d, _), p in zip(rows, prints):
        low = least[component[p]]
        want.append((d, f"{p:016x}", None if low == math.inf else low, place(d) == low))
    assert by_text(simhash.fuzzy_groups(frame(spark, rows)).collect()) == by_text(want)
    assert len(set(component.values())) < len(component)  # links between different fingerprints exist


@pytest.mark.parametrize("hot, tile", [(simhash._HOT, simhash._TILE), (3, 2)])
def test_every_link_is_found(spark, hot, tile):
    rng = random.Random(hot)
    prints = {rng.getrandbits(64) for _ in range(60)}
    for p in list(prints):
        for _ in range(rng.randint(0, 12)):  # chains of one to four changed bits
            for b in rng.sample(range(64), rng.randint(1, 4)):
                p ^= 1 << b
            prints.add(p)
    signed = [p - (1 << 64) if p >> 63 else p for p in sorted(prints)]
    found = simhash.links(spark.createDataFrame([(p,) for p in signed], "fp long").repartition(3), hot, tile).collect()
    joined = {}
    for a, b in found:
        joined.setdefault(a, set()).add(b)
        joined.setdefault(b, set()).add(a)
    want, seen = plain_components(prints), {}
    for p in signed:
        reach, todo = set(), [p]
        while todo:
            x = todo.pop()
            if x not in reach:
                reach.add(x)
                todo += joined.get(x, ())
        seen[p % 2**64] = min(x % 2**64 for x in reach)
    assert seen == want


def test_nearby_codewords_hold_the_code_of_every_neighbour():
    word = np.random.default_rng(1).integers(0, 1 << 23, 4000)
    place, code = simhash.nearby(word)
    have = set(zip(place.tolist(), code.tolist()))
    assert set(np.bincount(place).tolist()) <= {1, 6}
    for bit in range(23):
        assert set(zip(range(4000), simhash.decode(word ^ (1 << bit)).tolist())) <= have


def test_three_changed_bits_always_share_a_key():
    rng = np.random.default_rng(2)
    prints = rng.integers(0, 2**63, 500).astype(np.uint64) * np.uint64(2) + rng.integers(0, 2, 500).astype(np.uint64)
    other = prints.copy()
    for _ in range(3):
        other ^= np.uint64(1) << rng.integers(0, 64, 500).astype(np.uint64)
    (key, at), (key2, at2) = simhash.keys(prints), simhash.keys(other)
    own = {(a, k >> 1) for k, a in zip(key.tolist(), at.tolist()) if not k & 1}
    met = {a for k, a in zip(key2.tolist(), at2.tolist()) if k & 1 and (a, k >> 1) in own}
    assert met == set(range(500))


def test_query_equals_brute_force_prints(spark, sf_dir):
    rows = {r["doc_id"]: r["text"] for r in table(spark, sf_dir, "documents").collect()}
    got = selection_queries.op12_simhash(spark, sf_dir).collect()
    prints = {d: plain_print(t) for d, t in rows.items()}
    component = plain_components(prints.values())
    least = {}
    for d, p in prints.items():
        least[component[p]] = min(least.get(component[p], d), d)
    assert {(r["doc_id"], r["fingerprint"], r["component_id"]) for r in got} == {(d, f"{p:016x}", least[component[p]]) for d, p in prints.items()}


# resampling


def plain_features(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    return words, [" ".join(words[i : i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1)]


def plain_sample(rows, target, percent=5):
    bucket = lambda f: zlib.crc32(f.encode()) % 10000
    source, wanted = [0] * 10000, [0] * 10000
    for counts, some in ((source, [t for _, t in rows]), (wanted, target)):
        for t in some:
            for f in plain_features(t)[1]:
                counts[bucket(f)] += 1
    n_source, n_wanted = sum(source), sum(wanted)
    out = []
    for i, (d, t) in enumerate(rows):
        words, features = plain_features(t)
        weight = sum(
            math.floor(1000 * math.log((wanted[b] + 1) * (n_source + 10000) / ((source[b] + 1) * (n_wanted + 10000)))) for b in map(bucket, features)
        )
        h = int(hashlib.sha256(f"42:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        out.append([d, len(words), len(features), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None])
    able = sorted((r for r in out if r[1] >= 20), key=lambda r: (-r[4], math.inf if r[0] is None else r[0]))
    for rank, r in enumerate(able[: len(able) * percent // 100], 1):
        r[5] = rank
    return out


@pytest.mark.parametrize("percent", [5, 40, 100])
def test_resample(spark, percent):
    rows, target = texts(), ["a b c", None, "", "éX 9 a"] + [t for _, t in texts(10, 9)]
    docs = frame(spark, rows)
    got = resampling.resample(docs, spark.createDataFrame([(t,) for t in target], "text string"), percent).collect()
    assert by_text(got) == by_text(plain_sample(rows, target, percent))


def test_resample_without_target_or_rows(spark):
    rows = texts(12)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert by_text(resampling.resample(frame(spark, rows), empty, 50).collect()) == by_text(plain_sample(rows, [], 50))
    assert resampling.resample(empty, frame(spark, rows)).collect() == []


def test_repeated_ids_and_texts_draw_the_exact_number(spark):
    rows = [(1, "same words " * 20)] * 30 + [(None, "other words " * 20)] * 30
    got = resampling.resample(frame(spark, rows), frame(spark, rows), 50).collect()
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, 31)) and len(got) == 60


def test_kth_key(spark):
    rng = random.Random(8)
    rows = [(rng.randint(0, 5), rng.randint(0, 20), i) for i in range(300)]
    frame = spark.createDataFrame(rows, "a long, b long, c long").repartition(4)
    for k in (1, 2, 150, 299, 300):
        assert resampling.kth_key(frame, ["a", "b", "c"], k, pivots=5) == sorted(rows)[k - 1]
    assert resampling.kth_key(frame, ["a", "b", "c"], 0) is None and resampling.kth_key(frame, ["a", "b", "c"], 301) is None


def test_codes_of_long_words():
    words = ["x" * n for n in (1, 63, 64, 65, 1000)] + ["é" * 40, "z"]
    text = " ".join(words)
    _, runs = resampling.features(pa.array([text]))
    for k, (code, _) in enumerate(runs):
        assert code.tolist() == [zlib.crc32(" ".join(words[i : i + k + 1]).encode()) for i in range(len(words) - k)]


# manifest


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_tree(leaves, fanout):
    """Root, and the path of every leaf: per level what stands left and right of it."""
    level, at, paths = list(leaves), list(range(len(leaves))), [[] for _ in leaves]
    while len(level) > 1:
        for p, i in zip(paths, at):
            first = i // fanout * fanout
            p.append(("".join(level[first:i]), "".join(level[i + 1 : first + fanout])))
        level = [sha("".join(level[i : i + fanout])) for i in range(0, len(level), fanout)]
        at = [i // fanout for i in at]
    return level[0], paths


def plain_leaf(row):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def plain_manifest(rows, fanout):
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append((math.inf if row[0] is None else row[0], plain_leaf(row), row[0]))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: plain_tree([x[1] for x in sorted(groups[g], key=lambda x: x[:2])], fanout) for g in order}
    root, above = plain_tree([trees[g][0] for g in order], fanout)
    out = []
    for g, up in zip(order, above):
        for (_, leaf, doc_id), path in zip(sorted(groups[g], key=lambda x: x[:2]), trees[g][1]):
            out.append((doc_id, leaf, trees[g][0], root, path + up))
    return out


def manifest_rows(n=150):
    rng = random.Random(n)
    rows = [
        (i * 7 % 997, rng.choice(["web", None, ""]), rng.choice(["en", "en", "de", "é", None, "", "Z"]), rng.choice([None, i]), rng.choice([None, "", "té" * i]))
        for i in range(n)
    ]
    return rows + [(5000, "s", "lone", 1, "x"), (None, "s", "en", 1, "x"), (None, "s", "en", 2, "x"), (3, "a", "en", 1, "x"), (3, "a", "en", 1, "x")]


@pytest.mark.parametrize("fanout", [2, 3])
def test_manifest(spark, fanout):
    rows = manifest_rows()
    docs = spark.createDataFrame([(*r, "clash", 0) for r in rows], "doc_id long, source string, lang string, n_chars long, text string, hash string, idx int")
    got = merkle.manifest(docs.repartition(4), fanout=fanout).collect()
    plain = lambda r: (*r[:4], [tuple(x) for x in r[4]])
    assert by_text(plain(r) for r in got) == by_text(plain_manifest(rows, fanout))


@pytest.mark.parametrize("n", [0, 1, 2, 16, 17])
def test_small_manifests(spark, n):
    rows = [(i, "s", "en", i, f"text {i}") for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    got = merkle.manifest(docs, carry={"twice": F.col("n_chars") * 2})
    checked = got.withColumn("folded", merkle.folded(F.col("leaf"), F.col("path"))).collect()
    assert len(checked) == n and all(r["folded"] == r["root"] and r["twice"] == 2 * r["doc_id"] for r in checked)
    if n:
        assert {r["root"] for r in checked} == {plain_tree([plain_leaf(r) for r in rows], 2)[0]}


def test_a_changed_field_does_not_fold_to_the_root(spark):
    docs = spark.createDataFrame(manifest_rows(40), "doc_id long, source string, lang string, n_chars long, text string")
    changed = merkle.leaf([F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars") + 1, F.col("text")])
    rows = merkle.manifest(docs, carry={"changed": changed}).withColumn("to", merkle.folded(F.col("changed"), F.col("path"))).collect()
    assert all((r["to"] == r["root"]) == (r["changed"] == r["leaf"]) for r in rows) and any(r["to"] == r["root"] for r in rows)
