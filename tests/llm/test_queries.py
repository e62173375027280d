"""The registered queries themselves, over the whole smallest tables."""

import re
import zlib

import numpy as np
from tokenizers import Tokenizer

from hearthside.llm import queries
from hearthside.llm.registry import table


def test_op6_on_held_out_rows(spark, sf_dir):
    rows = queries.op6_toxicity(spark, sf_dir).collect()
    docs = {r["doc_id"] for r in table(spark, sf_dir, "documents").collect()}
    labels = {r["doc_id"]: r["toxic"] for r in table(spark, sf_dir, "labels").collect()}
    assert {r["doc_id"] for r in rows} == docs and len(rows) == len(docs)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1 for r in rows)
    assert all(r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    learned = [r["predicted"] == labels[r["doc_id"]] for r in rows if r["doc_id"] in labels and not r["held_out"]]
    assert np.mean(learned) > 0.9


def test_op7_leaves_no_plain_value(spark, sf_dir):
    before = {r["doc_id"]: r["text"] for r in table(spark, sf_dir, "documents").collect()}
    after = {r["doc_id"]: r for r in queries.op7_pseudonyms(spark, sf_dir).collect()}
    assert before.keys() == after.keys()
    plain = [r"[A-Za-z0-9._%+-]+@(?=[A-Za-z0-9-]+\.[A-Za-z]{2})", r"\(\d{3}\) \d{3}-\d{4}", r"(?:AKIA|ASIA)[A-Z0-9]{16}", r"password=\w{6,}"]
    found = 0
    for doc_id, text in before.items():
        for p in plain:
            for value in set(re.findall(p, text or "")):
                found += 1
                assert value not in after[doc_id]["text"] or after[doc_id]["text"].count(value) < text.count(value), value
        if not after[doc_id]["replaced"]:
            assert after[doc_id]["text"] == text
    assert found > 5


def test_op8_rules_and_the_graph(spark, sf_dir):
    rows = queries.op8_url_filter(spark, sf_dir).collect()
    assert len(rows) == table(spark, sf_dir, "pages").count()
    assert all(r["verdict"] == queries.RULES[r["rule"]] for r in rows if r["rule"])
    assert {r["verdict"] for r in rows} <= {"allow", "block"}


def test_op10_against_the_tokenizer(spark, sf_dir):
    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    texts = {r["doc_id"]: r["text"] or "" for r in table(spark, sf_dir, "documents").collect()}
    ids = {d: [*tokenizer.encode(t, add_special_tokens=False).ids, 1] for d, t in texts.items()}
    pieces = queries.op10_packing(spark, sf_dir).collect()
    sequences = {}
    for p in pieces:
        own = ids[p["doc_id"]]
        piece = own[p["start"] : p["start"] + p["length"]]
        assert p["doc_tokens"] == len(own) and p["ids_crc32"] == zlib.crc32(np.array(piece, "<u4").tobytes())
        sequences.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    assert sum(p["length"] for p in pieces) == sum(map(len, ids.values()))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048


def test_op2_finds_verbatim_items(spark, sf_dir):
    items = {r["item_id"]: r["text"] for r in table(spark, sf_dir, "benchmark").collect()}
    docs = {r["doc_id"]: r["text"] or "" for r in table(spark, sf_dir, "documents").collect()}
    found = {(r["doc_id"], r["item_id"]) for r in queries.op2_decontaminate(spark, sf_dir).collect()}
    verbatim = {(d, i) for i, t in items.items() if len(t.split()) >= 8 for d, text in docs.items() if t in text}
    assert verbatim <= found
