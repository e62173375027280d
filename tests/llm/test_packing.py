"""Packing: exact round trip, limits, padding; token ids against the tokenizer itself."""

import random

import numpy as np
import pytest

from hearthside.llm.packing import Limits, Packer, TextIds, encoded, pack, pack_conversations
from hearthside.llm.queries import tokenizer_path

ODD = [" ", "  ", "\n", "\n\n", "\t", "a", "B", "é", "\xa0", "'s", "7", "!", "\u3000", "日本", "\x1c", "\x85", "<|endoftext|>", "_", "\r\n", "'LL", "end."]


@pytest.fixture(scope="module")
def known():
    return TextIds(tokenizer_path())


def test_ids_are_those_of_the_whole_text(known):
    rng = random.Random(2)
    for _ in range(1500):
        text = "".join(rng.choice(ODD) for _ in range(rng.randint(0, 30)))
        assert encoded(text, known, 1).tolist() == known.bare.tokenizer.encode(text, add_special_tokens=False).ids + [1]
    assert encoded(None, known, 1).tolist() == [1]


def test_pieces_are_dropped_and_the_model_is_shared(known):
    before = encoded("some words here", known, 1).tolist()
    assert len(known.bare) and len(known.spaced)
    known.clear()
    assert not known.bare and not known.spaced and known.bare.merges is known.spaced.merges
    assert encoded("some words here", known, 1).tolist() == before


def test_round_trip(spark, known):
    rows = [(1, None), (2, ""), (3, "some words here. " * 700), (4, "short"), (4, "short"), (None, "no id"), (5, "x")]
    rows += [(100 + i, "word " * (i * 7 % 500)) for i in range(60)]
    docs = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, start int").coalesce(2)
    pieces = pack(docs, tokenizer_path()).collect()
    by_sequence = {}
    for p in pieces:
        by_sequence.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
        assert len(p["ids"]) == 4 * p["length"] > 0
    for spans in by_sequence.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 2048
    assert sum(2048 - sum(n for _, n in s) for s in by_sequence.values()) <= 2 * 2048  # one open sequence per task
    for doc_id, text in rows:
        if doc_id != 4:
            mine = sorted((p for p in pieces if p["doc_id"] == doc_id), key=lambda p: p["start"])
            ids = np.concatenate([np.frombuffer(p["ids"], np.uint32) for p in mine])
            assert ids.tolist() == encoded(text, known, 1).tolist() and {p["doc_tokens"] for p in mine} == {len(ids)}
    assert sorted((p["start"], p["length"]) for p in pieces if p["doc_id"] == 4) == [(0, 2), (0, 2)] or sum(
        p["length"] for p in pieces if p["doc_id"] == 4
    ) == 2 * len(encoded("short", known, 1))
    assert pack(docs.limit(0), tokenizer_path()).collect() == []


def test_every_limit_holds():
    rng = np.random.default_rng(4)
    limits = Limits(tokens=100, segments=5, loss_tokens=40)
    lengths = rng.integers(1, 150, 300)
    loss = [None if i % 3 == 0 else rng.random(n) < 0.3 for i, n in enumerate(lengths)]
    room, at = {}, {}
    for item, start, n, sequence, offset in Packer(limits, 0).place(lengths, loss):
        assert start == at.get(item, 0)
        at[item] = start + n
        used = room.setdefault(sequence, np.zeros(3, int))
        assert used[0] == offset
        used += (n, 1, n if loss[item] is None else loss[item][start : start + n].sum())
    assert at == dict(enumerate(lengths.tolist()))
    assert all((u <= (100, 5, 40)).all() for u in room.values())


def test_conversations_count_loss_tokens(spark, sf_dir):
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").selectExpr("conv_id doc_id", "text", "role = 'assistant' bears_loss")
    rows = pack_conversations(turns, tokenizer_path(), limits=Limits(tokens=512, segments=8, loss_tokens=200)).toPandas()
    sums = rows.groupby("sequence_id").agg(t=("length", "sum"), s=("length", "size"), m=("loss_tokens", "sum"))
    assert (sums.t <= 512).all() and (sums.s <= 8).all() and (sums.m <= 200).all() and sums.m.sum() > 0
