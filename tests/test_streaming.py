import json

import numpy as np
import pytest

from hearthside.streaming import ingest as module
from hearthside.streaming import key_ledger
from hearthside.streaming.ingest import ingest, read_version, stream_records

SCHEMA = "url string, seq int, v int"


def put(folder, name, rows):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(dict(zip(("url", "seq", "v"), r))) for r in rows) + "\nbroken\n\n")


def run(spark, base, snapshot=None):
    stream = stream_records(spark, str(base / "in"), SCHEMA, files_per_batch=1)
    ingest(
        stream, key="url", order=["seq"], out=str(base / "out"), ledger=str(base / "ledger"), checkpoint=str(base / "cp"), snapshot=snapshot
    ).awaitTermination()


def kept(spark, base):
    return sorted((r["url"], r["seq"], r["v"]) for r in spark.read.parquet(str(base / "out")).select("url", "seq", "v").collect())


def test_first_record_wins_and_restart_continues(spark, tmp_path):
    put(tmp_path / "in", "a.json", [("u1", 2, 20), ("u1", 1, 10), ("", 3, 3), ("u2", 4, 40)])
    run(spark, tmp_path)
    assert kept(spark, tmp_path) == [("u1", 1, 10), ("u2", 4, 40)]
    put(tmp_path / "in", "b.json", [("u2", 5, 50), ("u3", 6, 60)])
    run(spark, tmp_path)
    run(spark, tmp_path)
    assert kept(spark, tmp_path) == [("u1", 1, 10), ("u2", 4, 40), ("u3", 6, 60)]


def test_failed_batch_is_replayed_without_loss_or_doubles(spark, tmp_path, monkeypatch):
    put(tmp_path / "in", "a.json", [("u1", 1, 1)])
    run(spark, tmp_path)
    put(tmp_path / "in", "b.json", [("u1", 2, 2), ("u2", 3, 3)])
    real = module._add_batch

    def crash_after_writing(rows, batch, **settings):
        real(rows, batch, **settings)
        raise RuntimeError("lost driver")

    monkeypatch.setattr(module, "_add_batch", crash_after_writing)
    with pytest.raises(Exception, match="lost driver"):
        run(spark, tmp_path)
    monkeypatch.setattr(module, "_add_batch", real)
    run(spark, tmp_path)
    assert kept(spark, tmp_path) == [("u1", 1, 1), ("u2", 3, 3)]


def test_snapshots_every_second_batch(spark, tmp_path):
    for i in range(4):
        put(tmp_path / "in", f"{i}.json", [(f"u{i}", i, i)])
    sizes = []
    run(spark, tmp_path, snapshot=(2, lambda df: sizes.append(df.count())))
    assert sizes == [2, 4]


def test_versions_read_back_every_batch(spark, tmp_path):
    for i in range(4):
        put(tmp_path / "in", f"{i}.json", [(f"u{k}", k, k) for k in range(i + 2)])
        run(spark, tmp_path)
    schema = spark.read.parquet(str(tmp_path / "out")).drop("batch").schema
    for v in range(4):
        got = read_version(spark, str(tmp_path / "out"), schema, v).collect()
        assert sorted(r["url"] for r in got) == [f"u{k}" for k in range(v + 2)]
    assert read_version(spark, str(tmp_path / "out"), schema).count() == 5
    # no data row is written twice: the batches together hold every row once
    assert spark.read.parquet(str(tmp_path / "out")).count() == 5


def test_filters_never_miss_and_fold():
    rng = np.random.default_rng(3)
    parts = [rng.integers(0, 2**63, n).astype(np.uint64) for n in (0, 1, 900, 5000)]
    other = rng.integers(0, 2**63, 20_000).astype(np.uint64)
    for h in parts:
        bits = key_ledger.bloom(h)
        assert key_ledger.maybe(h, bits).all()
        assert key_ledger.maybe(other, bits).mean() < 0.03
    both = key_ledger.merged([key_ledger.bloom(parts[2]), key_ledger.bloom(parts[3])])
    assert key_ledger.maybe(parts[2], both).all() and key_ledger.maybe(parts[3], both).all()


def test_a_batch_reads_only_its_buckets(spark, tmp_path):
    ledger = key_ledger.KeyLedger(spark, str(tmp_path / "ledger"), buckets=16)
    keys = lambda a, b: spark.createDataFrame([(f"k{i}",) for i in range(a, b)], "url string")
    ledger.add(keys(0, 400), "url", 0)
    ledger.add(keys(400, 800), "url", 1)
    assert ledger.suspects(keys(100, 101), "url") and len(ledger.suspects(keys(100, 101), "url")) == 1
    ((run_name, bucket),) = ledger.suspects(keys(100, 101), "url")
    files = ledger._read([(run_name, bucket)]).inputFiles()
    assert run_name == "batch-0" and files and all(f"bucket={bucket}/" in f and "batch-0" in f for f in files)
    assert len(ledger.suspects(keys(5000, 5003), "url")) <= 1  # new keys open almost nothing
    assert ledger.unseen(keys(790, 805), "url").count() == 5
    assert ledger.unseen(keys(0, 410), "url", before=1).count() == 10


def test_runs_stay_few_and_repeats_replace(spark, tmp_path):
    ledger = key_ledger.KeyLedger(spark, str(tmp_path / "ledger"), buckets=2, fan=3)
    for batch in range(14):
        rows = spark.createDataFrame([(f"{batch}-{i}",) for i in range(3)] + [(None,)], "url string")
        for _ in range(2 if batch % 5 == 0 else 1):  # some batches run twice
            ledger.add(ledger.unseen(rows, "url", batch), "url", batch)
        assert len(ledger.runs()) <= 2 * 3
    assert sorted(r["key"] for r in ledger.keys().collect()) == sorted(f"{b}-{i}" for b in range(14) for i in range(3))
    assert ledger.unseen(spark.createDataFrame([(None,), ("3-1",), ("x",)], "url string"), "url").count() == 2
