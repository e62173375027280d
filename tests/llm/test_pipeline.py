"""Every stage works on what its predecessor kept, and its decisions take effect."""

import re

import corpus_pipeline
from hearthside.llm.decontaminate import find_leaks
from hearthside.llm.packing import TextIds, encoded
from hearthside.llm.queries import tokenizer_path
from tests.llm.test_dedup import brute


def test_stages(spark, sf_dir):
    before = docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, sf_dir)
        assert after.columns == docs.columns
        kept[name] = {r["doc_id"]: r["text"] for r in after.collect()}
        before = spark.createDataFrame(after.collect(), docs.schema)
    clean, exact, near, last = kept.values()
    assert exact.keys() <= clean.keys() and near.keys() <= exact.keys() and last.keys() <= near.keys()
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t)
    first = {}
    for d in sorted(clean):
        first.setdefault(norm(clean[d]), d)
    assert exact.keys() == set(first.values())
    assert near.keys() == {d for d, _, _, keep in brute(list(exact.items()), 5, 80) if keep}
    frame = spark.createDataFrame(list(near.items()), "doc_id long, text string")
    leaky = {r["doc_id"] for r in find_leaks(frame, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).collect()}
    assert last.keys() == near.keys() - leaky
    pieces = corpus_pipeline.STAGES[-1][1](spark, before, sf_dir).collect()
    known = TextIds(tokenizer_path())
    assert sum(p["length"] for p in pieces) == sum(len(encoded(t, known, 1)) for t in last.values())


def test_run_gives_the_last_stage(spark, sf_dir):
    assert corpus_pipeline.run(spark, sf_dir).columns[:3] == ["doc_id", "start", "length"]


def test_rows_without_own_ids(spark, sf_dir):
    words = [f"word{i}" for i in range(60)]
    text, other = " ".join(words), " ".join(words[::-1])
    item = spark.read.parquet(f"{sf_dir}/benchmark.parquet").orderBy("item_id").first()["text"]
    rows = [(None, text), (None, text.replace(" ", "  ")), (None, other), (1, other), (5, text + " a"), (5, text + " a"), (None, f"before {item} after"), (9, None), (None, ""), (7, "alone")]
    docs = spark.createDataFrame([(d, t, "en", "s", 1, "clash") for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long, key string")
    got = corpus_pipeline.exact(spark, docs.drop("key"), sf_dir)
    assert got.columns == corpus_pipeline.COLUMNS
    left = sorted(((r["doc_id"], " ".join(r["text"].split())) for r in got.where("text <> ''").collect()), key=str)
    assert left == sorted([(None, text), (1, other), (5, text + " a"), (None, f"before {item} after"), (7, "alone")], key=str)
    assert got.where("coalesce(text, '') = ''").count() == 1
    close = corpus_pipeline.near(spark, got, sf_dir).collect()
    assert sum("word7 word8" in " ".join((r["text"] or "").split()) for r in close) == 1
    assert not [r for r in corpus_pipeline.decontaminated(spark, got, sf_dir).collect() if item in (r["text"] or "")]


def test_empty_tables(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES[1:-1]:
        assert stage(spark, docs, sf_dir).collect() == []
    assert corpus_pipeline.packed(spark, docs, sf_dir).collect() == []
