import time

import pytest
from pyspark.sql import functions as F

from hearthside import schemas, session, vocab
from hearthside.session import build_session, ensure_checkpoint_dir, release, settle
from hearthside.sources import readers, writers


def test_records_tolerant_and_strict(spark, tmp_path):
    path = tmp_path / "r.jsonl"
    path.write_text('{"ad_id": "1", "price_numeric": 5.5, "title": "شقة"}\n\n{broken\n{"ad_id": "2"}\n', encoding="utf-8")
    rows = readers.read_records(spark, str(path)).orderBy("ad_id").collect()
    assert [(r["ad_id"], r["price_numeric"], r["title"]) for r in rows] == [("1", 5.5, "شقة"), ("2", None, None)]
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        readers.read_records_strict(spark, str(path)).collect()
    assert readers.read_records(spark, str(tmp_path / "none")).count() == 0


def test_append_records_and_ledger(spark, tmp_path):
    df = spark.createDataFrame([("u1", None), ("", "x")], "url string, title string")
    for _ in range(2):
        writers.append_records(df, str(tmp_path / "out"))
        writers.append_ledger(df, str(tmp_path / "seen"))
    assert spark.read.schema("url string, title string").json(str(tmp_path / "out")).count() == 4
    assert [r["url"] for r in readers.read_ledger(spark, str(tmp_path / "seen")).collect()] == ["u1"]
    assert readers.read_ledger(spark, str(tmp_path / "nothing")).count() == 0


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("7", 'two\nlines, "quoted"', 1.5, "new"), ("8", None, float("nan"), None)], "ad_id string, description string, price_numeric double, extra string")
    writers.write_csv(df, str(tmp_path / "c"))
    header = max((f.read_text(encoding="utf-8") for f in (tmp_path / "c").glob("*.csv")), key=len).split("\n")[0].split(",")
    assert header == vocab.RECORD_ORDER + ["extra"]
    schema = schemas.RAW.add("extra", "string")
    rows = {r["ad_id"]: r for r in readers.read_csv(spark, str(tmp_path / "c"), schema).collect()}
    assert rows["7"]["description"] == 'two\nlines, "quoted"' and rows["7"]["extra"] == "new" and rows["8"]["price_numeric"] is None


def test_enriched_always_has_all_features(spark, tmp_path):
    df = spark.createDataFrame([("1", "lux")], "ad_id string, finish_type string")
    writers.write_enriched(df, str(tmp_path / "j"), str(tmp_path / "c"))
    line = "".join(f.read_text() for f in (tmp_path / "j").glob("*.json"))
    assert all(f'"{f}"' in line for f in vocab.EXTRACTED_FEATURES)
    assert "has_security" in "".join(f.read_text() for f in (tmp_path / "c").glob("*.csv"))


def test_search_table(spark, tmp_path):
    rows = [(f"g{i % 2}", f"c{i % 5}", float(i % 7), i) for i in range(100)]
    df = spark.createDataFrame(rows, "governorate string, city string, price_numeric double, seq int")
    path = str(tmp_path / "t")
    assert writers.seed_search_table(spark, df, path, ["seq"]) is True
    assert writers.seed_search_table(spark, df.limit(1), path, ["seq"]) is False
    stored = readers.read_table(spark, path)
    assert [(r["id"], r["seq"]) for r in stored.orderBy("id").collect()] == [(i + 1, i) for i in range(100)]
    df.createOrReplaceTempView("kept_listings")
    assert readers.read_table(spark, "kept_listings").count() == 100


def test_state_and_samples(spark, tmp_path):
    state = readers.read_state(spark, str(tmp_path / "no")).first()
    assert (state["current_task"], state["current_task_page"], state["total_records"]) == (None, 0, 0)
    (tmp_path / "s.json").write_text('{"current_task": "x", "current_task_page": 3, "total_records": 9}')
    assert readers.read_state(spark, str(tmp_path / "s.json")).first()["total_records"] == 9
    df = spark.range(10)
    assert [r["id"] for r in readers.first_records(df, ["id"], 3).collect()] == [0, 1, 2]
    assert readers.first_records(df, ["id"], 0).count() == 10


def test_processed_formats(spark, tmp_path):
    df = spark.range(3).withColumn("x", F.lit("a"))
    writers.write_processed(df, str(tmp_path / "p"))
    writers.write_processed(df, str(tmp_path / "c"), "csv")
    assert readers.read_table(spark, str(tmp_path / "p")).count() == 3
    assert "id,x" in "".join(f.read_text() for f in (tmp_path / "c").glob("*.csv"))


def test_spread_only_touches_small_scans(spark, sf_dir):
    scan = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    assert readers.spread(scan).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    wide = spark.range(100, numPartitions=20)
    assert readers.spread(wide) is wide


def test_spread_deals_out_a_table_with_one_row_group_in_many_splits(spark, tmp_path):
    path, limit = str(tmp_path / "one"), "spark.sql.files.maxPartitionBytes"
    spark.range(200000, numPartitions=1).select("id", F.md5(F.col("id").cast("string")).alias("x")).write.parquet(path)
    before = spark.conf.get(limit)
    spark.conf.set(limit, "200000")
    try:
        scan = spark.read.parquet(path)
        cores = spark.sparkContext.defaultParallelism
        assert scan.rdd.getNumPartitions() >= cores
        held = readers.spread(scan).groupBy(F.spark_partition_id()).count().collect()
        assert sum(r["count"] for r in held) == 200000 and max(r["count"] for r in held) <= 2 * 200000 / cores
    finally:
        spark.conf.set(limit, before)


def test_session_and_checkpoint_folder(spark):
    assert build_session().sparkContext is spark.sparkContext
    ensure_checkpoint_dir(spark)
    assert spark.sparkContext.getCheckpointDir()


def test_settled_summaries_are_released(spark):
    release()
    kept = settle(spark.range(5))
    assert kept.storageLevel.useMemory and release() == 1 and release() == 0
    assert not kept.storageLevel.useMemory


def test_enriched_files_stay_small_however_many_features_are_null(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def found(i):
        seen.add(1)
        return "lux"

    df = spark.range(0, 2000, 1, 2).select(F.concat(F.lit("u"), "id").alias("url"), found.asNondeterministic()("id").alias("finish_type"))
    writers.write_enriched(df, str(tmp_path / "j"), str(tmp_path / "c"), "gzip")
    assert seen.value == 2000
    for name in ("j", "c"):
        assert sum(p.stat().st_size for p in (tmp_path / name).glob("part-*")) < 40 * 2000
    schema = writers.with_all_features(df).schema
    back = [readers.read_records_strict(spark, str(tmp_path / "j"), schema), readers.read_csv(spark, str(tmp_path / "c"), schema)]
    assert [b.where("finish_type = 'lux' AND has_pool IS NULL").select("url").distinct().count() for b in back] == [2000, 2000]


def test_shuffle_files_go_with_the_write_of_a_large_table(spark, tmp_path, monkeypatch):
    def shuffled():
        files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
        return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle")}

    monkeypatch.setattr(session, "_LARGE", 0)
    old = shuffled()
    spark.range(1000).groupBy(F.col("id") % 7).count().write.parquet(str(tmp_path / "t"))
    new = shuffled() - old
    assert new
    session.cut_lineage(spark.range(10))
    for _ in range(40):
        if not new & shuffled():
            break
        time.sleep(0.5)
    assert not new & shuffled()
