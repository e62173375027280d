"""Keyset paging, and statistics merged from states."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from hearthside.operators import search
from hearthside.streaming.market_state import MarketState


@pytest.mark.parametrize("direction", ["ASC", "DESC"])
def test_pages_partition_the_result(spark, direction):
    rng = random.Random(4)
    rows = [(i, rng.choice([None, None, *map(float, range(6))]), rng.choice("ab")) for i in range(100)]
    df = spark.createDataFrame(rows, "id long, price_numeric double, city string").repartition(5)
    whole = [tuple(r) for r in search.search(df, sort_dir=direction, limit=1000, city="a").collect()]
    got, token = [], None
    while True:
        page = [tuple(r) for r in search.search_after(df, token, sort_dir=direction, limit=7, city="a").collect()]
        if not page:
            break
        got += page
        token = search.continuation({"price_numeric": page[-1][1], "id": page[-1][0]})
    assert got == whole and len(got) > 30
    assert search.continuation(None) is None


def test_a_deep_page_is_a_pushed_range(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(5000).select("id", F.col("id").cast("double").alias("price_numeric")).write.parquet(path)
    page = search.search_after(spark.read.parquet(path), "[4000.0, 4000]", limit=10)
    plan = page._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(price_numeric,4000.0)" in plan and "TakeOrderedAndProject(limit=10" in plan
    assert [r["id"] for r in page.collect()] == list(range(4001, 4011))


def state(spark, path, fan=3):
    return MarketState(spark, str(path), "city", {"price": 10.0}, ["seller"], fan=fan)


def test_merged_states_equal_full_statistics(spark, tmp_path):
    rng = random.Random(5)
    rows = [(rng.choice(["x", "y", None]), rng.choice([None, round(rng.uniform(-50, 200), 2)]), rng.choice(["s1", "s2", "s3", None]), i % 7) for i in range(400)]
    df = spark.createDataFrame(rows, "city string, price double, seller string, batch int")
    parts, whole = state(spark, tmp_path / "parts"), state(spark, tmp_path / "whole")
    for b in range(7):
        for _ in range(1 + (b == 3)):  # one batch is repeated
            parts.add(df.where(F.col("batch") == b), b)
    whole.add(df, 0)
    got = {r["city"]: r.asDict() for r in parts.statistics().collect()}
    assert got == {r["city"]: r.asDict() for r in whole.statistics().collect()}
    for city in ("x", "y", None):
        prices = [p for c, p, _, _ in rows if c == city and p is not None]
        assert got[city]["rows"] == sum(c == city for c, *_ in rows) and got[city]["n_price"] == len(prices)
        assert got[city]["mean_price"] == pytest.approx(sum(prices) / len(prices)) and got[city]["min_price"] == min(prices)
        assert got[city]["middle_price"] == statistics.median_low(prices) // 10 and got[city]["distinct_seller"] == 3
    earlier = {r["city"]: r["rows"] for r in parts.statistics(version=1).collect()}
    assert earlier == {c: sum(x == c and b <= 1 for x, _, _, b in rows) for c in ("x", "y", None)}
    assert len(parts.states()) <= 4


def test_a_batch_reads_no_earlier_rows(spark, tmp_path):
    parts = state(spark, tmp_path / "s")
    for b in range(3):
        parts.add(spark.createDataFrame([("x", float(b), "s")], "city string, price double, seller string"), b)
    files = parts._merged(parts.states()).inputFiles()
    assert files and all("/states/" in f for f in files)
    assert parts.statistics().first()["rows"] == 3
