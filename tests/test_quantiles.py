import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from hearthside.operators.quantiles import exact_quantiles, from_ordered_bits, medians, ordered_bits


def skewed_rows():
    rng = random.Random(5)
    rows = [("hot", rng.lognormvariate(12, 1)) for _ in range(3000)]
    rows += [("hot", 500000.0)] * 1500
    rows += [(f"k{i % 40}", rng.uniform(-5, 5)) for i in range(2000)]
    rows += [("narrow", 30 + rng.random() / 1e6) for _ in range(999)]
    rows += [("packed", -7.0 - i * 2.0**-50) for i in range(700)]  # neighbours in the lowest bits
    rows += [("wide", rng.choice([-1, 1]) * 10.0 ** rng.uniform(-300, 300)) for _ in range(500)]
    rows += [("tiny", i * 5e-324) for i in range(-40, 300)]
    rows += [("two", 1.0), ("two", 2.0), ("one", -0.25), ("zero", 0.0), ("zero", -0.0)]
    rows += [("empty", None), ("two", None), ("two", float("nan")), (None, 3.0)]
    return rows


def test_matches_numpy(spark):
    rows = skewed_rows()
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    df = spark.createDataFrame(rows, "k string, x double")
    got = {r["k"]: r["q"] for r in exact_quantiles(df, ["k"], {"q": F.col("x")}, probs).collect()}
    groups = {}
    for k, x in rows:
        if k is not None:
            groups.setdefault(k, []).append(x)
    assert set(got) == set(groups)
    for k, xs in groups.items():
        kept = [x for x in xs if x is not None and not math.isnan(x)]
        if not kept:
            assert got[k] == [None] * len(probs)
            continue
        assert got[k] == pytest.approx(np.quantile(kept, probs).tolist(), rel=1e-12, abs=1e-12)


def test_several_measures_without_group(spark):
    df = spark.createDataFrame([(1, 10.0), (2, None), (3, 30.0), (4, 50.0)], "a int, b double")
    row = medians(df, [], {"a": F.col("a"), "b": F.col("b"), "c": F.lit(None).cast("double")}).first()
    assert (row["a"], row["b"], row["c"]) == (2.5, 30.0, None)


def test_measures_are_made_once_for_all_passes(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def made(i):
        seen.add(1)
        return float(i)

    df = spark.range(101).select(made.asNondeterministic()("id").alias("x"))
    assert medians(df, [], {"x": F.col("x")}).first()["x"] == 50.0
    assert seen.value == 101


def test_no_rows(spark):
    df = spark.createDataFrame([], "a double")
    assert medians(df, [], {"a": F.col("a")}).first()["a"] is None


def test_approximate_switch(spark):
    df = spark.range(1, 1002).select((F.col("id") % 2).alias("k"), F.col("id").cast("double").alias("x"))
    got = {r["k"]: r["m"] for r in medians(df, ["k"], {"m": F.col("x")}, approx=True).collect()}
    assert abs(got[0] - 501) <= 2 and abs(got[1] - 501) <= 2


def test_bits_order_like_doubles_and_come_back(spark):
    rng = random.Random(6)
    edges = [0.0, 5e-324, 2.2250738585072014e-308, 2.225073858507201e-308, 1.0, math.nextafter(1, 0), math.nextafter(1, 2), 1.7976931348623157e308, math.inf]
    values = edges + [2.0**k for k in range(-1074, 1024, 7)] + [math.nextafter(2.0**k, 0) for k in range(-1000, 1024, 7)] + [rng.lognormvariate(0, 60) for _ in range(500)]
    values += [-v for v in values]
    df = spark.createDataFrame([(v,) for v in values], "x double").select("x", ordered_bits(F.col("x")).alias("b")).select("x", "b", from_ordered_bits(F.col("b")).alias("y"))
    rows = df.collect()
    assert all(r["x"] == r["y"] for r in rows)
    by_bits = sorted(rows, key=lambda r: r["b"])
    assert [r["x"] for r in by_bits] == sorted(r["x"] for r in rows)
    assert all((a["b"] == b["b"]) == (a["x"] == b["x"]) for a, b in zip(by_bits, by_bits[1:]))
    odd = spark.sql("SELECT CAST('NaN' AS DOUBLE) AS x UNION ALL SELECT CAST(NULL AS DOUBLE)").select(ordered_bits(F.col("x")).alias("b"))
    assert [r["b"] for r in odd.collect()] == [None, None]
