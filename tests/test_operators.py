import random

import pytest
from pyspark.sql import functions as F

from hearthside import vocab
from hearthside.functions.features import one_hot
from hearthside.operators import clean, deals, gaps, ledger, market, quality, search
from hearthside.operators.sequence import batches, contiguous_id, first_per_key


def test_contiguous_id_over_skewed_order(spark):
    rows = [(i % 3 == 0 and 7.0 or float(i), f"k{i:05d}") for i in range(3000)]
    df = spark.createDataFrame(rows, "price double, key string").repartition(9)
    got = [(r["id"], r["price"], r["key"]) for r in contiguous_id(df, ["price", "key"]).orderBy("id").collect()]
    assert [g[0] for g in got] == list(range(1, 3001))
    assert [g[1:] for g in got] == sorted(rows)
    assert contiguous_id(df.limit(0), ["price", "key"]).count() == 0


def test_batches(spark):
    got = batches(spark.range(25).repartition(4), ["id"]).orderBy("id").collect()
    assert [(r["batch"], r["position"]) for r in got] == [(i // 10, i % 10) for i in range(25)]


def test_first_per_key_keeps_blanks_and_is_idempotent(spark):
    rows = [(i, ["a", "b", "", None, "hot"][i % 5] if i % 2 else "hot", i * 10) for i in range(200)]
    df = spark.createDataFrame(rows, "seq int, ad_id string, v int").repartition(6)
    once = first_per_key(df, "ad_id", F.col("seq"))
    got = sorted((r["seq"], r["ad_id"], r["v"]) for r in once.collect())
    seen, want = set(), []
    for row in rows:
        if not row[1] or row[1] not in seen:
            want.append(row)
            seen.add(row[1])
    assert got == sorted(want)
    twice = first_per_key(once, "ad_id", F.col("seq"))
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, once.collect()))


def test_ledger_parts_add_up(spark):
    batch = spark.createDataFrame([("u1",), ("u2",), ("u2",), ("u3",), ("",)], "url string")
    seen = spark.createDataFrame([("u2",), ("u9",), ("u9",)], "url string")
    left, both = ledger.unseen(batch, seen), ledger.already_seen(batch, seen)
    assert left.count() + both.count() == batch.count()
    assert {r["url"] for r in ledger.all_seen(batch, seen).collect()} == {"u1", "u2", "u3", "u9"}
    assert ledger.missing_from_ledger(batch, seen).first()["new_urls"] == 2


def search_rows(n=400):
    rng = random.Random(2)
    rows = []
    for i in range(1, n + 1):
        rows.append(
            (i, rng.choice(["cairo", "giza", None]), rng.choice(["c1", "c2", "c3", None]), rng.choice(["flat", "villa"]), rng.choice(["lux", "unknown"]),
             rng.choice([None, 0.0, 1e5, 2e5, 3e5]), rng.choice([0.0, 50.0, 120.0]), rng.randint(0, 5), rng.randint(0, 4),
             rng.randint(0, 1), rng.randint(0, 1), rng.randint(0, 1), rng.randint(0, 1))
        )
    columns = ["id", "governorate", "city", "property_type", "finish_type", "price_numeric", "area_sqm", "bedrooms", "bathrooms",
               "furnished_yes", "ownership_primary", "payment_option_cash or installment", "completion_status_off-plan"]
    return rows, columns


@pytest.mark.parametrize(
    "facets,test",
    [
        ({}, lambda r: True),
        ({"city": "c1"}, lambda r: r["city"] == "c1"),
        ({"city": ""}, lambda r: True),
        ({"governorate": "giza", "property_type": "villa", "finish_type": "lux"}, lambda r: (r["governorate"], r["property_type"], r["finish_type"]) == ("giza", "villa", "lux")),
        ({"min_price": 0}, lambda r: r["price_numeric"] is not None),
        ({"min_price": 1e5, "max_price": 2e5}, lambda r: r["price_numeric"] in (1e5, 2e5)),
        ({"min_area": 50, "max_area": 50}, lambda r: r["area_sqm"] == 50),
        ({"min_beds": 2, "max_beds": 3, "max_baths": 0}, lambda r: 2 <= r["bedrooms"] <= 3 and r["bathrooms"] == 0),
        ({"min_baths": 4}, lambda r: r["bathrooms"] >= 4),
        ({"furnished": "yes"}, lambda r: r["furnished_yes"] == 1),
        ({"furnished": "maybe"}, lambda r: True),
        ({"payment": "cash or installment", "completion": "off-plan", "ownership": "primary"},
         lambda r: r["payment_option_cash or installment"] == r["completion_status_off-plan"] == r["ownership_primary"] == 1),
    ],
)
def test_search_facets(spark, facets, test):
    rows, columns = search_rows()
    df = spark.createDataFrame(rows, "id int, governorate string, city string, property_type string, finish_type string, price_numeric double, area_sqm double, bedrooms int, bathrooms int, furnished_yes int, ownership_primary int, `payment_option_cash or installment` int, `completion_status_off-plan` int")
    got = {r["id"] for r in search.filtered(df, **facets).collect()}
    assert got == {r[0] for r in rows if test(dict(zip(columns, r)))}


def test_search_order_and_pages(spark):
    df = spark.createDataFrame([(1, 5.0, 1), (2, None, 2), (3, 5.0, 3), (4, 9.0, 4)], "id int, price_numeric double, area_sqm int")
    ids = lambda **k: [r["id"] for r in search.search(df, **k).collect()]
    assert ids() == [2, 1, 3, 4]
    assert ids(sort_dir="desc") == [4, 1, 3, 2]
    assert ids(sort_dir="sideways", sort_by="id; drop table") == [2, 1, 3, 4]
    assert ids(limit=2, offset=1) == [1, 3]
    assert ids(sort_by="area_sqm", sort_dir="DESC", limit=1) == [4]
    with pytest.raises(TypeError):
        search.search_predicate(colour="red")


def test_ids(spark):
    assert search.parse_ids(" 3, 4,,3 ") == [3, 4, 3]
    for bad in ("", " , ", "1,x", "1.5"):
        with pytest.raises(ValueError):
            search.parse_ids(bad)
    df = spark.range(1, 10).withColumnRenamed("id", "id")
    assert sorted(r["id"] for r in search.by_ids(df, [3, 3, 99]).collect()) == [3]
    assert search.by_ids(df, []).count() == 0
    wanted = search.ids_from_table(spark.createDataFrame([("1, 2",), (" ,2,",)], "ids string"))
    assert sorted(r["id"] for r in search.by_ids(df, wanted).collect()) == [1, 2]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        search.ids_from_table(spark.createDataFrame([("x",)], "ids string")).collect()


def test_options(spark):
    empty = spark.createDataFrame([], "price_numeric double, area_sqm double, bedrooms int, bathrooms int")
    assert search.option_bounds(empty).first().asDict() == vocab.OPTION_DEFAULTS
    df = spark.createDataFrame([(0.0, 0.0, 0, 0), (5.9, 70.9, 3, 2)], empty.schema)
    assert search.option_bounds(df).first().asDict() == {
        "price_min": 0, "price_max": 5, "area_min": 70, "area_max": 70, "bed_min": 1, "bed_max": 3, "bath_min": 1, "bath_max": 2
    }
    cities = spark.createDataFrame([("g", "b"), ("g", None), ("g", "a"), ("h", "z")], "governorate string, city string")
    assert [r["city"] for r in search.cities_of(cities, "g").collect()] == [None, "a", "b"]


def test_verdict_edges(spark):
    rows = [(100.0, 0.0), (0.0, 100.0), (100.0, 109.99), (100.0, 110.0), (100.0, 90.0), (100.0, 89.9), (100.0, 129.9), (100.0, 130.0), (100.0, 95.0), (None, 5.0)]
    want = ["---", "---", "Fair Price", "Overpriced", "Overpriced", "Great Deal", "Overpriced", "Possibly a Scam", "Fair Price", "---"]
    df = spark.createDataFrame(rows, "predicted double, price_numeric double")
    assert [r["verdict"] for r in deals.with_verdict(df).collect()] == want


def test_normalise_to_max(spark):
    df = spark.createDataFrame(
        [("s", 50.0, None, 0, 2, 1), ("s", 100.0, 40.0, 0, 4, None), ("t", 7.0, None, 1, 1, 1)],
        "s string, price_numeric double, area_sqm double, bedrooms int, bathrooms int, amenity_score int",
    )
    got = {(r["s"], r["price_numeric"]): [r[m + "_pct"] for m in vocab.COMPARE_MEASURES] for r in deals.normalise_to_max(df, "s").collect()}
    assert got == {("s", 50.0): [50.0, 0.0, 0.0, 50.0, 100.0], ("s", 100.0): [100.0, 100.0, 0.0, 100.0, 0.0], ("t", 7.0): [100.0, 0.0, 100.0, 100.0, 100.0]}


def test_comparison_table(spark):
    df = spark.createDataFrame([(4, "flat", 1234567.0, 3), (9, None, None, 2)], "id int, property_type string, price_numeric double, bedrooms int")
    rows = {r["feature"]: (r["Apt #4"], r["Apt #9"]) for r in deals.comparison_table(df, [9, 4]).collect()}
    assert rows["Price (EGP)"] == ("1,234,567", "---") and rows["Type"] == ("flat", "---") and rows["View"] == ("---", "---")
    assert list(rows) == list(vocab.COMPARE_LABELS.values())


def test_request_rows_and_coordinates(spark):
    table = spark.createDataFrame([(1, "cairo", 1, 0, 0, 1, 0, None, 1, 1, 0)], "id int, city string, furnished_yes int, furnished_no int, ownership_primary int, payment_option_cash int, payment_option_installment int, completion_status_ready int, seller_type_agency int, Pool int, Security int")
    row = deals.request_rows(table).first()
    assert (row["furnished"], row["ownership"], row["payment_option"], row["completion_status"], row["seller_type"]) == ("yes", "resale", "cash", "off-plan", "agency")
    assert row["Pool"] is True and row["Security"] is False and row["Elevator"] is False and row["compound_name"] == "unknown"
    known = spark.createDataFrame([("cairo", 30.5, 31.5)], "city string, latitude double, longitude double")
    some = spark.createDataFrame([("cairo",), ("x",)], "city string")
    got = {r["city"]: (r["latitude"], r["longitude"]) for r in deals.complete_requests(some, known).collect()}
    assert got == {"cairo": (30.5, 31.5), "x": (30.05, 31.25)}


def test_histogram_like_numpy(spark):
    import numpy as np

    rng = random.Random(4)
    values = [rng.lognormvariate(0, 1) for _ in range(500)] + [0.0, 9.0]
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "x double")
    counts, edges = np.histogram(values, bins=60)
    rows = market.histogram(df, F.col("x"), 60).orderBy("bin").collect()
    assert [r["n"] for r in rows] == counts.tolist()
    assert [r["low"] for r in rows] == pytest.approx(edges[:-1].tolist())
    flat = market.histogram(df.limit(0).union(spark.createDataFrame([(3.0,), (3.0,)], "x double")), F.col("x"), 4).orderBy("bin").collect()
    assert [(r["low"], r["n"]) for r in flat] == [(2.5, 0), (2.75, 0), (3.0, 2), (3.25, 0)]


def test_budget_needs_more_than_five(spark):
    df = spark.createDataFrame([(100.0, 10.0, 1, 1, "c")] * 5, "price_numeric double, area_sqm double, bedrooms int, bathrooms int, city string")
    assert market.budget_summary(df, 100).count() == 0 and market.budget_cities(df, 100).count() == 0
    assert market.budget_summary(df.union(df.limit(1)), 100).first()["listings"] == 6
    assert market.budget_cities(df.union(df.limit(1)), 100).first()["n"] == 6


def test_cleaning_steps(spark):
    df = spark.createDataFrame(
        [("a", None, 1, None), ("b", "x", None, None), (None, "y", 4, None), ("a", "y", 4, 1.0), ("b", None, None, None)],
        "t string, u string, n int, s double",
    )
    assert clean.drop_sparse(df).columns == ["t", "u", "n"]
    assert {r["column"]: r["nulls"] for r in clean.null_report(df).collect()} == {"t": 1, "u": 2, "n": 2, "s": 4}
    assert [r["n"] for r in clean.fill_with_mean(df, ["n"]).collect()] == [1.0, 3.0, 4.0, 4.0, 3.0]
    assert {r["column"]: r["mode"] for r in clean.column_modes(df, ["t", "u"]).collect()} == {"t": "a", "u": "y"}
    assert [r["t"] for r in clean.fill_with_mode(df, ["t"]).collect()] == ["a", "b", "a", "a", "b"]
    assert clean.columns_of(df, "number") == ["n", "s"] and clean.columns_of(df, "text") == ["t", "u"]
    assert clean.without_duplicates(df.union(df)).count() == 5


def test_one_hot_sums(spark):
    df = spark.createDataFrame([("yes",), ("NO",), ("odd",), (None,)], "furnished string")
    hot = one_hot(df, {"furnished": vocab.ONE_HOT_VALUES["furnished"]})
    sums = [sum(r) for r in hot.collect()]
    assert hot.columns == ["furnished_no", "furnished_unknown", "furnished_yes"] and sums == [1, 1, 0, 0]


def test_coverage_counts_zero_as_missing(spark):
    df = spark.createDataFrame([(0, "", True, None), (3, "lux", False, "x" * 31), (None, None, None, "short")], "floor_number int, finish_type string, has_pool boolean, description string")
    got = {r["feature"]: r["filled"] for r in quality.coverage(df).collect()}
    assert got == {"finish_type": 1, "floor_number": 1, "has_pool": 1}
    assert quality.coverage(df.limit(0)).first()["pct"] == 0.0


def test_validation(spark):
    good = {f.name: "1" for f in quality.REQUEST_REQUIRED.fields}
    rows = [good, {**good, "bedrooms": "many"}, {**good, "city": None}, {**good, "Pool": "perhaps"}, {**good, "Pool": "true"}]
    names = list(good) + ["Pool"]
    df = spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], ", ".join(f"`{n}` string" for n in names))
    checked = quality.validate_requests(df).collect()
    assert [r["errors"] for r in checked] == [[], ["bedrooms"], ["city"], ["Pool"], []]
    assert [r["Pool"] for r in checked] == [False, False, False, False, True]
    assert checked[0]["Central A/C & heating"] is False
    ok, bad = quality.split_valid(df)
    assert (ok.count(), bad.count()) == (2, 3)


def test_requests_and_replies(spark):
    rows = [(f"k{i:02d}", "Title" if i % 2 else None, f"text {i}" + "x" * 900, None, 0 if i == 3 else None) for i in range(12)]
    df = spark.createDataFrame(rows, "k string, title string, description string, finish_type string, floor_number int")
    texts = gaps.request_texts(df, "k", ["k"]).orderBy("batch").collect()
    assert [r["n"] for r in texts] == [10, 2] and texts[1]["keys"] == ["k10", "k11"]
    lines = texts[1]["prompt"].split("\n")
    assert lines[0] == "Extract features from these 2 apartment listings." and lines[3] == "=== Listing 1 ==="
    assert len(lines[4]) == 800 and lines[4].startswith("text 10") and lines[6] == "=== Listing 2 ===" and lines[7] == "Title"
    replies = spark.createDataFrame(
        [(0, ["a", "b"], '[{"finish_type": "lux", "floor_number": 2}, {"finish_type": null, "has_pool": true}]'), (1, ["c"], '{"finish_type": "lux"}'),
         (2, ["d"], "no json"), (3, ["e", "f"], "[{}]"), (4, ["g"], '"text"'), (5, ["h"], None)],
        "batch int, keys array<string>, reply string",
    )
    got = gaps.accepted(gaps.parse_replies(replies))
    assert sorted((r["key"], r["item"]["finish_type"], r["item"]["has_pool"]) for r in got.collect()) == [("a", "lux", None), ("b", None, True), ("c", "lux", None)]
    base = spark.createDataFrame([("a", "old", 0), ("c", "", None), ("z", None, 1)], "k string, finish_type string, floor_number int")
    merged = {r["k"]: (r["finish_type"], r["floor_number"]) for r in gaps.merge_replies(base, got, "k").collect()}
    assert merged == {"a": ("old", 2), "c": ("lux", None), "z": (None, 1)}
