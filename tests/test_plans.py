"""Plans keep what makes them scale: pushed filters, narrow reads, no cross joins."""

import re

import pytest

from hearthside.operators import search
from hearthside.operators.deals import normalise_to_max, with_coordinates
from hearthside.operators.encode import fit_target_encoding
from hearthside.plans.catalog import QUERIES
from hearthside.plans.fixture import listings
from hearthside.plans.search_queries import search_table
from hearthside.sources.writers import save_search_table


def plan(df):
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def read_schemas(text):
    return [set(re.findall(r"(\w+):", line)) for line in re.findall(r"ReadSchema: struct<(.*)>", text)]


@pytest.fixture(scope="module")
def stored(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("search") / "table")
    table = search_table(spark, sf_dir)
    save_search_table(table, path, ["row_key", "price_numeric", "description"])
    return spark.read.parquet(path)


def test_search_pushes_every_facet(stored):
    found = search.search(stored, city="NATION_5", min_price=10, max_beds=3, furnished="yes").select("id", "price_numeric")
    text = plan(found)
    pushed = re.search(r"PushedFilters: \[(.*)\]", text).group(1)
    for part in ("EqualTo(city,NATION_5)", "GreaterThanOrEqual(price_numeric,10", "LessThanOrEqual(bedrooms,3)", "EqualTo(furnished_yes,1)"):
        assert part in pushed
    assert "TakeOrderedAndProject" in text and "Exchange" not in text
    assert read_schemas(text) == [{"id", "city", "price_numeric", "bedrooms", "furnished_yes"}]


def test_ids_become_a_pushed_filter(stored):
    assert "In(id, [1,2,3])" in plan(search.by_ids(stored, [1, 2, 3]))


def test_options_scan_once(stored):
    for df in (search.dropdown_values(stored, ["city", "governorate"]), search.option_bounds(stored)):
        assert len(read_schemas(plan(df))) == 1


def test_aggregates_read_only_their_columns(spark, sf_dir):
    text = plan(listings(spark, sf_dir).groupBy("governorate").avg("price_numeric"))
    assert {"l_orderkey", "l_partkey", "l_suppkey", "l_extendedprice"} in read_schemas(text)
    assert {"o_orderkey"} in read_schemas(text)


def test_small_lookup_is_broadcast_by_size(spark):
    wanted = spark.range(1000).selectExpr("cast(id % 7 as string) city")
    known = spark.range(7).selectExpr("cast(id as string) city", "1d latitude", "2d longitude")
    assert "BroadcastHashJoin" in plan(with_coordinates(wanted, known))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "SortMergeJoin" in plan(with_coordinates(wanted, known))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


CHEAP = [n for n in sorted(QUERIES) if n not in ("stacked_scores", "tuned_model", "leaderboard", "linear_scores", "gbt_scores", "importances", "scored_requests", "prepared_listings") and not n.endswith("_ingest")]


@pytest.mark.parametrize("name", CHEAP)
def test_no_cross_joins(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_one_large_column_does_not_widen_the_joins_of_small_ones(spark):
    """400,000 sellers: the region's codes are still broadcast."""
    df = spark.range(400_000).selectExpr("cast(id % 5 as string) governorate", "cast(id as string) seller_name", "cast(id % 7 as double) target")
    coded = fit_target_encoding(df, ["governorate", "seller_name"]).apply(df)
    assert plan(coded).count("BroadcastHashJoin LeftOuter") >= 1


def test_rows_without_a_compare_set_are_one_set(spark):
    df = spark.createDataFrame([(None, 4.0), (None, 8.0), ("a", 5.0)], "place string, price_numeric double")
    found = normalise_to_max(df, "place", ["price_numeric"])
    assert sorted(r["price_numeric_pct"] for r in found.collect()) == [50.0, 100.0, 100.0]


def test_listings_set_the_method_limit(spark, sf_dir):
    from hearthside.plans.fixture import listings

    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name)
    spark.conf.set(name, "65535")
    try:
        listings(spark, sf_dir)
        assert spark.conf.get(name) == "8000"
    finally:
        spark.conf.set(name, before)


def test_regressions_share_one_stored_table(spark, sf_dir):
    text = plan(QUERIES["linear_by_area"](spark, sf_dir))
    assert "Join" not in text and all(read <= {"row_key", "target", "area_sqm"} for read in read_schemas(text))


def test_products_are_read_once_a_page(spark, sf_dir):
    """Neither the filter on found products nor the use of two of their fields reads the blocks, or builds the page, again."""
    made = QUERIES["page_products"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert made.count("""["']application/ld""") == 1 and made.count("broken</script>") == 1


def test_first_product_of_each_page(spark):
    from hearthside.operators import pages

    block = lambda text: f'<script type="application/ld+json">{text}</script>'
    rows = [
        (1, block("{broken") + block('{"@type": "Product", "name": "a"}') + block('{"@type": "Product", "name": "b"}')), (2, block('{"@type": "Place"}')),
        (3, None), (4, ""), (None, block('{"@type": "Product"}')),
    ]
    df = spark.createDataFrame(rows, "id long, html string")
    found = pages.with_product(df, df.html, "ld")
    assert found.columns == ["id", "html", "ld"]
    assert sorted(((r["id"], r["ld"]["name"]) for r in found.collect()), key=str) == [(1, "a"), (None, None)]
