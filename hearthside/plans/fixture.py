"""A listings table derived from the given tables, for queries and their oracles.

``listings`` is the Spark side, ``LISTINGS_SQL`` the same rows for an independent SQL
engine. Roles: governorate = region, city = nation, price = extended price,
area = quantity. Every text is built from known columns, so extraction has an exact
expected answer.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthside.session import compiled_methods
from hearthside.sources.readers import spread

AS_OF = "2025-06-15"

# delivery text -> months from AS_OF; the text is chosen by order key modulo its length
DELIVERY_TEXTS = [
    ("Immediate", "0.0"),
    ("2027", "date_diff('day', DATE '2025-06-15', DATE '2027-12-31') / 30.4375"),
    ("2024-2026", "date_diff('day', DATE '2025-06-15', DATE '2026-12-31') / 30.4375"),
    ("Jun-27", "date_diff('day', DATE '2025-06-15', DATE '2027-06-01') / 30.4375"),
    ("6 months", "6.0"),
    ("2.5 Years", "30.0"),
    ("two years", "24.0"),
    ("May", "0.0"),
    ("ready-to-move", "0.0"),
    ("this year", "date_diff('day', DATE '2025-06-15', DATE '2025-12-31') / 30.4375"),
    ("٢٠٢٦", "date_diff('day', DATE '2025-06-15', DATE '2026-12-31') / 30.4375"),
    ("13/1/2027", "date_diff('day', DATE '2025-06-15', DATE '2027-01-13') / 30.4375"),
    ("very soon", "0.5"),
    ("2020", "0.0"),
    ("2027-05-01T00:00:00.000Z", "date_diff('day', DATE '2025-06-15', DATE '2027-01-05') / 30.4375"),
    ("within two years", "24.0"),
    ("whenever", "0.0"),
]
TITLES = ["Flat in Hyde Park", "Flat in MIVIDA", "شقة في Swan Lake", "Flat in Mountain View Hyde Park", "Flat downtown"]
COMPOUND_TRUTH = ["Hyde Park", "Mivida", "Swan Lake", "Mountain View Hyde Park", None]
ARABIC_FINISH = ["تشطيب كامل", "سوبر لوكس", "نصف تشطيب", "على الطوب", "لوكس"]
ARABIC_FINISH_TRUTH = ["fully_finished", "super_lux", "semi_finished", "unfinished", "lux"]
LISTED_AMENITIES = [
    "Electricity Meter", "Water Meter", "Natural Gas", "Security", "Covered Parking", "Pets Allowed", "Landline",
    "Balcony", "Private Garden", "Pool", "Built in Kitchen Appliances", "Elevator", "Central A/C & heating", "Maids Room",
]


def read(spark: SparkSession, sf_dir: str, name: str, heavy: bool = False) -> DataFrame:
    """One given table; ``heavy`` work per row uses all cores even on a single-split file."""
    table = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(table) if heavy else table


def _pick(selector: Column, values: list[str | None]) -> Column:
    chosen = F.when(selector == 0, F.lit(values[0]))
    for i, v in enumerate(values[1:], 1):
        chosen = chosen.when(selector == i, F.lit(v))
    return chosen


def _pick_sql(selector: str, values: list[str | None], quote: bool = True) -> str:
    arms = " ".join(
        f"WHEN {i} THEN " + ("NULL" if v is None else f"'{v}'" if quote else v) for i, v in enumerate(values)
    )
    return f"CASE {selector} {arms} END"


def joined(spark: SparkSession, sf_dir: str, heavy: bool = False) -> DataFrame:
    """Order lines with part, supplier and place.

    Orders only test existence, hence a semi join that reads one column. Join
    strategies are left to the planner: the small tables are broadcast by their size.
    """
    compiled_methods(spark)
    t = {n: read(spark, sf_dir, n) for n in ("orders", "part", "supplier", "nation", "region")}
    t["lineitem"] = read(spark, sf_dir, "lineitem", heavy)
    return (
        t["lineitem"]
        .join(t["orders"], F.col("l_orderkey") == F.col("o_orderkey"), "left_semi")
        .join(t["part"], F.col("l_partkey") == F.col("p_partkey"))
        .join(t["supplier"], F.col("l_suppkey") == F.col("s_suppkey"))
        .join(t["nation"], F.col("s_nationkey") == F.col("n_nationkey"))
        .join(t["region"], F.col("n_regionkey") == F.col("r_regionkey"))
    )


def text_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows for queries that do much work per row."""
    return listings(spark, sf_dir, heavy=True)


def listings(spark: SparkSession, sf_dir: str, heavy: bool = False) -> DataFrame:
    c = F.col
    text = lambda x: c(x).cast("string")
    english = _pick(
        c("p_size") % 6, ["super lux", "fully finished", "semi-finished", "core and shell", "luxury", "nice"]
    )
    views = _pick(c("l_linenumber") % 4, ["garden view", "sea view", "pool view", "city"])
    description = F.concat(
        F.lit("Apartment "), english, F.lit(", floor "), text("p_size"), F.lit(", "), views, F.lit(", delivery "),
        (c("l_linenumber") + 2024).cast("string"), F.lit(", down payment EGP "), text("l_partkey"),
    )
    listed = [F.when(c("l_partkey") % (i + 2) == 0, F.lit(a)) for i, a in enumerate(LISTED_AMENITIES)]
    return joined(spark, sf_dir, heavy).select(
        F.concat_ws("-", text("l_orderkey"), text("l_linenumber"), text("l_partkey"), text("l_suppkey")).alias("row_key"),
        F.when(c("l_partkey") % 50 == 0, "").otherwise((c("l_orderkey") * 8 + c("l_linenumber")).cast("string")).alias("ad_id"),
        c("l_extendedprice").alias("price_numeric"),
        F.when(c("l_partkey") % 40 == 0, F.lit(0.0)).otherwise(c("l_quantity")).alias("area_sqm"),
        (c("p_size") % 7).cast("int").alias("bedrooms"),
        (c("p_size") % 5).cast("int").alias("bathrooms"),
        c("p_type").alias("property_type"),
        c("n_name").alias("city"),
        c("r_name").alias("governorate"),
        c("s_name").alias("seller_name"),
        (F.lit(22.0) + c("n_nationkey").cast("double") / 4 + (c("l_orderkey") % 100).cast("double") / 1024).alias("latitude"),
        (F.lit(25.0) + c("n_nationkey").cast("double") / 4 + (c("l_partkey") % 100).cast("double") / 1024).alias("longitude"),
        F.when(c("l_linestatus") == "O", "off-plan").otherwise("ready").alias("completion_status"),
        F.when(c("l_returnflag") == "A", "yes").when(c("l_returnflag") == "N", "no").alias("furnished"),
        F.when(c("l_suppkey") % 2 == 0, "primary").otherwise("resale").alias("ownership"),
        _pick(c("l_orderkey") % 3, ["cash", "installment", "cash or installment"]).alias("payment_option"),
        _pick(c("p_size") % 6, ["super_lux", "fully_finished", "semi_finished", "unfinished", "lux"]).alias("finish_truth"),
        (c("l_orderkey") % 30).cast("double").alias("delivery_months"),
        description.alias("description"),
        F.concat_ws(
            ", ",
            F.when(c("l_linenumber") % 2 == 0, "Pool"),
            F.when(c("l_linenumber") % 3 == 0, "Elevator"),
            F.when(c("p_size") % 2 == 0, "Security"),
        ).alias("amenities"),
        # further columns for text, dates, pages and models
        c("l_orderkey").alias("order_no"),
        c("l_linenumber").alias("line_no"),
        c("l_partkey").alias("part_no"),
        c("l_suppkey").alias("supp_no"),
        c("p_size").alias("size_no"),
        _pick(c("l_suppkey") % 5, TITLES).alias("title"),
        _pick(c("l_orderkey") % len(DELIVERY_TEXTS), [t for t, _ in DELIVERY_TEXTS]).alias("delivery_text"),
        F.concat(
            _pick(c("p_size") % 5, ARABIC_FINISH), F.lit(" الدور "), (c("p_size") % 30).cast("string"),
            F.lit(" استلام "), (c("l_linenumber") + 2024).cast("string"), F.lit(" مقدم "), text("l_partkey"),
            F.when(c("l_linenumber") % 2 == 0, F.lit(" تقسيط 7 سنوات حديقة")).otherwise(F.lit(" 5 year installment مصعد")),
        ).alias("arabic_text"),
        F.concat_ws(", ", *listed).alias("listed_amenities"),
        F.when(c("l_suppkey") % 3 == 0, "agency").otherwise("individual").alias("seller_type"),
    )


_LISTED_SQL = ", ".join(
    f"CASE WHEN l_partkey % {i + 2} = 0 THEN '{a}' END" for i, a in enumerate(LISTED_AMENITIES)
)

LISTINGS_SQL = f"""
SELECT
  concat_ws('-', CAST(l_orderkey AS STRING), CAST(l_linenumber AS STRING), CAST(l_partkey AS STRING), CAST(l_suppkey AS STRING)) AS row_key,
  CASE WHEN l_partkey % 50 = 0 THEN '' ELSE CAST(l_orderkey*8 + l_linenumber AS STRING) END AS ad_id,
  l_extendedprice AS price_numeric,
  CASE WHEN l_partkey % 40 = 0 THEN CAST(0 AS DOUBLE) ELSE l_quantity END AS area_sqm,
  CAST(p_size % 7 AS INT) AS bedrooms, CAST(p_size % 5 AS INT) AS bathrooms,
  p_type AS property_type, n_name AS city, r_name AS governorate, s_name AS seller_name,
  CAST(22 AS DOUBLE) + CAST(n_nationkey AS DOUBLE)/4 + CAST(l_orderkey % 100 AS DOUBLE)/1024 AS latitude,
  CAST(25 AS DOUBLE) + CAST(n_nationkey AS DOUBLE)/4 + CAST(l_partkey % 100 AS DOUBLE)/1024 AS longitude,
  CASE l_linestatus WHEN 'O' THEN 'off-plan' ELSE 'ready' END AS completion_status,
  CASE l_returnflag WHEN 'A' THEN 'yes' WHEN 'N' THEN 'no' END AS furnished,
  CASE WHEN l_suppkey % 2 = 0 THEN 'primary' ELSE 'resale' END AS ownership,
  CASE l_orderkey % 3 WHEN 0 THEN 'cash' WHEN 1 THEN 'installment' ELSE 'cash or installment' END AS payment_option,
  CASE p_size % 6 WHEN 0 THEN 'super_lux' WHEN 1 THEN 'fully_finished' WHEN 2 THEN 'semi_finished' WHEN 3 THEN 'unfinished' WHEN 4 THEN 'lux' END AS finish_truth,
  CAST(l_orderkey % 30 AS DOUBLE) AS delivery_months,
  concat('Apartment ', CASE p_size % 6 WHEN 0 THEN 'super lux' WHEN 1 THEN 'fully finished' WHEN 2 THEN 'semi-finished' WHEN 3 THEN 'core and shell' WHEN 4 THEN 'luxury' ELSE 'nice' END,
    ', floor ', CAST(p_size AS STRING), ', ', CASE l_linenumber % 4 WHEN 0 THEN 'garden view' WHEN 1 THEN 'sea view' WHEN 2 THEN 'pool view' ELSE 'city' END,
    ', delivery ', CAST(2024 + l_linenumber AS STRING), ', down payment EGP ', CAST(l_partkey AS STRING)) AS description,
  concat_ws(', ', CASE WHEN l_linenumber % 2 = 0 THEN 'Pool' END, CASE WHEN l_linenumber % 3 = 0 THEN 'Elevator' END, CASE WHEN p_size % 2 = 0 THEN 'Security' END) AS amenities,
  l_orderkey AS order_no, l_linenumber AS line_no, l_partkey AS part_no, l_suppkey AS supp_no, p_size AS size_no,
  {_pick_sql("l_suppkey % 5", TITLES)} AS title,
  {_pick_sql(f"l_orderkey % {len(DELIVERY_TEXTS)}", [t for t, _ in DELIVERY_TEXTS])} AS delivery_text,
  concat({_pick_sql("p_size % 5", ARABIC_FINISH)}, ' الدور ', CAST(p_size % 30 AS STRING), ' استلام ', CAST(l_linenumber + 2024 AS STRING),
    ' مقدم ', CAST(l_partkey AS STRING), CASE WHEN l_linenumber % 2 = 0 THEN ' تقسيط 7 سنوات حديقة' ELSE ' 5 year installment مصعد' END) AS arabic_text,
  concat_ws(', ', {_LISTED_SQL}) AS listed_amenities,
  CASE WHEN l_suppkey % 3 = 0 THEN 'agency' ELSE 'individual' END AS seller_type
FROM lineitem JOIN orders ON l_orderkey=o_orderkey JOIN part ON l_partkey=p_partkey JOIN supplier ON l_suppkey=s_suppkey
JOIN nation ON s_nationkey=n_nationkey JOIN region ON n_regionkey=r_regionkey
"""

DELIVERY_SQL = _pick_sql(f"order_no % {len(DELIVERY_TEXTS)}", [s for _, s in DELIVERY_TEXTS], quote=False)
COMPOUND_SQL = _pick_sql("supp_no % 5", COMPOUND_TRUTH)
ARABIC_FINISH_SQL = _pick_sql("size_no % 5", ARABIC_FINISH_TRUTH)
