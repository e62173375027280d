"""Verdicts, rankings and comparisons."""

from pyspark.sql import functions as F

from hearthside import vocab
from hearthside.functions.features import one_hot
from hearthside.operators import deals, market
from hearthside.operators.quality import validate_requests
from hearthside.plans.fixture import listings, read
from hearthside.plans.registry import KEY, query
from hearthside.plans.search_queries import numbered

_PRED_SQL = """, edge AS (SELECT *, CASE WHEN part_no % 70 = 0 THEN 0.0 WHEN part_no % 70 = 1 THEN price_numeric / 0.9
      ELSE price_numeric * (70 + part_no % 70) / 100 END AS predicted FROM listings_fx),
    d AS (SELECT *, CASE WHEN predicted = 0 THEN 0.0 ELSE (price_numeric - predicted) / predicted * 100 END AS delta FROM edge)"""


def predicted(spark, sf_dir):
    """A stand-in for predictions, with zero and near-boundary cases."""
    price, part = F.col("price_numeric"), F.col("part_no")
    value = (
        F.when(part % 70 == 0, F.lit(0.0))
        .when(part % 70 == 1, price / F.lit(0.9))
        .otherwise(price * (70 + part % 70) / 100)
    )
    return listings(spark, sf_dir).withColumn("predicted", value)


@query(
    "verdicts",
    _PRED_SQL
    + """SELECT row_key, round(delta, 6) AS delta_pct, CASE WHEN price_numeric = 0 OR predicted = 0 THEN '---' WHEN abs(delta) < 10 THEN 'Fair Price'
    WHEN delta < -10 THEN 'Great Deal' WHEN delta < 30 THEN 'Overpriced' ELSE 'Possibly a Scam' END AS verdict FROM d""",
)
def verdicts(spark, sf_dir):
    return deals.with_verdict(predicted(spark, sf_dir)).select("row_key", F.round("delta_pct", 6).alias("delta_pct"), "verdict")


@query(
    "deal_rank",
    _PRED_SQL + "SELECT row_number() OVER (ORDER BY delta, row_key, price_numeric, description) AS deal_rank, row_key FROM d",
)
def deal_rank(spark, sf_dir):
    judged = deals.with_verdict(predicted(spark, sf_dir)).select(*KEY, "delta_pct")
    return deals.rank_deals(judged, KEY).select("deal_rank", "row_key")


@query(
    "best_deals",
    _PRED_SQL + "SELECT row_key, city, round(delta, 6) AS delta_pct FROM d ORDER BY delta, row_key, price_numeric, description LIMIT 50",
)
def best_deals(spark, sf_dir):
    found = deals.best_deals(deals.with_verdict(predicted(spark, sf_dir)), KEY, 50)
    return found.select("row_key", "city", F.round("delta_pct", 6).alias("delta_pct"))


_NORM_TERMS = ", ".join(
    f"round(coalesce(CAST({m} AS DOUBLE), 0) / (CASE WHEN t_{m} = 0 THEN 1 ELSE t_{m} END) * 100, 6) AS {m}_pct"
    for m in ("price_numeric", "area_sqm", "bedrooms", "bathrooms", "amenity_score")
)


@query(
    "compare_norm",
    """, s AS (SELECT row_key, city, price_numeric, nullif(area_sqm, 0) AS area_sqm, nullif(bedrooms, 0) AS bedrooms, bathrooms,
      CAST(CASE WHEN contains(amenities, 'Pool') THEN 1 ELSE 0 END + CASE WHEN contains(amenities, 'Elevator') THEN 1 ELSE 0 END AS INT) AS amenity_score FROM listings_fx),
    m AS (SELECT *, max(price_numeric) OVER w AS t_price_numeric, max(coalesce(area_sqm, 1)) OVER w AS t_area_sqm, max(coalesce(bedrooms, 1)) OVER w AS t_bedrooms,
      max(bathrooms) OVER w AS t_bathrooms, max(amenity_score) OVER w AS t_amenity_score FROM s WINDOW w AS (PARTITION BY city))
    SELECT row_key, """
    + _NORM_TERMS
    + " FROM m",
)
def compare_norm(spark, sf_dir):
    score = F.contains("amenities", F.lit("Pool")).cast("int") + F.contains("amenities", F.lit("Elevator")).cast("int")
    df = listings(spark, sf_dir).withColumns(
        {
            "area_sqm": F.nullif("area_sqm", F.lit(0.0)),
            "bedrooms": F.nullif("bedrooms", F.lit(0)),
            "amenity_score": score,
        }
    )
    found = deals.normalise_to_max(df, "city")
    return found.select("row_key", *[F.round(f"{m}_pct", 6).alias(f"{m}_pct") for m in vocab.COMPARE_MEASURES])


_CELLS = [
    ("Type", "property_type"), ("City", "city"), ("Gov.", "governorate"),
    ("Price (EGP)", "format('{:,}', CAST(round_even(price_numeric, 0) AS BIGINT))"),
    ("Area (sqm)", "CAST(area_sqm AS STRING)"), ("Beds", "CAST(bedrooms AS STRING)"), ("Baths", "CAST(bathrooms AS STRING)"),
    ("Finish", "finish_truth"), ("View", "NULL"), ("Compound", "NULL"), ("Amenities", "NULL"),
]
_CELLS_SQL = " UNION ALL ".join(
    f"SELECT CAST({i} AS INT) AS position, '{label}' AS feature, id, coalesce({value}, '---') AS value FROM t WHERE id IN (3, 14, 159, 265)"
    for i, (label, value) in enumerate(_CELLS)
)


@query(
    "compare_transposed",
    f""", t AS (SELECT row_number() OVER (ORDER BY row_key, price_numeric, description) AS id, * FROM listings_fx), c AS ({_CELLS_SQL})
    SELECT position, feature, """
    + ", ".join(f"""max(CASE WHEN id = {i} THEN value END) AS "Apt #{i}" """ for i in (3, 14, 159, 265))
    + " FROM c GROUP BY position, feature",
)
def compare_transposed(spark, sf_dir):
    shown = ["property_type", "city", "governorate", "area_sqm", "bedrooms", "bathrooms", "finish_truth"]
    df = numbered(spark, sf_dir, shown).withColumnRenamed("finish_truth", "finish_type")
    return deals.comparison_table(df, [3, 14, 159, 265])


@query(
    "labels_from_flags",
    """SELECT row_key, CASE WHEN furnished = 'yes' THEN 'yes' WHEN furnished = 'no' THEN 'no' ELSE 'unknown' END AS furnished, ownership,
    payment_option, completion_status, seller_type FROM listings_fx""",
)
def labels_from_flags(spark, sf_dir):
    return deals.labels_from_flags(one_hot(listings(spark, sf_dir))).select(
        "row_key", "furnished", "ownership", "payment_option", "completion_status", "seller_type"
    )


@query(
    "completed_requests",
    """, c AS (SELECT city, median(latitude) AS lat, median(longitude) AS lon FROM listings_fx GROUP BY city)
    SELECT s_suppkey, n_name AS city, round(coalesce(lat, 30.05), 8) AS latitude, round(coalesce(lon, 31.25), 8) AS longitude, 'unknown' AS compound_name, 'agency' AS seller_type,
    CAST(0 AS DOUBLE) AS delivery_date, false AS roof
    FROM (SELECT s_suppkey, CASE WHEN s_suppkey % 7 = 0 THEN 'ATLANTIS' ELSE n_name END AS n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey) LEFT JOIN c ON n_name = c.city""",
)
def completed_requests(spark, sf_dir):
    coordinates = market.city_coordinates(listings(spark, sf_dir))
    partial = (
        read(spark, sf_dir, "supplier")
        .join(read(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .select("s_suppkey", F.when(F.col("s_suppkey") % 7 == 0, "ATLANTIS").otherwise(F.col("n_name")).alias("city"))
    )
    found = deals.complete_requests(partial, coordinates)
    return found.select(
        "s_suppkey", "city", F.round("latitude", 8).alias("latitude"), F.round("longitude", 8).alias("longitude"),
        "compound_name", "seller_type", "delivery_date", "roof",
    )


@query(
    "validated_requests",
    """SELECT row_key, TRY_CAST(CASE WHEN part_no % 11 = 0 THEN 'many' ELSE CAST(bedrooms AS STRING) END AS DOUBLE) AS bedrooms,
    concat_ws(',', CASE WHEN part_no % 11 = 0 THEN 'bedrooms' END, CASE WHEN finish_truth IS NULL THEN 'finish_type' END, CASE WHEN furnished IS NULL THEN 'furnished' END) AS errors
    FROM listings_fx""",
)
def validated_requests(spark, sf_dir):
    raw = listings(spark, sf_dir).select(
        "row_key",
        F.when(F.col("part_no") % 11 == 0, "many").otherwise(F.col("bedrooms").cast("string")).alias("bedrooms"),
        F.col("bathrooms").cast("string").alias("bathrooms"),
        F.col("area_sqm").alias("area_numeric"),
        "latitude", "longitude", "property_type", "city", "governorate",
        F.col("finish_truth").alias("finish_type"),
        "seller_name", F.lit("sea").alias("view_type"), F.lit("unknown").alias("compound_name"),
        F.col("delivery_months").alias("delivery_date"),
        "seller_type", "furnished", "ownership", "payment_option", "completion_status",
    )
    return validate_requests(raw).select("row_key", "bedrooms", F.array_join("errors", ",").alias("errors"))
