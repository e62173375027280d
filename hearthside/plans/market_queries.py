"""Market reports."""

from pyspark.sql import functions as F

from hearthside import vocab
from hearthside.functions.text import amenity_flags
from hearthside.operators import clean, market
from hearthside.operators.quantiles import exact_quantiles
from hearthside.plans.fixture import LISTED_AMENITIES, listings
from hearthside.plans.registry import query

_PPSQM = ", v AS (SELECT *, price_numeric / area_sqm AS ppsqm FROM listings_fx WHERE area_sqm > 0)"


@query(
    "market_median_ppsqm_by_city",
    _PPSQM + "SELECT city, round_even(median(ppsqm), 0) AS ppsqm FROM v GROUP BY city ORDER BY ppsqm DESC, city LIMIT 25",
)
def median_ppsqm_by_city(spark, sf_dir):
    return market.priciest(listings(spark, sf_dir), "city", 25)


@query(
    "market_stats",
    """SELECT count(*) AS total_listings, round(avg(price_numeric), 4) AS avg_price, count(DISTINCT governorate) AS num_governorates,
    count(DISTINCT city) AS num_cities, round(median(price_numeric), 4) AS median_price, round(median(area_sqm), 4) AS avg_area FROM listings_fx""",
)
def stats(spark, sf_dir):
    found = market.headline_stats(listings(spark, sf_dir))
    return found.withColumns({c: F.round(c, 4) for c in ("avg_price", "median_price", "avg_area")})


@query(
    "market_avg_by_governorate",
    "SELECT governorate, round_even(avg(price_numeric), 0) AS avg_price FROM listings_fx GROUP BY governorate",
)
def avg_by_governorate(spark, sf_dir):
    return market.group_mean(listings(spark, sf_dir), "governorate", F.col("price_numeric"), "avg_price")


@query(
    "market_value_counts",
    "SELECT furnished, count(*) AS n FROM listings_fx WHERE furnished IS NOT NULL GROUP BY furnished",
)
def furnished_counts(spark, sf_dir):
    return market.value_counts(listings(spark, sf_dir), "furnished")


@query("market_property_types", "SELECT property_type, count(*) AS n FROM listings_fx GROUP BY property_type")
def property_types(spark, sf_dir):
    return market.value_counts(listings(spark, sf_dir), "property_type")


@query("market_governorates", "SELECT DISTINCT governorate FROM listings_fx")
def governorates(spark, sf_dir):
    return market.distinct_values(listings(spark, sf_dir), "governorate")


@query("affordable_cities", _PPSQM + "SELECT city, round(median(ppsqm), 4) AS ppsqm FROM v GROUP BY city ORDER BY median(ppsqm), city LIMIT 15")
def affordable(spark, sf_dir):
    return market.affordable(listings(spark, sf_dir)).withColumn("ppsqm", F.round("ppsqm", 4))


@query(
    "premium_cities",
    _PPSQM + "SELECT city, round(median(ppsqm), 4) AS ppsqm FROM v GROUP BY city ORDER BY median(ppsqm) DESC, city DESC LIMIT 15",
)
def premium(spark, sf_dir):
    return market.premium(listings(spark, sf_dir)).withColumn("ppsqm", F.round("ppsqm", 4))


@query("price_by_bedrooms", "SELECT bedrooms, round(median(price_numeric), 4) AS median_price FROM listings_fx GROUP BY bedrooms")
def by_bedrooms(spark, sf_dir):
    return market.price_by_bedrooms(listings(spark, sf_dir)).withColumn("median_price", F.round("median_price", 4))


@query(
    "finish_price",
    _PPSQM + "SELECT finish_truth AS finish_type, round(median(ppsqm), 4) AS ppsqm FROM v WHERE finish_truth IS NOT NULL GROUP BY finish_truth",
)
def by_finish(spark, sf_dir):
    df = listings(spark, sf_dir).withColumnRenamed("finish_truth", "finish_type")
    return market.price_by_finish(df).withColumn("ppsqm", F.round("ppsqm", 4))


_AMENITY_SQL = " UNION ALL ".join(
    f"SELECT '{a}' AS amenity, round(100.0 * avg(CASE WHEN contains(lower(listed_amenities), '{a.lower()}') THEN 1.0 ELSE 0.0 END), 6) AS pct FROM listings_fx"
    for a in LISTED_AMENITIES
)


@query("amenity_share", _AMENITY_SQL)
def amenity_share(spark, sf_dir):
    df = listings(spark, sf_dir).select(
        *[f.cast("int").alias(n) for n, f in amenity_flags(F.col("listed_amenities")).items()]
    )
    return market.amenity_share(df, vocab.AMENITY_NAMES).withColumn("pct", F.round("pct", 6))


_BUDGET = ", b AS (SELECT * FROM listings_fx WHERE area_sqm > 0 AND price_numeric BETWEEN 30000 * (1 - 0.15) AND 30000 * (1 + 0.15))"


@query(
    "budget_summary",
    _BUDGET
    + """SELECT count(*) AS listings, median(area_sqm) AS median_area, median(CAST(bedrooms AS DOUBLE)) AS median_bedrooms,
    median(CAST(bathrooms AS DOUBLE)) AS median_bathrooms FROM b HAVING count(*) > 5""",
)
def budget_summary(spark, sf_dir):
    return market.budget_summary(listings(spark, sf_dir), 30000)


@query("budget_top_cities", _BUDGET + "SELECT city, count(*) AS n FROM b GROUP BY city ORDER BY n DESC, city LIMIT 5")
def budget_top_cities(spark, sf_dir):
    return market.budget_cities(listings(spark, sf_dir), 30000)


@query(
    "city_coords",
    "SELECT city, round(median(latitude), 8) AS latitude, round(median(longitude), 8) AS longitude FROM listings_fx GROUP BY city",
)
def city_coords(spark, sf_dir):
    found = market.city_coordinates(listings(spark, sf_dir))
    return found.withColumns({c: F.round(c, 8) for c in ("latitude", "longitude")})


@query(
    "geo_grid",
    """SELECT CAST(floor(latitude / 0.25) AS BIGINT) AS lat_cell, CAST(floor(longitude / 0.25) AS BIGINT) AS lon_cell, count(*) AS listings,
    round(avg(price_numeric / 1e6), 8) AS mean_weight FROM listings_fx WHERE area_sqm > 0 GROUP BY 1, 2""",
)
def geo_grid(spark, sf_dir):
    return market.geo_grid(listings(spark, sf_dir)).withColumn("mean_weight", F.round("mean_weight", 8))


_SAMPLE = ", s AS (SELECT * FROM listings_fx WHERE area_sqm > 0 ORDER BY md5(concat('42:', row_key)), row_key LIMIT 2000)"


@query("heat_points", _SAMPLE + "SELECT row_key, latitude, longitude, price_numeric / 1e6 AS weight FROM s")
def heat_points(spark, sf_dir):
    return market.heat_points(listings(spark, sf_dir), "row_key")


@query("map_centre", "SELECT round(median(latitude), 8) AS latitude, round(median(longitude), 8) AS longitude FROM listings_fx WHERE area_sqm > 0")
def map_centre(spark, sf_dir):
    found = market.map_centre(market.on_map(listings(spark, sf_dir)))
    return found.withColumns({c: F.round(c, 8) for c in ("latitude", "longitude")})


def _histogram_sql(value: str, bins: int, digits: int = 4) -> str:
    return f""", e AS (SELECT min({value}) AS a, max({value}) AS b FROM listings_fx),
    c AS (SELECT CAST(least(floor(({value} - a) / (b - a) * {bins}), {bins - 1}) AS INT) AS bin, count(*) AS n FROM listings_fx, e GROUP BY 1),
    r AS (SELECT CAST(unnest(range(0, {bins})) AS INT) AS bin)
    SELECT r.bin, round(a + r.bin * ((b - a) / {bins}), {digits}) AS low, round(a + (r.bin + 1) * ((b - a) / {bins}), {digits}) AS high,
    coalesce(n, 0) AS n FROM r CROSS JOIN e LEFT JOIN c ON r.bin = c.bin"""


@query("price_histogram", _histogram_sql("price_numeric", 60))
def price_histogram(spark, sf_dir):
    found = market.histogram(listings(spark, sf_dir), F.col("price_numeric"), 60)
    return found.withColumns({c: F.round(c, 4) for c in ("low", "high")})


@query("log_price_histogram", _histogram_sql("ln(1 + price_numeric)", 60))
def log_price_histogram(spark, sf_dir):
    found = market.histogram(listings(spark, sf_dir), F.log1p("price_numeric"), 60)
    return found.withColumns({c: F.round(c, 4) for c in ("low", "high")})


@query(
    "crawl_summary",
    """, p AS (SELECT *, CASE WHEN area_sqm > 0 THEN CAST(format('{:.2f}', price_numeric / area_sqm) AS DOUBLE) END AS price_per_sqm FROM listings_fx)
    SELECT count(*) AS total, round(avg(price_numeric), 4) AS avg_price, min(price_numeric) AS min_price, max(price_numeric) AS max_price,
    round(avg(price_per_sqm), 2) AS avg_price_per_sqm FROM p""",
)
def crawl_summary(spark, sf_dir):
    from hearthside.functions.features import price_per_sqm

    df = listings(spark, sf_dir).withColumn("price_per_sqm", price_per_sqm(F.col("price_numeric"), F.col("area_sqm")))
    found = market.crawl_summary(df)
    return found.withColumns({"avg_price": F.round("avg_price", 4), "avg_price_per_sqm": F.round("avg_price_per_sqm", 2)})


@query("common_cities", "SELECT city, count(*) AS n FROM listings_fx WHERE city != '' GROUP BY city ORDER BY n DESC, city LIMIT 10")
def common_cities(spark, sf_dir):
    return market.common_cities(listings(spark, sf_dir))


@query(
    "price_quartiles",
    "SELECT governorate, round(quantile_cont(price_numeric, 0.25), 4) AS q25, round(quantile_cont(price_numeric, 0.75), 4) AS q75 FROM listings_fx GROUP BY governorate",
)
def price_quartiles(spark, sf_dir):
    found = exact_quantiles(listings(spark, sf_dir), ["governorate"], {"q": F.col("price_numeric")}, [0.25, 0.75])
    return found.select("governorate", F.round(F.col("q")[0], 4).alias("q25"), F.round(F.col("q")[1], 4).alias("q75"))


_DESCRIBE = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count({c}) AS n, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS std,
    CAST(min({c}) AS DOUBLE) AS "min", CAST(max({c}) AS DOUBLE) AS "max" FROM listings_fx"""
    for c in ("price_numeric", "area_sqm", "bedrooms")
)


@query("describe_numbers", _DESCRIBE)
def describe(spark, sf_dir):
    found = clean.describe_numbers(listings(spark, sf_dir), ["price_numeric", "area_sqm", "bedrooms"])
    return found.withColumns({c: F.round(c, 4) for c in ("mean", "std")})


_TEXTS = ["city", "governorate", "property_type", "seller_name", "furnished", "title"]


@query(
    "unique_counts",
    " UNION ALL ".join(f"""SELECT '{c}' AS "column", count(DISTINCT {c}) AS n FROM listings_fx""" for c in _TEXTS),
)
def unique_counts(spark, sf_dir):
    return clean.unique_counts(listings(spark, sf_dir), _TEXTS)


@query(
    "column_modes",
    " UNION ALL ".join(
        f"""(SELECT '{c}' AS "column", {c} AS mode, count(*) AS n FROM listings_fx WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY n DESC, {c} LIMIT 1)"""
        for c in _TEXTS
    ),
)
def column_modes(spark, sf_dir):
    return clean.column_modes(listings(spark, sf_dir), _TEXTS)
