"""Cleaning, coverage, engineered features and the second extraction pass."""

from pyspark.sql import functions as F

from hearthside import vocab
from hearthside.functions.extract import enrich, extract
from hearthside.functions.features import engineer, one_hot, price_per_sqm, price_from_log
from hearthside.functions.truth import either, text_to_boolean
from hearthside.operators import clean, gaps, quality
from hearthside.plans.fixture import COMPOUND_SQL, listings, text_listings
from hearthside.plans.registry import KEY, query
from hearthside.session import cut_lineage

_GAPPY = """, g AS (SELECT row_key, furnished, finish_truth, nullif(area_sqm, 0) AS area_sqm, nullif(bedrooms, 0) AS bedrooms,
    CASE WHEN part_no % 3 = 0 THEN city END AS city, price_numeric, bathrooms FROM listings_fx)"""


def gappy(spark, sf_dir):
    return listings(spark, sf_dir).select(
        "row_key", "furnished", "finish_truth",
        F.nullif("area_sqm", F.lit(0.0)).alias("area_sqm"),
        F.nullif("bedrooms", F.lit(0)).alias("bedrooms"),
        F.when(F.col("part_no") % 3 == 0, F.col("city")).alias("city"),
        "price_numeric", "bathrooms",
    )


_GAPPY_COLUMNS = ["row_key", "furnished", "finish_truth", "area_sqm", "bedrooms", "city", "price_numeric", "bathrooms"]


@query(
    "null_report",
    _GAPPY
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) FILTER ({c} IS NULL) AS nulls, round(count(*) FILTER ({c} IS NULL) * 100.0 / count(*), 6) AS null_pct FROM g"""
        for c in _GAPPY_COLUMNS
    ),
)
def null_report(spark, sf_dir):
    return clean.null_report(gappy(spark, sf_dir)).withColumn("null_pct", F.round("null_pct", 6))


@query("drop_sparse", _GAPPY + "SELECT row_key, furnished, finish_truth, area_sqm, bedrooms, price_numeric, bathrooms FROM g")
def drop_sparse(spark, sf_dir):
    return clean.drop_sparse(gappy(spark, sf_dir), 60.0)


@query(
    "coverage_report",
    " UNION ALL ".join(
        f"SELECT '{f}' AS feature, count(*) FILTER ({test}) AS filled, round(count(*) FILTER ({test}) * 100.0 / count(*), 6) AS pct FROM listings_fx"
        for f, test in [
            ("finish_type", "finish_truth IS NOT NULL"),
            ("compound_name", f"({COMPOUND_SQL}) IS NOT NULL"),
            ("down_payment_egp", "part_no <> 0"),
            ("installment_years", "false"),
            ("monthly_installment_egp", "false"),
            ("floor_number", "size_no <> 0"),
            ("delivery_date", "true"),
            ("view_type", "line_no % 4 <> 3"),
            ("has_garden", "line_no % 4 = 0"),
            ("has_roof", "false"),
            ("has_elevator", "false"),
            ("has_parking", "false"),
            ("has_pool", "line_no % 4 = 2"),
            ("has_security", "false"),
        ]
    ),
)
def coverage_report(spark, sf_dir):
    df = enrich(text_listings(spark, sf_dir).select("title", "description"))
    return quality.coverage(df).withColumn("pct", F.round("pct", 6))


@query(
    "newly_filled",
    "SELECT 'finish_type' AS feature, count(*) FILTER (part_no % 2 = 0 AND finish_truth IS NOT NULL) AS filled, "
    "round(count(*) FILTER (part_no % 2 = 0 AND finish_truth IS NOT NULL) * 100.0 / count(*), 6) AS pct FROM listings_fx",
)
def newly_filled(spark, sf_dir):
    before = F.when(F.col("part_no") % 2 == 0, F.lit("")).otherwise(F.lit("lux"))
    df = extract(text_listings(spark, sf_dir).withColumn("before", before))
    return quality.newly_filled(df, {"finish_type": ("before", "found_finish_type")}).withColumn("pct", F.round("pct", 6))


@query(
    "crawl_coverage",
    " UNION ALL ".join(
        f"SELECT '{f}' AS feature, count(*) FILTER ({t}) AS filled, round(count(*) FILTER ({t}) * 100.0 / count(*), 6) AS pct FROM listings_fx"
        for f, t in [
            ("price", "price_numeric <> 0"), ("bedrooms", "bedrooms <> 0"), ("area", "area_sqm <> 0"),
            ("price_per_sqm", "area_sqm > 0"), ("city", "city <> ''"), ("geo", "latitude <> 0"),
            ("property_type", "property_type <> ''"), ("seller_type", "seller_type <> ''"), ("description", "length(description) > 30"),
        ]
    ),
)
def crawl_coverage(spark, sf_dir):
    df = listings(spark, sf_dir).withColumn("area_numeric", F.col("area_sqm"))
    df = df.withColumn("price_per_sqm", price_per_sqm(F.col("price_numeric"), F.col("area_sqm")))
    return quality.crawl_coverage(df).withColumn("pct", F.round("pct", 6))


@query(
    "fill_constants",
    "SELECT row_key, coalesce(furnished, 'Unknown') AS furnished, coalesce(finish_truth, 'Unknown') AS finish_type FROM listings_fx",
)
def fill_constants(spark, sf_dir):
    return clean.fill_constants(listings(spark, sf_dir).select("row_key", "furnished", F.col("finish_truth").alias("finish_type")))


@query(
    "fill_mean",
    _GAPPY + "SELECT row_key, round(coalesce(area_sqm, (SELECT avg(area_sqm) FROM g)), 6) AS area_sqm, round(coalesce(CAST(bedrooms AS DOUBLE), (SELECT avg(bedrooms) FROM g)), 6) AS bedrooms FROM g",
)
def fill_mean(spark, sf_dir):
    filled = clean.fill_with_mean(gappy(spark, sf_dir).select("row_key", "area_sqm", "bedrooms"))
    return filled.withColumns({c: F.round(c, 6) for c in ("area_sqm", "bedrooms")})


@query(
    "fill_mode",
    _GAPPY
    + "SELECT row_key, "
    + ", ".join(
        f"coalesce({c}, (SELECT {c} FROM g WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)) AS {c}"
        for c in ("furnished", "finish_truth", "city")
    )
    + " FROM g",
)
def fill_mode(spark, sf_dir):
    df = gappy(spark, sf_dir).select("row_key", "furnished", "finish_truth", "city")
    return clean.fill_with_mode(df, ["furnished", "finish_truth", "city"])


@query(
    "booleans_from_text",
    "SELECT row_key, CASE line_no % 4 WHEN 0 THEN true WHEN 1 THEN false WHEN 2 THEN true END AS has_roof FROM listings_fx",
)
def booleans_from_text(spark, sf_dir):
    line = F.col("line_no") % 4
    word = F.when(line == 0, "True").when(line == 1, "FALSE").when(line == 2, "true").otherwise("maybe")
    return clean.booleans_from_text(listings(spark, sf_dir).select("row_key", word.alias("has_roof")), ["has_roof"])


@query(
    "three_valued_or",
    """, f AS (SELECT row_key, CASE line_no % 3 WHEN 0 THEN true WHEN 1 THEN false END AS a, CASE size_no % 3 WHEN 0 THEN true WHEN 1 THEN false END AS b FROM listings_fx)
    SELECT row_key, CASE WHEN a OR b THEN true WHEN a IS NOT NULL OR b IS NOT NULL THEN false END AS either FROM f""",
)
def three_valued_or(spark, sf_dir):
    a = F.when(F.col("line_no") % 3 == 0, "true").when(F.col("line_no") % 3 == 1, "false")
    b = F.when(F.col("size_no") % 3 == 0, "true").when(F.col("size_no") % 3 == 1, "false")
    return listings(spark, sf_dir).select("row_key", either(text_to_boolean(a), text_to_boolean(b)).alias("either"))


@query(
    "outlier_iqr",
    """, x AS (SELECT row_key, CASE WHEN part_no % 37 = 0 THEN price_numeric * 10000 WHEN part_no % 41 = 0 THEN price_numeric / 10000 ELSE price_numeric END AS price_numeric FROM listings_fx),
    q AS (SELECT quantile_cont(ln(1 + price_numeric), 0.25) AS q1, quantile_cont(ln(1 + price_numeric), 0.75) AS q3 FROM x)
    SELECT row_key, price_numeric FROM x, q WHERE ln(1 + price_numeric) BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)""",
)
def outlier_iqr(spark, sf_dir):
    price, part = F.col("price_numeric"), F.col("part_no")
    skewed = F.when(part % 37 == 0, price * 10000).when(part % 41 == 0, price / 10000).otherwise(price)
    return clean.drop_outliers(listings(spark, sf_dir).select("row_key", skewed.alias("price_numeric")))


_HOT = [(c, v) for c, values in vocab.ONE_HOT_VALUES.items() for v in values]


@query(
    "one_hot",
    "SELECT row_key, "
    + ", ".join(f"""CASE WHEN {c} = '{v}' THEN 1 ELSE 0 END AS "{c}_{v}" """ for c, v in _HOT)
    + " FROM listings_fx",
)
def one_hot_flags(spark, sf_dir):
    return one_hot(listings(spark, sf_dir)).select("row_key", *[F.col(f"`{c}_{v}`") for c, v in _HOT])


@query(
    "ratio_features",
    f"""SELECT row_key, round(area_sqm / (CASE WHEN bedrooms = 0 THEN 0.5 ELSE bedrooms END), 8) AS area_per_bedroom,
    round(area_sqm / (CASE WHEN bathrooms = 0 THEN 0.5 ELSE bathrooms END), 8) AS area_per_bathroom,
    round(CAST(bedrooms AS DOUBLE) / (CASE WHEN bathrooms = 0 THEN 0.5 ELSE bathrooms END), 8) AS bed_bath_ratio, CAST(bedrooms + bathrooms AS DOUBLE) AS total_rooms,
    CAST(CASE WHEN contains(amenities, 'Pool') THEN 1 ELSE 0 END + CASE WHEN contains(amenities, 'Elevator') THEN 1 ELSE 0 END + CASE WHEN contains(amenities, 'Security') THEN 1 ELSE 0 END AS INT) AS amenity_score,
    CASE WHEN lower(coalesce({COMPOUND_SQL}, 'Unknown')) <> 'unknown' THEN 1 ELSE 0 END AS is_compound,
    CASE WHEN delivery_months <= 0.5 THEN 0 WHEN delivery_months <= 12 THEN 1 WHEN delivery_months <= 24 THEN 2 ELSE 3 END AS delivery_bucket FROM listings_fx""",
)
def ratio_features(spark, sf_dir):
    df = text_listings(spark, sf_dir).select(
        "row_key", "title", "description", "area_sqm", "bedrooms", "bathrooms", "amenities", "delivery_months"
    )
    df = clean.split_amenities(clean.fill_constants(enrich(df).withColumn("delivery_date", F.col("delivery_months"))))
    made = engineer(df)
    return made.select(
        "row_key", *[F.round(c, 8).alias(c) for c in ("area_per_bedroom", "area_per_bathroom", "bed_bath_ratio")],
        "total_rooms", "amenity_score", "is_compound", "delivery_bucket",
    )


@query("renamed_columns", "SELECT row_key AS \"Row\", city AS \"City\", bedrooms AS \"Beds_Total\", bathrooms AS \"Bath Rooms\" FROM listings_fx")
def renamed_columns(spark, sf_dir):
    """Report names first, then underscores only for names the reader of the table knows."""
    df = listings(spark, sf_dir).select("row_key", "city", "bedrooms", "bathrooms")
    shown = clean.renamed(df, {"row_key": "Row", "city": "City", "bedrooms": "Beds Total", "bathrooms": "Bath Rooms"})
    return clean.underscored(shown, ["Beds_Total", "Row"])


@query("typed_columns", "SELECT price_numeric, area_sqm, bedrooms, bathrooms FROM listings_fx")
def typed_columns(spark, sf_dir):
    df = listings(spark, sf_dir).select("row_key", "city", "price_numeric", "area_sqm", "bedrooms", "bathrooms")
    return clean.only(df, "number")


@query(
    "price_per_sqm",
    """SELECT row_key, CASE WHEN area_sqm > 0 THEN CAST(format('{:.2f}', price_numeric / area_sqm) AS DOUBLE) END AS price_per_sqm,
    round(exp(ln(1 + price_numeric)) - 1, 4) AS round_trip FROM listings_fx""",
)
def per_sqm(spark, sf_dir):
    price = F.col("price_numeric")
    return listings(spark, sf_dir).select(
        "row_key", price_per_sqm(price, F.col("area_sqm")).alias("price_per_sqm"),
        F.round(price_from_log(F.log1p(price)), 4).alias("round_trip"),
    )


@query(
    "flags_merged",
    """SELECT row_key, CASE WHEN contains(amenities, 'Pool') OR line_no % 4 = 2 THEN 1 ELSE 0 END AS "Pool", CASE WHEN line_no % 4 = 0 THEN 1 ELSE 0 END AS "Private Garden",
    CASE WHEN contains(amenities, 'Elevator') THEN 1 ELSE 0 END AS "Elevator", CASE WHEN contains(amenities, 'Security') THEN 1 ELSE 0 END AS "Security", 0 AS "Covered Parking", 0 AS roof FROM listings_fx""",
)
def flags_merged(spark, sf_dir):
    df = enrich(text_listings(spark, sf_dir).select("row_key", "title", "description", "amenities"))
    merged = clean.booleans_to_int(clean.merge_text_flags(clean.split_amenities(df)))
    return merged.select("row_key", "Pool", "Private Garden", "Elevator", "Security", "Covered Parking", "roof")


def enriched(spark, sf_dir):
    """The first extraction pass, stored as it would be: later passes read only what they need."""
    df = text_listings(spark, sf_dir).select("row_key", "title", "description", "price_numeric")
    return cut_lineage(enrich(df))


@query("gap_rows", f"SELECT row_key FROM listings_fx WHERE finish_truth IS NULL OR ({COMPOUND_SQL}) IS NULL")
def gap_rows(spark, sf_dir):
    return gaps.rows_with_gaps(enriched(spark, sf_dir)).select("row_key")


@query(
    "gap_rows_left",
    f"SELECT row_key FROM listings_fx WHERE (finish_truth IS NULL OR ({COMPOUND_SQL}) IS NULL) AND row_key NOT IN (SELECT row_key FROM listings_fx WHERE order_no % 4 = 0)",
)
def gap_rows_left(spark, sf_dir):
    df = enriched(spark, sf_dir)
    done = listings(spark, sf_dir).where("order_no % 4 = 0").select("row_key")
    return gaps.not_yet_done(gaps.rows_with_gaps(df), done, "row_key").select("row_key")


_BATCHES = f""", gap AS (SELECT * FROM listings_fx WHERE finish_truth IS NULL OR ({COMPOUND_SQL}) IS NULL),
    n AS (SELECT *, row_number() OVER (ORDER BY row_key, price_numeric, description) - 1 AS i FROM gap),
    b AS (SELECT CAST(i // 10 AS BIGINT) AS batch, CAST(i % 10 AS INT) AS position, row_key, title, description, finish_truth FROM n),
    p AS (SELECT batch, CAST(count(*) AS INT) AS n, concat('Extract features from these ', count(*), ' apartment listings.', chr(10), 'Return ONLY a JSON array of ', count(*), ' objects.', chr(10), chr(10),
      string_agg(concat('=== Listing ', position + 1, ' ===', chr(10), substr(concat(title, chr(10), description), 1, 800)), concat(chr(10), chr(10)) ORDER BY position)) AS prompt FROM b GROUP BY batch)"""


def _gap_batches(df):
    return gaps.request_texts(gaps.rows_with_gaps(df), "row_key", KEY)


@query("prompt_batches", _BATCHES + "SELECT batch, n, prompt FROM p")
def prompt_batches(spark, sf_dir):
    return _gap_batches(enriched(spark, sf_dir)).select("batch", "n", "prompt")


@query(
    "reply_merge",
    _BATCHES
    + f""", k AS (SELECT b.row_key, b.batch, b.position FROM b JOIN p ON b.batch = p.batch WHERE b.batch % 5 <> 0 AND (p.n = 1 OR b.batch % 5 <> 1))
    SELECT l.row_key, coalesce(l.finish_truth, CASE WHEN k.row_key IS NOT NULL THEN 'lux' END) AS finish_type,
    coalesce({COMPOUND_SQL.replace('supp_no', 'l.supp_no')}, CASE WHEN k.row_key IS NOT NULL THEN concat('Compound ', k.position) END) AS compound_name
    FROM listings_fx l LEFT JOIN k ON l.row_key = k.row_key""",
)
def reply_merge(spark, sf_dir):
    """Replies made from the requests: some broken, some with too few items, some lone objects."""
    df = enriched(spark, sf_dir)
    requests = _gap_batches(df)
    items = F.transform(
        F.sequence(F.lit(0), F.col("n") - 1),
        lambda i: F.concat(F.lit('{"finish_type": "lux", "compound_name": "Compound '), i.cast("string"), F.lit('"}')),
    )
    array_text = F.concat(F.lit(" ["), F.array_join(items, ","), F.lit("]"))
    reply = (
        F.when(F.col("batch") % 5 == 0, F.lit("sorry, no"))
        .when(F.col("batch") % 5 == 1, F.lit('{"finish_type": "lux", "compound_name": "Compound 0"}'))
        .otherwise(array_text)
    )
    answers = gaps.accepted(gaps.parse_replies(requests.withColumn("reply", reply)))
    return gaps.merge_replies(df, answers, "row_key").select("row_key", "finish_type", "compound_name")
