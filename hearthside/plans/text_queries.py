"""Text functions and free-text extraction.

Expected values of the extraction come from the columns the text was built from, so
the check does not depend on a second regular-expression dialect.
"""

from pyspark.sql import functions as F

from hearthside import vocab
from hearthside.functions import text
from hearthside.functions.dates import posted_date, with_delivery_months
from hearthside.functions.extract import Reader, enrich
from hearthside.functions.features import delivery_bucket
from hearthside.operators.quality import unread_report
from hearthside.plans.fixture import (
    ARABIC_FINISH_SQL,
    AS_OF,
    COMPOUND_SQL,
    DELIVERY_SQL,
    LISTED_AMENITIES,
    read,
    text_listings,
)
from hearthside.plans.registry import query


@query(
    "text_clean",
    "SELECT doc_id, trim(regexp_replace(text, '[\\s\\x{A0}]+', ' ', 'g')) AS cleaned FROM documents",
    listings=False,
)
def text_clean(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", text.clean_text(F.col("text")).alias("cleaned"))


@query(
    "digits_normalised",
    "SELECT doc_id, translate(translate(text, '0123456789', '٠١٢٣٤٥٦٧٨٩'), '٠١٢٣٤٥٦٧٨٩', '0123456789') AS digits FROM documents",
    listings=False,
)
def digits_normalised(spark, sf_dir):
    arabic = F.translate("text", vocab.ASCII_DIGITS, vocab.ARABIC_DIGITS)
    return read(spark, sf_dir, "documents").select("doc_id", text.ascii_digits(arabic).alias("digits"))


@query(
    "numbers_parsed",
    """SELECT row_key, CASE WHEN part_no % 9 = 0 THEN NULL ELSE CAST(part_no AS DOUBLE) * 1000 + 0.5 END AS price, CAST(size_no AS DOUBLE) AS area,
    CAST(NULL AS DOUBLE) AS broken FROM listings_fx""",
)
def numbers_parsed(spark, sf_dir):
    part = F.col("part_no").cast("string")
    price = F.when(F.col("part_no") % 9 == 0, F.lit("ask")).otherwise(F.concat(F.lit("EGP "), part, F.lit(",000.5")))
    area = F.concat(F.translate(F.col("size_no").cast("string"), vocab.ASCII_DIGITS, vocab.ARABIC_DIGITS), F.lit(" SQM"))
    return text_listings(spark, sf_dir).select(
        "row_key",
        text.parse_number(price).alias("price"),
        text.parse_number(area).alias("area"),
        text.parse_number(F.concat(F.lit("1.2."), part)).alias("broken"),
    )


@query("ad_ids", "SELECT row_key, CASE WHEN part_no % 4 = 0 THEN '' ELSE CAST(order_no AS STRING) END AS ad_id FROM listings_fx")
def ad_ids(spark, sf_dir):
    order = F.col("order_no").cast("string")
    url = F.when(F.col("part_no") % 4 == 0, F.concat(F.lit("/en/ad/flat-"), order, F.lit(".html"))).otherwise(
        F.concat(F.lit("/en/ad/flat-ID"), order, F.lit(".html"))
    )
    return text_listings(spark, sf_dir).select("row_key", text.ad_id(url).alias("ad_id"))


@query("lower_text", "SELECT row_key, lower(city) AS city, lower(title) AS title, bedrooms FROM listings_fx")
def lower_text(spark, sf_dir):
    df = text_listings(spark, sf_dir).select("row_key", "city", "title", "bedrooms")
    return text.lower_text(df)


@query(
    "amenity_flags",
    "SELECT row_key, "
    + ", ".join(f"""contains(lower(listed_amenities), '{a.lower()}') AS "{a}" """ for a in LISTED_AMENITIES)
    + " FROM listings_fx",
)
def amenity_flags(spark, sf_dir):
    flags = text.amenity_flags(F.col("listed_amenities"))
    return text_listings(spark, sf_dir).select("row_key", *[f.alias(n) for n, f in flags.items()])


@query("seller_prefix", "SELECT row_key, lower(seller_name) AS seller_name FROM listings_fx")
def seller_prefix(spark, sf_dir):
    noisy = F.lower(F.concat(F.col("seller_name"), F.lit("Member since "), (F.col("line_no") + 2010).cast("string")))
    return text_listings(spark, sf_dir).select("row_key", text.before_marker(noisy).alias("seller_name"))


@query(
    "text_assembled",
    """SELECT row_key, concat(CASE WHEN line_no = 1 THEN '' ELSE title END, ' ', description) AS whole, description AS bare,
    substr(trim(concat(title, ' ', description)), 1, 30) AS head FROM listings_fx""",
)
def text_assembled(spark, sf_dir):
    title = F.when(F.col("line_no") != 1, F.col("title"))
    return text_listings(spark, sf_dir).select(
        "row_key",
        text.title_and_description(title, F.col("description")).alias("whole"),
        text.drop_prefix(F.concat(F.lit("Description  "), F.col("description"))).alias("bare"),
        text.head_chars(F.concat(F.lit(" "), F.col("title"), F.lit(" "), F.col("description")), 30).alias("head"),
    )


@query(
    "urls_resolved",
    """SELECT row_key, concat(CASE order_no % 3 WHEN 0 THEN 'https://ads.example/en/ad/' WHEN 1 THEN 'https://other.example/' ELSE 'https://cdn.example/' END, part_no) AS url FROM listings_fx""",
)
def urls_resolved(spark, sf_dir):
    part = F.col("part_no").cast("string")
    href = (
        F.when(F.col("order_no") % 3 == 0, F.concat(F.lit("/en/ad/"), part))
        .when(F.col("order_no") % 3 == 1, F.concat(F.lit("https://other.example/"), part))
        .otherwise(F.concat(F.lit("//cdn.example/"), part))
    )
    return text_listings(spark, sf_dir).select("row_key", text.absolute_url(href, "https://ads.example").alias("url"))


@query(
    "bracket_counts",
    "SELECT row_key, city AS name, CASE WHEN line_no = 1 THEN CAST(0 AS BIGINT) ELSE part_no * 1000 + 7 END AS ads FROM listings_fx",
)
def bracket_counts(spark, sf_dir):
    label = F.when(F.col("line_no") == 1, F.col("city")).otherwise(
        F.concat(F.col("city"), F.lit(" ("), F.col("part_no").cast("string"), F.lit(",007)"))
    )
    return text_listings(spark, sf_dir).select(
        "row_key", text.without_bracketed_count(label).alias("name"), text.bracketed_count(label).alias("ads")
    )


@query(
    "shown_text",
    """SELECT row_key, concat('Stand-', upper(substr(property_type, 1, 1)), lower(substr(property_type, 2))) AS title,
    format('{:,}', CAST(round_even(price_numeric * 100, 0) AS BIGINT)) AS price FROM listings_fx""",
)
def shown_text(spark, sf_dir):
    return text_listings(spark, sf_dir).select(
        "row_key",
        text.title_case(F.concat(F.lit("stand-"), F.col("property_type"))).alias("title"),
        text.thousands(F.bround(F.col("price_numeric") * 100, 0)).alias("price"),
    )


@query("finish_type", "SELECT row_key, finish_truth AS finish_type FROM listings_fx")
def finish_type(spark, sf_dir):
    return text_listings(spark, sf_dir).select("row_key", Reader(F.col("description")).finish_type().alias("finish_type"))


@query(
    "floor_number",
    "SELECT row_key, TRY_CAST(regexp_extract(description, 'floor\\s*(\\d{1,2})', 1) AS INT) AS floor_number FROM listings_fx",
)
def floor_number(spark, sf_dir):
    return text_listings(spark, sf_dir).select("row_key", Reader(F.col("description")).floor_number().alias("floor_number"))


@query("delivery_hint", "SELECT row_key, CAST(2024 + line_no AS STRING) AS delivery_date FROM listings_fx")
def delivery_hint(spark, sf_dir):
    return text_listings(spark, sf_dir).select("row_key", Reader(F.col("description")).delivery_hint().alias("delivery_date"))


@query("view_type", "SELECT row_key, CASE line_no % 4 WHEN 0 THEN 'garden' WHEN 1 THEN 'sea' WHEN 2 THEN 'pool' END AS view_type FROM listings_fx")
def view_type(spark, sf_dir):
    return text_listings(spark, sf_dir).select("row_key", Reader(F.col("description")).view_type().alias("view_type"))


@query("down_payment", "SELECT row_key, CAST(part_no AS DOUBLE) AS down_payment_egp FROM listings_fx")
def down_payment(spark, sf_dir):
    return text_listings(spark, sf_dir).select("row_key", Reader(F.col("description")).down_payment().alias("down_payment_egp"))


@query(
    "instalments",
    """SELECT row_key, CASE line_no % 3 WHEN 0 THEN CAST(size_no AS INT) WHEN 1 THEN CAST(size_no AS INT) END AS installment_years,
    CASE WHEN line_no % 3 = 2 THEN CAST(part_no AS DOUBLE) * 1000 END AS monthly_installment_egp FROM listings_fx""",
)
def instalments(spark, sf_dir):
    size, part = F.col("size_no").cast("string"), F.col("part_no").cast("string")
    phrase = (
        F.when(F.col("line_no") % 3 == 0, F.concat(F.lit("installment up to "), size, F.lit(" years")))
        .when(F.col("line_no") % 3 == 1, F.concat(size, F.lit(" yr install")))
        .otherwise(F.concat(F.lit("monthly installment of EGP "), part, F.lit(",000")))
    )
    return text_listings(spark, sf_dir).withColumn("phrase", phrase).select(
        "row_key",
        Reader(F.col("phrase")).instalment_years().alias("installment_years"),
        Reader(F.col("phrase")).monthly_instalment().alias("monthly_installment_egp"),
    )


@query(
    "has_flags",
    """SELECT row_key, CASE WHEN line_no % 4 = 0 THEN true END AS has_garden, CASE WHEN line_no % 4 = 2 OR line_no % 2 = 0 THEN true END AS has_pool,
    CASE WHEN line_no % 3 = 0 THEN true END AS has_elevator, CASE WHEN size_no % 2 = 0 THEN true END AS has_security FROM listings_fx""",
)
def has_flags(spark, sf_dir):
    whole = text_listings(spark, sf_dir).withColumn("whole", F.concat("description", F.lit(" "), "amenities"))
    return whole.select(
        "row_key",
        *[Reader(F.col("whole")).mentions(f).alias(f) for f in ("has_garden", "has_pool", "has_elevator", "has_security")],
    )


@query("compound_match", f"SELECT row_key, {COMPOUND_SQL} AS compound_name FROM listings_fx")
def compound_match(spark, sf_dir):
    lowered = text_listings(spark, sf_dir).withColumn("plain", F.lower("title"))
    return lowered.select("row_key", Reader(F.col("title"), F.col("plain")).compound_name().alias("compound_name"))


@query(
    "extracted_english",
    f"""SELECT row_key, finish_truth AS finish_type, CAST(size_no AS INT) AS floor_number, CAST(2024 + line_no AS STRING) AS delivery_date,
    CASE line_no % 4 WHEN 0 THEN 'garden' WHEN 1 THEN 'sea' WHEN 2 THEN 'pool' END AS view_type, CAST(part_no AS DOUBLE) AS down_payment_egp,
    {COMPOUND_SQL} AS compound_name FROM listings_fx""",
)
def extracted_english(spark, sf_dir):
    return enrich(text_listings(spark, sf_dir).select("row_key", "title", "description")).select(
        "row_key", "finish_type", "floor_number", "delivery_date", "view_type", "down_payment_egp", "compound_name"
    )


@query(
    "extracted_arabic",
    f"""SELECT row_key, {ARABIC_FINISH_SQL} AS finish_type, CAST(size_no % 30 AS INT) AS floor_number, CAST(2024 + line_no AS STRING) AS delivery_date,
    CAST(part_no AS DOUBLE) AS down_payment_egp, CASE WHEN line_no % 2 = 0 THEN 7 ELSE 5 END AS installment_years,
    CASE WHEN line_no % 2 = 0 THEN true END AS has_garden, CASE WHEN line_no % 2 = 1 THEN true END AS has_elevator FROM listings_fx""",
)
def extracted_arabic(spark, sf_dir):
    return enrich(text_listings(spark, sf_dir).select("row_key", "arabic_text"), F.col("arabic_text")).select(
        "row_key", "finish_type", "floor_number", "delivery_date", "down_payment_egp", "installment_years", "has_garden", "has_elevator"
    )


@query("delivery_months", f"SELECT row_key, round({DELIVERY_SQL}, 8) AS months FROM listings_fx")
def months(spark, sf_dir):
    as_of = F.lit(AS_OF).cast("date")
    found = with_delivery_months(text_listings(spark, sf_dir), "delivery_text", "months", as_of)
    return found.select("row_key", F.round("months", 8).alias("months"))


# text, months or the day it means, and the step that reads it; one for every step and layout
DELIVERY_CASES = [
    ("31/12/2026", "2026-12-31", "date"), ("2026-31-12", "2026-12-31", "date"), ("20261231", "2026-12-31", "date"), ("2026/12", "2026-12-01", "date"),
    ("12/2026", "2026-12-01", "date"), ("31st December 2026", "2026-12-31", "date"), ("Dec 31, 2026", "2026-12-31", "date"),
    ("December 2026", "2026-12-01", "date"), ("2026 Dec", "2026-12-01", "date"), ("Dec-26", "2026-12-01", "month"), ("2026", "2026-12-31", "year"),
    ("2025 - 2027", "2027-12-31", "year"), ("18 months", 18.0, "duration"), ("1.5 Years", 18.0, "duration"), ("three years", 36.0, "duration"),
    ("Ready to move", 0.0, "phrase"), ("next year", "2026-01-01", "phrase"), ("", 0.0, "empty"), ("nan", 0.0, "empty"), ("TBD", 0.0, "unread"),
    ("13/13/2026", 0.0, "unread"), ("30 Feb 2026", 0.0, "unread"), ("May", 0.0, "unread"), ("123", 0.0, "unread"),
]


def _case_sql(value) -> str:
    return f"date_diff('day', DATE '{AS_OF}', DATE '{value}') / 30.4375" if isinstance(value, str) else str(value)


def _cases(i: int, quote) -> str:
    return f"CASE order_no % {len(DELIVERY_CASES)} " + " ".join(f"WHEN {n} THEN {quote(c[i])}" for n, c in enumerate(DELIVERY_CASES)) + " END"


def _delivery_cases(spark, sf_dir):
    texts = F.array(*[F.lit(t) for t, _, _ in DELIVERY_CASES])
    rows = text_listings(spark, sf_dir).withColumn("said", F.get(texts, (F.col("order_no") % len(DELIVERY_CASES)).cast("int")))
    return with_delivery_months(rows, "said", "months", F.lit(AS_OF).cast("date"), step="step")


@query("delivery_steps", f"SELECT row_key, round({_cases(1, _case_sql)}, 8) AS months, {_cases(2, repr)} AS step FROM listings_fx")
def delivery_steps(spark, sf_dir):
    return _delivery_cases(spark, sf_dir).select("row_key", F.round("months", 8).alias("months"), "step")


@query(
    "delivery_unread",
    f"SELECT step, CAST(count(*) AS BIGINT) AS n, count(DISTINCT said) AS texts FROM (SELECT {_cases(2, repr)} AS step, {_cases(0, repr)} AS said FROM listings_fx) GROUP BY step",
)
def delivery_unread(spark, sf_dir):
    """How many rows and texts each step reads, and how many none."""
    return unread_report(_delivery_cases(spark, sf_dir), "said", "step")


@query(
    "delivery_bucket",
    "SELECT row_key, CASE WHEN delivery_months <= 0.5 THEN 0 WHEN delivery_months <= 12 THEN 1 WHEN delivery_months <= 24 THEN 2 ELSE 3 END AS bucket FROM listings_fx",
)
def bucket(spark, sf_dir):
    return text_listings(spark, sf_dir).select("row_key", delivery_bucket(F.col("delivery_months")).alias("bucket"))


@query(
    "posted_dates",
    """SELECT row_key, CASE order_no % 3 WHEN 0 THEN concat(size_no, ' days ago') WHEN 1 THEN concat('Jun ', line_no, ', 2024') ELSE '' END AS posted FROM listings_fx""",
)
def posted(spark, sf_dir):
    size, line = F.col("size_no").cast("string"), F.col("line_no").cast("string")
    page = (
        F.when(F.col("order_no") % 3 == 0, F.concat(F.lit("Posted "), size, F.lit(" days ago\nJun 1, 2024")))
        .when(F.col("order_no") % 3 == 1, F.concat(F.lit("Listed Jun "), line, F.lit(", 2024 here")))
        .otherwise(F.lit("no date"))
    )
    return text_listings(spark, sf_dir).select("row_key", posted_date(page).alias("posted"))
