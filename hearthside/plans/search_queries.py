"""Search, options, ids, duplicates and set operations."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthside import vocab
from hearthside.functions.features import one_hot
from hearthside.operators import clean, deals, ledger, search
from hearthside.operators.sequence import contiguous_id, first_per_key
from hearthside.plans.fixture import listings, read
from hearthside.plans.registry import KEY, query
from hearthside.session import cut_lineage

_SHOWN = ["row_key", "city", "governorate", "price_numeric", "area_sqm", "bedrooms", "bathrooms"]
_SHOWN_SQL = ", ".join(_SHOWN)
_IDS = ", t AS (SELECT row_number() OVER (ORDER BY row_key, price_numeric, description) AS id, * FROM listings_fx)"


def search_table(spark, sf_dir):
    """Listings with the 0/1 columns the search filters look at."""
    domains = {c: v for c, v in vocab.ONE_HOT_VALUES.items() if c != "seller_type"}
    return one_hot(listings(spark, sf_dir).withColumnRenamed("finish_truth", "finish_type"), domains)


def numbered(spark, sf_dir, columns=()):
    """Listings with an id; only the key and the wanted columns are sorted and stored."""
    kept = [c for c in dict.fromkeys([*KEY, *columns])]
    return contiguous_id(listings(spark, sf_dir).select(*kept), KEY)


@query(
    "search_filtered",
    f"""SELECT {_SHOWN_SQL} FROM listings_fx WHERE governorate = 'ASIA' AND finish_truth = 'lux' AND price_numeric >= 10000
    AND price_numeric <= 60000 AND area_sqm >= 10 AND area_sqm <= 45 AND bedrooms >= 1 AND bedrooms <= 4 AND bathrooms >= 1
    ORDER BY price_numeric NULLS FIRST, row_key, description LIMIT 100""",
)
def search_filtered(spark, sf_dir):
    return search.search(
        search_table(spark, sf_dir), governorate="ASIA", finish_type="lux", min_price=10000, max_price=60000,
        min_area=10, max_area=45, min_beds=1, max_beds=4, min_baths=1, city="", key=["row_key", "description"],
    ).select(*_SHOWN)


@query(
    "search_choices",
    f"""SELECT {_SHOWN_SQL} FROM listings_fx WHERE furnished = 'yes' AND ownership = 'resale' AND payment_option = 'cash or installment'
    AND completion_status = 'off-plan' ORDER BY area_sqm DESC, row_key, price_numeric, description LIMIT 100""",
)
def search_choices(spark, sf_dir):
    return search.search(
        search_table(spark, sf_dir), furnished="yes", ownership="resale", payment="cash or installment",
        completion="off-plan", sort_by="area_sqm", sort_dir="desc", key=KEY,
    ).select(*_SHOWN)


@query(
    "search_paged",
    f"SELECT {_SHOWN_SQL} FROM listings_fx WHERE city = 'NATION_5' ORDER BY bedrooms NULLS FIRST, row_key, price_numeric, description LIMIT 50 OFFSET 100",
)
def search_paged(spark, sf_dir):
    return search.search(
        search_table(spark, sf_dir), city="NATION_5", sort_by="bedrooms", limit=50, offset=100, key=KEY
    ).select(*_SHOWN)


@query(
    "search_keyset",
    _IDS
    + """, r AS (SELECT id, city, price_numeric, row_number() OVER (ORDER BY price_numeric DESC, id) AS n FROM t WHERE governorate = 'ASIA' AND price_numeric <= 60000)
    SELECT id, city, price_numeric, CAST((n - 1) // 30 AS INT) AS page FROM r WHERE n <= 150""",
)
def search_keyset(spark, sf_dir):
    """Five pages of a search, each from the continuation of the one before."""
    table = cut_lineage(numbered(spark, sf_dir, ["city", "governorate", "price_numeric"]))
    pages, token = [], None
    for number in range(5):
        page = search.search_after(table, token, sort_dir="desc", limit=30, governorate="ASIA", max_price=60000)
        token = search.continuation(page.tail(1)[0])
        pages.append(page.select("id", "city", "price_numeric", F.lit(number).alias("page")))
    return reduce(DataFrame.unionByName, pages)


@query(
    "search_all_matches",
    f"SELECT {_SHOWN_SQL} FROM listings_fx WHERE property_type = 'STANDARD' AND bathrooms <= 2 AND ownership = 'primary'",
)
def search_all_matches(spark, sf_dir):
    found = search.filtered(
        search_table(spark, sf_dir), property_type="STANDARD", max_baths=2, ownership="primary", furnished="any"
    )
    return found.select(*_SHOWN)


@query(
    "search_options",
    " UNION ALL ".join(
        f"SELECT DISTINCT '{c}' AS facet, {s} AS value FROM listings_fx WHERE {s} IS NOT NULL"
        for c, s in [("city", "city"), ("governorate", "governorate"), ("property_type", "property_type"), ("finish_type", "finish_truth")]
    ),
)
def search_options(spark, sf_dir):
    return search.dropdown_values(search_table(spark, sf_dir), ["city", "governorate", "property_type", "finish_type"])


@query(
    "search_option_bounds",
    """SELECT CAST(floor(coalesce(nullif(min(price_numeric), 0), 0)) AS BIGINT) AS price_min, CAST(floor(coalesce(nullif(max(price_numeric), 0), 50000000)) AS BIGINT) AS price_max,
    CAST(floor(coalesce(min(CASE WHEN area_sqm > 0 THEN area_sqm END), 0)) AS BIGINT) AS area_min, CAST(floor(coalesce(max(CASE WHEN area_sqm > 0 THEN area_sqm END), 1000)) AS BIGINT) AS area_max,
    CAST(coalesce(nullif(min(bedrooms), 0), 1) AS BIGINT) AS bed_min, CAST(coalesce(nullif(max(bedrooms), 0), 10) AS BIGINT) AS bed_max,
    CAST(coalesce(nullif(min(bathrooms), 0), 1) AS BIGINT) AS bath_min, CAST(coalesce(nullif(max(bathrooms), 0), 6) AS BIGINT) AS bath_max FROM listings_fx""",
)
def search_option_bounds(spark, sf_dir):
    return search.option_bounds(search_table(spark, sf_dir))


@query("cities_of_governorate", "SELECT DISTINCT city FROM listings_fx WHERE governorate = 'EUROPE'")
def cities_of_governorate(spark, sf_dir):
    return search.cities_of(listings(spark, sf_dir), "EUROPE")


@query(
    "explore_rows",
    f"SELECT {_SHOWN_SQL} FROM listings_fx WHERE governorate = 'AFRICA' ORDER BY row_key, price_numeric, description LIMIT 5000",
)
def explore_rows(spark, sf_dir):
    return search.first_rows(listings(spark, sf_dir), KEY, 5000, "AFRICA").select(*_SHOWN)


@query("search_table_ids", _IDS + f"SELECT id, {_SHOWN_SQL} FROM t")
def search_table_ids(spark, sf_dir):
    return numbered(spark, sf_dir, _SHOWN).select("id", *_SHOWN)


@query("compare_ids", _IDS + f"SELECT id, {_SHOWN_SQL} FROM t WHERE id IN (7, 11, 500, 501, 999999999)")
def compare_ids(spark, sf_dir):
    ids = search.parse_ids("7, 11,500,, 501, 7, 999999999")
    return search.by_ids(numbered(spark, sf_dir, _SHOWN), ids).select("id", *_SHOWN)


@query(
    "requested_ids",
    _IDS
    + """, k AS (SELECT DISTINCT CAST(trim(x) AS BIGINT) AS id FROM (SELECT unnest(string_split(concat(CAST(s_suppkey AS STRING), ', ', CAST(s_suppkey * 3 AS STRING), ',,'), ',')) AS x FROM supplier) WHERE trim(x) != '')
    SELECT t.id, row_key FROM t JOIN k ON t.id = k.id""",
)
def requested_ids(spark, sf_dir):
    key = F.col("s_suppkey")
    requests = read(spark, sf_dir, "supplier").select(
        F.concat(key.cast("string"), F.lit(", "), (key * 3).cast("string"), F.lit(",,")).alias("ids")
    )
    return search.by_ids(numbered(spark, sf_dir), search.ids_from_table(requests)).select("id", "row_key")


@query(
    "listing_cards",
    """SELECT row_key, concat(upper(substr(property_type, 1, 1)), lower(substr(property_type, 2)), ' in ',
    array_to_string(list_transform(string_split(city, ' '), lambda w: concat(upper(substr(w, 1, 1)), lower(substr(w, 2)))), ' ')) AS heading,
    CASE WHEN area_sqm > 0 THEN round_even(price_numeric / area_sqm, 0) ELSE 0 END AS ppsqm FROM listings_fx""",
)
def listing_cards(spark, sf_dir):
    return deals.cards(listings(spark, sf_dir)).select("row_key", "heading", "ppsqm")


@query(
    "dedup_first",
    """, r AS (SELECT *, row_number() OVER (PARTITION BY ad_id ORDER BY row_key, price_numeric, description) AS n FROM listings_fx)
    SELECT row_key, ad_id, price_numeric, city FROM r WHERE n = 1 OR ad_id = ''""",
)
def dedup_first(spark, sf_dir):
    df = listings(spark, sf_dir).select("row_key", "ad_id", "price_numeric", "city", "description")
    return first_per_key(df, "ad_id", F.struct(*KEY)).drop("description")


@query(
    "dedup_rows",
    "SELECT DISTINCT city, property_type, bedrooms, bathrooms, furnished, ownership, payment_option, finish_truth FROM listings_fx",
)
def dedup_rows(spark, sf_dir):
    df = listings(spark, sf_dir).select(
        "city", "property_type", "bedrooms", "bathrooms", "furnished", "ownership", "payment_option", "finish_truth"
    )
    return clean.without_duplicates(df)


def _ledger(spark, sf_dir):
    return read(spark, sf_dir, "pages").where("page_id % 3 = 0").select("url")


@query("unseen_pages", "SELECT page_id, url FROM pages WHERE url NOT IN (SELECT url FROM pages WHERE page_id % 3 = 0)", listings=False)
def unseen_pages(spark, sf_dir):
    return ledger.unseen(read(spark, sf_dir, "pages").select("page_id", "url"), _ledger(spark, sf_dir))


@query(
    "first_unseen_pages",
    "SELECT min(page_id) AS page_id, url FROM pages WHERE url NOT IN (SELECT url FROM pages WHERE page_id % 3 = 0) GROUP BY url",
    listings=False,
)
def first_unseen_pages(spark, sf_dir):
    batch = read(spark, sf_dir, "pages").select("page_id", "url")
    return ledger.first_unseen(batch.unionByName(batch), _ledger(spark, sf_dir), F.col("page_id")).select("page_id", "url")


@query("seen_pages", "SELECT page_id, url FROM pages WHERE url IN (SELECT url FROM pages WHERE page_id % 3 = 0)", listings=False)
def seen_pages(spark, sf_dir):
    return ledger.already_seen(read(spark, sf_dir, "pages").select("page_id", "url"), _ledger(spark, sf_dir))


@query("seen_union", "SELECT DISTINCT url FROM pages", listings=False)
def seen_union(spark, sf_dir):
    return ledger.all_seen(_ledger(spark, sf_dir), read(spark, sf_dir, "pages"))


@query(
    "seen_diff",
    "SELECT count(DISTINCT url) AS new_urls FROM pages WHERE url NOT IN (SELECT url FROM pages WHERE page_id % 3 = 0)",
    listings=False,
)
def seen_diff(spark, sf_dir):
    return ledger.missing_from_ledger(read(spark, sf_dir, "pages"), _ledger(spark, sf_dir))
