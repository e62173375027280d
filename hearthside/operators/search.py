"""Faceted search, options, ids and paging over the search table."""

import json
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthside import vocab

_TEXT_FACETS = ["city", "governorate", "property_type", "finish_type"]
_RANGES = {"price": "price_numeric", "area": "area_sqm", "beds": "bedrooms", "baths": "bathrooms"}
_CHOICES = {
    "furnished": ("furnished", ["yes", "no"]),
    "ownership": ("ownership", ["primary", "resale"]),
    "payment": ("payment_option", ["cash", "installment", "cash or installment"]),
    "completion": ("completion_status", ["ready", "off-plan"]),
}


def search_predicate(**facets) -> Column | None:
    """All given facets as one conjunction.

    Text facets count when they are not empty; ``min_``/``max_`` facets for price,
    area, beds and baths count when they are not None and include their bounds. The
    four choices look at the 0/1 columns and ignore unknown values.
    """
    known = set(_TEXT_FACETS) | set(_CHOICES) | {f"{e}_{r}" for e in ("min", "max") for r in _RANGES}
    unknown = set(facets) - known
    if unknown:
        raise TypeError(f"unknown facets: {sorted(unknown)}")
    tests = [F.col(c) == facets[c] for c in _TEXT_FACETS if facets.get(c)]
    for name, column in _RANGES.items():
        if facets.get(f"min_{name}") is not None:
            tests.append(F.col(column) >= facets[f"min_{name}"])
        if facets.get(f"max_{name}") is not None:
            tests.append(F.col(column) <= facets[f"max_{name}"])
    for name, (column, values) in _CHOICES.items():
        if facets.get(name) in values:
            tests.append(F.col(f"`{column}_{facets[name]}`") == 1)
    return reduce(and_, tests) if tests else None


def filtered(df: DataFrame, **facets) -> DataFrame:
    test = search_predicate(**facets)
    return df if test is None else df.where(test)


def search(
    df: DataFrame,
    *,
    sort_by: str = "price_numeric",
    sort_dir: str = "ASC",
    limit: int = 100,
    offset: int = 0,
    key: list[str] | None = None,
    **facets,
) -> DataFrame:
    """Filter, sort and page. Ties are broken by ``key`` (default ``id``) so pages never overlap."""
    if sort_by not in vocab.SORTABLE_COLUMNS:
        sort_by = "price_numeric"
    by = F.col(sort_by).desc_nulls_last() if sort_dir.upper() == "DESC" else F.col(sort_by).asc_nulls_first()
    return filtered(df, **facets).orderBy(by, *(key or ["id"])).offset(offset).limit(limit)


def continuation(row, sort_by: str = "price_numeric", key: str = "id") -> str | None:
    """Text that stands for the place behind a row (the last one of a page); None without a row."""
    return None if row is None else json.dumps([row[sort_by], row[key]])


def search_after(
    df: DataFrame,
    token: str | None = None,
    *,
    sort_by: str = "price_numeric",
    sort_dir: str = "ASC",
    limit: int = 100,
    key: str = "id",
    **facets,
) -> DataFrame:
    """The page behind ``token`` (None: the first), in the order of :func:`search`; ``key`` is unique.

    The place is a range on the sort column that reaches the scan, and the page is a distributed top-n of ``limit`` rows: page
    10,000 costs no more than the first one, and rows added in between move no row from page to page.
    """
    if sort_by not in vocab.SORTABLE_COLUMNS:
        sort_by = "price_numeric"
    value, down = F.col(sort_by), sort_dir.upper() == "DESC"
    found = filtered(df, **facets)
    if token is not None:
        last, at = json.loads(token)
        behind = F.col(key) > F.lit(at)
        if last is None:  # nulls come first upward and last downward
            found = found.where(value.isNull() & behind if down else (value.isNull() & behind) | value.isNotNull())
        elif down:
            found = found.where((value <= last) | value.isNull()).where((value < last) | value.isNull() | behind)
        else:
            found = found.where(value >= last).where((value > last) | behind)
    return found.orderBy(value.desc_nulls_last() if down else value.asc_nulls_first(), key).limit(limit)


def first_rows(df: DataFrame, key: list[str], limit: int = 5000, governorate: str | None = None) -> DataFrame:
    kept = df.where(F.col("governorate") == governorate) if governorate else df
    return kept.orderBy(*key).limit(limit)


def dropdown_values(df: DataFrame, columns: list[str] = vocab.DROPDOWN_COLUMNS) -> DataFrame:
    """Every dropdown in one scan, long form: ``facet, value`` in order, nulls left out."""
    pairs = [F.struct(F.lit(c).alias("facet"), F.col(c).alias("value")) for c in columns]
    return (
        df.select(F.inline(F.array(*pairs)))
        .where(F.col("value").isNotNull())
        .distinct()
        .orderBy("facet", "value")
    )


def option_bounds(df: DataFrame) -> DataFrame:
    """Whole-number bounds for the sliders in one scan.

    A bound that is missing *or zero* takes its default; areas count only above 0.
    """
    area = F.when(F.col("area_sqm") > 0, F.col("area_sqm"))
    sources = {"price": F.col("price_numeric"), "area": area, "bed": F.col("bedrooms"), "bath": F.col("bathrooms")}

    def bound(name: str, found: Column) -> Column:
        usable = F.when(found != 0, found)
        return F.coalesce(usable.cast("long"), F.lit(vocab.OPTION_DEFAULTS[name]).cast("long")).alias(name)

    return df.agg(
        *[
            bound(f"{name}_{end}", fn(value))
            for name, value in sources.items()
            for end, fn in (("min", F.min), ("max", F.max))
        ]
    )


def cities_of(df: DataFrame, governorate: str) -> DataFrame:
    """Cities of one governorate in order; a null city is part of the list."""
    return df.where(F.col("governorate") == governorate).select("city").distinct().orderBy("city")


def parse_ids(ids: str) -> list[int]:
    """A comma-separated request text to whole numbers; blanks between commas are skipped."""
    try:
        found = [int(part) for part in (p.strip() for p in ids.split(",")) if part]
    except ValueError as error:
        raise ValueError("ids must be comma-separated whole numbers") from error
    if not found:
        raise ValueError("at least one id is needed")
    return found


def ids_from_table(requests: DataFrame, column: str = "ids") -> DataFrame:
    """The same reading for a table of request texts; a bad number fails the job."""
    parts = requests.select(F.explode(F.split(column, ",")).alias("part")).select(F.trim("part").alias("part"))
    return parts.where("part != ''").select(F.col("part").cast("long").alias("id"))


def by_ids(df: DataFrame, ids: list[int] | DataFrame, key: str = "id") -> DataFrame:
    """Rows with the given ids; repeated and unknown ids do nothing.

    A list becomes a pushed-down filter, a table becomes a semi join.
    """
    if isinstance(ids, DataFrame):
        return df.join(ids.select(key).distinct(), key, "left_semi")
    return df.where(F.col(key).isin(list(ids))) if ids else df.where(F.lit(False))
