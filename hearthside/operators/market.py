"""Market aggregates over listings."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthside import vocab
from hearthside.functions.truth import flag
from hearthside.operators.quantiles import medians

PRICE, AREA = "price_numeric", "area_sqm"


def with_ppsqm(df: DataFrame) -> DataFrame:
    """Rows with a positive area, plus their price per square metre."""
    return df.where(F.col(AREA) > 0).withColumn("ppsqm", F.try_divide(PRICE, AREA))


def _with_values(row: DataFrame, values: DataFrame) -> DataFrame:
    """Add the columns of a one-row frame; one scalar subquery brings all of them."""
    packed = values.select(F.struct("*").alias("v")).scalar()
    return row.withColumn("_v", packed).select("*", *[F.col(f"_v.{c}").alias(c) for c in values.columns]).drop("_v")


def headline_stats(df: DataFrame, approx: bool = False) -> DataFrame:
    """One row: counts, mean and median price, median area (published as ``avg_area``)."""
    distinct = F.approx_count_distinct if approx else F.count_distinct
    basic = df.agg(
        F.count("*").alias("total_listings"),
        F.avg(F.col(PRICE)).alias("avg_price"),
        distinct(F.col("governorate")).alias("num_governorates"),
        distinct(F.col("city")).alias("num_cities"),
    )
    middle = medians(df, [], {"median_price": F.col(PRICE), "avg_area": F.col(AREA)}, approx)
    return _with_values(basic, middle)


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().orderBy(column)


def value_counts(df: DataFrame, column: str, top: int | None = None) -> DataFrame:
    """Counts of non-null values, most frequent first, name as tie-break."""
    counted = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    ordered = counted.orderBy(F.desc("n"), column)
    return ordered.limit(top) if top else ordered


def group_mean(df: DataFrame, by: str, value: Column, name: str) -> DataFrame:
    """Group mean rounded to whole units, halves to even."""
    kept = df.where(F.col(by).isNotNull())
    return kept.groupBy(by).agg(F.bround(F.avg(value), 0).alias(name))


def median_ppsqm(df: DataFrame, by: str, approx: bool = False) -> DataFrame:
    return medians(with_ppsqm(df), [by], {"ppsqm": F.col("ppsqm")}, approx)


def priciest(df: DataFrame, by: str = "city", top: int = 25, approx: bool = False) -> DataFrame:
    found = median_ppsqm(df, by, approx).withColumn("ppsqm", F.bround("ppsqm", 0))
    return found.orderBy(F.desc("ppsqm"), by).limit(top)


def affordable(df: DataFrame, by: str = "city", top: int = 15, approx: bool = False) -> DataFrame:
    return median_ppsqm(df, by, approx).orderBy("ppsqm", by).limit(top)


def premium(df: DataFrame, by: str = "city", top: int = 15, approx: bool = False) -> DataFrame:
    """The most expensive groups, listed from cheap to expensive."""
    highest = median_ppsqm(df, by, approx).orderBy(F.desc("ppsqm"), F.desc(by)).limit(top)
    return highest.orderBy("ppsqm", by)


def city_coordinates(df: DataFrame, approx: bool = False) -> DataFrame:
    return medians(df, ["city"], {"latitude": F.col("latitude"), "longitude": F.col("longitude")}, approx)


def price_by_bedrooms(df: DataFrame, approx: bool = False) -> DataFrame:
    return medians(df, ["bedrooms"], {"median_price": F.col(PRICE)}, approx).orderBy("bedrooms")


def price_by_finish(df: DataFrame, approx: bool = False) -> DataFrame:
    return median_ppsqm(df, "finish_type", approx).orderBy("ppsqm", "finish_type")


def within_budget(df: DataFrame, budget: float, margin: float = 0.15) -> DataFrame:
    low, high = budget * (1 - margin), budget * (1 + margin)
    return with_ppsqm(df).where(F.col(PRICE).between(low, high))


def budget_summary(df: DataFrame, budget: float, margin: float = 0.15, approx: bool = False) -> DataFrame:
    """Typical listing around a budget; no row unless more than five listings match."""
    near = within_budget(df, budget, margin)
    counted = near.agg(F.count("*").alias("listings"))
    middle = medians(
        near,
        [],
        {"median_area": F.col(AREA), "median_bedrooms": F.col("bedrooms"), "median_bathrooms": F.col("bathrooms")},
        approx,
    )
    return _with_values(counted, middle).where("listings > 5")


def budget_cities(df: DataFrame, budget: float, margin: float = 0.15, top: int = 5) -> DataFrame:
    near = within_budget(df, budget, margin)
    enough = near.agg(F.count("*") > 5).scalar()
    return value_counts(near, "city", top).where(enough)


def amenity_share(df: DataFrame, flags: list[str] = vocab.AMENITY_FLAGS) -> DataFrame:
    """Percentage of listings per amenity, ascending; one scan, then a narrow unpivot."""
    have = [c for c in flags if c in df.columns]
    means = df.agg(*[(F.avg(F.col(f"`{c}`").cast("double")) * 100).alias(f"_{i}") for i, c in enumerate(have)])
    pairs = [F.struct(F.lit(c).alias("amenity"), F.col(f"_{i}").alias("pct")) for i, c in enumerate(have)]
    return means.select(F.inline(F.array(*pairs))).orderBy("pct", "amenity")


def histogram(df: DataFrame, value: Column, bins: int = 60) -> DataFrame:
    """Equal-width bins between minimum and maximum: ``bin, low, high, n`` (empty bins included).

    The last bin is closed on the right. When all values are equal the range is
    widened by a half on each side.
    """
    values = df.select(value.cast("double").alias("x")).where(F.col("x").isNotNull() & ~F.isnan("x"))
    ends = values.agg(F.min("x").alias("a"), F.max("x").alias("b"))
    flat = F.col("a") == F.col("b")
    ends = ends.select(
        F.when(flat, F.col("a") - 0.5).otherwise(F.col("a")).alias("a"),
        F.when(flat, F.col("b") + 0.5).otherwise(F.col("b")).alias("b"),
    )
    range_ = ends.select(F.struct("a", "b").alias("r")).scalar()
    low, high = range_["a"], range_["b"]
    number = F.least(F.floor((F.col("x") - low) / (high - low) * bins), F.lit(bins - 1)).cast("int")
    counted = values.withColumn("bin", number).groupBy("bin").agg(F.count("*").alias("n"))
    width = (F.col("b") - F.col("a")) / bins
    edges = ends.where("a IS NOT NULL").select(
        "a", "b", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin")
    )
    return (
        edges.join(counted, "bin", "left")
        .select(
            "bin",
            (F.col("a") + F.col("bin") * width).alias("low"),
            (F.col("a") + (F.col("bin") + 1) * width).alias("high"),
            F.coalesce("n", F.lit(0)).alias("n"),
        )
    )


def on_map(df: DataFrame) -> DataFrame:
    return df.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull() & (F.col(AREA) > 0))


def seeded_sample(df: DataFrame, key: str, n: int = 2000, seed: int = 42) -> DataFrame:
    """A repeatable sample of at most ``n`` rows: the smallest salted hashes of the key.

    Runs as a distributed top-n; no full sort and no dependence on partitioning.
    """
    hashed = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    return df.withColumn("_h", hashed).orderBy("_h", key).limit(n).drop("_h")


def heat_points(df: DataFrame, key: str, n: int = 2000, seed: int = 42) -> DataFrame:
    """Sampled map points weighted by price in millions."""
    return seeded_sample(on_map(df), key, n, seed).select(
        key, "latitude", "longitude", (F.col(PRICE) / 1e6).alias("weight")
    )


def map_centre(points: DataFrame) -> DataFrame:
    return medians(points, [], {"latitude": F.col("latitude"), "longitude": F.col("longitude")})


def geo_grid(df: DataFrame, cell: float = 0.25) -> DataFrame:
    """Every mapped listing counted into square cells, with the summed price weight."""
    cell_of = lambda c: F.floor(F.col(c) / F.lit(cell))
    return (
        on_map(df)
        .groupBy(cell_of("latitude").alias("lat_cell"), cell_of("longitude").alias("lon_cell"))
        .agg(F.count("*").alias("listings"), F.avg(F.col(PRICE) / 1e6).alias("mean_weight"))
    )


def crawl_summary(df: DataFrame) -> DataFrame:
    """Price figures over listings that state them; 0 when none does."""
    price = F.when(F.col(PRICE) != 0, F.col(PRICE))
    per_sqm = F.when(F.col("price_per_sqm") != 0, F.col("price_per_sqm"))
    zero = F.lit(0.0)
    return df.agg(
        F.count("*").alias("total"),
        F.coalesce(F.avg(price), zero).alias("avg_price"),
        F.coalesce(F.min(price), zero).alias("min_price"),
        F.coalesce(F.max(price), zero).alias("max_price"),
        F.coalesce(F.avg(per_sqm), zero).alias("avg_price_per_sqm"),
    )


def common_cities(df: DataFrame, top: int = 10) -> DataFrame:
    return value_counts(df.where(F.col("city") != ""), "city", top)


def flags_total(df: DataFrame, flags: list[str]) -> DataFrame:
    return df.agg(*[F.sum(flag(F.col(f"`{c}`"))).alias(c) for c in flags])
