"""Cleaning: column dropping, fills, flags, duplicates and outliers."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, NumericType, StringType

from hearthside import vocab
from hearthside.functions.text import amenity_flags, before_marker, lower_text
from hearthside.functions.truth import either, text_to_boolean
from hearthside.operators.quantiles import exact_quantiles


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def columns_of(df: DataFrame, kind: str) -> list[str]:
    """Names of the ``number``, ``text`` or ``boolean`` columns."""
    types = {"number": NumericType, "text": StringType, "boolean": BooleanType}
    return [f.name for f in df.schema.fields if isinstance(f.dataType, types[kind])]


def only(df: DataFrame, kind: str) -> DataFrame:
    return df.select(*[_c(c) for c in columns_of(df, kind)])


def null_report(df: DataFrame) -> DataFrame:
    """One row per column: null count and share, all counted in one scan."""
    counts = df.agg(
        F.count("*").alias("_rows"),
        *[F.count_if(_c(c).isNull()).alias(f"_n{i}") for i, c in enumerate(df.columns)],
    )
    pairs = [F.struct(F.lit(c).alias("column"), F.col(f"_n{i}").alias("nulls")) for i, c in enumerate(df.columns)]
    long = counts.select("_rows", F.inline(F.array(*pairs)))
    share = F.when(F.col("_rows") > 0, F.col("nulls") / F.col("_rows") * 100).otherwise(0.0)
    return long.select("column", "nulls", share.alias("null_pct"))


def drop_sparse(df: DataFrame, over_pct: float = 60.0) -> DataFrame:
    """Drop columns whose null share is above ``over_pct`` percent of the rows."""
    sparse = null_report(df).where(F.col("null_pct") > over_pct)
    return df.drop(*[r["column"] for r in sparse.collect()])  # at most one row per column


def without_duplicates(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def fill_constants(df: DataFrame, fills: dict = vocab.CONSTANT_FILLS) -> DataFrame:
    return df.na.fill({c: v for c, v in fills.items() if c in df.columns})


def column_means(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.agg(*[F.avg(_c(c)).alias(c) for c in columns])


def fill_with_mean(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Fill null numbers with the column mean (one scan for all columns)."""
    columns = columns or columns_of(df, "number")
    means = column_means(df, columns).first().asDict()
    types = dict(df.dtypes)
    filled = {}
    for c in columns:
        # an integer column becomes a double, since its mean is one
        value = _c(c) if types[c] == "double" else _c(c).cast("double")
        filled[c] = F.coalesce(value, F.lit(means[c]).cast("double"))
    return df.withColumns(filled)


def column_modes(df: DataFrame, columns: list[str]) -> DataFrame:
    """Most frequent value per text column, the smallest on ties: ``column, mode, n``."""
    pairs = [F.struct(F.lit(c).alias("column"), _c(c).alias("value")) for c in columns]
    counted = (
        df.select(F.inline(F.array(*pairs)))
        .where(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count("*").alias("n"))
    )
    best = F.min(F.struct((-F.col("n")).alias("rank"), F.col("value")))
    return counted.groupBy("column").agg(best.alias("best")).select(
        "column", F.col("best.value").alias("mode"), (-F.col("best.rank")).alias("n")
    )


def fill_with_mode(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    columns = columns or columns_of(df, "text")
    modes = {r["column"]: r["mode"] for r in column_modes(df, columns).collect()}  # one row per column
    return df.na.fill({c: v for c, v in modes.items() if v is not None})


def booleans_from_text(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: text_to_boolean(_c(c)) for c in columns})


def split_amenities(df: DataFrame) -> DataFrame:
    """The amenities text becomes one boolean per known name."""
    return df.withColumns(amenity_flags(F.col("amenities"))).drop("amenities")


def merge_text_flags(df: DataFrame) -> DataFrame:
    """Join listed amenities with those found in the text, then drop the text flags."""
    merged = {
        target: either(_c(target), _c(source)) for target, source in vocab.AMENITY_FROM_TEXT.items()
    }
    merged["roof"] = F.coalesce(F.col("has_roof"), F.lit(False))
    return df.withColumns(merged).drop(*vocab.FLAG_RULES)


def booleans_to_int(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {c: F.coalesce(_c(c), F.lit(False)).cast("int") for c in columns_of(df, "boolean")}
    )


def tidy_seller(df: DataFrame) -> DataFrame:
    return df.withColumn("seller_name", before_marker(F.col("seller_name")))


def iqr_fence(df: DataFrame, value: Column, width: float = 1.5) -> DataFrame:
    """One row ``low, high``: the quartiles of ``value`` widened by ``width`` times their distance."""
    q = exact_quantiles(df, [], {"q": value}, [0.25, 0.75]).select(
        F.col("q")[0].alias("q1"), F.col("q")[1].alias("q3")
    )
    reach = width * (F.col("q3") - F.col("q1"))
    return q.select((F.col("q1") - reach).alias("low"), (F.col("q3") + reach).alias("high"))


def drop_outliers(df: DataFrame, price: str = "price_numeric", width: float = 1.5) -> DataFrame:
    """Keep rows inside the fence on the log price; both bounds come from one scalar subquery."""
    logged = F.log1p(F.col(price))
    fence = iqr_fence(df, logged, width).select(F.struct("low", "high").alias("f")).scalar()
    return df.where((logged >= fence["low"]) & (logged <= fence["high"]))


def unique_counts(df: DataFrame, columns: list[str] | None = None, approx: bool = False) -> DataFrame:
    """Distinct non-null values per text column: ``column, n``.

    Values are reduced per (column, value) before anything is counted, so many
    columns do not multiply the rows that are shuffled.
    """
    columns = columns or columns_of(df, "text")
    pairs = [F.struct(F.lit(c).alias("column"), _c(c).alias("value")) for c in columns]
    long = df.select(F.inline(F.array(*pairs))).where(F.col("value").isNotNull())
    if approx:
        return long.groupBy("column").agg(F.approx_count_distinct("value").alias("n"))
    return long.distinct().groupBy("column").agg(F.count("*").alias("n"))


def describe_numbers(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, mean, sample standard deviation, minimum and maximum per column, long form."""
    stats = df.agg(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.count(_c(c)).alias("n"),
                F.avg(_c(c)).alias("mean"),
                F.stddev_samp(_c(c)).alias("std"),
                F.min(_c(c)).cast("double").alias("min"),
                F.max(_c(c)).cast("double").alias("max"),
            ).alias(f"_s{i}")
            for i, c in enumerate(columns)
        ]
    )
    return stats.select(F.inline(F.array(*[F.col(f"_s{i}") for i in range(len(columns))])))


def renamed(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed({old: new for old, new in names.items() if old in df.columns})


def underscored(df: DataFrame, known: list[str]) -> DataFrame:
    """Blanks become underscores, but only where the result is a known name."""
    clean_names = {c: c.replace(" ", "_") for c in df.columns}
    return df.withColumnsRenamed({old: new for old, new in clean_names.items() if new in known})


def prune_unused(df: DataFrame) -> DataFrame:
    return df.drop(*vocab.UNUSED_COLUMNS)


def lower_all(df: DataFrame) -> DataFrame:
    return lower_text(df)
