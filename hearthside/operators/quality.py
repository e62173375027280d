"""Coverage reports, fill counts and request validation."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from hearthside import vocab
from hearthside.functions.truth import missing, present
from hearthside.schemas import REQUEST_REQUIRED


def _long_counts(df: DataFrame, tests: dict[str, Column]) -> DataFrame:
    counted = df.agg(
        F.count("*").alias("_rows"),
        *[F.count_if(t).alias(f"_n{i}") for i, t in enumerate(tests.values())],
    )
    pairs = [F.struct(F.lit(n).alias("feature"), F.col(f"_n{i}").alias("filled")) for i, n in enumerate(tests)]
    share = F.when(F.col("_rows") > 0, F.col("filled") / F.col("_rows") * 100).otherwise(0.0)
    return counted.select("_rows", F.inline(F.array(*pairs))).select("feature", "filled", share.alias("pct"))


def coverage(df: DataFrame, features: list[str] = vocab.EXTRACTED_FEATURES) -> DataFrame:
    """How many rows have a usable value, per feature, in one scan."""
    return _long_counts(df, {f: present(df, f) for f in features if f in df.columns})


def crawl_coverage(df: DataFrame) -> DataFrame:
    tests = {
        "price": present(df, "price_numeric"),
        "bedrooms": present(df, "bedrooms"),
        "area": present(df, "area_numeric"),
        "price_per_sqm": present(df, "price_per_sqm"),
        "city": present(df, "city"),
        "geo": present(df, "latitude"),
        "property_type": present(df, "property_type"),
        "seller_type": present(df, "seller_type"),
        "description": F.length(F.coalesce("description", F.lit(""))) > 30,
    }
    return _long_counts(df, tests)


def newly_filled(df: DataFrame, pairs: dict[str, tuple[str, str]]) -> DataFrame:
    """Cells a pass filled; ``pairs`` maps a feature to its (before, after) columns."""
    return _long_counts(df, {f: missing(df, b) & present(df, a) for f, (b, a) in pairs.items()})


def validate_requests(df: DataFrame) -> DataFrame:
    """Typed request columns plus ``errors``, the names of absent or unreadable required fields.

    Amenity flags default to false. Good rows are those with an empty list.
    """
    names = set(df.columns)
    typed, errors = {}, []
    for field in REQUEST_REQUIRED.fields:
        raw = F.col(f"`{field.name}`") if field.name in names else F.lit(None)
        value = raw.cast("string") if isinstance(field.dataType, StringType) else raw.try_cast(field.dataType)
        typed[field.name] = value
        errors.append(F.when(value.isNull(), F.lit(field.name)))
    for flag_name in vocab.AMENITY_FLAGS:
        if flag_name not in names:
            typed[flag_name] = F.lit(False)
            continue
        raw = F.col(f"`{flag_name}`")
        value = raw.cast("string").try_cast("boolean")
        typed[flag_name] = F.coalesce(value, F.lit(False))
        errors.append(F.when(raw.isNotNull() & value.isNull(), F.lit(flag_name)))
    return df.withColumn("errors", F.filter(F.array(*errors), lambda e: e.isNotNull())).withColumns(typed)


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    checked = validate_requests(df)
    return checked.where(F.size("errors") == 0).drop("errors"), checked.where(F.size("errors") > 0)


def unread_report(df: DataFrame, text: str, step: str) -> DataFrame:
    """``step, n, texts`` per deciding step of a reading, with the number of different texts: what is read, and how much not."""
    per_text = df.groupBy(step, text).agg(F.count("*").alias("n"))
    return per_text.groupBy(step).agg(F.sum("n").alias("n"), F.count("*").alias("texts"))
