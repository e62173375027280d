"""Engineered features. Training and scoring both use these same Columns."""

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthside import vocab
from hearthside.functions.truth import flag


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def halved_zero(value: Column) -> Column:
    return F.when(value == 0, F.lit(0.5)).otherwise(value.cast("double"))


def round_cents(x: Column) -> Column:
    """Two decimals from the exact binary value, halves to even.

    ``bround`` looks at the shortest decimal text, so 2.675 (which is stored slightly
    below) would go up. Here ``x * 100`` is split into its rounded product and the
    exact error, and the error decides what looks like a half.
    """
    product = x * 100
    wide = x * 134217729.0
    top = wide - (wide - x)
    error = (top * 100 - product) + (x - top) * 100
    down = F.floor(product).cast("double")
    rest = product - down
    up = (rest > 0.5) | ((rest == 0.5) & ((error > 0) | ((error == 0) & (down % 2 != 0))))
    return F.when(up, down + 1).otherwise(down) / 100


def price_per_sqm(price: Column, area: Column) -> Column:
    """Rounded to two decimals; null when price or area is missing or zero."""
    return F.when((price != 0) & (area > 0), round_cents(price / area))


def ratios(area: str = "area_sqm") -> dict[str, Column]:
    beds, baths, size = F.col("bedrooms"), F.col("bathrooms"), F.col(area)
    return {
        "area_per_bedroom": size / halved_zero(beds),
        "area_per_bathroom": size / halved_zero(baths),
        "bed_bath_ratio": beds / halved_zero(baths),
        "total_rooms": (beds + baths).cast("double"),
    }


def amenity_score(df: DataFrame) -> Column:
    have = [c for c in vocab.AMENITY_FLAGS if c in df.columns]
    return reduce(add, [flag(_c(c)) for c in have])


def is_compound(name: Column) -> Column:
    return F.when(F.lower(name) != "unknown", 1).otherwise(0)


def delivery_bucket(months: Column) -> Column:
    """Right-closed: 0.5 is bucket 0, 12 is bucket 1, 24 is bucket 2."""
    return F.when(months <= 0.5, 0).when(months <= 12, 1).when(months <= 24, 2).when(months > 24, 3)


def one_hot(df: DataFrame, domains: dict[str, list[str]] = vocab.ONE_HOT_VALUES) -> DataFrame:
    """Replace each column by 0/1 columns named ``column_value``; other values give zeros."""
    made = {
        f"{name}_{value}": F.when(F.lower(_c(name)) == value, 1).otherwise(0)
        for name, values in domains.items()
        for value in values
    }
    return df.withColumns(made).drop(*domains)


def engineer(df: DataFrame, area: str = "area_sqm") -> DataFrame:
    return df.withColumns(
        {
            **ratios(area),
            "amenity_score": amenity_score(df),
            "is_compound": is_compound(F.col("compound_name")),
            "delivery_bucket": delivery_bucket(F.col("delivery_date")),
        }
    )


def price_from_log(prediction: Column) -> Column:
    """Predictions below 100 are on the log scale."""
    return F.when(prediction < 100, F.expm1(prediction)).otherwise(prediction)

