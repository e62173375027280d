"""Missing-value tests.

A value counts as missing when it is null, an empty string, zero or false. The
test depends on the column type, so these helpers read it from the schema.
"""

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, NumericType, StringType


def is_missing(value: Column, dtype: DataType) -> Column:
    """Reads ``value`` once, so an expensive column is not computed again by a pushed-down filter."""
    if isinstance(dtype, StringType):
        return F.coalesce(value, F.lit("")) == ""
    if isinstance(dtype, NumericType):
        return F.coalesce(value, F.lit(0).cast(dtype)) == 0
    if isinstance(dtype, BooleanType):
        return ~F.coalesce(value, F.lit(False))
    return value.isNull()


def missing(df: DataFrame, name: str) -> Column:
    return is_missing(F.col(f"`{name}`"), df.schema[name].dataType)


def present(df: DataFrame, name: str) -> Column:
    return ~missing(df, name)


def any_missing(df: DataFrame, names: list[str]) -> Column:
    return reduce(or_, [missing(df, n) for n in names])


def fill_missing(old: Column, new: Column, dtype: DataType) -> Column:
    """Keep ``old`` unless it is missing; a null ``new`` never replaces anything."""
    return F.when(is_missing(old, dtype) & new.isNotNull(), new).otherwise(old)


def either(a: Column, b: Column) -> Column:
    """Three-valued OR where one known false is enough for false."""
    return (
        F.when(F.coalesce(a, F.lit(False)) | F.coalesce(b, F.lit(False)), F.lit(True))
        .when(a.isNotNull() | b.isNotNull(), F.lit(False))
    )


def text_to_boolean(value: Column) -> Column:
    low = F.lower(value.cast("string"))
    return F.when(low == "true", F.lit(True)).when(low == "false", F.lit(False))


def flag(value: Column) -> Column:
    """Boolean (or 0/1 number) to 0/1, null counting as 0."""
    return F.coalesce(value.cast("int"), F.lit(0))


def without_nan(df: DataFrame) -> DataFrame:
    """NaN means missing in the incoming files; Spark would carry it through averages."""
    floats = [f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")]
    return df.withColumns(
        {c: F.when(~F.isnan(F.col(f"`{c}`")), F.col(f"`{c}`")) for c in floats}
    )
