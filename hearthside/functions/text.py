"""String functions. All are Column -> Column and stay inside generated code."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from hearthside import vocab

UNICODE = "(?U)"
FOLDED = "(?iuU)"  # case-insensitive and Unicode-aware character classes
_BLANK = r"[\s\x1c-\x1f]"


def strip(text: Column) -> Column:
    return F.regexp_replace(text, UNICODE + f"^{_BLANK}+|{_BLANK}+$", "")


def clean_text(text: Column) -> Column:
    """Null becomes empty, runs of white space become one blank, ends are trimmed."""
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), UNICODE + _BLANK + "+", " "))


def ascii_digits(text: Column) -> Column:
    return F.translate(text, vocab.ARABIC_DIGITS, vocab.ASCII_DIGITS)


def any_digits(text: Column) -> Column:
    """Like :func:`ascii_digits`, for text that is about to be cast to a number."""
    return F.translate(
        text, vocab.ARABIC_DIGITS + vocab.PERSIAN_DIGITS, vocab.ASCII_DIGITS + vocab.ASCII_DIGITS
    )


def filled(text: Column) -> Column:
    """Null for empty text. A cast that meets an empty text raises and catches an error for every row; one that meets null does not."""
    return F.nullif(text, F.lit(""))


def parse_number(text: Column) -> Column:
    """First drop everything but digits and dots, then read a double; otherwise null."""
    return filled(F.regexp_replace(any_digits(text), "[^0-9.]", "")).try_cast("double")


def ad_id(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"ID(\d+)\.html", 1), F.lit(""))


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]


def lower_text(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.lower(F.col(f"`{c}`")) for c in text_columns(df)})


def amenity_flags(amenities: Column, names: list[str] = vocab.AMENITY_NAMES) -> dict[str, Column]:
    """One boolean per amenity name; substring hits count, null text gives null."""
    return {n: F.contains(F.lower(amenities), F.lit(n.lower())) for n in names}


def before_marker(text: Column, marker: str = "member since") -> Column:
    return F.substring_index(text, marker, 1)


def title_and_description(title: Column, description: Column) -> Column:
    return F.concat(F.coalesce(title, F.lit("")), F.lit(" "), F.coalesce(description, F.lit("")))


def drop_prefix(text: Column, prefix: str = "Description") -> Column:
    return F.when(text.startswith(prefix), strip(F.substr(text, F.lit(len(prefix) + 1)))).otherwise(text)


def head_chars(text: Column, n: int = vocab.REQUEST_TEXT_CHARS) -> Column:
    return F.substring(strip(text), 1, n)


def absolute_url(href: Column, base: str) -> Column:
    """Resolve ``href`` against the site root ``base`` (scheme and host only)."""
    root = base.rstrip("/")
    scheme = root.split(":", 1)[0]
    return (
        F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), href)
        .when(href.startswith("//"), F.concat(F.lit(scheme + ":"), href))
        .when(href.startswith("/"), F.concat(F.lit(root), href))
        .otherwise(F.concat(F.lit(root + "/"), href))
    )


def bracketed_count(text: Column) -> Column:
    """The number in the first "(1,234)", 0 when there is none."""
    digits = F.regexp_replace(F.regexp_extract(text, r"\(([0-9,]+)\)", 1), ",", "")
    return F.coalesce(filled(digits).try_cast("bigint"), F.lit(0))


def without_bracketed_count(text: Column) -> Column:
    return strip(F.regexp_replace(text, r"\s*\([0-9,]+\)\s*", ""))


def title_case(text: Column) -> Column:
    """Capital after every non-letter, so "stand-alone" becomes "Stand-Alone"."""
    runs = F.regexp_extract_all(F.lower(text), F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1))
    return F.array_join(F.transform(runs, F.initcap), "")


def thousands(value: Column) -> Column:
    return F.format_number(value, 0)


def join_list(values: Column) -> Column:
    return F.array_join(values, ", ")
