"""Feature extraction from bilingual free text.

Every feature is an ordered list of rules and the first rule that hits decides.
``coalesce`` and ``when`` stop at the first hit, so later patterns are not run.
"""

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthside import vocab
from hearthside.functions.text import FOLDED, any_digits, title_and_description
from hearthside.functions.truth import fill_missing
from hearthside.schemas import EXTRACTED

# Words of which a text must hold at least one for the rule to hit, per rule. A plain
# substring search is far cheaper than a pattern, and most rules miss most texts.
_FINISH_WORDS = [
    ["super"], ["fully"], ["semi"], ["finished", "core"], ["lux"],
    ["سوبر"], ["تشطيب", "متشطب"], ["نصف"], ["بدون", "الطوب"], ["لوكس"],
]
_FLOOR_WORDS = [["ground"], ["floor"], ["floor"], ["الأرضي", "الارضي"], ["الدور"]]
_DELIVERY_WORDS = [
    ["ready", "immediate"], ["delivery", "استلام", "تسليم"], ["delivery", "استلام", "تسليم"], ["استلام", "جاهز"],
]
_VIEW_WORDS = [
    ["lagoon"], ["garden"], ["pool"], ["landscape"], ["open", "wide", "panoramic"], ["street"], ["lake"], ["sea"], ["park"],
]
_DOWN_PAYMENT_WORDS = [["payment", "dp", "مقدم"], ["payment", "dp", "مقدم"], ["payment", "dp"]]
_INSTALMENT_WORDS = [["install", "تقسيط"], ["install", "تقسيط", "أقساط"]]
_MONTHLY_WORDS = ["monthly"]
_FLAG_WORDS = {
    "has_garden": ["garden", "حديقة", "جنينة"],
    "has_roof": ["roof", "روف", "penthouse"],
    "has_elevator": ["elevator", "lift", "أسانسير", "مصعد"],
    "has_parking": ["parking", "garage", "جراج", "بارك"],
    "has_pool": ["pool", "حمام"],
    "has_security": ["security", "gated", "أمن", "حراسة", "سيكيورتي"],
}

# Letters with which a match of the rule begins. Java tries every alternative of a pattern at every letter of the text; a
# class in front of them turns most letters away at once. Rules that begin with one word or a number gain nothing.
_FIRST = dict(
    [
        *zip([p for p, _ in vocab.FINISH_RULES], ["us", "", "", "uc", "", "", "تم", "", "بع", ""], strict=True),
        *zip([p for p, _ in vocab.DELIVERY_RULES], ["ri", "dات", "", "اج"], strict=True),
        *zip([p for p, _ in vocab.VIEW_RULES], ["lv", "gv", "pv", "lv", "owp", "sv", "lv", "sv", ""], strict=True),
        *zip(vocab.DOWN_PAYMENT_RULES, ["dم", "", "d"], strict=True),
        *zip(vocab.INSTALMENT_YEAR_RULES, ["iت", ""], strict=True),
    ]
)
_FLAG_FIRST = {
    "has_garden": "gحج", "has_roof": "rرp", "has_elevator": "elأم", "has_parking": "pgجب", "has_pool": "spح",
    "has_security": "sgأحس",
}


def _led(pattern: str, first: str | None = None) -> str:
    """A pattern with the same matches that is only tried where one of its first letters stands."""
    letters = _FIRST.get(pattern, "") if first is None else first
    return f"(?=[{letters}])(?:{pattern})" if letters else f"(?:{pattern})"


def folded(plain: Column) -> Column:
    """Lower-case text with the letters that match a plain i or s spelled as such.

    Few texts hold one of them, and looking for three letters is cheaper than copying a text letter by letter.
    """
    odd = "ſı\u0307"
    return F.when(reduce(or_, [F.contains(plain, F.lit(c)) for c in odd]), F.translate(plain, odd, "si")).otherwise(plain)


class Reader:
    """The feature rules over a text column, its lower-case and its :func:`folded` form.

    Pass the latter two as columns of an earlier projection; every rule reads them. ``wide`` (such a column, too) is false
    where the text is plain ASCII, so that no Arabic word is looked for.
    """

    def __init__(self, text: Column, plain: Column | None = None, low: Column | None = None, wide: Column | None = None):
        self.text = text
        self.plain = plain if plain is not None else F.lower(text)
        self.low = low if low is not None else folded(self.plain)
        self.wide = wide

    def _may(self, words: list[str]) -> Column:
        held = lambda some: reduce(or_, [F.contains(self.low, F.lit(w)) for w in some])
        latin = [w for w in words if w.isascii()]
        other = [w for w in words if not w.isascii()]
        if self.wide is None or not other:
            return held(words)
        return held(latin) | (self.wide & held(other)) if latin else self.wide & held(other)

    def _hits(self, pattern: str, words: list[str], first: str | None = None) -> Column:
        return self._may(words) & self.text.rlike(FOLDED + _led(pattern, first))

    def _captured(self, pattern: str, words: list[str]) -> Column:
        """The match takes in the rest of the text, so no further ones are looked for."""
        found = F.regexp_extract_all(self.text, F.lit(FOLDED + _led(pattern) + "(?s:.*)"), F.lit(1))
        return F.when(self._may(words), F.get(found, F.lit(0)))

    def _ruled(self, rules: list[tuple], words: list[list[str]]) -> Column:
        """Fixed answer of the first rule that hits, or its captured text where the answer is None."""
        return F.coalesce(
            *[
                self._captured(pattern, need)
                if answer is None
                else F.when(self._hits(pattern, need), F.lit(str(answer)))
                for (pattern, answer), need in zip(rules, words, strict=True)
            ]
        )

    def _first_capture(self, patterns: list[str], words: list[list[str]]) -> Column:
        return F.coalesce(*[self._captured(p, need) for p, need in zip(patterns, words, strict=True)])

    def finish_type(self) -> Column:
        return self._ruled(vocab.FINISH_RULES, _FINISH_WORDS)

    def floor_number(self) -> Column:
        return any_digits(self._ruled(vocab.FLOOR_RULES, _FLOOR_WORDS)).try_cast("int")

    def delivery_hint(self) -> Column:
        return self._ruled(vocab.DELIVERY_RULES, _DELIVERY_WORDS)

    def view_type(self) -> Column:
        return self._ruled(vocab.VIEW_RULES, _VIEW_WORDS)

    def down_payment(self) -> Column:
        """The first rule that hits ends the search, even when its text is no number."""
        return _amount(self._first_capture(vocab.DOWN_PAYMENT_RULES, _DOWN_PAYMENT_WORDS))

    def instalment_years(self) -> Column:
        return _amount(self._first_capture(vocab.INSTALMENT_YEAR_RULES, _INSTALMENT_WORDS)).try_cast("int")

    def monthly_instalment(self) -> Column:
        """Read only when no rule for years hit."""
        years = [self._hits(p, need) for p, need in zip(vocab.INSTALMENT_YEAR_RULES, _INSTALMENT_WORDS, strict=True)]
        monthly = self._captured(vocab.INSTALMENT_MONTH_RULE, _MONTHLY_WORDS)
        return F.when(self._may(_MONTHLY_WORDS) & ~(years[0] | years[1]), _amount(monthly))

    def mentions(self, feature: str) -> Column:
        """True or null; absence from the text is never read as false."""
        return F.when(self._hits("|".join(vocab.FLAG_RULES[feature]), _FLAG_WORDS[feature], _FLAG_FIRST[feature]), F.lit(True))

    def compound_name(self, names: list[str] = vocab.COMPOUNDS) -> Column:
        """First listed name contained in the text, whatever its case."""
        return F.coalesce(*[F.when(F.contains(self.plain, F.lit(n.lower())), F.lit(n)) for n in names])

    def features(self) -> dict[str, Column]:
        found = {
            "finish_type": self.finish_type(),
            "compound_name": self.compound_name(),
            "down_payment_egp": self.down_payment(),
            "installment_years": self.instalment_years(),
            "monthly_installment_egp": self.monthly_instalment(),
            "floor_number": self.floor_number(),
            "delivery_date": self.delivery_hint(),
            "view_type": self.view_type(),
        }
        found.update({f: self.mentions(f) for f in vocab.FLAG_RULES})
        return found


def _amount(captured: Column) -> Column:
    return F.replace(any_digits(captured), F.lit(","), F.lit("")).try_cast("double")


def extract(df: DataFrame, text: Column | None = None, prefix: str = "found_") -> DataFrame:
    """Add one ``found_*`` column per feature.

    The text is built and lowered in a projection of its own, so each rule reads a
    plain column and the text is assembled once per row.
    """
    if text is None:
        text = title_and_description(F.col("title"), F.col("description"))
    base = df.withColumn("_text", text).withColumn("_plain", F.lower("_text")).withColumn("_low", folded(F.col("_plain")))
    base = base.withColumn("_wide", F.octet_length("_low") != F.char_length("_low"))
    found = Reader(F.col("_text"), F.col("_plain"), F.col("_low"), F.col("_wide")).features()
    return base.withColumns({prefix + n: found[n] for n in vocab.EXTRACTED_FEATURES}).drop("_text", "_plain", "_low", "_wide")


def enrich(df: DataFrame, text: Column | None = None) -> DataFrame:
    """Fill the extracted features; a value that is already there wins."""
    found = extract(df, text)
    present = set(df.columns)
    merged = {}
    for field in EXTRACTED.fields:
        new = F.col("found_" + field.name)
        merged[field.name] = (
            fill_missing(F.col(field.name), new, field.dataType) if field.name in present else new
        )
    return found.withColumns(merged).drop(*["found_" + f for f in vocab.EXTRACTED_FEATURES])
