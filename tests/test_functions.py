"""Rule tables: input text and the expected value."""

import datetime
import random
import re
import warnings

import pandas as pd
import pytest
from pyspark.sql import functions as F

from hearthside import vocab
from hearthside.functions import text
from hearthside.functions.dates import posted_date, with_calendar_date, with_delivery_months
from hearthside.functions.extract import Reader, enrich, extract
from hearthside.functions.features import delivery_bucket, halved_zero, price_from_log, price_per_sqm, round_cents
from hearthside.functions.truth import either, fill_missing, text_to_boolean


def table(spark, fn, pairs, kind="string"):
    """Assert fn(input) for each (input, expected) pair in one job."""
    rows = [(i, v) for i, (v, _) in enumerate(pairs)]
    df = spark.createDataFrame(rows, f"i int, v {kind}")
    got = {r["i"]: r["o"] for r in df.select("i", fn(F.col("v")).alias("o")).collect()}
    for i, (value, expected) in enumerate(pairs):
        assert got[i] == expected, (value, got[i], expected)


def test_clean_text(spark):
    table(spark, text.clean_text, [(None, ""), ("  a \n\t b c ", "a b c"), ("", ""), ("x\x1fy", "x y")])


def test_numbers(spark):
    table(
        spark, text.parse_number,
        [("EGP 4,500,000", 4500000.0), ("١٦٨ SQM", 168.0), ("1.2.3", None), ("", None), (None, None), ("none", None), (".5", 0.5), ("7.", 7.0), (".", None)],
    )


def test_small_text_functions(spark):
    table(spark, text.ad_id, [("https://x/en/ad/a-ID123.html", "123"), ("https://x/ID.html", ""), (None, "")])
    table(spark, text.before_marker, [("ali member since 2020", "ali "), ("nobody", "nobody"), (None, None)])
    table(spark, text.drop_prefix, [("Description  Nice", "Nice"), ("A Description", "A Description"), ("Description", "")])
    table(spark, text.bracketed_count, [("New Cairo (23,835)", 23835), ("New Cairo", 0)])
    table(spark, text.without_bracketed_count, [("New Cairo (23,835) ", "New Cairo"), ("(1) A (2)", "A")])
    table(spark, text.title_case, [("stand alone-villa o'neil 2nd", "Stand Alone-Villa O'Neil 2Nd"), ("", "")])
    table(spark, text.thousands, [(1234567.5, "1,234,568"), (2.5, "2"), (0.0, "0")], "double")
    base = "https://site.example"
    table(
        spark, lambda c: text.absolute_url(c, base),
        [("/en/a", base + "/en/a"), ("x.html", base + "/x.html"), ("https://o/x", "https://o/x"), ("//cdn/x", "https://cdn/x")],
    )
    table(spark, text.head_chars, [("  " + "x" * 900, "x" * 800)])


def test_finish_rules(spark):
    table(
        spark, lambda c: Reader(c).finish_type(),
        [
            ("Ultra super LUX flat", "super_lux"), ("fully-finished", "fully_finished"), ("semi finished", "semi_finished"),
            ("unfinished", "unfinished"), ("core & shell", "unfinished"), ("a luxury flat", "lux"), ("lux finish", None),
            ("luxor", None), ("deluxe", None), ("سوبر لوكس", "super_lux"), ("متشطب", "fully_finished"), ("نصف تشطيب", "semi_finished"),
            ("على الطوب", "unfinished"), ("لوكس", "lux"), ("super luxury fully finished", "super_lux"), ("", None), (None, None),
        ],
    )


def test_floor_rules(spark):
    table(
        spark, lambda c: Reader(c).floor_number(),
        [
            ("Ground Floor", 0), ("3rd floor", 3), ("floor no. 12", 12), ("floor 123", 12), ("الدور الأرضي", 0), ("الدور 7", 7),
            ("الدور ٩", 9), ("٣rd floor", 3), ("top floor", None), ("floor 2, ground floor", 0),
        ],
    )


def test_delivery_hint_rules(spark):
    table(
        spark, lambda c: Reader(c).delivery_hint(),
        [
            ("ready to move now", "immediate"), ("readymove", "immediate"), ("delivery in 2026", "2026"), ("2027 delivery", "2027"),
            ("استلام 2025", "2025"), ("استلام فوري", "immediate"), ("جاهز", "immediate"), ("delivered 2026", None), ("استلام ٢٠٢٦", "٢٠٢٦"),
        ],
    )


def test_view_rules(spark):
    table(
        spark, lambda c: Reader(c).view_type(),
        [
            ("Lagoon View", "lagoon"), ("view on swimming pool", "pool"), ("panoramic view", "panoramic"), ("sea view and garden view", "garden"),
            ("park view", "park"), ("view park", None), ("view on lake", "lake"), ("nice view", None),
        ],
    )


def test_money_rules(spark):
    table(
        spark, lambda c: Reader(c).down_payment(),
        [
            ("down payment of EGP 1,250,000.5", 1250000.5), ("DP 10%", 10.0), ("500,000 down payment", 500000.0), ("مقدم 300000", 300000.0),
            ("down payment ,", None), ("down payment ١٠%", None), ("no money", None), ("down payment , or 70 dp", None),
        ],
    )
    table(
        spark, lambda c: Reader(c).instalment_years(),
        [("installment up to 8 years", 8), ("7 years installment", None), ("7 year installment", 7), ("تقسيط 10 سنوات", 10), ("monthly installment 5,000", None)],
    )
    table(
        spark, lambda c: Reader(c).monthly_instalment(),
        [("monthly installment of EGP 5,000", 5000.0), ("monthly installment 5000, 7 year install", None), ("monthly rent 5", None)],
    )


def test_flags_and_compounds(spark):
    table(spark, lambda c: Reader(c).mentions("has_garden"), [("Garden", True), ("gardens", None), ("حديقة خاصة", True), (None, None)])
    table(spark, lambda c: Reader(c).mentions("has_roof"), [("PENTHOUSE", True), ("proof", None)])
    table(spark, lambda c: Reader(c).mentions("has_elevator"), [("lift", True), ("uplift", None), ("أسانسير", True)])
    table(
        spark, lambda c: Reader(c).compound_name(),
        [("in HYDE PARK", "Hyde Park"), ("Mountain View Hyde Park", "Mountain View Hyde Park"), ("badya and mivida", "Mivida"), ("nowhere", None)],
    )


FRAGMENTS = [
    "super lux", "ULTRA super luxury", "fully_finished", "semi-finished", "unfinished", "core and shell", "lux", "luxury finish", "سوبر لوكس", "تشطيب كامل",
    "بدون تشطيب", "ground floor", "2nd floor", "floor no. 4", "الدور 5", "الدور الارضي", "ready to move", "immediate receipt", "delivery 2026", "2027 استلام",
    "جاهز", "view on garden", "pool view", "wide view", "street view", "view sea", "down payment 10%", "dp of EGP 1,000", "5,5.25 dp", "مقدم 90", "install over 3 yr",
    "4 year installment", "monthly installment EGP 7,000", "تقسيط 6 سنة", "garden", "roof", "penthouse", "lift", "garage", "swimming pool", "gated", "أمن", "حمام سباحة",
    "Hyde Park", "o west", "Lake View", "fınished", "luxuries", "ſuper lux", "12", "%", ",", "EGP", "٣", "view",
]


def by_python(value, rules, first=True):
    """Brute force with the other regular-expression engine."""
    for rule in rules:
        pattern, answer = rule if isinstance(rule, tuple) else (rule, None)
        m = re.search(pattern, value, re.IGNORECASE)
        if m:
            return answer if answer is not None else m.group(1)
    return None


def test_rules_agree_with_brute_force(spark):
    rng = random.Random(11)
    texts = [rng.choice([" ", ", ", ""]).join(rng.choices(FRAGMENTS, k=rng.randint(1, 6))) for _ in range(1500)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = extract(df, F.col("t")).collect()
    for row in got:
        t = row["t"]
        assert row["found_finish_type"] == by_python(t, vocab.FINISH_RULES), t
        assert row["found_view_type"] == by_python(t, vocab.VIEW_RULES), t
        assert row["found_delivery_date"] == by_python(t, vocab.DELIVERY_RULES), t
        floor = by_python(t, vocab.FLOOR_RULES)
        assert row["found_floor_number"] == (None if floor is None else int(floor)), t
        paid = by_python(t, vocab.DOWN_PAYMENT_RULES)
        paid = None if paid is None or "%" in paid else paid.replace(",", "")
        assert row["found_down_payment_egp"] == (float(paid) if paid else None), t
        years = by_python(t, vocab.INSTALMENT_YEAR_RULES)
        assert row["found_installment_years"] == (None if years is None else int(years)), t
        monthly = None if years is not None else by_python(t, [vocab.INSTALMENT_MONTH_RULE])
        monthly = monthly.replace(",", "") if monthly else None
        assert row["found_monthly_installment_egp"] == (float(monthly) if monthly else None), t
        for flag, patterns in vocab.FLAG_RULES.items():
            hit = any(re.search(p, t, re.IGNORECASE) for p in patterns)
            assert row["found_" + flag] == (True if hit else None), (flag, t)
        name = next((n for n in vocab.COMPOUNDS if n.lower() in t.lower()), None)
        assert row["found_compound_name"] == name, t


def test_enrichment_keeps_existing_values(spark):
    df = spark.createDataFrame(
        [("Flat", "fully finished, floor 3", "lux", 0), (None, "semi finished, ground floor", "", None), ("x", None, None, 5)],
        "title string, description string, finish_type string, floor_number int",
    )
    got = [(r["finish_type"], r["floor_number"]) for r in enrich(df).collect()]
    assert got == [("lux", 3), ("semi_finished", 0), (None, 5)]


AS_OF = datetime.date(2025, 6, 15)


def months(y, m, d):
    return (datetime.date(y, m, d) - AS_OF).days / 30.4375


@pytest.mark.parametrize(
    "value,expected",
    [
        (None, 0.0), ("", 0.0), ("NaN", 0.0), ("None", 0.0), ("Ready to move", 0.0), ("ready-to-move", 0.0), ("under_construction", 0.0), ("this year", months(2025, 12, 31)),
        ("next year", months(2026, 1, 1)), ("current year", 0.0), ("Soon", 1.0), ("very  soon", 0.5), ("6 months to a year", 9.0), ("within one year", 12.0),
        ("2024-2027", months(2027, 12, 31)), ("2020/2024", 0.0), ("2026", months(2026, 12, 31)), ("2025", months(2025, 12, 31)), ("1999", 0.0), ("٢٠٢٧", months(2027, 12, 31)),
        ("Jun-27", months(2027, 6, 1)), ("Sept 2026", months(2026, 9, 1)), ("dec/49", months(2049, 12, 1)), ("dec-50", 0.0), ("june 2027", months(2027, 6, 1)),
        ("4 months", 4.0), ("2.5 years", 30.0), ("2,5 years", 30.0), ("3y", 36.0), ("in 4m or so", 4.0), ("two years", 24.0), ("about eleven months", 11.0), ("May", 0.0),
        ("sept", 0.0), ("12", 0.0), ("999", 0.0), ("13/1/2027", months(2027, 1, 13)), ("6/1/2027", months(2027, 1, 6)), ("2027-05-01T00:00:00.000Z", months(2027, 1, 5)),
        ("15 May 2026", months(2026, 5, 15)), ("whenever", 0.0), ("q4 2026", 0.0), ("31/2/2027", 0.0), ("6/1/2020", 0.0), ("١٢٣٬٤٥٦", 0.0),
    ],
)
def test_delivery_months(spark, value, expected):
    df = spark.createDataFrame([(value,)], "v string")
    got = with_delivery_months(df, "v", "m", F.lit(AS_OF)).first()["m"]
    assert got == pytest.approx(expected, abs=1e-12)


def test_calendar_dates_agree_with_pandas(spark):
    rng = random.Random(3)
    layouts = ["{d}/{m}/{y}", "{d}-{m}-{y}", "{y}-{m:02d}-{d:02d}", "{y}/{m}/{d}", "{d} {w} {y}", "{w} {y}", "{w} {d} {y}", "{y}-{m:02d}-{d:02d} 10:30:00", "{m}/{y}", "{y}{m:02d}{d:02d}"]
    words = ["jan", "february", "mar", "april", "may", "june", "jul", "august", "sept", "oct", "november", "dec"]
    values = sorted(
        {rng.choice(layouts).format(d=rng.randint(1, 28), m=(m := rng.randint(1, 12)), y=rng.randint(2024, 2031), w=words[m - 1]) for _ in range(300)}
    )
    df = spark.createDataFrame([(v,) for v in values], "raw string")
    got = {r["raw"]: r["d"] for r in with_calendar_date(df, "raw", "d", F.lit(AS_OF)).collect()}
    for v in values:
        with warnings.catch_warnings():
            warnings.simplefilter("ignore")
            want = pd.to_datetime(v, errors="coerce", utc=True, dayfirst=True)
        assert got[v] == (None if pd.isna(want) else want.date()), v


def test_posted_date(spark):
    table(
        spark, posted_date,
        [("x 3 Days ago y", "3 Days ago"), ("on Jan 5, 2024", "Jan 5, 2024"), ("March 12 2024; 1 hour ago", "1 hour ago"), ("none", ""), (None, "")],
    )


def test_buckets_are_right_closed(spark):
    table(spark, delivery_bucket, [(0.0, 0), (0.5, 0), (0.51, 1), (12.0, 1), (12.01, 2), (24.0, 2), (24.5, 3), (None, None)], "double")


def test_numbers_and_rounding(spark):
    table(spark, halved_zero, [(0.0, 0.5), (2.0, 2.0), (None, None)], "double")
    table(spark, price_from_log, [(0.0, 0.0), (100.0, 100.0), (5000.0, 5000.0)], "double")
    rng = random.Random(8)
    values = [2.675, 1.005, 0.125, 0.375, 2.5, 1009.045, 0.0, 1e9 + 0.005] + [rng.randint(1, 10**9) / 1000 for _ in range(3000)]
    table(spark, round_cents, [(v, round(v, 2)) for v in values], "double")
    df = spark.createDataFrame([(100.0, 3.0), (0.0, 3.0), (100.0, 0.0), (None, 1.0)], "p double, a double")
    assert [r[0] for r in df.select(price_per_sqm(F.col("p"), F.col("a"))).collect()] == [33.33, None, None, None]


def test_three_valued_or(spark):
    values = [True, False, None]
    rows = [(a, b) for a in values for b in values]
    df = spark.createDataFrame(rows, "a boolean, b boolean")
    for row in df.select("a", "b", either(F.col("a"), F.col("b")).alias("o")).collect():
        known = [v for v in (row["a"], row["b"]) if v is not None]
        assert row["o"] == (True if True in known else False if known else None)
    table(spark, text_to_boolean, [("True", True), ("FALSE", False), ("1", None), (None, None)])


def test_fill_missing(spark):
    df = spark.createDataFrame([(None, 1), (0, 2), (5, 3), (0, None)], "o int, n int")
    kind = df.schema["o"].dataType
    assert [r[0] for r in df.select(fill_missing(F.col("o"), F.col("n"), kind)).collect()] == [1, 2, 5, 0]
