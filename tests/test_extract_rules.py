"""The extraction rules against their bare patterns, on texts of odd letters."""

import random

from pyspark.sql import functions as F

from hearthside import vocab
from hearthside.functions import extract
from hearthside.functions.extract import Reader, folded
from hearthside.functions.text import FOLDED


def test_led_patterns_match_what_the_rules_match(spark):
    """Letters in front, words asked for first and the end after one match change no answer, whatever the text holds."""
    rng = random.Random(5)
    parts = [
        "Super", "ultra", "lux", "luxury", "FULLY", "ſemi", "fınished", "FİNISHED", "core", "and shell", "un", "finish", "سوبر", "لوكس", "تشطيب", "كامل",
        "متشطب", "نصف", "بدون", "على", "الطوب", "ground", "floor", "3rd", "12th", "no.", "الدور", "الأرضي", "الارضي", "ready to", "move", "immediate", "delivery",
        "receipt", "استلام", "تسليم", "فوري", "جاهز", "2027", "٢٠٢٦", "۷", "7", "1,200", "3.5", "20%", "EGP", "of", "down payment", "Dp", "مقدم", "install", "ınſtallment",
        "تقسيط", "أقساط", "up to", "year", "yr", "سنة", "سنوات", "monthly installment", "lagoon", "garden", "pool", "sea", "lake", "park", "view", "VIEW on", "ſwimming",
        "wide", "panoramic", "landscape", "street", "roof", "penthouse", "lift", "elevator", "مصعد", "parking", "garage", "جراج", "gated", "ſecurity", "أمن", "حمام سباحة",
        "حديقة", "روف", "̇", "i̇", "K", " ", "\n", "\x1c", "_", "-", "é",
    ]
    texts = ["".join(rng.choice(parts) + rng.choice(["", " ", " ", "\n"]) for _ in range(rng.randint(1, 14))) for _ in range(3000)]
    df = spark.createDataFrame([(i, x) for i, x in enumerate([*texts, "", None])], "i int, t string")
    low = F.lower("t")
    df = df.withColumn("p", low).withColumn("l", folded(F.col("p"))).withColumn("w", F.octet_length("l") != F.char_length("l"))
    reader = Reader(F.col("t"), F.col("p"), F.col("l"), F.col("w"))
    first = lambda p: F.get(F.regexp_extract_all("t", F.lit(FOLDED + p), F.lit(1)), F.lit(0))
    ruled = lambda rules: F.coalesce(*[first(p) if a is None else F.when(F.col("t").rlike(FOLDED + p), F.lit(str(a))) for p, a in rules])
    wanted = {
        "finish_type": (reader.finish_type(), ruled(vocab.FINISH_RULES)),
        "floor": (reader._ruled(vocab.FLOOR_RULES, extract._FLOOR_WORDS), ruled(vocab.FLOOR_RULES)),
        "delivery": (reader.delivery_hint(), ruled(vocab.DELIVERY_RULES)),
        "view": (reader.view_type(), ruled(vocab.VIEW_RULES)),
        "paid": (reader._first_capture(vocab.DOWN_PAYMENT_RULES, extract._DOWN_PAYMENT_WORDS), F.coalesce(*map(first, vocab.DOWN_PAYMENT_RULES))),
        "years": (reader._first_capture(vocab.INSTALMENT_YEAR_RULES, extract._INSTALMENT_WORDS), F.coalesce(*map(first, vocab.INSTALMENT_YEAR_RULES))),
        **{f: (reader.mentions(f), F.when(F.col("t").rlike(FOLDED + "|".join(p)), F.lit(True))) for f, p in vocab.FLAG_RULES.items()},
    }
    both = df.select("t", *[x.alias(n + side) for n, pair in wanted.items() for x, side in zip(pair, ("", "_by_rule"))]).collect()
    for n in wanted:
        assert [(r["t"], r[n]) for r in both if r[n] != r[n + "_by_rule"]] == []
        assert any(r[n] is not None for r in both)


def test_alternatives_are_led_by_their_letters():
    """Patterns that begin with alternatives are not tried at every letter, and flags neither."""
    for p in [vocab.DOWN_PAYMENT_RULES[0], vocab.INSTALMENT_YEAR_RULES[0], vocab.DELIVERY_RULES[1][0]]:
        assert extract._led(p).startswith("(?=[")
    assert set(extract._FLAG_FIRST) == set(vocab.FLAG_RULES)
