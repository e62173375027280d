"""Exact quantiles that never gather or sort a group's values: radix selection on the bits of the double.

A double is turned into a whole number that has the same order: sign, exponent and mantissa in one. The number is cut into
digits, from the highest on. A pass counts the rows per group, measure and digit, among the rows that agree with a wanted
value in all earlier digits; a running sum over these counts names the digit that holds each wanted rank. After the last
pass the digits are the value. Partial counts merge before the shuffle, so a group with a third of all rows, and values that
lie close together, cost as much as any others: no window sees more than 2^22 counts. Every pass is one scan of the group
keys and the measures' numbers for all groups and measures; these are written once before, so that no pass repeats what they
are made from. Counts do not depend on task order, so re-run tasks give the same
answer.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from hearthside.session import cut_lineage, settle

# fixed values: bits of the mantissa and the exponent's offset of a double
MANTISSA, OFFSET = 52, 1023
#: Bits below the digits of the passes: the first digit holds the sign, the exponent and nine bits of the mantissa.
CUTS = (43, 22, 0)


def ordered_bits(x: Column) -> Column:
    """A whole number that orders like the double ``x``; null for null and NaN, one number for both zeros."""
    size = F.abs(x)
    # numbers below the smallest exponent are not normalised; the logarithm may be off by one next to a power of two
    guess = F.least(F.greatest(F.floor(F.log2(size)).cast("int"), F.lit(1 - OFFSET)), F.lit(OFFSET))
    part = size / F.pow(F.lit(2.0), guess)  # exact, as are all shifts of the exponent
    over, under = part >= 2, (part < 1) & (guess > 1 - OFFSET)
    exponent = guess + F.when(over, 1).when(under, -1).otherwise(0)
    mantissa = F.when(over, part / 2).when(under, part * 2).otherwise(part) * F.lit(float(1 << MANTISSA))
    number = F.shiftleft((exponent + OFFSET - 1).cast("bigint"), MANTISSA) + mantissa.cast("bigint")
    whole = F.when(size == float("inf"), F.lit((2 * OFFSET + 1) << MANTISSA)).when(size == 0, F.lit(0)).otherwise(number)
    return F.when(x.isNull() | F.isnan(x), F.lit(None).cast("bigint")).when(x < 0, -whole).otherwise(whole)


def from_ordered_bits(number: Column) -> Column:
    """The double behind :func:`ordered_bits`."""
    whole = F.abs(number)
    exponent = F.shiftright(whole, MANTISSA)
    mantissa = (whole % (1 << MANTISSA)).cast("double") / F.lit(float(1 << MANTISSA))
    normal = (mantissa + 1) * F.pow(F.lit(2.0), exponent - OFFSET)
    size = (
        F.when(exponent == 0, mantissa * F.pow(F.lit(2.0), F.lit(1 - OFFSET)))
        .when(exponent > 2 * OFFSET, F.lit(float("inf")))
        .otherwise(normal)
    )
    return F.when(number < 0, -size).otherwise(size)


def _ranks(prob: float, n: Column) -> tuple[Column, Column]:
    position = F.lit(float(prob)) * (n - 1)
    return F.floor(position), F.ceil(position)


def _long_form(df: DataFrame, by: list[str], measures: dict[str, Column]) -> DataFrame:
    """One row per measured value; null keys and missing values (null, NaN) carry no value."""
    kept = df.select(
        *[F.col(f"`{k}`") for k in by],
        *[v.cast("double").alias(f"_m{i}") for i, v in enumerate(measures.values())],
    )
    for k in by:
        kept = kept.where(F.col(f"`{k}`").isNotNull())
    kept = cut_lineage(kept.withColumns({f"_m{i}": ordered_bits(F.col(f"_m{i}")) for i in range(len(measures))}))
    if len(measures) == 1:
        return kept.withColumn("_measure", F.lit(0)).withColumnRenamed("_m0", "_bits")
    pairs = [F.struct(F.lit(i).alias("_measure"), F.col(f"_m{i}").alias("_bits")) for i in range(len(measures))]
    return kept.select(*by, F.inline(F.array(*pairs)))


def _digit(cut: int) -> Column:
    """What the number has above its lowest ``cut`` bits; negative numbers round down, which keeps the order."""
    return F.shiftright("_bits", cut)


def exact_quantiles(df: DataFrame, by: list[str], measures: dict[str, Column], probs: list[float]) -> DataFrame:
    """Linear-interpolated quantiles per group.

    Returns ``by`` plus, per measure, an array column with one value per
    probability (null where a group has no value). Without ``by`` there is one row.
    """
    values = _long_form(df, by, measures)
    group = [*by, "_measure"]
    first = values.groupBy(*group, _digit(CUTS[0]).alias("_digit")).agg(F.count("*").alias("_c"))
    run = W.partitionBy(*group).orderBy(F.col("_digit").asc_nulls_first()).rowsBetween(W.unboundedPreceding, 0)
    valued = F.when(F.col("_digit").isNotNull(), F.col("_c")).otherwise(0)
    counted = first.withColumns({"_stop": F.sum(valued).over(run), "_n": F.sum(valued).over(W.partitionBy(*group))})
    counted = counted.withColumn("_start", F.col("_stop") - valued)
    # the wanted ranks that a digit holds; the rows of a group without any value stay as a marker
    ranks = F.array_distinct(F.array(*[r for p in probs for r in _ranks(p, F.col("_n"))]))
    here = lambda r: (r >= F.col("_start")) & (r < F.col("_stop"))
    held = counted.withColumn("_ranks", F.filter(ranks, here)).where("size(_ranks) > 0 OR (_n = 0 AND _digit IS NULL)")
    # a settled target table has a known size, so that the rows are not shuffled to meet a small one
    targets = settle(held.select(*group, "_digit", "_start", "_n", "_ranks"))

    for above, cut in zip(CUTS, CUTS[1:]):
        # rows that agree with a target in all digits so far, counted by the next digit
        inside = values.withColumn("_digit", _digit(above)).join(targets.where("_n > 0"), [*group, "_digit"])
        prefix = [*group, "_digit", "_start", "_n", "_ranks"]
        finer = inside.groupBy(*prefix, _digit(cut).alias("_finer")).agg(F.count("*").alias("_c"))
        run = W.partitionBy(*group, "_digit").orderBy("_finer").rowsBetween(W.unboundedPreceding, 0)
        placed = finer.withColumn("_stop", F.col("_start") + F.sum("_c").over(run)).withColumn("_start", F.col("_stop") - F.col("_c"))
        held = placed.withColumn("_ranks", F.filter("_ranks", here)).where("size(_ranks) > 0")
        found = held.select(*group, F.col("_finer").alias("_digit"), "_start", "_n", "_ranks")
        targets = settle(found.unionByName(targets.where("_n = 0")))

    def at(rank: Column, measure: int) -> Column:
        mine = (F.col("_measure") == measure) & F.array_contains("_ranks", rank)
        return F.max(F.when(mine, from_ordered_bits(F.col("_digit"))))

    picked = []
    for i in range(len(measures)):
        n = F.when(F.col("_measure") == i, F.col("_n"))
        picked.append(F.max(n).alias(f"_n{i}"))
        for j, p in enumerate(probs):
            low, high = _ranks(p, F.col("_n"))
            picked.append(at(low, i).alias(f"_lo{i}_{j}"))
            picked.append(at(high, i).alias(f"_hi{i}_{j}"))
    wide = targets.groupBy(*by).agg(*picked)

    def interpolate(i: int, j: int, p: float) -> Column:
        position = F.lit(float(p)) * (F.col(f"_n{i}") - 1)
        low, high = F.col(f"_lo{i}_{j}"), F.col(f"_hi{i}_{j}")
        return low + (high - low) * (position - F.floor(position))

    return wide.select(
        *[F.col(f"`{k}`") for k in by],
        *[
            F.array(*[interpolate(i, j, p) for j, p in enumerate(probs)]).alias(name)
            for i, name in enumerate(measures)
        ],
    )


def medians(
    df: DataFrame, by: list[str], measures: dict[str, Column], approx: bool = False
) -> DataFrame:
    """Median per group and measure; ``approx`` trades exactness for a single scan."""
    if approx:
        kept = df
        for k in by:
            kept = kept.where(F.col(f"`{k}`").isNotNull())
        return kept.groupBy(*by).agg(
            *[F.percentile_approx(v.cast("double"), 0.5).alias(name) for name, v in measures.items()]
        )
    found = exact_quantiles(df, by, measures, [0.5])
    return found.select(*[F.col(f"`{k}`") for k in by], *[F.col(n)[0].alias(n) for n in measures])
