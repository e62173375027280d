"""Market statistics that follow an ingest without reading earlier rows again.

A batch is reduced to a small state per place: counts, sums, extremes, counts per price bin and a HyperLogLog sketch of each
column whose distinct values are counted. States of batches merge by adding, taking extremes and uniting sketches, so the
statistics after any batch come from the states alone. A state is a folder per batch, and version N of the manifest lists
the states after batch N: a batch that is repeated replaces its own state, and any earlier time can be read.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from hearthside.sources.files import Manifests

#: States of a level that are merged into one of the next.
FAN = 8


class MarketState:
    """States under ``path`` per value of ``by``.

    ``measures`` have counts, sums, extremes and counts per bin of ``width``; ``distinct`` columns have sketches. Nulls carry no
    value; a null ``by`` is a place of its own. Sums are decimals with ``scale`` digits, so that they do not depend on the
    order of adding.
    """

    def __init__(self, spark: SparkSession, path: str, by: str, measures: dict[str, float], distinct: list[str], scale: int = 4, fan: int = FAN):
        self.spark, self.path, self.by, self.measures, self.distinct = spark, path, by, measures, distinct
        self.scale, self.fan = scale, fan
        self.manifests = Manifests(spark, f"{path}/versions")

    def _totals(self, merge: bool) -> list[Column]:
        out = [(F.sum("rows") if merge else F.count("*")).alias("rows")]
        for m in self.measures:
            value = F.col(f"`{m}`")
            number = value.cast(f"decimal({24 + self.scale},{self.scale})")
            kind = f"decimal(38,{self.scale})"
            out += [
                (F.sum(f"n_{m}") if merge else F.count(value)).alias(f"n_{m}"),
                F.sum(f"sum_{m}" if merge else number).cast(kind).alias(f"sum_{m}"),
                F.min(f"min_{m}" if merge else value).alias(f"min_{m}"),
                F.max(f"max_{m}" if merge else value).alias(f"max_{m}"),
            ]
        for c in self.distinct:
            out.append((F.hll_union_agg(f"hll_{c}") if merge else F.hll_sketch_agg(F.col(f"`{c}`"))).alias(f"hll_{c}"))
        return out

    def _write(self, name: str, totals: DataFrame, bins: DataFrame) -> None:
        totals.write.mode("overwrite").parquet(f"{self.path}/states/{name}/totals")
        bins.write.mode("overwrite").parquet(f"{self.path}/states/{name}/bins")

    def states(self, before: int | None = None) -> list[dict]:
        return self.manifests.read(self.manifests.latest(before))

    def _read(self, part: str, states: list[dict]) -> DataFrame:
        return reduce(DataFrame.unionByName, [self.spark.read.parquet(f"{self.path}/states/{s['name']}/{part}") for s in states])

    def add(self, rows: DataFrame, batch: int) -> None:
        """Reduce a batch to its state and write the batch's version."""
        bins = [
            F.struct(F.lit(m).alias("measure"), F.floor(F.col(f"`{m}`") / F.lit(float(width))).alias("bin")) for m, width in self.measures.items()
        ]
        place = F.col(f"`{self.by}`").alias("place")
        counted = rows.select(place, F.inline(F.array(*bins))).where("bin IS NOT NULL").groupBy("place", "measure", "bin").agg(F.count("*").alias("n"))
        self._write(f"batch-{batch}", rows.groupBy(place).agg(*self._totals(False)), counted)
        states, level = [*self.states(batch), {"name": f"batch-{batch}", "level": 0}], 0
        while len(mine := [s for s in states if s["level"] == level]) >= self.fan:
            name = f"merged-{level + 1}-{batch}"
            self._write(name, self._merged(mine), self._merged_bins(mine))
            states = [s for s in states if s["level"] != level] + [{"name": name, "level": level + 1}]
            level += 1
        self.manifests.write(batch, states)

    def _merged(self, states: list[dict]) -> DataFrame:
        return self._read("totals", states).groupBy("place").agg(*self._totals(True))

    def _merged_bins(self, states: list[dict]) -> DataFrame:
        return self._read("bins", states).groupBy("place", "measure", "bin").agg(F.sum("n").alias("n"))

    def statistics(self, version: int | None = None) -> DataFrame:
        """``place, rows`` and per measure ``n, mean, min, max, middle``, per distinct column ``distinct``, after a batch.

        ``middle`` is the bin that holds the lower median, from the merged counts.
        """
        states = self.manifests.read(self.manifests.latest() if version is None else version)
        run = W.partitionBy("place", "measure")
        bins = self._merged_bins(states).withColumns({"upto": F.sum("n").over(run.orderBy("bin")), "all": F.sum("n").over(run)})
        middle = bins.where("upto >= ceil(all / 2) AND upto - n < ceil(all / 2)").select(F.col("place").alias("at"), "measure", "bin")
        wide = middle.groupBy("at").agg(*[F.max(F.when(F.col("measure") == m, F.col("bin"))).alias(f"middle_{m}") for m in self.measures])
        total = self._merged(states)
        shown = [F.col("place").alias(self.by), "rows"]
        for m in self.measures:
            mean = F.when(F.col(f"n_{m}") > 0, F.col(f"sum_{m}").cast("double") / F.col(f"n_{m}"))
            shown += [f"n_{m}", mean.alias(f"mean_{m}"), f"min_{m}", f"max_{m}", f"middle_{m}"]
        shown += [F.hll_sketch_estimate(f"hll_{c}").alias(f"distinct_{c}") for c in self.distinct]
        return total.join(wide, F.col("place").eqNullSafe(F.col("at")), "left").select(*shown)
