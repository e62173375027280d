"""Ledger of seen keys in hash buckets, with a Bloom filter per run and bucket.

A batch adds one run: its new keys, a folder per bucket, and one row per bucket with a Bloom filter of the bucket's keys. A
batch that asks which of its keys are new reads the filters of its own buckets; only key files of runs and buckets whose
filter says "maybe" are read and compared. ``FAN`` runs of a level are merged into one of the next, so a ledger of n
batches has a number of runs that grows with the logarithm of n. Version N of the manifest names the runs after batch N: a
batch that is repeated starts from the version before it and replaces its own run.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthside.sources.files import Manifests

BUCKETS, FAN = 32, 8
BITS_PER_KEY, HASHES = 10, 6
FILTER = "bucket int, keys bigint, bits binary"


def _places(h: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    """Bit numbers of each key hash in a filter of ``bits`` (a power of two), by double hashing."""
    low, high = h & np.uint64(0xFFFFFFFF), (h >> np.uint64(32)) | np.uint64(1)
    for i in range(HASHES):
        yield (low + np.uint64(i) * high) & np.uint64(bits - 1)


def bloom(h: np.ndarray) -> bytes:
    """A filter of about ``BITS_PER_KEY`` bits per key."""
    bits = 1 << max(10, int(np.ceil(np.log2(max(1, len(h)) * BITS_PER_KEY))))
    found = np.zeros(bits, bool)
    for place in _places(h, bits):
        found[place] = True
    return np.packbits(found, bitorder="little").tobytes()


def maybe(h: np.ndarray, filter_bits: bytes) -> np.ndarray:
    """Which key hashes the filter may hold; none that it holds is left out."""
    data = np.frombuffer(filter_bits, np.uint8)
    out = np.ones(len(h), bool)
    for place in _places(h, len(data) * 8):
        out &= (data[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1
    return out


def merged(filters: list[bytes]) -> bytes:
    """The filter of the union of the keys, as large as the smallest one: a larger one is folded onto it."""
    size = min(map(len, filters))
    return np.bitwise_or.reduce([np.bitwise_or.reduce(np.frombuffer(f, np.uint8).reshape(-1, size), axis=0) for f in filters]).tobytes()


class KeyLedger:
    """``path/runs/<run>/keys/bucket=B`` (column ``key``), ``path/runs/<run>/filters`` and ``path/versions/N.json``."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS, fan: int = FAN):
        self.spark, self.path, self.buckets, self.fan = spark, path, buckets, fan
        self.manifests = Manifests(spark, f"{path}/versions")

    def runs(self, before: int | None = None) -> list[dict]:
        """``name, level`` of the runs after the last batch below ``before``."""
        return self.manifests.read(self.manifests.latest(before))

    def _hashed(self, df: DataFrame, key: str) -> DataFrame:
        text = F.col(f"`{key}`").cast("string")
        return df.withColumns({"_key": text, "_h": F.xxhash64(text), "_bucket": F.pmod(F.xxhash64(text), F.lit(self.buckets)).cast("int")})

    def _read(self, pairs: list[tuple[str, int]]) -> DataFrame | None:
        """Keys of the given (run, bucket) folders; no other file is opened."""
        paths = [f"{self.path}/runs/{run}/keys/bucket={bucket}" for run, bucket in pairs]
        return self.spark.read.schema("key string").parquet(*paths) if paths else None

    def suspects(self, df: DataFrame, key: str, before: int | None = None) -> list[tuple[str, int]]:
        """The (run, bucket) pairs whose filter may hold a key of ``df``: at most runs times buckets."""
        runs = [r["name"] for r in self.runs(before)]
        if not runs:
            return []
        hashed = self._hashed(df, key).select(F.col("_bucket").alias("bucket"), F.col("_h").alias("h"))
        filters = None
        for run in runs:
            one = self.spark.read.schema(FILTER).parquet(f"{self.path}/runs/{run}/filters").select("bucket", "bits", F.lit(run).alias("run"))
            filters = one if filters is None else filters.unionByName(one)

        def probe(keys: pa.Table, own: pa.Table) -> pa.Table:
            h = np.asarray(keys["h"]).view(np.uint64)
            hits = [(b, r) for b, bits, r in zip(*(own[c].to_pylist() for c in ("bucket", "bits", "run"))) if len(h) and maybe(h, bits).any()]
            return pa.table([pa.array([b for b, _ in hits], pa.int32()), pa.array([r for _, r in hits], pa.string())], names=["bucket", "run"])

        found = hashed.groupBy("bucket").cogroup(filters.groupBy("bucket")).applyInArrow(probe, "bucket int, run string")
        return sorted((r["run"], r["bucket"]) for r in found.collect())

    def unseen(self, df: DataFrame, key: str, before: int | None = None) -> DataFrame:
        """Rows of ``df`` whose key no batch below ``before`` has added; null keys are never seen."""
        known = self._read(self.suspects(df, key, before))
        if known is None:
            return df
        known = known.select(F.col("key").alias("_known"))
        return self._hashed(df, key).join(known, F.col("_key") == F.col("_known"), "left_anti").drop("_key", "_h", "_bucket")

    def _write_run(self, keys: DataFrame, name: str) -> None:
        """``keys``: column key, distinct."""
        hashed = self._hashed(keys, "key").select("key", F.col("_bucket").alias("bucket"))
        hashed.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/runs/{name}/keys")
        # the filters are made from the written keys, so they fit them whatever is run again
        stored = self.spark.read.schema("key string, bucket int").parquet(f"{self.path}/runs/{name}/keys")

        def build(group: pa.Table) -> pa.Table:
            h = np.asarray(group["h"]).view(np.uint64)
            return pa.table([pa.array([group["bucket"][0].as_py()], pa.int32()), pa.array([len(h)]), pa.array([bloom(h)], pa.binary())], names=["bucket", "keys", "bits"])

        rows = stored.select("bucket", F.xxhash64("key").alias("h")).groupBy("bucket").applyInArrow(build, FILTER)
        rows.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/runs/{name}/filters")  # one row per bucket

    def add(self, keys: DataFrame, key: str, batch: int) -> None:
        """Add the distinct non-null keys of a batch, which must be unseen, and write the batch's version."""
        runs = self.runs(batch)
        self._write_run(keys.select(F.col(f"`{key}`").cast("string").alias("key")).where("key IS NOT NULL").distinct(), f"batch-{batch}")
        runs.append({"name": f"batch-{batch}", "level": 0})
        level = 0
        while len(mine := [r for r in runs if r["level"] == level]) >= self.fan:
            name = f"merged-{level + 1}-{batch}"
            self._write_run(self._keys_of(mine), name)
            runs = [r for r in runs if r["level"] != level] + [{"name": name, "level": level + 1}]
            level += 1
        self.manifests.write(batch, runs)

    def _keys_of(self, runs: list[dict]) -> DataFrame:
        paths = [f"{self.path}/runs/{r['name']}/keys" for r in runs]
        reader = self.spark.read.schema("key string").option("recursiveFileLookup", "true")
        return reader.parquet(*paths) if paths else self.spark.createDataFrame([], "key string")

    def keys(self) -> DataFrame:
        """All keys seen so far."""
        return self._keys_of(self.runs())
