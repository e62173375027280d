"""Near-duplicates by b-bit MinHash.

Every distinct shingle set keeps the low ``BITS`` bits of 128 minima, packed, and 32 band keys of four full minima.
Sets that share a band key are candidates. Their packed signatures are compared by counting equal lanes; the estimate is
corrected for lanes that are equal by chance, and pairs clearly below the threshold go. The rest are confirmed on the
full sets.

Pairs are not expanded within a group. A band's sets are first compared with its most central one, and the links found
are contracted to components. Only then sets of one band that are still in different components meet, in tiles of bounded
size: all sets of the group on one side, those outside of its largest component on the other, so no link between
components is lost and members of one component are never compared again. Tiles of packed signatures come first; only the
sets that have a likely partner there meet once more in full.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthside.llm.common import LAST_ID, MIX, mixed, parts, row_id, slices, stored, text_bytes, word_names, words
from hearthside.llm.components import components

HASHES, BANDS, BITS = 128, 32, 8
#: Rows of signatures, and bytes of full sets, on one side of a tile.
TILE, TILE_BYTES = 4096, 16 << 20
#: Bytes of text whose shingles are in memory at a time.
_SLICE = 2 << 20
#: Standard errors that a pair's estimate may lie under the threshold before it goes without a full comparison.
MARGIN = 5.5
#: Lanes of the signature of sets that stay in different components after the star round.
LONG = 512
_A = mixed(np.arange(1, LONG + 1, dtype=np.uint64) * MIX[0]) | np.uint64(1)
_B = mixed(np.arange(1, LONG + 1, dtype=np.uint64) * MIX[3])
SETS = "id long, n_shingles long, set_key binary, signature binary, bands binary"


def shingle_sets(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, names): the sorted distinct shingles of every row, A-Z lower-cased, whole texts.

    A row with fewer than ``size`` words has its whole sequence as one shingle, a row without words none.
    """
    buf, offsets = text_bytes(column)
    first, last, rows = words(buf, offsets)
    names = word_names(buf, first, last, lower=True)
    n = len(offsets) - 1
    count = np.bincount(rows, minlength=n)
    at = np.concatenate([[0], np.cumsum(count)])
    if len(names) >= size:
        whole = np.zeros(len(names) - size + 1, np.uint64)
        for k in range(size):
            whole = mixed(whole * MIX[1] + names[k : len(names) - size + 1 + k])
        inside = rows[: len(whole)] == rows[size - 1 :]
        keys, owner = whole[inside], rows[: len(whole)][inside]
    else:
        keys, owner = names[:0], rows[:0]
    few = np.flatnonzero((count > 0) & (count < size))
    extra = np.zeros(len(few), np.uint64)
    for j, r in enumerate(few):
        for name in names[at[r] : at[r + 1]]:
            extra[j] = mixed(extra[j : j + 1] * MIX[2] + name)[0]
    keys, owner = np.concatenate([keys, extra]), np.concatenate([owner, few])
    order = np.lexsort((keys, owner))
    keys, owner = keys[order], owner[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])
    keys, owner = keys[new], owner[new]
    return np.searchsorted(owner, np.arange(n + 1)), keys


def _minima(at: np.ndarray, keys: np.ndarray, lanes: int) -> np.ndarray:
    """The smallest value of each of ``lanes`` hash functions over every row's set (0 for an empty set)."""
    full = np.flatnonzero(np.diff(at))
    starts = at[full]
    minima = np.zeros((len(at) - 1, lanes), np.uint64)
    step = 1 << 15
    low = np.empty(len(keys), np.uint64)
    for h in range(lanes if len(full) else 0):
        for p in range(0, len(keys), step):  # in pieces that stay in the processor's cache
            part = keys[p : p + step] * _A[h]
            part += _B[h]
            part ^= part >> np.uint64(32)
            low[p : p + step] = part
        minima[full, h] = np.minimum.reduceat(low, starts)
    return mixed(minima)


def _low_bits(minima: np.ndarray) -> pa.Array:
    return pa.array([c.tobytes() for c in (minima & np.uint64((1 << BITS) - 1)).astype(np.uint8)], pa.binary())


def _signed(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, size=_SLICE):
        at, keys = shingle_sets(batch.column(1), size)
        full = np.flatnonzero(np.diff(at))
        minima = _minima(at, keys, HASHES)
        bands = np.zeros((len(at) - 1, BANDS), np.uint64)
        rows_of = HASHES // BANDS
        for k in range(rows_of):
            bands = mixed(bands * MIX[1] + minima[:, k::rows_of][:, :BANDS] + np.arange(BANDS, dtype=np.uint64))
        sums = np.zeros((len(at) - 1, 2), np.uint64)
        if len(full):
            sums[full, 0] = np.add.reduceat(mixed(keys ^ MIX[0]), at[full])
            sums[full, 1] = np.add.reduceat(mixed(keys ^ MIX[3]), at[full])
        blank = lambda cells: pa.array([c.tobytes() for c in cells], pa.binary())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(np.diff(at)), blank(sums), _low_bits(minima), blank(bands)],
            names=[x.split()[0] for x in SETS.split(", ")],
        )


def estimate(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Jaccard similarity from packed low bits (uint8 lanes), corrected for chance equality of lanes."""
    equal = np.count_nonzero(x == y, axis=-1) / x.shape[-1]
    chance = 1.0 / (1 << BITS)
    return (equal - chance) / (1 - chance)


def _least(threshold: float, lanes: int = HASHES) -> float:
    return threshold - MARGIN * np.sqrt(threshold * (1 - threshold) / lanes)


def _estimated(pairs: DataFrame, signatures: DataFrame, threshold: float) -> DataFrame:
    """Of (a, b), the pairs whose signatures may belong to similar sets."""
    lanes = signatures.select("id", "signature")
    both = pairs.join(lanes.toDF("a", "sa"), "a").join(lanes.toDF("b", "sb"), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (text_bytes(batch.column(i))[0].reshape(-1, HASHES) for i in (2, 3))
            yield batch.select(["a", "b"]).filter(pa.array(estimate(x, y) >= _least(threshold)))

    return both.select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of (a, b), the pairs with 100 * intersection >= percent * union, on full sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = (np.frombuffer(v.as_py(), np.uint64) for v in (x, y))
                common = len(x) + len(y) - len(np.union1d(x, y))
                good.append(100 * common >= percent * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    both = pairs.join(sets.toDF("a", "sa"), "a").join(sets.toDF("b", "sb"), "b")
    return both.select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long")


def _full_sets(docs: DataFrame, ids: DataFrame, size: int) -> DataFrame:
    """(id, set, n, long): shingle set, its size and its long signature, of one row of each id in ``ids``.

    The written ids filter the scan before the texts are shuffled.
    """
    wanted = stored(ids, "wanted-ids").where(F.col("id") >= F.lit(-(2**63)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, size=_SLICE):
            at, keys = shingle_sets(batch.column(1), size)
            cells = [keys[a:b].tobytes() for a, b in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(cells, pa.binary()), pa.array(np.diff(at)), _low_bits(_minima(at, keys, LONG))],
                names=["id", "set", "n", "long"],
            )

    found = docs.join(wanted, "id", "left_semi").select("id", "text").dropDuplicates(["id"])
    return found.mapInArrow(run, "id long, set binary, n long, long binary")


def _tiled(rows: DataFrame, weight: Column, limit: int) -> DataFrame:
    """``rows`` (centre, id, component, n) of the groups with several components, in tiles: deal, tile, left and the columns.

    The sets outside of the largest component of a group (left) meet all its sets. Either side is cut so that a part weighs
    about ``limit``, and a left part meets every right part in a tile of its own.
    """
    shares = rows.groupBy("centre", "component").agg(F.sum(weight).alias("w"))
    groups = shares.groupBy("centre").agg(
        F.max(F.struct("w", "component")).alias("most"), F.sum("w").alias("all"), F.count("*").alias("parts")
    ).where("parts > 1")
    cut = lambda w: F.ceil(w / limit).cast("int")
    sides = groups.select("centre", F.col("most.component").alias("major"), cut(F.col("all")).alias("rights"), cut(F.col("all") - F.col("most.w")).alias("lefts"))
    both = rows.join(sides, "centre")
    part = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    place = lambda left, i, j: F.struct(F.lit(left).alias("left"), i.alias("i"), j.alias("j"))
    right = F.transform(F.sequence(F.lit(0), F.col("lefts") - 1), lambda i: place(False, i, part("rights")))
    left = F.transform(F.sequence(F.lit(0), F.col("rights") - 1), lambda j: place(True, part("lefts"), j))
    at = F.explode(F.when(F.col("component") == F.col("major"), right).otherwise(F.concat(right, left)))
    placed = both.select("centre", "id", "component", "n", at.alias("at")).select("centre", "at.*", "id", "component", "n")
    return placed.withColumn("deal", F.pmod(F.xxhash64("centre", "i", "j"), F.lit(8 * parts(rows.sparkSession))))


def _tiles_of(group: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of the left and of the right rows of every tile of the group."""
    key = [np.asarray(group[c]) for c in ("j", "i", "centre")]
    left = np.asarray(group["left"])
    order = np.lexsort(key)
    starts = np.flatnonzero(np.any([k[order][1:] != k[order][:-1] for k in key], axis=0)) + 1
    for tile in np.split(order, starts):
        if len(tile):
            yield tile[left[tile]], tile[~left[tile]]


def _fitting(x: int, right: np.ndarray, comp: np.ndarray, n: np.ndarray, percent: int) -> np.ndarray:
    """The rows of other components whose sizes allow a link with row x."""
    return right[(100 * np.minimum(n[right], n[x]) >= percent * np.maximum(n[right], n[x])) & (comp[right] != comp[x])]


def _likely(group: pa.Table, percent: int) -> pa.Table:
    """(centre, id, component, n) of the sets with a partner in another component whose packed signature allows a link."""
    ids, comp, n = (np.asarray(group[c]) for c in ("id", "component", "n"))
    lanes = text_bytes(group["signature"])[0].reshape(-1, HASHES)
    least, some = _least(percent / 100), np.zeros(len(ids), bool)
    for left, right in _tiles_of(group):
        for x in left:
            y = _fitting(x, right, comp, n, percent)
            y = y[estimate(lanes[x][None, :], lanes[y]) >= least]
            some[y] = True
            some[x] |= len(y) > 0
    return group.select(["centre", "id", "component", "n"]).filter(pa.array(some))


def _tile_links(group: pa.Table, percent: int) -> pa.Table:
    """Links that join components, in each tile of the group.

    A pair is looked at by size, by its long signature, and then by its full sets. Components that a link has joined are
    not compared again, so a tile gives fewer links than it has sets.
    """
    ids, comp, n = (np.asarray(group[c]) for c in ("id", "component", "n"))
    comp = comp.copy()
    lanes = text_bytes(group["long"])[0].reshape(-1, LONG)
    data, at = text_bytes(group["set"])
    links = []
    for left, right in _tiles_of(group):
        tile = np.concatenate([left, right])
        for x in left:
            y = _fitting(x, right, comp, n, percent)
            y = y[estimate(lanes[x][None, :], lanes[y]) >= _least(percent / 100, LONG)]
            own = data[at[x] : at[x + 1]].view(np.uint64)
            for z in y:
                if comp[z] == comp[x]:
                    continue
                other = data[at[z] : at[z + 1]].view(np.uint64)
                place = np.minimum(np.searchsorted(own, other), len(own) - 1)
                common = int(np.count_nonzero(own[place] == other))
                if 100 * common >= percent * (len(own) + len(other) - common):
                    links.append((min(ids[x], ids[z]), max(ids[x], ids[z])))
                    comp[tile[comp[tile] == comp[z]]] = comp[x]
    pairs = np.array(links, np.int64).reshape(-1, 2)
    return pa.table([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])


def near_groups(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    ``docs``: doc_id, text. Rows are linked when 100 * intersection >= percent * union of their sets of distinct
    ``size``-word shingles; a component is what links connect, and its smallest doc_id stays. A null or empty text has
    an empty set and is linked with nothing. Rows that repeat a doc_id are rows of their own with equal answers only if
    their texts have equal sets; doc_id should be unique. Rows without an id are linked with nothing: their component_id
    is null and they are kept. An empty table gives no rows; other columns are not read.
    """
    rows = docs.select(row_id().alias("id"), F.col("text").cast("string").alias("text"))
    threshold = percent / 100
    signed = stored(rows.mapInArrow(lambda b: _signed(b, size), SETS), "signatures")
    classes = signed.where((F.col("n_shingles") > 0) & (F.col("id") != F.lit(LAST_ID))).groupBy("set_key").agg(F.min(F.struct("id", "signature", "bands", "n_shingles")).alias("m"))
    heads = stored(classes.select("set_key", "m.id", "m.signature", "m.bands", F.col("m.n_shingles").alias("n")), "set-classes")

    def banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = text_bytes(batch.column(1))[0].view(np.int64)
            ids = np.repeat(np.asarray(batch.column(0)), BANDS)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(ids)], names=["band", "id"])

    band = heads.select("id", "bands").mapInArrow(banded, "band long, id long")
    sizes = band.groupBy("band").count().where("count > 1")
    members = stored(band.join(sizes, "band"), "bands")
    # the most central set of a band is the one that meets the most others over all bands
    rank = members.groupBy("id").agg(F.sum("count").alias("degree"))
    ranked = members.select("band", "id").join(rank, "id")
    centre = ranked.groupBy("band").agg(F.max_by("id", F.struct("degree", -F.col("id"))).alias("centre"))
    star = (
        members.join(centre, "band").where("id != centre")
        .select(F.least("id", "centre").alias("a"), F.greatest("id", "centre").alias("b")).distinct()
    )
    pairs = stored(_estimated(star, heads, threshold), "star-pairs")
    involved = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    sets = stored(_full_sets(rows, involved, size), "sets")
    links = stored(_confirmed(pairs, sets.select("id", "set"), percent), "star-links")
    found = stored(components(links), "star-components")

    # sets of bands with one centre that are in different components meet in tiles
    grouped = members.join(centre, "band").select("centre", "id").distinct()
    placed = grouped.join(found.toDF("id", "component"), "id", "left").withColumn("component", F.coalesce("component", "id"))
    placed = stored(placed.join(heads.select("id", "n"), "id").select("centre", "id", "component", "n"), "placed-sets")
    narrow = _tiled(placed, F.lit(1), TILE).join(heads.select("id", "signature"), "id")
    likely = narrow.groupBy("deal").applyInArrow(lambda g: _likely(g, percent), "centre long, id long, component long, n long")
    open_rows = stored(likely.distinct(), "open-sets")
    known = sets.unionByName(stored(_full_sets(rows, open_rows.select("id").distinct().join(sets, "id", "left_anti"), size), "sets"))
    tiles = _tiled(open_rows, 8 * F.col("n") + LONG + 100, TILE_BYTES).join(known.select("id", "set", "long"), "id")
    links2 = stored(tiles.groupBy("deal").applyInArrow(lambda g: _tile_links(g, percent), "a long, b long"), "rest-links")
    merged = stored(components(found.select(F.col("node").alias("a"), F.col("component").alias("b")).union(links2)), "components")

    by_set = heads.select("set_key", F.col("id").alias("node")).join(merged, "node", "left").select(
        "set_key", F.coalesce("component", "node").alias("component")
    )
    real = lambda c: F.when(F.col(c) != F.lit(LAST_ID), F.col(c))
    # the empty set has no class: its rows are their own components
    answers = signed.select("id", "n_shingles", F.when((F.col("n_shingles") > 0) & (F.col("id") != F.lit(LAST_ID)), F.col("set_key")).alias("set_key")).join(by_set, "set_key", "left")
    return answers.withColumn("component", F.coalesce("component", "id")).select(
        real("id").alias("doc_id"), "n_shingles", real("component").alias("component_id"), (F.col("id") == F.col("component")).alias("kept")
    )
