"""Merkle manifest of a dataset by slot pivots.

Rows are leaves, ordered by id within a partition of the dataset (a language, say); every ``fanout`` consecutive nodes have
a parent. A node knows its parent and its slot from its number alone. A conditional aggregate per slot spreads the nodes of
a block, ``fanout`` to the power of ``SPAN`` of them, into columns; concatenating the columns of a parent and hashing gives
its digest, leaving out the own slot's column gives the siblings. So one shuffle of digests, ``SPAN`` levels at a time,
serves all partitions alike, and a partition with a third of all rows is a third of the blocks. Paths go down the same
blocks again: a block's path is joined once and spread to its slots.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthside.llm.common import LAST_ID, stored
from hearthside.operators.sequence import contiguous_id

SPAN = 4
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<left:string,right:string>>"


def digest(*parts: Column) -> Column:
    """Lowercase hexadecimal SHA-256 of the concatenated parts."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def leaf(fields: list[Column]) -> Column:
    """Digest of a row: each field as its number of bytes, a colon and its text, or ``-`` if null."""

    def field(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return digest(*[field(f) for f in fields])


def depth(n: Column, fanout: int) -> Column:
    """Levels of parents above ``n`` leaves."""
    powers = []
    while not powers or powers[-1] * fanout < 2**63:
        powers.append(powers[-1] * fanout if powers else 1)
    return F.size(F.filter(F.array(*[F.lit(p).cast("long") for p in powers]), lambda p: p < n))


def _slot(level: int, i: int) -> str:
    return f"s{level}_{i}"


def _text(level: int, nodes: range) -> str:
    """The digests of neighbours at a level, end to end, as SQL."""
    return f"concat('', {', '.join(f"coalesce({_slot(level, i)}, '')" for i in nodes)})" if len(nodes) else "''"


def climb(nodes: DataFrame, rounds: int, fanout: int, carry: tuple[str, ...] = ()) -> tuple[list[DataFrame], DataFrame]:
    """Blocks of every round, written, and the top node of each tree (tree, depth, idx, hash).

    ``nodes``: tree, depth (of the tree), idx (0, 1, 2 … in it), hash, and the columns ``carry``, which stay with the
    slots of the first round.
    """
    width, blocks = fanout**SPAN, []
    for turn in range(rounds):
        row = ", ".join(("hash", *(carry if turn == 0 else ())))
        spread = nodes.groupBy("tree", "depth", F.expr(f"idx div {width}").alias("idx")).agg(
            *[F.expr(f"max(if(idx % {width} = {s}, struct({row}), null))").alias(f"slot{s}") for s in range(width)]
        )
        block = spread.select("*", *[F.expr(f"slot{s}.hash AS {_slot(0, s)}") for s in range(width)])
        for level in range(SPAN):
            above = []
            for i in range(width // fanout ** (level + 1)):
                first = _slot(level, i * fanout)
                whole = f"sha2({_text(level, range(i * fanout, (i + 1) * fanout))}, 256)"
                above.append(F.expr(f"CASE WHEN depth <= {turn * SPAN + level} THEN {first} WHEN {first} IS NOT NULL THEN {whole} END AS {_slot(level + 1, i)}"))
            block = block.select("*", *above)
        block = stored(block, "merkle-blocks")
        blocks.append(block)
        nodes = block.select("tree", "depth", "idx", F.col(_slot(SPAN, 0)).alias("hash"))
    return blocks, nodes


def _siblings(s: int, level: int, base: int, fanout: int) -> str:
    """The other children of the parent above the node over slot ``s`` at ``level``, null above the tree's top, as SQL."""
    i = s // fanout**level
    first = i // fanout * fanout
    left, right = _text(level, range(first, i)), _text(level, range(i + 1, first + fanout))
    return f"if(depth > {base + level}, named_struct('left', {left}, 'right', {right}), null)"


def descend(blocks: list[DataFrame], tops: DataFrame, fanout: int, carry: tuple[str, ...] = ()) -> DataFrame:
    """tree, idx, hash, path and ``carry`` of every node that ``climb`` began with, and the other columns of ``tops``.

    ``tops``: tree, path (of the tree's top node) and columns that every node of the tree gets. A path has an entry per
    level, from the node upward: what stands left and right of it below its parent.
    """
    width = fanout**SPAN
    given = [c for c in tops.columns if c not in ("tree", "path")]
    paths = tops.withColumn("idx", F.lit(0).cast("long"))
    for turn in reversed(range(len(blocks))):
        kept = ("hash", *carry) if turn == 0 else ()
        slots = []
        for s in range(width):
            own = ", ".join(_siblings(s, level, turn * SPAN, fanout) for level in range(SPAN))
            cells = "".join(f", '{c}', slot{s}.{c}" for c in kept)
            slot = f"named_struct('idx', idx * {width} + {s}, 'path', concat(CAST(array_compact(array({own})) AS {PATH}), path){cells})"
            slots.append(f"if({_slot(0, s)} IS NULL, null, {slot})")
        rows = blocks[turn].join(paths, ["tree", "idx"]).select("tree", *given, F.expr(f"explode(array_compact(array({', '.join(slots)})))").alias("node"))
        paths = rows.select("tree", *given, "node.idx", "node.path", *[f"node.{c}" for c in kept])
        if turn:
            paths = stored(paths, "merkle-paths")
    return paths


def folded(value: Column, path: Column) -> Column:
    """The root that a leaf digest and its path lead to."""
    return F.aggregate(path, value, lambda a, s: digest(s["left"], a, s["right"]))


def path_digest(path: Column) -> Column:
    """Digest of all siblings of the path, level by level, left to right."""
    return digest(F.concat_ws("", F.transform(path, lambda s: F.concat(s["left"], s["right"]))))


def _rounds(levels: int | None) -> int:
    return max(1, -(-(levels or 0) // SPAN))


def manifest(
    docs: DataFrame, fields: tuple[str, ...] = FIELDS, partition: str = "lang", fanout: int = 2, carry: dict[str, Column] | None = None
) -> DataFrame:
    """One row per row of ``docs``: doc_id, leaf, subroot, root, path, and the columns ``carry`` computed from the row.

    ``docs``: doc_id, ``partition`` and ``fields``. Leaves ascend by doc_id within a partition; every ``fanout``
    consecutive nodes have a parent, whose digest is that of their digests' text, until one node, the subroot, is left.
    The subroots, ordered by partition (null first, then bytewise), lead to the root in the same way. path: per level
    what stands left and right of the node. Null is a partition like any other, and null and empty texts are different
    fields. Rows without an id come after all others of their partition, rows that repeat an id by their leaf, rows
    equal in all fields in the order read. An empty table gives no rows; other columns are not read.
    """
    carry = carry or {}
    names = tuple(carry)
    rows = docs.select(
        F.col(partition).cast("string").alias("part"), F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("id"),
        leaf([F.col(f) for f in fields]).alias("hash"), F.struct(*[c.alias(n) for n, c in carry.items()], F.lit(0).alias("_")).alias("carried"),
        F.monotonically_increasing_id().alias("read"),
    )
    rows = contiguous_id(stored(rows, "leaves"), [F.col("part").asc_nulls_first(), "id", "hash", "read"], "row")
    sizes = stored(rows.groupBy("part").agg(F.min("row").alias("first"), F.count("*").alias("n")), "partitions")
    trees = stored(
        contiguous_id(sizes, [F.col("part").asc_nulls_first()], "tree").withColumn("depth", depth(F.col("n"), fanout)), "trees"
    )
    nodes = rows.join(trees.withColumnRenamed("part", "own"), F.col("part").eqNullSafe(F.col("own"))).select(
        "tree", "depth", (F.col("row") - F.col("first")).alias("idx"), "hash", "id", "carried"
    )
    n_trees, deepest = trees.agg(F.count("*"), F.max("depth")).first()
    blocks, tops = climb(nodes, _rounds(deepest), fanout, ("id", "carried"))
    # the subroots are the leaves of one more tree
    upper = tops.select(
        F.lit(0).cast("long").alias("tree"), depth(F.lit(n_trees), fanout).alias("depth"), (F.col("tree") - 1).alias("idx"), "hash"
    )
    levels = next(d for d in range(64) if fanout**d >= n_trees)
    upper_blocks, top = climb(upper, _rounds(levels), fanout)
    root = top.select("hash").first()
    start = top.select("tree", F.array().cast(PATH).alias("path"))
    partitions = descend(upper_blocks, start, fanout).select(
        (F.col("idx") + 1).alias("tree"), "path", F.col("hash").alias("subroot"), F.lit(root["hash"] if root else None).cast("string").alias("root")
    )
    found = descend(blocks, partitions, fanout, ("id", "carried"))
    return found.select(
        F.when(F.col("id") != F.lit(LAST_ID), F.col("id")).alias("doc_id"), F.col("hash").alias("leaf"), "subroot", "root", "path",
        *[F.col(f"carried.{n}").alias(n) for n in names],
    )
