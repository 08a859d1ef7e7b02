"""Merkle dataset manifest: a hash tree per group of rows, a tree over the groups, and a proof per row.

A leaf is the digest of a row's fields. In each tree every two consecutive nodes become the digest
of both (a lone last one the digest of itself) until one is left; the trees' roots are the leaves
of one more tree. Digests are sha256; their lowercase hex text is what is hashed again, their 32
bytes are what is stored.

Proofs come from pointer jumping. Every node first holds the step to its parent: the sibling's side
and digest. Nodes whose level divides by 2 d then join the nodes d levels above them and append
their segment, so the distance that a segment spans doubles in each self-join until every leaf
reaches its root; the number of joins is the logarithm of the depth. A join key is one ancestor:
it has 2^d rows at distance d, and where that is many there are few ancestors, which are broadcast
after their bytes are counted. Nothing else is broadcast by hint.

Places in a tree come from one range exchange by (tree, order, leaf): rows of a partition are
numbered where they stand and the partitions' row counts give the offsets, so a tree that holds
most rows is spread over all partitions. Subtrees of ``2^LIFT`` consecutive nodes are hashed in one
group, which is the bound of every group.

Null trees form a tree of their own, which stands first; null orders stand first in a tree; rows
of equal order stand by leaf, so repeated rows are neighbours. A null field is ``-``, another its
UTF-8 byte count, ``:`` and itself; empty and very long texts need nothing special. A tree of one
row has that leaf as root and an empty proof. An empty table gives no rows. Only the named columns
are read, so further ones can't clash.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlens.llm.common import partitions, written

#: Levels hashed in one group.
LIFT = 8
#: Bytes of a step: side, then digest.
STEP = 33
RIGHT, LEFT, NONE = b"\x00", b"\x01", b"\x02"
#: Bytes of ancestors that a join may broadcast, counted before.
BROADCAST_BYTES = 16 << 20


def digest(text: Column) -> Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)


def leaf_digest(fields: Sequence[Column]) -> Column:
    """Hex digest of a row: each field as ``-`` or byte count, ``:`` and text."""
    texts = [f.cast("string") for f in fields]
    return digest(F.concat(*[F.when(t.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts]))


def hex_of(packed: Column) -> Column:
    return F.lower(F.hex(packed))


def count_to(n: Column) -> Column:
    """0 .. n - 1 as an array; empty for 0."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def _depth(n: Column) -> Column:
    """Levels above ``n`` leaves."""
    return F.when(n > 1, F.length(F.bin(n - 1))).otherwise(0)


def _placed(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``rows`` (tree, order, leaf, ...) with part and at; and (part, tree, shift, n): place = at + shift."""
    order = ["tree", F.col("order").asc_nulls_first(), "leaf"]
    placed = rows.repartitionByRange(partitions(rows.sparkSession), *order).sortWithinPartitions(*order)
    placed = written(placed.withColumn("id", F.monotonically_increasing_id()), "merkle-placed")
    low = (1 << 33) - 1
    placed = placed.withColumn("part", F.shiftright("id", 33)).withColumn("at", F.col("id").bitwiseAND(F.lit(low))).drop("id")
    spans = placed.groupBy("part", "tree").agg(F.count("*").alias("rows"), F.min("at").alias("first"))
    # one row per partition: their number bounds this window
    parts = spans.groupBy("part").agg(F.sum("rows").alias("rows"))
    parts = parts.selectExpr("part", "sum(rows) OVER (ORDER BY part) - rows AS offset")
    spans = spans.join(parts, "part")
    trees = spans.groupBy("tree").agg(F.min(F.col("offset") + F.col("first")).alias("start"), F.sum("rows").alias("n"))
    spans = spans.join(trees, "tree").select("part", "tree", (F.col("offset") - F.col("start")).alias("shift"), "n")
    return placed, written(spans, "merkle-spans")


def _lifted(nodes: DataFrame) -> DataFrame:
    """(tree, group, n, levels): the nodes of each run of ``2^LIFT`` (tree, idx, n, digest) and of the levels above it."""

    def above(level: Column) -> Column:
        pair = lambda i: F.concat(F.get(level, 2 * i), F.coalesce(F.get(level, 2 * i + 1), F.lit("")))
        return F.transform(count_to(((F.size(level) + 1) / 2).cast("int")), lambda i: digest(pair(i)))

    runs = nodes.groupBy("tree", F.shiftright("idx", LIFT).alias("group")).agg(
        F.first("n").alias("n"), F.array_sort(F.collect_list(F.struct("idx", "digest"))).alias("run"))
    runs = runs.withColumn("levels", F.array(F.transform("run", lambda x: hex_of(x.digest))))
    steps = F.least(F.lit(LIFT), _depth(F.col("n")))
    levels = F.aggregate(count_to(steps), F.col("levels"), lambda all_, _: F.concat(all_, F.array(above(F.element_at(all_, -1)))))
    return runs.select("tree", "group", "n", F.transform(levels, lambda a: F.transform(a, F.unhex)).alias("levels"))


def _steps(lifted: DataFrame, level: int) -> DataFrame:
    """(tree, level, idx, segment): the step of each node to its parent; a tree's root has none."""
    rows = lifted.select("tree", "group", F.posexplode(F.slice("levels", 1, F.size("levels") - 1)).alias("up", "row"))

    def step(i: Column) -> Column:
        right = F.get(F.col("row"), i + 1)
        lone = F.lit(NONE + bytes(STEP - 1))
        even = F.when(right.isNull(), lone).otherwise(F.concat(F.lit(RIGHT), right))
        return F.when(i % 2 == 0, even).otherwise(F.concat(F.lit(LEFT), F.get(F.col("row"), i - 1)))

    first = F.expr(f"shiftleft(group, {LIFT} - up)")
    nodes = F.transform(count_to(F.size("row")), lambda i: F.struct((first + i).alias("idx"), step(i).alias("segment")))
    return rows.select("tree", (F.lit(level) + F.col("up")).alias("level"), F.inline(nodes))


def _built(leaves: DataFrame, depth: int) -> tuple[DataFrame | None, DataFrame]:
    """The steps of all nodes of all trees, and (tree, digest) of their roots; ``depth`` levels below the highest."""
    steps, roots = None, leaves.filter("n = 1").select("tree", "digest")
    level, nodes = 0, leaves
    while level < depth:
        lifted = written(_lifted(nodes.filter("n > 1")), "merkle-levels")
        more = _steps(lifted, level)
        steps = more if steps is None else steps.union(more)
        level += LIFT
        nodes = lifted.select("tree", F.col("group").alias("idx"), F.shiftright(F.col("n") + ((1 << LIFT) - 1), LIFT).alias("n"),
                              F.get(F.element_at("levels", -1), F.lit(0)).alias("digest"))
        roots = roots.union(nodes.filter("n = 1").select("tree", "digest"))
    return steps, roots


def _with_ancestors(rows: DataFrame, above: DataFrame, n_above: int, distance: int, more: Sequence[str] = ()) -> tuple[DataFrame, bool]:
    """``rows`` with the segments of their ancestors ``distance`` levels up appended, and whether none was shuffled.

    ``above``: (tree, idx, segment, ``more``), ``n_above`` rows, segments of ``distance`` steps at most (of one at 0).
    """
    above = above.select(F.col("tree").alias("tree_"), F.col("idx").alias("idx_"), F.col("segment").alias("segment_"), *[F.col(c).alias(c + "_") for c in more])
    small = n_above * (STEP * max(1, distance) + 64) <= BROADCAST_BYTES
    on = (F.col("tree") == F.col("tree_")) & (F.shiftright("idx", distance) == F.col("idx_"))
    for c in more:
        on = on & (F.col(c) + distance == F.col(c + "_"))
    out = rows.join(F.broadcast(above) if small else above, on, "left")
    out = out.withColumn("segment", F.concat("segment", F.coalesce("segment_", F.lit(b""))))
    return out.drop("tree_", "idx_", "segment_", *[c + "_" for c in more]), small


def _with_segments(leaves: DataFrame, steps: DataFrame | None, widths: Sequence[int]) -> DataFrame:
    """``leaves`` (tree, idx, ...) with ``segment``: the steps from each to its tree's root."""
    low = leaves.withColumn("segment", F.lit(b""))
    if steps is None:
        return low
    steps = written(steps, "merkle-steps")
    low, small = _with_ancestors(low, steps.filter("level = 0"), widths[0], 0)
    low = low if small else written(low, "merkle-leaves")
    high, distance, depth = steps.filter("level > 0"), 1, len(widths)
    while distance < depth:
        low, small = _with_ancestors(low, high.filter(F.col("level") == distance), widths[distance], distance)
        low = low if small else written(low, "merkle-leaves")
        if 2 * distance < depth:
            below, above = high.filter(F.col("level") % (2 * distance) == 0), high.filter(F.col("level") % (2 * distance) == distance)
            high = written(_with_ancestors(below, above, sum(widths[distance :: 2 * distance]), distance, ["level"])[0], "merkle-nodes")
        distance *= 2
    return low


def _widths(trees: DataFrame) -> list[int]:
    """Nodes below a root, per level, of all trees (tree, n) together."""
    below = [f"sum(CASE WHEN n > 1 AND length(bin(n - 1)) > {i} THEN shiftright(n - 1, {i}) + 1 END)" for i in range(48)]
    return [w for w in trees.agg(F.expr(f"array({', '.join(below)})")).first()[0] if w]


def _trees(rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``rows`` (tree, order, leaf, ...) with part and ``segment`` to their root; (tree, digest) of the roots; (part, tree, ...)."""
    placed, spans = _placed(rows)
    widths = _widths(spans.groupBy("tree").agg(F.first("n").alias("n")))
    # (part, tree) is bounded by a partition, however many rows a tree has
    leaves = placed.join(spans, ["part", "tree"]).withColumn("idx", F.col("at") + F.col("shift")).drop("at", "shift")
    steps, roots = _built(leaves.select("tree", "idx", "n", F.col("leaf").alias("digest")), len(widths))
    return _with_segments(leaves.drop("n"), steps, widths), written(roots, "merkle-roots"), spans


def proofs(df: DataFrame, leaf: Column, tree: str, order: str, keep: Mapping[str, Column]) -> DataFrame:
    """``keep`` columns, ``leaf``, ``subroot`` and ``root`` (hex) and ``proof`` (packed steps) of each row.

    ``leaf`` is a hex digest, see :func:`leaf_digest`; ``tree`` (text) names the group of a row and
    ``order`` its place there. ``keep``: further columns of the result, by name.
    """
    kept = F.struct(*[c.alias(name) for name, c in keep.items()]).alias("kept")
    # "" for null and "=..." for text keep the bytewise order, null first
    tree_key = F.coalesce(F.concat(F.lit("="), F.col(tree).cast("string")), F.lit(""))
    rows = df.select(tree_key.alias("tree"), F.col(order).alias("order"), F.unhex(leaf).alias("leaf"), kept)
    # the range exchange reads its input twice: written first, texts are hashed once
    leaves, roots, spans = _trees(written(rows, "merkle-rows"))
    tops, root, _ = _trees(roots.select(F.lit("").alias("tree"), F.col("tree").alias("order"), F.col("digest").alias("leaf")))
    tops = tops.select(F.col("order").alias("tree"), F.col("leaf").alias("subroot"), F.col("segment").alias("top"))
    tops = tops.join(root.select(F.col("digest").alias("root")).hint("broadcast"), F.lit(True))  # one row
    tops = written(spans.select("part", "tree").join(tops, "tree"), "merkle-tops")
    out = leaves.join(tops, ["part", "tree"])
    return out.select("kept.*", hex_of(F.col("leaf")).alias("leaf"), hex_of(F.col("subroot")).alias("subroot"), hex_of(F.col("root")).alias("root"),
                      F.concat("segment", "top").alias("proof"))


def _each_step(proof: Column) -> Column:
    at = count_to((F.octet_length(proof) / STEP).cast("int"))
    return F.transform(at, lambda i: F.struct(F.substring(proof, i * STEP + 1, F.lit(1)).alias("side"), hex_of(F.substring(proof, i * STEP + 2, F.lit(STEP - 1))).alias("digest")))


def siblings(proof: Column) -> Column:
    """The siblings' hex digests, level by level, as one text."""
    there = F.filter(_each_step(proof), lambda s: s.side != F.lit(NONE))
    return F.array_join(F.transform(there, lambda s: s.digest), "")


def folded(leaf: Column, proof: Column) -> Column:
    """The root that ``leaf`` (hex) and the siblings of ``proof`` give."""

    def up(node: Column, s: Column) -> Column:
        pair = F.when(s.side == F.lit(RIGHT), F.concat(node, s.digest)).when(s.side == F.lit(LEFT), F.concat(s.digest, node)).otherwise(node)
        return digest(pair)

    return F.aggregate(_each_step(proof), leaf, up)
