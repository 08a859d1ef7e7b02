"""Temperature mixing of sources, in DataFrame functions only.

Source weights are token shares raised to an exponent a and normalised: a = 1 keeps the corpus as
it is, a = 0 makes all sources equal. The exponent is bisected until the weights meet a target
entropy, or until no source is repeated more often than a limit. The weights are then realised
under a token budget: each source is passed over as often as its share of the budget allows, each
pass in a permutation of its own, and the last pass ends where the budget does.

A permutation is the order of a digest of seed, pass and key; the first ``BLOCK_DIGITS`` hex
digits are the block. The cut of the last pass is found from token sums per block (at most 4,096
rows a source) and then inside the one block that holds it, so no task ever orders a source,
however many rows it has. What reaches the rows is one line per source. Those lines are written, their
bytes are summed, and up to ``BROADCAST_BYTES`` they are broadcast, so rows stay where they were read;
beyond that (very many sources) rows and lines meet by source and one of ``SALTS`` salts of the key, so no
source is ever one task's.

Tokens are whole numbers; by default a text counts a quarter of its bytes, rounded up, and 1 at
least. Null sources form one source "". Rows with equal keys have equal places in a permutation and
are taken or left together. An empty table gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martlens.llm.common import written

BLOCK_DIGITS = 3
PLACE_DIGITS = 16
STEPS = 60
#: Bytes of the lines per source that a join may broadcast.
BROADCAST_BYTES = 8 << 20
SALTS = 32


def default_tokens(text: str = "text") -> Column:
    return F.greatest(F.lit(1), F.ceil(F.coalesce(F.octet_length(text), F.lit(0)) / 4)).cast("long")


def place(seed: int, turn: Column, key: Column) -> Column:
    """Where a row stands in the permutation of a pass, as fixed-width hex digits."""
    return F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), turn.cast("string"), key.cast("string")).cast("binary")), 1, PLACE_DIGITS)


def source_weights(totals: DataFrame, max_repeats: float | None = None, target_entropy: float | None = None, budget: int | None = None) -> DataFrame:
    """``totals`` (source, tokens) with ``exponent``, ``weight`` and ``source_budget``, one row per source.

    ``max_repeats``: the least exponent at which no source is passed over more often. ``target_entropy``
    (nats): the greatest exponent whose weights reach it. With neither, the shares are kept.
    ``budget``: tokens of the mix; None: as many as take every source once at least.
    The bisection runs inside one row that lists the shares, ``STEPS`` halvings of [0, 1].
    """
    if max_repeats is not None and target_entropy is not None:
        raise ValueError("give a repetition limit or a target entropy, not both")
    all_tokens = F.aggregate("tokens", F.lit(0.0), lambda s, t: s + t)
    one = totals.agg(F.array_sort(F.collect_list(F.struct(F.col("tokens").cast("double").alias("t"), F.col("source").alias("s")))).alias("listed"))
    one = one.filter(F.size("listed") > 0).withColumn("tokens", F.transform("listed", lambda x: x.t))
    one = one.withColumn("total", all_tokens).withColumn("shares", F.transform("tokens", lambda t: t / F.col("total")))

    def weights(a: Column) -> Column:
        z = F.aggregate("shares", F.lit(0.0), lambda s, p: s + F.pow(p, a))
        return F.transform("shares", lambda p: F.pow(p, a) / z)

    def meets(a: Column) -> Column:
        """Whether the exponent is high enough (repeats) or low enough (entropy)."""
        if target_entropy is not None:
            return F.aggregate(weights(a), F.lit(0.0), lambda s, w: s - w * F.log(w)) >= target_entropy
        passes = F.zip_with(weights(a), F.col("tokens"), lambda w, t: w / t)
        scale = F.lit(float(budget)) if budget is not None else 1 / F.array_min(passes)
        return F.array_max(passes) * scale <= max_repeats * (1 + 1e-12)

    if max_repeats is None and target_entropy is None:
        one = one.withColumn("exponent", F.lit(1.0))
    else:
        state = F.struct(F.lit(0.0).alias("lo"), F.lit(1.0).alias("hi"))

        def halve(s: Column, _: Column) -> Column:
            mid = (s.lo + s.hi) / 2
            up = ~meets(mid) if target_entropy is None else meets(mid)  # towards 1
            return F.when(up, F.struct(mid.alias("lo"), s.hi.alias("hi"))).otherwise(F.struct(s.lo.alias("lo"), mid.alias("hi")))

        found = F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), state, halve)
        zero = F.lit(0.0)
        best = F.when(meets(zero), zero).otherwise(found.hi) if target_entropy is None else F.when(meets(F.lit(1.0)), F.lit(1.0)).otherwise(found.lo)
        one = one.withColumn("exponent", best)
    one = one.withColumn("weights", weights(F.col("exponent")))
    whole = F.lit(float(budget)) if budget is not None else 1 / F.array_min(F.zip_with("weights", "tokens", lambda w, t: w / t))
    one = one.withColumn("whole", whole)
    rows = one.select("exponent", "whole", F.inline(F.zip_with("listed", "weights", lambda x, w: F.struct(x.s.alias("source"), x.t.cast("long").alias("tokens"), w.alias("weight")))))
    return rows.select("source", "tokens", "exponent", "weight", F.round(F.col("whole") * F.col("weight")).cast("long").alias("source_budget"))


def _with_plan(rows: DataFrame, plan: DataFrame, source: str, key: str) -> DataFrame:
    """``rows`` joined with ``plan`` (a written table, one line a source named like ``source``)."""
    size = plan.agg(F.sum(F.octet_length(source) + 64 + 8 * len(plan.columns))).first()[0] or 0
    if size <= BROADCAST_BYTES:
        return rows.join(F.broadcast(plan), source)
    salted = plan.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("__salt", F.pmod(F.xxhash64(key), F.lit(SALTS)).cast("int")).join(salted, [source, "__salt"]).drop("__salt")


def mix(df: DataFrame, key: str, source: str = "source", tokens: Column | None = None, seed: int = 0, **targets) -> DataFrame:
    """The rows of ``df``, each once per pass it is part of, with weight, tokens, pass, block and place.

    Sorted by ``turn`` and ``place`` a source's rows stand in the order of its block permutations.
    ``targets`` go to :func:`source_weights`. Columns of ``df`` named like the new ones are replaced.
    """
    rows = df.withColumn("__source", F.coalesce(F.col(source), F.lit(""))).withColumn("__tokens", default_tokens() if tokens is None else tokens)
    rows = rows.withColumn("__key", F.coalesce(F.col(key).cast("string"), F.lit(""))).drop("weight", "exponent", "turn", "block", "place", "n_tokens")
    narrow = rows.select(F.col("__source").alias("source"), F.col("__tokens").alias("tokens"), F.col("__key").alias("key"))
    plan = source_weights(narrow.groupBy("source").agg(F.sum("tokens").alias("tokens")), **targets)
    plan = plan.withColumn("turns", F.floor(F.col("source_budget") / F.col("tokens")).cast("long"))
    plan = written(plan.withColumn("rest", F.col("source_budget") - F.col("turns") * F.col("tokens")), "mix-sources")

    last = _with_plan(narrow, plan.select("source", "turns", "rest"), "source", "key").withColumn("place", place(seed, F.col("turns"), F.col("key")))
    last = last.withColumn("block", F.substring("place", 1, BLOCK_DIGITS))
    blocks = last.groupBy("source", "block").agg(F.sum("tokens").alias("tokens"), F.first("rest").alias("rest"))
    blocks = blocks.withColumn("upto", F.sum("tokens").over(Window.partitionBy("source").orderBy("block")))
    cut_blocks = blocks.filter("upto > rest AND upto - tokens <= rest").select("source", F.col("block").alias("cut_block"), (F.col("upto") - F.col("tokens")).alias("before"))
    inside = last.join(cut_blocks.withColumnRenamed("cut_block", "block"), ["source", "block"]).select("source", "place", "tokens", "rest", "before")
    inside = inside.withColumn("upto", F.col("before") + F.sum("tokens").over(Window.partitionBy("source").orderBy("place")))
    cuts = inside.filter("upto <= rest").groupBy("source").agg(F.max("place").alias("cut_place"))
    plan = plan.join(cut_blocks.select("source", "cut_block"), "source", "left").join(cuts, "source", "left")
    # without a row inside the cut block that fits, the cut is where the block begins
    plan = plan.select(F.col("source").alias("__source"), "weight", "exponent", "turns", F.coalesce("cut_place", "cut_block").alias("__cut"))

    out = _with_plan(rows, written(plan, "mix-plan"), "__source", "__key")
    taken = F.when(place(seed, F.col("turns"), F.col("__key")) <= F.col("__cut"), F.col("turns")).otherwise(F.col("turns") - 1)
    out = out.withColumn("turn", F.explode(F.when(taken >= 0, F.sequence(F.lit(0).cast("long"), taken)).otherwise(F.array().cast("array<bigint>"))))
    out = out.withColumn("place", place(seed, F.col("turn"), F.col("__key"))).withColumn("block", F.substring("place", 1, BLOCK_DIGITS))
    return out.withColumn("n_tokens", F.col("__tokens")).drop("__source", "__tokens", "__key", "__cut", "turns")


