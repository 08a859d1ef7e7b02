"""Near-duplicate line removal by a segment-partition edit join, in DataFrame functions only.

A line goes when an earlier line (smaller document id, or earlier in the same document) is within
``max_edits`` character edits of it; equal lines are within none. Lines shorter than ``min_chars``
(blank lines, bullets, brackets) are layout and take no part.

Distinct texts are joined as follows. The shorter of two texts is cut into ``max_edits`` + 1
segments of fixed places; if the texts are within ``max_edits``, one segment stands unchanged in
the longer one, shifted by no more edits than stand on either side. So each text gives an index row
per segment (its length, the segment's number and hash) and probes, for each length difference, the
few substrings that the multi-match rule leaves. Pairs that share a row are verified with a
bit-parallel automaton over the 2 x ``max_edits`` + 1 diagonals of the band: a bit per diagonal, one word per
number of edits, one step per character. Its steps are interpreted lambda calls, so Spark's compiled
``levenshtein`` with the same threshold (banded too) runs before it. That is the same exact predicate, so
``levenshtein`` verifies, and the automaton only checks the pairs that it accepts.

Pairs that share a row grow with the square of a group of near copies. So with one edit (the production
parameter) a key with more than ``CROWD`` index rows lists no pairs: its texts agree but for the other half,
the open part. That is cut into ``PIECES``; the edit stands in one of them, so each text gives a key per
piece, the hash of all that stands outside it. Keys that are still crowded are cut again, the others list
their pairs. With one open character left, texts of a key that are equally long are within one edit: each is
near the earliest of them, which is a ``min``. A text that is longer by one is joined with the text it becomes
without one of its two open characters. So rows grow with the characters of the crowded texts, not with pairs.
With two edits or more every key lists its pairs.

Shuffles carry hashes. Copies of a line are merged by a combinable ``min`` before anything is
joined, and index and probe rows are distinct, so a line probes once however often it occurs.
The texts of candidates are read again by the ids of their documents: behind a check of their
number these are broadcast, beyond it joined. What links gives is the earliest line near each
text, so no chain of links is followed and no group is gathered.

Null text is empty; rows that share an id are ordered by their text; rows that repeat an id and
text are treated alike. Other columns are passed on; any named ``n_lines`` or ``n_removed`` are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlens.llm.common import dropped, written

BROADCAST_IDS = 1_000_000
NO_ID = -(2**63)
#: Index rows of a key that list their pairs; with more the key is cut further.
CROWD = 64
#: Parts that the open part of a crowded key is cut into.
PIECES = 16


def lines(rows: DataFrame, min_chars: int) -> DataFrame:
    """(at: document, text hash and place of the line, line, h: its 128-bit hash) of lines that take part."""
    out = rows.select("__doc", "__row", F.posexplode(F.split("__text", "\n", -1)).alias("pos", "line")).filter(F.length("line") >= min_chars)
    return out.select(F.struct("__doc", "__row", "pos").alias("at"), "line", hashed("line").alias("h"))


def hashed(*columns: Column | str) -> Column:
    """128-bit hash, by which texts are told apart."""
    return F.struct(F.xxhash64(*columns).alias("a"), F.xxhash64(F.lit(1), *columns).alias("b"))


def segments(length: Column, count: int) -> list[tuple[Column, Column]]:
    """(first place from 1, size) of each of ``count`` segments of a text of ``length``: the last are longer by one."""
    size, longer = F.floor(length / count).cast("int"), length % count
    out, start = [], F.lit(1)
    for i in range(count):
        own = size + F.when(F.lit(i) >= F.lit(count) - longer, 1).otherwise(0)
        out.append((start, own))
        start = start + own
    return out


def segment_key(length: Column, i: int, start: Column, size: Column) -> Column:
    return F.xxhash64(length, F.lit(i), F.substring(F.col("line"), start, size))


def join_keys(max_edits: int) -> tuple[Column, Column]:
    """Index rows of a line of ``len`` characters, which also probe texts as long as it, and its other probes: of texts as long (even) or shorter."""
    n = F.col("len")
    index = [segment_key(n, i, p, size) for i, (p, size) in enumerate(segments(n, max_edits + 1))]
    probes = []
    for less in range(max_edits + 1):
        for i, (p, size) in enumerate(segments(n - less, max_edits + 1)):
            left, right = i, max_edits - i  # edits that can stand before and after the segment
            for shift in range(max(-left, less - right), min(left, less + right) + 1):
                if less or shift:
                    probes.append(F.struct(segment_key(n - less, i, p + shift, size).alias("key"), F.lit(not less).alias("even")))
    return F.array(*index), F.array(*probes)


def hinted(rows: DataFrame) -> DataFrame:
    """``rows``, to be broadcast if they are few."""
    return F.broadcast(rows) if rows.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS else rows


def crowds_of(index: DataFrame) -> DataFrame:
    """Keys with more than ``CROWD`` rows."""
    return written(index.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > CROWD).select("key"), "line-crowds")


def crowd_rows(keyed: DataFrame, crowds: DataFrame) -> DataFrame:
    """(h, line, less, n, a, b) of lines that have a key of ``crowds`` for one edit: as an index row (less 0) or as
    one longer (less 1) than texts of n characters, whose characters from a (from 0) to before b are open."""
    parts = []
    for less in (0, 1):
        n = F.col("len") - less
        for i, (p, size) in enumerate(segments(n, 2)):
            a, b = (F.lit(0), n - size) if i else (size, n)
            parts.append(F.struct(segment_key(n, i, p + i * less, size).alias("key"), F.lit(less).alias("less"), n.alias("n"), a.alias("a"), b.alias("b")))
    rows = keyed.select("h", "line", F.explode(F.array(*parts)).alias("part")).select("h", "line", "part.*")
    return rows.join(hinted(crowds), "key", "left_semi").select("h", "line", "less", "n", "a", "b").dropDuplicates(["h", "less", "n", "a", "b"])


def cut(items: DataFrame, texts: DataFrame) -> DataFrame:
    """``items`` (h, less, n, a, b) for each piece of their open part, with the hash of what stands outside it as ``key``."""
    size = F.col("b") - F.col("a")
    count = F.greatest(F.least(F.lit(PIECES), size), F.lit(1))
    place = lambda j: (F.col("a") + F.floor(j * size / count)).cast("int")
    pieces = F.transform(F.sequence(F.lit(0), count - 1), lambda j: F.struct(place(j).alias("a"), place(j + 1).alias("b")))
    out = items.join(texts, "h").select("h", "less", "n", "line", F.explode(pieces).alias("piece")).select("h", "less", "n", "line", "piece.*")
    outside = F.substring("line", F.lit(1), F.col("a")), F.substring(F.col("line"), F.col("b") + F.col("less") + 1, F.length("line"))
    return out.select("h", "less", "n", "a", "b", hashed("n", "a", "b", *outside).alias("key"))


def among_crowds(keyed: DataFrame, classes: DataFrame, crowds: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Of texts that share a key of ``crowds``: pairs (h1, h2) to be verified, pairs within one edit, and (h, near) for others within one edit."""
    members = written(crowd_rows(keyed, crowds), "line-crowd-rows")
    texts = written(members.select("h", "line").dropDuplicates(["h"]), "line-crowd-texts")
    items, pairs, ends = members.drop("line"), [], []
    while True:
        rows = written(cut(items, texts), "line-pieces")
        index = rows.filter("less = 0")
        crowds = hinted(crowds_of(index))
        few = index.join(crowds, "key", "left_anti").select(F.col("h").alias("h1"), "key")
        pairs.append(few.join(rows.select(F.col("h").alias("h2"), "key", "less"), "key").filter("h1 < h2 OR less = 1").select("h1", "h2"))
        crowded = rows.join(crowds, "key", "left_semi")
        ends.append(crowded.filter("b - a <= 1"))
        items = written(crowded.filter("b - a > 1").select("h", "less", "n", "a", "b"), "line-crowd-items")
        if items.isEmpty():
            break
    for more in range(1, len(ends)):
        pairs[0], ends[0] = pairs[0].union(pairs[more]), ends[0].union(ends[more])
    ends = written(ends[0], "line-ends")
    even = ends.filter("less = 0").join(classes.select("h", "first"), "h").select("h", "key", "first")
    near = even.select("h", "key").join(even.groupBy("key").agg(F.min("first").alias("near")), "key").select("h", "near")
    without = lambda at: F.concat(F.substring("line", F.lit(1), at), F.substring(F.col("line"), at + 2, F.length("line")))
    shorter = F.transform(F.sequence(F.col("a"), F.col("b")), lambda at: hashed(without(at)))
    longer = ends.filter("less = 1").join(texts, "h").select(F.col("h").alias("h2"), F.explode(shorter).alias("h1")).distinct()
    return pairs[0], longer.join(classes.select(F.col("h").alias("h1")), "h1", "left_semi").select("h1", "h2"), near


def within(a: Column, b: Column, max_edits: int) -> Column:
    """Whether the edit distance of character arrays ``a`` and ``b`` (as long, or longer by ``max_edits`` at most) is small enough.

    Bit d of word e: the prefixes of ``a`` and of ``b`` that end on diagonal d - ``max_edits`` are within e edits.
    """
    width = 2 * max_edits + 1
    mask = (1 << width) - 1
    start = F.array(*(F.lit(sum(1 << (max_edits + d) for d in range(e + 1))).cast("long") for e in range(max_edits + 1)))

    def step(words: Column, i: Column) -> Column:
        equal = F.lit(0).cast("long")
        for d in range(-max_edits, max_edits + 1):
            equal = equal.bitwiseOR(F.when(F.get(a, i) == F.get(b, i + d), F.lit(1 << (max_edits + d)).cast("long")).otherwise(F.lit(0).cast("long")))
        out = [F.get(words, F.lit(0)).bitwiseAND(equal)]
        for e in range(1, max_edits + 1):
            before, now = F.get(words, F.lit(e - 1)), F.get(words, F.lit(e))
            kept = now.bitwiseAND(equal).bitwiseOR(before).bitwiseOR(F.shiftright(before, 1))  # equal, replaced, left out of a
            out.append(kept.bitwiseOR(F.shiftleft(out[-1], 1)).bitwiseAND(mask))  # or put into b
        return F.array(*out)

    last = F.aggregate(F.sequence(F.lit(0), F.size(a) - 1), start, step)
    ends = F.array(*(F.lit(1 << (max_edits + d)).cast("long") for d in range(max_edits + 1)))
    return F.get(last, F.lit(max_edits)).bitwiseAND(F.get(ends, F.size(b) - F.size(a))) != 0


def earliest(rows: DataFrame, max_edits: int, min_chars: int) -> DataFrame:
    """(h, first): for texts that occur twice or are near another, the earliest line within ``max_edits``."""
    every = lines(rows, min_chars)
    classes = written(every.groupBy("h").agg(F.min("at").alias("first"), F.count("*").alias("n")), "line-classes")
    if not max_edits:
        return classes.filter("n > 1").select("h", "first")
    index, probes = join_keys(max_edits)
    keyed = every.select("h", "line", F.length("line").alias("len"))  # counted once, not in each key
    shorter = indexed = written(keyed.select(F.col("h").alias("h1"), F.explode(index).alias("key")).distinct(), "line-index")
    longer = keyed.select(F.col("h").alias("h2"), F.explode(probes).alias("probe"))
    longer = longer.select("h2", "probe.key", "probe.even").distinct()  # copies of a line probe once
    longer = longer.union(shorter.select("h1", "key", F.lit(True)))
    crowds = crowds_of(shorter) if max_edits == 1 else None
    crowded = crowds is not None and not crowds.isEmpty()
    if crowded:
        more, sure, same = among_crowds(keyed, classes, crowds)
        shorter = shorter.join(hinted(crowds), "key", "left_anti")
    # texts as long as each other would meet both ways round
    pairs = shorter.join(longer, "key").filter("h1 < h2 OR NOT even").select("h1", "h2")
    pairs = written((pairs.union(more) if crowded else pairs).distinct(), "line-pairs")

    wanted = pairs.select(F.col("h1").alias("h")).union(pairs.select("h2")).distinct()
    firsts = classes.join(wanted, "h").select("first.__doc", "first.__row", "first").distinct()
    ids = written(firsts.select("__doc", "__row").distinct(), "line-docs")
    sources = rows.join(hinted(ids), ["__doc", "__row"], "left_semi").distinct()
    texts = lines(sources, min_chars).join(firsts.select(F.col("first").alias("at")), "at", "left_semi").dropDuplicates(["h"])
    texts = written(texts, "line-texts")
    close = (pairs.join(texts.select(F.col("h").alias("h1"), F.col("line").alias("line1")), "h1")
             .join(texts.select(F.col("h").alias("h2"), F.col("line").alias("line2")), "h2")
             .filter(F.levenshtein("line1", "line2", max_edits) >= 0))
    # as arrays of characters, made once and not in each step of the automaton
    close = written(close.select("h1", "h2", F.split("line1", "").alias("a"), F.split("line2", "").alias("b")), "line-close")
    verified = close.filter(within(F.col("a"), F.col("b"), max_edits)).select("h1", "h2")
    verified = written(verified.union(sure), "line-verified") if crowded else verified
    links = written(verified.select(F.col("h1").alias("h"), F.col("h2").alias("other")).union(verified.select("h2", "h1")).distinct(), "line-links")
    near = links.join(classes.select(F.col("h").alias("other"), F.col("first").alias("near")), "other").select("h", "near")
    near = (near.union(same) if crowded else near).groupBy("h").agg(F.min("near").alias("near"))
    out = classes.join(near, "h", "left").filter("n > 1 OR near IS NOT NULL")
    return out.select("h", F.least("first", F.coalesce("near", "first")).alias("first"))


def dedup_lines(df: DataFrame, key: str = "doc_id", text: str = "text", max_edits: int = 1, min_chars: int = 20) -> DataFrame:
    """``df`` with ``text`` without its near-duplicate lines, ``n_lines`` and ``n_removed``."""
    body = F.coalesce(F.col(text), F.lit(""))
    rows = df.select(F.coalesce(F.col(key), F.lit(NO_ID)).alias("__doc"), F.xxhash64(body).alias("__row"), body.alias("__text"))
    first = earliest(rows, max_edits, min_chars)
    gone = lines(rows, min_chars).select("at", "h").join(first, "h").filter("at > first").select("at.*")
    gone = gone.groupBy("__doc", "__row").agg(F.collect_set("pos").alias("__gone"))
    out = df.withColumn("__doc", F.coalesce(F.col(key), F.lit(NO_ID))).withColumn("__row", F.xxhash64(body))
    out = out.join(gone, ["__doc", "__row"], "left").withColumn("__lines", F.split(body, "\n", -1))
    # positions that stay by a hash set, so the work grows with the lines and not with lines times removed lines
    stay = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), "__gone")
    kept = F.transform(stay, lambda i: F.get("__lines", i))
    out = out.withColumn("n_lines", F.size("__lines").cast("long")).withColumn("n_removed", F.coalesce(F.size("__gone"), F.lit(0)).cast("long"))
    out = out.withColumn(text, F.when(F.col("__gone").isNull(), F.col(text)).otherwise(F.array_join(kept, "\n")))
    return out.withColumn("n_removed", F.greatest("n_removed", F.lit(0).cast("long"))).drop("__doc", "__row", "__lines", "__gone")
