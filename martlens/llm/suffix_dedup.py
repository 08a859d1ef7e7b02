"""Removal of repeated byte strings by a hash-compared suffix sort.

A byte goes when a ``LENGTH``-byte string that covers it also starts earlier: in a document with a
smaller id, or earlier in the same one. Strings are judged on the input and never cross documents.

Anchors. Of the ``GRAM``-byte strings in a window of ``LENGTH`` bytes, the one with the smallest hash (the
first of equals) is the window's anchor. Equal windows have equal anchors at equal offsets, so
only windows whose anchor string occurs twice can repeat. One anchor serves a run of
neighbouring windows, so about one position in 35 is dealt out, in packed blocks, to find which
occur twice; texts that are copies of each other count once there. A common anchor is one of
the many of each text, so it is a small part of any bucket.

Suffix sort. The windows of one anchor string (its class) are sorted as suffixes: mergesort,
vectorised over all classes of a batch, in which two suffixes are compared by their longest
common extension, found by binary search on prefix polynomial hashes, and by the byte after it.
Ties stay in document order, so every window that equals the one before it repeats. Equal
neighbours are verified byte by byte; after a hash collision the batch is grouped by its bytes instead.
A class of more than ``PART`` occurrences is cut into parts that sort alone; what they find first is
compared between parts by a combinable ``min`` per window digest.

Full copies of a text of ``LENGTH`` bytes or more lose all bytes without a sort. Null text is empty.
Rows that share an id are ordered by a digest of their texts; rows that repeat id and text are
treated alike. Ids that are null come first.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martlens.llm.common import U64, mapped, mixed, partitions, slices, text_slices, written

LENGTH = 100
GRAM = 32
WINDOW = LENGTH - GRAM + 1
PART = 4096
CHUNK_BYTES = 1 << 19
LONG_BYTES = 4 << 20
PLACE_BITS = 24
HELD = 400_000
ANCHORS_PER_BUCKET = 64_000
BROADCAST_IDS = 1_000_000
NO_ID = -(2**63)
BASE = 0x9E3779B97F4A7C15 | 1
ANCHOR = np.dtype([("gram", "<u8"), ("text", "<i8"), ("place", "<u4")])


class Powers:
    """Powers of the odd ``BASE`` and of its inverse modulo 2^64, and a random word for each byte."""

    def __init__(self):
        self.words = mixed(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15))
        self.up = self.down = np.ones(1, U64)

    def grown(self, n: int) -> None:
        if len(self.up) < n:
            n = 1 << n.bit_length()
            self.up = np.cumprod(np.concatenate([[U64(1)], np.full(n, U64(BASE))]), dtype=U64)
            self.down = np.cumprod(np.concatenate([[U64(1)], np.full(n, U64(pow(BASE, -1, 1 << 64)))]), dtype=U64)

    def prefixes(self, data: np.ndarray) -> np.ndarray:
        """Prefix hashes: entry i is the polynomial of the first i bytes."""
        self.grown(len(data) + 1)
        out = np.zeros(len(data) + 1, U64)
        np.cumsum(self.words[data] * self.up[: len(data)], dtype=U64, out=out[1:])
        return out


def anchors(data: np.ndarray, ends: np.ndarray, powers: Powers) -> tuple[np.ndarray, ...]:
    """Anchors of the windows of concatenated texts that end at ``ends``.

    Per anchor: its place, the hash of its string, and the first and last window that it serves.
    """
    n = len(data) - GRAM + 1
    none = np.zeros(0, np.int64)
    if len(data) < LENGTH:
        return none, none.astype(U64), none, none
    prefix = powers.prefixes(data)
    grams = mixed((prefix[GRAM:] - prefix[:-GRAM]) * powers.down[:n])
    low = U64((1 << PLACE_BITS) - 1)
    least = (grams & ~low) | np.arange(n, dtype=U64)
    reach = 1
    while 2 * reach <= WINDOW:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    least = np.minimum(least[: n - WINDOW + 1], least[WINDOW - reach :][: n - WINDOW + 1])
    starts = np.concatenate([[0], ends[:-1]])
    inside = np.zeros(len(least) + 1, np.int8)
    ok = ends - starts >= LENGTH
    np.add.at(inside, starts[ok], 1)
    np.add.at(inside, ends[ok] - LENGTH + 1, -1)
    first = np.flatnonzero(np.cumsum(inside[:-1]))  # window starts within a text
    place = (least[first] & low).astype(np.int64)
    at = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]])) if len(place) else none
    place, lo = place[at], first[at]
    hi = first[np.concatenate([at[1:] - 1, [len(first) - 1]])] if len(at) else none
    return place, grams[place], lo, hi


def pieces(text: bytes) -> Iterator[tuple[int, bytes]]:
    """(start, bytes) of overlapping parts of a very long text; together they hold each window once."""
    step = LONG_BYTES - LENGTH + 1
    for start in range(0, max(1, len(text) - LENGTH + 1), step):
        yield start, text[start : start + LONG_BYTES]


def text_anchors(texts: list[bytes], powers: Powers) -> Iterator[tuple[np.ndarray, ...]]:
    """For batches of texts: number of the text, place, hash, first and last window of each anchor, within its text."""
    units = [(i, start, part) for i, text in enumerate(texts) if len(text) >= LENGTH for start, part in pieces(text)]
    for i, j in slices(np.array([len(u[2]) for u in units]), LONG_BYTES):
        own = units[i:j]
        ends = np.cumsum([len(u[2]) for u in own])
        place, gram, lo, hi = anchors(np.frombuffer(b"".join(u[2] for u in own), np.uint8), ends, powers)
        unit = np.searchsorted(ends, place, "right")
        shift = np.array([u[1] for u in own]) - np.concatenate([[0], ends[:-1]])
        yield np.array([u[0] for u in own])[unit], place + shift[unit], gram, lo + shift[unit], hi + shift[unit]


def repeated_anchors(texts: DataFrame, buckets: int) -> DataFrame:
    """(mark, place, n): anchors whose string occurs n > 1 times in distinct texts (mark, text) or places."""

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, held, count = Powers(), [], 0

        def flushed() -> pa.RecordBatch:
            rows = np.concatenate(held)
            bucket = ((rows["gram"] >> U64(32)) * U64(buckets) >> U64(32)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            rows, cuts = rows[order], np.searchsorted(bucket[order], np.arange(buckets + 1))
            some = np.flatnonzero(cuts[1:] > cuts[:-1])
            return pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array([rows[cuts[i] : cuts[i + 1]].tobytes() for i in some], pa.binary())], ["bucket", "anchors"])

        for batch in text_slices(batches, "text", CHUNK_BYTES):
            marks = np.array(batch.column(0).to_pylist(), np.int64)
            for number, place, gram, _, _ in text_anchors(batch.column(1).cast(pa.binary()).to_pylist(), powers):
                rows = np.empty(len(place), ANCHOR)
                rows["gram"], rows["text"], rows["place"] = gram, marks[number], place
                held.append(rows)
                count += len(rows)
            if count >= HELD:
                yield flushed()
                held, count = [], 0
        if count:
            yield flushed()

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def result(blocks: list[bytes]) -> pa.RecordBatch:
            rows = np.frombuffer(b"".join(blocks), ANCHOR)
            rows = rows[np.lexsort((rows["place"], rows["text"], rows["gram"]))]
            new = np.concatenate([[True], (rows[1:] != rows[:-1])])
            rows = rows[new]
            run = np.cumsum(np.concatenate([[True], rows["gram"][1:] != rows["gram"][:-1]])) - 1
            n = np.bincount(run)[run]
            rows, n = rows[n > 1], n[n > 1]
            return pa.RecordBatch.from_arrays([pa.array(rows["text"].astype(np.int64)), pa.array(rows["place"].astype(np.int64)), pa.array(n.astype(np.int64))], ["mark", "place", "n"])

        at, blocks = None, []
        for batch in batches:
            for bucket, block in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if bucket != at and blocks:
                    yield result(blocks)
                    blocks = []
                at = bucket
                blocks.append(block)
        if blocks:
            yield result(blocks)

    dealt = mapped(texts, placed, "bucket int, anchors binary").repartition(max(partitions(texts.sparkSession), min(buckets, 4096)), "bucket")
    return mapped(dealt.sortWithinPartitions("bucket"), counted, "mark long, place long, n long")


class Suffixes:
    """Suffixes of a byte buffer that start at given places, compared over ``LENGTH`` bytes."""

    def __init__(self, data: np.ndarray, powers: Powers):
        self.data, self.powers = data, powers
        self.prefix = powers.prefixes(data)

    def common(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Longest common extension of the suffixes at ``x`` and ``y``, up to ``LENGTH``."""
        low, high = np.zeros(len(x), np.int64), np.full(len(x), LENGTH)
        down = self.powers.down
        px, py, dx, dy = self.prefix[x], self.prefix[y], down[x], down[y]
        for _ in range(LENGTH.bit_length()):
            middle = (low + high + 1) >> 1
            same = (self.prefix[x + middle] - px) * dx == (self.prefix[y + middle] - py) * dy
            low, high = np.where(same, middle, low), np.where(same, high, np.maximum(middle - 1, low))
        return low

    def less(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Sign of the order of the suffixes at ``x`` and ``y``: negative where x comes first, 0 where equal."""
        length = self.common(x, y)
        end = length == LENGTH
        at = np.where(end, 0, length)
        return np.where(end, 0, self.data[x + at].astype(np.int64) - self.data[y + at])

    def sorted(self, at: np.ndarray, group: np.ndarray) -> np.ndarray:
        """An order of the entries that sorts the suffixes of each group (a run of equal numbers), ties as given."""
        n = len(at)
        order = np.arange(n)
        starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        size = np.diff(np.concatenate([starts, [n]]))
        number = np.repeat(np.arange(len(starts)), size)
        first, count = starts[number], size[number]
        width, active = 1, np.flatnonzero(count > 1)
        while len(active):
            place = active - first[active]  # within the group; positions, as runs stay where they are
            run = place // width
            left = run % 2 == 0
            begin = first[active] + np.where(left, run + 1, run - 1) * width
            end = np.minimum(begin + width, first[active] + count[active])
            begin = np.minimum(begin, end)
            own = at[order[active]]
            low, high = begin.copy(), end.copy()
            while len(open_ := np.flatnonzero(low < high)):
                middle = (low[open_] + high[open_]) >> 1
                sign = self.less(at[order[middle]], own[open_])
                # before a left entry stand smaller ones of the right run; before a right entry also equal ones of the left
                before = np.where(left[open_], sign < 0, sign <= 0)
                low[open_], high[open_] = np.where(before, middle + 1, low[open_]), np.where(before, high[open_], middle)
            target = first[active] + (run - run % 2) * width + place % width + (low - begin)
            moved = order.copy()
            moved[target] = order[active]
            order = moved
            width *= 2
            active = active[count[active] > width]
        return order

    def repeats(self, at: np.ndarray, group: np.ndarray) -> np.ndarray:
        """Whether each suffix equals one that stands before it in its group."""
        order = self.sorted(at, group)
        x, y = at[order[:-1]], at[order[1:]]
        near = np.flatnonzero(group[order[:-1]] == group[order[1:]])
        near = near[self.common(x[near], y[near]) == LENGTH]
        for i in range(0, len(near), 10_000):
            some = near[i : i + 10_000]
            span = np.arange(LENGTH)
            if (self.data[x[some][:, None] + span] != self.data[y[some][:, None] + span]).any():
                return self.repeats_by_bytes(at, group)
        out = np.zeros(len(at), bool)
        out[order[near + 1]] = True
        return out

    def repeats_by_bytes(self, at: np.ndarray, group: np.ndarray) -> np.ndarray:
        seen, out = set(), np.zeros(len(at), bool)
        for i, (p, g) in enumerate(zip(at.tolist(), group.tolist())):
            key = (g, self.data[p : p + LENGTH].tobytes())
            out[i] = key in seen
            seen.add(key)
        return out


CONTEXT = "gram long, part int, parts int, doc long, mark long, lo long, off int, context binary"
FOUND = "doc long, mark long, start long, stop long, a long, b long"


def class_repeats(rows: list[tuple], powers: Powers) -> list[tuple]:
    """``FOUND`` rows of whole classes (or parts): repeated spans; for parts also their first windows with digests.

    ``rows``: (gram, part, parts, doc, mark, lo, off, context), sorted by gram, part, doc, mark and lo.
    """
    import xxhash

    out, seen, own = [], set(), []
    for row in rows:
        key = (row[0], row[1], row[6], row[7])
        if key in seen:  # the same bytes around the anchor: all of its windows repeat
            out.append((*row[3:5], row[5], row[5] + len(row[7]), None, None))
        else:
            seen.add(key)
            own.append(row)
    sizes: dict[tuple, int] = {}
    for row in own:
        sizes[row[:2]] = sizes.get(row[:2], 0) + 1
    own = [row for row in own if sizes[row[:2]] > 1 or row[2] > 1]
    if not own:
        return out
    length = np.array([len(r[7]) for r in own])
    base = np.cumsum(length) - length
    windows = length - LENGTH + 1
    entry = np.repeat(np.arange(len(own)), windows)
    j = np.arange(len(entry)) - np.repeat(np.cumsum(windows) - windows, windows)
    names = {k: i for i, k in enumerate(dict.fromkeys(r[:2] for r in own))}
    cls = np.array([names[r[:2]] for r in own])
    group = cls[entry] * (LENGTH + 1) + (np.array([r[6] for r in own])[entry] - j)
    order = np.argsort(group, kind="stable")  # documents stay in order within a group
    suffixes = Suffixes(np.frombuffer(b"".join(r[7] for r in own), np.uint8), powers)
    repeated = np.zeros(len(entry), bool)
    repeated[order] = suffixes.repeats((base[entry] + j)[order], group[order])
    hit = np.flatnonzero(repeated)
    if len(hit):
        cut = np.concatenate([[True], (entry[hit][1:] != entry[hit][:-1]) | (j[hit][1:] != j[hit][:-1] + 1)])
        heads = np.flatnonzero(cut)
        tails = np.concatenate([heads[1:] - 1, [len(hit) - 1]])
        for h, t in zip(hit[heads].tolist(), hit[tails].tolist()):
            row = own[entry[h]]
            out.append((*row[3:5], row[5] + int(j[h]), row[5] + int(j[t]) + LENGTH, None, None))
    split = np.array([r[2] > 1 for r in own])[entry] & ~repeated
    for i in np.flatnonzero(split).tolist():
        row, k = own[entry[i]], int(j[i])
        d = xxhash.xxh3_128_intdigest(row[7][k : k + LENGTH])
        out.append((*row[3:5], row[5] + k, row[5] + k + LENGTH, (d >> 64) - (1 << 63), (d & (1 << 64) - 1) - (1 << 63)))
    return out


def repeated_spans(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, mark, n_bytes, sha256, spans) of each row: ``spans`` are the maximal removed byte ranges, in order.

    ``doc`` is the id (the least number for null), ``mark`` the xxhash64 of the text.
    """
    spark = df.sparkSession
    body = df.select(F.coalesce(F.col(key).cast("long"), F.lit(NO_ID)).alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("mark", F.xxhash64("text"))
    heads = written(body.select("doc", "mark", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2("text", 256).alias("sha256")), "suffix-heads")
    firsts = heads.groupBy("sha256").agg(F.min("doc").alias("first"), F.min("mark").alias("mark"), F.max("n_bytes").alias("n_bytes"))
    total = heads.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
    buckets = max(partitions(spark), math.ceil(total / 35 / ANCHORS_PER_BUCKET))

    marks = repeated_anchors(body.select("mark", "text"), buckets)
    marks = marks.groupBy("mark").agg(F.collect_list(F.struct("place", "n")).alias("anchors"))
    todo = written(marks.join(firsts.select("mark", F.col("first").alias("doc")), "mark"), "suffix-anchors")
    ids = todo.select("doc", "mark")
    few = ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    texts = body.join(F.broadcast(ids), ["doc", "mark"], "left_semi") if few else body
    texts = texts.join(todo, ["doc", "mark"]).select("doc", "mark", "anchors", "text")

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in text_slices(batches, "text", CHUNK_BYTES):
            own = batch.column(3).cast(pa.binary()).to_pylist()
            docs, marks_ = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            wanted = batch.column(2)
            flat = wanted.flatten()
            owner = np.repeat(np.arange(len(own)), np.diff(wanted.offsets.to_numpy()))
            place_, n_ = flat.field(0).to_numpy(), flat.field(1).to_numpy()
            order = np.lexsort((place_, owner))
            owner, place_, n_ = owner[order], place_[order], n_[order]
            known = owner.astype(np.int64) << 40 | place_
            for number, place, gram, lo, hi in text_anchors(own, powers):
                code = number.astype(np.int64) << 40 | place
                at = np.searchsorted(known, code)
                at[at == len(known)] = 0
                hit = np.flatnonzero(known[at] == code)
                rows = []
                for h in hit.tolist():
                    i, first, last = int(number[h]), int(lo[h]), int(hi[h])
                    parts = -(-int(n_[at[h]]) // PART)
                    part = int(mixed(np.array([docs[i] * 1_000_003 + first], np.int64).astype(U64))[0] % U64(parts)) if parts > 1 else 0
                    rows.append((int(gram[h].astype(np.int64)), part, parts, docs[i], marks_[i], first, int(place[h]) - first, own[i][first : last + LENGTH]))
                for k in range(0, len(rows), 20_000):
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[k : k + 20_000]), context_schema.types)], schema=context_schema)

    def sorted_classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, held, size = Powers(), [], 0

        def result() -> pa.RecordBatch:
            found = class_repeats(held, powers)
            columns = zip(*found) if found else [[]] * 6
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc", "mark", "start", "stop", "a", "b"])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if size >= CHUNK_BYTES and held[-1][:2] != row[:2]:
                    yield result()
                    held, size = [], 0
                held.append(row)
                size += len(row[7])
        if held:
            yield result()

    types = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    context_schema = pa.schema([(n, types[t]) for n, t in (f.split() for f in CONTEXT.split(", "))])
    dealt = mapped(texts, contexts, CONTEXT).repartition(partitions(spark) * 2, "gram", "part")
    dealt = dealt.sortWithinPartitions("gram", "part", "doc", "mark", "lo")
    found = written(mapped(dealt, sorted_classes, FOUND), "suffix-found")

    parted = found.filter("a IS NOT NULL")
    least = parted.groupBy("a", "b").agg(F.min(F.struct("doc", "mark", "start")).alias("least"))
    across = parted.join(least, ["a", "b"]).filter(F.struct("doc", "mark", "start") > F.col("least"))
    spans = found.filter("a IS NULL").select("doc", "mark", "start", "stop").union(across.select("doc", "mark", "start", "stop"))
    spans = merged_spans(spans)
    empty = F.array().cast("array<struct<start:bigint,stop:bigint>>")
    out = heads.join(firsts.select("sha256", "first"), "sha256").join(spans, ["doc", "mark"], "left")
    copy = (F.col("doc") > F.col("first")) & (F.col("n_bytes") >= LENGTH)
    whole = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("stop")))
    return out.withColumn("spans", F.when(copy, whole).otherwise(F.coalesce("spans", empty))).select("doc", "mark", "n_bytes", "sha256", "spans")


def merged_spans(spans: DataFrame) -> DataFrame:
    """(doc, mark, spans): the spans of a text in order, those that touch or overlap made one."""
    before = Window.partitionBy("doc", "mark").orderBy("start", "stop").rowsBetween(Window.unboundedPreceding, -1)
    heads = spans.withColumn("new", (F.col("start") > F.coalesce(F.max("stop").over(before), F.lit(-1))).cast("int"))
    upto = Window.partitionBy("doc", "mark").orderBy("start", "stop").rowsBetween(Window.unboundedPreceding, 0)
    runs = heads.withColumn("run", F.sum("new").over(upto)).groupBy("doc", "mark", "run").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
    return runs.groupBy("doc", "mark").agg(F.array_sort(F.collect_list(F.struct("start", "stop"))).alias("spans"))


def without_spans(df: DataFrame, spans: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, mark, kept): the bytes of the texts of ``df`` that lie outside the spans of :func:`repeated_spans`."""
    body = df.select(F.coalesce(F.col(key).cast("long"), F.lit(NO_ID)).alias("doc"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("mark", F.xxhash64("text"))
    cut = spans.select("doc", "mark", "spans").dropDuplicates(["doc", "mark"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text", CHUNK_BYTES):
            out = []
            for body_, removed in zip(batch.column(2).cast(pa.binary()).to_pylist(), batch.column(3).to_pylist()):
                at, kept = 0, []
                for span in removed:
                    kept.append(body_[at : span["start"]])
                    at = span["stop"]
                out.append(b"".join(kept) + body_[at:])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())], ["doc", "mark", "kept"])

    return mapped(body.join(cut, ["doc", "mark"]).select("doc", "mark", "text", "spans"), run, "doc long, mark long, kept binary")
