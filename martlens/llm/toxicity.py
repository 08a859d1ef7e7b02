"""Toxicity by nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

Fitting, on at most ``SAMPLE`` labelled rows of either label (those with the smallest id digest;
the only bounded part, beyond it more rows do not change the size of the model):

1. the terms of the examples' texts (words, and the first 4 to 6 letters of longer words, so that inflected
   and compound forms meet) are counted by label, near copies of a text (those that agree with it in half
   of ``LANES`` least hashes of word 5-grams) together once;
2. the ``TERMS`` terms that speak most clearly for label 1 are kept: a term is kept only if it is in
   ``LEAST_TEXTS`` of these texts of label 1, however many there are (so rare kinds of label 1 keep their
   terms, and the words of one much-copied text do not), and, by the
   lower end of the 90 % interval of its smoothed odds ratio, ``ODDS`` times likelier there;
3. document frequencies of these terms are counted over all documents;
4. examples become unit TF-IDF vectors over them. Their inverted index holds, for each term, its
   weights by blocks of ``BLOCK`` examples and each block's largest weight.

Scoring: a text's vector is compared with the blocks in the order of their upper bounds
(``FIRST_BLOCKS`` at once, then twice as many each time), until no block can change its ``NEIGHBOURS`` nearest. Their labels vote with their cosines as weights (times
the number of labelled rows that an example of its label stands for),
``PRIOR`` votes of the base rate are added, and so the score is a smoothed share of label 1 among
texts alike. Texts without a kept term have no direction; all such examples are equally near, and
the score is the smoothed share of label 1 among them. A text's score depends on its text and the
fitted model alone; ids, languages, sources and its own label are not looked at.

Null text is empty. Rows repeated are scored alike. Labels that are null or neither 0 nor 1, and
labels of absent documents, are not used. Without any labelled row every score is 0.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlens.llm.common import mapped, mixed, text_slices, written

SAMPLE = 8_000
TERMS = 4_096
LEAST_TEXTS = 3
LANES = 16
NGRAM = 5
ODDS = 6.0
BLOCK = 64
FIRST_BLOCKS = 16
NEIGHBOURS = 25
PRIOR = 1.0
SLICE_BYTES = 1 << 20
CACHE_WORDS = 200_000
CACHE_SCORES = 10_000
WORD = re.compile(r"[^\W\d_]+")


def terms_of(word: str) -> list[str]:
    return [word, *(f"{word[:n]}*" for n in (4, 5, 6) if len(word) > n)]


class Terms:
    """Counts the kept terms of texts; which terms a word has is remembered per worker."""

    def __init__(self, numbers: dict[str, int]):
        self.numbers = numbers
        self.known: dict[str, tuple[int, ...]] = {}

    def count(self, text: str | None) -> Counter:
        out: Counter = Counter()
        known = self.known
        if len(known) > CACHE_WORDS:
            known.clear()
        for word, n in Counter(WORD.findall((text or "").lower())).items():
            if (own := known.get(word)) is None:
                own = known[word] = tuple(self.numbers[t] for t in terms_of(word) if t in self.numbers)
            for t in own:
                out[t] += n
        return out


@dataclass
class Model:
    numbers: dict[str, int]
    idf: np.ndarray
    labels: np.ndarray  # of examples that have a vector
    stands: tuple[float, float]  # labelled rows per example of label 0 and 1
    ids: np.ndarray  # their document ids, as evidence
    without: float  # share of label 1 among examples that have none
    base: float
    postings: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]  # term: blocks, largest, examples, weights

    def vector(self, counts: Counter) -> dict[int, float]:
        raw = {t: (1 + math.log(n)) * float(self.idf[t]) for t, n in sorted(counts.items())}
        size = math.sqrt(sum(w * w for w in raw.values()))
        return {t: w / size for t, w in raw.items()} if size else {}

    def nearest(self, query: dict[int, float]) -> tuple[np.ndarray, np.ndarray]:
        """Exact cosines and numbers of the ``NEIGHBOURS`` nearest examples, nearest first, ties to smaller numbers."""
        blocks = -(-len(self.labels) // BLOCK)
        bound = np.zeros(blocks)
        for t, w in query.items():
            if t in self.postings:
                at, largest, _, _ = self.postings[t]
                bound[at] += w * largest
        best, numbers = np.zeros(0), np.zeros(0, np.int64)
        order = np.argsort(-bound, kind="stable")[: np.count_nonzero(bound > 0)]
        done, some_blocks = 0, FIRST_BLOCKS
        while done < len(order) and (len(best) < NEIGHBOURS or bound[order[done]] >= best[-1] - 1e-12):
            taken = np.zeros(blocks, bool)
            taken[order[done : done + some_blocks]] = True
            done, some_blocks = done + some_blocks, 2 * some_blocks
            here, scores = np.repeat(taken, BLOCK), np.zeros(blocks * BLOCK)
            for t, w in query.items():
                if t in self.postings:
                    _, _, examples, weights = self.postings[t]
                    own = here[examples]
                    scores[examples[own]] += w * weights[own]
            some = np.flatnonzero(scores > 0)
            best, numbers = np.concatenate([best, scores[some]]), np.concatenate([numbers, some])
            near = np.lexsort((numbers, -best))[:NEIGHBOURS]
            best, numbers = best[near], numbers[near]
        return best, numbers

    def score(self, counts: Counter) -> tuple[float, list[int]]:
        """The score and, as evidence, the ids of the five nearest examples of the label that it speaks for."""
        query = self.vector(counts)
        if not query:
            return self.without, []
        near, numbers = self.nearest(query)
        votes = self.labels[numbers]
        weight = near * np.where(votes == 1, *self.stands[::-1])
        score = (float(weight @ votes) + PRIOR * self.base) / (float(weight.sum()) + PRIOR)
        return score, [int(i) for i in self.ids[numbers[votes == (score >= self.base)]][:5]]


def sketch(text: str) -> np.ndarray:
    """``LANES`` least hashes of the word ``NGRAM``-grams of ``text``."""
    found = text.lower().split()
    if len(text) > 30 * len(found):  # a script without spaces
        found = list(text.lower())
    grams = {" ".join(found[i : i + NGRAM]) for i in range(max(1, len(found) - NGRAM + 1))}
    base = np.array([int.from_bytes(hashlib.blake2b(g.encode(), digest_size=8).digest(), "little") for g in grams], np.uint64)
    return np.array([mixed(base ^ mixed(np.array([k + 1], np.uint64))).min() for k in range(LANES)])


def near_copies(texts: DataFrame) -> DataFrame:
    """(digest, label, group) of the examples ``texts`` that have a near copy of their label; at most 2 x ``SAMPLE``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text", SLICE_BYTES):
            marks = [sketch(body).tobytes() for body in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(marks, pa.binary())], ["digest", "label", "marks"])

    rows = sorted(mapped(texts.select("digest", "label", "text"), run, "digest string, label int, marks binary").collect())
    marks = np.frombuffer(b"".join(r["marks"] for r in rows), np.uint64).reshape(-1, LANES)
    root = list(range(len(rows)))

    def top(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for lane in range(LANES):
        first: dict[tuple[int, int], int] = {}  # each text meets the first of its lane's value, so no group is squared
        for i, r in enumerate(rows):
            j = first.setdefault((r["label"], int(marks[i, lane])), i)
            if j != i and 2 * np.count_nonzero(marks[i] == marks[j]) >= LANES:
                a, b = sorted((top(i), top(j)))
                root[b] = a
    tops = [top(i) for i in range(len(rows))]
    size = Counter(tops)
    out = [(r["digest"], r["label"], g) for r, g in zip(rows, tops) if size[g] > 1]
    return texts.sparkSession.createDataFrame(out, "digest string, label int, group long")


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", key: str = "doc_id", text: str = "text") -> Model:
    """The model of ``labels`` (key, label), for texts of ``docs``; ``labels`` holds only rows to learn from."""
    spark = docs.sparkSession
    usable = labels.filter(F.col(label).isin(0, 1) & F.col(key).isNotNull()).select(F.col(key).alias("__key"), F.col(label).cast("int").alias("__label"))
    order = F.md5(F.col("__key").cast("string").cast("binary"))
    usable_rows = dict(usable.groupBy("__label").count().collect())
    sample = usable.filter("__label = 0").orderBy(order, "__key").limit(SAMPLE).union(usable.filter("__label = 1").orderBy(order, "__key").limit(SAMPLE))
    rows = sample.collect()  # at most 2 x SAMPLE pairs of an id and a label
    examples = spark.createDataFrame([(r["__key"], r["__label"]) for r in rows], "__key long, __label int")
    texts = docs.join(F.broadcast(examples), docs[key] == examples["__key"]).select(
        F.col("__key").alias("id"), F.col("__label").alias("label"), F.coalesce(docs[text], F.lit("")).alias("text"))
    texts = written(texts.groupBy(F.sha2("text", 256).alias("digest"), "label").agg(F.min("id").alias("id"), F.first("text").alias("text")), "toxicity-examples")
    copies = near_copies(texts)
    grouped = texts.join(F.broadcast(copies), ["digest", "label"], "left")

    def by_label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = (Counter(), Counter())
        for batch in text_slices(batches, "text", SLICE_BYTES):
            for y, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts[y].update({t for w in set(WORD.findall(body.lower())) for t in terms_of(w)})
        for y in (0, 1):
            got = list(counts[y].items())
            for i in range(0, len(got), 50_000):
                part = got[i : i + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array([t for t, _ in part]), pa.array([n if y == 0 else 0 for _, n in part], pa.int64()), pa.array([n if y else 0 for _, n in part], pa.int64())], ["term", "n0", "n1"])

    def of_copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "text", SLICE_BYTES):
            for y, group, body in zip(*(c.to_pylist() for c in batch.columns)):
                got = sorted({t for w in set(WORD.findall(body.lower())) for t in terms_of(w)})
                yield pa.RecordBatch.from_arrays([pa.array(got, pa.string()), pa.array([y] * len(got), pa.int32()), pa.array([group] * len(got), pa.int64())], ["term", "label", "group"])

    totals = dict(grouped.groupBy("label").agg(F.sum(F.col("group").isNull().cast("long")) + F.count_distinct("group")).collect())
    n0, n1 = totals.get(0, 0), totals.get(1, 0)
    single = mapped(grouped.filter("group IS NULL").select("label", "text"), by_label, "term string, n0 long, n1 long")
    copied = mapped(grouped.filter("group IS NOT NULL").select("label", "group", "text"), of_copies, "term string, label int, group long").distinct()
    copied = copied.select("term", (1 - F.col("label")).cast("long").alias("n0"), F.col("label").cast("long").alias("n1"))
    counted = single.union(copied).groupBy("term").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    odds = F.log((F.col("n1") + 0.5) / (n1 + 1.0) / ((F.col("n0") + 0.5) / (n0 + 1.0)))
    sure = odds - 1.645 * F.sqrt(1 / (F.col("n1") + 0.5) + 1 / (F.col("n0") + 0.5))
    clear = counted.filter((F.col("n1") >= LEAST_TEXTS) & (sure >= math.log(ODDS))).orderBy(F.desc(odds * F.sqrt("n1")), "term").limit(TERMS)
    numbers = {r["term"]: i for i, r in enumerate(clear.collect())}  # at most TERMS

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, total, n = Terms(numbers), Counter(), 0
        for batch in text_slices(batches, "text", SLICE_BYTES):
            n += batch.num_rows
            for body in batch.column(0).to_pylist():
                total.update(terms.count(body).keys())
        yield pa.RecordBatch.from_arrays([pa.array([-1, *total], pa.int64()), pa.array([n, *total.values()], pa.int64())], ["term", "n"])

    found = dict(mapped(docs.select(F.coalesce(docs[text], F.lit("")).alias("text")), frequencies, "term long, n long").groupBy("term").agg(F.sum("n")).collect())
    n = found.get(-1, 0)
    idf = np.array([math.log((1 + n) / (1 + found.get(i, 0))) + 1 for i in range(len(numbers))])

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms = Terms(numbers)
        for batch in text_slices(batches, "text", SLICE_BYTES):
            got = [terms.count(body) for body in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([list(c.keys()) for c in got], pa.list_(pa.int64())), pa.array([list(c.values()) for c in got], pa.list_(pa.int64()))], ["id", "label", "terms", "counts"])

    rows = mapped(texts.select("id", "label", "text"), vectors, "id long, label int, terms array<long>, counts array<long>").collect()
    all0, all1 = usable_rows.get(0, 0), usable_rows.get(1, 0)
    stands = (max(1.0, all0 / SAMPLE), max(1.0, all1 / SAMPLE))
    model = Model(numbers, idf, np.zeros(0), stands, np.zeros(0, np.int64), 0.0, all1 / (all0 + all1) if all0 + all1 else 0.0, {})
    lists: dict[int, list[tuple[int, float]]] = {}
    kept, without = [], [0, 0]
    for r in sorted(rows, key=lambda r: (r["id"], r["label"])):
        if not r["terms"]:
            without[r["label"]] += 1
            continue
        for t, w in model.vector(Counter(dict(zip(r["terms"], r["counts"])))).items():
            lists.setdefault(t, []).append((len(kept), w))
        kept.append((r["id"], r["label"]))
    model.ids, model.labels = np.array([i for i, _ in kept], np.int64), np.array([y for _, y in kept], float)
    alike = [n * s for n, s in zip(without, stands)]
    model.without = (alike[1] + PRIOR * model.base) / (sum(alike) + PRIOR)
    for t, got in lists.items():
        examples, weights = np.array([i for i, _ in got]), np.array([w for _, w in got])
        starts = np.unique(examples // BLOCK, return_index=True)
        model.postings[t] = (starts[0], np.maximum.reduceat(weights, starts[1]), examples, weights)
    return model


def score(docs: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, ``score`` (0 to 1) and ``evidence`` (ids of near examples) of each text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by SAMPLE and TERMS
    own = [c for c in keep if c not in ("score", "evidence")]
    rows = docs.select(*own, *([] if text in own else [text]))
    at = rows.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared.value
        terms, known = Terms(fitted.numbers), {}
        for batch in text_slices(batches, text, SLICE_BYTES):
            got = []
            for body in batch.column(at).to_pylist():
                counts = terms.count(body)
                mark = tuple(sorted(counts.items()))
                if mark not in known:
                    if len(known) >= CACHE_SCORES:
                        known.clear()
                    known[mark] = fitted.score(counts)
                got.append(known[mark])
            columns = [pa.array([s for s, _ in got], pa.float64()), pa.array([e for _, e in got], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(own)], *columns], [*own, "score", "evidence"])

    return mapped(rows, run, T.StructType([*rows.schema.fields[: len(own)], T.StructField("score", T.DoubleType()), T.StructField("evidence", T.ArrayType(T.LongType()))]))
