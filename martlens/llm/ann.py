"""Approximate nearest neighbours by cross-polytope hashing.

Vectors are padded to a power of two and turned by pseudo-random rotations: three rounds of sign
flips and a fast Hadamard transform. A table's bucket is the nearest signed axis of the turned
unit vector. Every vector is put in its bucket of each table; a query probes, in each table, the
buckets of its ``probes`` nearest signed axes. All candidates of a bucket are scored exactly, in
double precision on the vectors as given. Queries that find fewer than ``k`` ask again with ``WIDER``
times as many axes, and so on up to all axes of one table, which hold every vector; so a query gets
``k`` rows, or all there are.

Spark deals vectors and queries by (table, bucket, part). A bucket of more than ``PART_ROWS`` rows
is cut into parts and its queries go to each, so no task holds a hot bucket; the bucket counts that
decide it are a table of tables x axes numbers. Of equal vectors only the ``k + 1`` with the
smallest ids can be among anybody's ``k`` nearest, so the others are not put in tables at all.

Vectors that are null, empty or zero, hold null or non-finite components, or have another length
than most take no part; they get no result and are nobody's neighbour. Rows with a null id take
no part. Repeated ids: a query's own id is never a candidate, equal pairs are given once. An empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martlens.llm.common import mapped, partitions, written

PART_ROWS = 8192
QUERY_ROWS = 256
WIDER = 4
NEAR = "query_id long, vec_id long, score double"


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row, not normalised; the width is a power of two."""
    x, h = x.copy(), 1
    while h < x.shape[1]:
        y = x.reshape(len(x), -1, 2, h)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], 2).reshape(len(x), -1)
        h *= 2
    return x


def turned(x: np.ndarray, table: int, seed: int) -> np.ndarray:
    """Rows of ``x`` after the pseudo-random rotation of ``table`` (scaled, which no bucket depends on)."""
    width = 1 << max(0, x.shape[1] - 1).bit_length()
    y = np.zeros((len(x), width))
    y[:, : x.shape[1]] = x
    signs = np.random.default_rng([seed, table]).choice([-1.0, 1.0], (3, width))
    for s in signs:
        y = hadamard(y * s)
    return y


def axes(x: np.ndarray, table: int, seed: int, probes: int) -> np.ndarray:
    """The ``probes`` nearest signed axes of each row, nearest first; axis i is i, -i is width + i."""
    y = turned(x, table, seed)
    y = np.concatenate([y, -y], 1)
    return np.argsort(-y, 1, kind="stable")[:, :probes]


def matrix(column: pa.Array, dim: int, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, dim)


def clean(df: DataFrame, key: str, vector: str) -> tuple[DataFrame, int, str]:
    """(key, vec: packed components) of the rows that take part, their length, and the numpy type."""
    kind = "<f4" if dict(df.dtypes)[vector] == "array<float>" else "<f8"
    sizes = df.filter(F.size(vector) > 0).groupBy(F.size(vector).alias("n")).count().orderBy(F.desc("count"), "n").first()
    dim = sizes["n"] if sizes else 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, out = [], []
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1)):
                x = np.array([np.nan if c is None else c for c in v.as_py()], kind) if v.values.null_count else v.values.to_numpy(zero_copy_only=False).astype(kind)
                if np.isfinite(x).all() and x.any():
                    ids.append(i)
                    out.append((x + 0).tobytes())  # + 0: no negative zeros, so equal vectors are equal bytes
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(out, pa.binary())], ["vec_id", "vec"])

    rows = df.filter((F.size(vector) == dim) & F.col(key).isNotNull()).select(F.col(key).cast("long").alias("vec_id"), vector)
    return mapped(rows, run, "vec_id long, vec binary"), dim, kind


def nearest(df: DataFrame, is_query: Column, k: int = 20, tables: int = 16, probes: int = 8, key: str = "vec_id", vector: str = "embedding", seed: int = 0) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` found with the largest inner product, ties to smaller ids.

    ``is_query`` is a condition on ``vec_id``.
    """
    vectors, dim, kind = clean(df, key, vector)
    vectors = written(vectors, "vectors")
    same = Window.partitionBy("vec").orderBy("vec_id")
    base = vectors.distinct().withColumn("copy", F.row_number().over(same)).filter(f"copy <= {k + 1}").select("vec_id", "vec")

    def hashed(n: int, tables: int = tables):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                x = matrix(batch.column(1), dim, kind).astype(np.float64)
                for table in range(tables):
                    near = axes(x, table, seed, n)
                    rows = np.repeat(np.arange(len(x)), near.shape[1])
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rows), table, np.int32)), pa.array(near.ravel().astype(np.int32)), *(c.take(pa.array(rows)) for c in batch.columns)], ["table", "bucket", "vec_id", "vec"])

        return run

    schema = "table int, bucket int, vec_id long, vec binary"
    spark = df.sparkSession
    placed = written(mapped(base, hashed(1), schema), "ann-tables")
    # at most tables x 2 x width rows, whatever the size of the input
    parts = placed.groupBy("table", "bucket").agg(F.ceil(F.count("*") / PART_ROWS).cast("int").alias("parts"))
    there = placed.join(parts, ["table", "bucket"]).withColumn("part", F.pmod(F.xxhash64("vec_id"), "parts").cast("int")).withColumn("asks", F.lit(0))
    columns = ["table", "bucket", "part", "asks", "vec_id", "vec"]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def answers(ids: list[int], vecs: list[bytes]) -> pa.RecordBatch:
            q = np.frombuffer(b"".join(vecs), kind).reshape(-1, dim).astype(np.float64)
            scores = q @ held.T
            scores[np.array(ids)[:, None] == held_ids] = -np.inf
            out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
            for i, query in enumerate(ids):
                least = np.partition(scores[i], -k)[-k] if scores.shape[1] > k else -np.inf
                # a matrix product may round equal rows apart, so near ties are scored again one by one
                some = np.flatnonzero((scores[i] >= least - 1e-9 * (1 + abs(least) if np.isfinite(least) else 1)) & (scores[i] > -np.inf))
                exact = np.einsum("ij,j->i", held[some], q[i])
                best = np.lexsort((held_ids[some], -exact))[:k]
                out.append((np.full(len(best), query), held_ids[some[best]], exact[best]))
            a, b, c = (np.concatenate(x) for x in zip(*out))
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c, pa.float64())], ["query_id", "vec_id", "score"])

        at, base_ids, base_vecs, ids, vecs = None, [], [], [], []
        held = held_ids = None
        for batch in batches:
            for t, b, p, asks, i, v in zip(*(c.to_pylist() for c in batch.columns)):
                if at != (t, b, p):
                    if ids:
                        yield answers(ids, vecs)
                    at, base_ids, base_vecs, ids, vecs, held = (t, b, p), [], [], [], [], None
                if not asks:
                    base_ids.append(i)
                    base_vecs.append(v)
                    continue
                if held is None:
                    held, held_ids = np.frombuffer(b"".join(base_vecs), kind).reshape(-1, dim).astype(np.float64), np.array(base_ids, np.int64)
                ids.append(i)
                vecs.append(v)
                if len(ids) == QUERY_ROWS:
                    yield answers(ids, vecs)
                    ids, vecs = [], []
        if ids:
            yield answers(ids, vecs)

    def answered(queries: DataFrame, tables: int, n: int) -> DataFrame:
        asked = mapped(queries, hashed(n, tables), schema).join(parts, ["table", "bucket"])
        asked = asked.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).withColumn("asks", F.lit(1))
        rows = there.filter(F.col("table") < tables).select(columns).union(asked.select(columns))
        dealt = rows.repartition(partitions(spark), "table", "bucket", "part").sortWithinPartitions("table", "bucket", "part", "asks")
        found = mapped(dealt, search, NEAR).distinct()
        rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
        return written(found.withColumn("rank", rank).filter(f"rank <= {k}").select("query_id", "rank", "vec_id", "score"), "ann-answers")

    queries, every = vectors.filter(is_query).distinct(), 2 << max(0, dim - 1).bit_length()
    out, n = None, min(probes, every)
    while True:
        last = n == every
        now = answered(queries, 1 if last else tables, n)
        full = now.groupBy("query_id").count().filter(f"count >= {k}").select(F.col("query_id").alias("vec_id"))
        done = now if last else now.join(full.withColumnRenamed("vec_id", "query_id"), "query_id", "left_semi")
        out = done if out is None else out.union(done)
        if last:
            return out
        queries = written(queries.join(full, "vec_id", "left_anti"), "ann-short")
        if queries.isEmpty():
            return out
        n = min(n * WIDER, every)
