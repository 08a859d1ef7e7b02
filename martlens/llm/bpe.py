"""Byte-level BPE encoding and decoding of whole texts.

Each match of the split pattern is a piece. A piece that is a token is that token; all others
are merged together as padded numpy matrices, one matrix per length bucket: in each round every
row finds its leftmost pair of least rank (pair ranks come from an open-addressed hash table),
merges it and is compacted; rows without a pair that merges leave the matrix. Pieces over
``MATRIX_BYTES`` (long runs of one character class) would make a matrix quadratic in their
length, so they are merged one by one with a heap of pairs, which gives the same tokens.

Spark reads and splits the texts; a task needs the vocabulary and one slice of a batch.
Pieces repeat, so each worker keeps the ids of up to ``CACHE_PIECES`` pieces; that only saves
time. Null texts count as empty, empty texts have no ids, repeated rows are encoded alike and
columns other than those named are passed on or ignored.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlens.llm.common import U64, mapped, text_slices

MATRIX_BYTES = 256
MATRIX_CELLS = 1 << 16
CACHE_PIECES = 50_000
SLICE_BYTES = 1 << 20
NONE = np.int32(2**31 - 1)


class PairTable:
    """Ranks of (left id, right id) pairs in an open-addressed table with linear probing."""

    EMPTY = U64(2**64 - 1)

    def __init__(self, pairs: dict[int, int]):
        self.bits = max(4, (2 * len(pairs)).bit_length())
        self.mask = (1 << self.bits) - 1
        self.keys = np.full(1 << self.bits, self.EMPTY, U64)
        self.ranks = np.full(1 << self.bits, NONE, np.int32)
        keys = np.fromiter(pairs, U64, len(pairs))
        ranks = np.fromiter(pairs.values(), np.int32, len(pairs))
        slot = self._slot(keys)
        while len(keys):
            free = self.keys[slot] == self.EMPTY
            first = np.zeros(len(keys), bool)
            first[np.unique(slot, return_index=True)[1]] = True
            put = free & first
            self.keys[slot[put]], self.ranks[slot[put]] = keys[put], ranks[put]
            keys, ranks, slot = keys[~put], ranks[~put], slot[~put]
            taken = self.keys[slot] != self.EMPTY
            slot[taken] = (slot[taken] + 1) & self.mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * U64(0x9E3779B97F4A7C15)) >> U64(64 - self.bits)).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, ``NONE`` where it does not merge; negative ids never merge."""
        out = np.full(left.shape, NONE, np.int32)
        todo = np.flatnonzero((left >= 0) & (right >= 0))
        keys = (left[todo].astype(U64) << U64(32)) | right[todo].astype(U64)
        slot = self._slot(keys)
        while len(todo):
            there = self.keys[slot]
            hit = there == keys
            out[todo[hit]] = self.ranks[slot[hit]]
            more = ~hit & (there != self.EMPTY)
            todo, keys, slot = todo[more], keys[more], (slot[more] + 1) & self.mask
        return out


def ranked(path: str) -> Iterator[tuple[bytes, int]]:
    """(token, rank) of each line of a rank file (base64 token, rank)."""
    with open(path, "rb") as lines:
        for line in lines:
            if line.strip():
                token, rank = line.split()
                yield base64.b64decode(token), int(rank)


class Vocabulary:
    """Ids by token bytes and the merge ranks of a rank file."""

    def __init__(self, path: str):
        self.ids = dict(ranked(path))
        self.byte_ids = np.array([self.ids.get(bytes([b]), -1) for b in range(256)], np.int32)
        self.pairs: dict[int, int] = {}
        for token, rank in self.ids.items():
            for i in range(1, len(token)):
                left, right = self.ids.get(token[:i]), self.ids.get(token[i:])
                if left is not None and right is not None:
                    self.pairs[left << 32 | right] = rank
        self.table = PairTable(self.pairs)

    def encode_pieces(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each piece, packed as little-endian unsigned 32-bit integers."""
        out: list[bytes] = [b""] * len(pieces)
        buckets: dict[int, list[int]] = {}
        for i, piece in enumerate(pieces):
            whole = self.ids.get(piece)
            if whole is not None:
                out[i] = whole.to_bytes(4, "little")
            elif len(piece) > MATRIX_BYTES:
                out[i] = np.array(self._merge_long(piece), "<u4").tobytes()
            else:
                buckets.setdefault(max(4, 1 << (len(piece) - 1).bit_length()), []).append(i)
        for width, rows in buckets.items():
            for k in range(0, len(rows), MATRIX_CELLS // width):
                self._merge_matrix(pieces, rows[k : k + MATRIX_CELLS // width], width, out)
        return out

    def _merge_matrix(self, pieces: list[bytes], rows: list[int], width: int, out: list[bytes]) -> None:
        raw = b"".join(pieces[i].ljust(width, b"\0") for i in rows)
        length = np.array([len(pieces[i]) for i in rows])
        ids = self.byte_ids[np.frombuffer(raw, np.uint8)].reshape(len(rows), width)
        ids = np.where(np.arange(width) < length[:, None], ids, np.int32(-1))
        rank = self.table.rank(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(rows), width - 1)
        where = np.array(rows)
        while len(where):
            at = rank.argmin(1)  # the first of equal ranks: the leftmost
            best = rank[np.arange(len(at)), at]
            ended = best == NONE
            for i in np.flatnonzero(ended):
                out[where[i]] = ids[i, : length[i]].astype("<u4").tobytes()
            going = ~ended
            ids, rank, length, where = ids[going], rank[going], length[going] - 1, where[going]
            at, best = at[going], best[going]
            if not len(where):
                return
            width = ids.shape[1]
            row = np.arange(len(where))
            ids[row, at] = best
            ids = np.concatenate([ids, np.full((len(row), 1), -1, np.int32)], 1)
            column = np.arange(width)
            ids = np.take_along_axis(ids, column + (column > at[:, None]), 1)
            rank = np.concatenate([rank, np.full((len(row), 1), NONE, np.int32)], 1)
            rank = np.take_along_axis(rank, column[:-1] + (column[:-1] > at[:, None]), 1)
            right = np.where(at + 1 < width, ids[row, np.minimum(at + 1, width - 1)], -1)
            has = at < width - 1
            rank[row[has], at[has]] = self.table.rank(best[has], right[has])
            left = np.where(at > 0, ids[row, np.maximum(at - 1, 0)], -1)
            has = at > 0
            rank[row[has], at[has] - 1] = self.table.rank(left[has], best[has])
            keep = max(2, int(length.max()))
            ids, rank = ids[:, :keep], rank[:, : keep - 1]

    def _merge_long(self, piece: bytes) -> list[int]:
        ids = self.byte_ids[np.frombuffer(piece, np.uint8)].tolist()
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        pair = self.pairs.get
        heap = [(r, i) for i in range(len(ids) - 1) if (r := pair(ids[i] << 32 | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i]
            if ids[i] < 0 or j >= len(ids) or pair(ids[i] << 32 | ids[j]) != rank:
                continue  # one of the two has been merged meanwhile
            ids[i], ids[j], after[i] = rank, -1, after[j]
            if after[i] < len(ids):
                before[after[i]] = i
                if (r := pair(rank << 32 | ids[after[i]])) is not None:
                    heapq.heappush(heap, (r, i))
            if before[i] >= 0 and (r := pair(ids[before[i]] << 32 | rank)) is not None:
                heapq.heappush(heap, (r, before[i]))
        return [x for x in ids if x >= 0]


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    """Loaded once per Python worker."""
    return Vocabulary(path)


@lru_cache(maxsize=2)
def token_bytes(path: str) -> dict[int, bytes]:
    """Token bytes by id: all that decoding needs. Loaded once per Python worker."""
    return {rank: token for token, rank in ranked(path)}


class Encoder:
    """Packed ids of whole texts, with the ids of pieces seen lately."""

    def __init__(self, path: str, pattern: str):
        import regex

        self.vocabulary, self.split = vocabulary(path), regex.compile(pattern).findall
        self.cache: dict[str, bytes] = {}

    def packed(self, texts: list[str | None]) -> list[bytes]:
        found = [self.split(t) if t else [] for t in texts]
        if len(self.cache) > CACHE_PIECES:
            self.cache.clear()
        new = list({p for pieces in found for p in pieces}.difference(self.cache))
        self.cache.update(zip(new, self.vocabulary.encode_pieces([p.encode() for p in new])))
        return [b"".join(map(self.cache.__getitem__, pieces)) for pieces in found]


def decoded(packed: bytes | None, token: dict[int, bytes]) -> bytes:
    return b"".join(map(token.__getitem__, np.frombuffer(packed or b"", "<u4").tolist()))


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and ``ids``: the packed token ids (binary, little-endian uint32) of ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path, pattern)
        for batch in text_slices(batches, "__text", SLICE_BYTES):
            ids = pa.array(encoder.packed(batch.column(batch.num_columns - 1).to_pylist()), pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], ids], [*batch.schema.names[:-1], "ids"])

    rows = df.select(*keep, F.col(text).cast("string").alias("__text"))
    return mapped(rows, run, T.StructType([*rows.schema.fields[:-1], T.StructField("ids", T.BinaryType())]))


def round_trip(df: DataFrame, path: str, pattern: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, the packed ``ids`` of ``text`` and ``decoded_sha256``, the digest of what those ids decode to.

    One pass: ids are decoded where they were made, a slice at a time, so no task holds texts and
    decoded bytes of a whole batch.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, token = Encoder(path, pattern), token_bytes(path)
        for batch in text_slices(batches, "__text", SLICE_BYTES):
            ids = encoder.packed(batch.column(batch.num_columns - 1).to_pylist())
            digests = pa.array([hashlib.sha256(decoded(x, token)).hexdigest() for x in ids], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(ids, pa.binary()), digests], [*batch.schema.names[:-1], "ids", "decoded_sha256"])

    rows = df.select(*keep, F.col(text).cast("string").alias("__text"))
    return mapped(rows, run, T.StructType([*rows.schema.fields[:-1], T.StructField("ids", T.BinaryType()), T.StructField("decoded_sha256", T.StringType())]))


def decode(df: DataFrame, path: str, ids: str = "ids", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns and ``decoded``: the bytes that the packed ``ids`` stand for (null: empty)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = token_bytes(path)
        for batch in text_slices(batches, "__ids", 4 * SLICE_BYTES):
            out = [decoded(x, token) for x in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(out, pa.binary())], [*batch.schema.names[:-1], "decoded"])

    rows = df.select(*keep, F.col(ids).alias("__ids"))
    return mapped(rows, run, T.StructType([*rows.schema.fields[:-1], T.StructField("decoded", T.BinaryType())]))
