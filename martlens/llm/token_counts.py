"""Token counts by greedy longest match, without building the pieces.

The vocabulary is a byte trie with failure links. A node's failure link says where matching goes
on after its longest tokens are taken, and ``pops`` how many tokens that takes; both are computed
once, breadth first. A word is then counted in one left-to-right pass: follow an edge if there
is one, else add the node's ``pops`` and take its failure link. Each byte is read once and each
failure step gives up at least one byte of depth, so the pass is linear in the word.

Words are split by a pattern; counts of up to ``CACHE_WORDS`` words are kept in a worker to save
time. ``prefix`` marks pieces that go on inside a word (as "##" does); with an empty prefix one
set of pieces serves everywhere. A word that cannot be covered counts as one unknown token.
Null and empty texts have no tokens; repeated rows count alike; other columns are passed or ignored.
"""

from __future__ import annotations

import base64
from collections import deque
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlens.llm.common import mapped, text_slices

CACHE_WORDS = 200_000
SLICE_BYTES = 1 << 20


class Automaton:
    """Nodes are numbers; node 0 is the start of a word and ``inner`` the start of a later piece."""

    def __init__(self, pieces: list[bytes], prefix: bytes = b""):
        self.edges: list[dict[int, int]] = [{}]
        token = [False]

        def insert(node: int, text: bytes) -> None:
            for b in text:
                if b not in self.edges[node]:
                    self.edges[node][b] = len(self.edges)
                    self.edges.append({})
                    token.append(False)
                node = self.edges[node][b]
            token[node] = True

        self.inner = 0
        if prefix:
            self.inner = 1
            self.edges.append({})
            token.append(False)
        for piece in pieces:
            if prefix and piece.startswith(prefix) and len(piece) > len(prefix):
                insert(self.inner, piece[len(prefix):])
            elif piece:
                insert(0, piece)
        self.fail: list[int] = [-1] * len(self.edges)  # -1: no token ends here or before
        self.pops = [0] * len(self.edges)
        todo = deque({0, self.inner})
        while todo:
            u = todo.popleft()
            for b, v in self.edges[u].items():
                if token[v]:
                    self.fail[v], self.pops[v] = self.inner, 1
                else:
                    z, pops = self.fail[u], self.pops[u]
                    while z >= 0 and b not in self.edges[z]:
                        pops += self.pops[z]
                        z = self.fail[z]
                    if z >= 0:
                        self.fail[v], self.pops[v] = self.edges[z][b], pops
                todo.append(v)

    def count(self, word: bytes) -> int:
        """Pieces of the greedy longest-match split of ``word``; 1 where it has none."""
        edges, fail, pops, inner = self.edges, self.fail, self.pops, self.inner
        node = total = 0
        for b in word:
            while (step := edges[node].get(b)) is None:
                total += pops[node]
                node = fail[node]
                if node < 0:
                    return 1
            node = step
        while node != inner:
            if node < 0:
                return 1
            total += pops[node]
            node = fail[node]
        return total


@lru_cache(maxsize=2)
def rank_file_automaton(path: str) -> Automaton:
    """The automaton over the tokens of a rank file, built once per Python worker."""
    with open(path, "rb") as lines:
        return Automaton([base64.b64decode(line.split()[0]) for line in lines if line.strip()])


def count_tokens(df: DataFrame, path: str, pattern: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, ``n_words`` and ``n_tokens`` of ``text`` under the tokens of the rank file at ``path``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        automaton, split = rank_file_automaton(path), regex.compile(pattern).findall
        cache: dict[str, int] = {}
        for batch in text_slices(batches, "__text", SLICE_BYTES):
            found = [split(t) if t else [] for t in batch.column(batch.num_columns - 1).to_pylist()]
            if len(cache) > CACHE_WORDS:
                cache.clear()
            for word in {w for words in found for w in words}.difference(cache):
                cache[word] = automaton.count(word.encode())
            columns = [pa.array([len(words) for words in found], pa.int64()),
                       pa.array([sum(map(cache.__getitem__, words)) for words in found], pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], [*batch.schema.names[:-1], "n_words", "n_tokens"])

    rows = df.select(*keep, F.col(text).cast("string").alias("__text"))
    return mapped(rows, run, T.StructType([*rows.schema.fields[:-1], T.StructField("n_words", T.LongType()), T.StructField("n_tokens", T.LongType())]))
