"""Registered queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martlens.llm import (
    ann, bpe, fingerprints, line_dedup, merkle, mixing, ngram_join, secrets, suffix_dedup, token_counts, toxicity, warc, whitening,
)
from martlens.llm.common import read, written

RANKS = "byte_bpe_50k.tiktoken"


def op1_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(RANKS)
    ids = bpe.encode(read(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)
    ids = ids.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), "ids")
    out = bpe.decode(ids, path, keep=("doc_id", "n_tokens", "ids_sha256"))
    return out.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(read(spark, sf_dir, "documents"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.encode(F.coalesce("text", F.lit("")), "UTF-8"), 256).alias("kept_sha256"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    spans = written(suffix_dedup.repeated_spans(docs), "suffix-spans")
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + x.stop - x.start)
    spans = spans.withColumn("n_removed", removed).withColumn("n_spans", F.size("spans").cast("long"))
    # texts are read again only where some bytes stay and some go
    cut = spans.filter("n_removed > 0 AND n_removed < n_bytes")
    ids = cut.select("doc", "mark").distinct()
    if ids.limit(suffix_dedup.BROADCAST_IDS + 1).count() <= suffix_dedup.BROADCAST_IDS:
        docs = docs.join(F.broadcast(ids), (F.coalesce("doc_id", F.lit(suffix_dedup.NO_ID)) == ids.doc) & (F.xxhash64(F.coalesce("text", F.lit(""))) == ids.mark), "left_semi")
    kept = suffix_dedup.without_spans(docs, cut).select("doc", "mark", F.sha2("kept", 256).alias("kept_sha256")).distinct()
    out = spans.join(kept, ["doc", "mark"], "left")
    sha = F.when(F.col("n_removed") == 0, F.col("sha256")).when(F.col("n_removed") == F.col("n_bytes"), F.sha2(F.lit("").cast("binary"), 256)).otherwise(F.col("kept_sha256"))
    doc = F.when(F.col("doc") != suffix_dedup.NO_ID, F.col("doc"))
    return out.select(doc.alias("doc_id"), "n_bytes", "n_removed", "n_spans", sha.alias("kept_sha256"))


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(read(spark, sf_dir, "documents"))


def held_out(key: str) -> Column:
    """Rows that no label is learned from."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2


#: Scores from here on count as label 1.
TOXIC_FROM = 0.3


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, read(spark, sf_dir, "labels").filter(~held_out("doc_id")))
    out = toxicity.score(docs, model)
    return out.select("doc_id", F.coalesce(held_out("doc_id"), F.lit(False)).alias("held_out"), "score", (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"), "evidence")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.write_archives(read(spark, sf_dir, "pages"), warc.archive_folder(spark))
    return warc.read_records(index).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP8_SQL = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
g AS (SELECT payload_digest, max(page_id) AS response FROM p WHERE payload_bytes >= 1000 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN response IS NULL OR response = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN response <> page_id THEN response END AS refers_to
FROM p LEFT JOIN g USING (payload_digest)
"""


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = fingerprints.with_next(rows, "doc_id", ["text"], lambda d: fingerprints.with_words(d, "text", "words"))
    n, half = F.length("text"), F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("next_text"), F.lit(1), half))
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), edited.alias("edited"), "words", "next_words")
    rows = fingerprints.with_words(rows, "edited", "edited_words")
    rows = fingerprints.with_likeness(rows, "words", {"near_edited": "edited_words", "near_next": "next_words"})
    return rows.select("doc_id", "n_chars", F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
                       fingerprints.text_of(F.col("words")).alias("fingerprint"), fingerprints.text_of(F.col("edited_words")).alias("edited_fingerprint"),
                       "near_edited", "near_next")


#: Repetition limit of the production mix: a source is passed over twice at most.
MAX_REPEATS = 2.0


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", mixing.default_tokens().alias("tokens"))
    out = mixing.mix(docs, "doc_id", tokens=F.col("tokens"), max_repeats=MAX_REPEATS)
    return out.select("doc_id", "source", F.round("weight", 9).alias("weight"), "turn", "block", "place", "n_tokens")


#: Fields of a document's leaf, in this order.
LEAF_FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select(*LEAF_FIELDS)
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    n_chars = F.when(tampered, F.try_add(F.col("n_chars"), F.lit(1))).otherwise(F.col("n_chars"))
    now = merkle.leaf_digest([n_chars if c == "n_chars" else F.col(c) for c in LEAF_FIELDS])
    rows = merkle.proofs(docs, merkle.leaf_digest([F.col(c) for c in LEAF_FIELDS]), "lang", "doc_id",
                         {"doc_id": F.col("doc_id"), "now": F.when(tampered & F.col("n_chars").isNotNull(), F.unhex(now))})
    rows = rows.withColumn("folded_root", merkle.folded(F.coalesce(merkle.hex_of(F.col("now")), "leaf"), F.col("proof")))
    return rows.select("doc_id", "leaf", "subroot", "root", F.sha2(F.encode(merkle.siblings(F.col("proof")), "UTF-8"), 256).alias("proof_sha256"),
                       "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def _sql_leaf(n_chars: str) -> str:
    values = ["doc_id", "source", "lang", n_chars, "text"]
    return "sha256(" + " || ".join(f"CASE WHEN {v} IS NULL THEN '-' ELSE strlen(CAST({v} AS VARCHAR)) || ':' || CAST({v} AS VARCHAR) END" for v in values) + ")"


#: crc32 bit by bit: its reflected polynomial over the digits of the id.
_SQL_CRC = """xor(4294967295::UBIGINT, list_reduce(
    list_concat([4294967295::UBIGINT], list_transform(range(1, strlen(CAST(doc_id AS VARCHAR)) + 1), lambda i: ascii(substr(CAST(doc_id AS VARCHAR), i, 1))::UBIGINT)),
    lambda c, b: list_reduce(list_concat([xor(c, b)], [0::UBIGINT, 0, 0, 0, 0, 0, 0, 0]),
                      lambda x, z: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::UBIGINT) ELSE x // 2 END)))"""

OP11_SQL = f"""
WITH RECURSIVE leaves AS (
  SELECT row_number() OVER () AS rid, doc_id, lang, leaf, CASE WHEN crc % 7 = 0 AND n_chars IS NOT NULL THEN changed ELSE leaf END AS now,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p, count(*) OVER (PARTITION BY lang) AS n
  FROM (SELECT doc_id, lang, n_chars, {_sql_leaf("n_chars")} AS leaf, {_sql_leaf("(n_chars + 1)")} AS changed, {_SQL_CRC} AS crc FROM documents)),
low AS (
  SELECT lang, 0 AS l, p AS i, n, leaf AS h FROM leaves
  UNION ALL
  SELECT lang, l + 1, i // 2, (any_value(n) + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM low WHERE n > 1 GROUP BY lang, l, i // 2),
langs AS (SELECT lang, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS p, count(*) OVER () AS n, max(l) OVER () AS deepest, l AS depth FROM low WHERE n = 1),
top AS (
  SELECT 0 AS l, p AS i, n, h FROM langs
  UNION ALL
  SELECT l + 1, i // 2, (any_value(n) + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM top WHERE n > 1 GROUP BY l, i // 2),
steps AS (
  SELECT rid, low.l AS l, (p >> low.l) AS at, s.h AS h
  FROM leaves JOIN low ON low.lang IS NOT DISTINCT FROM leaves.lang AND low.i = (p >> low.l) AND low.n > 1
  LEFT JOIN low s ON s.lang IS NOT DISTINCT FROM leaves.lang AND s.l = low.l AND s.i = xor(p >> low.l, 1)
  UNION ALL
  SELECT rid, depth + top.l, (langs.p >> top.l), s.h
  FROM leaves JOIN langs ON langs.lang IS NOT DISTINCT FROM leaves.lang JOIN top ON top.i = (langs.p >> top.l) AND top.n > 1
  LEFT JOIN top s ON s.l = top.l AND s.i = xor(langs.p >> top.l, 1)),
folds AS (
  SELECT rid, 0 AS l, now AS h FROM leaves
  UNION ALL
  SELECT f.rid, f.l + 1, sha256(CASE WHEN s.at % 2 = 0 THEN f.h || coalesce(s.h, '') ELSE s.h || f.h END) FROM folds f JOIN steps s ON s.rid = f.rid AND s.l = f.l),
folded AS (SELECT rid, arg_max(h, l) AS folded_root FROM folds GROUP BY rid),
proofs AS (SELECT rid, sha256(coalesce(string_agg(h, '' ORDER BY l), '')) AS proof_sha256 FROM steps GROUP BY rid)
SELECT doc_id, leaf, langs.h AS subroot, top.h AS root, coalesce(proof_sha256, sha256('')) AS proof_sha256, folded_root, folded_root = top.h AS verified
FROM leaves JOIN langs ON langs.lang IS NOT DISTINCT FROM leaves.lang JOIN top ON top.n = 1 JOIN folded USING (rid) LEFT JOIN proofs USING (rid)
"""


def op12_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(read(spark, sf_dir, "documents"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings")
    return whitening.whiten(rows, whitening.fit(rows))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ann": op1_ann,
    "op2_bpe": op2_bpe,
    "op3_token_counts": op3_token_counts,
    "op4_line_dedup": op4_line_dedup,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_ngram_join": op6_ngram_join,
    "op7_toxicity": op7_toxicity,
    "op8_warc": op8_warc,
    "op9_fingerprints": op9_fingerprints,
    "op10_mixing": op10_mixing,
    "op11_merkle": op11_merkle,
    "op12_secrets": op12_secrets,
    "op13_whitening": op13_whitening,
}
ORACLE_SQL: dict[str, str] = {"op8_warc": OP8_SQL, "op11_merkle": OP11_SQL}
