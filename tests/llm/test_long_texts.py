"""Texts of very many paragraphs and lines: results stay right, work stays linear in one row."""

import time

from pyspark.sql import functions as F

from martlens.llm import fingerprints, line_dedup


def test_likeness_of_texts_with_many_paragraphs(spark):
    n = 40_000
    texts = ["\n".join(f"{name} paragraph {i}" for i in range(n)) for name in ("left", "right")]
    half = "\n".join(f"{'left' if i % 2 else 'other'} paragraph {i}" for i in range(n))
    df = spark.createDataFrame([(1, texts[0], texts[1], half)], "id long, a string, b string, c string")
    for c in ("a", "b", "c"):
        df = fingerprints.with_words(df, c, f"{c}_words")
    row = fingerprints.with_likeness(df, "a_words", {"strangers": "b_words", "halves": "c_words", "same": "a_words"}).first()
    assert row.strangers < 0.25 and 0.3 < row.halves < 0.7 and row.same == 1.0
    # insertion and deletion of the same paragraphs, in another order
    both = spark.createDataFrame([(1, texts[1] + "\n" + texts[0])], "id long, t string")
    whole = fingerprints.with_words(both, "t", "words").first().words
    summed = df.select(fingerprints.add(F.col("a_words"), F.col("b_words")).alias("w")).first().w
    assert list(whole) == list(summed)


def test_removed_lines_of_one_long_text(spark):
    n = 40_000
    lines = [f"line number {i // 2:07d} of this text, code {hash_of(i // 2)}" for i in range(n)]
    df = spark.createDataFrame([(1, "\n".join(lines)), (2, "short")], "doc_id long, text string")
    start = time.time()
    got = {r.doc_id: r for r in line_dedup.dedup_lines(df).collect()}
    assert got[2].text == "short" and got[2].n_removed == 0
    assert got[1].n_lines == n and got[1].n_removed == n // 2
    assert got[1].text == "\n".join(lines[::2])
    assert time.time() - start < 60


def hash_of(i: int) -> str:
    import hashlib

    return hashlib.md5(str(i).encode()).hexdigest()
