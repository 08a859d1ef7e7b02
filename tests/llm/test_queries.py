"""The registered queries themselves against plain models, and the pipeline's stages on odd tables."""

import ast
import hashlib
import pathlib
from collections import defaultdict

import corpus_pipeline
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

import __spark_entry__
from martlens.llm import mixing, queries

HERE = pathlib.Path(__file__).parent
#: The test that holds a query without SQL against brute force, a plain model, a round trip or held-out labels.
BRUTE_FORCE = {
    "op1_ann": "test_ann_recall_on_the_small_given_table",
    "op2_bpe": "test_bpe_equals_the_library_and_round_trips",
    "op3_token_counts": "test_token_counts_are_greedy_longest_match",
    "op4_line_dedup": "test_line_dedup_equals_all_pairs",
    "op5_suffix_dedup": "test_suffix_dedup_equals_brute_force",
    "op6_ngram_join": "test_ngram_join_equals_all_pairs",
    "op7_toxicity": "test_toxicity_finds_label_words_and_search_is_exact",
    "op9_fingerprints": "test_fingerprint_query_equals_a_plain_model",
    "op10_mixing": "test_mixing_query_equals_a_plain_model",
    "op12_secrets": "test_base_matches_equal_the_patterns",
    "op13_whitening": "test_whitening_equals_a_dense_solver",
    "pipeline": "test_stages",
}


def test_every_query_without_sql_has_a_brute_force_test():
    assert set(__spark_entry__.LLM_QUERIES) - set(__spark_entry__.LLM_ORACLE_SQL) == set(BRUTE_FORCE)
    tests = {n.name for f in HERE.glob("test_*.py") for n in ast.parse(f.read_text()).body if isinstance(n, ast.FunctionDef)}
    assert set(BRUTE_FORCE.values()) <= tests


def documents(spark):
    return sorted(spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect(), key=lambda r: r["doc_id"])


def test_fingerprint_query_equals_a_plain_model(spark):
    docs = documents(spark)
    texts = [r["text"] or "" for r in docs]
    got = {r["doc_id"]: r for r in queries.op9_fingerprints(spark, SF_SMALL).collect()}
    by_text = defaultdict(set)
    for i, r in enumerate(docs):
        text, after = texts[i], texts[(i + 1) % len(docs)]
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        row = got[r["doc_id"]]
        assert row["n_chars"] == len(text) and row["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        by_text[text].add(row["fingerprint"])
        by_text[edited].add(row["edited_fingerprint"])
        assert 0 <= row["near_edited"] <= 1 and 0 <= row["near_next"] <= 1
        lines, others = ([x for x in t.split("\n")] for t in (text, after))
        if text == after:
            assert row["near_next"] == pytest.approx(1)
        elif not set(lines) & set(others):
            assert row["near_next"] < 0.45
    assert all(len(f) == 1 for f in by_text.values())  # equal texts have equal fingerprints
    assert len({f for fs in by_text.values() for f in fs}) > 0.9 * len(by_text)


def test_mixing_query_equals_a_plain_model(spark):
    docs = documents(spark)
    tokens = {r["doc_id"]: max(1, -(-len((r["text"] or "").encode()) // 4)) for r in docs}
    per_source = defaultdict(list)
    for r in docs:
        per_source[r["source"] or ""].append(r["doc_id"])
    totals = {s: sum(tokens[i] for i in ids) for s, ids in per_source.items()}
    whole = sum(totals.values())

    def repeats(a):
        w = {s: (t / whole) ** a for s, t in totals.items()}
        passes = {s: w[s] / totals[s] for s in totals}
        return {s: p / min(passes.values()) for s, p in passes.items()}, {s: x / sum(w.values()) for s, x in w.items()}

    low, high = 0.0, 1.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (low, mid) if max(repeats(mid)[0].values()) <= queries.MAX_REPEATS else (mid, high)
    exponent = 0.0 if max(repeats(0.0)[0].values()) <= queries.MAX_REPEATS else high
    passes, weights = repeats(exponent)
    place = lambda turn, i: hashlib.md5(f"0:{turn}:{i}".encode()).hexdigest()[: mixing.PLACE_DIGITS]
    want = set()
    for s, ids in per_source.items():
        budget = round(passes[s] * totals[s])
        turns, rest = divmod(budget, totals[s])
        want |= {(i, s, t, place(t, i)) for t in range(turns) for i in ids}
        for at, i in sorted((place(turns, i), i) for i in ids):
            if tokens[i] > rest:
                break
            rest -= tokens[i]
            want.add((i, s, turns, at))
    rows = queries.op10_mixing(spark, SF_SMALL).collect()
    got = {(r["doc_id"], r["source"] or "", r["turn"], r["place"]) for r in rows}
    # a budget is rounded: one row at a cut may differ where the exponent's last digits do
    assert len(got) == len(rows) and len(got ^ want) <= 1
    for r in rows:
        assert r["weight"] == pytest.approx(weights[r["source"] or ""], abs=1e-6)
        assert r["block"] == r["place"][: mixing.BLOCK_DIGITS] and r["n_tokens"] == tokens[r["doc_id"]]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_the_mix_doesnt_move_texts(spark, monkeypatch):
    rows = spark.createDataFrame([(i, f"text {i}" * 9, "big" if i % 3 else f"s{i % 7}") for i in range(600)], "doc_id long, text string, source string").repartition(4)
    small = mixing.mix(rows, "doc_id", max_repeats=2.0)
    above = plan_of(small).split("BroadcastExchange")[0]
    assert "BroadcastHashJoin" in above and "Exchange hashpartitioning" not in above
    monkeypatch.setattr(mixing, "BROADCAST_BYTES", 0)
    salted = mixing.mix(rows, "doc_id", max_repeats=2.0)
    assert "__salt" in plan_of(salted)
    pick = lambda df: sorted(map(tuple, df.select("doc_id", "source", "turn", "place").collect()))
    assert pick(salted) == pick(small)


DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, place string, __source string, turn int"


def odd_rows():
    base = [(i, f"alpha{i} beta{i * 7} gamma{i * 13} delta{i * 3} omega{i * 5}", "en", f"s{i % 3}", 40) for i in range(40)]
    odd = [(None, "one two three four five six seven", None, None, None), (None, "another text that has no id at all", "en", "s1", 1),
           (7, "seventh id stands twice with other words", "en", "s1", 5), (41, None, "en", "s0", None), (42, "", "de", "s0", 0), (43, "w " * 60_000, "en", "s2", 120_000)]
    return [(*r, 1.0, "x", "y", 3) for r in base + odd]


@pytest.mark.parametrize("name, rows", [("empty", []), ("null texts", [(i, None, None, None, None, None, None, None, None) for i in range(5)]), ("odd", odd_rows())])
def test_stages_on_odd_tables(spark, scratch, name, rows):
    """Null ids, repeated ids, null and long texts, empty tables and clashing columns: every stage runs, clean rows stay."""
    spark.createDataFrame(rows, DOCS).repartition(2).write.parquet(f"{scratch}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i < 3)) for i in range(20)], "doc_id long, quality int, toxic int").write.parquet(f"{scratch}/labels.parquet")
    docs = spark.read.parquet(f"{scratch}/documents.parquet")
    for stage, run in corpus_pipeline.STAGES:
        before, ids = docs.count(), {r["doc_id"] for r in docs.select("doc_id").collect()}
        run(spark, docs, scratch).write.parquet(f"{scratch}/{stage}")
        docs = spark.read.parquet(f"{scratch}/{stage}")
        if stage.startswith("mixing"):
            assert docs.count() >= before and {r["doc_id"] for r in docs.select("doc_id").collect()} == ids
        if stage.startswith("byte"):
            assert docs.count() == before and docs.filter("n_tokens <> octet_length(ids) / 4").count() == 0
    kept = {r["doc_id"] for r in docs.collect()}
    if name == "odd":
        assert {None, 7, 42, 43} | set(range(20, 40)) <= kept
    elif name == "empty":
        assert not kept


def test_the_mix_is_written_in_the_order_of_its_permutations(spark, scratch):
    spark.createDataFrame(odd_rows(), DOCS).write.parquet(f"{scratch}/documents.parquet")
    docs = spark.read.parquet(f"{scratch}/documents.parquet")
    out = corpus_pipeline.mixing_stage(spark, docs, scratch)
    got = [r["doc_id"] for r in out.select(F.monotonically_increasing_id().alias("at"), "doc_id").orderBy("at").collect()]
    mix = mixing.mix(docs, "doc_id", max_repeats=queries.MAX_REPEATS).orderBy("turn", "place")
    assert [i for i in got if i] == [r["doc_id"] for r in mix.select("doc_id").collect() if r["doc_id"]]


def test_ngram_stage_tells_rows_apart_by_id_and_text(spark, scratch):
    text = " ".join(f"word{i}" for i in range(50))
    clean = " ".join(f"other{i}" for i in range(50))
    rows = [(5, text), (9, text + " tail"), (9, clean), (None, text + " tail more"), (None, "a null id and words of its own here"), (12, "repeated row " + clean[::-1]),
            (12, "repeated row " + clean[::-1]), (13, ""), (13, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    kept = sorted(((r["doc_id"], r["text"]) for r in corpus_pipeline.ngram_join_stage(spark, docs, scratch).collect()), key=str)
    assert kept == sorted([rows[0], rows[2], rows[4], rows[5], rows[7], rows[8]], key=str)
