"""Every operator against brute force on small tables with nulls, empty and long texts, ties, repeats and clashing names."""

import base64
import hashlib
import os
import random
import time

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from martlens.llm import ann, bpe, common, fingerprints, line_dedup, mixing, ngram_join, suffix_dedup, token_counts, toxicity, warc

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, node long, bucket int"


def table(spark, texts, repeat=()):
    rows = [(i, t, None, None if i % 5 == 0 else f"s{i % 3}", None, 1.0, i, 2) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows + [rows[i] for i in repeat], DOCS).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def words(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def test_bpe_equals_the_library_and_round_trips(spark, empty):
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = ["Hello world, it's 2024!", None, "", "a" * 3000, "  \n\t x <|endoftext|>", "añb😀 ßç" * 50, "ab" * 400 + " " * 700 + "z"]
    ids = bpe.encode(table(spark, texts, repeat=[0]), RANKS, public_tokenizers.PATTERN)
    out = bpe.decode(ids.withColumn("packed", F.col("ids")), RANKS, keep=("doc_id", "packed")).collect()
    assert len(out) == len(texts) + 1
    for r in out:
        text = texts[r["doc_id"]] or ""
        assert np.frombuffer(r["packed"], "<u4").tolist() == own.encode_ordinary(text)
        assert bytes(r["decoded"]) == text.encode()
    assert bpe.encode(empty, RANKS, public_tokenizers.PATTERN).count() == 0


def test_token_counts_are_greedy_longest_match(spark, empty):
    vocabulary = {base64.b64decode(line.split()[0]) for line in open(RANKS, "rb")}
    longest = max(map(len, vocabulary))

    def greedy(word):
        n = i = 0
        while i < len(word):
            i = next(j for j in range(min(len(word), i + longest), i, -1) if word[i:j] in vocabulary)
            n += 1
        return n

    import regex

    texts = ["unbelievably tokenised words", None, "", "x" * 2000, "añb😀 ßç thethethe"]
    got = {r["doc_id"]: r for r in token_counts.count_tokens(table(spark, texts), RANKS, public_tokenizers.PATTERN).collect()}
    for i, t in enumerate(texts):
        found = regex.findall(public_tokenizers.PATTERN, t or "")
        assert (got[i]["n_words"], got[i]["n_tokens"]) == (len(found), sum(greedy(w.encode()) for w in found))
    assert token_counts.count_tokens(empty, RANKS, public_tokenizers.PATTERN).count() == 0
    marked = token_counts.Automaton([b"un", b"##aff", b"##able", b"##a"], b"##")
    assert [marked.count(w) for w in (b"unaffable", b"un", b"unx", b"affable", b"una")] == [3, 1, 1, 1, 2]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(row[j] + 1, now[-1] + 1, row[j - 1] + (x != y)))
        row = now
    return row[-1]


@pytest.mark.parametrize("edits", [0, 1, 2])
def test_line_dedup_equals_all_pairs(spark, empty, edits):
    rng = random.Random(edits)
    base = ["abcdefghij klm nop", "the quick brown fox", "short", "añb😀cdefg hijk lmno", "xyxyxyxyxyxyxyxyxyxy", ""]

    def changed(s):
        s = list(s)
        for _ in range(rng.randrange(4)):
            i = rng.randrange(len(s) + 1)
            s[i : i + rng.randrange(2)] = rng.choice(["", "a", "😀"])
        return "".join(s)

    texts = ["\n".join(changed(rng.choice(base)) for _ in range(rng.randrange(1, 6))) for _ in range(30)] + [None, ""]
    got = {r["doc_id"]: r for r in line_dedup.dedup_lines(table(spark, texts), max_edits=edits, min_chars=8).collect()}
    seen = []
    for i, t in enumerate(texts):
        kept = []
        for line in (t or "").split("\n"):
            if len(line) < 8 or not any(distance(line, o) <= edits for o in seen):
                kept.append(line)
            if len(line) >= 8:
                seen.append(line)
        assert (got[i]["text"] or "") == "\n".join(kept)
        assert got[i]["n_removed"] == got[i]["n_lines"] - len(kept) or not kept
    assert line_dedup.dedup_lines(empty, max_edits=edits).count() == 0


def one_edit(a, b):
    """Whether ``a`` and ``b`` are within one edit."""
    a, b = sorted((a, b), key=len)
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return len(b) - len(a) <= 1 and a[i + (len(a) == len(b)) :] == b[i + 1 :]


@pytest.mark.parametrize("crowd, pieces", [(64, 16), (1, 3)])
def test_line_dedup_of_large_groups_of_near_copies(spark, crowd, pieces, monkeypatch):
    monkeypatch.setattr(line_dedup, "CROWD", crowd)
    monkeypatch.setattr(line_dedup, "PIECES", pieces)
    rng = random.Random(5)
    passage = words(rng, 12).split()
    letters = [chr(0x4E00 + i) for i in range(120)]
    lines = [f"one letter of this line is {c} and the others are the same" for c in letters]
    lines += [f"this line is longer by {c} in some of its copies" for c in ["", *letters]]
    lines += ["".join(rng.choice("ab") for _ in range(rng.randrange(6, 10))) for _ in range(150)] + ["", "a", "b", "ab"]
    for _ in range(400):
        changed = list(passage)
        for _ in range(rng.randrange(1, 3)):
            changed[rng.randrange(12)] += rng.choice(["", "x", "y", "new"])
        lines.append(" ".join(changed))
    rng.shuffle(lines)
    counts, written = {}, line_dedup.written

    def counted(df, name):
        out = written(df, name)
        counts[name] = counts.get(name, 0) + out.count()
        return out

    monkeypatch.setattr(line_dedup, "written", counted)
    least = 20 if crowd == 64 else 0
    texts = ["\n".join(lines[i : i + 7]) for i in range(0, len(lines), 7)]
    got = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(table(spark, texts), min_chars=least).collect()}
    seen = []
    for i, t in enumerate(texts):
        kept = []
        for line in t.split("\n"):
            if len(line) < least or not any(one_edit(line, o) for o in seen):
                kept.append(line)
            if len(line) >= least:
                seen.append(line)
        assert got[i] == "\n".join(kept)
    if crowd == 64:
        assert counts["line-pairs"] < 3 * len(lines)  # 15491 pairs of these 795 lines share a half


@pytest.mark.parametrize("part", [4096, 2])
def test_suffix_dedup_equals_brute_force(spark, empty, part, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PART", part)
    rng = random.Random(7)
    passage = words(rng, 40)
    texts = [words(rng, 60, 5000) + (passage if i % 2 else "") + words(rng, 20, 5000) for i in range(12)]
    texts += [texts[3], "ab" * 200, "ab" * 90, None, "", "x" * 99, "x" * 99, texts[1][:150] + "é" + texts[1][150:]]
    spans = suffix_dedup.repeated_spans(table(spark, texts))
    kept = {r["doc"]: bytes(r["kept"]) for r in suffix_dedup.without_spans(table(spark, texts), spans).collect()}
    seen = set()
    for i, t in enumerate(texts):
        t = (t or "").encode()
        gone = bytearray(len(t))
        for j in range(len(t) - 99):
            if t[j : j + 100] in seen:
                gone[j : j + 100] = b"\1" * 100
            seen.add(t[j : j + 100])
        assert kept[i] == bytes(b for b, g in zip(t, gone) if not g), i
    assert suffix_dedup.repeated_spans(empty).count() == 0


def test_suffix_comparison_survives_hash_collisions():
    powers = suffix_dedup.Powers()
    powers.words[:] = 1  # every byte hashes alike
    data = np.frombuffer(b"a" * 100 + b"b" * 100 + b"a" * 100, np.uint8)
    got = suffix_dedup.Suffixes(data, powers).repeats(np.array([0, 100, 200]), np.zeros(3, np.int64))
    assert got.tolist() == [False, False, True]


@pytest.mark.parametrize("block", [2048, 4])
def test_ngram_join_equals_all_pairs(spark, empty, block, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    rng = random.Random(11)
    texts = [words(rng, rng.choice([1, 3, 8, 30, 120]), 3000) for _ in range(25)]
    for i in range(20):
        t = texts[i % 7 + 10].split()
        t[rng.randrange(len(t))] = f"new{i}"
        texts.append(" ".join(t).upper())
    texts += [None, "", " \t\n", texts[0], texts[0]]

    def shingled(t):
        w = (t or "").encode().lower().split()
        return {tuple(w[i : i + 4]) for i in range(max(1, len(w) - 3))} if w else set()

    sets = [shingled(t) for t in texts]
    root = list(range(len(texts)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 85 * len(a | sets[j]):
                old, new = max(root[i], root[j]), min(root[i], root[j])
                root = [new if r == old else r for r in root]
    got = {r["doc_id"]: r for r in ngram_join.near_duplicates(table(spark, texts, repeat=[2])).collect()}
    assert [(got[i]["n_shingles"], got[i]["component_id"]) for i in range(len(texts))] == [(len(s), r) for s, r in zip(sets, root)]
    assert ngram_join.near_duplicates(empty).count() == 0


def test_ngram_join_keeps_the_links_of_rows_that_share_an_id_or_have_none(spark):
    rng = random.Random(3)
    base, other = words(rng, 60, 3000), words(rng, 60, 3000)
    near, bridge = base + " tail1", base + " tail1 tail2"
    schema = "doc_id long, text string"
    plain = [(5, base), (9, near), (9, other), (11, words(rng, 60, 3000))]
    for rows in (plain, plain[::-1]):
        got = {(r["doc_id"], r["n_shingles"]): (r["component_id"], r["stands"]) for r in ngram_join.near_duplicates(spark.createDataFrame(rows, schema).coalesce(1)).collect()}
        assert got == {(5, 57): (5, True), (9, 58): (5, False), (9, 57): (9, True), (11, 57): (11, True)}
    nameless = [(None, bridge), (5, base), (None, other), (None, other), (7, ""), (None, None)]
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"], r["stands"]) for r in ngram_join.near_duplicates(spark.createDataFrame(nameless, schema)).collect()), key=str)
    assert got == sorted([(None, 59, 5, False), (5, 57, 5, True), (None, 57, None, True), (None, 57, None, True), (7, 0, 7, True), (None, 0, None, True)], key=str)


def test_ngram_join_deals_a_large_cluster_in_waves_and_leaves_no_texts_behind(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 4)
    rng, made, write = random.Random(7), [], ngram_join.written
    base = words(rng, 200, 3000).split()
    texts = [" ".join(base[:i] + [f"new{i}"] + base[i + 1 :]) for i in range(40)] + [words(rng, 200, 3000) for _ in range(5)]

    def kept(df, name):
        out = write(df, name)
        made.append((name, out, out.count()))
        return out

    monkeypatch.setattr(ngram_join, "written", kept)
    got = [(r["doc_id"], r["component_id"]) for r in ngram_join.near_duplicates(table(spark, texts, repeat=[3] * 30)).collect()]
    assert sorted(set(got)) == [(i, 0 if i < 40 else i) for i in range(45)] and len(got) == 75
    rows = {name: n for name, _, n in made}
    assert 40 <= rows["shingle-texts"] <= 40 + 5  # a repeated row comes once from a task
    assert sum(name == "shingle-links" for name, _, _ in made) >= 10  # ten blocks: no shuffle has every pair of blocks
    left = [name for name, out, _ in made if os.path.exists(out.scratch.removeprefix("file:"))]
    assert "shingle-sets" in left and not {"shingle-texts", "shingle-candidates", "shingle-members", "shingle-links"} & set(left)


def test_written_tables_leave_no_shuffle_files(spark):
    def shuffled():
        spark_dirs = [d.toString() for d in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
        return sum(f.startswith("shuffle_") for top in spark_dirs for _, _, names in os.walk(top) for f in names)

    before = shuffled()
    out = common.written(spark.range(1000).repartition(3, "id"), "shuffled")
    end = time.time() + 20
    while shuffled() > before and time.time() < end:
        time.sleep(0.2)
    assert shuffled() <= before and out.count() == 1000
    common.dropped(out)
    assert not os.path.exists(out.scratch.removeprefix("file:"))


def test_rtree_finds_every_point_that_passes():
    rng = np.random.default_rng(0)
    points = rng.poisson(5, (300, 8))
    tree = ngram_join.Tree(points)
    for p in points[:20]:
        want = np.flatnonzero(185 * np.minimum(p, points).sum(1) >= 85 * (p.sum() + points.sum(1)))
        assert sorted(tree.order[tree.search(p, 85)].tolist()) == want.tolist()


def test_toxicity_finds_label_words_and_search_is_exact(spark, empty):
    rng = random.Random(5)
    texts = [words(rng, 40) + (" vileword vileword nastyterm" if i % 6 == 0 else "") for i in range(240)] + [None, ""]
    docs = table(spark, texts)
    labels = spark.createDataFrame([(i, int(i % 6 == 0)) for i in range(0, 240, 2)] + [(1, None), (None, 1), (9999, 1)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    got = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    assert all((got[i] >= 0.3) == (i % 6 == 0) for i in range(240)) and got[240] == got[241] < 0.3
    vectors = np.zeros((len(model.labels), len(model.numbers)))
    for t, (_, _, examples, weights) in model.postings.items():
        vectors[examples, t] = weights
    query = {0: 0.6, 1: 0.8}
    near, numbers = model.nearest(query)
    scores = vectors[:, 0] * 0.6 + vectors[:, 1] * 0.8
    want = np.lexsort((np.arange(len(scores)), -scores))[: len(near)]
    assert np.allclose(near, scores[want])
    nothing = toxicity.fit(empty, labels)
    assert toxicity.score(empty, nothing).count() == 0


def test_warc_round_trip(spark, scratch):
    big, small = "<p>" + "é" * 600, "<p>x"
    rows = [(1, "u1", big), (2, "u2", big), (3, "u3", big + "!"), (4, None, small), (5, "u5", small), (6, "u6", None), (None, "u7", big), (8, "a\r\nb", "WARC/1.1\r\n\r\n" + big)]
    pages = spark.createDataFrame([(*r, "extra", 0) for r in rows], "page_id long, url string, html string, digest string, offset int")
    index = warc.write_archives(pages, f"{scratch}/warc")
    got = {r["page_id"]: r for r in warc.read_records(index).collect()}
    for page, _, html in rows:
        payload = (html or "").encode()
        r = got[page]
        assert (r["payload_bytes"], r["payload_digest"]) == (len(payload), hashlib.sha1(payload).hexdigest())
        assert (r["record_type"], r["refers_to"]) == (("revisit", 2) if page in (1, None) else ("response", None))
        assert page in (1, None) or bytes(r["payload"]) == payload
    assert [r["page_id"] for r in warc.read_records(index.filter("page_id = 5")).collect()] == [5]
    assert warc.read_records(warc.write_archives(pages.limit(0), f"{scratch}/none")).count() == 0


def test_warc_memory(spark, scratch, monkeypatch):
    pages = spark.createDataFrame([(i, f"u{i}", f"<p>{i // 2}" * 200_000) for i in range(60)], "page_id long, url string, html string").coalesce(1)
    want = {(i, "response" if i % 2 else "revisit", None if i % 2 else i + 1, len(f"<p>{i // 2}") * 200_000) for i in range(60)}
    tasks, mapped = [], warc.mapped

    def kept(df, run, schema):
        tasks.append((df, run))
        return mapped(df, run, schema)

    monkeypatch.setattr(warc, "mapped", kept)
    for few in (0, 100_000):
        monkeypatch.setattr(warc, "SHARED_ROWS", few, raising=False)
        index = warc.write_archives(pages, f"{scratch}/warc{few}")
        out = warc.read_records(index)
        assert {(r["page_id"], r["record_type"], r["refers_to"], r["payload_bytes"]) for r in out.drop("payload").collect()} == want
        assert out.filter("record_type = 'response' AND sha1(payload) = payload_digest").count() == 30
    # records that are small in the archive and large when unpacked come in batches of a few MB
    rows, run = tasks[-1]
    batches = list(run(iter(rows.toArrow().to_batches())))
    assert sum(b.num_rows for b in batches) == 60 and max(b.nbytes for b in batches) < warc.RANGE_BYTES + (1 << 20)
    # few shared digests: the pages are neither shuffled nor sorted
    plan = tasks[-2][0]._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_fingerprints_and_next(spark, empty):
    texts = ["a.\nb.\nc.", "c.\nb.\na.", "a.\nb.", None, "", "one long paragraph. It has parts! Really? yes"]
    df = table(spark, texts).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    w = {r["doc_id"]: r["words"] for r in fingerprints.with_words(df, "text", "words").collect()}
    assert w[0] == w[1] != w[2] and w[3] == w[4]
    c = fingerprints.with_words(spark.createDataFrame([(9, "c.")], "doc_id long, text string"), "text", "words").first()["words"]
    both = spark.createDataFrame([(w[0], c, w[2])], "a array<long>, c array<long>, b array<long>")
    assert both.select(fingerprints.subtract(F.col("a"), F.col("c")) == F.col("b"), fingerprints.add(F.col("b"), F.col("c")) == F.col("a")).first() == (True, True)
    near = fingerprints.with_likeness(both, "a", {"self": "a", "part": "b"}).first()
    assert near["self"] == 1.0 and 0.4 < near["part"] <= 1.0
    ids = spark.createDataFrame([(None, "n"), (5, "a"), (900, "b"), (901, "c"), (10_000, "d")], "doc_id long, text string")
    got = {r["text"]: r["next_text"] for r in fingerprints.with_next(ids, "doc_id", ["text"], per_group=2).collect()}
    assert got == {"n": "a", "a": "b", "b": "c", "c": "d", "d": "n"}
    assert fingerprints.with_next(empty.select("doc_id", "text"), "doc_id", ["text"]).count() == 0


def test_fingerprint_cosines_are_near_the_exact_ones(spark):
    rng = random.Random(9)
    lines = [[f"line {rng.randrange(10**9)}" for _ in range(20)] for _ in range(200)]
    rows = [("\n".join(a), "\n".join(b[:10] + a[:10])) for a, b in zip(lines, lines[1:])]
    df = fingerprints.with_words(fingerprints.with_words(spark.createDataFrame(rows, "a string, b string"), "a", "x"), "b", "y")
    near = [r["near"] for r in fingerprints.with_likeness(df, "x", {"near": "y"}).collect()]
    assert np.sqrt(np.mean((np.array(near) - 0.5) ** 2)) < 0.065


def test_mixing_meets_its_budgets(spark, empty):
    rng = random.Random(2)
    rows = [(i, rng.randrange(1, 50), "big" if i % 3 else ("mid" if i % 2 else None), 0.5) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, tokens long, source string, weight double")
    totals = df.groupBy(F.coalesce("source", F.lit("")).alias("source")).agg(F.sum("tokens").alias("tokens"))
    plan = {r["source"]: r for r in mixing.source_weights(totals, max_repeats=2.0).collect()}
    assert abs(sum(r["weight"] for r in plan.values()) - 1) < 1e-9
    passes = {s: r["source_budget"] / r["tokens"] for s, r in plan.items()}
    assert min(passes.values()) == pytest.approx(1) and max(passes.values()) <= 2.01
    out = mixing.mix(df, "doc_id", tokens=F.col("tokens"), max_repeats=2.0).select("doc_id", F.coalesce("source", F.lit("")).alias("source"), "turn", "n_tokens").collect()
    for s, r in plan.items():
        taken = sum(x["n_tokens"] for x in out if x["source"] == s)
        assert r["source_budget"] - 50 < taken <= r["source_budget"]
    assert len({(x["doc_id"], x["turn"]) for x in out}) == len(out) and {x["doc_id"] for x in out} == set(range(600))
    even = mixing.source_weights(totals, target_entropy=1.09).collect()
    assert -sum(r["weight"] * np.log(r["weight"]) for r in even) == pytest.approx(1.09, abs=1e-6)
    assert mixing.mix(empty, "doc_id", max_repeats=2.0).count() == 0


def test_ann_recall_ties_and_rows_that_take_no_part(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, 16)).astype("float32")
    x[100:140] = x[100]
    rows = [(i, v.tolist(), "z") for i, v in enumerate(x)]
    rows += [(700, None, ""), (720, [0.0] * 16, ""), (740, [float("nan")] * 16, ""), (760, [None] + [1.0] * 15, ""), (780, [1.0], ""), (None, [1.0] * 16, ""), (5, x[5].tolist(), "")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank string")
    got = ann.nearest(df, F.col("vec_id") % 20 == 0).collect()
    found = {}
    for r in sorted(got, key=lambda r: (r["query_id"], r["rank"])):
        found.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert set(found) == set(range(0, 600, 20))
    hits = 0
    for q, near in found.items():
        s = x.astype(float) @ x[q].astype(float)
        s[q] = -np.inf
        hits += len(set(np.lexsort((np.arange(600), -s))[:20]) & {i for i, _ in near})
        assert all(abs(s[i] - v) < 1e-9 for i, v in near) and len(near) == 20
    assert hits >= 0.9 * 20 * len(found)
    assert [i for i, _ in found[100]] == list(range(101, 121))
    assert ann.nearest(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_ann_gives_k_or_all_of_a_small_table(spark):
    x = np.random.default_rng(3).normal(size=(31, 64))
    for n in (12, 31):
        df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x[:n])], "vec_id long, embedding array<double>")
        got = ann.nearest(df, F.col("vec_id") < 5).collect()
        for q in range(5):
            s = x[:n] @ x[q]
            s[q] = -np.inf
            found = [r["vec_id"] for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == q]
            assert len(found) == min(20, n - 1) and (n > 21 or found == np.argsort(-s)[: n - 1].tolist())


def test_ann_recall_on_the_small_given_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [r for r in df.collect() if r["embedding"] is not None]
    ids, x = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], float)
    got, hits, n = ann.nearest(df, F.col("vec_id") % 20 == 0).collect(), 0, 0
    for q in ids[ids % 20 == 0]:
        s = x @ x[ids == q][0]
        s[ids == q] = -np.inf
        hits += len({r["vec_id"] for r in got if r["query_id"] == q} & set(ids[np.lexsort((ids, -s))[:20]].tolist()))
        n += 20
    assert hits >= 0.92 * n


def test_toxicity_keeps_terms_of_a_rare_kind_but_not_of_a_copied_text(spark):
    rng = random.Random(8)
    copied = words(rng, 60, 5000) + " copyword"
    texts = [words(rng, 40) + " vileword" for _ in range(400)] + [words(rng, 40) + " rareword" for _ in range(7)]
    texts += [f"{copied} tail{i}" for i in range(30)] + [words(rng, 40) for _ in range(2400)]
    labels = spark.createDataFrame([(i, int(i < 437)) for i in range(len(texts))], "doc_id long, toxic int")
    numbers = toxicity.fit(table(spark, texts), labels).numbers
    assert {"vileword", "rareword"} <= set(numbers) and "copyword" not in numbers


def test_connected_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 90), (100, 90)], "a long, b long")
    got = dict(common.connected_components(edges).collect())
    assert got == {**{i: 0 for i in range(41)}, 90: 90, 100: 90}
