"""Retrieval: exact vector top-k against brute force, bounded plans, no all-pairs joins."""

import math
import os
import re
import shutil
import tracemalloc
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from fjord.operators import retrieve, textindex
from fjord.operators.kbest import KBest
from fjord.plans.queries import QUERIES
from tests.conftest import SF_SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _brute_force(vecs, queries, k, metric):
    out = set()
    for qid, q in queries:
        scored = []
        for vid, v in vecs:
            a, b = np.asarray(v, float), np.asarray(q, float)
            if metric == "l2":
                d = float(((a - b) ** 2).sum())
            else:
                d = -float(a @ b / (np.linalg.norm(a) * np.linalg.norm(b)))
            scored.append((d, vid))
        out |= {(qid, vid, r + 1) for r, (_, vid) in enumerate(sorted(scored)[:k])}
    return out


@pytest.mark.parametrize("metric", ["l2", "cosine"])
def test_nearest_vectors_equals_brute_force(spark, metric):
    rng = np.random.default_rng(7)
    base = rng.integers(-3, 4, size=(40, 5)).astype(float)
    # duplicated vectors: equal distances, ties broken by the lower id
    vecs = [(i, [float(x) for x in base[i % 25]]) for i in range(120)]
    queries = [(q, [float(x) for x in rng.integers(-3, 4, size=5)]) for q in range(7)]
    vdf = spark.createDataFrame(vecs, "vec_id long, embedding array<float>").repartition(6)
    qdf = spark.createDataFrame(queries, "query_id int, embedding array<float>")
    got = retrieve.nearest_vectors(vdf, qdf, k=4, metric=metric)
    rows = {(r["query_id"], r["vec_id"], r["rank"]) for r in got.collect()}
    assert rows == _brute_force(vecs, queries, 4, metric)


def test_nearest_vectors_chunked_equals_single_batch(spark):
    rng = np.random.default_rng(3)
    vecs = [(i, [float(x) for x in rng.normal(size=4)]) for i in range(200)]
    queries = [(q, [float(x) for x in rng.normal(size=4)]) for q in range(30)]
    vdf = spark.createDataFrame(vecs, "vec_id long, embedding array<float>")
    qdf = spark.createDataFrame(queries, "query_id int, embedding array<float>")
    one = {tuple(r) for r in retrieve.nearest_vectors(vdf, qdf, k=3).select("query_id", "vec_id", "rank").collect()}
    many = {tuple(r) for r in retrieve.nearest_vectors_chunked(vdf, qdf, k=3, chunk_rows=8)
            .select("query_id", "vec_id", "rank").collect()}
    assert one == many and len(one) == 90


def test_more_queries_than_one_batch(spark):
    vdf = spark.createDataFrame([(i, [float(i)]) for i in range(9)], "vec_id long, embedding array<float>")
    qdf = spark.createDataFrame([(i, [float(i)]) for i in range(5)], "query_id int, embedding array<float>")
    got = retrieve.nearest_vectors(vdf, qdf, k=1, max_queries=2).select("query_id", "vec_id").collect()
    assert sorted(map(tuple, got)) == [(i, i) for i in range(5)]


def test_near_equal_distances_rank_by_distance(spark):
    vdf = spark.createDataFrame([(1, [0.0009]), (2, [0.0005]), (3, [0.0]), (4, [0.0000001])], "vec_id long, embedding array<double>")
    qdf = spark.createDataFrame([(0, [0.0])], "query_id int, embedding array<double>")
    got = retrieve.nearest_vectors(vdf.repartition(4), qdf, k=3).orderBy("rank").collect()
    assert [r["vec_id"] for r in got] == [3, 4, 2]


def test_distances_do_not_depend_on_the_batch():
    rng = np.random.default_rng(5)
    v, q = rng.normal(1e4, 1, (50, 64)), rng.normal(1e4, 1, (1200, 64))
    assert (retrieve._distances(v, q, "l2")[:, :5] == retrieve._distances(v, q[:5], "l2")).all()


def test_equal_texts_score_equal_and_hot_terms_move_little(spark):
    rows = [(i, f"the stop word the {'common' if i % 2 else 'other'} word{i % 7} " + ("same text " if i % 3 == 0 else f"own{i} ") * 3)
            for i in range(300)] + [(1000, "the"), (1001, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    qs = spark.createDataFrame([(1, "the same word3"), (2, "the"), (3, "absent")], "question_id int, question string")
    got = retrieve.tfidf_top_k(docs, qs, k=4)
    plan = _plan(got)
    assert "WindowGroupLimit" in plan and "Partial" in plan
    first = sorted(map(tuple, got.collect()))
    assert first == sorted(map(tuple, retrieve.tfidf_top_k(docs.repartition(9), qs, k=4).collect()))  # to the last bit
    for question in (1, 2):
        by_score = {}
        for q, d, s, r in first:
            if q == question:
                by_score.setdefault(s, []).append((r, d))
        assert all([d for _, d in sorted(g)] == sorted(d for _, d in g) for g in by_score.values())


def test_top_k_is_limited_before_the_shuffle(spark):
    for name in ("vector_topk", "tfidf_topk"):
        plan = _plan(E.queries()[name](spark, SF_SMALL))
        assert "WindowGroupLimit" in plan and "Partial" in plan, name


def test_tokens_match_letter_digit_runs(spark):
    df = spark.createDataFrame([(1, "  Hello, wörld!! 42x__y "), (2, "ÉTÉ-été"), (3, "")], "doc_id long, text string")
    got = sorted((r["doc_id"], r["term"], r["tf"]) for r in retrieve.term_counts(df, "doc_id", "text").collect())
    assert got == [(1, "42x", 1), (1, "hello", 1), (1, "wörld", 1), (1, "y", 1), (2, "été", 2)]


def test_no_registered_query_plans_all_pairs(spark):
    """No Cartesian product or nested-loop join in any registered query."""
    bad = {}
    for name, fn in sorted(QUERIES.items()):
        plan = _plan(fn(spark, SF_SMALL))
        hits = [op for op in ("CartesianProduct", "BroadcastNestedLoopJoin") if op in plan]
        if hits:
            bad[name] = hits
    assert not bad, bad


def test_term_table_is_tokenised_once(spark, monkeypatch):
    """Building the index tokenises the documents once; asking it reads only what is stored."""
    tokenised, counted = [], textindex.term_counts
    monkeypatch.setattr(textindex, "term_counts", lambda d, *a: tokenised.append(d.columns) or counted(d, *a))
    df = E.queries()["tfidf_topk"](spark, SF_SMALL)
    df.collect()
    assert [("text" in c, "question" in c) for c in tokenised] == [(True, False), (False, True)]
    final = df._jdf.queryExecution().executedPlan().toString()
    final = final.split("== Initial Plan ==")[0]
    assert "Generate explode(split(lower(text" not in final and re.search(r"PartitionFilters: \[[^\]]*bucket#\d+ IN", final)


def test_text_rendering_survives_large_amounts(spark):
    """Amount sums past 10^12 render as text instead of overflowing a narrow decimal (ANSI)."""
    from fjord.functions.exprs import money_text

    df = spark.createDataFrame([(1, 123456789012345.678), (2, 2.5)], "k int, total double")
    doc = retrieve.rows_document(df, "big", ["k"]).first()["text"]
    assert '"total":1.2345678901234567E14' in doc and '"total":2.5}' in doc
    assert df.select(money_text(F.col("total")).alias("t")).first()["t"].startswith("123456789012345.6")


def test_profile_override_aggregates_once(spark):
    df = E.queries()["profile_override"](spark, SF_SMALL)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final and final.count("partial_count(1)") == 1


def test_top_k_above_the_group_limit_threshold_is_exact(spark):
    rows = [(g, i, float((i * 37) % 101)) for g in range(2) for i in range(400)]
    df = spark.createDataFrame(rows, "g int, i int, v double")
    order = [F.col("v").desc(), F.col("i").asc()]
    old = spark.conf.get("spark.sql.optimizer.windowGroupLimitThreshold")
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "5")
    try:
        got = {(r["g"], r["i"], r["rank"]) for r in retrieve.top_k_per_group(df, ["g"], order, 50, buckets=8).collect()}
    finally:
        spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", old)
    want = set()
    for g in range(2):
        ranked = sorted((r for r in rows if r[0] == g), key=lambda r: (-r[2], r[1]))[:50]
        want |= {(g, r[1], n + 1) for n, r in enumerate(ranked)}
    assert got == want


def _brute_tfidf(docs, questions, k):
    """Rows (question, doc, score to 9 digits, rank) by definition."""
    count = lambda t: Counter(re.findall(r"[^\W_]+", (t or "").lower()))
    tf, n = {}, len({d for d, _ in docs if d is not None})
    for d, t in docs:
        if d is not None:
            tf.setdefault(d, Counter()).update(count(t))
    df = Counter(t for c in tf.values() for t in c)
    idf = {t: math.log((n + 1) / (f + 1)) for t, f in df.items()}
    out = []
    for q, text in questions:
        qw = {t: c * idf[t] for t, c in sorted(count(text).items()) if t in idf}
        qn = math.sqrt(sum(w * w for w in qw.values()))
        scored = []
        for d, c in tf.items():
            shared = sorted(t for t in c if t in qw)
            if shared:
                dn = math.sqrt(sum((c[t] * idf[t]) ** 2 for t in sorted(c)))
                score = sum(c[t] * idf[t] * qw[t] for t in shared) / (qn * dn) if qn * dn else None
                scored.append((-1e-13 if score is None else -round(score, 12), d, score))
        out += [(q, d, None if s is None else round(s, 9), i + 1) for i, (_, d, s) in enumerate(sorted(scored, key=lambda x: x[:2])[:k])]
    return sorted(out)


def _found(df):
    return sorted((r[0], r[1], None if r[2] is None else round(r[2], 9), r[3]) for r in df.collect())


DOCS = [(i, f"the stop word the {'common' if i % 2 else 'other'} word{i % 7} " + ("same text " if i % 3 == 0 else f"own{i} ") * 3)
        for i in range(200)] + [(1000, "the"), (1001, None), (1002, ""), (None, "the lost one"), (1003, "the"), (1003, "twice here")]
ASKED = [(1, "the same word3"), (2, "the"), (3, "absent"), (4, "Own5 OWN5 common, twice?"), (5, None), (6, "")]


def test_index_equals_brute_force(spark, tmp_path):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string").repartition(5)
    qs = spark.createDataFrame(ASKED, "question_id int, question string")
    path = textindex.build(docs, str(tmp_path / "index"), buckets=16)
    want = _brute_tfidf(DOCS, ASKED, 4)
    assert _found(textindex.search(spark, path, qs, k=4)) == want
    assert _found(textindex.search(spark, path, qs, k=4, max_questions=1)) == want  # several parts
    assert textindex.search(spark, path, qs.filter("question_id in (3, 5, 6)"), k=4).count() == 0
    names = spark.createDataFrame([(str(d), t) for d, t in DOCS if d is not None], "id string, text string")
    by_name = textindex.build(names, str(tmp_path / "names"), doc_key="id", buckets=3)
    got = textindex.search(spark, by_name, qs, k=4, doc_key="id").filter("question_id = 4").collect()
    assert [r["id"] for r in sorted(got, key=lambda r: r["rank"])][:1] == ["5"]
    empty = textindex.build(docs.limit(0), str(tmp_path / "empty"), buckets=2)
    assert textindex.search(spark, empty, qs).count() == 0


def test_only_the_asked_partitions_are_read(spark, tmp_path):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    qs = spark.createDataFrame(ASKED[:1], "question_id int, question string")
    path = textindex.build(docs, str(tmp_path / "index"), buckets=32)
    want = _found(textindex.search(spark, path, qs, k=4))
    asked = {r[0] for r in spark.read.parquet(f"{path}/terms").filter("term in ('the', 'same', 'word3')").select("bucket").collect()}
    plan = _plan(textindex.search(spark, path, qs, k=4))
    assert re.search(r"PartitionFilters: \[[^\]]*bucket#\d+ IN", plan) and "PushedFilters: [In(term" in plan
    gone = 0
    for name in ("postings", "terms"):
        for d in os.listdir(f"{path}/{name}"):
            if d.startswith("bucket=") and int(d[7:]) not in asked:
                shutil.rmtree(f"{path}/{name}/{d}")  # files of this test only
                gone += 1
    assert gone > 40 and _found(textindex.search(spark, path, qs, k=4)) == want


def test_many_questions_share_a_stop_word(spark, tmp_path):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    path = textindex.build(docs, str(tmp_path / "index"), buckets=8)
    qs = spark.createDataFrame([(i, f"the word{i % 7}") for i in range(10_000)], "question_id int, question string")
    got = {}
    for q, d, s, r in _found(textindex.search(spark, path, qs, k=2)):
        got.setdefault(q, []).append((d, s, r))
    one = {}
    for q, d, s, r in _brute_tfidf(DOCS, [(i, f"the word{i}") for i in range(7)], 2):
        one.setdefault(q, []).append((d, s, r))
    assert len(got) == 10_000 and all(got[i] == one[i % 7] for i in got)


def test_k_best_memory_is_bounded():
    rng = np.random.default_rng(9)
    vectors, asked = rng.normal(size=(4000, 64)), rng.normal(size=(10_000, 64))

    class Sent:
        value = (np.arange(10_000), asked)

    run = retrieve._partition_top_k(Sent, 3, "vec_id", "embedding", ["vec_id"], "l2")
    batch = pd.DataFrame({"vec_id": np.arange(600), "embedding": list(vectors[:600])})
    tracemalloc.start()
    out = pd.concat(run(iter([batch, batch.assign(vec_id=batch["vec_id"] + 600)])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(out) == 30_000 and peak < 200 << 20
    q = out[out["__qid"] == 17].sort_values(["distance", "vec_id"])
    want = sorted((float(((asked[17] - v) ** 2).sum()), i) for i, v in enumerate(vectors[:600]))[:2]
    assert q["vec_id"].tolist()[:2] == [want[0][1], want[0][1] + 600]  # equal rows: the smaller id first


def test_k_best_over_tiles():
    rng = np.random.default_rng(10)
    keys = rng.integers(0, 5, size=(90, 7)).astype(float)
    keys[rng.random(keys.shape) < 0.2] = np.inf
    known = rng.random(keys.shape) < 0.8
    best = KBest(7, 4, "id")
    for at in range(0, 90, 13):
        part = slice(at, at + 13)
        best.add(keys[part], pd.DataFrame({"id": 1000 - np.arange(90)[part]}), known[part])
    for q in range(7):
        want = sorted((keys[i, q], 1000 - i) for i in range(90) if known[i, q])[:4]
        got = best.frame[best.frame["__q"] == q]
        assert list(zip(got["__key"], got["id"], strict=True)) == want


def test_index_shuffles_a_posting_once_to_its_bucket_and_once_to_its_document(spark, tmp_path, monkeypatch):
    """Terms are counted in the row, and only (document, square) goes to the document."""
    from pyspark.sql.readwriter import DataFrameWriter

    plans, write = {}, DataFrameWriter.parquet

    def noted(self, path, *a, **kw):
        plans[os.path.basename(path)] = self._df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
        return write(self, path, *a, **kw)

    monkeypatch.setattr(DataFrameWriter, "parquet", noted)
    docs = spark.createDataFrame([r for r in DOCS if r[0] not in (None, 1003)], "doc_id long, text string").repartition(3)
    textindex.build(docs.select("doc_id", "text"), str(tmp_path / "index"), buckets=8)
    before, after = plans["postings"].split("Generate", 1)
    assert before.count("Exchange") == 1 and "Aggregate" not in plans["postings"] and after.count("Exchange") <= 1  # the test's own
    assert re.search(r"Exchange hashpartitioning\(doc#\d+L?, \d+\), REPARTITION_BY_COL", plans["docs"])
    assert "collect_list(s#" in plans["docs"]


def test_terms_of_repeated_keys_are_counted_together(spark):
    rows = [(1, "b a  b!"), (2, "é É x"), (1, "a c"), (3, ""), (4, None), (5, "..."), (2, None), (6, "one")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    repeated = df.groupBy("doc_id").count().filter("count > 1").select("doc_id")
    want = [(1, "a", 2), (1, "b", 2), (1, "c", 1), (2, "x", 1), (2, "é", 2), (6, "one", 1)]
    assert sorted(tuple(r) for r in textindex.term_counts(df, "doc_id", "text", repeated).collect()) == want
    once = textindex.term_counts(df.filter("doc_id in (3, 4, 5, 6)"), "doc_id", "text", repeated.limit(0))
    assert [tuple(r) for r in once.collect()] == [(6, "one", 1)]


def test_index_joins_no_postings_with_terms_and_moves_blocks(spark, tmp_path, monkeypatch):
    """However large the term table is: frequencies are counted in the bucket, and a chunk's postings of a term are one row."""
    from pyspark.sql.readwriter import DataFrameWriter

    plans, write = {}, DataFrameWriter.parquet

    def noted(self, path, *a, **kw):
        plans[os.path.basename(path)] = self._df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
        return write(self, path, *a, **kw)

    monkeypatch.setattr(DataFrameWriter, "parquet", noted)
    docs = spark.createDataFrame([r for r in DOCS if r[0] not in (None, 1003)], "doc_id long, text string").coalesce(1)
    path = textindex.build(docs, str(tmp_path / "index"), buckets=8)
    assert not [name for name, plan in plans.items() if "Join" in plan]
    terms = spark.read.parquet(f"{path}/terms")
    assert spark.read.parquet(f"{path}/postings").count() == terms.count() < terms.agg(F.sum("df")).first()[0] / 2


@pytest.mark.parametrize(("postings", "size", "most"), [(7, 1 << 30, 1 << 15), (1 << 30, 100, 1 << 15), (1 << 30, 1 << 30, 2), (1, 1, 1)])
def test_chunks_hold_whole_documents(monkeypatch, postings, size, most):
    monkeypatch.setattr(textindex, "CHUNK_POSTINGS", postings)
    monkeypatch.setattr(textindex, "CHUNK_BYTES", size)
    monkeypatch.setattr(textindex, "CHUNK_DOCS", most)
    monkeypatch.setattr(textindex.TaskContext, "get", lambda: type("Task", (), {"partitionId": lambda self: 3})())
    rng = np.random.default_rng(2)
    rows = [(t % 3, f"t{t}", f"d{d}", int(rng.integers(1, 9))) for d in rng.permutation(20)
            for t in rng.choice(40, size=30 if d == 5 else int(rng.integers(1, 6)), replace=False).tolist()]
    table = pa.table(dict(zip(("bucket", "term", "doc", "tf"), map(list, zip(*rows, strict=True)), strict=True)))
    blocks = [r for b in textindex._blocks(iter(table.to_batches(4))) for r in b.to_pylist()]
    docs = {b["chunk"]: b["docs"] for b in blocks if b["docs"] is not None}
    assert sorted(sum(docs.values(), [])) == sorted({r[2] for r in rows}) and max(map(len, docs.values())) <= most
    assert sorted((b["bucket"], b["term"], docs[b["chunk"]][at], tf) for b in blocks for at, tf in zip(b["at"], b["tf"], strict=True)) == sorted(rows)
    assert len({(b["chunk"], b["term"]) for b in blocks}) == len(blocks) and {b["chunk"] >> 33 for b in blocks} == {3}
    idf = {f"t{t}": 0.1 + t / 7 for t in range(40)}
    for chunk, names in docs.items():
        of = pa.Table.from_pylist([{"chunk": chunk, "docs": b["docs"], "at": b["at"], "tf": b["tf"], "idf": idf[b["term"]]}
                                   for b in blocks if b["chunk"] == chunk])
        want = {d: sum(sorted((tf * idf[t]) ** 2 for _, t, e, tf in rows if e == d)) for d in names}
        got = textindex._chunk_squares(of).to_pylist()
        assert {r["doc"]: r["s"] for r in got} == pytest.approx(want, rel=1e-15) and [names[r["at"]] for r in got] == names


def test_an_index_of_an_older_layout_is_not_kept(spark, tmp_path):
    path = textindex.build(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), str(tmp_path / "index"), buckets=2, source="v1")
    assert textindex.is_of(spark, path, "v1") and not textindex.is_of(spark, path, "v2")
    old = str(tmp_path / "old")
    spark.createDataFrame([(1, 2, "bigint", "v1")], "n_docs long, buckets int, doc_type string, source string").write.parquet(f"{old}/stats")
    assert not textindex.is_of(spark, old, "v1")


def test_few_repeated_keys_shuffle_no_text(spark, monkeypatch):
    rows = [(i % 90, f"own{i} same") for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    repeated = df.groupBy("doc_id").count().filter("count > 1").select("doc_id")
    monkeypatch.setattr(textindex, "MAX_REPEATED", 10)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        few = textindex.term_counts(df, "doc_id", "text", repeated)
        assert "SortMergeJoin" not in _plan(few)
        monkeypatch.setattr(textindex, "MAX_REPEATED", 9)
        many = textindex.term_counts(df, "doc_id", "text", repeated)
        assert "SortMergeJoin" in _plan(many)
        assert sorted(map(tuple, few.collect())) == sorted(map(tuple, many.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
