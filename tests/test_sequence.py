"""The hot-key chunked path gives exactly the plain window's lag / rolling mean / lead."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from fjord.operators import gold, prefix, sequence
from fjord.operators.sequence import sequential_features
from fjord.sources.tables import txn
from tests.conftest import SF_SMALL


def _rows(df, cols):
    return sorted((tuple(None if r[c] is None else round(r[c], 9) if isinstance(r[c], float) else r[c]
                         for c in cols) for r in df.collect()), key=str)


def test_hot_key_chunks_match_window(spark):
    # key "hot" holds ~70% of rows, with tied timestamps broken by id
    rows = [(i, "hot" if i % 10 < 7 else f"k{i % 5}", i // 3, float((i * 37) % 101)) for i in range(2000)]
    df = spark.createDataFrame(rows, "id long, k string, t long, v double")
    got = sequential_features(df, "k", ["t", "id"], "v", "lag", "roll", "lead", span=6,
                              heavy_threshold=100, chunk_rows=50)
    w = Window.partitionBy("k").orderBy("t", "id")
    ref = df.select("*", F.lag("v").over(w).alias("lag"), F.avg("v").over(w.rowsBetween(-6, 0)).alias("roll"),
                    F.lead("v").over(w).alias("lead"))
    cols = ["id", "k", "lag", "roll", "lead"]
    assert _rows(got, cols) == _rows(ref, cols)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["hot", "hot", "hot", "k", None]), st.sampled_from([None, 1, 2, 3]),
                          st.sampled_from([1.0, 2.0, 3.0, 5.0])), min_size=1, max_size=120),
       st.sampled_from([7, 10, 25]))
def test_tied_and_null_order_keys(spark, rows, chunk):
    df = spark.createDataFrame([(k, t, v) for k, t, v in rows], "k string, t long, v double")
    got = sequential_features(df, "k", ["t"], "v", "lag", "roll", "lead", span=6, heavy_threshold=12, chunk_rows=chunk)
    w = Window.partitionBy("k").orderBy("t", "v")  # rows that still tie are interchangeable
    ref = df.select("*", F.lag("v").over(w).alias("lag"), F.avg("v").over(w.rowsBetween(-6, 0)).alias("roll"),
                    F.lead("v").over(w).alias("lead"))
    cols = ["k", "t", "v", "lag", "roll", "lead"]
    assert sorted(map(str, _rows(got, cols))) == sorted(map(str, _rows(ref, cols)))


def test_equal_rows_meet_in_no_task(spark):
    """A key of which nine in ten rows agree in everything that orders them, half of those in everything."""
    rows = [(i if i % 2 else -1, "hot", 5 if i % 10 else i, 2.0 if i % 10 else float(i)) for i in range(4000)]
    df = spark.createDataFrame(rows, "id long, k string, t long, v double")
    placed = sequence.positions(df, "k", ["t", "v"])
    assert sorted(r["__pos"] for r in placed.collect()) == list(range(4000))
    ordered = [(r["t"], r["v"]) for r in placed.orderBy("__pos").collect()]
    assert ordered == sorted(ordered)
    counted = df.groupBy(*df.columns).count()
    salt = F.pmod(F.xxhash64(*df.columns), F.lit(prefix.bucket_count(df)))
    assert counted.groupBy("k", "t", "v", salt).count().agg(F.max("count")).first()[0] < 4000 / 10
    plan = placed._jdf.queryExecution().executedPlan().toString()
    windows = [x for x in plan.splitlines() if "Window [sum(__n" in x]
    assert windows and all("__salt" in x or "__bucket" in x for x in windows)
    got = sequential_features(df, "k", ["t"], "v", "lag", "roll", "lead", heavy_threshold=100, chunk_rows=50)
    w = Window.partitionBy("k").orderBy("t", "v")
    ref = df.select("*", F.lag("v").over(w).alias("lag"), F.avg("v").over(w.rowsBetween(-6, 0)).alias("roll"), F.lead("v").over(w).alias("lead"))
    cols = ["k", "t", "v", "lag", "roll", "lead"]
    assert sorted(map(str, _rows(got, cols))) == sorted(map(str, _rows(ref, cols)))


def test_ml_features_with_forced_split(spark):
    t = txn(spark, SF_SMALL)
    a = gold.account_features(t, heavy_threshold=5, chunk_rows=8)  # every account is "heavy"
    b = gold.account_features(t)
    cols = ["tr_id", "prev_amount", "rolling_avg_amount_7"]
    assert _rows(a, cols) == _rows(b, cols)
