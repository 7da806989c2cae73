"""Bucketed ranks equal SQL window ranks (ties, NULLs, tiny groups, a hot group)."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from fjord.operators import features, prefix
from fjord.operators.prefix import group_rank


def _check(spark, rows, buckets):
    df = spark.createDataFrame(rows, "id int, g string, v double")
    got = group_rank(df, ["g"], [("v", True)],
                     {"r_desc": "rank_reverse", "pr": "percent_rank", "r": "rank"}, buckets=buckets)
    w = Window.partitionBy("g")
    ref = df.select("id",
                    F.rank().over(w.orderBy(F.col("v").desc())).alias("r_desc"),
                    F.percent_rank().over(w.orderBy("v")).alias("pr"),
                    F.rank().over(w.orderBy("v")).alias("r"))
    a = sorted((r["id"], r["r_desc"], round(r["pr"], 9), r["r"]) for r in got.collect())
    b = sorted((r["id"], r["r_desc"], round(r["pr"], 9), r["r"]) for r in ref.collect())
    assert a == b


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]),
                          st.one_of(st.none(), st.sampled_from([1.0, 2.0, 2.0, 3.5, -1.0, 7.0]))),
                min_size=1, max_size=40),
       st.sampled_from([1, 2, 4, 16]))
def test_group_rank_equals_window(spark, rows, buckets):
    _check(spark, [(i, g, v) for i, (g, v) in enumerate(rows)], buckets)


def test_hot_group_and_global_rank(spark):
    # one group holds most rows and one value repeats a third of the time
    rows = [(i, "hot" if i % 10 else "cold", float(i % 3 == 0 and 5 or i % 97)) for i in range(3000)]
    _check(spark, rows, 8)
    df = spark.createDataFrame(rows, "id int, g string, v double")
    got = group_rank(df, [], [("v", False), ("id", True)], {"r": "rank"}, buckets=8)
    ref = df.select("id", F.rank().over(Window.orderBy(F.col("v").desc(), "id")).alias("r"))
    assert sorted(map(tuple, got.select("id", "r").collect())) == sorted(map(tuple, ref.collect()))


def test_many_buckets_and_plan(spark):
    # more buckets than one coarse step, and the plan that is really used
    rows = [(i, "g%d" % (i % 3), float(i * 37 % 1009)) for i in range(3000)]
    _check(spark, rows, 300)
    df = spark.createDataFrame(rows, "id int, g string, v double")
    plan = group_rank(df, ["g"], [("v", True)], {"r": "rank"})._jdf.queryExecution().executedPlan().toString()
    ranked = [line for line in plan.splitlines() if "Window [sum" in line and "specifiedwindowframe(RowFrame" in line]
    assert any("__bucket" in line for line in ranked)  # every window over rows runs per (group, bucket)
    # what meets in one partition are partial counts, one row per task
    lines = plan.splitlines()
    assert all("HashAggregate" in lines[i + 1] and "partial_count" in lines[i + 1]
               for i, line in enumerate(lines) if "Exchange SinglePartition" in line)


def test_split_points_are_dealt_by_size(spark):
    """The split table is bounded by the ranges asked for, not by groups times ranges, and a hot group gets its share."""
    rows = spark.range(40_000).select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 2000).alias("g"),
                                      F.xxhash64("id").cast("double").alias("v"), F.lit(1).alias("n"))
    points = {r["g"]: r["__splits"] for r in prefix.split_points(rows, ["g"], F.col("v"), ["v"], ["n"], 100).collect()}
    assert set(points) == {-1} and 20 <= len(points[-1]) <= 50  # a third of the rows; the other groups have 13 or so each
    two = prefix.split_points(rows.withColumn("g", F.col("v") > 0),
                              ["g"], F.col("v"), ["v"], ["n"], 100).collect()
    assert len(two) == 2 and 80 <= sum(len(r["__splits"]) for r in two) <= 120
    assert all(p == sorted(p) for p in points.values())
    got = prefix.group_rank(rows, ["g"], [("v", True)], {"r": "rank"}, buckets=100)
    ref = rows.select("g", "v", F.rank().over(Window.partitionBy("g").orderBy("v")).alias("r"))
    assert got.select("g", "v", "r").exceptAll(ref).count() == 0 and got.count() == 40_000


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from([0, 1, 1, 1, None]), st.one_of(st.none(), st.integers(0, 30))), min_size=1, max_size=60),
       st.sampled_from([0.2, 0.5, 0.01]))
def test_stratified_split_equals_the_rank(spark, rows, share):
    """Repeated and NULL keys, NULL classes: rows are the test set up to their rank by hash."""
    df = spark.createDataFrame(rows, "is_fraud int, tr_id int")
    got = features.stratified_split(df, test_size=share)
    u = features.hash_unit(F.col("tr_id"))
    w = Window.partitionBy("is_fraud")
    rank = F.rank().over(w.orderBy(u.asc_nulls_first(), F.col("tr_id").asc_nulls_first()))
    size = F.ceil(F.count(F.lit(1)).over(w) * F.lit(str(share)).cast("decimal(10,6)"))
    ref = df.withColumn("split", F.when(rank <= size, "test").otherwise("train"))
    key = lambda r: str(tuple(r))
    assert sorted(got.collect(), key=key) == sorted(ref.collect(), key=key)
