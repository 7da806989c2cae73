"""SCD2 over the FIXTURES.md three-run sequence, both modes, plus upsert."""

from fjord.operators import merge

RUNS = [
    [("a", .1), ("b", .2)],
    [("a", .1), ("b", .5), ("c", None)],
    [("a", .1), ("c", .3), (None, .4)],
]
TS = ["2024-01-01 00:00:00", "2024-01-02 00:00:00", "2024-01-03 00:00:00"]
OPEN = "9999-12-31 00:00:00"


def _run(spark, mode):
    target = spark.createDataFrame([], merge.SCD2_SCHEMA)
    for rows, ts in zip(RUNS, TS):
        src = spark.createDataFrame(rows, "account_hash string, risk_score double")
        # materialise each run, as the job does with its versioned write
        target = spark.createDataFrame(merge.scd2_merge(target, src, ts, mode).collect(), merge.SCD2_SCHEMA)
    out = set()
    for r in target.collect():
        run_from = TS.index(str(r["valid_from"])) + 1
        run_to = "open" if str(r["valid_to"]) == OPEN else TS.index(str(r["valid_to"])) + 1
        out.add((r["account_hash"], r["risk_score"], run_from, run_to, r["is_current"]))
    return out


def test_single_pass(spark):
    assert _run(spark, "single") == {
        ("a", .1, 1, "open", True), ("b", .2, 1, 2, False), ("c", None, 2, "open", True),
        (None, .4, 3, "open", True)}


def test_complete(spark):
    got = _run(spark, "complete")
    assert got == {
        ("a", .1, 1, "open", True), ("b", .2, 1, 2, False), ("b", .5, 2, "open", True),
        ("c", None, 2, 3, False), ("c", .3, 3, "open", True), (None, .4, 3, "open", True)}
    # invariant: one current row per key
    keys = [k for k, _, _, _, cur in got if cur]
    assert len(keys) == len(set(keys))


def test_upsert(spark):
    old = spark.createDataFrame([(1, "x"), (2, "y")], "id int, text string")
    new = spark.createDataFrame([(2, "y2"), (3, "z")], "id int, text string")
    assert sorted(map(tuple, merge.upsert(old, new, "id").collect())) == [(1, "x"), (2, "y2"), (3, "z")]
