"""Bronze file stream with schema memory / rescue (the four evolution scenarios) and silver replay."""

import csv
import json
import os
import random
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from fjord.operators import clean
from fjord.sources import csvrecords
from fjord.sources.tables import raw_txn
from fjord.streaming import bronze, silver
from tests.conftest import SF_SMALL

HINTS = {"Amount": "double", "TransactionDate": "timestamp"}


def _write(path, records):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as fh:
        for r in records:
            fh.write(json.dumps(r) + "\n")


def test_four_scenarios_and_rerun(spark, tmp_path):
    landing, table = str(tmp_path / "landing"), str(tmp_path / "bronze")
    memory, ckpt = str(tmp_path / "schema"), str(tmp_path / "ckpt")
    _write(f"{landing}/2025-03-04/a.jsonl", [
        {"TransactionID": "a-100", "TransactionDate": "2025-03-04T06:10:00", "Amount": 88.125},
        {"TransactionID": "a-102", "TransactionDate": "2025-03-04T12:30:00", "Amount": "n/a"},
        {"TransactionID": "a-103", "TransactionDate": "2025-03-04T16:20:00", "Channel": "kiosk"},
        {"TransactionID": "a-104", "TransactionDate": "2025-03-04T17:45:00",
         "Extra": {"score": "7", "seen": [1, 2]}},
    ])
    bronze.run_bronze(spark, landing, table, memory, ckpt, HINTS)
    rows = {r["TransactionID"]: r for r in bronze.read_bronze(spark, table).collect()}
    assert len(rows) == 4
    # type drift: typed column NULL, value kept in the rescue
    assert rows["a-102"]["Amount"] is None and json.loads(rows["a-102"]["_rescued_data"]) == {"Amount": "n/a"}
    # sparse optional attribute: NULL where absent
    assert rows["a-103"]["Channel"] == "kiosk" and rows["a-100"]["Channel"] is None
    # nested payload: kept as text in the rescue, not a column
    assert "Extra" not in rows["a-104"].asDict()
    assert json.loads(json.loads(rows["a-104"]["_rescued_data"])["Extra"])["score"] == "7"
    assert rows["a-100"]["_rescued_data"] is None and rows["a-100"]["Amount"] == 88.125
    assert rows["a-100"]["_source_file"].endswith("a.jsonl")
    assert rows["a-100"]["_environment"] == "test" and rows["a-100"]["_pipeline_version"] == "1.0"

    # additive column in a new file: memory grows, only the new file is read
    _write(f"{landing}/2025-03-05/b.jsonl", [
        {"TransactionID": "a-101", "TransactionDate": "2025-03-05T09:05:00", "Amount": 40.0, "DeviceID": "tab-3"}])
    schema = bronze.run_bronze(spark, landing, table, memory, ckpt, HINTS)
    assert "DeviceID" in schema.fieldNames()
    df = bronze.read_bronze(spark, table)
    assert df.count() == 5
    assert df.filter(F.col("DeviceID") == "tab-3").count() == 1
    assert df.filter(F.col("DeviceID").isNull()).count() == 4

    # run again with nothing new: nothing ingested
    bronze.run_bronze(spark, landing, table, memory, ckpt, HINTS)
    assert bronze.read_bronze(spark, table).count() == 5


def test_silver_stream_and_replay(spark, tmp_path):
    raw = raw_txn(spark, SF_SMALL).withColumn("_rescued_data", F.lit(None).cast("string")) \
        .withColumn("_ingestion_date", F.lit("2026-12-01").cast("date"))
    bronze_path = str(tmp_path / "bronze")
    raw.write.parquet(bronze_path)
    good, bad = str(tmp_path / "good"), str(tmp_path / "bad")
    silver.run_silver(spark, bronze_path, good, bad, str(tmp_path / "ckpt"))
    exp_good = clean.silver_good(raw, as_of="2026-12-01").count()
    exp_bad = clean.silver_quarantine(raw).count()
    assert silver.read_silver(spark, good).count() == exp_good
    assert silver.read_silver(spark, bad).count() == exp_bad
    # replay batch 0 with fewer rows: its directory is replaced, nothing stale survives
    silver.process_batch(raw.limit(10), 0, good, bad)
    assert silver.read_silver(spark, good).count() <= 10
    # a second batch id lands beside it
    silver.process_batch(raw, 1, good, bad)
    assert silver.read_silver(spark, good).filter("_batch_id = 1").count() == exp_good


def _write_csv(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as fh:
        fh.write("\n".join(lines) + "\n")


def test_csv_stream_binds_each_file_by_its_own_header(spark, tmp_path):
    landing, table, ckpt = str(tmp_path / "landing"), str(tmp_path / "bronze"), str(tmp_path / "ckpt")
    _write_csv(f"{landing}/d1/a.csv", ["TransactionID,Amount,TransactionDate",
                                       "tx-1,10.5,2025-01-01 07:00:00", "tx-2,bad,2025-01-01 08:00:00"])
    # drifted header: columns swapped and one added ("IP Address" is renamed on the way in)
    _write_csv(f"{landing}/d2/b.csv", ['TransactionDate,"IP Address",TransactionID,Amount',
                                       "2025-01-02 09:00:00,10.0.0.1,tx-3,7"])
    bronze.run_bronze_csv(spark, landing, table, ckpt, HINTS)
    rows = {r["TransactionID"]: r for r in bronze.read_bronze(spark, table).collect()}
    assert set(rows) == {"tx-1", "tx-2", "tx-3"}
    assert rows["tx-3"]["Amount"] == 7.0 and rows["tx-3"]["IP_Address"] == "10.0.0.1"
    assert str(rows["tx-3"]["TransactionDate"]).startswith("2025-01-02 09:00")
    assert rows["tx-1"]["IP_Address"] is None and rows["tx-1"]["Amount"] == 10.5
    assert rows["tx-2"]["Amount"] is None and json.loads(rows["tx-2"]["_rescued_data"]) == {"Amount": "bad"}
    assert rows["tx-3"]["_source_file"].endswith("b.csv")
    # a second run sees no new file; a new file is ingested alone
    bronze.run_bronze_csv(spark, landing, table, ckpt, HINTS)
    assert bronze.read_bronze(spark, table).count() == 3
    _write_csv(f"{landing}/d3/c.csv", ["Amount,TransactionID", "1.25,tx-4"])
    bronze.run_bronze_csv(spark, landing, table, ckpt, HINTS)
    rows = {r["TransactionID"]: r for r in bronze.read_bronze(spark, table).collect()}
    assert len(rows) == 4 and rows["tx-4"]["Amount"] == 1.25 and rows["tx-4"]["TransactionDate"] is None


def test_csv_bronze_feeds_silver(spark, tmp_path):
    from fjord.functions.constants import SCHEMA_HINTS

    landing, table = str(tmp_path / "landing"), str(tmp_path / "bronze")
    _write_csv(f"{landing}/d1/a.csv", ["TransactionID,AccountID,TransactionAmount,TransactionDate",
                                       "tx-1,ac-1,10.5,2025-01-01 07:00:00", "tx-2,ac-1,oops,2025-01-01 08:00:00"])
    _write_csv(f"{landing}/d2/b.csv", ["TransactionDate,TransactionAmount,AccountID,TransactionID",
                                       "2025-01-02 09:00:00,7,ac-2,tx-3"])
    bronze.run_bronze_csv(spark, landing, table, str(tmp_path / "ck_b"), SCHEMA_HINTS)
    good, bad = str(tmp_path / "good"), str(tmp_path / "bad")
    silver.run_silver(spark, table, good, bad, str(tmp_path / "ck_s"), as_of="2026-12-01")
    g = silver.read_silver(spark, good)
    assert sorted(r["TransactionID"] for r in g.collect()) == ["tx-1", "tx-3"]
    assert "_bronze_batch_id" in g.columns  # bronze lineage passes through; silver's own batch dirs stay distinct
    assert [r["TransactionID"] for r in silver.read_silver(spark, bad).collect()] == ["tx-2"]


def test_bronze_job_takes_a_csv_feed(spark, tmp_path):
    from fjord.config import Paths
    from fjord.functions.constants import SCHEMA_HINTS
    from fjord.plans import jobs

    paths = Paths(str(tmp_path / "lake"), "test")
    _write_csv(f"{paths.landing}/d1/a.csv", ["TransactionID,TransactionAmount", "tx-1,3.5"])
    jobs.run_bronze(spark, paths, SCHEMA_HINTS, fmt="csv")
    r = bronze.read_bronze(spark, paths.bronze).first()
    assert (r["TransactionID"], r["TransactionAmount"], r["_environment"]) == ("tx-1", 3.5, "test")


def test_csv_extra_and_missing_fields(spark, tmp_path):
    landing, table = str(tmp_path / "landing"), str(tmp_path / "bronze")
    _write_csv(f"{landing}/d1/a.csv", ["TransactionID,Amount", "r-1,5.25", "r-2,6.0,EXTRA,,more", "r-3", '"r-4, quoted",7',
                                       "r-5,8," + ",".join(f"x{i}" for i in range(40))])
    _write_csv(f"{landing}/d2/empty.csv", [""])
    bronze.run_bronze_csv(spark, landing, table, str(tmp_path / "ck"), HINTS, max_files_per_trigger=1)
    rows = {r["TransactionID"]: r for r in bronze.read_bronze(spark, table).collect()}
    assert set(rows) == {"r-1", "r-2", "r-3", "r-4, quoted", "r-5"}
    assert rows["r-1"]["_rescued_data"] is None and rows["r-3"]["_rescued_data"] is None and rows["r-3"]["Amount"] is None
    assert rows["r-2"]["Amount"] == 6.0 and json.loads(rows["r-2"]["_rescued_data"]) == {"_extra_1": "EXTRA", "_extra_3": "more"}
    kept = json.loads(rows["r-5"]["_rescued_data"])
    assert kept["_extra_32"] == "x31" and kept["_raw"].endswith(",x39")


def test_csv_header_after_blank_lines(spark, tmp_path):
    landing, table = str(tmp_path / "landing"), str(tmp_path / "bronze")
    _write_csv(f"{landing}/d1/a.csv", ["\ufeff", "  ", "\t", "TransactionID,Amount", "b-1,5.25", "", "b-2,6"])
    _write_csv(f"{landing}/d2/b.csv", ["Amount,TransactionID", "7,b-3"])
    # splits smaller than the run of blank lines
    _write_csv(f"{landing}/d3/c.csv", [*[" " * 50] * 200, "Amount,TransactionID", "8,b-4"])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1024")
    try:
        bronze.run_bronze_csv(spark, landing, table, str(tmp_path / "ck"), HINTS)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    rows = {r["TransactionID"]: r["Amount"] for r in bronze.read_bronze(spark, table).collect()}
    assert rows == {"b-1": 5.25, "b-2": 6.0, "b-3": 7.0, "b-4": 8.0}


def test_csv_with_too_many_headers_raises(spark, monkeypatch):
    monkeypatch.setattr(csvrecords, "MAX_FIELDS", 2)
    rows = [(line, f"f{i}", 0) for i in range(3) for line in (f"TransactionID,c{i}", f"h-{i},x")]
    lines = spark.createDataFrame(rows, "value string, _source_file string, _block long").coalesce(1)
    assert csvrecords.csv_by_header(lines.filter("_source_file <> 'f2'"), HINTS).count() == 2
    with pytest.raises(ValueError, match="distinct headers"):
        csvrecords.csv_by_header(lines, HINTS)


def test_json_batches_are_bounded(spark, tmp_path):
    landing, table, ckpt = str(tmp_path / "landing"), str(tmp_path / "bronze"), str(tmp_path / "ckpt")
    for i in range(5):
        _write(f"{landing}/f{i}.jsonl", [{"TransactionID": f"b-{i}", "Amount": i}])
    bronze.run_bronze(spark, landing, table, str(tmp_path / "schema"), ckpt, HINTS, max_files_per_trigger=2)
    assert bronze.read_bronze(spark, table).count() == 5
    assert len([f for f in os.listdir(f"{ckpt}/commits") if f.isdigit()]) == 3


def _delivery(spark, rows):
    """Raw rows (id, account, amount, date) of one batch."""
    return spark.createDataFrame([(i, a, m, d, None) for i, a, m, d in rows],
                                 "TransactionID string, AccountID string, TransactionAmount string, TransactionDate string, _rescued_data string")


def test_repeats_across_batches(spark, tmp_path):
    good, bad = str(tmp_path / "good"), str(tmp_path / "bad")
    take = lambda rows, n: silver.process_batch(_delivery(spark, rows), n, good, bad, as_of="2026-12-01", across_batches=True)
    stored = lambda n: sorted((r["TransactionID"] or "", r["AccountID"], r["TransactionAmount"])
                              for r in silver.read_silver(spark, good).filter(F.col("_batch_id") == n).collect())
    take([("t1", "a", "1.0", "2024-01-01"), ("t1", "a", "2.0", "2024-01-01"), ("t2", "a", "3.0", "2024-01-02"),
          (None, "a", "4.0", "2024-01-01"), (None, "a", "5.0", "2024-01-01")], 0)
    assert stored(0) == [("", "a", 4.0), ("", "a", 5.0), ("t1", "a", 1.0), ("t2", "a", 3.0)]  # NULL ids are no repeats
    second = [("t1", "a", "1.0", "2024-01-01"), ("t2", "a", "9.0", "2024-03-05"), ("t1", "b", "6.0", "2024-01-01"),
              (None, "a", "4.0", "2024-01-01"), ("t3", "a", "7.0", "2024-01-09")]
    take(second, 1)
    want = [("", "a", 4.0), ("t1", "b", 6.0), ("t3", "a", 7.0)]  # t2 came on another day and is a repeat all the same
    assert stored(1) == want
    take([("t3", "a", "7.0", "2024-01-09"), ("t4", "a", "8.0", "2024-01-09")], 2)
    assert stored(2) == [("t4", "a", 8.0)]
    for _ in range(2):  # a replay meets the batches before it, not itself or later ones
        take(second, 1)
        assert stored(1) == want and stored(2) == [("t4", "a", 8.0)]
    take([], 3)
    take([("t4", "a", "8.0", "2024-01-09")], 4)
    assert stored(3) == [] and stored(4) == []


def test_repeats_are_found_in_batches_stored_without_filters(spark, tmp_path):
    good, bad = str(tmp_path / "good"), str(tmp_path / "bad")
    for n in (0, 1):
        silver.process_batch(_delivery(spark, [(f"t{n}", "a", "1.0", f"2024-01-0{n + 1}")]), n, good, bad, as_of="2026-12-01")
    rows = _delivery(spark, [("t0", "a", "1.0", "2024-01-01"), ("t1", "a", "1.0", "2024-01-02"), ("t9", "a", "1.0", "2024-01-02")])
    silver.process_batch(rows, 2, good, bad, as_of="2026-12-01", across_batches=True)
    assert [r["TransactionID"] for r in silver.read_silver(spark, good).filter("_batch_id = 2").collect()] == ["t9"]


def test_only_days_that_may_hold_a_key_are_read(spark, tmp_path):
    from fjord.operators import seen

    rows = spark.range(20_000).select(F.concat(F.lit("t"), "id").alias("TransactionID"), F.lit("a").alias("AccountID"),
                                      F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 100).cast("int")).alias("day"))
    path = str(tmp_path / "stored")
    rows.repartition("day").write.partitionBy("day").parquet(path)
    stored = spark.read.parquet(path)
    batch = spark.createDataFrame([("t5", "a"), ("t105", "a"), ("t6", "b"), ("new", "a"), (None, "a")], "TransactionID string, AccountID string")
    out = seen.unseen(batch, stored, seen.key_filter(rows), seen.key_filter(rows, ["day"]), ["day"])
    assert sorted((r[0] or "", r[1]) for r in out.collect()) == [("", "a"), ("new", "a"), ("t6", "b")]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan
    tiny = dict(words=4)  # a filter too small to tell anything apart: the same rows
    out = seen.unseen(batch, stored, seen.key_filter(rows, **tiny), seen.key_filter(rows, ["day"], **tiny), ["day"], **tiny)
    assert sorted((r[0] or "", r[1]) for r in out.collect()) == [("", "a"), ("new", "a"), ("t6", "b")]


def test_silver_stream_across_batches(spark, tmp_path):
    raw = raw_txn(spark, SF_SMALL).withColumn("_rescued_data", F.lit(None).cast("string"))
    bronze_path, good, bad = str(tmp_path / "bronze"), str(tmp_path / "good"), str(tmp_path / "bad")
    for half in (F.lit(True), F.col("CustomerAge") < "40"):  # the second delivery repeats a part of the first
        raw.filter(half).coalesce(1).write.mode("append").parquet(bronze_path)
        silver.run_silver(spark, bronze_path, good, bad, str(tmp_path / "ckpt"), as_of="2026-12-01", across_batches=True)
    known = silver.read_silver(spark, good).filter("TransactionID is not null and AccountID is not null")
    want = clean.silver_good(raw, as_of="2026-12-01").filter("TransactionID is not null and AccountID is not null").count()
    assert known.count() == known.select("TransactionID", "AccountID").distinct().count() == want


@contextmanager
def _splits(spark, size):
    """Input splits of so many bytes."""
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    try:
        yield
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def _lines(spark, path):
    return spark.read.option("recursiveFileLookup", "true").text(path).select(
        "value", F.col("_metadata.file_path").alias("_source_file"), F.col("_metadata.file_block_start").alias("_block"))


@pytest.mark.parametrize("size", [16, 64, 1 << 20])
def test_csv_records_equal_the_csv_module(spark, tmp_path, size):
    """Quoted breaks, quotes and commas, also across splits, as Python's csv module reads them."""
    r, want = random.Random(size), []
    for f in range(4):
        path = tmp_path / f"f{f}.csv"
        names = [["id", "a", "b"], ["b", "id", "a"], ["id", "a"], ["a", "id", "b c"]][f]
        with open(path, "w", encoding="utf-8", newline="") as fh:
            out = csv.writer(fh, lineterminator="\n")
            out.writerow(names)
            for i in range(60):
                row = {n: "".join(r.choice(["x", "yy", ",", '"', "\n", "\n\n", " ", "é"] if f != 2 else ["x", ",", " "]) for _ in range(r.randint(1, 9)))
                       for n in names} | {"id": f"{f}-{i}"}
                out.writerow([row[n] for n in names])
        with open(path, encoding="utf-8", newline="") as fh:
            want += [dict(x) for x in csv.DictReader(fh)]
    with _splits(spark, size):
        out = csvrecords.csv_by_header(_lines(spark, str(tmp_path)), HINTS)
        got = {x["id"]: x for x in out.collect()}
    assert len(got) == len(want) == 240
    for w in want:
        row = got[w["id"]].asDict()
        assert row["_rescued_data"] is None
        assert {k: (row[k] or "").strip() for k in w} == {k: v.strip() for k, v in w.items()}, w


@pytest.mark.parametrize("size", [16, 1 << 20])
def test_unclosed_quotes_are_rescued_whole(spark, tmp_path, size):
    files = {"good": ["id,a", '1,"two', 'lines"', "2,x"],
             "open": ["id,a", "3,x", '4,"never closed', "5,y", "6,z,extra", '7,"q,r"', "8"],
             "crossed": ["id,a", '9,"stray', '10,"two', 'lines"', "11,w"],
             "header": ['id,"a', "12,x"]}
    for name, lines in files.items():
        _write_csv(str(tmp_path / f"{name}.csv"), lines)
    with _splits(spark, size):
        rows = csvrecords.csv_by_header(_lines(spark, str(tmp_path)), HINTS).collect()
    found = {x["id"]: x["a"] for x in rows if x["id"] is not None}
    assert found == {"1": "two\nlines", "2": "x", "3": "x", "5": "y", "7": "q,r", "11": "w"}
    raw = sorted(json.loads(x["_rescued_data"])["_raw"] for x in rows if x["id"] is None)
    assert raw == sorted(['4,"never closed', "6,z,extra", "8", '9,"stray', '10,"two', 'lines"', "12,x"])


def test_a_record_that_never_ends_is_not_collected(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(csvrecords, "MAX_RECORD", 100)
    _write_csv(str(tmp_path / "a.csv"), ["id,a", "1,x", '2,"stray', *[f"{i},y" for i in range(3, 40)], '40,"stray', "41,z"])
    rows = csvrecords.csv_by_header(_lines(spark, str(tmp_path)), HINTS).collect()
    assert {int(x["id"]) for x in rows if x["id"] is not None} == {1, *range(3, 40), 41}
    assert sorted(json.loads(x["_rescued_data"])["_raw"] for x in rows if x["id"] is None) == ['2,"stray', '40,"stray']


def test_one_scan_whatever_the_number_of_headers(spark, tmp_path):
    scans = {}
    for n in (1, 6):
        for i in range(n):
            _write_csv(str(tmp_path / f"{n}" / f"{i}.csv"), [f"id,c{i}", f"{i},x"])
        out = csvrecords.csv_by_header(_lines(spark, str(tmp_path / f"{n}")), HINTS)
        assert out.count() == n
        plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        scans[n] = plan.count("FileScan text")
    assert scans == {1: 1, 6: 1}


def test_types_widen_over_runs(spark, tmp_path):
    """Whole numbers, then decimals, then text: every value stays as it came, old files are not touched."""
    for fmt in ("csv", "json"):
        landing, table, ckpt, mem = (str(tmp_path / fmt / x) for x in ("landing", "table", "ckpt", "memory"))
        kinds, seen_files = [], set()
        for i, values in enumerate((["7", "0"], ["2.50", "8"], ["n/a", "9", "007"])):
            if fmt == "csv":
                _write_csv(f"{landing}/{i}.csv", ["TransactionID,Qty,Zip,When,Amount", *[f"r{i}{j},{v},0{j},2024-01-0{i + 1},{j}.5" for j, v in enumerate(values)]])
                bronze.run_bronze_csv(spark, landing, table, ckpt, HINTS, memory=mem)
            else:
                _write(f"{landing}/{i}.jsonl", [{"TransactionID": f"r{i}{j}", "Qty": v, "Zip": f"0{j}", "When": f"2024-01-0{i + 1}", "Amount": j + .5}
                                                for j, v in enumerate(values)])
                bronze.run_bronze(spark, landing, table, mem, ckpt, HINTS)
            now = {os.path.join(d, f) for d, _, names in os.walk(table) for f in names if f.endswith(".parquet")}
            assert seen_files <= now
            seen_files = now
            typed = bronze.read_bronze(spark, table, mem)
            kinds.append(dict(typed.dtypes)["Qty"])
            assert dict(typed.dtypes)["Zip"] == "string" and dict(typed.dtypes)["When"] == "date" and dict(typed.dtypes)["Amount"] == "double"
        assert kinds == ["int", "double", "string"]
        got = sorted((r["TransactionID"], r["Qty"]) for r in typed.collect())
        assert got == [("r00", "7"), ("r01", "0"), ("r10", "2.50"), ("r11", "8"), ("r20", "n/a"), ("r21", "9"), ("r22", "007")]
        assert typed.filter("_rescued_data is not null").count() == 0


def test_type_sets(spark):
    from fjord.sources import inference

    cases = {"int": ["0", "-5", "2147483647"], "bigint": ["1", "2147483648", "-9223372036854775808"], "double": ["1", "2.5", "-0.125"],
             "boolean": ["true", "false"], "date": ["2024-02-29"], "timestamp": ["2024-02-29", "2024-01-01 10:00:00", "2024-01-01T10:00:00.5"],
             "string": ["1", "1234567890123456.5"], "void": [None]}
    cases |= {f"s{i}": [v] for i, v in enumerate(["", " 1", "+1", "01", "1.", ".5", "1e5", "NaN", "True", "2024-02-30", "2024-1-1", "9223372036854775808",
                                                "2024-01-01 25:00:00"])}
    for kind, values in cases.items():
        df = spark.createDataFrame([(v,) for v in values], "`a.b` string")
        got = inference.column_sets(df, ["a.b"]).select(inference.type_name(F.col("types"))).first()[0]
        assert got == (kind if not kind[1:].isdigit() else "string"), (kind, values, got)
