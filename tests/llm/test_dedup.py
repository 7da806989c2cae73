"""Exact and SimHash dedup against brute force."""

import hashlib
import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from fjord.llm import exactdup, simhash
from fjord.llm.common import BATCH, ship
from fjord.llm.components import components
from fjord.llm.queries import QUERIES
from tests.conftest import SF_SMALL

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def odd(spark):
    same = "same start of sixty-four characters, so that the prefix hash is no help at all: "
    rows = [(1, "Copy"), (5, "cOPY"), (3, "copy"), (7, "other"), (8, None), (9, ""), (10, "É"), (11, "é"), (12, same + "a"),
            (13, same + "b"), (14, same + "A"), (15, "twice"), (15, "twice"), (None, "no id"), (None, "no id"), (None, "copy"),
            (20, "long " * 50_000), (21, "LONG " * 50_000)]
    return spark.createDataFrame(rows, "doc_id long, text string").withColumns({"kept": F.lit("x"), "word": F.lit(1)})


def brute_exact(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault((t or "").translate(LOW), []).append(i)
    return {t: (max((i for i in g if i is not None), default=None), len(g)) for t, g in groups.items()}


def test_exact_groups(spark):
    docs = odd(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = brute_exact(rows)
    out = exactdup.exact_groups(docs.repartition(4), carry={"t": F.col("text")}).collect()
    assert len(out) == len(rows)
    for r in out:
        assert (r.keep_id, r.group_size) == want[(r.t or "").translate(LOW)]
        assert not r.kept or r.doc_id == r.keep_id
    kept = [(r.t or "").translate(LOW) for r in out if r.kept]
    assert sorted(kept) == sorted(want)  # one of each
    left = exactdup.drop_exact_copies(docs)
    assert left.columns == docs.columns
    assert sorted((r.text or "").translate(LOW) for r in left.collect()) == sorted(want)
    assert exactdup.exact_groups(docs.limit(0)).count() == 0


def test_exact_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    want, text = brute_exact(rows), dict(rows)
    for r in QUERIES["op8_exact_dedup"](spark, SF_SMALL).collect():
        low = text[r.doc_id].translate(LOW)
        assert (r.keep_id, r.group_size) == want[low] and r.kept == (r.doc_id == r.keep_id)
        assert r.text_sha256 == hashlib.sha256(low.encode()).hexdigest()


def brute_print(text, n=3):
    w = (text or "").encode().lower().split()
    shingles = [b" ".join(w[i:i + n]) for i in range(max(1, len(w) - n + 1))] if w else []
    hs = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hs) * 2 > len(hs)) if hs else 0


def brute_components(ids, prints, most=3):
    parent = list(range(len(ids)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a in range(len(ids)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= most:
                parent[find(a)] = find(b)
    least = {}
    for a, i in enumerate(ids):
        if i is not None:
            least[find(a)] = min(i, least.get(find(a), i))
    return [least.get(find(a)) for a in range(len(ids))]


def test_anchors_miss_no_pair():
    r = random.Random(1)
    rng = np.random.default_rng(1)
    for _ in range(1500):
        x = int(rng.integers(0, 2**64, dtype=np.uint64))
        y = x
        for b in r.sample(range(64), r.randint(0, 3)):
            y ^= 1 << b
        row, anchor = simhash.anchors(np.array([x, y], np.uint64))
        assert set(anchor[row == 0]) & set(anchor[row == 1])


def test_links_join_all_within_three_bits(spark):
    r = random.Random(2)
    prints = [r.getrandbits(64) for _ in range(150)]
    for _ in range(450):  # chains and dense groups around the first ones
        x = r.choice(prints[:40] + prints[-30:])
        for b in r.sample(range(64), r.randint(1, 4)):
            x ^= 1 << b
        prints.append(x)
    prints = sorted(set(prints))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(s,) for s in signed], "fp long").repartition(6)
    want = brute_components(list(range(len(prints))), prints)
    for cell_rows in (5000, 7):  # 7: every busy anchor is dealt over a grid
        got = {x.node: x.root for x in components(simhash.links(df, cell_rows=cell_rows)).collect()}
        roots = [got.get(s, s) for s in signed]
        assert len(set(zip(roots, want, strict=True))) == len(set(roots)) == len(set(want))


def test_an_anchor_may_fill_several_batches(spark):
    """2,731 fingerprints share all their anchors; only pairs that differ in bit 62 are within 3 bits."""
    code = [x for x in range(1 << 16) if all((x & c).bit_count() % 2 == 0 for c in (0xffff, 0xaaaa, 0xcccc, 0xf0f0, 0xff00))]
    prints = [0x2b5c_9d03_11e7 | c << 46 for c in code] + [0x2b5c_9d03_11e7 | c << 46 | 1 << 62 for c in code[::3]]
    assert len(code) == 2048 and min((code[0] ^ c).bit_count() for c in code[1:]) == 4
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(s,) for s in signed], "fp long").repartition(3)
    ship(spark)  # batches of 1,000 rows
    for cell_rows in (5000, 1500):
        got = {tuple(sorted((r.u, r.v))) for r in simhash.links(df, cell_rows=cell_rows).collect()}
        assert got == {tuple(sorted((signed[3 * i], s))) for i, s in enumerate(signed[2048:])}
    none = simhash.forest(np.zeros(0, np.uint64), np.zeros(0, np.int64), 3)
    assert [len(x) for x in none] == [0, 0]


def test_near_copies_in_small_batches(spark):
    """Copies with a word changed meet at anchors that go on over many batches of two rows."""
    base = [f"word{i}" for i in range(400)]
    rows = [(i, " ".join([*base[:7 * i], f"other{i}", *base[7 * i + 1:]])) for i in range(40)] + [(50, "quite another text")]
    want = brute_components([i for i, _ in rows], [brute_print(t) for _, t in rows])
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    ship(spark)
    before = spark.conf.get(BATCH)
    spark.conf.set(BATCH, "2")
    try:
        got = {r.doc_id: r.component_id for r in simhash.near_groups(docs).collect()}
        left = sorted(r.doc_id for r in simhash.drop_near_copies(docs).collect())
    finally:
        spark.conf.set(BATCH, before)
    assert [got[i] for i, _ in rows] == want
    assert left == sorted(set(want)) and len(left) < 30


def test_near_groups(spark):
    base = " ".join(f"word{i}" for i in range(400))
    rows = [(4, base), (2, base + " tail"), (9, base.upper()), (5, None), (6, ""), (7, " \t\n"), (8, "one"), (11, "ONE"),
            (12, "two words"), (None, base), (None, "alone without id " * 3), (13, "a b c"), (13, "a b c"), (14, "\xa0"),
            (15, "é É x " * 40_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"fp": F.lit(1), "root": F.lit("x")})
    prints = [brute_print(t) for _, t in rows]
    want = sorted(zip([str(i) for i, _ in rows], prints, map(str, brute_components([i for i, _ in rows], prints)), strict=True))
    out = simhash.near_groups(docs.repartition(3)).collect()
    assert sorted((str(r.doc_id), r.fp % (1 << 64), str(r.component_id)) for r in out) == want
    left = simhash.drop_near_copies(docs)
    assert left.columns == docs.columns
    assert sorted(str(r.doc_id) for r in left.collect()) == sorted(set(c for *_, c in want if c != "None") | {"None"})
    assert simhash.near_groups(docs.limit(0)).count() == 0


def test_simhash_query(spark):
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect())
    prints = [brute_print(t) for _, t in rows]
    want = list(zip([i for i, _ in rows], [f"{p:016x}" for p in prints], brute_components([i for i, _ in rows], prints), strict=True))
    assert sorted(map(tuple, QUERIES["op10_simhash"](spark, SF_SMALL).collect())) == want


def test_columns_of_any_name_are_left_alone(spark):
    rows = [(1, "One text", 7), (2, "one TEXT", 8), (3, "another one entirely, with more words", 9), (3, "another one entirely, with more words", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, v int").withColumns(
        {c: F.col("v") + 1 for c in ("__x", "__i", "__n", "__h", "id", "key", "row", "fp", "a.b")})
    for drop, kept in ((exactdup.drop_exact_copies, [2, 3]), (simhash.drop_near_copies, [1, 3])):
        out = drop(docs)
        assert out.columns == docs.columns
        assert sorted(r["doc_id"] for r in out.collect()) == kept and all(r["__x"] == r["v"] + 1 for r in out.collect())
