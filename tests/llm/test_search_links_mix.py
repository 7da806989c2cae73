"""Nearest neighbours, host verdicts and mixing against brute force."""

import hashlib
import math
import random
import re

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from fjord.llm import blockann, linkgraph, mixing
from fjord.llm.oracle import ORACLE
from fjord.llm.queries import QUERIES
from tests.conftest import SF_SMALL


def brute_nearest(rows, k, is_query):
    good = [(i, v) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = []
    for i, v in sorted(set((i, tuple(v)) for i, v in good if is_query(i))):
        found = []
        for j, w in good:
            if (j, tuple(w)) != (i, v) and len(w) == len(v):
                s = 0.0
                for a, b in zip(v, w, strict=True):
                    s += a * b
                found.append((-s, j))
        out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(sorted(found)[:k])]
    return sorted(out)


def test_nearest(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=8).astype(np.float32).tolist()) for i in range(300)]
    rows += [(300 + i, rows[i % 5][1]) for i in range(40)]  # ties
    rows += [(500, None), (501, []), (502, [0.0] * 8), (503, [1.0, None] + [0.0] * 6), (504, [float("nan")] * 8),
             (505, [float("inf")] + [1.0] * 7), (None, [1.0] * 8), (510, [1e30] * 8), (511, [1e-30] * 8), (520, [1.0, 2.0]),
             (521, [2.0, 1.0]), (530, [1.0] * 8), (530, [1.0] * 8), (540, [1.0] * 8), (540, [2.0] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({"key": F.lit(1), "cell": F.lit("x")})
    rows = [(r.vec_id, r.embedding) for r in df.collect()]  # as 32-bit numbers
    want = brute_nearest(rows, 7, lambda i: i % 10 == 0)
    for blocks, stripes in ((65_536, 4_000_000), (9, 50)):  # the second: many cells
        got = blockann.search(df.repartition(5), F.col("vec_id") % 10 == 0, k=7, query_rows=blocks, stripe_rows=stripes)
        assert sorted(map(tuple, got.collect())) == want
    assert blockann.search(df.limit(0), F.col("vec_id") % 10 == 0).count() == 0


def test_nearest_query(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()]
    assert sorted(map(tuple, QUERIES["op6_nearest"](spark, SF_SMALL).collect())) == brute_nearest(rows, 20, lambda i: i % 20 == 0)


RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def brute_judge(pages):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    judged, edges, count = [], {}, {}
    for i, url, html in pages:
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        host = re.match("[^/?#]*", rest)[0].translate(low)
        path = re.match("[^/?#]*([^?#]*)", rest)[1]
        fit = [(len(h + p), v, h + p) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fit) if fit else (0, None, None)
        judged.append((i, host, path, best[2], best[1]))
        if host:
            c = count.setdefault(host, [0, 0, 0])
            c[0] += 1
            c[1] += best[1] == "allow"
            c[2] += best[1] == "block"
            for d in {m[1].translate(low) for m in re.finditer(r"""(?i)<a\s[^>]*?href\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s<>]+)""", html or "")}:
                if d != host:
                    edges[host, d] = edges.get((host, d), 0) + 1
    hosts = {*count, *(h for e in edges for h in e)}
    scores = []
    for k in (1, 2):
        seed = {h: 0.15 * c[k] / c[0] for h, c in count.items()}
        walk = edges if k == 1 else {(b, a): n for (a, b), n in edges.items()}
        out = {}
        for (a, _), n in walk.items():
            out[a] = out.get(a, 0) + n
        r = dict(seed)
        for _ in range(160):
            r = {h: seed.get(h, 0) + 0.85 * sum(r.get(a, 0) * n / out[a] for (a, b), n in walk.items() if b == h) for h in hosts}
        scores.append(r)
    result = []
    for i, host, path, rule, verdict in judged:
        t, d = (s.get(host, 0.0) for s in scores)
        result.append((i, host, path, rule, verdict or ("block" if d >= 0.01 and d > 0.75 * (t + d) else "allow"), t, d))
    return result


def test_verdicts_with_links(spark):
    r = random.Random(3)
    hosts = ["a.example.org", "EXAMPLE.org", "x.com", "shop.x.com", "bad.com", "n1.net", "n2.net", "n3.net", "n4.net", "org"]
    pages = []
    for i in range(400):
        h = r.choice(hosts)
        path = r.choice(["", "/", "/fr/1", "/de/2", "/es/", "/en/12", "/en/2", "/x?y=/de/", "#/fr/"])
        if h == "bad.com":
            path = "/de/9"
        to = {"n1.net": ["bad.com"], "n2.net": ["n1.net", "bad.com"], "n3.net": ["org", "n4.net"]}.get(h, hosts)
        html = "".join(f'<p><A class=x HREF = "{s}//{r.choice(to)}/p">z</a>' for s in r.choices(["http:", "", "ftp:"], k=r.randint(0, 3)))
        pages.append((i, f"http{r.choice(['', 's'])}://{h}{path}", html + '<a href="/local">'))
    pages += [(900, None, "<a href='http://org/'>"), (901, "no scheme", None), (902, "http://", None), (903, "x://y://z", "<a>"),
              (None, "http://org/", None), (904, "http://org/", "t"), (904, "http://org/", "t")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumns({"host": F.lit(1), "v": F.lit("x")})
    want = brute_judge(pages)
    got = linkgraph.judge(df.repartition(4)).collect()
    key = lambda x: tuple(str(c) for c in x[:5])
    assert sorted(map(key, got)) == sorted(map(key, want))
    scores = {(x[1]): x[5:] for x in want}
    for x in got:
        assert (x.trust, x.distrust) == pytest.approx(scores[x.host], abs=1e-6)
    db = duckdb.connect()  # the SQL settles alike
    db.register("pages", pd.DataFrame(pages, columns=["page_id", "url", "html"]).astype({"page_id": "Int64"}))
    told = db.sql(ORACLE["op4_url_verdicts"]).fetchall()
    assert sorted(map(key, told)) == sorted(map(key, want)) and any(x[5] > 0.2 for x in told)
    for x in told:
        assert x[5:] == pytest.approx(scores[x[1]], abs=1e-6)
    assert linkgraph.judge(df.limit(0)).count() == 0


def test_distrust_runs_against_links_and_trust_along(spark):
    page = lambda i, host, path, *to: (i, f"http://{host}{path}", "".join(f"<a href='http://{t}/'>" for t in to))
    pages = [page(1, "bad.com", "/de/1"), page(2, "farm.net", "/", "bad.com"), page(3, "farm2.net", "/", "farm.net"),
             page(4, "fine.org", "/", "friend.net"), page(5, "friend.net", "/x"), page(6, "lone.net", "/")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r.page_id: (r.rule, r.verdict) for r in linkgraph.judge(df).collect()}
    assert got == {1: ("com/de/", "block"), 2: (None, "block"), 3: (None, "block"), 4: ("org/", "allow"),
                   5: (None, "allow"), 6: (None, "allow")}


def test_query_follows_links_to_the_end(spark, tmp_path, monkeypatch):
    """Distrust reaches the start of a chain of 25 hosts before 30 blocked ones."""
    page = lambda i, host, path, *to: (i, f"http://{host}{path}", "".join(f"<a href='http://{t}/'>" for t in to))
    bad = [f"bad{i}.com" for i in range(30)]
    pages = [page(100 + i, h, "/de/1") for i, h in enumerate(bad)]
    pages += [page(i, f"a{i}.net", "/", *([f"a{i + 1}.net"] if i < 25 else bad)) for i in range(1, 26)]
    pages += [page(200, "r1.com", "/de/1", "r2.net"), page(201, "r2.net", "/", "r1.com")]  # a ring never comes to rest
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = {r.page_id: r for r in QUERIES["op4_url_verdicts"](spark, str(tmp_path)).collect()}
    for i in range(1, 26):
        assert got[i].verdict == "block" and got[i].distrust == pytest.approx(30 * 0.15 * 0.85 ** (26 - i), abs=1e-6)
    assert got[200].distrust == pytest.approx(0.15 / (1 - 0.85**2), abs=1e-6)
    monkeypatch.setattr(linkgraph, "MOST_ROUNDS", 3)
    with pytest.raises(RuntimeError, match="not settled after 3 rounds"):
        QUERIES["op4_url_verdicts"](spark, str(tmp_path))


def test_verdict_query(spark):
    pages = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()]
    got = QUERIES["op4_url_verdicts"](spark, SF_SMALL).collect()
    assert sorted(tuple(x)[:5] for x in got) == sorted(tuple(x)[:5] for x in brute_judge(pages)) or \
        sorted(map(str, (tuple(x)[:5] for x in got))) == sorted(str(x[:5]) for x in brute_judge(pages))


def solve(total):
    """The number m with total(m) = 0, for a total that grows with m."""
    lo, hi = 0.0, 1.0
    while total(hi) < 0 and hi < 1e30:
        hi *= 2
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if total(mid) < 0 else (lo, mid)
    return lo


def brute_mix(rows, fraction, temper=0.7, seed="mix", rounds=300):
    """(documents (id, cell, tokens, weight, p, taken), targets {kind: {value: (tokens to take, out of reach)}}) by bisection."""
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    texts, df, size = [], {}, {}
    for i, text, source, lang in rows:
        source, lang = source if source is not None else "(none)", lang if lang is not None else "(none)"
        terms = re.findall("[a-z]{4,}", (text or "").translate(low))
        size[lang] = size.get(lang, 0) + 1
        for w in set(terms):
            df[lang, w] = df.get((lang, w), 0) + 1
        texts.append((i, text or "", source, lang, terms))
    keywords = {lang: sorted((-f, w) for (x, w), f in df.items() if x == lang and 100 * f >= n and 5 * f <= n)[:4] for lang, n in size.items()}
    cells, docs = {}, []
    for i, text, source, lang, terms in texts:
        n = len(re.findall(r"[^ \t\n\r]+", text))
        used = [(-terms.count(w), -f, w) for f, w in keywords[lang] if w in terms]
        cell = (source, lang, "empty" if n == 0 else min(used)[2] if used else "other")
        key = str(i) if i is not None else hashlib.md5(text.encode()).hexdigest()
        u = int(hashlib.md5(f"{key}:{seed}".encode()).hexdigest()[:13], 16) / 2**52
        cells[cell] = cells.get(cell, 0) + n
        docs.append((i, cell, n, u))
    kinds = [lambda c: c[0], lambda c: c[1], lambda c: c[1:]]
    have = [{} for _ in kinds]
    for c, n in cells.items():
        for d, k in enumerate(kinds):
            have[d][k(c)] = have[d].get(k(c), 0) + n

    def fill(values, total):
        share = {v: n**temper if n else 0.0 for v, n in values.items()}
        m = solve(lambda m: sum(min(values[v], m * share[v]) for v in values) - total)
        return {v: (min(float(values[v]), m * share[v]), 0 < values[v] <= m * share[v] * (1 + 1e-12)) for v in values}

    budget = fraction * sum(cells.values())
    goals = [fill(have[0], budget), fill(have[1], budget), {}]
    for lang in have[1]:
        goals[2] |= fill({v: n for v, n in have[2].items() if v[0] == lang}, goals[1][lang][0])
    y = {c: float(n) * fraction for c, n in cells.items()}
    whole = {c for c in cells if any(goals[d][k(c)][1] for d, k in enumerate(kinds))}
    x = lambda c, m=1.0: cells[c] if c in whole else min(cells[c], m * y[c])
    for _ in range(rounds):
        worst = 0.0
        for d, k in enumerate(kinds):
            for v, (goal, _) in goals[d].items():
                mine = [c for c in cells if k(c) == v and c not in whole]
                fixed = sum(cells[c] for c in cells if k(c) == v and c in whole)
                now = fixed + sum(x(c) for c in mine)
                worst = max(worst, abs(now - goal) / goal if goal else 0)
                m = solve(lambda m, mine=mine, fixed=fixed, goal=goal: fixed + sum(x(c, m) for c in mine) - goal) if mine and goal else 1.0
                for c in mine:
                    y[c] *= min(m, 1e6)
        if worst < 1e-12:
            break
    p = {c: 1.0 if n == 0 else min(1.0, x(c) / n) for c, n in cells.items()}
    return [(i, c, n, p[c] / fraction if n or cells[c] else 1.0, p[c], u < p[c]) for i, c, n, u in docs], goals


def mixed_rows():
    r, rows = random.Random(4), []
    words = {"en": ["apple", "berry", "cherry", "damson"], "de": ["apfel", "beere", "kirsche"], None: ["nil"]}
    for i in range(900):
        source = "hot" if r.random() < 0.5 else r.choice(["a", "b", "c", None])
        lang = r.choice(["en", "en", "de", None])
        n = r.choice([0, 5, 100, 500])
        rows.append((i, " ".join(["w"] * n + ([r.choice(words[lang]).title()] if n and r.random() < 0.5 else [])), source, lang))
    return rows + [(None, "no id", "a", "en"), (None, None, "a", "de"), (1700, "twice", "b", "en"), (1700, "twice", "b", "en")]


def test_mixing(spark):
    rows = mixed_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string").withColumns(
        {c: F.lit(1) for c in ("n", "w", "topic", "__topic", "__x", "doc", "u", "p")})
    want, goals = brute_mix(rows, 0.5)
    got = mixing.mix(df.repartition(5), fraction=0.5).collect()
    key = lambda x: (str(x[0]), x[1], x[2])
    got = sorted([(g.doc.doc_id, (g.source, g.lang, g.topic), g.tokens, g.weight, g.p, g.selected) for g in got], key=key)
    for g, x in zip(got, sorted(want, key=key), strict=True):
        assert key(g) == key(x) and g[3:5] == pytest.approx(x[3:5], rel=1e-6, abs=1e-9) and g[5] == x[5]
    assert len({g[1][2] for g in got}) > 6
    total = sum(g[2] for g in got)
    assert sum(g[2] * g[4] for g in got) == pytest.approx(0.5 * total)
    kept = mixing.sample(df, fraction=0.5)
    assert kept.columns == df.columns and kept.count() == sum(x[5] for x in want)
    assert mixing.mix(df.limit(0)).count() == 0
    only = mixing.mix(df, targets={"lang": {"de": 1.0}}, fraction=0.1).collect()
    assert all(g.p == 0 for g in only if g.lang != "de" and g.tokens)


def test_op9_stages_no_text(spark, monkeypatch):
    """Described rows hold the asked columns only, so no text goes through the writer of the staged table."""
    staged, stage = [], mixing.stage
    monkeypatch.setattr(mixing, "stage", lambda df: staged.append(df.schema) or stage(df))
    out = QUERIES["op9_mixing"](spark, SF_SMALL)
    held = [s["doc"].dataType.names for s in staged if "doc" in s.names]
    assert held == [["doc_id"]] and out.count() > 0


def test_the_sample_meets_its_targets(spark):
    """Expected shares of every source, language and topic, to 1e-6, or named as out of reach."""
    rows = mixed_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    for fraction in (0.5, 0.8):
        want, goals = brute_mix(rows, fraction)
        told = {(r.dim, (r.lang, r.value) if r.lang else r.value): r for r in mixing.plan(df, fraction).collect()}
        budget = fraction * sum(x[2] for x in want)
        for d, kind in enumerate(mixing.DIMS):
            for v, (goal, full) in goals[d].items():
                r = told[kind, v]
                expected = sum(x[2] * x[4] for x in want if (x[1][1:] if d == 2 else x[1][d]) == v) / budget
                assert r.reached == pytest.approx(r.target, abs=1e-6) and r.reached == pytest.approx(expected, abs=1e-6)
                assert r.target == pytest.approx(goal / budget, abs=1e-6) and r.full == full
                assert r.full or r.target >= r.wanted - 1e-9 or d == 2
        assert fraction < 0.8 or any(r.full for r in told.values())


def test_many_cells_are_raked_alike(spark):
    r = random.Random(8)
    rows = [(s, x, t, r.randint(1, 500)) for s in "abcde" for x in ("en", "de") for t in ("p", "q", "other") if r.random() < 0.9]
    cells = spark.createDataFrame(rows, "source string, lang string, topic string, n long")
    wanted = mixing.goals(cells, 0.6)
    one, many = (sorted((*x[:3], round(x.x, 6)) for x in mixing.rake(cells, wanted, 0.6, tolerance=1e-9, cells_per_task=k).collect())
                 for k in (1000, 5))
    assert one == many


def test_raking_tells_of_targets_it_cannot_meet(spark, caplog):
    cells = spark.createDataFrame([("a", "en", "note", 5), ("b", "de", "note", 5)], "source string, lang string, topic string, n long")
    run = lambda source, lang: mixing.rake(cells, mixing.goals(cells, 0.5, {
        "source": source, "lang": lang, "topic": {"note": 1.0}}), 0.5).collect()
    assert sorted((r.source, round(r.x, 9)) for r in run({"a": 0.9, "b": 0.1}, {"en": 0.9, "de": 0.1})) == [("a", 4.5), ("b", 0.5)]
    assert not caplog.records
    run({"a": 0.9, "b": 0.1}, {"en": 0.1, "de": 0.9})
    assert [r.name for r in caplog.records if "off its target" in r.message] == ["fjord.llm.mixing"]


def test_mixing_query(spark):
    rows = [(r.doc_id, r.text, r.source, r.lang) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    want = {x[0]: x for x in brute_mix(rows, 0.7)[0]}
    for g in QUERIES["op9_mixing"](spark, SF_SMALL).collect():
        _, cell, n, weight, p, taken = want[g.doc_id]
        assert (g.source, g.lang, g.topic, g.tokens, g.selected) == (*cell, n, taken)
        assert (g.weight, g.probability) == pytest.approx((weight, p), abs=2e-6)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle(spark, name):
    db = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "labels"):
        db.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    want = db.sql(ORACLE[name])
    got = QUERIES[name](spark, SF_SMALL).select(*want.columns)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want.fetchall()))
