"""Classifiers: held-out accuracy on the given tables, defined results on odd ones."""

import math
import tracemalloc
import zlib

import numpy as np
import pandas as pd
import pytest
import xxhash
import zstandard
from pyspark.sql import functions as F

from fjord.llm import quality, toxicity
from fjord.llm.queries import QUERIES
from tests.conftest import SF_MID, SF_SMALL

LARGER = "/root/testdata/sf0.1"


def crc(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


@pytest.mark.parametrize("query,label,threshold,least", [("op1_quality", "quality", 0.3, 0.95), ("op7_toxicity", "toxic", 0.5, 0.95)])
def test_held_out_accuracy(spark, query, label, threshold, least):
    labels = {r.doc_id: r[label] for r in spark.read.parquet(f"{LARGER}/labels.parquet").collect()}
    out = QUERIES[query](spark, LARGER).collect()
    assert len(out) == spark.read.parquet(f"{LARGER}/documents.parquet").count()
    assert all(r.held_out == crc(r.doc_id) and 0 <= r.score <= 1 and r.predicted == (r.score >= threshold) for r in out)
    judged = [(r.predicted, labels[r.doc_id]) for r in out if r.held_out and labels.get(r.doc_id) is not None]
    assert np.mean([p == y for p, y in judged]) >= least
    for y in (0, 1):
        assert np.mean([p == y for p, z in judged if z == y]) >= 0.8  # some labels there contradict their texts


def odd(spark):
    rows = [(1, None), (2, ""), (3, "plain words " * 5), (None, "no id"), (None, None), (4, "twice"), (4, "twice"), (5, "x " * 300_000)]
    return spark.createDataFrame(rows, "doc_id long, text string").withColumns({"score": F.lit("x"), "y": F.lit(1), "o": F.lit(2)})


@pytest.mark.parametrize("module,label", [(quality, "quality"), (toxicity, "toxic")])
def test_odd_tables(spark, module, label):
    docs = odd(spark)
    labels = spark.createDataFrame([(1, 1, 0), (3, 0, 1), (3, None, None), (99, 1, 1), (None, 1, 1), (4, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    for known in (labels, labels.limit(0), labels.filter("quality = 1")):
        model = module.train(docs, known)
        out = module.score(docs, model).collect()
        assert len(out) == 8 and all(0 <= r.score <= 1 for r in out)
        assert len({r.score for r in out if r.doc_id == 4}) == 1
        assert all(r.held_out for r in out if r.doc_id is None)
        assert module.score(docs.limit(0), model).count() == 0
    model = module.train(docs.limit(0), labels)
    assert module.score(docs, model).count() == 8


def test_keep_good_leaves_columns_alone(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").withColumns({"n": F.lit(None).cast("long"), "s": F.array(F.lit(1))})
    model = quality.train(docs, spark.read.parquet(f"{SF_MID}/labels.parquet"))
    kept = quality.keep_good(docs, model)
    good = {r.doc_id for r in quality.score(docs, model).filter("predicted = 1").collect()}
    assert kept.schema == docs.schema
    rows = kept.collect()
    assert {r.doc_id for r in rows} == good and all(r.n is None and r.s == [1] for r in rows)


def test_kernel_tolerates_gaps_and_inserted_characters():
    k = toxicity.kernel(["stupid"], ["stupid", "stuxpid", "st.upid", "garden", "the"])[0]
    assert k[0] == pytest.approx(1) and min(k[1:3]) > 0.4 > 0.1 > max(k[3:])
    # against the definition: weighted subsequences of three that span at most five
    a, b = "^abca$", "^abda$"

    def expand(w):
        out = {}
        for i in range(len(w)):
            for j in range(i + 1, len(w)):
                for m in range(j + 1, min(len(w), i + 5)):
                    out[w[i] + w[j] + w[m]] = out.get(w[i] + w[j] + w[m], 0) + toxicity.DECAY ** (m - i - 2)
        return out

    x, y = expand(a), expand(b)
    norm = lambda w: np.sqrt(sum(toxicity.DECAY ** (2 * (m - i - 2)) for i in range(len(w)) for j in range(i + 1, len(w))
                                 for m in range(j + 1, min(len(w), i + 5))))
    assert toxicity.kernel(["abca"], ["abda"])[0, 0] == pytest.approx(sum(x[s] * y.get(s, 0) for s in x) / norm(a) / norm(b))


def test_spaced_and_altered_insults_are_caught(spark):
    insults = ["grobble", "snarfle", "wibbley"]
    rng = np.random.default_rng(1)
    vocabulary = ["".join(rng.choice(list("aeioulnrst"), 6)) for _ in range(400)]
    rows, marks = [], []
    for i in range(900):
        words = list(rng.choice(vocabulary, 20))
        if i % 5 == 0:
            words[int(rng.integers(20))] = insults[i // 5 % 3]
        rows.append((i, " ".join(words)))
        marks.append((i, int(i % 5 == 0)))
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(marks, "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    clean = " ".join(vocabulary[:10])
    tests = [clean, f"{clean} grobble", f"{clean} grob.ble", f"{clean} s n a r f l e", f"{clean} w-i-b-b-l-e-y", f"{clean} snarxfle"]
    out = toxicity.score(spark.createDataFrame(list(enumerate(tests)), "doc_id long, text string"), model).orderBy("doc_id").collect()
    assert [r.predicted for r in out] == [0, 1, 1, 1, 1, 1]


def test_only_copies_are_learnt_from_once(spark):
    """A word that every text holds does not make the texts copies; copies with a few words changed are."""
    rng = np.random.default_rng(2)
    vocabulary = ["".join(rng.choice(list("aeioulnrst"), 6)) for _ in range(400)]
    least = min((f"q{i}" for i in range(100_000)), key=lambda w: xxhash.xxh64_intdigest(w) >> 1)
    texts = [" ".join([least, *rng.choice(vocabulary, 40)]) for _ in range(600)]
    texts = [t + " grobble" if i % 5 == 0 else t for i, t in enumerate(texts)]
    marks = [int(i % 5 == 0) for i in range(600)]
    rows = pd.DataFrame({"o": range(603), "y": [*marks, 0, 0, 1], "signature": [
        toxicity.signature(t).tobytes() for t in [*texts, texts[1].replace(" ", ". ").upper(), texts[2] + " more", texts[3]]]})
    assert sorted(toxicity.one_of_each(rows.sample(frac=1, random_state=1))["o"]) == [*range(600), 602]  # 602 has another label
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model = toxicity.train(docs, spark.createDataFrame(list(enumerate(marks)), "doc_id long, toxic int"))
    tests = spark.createDataFrame([(0, texts[1]), (1, texts[1] + " grobble")], "doc_id long, text string")
    assert [r.predicted for r in toxicity.score(tests, model).orderBy("doc_id").collect()] == [0, 1]


def test_quality_scores_by_definition(spark):
    """Scores of whole texts from the fitted model's dictionaries and weights, with zstandard alone."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    model = quality.train(docs, spark.read.parquet(f"{SF_SMALL}/labels.parquet"))
    made = {}
    for name, d in (("good", model.good), ("bad", model.bad), ("plain", b"")):
        known = {"dict_data": zstandard.ZstdCompressionDict(d)} if d else {}
        if d:
            known["dict_data"].precompute_compress(level=quality.LEVEL)
        made[name] = zstandard.ZstdCompressor(level=quality.LEVEL, **known)
    size = lambda name, data: len(made[name].compress(data))
    got = {r.doc_id: r for r in quality.score(docs, model).collect()}
    for r in docs.collect():
        raw = (r.text or "").encode()
        good, bad, n = size("good", raw), size("bad", raw), len(raw) + 1
        count = max(1, round(len(raw) / quality.WINDOW))
        step = max(1, math.ceil(len(raw) / count))
        pieces = [raw[i:i + step] for i in range(0, len(raw), step)] or [b""]
        gain = [(size("bad", p) - size("good", p)) / (len(p) + 1) for p in pieces]
        own = [size("good", p) / (len(p) + 1) for p in pieces]
        f = [(bad - good) / n, (bad - good) / (bad + good), size("plain", raw) / n, math.log(n), min(gain), sum(gain) / len(gain), sum(own) / len(own)]
        z = sum((x - c) / s * w for x, c, s, w in zip(f, model.centre, model.spread, model.weights[:-1], strict=True)) + model.weights[-1]
        assert got[r.doc_id].score == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-9)
        assert got[r.doc_id].predicted == int(got[r.doc_id].score >= 0.3)


def plain_margin(model, word):
    """The margin of a word, subsequence by subsequence."""
    chars, mask = [ord(c) for c in "^" + toxicity.EDGE.sub("", word) + "$"], (1 << 64) - 1
    total = squares = 0.0
    for a in range(len(chars)):
        for i, j in toxicity.STEPS:
            if a + j < len(chars):
                code = (chars[a] * 0x9E3779B97F4A7C15 & mask) ^ (chars[a + i] * 0xC2B2AE3D27D4EB4F & mask)
                code = ((code ^ code >> 29) * 0xBF58476D1CE4E5B9 & mask) ^ (chars[a + j] * 0x165667B19E3779F9 & mask)
                code = (code ^ code >> 32) * 0x94D049BB133111EB & mask
                w = toxicity.DECAY ** (j - 2)
                total += w * model.table[code >> 64 - toxicity.SLOT_BITS]
                squares += w * w
    return total / math.sqrt(squares) + model.constant if squares else model.constant


def test_toxicity_scores_by_definition(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    model = toxicity.train(docs, spark.read.parquet(f"{SF_SMALL}/labels.parquet"))
    got, margins = {r.doc_id: r for r in toxicity.score(docs, model).collect()}, {}
    for r in docs.collect():
        found = []
        for w in set(toxicity.words(r.text)):
            if w not in margins:
                margins[w] = plain_margin(model, w)
            found.append(margins[w])
        top = [max(toxicity.FLOOR, m) for m in [*sorted(found, reverse=True)[:2], toxicity.FLOOR, toxicity.FLOOR][:2]]
        z = top[0] * model.weights[0] + top[1] * model.weights[1] + model.weights[2]
        assert got[r.doc_id].score == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-9)
        assert got[r.doc_id].predicted == int(got[r.doc_id].score >= 0.5)


def test_one_very_long_word_stays_in_memory(monkeypatch):
    rng = np.random.default_rng(1)
    model = toxicity.Model(rng.normal(size=toxicity.SLOTS), 0.1, np.array([1.0, 0.5, 0.0]))
    word = "".join(rng.choice(list("abcdefgh"), size=2_000))
    whole = model.margins([word])[0]
    monkeypatch.setattr(toxicity, "PIECE", 300)
    assert model.margins(["x", word, "insult", "y" * 301])[[1, 3]] == pytest.approx([whole, plain_margin(model, "y" * 301)])
    assert whole == pytest.approx(plain_margin(model, word))
    monkeypatch.undo()
    tracemalloc.start()
    toxicity.Reader(model).top(["clean words " + "QUJD" * 2_500_000, None])  # ten million characters
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 500 << 20
