"""The corpus pipeline, stage by stage, against plain Python over its own input."""

import hashlib

import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from fjord.llm import quality
from fjord.llm.common import stage
from tests.conftest import SF_SMALL
from tests.llm.test_dedup import LOW, brute_components, brute_print
from tests.llm.test_search_links_mix import brute_mix


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality classifier", "exact dedup", "SimHash near-dedup", "mixing to target weights", "BPE encoding"]
    results = {}
    for name, function in stages.items():
        out = stage(function(spark, docs, SF_SMALL))
        results[name] = (docs.collect(), out.collect())
        if name != "BPE encoding":
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
            docs = out

    before, after = results["quality classifier"]
    source = spark.createDataFrame(before)
    model = quality.train(source, spark.read.parquet(f"{SF_SMALL}/labels.parquet"))
    assert {r.doc_id for r in after} == {r.doc_id for r in quality.score(source, model).collect() if r.predicted}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").collect()}
    clean = [r.doc_id for r in before if labels.get(r.doc_id) == 1]
    assert len({r.doc_id for r in after} & set(clean)) >= 0.97 * len(clean)

    before, after = results["exact dedup"]
    best = {}
    for r in before:
        t = (r.text or "").translate(LOW)
        best[t] = max(r.doc_id, best.get(t, r.doc_id))
    assert sorted(after) == sorted(r for r in before if r.doc_id == best[(r.text or "").translate(LOW)])

    before, after = results["SimHash near-dedup"]
    group = brute_components([r.doc_id for r in before], [brute_print(r.text) for r in before])
    assert sorted(after) == sorted(r for r, c in zip(before, group, strict=True) if r.doc_id == c)

    before, after = results["mixing to target weights"]
    chosen = {x[0] for x in brute_mix([(r.doc_id, r.text, r.source, r.lang) for r in before], 0.7)[0] if x[5]}
    assert sorted(after) == sorted(r for r in before if r.doc_id in chosen)

    before, after = results["BPE encoding"]
    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = []
    for r in before:
        ids = lib.encode(r.text, add_special_tokens=False).ids
        want.append((r.doc_id, len(ids), *(hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), r.text))))
    assert sorted(map(tuple, after)) == sorted(want)
    assert corpus_pipeline.ORACLE_SQL is None


def test_stages_on_odd_rows(spark):
    text = "An ordinary sentence with several words, and then another one. " * 8
    rows = [(None, None, None, None, None), (None, text, "en", "a", 1), (1, text, None, None, None), (1, text, None, None, None),
            (2, text.upper(), "en", "a", 5), (3, "", "de", "b", 0), (4, text + "tail", "en", "a", 9), (4, "another text " * 30, "en", "b", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumns(
        {"kept": F.lit(True), "fp": F.lit("x"), "w": F.lit(1.0)})
    for name, function in corpus_pipeline.STAGES:
        result = function(spark, docs, SF_SMALL)
        out = result.collect()
        assert len(out) <= len(rows)
        if name == "exact dedup":
            assert len(out) == 4  # the text in either case, the text with a tail, the other text, the empty one
        if name != "BPE encoding":
            assert result.columns == docs.columns
        assert function(spark, docs.limit(0), SF_SMALL).count() == 0
