"""Quality by compression: zstandard dictionaries of good and of bad text.

A text that looks like good text compresses better with a dictionary built from
good text than with one built from bad text. The features of a text are
compressed-size differences, normalised:

* (bad - good) / raw size        * (bad - good) / (bad + good)
* plain size / raw size          * log of the raw size
* the least and the mean of (bad - good) / raw size over pieces of the text,
  each compressed alone, and the mean of good / raw size over them

where good, bad and plain are the sizes with either dictionary and with none;
a logistic fit turns them into a probability (the calibrated score). The least
piece finds junk in the middle of good text.

The fit uses a bounded sample of labelled rows: at most ``dict_bytes`` of text
per class for the dictionaries and ``fit_rows`` rows for the logistic fit, both
taken in order of a hash of the id, from disjoint parts (three quarters and one). Texts longer than
a 64th of ``dict_bytes`` (128 KB) are not put into a dictionary, so no text fills
it alone; they are fitted and scored like all others. Scoring covers whole
texts of all rows; the model is two dictionaries of at most ``dict_size`` bytes
and a few numbers, whatever the size of the data.

Defined cases: a null text counts as empty; an empty text is scored like any
other; a null label or a label without a document is not learnt from, several
labels of one document each count; with labels of one class only every score is
the smoothed share of that class; a null id is held out; repeated rows get the
same score; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fjord.llm.common import held_out, row_key, ship, stage

LEVEL = 3
WINDOW = 1500
FEATURES = 7


@dataclass
class Model:
    good: bytes
    bad: bytes
    weights: np.ndarray  # of the scaled features, then the constant
    centre: np.ndarray
    spread: np.ndarray

    def scorer(self) -> Scorer:
        return Scorer(self)


class Scorer:
    """A model with its compressors, which cannot be pickled."""

    def __init__(self, model: Model):
        self.model, self.sizes = model, [_compressor(model.good), _compressor(model.bad), _compressor(b"")]

    def features(self, text: str | None) -> list[float]:
        raw = (text or "").encode("utf-8", "surrogatepass")
        good, bad, plain = (len(c.compress(raw)) for c in self.sizes)
        n = len(raw) + 1
        # pieces of about WINDOW bytes of the whole text, each compressed alone, so that the dictionary counts
        step = max(1, -(-len(raw) // max(1, round(len(raw) / WINDOW))))
        pieces = [raw[i:i + step] for i in range(0, len(raw), step)] or [b""]
        g = np.array([len(self.sizes[0].compress(p)) / (len(p) + 1) for p in pieces])
        b = np.array([len(self.sizes[1].compress(p)) / (len(p) + 1) for p in pieces])
        return [(bad - good) / n, (bad - good) / (bad + good), plain / n, float(np.log(n)),
                float((b - g).min()), float((b - g).mean()), float(g.mean())]

    def score(self, x: np.ndarray) -> np.ndarray:
        m = self.model
        return sigmoid((x - m.centre) / m.spread @ m.weights[:-1] + m.weights[-1])


def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    if not dictionary:
        return zstandard.ZstdCompressor(level=LEVEL)
    d = zstandard.ZstdCompressionDict(dictionary)
    d.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=d)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def build_dictionary(texts: list[bytes], size: int) -> bytes:
    """A trained dictionary; plain content where there is too little text to train one."""
    texts = [t for t in texts if t]
    try:
        return zstandard.train_dictionary(min(size, max(1024, sum(map(len, texts)) // 8)), texts).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"\n".join(texts)[-size:]


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 50) -> np.ndarray:
    """Weights and constant of a ridge logistic regression, by Newton's method."""
    a = np.c_[x, np.ones(len(x))]
    w = np.zeros(a.shape[1])
    for _ in range(steps):
        p = sigmoid(a @ w)
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + ridge * np.eye(len(w)), a.T @ (p - y) + ridge * w)
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return w


def labelled(docs: DataFrame, labels: DataFrame, label: str, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """Rows that may be learnt from, without their texts: id, y (0 or 1), n bytes and o, a stable order."""
    y = labels.select(F.col("doc_id").alias("__l"), F.col(label).cast("int").alias("y")).filter("y in (0, 1)")
    rows = docs.select(F.col(id_col).alias("id"), F.octet_length(F.coalesce(F.col(text_col), F.lit(""))).alias("n"),
                       F.xxhash64(F.col(id_col), row_key(text_col)).alias("o"))
    return rows.filter(~held_out(F.col("id"))).join(y, F.col("id") == F.col("__l")).drop("__l")


def with_texts(docs: DataFrame, sample: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (o, y, text) of a bounded ``sample`` (o, y); the sample travels to the texts, not the texts to it."""
    rows = docs.select(F.xxhash64(F.col(id_col), row_key(text_col)).alias("o"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.join(F.broadcast(sample.select("o", "y").distinct()), "o").select("o", "y", "text")


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", text_col: str = "text",
          dict_size: int = 112 << 10, dict_bytes: int = 8 << 20, fit_rows: int = 10_000) -> Model:
    """Fit the two dictionaries and the logistic weights on a bounded sample of labelled rows."""
    ship(docs.sparkSession)
    rows = stage(labelled(docs, labels, label, id_col, text_col))
    # texts of either class in order of the hash until dict_bytes are full; a text may take a 64th of that
    small = rows.filter((F.col("n") <= dict_bytes // 64) & (F.pmod("o", F.lit(4)) != 0))
    mean = {r.y: max(r.m, 64) for r in small.groupBy("y").agg(F.avg("n").alias("m")).collect()}
    dictionaries = {}
    for y in (1, 0):
        first = small.filter(F.col("y") == y).orderBy("o").limit(int(dict_bytes / mean.get(y, 64)) + 1)
        texts, total = [], 0
        for r in with_texts(docs, stage(first), id_col, text_col).orderBy("o").toLocalIterator():
            texts.append(r.text.encode("utf-8"))
            total += len(texts[-1])
            if total > dict_bytes:
                break
        dictionaries[y] = build_dictionary(texts, dict_size)
    model = Model(dictionaries[1], dictionaries[0], np.zeros(FEATURES + 1), np.zeros(FEATURES), np.ones(FEATURES))

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = model.scorer()
        for b in batches:
            x = np.array([scorer.features(t) for t in b["text"]]).reshape(-1, FEATURES)
            yield pd.DataFrame({"o": b["o"], "y": b["y"], **{f"f{i}": x[:, i] for i in range(FEATURES)}})

    sample = stage(rows.filter(F.pmod("o", F.lit(4)) == 0).orderBy("o").limit(fit_rows))
    got = (with_texts(docs, sample, id_col, text_col)
           .mapInPandas(measure, "o long, y int, " + ", ".join(f"f{i} double" for i in range(FEATURES)))
           .toPandas().sort_values(["o", "y"]))
    y = got["y"].to_numpy(float)
    if len(set(y)) < 2:  # nothing to tell apart: the smoothed share
        share = rows.agg((F.coalesce(F.sum("y"), F.lit(0)) + 1) / (F.count("*") + 2)).first()[0]
        model.weights[-1] = np.log(share / (1 - share))
        return model
    x = got[[f"f{i}" for i in range(FEATURES)]].to_numpy()
    model.centre, model.spread = x.mean(axis=0), x.std(axis=0) + 1e-9
    model.weights = logistic((x - model.centre) / model.spread, y)
    return model


def score(docs: DataFrame, model: Model, threshold: float = 0.3, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """Per document: id, __x (row_key), held_out, score (0 to 1) and predicted (1 from ``threshold``)."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = shared.value.scorer()
        for b in batches:
            x = np.array([scorer.features(t) for t in b["text"]]).reshape(-1, FEATURES)
            yield pd.DataFrame({"i": b["i"], "__x": b["__x"], "held_out": b["held_out"], "score": scorer.score(x)})

    rows = docs.select(F.col(id_col).cast("string").alias("i"), row_key(text_col).alias("__x"),
                       held_out(F.col(id_col)).alias("held_out"), F.col(text_col).alias("text"))
    return (rows.mapInPandas(run, "i string, __x long, held_out boolean, score double")
            .select(F.col("i").cast("long").alias(id_col), "__x", "held_out", "score",
                    (F.col("score") >= threshold).cast("int").alias("predicted")))


def keep_good(docs: DataFrame, model: Model, threshold: float = 0.3, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score ``threshold`` or more, unchanged and in place: nothing is shuffled."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = shared.value.scorer()
        for b in batches:
            texts = b.column(b.schema.get_field_index(text_col)).to_pylist()
            x = np.array([scorer.features(t) for t in texts]).reshape(-1, FEATURES)
            yield b.filter(pa.array(scorer.score(x) >= threshold))

    return docs.mapInArrow(run, docs.schema)
