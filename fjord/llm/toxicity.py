"""Toxicity by a gapped subsequence kernel and a support vector machine on Nystroem landmarks.

Kernel: a word, with a mark at either end, is the weighted set of its
subsequences of three characters that span at most five, so one or two inserted
characters leave most of an insult's subsequences in place; a wider span weighs
less (``DECAY`` per skipped character). k(x, y) is the inner product of these
sets, normalised. Subsequences are hashed into ``SLOTS`` table places.

Labels belong to whole texts, so a toxic text is a bag of words of which some
are insults. Instances are words of labelled sentences: toxic instances are
words that stand significantly more often in toxic texts, words of toxic texts
only with a run of five characters that does, and the same words with a
character put in; the others come from clean texts. Landmarks are chosen among them greedily, each the word worst
covered so far; phi(x) = K_mm^(-1/2) k(x, landmarks) and a linear support vector
machine (squared hinge) on phi decides. As k is linear in the weighted set, the
machine folds into one weight per table place: scoring a word is a table lookup
per subsequence.

A text is as toxic as its worst words: a logistic fit turns the two largest
margins into a probability; a margin below ``FLOOR`` (that of a text without
words) counts as ``FLOOR``, as nothing is cleaner than no words at all.
Spaced-out letters are joined to a word first. Words of 3 to 64 characters are
learnt from (shorter ones have no subsequence of their own but the marks',
longer ones are no words); every word of any length is scored.

The fit uses at most ``fit_docs`` labelled rows, in order of a hash of the id;
three quarters of them (one of each group of copies) train the machine, the
others the logistic. Copies are texts of one label that share half of their runs
of five words, as estimated by min-hashes. Scoring covers whole texts; the model is one table of
fixed size.

Defined cases: a null text counts as empty, and a text without words has the
margins of the empty word; a null label is not learnt from; labels of one class
only give the smoothed share of that class; a null id is held out; repeated
rows get the same score; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fjord.llm.common import held_out, row_key, ship, stage
from fjord.llm.quality import labelled, logistic, sigmoid, with_texts

SLOT_BITS = 20
SLOTS = 1 << SLOT_BITS
DECAY = 0.6
STEPS = [(i, j) for j in range(2, 5) for i in range(1, j)]  # places of the 2nd and 3rd character after the 1st
EDGE = re.compile(r"^[\W_]+|[\W_]+$")
SPACED = re.compile(r"(?<!\w)(?:[^\W\d_][\W_]{1,2}){3,}[^\W\d_](?!\w)")
KEEP_WORDS, KEEP_CHARS = 400_000, 1000  # words whose margins are remembered, and how long one of them may be
PIECE = 200_000  # characters whose subsequences are held at once
STEM = "\n"
FLOOR = -3.0  # margin of a text without words
HASHES, BAND, ALIKE = 126, 3, 0.5  # min-hashes of a text, those that stand for it in a look-up, the share copies agree in


def words(text: str | None) -> list[str]:
    """Lower-cased words between white space; letters that marks or spaces part are one word."""
    low = (text or "").lower()
    if SPACED.search(low):
        low = SPACED.sub(lambda m: "".join(c for c in m[0] if c.isalnum()), low)
    return low.split()


def marked(word: str) -> str:
    """The word between its marks, without what stands around it."""
    return "^" + EDGE.sub("", word) + "$"


def places(text: str, owner_ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """(positions of the first character, table place, weight) of every subsequence, one shape after the other.

    ``owner_ends`` holds, for every character, where its word ends.
    """
    chars = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    place = np.arange(len(chars))
    for i, j in STEPS:
        at = place[place + j < owner_ends]
        code = chars[at] * np.uint64(0x9E3779B97F4A7C15) ^ chars[at + i] * np.uint64(0xC2B2AE3D27D4EB4F)
        code = (code ^ code >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9) ^ chars[at + j] * np.uint64(0x165667B19E3779F9)
        code = (code ^ code >> np.uint64(32)) * np.uint64(0x94D049BB133111EB)
        yield at, (code >> np.uint64(64 - SLOT_BITS)).astype(np.int64), DECAY ** (j - 2)


def occurrences(batch: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word number, table place, weight) of every subsequence; weights are normalised per word."""
    texts = [marked(w) for w in batch]
    length = np.fromiter(map(len, texts), np.int64, len(texts))
    owner = np.repeat(np.arange(len(texts)), length)
    who, slot, weight = [], [], []
    for at, s, w in places("".join(texts), np.repeat(np.cumsum(length), length)):
        who.append(owner[at])
        slot.append(s)
        weight.append(np.full(len(at), w, np.float64))
    who, slot, weight = np.concatenate(who), np.concatenate(slot), np.concatenate(weight)
    norm = np.sqrt(np.bincount(who, weight * weight, len(batch)))
    return who, slot, weight / norm[who]


def kernel(a: list[str], b: list[str]) -> np.ndarray:
    """Normalised kernel of two word lists."""
    out = np.zeros((len(a), len(b)))
    wb, sb, vb = occurrences(b)
    order = np.argsort(sb, kind="stable")
    wb, sb, vb = wb[order], sb[order], vb[order]
    wa, sa, va = occurrences(a)
    lo, hi = np.searchsorted(sb, sa), np.searchsorted(sb, sa, side="right")
    n = hi - lo
    left = np.repeat(np.arange(len(sa)), n)
    right = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
    np.add.at(out, (wa[left], wb[right]), va[left] * vb[right])
    return out


@dataclass
class Model:
    table: np.ndarray  # weight of each table place
    constant: float
    weights: np.ndarray  # logistic: two largest margins, constant

    def margins(self, batch: list[str]) -> np.ndarray:
        """Margins of words, as many of them at a time as hold PIECE characters."""
        out, at = np.empty(len(batch)), 0
        ends = np.cumsum([len(w) for w in batch])
        while at < len(batch):
            if len(batch[at]) > PIECE:
                out[at] = self.long_margin(batch[at])
                at += 1
                continue
            to = max(at + 1, int(np.searchsorted(ends, ends[at] - len(batch[at]) + PIECE, side="right")))
            who, slot, weight = occurrences(batch[at:to])
            out[at:to] = np.bincount(who, weight * self.table[slot], to - at) + self.constant
            at = to
        return out

    def long_margin(self, word: str) -> float:
        """The margin of one long word, summed in slices that share the characters a subsequence may span."""
        text, total, squares, reach = marked(word), 0.0, 0.0, max(j for _, j in STEPS)
        for start in range(0, len(text), PIECE):
            part = text[start:start + PIECE + reach]
            for at, slot, weight in places(part, np.full(len(part), len(part))):
                own = slot[at < PIECE]
                total += weight * self.table[own].sum()
                squares += weight * weight * len(own)
        return total / squares**0.5 + self.constant

    def score(self, top: np.ndarray) -> np.ndarray:
        return sigmoid(top @ self.weights[:2] + self.weights[2])


class Reader:
    """Margins of whole texts; a bounded memory of words saves computing them again."""

    def __init__(self, model: Model):
        self.model, self.known = model, {}

    def top(self, texts: list[str | None]) -> np.ndarray:
        """The two largest margins of distinct words of every text."""
        bags = [set(words(t)) for t in texts]
        if len(self.known) > KEEP_WORDS:
            self.known.clear()
        new = list(set().union(*bags).difference(self.known)) if bags else []
        fresh = dict(zip(new, self.model.margins(new).tolist(), strict=True))
        self.known.update((w, m) for w, m in fresh.items() if len(w) <= KEEP_CHARS)
        margin = lambda w: fresh[w] if w in fresh else self.known[w]
        out = np.full((len(texts), 2), FLOOR)
        for row, bag in zip(out, bags, strict=True):
            if bag:
                m = np.fromiter(map(margin, bag), np.float64, len(bag))
                row[0] = m.max()
                if len(m) > 1:
                    row[1] = np.partition(m, -2)[-2]
        return np.maximum(out, FLOOR)


def choose_landmarks(candidates: list[str], m: int) -> list[str]:
    """Greedy (pivoted Cholesky): each landmark is the word that those before explain least."""
    rest, chosen, rows = np.ones(len(candidates)), [], []
    for _ in range(min(m, len(candidates))):
        i = int(rest.argmax())
        if rest[i] < 1e-6:
            break
        row = kernel([candidates[i]], candidates)[0]
        for r in rows:
            row = row - r[i] * r
        row = row / np.sqrt(rest[i])
        rows.append(row)
        rest = rest - row * row
        rest[i] = 0
        chosen.append(candidates[i])
    return chosen


def squared_hinge(x: np.ndarray, y: np.ndarray, cost: np.ndarray, steps: int = 30) -> tuple[np.ndarray, float]:
    """Linear support vector machine (y: -1 or 1), by Newton steps on the primal."""
    a = np.c_[x, np.ones(len(x))]
    w = np.zeros(a.shape[1])
    keep = np.eye(len(w))
    keep[-1, -1] = 1e-6
    for _ in range(steps):
        inside = y * (a @ w) < 1
        b = a[inside] * cost[inside, None]
        new = np.linalg.solve(keep + 2 * b.T @ a[inside], 2 * b.T @ y[inside])
        done = np.abs(new - w).max() < 1e-6
        w = new
        if done:
            break
    return w[:-1], float(w[-1])


def stems(word: str) -> list[str]:
    """Runs of five characters of the marked word, told from words by a first character no word has."""
    marked = f"^{word}$"
    return [STEM + marked[i:i + 5] for i in range(len(marked) - 4)]


def inserted(word: str) -> list[str]:
    """The word with one character put in, at two places."""
    marks = "x.*-_"
    return [word[:i] + marks[(len(word) + i) % 5] + word[i:] for i in (len(word) // 2, len(word) // 3 + 1)]


def fit_words(toxic: list[str], seen: list[float], clean: list[str], landmarks: int) -> tuple[np.ndarray, float]:
    """Table and constant of the machine that tells toxic words (seen so often) from clean ones."""
    m = choose_landmarks(toxic, landmarks // 2) + choose_landmarks(clean[:4 * landmarks], landmarks // 2)
    values, vectors = np.linalg.eigh(kernel(m, m))
    good = values > 1e-4
    root = vectors[:, good] / np.sqrt(values[good])  # K_mm^(-1/2), up to a rotation
    odd = [v for w in toxic if len(w) > 3 for v in inserted(w)]
    x = np.concatenate([kernel(part, m) @ root for part in (toxic, odd, clean) if part])
    y = np.r_[np.ones(len(toxic) + len(odd)), -np.ones(len(clean))]
    weight = np.sqrt(np.array(seen))
    cost = np.r_[30 * weight / weight.mean(), np.full(len(odd), 10.0), np.full(len(clean), 10.0)]
    w, constant = squared_hinge(x, y, cost)
    who, slot, value = occurrences(m)
    return np.bincount(slot, value * (root @ w)[who], SLOTS), constant


def signature(text: str | None) -> np.ndarray:
    """Least hashes of the text's runs of five words (of all its words where it has fewer); marks at word ends do not count."""
    code = np.array([xxhash.xxh64_intdigest(EDGE.sub("", w)) for w in words(text)], np.uint64)
    code = np.r_[code, np.zeros(max(0, 5 - len(code)), np.uint64)]
    n = len(code) - 4
    run = code[:n]
    for i in range(1, 5):
        run = (run ^ run >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9) + code[i:n + i]
    run = np.unique(run ^ run >> np.uint64(32))
    factors = np.random.default_rng(7).integers(0, 1 << 63, HASHES, np.uint64) * np.uint64(2) + np.uint64(1)
    return np.array([(run * f >> np.uint64(32)).min() for f in factors], np.uint32)


def one_of_each(rows: pd.DataFrame) -> pd.DataFrame:
    """The rows (o, y, signature) without copies of an earlier one with the same label, in order of o."""
    kept = []
    for _, part in rows.sort_values(["y", "o"]).groupby("y"):
        signs = np.frombuffer(b"".join(part["signature"]), np.uint32).reshape(-1, HASHES)
        wide = signs.astype(np.uint64).reshape(len(signs), -1, BAND)
        keys = wide @ np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)
        shared = np.empty(keys.shape, bool)
        for b in range(keys.shape[1]):
            _, group, size = np.unique(keys[:, b], return_inverse=True, return_counts=True)
            shared[:, b] = size[group] > 1
        first: dict[tuple[int, int], list[int]] = {}  # kept rows by band; only bands that meet another row
        for i, s in enumerate(signs):
            bands = [(b, int(keys[i, b])) for b in np.flatnonzero(shared[i])]
            near = sorted(set().union(*(first.get(k, []) for k in bands)))
            if near and (signs[near] == s).mean(axis=1).max() >= ALIKE:
                continue
            for k in bands:
                first.setdefault(k, []).append(i)
            kept.append(part.index[i])
    return rows.loc[kept]


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", id_col: str = "doc_id", text_col: str = "text",
          fit_docs: int = 12_000, landmarks: int = 256, word_rows: int = 4_000) -> Model:
    """Fit the machine and the logistic weights on a bounded sample of labelled rows."""
    ship(docs.sparkSession)
    rows = stage(labelled(docs, labels, label, id_col, text_col))
    sample = stage(rows.orderBy("o").limit(fit_docs))
    share = rows.agg((F.coalesce(F.sum("y"), F.lit(0)) + 1) / (F.count("*") + 2)).first()[0]
    prior = Model(np.zeros(SLOTS), 0.0, np.array([0.0, 0.0, np.log(share / (1 - share))]))

    def signatures(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"o": b["o"], "y": b["y"], "signature": [signature(t).tobytes() for t in b["text"]]})

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for at in range(0, len(b), 200):
                part = b.iloc[at:at + 200]
                bags = [{EDGE.sub("", w) for w in words(t)} for t in part["text"]]
                bags = [{w for w in x if 2 < len(w) <= 64} for x in bags]
                grams = [{g for w in x for g in stems(w)} for x in bags]
                found = [[*sorted(x), *sorted(y)] for x, y in zip(bags, grams, strict=True)]
                yield pd.DataFrame({"w": [w for x in found for w in x],
                                    "y": np.repeat(part["y"].to_numpy(), [len(x) for x in found])})

    texts = stage(with_texts(docs, sample, id_col, text_col))
    learn = texts.filter(F.pmod("o", F.lit(4)) != 0)
    # at most fit_docs rows of half a kilobyte
    kept = one_of_each(learn.mapInPandas(signatures, "o long, y int, signature binary").toPandas())
    total = {int(y): float(n) for y, n in kept["y"].value_counts().items()}
    if len(total) < 2:
        return prior
    one = stage(docs.sparkSession.createDataFrame(list(zip(kept["o"].tolist(), kept["y"].tolist(), strict=True)),
                                                  "o long, y int"))
    # Chernoff's bound on the chance that something that tells nothing stands in so many toxic texts, against
    # the number of words and stems that were tried
    a, b, rate = F.col("a"), F.col("b"), total[1] / (total[0] + total[1])
    surprise = (F.when(a > 0, a * F.log(a / ((a + b) * rate))).otherwise(0.0)
                + F.when(b > 0, b * F.log(b / ((a + b) * (1 - rate)))).otherwise(0.0))
    counted = stage(learn.join(F.broadcast(one), ["o", "y"]).dropDuplicates(["o", "y"]).select("text", "y")
                    .mapInPandas(split, "w string, y int")
                    .groupBy("w").agg(F.sum("y").cast("double").alias("a"), F.sum(1 - F.col("y")).cast("double").alias("b"))
                    .withColumn("g", F.when(a > (a + b) * rate, surprise).otherwise(0.0)))
    tried = float(np.log(max(2, counted.count())))
    telling = (F.col("g") > tried) & (a / total[1] > 10 * b / total[0])
    whole = counted.filter(~F.col("w").startswith(STEM))
    grams = stage(counted.filter(F.col("w").startswith(STEM) & telling).orderBy(F.desc("g"), "w").limit(word_rows)
                  .select(F.substring("w", 2, 99).alias("gram")))
    # toxic words tell by themselves, or hold a telling stem and stand in no clean text
    marked = F.concat(F.lit("^"), F.col("w"), F.lit("$"))
    held = (whole.filter("a > 0 and b = 0").select("w", "a", F.explode(F.transform(
        F.sequence(F.lit(1), F.length(marked) - 4), lambda i: marked.substr(i, F.lit(5)))).alias("gram"))
        .join(F.broadcast(grams), "gram").select("w", "a").distinct())
    found = (whole.filter(telling).select("w", "a").union(held).distinct().orderBy(F.desc("a"), "w")
             .limit(word_rows).collect())
    other = whole.filter("b >= 1 and g < 1")
    common = [r.w for r in other.orderBy(F.desc("b"), "w").limit(word_rows // 2).collect()]
    chance = [r.w for r in other.orderBy(F.xxhash64("w"), "w").limit(word_rows).collect()]
    clean = list(dict.fromkeys(common + chance))
    if not found or not clean:
        return prior
    table, constant = fit_words([r.w for r in found], [r.a for r in found], clean, landmarks)
    model = Model(table, constant, prior.weights)

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = Reader(model)
        for b in batches:
            top = reader.top(list(b["text"]))
            yield pd.DataFrame({"o": b["o"], "y": b["y"], "f0": top[:, 0], "f1": top[:, 1]})

    got = (texts.filter(F.pmod("o", F.lit(4)) == 0).mapInPandas(measure, "o long, y int, f0 double, f1 double")
           .toPandas().sort_values(["o", "y"]))
    if got["y"].nunique() == 2:
        model.weights = logistic(got[["f0", "f1"]].to_numpy(), got["y"].to_numpy(float))
    else:
        model.weights = np.array([4.0, 0.0, 0.0])
    return model


def score(docs: DataFrame, model: Model, threshold: float = 0.5, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """Per document: id, __x (row_key), held_out, score (0 to 1) and predicted (1 from ``threshold``)."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = Reader(shared.value)
        for b in batches:
            texts = list(b["text"])
            parts = [reader.top(texts[i:i + 200]) for i in range(0, len(texts), 200)]
            top = np.concatenate(parts) if parts else np.zeros((0, 2))
            yield pd.DataFrame({"i": b["i"], "__x": b["__x"], "held_out": b["held_out"],
                                "score": reader.model.score(top)})

    rows = docs.select(F.col(id_col).cast("string").alias("i"), row_key(text_col).alias("__x"),
                       held_out(F.col(id_col)).alias("held_out"), F.col(text_col).alias("text"))
    return (rows.mapInPandas(run, "i string, __x long, held_out boolean, score double")
            .select(F.col("i").cast("long").alias(id_col), "__x", "held_out", "score",
                    (F.col("score") >= threshold).cast("int").alias("predicted")))
