"""Quality rules judged by host: failures are counted per host, shrunk, and held against its documents.

1. One scan measures every whole text: words, code points in words, symbols,
   lines that repeat an earlier one, and words in runs of five words that stand
   in the text more than once. The narrow measures are written to the shared
   folder; texts are never shuffled.
2. Every rule's failures are counted per host with map-side aggregation, so a
   hot host sends one row per task.
3. A rule's rates over all hosts are fitted by a beta distribution (moments of
   the beta-binomial, hosts weighted by their documents). A host's rate is the
   mean of its posterior: few documents say little and stay near the mean of
   all hosts, many speak for themselves.
4. A host fails when some rule's rate lies above ``limit`` by ``margin``
   posterior standard deviations. Its verdict is joined back to its documents.

A document is kept when it breaks no base rule and its host does not fail.

Defined cases: a null text has no words; a null or missing host is a value of
its own (``(none)``); a host that holds a url stands for the url's host; null
and repeated ids each get their own row; one host, or hosts of one document
each, give no spread to fit and are pooled; an empty table gives no rows; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator, Mapping
from itertools import count

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fjord.llm.common import ascii_lower, ship, stage

BLANKS = " \t\n\v\f\r"
WORD, BLANK, SYMBOL = re.compile(f"[^{BLANKS}]+"), re.compile(f"[{BLANKS}]"), re.compile(r"[#*$%&|<>]")
RUN, PIECE = 5, 1 << 20
NONE = "(none)"
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"]

# A rule is true where a document breaks it. The first two are the base rules.
RULES: dict[str, str] = {
    "short": "n_words < 10",
    "repeats": "100 * n_repeat_words > 20 * n_words",
    "dup_lines": "100 * n_dup_lines > 30 * n_lines",
    "symbols": "100 * n_symbols > 10 * n_words",
    "word_length": "word_chars < 3 * n_words or word_chars > 12 * n_words",
}
BASE = ("short", "repeats")


def word_numbers(text: str) -> tuple[np.ndarray, int]:
    """(a number per word, equal for equal words; code points in words), a piece of the text at a time."""
    number: defaultdict[str, int] = defaultdict(count().__next__)
    parts, chars, at = [], 0, 0
    while at < len(text):
        cut = BLANK.search(text, at + PIECE)
        end = cut.start() if cut else len(text)
        words = WORD.findall(text, at, end)
        chars += sum(map(len, words))
        parts.append(np.fromiter(map(number.__getitem__, words), np.int64, len(words)))
        at = end
    return np.concatenate(parts) if parts else np.empty(0, np.int64), chars


def repeated_words(numbers: np.ndarray, run: int = RUN) -> int:
    """Words inside a run of ``run`` words that stands in the text twice or more, the first one included."""
    starts = len(numbers) - run + 1
    if starts < 2:
        return 0
    codes = numbers[:starts]
    for k in range(1, run):  # numbers of ever longer runs: exact, no hashing
        codes = np.unique(codes * (numbers.max() + 1) + numbers[k:k + starts], return_inverse=True)[1]
    twice = np.bincount(codes)[codes] > 1
    edge = np.zeros(len(numbers) + 1, np.int64)
    edge[:starts] += twice
    edge[run:] -= twice
    return int((np.cumsum(edge) > 0).sum())


def measure(text: str | None) -> tuple[int, ...]:
    """The numbers named in MEASURES of one text."""
    text = text or ""
    numbers, chars = word_numbers(text)
    seen: set[str] = set()
    lines = dups = 0
    for line in text.split("\n"):
        if line.strip(BLANKS):
            lines += 1
            dups += line in seen
            seen.add(line)
    return len(numbers), chars, len(SYMBOL.findall(text)), dups, repeated_words(numbers), lines


def host_of(docs: DataFrame, host_col: str) -> Column:
    """The host a row belongs to: the column's value, or the host of a url that stands in it."""
    if host_col not in docs.columns:
        return F.lit(NONE)
    value = F.col(f"`{host_col}`").cast("string")
    url = F.regexp_extract(value, "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    return F.coalesce(F.when(url != "", ascii_lower(url)).otherwise(value), F.lit(NONE))


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """Per row: id, host and the columns of MEASURES."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), host_of(docs, host_col).alias("host"),
                       F.col(f"`{text_col}`").alias("text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = np.array([measure(t) for t in b["text"]], np.int64).reshape(-1, len(MEASURES))
            yield pd.DataFrame({"id": b["id"], "host": b["host"], **dict(zip(MEASURES, found.T, strict=True))})

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInPandas(run, f"id {kind}, host string, " + ", ".join(f"{m} long" for m in MEASURES))


def host_rates(found: DataFrame, rules: Mapping[str, str] = RULES) -> DataFrame:
    """Rows (host, rule, n, fails, rate, spread): the posterior mean and standard deviation of every host and rule."""
    names = list(rules)
    counts = found.groupBy("host").agg(
        F.count("*").alias("n"), *[F.sum(F.expr(r).cast("long")).alias(f"fails_{i}") for i, r in enumerate(rules.values())])
    long = stage(counts.select("host", "n", F.explode(F.array(*[
        F.struct(F.lit(r).alias("rule"), F.col(f"fails_{i}").alias("fails")) for i, r in enumerate(names)])).alias("x"))
        .select("host", "n", "x.*"))
    total, hosts = F.col("total"), F.col("hosts")
    moments = long.groupBy("rule").agg(
        F.sum("n").cast("double").alias("total"), F.count("*").cast("double").alias("hosts"),
        (F.sum("fails") / F.sum("n")).alias("mean"), F.sum(F.col("fails") * F.col("fails") / F.col("n")).alias("squares"),
        F.sum(F.col("n").cast("double") * F.col("n")).alias("sizes"))
    mean = F.col("mean")
    between = (F.col("squares") - total * mean * mean) / F.nullif(mean * (1 - mean), F.lit(0.0)) - (hosts - 1)
    room = total - F.col("sizes") / total - (hosts - 1)
    # the correlation of two documents of one host: none or all of it would leave no beta distribution
    alike = F.least(F.greatest(F.coalesce(F.when(room > 1e-9 * total, between / room), F.lit(0.0)), F.lit(1e-6)), F.lit(1 - 1e-6))
    prior = moments.select("rule", "mean", ((1 - alike) / alike).alias("strength"))
    rate = (F.col("mean") * F.col("strength") + F.col("fails")) / (F.col("strength") + F.col("n"))
    return (long.join(F.broadcast(prior), "rule")  # one row per rule
            .select("host", "rule", "n", "fails", rate.alias("rate"), "strength")
            .withColumn("spread", F.sqrt(F.col("rate") * (1 - F.col("rate")) / (F.col("strength") + F.col("n") + 1)))
            .drop("strength"))


def judge(docs: DataFrame, rules: Mapping[str, str] = RULES, base: tuple[str, ...] = BASE, limit: float = 0.5,
          margin: float = 2.0, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """Per row: id, host, the measures, ``base_failed``, ``host_rate`` (of the host's worst rule), ``host_failed``, ``kept``."""
    found = stage(measures(docs, id_col, text_col, host_col))
    hosts = stage(host_rates(found, rules).groupBy("host").agg(
        F.max("rate").alias("host_rate"),
        F.bool_or(F.col("rate") - margin * F.col("spread") > limit).alias("host_failed")))
    broken = F.lit(False)
    for r in base:
        broken = broken | F.expr(rules[r])
    out = found.withColumn("base_failed", broken).join(hosts, "host", "left")
    return out.select(F.col("id").alias(id_col), "host", *MEASURES, "base_failed", "host_rate", "host_failed",
                      (~F.col("base_failed") & ~F.col("host_failed")).alias("kept"))
