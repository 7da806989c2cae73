"""Mixing sources to target weights: bounded iterative proportional fitting, then sampling.

Documents fall into cells (source, language, topic). A sample of ``fraction`` of
all tokens is wanted in which every source, language and topic has its target
share. The tokens to take from each cell are raked: in turn, the cells of each
source (language, topic) are scaled so that they sum to its target. No cell gives
more than it has: a full cell is taken whole, and the cells of a value that are
still open are raked to what is left of its target, until all three sets of
marginals agree with their targets. A cell's inclusion probability is what it
gives over what it has, and documents are sampled by a hash of their id, so the
expected sample has the target shares.

*Topics* come from the words: the ``KEYWORDS`` words of a language that stand in
most of its documents, of those in 1 to 20 % of them; a document's topic is the
keyword it uses most (of equally used ones the rarer, then by name), else
``other``. Topics are counted within their language, a corpus of documents in
several languages having no words in common.

*Targets* are tempered by default: a source's share is proportional to its tokens
to the power ``temper`` (1 keeps the shares, 0 makes them equal), so small
sources gain weight and a hot one loses it; a topic's share is tempered within
its language. Explicit shares can be given. A target that no sample of that size
can reach (the value has fewer tokens) is lowered to what the value has, the
others of its kind share the rest, and :func:`plan` reports it.

Cells are counted with map-side aggregation, one row per cell and task; fewer
than ``CELLS_PER_TASK`` cells are raked by numpy in one task, more by grouped sums
over tables in the shared folder; documents are only joined with the
finished cells.

Defined cases: null or missing source and language are a value of their own
(``(none)``); a null or empty text has no tokens and falls into the topic
``empty``; a cell without tokens gets probability 1 (it costs nothing); with explicit
targets a value without a share gets probability 0; targets that the cells
cannot meet together (a value that stands in cells of others only) are met as
far as the last round goes, which is logged as a warning; a null id is hashed by its
text; rows that share an id share their fate; an empty table gives no rows;
columns of any name are left alone.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator, Mapping, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fjord.llm.common import ship, stage

DIMS = ("source", "lang", "topic")
WORD = r"[^ \t\n\r]+"
KEYWORDS, LETTERS = 4, 4
PARTS = 64  # a language's words are dealt over so many
NONE = "(none)"
SWEEPS_PER_TABLE, CELLS_PER_TASK = 2, 200_000


def token_count(text: Column) -> Column:
    """Words between blanks, the unit in which shares are counted."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def terms(text: Column) -> Column:
    """Runs of letters a-z, A-Z lower-cased, and maybe empty ones at the ends; keywords are those of four letters or more."""
    # what is not a letter goes first: then the rest is ASCII, and quick to lower and to split
    return F.split(F.lower(F.regexp_replace(F.coalesce(text, F.lit("")), "[^A-Za-z]+", " ")), " ")


def keywords(rows: DataFrame, per_lang: int = KEYWORDS) -> DataFrame:
    """(lang, keywords: array of (word, df)) from rows (lang, text); counted over all documents."""
    found = (rows.select("lang", F.explode(F.array_distinct(terms(F.col("text")))).alias("word"))
             .filter(F.length("word") >= LETTERS).groupBy("lang", "word").agg(F.count("*").alias("df"))
             .withColumn("part", F.pmod(F.xxhash64("word"), F.lit(PARTS))))
    sizes = rows.groupBy("lang").agg(F.count("*").alias("docs")).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1)).cast("array<long>")))
    top = found.join(sizes, ["lang", "part"]).filter("100 * df >= docs and 5 * df <= docs")
    for by in (["lang", "part"], ["lang"]):  # the best of every part, then of these: no language's words meet in one task
        best = Window.partitionBy(*by).orderBy(F.desc("df"), "word")
        top = top.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= per_lang)
    return top.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("word", "df"))).alias("keywords"))


def topic(found: Column, tokens: Column, words: Column) -> Column:
    """The keyword of ``words`` (array of (word, df)) that stands most often among the terms ``found``."""
    used = F.transform(words, lambda k: F.struct(
        (F.size(F.array_remove(found, k["word"])) - F.size(found)).alias("n"), k["df"].alias("df"), k["word"].alias("word")))
    best = F.array_min(F.filter(used, lambda u: u["n"] < 0))["word"]
    # the size is a second use of the terms, so the planner computes them once a row and not once a keyword
    return F.when(tokens == 0, F.lit("empty")).when(F.size(found) < 1, F.lit("other")).otherwise(F.coalesce(best, F.lit("other")))


def uniform(id_: Column, text: Column, seed: str) -> Column:
    """A number from 0 to 1 that depends on the id alone (on the text for a null id)."""
    key = F.coalesce(id_.cast("string"), F.md5(F.coalesce(text, F.lit(""))))
    return F.conv(F.substring(F.md5(F.concat(key, F.lit(":" + seed))), 1, 13), 16, 10).cast("double") / float(1 << 52)


def described(docs: DataFrame, id_col: str, text_col: str, source_col: str, lang_col: str, seed: str,
              columns: Sequence[str] | None = None) -> DataFrame:
    """Staged rows (doc: the document as one struct, source, lang, topic, tokens, u); read for the cells and the sample.

    ``columns`` are those of ``doc`` (all): a text that nobody asks for is read, but not written again.
    """
    value = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(NONE)) if c in docs.columns else F.lit(NONE)
    text = F.col(f"`{text_col}`")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in (columns or docs.columns)]).alias("doc"), value(source_col).alias("source"),
                       value(lang_col).alias("lang"), text.alias("text"), token_count(text).alias("tokens"),
                       uniform(F.col(f"`{id_col}`"), text, seed).alias("u"))
    known = stage(keywords(rows))
    rows = rows.join(known, "lang", "left").withColumn("terms", terms(F.col("text")))
    return stage(rows.select("doc", "source", "lang", topic(F.col("terms"), F.col("tokens"), F.col("keywords")).alias("topic"),
                             "tokens", "u"))


def _fill(values: DataFrame, totals: DataFrame) -> DataFrame:
    """``values`` (dim, within, value, have, share) with ``target``: the totals (dim, within, total) dealt by share, none above have.

    ``full`` marks the values whose share of the total they do not have.
    """
    now = stage(values.join(totals, ["dim", "within"]).withColumn("full", F.lit(False)))
    while True:  # each round fills at least one more value, or ends
        open_ = ~F.col("full")
        level = now.groupBy("dim", "within").agg(
            ((F.max("total") - F.coalesce(F.sum(F.when(F.col("full"), F.col("have"))), F.lit(0.0)))
             / F.nullif(F.sum(F.when(open_, F.col("share"))), F.lit(0.0))).alias("level"))
        now = now.join(level, ["dim", "within"])
        over = open_ & (F.col("share") > 0) & (F.col("level") * F.col("share") >= F.col("have"))
        if now.filter(over).isEmpty():
            target = F.when(F.col("full"), F.col("have")).otherwise(F.coalesce(F.col("level") * F.col("share"), F.lit(0.0)))
            return stage(now.withColumn("target", target).drop("level"))
        now = stage(now.withColumn("full", F.col("full") | F.coalesce(over, F.lit(False))).drop("level"))


def goals(cells: DataFrame, fraction: float, targets: Mapping[str, Mapping[str, float]] | None = None,
          temper: float = 0.7) -> DataFrame:
    """(dim, within, value, have, share, total, full, target): the tokens to take of every source, language and topic.

    ``within`` is the language of a topic; topics with explicit targets are not told apart by language.
    """
    targets = targets or {}
    budget = (cells.agg(F.sum("n")).first()[0] or 0) * fraction
    nested = "topic" not in targets
    parts = []
    for d in DIMS:
        within = F.col("lang") if d == "topic" and nested else F.lit("")
        if d in targets:
            pairs = [F.lit(x) for kv in targets[d].items() for x in kv]
            share = F.coalesce(F.element_at(F.create_map(*pairs), F.col("value")).cast("double"), F.lit(0.0))
        else:
            share = F.pow("have", F.lit(temper))
        have = cells.groupBy(F.lit(d).alias("dim"), within.alias("within"), F.col(d).alias("value")).agg(F.sum("n").cast("double").alias("have"))
        parts.append(have.withColumn("share", F.when(F.col("have") > 0, share).otherwise(0.0)))
    spark, flat = cells.sparkSession, parts[:2] if nested else parts
    top = _fill(reduce(DataFrame.unionByName, flat),
                spark.createDataFrame([(d, "", float(budget)) for d in DIMS], "dim string, within string, total double"))
    if not nested:
        return top
    by_lang = top.filter("dim = 'lang'").select(F.lit("topic").alias("dim"), F.col("value").alias("within"), F.col("target").alias("total"))
    return top.unionByName(_fill(parts[2], by_lang))


def _progress(worst: float | None, best: float | None, stuck: int) -> tuple[float | None, int]:
    """(best miss so far, tables in a row that were hardly better)."""
    stuck = 0 if best is None or worst is None or worst < 0.99 * best else stuck + 1
    return worst if best is None else min(best, worst), stuck


def swept(n: np.ndarray, y: np.ndarray, whole: np.ndarray, sides: list[tuple[np.ndarray, np.ndarray]], rounds: int,
          tolerance: float) -> tuple[np.ndarray, float]:
    """(tokens to take, largest miss) of cells; ``sides`` holds (number of the cell's value, that value's target) per kind."""
    worst, best, stuck = 0.0, None, 0
    for done in range(1, rounds + 1):
        worst = 0.0
        for value, goal in sides:
            shut = whole | (y >= n)
            closed = np.bincount(value, np.where(shut, n, 0.0))[value]
            left = np.bincount(value, np.where(shut, 0.0, y))[value]
            took = closed + left
            with np.errstate(divide="ignore", invalid="ignore"):
                factor = np.where((left > 0) & (goal > closed), (goal - closed) / left, np.where(took > 0, goal / took, 0.0))
                miss = np.where(goal > 0, np.abs(took - goal) / goal, 0.0)
            worst = max(worst, float(miss.max(initial=0.0)))
            y = y * factor
        if done % SWEEPS_PER_TABLE == 0:
            best, stuck = _progress(worst, best, stuck)
            if worst < tolerance or stuck >= 10:
                break
    return y, worst


def _rake_apart(now: DataFrame, keys: Mapping[str, list[str]], rounds: int, tolerance: float) -> tuple[DataFrame, float | None]:
    """(cells, largest miss) after the sweeps of :func:`swept` as grouped sums over staged tables."""
    n, y = F.col("n"), F.col("y")
    columns, worst, best, stuck = now.columns, None, None, 0
    for _ in range(0, rounds, SWEEPS_PER_TABLE):
        for _ in range(SWEEPS_PER_TABLE):
            off = F.lit(0.0)
            for d in DIMS:
                shut = F.col("whole") | (y >= n)
                sums = {"shut": F.sum(F.when(shut, n).otherwise(0.0)), "open": F.sum(F.when(shut, 0.0).otherwise(y))}
                now = now.join(now.groupBy(*keys[d]).agg(*[v.alias(c) for c, v in sums.items()]), keys[d])
                goal, took = F.col(f"t_{d}"), F.col("shut") + F.col("open")
                factor = (F.when((F.col("open") > 0) & (goal > F.col("shut")), (goal - F.col("shut")) / F.col("open"))
                          .when(took > 0, goal / took).otherwise(0.0))
                off = F.greatest(off, F.when(goal > 0, F.abs(took - goal) / goal).otherwise(0.0))
                now = now.withColumn("y", y * factor).withColumn(f"off_{d}", off).drop("shut", "open")
                off = F.col(f"off_{d}")
            now = now.withColumn("off", off).drop(*[f"off_{d}" for d in DIMS])
        now = stage(now)
        worst = now.agg(F.max("off")).first()[0]
        now = now.select(*columns)
        best, stuck = _progress(worst, best, stuck)
        if worst is None or worst < tolerance or stuck >= 10:
            break
    return now, worst


def rake(cells: DataFrame, wanted: DataFrame, fraction: float, rounds: int = 200, tolerance: float = 1e-11,
         cells_per_task: int = CELLS_PER_TASK) -> DataFrame:
    """Cells (source, lang, topic, n) with x: the tokens to take, at most n, that sum to the targets of ``wanted``."""
    n, y = F.col("n"), F.col("y")
    nested = not wanted.filter("dim = 'topic' and within <> ''").isEmpty()
    keys = {"source": ["source"], "lang": ["lang"], "topic": ["lang", "topic"] if nested else ["topic"]}
    now, whole = cells.withColumn("n", F.col("n").cast("double")), F.lit(False)
    for d in DIMS:
        t = wanted.filter(F.col("dim") == d).select(
            *([F.col("within").alias("lang")] if len(keys[d]) > 1 else []), F.col("value").alias(d),
            F.col("target").alias(f"t_{d}"), F.col("full").alias(f"full_{d}"))
        now, whole = now.join(t, keys[d]), whole | F.col(f"full_{d}")
    # a value that is taken whole takes its cells whole
    now = stage(now.withColumn("y", n * fraction).withColumn("whole", whole).drop(*[f"full_{d}" for d in DIMS]))
    # few cells are raked in one task; many by grouped sums that are joined back, so no value's cells meet
    if now.count() < cells_per_task:
        ship(cells.sparkSession)

        def settle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            parts = list(batches)
            if not parts:
                return
            rows = pd.concat(parts, ignore_index=True)
            sides = [(rows.groupby(keys[d], sort=False).ngroup().to_numpy(), rows[f"t_{d}"].to_numpy()) for d in DIMS]
            took, miss = swept(rows["n"].to_numpy(), rows["y"].to_numpy(), rows["whole"].to_numpy(bool), sides, rounds, tolerance)
            yield rows.assign(y=took, off=miss)

        now = stage(now.coalesce(1).mapInPandas(settle, now.withColumn("off", F.lit(0.0)).schema))
        worst = now.agg(F.max("off")).first()[0]
    else:
        now, worst = _rake_apart(now, keys, rounds, tolerance)
    if worst is not None and worst >= 1e-6:
        logging.getLogger(__name__).warning("raking ended with a marginal off its target by a share of %g", worst)
    return now.select(*DIMS, "n", F.when(F.col("whole") | (y >= n), n).otherwise(y).alias("x"))


def _planned(rows: DataFrame, fraction: float, targets: Mapping[str, Mapping[str, float]] | None,
             temper: float) -> tuple[DataFrame, DataFrame]:
    """(targets, raked cells) of described rows; logs the targets out of reach."""
    cells = stage(rows.groupBy(*DIMS).agg(F.sum("tokens").alias("n")))
    wanted = goals(cells, fraction, targets, temper)
    lowered = wanted.filter("full").count()
    if lowered:
        logging.getLogger(__name__).warning("%d targets are out of reach of any sample of this size; see mixing.plan", lowered)
    return wanted, stage(rake(cells, wanted, fraction))


def plan(docs: DataFrame, fraction: float = 0.7, targets: Mapping[str, Mapping[str, float]] | None = None,
         temper: float = 0.7, seed: str = "mix", id_col: str = "doc_id", text_col: str = "text",
         source_col: str = "source", lang_col: str = "lang") -> DataFrame:
    """Every target as shares of the sample: dim, lang (of a topic), value, wanted, target (what can be reached), reached, full."""
    rows = described(docs, id_col, text_col, source_col, lang_col, seed, [id_col])
    wanted, cells = _planned(rows, fraction, targets, temper)
    budget = F.lit(cells.agg(F.sum("n")).first()[0] or 0.0) * fraction
    shares = Window.partitionBy("dim", "within")  # values of one kind
    free = F.col("total") * F.col("share") / F.nullif(F.sum("share").over(shares), F.lit(0.0))
    out = wanted.select("dim", "within", "value", (free / budget).alias("wanted"), (F.col("target") / budget).alias("target"), "full")
    nested = out.filter("dim = 'topic' and within <> ''").isEmpty()
    parts = [cells.groupBy(F.lit(d).alias("dim"), (F.lit("") if d != "topic" or nested else F.col("lang")).alias("within"),
                           F.col(d).alias("value")).agg((F.sum("x") / budget).alias("reached")) for d in DIMS]
    return (out.join(reduce(DataFrame.unionByName, parts), ["dim", "within", "value"])
            .select("dim", F.col("within").alias("lang"), "value", "wanted", "target", "reached", "full"))


def mix(docs: DataFrame, fraction: float = 0.7, targets: Mapping[str, Mapping[str, float]] | None = None,
        temper: float = 0.7, seed: str = "mix", id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source", lang_col: str = "lang", columns: Sequence[str] | None = None) -> DataFrame:
    """Rows (doc: ``columns`` of the document, or all, as one struct, source, lang, topic, tokens, weight of a token, p, selected)."""
    rows = described(docs, id_col, text_col, source_col, lang_col, seed, columns)
    cells = _planned(rows, fraction, targets, temper)[1]
    p = F.when(F.col("n") > 0, F.least(F.lit(1.0), F.col("x") / F.col("n"))).otherwise(1.0)
    done = cells.select(*DIMS, p.alias("p"), F.when(F.col("n") > 0, p / fraction).otherwise(1.0).alias("weight"))
    return rows.join(done, list(DIMS)).select("doc", *DIMS, "tokens", "weight", "p", (F.col("u") < F.col("p")).alias("selected"))


def sample(docs: DataFrame, **options) -> DataFrame:
    """The documents that :func:`mix` selects, with the columns of ``docs``."""
    return mix(docs, **options).filter("selected").select("doc.*")
