"""A stored inverted index of a document table, and top-k questions against it.

An index is a folder of four Parquet tables, built once per version of the documents:

* ``postings/bucket=<b>``  term, df, block, chunk, at, tf; a bucket holds the terms of one hash range, sorted by term
* ``terms/bucket=<b>``     term, df: the number of documents that hold the term
* ``docs``                 doc, norm, chunk, at; norm: length of its TF-IDF vector, idf = ln((N + 1) / (df + 1))
* ``stats``                n_docs, buckets, and what the index was built from; written last, it makes the index whole

A chunk is a bounded run of whole documents, as a task met them; a document is
named by its chunk and its place ``at`` in it. A row of the postings is a block:
all documents of one chunk that hold one term, as the two lists ``at`` and ``tf``.
``block`` numbers a term's rows, and one row of each chunk lists its ``docs``.

A question batch reads the buckets of its own terms only (partition pruning) and
in them, for a batch of few terms, the row groups that can hold these. The
postings it reads come together by document as (term number, weight), so what is
shuffled depends on the documents and the asked terms, not on how many questions
ask for them. The questions are a flat index (offsets per term number, question
numbers, weights), bounded per batch and sent to the tasks, where each document
meets it once and every question's k best survive.

Products are summed in order of the term and squares in order of their size, so
equal texts score equal to the last bit, whatever the partitioning. A posting is
shuffled once to its bucket and once back to its chunk, both times within a
block; frequencies are counted where a bucket's blocks are, so no join of all
postings with all terms is needed, however many terms there are.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fjord.operators.kbest import KBest, tile_rows, top_k_per_group
from fjord.session import ensure_checkpoint_dir, ship_package

TOKEN = r"[\p{L}\p{N}]+"  # a term: a maximal run of letters / digits
_SEPARATOR = r"[^\p{L}\p{N}]+"
MAX_QUESTIONS = 10_000  # questions that meet the postings at once
MAX_ENTRIES = 2_000_000  # (question, term) pairs that do: 32 MB in every task
CHUNK_POSTINGS = 2_000_000  # a chunk is closed at the document that reaches them: some 100 MB in a task
CHUNK_BYTES = 256 << 20  # or these, where terms are long
CHUNK_DOCS = 1 << 15  # or at so many documents: places are 16 bits
MAX_REPEATED = 500_000  # ids in several rows that are sent to the texts; beyond that both are shuffled
LAYOUT = 2  # of the folder; an index of another one is built anew
STATS = "n_docs long, buckets int, doc_type string, source string, layout int"
PUSHED_TERMS = 1_000  # up to here the asked terms themselves are pushed to the scan


def tokens(text: Column) -> Column:
    """Lower-cased letter/digit runs of the whole text.

    Splitting on the separator class yields exactly the runs of ``TOKEN`` plus
    an empty string where the text starts or ends with a separator (filtered
    by ``term_counts``); it is ~2.5x faster than ``regexp_extract_all``.
    """
    return F.split(F.lower(text), _SEPARATOR)


def term_counts(docs: DataFrame, key: str, text: str, repeated: DataFrame | None = None) -> DataFrame:
    """(key, term, tf) — a partially aggregated count, so hot terms cost one row per task.

    With ``repeated`` (the keys that stand in several rows) the terms of all other
    rows are counted where they are: sorted in the row, a term's count is the
    distance to where the next one starts. Only those of repeated keys are shuffled,
    and then brought together, so that a key's terms always follow each other in one task.
    """
    if repeated is not None:
        known = repeated.limit(MAX_REPEATED + 1).count()
        repeated = F.broadcast(repeated) if known <= MAX_REPEATED else repeated
        once = docs.join(repeated, key, "left_anti") if known else docs
        words, starts = F.col("__words"), F.col("__starts")  # used more than once each, so computed once a row
        last = F.greatest(F.size(words) - 1, F.lit(0))
        changes = F.filter(F.sequence(F.lit(0), last), lambda i: ~F.get(words, i).eqNullSafe(F.get(words, i - 1)))
        runs = F.transform(starts, lambda s, j: F.struct(
            F.get(words, s).alias("term"), (F.coalesce(F.get(starts, j + 1), F.size(words)) - s).cast("long").alias("tf")))
        counted = (once.select(F.col(key).alias("__key"), F.array_sort(tokens(F.col(text))).alias("__words"))
                       .withColumn("__starts", changes)
                       .select("__key", F.inline(runs)).filter(F.col("term") != "")
                       .withColumnRenamed("__key", key))
        if once is docs:
            return counted
        several = term_counts(docs.join(repeated, key, "left_semi"), key, text)
        return counted.unionByName(several.repartition(key).sortWithinPartitions(key, "term"))
    return (docs.select(F.col(key).alias("__key"), F.explode(tokens(F.col(text))).alias("term"))
                .filter(F.col("term") != "")
                .groupBy("__key", "term").agg(F.count(F.lit(1)).alias("tf"))
                .withColumnRenamed("__key", key))


def _bucket(term: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(buckets)).cast("int")


def scratch_folder(spark: SparkSession) -> str:
    """A fresh index folder below ``spark.checkpoint.dir``, which all executors share."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/fjord-index/{uuid.uuid4().hex}"


def build(docs: DataFrame, path: str, doc_key: str = "doc_id", text: str = "text", buckets: int | None = None,
          source: str = "") -> str:
    """Write the index of ``docs`` to the new folder ``path``; documents without an id are not indexed.

    Terms are counted in the document's row, but for ids that stand in several rows.
    A task packs them to blocks before they go to their bucket, so a hot term is a
    row per chunk there, and its frequency is the sum over these rows.
    """
    spark = docs.sparkSession
    ship_package(spark)
    buckets = buckets or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    docs = docs.filter(F.col(doc_key).isNotNull())
    doc_type = docs.schema[doc_key].dataType.simpleString()
    ids = docs.groupBy(doc_key).agg(F.count(F.lit(1)).alias("rows"))
    n_docs = ids.count()
    counted = term_counts(docs, doc_key, text, ids.filter("rows > 1").select(doc_key)).select(
        _bucket(F.col("term"), buckets).alias("bucket"), "term", F.col(doc_key).alias("doc"), "tf")
    blocks = counted.mapInArrow(_blocks, f"bucket int, term string, chunk long, at array<short>, tf array<long>, docs array<{doc_type}>")
    of_term = Window.partitionBy("bucket", "term").orderBy("chunk")
    df = F.sum(F.size("at").cast("long")).over(of_term.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    (blocks.repartition("bucket").withColumns({"df": df, "block": F.row_number().over(of_term)})
           .sortWithinPartitions("bucket", "term").write.partitionBy("bucket").parquet(f"{path}/postings"))
    postings = _read(spark, path, "postings", doc_type)
    (postings.filter("block = 1").select("bucket", "term", "df").hint("rebalance", "bucket").sortWithinPartitions("bucket", "term")
             .write.partitionBy("bucket").parquet(f"{path}/terms"))

    squares = postings.select("chunk", "docs", "at", "tf", _idf(F.lit(n_docs)).alias("idf")).groupBy("chunk").applyInArrow(
        _chunk_squares, f"doc {doc_type}, s double, chunk long, at short").repartition("doc")
    whole = F.when(F.count(F.lit(1)) == 1, F.array_sort(F.collect_list("s"))).otherwise(
        F.raise_error(F.lit("a document lies in two chunks: the documents changed while they were read")))
    norm = F.sqrt(F.aggregate(whole, F.lit(0.0), lambda acc, s: acc + s))
    (squares.groupBy("doc").agg(norm.alias("norm"), F.min("chunk").alias("chunk"), F.min("at").alias("at"))
            .write.parquet(f"{path}/docs"))
    stats = spark.createDataFrame([(n_docs, buckets, doc_type, source, LAYOUT)], STATS)
    stats.coalesce(1).write.parquet(f"{path}/stats")
    return path


def is_of(spark: SparkSession, path: str, source: str) -> bool:
    """Whether the index at ``path`` was built from ``source``, in the layout that is read here."""
    stats = spark.read.schema(STATS).parquet(f"{path}/stats").first()
    return stats.source == source and stats.layout == LAYOUT


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (bucket, term, doc, tf), a document's together, as blocks of chunks of whole documents."""
    task, made, held, rows, size = TaskContext.get().partitionId(), 0, [], 0, 0
    full, wide = CHUNK_POSTINGS, CHUNK_BYTES

    def chunks(counted: pa.Table, starts: np.ndarray):
        nonlocal made
        for i in range(0, len(starts) - 1, CHUNK_DOCS):
            of = starts[i:i + CHUNK_DOCS + 1]
            yield from _chunk_blocks(counted.slice(of[0], of[-1] - of[0]), of - of[0], (task << 33) + made)
            made += 1

    for b in batches:
        held.append(b)
        rows, size = rows + b.num_rows, size + b.nbytes
        if rows >= full or size >= wide:
            counted = pa.Table.from_batches(held).combine_chunks()
            starts = _starts(counted["doc"])
            yield from chunks(counted, starts)  # the last document may go on
            held = counted.slice(starts[-1]).to_batches()
            rows, size = sum(h.num_rows for h in held), sum(h.nbytes for h in held)
            full, wide = max(CHUNK_POSTINGS, 2 * rows), max(CHUNK_BYTES, 2 * size)
    if rows:
        counted = pa.Table.from_batches(held).combine_chunks()
        yield from chunks(counted, np.append(_starts(counted["doc"]), rows))


def _starts(doc: pa.ChunkedArray) -> np.ndarray:
    return np.append(0, 1 + np.flatnonzero(pc.not_equal(doc.slice(1), doc.slice(0, len(doc) - 1)).to_numpy()))


def _chunk_blocks(counted: pa.Table, starts: np.ndarray, chunk: int) -> Iterator[pa.RecordBatch]:
    """One row per term of a chunk, whose documents begin at ``starts`` (the end included); the first one lists them."""
    coded = counted["term"].combine_chunks().dictionary_encode()
    of_term, n = coded.indices.to_numpy(), len(coded.dictionary)
    order = np.argsort(of_term, kind="stable")
    ends = np.append(0, np.cumsum(np.bincount(of_term, minlength=n))).astype(np.int32)
    at = np.arange(len(starts) - 1, dtype=np.int16).repeat(np.diff(starts))
    docs = pa.ListArray.from_arrays(np.append(0, np.full(n, len(starts) - 1)).astype(np.int32),
                                    counted["doc"].take(pa.array(starts[:-1])).combine_chunks(), mask=pa.array(np.arange(n) > 0))
    yield from pa.table({
        "bucket": pa.array(counted["bucket"].to_numpy()[order[ends[:-1]]], pa.int32()), "term": coded.dictionary,
        "chunk": pa.array(np.full(n, chunk)), "at": pa.ListArray.from_arrays(ends, at[order]),
        "tf": pa.ListArray.from_arrays(ends, counted["tf"].to_numpy()[order]), "docs": docs,
    }).to_batches(10_000)


def _chunk_squares(blocks: pa.Table) -> pa.Table:
    """(doc, sum of the squares of its weights, smallest first) of all blocks (docs, at, tf, idf) of a chunk."""
    at = pc.list_flatten(blocks["at"]).to_numpy()
    w = pc.list_flatten(blocks["tf"]).to_numpy() * blocks["idf"].to_numpy().repeat(pc.list_value_length(blocks["at"]).to_numpy())
    docs = pc.list_flatten(blocks["docs"])
    s = w * w
    order = np.lexsort((s, at))
    total = np.bincount(at[order], weights=s[order], minlength=len(docs))  # one after the other: in order
    return pa.table({"doc": docs, "s": total, "chunk": pa.repeat(blocks["chunk"][0], len(docs)),
                     "at": pa.array(np.arange(len(docs)), pa.int16())})


def _idf(n_docs: Column) -> Column:
    return F.log((n_docs + 1) / (F.col("df") + 1))


def _read(spark: SparkSession, path: str, name: str, doc_type: str) -> DataFrame:
    columns = {"postings": f"term string, df long, block int, chunk long, at array<short>, tf array<long>, docs array<{doc_type}>, bucket int",
               "terms": "term string, df long, bucket int", "docs": f"doc {doc_type}, norm double, chunk long, at short"}
    return spark.read.schema(columns[name]).parquet(f"{path}/{name}")


class Questions:
    """A bounded batch as flat arrays: the questions of term number t are ``question[offsets[t]:offsets[t + 1]]``."""

    def __init__(self, ids: list, rows: list[tuple]):
        """``rows``: (number of the question, number of the term, weight), sorted by term, then question."""
        self.ids = ids
        question, term, weight = (np.array(x) for x in zip(*rows, strict=True))
        self.question, self.weight = question.astype(np.int64), weight.astype(np.float64)
        self.offsets = np.searchsorted(term, np.arange(term.max() + 2))
        norm = np.zeros(len(ids))
        np.add.at(norm, self.question, self.weight * self.weight)  # in order of the term
        self.norm = np.sqrt(norm)

    def dots(self, n: int, doc: np.ndarray, term: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(products, whether they share a term) of n documents with all questions; entries in order of document, term."""
        total, known = np.zeros(n * len(self.ids)), np.zeros(n * len(self.ids), bool)
        sizes = self.offsets[term + 1] - self.offsets[term]
        ends, at = np.cumsum(sizes), 0
        while at < len(term):  # so many entries that their questions fill a tile
            to = max(at + 1, int(np.searchsorted(ends, ends[at] - sizes[at] + tile_rows(1), side="right")))
            size = sizes[at:to]
            inner = np.arange(size.sum()) - (np.cumsum(size) - size).repeat(size)
            entry = self.offsets[term[at:to]].repeat(size) + inner
            cell = doc[at:to].repeat(size) * len(self.ids) + self.question[entry]
            np.add.at(total, cell, weight[at:to].repeat(size) * self.weight[entry])  # one after the other: in order
            known[cell] = True
            at = to
        return total.reshape(n, -1), known.reshape(n, -1)


def _meet(batch, k: int):
    """A ``mapInArrow`` function over (doc, norm, terms, weights): every question's k best documents of the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked: Questions = batch.value
        best, step, schema = KBest(len(asked.ids), k, "doc"), tile_rows(len(asked.ids)), None
        for b in batches:
            schema = b.schema.field("doc").type
            for at in range(0, b.num_rows, step):
                part = b.slice(at, step)
                sizes = part.column("terms").value_lengths().to_numpy()
                doc = np.arange(part.num_rows).repeat(sizes)
                dot, known = asked.dots(part.num_rows, doc, part.column("terms").flatten().to_numpy(),
                                        part.column("weights").flatten().to_numpy())
                length = part.column("norm").to_numpy()[:, None] * asked.norm[None, :]
                with np.errstate(divide="ignore", invalid="ignore"):
                    key = np.where(length == 0, np.inf, -dot / length)
                best.add(key, part.select(["doc"]).to_pandas(), known)
        if best.frame is not None:
            f = best.frame
            score = np.where(np.isinf(f["__key"]), np.nan, -f["__key"]) + 0.0
            yield pa.RecordBatch.from_arrays(
                [pa.array(f["__q"].to_numpy(), pa.int32()), pa.array(f["doc"], schema), pa.array(score, from_pandas=True)],
                names=["number", "doc", "score"])

    return run


def search(spark: SparkSession, path: str, questions: DataFrame, k: int = 3, doc_key: str = "doc_id",
           q_key: str = "question_id", q_text: str = "question", max_questions: int = MAX_QUESTIONS) -> DataFrame:
    """(question, document, score, rank), cosine similarity of TF-IDF vectors, top-k documents per question.

    Only postings of the asked terms are read. A batch of more than
    ``max_questions`` questions (or MAX_ENTRIES terms) goes in several parts,
    dealt by a hash of the question. The part's terms and weights are collected
    once; a question without a term of the corpus has no rows.
    """
    ship_package(spark)
    stats = spark.read.schema(STATS).parquet(f"{path}/stats").first()
    asked = term_counts(questions, q_key, q_text).select(
        F.col(q_key).alias("q"), "term", "tf", _bucket(F.col("term"), stats.buckets).alias("bucket"))
    parts, rows = 1, asked.limit(MAX_ENTRIES + 1).collect()  # as many as meet the postings at once
    if len(rows) > MAX_ENTRIES or len({r.q for r in rows}) > max_questions:
        size = asked.agg(F.count(F.lit(1)), F.countDistinct("q")).first()
        parts = max(2 * -(-size[0] // MAX_ENTRIES), -(-size[1] // max_questions), 2)
    out = None
    for p in range(parts):
        if parts > 1:
            rows = asked.filter(F.pmod(F.xxhash64("q"), F.lit(parts)) == p).collect()
        found = _search_part(spark, path, rows, stats, k, q_key, questions.schema[q_key].dataType.simpleString())
        if found is not None:
            out = found if out is None else out.unionByName(found)
    q_type = questions.schema[q_key].dataType.simpleString()
    if out is None:
        return spark.createDataFrame([], f"`{q_key}` {q_type}, `{doc_key}` {stats.doc_type}, score double, rank int")
    out = out.withColumnRenamed("doc", doc_key)
    return top_k_per_group(out, [q_key], [F.col("score").desc(), F.col(doc_key).asc()], k)


def asked_postings(spark: SparkSession, path: str, doc_type: str, wanted: list[tuple[int, str, int, float]]) -> DataFrame:
    """(doc, norm, terms, weights) of the documents that hold a wanted term (bucket, term, number, idf).

    It depends on the terms alone: however many questions ask for one, its postings move once.
    """
    names = [t for _, t, _, _ in wanted]
    postings = _read(spark, path, "postings", doc_type).filter(F.col("bucket").isin(sorted({b for b, *_ in wanted})))
    if len(names) <= PUSHED_TERMS:
        postings = postings.filter(F.col("term").isin(names))
    terms = spark.createDataFrame(wanted, "bucket int, term string, number int, idf double")
    hits = (postings.join(F.broadcast(terms), ["bucket", "term"])  # at most the terms of a bounded batch
            .select("chunk", "number", "idf", F.inline(F.arrays_zip("at", "tf")))
            .select("chunk", "at", "number", (F.col("tf") * F.col("idf")).alias("w"))
            .groupBy("chunk", "at").agg(F.array_sort(F.collect_list(F.struct("number", "w"))).alias("ts")))
    return hits.join(_read(spark, path, "docs", doc_type), ["chunk", "at"]).select(
        "doc", "norm", F.col("ts.number").alias("terms"), F.col("ts.w").alias("weights"))


def _search_part(spark: SparkSession, path: str, asked: list, stats, k: int, q_key: str, q_type: str) -> DataFrame | None:
    """The k best of every task for a bounded batch of rows (q, term, tf, bucket)."""
    of_term = {r.term: r.bucket for r in asked}
    terms = _read(spark, path, "terms", stats.doc_type).filter(F.col("bucket").isin(sorted(set(of_term.values()))))
    if len(of_term) <= PUSHED_TERMS:
        terms = terms.filter(F.col("term").isin(sorted(of_term)))
    else:
        terms = terms.join(F.broadcast(spark.createDataFrame(list(of_term.items()), "term string, bucket int")), ["bucket", "term"])
    idf = {r.term: r.idf for r in terms.select("term", _idf(F.lit(stats.n_docs)).alias("idf")).collect()}  # asked terms only
    if not idf:
        return None
    number = {t: i for i, t in enumerate(sorted(idf))}  # numbers run as the terms do
    known = sorted((number[r.term], r.q, r.tf) for r in asked if r.term in idf)
    ids = sorted({q for _, q, _ in known})
    place, names = {q: i for i, q in enumerate(ids)}, sorted(idf)
    batch = spark.sparkContext.broadcast(Questions(ids, [(place[q], t, tf * idf[names[t]]) for t, q, tf in known]))
    flat = asked_postings(spark, path, stats.doc_type, [(of_term[t], t, number[t], idf[t]) for t in names])
    best = flat.mapInArrow(_meet(batch, k), f"number int, doc {stats.doc_type}, score double")
    named = spark.createDataFrame(list(enumerate(ids)), f"number int, `{q_key}` {q_type}")  # as many rows as questions
    return best.join(F.broadcast(named), "number").select(q_key, "doc", "score")
