"""Retrieval over documents and vectors, as Spark jobs.

* exact top-k nearest vectors: the (size-checked) query batch is shipped to
  every vector partition; each task computes distances with numpy and keeps
  its own top k per query, then the candidates (queries × k × partitions) are
  ranked once;
* TF-IDF cosine top-k against a stored inverted index (``textindex``);
* documents: gold tables rendered as JSON text (first 50 rows each).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fjord.functions.constants import ANSWER_PREFIX, ANSWER_SUFFIX
from fjord.functions.exprs import ident
from fjord.operators import textindex
from fjord.operators.kbest import KBest, tile_rows, top_k_per_group
from fjord.operators.textindex import term_counts  # noqa: F401  (part of this module's interface)
from fjord.session import ship_package

MAX_BROADCAST_QUERIES = 10_000


def centroids(vectors: DataFrame, group: str = "label", vec: str = "embedding") -> DataFrame:
    """Per-group mean vector (one row per group): the query set for the demo."""
    exploded = vectors.select(group, F.posexplode(vec).alias("pos", "x"))
    means = exploded.groupBy(group, "pos").agg(F.avg("x").alias("x"))
    return means.groupBy(group).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "x"))), lambda e: e["x"]).alias(vec))


def _query_matrix(queries: DataFrame, qid: str, vec: str, limit: int):
    """The query batch as (ids, float64 matrix), or None when it has more than ``limit`` rows.

    Only a bounded batch travels to the tasks, as a broadcast variable; the
    vector table never leaves its partitions.
    """
    q = queries.select(F.col(qid).alias("qid"), F.col(vec).cast("array<double>").alias("v"))
    rows = q.limit(limit + 1).collect()
    if len(rows) > limit:
        return None
    ids = np.array([r["qid"] for r in rows])
    mat = np.array([r["v"] for r in rows], dtype=np.float64).reshape(len(rows), -1 if rows else 0)
    return ids, mat


_BLOCK_ELEMENTS = 2_000_000  # bound on one numpy temporary (rows × queries × dims), 16 MB


def _distances(vm: np.ndarray, qm: np.ndarray, metric: str) -> np.ndarray:
    """rows × queries distances: squared L2 (exact differences, in blocks of both) or −cosine."""
    if metric != "l2":
        vn = np.linalg.norm(vm, axis=1)[:, None]
        qn = np.linalg.norm(qm, axis=1)[None, :]
        with np.errstate(invalid="ignore", divide="ignore"):
            return -(vm @ qm.T) / np.where(vn * qn == 0, np.nan, vn * qn)
    some = max(1, min(qm.shape[0], _BLOCK_ELEMENTS // max(1, qm.shape[1])))
    step = max(1, _BLOCK_ELEMENTS // max(1, some * qm.shape[1]))
    out = np.empty((vm.shape[0], qm.shape[0]))
    for i in range(0, vm.shape[0], step):
        for j in range(0, qm.shape[0], some):
            diff = vm[i:i + step, None, :] - qm[None, j:j + some, :]
            out[i:i + step, j:j + some] = np.einsum("vqd,vqd->vq", diff, diff)
    return out


def _partition_top_k(q_bc, k: int, vid: str, vec: str, keep: list[str], metric: str):
    """A ``mapInPandas`` function: this task's k best vectors per query.

    Vectors meet the query batch a tile at a time, so a task holds one tile of
    distances and the running k best per query, in the final order (distance,
    vector id), whatever the size of the batch or of the Arrow batches. It emits
    at most queries × k rows. The global top k of a query is always inside the
    top k of the task that holds it, so the cut is exact.
    """

    def run(batches):
        ids, qm = q_bc.value
        best, step = KBest(len(ids), k, vid), tile_rows(len(ids))
        for pdf in batches if len(ids) else []:
            for at in range(0, len(pdf), step):
                part = pdf.iloc[at:at + step]
                vm = np.stack(part[vec].map(lambda a: np.asarray(a, dtype=np.float64)).to_numpy())
                dist = _distances(vm, qm, metric)
                best.add(np.where(np.isnan(dist), np.inf, dist), part[keep])
        if best.frame is not None:
            out = best.frame
            key = out.pop("__key")
            out.insert(0, "__qid", ids[out.pop("__q").to_numpy()])
            out["distance"] = key.where(np.isfinite(key))
            yield out

    return run


def nearest_vectors(vectors: DataFrame, queries: DataFrame, k: int = 3, qid: str = "query_id",
                    vid: str = "vec_id", vec: str = "embedding", metric: str = "l2",
                    max_queries: int = MAX_BROADCAST_QUERIES) -> DataFrame:
    """Exact k nearest vectors for every query row.

    Every query must meet every vector for an exact answer. The query batch
    (at most ``max_queries`` rows at once, larger sets go in chunks) is shipped to the tasks; each task
    scans its vector partitions in place and emits only its own top k per
    query. The final cut ranks at most queries × k × partitions candidates,
    so no query × vector pair is ever materialised or shuffled.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    batch = _query_matrix(queries, qid, vec, max_queries)
    if batch is None:
        return nearest_vectors_chunked(vectors, queries, k, qid, max_queries, vid=vid, vec=vec, metric=metric)
    q_bc = spark.sparkContext.broadcast(batch)
    keep = [c for c in vectors.columns if c != vec]
    qtype = queries.schema[qid].dataType.simpleString()
    out_schema = ", ".join([f"__qid {qtype}"] + [f"`{c}` {vectors.schema[c].dataType.simpleString()}" for c in keep]
                           + ["distance double"])
    cands = vectors.filter(F.col(vec).isNotNull()).mapInPandas(_partition_top_k(q_bc, k, vid, vec, keep, metric), out_schema)
    cands = cands.withColumnRenamed("__qid", qid)
    order = [F.col("distance").asc_nulls_last(), F.col(vid).asc()]
    return top_k_per_group(cands, [qid], order, k)


def nearest_vectors_chunked(vectors: DataFrame, queries: DataFrame, k: int = 3, qid: str = "query_id",
                            chunk_rows: int = MAX_BROADCAST_QUERIES, **kw) -> DataFrame:
    """Exact top-k for a query set of any size: the batch is shipped in bounded chunks."""
    n = queries.count()
    chunks = max(1, math.ceil(n / chunk_rows))
    tagged = queries.withColumn("__chunk", F.pmod(F.xxhash64(qid), F.lit(chunks)))
    # a hash split is uneven: give each chunk headroom over the mean
    bound = max(chunk_rows, 2 * math.ceil(n / chunks))
    parts = [nearest_vectors(vectors, tagged.filter(F.col("__chunk") == c).drop("__chunk"), k, qid,
                             max_queries=bound, **kw) for c in range(chunks)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ------------------------------------------------------------------ text
def tfidf_top_k(docs: DataFrame, questions: DataFrame, k: int = 3, doc_key: str = "doc_id",
                text: str = "text", q_key: str = "question_id", q_text: str = "question") -> DataFrame:
    """R2 + R3 in one go: an index of ``docs`` in a scratch folder, and the questions against it.

    For more than one question batch build the index once (``textindex.build``) and ask it (``textindex.search``).
    """
    spark = docs.sparkSession
    path = textindex.build(docs, textindex.scratch_folder(spark), doc_key, text)
    return textindex.search(spark, path, questions, k, doc_key, q_key, q_text)


def answer_context(ranked: DataFrame, docs: DataFrame, questions: DataFrame | None = None,
                   q_key: str = "question_id", doc_key: str = "doc_id", text: str = "text",
                   q_text: str = "question", n_answer_docs: int = 2) -> DataFrame:
    """Context in rank order and the template answer from the first two texts.

    The ranked list has k rows per question of the batch; it travels to the
    texts (broadcast join), so the texts stay where they are but for the ranked
    ones. With ``questions`` every question gets a row and its text, as in the
    reference: one without context gets an empty context and the bare template.
    """
    joined = docs.select(doc_key, text).join(F.broadcast(ranked.select(q_key, doc_key, "rank")), doc_key)
    per_q = joined.groupBy(q_key).agg(
        F.array_sort(F.collect_list(F.struct("rank", F.col(doc_key).alias("id"), F.col(text).alias("t"))))
        .alias("ctx"))
    keep = [q_key]
    if questions is not None:
        per_q = questions.select(q_key, q_text).join(per_q, q_key, "left")
        keep.append(q_text)
    ctx = F.coalesce(F.col("ctx"), F.array().cast(per_q.schema["ctx"].dataType))
    ids_text = F.array_join(F.transform(ctx, lambda e: e["id"].cast("string")), ",")
    first = F.array_join(F.transform(F.slice(ctx, 1, n_answer_docs), lambda e: e["t"]), " ")
    return per_q.select(*keep, ids_text.alias("context_ids"),
                        F.concat(F.lit(ANSWER_PREFIX), first, F.lit(ANSWER_SUFFIX)).alias("answer"))


# ------------------------------------------------------------------ documents
def rows_document(df: DataFrame, doc_id: str, order: Sequence[str], n: int = 50) -> DataFrame:
    """A17 + L3: first ``n`` rows by ``order`` as one JSON array text; numbers stay numbers, all their digits.

    ``orderBy().limit(n)`` is a per-partition top-n then a merge of n-row
    lists, so the document costs n rows on one task, never the table.
    """
    head = df.orderBy(*order).limit(n)
    w = Window.orderBy(*order)  # over n rows only
    numbered = head.select(F.row_number().over(w).alias("__i"), F.to_json(F.struct(*[F.col(ident(c)) for c in df.columns]), {"ignoreNullFields": "false"}).alias("__j"))
    return numbered.agg(
        F.concat(F.lit("["), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("__i", "__j"))),
                                                       lambda e: e["__j"]), ","), F.lit("]")).alias("text")
    ).select(F.lit(doc_id).alias("id"), "text", F.lit(f"gold/{doc_id}").alias("source"))
