"""SimHash near-dedup by anchor-point covering.

Anchors are the words of a covering code of the 64-bit space: two blocks of 23
bits carry the perfect binary Golay code (covering radius 3 each, 2^12 words),
the other 18 bits are left free, so there are 2^24 anchors. Let x and y differ
in d <= 3 bits. Some z on the way from x to y is within 1 bit of x and 2 of y;
z has an anchor within radius 3 per block, so x lies within radius + 1 and y
within radius + 2 of that anchor (the excess summed over both blocks). Every
distinct fingerprint is therefore replicated to all anchors within covering
radius + 2 (68 of them on average), and each pair within 3 bits meets at one.

Only distinct fingerprints are replicated: copies, and all texts that share a
fingerprint, are one node. Per anchor the bits are compared and the links of a
spanning forest are reported, never all pairs of a dense group. An anchor with
more than ``cell_rows`` fingerprints is dealt over a grid of cells, each of
which compares two of its slices, so no task holds a hot anchor whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fjord.llm.common import keep_rows, row_key, ship, stage
from fjord.llm.components import components

MAX_BITS = 3
SHINGLE_WORDS = 3
SEED = 42
BLOCK_BITS = 23
GENERATOR = 0b101011100011  # x^11 + x^9 + x^7 + x^6 + x^5 + x + 1: the binary Golay code's polynomial
HASHES_AT_ONCE = 1 << 16


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """SimHash of the word shingles, unsigned; 0 for a text without words (or null)."""
    w = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not w:
        return 0
    joined = b" ".join(w)
    ends = np.cumsum(np.fromiter(map(len, w), np.int64, len(w)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(w) > words:
        starts, ends = starts[: len(w) - words + 1], ends[words - 1:]
    else:
        starts, ends = starts[:1], ends[-1:]
    n, counts, h = len(starts), np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for at in range(0, n, HASHES_AT_ONCE):
        a, b = starts[at:at + HASHES_AT_ONCE].tolist(), ends[at:at + HASHES_AT_ONCE].tolist()
        hashes = np.array([h(joined[i:j], SEED) for i, j in zip(a, b, strict=True)], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Rows (id, __x: row_key, fp: the fingerprint as a signed long), one per document."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            fp = np.fromiter((fingerprint(t, words) for t in b["t"]), np.uint64, len(b))
            yield pd.DataFrame({"i": b["i"], "__x": b["__x"], "fp": fp.view(np.int64)})

    # the id goes as text: pandas would turn longs beside a null into doubles
    rows = docs.select(F.col(id_col).cast("string").alias("i"), row_key(text_col).alias("__x"),
                       F.col(text_col).alias("t"))
    return (rows.mapInPandas(run, "i string, __x long, fp long")
            .select(F.col("i").cast("long").alias(id_col), "__x", "fp"))


@lru_cache(maxsize=1)
def golay() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All 23-bit vectors of weight <= 5 by syndrome: (vectors, excess over radius 3, first of each syndrome)."""
    vectors = [np.zeros(1, np.int64)]
    layer = [(0, -1)]
    for _ in range(5):
        layer = [(v | 1 << i, i) for v, last in layer for i in range(last + 1, BLOCK_BITS)]
        vectors.append(np.array([v for v, _ in layer], np.int64))
    excess = np.concatenate([np.full(len(v), max(0, weight - 3)) for weight, v in enumerate(vectors)])
    v = np.concatenate(vectors)
    s = syndrome(v)
    order = np.lexsort((excess, s))
    first = np.searchsorted(s[order], np.arange(2049))
    return v[order], excess[order].astype(np.int8), first


def syndrome(block: np.ndarray) -> np.ndarray:
    """Remainder of 23-bit vectors modulo the generator polynomial (11 bits)."""
    r = block.astype(np.int64).copy()
    for bit in range(BLOCK_BITS - 1, 10, -1):
        r ^= np.where(r >> bit & 1, GENERATOR << (bit - 11), 0)
    return r


def _near(block: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, message of each code word within radius + 2, excess) of every 23-bit block."""
    v, excess, first = golay()
    s = syndrome(block)
    n = first[s + 1] - first[s]
    row = np.repeat(np.arange(len(block)), n)
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[s], n)
    return row, (block[row] ^ v[at]) >> 11, excess[at]


def anchors(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, anchor) for every anchor within covering radius + 2 of each unsigned fingerprint."""
    mask = np.uint64((1 << BLOCK_BITS) - 1)
    ra, wa, ea = _near((fp & mask).astype(np.int64))
    rb, wb, eb = _near((fp >> np.uint64(BLOCK_BITS) & mask).astype(np.int64))
    # every word of the first block with every word of the second, per fingerprint
    nb = np.bincount(rb, minlength=len(fp))
    start = np.cumsum(nb) - nb
    n = nb[ra]
    left = np.repeat(np.arange(len(ra)), n)
    right = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(start[ra], n)
    ok = ea[left] + eb[right] <= 2
    left, right = left[ok], right[ok]
    return ra[left], wa[left] << 12 | wb[right]


def forest(fp: np.ndarray, group: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect, within each group, all fingerprints that are chained by <= max_bits.

    ``group`` is sorted. Small groups report each of their pairs that links;
    of a large one every fingerprint is compared with those not reached yet,
    and only the links of the search tree are reported. No rows give no links.
    """
    if not len(fp):
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    out_u, out_v = [], []
    edge = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1], [True])))
    size = np.diff(edge)
    small = np.repeat(size <= 16, size)
    f, g = fp[small], group[small]
    for k in range(1, 16):
        if len(f) <= k:
            break
        same = np.flatnonzero(g[k:] == g[:-k])
        if not len(same):
            break
        hit = same[np.bitwise_count(f[same] ^ f[same + k]) <= max_bits]
        out_u.append(f[hit])
        out_v.append(f[hit + k])
    for at in np.flatnonzero(size > 16):
        rest = np.unique(fp[edge[at]:edge[at + 1]])
        while len(rest):
            queue, rest = [rest[0]], rest[1:]
            while queue and len(rest):
                u = queue.pop()
                near = np.bitwise_count(rest ^ u) <= max_bits
                if near.any():
                    found, rest = rest[near], rest[~near]
                    out_u.append(np.full(len(found), u, np.uint64))
                    out_v.append(found)
                    queue.extend(found)
    if not out_u:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    u, v = np.concatenate(out_u), np.concatenate(out_v)
    keep = u != v
    both = np.unique(np.stack([np.minimum(u, v)[keep], np.maximum(u, v)[keep]], axis=1), axis=0)
    return both[:, 0], both[:, 1]


def links(distinct: DataFrame, max_bits: int = MAX_BITS, cell_rows: int = 5000) -> DataFrame:
    """Links (u, v) between distinct fingerprints (column fp) that join all within ``max_bits`` (<= 3)."""
    if max_bits > MAX_BITS:
        raise ValueError("the anchors cover distances up to 3 bits")

    def replicate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            fp = b["fp"].to_numpy().view(np.uint64)
            row, anchor = anchors(fp)
            yield pd.DataFrame({"anchor": anchor.astype(np.int32), "fp": fp[row].view(np.int64)})

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fp, key = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for b in batches:  # sorted by cell; the last cell may go on in the next batch, and in several
            fp = np.concatenate([fp, b["fp"].to_numpy().view(np.uint64)])
            key = np.concatenate([key, b["cell"].to_numpy()])
            done = int(np.searchsorted(key, key[-1])) if len(key) else 0
            if not done:
                continue
            u, v = forest(fp[:done], key[:done], max_bits)
            yield pd.DataFrame({"u": u.view(np.int64), "v": v.view(np.int64)})
            fp, key = fp[done:], key[done:]
        u, v = forest(fp, key, max_bits)
        yield pd.DataFrame({"u": u.view(np.int64), "v": v.view(np.int64)})

    replicas = stage(distinct.select("fp").mapInPandas(replicate, "anchor int, fp long"))
    hot = stage(replicas.groupBy("anchor").count().filter(F.col("count") > cell_rows)
                .select("anchor", F.ceil(F.col("count") / cell_rows).cast("int").alias("k")))
    dealt = replicas.join(hot, "anchor", "left")
    slice_ = F.pmod(F.xxhash64("fp"), F.col("k")).cast("int")
    cells = F.when(F.col("k").isNull(), F.array(F.lit(0))).otherwise(F.transform(
        F.sequence(F.lit(0), F.col("k") - 1),
        lambda j: F.least(j, F.col("s")) * 65536 + F.greatest(j, F.col("s"))))
    dealt = (dealt.withColumn("s", slice_)
             .select((F.col("anchor").cast("long") * (1 << 32)).alias("a"), "fp", F.explode(cells).alias("c"))
             .select((F.col("a") + F.col("c")).alias("cell"), "fp"))
    return (dealt.repartition("cell").sortWithinPartitions("cell")
            .mapInPandas(compare, "u long, v long"))


def _rooted(docs: DataFrame, words: int, max_bits: int, id_col: str, text_col: str) -> DataFrame:
    """Per document: id, __x (row_key), fp, root (a fingerprint that names the group) and component_id."""
    prints = stage(fingerprints(docs, words, id_col, text_col))
    nodes = stage(prints.groupBy("fp").agg(F.min(id_col).alias("least")))
    joined = components(links(nodes, max_bits))
    member = stage(nodes.join(joined, nodes.fp == joined.node, "left")
                   .select("fp", F.coalesce("root", "fp").alias("root"), "least"))
    least = stage(member.groupBy("root").agg(F.min("least").alias("component_id")))
    named = stage(member.join(least, "root").select("fp", "root", "component_id"))
    return prints.join(named, "fp")


def near_groups(docs: DataFrame, words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """Per document: id, fp (signed long) and component_id, the smallest id reachable by links of <= max_bits.

    Defined cases: a null, empty or blank text has fingerprint zero and links
    like any other; a text with fewer words is one shingle; repeated rows each
    get a row; a null id takes part but is never a component_id while a
    non-null id is reachable; an empty table gives no rows; other columns are
    ignored.
    """
    return _rooted(docs, words, max_bits, id_col, text_col).select(id_col, "fp", "component_id")


def drop_near_copies(docs: DataFrame, words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
                     id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each group: the smallest id (nulls last), then the smallest text hash."""
    rows = stage(_rooted(docs, words, max_bits, id_col, text_col))
    order = F.struct(F.col(id_col).isNull().alias("a"), F.col(id_col).alias("__i"), "__x")
    best = stage(rows.groupBy("root").agg(F.min(order).alias("b")).select("root", "b.__i", F.col("b.__x").alias("__y")))
    chosen = rows.join(best, "root").filter(F.col(id_col).eqNullSafe(F.col("__i")) & (F.col("__x") == F.col("__y")))
    keep = stage(chosen.groupBy("__i", "__x").agg(F.count("*").alias("__n")))
    return keep_rows(docs, keep, id_col, text_col)
