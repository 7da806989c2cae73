"""BPE encoding with reuse of content-defined chunks, and exact decoding.

A rolling hash over the last ``WINDOW`` bytes cuts every text into chunks at
places that depend on nearby content only, so a passage that many documents
share yields the same chunks in all of them.

1. One pass counts the hashes of all chunks. Those that occur more than once
   set bits in a bit set of fixed size.
2. A second pass reports the chunks that hit the bit set: hash, text, and the
   text key they belong to. Chunks that really repeat are encoded once, whoever
   shares them.
3. Texts with such chunks are joined with the ids of theirs; other texts never
   move. Shared chunks take the shared ids, what lies between them is encoded on
   the spot, and the parts are joined.

Encoding chunks apart can differ from encoding the text at the joins only. A
join is repaired by encoding again from the last cut before it that both sides
must have (white space after a word) to the first such cut behind it, with the
neighbouring pieces; the span grows piece by piece until what is encoded again
agrees with both neighbours, up to the whole text.

Defined cases: a null text counts as empty and has no ids; texts are keyed by a
64-bit hash and chunks are checked by a 128-bit hash before ids are taken, so a
key collision costs work, not correctness; repeated rows each get a row; an
empty table gives no rows; other columns are ignored but those in ``carry``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fjord.llm.common import SKETCH_BITS, bit_words, mark, row_key, ship, stage
from fjord.llm.tokens import ODD_SPACE, ByteEncoder, encoder

WINDOW = 16
CUT_BITS = 10  # a cut every 1,024 bytes on average, beyond the least size
LEAST, MOST = 256, 16_384
PIECE = re.compile(rb"\s*\S+|\s+")
MULTIPLIER = 0x9E3779B1
ROWS = 500  # texts handed on at once


def cuts(raw: bytes) -> list[int]:
    """Ends of the chunks of ``raw``: where the rolling hash says so, at a character's start."""
    n = len(raw)
    if n <= LEAST:
        return [n] if n else []
    b = np.frombuffer(raw, np.uint8)
    h, m, span = (b.astype(np.uint32) + 1) * np.uint32(0x85EBCA6B), MULTIPLIER, 1
    while span < WINDOW:  # hash of 2 * span bytes from two hashes of span bytes
        longer = h.copy()
        longer[span:] += h[:-span] * np.uint32(m)
        h, m, span = longer, m * m & 0xFFFFFFFF, span * 2
    found = np.flatnonzero(h >> np.uint32(32 - CUT_BITS) == 0) + 1
    out, last = [], 0
    for at in [*found[found < n].tolist(), n]:
        while at - last > MOST:
            last = _character(b, last + MOST)
            out.append(last)
        if at - last >= LEAST or at == n:
            at = at if at == n else _character(b, at)
            if at > last:
                out.append(at)
                last = at
    return out


def _character(b: np.ndarray, at: int) -> int:
    while at < len(b) and b[at] & 0xC0 == 0x80:
        at += 1
    return at


def chunks(raw: bytes) -> list[bytes]:
    ends = cuts(raw)
    return [raw[a:z] for a, z in zip([0, *ends], ends, strict=False)]


def seals(raw: bytes) -> list[int]:
    """Places where any encoding of a text cuts: white space after a word."""
    return [m.end() for m in PIECE.finditer(raw)][:-1]


def join(left: np.ndarray, right: np.ndarray, enc: ByteEncoder) -> np.ndarray:
    """Ids of the text of ``left`` followed by that of ``right``, repaired where they meet."""
    if not len(left) or not len(right):
        return np.concatenate([left, right])
    reach = 24
    while True:
        a, z = left[-reach:], right[:reach]
        whole = len(a) == len(left) and len(z) == len(right)
        text = enc.decode(a) + enc.decode(z)
        middle = int(enc.lengths[a].sum())
        found = seals(text)
        before = [p for p in found if p < middle]
        behind = [p for p in found if p > middle]
        # a seal needs a known character before it: not the first piece of a part of the left side
        lows = before[1:] if len(a) < len(left) else before
        highs = behind[:-1] if len(z) < len(right) else behind
        odd = ODD_SPACE.search(text.decode("utf-8", "replace"))
        if len(lows) >= 2 and len(highs) >= 2 and not odd:
            at_a, at_z = np.cumsum(enc.lengths[a]), middle + np.cumsum(enc.lengths[z])
            low, inner_low = lows[-2], lows[-1]
            inner_high, high = highs[0], highs[1]
            i, i2 = np.searchsorted(at_a, [low, inner_low])
            j2, j = np.searchsorted(at_z, [inner_high, high])
            fixed = enc.ids(text[low:high].decode("utf-8"))
            head, tail = a[i + 1:i2 + 1], z[j2 + 1:j + 1]
            agree = (at_a[i] == low and at_a[i2] == inner_low and at_z[j2] == inner_high and at_z[j] == high
                     and len(fixed) >= len(head) + len(tail)
                     and np.array_equal(fixed[:len(head)], head) and np.array_equal(fixed[len(fixed) - len(tail):], tail))
            if agree:
                return np.concatenate([left[:len(left) - len(a) + i + 1], fixed, right[j + 1:]])
        if whole:
            return enc.ids(text.decode("utf-8"))
        reach *= 4


def assemble(parts: list[np.ndarray], enc: ByteEncoder) -> np.ndarray:
    """Ids of a text from the ids of its chunks: neighbours are joined in pairs, so long texts stay linear."""
    while len(parts) > 1:
        parts = [join(parts[i], parts[i + 1], enc) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
    return parts[0] if parts else np.zeros(0, enc.dtype)


def _digest(chunk: bytes) -> bytes:
    return xxhash.xxh3_128_digest(chunk)


def _short(digest: bytes) -> int:
    return int.from_bytes(digest[:8], "little", signed=True)


def shared_chunks(docs: DataFrame, tokenizer: str, text_col: str) -> DataFrame:
    """Rows (key, h, ids): for the texts that have chunks occurring more than once, these chunks' ids."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("t"), row_key(text_col).alias("key"))

    def hashes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"k": np.array([_short(_digest(c)) for t in b["t"] for c in chunks(t.encode("utf-8"))],
                                              np.int64)})

    repeated = texts.select("t").mapInPandas(hashes, "k long").groupBy("k").count().filter("count > 1").select("k")
    words = bit_words(repeated, "k").collect()  # at most SKETCH_BITS / 64 rows
    bits = np.zeros(SKETCH_BITS // 64, np.int64)
    for r in words:
        bits[r.word] = r.bits
    sketch = spark.sparkContext.broadcast(bits)

    def report(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hit, told = sketch.value.view(np.uint64), set()
        for b in batches:
            key, h, text = [], [], []
            for t, k in zip(b["t"], b["key"], strict=True):
                own = set()
                for c in chunks(t.encode("utf-8")):
                    d = _digest(c)
                    place = _short(d) % SKETCH_BITS
                    if d in own or not int(hit[place >> 6]) >> (place & 63) & 1:
                        continue
                    own.add(d)
                    key.append(k)
                    h.append(d)
                    text.append(None if d in told else c)  # the text once per task is enough
                    if len(told) < 200_000:
                        told.add(d)
            yield pd.DataFrame({"key": np.array(key, np.int64), "h": h, "text": text})

    found = stage(texts.mapInPandas(report, "key long, h binary, text binary"))

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(tokenizer)
        for b in batches:
            yield pd.DataFrame({"h": b["h"], "ids": [enc.encode(bytes(t).decode("utf-8")) for t in b["text"]]})

    once = stage(found.groupBy("h").agg(F.max("text").alias("text")).mapInPandas(encode, "h binary, ids binary"))
    return found.select("key", "h").join(once, "h").select("key", "h", "ids")


def text_ids(text: str, refs, enc: ByteEncoder) -> np.ndarray:
    """Ids of a text; those of chunks in ``refs`` (rows h, ids) are taken from there, the rest in runs."""
    if refs is None or not len(refs):
        return enc.ids(text)
    known = {bytes(x["h"]): x["ids"] for x in refs}
    parts, run = [], []

    def flush() -> None:
        if run:
            parts.append(enc.ids(b"".join(run).decode("utf-8")))
            run.clear()

    for c in chunks(text.encode("utf-8")):
        got = known.get(_digest(c))
        if got is None:
            run.append(c)
        else:
            flush()
            parts.append(np.frombuffer(got, enc.dtype))
    flush()
    return assemble(parts, enc)


def encode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
           carry: tuple[str, ...] = ()) -> DataFrame:
    """Per document: id, ids (array of int), decoded (the text decoded from the ids) and the ``carry`` columns.

    Ids are those of the tokenizers library with add_special_tokens=False, and
    ``decoded`` is its decode(ids, skip_special_tokens=False). Needs a byte-level
    BPE file.
    """
    ship(docs.sparkSession)
    if not isinstance(encoder(tokenizer), ByteEncoder):
        raise ValueError("needs a byte-level BPE tokenizer without normalizer and prefix space")
    own = {c: F.col(c) for c in carry}
    refs = stage(shared_chunks(docs, tokenizer, text_col).groupBy("key")
                 .agg(F.collect_set(F.struct("h", "ids")).alias("refs")))
    rows = docs.select(F.col(id_col).cast("string").alias("i"), F.coalesce(F.col(text_col), F.lit("")).alias("t"),
                       row_key(text_col).alias("key"), *[e.alias(f"c_{c}") for c, e in own.items()])
    rows = mark(rows, "key", stage(bit_words(refs, "key")), "hit")
    kinds = dict(docs.dtypes)
    schema = ", ".join(["i string", "ids array<int>", "decoded string", *[f"`c_{c}` {kinds[c]}" for c in carry]])
    kept = [f"c_{c}" for c in carry]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(tokenizer)
        for batch in batches:
            for at in range(0, len(batch), ROWS):
                b = batch.iloc[at:at + ROWS]
                shared = b["refs"] if "refs" in b else [None] * len(b)
                ids = [text_ids(t, r, enc) for t, r in zip(b["t"], shared, strict=True)]
                out = {"i": b["i"].to_numpy(), "ids": [x.astype(np.int32) for x in ids],
                       "decoded": [enc.decode(x).decode("utf-8", "replace") for x in ids]}
                yield pd.DataFrame(out | {c: b[c].to_numpy() for c in kept})

    alone = rows.filter("not hit").select("i", "t", *kept).mapInPandas(run, schema)
    joined = (rows.filter("hit").join(refs, "key", "left").select("i", "t", "refs", *kept).mapInPandas(run, schema))
    return alone.unionByName(joined).select(F.col("i").cast("long").alias(id_col), "ids", "decoded",
                                            *[F.col(f"c_{c}").alias(c) for c in carry])
