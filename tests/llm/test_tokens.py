"""Tokenising: exact agreement with the library on fixtures, fuzz and awkward tables."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyarrow import fs as arrow_fs
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fjord.llm import chunkbpe, tokenfiles, tokens
from fjord.llm.common import shared_folder
from fjord.llm.queries import QUERIES
from fjord.llm.tokens import ByteEncoder, WordEncoder, encoder
from tests.conftest import SF_SMALL

WORD, BYTE = (public_tokenizers.path(f) for f in ("word_bpe_49k.json", "byte_bpe_50k.json"))
BITS = ["a", "B", "É", "é", "́", "ß", "İ", "Σ", "ς", " ", "  ", "\n", "\t", "\r\n", "\xa0", " ",
        "　", "\x1c", "\x85", "'s", "'S", "'LL", "don't", "1", "23", "½", "²", "<|endoftext|>", "<|startoftext|>",
        "<|endof", "text|>", "日本", "한", "!", "...", "—", "µ", "ª", "×", "😀", "\x00", "​", "ÿ", "Ÿ", "K", "ſ",
        "the", "the quick brown", "x" * 30]


def fuzz(n, most, seed):
    r = random.Random(seed)
    return ["".join(r.choice(BITS) for _ in range(r.randint(0, most))) for _ in range(n)]


@pytest.mark.parametrize("path,kind", [(WORD, WordEncoder), (BYTE, ByteEncoder)])
def test_pieces_give_the_library_s_ids(path, kind):
    enc, lib = encoder(path), Tokenizer.from_file(path)
    assert type(enc) is kind
    for text in fuzz(8000, 12, 1):
        want = lib.encode(text, add_special_tokens=False).ids
        assert enc.ids(text).tolist() == want, repr(text)
        if kind is ByteEncoder:
            assert enc.decode(enc.ids(text)).decode("utf-8", "replace") == lib.decode(want, skip_special_tokens=False)


def test_chunks_cover_the_text_and_follow_the_content():
    r = random.Random(2)
    body = " ".join(str(r.random()) for _ in range(3000)).encode()
    a, b = chunkbpe.chunks(b"start " + body), chunkbpe.chunks(b"another beginning " + body)
    assert b"".join(a) == b"start " + body
    assert len(set(a) & set(b)) > 0.8 * len(a)
    assert all(len(c) <= chunkbpe.MOST + 3 for c in chunkbpe.chunks("é".encode() * 50_000))
    assert all(c.decode("utf-8") for c in chunkbpe.chunks("é日".encode() * 50_000))


def test_joined_chunks_equal_the_whole_text():
    enc, lib, r = encoder(BYTE), Tokenizer.from_file(BYTE), random.Random(3)
    for text in fuzz(2500, 60, 4):
        raw, at, parts = text.encode(), 0, []
        while at < len(raw):  # cuts anywhere, also inside words and white space
            to = chunkbpe._character(np.frombuffer(raw, np.uint8), min(len(raw), at + r.randint(1, 40)))
            parts.append(enc.ids(raw[at:to].decode()))
            at = to
        assert chunkbpe.assemble(parts, enc).tolist() == lib.encode(text, add_special_tokens=False).ids, repr(text)


def odd_documents(spark):
    shared = "passage that several documents share, word for word, " * 60
    rows = [(1, None, "x"), (2, "", "x"), (3, "   ", None), (None, "no id", "x"), (None, None, None),
            (7, "twice", "x"), (7, "twice", "x"), (8, "tail " + shared, "y"), (9, shared + "head", "y"),
            (10, "日本 " * 3000 + shared, "z"), (11, "word" * 20_000, "z"), (12, "a\xa0b " * 2000, "z")]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string").withColumn("key", F.lit(1))


def test_odd_documents(spark):
    docs = odd_documents(spark)
    lib = Tokenizer.from_file(BYTE)
    got = chunkbpe.encode(docs, BYTE, carry=("text",)).collect()
    assert len(got) == 12
    for r in got:
        assert r.ids == lib.encode(r.text or "", add_special_tokens=False).ids
        assert r.decoded == (r.text or "")
    assert chunkbpe.encode(docs.limit(0), BYTE).count() == 0

    folder = shared_folder(spark)
    written = tokenfiles.write(docs, folder, WORD, end_id=2, partitions=3)
    back = tokenfiles.read_back(spark, folder, written).collect()
    lib = Tokenizer.from_file(WORD)
    want = sorted(((r.doc_id is not None, r.doc_id or 0), lib.encode(r.text or "", add_special_tokens=False).ids + [2])
                  for r in docs.collect())
    have = sorted(((r.doc_id is not None, r.doc_id or 0), r.start, r.n_tokens, r.ids_crc32) for r in back)
    assert len(have) == 12
    assert sorted(h[1] for h in have)[0] == 0 and sum(h[2] for h in have) == sum(len(w[1]) for w in want)
    assert sorted((h[0], h[2], h[3]) for h in have) == sorted(
        (k, len(ids), zlib.crc32(np.array(ids, "<u4"))) for k, ids in want)
    ordered = sorted(have, key=lambda h: h[1])
    assert [h[0] for h in ordered] == sorted(h[0] for h in have)
    assert [h[1] for h in ordered] == np.cumsum([0] + [h[2] for h in ordered])[:-1].tolist()
    empty = tokenfiles.write(docs.limit(0), shared_folder(spark), WORD, end_id=2)
    assert tokenfiles.read_back(spark, folder, empty).count() == 0


def test_files_that_cannot_be_mapped_are_read_by_ranges(tmp_path):
    folder = tokenfiles.Folder(str(tmp_path))
    folder.local, folder.fs = False, arrow_fs.LocalFileSystem()  # as for a folder on another system
    ids = np.arange(5000, dtype="<u2")
    with folder.open("_tmp") as f:
        f.write(ids.tobytes())
    folder.rename("_tmp", "part.bin")
    back = folder.read("part.bin", "<u2")
    assert isinstance(back, tokenfiles.Ranges) and len(back) == 5000
    assert (back[0:5000] == ids).all() and (back[77:1234] == ids[77:1234]).all() and len(back[10:10]) == 0
    folder.local = True
    assert isinstance(folder.read("part.bin", "<u2"), np.memmap)


def test_files_are_sized_by_text(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "some words " * 50) for i in range(200)], "doc_id long, text string")
    monkeypatch.setattr(tokenfiles, "FILE_BYTES", 11_000)
    folder = shared_folder(spark)
    written = tokenfiles.write(docs, folder, WORD, end_id=2, partitions=2)
    assert written.count() >= 8 and written.agg(F.max("docs")).first()[0] < 50
    starts = sorted((r.start, r.n_tokens, r.doc_id) for r in tokenfiles.read_back(spark, folder, written).collect())
    assert [x[2] for x in starts] == list(range(200)) and [x[0] for x in starts] == [101 * i for i in range(200)]


def test_queries_against_the_library(spark):
    docs = sorted(spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect())
    word, byte = Tokenizer.from_file(WORD), Tokenizer.from_file(BYTE)
    start, want3, want5 = 0, [], []
    for r in docs:
        ids = word.encode(r.text, add_special_tokens=False).ids + [2]
        want3.append((r.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4"))))
        start += len(ids)
        ids = byte.encode(r.text, add_special_tokens=False).ids
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), byte.decode(ids, skip_special_tokens=False))]
        want5.append((r.doc_id, len(ids), *sha))
    assert sorted(map(tuple, QUERIES["op3_token_files"](spark, SF_SMALL).collect())) == want3
    assert sorted(map(tuple, QUERIES["op5_bpe"](spark, SF_SMALL).collect())) == want5


def test_a_word_is_encoded_once_whatever_stands_around_it(monkeypatch):
    enc, asked = WordEncoder(WORD), []
    encode = enc.model_ids
    monkeypatch.setattr(enc, "model_ids", lambda parts: asked.extend(parts) or encode(parts))
    text = "Zorblat, zorblat; (ZORBLAT) zorblat's 'zorblat' zorblat 7zorblat7 Été, été."
    want = Tokenizer.from_file(WORD).encode(text, add_special_tokens=False).ids
    assert enc.ids(text).tolist() == want == enc.ids(text).tolist()
    assert asked.count("zorblat") == 1 and asked.count("été") == 1 and len(asked) == len(set(asked))
    monkeypatch.setattr(tokens, "KEEP_PIECES", 2)
    assert enc.ids(text + " once more, zorblat").tolist()[:len(want)] == want and len(enc.known_parts) < 20
