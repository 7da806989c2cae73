"""Exact and fast use of public BPE tokenizer files inside Spark tasks.

A text falls into pieces that a tokenizer encodes independently of each other;
each distinct piece is encoded once per worker and remembered (bounded). Plain
pieces (ASCII and Latin-1 letters) go straight to the library's BPE model after
the same lower-casing and splitting; all others, and texts with unusual white
space, go through the library's full encoder. A tokenizer file of another build
than the two known ones always goes through the full encoder.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Callable
from functools import lru_cache

import numpy as np
from tokenizers import Tokenizer

KEEP_PIECES = 300_000
LONG_PIECE = 200
LETTER = "A-Za-zÀ-ÖØ-öø-ÿ"
PLAIN = re.compile(f"[\\t\\n\\r -~{LETTER}]*")
ODD_SPACE = re.compile(r"[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
ENDINGS = "'s|'t|'re|'ve|'m|'ll|'d"


@lru_cache(maxsize=1)
def byte_chars() -> list[str]:
    """The printable character that stands for each byte in byte-level BPE vocabularies."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


class Pieces[T: (bytes, str)](dict[T, bytes]):
    """Ids of pieces; one that is not known yet is encoded, and kept unless it is long."""

    def __init__(self, encode: Callable[[T], bytes]):
        super().__init__()
        self.encode = encode

    def __missing__(self, piece: T) -> bytes:
        ids = self.encode(piece)
        if len(piece) <= LONG_PIECE:
            self[piece] = ids
        return ids


class Encoder:
    """Ids of texts, as ``Tokenizer.encode(text, add_special_tokens=False)`` gives them."""

    split = re.compile(rb"(?s).+")

    def __init__(self, path: str):
        self.full = Tokenizer.from_file(path)
        self.full.no_truncation()
        self.full.no_padding()
        self.dtype = np.dtype("<u2") if self.full.get_vocab_size(True) <= 1 << 16 else np.dtype("<u4")
        self.known = Pieces(self.piece)
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        self.chars = byte_chars()
        self.mapped = dict(enumerate(self.chars))

    def whole(self, text: str) -> bytes:
        return np.array(self.full.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def piece(self, piece: bytes) -> bytes:
        return self.whole(piece.decode("utf-8"))

    def pieces(self, raw: bytes) -> list[bytes]:
        return self.split.findall(raw)

    def free(self, text: str) -> bool:
        """Whether the text falls into independent pieces."""
        return False

    def encode(self, text: str) -> bytes:
        """Ids in the encoder's dtype, as bytes."""
        if not self.free(text):
            return self.whole(text)
        known, parts = self.known, self.pieces(text.encode("utf-8"))
        if len(known) > KEEP_PIECES:
            known.clear()
        return b"".join(map(known.__getitem__, parts))

    def ids(self, text: str) -> np.ndarray:
        return np.frombuffer(self.encode(text), self.dtype)

    def model_ids(self, parts: list[str]) -> bytes:
        """Ids of plain parts, each a word of the library's model once its bytes are mapped."""
        tokenize, mapped = self.full.model.tokenize, self.mapped
        found = [t.id for part in parts for t in tokenize(
            part if part.isalnum() and part.isascii() else part.encode("utf-8").decode("latin-1").translate(mapped))]
        return array(self.code, found).tobytes()


class WordEncoder(Encoder):
    """Lower case, white space dropped, word ends marked: pieces lie between ASCII white space."""

    parts = re.compile(f"{ENDINGS}|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")

    def __init__(self, path: str):
        super().__init__(path)
        # words come with many marks and capitals around them: their parts are remembered as well
        self.known_parts = Pieces(lambda part: self.model_ids([part]))

    def free(self, text: str) -> bool:
        return True

    def pieces(self, raw: bytes) -> list[bytes]:
        return raw.split()

    def piece(self, piece: bytes) -> bytes:
        text = piece.decode("utf-8")
        if not PLAIN.fullmatch(text) or "<|" in text:
            return self.whole(text)
        low = text.lower()
        known = self.known_parts
        if len(known) > KEEP_PIECES:
            known.clear()
        return known[low] if low.isalpha() else b"".join(map(known.__getitem__, self.parts.findall(low)))


class ByteEncoder(Encoder):
    """Byte-level BPE: pieces are white space with the word that follows.

    The splitting pattern never joins a character with white space after it, so
    a cut between a word and ASCII white space changes nothing on either side.
    """

    split = re.compile(rb"\s*\S+|\s+")
    parts = re.compile(f"{ENDINGS}| ?[{LETTER}]+| ?[0-9]+| ?[^\\s{LETTER}0-9]+|\\s+(?!\\S)|\\s+")

    def __init__(self, path: str):
        super().__init__(path)
        back = {c: b for b, c in enumerate(self.chars)}
        self.bytes = [b""] * self.full.get_vocab_size(True)
        added = self.full.get_added_tokens_decoder()
        for token, i in self.full.get_vocab(True).items():
            self.bytes[i] = token.encode("utf-8") if i in added else bytes([back[c] for c in token])
        self.lengths = np.array([len(b) for b in self.bytes], np.int64)

    def free(self, text: str) -> bool:
        return not ODD_SPACE.search(text)

    def piece(self, piece: bytes) -> bytes:
        text = piece.decode("utf-8")
        if not PLAIN.fullmatch(text) or "<|" in text:
            return self.whole(text)
        return self.model_ids(self.parts.findall(text))

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids.tolist()))


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a tokenizer file; it keeps its pieces from task to task."""
    if path not in _ENCODERS:
        with open(path, encoding="utf-8") as f:
            config = json.load(f)
        split, model = config["pre_tokenizer"], config["model"]
        plain_bpe = model["type"] == "BPE" and not model["dropout"] and not model.get("ignore_merges")
        kind: type[Encoder] = Encoder
        if plain_bpe and config["normalizer"] is None and split["type"] == "ByteLevel":
            if split["use_regex"] and not split["add_prefix_space"]:
                kind = ByteEncoder
        elif plain_bpe and split["type"] == "Sequence" and config["normalizer"]["type"] == "Sequence":
            norms = [n["type"] for n in config["normalizer"]["normalizers"]]
            steps = split["pretokenizers"]
            pattern = steps[0].get("pattern", {}).get("Regex", "")
            if (norms == ["NFC", "Replace", "Lowercase"] and steps[0].get("behavior") == "Removed"
                    and pattern == ENDINGS + r"|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"):
                kind = WordEncoder
        _ENCODERS[path] = kind(path)
    return _ENCODERS[path]
