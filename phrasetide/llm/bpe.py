"""Byte-pair encoding of whole texts in fragments between forced boundaries.

A byte pair that occurs inside no token of the vocabulary can't be merged over,
so a text may be cut there and its fragments encoded by themselves. Fragments
are short and recur, so most are encoded once per Python worker.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from phrasetide.llm.common import texts_of

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

# Fragments remembered per Python worker; twice as many at most.
MEMORY = 200_000

# White space beyond ASCII, and separators that libraries see differently: a
# text with one of these is encoded whole.
_ODD_SPACE = re.compile("[\x1c-\x1f\x85\xa0  -     　]")
_ASCII_SPACE = b" \t\n\x0b\x0c\r"


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {b: chr(b) for b in plain}
    for n, b in enumerate(b for b in range(256) if b not in letters):
        letters[b] = chr(256 + n)
    return letters


class Memory(dict):
    """Fragment -> packed ids; unknown fragments are encoded when asked for.

    When full, what is there becomes the old generation, from which fragments
    still in use come back.
    """

    def __init__(self, encode, limit: int = MEMORY):
        super().__init__()
        self.encode, self.limit, self.old = encode, limit, {}

    def __missing__(self, fragment):
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        packed = self.old.get(fragment)
        if packed is None:
            packed = self.encode(fragment)
        self[fragment] = packed
        return packed


def packed(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    return array("I", ids).tobytes() if array("I").itemsize == 4 else np.array(ids, "<u4").tobytes()


class Codec:
    """Encoding and decoding with a byte-level vocabulary in the tokenizers format."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.model = self.library.model
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = byte_letters()
        self.to_letters = dict(letters)
        back = {letter: b for b, letter in letters.items()}
        added = {token["id"]: token["content"] for token in spec["added_tokens"]}
        vocabulary = spec["model"]["vocab"]
        self.token_bytes = [b""] * (max([*vocabulary.values(), *added]) + 1)
        for token, i in vocabulary.items():
            self.token_bytes[i] = bytes(back[c] for c in token if c in back)
        for i, content in added.items():
            self.token_bytes[i] = content.encode()
        self.decimals = [str(i) for i in range(len(self.token_bytes))]
        self.special = re.compile("|".join(map(re.escape, added.values())) or r"(?!)")
        self.cuts = self._certain_cuts(i for i in vocabulary.values() if i not in added)
        self.memory = Memory(self._encode_fragment)

    def _certain_cuts(self, ids) -> np.ndarray:
        """Byte pairs between which every text may be cut, as a 256 by 256 table.

        Of the pairs inside no token, those are left out whose cut the splitting
        into words could notice: in the middle of a character, after white space
        (which looks at what follows), and before an apostrophe (which starts a
        contraction only where no other sign precedes it).
        """
        cuts = np.ones((256, 256), bool)
        for i in ids:
            token = np.frombuffer(self.token_bytes[i], np.uint8)
            cuts[token[:-1], token[1:]] = False
        cuts[:, 0x80:0xC0] = False
        cuts[list(_ASCII_SPACE), :] = False
        cuts[:, ord("'")] = False
        return cuts

    def _encode_fragment(self, fragment: bytes) -> bytes:
        text = fragment.decode()
        word = text[1:] if text[:1] == " " else text
        if word.isalpha() and max(word) < "ɐ":  # one word: no splitting needed
            letters = fragment.decode("latin-1").translate(self.to_letters)
            return packed([token.id for token in self.model.tokenize(letters)])
        return packed(self.library.encode(text, add_special_tokens=False).ids)

    def fragments(self, text: str) -> list[bytes]:
        """The pieces of a text between its certain cuts."""
        raw = text.encode()
        codes = np.frombuffer(raw, np.uint8)
        at = (np.flatnonzero(self.cuts[codes[:-1], codes[1:]]) + 1).tolist()
        return [raw[i:j] for i, j in zip([0, *at], [*at, len(raw)])]

    def encode(self, text: str) -> bytes:
        """Packed ids of a whole text, as the library gives without special tokens added."""
        if not text:
            return b""
        if self.special.search(text) or _ODD_SPACE.search(text):
            return packed(self.library.encode(text, add_special_tokens=False).ids)
        return b"".join(map(self.memory.__getitem__, self.fragments(text)))

    def decode(self, ids: list[int]) -> str:
        """The text of ids, special tokens included."""
        return b"".join(map(self.token_bytes.__getitem__, ids)).decode("utf-8", "replace")


_codecs: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """The codec of a vocabulary file, one per Python worker."""
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def _encode_texts(path: str):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path)
        for batch in batches:
            ids = [coder.encode(text) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(ids, pa.large_binary()).cast(pa.binary())],
                names=["doc_id", "ids"])
    return encode


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id`` and ``ids`` (little-endian unsigned 32-bit) of every whole text.

    ``path`` names the vocabulary file on every executor. A null text is the
    empty one, which has no ids. Only ``doc_id`` and ``text`` are read.
    """
    return texts_of(docs).mapInArrow(_encode_texts(path), "doc_id long, ids binary")


def _decode_ids(path: str):
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path)
        for batch in batches:
            texts = [coder.decode(np.frombuffer(ids or b"", "<u4").tolist())
                     for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())],
                                             names=["doc_id", "text"])
    return decode


def decoded(ids: DataFrame, path: str) -> DataFrame:
    """The texts of packed ``ids``; null ids give the empty text."""
    return ids.select("doc_id", "ids").mapInArrow(_decode_ids(path), "doc_id long, text string")


def _digests(path: str):
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path)
        for batch in batches:
            sizes, id_digests, text_digests = [], [], []
            for text in batch.column("text").to_pylist():
                ids = np.frombuffer(coder.encode(text), "<u4").tolist()
                decimals = ",".join(map(coder.decimals.__getitem__, ids))
                sizes.append(len(ids))
                id_digests.append(hashlib.sha256(decimals.encode()).hexdigest())
                text_digests.append(hashlib.sha256(coder.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()),
                 pa.array(id_digests, pa.string()), pa.array(text_digests, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
    return digest


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """Every whole text encoded and decoded again, as digests of both.

    One pass without a shuffle: what ``encoded`` and ``decoded`` do, in one
    Python worker per task. Repeated rows give repeated results.
    """
    return texts_of(docs).mapInArrow(
        _digests(path), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
