from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest
from public_tokenizers import path
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from phrasetide.llm import alignment
from phrasetide.llm.bpe import byte_letters
from tests.llm.conftest import TEXTS

A, B = path("byte_bpe_50k.json"), path("piece_bpe_32k.model")
library_a = Tokenizer.from_file(A)
library_a.encode_special_tokens = True
library_b = SentencePieceProcessor(model_file=B)
BACK = {letter: b for b, letter in byte_letters().items()}

MORE = ["a ▁ b", "trail ", "  two", " ", "   ", "x\x00y", "é ½ ﬁ  　 ﻿", "<s> </s> <0x41>",
        "a\r\n\tb;\r }\r", "one two one two", "one two", "▁", "end.\n\nNext  line\t\t x", "𝔘𝔫𝔦 🎉🎉"]


def tokens(text):
    """Token bytes and ids of both sides by the libraries, of the whole text."""
    ids_a = library_a.encode(" " + text, add_special_tokens=False).ids
    bytes_a = [bytes(BACK[c] for c in library_a.id_to_token(i)) for i in ids_a]
    ids_b = library_b.encode(text)
    pieces = [library_b.id_to_piece(i) for i in ids_b]
    bytes_b = [bytes([int(p[3:5], 16)]) if library_b.is_byte(i) else p.replace("▁", " ").encode()
               for i, p in zip(ids_b, pieces)]
    return ids_a, bytes_a, ids_b, bytes_b


def brute_force(texts):
    """Per text: n_a, n_b, groups and links; then the corpus-wide measures."""
    made, counts = [], Counter()
    for text in texts:
        if not text:
            made.append((0, 0, "", []))
            continue
        ids_a, bytes_a, ids_b, bytes_b = tokens(text)
        if b"".join(bytes_a) != (" " + text).encode() or b"".join(bytes_b) != (" " + text).encode():
            made.append((0, 0, "", []))
            continue
        groups, links, a, b, end_a, end_b = [], [], [], [], 0, 0
        ia = ib = 0
        while ia < len(ids_a) or ib < len(ids_b):
            if end_a <= end_b:
                a.append(ids_a[ia])
                end_a += len(bytes_a[ia])
                ia += 1
            else:
                b.append(ids_b[ib])
                end_b += len(bytes_b[ib])
                ib += 1
            if end_a == end_b:
                groups.append(",".join(map(str, a)) + "|" + ",".join(map(str, b)))
                links.append((a[-1], b[-1]))
                a, b = [], []
        counts.update(links)
        made.append((len(ids_a), len(ids_b), ";".join(groups), links))
    best = {}
    for (a, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    return [(n_a, n_b, groups.count("|") if links else 0, len(links),
             sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links), groups)
            for n_a, n_b, groups, links in made]


def random_texts(n):
    draw = random.Random(5)
    alphabet = "aeinrst  .,'\n\t-é京🎉▁<>0"
    return ["".join(draw.choice(alphabet) for _ in range(draw.randint(1, 60))) for _ in range(n)]


@pytest.mark.parametrize("limit", [alignment.PAIR_BYTES, 0])
def test_equals_brute_force(docs, limit):
    texts = TEXTS + MORE + TEXTS[:4] + random_texts(80)
    made = alignment.aligned(docs(*texts), A, B, digests=False, limit=limit)
    rows = sorted(made.collect(), key=lambda r: r.doc_id)
    assert [r.doc_id for r in rows] == list(range(len(texts)))
    for row, want, text in zip(rows, brute_force(texts), texts):
        assert tuple(row)[1:] == want, text


def test_digests_null_ids_and_clashing_columns(docs, clashing, empty):
    made = alignment.aligned(clashing((None, "one two"), (3, "one two"), (3, "one two"), (4, None)),
                             A, B).orderBy(F.col("doc_id").asc_nulls_first()).collect()
    (want, *_) = brute_force(["one two"] * 3)
    for row in made[:3]:
        assert tuple(row)[1:-1] == want[:-1]
        assert row.groups_sha256 == hashlib.sha256(want[-1].encode()).hexdigest()
    assert tuple(made[3]) == (4, 0, 0, 0, 0, 0, 0, "")
    none = alignment.aligned(empty, A, B)
    assert none.count() == 0 and none.columns[-1] == "groups_sha256"


def test_fragments_encode_as_whole_texts():
    side = alignment.PieceSide(B)
    for text in [t for t in TEXTS + MORE if t] + random_texts(400):
        assert side.encode(text).tolist() == library_b.encode(text), text
