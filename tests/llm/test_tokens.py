from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from public_tokenizers import path
from tokenizers import Tokenizer

from phrasetide.llm import bpe, packing, token_files
from phrasetide.session import new_work_dir
from tests.llm.conftest import TEXTS

BYTES, WORDS = path("byte_bpe_50k.json"), path("word_bpe_49k.json")
byte_library, word_library = Tokenizer.from_file(BYTES), Tokenizer.from_file(WORDS)
byte_codec, word_codec = bpe.Codec(BYTES), packing.WordCodec(WORDS)

# Signs at which a wrong cut would show: spaces of all kinds, apostrophes, marks.
awkward = st.text(alphabet=st.one_of(
    st.sampled_from(list(" \t\n\r'’.,!?-_sStTlLdD0123  \x1c\x85́éßİ東🎉<|>")),
    st.characters(exclude_categories=["Cs"])), max_size=80)


def ids_of(library, text):
    return library.encode(text, add_special_tokens=False).ids


@given(awkward)
@settings(max_examples=600, deadline=None)
def test_fragments_give_the_ids_of_the_whole_text(text):
    ids = np.frombuffer(byte_codec.encode(text), "<u4").tolist()
    assert ids == ids_of(byte_library, text)
    assert byte_codec.decode(ids) == byte_library.decode(ids, skip_special_tokens=False)


@given(awkward)
@settings(max_examples=600, deadline=None)
def test_words_give_the_ids_of_the_whole_text(text):
    assert np.frombuffer(word_codec.encode(text), "<u4").tolist() == ids_of(word_library, text)


@pytest.mark.parametrize("text", [t or "" for t in TEXTS])
def test_odd_texts(text):
    assert np.frombuffer(byte_codec.encode(text), "<u4").tolist() == ids_of(byte_library, text)
    assert np.frombuffer(word_codec.encode(text), "<u4").tolist() == ids_of(word_library, text)


def test_signs_behind_words_are_encoded_once(monkeypatch):
    codec, asked = packing.WordCodec(WORDS), []
    encode = codec._encode_other
    monkeypatch.setattr(codec, "_encode_other", lambda text: asked.append(text) or encode(text))
    codec.signs.encode = codec._encode_other
    text = "One. Two, three. Four, five!? six. Seven!?"
    assert np.frombuffer(codec.encode(text), "<u4").tolist() == ids_of(word_library, text)
    assert sorted(asked) == ["!?", ",", "."]


def test_broken_bytes_decode_as_the_library_does():
    ids = ids_of(byte_library, "東🎉")[:-1]
    assert byte_codec.decode(ids) == byte_library.decode(ids, skip_special_tokens=False)


def test_a_full_memory_changes_nothing():
    memory = bpe.Memory(lambda f: f.upper(), limit=3)
    assert [memory[c] for c in "abcabdefgabc"] == list("ABCABDEFGABC")
    assert len(memory) <= 3 and len(memory.old) <= 3


def test_no_cut_lies_inside_a_token():
    for token in byte_codec.token_bytes[:-1]:
        codes = np.frombuffer(token, np.uint8)
        assert not byte_codec.cuts[codes[:-1], codes[1:]].any()


def test_encoded_and_decoded(odd):
    ids = bpe.encoded(odd, BYTES)
    back = {r.doc_id: r.text for r in bpe.decoded(ids, BYTES).collect()}
    assert back == {i: t or "" for i, t in enumerate(TEXTS)}


def test_round_trip_digests(odd, empty, clashing):
    for row in bpe.round_trip(odd, BYTES).collect():
        ids = ids_of(byte_library, TEXTS[row.doc_id] or "")
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(byte_library.decode(
            ids, skip_special_tokens=False).encode()).hexdigest()
    assert bpe.round_trip(empty, BYTES).count() == 0
    assert bpe.round_trip(clashing("a", "a"), BYTES).count() == 2


@pytest.fixture
def small_batches(monkeypatch):
    monkeypatch.setattr(token_files, "BATCH", 2)


def test_files_hold_all_documents_in_order(spark, docs):
    rows = [(3 * i, t) for i, t in enumerate(TEXTS * 3)]
    folder = new_work_dir(spark, "tokens")
    token_files.write_tokens(docs(*rows, parts=4), folder, BYTES, length=16)
    made = sorted(token_files.read_documents(spark, folder).collect())
    start = 0
    for row, (doc_id, text) in zip(made, rows, strict=True):
        ids = np.array([*ids_of(byte_library, text or ""), 0], "<u4")
        assert (row.doc_id, row.start, bytes(row.ids)) == (doc_id, start, ids.tobytes())
        start += len(ids)
    assert spark.read.parquet(f"{folder}/manifest").count() > 1


def test_a_sequence_is_read_in_place(spark, docs):
    folder = new_work_dir(spark, "tokens")
    token_files.write_tokens(docs("one two three four five six", "seven"), folder, BYTES, length=4)
    bucket = spark.read.parquet(f"{folder}/manifest").agg({"bucket": "min"}).first()[0]
    ids, mask = token_files.sequence(folder, bucket, 1)
    want = [*ids_of(byte_library, "one two three four five six"), 0][4:8]
    assert ids.tolist()[:len(want)] == want and mask.tolist() == [True] * len(want) + [False] * (
        4 - len(want))
    assert not ids.flags.owndata


def test_files_of_an_empty_table(spark, empty):
    folder = new_work_dir(spark, "tokens")
    token_files.write_tokens(empty, folder, BYTES)
    assert token_files.read_documents(spark, folder).count() == 0


def brute_cost(places, costs, length):
    best = {0: 0}
    for j in range(1, len(places)):
        best[j] = min(best[i] + length - (places[j] - places[i]) + costs[j]
                      for i in range(j) if places[j] - places[i] <= length)
    return best[len(places) - 1]


@given(st.lists(st.tuples(st.integers(1, 10), st.sampled_from([0, 2, 9])), min_size=1, max_size=40))
def test_cuts_cost_the_least(steps):
    places = np.concatenate([[0], np.cumsum([s for s, _ in steps])])
    costs = np.array([0, *[c for _, c in steps]])
    cuts = packing.best_cuts(places, costs, 12)
    at = {p: c for p, c in zip(places.tolist(), costs.tolist())}
    total, before = 0, 0
    for cut in cuts:
        assert 0 < cut - before <= 12
        total += 12 - (cut - before) + at[cut]
        before = cut
    assert before == places[-1] and total == brute_cost(places.tolist(), costs.tolist(), 12)


@pytest.mark.parametrize("length, horizon", [(8, 20), (64, 1 << 20), (2048, 500)])
def test_every_id_lies_in_one_piece(spark, docs, length, horizon):
    frame = docs(*TEXTS, (3, "twice."), (3, "twice."))
    rows = packing.packed_pieces(frame, WORDS, length=length, horizon=horizon).collect()
    texts = [*enumerate(TEXTS), (3, "twice."), (3, "twice.")]
    want = sorted((i, zlib.crc32(np.array([*ids_of(word_library, t or ""), 1], "<u4").tobytes()))
                  for i, t in texts if i != 3)
    got = {}
    for row in sorted(rows, key=lambda r: (r.doc_id, r.start)):
        if row.doc_id != 3:
            assert row.start == got.get(row.doc_id, 0)
            got[row.doc_id] = row.start + row.length
            if row.length == row.doc_tokens:
                assert (row.doc_id, row.ids_crc32) in want
    assert all(got[i] == len(ids_of(word_library, t or "")) + 1 for i, t in texts if i != 3)
    sequences = {}
    for row in rows:
        sequences.setdefault(row.sequence_id, []).append((row.offset, row.length))
    for pieces in sequences.values():
        at = 0
        for offset, size in sorted(pieces):
            assert offset == at
            at += size
        assert at <= length


def test_packing_odd_tables(empty, clashing):
    assert packing.packed_pieces(empty, WORDS).count() == 0
    assert packing.packed_pieces(clashing("a", None), WORDS).count() == 2


@pytest.mark.parametrize("kind", ["words", "signs", "wide sentences"])
def test_texts_without_sentence_ends_are_packed_with_little_padding(kind):
    import random
    draw = random.Random(2)
    signs = lambda n: "".join(chr(draw.randint(0x4E00, 0x9000)) for _ in range(n))
    make = {"words": lambda: " ".join(draw.choice(["word", "other", "thing"]) for _ in range(3000)),
            "signs": lambda: signs(1000),
            "wide sentences": lambda: "。".join(signs(20) for _ in range(50))}[kind]
    coder = packing.word_codec(path("word_bpe_49k.json"))
    packer = packing._Packer(coder.ends_sentence, coder.ends_word, 0, 2048, 1 << 20)
    for i in range(40):
        packer.add(i, np.append(np.frombuffer(coder.encode(make()), "<u4"), np.uint32(1)))
    packer.cut(last=True)
    used = sum(length for _, _, length, *_ in packer.rows)
    sequences = {row[5] for row in packer.rows}
    assert 1 - used / (2048 * len(sequences)) < 0.05
