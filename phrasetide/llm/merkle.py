"""Merkle fingerprints of documents over sections, paragraphs and phrases.

Paragraphs are lines; a section is a run of paragraphs that closes where the
digest of a paragraph says so, so an edit moves section borders only near it.
Under a paragraph lie phrases, as many documents are a single line: a phrase
ends at a sign, and a long one is cut at words chosen by their hash. Digests of
phrases make that of the paragraph, those the section's, and those the root.

A fingerprint reads ``root/section,paragraph.phrases,...``: the root's SHA-256,
then per section its digest, and per paragraph its digest and those of its
phrases, shortened to six hex digits each.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phrasetide.llm.common import Buckets, partitions, texts_of

# A section closes at one in so many paragraphs.
SECTION = 4
# A phrase of more bytes is cut, on average after so many words.
LONG_PHRASE, WORDS = 48, 4
RUN = 8  # characters of a piece of a long word, on average
SHORT = 3  # bytes of a shortened digest

_PHRASES = re.compile(rb"[^.,!?;:]+[.,!?;:]*|[.,!?;:]+")
_WORDS = re.compile(rb" *[^ ]+ *$| *[^ ]+|  *")


def _runs(word: bytes) -> list[bytes]:
    """A long word cut behind characters that it and its neighbour's hash choose.

    Scripts without spaces, tables and encoded data have words of any length. A
    run without such a place is cut after ``4 * RUN`` characters.
    """
    if len(word) <= LONG_PHRASE:
        return [word]
    text = word.decode()
    codes = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.uint32)
    hashed = (codes[:-1] * np.uint32(2654435761)) ^ (codes[1:] * np.uint32(2246822519))
    made, start = [], 0
    for end in [*(np.flatnonzero((hashed >> np.uint32(13)) % RUN == 0) + 2).tolist(), len(text)]:
        while end - start > 4 * RUN:
            made.append(text[start:start + 4 * RUN].encode())
            start += 4 * RUN
        if end > start:
            made.append(text[start:end].encode())
            start = end
    return made


def phrases(paragraph: bytes) -> list[bytes]:
    """The pieces of a paragraph; joined they give it again."""
    found = _PHRASES.findall(paragraph)
    if len(paragraph) <= LONG_PHRASE or all(len(p) <= LONG_PHRASE for p in found):
        return found
    cut = []
    for phrase in found:
        if len(phrase) <= LONG_PHRASE:
            cut.append(phrase)
            continue
        held = []
        for word in _WORDS.findall(phrase):
            if len(word) > LONG_PHRASE:
                cut += [b"".join(held), *_runs(word)] if held else _runs(word)
                held = []
                continue
            held.append(word)
            if zlib.crc32(word) % WORDS == 0 or len(held) >= 4 * WORDS:
                cut.append(b"".join(held))
                held = []
        if held:
            cut.append(b"".join(held))
    return cut


class Tree:
    """The digests of one text."""

    def __init__(self, text: str):
        self.leaves: list[bytes] = []
        self.sections: list[tuple[bytes, list[tuple[bytes, list[bytes]]]]] = []
        held: list[tuple[bytes, list[bytes]]] = []
        root = sha256()
        lines = text.encode().split(b"\n") if text else []
        for n, line in enumerate(lines):
            leaves = [sha256(p).digest() for p in phrases(line)]
            paragraph = sha256(b"".join(leaves)).digest()
            held.append((paragraph, [d[:SHORT] for d in leaves]))
            if paragraph[-1] % SECTION == 0 or n + 1 == len(lines):
                section = sha256(b"".join(d for d, _ in held)).digest()
                root.update(section)
                self.sections.append((section, held))
                held = []
        self.root = root.hexdigest()
        for _, paragraphs in self.sections:
            for _, leaves in paragraphs:
                self.leaves += leaves

    def __str__(self) -> str:
        return "/".join([self.root, *(
            ",".join([section[:SHORT].hex(), *(
                f"{paragraph[:SHORT].hex()}.{b''.join(leaves).hex()}"
                for paragraph, leaves in paragraphs)])
            for section, paragraphs in self.sections)])


def _parts(fingerprint: str) -> tuple[str, list[str]]:
    """Root and leaves of a written fingerprint."""
    root, *sections = fingerprint.split("/")
    size, leaves = 2 * SHORT, []
    for section in sections:
        for paragraph in section.split(",")[1:]:
            run = paragraph.split(".")[1]
            leaves += [run[i:i + size] for i in range(0, len(run), size)]
    return root, leaves


def _alike(root_a: str, a: list, root_b: str, b: list) -> float:
    if root_a == root_b:
        return 1.0
    if not a or not b:
        return 0.0
    return 2 * (Counter(a) & Counter(b)).total() / (len(a) + len(b))


def likeness(a: str, b: str) -> float:
    """1 for equal roots, else the share of phrases that both fingerprints have."""
    root_a, leaves_a = _parts(a)
    root_b, leaves_b = _parts(b)
    return _alike(root_a, leaves_a, root_b, leaves_b)


def differing(a: str, b: str) -> list[int]:
    """Paragraphs of ``a`` (counted from 0) under branches that ``b`` lacks."""
    if a.split("/")[0] == b.split("/")[0]:
        return []
    theirs = Counter(p for section in b.split("/")[1:] for p in section.split(",")[1:])
    found, n = [], 0
    for section in a.split("/")[1:]:
        for paragraph in section.split(",")[1:]:
            if theirs[paragraph] > 0:
                theirs[paragraph] -= 1
            else:
                found.append(n)
            n += 1
    return found


def _print(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = [str(Tree(text)) for text in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(prints, pa.string())],
                                         names=["doc_id", "fingerprint"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``fingerprint`` of every whole text; a null text is the empty one.

    Equal texts have equal fingerprints, with the same root and no branches for
    the empty text. Only ``doc_id`` and ``text`` are read.
    """
    return texts_of(docs).mapInArrow(_print, "doc_id long, fingerprint string")


EDITS = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
         "edited_fingerprint string, near_edited double, near_next double")


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows by document, a copy of the next range's first row at the end."""
    before = None
    for batch in batches:
        rows = []
        for doc_id, text, border in zip(batch.column("doc_id").to_pylist(),
                                        batch.column("text").to_pylist(),
                                        batch.column("border").to_pylist()):
            if before is not None and before[3]:
                break  # several rows share the border's id: the first is the next document
            tree = Tree(text)
            if before is not None:
                rows.append(_edited(before, text, tree))
            before = (doc_id, text, tree, border)
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), (
                    pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(),
                    pa.float64(), pa.float64()))],
                names=[f.split()[0] for f in EDITS.split(", ")])


def _edited(doc: tuple, following: str, following_tree: Tree) -> tuple:
    doc_id, text, tree, _ = doc
    half = len(text) // 2
    edited = text[:len(text) - half] + following[:half]
    other = Tree(edited)
    return (doc_id, len(text), sha256(edited.encode()).hexdigest(), str(tree), str(other),
            _alike(tree.root, tree.leaves, other.root, other.leaves),
            _alike(tree.root, tree.leaves, following_tree.root, following_tree.leaves))


def half_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of all texts and of their edits by the following document.

    The second half of each text (rounded down) gives way to as many code points
    of the document with the next ``doc_id``, the first following the last.
    Ranges of ids are dealt to tasks, with a copy of the next range's first
    document, so texts are shuffled once. A document alone is its own follower;
    rows with equal ids follow in order of their texts; a null ``doc_id`` comes
    first. A null text is the empty one. An empty table gives an empty result.
    """
    rows = texts_of(docs)
    ranges = Buckets(rows, "doc_id", partitions(docs.sparkSession))
    filled = sorted(ranges.first)
    before = {bucket: filled[n - 1] for n, bucket in enumerate(filled)}
    to = [before.get(bucket, 0) for bucket in range(ranges.count)]
    firsts = [first for first in ranges.first.values() if first is not None]
    own = F.struct(F.col("bucket"), F.lit(False).alias("border"))
    copy = F.struct(F.get(F.split(F.lit(",".join(map(str, to))), ",").cast("array<int>"),
                          F.col("bucket")).alias("bucket"), F.lit(True).alias("border"))
    first = F.col("doc_id").isin(firsts) if firsts else F.lit(False)
    if ranges.first.get(0, 0) is None:
        first = F.col("doc_id").isNull() | first
    return (rows.withColumn("bucket", ranges.column())
            .select("doc_id", "text", F.explode(F.when(first, F.array(own, copy))
                                                .otherwise(F.array(own))).alias("place"))
            .select("doc_id", "text", "place.*")
            .repartitionById(ranges.count, F.col("bucket"))
            .sortWithinPartitions("border", "doc_id", "text")
            .mapInArrow(_edits, EDITS))
