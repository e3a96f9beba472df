from __future__ import annotations

import pytest

DOC = "doc_id long, text string, lang string, source string, n_chars long"

# A text of every awkward kind; ids are given by place.
TEXTS = [
    "One line of plain words here.", "", None, "   \t\n ", "One line of plain words here.",
    "Onelineofplainwordshere.", "ÄÖÜ ñandú ça — 東京 🎉 é x y z", "a" * 9000,
    "\n".join(f"line {i} of a long text, with words {i % 7}." for i in range(900)),
    "<|endoftext|> don't 'tis it's !'s x\x1cy  two  spaces \n\n\nend \t", "42 1,000 !!! ???",
]


@pytest.fixture
def docs(spark):
    """Documents of given texts, or of (doc_id, text[, lang]) tuples."""
    def make(*rows, parts: int = 3):
        full = [(r if isinstance(r, tuple) else (i, r)) for i, r in enumerate(rows)]
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", None) for r in full]
        return spark.createDataFrame(full, DOC).repartition(parts)
    return make


@pytest.fixture
def odd(docs):
    return docs(*TEXTS)


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], DOC)


@pytest.fixture
def clashing(docs):
    """Documents with further columns named like those the operators make."""
    names = ("kept", "digest", "slot", "shard", "bits", "bucket", "record", "row", "lettered",
             "doc", "family", "id", "key", "part", "_salt", "dropped_key")

    def make(*rows):
        from pyspark.sql import functions as F
        return docs(*rows).withColumns({n: F.lit(n) for n in names})
    return make
