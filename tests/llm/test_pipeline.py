from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as driver
import corpus_pipeline
from checks import compare
from phrasetide.llm import minhash, queries
from tests.llm.conftest import TEXTS

ROOT = Path(__file__).resolve().parents[2]
SF_DIR = "/root/testdata/sf0.001"


def test_stages_take_effect(spark, docs, tmp_path):
    long = " ".join(f"word{i}" for i in range(80))
    frame = docs(*TEXTS, long, long + " extra", long.replace(" ", "  "), "42 43", None)
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    kept = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = kept
        kept = stage(spark, before, str(tmp_path))
        assert kept.columns == before.columns
        assert kept.count() < before.count()
    # Of three copies of the long text the wide one goes last into the near stage.
    ids = {r.doc_id for r in kept.collect()}
    n = len(TEXTS)
    assert ids & {n, n + 1, n + 2} == {n + 1} and not ids & {n + 3, n + 4, 1, 2, 3, 10}
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in pieces} == ids


def test_near_stage_takes_five_words(docs):
    made = minhash.near_duplicates(docs("a b c d e f"), size=5).first()
    assert made.n_shingles == 2


def test_empty_documents(spark, empty, tmp_path):
    empty.write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="driver tables not there")
@pytest.mark.parametrize("name", list(queries.SQL))
def test_query_equals_its_sql(spark, monkeypatch, name):
    monkeypatch.setattr(compare, "QUERIES", queries.QUERIES)
    monkeypatch.setattr(compare, "SQL", queries.SQL)
    rows, found = compare.differences(spark, compare.connect(SF_DIR), SF_DIR, name)
    assert rows > 0 and not found


def test_every_operator_is_registered_once():
    names = [n.split("_")[0] for n in driver.queries() if n.startswith("op")]
    assert sorted(names) == sorted(f"op{n}" for n in range(1, 14))
    assert "pipeline" in driver.queries() and "pipeline" not in driver.oracle_sql()


def test_entry_works_without_the_subpackage(tmp_path):
    for item in ("__spark_entry__.py", "checks", "phrasetide"):
        (tmp_path / item).symlink_to(ROOT / item)
    (tmp_path / "phrasetide").unlink()
    (tmp_path / "phrasetide").mkdir()
    for item in (ROOT / "phrasetide").iterdir():
        if item.name != "llm":
            (tmp_path / "phrasetide" / item.name).symlink_to(item)
    code = "import __spark_entry__ as e; assert len(e.queries()) > 50 and 'pipeline' not in e.queries()"
    subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, check=True,
                   env={**os.environ, "PYTHONPATH": str(tmp_path)})
