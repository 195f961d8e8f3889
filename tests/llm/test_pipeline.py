"""The five stages: columns, decisions against the operators, and the entry without them."""

import os
import shutil
import subprocess
import sys

import pytest

import corpus_pipeline
from riskframe.llm import decontaminate, quality, simhash
from riskframe.llm.mixture import Mixture
from riskframe.session import materialise

ROOT = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))


def test_stages_hand_on_whole_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, before = docs.columns, docs
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        out[name] = docs = materialise(stage(spark, docs, sf_dir), "stage")
        if name != "sharding":
            assert docs.columns == columns
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    good = {r.doc_id for r in quality.classify(before, labels).where("predicted = 1").collect()}
    kept = {r.doc_id for r in out["quality"].collect()}
    assert kept == good
    heads = {r.component for r in simhash.near_duplicates(out["quality"]).collect()}
    unique = {r.doc_id for r in out["near-duplicates"].collect()}
    assert unique == heads and out["near-duplicates"].count() == len(heads)
    leaks = {r.doc_id for r in decontaminate.find_leaks(out["near-duplicates"], spark.read.parquet(f"{sf_dir}/benchmark.parquet")).collect()}
    clean = {r.doc_id for r in out["decontamination"].collect()}
    assert clean == unique - leaks
    taken = {r.doc_id: r.taken for r in Mixture().report(out["decontamination"]).collect()}
    words = {}
    for r in out["mixture"].collect():
        words[r.doc_id] = words.get(r.doc_id, 0) + len(r.text.split())
    assert words == {k: v for k, v in taken.items() if v}
    rows = out["sharding"].collect()
    assert len(rows) == out["mixture"].count() and {r.shard for r in rows} <= set(range(40))


@pytest.mark.parametrize("gone", [("corpus_pipeline.py", "riskframe/llm", "tests/llm")])
def test_entry_works_without_this_package(tmp_path, gone):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "spark-warehouse*", "__pycache__", *[os.path.basename(g) for g in gone]))
    code = "import __spark_entry__ as e; q = e.queries(); assert q and not any(k.startswith('op') or k == 'pipeline' for k in q); assert set(e.oracle_sql()) <= set(q)"
    done = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
