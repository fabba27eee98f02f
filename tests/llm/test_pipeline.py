import os
import shutil
import subprocess
import sys

import corpus_pipeline
from basketry.llm import minhash

from .helpers import LARGE, MIDDLE, SMALL, edge_documents, empty_documents

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_stages_and_their_columns(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "language", "near_duplicates", "mixture", "packing"]
    docs = spark.read.parquet(f"{LARGE}/documents.parquet")  # with examples enough to learn from
    toxic = {r.doc_id for r in spark.read.parquet(f"{LARGE}/labels.parquet").where("toxic = 1").collect()}
    clean = {r.doc_id for r in spark.read.parquet(f"{LARGE}/labels.parquet").where("toxic = 0").collect()}
    out = corpus_pipeline.toxicity(spark, docs, LARGE)
    left = {r.doc_id for r in out.select("doc_id").collect()}
    assert out.columns == docs.columns and len(toxic & left) <= 0.1 * len(toxic) and len(clean & left) >= 0.99 * len(clean)
    docs = spark.read.parquet(f"{MIDDLE}/documents.parquet").cache()
    spoken = corpus_pipeline.language(spark, docs, MIDDLE)
    assert spoken.columns == docs.columns and spoken.count() >= 0.97 * docs.count()
    one = corpus_pipeline.near_duplicates(spark, docs, MIDDLE)
    kept = {r.key for r in minhash.near_duplicates(docs, 5).where("kept").collect()}
    assert one.columns == docs.columns and sorted(r.doc_id for r in one.collect()) == sorted(kept)
    mixed = corpus_pipeline.mixture(spark, docs, MIDDLE)
    assert mixed.columns == docs.columns and mixed.select("doc_id").distinct().count() == docs.count()


def test_few_toxic_documents_pass_on_either_table(spark):
    for sf in (MIDDLE, LARGE):
        docs = spark.read.parquet(f"{sf}/documents.parquet")
        labels = spark.read.parquet(f"{sf}/labels.parquet").where("toxic is not null").collect()
        left = {r.doc_id for r in corpus_pipeline.toxicity(spark, docs, sf).select("doc_id").collect()}
        toxic, clean = ({r.doc_id for r in labels if r.toxic == y} for y in (1, 0))
        assert len(toxic & left) <= 0.1 * len(toxic) and len(clean & left) >= 0.97 * len(clean), sf


def test_run(spark):
    places = corpus_pipeline.run(spark, SMALL)
    assert places.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and places.count() > 100


def test_every_stage_on_edge_cases(spark):
    for make in (edge_documents, empty_documents):
        docs = make(spark)
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SMALL)
            assert name == "packing" or out.columns == docs.columns
            assert out.count() >= 0


def test_the_rest_works_without_these_folders(tmp_path):
    shutil.copytree(ROOT, tmp_path / "repo", ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    code = "import __spark_entry__ as e; q = e.queries(); e.oracle_sql(); print(len(q), sum(k.startswith('op') and k[2].isdigit() for k in q), 'pipeline' in q)"
    said = subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "repo", capture_output=True, text=True, check=True).stdout.split()
    assert int(said[0]) > 200 and said[1:] == ["0", "False"]
