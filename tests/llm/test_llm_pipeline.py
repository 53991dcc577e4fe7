"""The pipeline's stages, and every registered query of the package."""

import os
import subprocess
import sys

import pytest
from compare import connect, difference

import corpus_pipeline
from haatlake.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    at = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id for r in at.select("doc_id").collect()}
        at = stage(spark, at, SF)
        assert at.columns == docs.columns, name
        after = [r.doc_id for r in at.select("doc_id").collect()]
        assert len(after) == len(set(after)) and set(after) <= before and len(after) > 0.7 * len(before)


def test_pipeline_equals_its_stages(spark):
    import test_llm_joins as joins
    from haatlake.llm import langid, quality
    from haatlake.llm.common import in_bucket

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    scores = quality.score(docs, quality.train(docs, spark.read.parquet(f"{SF}/labels.parquet"), ~in_bucket("doc_id", 5, 0))).collect()
    good = docs.where(docs.doc_id.isin([r.doc_id for r in scores if r.score >= 0.3]))
    langs = langid.predict(good, langid.train(good, ~in_bucket("doc_id", 4, 2))).collect()
    known = sorted(r.doc_id for r in langs if not r.rejected)
    want = set(joins.five([(i, rows[i].text) for i in known]))
    got = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in got} == want
    assert all(sum(p.length for p in got if p.doc_id == i) == next(p.doc_tokens for p in got if p.doc_id == i) for i in want)


def test_stages_take_odd_rows(spark):
    rows = [(1, None, None, None, None, "x"), (2, "", "en", "s", 0, "x"), (None, "some words of a text", "en", "s", 20, "x"), (4, "some words of a text", None, "s", 20, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score string")
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert out.count() >= 0 and stage(spark, docs.limit(0), SF).count() == 0
    kept = corpus_pipeline.jaccard_join(spark, docs, SF)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {1, 2, 4}


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, name):
    got = QUERIES[name](spark, SF)
    if name in ORACLE:
        assert difference(got, connect(SF), ORACLE[name]) is None
    else:
        assert got.count() > 0


def test_entry_works_without_the_package():
    """Only __spark_entry__ guards the import."""
    code = ("import sys\nclass No:\n def find_spec(self, n, p=None, t=None):\n  if n in ('corpus_pipeline', 'haatlake.llm'): raise ModuleNotFoundError(n, name=n)\n"
            "sys.meta_path.insert(0, No())\nimport __spark_entry__ as e\nassert 'pipeline' not in e.queries() and len(e.queries()) > 100")
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)
