"""The pipeline's stages against brute force over their own inputs, and the entry's guard."""

import os
import subprocess
import sys

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from sparktab.llm import quality_fm, rules, secrets


@pytest.fixture(scope="module")
def runs(spark, tmp_path_factory):
    """Input and output of every stage over sf0.001."""
    d, out = "/root/testdata/sf0.001", []
    docs = spark.read.parquet(f"{d}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp(name) / "t")
        stage(spark, docs, d).write.parquet(path)
        after = spark.read.parquet(path)
        out.append((name, docs, after))
        docs = after
    return out


def test_names_and_columns(runs):
    assert [n for n, _, _ in runs] == ["quality", "rules", "near_dups", "secrets", "packing"]
    for _, before, after in runs[:-1]:
        assert after.columns == before.columns and after.dtypes == before.dtypes


def test_quality_stage(spark, runs):
    _, before, after = runs[0]
    model = quality_fm.train(before, spark.read.parquet("/root/testdata/sf0.001/labels.parquet"))
    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in before.collect() if model.score(r.text) >= 0.7}


def test_rules_stage(runs):
    _, before, after = runs[1]
    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in before.collect() if not any(f(rules.Text(r.text)) for f in rules.RULES.values())}


def test_near_dup_stage(runs):
    _, before, after = runs[2]
    left = after.collect()
    texts = [" ".join(r.text.split()) for r in left]
    assert len(set(texts)) == len(texts)
    assert {r.doc_id for r in left} <= {r.doc_id for r in before.collect()}


def test_secret_stage(runs):
    _, before, after = runs[3]
    assert before.count() == after.count()
    for r in after.collect():
        assert not secrets.base_spans(r.text)


def test_packing_stage(runs):
    _, before, after = runs[4]
    rows = after.collect()
    assert {r.doc_id for r in rows} == {r.doc_id for r in before.collect()}
    for d in {r.doc_id for r in rows}:
        own = sorted((r for r in rows if r.doc_id == d), key=lambda r: r.start)
        assert sum(r.length for r in own) == own[0].doc_tokens


def test_stages_take_empty_and_odd_tables(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, score string"
    d = "/root/testdata/sf0.001"
    odd = [(1, None, None, None, None, "x"), (None, "a few words", None, None, None, None), (2, "", "en", "s", 0, "y"), (2, "", "en", "s", 0, "y")]
    for rows in ([], odd):
        docs = spark.createDataFrame(rows, schema)
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, d)
            assert name == "packing" or out.columns == docs.columns
            out.write.parquet(str(tmp_path / f"{name}{len(rows)}"))


def test_entry_without_the_subpackage(tmp_path):
    """Without the pipeline file and the subpackage the entry still gives the other queries."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    code = ("import sys; sys.modules['sparktab.llm'] = None; sys.modules['corpus_pipeline'] = None; sys.path.insert(0, %r); "
            "import __spark_entry__ as e; q = e.queries(); assert q and not any(k.startswith('op1_') or k == 'pipeline' for k in q); e.oracle_sql()") % root
    subprocess.run([sys.executable, "-c", code], check=True, timeout=120)


CLASHES = ["_id", "_b", "_w", "_bits", "_maybe", "key", "component", "maybe", "LOST_ID", "sample_id", "sample_hash", "filter_word",
           "filter_bits", "filter_place", "n", "cell", "length", "offset", "rule", "s", "label", "_k", "_y", "_t"]


@pytest.mark.parametrize("at", range(5))
def test_columns_with_any_name_go_along(spark, runs, at):
    name, before, after = runs[at]
    more = before.select("*", *[F.lit(i).alias(c) for i, c in enumerate(CLASHES)])
    got = corpus_pipeline.STAGES[at][1](spark, more, "/root/testdata/sf0.001")
    if at < 4:
        assert got.columns == more.columns
        assert sorted(r.doc_id for r in got.select("doc_id").collect()) == sorted(r.doc_id for r in after.collect())
        assert got.select(*CLASHES).distinct().count() == 1
    else:
        assert got.columns == after.columns and got.count() == after.count()
