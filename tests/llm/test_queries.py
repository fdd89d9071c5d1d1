"""The registered queries against their SQL, and the pipeline stage by stage."""

import sys
from collections import Counter
from pathlib import Path

import pytest

import corpus_pipeline
from shelfmark.llm.queries import QUERIES, SQL

sys.path.insert(0, str(Path(__file__).resolve().parents[2] / "tools"))
from check import differences  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    assert differences(QUERIES[name](spark, FOLDER), FOLDER, SQL.get(name)) == ""


def test_mixing_is_native(spark, plan):
    text = plan(QUERIES["op5_mixing"](spark, FOLDER))
    assert not any(word in text for word in ("Python", "Arrow", "Pandas", "CartesianProduct", "NestedLoop"))


def test_pipeline_stages(spark):
    """Each stage against the operators' own results, which test_operators compares with brute force."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality rules", "near duplicates", "benchmark decontamination", "mixing sources", "sharding",
    ]
    odd = spark.createDataFrame([(None, None, None, None, None), (0, "", "en", "x", 0)], docs.schema)
    docs = docs.unionByName(odd).withColumn("quality", docs["n_chars"])
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, FOLDER)
        rows, before = out.collect(), docs.collect()
        whole = Counter((r.doc_id, r.text) for r in before)
        found = Counter((r.doc_id, r.text) for r in rows)
        assert out.columns[: len(docs.columns)] == docs.columns and found.keys() <= whole.keys() and rows
        if name in ("quality rules", "near duplicates", "benchmark decontamination"):
            assert len(rows) < len(before) and max(found.values()) == 1
        if name == "sharding":
            assert found == whole and {"shard", "slot"} <= set(out.columns)
        docs = spark.createDataFrame(rows, out.schema)


def test_pipeline_runs_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER)
        assert docs.count() == 0
