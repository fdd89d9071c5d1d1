"""From raw documents to shuffled shards of training data, in five stages.

Each stage reads what the one before has written and returns a DataFrame with the columns of
``documents``; the last adds ``shard`` and ``slot``. None of them relies on unique ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm import decontaminate, mixing, neardup, outliers, sharding
from shelfmark.llm.queries import prepared
from shelfmark.session import store


def _columns(docs: DataFrame):
    return [F.col(f"`{c}`") for c in docs.columns]


def _free(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` doesn't have."""
    while name in docs.columns:
        name += "_"
    return name


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither fail the base rules nor are outliers of their language and source.
    Null and empty texts go; repeated rows stay or go together."""
    name = _free(docs, "quality")
    return outliers.quality(docs, name=name).where(f"{name}.kept").select(*_columns(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the least id, of each group linked by a similarity of 0.8 or more over
    five-word shingles. Texts without words are no duplicates."""
    return neardup.without_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no ten-word window of a benchmark item occurs. A document with one goes
    as a whole, as what is around a leaked passage often is its answer."""
    name = _free(docs, "contamination")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.contamination(docs, benchmark, name=name)
    return found.where(f"{name}.n_hit = 0").select(*_columns(docs))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the order they are trained on, a row for each time one is taken, so that sources
    come near their target weights. Texts without words aren't taken."""
    return mixing.curriculum(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows, with the shard of eight that each lies in and its slot there. Equal texts share a shard."""
    name = _free(docs, "sharding")
    placed = sharding.shards(docs, name=name)
    return placed.select(*_columns(docs), f"{name}.shard", f"{name}.slot")


STAGES = [
    ("quality rules", quality),
    ("near duplicates", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing sources", mixture),
    ("sharding", shards),
]

#: No SQL has the quality estimate, bin packing or the curriculum; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the ``documents`` of a folder."""
    prepared(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
