"""The corpus pipeline: quality rules, exact dedup, near-copy dedup, personal
data, packing. Each stage is a function (spark, docs, sf_dir) -> DataFrame
whose result is written as Parquet and read again as the next stage's docs;
all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ridgeline.llm import exact_dedup, jaccard_join, packing, pii, quality_rules
from ridgeline.llm.common import table
from ridgeline.session import scratch_path, scratch_scope


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go, and kept ones lose their failing lines. Null and
    empty texts are rejected; ids, repeated rows and other columns stay as
    they are; an empty table stays empty."""
    return quality_rules.kept_documents(docs)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (blanks aside) the longest stays, then the smallest id."""
    return exact_dedup.exact_dedup(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents that near-copy links connect (five-word
    shingles, Jaccard similarity of at least 0.8) the smallest id stays."""
    return jaccard_join.one_per_component(docs)


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every span of personal data is replaced by its kind."""
    return pii.redacted(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All remaining documents packed into sequences of 1024 tokens: one row
    per piece."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_stage),
    ("exact_dedup", exact_stage),
    ("jaccard_join", near_stage),
    ("personal_data", personal_data_stage),
    ("best_fit_packing", packing_stage),
]

# The model of the personal-data stage and the packing have no SQL form; the
# pipeline is tested against a plain version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written and read again; what
    a stage has kept in the shared folder on its way goes when it is done."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        with scratch_scope(spark):
            out = stage(spark, docs, sf_dir)
            out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
