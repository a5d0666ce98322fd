"""From documents to packed training sequences: five stages, each written as Parquet and read by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cueloom.llm.common import forgetting, stored, table
from cueloom.llm.decontaminate import drop_contaminated
from cueloom.llm.line_dedup import dedup_lines
from cueloom.llm.queries import packed, quality_scored
from cueloom.llm.simhash import drop_near_copies


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject (score 0.5 or more)."""
    names = docs.columns
    return quality_scored(docs, spark, sf_dir).where("predicted = 1").select(*names)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that are repeated, or nearly so, elsewhere."""
    return dedup_lines(docs).select(*docs.columns)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one of the smallest doc_id."""
    return drop_near_copies(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their place in a training sequence."""
    return packed(docs)


STAGES = [
    ("quality_classifier", quality),
    ("line_dedup", line_dedup),
    ("simhash_dedup", simhash_dedup),
    ("benchmark_decontamination", decontamination),
    ("best_fit_packing", packing),
]

#: SQL has no tokenizer, no votes and no MinHash. ``run`` is compared with plain Python in the tests, stage by stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``. A stage's tables go when its result is written."""
    docs = table(spark, sf_dir, "documents")
    *filters, (_, last) = STAGES
    for name, stage in filters:
        with forgetting(spark):
            docs = stored(stage(spark, docs, sf_dir), name, keep=True)
    return last(spark, docs, sf_dir)
