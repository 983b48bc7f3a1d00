"""From raw documents to packed sequences: five stages, each over all that its predecessor kept.

Defined cases, stage by stage: documents without text, or with a blank or very short one, fall to the rules' base check; very long texts are
judged, compared and packed whole; of rows that share an id the near-duplicate stage keeps the one with the smallest text, and rows without an id all
stay in it; sources that are null or not named share the rest of the mixture; an empty table gives empty tables.  Columns beside the known ones,
whatever their names, are carried along up to the packing stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trackmill.llm import mixing, near_dedup, packing, quality_model, quality_rules
from trackmill.llm.common import table
from trackmill.llm.queries import REST_WEIGHT, WEIGHTS, tokenizer_file
from trackmill.session import materialise


def quality_rule_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly supervised rules keep."""
    return quality_rules.kept_documents(docs)


def quality_classifier_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the discriminant predicts to be good; it learns from all labelled documents, as the rules leave hardly a bad one."""
    return quality_model.kept_documents(docs, table(spark, sf_dir, "labels"), lessons=table(spark, sf_dir, "documents"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return near_dedup.kept_documents(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that sources make up their target shares, in shuffled order."""
    return mixing.mix(docs, WEIGHTS, REST_WEIGHT, copy_col="_llm_copy", key_col="_llm_key").drop("_llm_copy", "_llm_key")


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 2048 ids."""
    return packing.pack(docs, tokenizer_file(), digest=True)


STAGES = [
    ("quality rules", quality_rule_stage),
    ("quality classifier", quality_classifier_stage),
    ("near duplicates", near_dedup_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: Models and sketches are not for SQL; the pipeline is tested against a stage-by-stage plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read back for the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
