"""The registered queries of the training-data operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackmill.llm import (
    divergence, fingerprints, mixing, near_dedup, packing, perspectives, quality_model, quality_rules, records, suffix_dedup, toxicity, url_filter,
    whitening)
from trackmill.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

#: Shares of the mixture that the mixing query and the pipeline aim at; sources that are not named share the rest.
WEIGHTS = {"src0": 10.0, "src1": 8.0, "src2": 8.0, "src3": 6.0, "src4": 6.0, "src5": 4.0, "src6": 4.0, "src7": 2.0, "src8": 2.0, "src9": 1.0}
REST_WEIGHT = 50.0


def tokenizer_file() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register


@query("op1_quality_classifier")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op6_near_duplicates")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


@query("op7_quality_rules")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents")).select(
        "doc_id", *quality_rules.statistics_columns(), "posterior", "base_failed", "kept")


@query("op8_packing")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_file(), digest=True)


@query("op2_binary_records")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.round_trip(table(spark, sf_dir, "documents"), tokenizer_file(), digest=True)


@query("op9_url_filter", url_filter.oracle())
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages")).drop("strict_terms", "soft_terms")


@query("op3_mixing", mixing.oracle(WEIGHTS, REST_WEIGHT))
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), WEIGHTS, REST_WEIGHT)


@query("op10_multiset_fingerprints", fingerprints.oracle())
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, sf_dir, "documents"))


@query("op4_toxicity_chain")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op5_perspective_rotation", perspectives.oracle())
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perspectives.rotate(table(spark, sf_dir, "conversations"))


@query("op13_source_divergence", divergence.oracle())
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


@query("op12_embedding_whitening")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@query("op11_suffix_dedup")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digests(suffix_dedup.cut_out(table(spark, sf_dir, "documents")))
