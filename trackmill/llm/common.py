"""Small helpers of the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trackmill.session import materialise

#: ASCII white space: what separates words everywhere in this package.
SPACE = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def any_value_of(values: DataFrame, key: str, value: str) -> DataFrame:
    """One row per non-null key with its largest value, for tables that may repeat a key."""
    return values.where(F.col(key).isNotNull() & F.col(value).isNotNull()).groupBy(key).agg(F.max(value).alias(value))


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """True for the share of ids that no model may learn from (crc32 of the id as text; null id: of the empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds == 0


def written(df: DataFrame, label: str, rows: int = 1000) -> DataFrame:
    """``materialise`` with at most ``rows`` rows in a batch handed to Python, so that whole texts stay few there.

    The setting holds for this one write and is put back.
    """
    spark, name = df.sparkSession, "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        return materialise(df, label)
    finally:
        spark.conf.set(name, before)


#: A key with more than one in so many rows is dealt to several tasks; there are no more such keys than this.
HOT_SHARE = 1000


def spread_join(rows: DataFrame, table: DataFrame, key: str, by: str, counted: DataFrame | None = None) -> DataFrame:
    """Inner join on ``key``, where a few keys may hold a large part of ``rows``.

    The rows of a hot key are dealt to as many parts as it holds thousandths of all rows, by a hash of ``by``, and its rows of
    ``table`` are copied to each.  Hot keys are counted (added up before the shuffle) and broadcast, ``HOT_SHARE`` rows at most.  They are
    counted in ``counted``, a written table with the same keys, or else in ``rows``.
    """
    counted = rows if counted is None else counted
    total = counted.count()
    hot = counted.groupBy(key).agg(F.count(F.lit(1)).alias("_llm_rows")).where(F.col("_llm_rows") * HOT_SHARE > total).select(key, F.ceil(F.col("_llm_rows") * HOT_SHARE / max(total, 1)).cast("int").alias("_llm_parts"))
    dealt = rows.join(F.broadcast(hot), key, "left")
    dealt = dealt.withColumn("_llm_part", F.coalesce(F.pmod(F.xxhash64(by), F.col("_llm_parts")).cast("int"), F.lit(0))).drop("_llm_parts")
    copied = table.join(F.broadcast(hot), key, "left")
    copied = copied.withColumn("_llm_part", F.explode(F.sequence(F.lit(0), F.coalesce("_llm_parts", F.lit(1)) - 1))).drop("_llm_parts")
    return dealt.join(copied, [key, "_llm_part"]).drop("_llm_part")
