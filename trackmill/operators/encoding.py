"""Categories to codes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trackmill.functions.encodings import type_family
from trackmill.operators.stats import value_share
from trackmill.session import materialise

#: Width of the order ranges in which codes are counted: a range holds at most this many values.
ORDER_RANGE = 1_000_000


def first_appearance_codes(df: DataFrame, cols: Sequence[str], order: str, width: int = ORDER_RANGE) -> DataFrame:
    """Dictionary ``(column, value, code)``: values numbered by the smallest ``order`` they occur at.

    All columns in one pass, combined map-side to one row per value.  ``order`` is an integer
    column, unique per row; numbering happens inside ranges of it and is shifted by the counts of
    the earlier ranges, so no task sees a whole dictionary.
    """
    pairs = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols
    ]))
    firsts = (
        df.select(F.col(order).alias("_at"), pairs.alias("p"))
        .filter(F.col("p.value").isNotNull())
        .groupBy("p.column", "p.value").agg(F.min("_at").alias("_at"))
        .withColumn("_range", F.col("_at") - F.pmod("_at", F.lit(width)))
    )
    ahead = Window.partitionBy("column").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    counts = (
        firsts.groupBy("column", "_range").agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_base", F.coalesce(F.sum("_n").over(ahead), F.lit(0)))
    )
    inside = Window.partitionBy("column", "_range").orderBy("_at", "value")
    return (
        firsts.join(counts, ["column", "_range"])
        .withColumn("code", F.col("_base") + F.row_number().over(inside) - 1)
        .select("column", "value", "code")
    )


def factorize(df: DataFrame, cols: Sequence[str], order: str, width: int = ORDER_RANGE) -> DataFrame:
    """Replace categories by integer codes in order of first appearance; NULL becomes -1.

    The dictionary is materialised once, so that its real size decides between a broadcast and a
    shuffle join for each column.
    """
    codes = materialise(first_appearance_codes(df, cols, order, width), "codes")
    out = df
    for c in cols:
        mine = codes.filter(F.col("column") == c).select(F.col("value").alias("_v"), F.col("code").alias("_code"))
        out = (
            out.join(mine, F.col(c).cast("string") == F.col("_v"), "left")
            .withColumn(c, F.coalesce("_code", F.lit(-1)).cast("bigint"))
            .drop("_v", "_code")
        )
    return out.select(*df.columns)


def rare_to_other(df: DataFrame, col: str, threshold: float = 0.01, other: str = "Other") -> DataFrame:
    """Values whose share is strictly below ``threshold`` become ``other``.

    Only the frequent values are looked up: never more than ``1 / threshold`` of them, which bounds
    the broadcast.
    """
    frequent = value_share(df, col).filter(F.col("share") >= threshold).select(F.col(col).alias("_kept"))
    out = df.join(F.broadcast(frequent), F.col(col) == F.col("_kept"), "left")
    return out.withColumn(
        col, F.when(F.col(col).isNotNull(), F.coalesce("_kept", F.lit(other)))
    ).select(*df.columns)


def combine_types(df: DataFrame, col: str = "aircraft_type", threshold: float = 0.01) -> DataFrame:
    return rare_to_other(df.withColumn(col, type_family(col)), col, threshold)
