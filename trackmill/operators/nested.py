"""Tracks as arrays: a slice is one row, worked on by higher-order functions instead of windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackmill.functions.timing import micros, seconds
from trackmill.operators.slices import SLICE, Series, sliced

TRACK = "track"


def nest(df: DataFrame, s: Series, columns: Sequence[str]) -> DataFrame:
    """One row per (entity, slice): ``track``, an array of (us, tie columns, columns) in order.

    Ordered by its leading fields, so the order is that of the series; a slice bounds its length.
    """
    sample = F.struct(micros(s.time).alias("us"), *[F.col(c) for c in s.tie], *[F.col(c) for c in columns if c not in s.tie])
    return sliced(df, s).groupBy(*s.group).agg(F.array_sort(F.collect_list(sample)).alias(TRACK))


def unnest(nested: DataFrame, s: Series) -> DataFrame:
    """The samples again, with ``s.time`` from their microseconds."""
    rows = nested.select(s.key, F.inline(TRACK))
    return rows.withColumn(s.time, F.timestamp_micros("us")).drop("us")


def with_neighbours(nested: DataFrame, s: Series) -> DataFrame:
    """Add ``first_us`` of the entity and ``before``, the last sample of the slice ahead: windows over rows that are slices."""
    edge = F.element_at(TRACK, -1)
    return nested.withColumns({"first_us": F.min(F.element_at(TRACK, 1)["us"]).over(s.entity()), "before": F.lag(edge).over(s.slices())})


def map_samples(nested: DataFrame, **fields) -> DataFrame:
    """Add fields to every sample: each is a function of the sample, the one before it (NULL for the first) and the slice's row."""
    def changed(x: Column, i: Column) -> Column:
        ahead = F.when(i > 0, F.get(TRACK, i - 1)).otherwise(F.col("before"))
        out = x
        for name, value in fields.items():
            out = out.withField(name, value(x, ahead))
        return out

    return nested.withColumn(TRACK, F.transform(TRACK, changed))


def elapsed(x: Column, ahead: Column) -> Column:
    """Seconds since the entity's first sample."""
    return seconds(x["us"] - F.col("first_us"))


def rate(column: str, scale: float = 1.0, first: float = 0.0):
    """Difference quotient over seconds, as ``timeseries.rate_step`` has it."""
    def of(x: Column, ahead: Column) -> Column:
        return F.when(ahead.isNull(), F.lit(first)).otherwise(F.try_divide(x[column] - ahead[column], seconds(x["us"] - ahead["us"])) / scale)

    return of


def summary(nested: DataFrame, s: Series, column: str) -> DataFrame:
    """Per entity, the total climb (sum of rises) and the number of known values of a column, folded over arrays.

    Rises are taken between neighbouring known values; the state handed from slice to slice is the last known value.
    """
    known = F.filter(F.transform(TRACK, lambda x: x[column]), lambda v: v.isNotNull())
    parts = nested.select(s.key, SLICE, known.alias("v"))
    rise = F.aggregate(F.zip_with(F.slice("v", 2, F.greatest(F.size("v") - 1, F.lit(0))), F.slice("v", 1, F.greatest(F.size("v") - 1, F.lit(0))),
                                  lambda b, a: F.greatest(b - a, F.lit(0.0))), F.lit(0.0), lambda total, r: total + r)
    ends = parts.select(s.key, SLICE, rise.alias("rise"), F.size("v").alias("n"), F.get("v", F.lit(0)).alias("lo"), F.try_element_at("v", F.lit(-1)).alias("hi"))
    ahead = F.last("hi", ignorenulls=True).over(s.slices().rowsBetween(-(1 << 31), -1))
    joint = F.when(F.col("lo").isNotNull() & F.col("ahead").isNotNull(), F.greatest(F.col("lo") - F.col("ahead"), F.lit(0.0))).otherwise(0.0)
    return (ends.withColumn("ahead", ahead).groupBy(s.key)
            .agg(F.sum(F.col("rise") + joint).alias("total_climb"), F.sum("n").cast("bigint").alias("known")))
