"""Interval join: samples with all the intervals that hold their instant."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackmill.functions.timing import MICROS, floor_div, micros
from trackmill.session import materialise

#: Shortest bucket.
UNIT_S = 60
#: Samples that one stretch of time may hold before it is split.
HEAVY = 200_000


def interval_join(samples: DataFrame, intervals: DataFrame, on: Sequence[str], time: str, start: str, end: str,
                  unit_s: int = UNIT_S, heavy: int = HEAVY) -> DataFrame:
    """Pairs of a sample and an interval with the same ``on`` columns and ``start <= time < end``, with the columns of both.

    Both sides are laid on stretches of time, each sample on one stretch, an interval on those that it meets: a stretch is as
    short as it can be with at most four copies of an interval on average.  One of more than ``heavy`` samples is split into parts of
    its time.  Inside a part intervals are indexed by time buckets of ``unit_s`` times a power of two: each goes to the level whose
    buckets are as long as it is, where it meets two of them at most.  A sample looks into one bucket of each level that has intervals,
    by one equality join, the only step that exchanges these looks; the bounds are then checked exactly.  Empty intervals, and rows without an
    instant or a bound, meet nothing.

    The driver sees the occupied levels only, 50 or so at most.
    """
    clash = {c.lower() for c in samples.columns} & {c.lower() for c in intervals.columns if c not in on}
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    unit = unit_s * MICROS
    lo, hi = micros(start), micros(end)
    level = F.greatest(F.lit(0), F.ceil(F.log2((hi - lo) / F.lit(float(unit)))).cast("int"))
    spans = intervals.filter(lo < hi).withColumn("_level", level)
    sizes = {r["_level"]: r["n"] for r in spans.groupBy("_level").agg(F.count(F.lit(1)).alias("n")).collect()} or {0: 0}
    levels = sorted(sizes)
    stretch = unit << next(
        v for v in range(levels[-1] + 1) if sum(n * (1 + 2 ** max(0, k - v)) for k, n in sizes.items()) <= 4 * sum(sizes.values())
    )

    us = micros(time)
    place = [*on, "_stretch"]
    timed = samples.filter(us.isNotNull()).withColumn("_stretch", floor_div(us, F.lit(stretch)))
    loads = timed.groupBy(*place).agg(F.count(F.lit(1)).alias("_load")).filter(F.col("_load") > heavy)
    # Written, so that the real size of the few heavy stretches decides how they are joined.
    parts = materialise(loads.select(*place, F.ceil(F.col("_load") / heavy).alias("_parts")), "parts")

    def split(df: DataFrame) -> DataFrame:
        return df.join(parts, place, "left").withColumn("_parts", F.coalesce("_parts", F.lit(1).cast("bigint")))

    def part_of(at: Column) -> Column:
        """Part of its stretch in which an instant lies."""
        inside = (at - F.col("_stretch") * F.lit(stretch)) / F.lit(stretch)
        return F.least(F.greatest(F.floor(inside * F.col("_parts")), F.lit(0)), F.col("_parts") - 1)

    left = split(timed).withColumn("_part", part_of(us)).drop("_parts")
    looks = F.array(*[F.struct(F.lit(v).alias("_level"), floor_div(us, F.lit(unit << v)).alias("_bucket")) for v in levels])
    met = F.sequence(floor_div(lo, F.lit(stretch)), floor_div(hi - 1, F.lit(stretch)))
    right = split(spans.withColumn("_stretch", F.explode(met)))
    right = right.withColumn("_part", F.explode(F.sequence(part_of(lo), part_of(hi - 1)))).drop("_parts")
    width = F.lit(unit) * F.expr("shiftleft(1L, _level)")
    right = right.withColumn("_bucket", F.explode(F.sequence(floor_div(lo, width), floor_div(hi - 1, width))))
    joined = left.select("*", F.inline(looks)).join(right, [*place, "_part", "_level", "_bucket"])
    mine = [c for c in intervals.columns if c not in on]
    return joined.filter((us >= lo) & (us < hi)).select(*samples.columns, *mine)
