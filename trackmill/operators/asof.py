"""As-of join: to each sample the last row of another table at or before its instant."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trackmill.functions.timing import MICROS, micros
from trackmill.operators.slices import SLICE, Series, Step, apply_steps, before

_FROM = "_asof"


def asof_join(left: DataFrame, right: DataFrame, s: Series, right_time: str, columns: Sequence[str],
              right_order: Sequence[str] = (), tolerance_s: float | None = None, age: str | None = None) -> DataFrame:
    """``left`` with the ``columns`` of the last row of ``right`` under the same ``s.key``, at or before ``s.time``.

    Rows of ``right`` at one instant are told apart by ``right_order`` and then by ``columns``: the greatest one counts.  A row that is
    older than ``tolerance_s`` is not taken, nor is an earlier one in its place.  ``age`` names a column for its age in seconds.  Every row of
    ``left`` stays, with NULLs where nothing is found; rows without a key or an instant find nothing, on either side.

    Both tables are laid into one series, in which the last known row is looked up inside the slice and, failing that, carried over from earlier
    slices.  So there is neither a range join nor a window over a whole key: a key with most of the rows is spread over its slices.
    """
    kept = left.columns
    clash = {c.lower() for c in columns} & {c.lower() for c in kept}
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    found = F.struct(micros(right_time).alias("us"), *[F.col(c).alias(f"o{k}") for k, c in enumerate(right_order)],
                     *[F.col(c).alias(f"c{k}") for k, c in enumerate(columns)])
    known = right.filter(F.col(s.key).isNotNull() & F.col(right_time).isNotNull())
    donors = known.select(F.col(s.key), F.col(right_time).cast("timestamp").alias("_at"), found.alias(_FROM))
    placed = F.col(s.key).isNotNull() & F.col(s.time).isNotNull()
    takers = left.filter(placed).withColumn("_at", F.col(s.time).cast("timestamp"))
    both = takers.unionByName(donors, allowMissingColumns=True)

    # A donor of the same instant comes first.
    merged = Series(s.key, "_at", ("_asof_side",), s.slice_s)
    both = both.withColumn("_asof_side", F.when(F.col(_FROM).isNull(), 1).otherwise(0))
    here = Window.partitionBy(s.key, SLICE).orderBy("_at", "_asof_side", _FROM).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    step = Step(
        {"_last": F.max(_FROM)},
        {"_before": F.last("_last", ignorenulls=True).over(before(merged))},
        {"_found": F.coalesce(F.last(_FROM, ignorenulls=True).over(here), F.col("_before"))},
    )
    us = micros("_at")
    found_age = (us - F.col("_found.us")) / F.lit(float(MICROS))
    near = F.lit(True) if tolerance_s is None else found_age <= tolerance_s
    taken = {c: F.when(near, F.col(f"_found.c{k}")) for k, c in enumerate(columns)}
    if age is not None:
        taken[age] = F.when(near, found_age)
    joined = apply_steps(both, merged, step).filter("_asof_side = 1").withColumns(taken)
    names = [*kept, *taken]
    return joined.select(*names).unionByName(left.filter(~F.coalesce(placed, F.lit(False))), allowMissingColumns=True)
