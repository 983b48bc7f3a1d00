"""Sessions: positions cut into flights where nothing was heard for a while, in batch and in streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trackmill.functions.timing import MICROS, micros
from trackmill.operators.slices import Series, Step, apply_steps, carried_total


def session_step(s: Series, gap_s: float, name: str = "session") -> Step:
    """Number of the sample's session in its entity, from 0: a new one begins ``gap_s`` seconds or more after the sample before.

    Gaps inside a slice are marked there; a gap at a slice's edge shows from the extents of the slices, and the marks of all earlier
    slices are carried over.
    """
    us, gap = micros(s.time), round(gap_s * MICROS)
    so_far = s.rows().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return Step(
        {"_marks": F.sum("_mark"), "_session_lo": F.min(us), "_session_hi": F.max(us)},
        {
            "_marks_before": carried_total("_marks", s),
            "_edge": F.coalesce((F.col("_session_lo") - F.lag("_session_hi").over(s.slices()) >= gap).cast("bigint"), F.lit(0)),
        },
        {name: F.col("_marks_before") + F.col("_edges") + F.sum("_mark").over(so_far)},
        prepare={"_mark": F.coalesce((us - F.lag(us).over(s.rows()) >= gap).cast("bigint"), F.lit(0))},
        late={"_edges": F.sum("_edge").over(s.slices().rowsBetween(Window.unboundedPreceding, Window.currentRow))},
    )


def with_sessions(df: DataFrame, s: Series, gap_s: float, name: str = "session") -> DataFrame:
    """Add the session number of each sample; for positions without a flight id, (entity, session) is one."""
    return apply_steps(df, s, session_step(s, gap_s, name))


def session_summary(df: DataFrame, s: Series, gap_s: float) -> DataFrame:
    """One row per session: entity, ``started``, ``ended`` (its last sample) and ``samples``.

    The same for a batch and, in append mode with a watermark on ``s.time``, for a stream, whose state is one row per
    open session.
    """
    # The engine still merges samples that are exactly its gap apart.
    apart = f"INTERVAL '{(round(gap_s * MICROS) - 1) / MICROS:.6f}' SECOND"
    window = F.session_window(F.col(s.time), f"{round(gap_s * MICROS) - 1} microseconds")
    ended = F.col("session_window.end") - F.expr(apart)
    return (df.groupBy(s.key, window).agg(F.count(F.lit(1)).alias("samples"))
            .select(s.key, F.col("session_window.start").alias("started"), ended.alias("ended"), "samples"))
