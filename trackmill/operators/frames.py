"""Statistics over a stretch of seconds around each sample."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from trackmill.functions.timing import MICROS, floor_div, micros
from trackmill.operators.slices import Series


def with_time_frame(df: DataFrame, s: Series, columns: Mapping[str, Callable[[WindowSpec], Column]], before_s: float, after_s: float = 0.0,
                    block_s: float | None = None) -> DataFrame:
    """Add columns computed over the rows of the same entity from ``before_s`` seconds before to ``after_s`` after each row.

    Each entry is a function of the window, such as ``lambda w: F.avg("altitude").over(w)``; both ends count, and rows of the same instant are in
    each other's frame.  Rows without an instant have a frame of each other, as in SQL.

    Rows are cut into blocks of ``block_s`` seconds (by default, as long as the frame); each row is copied to the blocks
    whose frames reach it, so a window holds the rows of a block and of one frame, however long the entity is.  Dense data takes shorter
    blocks, at the cost of more copies: 1 + (before_s + after_s) / block_s of each row.
    """
    before, after = round(before_s * MICROS), round(after_s * MICROS)
    block = round((block_s or max(before_s + after_s, 1.0)) * MICROS)
    if min(before, after) < 0 or block <= 0:
        raise ValueError("a frame reaches back and ahead, and blocks have a length")
    us = micros(s.time)
    width = F.lit(block)
    own = floor_div(us, width)
    # A row is in the frames of rows from `after` before it to `before` after it.
    reach = F.sequence(floor_div(us - after, width), floor_div(us + before, width))
    copies = df.withColumns({"_us": us, "_own": own}).withColumn("_block", F.explode_outer(reach))
    frame = Window.partitionBy(s.key, "_block").orderBy("_us").rangeBetween(-before, after)
    done = copies.withColumns({n: c(frame) for n, c in columns.items()})
    return done.filter(F.col("_block").eqNullSafe(F.col("_own"))).drop("_us", "_own", "_block")


def frame_copies(before_s: float, after_s: float, block_s: float) -> int:
    """How many blocks a row is copied to at most."""
    return math.ceil((before_s + after_s) / block_s) + 1
