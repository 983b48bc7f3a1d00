"""Time slices: how ordered per-entity work stays spread out, whatever the size of an entity.

An entity (a flight) may hold a large part of all rows, so a window over the whole entity could
end in one task.  Every ordered operator therefore works on *(entity, time slice)* groups: the
rows of an entity inside one fixed stretch of time.  Once exact repeats of an instant are removed
(``dedup_first``, which combines before the shuffle) a slice holds at most ``slice length x clock
rate`` rows; where the clock may be fast for a long time, ``Series.max_rows`` cuts slices by their rows as well.  What a slice needs to know about the others - its predecessor's last row, a running
total, the entity's extent - is a *carry*: slices are aggregated (combined map-side) to one small
row each, windows run over those rows, and the result is joined back on (entity, slice).

All operators share that partitioning, so one exchange of the samples serves a chain of them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from trackmill.functions.timing import MICROS, micros

SLICE = "_slice"

#: Cells of time that a slice is cut into to find where its rows lie.
CELLS = 4096


@dataclass(frozen=True)
class Series:
    """Which columns make up a time series, and how long a slice of it is.

    ``tie`` orders rows of the same instant; together with ``time`` it should be unique per entity.
    With ``max_rows`` a slice of more rows is cut, at the cost of one more exchange, into parts of at most so many and
    what falls into one more of its ``CELLS`` cells of time.
    """

    key: str = "flight_id"
    time: str = "event_time"
    tie: tuple[str, ...] = ("seq",)
    slice_s: int = 900
    max_rows: int | None = None

    @property
    def order(self) -> tuple[str, ...]:
        return (self.time, *self.tie)

    @property
    def group(self) -> tuple[str, str]:
        return (self.key, SLICE)

    def rows(self) -> WindowSpec:
        """Rows of one slice in order."""
        return Window.partitionBy(*self.group).orderBy(*self.order)

    def in_slice(self) -> WindowSpec:
        """All rows of one slice."""
        return Window.partitionBy(*self.group)

    def slices(self) -> WindowSpec:
        """Slice summaries of one entity in order."""
        return Window.partitionBy(self.key).orderBy(SLICE)

    def entity(self) -> WindowSpec:
        """All slice summaries of one entity."""
        return Window.partitionBy(self.key)

    def row_sql(self) -> str:
        return f"PARTITION BY `{self.key}`, `{SLICE}` ORDER BY " + ", ".join(f"`{c}`" for c in self.order)

    def slice_sql(self) -> str:
        return f"PARTITION BY `{self.key}` ORDER BY `{SLICE}`"


def sliced(df: DataFrame, s: Series) -> DataFrame:
    """Add the start of the row's slice in epoch microseconds."""
    if SLICE in df.columns:
        return df
    us = micros(s.time)
    out = df.withColumn(SLICE, us - F.pmod(us, F.lit(s.slice_s * MICROS)))
    return out if s.max_rows is None else _cut(out, s)


def _cut(df: DataFrame, s: Series) -> DataFrame:
    """Cut slices of more than ``max_rows`` rows where the running count of their cells passes a multiple of it."""
    width = max(1, s.slice_s * MICROS // CELLS)
    past = micros(s.time) - F.col(SLICE)
    rows = df.withColumn("_cell", F.col(SLICE) + past - F.pmod(past, F.lit(width)))
    counts = rows.groupBy(*s.group, "_cell").agg(F.count(F.lit(1)).alias("_in_cell"))
    # Windows over the cells of a slice, not over its rows.
    ahead = F.sum("_in_cell").over(s.in_slice().orderBy("_cell")) - F.col("_in_cell")
    dense = counts.withColumn("_in_slice", F.sum("_in_cell").over(s.in_slice())).filter(F.col("_in_slice") > s.max_rows)
    parts = dense.withColumn("_part", F.floor(ahead / s.max_rows))
    starts = parts.withColumn("_from", F.min("_cell").over(Window.partitionBy(*s.group, "_part"))).select(s.key, "_cell", "_from")
    cut = rows.join(starts, [s.key, "_cell"], "left").withColumn(SLICE, F.coalesce("_from", SLICE))
    return cut.select(*df.columns)


def unsliced(df: DataFrame) -> DataFrame:
    return df.drop(SLICE)


def position(s: Series) -> Column:
    """The orderable position of a row within its entity."""
    return F.struct(*[F.col(c) for c in s.order])


def with_carry(df: DataFrame, s: Series, aggs: Mapping[str, Column],
               carries: Mapping[str, Column]) -> DataFrame:
    """Summarise each slice, combine the summaries across the entity, join the result back.

    ``aggs`` are aggregates over the rows of a slice; ``carries`` are window expressions over
    those summaries (see ``Series.slices`` / ``Series.entity``).  ``df`` must be sliced.
    """
    summary = df.groupBy(*s.group).agg(*[c.alias(n) for n, c in aggs.items()])
    carried = summary.select(*s.group, *[c.alias(n) for n, c in carries.items()])
    return df.join(carried, list(s.group), "left")


def join_entity(df: DataFrame, s: Series, attributes: DataFrame, how: str = "inner") -> DataFrame:
    """Join one row per entity (a flight list, per-entity bounds) to the samples.

    A join on the entity would send all samples of a large one to the same task, and later windows
    would inherit that partitioning.  So the attributes are first spread over the entity's slices
    (a small table), and the samples join on (entity, slice), as every other step does.
    """
    base = sliced(df, s)
    per_slice = base.select(*s.group).distinct().join(attributes, s.key)
    return base.join(per_slice, list(s.group), how)


@dataclass(frozen=True)
class Step:
    """One ordered computation: what to summarise per slice, what to carry, what to add to the rows.

    ``prepare`` holds row columns (also windows inside the slice) the summary needs; ``late``
    are carries computed from other carries; ``columns`` may use all of them and windows over
    the rows of a slice.
    """

    aggs: Mapping[str, Column]
    carries: Mapping[str, Column]
    columns: Mapping[str, Column]
    prepare: Mapping[str, Column] = field(default_factory=dict)
    late: Mapping[str, Column] = field(default_factory=dict)


def apply_steps(df: DataFrame, s: Series, *steps: Step) -> DataFrame:
    """Run steps that do not need each other's output on one summary and one join.

    The samples are read twice however many steps there are.
    """
    def merged(part: str) -> dict[str, Column]:
        return {n: c for step in steps for n, c in getattr(step, part).items()}

    prepare, carries, late, columns = (merged(p) for p in ("prepare", "carries", "late", "columns"))
    rows = sliced(df, s).withColumns(prepare)
    summary = rows.groupBy(*s.group).agg(*[c.alias(n) for n, c in merged("aggs").items()])
    carried = summary.withColumns(carries).withColumns(late).select(*s.group, *carries, *late)
    out = rows.join(carried, list(s.group), "left").withColumns(columns)
    return out.drop(*[c for c in (*prepare, *carries, *late) if c not in columns])


def before(s: Series) -> WindowSpec:
    """The slices ahead of the current one."""
    return s.slices().rowsBetween(Window.unboundedPreceding, -1)


def carried_total(name: str, s: Series) -> Column:
    """Sum of a per-slice aggregate over all earlier slices."""
    return F.coalesce(F.sum(name).over(before(s)), F.lit(0))


def position_step(s: Series, name: str, total: str) -> Step:
    """Zero-based row position in the entity and the entity's row count."""
    return Step(
        {"_rows": F.count(F.lit(1))},
        {"_rows_before": carried_total("_rows", s), "_rows_all": F.sum("_rows").over(s.entity())},
        {
            name: F.col("_rows_before") + F.row_number().over(s.rows()).cast("bigint") - 1,
            total: F.col("_rows_all"),
        },
    )


def with_row_blocks(df: DataFrame, s: Series, block: int, halo: int) -> tuple[DataFrame, WindowSpec]:
    """Cut each entity into blocks of ``block`` rows, each with ``halo`` neighbour rows on both sides.

    Sliding frames up to ``halo`` rows wide are then exact for the block's own rows (``_own``)
    while a window never sees more than ``block + 2 * halo`` rows.
    """
    if halo > block:
        raise ValueError("the halo must not be wider than a block")
    numbered = apply_steps(df, s, position_step(s, "_rn", "_n"))
    base = F.floor(F.col("_rn") / F.lit(block)).cast("bigint")
    offset = F.pmod("_rn", F.lit(block))
    copies = F.array_compact(
        F.array(
            F.lit(0),
            F.when((offset < halo) & (F.col("_rn") >= block), F.lit(-1)),
            F.when((offset >= block - halo) & (F.col("_rn") - offset + block < F.col("_n")), F.lit(1)),
        )
    )
    cut = (
        numbered.withColumn("_shift", F.explode(copies))
        .withColumn("_block", base + F.col("_shift"))
        .withColumn("_own", F.col("_shift") == 0)
        .drop("_shift")
    )
    return cut, Window.partitionBy(s.key, "_block").orderBy("_rn")


def own_rows(df: DataFrame) -> DataFrame:
    return df.filter("_own").drop("_own", "_block", "_rn", "_n")


def neighbours_step(s: Series, cols: Sequence[str]) -> Step:
    """Nearest known sample of each column at or before and strictly after each row.

    Adds ``_prev_<c>`` and ``_next_<c>`` structs ``(us, v)``, NULL where there is none.
    """
    us, place = micros(s.time), position(s)
    here = s.rows().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    aggs: dict[str, Column] = {}
    carries: dict[str, Column] = {}
    columns: dict[str, Column] = {}
    prepare: dict[str, Column] = {}
    for c in cols:
        known = F.col(c).isNotNull()
        prepare[f"_pt_{c}"] = F.when(known, F.struct(us.alias("us"), F.col(c).alias("v")))
        placed = F.when(known, F.struct(place.alias("p"), us.alias("us"), F.col(c).alias("v")))
        aggs[f"_first_{c}"] = F.min(placed)
        aggs[f"_last_{c}"] = F.max(placed)
        carries[f"_before_{c}"] = F.last(f"_last_{c}", ignorenulls=True).over(before(s))
        carries[f"_after_{c}"] = F.expr(f"lead(`_first_{c}`, 1) IGNORE NULLS OVER ({s.slice_sql()})")
        earlier, later = (
            F.when(F.col(f"_{side}_{c}").isNotNull(), F.struct(F.col(f"_{side}_{c}.us"), F.col(f"_{side}_{c}.v")))
            for side in ("before", "after")
        )
        columns[f"_prev_{c}"] = F.coalesce(F.last(f"_pt_{c}", ignorenulls=True).over(here), earlier)
        columns[f"_next_{c}"] = F.coalesce(F.expr(f"lead(`_pt_{c}`, 1) IGNORE NULLS OVER ({s.row_sql()})"), later)
    return Step(aggs, carries, columns, prepare)


def between_neighbours(at_us: Column, c: str) -> Column:
    """Linear blend of the neighbours of column ``c`` at instant ``at_us``; no extrapolation."""
    lo, hi = F.col(f"_prev_{c}"), F.col(f"_next_{c}")
    share = (at_us - lo["us"]) / F.nullif(hi["us"] - lo["us"], F.lit(0)).cast("double")
    return F.when(lo["us"] == at_us, lo["v"]).otherwise(lo["v"] + (hi["v"] - lo["v"]) * share)
