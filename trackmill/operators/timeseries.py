"""Ordered operators on the samples of each entity; see ``slices`` for how they are spread out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trackmill.functions.physics import KT_TO_MPS
from trackmill.functions.timing import MICROS, ceil_div, floor_div, micros, seconds
from trackmill.operators.percentiles import exact_percentiles
from trackmill.operators.slices import (
    SLICE,
    Series,
    Step,
    apply_steps,
    before,
    between_neighbours,
    carried_total,
    join_entity,
    neighbours_step,
    position,
    position_step,
    with_carry,
)
from trackmill.session import materialise

DEFAULT = Series()


def elapsed_step(s: Series = DEFAULT, name: str = "ts") -> Step:
    """Seconds since the entity's first sample."""
    us = micros(s.time)
    return Step({"_t0": F.min(us)}, {"_t0_all": F.min("_t0").over(s.entity())}, {name: seconds(us - F.col("_t0_all"))})


def with_elapsed(df: DataFrame, s: Series = DEFAULT, name: str = "ts") -> DataFrame:
    return apply_steps(df, s, elapsed_step(s, name))


def _lagged(s: Series, tag: str, packed: Column) -> tuple[dict[str, Column], dict[str, Column], Column]:
    """Parts of the predecessor of ``packed`` in the entity, across slice borders."""
    aggs = {f"_last_{tag}": F.max(F.struct(position(s).alias("p"), packed.alias("v")))}
    carries = {f"_lag_{tag}": F.lag(f"_last_{tag}.v").over(s.slices())}
    return aggs, carries, F.coalesce(F.lag(packed).over(s.rows()), F.col(f"_lag_{tag}"))


def rate_step(col: str, name: str, s: Series = DEFAULT, scale: float = 1.0, first: float | None = 0.0) -> Step:
    """Difference quotient of ``col`` over seconds, divided by ``scale``.

    The entity's first row gets ``first``; a repeated instant gives NULL.
    """
    us = micros(s.time)
    aggs, carries, lag = _lagged(s, name, F.struct(us.alias("us"), F.col(col).alias("x")))
    rate = F.try_divide(F.col(col) - lag["x"], seconds(us - lag["us"])) / scale
    return Step(aggs, carries, {name: F.when(lag.isNull(), F.lit(first)).otherwise(rate)})


def with_rate(df: DataFrame, col: str, name: str, s: Series = DEFAULT, scale: float = 1.0,
              first: float | None = 0.0) -> DataFrame:
    return apply_steps(df, s, rate_step(col, name, s, scale, first))


def _extent(s: Series) -> tuple[dict[str, Column], dict[str, Column]]:
    aggs = {"_lo": F.min(micros(s.time)), "_hi": F.max(micros(s.time)), "_cnt": F.count(micros(s.time))}
    carries = {
        "_start": F.min("_lo").over(s.entity()),
        "_end": F.max("_hi").over(s.entity()),
        "_known": F.sum("_cnt").over(s.entity()),
    }
    return aggs, carries


def _mean_step() -> Column:
    return F.try_divide(seconds(F.col("_end") - F.col("_start")), (F.col("_known") - 1).cast("double"))


def mean_step(s: Series = DEFAULT, name: str = "mean_step") -> Step:
    """The entity's mean sample spacing in seconds."""
    return Step(*_extent(s), {name: _mean_step()})


def with_mean_step(df: DataFrame, s: Series = DEFAULT, name: str = "mean_step") -> DataFrame:
    return apply_steps(df, s, mean_step(s, name))


def _before_sum(name: str, s: Series) -> Column:
    return F.coalesce(F.sum(name).over(before(s)), F.lit(0.0))


def _running_sum(col: str, s: Series) -> Column:
    return F.sum(col).over(s.rows().rowsBetween(Window.unboundedPreceding, Window.currentRow))


def air_distance_step(s: Series = DEFAULT, tas: str = "tas", name: str = "airdist", total: str = "distance") -> Step:
    """Distance flown through the air (km), running and in total, at the mean sample spacing.

    A NULL airspeed adds nothing, and its own row has no running value.
    """
    aggs, carries = _extent(s)
    aggs["_speed"] = F.sum(tas)
    carries["_speed0"] = _before_sum("_speed", s)
    carries["_speed_all"] = F.sum("_speed").over(s.entity())
    to_km = _mean_step() * (KT_TO_MPS / 1000.0)
    return Step(aggs, carries, {
        name: F.when(F.col(tas).isNotNull(), (F.col("_speed0") + _running_sum(tas, s)) * to_km),
        total: F.col("_speed_all") * to_km,
    })


def with_air_distance(df: DataFrame, s: Series = DEFAULT, tas: str = "tas",
                      name: str = "airdist", total: str = "distance") -> DataFrame:
    return apply_steps(df, s, air_distance_step(s, tas, name, total))


def mass_loss_step(s: Series = DEFAULT, flow: str = "fuelflow", name: str = "mass_loss") -> Step:
    """Fuel burnt since the first sample: flow times elapsed time, summed; unknown flow burns nothing.

    A slice sums its inner intervals; the one across its border belongs to its first row.
    """
    us = micros(s.time)
    inner = seconds(us - F.lag(us).over(s.rows()))
    head = F.min(F.struct(position(s).alias("p"), us.alias("us"), F.col(flow).alias("flow")))
    border = F.col("_head.flow") * seconds(F.col("_head.us") - F.lag("_tail").over(s.slices()))
    return Step(
        aggs={"_inner": F.sum("_burn"), "_head": head, "_tail": F.max(us)},
        carries={"_border": F.coalesce(border, F.lit(0.0)), "_inner_sum": F.col("_inner")},
        late={"_burnt0": F.coalesce(F.sum(F.col("_border") + F.col("_inner_sum")).over(before(s)), F.lit(0.0))},
        columns={name: F.col("_burnt0") + F.col("_border") + _running_sum("_burn", s)},
        prepare={"_burn": F.coalesce(F.col(flow) * inner, F.lit(0.0))},
    )


def with_mass_loss(df: DataFrame, s: Series = DEFAULT, flow: str = "fuelflow", name: str = "mass_loss") -> DataFrame:
    return apply_steps(df, s, mass_loss_step(s, flow, name))


# What counts as level flight at cruise.
CRUISE_PHASES = ("CRUISE", "LEVEL")
CRUISE_ALTITUDE = (20_000.0, 45_000.0)
CRUISE_VERTICAL_RATE = 500.0


def cruise_like(phase: str = "phase", altitude: str = "altitude", rate: str = "vertical_rate",
                tas: str = "tas") -> Column:
    """Level flight at cruise altitude with known speed; never NULL."""
    low, high = CRUISE_ALTITUDE
    inside = (
        F.col(phase).isin(*CRUISE_PHASES)
        & (F.col(altitude) > low) & (F.col(altitude) < high)
        & (F.abs(F.col(rate)) < CRUISE_VERTICAL_RATE)
        & F.col(tas).isNotNull()
    )
    return F.coalesce(inside, F.lit(False))


def between_step(after_last: Column, until_first: Column, keep: Column, s: Series = DEFAULT,
                 name: str = "cruise") -> Step:
    """1 on rows satisfying ``keep`` from the last ``after_last`` row to the first ``until_first`` row.

    Without a row of either kind the stretch reaches to the entity's first or last row.
    """
    here = position(s)
    inside = (
        keep
        & F.coalesce(here >= F.col("_from"), F.lit(True))
        & F.coalesce(here <= F.col("_to"), F.lit(True))
    )
    return Step(
        {"_a": F.max(F.when(after_last, here)), "_b": F.min(F.when(until_first, here))},
        {"_from": F.max("_a").over(s.entity()), "_to": F.min("_b").over(s.entity())},
        {name: F.when(inside, 1).otherwise(0)},
    )


def mark_between(df: DataFrame, after_last: Column, until_first: Column, keep: Column,
                 s: Series = DEFAULT, name: str = "cruise") -> DataFrame:
    return apply_steps(df, s, between_step(after_last, until_first, keep, s, name))


def trim_band_with_fallback(df: DataFrame, s: Series = DEFAULT, flag: str = "cruise", speed: str = "tas",
                            height: str = "altitude", name: str = "in_cruise",
                            band: tuple[float, float] = (0.15, 0.85), top: float = 0.8,
                            middle: tuple[float, float] = (0.2, 0.8)) -> DataFrame:
    """Mark the steady part of the cruise.

    Flagged rows whose speed and height both lie strictly inside the entity's ``band`` percentiles
    of the flagged rows.  An entity left with none falls back to its rows at or above the ``top``
    percentile of height, of which the ``middle`` part by position (all, if that part is empty).
    """
    flagged = F.col(flag) == 1
    lo, hi = band
    bounds = exact_percentiles(df, [s.key], {
        "_speed_lo": (F.when(flagged, F.col(speed)), lo),
        "_speed_hi": (F.when(flagged, F.col(speed)), hi),
        "_height_lo": (F.when(flagged, F.col(height)), lo),
        "_height_hi": (F.when(flagged, F.col(height)), hi),
        "_height_top": (F.col(height), top),
    })
    steady = F.coalesce(
        flagged
        & (F.col(speed) > F.col("_speed_lo")) & (F.col(speed) < F.col("_speed_hi"))
        & (F.col(height) > F.col("_height_lo")) & (F.col(height) < F.col("_height_hi")),
        F.lit(False),
    )
    high = F.coalesce(F.col(height) >= F.col("_height_top"), F.lit(False))
    marked = join_entity(df, s, bounds, "left").withColumns({"_steady": steady, "_high": high})
    marked = with_carry(
        marked, s,
        {"_steady_n": F.count_if("_steady"), "_high_n": F.count_if("_high")},
        {
            "_kept": F.sum("_steady_n").over(s.entity()),
            "_total": F.sum("_high_n").over(s.entity()),
            "_high0": carried_total("_high_n", s),
        },
    )
    place = F.col("_high0") + F.sum(F.col("_high").cast("bigint")).over(
        s.rows().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ) - 1
    start = F.floor(F.col("_total") * middle[0])
    end = F.floor(F.col("_total") * middle[1])
    fallback = F.col("_high") & ((start == end) | ((place >= start) & (place < end)))
    return marked.withColumn(name, F.when(F.col("_kept") > 0, F.col("_steady")).otherwise(fallback)).drop(
        "_speed_lo", "_speed_hi", "_height_lo", "_height_hi", "_height_top",
        "_steady", "_high", "_kept", "_total", "_high0",
    )


#: Grid points expanded from one row at a time, so that a long gap never becomes one huge array.
_GRID_CHUNK = 4096


def _lines(df: DataFrame, s: Series, numeric: Sequence[str], carried: Sequence[str], num: Column, den: Column,
           circular: Sequence[str] = ()) -> DataFrame:
    """Each sample row with the points ``_i0`` to ``_i1 - 1`` of the grid ``start + i * num / den`` (us) that lie before the next row.

    The line through the nearest known samples of each column is settled per row, so a grid point costs one multiplication.  Angles
    have lines of their sine and cosine.  Rows without a point are left out.
    """
    out = df.select(s.key, *s.order, *numeric, *carried)
    turns = [c for c in circular if c in numeric]
    for c in turns:  # angles are blended on the circle
        out = out.withColumns({f"{c}_sin": F.sin(F.radians(c)), f"{c}_cos": F.cos(F.radians(c))})
    blended = [c for c in numeric if c not in turns] + [f"{c}_{f}" for c in turns for f in ("sin", "cos")]

    out = out.withColumn("_us", micros(s.time))
    aggs, carries = _extent(s)
    carries["_us_after"] = F.lead("_lo").over(s.slices())
    following = F.coalesce(F.lead("_us").over(s.rows()), F.col("_us_after"))
    grid = {"_start": F.col("_start"), "_end": F.col("_end"), "_following": following, "_num": num, "_den": den}
    out = apply_steps(out, s, neighbours_step(s, [*blended, *carried]), Step(aggs, carries, grid))
    lines = {}
    for c in blended:
        lo, hi = F.col(f"_prev_{c}"), F.col(f"_next_{c}")
        lines |= {
            f"_at_{c}": lo["us"], f"_value_{c}": lo["v"],
            f"_slope_{c}": (hi["v"] - lo["v"]) / (hi["us"] - lo["us"]).cast("double"),
        }
    following, start, scale = F.col("_following"), F.col("_start"), F.col("_den")
    first = ceil_div((F.col("_us") - start) * scale, F.col("_num"))
    last = F.when(
        following.isNull(), floor_div((F.col("_end") - start) * scale, F.col("_num")) + 1
    ).otherwise(ceil_div((following - start) * scale, F.col("_num")))
    known = [F.col(f"_prev_{c}.v").alias(c) for c in carried]
    return out.select(
        *s.group, *[c for c in s.order if c not in carried], "_start", "_end", "_num", "_den", first.alias("_i0"), last.alias("_i1"),
        *[c.alias(n) for n, c in lines.items()], *known,
    ).filter("_i1 > _i0")


def _on_line(c: str, at: Column) -> Column:
    past = at - F.col(f"_at_{c}")
    return F.when(past == 0, F.col(f"_value_{c}")).otherwise(F.col(f"_value_{c}") + F.col(f"_slope_{c}") * past)


def _angle(sine: Column, cosine: Column) -> Column:
    return F.pmod(F.degrees(F.atan2(sine, cosine)), F.lit(360.0))


def _values_at(at: Column, numeric: Sequence[str], circular: Sequence[str]) -> dict[str, Column]:
    """The columns of a line at an instant."""
    return {
        c: _angle(_on_line(f"{c}_sin", at), _on_line(f"{c}_cos", at)) if c in circular else _on_line(c, at) for c in numeric
    }


def _dealt(lines: DataFrame, s: Series) -> DataFrame:
    """Lines cut at the borders of slices and dealt by the slice that their points lie in, so that the points, which are many
    more, come out on their slices and need no exchange of their own."""
    width = F.lit(s.slice_s * MICROS)

    def slice_of(i: Column) -> Column:
        at = F.col("_start") + floor_div(i * F.col("_num"), F.col("_den"))
        return at - F.pmod(at, width)

    def first_from(us: Column) -> Column:
        return ceil_div((us - F.col("_start")) * F.col("_den"), F.col("_num"))

    cut = lines.drop(SLICE).withColumn(SLICE, F.explode(F.sequence(slice_of(F.col("_i0")), slice_of(F.col("_i1") - 1), width)))
    cut = cut.withColumns({
        "_i0": F.greatest(F.col("_i0"), first_from(F.col(SLICE))), "_i1": F.least(F.col("_i1"), first_from(F.col(SLICE) + width)),
    }).filter("_i1 > _i0")
    return cut.repartition(int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions")), *s.group)


def _points(lines: DataFrame) -> DataFrame:
    """A row per point of each line, with its place ``_i`` and instant ``_point``."""
    return (
        lines.withColumn("_c", F.explode(F.expr(f"sequence(_i0, _i1 - 1, {_GRID_CHUNK}L)")))
        .withColumn("_i", F.explode(F.expr(f"sequence(_c, least(_c + {_GRID_CHUNK - 1}L, _i1 - 1))")))
        .withColumn("_point", F.col("_start") + floor_div(F.col("_i") * F.col("_num"), F.col("_den")))
    )


def _resampled(df: DataFrame, s: Series, numeric: Sequence[str], carried: Sequence[str], num: Column, den: Column,
               circular: Sequence[str] = (), dealt: bool = False) -> DataFrame:
    """Samples on the grid ``start + i * num / den`` (us) between the entity's first and last instant.

    Each sample row expands to the grid points up to the next sample, so the grid needs no
    join with the samples.  Numbers are blended between the nearest known samples of each column,
    other columns keep the last known value; nothing is extrapolated.
    """
    lines = _lines(df, s, numeric, carried, num, den, circular)
    on_slices = dealt and s.max_rows is None
    if dealt:
        lines = materialise(lines, "lines")
    values = _values_at(F.col("_point"), numeric, circular)
    return _points(_dealt(lines, s) if on_slices else lines).select(
        *(s.group if on_slices else (s.key,)),
        F.col("_i").alias("grid_index"),
        F.timestamp_micros(F.col("_point")).alias(s.time),
        *[values[c].alias(c) for c in numeric],
        *carried,
    )


def _fixed_step(step_s: int | None, points: int) -> Column:
    if step_s is None:
        step = F.greatest(F.lit(1), floor_div(F.col("_end") - F.col("_start"), F.lit(points * MICROS))).cast("bigint")
    else:
        step = F.lit(step_s).cast("bigint")
    return step * MICROS


def resample_fixed(df: DataFrame, s: Series = DEFAULT, numeric: Sequence[str] = (), carried: Sequence[str] = (),
                   step_s: int | None = None, points: int = 600, circular: Sequence[str] = (), dealt: bool = False) -> DataFrame:
    """Resample every entity to a fixed step of whole seconds.

    Without ``step_s`` the step follows the duration: ``max(1, int(duration / points))``.
    Instants of an entity must be distinct (see ``dedup_first``).  With ``dealt`` what lies between two samples is written, in place
    of a grid that may be many times larger, and expanded on the slices of the grid, whose start is a column of the result: ordered steps
    need no exchange of the grid, and columns that nobody reads are not computed.
    """
    return _resampled(df, s, numeric, carried, _fixed_step(step_s, points), F.lit(1).cast("bigint"), circular, dealt)


def resample_n(df: DataFrame, s: Series = DEFAULT, numeric: Sequence[str] = (), carried: Sequence[str] = (),
               n: int = 500, circular: Sequence[str] = ()) -> DataFrame:
    """Resample every entity to ``n`` evenly spaced instants, both ends included."""
    span = F.greatest(F.col("_end") - F.col("_start"), F.lit(1))
    return _resampled(df, s, numeric, carried, span.cast("bigint"), F.lit(n - 1).cast("bigint"), circular)


def resample_fixed_n(df: DataFrame, s: Series = DEFAULT, numeric: Sequence[str] = (), points: int = 600, n: int = 500,
                     circular: Sequence[str] = ()) -> DataFrame:
    """``resample_n`` of ``resample_fixed``, point by point: both grids are evaluated for each even instant, and only these become rows.

    An even instant lies between two points of the fixed grid: both on the same line between two samples, or the latter on the next
    line that has points, whose first values each line is handed.  The fixed grid knows a column between its first and last known
    point without gaps, so no others matter.  Rows come out on their slices, as from ``resample_fixed`` with ``dealt``.
    """
    lines = materialise(_lines(df, s, numeric, (), _fixed_step(None, points), F.lit(1).cast("bigint"), circular), "lines")
    step, start = F.col("_num"), F.col("_start")
    first = F.struct(*[v.alias(c) for c, v in _values_at(start + F.col("_i0") * step, numeric, circular).items()])
    lines = apply_steps(lines, s, Step(
        {"_head": F.min(F.struct(position(s).alias("p"), F.col("_first").alias("f")))},
        {"_head_after": F.lead("_head.f").over(s.slices())},
        {"_then": F.coalesce(F.lead("_first").over(s.rows()), F.col("_head_after"))},
        {"_first": first},
    ))
    # The even grid runs from the first to the last point of the fixed one.
    last = floor_div(F.col("_end") - start, step)
    lines = lines.withColumns({
        "_step": step, "_stop": F.col("_i1"), "_num": F.greatest(last * step, F.lit(1)).cast("bigint"), "_den": F.lit(n - 1).cast("bigint"),
    }).withColumns({
        "_i0": ceil_div(F.col("_i0") * F.col("_step") * F.col("_den"), F.col("_num")),
        "_i1": F.when(
            F.col("_i1") > floor_div(F.col("_end") - start, F.col("_step")),
            floor_div(floor_div(F.col("_end") - start, F.col("_step")) * F.col("_step") * F.col("_den"), F.col("_num")) + 1,
        ).otherwise(ceil_div(F.col("_i1") * F.col("_step") * F.col("_den"), F.col("_num"))),
    }).filter("_i1 > _i0")
    on_slices = s.max_rows is None
    out = _points(_dealt(lines, s) if on_slices else lines)
    out = out.withColumn("_cell", floor_div(F.col("_point") - start, F.col("_step")))
    out = out.withColumn("_low", start + F.col("_cell") * F.col("_step"))
    here = F.col("_cell") + 1 < F.col("_stop")
    low = _values_at(F.col("_low"), numeric, circular)
    high = _values_at(F.col("_low") + F.col("_step"), numeric, circular)
    out = out.select(
        *(s.group if on_slices else (s.key,)), "_i", "_point", "_step", (F.col("_point") - F.col("_low")).alias("_past"),
        *[low[c].alias(f"_low_{c}") for c in numeric],
        *[F.when(here, high[c]).otherwise(F.col(f"_then.{c}")).alias(f"_high_{c}") for c in numeric],
    )

    def between(lo: Column, hi: Column) -> Column:
        return F.when(F.col("_past") == 0, lo).otherwise(lo + (hi - lo) / F.col("_step").cast("double") * F.col("_past"))

    def blend(c: str) -> Column:
        lo, hi = F.col(f"_low_{c}"), F.col(f"_high_{c}")
        if c not in circular:
            return between(lo, hi)
        return _angle(between(F.sin(F.radians(lo)), F.sin(F.radians(hi))), between(F.cos(F.radians(lo)), F.cos(F.radians(hi))))

    return out.select(
        *(s.group if on_slices else (s.key,)), F.col("_i").alias("grid_index"), F.timestamp_micros(F.col("_point")).alias(s.time),
        *[blend(c).alias(c) for c in numeric],
    )


def interpolate_nulls(df: DataFrame, s: Series, cols: Sequence[str]) -> DataFrame:
    """Fill NULLs from the nearest known samples of the same column; NULLs at the ends stay."""
    out = apply_steps(df, s, neighbours_step(s, cols))
    at = micros(s.time)
    out = out.withColumns({c: F.coalesce(F.col(c), between_neighbours(at, c)) for c in cols})
    return out.drop(*[f"_{side}_{c}" for c in cols for side in ("prev", "next")])


def with_position(df: DataFrame, s: Series = DEFAULT, name: str = "rn", total: str = "n") -> DataFrame:
    return apply_steps(df, s, position_step(s, name, total))
