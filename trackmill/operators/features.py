"""Samples to one feature row per flight."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackmill.functions.geo import haversine
from trackmill.functions.physics import FTMIN_TO_MPS, GRAVITY_ROUNDED, KT_TO_MPS, path_angle
from trackmill.functions.timing import MICROS, micros, seconds
from trackmill.operators.percentiles import exact_percentiles
from trackmill.operators.slices import Series, position

INITIAL_CLIMB_BELOW = 10_000.0


def _subsets(in_cruise: str) -> dict[str, Column]:
    climb = F.col("phase") == "CLIMB"
    return {
        "initclimb": climb & (F.col("altitude") < INITIAL_CLIMB_BELOW),
        "climb": climb,
        "cruise": F.col(in_cruise),
        "descent": F.col("phase") == "DESCENT",
    }


def _durations(us: dict[str, Column]) -> dict[str, Column]:
    """Whole seconds spent in each subset (0 if empty), and from the last climb to the first descent row.

    ``us`` holds the instant on the rows of each subset and NULL elsewhere.
    """
    def whole(span: Column) -> Column:
        return F.call_function("div", span, F.lit(MICROS))

    nothing = F.lit(0).cast("bigint")
    out = {f"dur_{n}": F.coalesce(whole(F.max(t) - F.min(t)), nothing) for n, t in us.items()}
    out["dur_cruise2"] = F.coalesce(whole(F.min(us["descent"]) - F.max(us["climb"])), out["dur_cruise"])
    return out


def durations(df: DataFrame, s: Series, in_cruise: str = "in_cruise") -> DataFrame:
    us = {n: F.when(rows, micros(s.time)) for n, rows in _subsets(in_cruise).items()}
    return df.groupBy(s.key).agg(*[c.alias(n) for n, c in _durations(us).items()])


def flight_features(df: DataFrame, s: Series, in_cruise: str = "in_cruise") -> DataFrame:
    """48 features per flight from enriched samples.

    One aggregation of mergeable states (so a flight of any size combines map-side) joined
    with the exact medians on the same key, which needs no further exchange of the result.
    """
    subsets = _subsets(in_cruise)
    picked: dict[str, Column] = {}

    def pick(n: str, col: str, test: Column | None = None) -> str:
        """A column holding ``col`` on the rows of subset ``n`` (and ``test``), projected once for all its uses."""
        alias = f"_{n}_{col}" + ("" if test is None else "_signed")
        rows = F.col(f"_in_{n}") if test is None else F.col(f"_in_{n}") & test
        picked[alias] = F.when(rows, F.col(col))
        return alias

    acc = F.col("vertical_acc")
    out: dict[str, Column] = {
        "mean_cruise_altitude": F.avg(pick("cruise", "altitude")),
        "max_cruise_altitude": F.max(pick("cruise", "altitude")),
        "distance": F.max("airdist"),
        "mean_latitude": F.avg(pick("cruise", "latitude")),
        "mean_longitude": F.avg(pick("cruise", "longitude")),
        "mean_cruise_temperature": F.avg(pick("cruise", "temperature")),
        "mean_cruise_humidity": F.avg(pick("cruise", "specific_humidity")),
        "mean_rod": F.avg(pick("descent", "vertical_rate")),
        "min_rod": F.min(pick("descent", "vertical_rate")),
        "mean_neg_descent_vertacc": F.avg(pick("descent", "vertical_acc", acc < 0)),
        "min_descent_vertacc": F.min(pick("descent", "vertical_acc")),
        "fuel_spent": F.max("mass_loss"),
    }
    for n in subsets:
        out[f"mean_{n}_tas"] = F.avg(pick(n, "tas"))
        out[f"max_{n}_tas"] = F.max(pick(n, "tas"))
        for col in ("thrust", "fuelflow", "mass_loss"):
            out[f"mean_{n}_{col}"] = F.avg(pick(n, col))
    for n, short in (("initclimb", "initroc"), ("climb", "roc")):
        out[f"mean_{short}"] = F.avg(pick(n, "vertical_rate"))
        out[f"max_{short}"] = F.max(pick(n, "vertical_rate"))
        out[f"mean_pos_{n}_vertacc"] = F.avg(pick(n, "vertical_acc", acc > 0))
        out[f"max_{n}_vertacc"] = F.max(pick(n, "vertical_acc"))
    for n in subsets:
        picked[f"_{n}_us"] = F.when(F.col(f"_in_{n}"), micros(s.time))
    out |= _durations({n: F.col(f"_{n}_us") for n in subsets})
    medians = exact_percentiles(df, [s.key], {
        "median_initroc": (F.when(subsets["initclimb"], F.col("vertical_rate")), 0.5),
        "median_roc": (F.when(subsets["climb"], F.col("vertical_rate")), 0.5),
        "median_rod": (F.when(subsets["descent"], F.col("vertical_rate")), 0.5),
    })
    # Subsets, picked values and aggregates in steps of their own keep the generated code small.
    flagged = df.withColumns({f"_in_{n}": rows for n, rows in subsets.items()})
    values = flagged.select(s.key, "airdist", "mass_loss", *[c.alias(n) for n, c in picked.items()])
    return values.groupBy(s.key).agg(*[c.alias(n) for n, c in out.items()]).join(medians, s.key, "left")


#: Altitude band edges (ft).  Fixed values.
BAND_EDGES = (0, 5000, 10000, 15000, 20000)


def _ends(rows: Column, s: Series, value: Column) -> tuple[Column, Column]:
    """``value`` at the first and last of ``rows``."""
    tagged = F.when(rows, F.struct(position(s).alias("p"), value.alias("v")))
    return F.min(tagged)["v"], F.max(tagged)["v"]


def band_features(df: DataFrame, s: Series, edges: Sequence[int] = BAND_EDGES, rows: Column | None = None) -> DataFrame:
    """Mean climb rate, path angle and airspeed, and specific acceleration, per altitude band ``(lo, hi]``.

    ``rows`` restricts the samples considered (the climb by default) without dropping flights.
    """
    climb = (F.col("phase") == "CLIMB") if rows is None else rows
    tas = F.col("tas") * KT_TO_MPS
    rate = F.col("vertical_rate") * FTMIN_TO_MPS
    angle = path_angle(F.col("vertical_rate"), F.col("tas"))
    out: dict[str, Column] = {}
    state = F.struct(micros(s.time).alias("us"), tas.alias("v"), F.col("altitude").alias("h"))
    for lo, hi in zip(edges, edges[1:]):
        band = climb & (F.col("altitude") > lo) & (F.col("altitude") <= hi)
        first, last = _ends(band, s, state)
        seconds_between = seconds(last["us"] - first["us"])
        acc = F.try_divide(last["v"] * (last["v"] - first["v"]), seconds_between) + F.try_divide(
            GRAVITY_ROUNDED * (last["h"] - first["h"]), seconds_between
        )
        name = f"{lo}_{hi}"
        out[f"avg_climb_rate_{name}"] = F.bround(F.avg(F.when(band, rate)), 0)
        out[f"avg_path_angle_{name}"] = F.bround(F.avg(F.when(band, angle)), 5)
        out[f"avg_tas_mps_{name}"] = F.bround(F.avg(F.when(band, tas)), 0)
        out[f"spec_acc_mps_{name}"] = acc
    return df.groupBy(s.key).agg(*[c.alias(n) for n, c in out.items()])


def climb_range_rate(df: DataFrame, s: Series, decimals: int = 3) -> DataFrame:
    """Great-circle distance between the first and last climb row (km) and the speed over it (km/s)."""
    state = F.struct(micros(s.time).alias("us"), F.col("latitude").alias("lat"), F.col("longitude").alias("lon"))
    first, last = _ends(F.col("phase") == "CLIMB", s, state)
    ends = df.groupBy(s.key).agg(first.alias("_a"), last.alias("_b")).filter(F.col("_a").isNotNull())
    distance = haversine(F.col("_a.lat"), F.col("_a.lon"), F.col("_b.lat"), F.col("_b.lon"))
    duration = seconds(F.col("_b.us") - F.col("_a.us"))
    return ends.select(
        s.key,
        F.bround(distance, 0).alias("climb_range"),
        F.bround(F.try_divide(distance, duration), decimals).alias("climb_rate"),
    )
