"""Joins with flight lists and dimensions, thrust and fuel."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trackmill.functions.geo import great_circle_km
from trackmill.functions.physics import drag_term, fuel_flow, mach, thrust
from trackmill.operators.cleaning import dedup_first
from trackmill.operators.slices import Series, join_entity


def join_dim(df: DataFrame, dim: DataFrame, on: str, key: str, columns: Mapping[str, str]) -> DataFrame:
    """Left join of a dimension, its columns renamed by ``columns``, its key not kept.

    No broadcast hint: dimension files below the session's broadcast threshold are broadcast by
    their known size, larger ones take a shuffle join whose skew is split at run time.
    """
    unique = dedup_first(dim.select(key, *columns), [key], list(columns))
    right = unique.select(F.col(key).alias("_dim_key"), *[F.col(c).alias(n) for c, n in columns.items()])
    return df.join(right, F.col(on) == F.col("_dim_key"), "left").drop("_dim_key")


def row_per_entity(df: DataFrame) -> DataFrame:
    """A table that grows with the entities, as the right side of a join: never broadcast.

    The engine guesses its size from that of its files and the share of columns read.  A few narrow or mostly unknown
    columns of a wide table pass for small with millions of rows, and would be gathered by the driver.
    """
    return df.hint("merge")


def attach_type(samples: DataFrame, flights: DataFrame, s: Series,
                columns: Sequence[str] = ("aircraft_type",)) -> DataFrame:
    """Samples of known flights with columns of the flight list."""
    return join_entity(samples, s, flights.select(s.key, *columns))


def keep_known(samples: DataFrame, flights: DataFrame, s: Series) -> DataFrame:
    """Samples whose flight is in the flight list."""
    return join_entity(samples, s, flights.select(s.key), "left_semi")


def join_new_columns(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Add those columns of ``right`` that ``left`` lacks, matched by key."""
    new = [c for c in right.columns if c not in left.columns]
    return left.join(row_per_entity(right.select(key, *new)), key, "left")


def join_natural(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.join(right, [c for c in left.columns if c in right.columns], "inner")


def airport_points(airports: DataFrame, code: str = "icao",
                   overrides: Mapping[str, tuple[float, float]] | None = None) -> DataFrame:
    """One position per airport: the first source, else the second, else NULL; overrides win."""
    out = airports.select(
        code,
        F.coalesce("lat", "lat_alt").alias("lat"),
        F.coalesce("lon", "lon_alt").alias("lon"),
    )
    for place, (lat, lon) in (overrides or {}).items():
        here = F.col(code) == place
        out = out.withColumns({
            "lat": F.when(here, F.lit(lat)).otherwise(F.col("lat")),
            "lon": F.when(here, F.lit(lon)).otherwise(F.col("lon")),
        })
    return out


def with_airport_distance(flights: DataFrame, points: DataFrame, code: str = "icao",
                          name: str = "great_circle_distance_km") -> DataFrame:
    """Distance between departure and destination, NULL if a position is unknown."""
    out = join_dim(flights, points, "adep", code, {"lat": "adep_lat", "lon": "adep_lon"})
    out = join_dim(out, points, "ades", code, {"lat": "ades_lat", "lon": "ades_lon"})
    ends = [F.col(c) for c in ("adep_lat", "adep_lon", "ades_lat", "ades_lon")]
    return out.withColumn(name, great_circle_km(*ends))


# Types standing in for others, and types without a thrust model.
TYPE_SUBSTITUTES = {"a20n": "a320", "a359": "a333"}
TYPES_WITHOUT_THRUST = (
    "a343", "b752", "b763", "b772", "b773", "b77w", "b788", "b789", "bcs1", "bcs3", "c56x", "crj9",
)


def thrust_type(col: Column, substitutes: Mapping[str, str] = TYPE_SUBSTITUTES,
                excluded: Sequence[str] = TYPES_WITHOUT_THRUST) -> Column:
    """The type whose thrust model applies, NULL if none does."""
    code = F.lower(F.trim(col))
    out = F.when(code.isin(*excluded), F.lit(None).cast("string"))
    for old, new in substitutes.items():
        out = out.when(code == old, F.lit(new))
    return out.otherwise(code)


def with_thrust_fuel(df: DataFrame, regimes: DataFrame, fuel: DataFrame, type_col: str = "aircraft_type",
                     label: str = "label", tas: str = "tas", altitude: str = "altitude",
                     rate: str = "vertical_rate") -> DataFrame:
    """Thrust and fuel flow from coefficient tables: one row per (type, regime), one per type.

    The coefficients are user data; a type or regime without them gives NULL.
    """
    r = regimes.select(
        F.col("ac").alias("_ac"), F.col("regime").alias("_regime"), *[F.col(c).alias(f"_{c}") for c in ("c0", "c1", "c2", "c3")]
    )
    f = fuel.select(F.col("ac").alias("_fuel_ac"), *[F.col(c).alias(f"_{c}") for c in ("f0", "f1", "f2", "f3")])
    out = df.withColumn("_model", thrust_type(F.col(type_col)))
    out = out.join(r, (F.col("_model") == F.col("_ac")) & (F.col(label) == F.col("_regime")), "left")
    out = out.join(f, F.col("_model") == F.col("_fuel_ac"), "left")
    force = thrust(*[F.col(f"_c{i}") for i in range(4)], F.col(tas), F.col(altitude), F.col(rate))
    out = out.withColumn("thrust", force)
    flow = fuel_flow(*[F.col(f"_f{i}") for i in range(4)], F.col("thrust"), F.col(altitude))
    return out.withColumn("fuelflow", flow).drop(
        "_model", "_ac", "_regime", "_fuel_ac", *[f"_{x}{i}" for x in "cf" for i in range(4)]
    )


BANDS = ("0_5000", "5000_10000", "10000_15000", "15000_20000")


def with_drag_terms(df: DataFrame, cd0: str = "cd0", bands: Sequence[str] = BANDS) -> DataFrame:
    return df.withColumns({
        f"drag_term{i}": drag_term(F.col(cd0), F.col(f"avg_tas_mps_{b}")) for i, b in enumerate(bands, 1)
    })


def with_ceiling_diff(df: DataFrame, ceiling: str = "ceiling_ft", cruise: str = "cruise_ft") -> DataFrame:
    return df.withColumns({
        "ceiling_diff": F.col(ceiling) - F.col("max_cruise_altitude"),
        "cruise_diff": F.col(cruise) - F.col("mean_cruise_altitude"),
    })


def with_mach(df: DataFrame, tas: str = "mean_cruise_tas", temperature: str = "mean_cruise_temperature",
              nominal: str = "cruise_mach") -> DataFrame:
    number = mach(F.col(tas), F.col(temperature))
    return df.withColumns({"average_mach": number, "mach_diff": number - F.col(nominal)})


def with_spec_thrust(df: DataFrame, acceleration: bool = False, bands: Sequence[str] = BANDS) -> DataFrame:
    """Drag plus path angle per band, optionally plus specific acceleration."""
    out = {}
    for i, b in enumerate(bands, 1):
        total = F.col(f"drag_term{i}") + F.col(f"avg_path_angle_{b}")
        out[f"spec_thrust{i}"] = total + F.col(f"spec_acc_mps_{b}") if acceleration else total
    return df.withColumns(out)
