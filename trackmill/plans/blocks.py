"""Frames shared by several queries, with the oracle SQL that means the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackmill.functions.physics import true_airspeed
from trackmill.operators.cleaning import dedup_first
from trackmill.operators.enrich import attach_type, with_thrust_fuel
from trackmill.operators.smoothing import thrust_regime
from trackmill.operators.slices import apply_steps
from trackmill.operators.timeseries import (
    air_distance_step,
    between_step,
    cruise_like,
    mass_loss_step,
)
from trackmill.plans.registry import block
from trackmill.session import materialise
from trackmill.sources import views

FX = views.SERIES

block("tracks", """
  SELECT * EXCLUDE (rk) FROM (
    SELECT *, row_number() OVER (PARTITION BY flight_id, event_time ORDER BY seq) AS rk FROM samples)
  WHERE rk = 1""")


def tracks(spark: SparkSession, sf: str) -> DataFrame:
    return dedup_first(views.samples(spark, sf), [FX.key, FX.time], ["seq"])


def stored_tracks(spark: SparkSession, sf: str) -> DataFrame:
    """The deduplicated samples as a written table, for operators that read their input more than once.

    The deduplication keeps whole rows, so reading two columns of it costs as much as reading all.
    """
    return materialise(tracks(spark, sf), "tracks")


BLOCK_AIRED = """
  SELECT *, sqrt(pow(groundspeed * 0.514444e0 * sin(radians(track)) - u_component_of_wind, 2)
               + pow(groundspeed * 0.514444e0 * cos(radians(track)) - v_component_of_wind, 2)) / 0.514444e0 AS tas
  FROM tracks"""
block("aired", BLOCK_AIRED)


def with_tas(df: DataFrame) -> DataFrame:
    return df.withColumn("tas", true_airspeed(
        F.col("groundspeed"), F.col("track"), F.col("u_component_of_wind"), F.col("v_component_of_wind")
    ))


block("stepped", """
  SELECT *, (epoch_us(max(event_time) OVER w) - epoch_us(min(event_time) OVER w)) / 1e6
            / nullif(count(*) OVER w - 1, 0) AS mean_step
  FROM aired WINDOW w AS (PARTITION BY flight_id)""")

block("flown", """
  SELECT * EXCLUDE (mean_step),
         sum(tas) OVER (PARTITION BY flight_id ORDER BY event_time, seq ROWS UNBOUNDED PRECEDING)
           * mean_step * 0.514444e0 / 1e3 AS airdist,
         sum(tas) OVER (PARTITION BY flight_id) * mean_step * 0.514444e0 / 1e3 AS distance
  FROM stepped""")

CRUISE_SQL = """phase IN ('CRUISE', 'LEVEL') AND altitude > 20000 AND altitude < 45000
           AND vertical_rate > -500 AND vertical_rate < 500 AND tas IS NOT NULL AND altitude IS NOT NULL"""

BLOCK_CRUISED = f"""
  SELECT * EXCLUDE (rn, a, b), CASE WHEN rn >= coalesce(a, 1) AND rn <= coalesce(b, rn) AND {CRUISE_SQL}
           THEN 1 ELSE 0 END AS cruise
  FROM (SELECT *, max(CASE WHEN phase = 'CLIMB' THEN rn END) OVER (PARTITION BY flight_id) AS a,
                  min(CASE WHEN phase = 'DESCENT' THEN rn END) OVER (PARTITION BY flight_id) AS b
        FROM (SELECT *, row_number() OVER (PARTITION BY flight_id ORDER BY event_time, seq) AS rn FROM flown))"""
block("cruised", BLOCK_CRUISED)


def cruise_step():
    return between_step(F.col("phase") == "CLIMB", F.col("phase") == "DESCENT", cruise_like(), FX)


REGIME_SQL = """CASE phase WHEN 'CLIMB' THEN 'climb' WHEN 'CRUISE' THEN 'cruise' WHEN 'DESCENT' THEN 'descent_idle'
         WHEN 'LEVEL' THEN 'descent_idle' WHEN 'GROUND' THEN 'descent_idle' WHEN 'NA' THEN 'descent_idle' ELSE phase END"""

MODEL_SQL = """CASE WHEN lower(trim(f.aircraft_type)) IN ('a343', 'b752', 'b763', 'b772', 'b773', 'b77w', 'b788', 'b789',
                'bcs1', 'bcs3', 'c56x', 'crj9') THEN NULL
              WHEN lower(trim(f.aircraft_type)) = 'a20n' THEN 'a320' WHEN lower(trim(f.aircraft_type)) = 'a359' THEN 'a333'
              ELSE lower(trim(f.aircraft_type)) END"""


def thrust_sql(source: str) -> str:
    """Samples of ``source`` with type, label, thrust and fuel flow."""
    return f"""
  SELECT t.* EXCLUDE (model), t.thrust_raw AS thrust, u.f0 + u.f1 * t.thrust_raw + u.f2 * t.thrust_raw * t.thrust_raw + u.f3 * t.altitude AS fuelflow
  FROM (SELECT s.*, r.c0 + r.c1 * s.tas + r.c2 * s.altitude + r.c3 * s.vertical_rate AS thrust_raw
        FROM (SELECT x.*, f.aircraft_type, {REGIME_SQL} AS label, {MODEL_SQL} AS model
              FROM {source} x JOIN flights f ON x.flight_id = f.flight_id) s
        LEFT JOIN regimes r ON r.ac = s.model AND r.regime = s.label) t
  LEFT JOIN fuel u ON u.ac = t.model"""


block("thrusted", "SELECT * EXCLUDE (thrust_raw) FROM (" + thrust_sql("cruised") + ")")


def with_forces(spark: SparkSession, sf: str, df: DataFrame) -> DataFrame:
    typed = attach_type(df, views.flights(spark, sf), FX).withColumn("label", thrust_regime(F.col("phase")))
    return with_thrust_fuel(typed, views.regimes(spark), views.fuel(spark))


def mass_loss_sql(source: str) -> str:
    return f"""
  SELECT * EXCLUDE (burn), sum(coalesce(burn, 0)) OVER (PARTITION BY flight_id ORDER BY event_time, seq ROWS UNBOUNDED PRECEDING) AS mass_loss
  FROM (SELECT *, fuelflow * (epoch_us(event_time) - epoch_us(lag(event_time) OVER (PARTITION BY flight_id ORDER BY event_time, seq))) / 1e6 AS burn
        FROM {source})"""


block("enriched", mass_loss_sql("thrusted"))


def enriched(spark: SparkSession, sf: str, *more, stored: DataFrame | None = None) -> DataFrame:
    """Deduplicated samples with airspeed, air distance, cruise flag, type, thrust, fuel and mass loss.

    Thrust and fuel only need the row, so they come first, and all ordered steps share one pass.  ``stored`` may hand in the stored tracks.
    """
    forced = with_forces(spark, sf, with_tas(stored_tracks(spark, sf) if stored is None else stored))
    return apply_steps(forced, FX, air_distance_step(FX), cruise_step(), mass_loss_step(FX), *more)


block("rated", """
  SELECT *, CASE WHEN prev_t IS NULL THEN 0e0
                 ELSE (vertical_rate - prev_v) / nullif((epoch_us(event_time) - epoch_us(prev_t)) / 1e6, 0) / 60 END AS vertical_acc
  FROM (SELECT *, lag(event_time) OVER w AS prev_t, lag(vertical_rate) OVER w AS prev_v
        FROM enriched WINDOW w AS (PARTITION BY flight_id ORDER BY event_time, seq))""")


def trim_sql(source: str) -> str:
    return f"""
  SELECT * EXCLUDE (s_lo, s_hi, h_lo, h_hi, h_top, steady, high, kept, total, place),
         CASE WHEN kept > 0 THEN steady
              ELSE high AND (floor(total * 2e-1) = floor(total * 8e-1)
                             OR (place >= floor(total * 2e-1) AND place < floor(total * 8e-1))) END AS in_cruise
  FROM (SELECT *, sum(CASE WHEN steady THEN 1 ELSE 0 END) OVER p AS kept,
                  sum(CASE WHEN high THEN 1 ELSE 0 END) OVER p AS total,
                  sum(CASE WHEN high THEN 1 ELSE 0 END) OVER (p ORDER BY event_time, seq ROWS UNBOUNDED PRECEDING) - 1 AS place
        FROM (SELECT x.*, b.* EXCLUDE (flight_id),
                coalesce(cruise = 1 AND tas > s_lo AND tas < s_hi AND altitude > h_lo AND altitude < h_hi, false) AS steady,
                coalesce(altitude >= h_top, false) AS high
              FROM {source} x JOIN (
                SELECT flight_id,
                  quantile_cont(CASE WHEN cruise = 1 THEN tas END, 0.15) AS s_lo,
                  quantile_cont(CASE WHEN cruise = 1 THEN tas END, 0.85) AS s_hi,
                  quantile_cont(CASE WHEN cruise = 1 THEN altitude END, 0.15) AS h_lo,
                  quantile_cont(CASE WHEN cruise = 1 THEN altitude END, 0.85) AS h_hi,
                  quantile_cont(altitude, 0.8) AS h_top
                FROM {source} GROUP BY flight_id) b ON x.flight_id = b.flight_id)
        WINDOW p AS (PARTITION BY flight_id))"""


block("trimmed", trim_sql("rated"))
