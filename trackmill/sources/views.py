"""Stand-in tables with the shape of flight data, derived from the test tables.

The test tables hold no flights.  ``events`` plays the samples, ``orders`` the flight list and
the predictions, ``nation`` the airports.  The same SQL text feeds Spark and, through
``ORACLE_VIEWS``, the oracle queries; ``samples`` alone is built differently in Spark: its
percent_rank over a whole user is taken from the sliced row position.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackmill.operators.slices import Series
from trackmill.operators.timeseries import with_position

#: Samples of the stand-in flights are hours apart over a month, so a slice lasts days.
SERIES = Series(slice_s=5 * 86_400)

_RANKED = """
  SELECT event_id, user_id, ts, value,
         percent_rank() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS frac
  FROM events"""

_SAMPLES = """
WITH p AS (
  SELECT *, least(1e0, frac / 3e-1, (1e0 - frac) / 3e-1) AS prof,
         CASE WHEN event_id % 17 = 0 THEN 'LEVEL' WHEN frac < 3e-1 THEN 'CLIMB'
              WHEN frac <= 7e-1 THEN 'CRUISE' ELSE 'DESCENT' END AS phase
  FROM {ranked}),
b AS (
  SELECT user_id AS flight_id, event_id AS seq, ts AS event_time, phase,
         CASE WHEN event_id % 29 = 0 THEN NULL ELSE 36e3 * prof + value END AS altitude,
         CASE phase WHEN 'CLIMB' THEN 2e3 + value WHEN 'DESCENT' THEN -18e2 - value
                    ELSE value - 5e1 END AS vertical_rate,
         25e1 + 2e2 * prof + value / 1e1 AS groundspeed,
         CAST((event_id * 37) % 360 AS DOUBLE) AS track,
         CAST(event_id % 41 - 20 AS DOUBLE) AS u_component_of_wind,
         CAST((event_id * 7) % 31 - 15 AS DOUBLE) AS v_component_of_wind,
         4e1 + user_id % 20 + 5e0 * frac AS latitude,
         user_id % 30 + 8e0 * frac AS longitude,
         CASE WHEN event_id % 23 = 0 THEN NULL ELSE 28815e-2 - 19812e-7 * 36e3 * prof END AS temperature,
         1e-2 * exp(-36e3 * prof / 8e3) AS specific_humidity
  FROM p)
{doubled}"""

# Every fiftieth sample is delivered twice.
_DOUBLED = "SELECT * FROM b UNION ALL SELECT * FROM b WHERE seq % 50 = 0"
_DOUBLED_IN_ONE_PASS = "SELECT b.* FROM b LATERAL VIEW explode(IF(seq % 50 = 0, array(1, 2), array(1))) AS delivery"

_FLIGHTS = """
SELECT o.o_orderkey AS flight_id, CAST(o.o_orderdate AS DATE) AS flight_date,
  CASE WHEN o.o_orderkey % 10 < 7 THEN 'challenge' ELSE 'final' END AS dataset,
  concat('X', lpad(CAST(c.c_nationkey AS STRING), 3, '0')) AS adep,
  concat('X', lpad(CAST((o.o_custkey * 7) % 27 AS STRING), 3, '0')) AS ades,
  CASE WHEN c.c_nationkey = 24 THEN NULL ELSE concat('C', CAST(n.n_regionkey AS STRING)) END AS country_code_adep,
  concat('C', CAST(((o.o_custkey * 7) % 27) % 5 AS STRING)) AS country_code_ades,
  CASE WHEN o.o_custkey % 211 = 0 THEN NULL WHEN o.o_custkey % 200 < 70 THEN 'A320'
       WHEN o.o_custkey % 200 < 110 THEN ' b738 ' WHEN o.o_custkey % 200 < 130 THEN 'B739'
       WHEN o.o_custkey % 200 < 150 THEN 'A321' WHEN o.o_custkey % 200 < 165 THEN 'B77W'
       WHEN o.o_custkey % 200 < 180 THEN 'B789' WHEN o.o_custkey % 200 < 198 THEN 'E190'
       WHEN o.o_custkey % 200 = 198 THEN 'C56X' ELSE 'A310' END AS aircraft_type,
  concat('AL', CAST(o.o_custkey % 12 AS STRING)) AS airline,
  o.o_orderdate + (o.o_orderkey % 1440) * INTERVAL '1' MINUTE AS actual_offblock_time,
  o.o_orderdate + (o.o_orderkey % 1440 + 40 + o.o_custkey % 400) * INTERVAL '1' MINUTE AS arrival_time,
  CAST(40 + o.o_custkey % 400 AS DOUBLE) AS flight_duration,
  2e2 + o.o_totalprice / 1e2 AS flown_distance,
  CASE WHEN o.o_orderkey % 10 < 7 THEN 4e4 + o.o_totalprice / 4e0 + 1e2 * (o.o_custkey % 200) END AS tow
FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey JOIN {nation} n ON c.c_nationkey = n.n_nationkey"""

_AIRPORTS = """
SELECT concat('X', lpad(CAST(n_nationkey AS STRING), 3, '0')) AS icao,
  CASE WHEN n_nationkey % 6 = 5 THEN NULL ELSE -4e1 + 35e-1 * n_nationkey END AS lat,
  CASE WHEN n_nationkey % 6 = 5 THEN NULL ELSE -15e1 + 125e-1 * n_nationkey END AS lon,
  CASE WHEN n_nationkey % 4 = 3 THEN NULL ELSE -4e1 + 35e-1 * n_nationkey END AS lat_alt,
  CASE WHEN n_nationkey % 4 = 3 THEN NULL ELSE -15e1 + 125e-1 * n_nationkey END AS lon_alt
FROM {nation}"""

# Invented round figures.
_TYPES = """
SELECT ac, m_tow, min_tow_ch, max_tow_ch, cd0, ceiling_ft, cruise_ft, cruise_mach, climb_range_ref, cruise_range_ref FROM (VALUES
 ('A320', 8e4, 45e3, 77e3, 18e-3, 39e3, 36e3, 78e-2, 22e1, 12e2), ('B738', 79e3, 44e3, 78e3, 19e-3, 41e3, 36e3, 79e-2, 21e1, 12e2),
 ('B739', 85e3, 52e3, 77e3, 19e-3, 41e3, 36e3, 79e-2, 22e1, 13e2), ('A321', 93e3, 52e3, 88e3, 2e-2, 39e3, 35e3, 78e-2, 23e1, 13e2),
 ('B77W', 351e3, 181e3, 351e3, 15e-3, 43e3, 36e3, 84e-2, 28e1, 7e3), ('B789', 254e3, 128e3, 252e3, 16e-3, 43e3, 38e3, 85e-2, 27e1, 6e3),
 ('E190', 5e4, 3e4, 47e3, 2e-2, 41e3, 36e3, 78e-2, 19e1, 8e2),
 ('A310', 15e4, 66e3, 83e3, NULL, NULL, NULL, NULL, NULL, NULL), ('C56X', NULL, 51e3, 51e3, NULL, NULL, NULL, NULL, NULL, NULL))
 AS t(ac, m_tow, min_tow_ch, max_tow_ch, cd0, ceiling_ft, cruise_ft, cruise_mach, climb_range_ref, cruise_range_ref)"""

# Invented coefficients, proportional to the type's largest weight.
_REGIMES = """
SELECT lower(ac) AS ac, 'climb' AS regime, 3e0 * m_tow AS c0, -1e2 AS c1, -2e0 AS c2, 1e0 AS c3 FROM {types} WHERE m_tow IS NOT NULL
UNION ALL SELECT lower(ac), 'cruise', 2e0 * m_tow, -5e1, -1e0, 5e-1 FROM {types} WHERE m_tow IS NOT NULL
UNION ALL SELECT lower(ac), 'descent_idle', 2e-1 * m_tow, -5e0, -1e-1, 1e-1 FROM {types} WHERE m_tow IS NOT NULL"""

_FUEL = """
SELECT lower(ac) AS ac, 1e-1 AS f0, 1e-5 AS f1, 1e-12 AS f2, -1e-6 AS f3 FROM {types} WHERE m_tow IS NOT NULL"""

_PREDS = """
SELECT o.o_orderkey AS flight_id, CAST(m.model_id AS INT) AS model_id,
  CASE WHEN o.o_orderkey % 5 = 0 THEN 1 ELSE 0 END AS test,
  concat('T', CAST(o.o_custkey % 8 AS STRING)) AS aircraft_type,
  4e4 + o.o_totalprice / 4e0 AS tow,
  CASE WHEN (o.o_orderkey + m.model_id) % 97 = 0 THEN NULL
       ELSE (4e4 + o.o_totalprice / 4e0) * (1e0 + ((o.o_orderkey * (7 + m.model_id) + o.o_custkey % 8 * m.model_id) % 41 - 20) / 2e2) END AS tow_pred
FROM {orders} o {models}
WHERE o.o_orderkey % 10 < 7"""

_PLAIN = {"orders": "orders", "customer": "customer", "nation": "nation"}

#: View name -> SQL for the oracle engine.
ORACLE_VIEWS = {
    "samples": _SAMPLES.replace("{ranked}", f"({_RANKED})").replace("{doubled}", _DOUBLED),
    "flights": _FLIGHTS.format(**_PLAIN),
    "airports": _AIRPORTS.format(**_PLAIN),
    "types": _TYPES,
    "regimes": _REGIMES.format(types="types"),
    "fuel": _FUEL.format(types="types"),
    "preds": _PREDS.format(models="CROSS JOIN (VALUES (0), (1), (2), (3), (4)) AS m(model_id)", **_PLAIN),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _utc(spark: SparkSession) -> None:
    # The tables store wall-clock times without a zone; reading them as UTC keeps instants fixed.
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    _utc(spark)
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "value")
    by_user = Series("user_id", "ts", ("event_id",), SERIES.slice_s)
    ranked = with_position(events, by_user, "_rn", "_n").withColumn(
        "frac", F.when(F.col("_n") > 1, F.col("_rn") / (F.col("_n") - 1)).otherwise(0.0)
    )
    text = _SAMPLES.replace("{doubled}", _DOUBLED_IN_ONE_PASS)
    return spark.sql(text, ranked=ranked.select("event_id", "user_id", "ts", "value", "frac"))


def flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    _utc(spark)
    return spark.sql(_FLIGHTS, **{t: table(spark, sf_dir, t) for t in _PLAIN})


def airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(_AIRPORTS, nation=table(spark, sf_dir, "nation"))


def types(spark: SparkSession) -> DataFrame:
    return spark.sql(_TYPES)


def regimes(spark: SparkSession) -> DataFrame:
    return spark.sql(_REGIMES, types=types(spark))


def fuel(spark: SparkSession) -> DataFrame:
    return spark.sql(_FUEL, types=types(spark))


def preds(spark: SparkSession, sf_dir: str) -> DataFrame:
    lateral = _PREDS.replace("{models}", "LATERAL VIEW explode(array(0, 1, 2, 3, 4)) m AS model_id")
    return spark.sql(lateral, orders=table(spark, sf_dir, "orders"))
