"""Queries on samples: cleaning, time-series operators, smoothing, reduction to flight features."""

from __future__ import annotations

from pyspark.sql import functions as F

from trackmill.functions import geo, physics
from trackmill.functions.timing import micros
from trackmill.operators import cleaning, enrich, features, smoothing, timeseries
from trackmill.operators.slices import unsliced
from trackmill.plans import blocks
from trackmill.plans.blocks import FX
from trackmill.plans.registry import block, query, rounded, rounded_sql
from trackmill.session import materialise
from trackmill.sources import views

def us():
    return micros(FX.time).alias("us")


# --- filters and null handling ------------------------------------------------------------------

@query("filter_cruise_pred", f"SELECT flight_id, seq, epoch_us(event_time) AS us FROM aired WHERE {blocks.CRUISE_SQL}")
def filter_cruise_pred(spark, sf):
    df = blocks.with_tas(blocks.tracks(spark, sf))
    return df.filter(timeseries.cruise_like()).select("flight_id", "seq", us())


@query("filter_eq", "SELECT flight_id, seq, phase FROM samples WHERE phase = 'CLIMB'")
def filter_eq(spark, sf):
    return views.samples(spark, sf).filter(F.col("phase") == "CLIMB").select("flight_id", "seq", "phase")


@query("drop_null_key", "SELECT flight_id, seq FROM samples WHERE altitude IS NOT NULL AND temperature IS NOT NULL")
def drop_null_key(spark, sf):
    return views.samples(spark, sf).dropna(subset=["altitude", "temperature"]).select("flight_id", "seq")


@query("drop_short_entities", """
SELECT flight_id, seq FROM tracks WHERE flight_id IN (
  SELECT flight_id FROM tracks GROUP BY flight_id
  HAVING count(*) >= 62 AND quantile_cont(altitude, 0.8) >= 36030)""")
def drop_short_entities(spark, sf):
    kept = cleaning.drop_short_entities(blocks.stored_tracks(spark, sf), FX, min_rows=62, floor=36_030.0)
    return kept.select("flight_id", "seq")


@query("sort_in_entity", """
SELECT flight_id, seq, CAST(row_number() OVER (PARTITION BY flight_id ORDER BY event_time, seq) AS BIGINT) AS place FROM tracks""")
def sort_in_entity(spark, sf):
    df = timeseries.with_position(blocks.stored_tracks(spark, sf), FX, "rn")
    return df.select("flight_id", "seq", (F.col("rn") + 1).alias("place"))


@query("dedup_first", "SELECT flight_id, epoch_us(event_time) AS us, seq, altitude FROM tracks")
def dedup_first(spark, sf):
    return blocks.tracks(spark, sf).select("flight_id", us(), "seq", "altitude")


# --- time series --------------------------------------------------------------------------------

@query("elapsed_seconds", """
SELECT flight_id, seq, (epoch_us(event_time) - epoch_us(min(event_time) OVER (PARTITION BY flight_id))) / 1e6 AS ts
FROM tracks""")
def elapsed_seconds(spark, sf):
    return timeseries.with_elapsed(blocks.stored_tracks(spark, sf), FX).select("flight_id", "seq", "ts")


@query("diff_rate", """
SELECT flight_id, seq, CASE WHEN t IS NULL THEN 0e0
  ELSE (vertical_rate - v) / nullif((epoch_us(event_time) - epoch_us(t)) / 1e6, 0) / 60 END AS vertical_acc
FROM (SELECT *, lag(event_time) OVER w AS t, lag(vertical_rate) OVER w AS v FROM tracks
      WINDOW w AS (PARTITION BY flight_id ORDER BY event_time, seq))""")
def diff_rate(spark, sf):
    df = timeseries.with_rate(blocks.stored_tracks(spark, sf), "vertical_rate", "vertical_acc", FX, scale=60.0)
    return df.select("flight_id", "seq", "vertical_acc")


@query("mean_step", "SELECT flight_id, seq, mean_step FROM stepped")
def mean_step(spark, sf):
    return timeseries.with_mean_step(blocks.stored_tracks(spark, sf), FX).select("flight_id", "seq", "mean_step")


@query("air_distance", rounded_sql("SELECT flight_id, seq, airdist, distance FROM flown", "airdist distance", 3))
def air_distance(spark, sf):
    df = timeseries.with_air_distance(blocks.with_tas(blocks.stored_tracks(spark, sf)), FX)
    return rounded(df.select("flight_id", "seq", "airdist", "distance"), 3)


@query("mass_loss", rounded_sql("SELECT flight_id, seq, mass_loss FROM enriched", "mass_loss", 2))
def mass_loss(spark, sf):
    return rounded(blocks.enriched(spark, sf).select("flight_id", "seq", "mass_loss"), 2)


@query("cruise_slice", "SELECT flight_id, seq, cruise FROM cruised")
def cruise_slice(spark, sf):
    df = blocks.with_tas(blocks.stored_tracks(spark, sf))
    marked = timeseries.mark_between(
        df, F.col("phase") == "CLIMB", F.col("phase") == "DESCENT", timeseries.cruise_like(), FX
    )
    return marked.select("flight_id", "seq", "cruise")


block("cruise_trimmed", blocks.trim_sql("cruised"))


@query("cruise_trim", "SELECT flight_id, seq, in_cruise FROM cruise_trimmed")
def cruise_trim(spark, sf):
    df = blocks.with_tas(blocks.stored_tracks(spark, sf))
    marked = materialise(timeseries.apply_steps(df, FX, blocks.cruise_step()))
    return timeseries.trim_band_with_fallback(marked, FX).select("flight_id", "seq", "in_cruise")


GRID_COLUMNS = ("altitude", "groundspeed", "temperature")


def resample_sql(source: str, num: str, den: str, numeric, carried=("phase",)) -> str:
    """Samples of ``source`` on the grid start + floor(i * num / den), by interval joins per column."""
    def known(c):
        return f"""(SELECT flight_id, epoch_us(event_time) AS us, {c} AS v,
            lead(epoch_us(event_time)) OVER (PARTITION BY flight_id ORDER BY event_time) AS us1,
            lead({c}) OVER (PARTITION BY flight_id ORDER BY event_time) AS v1
          FROM {source} WHERE {c} IS NOT NULL)"""

    joins = "\n".join(
        f"  ASOF LEFT JOIN {known(c)} k{i} ON g.flight_id = k{i}.flight_id AND g.us >= k{i}.us"
        for i, c in enumerate([*numeric, *carried])
    )
    values = ",\n    ".join(
        f"CASE WHEN g.us = k{i}.us THEN k{i}.v ELSE k{i}.v + (k{i}.v1 - k{i}.v) * ((g.us - k{i}.us) / CAST(k{i}.us1 - k{i}.us AS DOUBLE)) END AS {c}"
        for i, c in enumerate(numeric)
    )
    texts = "".join(f",\n    k{i}.v AS {c}" for i, c in enumerate(carried, len(numeric)))
    return f"""
  SELECT g.flight_id, g.grid_index, g.us,
    {values}{texts}
  FROM (SELECT flight_id, i AS grid_index, start_us + (i * num) // den AS us
        FROM (SELECT flight_id, start_us, num, den, unnest(range(0, ((end_us - start_us) * den) // num + 1)) AS i
              FROM (SELECT flight_id, min(epoch_us(event_time)) AS start_us, max(epoch_us(event_time)) AS end_us,
                      CAST({num} AS BIGINT) AS num, CAST({den} AS BIGINT) AS den
                    FROM {source} GROUP BY flight_id))) g
{joins}"""


def circular_sql(source: str, num: str, den: str, numeric, angle: str) -> str:
    """``resample_sql`` of numbers only, with one angle blended on the circle."""
    parts = f"(SELECT *, sin(radians({angle})) AS {angle}_sin, cos(radians({angle})) AS {angle}_cos FROM {source})"
    plain = resample_sql(parts, num, den, [*[c for c in numeric if c != angle], f"{angle}_sin", f"{angle}_cos"], ())
    return f"SELECT * EXCLUDE ({angle}_sin, {angle}_cos), (degrees(atan2({angle}_sin, {angle}_cos)) + 36e1) % 36e1 AS {angle} FROM ({plain})"


SPAN_SQL = "(max(epoch_us(event_time)) - min(epoch_us(event_time)))"
FIXED_STEP_SQL = f"greatest(1, {SPAN_SQL} // 600000000) * 1000000"
block("grid_fixed", resample_sql("tracks", FIXED_STEP_SQL, "1", GRID_COLUMNS))
block("grid_n", resample_sql("tracks", f"greatest(1, {SPAN_SQL})", "499", GRID_COLUMNS))


@query("resample_fixed", rounded_sql("SELECT * FROM grid_fixed", "altitude groundspeed temperature"))
def resample_fixed(spark, sf):
    df = timeseries.resample_fixed(blocks.stored_tracks(spark, sf), FX, GRID_COLUMNS, ["phase"])
    return rounded(df.select("flight_id", "grid_index", us(), *GRID_COLUMNS, "phase"))


@query("resample_n", rounded_sql("SELECT * FROM grid_n", "altitude groundspeed temperature"))
def resample_n(spark, sf):
    df = timeseries.resample_n(blocks.stored_tracks(spark, sf), FX, GRID_COLUMNS, ["phase"], n=500)
    return rounded(df.select("flight_id", "grid_index", us(), *GRID_COLUMNS, "phase"))


# --- smoothing and phases -----------------------------------------------------------------------

def outlier_sql(source: str, windows: dict[str, int]) -> str:
    """``source`` with outliers removed and gaps interpolated, keyed by flight and seq."""
    med = ", ".join(
        f"pow({c} - quantile_cont({c}, 0.5) OVER (PARTITION BY flight_id ORDER BY event_time, seq ROWS BETWEEN {w // 2} PRECEDING AND {w // 2} FOLLOWING), 2) AS d_{c}"
        for c, w in windows.items()
    )
    ms = ", ".join(
        f"CASE WHEN d_{c} <= avg(d_{c}) OVER (PARTITION BY flight_id ORDER BY event_time, seq ROWS BETWEEN {w // 2} PRECEDING AND {w // 2} FOLLOWING) THEN {c} END AS {c}"
        for c, w in windows.items()
    )
    near = ", ".join(
        f"""last_value(CASE WHEN {c} IS NOT NULL THEN {{'us': epoch_us(event_time), 'v': {c}}} END IGNORE NULLS) OVER (PARTITION BY flight_id ORDER BY event_time, seq ROWS UNBOUNDED PRECEDING) AS p_{c},
            first_value(CASE WHEN {c} IS NOT NULL THEN {{'us': epoch_us(event_time), 'v': {c}}} END IGNORE NULLS) OVER (PARTITION BY flight_id ORDER BY event_time, seq ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS n_{c}"""
        for c in windows
    )
    fill = ", ".join(
        f"coalesce({c}, p_{c}.v + (n_{c}.v - p_{c}.v) * ((epoch_us(event_time) - p_{c}.us) / CAST(n_{c}.us - p_{c}.us AS DOUBLE))) AS {c}"
        for c in windows
    )
    extra = ", ".join(f"d_{c}" for c in windows)
    ends = ", ".join(f"p_{c}, n_{c}" for c in windows)
    return f"""
  SELECT * EXCLUDE ({ends}) REPLACE ({fill})
  FROM (SELECT *, {near}
        FROM (SELECT * EXCLUDE ({extra}) REPLACE ({ms}) FROM (SELECT *, {med} FROM {source})))"""


OUTLIER_WINDOWS = {"altitude": 7, "vertical_rate": 11}
block("filtered", outlier_sql("tracks", OUTLIER_WINDOWS))


@query("outlier_filter", rounded_sql("SELECT flight_id, seq, altitude, vertical_rate FROM filtered", "altitude vertical_rate"))
def outlier_filter(spark, sf):
    df = smoothing.outlier_filter(blocks.stored_tracks(spark, sf), FX, OUTLIER_WINDOWS, block=16)
    return rounded(df.select("flight_id", "seq", "altitude", "vertical_rate"))


# The order-two kernel of 11 points from its closed form; edges are compared in the unit tests.
SAVGOL_HALF = 5
_W = 2 * SAVGOL_HALF + 1
_M2 = SAVGOL_HALF * (SAVGOL_HALF + 1) * _W / 3
_M4 = _M2 * (3 * SAVGOL_HALF**2 + 3 * SAVGOL_HALF - 1) / 5
_KERNEL = [(_M4 - j * j * _M2) / (_W * _M4 - _M2 * _M2) for j in range(-SAVGOL_HALF, SAVGOL_HALF + 1)]
_TERMS = " + ".join(
    f"{k!r}::DOUBLE * {'lag' if j < 0 else 'lead'}(vertical_rate, {abs(j)}) OVER w" for j, k in zip(range(-5, 6), _KERNEL)
)


@query("savgol", rounded_sql(f"""
SELECT flight_id, seq, smooth FROM (
  SELECT flight_id, seq, {_TERMS} AS smooth FROM tracks WINDOW w AS (PARTITION BY flight_id ORDER BY event_time, seq))
WHERE smooth IS NOT NULL""", "smooth"))
def savgol(spark, sf):
    tracks = timeseries.with_position(blocks.stored_tracks(spark, sf), FX, "rn", "n")
    smooth = smoothing.savgol(tracks, FX, {"smooth": ("vertical_rate", _W)}, block=24)
    interior = (F.col("rn") >= SAVGOL_HALF) & (F.col("rn") < F.col("n") - SAVGOL_HALF)
    return rounded(smooth.filter(interior).select("flight_id", "seq", "smooth"))


def _step_sql(x: str, a: float, b: float) -> str:
    w = b - a
    return f"""CASE WHEN {x} <= {a} THEN 0e0 WHEN {x} >= {b} THEN 1e0 WHEN {x} <= {(a + b) / 2} THEN 2 * pow(({x} - {a}) / {w}, 2)
      WHEN {x} IS NOT NULL THEN 1 - 2 * pow(({x} - {b}) / {w}, 2) END"""


def _bell_sql(x: str, m: float, s: float) -> str:
    return f"exp(-pow({x} - {m}, 2) / (2 * {s}::DOUBLE * {s}))"


def phase_sql(source: str, h: str = "altitude", v: str = "tas", r: str = "vertical_rate") -> str:
    """``source`` with the fuzzy phase as ``fuzzy``."""
    return f"""
  SELECT * EXCLUDE (m_level, m_up, m_down, m_ground, m_low, m_high, m_slow, m_medium, m_fast, g, c, d, k, l),
    CASE WHEN {h} IS NULL OR {v} IS NULL OR {r} IS NULL THEN 'NA'
         WHEN g >= greatest(c, d, k, l) THEN 'GROUND' WHEN c >= greatest(d, k, l) THEN 'CLIMB'
         WHEN d >= greatest(k, l) THEN 'DESCENT' WHEN k >= l THEN 'CRUISE' ELSE 'LEVEL' END AS fuzzy
  FROM (SELECT *, least(m_ground, m_slow, m_level) AS g, least(m_low, m_medium, m_up) AS c, least(m_low, m_medium, m_down) AS d,
          least(m_high, m_fast, m_level) AS k, least(m_low, m_medium, m_level) AS l
        FROM (SELECT *, {_bell_sql(r, 0, 100)} AS m_level, {_step_sql(r, 10, 1000)} AS m_up, 1 - ({_step_sql(r, -1000, -10)}) AS m_down,
                1 - ({_step_sql(h, 0, 200)}) AS m_ground, {_bell_sql(h, 10000, 10000)} AS m_low, {_bell_sql(h, 35000, 20000)} AS m_high,
                {_bell_sql(v, 0, 50)} AS m_slow, {_bell_sql(v, 300, 100)} AS m_medium, {_bell_sql(v, 600, 100)} AS m_fast
              FROM {source}))"""


block("fuzzy_rows", phase_sql("aired"))


@query("phase_label", "SELECT flight_id, seq, fuzzy FROM fuzzy_rows")
def phase_label(spark, sf):
    df = blocks.with_tas(blocks.tracks(spark, sf))
    return smoothing.phase_label(df, FX, bucket_s=None, name="fuzzy").select("flight_id", "seq", "fuzzy")


block("half_days", """
  SELECT flight_id, seq, avg(altitude) OVER b AS altitude, avg(tas) OVER b AS tas, avg(vertical_rate) OVER b AS vertical_rate
  FROM aired WINDOW b AS (PARTITION BY flight_id, epoch_us(event_time) // 43200000000)""")
block("fuzzy_half_days", phase_sql("half_days"))


@query("phase_label_bucket", "SELECT flight_id, seq, fuzzy FROM fuzzy_half_days")
def phase_label_bucket(spark, sf):
    df = blocks.with_tas(blocks.tracks(spark, sf))
    return smoothing.phase_label(df, FX, bucket_s=43_200, name="fuzzy").select("flight_id", "seq", "fuzzy")


@query("phase_map", f"SELECT flight_id, seq, {blocks.REGIME_SQL} AS label FROM samples")
def phase_map(spark, sf):
    return views.samples(spark, sf).select("flight_id", "seq", smoothing.thrust_regime(F.col("phase")).alias("label"))


# --- scalar functions on samples ----------------------------------------------------------------

def haversine_sql(lat1: str, lon1: str, lat2: str, lon2: str, radius: str = "6371e0") -> str:
    a = (f"(pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2}))"
         f" * pow(sin(radians({lon2} - {lon1}) / 2), 2))")
    return f"(2e0 * {radius} * atan2(sqrt({a}), sqrt(greatest(1e0 - {a}, 0e0))))"


@query("haversine", f"SELECT flight_id, seq, round({haversine_sql('latitude', 'longitude', '50e0', '10e0')}, 4) AS km FROM samples")
def haversine(spark, sf):
    km = geo.haversine(F.col("latitude"), F.col("longitude"), F.lit(50.0), F.lit(10.0))
    return rounded(views.samples(spark, sf).select("flight_id", "seq", km.alias("km")))


@query("true_airspeed", "SELECT flight_id, seq, round(tas, 4) AS tas FROM aired")
def true_airspeed(spark, sf):
    return rounded(blocks.with_tas(blocks.tracks(spark, sf)).select("flight_id", "seq", "tas"))


@query("unit_conv", """
SELECT flight_id, seq, groundspeed * 0.514444e0 AS speed_mps, vertical_rate * 0.00508e0 AS rate_mps, altitude / 3.28084e0 AS altitude_m
FROM samples""")
def unit_conv(spark, sf):
    return views.samples(spark, sf).select(
        "flight_id", "seq",
        (F.col("groundspeed") * physics.KT_TO_MPS).alias("speed_mps"),
        (F.col("vertical_rate") * physics.FTMIN_TO_MPS).alias("rate_mps"),
        (F.col("altitude") / physics.M_TO_FT).alias("altitude_m"),
    )


@query("path_angle", """
SELECT flight_id, seq, round(vertical_rate * 0.00508e0 / nullif(tas * 0.514444e0, 0), 6) + 0e0 AS angle FROM aired""")
def path_angle(spark, sf):
    df = blocks.with_tas(blocks.tracks(spark, sf))
    angle = physics.path_angle(F.col("vertical_rate"), F.col("tas"))
    return rounded(df.select("flight_id", "seq", angle.alias("angle")), 6)


@query("air_density", """
SELECT flight_id, seq, round(101325e0 * pow(1 - 0.0065e0 * (altitude / 3.28084e0) / 288.15e0, 9.80665e0 / (287.05e0 * 0.0065e0))
  / (287.05e0 * temperature), 6) AS density FROM samples""")
def air_density(spark, sf):
    density = physics.air_density(F.col("altitude") / physics.M_TO_FT, F.col("temperature"))
    return rounded(views.samples(spark, sf).select("flight_id", "seq", density.alias("density")), 6)


@query("mach", rounded_sql("""
SELECT a.flight_id, a.seq, a.tas * 0.514444e0 / sqrt(1.4e0 * 287.05e0 * a.temperature) AS mach,
       a.tas * 0.514444e0 / sqrt(1.4e0 * 287.05e0 * a.temperature) - t.cruise_mach AS mach_diff
FROM aired a JOIN flights f ON a.flight_id = f.flight_id LEFT JOIN types t ON t.ac = upper(trim(f.aircraft_type))""",
                           "mach mach_diff", 6))
def mach(spark, sf):
    df = enrich.attach_type(blocks.with_tas(blocks.stored_tracks(spark, sf)), views.flights(spark, sf), FX)
    df = df.withColumn("_ac", F.upper(F.trim("aircraft_type")))
    df = enrich.join_dim(df, views.types(spark), "_ac", "ac", {"cruise_mach": "cruise_mach"})
    df = enrich.with_mach(df, "tas", "temperature")
    return rounded(df.select("flight_id", "seq", F.col("average_mach").alias("mach"), "mach_diff"), 6)


@query("round_half_even", """
SELECT flight_id, seq, round_even(value_half, 0) AS whole, round_even(groundspeed, 1) AS tenth
FROM (SELECT *, seq / 2e0 AS value_half FROM samples)""")
def round_half_even(spark, sf):
    return views.samples(spark, sf).select(
        "flight_id", "seq", F.bround(F.col("seq") / 2.0, 0).alias("whole"), F.bround("groundspeed", 1).alias("tenth")
    )


# --- samples with flights and types -------------------------------------------------------------

@query("join_type_inner", "SELECT s.flight_id, s.seq, f.aircraft_type FROM samples s JOIN flights f ON s.flight_id = f.flight_id")
def join_type_inner(spark, sf):
    joined = enrich.attach_type(views.samples(spark, sf), views.flights(spark, sf), FX)
    return joined.select("flight_id", "seq", "aircraft_type")


@query("semi_known", """
SELECT flight_id, seq FROM samples WHERE flight_id IN (SELECT flight_id FROM flights WHERE dataset = 'challenge')""")
def semi_known(spark, sf):
    known = views.flights(spark, sf).filter(F.col("dataset") == "challenge")
    return enrich.keep_known(views.samples(spark, sf), known, FX).select("flight_id", "seq")


@query("type_substitute", f"""
SELECT x.flight_id, x.seq, {blocks.MODEL_SQL} AS model FROM samples x JOIN flights f ON x.flight_id = f.flight_id""")
def type_substitute(spark, sf):
    joined = enrich.attach_type(views.samples(spark, sf), views.flights(spark, sf), FX)
    return joined.select("flight_id", "seq", enrich.thrust_type(F.col("aircraft_type")).alias("model"))


@query("thrust_fuel", rounded_sql("SELECT flight_id, seq, label, thrust, fuelflow FROM thrusted", "thrust fuelflow"))
def thrust_fuel(spark, sf):
    df = blocks.with_forces(spark, sf, blocks.with_tas(blocks.stored_tracks(spark, sf)))
    return rounded(df.select("flight_id", "seq", "label", "thrust", "fuelflow"))


# --- one row per flight -------------------------------------------------------------------------

def _avg(cond: str, col: str) -> str:
    return f"avg(CASE WHEN {cond} THEN {col} END)"


_SUBSETS = {
    "initclimb": "phase = 'CLIMB' AND altitude < 10000",
    "climb": "phase = 'CLIMB'",
    "cruise": "in_cruise",
    "descent": "phase = 'DESCENT'",
}


def _span(cond: str) -> str:
    t = f"CASE WHEN {cond} THEN epoch_us(event_time) END"
    return f"coalesce((max({t}) - min({t})) // 1000000, 0)"


def duration_sql() -> str:
    gap = """(min(CASE WHEN phase = 'DESCENT' THEN epoch_us(event_time) END)
      - max(CASE WHEN phase = 'CLIMB' THEN epoch_us(event_time) END))"""
    parts = [f"CAST({_span(c)} AS BIGINT) AS dur_{n}" for n, c in _SUBSETS.items()]
    parts.append(f"CAST(coalesce(sign({gap}) * (abs({gap}) // 1000000), {_span('in_cruise')}) AS BIGINT) AS dur_cruise2")
    return ",\n  ".join(parts)


#: Means of values with few decimals can end in a 5 at the fifth; they are compared more finely.
FEATURE_DIGITS = dict.fromkeys([
    "mean_cruise_altitude", "mean_rod", "mean_roc", "mean_initroc", "mean_latitude", "mean_longitude",
], 7)


def feature_digits(df):
    fine = df.withColumns({c: F.round(c, d) + F.lit(0.0) for c, d in FEATURE_DIGITS.items()})
    return fine.withColumns({
        f.name: F.round(f.name, 4) + F.lit(0.0)
        for f in df.schema if f.dataType.typeName() == "double" and f.name not in FEATURE_DIGITS
    })


def feature_sql(source: str) -> str:
    out = {
        "mean_cruise_altitude": _avg("in_cruise", "altitude"),
        "max_cruise_altitude": "max(CASE WHEN in_cruise THEN altitude END)",
        "distance": "max(airdist)",
        "mean_latitude": _avg("in_cruise", "latitude"),
        "mean_longitude": _avg("in_cruise", "longitude"),
        "mean_cruise_temperature": _avg("in_cruise", "temperature"),
        "mean_cruise_humidity": _avg("in_cruise", "specific_humidity"),
        "mean_rod": _avg("phase = 'DESCENT'", "vertical_rate"),
        "min_rod": "min(CASE WHEN phase = 'DESCENT' THEN vertical_rate END)",
        "median_rod": "median(CASE WHEN phase = 'DESCENT' THEN vertical_rate END)",
        "mean_neg_descent_vertacc": _avg("phase = 'DESCENT' AND vertical_acc < 0", "vertical_acc"),
        "min_descent_vertacc": "min(CASE WHEN phase = 'DESCENT' THEN vertical_acc END)",
        "fuel_spent": "max(mass_loss)",
    }
    for n, c in _SUBSETS.items():
        out[f"mean_{n}_tas"] = _avg(c, "tas")
        out[f"max_{n}_tas"] = f"max(CASE WHEN {c} THEN tas END)"
        for col in ("thrust", "fuelflow", "mass_loss"):
            out[f"mean_{n}_{col}"] = _avg(c, col)
    for n, short in (("initclimb", "initroc"), ("climb", "roc")):
        c = _SUBSETS[n]
        out[f"mean_{short}"] = _avg(c, "vertical_rate")
        out[f"median_{short}"] = f"median(CASE WHEN {c} THEN vertical_rate END)"
        out[f"max_{short}"] = f"max(CASE WHEN {c} THEN vertical_rate END)"
        out[f"mean_pos_{n}_vertacc"] = _avg(f"({c}) AND vertical_acc > 0", "vertical_acc")
        out[f"max_{n}_vertacc"] = f"max(CASE WHEN {c} THEN vertical_acc END)"
    body = ",\n  ".join(f"round({e}, {FEATURE_DIGITS.get(n, 4)}) + 0e0 AS {n}" for n, e in out.items())
    return f"SELECT flight_id, {body},\n  {duration_sql()}\nFROM {source} GROUP BY flight_id"


def trimmed(spark, sf):
    """Enriched samples with vertical acceleration and the steady-cruise mark."""
    rated = blocks.enriched(spark, sf, timeseries.rate_step("vertical_rate", "vertical_acc", FX, scale=60.0))
    return timeseries.trim_band_with_fallback(materialise(unsliced(rated), "rated"), FX)


@query("flight_features", feature_sql("trimmed"))
def flight_features(spark, sf):
    return feature_digits(features.flight_features(materialise(trimmed(spark, sf), "trimmed"), FX))


@query("durations", f"SELECT flight_id,\n  {duration_sql()}\nFROM cruise_trimmed GROUP BY flight_id")
def durations(spark, sf):
    df = blocks.with_tas(blocks.stored_tracks(spark, sf))
    marked = materialise(timeseries.apply_steps(df, FX, blocks.cruise_step()))
    return features.durations(timeseries.trim_band_with_fallback(marked, FX), FX)


def band_sql(source: str) -> str:
    parts = []
    for lo, hi in zip(features.BAND_EDGES, features.BAND_EDGES[1:]):
        band = f"(phase = 'CLIMB' AND altitude > {lo} AND altitude <= {hi})"
        state = f"CASE WHEN {band} THEN {{'p': event_time, 's': seq, 'us': epoch_us(event_time), 'v': tas * 0.514444e0, 'h': altitude}} END"
        a, b = f"min({state})", f"max({state})"
        dt = f"nullif(({b}.us - {a}.us) / 1e6, 0)"
        n = f"{lo}_{hi}"
        angle = "(vertical_rate * 0.00508e0 / nullif(tas * 0.514444e0, 0))"
        parts += [
            f"round_even({_avg(band, 'vertical_rate * 0.00508e0')}, 0) + 0e0 AS avg_climb_rate_{n}",
            f"round_even({_avg(band, angle)}, 5) + 0e0 AS avg_path_angle_{n}",
            f"round_even({_avg(band, 'tas * 0.514444e0')}, 0) + 0e0 AS avg_tas_mps_{n}",
            f"{b}.v * ({b}.v - {a}.v) / {dt} + 9.81e0 * ({b}.h - {a}.h) / {dt} AS spec_acc_mps_{n}",
        ]
    return f"SELECT flight_id, {', '.join(parts)} FROM {source} GROUP BY flight_id"


block("banded", band_sql("aired"))


@query("altitude_bands", rounded_sql("SELECT * FROM banded", " ".join(
    f"spec_acc_mps_{b} avg_climb_rate_{b} avg_path_angle_{b} avg_tas_mps_{b}" for b in enrich.BANDS), 6))
def altitude_bands(spark, sf):
    return rounded(features.band_features(blocks.with_tas(blocks.tracks(spark, sf)), FX), 6)


def climb_range_sql(source: str) -> str:
    km = haversine_sql("a.lat", "a.lon", "b.lat", "b.lon")
    state = "{'p': event_time, 's': seq, 'us': epoch_us(event_time), 'lat': latitude, 'lon': longitude}"
    return f"""SELECT flight_id, round_even({km}, 0) + 0e0 AS climb_range, round_even({km} / nullif((b.us - a.us) / 1e6, 0), 3) + 0e0 AS climb_rate
FROM (SELECT flight_id, min({state}) AS a, max({state}) AS b FROM {source} WHERE phase = 'CLIMB' GROUP BY flight_id)"""


block("climb_ranges", climb_range_sql("tracks"))


@query("climb_range_rate", "SELECT * FROM climb_ranges")
def climb_range_rate(spark, sf):
    return rounded(features.climb_range_rate(blocks.tracks(spark, sf), FX))


@query("join_features_left", """
SELECT f.flight_id, f.dataset, c.climb_range, c.climb_rate FROM flights f LEFT JOIN climb_ranges c ON f.flight_id = c.flight_id""")
def join_features_left(spark, sf):
    # Outer join, then rows without a dataset dropped: the optimiser turns it into a left join.
    ranges = features.climb_range_rate(blocks.tracks(spark, sf), FX)
    joined = views.flights(spark, sf).select("flight_id", "dataset").join(ranges, "flight_id", "full_outer")
    return rounded(joined.filter(F.col("dataset").isNotNull()))


@query("join_back_features", rounded_sql("""
SELECT f.flight_id, b.* EXCLUDE (flight_id), c.climb_range, c.climb_rate
FROM flights f LEFT JOIN banded b ON b.flight_id = f.flight_id LEFT JOIN climb_ranges c ON c.flight_id = f.flight_id""",
    " ".join(f"spec_acc_mps_{b}" for b in enrich.BANDS)))
def join_back_features(spark, sf):
    tracks = blocks.with_tas(blocks.stored_tracks(spark, sf))
    out = views.flights(spark, sf).select("flight_id")
    out = out.join(features.band_features(tracks, FX), "flight_id", "left")
    out = out.join(features.climb_range_rate(tracks, FX), "flight_id", "left")
    return out.withColumns({f"spec_acc_mps_{b}": F.round(f"spec_acc_mps_{b}", 4) + 0.0 for b in enrich.BANDS}).withColumns({
        c: F.col(c) + 0.0 for c in out.columns if c != "flight_id" and not c.startswith("spec_acc")
    })
