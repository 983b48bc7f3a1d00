"""Queries on the flight list, dimensions and flight-level features."""

from __future__ import annotations

from pyspark.sql import functions as F

from trackmill.functions import encodings
from trackmill.functions.timing import hour_partition, micros
from trackmill.operators import cleaning, encoding, enrich, features, sampling, stats
from trackmill.plans import blocks
from trackmill.plans.blocks import FX
from trackmill.plans.catalog_samples import haversine_sql
from trackmill.plans.registry import block, query, rounded, rounded_sql
from trackmill.session import materialise
from trackmill.sources import views

# --- projections --------------------------------------------------------------------------------

@query("proj_basic", """
SELECT flight_id AS id, adep AS origin, ades AS destination, flown_distance, 1 AS unit FROM flights""")
def proj_basic(spark, sf):
    df = views.flights(spark, sf).select("flight_id", "adep", "ades", "flown_distance", "flight_date")
    named = df.withColumnsRenamed({"flight_id": "id", "adep": "origin", "ades": "destination"})
    return named.drop("flight_date").withColumn("unit", F.lit(1))


@query("proj_flag", "SELECT flight_id, CASE WHEN dataset = 'challenge' THEN 0 ELSE 1 END AS submission FROM flights")
def proj_flag(spark, sf):
    flag = F.when(F.col("dataset") == "challenge", 0).otherwise(1)
    return views.flights(spark, sf).select("flight_id", flag.alias("submission"))


@query("clean_names", "SELECT flight_id, flown_distance AS flowndistancekm, adep AS adep_code FROM flights")
def clean_names(spark, sf):
    df = views.flights(spark, sf).select(
        "flight_id", F.col("flown_distance").alias("flown distance [km]"), F.col("adep").alias("adep_code?")
    )
    return cleaning.clean_names(df)


@query("cast_float32", """
SELECT flight_id, round(CAST(CAST(flown_distance AS FLOAT) AS DOUBLE), 2) AS flown_distance,
       round(CAST(CAST(tow AS FLOAT) AS DOUBLE), 1) AS tow FROM flights""")
def cast_float32(spark, sf):
    df = cleaning.cast_float32(views.flights(spark, sf).select("flight_id", "flown_distance", "tow"))
    return df.select(
        "flight_id", F.round(F.col("flown_distance").cast("double"), 2).alias("flown_distance"),
        F.round(F.col("tow").cast("double"), 1).alias("tow"),
    )


@query("cast_int_out", "SELECT flight_id, model_id, CAST(trunc(tow_pred) AS BIGINT) AS tow FROM preds")
def cast_int_out(spark, sf):
    return views.preds(spark, sf).select("flight_id", "model_id", F.col("tow_pred").cast("bigint").alias("tow"))


@query("dtype_select", "SELECT flight_id, flight_duration, flown_distance, tow FROM flights")
def dtype_select(spark, sf):
    df = views.flights(spark, sf)
    return df.select(*cleaning.numeric_columns(df))


@query("parse_time", """
SELECT flight_id, epoch_us(date_trunc('second', actual_offblock_time)) AS offblock_us,
       CAST(epoch_us(CAST(flight_date AS TIMESTAMP)) // 86400000000 AS BIGINT) AS day_number FROM flights""")
def parse_time(spark, sf):
    texts = views.flights(spark, sf).select(
        "flight_id",
        F.date_format("actual_offblock_time", "yyyy-MM-dd HH:mm:ss").alias("offblock"),
        F.date_format("flight_date", "yyyy-MM-dd").alias("day"),
    )
    return texts.select(
        "flight_id",
        F.unix_micros(F.to_timestamp("offblock", "yyyy-MM-dd HH:mm:ss")).alias("offblock_us"),
        F.unix_date(F.to_date("day", "yyyy-MM-dd")).cast("bigint").alias("day_number"),
    )


@query("fill_from", """
SELECT f.flight_id, coalesce(a.lat, a.lat_alt) AS adep_lat, coalesce(a.lon, a.lon_alt) AS adep_lon
FROM flights f LEFT JOIN airports a ON a.icao = f.adep""")
def fill_from(spark, sf):
    points = enrich.airport_points(views.airports(spark, sf))
    out = enrich.join_dim(views.flights(spark, sf), points, "adep", "icao", {"lat": "adep_lat", "lon": "adep_lon"})
    return out.select("flight_id", "adep_lat", "adep_lon")


@query("override_point", """
SELECT f.flight_id, CASE WHEN f.ades = 'X011' THEN 29.25e0 ELSE coalesce(a.lat, a.lat_alt) END AS ades_lat,
       CASE WHEN f.ades = 'X011' THEN 47.75e0 ELSE coalesce(a.lon, a.lon_alt) END AS ades_lon
FROM flights f LEFT JOIN airports a ON a.icao = f.ades""")
def override_point(spark, sf):
    points = enrich.airport_points(views.airports(spark, sf), overrides={"X011": (29.25, 47.75)})
    out = enrich.join_dim(views.flights(spark, sf), points, "ades", "icao", {"lat": "ades_lat", "lon": "ades_lon"})
    return out.select("flight_id", "ades_lat", "ades_lon")


PROFILED = ("country_code_adep", "aircraft_type", "airline", "tow")
_PROFILE = "\nUNION ALL ".join(
    f"SELECT dataset, '{c}' AS \"column\", count(*) - count({c}) AS nulls, count(*) AS rows FROM flights GROUP BY dataset"
    for c in PROFILED
)


@query("null_profile", _PROFILE)
def null_profile(spark, sf):
    return cleaning.null_profile(views.flights(spark, sf), PROFILED, by=["dataset"])


# --- features joined to flights -----------------------------------------------------------------

block("profiled", """
  SELECT f.*, c.climb_range, c.climb_rate, c.climb_rate AS mean_climb_thrust, c.climb_rate AS mean_climb_fuelflow,
         f.flown_distance AS mean_cruise_fuelflow
  FROM flights f LEFT JOIN climb_ranges c ON f.flight_id = c.flight_id""")


def profiled(spark, sf):
    """Flights with climb features that only a few of them have, and columns with names that are dropped."""
    ranges = features.climb_range_rate(blocks.tracks(spark, sf), FX)
    return views.flights(spark, sf).join(ranges, "flight_id", "left").withColumns({
        "mean_climb_thrust": F.col("climb_rate"), "mean_climb_fuelflow": F.col("climb_rate"),
        "mean_cruise_fuelflow": F.col("flown_distance"),
    })


# Which columns are too sparse depends on the data; the oracle lists those with at most 2 % NULLs, without
# the ones dropped by name, and tow, which is protected.
@query("drop_sparse_columns", """
SELECT flight_id, epoch_us(CAST(flight_date AS TIMESTAMP)) AS flight_date, dataset, adep, ades, country_code_ades, aircraft_type, airline,
       epoch_us(actual_offblock_time) AS actual_offblock_time, epoch_us(arrival_time) AS arrival_time, flight_duration, flown_distance,
       tow, mean_cruise_fuelflow FROM profiled""")
def drop_sparse_columns(spark, sf):
    df = profiled(spark, sf)
    kept = cleaning.select_columns_by_profile(df, max_nulls=df.count() // 50, protect=("tow",))
    return kept.withColumns({c: micros(c) for c in ("flight_date", "actual_offblock_time", "arrival_time") if c in kept.columns})


@query("select_top_features", "SELECT flight_id, flown_distance, flight_duration, tow FROM flights")
def select_top_features(spark, sf):
    df = views.flights(spark, sf)
    # Importance by the share of distinct values, ranked from the data itself.
    counted = stats.distinct_values(df, ["flown_distance", "flight_duration", "airline", "dataset"])
    pairs = F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"n_{c}").cast("double").alias("importance"))
        for c in ("flown_distance", "flight_duration", "airline", "dataset")
    ]))
    importance = counted.select(pairs.alias("p")).select("p.*")
    return cleaning.select_top_features(df, importance, 2, ["tow", "flight_id"])


@query("join_dim_left", """
SELECT f.flight_id, t.min_tow_ch, t.max_tow_ch, t.m_tow FROM flights f LEFT JOIN types t ON f.aircraft_type = t.ac""")
def join_dim_left(spark, sf):
    out = enrich.join_dim(views.flights(spark, sf), views.types(spark), "aircraft_type", "ac",
                          {"min_tow_ch": "min_tow_ch", "max_tow_ch": "max_tow_ch", "m_tow": "m_tow"})
    return out.select("flight_id", "min_tow_ch", "max_tow_ch", "m_tow")


@query("lookup_map", "SELECT f.flight_id, a.lat, a.lon FROM flights f LEFT JOIN airports a ON a.icao = f.ades")
def lookup_map(spark, sf):
    out = enrich.join_dim(views.flights(spark, sf), views.airports(spark, sf), "ades", "icao", {"lat": "lat", "lon": "lon"})
    return out.select("flight_id", "lat", "lon")


@query("join_new_columns", """
SELECT f.flight_id, f.flown_distance, c.climb_range, c.climb_rate FROM flights f LEFT JOIN climb_ranges c ON c.flight_id = f.flight_id""")
def join_new_columns(spark, sf):
    left = views.flights(spark, sf).select("flight_id", "flown_distance")
    right = features.climb_range_rate(blocks.tracks(spark, sf), FX).withColumn("flown_distance", F.lit(0.0))
    return enrich.join_new_columns(left, right, "flight_id")


@query("join_natural", """
SELECT flight_id, test, aircraft_type, tow, a.tow_pred AS first_pred, b.tow_pred AS second_pred
FROM (SELECT * FROM preds WHERE model_id = 0) a JOIN (SELECT * FROM preds WHERE model_id = 1) b
USING (flight_id, test, aircraft_type, tow)""")
def join_natural(spark, sf):
    preds = views.preds(spark, sf)
    first = preds.filter("model_id = 0").drop("model_id").withColumnRenamed("tow_pred", "first_pred")
    second = preds.filter("model_id = 1").drop("model_id").withColumnRenamed("tow_pred", "second_pred")
    return enrich.join_natural(first, second)


# --- set operations and counts ------------------------------------------------------------------

@query("union_rows", """
SELECT flight_id, 'challenge' AS part FROM flights WHERE dataset = 'challenge'
UNION ALL SELECT flight_id, 'final' FROM flights WHERE dataset = 'final'""")
def union_rows(spark, sf):
    df = views.flights(spark, sf)
    train = df.filter(F.col("dataset") == "challenge").select("flight_id", F.lit("challenge").alias("part"))
    rest = df.filter(F.col("dataset") == "final").select(F.lit("final").alias("part"), "flight_id")
    return train.unionByName(rest)


@query("distinct_values", """
SELECT count(DISTINCT aircraft_type) AS n_aircraft_type, count(DISTINCT adep) AS n_adep, count(DISTINCT airline) AS n_airline FROM flights""")
def distinct_values(spark, sf):
    return stats.distinct_values(views.flights(spark, sf), ["aircraft_type", "adep", "airline"])


@query("value_share", """
SELECT aircraft_type, count(*) AS n, count(*) / CAST((SELECT count(aircraft_type) FROM flights) AS DOUBLE) AS share
FROM flights WHERE aircraft_type IS NOT NULL GROUP BY aircraft_type""")
def value_share(spark, sf):
    return stats.value_share(views.flights(spark, sf), "aircraft_type")


# --- correlation --------------------------------------------------------------------------------

CORR_COLUMNS = ("flight_duration", "flown_distance", "tow", "hour", "customer_band")


def corr_input(spark, sf):
    return views.flights(spark, sf).select(
        "flight_id", "flight_duration", "flown_distance", "tow",
        F.hour("actual_offblock_time").cast("double").alias("hour"),
        F.when(F.col("country_code_adep").isNotNull(), F.substring("country_code_adep", 2, 1).cast("double")).alias("customer_band"),
    )


block("corr_input", """
  SELECT flight_id, flight_duration, flown_distance, tow, CAST(hour(actual_offblock_time) AS DOUBLE) AS hour,
         CAST(substr(country_code_adep, 2, 1) AS DOUBLE) AS customer_band FROM flights""")
block("correlations", "\nUNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS r, count(CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN 1 END) AS n FROM corr_input"
    for a in CORR_COLUMNS for b in CORR_COLUMNS if a != b
))


@query("corr_matrix", "SELECT a, b, round(r, 8) + 0e0 AS r, n FROM correlations")
def corr_matrix(spark, sf):
    return rounded(stats.corr_matrix(corr_input(spark, sf), CORR_COLUMNS), 8)


@query("topk_per_group", """
SELECT a, b, round(r, 8) + 0e0 AS r, n, rank FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY a ORDER BY abs(r) DESC NULLS LAST, b) AS BIGINT) AS rank FROM correlations)
WHERE rank <= 2""")
def topk_per_group(spark, sf):
    return rounded(stats.topk_per_group(stats.corr_matrix(corr_input(spark, sf), CORR_COLUMNS), 2), 8)


# --- statistics per type ------------------------------------------------------------------------

block("typed", """
  SELECT flight_id, aircraft_type, flown_distance, CASE WHEN flight_id % 7 <> 0 THEN flight_duration * 5e-1 END AS climb_range
  FROM flights""")


def typed(spark, sf):
    """Flights with a stand-in climb range, unknown for some."""
    return views.flights(spark, sf).select(
        "flight_id", "aircraft_type", "flown_distance",
        F.when(F.col("flight_id") % 7 != 0, F.col("flight_duration") * 0.5).alias("climb_range"),
    )


@query("type_stats", rounded_sql("""
SELECT aircraft_type, max(flown_distance) AS max_flown_dist, min(flown_distance) AS min_flown_dist,
  max(climb_range) AS max_climb_range, min(climb_range) AS min_climb_range,
  median(flown_distance) AS median_flown_distance, median(climb_range) AS median_climb_range
FROM typed GROUP BY aircraft_type""", "max_flown_dist min_flown_dist max_climb_range min_climb_range median_flown_distance median_climb_range"))
def type_stats(spark, sf):
    return rounded(stats.type_stats(materialise(typed(spark, sf), "typed")))


@query("normalise_by_reference", """
SELECT flight_id,
  CASE WHEN nc > 50 THEN climb_range / nullif(mc, 0) ELSE c END AS climb_range_normalized,
  CASE WHEN nf > 50 THEN flown_distance / nullif(mf, 0) ELSE f END AS flown_distance_normalized
FROM (SELECT x.*, g.nc, g.nf, g.mc, g.mf
      FROM (SELECT t.*, t.climb_range / d.climb_range_ref AS c, (t.flown_distance - t.climb_range) / d.cruise_range_ref AS f
            FROM typed t LEFT JOIN types d ON d.ac = t.aircraft_type) x
      LEFT JOIN (SELECT t.aircraft_type, count(*) - count(t.climb_range / d.climb_range_ref) AS nc,
                   count(*) - count((t.flown_distance - t.climb_range) / d.cruise_range_ref) AS nf,
                   median(t.climb_range) AS mc, median(t.flown_distance) AS mf
                 FROM typed t LEFT JOIN types d ON d.ac = t.aircraft_type GROUP BY t.aircraft_type) g
      ON g.aircraft_type = x.aircraft_type)""")
def normalise_by_reference(spark, sf):
    df = enrich.join_dim(materialise(typed(spark, sf), "typed"), views.types(spark), "aircraft_type", "ac",
                         {"climb_range_ref": "climb_range_ref", "cruise_range_ref": "cruise_range_ref"})
    out = stats.normalise_by_reference(df, max_nulls=50)
    return out.select("flight_id", "climb_range_normalized", "flown_distance_normalized")


@query("impute_group_median", rounded_sql("""
SELECT t.flight_id, coalesce(t.climb_range, g.m) AS climb_range
FROM typed t LEFT JOIN (SELECT aircraft_type, median(climb_range) AS m FROM typed GROUP BY aircraft_type) g
ON g.aircraft_type = t.aircraft_type""", "climb_range"))
def impute_group_median(spark, sf):
    df = materialise(typed(spark, sf), "typed")
    return rounded(stats.fill_group_median(df, "climb_range", "aircraft_type").select("flight_id", "climb_range"))


# --- scalar functions on flights ----------------------------------------------------------------

block("distances", f"""
  SELECT f.*, {haversine_sql('a.lat', 'a.lon', 'b.lat', 'b.lon', '6371.009e0')} AS great_circle_distance_km
  FROM flights f
  LEFT JOIN (SELECT icao, coalesce(lat, lat_alt) AS lat, coalesce(lon, lon_alt) AS lon FROM airports) a ON a.icao = f.adep
  LEFT JOIN (SELECT icao, coalesce(lat, lat_alt) AS lat, coalesce(lon, lon_alt) AS lon FROM airports) b ON b.icao = f.ades""")


@query("great_circle", "SELECT flight_id, round(great_circle_distance_km, 4) AS great_circle_distance_km FROM distances")
def great_circle(spark, sf):
    out = enrich.with_airport_distance(views.flights(spark, sf), enrich.airport_points(views.airports(spark, sf)))
    return rounded(out.select("flight_id", "great_circle_distance_km"))


@query("drag_terms", rounded_sql("""
SELECT b.flight_id, t.cd0 * b.avg_tas_mps_0_5000 * b.avg_tas_mps_0_5000 / 2 AS drag_term1,
  t.cd0 * b.avg_tas_mps_5000_10000 * b.avg_tas_mps_5000_10000 / 2 AS drag_term2,
  t.cd0 * b.avg_tas_mps_10000_15000 * b.avg_tas_mps_10000_15000 / 2 AS drag_term3,
  t.cd0 * b.avg_tas_mps_15000_20000 * b.avg_tas_mps_15000_20000 / 2 AS drag_term4
FROM banded b JOIN flights f ON f.flight_id = b.flight_id LEFT JOIN types t ON t.ac = upper(trim(f.aircraft_type))""",
    "drag_term1 drag_term2 drag_term3 drag_term4"))
def drag_terms(spark, sf):
    out = enrich.with_drag_terms(banded_typed(spark, sf))
    return rounded(out.select("flight_id", *[f"drag_term{i}" for i in range(1, 5)]))


def banded_typed(spark, sf):
    """Band features with the performance columns of the flight's type."""
    bands = features.band_features(blocks.with_tas(blocks.tracks(spark, sf)), FX)
    df = bands.join(views.flights(spark, sf).select("flight_id", "aircraft_type"), "flight_id").withColumn("_ac", F.upper(F.trim("aircraft_type")))
    names = ("cd0", "ceiling_ft", "cruise_ft", "cruise_mach")
    return enrich.join_dim(df, views.types(spark), "_ac", "ac", {n: n for n in names})


@query("ceiling_cruise_diff", rounded_sql("""
SELECT flight_id, any_value(t.ceiling_ft) - max(s.altitude) AS ceiling_diff, any_value(t.cruise_ft) - avg(s.altitude) AS cruise_diff
FROM (SELECT x.*, upper(trim(f.aircraft_type)) AS ac FROM tracks x JOIN flights f USING (flight_id) WHERE x.phase = 'CRUISE') s
LEFT JOIN types t ON t.ac = s.ac GROUP BY flight_id""", "ceiling_diff cruise_diff", 7))
def ceiling_cruise_diff(spark, sf):
    cruise = blocks.tracks(spark, sf).filter(F.col("phase") == "CRUISE").groupBy("flight_id").agg(
        F.max("altitude").alias("max_cruise_altitude"), F.avg("altitude").alias("mean_cruise_altitude")
    )
    df = cruise.join(views.flights(spark, sf).select("flight_id", "aircraft_type"), "flight_id").withColumn("_ac", F.upper(F.trim("aircraft_type")))
    df = enrich.join_dim(df, views.types(spark), "_ac", "ac", {"ceiling_ft": "ceiling_ft", "cruise_ft": "cruise_ft"})
    return rounded(enrich.with_ceiling_diff(df).select("flight_id", "ceiling_diff", "cruise_diff"), 7)


_SPEC = ", ".join(
    f"t.cd0 * b.avg_tas_mps_{n} * b.avg_tas_mps_{n} / 2 + b.avg_path_angle_{n} AS spec_thrust{i},"
    f" t.cd0 * b.avg_tas_mps_{n} * b.avg_tas_mps_{n} / 2 + b.avg_path_angle_{n} + b.spec_acc_mps_{n} AS spec_thrust{i}_acc"
    for i, n in enumerate(enrich.BANDS, 1)
)


@query("spec_thrust", rounded_sql(f"""
SELECT b.flight_id, {_SPEC}
FROM banded b JOIN flights f ON f.flight_id = b.flight_id LEFT JOIN types t ON t.ac = upper(trim(f.aircraft_type))""",
    " ".join(f"spec_thrust{i} spec_thrust{i}_acc" for i in range(1, 5)), 7))
def spec_thrust(spark, sf):
    df = enrich.with_drag_terms(banded_typed(spark, sf))
    with_acc = enrich.with_spec_thrust(df, acceleration=True).withColumnsRenamed(
        {f"spec_thrust{i}": f"spec_thrust{i}_acc" for i in range(1, 5)}
    )
    out = enrich.with_spec_thrust(with_acc)
    return rounded(out.select("flight_id", *[f"spec_thrust{i}{x}" for i in range(1, 5) for x in ("", "_acc")]), 7)


@query("pair_key", "SELECT flight_id, adep || ades AS adepdespair, country_code_adep || country_code_ades AS countrypair FROM flights")
def pair_key(spark, sf):
    return views.flights(spark, sf).select(
        "flight_id", encodings.pair_key("adep", "ades").alias("adepdespair"),
        encodings.pair_key("country_code_adep", "country_code_ades").alias("countrypair"),
    )


FAMILY_SQL = """CASE WHEN aircraft_type IS NULL OR trim(aircraft_type) = '' THEN 'Unknown'
    WHEN regexp_matches(upper(trim(aircraft_type)), '^B73[0-9]') THEN 'B73x'
    WHEN regexp_matches(upper(trim(aircraft_type)), '^B78[0-9]') THEN 'B78x'
    WHEN regexp_matches(upper(trim(aircraft_type)), '^B77[0-9]') THEN 'B77x'
    WHEN regexp_matches(upper(trim(aircraft_type)), '^A31[0-9]') THEN 'A31x'
    ELSE upper(trim(aircraft_type)) END"""


@query("type_family", f"SELECT flight_id, {FAMILY_SQL} AS family FROM flights")
def type_family(spark, sf):
    return views.flights(spark, sf).select("flight_id", encodings.type_family("aircraft_type").alias("family"))


block("combined", f"""
  SELECT x.* EXCLUDE (family), CASE WHEN s.n < 0.01e0 * (SELECT count(*) FROM flights) THEN 'Other' ELSE x.family END AS family
  FROM (SELECT *, {FAMILY_SQL} AS family FROM flights) x
  JOIN (SELECT {FAMILY_SQL} AS family, count(*) AS n FROM flights GROUP BY 1) s ON s.family = x.family""")


@query("rare_to_other", "SELECT flight_id, family FROM combined")
def rare_to_other(spark, sf):
    return encoding.combine_types(views.flights(spark, sf)).select("flight_id", F.col("aircraft_type").alias("family"))


@query("hour_partition", """
SELECT flight_id, CAST(hour(actual_offblock_time) AS DOUBLE) AS hour24, CAST(floor(hour(arrival_time) / 6e0) AS DOUBLE) AS quarter FROM flights""")
def hour_partition_query(spark, sf):
    return views.flights(spark, sf).select(
        "flight_id", hour_partition("actual_offblock_time").alias("hour24"),
        hour_partition("arrival_time", 4).alias("quarter"),
    )


@query("day_of_year", "SELECT flight_id, CAST(dayofyear(flight_date) AS BIGINT) AS day_of_year FROM flights")
def day_of_year(spark, sf):
    return views.flights(spark, sf).select("flight_id", F.dayofyear("flight_date").cast("bigint").alias("day_of_year"))


CODED = ("adepdespair", "airline", "aircraft_type", "countrypair", "adep", "ades", "country_code_adep", "country_code_ades")
block("keyed", """
  SELECT * EXCLUDE (family, aircraft_type), family AS aircraft_type, adep || ades AS adepdespair,
         country_code_adep || country_code_ades AS countrypair FROM combined""")


def factorize_sql(source: str, cols, keep: str) -> str:
    joins = "\n".join(
        f"  LEFT JOIN (SELECT {c} AS v, row_number() OVER (ORDER BY min(flight_id)) - 1 AS code FROM {source} WHERE {c} IS NOT NULL GROUP BY {c}) k{i} ON k{i}.v = x.{c}"
        for i, c in enumerate(cols)
    )
    codes = ", ".join(f"CAST(coalesce(k{i}.code, -1) AS BIGINT) AS {c}" for i, c in enumerate(cols))
    return f"SELECT {keep}, {codes}\nFROM {source} x\n{joins}"


def keyed(spark, sf):
    df = encoding.combine_types(views.flights(spark, sf))
    return df.withColumns({
        "adepdespair": encodings.pair_key("adep", "ades"),
        "countrypair": encodings.pair_key("country_code_adep", "country_code_ades"),
    })


@query("factorize", factorize_sql("keyed", CODED, "x.flight_id"))
def factorize(spark, sf):
    df = keyed(spark, sf).select("flight_id", *CODED)
    # Narrow ranges make several of them even on small tables.
    return encoding.factorize(df, CODED, "flight_id", width=4096)


# --- sampling and weights -----------------------------------------------------------------------

SPLIT_SQL = "CASE WHEN CAST('0x' || substr(md5('42|' || CAST(flight_id AS VARCHAR)), 1, 8) AS BIGINT) % 100 < 20 THEN 1 ELSE 0 END"


@query("split_train_test", f"SELECT flight_id, {SPLIT_SQL} AS test FROM flights")
def split_train_test(spark, sf):
    return sampling.split_train_test(views.flights(spark, sf)).select("flight_id", "test")


@query("undersample", """
SELECT flight_id, aircraft_type FROM (
  SELECT *, row_number() OVER (PARTITION BY aircraft_type ORDER BY md5('42|' || CAST(flight_id AS VARCHAR)), flight_id) AS rk FROM flights)
WHERE aircraft_type = 'B789' OR rk <= CAST(floor((SELECT count(*) FROM flights WHERE aircraft_type = 'B789') * 85e-2) AS BIGINT)""")
def undersample(spark, sf):
    return sampling.undersample(views.flights(spark, sf), "aircraft_type", "B789").select("flight_id", "aircraft_type")


@query("weights_unit", "SELECT flight_id, 1e0 AS weight FROM flights WHERE tow IS NOT NULL")
def weights_unit(spark, sf):
    labelled = views.flights(spark, sf).filter(F.col("tow").isNotNull())
    return sampling.weights_manual(labelled, []).select("flight_id", "weight")


@query("weights_inverse_freq", rounded_sql("""
SELECT x.flight_id, CASE WHEN x.airline = 'AL3' THEN m.top * m.factor * 1.5e0 WHEN x.aircraft_type = 'B789' THEN m.top * 5 ELSE s.w END AS weight
FROM flights x
LEFT JOIN (SELECT aircraft_type, (SELECT count(aircraft_type) FROM flights) / CAST(count(*) AS DOUBLE) AS w
           FROM flights WHERE aircraft_type IS NOT NULL GROUP BY aircraft_type) s ON s.aircraft_type = x.aircraft_type
JOIN (SELECT max(w) AS top, (SELECT CASE WHEN count(*) > 0 THEN 5 ELSE 1 END FROM flights WHERE aircraft_type = 'B789') AS factor FROM (SELECT (SELECT count(aircraft_type) FROM flights) / CAST(count(*) AS DOUBLE) AS w
      FROM flights WHERE aircraft_type IS NOT NULL GROUP BY aircraft_type)) m ON true""", "weight", 6))
def weights_inverse_freq(spark, sf):
    out = sampling.weights_inverse_freq(
        views.flights(spark, sf), "aircraft_type", "B789", boosted=F.col("airline") == "AL3"
    )
    return rounded(out.select("flight_id", "weight"), 6)


block("coded", factorize_sql("keyed", ["aircraft_type", "airline"], "x.flight_id"))


@query("weights_manual", """
SELECT flight_id, CASE WHEN aircraft_type = 16 THEN 9e0 WHEN airline = 3 THEN 9e0 WHEN aircraft_type IN (2, 4, 5) THEN 2e0
  WHEN aircraft_type IN (6, 15) THEN 6e0 WHEN aircraft_type IN (0, 7) THEN 4e0 ELSE 1e0 END AS weight FROM coded""")
def weights_manual(spark, sf):
    df = keyed(spark, sf).select("flight_id", "aircraft_type", "airline")
    coded = encoding.factorize(df, ["aircraft_type", "airline"], "flight_id")
    return sampling.weights_manual(coded, sampling.manual_rules()).select("flight_id", "weight")


