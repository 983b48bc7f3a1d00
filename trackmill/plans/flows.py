"""Composite flows: raw samples to enriched samples, to features, to a model table, to a submission."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackmill.functions.encodings import pair_key
from trackmill.functions.physics import true_airspeed
from trackmill.functions.timing import hour_partition
from trackmill.operators import cleaning, encoding, enrich, ml, selection, stats
from trackmill.operators.features import band_features, climb_range_rate, flight_features
from trackmill.operators.slices import Series, apply_steps, position_step, unsliced
from trackmill.operators.smoothing import outlier_filter, phase_label, smooth_climb, thrust_regime
from trackmill.operators.timeseries import (
    air_distance_step,
    between_step,
    cruise_like,
    elapsed_step,
    mass_loss_step,
    resample_fixed,
    resample_fixed_n,
    trim_band_with_fallback,
    with_rate,
)
from trackmill.session import materialise, settled
from trackmill.sources import tables

BANDS = enrich.BANDS

#: Numeric sample columns, all of them interpolated when resampling.
SAMPLE_NUMBERS = (
    "altitude", "vertical_rate", "groundspeed", "track", "u_component_of_wind", "v_component_of_wind",
    "latitude", "longitude", "temperature", "specific_humidity",
)

#: Angles among them, which are blended on the circle.
ANGLES = ("track",)

#: Rows in the filter's default windows, per column.
FILTER_WINDOWS = {"altitude": 17, "vertical_rate": 5, "groundspeed": 9, "track": 17}


def _airspeed(df: DataFrame) -> DataFrame:
    return df.withColumn("tas", true_airspeed(
        F.col("groundspeed"), F.col("track"), F.col("u_component_of_wind"), F.col("v_component_of_wind")
    ))


def _known_tracks(samples: DataFrame, flights: DataFrame, s: Series) -> DataFrame:
    """Samples of listed flights, one per instant, written once: every later step reads them several times."""
    timed = samples.filter(F.col(s.time).isNotNull())
    unique = materialise(cleaning.dedup_first(timed, [s.key, s.time], s.tie), "tracks")
    return unsliced(enrich.keep_known(unique, flights, s))


def _forces(df: DataFrame, flights: DataFrame, regimes: DataFrame, fuel: DataFrame, s: Series) -> DataFrame:
    return enrich.with_thrust_fuel(enrich.attach_type(df, flights, s), regimes, fuel)


def preprocess(samples: DataFrame, flights: DataFrame, regimes: DataFrame, fuel: DataFrame, s: Series,
               windows: Mapping[str, int] | None = None, grid_points: int = 600, even_points: int = 500,
               min_rows: int = 10, floor: float = 10_000.0, block: int = 2048,
               numbers: Sequence[str] = SAMPLE_NUMBERS, phase_bucket_s: int | None = 60) -> DataFrame:
    """Raw samples of known flights to evenly spaced, enriched, phase-labelled samples.

    Phases are those of a row's time bucket (``phase_bucket_s`` must divide the slice).  Stages are written where the next step reads its input more
    than once, and deleted when the step after them is written.
    """
    even = replace(s, tie=("grid_index",))

    def cleaned() -> DataFrame:
        return unsliced(outlier_filter(_known_tracks(samples, flights, s), s, windows or FILTER_WINDOWS, block))

    def labels() -> DataFrame:
        kept = unsliced(cleaning.drop_short_entities(settled(cleaned, "clean"), s, min_rows, floor=floor))
        spaced = _airspeed(resample_fixed_n(kept, s, numbers, points=grid_points, n=even_points, circular=ANGLES))
        return phase_label(spaced, even, bucket_s=phase_bucket_s)

    labelled = settled(labels, "spaced")
    labelled = labelled.withColumn("label", thrust_regime(F.col("phase")))
    forced = _forces(labelled, flights, regimes, fuel, even)
    return unsliced(apply_steps(
        forced, even, air_distance_step(even), elapsed_step(even), mass_loss_step(even),
        between_step(F.col("phase") == "CLIMB", F.col("phase") == "DESCENT", cruise_like(), even),
    ))


def climb_preprocess(samples: DataFrame, flights: DataFrame, regimes: DataFrame, fuel: DataFrame, s: Series,
                     step_s: int = 1, min_rows: int = 10, floor: float = 10_000.0,
                     wide: int = 300, narrow: int = 100, numbers: Sequence[str] = SAMPLE_NUMBERS,
                     phase_bucket_s: int | None = 60) -> DataFrame:
    """Climb samples on a fine grid, smoothed; airspeed and distance are computed within the climb.

    Rows outside the climb are smoothed over, and for that need no more than their height and rate: the rest of them is not exchanged.
    """
    even = replace(s, tie=("grid_index",))

    def climbs() -> DataFrame:
        kept = unsliced(cleaning.drop_short_entities(_known_tracks(samples, flights, s), s, min_rows, floor=floor))
        grid = _airspeed(resample_fixed(kept, s, numbers, step_s=step_s, circular=ANGLES, dealt=True))
        labelled = phase_label(grid, even, bucket_s=phase_bucket_s)
        needed = (*even.group, *even.order, "altitude", "vertical_rate", "phase")
        inside = {c: F.when(F.col("phase") == "CLIMB", F.col(c)) for c in labelled.columns if c not in needed}
        complete = labelled.dropna(subset=["altitude", "vertical_rate"]).withColumns(inside).withColumn("raw_phase", F.col("phase"))
        smooth = unsliced(smooth_climb(complete, even, wide=wide, narrow=narrow))
        return smooth.filter(F.col("raw_phase") == "CLIMB").drop("raw_phase")

    climb = settled(climbs, "climb")
    forced = _forces(climb.withColumn("label", F.lit("climb")), flights, regimes, fuel, even)
    out = apply_steps(
        forced, even, air_distance_step(even), elapsed_step(even), mass_loss_step(even), position_step(even, "_place", "_size")
    )
    return unsliced(out.filter(F.col("_size") >= 2).drop("_place", "_size"))


def flight_feature_flow(enriched: DataFrame, s: Series) -> DataFrame:
    """Enriched samples to 48 features per flight; flights without any airspeed or altitude are dropped."""
    unique = cleaning.dedup_first(unsliced(enriched), [s.key, s.time], s.tie)
    base = materialise(unique, "unique")
    known = cleaning.drop_unknown_entities(base, s, ["tas", "altitude"])
    rated = materialise(unsliced(with_rate(known, "vertical_rate", "vertical_acc", s, scale=60.0)), "rated")
    trimmed = materialise(unsliced(trim_band_with_fallback(rated, s)), "trimmed")
    return flight_features(trimmed, s)


def climb_feature_flow(samples: DataFrame, flights: DataFrame, s: Series) -> DataFrame:
    """Band features and climb range of the climb samples, on the flight list."""
    aired = _airspeed(enrich.keep_known(samples.filter(F.col("phase") == "CLIMB"), flights, s))
    features = band_features(aired, s).join(enrich.row_per_entity(climb_range_rate(aired, s)), s.key, "left")
    return flights.join(enrich.row_per_entity(features), s.key, "left")


def assemble(flights: DataFrame, features: DataFrame, climb: DataFrame, types: DataFrame, airports: DataFrame,
             key: str = "flight_id", max_type_nulls: int = 1000, max_nulls: int = 400_000, drop_sparse: bool = True,
             impute: str | None = "gbt", impute_columns: Sequence[str] | None = None, protect: Sequence[str] = ("tow",)) -> DataFrame:
    """Flight list, sample features and dimensions to one wide table, sparse columns dropped, gaps filled.

    ``max_nulls`` is a number of rows, so with enough flights any column with gaps is sparse: the columns of ``protect`` and those to be
    imputed by name stay whatever the number.
    """
    df = flights.withColumn("submission", F.when(F.col("dataset") == "challenge", 0).otherwise(1))
    df = df.join(enrich.row_per_entity(features), key, "left")
    df = enrich.join_new_columns(df, climb, key)
    df = df.withColumn("ac", F.upper(F.trim("aircraft_type")))
    names = [c for c in types.columns if c != "ac"]
    df = enrich.join_dim(df, types, "ac", "ac", {c: c for c in names})
    df = enrich.with_airport_distance(df, enrich.airport_points(airports)).drop(
        "adep_lat", "adep_lon", "ades_lat", "ades_lon"
    )
    df = enrich.with_mach(enrich.with_ceiling_diff(enrich.with_drag_terms(df)))
    df = materialise(df, "assembled")
    df = stats.normalise_by_reference(df, "ac", max_type_nulls)
    extremes = stats.type_stats(df.select("ac", "flown_distance", "climb_range"), "ac").withColumnRenamed("ac", "_ac")
    df = df.join(extremes, F.col("ac") == F.col("_ac"), "left").drop("_ac")
    if drop_sparse:
        df = materialise(df, "normalised")
        df = cleaning.select_columns_by_profile(df, max_nulls, (key, *protect, *(impute_columns or ())))
    if impute:
        df = ml.impute_by_model(df, impute_columns, key=key, method=impute)
    return df


#: What specific thrust is computed from.
SPEC_THRUST_INPUTS = (*(f"drag_term{i}" for i in range(1, 1 + len(BANDS))), *(f"avg_path_angle_{b}" for b in BANDS))

#: What every model table is made from besides the columns that are chosen: keys, codes, types and times.
FEATURE_INPUTS = ("adep", "ades", "country_code_adep", "country_code_ades", "aircraft_type", "airline", "dataset", "flight_date",
                  "actual_offblock_time", "arrival_time")

#: Columns that are coded by numbers.  Fixed values.
CODED = ("adepdespair", "airline", "aircraft_type", "countrypair", "adep", "ades", "country_code_adep", "country_code_ades")

#: Columns no model reads.  Fixed values.
UNUSED = ("wtc", "ac", "callsign", "name_adep", "name_ades", "actual_offblock_time", "arrival_time", "dataset")


def model_features(df: DataFrame, features: Sequence[str] | DataFrame, n: int = 80,
                   protect: Sequence[str] = ("tow", "flight_id", "submission", "adep", "ades", "aircraft_type",
                                             "airline", "adepdespair", "countrypair"),
                   threshold: float = 0.01, key: str = "flight_id", date: str = "flight_date", spec_thrust: bool = True) -> DataFrame:
    """The assembled table as models read it: keys, families, time of day, float32, codes, specific thrust, chosen columns.

    ``features`` is an importance table or an ordered list of names, of which the first ``n`` count.  Specific thrust needs the drag and path
    angle of every band, and a table without them raises; ``spec_thrust=False`` leaves the step out.
    """
    out = cleaning.clean_names(df)
    missing = [c for c in SPEC_THRUST_INPUTS if c not in out.columns] if spec_thrust else []
    if missing:
        raise ValueError(f"specific thrust needs the columns {missing}")
    if "submission" not in out.columns:
        out = out.withColumn("submission", F.when(F.col("dataset") == "challenge", 0).otherwise(1))
    out = out.withColumns({
        "adepdespair": pair_key("adep", "ades"),
        "countrypair": pair_key("country_code_adep", "country_code_ades"),
        "time_of_day_offblock": hour_partition("actual_offblock_time"),
        "time_of_day_arrival": hour_partition("arrival_time"),
        "day_of_year": F.dayofyear(date).cast("bigint"),
    })
    out = encoding.combine_types(out, threshold=threshold).drop(*UNUSED)
    out = cleaning.cast_float32(out, keep=[key])
    if spec_thrust:
        out = enrich.with_spec_thrust(out)
    if isinstance(features, DataFrame):
        chosen = cleaning.top_features(features, n, protect)
    else:
        chosen = list(dict.fromkeys([*features[:n], *protect]))
    coded = [c for c in CODED if c in chosen]
    return encoding.factorize(out.select(*chosen), coded, key) if coded else out.select(*chosen)


def rmse_flow(preds: DataFrame, scored: DataFrame, key: str = "flight_id") -> DataFrame:
    """Two selections, by error over all rows and over test rows, and their even blend.

    All rows are scored: a model that leaves out a flight of a type is unscored there.
    """
    chosen = selection.select_twice(preds, scored, key=key)
    return chosen.withColumn("tow", F.col("tow_all") * 0.5 + F.col("tow_test") * 0.5)


def publish(predictions: DataFrame, submissions: DataFrame, folder: str, name: str = "model", features: int = 0) -> None:
    """Write what a training run produced: scored predictions per model and submissions, all in whole numbers."""
    scored = predictions.withColumns({c: F.bround(c, 0) for c in ("tow", "tow_pred")})
    tables.write_predictions(scored, f"{folder}/predictions", name, features)
    whole = submissions.select("flight_id", "model_id", "aircraft_type", F.col("tow").cast("bigint").alias("tow_pred"))
    tables.write_csv(whole, f"{folder}/submissions")


def select_submission(spark: SparkSession, folder: str, ids: DataFrame) -> DataFrame:
    """From published runs to one submission: best model per type, blended, in the order of the official ids."""
    scored = tables.read_predictions(spark, f"{folder}/predictions")
    schema = "flight_id bigint, model_id int, aircraft_type string, tow_pred double"
    unlabelled = spark.read.option("header", True).schema(schema).csv(f"{folder}/submissions")
    chosen = rmse_flow(unlabelled, scored)
    return selection.in_submission_order(ids, chosen)
