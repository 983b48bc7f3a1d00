"""Readers with fixed schemas, and sinks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackmill.functions.timing import floor_div, micros
from trackmill.operators.cleaning import nan_to_null
from trackmill.operators.slices import Series, sliced, with_carry


_TYPES = {
    "bigint": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(), "string": T.StringType(),
    "date": T.DateType(), "timestamp": T.TimestampType(),
}


def _schema(text: str) -> T.StructType:
    """A schema from ``name type, ...`` without needing a session yet."""
    fields = [part.split() for part in text.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields])


FLIGHTS = _schema(
    "flight_id bigint, date date, callsign string, adep string, name_adep string, country_code_adep string,"
    " ades string, name_ades string, country_code_ades string, actual_offblock_time timestamp,"
    " arrival_time timestamp, aircraft_type string, wtc string, airline string, flight_duration double,"
    " flown_distance double, tow double"
)
SAMPLES = _schema(
    "flight_id bigint, event_time timestamp, seq bigint, altitude double, vertical_rate double, groundspeed double,"
    " track double, u_component_of_wind double, v_component_of_wind double, latitude double, longitude double,"
    " temperature double, specific_humidity double"
)
PREDICTIONS = _schema(
    "flight_id bigint, aircraft_type string, airline string, test int, tow double, tow_pred double"
)


def read_flights(spark: SparkSession, paths: Mapping[str, str], schema: T.StructType = FLIGHTS) -> DataFrame:
    """The flight lists under ``paths``, tagged with their key as ``dataset``.

    CSV columns are matched by header name, so a list may lack some (they read as NULL).
    """
    parts = []
    for tag, path in paths.items():
        header = spark.read.option("header", True).csv(path).columns
        known = {f.name: f for f in schema}
        part = spark.read.option("header", True).schema(
            T.StructType([known.get(c, T.StructField(c, T.StringType())) for c in header])
        ).csv(path)
        parts.append(part.select(*[c for c in header if c in known]).withColumn("dataset", F.lit(tag)))
    return nan_to_null(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts))


def read_samples(spark: SparkSession, path: str, columns: Sequence[str] | None = None,
                 time: str = "event_time", schema: T.StructType | None = None) -> DataFrame:
    """Sample files: NaN becomes NULL, the time becomes a session-zone timestamp.

    Files written by pandas hold nanoseconds, which the engine reads only as integers.
    """
    spark.conf.set("spark.sql.legacy.parquet.nanosAsLong", "true")
    reader = spark.read.schema(schema) if schema else spark.read
    df = reader.parquet(path)
    if columns:
        df = df.select(*columns)
    if time in df.columns:
        if isinstance(df.schema[time].dataType, T.LongType):
            instant = F.timestamp_micros(floor_div(F.col(time), F.lit(1000)))
        else:
            instant = F.col(time).cast("timestamp")
        df = df.withColumn(time, instant)
    return nan_to_null(df)


def read_dim(spark: SparkSession, path: str, schema: T.StructType | str, columns: Sequence[str]) -> DataFrame:
    """Chosen columns of a dimension CSV, whose header must follow ``schema``."""
    return nan_to_null(
        spark.read.option("header", True).option("enforceSchema", False).schema(schema).csv(path).select(*columns)
    )


def read_predictions(spark: SparkSession, folder: str, marker: str = "_with_tow_pred",
                     token: str = r"_(\d+)_\d+_with_tow_pred", schema: T.StructType = PREDICTIONS) -> DataFrame:
    """All prediction files of a folder as one long table; ``model_id`` comes from the file name.

    Only names containing ``marker`` are read (a file, or a folder Spark wrote).
    """
    rows = spark.read.option("header", True).schema(schema).csv(f"{folder}/*{marker}*")
    return rows.withColumn("model_id", F.regexp_extract(F.col("_metadata.file_path"), token, 1).cast("int"))


def write_predictions(preds: DataFrame, folder: str, name: str = "model", features: int = 0) -> None:
    """One folder of CSV per model, named so that :func:`read_predictions` finds the model again."""
    label = F.concat_ws("_", F.lit(name), F.col("model_id").cast("string"), F.lit(str(features)), F.lit("with_tow_pred"))
    columns = [f.name for f in PREDICTIONS]
    known = preds.withColumns({f.name: F.lit(None).cast(f.dataType) for f in PREDICTIONS if f.name not in preds.columns})
    (
        known.select(*columns, label.alias("file")).hint("rebalance", "file")
        .write.mode("overwrite").partitionBy("file").option("header", True).csv(folder)
    )


def with_first_date(df: DataFrame, s: Series, name: str = "flight_date") -> DataFrame:
    """The day of the entity's first sample, so that an entity never splits over days."""
    out = with_carry(sliced(df, s), s, {"_lo": F.min(micros(s.time))}, {"_first": F.min("_lo").over(s.entity())})
    return out.withColumn(name, F.to_date(F.timestamp_micros("_first"))).drop("_first")


def write_daily(df: DataFrame, path: str, s: Series, day: str = "flight_date", also: Sequence[str] = ()) -> None:
    """Parquet by day of the entity's first sample.  Rewriting a day replaces it, nothing else.

    The rebalance lets the engine split a heavy day over several files and merge light ones.
    """
    dated = with_first_date(df, s, day).drop("_slice")
    (
        dated.hint("rebalance", day, *also)
        .write.partitionBy(day, *also).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
    )


def compact(spark: SparkSession, source: str, target: str, by: Sequence[str] = ()) -> DataFrame:
    """Merge many small Parquet files into few large ones under a new path."""
    df = spark.read.parquet(source)
    evened = df.hint("rebalance", *by)
    writer = evened.write.mode("overwrite")
    (writer.partitionBy(*by) if by else writer).parquet(target)
    return spark.read.parquet(target)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(
        header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(path)
