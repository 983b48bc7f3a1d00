"""Queries that bring tables together by time, and what comes in pieces: as-of and interval joins, frames of seconds, sessions, streams."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from trackmill.functions.timing import MICROS, micros
from trackmill.operators import asof, frames, intervals, nested, sessions, sketches
from trackmill.operators.slices import Series
from trackmill.plans import blocks
from trackmill.plans.blocks import FX
from trackmill.plans.registry import block, query, rounded, rounded_sql
from trackmill.session import fresh_path, materialise
from trackmill.sources import views
from trackmill.streaming.flights import ingest_flights

#: Eight regions share all samples, so a region is a key with very many rows.
REGIONS = Series("region", "event_time", ("flight_id", "seq"), 6 * 3600)
GAP_S = 6 * 3600

block("weather", """
  SELECT user_id % 8 AS region, ts AS noted, max(value) AS wind, max(event_id) AS report FROM events WHERE event_id % 5 = 0 GROUP BY user_id % 8, ts""")
block("zones", """
  SELECT event_id AS zone_id, user_id % 8 AS region, epoch_us(ts) AS opens_us,
    epoch_us(ts) + CAST((60 * (1 + event_id % 7) * CASE event_id % 3 WHEN 0 THEN 1 WHEN 1 THEN 10 ELSE 100 END) AS BIGINT) * 1000000 AS closes_us
  FROM events WHERE event_id % 40 = 0""")


def events(spark, sf):
    return views.table(spark, sf, "events").withColumn("region", F.col("user_id") % 8)


def in_regions(spark, sf):
    return blocks.tracks(spark, sf).withColumn("region", F.col("flight_id") % 8)


def weather(spark, sf):
    """Reports of wind by region; those of one instant stay apart, and the join takes the greatest."""
    return events(spark, sf).filter("event_id % 5 = 0").select("region", F.col("ts").alias("noted"), F.col("value").alias("wind"), F.col("event_id").alias("report"))


def zones(spark, sf):
    long = F.when(F.col("event_id") % 3 == 0, 1).when(F.col("event_id") % 3 == 1, 10).otherwise(100)
    closes = F.timestamp_micros(micros("ts") + 60 * (1 + F.col("event_id") % 7) * long * MICROS)
    return events(spark, sf).filter("event_id % 40 = 0").select(
        F.col("event_id").alias("zone_id"), "region", F.col("ts").cast("timestamp").alias("opens"), closes.alias("closes"))


@query("asof_join", """
SELECT flight_id, seq, CASE WHEN age <= 3600 THEN wind END AS wind, CASE WHEN age <= 3600 THEN age END AS age FROM (
  SELECT s.flight_id, s.seq, w.wind, (epoch_us(s.event_time) - epoch_us(w.noted)) / 1e6 AS age
  FROM (SELECT *, flight_id % 8 AS region FROM tracks) s ASOF LEFT JOIN weather w ON s.region = w.region AND s.event_time >= w.noted)""")
def asof_join(spark, sf):
    joined = asof.asof_join(in_regions(spark, sf), weather(spark, sf), REGIONS, "noted", ["wind"], tolerance_s=3600, age="age")
    return joined.select("flight_id", "seq", "wind", "age")


@query("interval_join", """
SELECT s.flight_id, s.seq, z.zone_id FROM (SELECT *, flight_id % 8 AS region, epoch_us(event_time) AS us FROM tracks) s
JOIN zones z ON s.region = z.region AND s.us >= z.opens_us AND s.us < z.closes_us""")
def interval_join(spark, sf):
    held = materialise(in_regions(spark, sf).select("flight_id", "seq", "region", "event_time"), "held")
    return intervals.interval_join(held, zones(spark, sf), ["region"], "event_time", "opens", "closes").select("flight_id", "seq", "zone_id")


@query("time_range_frame", rounded_sql("""
SELECT flight_id, seq, count(altitude) OVER w AS known, avg(altitude) OVER w AS mean_altitude, min(altitude) OVER w AS lowest FROM tracks
WINDOW w AS (PARTITION BY flight_id ORDER BY event_time RANGE BETWEEN INTERVAL 6 HOUR PRECEDING AND INTERVAL 2 HOUR FOLLOWING)""", "mean_altitude lowest"))
def time_range_frame(spark, sf):
    tracks = blocks.tracks(spark, sf).select("flight_id", "event_time", "seq", "altitude")
    framed = frames.with_time_frame(tracks, FX, {
        "known": lambda w: F.count("altitude").over(w), "mean_altitude": lambda w: F.avg("altitude").over(w), "lowest": lambda w: F.min("altitude").over(w),
    }, 6 * 3600, 2 * 3600)
    return rounded(framed.select("flight_id", "seq", "known", "mean_altitude", "lowest"))


block("sessioned", f"""
  SELECT *, sum(fresh) OVER (PARTITION BY flight_id ORDER BY event_time, seq) AS session FROM (
    SELECT *, CASE WHEN epoch_us(event_time) - epoch_us(lag(event_time) OVER (PARTITION BY flight_id ORDER BY event_time, seq)) >= {GAP_S * MICROS}
              THEN 1 ELSE 0 END AS fresh FROM tracks)""")
SESSION_SUMMARY = """
SELECT flight_id, epoch_us(min(event_time)) AS started, epoch_us(max(event_time)) AS ended, count(*) AS samples FROM sessioned GROUP BY flight_id, session"""


def in_micros(df):
    return df.select("flight_id", F.unix_micros("started").alias("started"), F.unix_micros("ended").alias("ended"), "samples")


@query("sessions", "SELECT flight_id, seq, CAST(session AS BIGINT) AS session FROM sessioned")
def sessions_query(spark, sf):
    return sessions.with_sessions(blocks.stored_tracks(spark, sf), FX, GAP_S).select("flight_id", "seq", "session")


@query("session_summary", SESSION_SUMMARY)
def session_summary(spark, sf):
    tracks = blocks.tracks(spark, sf).withColumn("event_time", F.col("event_time").cast("timestamp"))
    return in_micros(sessions.session_summary(tracks, FX, GAP_S))


def delivered(spark, sf, parts=3):
    """The samples in deliveries that cut across all flights, and a heartbeat long after them."""
    root = fresh_path(spark, "deliveries")
    df = materialise(blocks.tracks(spark, sf).select("flight_id", "seq", F.col("event_time").cast("timestamp").alias("event_time"), "altitude"), "samples")
    ends = df.agg(F.min(micros("event_time")), F.max(micros("event_time"))).first()
    step = (ends[1] - ends[0]) // parts + 1
    late = spark.createDataFrame([(ends[1] + 400 * 86_400 * MICROS,)], "us bigint")
    heartbeat = late.select(*[F.lit(None).cast(df.schema[c].dataType).alias(c) for c in ("flight_id", "seq")],
                            F.timestamp_micros("us").alias("event_time"), F.lit(None).cast("double").alias("altitude"))
    cuts = [df.filter(F.floor((micros("event_time") - ends[0]) / step) == k) for k in range(parts)]
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema])
    return f"{root}/in", root, schema, [*cuts, heartbeat]


@query("session_stream", SESSION_SUMMARY)
def session_stream(spark, sf):
    """The sessions of the deliveries, each summed up when the watermark has passed its gap."""
    source, root, schema, cuts = delivered(spark, sf)
    for cut in cuts:
        cut.write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source).withWatermark("event_time", "0 seconds")
        closed = sessions.session_summary(stream.filter("flight_id is not null or altitude is null"), FX, GAP_S)
        (closed.writeStream.outputMode("append").option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True)
         .start(f"{root}/out").awaitTermination())
    return in_micros(spark.read.parquet(f"{root}/out").filter("flight_id is not null"))


@query("flight_stream", """
SELECT flight_id, seq, CAST(count(*) OVER (PARTITION BY flight_id) AS BIGINT) AS in_flight FROM tracks""")
def flight_stream(spark, sf):
    """Flights cut in the middle by deliveries: each is handed on once, when it is complete, with all its samples."""
    source, root, schema, cuts = delivered(spark, sf)

    def whole(flights):
        sizes = flights.groupBy("flight_id").agg(F.count(F.lit(1)).alias("in_flight"))
        return flights.join(sizes, "flight_id")

    for cut in cuts:
        cut.write.mode("append").parquet(source)
        ingest_flights(spark, source, f"{root}/out", f"{root}/late", f"{root}/checkpoint", schema, whole, FX, 60 * 86_400)
    return spark.read.parquet(f"{root}/out").select("flight_id", "seq", "in_flight")


@query("merged_quantiles", """
SELECT flight_id, count(altitude) AS known, max(altitude) AS highest, true AS within FROM tracks GROUP BY flight_id""")
def merged_quantiles(spark, sf):
    """Quantile states of each flight and day, stored, and merged to flights: the exact rank of the median lies within the bound."""
    tracks = blocks.stored_tracks(spark, sf).withColumn("day", F.to_date("event_time"))
    stored = materialise(sketches.quantile_states(tracks, ["flight_id", "day"], ["altitude"]), "states")
    merged = sketches.merged_states(stored, ["flight_id"], ["altitude"])
    read = sketches.quantiles(merged, ["flight_id"], {"middle": ("altitude", 0.5), "highest": ("altitude", 1.0)})
    ranks = tracks.join(read, "flight_id").groupBy("flight_id").agg(
        F.count("altitude").alias("known"), F.max("highest").alias("highest"), F.count_if(F.col("altitude") < F.col("middle")).alias("below"),
        F.count_if(F.col("altitude") <= F.col("middle")).alias("up_to"))
    bound = sketches.rank_error() * F.col("known") + 1
    within = (F.col("known") == 0) | ((F.col("below") <= F.col("known") / 2 + bound) & (F.col("up_to") >= F.col("known") / 2 - bound))
    return ranks.select("flight_id", "known", "highest", within.alias("within"))


@query("nested_track", """
SELECT flight_id, seq, (epoch_us(event_time) - epoch_us(min(event_time) OVER (PARTITION BY flight_id))) / 1e6 AS ts, CASE WHEN t IS NULL THEN 0e0
  ELSE (vertical_rate - v) / nullif((epoch_us(event_time) - epoch_us(t)) / 1e6, 0) / 60 END AS vertical_acc
FROM (SELECT *, lag(event_time) OVER w AS t, lag(vertical_rate) OVER w AS v FROM tracks
      WINDOW w AS (PARTITION BY flight_id ORDER BY event_time, seq))""")
def nested_track(spark, sf):
    tracks = nested.with_neighbours(nested.nest(blocks.tracks(spark, sf), FX, ["vertical_rate"]), FX)
    done = nested.map_samples(tracks, ts=nested.elapsed, vertical_acc=nested.rate("vertical_rate", scale=60.0))
    return nested.unnest(done, FX).select("flight_id", "seq", "ts", "vertical_acc")


@query("nested_climb", rounded_sql("""
SELECT flight_id, sum(greatest(altitude - coalesce(ahead, altitude), 0)) AS total_climb, count(*) AS known FROM (
  SELECT flight_id, altitude, lag(altitude) OVER (PARTITION BY flight_id ORDER BY event_time, seq) AS ahead FROM tracks WHERE altitude IS NOT NULL)
GROUP BY flight_id""", "total_climb"))
def nested_climb(spark, sf):
    climbed = nested.summary(nested.nest(blocks.tracks(spark, sf), FX, ["altitude"]), FX, "altitude")
    return rounded(climbed.filter("known > 0"))
