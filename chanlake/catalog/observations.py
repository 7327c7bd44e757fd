"""Queries over observations: an event observes the message that its number names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chanlake.catalog.base import EVENTS_SQL, Entry, events_k, when_sql, when_text
from chanlake.operators import observe
from chanlake.plans.observations import admissions, roll_up, track
from chanlake.schemas import OBSERVATIONS
from chanlake.session import work_path
from chanlake.sources.tables import to_schema
from chanlake.streaming.observations import (
    append_log,
    hourly_stream,
    read_observation_stream,
    write_hours,
)


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    rows = events_k(spark, sf_dir).select(
        F.concat(F.lit("c"), "user_id").alias("channel_id"),
        k.alias("id"),
        F.col("ts").alias("queried_at"),
        F.round(F.col("value") * 100).cast("bigint").alias("views"),
        F.when(F.col("event_type") != "error", k).alias("forwards"),
        F.when(k % 2 == 0, F.date_trunc("day", "ts")).alias("edit_date"),
        F.when(
            F.col("event_type") != "view", F.create_map(F.lit("A"), k, F.lit("B"), F.col("user_id"))
        ).alias("reactions"),
        F.when(F.col("event_type") != "click", k + 1).alias("replies"),
    )
    return to_schema(rows, OBSERVATIONS)


_OBS_SQL = f"""{EVENTS_SQL},
obs AS (SELECT channel_id, k AS id, ts AS queried_at, CAST(round(value * 100) AS BIGINT) AS views,
  CASE WHEN event_type <> 'error' THEN k END AS forwards, CASE WHEN k % 2 = 0 THEN date_trunc('day', ts) END AS edit_date,
  CASE WHEN event_type <> 'view' THEN 'A=' || k || ';B=' || user_id END AS reactions,
  CASE WHEN event_type <> 'click' THEN k + 1 END AS replies, event_id FROM ev)"""


def _joined(values: Column) -> Column:
    """A list as text with nulls in their places."""
    return F.array_join(F.transform(values, lambda v: F.coalesce(v.cast("string"), F.lit("-"))), "|")


def _shown_arrays(arrays: DataFrame) -> DataFrame:
    reactions = F.transform(
        "reactions",
        lambda m: F.array_join(
            F.transform(F.map_entries(m), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))),
            ";",
        ),
    )
    return arrays.select(
        "channel_id",
        "id",
        "page",
        _joined(F.transform("queried_at", when_text)).alias("queried_at"),
        _joined(F.col("views")).alias("views"),
        _joined(F.col("forwards")).alias("forwards"),
        _joined(F.transform("edit_date", when_text)).alias("edit_date"),
        _joined(reactions).alias("reactions"),
        _joined(F.col("replies")).alias("replies"),
    )


def observation_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown_arrays(observe.observation_arrays(observations(spark, sf_dir)))


def _agg_sql(value: str) -> str:
    return f"string_agg(coalesce({value}, '-'), '|' ORDER BY queried_at)"


ARRAYS_SQL = f"""WITH {_OBS_SQL}
SELECT channel_id, id, strftime(queried_at, '%Y-%m') AS page, {_agg_sql(when_sql('queried_at'))} AS queried_at,
  {_agg_sql('CAST(views AS VARCHAR)')} AS views, {_agg_sql('CAST(forwards AS VARCHAR)')} AS forwards,
  {_agg_sql(when_sql('edit_date'))} AS edit_date, {_agg_sql('reactions')} AS reactions,
  {_agg_sql("CAST(coalesce(replies, 0) AS VARCHAR)")} AS replies
FROM obs GROUP BY 1, 2, 3"""


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown_hours(observe.hourly_observations(observations(spark, sf_dir)))


def _shown_hours(hours: DataFrame) -> DataFrame:
    times = ("hour_start", "hour_end", "last_queried_at")
    return hours.select(
        "channel_id",
        *(when_text(t).alias(t) for t in times),
        "observations",
        "views",
        "forwards",
    )


_HOURS_SQL = f"""
SELECT channel_id, {when_sql("date_trunc('hour', queried_at)")} AS hour_start,
  {when_sql("date_trunc('hour', queried_at) + INTERVAL 1 HOUR")} AS hour_end, {when_sql('max(queried_at)')} AS last_queried_at,
  count(*) AS observations, CAST(sum(views) AS BIGINT) AS views, CAST(sum(forwards) AS BIGINT) AS forwards
FROM obs GROUP BY channel_id, date_trunc('hour', queried_at)"""
HOURLY_SQL = f"WITH {_OBS_SQL} {_HOURS_SQL}"


def new_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as new messages of fewer channels, so that hours fill up."""
    return events_k(spark, sf_dir).select(
        F.concat(F.lit("t"), "event_type").alias("channel_id"),
        F.col("event_id").alias("id"),
        F.col("ts").alias("date"),
    )


def sample_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observe.sample_cap(new_messages(spark, sf_dir)).select("channel_id", "id")


CAP_SQL = """
WITH m AS (SELECT 't' || event_type AS channel_id, event_id AS id, date_trunc('hour', ts) AS h FROM events),
c AS (SELECT channel_id, h, count(*) AS n FROM m GROUP BY 1, 2),
b AS (SELECT channel_id, h, coalesce(sum(n) OVER (PARTITION BY channel_id ORDER BY h ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM c)
SELECT channel_id, id FROM m JOIN b USING (channel_id, h) WHERE before < 100"""

_SPLIT = "2024-01-25"


def _saved_and_pull(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = observations(spark, sf_dir)
    split = F.to_timestamp(F.lit(_SPLIT))
    return rows.filter(F.col("queried_at") < split), rows.filter(F.col("queried_at") >= split)


_SAVED_SQL = f"""{_OBS_SQL},
saved AS (SELECT * FROM obs WHERE queried_at < TIMESTAMP '{_SPLIT}'),
pull AS (SELECT * FROM obs WHERE queried_at >= TIMESTAMP '{_SPLIT}'),
newest AS (SELECT *, row_number() OVER (PARTITION BY channel_id, id ORDER BY queried_at DESC) AS r FROM pull)"""


def latest_vs_saved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Saved observations, marked when the message is gone from the pull."""
    kept = observe.latest_vs_saved(*_saved_and_pull(spark, sf_dir), mark_deleted=True)
    return kept.select("channel_id", "id", when_text("queried_at").alias("queried_at"), "deleted")


LATEST_SQL = f"""WITH {_SAVED_SQL}
SELECT s.channel_id, s.id, {when_sql('s.queried_at')} AS queried_at, p.id IS NULL AS deleted
FROM saved s LEFT JOIN (SELECT DISTINCT channel_id, id FROM pull) p ON s.channel_id = p.channel_id AND s.id = p.id"""


def append_pull(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is still followed, with the newest observation of each message."""
    rows = observe.append_pull(*_saved_and_pull(spark, sf_dir))
    return rows.select("channel_id", "id", when_text("queried_at").alias("queried_at"), "views")


APPEND_SQL = f"""WITH {_SAVED_SQL}
SELECT channel_id, id, {when_sql('queried_at')} AS queried_at, views FROM saved
WHERE (channel_id, id) IN (SELECT channel_id, id FROM pull)
UNION ALL SELECT channel_id, id, {when_sql('queried_at')}, views FROM newest
WHERE r = 1 AND (channel_id, id) IN (SELECT channel_id, id FROM saved)"""


def tracked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two rounds of tracking on disk, rolled up to arrays and read back."""
    saved, pull = _saved_and_pull(spark, sf_dir)
    log, arrays = work_path(spark, "observations"), work_path(spark, "arrays")
    first = saved.withColumn("date", F.to_timestamp(F.lit("2024-01-01")))
    track(spark, pull.filter("false"), first, log, "1")
    track(spark, pull, first.filter("false"), log, "2")
    roll_up(spark, log, arrays, 16)
    read = spark.read.schema(
        "channel_id string, id bigint, page string, queried_at array<timestamp>, views array<bigint>"
    ).json(arrays)
    return read.select(
        "channel_id",
        "id",
        "page",
        F.size("queried_at").alias("observations"),
        _joined(F.col("views")).alias("views"),
    )


# All first observations carry one date, so one admitted hour takes them all in.
TRACKED_SQL = f"""WITH {_SAVED_SQL},
rows AS (
  SELECT channel_id, id, queried_at, views FROM saved WHERE (channel_id, id) IN (SELECT channel_id, id FROM pull)
  UNION ALL SELECT channel_id, id, queried_at, views FROM newest WHERE r = 1 AND (channel_id, id) IN (SELECT channel_id, id FROM saved))
SELECT channel_id, id, strftime(queried_at, '%Y-%m') AS page, CAST(count(*) AS INTEGER) AS observations,
  {_agg_sql('CAST(views AS VARCHAR)')} AS views FROM rows GROUP BY 1, 2, 3"""


def admitted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three rounds of admission, one for every ten days, while followed messages vanish.

    A round's pull has no message at all, so the log forgets the earlier ones: admission
    still counts them.
    """
    log = work_path(spark, "observations")
    new = new_messages(spark, sf_dir).withColumns(
        {"channel_id": F.concat("channel_id", F.col("id") % 50), "queried_at": F.col("date")}
    )
    part = F.least(F.floor((F.dayofmonth("date") - 1) / 10), F.lit(2))
    for number in range(3):
        track(spark, new.filter("false"), new.filter(part == number), log, str(number), cap=20)
    return admissions(spark, log)


ADMITTED_SQL = """
WITH m AS (SELECT 't' || event_type || event_id % 50 AS channel_id, event_id AS id, date_trunc('hour', ts) AS h,
  least((day(ts) - 1) // 10, 2) AS round FROM events),
c AS (SELECT channel_id, round, h, count(*) AS n FROM m GROUP BY 1, 2, 3),
b AS (SELECT channel_id, round, h, coalesce(sum(n) OVER (PARTITION BY channel_id ORDER BY round, h
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM c)
SELECT channel_id, id FROM m JOIN b USING (channel_id, round, h) WHERE before < 20"""


def _stream_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations as JSON files in time order, read as a stream."""
    path = work_path(spark, "observation-files")
    micros = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
    rows = observations(spark, sf_dir).repartitionByRange(4, "queried_at")
    rows.write.option("timestampFormat", micros).json(path)
    return read_observation_stream(spark, path)


def stream_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours the stream has closed: the watermark holds the newest ones back."""
    hours = work_path(spark, "hours")
    stream = hourly_stream(_stream_source(spark, sf_dir))
    write_hours(stream, hours, work_path(spark, "stream")).awaitTermination()
    return _shown_hours(spark.read.parquet(hours))


STREAM_HOURLY_SQL = f"""WITH {_OBS_SQL}, hours AS ({_HOURS_SQL})
SELECT * FROM hours WHERE hour_end <= (SELECT {when_sql("max(queried_at) - INTERVAL 2 HOUR")} FROM obs)"""


def stream_tracked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The append-only log kept by a stream, rolled up in batch."""
    log = work_path(spark, "log")
    append_log(_stream_source(spark, sf_dir), log, work_path(spark, "stream")).awaitTermination()
    rolled = observe.observation_arrays(to_schema(spark.read.parquet(log), OBSERVATIONS))
    return rolled.select(
        "channel_id",
        "id",
        "page",
        _joined(F.col("views")).alias("views"),
        _joined(F.col("replies")).alias("replies"),
    )


STREAM_TRACKED_SQL = f"""WITH {_OBS_SQL}
SELECT channel_id, id, strftime(queried_at, '%Y-%m') AS page, {_agg_sql('CAST(views AS VARCHAR)')} AS views,
  {_agg_sql("CAST(coalesce(replies, 0) AS VARCHAR)")} AS replies FROM obs GROUP BY 1, 2, 3"""

ENTRIES: dict[str, Entry] = {
    "observation_arrays": (observation_arrays, ARRAYS_SQL),
    "hourly_observations": (hourly, HOURLY_SQL),
    "sample_cap": (sample_cap, CAP_SQL),
    "latest_vs_saved": (latest_vs_saved, LATEST_SQL),
    "append_pull": (append_pull, APPEND_SQL),
    "track_updates": (tracked, TRACKED_SQL),
    "track_admissions": (admitted, ADMITTED_SQL),
    "stream_hourly": (stream_hourly, STREAM_HOURLY_SQL),
    "stream_track_updates": (stream_tracked, STREAM_TRACKED_SQL),
}
