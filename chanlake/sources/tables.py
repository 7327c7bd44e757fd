"""Canonical tables: read, cast, write."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chanlake.schemas import Schema
from chanlake.session import shuffles_deleted, stages
from chanlake.sources.paths import list_exists, missing_columns

BUCKET = "channel_bucket"
MONTH = "date_month"
DEFAULT_BUCKETS = 512
MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def to_schema(df: DataFrame, schema: Schema, keep: tuple[str, ...] = ()) -> DataFrame:
    """Exactly the columns of ``schema`` (after ``keep``), cast; absent ones are null."""
    have = set(df.columns)
    return df.select(
        *keep,
        *(
            (F.col(name) if name in have else F.lit(None)).cast(kind).alias(name)
            for name, kind in schema.items()
            if name not in keep
        ),
    )


def scan_table(
    spark: SparkSession, path: str, schema: Schema, keep: tuple[str, ...] = ()
) -> DataFrame | None:
    """A saved table cast to ``schema``; None when it is absent or lacks a column.

    None means the table must be rebuilt from its sources. One file's footer tells the
    columns: every write gives all of them.
    """
    if not list_exists(spark, path):
        return None
    saved = spark.read.parquet(path)
    if missing_columns(saved.schema, schema):
        return None
    return to_schema(saved, schema, keep)


def bucket_of(channel_id: str | Column, buckets: int = DEFAULT_BUCKETS) -> Column:
    """The folder of a channel. Channels share folders: one folder each would leave
    millions of tiny files."""
    column = F.col(channel_id) if isinstance(channel_id, str) else channel_id
    return F.pmod(F.xxhash64(column), F.lit(buckets)).cast("int")


def month_of(date: str | Column) -> Column:
    """The month of a date as a number such as 202401; 0 where there is none."""
    date = F.col(date) if isinstance(date, str) else date
    return F.coalesce(F.year(date) * 100 + F.month(date), F.lit(0)).cast("int")


def folders_of(df: DataFrame) -> list[str]:
    """The folder levels of a table of such rows: channel buckets, then months if rows have a time."""
    has_time = dict(df.dtypes).get("date", "").startswith(("timestamp", "date"))
    return [BUCKET, MONTH] if has_time else [BUCKET]


def with_folders(df: DataFrame, buckets: int = DEFAULT_BUCKETS) -> DataFrame:
    """Add the columns that name a row's folder."""
    named = df.withColumn(BUCKET, bucket_of("channel_id", buckets))
    return named.withColumn(MONTH, month_of("date")) if MONTH in folders_of(df) else named


def folder_name(folders: list[str]) -> Column:
    """A row's folder as text. As these are partition columns, a filter on it prunes folders."""
    return F.concat_ws("/", *(F.concat(F.lit(f"{f}="), F.col(f).cast("string")) for f in folders))


def write_bucketed(
    df: DataFrame, path: str, buckets: int = DEFAULT_BUCKETS, dynamic: bool = True
) -> None:
    """Write a table in channel buckets, and in months of ``date`` where there is one,
    replacing only the folders present in ``df`` (all of them if not ``dynamic``).

    The rows are rebalanced by folder at run time: small folders share a task, and one
    that a hot channel fills is split over as many tasks as its size asks for. Row order
    inside a file is by date where there is one, which keeps row-group statistics narrow.
    """
    folders = folders_of(df)
    order = folders + [c for c in ("date",) if c in df.columns]
    with shuffles_deleted(df.sparkSession):
        (
            with_folders(df, buckets)
            .hint("rebalance", *folders)
            .sortWithinPartitions(*order)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic" if dynamic else "static")
            .partitionBy(*folders)
            .parquet(path)
        )


def create_empty(like: DataFrame, path: str, folders: list[str] | None = None) -> None:
    """A bucketed table without rows: one empty file that holds the columns."""
    folders = folders_of(like) if folders is None else folders
    empty = like.sparkSession.createDataFrame([], like.drop(*folders).schema)
    empty.write.mode("overwrite").parquet("/".join([path.rstrip("/"), *(f"{f}=0" for f in folders)]))


def write_messages(df: DataFrame, path: str, buckets: int = DEFAULT_BUCKETS) -> None:
    """The message table, columns in sorted order."""
    write_bucketed(df.select(*sorted(c for c in df.columns if c not in (BUCKET, MONTH))), path, buckets)


def write_users(df: DataFrame, path: str, buckets: int = DEFAULT_BUCKETS) -> None:
    """Participants. Channels without any leave no rows and hence no files."""
    write_bucketed(df, path, buckets)


def write_service_messages(df: DataFrame, path: str, buckets: int = DEFAULT_BUCKETS) -> None:
    write_bucketed(df, path, buckets)


def write_observations(df: DataFrame, path: str, buckets: int = DEFAULT_BUCKETS) -> None:
    """Roll-ups of observations, as JSON lines in channel buckets."""
    bucketed = df.withColumn(BUCKET, bucket_of("channel_id", buckets))
    bucketed.hint("rebalance", BUCKET).write.mode("overwrite").partitionBy(BUCKET).json(path)


def write_version(df: DataFrame, root: str, version: str) -> str:
    """Write a new version of a small table next to the old ones and give its path.

    The version being read is never overwritten; readers switch to the new path.
    """
    path = f"{root.rstrip('/')}/version={version}"
    df.write.mode("overwrite").parquet(path)
    return path


def versions(spark: SparkSession, root: str) -> list[str]:
    """Names of all complete versions of a table, in order; no data is read."""
    if not list_exists(spark, root):
        return []
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(root)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(
        status.getPath().getName().removeprefix("version=")
        for status in fs.listStatus(folder)
        if status.getPath().getName().startswith("version=")
        and fs.exists(jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS"))
    )


def latest_version(spark: SparkSession, root: str) -> str | None:
    """Path of the newest complete version of a table, None if there is none."""
    done = versions(spark, root)
    return f"{root.rstrip('/')}/version={done[-1]}" if done else None


def replace_folder(df: DataFrame, path: str, kind: str = "parquet") -> None:
    """Put ``df``, which may read ``path``, in the place of the folder ``path``.

    It is written beside it, under a name that readers of the parent pass over, and takes its place
    when it is complete. A job lost in between leaves the one or the other, and ``df`` written anew
    gives the same.
    """
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path.rstrip("/"))
    beside = jvm.org.apache.hadoop.fs.Path(target.getParent(), f"_new-{target.getName()}")
    df.write.mode("overwrite").format(kind).save(str(beside.toString()))
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.delete(target, True)
    if not fs.rename(beside, target):
        raise OSError(f"{beside.toString()} could not take the place of {path}")


def finish_replacements(spark: SparkSession, path: str) -> None:
    """End what a lost ``replace_folder`` of ``path``, or of a folder in it, has begun."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path.rstrip("/"))
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    begun = [jvm.org.apache.hadoop.fs.Path(target.getParent(), f"_new-{target.getName()}")]
    if fs.exists(target) and fs.getFileStatus(target).isDirectory():
        begun += [s.getPath() for s in fs.listStatus(target) if s.getPath().getName().startswith("_new-")]
    for beside in begun:
        if not fs.exists(beside):
            continue
        place = jvm.org.apache.hadoop.fs.Path(beside.getParent(), beside.getName().removeprefix("_new-"))
        complete = fs.exists(jvm.org.apache.hadoop.fs.Path(beside, "_SUCCESS"))
        if complete and not fs.exists(place):
            fs.rename(beside, place)
        else:
            fs.delete(beside, True)


def write_channel_docs(docs: DataFrame, path: str, buckets: int = DEFAULT_BUCKETS) -> None:
    """Channel documents as JSON, in channel buckets."""
    columns = [c for c in docs.columns if c not in ("full_keys", "file_path", "file_modified")]
    rows = docs.select(*columns).withColumn(BUCKET, bucket_of(F.col("full_chat.id"), buckets))
    rows.hint("rebalance", BUCKET).write.mode("overwrite").partitionBy(BUCKET).json(path)


def write_monthly_jsonl(messages: DataFrame, path: str, period: Column) -> None:
    """Messages in one folder per channel and period; columns keep their nesting, nulls are written.

    Only the folders of channels and periods in ``messages`` are replaced.
    Rebalanced at run time, so that a month which holds much of the data is written by
    several tasks and small ones share one.
    """
    rows = messages.withColumn("period", period)
    (
        rows.hint("rebalance", "channel_id", "period")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("timestampFormat", MICROS)
        .option("ignoreNullFields", False)
        .partitionBy("channel_id", "period")
        .json(path)
    )


def add_first_written(new: DataFrame, path: str, key: str, order: Column) -> None:
    """Append the rows whose key is not stored yet, one per key: the first by ``order``."""
    spark = new.sparkSession
    fresh = new
    if list_exists(spark, path):
        stored = spark.read.parquet(path).select(key)
        fresh = new.join(stored, key, "left_anti")
    fresh = fresh.groupBy(key).agg(
        F.min_by(F.struct(*(c for c in new.columns if c != key)), order).alias("_first")
    )
    with stages(spark) as stage:
        stage(fresh.select(key, "_first.*"), "fresh").write.mode("append").parquet(path)


def write_cached_pages(pages: DataFrame, path: str) -> None:
    """Full web pages by ``media_id``; the first one written stays."""
    order = F.col("seen_at") if "seen_at" in pages.columns else F.xxhash64("page")
    add_first_written(pages, path, "media_id", order)
