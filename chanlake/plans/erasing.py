"""Erasing channels from all that an archive keeps, and the proof that nothing of them is left.

An archive is described by its holdings. A tombstone log says which channels are to go and which
are gone: it is written before anything is erased and closed after all is, so a job that
was lost is finished by its repetition, and each step may be repeated.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chanlake.operators.erase import erase_channels, erase_from_table
from chanlake.operators.locations import index_path
from chanlake.session import discard, shared_dir, stages
from chanlake.sources.manifest import list_files
from chanlake.sources.paths import list_exists, with_path_params
from chanlake.sources.segments import PLACE, erase_from_packs, marks_path, segment_lines
from chanlake.sources.tables import (
    BUCKET,
    DEFAULT_BUCKETS,
    bucket_of,
    finish_replacements,
    latest_version,
    replace_folder,
    versions,
)

LOG = "channel_id string, state string, at timestamp"
ASKED, DONE = "asked", "done"


@dataclass(frozen=True)
class Holding:
    """A table or folder with what belongs to channels.

    ``kind`` is one of ``KINDS``. ``key`` names the column with the channel. Where the channel
    stands in the path of a file, ``template`` says where, and ``key`` is the column with the path.
    ``by``: for a table of shared values, the table that says which channels use a value, the
    column of the value there and here.
    """

    name: str
    kind: str
    path: str
    key: str = "channel_id"
    template: str = ""
    by: tuple[str, str, str] = ("", "", "")


def _read(spark: SparkSession, holding: Holding, path: str | None = None) -> DataFrame:
    """The rows of a holding, with the channel as ``_channel``."""
    path = path or holding.path
    if holding.kind == "json":
        rows = spark.read.json(path)
    elif holding.kind == "files":
        rows = list_files(spark, path, "*")
    elif holding.kind == "packs":
        rows = segment_lines(spark, path, packs=True)
    else:
        rows = spark.read.option("recursiveFileLookup", False).parquet(path)
    if not holding.template:
        return rows.withColumn("_channel", F.col(holding.key).cast("string"))
    keyed = with_path_params(rows.withColumn("_path", F.col(holding.key)), holding.template, "_path", keep_others=True)
    return keyed.withColumn("_channel", F.col("channel_id")).drop("_path", *({"channel_id", "period", "file"} - set(rows.columns)))


def _rest(rows: DataFrame, tombstones: DataFrame) -> DataFrame:
    return erase_channels(rows, tombstones, "_channel").drop("_channel")


def _of_gone(rows: DataFrame, tombstones: DataFrame) -> DataFrame:
    return rows.join(tombstones.select(F.col("channel_id").alias("_channel")).distinct(), "_channel", "left_semi")


def _buckets(spark: SparkSession, holding: Holding, tombstones: DataFrame, buckets: int) -> None:
    """A table in channel buckets: those that hold erased channels are rewritten."""
    erase_from_table(spark.read.parquet(holding.path), holding.path, tombstones, buckets)


def _rows(spark: SparkSession, holding: Holding, tombstones: DataFrame, buckets: int) -> None:
    """A plain table, rewritten if it has to be."""
    rows = _read(spark, holding)
    if not _of_gone(rows, tombstones).isEmpty():
        replace_folder(_rest(rows, tombstones), holding.path)


def _rounds(spark: SparkSession, holding: Holding, tombstones: DataFrame, buckets: int) -> None:
    """A log of rounds: all of them count, and each that holds erased channels is rewritten."""
    for version in versions(spark, holding.path):
        path = f"{holding.path.rstrip('/')}/version={version}"
        rows = _read(spark, holding, path)
        if not _of_gone(rows, tombstones).isEmpty():
            replace_folder(_rest(rows, tombstones), path)


def _versions(spark: SparkSession, holding: Holding, tombstones: DataFrame, buckets: int) -> None:
    """A table in versions: the newest is rewritten, superseded ones go."""
    _superseded(spark, holding.path)
    newest = latest_version(spark, holding.path)
    if newest:
        _rows(spark, Holding(holding.name, "rows", newest, holding.key), tombstones, buckets)


def _superseded(spark: SparkSession, root: str) -> None:
    for version in versions(spark, root)[:-1]:
        discard(spark, f"{root.rstrip('/')}/version={version}")


def _gone_values(spark: SparkSession, holding: Holding, tombstones: DataFrame) -> DataFrame:
    """Values that erased channels use and no other."""
    table, there, here = holding.by
    uses = spark.read.parquet(table).select(F.col("channel_id").alias("_channel"), F.col(there).alias(here))
    uses = uses.filter(F.col(here).isNotNull())
    gone, kept = _of_gone(uses, tombstones).select(here).distinct(), erase_channels(uses, tombstones, "_channel").select(here)
    return gone.join(kept, here, "left_anti")


def _values(spark: SparkSession, holding: Holding, tombstones: DataFrame, buckets: int) -> None:
    """A table of values that channels share: those that only erased channels use go, which has to be
    found before the table that tells is erased."""
    versioned = bool(versions(spark, holding.path))
    if versioned:
        _superseded(spark, holding.path)
    path = latest_version(spark, holding.path) if versioned else holding.path
    here = holding.by[2]
    with stages(spark) as stage:
        gone = stage(_gone_values(spark, holding, tombstones), "gone-values")
        rows = spark.read.parquet(path)
        if not rows.join(gone, here, "left_semi").isEmpty():
            replace_folder(rows.join(gone, here, "left_anti"), path)


def _json(spark: SparkSession, holding: Holding, tombstones: DataFrame, buckets: int) -> None:
    """JSON lines in channel buckets: those with erased channels are rewritten as text, as they are."""
    named = tombstones.select(bucket_of("channel_id", buckets).alias(BUCKET)).distinct()
    for row in named.collect():  # at most ``buckets`` integers
        path = f"{holding.path.rstrip('/')}/{BUCKET}={row[0]}"
        if list_exists(spark, path):
            lines = spark.read.text(path).withColumn("_channel", F.get_json_object("value", f"$.{holding.key}"))
            if not _of_gone(lines, tombstones).isEmpty():
                replace_folder(_rest(lines, tombstones), path, "text")


def _files(spark: SparkSession, holding: Holding, tombstones: DataFrame, buckets: int) -> None:
    """Files with the channel in their path are removed."""
    for row in _of_gone(_read(spark, holding), tombstones).select("path").collect():  # names of what goes
        discard(spark, row.path)


def _packs(spark: SparkSession, holding: Holding, tombstones: DataFrame, buckets: int) -> None:
    """Packs of logs in channel buckets: those that hold erased channels are rewritten."""
    erase_from_packs(spark, holding.path, tombstones, buckets)


KINDS: dict[str, Callable[[SparkSession, Holding, DataFrame, int], None]] = {
    "values": _values, "buckets": _buckets, "rows": _rows, "rounds": _rounds, "versions": _versions, "json": _json, "files": _files,
    "packs": _packs,
}


def message_holdings(tables, template: str) -> list[Holding]:
    """What :class:`MessageTables` names."""
    return [
        Holding("messages", "buckets", tables.messages),
        Holding("service", "buckets", tables.service),
        Holding("quarantine", "rows", tables.quarantine, "file_path", template),
        Holding("manifest", "rows", tables.files, "path", template),
    ]


def stored_holdings(stored, tables, template: str, stored_template: str, packs: bool = False) -> list[Holding]:
    """What :class:`StoredLogs` names. The message table of ``tables`` tells who uses a page."""
    logs = Holding("stored logs", "files", stored.messages, "path", stored_template)
    return [
        Holding("pages", "values", stored.cached_pages, by=(tables.messages, "media_id", "media_id")),
        Holding("stored logs", "packs", stored.messages) if packs else logs,
        Holding("marks", "rows", marks_path(stored.messages), PLACE[0]),
        Holding("channel maps", "buckets", stored.channel_maps),
        Holding("forwards", "buckets", stored.forwards),
        Holding("private quarantine", "rows", stored.quarantine, "file_path", template),
        Holding("private manifest", "rows", stored.files, "path", template),
    ]


def ask(channels: DataFrame, log: str) -> DataFrame:
    """Enter channels in the tombstone log; gives all that are asked for and not done."""
    spark = channels.sparkSession
    wanted = channels.select(F.col("channel_id").cast("string").alias("channel_id")).distinct()
    entries = wanted.select("channel_id", F.lit(ASKED).alias("state"), F.current_timestamp().alias("at"))
    entries.write.mode("append").parquet(log)
    return pending(spark, log)


def pending(spark: SparkSession, log: str) -> DataFrame:
    """Channels whose last entry asks for their removal: one that was erased may come again."""
    newest = spark.read.schema(LOG).parquet(log).groupBy("channel_id").agg(
        F.max_by("state", F.struct("at", (F.col("state") == ASKED).alias("asked"))).alias("state")
    )
    return newest.filter(F.col("state") == ASKED).select("channel_id")


def erase_job(channels: DataFrame, holdings: list[Holding], log: str, buckets: int = DEFAULT_BUCKETS) -> int:
    """Erase the channels, and those of earlier jobs that did not end, from all holdings.

    Holdings of shared values go first, as others tell who uses a value. Absent holdings are passed
    over. Gives the number of traces that are left, 0 if all went well; only then the log is closed.
    """
    spark = channels.sparkSession
    with stages(spark) as stage:
        tombstones = stage(ask(channels, log), "tombstones")
        for holding in holdings:
            finish_replacements(spark, holding.path)
        for kind, erase in KINDS.items():
            for holding in holdings:
                if holding.kind == kind and list_exists(spark, holding.path):
                    erase(spark, holding, tombstones, buckets)
        left = traces(spark, holdings, tombstones).count()
        if not left:
            done = tombstones.select("channel_id", F.lit(DONE).alias("state"), F.current_timestamp().alias("at"))
            done.write.mode("append").parquet(log)
    return left


def traces(spark: SparkSession, holdings: list[Holding], tombstones: DataFrame) -> DataFrame:
    """``name, channel_id, rows`` of what the holdings still have of the channels; none is the proof.

    All versions and rounds are looked at, side tables and names of files and folders too.
    """
    found = [spark.createDataFrame([], "name string, channel_id string, rows bigint")]
    for holding in holdings:
        if not list_exists(spark, holding.path) or holding.kind == "values":
            continue
        looked = [_read(spark, holding)]
        if holding.kind == "buckets" and list_exists(spark, index_path(holding.path)):
            looked.append(_read(spark, Holding(holding.name, "rows", index_path(holding.path))))
        for rows in looked:
            counted = _of_gone(rows.select("_channel"), tombstones).groupBy(F.col("_channel").alias("channel_id"))
            counted = counted.agg(F.count("*").alias("rows"))
            found.append(counted.select(F.lit(holding.name).alias("name"), "channel_id", "rows"))
    return reduce(DataFrame.unionByName, found)


def vacuum_stages(spark: SparkSession, days: float) -> list[str]:
    """Remove folders in the shared folder that nothing has changed for so long: stages that lost jobs
    left, which may hold rows of erased channels. Gives their names."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(shared_dir(spark))
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    now = spark.range(1).select((F.unix_micros(F.current_timestamp()) / 1000).alias("ms")).first()[0]
    old = [s.getPath() for s in fs.listStatus(root) if s.isDirectory() and s.getModificationTime() < now - days * 86_400_000]
    for path in old:
        fs.delete(path, True)
    return sorted(path.getName() for path in old)
