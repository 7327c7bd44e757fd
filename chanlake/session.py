"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from contextlib import AbstractContextManager, contextmanager
from contextvars import ContextVar
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings the library relies on; all can be changed on a live session.
SQL_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Folders are listed by at most so many tasks; by default each of up to 10,000 is a task.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "96",
}

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings to an existing session."""
    for name, value in SQL_CONF.items():
        spark.conf.set(name, value)
    return spark


def create_session(app_name: str = "chanlake", master: str | None = None, **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in {**SQL_CONF, **conf}.items():
        builder = builder.config(name, value)
    return configure(builder.getOrCreate())


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> SparkSession:
    """Give Python tasks this package: its source as a zip among the session's Python files, once
    for a session."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        package = Path(__file__).resolve().parent
        folder = tempfile.mkdtemp(prefix="chanlake-code-")  # Spark serves the file from here
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        path = os.path.join(folder, f"{package.name}.zip")
        with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
            for source in sorted(package.rglob("*.py")):
                archive.write(source, source.relative_to(package.parent))
        context.addPyFile(path)
        _SHIPPED.add(context.applicationId)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it.

    Only a local session without the setting (a test) gets a folder of its own.
    """
    root = spark.conf.get(CHECKPOINT_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder all executors can reach")
        root = tempfile.mkdtemp(prefix="chanlake-")
        spark.conf.set(CHECKPOINT_SETTING, root)
    return root.rstrip("/")


def work_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder; every call gives another one."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


# Shuffle files of a job leave the executors' disks when the job ends, not when the driver happens
# to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shuffles_deleted(spark: SparkSession) -> AbstractContextManager[None]:
    """For the jobs of this block."""
    return settings(spark, {CLEANUP: "true"})


def write_stage(df: DataFrame, name: str = "stage") -> str:
    """Write ``df`` as Parquet in the shared folder; gives the path. Its shuffles are done with."""
    path = work_path(df.sparkSession, name)
    with shuffles_deleted(df.sparkSession):
        df.write.parquet(path)
    return path


def materialised(df: DataFrame, name: str = "stage", keep: bool = False) -> DataFrame:
    """Write ``df`` in the shared folder and read it back.

    Cheaper than a checkpoint when the result is scanned several times: later plans get
    column pruning, pushed filters and real size statistics. Inside ``scratch`` it is deleted with
    the block, unless it is to be kept: then with the block around that, if there is one.
    """
    path = write_stage(df, name)
    scopes = _SCRATCH.get()
    if len(scopes) > keep:
        scopes[-1 - keep].append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_SCRATCH: ContextVar[tuple[list[str], ...]] = ContextVar("scratch", default=())


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete in the end what ``materialised`` has written in this block."""
    paths: list[str] = []
    token = _SCRATCH.set((*_SCRATCH.get(), paths))
    try:
        yield
    finally:
        _SCRATCH.reset(token)
        for path in paths:
            discard(spark, path)


@contextmanager
def stages(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """Gives ``materialised`` for stages that are deleted at the end of the block."""
    paths = []

    def stage(df: DataFrame, name: str = "stage") -> DataFrame:
        paths.append(write_stage(df, name))
        return spark.read.schema(df.schema).parquet(paths[-1])

    try:
        yield stage
    finally:
        for path in paths:
            discard(spark, path)


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Runtime settings for the jobs of this block."""
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


class BucketedStage:
    """A table in the shared folder, dealt to buckets by ``keys``: joins and groups by these keys
    do not move it. It may grow; ``parts`` name the column that tells what was appended together.
    """

    def __init__(self, spark: SparkSession, name: str, buckets: int, keys: list[str], parts: tuple[str, ...] = ()):
        self.spark, self.buckets, self.keys, self.parts = spark, buckets, keys, parts
        self.path = work_path(spark, name)
        self.table = "stage_" + self.path.rsplit("-", 1)[-1]

    def append(self, df: DataFrame) -> None:
        """The rows become one file for each bucket if ``df`` is dealt by the same keys."""
        writer = df.write.format("parquet").mode("append").option("path", self.path)
        if self.parts:
            writer = writer.partitionBy(*self.parts)
        writer.bucketBy(self.buckets, *self.keys).sortBy(*self.keys).saveAsTable(self.table)

    def read(self) -> DataFrame:
        return self.spark.table(self.table)

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")
        discard(self.spark, self.path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete a stage that nothing reads any more."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
