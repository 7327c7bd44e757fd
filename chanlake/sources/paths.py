"""Keys held in file and folder names, and incremental selection of files."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def list_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on whatever file system its URI names."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of a file, or of all files in a folder."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(target).getLength()


def _segments(template: str, fixed: dict) -> tuple[str, list[str]]:
    """Literal and key segments of a ``{key}`` template as one pattern, and its free keys."""
    parts = re.split(r"\{(\w+)\}", template)
    literals, keys = parts[::2], parts[1::2]
    found = [re.escape(str(fixed[key])) if key in fixed else "(.+)" for key in keys]
    pattern = "".join(re.escape(literal) + key for literal, key in zip(literals, [*found, ""], strict=True))
    return pattern, [key for key in keys if key not in fixed]


def _ending(path: str | Column, template: str) -> Column:
    column = F.col(path) if isinstance(path, str) else path
    return F.substring_index(column, "/", -(template.count("/") + 1))


def fits(path: str | Column, template: str, **fixed) -> Column:
    """Whether the path's last parts match ``template``."""
    return _ending(path, template).rlike(_segments(template, fixed)[0])


def with_path_params(
    df: DataFrame, template: str, path: str | Column = "file_path", keep_others: bool = False, **fixed
) -> DataFrame:
    """Add one column for each free key of ``template``, matched in the path's last parts.

    ``template`` may span folders, as in ``{channel_id}/{start}_to_{end}.jsonl``. Rows
    whose path does not match are dropped, or get null keys with ``keep_others``.
    """
    pattern, keys = _segments(template, fixed)
    ending = _ending(path, template)
    values = {key: F.regexp_extract(ending, pattern, n) for n, key in enumerate(keys, 1)}
    if keep_others:
        return df.withColumns({key: F.when(ending.rlike(pattern), value) for key, value in values.items()})
    return df.filter(ending.rlike(pattern)).withColumns(values)


def only_modified_since(df: DataFrame, since: Column, column: str = "file_modified") -> DataFrame:
    """Rows from files changed after the target was last saved; all if it never was."""
    return df.filter(F.coalesce(F.col(column) > since, F.lit(True)))


def missing_columns(saved: T.StructType | list[str], schema) -> list[str]:
    """Canonical columns a saved table lacks; if any, the table must be rebuilt."""
    names = saved.fieldNames() if isinstance(saved, T.StructType) else saved
    return [name for name in schema if name not in names]
