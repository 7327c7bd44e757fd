"""Small side files: pseudonym maps, seeds, keyword lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

from chanlake.sources.manifest import escaped


_FILE = ("file_path", "file_modified")


def _reader(spark: SparkSession, modified_after: str | None) -> DataFrameReader:
    reader = spark.read.option("recursiveFileLookup", True)
    return reader.option("modifiedAfter", modified_after) if modified_after else reader


def _text(reader: DataFrameReader, path: str | list[str], wholetext: bool = False) -> DataFrame:
    return reader.text(path, wholetext=wholetext).select(
        "value",
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_modification_time").alias("file_modified"),
    )


def _map_entries(
    spark: SparkSession, path: str | list[str], kind: str, strings: bool, modified_after: str | None = None
) -> DataFrame:
    """``file_path, file_modified, key, value`` of JSON maps, of which one may be many tasks' work.

    A map is read in pieces between the end of a value and the next key, so that Spark can split
    its file. A separator inside a key or value leaves a first half that is no JSON; a file with
    such a piece, or without one beginning and one end, is read as a whole instead. What is no JSON
    object even then gives no rows.
    """
    if not path:
        return spark.createDataFrame([], f"file_path string, file_modified timestamp, key string, value {kind}")
    separator, closing = ('",', '"') if strings else (",", "")
    last = r'(^\{|"|null|true|false|[0-9])\s*\}\s*$' if strings else r"\}\s*$"
    text = F.regexp_replace("value", r"^\s+", "")  # what ends a piece may belong to a value
    first, end = F.startswith(text, F.lit("{")), text.rlike(last)
    body = F.regexp_replace(text, r"^\{", "")
    body = F.when(end, F.regexp_replace(body, r"\}\s*$", "")).otherwise(F.concat(body, F.lit(closing)))
    whole = F.concat(F.lit("{"), body, F.lit("}"))
    entries = F.from_json(whole, f"map<string,{kind}>")
    pieces = _text(_reader(spark, modified_after).option("lineSep", separator), path)
    blank = text == ""
    marked = pieces.select(*_FILE, entries.alias("entries"), first.alias("first"), end.alias("end"), blank.alias("blank"))
    # A blank piece is what follows the last separator of a file: nothing, or a lost end.
    broken = F.col("entries").isNull() & ~F.col("blank")
    odd = (F.count_if("first") != 1) | (F.count_if("end") != 1) | (F.count_if(broken) > 0)
    verdict = marked.groupBy("file_path").agg(odd.alias("odd"))
    whole_paths = [escaped(row.file_path) for row in verdict.filter("odd").select("file_path").collect()]
    read = marked.join(verdict.filter("odd"), "file_path", "left_anti") if whole_paths else marked
    found = read.select(*_FILE, F.explode("entries"))
    if not whole_paths:
        return found
    rest = _text(_reader(spark, None), whole_paths, wholetext=True)
    return found.unionByName(rest.select(*_FILE, F.explode(F.from_json("value", f"map<string,{kind}>"))))


def scan_anon_maps(
    spark: SparkSession, path: str | list[str], modified_after: str | None = None
) -> DataFrame:
    """``original, hash`` rows of all JSON maps below ``path``, or of those listed, with their file."""
    return _map_entries(spark, path, "string", True, modified_after).select(
        *_FILE, F.col("key").alias("original"), F.col("value").alias("hash")
    )


def scan_seeds(spark: SparkSession, path: str) -> DataFrame:
    """``channel_id, access_hash`` rows of a JSON map."""
    return _map_entries(spark, path, "bigint", False).select(
        F.col("key").alias("channel_id"), F.col("value").alias("access_hash")
    )


def scan_keywords(spark: SparkSession, path: str) -> DataFrame:
    """Distinct keywords, one per line."""
    return (
        spark.read.text(path)
        .select(F.rtrim(F.col("value")).alias("keyword"))
        .filter(F.col("keyword") != "")
        .distinct()
    )
