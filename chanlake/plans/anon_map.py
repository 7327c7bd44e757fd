"""Merging per-channel pseudonym maps into one checked table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chanlake.operators.pseudonyms import (
    duplicate_hashes,
    merge_anon_maps,
    merge_maps_last_wins,
    verify_pseudonyms,
)
from chanlake.schemas import ANON_MAP
from chanlake.session import stages
from chanlake.sources.lists import scan_anon_maps
from chanlake.sources.manifest import list_files, new_files, paths_to_read, remember
from chanlake.sources.tables import latest_version, scan_table, write_version


@dataclass(frozen=True)
class MapReport:
    path: str
    duplicated_rows: int
    mismatches: DataFrame


def merge_map_files(
    spark: SparkSession,
    maps: str,
    table: str,
    version: str,
    key: str | bytes | None = None,
    modified_after: str | None = None,
) -> MapReport:
    """Merge the map files that the manifest (``<table>-files``) lacks into a new version; of these
    only files newer than ``modified_after``, if that is given.

    A file counts whenever it arrives, also with an old time; the manifest is extended last, so a
    lost run is repeated, and merging twice changes nothing. Rows with a wrong hash and hashes
    that stand for several originals are reported.
    """
    manifest = f"{table.rstrip('/')}-files"
    current = latest_version(spark, table)
    old = scan_table(spark, current, ANON_MAP) if current else None
    with stages(spark) as stage:
        listing = list_files(spark, maps, "*")
        if modified_after:
            listing = listing.filter(F.col("modified") > F.to_timestamp(F.lit(modified_after)))
        files = stage(listing if old is None else new_files(listing, manifest), "files")
        new = merge_maps_last_wins(scan_anon_maps(spark, paths_to_read(files)))
        path = write_version(stage(merge_anon_maps(old, new), "anon-map"), table, version)
        remember(new_files(files, manifest), manifest)
    merged = scan_table(spark, path, ANON_MAP)
    duplicated = duplicate_hashes(merged).select(F.col("rows").cast("bigint")).first()[0]
    return MapReport(path, duplicated, verify_pseudonyms(merged, key))
