"""Extra columns taken through an operator, whatever their names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REST = "_rest"


def carried(df: DataFrame, *needed: str) -> DataFrame:
    """The needed columns and all others in one: no name clashes with an operator's own."""
    others = [c for c in df.columns if c not in needed]
    return df.select(*needed, *([F.struct(*others).alias(REST)] if others else []))


def restored(rows: DataFrame, df: DataFrame, *needed: str, added: tuple[str, ...] = ()) -> DataFrame:
    """The columns of ``df`` with their own values, and those that were added."""
    own = [F.col(c) if c in needed else F.col(REST).getField(c).alias(c) for c in df.columns]
    return rows.select(*own, *added)
