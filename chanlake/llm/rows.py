"""A name for a row that does not rest on its id alone: ids may be absent or come twice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chanlake.operators.skew import global_rank


def row_digest(*columns: str) -> Column:
    """64 bits of the values, nulls told from empty texts: rows that are equal in them share it."""
    return F.xxhash64(*(part for c in columns for part in (F.col(c).isNull(), F.col(c))))


def numbered(docs: DataFrame, name: str, id_column: str = "doc_id") -> DataFrame:
    """``docs``, written once, with a number of its own for each row: 1, 2, ... by id (null last), then
    by a digest of the text. Equal rows are told apart, in no fixed order."""
    order = {"_late": F.col(id_column).isNull(), "_of_text": F.xxhash64("text")}
    keyed = docs.select(F.struct(*docs.columns).alias("_row"), F.col(id_column).alias("_id"), *(c.alias(n) for n, c in order.items()))
    ranked = global_rank(keyed, ["_late", "_id", "_of_text"], "_rank")
    return ranked.select(*(F.col("_row").getField(c).alias(c) for c in docs.columns), F.col("_rank").alias(name))
