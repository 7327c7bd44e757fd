"""What a job with Python tasks needs: the package on the workers, result schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from chanlake.session import ship_package

BATCH_ROWS = 1000


def ship(spark: SparkSession) -> SparkSession:
    """Give Python tasks this package and set the rows of their batches."""
    # whole texts: smaller batches, as memory goes with the bytes of a batch
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return ship_package(spark)


def extended(df: DataFrame, **fields: str) -> StructType:
    """The schema of ``df`` with more fields, given as name and DDL type."""
    more = StructType.fromDDL(", ".join(f"{name} {kind}" for name, kind in fields.items()))
    return StructType([*df.schema.fields, *more.fields])
