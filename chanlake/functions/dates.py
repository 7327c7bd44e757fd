"""Time bins and ISO timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

COLLECTION_LAG_DAYS = 30  # views and forwards have settled by then
OBSERVATION_DAYS = 14
MICROS_PER_DAY = 86_400_000_000


def collection_cutoff(now: Column) -> Column:
    return now - F.expr(f"INTERVAL {COLLECTION_LAG_DAYS} DAYS")


def _bins(start: Column, end: Column, step: str) -> Column:
    """Consecutive bins of one step from ``start``; one that ends after ``end`` is left out."""
    width = F.expr(f"INTERVAL {step}")
    edges = F.when(start <= end, F.sequence(start, end, width))
    bins = F.transform(edges, lambda at: F.struct(at.alias("start"), (at + width).alias("end")))
    return F.coalesce(
        F.filter(bins, lambda b: b["end"] <= end),
        F.array().cast("array<struct<start:timestamp,end:timestamp>>"),
    )


def month_bins(created: Column, cutoff: Column) -> Column:
    """Whole months from the month of ``created`` up to the cutoff."""
    return _bins(F.date_trunc("month", created).cast("timestamp"), cutoff, "1 MONTH")


def hour_bins(now: Column, days: int = OBSERVATION_DAYS) -> Column:
    """Hourly bins over ``days``, the first one starting an hour before ``now``."""
    first = now - F.expr("INTERVAL 1 HOUR")
    return _bins(first, now + F.expr(f"INTERVAL {days} DAYS"), "1 HOUR")


def period_name(bin_: Column) -> Column:
    """The name of a bin's file, without the suffix."""
    day = "yyyy-MM-dd"
    return F.concat(
        F.date_format(bin_["start"], day), F.lit("_to_"), F.date_format(bin_["end"], day)
    )


def days_since(date: Column, now: Column) -> Column:
    """Whole days from ``date`` to ``now``, rounded down also when negative."""
    return F.floor((F.unix_micros(now) - F.unix_micros(date)) / F.lit(MICROS_PER_DAY))


def parse_iso(text: Column) -> Column:
    return F.try_to_timestamp(text)


def format_iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
