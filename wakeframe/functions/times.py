"""Instants as text and run names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def iso_text(ts: Column) -> Column:
    """ISO 8601 text in the session's time zone (UTC by setting)."""
    return F.date_format(ts.cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")


def run_name(prefix: str, ts: Column) -> Column:
    """``<prefix>__20240131T235959``."""
    return F.concat(F.lit(f"{prefix}__"), F.date_format(ts.cast("timestamp"), "yyyyMMdd'T'HHmmss"))


def report_name(prefix: str, ts: Column) -> Column:
    """``<prefix>_20240131_235959.json``."""
    return F.concat(F.lit(f"{prefix}_"), F.date_format(ts.cast("timestamp"), "yyyyMMdd_HHmmss"), F.lit(".json"))
