"""Instants as epoch milliseconds and as ISO-8601 text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.config import WINDOW_SIZES, WINDOW_UNITS


def millis(instant: Column) -> Column:
    return F.unix_millis(instant)


def from_millis(value: Column) -> Column:
    return F.timestamp_millis(value)


def iso_text(instant: Column) -> Column:
    """UTC text with seven fraction digits; the last one is always 0 (Spark keeps micros)."""
    return F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'0Z'")


def parse_iso(text: Column) -> Column:
    """Instant or null when the text is not a time. A seventh fraction digit is dropped."""
    return text.try_cast("timestamp")


def as_instant(value: Column) -> Column:
    """Zone-less table time read as UTC (the session zone is UTC)."""
    return value.cast("timestamp")


def window_start(instant: Column, size: str) -> Column:
    """Start of the tumbling window the instant falls in."""
    return F.date_trunc(WINDOW_UNITS[size], instant)


def window_step(size: str) -> Column:
    return F.expr(f"interval {WINDOW_SIZES[size]}")
