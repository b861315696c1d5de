"""Retry rules as columns. Nothing here waits: the delay only says when a row is due."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.config import TRANSIENT_ERROR_CODES, RetryPolicy

DEFAULT = RetryPolicy()


def backoff_ms(attempt: Column, policy: RetryPolicy = DEFAULT) -> Column:
    """Delay after the given attempt (1, 2, ...). Capped first, so no cast can overflow."""
    grown = policy.initial_delay_ms * F.pow(F.lit(policy.multiplier), attempt - 1)
    return F.least(F.lit(float(policy.max_delay_ms)), grown).cast("int")


def next_attempt_at(failed_at: Column, attempt: Column, policy: RetryPolicy = DEFAULT) -> Column:
    return F.timestamp_millis(F.unix_millis(failed_at) + backoff_ms(attempt, policy))


def is_transient(code: Column, fatal: Column) -> Column:
    return (~fatal) & code.isin(*TRANSIENT_ERROR_CODES)


def claimed_retry_count(status: Column, retry_count: Column) -> Column:
    """A claim counts as a retry only for a row that had failed."""
    return F.when(status == "FAILED", retry_count + 1).otherwise(retry_count)
