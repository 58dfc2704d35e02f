"""Filters over event, post and place columns.

Predicates on raw columns (``event_name``, ``date``, ``event_time``) reach the Parquet
scan; those on payload columns expect :func:`tidemark.operators.events.parse_events`.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def named(names: str | Iterable[str]) -> Column:
    wanted = [names] if isinstance(names, str) else list(names)
    return F.col("event_name").isin(wanted)


def on_dates(start: str | None = None, end: str | None = None) -> Column:
    condition = F.lit(True)
    if start is not None:
        condition = condition & (F.col("date") >= start)
    if end is not None:
        condition = condition & (F.col("date") <= end)
    return condition


def since(ts: int | None = None) -> Column:
    return F.lit(True) if ts is None else F.col("event_time") >= ts


def before(ts: int | None = None) -> Column:
    return F.lit(True) if ts is None else F.col("event_time") < ts


def is_locked() -> Column:
    return F.col("is_locked") == "true"


def from_post() -> Column:
    return F.col("from_post") == "true"


def age_zero() -> Column:
    return F.col("user_age").try_cast("int") == 0


def has_post() -> Column:
    return F.col("post_id").isNotNull()


def retained(cutoff_ms: int) -> Column:
    return F.coalesce(F.col("created_ts"), F.lit(0)) >= cutoff_ms


def in_window(column: str, lo: int, hi: int | None = None) -> Column:
    """Half-open [lo, hi); open above without ``hi``."""
    condition = F.col(column) >= lo
    return condition if hi is None else condition & (F.col(column) < hi)


def state_known() -> Column:
    return F.col("post_state").isNotNull()


def place_type(kind: str) -> Column:
    return F.col("ty") == kind
