"""Scalar building blocks: Column in, Column out, all inside generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_MS = 86_400_000


def json_str(col: Column | str, path: str) -> Column:
    """Scalar at a JSON path as text; missing, null or malformed gives null."""
    return F.get_json_object(col, path)


def first_present(*cols: Column) -> Column:
    """First alias that is not null."""
    return F.coalesce(*cols)


def first_truthy(a: Column, b: Column, zero) -> Column:
    """``a`` unless it is null or its type's empty value, else whatever ``b`` holds."""
    return F.when(a.isNotNull() & (a != F.lit(zero)), a).otherwise(b)


def safe_cast(col: Column, dtype: str) -> Column:
    """Cast that yields null instead of an ANSI error."""
    return col.try_cast(dtype)


def str_true(col: Column) -> Column:
    return col == F.lit("true")


def title_len(title: Column, stored: Column | None = None) -> Column:
    """Length of the title; a stored length wins where it is given."""
    if stored is None:
        return F.length(title)
    return F.coalesce(stored, F.length(F.coalesce(title, F.lit(""))))


def origin_post(origin: Column) -> Column:
    """Post id of an origin written as ``post_<id>``."""
    return F.substr(origin, F.lit(6))


def floor_div(col: Column, width: int) -> Column:
    """Exact floor(col / width) on 64-bit integers."""
    step = F.lit(width).cast("bigint")
    return F.call_function("div", col - F.pmod(col, step), step)


def ms_to_day(ms: Column, tz: str = "UTC") -> Column:
    """Day text of an epoch-ms instant in ``tz``, whatever the session zone is."""
    if tz == "UTC":
        return F.date_from_unix_date(floor_div(ms, DAY_MS).cast("int")).cast("string")
    utc = F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), (ms / F.lit(1000)).cast("decimal(18,6)")
    )
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), utc).cast("date").cast("string")


def to_epoch_ms(col: Column) -> Column:
    """Epoch-ms of a timestamp, or of ISO-8601 text with an offset."""
    return F.unix_millis(col.try_cast("timestamp"))


def age_hours(run_ts: Column, created_ts: Column) -> Column:
    return (run_ts - created_ts) / F.lit(3_600_000.0)


def ratio_or_null(n: Column, d: Column) -> Column:
    return n.cast("double") / F.nullif(d, F.lit(0))


def ratio_or_zero(n: Column, d: Column) -> Column:
    return F.when(d > 0, n.cast("double") / d).otherwise(F.lit(0.0))


def classified(topic: Column, sub_topic: Column, truthy: bool = False) -> Column:
    present = topic.isNotNull() & sub_topic.isNotNull()
    if truthy:
        present = present & (topic != "") & (sub_topic != "")
    return flag01(present)


def has_media(flag: Column, duration: Column) -> Column:
    return F.coalesce(flag, F.lit(False)) | duration.isNotNull()


def default(col: Column, value) -> Column:
    return F.coalesce(col, F.lit(value))


def label_y(trial: Column, initiate: Column) -> Column:
    """2 for a trial, 1 for an initiated transaction, else 0."""
    return F.when(trial, 2).when(initiate, 1).otherwise(0)


def flag01(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


def pct(n: Column, total: Column) -> Column:
    return F.round(F.lit(100.0) * n / total, 2)


def minutes_between(later_ms: Column, earlier_ms: Column) -> Column:
    """Whole minutes between two epoch-ms instants, truncated toward zero."""
    return ((later_ms - earlier_ms) / F.lit(60_000.0)).cast("bigint")
