"""Run and window bounds, worked out once on the driver and used as literals."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timedelta
from zoneinfo import ZoneInfo

FEED_TZ = "Asia/Kolkata"


def day_ms(day: str, tz: str = FEED_TZ) -> int:
    """Epoch-ms of the start of ``day`` in ``tz``."""
    return int(datetime.fromisoformat(day).replace(tzinfo=ZoneInfo(tz)).timestamp() * 1000)


def shift_day(day: str, days: int) -> str:
    return (date.fromisoformat(day) + timedelta(days=days)).isoformat()


def dates_between(start: str, end: str) -> list[str]:
    days = [start]
    while days[-1] < end:
        days.append(shift_day(days[-1], 1))
    return days


@dataclass(frozen=True)
class WindowBounds:
    """Current window [ref-7d, ..) and prior window [ref-14d, ref-7d)."""

    window_start: int
    prior_start: int
    prior_end: int
    first_date: str
    last_date: str


def window_bounds(ref: str, tz: str = FEED_TZ, days: int = 7) -> WindowBounds:
    start = day_ms(shift_day(ref, -days), tz)
    return WindowBounds(
        window_start=start,
        prior_start=day_ms(shift_day(ref, -2 * days), tz),
        prior_end=start,
        first_date=shift_day(ref, -2 * days),
        last_date=ref,
    )


@dataclass(frozen=True)
class RunParams:
    run_ts: int
    date: str
    slot: str
    iso: str


def run_params(run_ts: int, tz: str = FEED_TZ) -> RunParams:
    """Partition date, HHMM slot and ISO text of a run in its home zone."""
    at = datetime.fromtimestamp(run_ts / 1000, ZoneInfo(tz))
    return RunParams(run_ts, at.strftime("%Y-%m-%d"), at.strftime("%H%M"), at.isoformat())
