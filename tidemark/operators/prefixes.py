"""Counts at rest for leave-one-out features: a view of a date needs that date's events and a few tables, not history.

Counts per (post, user) and per post are kept in blocks of dates. The k-th date since the first ends a block of as many dates as
the lowest set bit of k says (1, 2, 1, 4, 1, 2, 1, 8, ...), so all dates up to any one are the sum of at most ``log2(dates) + 1``
blocks, and a date's counts are written as many times, however long the history is. Within the date of a view, running sums go over
minutes and within a minute (:func:`tidemark.operators.leakage.counts_before`); no window holds more than the minutes of the days asked for.

A date is the UTC day of the event's time. The folders of the log before and after it are read as well, so that events filed a day off count.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date as calendar

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import day_ms, ms_to_day, on_dates, shift_day
from tidemark.operators.leakage import before_last, default_measures, marks_of, others_before, probes_of
from tidemark.vocab import VOCAB_A, Vocabulary

KEYS = {"by_user": ["post_id", "user_id"], "by_post": ["post_id"]}


def _place(date: str, since: str) -> int:
    return (calendar.fromisoformat(date) - calendar.fromisoformat(since)).days + 1


def blocks_up_to(date: str, since: str) -> list[str]:
    """Last dates of the blocks that together hold ``since`` to ``date``; none if ``date`` is before."""
    k, out = _place(date, since), []
    while k > 0:
        out.append(shift_day(since, k - 1))
        k &= k - 1
    return out


def blocks_with(date: str, since: str, first: str, last: str) -> list[str]:
    """Last dates, from ``first`` to ``last``, of the blocks that hold a date."""
    k, end, out = _place(date, since), _place(last, since), []
    while k <= end:
        out.append(shift_day(since, k - 1))
        k += k & -k
    return [d for d in out if d >= first]


def table_schema(table: str, measures: Mapping[str, Column] | None = None, vocab: Vocabulary = VOCAB_A) -> str:
    names = list(measures or default_measures(vocab))
    return ", ".join([f"{k} string" for k in KEYS[table]] + [f"{n} bigint" for n in names] + ["date string"])


def daily_counts(
    events: DataFrame, first: str, last: str, measures: Mapping[str, Column] | None = None, vocab: Vocabulary = VOCAB_A
) -> DataFrame:
    """Counts per (post, user) and UTC day of the event, of a range of days."""
    start, end = day_ms(first, "UTC"), day_ms(shift_day(last, 1), "UTC")
    filed = events.filter(on_dates(shift_day(first, -1), shift_day(last, 1)))
    of_days = filed.filter((F.col("event_time") >= start) & (F.col("event_time") < end))
    return marks_of(of_days, measures, vocab, ms_to_day(F.col("event_time"), "UTC"), "date")


def blocks(new: DataFrame, stored: DataFrame, keys: list[str], since: str, first: str, last: str) -> DataFrame:
    """The blocks that end from ``first`` to ``last``, from the counts of these dates and the stored blocks of all
    dates before them (those of ``blocks_up_to``)."""
    names = [c for c in new.columns if c not in ("post_id", "user_id", "date")]
    place = range(_place(first, since), _place(last, since) + 1)
    own = {shift_day(since, k - 1) for k in place} | set(blocks_up_to(shift_day(first, -1), since))
    held = [F.lit(x) for d in sorted(own) for x in (d, blocks_with(d, since, first, last))]
    rows = new.select(*keys, *names, "date").unionByName(stored.select(*keys, *names, "date"))
    ends = F.explode(F.element_at(F.create_map(*held), F.col("date"))).alias("date")
    return rows.select(*keys, *names, ends).groupBy(*keys, "date").agg(*[F.sum(n).alias(n) for n in names])


def loo_counts_on(
    views: DataFrame,
    events: DataFrame,
    before: Mapping[str, DataFrame],
    date: str,
    last: str | None = None,
    measures: Mapping[str, Column] | None = None,
    vocab: Vocabulary = VOCAB_A,
) -> DataFrame:
    """:func:`tidemark.operators.leakage.loo_counts` of the views of one UTC day, or of the days from ``date`` to ``last``.

    ``before`` holds, by table, the blocks of all dates before. Their rows count from the last millisecond before ``date`` on,
    and only those of keys with a view are taken along.
    """
    last = last or date
    start, end = day_ms(date, "UTC"), day_ms(shift_day(last, 1), "UTC")
    names = list(measures or default_measures(vocab))
    of_day = lambda df: df.filter((F.col("t") >= start) & (F.col("t") < end))
    marks = of_day(marks_of(events.filter(on_dates(shift_day(date, -1), shift_day(last, 1))), measures, vocab))
    probes = of_day(probes_of(views))
    with_history = {}
    for table, keys in KEYS.items():
        history = before[table].select(*keys, F.lit(start - 1).cast("bigint").alias("t"), *names)
        if table == "by_post":  # by_user's is cut to pairs with a view by others_before, together with the marks
            history = before_last(history, probes, keys)
        with_history[table] = marks.select(*keys, "t", *names).unionByName(history)
    return others_before(with_history["by_user"], with_history["by_post"], probes, names)
