"""Daily feature tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import on_dates, window_bounds
from tidemark.functions.dates import FEED_TZ
from tidemark.operators.creators import creator_features, creator_features_of
from tidemark.operators.ecosystem import eco_district, eco_lang, eco_state
from tidemark.operators.events import initiates, locks
from tidemark.operators.sliding import advance_seen, advance_totals, as_locks, prior_counts, seen_over, totals_over
from tidemark.vocab import VOCAB_A, Vocabulary


def daily_features(
    posts: DataFrame,
    events: DataFrame,
    mapping: DataFrame,
    ref: str,
    tz: str = FEED_TZ,
    profile: DataFrame | None = None,
    by: str = "post_id",
    vocab: Vocabulary = VOCAB_A,
) -> dict[str, DataFrame]:
    """District, state, language and creator tables of a reference date.

    Reads events of the current and prior windows. ``by`` attributes initiates by post id
    or by origin.
    """
    bounds = window_bounds(ref, tz)
    recent = events.filter(on_dates(bounds.first_date, bounds.last_date))
    locked = locks(recent, vocab)
    started = initiates(recent, by, vocab)
    return {
        "eco_district": eco_district(posts, locked, ref, tz),
        "eco_state": eco_state(posts, mapping, ref, tz),
        "eco_lang": eco_lang(posts, ref, tz),
        "creator": creator_features(posts, locked, started, ref, tz, profile),
    }


def advance_sliding(
    seen: DataFrame, totals: DataFrame, events: DataFrame, date: str, tz: str = FEED_TZ, by: str = "post_id",
    vocab: Vocabulary = VOCAB_A,
) -> tuple[DataFrame, DataFrame]:
    """The sliding tables of a date from those of the date before and the events of the date."""
    locked, started = locks(events, vocab), initiates(events, by, vocab)
    return advance_seen(seen, locked, date, tz), advance_totals(totals, locked, started, date, tz)


def advance_sliding_over(
    seen: DataFrame, totals: DataFrame, events: DataFrame, first: str, last: str, tz: str = FEED_TZ, by: str = "post_id",
    vocab: Vocabulary = VOCAB_A,
) -> tuple[DataFrame, DataFrame]:
    """The sliding tables of every date of a range, from those of the date before it and the events of the range."""
    locked, started = locks(events, vocab), initiates(events, by, vocab)
    return seen_over(seen, locked, first, last, tz), totals_over(totals, locked, started, first, last, tz)


def daily_features_sliding(
    posts: DataFrame, seen: DataFrame, totals: DataFrame, mapping: DataFrame, ref: str, tz: str = FEED_TZ
) -> dict[str, DataFrame]:
    """What :func:`daily_features` gives, from the sliding tables up to the reference date; no events are read."""
    counts = prior_counts(totals, ref, tz)
    viewed, started = counts.filter("_views > 0"), counts.filter("_initiates > 0")
    return {
        "eco_district": eco_district(posts, as_locks(seen.filter(F.col("date") == ref)), ref, tz),
        "eco_state": eco_state(posts, mapping, ref, tz),
        "eco_lang": eco_lang(posts, ref, tz),
        "creator": creator_features_of(
            posts, viewed.select("post_id", "_views", "_locks"), started.select("post_id", "_initiates"), ref, tz
        ),
    }
