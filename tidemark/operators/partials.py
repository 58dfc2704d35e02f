"""Additive daily counters: the state from which any snapshot can be finished.

Every counter is a plain sum keyed by date, so the state of a run is the sum of the counters
of its events in any order and any split. That makes one state serve the full rebuild, the
incremental run and the stream, makes pairs meet across runs, and lets whole days expire.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import default, has_post, named, on_dates
from tidemark.operators.engagement import METRICS_A, fan_out
from tidemark.operators.events import parse_events
from tidemark.vocab import VOCAB_A, Vocabulary

POST_KEYS = ["date", "post_id", "user_id"]
POST_SUMS = [
    "engaged",
    "locks",
    "initiates",
    "shares",
    "reactions",
    "comments",
    "media_clicks",
    "read_mode",
    "dur_sum",
    "dur_n",
]
USER_KEYS = ["date", "user_id"]
USER_SUMS = ["day0_calls", "trials"]


def post_partials(events: DataFrame, vocab: Vocabulary = VOCAB_A) -> DataFrame:
    """Counters per (date, post, user), from one scan and one parse.

    Only locks and initiates need their user; every other event goes to a null user, so a
    post adds one row a day for all of its plain engagement.
    """
    name = F.col("event_name")
    wanted = [
        vocab.locked,
        vocab.shared,
        vocab.reaction,
        vocab.comment,
        vocab.media_click,
        vocab.read_mode,
        vocab.initiate,
    ]
    parsed = parse_events(
        events.filter(named(wanted)), "post_id", "is_locked", "from_post", "duration"
    ).filter(has_post())
    is_lock = (name == vocab.locked) & (F.col("is_locked") == "true")
    is_init = (name == vocab.initiate) & (F.col("from_post") == "true")
    duration = F.when(name == vocab.locked, F.col("duration"))
    return (
        parsed.withColumn("user_id", F.when(is_lock | is_init, F.col("user_id")))
        .groupBy(*POST_KEYS)
        .agg(
            F.count_if(name != vocab.initiate).alias("engaged"),
            F.count_if(is_lock).alias("locks"),
            F.count_if(is_init).alias("initiates"),
            F.count_if(name == vocab.shared).alias("shares"),
            F.count_if(name == vocab.reaction).alias("reactions"),
            F.count_if(name == vocab.comment).alias("comments"),
            F.count_if(name == vocab.media_click).alias("media_clicks"),
            F.count_if(name == vocab.read_mode).alias("read_mode"),
            default(F.sum(duration), 0.0).alias("dur_sum"),
            F.count(duration).alias("dur_n"),
        )
    )


def user_partials(events: DataFrame, vocab: Vocabulary = VOCAB_A) -> DataFrame:
    """Age-0 first calls and trials per (date, user)."""
    name = F.col("event_name")
    parsed = parse_events(events.filter(named([vocab.first_call, vocab.trial])), "user_age")
    is_call = (name == vocab.first_call) & (F.col("user_age") == "0")
    is_trial = name == vocab.trial
    return (
        parsed.filter(is_call | is_trial)
        .groupBy(*USER_KEYS)
        .agg(F.count_if(is_call).alias("day0_calls"), F.count_if(is_trial).alias("trials"))
    )


def merge_partials(keys: list[str], sums: list[str], *parts: DataFrame) -> DataFrame:
    """Sum of counters over any number of partial tables."""
    union = reduce(DataFrame.unionByName, parts)
    return union.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])


def metrics_from_partials(
    by_post: DataFrame,
    by_user: DataFrame,
    since_date: str | None = None,
    day0: DataFrame | None = None,
) -> DataFrame:
    """Engagement and conversions per post, of posts with any engagement.

    ``day0`` replaces the day-0 users found in ``by_user`` (an incremental run looks for
    them over more days than it counts events of).
    """
    pairs = merge_partials(["post_id", "user_id"], POST_SUMS, by_post.filter(on_dates(since_date)))
    users = merge_partials(["user_id"], USER_SUMS, by_user.filter(on_dates(since_date)))
    if day0 is None:
        day0_trials = users.filter(F.col("day0_calls") > 0)
    else:
        day0_trials = day0.select("user_id").join(users, "user_id", "left")
    joined, conversions = fan_out(pairs, day0_trials)
    plain = [F.sum(c).alias(c) for c in POST_SUMS if c not in ("locks", "initiates")]
    totals = joined.groupBy("post_id").agg(
        F.sum(F.col("locks")).alias("views"), *plain, *conversions
    )
    # A post with locks has engagement, so this filter loses no conversions.
    return (
        totals.filter(F.col("engaged") > 0)
        .withColumn("avg_dur", F.col("dur_sum") / F.nullif(F.col("dur_n"), F.lit(0)))
        .select("post_id", *[default(F.col(c), 0.0 if c == "avg_dur" else 0).alias(c) for c in METRICS_A])
    )
