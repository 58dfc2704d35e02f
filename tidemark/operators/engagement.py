"""Engagement, social and conversion counts per post."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import (
    age_zero,
    before,
    default,
    has_post,
    named,
    on_dates,
    run_params,
    shift_day,
    since,
)
from tidemark.functions.dates import FEED_TZ
from tidemark.operators.events import in_posts, parse_events, trials
from tidemark.vocab import VOCAB_A, VOCAB_B, Vocabulary

METRICS_A = [
    "views",
    "shares",
    "reactions",
    "comments",
    "media_clicks",
    "read_mode",
    "avg_dur",
    "locks",
    "initiates",
    "trials",
    "day0_locks",
    "day0_initiates",
    "day0_trials",
]


def _name(name: str):
    return F.col("event_name") == name


def engagement_a(
    events: DataFrame,
    posts: DataFrame | None = None,
    since_date: str | None = None,
    since_ts: int | None = None,
    vocab: Vocabulary = VOCAB_A,
) -> DataFrame:
    """Six conditional counts and the mean duration of feed views that carry one."""
    wanted = [
        vocab.locked,
        vocab.shared,
        vocab.reaction,
        vocab.comment,
        vocab.media_click,
        vocab.read_mode,
    ]
    scanned = events.filter(named(wanted) & on_dates(since_date) & since(since_ts))
    parsed = parse_events(scanned, "post_id", "is_locked", "duration").filter(has_post())
    counts = parsed.groupBy("post_id").agg(
        F.count_if(_name(vocab.locked) & (F.col("is_locked") == "true")).alias("views"),
        F.count_if(_name(vocab.shared)).alias("shares"),
        F.count_if(_name(vocab.reaction)).alias("reactions"),
        F.count_if(_name(vocab.comment)).alias("comments"),
        F.count_if(_name(vocab.media_click)).alias("media_clicks"),
        F.count_if(_name(vocab.read_mode)).alias("read_mode"),
        F.avg(F.when(_name(vocab.locked), F.col("duration"))).alias("avg_dur"),
    )
    return counts if posts is None else in_posts(counts, posts)


def _since_days(run_ts: int, days: int, tz: str) -> str:
    return shift_day(run_params(run_ts, tz).date, -days)


def engagement_b(
    events: DataFrame, run_ts: int, tz: str = FEED_TZ, vocab: Vocabulary = VOCAB_B
) -> DataFrame:
    """Views, clicks and mean times from post-seen events of the last day."""
    scanned = events.filter(
        named(vocab.seen) & on_dates(_since_days(run_ts, 1, tz)) & before(run_ts)
    )
    parsed = parse_events(
        scanned, "post_id", "media_clicked", "read_mode_open", "screen_time", "max_listen"
    ).filter(has_post())
    return parsed.groupBy("post_id").agg(
        F.count(F.lit(1)).alias("views"),
        F.count_if(F.col("media_clicked") == "true").alias("mediaClickedCount"),
        F.count_if(F.col("read_mode_open") == "true").alias("readModeCount"),
        F.avg("screen_time").alias("avgDur"),
        F.avg("max_listen").alias("listenpct"),
    )


def social_b(
    events: DataFrame, run_ts: int, tz: str = FEED_TZ, vocab: Vocabulary = VOCAB_B
) -> DataFrame:
    """Shares, reactions and comments of the last day."""
    scanned = events.filter(
        named([vocab.shared, vocab.reaction, vocab.comment])
        & on_dates(_since_days(run_ts, 1, tz))
        & before(run_ts)
    )
    parsed = parse_events(scanned, "post_id").filter(has_post())
    return parsed.groupBy("post_id").agg(
        F.count_if(_name(vocab.shared)).alias("shareCount"),
        F.count_if(_name(vocab.reaction)).alias("reactionCount"),
        F.count_if(_name(vocab.comment)).alias("commentCount"),
    )


def metrics_b(
    events: DataFrame, run_ts: int, tz: str = FEED_TZ, vocab: Vocabulary = VOCAB_B
) -> DataFrame:
    """The three variant B counts from one scan, one parse and one shuffle.

    Only conversions reach back further than a day.
    """
    kinds = {"locks": vocab.locked, "initiates": vocab.initiate, "trials": vocab.trial}
    daily = [vocab.seen, vocab.shared, vocab.reaction, vocab.comment]
    last_day = on_dates(_since_days(run_ts, 1, tz))
    scanned = events.filter(
        on_dates(_since_days(run_ts, 7, tz))
        & before(run_ts)
        & (named(kinds.values()) | (named(daily) & last_day))
    )
    parsed = parse_events(
        scanned, "post_id", "user_age", "media_clicked", "read_mode_open", "screen_time", "max_listen"
    ).filter(has_post())
    seen = _name(vocab.seen)
    return parsed.groupBy("post_id").agg(
        F.count_if(seen).alias("views"),
        F.count_if(seen & (F.col("media_clicked") == "true")).alias("mediaClickedCount"),
        F.count_if(seen & (F.col("read_mode_open") == "true")).alias("readModeCount"),
        F.avg(F.when(seen, F.col("screen_time"))).alias("avgDur"),
        F.avg(F.when(seen, F.col("max_listen"))).alias("listenpct"),
        F.count_if(_name(vocab.shared)).alias("shareCount"),
        F.count_if(_name(vocab.reaction)).alias("reactionCount"),
        F.count_if(_name(vocab.comment)).alias("commentCount"),
        *[F.count_if(_name(n)).alias(f"post_{kind}_so_far") for kind, n in kinds.items()],
        *[F.count_if(_name(n) & age_zero()).alias(f"post_day0_{k}") for k, n in kinds.items()],
    )


def conversions_b(
    events: DataFrame, run_ts: int, tz: str = FEED_TZ, vocab: Vocabulary = VOCAB_B
) -> DataFrame:
    """Locks, initiates and trials of the last seven days, and those by age-0 users."""
    kinds = {"locks": vocab.locked, "initiates": vocab.initiate, "trials": vocab.trial}
    scanned = events.filter(
        named(kinds.values()) & on_dates(_since_days(run_ts, 7, tz)) & before(run_ts)
    )
    parsed = parse_events(scanned, "post_id", "user_age").filter(has_post())
    return parsed.groupBy("post_id").agg(
        *[F.count_if(_name(n)).alias(f"post_{kind}_so_far") for kind, n in kinds.items()],
        *[F.count_if(_name(n) & age_zero()).alias(f"post_day0_{k}") for k, n in kinds.items()],
    )


def fan_out(
    pairs: DataFrame, day0: DataFrame, dedup: bool = False
) -> tuple[DataFrame, list[Column]]:
    """Pairs with their user's trials, and the per-post sums that count conversions.

    ``pairs`` holds ``locks`` and ``initiates`` per (post_id, user_id) and ``day0`` holds
    ``trials`` per day-0 user. The sums are the counts of joining every lock to every
    initiate of its pair and every trial of its user; they follow from products of the
    group counts, so no such join is run. ``dedup`` counts each lock once instead.

    A user has at most one pair a post, so the join is plain: users lie by their id already
    and are not copied.
    """
    marks = day0.select("user_id", F.lit(1).alias("is_day0"), F.col("trials").alias("_t"))
    joined = pairs.join(marks, "user_id", "left")
    lock = F.col("locks")
    # A null user matches nothing, as in a join.
    n_init = F.when(F.col("user_id").isNotNull(), F.col("initiates")).otherwise(0)
    n_trial = default(F.col("_t"), 0)
    if dedup:
        init = lock * F.least(n_init, F.lit(1))
        trial = lock * F.least(n_trial, F.lit(1))
    else:
        i1, t1 = F.greatest(n_init, F.lit(1)), F.greatest(n_trial, F.lit(1))
        lock, init, trial = lock * i1 * t1, lock * n_init * t1, lock * i1 * n_trial
    is_day0 = default(F.col("is_day0"), 0)
    counts = {"locks": lock, "initiates": init, "trials": trial}
    return joined, [
        *[F.sum(n).alias(kind) for kind, n in counts.items()],
        *[F.sum(n * is_day0).alias(f"day0_{kind}") for kind, n in counts.items()],
    ]


def conversions_a(
    events: DataFrame,
    posts: DataFrame | None,
    day0: DataFrame,
    since_date: str | None = None,
    since_ts: int | None = None,
    dedup: bool = False,
    vocab: Vocabulary = VOCAB_A,
) -> DataFrame:
    """Locks with their initiates (same post and user) and trials (same user, day-0 only)."""
    scanned = events.filter(on_dates(since_date) & since(since_ts))
    kinds = parse_events(
        scanned.filter(named([vocab.locked, vocab.initiate])), "post_id", "is_locked", "from_post"
    )
    is_lock = _name(vocab.locked) & (F.col("is_locked") == "true")
    is_init = _name(vocab.initiate) & (F.col("from_post") == "true")
    pairs = (
        kinds.filter(has_post() & (is_lock | is_init))
        .groupBy("post_id", "user_id")
        .agg(F.count_if(is_lock).alias("locks"), F.count_if(is_init).alias("initiates"))
    )
    if posts is not None:
        pairs = in_posts(pairs, posts)
    per_user = trials(scanned, vocab).groupBy("user_id").agg(F.count(F.lit(1)).alias("trials"))
    marked = day0.select("user_id").join(per_user, "user_id", "left")
    joined, sums = fan_out(pairs, marked, dedup)
    return joined.filter(F.col("locks") > 0).groupBy("post_id").agg(*sums)


def post_metrics(engagement: DataFrame, conversions: DataFrame) -> DataFrame:
    """Engagement and conversions of a post side by side; what is missing counts as 0."""
    joined = engagement.join(conversions, "post_id", "full")
    return joined.select(
        "post_id",
        *[
            default(F.col(name), 0.0 if name == "avg_dur" else 0).alias(name)
            for name in METRICS_A
        ],
    )

