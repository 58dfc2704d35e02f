"""Whole snapshot runs: full, incremental, from state, and the stateless variant."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import (
    age_hours,
    before,
    classified,
    default,
    on_dates,
    ratio_or_zero,
    run_params,
    shift_day,
    since,
)
from tidemark.functions.dates import FEED_TZ
from tidemark.functions.scalars import DAY_MS
from tidemark.operators.engagement import metrics_b
from tidemark.operators.events import in_posts
from tidemark.operators.partials import (
    POST_KEYS,
    POST_SUMS,
    USER_KEYS,
    USER_SUMS,
    merge_partials,
    metrics_from_partials,
    post_partials,
    user_partials,
)
from tidemark.operators.posts import merge_posts, with_state
from tidemark.vocab import VOCAB_A, VOCAB_B, Vocabulary

# snapshot column -> metric of post_metrics
COUNTERS = {
    "views": "views",
    "shareCount": "shares",
    "mediaClickedCount": "media_clicks",
    "reactionCount": "reactions",
    "commentCount": "comments",
    "readModeCount": "read_mode",
    "post_locks_so_far": "locks",
    "post_initiates_so_far": "initiates",
    "post_trials_so_far": "trials",
    "post_day0_locks": "day0_locks",
    "post_day0_initiates": "day0_initiates",
    "post_day0_trials": "day0_trials",
}


def with_rates(df: DataFrame, variant: str = "a") -> DataFrame:
    """Day-0 conversion rates; per view means per day-0 lock in variant A."""
    per_view = F.col("post_day0_locks" if variant == "a" else "views")
    initiates, trials = F.col("post_day0_initiates"), F.col("post_day0_trials")
    return df.select(
        "*",
        ratio_or_zero(initiates, per_view).alias("post_day0_initiates_per_view"),
        ratio_or_zero(trials, per_view).alias("post_day0_trials_per_view"),
        ratio_or_zero(initiates, F.col("post_day0_locks")).alias("post_day0_initiates_per_lock"),
    )


def _finish(rows: DataFrame, run_ts: int, mapping: DataFrame) -> DataFrame:
    located = with_state(rows, mapping)
    complete = located.select(
        "*", F.lit(run_ts).cast("bigint").alias("run_ts"), F.lit(0.0).alias("listenpct")
    )
    return with_rates(complete, "a").select(*schemas.SNAPSHOT_COLUMNS)


def assemble_a(posts: DataFrame, metrics: DataFrame, run_ts: int, mapping: DataFrame) -> DataFrame:
    """Posts with their metrics, state and rates: the 34 snapshot columns."""
    counts = metrics.select(
        "post_id", F.col("avg_dur").alias("avgDur"), *[F.col(m).alias(c) for c, m in COUNTERS.items()]
    )
    rows = posts.join(counts, "post_id", "left").fillna(0, subset=[*COUNTERS, "avgDur"])
    return _finish(rows, run_ts, mapping)


def window_events(
    events: DataFrame, run_ts: int, days: int = 7, tz: str = FEED_TZ
) -> DataFrame:
    """Events dated within the window and before the run."""
    run_date = run_params(run_ts, tz).date
    return events.filter(on_dates(shift_day(run_date, -days)) & before(run_ts))


def full_metrics(events: DataFrame, vocab: Vocabulary = VOCAB_A) -> DataFrame:
    return metrics_from_partials(post_partials(events, vocab), user_partials(events, vocab))


def snapshot_full(
    events: DataFrame,
    posts: DataFrame,
    run_ts: int,
    mapping: DataFrame,
    days: int = 7,
    tz: str = FEED_TZ,
    vocab: Vocabulary = VOCAB_A,
) -> DataFrame:
    """Cold start: all counts from the events of the window."""
    seen = window_events(events, run_ts, days, tz)
    return assemble_a(posts, full_metrics(seen, vocab), run_ts, mapping)


def snapshot_incremental(
    previous: DataFrame,
    today: DataFrame,
    events: DataFrame,
    run_ts: int,
    prev_run_ts: int,
    mapping: DataFrame,
    days: int = 7,
    tz: str = FEED_TZ,
    vocab: Vocabulary = VOCAB_A,
) -> DataFrame:
    """Previous snapshot plus the delta [prev_run_ts, run_ts); new posts get their full counts.

    The twelve counters add up. The mean duration is that of the delta where the post has
    any, else the previous one. Conversions pair only within the delta, as a sum of
    snapshots cannot know the users of earlier locks, and counts of days past the window stay;
    :func:`snapshot_advanced` is exact in both.
    """
    first_date = shift_day(run_params(run_ts, tz).date, -days)
    seen = window_events(events, run_ts, days, tz)
    by_user = user_partials(seen, vocab)
    new = today.join(previous.select("post_id"), "post_id", "left_anti")
    full = metrics_from_partials(in_posts(post_partials(seen, vocab), new), by_user)
    delta = seen.filter(since(prev_run_ts))
    changed = metrics_from_partials(
        post_partials(delta, vocab),
        user_partials(delta, vocab),
        first_date,
        day0=by_user.filter(F.col("day0_calls") > 0).select("user_id").distinct(),
    )

    # Every side of these joins is unique on, and shuffled by, the post.
    tag = lambda df, mark: df.select(
        "post_id", *[F.col(c).alias(f"{mark}_{c}") for c in df.columns if c != "post_id"]
    )
    now = today.select(*schemas.POST.fieldNames()).withColumn("listed", F.lit(True))
    before_run = previous.withColumn("known", F.lit(True))
    rows = (
        tag(now, "now")
        .join(tag(before_run, "old"), "post_id", "full")
        .filter(F.col("now_listed") | (F.col("old_created_ts") >= run_ts - days * DAY_MS))
        .join(tag(full, "full"), "post_id", "left")
        .join(tag(changed, "delta"), "post_id", "left")
    )
    listed, known = F.col("now_listed").isNotNull(), F.col("old_known").isNotNull()
    either = lambda c: F.when(listed, F.col(f"now_{c}")).otherwise(F.col(f"old_{c}"))
    zero = lambda c: default(F.col(c), 0)
    summed = rows.select(
        "post_id",
        *[either(c).alias(c) for c in schemas.POST.fieldNames() if c != "post_id"],
        F.when(known, F.coalesce("delta_avg_dur", "old_avgDur"))
        .otherwise(default(F.col("full_avg_dur"), 0.0))
        .alias("avgDur"),
        *[
            F.when(known, zero(f"old_{c}") + zero(f"delta_{m}")).otherwise(zero(f"full_{m}")).alias(c)
            for c, m in COUNTERS.items()
        ],
    )
    return _finish(summed, run_ts, mapping)


def advance_state(
    state: tuple[DataFrame, DataFrame] | None,
    events: DataFrame,
    vocab: Vocabulary = VOCAB_A,
) -> tuple[DataFrame, DataFrame]:
    """Adds the counters of new events to a (per post, per user) state."""
    by_post, by_user = post_partials(events, vocab), user_partials(events, vocab)
    if state is None:
        return by_post, by_user
    return (
        merge_partials(POST_KEYS, POST_SUMS, state[0], by_post),
        merge_partials(USER_KEYS, USER_SUMS, state[1], by_user),
    )


def snapshot_from_state(
    state: tuple[DataFrame, DataFrame],
    posts: DataFrame,
    run_ts: int,
    mapping: DataFrame,
    days: int = 7,
    tz: str = FEED_TZ,
) -> DataFrame:
    """Snapshot from additive state; equals the full rebuild over the same events.

    Days that left the window are not read, so counts expire with them.
    """
    first_date = shift_day(run_params(run_ts, tz).date, -days)
    return assemble_a(posts, metrics_from_partials(*state, first_date), run_ts, mapping)


def snapshot_advanced(
    state: tuple[DataFrame, DataFrame],
    previous: DataFrame,
    today: DataFrame,
    events: DataFrame,
    run_ts: int,
    prev_run_ts: int,
    mapping: DataFrame,
    days: int = 7,
    tz: str = FEED_TZ,
    vocab: Vocabulary = VOCAB_A,
) -> DataFrame:
    """Today's posts and those of the previous snapshot, counted from the state up to it and the
    events since: what a full rebuild gives, with the log read from ``prev_run_ts`` on only."""
    delta = events.filter(since(prev_run_ts) & before(run_ts))
    parts = (post_partials(delta, vocab), user_partials(delta, vocab))
    grown = tuple(old.unionByName(new.select(old.columns)) for old, new in zip(state, parts, strict=True))
    posts = merge_posts(today, previous, run_ts - days * DAY_MS)
    return snapshot_from_state(grown, posts, run_ts, mapping, days, tz)


def assemble_b(posts: DataFrame, run_ts: int, *metrics: DataFrame) -> DataFrame:
    """Posts with keyed lookups of their metrics; what is missing counts as 0."""
    means = ["avgDur", "listenpct"]
    counts = [c for c in [*schemas.ENGAGEMENT_COLUMNS, *schemas.CONVERSION_COLUMNS] if c not in means]
    rows = posts
    for table in metrics:
        rows = rows.join(table, "post_id", "left")
    rows = rows.fillna(0, subset=counts).fillna(0.0, subset=means)
    run = F.lit(run_ts).cast("bigint")
    complete = rows.select(
        "*",
        classified(F.col("topic"), F.col("subTopic"), truthy=True).alias("classified"),
        age_hours(run, F.col("created_ts")).alias("age_hours"),
        run.alias("snapshot_ts"),
    )
    return with_rates(complete, "b").select(*schemas.SNAPSHOT_B_COLUMNS)


def snapshot_b(
    events: DataFrame,
    posts: DataFrame,
    run_ts: int,
    mapping: DataFrame | None = None,
    tz: str = FEED_TZ,
    vocab: Vocabulary = VOCAB_B,
) -> DataFrame:
    """Stateless snapshot; with a district map it also carries ``post_state``."""
    snapshot = assemble_b(posts, run_ts, metrics_b(events, run_ts, tz, vocab))
    return snapshot if mapping is None else with_state(snapshot, mapping)


def engagement_from_counters(df: DataFrame) -> DataFrame:
    """Engagement of a counters table that splits local and global activity."""
    total = lambda *names: sum((default(F.col(n), 0) for n in names[1:]), default(F.col(names[0]), 0))
    return df.select(
        "post_id",
        total("lvc", "gvc").alias("views"),
        total("sc").alias("shareCount"),
        total("vcc").alias("mediaClickedCount"),
        total("lrc", "grc").alias("reactionCount"),
        total("lcc", "gcc").alias("commentCount"),
        total("rmc").alias("readModeCount"),
        default(F.col("ad"), 0.0).alias("avgDur"),
        default(F.col("lp"), 0.0).alias("listenpct"),
    )
