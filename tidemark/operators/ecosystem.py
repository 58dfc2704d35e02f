"""Market activity per district, state and language over the current window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import in_window, state_known, window_bounds
from tidemark.functions.dates import FEED_TZ
from tidemark.operators.events import only_day0
from tidemark.operators.posts import with_state
from tidemark.skew import salted_lookup


def _activity(posts: DataFrame, key: str, name: str, prefix: str) -> DataFrame:
    reporter = F.when(F.col("isReporter"), F.col("creatorID"))
    return posts.groupBy(F.col(key).alias(name)).agg(
        F.count(F.lit(1)).alias(f"{prefix}_posts_7d"),
        F.count_distinct(reporter).alias(f"{prefix}_reporters_7d"),
    )


def current_posts(posts: DataFrame, ref: str, tz: str = FEED_TZ) -> DataFrame:
    return posts.filter(in_window("created_ts", window_bounds(ref, tz).window_start))


def eco_users(
    locks: DataFrame,
    posts: DataFrame,
    ref: str,
    tz: str = FEED_TZ,
    day0: DataFrame | None = None,
) -> DataFrame:
    """Distinct users who locked a post of the district; posts outside the window give null."""
    recent = locks.filter(in_window("event_time", window_bounds(ref, tz).window_start))
    if day0 is not None:
        recent = only_day0(recent, day0)
    # Repeated locks of a user collapse before the join, and a hot post is spread by user.
    pairs = recent.select("post_id", "user_id").distinct()
    places = current_posts(posts, ref, tz).select("post_id", "location_pid")
    return (
        salted_lookup(pairs, places, ["post_id"], ["user_id"])
        .groupBy(F.col("location_pid").alias("district_pid"))
        .agg(F.count_distinct("user_id").alias("district_users_7d"))
    )


def eco_district(
    posts: DataFrame,
    locks: DataFrame,
    ref: str,
    tz: str = FEED_TZ,
    fill: bool = True,
    day0: DataFrame | None = None,
) -> DataFrame:
    """Posts, reporters and users per district.

    The null district of posts and the null district of users do not match, so each keeps
    its own row. ``fill`` turns missing counts into 0.
    """
    activity = _activity(current_posts(posts, ref, tz), "location_pid", "district_pid", "district")
    joined = activity.join(eco_users(locks, posts, ref, tz, day0), "district_pid", "full")
    counts = ["district_posts_7d", "district_reporters_7d", "district_users_7d"]
    return joined.fillna(0, subset=counts) if fill else joined


def eco_state(posts: DataFrame, mapping: DataFrame, ref: str, tz: str = FEED_TZ) -> DataFrame:
    located = with_state(current_posts(posts, ref, tz), mapping)
    return _activity(located.filter(state_known()), "post_state", "state_name", "state")


def eco_lang(posts: DataFrame, ref: str, tz: str = FEED_TZ) -> DataFrame:
    return _activity(current_posts(posts, ref, tz), "postLang", "postLang", "lang")
