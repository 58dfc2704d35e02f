"""Creator history. Events are counted per post before they meet the posts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import default, in_window, window_bounds
from tidemark.functions.dates import FEED_TZ


def _per_creator(events: DataFrame, posts: DataFrame, name: str) -> DataFrame:
    """Event count per creator. A hot post is one row by the time it is joined."""
    per_post = events.groupBy("post_id").agg(F.count(F.lit(1)).alias("_n"))
    owners = posts.select("post_id", "creatorID")
    return per_post.join(owners, "post_id").groupBy("creatorID").agg(F.sum("_n").alias(name))


def creator_prior(
    posts: DataFrame,
    locks: DataFrame,
    initiates: DataFrame,
    ref: str,
    tz: str = FEED_TZ,
) -> DataFrame:
    """Prior-window locks, initiates and their rate, of creators with prior locks."""
    bounds = window_bounds(ref, tz)
    prior = lambda df, column: df.filter(
        in_window(column, bounds.prior_start, bounds.prior_end)
    )
    kind = lambda df, lock: prior(df, "event_time").select("post_id", F.lit(lock).alias("_lock"))
    per_post = (
        kind(locks, True)
        .unionByName(kind(initiates, False))
        .groupBy("post_id")
        .agg(F.count_if("_lock").alias("_l"), F.count_if(~F.col("_lock")).alias("_i"))
    )
    owners = prior(posts, "created_ts").select("post_id", "creatorID")
    # A post without an owner's id has nobody whose initiates it could add to.
    begun = F.sum(F.when(F.col("creatorID").isNotNull(), F.col("_i")))
    history = owners.join(per_post, "post_id").groupBy("creatorID").agg(
        F.sum("_l").alias("locks"), default(begun, 0).alias("initiates")
    )
    return history.filter("locks > 0").select(
        "creatorID",
        "locks",
        "initiates",
        (F.col("initiates") / F.col("locks")).alias("creator_prior_rate"),
        F.lit(1).alias("creator_has_prior"),
    )


def creator_viewcount(locks: DataFrame, posts: DataFrame) -> DataFrame:
    return _per_creator(locks, posts, "creator_viewcount")


def creator_verified(posts: DataFrame, how: str = "reporter") -> DataFrame:
    """Creators and whether they count as verified.

    ``reporter`` lists those with any reporter post as true; ``none`` lists all as false.
    """
    if how == "none":
        everyone = posts.select("creatorID").distinct()
        return everyone.withColumn("creator_verified", F.lit(False))
    reporters = posts.filter(F.col("isReporter")).select("creatorID").distinct()
    return reporters.withColumn("creator_verified", F.lit(True))


def creator_features(
    posts: DataFrame,
    locks: DataFrame,
    initiates: DataFrame,
    ref: str,
    tz: str = FEED_TZ,
    profile: DataFrame | None = None,
    keep_all: bool = False,
) -> DataFrame:
    """Prior rate, history flag, view count and verified flag per creator.

    View count and flag come from the log, or from a ``profile`` table where one is given.
    Creators without prior locks are left out unless ``keep_all``.
    """
    if profile is not None:
        rates = creator_prior(posts, locks, initiates, ref, tz).drop("locks", "initiates")
        known = profile.select(
            F.col("user_id").alias("creatorID"),
            "creator_viewcount",
            F.col("verified").alias("creator_verified"),
        )
        if keep_all:
            rates = _all_creators(posts, rates)
        return rates.join(known, "creatorID", "left")

    # One read of the locks serves both the prior window and the view count.
    bounds = window_bounds(ref, tz)
    is_prior = lambda c: in_window(c, bounds.prior_start, bounds.prior_end)
    per_post = locks.groupBy("post_id").agg(
        F.count(F.lit(1)).alias("_views"), F.count_if(is_prior("event_time")).alias("_locks")
    )
    started = initiates.filter(is_prior("event_time")).groupBy("post_id").agg(
        F.count(F.lit(1)).alias("_initiates")
    )
    return creator_features_of(posts, per_post, started, ref, tz, keep_all)


def creator_features_of(
    posts: DataFrame, per_post: DataFrame, started: DataFrame, ref: str, tz: str = FEED_TZ, keep_all: bool = False
) -> DataFrame:
    """Creator features from counts per post: ``_views`` of both windows and ``_locks`` of the prior one, of posts with
    views; ``_initiates`` of the prior one, of posts with initiates."""
    bounds = window_bounds(ref, tz)
    is_prior = lambda c: in_window(c, bounds.prior_start, bounds.prior_end)
    owners = posts.select("post_id", "creatorID", is_prior("created_ts").alias("_prior"))
    totals = (
        owners.join(per_post, "post_id")
        .groupBy("creatorID")
        .agg(
            F.sum("_views").alias("creator_viewcount"),
            F.sum(F.when(F.col("_prior"), F.col("_locks"))).alias("locks"),
        )
    )
    begun = (
        owners.filter("_prior")
        .join(started, "post_id")
        .groupBy("creatorID")
        .agg(F.sum("_initiates").alias("initiates"))
    )
    # A missing creator matches nothing, so it has neither initiates nor views.
    views = F.when(F.col("creatorID").isNotNull(), F.col("creator_viewcount"))
    rates = (
        totals.join(begun, "creatorID", "left")
        .withColumn("_known", F.col("locks") > 0)
        .select(
            "creatorID",
            F.when(
                F.col("_known"), default(F.col("initiates"), 0) / F.nullif(F.col("locks"), F.lit(0))
            ).alias("creator_prior_rate"),
            F.when(F.col("_known"), 1).alias("creator_has_prior"),
            views.alias("creator_viewcount"),
        )
    )
    if not keep_all:
        rates = rates.filter(F.col("creator_has_prior").isNotNull())
    flags = posts.groupBy("creatorID").agg(F.max(default(F.col("isReporter"), False)).alias("_reports"))
    known = flags.filter(F.col("creatorID").isNotNull())
    rows = (_all_creators(posts, rates) if keep_all else rates).join(known, "creatorID", "left")
    return rows.select(
        "creatorID",
        "creator_prior_rate",
        "creator_has_prior",
        default(F.col("creator_viewcount"), 0).alias("creator_viewcount"),
        default(F.col("_reports"), False).alias("creator_verified"),
    )


def _all_creators(posts: DataFrame, rates: DataFrame) -> DataFrame:
    everyone = posts.select("creatorID").distinct()
    return everyone.join(rates, "creatorID", "left").fillna(
        {"creator_prior_rate": 0.0, "creator_has_prior": 0}
    )
