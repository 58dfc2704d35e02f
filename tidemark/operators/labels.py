"""Conversion labels per (user, post view), under several time windows.

Whether a view is followed by a conversion is a question about extremes, not pairs: within
one time bucket a later event exists exactly when the latest one is not before the view, and
within a fixed-width window the only other candidate is the earliest event of the next bucket.
So events shrink to one row per user (and post) and bucket, and views look that row up.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import (
    age_zero,
    day_ms,
    floor_div,
    has_post,
    label_y,
    ms_to_day,
    named,
    on_dates,
    shift_day,
)
from tidemark.functions.scalars import DAY_MS
from tidemark.operators.asof import asof_snapshot
from tidemark.operators.events import day0_users, initiates, locks, only_day0, trials
from tidemark.vocab import VOCAB_A, Vocabulary


@dataclass(frozen=True)
class WindowPolicy:
    """Which later events count for a view.

    ``same_day`` keeps those of the view's day, ``width_ms`` those within a fixed time, and
    neither keeps all up to the scan bound of ``scan_days`` after the last view date.
    """

    name: str
    scan_days: int
    same_day: bool = False
    width_ms: int | None = None

    def bucket(self, ms: Column, tz: str) -> Column:
        if self.same_day:
            return ms_to_day(ms, tz)
        return floor_div(ms, self.width_ms) if self.width_ms else F.lit(0)


SAME_DAY = WindowPolicy("same_day", scan_days=1, same_day=True)
HORIZON_3D = WindowPolicy("horizon3d", scan_days=3)
WITHIN_7D = WindowPolicy("7d", scan_days=7, width_ms=7 * DAY_MS)
POLICIES = {p.name: p for p in (SAME_DAY, HORIZON_3D, WITHIN_7D)}


def post_views(
    events: DataFrame,
    start: str,
    end: str,
    day0: str = "event_age",
    vocab: Vocabulary = VOCAB_A,
) -> DataFrame:
    """Locked feed views of day-0 users: user, post and view time.

    ``event_age`` asks for age 0 on the view itself, ``first_call`` for a first call at age 0
    in the date range.
    """
    seen = locks(events.filter(on_dates(start, end)), vocab).filter(has_post())
    if day0 == "event_age":
        seen = seen.filter(age_zero())
    else:
        seen = only_day0(seen, day0_users(events, start, end, vocab))
    return seen.select("user_id", "post_id", F.col("event_time").alias("view_time"))


def conversion_reach(
    events: DataFrame, keys: list[str], policy: WindowPolicy, tz: str = "UTC"
) -> DataFrame:
    """Per key and bucket: the latest event in it and the earliest in the next one."""
    extremes = (
        events.withColumn("bucket", policy.bucket(F.col("event_time"), tz))
        .groupBy(*keys, "bucket")
        .agg(F.max("event_time").alias("latest"), F.min("event_time").alias("earliest"))
    )
    none = F.lit(None).cast("bigint")
    if policy.width_ms is None:
        return extremes.select(*keys, "bucket", "latest", none.alias("next_earliest"))
    own = F.struct("bucket", "latest", none.alias("next_earliest"))
    previous = F.struct(
        (F.col("bucket") - 1).alias("bucket"),
        none.alias("latest"),
        F.col("earliest").alias("next_earliest"),
    )
    return (
        extremes.select(*keys, F.inline(F.array(own, previous)))
        .groupBy(*keys, "bucket")
        .agg(F.max("latest").alias("latest"), F.min("next_earliest").alias("next_earliest"))
    )


def flag_conversions(
    views: DataFrame,
    events: DataFrame,
    keys: list[str],
    policy: WindowPolicy,
    name: str,
    tz: str = "UTC",
) -> DataFrame:
    """Adds boolean ``name``: an event of the same keys follows the view in its window."""
    # Few of all users have a view, so conversions of the others go no further.
    users = views.select("user_id").distinct()
    reach = conversion_reach(events.join(users, "user_id", "left_semi"), keys, policy, tz)
    keyed = views.withColumn("bucket", policy.bucket(F.col("view_time"), tz))
    found = keyed.join(reach, [*keys, "bucket"], "left")
    follows = F.col("latest") >= F.col("view_time")
    if policy.width_ms is not None:
        inside = F.col("next_earliest") < F.col("view_time") + policy.width_ms
        follows = F.coalesce(follows, F.lit(False)) | F.coalesce(inside, F.lit(False))
    return found.select(*views.columns, F.coalesce(follows, F.lit(False)).alias(name))


def _conversion_events(
    events: DataFrame, kind: str, vocab: Vocabulary
) -> tuple[DataFrame, list[str]]:
    """Initiates belong to a user and post, trials to a user."""
    if kind == "trial":
        return trials(events, vocab), ["user_id"]
    found = initiates(events, by="origin", vocab=vocab).filter(has_post())
    return found, ["user_id", "post_id"]


def conversions_after(
    views: DataFrame,
    events: DataFrame,
    kind: str,
    policy: WindowPolicy,
    tz: str = "UTC",
    vocab: Vocabulary = VOCAB_A,
) -> DataFrame:
    """Distinct (user, post, snapshot) of matched views followed by a conversion."""
    found, keys = _conversion_events(events, kind, vocab)
    flagged = flag_conversions(views, found, keys, policy, "hit", tz)
    return flagged.filter("hit").select("user_id", "post_id", "run_ts").distinct()


def flag_views(
    views: DataFrame,
    events: DataFrame,
    policy: WindowPolicy,
    tz: str = "UTC",
    vocab: Vocabulary = VOCAB_A,
) -> DataFrame:
    """Matched views with ``initiated`` and ``trialed`` flags of their own."""
    for kind, name in (("initiate", "initiated"), ("trial", "trialed")):
        found, keys = _conversion_events(events, kind, vocab)
        views = flag_conversions(views, found, keys, policy, name, tz)
    return views


GROUP = ["user_id", "post_id", "run_ts"]


def _join_groups(views: DataFrame, outcome: DataFrame) -> DataFrame:
    """Views with the outcome of their group.

    No group of a null user has an outcome, so comparing users null-safely changes no row;
    it keeps Spark from filtering nulls on one side only, and so lets both sides share the
    scan and shuffle of the views.
    """
    same_user = F.col("v.user_id").eqNullSafe(F.col("o.user_id"))
    same_group = (F.col("v.post_id") == F.col("o.post_id")) & (F.col("v.run_ts") == F.col("o.run_ts"))
    joined = views.alias("v").join(outcome.alias("o"), same_user & same_group, "left")
    flags = [c for c in outcome.columns if c not in GROUP]
    return joined.select("v.*", *[F.col(f"o.{c}") for c in flags])


def label_views(
    flagged: DataFrame,
    per_view: bool = False,
    tz: str = "UTC",
    matched: DataFrame | None = None,
) -> DataFrame:
    """Labels of flagged views.

    By default the views of one user on one post under one snapshot share the strongest
    outcome of any of them; ``per_view`` labels each by its own. ``matched`` may hold the
    same views before they were flagged, which are cheaper to read a second time.
    """
    if not per_view:
        outcome = (
            flagged.filter(F.col("initiated") | F.col("trialed"))
            .groupBy(*GROUP)
            .agg(F.bool_or("initiated").alias("initiated"), F.bool_or("trialed").alias("trialed"))
        )
        plain = (flagged if matched is None else matched).select(*GROUP, "view_time")
        flagged = _join_groups(plain, outcome)
    return flagged.select(
        *GROUP,
        "view_time",
        label_y(F.col("trialed"), F.col("initiated")).alias("y"),
        ms_to_day(F.col("view_time"), tz).alias("date"),
    )


def scan_conversions(
    events: DataFrame, start: str, end: str, policy: WindowPolicy, vocab: Vocabulary = VOCAB_A
) -> DataFrame:
    """Conversion events the window can reach from the view dates."""
    return events.filter(
        named([vocab.initiate, vocab.trial]) & on_dates(start, shift_day(end, policy.scan_days))
    )


def matched_views(
    events: DataFrame,
    snapshots: DataFrame,
    start: str,
    end: str,
    day0: str = "event_age",
    lag_ms: int = 0,
    vocab: Vocabulary = VOCAB_A,
) -> DataFrame:
    """Day-0 views of a date range, each with the snapshot that preceded it.

    Runs count from a day before the range on, so that views shortly after midnight find theirs.
    The run's time decides; its folder ``date`` is a day in some zone and only narrows the scan.
    """
    views = post_views(events, start, end, day0, vocab)
    return asof_snapshot(views, runs_of(snapshots, start, end), lag_ms)


def runs_of(snapshots: DataFrame, start: str, end: str) -> DataFrame:
    """Snapshots that views of a range of UTC days can match, whatever zone names the folders."""
    first, last = day_ms(shift_day(start, -1), "UTC"), day_ms(shift_day(end, 1), "UTC")
    folders = on_dates(shift_day(start, -2), shift_day(end, 1))
    return snapshots.filter(folders & (F.col("run_ts") >= first) & (F.col("run_ts") < last))


def create_labels(
    events: DataFrame,
    snapshots: DataFrame,
    start: str,
    end: str,
    window: str = "same_day",
    day0: str = "event_age",
    per_view: bool = False,
    lag_ms: int = 0,
    tz: str = "UTC",
    vocab: Vocabulary = VOCAB_A,
) -> DataFrame:
    """Labels of the day-0 views of a date range, one row per (user, post, view time)."""
    policy = POLICIES[window]
    views = matched_views(events, snapshots, start, end, day0, lag_ms, vocab)
    conversions = scan_conversions(events, start, end, policy, vocab)
    flagged = flag_views(views, conversions, policy, tz, vocab)
    return label_views(flagged, per_view, tz, matched=views)


def multi_window_labels(
    events: DataFrame,
    snapshots: DataFrame,
    start: str,
    end: str,
    day0: str = "event_age",
    tz: str = "UTC",
    vocab: Vocabulary = VOCAB_A,
) -> DataFrame:
    """Same-day and seven-day labels side by side: ``y_day0`` and ``y_day7``.

    Each view is matched once; the outcomes of a snapshot group meet in one aggregation.
    """
    matched = flagged = matched_views(events, snapshots, start, end, day0, vocab=vocab)
    names = []
    for policy, suffix in ((SAME_DAY, "day0"), (WITHIN_7D, "day7")):
        conversions = scan_conversions(events, start, end, policy, vocab)
        for kind in ("initiate", "trial"):
            found, keys = _conversion_events(conversions, kind, vocab)
            names.append(f"{kind}_{suffix}")
            flagged = flag_conversions(flagged, found, keys, policy, names[-1], tz)
    outcome = flagged.groupBy(*GROUP).agg(*[F.bool_or(n).alias(n) for n in names])
    plain = matched.select(*GROUP, "view_time")
    return _join_groups(plain, outcome).select(
        *GROUP,
        "view_time",
        label_y(F.col("trial_day0"), F.col("initiate_day0")).alias("y_day0"),
        label_y(F.col("trial_day7"), F.col("initiate_day7")).alias("y_day7"),
        ms_to_day(F.col("view_time"), tz).alias("date"),
    )


def outcome_7d(
    views: DataFrame,
    events: DataFrame,
    start: str | None = None,
    end: str | None = None,
    vocab: Vocabulary = VOCAB_A,
) -> DataFrame:
    """Per (user, post): initiate and trial flags of the user within seven days of any view.

    Here neither event is tied to the post. ``start`` and ``end`` are the view dates; with them
    the event scan is bounded as well.
    """
    events = events.filter(on_dates(start, None if end is None else shift_day(end, WITHIN_7D.scan_days)))
    flagged = views.distinct()
    for name, event in (("initiated", vocab.initiate), ("trialed", vocab.trial)):
        found = events.filter(named(event)).select("user_id", "event_time")
        flagged = flag_conversions(flagged, found, ["user_id"], WITHIN_7D, name)
    grouped = flagged.groupBy("user_id", "post_id").agg(
        F.bool_or("initiated").alias("initiated"), F.bool_or("trialed").alias("trialed")
    )
    return grouped.select(
        "user_id",
        "post_id",
        F.col("initiated").cast("int").alias("initiate_transaction"),
        F.col("trialed").cast("int").alias("trial_started"),
        label_y(F.col("trialed"), F.col("initiated")).alias("y"),
    )
