"""Leave-one-out counts: what other users had done on a post before a view."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions import floor_div, has_post, named, on_dates
from tidemark.operators.events import parse_events
from tidemark.vocab import VOCAB_A, Vocabulary

MINUTE_MS = 60_000


def counts_before(
    marks: DataFrame, probes: DataFrame, keys: list[str], names: list[str], slice_ms: int = MINUTE_MS
) -> DataFrame:
    """For each distinct probe (keys, ``t``), the sums of ``names`` over marks before ``t``.

    A running sum over a whole key would put a hot key into one task. Marks and probes first
    shrink to one row per key and millisecond; the running sum is then taken within slices
    and over the totals of slices. A window group therefore holds at most ``slice_ms`` rows,
    or one row per slice of the period, whatever the number of events. Rows are laid out by
    slice once, which serves the shrinking, the sums within slices and their totals.
    """
    zero = F.lit(0).cast("bigint")
    points = (
        marks.select(*keys, "t", *names, F.lit(False).alias("probe"))
        .unionByName(
            probes.select(*keys, "t", *[zero.alias(n) for n in names], F.lit(True).alias("probe"))
        )
        .withColumn("slice", floor_div(F.col("t"), slice_ms))
        # Stated here for both readers of the points; a filter that Spark infers for one of
        # them alone would keep them from sharing the shuffle.
        .filter(F.col("slice").isNotNull())
        .repartition(*keys, "slice")
        .groupBy(*keys, "slice", "t")
        .agg(F.bool_or("probe").alias("probe"), *[F.sum(n).alias(n) for n in names])
    )
    earlier = lambda window: window.rowsBetween(Window.unboundedPreceding, -1)
    in_slice = earlier(Window.partitionBy(*keys, "slice").orderBy("t"))
    over_slices = earlier(Window.partitionBy(*keys).orderBy("slice"))
    running = lambda n, w: F.coalesce(F.sum(n).over(w), zero)
    # Only slices and points that hold a probe are kept. Both sides need the same columns of
    # the points, in the same order, so the points are shuffled once.
    totals = (
        points.groupBy(*keys, "slice")
        .agg(*[F.sum(n).alias(n) for n in names], F.bool_or("probe").alias("probe"))
        .select(*keys, "slice", "probe", *[running(n, over_slices).alias(f"_{n}") for n in names])
        .filter("probe")
        .drop("probe")
    )
    within = points.select(
        *keys, "slice", "t", "probe", *[running(n, in_slice).alias(n) for n in names]
    ).filter("probe")
    return within.join(totals, [*keys, "slice"]).select(
        *keys, "t", *[(F.col(n) + F.col(f"_{n}")).alias(n) for n in names]
    )


def default_measures(vocab: Vocabulary = VOCAB_A) -> dict[str, Column]:
    name = F.col("event_name")
    return {
        "views": name == vocab.seen,
        "locks": (name == vocab.locked) & (F.col("is_locked") == "true"),
        "initiates": (name == vocab.initiate) & (F.col("from_post") == "true"),
        "shares": name == vocab.shared,
        "reactions": name == vocab.reaction,
        "comments": name == vocab.comment,
        "media_clicks": name == vocab.media_click,
        "read_mode": name == vocab.read_mode,
    }


def counted_events(vocab: Vocabulary = VOCAB_A) -> list[str]:
    """Names of the events that the default measures count."""
    engaged = [vocab.shared, vocab.reaction, vocab.comment, vocab.media_click, vocab.read_mode]
    return [vocab.seen, vocab.locked, vocab.initiate, *engaged]


def marks_of(
    events: DataFrame,
    measures: Mapping[str, Column] | None = None,
    vocab: Vocabulary = VOCAB_A,
    at: Column | None = None,
    name: str = "t",
) -> DataFrame:
    """What each user did on each post at each time ``t``, counted by measure. ``at`` may give a coarser time, called ``name``."""
    parsed = parse_events(
        events.filter(named(counted_events(vocab))), "post_id", "is_locked", "from_post"
    ).filter(has_post() & F.col("user_id").isNotNull() & F.col("event_time").isNotNull())
    counts = [F.count_if(cond).alias(n) for n, cond in (measures or default_measures(vocab)).items()]
    time = F.col("event_time") if at is None else at
    return parsed.withColumn(name, time).groupBy("post_id", "user_id", name).agg(*counts)


def probes_of(views: DataFrame) -> DataFrame:
    """Distinct views of a known user and post, with their time ``t``."""
    return (
        views.select("post_id", "user_id", F.col("view_time").alias("t"))
        .filter(has_post() & F.col("user_id").isNotNull() & F.col("t").isNotNull())
        .distinct()
    )


def before_last(marks: DataFrame, probes: DataFrame, keys: list[str]) -> DataFrame:
    """Marks before the last probe of their keys.

    An inner join to unique keys: a semi-join would be pushed below the counting of marks and read all events again. The
    probes are counted, and their slice is stated, so that Spark takes them from the shuffle of distinct probes too.
    """
    sliced = probes.filter(floor_div(F.col("t"), MINUTE_MS).isNotNull())
    last = sliced.groupBy(*keys).agg(F.max("t").alias("_last"), F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 0)
    return marks.join(last, keys).filter(F.col("t") < F.col("_last")).select(*marks.columns)


def others_before(own: DataFrame, everyone: DataFrame, probes: DataFrame, names: list[str]) -> DataFrame:
    """Per probe, the marks of everyone on the post before it less the user's own.

    Few of all pairs of a post and a user have a probe; own marks of the others go no further.
    """
    pair = ["post_id", "user_id"]
    mine = counts_before(before_last(own, probes, pair), probes, pair, names)
    totals = counts_before(everyone, probes, ["post_id"], names)
    totals = totals.select("post_id", "t", *[F.col(n).alias(f"_{n}") for n in names])
    # The millisecond in the key divides a hot post.
    return mine.join(totals, ["post_id", "t"]).select(
        "user_id",
        "post_id",
        F.col("t").alias("view_time"),
        *[(F.col(f"_{n}") - F.col(n)).alias(f"{n}_other_users") for n in names],
    )


def loo_counts(
    views: DataFrame,
    events: DataFrame,
    measures: Mapping[str, Column] | None = None,
    vocab: Vocabulary = VOCAB_A,
    until: str | None = None,
) -> DataFrame:
    """Adds ``<measure>_other_users`` to each distinct (user, post, view time).

    Events of others before the view are all events before it less the user's own. Rows
    without a user or post belong to nobody and are left out at the source: every branch
    then starts from the same shuffled rows, which Spark reads once. ``until``, the date of the
    last view, bounds the scan.
    """
    marks = marks_of(events.filter(on_dates(None, until)), measures, vocab)
    return others_before(marks, marks, probes_of(views), list(measures or default_measures(vocab)))
