"""Reports on labels, users, training rows and runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions import minutes_between, ms_to_day, named, on_dates, pct
from tidemark.operators.events import day0_users, parse_events
from tidemark.skew import salted_lookup
from tidemark.vocab import VOCAB_A, Vocabulary


def _class_counts(*names: str):
    return [F.count_if(F.col("y") == y).alias(name) for y, name in enumerate(names)]


def dataset_stats(train: DataFrame) -> DataFrame:
    """Rows, distinct users and posts, class counts and percentages."""
    stats = train.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_distinct("user_id").alias("unique_users"),
        F.count_distinct("post_id").alias("unique_posts"),
        *_class_counts("y_0", "y_1", "y_2"),
    )
    share = lambda name: (
        F.col(name).cast("double") / F.nullif(F.col("total_rows"), F.lit(0)) * F.lit(100.0)
    )
    return stats.select(
        "*",
        share("y_0").alias("pct_none"),
        share("y_1").alias("pct_initiate"),
        share("y_2").alias("pct_trial"),
    )


def label_qa(labels: DataFrame, date: str | None = None) -> DataFrame:
    """Instances, users, posts and class counts per label date."""
    chosen = labels if date is None else labels.filter(on_dates(date, date))
    return chosen.groupBy("date").agg(
        F.count(F.lit(1)).alias("total_instances"),
        F.count_distinct("user_id").alias("unique_users"),
        F.count_distinct("post_id").alias("unique_posts"),
        *_class_counts("no_conversion", "initiated", "trialed"),
    )


def label_freshness(labels: DataFrame) -> DataFrame:
    return labels.agg(F.max("date").alias("latest_label_date"))


def label_distribution(labels: DataFrame) -> DataFrame:
    """Share of each class per date, in date order."""
    counts = labels.groupBy("date", "y").agg(F.count(F.lit(1)).alias("cnt"))
    # The window sees at most one row per class and date.
    of_day = F.sum("cnt").over(Window.partitionBy("date"))
    return counts.withColumn("pct", pct(F.col("cnt"), of_day)).orderBy("date", "y")


def top_n(df: DataFrame, order: list, n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def user_age_distribution(
    events: DataFrame, date: str, n: int = 10, vocab: Vocabulary = VOCAB_A
) -> DataFrame:
    """The most frequent ages of first calls on a date; ties go to the smaller text."""
    calls = events.filter(named(vocab.first_call) & on_dates(date, date))
    ages = parse_events(calls, "user_age").groupBy("user_age").agg(F.count(F.lit(1)).alias("cnt"))
    return top_n(ages, [F.desc("cnt"), F.asc("user_age")], n)


def day0_user_count(events: DataFrame, date: str, vocab: Vocabulary = VOCAB_A) -> DataFrame:
    return day0_users(events, date, date, vocab).agg(F.count("user_id").alias("day0_users"))


def conversion_timing(
    labels: DataFrame, events: DataFrame, date: str, tz: str = "UTC", vocab: Vocabulary = VOCAB_A
) -> DataFrame:
    """Converted labels of a date beside the conversions of their user that day.

    The report lists every conversion of the user for every label, as it is defined; both
    sides are first cut to the one date and to converted labels, and the labels of one user
    are spread over tasks.
    """
    converted = labels.filter(on_dates(date, date) & (F.col("y") > 0)).select(
        "user_id", "post_id", "view_time", "y"
    )
    conversions = events.filter(
        named([vocab.initiate, vocab.trial])
        & on_dates(date, date)
        & (ms_to_day(F.col("event_time"), tz) == date)
    ).select("user_id", F.col("event_time").alias("conversion_time"))
    return (
        salted_lookup(converted, conversions, ["user_id"], ["post_id", "view_time"], how="inner")
        .select(
            "user_id",
            "post_id",
            "view_time",
            "conversion_time",
            minutes_between(F.col("conversion_time"), F.col("view_time")).alias(
                "minutes_to_convert"
            ),
            "y",
        )
        .orderBy("minutes_to_convert")
    )


def rank_posts(
    snapshot: DataFrame, metric: str = "post_day0_initiates_per_lock", k: int = 100
) -> DataFrame:
    """Top posts by a target metric; ties go to the smaller post id."""
    return top_n(snapshot.select("post_id", metric), [F.desc(metric), F.asc("post_id")], k)


def run_summary(snapshot: DataFrame, previous: DataFrame) -> DataFrame:
    """Posts of a run, split into new ones and those carried from the run before."""
    known = previous.select("post_id", F.lit(True).alias("_known"))
    joined = snapshot.select("post_id").join(known, "post_id", "left")
    return joined.agg(
        F.count(F.lit(1)).alias("posts"),
        F.count_if(F.col("_known").isNull()).alias("new_posts"),
        F.count_if(F.col("_known")).alias("incremental_posts"),
    )
