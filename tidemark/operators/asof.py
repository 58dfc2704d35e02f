"""As-of matching without pairing views and snapshots of a post."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions import floor_div

HOUR_MS = 3_600_000


def run_calendar(snapshots: DataFrame, wanted: DataFrame, bucket_ms: int) -> DataFrame:
    """For each wanted (post, bucket): the runs inside it and the last run before it.

    Only runs of wanted posts are read on. The last run is carried forward over one row per post
    and bucket that holds a run or is wanted, so a window group is bounded by the buckets of the
    period, and no row is made for time nobody asks about.
    """
    posts = wanted.select("post_id").distinct()
    runs = (
        snapshots.select("post_id", "run_ts")
        .join(posts, "post_id", "left_semi")
        .withColumn("bucket", floor_div(F.col("run_ts"), bucket_ms))
        .select("post_id", "bucket", "run_ts", F.lit(False).alias("wanted"))
    )
    none = F.lit(None).cast("bigint")
    asked = wanted.select("post_id", "bucket", none.alias("run_ts"), F.lit(True).alias("wanted"))
    filed = (
        runs.unionByName(asked)
        .groupBy("post_id", "bucket")
        .agg(
            F.collect_set("run_ts").alias("runs"),
            F.max("run_ts").alias("last_run"),
            F.bool_or("wanted").alias("wanted"),
        )
    )
    earlier = Window.partitionBy("post_id").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    carried = filed.withColumn("prev_run", F.max("last_run").over(earlier))
    return carried.filter("wanted").select("post_id", "bucket", "runs", "prev_run")


def asof_snapshot(
    views: DataFrame, snapshots: DataFrame, lag_ms: int = 0, bucket_ms: int = 6 * HOUR_MS
) -> DataFrame:
    """Adds ``run_ts``, the latest run at or before each view; views with none are dropped.

    Views repeat a (user, post, time) at most once in the result. ``lag_ms`` asks for a run
    that is at least so much older than the view. The bucket in the key divides a hot post by
    time, and Spark splits what remains of one.
    """
    probe = F.col("view_time") - lag_ms
    keyed = views.distinct().withColumn("bucket", floor_div(probe, bucket_ms))
    keys = ["post_id", "bucket"]
    calendar = run_calendar(snapshots, keyed.select(*keys).distinct(), bucket_ms)
    matched = keyed.join(calendar, keys)
    inside = F.array_max(F.filter("runs", lambda run: run <= probe))
    return (
        matched.withColumn("run_ts", F.coalesce(inside, F.col("prev_run")))
        .filter(F.col("run_ts").isNotNull())
        .select(*views.columns, "run_ts")
    )
