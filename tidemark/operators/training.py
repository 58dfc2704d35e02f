"""One training row per label, with the features known at its snapshot."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import age_hours, classified, default, ms_to_day, ratio_or_null, shift_day
from tidemark.skew import hot_key_lookup, salted_lookup

# ratio column -> counter divided by views
RATIOS = {
    "shares_pv": "shareCount",
    "videoclicks_pv": "mediaClickedCount",
    "reactions_pv": "reactionCount",
    "comments_pv": "commentCount",
    "seemore_pv": "readModeCount",
}

# feature table -> (key in the snapshot, key in the table, {column: value when missing})
DIMENSIONS = {
    "eco_district": (
        "location_pid",
        "district_pid",
        {"district_posts_7d": 0, "district_reporters_7d": 0, "district_users_7d": 0},
    ),
    "eco_state": ("post_state", "state_name", {"state_posts_7d": 0, "state_reporters_7d": 0}),
    "eco_lang": ("postLang", "postLang", {"lang_posts_7d": 0, "lang_reporters_7d": 0}),
    "creator": (
        "creatorID",
        "creatorID",
        {
            "creator_prior_rate": 0.0,
            "creator_has_prior": 0,
            "creator_verified": False,
            "creator_viewcount": 0,
        },
    ),
}

FEATURE_COLUMNS = [c for _, _, columns in DIMENSIONS.values() for c in columns]

TRAINING_COLUMNS = [
    "user_id",
    "post_id",
    "run_ts",
    "y",
    "created_ts",
    *schemas.ENGAGEMENT_COLUMNS,
    *RATIOS,
    "age_hours",
    "classified",
    *schemas.META_COLUMNS,
    "post_state",
    *schemas.CONVERSION_COLUMNS,
    *schemas.RATE_COLUMNS,
    *FEATURE_COLUMNS,
]


def ratio_columns() -> list[Column]:
    return [ratio_or_null(F.col(n), F.col("views")).alias(r) for r, n in RATIOS.items()]


def with_ratios(df: DataFrame) -> DataFrame:
    """Adds the per-view ratios; a post without views has none."""
    return df.select("*", *ratio_columns())


def with_daily_features(
    snapshots: DataFrame,
    features: Mapping[str, DataFrame],
    tz: str = "UTC",
    feature_lag_days: int = 0,
) -> DataFrame:
    """Adds district, state, language and creator features of the snapshot's day.

    Same-day features cover events later than the snapshot; ``feature_lag_days=1`` takes
    the table of the day before instead.
    """
    columns = snapshots.columns
    rows = snapshots.withColumn("_day", ms_to_day(F.col("run_ts"), tz))
    for table, (key, table_key, values) in DIMENSIONS.items():
        day = F.date_add(F.col("date").cast("date"), feature_lag_days).cast("string")
        lookup = features[table].select(
            F.col(table_key).alias(key), day.alias("_day"), *values
        )
        rows = salted_lookup(rows, lookup, [key, "_day"], ["post_id", "run_ts"])
    filled = [default(F.col(c), v).alias(c) for _, _, d in DIMENSIONS.values() for c, v in d.items()]
    return rows.select(*columns, *filled)


def training_data(
    labels: DataFrame,
    snapshots: DataFrame,
    features: Mapping[str, DataFrame],
    start: str,
    end: str,
    tz: str = "UTC",
    feature_lag_days: int = 0,
) -> DataFrame:
    """Labels joined to their snapshots and the daily features: 54 columns.

    Features are attached to the snapshots that labels refer to, once each, before those
    meet the labels; a snapshot that many labels share is split over tasks.
    """
    day = ms_to_day(F.col("run_ts"), tz)
    wanted = labels.filter(day.between(start, end)).select("user_id", "post_id", "run_ts", "y")
    keys = ["post_id", "run_ts"]
    # The day of the run decides; its folder date is a day in some zone.
    near = F.col("date").between(shift_day(start, -1), shift_day(end, 1))
    used = snapshots.filter(near).join(wanted.select(*keys).distinct(), keys, "left_semi")
    rows = with_daily_features(
        used.select(*schemas.SNAPSHOT_COLUMNS), features, tz, feature_lag_days
    ).select(
        "*",
        *ratio_columns(),
        age_hours(F.col("run_ts"), F.col("created_ts")).alias("age_hours"),
        classified(F.col("topic"), F.col("subTopic")).alias("classified"),
    )
    return hot_key_lookup(wanted, rows, keys, ["user_id"], how="inner").select(*TRAINING_COLUMNS)


def with_serving_context(requests: DataFrame, posts: DataFrame) -> DataFrame:
    """Serving place, language and tier of each request against the post's own place.

    ``requests`` holds ``post_id``, ``serving_district_pid``, ``serving_state``,
    ``serving_lang`` and ``tier``; ``posts`` holds ``location_pid`` and ``post_state``.
    """
    known = posts.select("post_id", "location_pid", "post_state")
    rows = hot_key_lookup(requests, known, ["post_id"], ["user_id", "event_time"])
    same = lambda a, b: F.coalesce(F.col(a) == F.col(b), F.lit(False))
    return rows.select(
        *requests.columns,
        same("location_pid", "serving_district_pid").alias("same_district"),
        same("post_state", "serving_state").alias("same_state"),
    )


def balance(train: DataFrame, mode: str = "weights", fractions=None, seed: int = 7) -> DataFrame:
    """Class weights (rows / (classes x rows of the class)) or a stratified sample."""
    if mode == "sample":
        return train.sampleBy("y", fractions, seed)
    counts = train.groupBy("y").agg(F.count(F.lit(1)).alias("_n"))
    totals = counts.agg(F.sum("_n").alias("rows"), F.count(F.lit(1)).alias("classes"))
    weights = counts.select(
        "y",
        (
            totals.select("rows").scalar() / (totals.select("classes").scalar() * F.col("_n"))
        ).alias("class_weight"),
    )
    # At most one row per class, and y has three.
    return train.join(F.broadcast(weights), "y").select(*train.columns, "class_weight")


def stratified_sample(
    rows: DataFrame, by: str, fractions: Mapping[int, float], keys: list[str], salt: str = "", digits: int = 4
) -> DataFrame:
    """floor(fraction x rows of the class) rows of each class: those whose salted hash of ``keys`` is smallest.

    The same rows on any partitioning and in any order, and a larger fraction keeps the rows of a smaller one. Classes not in
    ``fractions`` and null ones have none; rows with equal keys are told apart by their other columns, and
    null keys count as empty ones.

    Classes are counted by the first hexadecimal digits of the hash, which gives the group that holds the last row wanted.
    Rows of earlier groups stay, later ones go, and only those of that group are put in order, so that no
    task holds a class.
    """
    columns = rows.columns
    text = F.concat_ws("|", F.lit(salt), *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])
    hashed = rows.select("*", F.md5(text.cast("binary")).alias("_hash")).withColumn("_group", F.substring("_hash", 1, digits))
    counts = hashed.groupBy(by, "_group").agg(F.count(F.lit(1)).alias("_n"))  # 16**digits rows a class at most
    per_class = Window.partitionBy(by)
    share = F.lit(None).cast("double")
    for value, fraction in fractions.items():
        share = F.when(F.col(by) == value, F.lit(float(fraction))).otherwise(share)
    # a product such as 0.29 x 100 that lies within rounding of a whole number is that number
    wanted = F.floor(share * F.sum("_n").over(per_class) + F.lit(1e-9)).cast("bigint")
    before = F.coalesce(F.sum("_n").over(per_class.orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    left = counts.select(by, "_group", "_n", (wanted - before).alias("_left")).filter(F.col("_left") > 0)
    kept = hashed.join(left, [by, "_group"])
    whole = kept.filter(F.col("_left") >= F.col("_n"))
    order = Window.partitionBy(by, "_group").orderBy("_hash", *[c for c in columns if c not in (by, *keys)])
    last = kept.filter(F.col("_left") < F.col("_n")).withColumn("_rank", F.row_number().over(order))
    last = last.filter(F.col("_rank") <= F.col("_left"))
    return whole.select(*columns).unionByName(last.select(*columns))
