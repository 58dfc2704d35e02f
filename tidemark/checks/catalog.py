"""One query per operator, over the whole fixture tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.checks.fixtures import (
    END,
    FEATURE_DATES,
    PREV_RUN_TS,
    REF,
    RUN_TS,
    START,
    TODAY,
    Fixtures,
)
from tidemark.counters import Counters
from tidemark.functions import (
    json_str,
    ms_to_day,
    on_dates,
    run_params,
    safe_cast,
    shift_day,
    str_true,
    window_bounds,
)
from tidemark.functions.scalars import DAY_MS
from tidemark.operators import creators, ecosystem, engagement, labels, leakage, quality, training
from tidemark.operators.asof import asof_snapshot
from tidemark.operators.events import (
    day0_users,
    flag_day0,
    in_posts,
    initiates,
    locks,
    only_day0,
    parse_events,
)
from tidemark.operators.ingest import dump_rejects as ingest_dump_rejects
from tidemark.operators.ingest import reject_counts
from tidemark.operators.partials import post_partials
from tidemark.operators.posts import (
    latest_posts,
    merge_posts,
    place_map,
    place_orphans,
    posts_from_table,
    split_posts,
    users_from_table,
    with_state,
)
from tidemark.plans import jobs
from tidemark.plans import snapshots as plans
from tidemark.plans.daily import daily_features_sliding
from tidemark.session import tune
from tidemark.sources import readers, sinks
from tidemark.streaming.snapshots import read_event_stream, stream_snapshots
from tidemark.vocab import VOCAB_A, VOCAB_B

SINCE = shift_day(run_params(RUN_TS).date, -7)
BOUNDS = window_bounds(REF)
CARRY_CUTOFF = RUN_TS - 7 * DAY_MS
TIMING_DATE = "2024-01-11"
SAMPLE_KEYS = ["user_id", "post_id", "run_ts", "view_time"]

_QUERIES: dict[str, Callable[[Fixtures], DataFrame]] = {}


def _query(fn: Callable[[Fixtures], DataFrame]) -> Callable[[Fixtures], DataFrame]:
    _QUERIES[fn.__name__] = fn
    return fn


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            tune(spark)
            return fn(Fixtures.of(spark, sf_dir))

        return run

    return {name: bind(fn) for name, fn in _QUERIES.items()}


def _recent(f: Fixtures) -> DataFrame:
    return f.events.filter(on_dates(BOUNDS.first_date, BOUNDS.last_date))


# Events and user sets


@_query
def event_payload(f):
    e = parse_events(f.events)
    day = ms_to_day(F.col("event_time"), "Asia/Kolkata").alias("feed_day")
    return e.select("*", ms_to_day(F.col("event_time")).alias("utc_day"), day)


@_query
def json_paths(f):
    path = lambda p: json_str("data", f"$.{p}")
    return f.events.select(
        "event_id",
        path("postId").alias("post_id"),
        path("duration").alias("duration_text"),
        path("postEngagement.screenTime").alias("screen_time_text"),
        path("absent").alias("absent"),
        safe_cast(path("postEngagement.screenTime"), "bigint").alias("screen_time"),
        str_true(path("isLocked")).alias("is_locked"),
    )


@_query
def ingested_events(f):
    return f.ingested.drop("unread")


@_query
def event_rejects(f):
    return reject_counts(f.ingested)


@_query
def dump_rejects(f):
    return reject_counts(ingest_dump_rejects(f.dumps))


@_query
def engagement_from_ingested(f):
    return engagement.engagement_a(f.ingested, f.truthy_posts, SINCE)


@_query
def day0_users_since(f):
    return day0_users(f.events, SINCE)


@_query
def day0_user_count(f):
    return quality.day0_user_count(f.events, TODAY)


@_query
def user_age_distribution(f):
    return quality.user_age_distribution(f.events, TODAY)


@_query
def flagged_locks(f):
    return flag_day0(locks(f.events), day0_users(f.events, SINCE))


@_query
def day0_initiates(f):
    started = in_posts(initiates(f.events, "origin"), f.posts)
    return only_day0(started, day0_users(f.events, SINCE))


# Counts per post


@_query
def engagement_a(f):
    return engagement.engagement_a(f.events, f.truthy_posts, SINCE)


@_query
def engagement_a_delta(f):
    return engagement.engagement_a(f.events, f.truthy_posts, SINCE, PREV_RUN_TS)


@_query
def engagement_b(f):
    return engagement.engagement_b(f.events, RUN_TS)


@_query
def social_b(f):
    return engagement.social_b(f.events, RUN_TS)


@_query
def conversions_a_fanout(f):
    return engagement.conversions_a(f.events, f.truthy_posts, day0_users(f.events, SINCE), SINCE)


@_query
def conversions_a_dedup(f):
    day0 = day0_users(f.events, SINCE)
    return engagement.conversions_a(f.events, f.truthy_posts, day0, SINCE, dedup=True)


@_query
def conversions_b(f):
    return engagement.conversions_b(f.events, RUN_TS)


@_query
def post_metrics_full_outer(f):
    day0 = day0_users(f.events, SINCE)
    return engagement.post_metrics(
        engagement.engagement_a(f.events, None, SINCE),
        engagement.conversions_a(f.events, None, day0, SINCE),
    )


@_query
def post_metrics_one_pass(f):
    return plans.full_metrics(f.events.filter(on_dates(SINCE)))


@_query
def engagement_from_counters(f):
    e = parse_events(f.events, "post_id", "duration", "max_listen")
    odd = F.col("event_id").cast("bigint") % 2 == 1
    kinds = {
        "vc": VOCAB_B.seen,
        "rc": VOCAB_A.reaction,
        "cc": VOCAB_A.comment,
    }
    split = [
        F.count_if((F.col("event_name") == name) & (odd if side == "l" else ~odd)).alias(side + kind)
        for kind, name in kinds.items()
        for side in "lg"
    ]
    counters = (
        e.filter(F.col("post_id").isNotNull())
        .groupBy("post_id")
        .agg(
            *split,
            F.count_if(F.col("event_name") == VOCAB_A.shared).alias("sc"),
            F.count_if(F.col("event_name") == VOCAB_A.media_click).alias("vcc"),
            F.count_if(F.col("event_name") == VOCAB_A.read_mode).alias("rmc"),
            F.avg("duration").alias("ad"),
            F.avg("max_listen").alias("lp"),
        )
    )
    return plans.engagement_from_counters(counters)


# Posts and places


@_query
def latest_posts_coalesce(f):
    return f.posts


@_query
def latest_posts_truthy(f):
    return f.truthy_posts


@_query
def latest_posts_strict(f):
    return latest_posts(f.dumps, "strict")


@_query
def posts_from_store(f):
    place = F.when(F.col("doc_id") % 11 != 10, F.concat(F.lit("d"), F.col("doc_id") % 25))
    store = f.raw("documents").select(
        F.concat(F.lit("p"), "doc_id").alias("id"),
        (F.lit(BOUNDS.prior_start) - 2 * DAY_MS + F.col("doc_id") % 20 * DAY_MS).alias("c"),
        F.col("source").alias("topic"),
        F.lit("st").alias("subTopic"),
        (F.col("doc_id") % 4).cast("int").alias("districtImportanceLevel"),
        (F.col("doc_id") % 3).cast("int").alias("stateImportanceLevel"),
        F.lit(0).alias("nationalImportanceLevel"),
        (F.col("doc_id") % 2 == 0).alias("isLocal"),
        (F.col("doc_id") % 3 == 0).alias("isReporter"),
        F.lit(True).alias("containsVisualMedia"),
        (F.col("doc_id") % 60).cast("double").alias("duration"),
        F.length("text").alias("titleLength"),
        F.col("lang").alias("contentLang"),
        F.concat(F.lit("c"), F.col("doc_id") % 40).alias("creatorID"),
        F.struct(place.alias("pid")).alias("location"),
    )
    return posts_from_table(store, BOUNDS.prior_start)


@_query
def users_from_store(f):
    return users_from_table(f.users)


@_query
def place_map_left(f):
    return place_map(f.places, "left")


@_query
def place_map_inner(f):
    return place_map(f.places)


@_query
def orphan_districts(f):
    return place_orphans(f.places)


@_query
def posts_with_state(f):
    return with_state(f.posts, f.mapping)


def _today(f):
    return latest_posts(f.dumps.filter(on_dates(TODAY, TODAY)), "truthy")


@_query
def merged_posts(f):
    return merge_posts(_today(f), f.previous, CARRY_CUTOFF)


@_query
def split_new_and_existing(f):
    posts = merge_posts(_today(f), f.previous, CARRY_CUTOFF)
    new, existing = split_posts(posts, f.previous)
    mark = lambda df, kind: df.select("post_id", F.lit(kind).alias("kind"))
    return mark(new, "new").unionByName(mark(existing, "existing"))


# Daily features


@_query
def eco_district(f):
    return ecosystem.eco_district(f.posts, locks(_recent(f)), REF)


@_query
def eco_district_unfilled_day0(f):
    day0 = day0_users(_recent(f), BOUNDS.first_date)
    return ecosystem.eco_district(f.posts, locks(_recent(f)), REF, fill=False, day0=day0)


@_query
def eco_state(f):
    return ecosystem.eco_state(f.posts, f.mapping, REF)


@_query
def eco_lang(f):
    return ecosystem.eco_lang(f.posts, REF)


@_query
def eco_users(f):
    return ecosystem.eco_users(locks(_recent(f)), f.posts, REF)


@_query
def creator_prior(f):
    return creators.creator_prior(f.posts, locks(_recent(f)), initiates(_recent(f)), REF)


@_query
def creator_viewcount(f):
    return creators.creator_viewcount(locks(_recent(f)), f.posts)


@_query
def creator_verified(f):
    return creators.creator_verified(f.posts)


@_query
def creator_verified_none(f):
    return creators.creator_verified(f.posts, "none")


@_query
def creator_features_events(f):
    return creators.creator_features(f.posts, locks(_recent(f)), initiates(_recent(f)), REF)


@_query
def creator_features_profile(f):
    return creators.creator_features(
        f.posts,
        locks(_recent(f)),
        initiates(_recent(f), "origin"),
        REF,
        profile=users_from_table(f.users),
    )


@_query
def creator_features_all(f):
    return creators.creator_features(
        f.posts, locks(_recent(f)), initiates(_recent(f)), REF, keep_all=True
    )


def _sliding(f, kind):
    """A feature table of several dates, each from the sliding tables up to it."""
    base, tables = f.sliding, []
    for date in FEATURE_DATES:
        seen = readers.sliding_table(f.spark, base, "seen", [date])
        totals = readers.sliding_table(f.spark, base, "totals", sinks.dates_between(shift_day(date, -15), date))
        tables.append(daily_features_sliding(f.posts, seen, totals, f.mapping, date)[kind].withColumn("date", F.lit(date)))
    return reduce(DataFrame.unionByName, tables)


@_query
def eco_district_sliding(f):
    return _sliding(f, "eco_district")


@_query
def creator_features_sliding(f):
    return _sliding(f, "creator")


# As-of matching and labels


def _all_views(f):
    return labels.post_views(f.events, START, END)


@_query
def asof_all_views(f):
    return asof_snapshot(_all_views(f), f.grid)


@_query
def asof_lag15m(f):
    return asof_snapshot(_all_views(f), f.grid, lag_ms=15 * 60_000)


def _matched(f):
    return labels.matched_views(f.events, f.grid, START, END)


@_query
def initiates_after_same_day(f):
    events = labels.scan_conversions(f.events, START, END, labels.SAME_DAY)
    return labels.conversions_after(_matched(f), events, "initiate", labels.SAME_DAY)


@_query
def trials_after_same_day(f):
    events = labels.scan_conversions(f.events, START, END, labels.SAME_DAY)
    return labels.conversions_after(_matched(f), events, "trial", labels.SAME_DAY)


def _labels(f, window="same_day", **options):
    return labels.create_labels(f.events, f.grid, START, END, window, **options)


@_query
def labels_same_day(f):
    return _labels(f)


@_query
def labels_horizon3d(f):
    return _labels(f, "horizon3d", day0="first_call")


@_query
def labels_7d(f):
    return _labels(f, "7d")


@_query
def labels_same_day_per_view(f):
    return _labels(f, per_view=True)


@_query
def labels_multi_window(f):
    return labels.multi_window_labels(f.events, f.grid, START, END)


@_query
def outcome_7d(f):
    return labels.outcome_7d(_all_views(f), f.events, START, END)


@_query
def label_distribution(f):
    return quality.label_distribution(f.labels())


@_query
def label_qa(f):
    return quality.label_qa(f.labels())


@_query
def label_freshness(f):
    return quality.label_freshness(f.labels())


@_query
def conversion_timing(f):
    return quality.conversion_timing(f.labels(), f.events, TIMING_DATE)


@_query
def loo_counts(f):
    return leakage.loo_counts(_all_views(f), f.events, until=END)


@_query
def loo_counts_at_rest(f):
    """The same rows, from the counts at rest and the events of the days alone: a week, then three shorter ranges."""
    base, firsts = f.prefixes, [START, "2024-01-15", "2024-01-20", END]
    ranges = zip(firsts, [*(shift_day(d, -1) for d in firsts[1:]), END], strict=True)
    # Views of a range lie in its folders and those before and after it, as its events do.
    views = lambda a, b: labels.post_views(f.events, max(START, shift_day(a, -1)), min(END, shift_day(b, 1)))
    parts = [jobs.views_with_others(f.spark, views(a, b), f.path("events"), base, a, b) for a, b in ranges]
    return reduce(DataFrame.unionByName, parts)


# Snapshots


@_query
def snapshot_a_full(f):
    return plans.snapshot_full(f.events, f.truthy_posts, RUN_TS, f.mapping)


@_query
def snapshot_a_incremental(f):
    recent = f.events.filter(on_dates(run_params(PREV_RUN_TS, "UTC").date, TODAY))
    return plans.snapshot_advanced(
        f.state, f.previous, _today(f), recent, RUN_TS, PREV_RUN_TS, f.mapping
    )


@_query
def snapshot_a_faithful_delta(f):
    return plans.snapshot_incremental(
        f.previous, _today(f), f.events, RUN_TS, PREV_RUN_TS, f.mapping
    )


@_query
def snapshot_a_from_state(f):
    seen = f.events.filter(F.col("event_time") < RUN_TS)
    earlier = plans.advance_state(None, seen.filter(F.col("event_time") < PREV_RUN_TS))
    state = plans.advance_state(earlier, seen.filter(F.col("event_time") >= PREV_RUN_TS))
    return plans.snapshot_from_state(state, f.truthy_posts, RUN_TS, f.mapping)


@_query
def snapshot_b(f):
    return plans.snapshot_b(f.events, latest_posts(f.dumps, "strict"), RUN_TS)


@_query
def snapshot_b_three_lookups(f):
    return plans.assemble_b(
        latest_posts(f.dumps, "strict"),
        RUN_TS,
        engagement.engagement_b(f.events, RUN_TS),
        engagement.social_b(f.events, RUN_TS),
        engagement.conversions_b(f.events, RUN_TS),
    )


@_query
def snapshot_b_with_state(f):
    return plans.snapshot_b(f.events, latest_posts(f.dumps, "strict"), RUN_TS, f.mapping)


@_query
def rank_posts(f):
    return quality.rank_posts(snapshot_a_full(f))


@_query
def rank_posts_by_trials(f):
    return quality.rank_posts(snapshot_a_full(f), "post_day0_trials_per_view")


@_query
def rank_posts_by_initiates_per_view(f):
    return quality.rank_posts(snapshot_a_full(f), "post_day0_initiates_per_view")


@_query
def run_summary(f):
    return quality.run_summary(snapshot_a_incremental(f), f.previous)


@_query
def stream_snapshot(f):
    """Three batches: any event may come late, some come twice, some lie after the run."""
    folder = f.scratch()
    number = F.col("event_id").cast("bigint")
    runs = [PREV_RUN_TS, RUN_TS - 900_000, RUN_TS]
    for n in range(len(runs)):
        again = (number % 7 == 0) & (number % len(runs) < n)
        arrived = f.events.filter((number % len(runs) == n) | again)
        arrived.write.mode("append").parquet(f"{folder}/in")
        writer = stream_snapshots(
            read_event_stream(f.spark, f"{folder}/in"),
            out=f"{folder}/snapshots",
            state_dir=f"{folder}/state",
            checkpoint=f"{folder}/checkpoint",
            posts_at=lambda run_ts: f.truthy_posts,
            mapping=f.mapping,
            clock=lambda batch_id: runs[batch_id],
        )
        writer.trigger(availableNow=True).start().awaitTermination()
    return readers.read_snapshot(f.spark, f"{folder}/snapshots", RUN_TS + 60_000)


@_query
def scheduled_runs(f):
    """Scheduled runs while events arrive late, one run is made up for later, one breaks off half-way and one is repeated."""
    folder, number = f.scratch(), F.col("event_id").cast("bigint")

    def arrive(k: int) -> None:
        """A fourth of the events of every date, whatever runs there were before."""
        f.events.filter(number % 4 == k).write.mode("append").partitionBy("date").parquet(f"{folder}/events")

    def run(minutes: int) -> None:
        run_ts = RUN_TS - minutes * 60_000
        jobs.run_snapshot(f.spark, f"{folder}/events", f.path("dumps"), f.mapping, f"{folder}/snapshots", run_ts)

    f.dumps  # noqa: B018  (writes the dumps)
    arrive(0)
    run(45)
    arrive(1)
    run(15)
    arrive(2)
    run(30)
    # counters of one table and no entry in the log: what a run leaves that is lost on the way
    counters = Counters(f.spark, f"{folder}/snapshots_state")
    counters.write("by_post", counters.new_part(), post_partials(f.events.filter(number % 4 == 2)))
    arrive(3)
    run(0)
    run(0)
    return readers.read_snapshot(f.spark, f"{folder}/snapshots", RUN_TS + 60_000)


@_query
def run_catalogue(f):
    """Runs of some dates as the catalogue has them."""
    base = f.scratch()
    for days in (0, 1, 9):
        run_ts = RUN_TS - days * DAY_MS
        posts = f.truthy_posts.filter(F.col("created_ts") < run_ts).select(*schemas.POST.fieldNames())
        sinks.write_snapshot(plans.assemble_a(posts, f.no_metrics, run_ts, f.mapping), base, run_ts)
    found = readers.list_runs(f.spark, base, shift_day(TODAY, -7), TODAY)
    entries = [(d, r, readers.run_entry(f.spark, base, d, r)) for d, r in found]
    rows = [(d, r, e["run_ts"], e["rows"]) for d, r, e in entries]
    return f.spark.createDataFrame(rows, "date string, run string, run_ts bigint, rows bigint")


# Training


@_query
def per_view_ratios(f):
    kept = ["run_ts", "post_id", "views"]
    return training.with_ratios(f.series).select(*kept, *training.RATIOS)


@_query
def serving_context(f):
    e = parse_events(f.events, "post_id", "district_pid", "state_pid")
    names = f.places.select(F.col("id").alias("state_pid"), F.col("name").alias("serving_state"))
    tier = F.element_at(
        F.array(F.lit("district"), F.lit("state"), F.lit("national")),
        (F.col("event_id").cast("int") % 3 + 1),
    )
    requests = e.join(names, "state_pid", "left").select(
        "event_id",
        "user_id",
        "event_time",
        "post_id",
        F.col("district_pid").alias("serving_district_pid"),
        "serving_state",
        F.lit("en").alias("serving_lang"),
        tier.alias("tier"),
    )
    return training.with_serving_context(requests, with_state(f.posts, f.mapping))


def _training(f):
    series = f.series  # first, so that labels take their grid from it
    return training.training_data(f.labels(), series, f.features, START, END)


@_query
def training_data(f):
    return _training(f)


@_query
def training_data_lagged_features(f):
    series = f.series
    return training.training_data(
        f.labels("7d"), series, f.features, START, END, feature_lag_days=1
    )


@_query
def dataset_stats(f):
    return quality.dataset_stats(_training(f))


@_query
def class_weights(f):
    return training.balance(f.labels())


@_query
def stratified_sample(f):
    return training.balance(f.labels(), "sample", {0: 0.5, 1: 1.0, 2: 1.0})


@_query
def exact_stratified_sample(f):
    return training.stratified_sample(f.labels(), "y", {0: 0.5, 1: 1.0, 2: 0.25}, SAMPLE_KEYS, "tidemark")


# Tables written and read back


@_query
def roundtrip_event_log(f):
    f.events  # noqa: B018  (writes the log)
    wanted = [VOCAB_A.locked, VOCAB_A.initiate]
    return readers.read_events(f.spark, f.path("events"), START, END, wanted).drop("platform")


@_query
def roundtrip_dumps(f):
    f.dumps  # noqa: B018  (writes the dumps)
    dumps = readers.read_dumps(f.spark, f.path("dumps"), SINCE, TODAY)
    return dumps.select("event_name", "data", "date")


@_query
def roundtrip_snapshot_jsonl(f):
    base = f.scratch()
    sinks.write_snapshot(snapshot_a_full(f), base, RUN_TS)
    sinks.write_snapshot(f.spark.createDataFrame([], schemas.SNAPSHOT), base, RUN_TS + 900_000)
    return readers.read_snapshot(f.spark, base, RUN_TS + 900_000)


@_query
def roundtrip_snapshot_ts(f):
    base = f.scratch()
    sinks.write_snapshot(snapshot_b(f), base, RUN_TS, layout="ts")
    return readers.read_snapshot_ts(f.spark, base, RUN_TS)


@_query
def roundtrip_features(f):
    base = f.scratch()
    for _ in range(2):
        sinks.write_features(creator_features_events(f), base, "creator", REF)
    return readers.features_table(f.spark, base, "creator", FEATURE_DATES[0], REF)


@_query
def roundtrip_labels(f):
    base = f.scratch()
    for _ in range(2):
        sinks.write_labels(_labels(f), base)
    return readers.labels_table(f.spark, base, START, END)


@_query
def roundtrip_training(f):
    base = f.scratch()
    sinks.write_training(_training(f), base)
    return f.spark.read.parquet(base).select(*training.TRAINING_COLUMNS)


@_query
def roundtrip_place_map(f):
    path = f.scratch()
    sinks.write_place_map(f.mapping, path)
    return readers.read_place_rows(f.spark, path)


@_query
def registered_tables(f):
    base, name = f.scratch(), f"tidemark_{uuid.uuid4().hex}"
    sinks.write_snapshot(snapshot_a_full(f), f"{base}/snapshots", RUN_TS)
    sinks.write_labels(_labels(f), f"{base}/labels")
    f.spark.sql(f"CREATE DATABASE {name} LOCATION '{base}/db'")
    sinks.create_tables(f.spark, f"{base}/snapshots", f"{base}/labels", name)
    counts = []
    for table in ("dynamic_snapshots", "training_labels"):
        sinks.register_partitions(f.spark, f"{name}.{table}")
        rows = f.spark.table(f"{name}.{table}").groupBy("date").agg(F.count(F.lit(1)).alias("n"))
        counts.append(rows.withColumn("table_name", F.lit(table)))
    return counts[0].unionByName(counts[1])


@_query
def roundtrip_place_object(f):
    path = f.scratch()
    entry = F.struct("district_name", "state_name", "state_pid")
    whole = F.to_json(F.map_from_entries(F.collect_list(F.struct("district_pid", entry))))
    f.mapping.agg(whole.alias("value")).write.text(path)
    return readers.read_place_map(f.spark, path)


@_query
def roundtrip_places(f):
    path = f.scratch()
    f.places.agg(F.to_json(F.collect_list(F.struct(*f.places.columns))).alias("value")).write.text(path)
    return readers.read_places(f.spark, path).select(*f.places.columns)


@_query
def roundtrip_iso_times(f):
    """Snapshot rows whose run time is ISO text."""
    base, run = f.scratch(), run_params(RUN_TS)
    rows = snapshot_a_full(f).withColumn("run_ts", F.lit(run.iso))
    rows.write.json(f"{base}/date={run.date}/run={run.slot}")
    return readers.snapshots_table(f.spark, base, TODAY, TODAY).select(*schemas.SNAPSHOT_COLUMNS)


@_query
def roundtrip_cold_start(f):
    base = f.scratch()
    sinks.write_snapshot(snapshot_a_full(f), base, RUN_TS)
    days = [shift_day(TODAY, n) for n in (0, 1, 2)]
    return f.spark.createDataFrame([(d, readers.is_cold_start(f.spark, base, d)) for d in days], "date string, cold boolean")


@_query
def roundtrip_corrected_labels(f):
    """A range written again after one of its dates lost all its labels."""
    base, owned = f.scratch(), sinks.dates_between(START, END)
    sinks.write_labels(f.labels(), base, owned)
    sinks.write_labels(f.labels().filter(F.col("date") != TIMING_DATE), base, owned)
    return f.spark.read.schema(schemas.LABELS).parquet(base)


@_query
def finished_table(f):
    return readers.as_table(f.labels(), f"tidemark_finished_{uuid.uuid4().hex}")
