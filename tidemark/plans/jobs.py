"""The scheduled runs: sources, one plan, sinks."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark import files, schemas
from tidemark.counters import Counters, Entry, Part
from tidemark.functions import day_ms, run_params, shift_day, window_bounds
from tidemark.functions.dates import FEED_TZ
from tidemark.functions.scalars import DAY_MS
from tidemark.operators.labels import (
    POLICIES,
    flag_views,
    label_views,
    matched_views,
    scan_conversions,
)
from tidemark.operators.posts import latest_posts, merge_posts
from tidemark.operators.prefixes import KEYS, blocks, daily_counts, loo_counts_on
from tidemark.operators.training import training_data
from tidemark.plans.daily import advance_sliding, advance_sliding_over, daily_features, daily_features_sliding
from tidemark.plans.snapshots import snapshot_from_state, snapshot_full, snapshot_incremental
from tidemark.session import drop_staged, shared_dir
from tidemark.sources.readers import (
    event_files,
    features_table,
    is_cold_start,
    labels_table,
    latest_run,
    prefix_blocks,
    prefix_range,
    prefix_table,
    read_dumps,
    read_event_files,
    read_events,
    read_snapshot,
    sliding_table,
    snapshots_table,
)
from tidemark.sources.sinks import (
    dates_between,
    write_features,
    write_labels,
    write_prefixes,
    write_sliding,
    write_sliding_dates,
    write_snapshot,
    write_training,
)
from tidemark.streaming.snapshots import count_batch
from tidemark.vocab import VOCAB_A, Vocabulary


def run_snapshot(
    spark: SparkSession,
    events_path: str,
    dumps_path: str,
    mapping: DataFrame,
    base: str,
    run_ts: int,
    days: int = 7,
    tz: str = FEED_TZ,
    vocab: Vocabulary = VOCAB_A,
    faithful_delta: bool = False,
) -> str:
    """One snapshot run. Returns ``full``, ``backfill`` or ``incremental``.

    A cold start reads the dumps and events of the whole window and begins the counters beside ``base`` anew. Any later run
    reads today's dumps, the previous snapshot and the event files that no run has counted, whatever the dates in them,
    adds them to the counters and finishes the snapshot from these: late files and late events are in the next snapshot,
    conversions pair across runs, and days expire. A repeated run counts what arrived in between. A run before the last
    counted one is worked out from the log and leaves the counters alone. Each equals a full rebuild at its time.

    Of two runs at a time, one fails with FileExistsError and can be repeated. ``faithful_delta`` adds up snapshots
    instead, which pairs within the delta only and keeps no counters.
    """
    now = run_params(run_ts, tz)
    since_date, until_date = shift_day(now.date, -days), shift_day(now.date, 1)
    counters = Counters(spark, f"{base.rstrip('/')}_state")
    head = None if faithful_delta else counters.head()
    slot = None if is_cold_start(spark, base, now.date) else latest_run(spark, base, run_ts, tz)
    backfill = head is not None and run_ts < head.until
    if backfill or slot is None or (head is None and not faithful_delta):
        posts = latest_posts(read_dumps(spark, dumps_path, since_date, now.date), "truthy")
        if backfill or faithful_delta:
            events = read_events(spark, events_path, since_date, until_date)
            snapshot = snapshot_full(events, posts, run_ts, mapping, days, tz, vocab)
        else:
            head = count_arrivals(counters, head, events_path, since_date, until_date, run_ts, vocab, anew=True)
            snapshot = _from_counters(counters, head, posts, run_ts, mapping, days, tz)
        write_snapshot(snapshot, base, run_ts, tz=tz)
        return "backfill" if backfill else "full"
    today = latest_posts(read_dumps(spark, dumps_path, now.date, now.date), "truthy")
    previous = read_snapshot(spark, base, run_ts, tz)
    if faithful_delta:
        events = read_events(spark, events_path, since_date, until_date)
        prev_ts = previous.agg(F.max("run_ts")).first()[0]
        if prev_ts is None:  # a run without posts; its slot is known to the minute
            date, run = slot
            prev_ts = day_ms(date, tz) + (int(run[:2]) * 60 + int(run[2:])) * 60_000
        snapshot = snapshot_incremental(previous, today, events, run_ts, prev_ts, mapping, days, tz, vocab)
    else:
        head = count_arrivals(counters, head, events_path, since_date, until_date, run_ts, vocab)
        posts = merge_posts(today, previous, run_ts - days * DAY_MS)
        snapshot = _from_counters(counters, head, posts, run_ts, mapping, days, tz)
    write_snapshot(snapshot, base, run_ts, tz=tz)
    return "incremental"


def count_arrivals(
    counters: Counters,
    head: Entry | None,
    events_path: str,
    first: str,
    last: str,
    run_ts: int,
    vocab: Vocabulary = VOCAB_A,
    anew: bool = False,
) -> Entry:
    """Counts the event files of some dates that are not in the counters' ledger, and enters them there.

    The files are written down first and then read by that list, so that what is counted is what the ledger holds.
    """
    spark, name = counters.spark, counters.new_part()
    listed = event_files(spark, events_path, first, last)
    if head is not None and not anew:
        listed = listed.join(counters.read("files", head, first, last).select("uri"), "uri", "left_anti")
    found = Part(name, 0, 1, {"files": counters.write("files", name, listed)})
    events = read_event_files(spark, events_path, counters.read_part("files", found))
    batch = 1 if head is None else head.batch + 1
    return count_batch(counters, head, events, batch, run_ts, first, vocab, sources=found, anew=anew)


def _from_counters(
    counters: Counters, head: Entry, posts: DataFrame, run_ts: int, mapping: DataFrame, days: int, tz: str
) -> DataFrame:
    today = run_params(run_ts, tz).date
    state = tuple(counters.read(t, head, shift_day(today, -days), shift_day(today, 1)) for t in ("by_post", "by_user"))
    return snapshot_from_state(state, posts, run_ts, mapping, days, tz)


def run_daily(
    spark: SparkSession,
    events_path: str,
    dumps_path: str,
    mapping: DataFrame,
    base: str,
    ref: str,
    tz: str = FEED_TZ,
    vocab: Vocabulary = VOCAB_A,
) -> dict[str, int]:
    """The four feature tables of one date. Returns the rows written to each."""
    bounds = window_bounds(ref, tz)
    events = read_events(spark, events_path, bounds.first_date, bounds.last_date)
    dumps = read_dumps(spark, dumps_path, bounds.first_date, bounds.last_date)
    tables = daily_features(latest_posts(dumps), events, mapping, ref, tz, vocab=vocab)
    written = {}
    for kind, table in tables.items():
        # Counted while it is written, without a second run of the plan.
        counted = Observation()
        rows = table.observe(counted, F.count(F.lit(1)).alias("rows"))
        write_features(rows, base, kind, ref)
        written[kind] = counted.get["rows"]
    return written


def run_daily_sliding(
    spark: SparkSession,
    events_path: str,
    dumps_path: str,
    mapping: DataFrame,
    base: str,
    ref: str,
    tz: str = FEED_TZ,
    vocab: Vocabulary = VOCAB_A,
) -> int:
    """The four feature tables of a date from sliding tables beside ``base``. Returns how many dates of events were read: one.

    Dates that are missing since the last run, or the two windows and a day before the first one, are made up for in one pass.
    A date run again replaces its own tables; run those after it again if its events have changed.
    """
    state = f"{base.rstrip('/')}_sliding"
    wanted = dates_between(shift_day(ref, -15), ref)
    done = [d for d in wanted[:-1] if files.present(spark, [f"{state}/totals/date={d}"])]
    missing = [d for d in wanted if not done or d > done[-1]]
    if len(missing) > 1:
        advance_days(spark, events_path, state, missing[0], missing[-1], tz, vocab)
    else:
        advance_day(spark, events_path, state, missing[0], tz, vocab)
    bounds = window_bounds(ref, tz)
    posts = latest_posts(read_dumps(spark, dumps_path, bounds.first_date, bounds.last_date))
    seen, totals = sliding_table(spark, state, "seen", [ref]), sliding_table(spark, state, "totals", wanted)
    for kind, rows in daily_features_sliding(posts, seen, totals, mapping, ref, tz).items():
        write_features(rows, base, kind, ref)
    return len(missing)


def advance_day(
    spark: SparkSession, events_path: str, state: str, date: str, tz: str = FEED_TZ, vocab: Vocabulary = VOCAB_A
) -> None:
    """Writes the sliding tables of a date; reads the events of that date and the tables of the one before."""
    before = [sliding_table(spark, state, t, [shift_day(date, -1)]) for t in ("seen", "totals")]
    tables = advance_sliding(*before, read_events(spark, events_path, date, date), date, tz, vocab=vocab)
    for name, rows in zip(("seen", "totals"), tables, strict=True):
        write_sliding(rows, state, name, date)


def advance_days(
    spark: SparkSession, events_path: str, state: str, first: str, last: str, tz: str = FEED_TZ, vocab: Vocabulary = VOCAB_A
) -> None:
    """Writes the sliding tables of a range of dates as :func:`advance_day` would one after the other, in one pass over its events."""
    before = [sliding_table(spark, state, t, [shift_day(first, -1)]) for t in ("seen", "totals")]
    tables = advance_sliding_over(*before, read_events(spark, events_path, first, last), first, last, tz, vocab=vocab)
    for name, rows in zip(("seen", "totals"), tables, strict=True):
        write_sliding_dates(rows, state, name, dates_between(first, last))


def advance_prefixes(
    spark: SparkSession, events_path: str, base: str, first: str, last: str, vocab: Vocabulary = VOCAB_A
) -> None:
    """Writes the counts at rest (:mod:`tidemark.operators.prefixes`) of a range of dates, in one pass over its events.

    Blocks by post are summed from those by post and user that end on the same dates, once these are written.
    The range begins the counts or follows on what is there. A range that was counted before is written again, for late
    events; dates after it then have to be counted again too, and are no longer offered until they are.
    """
    known = prefix_range(spark, base)
    since, done = known or (first, shift_day(first, -1))
    if not since <= first <= shift_day(done, 1):
        raise ValueError(f"counts at rest hold {since} to {done}; {first} neither lies in them nor follows")
    # Blocks of the range and after it do not count while they are rewritten.
    before, ends = shift_day(first, -1), f"{base.rstrip('/')}/dates.json"
    if known is None or first <= done:
        files.write(spark, ends, json.dumps([since, before]))
    events = read_events(spark, events_path, before, shift_day(last, 1))
    day, owned = daily_counts(events, first, last, vocab=vocab), dates_between(first, last)
    stored = prefix_table(spark, base, "by_user", before)
    write_prefixes(blocks(day, stored, KEYS["by_user"], since, first, last), base, "by_user", owned)
    names = [c for c in day.columns if c not in ("post_id", "user_id", "date")]
    by_user = prefix_blocks(spark, base, "by_user", owned)
    write_prefixes(by_user.groupBy(*KEYS["by_post"], "date").agg(*[F.sum(n).alias(n) for n in names]), base, "by_post", owned)
    files.write(spark, ends, json.dumps([since, last]))


def views_with_others(
    spark: SparkSession,
    views: DataFrame,
    events_path: str,
    base: str,
    date: str,
    last: str | None = None,
    vocab: Vocabulary = VOCAB_A,
) -> DataFrame:
    """Leave-one-out counts of the views of a UTC day, or of the days from ``date`` to ``last``, from the counts at rest up to the
    day before and the events of these days."""
    before = {table: prefix_table(spark, base, table, shift_day(date, -1)) for table in KEYS}
    events = read_events(spark, events_path, shift_day(date, -1), shift_day(last or date, 1))
    return loo_counts_on(views, events, before, date, last, vocab=vocab)


def run_labels(
    spark: SparkSession,
    events_path: str,
    snapshots_base: str,
    base: str,
    start: str,
    end: str,
    window: str = "same_day",
    tz: str = "UTC",
    vocab: Vocabulary = VOCAB_A,
    day0: str = "event_age",
    per_view: bool = False,
    lag_ms: int = 0,
) -> None:
    """Labels of a date range; dates of it without labels end up empty.

    Flagged views feed both the snapshot groups and the rows that read the groups back, so
    they are staged once, in a folder of this run's own, instead of being worked out twice.
    """
    policy = POLICIES[window]
    events = read_events(spark, events_path, start, shift_day(end, policy.scan_days))
    snapshots = snapshots_table(spark, snapshots_base, shift_day(start, -2), shift_day(end, 1))
    views = matched_views(events, snapshots, start, end, day0, lag_ms, vocab)
    flagged = flag_views(views, scan_conversions(events, start, end, policy, vocab), policy, tz, vocab)
    folder = f"{shared_dir(spark)}/flagged_views/{uuid.uuid4().hex}"
    try:
        flagged.write.parquet(folder)
        staged = spark.read.schema(flagged.schema).parquet(folder)
        write_labels(label_views(staged, per_view, tz), base, owned=dates_between(start, end))
    finally:
        drop_staged(spark, folder)


def run_training(
    spark: SparkSession,
    labels_base: str,
    snapshots_base: str,
    features_base: str,
    base: str,
    start: str,
    end: str,
    tz: str = "UTC",
    feature_lag_days: int = 0,
) -> None:
    """The training table of a date range."""
    first = shift_day(start, -feature_lag_days)
    features = {k: features_table(spark, features_base, k, first, end) for k in schemas.FEATURES}
    labels = labels_table(spark, labels_base, start, end, tz)
    snapshots = snapshots_table(spark, snapshots_base, shift_day(start, -1), shift_day(end, 1))
    rows = training_data(labels, snapshots, features, start, end, tz, feature_lag_days)
    write_training(rows, base, tz, owned=dates_between(start, end))


__all__ = ["run_daily", "run_daily_sliding", "run_labels", "run_snapshot", "run_training"]
