"""Snapshots from an event stream.

Each micro-batch adds a part to the counters at rest (:mod:`tidemark.counters`) and one entry to their log; a snapshot sums
the parts over the window. A replayed batch is known by its number and counts nothing, a half-written one was never
counted, and days past the window leave with their parts. Events count once, by their ids, also when they come late; those
at or after a run wait for the next one.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tidemark import schemas
from tidemark.counters import LATER, Counters, Entry, Part
from tidemark.functions import run_params, shift_day
from tidemark.functions.dates import FEED_TZ
from tidemark.operators.partials import post_partials, user_partials
from tidemark.plans.snapshots import snapshot_from_state
from tidemark.session import drop_staged
from tidemark.sources.sinks import write_snapshot
from tidemark.vocab import VOCAB_A, Vocabulary

State = tuple[DataFrame, DataFrame]


def read_event_stream(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """Event-log files as they arrive."""
    return spark.readStream.schema(schemas.EVENT_LOG).options(**options).parquet(path)


def new_events(batch: DataFrame, counters: Counters, head: Entry | None) -> DataFrame:
    """Events of a batch that no earlier batch had, however late they come.

    Ids are kept by event date; only those of the batch's own dates are read.
    """
    rows = batch.dropDuplicates(["date", "event_id"])
    dates = sorted(r["date"] for r in batch.select("date").distinct().collect() if r["date"] is not None)
    if head is None or not dates:
        return rows
    seen = counters.read("ids", head, dates[0], dates[-1]).filter(F.col("date").isin(dates))
    return rows.join(seen, ["date", "event_id"], "left_anti").select(*batch.columns)


def count_batch(
    counters: Counters,
    head: Entry | None,
    events: DataFrame,
    batch: int,
    run_ts: int,
    oldest: str,
    vocab: Vocabulary = VOCAB_A,
    sources: Part | None = None,
    anew: bool = False,
    ids: bool = False,
) -> Entry:
    """Counts the events before a run, of this batch and of those put off so far, and puts the later ones off.

    ``sources`` is a part that holds the files the events were read from, ``ids`` keeps their ids. All of it counts with
    the one entry added last. Parts are merged after that, as need be.
    """
    name = sources.name if sources else counters.new_part()
    dates = dict(sources.dates) if sources else {}
    if ids:
        dates["ids"] = counters.write("ids", name, events.select("date", "event_id"))
    waiting = events if anew or head is None or head.later is None else events.unionByName(counters.put_off(head))
    later = waiting.filter(F.col("event_time") >= run_ts)
    rest = counters.new_part()
    put_off = counters.write(LATER, rest, later)
    due = waiting.filter(F.col("event_time") < run_ts)
    dates["by_post"] = counters.write("by_post", name, post_partials(due, vocab))
    dates["by_user"] = counters.write("by_user", name, user_partials(due, vocab))
    part = Part(name, 0, 1, dates)
    entry = counters.commit(head, batch, run_ts, part, oldest, Part(rest, 0, 0, {LATER: put_off}), anew)
    return counters.compact(entry, oldest)


#: A time and a date beyond all others, for counts without a window.
_NEVER, _EVER = 1 << 62, ""


def append_partials(
    batch: DataFrame, batch_id: int, state_dir: str, vocab: Vocabulary = VOCAB_A
) -> None:
    """Counts a batch unless it was counted before."""
    counters = Counters(batch.sparkSession, state_dir)
    head = counters.head()
    if head is None or batch_id > head.batch:
        count_batch(counters, head, batch, batch_id, _NEVER, _EVER, vocab)


def read_state(
    spark: SparkSession, state_dir: str, start: str | None = None, end: str | None = None
) -> State:
    """(per post, per user) counters of all batches so far, of a range of event dates.

    Only the folders of these dates are opened.
    """
    counters = Counters(spark, state_dir)
    head = counters.head()
    return counters.read("by_post", head, start, end), counters.read("by_user", head, start, end)


def stream_snapshots(
    stream: DataFrame,
    out: str,
    state_dir: str,
    checkpoint: str,
    posts_at: Callable[[int], DataFrame],
    mapping: DataFrame,
    clock: Callable[[int], int],
    days: int = 7,
    tz: str = FEED_TZ,
    vocab: Vocabulary = VOCAB_A,
) -> DataStreamWriter:
    """Writer that keeps the counters and writes one snapshot per micro-batch.

    ``clock`` gives the run time of a batch id and ``posts_at`` the posts of a run time. The
    caller sets the trigger (15 minutes in production) and starts it. All folders must be
    shared by the executors.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        spark, run_ts = batch.sparkSession, clock(batch_id)
        today = run_params(run_ts, tz).date
        oldest = shift_day(today, -days)
        counters = Counters(spark, state_dir)
        head = counters.head()
        if head is None or batch_id > head.batch:
            # Four tables are counted from the batch, each from few of its columns and kinds of events.
            staged = f"{state_dir.rstrip('/')}/batches/{uuid.uuid4().hex}"
            try:
                new_events(batch, counters, head).write.parquet(staged)
                fresh = spark.read.schema(batch.schema).parquet(staged)
                count_batch(counters, head, fresh, batch_id, run_ts, oldest, vocab, ids=True)
            finally:
                drop_staged(spark, staged)
        # Event dates may be those of another zone, up to a day ahead of the run's.
        state = read_state(spark, state_dir, oldest, shift_day(today, 1))
        snapshot = snapshot_from_state(state, posts_at(run_ts), run_ts, mapping, days, tz)
        write_snapshot(snapshot, out, run_ts, tz=tz)

    return stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
