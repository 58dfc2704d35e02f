"""Readers, sinks, scheduled runs and streams on real folders."""

import json

import pytest
from frames import T0, dump, dump_frame, event_frame, first_call, initiate, lock, rows, trial
from test_snapshots import post_frame, random_log

from tidemark import schemas
from tidemark.functions import run_params, shift_day
from tidemark.functions.scalars import DAY_MS
from tidemark.operators.training import TRAINING_COLUMNS
from tidemark.plans import jobs
from tidemark.plans import snapshots as sn
from tidemark.session import shared_dir
from tidemark.sources import readers, sinks
from tidemark.streaming import snapshots as st

RUN = T0
SLOT = 15 * 60_000


@pytest.fixture(scope="module")
def mapping(spark):
    return spark.createDataFrame([("d1", "One", "North", "s1")], schemas.PLACE_MAP)


def snapshot(spark, mapping, run_ts, n=2):
    return sn.snapshot_full(event_frame(spark, []), post_frame(spark, n), run_ts, mapping)


def test_latest_snapshot_is_found_across_midnight(spark, mapping, tmp_path):
    base = str(tmp_path / "snapshots")
    assert readers.is_cold_start(spark, base, "2024-01-12")
    assert readers.read_snapshot(spark, base, RUN).count() == 0
    midnight = 1_704_997_800_000  # 2024-01-12 00:00 in the feed's zone
    for n, run_ts in ((1, midnight - 2 * SLOT), (2, midnight - SLOT), (3, midnight)):
        sinks.write_snapshot(snapshot(spark, mapping, run_ts, n), base, run_ts)
    assert readers.latest_run(spark, base, midnight) == ("2024-01-11", "2345")
    assert readers.read_snapshot(spark, base, midnight).count() == 2
    assert readers.read_snapshot(spark, base, midnight + SLOT).count() == 3
    assert not readers.is_cold_start(spark, base, "2024-01-13")
    assert readers.is_cold_start(spark, base, "2024-01-14")
    assert readers.snapshots_table(spark, base, "2024-01-12").count() == 3


def test_snapshot_files_keep_nulls_and_may_hold_iso_times(spark, mapping, tmp_path):
    base = str(tmp_path / "snapshots")
    sinks.write_snapshot(snapshot(spark, mapping, RUN, 1).selectExpr(
        *[c if c != "topic" else "cast(null as string) topic" for c in schemas.SNAPSHOT_COLUMNS]
    ), base, RUN)
    now = run_params(RUN)
    text = spark.read.text(f"{base}/date={now.date}/run={now.slot}").first().value
    line = json.loads(text)
    assert line["topic"] is None and line["run_ts"] == RUN
    line["run_ts"] = now.iso
    folder = tmp_path / "iso" / f"date={now.date}" / f"run={now.slot}"
    folder.mkdir(parents=True)
    (folder / "snapshot.jsonl").write_text(json.dumps(line))
    assert readers.snapshots_table(spark, str(tmp_path / "iso")).first().run_ts == RUN // 1000 * 1000


def test_missing_dates_are_skipped(spark, tmp_path):
    base = str(tmp_path / "dumps")
    frame = dump_frame(spark, [dump("2024-01-01", id="a"), dump("2024-01-04", id="b")])
    frame.write.partitionBy("event_name", "date").parquet(base)
    assert readers.read_dumps(spark, base, "2024-01-02", "2024-01-05").count() == 1
    assert readers.read_dumps(spark, base, "2024-01-02", "2024-01-03").count() == 0


def test_place_files(spark, mapping, tmp_path):
    places = [
        {"id": "s1", "ty": "STATE", "name": "North"},
        {"id": "d1", "ty": "DISTRICT", "name": "One", "parentId": "s1", "extra": 1},
    ]
    (tmp_path / "places.json").write_text(json.dumps(places, indent=1))
    assert readers.read_places(spark, str(tmp_path / "places.json")).count() == 2
    entry = {"district_name": "One", "state_name": "North", "state_pid": "s1"}
    (tmp_path / "map.json").write_text(json.dumps({"d1": entry, "d2": entry}, indent=2))
    found = readers.read_place_map(spark, str(tmp_path / "map.json"))
    assert rows(found, "district_pid", "state_name") == [("d1", "North"), ("d2", "North")]
    sinks.write_place_map(mapping, str(tmp_path / "out"))
    assert rows(readers.read_place_rows(spark, str(tmp_path / "out"))) == rows(mapping)


def test_writes_replace_only_their_partitions(spark, tmp_path):
    base = str(tmp_path / "labels")
    label = lambda user, y, date: (user, "p", T0, T0, y, date)
    make = lambda *r: spark.createDataFrame(list(r), schemas.LABELS)
    sinks.write_labels(make(label("a", 0, "2024-01-11"), label("b", 0, "2024-01-12")), base)
    for _ in range(2):
        sinks.write_labels(make(label("c", 1, "2024-01-12")), base)
    table = readers.labels_table(spark, base)
    assert rows(table, "user_id", "date") == [("a", "2024-01-11"), ("c", "2024-01-12")]
    assert readers.labels_table(spark, base, "2024-01-11", "2024-01-11").count() == 2
    assert readers.labels_table(spark, base, "2024-01-12").count() == 0


def test_as_table(spark):
    readers.as_table(spark.range(3), "finished_result")
    assert spark.sql("select count(*) n from finished_result").first().n == 3


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def _write_sources(spark, tmp_path, log, dumps):
    event_frame(spark, log).write.partitionBy("date").parquet(str(tmp_path / "events"))
    dump_frame(spark, dumps).write.partitionBy("event_name", "date").parquet(str(tmp_path / "dumps"))
    return str(tmp_path / "events"), str(tmp_path / "dumps")


def test_scheduled_runs_end_to_end(spark, mapping, tmp_path):
    date = run_params(T0).date
    meta = dict(topic="t", subTopic="s", contentLang="en", isReporter=True, creatorID="c1")
    post = lambda day, i, age: dump(
        day, id=f"p{i}", created=T0 - age * DAY_MS, location={"pid": "d1"}, **meta
    )
    dumps = [post(shift_day(date, -1), 0, 1), post(date, 1, 0), post(shift_day(date, -9), 2, 10)]
    prior = T0 - 9 * DAY_MS
    log = [
        lock(1, prior, "w", "p2"),
        initiate(2, prior + 1, "w", "p2"),
        first_call(3, T0 - 60_000, "u"),
        lock(4, T0 - 10_000, "u", "p0"),  # in the minute of the first run, before it
        lock(5, T0 + 60_000, "u", "p0"),
        initiate(6, T0 + 120_000, "u", "p0"),
        lock(7, T0 + SLOT + 60_000, "v", "p1"),
        trial(8, T0 + SLOT + 70_000, "v"),
    ]
    events, dump_path = _write_sources(spark, tmp_path, log, dumps)
    out = {k: str(tmp_path / k) for k in ("snapshots", "labels", "features", "training")}

    args = (spark, events, dump_path, mapping, out["snapshots"])
    assert jobs.run_snapshot(*args, T0) == "full"
    assert jobs.run_snapshot(*args, T0 + SLOT) == "incremental"
    assert jobs.run_snapshot(*args, T0 + SLOT) == "incremental"  # a repeated run
    second = readers.read_snapshot(spark, out["snapshots"], T0 + 2 * SLOT)
    assert rows(second, "post_id", "views", "post_day0_locks", "post_day0_initiates") == [
        ("p0", 2, 2, 2),  # both locks pair with the later initiate
        ("p1", 0, 0, 0),
    ]
    assert jobs.run_snapshot(*args, T0 + SLOT, faithful_delta=True) == "incremental"
    faithful = readers.read_snapshot(spark, out["snapshots"], T0 + 2 * SLOT)
    assert rows(faithful, "post_id", "post_day0_initiates") == [("p0", 1), ("p1", 0)]
    assert jobs.run_snapshot(*args, T0 + SLOT) == "incremental"
    # Snapshots lie under the feed's date, labels under the UTC date of the view.
    utc = shift_day(date, -1) if run_params(T0).slot < "0530" else date
    for _ in range(2):
        jobs.run_labels(spark, events, out["snapshots"], out["labels"], utc, date)
    options = dict(window="horizon3d", day0="first_call", per_view=True, lag_ms=0)
    jobs.run_labels(spark, events, out["snapshots"], str(tmp_path / "other"), utc, date, **options)
    assert rows(readers.labels_table(spark, str(tmp_path / "other")), "user_id", "y") == [("u", 1)]
    labels = readers.labels_table(spark, out["labels"])
    assert rows(labels, "user_id", "post_id", "run_ts", "y") == [
        ("u", "p0", T0, 1),
        ("v", "p1", T0 + SLOT, 2),
    ]
    written = jobs.run_daily(spark, events, dump_path, mapping, out["features"], date)
    assert written["creator"] == 1 and set(written) == set(schemas.FEATURES)
    creator = readers.features_table(spark, out["features"], "creator", date, date).first()
    assert (creator.creatorID, creator.creator_prior_rate, creator.creator_verified) == ("c1", 1.0, True)
    jobs.run_training(
        spark, out["labels"], out["snapshots"], out["features"], out["training"], utc, date
    )
    train = spark.read.parquet(out["training"])
    assert set(train.columns) == {*TRAINING_COLUMNS, "date"} and len(TRAINING_COLUMNS) == 54
    assert rows(train, "user_id", "y", "views") == [("u", 1, 1), ("v", 2, 0)]


def test_stream_of_many_batches_equals_one_batch(spark, mapping, tmp_path):
    log = sorted(random_log(n=240, seed=8, start=T0 - 2 * 3_600_000, span=2 * 3_600_000), key=lambda e: e[1])
    source = tmp_path / "in"
    # Each file also repeats the last events of the one before.
    for n in range(4):
        part = log[max(n * 60 - 10, 0) : n * 60 + 60]
        event_frame(spark, part).coalesce(1).write.mode("append").parquet(str(source))
    posts = post_frame(spark, 7)
    runs = []

    def clock(batch_id):
        runs.append(T0 + batch_id * SLOT)
        return runs[-1]

    def start():
        stream = st.read_event_stream(spark, str(source), maxFilesPerTrigger="1")
        writer = st.stream_snapshots(
            stream, str(tmp_path / "out"), str(tmp_path / "state"), str(tmp_path / "check"),
            lambda run_ts: posts, mapping, clock,
        )
        writer.trigger(availableNow=True).start().awaitTermination()

    start()
    assert len(runs) >= 4
    last = readers.read_snapshot(spark, str(tmp_path / "out"), max(runs) + SLOT)
    full = sn.snapshot_full(event_frame(spark, log), posts, max(runs), mapping)
    columns = [c for c in schemas.SNAPSHOT_COLUMNS if c != "run_ts"]
    assert rows(last, *columns) == rows(full, *columns)
    start()  # nothing new
    again = readers.read_snapshot(spark, str(tmp_path / "out"), max(runs) + SLOT)
    assert rows(again, *columns) == rows(full, *columns)


def test_replayed_batch_changes_nothing(spark, tmp_path):
    batch = event_frame(spark, random_log(n=80))
    for batch_id in (0, 1, 1):
        st.append_partials(batch, batch_id, str(tmp_path))
    by_post, by_user = st.read_state(spark, str(tmp_path))
    want = sn.advance_state(None, batch)
    assert by_post.groupBy().sum("locks").first()[0] == 2 * want[0].groupBy().sum("locks").first()[0]
    assert by_user.groupBy().sum("trials").first()[0] == 2 * want[1].groupBy().sum("trials").first()[0]


def test_a_batch_is_staged_and_its_staged_rows_go(spark, tmp_path, mapping, monkeypatch):
    event_frame(spark, [lock(i, T0 - i, "u1", "p1") for i in range(3)]).write.parquet(str(tmp_path / "in"))
    plans, real = [], st.count_batch
    seen = lambda c, h, events, *a, **k: plans.append(events._jdf.queryExecution().optimizedPlan().toString()) or real(c, h, events, *a, **k)
    monkeypatch.setattr(st, "count_batch", seen)
    writer = st.stream_snapshots(
        st.read_event_stream(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "state"), str(tmp_path / "check"),
        lambda run_ts: post_frame(spark, 2), mapping, lambda batch_id: T0,
    )
    writer.trigger(availableNow=True).start().awaitTermination()
    assert plans and not any("InMemory" in p for p in plans)
    assert not list((tmp_path / "state" / "batches").iterdir())
