"""The log of counted batches: late, made-up, repeated, broken-off and rival runs, tiers, expiry, the run catalogue."""

import os

import pytest
from frames import T0, dump, dump_frame, event_frame, first_call, initiate, lock, rows, trial
from test_snapshots import random_log

from tidemark import counters as ct
from tidemark import files, schemas
from tidemark.functions import run_params, shift_day
from tidemark.operators.partials import post_partials, user_partials
from tidemark.operators.training import stratified_sample
from tidemark.plans import jobs
from tidemark.plans import snapshots as sn
from tidemark.sources import readers, sinks
from tidemark.streaming import snapshots as st

SLOT = 15 * 60_000
COLUMNS = [c for c in schemas.SNAPSHOT_COLUMNS if c != "run_ts"]


class World:
    """An event log, dumps and snapshots in a folder."""

    def __init__(self, spark, tmp_path, posts=4):
        self.spark, self.base = spark, str(tmp_path / "snapshots")
        self.events, self.dumps = str(tmp_path / "events"), str(tmp_path / "dumps")
        self.mapping = spark.createDataFrame([("d1", "One", "North", "s1")], schemas.PLACE_MAP)
        date = run_params(T0).date
        listed = [dump(date, id=f"p{i}", created=T0 - 3_600_000, topic="t", subTopic="s") for i in range(posts)]
        dump_frame(spark, listed).write.partitionBy("event_name", "date").parquet(self.dumps)
        self.arrived = []

    def arrive(self, *log):
        self.arrived += log
        event_frame(self.spark, list(log)).write.mode("append").partitionBy("date").parquet(self.events)

    def run(self, run_ts):
        return jobs.run_snapshot(self.spark, self.events, self.dumps, self.mapping, self.base, run_ts)

    def check(self, run_ts):
        """The snapshot equals a full rebuild from what has arrived."""
        got = readers.read_snapshot(self.spark, self.base, run_ts + 60_000)
        posts = jobs.latest_posts(readers.read_dumps(self.spark, self.dumps), "truthy")
        full = sn.snapshot_full(event_frame(self.spark, self.arrived), posts, run_ts, self.mapping)
        assert rows(got, *COLUMNS) == rows(full, *COLUMNS)
        return {r["post_id"]: r for r in got.collect()}

    @property
    def log(self):
        return ct.Counters(self.spark, f"{self.base}_state")


@pytest.fixture
def world(spark, tmp_path):
    return World(spark, tmp_path)


def test_a_late_event_is_in_the_next_snapshot(world):
    world.arrive(lock(1, T0 - 5_000, "u", "p0"), lock(2, T0 + 5_000, "u", "p0"))
    assert world.run(T0) == "full"
    assert world.check(T0)["p0"]["views"] == 1
    world.arrive(lock(3, T0 - 1_000, "v", "p0"), initiate(4, T0 - 500, "u", "p0"))
    assert world.run(T0 + SLOT) == "incremental"
    assert world.check(T0 + SLOT)["p0"]["views"] == 3


def test_runs_out_of_order_count_nothing_twice(world):
    world.arrive(lock(1, T0 - 5_000, "u", "p0"))
    world.run(T0)
    world.arrive(lock(2, T0 + SLOT - 1, "u", "p0"))
    world.run(T0 + 2 * SLOT)
    world.arrive(lock(3, T0 + SLOT - 2, "u", "p0"))
    assert world.run(T0 + SLOT) == "backfill"
    assert world.check(T0 + SLOT)["p0"]["views"] == 3
    for _ in range(2):
        assert world.run(T0 + 3 * SLOT) == "incremental"
        assert world.check(T0 + 3 * SLOT)["p0"]["views"] == 3


def test_a_run_that_breaks_off_loses_nothing(world, monkeypatch):
    world.arrive(lock(1, T0 - 5_000, "u", "p0"), first_call(8, T0 - 6_000, "u"))
    world.run(T0)
    world.arrive(lock(2, T0 + 1, "u", "p0"), initiate(4, T0 + 1, "u", "p0"), trial(3, T0 + 2, "u"))
    whole = ct.Counters.write

    def breaks(self, table, part, rows):
        if table == "by_user":
            raise OSError("lost")
        return whole(self, table, part, rows)

    monkeypatch.setattr(ct.Counters, "write", breaks)
    with pytest.raises(OSError):
        world.run(T0 + SLOT)
    monkeypatch.undo()
    # nor does one that breaks off after its entry, before its snapshot
    monkeypatch.setattr(jobs, "write_snapshot", lambda *a, **k: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        world.run(T0 + SLOT)
    monkeypatch.undo()
    world.run(T0 + 2 * SLOT)
    assert world.check(T0 + 2 * SLOT)["p0"]["post_trials_so_far"] == 2
    assert world.log.drop_orphans(1 << 62) > 0 and world.log.drop_orphans(1 << 62) == 0
    world.run(T0 + 3 * SLOT)
    world.check(T0 + 3 * SLOT)


def test_of_two_runs_at_a_time_one_fails(world):
    world.arrive(lock(1, T0 - 5_000, "u", "p0"))
    world.run(T0)
    head = world.log.head()
    part = ct.Part("a", 0, 1, {})
    world.log.commit(head, 2, T0 + SLOT, part, "")
    with pytest.raises(FileExistsError):
        world.log.commit(head, 2, T0 + SLOT, part, "")
    names = files.names(world.spark, f"{world.log.base}/log")
    assert len(names) == 2 and not [n for n in names if n.endswith(".tmp")]


def test_damaged_entries_are_no_empty_state(world):
    world.arrive(lock(1, T0 - 5_000, "u", "p0"))
    world.run(T0)
    files.write(world.spark, f"{world.log.base}/log/000000000009.json", "{")
    with pytest.raises(ValueError):
        world.run(T0 + SLOT)


def test_parts_are_merged_in_tiers_and_expire(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ct, "FAN", (2, 2))
    monkeypatch.setattr(ct, "KEEP", 2)
    log = ct.Counters(spark, str(tmp_path))
    start, per_day = T0 - T0 % 86_400_000, 4
    events, most, folders = [], 0, 0
    for batch in range(1, 3 * per_day + 1):
        at = start + batch * 21_600_000
        new = [lock(1000 * batch + k, at - 1 - k * 3_600_000, f"u{k}", "p0") for k in range(4)] + [trial(1000 * batch + 9, at - 5, "u1")]
        events += new
        oldest = shift_day(run_params(at, "UTC").date, -1)
        st.count_batch(log, log.head(), event_frame(spark, new), batch, at, oldest, ids=True)
        head = log.head()
        most = max(most, len(head.parts))
        folders = max(folders, len(files.names(spark, f"{tmp_path}/by_post")))
        assert len(files.names(spark, f"{tmp_path}/log")) <= 2
    assert head.batch == 3 * per_day and {p.tier for p in head.parts} >= {2}
    assert most <= sum(ct.FAN) + 2 + 2 and folders <= most + 2 * max(ct.FAN)
    wanted = event_frame(spark, [e for e in events if e[-1] >= oldest])
    assert rows(log.read("by_post", head, oldest).groupBy("post_id", "user_id").sum("locks")) == rows(post_partials(wanted).groupBy("post_id", "user_id").sum("locks"))
    assert rows(log.read("by_user", head, oldest).groupBy("user_id").sum("trials")) == rows(user_partials(wanted).groupBy("user_id").sum("trials"))
    assert log.read("ids", head, oldest).count() == wanted.count()
    # a range of dates opens the folders of these dates alone
    one = log.read("by_post", head, oldest, oldest).inputFiles()
    assert one and all(f"date={oldest}" in f for f in one)


def test_a_replayed_stream_batch_changes_nothing(spark, tmp_path):
    log = ct.Counters(spark, str(tmp_path))
    for batch in (0, 1, 1, 0):
        st.append_partials(event_frame(spark, random_log(n=40, seed=batch)), batch, str(tmp_path))
    assert log.head().batch == 1 and log.head().number == 2


def test_many_files_are_picked_by_name_or_from_their_dates(spark, world):
    world.arrive(*random_log(n=60))
    world.arrive(*random_log(n=30, seed=2))
    dates = sorted({e[-1] for e in world.arrived})
    listed = readers.event_files(spark, world.events, dates[0], dates[-1])
    some = listed.orderBy("uri").limit(3)
    by_name = readers.read_event_files(spark, world.events, some)
    by_date = readers.read_event_files(spark, world.events, some, named=1)
    assert rows(by_name) == rows(by_date) and 0 < by_name.count() < 90
    assert rows(readers.read_event_files(spark, world.events, listed)) == sorted(world.arrived)
    assert readers.event_files(spark, world.events, "1999-01-01", "1999-01-02").count() == 0


def test_readers_open_the_dates_of_their_range_alone(spark, world):
    world.arrive(*random_log(n=200, span=6 * 86_400_000))
    day = sorted({e[-1] for e in world.arrived})[1]
    assert {f.split("date=")[1][:10] for f in readers.read_events(spark, world.events, day, day).inputFiles()} == {day}
    assert readers.read_events(spark, world.events, "1999-01-01", "1999-01-03").count() == 0


def test_runs_are_looked_up_and_not_listed(spark, world, monkeypatch):
    posts = spark.createDataFrame([], schemas.POST)
    for k in range(2):
        sinks.write_snapshot(sn.snapshot_full(event_frame(spark, []), posts, T0 + k * SLOT, world.mapping), world.base, T0 + k * SLOT)
    now = run_params(T0)
    data = f"{world.base}/date={now.date}"
    opened = []
    real = files.names
    monkeypatch.setattr(files, "names", lambda s, folder: opened.append(folder) or real(s, folder))
    assert not readers.is_cold_start(spark, world.base, now.date)
    assert readers.latest_run(spark, world.base, T0 + SLOT) == (now.date, now.slot)
    assert opened and not [f for f in opened if not f.startswith(f"{world.base}/_runs")]
    entry = readers.run_entry(spark, world.base, now.date, now.slot)
    assert (entry["run_ts"], entry["rows"]) == (T0, 0) and all(os.path.exists(f"{world.base}/{f}") for f in entry["files"])
    assert readers.run_entry(spark, world.base, now.date, "0000") is None
    # the catalogue is no data
    assert readers.snapshots_table(spark, world.base).count() == 0 and os.path.isdir(data)


def test_stratified_sample_is_exact_and_stays_the_same(spark):
    table = [(k, k % 3 if k % 50 else None, f"u{k // 2}") for k in range(1000)] + [(7, 1, "u3")] * 5
    df = spark.createDataFrame(table, "n int, y int, user string")
    pick = lambda d, f, digits: rows(stratified_sample(d, "y", f, ["user"], "s", digits))
    sizes = {y: sum(t[1] == y for t in table) for y in (0, 1, 2)}
    want = {0: 0.29, 1: 1.0, 2: 0.5}
    one = pick(df, want, 1)
    assert {y: sum(r[1] == y for r in one) for y in want} == {y: int(sizes[y] * f + 1e-9) for y, f in want.items()}
    assert one == pick(df.repartition(7).orderBy("user"), want, 4)
    assert set(pick(df, {0: 0.1}, 2)) <= set(r for r in one if r[1] == 0)
    assert pick(df.limit(0), want, 4) == [] and pick(df, {5: 1.0}, 4) == []
