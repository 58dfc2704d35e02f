"""Counts at rest against the running counts over all events."""

import random

import pytest
from frames import T0, event_frame, rows
from frames import event as one_event

from tidemark.functions import shift_day
from tidemark.operators import leakage, prefixes
from tidemark.plans import jobs
from tidemark.sources import readers

DAY = 86_400_000
SINCE = "2024-01-01"
VIEW = "user_id string, post_id string, view_time bigint"


@pytest.mark.parametrize("days", [1, 2, 7, 16, 45])
def test_blocks_hold_each_date_once(days):
    dates = [shift_day(SINCE, k) for k in range(days)]
    held = {end: [d for d in dates if end in prefixes.blocks_with(d, SINCE, SINCE, dates[-1])] for end in dates}
    for k, date in enumerate(dates):
        ends = prefixes.blocks_up_to(date, SINCE)
        assert sorted(d for e in ends for d in held[e]) == dates[: k + 1]
        assert len(ends) <= (k + 1).bit_length()
    assert prefixes.blocks_up_to("2023-12-31", SINCE) == []


def _log(rng, n):
    names = sorted(leakage.counted_events())
    out = []
    for i in range(n):
        at = T0 - rng.randrange(4 * DAY)
        user = rng.choice(["u1", "u1", "u2", "u3", None])
        post = rng.choice(["p0", "p0", "p1", None])
        out.append(one_event(i, at, user, rng.choice(names), post, isLocked="true", isInitiatedFromPost="true"))
    return out


def _views(spark, log, rng):
    made = {(rng.choice(["u1", "u2", "new"]), rng.choice(["p0", "p1", "p9"]), e[1] + rng.choice([0, 1])) for e in log[:120]}
    return spark.createDataFrame(sorted(made), VIEW)


def test_equals_counts_over_all_events(spark, tmp_path):
    rng = random.Random(8)
    log = _log(rng, 500)
    base, path = str(tmp_path / "rest"), str(tmp_path / "events")
    frame = event_frame(spark, log)
    frame.write.partitionBy("date").parquet(path)
    dates = sorted({e[-1] for e in log})
    first, last = shift_day(dates[0], -1), dates[-1]
    views = _views(spark, log, rng)
    want = rows(leakage.loo_counts(views, frame))
    with pytest.raises(ValueError):
        jobs.advance_prefixes(spark, path, base, first, last)
        jobs.advance_prefixes(spark, path, base, shift_day(last, 3), shift_day(last, 3))

    def got():
        ranges = [(dates[0], dates[2]), (dates[3], last)]
        parts = [jobs.views_with_others(spark, views, path, base, a, b) for a, b in ranges]
        return sorted(r for p in parts for r in rows(p))

    assert got() == want
    # in steps, then a range again for events that came late
    step = str(tmp_path / "steps")
    jobs.advance_prefixes(spark, path, step, first, dates[1])
    jobs.advance_prefixes(spark, path, step, dates[2], dates[2])
    jobs.advance_prefixes(spark, path, step, dates[3], last)
    for table, keys in prefixes.KEYS.items():
        read = lambda b: readers.prefix_table(spark, b, table, last).groupBy(*keys).sum("views", "locks")  # noqa: B023, E731
        assert rows(read(base)) == rows(read(step))
    late = [one_event(9000 + i, e[1], "u9", e[5], "p0", isLocked="true", isInitiatedFromPost="true") for i, e in enumerate(log[:40]) if e[-1] >= dates[1]]
    event_frame(spark, late).write.mode("append").partitionBy("date").parquet(path)
    jobs.advance_prefixes(spark, path, base, dates[1], dates[2])
    assert readers.prefix_range(spark, base) == (first, dates[2])
    with pytest.raises(LookupError):
        readers.prefix_table(spark, base, "by_post", dates[3])
    jobs.advance_prefixes(spark, path, base, dates[3], last)
    want = rows(leakage.loo_counts(views, event_frame(spark, log + late)))
    assert got() == want


def test_a_day_reads_its_own_events_and_few_blocks(spark, tmp_path):
    base, path = str(tmp_path / "rest"), str(tmp_path / "events")
    event_frame(spark, _log(random.Random(1), 200)).write.partitionBy("date").parquet(path)
    days = sorted(p.name.removeprefix("date=") for p in (tmp_path / "events").glob("date=*"))
    jobs.advance_prefixes(spark, path, base, days[0], days[-2])
    views = spark.createDataFrame([("u1", "p0", T0)], VIEW)
    read = jobs.views_with_others(spark, views, path, base, days[-1]).inputFiles()
    folders = {(f.split("/")[-3], f.split("/")[-2].removeprefix("date=")) for f in read}
    assert {d for t, d in folders if t == "events"} <= {shift_day(days[-1], k) for k in (-1, 0, 1)}
    for table in prefixes.KEYS:
        assert {d for t, d in folders if t == table} <= set(prefixes.blocks_up_to(days[-2], days[0]))


def test_counts_by_post_come_from_those_by_user(spark, tmp_path, monkeypatch):
    base, path, read = str(tmp_path / "rest"), str(tmp_path / "events"), {}
    event_frame(spark, _log(random.Random(2), 200)).write.partitionBy("date").parquet(path)
    write = jobs.write_prefixes

    def noted(rows, base, table, owned):
        read[table] = rows.inputFiles()
        write(rows, base, table, owned)

    monkeypatch.setattr(jobs, "write_prefixes", noted)
    days = sorted(p.name.removeprefix("date=") for p in (tmp_path / "events").glob("date=*"))
    jobs.advance_prefixes(spark, path, base, days[0], days[-1])
    assert any("/events/" in f for f in read["by_user"])
    assert read["by_post"] and all("/rest/by_user/" in f for f in read["by_post"])


def test_empty_tables(spark, tmp_path):
    path = str(tmp_path / "events")
    event_frame(spark, []).write.parquet(path)
    jobs.advance_prefixes(spark, path, str(tmp_path / "rest"), SINCE, "2024-01-03")
    views = spark.createDataFrame([("u", "p", T0), (None, "p", T0), ("u", None, T0), ("u", "p", None)], VIEW)
    day = readers.dates_between("2024-01-01", "2024-01-04")[-1]
    assert jobs.views_with_others(spark, views, path, str(tmp_path / "rest"), day).count() == 0
