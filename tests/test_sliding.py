"""Sliding daily tables against the windows worked out from all events."""

import random

import pytest
from frames import T0, dump, dump_frame, event_frame, initiate, lock, rows

from tidemark import schemas
from tidemark.functions import on_dates, shift_day, window_bounds
from tidemark.operators.events import initiates, locks
from tidemark.operators.posts import latest_posts
from tidemark.operators.sliding import SEEN, TOTALS, advance_seen, advance_totals, prior_counts, seen_over, totals_over
from tidemark.plans import jobs
from tidemark.plans.daily import daily_features, daily_features_sliding
from tidemark.sources import readers

DAY = 86_400_000


@pytest.fixture(scope="module")
def log():
    r = random.Random(2)
    out = []
    for i in range(700):
        at = T0 - r.randrange(40 * DAY)
        user, post = r.choice(["u1", "u2", "u3", "u4", None]), f"p{r.randrange(12)}"
        if post == "p3" and T0 - 36 * DAY < at < T0 - 4 * DAY:
            continue  # a post that leaves and begins anew
        out.append(lock(i, at, user, post) if r.random() < 0.7 else initiate(i, at, user, post))
    return out


def dumps(refs):
    start = min(refs)
    return [
        dump(shift_day(start, k % 14 - 13), id=f"p{k}", created=T0 - (k % 14) * DAY, topic="t", isReporter=k % 2 == 0, creatorID=f"c{k % 3}", contentLang="en", location={"pid": f"d{k % 2}"})
        for k in range(12)
    ]


@pytest.mark.parametrize("tz", ["Asia/Kolkata", "America/New_York"])
def test_equals_windows_over_all_events(spark, log, tz):
    events = event_frame(spark, log)
    ref = shift_day(max(e[-1] for e in log), -1)
    posts = latest_posts(dump_frame(spark, dumps([ref])))
    mapping = spark.createDataFrame([("d1", "One", "North", "s1")], schemas.PLACE_MAP)
    kept = {}
    by_date = {}
    for e in log:
        by_date.setdefault(e[-1], []).append(e)
    date, end = shift_day(min(by_date), -1), ref
    table = {"seen": spark.createDataFrame([], SEEN), "totals": spark.createDataFrame([], TOTALS)}
    while date < end:
        date = shift_day(date, 1)
        if date < shift_day(ref, -16) and date not in by_date:
            continue
        day = event_frame(spark, by_date.get(date, []))
        new = {"seen": advance_seen(table["seen"], locks(day), date, tz), "totals": advance_totals(table["totals"], locks(day), initiates(day), date, tz, idle=16)}
        # lineage is cut by hand: a day's rows are few
        table = {k: spark.createDataFrame(df.collect(), df.schema) for k, df in new.items()}
        kept[date] = table
    every = kept[ref]["totals"]
    for back in (15, 14, 8, 7):
        every = every.unionByName(kept[shift_day(ref, -back)]["totals"])
    got = daily_features_sliding(posts, kept[ref]["seen"], every, mapping, ref, tz)
    b = window_bounds(ref, tz)
    want = daily_features(posts, events.filter(on_dates(b.first_date, b.last_date)), mapping, ref, tz)
    for kind, df in want.items():
        assert rows(got[kind].fillna("-"), *df.columns) == rows(df.fillna("-"), *df.columns), kind
    assert want["creator"].count() > 0 and want["eco_district"].count() > 1
    assert prior_counts(every.limit(0), ref, tz).count() == 0


@pytest.mark.parametrize(("tz", "known"), [("Asia/Kolkata", 0), ("America/New_York", 5)])
def test_a_range_in_one_pass_equals_its_dates(spark, log, tz, known):
    """With posts that leave after three dates and begin anew, and with tables of the dates before or none."""
    first, last = shift_day(max(e[-1] for e in log), -11), shift_day(max(e[-1] for e in log), 1)
    quiet = [e for e in log if "p5" not in e[2] or e[-1] > shift_day(first, 8) or e[-1] < shift_day(first, 3)]
    table = {"seen": spark.createDataFrame([], SEEN), "totals": spark.createDataFrame([], TOTALS)}
    want, start = {"seen": [], "totals": []}, shift_day(first, known)
    before = dict(table)
    for date in readers.dates_between(first, last):
        day = event_frame(spark, [e for e in quiet if e[-1] == date])
        new = {"seen": advance_seen(table["seen"], locks(day), date, tz), "totals": advance_totals(table["totals"], locks(day), initiates(day), date, tz, idle=3)}
        table = {k: spark.createDataFrame(df.collect(), df.schema) for k, df in new.items()}
        if date < start:
            before = dict(table)
        else:
            for k, df in table.items():
                want[k] += rows(df.fillna("-"), *sorted(df.columns))
    events = event_frame(spark, [e for e in quiet if start <= e[-1] <= last])
    got = {
        "seen": seen_over(before["seen"], locks(events), start, last, tz),
        "totals": totals_over(before["totals"], locks(events), initiates(events), start, last, tz, idle=3),
    }
    for k, df in got.items():
        assert sorted(rows(df.fillna("-"), *sorted(df.columns)), key=str) == sorted(want[k], key=str), k
    assert known or len({r["since"] for r in got["totals"].filter("post_id = 'p5'").collect()}) > 1


def test_missing_dates_are_read_together(spark, log, tmp_path, monkeypatch):
    ref = shift_day(max(e[-1] for e in log), -1)
    event_frame(spark, log).write.partitionBy("date").parquet(str(tmp_path / "events"))
    dump_frame(spark, dumps([ref])).write.partitionBy("event_name", "date").parquet(str(tmp_path / "dumps"))
    mapping = spark.createDataFrame([("d1", "One", "North", "s1")], schemas.PLACE_MAP)
    asked = []
    real = jobs.read_events
    monkeypatch.setattr(jobs, "read_events", lambda s, p, a, b: asked.append((a, b)) or real(s, p, a, b))
    assert jobs.run_daily_sliding(spark, str(tmp_path / "events"), str(tmp_path / "dumps"), mapping, str(tmp_path / "sliding"), ref) == 16
    assert asked == [(shift_day(ref, -15), ref)]


def test_a_day_reads_one_date_of_events(spark, log, tmp_path, monkeypatch):
    ref = shift_day(max(e[-1] for e in log), -1)
    event_frame(spark, log).write.partitionBy("date").parquet(str(tmp_path / "events"))
    dump_frame(spark, dumps([ref])).write.partitionBy("event_name", "date").parquet(str(tmp_path / "dumps"))
    mapping = spark.createDataFrame([("d1", "One", "North", "s1")], schemas.PLACE_MAP)
    args = (spark, str(tmp_path / "events"), str(tmp_path / "dumps"), mapping)
    assert jobs.run_daily_sliding(*args, str(tmp_path / "sliding"), shift_day(ref, -1)) == 16
    asked = []
    real = jobs.read_events
    monkeypatch.setattr(jobs, "read_events", lambda s, p, a, b: asked.append((a, b)) or real(s, p, a, b))
    assert jobs.run_daily_sliding(*args, str(tmp_path / "sliding"), ref) == 1 and asked == [(ref, ref)]
    monkeypatch.undo()
    jobs.run_daily(*args, str(tmp_path / "whole"), ref)
    for kind in schemas.FEATURES:
        one, other = (readers.features_table(spark, str(tmp_path / k), kind, ref, ref) for k in ("sliding", "whole"))
        assert rows(one.fillna("-")) == rows(other.fillna("-")), kind
