"""Counts, state and snapshot runs on small frames."""

import random

import pytest
from frames import (
    T0, dump, dump_frame, event, event_frame, first_call, initiate, lock, rows, trial, utc_day,
)

from tidemark import schemas
from tidemark.functions import on_dates
from tidemark.functions.scalars import DAY_MS
from tidemark.operators import engagement as en
from tidemark.operators.events import day0_users, parse_events
from tidemark.operators.posts import latest_posts, merge_posts, place_map, place_orphans, split_posts
from tidemark.plans import snapshots as sn

MINUTE = 60_000
RUN = T0 + 6 * 3_600_000


@pytest.fixture(scope="module")
def mapping(spark):
    places = spark.createDataFrame(
        [
            ("s1", "STATE", "North", None),
            ("d1", "DISTRICT", "One", "s1"),
            ("d2", "DISTRICT", "Two", "s9"),
        ],
        schemas.PLACE,
    )
    assert rows(place_orphans(places), "district_pid") == [("d2",)]
    assert place_map(places, "left").count() == 2
    return place_map(places)


def post_rows(n, created=T0 - DAY_MS):
    return [
        (f"p{i}", created, "t", "s", 1, 2, 3, True, False, True, 4.0, 5, "en", "c1", "d1")
        for i in range(n)
    ]


def post_frame(spark, n, created=T0 - DAY_MS):
    return spark.createDataFrame(post_rows(n, created), schemas.POST)


def test_fan_out_multiplies_and_dedup_does_not(spark):
    events = event_frame(
        spark,
        [
            first_call(0, T0, "u1"),
            lock(1, T0, "u1", "p1"),
            lock(2, T0 + 1, "u1", "p1"),
            initiate(3, T0, "u1", "p1"),
            initiate(4, T0, "u1", "p1"),
            initiate(5, T0, "u1", "p1"),
            trial(6, T0, "u1"),
            trial(7, T0, "u1"),
            lock(8, T0, "u2", "p1"),
            trial(9, T0, "u2"),  # not a day-0 user
            initiate(10, T0, "u3", "p1"),  # no lock of that user
            lock(11, T0, None, "p1"),
            initiate(12, T0, None, "p1"),
        ],
    )
    day0 = day0_users(events)
    names = ["locks", "initiates", "trials", "day0_locks", "day0_initiates", "day0_trials"]
    fan = en.conversions_a(events, None, day0).select(*names).first()
    assert tuple(fan) == (2 * 3 * 2 + 2, 12, 12, 12, 12, 12)
    once = en.conversions_a(events, None, day0, dedup=True).select(*names).first()
    assert tuple(once) == (4, 2, 2, 2, 2, 2)


def test_mean_duration_covers_unlocked_views_with_a_duration(spark):
    events = event_frame(
        spark,
        [
            event(1, T0, "u", "feed_locked", "p", isLocked="true", duration=10),
            event(2, T0, "u", "feed_locked", "p", isLocked="false", duration=20),
            event(3, T0, "u", "feed_locked", "p", isLocked="true", duration=None),
            event(4, T0, "u", "post_shared", "p", duration=99),
        ],
    )
    row = en.engagement_a(events).first()
    assert (row.views, row.shares, row.avg_dur) == (2, 1, 15.0)


def test_malformed_payloads_count_nowhere(spark):
    bad = [("9", T0, "{not json", "android", "u", "feed_locked", utc_day(T0))]
    events = event_frame(spark, [lock(1, T0, "u", "p"), *bad])
    assert en.engagement_a(events).count() == 1
    assert parse_events(events, "post_id").filter("post_id is null").count() == 1


def test_newest_dump_wins_and_ties_are_settled_by_text(spark):
    dumps = dump_frame(
        spark,
        [
            dump("2024-01-02", id="p1", topic="new", created=5),
            dump("2024-01-01", id="p1", topic="old", created=5),
            dump("2024-01-01", postId="p2", topic="a"),
            dump("2024-01-01", postId="p2", topic="b"),
            dump("2024-01-03", event_name="other", id="p1", topic="no"),
            dump("2024-01-03", raw='{"id":"p1","topic":'),
            dump("2024-01-03", raw=""),
            dump("2024-01-03", topic="no id"),
        ],
    )
    assert rows(latest_posts(dumps), "post_id", "topic") == [("p1", "new"), ("p2", "b")]


def test_alias_modes(spark):
    dumps = dump_frame(
        spark,
        [
            dump(
                "2024-01-01", id="p1", districtImportanceLevel=0, district_score=4,
                isLocal=False, is_local=True, created=0, createdAt=7, creatorID="",
                creatorId="c9", location={"pid": ""}, location_pid="d7", titleLength=0, title="abc",
                duration=0, media_duration=6, media="video",
            ),
        ],
    )
    names = ["created_ts", "distImp", "isLocal", "creatorID", "location_pid", "titleLen", "media_duration"]
    pick = lambda mode: tuple(latest_posts(dumps, mode).select(*names).first())
    assert pick("coalesce") == (0, 0, False, "", "", 0, 0.0)
    assert pick("truthy") == (7, 4, True, "c9", "d7", 3, 6.0)
    assert pick("strict") == (0, 0, False, "", "", 3, 0)
    assert latest_posts(dumps, "strict").first().media == "video"


def random_log(n=400, posts=6, seed=3, start=T0 - DAY_MS, span=DAY_MS):
    rng = random.Random(seed)
    log = []
    for i in range(n):
        at, user = start + rng.randrange(span), f"u{min(rng.randrange(12), 7)}"
        post = f"p{max(rng.randrange(-2, posts), 0)}"
        make = rng.choice(
            [
                lambda: lock(i, at, user, post, duration=rng.choice([None, 4, 7.5])),
                lambda: initiate(i, at, user, post),
                lambda: trial(i, at, user),
                lambda: first_call(i, at, user, rng.choice([0, 0, 2])),
                lambda: event(i, at, user, "post_shared", post),
                lambda: event(i, at, user, "comment_created", post),
            ]
        )
        log.append(make())
    return log


def test_state_of_any_split_equals_the_full_rebuild(spark, mapping):
    log = random_log()
    posts = post_frame(spark, 8)
    full = sn.snapshot_full(event_frame(spark, log), posts, RUN, mapping)
    state = None
    for part in (log[:50], log[50:51], log[51:300], log[300:]):
        state = sn.advance_state(state, event_frame(spark, part))
    assert rows(sn.snapshot_from_state(state, posts, RUN, mapping)) == rows(full)
    assert full.count() == 8 and full.agg({"post_day0_initiates": "max"}).first()[0] > 0


def test_one_pass_metrics_equal_the_two_queries_joined(spark):
    events = event_frame(spark, random_log())
    joined = en.post_metrics(
        en.engagement_a(events), en.conversions_a(events, None, day0_users(events))
    )
    assert rows(sn.full_metrics(events)) == rows(joined)


def test_incremental_equals_full_when_no_pair_spans_the_runs(spark, mapping):
    earlier = [e for e in random_log(seed=4) if e[4] != "u0"]
    prev_run = T0
    # After the previous run only a user of its own acts, on any post.
    later = [
        first_call(900, T0 - 1, "v"),
        lock(901, T0 + 1, "v", "p0", duration=3),
        initiate(902, T0 + 2, "v", "p0"),
        trial(903, T0 + 3, "v"),
        event(904, T0 + 4, "v", "post_shared", "p7"),
    ]
    events = event_frame(spark, earlier + later)
    known, everyone = post_frame(spark, 7), post_frame(spark, 8)
    previous = sn.snapshot_full(events, known, prev_run, mapping)
    today = everyone.filter("post_id in ('p6', 'p7')")
    got = sn.snapshot_incremental(previous, today, events, RUN, prev_run, mapping)
    full = sn.snapshot_full(events, everyone, RUN, mapping)
    # The mean of a post with delta durations is that of the delta.
    columns = [c for c in schemas.SNAPSHOT_COLUMNS if c != "avgDur"]
    assert rows(got, *columns) == rows(full, *columns)
    assert got.filter("post_id = 'p0'").first().avgDur == 3.0
    assert got.filter("post_id = 'p7'").first().shareCount == 1


def test_expired_posts_are_not_carried(spark, mapping):
    old, young = post_frame(spark, 2, RUN - 8 * DAY_MS), post_frame(spark, 3, RUN - DAY_MS)
    previous = sn.snapshot_full(
        event_frame(spark, []), old.filter("post_id = 'p1'").union(young.filter("post_id = 'p2'")),
        RUN, mapping,
    )
    merged = merge_posts(young.filter("post_id = 'p0'"), previous, RUN - 7 * DAY_MS)
    assert rows(merged, "post_id") == [("p0",), ("p2",)]
    new, existing = split_posts(merged, previous)
    assert rows(new, "post_id") == [("p0",)] and rows(existing, "post_id") == [("p2",)]


def test_counts_stop_at_the_run(spark, mapping):
    events = event_frame(spark, [lock(1, RUN - 1, "u", "p0"), lock(2, RUN, "u", "p0")])
    snapshot = sn.snapshot_full(events, post_frame(spark, 1), RUN, mapping).first()
    assert snapshot.views == snapshot.post_locks_so_far == 1
    assert snapshot.post_state == "North"
    assert sn.window_events(events, RUN).filter(on_dates("2030-01-01")).count() == 0


def test_stateless_variant_guards_its_rates(spark):
    events = event_frame(
        spark,
        [
            event(1, RUN - 2, "u", "post_seen", "p0", userAge=0, postEngagement={"screenTime": 4}),
            event(2, RUN - 2, "u", "initiate_transaction", "p0", userAge=0),
            event(3, RUN - 2, "u", "post_reacted", "p0"),
        ],
    )
    row = sn.snapshot_b(events, post_frame(spark, 2), RUN).filter("post_id = 'p0'").first()
    assert (row.views, row.avgDur, row.reactionCount) == (1, 4.0, 1)
    assert row.post_day0_initiates_per_view == 1.0
    assert row.post_day0_initiates_per_lock == 0.0
    assert row.snapshot_ts == RUN and len(row) == len(schemas.SNAPSHOT_B_COLUMNS)
