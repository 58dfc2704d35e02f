"""As-of, range and leave-one-out operators against brute force on skewed random data."""

import random
from collections import defaultdict

import pytest
from frames import T0, event, event_frame, initiate, lock, rows, trial, utc_day

from tidemark.functions.scalars import DAY_MS
from tidemark.operators import labels as lb
from tidemark.operators.asof import HOUR_MS, asof_snapshot
from tidemark.operators.leakage import loo_counts
from tidemark.skew import hot_key_lookup, salted_lookup

VIEW = "user_id string, post_id string, view_time bigint"


def _time(rng, days=20):
    # Whole hours now and then, so that views, runs and window edges coincide.
    ms = T0 + rng.randrange(days * DAY_MS)
    return ms - ms % HOUR_MS if rng.random() < 0.3 else ms


def _hot(rng, prefix, n):
    """A third of the draws fall on one key."""
    return f"{prefix}0" if rng.random() < 1 / 3 else f"{prefix}{rng.randrange(n)}"


@pytest.mark.parametrize("lag_ms", [0, 15 * 60_000])
def test_asof_matches_brute_force(spark, lag_ms):
    rng = random.Random(lag_ms)
    views = [(_hot(rng, "u", 9), _hot(rng, "p", 12), _time(rng)) for _ in range(600)]
    runs = [(_hot(rng, "p", 10), _time(rng, 12)) for _ in range(150)]
    got = asof_snapshot(
        spark.createDataFrame(views, VIEW),
        spark.createDataFrame(runs, "post_id string, run_ts bigint"),
        lag_ms,
    )
    want = set()
    for user, post, at in set(views):
        earlier = [r for p, r in runs if p == post and r <= at - lag_ms]
        if earlier:
            want.add((user, post, at, max(earlier)))
    assert want and rows(got) == sorted(want)


def _follows(policy, view, at):
    if at < view:
        return False
    if policy.same_day:
        return utc_day(view) == utc_day(at)
    return policy.width_ms is None or at < view + policy.width_ms


@pytest.mark.parametrize("policy", lb.POLICIES.values(), ids=lambda p: p.name)
@pytest.mark.parametrize("keys", [["user_id"], ["user_id", "post_id"]])
def test_conversion_flags_match_brute_force(spark, policy, keys):
    rng = random.Random(len(keys))
    draw = lambda: (_hot(rng, "u", 8), _hot(rng, "p", 5), _time(rng))
    views = sorted({draw() for _ in range(300)})
    events = [draw() for _ in range(120)]
    # Events exactly at, at the end of, and one ms short of a view's window.
    for user, post, at in views[:30]:
        width = policy.width_ms or DAY_MS
        events += [(user, post, at + d) for d in (rng.choice([0, -1, width, width - 1]),)]
    got = lb.flag_conversions(
        spark.createDataFrame(views, VIEW),
        spark.createDataFrame(events, "user_id string, post_id string, event_time bigint"),
        keys,
        policy,
        "hit",
    )
    same = lambda v, e: v[0] == e[0] and (len(keys) == 1 or v[1] == e[1])
    want = [(*v, any(same(v, e) and _follows(policy, v[2], e[2]) for e in events)) for v in views]
    assert {w[-1] for w in want} == {True, False}
    assert rows(got) == want


def _label_case(spark):
    day = 1_705_190_400_000  # 2024-01-14 00:00 UTC
    hour = lambda h: day + int(h * HOUR_MS)
    events = [
        lock(1, hour(10), "u1", "p1"),
        lock(2, hour(12), "u1", "p1"),  # after the initiate, same snapshot
        initiate(3, hour(11), "u1", "p1"),
        lock(4, hour(10), "u2", "p1"),
        initiate(5, hour(11), "u2", "p2"),  # another post
        lock(6, hour(10), "u3", "p1"),
        trial(7, hour(30), "u3"),  # next day
        lock(8, hour(10), "u4", "p1"),
        initiate(9, hour(10), "u4", "p1"),  # at the very moment
        trial(10, hour(20), "u4"),
        lock(11, hour(10), "u5", "p1", age=3),  # not day 0
        lock(12, hour(1), "u6", "p1"),  # before any snapshot
        lock(13, hour(10), None, "p1"),  # no user
    ]
    snapshots = [("p1", hour(6), "2024-01-14"), ("p1", hour(14), "2024-01-14")]
    return (
        event_frame(spark, events),
        spark.createDataFrame(snapshots, "post_id string, run_ts bigint, date string"),
        hour,
    )


@pytest.mark.parametrize(
    ("window", "per_view", "want"),
    [
        ("same_day", False, {"u1": [1, 1], "u2": [0], "u3": [0], "u4": [2], None: [0]}),
        ("same_day", True, {"u1": [1, 0], "u2": [0], "u3": [0], "u4": [2], None: [0]}),
        ("horizon3d", False, {"u1": [1, 1], "u2": [0], "u3": [2], "u4": [2], None: [0]}),
        ("7d", False, {"u1": [1, 1], "u2": [0], "u3": [2], "u4": [2], None: [0]}),
    ],
)
def test_labels(spark, window, per_view, want):
    events, snapshots, hour = _label_case(spark)
    got = lb.create_labels(events, snapshots, "2024-01-14", "2024-01-14", window, per_view=per_view)
    collected = defaultdict(list)
    for row in sorted(got.collect(), key=lambda r: r.view_time):
        assert row.run_ts == hour(6) <= row.view_time and row.date == "2024-01-14"
        collected[row.user_id].append(row.y)
    assert dict(collected) == want


def test_lagged_matching_uses_an_older_snapshot(spark):
    events, snapshots, hour = _label_case(spark)
    late = events.filter("event_id = '2'")
    views = lb.matched_views(late, snapshots, "2024-01-14", "2024-01-14", lag_ms=7 * HOUR_MS)
    assert views.count() == 0
    views = lb.matched_views(late, snapshots, "2024-01-14", "2024-01-14", lag_ms=6 * HOUR_MS)
    assert rows(views, "run_ts") == [(hour(6),)]


def test_leave_one_out_matches_brute_force(spark):
    rng = random.Random(5)
    names = ["post_seen", "feed_locked", "initiate_transaction", "post_shared", "post_reaction"]
    names += ["comment_created", "media_clicked", "read_mode_entered"]
    events = [
        event(
            i, _time(rng, 2), _hot(rng, "u", 6), rng.choice(names), _hot(rng, "p", 4),
            isLocked="true", isInitiatedFromPost="true",
        )
        for i in range(500)
    ]
    views = {(e[4], rng.choice(["p0", "p1"]), e[1] + rng.choice([0, 1])) for e in events[:150]}
    frame = event_frame(spark, events)
    got = loo_counts(spark.createDataFrame(sorted(views), VIEW), frame)
    want = []
    for user, post, at in views:
        others = [
            e[5] for e in events if f'"postId": "{post}"' in e[2] and e[1] < at and e[4] != user
        ]
        want.append((user, post, at, *[others.count(n) for n in names]))
    assert rows(got) == sorted(want)


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("join", [salted_lookup, hot_key_lookup])
def test_spread_lookups_equal_a_plain_join(spark, join, how):
    rng = random.Random(1)
    left = spark.createDataFrame(
        [(rng.choice([None, "hot", "hot", f"k{i % 40}"]), i) for i in range(2000)],
        "k string, i bigint",
    )
    lookup = spark.createDataFrame([(f"k{i}", i) for i in range(30)] + [("hot", -1)], "k string, v int")
    assert rows(join(left, lookup, ["k"], ["i"], how=how).fillna({"k": "", "v": -9})) == rows(
        left.join(lookup, "k", how).fillna({"k": "", "v": -9})
    )
