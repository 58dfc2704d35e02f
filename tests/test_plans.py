"""Shapes of physical plans: what reaches the scan, and what must never appear."""

import re

import pytest
from frames import event_frame
from test_snapshots import post_frame, random_log

import __spark_entry__ as contract
from tidemark.checks.fixtures import Fixtures
from tidemark.operators import engagement as en
from tidemark.operators.events import day0_users, initiates, locks
from tidemark.operators.labels import create_labels
from tidemark.operators.leakage import loo_counts, marks_of
from tidemark.operators.partials import post_partials, user_partials
from tidemark.plans.snapshots import full_metrics, snapshot_full
from tidemark.sources import readers

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "ExistingRDD")

# These write tables and return a plain scan of them, or end in a driver-made empty frame.
WRITERS = {n for n in contract.catalog.queries() if n.startswith(("roundtrip_", "registered_", "stream_", "scheduled_", "run_catalogue"))}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(contract.catalog.queries()) - WRITERS))
def test_no_pairing_and_no_python(spark, sf_dir, name):
    text = plan(contract.catalog.queries()[name](spark, sf_dir))
    assert not [word for word in FORBIDDEN if word in text]


@pytest.fixture
def log(spark, tmp_path):
    event_frame(spark, random_log(n=200)).write.partitionBy("date").parquet(str(tmp_path / "log"))
    return readers.read_events(spark, str(tmp_path / "log"))


def test_dates_names_and_columns_reach_the_scan(log):
    text = plan(en.engagement_a(log, since_date="2024-01-11", since_ts=5))
    scan = next(line for line in text.splitlines() if "FileScan" in line)
    assert re.search(r"PartitionFilters: \[[^\]]*date#\d+ >= 2024-01-11", scan)
    assert "In(event_name" in scan and "GreaterThanOrEqual(event_time,5)" in scan
    schema = scan.split("ReadSchema: ")[1]
    assert set(re.findall(r"(\w+):", schema)) == {"event_time", "data", "event_name"}


@pytest.mark.parametrize("operator", [locks, initiates, post_partials, user_partials, marks_of])
def test_a_payload_is_parsed_once(log, operator):
    assert operator(log)._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1


def test_counts_are_combined_before_the_shuffle(log):
    text = plan(day0_users(log))
    assert text.count("HashAggregate") == 2 and text.index("Exchange") > text.index("HashAggregate")


def executed(spark, make):
    """Final plan with every join shuffled, as on data too large to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = make()
        df.collect()
        return plan(df).split("== Initial Plan ==")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_snapshot_reads_the_log_once_for_posts_and_once_for_users(spark, log):
    mapping = spark.createDataFrame([("d1", "x")], "district_pid string, state_name string")
    posts = post_frame(spark, 3)
    text = executed(spark, lambda: snapshot_full(log, posts, 1_705_100_000_000, mapping))
    assert len(re.findall(r"FileScan parquet", text)) == 2


def test_conversions_copy_no_users(spark, log):
    assert "_salt" not in plan(full_metrics(log))


def test_the_grid_of_labels_is_that_of_the_series_without_its_counts(spark, sf_dir):
    tables = Fixtures(spark, sf_dir)
    grid = tables.grid
    assert "series" not in tables._built
    assert sorted(map(tuple, grid.collect())) == sorted(map(tuple, tables.series.select(*grid.columns).collect()))
    assert "series" in tables._built and "/series" in tables.grid.inputFiles()[0]


def test_leave_one_out_reads_events_and_views_once(spark, log):
    views = log.filter("event_name = 'feed_locked'").selectExpr(
        "user_id", "get_json_object(data, '$.postId') post_id", "event_time view_time"
    )
    text = executed(spark, lambda: loo_counts(views, log))
    assert len(re.findall(r"FileScan parquet", text)) == 2
    assert text.count("ReusedExchange") >= 4


def test_leave_one_out_lays_points_out_once(spark, log):
    views = log.filter("event_name = 'feed_locked'").selectExpr(
        "user_id", "get_json_object(data, '$.postId') post_id", "event_time view_time"
    )
    text = executed(spark, lambda: loo_counts(views, log))
    # events, views, pairs on both sides; by user and by post: points, totals of slices twice; both sides of the last join
    assert len(re.findall(r"(?<!Reused)(?<!Broadcast)Exchange hashpartitioning", re.sub(r"ReusedExchange.*", "", text))) <= 12


def test_labels_join_on_keys_only(spark, log):
    snapshots = spark.createDataFrame(
        [("p0", 1_704_950_000_000, "2024-01-11")], "post_id string, run_ts bigint, date string"
    )
    text = executed(spark, lambda: create_labels(log, snapshots, "2024-01-11", "2024-01-12"))
    assert "SortMergeJoin" in text
    assert "CartesianProduct" not in text and "NestedLoop" not in text
