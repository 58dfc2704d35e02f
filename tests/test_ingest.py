"""Payloads parsed once: good, bad and missing ones."""

from frames import T0, dump, dump_frame, event, event_frame, lock, rows, utc_day

from tidemark import schemas
from tidemark.operators import engagement as en
from tidemark.operators.events import parse_events
from tidemark.operators.ingest import dump_rejects, ingest_events, reject_counts


def raw(i, data, at=T0, name="feed_locked"):
    return (str(i), at, data, "android", "u", name, utc_day(T0))


def log(spark):
    return event_frame(
        spark,
        [
            lock(1, T0, "u", "p", duration=2.5),
            event(2, T0, "u", "post_shared", "p"),
            raw(3, '{"postId":"p","userAge":'),
            raw(4, None),
            raw(5, "  "),
            raw(6, "[1, 2]"),
            raw(7, '"text"'),
            raw(8, '{"postId":"p"}', at=None),
            raw(9, '{"postId":"p"}', name=None),
            raw(10, "{}"),
        ],
    )


def test_every_event_is_kept_with_its_reason(spark):
    got = {r["event_id"]: r for r in ingest_events(log(spark)).collect()}
    reasons = {int(k): r["reason"] for k, r in got.items() if r["reason"]}
    assert reasons == {3: "malformed", 4: "no payload", 5: "no payload", 6: "malformed", 7: "malformed", 8: "no time", 9: "no event name"}
    assert got["3"]["unread"] == '{"postId":"p","userAge":' and got["1"]["unread"] is None
    assert got["3"]["post_id"] is None and got["10"]["reason"] is None
    assert rows(reject_counts(ingest_events(log(spark))), "reason", "rejected") == [("malformed", 3), ("no event name", 1), ("no payload", 2), ("no time", 1)]
    assert ingest_events(event_frame(spark, [])).count() == 0


def test_operators_read_the_parsed_events_without_another_parse(spark):
    events = log(spark)
    parsed = ingest_events(events)
    same = [str(r) for r in sorted(parse_events(events).collect(), key=str)]
    assert [str(r) for r in sorted(parse_events(parsed).collect(), key=str)] == same
    assert rows(en.engagement_a(parsed)) == rows(en.engagement_a(events))


def test_at_rest_nothing_is_parsed(spark, tmp_path):
    parsed = ingest_events(log(spark))
    parsed.write.partitionBy("date").parquet(str(tmp_path / "parsed"))
    stored = spark.read.schema(parsed.schema).parquet(str(tmp_path / "parsed"))
    plan = en.engagement_a(stored)._jdf.queryExecution().executedPlan().toString()
    assert "from_json" not in plan and "get_json_object" not in plan
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "unread" not in scan.split("ReadSchema: ")[1]


def test_dumps_that_give_no_post(spark):
    day = utc_day(T0)
    dumps = dump_frame(spark, [dump(day, id="p1"), dump(day, postId="p2"), dump(day, topic="x"), dump(day, id=""), dump(day, raw=""), dump(day, raw='{"id":'), dump(day, event_name="other", raw="")])
    assert rows(reject_counts(dump_rejects(dumps)), "reason", "rejected") == [("malformed", 1), ("no payload", 1), ("no post id", 2)]
    assert schemas.DUMP_LOG.fieldNames() == dumps.columns
