"""Small hand-made frames."""

from __future__ import annotations

import json
from datetime import UTC, datetime

from tidemark import schemas

T0 = 1_705_000_000_000  # 2024-01-11 19:06:40 UTC


def utc_day(ms: int) -> str:
    return datetime.fromtimestamp(ms / 1000, UTC).strftime("%Y-%m-%d")


def event(i, ms, user, name, post=None, **payload):
    if post is not None:
        payload["postId"] = post
    return (str(i), ms, json.dumps(payload), "android", user, name, utc_day(ms))


def event_frame(spark, rows):
    return spark.createDataFrame(rows, schemas.EVENT_LOG)


def lock(i, ms, user, post, age=0, **payload):
    return event(i, ms, user, "feed_locked", post, userAge=age, isLocked="true", **payload)


def initiate(i, ms, user, post):
    payload = {"isInitiatedFromPost": "true", "origin": f"post_{post}"}
    return event(i, ms, user, "initiate_transaction", post, **payload)


def trial(i, ms, user):
    return event(i, ms, user, "subscription_trial_started")


def first_call(i, ms, user, age=0):
    return event(i, ms, user, "feed_first_call", userAge=age)


def dump(date, event_name="post_classification_data_dump", raw=None, **payload):
    return (event_name, json.dumps(payload) if raw is None else raw, date)


def dump_frame(spark, rows):
    return spark.createDataFrame(rows, schemas.DUMP_LOG)


def rows(df, *columns):
    names = columns or df.columns
    return sorted(tuple(r[c] for c in names) for r in df.collect())
