"""Event payloads and user sets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark import schemas
from tidemark.functions import named, on_dates, origin_post
from tidemark.skew import salted_lookup
from tidemark.vocab import VOCAB_A, Vocabulary

# payload column -> (top-level payload field, expression on the parsed payload)
_FIELDS = {
    "post_id": ("postId", lambda p: p["postId"]),
    "user_age": ("userAge", lambda p: p["userAge"]),
    "is_locked": ("isLocked", lambda p: p["isLocked"]),
    "from_post": ("isInitiatedFromPost", lambda p: p["isInitiatedFromPost"]),
    "origin": ("origin", lambda p: p["origin"]),
    "origin_post_id": ("origin", lambda p: origin_post(p["origin"])),
    "duration": ("duration", lambda p: p["duration"].try_cast("double")),
    "media_clicked": ("postEngagement", lambda p: p["postEngagement.mediaClicked"]),
    "read_mode_open": ("postEngagement", lambda p: p["postEngagement.readModeOpen"]),
    "screen_time": ("postEngagement", lambda p: p["postEngagement.screenTime"].try_cast("int")),
    "max_listen": ("maxListenDuration", lambda p: p["maxListenDuration"].try_cast("int")),
    "district_pid": ("districtId", lambda p: p["districtId"]),
    "state_pid": ("stateId", lambda p: p["stateId"]),
}

_RAW = ["event_id", "event_time", "user_id", "event_name", "date"]


class _Payload:
    """Field access on the parsed payload column."""

    def __getitem__(self, path: str):
        return F.col(f"_payload.{path}")


def parse_events(events: DataFrame, *fields: str) -> DataFrame:
    """Raw columns plus the named payload fields, from one JSON parse per event.

    Filter on raw columns before calling this: the parse is the costly step. Malformed
    payloads give null fields. Events that were parsed when they came in
    (:mod:`tidemark.operators.ingest`) are not parsed again.

    The payload leaves a generator, past which no filter on a field is pushed: as a plain column
    it would be parsed once for the filter and once more for the rows that are left.
    """
    wanted = fields or tuple(_FIELDS)
    if "data" not in events.columns:
        return events.select(*[c for c in _RAW if c in events.columns], *wanted)
    needed = {_FIELDS[name][0] for name in wanted}
    schema = StructType([f for f in schemas.EVENT_PAYLOAD.fields if f.name in needed])
    raw = [c for c in _RAW if c in events.columns]
    payload = _Payload()
    parsed = events.select(*raw, F.explode(F.array(F.from_json("data", schema))).alias("_payload"))
    return parsed.select(*raw, *[_FIELDS[name][1](payload).alias(name) for name in wanted])


def in_posts(df: DataFrame, posts: DataFrame) -> DataFrame:
    """Rows whose post is in the given set."""
    return df.join(posts.select("post_id"), "post_id", "left_semi")


def day0_users(
    events: DataFrame,
    start: str | None = None,
    end: str | None = None,
    vocab: Vocabulary = VOCAB_A,
) -> DataFrame:
    """Distinct users whose first-call event carries age 0, over a date range."""
    calls = events.filter(named(vocab.first_call) & on_dates(start, end))
    return (
        parse_events(calls, "user_age").filter(F.col("user_age") == "0").select("user_id").distinct()
    )


def flag_day0(events: DataFrame, day0: DataFrame) -> DataFrame:
    """Adds ``is_day0`` (0/1) by membership of the user."""
    marks = day0.select("user_id", F.lit(1).alias("is_day0"))
    return salted_lookup(events, marks, ["user_id"], ["event_time"]).select(
        *events.columns, F.coalesce("is_day0", F.lit(0)).alias("is_day0")
    )


def only_day0(events: DataFrame, day0: DataFrame) -> DataFrame:
    """Events of the given users."""
    users = day0.select("user_id")
    kept = salted_lookup(events, users, ["user_id"], ["event_time"], how="left_semi")
    return kept.select(*events.columns)


def locks(events: DataFrame, vocab: Vocabulary = VOCAB_A) -> DataFrame:
    """Locked feed views: user, time, post and age."""
    parsed = parse_events(events.filter(named(vocab.locked)), "post_id", "user_age", "is_locked")
    return parsed.filter(F.col("is_locked") == "true").select(
        "user_id", "event_time", "post_id", "user_age", "date"
    )


def initiates(events: DataFrame, by: str = "post_id", vocab: Vocabulary = VOCAB_A) -> DataFrame:
    """Transactions initiated from a post, attributed by post id or by origin."""
    column = {"post_id": "post_id", "origin": "origin_post_id"}[by]
    parsed = parse_events(events.filter(named(vocab.initiate)), column, "from_post")
    return parsed.filter(F.col("from_post") == "true").select(
        "user_id", "event_time", F.col(column).alias("post_id"), "date"
    )


def trials(events: DataFrame, vocab: Vocabulary = VOCAB_A) -> DataFrame:
    return events.filter(named(vocab.trial)).select("user_id", "event_time", "date")
