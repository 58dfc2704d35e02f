"""Events and dumps parsed once, when they come in, with the reason where a payload cannot be used.

No row is dropped: one whose payload is bad keeps its raw columns, since some events count without a payload, and its reason. The
rejects are the rows with a reason, with the payload as it came.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemark import schemas
from tidemark.operators.events import _FIELDS, _RAW, _Payload
from tidemark.vocab import DUMP_EVENT

NO_PAYLOAD, MALFORMED, NO_TIME, NO_EVENT, NO_ID = "no payload", "malformed", "no time", "no event name", "no post id"
_BAD = "_unread"


def _parsed(rows: DataFrame, schema: StructType) -> DataFrame:
    """Adds the payload, parsed once; its field ``_unread`` holds the text of one that is no JSON object."""
    whole = StructType([*schema.fields, StructField(_BAD, StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD}
    return rows.withColumn("_payload", F.from_json("data", whole, options))


def _first_of(*reasons: tuple[Column, str]) -> Column:
    """The first reason that holds; null if none does."""
    out = F.lit(None).cast("string")
    for condition, name in reversed(reasons):
        out = F.when(condition, F.lit(name)).otherwise(out)
    return out


def _unusable() -> list[tuple[Column, str]]:
    blank = F.col("data").isNull() | (F.trim("data") == "")
    return [(blank, NO_PAYLOAD), (F.col(f"_payload.{_BAD}").isNotNull(), MALFORMED)]


def ingest_events(events: DataFrame) -> DataFrame:
    """Raw columns, all payload fields as :func:`tidemark.operators.events.parse_events` gives them, ``reason``, and ``unread``,
    the payload of an event with a reason. Every operator on events takes this in place of the log."""
    reason = _first_of(*_unusable(), (F.col("event_time").isNull(), NO_TIME), (F.col("event_name").isNull(), NO_EVENT))
    payload = _Payload()
    rows = _parsed(events, schemas.EVENT_PAYLOAD).withColumn("reason", reason)
    fields = [expression(payload).alias(name) for name, (_, expression) in _FIELDS.items()]
    unread = F.when(F.col("reason").isNotNull(), F.col("data")).alias("unread")
    return rows.select(*[c for c in _RAW if c in events.columns], *fields, "reason", unread)


def dump_rejects(dumps: DataFrame) -> DataFrame:
    """Rows of the classification dumps that give no post: date, ``reason`` and ``unread``."""
    ids = StructType([StructField("id", StringType()), StructField("postId", StringType())])
    named = F.coalesce(F.nullif(F.col("_payload.id"), F.lit("")), F.nullif(F.col("_payload.postId"), F.lit("")))
    rows = _parsed(dumps.filter(F.col("event_name") == DUMP_EVENT), ids)
    rows = rows.select("date", _first_of(*_unusable(), (named.isNull(), NO_ID)).alias("reason"), F.col("data").alias("unread"))
    return rows.filter(F.col("reason").isNotNull())


def reject_counts(rows: DataFrame) -> DataFrame:
    """Rows with each reason on each date."""
    rejected = rows.filter(F.col("reason").isNotNull())
    return rejected.groupBy("date", "reason").agg(F.count(F.lit(1)).alias("rejected"))
