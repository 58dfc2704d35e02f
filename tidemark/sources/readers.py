"""Readers. A missing date is no error. Given a range of dates, a reader lists the folders of these dates and no others."""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructType

from tidemark import files, schemas
from tidemark.functions import dates_between as dates_between
from tidemark.functions import ms_to_day, named, on_dates, run_params, shift_day, to_epoch_ms
from tidemark.functions.dates import FEED_TZ
from tidemark.operators import prefixes
from tidemark.operators.sliding import SEEN, TOTALS
from tidemark.vocab import DUMP_EVENT


def _dated(
    reader: DataFrameReader, form: str, schema, base: str, start: str | None, end: str | None, under: str = ""
) -> DataFrame:
    """A table laid out by ``date=`` below ``base`` and ``under``, of a range of dates.

    An open range is left to partition filters; of a closed one, only the folders that exist are opened.
    """
    reader, base = reader.format(form).schema(schema), base.rstrip("/")
    if start is None or end is None:
        return reader.load(base).filter(on_dates(start, end))
    spark = SparkSession.active()
    found = files.present(spark, [f"{base}{under}/date={d}" for d in dates_between(start, end)] if start <= end else [])
    if not found:
        return spark.createDataFrame([], schema)
    return reader.option("basePath", base).load(found).filter(on_dates(start, end))


def read_events(
    spark: SparkSession,
    path: str,
    start: str | None = None,
    end: str | None = None,
    names: Iterable[str] | None = None,
) -> DataFrame:
    """Event log by date range and event names; both filters reach the scan."""
    events = _dated(spark.read, "parquet", schemas.EVENT_LOG, path, start, end)
    return events if names is None else events.filter(named(names))


def read_dumps(
    spark: SparkSession, base: str, since: str | None = None, until: str | None = None
) -> DataFrame:
    """Classification dumps under ``event_name=/date=`` folders, over a date range."""
    dumps = _dated(spark.read, "parquet", schemas.DUMP_LOG, base, since, until, f"/event_name={DUMP_EVENT}")
    return dumps.filter(F.col("event_name") == DUMP_EVENT)


def event_files(spark: SparkSession, path: str, start: str, end: str) -> DataFrame:
    """(date, path, uri) of the event log's files of a range of dates, from the listing alone.

    Files do not change once they are there; ``uri`` is how a scan names them.
    """
    found = files.present(spark, [f"{path.rstrip('/')}/date={d}" for d in dates_between(start, end)])
    if not found:
        return spark.createDataFrame([], "date string, path string, uri string")
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(found)
    date = F.regexp_extract("path", "/date=([^/]+)/", 1).alias("date")
    return listed.select(date, "path", F.col("_metadata.file_path").alias("uri"))


#: Files named one by one to a scan; of more, those wanted are picked from a scan of their dates.
NAMED = 10_000


def read_event_files(spark: SparkSession, path: str, chosen: DataFrame, named: int = NAMED) -> DataFrame:
    """Rows of some files of the event log, as :func:`event_files` lists them."""
    some = chosen.select("path").limit(named + 1).collect()
    reader = spark.read.schema(schemas.EVENT_LOG).option("basePath", path.rstrip("/"))
    if not some:
        return spark.createDataFrame([], schemas.EVENT_LOG)
    if len(some) <= named:
        return reader.parquet(*[r["path"] for r in some])
    first, last = chosen.agg(F.min("date"), F.max("date")).first()
    rows = read_events(spark, path, first, last).select("*", F.col("_metadata.file_path").alias("uri"))
    return rows.join(chosen.select("uri"), "uri", "left_semi").select(*schemas.EVENT_LOG.fieldNames())


def read_place_map(spark: SparkSession, path: str) -> DataFrame:
    """District map, from rows or from one JSON object keyed by district."""
    text = spark.read.text(path, wholetext=True)
    entries = text.select(F.explode(F.from_json("value", schemas.PLACE_OBJECT)).alias("k", "v"))
    return entries.select(F.col("k").alias("district_pid"), "v.*")


def read_place_rows(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.PLACE_MAP).json(path)


def read_places(spark: SparkSession, path: str) -> DataFrame:
    """Place tree from a JSON array."""
    return spark.read.schema(schemas.PLACE).json(path, multiLine=True)


_SLOT = StructType().add("date", StringType()).add("run", StringType())


def _snapshot_layout() -> StructType:
    return StructType([*schemas.SNAPSHOT.fields, *_SLOT.fields])


def snapshots_table(
    spark: SparkSession, base: str, start: str | None = None, end: str | None = None
) -> DataFrame:
    """Snapshots of a date range, 34 columns and their partition ``date`` and ``run``.

    ``run_ts`` may be epoch-ms or ISO text with an offset.
    """
    fields = [
        f if f.name != "run_ts" else StructType().add("run_ts", StringType()).fields[0]
        for f in _snapshot_layout().fields
    ]
    raw = _dated(spark.read, "json", StructType(fields), base, start, end)
    text = F.col("run_ts")
    return raw.withColumn("run_ts", F.coalesce(text.try_cast("bigint"), to_epoch_ms(text)))


def read_snapshot_ts(spark: SparkSession, base: str, ts: int | None = None) -> DataFrame:
    """Variant B snapshots under ``ts=`` folders."""
    schema = StructType([*schemas.SNAPSHOT_B.fields]).add("ts", LongType())
    table = spark.read.schema(schema).json(base)
    return table if ts is None else table.filter(F.col("ts") == ts)


def catalogue(base: str, date: str) -> str:
    """Folder that names the finished runs of a date. Spark takes no notice of it when it reads ``base``."""
    return f"{base.rstrip('/')}/_runs/date={date}"


def list_runs(spark: SparkSession, base: str, start: str, end: str) -> list[tuple[str, str]]:
    """(date, run) of the finished runs of a date range, in order.

    They are looked up in the catalogue that :func:`tidemark.sources.sinks.write_snapshot` keeps; no data folder is opened.
    A date that is not in it, since others wrote it, is listed.
    """
    found, unknown = [], []
    for date in dates_between(start, end):
        runs = files.names(spark, catalogue(base, date))
        found += [(date, n.removesuffix(".json")) for n in runs]
        unknown += [] if runs else [f"{base.rstrip('/')}/date={date}"]
    folders = files.present(spark, unknown)
    if folders:
        listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folders)
        name = lambda part: F.regexp_extract("path", f"/{part}=([^/]+)/", 1)
        slots = listed.select(name("date").alias("date"), name("run").alias("run")).distinct()
        found += [(r["date"], r["run"]) for r in slots.collect()]  # 96 a day at most
    return sorted(found)


def run_entry(spark: SparkSession, base: str, date: str, run: str) -> dict | None:
    """What the catalogue holds of a run: its time, its rows and its files; None if it is not in it."""
    path = f"{catalogue(base, date)}/{run}.json"
    return json.loads(files.read_text(spark, path)) if files.present(spark, [path]) else None


def is_cold_start(spark: SparkSession, base: str, date: str) -> bool:
    """True when neither the date nor the day before has a snapshot."""
    return not list_runs(spark, base, shift_day(date, -1), date)


def latest_run(
    spark: SparkSession, base: str, before_ts: int, tz: str = FEED_TZ, days: int = 7
) -> tuple[str, str] | None:
    """(date, run) of the last snapshot strictly before a run, at most ``days`` dates back."""
    now = run_params(before_ts, tz)
    runs = list_runs(spark, base, shift_day(now.date, -days), now.date)
    return max((slot for slot in runs if slot < (now.date, now.slot)), default=None)


def read_snapshot(
    spark: SparkSession, base: str, before_ts: int, tz: str = FEED_TZ, days: int = 7
) -> DataFrame:
    """The last snapshot strictly before a run, at most ``days`` dates back; empty when there is none."""
    slot = latest_run(spark, base, before_ts, tz, days)
    if slot is None:
        return spark.createDataFrame([], schemas.SNAPSHOT)
    date, run = slot
    rows = snapshots_table(spark, base, date, date).filter(F.col("run") == run)
    return rows.select(*schemas.SNAPSHOT_COLUMNS)


def labels_table(
    spark: SparkSession,
    base: str,
    start: str | None = None,
    end: str | None = None,
    tz: str = "UTC",
) -> DataFrame:
    """Labels whose snapshot was taken in a date range, both days included.

    A view never precedes its snapshot and follows it within two days, so dates of the folders are
    bounded on both sides.
    """
    day = ms_to_day(F.col("run_ts"), tz)
    first, last = start and shift_day(start, -1), end and shift_day(end, 3)
    table = _dated(spark.read, "parquet", schemas.LABELS, base, first, last)
    table = table if start is None else table.filter(day >= start)
    return table if end is None else table.filter(day <= end)


def features_table(
    spark: SparkSession, base: str, kind: str, start: str | None = None, end: str | None = None
) -> DataFrame:
    """One daily feature table over a date range."""
    path = f"{base.rstrip('/')}/{kind}"
    return _dated(spark.read, "parquet", schemas.FEATURES[kind], path, start, end)


def sliding_table(spark: SparkSession, base: str, table: str, dates: Iterable[str]) -> DataFrame:
    """A sliding table at the end of some dates; a date that is missing has no rows."""
    schema = {"seen": SEEN, "totals": TOTALS}[table]
    base = f"{base.rstrip('/')}/{table}"
    found = files.present(spark, [f"{base}/date={d}" for d in dict.fromkeys(dates)])
    if not found:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", base).parquet(*found)


def prefix_range(spark: SparkSession, base: str) -> tuple[str, str] | None:
    """First and last date of the counts at rest under ``base``; None before the first."""
    path = f"{base.rstrip('/')}/dates.json"
    return tuple(json.loads(files.read_text(spark, path))) if files.present(spark, [path]) else None


def prefix_table(spark: SparkSession, base: str, table: str, until: str) -> DataFrame:
    """Blocks of counts at rest that together hold all dates up to ``until``; opens no other date.

    Dates before the first have no rows. LookupError if ``until`` is past the last date counted.
    """
    known = prefix_range(spark, base)
    if known is None:
        raise LookupError(f"no counts at rest under {base}")
    since, last = known
    if until > last and until >= since:
        raise LookupError(f"counts at rest end with {last}, {until} was asked for")
    return prefix_blocks(spark, base, table, prefixes.blocks_up_to(until, since))


def prefix_blocks(spark: SparkSession, base: str, table: str, ends: Iterable[str]) -> DataFrame:
    """Blocks of counts at rest that end on some dates, whether they are offered to readers yet or not."""
    schema, root = prefixes.table_schema(table), f"{base.rstrip('/')}/{table}"
    found = files.present(spark, [f"{root}/date={d}" for d in ends])
    if not found:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", root).parquet(*found)


def as_table(df: DataFrame, name: str) -> DataFrame:
    """Registers a finished result under a name for SQL."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)
