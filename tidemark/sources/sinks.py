"""Writers. Each replaces the partitions its run owns, also those it has no rows for any more, and no
others: a repeated run changes nothing, and one with corrected input leaves nothing stale."""

from __future__ import annotations

import json
from collections.abc import Iterable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark import files, schemas
from tidemark.functions import ms_to_day, run_params
from tidemark.functions.dates import FEED_TZ
from tidemark.sources.readers import catalogue
from tidemark.sources.readers import dates_between as dates_between


def _replace(df: DataFrame, *partitions: str) -> DataFrameWriter:
    """Writer over evenly sized tasks; a partition with much data gets several files."""
    balanced = df.hint("rebalance", *[F.col(p) for p in partitions])
    return (
        balanced.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions)
    )


def _folder(df: DataFrame, *partitions: str) -> DataFrameWriter:
    """Writer of one folder, which ends up empty when there are no rows."""
    return df.drop(*partitions).hint("rebalance").write.mode("overwrite")


def _replace_dates(df: DataFrame, base: str, owned: Iterable[str] | None) -> None:
    """Writes by ``date`` and empties those of the ``owned`` dates that got no row."""
    seen = Observation()
    rows = df.observe(seen, F.collect_set("date").alias("dates"))
    _replace(rows, "date").option("compression", "snappy").parquet(base)
    if owned is not None:
        none = df.sparkSession.createDataFrame([], df.schema)
        try:
            written = seen.get["dates"]
        except Py4JJavaError:  # of a plan that turns out empty Spark may drop the observation too
            written = [r["date"] for r in df.select("date").distinct().collect()]
        for date in sorted(set(owned) - set(written)):
            _folder(none, "date").parquet(f"{base.rstrip('/')}/date={date}")


def write_snapshot(
    df: DataFrame, base: str, run_ts: int, layout: str = "slot", tz: str = FEED_TZ
) -> None:
    """JSON lines under ``date=/run=HHMM/``, or under ``ts=<ms>/`` with ``layout="ts"``.

    A finished run of the first layout is entered in the catalogue, with its time, rows and files, after its files are there.
    """
    run = run_params(run_ts, tz)
    base = base.rstrip("/")
    own = f"ts={run_ts}" if layout == "ts" else f"date={run.date}/run={run.slot}"
    _folder(df).option("ignoreNullFields", "false").json(f"{base}/{own}")
    if layout != "ts":
        spark = df.sparkSession
        found = [f"{own}/{n}" for n in files.names(spark, f"{base}/{own}") if not n.startswith(("_", "."))]
        entry = {"run_ts": run_ts, "rows": spark.read.text(f"{base}/{own}").count(), "files": found}
        files.write(spark, f"{catalogue(base, run.date)}/{run.slot}.json", json.dumps(entry))


def write_features(df: DataFrame, base: str, kind: str, date: str) -> None:
    """One date of a daily feature table, in the table's declared columns."""
    schema = schemas.FEATURES[kind]
    rows = df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields if f.name != "date"])
    _folder(rows).parquet(f"{base.rstrip('/')}/{kind}/date={date}")


def write_sliding(df: DataFrame, base: str, table: str, date: str) -> None:
    """One date of a sliding table."""
    _folder(df, "date").parquet(f"{base.rstrip('/')}/{table}/date={date}")


def write_sliding_dates(df: DataFrame, base: str, table: str, owned: Iterable[str]) -> None:
    """A sliding table of all ``owned`` dates."""
    _replace_dates(df, f"{base.rstrip('/')}/{table}", owned)


def write_prefixes(df: DataFrame, base: str, table: str, owned: Iterable[str]) -> None:
    """Blocks of counts at rest that end on the ``owned`` dates."""
    _replace_dates(df, f"{base.rstrip('/')}/{table}", owned)


def write_labels(df: DataFrame, base: str, owned: Iterable[str] | None = None) -> None:
    """Labels by the date of their view; ``owned`` names the dates the run answers for."""
    _replace_dates(df.select(*schemas.LABELS.fieldNames()), base, owned)


def write_training(
    df: DataFrame, base: str, tz: str = "UTC", owned: Iterable[str] | None = None
) -> None:
    """Training rows by the day of their snapshot; ``owned`` names the days the run answers for."""
    _replace_dates(df.withColumn("date", ms_to_day(F.col("run_ts"), tz)), base, owned)


def write_place_map(df: DataFrame, path: str) -> None:
    df.select(*schemas.PLACE_MAP.fieldNames()).write.mode("overwrite").json(path)


def create_tables(
    spark: SparkSession,
    snapshots_base: str,
    labels_base: str,
    database: str = "default",
) -> None:
    """External tables over snapshot and label folders, partitioned by date."""
    for table, schema, partitions, source, base in (
        ("dynamic_snapshots", schemas.SNAPSHOT, "date STRING, run STRING", "JSON", snapshots_base),
        ("training_labels", schemas.LABELS, "date STRING", "PARQUET", labels_base),
    ):
        columns = [f"{f.name} {f.dataType.simpleString()}" for f in schema.fields if f.name != "date"]
        names = ", ".join(p.split()[0] for p in partitions.split(", "))
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {database}.{table} "
            f"({', '.join(columns)}, {partitions}) USING {source} "
            f"PARTITIONED BY ({names}) LOCATION '{base}'"
        )


def register_partitions(spark: SparkSession, table: str) -> None:
    """Registers every partition folder found under the table's location."""
    spark.catalog.recoverPartitions(table)
