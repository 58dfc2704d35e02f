"""The app's tables, derived from the given ones by SQL that reads the same on both engines.

``events`` becomes the event log, ``documents`` the classification dumps, ``region`` and
``nation`` the places, ``supplier`` the creators' profiles. Every row of a table is used. A
third of the events fall on one post and a third of the posts on one creator and district.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import files, schemas
from tidemark.functions import (
    age_zero,
    floor_div,
    has_post,
    ms_to_day,
    on_dates,
    run_params,
    shift_day,
    window_bounds,
)
from tidemark.functions.dates import FEED_TZ
from tidemark.operators.asof import HOUR_MS
from tidemark.operators.events import parse_events
from tidemark.operators.ingest import ingest_events
from tidemark.operators.labels import create_labels
from tidemark.operators.partials import post_partials, user_partials
from tidemark.operators.posts import latest_posts, place_map, with_state
from tidemark.plans.daily import daily_features
from tidemark.plans.jobs import advance_day, advance_days, advance_prefixes
from tidemark.plans.snapshots import full_metrics, snapshot_full, window_events, with_rates
from tidemark.session import shared_dir
from tidemark.sources.readers import dates_between

RUN_TS = 1_705_838_400_000  # 2024-01-21 12:00 UTC, 17:30 in the feed's zone
PREV_RUN_TS = RUN_TS - 6 * HOUR_MS
TODAY = run_params(RUN_TS).date
REF = "2024-01-21"
START, END = "2024-01-08", "2024-01-21"
FEATURE_DATES = ["2024-01-11", "2024-01-15", "2024-01-20", "2024-01-21"]
SLOT_MS = 6 * HOUR_MS

# Engine-specific reading of the raw event columns.
EVENTS_RAW = {
    "spark": """
SELECT event_id, user_id, event_type, unix_micros(CAST(ts AS TIMESTAMP)) AS ts_us,
       date_format(ts, 'yyyy-MM-dd') AS dt, day(ts) AS dom,
       CAST(get_json_object(props, '$.k') AS INT) AS k
FROM @events""",
    "duckdb": """
SELECT event_id, user_id, event_type, epoch_us(ts) AS ts_us,
       strftime(ts, '%Y-%m-%d') AS dt, day(ts) AS dom,
       CAST(json_extract_string(props, '$.k') AS INT) AS k
FROM @events""",
}

EVENTS_KEYED = """
SELECT r.*, CASE WHEN event_id % 3 = 0 THEN 7
            ELSE (user_id * 7 + (k % 5) * 14) % (SELECT count(*) FROM @documents) END AS doc
FROM @events_raw r"""

APPEVENTS = """
SELECT CAST(event_id AS STRING) AS event_id,
       CAST(floor(ts_us / 1000) AS BIGINT) AS event_time,
       '{' || CASE WHEN event_id % 50 = 49 THEN ''
                   ELSE '"postId":"p' || CAST(doc AS STRING) || '",' END
         || '"userAge":' || CAST((user_id + dom) % 4 AS STRING)
         || ',"isLocked":' || CASE WHEN event_id % 10 = 0 THEN 'false'
                                   WHEN event_id % 2 = 0 THEN '"true"' ELSE 'true' END
         || ',"isInitiatedFromPost":' || CASE WHEN event_id % 9 = 0 THEN 'false' ELSE 'true' END
         || ',"origin":"post_p' || CAST(doc AS STRING)
         || '","duration":' || CASE WHEN event_id % 5 = 0 THEN 'null'
                                    ELSE CAST(event_id % 60 AS STRING) END
         || ',"postEngagement":{"mediaClicked":'
         || CASE WHEN event_id % 4 = 0 THEN 'true' ELSE 'false' END
         || ',"readModeOpen":' || CASE WHEN event_id % 7 = 0 THEN 'true' ELSE 'false' END
         || ',"screenTime":' || CAST(event_id % 40 AS STRING)
         || '},"maxListenDuration":' || CAST(event_id % 100 AS STRING)
         || ',"districtId":"d' || CAST(user_id % 25 AS STRING)
         || '","stateId":"s' || CAST(user_id % 5 AS STRING) || '"}' AS data,
       'android' AS platform,
       'u' || CAST(user_id AS STRING) AS user_id,
       CASE event_type
         WHEN 'signup' THEN 'feed_first_call'
         WHEN 'view' THEN 'feed_locked'
         WHEN 'error' THEN 'initiate_transaction'
         WHEN 'purchase' THEN
           CASE event_id % 4 WHEN 0 THEN 'trial_payment_success'
                             WHEN 1 THEN 'subscription_trial_started' ELSE 'post_seen' END
         ELSE CASE event_id % 8
                WHEN 0 THEN 'post_shared' WHEN 1 THEN 'post_reaction'
                WHEN 2 THEN 'comment_created' WHEN 3 THEN 'media_clicked'
                WHEN 4 THEN 'read_mode_entered' WHEN 5 THEN 'post_seen'
                WHEN 6 THEN 'post_reacted' ELSE 'comment_posted' END
       END AS event_name,
       dt AS date
FROM @events_keyed"""

# Even posts use the primary field names, odd ones the alternative names. Some posts are
# dumped again a day later, some twice on a day, and some rows are unusable.
POST_DUMPS = """
WITH d AS (
  SELECT doc_id, source, lang, n_chars, doc_id % 30 AS born,
         1704067200000 + (doc_id % 30) * 86400000 + (doc_id % 1000) * 7001 AS created,
         CASE WHEN doc_id % 3 = 0 THEN 1 ELSE doc_id % 40 END AS creator,
         CASE WHEN doc_id % 3 = 0 THEN 7 ELSE doc_id % 25 END AS place
  FROM @documents
), forms AS (
  SELECT doc_id, born,
         CASE WHEN doc_id % 2 = 0 THEN
           '{"id":"p' || CAST(doc_id AS STRING) || '","created":' || CAST(created AS STRING)
             || ',"topic":"' || source || '"'
             || CASE WHEN doc_id % 7 = 0 THEN '' ELSE ',"subTopic":"st"' END
             || ',"districtImportanceLevel":' || CAST(doc_id % 4 AS STRING)
             || ',"district_score":9,"stateImportanceLevel":' || CAST(doc_id % 3 AS STRING)
             || ',"nationalImportanceLevel":0,"isLocal":true,"is_local":false,"isReporter":'
             || CASE WHEN doc_id % 3 = 0 THEN 'true' ELSE 'false' END
             || ',"contentLang":"' || lang || '","creatorID":"c' || CAST(creator AS STRING)
             || '","media":"video","duration":' || CAST(doc_id % 60 AS STRING)
             || CASE WHEN doc_id % 11 = 10 THEN ''
                     ELSE ',"location":{"pid":"d' || CAST(place AS STRING) || '"}' END
             || ',"titleLength":' || CAST(n_chars % 200 AS STRING)
         ELSE
           '{"postId":"p' || CAST(doc_id AS STRING) || '","createdAt":' || CAST(created AS STRING)
             || ',"sub_topic":"st2","district_score":' || CAST(doc_id % 4 AS STRING)
             || ',"state_score":1,"national_score":2,"is_local":false,"is_reporter":true,"lang":"'
             || lang || '","creator_pid":"c' || CAST(creator AS STRING)
             || '","title":"t' || CAST(doc_id AS STRING)
             || '","district_pid":"d' || CAST(place AS STRING) || '","topic":"' || source || '"'
         END AS body
  FROM d
)
SELECT 'post_classification_data_dump' AS event_name, body || '}' AS data,
       '2024-01-' || lpad(CAST(1 + born AS STRING), 2, '0') AS date
FROM forms
UNION ALL
SELECT CASE WHEN doc_id % 50 = 5 THEN 'other_event' ELSE 'post_classification_data_dump' END,
       CASE WHEN doc_id % 50 = 3 THEN body || ',"open":'
            WHEN doc_id % 50 = 4 THEN ''
            WHEN doc_id % 50 = 6 THEN '{"topic":"no id"}'
            ELSE body || ',"containsVisualMedia":true,"media_duration":0}' END,
       '2024-01-' || lpad(CAST((CASE WHEN doc_id % 4 = 1 THEN 2 ELSE 1 END) + born AS STRING), 2, '0')
FROM forms WHERE doc_id % 4 IN (1, 2) OR doc_id % 50 IN (3, 4, 5, 6)"""

PLACES = """
SELECT 's' || CAST(r_regionkey AS STRING) AS id, 'STATE' AS ty, r_name AS name,
       CAST(NULL AS STRING) AS parentId
FROM @region
UNION ALL
SELECT 'd' || CAST(n_nationkey AS STRING), 'DISTRICT', n_name,
       's' || CASE WHEN n_nationkey = 13 THEN '99' ELSE CAST(n_regionkey AS STRING) END
FROM @nation"""

USERS = """
SELECT 'c' || CAST(s_suppkey AS STRING) AS id, s_acctbal > 5000 AS verified,
       CAST(floor(abs(s_acctbal)) AS BIGINT) AS viewCount
FROM @supplier"""


def _slot() -> Column:
    return (floor_div(F.col("event_time"), SLOT_MS) * SLOT_MS).alias("run_ts")


def _filed() -> Column:
    """Day of the run in the feed's zone, as the writer of snapshots files it."""
    return ms_to_day(F.col("run_ts"), FEED_TZ)


SOURCES = ("events", "documents", "region", "nation", "supplier")


class Fixtures:
    """The derived tables of one data folder.

    The event log, the dumps, the snapshots, the features and the labels are tables at rest in
    production. Here each is written once per session, on first use, to the shared folder and
    read back by every query, so that scans see date partitions and many files.
    """

    _open: dict[tuple[str, str], Fixtures] = {}

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._built: dict[str, DataFrame] = {}
        self._home = files.until_exit(spark, f"{shared_dir(spark)}/tidemark-{uuid.uuid4().hex}")

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str) -> Fixtures:
        key = (spark.sparkContext.applicationId, sf_dir)
        if key not in cls._open:
            cls._open[key] = cls(spark, sf_dir)
        return cls._open[key]

    def raw(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{table}.parquet")

    def scratch(self) -> str:
        """A fresh folder for one query."""
        return f"{self._home}/{uuid.uuid4().hex}"

    def _sql(self, text: str, **tables: DataFrame) -> DataFrame:
        for name in sorted(tables, key=len, reverse=True):
            view = f"tidemark_fixture_{name}"
            tables[name].createOrReplaceTempView(view)
            text = text.replace(f"@{name}", view)
        return self.spark.sql(text)

    def _once(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        if name not in self._built:
            self._built[name] = build()
        return self._built[name]

    def _stored(self, name: str, build: Callable[[], DataFrame], *partitions: str) -> DataFrame:
        def write_and_read() -> DataFrame:
            rows, path = build(), self.path(name)
            balanced = rows.hint("rebalance", *[F.col(p) for p in partitions])
            writer = balanced.write
            (writer.partitionBy(*partitions) if partitions else writer).parquet(path)
            return self.spark.read.schema(rows.schema).parquet(path)

        return self._once(name, write_and_read)

    def path(self, name: str) -> str:
        return f"{self._home}/{name}"

    def events_from(self, raw_events: DataFrame) -> DataFrame:
        raw = self._sql(EVENTS_RAW["spark"], events=raw_events)
        keyed = self._sql(EVENTS_KEYED, events_raw=raw, documents=self.raw("documents"))
        return self._sql(APPEVENTS, events_keyed=keyed)

    @property
    def events(self) -> DataFrame:
        return self._stored("events", lambda: self.events_from(self.raw("events")), "date")

    @property
    def dumps(self) -> DataFrame:
        build = lambda: self._sql(POST_DUMPS, documents=self.raw("documents"))
        return self._stored("dumps", build, "event_name", "date")

    @property
    def places(self) -> DataFrame:
        return self._once(
            "places",
            lambda: self._sql(PLACES, region=self.raw("region"), nation=self.raw("nation")),
        )

    @property
    def users(self) -> DataFrame:
        return self._once("users", lambda: self._sql(USERS, supplier=self.raw("supplier")))

    @property
    def mapping(self) -> DataFrame:
        return self._once("mapping", lambda: place_map(self.places))

    @property
    def posts(self) -> DataFrame:
        return self._once("posts", lambda: latest_posts(self.dumps))

    @property
    def truthy_posts(self) -> DataFrame:
        return self._once("truthy_posts", lambda: latest_posts(self.dumps, "truthy"))

    @property
    def grid(self) -> DataFrame:
        """Post, run and date of the snapshots: of ``series`` where it is at rest, else without its counts."""
        if "series" in self._built:
            return self.series.select("post_id", "run_ts", "date")
        return self._stored("grid", self._grid, "date")

    def _grid(self) -> DataFrame:
        parsed = parse_events(self.events, "post_id").filter(has_post())
        slots = parsed.select("post_id", _slot()).distinct()
        return slots.join(self.posts.select("post_id"), "post_id").withColumn("date", _filed())

    @property
    def series(self) -> DataFrame:
        """A snapshot of a post for every six-hour slot in which it had an event.

        All 34 columns, counting the events of the slot.
        """
        return self._stored("series", self._series, "date")

    def _series(self) -> DataFrame:
        name = F.col("event_name")
        locked = (name == "feed_locked") & (F.col("is_locked") == "true")
        initiated = (name == "initiate_transaction") & (F.col("from_post") == "true")
        trialed = name == "subscription_trial_started"
        duration = F.when(name == "feed_locked", F.col("duration"))
        parsed = parse_events(
            self.events, "post_id", "user_age", "is_locked", "from_post", "duration"
        ).filter(has_post())
        counts = parsed.groupBy("post_id", _slot()).agg(
            F.count_if(locked).alias("views"),
            F.count_if(name == "post_shared").alias("shareCount"),
            F.count_if(name == "media_clicked").alias("mediaClickedCount"),
            F.count_if(name == "post_reaction").alias("reactionCount"),
            F.count_if(name == "comment_created").alias("commentCount"),
            F.count_if(name == "read_mode_entered").alias("readModeCount"),
            F.coalesce(F.avg(duration), F.lit(0.0)).alias("avgDur"),
            F.count_if(locked).alias("post_locks_so_far"),
            F.count_if(initiated).alias("post_initiates_so_far"),
            F.count_if(trialed).alias("post_trials_so_far"),
            F.count_if(locked & age_zero()).alias("post_day0_locks"),
            F.count_if(initiated & age_zero()).alias("post_day0_initiates"),
            F.count_if(trialed & age_zero()).alias("post_day0_trials"),
        )
        located = with_state(self.posts, self.mapping)
        rows = counts.join(located, "post_id").withColumn("listenpct", F.lit(0.0))
        filed = with_rates(rows, "a").withColumn("date", _filed())
        return filed.select(*schemas.SNAPSHOT_COLUMNS, "date")

    @property
    def features(self) -> dict[str, DataFrame]:
        """The daily feature tables of several dates, each worked out for its own date."""
        built: dict[str, DataFrame] = {}

        def table(kind: str) -> DataFrame:
            for date in FEATURE_DATES if not built else ():
                bounds = window_bounds(date)
                events = self.events.filter(on_dates(bounds.first_date, bounds.last_date))
                for name, rows in daily_features(self.posts, events, self.mapping, date).items():
                    rows = rows.withColumn("date", F.lit(date))
                    built[name] = built[name].unionByName(rows) if name in built else rows
            return built[kind]

        return {
            kind: self._stored(kind, lambda kind=kind: table(kind), "date")
            for kind in schemas.FEATURES
        }

    @property
    def sliding(self) -> str:
        """Folder of the sliding tables: seventeen days at once, then date by date."""

        def build() -> str:
            self.events  # noqa: B018  (writes the log)
            base = self.path("sliding")
            advance_days(self.spark, self.path("events"), base, "2024-01-01", "2024-01-17")
            for date in dates_between("2024-01-18", FEATURE_DATES[-1]):
                advance_day(self.spark, self.path("events"), base, date)
            return base

        return self._once("sliding", build)

    @property
    def prefixes(self) -> str:
        """Folder of the counts at rest: seventeen days at once, then date by date."""

        def build() -> str:
            self.events  # noqa: B018  (writes the log)
            base = self.path("prefixes")
            advance_prefixes(self.spark, self.path("events"), base, "2024-01-01", "2024-01-17")
            for date in dates_between("2024-01-18", "2024-01-20"):
                advance_prefixes(self.spark, self.path("events"), base, date, date)
            return base

        return self._once("prefixes", build)

    @property
    def previous(self) -> DataFrame:
        """The snapshot of the run before, with some posts about to leave the window."""

        def build() -> DataFrame:
            window = self.dumps.filter(on_dates(shift_day(TODAY, -9), TODAY))
            posts = latest_posts(window, "truthy").filter(F.col("created_ts") < PREV_RUN_TS)
            return snapshot_full(self.events, posts, PREV_RUN_TS, self.mapping)

        return self._stored("previous", build)

    @property
    def damaged(self) -> DataFrame:
        """The event log with some payloads cut short and some missing."""
        number, data = F.col("event_id").cast("bigint") % 97, F.col("data")
        cut = F.when(number == 5, F.substring(data, 1, 20)).when(number == 6, F.lit("")).when(number != 7, data)
        return self.events.withColumn("data", cut)

    @property
    def ingested(self) -> DataFrame:
        """The log parsed once, at rest."""
        return self._stored("ingested", lambda: ingest_events(self.damaged), "date")

    @property
    def no_metrics(self) -> DataFrame:
        """Metrics of no post."""
        return full_metrics(self.events.filter(F.lit(False)))

    @property
    def state(self) -> tuple[DataFrame, DataFrame]:
        """Counters of the events up to the run before, as a scheduled run leaves them."""
        seen = lambda: window_events(self.events, PREV_RUN_TS)
        by_post = self._stored("state_post", lambda: post_partials(seen()), "date")
        return by_post, self._stored("state_user", lambda: user_partials(seen()), "date")

    def labels(self, window: str = "same_day") -> DataFrame:
        build = lambda: create_labels(self.events, self.grid, START, END, window)
        return self._stored(f"labels_{window}", build, "date")
