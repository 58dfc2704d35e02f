"""Daily tables that slide: a date adds one date of events, whatever the length of the windows.

``seen`` holds one row per post and user, the last lock of the user on the post, for as long as it lies in the window. Whether a user
counts in a window depends on nothing else, so distinct users of any place come from one date of this table.

``totals`` holds running counts per post at the end of each date, so that the events of a range of dates are the difference
of two rows. Windows begin at midnight of the feed's zone and the log is filed by UTC dates; of a date, the events that already
belong to the next day of the zone, or still to the day before, are kept beside the totals and taken off or added.
"""

from __future__ import annotations

from datetime import datetime
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import dates_between, day_ms, default, ms_to_day, shift_day
from tidemark.functions.dates import FEED_TZ

SEEN = "post_id string, user_id string, last_seen bigint, date string"
TOTALS = (
    "post_id string, locks bigint, initiates bigint, ahead_locks bigint, ahead_initiates bigint, behind_locks bigint, "
    "behind_initiates bigint, since string, active string, date string"
)
COUNTS = ("locks", "initiates")
EDGES = tuple(f"{edge}_{kind}" for edge in ("ahead", "behind") for kind in COUNTS)
#: Dates without events after which a post leaves the totals.
IDLE = 30


def advance_seen(previous: DataFrame, locks: DataFrame, date: str, tz: str = FEED_TZ, days: int = 7) -> DataFrame:
    """``seen`` at the end of a date, from that of the date before and the locks of the date."""
    kept = previous.select("post_id", "user_id", "last_seen")
    new = locks.select("post_id", "user_id", F.col("event_time").alias("last_seen"))
    rows = kept.unionByName(new).filter(F.col("last_seen") >= day_ms(shift_day(date, -days), tz))
    return rows.groupBy("post_id", "user_id").agg(F.max("last_seen").alias("last_seen")).withColumn("date", F.lit(date))


def seen_over(
    previous: DataFrame, locks: DataFrame, first: str, last: str, tz: str = FEED_TZ, days: int = 7
) -> DataFrame:
    """``seen`` at the end of every date of a range, in one pass: what :func:`advance_seen` gives date by date.

    A lock stands in the table from the date it is filed under until it leaves the window, in no more rows than there are to write.
    """
    kept = previous.select("post_id", "user_id", "last_seen", F.lit(first).alias("filed"))
    new = locks.groupBy("post_id", "user_id", F.col("date").alias("filed")).agg(F.max("event_time").alias("last_seen"))
    ends = [
        F.struct(F.lit(d).alias("date"), F.lit(day_ms(shift_day(d, -days), tz)).alias("start")) for d in dates_between(first, last)
    ]
    inside = F.filter(F.array(*ends), lambda end: (end["date"] >= F.col("filed")) & (end["start"] <= F.col("last_seen")))
    rows = kept.unionByName(new).select("post_id", "user_id", "last_seen", F.explode(inside["date"]).alias("date"))
    return rows.groupBy("post_id", "user_id", "date").agg(F.max("last_seen").alias("last_seen"))


def as_locks(seen: DataFrame) -> DataFrame:
    """The last lock of every user on a post, in the form of :func:`tidemark.operators.events.locks`."""
    return seen.select("user_id", F.col("last_seen").alias("event_time"), "post_id")


def advance_totals(
    previous: DataFrame, locks: DataFrame, initiates: DataFrame, date: str, tz: str = FEED_TZ, idle: int = IDLE
) -> DataFrame:
    """``totals`` at the end of a date, from those of the date before and the events of the date.

    A post leaves after ``idle`` dates without events, and begins anew if there are further ones.
    """
    today = _counts_on(locks.withColumn("date", F.lit(date)), initiates.withColumn("date", F.lit(date)), tz)
    rows = _without_edges(previous).filter(F.col("active") > shift_day(date, -idle)).unionByName(today)
    sums = [F.sum(c).alias(c) for c in (*COUNTS, *EDGES)]
    summed = rows.groupBy("post_id").agg(*sums, F.min("since").alias("since"), F.max("active").alias("active"))
    return summed.withColumn("date", F.lit(date))


def _counts_on(locks: DataFrame, initiates: DataFrame, tz: str) -> DataFrame:
    """Counts per post and date of the log, in the form of ``totals`` that begin on that date."""
    day = ms_to_day(F.col("event_time"), tz)
    kinds = zip(COUNTS, (locks, initiates), strict=True)
    marked = [df.select("post_id", "date", F.lit(kind).alias("kind"), day.alias("day")) for kind, df in kinds]
    counts = []
    for kind in COUNTS:
        own = F.col("kind") == kind
        counts.append(F.count_if(own).alias(kind))
        counts.append(F.count_if(own & (F.col("day") > F.col("date"))).alias(f"ahead_{kind}"))
        counts.append(F.count_if(own & (F.col("day") < F.col("date"))).alias(f"behind_{kind}"))
    found = marked[0].unionByName(marked[1]).groupBy("post_id", "date").agg(*counts)
    return found.select("post_id", *COUNTS, *EDGES, F.col("date").alias("since"), F.col("date").alias("active"))


def _without_edges(totals: DataFrame) -> DataFrame:
    return totals.drop("date").withColumns({e: F.lit(0).cast("bigint") for e in EDGES})


def totals_over(
    previous: DataFrame, locks: DataFrame, initiates: DataFrame, first: str, last: str, tz: str = FEED_TZ, idle: int = IDLE
) -> DataFrame:
    """``totals`` at the end of every date of a range, in one pass: what :func:`advance_totals` gives date by date.

    A post's window holds one row per date with events. Each is then repeated for the dates up to the next one,
    as long as the post stays.
    """
    rows = _without_edges(previous).unionByName(_counts_on(locks, initiates, tz))
    ordered = Window.partitionBy("post_id").orderBy("active")
    day = F.col("active").cast("date")
    anew = F.coalesce(F.date_diff(day, F.lag(day).over(ordered)) >= idle, F.lit(False)).cast("int")
    ends = F.date_sub(F.coalesce(F.lead(day).over(ordered), F.lit(shift_day(last, 1)).cast("date")), 1)
    stays = F.least(ends, F.date_add(day, idle - 1))
    stretches = rows.withColumn("_anew", anew).withColumn("_ends", stays).withColumn("_part", F.sum("_anew").over(ordered))
    running = Window.partitionBy("post_id", "_part").orderBy("active").rowsBetween(Window.unboundedPreceding, 0)
    summed = stretches.withColumns(
        {**{c: F.sum(c).over(running) for c in COUNTS}, "since": F.min("since").over(running)}
    ).withColumn("_begins", F.greatest(day, F.lit(first).cast("date")))
    dates = F.explode(F.sequence("_begins", "_ends").cast("array<string>")).alias("date")
    repeated = summed.filter(F.col("_begins") <= F.col("_ends")).select(*summed.columns, dates)
    on_the_date = lambda c: F.when(F.col("date") == F.col("active"), F.col(c)).otherwise(0).alias(c)
    return repeated.select("post_id", *COUNTS, *[on_the_date(e) for e in EDGES], "since", "active", "date")


def prior_counts(totals: DataFrame, ref: str, tz: str = FEED_TZ) -> DataFrame:
    """Per post: ``_views``, the locks of both windows of a reference date, ``_locks`` and ``_initiates`` of the prior one.

    Reads the totals of three dates, and of two more in a zone behind UTC.
    """
    first, last = shift_day(ref, -15), shift_day(ref, -8)  # the dates before the prior window, and its last one
    dates = [first, last, ref]
    behind = datetime.fromisoformat(ref).replace(tzinfo=ZoneInfo(tz)).utcoffset().total_seconds() < 0
    if behind:
        dates += [shift_day(first, 1), shift_day(last, 1)]
    at = lambda date, c: F.max(F.when(F.col("date") == date, F.col(c)))
    picked = [at(d, c).alias(f"{c}_{k}") for k, d in enumerate(dates) for c in (*COUNTS, "since")]
    picked += [at(last, f"ahead_{c}").alias(f"ahead_{c}") for c in COUNTS]
    picked += [at(d, f"behind_{c}").alias(f"behind_{c}_{k}") for k, d in enumerate(dates[3:]) for c in COUNTS]
    rows = totals.filter(F.col("date").isin(dates)).groupBy("post_id").agg(*picked)

    def between(count: str, end: int) -> Column:
        """Events after the first date and up to another; a post that left in between had none before it began anew."""
        started = F.when(F.col(f"since_{end}") <= first, default(F.col(f"{count}_0"), 0)).otherwise(0)
        return F.when(F.col(f"{count}_{end}").isNull(), 0).otherwise(F.col(f"{count}_{end}") - started)

    def prior(count: str) -> Column:
        value = between(count, 1) - default(F.col(f"ahead_{count}"), 0)
        if behind:
            value = value + default(F.col(f"behind_{count}_1"), 0) - default(F.col(f"behind_{count}_0"), 0)
        return value

    return rows.select(
        "post_id",
        between("locks", 2).alias("_views"),
        prior("locks").alias("_locks"),
        prior("initiates").alias("_initiates"),
    )
