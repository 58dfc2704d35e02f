"""Counters at rest: parts of additive tables, and a log whose entries name the parts that count.

A batch writes a new part: its counters by post and by user, the event ids or the files it took them from, and the events
it put off because they lie at or after its run. Nothing of that counts until one small file is added to the log, in one
step that fails if another writer took that place. The entry names the batch, the run up to which events are counted, and
all parts that count from then on. So a batch counts whole or not at all, a replayed batch is known by its number, two runs at a
time cannot both count, and what a crashed run left is never read.

Parts are merged in tiers: FAN[0] batches to a part of an hour, FAN[1] of these to a part of a day, each key summed; a part none
of whose dates is still wanted leaves the log with the next entry. The log names fewer than
``sum(FAN) + days of the window + 2`` parts, however many batches there were, and a row is written three times in all.

The last KEEP entries stay, for readers that began with one; parts that none of these names are removed.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import files, schemas
from tidemark.operators.partials import POST_KEYS, POST_SUMS, USER_KEYS, USER_SUMS

#: Parts of a tier that are merged into one of the next: four quarter-hour batches, twenty-four hours.
FAN = (4, 24)
KEEP = 16

_BY_POST = (
    "date string, post_id string, user_id string, engaged bigint, locks bigint, initiates bigint, shares bigint, "
    "reactions bigint, comments bigint, media_clicks bigint, read_mode bigint, dur_sum double, dur_n bigint"
)
_BY_USER = "date string, user_id string, day0_calls bigint, trials bigint"


@dataclass(frozen=True)
class Table:
    """A table of parts, laid out by date. ``sums`` add up by ``keys`` where parts are merged."""

    schema: str
    keys: list[str]
    sums: list[str] = field(default_factory=list)


TABLES = {
    "by_post": Table(_BY_POST, POST_KEYS, POST_SUMS),
    "by_user": Table(_BY_USER, USER_KEYS, USER_SUMS),
    "ids": Table("date string, event_id string", ["date", "event_id"]),
    "files": Table("date string, path string, uri string", ["date", "path", "uri"]),
}
#: Events put off; those of the last batch alone count.
LATER = "later"


@dataclass(frozen=True)
class Part:
    name: str
    tier: int
    batches: int
    dates: dict[str, list[str]]  # by table, those with rows

    def reaches(self, oldest: str) -> bool:
        return any(d >= oldest for dates in self.dates.values() for d in dates)


@dataclass(frozen=True)
class Entry:
    """One state of the log: the last batch that counts, the run it counted up to, and all parts."""

    number: int
    batch: int
    until: int
    parts: tuple[Part, ...]
    later: Part | None = None

    def text(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def of(text: str) -> Entry:
        raw = json.loads(text)
        later = raw.pop("later")
        parts = tuple(Part(**p) for p in raw.pop("parts"))
        return Entry(**raw, parts=parts, later=None if later is None else Part(**later))


class Counters:
    """The counters in a folder that all executors share."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")

    # the log

    def _numbers(self) -> list[int]:
        found = files.names(self.spark, f"{self.base}/log")
        return sorted(int(n.removesuffix(".json")) for n in found if n.endswith(".json"))

    def _path(self, number: int) -> str:
        return f"{self.base}/log/{number:012d}.json"

    def entry(self, number: int) -> Entry:
        return Entry.of(files.read_text(self.spark, self._path(number)))

    def head(self) -> Entry | None:
        """The last entry; None before the first."""
        numbers = self._numbers()
        return self.entry(numbers[-1]) if numbers else None

    def _add(self, entry: Entry) -> Entry:
        files.write_new(self.spark, self._path(entry.number), entry.text())
        return entry

    # parts

    def new_part(self) -> str:
        return uuid.uuid4().hex

    def _folder(self, table: str, part: str) -> str:
        return f"{self.base}/{table}/part={part}"

    def write(self, table: str, part: str, rows: DataFrame) -> list[str]:
        """Writes a table of a part by date. Returns the dates with rows."""
        folder = self._folder(table, part)
        rows.hint("rebalance", F.col("date")).write.mode("overwrite").partitionBy("date").parquet(folder)
        found = [n.removeprefix("date=") for n in files.names(self.spark, folder) if n.startswith("date=")]
        return [d for d in found if not d.startswith("__")]  # rows without a date are in no window

    def _read(self, table: str, schema, parts: Iterable[Part], start: str | None, end: str | None) -> DataFrame:
        wanted = lambda d: (start is None or d >= start) and (end is None or d <= end)
        paths = [f"{self._folder(table, p.name)}/date={d}" for p in parts for d in p.dates.get(table, ()) if wanted(d)]
        if not paths:
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).option("basePath", f"{self.base}/{table}").parquet(*paths)
        return rows.select(*self.spark.createDataFrame([], schema).columns)

    def read(self, table: str, entry: Entry | None, start: str | None = None, end: str | None = None) -> DataFrame:
        """Rows of a table in all parts that an entry names, of a range of dates. Only their folders are opened."""
        return self._read(table, TABLES[table].schema, entry.parts if entry else (), start, end)

    def put_off(self, entry: Entry | None) -> DataFrame:
        """Events that the last batch put off."""
        return self._read(LATER, schemas.EVENT_LOG, [entry.later] if entry and entry.later else (), None, None)

    def read_part(self, table: str, part: Part) -> DataFrame:
        return self._read(table, TABLES[table].schema, [part], None, None)

    # changes

    def commit(
        self,
        head: Entry | None,
        batch: int,
        until: int,
        part: Part,
        oldest: str,
        later: Part | None = None,
        anew: bool = False,
    ) -> Entry:
        """Adds a written part to those that count, or lets it alone count (``anew``).

        Parts without dates from ``oldest`` on no longer count. FileExistsError if another run added an entry after ``head``.
        """
        kept = () if anew or head is None else tuple(p for p in head.parts if p.reaches(oldest))
        return self._add(Entry((head.number if head else 0) + 1, batch, until, (*kept, part), later))

    def compact(self, head: Entry, oldest: str) -> Entry:
        """Merges the oldest parts of a tier that has too many, and removes what no kept entry names."""
        for tier, fan in enumerate(FAN):
            own = [p for p in head.parts if p.tier == tier]
            if len(own) >= fan:
                head = self._merge(head, own[:fan], tier + 1, oldest)
        self._sweep(head.number)
        return head

    def _merge(self, head: Entry, parts: list[Part], tier: int, oldest: str) -> Entry:
        name, dates = self.new_part(), {}
        for table, kind in TABLES.items():
            if any(p.dates.get(table) for p in parts):
                rows = self._read(table, kind.schema, parts, oldest, None)
                sums = [F.sum(c).alias(c) for c in kind.sums]
                rows = rows.groupBy(*kind.keys).agg(*sums) if sums else rows.distinct()
                dates[table] = self.write(table, name, rows)
        merged = Part(name, tier, sum(p.batches for p in parts), dates)
        gone = {p.name for p in parts}
        rest = tuple(p for p in head.parts if p.name not in gone)
        return self._add(replace(head, number=head.number + 1, parts=(*rest, merged)))

    def _sweep(self, last: int) -> None:
        """Removes entries before the last KEEP ones and the parts that only these named."""
        old = [n for n in self._numbers() if n <= last - KEEP]
        if not old:
            return
        live = {name for n in self._numbers() if n > last - KEEP for name in _named(self.entry(n))}
        for number in old:
            for name, part in _named(self.entry(number)).items():
                if name not in live:
                    for table in part.dates:
                        files.delete(self.spark, self._folder(table, name))
            files.delete(self.spark, self._path(number))

    def drop_orphans(self, before_ms: int) -> int:
        """Removes part folders that no entry names and that were last written to before a time: what crashed runs left.
        Returns how many."""
        live = {name for n in self._numbers() for name in _named(self.entry(n))}
        gone = 0
        for table in (*TABLES, LATER):
            for folder, written in files.written(self.spark, f"{self.base}/{table}").items():
                if folder.removeprefix("part=") not in live and written < before_ms:
                    files.delete(self.spark, f"{self.base}/{table}/{folder}")
                    gone += 1
        return gone


def _named(entry: Entry) -> dict[str, Part]:
    """Parts an entry names."""
    return {p.name: p for p in (*entry.parts, *([entry.later] if entry.later else []))}
