"""Days kept current from event files that arrive late, in any order, and more than once.

Of every event file only its summary is kept, as an addition to the day: the (day, user, bot) counts, which add up, and, for
views and shows, the (day, bot, event id)s that aren't stored yet, found by an anti-join with the stored ids of
the file's days (M1 counts distinct ids, which don't add up). Additions are taken in once per file. A day's summary is the sum of its
additions; :meth:`EventStore.compact` replaces many small additions by that sum. A refresh runs the reports from
the store for the days that additions have touched since the last one: the raw events of a day are read once, however often the
day is run again.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from botpulse.functions.dates import DayRange
from botpulse.operators import summaries
from botpulse.plans.daily_run import TableStatus, run_reports
from botpulse.sources import published, schemas
from botpulse.sources.catalog import Tables
from botpulse.sources.sinks import read_table, write_table
from botpulse.streaming.refresh import contiguous_ranges

ALL_DAYS = DayRange(dt.date(1000, 1, 1), dt.date(9999, 12, 31))
SUMMARIES = {  # event table → its summary, the summing function, the bot's column
    "chat_send": ("chat_user_bot_daily", summaries.summarize_chats, "prompt_id"),
    "bot_view": ("view_user_bot_daily", summaries.summarize_views, "bot_id"),
    "show_prompt_card": ("show_user_bot_daily", summaries.summarize_shows, "prompt_id"),
}
WITH_IDS = ("bot_view", "show_prompt_card")


@dataclass(frozen=True)
class EventStore:
    spark: SparkSession
    path: str

    def _at(self, name: str) -> str:
        return f"{self.path.rstrip('/')}/{name}"

    def _summary(self, table: str, days: set[str] | None = None) -> DataFrame:
        name = SUMMARIES[table][0]
        return self._read(name, schemas.OUTPUTS[name], days)

    def _ids(self, table: str, days: set[str] | None = None) -> DataFrame:
        return self._read(f"{table}_ids", schemas.INPUTS[table], days).drop("user_id")

    def _read(self, name: str, schema, days: set[str] | None) -> DataFrame:
        if not published.current(self.spark, self._at(name)).number:
            return self.spark.createDataFrame([], schema)
        return read_table(self.spark, name, self._at(name), schema, days)

    def ingest(self, table: str, files: dict[str, DataFrame]) -> int:
        """Take in the events of ``files`` (file name → its events of ``table``); returns the rows added to the summary.

        A file that was taken in before is left out, so a replay changes nothing; one job for all others.
        """
        _, summarize, bot = SUMMARIES[table]
        name = SUMMARIES[table][0]
        new = self._new(name, files)
        rows = 0
        if new:
            rows = write_table(summarize(_stacked(new), ALL_DAYS), self._at(name), mode="append", run_id=sorted(new), mark=True)
        if table in WITH_IDS:
            new = self._new(f"{table}_ids", files)
            if new:
                events = _stacked(new)
                days = {r[0].isoformat() for r in events.select("event_date").distinct().collect() if r[0]}  # an entry a day
                keys = ["event_date", "event_id", bot]
                fresh = events.where("event_id IS NOT NULL").select(*keys).distinct()
                known = self._ids(table, days).withColumnRenamed(bot, "b_").withColumnsRenamed({"event_date": "d_", "event_id": "e_"})
                fresh = fresh.join(known, (F.col("event_date") == F.col("d_")) & (F.col("event_id") == F.col("e_"))
                                   & F.col(bot).eqNullSafe(F.col("b_")), "left_anti")
                fresh = fresh.withColumn("user_id", F.lit(None).cast("long"))
                write_table(fresh, self._at(f"{table}_ids"), mode="append", run_id=sorted(new), mark=True)
        return rows

    def _new(self, name: str, files: dict[str, DataFrame]) -> dict[str, DataFrame]:
        taken = published.current(self.spark, self._at(name)).runs
        return {file: events for file, events in files.items() if file not in taken}

    def merged(self, table: str, days: set[str] | None = None) -> DataFrame:
        """The summary of an event table: the sums of its additions."""
        stored = self._summary(table, days)
        counts = [c for c in stored.columns if c not in summaries.KEYS]
        return stored.groupBy(*summaries.KEYS).agg(*[F.sum(c).alias(c) for c in counts])

    def compact(self, table: str, from_versions: int = 8) -> list[str]:
        """Replace the additions of days with ``from_versions`` of them by their sum; returns these days.

        If another addition comes between, ``Superseded`` is raised and nothing changes.
        """
        name = SUMMARIES[table][0]
        now = published.current(self.spark, self._at(name))
        many = {d: v for d, v in now.parts.items() if len(v) >= from_versions}
        if many:
            write_table(self.merged(table, set(many)), self._at(name), days=set(many),
                        guard=lambda later: all(later.parts.get(d) == v for d, v in many.items()))
        return sorted(many)

    def tables(self, t: Tables) -> Tables:
        """``t`` with everything that depends on events taken from the store."""
        return t.with_(chat_summary=self.merged("chat_send"), view_summary=self.merged("bot_view"),
                       show_summary=self.merged("show_prompt_card"),
                       **{table: self._ids(table).withColumn("user_id", F.lit(None).cast("long")) for table in WITH_IDS})

    def _marks(self) -> dict[str, str]:
        """Day → its last additions."""
        marks: dict[str, list[str]] = {}
        for name in (*(s[0] for s in SUMMARIES.values()), *(f"{table}_ids" for table in WITH_IDS)):
            for day, version in published.current(self.spark, self._at(name)).notes.items():
                marks.setdefault(day, []).append(version)
        return {day: " ".join(versions) for day, versions in marks.items()}

    def refresh(self, t: Tables, out: str, **options) -> dict[DayRange, dict[str, TableStatus]]:
        """Run the reports of the days touched since the last refresh into ``out``; days with a failed table stay due."""
        marks = self._marks()
        known = published.current(self.spark, self._at("refreshed")).notes
        due = [dt.date.fromisoformat(d) for d, mark in marks.items() if known.get(d) != mark]
        found = {}
        for days in contiguous_ranges(due):
            found[days] = run_reports(self.tables(t), days, out, **options)
            if all(s.ok for s in found[days].values()):
                seen = {d.isoformat(): marks[d.isoformat()] for d in days.days()}
                published.publish(self.spark, self._at("refreshed"), lambda now, seen=seen: replace(now, notes=now.notes | seen))
        return found


def _stacked(files: dict[str, DataFrame]) -> DataFrame:
    frames = [files[name] for name in sorted(files)]
    stacked = frames[0]
    for frame in frames[1:]:
        stacked = stacked.unionByName(frame)
    return stacked
