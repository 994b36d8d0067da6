"""Long backfills in chunks of days, with a ledger to go on from after a crash.

A backfill first brings the tag tables and the dimension up to date for the whole range, so that every chunk uses the
dimension that one job over the range would use. Then it runs the reports chunk by chunk. Chunks are runs of days of about
``chunk_bytes`` of event data; their limits are written down before the first one starts and kept when the
backfill is resumed, whatever has arrived since. A chunk whose tables are all written is entered in the ledger; a resumed
backfill goes on at the first chunk that isn't.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from botpulse.functions.dates import DayRange, within
from botpulse.plans.daily_run import _ORDER, TableStatus, run_reports
from botpulse.sources.catalog import Tables
from botpulse.sources.published import Store

FIRST = ("aigc_tag", "aigc_tag_seed", "aigc_tag_v5", "tags_exploded")  # undated, or read as a whole
EVENTS = ("show_prompt_card", "bot_view", "chat_send")
CHUNK_BYTES = 256 << 30


def day_bytes(events: DataFrame, days: DayRange, col: str = "event_date") -> dict[str, int]:
    """Bytes per day of an event table: of its files where they lie in a folder per day, else rows (one count per day,
    combined map-side) by the columns' default widths."""
    spark = events.sparkSession
    sizes: dict[str, int] = {}
    marker = f"{col}="
    for file in events.select(col).inputFiles():  # a name per file
        if marker not in file:
            break
        path = spark._jvm.org.apache.hadoop.fs.Path(file)
        day = file.split(marker, 1)[1].split("/", 1)[0]
        size = path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path).getLen()
        sizes[day] = sizes.get(day, 0) + int(size)
    else:
        if sizes:
            return {d.isoformat(): sizes.get(d.isoformat(), 0) for d in days.days()}
    width = sum(int(spark._jvm.org.apache.spark.sql.types.DataType.fromJson(f.dataType.json()).defaultSize())
                for f in events.schema.fields)
    counted = within(events.select(col), days, col).groupBy(col).agg(F.count(F.lit(1)).alias("n")).collect()
    rows = {r[0].isoformat(): r["n"] for r in counted}
    return {d.isoformat(): rows.get(d.isoformat(), 0) * width for d in days.days()}


def chunks(sizes: dict[str, int], chunk_bytes: int) -> list[DayRange]:
    """Consecutive days, at least one and otherwise up to ``chunk_bytes`` a chunk."""
    out: list[DayRange] = []
    filled = 0
    for day in sorted(sizes):
        if out and filled + sizes[day] <= chunk_bytes:
            out[-1], filled = DayRange(out[-1].start, day), filled + sizes[day]
        else:
            out.append(DayRange.of(day))
            filled = sizes[day]
    return out


@dataclass(frozen=True)
class Ledger:
    """Small files, each created once: the plan of a backfill, and an entry per finished chunk."""

    store: Store
    name: str

    @classmethod
    def of(cls, spark, out: str, days: DayRange) -> Ledger:
        return cls(Store(spark, out), f"_backfill/{days.start}_{days.end}")

    def _whole(self, name: str):
        """The content of a file, None without one or where its writer died in the middle."""
        try:
            return json.loads(self.store.read(f"{self.name}/{name}"))
        except Exception:
            return None

    def _put(self, name: str, content) -> None:
        if not self.store.create(f"{self.name}/{name}", json.dumps(content)) and self._whole(name) is None:
            self.store.delete(f"{self.name}/{name}")
            self.store.create(f"{self.name}/{name}", json.dumps(content))

    def plan(self, make) -> list[DayRange]:
        if self._whole("plan.json") is None:
            self._put("plan.json", [[str(c.start), str(c.end)] for c in make()])
        return [DayRange(a, b) for a, b in self._whole("plan.json")]

    def finished(self, key: str) -> bool:
        return self._whole(f"{key}.json") is not None

    def finish(self, key: str, status: dict[str, TableStatus]) -> None:
        self._put(f"{key}.json", {name: s.rows for name, s in status.items()})

    def forget(self) -> None:
        self.store.delete(self.name)


def run_backfill(t: Tables, days: DayRange, out: str, chunk_bytes: int = CHUNK_BYTES, seed_csv: str | None = None,
                 seed_date=None, parallelism: int = 4, again: bool = False) -> dict[str, dict[str, TableStatus]]:
    """Run every report for ``days`` in chunks; returns the status per chunk run now (``"dimension"`` and ``"start_end"``).

    Chunks finished by an earlier call with the same ``days`` and ``out`` are left out; ``again`` starts anew. A chunk with a
    failed table stays open, and the backfill goes on with the next. If the dimension fails, no chunk is run.
    """
    ledger = Ledger.of(t.spark, out, days)
    if again:
        ledger.forget()

    def planned() -> list[DayRange]:
        total = {d.isoformat(): 0 for d in days.days()}
        for name in EVENTS:
            for day, size in day_bytes(getattr(t, name), days).items():
                total[day] += size
        return chunks(total, chunk_bytes)

    done: dict[str, dict[str, TableStatus]] = {}

    def run(key: str, part: DayRange, jobs: set[str], **options) -> bool:
        if ledger.finished(key):
            return True
        done[key] = run_reports(t, part, out, parallelism=parallelism, jobs=jobs, **options)
        whole = all(s.ok for s in done[key].values())
        if whole:
            ledger.finish(key, done[key])
        return whole

    plan = ledger.plan(planned)
    if not run("dimension", days, set(FIRST), seed_csv=seed_csv, seed_date=seed_date):
        return done
    for part in plan:
        run(f"{part.start}_{part.end}", part, set(_ORDER) - set(FIRST))
    return done
