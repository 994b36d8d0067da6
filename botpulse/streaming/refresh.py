"""Data-driven refresh of the daily reports with Structured Streaming.

The original runs every report once a day for "yesterday" from a scheduler.
Here a file stream over an event landing folder tells which days received
new data; each micro-batch reruns :func:`run_reports` for exactly those days.
Day tables are overwritten per ``event_date`` partition, so a replayed batch
(foreachBatch is at-least-once) rewrites the same rows: the output is
effectively exactly-once. ``trigger(availableNow=True)`` gives a catch-up run
that stops when the folder is drained; ``processingTime`` keeps refreshing
(e.g. hourly) as files land.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from botpulse.functions.dates import DayRange
from botpulse.plans.daily_run import run_reports
from botpulse.sources.catalog import Tables


def contiguous_ranges(days: list[dt.date]) -> list[DayRange]:
    """Group days into maximal runs of consecutive days."""
    out: list[DayRange] = []
    for d in sorted(set(days)):
        if out and d == out[-1].end + dt.timedelta(days=1):
            out[-1] = DayRange(out[-1].start, d)
        else:
            out.append(DayRange(d, d))
    return out


def touched_days(batch: DataFrame, col: str = "event_date") -> list[DayRange]:
    """Day ranges present in a micro-batch (a distinct over days: a handful of rows)."""
    days = [r[0] for r in batch.select(col).where(F.col(col).isNotNull()).distinct().collect()]
    return contiguous_ranges(days)


def start_refresh(
    day_stream: DataFrame,
    tables: Callable[[], Tables],
    out: str,
    checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Rerun every report for the days seen in ``day_stream`` (a streaming frame
    with an ``event_date`` column). ``tables()`` builds the batch inputs per
    micro-batch, so newly landed files are included. A failing table fails the
    batch, which the query then replays from ``checkpoint``, a folder to keep across restarts.
    Days are always replaced, never appended: a replayed batch would append its rows twice.
    """

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        for days in touched_days(batch):
            status = run_reports(tables(), days, out)
            failed = {k: s.error for k, s in status.items() if not s.ok}
            if failed:
                raise RuntimeError(f"batch {batch_id}, days {days}: failed tables {failed}")

    writer = (
        day_stream.select("event_date")
        .writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
    )
    return writer.start()
