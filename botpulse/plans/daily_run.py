"""The ordered daily run: every table for a range of days, producers first.

Levels (a level starts when the previous one is written; tables within a
level are independent and run concurrently):

0. ``aigc_tag`` — Luna tags (D2); ``aigc_tag_seed`` — the seed CSV (D1), a table of its own so that
   neither load replaces the other's days; the per (day, user, bot) summaries of chats, bot views
   and card shows — the only reads of the event tables except M1's distinct event ids
1. ``aigc_tag_v5`` — V5 enrichment (D3), kept up to date with all stored days of both (:mod:`botpulse.plans.dimension`)
2. everything that needs only the dimension: D4, M1–M3, W4, C3, C4, A3
3. everything that reads a table of level 2: T4 (M1–M3, D4), C1/A1 (M1),
   C2/A2 (M2), C5 (C4)

Consumers read the *written* producer tables, as the original jobs read the
warehouse: each write cuts the lineage, so a lost executor only recomputes
work since the last written table. Every day of the range is replaced, also one that has
become empty (or rows are appended on request).

Failures. A table that fails for the range is tried by halves of the range, and again by halves of what fails, so k bad
days of n cost about ``2 k log2 n`` jobs and only those days; the long tables W4 and T4 are first tried metric by metric. What failed is
recorded and the run goes on.
Without a dimension its consumers are skipped and recorded as such: they are never computed from a
smaller one. Other producers that failed (summaries, M1–M3, C4) are replaced by the same computation from
the sources, with the same result.
"""

from __future__ import annotations

import datetime as dt
import logging
import time
import traceback
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from botpulse.functions.constants import METRIC_TYPES
from botpulse.functions.dates import DayRange
from botpulse.operators import compare, rollups, summaries, tags
from botpulse.operators import prompt_metrics as pm
from botpulse.plans.dimension import refresh_dimension
from botpulse.sources import published
from botpulse.sources.catalog import Tables
from botpulse.sources.seed import seed_tags
from botpulse.sources.sinks import read_table, table_exists, write_table

log = logging.getLogger(__name__)

UNDATED = {"tags_exploded"}
# Run-internal inputs of the reports: always replaced per day, also in append mode
# (appending them would double every count derived from them).
INTERMEDIATE = {"chat_user_bot_daily", "view_user_bot_daily", "show_user_bot_daily"}
# Tables that only mean something with the whole dimension, and the dimension with its tags.
NEEDS = {"aigc_tag_v5": ("aigc_tag", "aigc_tag_seed")}
DIMENSION = "aigc_tag_v5"


@dataclass(frozen=True)
class TableStatus:
    ok: bool
    rows: int | None = None
    seconds: float = 0.0
    error: str | None = None
    failures: dict[str, str] = field(default_factory=dict)  # day or "day metric" → error


class Skipped(Exception):
    """A table whose producer failed."""


def run_reports(
    t: Tables,
    days: DayRange | None,
    out: str,
    mode: str = "overwrite",
    seed_csv: str | None = None,
    seed_date: dt.date | str | None = None,
    parallelism: int = 4,
    jobs: set[str] | None = None,
    run_id: str | None = None,
) -> dict[str, TableStatus]:
    """Compute and write every table (or those of ``jobs``) for ``days`` (default: yesterday) under ``out``.

    Tables run in dependency levels; the tables of one level are submitted
    concurrently from ``parallelism`` driver threads (Spark schedules their jobs
    side by side), a level starts when the previous one is written. Returns a
    status per table: rows written (from an ``Observation`` on the write),
    duration, or the error. ``seed_csv`` is loaded as the seed list (D1) of ``seed_date``
    (default: the last day). With ``jobs``, a dimension stored by an earlier run under ``out`` (or in ``t``) is used;
    without one it is derived from all days up to the range's end.

    Every table is published by a switch (``sinks.read_table`` reads it); versions that are out of use for a day are removed.
    With a ``run_id``, ``mode="append"`` takes each piece of the run in once: the same id again adds only what is missing.
    """
    days = days or DayRange.yesterday()
    spark = t.spark
    unknown = set(jobs or ()) - set(_ORDER)
    if unknown:
        raise ValueError(f"no such job: {sorted(unknown)}; expected some of {_ORDER}")
    path = {name: f"{out.rstrip('/')}/{name}" for name in _ORDER}
    status: dict[str, TableStatus] = {}
    schema_of: dict[str, object] = {}

    def stored(name: str) -> DataFrame | None:
        """The table written by this run, or None when its step failed or wasn't asked for."""
        if not status.get(name, TableStatus(False)).ok:
            return None
        return read_table(spark, name, path[name], schema_of.get(name))

    def write(name: str, frame: DataFrame, when: DayRange, how: str, piece: str | None = None) -> int:
        if name in INTERMEDIATE:
            schema_of[name] = frame.schema  # ids in their delivered types
        return write_table(frame, path[name], mode=how, partitioned=name not in UNDATED, days=when, run_id=piece)

    def attempt(name: str, build: Callable[..., DataFrame | int], how: str) -> TableStatus:
        t0 = time.perf_counter()
        failures: dict[str, str] = {}
        once = run_id is not None and how == "append"
        taken = set(published.current(spark, path[name]).runs) if once else set()

        def done(ok: bool, rows: int | None, error: str | None = None):
            return TableStatus(ok, rows, round(time.perf_counter() - t0, 3), error, failures)

        def piece(when: DayRange, metric: str | None) -> str | None:
            return f"{run_id}:{when.start}:{when.end}:{metric or ''}" if once else None

        def partly(when: DayRange, metric: str | None) -> bool:
            """Whether an earlier try of this run took in a part of it."""
            for other in taken - {piece(when, metric)}:
                if other.startswith(f"{run_id}:"):
                    start, end, what = other[len(run_id) + 1:].split(":")
                    if start >= str(when.start) and end <= str(when.end) and (metric is None or what == metric):
                        return True
            return False

        def tried(when: DayRange, metric: str | None, how: str) -> int:
            if piece(when, metric) not in taken and partly(when, metric):
                raise RuntimeError("a part of it was written before")
            made = build(when) if metric is None else build(when, metric)
            return made if isinstance(made, int) else write(name, made, when, how, piece(when, metric))

        def by_metric(when: DayRange, how: str) -> tuple[int, list[tuple[str, Exception]]]:
            rows, bad = 0, []
            for metric in METRIC_TYPES:
                try:
                    rows += tried(when, metric, how)
                    how = "append"  # the first one replaced the days
                except Exception as exc:
                    bad.append((metric, exc))
            return rows, bad

        def halved(when: DayRange, metric: str | None, how: str, error: Exception) -> int:
            """The rows written of a range that failed as a whole."""
            if when.n_days == 1:
                if metric is None and name in _LONG:
                    rows, bad = by_metric(when, how)
                    failures.update({f"{when.start} {m}": f"{type(e).__name__}: {e}" for m, e in bad})
                    return rows
                failures[f"{when.start} {metric}" if metric else str(when.start)] = f"{type(error).__name__}: {error}"
                return 0
            rows = 0
            for half in when.halves():
                try:
                    rows += tried(half, metric, how)
                except Exception as exc:
                    rows += halved(half, metric, how, exc)
            return rows

        try:
            for producer in NEEDS.get(name, (DIMENSION,) if name in _FROM_DIMENSION else ()):
                if producer in status and not status[producer].ok:
                    raise Skipped(f"skipped: {producer} failed")
            return done(True, tried(days, None, how))
        except Skipped as exc:
            return done(False, None, str(exc))
        except Exception as exc:  # isolate: by days, and by metric for the long tables
            log.error("table %s failed: %s", name, traceback.format_exc())
            first = exc
        whole = f"{type(first).__name__}: {first}"
        if name in UNDATED or name == DIMENSION or (days.n_days == 1 and name not in _LONG):
            return done(False, None, whole)
        rows, bad = by_metric(days, how) if name in _LONG else (0, [])
        if name in _LONG and len(bad) < len(METRIC_TYPES):
            rows += sum(halved(days, metric, "append", exc) for metric, exc in bad)
        else:
            rows += halved(days, None, how, first)
        return done(not failures, rows, whole if failures else None)

    def step(name: str, build: Callable[..., DataFrame]) -> None:
        if jobs is not None and name not in jobs:
            return
        status[name] = attempt(name, build, "overwrite" if name in INTERMEDIATE else mode)
        log.info("%s: %s", name, status[name])

    def level(steps: list[tuple[str, Callable[..., DataFrame]]]) -> None:
        if parallelism <= 1 or len(steps) == 1:
            for name, build in steps:
                step(name, build)
            return
        with ThreadPoolExecutor(max_workers=parallelism, thread_name_prefix="botpulse") as pool:
            list(pool.map(lambda s: step(*s), steps))

    def aigc_tag_v5(_: DayRange) -> int:
        rows = refresh_dimension(t, path, days, mode, run_id)
        if rows is None:
            raise Skipped("skipped: no tag table")
        return rows

    level([
        ("aigc_tag", lambda d: tags.luna_tags(t, d)),
        ("chat_user_bot_daily", lambda d: summaries.chat_summary(t, d)),
        ("view_user_bot_daily", lambda d: summaries.view_summary(t, d)),
        ("show_user_bot_daily", lambda d: summaries.show_summary(t, d)),
    ])
    if seed_csv is not None and (jobs is None or "aigc_tag_seed" in jobs):
        stamp = DayRange.of(seed_date or days.end)
        try:
            rows = write_table(seed_tags(spark, seed_csv, stamp.start), path["aigc_tag_seed"], mode=mode, days=stamp, run_id=run_id)
            status["aigc_tag_seed"] = TableStatus(True, rows)
        except Exception as exc:
            status["aigc_tag_seed"] = TableStatus(False, error=f"{type(exc).__name__}: {exc}")
    t = t.with_(chat_summary=stored("chat_user_bot_daily"), view_summary=stored("view_user_bot_daily"),
                show_summary=stored("show_user_bot_daily"))
    level([(DIMENSION, aigc_tag_v5)])
    written = stored(DIMENSION)
    if written is None and jobs is not None and DIMENSION not in jobs and table_exists(spark, path[DIMENSION]):
        written = read_table(spark, DIMENSION, path[DIMENSION])
    dim = t.with_(aigc_tag_v5=written) if written is not None else t
    level([
        ("tags_exploded", lambda d: tags.tags_exploded(dim.with_(tags_exploded=None), d)),
        ("click_rate_daily", lambda d: pm.click_rate_daily(dim, d)),
        ("chat_start_daily", lambda d: pm.chat_start_daily(dim, d)),
        ("chat_rounds_daily", lambda d: pm.chat_rounds_daily(dim, d)),
        ("metrics_by_workflow", lambda d, m=METRIC_TYPES: rollups.metrics_by_workflow(dim, d, m)),
        ("chat_depth_compare", lambda d: compare.chat_depth_compare(dim, d)),
        ("bot_tags_daily", lambda d: tags.bot_tags_daily(dim, d)),
        ("chat_depth_total_compare", lambda d: compare.chat_depth_total_compare(dim, d)),
    ])
    dim = dim.with_(tags_exploded=stored("tags_exploded"))
    m1, m2, m3 = stored("click_rate_daily"), stored("chat_start_daily"), stored("chat_rounds_daily")
    level([
        ("metrics_by_tag", lambda d, m=METRIC_TYPES: rollups.metrics_by_tag(
            dim, d, m, click_rate=m1, chat_start=m2, chat_rounds=m3)),
        ("chat_start_compare", lambda d: compare.chat_start_compare(dim, d, m2)),
        ("click_compare", lambda d: compare.click_compare(dim, d, m1)),
        ("chat_depth_by_tag", lambda d: compare.chat_depth_by_tag(dim, d, stored("bot_tags_daily"))),
        ("click_total_compare", lambda d: compare.click_total_compare(dim, d, m1)),
        ("chat_start_total_compare", lambda d: compare.chat_start_total_compare(dim, d, m2)),
    ])
    for name in [*status, "aigc_tag_v5_pairs"]:
        published.vacuum(spark, f"{out.rstrip('/')}/{name}")
    return {name: status[name] for name in _ORDER if name in status}


_ORDER = [
    "chat_user_bot_daily", "view_user_bot_daily", "show_user_bot_daily",
    "aigc_tag", "aigc_tag_seed", "aigc_tag_v5", "tags_exploded",
    "click_rate_daily", "chat_start_daily", "chat_rounds_daily",
    "metrics_by_workflow", "metrics_by_tag",
    "chat_depth_compare", "chat_start_compare", "click_compare",
    "bot_tags_daily", "chat_depth_by_tag",
    "click_total_compare", "chat_start_total_compare", "chat_depth_total_compare",
]

_FROM_DIMENSION = set(_ORDER[_ORDER.index("tags_exploded"):]) - {"bot_tags_daily"}
_LONG = {"metrics_by_workflow", "metrics_by_tag"}


def main(argv: list[str] | None = None) -> int:
    """``spark-submit run_daily.py --inputs BASE --out OUT [--start D] [--end D]``
    (or ``python -m botpulse.plans.daily_run ...``).

    Reads every input from ``BASE/<input>`` (Parquet) or, with ``--catalog``, from the tables of a metastore
    database; runs all tables, or those named with ``--job``, for the range (default: yesterday) and exits
    non-zero if any table failed. Failed days and metrics are printed below their table.
    """
    import argparse

    from pyspark.sql import SparkSession

    from botpulse.session import configure
    from botpulse.sources import schemas

    parser = argparse.ArgumentParser(description="Write KPI tables for a range of days.")
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--inputs", help="folder holding one Parquet folder per input table")
    source.add_argument("--catalog", help="metastore database holding the input tables")
    parser.add_argument("--out", required=True, help="folder for the output tables")
    parser.add_argument("--start", help="first day, YYYY-MM-DD (default: yesterday)")
    parser.add_argument("--end", help="last day, YYYY-MM-DD (default: --start)")
    parser.add_argument("--job", action="append", choices=_ORDER, help="run this table only (may be repeated)")
    parser.add_argument("--dimension", help="stored aigc_tag_v5 table to use instead of deriving one")
    parser.add_argument("--mode", choices=["overwrite", "append"], default="overwrite")
    parser.add_argument("--seed-csv", help="bot → workflow seed CSV (id,workflow)")
    parser.add_argument("--seed-date", help="day of the seed rows (default: the last day)")
    parser.add_argument("--chunk-gb", type=float, help="run in chunks of days of so much event data, resumed after a crash")
    parser.add_argument("--run-id", help="with --mode append: rows of a run id are taken in once")
    parser.add_argument("--parallelism", type=int, default=4)
    args = parser.parse_args(argv)

    days = DayRange.of(args.start, args.end) if args.start else DayRange.yesterday()
    spark = configure(SparkSession.builder.appName("botpulse-daily").getOrCreate())
    if args.inputs:
        tables = Tables.from_parquet(spark, args.inputs)
    else:
        tables = Tables.from_catalog(spark, **{name: f"{args.catalog}.{name}" for name in schemas.INPUTS})
    if args.dimension:
        tables = tables.with_(aigc_tag_v5=read_table(spark, DIMENSION, args.dimension))
    if args.chunk_gb:
        from botpulse.plans.backfill import run_backfill

        if args.mode != "overwrite" or args.job or args.dimension:
            parser.error("--chunk-gb replaces whole days of all tables")
        parts = run_backfill(tables, days, args.out, int(args.chunk_gb * (1 << 30)), args.seed_csv, args.seed_date, args.parallelism)
        status = {f"{key} {name}": s for key, part in parts.items() for name, s in part.items()}
        return _printed(status)
    status = run_reports(tables, days, args.out, mode=args.mode, seed_csv=args.seed_csv, seed_date=args.seed_date,
                         parallelism=args.parallelism, jobs=set(args.job) if args.job else None, run_id=args.run_id)
    return _printed(status)


def _printed(status: dict[str, TableStatus]) -> int:
    for name, s in status.items():
        print(f"{name}\t{'ok' if s.ok else 'FAILED'}\t{s.rows if s.ok else s.error}\t{s.seconds}s")
        for what, error in s.failures.items():
            print(f"  {what}\t{error}")
    return 0 if all(s.ok for s in status.values()) else 1


if __name__ == "__main__":
    raise SystemExit(main())
