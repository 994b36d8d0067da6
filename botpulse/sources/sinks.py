"""Sinks: replacement of days or whole tables, or append, each published by one switch."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import replace

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from botpulse.functions.dates import DayRange
from botpulse.sources import published, schemas

PARTITION_COL = "event_date"


def table_exists(spark, path: str) -> bool:
    return published.Store(spark, path).exists()


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partitioned: bool = True,
                days: DayRange | Iterable[str] | None = None, run_id: str | list[str] | None = None,
                notes: dict[str, str | None] | None = None, mark: bool = False,
                guard: Callable[[published.Publication], bool] | None = None) -> int:
    """Write ``df`` to ``path`` and return the number of rows written.

    The rows go to a new version beside the old ones and are published last (:mod:`botpulse.sources.published`): until then,
    and after a crash at any point, readers see the whole old table.
    ``mode="overwrite"`` on a day-partitioned table replaces every day of ``days``, also those for which ``df`` has no
    rows, so a rerun leaves no stale day; without ``days`` only the days in ``df``. ``mode="append"`` adds rows.
    A table without a day column is replaced or added to as a whole. With a ``run_id`` rows are taken
    in once: a repeated run id (or list of ids, taken in together) writes nothing and returns the rows of the first time.
    ``notes`` are kept with the publication (None removes one); ``mark`` notes the version of each day found. Where ``guard``
    doesn't hold for the table as it is when the rows are published, ``Superseded`` is raised and nothing changes.

    The row count and the days come from an ``Observation`` on the write itself, not from a second pass.
    Day-partitioned writes go through a ``rebalance`` on ``event_date``: AQE then sizes the write tasks (small days
    coalesced into few files, a large day split into several), instead of every task writing a file for every day it holds.
    """
    if mode not in ("overwrite", "append"):
        raise ValueError(f"unsupported write mode {mode!r}")
    spark = df.sparkSession
    before = published.current(spark, path)
    ids = [run_id] if isinstance(run_id, str) else list(run_id or [])

    def taken(now: published.Publication) -> bool:
        known = [i in now.runs for i in ids]
        if any(known) and not all(known):
            raise Superseded(f"some of the run ids are in {path} already")
        return any(known)

    if taken(before):
        return sum(before.runs[i] for i in ids)
    if not before.number and _holds_plain_files(spark, path):
        raise ValueError(f"{path} holds plain Parquet files: read it and write it to a new folder")
    obs = Observation()
    seen = [F.count(F.lit(1)).alias("rows")]
    if partitioned:
        seen.append(F.collect_set(F.col(PARTITION_COL).cast("string")).alias("days"))  # one entry a day
    observed = df.observe(obs, *seen)
    version = published.new_version()
    target = published.version_path(path, version)
    if partitioned:
        observed.hint("rebalance", PARTITION_COL).write.partitionBy(PARTITION_COL).parquet(target)
    else:
        observed.write.parquet(target)
    got = obs.get
    rows = int(got.get("rows", 0))
    found = set(got.get("days") or []) if partitioned else {""}
    if days is None:
        replaced = found
    else:
        replaced = {d.isoformat() for d in days.days()} if isinstance(days, DayRange) else set(days)

    def change(now: published.Publication) -> published.Publication | None:
        if taken(now):
            return None
        if guard is not None and not guard(now):
            raise Superseded(f"{path} has changed meanwhile")
        new = now.adding(version, found) if mode == "append" else now.replacing(replaced | found, version, found)
        marks = {d: version for d in found} if mark else {}
        noted = {k: v for k, v in {**now.notes, **(notes or {}), **marks}.items() if v is not None}
        return replace(new, notes=noted, runs=now.runs | {i: 0 for i in ids[1:]} | {i: rows for i in ids[:1]})

    now = published.publish(spark, path, change)
    return sum(now.runs[i] for i in ids) if ids else rows


class Superseded(Exception):
    """What a write was made for has changed."""


def _holds_plain_files(spark, path: str) -> bool:
    names = published.Store(spark, path).names()
    return any(n.endswith(".parquet") or n.startswith(f"{PARTITION_COL}=") for n in names)


def read_table(spark, name: str, path: str, schema: StructType | None = None, days: Iterable[str] | None = None) -> DataFrame:
    """The published rows of a table of :func:`write_table` (of ``days`` only, if given), with its declared schema (or the
    one it was written with) and column order. A plain Parquet folder is read as it is."""
    schema = schema or schemas.OUTPUTS[name]
    now = published.current(spark, path)
    if not now.number:
        return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())
    folders = sorted(published.version_path(path, v) + (f"/{PARTITION_COL}={day}" if day else "")
                     for day, versions in now.parts.items() if days is None or day in days for v in versions)
    if not folders:
        return spark.createDataFrame([], schema)
    stored = spark.read.schema(schema).option("basePath", f"{path.rstrip('/')}/data").parquet(*folders)
    return stored.select(*schema.fieldNames())
