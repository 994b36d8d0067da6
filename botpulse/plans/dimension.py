"""Upkeep of the stored V5 dimension (D3), day by day.

The dimension is stored by the day of the ``aigc_tag`` row that a row comes from; readers take it without the
day. Its publication notes of which versions of ``aigc_tag`` and of the seed list a day was made. A run
recomputes the days whose versions differ from the noted ones (its own days, a new
seed day, days of a run that broke off between the two tables) and the days of bots whose V5 tags have changed
since the last run, told from a stored copy of the (bot, tag) pairs. Everything else stays as it is, so rows
read and written do not grow with the days stored. Only when links have changed are the days of those bots looked up in two columns of
the tag tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from botpulse.functions.dates import DayRange
from botpulse.operators import tags
from botpulse.sources import published, schemas
from botpulse.sources.catalog import Tables
from botpulse.sources.sinks import read_table, table_exists, write_table

SOURCES = ("aigc_tag", "aigc_tag_seed")


def stored_tags(spark, path: dict[str, str], days: set[str] | None = None) -> DataFrame | None:
    """The rows (of ``days``) of the tag tables that there are; other days' files aren't even listed."""
    found = [read_table(spark, "aigc_tag", path[n], days=days) for n in SOURCES if table_exists(spark, path[n])]
    if not found:
        return None
    return found[0] if len(found) == 1 else found[0].unionByName(found[1])


def _made_of(spark, path: dict[str, str]) -> dict[str, str]:
    """Day → the versions that the tag tables hold of it."""
    made: dict[str, list[str]] = {}
    for name in SOURCES:
        if table_exists(spark, path[name]):
            for day, versions in published.current(spark, path[name]).parts.items():
                made.setdefault(day, []).extend(versions)
    return {day: " ".join(versions) for day, versions in made.items()}


def _days_of(rows: DataFrame, bots: DataFrame) -> set[str]:
    days = rows.select("prompt_id", "event_date").join(bots, "prompt_id", "left_semi").select("event_date").distinct()
    return {r[0].isoformat() for r in days.collect()}  # one entry a day


def refresh_dimension(t: Tables, path: dict[str, str], days: DayRange, mode: str = "overwrite", run_id: str | None = None) -> int | None:
    """Bring the stored dimension up to date with the stored tag tables; returns the rows written, None without a tag table.

    ``mode="append"`` adds the V5 rows of the run's days instead, as an accumulating table does. The outcome of
    ``overwrite`` is that of a rebuild from all stored days, whatever ran before.
    """
    spark = t.spark
    if not any(table_exists(spark, path[n]) for n in SOURCES):
        return None
    target = path["aigc_tag_v5"]
    if mode != "overwrite":
        added = tags.enrich_v5(t, stored_tags(spark, path, {d.isoformat() for d in days.days()}), dated=True)
        return write_table(added, target, mode=mode, run_id=run_id)
    made, before = _made_of(spark, path), published.current(spark, target)
    pairs_at = f"{target}_pairs"
    version = published.new_version()
    tags.bot_v5(t).write.parquet(published.version_path(pairs_at, version))  # published below, after the dimension
    schema = schemas.BOT_V5
    pairs = spark.read.schema(schema).parquet(published.version_path(pairs_at, version))
    stale = {d for d in {*made, *before.notes, *before.parts} if made.get(d) != before.notes.get(d)}
    if not published.current(spark, pairs_at).number:
        stale |= set(made)
    else:
        known = read_table(spark, "bot_v5", pairs_at, schema)
        changed = pairs.subtract(known).unionByName(known.subtract(pairs)).select("prompt_id").distinct()
        if not changed.isEmpty():
            stale |= _days_of(stored_tags(spark, path), changed)
    rows = write_table(tags.enrich_v5(t, stored_tags(spark, path, stale), pairs, dated=True), target, days=stale,
                       notes={d: made.get(d) for d in stale})
    published.publish(spark, pairs_at, lambda now: now.replacing([""], version, [""]))
    return rows
