"""Tag dimension jobs: Luna workflow tags (D2), V5 enrichment (D3), the
prompt → tag map (D4) and the daily tag explosion of shown bots (C4).

The seed CSV load (D1) lives in :mod:`botpulse.sources.seed`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from botpulse.functions.constants import TAG_SEPARATOR
from botpulse.functions.dates import DayRange, within
from botpulse.functions.joins import split_join
from botpulse.functions.tagtext import is_luna_path, is_v5_path, pieces, strip_v5_prefix
from botpulse.operators.summaries import show_summary
from botpulse.sources.catalog import Tables


def _tags_on_paths(t: Tables, path_filter) -> DataFrame:
    """``prompt_tag`` rows whose path matches, as ``(tag_id, name, created_at)``."""
    paths = t.prompt_tag_path.where(path_filter(F.col("path"))).select(F.col("id").alias("path_id"))
    return split_join(t.prompt_tag, paths, "path_id").select(F.col("id").alias("tag_id"), "name", "created_at")


def luna_tags(t: Tables, days: DayRange) -> DataFrame:
    """``(prompt_id, tag, event_date)`` for Luna-path tags created on each day.

    The day is the tag's creation day; every link of such a tag yields a row
    (no dedupe).
    """
    tags = within(
        _tags_on_paths(t, is_luna_path).select(
            "tag_id", F.col("name").alias("tag"), F.to_date("created_at").alias("event_date")),
        days,
    )
    return split_join(t.prompt_tag_link, tags, "tag_id").select("prompt_id", "tag", "event_date")


def bot_v5(t: Tables) -> DataFrame:
    """Distinct ``(prompt_id, tags)``: each bot's V5 tags without their prefix."""
    v5 = _tags_on_paths(t, is_v5_path).select("tag_id", strip_v5_prefix(F.col("name")).alias("tags"))
    return split_join(t.prompt_tag_link, v5, "tag_id").select("prompt_id", "tags").distinct()


def enrich_v5(t: Tables, aigc_tag: DataFrame, pairs: DataFrame | None = None, dated: bool = False) -> DataFrame:
    """``aigc_tag`` rows (bot → workflow, per day) joined to each bot's V5 tags (``pairs``, if they are stored).

    Distinct per day, then the days are stacked without their date (unless ``dated``).
    """
    # Both sides are made distinct before the join (same result as distinct after it):
    # repeated copies of a link or an aigc row collapse map-side instead of multiplying.
    aigc = aigc_tag.select("event_date", "prompt_id", F.col("tag").alias("workflow")).distinct()
    joined = aigc.join(pairs if pairs is not None else bot_v5(t), "prompt_id")
    return joined.select("prompt_id", "workflow", "tags", *["event_date"] * dated)


def v5_tags(t: Tables, days: DayRange, aigc_tag: DataFrame | None = None) -> DataFrame:
    """D3: ``(prompt_id, workflow, tags)`` — each AIGC bot's V5 tags, "V5 " prefix removed.

    Per day, the day's ``aigc_tag`` rows (bot → workflow) are joined to the
    bot's V5-path tags and made distinct; the days are then stacked without
    their date, so a (bot, workflow, tag) seen on two days appears twice, as
    the accumulating original table does.
    """
    aigc = aigc_tag if aigc_tag is not None else t.aigc_tag
    if aigc is None:
        aigc = luna_tags(t, days)
    return enrich_v5(t, within(aigc, days))


def dimension(t: Tables, days: DayRange) -> DataFrame:
    """The AIGC dimension: the stored ``aigc_tag_v5`` if given, else derived (D2 → D3) from
    every ``aigc_tag`` day up to the range's end, as the accumulated table holds them."""
    return t.aigc_tag_v5 if t.aigc_tag_v5 is not None else v5_tags(t, days.back_to_start())


def tags_exploded(t: Tables, days: DayRange) -> DataFrame:
    """Distinct ``(prompt_id, tag)`` of the AIGC dimension (read by the by-tag reports)."""
    if t.tags_exploded is not None:
        return t.tags_exploded
    return dimension(t, days).select("prompt_id", F.col("tags").alias("tag")).distinct()


def v5_tag_pieces(t: Tables, limit: int | None = None) -> DataFrame:
    """``(prompt_id, tag)``: each bot's V5 tag names split on commas, trimmed, blanks dropped.

    All pieces by default: a map-side explode of each name. With ``limit`` only the first ``limit`` pieces
    of a bot in name order (the reports this replaces kept 20): every name yields at least one
    piece, so a ``row_number() <= limit`` window keeps that many names before they are split.
    """
    names = split_join(
        t.prompt_tag_link, _tags_on_paths(t, is_v5_path).where(F.col("name").isNotNull()), "tag_id"
    ).select("prompt_id", "name")
    if limit is None:
        split = names.select("prompt_id", F.explode(pieces(F.col("name"))).alias("piece"))
    else:
        ranked = Window.partitionBy("prompt_id").orderBy("name")
        first_names = names.withColumn("rn", F.row_number().over(ranked)).where(F.col("rn") <= limit)
        joined = first_names.groupBy("prompt_id").agg(
            F.array_join(
                F.transform(F.array_sort(F.collect_list(F.struct("rn", "name"))), lambda x: x["name"]),
                TAG_SEPARATOR,
            ).alias("tag_str")
        )
        split = joined.select("prompt_id", F.explode(F.slice(pieces(F.col("tag_str")), 1, limit)).alias("piece"))
    return split.select("prompt_id", F.trim("piece").alias("tag")).where(F.col("tag") != "")


def bot_tags_daily(t: Tables, days: DayRange, limit: int | None = None) -> DataFrame:
    """C4: ``(event_date, prompt_id, tag)`` for every bot shown on the day.

    Tags keep their "V5 " prefix; duplicates are kept; ``limit`` as in :func:`v5_tag_pieces`.
    """
    shown = show_summary(t, days).select("event_date", "prompt_id").distinct()
    return shown.join(v5_tag_pieces(t, limit), "prompt_id").select("event_date", "prompt_id", "tag")
