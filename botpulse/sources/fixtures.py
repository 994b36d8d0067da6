"""Adapter from the driver's test tables to the job inputs.

The test data holds a generic ``events(event_id, ts, user_id, event_type,
value, props)`` table and a TPC-H ``part`` table. They map onto the chatbot
inputs as follows (whole tables, every day, every part):

* bot key: ``props.k`` → ``prompt_id = 'p' || k``
* ``view`` events are card impressions (``show_prompt_card``), ``click`` events
  are bot views (``bot_view``), ``purchase``/``signup``/``error`` events are chat
  messages with method NULL / ``send`` / ``regenerate``
* ``event_version_count`` counts events per day, event name and app version
  (``user_id % 3``)
* every part ``p_partkey`` is bot ``'p' || p_partkey``; its name words give a
  V5 "style" tag and a V5 "object" tag, its type gives a Luna workflow tag.
  Bots with ``p_size <= 30`` are linked to their type's workflow (the AIGC
  bots), brands 1-4 also to the PROMO workflow, cheap parts to a legacy tag.

The same mapping is written as SQL in ``sql_oracles.py`` for the DuckDB oracle.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from botpulse.functions.dates import DayRange
from botpulse.sources.catalog import Tables

# Fixed fixture values (tag paths, creation times).
TAG_PATHS = [(1, "Bots/V5/style"), (2, "Bots/V5/object"), (3, "Bots/Luna/workflow"), (4, "Bots/Legacy")]
CREATED_DAY_1 = dt.datetime(2024, 1, 1, 8, 0, 0)
CREATED_DAY_2 = dt.datetime(2024, 1, 2, 9, 30, 0)
LATE_WORKFLOWS = ("PROMO", "LARGE")
SECOND_WORKFLOW_BRANDS = ("Brand#1", "Brand#2", "Brand#3", "Brand#4")


def _ntz(value: dt.datetime):
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def event_tables(events: DataFrame) -> dict[str, DataFrame]:
    ev = events.select(
        F.to_date("ts").alias("event_date"),
        "event_id",
        "user_id",
        "event_type",
        # props is a one-key JSON object ({"k": 69}); a key-anchored regex reads it ~4x faster
        # than a JSON parser per row.
        F.concat(F.lit("p"), F.regexp_extract("props", r'"k"\s*:\s*(-?[0-9]+)', 1).cast("int").cast("string"))
        .alias("prompt_id"),
    )
    show = ev.where(F.col("event_type") == "view").select("event_date", "event_id", "prompt_id", "user_id")
    view = ev.where(F.col("event_type") == "click").select(
        "event_date", "event_id", F.col("prompt_id").alias("bot_id"), "user_id")
    chat = ev.where(F.col("event_type").isin("purchase", "signup", "error")).select(
        "event_date", "event_id", "prompt_id", "user_id",
        F.when(F.col("event_type") == "error", "regenerate")
        .when(F.col("event_type") == "signup", "send").alias("method"))
    event_name = (F.when(F.col("event_type") == "click", "view_bot")
                  .when(F.col("event_type") == "view", "show_prompt_card")
                  .otherwise(F.col("event_type")))
    version_count = ev.groupBy(
        "event_date", event_name.alias("event_name"), (F.col("user_id") % 3).cast("int").alias("version")
    ).agg(F.count(F.lit(1)).alias("events"))
    return {"show_prompt_card": show, "bot_view": view, "chat_send": chat, "event_version_count": version_count}


def catalog_tables(spark: SparkSession, part: DataFrame) -> dict[str, DataFrame]:
    """Tag catalogue from one pass over ``part``: each part yields the tags it is
    linked to as ``(tag_id, name, path_id, created_at)`` structs."""
    style = F.regexp_extract("p_name", r"^[a-z]+", 0)
    obj = F.regexp_extract("p_name", r"[a-z]+$", 0)
    p_type = F.col("p_type")

    def tag(tag_id, name, path_id, created):
        return F.struct(tag_id.alias("tag_id"), name.alias("name"), F.lit(path_id).alias("path_id"),
                        created.alias("created_at"))

    style_tag = tag(F.concat(F.lit("s:"), style),
                    F.when(style == "small", F.lit("V5 small, cozy"))  # a comma inside a name
                    .otherwise(F.concat(F.lit("V5 "), style)), 1, _ntz(CREATED_DAY_1))
    object_tag = tag(F.concat(F.lit("o:"), obj), F.concat(F.lit("V5   "), obj, F.lit(" ")), 2,  # extra blanks
                     _ntz(CREATED_DAY_1))
    workflow_tag = tag(F.concat(F.lit("w:"), p_type),
                       F.when(p_type == "SMALL", F.lit("")).otherwise(F.lower(p_type)), 3,  # blank workflow
                       F.when(p_type.isin(*LATE_WORKFLOWS), _ntz(CREATED_DAY_2)).otherwise(_ntz(CREATED_DAY_1)))
    promo_tag = tag(F.lit("w:PROMO"), F.lit("promo"), 3, _ntz(CREATED_DAY_2))
    legacy_tag = tag(F.lit("x:old"), F.lit("old"), 4, _ntz(CREATED_DAY_1))

    linked = F.filter(
        F.array(
            style_tag,
            object_tag,
            F.when(F.col("p_size") <= 30, workflow_tag),
            F.when(F.col("p_brand").isin(*SECOND_WORKFLOW_BRANDS) & (p_type != "PROMO"), promo_tag),
            F.when(F.col("p_retailprice") < 950, legacy_tag),
        ),
        lambda x: x.isNotNull(),
    )
    links = part.select(
        F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("prompt_id"),
        F.explode(linked).alias("t"))
    # Every tag of the catalogue, linked or not (type tags of bots above the size cut included).
    every_tag = F.array(style_tag, object_tag, workflow_tag, legacy_tag)
    tags = part.select(F.inline(every_tag)).withColumnRenamed("tag_id", "id").distinct()
    paths = spark.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("id"), F.lit(p).alias("path")) for i, p in TAG_PATHS])))
    return {
        "prompt_tag_link": links.select("prompt_id", "t.tag_id"),
        "prompt_tag": tags,
        "prompt_tag_path": paths,
    }


def fixture_tables(spark: SparkSession, sf_dir: str) -> Tables:
    """Job inputs derived from ``{sf_dir}/events.parquet`` and ``{sf_dir}/part.parquet``."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    return Tables(**event_tables(events), **catalog_tables(spark, part))


_DAYS: dict[str, DayRange] = {}


def fixture_days(spark: SparkSession, sf_dir: str) -> DayRange:
    """Every day present in ``{sf_dir}/events.parquet`` (read-only data: computed once per folder)."""
    if sf_dir not in _DAYS:
        events = spark.read.parquet(f"{sf_dir}/events.parquet")
        _DAYS[sf_dir] = DayRange.covering(events.select(F.to_date("ts").alias("event_date")))
    return _DAYS[sf_dir]
