"""Small hand-made input frames for rule tests."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from botpulse.sources import schemas
from botpulse.sources.catalog import Tables

D1 = dt.date(2024, 1, 1)
D2 = dt.date(2024, 1, 2)
D3 = dt.date(2024, 1, 3)
CREATED = dt.datetime(2024, 1, 1, 10, 0)
V5_PATH = (1, "Bots/V5/x")
LUNA_PATH = (2, "Bots/Luna/workflow")


def frame(spark: SparkSession, rows, schema) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


def make_tables(spark: SparkSession, *, shows=(), views=(), chats=(), evc=(), links=(), tags=(),
                paths=(V5_PATH, LUNA_PATH), v5=None, aigc=None, exploded=None) -> Tables:
    """Rows are tuples in schema order:
    shows (event_date, event_id, prompt_id, user_id); views (event_date, event_id, bot_id, user_id);
    chats (event_date, event_id, prompt_id, user_id, method); evc (event_date, event_name, version, events);
    links (prompt_id, tag_id); tags (id, name, path_id, created_at); paths (id, path);
    v5 (prompt_id, workflow, tags); aigc (prompt_id, tag, event_date); exploded (prompt_id, tag).
    """
    def opt(rows, schema):
        return None if rows is None else frame(spark, rows, schema)

    return Tables(
        show_prompt_card=frame(spark, shows, schemas.SHOW_PROMPT_CARD),
        bot_view=frame(spark, views, schemas.BOT_VIEW),
        chat_send=frame(spark, chats, schemas.CHAT_SEND),
        event_version_count=frame(spark, evc, schemas.EVENT_VERSION_COUNT),
        prompt_tag_link=frame(spark, links, schemas.PROMPT_TAG_LINK),
        prompt_tag=frame(spark, tags, schemas.PROMPT_TAG),
        prompt_tag_path=frame(spark, paths, schemas.PROMPT_TAG_PATH),
        aigc_tag=opt(aigc, schemas.AIGC_TAG),
        aigc_tag_v5=opt(v5, schemas.AIGC_TAG_V5),
        tags_exploded=opt(exploded, schemas.TAGS_EXPLODED),
    )


def rows(df: DataFrame, *cols: str) -> list[tuple]:
    """Sorted tuples of ``cols`` (all columns when none given)."""
    sel = df.select(*cols) if cols else df
    return sorted((tuple(r) for r in sel.collect()), key=lambda r: tuple((x is None, str(x)) for x in r))
