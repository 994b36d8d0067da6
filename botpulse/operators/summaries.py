"""Per (day, user, bot) summaries of the event tables.

Every chat-based KPI — views x chats rows (M2/W2), messages and distinct
chatting users per bot (M3, W3, C3, A3), the non-regenerate variant (C5),
distinct chatting users per day (C2/A2) — is an exact function of one
``(event_date, user_id, prompt_id)`` aggregate of ``chat_send``; the same holds
for bot views (M2/W1/C2) and card shows (W1/C4). Distinct users per bot become a
plain count of summary rows. Only ``COUNT(DISTINCT event_id)`` (M1) needs the
raw tables, since an event id is not known to belong to one user.

The daily run writes these summaries once and every report reads them, so
each event table is scanned and shuffled once per run instead of once per
report. Standalone jobs compute them inline.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from botpulse.functions.constants import METHOD_REGENERATE
from botpulse.functions.dates import DayRange, within
from botpulse.functions.joins import only_bots
from botpulse.sources.catalog import Tables

KEYS = ["event_date", "user_id", "prompt_id"]


def summarize_chats(chats: DataFrame, days: DayRange) -> DataFrame:
    """``(event_date, user_id, prompt_id, n_msgs, n_events, n_kept)``: messages, messages with
    an event id, and messages whose method is not ``regenerate`` (NULL kept)."""
    method = F.col("method")
    kept = method.isNull() | (method != METHOD_REGENERATE)
    return within(chats, days).groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("n_msgs"),
        F.count("event_id").alias("n_events"),
        F.count(F.when(kept, F.lit(1))).alias("n_kept"),
    )


def summarize_views(views: DataFrame, days: DayRange) -> DataFrame:
    """``(event_date, user_id, prompt_id, n_views)`` of bot views."""
    return within(views, days).groupBy("event_date", "user_id", F.col("bot_id").alias("prompt_id")).agg(
        F.count(F.lit(1)).alias("n_views"))


def summarize_shows(shows: DataFrame, days: DayRange) -> DataFrame:
    """``(event_date, user_id, prompt_id, n_shows)`` of card shows."""
    return within(shows, days).groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n_shows"))


def bot_day_facts(t: Tables, days: DayRange) -> DataFrame:
    """Per (day, bot), from one pass over each event table: ``viewers``, ``card_viewers`` and ``chatters``
    (distinct users), ``n_events`` (messages with an event id), and ``pair_rows`` / ``pair_hits`` (rows and matched rows of
    views LEFT JOIN chats on user and bot).

    The three per (day, user, bot) summaries are stacked and summed to one row per (day, user, bot)."""
    zero = F.lit(0).cast("long")
    stacked = None
    for summary, column in ((view_summary(t, days), "n_views"), (show_summary(t, days), "n_shows"),
                            (chat_summary(t, days), "n_msgs")):
        columns = {c: zero for c in ("n_views", "n_shows", "n_msgs", "n_events")} | {column: F.col(column)}
        if column == "n_msgs":
            columns["n_events"] = F.col("n_events")
        part = summary.select(*KEYS, *[c.alias(n) for n, c in columns.items()])
        stacked = part if stacked is None else stacked.unionByName(part)
    user = stacked.groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in ("n_views", "n_shows", "n_msgs", "n_events")])
    known, views, msgs = F.col("user_id").isNotNull(), F.col("n_views"), F.col("n_msgs")
    return user.groupBy("event_date", "prompt_id").agg(
        F.count(F.when(known & (views > 0), 1)).alias("viewers"),
        F.count(F.when(known & (F.col("n_shows") > 0), 1)).alias("card_viewers"),
        F.count(F.when(known & (msgs > 0), 1)).alias("chatters"),
        F.sum("n_events").alias("n_events"),
        F.sum(views * F.when(known, F.greatest(msgs, F.lit(1))).otherwise(1)).alias("pair_rows"),
        F.sum(F.when(known, views * msgs).otherwise(0)).alias("pair_hits"))


def chat_summary(t: Tables, days: DayRange, bots: DataFrame | None = None) -> DataFrame:
    """The stored chat summary, or the chats summarised; of ``bots`` only where given."""
    events = t.chat_summary if t.chat_summary is not None else t.chat_send
    if bots is not None:
        events = only_bots(events, bots, "prompt_id", KEYS)
    return within(events, days) if t.chat_summary is not None else summarize_chats(events, days)


def view_summary(t: Tables, days: DayRange) -> DataFrame:
    return within(t.view_summary, days) if t.view_summary is not None else summarize_views(t.bot_view, days)


def show_summary(t: Tables, days: DayRange) -> DataFrame:
    return within(t.show_summary, days) if t.show_summary is not None else summarize_shows(
        t.show_prompt_card, days)
