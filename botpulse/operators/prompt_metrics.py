"""Per-prompt daily KPIs for AIGC bots: click rate (M1), chat start rate (M2)
and chat rounds per user (M3).

Each output has one row per (day, dimension row) for every day of the range,
also for bots without events. Events are aggregated to (day, bot) before they
meet the dimension, so no event row is ever joined or grouped with a
dimension-sized fan-out and a hot bot is split across tasks by the
aggregation's map-side combine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from botpulse.functions.constants import RATE_DECIMALS, ROUNDS_DECIMALS
from botpulse.functions.dates import DayRange, daily_values, within
from botpulse.functions.joins import only_bots
from botpulse.functions.metrics import ratio, zero_if_null
from botpulse.operators.summaries import chat_summary, show_summary, view_summary
from botpulse.operators.tags import dimension
from botpulse.sources.catalog import Tables

KEYS = ["event_date", "prompt_id"]
USER_KEYS = ["event_date", "user_id", "prompt_id"]


def distinct_per_bot(events: DataFrame, days: DayRange, bot_col: str, value_col: str, name: str,
                     bots: DataFrame) -> DataFrame:
    """``COUNT(DISTINCT value_col)`` per (day, bot) of ``bots`` as ``(event_date, prompt_id, name)``.

    Events of other bots are left out by a semi-join before the aggregation: event ids are nearly
    unique, so its shuffle is as large as its input."""
    kept = only_bots(within(events, days), bots, bot_col, ["event_date", bot_col, value_col])
    return kept.groupBy("event_date", F.col(bot_col).alias("prompt_id")).agg(
        F.countDistinct(value_col).alias(name))


def click_show_events(t: Tables, days: DayRange) -> DataFrame:
    """Per day and AIGC bot: distinct event ids of bot views as ``e`` and of card shows as ``u``."""
    bots = dimension(t, days)
    clicks = distinct_per_bot(t.bot_view, days, "bot_id", "event_id", "e", bots)
    shows = distinct_per_bot(t.show_prompt_card, days, "prompt_id", "event_id", "u", bots)
    return clicks.join(shows, KEYS, "full")


def click_show_users(t: Tables, days: DayRange) -> DataFrame:
    """Per (day, bot): distinct users with a bot view as ``e`` and with a card show as ``u``
    (one summary row per user, so a count of non-NULL users)."""
    viewers = view_summary(t, days).groupBy(*KEYS).agg(F.count("user_id").alias("e"))
    card_viewers = show_summary(t, days).groupBy(*KEYS).agg(F.count("user_id").alias("u"))
    return viewers.join(card_viewers, KEYS, "full")


def view_chat_pairs(t: Tables, days: DayRange) -> DataFrame:
    """Per (day, bot): rows of ``views LEFT JOIN chats ON (user, bot)`` and how many matched.

    Computed from pre-counts: a (day, user, bot) with ``v`` views and ``c``
    chats contributes ``v * max(c, 1)`` joined rows and ``v * c`` matched rows —
    the same numbers as the row-level join without its ``v * c`` blow-up.
    Output ``(event_date, prompt_id, click_user_cnt, chat_user_cnt)``.
    """
    views = view_summary(t, days).select(*USER_KEYS, F.col("n_views").alias("v"))
    chats = chat_summary(t, days).select(*USER_KEYS, F.col("n_msgs").alias("c"))
    return views.join(chats, USER_KEYS, "left").groupBy(*KEYS).agg(
        F.sum(F.col("v") * F.coalesce(F.col("c"), F.lit(1))).alias("click_user_cnt"),
        F.sum(F.col("v") * zero_if_null("c")).alias("chat_user_cnt"),
    )


def chat_counts(t: Tables, days: DayRange, kept_only: bool = False, bots: DataFrame | None = None) -> DataFrame:
    """Per (day, bot) of chat messages: ``COUNT(*)`` as ``n_msgs``, ``COUNT(event_id)`` as
    ``n_events`` and ``COUNT(DISTINCT user_id)`` as ``n_users``; with ``kept_only`` over the
    messages whose method is not ``regenerate`` (``n_msgs``, ``n_users`` only). ``bots`` limits it to
    these bots, by a semi-join below the aggregation."""
    summary = chat_summary(t, days, bots)
    if kept_only:
        summary = summary.where(F.col("n_kept") > 0).withColumn("n_msgs", F.col("n_kept"))
    return summary.groupBy(*KEYS).agg(
        F.sum("n_msgs").alias("n_msgs"),
        F.sum("n_events").alias("n_events"),
        F.count("user_id").alias("n_users"))


def click_rate_daily(t: Tables, days: DayRange) -> DataFrame:
    """M1: distinct bot-view events / distinct card-show events per (day, prompt, workflow, tag).

    Dimension made distinct first. Counts 0 and rate NULL without shows.
    """
    dim = dimension(t, days).select("prompt_id", "workflow", "tags").distinct()
    counts = click_show_events(t, days).withColumnsRenamed({"e": "clicks", "u": "shows"})
    clicks_n, shows_n = zero_if_null("clicks"), zero_if_null("shows")
    return (
        daily_values(dim, counts, days)
        .select(
            "event_date", "prompt_id", "workflow", "tags",
            clicks_n.alias("click_event_cnt"),
            shows_n.alias("show_event_cnt"),
            ratio(clicks_n, "shows", RATE_DECIMALS).alias("click_rate"),
        )
    )


def chat_start_daily(t: Tables, days: DayRange) -> DataFrame:
    """M2: joined view rows, matched chat rows and their ratio per (day, prompt, workflow, tag).

    Counts are joined rows, not users (see :func:`view_chat_pairs`). NULL → 0
    everywhere, the rate included.
    """
    dim = dimension(t, days).select("prompt_id", "workflow", "tags").distinct()
    per_bot = view_chat_pairs(t, days).withColumn(
        "rate", ratio("chat_user_cnt", "click_user_cnt", RATE_DECIMALS))
    return daily_values(dim, per_bot, days).select(
        "event_date", "prompt_id", "workflow", "tags",
        zero_if_null("click_user_cnt").alias("click_user_cnt"),
        zero_if_null("chat_user_cnt").alias("chat_user_cnt"),
        F.coalesce(F.col("rate"), F.lit(0.0)).alias("chat_start_rate"),
    )


def chat_rounds_daily(t: Tables, days: DayRange) -> DataFrame:
    """M3: chat messages, distinct chatting users and messages per user, per (day, prompt, workflow, tag).

    The dimension is *not* made distinct: ``k`` identical dimension rows
    multiply the message count by ``k`` but not the user count. Average NULL
    without users.
    """
    dim = dimension(t, days).groupBy("prompt_id", "workflow", "tags").agg(F.count(F.lit(1)).alias("dim_rows"))
    chats = chat_counts(t, days, bots=dim)
    total = F.col("dim_rows") * zero_if_null("n_events")
    users = zero_if_null("n_users")
    return daily_values(dim, chats, days).select(
        "event_date", "prompt_id", "workflow", "tags",
        total.alias("total_chat_events"),
        users.alias("unique_users"),
        ratio(total, users, ROUNDS_DECIMALS).alias("avg_chat_rounds_per_user"),
    )
