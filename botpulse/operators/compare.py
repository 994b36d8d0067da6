"""AIGC vs all-bots comparison reports.

* C1 / A1 click rate, C2 / A2 chat start rate: the AIGC side sums the
  per-prompt daily tables (by workflow for C, per day for A); the all-bots side
  is one row per day.
* C3 / A3 chat depth: every chat message is classed AIGC or AllBots by the
  AIGC dimension.
* C5 chat depth by tag, over the daily tag explosion (C4).

"All bots" means three different things, kept as in the original reports:
C1/A1 count everything in ``event_version_count``; C2/A2 count all viewing users
and those of them who chatted with any bot; C3/A3/C5 mean bots *not* in the
AIGC dimension.

One-row-per-day branches (C1/C2 all bots, A1/A2 both sides) are global
aggregates in the original per-day SQL, so they exist even on days without
input. Here they are aggregated per day and then left-joined onto the day
spine; sums stay NULL and counts become 0 on empty days.

The AIGC sides read stored per-prompt daily tables when given (as the daily
run does); standalone they sum per-bot event counts weighted by each bot's
number of per-prompt rows, with the same result and no days × dimension grid.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from botpulse.functions.constants import (
    AIGC, ALL_BOTS, ALL_WORKFLOWS, EVENT_SHOW_PROMPT_CARD, EVENT_VIEW_BOT, RATE_DECIMALS, ROUNDS_DECIMALS)
from botpulse.functions.dates import DayRange, day_spine, within
from botpulse.functions.metrics import bot_type, ratio, zero_if_null
from botpulse.operators import prompt_metrics as pm
from botpulse.operators.grouped import rows_per_prompt, weighted_rollup
from botpulse.operators.summaries import chat_summary, view_summary
from botpulse.operators.tags import bot_tags_daily, dimension
from botpulse.sources.catalog import Tables


def _named() -> Column:
    """A non-NULL, non-empty workflow."""
    return F.col("workflow").isNotNull() & (F.col("workflow") != "")


def _named_workflow(df: DataFrame) -> DataFrame:
    return df.where(_named())


def _m1_counts(t: Tables, days: DayRange) -> DataFrame:
    return pm.click_show_events(t, days)


def _m2_counts(t: Tables, days: DayRange) -> DataFrame:
    return pm.view_chat_pairs(t, days).select(
        *pm.KEYS, F.col("click_user_cnt").alias("e"), F.col("chat_user_cnt").alias("u"))


def _aigc_by_workflow(t: Tables, days: DayRange, per_prompt: DataFrame) -> DataFrame:
    """``(event_date, workflow, total_events, total_users)``: what summing a per-prompt daily
    table (one row per distinct bot, workflow, tag) over named workflows gives."""
    keyed = (dimension(t, days).select("prompt_id", "workflow", "tags").distinct().where(_named())
             .groupBy("prompt_id", "workflow").agg(F.count(F.lit(1)).alias("we")).withColumn("wu", F.col("we")))
    return weighted_rollup(keyed, per_prompt, days, "workflow").drop("prompt_count")


def _aigc_per_day(t: Tables, days: DayRange, per_prompt: DataFrame, named_only: bool) -> DataFrame:
    """``(event_date, total_events, total_users)`` summed over all AIGC rows of a per-prompt
    daily table, one row per day — absent on days that table would have no rows."""
    keyed = rows_per_prompt(dimension(t, days), True, "we", _named() if named_only else None).select(
        "prompt_id", F.lit(AIGC).alias("group"), "we", F.col("we").alias("wu"))
    return weighted_rollup(keyed, per_prompt, days, "group").select("event_date", "total_events", "total_users")


def all_bots_clicks(t: Tables, days: DayRange) -> DataFrame:
    """Per day: ``(event_date, total_clicks, total_shows)`` over all app versions; NULL sums
    on days without rows."""
    name = F.col("event_name")
    per_day = (
        within(t.event_version_count, days)
        .where(name.isin(EVENT_VIEW_BOT, EVENT_SHOW_PROMPT_CARD))
        .groupBy("event_date")
        .agg(
            F.sum(F.when(name == EVENT_VIEW_BOT, F.col("events")).otherwise(F.lit(0))).alias("total_clicks"),
            F.sum(F.when(name == EVENT_SHOW_PROMPT_CARD, F.col("events")).otherwise(F.lit(0))).alias("total_shows"),
        )
    )
    return day_spine(t.spark, days).join(per_day, "event_date", "left")


def all_bots_chat_users(t: Tables, days: DayRange) -> DataFrame:
    """Per day: ``(event_date, click_users, chat_users)`` — distinct users with a bot view
    and how many of them sent any chat message that day; 0 on empty days."""
    viewers = view_summary(t, days).select("event_date", "user_id").distinct()
    chatters = chat_summary(t, days).select("event_date", "user_id").distinct().withColumn("chatted", F.lit(1))
    per_day = viewers.join(chatters, ["event_date", "user_id"], "left").groupBy("event_date").agg(
        F.count("user_id").alias("click_users"), F.count("chatted").alias("chat_users"))
    return day_spine(t.spark, days).join(per_day, "event_date", "left").select(
        "event_date", zero_if_null("click_users").alias("click_users"),
        zero_if_null("chat_users").alias("chat_users"))


def click_compare(t: Tables, days: DayRange, click_rate: DataFrame | None = None) -> DataFrame:
    """AIGC click rate per named workflow, plus one ``ALL``/``AllBots`` row per day."""
    if click_rate is not None:
        sums = _named_workflow(within(click_rate, days)).groupBy("event_date", "workflow").agg(
            F.sum("click_event_cnt").alias("total_clicks"), F.sum("show_event_cnt").alias("total_shows"))
    else:
        sums = _aigc_by_workflow(t, days, _m1_counts(t, days)).withColumnsRenamed(
            {"total_events": "total_clicks", "total_users": "total_shows"})
    aigc = sums.select("event_date", "workflow", F.lit(AIGC).alias("bot_type"), "total_clicks", "total_shows")
    every = all_bots_clicks(t, days).select(
        "event_date", F.lit(ALL_WORKFLOWS).alias("workflow"), F.lit(ALL_BOTS).alias("bot_type"),
        "total_clicks", "total_shows")
    return aigc.unionByName(every).withColumn(
        "click_rate", ratio("total_clicks", "total_shows", RATE_DECIMALS))


def chat_start_compare(t: Tables, days: DayRange, chat_start: DataFrame | None = None) -> DataFrame:
    """AIGC chat start rate per named workflow, plus one ``ALL``/``AllBots`` row per day."""
    if chat_start is not None:
        sums = _named_workflow(within(chat_start, days)).groupBy("event_date", "workflow").agg(
            F.sum("click_user_cnt").alias("total_click_users"), F.sum("chat_user_cnt").alias("total_chat_users"))
    else:
        sums = _aigc_by_workflow(t, days, _m2_counts(t, days)).withColumnsRenamed(
            {"total_events": "total_click_users", "total_users": "total_chat_users"})
    aigc = sums.select("event_date", "workflow", F.lit(AIGC).alias("bot_type"), "total_click_users",
                       "total_chat_users")
    every = all_bots_chat_users(t, days).select(
        "event_date", F.lit(ALL_WORKFLOWS).alias("workflow"), F.lit(ALL_BOTS).alias("bot_type"),
        F.col("click_users").alias("total_click_users"), F.col("chat_users").alias("total_chat_users"))
    return aigc.unionByName(every).withColumn(
        "chat_start_rate", ratio("total_chat_users", "total_click_users", RATE_DECIMALS))


def _depth_or_zero(msgs: str, users: str) -> object:
    """0 when the user sum is 0, else ``ROUND(msgs / users, 4)``."""
    return F.when(F.col(users) == 0, F.lit(0.0)).otherwise(ratio(msgs, users, RATE_DECIMALS))


def chat_depth_compare(t: Tables, days: DayRange) -> DataFrame:
    """Chat messages per user by (bot type, workflow); AllBots rows have workflow NULL.

    A bot in two workflows counts fully in each (distinct bot, workflow).
    """
    dim = dimension(t, days).select("prompt_id", "workflow").distinct().withColumn("in_dim", F.lit(True))
    per_bot = pm.chat_counts(t, days).join(dim, "prompt_id", "left")
    return (
        per_bot.groupBy("event_date", bot_type(F.col("in_dim").isNotNull()).alias("bot_type"), "workflow")
        .agg(F.sum("n_msgs").alias("total_msgs"), F.sum("n_users").alias("user_count"))
        .withColumn("chat_depth_user", _depth_or_zero("total_msgs", "user_count"))
    )


def chat_depth_total_compare(t: Tables, days: DayRange) -> DataFrame:
    """A3: chat messages per user, AIGC vs other bots.

    Against the raw dimension: an AIGC bot's messages count once per
    dimension row, its users once.
    """
    dim_rows = dimension(t, days).groupBy("prompt_id").agg(F.count(F.lit(1)).alias("dim_rows"))
    per_bot = pm.chat_counts(t, days).join(dim_rows, "prompt_id", "left")
    return (
        per_bot.groupBy("event_date", bot_type(F.col("dim_rows").isNotNull()).alias("bot_type"))
        .agg(F.sum(F.col("n_msgs") * F.coalesce(F.col("dim_rows"), F.lit(1))).alias("total_msgs"),
             F.sum("n_users").alias("user_count"))
        .withColumn("chat_depth_user", _depth_or_zero("total_msgs", "user_count"))
    )


def chat_depth_by_tag(t: Tables, days: DayRange, bot_tags: DataFrame | None = None) -> DataFrame:
    """Non-regenerate chat messages per user by (day, tag, bot type) over the day's tags.

    A bot's per-day counts are multiplied by its number of raw AIGC dimension
    rows (1 for other bots). Days without qualifying messages give no rows.
    """
    per_bot = pm.chat_counts(t, days, kept_only=True)
    tags_daily = within(bot_tags if bot_tags is not None else bot_tags_daily(t, days), days)
    dim_rows = dimension(t, days).groupBy("prompt_id").agg(F.count(F.lit(1)).alias("dim_rows"))
    tagged = tags_daily.join(dim_rows, "prompt_id", "left").select(
        "event_date", "prompt_id", "tag",
        bot_type(F.col("dim_rows").isNotNull()).alias("bot_type"),
        F.coalesce(F.col("dim_rows"), F.lit(1)).alias("mult"))
    return (
        per_bot.join(tagged, pm.KEYS)
        .groupBy("event_date", "tag", "bot_type")
        .agg(F.sum(F.col("n_msgs") * F.col("mult")).alias("total_chat_events"),
             F.sum(F.col("n_users") * F.col("mult")).alias("total_chat_user_count"))
        .where(F.col("total_chat_events") > 0)
        .withColumn("chat_depth_user", ratio("total_chat_events", "total_chat_user_count", ROUNDS_DECIMALS))
    )


def click_total_compare(t: Tables, days: DayRange, click_rate: DataFrame | None = None) -> DataFrame:
    """A1: one AIGC row (named workflows) and one AllBots row per day."""
    if click_rate is not None:
        aigc_day = _named_workflow(within(click_rate, days)).groupBy("event_date").agg(
            F.sum("click_event_cnt").alias("total_clicks"), F.sum("show_event_cnt").alias("total_shows"))
    else:
        aigc_day = _aigc_per_day(t, days, _m1_counts(t, days), named_only=True).withColumnsRenamed(
            {"total_events": "total_clicks", "total_users": "total_shows"})
    aigc = day_spine(t.spark, days).join(aigc_day, "event_date", "left").select(
        "event_date", F.lit(AIGC).alias("bot_type"), "total_clicks", "total_shows")
    every = all_bots_clicks(t, days).select(
        "event_date", F.lit(ALL_BOTS).alias("bot_type"), "total_clicks", "total_shows")
    return aigc.unionByName(every).withColumn(
        "click_rate", ratio("total_clicks", "total_shows", RATE_DECIMALS))


def chat_start_total_compare(t: Tables, days: DayRange, chat_start: DataFrame | None = None) -> DataFrame:
    """A2: one AIGC row (every workflow, empty ones included) and one AllBots row per day."""
    if chat_start is not None:
        aigc_day = within(chat_start, days).groupBy("event_date").agg(
            F.sum("click_user_cnt").alias("click_user_cnt"), F.sum("chat_user_cnt").alias("chat_user_cnt"))
    else:
        aigc_day = _aigc_per_day(t, days, _m2_counts(t, days), named_only=False).withColumnsRenamed(
            {"total_events": "click_user_cnt", "total_users": "chat_user_cnt"})
    aigc = day_spine(t.spark, days).join(aigc_day, "event_date", "left").select(
        "event_date", F.lit(AIGC).alias("workflow"), F.lit(AIGC).alias("bot_type"),
        "click_user_cnt", "chat_user_cnt")
    every = all_bots_chat_users(t, days).select(
        "event_date", F.lit(ALL_WORKFLOWS).alias("workflow"), F.lit(ALL_BOTS).alias("bot_type"),
        F.col("click_users").alias("click_user_cnt"), F.col("chat_users").alias("chat_user_cnt"))
    return aigc.unionByName(every).withColumn(
        "chat_start_rate", ratio("chat_user_cnt", "click_user_cnt", RATE_DECIMALS))
