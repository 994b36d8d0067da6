"""KPIs rolled up by workflow (W1–W4) and by tag.

By workflow: one row per (day, workflow) for every workflow of the AIGC
dimension and every day. By tag: one row per (day, tag) that has rows in the
per-prompt daily table.

Fan-out (kept from the original jobs): W1/W2 join the *raw* dimension, so a
bot's counts are multiplied by its number of (workflow, tag) rows; W3 uses
distinct (bot, workflow). T1–T3 sum the per-prompt daily tables, which hold one
row per (bot, workflow, tag); computed standalone, the same sums come from
per-bot event counts weighted by those row counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from botpulse.functions.constants import (
    CHAT_DEPTH_USER, CHAT_START_RATE, CLICK_RATE, METRIC_TYPES, RATE_DECIMALS, ROUNDS_DECIMALS)
from botpulse.functions.dates import DayRange, within
from botpulse.functions.metrics import ratio
from botpulse.operators import prompt_metrics as pm
from botpulse.operators.grouped import rows_per_prompt, weighted_rollup, weighted_stack
from botpulse.operators.summaries import bot_day_facts
from botpulse.operators.tags import dimension, tags_exploded
from botpulse.sources.catalog import Tables


def _metric(total_events: str, total_users: str, metric_type: str) -> object:
    """metric_value: clicks/shows, chats/clicks or messages/users by metric type."""
    if metric_type == CLICK_RATE:
        return ratio(total_events, total_users, RATE_DECIMALS)
    if metric_type == CHAT_START_RATE:
        return ratio(total_users, total_events, RATE_DECIMALS)
    return ratio(total_events, total_users, ROUNDS_DECIMALS)


def _finish(rolled: DataFrame, key: str, metric_type: str) -> DataFrame:
    return rolled.select(
        "event_date", F.lit(metric_type).alias("metric_type"), key, "total_events", "total_users", "prompt_count",
    ).withColumn("metric_value", _metric("total_events", "total_users", metric_type))


def _raw_fanout(t: Tables, days: DayRange) -> DataFrame:
    """``(prompt_id, workflow, we, wu)``: weight = the bot's raw dimension rows in the workflow."""
    return dimension(t, days).groupBy("prompt_id", "workflow").agg(F.count(F.lit(1)).alias("we")).withColumn(
        "wu", F.col("we"))


def workflow_click_rate(t: Tables, days: DayRange) -> DataFrame:
    """Distinct viewing users / distinct card-seeing users per workflow (raw fan-out)."""
    per_prompt = pm.click_show_users(t, days)
    return _finish(weighted_rollup(_raw_fanout(t, days), per_prompt, days, "workflow"), "workflow", CLICK_RATE)


def workflow_chat_start(t: Tables, days: DayRange) -> DataFrame:
    """Joined view rows and matched chat rows per workflow (raw fan-out)."""
    per_prompt = pm.view_chat_pairs(t, days).select(
        *pm.KEYS, F.col("click_user_cnt").alias("e"), F.col("chat_user_cnt").alias("u"))
    return _finish(weighted_rollup(_raw_fanout(t, days), per_prompt, days, "workflow"), "workflow",
                   CHAT_START_RATE)


def workflow_chat_depth(t: Tables, days: DayRange) -> DataFrame:
    """Chat messages / distinct chatting users per workflow (distinct bot, workflow)."""
    keyed = dimension(t, days).select("prompt_id", "workflow").distinct().select(
        "prompt_id", "workflow", F.lit(1).alias("we"), F.lit(1).alias("wu"))
    per_prompt = pm.chat_counts(t, days).select(
        *pm.KEYS, F.col("n_events").alias("e"), F.col("n_users").alias("u"))
    return _finish(weighted_rollup(keyed, per_prompt, days, "workflow"), "workflow", CHAT_DEPTH_USER)


WORKFLOW_METRICS = {
    CLICK_RATE: workflow_click_rate,
    CHAT_START_RATE: workflow_chat_start,
    CHAT_DEPTH_USER: workflow_chat_depth,
}


def metrics_by_workflow(t: Tables, days: DayRange, metric_types=METRIC_TYPES) -> DataFrame:
    """The chosen workflow metrics as one long table, from one pass over each event table."""
    chosen = _chosen(WORKFLOW_METRICS, metric_types)
    if len(chosen) == 1:
        return WORKFLOW_METRICS[chosen[0]](t, days)
    copies = F.col("we")
    sums = {
        CLICK_RATE: (copies * F.col("viewers"), copies * F.col("card_viewers")),
        CHAT_START_RATE: (copies * F.col("pair_rows"), copies * F.col("pair_hits")),
        CHAT_DEPTH_USER: (F.col("n_events"), F.col("chatters")),
    }
    return _finish_stack(weighted_stack(_raw_fanout(t, days), bot_day_facts(t, days), days, "workflow",
                                        {m: sums[m] for m in chosen}), "workflow", chosen)


# ---- by tag -------------------------------------------------------------------------
def _by_tag_from_daily(daily: DataFrame, tags: DataFrame, days: DayRange, events_col: str, users_col: str,
                       metric_type: str) -> DataFrame:
    """T from a stored per-prompt daily table, as the original reads it."""
    per_prompt = within(daily, days).groupBy(*pm.KEYS).agg(
        F.sum(events_col).alias("e"), F.sum(users_col).alias("u"))
    return (
        per_prompt.join(tags.select("prompt_id", "tag"), "prompt_id")
        .groupBy("event_date", "tag")
        .agg(F.sum("e").alias("total_events"), F.sum("u").alias("total_users"),
             F.countDistinct("prompt_id").alias("prompt_count"))
        .select("event_date", F.lit(metric_type).alias("metric_type"), "tag",
                "total_events", "total_users", "prompt_count",
                _metric("total_events", "total_users", metric_type).alias("metric_value"))
    )


def _tag_weights(t: Tables, days: DayRange, raw_events: bool) -> DataFrame:
    """``(prompt_id, tag, we, wu)``: a bot's per-prompt daily rows are its distinct
    (workflow, tag) dimension rows, so its counts enter each of its tags that many
    times — except M3's message count, which already carries the raw row count."""
    dim = dimension(t, days)
    weights = rows_per_prompt(dim, True, "k")
    if raw_events:
        weights = weights.join(rows_per_prompt(dim, False, "r"), "prompt_id")
    return tags_exploded(t, days).select("prompt_id", "tag").join(weights, "prompt_id").select(
        "prompt_id", "tag", F.col("r" if raw_events else "k").alias("we"), F.col("k").alias("wu"))


def tag_click_rate(t: Tables, days: DayRange, click_rate: DataFrame | None = None) -> DataFrame:
    """Per tag, summed clicks (total_events) and card shows (total_users) of M1.

    From a stored M1 table when given; otherwise straight from the events with
    the same result (no days × dimension grid).
    """
    if click_rate is not None:
        return _by_tag_from_daily(click_rate, tags_exploded(t, days), days, "click_event_cnt", "show_event_cnt",
                                  CLICK_RATE)
    per_prompt = pm.click_show_events(t, days)
    return _finish(weighted_rollup(_tag_weights(t, days, False), per_prompt, days, "tag"), "tag", CLICK_RATE)


def tag_chat_start(t: Tables, days: DayRange, chat_start: DataFrame | None = None) -> DataFrame:
    """Per tag, summed view rows (total_events) and chat rows (total_users) of M2."""
    if chat_start is not None:
        return _by_tag_from_daily(chat_start, tags_exploded(t, days), days, "click_user_cnt", "chat_user_cnt",
                                  CHAT_START_RATE)
    per_prompt = pm.view_chat_pairs(t, days).select(
        *pm.KEYS, F.col("click_user_cnt").alias("e"), F.col("chat_user_cnt").alias("u"))
    return _finish(weighted_rollup(_tag_weights(t, days, False), per_prompt, days, "tag"), "tag",
                   CHAT_START_RATE)


def tag_chat_depth(t: Tables, days: DayRange, chat_rounds: DataFrame | None = None) -> DataFrame:
    """Per tag, summed chat messages and chatting users of M3."""
    if chat_rounds is not None:
        return _by_tag_from_daily(chat_rounds, tags_exploded(t, days), days, "total_chat_events", "unique_users",
                                  CHAT_DEPTH_USER)
    per_prompt = pm.chat_counts(t, days).select(
        *pm.KEYS, F.col("n_events").alias("e"), F.col("n_users").alias("u"))
    return _finish(weighted_rollup(_tag_weights(t, days, True), per_prompt, days, "tag"), "tag", CHAT_DEPTH_USER)


TAG_METRICS = {
    CLICK_RATE: tag_click_rate,
    CHAT_START_RATE: tag_chat_start,
    CHAT_DEPTH_USER: tag_chat_depth,
}


def metrics_by_tag(t: Tables, days: DayRange, metric_types=METRIC_TYPES, **daily: DataFrame) -> DataFrame:
    """T4: the chosen tag metrics as one long table.

    ``daily`` may pass stored per-prompt tables as ``click_rate=``, ``chat_start=``, ``chat_rounds=``; without
    any, all metrics come from one summary of the events (and M1's distinct event ids).
    """
    chosen = _chosen(TAG_METRICS, metric_types)
    inputs = {CLICK_RATE: "click_rate", CHAT_START_RATE: "chat_start", CHAT_DEPTH_USER: "chat_rounds"}
    if len(chosen) == 1 or any(d is not None for d in daily.values()):
        frames = [TAG_METRICS[m](t, days, daily.get(inputs[m])) for m in chosen]
        out = frames[0]
        for f in frames[1:]:
            out = out.unionByName(f)
        return out
    facts = bot_day_facts(t, days)
    if CLICK_RATE in chosen:
        facts = facts.join(pm.click_show_events(t, days), pm.KEYS, "full")
    kinds, raw = F.col("wu"), F.col("we")  # distinct and raw dimension rows of the bot
    sums = {
        CLICK_RATE: lambda: (kinds * F.col("e"), kinds * F.col("u")),
        CHAT_START_RATE: lambda: (kinds * F.col("pair_rows"), kinds * F.col("pair_hits")),
        CHAT_DEPTH_USER: lambda: (raw * F.col("n_events"), kinds * F.col("chatters")),
    }
    return _finish_stack(weighted_stack(_tag_weights(t, days, True), facts, days, "tag", {m: sums[m]() for m in chosen}),
                         "tag", chosen)


def _chosen(jobs, metric_types) -> list[str]:
    names = [metric_types] if isinstance(metric_types, str) else list(metric_types)
    unknown = [m for m in names if m not in jobs]
    if unknown or not names:
        raise ValueError(f"unknown metric_type {unknown or metric_types!r}; expected one of {list(jobs)}")
    return names


def _finish_stack(stacked: DataFrame, key: str, chosen: list[str]) -> DataFrame:
    value = F.lit(None).cast("double")
    for m in chosen:
        value = F.when(F.col("metric_type") == m, _metric("total_events", "total_users", m)).otherwise(value)
    return stacked.select("event_date", "metric_type", key, "total_events", "total_users", "prompt_count",
                          value.alias("metric_value"))
