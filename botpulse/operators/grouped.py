"""Weighted roll-up of per-bot daily counts to groups of bots (workflow, tag, all AIGC).

The original roll-ups join per-bot counts to a dimension that holds a bot
several times and sum, so each bot's counts enter a group multiplied by its
number of dimension rows there. Here that multiplicity is a weight column,
and the day grid is days × groups, not days × dimension rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from botpulse.functions.dates import DayRange, spread_over_days
from botpulse.functions.metrics import zero_if_null


def weighted_rollup(keyed: DataFrame, per_prompt: DataFrame, days: DayRange, key: str) -> DataFrame:
    """Sum ``per_prompt`` counts over the bots of each ``key`` group, per day.

    ``keyed (prompt_id, key, we, wu)``: one row per bot membership in a group,
    ``we``/``wu`` the weights of the bot's ``e``/``u`` counts in that group
    (duplicate memberships count twice, as a join would).
    ``per_prompt (event_date, prompt_id, e, u)``: per-day counts of each bot.

    Returns ``(event_date, key, prompt_count, total_events, total_users)`` with a
    row for every day of ``days`` and every group of ``keyed``; sums are 0 when
    the group's bots had no counts that day. The group key may be NULL (joined
    null-safe).
    """
    sums = per_prompt.join(keyed, "prompt_id").groupBy(
        F.col("event_date").alias("s_date"), F.col(key).alias("s_key")
    ).agg(
        F.sum(F.col("we") * zero_if_null("e")).alias("s_events"),
        F.sum(F.col("wu") * zero_if_null("u")).alias("s_users"),
    )
    groups = keyed.groupBy(key).agg(F.countDistinct("prompt_id").alias("prompt_count"))
    grid = spread_over_days(groups, days)
    joined = grid.join(sums, (F.col("event_date") == F.col("s_date")) & F.col(key).eqNullSafe(F.col("s_key")), "left")
    return joined.select(
        "event_date", key, "prompt_count",
        zero_if_null("s_events").alias("total_events"),
        zero_if_null("s_users").alias("total_users"),
    )


def weighted_stack(keyed: DataFrame, facts: DataFrame, days: DayRange, key: str,
                   sums: dict[str, tuple[Column, Column]]) -> DataFrame:
    """Several metrics of each ``key`` group from one join and one aggregation.

    ``keyed (prompt_id, key, weights...)``, ``facts (event_date, prompt_id, counts...)``; ``sums[metric]`` are the
    row expressions whose sums are the metric's total_events and total_users. Returns ``(event_date, key,
    prompt_count, metric_type, total_events, total_users)`` for every day, group and metric."""
    names = {m: (f"s{i}_events", f"s{i}_users") for i, m in enumerate(sums)}
    totals = facts.join(keyed, "prompt_id").groupBy(F.col("event_date").alias("s_date"), F.col(key).alias("s_key")).agg(
        *[F.sum(zero_if_null(c)).alias(n) for m, pair in sums.items() for c, n in zip(pair, names[m])])
    groups = keyed.groupBy(key).agg(F.countDistinct("prompt_id").alias("prompt_count"))
    joined = spread_over_days(groups, days).join(
        totals, (F.col("event_date") == F.col("s_date")) & F.col(key).eqNullSafe(F.col("s_key")), "left")
    rows = F.array(*[F.struct(F.lit(m).alias("metric_type"), zero_if_null(e).alias("total_events"),
                              zero_if_null(u).alias("total_users")) for m, (e, u) in names.items()])
    return joined.select("event_date", key, "prompt_count", F.inline(rows))


def rows_per_prompt(dim: DataFrame, distinct: bool, name: str, where=None) -> DataFrame:
    """``(prompt_id, name)``: a bot's number of dimension rows (all, or distinct
    (prompt, workflow, tags) rows), optionally only rows matching ``where``."""
    rows = dim.select("prompt_id", "workflow", "tags")
    if distinct:
        rows = rows.distinct()
    if where is not None:
        rows = rows.where(where)
    return rows.groupBy("prompt_id").agg(F.count(F.lit(1)).alias(name))
