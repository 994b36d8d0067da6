"""Registry of every report job: name → ``f(tables, days) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from botpulse.functions.dates import DayRange
from botpulse.operators import compare, rollups, tags
from botpulse.operators import prompt_metrics as pm
from botpulse.sources.catalog import Tables
from botpulse.sources.seed import clean_seed, through_csv

Job = Callable[[Tables, DayRange], DataFrame]

SEED_DATE = "2025-05-10"  # fixed stamp of the seed load


def seed_tags_roundtrip(t: Tables, days: DayRange) -> DataFrame:
    """D1 over the test data: the Luna bot → workflow rows as CSV records, parsed and cleaned as
    the seed file's are."""
    return clean_seed(through_csv(tags.luna_tags(t, days)), SEED_DATE)


JOBS: dict[str, Job] = {
    # tag dimensions
    "seed_tags": seed_tags_roundtrip,
    "luna_tags": tags.luna_tags,
    "v5_tags": tags.v5_tags,
    "tags_exploded": tags.tags_exploded,
    "bot_tags_daily": tags.bot_tags_daily,
    # per-prompt daily KPIs
    "click_rate_daily": pm.click_rate_daily,
    "chat_start_daily": pm.chat_start_daily,
    "chat_rounds_daily": pm.chat_rounds_daily,
    # by workflow
    "workflow_click_rate": rollups.workflow_click_rate,
    "workflow_chat_start": rollups.workflow_chat_start,
    "workflow_chat_depth": rollups.workflow_chat_depth,
    "metrics_by_workflow": rollups.metrics_by_workflow,
    # by tag
    "tag_click_rate": rollups.tag_click_rate,
    "tag_chat_start": rollups.tag_chat_start,
    "tag_chat_depth": rollups.tag_chat_depth,
    "metrics_by_tag": rollups.metrics_by_tag,
    # comparisons
    "click_compare": compare.click_compare,
    "chat_start_compare": compare.chat_start_compare,
    "chat_depth_compare": compare.chat_depth_compare,
    "chat_depth_by_tag": compare.chat_depth_by_tag,
    "click_total_compare": compare.click_total_compare,
    "chat_start_total_compare": compare.chat_start_total_compare,
    "chat_depth_total_compare": compare.chat_depth_total_compare,
}
