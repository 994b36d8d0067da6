"""Physical-plan properties that matter at scale."""

from __future__ import annotations

import contextlib
import io
import re

import pytest

import __spark_entry__ as entry
from botpulse.plans.jobs import JOBS

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def plans(spark):
    return {name: plan(entry.queries()[name](spark, SF)) for name in JOBS}


def test_no_cartesian_or_nested_loop_or_python(plans):
    for name, text in plans.items():
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
                    "FlatMapGroupsInPandas", "MapInPandas"):
            assert bad not in text, f"{name}: {bad}"


def test_event_scans_prune_columns_and_push_filters(plans):
    text = plans["chat_start_daily"]
    scans = [blk for blk in text.split("\n\n") if "events.parquet" in blk]
    assert scans
    for blk in scans:
        assert "PushedFilters" in blk and ("EqualTo(event_type" in blk or "In(event_type" in blk)
        assert "value:" not in blk  # unused column not read


def test_tag_explosion_needs_no_window(plans):
    assert "Window" not in plans["bot_tags_daily"]


def test_semi_join_below_the_distinct_event_ids(plans):
    """Events of bots outside the dimension never reach the shuffle of the distinct count."""
    for name in ("click_rate_daily", "tag_click_rate", "click_compare", "click_total_compare", "metrics_by_tag"):
        tree = plans[name].split("\n\n")[0].splitlines()
        semi = [i for i, line in enumerate(tree) if "LeftSemi" in line]
        assert len(semi) >= 2, name
        # the distinct count's exchange, keyed by the event id too, lies above the semi-join
        text = plans[name]
        assert re.search(r"hashpartitioning\(event_date#\d+, \w+#\d+, event_id#\d+L?, \d+\)", text), name
        for i in semi:
            assert any("Exchange" in line for line in tree[:i]), name


def test_stacked_reports_read_each_event_table_once(plans):
    scans = {name: plans[name].split("\n\n")[0].count("Scan parquet") for name in ("metrics_by_workflow", "metrics_by_tag")}
    events = {name: sum("events.parquet" in part and "ReadSchema" in part for part in plans[name].split("\n\n")) for name in scans}
    assert events["metrics_by_workflow"] == 3
    assert events["metrics_by_tag"] <= 5  # M1's distinct event ids read views and shows once more


def test_daily_tables_explode_days_after_the_join(plans):
    for name in ("click_rate_daily", "chat_start_daily", "chat_rounds_daily"):
        tree = plans[name].split("\n\n")[0]
        assert tree.index("Generate") < tree.index("Join"), name  # the plan's root comes first


def test_distinct_counts_shuffle_on_distinct_keys(plans):
    # COUNT(DISTINCT event_id) per (day, bot): first exchange keyed by the distinct column too,
    # so a hot bot is spread over tasks before the per-bot count.
    text = plans["click_rate_daily"]
    assert re.search(r"hashpartitioning\(event_date#\d+, \w+#\d+, event_id#\d+L?, \d+\)", text)


def test_day_filter_prunes_event_partitions(spark, tmp_path):
    from helpers import D1, D2, make_tables

    from botpulse.functions.dates import DayRange
    from botpulse.operators.prompt_metrics import chat_start_daily
    from botpulse.sources import schemas
    from botpulse.sources.catalog import Tables

    t = make_tables(spark, shows=[(D1, 1, "p1", 1), (D2, 2, "p1", 1)], views=[(D1, 3, "p1", 1), (D2, 4, "p1", 2)],
                    chats=[(D2, 5, "p1", 2, None)], v5=[("p1", "wf", "a")])
    for name in schemas.INPUTS:
        df = getattr(t, name)
        writer = df.write.partitionBy("event_date") if "event_date" in df.columns else df.write
        writer.parquet(str(tmp_path / name))
    stored = Tables.from_parquet(spark, str(tmp_path)).with_(aigc_tag_v5=t.aigc_tag_v5)
    df = chat_start_daily(stored, DayRange.of(D2))
    text = plan(df)
    scans = [blk for blk in text.split("\n\n") if "Scan parquet" in blk and ("bot_view" in blk or "chat_send" in blk)]
    assert scans and all("PartitionFilters: [isnotnull(event_date" in blk and "2024-01-02" in blk for blk in scans)
    assert [tuple(r) for r in df.select("click_user_cnt", "chat_user_cnt").collect()] == [(1, 1)]
