"""One hand-made case per semantic rule (fan-out, NULL vs 0, date spine, join
fan-out of views x chats, regenerate filter, tag explosion, prefix strip,
LIKE, the three "all bots" meanings, rounding, the seed CSV)."""

from __future__ import annotations

import datetime as dt

import pytest
from helpers import CREATED, D1, D2, make_tables, rows
from pyspark.sql import functions as F

from botpulse.functions.dates import DayRange
from botpulse.functions.metrics import ratio
from botpulse.operators import compare, rollups, tags
from botpulse.operators import prompt_metrics as pm
from botpulse.sources.seed import seed_tags

DAY1 = DayRange.of(D1)
DAYS12 = DayRange(D1, D2)


# ---- K: dimension fan-out ------------------------------------------------------------
def test_fanout_two_tags_one_prompt(spark):
    t = make_tables(
        spark,
        v5=[("p1", "wf", "a"), ("p1", "wf", "b")],
        chats=[(D1, 1, "p1", 1, None), (D1, 2, "p1", 1, None), (D1, 3, "p1", 2, None)],
        views=[(D1, 10, "p1", 1)],
        shows=[(D1, 20, "p1", 1), (D1, 21, "p1", 2)],
    )
    w1 = rows(rollups.workflow_click_rate(t, DAY1), "total_events", "total_users", "prompt_count", "metric_value")
    assert w1 == [(2, 4, 1, 0.5)]  # 1 viewer, 2 card viewers, doubled by the two tag rows
    w2 = rows(rollups.workflow_chat_start(t, DAY1), "total_events", "total_users", "metric_value")
    assert w2 == [(4, 4, 1.0)]  # 1 view x 2 chats = 2 joined rows, doubled
    w3 = rows(rollups.workflow_chat_depth(t, DAY1), "total_events", "total_users", "metric_value")
    assert w3 == [(3, 2, 1.5)]  # distinct (bot, workflow): no doubling
    c3 = rows(compare.chat_depth_compare(t, DAY1), "bot_type", "workflow", "total_msgs", "user_count")
    assert c3 == [("AIGC", "wf", 3, 2)]
    a3 = rows(compare.chat_depth_total_compare(t, DAY1), "bot_type", "total_msgs", "user_count", "chat_depth_user")
    assert a3 == [("AIGC", 6, 2, 3.0)]


def test_duplicate_dimension_rows_multiply_messages_not_users(spark):
    t = make_tables(
        spark,
        v5=[("p1", "wf", "a"), ("p1", "wf", "a")],
        chats=[(D1, 1, "p1", 1, None), (D1, 2, "p1", 1, None), (D1, 3, "p1", 2, None)],
    )
    m3 = rows(pm.chat_rounds_daily(t, DAY1), "prompt_id", "total_chat_events", "unique_users",
              "avg_chat_rounds_per_user")
    assert m3 == [("p1", 6, 2, 3.0)]
    # M1/M2 make the dimension distinct: one row per (day, prompt, workflow, tag)
    assert pm.click_rate_daily(t, DAY1).count() == 1
    assert pm.chat_start_daily(t, DAY1).count() == 1


# ---- N: NULL vs 0 ----------------------------------------------------------------------
def test_prompt_without_events(spark):
    t = make_tables(spark, v5=[("p2", "w2", "x")], chats=[(D1, 1, "p9", 1, None)])
    assert rows(pm.click_rate_daily(t, DAY1), "click_event_cnt", "show_event_cnt", "click_rate") == [(0, 0, None)]
    assert rows(pm.chat_start_daily(t, DAY1), "click_user_cnt", "chat_user_cnt", "chat_start_rate") == [(0, 0, 0.0)]
    assert rows(pm.chat_rounds_daily(t, DAY1), "total_chat_events", "unique_users",
                "avg_chat_rounds_per_user") == [(0, 0, None)]
    for job in rollups.WORKFLOW_METRICS.values():
        assert rows(job(t, DAY1), "total_events", "total_users", "prompt_count", "metric_value") == [(0, 0, 1, None)]


# ---- S: date spine ---------------------------------------------------------------------
def test_days_without_events(spark):
    t = make_tables(
        spark,
        v5=[("p1", "wf", "a")],
        shows=[(D1, 1, "p1", 1)],
        views=[(D1, 2, "p1", 1)],
        chats=[(D1, 3, "p1", 1, "send")],
        evc=[(D1, "view_bot", 0, 5), (D1, "show_prompt_card", 0, 10), (D2, "purchase", 0, 3)],
        links=[("p1", "v5a")],
        tags=[("v5a", "V5 a", 1, CREATED)],
    )
    for job in (pm.click_rate_daily, pm.chat_start_daily, pm.chat_rounds_daily):
        assert rows(job(t, DAYS12), "event_date") == [(D1,), (D2,)]
    for job in rollups.WORKFLOW_METRICS.values():
        assert rows(job(t, DAYS12), "event_date") == [(D1,), (D2,)]

    c1 = rows(compare.click_compare(t, DAYS12), "event_date", "bot_type", "total_clicks", "total_shows", "click_rate")
    assert (D2, "AllBots", None, None, None) in c1  # no view/show rows that day: NULL sums
    assert (D1, "AllBots", 5, 10, 0.5) in c1
    a1 = rows(compare.click_total_compare(t, DAYS12), "event_date", "bot_type", "total_clicks", "total_shows",
              "click_rate")
    assert (D2, "AIGC", 0, 0, None) in a1 and (D2, "AllBots", None, None, None) in a1
    c2 = rows(compare.chat_start_compare(t, DAYS12), "event_date", "bot_type", "total_click_users",
              "total_chat_users", "chat_start_rate")
    assert (D2, "AllBots", 0, 0, None) in c2 and (D1, "AllBots", 1, 1, 1.0) in c2
    a2 = rows(compare.chat_start_total_compare(t, DAYS12), "event_date", "bot_type", "click_user_cnt",
              "chat_user_cnt", "chat_start_rate")
    assert (D2, "AllBots", 0, 0, None) in a2 and (D2, "AIGC", 0, 0, None) in a2
    for job in (compare.chat_depth_compare, compare.chat_depth_total_compare, compare.chat_depth_by_tag,
                tags.bot_tags_daily):
        assert {r[0] for r in rows(job(t, DAYS12), "event_date")} == {D1}


def test_global_aigc_branch_is_null_without_rows(spark):
    t = make_tables(spark, v5=[("p1", "wf", "a")])
    m1_day1_only = pm.click_rate_daily(t, DAY1)
    a1 = rows(compare.click_total_compare(t, DAYS12, click_rate=m1_day1_only),
              "event_date", "bot_type", "total_clicks", "total_shows", "click_rate")
    assert (D1, "AIGC", 0, 0, None) in a1 and (D2, "AIGC", None, None, None) in a1


# ---- F: views x chats fan-out ------------------------------------------------------------
def test_chat_start_counts_joined_rows(spark):
    t = make_tables(
        spark,
        v5=[("p1", "wf", "a")],
        views=[(D1, 1, "p1", 1), (D1, 2, "p1", 1), (D1, 3, "p1", 2)],
        chats=[(D1, 4, "p1", 1, None), (D1, 5, "p1", 1, None), (D1, 6, "p1", 1, None)],
    )
    assert rows(pm.chat_start_daily(t, DAY1), "click_user_cnt", "chat_user_cnt", "chat_start_rate") == [
        (7, 6, 0.8571)]


def test_null_user_views_never_match(spark):
    t = make_tables(
        spark,
        v5=[("p1", "wf", "a")],
        views=[(D1, 1, "p1", None), (D1, 2, "p1", None)],
        chats=[(D1, 4, "p1", None, None)],
    )
    assert rows(pm.chat_start_daily(t, DAY1), "click_user_cnt", "chat_user_cnt") == [(2, 0)]


# ---- M: regenerate -----------------------------------------------------------------------
def test_regenerate_only_excluded_by_depth_by_tag(spark):
    t = make_tables(
        spark,
        v5=[("p1", "wf", "a")],
        shows=[(D1, 9, "p1", 1)],
        chats=[(D1, 1, "p1", 1, None), (D1, 2, "p1", 2, "send"), (D1, 3, "p1", 3, "regenerate")],
        links=[("p1", "v5a")],
        tags=[("v5a", "V5 a", 1, CREATED)],
    )
    c5 = rows(compare.chat_depth_by_tag(t, DAY1), "tag", "bot_type", "total_chat_events", "total_chat_user_count",
              "chat_depth_user")
    assert c5 == [("V5 a", "AIGC", 2, 2, 1.0)]
    assert rows(pm.chat_rounds_daily(t, DAY1), "total_chat_events") == [(3,)]


def test_depth_by_tag_fans_out_over_raw_dimension(spark):
    t = make_tables(
        spark,
        v5=[("p1", "wf", "a"), ("p1", "wf", "b")],
        shows=[(D1, 9, "p1", 1), (D1, 10, "p2", 1)],
        chats=[(D1, 1, "p1", 1, None), (D1, 2, "p2", 2, None)],
        links=[("p1", "v5a"), ("p2", "v5a")],
        tags=[("v5a", "V5 a", 1, CREATED)],
    )
    c5 = rows(compare.chat_depth_by_tag(t, DAY1), "tag", "bot_type", "total_chat_events", "total_chat_user_count")
    assert c5 == [("V5 a", "AIGC", 2, 2), ("V5 a", "AllBots", 1, 1)]


# ---- E: tag explosion ---------------------------------------------------------------------
def _shown_with_names(spark, names):
    return make_tables(
        spark,
        shows=[(D1, 1, "p1", 1)],
        links=[("p1", f"t{i}") for i in range(len(names))],
        tags=[(f"t{i}", n, 1, CREATED) for i, n in enumerate(names)],
    )


def test_explode_commas_blanks_prefix_kept(spark):
    t = _shown_with_names(spark, ["V5 a, b", "V5 c", " "])
    assert rows(tags.bot_tags_daily(t, DAY1), "tag") == [("V5 a",), ("V5 c",), ("b",)]


def test_explode_keeps_all_pieces_unless_limited(spark):
    t = _shown_with_names(spark, [f"n{i:02d}" for i in range(25)])
    everything = tags.bot_tags_daily(t, DAY1)
    assert rows(everything, "tag") == [(f"n{i:02d}",) for i in range(25)]
    assert "Window" not in everything._jdf.queryExecution().executedPlan().toString()
    assert rows(tags.bot_tags_daily(t, DAY1, limit=20), "tag") == [(f"n{i:02d}",) for i in range(20)]
    # a limit counts pieces, not names
    t = _shown_with_names(spark, [f"{c}1,{c}2,{c}3" for c in "abcdefghij"])
    got = [r[0] for r in rows(tags.bot_tags_daily(t, DAY1, limit=20), "tag")]
    assert len(got) == 20 and "g2" in got and "g3" not in got and "h1" not in got


def test_explode_keeps_duplicates_and_skips_null_names(spark):
    t = _shown_with_names(spark, ["V5 a", "V5 a", None])
    assert rows(tags.bot_tags_daily(t, DAY1), "tag") == [("V5 a",), ("V5 a",)]


def test_explode_only_for_shown_bots_per_day(spark):
    t = make_tables(
        spark,
        shows=[(D1, 1, "p1", 1), (D2, 2, "p1", 1), (D2, 3, "p1", 2)],
        links=[("p1", "t0"), ("p2", "t0")],
        tags=[("t0", "V5 a", 1, CREATED)],
    )
    assert rows(tags.bot_tags_daily(t, DAYS12)) == [(D1, "p1", "V5 a"), (D2, "p1", "V5 a")]


# ---- X, L: V5 enrichment ---------------------------------------------------------------------
def test_v5_prefix_strip_and_case_sensitive_paths(spark):
    t = make_tables(
        spark,
        paths=[(1, "a/V5/b"), (2, "a/v5/b"), (3, "Bots/Luna/wf")],
        links=[("p1", "w"), ("p1", "keep"), ("p1", "skip")],
        tags=[("w", "flow", 3, CREATED), ("keep", "V5   cool tag ", 1, CREATED), ("skip", "V5 lower", 2, CREATED)],
    )
    assert rows(tags.luna_tags(t, DAY1)) == [("p1", "flow", D1)]
    assert rows(tags.v5_tags(t, DAY1)) == [("p1", "flow", "cool tag")]


def test_v5_pairs_seen_on_two_days_appear_twice(spark):
    t = make_tables(
        spark,
        aigc=[("p1", "wf", D1), ("p1", "wf", D1), ("p1", "wf", D2)],
        links=[("p1", "t")],
        tags=[("t", "V5 x", 1, CREATED)],
    )
    assert rows(tags.v5_tags(t, DAYS12)) == [("p1", "wf", "x"), ("p1", "wf", "x")]
    assert rows(tags.tags_exploded(t, DAYS12)) == [("p1", "x")]


def test_luna_tags_by_creation_day(spark):
    t = make_tables(
        spark,
        links=[("p1", "a"), ("p2", "a"), ("p1", "b")],
        tags=[("a", "wfA", 2, dt.datetime(2024, 1, 1, 23, 59)), ("b", "wfB", 2, dt.datetime(2024, 1, 3, 0, 1))],
    )
    assert rows(tags.luna_tags(t, DAYS12)) == [("p1", "wfA", D1), ("p2", "wfA", D1)]


# ---- U: the three "all bots" ---------------------------------------------------------------------
def test_all_bots_meanings(spark):
    t = make_tables(
        spark,
        v5=[("p1", "wf", "a")],
        views=[(D1, 1, "p1", 1)],
        chats=[(D1, 2, "p9", 1, None)],
    )
    c2 = rows(compare.chat_start_compare(t, DAY1), "workflow", "bot_type", "total_click_users", "total_chat_users",
              "chat_start_rate")
    assert ("ALL", "AllBots", 1, 1, 1.0) in c2
    assert ("wf", "AIGC", 1, 0, 0.0) in c2
    c3 = rows(compare.chat_depth_compare(t, DAY1), "bot_type", "workflow", "total_msgs")
    assert c3 == [("AllBots", None, 1)]
    assert rows(pm.chat_start_daily(t, DAY1), "click_user_cnt", "chat_user_cnt") == [(1, 0)]


def test_click_compare_skips_blank_and_null_workflows(spark):
    t = make_tables(spark, v5=[("p1", "", "a"), ("p2", None, "a"), ("p3", "wf", "a")],
                    shows=[(D1, 1, "p1", 1), (D1, 2, "p3", 1)], views=[(D1, 3, "p3", 1)])
    c1 = rows(compare.click_compare(t, DAY1), "workflow", "bot_type", "total_clicks", "total_shows")
    assert c1 == [("ALL", "AllBots", None, None), ("wf", "AIGC", 1, 1)]
    # A2 keeps every workflow, A1 only named ones
    a1 = rows(compare.click_total_compare(t, DAY1), "bot_type", "total_clicks", "total_shows")
    assert ("AIGC", 1, 1) in a1


def test_null_workflow_is_its_own_group(spark):
    t = make_tables(spark, v5=[("p1", None, "a"), ("p2", "wf", "a")], views=[(D1, 1, "p1", 7)],
                    shows=[(D1, 2, "p1", 7)])
    w1 = rows(rollups.workflow_click_rate(t, DAY1), "workflow", "total_events", "total_users", "prompt_count")
    assert w1 == [("wf", 0, 0, 1), (None, 1, 1, 1)]


# ---- R: rounding ------------------------------------------------------------------------------
def test_half_up_rounding(spark):
    got = spark.range(1).select(
        ratio(F.lit(23), F.lit(40), 2).alias("a"),
        ratio(F.lit(1), F.lit(8), 2).alias("b"),
        ratio(F.lit(2), F.lit(3), 4).alias("c"),
        ratio(F.lit(1), F.lit(0), 4).alias("d"),
        ratio(F.lit(1), F.lit(None).cast("long"), 4).alias("e"),
    ).first()
    assert tuple(got) == (0.58, 0.13, 0.6667, None, None)


# ---- D1: seed CSV -------------------------------------------------------------------------------
def test_seed_csv(spark, tmp_path):
    path = tmp_path / "seed.csv"
    path.write_bytes("id,workflow\r\n#NAME?,wfA\r\n,wfB\r\np3,\r\np4,NA\r\np5,工作流\r\n".encode())
    got = rows(seed_tags(spark, str(path), "2025-05-10"))
    assert got == [("#NAME?", "wfA", dt.date(2025, 5, 10)), ("p5", "工作流", dt.date(2025, 5, 10))]


def test_seed_csv_quotes_and_line_breaks(spark, tmp_path):
    import pandas as pd

    path = tmp_path / "seed.csv"
    path.write_bytes(b'id,workflow\r\np1,"a ""q"" b"\r\np2,"x\ny"\r\np3,"u,v"\r\n"p,4",w\r\n')
    got = rows(seed_tags(spark, str(path), "2025-05-10"), "prompt_id", "tag")
    assert got == sorted(pd.read_csv(path).itertuples(index=False, name=None))
    assert ("p1", 'a "q" b') in got and ("p2", "x\ny") in got


def test_seed_records_survive_the_round_trip(spark):
    from botpulse.sources.seed import clean_seed, through_csv

    pairs = [("p1", 'a "q" b'), ("p2", "x,y"), ("p3", "工作流"), ("p4", ""), ("p5", None), ("p6", "NA")]
    got = rows(clean_seed(through_csv(spark.createDataFrame(pairs, "prompt_id string, tag string")), "2025-05-10"),
               "prompt_id", "tag")
    assert got == [("p1", 'a "q" b'), ("p2", "x,y"), ("p3", "工作流")]


# ---- P2, W4, T4: arguments ------------------------------------------------------------------------
def test_day_range_rules():
    assert DayRange.of("2024-01-03").n_days == 1
    assert DayRange("2024-01-01", "2024-01-30").n_days == 30
    with pytest.raises(ValueError):
        DayRange("2024-01-02", "2024-01-01")
    with pytest.raises(ValueError):
        DayRange.of("2024-13-01")
    assert DayRange.yesterday(dt.date(2024, 3, 1)) == DayRange.of("2024-02-29")


def test_unknown_metric_type(spark):
    t = make_tables(spark, v5=[("p1", "wf", "a")])
    with pytest.raises(ValueError):
        rollups.metrics_by_workflow(t, DAY1, ["click_rate", "bounce_rate"])
    with pytest.raises(ValueError):
        rollups.metrics_by_tag(t, DAY1, "bounce_rate")
    one = rollups.metrics_by_workflow(t, DAY1, "chat_depth_user")
    assert rows(one, "metric_type") == [("chat_depth_user",)]


# ---- sources ---------------------------------------------------------------------------------------
def test_mirror_columns_renamed(spark):
    from botpulse.sources.catalog import normalize_mirror_columns

    from pyspark.sql import types as T

    schema = T.StructType([T.StructField('"PromptId"', T.StringType()), T.StructField('"PromptTagId"', T.StringType()),
                           T.StructField('"pathId"', T.IntegerType())])
    df = spark.createDataFrame([("p", "t", 1)], schema)
    assert normalize_mirror_columns(df).columns == ["prompt_id", "tag_id", "path_id"]


def test_from_parquet_and_catalog(spark, tmp_path):
    from helpers import make_tables

    from botpulse.sources import schemas
    from botpulse.sources.catalog import Tables

    t = make_tables(spark, shows=[(D1, 1, "p1", 1)], v5=[("p1", "wf", "a")])
    for name in schemas.INPUTS:
        getattr(t, name).write.parquet(str(tmp_path / name))
    back = Tables.from_parquet(spark, str(tmp_path))
    assert rows(back.show_prompt_card) == [(D1, 1, "p1", 1)]
    for name in schemas.INPUTS:
        getattr(t, name).createOrReplaceTempView(f"v_{name}")
    cat = Tables.from_catalog(spark, **{name: f"v_{name}" for name in schemas.INPUTS})
    assert rows(cat.show_prompt_card) == [(D1, 1, "p1", 1)]


def test_aigc_totals_null_without_named_workflows(spark):
    t = make_tables(spark, v5=[("p1", "", "a")], shows=[(D1, 1, "p1", 1)], views=[(D1, 2, "p1", 1)])
    a1 = rows(compare.click_total_compare(t, DAY1), "bot_type", "total_clicks", "total_shows", "click_rate")
    assert ("AIGC", None, None, None) in a1
    a2 = rows(compare.chat_start_total_compare(t, DAY1), "bot_type", "click_user_cnt", "chat_user_cnt")
    assert ("AIGC", 1, 0) in a2  # A2 keeps blank workflows
    assert rows(compare.click_compare(t, DAY1), "bot_type") == [("AllBots",)]


def test_cluster_conf():
    from botpulse.session import cluster_conf

    conf = cluster_conf(4000)
    assert conf["spark.sql.shuffle.partitions"] == "12000"
    assert conf["spark.sql.adaptive.enabled"] == "true"
    assert conf["spark.sql.sources.partitionOverwriteMode"] == "dynamic"


# ---- P4: empty inputs ----------------------------------------------------------------------------------
@pytest.mark.parametrize("dim", [[("p1", "wf", "a")], []], ids=["no-events", "nothing"])
def test_every_job_on_empty_inputs(spark, dim):
    from botpulse.plans.jobs import JOBS

    t = make_tables(spark, v5=dim)
    counts = {name: job(t, DAYS12).count() for name, job in JOBS.items()}
    per_dim_day = 2 * len(dim)
    assert counts["click_rate_daily"] == counts["chat_start_daily"] == counts["chat_rounds_daily"] == per_dim_day
    assert counts["metrics_by_workflow"] == counts["metrics_by_tag"] == 3 * per_dim_day
    assert counts["click_total_compare"] == counts["chat_start_total_compare"] == 4  # AIGC + AllBots per day
    assert counts["click_compare"] == counts["chat_start_compare"] == 2 + per_dim_day
    for name in ("chat_depth_compare", "chat_depth_total_compare", "chat_depth_by_tag", "bot_tags_daily",
                 "luna_tags", "seed_tags"):
        assert counts[name] == 0, name


def test_from_parquet_accepts_local_timestamps(spark, tmp_path):
    from helpers import make_tables

    from botpulse.sources import schemas
    from botpulse.sources.catalog import Tables

    t = make_tables(spark, links=[("p1", "a")], tags=[("a", "wf", 2, CREATED)])
    for name in schemas.INPUTS:
        df = getattr(t, name)
        if name == "prompt_tag":  # stored as TIMESTAMP (with time zone semantics), not TIMESTAMP_NTZ
            df = df.withColumn("created_at", F.col("created_at").cast("timestamp"))
        df.write.parquet(str(tmp_path / name))
    back = Tables.from_parquet(spark, str(tmp_path))
    assert dict(back.prompt_tag.dtypes)["created_at"] == "timestamp_ntz"
    assert rows(tags.luna_tags(back, DAY1)) == [("p1", "wf", D1)]


def test_inputs_as_delivered(spark, tmp_path):
    """Text ids stay text, and a text day is filtered in the scan."""
    import contextlib
    import io

    from helpers import make_tables

    from botpulse.sources import schemas
    from botpulse.sources.catalog import Tables

    t = make_tables(spark, shows=[(D1, 1, "p1", 1), (D2, 2, "p1", 1)], views=[(D1, 3, "p1", 1)], v5=[("p1", "wf", "a")],
                    chats=[(D1, 4, "p1", 1, None)])
    for name in schemas.INPUTS:
        df = getattr(t, name)
        for c in ("event_id", "user_id"):
            if c in df.columns:
                df = df.withColumn(c, F.concat(F.lit("u"), F.col(c).cast("string")))
        if "event_date" in df.columns:
            df = df.withColumn("event_date", F.col("event_date").cast("string"))
        df.write.parquet(str(tmp_path / name))
    back = Tables.from_parquet(spark, str(tmp_path)).with_(aigc_tag_v5=t.aigc_tag_v5)
    m1 = pm.click_rate_daily(back, DAY1)
    assert rows(m1, "event_date", "prompt_id", "click_event_cnt", "show_event_cnt") == [(D1, "p1", 1, 1)]
    assert rows(pm.chat_start_daily(back, DAY1), "click_user_cnt", "chat_user_cnt") == [(1, 1)]
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        m1.explain(mode="formatted")
    assert "GreaterThanOrEqual(event_date,2024-01-01)" in text.getvalue()


def test_dimension_is_derived_from_all_days_so_far(spark):
    t = make_tables(spark, shows=[(D2, 1, "p1", 1)], links=[("p1", "w"), ("p1", "v")],
                    tags=[("w", "flow", 2, CREATED), ("v", "V5 x", 1, CREATED)])
    assert rows(pm.click_rate_daily(t, DayRange.of(D2)), "prompt_id", "show_event_cnt") == [("p1", 1)]
