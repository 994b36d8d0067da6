"""Explicit schemas of the logical input and output tables (written by name)."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, D, DBL, I = T.StringType(), T.LongType(), T.DateType(), T.DoubleType(), T.IntegerType()


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# ---- inputs -----------------------------------------------------------------
SHOW_PROMPT_CARD = _schema(("event_date", D), ("event_id", L), ("prompt_id", S), ("user_id", L))
BOT_VIEW = _schema(("event_date", D), ("event_id", L), ("bot_id", S), ("user_id", L))
CHAT_SEND = _schema(("event_date", D), ("event_id", L), ("prompt_id", S), ("user_id", L), ("method", S))
EVENT_VERSION_COUNT = _schema(("event_date", D), ("event_name", S), ("version", I), ("events", L))
PROMPT_TAG_LINK = _schema(("prompt_id", S), ("tag_id", S))
PROMPT_TAG = _schema(("id", S), ("name", S), ("path_id", I), ("created_at", T.TimestampNTZType()))
PROMPT_TAG_PATH = _schema(("id", I), ("path", S))
SEED_CSV = _schema(("id", S), ("workflow", S))

# Columns that are only compared and counted: kept in the type they are delivered in.
IDS = frozenset({"event_id", "user_id", "prompt_id", "bot_id", "tag_id", "id", "path_id"})

INPUTS = {
    "show_prompt_card": SHOW_PROMPT_CARD,
    "bot_view": BOT_VIEW,
    "chat_send": CHAT_SEND,
    "event_version_count": EVENT_VERSION_COUNT,
    "prompt_tag_link": PROMPT_TAG_LINK,
    "prompt_tag": PROMPT_TAG,
    "prompt_tag_path": PROMPT_TAG_PATH,
}

# ---- derived tables -----------------------------------------------------------
AIGC_TAG = _schema(("prompt_id", S), ("tag", S), ("event_date", D))
AIGC_TAG_V5 = _schema(("prompt_id", S), ("workflow", S), ("tags", S))
BOT_V5 = _schema(("prompt_id", S), ("tags", S))
TAGS_EXPLODED = _schema(("prompt_id", S), ("tag", S))
BOT_TAGS_DAILY = _schema(("event_date", D), ("prompt_id", S), ("tag", S))

CLICK_RATE_DAILY = _schema(
    ("event_date", D), ("prompt_id", S), ("workflow", S), ("tags", S),
    ("click_event_cnt", L), ("show_event_cnt", L), ("click_rate", DBL))
CHAT_START_DAILY = _schema(
    ("event_date", D), ("prompt_id", S), ("workflow", S), ("tags", S),
    ("click_user_cnt", L), ("chat_user_cnt", L), ("chat_start_rate", DBL))
CHAT_ROUNDS_DAILY = _schema(
    ("event_date", D), ("prompt_id", S), ("workflow", S), ("tags", S),
    ("total_chat_events", L), ("unique_users", L), ("avg_chat_rounds_per_user", DBL))
METRICS_BY_WORKFLOW = _schema(
    ("event_date", D), ("metric_type", S), ("workflow", S),
    ("total_events", L), ("total_users", L), ("prompt_count", L), ("metric_value", DBL))
METRICS_BY_TAG = _schema(
    ("event_date", D), ("metric_type", S), ("tag", S),
    ("total_events", L), ("total_users", L), ("prompt_count", L), ("metric_value", DBL))
CLICK_COMPARE = _schema(
    ("event_date", D), ("workflow", S), ("bot_type", S),
    ("total_clicks", L), ("total_shows", L), ("click_rate", DBL))
CHAT_START_COMPARE = _schema(
    ("event_date", D), ("workflow", S), ("bot_type", S),
    ("total_click_users", L), ("total_chat_users", L), ("chat_start_rate", DBL))
CHAT_DEPTH_COMPARE = _schema(
    ("event_date", D), ("bot_type", S), ("workflow", S),
    ("total_msgs", L), ("user_count", L), ("chat_depth_user", DBL))
CHAT_DEPTH_BY_TAG = _schema(
    ("event_date", D), ("tag", S), ("bot_type", S),
    ("total_chat_events", L), ("total_chat_user_count", L), ("chat_depth_user", DBL))
CLICK_TOTAL_COMPARE = _schema(
    ("event_date", D), ("bot_type", S), ("total_clicks", L), ("total_shows", L), ("click_rate", DBL))
CHAT_START_TOTAL_COMPARE = _schema(
    ("event_date", D), ("workflow", S), ("bot_type", S),
    ("click_user_cnt", L), ("chat_user_cnt", L), ("chat_start_rate", DBL))
CHAT_DEPTH_TOTAL_COMPARE = _schema(
    ("event_date", D), ("bot_type", S), ("total_msgs", L), ("user_count", L), ("chat_depth_user", DBL))

CHAT_USER_BOT_DAILY = _schema(
    ("event_date", D), ("user_id", L), ("prompt_id", S), ("n_msgs", L), ("n_events", L), ("n_kept", L))
VIEW_USER_BOT_DAILY = _schema(("event_date", D), ("user_id", L), ("prompt_id", S), ("n_views", L))
SHOW_USER_BOT_DAILY = _schema(("event_date", D), ("user_id", L), ("prompt_id", S), ("n_shows", L))

OUTPUTS = {
    "chat_user_bot_daily": CHAT_USER_BOT_DAILY,
    "view_user_bot_daily": VIEW_USER_BOT_DAILY,
    "show_user_bot_daily": SHOW_USER_BOT_DAILY,
    "aigc_tag": AIGC_TAG,
    "aigc_tag_seed": AIGC_TAG,
    "aigc_tag_v5": AIGC_TAG_V5,
    "tags_exploded": TAGS_EXPLODED,
    "bot_tags_daily": BOT_TAGS_DAILY,
    "click_rate_daily": CLICK_RATE_DAILY,
    "chat_start_daily": CHAT_START_DAILY,
    "chat_rounds_daily": CHAT_ROUNDS_DAILY,
    "metrics_by_workflow": METRICS_BY_WORKFLOW,
    "metrics_by_tag": METRICS_BY_TAG,
    "click_compare": CLICK_COMPARE,
    "chat_start_compare": CHAT_START_COMPARE,
    "chat_depth_compare": CHAT_DEPTH_COMPARE,
    "chat_depth_by_tag": CHAT_DEPTH_BY_TAG,
    "click_total_compare": CLICK_TOTAL_COMPARE,
    "chat_start_total_compare": CHAT_START_TOTAL_COMPARE,
    "chat_depth_total_compare": CHAT_DEPTH_TOTAL_COMPARE,
}
