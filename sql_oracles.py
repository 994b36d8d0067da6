"""DuckDB oracle SQL for every registered query.

Each statement carries the test-data mapping of ``botpulse.sources.fixtures``
as leading CTEs (only the base tables are registered in the oracle) and runs
over every day present in ``events``. The bodies are derived from the metric
rules: all events in one tidy relation, every count per (day, bot) from it, and the
dimension as rows with multiplicities. The Spark jobs use other plans, so
agreement checks them.

Rounding: DuckDB's ``round(double)`` is not exact HALF_UP on ties, so ratios
are rounded with integer arithmetic, see :func:`rnd`. Sums are cast to
BIGINT (DuckDB sums BIGINT into HUGEINT).
"""

from __future__ import annotations

from botpulse.sources.seed import PANDAS_NA_TOKENS

FIXTURE = r"""
ev AS (
  SELECT CAST(ts AS DATE) AS event_date, event_id, user_id, event_type,
         'p' || CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) AS VARCHAR) AS prompt_id
  FROM events),
show_prompt_card AS (SELECT event_date, event_id, prompt_id, user_id FROM ev WHERE event_type = 'view'),
bot_view AS (SELECT event_date, event_id, prompt_id AS bot_id, user_id FROM ev WHERE event_type = 'click'),
chat_send AS (
  SELECT event_date, event_id, prompt_id, user_id,
         CASE event_type WHEN 'error' THEN 'regenerate' WHEN 'signup' THEN 'send' END AS method
  FROM ev WHERE event_type IN ('purchase', 'signup', 'error')),
event_version_count AS (
  SELECT event_date,
         CASE event_type WHEN 'click' THEN 'view_bot' WHEN 'view' THEN 'show_prompt_card' ELSE event_type END
           AS event_name,
         CAST(user_id % 3 AS INTEGER) AS version, COUNT(*) AS events
  FROM ev GROUP BY 1, 2, 3),
pp AS (
  SELECT 'p' || CAST(p_partkey AS VARCHAR) AS prompt_id, p_type, p_size, p_brand, p_retailprice,
         regexp_extract(p_name, '^[a-z]+', 0) AS style, regexp_extract(p_name, '[a-z]+$', 0) AS obj
  FROM part),
prompt_tag_path AS (
  SELECT * FROM (VALUES (1, 'Bots/V5/style'), (2, 'Bots/V5/object'), (3, 'Bots/Luna/workflow'),
                        (4, 'Bots/Legacy')) v(id, path)),
prompt_tag AS (
  SELECT DISTINCT 's:' || style AS id,
         CASE WHEN style = 'small' THEN 'V5 small, cozy' ELSE 'V5 ' || style END AS name,
         1 AS path_id, TIMESTAMP '2024-01-01 08:00:00' AS created_at FROM pp
  UNION ALL
  SELECT DISTINCT 'o:' || obj, 'V5   ' || obj || ' ', 2, TIMESTAMP '2024-01-01 08:00:00' FROM pp
  UNION ALL
  SELECT DISTINCT 'w:' || p_type, CASE WHEN p_type = 'SMALL' THEN '' ELSE lower(p_type) END, 3,
         CASE WHEN p_type IN ('PROMO', 'LARGE') THEN TIMESTAMP '2024-01-02 09:30:00'
              ELSE TIMESTAMP '2024-01-01 08:00:00' END FROM pp
  UNION ALL
  SELECT 'x:old', 'old', 4, TIMESTAMP '2024-01-01 08:00:00'),
prompt_tag_link AS (
  SELECT prompt_id, 's:' || style AS tag_id FROM pp
  UNION ALL SELECT prompt_id, 'o:' || obj FROM pp
  UNION ALL SELECT prompt_id, 'w:' || p_type FROM pp WHERE p_size <= 30
  UNION ALL SELECT prompt_id, 'w:PROMO' FROM pp
            WHERE p_brand IN ('Brand#1', 'Brand#2', 'Brand#3', 'Brand#4') AND p_type <> 'PROMO'
  UNION ALL SELECT prompt_id, 'x:old' FROM pp WHERE p_retailprice < 950),
bounds AS (SELECT min(event_date) AS lo, max(event_date) AS hi FROM ev),
spine AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS event_date FROM bounds),
bot_tag AS (
  SELECT prompt_id AS bot, name, path, CAST(created_at AS DATE) AS born
  FROM prompt_tag_link, prompt_tag, prompt_tag_path
  WHERE tag_id = prompt_tag.id AND path_id = prompt_tag_path.id),
aigc_tag AS (
  SELECT bot AS prompt_id, name AS tag, born AS event_date FROM bot_tag, bounds
  WHERE contains(path, 'Luna') AND born BETWEEN lo AND hi),
style AS (SELECT DISTINCT bot, trim(regexp_replace(name, '^V5\s+', '')) AS tags FROM bot_tag WHERE contains(path, 'V5')),
aigc_v5 AS (
  SELECT flow.prompt_id, flow.tag AS workflow, style.tags
  FROM (SELECT DISTINCT event_date, prompt_id, tag FROM aigc_tag) flow JOIN style ON style.bot = flow.prompt_id)"""


def rnd(num: str, den: str, decimals: int) -> str:
    """Exact HALF_UP ``ROUND(num / NULLIF(den, 0), decimals)`` for non-negative integers."""
    p = 10**decimals
    d = f"NULLIF({den}, 0)"
    return f"(CAST((2 * ({num}) * {p} + {d}) // (2 * {d}) AS DOUBLE) / {p})"


def with_fixture(*ctes: str, body: str) -> str:
    parts = [FIXTURE.strip()] + [c.strip() for c in ctes]
    return "WITH " + ",\n".join(parts) + "\n" + body.strip()


# One tidy relation of all app events, its counts per (day, bot), and the dimension as
# rows with multiplicities. Every report is arithmetic on these three.
FACTS = """touch AS (
  SELECT event_date, 'open' AS kind, bot_id AS bot, user_id, event_id, false AS redone FROM bot_view
  UNION ALL SELECT event_date, 'card', prompt_id, user_id, event_id, false FROM show_prompt_card
  UNION ALL SELECT event_date, 'chat', prompt_id, user_id, event_id, method IS NOT DISTINCT FROM 'regenerate'
  FROM chat_send),
counted AS (
  SELECT event_date, bot,
         COUNT(DISTINCT event_id) FILTER (kind = 'open') AS open_ids,
         COUNT(DISTINCT event_id) FILTER (kind = 'card') AS card_ids,
         COUNT(DISTINCT user_id) FILTER (kind = 'open') AS openers,
         COUNT(DISTINCT user_id) FILTER (kind = 'card') AS card_users,
         COUNT(*) FILTER (kind = 'chat') AS msgs,
         COUNT(event_id) FILTER (kind = 'chat') AS msg_ids,
         COUNT(DISTINCT user_id) FILTER (kind = 'chat') AS chatters,
         COUNT(*) FILTER (kind = 'chat' AND NOT redone) AS fresh_msgs,
         COUNT(DISTINCT user_id) FILTER (kind = 'chat' AND NOT redone) AS fresh_chatters
  FROM touch GROUP BY ALL),
meetings AS (
  SELECT event_date, bot, user_id, COUNT(*) FILTER (kind = 'open') AS opened, COUNT(*) FILTER (kind = 'chat') AS said
  FROM touch GROUP BY ALL),
paired AS (
  SELECT event_date, bot,
         CAST(SUM(opened * IF(user_id IS NULL, 1, greatest(said, 1))) AS BIGINT) AS pair_rows,
         CAST(SUM(IF(user_id IS NULL, 0, opened * said)) AS BIGINT) AS pair_hits
  FROM meetings GROUP BY ALL),
facts AS (SELECT * FROM counted JOIN paired USING (event_date, bot)),
member AS (SELECT prompt_id AS bot, workflow, tags, COUNT(*) AS copies FROM aigc_v5 GROUP BY ALL),
weight AS (SELECT bot, COUNT(*) AS kinds, CAST(SUM(copies) AS BIGINT) AS copies FROM member GROUP BY bot),
flow AS (SELECT bot, workflow, CAST(SUM(copies) AS BIGINT) AS copies, COUNT(*) AS kinds FROM member GROUP BY ALL),
daily AS (  -- every day with every fact, 0 where nothing happened
  SELECT day.event_date, w.bot,
         COALESCE(open_ids, 0) AS open_ids, COALESCE(card_ids, 0) AS card_ids, COALESCE(openers, 0) AS openers,
         COALESCE(card_users, 0) AS card_users, COALESCE(msg_ids, 0) AS msg_ids, COALESCE(chatters, 0) AS chatters,
         COALESCE(pair_rows, 0) AS pair_rows, COALESCE(pair_hits, 0) AS pair_hits
  FROM weight w JOIN spine day ON true LEFT JOIN facts f ON f.bot = w.bot AND f.event_date = day.event_date)"""


def long(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


def per_prompt(left: str, right: str, names: tuple[str, str, str], num: str, den: str, decimals: int,
               empty: str = "NULL") -> str:
    """One row per day and distinct dimension row; ``left`` and ``right`` are its two counts."""
    return f"""SELECT event_date, bot AS prompt_id, workflow, tags, {long(left)} AS {names[0]}, {long(right)} AS {names[1]},
       COALESCE({rnd(num, den, decimals)}, {empty}) AS {names[2]}
FROM daily JOIN member USING (bot)"""


PER_PROMPT = {
    "click_rate_daily": per_prompt("open_ids", "card_ids", ("click_event_cnt", "show_event_cnt", "click_rate"),
                                   "open_ids", "card_ids", 4),
    "chat_start_daily": per_prompt("pair_rows", "pair_hits", ("click_user_cnt", "chat_user_cnt", "chat_start_rate"),
                                   "pair_hits", "pair_rows", 4, "0"),
    "chat_rounds_daily": per_prompt("copies * msg_ids", "chatters",
                                    ("total_chat_events", "unique_users", "avg_chat_rounds_per_user"),
                                    "copies * msg_ids", "chatters", 2),
}


def rolled(source: str, key: str, metric: str, events: str, users: str, decimals: int) -> str:
    """A KPI summed over the bots of each ``key``; the value is events over users, or the other way for the start rate."""
    up, down = (users, events) if metric == "chat_start_rate" else (events, users)
    return f"""SELECT event_date, '{metric}' AS metric_type, {key}, {long(f'SUM({events})')} AS total_events,
       {long(f'SUM({users})')} AS total_users, COUNT(DISTINCT bot) AS prompt_count,
       {rnd(f'SUM({up})', f'SUM({down})', decimals)} AS metric_value
FROM daily JOIN {source} USING (bot) GROUP BY event_date, {key}"""


BY_WORKFLOW = {
    "workflow_click_rate": rolled("flow", "workflow", "click_rate", "copies * openers", "copies * card_users", 4),
    "workflow_chat_start": rolled("flow", "workflow", "chat_start_rate", "copies * pair_rows", "copies * pair_hits", 4),
    "workflow_chat_depth": rolled("flow", "workflow", "chat_depth_user", "msg_ids", "chatters", 2),
}

# A bot's counts enter each of its tags as often as the per-prompt tables hold the bot.
TAGGED = "(SELECT DISTINCT bot, tags AS tag, kinds, weight.copies FROM member JOIN weight USING (bot))"
BY_TAG = {
    "tag_click_rate": rolled(TAGGED, "tag", "click_rate", "kinds * open_ids", "kinds * card_ids", 4),
    "tag_chat_start": rolled(TAGGED, "tag", "chat_start_rate", "kinds * pair_rows", "kinds * pair_hits", 4),
    "tag_chat_depth": rolled(TAGGED, "tag", "chat_depth_user", "copies * msg_ids", "kinds * chatters", 2),
}

EXPLODED = """pieces AS (
  SELECT bot, trim(unnest(string_split(name, ','))) AS tag FROM bot_tag WHERE contains(path, 'V5') AND name IS NOT NULL),
bot_day_tag AS (
  SELECT event_date, bot, tag FROM facts JOIN pieces USING (bot) WHERE tag <> ''
    AND EXISTS (FROM touch x WHERE kind = 'card' AND x.bot = facts.bot AND x.event_date = facts.event_date))"""

# Whole-app rows: one per day, also for days without events.
APP = """app_clicks AS (
  SELECT event_date, CASE WHEN COUNT(event_name) > 0 THEN CAST(SUM(IF(event_name = 'view_bot', events, 0)) AS BIGINT) END AS a,
         CASE WHEN COUNT(event_name) > 0 THEN CAST(SUM(IF(event_name = 'show_prompt_card', events, 0)) AS BIGINT) END AS b
  FROM spine LEFT JOIN (FROM event_version_count WHERE event_name IN ('view_bot', 'show_prompt_card')) USING (event_date)
  GROUP BY event_date),
person AS (
  SELECT event_date, user_id, bool_or(kind = 'open') AS opens, bool_or(kind = 'chat') AS chats
  FROM touch WHERE user_id IS NOT NULL GROUP BY ALL),
app_chats AS (
  SELECT event_date, COUNT(user_id) FILTER (opens) AS a, COUNT(user_id) FILTER (opens AND chats) AS b
  FROM spine LEFT JOIN person USING (event_date) GROUP BY event_date)"""


def against_app(labels: str, app_labels: str, source: str, a: str, b: str, names: tuple[str, str, str], app: str,
                start: bool, by: str) -> str:
    """AIGC sums grouped ``by``, stacked on the whole app's row per day."""
    up, down = ("b", "a") if start else ("a", "b")
    return f"""WITH both_sides AS (
  SELECT event_date, {labels}, {long(f'SUM({a})')} AS a, {long(f'SUM({b})')} AS b FROM {source} GROUP BY {by}
  UNION ALL SELECT event_date, {app_labels}, a, b FROM {app})
SELECT * EXCLUDE (a, b), a AS {names[0]}, b AS {names[1]}, {rnd(up, down, 4)} AS {names[2]} FROM both_sides"""


NAMED = "(SELECT * FROM daily JOIN flow USING (bot) WHERE workflow <> '')"
CLICKS = ("total_clicks", "total_shows", "click_rate")
COMPARED = {
    "click_compare": against_app(
        "workflow, 'AIGC' AS bot_type", "'ALL', 'AllBots'", NAMED, "kinds * open_ids", "kinds * card_ids", CLICKS,
        "app_clicks", False, "event_date, workflow"),
    "chat_start_compare": against_app(
        "workflow, 'AIGC' AS bot_type", "'ALL', 'AllBots'", NAMED, "kinds * pair_rows", "kinds * pair_hits",
        ("total_click_users", "total_chat_users", "chat_start_rate"), "app_chats", True, "event_date, workflow"),
    "click_total_compare": against_app(
        "'AIGC' AS bot_type", "'AllBots'", f"spine LEFT JOIN {NAMED} USING (event_date)", "kinds * open_ids",
        "kinds * card_ids", CLICKS, "app_clicks", False, "event_date"),
    "chat_start_total_compare": against_app(
        "'AIGC' AS workflow, 'AIGC' AS bot_type", "'ALL', 'AllBots'",
        "spine LEFT JOIN (FROM daily JOIN flow USING (bot)) USING (event_date)", "kinds * pair_rows", "kinds * pair_hits",
        ("click_user_cnt", "chat_user_cnt", "chat_start_rate"), "app_chats", True, "event_date"),
}


def depth(source: str, keys: str, msgs: str, users: str, names: tuple[str, str], decimals: int, having: str = "") -> str:
    """Messages per user of the bots that chatted; 0 without users unless ``having`` leaves them out."""
    value = rnd(f"SUM({msgs})", f"SUM({users})", decimals)
    value = value if having else f"IF(SUM({users}) = 0, 0.0, {value})"
    return f"""SELECT event_date, {keys}, {long(f'SUM({msgs})')} AS {names[0]}, {long(f'SUM({users})')} AS {names[1]},
       {value} AS chat_depth_user
FROM {source} GROUP BY ALL {having}"""


SIDE = "IF(bot IN (SELECT bot FROM weight), 'AIGC', 'AllBots') AS bot_type"
TOTALS = ("total_msgs", "user_count")
DEPTHS = {
    "chat_depth_compare": depth("(FROM facts LEFT JOIN flow USING (bot) WHERE msgs > 0)", f"{SIDE}, workflow", "msgs", "chatters",
                                TOTALS, 4),
    "chat_depth_total_compare": depth("(FROM facts LEFT JOIN weight USING (bot) WHERE msgs > 0)", SIDE,
                                      "msgs * COALESCE(copies, 1)", "chatters", TOTALS, 4),
    "chat_depth_by_tag": depth(
        "(FROM facts JOIN bot_day_tag USING (event_date, bot) LEFT JOIN weight USING (bot) WHERE fresh_msgs > 0)",
        f"tag, {SIDE}", "fresh_msgs * COALESCE(copies, 1)", "fresh_chatters * COALESCE(copies, 1)",
        ("total_chat_events", "total_chat_user_count"), 2, "HAVING SUM(fresh_msgs) > 0"),
}

# Rows with a missing id or workflow (pandas' missing-value tokens) dropped, fixed stamp.
_NA_LIST = ", ".join("'" + t + "'" for t in PANDAS_NA_TOKENS)
SEED = f"""SELECT prompt_id, tag, DATE '2025-05-10' AS event_date FROM aigc_tag
WHERE prompt_id IS NOT NULL AND tag IS NOT NULL AND prompt_id NOT IN ({_NA_LIST}) AND tag NOT IN ({_NA_LIST})"""


def _stacked(parts: dict[str, str]) -> str:
    return "\nUNION ALL\n".join(parts.values())


def oracles() -> dict[str, str]:
    found = {
        "seed_tags": with_fixture(body=SEED),
        "luna_tags": with_fixture(body="SELECT prompt_id, tag, event_date FROM aigc_tag"),
        "v5_tags": with_fixture(body="SELECT prompt_id, workflow, tags FROM aigc_v5"),
        "tags_exploded": with_fixture(body="SELECT DISTINCT prompt_id, tags AS tag FROM aigc_v5"),
        "bot_tags_daily": with_fixture(FACTS, EXPLODED, body="SELECT event_date, bot AS prompt_id, tag FROM bot_day_tag"),
    }
    for group in (PER_PROMPT, BY_WORKFLOW, BY_TAG):
        found |= {name: with_fixture(FACTS, body=sql) for name, sql in group.items()}
    found["metrics_by_workflow"] = with_fixture(FACTS, body=_stacked(BY_WORKFLOW))
    found["metrics_by_tag"] = with_fixture(FACTS, body=_stacked(BY_TAG))
    for name, sql in COMPARED.items():
        found[name] = f"SELECT * FROM ({with_fixture(FACTS, APP, body='SELECT 1').rsplit('SELECT 1', 1)[0].rstrip()}, " \
                      f"{sql.removeprefix('WITH ')})"
    found |= {name: with_fixture(FACTS, EXPLODED, body=sql) for name, sql in DEPTHS.items()}
    return found
