"""SQL that gives the result of each registered query on the same tables.

Shared parts are common table expressions; ``_sql`` puts the ones a statement needs in front of it.
"""

from __future__ import annotations

import re

from checks.rounding import digits, offset

SPLIT = "TIMESTAMP '2024-01-16 00:00:00'"
OVERLAP_END = "TIMESTAMP '2024-01-18 00:00:00'"
AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"

PARTS: dict[str, str] = {}
ORACLES: dict[str, str] = {}


def _sql(text: str) -> str:
    needed: set[str] = set()
    todo = [text]
    while todo:
        words = set(re.findall(r"\w+", todo.pop()))
        for name in words & (PARTS.keys() - needed):
            needed.add(name)
            todo.append(PARTS[name])
    parts = [f"{name} AS ({PARTS[name]})" for name in PARTS if name in needed]
    return (f"WITH {', '.join(parts)} " if parts else "") + text


def r(expr: str, name: str | None = None) -> str:
    name = name or expr.split(".")[-1]
    return f"round(({expr}) + {offset(name)}, {digits(name)}) + 0.0 AS {name}"


# --- test tables as input tables ---------------------------------------------------------------------------------

PARTS["ev"] = """
SELECT event_id, ts, event_type, value, CAST(user_id AS VARCHAR) AS user_id,
  json_extract_string(props, '$.k') AS video_id FROM events"""
PARTS["ur"] = """
SELECT CAST(c_custkey AS VARCHAR) AS user_id, r_name AS region,
  n_name || CASE WHEN r_regionkey = 0 THEN '-BOT' ELSE '' END AS country
FROM customer, nation, region WHERE c_nationkey = n_nationkey AND n_regionkey = r_regionkey"""
PARTS["place"] = """
SELECT ev.*, r_name AS region, n_name || CASE WHEN r_regionkey = 0 THEN '-BOT' ELSE '' END AS country
FROM ev, nation, region WHERE n_nationkey = CAST(user_id AS BIGINT) % 25 AND n_regionkey = r_regionkey"""
PARTS["up"] = """
SELECT video_id, ts, event_id, region, country,
  CASE WHEN value > 40 THEN 'ai' WHEN value > 10 THEN 'camera' ELSE 'gallery' END AS upload_type
FROM place WHERE event_type = 'signup'"""
PARTS["scores"] = """
SELECT CAST(doc_id AS VARCHAR) AS video_id, toxic = 1 AS is_nsfw,
  CASE WHEN quality = 1 THEN 'neutral' ELSE 'explicit' END AS nsfw_ec, 'UNKNOWN' AS nsfw_gore,
  CASE WHEN toxic = 1 THEN 0.9::DOUBLE ELSE 0.1::DOUBLE END AS probability FROM labels"""
PARTS["shards"] = """
SELECT CAST(o_custkey AS VARCHAR) AS user_id, o_orderstatus AS category, region, o_orderkey, CAST(o_orderdate AS DATE) AS day
FROM orders LEFT JOIN ur ON CAST(o_custkey AS VARCHAR) = ur.user_id"""
PARTS["ve"] = """
SELECT 'vec_' || vec_id AS uri, CAST(vec_id AS VARCHAR) AS post_id,
  CASE WHEN label <= 6 THEN CAST(label * 1000 AS VARCHAR) END AS stamp,
  CASE WHEN label >= 3 THEN CAST(label AS VARCHAR) END AS publisher, CAST(label AS VARCHAR) AS listed, embedding,
  CASE WHEN quality = 1 THEN 'neutral' ELSE 'explicit' END AS nsfw_ec, 'UNKNOWN' AS nsfw_gore,
  coalesce(toxic = 1, false) AS is_nsfw
FROM embeddings LEFT JOIN labels ON vec_id = doc_id"""


def _pairs(condition: str) -> str:
    return f"""
SELECT user_id, video_id, count(*) AS n, avg(value) AS mean, stddev_samp(value) AS sd,
  bool_or(event_type = 'click') AS clicked, max(ts) AS last_ts FROM ev WHERE {condition} GROUP BY ALL"""


PARTS["pa"] = _pairs(f"ts < {SPLIT}")
PARTS["pb"] = _pairs(f"ts >= {SPLIT}")

# --- scans, sinks ------------------------------------------------------------------------------------------------

ORACLES["event_scan"] = f"""
SELECT event_id, ts, event_type, {r("value")} FROM events WHERE event_type IN ('view', 'click') AND ts >= {SPLIT}"""
ORACLES["wildcard_scan"] = """
SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, NULL AS s_suppkey, NULL AS s_name, NULL AS s_nationkey
FROM customer UNION ALL SELECT NULL, NULL, NULL, s_suppkey, s_name, CAST(s_nationkey AS BIGINT) FROM supplier"""
ORACLES["union_of_shards"] = """
SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS name, NULL AS kind FROM nation
UNION ALL SELECT CAST(r_regionkey AS BIGINT), NULL, 'region' FROM region"""
ORACLES["json_columns_to_string"] = "SELECT event_id, CAST(json(props) AS VARCHAR) AS props FROM events"
ORACLES["latest_n_events"] = f"""
SELECT event_id, ts AS timestamp, user_id, event_type, {r("value")} FROM events ORDER BY ts DESC, event_id DESC LIMIT 100"""
_status = "SELECT o_orderstatus, count(*) AS orders FROM orders GROUP BY ALL"
ORACLES["append_or_create"] = f"({_status}) UNION ALL ({_status})"
ORACLES["create_or_replace"] = """
SELECT o_orderdate, count(*) AS orders FROM orders GROUP BY ALL HAVING count(*) > 1"""
ORACLES["partitioned_layout"] = f"""
SELECT event_id, ts, user_id, event_type, {r("value")}, CAST(ts AS DATE) AS dt FROM events"""

# --- functions ---------------------------------------------------------------------------------------------------

_fields = """
SELECT event_id, CAST(user_id AS VARCHAR) AS id, CAST(value AS VARCHAR) AS number, CAST(value > 50 AS VARCHAR) AS flag,
  NULL AS object, NULL AS list, '{' || event_type AS braced, NULL AS gone, NULL AS missing FROM events"""
ORACLES["json_scalar_fields"] = ORACLES["json_scalar_single"] = _fields
ORACLES["json_subdocuments"] = """
SELECT event_id, '{"event_type":"' || event_type || '"}' AS object, 2 AS items, NULL AS no_items FROM events"""
PARTS["docs"] = """
SELECT place.*, CASE WHEN value <= 30 THEN ts
  ELSE max(ts) OVER (PARTITION BY value <= 30, event_id // 8) END AS publish_time
FROM place"""
ORACLES["json_rows_explode"] = _sql(
    "SELECT CASE WHEN value > 30 THEN 'v' || event_id END AS video_id, publish_time FROM docs"
)
ORACLES["parse_timestamps"] = """
SELECT event_id, ts - INTERVAL 330 MINUTE AS shifted, CAST(ts AS DATE) AS day FROM events"""
ORACLES["scalar_functions"] = f"""
SELECT event_id, CAST(NULL AS DOUBLE) AS unreadable, {r("value", "readable")},
  {r("CASE WHEN event_type = 'view' THEN least(value, 20) END", "smaller")},
  {r("CASE WHEN event_type = 'view' THEN greatest(value, 5) END", "floored")},
  {r("CASE WHEN event_type = 'view' THEN value ELSE -1 END", "filled")},
  nullif(event_type, 'view') AS not_view, {r("sqrt(pow(value, 2))", "root")}, epoch_us(ts) // 1000 AS millis,
  event_type = 'view' AS is_view FROM events"""
ORACLES["array_map_lookup"] = _sql(
    """SELECT uri, post_id, stamp AS timestamp, NULL AS canister_id, publisher AS publisher_user_id,
  len(embedding) = 64 AS right_dim FROM ve"""
)
ORACLES["array_map_drop"] = _sql(
    "SELECT uri, concat_ws(',', 'publisher_user_id=' || publisher, 'timestamp=' || stamp) AS entries FROM ve"
)
_entries = "concat_ws(',', 'post_id=' || post_id, 'publisher_user_id=' || {}, 'timestamp=' || stamp) AS entries"
ORACLES["array_map_upsert"] = _sql(f"SELECT uri, {_entries.format('listed')} FROM ve")

# --- filters -----------------------------------------------------------------------------------------------------

ORACLES["predicates"] = _sql(
    """SELECT event_id, user_id, true AS kept FROM ev
WHERE video_id <> '7' AND (event_type = 'error' OR (event_type IN ('view', 'click') AND value >= 10))"""
)
ORACLES["suffix_filter"] = _sql("SELECT * FROM ur WHERE country LIKE '%-BOT'")
ORACLES["lookback_filter"] = f"SELECT event_id, ts FROM events WHERE ts >= {AS_OF} - INTERVAL 7 DAY"
ORACLES["yesterday_filter"] = "SELECT event_id, ts FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-15'"
ORACLES["watermark_filter"] = f"""
SELECT event_id, ts FROM events WHERE ts > (SELECT max(ts) FROM events WHERE event_type = 'view' AND ts < {SPLIT})"""
ORACLES["watermark_without_default"] = """
SELECT event_id, 'strict' AS kind FROM events WHERE ts > (SELECT max(ts) FROM events WHERE event_type = 'none')
UNION ALL SELECT event_id, 'filled' FROM events
WHERE ts > coalesce((SELECT max(ts) FROM events WHERE event_type = 'none'), TIMESTAMP '1970-01-01 00:00:00')"""
ORACLES["value_range_filter"] = "SELECT event_id FROM events WHERE value <= 100"
ORACLES["index_eligible"] = _sql(
    "SELECT uri FROM ve WHERE len(embedding) = 64 AND stamp IS NOT NULL AND publisher IS NOT NULL"
)
ORACLES["array_exists_filter"] = _sql("SELECT uri FROM ve WHERE stamp IS NULL")
ORACLES["parameterised_sql"] = f"SELECT event_id, ts FROM events WHERE ts >= {SPLIT}"

# --- joins -------------------------------------------------------------------------------------------------------

ORACLES["left_join_composite"] = _sql(
    """SELECT a.user_id, a.video_id, views, likes
FROM (SELECT user_id, video_id, count(*) AS views FROM ev WHERE event_type = 'view' GROUP BY ALL) a
LEFT JOIN (SELECT user_id, video_id, count(*) AS likes FROM ev WHERE event_type = 'click' GROUP BY ALL) b
ON a.user_id = b.user_id AND a.video_id = b.video_id"""
)
ORACLES["left_join_default"] = _sql(
    f"""SELECT event_id, user_id, {r("value")}, {r("coalesce(level, 1)", "level")} FROM ev
LEFT JOIN (SELECT user_id, avg(value) AS level FROM ev WHERE value > 150 GROUP BY ALL) USING (user_id)"""
)
ORACLES["left_join_dimension"] = _sql(
    "SELECT event_id, user_id, region FROM ev LEFT JOIN (SELECT * FROM ur WHERE region <> 'ASIA') USING (user_id)"
)
ORACLES["inner_join_fan_out"] = _sql(
    f"""SELECT v.video_id, {r("level")}, event_id, region
FROM (SELECT video_id, avg(value) AS level FROM ev WHERE event_type = 'view' GROUP BY ALL) v JOIN up USING (video_id)"""
)
ORACLES["join_on_json_key"] = _sql(
    """SELECT event_id, 'c' || video_id AS canister_id, uploads
FROM ev JOIN (SELECT video_id, count(*) AS uploads FROM ev GROUP BY ALL) USING (video_id)"""
)
ORACLES["attach_latest"] = _sql(
    """SELECT v.video_id, upload_type, event_id FROM (SELECT DISTINCT video_id FROM ev) v LEFT JOIN
(SELECT * FROM up QUALIFY row_number() OVER (PARTITION BY video_id ORDER BY ts DESC, event_id DESC) = 1) USING (video_id)"""
)
ORACLES["existence_flag"] = _sql(
    "SELECT event_id, user_id, user_id IN (SELECT user_id FROM ev WHERE value > 200) AS big_spender FROM ev"
)
ORACLES["semi_anti_not_in"] = _sql(
    """SELECT uri FROM ve WHERE uri IN (SELECT 'vec_' || doc_id FROM labels)
AND uri NOT IN (SELECT uri FROM ve WHERE is_nsfw)"""
)
ORACLES["not_in_with_nulls"] = _sql(
    "SELECT uri FROM ve WHERE uri NOT IN (SELECT CASE WHEN NOT is_nsfw THEN uri END FROM ve)"
)
ORACLES["broadcast_stats_cross_join"] = f"""
SELECT event_id, {r("value")}, {r("mean")}, last FROM events, (SELECT avg(value) AS mean, max(ts) AS last FROM events)"""
ORACLES["restrict_dates"] = """
SELECT event_id, CAST(ts AS DATE) AS event_date FROM events WHERE CAST(ts AS DATE) IN
(SELECT DISTINCT CAST(ts AS DATE) AS d FROM events ORDER BY d DESC LIMIT 10)"""

# --- aggregation -------------------------------------------------------------------------------------------------

ORACLES["mean_and_rate"] = _sql(
    f"""SELECT video_id, {r("avg(value)", "mean_value")},
{r("avg(CASE WHEN event_type = 'error' THEN NULL WHEN event_type = 'click' THEN 1 ELSE 0 END)", "click_rate")}
FROM ev GROUP BY video_id"""
)
ORACLES["flag_moments"] = _sql(
    f"""SELECT user_id, {r("avg(c)", "clicked_avg")}, {r("stddev_samp(c)", "clicked_stddev")}, CAST(sum(c) AS BIGINT) AS clicks
FROM (SELECT user_id, CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS c FROM ev) GROUP BY user_id"""
)
ORACLES["group_counts"] = _sql(
    f"""SELECT video_id, count(*) AS n, count(*) FILTER (value > 50) AS n_high, CAST(sum(event_id) AS BIGINT) AS id_sum,
min(ts) AS first_ts, max(ts) AS last_ts, {r("stddev_samp(value)", "sd")} FROM ev GROUP BY video_id"""
)
ORACLES["aggregate_all"] = f"""
SELECT {r("avg(value)", "mean")}, {r("stddev_samp(value)", "sd")}, count(*) AS n, max(ts) AS last FROM events"""
ORACLES["distinct_keys"] = _sql("SELECT DISTINCT user_id, video_id FROM ev")
ORACLES["metadata_coverage"] = _sql(
    f"""SELECT count(*) FILTER (publisher IS NULL) AS missing, count(*) AS total,
{r("100.0::DOUBLE * count(*) FILTER (publisher IS NULL) / count(*)", "missing_percentage")} FROM ve"""
)
ORACLES["dau_total"] = "SELECT count(DISTINCT user_id) AS daily_users FROM events"
ORACLES["dau_daily"] = """
SELECT CAST(ts AS DATE) AS event_date, count(DISTINCT user_id) AS daily_users FROM events GROUP BY 1"""

# --- windows, ordering, sets -------------------------------------------------------------------------------------

ORACLES["latest_per_key"] = _sql(
    """SELECT user_id, CAST(strftime(day, '%Y%m%d') AS BIGINT) AS last_updated_date, o_orderkey, category FROM shards
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY day DESC, o_orderkey DESC) = 1"""
)
PARTS["first_scores"] = """
SELECT 'vec_' || doc_id AS uri, 'z_explicit' AS nsfw_ec, CASE WHEN quality = 1 THEN 'low' ELSE 'high' END AS nsfw_gore,
  toxic = 1 AS is_nsfw FROM labels"""
ORACLES["first_per_key"] = _sql("SELECT uri AS gcs_video_id, nsfw_ec, nsfw_gore, is_nsfw FROM first_scores")
PARTS["by_video"] = "SELECT video_id, avg(value) AS rate FROM ev JOIN ur USING (user_id) GROUP BY ALL"
PARTS["by_place"] = "SELECT video_id, region, avg(value) AS rate FROM ev JOIN ur USING (user_id) GROUP BY ALL"
ORACLES["global_zscore"] = _sql(
    f"""SELECT video_id, {r("rate")},
{r("coalesce((rate - avg(rate) OVER ()) / nullif(stddev_samp(rate) OVER (), 0), 0)", "z_rate")} FROM by_video"""
)
ORACLES["partition_zscore"] = _sql(
    f"""SELECT video_id, region, {r("rate")}, {r("(rate - avg(rate) OVER w) / coalesce(nullif(stddev_samp(rate) OVER w, 0), 100)", "z_rate")}
FROM (SELECT video_id, nullif(region, 'ASIA') AS region, rate FROM by_place) WINDOW w AS (PARTITION BY region)"""
)
ORACLES["top_k"] = _sql(f"SELECT video_id, {r('rate')} FROM by_video ORDER BY by_video.rate DESC, video_id LIMIT 10")
ORACLES["top_k_per_group"] = _sql(
    f"""SELECT video_id, region, {r("rate")} FROM by_place
QUALIFY row_number() OVER (PARTITION BY region ORDER BY by_place.rate DESC, video_id) <= 3"""
)
ORACLES["recent_dates"] = "SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders ORDER BY day DESC LIMIT 100"
ORACLES["batch_cap"] = "SELECT DISTINCT l_orderkey FROM lineitem ORDER BY l_orderkey LIMIT 10000"
ORACLES["ordered_export"] = _sql("SELECT * FROM ur ORDER BY region, user_id")
ORACLES["union_distinct"] = _sql(
    "SELECT user_id, video_id FROM ev WHERE event_type = 'view' UNION SELECT user_id, video_id FROM ev WHERE value > 50"
)

# --- merge -------------------------------------------------------------------------------------------------------

_both = "FROM pa t FULL JOIN pb s ON t.user_id = s.user_id AND t.video_id = s.video_id"
_keys = "coalesce(t.user_id, s.user_id) AS user_id, coalesce(t.video_id, s.video_id) AS video_id"
_stats = ("n", "mean", "sd", "clicked", "last_ts")


def _pick(chosen: str, columns=_stats) -> str:
    """Columns of the side a key condition chooses."""
    out = []
    for c in columns:
        value = f"CASE WHEN {chosen} THEN s.{c} ELSE t.{c} END"
        out.append(r(value, c) if c in ("mean", "sd") else f"{value} AS {c}")
    return ", ".join(out)


ORACLES["merge_upsert"] = _sql(f"SELECT {_keys}, {_pick('s.user_id IS NOT NULL')} {_both}")
ORACLES["merge_insert_only"] = _sql(f"SELECT {_keys}, {_pick('t.user_id IS NULL')} {_both}")


def pool_mean(m1: str, n1: str, m2: str, n2: str) -> str:
    return f"({m1} * {n1} + {m2} * {n2}) / ({n1} + {n2})"


def pool_sd(m1: str, s1: str, n1: str, m2: str, s2: str, n2: str) -> str:
    return (
        f"sqrt((({n1} - 1) * {s1} * {s1} + ({n2} - 1) * {s2} * {s2}"
        f" + {n1} * {n2} / ({n1} + {n2})::DOUBLE * ({m1} - {m2}) * ({m1} - {m2})) / ({n1} + {n2} - 1))"
    )


def _three(both: str, only_s: str, only_t: str, key: str = "user_id") -> str:
    return f"CASE WHEN t.{key} IS NULL THEN {only_s} WHEN s.{key} IS NULL THEN {only_t} ELSE {both} END"


ORACLES["merge_pooled"] = _sql(
    f"""SELECT {_keys}, coalesce(t.n, 0) + coalesce(s.n, 0) AS n,
{r(_three(pool_mean("t.mean", "t.n", "s.mean", "s.n"), "s.mean", "t.mean"), "mean")},
{r(_three(pool_sd("t.mean", "t.sd", "t.n", "s.mean", "s.sd", "s.n"), "s.sd", "t.sd"), "sd")},
coalesce(t.clicked, s.clicked) AS clicked, coalesce(s.last_ts, t.last_ts) AS last_ts {_both}"""
)
ORACLES["merge_singleton"] = _sql(
    f"""SELECT (SELECT CAST(sum(n) AS BIGINT) FROM (SELECT n FROM pa UNION ALL SELECT n FROM pb)) AS n,
(SELECT max(last_ts) FROM pb) AS last_ts, {r("greatest((SELECT max(mean) FROM pa), (SELECT max(mean) FROM pb))", "top")}"""
)
ORACLES["merge_sticky_or"] = _sql(
    f"""SELECT {_keys}, coalesce(t.n, s.n) AS n, coalesce(t.clicked, false) OR coalesce(s.clicked, false) AS clicked,
coalesce(s.last_ts, t.last_ts) AS last_ts {_both}"""
)
_left = "FROM pa t LEFT JOIN pb s ON t.user_id = s.user_id AND t.video_id = s.video_id"
ORACLES["merge_update_only"] = _sql(
    f"SELECT t.user_id, t.video_id, t.n, {r('coalesce(s.mean, t.mean)', 'mean')} {_left}"
)
ORACLES["merge_default_fill"] = _sql(
    f"""SELECT t.user_id, t.video_id, t.n, {r("coalesce(s.mean, -1)", "mean")},
s.user_id IS NOT NULL AND t.clicked AS clicked {_left}"""
)

# --- relation and statistics -------------------------------------------------------------------------------------

_watch = "event_type = 'view' AND value <= 100"


def _joined_relation(condition: str) -> str:
    """Watches, to which likes and shares of the same pair are joined."""
    last = lambda kind, c: f"(SELECT user_id, video_id, max(ts) AS {c} FROM ev WHERE event_type = '{kind}' AND {condition} GROUP BY ALL)"
    return f"""
SELECT w.user_id, w.video_id, last_watched_timestamp, mean_percentage_watched, last_liked_timestamp, l.user_id IS NOT NULL AS liked,
  last_shared_timestamp, s.user_id IS NOT NULL AS shared
FROM (SELECT user_id, video_id, max(ts) AS last_watched_timestamp, avg(value) / 100 AS mean_percentage_watched
  FROM ev WHERE {_watch} AND {condition} GROUP BY ALL) w
LEFT JOIN {last('click', 'last_liked_timestamp')} l ON w.user_id = l.user_id AND w.video_id = l.video_id
LEFT JOIN {last('purchase', 'last_shared_timestamp')} s ON w.user_id = s.user_id AND w.video_id = s.video_id"""


PARTS["rel"] = _joined_relation("true")
PARTS["rel0"] = _joined_relation(f"ts < {SPLIT}")
PARTS["relb"] = _joined_relation("ts > (SELECT max(last_watched_timestamp) FROM rel0)")
_new = "s.user_id IS NOT NULL"
PARTS["rel1"] = (
    f"SELECT {_keys}, "
    + ", ".join(
        f"CASE WHEN {_new} THEN s.{c} ELSE t.{c} END AS {c}"
        for c in ("last_watched_timestamp", "mean_percentage_watched", "last_liked_timestamp", "last_shared_timestamp")
    )
    + ", coalesce(t.liked, false) OR coalesce(s.liked, false) AS liked"
    + ", coalesce(t.shared, false) OR coalesce(s.shared, false) AS shared"
    + " FROM rel0 t FULL JOIN relb s ON t.user_id = s.user_id AND t.video_id = s.video_id"
)
_rel_out = f"""SELECT user_id, video_id, last_watched_timestamp, {r("mean_percentage_watched")}, last_liked_timestamp, liked,
last_shared_timestamp, shared FROM """
ORACLES["user_video_relation"] = _sql(_rel_out + "rel")
ORACLES["user_video_relation_incr"] = _sql(_rel_out + "rel1")

_measures = {"like": "CAST(liked AS INT)", "share": "CAST(shared AS INT)", "watch_percentage": "mean_percentage_watched"}


def _users(source: str) -> str:
    parts = [f"avg({x}) AS user_{m}_avg, stddev_samp({x}) AS user_{m}_stddev" for m, x in _measures.items()]
    return f"""
SELECT *, {", ".join(
        f"user_{m}_avg * (1 - user_{m}_avg) AS user_normalized_{m}_avg, "
        f"(1 - user_{m}_avg) * user_{m}_stddev AS user_normalized_{m}_stddev" for m in _measures)}
FROM (SELECT user_id, {", ".join(parts)}, CAST(sum(CAST(liked AS INT)) AS BIGINT) AS total_likes,
  CAST(sum(CAST(shared AS INT)) AS BIGINT) AS total_shares, count(mean_percentage_watched) AS total_watches,
  max(last_watched_timestamp) AS last_update_timestamp FROM {source} GROUP BY user_id)"""


_user_doubles = [f"user_{p}{m}_{s}" for m in _measures for p in ("", "normalized_") for s in ("avg", "stddev")]
_user_rest = ["total_likes", "total_shares", "total_watches", "last_update_timestamp"]
PARTS["us"] = _users("rel")
PARTS["us0"] = _users("rel0")
PARTS["relu"] = "SELECT * FROM rel1 WHERE last_watched_timestamp > (SELECT max(last_update_timestamp) FROM us0)"
PARTS["usb"] = _users("relu")


def _users_merged() -> str:
    n = ("t.total_watches", "s.total_watches")
    out = ["coalesce(t.user_id, s.user_id) AS user_id"]
    for m in _measures:
        a, sd = f"user_{m}_avg", f"user_{m}_stddev"
        pooled = {
            a: pool_mean(f"t.{a}", n[0], f"s.{a}", n[1]),
            sd: pool_sd(f"t.{a}", f"t.{sd}", n[0], f"s.{a}", f"s.{sd}", n[1]),
            # as published: from the averages before the merge
            f"user_normalized_{m}_avg": f"t.{a} * (1 - t.{a})",
            f"user_normalized_{m}_stddev": f"(1 - t.{a}) * t.{sd}",
        }
        out += [f"{_three(v, f's.{c}', f't.{c}')} AS {c}" for c, v in pooled.items()]
    out += [f"coalesce(t.{c}, 0) + coalesce(s.{c}, 0) AS {c}" for c in _user_rest[:3]]
    out.append("coalesce(s.last_update_timestamp, t.last_update_timestamp) AS last_update_timestamp")
    return f"SELECT {', '.join(out)} FROM us0 t FULL JOIN usb s ON t.user_id = s.user_id"


PARTS["us1"] = _users_merged()
_users_out = f"SELECT user_id, {', '.join(r(c) for c in _user_doubles)}, {', '.join(_user_rest)} FROM "
ORACLES["user_video_metrics"] = _sql(_users_out + "us")
ORACLES["user_video_metrics_incr"] = _sql(_users_out + "us1")


def _videos(source: str, users: str) -> str:
    parts = [
        f"avg((1 - coalesce(user_{m}_avg, 1)) * {x}) AS user_normalized_{m}_perc" for m, x in _measures.items()
    ]
    return f"""
SELECT video_id, {", ".join(parts)}, count(user_id) AS total_impressions,
  max(last_watched_timestamp) AS last_update_timestamp
FROM {source} LEFT JOIN (SELECT user_id, {", ".join(f"user_{m}_avg" for m in _measures)} FROM {users}) USING (user_id)
GROUP BY video_id"""


_perc = [f"user_normalized_{m}_perc" for m in _measures]
PARTS["vi"] = _videos("rel", "us")
PARTS["vi0"] = _videos("rel0", "us0")
PARTS["relv"] = "SELECT * FROM rel1 WHERE last_watched_timestamp > (SELECT max(last_update_timestamp) FROM vi0)"
PARTS["vib"] = _videos("relv", "us1")
_pooled_perc = [
    _three(pool_mean(f"t.{c}", "t.total_impressions", f"s.{c}", "s.total_impressions"), f"s.{c}", f"t.{c}", "video_id") + f" AS {c}"
    for c in _perc
]
PARTS["vi1"] = f"""
SELECT coalesce(t.video_id, s.video_id) AS video_id, {", ".join(_pooled_perc)},
  coalesce(t.total_impressions, 0) + coalesce(s.total_impressions, 0) AS total_impressions,
  coalesce(s.last_update_timestamp, t.last_update_timestamp) AS last_update_timestamp
FROM vi0 t FULL JOIN vib s ON t.video_id = s.video_id"""
_videos_out = f"SELECT video_id, {', '.join(r(c) for c in _perc)}, total_impressions, last_update_timestamp FROM "
ORACLES["video_statistics"] = _sql(_videos_out + "vi")
ORACLES["video_statistics_incr"] = _sql(_videos_out + "vi1")

_global_names = dict(zip(_perc, ("user_normalized_likes", "user_normalized_shares", "user_normalized_watch_percentage")))


def _all(source: str) -> str:
    parts = [f"avg({c}) AS global_avg_{g}, stddev_samp({c}) AS global_stddev_{g}" for c, g in _global_names.items()]
    return f"""
SELECT {", ".join(parts)}, CAST(sum(total_impressions) AS BIGINT) AS total_impressions,
  max(last_update_timestamp) AS last_update_timestamp FROM {source}"""


PARTS["gl"] = _all("vi")
PARTS["gl0"] = _all("vi0")
PARTS["vig"] = "SELECT * FROM vi1 WHERE last_update_timestamp > (SELECT last_update_timestamp FROM gl0)"
PARTS["glb"] = _all("vig")
_gn = ("t.total_impressions", "s.total_impressions")
PARTS["gl1"] = (
    "SELECT "
    + ", ".join(
        f"coalesce({pool_mean(f't.global_avg_{g}', _gn[0], f's.global_avg_{g}', _gn[1])}, t.global_avg_{g}) AS global_avg_{g}, "
        f"coalesce({pool_sd(f't.global_avg_{g}', f't.global_stddev_{g}', _gn[0], f's.global_avg_{g}', f's.global_stddev_{g}', _gn[1])},"
        f" t.global_stddev_{g}) AS global_stddev_{g}"
        for g in _global_names.values()
    )
    + """, coalesce(t.total_impressions, 0) + coalesce(s.total_impressions, 0) AS total_impressions,
coalesce(s.last_update_timestamp, t.last_update_timestamp) AS last_update_timestamp FROM gl0 t, glb s"""
)
_global_out = (
    "SELECT "
    + ", ".join(r(f"global_{stat}_{g}") for g in _global_names.values() for stat in ("avg", "stddev"))
    + ", total_impressions, last_update_timestamp FROM "
)
ORACLES["global_video_stats"] = _sql(_global_out + "gl")
ORACLES["global_video_stats_incr"] = _sql(_global_out + "gl1")

_short = dict(zip(_perc, ("like", "share", "watch")))


def _quality(like: str, share: str, watch: str) -> str:
    a, b, c = (f"({z} + 120)" for z in (like, share, watch))
    return f"3 * {a} * {b} * {c} / ({a} + {b} + {c})"


def _normalized(source: str, stats: str) -> str:
    z = {
        m: f"({c} - global_avg_{_global_names[c]}) / CASE WHEN global_stddev_{_global_names[c]} < 0.01 THEN 0.01"
        f" ELSE global_stddev_{_global_names[c]} END"
        for c, m in _short.items()
    }
    return f"""
SELECT *, {_quality(*(f"normalized_{m}_perc" for m in z))} AS ds_quality_score
FROM (SELECT video_id, {", ".join(f"{c} AS {m}_percentage_un, {z[m]} AS normalized_{m}_perc" for c, m in _short.items())},
  v.total_impressions, v.last_update_timestamp FROM {source} v, {stats})"""


PARTS["no"] = _normalized("vi", "gl")
PARTS["no0"] = _normalized("vi0", "gl0")
PARTS["vin"] = "SELECT * FROM vi1 WHERE last_update_timestamp > (SELECT max(last_update_timestamp) FROM no0)"
PARTS["nob"] = _normalized("vin", "gl1")


def _normalized_merged() -> str:
    out = ["coalesce(t.video_id, s.video_id) AS video_id"]
    for c, m in _short.items():
        g = _global_names[c]
        un = pool_mean(f"t.{m}_percentage_un", "t.total_impressions", f"s.{m}_percentage_un", "s.total_impressions")
        out.append(f"{_three(un, f's.{m}_percentage_un', f't.{m}_percentage_un', 'video_id')} AS {m}_percentage_un")
        # as published: from the percentages before the merge
        z = f"(t.{m}_percentage_un - g.global_avg_{g}) / greatest(g.global_stddev_{g}, 0.01)"
        out.append(
            f"{_three(f'coalesce({z}, 0)', f'coalesce(s.normalized_{m}_perc, 0)', f't.normalized_{m}_perc', 'video_id')}"
            f" AS normalized_{m}_perc"
        )
    old = _quality(*(f"t.normalized_{m}_perc" for m in _short.values()))
    out.append(f"{_three(old, 's.ds_quality_score', 't.ds_quality_score', 'video_id')} AS ds_quality_score")
    out.append("coalesce(t.total_impressions, 0) + coalesce(s.total_impressions, 0) AS total_impressions")
    out.append("coalesce(s.last_update_timestamp, t.last_update_timestamp) AS last_update_timestamp")
    return f"SELECT {', '.join(out)} FROM (no0 t FULL JOIN nob s ON t.video_id = s.video_id), gl1 g"


PARTS["no1"] = _normalized_merged()
_normalized_out = (
    "SELECT video_id, "
    + ", ".join(r(f"{m}_percentage_un") + ", " + r(f"normalized_{m}_perc") for m in _short.values())
    + f", total_impressions, last_update_timestamp, {r('ds_quality_score')} FROM "
)
ORACLES["video_statistics_normalized"] = _sql(_normalized_out + "no")
ORACLES["video_statistics_normalized_incr"] = _sql(_normalized_out + "no1")

PARTS["usr"] = _users("rel1")
PARTS["vir"] = _videos("rel1", "usr")
PARTS["glr"] = _all("vir")
PARTS["nor"] = _normalized("vir", "glr")
ORACLES["retracted_statistics"] = _sql(
    _normalized_out.replace(" FROM ", ", pairs, mean_deviation FROM ")
    + f"""nor, (SELECT CAST(sum(total_watches) AS BIGINT) AS pairs, {r("avg(user_watch_percentage_stddev)", "mean_deviation")} FROM usr)"""
)

# --- popularity --------------------------------------------------------------------------------------------------


def _recent(days: int) -> str:
    return f"last_watched_timestamp >= {AS_OF} - INTERVAL {days} DAY"


_means = "avg(CAST(liked AS INT)) AS l, avg(mean_percentage_watched) AS w"


def _score(zl: str, zw: str) -> str:
    low = f"least({zl}, {zw})"
    return f"2 / (1 / ({zl} - {low} + 1 + 1e-9) + 1 / ({zw} - {low} + 1 + 1e-9))"


def _z(x: str, over: str, guard: str) -> str:
    gap, sd = f"({x} - avg({x}) OVER ({over}))", f"nullif(stddev_samp({x}) OVER ({over}), 0)"
    return {"none": f"{gap} / {sd}", "zero": f"coalesce({gap} / {sd}, 0)", "flat": f"{gap} / coalesce({sd}, 100)"}[guard]


PARTS["pop90"] = f"""
SELECT video_id, {_z("l", "", "none")} AS zl, {_z("w", "", "none")} AS zw
FROM (SELECT video_id, {_means} FROM rel WHERE {_recent(90)} GROUP BY video_id)"""
ORACLES["global_popular_l90d"] = _sql(
    f"""SELECT video_id, {r("zl", "normalized_like_perc")}, {r("zw", "normalized_watch_perc")},
{r(_score("zl", "zw"), "global_popularity_score")} FROM pop90"""
)
PARTS["pop7"] = f"""
SELECT video_id, {_z("l", "", "zero")} AS zl, {_z("w", "", "zero")} AS zw
FROM (SELECT video_id, {_means} FROM rel WHERE {_recent(7)} GROUP BY video_id)"""
ORACLES["global_popular_l7d"] = _sql(
    f"""SELECT p.video_id, {r("zl - least(zl, zw) + 1", "normalized_like_perc_p")},
{r("zw - least(zl, zw) + 1", "normalized_watch_perc_p")}, {r(_score("zl", "zw"), "global_popularity_score")},
is_nsfw, nsfw_ec, nsfw_gore, {r("probability", "nsfw_probability")}, upload_type,
p.video_id IN (SELECT video_id FROM up WHERE country LIKE '%-BOT') AS is_bot_uploaded,
p.video_id IN (SELECT CAST(doc_id AS VARCHAR) FROM documents WHERE lang = 'en') AS user_uploaded_ai_content
FROM pop7 p JOIN scores USING (video_id) LEFT JOIN
(SELECT * FROM up QUALIFY row_number() OVER (PARTITION BY video_id ORDER BY ts DESC, event_id DESC) = 1) u
ON p.video_id = u.video_id"""
)
for _days in (7, 90):
    PARTS[f"local{_days}"] = f"""
SELECT video_id, region, {_z("l", "PARTITION BY region", "flat")} AS zl, {_z("w", "PARTITION BY region", "flat")} AS zw
FROM (SELECT video_id, region, {_means} FROM rel LEFT JOIN ur USING (user_id) WHERE {_recent(_days)} GROUP BY ALL)"""
    ORACLES[f"local_popular_l{_days}d"] = _sql(
        f"""SELECT video_id, region, {r("zl", "normalized_like_perc")}, {r("zw", "normalized_watch_perc")},
{r(_score("zl", "zw"), "local_popularity_score")} FROM local{_days}"""
    )
PARTS["place7"] = f"""
SELECT video_id, region, {_z("l", "", "flat")} AS zl, {_z("w", "", "flat")} AS zw
FROM (SELECT video_id, region, {_means} FROM rel JOIN up USING (video_id) WHERE {_recent(7)} AND region IS NOT NULL GROUP BY ALL)"""
ORACLES["region_popular_l7d"] = _sql(
    f"""SELECT video_id, region, {r("zl - least(zl, zw) + 1", "normalized_like_perc_p")},
{r("zw - least(zl, zw) + 1", "normalized_watch_perc_p")}, {r(_score("zl", "zw"), "within_region_popularity_score")} FROM place7"""
)

# --- graph, uploads, moderation, users, counts -------------------------------------------------------------------

PARTS["follows"] = """
SELECT user_id AS follower_id, video_id AS following_id, event_type = 'signup' AS active, ts AS last_updated_timestamp
FROM ev WHERE event_type IN ('signup', 'error')
QUALIFY row_number() OVER (PARTITION BY user_id, video_id ORDER BY ts DESC, event_type DESC) = 1"""
for _name in ("follower_graph", "stream_latest_state"):
    ORACLES[_name] = _sql("SELECT * FROM follows")
# states from before the second batch were blanked, and stay so unless the batch has the pair
for _name in ("follower_graph_incr", "create_or_merge", "stream_increment"):
    ORACLES[_name] = _sql(
        f"""SELECT follower_id, following_id, CASE WHEN last_updated_timestamp >= {SPLIT} THEN active END AS active,
last_updated_timestamp FROM follows"""
    )

_null_fields = [
    "btc_balance_e8s", "city", "country", "creator_commision_percentage", "custom_device_id", "device", "distinct_id",
    "game_type", "ip", "ip_addr", "is_game_enabled", "is_logged_in", "is_nsfw_enabled", "principal", "user_agent", "visitor_id",
]
for _name, _city in (("video_upload_stats", "NULL"), ("video_upload_stats_incr", f"CASE WHEN ts < {SPLIT} THEN 'old' END")):
    ORACLES[_name] = _sql(
        f"""SELECT 'd' || user_id AS device_id, CASE WHEN value > 50 THEN 'android' ELSE 'ios' END AS os,
CAST(NULL AS VARCHAR) AS user_id, 'video_upload_success' AS event, CAST(value > 40 AS VARCHAR) AS is_creator, region,
CAST(event_id AS VARCHAR) AS sats_balance, 'v' || event_id AS video_id,
CASE WHEN value > 10 THEN 'camera' ELSE 'gallery' END AS upload_type, ts AS timestamp,
{", ".join(f"CAST({_city if c == 'city' else 'NULL'} AS VARCHAR) AS {c}" for c in _null_fields)} FROM docs WHERE event_type = 'signup' AND value <= 30"""
    )
_shown = "'user ' || user_id"
for _name, _display in (
    ("bot_uploaded_content", _shown),
    ("bot_uploaded_content_incr", f"CASE WHEN ts < {SPLIT} THEN 'old' ELSE {_shown} END"),
):
    ORACLES[_name] = _sql(
        f"""SELECT user_id, user_id AS publisher_user_id, 'c' || video_id AS canister_id, 'v' || event_id AS video_id,
CAST(event_id AS VARCHAR) AS post_id, country, {_display} AS display_name, ts AS timestamp
FROM docs WHERE event_type = 'signup' AND country LIKE '%-BOT'"""
    )


def _ai(country: str) -> str:
    return f"""
SELECT 'v' || event_id AS video_id, user_id AS publisher_user_id, user_id, 'c' || video_id AS ai_canister_id,
  strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS event_timestamp_str, publish_time, publish_time AS received_timestamp,
  CAST(to_json({{'event': 'video_upload_success', 'video_id': 'v' || event_id, 'user_id': user_id,
    'publisher_user_id': user_id, 'canister_id': 'c' || video_id, 'type': 'upload', 'type_ext': 'ai_video',
    '$device_id': 'd' || user_id, '$os': CASE WHEN value > 50 THEN 'android' ELSE 'ios' END, 'region': region,
    'is_creator': value > 40, 'sats_balance': event_id,
    'upload_type': CASE WHEN value > 10 THEN 'camera' ELSE 'gallery' END}}) AS VARCHAR) AS event_json_data,
  'upload' AS event_type, 'ai_video' AS type_ext, ts AS upload_timestamp, CAST(event_id AS VARCHAR) AS post_id,
  'c' || video_id AS upload_canister_id, {country} AS country, 'user ' || user_id AS display_name
FROM docs WHERE docs.event_type = 'signup' AND value > 20"""


ORACLES["ai_ugc"] = _sql(_ai("country"))
_in_batch = f"publish_time >= {SPLIT} AND ts >= {SPLIT}"
_in_first = f"publish_time < {OVERLAP_END} AND ts < {OVERLAP_END}"
ORACLES["ai_ugc_incr"] = _sql(
    _ai(f"CASE WHEN {_in_batch} THEN country ELSE 'old' END") + f" AND (({_in_batch}) OR ({_in_first}))"
)


def _reports(reason: str) -> str:
    return f"""
SELECT video_id, 'u' || video_id AS publisher_user_id, 'c' || video_id AS canister_id, {reason} AS report_reason,
  user_id AS reporter_user_id, country AS reporter_country, ts AS report_timestamp FROM docs WHERE event_type = 'error'"""


_reason = "CASE WHEN value > 50 THEN 'Spam' ELSE 'Nudity / Porn' END"
ORACLES["video_reports"] = _sql(_reports(_reason))
ORACLES["video_reports_incr"] = _sql(_reports(f"CASE WHEN ts >= {SPLIT} THEN {_reason} ELSE 'old' END"))


def _excluded(condition: str) -> str:
    return f"""
SELECT video_id, min(ts) AS excluded_at, 'reported_nsfw' AS exclusion_reason FROM ev
WHERE event_type = 'error' AND {condition}
  AND video_id IN (SELECT video_id FROM scores WHERE probability >= 0.4 OR nsfw_ec <> 'neutral') GROUP BY video_id
UNION SELECT video_id, min(ts), 'banned' FROM ev WHERE event_type = 'signup' AND value > 100 AND {condition} GROUP BY video_id"""


PARTS["ex0"] = _excluded(f"ts < {OVERLAP_END}")
PARTS["exall"] = _excluded(f"ts >= {SPLIT}")
PARTS["exb"] = "SELECT * FROM exall QUALIFY row_number() OVER (PARTITION BY video_id ORDER BY exclusion_reason) = 1"
ORACLES["excluded_videos"] = _sql(_excluded("true"))
ORACLES["excluded_videos_incr"] = _sql(
    """SELECT coalesce(t.video_id, s.video_id) AS video_id, coalesce(s.excluded_at, t.excluded_at) AS excluded_at,
coalesce(s.exclusion_reason, t.exclusion_reason) AS exclusion_reason FROM ex0 t FULL JOIN exb s ON t.video_id = s.video_id"""
)


def _facts(condition: str) -> str:
    return f"""
SELECT user_id, category, region, CAST(strftime(day, '%Y%m%d') AS BIGINT) AS occurrence_date, day AS last_updated_date
FROM shards WHERE {condition} QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY day DESC, o_orderkey DESC) = 1"""


PARTS["facts0"] = _facts("day <= DATE '2000-01-01'")
PARTS["factsb"] = _facts("day >= DATE '2000-01-01'")
ORACLES["user_base_facts"] = _sql(_facts("true"))
ORACLES["user_base_facts_incr"] = _sql(
    "SELECT * FROM factsb UNION ALL SELECT * FROM facts0 WHERE user_id NOT IN (SELECT user_id FROM factsb)"
)
PARTS["per_day"] = """
SELECT CAST(ts AS DATE) AS event_date, event_type AS event_name, count(*) AS event_count FROM events GROUP BY ALL"""
ORACLES["daily_event_counts"] = _sql("SELECT * FROM per_day")
ORACLES["daily_event_counts_recent"] = """
SELECT CAST(o_orderdate AS DATE) AS event_date, o_orderstatus AS event_name, count(*) AS event_count FROM orders
WHERE CAST(o_orderdate AS DATE) IN (SELECT DISTINCT CAST(o_orderdate AS DATE) FROM orders ORDER BY 1 DESC LIMIT 100) GROUP BY ALL"""
ORACLES["daily_event_counts_update"] = _sql("SELECT * FROM per_day WHERE event_date <= DATE '2024-01-15'")
# late rows count while their day is open: until a batch ends with a row two days after the day's end, and the next one as well
ORACLES["stream_daily_counts"] = f"""
SELECT CAST(ts AS DATE) AS event_date, event_type AS event_name, count(*) AS event_count FROM events
WHERE value <= 20 OR CAST(ts AS DATE) + INTERVAL 1 DAY >
  (SELECT max(ts) FROM events WHERE value <= 20 AND ts < {SPLIT}) - INTERVAL 2 DAY
GROUP BY ALL"""


def _seen(condition: str) -> str:
    return f"""
SELECT user_id, event_type, ts, value FROM events WHERE {condition} AND ts >= (SELECT max(ts) FROM events WHERE {condition}) - INTERVAL 7 DAY
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC) = 1"""


PARTS["seen1"], PARTS["seen2"] = _seen(f"ts < {SPLIT}"), _seen(f"ts >= {SPLIT}")
ORACLES["stream_lookback_upsert"] = _sql(
    f"""SELECT user_id, event_type, ts, {r("value")} FROM (SELECT * FROM seen2 UNION ALL SELECT * FROM seen1 ANTI JOIN seen2
USING (user_id, event_type))"""
)

# --- embeddings --------------------------------------------------------------------------------------------------

_letters = ", ".join(
    r(f"CAST(length(text) - length(replace(text, '{c}', '')) AS DOUBLE)", f"count_{c}") for c in "abcdefgh"
)
ORACLES["embed_new_videos"] = f"""
SELECT 'doc_' || doc_id AS uri, toxic = 1 AS is_nsfw, CASE WHEN quality = 1 THEN 'neutral' ELSE 'explicit' END AS nsfw_ec,
  'UNKNOWN' AS nsfw_gore, {_letters} FROM documents JOIN labels USING (doc_id) WHERE lang <> 'de'"""
_spans = ", ".join(
    r(f"CAST(length(part) - length(replace(part, '{c}', '')) AS DOUBLE)", f"count_{c}") for c in "abcdefgh"
)
ORACLES["embed_segments"] = f"""
SELECT uri, {r("CAST(a AS DOUBLE)", "start")}, {r("CAST(least(a + 1000, length(text)) AS DOUBLE)", '"end"')}, {_spans}
FROM (SELECT 'doc_' || doc_id AS uri, text, a, substr(text, a + 1, 1000) AS part
  FROM documents, unnest(range(0, length(text), 1000)) AS spans(a))"""
_fit = "stamp IS NOT NULL AND publisher IS NOT NULL AND len(embedding) = 64"
_index = """uri, {} AS post_id, stamp AS timestamp, NULL AS canister_id, publisher AS publisher_user_id,
nsfw_ec, nsfw_gore, is_nsfw"""
ORACLES["video_index"] = _sql(f"SELECT {_index.format('post_id')} FROM ve WHERE {_fit}")
ORACLES["video_index_incr"] = _sql(
    f"""SELECT {_index.format("CASE WHEN is_nsfw THEN 'old' ELSE post_id END")}, len(embedding) AS dim FROM ve WHERE {_fit}"""
)
ORACLES["backfill_nsfw"] = _sql(
    """SELECT uri, coalesce(s.nsfw_ec, 'UNKNOWN') AS nsfw_ec, coalesce(s.nsfw_gore, 'UNKNOWN') AS nsfw_gore,
coalesce(s.is_nsfw, true) AS is_nsfw FROM ve LEFT JOIN first_scores s USING (uri)"""
)
ORACLES["backfill_metadata_key"] = ORACLES["array_map_upsert"]
_similar = """SELECT vec_id, list_cosine_similarity(embedding::DOUBLE[],
(SELECT embedding::DOUBLE[] FROM embeddings ORDER BY vec_id LIMIT 1)) AS sim FROM embeddings ORDER BY sim DESC, vec_id LIMIT 5"""
for _name in ("vector_search_exact", "vector_search_all_cells"):
    ORACLES[_name] = f"SELECT vec_id, {r('sim', 'similarity')} FROM ({_similar})"

_angle = "list_cosine_similarity({}::DOUBLE[], {}::DOUBLE[])"
ORACLES["vector_search_ivf"] = f"""
WITH centers AS (SELECT vec_id AS c, embedding AS center FROM embeddings ORDER BY vec_id LIMIT 8),
q AS (SELECT embedding AS query FROM embeddings ORDER BY vec_id LIMIT 1),
near AS (SELECT c FROM centers, q ORDER BY {_angle.format("center", "query")} DESC, c LIMIT 3),
cells AS (SELECT vec_id, embedding, c FROM embeddings, centers
  QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY {_angle.format("embedding", "center")} DESC, c) = 1)
SELECT vec_id, {r("sim", "similarity")} FROM (SELECT vec_id, {_angle.format("embedding", "query")} AS sim
  FROM cells JOIN near USING (c), q ORDER BY sim DESC, vec_id LIMIT 5)"""

ORACLES["vector_index_search"] = f"""
SELECT query_id, vec_id, {r("sim", "similarity")}, rank FROM (
  SELECT q.vec_id AS query_id, e.vec_id, round({_angle.format("q.embedding", "e.embedding")}, 12) AS sim,
    row_number() OVER (PARTITION BY q.vec_id ORDER BY round({_angle.format("q.embedding", "e.embedding")}, 12) DESC, e.vec_id) AS rank
  FROM embeddings q, embeddings e WHERE q.vec_id % 50 = 0) WHERE rank <= 5"""

# --- ingestion and serving ---------------------------------------------------------------------------------------

ORACLES["latest_events_copy"] = """
SELECT event_id, ts AS timestamp, CAST(json(props) AS VARCHAR) AS data FROM events ORDER BY ts DESC, event_id DESC LIMIT 100"""
_moved = "(SELECT date_trunc('millisecond', max(last_update_timestamp)) FROM vi0) - INTERVAL 6 HOUR"
ORACLES["sync_incremental"] = _sql(
    f"""{_videos_out.replace(" FROM ", f", {AS_OF} AS _updated_at FROM ")} vi WHERE last_update_timestamp >= {_moved}
UNION ALL {_videos_out.replace(" FROM ", f", {SPLIT} AS _updated_at FROM ")} vi0
WHERE video_id NOT IN (SELECT video_id FROM vi WHERE last_update_timestamp >= {_moved})"""
)
ORACLES["sync_after_compaction"] = ORACLES["sync_incremental"]
_approval = """CAST(doc_id AS VARCHAR) AS video_id, {} AS post_id, source AS canister_id, lang AS user_id,
lang = 'en' AS is_approved, {} AS _updated_at"""
ORACLES["sync_full"] = f"""SELECT {_approval.format("'p' || doc_id", AS_OF)} FROM documents"""
ORACLES["current_view"] = f"""SELECT {_approval.format(
    "CASE WHEN lang = 'en' THEN 'new' ELSE 'p' || doc_id END", f"CASE WHEN lang = 'en' THEN {AS_OF} ELSE {SPLIT} END")}
FROM documents"""

ORACLES["bucketed_statistics"] = ORACLES["video_statistics"]
ORACLES["merge_touched_partitions"] = ORACLES["merge_upsert"]
ORACLES["merge_appended"] = ORACLES["merge_insert_only"]


def _summary(parts: dict[str, tuple[str, str, str]]) -> str:
    """One row (name, rows, total, old) for each relation, from its SQL, total and condition on rows from before."""
    return _sql(
        "\nUNION ALL ".join(
            f"SELECT '{name}' AS name, count(*) AS rows, CAST(coalesce({total}, 0) AS BIGINT) AS total, count(*) FILTER ({old}) AS old FROM ({sql})"
            for name, (sql, total, old) in parts.items()
        )
    )


def _chain(second: bool) -> str:
    k = "1" if second else ""

    def since(expr: str) -> str:
        """The first batch, or what of the second one lies within a lookback of its time."""
        return f"(ts < {SPLIT} OR ts >= {AS_OF} - INTERVAL {expr})" if second else "true"

    def unless(keys: str, batch: str) -> str:
        return f"({keys}) NOT IN (SELECT ({keys}) FROM {batch})" if second else "false"

    old = f"ts < {SPLIT}" if second else "false"
    excluded = (
        f"""SELECT coalesce(t.video_id, s.video_id) AS video_id, coalesce(s.exclusion_reason, t.exclusion_reason) AS exclusion_reason
FROM ({_excluded(f"ts < {SPLIT}")}) t FULL JOIN (SELECT * FROM ({_excluded(f"ts >= {AS_OF} - INTERVAL 10 MINUTE")})
QUALIFY row_number() OVER (PARTITION BY video_id ORDER BY exclusion_reason) = 1) s ON t.video_id = s.video_id"""
        if second
        else _excluded("true")
    )
    # every event of the tests is an engagement event; some are reported, banned or uploaded as well
    named = f"""SELECT CAST(ts AS DATE) AS day, name, count(*) AS n FROM ev, unnest(
[CASE event_type WHEN 'view' THEN 'w' WHEN 'click' THEN 'l' WHEN 'purchase' THEN 's' WHEN 'signup' THEN 'f' ELSE 'u' END,
 CASE WHEN event_type = 'error' THEN 'r' END, CASE WHEN event_type = 'signup' AND value > 100 THEN 'b' END,
 CASE WHEN event_type = 'signup' THEN 'd' END]) AS names(name)
WHERE name IS NOT NULL AND {f"(ts < {SPLIT} OR CAST(ts AS DATE) = CAST({AS_OF} AS DATE) - 1)" if second else "true"} GROUP BY ALL"""
    ai = f"(ts < {SPLIT} AND publish_time < {SPLIT}) OR (least(ts, publish_time) >= {AS_OF} - INTERVAL 35 MINUTE)" if second else "true"
    facts = ORACLES["user_base_facts"] if not second else _sql("SELECT * FROM facts0")
    parts = {
        "user_video_relation": (f"SELECT * FROM rel{k}", "count(*) FILTER (liked) + 2 * count(*) FILTER (shared)", unless("user_id, video_id", "relb")),
        "user_video_metrics": (f"SELECT * FROM us{k}", "sum(total_watches)", unless("user_id", "usb")),
        "video_statistics": (f"SELECT * FROM vi{k}", "sum(total_impressions)", unless("video_id", "vib")),
        "global_video_stats": (f"SELECT * FROM gl{k}", "sum(total_impressions)", "false"),
        "video_statistics_normalized": (f"SELECT * FROM no{k}", "sum(total_impressions)", unless("video_id", "nob")),
        "follower_graph": (
            "SELECT * FROM follows", "count(DISTINCT follower_id)", f"last_updated_timestamp < {SPLIT}" if second else "false"
        ),
        "video_reports": (f"SELECT * FROM docs WHERE event_type = 'error' AND {since('35 MINUTE')}", "count(DISTINCT video_id)", old),
        "excluded_videos": (excluded, "count(*) FILTER (exclusion_reason = 'banned')", "false"),
        "bot_uploaded_content": ("SELECT * FROM docs WHERE event_type = 'signup' AND country LIKE '%-BOT'", "sum(event_id)", old),
        "video_upload_stats": ("SELECT * FROM docs WHERE event_type = 'signup' AND value <= 30", "sum(event_id)", old),
        "ai_ugc": (f"SELECT * FROM docs WHERE event_type = 'signup' AND value > 20 AND ({ai})", "sum(event_id)", old),
        "user_base_facts": (facts, "count(DISTINCT region)", "true" if second else "false"),
        "daily_event_counts": (named, f"sum(n) FILTER (day >= CAST({SPLIT} AS DATE))" if second else "sum(n)", f"day < {SPLIT}" if second else "false"),
    }
    served = ("user_video_relation", "video_statistics", "follower_graph", "bot_uploaded_content", "ai_ugc", "excluded_videos")
    parts |= {f"{n} served": (*parts[n][:2], "false") for n in served}
    # the chain's uploads are videos of their own, which nobody watched
    ranked = {
        "global_popular_videos_l90d": "SELECT * FROM pop90",
        "global_popular_videos_l7d": "SELECT * FROM pop7 JOIN scores USING (video_id)",
        "region_popular_videos_l7d": "SELECT 1 WHERE false",
        **{
            f"local_popular_videos_l{d}d": f"SELECT DISTINCT video_id, region FROM rel LEFT JOIN ({facts}) f USING (user_id) WHERE {_recent(d)}"
            for d in (7, 90)
        },
    }
    parts |= {n: (sql, "0", "false") for n, sql in ranked.items()}
    parts |= {
        "global_popular_videos_l7d served": (ranked["global_popular_videos_l7d"], "0", "false"),
        "ugc_content_approval served": ("SELECT * FROM documents", "0", "false"),
        "video_nsfw_agg served": ("SELECT * FROM labels", "0", "false"),
    }
    return _summary(parts)


ORACLES["users_over_days"] = "\nUNION ALL ".join(
    f"""SELECT d.day AS event_date, {days} AS days, count(DISTINCT user_id) AS exact, true AS near
FROM (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events) d JOIN events e
ON CAST(e.ts AS DATE) BETWEEN d.day - {days - 1} AND d.day GROUP BY d.day"""
    for days in (1, 7, 28)
)
# the summaries, and the rows at the end of the chain's longest path
ORACLES["chain_first_run"] = f"""
SELECT * FROM ({_chain(False)}) UNION ALL BY NAME SELECT * FROM ({ORACLES["video_statistics_normalized"]})"""
ORACLES["chain_second_run"] = _chain(True)
ORACLES["train_classifier"] = f"""
SELECT ('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8))::BIGINT % 1000 < 200 AS held_out, CAST(quality AS BIGINT) AS label, count(*) AS rows,
  {r("avg(len(string_split(text, ' ')))", "mean_words")}, true AS fitted FROM documents JOIN labels USING (doc_id) GROUP BY ALL"""
