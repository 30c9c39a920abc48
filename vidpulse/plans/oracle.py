"""DuckDB SQL that gives the same result as each named query.

Common table expressions are listed with the ones they need; ``_with`` puts the
chain in front of a query.
"""

from __future__ import annotations

SEED = 42
EPOCH = "TIMESTAMP '1970-01-01'"
PLACES = 10
LOG = "event_time, user_id, video_id, watch_time, duration, watch_ratio, is_click, is_like, is_share"


def _r(expression: str, places: int = PLACES) -> str:
    """Half up on the shortest decimal text of the double, as Spark rounds."""
    return f"CAST(round(CAST(CAST({expression} AS VARCHAR) AS DECIMAL(38, 20)), {places}) AS DOUBLE)"


def _md5(key: str, seed: str | int = SEED) -> str:
    return f"md5(concat('{seed}|', CAST({key} AS VARCHAR)))"


def _draw(key: str, digits: int = 8, seed: str | int = SEED) -> str:
    return f"CAST('0x' || substr({_md5(key, seed)}, 1, {digits}) AS BIGINT)"


def _uniform(key: str, name: str) -> str:
    return f"({_draw(key, 8, f'{SEED}-{name}')} / 4294967296.0::DOUBLE)"


def _int(key: str, name: str, low: int, high: int) -> str:
    return f"({low} + {_draw(key, 8, f'{SEED}-{name}')} % {high - low + 1})"


def _cells(source: str, width: str, engagement: str) -> str:
    return f"""
SELECT video_id, time_bucket(INTERVAL {width}, event_time, {EPOCH}) AS window_start,
       count(*) AS views_count, count(DISTINCT user_id) AS unique_users,
       avg(watch_ratio) AS avg_watch_ratio, avg(watch_time) AS avg_watch_time, {engagement}
FROM {source} WHERE event_time IS NOT NULL GROUP BY ALL"""


def _grown(cells: str, width: str) -> str:
    return f"""
SELECT *, window_start + INTERVAL {width} AS window_end,
       CASE WHEN previous_views = 0 THEN CAST(views_count AS DOUBLE)
            ELSE (views_count - previous_views) / previous_views END AS growth_rate
FROM (SELECT *, coalesce(lag(views_count) OVER (PARTITION BY video_id ORDER BY window_start), 0) AS previous_views
      FROM {cells})"""


ENGAGED = "CAST(sum(is_like + is_share) AS BIGINT) AS engagement_count"
ENGAGED_SPLIT = (
    "CAST(coalesce(sum(is_like), 0) AS BIGINT) AS like_count, "
    "CAST(coalesce(sum(is_share), 0) AS BIGINT) AS share_count"
)
SCORE = (
    "CAST(0.4 AS DOUBLE) * views_score + CAST(0.25 AS DOUBLE) * growth_score"
    " + CAST(0.2 AS DOUBLE) * watch_ratio_score + CAST(0.15 AS DOUBLE) * engagement_score AS hot_score"
)


def _labelled(scored: str, cut: str) -> str:
    return f"""
SELECT *, CASE WHEN predicted_hot = 1 THEN 'HOT' ELSE 'NOT_HOT' END AS hot_label
FROM (SELECT *, CASE WHEN hot_score >= {cut} THEN 1 ELSE 0 END AS predicted_hot FROM {scored})"""


P99 = "(SELECT quantile_cont(hot_score, 0.99) FROM {})"


def _minmax(column: str, alias: str) -> str:
    low, high = f"min({column}) OVER ()", f"max({column}) OVER ()"
    return f"CASE WHEN {low} = {high} THEN 0.0 ELSE ({column} - {low}) / ({high} - {low}) END AS {alias}"


def _decide(source: str) -> str:
    return f"""
SELECT *, CASE WHEN cache_decision = 'CACHE' AND hot_score >= p99 THEN 'VERY_HIGH'
               WHEN cache_decision = 'CACHE' THEN 'HIGH'
               WHEN cache_decision = 'WATCHLIST' THEN 'MEDIUM' ELSE 'LOW' END AS cache_priority,
       CASE cache_decision WHEN 'CACHE' THEN 'Predicted as HOT; preload this video-window into cache.'
            WHEN 'WATCHLIST' THEN 'High hot_score among non-HOT records; monitor for possible caching.'
            ELSE 'Low trending signal; do not cache to avoid wasting resources.' END AS reason,
       row_number() OVER (ORDER BY hot_score DESC, video_id, window_start) AS cache_rank
FROM (SELECT p.*, c.p99, CASE WHEN hot_label = 'HOT' THEN 'CACHE'
                              WHEN hot_score >= c.cut THEN 'WATCHLIST' ELSE 'NO_CACHE' END AS cache_decision
      FROM {source} p CROSS JOIN (
        SELECT coalesce(quantile_cont(hot_score, 0.95) FILTER (hot_label <> 'HOT'), quantile_cont(hot_score, 0.95)) AS cut,
               quantile_cont(hot_score, 0.99) AS p99 FROM {source}) c)"""


def _number(name: str, kind: str = "DOUBLE") -> str:
    read = f"TRY_CAST({name} AS DOUBLE)"
    value = f"CASE WHEN isfinite({read}) THEN {read} ELSE 0.0 END"
    return f"{value} AS {name}" if kind == "DOUBLE" else f"coalesce(TRY_CAST(trunc({value}) AS {kind}), 0) AS {name}"


def _drawn(condition: str, n: int, seed: str = "hit") -> str:
    """``n`` draws with replacement of the served requests that meet a condition."""
    return f"""
SELECT t.event_id, t.video_id, d.draw_id
FROM (SELECT i AS draw_id, {_draw("i", 15, f"{SEED}-{seed}")} % (SELECT count(*) FROM served WHERE {condition}) + 1 AS row
      FROM range({n}) r(i)) d
JOIN (SELECT *, row_number() OVER (ORDER BY event_time, event_id) AS row FROM served WHERE {condition}) t USING (row)"""


# name -> (needed expressions, SQL)
CTE: dict[str, tuple[tuple[str, ...], str]] = {
    "video_log": (
        (),
        """
SELECT event_id, ts AS event_time, CAST(user_id AS VARCHAR) AS user_id, CAST(k AS VARCHAR) AS video_id,
       value AS watch_time, CAST(30 + 10 * (k % 20) AS DOUBLE) AS duration,
       value / CAST(30 + 10 * (k % 20) AS DOUBLE) AS watch_ratio,
       CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS is_click,
       CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS is_like,
       CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END AS is_share
FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events)""",
    ),
    "dirty_log": (
        ("video_log",),
        """
SELECT event_id,
       CASE WHEN event_id % 101 = 0 THEN 'not-a-time' ELSE CAST(event_time AS VARCHAR) END AS event_time,
       CASE WHEN event_id % 97 = 0 THEN NULL ELSE user_id END AS user_id,
       CASE WHEN event_id % 89 = 0 THEN NULL ELSE video_id END AS video_id,
       CASE WHEN event_id % 83 = 0 THEN -1.0 WHEN event_id % 79 = 0 THEN NULL ELSE watch_time END AS watch_time,
       CASE WHEN event_id % 73 = 0 THEN 0.0 ELSE duration END AS duration,
       watch_ratio,
       CASE WHEN event_id % 71 = 0 THEN NULL ELSE is_click END AS is_click, is_like, is_share
FROM (SELECT * FROM video_log UNION ALL SELECT * FROM video_log WHERE event_id % 50 = 0)""",
    ),
    "source_log": (
        ("video_log",),
        """
SELECT event_id, user_id, video_id, epoch_us(event_time) // 1000 AS time_ms,
       CAST(round(watch_time * 1000) AS BIGINT) AS play_time_ms,
       CASE WHEN event_id % 73 = 0 THEN 0 ELSE CAST(duration * 1000 AS BIGINT) END AS duration_ms,
       is_click, is_like, is_share AS is_forward
FROM video_log""",
    ),
    "strict_log": (
        ("video_log",),
        """
SELECT * FROM video_log
WHERE duration > 0 AND watch_time >= 0 AND watch_time / duration BETWEEN 0 AND 1
  AND user_id IS NOT NULL AND video_id IS NOT NULL""",
    ),
    "feature_log": (
        ("dirty_log",),
        """
SELECT * REPLACE (TRY_CAST(event_time AS TIMESTAMP) AS event_time, least(greatest(watch_ratio, 0.0), 1.0) AS watch_ratio)
FROM dirty_log
WHERE TRY_CAST(event_time AS TIMESTAMP) IS NOT NULL AND user_id IS NOT NULL AND video_id IS NOT NULL
  AND duration > 0 AND watch_time >= 0""",
    ),
    "half_hour_cells": (("strict_log",), _cells("strict_log", "30 MINUTE", ENGAGED)),
    "half_hour_features": (("half_hour_cells",), _grown("half_hour_cells", "30 MINUTE")),
    "split_cells": (("feature_log",), _cells("feature_log", "30 MINUTE", ENGAGED_SPLIT)),
    "split_features": (("split_cells",), _grown("split_cells", "30 MINUTE")),
    "big_log": (
        (),
        """
SELECT l_shipdate AS event_time, CAST(l_suppkey AS VARCHAR) AS user_id, CAST(l_partkey AS VARCHAR) AS video_id,
       l_quantity AS watch_time, least(greatest(l_quantity / CAST(p_size AS DOUBLE), 0.0), 1.0) AS watch_ratio,
       CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS is_like, CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END AS is_share
FROM lineitem JOIN part ON l_partkey = p_partkey
WHERE p_size > 0 AND l_quantity >= 0 AND l_suppkey IS NOT NULL""",
    ),
    "big_cells": (("big_log",), _cells("big_log", "30 DAY", ENGAGED)),
    "big_features": (("big_cells",), _grown("big_cells", "30 DAY")),
    "day_cells": (("strict_log",), _cells("strict_log", "1 DAY", ENGAGED)),
    "features": (("day_cells",), _grown("day_cells", "1 DAY")),
    "maxima": (
        ("features",),
        """
SELECT CAST(coalesce(nullif(max(views_count), 0), 1) AS DOUBLE) AS max_views,
       CAST(coalesce(nullif(max(growth_rate), 0), 1) AS DOUBLE) AS max_growth,
       CAST(coalesce(nullif(max(engagement_count), 0), 1) AS DOUBLE) AS max_engagement
FROM features""",
    ),
    "max_scored": (
        ("maxima",),
        f"""
SELECT *, {SCORE}
FROM (SELECT f.*, views_count / max_views AS views_score, growth_rate / max_growth AS growth_score,
             avg_watch_ratio AS watch_ratio_score, engagement_count / max_engagement AS engagement_score
      FROM features f CROSS JOIN maxima)""",
    ),
    "predictions": (("max_scored",), _labelled("max_scored", P99.format("max_scored"))),
    "minmax_scored": (
        ("features",),
        f"""
SELECT *, {SCORE}
FROM (SELECT *, {_minmax("CAST(views_count AS DOUBLE)", "views_score")},
             {_minmax("greatest(growth_rate, 0.0)", "growth_score")},
             {_minmax("avg_watch_ratio", "watch_ratio_score")},
             {_minmax("CAST(engagement_count AS DOUBLE)", "engagement_score")}
      FROM features)""",
    ),
    "minmax_predictions": (("minmax_scored",), _labelled("minmax_scored", P99.format("minmax_scored"))),
    "static_predictions": (("minmax_scored",), _labelled("minmax_scored", "CAST(0.7 AS DOUBLE)")),
    "messy": (
        ("predictions",),
        """
SELECT video_id, window_start, window_end,
       CASE d WHEN 3 THEN 'n/a' WHEN 2 THEN 'inf' WHEN 1 THEN '1e30' ELSE concat(CAST(views_count AS VARCHAR), '.7') END AS views_count,
       CAST(unique_users AS VARCHAR) AS unique_users,
       CASE WHEN d <> 9 THEN CAST(avg_watch_ratio AS VARCHAR) END AS avg_watch_ratio,
       CAST(growth_rate AS VARCHAR) AS growth_rate, CAST(engagement_count AS VARCHAR) AS engagement_count,
       CASE WHEN d <> 4 THEN CAST(hot_score AS VARCHAR) END AS hot_score,
       CASE WHEN d = 5 THEN '' ELSE CAST(predicted_hot AS VARCHAR) END AS predicted_hot,
       CASE d WHEN 6 THEN 'hot' WHEN 7 THEN 'maybe' WHEN 8 THEN NULL ELSE lower(hot_label) END AS hot_label
FROM (SELECT *, CAST(video_id AS INT) % 10 AS d FROM predictions)""",
    ),
    "coerced": (
        ("messy",),
        f"""
SELECT video_id, window_start, window_end, {_number("views_count", "BIGINT")}, {_number("unique_users", "BIGINT")},
       {_number("avg_watch_ratio")}, {_number("growth_rate")}, {_number("engagement_count", "BIGINT")},
       {_number("hot_score")}, {_number("predicted_hot", "INTEGER")}, upper(hot_label) AS hot_label
FROM messy""",
    ),
    "decided": (("predictions",), _decide("predictions")),
    "policy": (
        ("predictions",),
        """
SELECT video_id, window_start, window_end, views_count, unique_users, hot_score, hot_label
FROM predictions WHERE hot_label = 'HOT'
QUALIFY row_number() OVER (PARTITION BY video_id ORDER BY hot_score DESC, window_start) = 1""",
    ),
    "served": (
        ("policy",),
        f"""
SELECT l.event_id, l.event_time, l.video_id, coalesce(p.hot_score, 0.0) AS hot_score, coalesce(p.hot_label, 'NOT_HOT') AS hot_label,
       coalesce(strftime(p.window_start, '%Y-%m-%d %H:%M:%S'), '') AS window_start,
       coalesce(strftime(p.window_end, '%Y-%m-%d %H:%M:%S'), '') AS window_end,
       CASE WHEN p.video_id IS NULL THEN 'NO_CACHE' ELSE 'CACHE' END AS cache_decision,
       CASE WHEN p.video_id IS NULL THEN 'CACHE_MISS' ELSE 'CACHE_HIT' END AS status,
       CASE WHEN p.video_id IS NULL THEN 'ORIGIN_SERVER' ELSE 'EDGE_CACHE' END AS served_from,
       CAST(trunc(l.watch_time) AS INTEGER) AS latency_ms
FROM video_log l LEFT JOIN policy p ON l.video_id = p.video_id""",
    ),
    "mixed": (("served",), _drawn("status = 'CACHE_HIT'", 1200) + "\nUNION ALL " + _drawn("status = 'CACHE_MISS'", 1800, "miss")),
    "best_videos": (("policy",), "SELECT * FROM policy ORDER BY hot_score DESC, video_id, window_start LIMIT 5"),
    "viral": (
        ("served", "best_videos"),
        _drawn("video_id IN (SELECT video_id FROM best_videos)", 450)
        + "\nUNION ALL "
        + _drawn("status = 'CACHE_MISS'", 50, "miss"),
    ),
    "trend_videos": (
        ("video_log",),
        f"SELECT video_id FROM (SELECT DISTINCT video_id FROM video_log) ORDER BY {_md5('video_id')}, video_id LIMIT 30",
    ),
    "trend": (
        ("trend_videos",),
        """
SELECT * FROM video_log
WHERE video_id IN (SELECT video_id FROM trend_videos)
  AND event_time >= (SELECT min(event_time) + INTERVAL 3 HOUR FROM video_log)""",
    ),
    "injected": (
        ("trend",),
        f"""
SELECT t.* EXCLUDE (row) REPLACE (t.event_time + to_seconds({_int("draw_id", "shift", 0, 3599)}) AS event_time)
FROM (SELECT i AS draw_id, {_draw("i", 15)} % (SELECT count(*) FROM trend) + 1 AS row
      FROM range(20000) r(i) WHERE i < (SELECT count(*) FROM trend)) d
JOIN (SELECT *, row_number() OVER (ORDER BY event_time, event_id) AS row FROM trend) t USING (row)""",
    ),
    "totals": (
        ("decided",),
        """
SELECT *, total_requests - cache_hits AS cache_misses,
       CASE WHEN total_requests > 0 THEN cache_hits / total_requests ELSE 0.0 END AS cache_hit_ratio,
       300.0::DOUBLE AS average_latency_without_cache,
       CASE WHEN total_requests > 0 THEN (cache_hits * 50.0::DOUBLE + (total_requests - cache_hits) * 300.0::DOUBLE) / total_requests
            ELSE 0.0 END AS average_latency_with_cache,
       cache_hits * 20.0::DOUBLE / 1024.0::DOUBLE AS estimated_bandwidth_saved,
       300.0::DOUBLE AS origin_latency_ms_assumption, 50.0::DOUBLE AS cache_latency_ms_assumption,
       20.0::DOUBLE AS average_request_size_mb_assumption, 0.02::DOUBLE AS cost_per_gb_assumption
FROM (SELECT CAST(coalesce(sum(views_count), 0) AS BIGINT) AS total_requests,
             CAST(coalesce(sum(views_count) FILTER (cache_decision = 'CACHE'), 0) AS BIGINT) AS cache_hits,
             CAST(coalesce(sum(views_count) FILTER (cache_decision = 'WATCHLIST'), 0) AS BIGINT) AS watchlist_requests,
             count(*) FILTER (cache_decision = 'CACHE') AS num_cache_records,
             count(*) FILTER (cache_decision = 'WATCHLIST') AS num_watchlist_records,
             count(*) FILTER (cache_decision = 'NO_CACHE') AS num_no_cache_records,
             count(DISTINCT video_id) FILTER (cache_decision = 'CACHE') AS num_unique_cached_videos,
             count(DISTINCT video_id) AS num_unique_total_videos
      FROM decided)""",
    ),
    "kpis": (
        ("totals",),
        """
SELECT *, cache_hit_ratio AS origin_request_reduction,
       average_latency_without_cache - average_latency_with_cache AS latency_reduction_ms,
       (average_latency_without_cache - average_latency_with_cache) / average_latency_without_cache AS latency_reduction_percent,
       estimated_bandwidth_saved * cost_per_gb_assumption AS estimated_cost_saved
FROM totals""",
    ),
}


def _with(needed: tuple[str, ...], body: str) -> str:
    chain: dict[str, str] = {}

    def add(name: str) -> None:
        if name not in chain:
            for other in CTE[name][0]:
                add(other)
            chain[name] = CTE[name][1]

    for name in needed:
        add(name)
    parts = ",\n".join(f"{name} AS ({sql.strip()})" for name, sql in chain.items())
    return f"WITH {parts}\n{body.strip()}"


TIME_TEXT = "strftime(event_time, '%Y-%m-%d %H:%M:%S.%f')"
MESSAGE_FIELDS = f"""{TIME_TEXT} AS event_time, CAST(user_id AS BIGINT) AS user_id, CAST(video_id AS BIGINT) AS video_id,
       {_r("watch_time", 3)} AS watch_time, duration, {_r("watch_ratio", 4)} AS watch_ratio, is_click, is_like, is_share"""

# Spark writes a double below 0.001 as digits with an exponent.
RATIO_TEXT = (
    "CASE WHEN r > 0 AND r < 0.001 THEN concat(CAST(CAST(round(r * 10000) AS INT) AS VARCHAR), '.0E-4')"
    " ELSE CAST(r AS VARCHAR) END"
)

FEATURES = f"""video_id, window_start, window_end, views_count, unique_users, {_r("avg_watch_ratio")} AS avg_watch_ratio,
       {_r("avg_watch_time")} AS avg_watch_time, growth_rate, engagement_count"""

PREDICTIONS = f"""video_id, window_start, window_end, views_count, unique_users, {_r("avg_watch_ratio")} AS avg_watch_ratio,
       growth_rate, engagement_count, views_score, growth_score, {_r("watch_ratio_score")} AS watch_ratio_score,
       engagement_score, {_r("hot_score")} AS hot_score, predicted_hot, hot_label"""

HOT = f"""video_id, window_start, window_end, views_count, unique_users, {_r("avg_watch_ratio")} AS avg_watch_ratio,
       growth_rate, engagement_count, {_r("hot_score")} AS hot_score, hot_label"""

POLICY = f"video_id, window_start, window_end, views_count, unique_users, {_r('hot_score')} AS hot_score, hot_label"

BEST = "ORDER BY predictions.hot_score DESC, video_id, window_start"

LOOSE = "event_id, event_time, user_id, video_id, watch_time, duration"


def _outcome(source: str, by: str = "") -> str:
    first = f"{by}, " if by else ""
    return f"""
SELECT {first}count(*) AS total_requests, count(*) FILTER (status = 'CACHE_HIT') AS cache_hits,
       count(*) FILTER (status <> 'CACHE_HIT') AS cache_misses,
       {_r("count(*) FILTER (status = 'CACHE_HIT') / count(*)", 6)} AS cache_hit_ratio,
       {_r("avg(latency_ms)", 4)} AS average_latency_ms"""


def _span(status: str) -> str:
    own = f"latency_ms) FILTER (status = '{status}'"
    return f"concat(min({own}), '-', max({own}))"


def _running(order: str) -> str:
    upto = f"OVER (ORDER BY {order} ROWS UNBOUNDED PRECEDING)"
    hits = f"sum(CASE WHEN status = 'CACHE_HIT' THEN 1 ELSE 0 END) {upto}"
    return f"""{_r(f"{hits} / count(*) {upto}", 6)} AS current_cache_hit_ratio,
       {_r(f"sum(latency_ms) {upto} / count(*) {upto}", 4)} AS current_avg_latency_ms"""


def _describe(source: str, column: str, places: int = 4, extra: str = "") -> str:
    quartiles = ", ".join(
        f"{_r(f'quantile_cont({column}, {q})', places)} AS q{int(q * 100)}" for q in (0.25, 0.5, 0.75)
    )
    return f"""SELECT '{column}' AS "column", count({column}) AS "count", {_r(f"avg({column})", places)} AS mean,
       {_r(f"stddev_samp({column})", places)} AS std, CAST(min({column}) AS DOUBLE) AS min, {quartiles},
       CAST(max({column}) AS DOUBLE) AS max{extra} FROM {source}"""


def _text_profile(column: str, source: str = "orders") -> str:
    return f"""
SELECT '{column}' AS "column", CAST(sum(n) AS BIGINT) AS "count", count(*) AS "unique",
       arg_min(v, (-n, v)) AS top, max(n) AS freq
FROM (SELECT CAST({column} AS VARCHAR) AS v, count(*) AS n FROM {source} WHERE {column} IS NOT NULL GROUP BY 1)"""


def _histogram(values: str, bins: int) -> str:
    return f"""
SELECT bin, {_r("lo + (bin - 1) * width", 6)} AS bin_low, {_r("lo + bin * width", 6)} AS bin_high, count(*) AS rows
FROM (SELECT CAST(least(floor((v - lo) / width) + 1, {bins}) AS INTEGER) AS bin, lo, width
      FROM {values} CROSS JOIN (SELECT min(v) AS lo, (max(v) - min(v)) / {bins} AS width FROM {values}))
GROUP BY ALL"""


# Metric, unit, description and decimal places of the savings report.
KPIS = [
    ("total_requests", "requests", "Total simulated requests based on views_count.", None),
    ("cache_hits", "requests", "Requests served from cache because cache_decision is CACHE.", None),
    ("cache_misses", "requests", "Requests still served by the origin server.", None),
    ("watchlist_requests", "requests", "Requests belonging to WATCHLIST records.", None),
    ("cache_hit_ratio", "ratio", "Share of requests served by cache.", 6),
    ("origin_request_reduction", "ratio", "Estimated reduction of requests to origin server.", 6),
    ("average_latency_without_cache", "ms", "Assumed average latency if all requests go to origin.", 4),
    ("average_latency_with_cache", "ms", "Estimated average latency after applying cache recommendation.", 4),
    ("latency_reduction_ms", "ms", "Estimated latency reduction in milliseconds.", 4),
    ("latency_reduction_percent", "ratio", "Estimated latency reduction ratio.", 6),
    ("estimated_bandwidth_saved", "GB", "Estimated bandwidth saved from cached requests.", 4),
    ("estimated_cost_saved", "USD", "Estimated bandwidth cost saved.", 4),
    ("num_cache_records", "records", "Number of video-window records recommended for CACHE.", None),
    ("num_watchlist_records", "records", "Number of video-window records recommended for WATCHLIST.", None),
    ("num_no_cache_records", "records", "Number of video-window records recommended for NO_CACHE.", None),
    ("num_unique_cached_videos", "videos", "Number of unique videos recommended for CACHE.", None),
    ("num_unique_total_videos", "videos", "Number of unique videos in prediction output.", None),
    ("origin_latency_ms_assumption", "ms", "Latency assumption for origin server.", None),
    ("cache_latency_ms_assumption", "ms", "Latency assumption for cache server.", None),
    ("average_request_size_mb_assumption", "MB", "Assumed average video request size.", None),
    ("cost_per_gb_assumption", "USD/GB", "Assumed bandwidth cost per GB.", None),
]


def _kpi_union() -> str:
    lines = []
    for metric, unit, text, places in KPIS:
        value = metric if places is None else _r(metric, places)
        lines.append(
            f"SELECT '{metric}' AS metric, CAST({value} AS DOUBLE) AS value, '{unit}' AS unit, '{text}' AS description FROM kpis"
        )
    return "\nUNION ALL ".join(lines)


CTE["broken"] = (
    ("video_log",),
    """
SELECT event_id, "partition", {} FROM (SELECT event_id, CAST(video_id AS INT) % 3 AS "partition", {} FROM video_log)""".format(
        ", ".join(
            f"CASE WHEN event_id % 101 = 0 {'OR event_id % 97 = 0 ' if c == 'user_id' else ''}THEN NULL ELSE {c} END AS {c}"
            for c in LOG.split(", ")
        ),
        MESSAGE_FIELDS,
    ),
)

ORACLE_SQL: dict[str, str] = {
    "topic_peek": _with(
        ("video_log",),
        f"""
SELECT CAST(video_id AS INT) % 3 AS "partition", event_id AS "offset", {MESSAGE_FIELDS}
FROM video_log ORDER BY 1, 2 LIMIT 10""",
    ),
    "topic_peek_files": _with(
        ("video_log",),
        f"""
SELECT CAST(video_id AS INT) % 3 AS "partition", event_id AS "offset", {MESSAGE_FIELDS}
FROM video_log ORDER BY 1, 2 LIMIT 10""",
    ),
    "scan_pruned_limit": _with(
        ("video_log",),
        "SELECT video_id FROM (SELECT * FROM video_log ORDER BY event_time, event_id LIMIT 100000)",
    ),
    "replay_head": _with(("video_log",), "SELECT * FROM video_log ORDER BY event_time, event_id LIMIT 5000"),
    "to_messages": _with(
        ("video_log",),
        f"""
SELECT event_id, video_id AS key,
       concat('{{"event_time":"', {TIME_TEXT}, '","user_id":', user_id, ',"video_id":', video_id,
              ',"watch_time":', CAST({_r("watch_time", 3)} AS VARCHAR), ',"duration":', CAST(duration AS VARCHAR),
              ',"watch_ratio":', {RATIO_TEXT}, ',"is_click":', is_click, ',"is_like":', is_like,
              ',"is_share":', is_share, '}}') AS value
FROM (SELECT *, {_r("watch_ratio", 4)} AS r FROM video_log)""",
    ),
    "to_messages_fields": _with(("video_log",), f"SELECT event_id, {MESSAGE_FIELDS} FROM video_log"),
    "parse_messages": _with(("broken",), 'SELECT * EXCLUDE ("partition") FROM broken'),
    "bronze_drain": _with(("broken",), 'SELECT * EXCLUDE (event_id), event_id AS "offset" FROM broken'),
    "silver_drain": _with(
        ("broken",),
        """
SELECT TRY_CAST(event_time AS TIMESTAMP) AS event_time, CAST(user_id AS VARCHAR) AS user_id, CAST(video_id AS VARCHAR) AS video_id,
       watch_time, duration, watch_time / duration AS watch_ratio, is_click, is_like, is_share
FROM broken WHERE user_id IS NOT NULL AND video_id IS NOT NULL AND duration > 0 AND watch_time >= 0 AND watch_time <= duration""",
    ),
    "normalize_columns": _with(("dirty_log",), f"SELECT {LOOSE} FROM dirty_log"),
    "standardize": _with(
        ("source_log",),
        """
SELECT event_id, user_id, video_id, is_click, is_like, make_timestamp(time_ms * 1000) AS event_time,
       play_time_ms / 1000.0::DOUBLE AS watch_time, duration_ms / 1000.0::DOUBLE AS duration,
       CASE WHEN duration_ms <> 0 THEN play_time_ms / duration_ms END AS watch_ratio, is_forward AS is_share
FROM source_log""",
    ),
    "with_defaults": _with(
        ("dirty_log",), f"SELECT {LOOSE}, 1 AS is_click, 0 AS is_like, 0 AS is_share FROM dirty_log"
    ),
    "coerce_types": _with(
        ("dirty_log",),
        """
SELECT CAST(event_id AS VARCHAR) AS event_id, TRY_CAST(event_time AS TIMESTAMP) AS event_time, user_id, video_id,
       watch_time, duration, watch_ratio, coalesce(is_click, 1) AS is_click, is_like, is_share FROM dirty_log""",
    ),
    "coerce_predictions": _with(
        ("coerced",),
        f"""
SELECT video_id, window_start, window_end, views_count, unique_users, {_r("avg_watch_ratio")} AS avg_watch_ratio,
       growth_rate, engagement_count, {_r("hot_score")} AS hot_score, predicted_hot, hot_label FROM coerced""",
    ),
    "reconcile_labels": _with(
        ("coerced",),
        """
SELECT video_id, window_start, predicted_hot,
       CASE WHEN predicted_hot = 1 OR hot_label = 'HOT' THEN 'HOT' WHEN predicted_hot = 0 THEN 'NOT_HOT' ELSE hot_label END AS hot_label
FROM coerced""",
    ),
    "clean_strict": _with(
        ("dirty_log",),
        """
SELECT TRY_CAST(event_time AS TIMESTAMP) AS event_time, user_id, video_id, watch_time, duration,
       watch_time / duration AS watch_ratio, is_click, is_like, is_share
FROM dirty_log WHERE user_id IS NOT NULL AND video_id IS NOT NULL AND duration > 0 AND watch_time >= 0
  AND watch_time <= duration""",
    ),
    "csv_clean_strict": _with(
        ("dirty_log",),
        """
SELECT TRY_CAST(event_time AS TIMESTAMP) AS event_time, user_id, video_id, watch_time, duration,
       watch_time / duration AS watch_ratio, is_click, is_like, is_share
FROM dirty_log WHERE user_id IS NOT NULL AND video_id IS NOT NULL AND duration > 0 AND watch_time >= 0
  AND watch_time <= duration""",
    ),
    "csv_published": _with(("video_log",), "SELECT * FROM video_log"),
    "clean_strict_text": _with(
        ("dirty_log",),
        """
SELECT TRY_CAST(event_time AS TIMESTAMP) AS event_time, user_id, video_id, watch_time, duration,
       watch_time / duration AS watch_ratio, is_click, is_like, is_share
FROM dirty_log WHERE user_id IS NOT NULL AND video_id IS NOT NULL AND duration > 0 AND watch_time >= 0
  AND watch_time <= duration""",
    ),
    "clean_loose": _with(
        ("source_log",),
        """
SELECT DISTINCT make_timestamp(time_ms * 1000) AS event_time, user_id, video_id, least(play_time_ms, duration_ms) / 1000.0::DOUBLE AS watch_time,
       duration_ms / 1000.0::DOUBLE AS duration, (least(play_time_ms, duration_ms) / 1000.0::DOUBLE) / (duration_ms / 1000.0::DOUBLE) AS watch_ratio,
       1 AS is_click, 0 AS is_like, 0 AS is_share
FROM source_log WHERE event_id % 101 <> 0 AND duration_ms > 0""",
    ),
    "to_messages_rejects": _with(("video_log",), "SELECT event_id FROM video_log WHERE event_id % 97 <> 0"),
    "quantile_special_values": "SELECT " + ", ".join(
        f"CAST(round(quantile_cont(price, {q}), 4) AS DOUBLE) AS q{int(1000 * q)}" for q in (0.0, 0.25, 0.5, 0.95, 1.0)
    ) + """
FROM (SELECT CASE WHEN o_orderkey % 97 = 0 THEN 'NaN'::DOUBLE WHEN o_orderkey % 89 = 0 THEN 'inf'::DOUBLE
                  WHEN o_orderkey % 83 = 0 THEN '-inf'::DOUBLE ELSE o_totalprice END AS price FROM orders)""",
    "rank_many_ranges": "SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS place FROM orders",
    "hot_quantile_approx": _with(
        ("predictions",),
        f"""
SELECT any_value(n) AS rows, {_r("max(hot_score) FILTER (place = greatest(1, 989 * n // 1000))")} AS low,
       {_r("max(hot_score) FILTER (place = least(n, (991 * n + 999) // 1000))")} AS high, true AS within
FROM (SELECT hot_score, row_number() OVER (ORDER BY hot_score) AS place, count(*) OVER () AS n FROM predictions)""",
    ),
    "hot_max_approx": _with(
        ("predictions",),
        f"""
SELECT count(*) AS rows, count(*) FILTER (score > high) AS hot_above, count(*) FILTER (score < low) AS other_below
FROM (SELECT score, max(score) FILTER (place = greatest(1, 989 * n // 1000)) OVER () AS low,
             max(score) FILTER (place = least(n, (991 * n + 999) // 1000)) OVER () AS high
      FROM (SELECT {_r("hot_score")} AS score, row_number() OVER (ORDER BY hot_score) AS place, count(*) OVER () AS n FROM predictions))""",
    ),
    "clean_clamp": _with(
        ("dirty_log",),
        """
SELECT DISTINCT TRY_CAST(event_time AS TIMESTAMP) AS event_time, user_id, video_id, least(watch_time, duration) AS watch_time,
       duration, least(watch_time, duration) / duration AS watch_ratio, coalesce(is_click, 1) AS is_click, is_like, is_share
FROM dirty_log WHERE TRY_CAST(event_time AS TIMESTAMP) IS NOT NULL AND user_id IS NOT NULL AND video_id IS NOT NULL
  AND watch_time >= 0 AND duration > 0""",
    ),
    "clamp_drain": _with(
        ("dirty_log",),
        """
SELECT DISTINCT TRY_CAST(event_time AS TIMESTAMP) AS event_time, user_id, video_id, least(watch_time, duration) AS watch_time,
       duration, least(watch_time, duration) / duration AS watch_ratio, coalesce(is_click, 1) AS is_click, is_like, is_share
FROM dirty_log WHERE TRY_CAST(event_time AS TIMESTAMP) IS NOT NULL AND user_id IS NOT NULL AND video_id IS NOT NULL
  AND watch_time >= 0 AND duration > 0""",
    ),
    "clean_feature_input": _with(("feature_log",), f"SELECT {LOG} FROM feature_log"),
    "dedup_logs": _with(("dirty_log",), f"SELECT DISTINCT {LOG} FROM dirty_log"),
    "video_features": _with(("half_hour_features",), f"SELECT {FEATURES} FROM half_hour_features"),
    "video_features_split": _with(
        ("split_features",),
        f"SELECT {FEATURES}, like_count, share_count, previous_views"
        " FROM (SELECT *, like_count + share_count AS engagement_count FROM split_features)",
    ),
    "video_features_big": _with(("big_features",), f"SELECT {FEATURES} FROM big_features"),
    "unique_users": _with(("day_cells",), "SELECT video_id, window_start, views_count, unique_users FROM day_cells"),
    "growth_rate": _with(("features",), "SELECT video_id, window_start, views_count, growth_rate FROM features"),
    "growth_drain": _with(
        ("features",),
        """
SELECT video_id, window_start, views_count, growth_rate FROM features
WHERE window_end <= (SELECT max(event_time) - INTERVAL 10 MINUTE FROM strict_log)""",
    ),
    "unique_users_rollup": _with(("day_cells",), "SELECT video_id, window_start, views_count, unique_users FROM day_cells"),
    "video_features_rollup": _with(("big_features",), f"SELECT {FEATURES} FROM big_features"),
    "hot_incremental": _with(("predictions",), f"SELECT {PREDICTIONS} FROM predictions"),
    "top_features": _with(
        ("features",),
        f"SELECT {FEATURES} FROM features ORDER BY views_count DESC, features.growth_rate DESC, video_id, window_start LIMIT 20",
    ),
    "score_maxima": _with(("maxima",), "SELECT * FROM maxima"),
    "hot_max_p99": _with(("predictions",), f"SELECT {PREDICTIONS} FROM predictions"),
    "hot_minmax_p99": _with(("minmax_predictions",), f"SELECT {PREDICTIONS} FROM minmax_predictions"),
    "hot_minmax_static": _with(("static_predictions",), f"SELECT {PREDICTIONS} FROM static_predictions"),
    "hot_quantiles": _with(
        ("predictions",),
        f"""
SELECT {_r("quantile_cont(hot_score, 0.99)")} AS p99_all,
       {_r("quantile_cont(hot_score, 0.95) FILTER (hot_label <> 'HOT')")} AS p95_not_hot FROM predictions""",
    ),
    "all_hot": _with(("predictions",), f"SELECT {HOT} FROM predictions WHERE hot_label = 'HOT'"),
    "top_hot": _with(("predictions",), f"SELECT {HOT} FROM predictions WHERE hot_label = 'HOT' {BEST} LIMIT 20"),
    "top_any": _with(
        ("minmax_predictions",),
        f"SELECT {HOT} FROM minmax_predictions {BEST} LIMIT 20".replace("predictions.hot", "minmax_predictions.hot"),
    ),
    "cache_rank": _with(("decided",), "SELECT video_id, window_start, cache_rank FROM decided"),
    "cache_recommendation": _with(
        ("decided",),
        f"""
SELECT video_id, window_start, window_end, views_count, unique_users, {_r("avg_watch_ratio")} AS avg_watch_ratio,
       growth_rate, engagement_count, {_r("hot_score")} AS hot_score, predicted_hot, hot_label, cache_rank,
       cache_priority, cache_decision, reason FROM decided""",
    ),
    "cache_kpis": _with(("kpis",), _kpi_union()),
    "kpi_percent": _with(
        ("kpis",),
        f"""
SELECT 'Cache Hit Ratio' AS metric, {_r("cache_hit_ratio * 100")} AS percent FROM kpis
UNION ALL SELECT 'Origin Request Reduction', {_r("origin_request_reduction * 100")} FROM kpis
UNION ALL SELECT 'Latency Reduction', {_r("latency_reduction_percent * 100")} FROM kpis""",
    ),
    "hits_and_misses": _with(
        ("kpis",),
        """
SELECT 'Cache Hits' AS type, cache_hits AS requests FROM kpis
UNION ALL SELECT 'Cache Misses', cache_misses FROM kpis""",
    ),
    "latency_comparison": _with(
        ("kpis",),
        f"""
SELECT 'Without Cache' AS scenario, {_r("average_latency_without_cache")} AS latency_ms FROM kpis
UNION ALL SELECT 'With Cache', {_r("average_latency_with_cache")} FROM kpis""",
    ),
    "top_decided": _with(
        ("decided",),
        f"""
SELECT video_id, window_start, {_r("hot_score")} AS hot_score
FROM decided WHERE cache_decision = 'CACHE' ORDER BY cache_rank LIMIT 20""",
    ),
    "label_counts": _with(
        ("decided",),
        "\nUNION ALL ".join(
            f"""SELECT '{c}' AS "column", {c} AS value, count(*) AS rows FROM decided GROUP BY 1, 2"""
            for c in ("hot_label", "cache_decision", "cache_priority")
        ),
    ),
    "run_summary": _with(
        ("decided", "features"),
        """
SELECT 'feature_rows' AS item, count(*) AS value FROM features
UNION ALL SELECT 'sum_views_count', CAST(sum(views_count) AS BIGINT) FROM features
UNION ALL SELECT 'prediction_rows', count(*) FROM predictions
UNION ALL SELECT 'cache_rows', count(*) FROM decided
UNION ALL SELECT 'hot_label=' || hot_label, count(*) FROM predictions GROUP BY 1
UNION ALL SELECT 'cache_decision=' || cache_decision, count(*) FROM decided GROUP BY 1""",
    ),
    "cache_policy": _with(("policy",), f"SELECT {POLICY} FROM policy"),
    "top_cached": _with(
        ("predictions",), f"SELECT {POLICY} FROM predictions WHERE hot_label = 'HOT' {BEST} LIMIT 20"
    ),
    "top_videos": _with(("best_videos",), f"SELECT {POLICY} FROM best_videos"),
    "serve_requests": _with(
        ("served",),
        f"SELECT * EXCLUDE (event_time) REPLACE ({_r('hot_score')} AS hot_score) FROM served",
    ),
    "miss_pool": _with(
        ("policy",), "SELECT DISTINCT video_id FROM video_log WHERE video_id NOT IN (SELECT video_id FROM policy)"
    ),
    "request_stats": _with(
        ("served",),
        f"""{_outcome("served")}, {_span("CACHE_HIT")} AS cache_latency_range_ms,
       {_span("CACHE_MISS")} AS origin_latency_range_ms,
       (SELECT count(*) FROM predictions WHERE hot_label = 'HOT') AS hot_video_window_records,
       (SELECT count(*) FROM policy) AS cached_unique_videos FROM served""",
    ),
    "running_stats": _with(
        ("served",),
        f"SELECT event_id + 1 AS request_id, status, latency_ms, {_running('event_id')} FROM served",
    ),
    "running_stats_drain": _with(
        ("served",),
        f"SELECT event_id + 1 AS request_id, status, latency_ms, {_running('event_id')} FROM served",
    ),
    "replay_policy": _with(
        ("served",),
        f"""
SELECT * REPLACE ({_r("hot_score")} AS hot_score), row_number() OVER (ORDER BY event_time, event_id) AS request_id,
       {_running("event_time, event_id")} FROM served""",
    ),
    "stratified_requests": _with(("mixed",), "SELECT event_id, video_id, draw_id FROM mixed"),
    "viral_requests": _with(("viral",), "SELECT event_id, video_id, draw_id FROM viral"),
    "sample_n": _with(
        ("video_log",),
        f"SELECT * EXCLUDE (watch_ratio) FROM video_log ORDER BY {_md5('event_id')}, event_id LIMIT 2500",
    ),
    "sample_keys": _with(("trend_videos",), "SELECT video_id FROM trend_videos"),
    "trend_rows": _with(("trend",), "SELECT event_id, video_id FROM trend"),
    "sample_replace": _with(
        ("video_log",),
        f"""
SELECT t.event_time, t.event_id, t.video_id, d.draw_id
FROM (SELECT i AS draw_id, {_draw("i", 15)} % (SELECT count(*) FROM video_log) + 1 AS row
      FROM range(20000) r(i) WHERE i < (SELECT count(*) FROM video_log)) d
JOIN (SELECT *, row_number() OVER (ORDER BY event_time, event_id) AS row FROM video_log) t USING (row)""",
    ),
    "inject_trend": _with(
        ("injected",),
        """
SELECT event_id, event_time, video_id, watch_time FROM video_log
UNION ALL SELECT event_id, event_time, video_id, watch_time FROM injected""",
    ),
    "trend_union": _with(
        ("injected",),
        """
SELECT video_id, count(*) AS rows, CAST(sum(added) AS BIGINT) AS added_rows
FROM (SELECT video_id, 0 AS added FROM video_log UNION ALL SELECT video_id, 1 FROM injected) GROUP BY 1""",
    ),
    "table_counts": "\nUNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS rows, {n} AS columns FROM {t}"
        for t, n in {"events": 6, "customer": 5, "orders": 6, "part": 6, "lineitem": 11}.items()
    ),
    "describe_numeric": f"""{_describe("orders", "o_totalprice")}\nUNION ALL {_describe("orders", "o_custkey")}""",
    "describe_text": "\nUNION ALL ".join(
        [
            _text_profile("o_orderstatus"),
            _text_profile("o_orderpriority"),
            _text_profile("o_orderdate", "(SELECT CAST(o_orderdate AS DATE) AS o_orderdate FROM orders)"),
        ]
    ),
    "describe_text_keys": "\nUNION ALL ".join(
        _text_profile(c, "(SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,"
                      " CASE WHEN o_orderkey % 4 > 0 THEN CAST(o_custkey AS VARCHAR) ELSE '-1' END AS often FROM orders)")
        for c in ("o_orderkey", "o_custkey", "often")
    ),
    "top_many": """
SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem
ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber LIMIT 40000""",
    "null_profile": _with(
        ("dirty_log",),
        "SELECT * FROM (" + "\nUNION ALL ".join(
            f"""SELECT '{c}' AS "column", count(*) FILTER ({c} IS NULL) AS nulls FROM dirty_log"""
            for c in ["event_id", *LOG.split(", ")]
        ) + ") WHERE nulls > 0",
    ),
    "duplicate_profile": _with(
        ("dirty_log",),
        f"""
SELECT CAST(sum(n) AS BIGINT) AS rows, CAST(sum(n - 1) AS BIGINT) AS duplicates,
       {_r("CAST(sum(n - 1) AS DOUBLE) * 100.0::DOUBLE / sum(n)", 2)} AS percent
FROM (SELECT count(*) AS n FROM dirty_log GROUP BY event_id, {LOG})""",
    ),
    "ratio_profile": _with(
        ("source_log",),
        _describe(
            "(SELECT CASE WHEN duration_ms <> 0 THEN play_time_ms / duration_ms END AS watch_ratio_raw FROM source_log)",
            "watch_ratio_raw",
            6,
            ", count(*) FILTER (watch_ratio_raw > 1) AS over_one, count(*) FILTER (watch_ratio_raw IS NULL) AS null_ratio",
        ),
    ),
    "histogram": _with(
        ("source_log",),
        _histogram(
            """(SELECT least(CAST(play_time_ms AS DOUBLE), (SELECT quantile_cont(play_time_ms, 0.99) FROM source_log)) AS v
                FROM source_log)""",
            50,
        ),
    ),
    "ratio_histogram": _with(
        ("source_log",),
        _histogram(
            """(SELECT greatest(least(play_time_ms / duration_ms, 2.0::DOUBLE), 0.0::DOUBLE) AS v
                FROM source_log WHERE duration_ms <> 0)""",
            60,
        ),
    ),
    "interaction_rates": _with(
        ("source_log",),
        "\nUNION ALL ".join(
            f"SELECT '{c}' AS flag, {_r(f"avg({c}) * 100", 2)} AS percent FROM source_log"
            for c in ("is_click", "is_like", "is_forward")
        ),
    ),
    "time_range": _with(
        ("source_log",),
        "SELECT make_timestamp(min(time_ms) * 1000) AS first_event, make_timestamp(max(time_ms) * 1000) AS last_event FROM source_log",
    ),
    "events_per_day": _with(
        ("video_log",), "SELECT CAST(event_time AS DATE) AS day, count(*) AS events FROM video_log GROUP BY 1"
    ),
    "category_counts": "SELECT c_mktsegment, count(*) AS rows FROM customer GROUP BY 1",
}

ORACLE_SQL["silver_rewritten_drain"] = ORACLE_SQL["silver_drain"]
