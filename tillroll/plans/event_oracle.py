"""The queries of ``event_catalog`` in SQL for an independent engine."""

from __future__ import annotations

_HOUR = "INTERVAL 1 HOUR"

_WINDOWED = f"""
  SELECT time_bucket({_HOUR}, ts) AS window_start, time_bucket({_HOUR}, ts) + {_HOUR} AS window_end,
         event_type, CAST(value AS DECIMAL(18,2)) AS value, *
         EXCLUDE (event_type, value)
"""

# A run's rows are late if their window had ended before the largest time of earlier runs less
# twelve hours, in whole milliseconds.
_LATE = f"""
WITH arrivals AS (
  SELECT *, (epoch_us(ts + to_hours(CASE WHEN event_id % 10 = 3 THEN event_id % 48 ELSE 0 END))
             // (6 * 86400000000)) AS run
  FROM events),
runs AS (
  SELECT run, max(max(epoch_ms(ts))) OVER (ORDER BY run ROWS BETWEEN UNBOUNDED PRECEDING
                AND 1 PRECEDING) - 12 * 3600000 AS mark
  FROM arrivals GROUP BY run),
judged AS (
  {_WINDOWED}, coalesce(epoch_ms(time_bucket({_HOUR}, ts) + {_HOUR}) <= mark, false) AS late
  FROM arrivals JOIN runs USING (run)),
closing AS (SELECT max(epoch_ms(ts)) - 12 * 3600000 AS mark FROM events)
SELECT window_start, window_end, event_type, count(*) FILTER (WHERE NOT late) AS events,
       CAST(sum(value) FILTER (WHERE NOT late) AS DECIMAL(28,2)) AS total,
       count(*) FILTER (WHERE late) AS late
FROM judged, closing WHERE epoch_ms(window_end) <= closing.mark
GROUP BY window_start, window_end, event_type
"""

_SESSIONS = """
WITH marked AS (
  SELECT user_id, ts, CAST(value AS DECIMAL(18,2)) AS value,
         coalesce(ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) > INTERVAL 6 HOUR, true)
           AS opens FROM events WHERE ts IS NOT NULL),
numbered AS (
  SELECT *, sum(CAST(opens AS INTEGER)) OVER (PARTITION BY user_id ORDER BY ts
    ROWS UNBOUNDED PRECEDING) AS n FROM marked),
sessions AS (
  SELECT user_id, min(ts) AS session_start, max(ts) AS session_end, count(*) AS events,
         CAST(sum(value) AS DECIMAL(38,2)) AS total FROM numbered GROUP BY user_id, n)
"""

def _sessions(hours: int) -> str:
    return _SESSIONS.replace("INTERVAL 6 HOUR", f"INTERVAL {hours} HOUR")


def _event_time(date: str) -> str:
    days = f"date_diff('day', DATE '1995-01-01', CAST({date} AS DATE))"
    return f"(TIMESTAMP '2024-01-01' + to_minutes(12 * {days}))"


ORACLE_SQL = {
    "event_windows": f"""
SELECT window_start, window_end, event_type, count(*) AS events,
       CAST(sum(value) AS DECIMAL(28,2)) AS total
FROM ({_WINDOWED} FROM events) GROUP BY ALL""",
    "event_windows_late": _LATE,
    "user_sessions": f"{_SESSIONS} SELECT * FROM sessions",
    # Final are those whose end and gap lie before the largest time less an hour.
    "user_sessions_stream": f"""{_SESSIONS}
SELECT sessions.* FROM sessions, (SELECT max(epoch_ms(ts)) - 3600000 AS mark FROM events)
WHERE epoch_ms(session_end) + 6 * 3600000 <= mark""",
    "asof_last_event": f"""
WITH moments AS (
  SELECT o_orderkey, o_custkey AS user_id, {_event_time("o_orderdate")} AS moment FROM orders)
SELECT o_orderkey, m.user_id, moment, event_id, event_type, ts
FROM moments m ASOF LEFT JOIN events e ON m.user_id = e.user_id AND m.moment > e.ts""",
    "asof_recent_purchase": """
WITH bought AS (
  SELECT user_id, ts AS purchased, event_id AS purchase_id, value AS purchase_value
  FROM events WHERE event_type = 'purchase'),
found AS (
  SELECT e.event_id, e.user_id, e.ts, purchase_id, purchased, purchase_value,
         coalesce(e.ts - purchased <= INTERVAL 7 DAY, false) AS near
  FROM events e ASOF LEFT JOIN bought b ON e.user_id = b.user_id AND e.ts >= b.purchased)
SELECT event_id, user_id, ts, CASE WHEN near THEN purchase_id END AS purchase_id,
       CASE WHEN near THEN purchased END AS purchased,
       CASE WHEN near THEN purchase_value END AS purchase_value
FROM found""",
    "interval_campaigns": f"""
WITH shipments AS (
  SELECT {_event_time("o_orderdate")} AS s, {_event_time("l_shipdate")} AS e
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
campaigns AS (
  SELECT event_type, CAST(ts AS DATE) AS day, min(ts) AS s, max(ts) AS e FROM events GROUP BY 1, 2)
SELECT event_type, day, count(*) AS shipments,
       CAST(sum(epoch_us(least(a.e, c.e)) - epoch_us(greatest(a.s, c.s))) AS DECIMAL(38,0)) AS micros
FROM campaigns c JOIN shipments a ON a.s < c.e AND c.s < a.e
WHERE a.s < a.e AND c.s < c.e GROUP BY 1, 2""",
    "sketch_weeks": """
SELECT CAST(date_trunc('week', ts) AS DATE) AS first_day,
       CAST(date_trunc('week', ts) AS DATE) + 6 AS last_day, count(*) AS events,
       count(DISTINCT user_id) AS exact_items, true AS items_close, true AS quantiles_close
FROM events WHERE ts IS NOT NULL GROUP BY 1, 2""",
    "event_props": """
SELECT event_id, ts, user_id, event_type, value, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
       CAST(len(json_keys(props)) - 1 AS INTEGER) AS rest, NOT json_valid(props) AS unreadable
FROM events""",
    "interval_sessions": f"""{_sessions(2)}
SELECT a.user_id AS a_user_id, b.user_id AS b_user_id,
       greatest(a.session_start, b.session_start) AS overlap_start,
       least(a.session_end, b.session_end) AS overlap_end
FROM sessions a JOIN sessions b ON a.user_id < b.user_id AND a.user_id % 10 = b.user_id % 10
  AND a.session_start < b.session_end AND b.session_start < a.session_end
WHERE a.session_start < a.session_end AND b.session_start < b.session_end""",
}
