"""The same queries as SQL over the same tables, written for DuckDB.

Derives the typing events column by column, without the JSON in between, so
that encoding and parsing are checked as well.
"""

from __future__ import annotations

from .registry import STAMP

TYPED = """
te AS (
  SELECT
    CASE event_type WHEN 'click' THEN 'KEYSTROKE' WHEN 'view' THEN 'TEST_START'
      WHEN 'signup' THEN 'SESSION_START' WHEN 'purchase' THEN 'TEST_COMPLETE'
      ELSE CASE WHEN k < 50 THEN 'TEST_TIMEOUT' ELSE 'TEST_RESTART' END END AS "eventType",
    concat('u', CAST(user_id * 4 + k % 4 AS VARCHAR)) AS "userId",
    strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') AS "timestamp",
    md5(concat_ws('|', CAST(event_id AS VARCHAR), event_type)) AS event_id,
    CASE WHEN event_type = 'click' AND k % 20 <> 7 THEN CAST(100 - k % 40 AS INT) END AS accuracy,
    CASE WHEN event_type = 'click' AND k % 10 <> 9
      THEN CAST(floor(value + 0.5) AS INT) END AS wpm,
    CASE WHEN event_type = 'click'
      THEN CAST(floor((1 + k) * (100 - k % 40) / 100.0) AS INT) END AS correct,
    CASE WHEN event_type = 'click' THEN CAST(1 + k AS INT) END AS total,
    CASE WHEN event_type = 'purchase' OR (event_type = 'error' AND k < 50)
      THEN CAST(floor(value + 0.5) AS INT) END AS "finalWPM",
    CASE WHEN event_type = 'purchase' OR (event_type = 'error' AND k < 50)
      THEN CAST(100 - k % 40 AS INT) END AS "finalAccuracy",
    CASE WHEN event_type = 'view' THEN concat('passage ', CAST(k % 7 AS VARCHAR)) END AS quote,
    CASE WHEN event_type <> 'purchase'
      THEN CAST(epoch_us(ts) // 1000 AS DOUBLE) END AS data_timestamp,
    ts
  FROM (SELECT *, CAST(json_extract(props, '$.k') AS INT) AS k FROM events)
)"""

STATS = (
    TYPED
    + """,
st AS (
  SELECT "userId", avg(wpm) AS avg_wpm, avg(accuracy) AS avg_accuracy,
    count(*) AS keystroke_count, stddev_samp(wpm) AS wpm_variance
  FROM te WHERE "eventType" = 'KEYSTROKE' AND wpm IS NOT NULL
  GROUP BY "userId" HAVING count(*) > 2
),
pop AS (
  SELECT count(*) AS users, coalesce(avg(avg_wpm), 0) AS population_mean,
    coalesce(nullif(stddev_samp(avg_wpm), 0), 10) AS population_stddev
  FROM st
)"""
)


LEVEL = """CASE WHEN avg_wpm >= 60 THEN '🏆 EXPERT' WHEN avg_wpm >= 40 THEN '👍 INTERMEDIATE'
    WHEN avg_wpm >= 20 THEN '📚 BEGINNER' ELSE '🎯 PRACTICE NEEDED' END"""
TREND = """CASE WHEN avg_wpm >= 50 THEN '🚀 FAST TYPIST' WHEN avg_wpm >= 30 THEN '👍 MODERATE'
    ELSE '📚 LEARNING' END"""
BAND = """CASE WHEN NOT population_mean > 0 THEN '⭐ FIRST TEST'
    WHEN avg_wpm > population_mean + population_stddev THEN '🏆 TOP 10%'
    WHEN avg_wpm > population_mean THEN '📈 ABOVE AVERAGE'
    WHEN avg_wpm > population_mean - population_stddev THEN '📊 AVERAGE'
    ELSE '🎯 NEEDS PRACTICE' END"""


REQUESTED = """SELECT "userId" FROM (SELECT DISTINCT "userId" FROM te)
    WHERE right("userId", 1) <> '4'
  UNION ALL SELECT concat('x', "userId") FROM (SELECT DISTINCT "userId" FROM te)
    WHERE right("userId", 1) = '0'"""


def _tenths(x: str) -> str:
    """Round half to even at one decimal on the stored binary value."""
    scaled = f"(CAST(({x} - floor({x})) * CAST(144115188075855872 AS DOUBLE) AS BIGINT) * 10)"
    digit, rest = f"({scaled} >> 57)", f"({scaled} & 144115188075855871)"
    half = "72057594037927936"
    up = f"CASE WHEN {rest} > {half} OR ({rest} = {half} AND {digit} % 2 = 1) THEN 1 ELSE 0 END"
    return f"CAST(CAST(floor({x}) AS BIGINT) * 10 + {digit} + {up} AS DOUBLE) / CAST(10 AS DOUBLE)"


ISO_STAMP = STAMP.replace(" ", "T") + ".000Z"

RESULTS = (
    STATS
    + f""",
res AS (
  SELECT "userId", {_tenths("avg_wpm")} AS avg_wpm, {_tenths("avg_accuracy")} AS avg_accuracy,
    keystroke_count, {BAND} AS global_rank, {TREND} AS performance_trend,
    '{ISO_STAMP}' AS "timestamp"
  FROM st, pop
),
stored AS (
  SELECT "userId", coalesce(avg_wpm, 0) AS avg_wpm, coalesce(avg_accuracy, 0) AS avg_accuracy,
    keystroke_count AS total_keystrokes, global_rank, performance_trend,
    '{ISO_STAMP}' AS last_update
  FROM res WHERE "userId" <> ''
),
board AS (
  SELECT "userId" AS username, avg_wpm, avg_accuracy FROM stored
  WHERE avg_wpm > 0 ORDER BY avg_wpm DESC, username LIMIT 10
)"""
)

SESSIONS = (
    TYPED
    + """,
starts AS (
  SELECT "userId", "timestamp" AS start_time, event_id AS start_id FROM (
    SELECT *, row_number() OVER (
      PARTITION BY "userId" ORDER BY "timestamp" DESC, event_id DESC) AS n
    FROM te WHERE "eventType" = 'SESSION_START') WHERE n = 1
),
sess AS (
  SELECT "userId", start_time,
    max(CASE WHEN "eventType" = 'TEST_COMPLETE' THEN "timestamp" END) AS end_time,
    count(*) AS events_count
  FROM te JOIN starts USING ("userId")
  WHERE "timestamp" > start_time OR ("timestamp" = start_time AND event_id >= start_id)
  GROUP BY "userId", start_time
)"""
)

COUNTED = (
    TYPED
    + """,
seg AS (
  SELECT *, sum(CASE WHEN "eventType" IN ('SESSION_START', 'TEST_RESTART') THEN 1 ELSE 0 END)
    OVER (PARTITION BY "userId" ORDER BY "timestamp", event_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS segment
  FROM te
)"""
)

ATTEMPTS = """
attempts AS (
  SELECT doc_id, text AS quote, CAST(doc_id % 61 AS INT) AS elapsed,
    CASE doc_id % 5 WHEN 0 THEN text WHEN 1 THEN replace(text, 'e', '3')
      WHEN 2 THEN replace(text, ' ', '') WHEN 3 THEN concat(text, ' ', lang) ELSE '' END AS typed
  FROM documents
),
ch AS (
  SELECT *, string_split(typed, '') AS t, string_split(quote, '') AS q FROM attempts
),
cmp AS (
  SELECT doc_id, elapsed, CAST(length(typed) AS INT) AS total, CAST(length(quote) AS INT) AS len,
    CASE WHEN length(typed) = 0 THEN 0 ELSE CAST(len(list_filter(
      list_zip(t, q), lambda p: coalesce(p[1] = p[2], false))) AS INT) END AS correct
  FROM ch
)"""


def _with(ctes: str, select: str) -> str:
    return f"WITH {ctes.strip()}\n{select.strip()}"


EVENT_COLUMNS = (
    '"eventType", "userId", "timestamp", event_id, accuracy, wpm, correct, total, '
    '"finalWPM", "finalAccuracy", quote, data_timestamp'
)
STAT_COLUMNS = (
    '"userId", round(avg_wpm, 6) AS avg_wpm, round(avg_accuracy, 6) AS avg_accuracy, '
    "keystroke_count, round(wpm_variance, 6) AS wpm_variance"
)
LABELLED_STATS = _with(STATS, f"SELECT {STAT_COLUMNS}, {LEVEL} AS performance_level FROM st")
RESULT_ROWS = _with(RESULTS, "SELECT * FROM res")
BOARD_ROWS = _with(RESULTS, "SELECT * FROM board")
SESSION_ROWS = _with(SESSIONS, 'SELECT "userId", start_time, end_time, events_count FROM sess')
COUNTED_ROWS = _with(
    COUNTED,
    'SELECT "userId", event_id, "eventType", row_number() OVER (PARTITION BY "userId", segment '
    'ORDER BY "timestamp", event_id) AS event_no FROM seg',
)
_SCORES = (
    "SELECT doc_id, correct, total, "
    "CASE WHEN total > 0 THEN CAST(floor(correct / total * 100 + 0.5) AS INT) "
    "ELSE 100 END AS accuracy, "
    "CASE WHEN elapsed > 0 THEN CAST(floor((total / 5) / (elapsed / 60) + 0.5) AS INT) "
    "ELSE 0 END AS wpm FROM cmp"
)
_DEFAULTS = {
    "avg_wpm": "0",
    "avg_accuracy": "0",
    "total_keystrokes": "0",
    "global_rank": "'N/A'",
    "performance_trend": "'stable'",
}
_LOOKUP = ", ".join(
    f"CASE WHEN s.\"userId\" IS NULL THEN {d} ELSE s.{c} END AS {c}" for c, d in _DEFAULTS.items()
)
HEALTH = SESSIONS + "," + RESULTS[len(TYPED) + 1 :]

ORACLE: dict[str, str] = {
    "parse_events": _with(TYPED, f"SELECT {EVENT_COLUMNS} FROM te"),
    "keystrokes": _with(
        TYPED,
        "SELECT \"userId\", wpm, accuracy FROM te "
        "WHERE \"eventType\" = 'KEYSTROKE' AND wpm IS NOT NULL",
    ),
    "routed_events": _with(
        TYPED,
        'SELECT "eventType", "userId", "timestamp" FROM te '
        "WHERE \"eventType\" IN ('SESSION_START', 'TEST_COMPLETE')",
    ),
    "encode_events": _with(TYPED, f'SELECT "userId" AS key, {EVENT_COLUMNS} FROM te'),
    "enrich_events": _with(
        TYPED,
        'SELECT "eventType", "userId", '
        'md5(concat_ws(\'|\', "eventType", "userId", "timestamp")) AS event_id, '
        "strftime(ts + INTERVAL 1 SECOND, '%Y-%m-%dT%H:%M:%S.%gZ') AS server_timestamp FROM te",
    ),
    "event_times": _with(
        TYPED,
        "SELECT event_id, CAST(epoch_us(ts) // 1000 AS DOUBLE) AS event_millis, "
        'CASE WHEN data_timestamp IS NOT NULL THEN "timestamp" END AS payload_time FROM te',
    ),
    "test_outcomes": _with(
        TYPED,
        'SELECT "userId", "eventType", "finalWPM", "finalAccuracy" FROM te '
        "WHERE \"eventType\" IN ('TEST_COMPLETE', 'TEST_TIMEOUT')",
    ),
    "malformed_events": _with(
        TYPED,
        "SELECT CASE right(\"userId\", 1) WHEN '3' THEN 'malformed' ELSE 'empty' END AS reason, "
        "count(*) AS records FROM te WHERE right(\"userId\", 1) IN ('3', '7') GROUP BY 1",
    ),
    "user_stats": _with(STATS, f"SELECT {STAT_COLUMNS} FROM st"),
    "performance_level": _with(
        STATS,
        f'SELECT "userId", round(avg_wpm, 6) AS avg_wpm, {LEVEL} AS performance_level FROM st',
    ),
    "population_stats": _with(
        STATS,
        "SELECT users, round(population_mean, 6) AS population_mean, "
        "round(population_stddev, 6) AS population_stddev FROM pop",
    ),
    "global_rank": _with(STATS, f"SELECT {STAT_COLUMNS}, {BAND} AS global_rank FROM st, pop"),
    "performance_trend": _with(
        STATS,
        f'SELECT "userId", round(avg_wpm, 6) AS avg_wpm, {TREND} AS performance_trend FROM st',
    ),
    "result_records": RESULT_ROWS,
    "result_json": _with(RESULTS, 'SELECT "userId" AS key, * FROM res'),
    "stored_results": _with(RESULTS, "SELECT * FROM stored"),
    "latest_results": _with(
        TYPED,
        'SELECT "userId", day, round(avg_wpm, 6) AS avg_wpm, keystroke_count FROM ('
        'SELECT *, row_number() OVER (PARTITION BY "userId" ORDER BY day DESC) AS n FROM ('
        'SELECT "userId", CAST(CAST(ts AS DATE) AS VARCHAR) AS day, avg(wpm) AS avg_wpm, '
        "count(*) AS keystroke_count FROM te WHERE \"eventType\" = 'KEYSTROKE' "
        "AND wpm IS NOT NULL GROUP BY 1, 2)) WHERE n = 1",
    ),
    "leaderboard": BOARD_ROWS,
    "leaderboard_position": _with(
        RESULTS,
        "SELECT row_number() OVER (ORDER BY avg_wpm DESC, username) AS position, * FROM board",
    ),
    "leaderboard_snapshot": BOARD_ROWS,
    "lookup_with_default": _with(
        RESULTS,
        f'SELECT u."userId", {_LOOKUP}, s.last_update FROM ({REQUESTED}) u '
        'LEFT JOIN stored s ON u."userId" = s."userId"',
    ),
    "lookup_present": _with(
        RESULTS,
        'SELECT "userId", avg_wpm, avg_accuracy, total_keystrokes, global_rank, '
        f'performance_trend, last_update FROM stored WHERE "userId" IN ({REQUESTED})',
    ),
    "known_users": _with(
        RESULTS, f'SELECT "userId" FROM stored WHERE "userId" IN ({REQUESTED})'
    ),
    "health_counts": _with(
        HEALTH,
        "SELECT (SELECT count(*) FROM sess) AS active_sessions, "
        "(SELECT count(*) FROM stored) AS spark_analytics_count",
    ),
    "score_text": _with(ATTEMPTS, _SCORES),
    "char_status": _with(
        ATTEMPTS,
        "SELECT doc_id, status, chars FROM ("
        "SELECT doc_id, 'correct' AS status, CAST(correct AS BIGINT) AS chars FROM cmp UNION ALL "
        "SELECT doc_id, 'incorrect', CAST(least(total, len) - correct AS BIGINT) FROM cmp "
        "UNION ALL SELECT doc_id, 'pending', CAST(greatest(len - total, 0) AS BIGINT) FROM cmp"
        ") WHERE chars > 0",
    ),
    "completion": _with(
        ATTEMPTS,
        "SELECT doc_id, typed = quote AND elapsed < 60 AS is_complete, "
        "elapsed >= 60 AS is_timed_out, CAST(greatest(60 - elapsed, 0) AS INT) AS remaining, "
        "CAST(length(quote) AS INT) AS quote_length FROM attempts",
    ),
    "session_tracker": SESSION_ROWS,
    "session_tracker_salted": SESSION_ROWS,
    "event_counter": COUNTED_ROWS,
    "event_counter_sliced": COUNTED_ROWS,
    "stream_user_stats": LABELLED_STATS,
    "stream_result_records": RESULT_ROWS,
    "stream_leaderboard": BOARD_ROWS,
    "stream_stats_log": LABELLED_STATS,
    "stream_sessions": SESSION_ROWS,
    "stream_session_log": SESSION_ROWS,
    "stream_health": _with(
        HEALTH,
        "SELECT 'ended' AS status, false AS source_connected, "
        "(SELECT count(*) FROM sess) AS active_sessions, "
        "(SELECT count(*) FROM stored) AS spark_analytics_count",
    ),
}

#: UTF-16 units of a text as numbers.
_UNITS = """flatten(list_transform(string_split({}, ''), lambda c: CASE WHEN unicode(c) > 65535
      THEN [55296 + ((unicode(c) - 65536) // 1024), 56320 + (unicode(c) - 65536) % 1024]
      ELSE [unicode(c)] END))"""

ORACLE |= {
    "score_text_utf16": _with(
        ATTEMPTS.split("ch AS (")[0].rstrip().rstrip(",")
        + f""",
emoji AS (
  SELECT doc_id, elapsed, replace(quote, 'a', '😀') AS quote,
    replace(replace(typed, 'a', CASE WHEN doc_id % 2 = 0 THEN '😀' ELSE '😁' END), 'o', '🎹') AS typed
  FROM attempts
),
units AS (
  SELECT doc_id, elapsed,
    CASE WHEN typed = '' THEN [] ELSE {_UNITS.format("typed")} END AS t,
    {_UNITS.format("quote")} AS q
  FROM emoji
),
cmp AS (
  SELECT doc_id, elapsed, CAST(len(t) AS INT) AS total, CAST(len(list_filter(
    list_zip(t, q), lambda p: coalesce(p[1] = p[2], false))) AS INT) AS correct FROM units
)""",
        _SCORES,
    ),
    "char_status_runs": _with(
        ATTEMPTS,
        """, places AS (
  SELECT doc_id, unnest(range(0, len(q))) AS i, t, q FROM ch
), told AS (
  SELECT doc_id, i, CASE WHEN typed_n <= i THEN 'pending' WHEN t[i + 1] = q[i + 1] THEN 'correct'
    ELSE 'incorrect' END AS status
  FROM (SELECT *, CASE WHEN t = [''] THEN 0 ELSE len(t) END AS typed_n FROM places)
), marked AS (
  SELECT *, i - row_number() OVER (PARTITION BY doc_id, status ORDER BY i) AS island FROM told
)
SELECT doc_id, CAST(min(i) AS INT) AS start, CAST(count(*) AS INT) AS length, status
FROM marked GROUP BY doc_id, status, island""",
    ),
    "service_stats": ORACLE["user_stats"],
    "service_population": ORACLE["population_stats"],
    "service_results": RESULT_ROWS,
    "service_leaderboard": BOARD_ROWS,
    "service_lookup": ORACLE["lookup_with_default"],
    "service_unreadable": ORACLE["malformed_events"],
    "stream_event_counter": COUNTED_ROWS,
    "stream_sessions_in_order": SESSION_ROWS,
    "user_positions": _with(
        RESULTS,
        "SELECT row_number() OVER (ORDER BY avg_wpm DESC, \"userId\") AS position, "
        '"userId" AS username, avg_wpm, avg_accuracy FROM stored WHERE avg_wpm > 0',
    ),
}
