"""DuckDB oracle SQL: the expected results computed straight from the driver's tables.

The generated games (see :mod:`chesstally.testing.fixtures`) follow rules on ``lineitem``
columns; these queries apply the *meaning* of those rules (which month, opening group, buckets
and result each game must get) without any PGN text, so the Spark and DuckDB sides are
independent. Only the fixed opening-group table is shared, entered here as a ``VALUES`` list
joined by ``BETWEEN`` (a range join, where the Spark side uses an equi-join on codes).
"""

from __future__ import annotations

from chesstally.functions.eco import eco_ranges


def _eco_values() -> str:
    return ", ".join(f"({lo}, {hi}, '{label}')" for lo, hi, label in eco_ranges())


def _bucket(expr: str, size: int) -> str:
    return "0" if size == 0 else f"({expr}) // {size} * {size}"


def game_rows_sql(bucket_size: int = 200) -> str:
    """One row per game: month, eco_group, white/black bucket, r (0 white win, 1 black win,
    2 draw, else uncounted)."""
    white = f"1400 + CAST(floor(l_extendedprice) AS BIGINT) % 600"
    black = "1400 + (l_partkey * 37) % 600"
    return f"""
    SELECT
      CASE WHEN l_orderkey % 7 <> 0 AND (l_orderkey % 11 = 0 OR l_orderkey % 23 = 1)
           THEN 'unknown' ELSE strftime(l_shipdate, '%Y-%m') END AS month,
      coalesce(eco.label, 'U00') AS eco_group,
      CAST(CASE WHEN l_suppkey % 19 = 0 THEN 0 ELSE {_bucket(white, bucket_size)} END AS INTEGER)
        AS white_bucket,
      CAST(CASE WHEN l_partkey % 23 = 0 OR l_suppkey % 29 = 0 THEN 0
                ELSE {_bucket(black, bucket_size)} END AS INTEGER) AS black_bucket,
      (l_orderkey + l_linenumber) % 5 AS r,
      strftime(l_shipdate, '%Y-%m') AS source_month
    FROM lineitem
    LEFT JOIN (VALUES {_eco_values()}) AS eco(lo, hi, label)
      ON l_orderkey % 13 <> 0 AND l_partkey % 17 <> 0
     AND (l_orderkey % 5) * 100 + (l_partkey * 7 + l_linenumber) % 100 BETWEEN eco.lo AND eco.hi
    """


def aggregate_sql(bucket_size: int = 200, scale: int = 1) -> str:
    mult = "" if scale == 1 else f" * {scale}"
    return f"""
    SELECT month, eco_group, white_bucket, black_bucket,
           CAST(count(*){mult} AS BIGINT) AS games,
           CAST(count(*) FILTER (WHERE r = 0){mult} AS BIGINT) AS white_wins,
           CAST(count(*) FILTER (WHERE r = 1){mult} AS BIGINT) AS black_wins,
           CAST(count(*) FILTER (WHERE r = 2){mult} AS BIGINT) AS draws
    FROM ({game_rows_sql(bucket_size)}) g
    GROUP BY month, eco_group, white_bucket, black_bucket
    """


AGG = aggregate_sql()

# SQL a user of the original database would run, unchanged (also the oracle's statement).
SQL_OPENING_RESULTS = """
SELECT eco_group,
       CAST(sum(games) AS BIGINT) AS games,
       CAST(sum(white_wins) AS BIGINT) AS white_wins,
       CAST(sum(draws) AS BIGINT) AS draws,
       CAST(count(DISTINCT month) AS BIGINT) AS months
FROM aggregates
WHERE white_bucket >= 1400 AND black_bucket >= 1400
GROUP BY eco_group
"""


def _per_source_month_sql() -> str:
    return f"""
    SELECT source_month, month, eco_group, white_bucket, black_bucket,
           CAST(count(*) AS BIGINT) AS games,
           CAST(count(*) FILTER (WHERE r = 0) AS BIGINT) AS white_wins,
           CAST(count(*) FILTER (WHERE r = 1) AS BIGINT) AS black_wins,
           CAST(count(*) FILTER (WHERE r = 2) AS BIGINT) AS draws
    FROM ({game_rows_sql()}) g
    GROUP BY source_month, month, eco_group, white_bucket, black_bucket
    """


_LETTER = "substr('ABCDE', CAST(l_orderkey % 5 AS INTEGER) + 1, 1)"
_CODE_AS_WRITTEN = (f"(CASE WHEN l_orderkey % 3 = 0 THEN lower({_LETTER}) ELSE {_LETTER} END"
                    " || lpad(CAST((l_partkey * 7 + l_linenumber) % 100 AS VARCHAR), 2, '0'))")
_CODE = f"({_LETTER} || lpad(CAST((l_partkey * 7 + l_linenumber) % 100 AS VARCHAR), 2, '0'))"
_WHITE_N = "CAST(1400 + CAST(floor(l_extendedprice) AS BIGINT) % 600 AS VARCHAR)"

HEADER_TAGS = f"""
SELECT utc_date, date, eco, white_elo, black_elo, result, CAST(count(*) AS BIGINT) AS games
FROM (
  SELECT
    CASE WHEN l_orderkey % 7 = 0 THEN NULL
         WHEN l_orderkey % 11 = 0 THEN '????.??.??'
         WHEN l_orderkey % 23 = 1 THEN ''
         ELSE strftime(l_shipdate, '%Y.%m.%d') END AS utc_date,
    strftime(l_shipdate, '%Y.%m.%d') AS date,
    CASE WHEN l_orderkey % 13 = 0 THEN NULL
         WHEN l_partkey % 17 = 0 THEN '?'
         WHEN l_linenumber = 3 THEN ' ' || {_CODE_AS_WRITTEN} || ' '
         ELSE {_CODE_AS_WRITTEN} END AS eco,
    CASE WHEN l_suppkey % 19 = 0 THEN '?'
         WHEN l_linenumber = 2 THEN '+' || {_WHITE_N}
         WHEN l_linenumber = 6 THEN lpad({_WHITE_N}, 22, '0')
         ELSE {_WHITE_N} END AS white_elo,
    CASE WHEN l_partkey % 23 = 0 THEN '70000'
         WHEN l_suppkey % 29 = 0 THEN ' 1500'
         ELSE CAST(1400 + (l_partkey * 37) % 600 AS VARCHAR) END AS black_elo,
    CASE (l_orderkey + l_linenumber) % 5
         WHEN 0 THEN '1-0' WHEN 1 THEN '0-1' WHEN 2 THEN '1/2-1/2'
         WHEN 3 THEN (CASE WHEN l_orderkey % 2 = 0 THEN ' 1-0' ELSE '*' END)
         ELSE NULL END AS result
  FROM lineitem) t
GROUP BY utc_date, date, eco, white_elo, black_elo, result
"""

MONTH_KEY = f"""
SELECT month, CAST(count(*) AS BIGINT) AS games FROM ({game_rows_sql()}) g GROUP BY month
"""

RESULT_CLASS = f"""
SELECT CASE r WHEN 0 THEN 'white' WHEN 1 THEN 'black' WHEN 2 THEN 'draw' ELSE 'other' END
         AS result_class,
       CAST(count(*) AS BIGINT) AS games
FROM ({game_rows_sql()}) g GROUP BY 1
"""

ECO_GROUP_LOOKUP = f"""
SELECT CASE WHEN l_orderkey % 13 = 0 OR l_partkey % 17 = 0 THEN NULL ELSE {_CODE} END AS eco_code,
       coalesce(eco.label, 'U00') AS eco_group,
       CAST(count(*) AS BIGINT) AS games
FROM lineitem
LEFT JOIN (VALUES {_eco_values()}) AS eco(lo, hi, label)
  ON l_orderkey % 13 <> 0 AND l_partkey % 17 <> 0
 AND (l_orderkey % 5) * 100 + (l_partkey * 7 + l_linenumber) % 100 BETWEEN eco.lo AND eco.hi
GROUP BY 1, 2
"""

ELO_BUCKET_200 = f"""
SELECT white_bucket, black_bucket, CAST(count(*) AS BIGINT) AS games
FROM ({game_rows_sql(200)}) g GROUP BY 1, 2
"""


def _custom_buckets_sql(sizes=(0, 100, 400)) -> str:
    parts = [f"""SELECT CAST({s} AS INTEGER) AS bucket_size, white_bucket, black_bucket,
                CAST(count(*) AS BIGINT) AS games
         FROM ({game_rows_sql(s)}) g GROUP BY 2, 3""" for s in sizes]
    return "\nUNION ALL\n".join(parts)


ELO_BUCKET_CUSTOM = _custom_buckets_sql()

GAME_SCAN_COUNT = """
SELECT strftime(l_shipdate, '%Y-%m') AS source_month, CAST(count(*) AS BIGINT) AS games
FROM lineitem GROUP BY 1
"""

TOTAL_GAMES = "SELECT CAST(count(*) AS BIGINT) AS games FROM lineitem"

_INDEX = """
SELECT o_orderkey % 10 AS v, strftime(o_orderdate, '%Y-%m') AS m FROM orders
"""


def plan_sql(since: str = "1996-03", until: str = "2000-10", pending: bool = False) -> str:
    extra = (f" AND m NOT IN (SELECT month FROM ({LEDGER_STATE}) s WHERE status = 'success')"
             if pending else "")
    return f"""
    SELECT m AS month,
           CASE WHEN v = 5 THEN 'https://mirror.example.net/' || m || '.pgn.zst'
                ELSE 'https://example.org/standard/games_rated_' || m || '.pgn.zst' END AS url
    FROM ({_INDEX}) l
    WHERE v NOT IN (2, 3, 4, 6) AND m >= '{since}' AND m <= '{until}'{extra}
    """


LEDGER_STATE = """
WITH e AS (
  SELECT strftime(o_orderdate, '%Y-%m') AS month, o_orderkey AS seq,
         CASE WHEN o_orderkey % 5 < 2 THEN 'start' ELSE 'finish' END AS kind,
         'https://example.org/standard/games_rated_' || strftime(o_orderdate, '%Y-%m')
           || '.pgn.zst' AS url,
         strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS event_at,
         o_custkey % 1000 AS games,
         CAST(floor(o_totalprice) AS BIGINT) AS duration_ms,
         CASE WHEN o_orderkey % 5 = 4 THEN 'failed' ELSE 'success' END AS fstatus
  FROM orders),
g AS (
  SELECT month,
         min(seq) FILTER (WHERE kind = 'start') AS first_start,
         max(seq) FILTER (WHERE kind = 'start') AS last_start,
         max(seq) FILTER (WHERE kind = 'finish') AS last_finish,
         arg_max(url, seq) FILTER (WHERE kind = 'start') AS url,
         arg_max(event_at, seq) FILTER (WHERE kind = 'start') AS started_at,
         arg_max(event_at, seq) FILTER (WHERE kind = 'finish') AS f_at,
         arg_max(games, seq) FILTER (WHERE kind = 'finish') AS f_games,
         arg_max(duration_ms, seq) FILTER (WHERE kind = 'finish') AS f_dur,
         arg_max(fstatus, seq) FILTER (WHERE kind = 'finish') AS f_status
  FROM e GROUP BY month)
SELECT month, url, started_at,
       CASE WHEN last_finish > first_start THEN f_at END AS finished_at,
       CAST(CASE WHEN last_finish > first_start THEN f_games ELSE 0 END AS BIGINT) AS games,
       CAST(CASE WHEN last_finish > first_start THEN f_dur ELSE 0 END AS BIGINT) AS duration_ms,
       CASE WHEN last_finish > last_start THEN f_status ELSE 'started' END AS status
FROM g WHERE first_start IS NOT NULL
"""

OPENING_POPULARITY = f"""
WITH a AS ({AGG}),
p AS (SELECT month, eco_group, CAST(sum(games) AS BIGINT) AS games FROM a GROUP BY 1, 2)
SELECT month, eco_group, games,
       CAST(games AS DOUBLE) / CAST(sum(games) OVER (PARTITION BY month) AS DOUBLE) AS share
FROM p
"""

RESULT_RATES = f"""
WITH a AS ({AGG}),
s AS (SELECT eco_group, CAST(sum(games) AS BIGINT) AS games,
             CAST(sum(white_wins) AS BIGINT) AS white_wins,
             CAST(sum(black_wins) AS BIGINT) AS black_wins,
             CAST(sum(draws) AS BIGINT) AS draws
      FROM a GROUP BY 1)
SELECT eco_group, games, white_wins, black_wins, draws,
       CAST(white_wins AS DOUBLE) / CAST(games AS DOUBLE) AS white_rate,
       CAST(black_wins AS DOUBLE) / CAST(games AS DOUBLE) AS black_rate,
       CAST(draws AS DOUBLE) / CAST(games AS DOUBLE) AS draw_rate,
       CAST(white_wins + black_wins AS DOUBLE) / CAST(games AS DOUBLE) AS decisive_rate
FROM s
"""

ELO_PERFORMANCE = f"""
WITH a AS ({AGG}),
s AS (SELECT white_bucket, black_bucket, CAST(sum(games) AS BIGINT) AS games,
             CAST(sum(white_wins) AS BIGINT) AS white_wins,
             CAST(sum(black_wins) AS BIGINT) AS black_wins,
             CAST(sum(draws) AS BIGINT) AS draws
      FROM a GROUP BY 1, 2)
SELECT white_bucket, black_bucket, CAST(white_bucket - black_bucket AS INTEGER) AS gap,
       games, white_wins, black_wins, draws,
       CASE WHEN white_wins + black_wins + draws = 0 THEN NULL
            ELSE CAST(white_wins * 2 + draws AS DOUBLE)
                 / CAST((white_wins + black_wins + draws) * 2 AS DOUBLE) END AS white_score,
       CAST(draws AS DOUBLE) / CAST(games AS DOUBLE) AS draw_rate
FROM s
"""

MONTHLY_TREND = f"""
WITH a AS ({AGG}),
m AS (SELECT month, CAST(sum(games) AS BIGINT) AS games FROM a
      WHERE month <> 'unknown' GROUP BY 1)
SELECT month, games,
       lag(games) OVER (ORDER BY month) AS prev_games,
       games - lag(games) OVER (ORDER BY month) AS games_delta,
       CAST(sum(games) OVER (ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
            AS BIGINT) AS running_games
FROM m
"""

TOP_OPENINGS = f"""
WITH a AS ({AGG}),
p AS (SELECT month, eco_group, CAST(sum(games) AS BIGINT) AS games FROM a GROUP BY 1, 2),
r AS (SELECT month, eco_group, games,
             CAST(row_number() OVER (PARTITION BY month ORDER BY games DESC, eco_group ASC)
                  AS INTEGER) AS rank
      FROM p)
SELECT month, rank, eco_group, games FROM r WHERE rank <= 3
"""

ROLLUP_COUNTS = f"""
WITH a AS ({AGG})
SELECT month, eco_group, CAST(sum(games) AS BIGINT) AS games,
       CAST(sum(white_wins) AS BIGINT) AS white_wins,
       CAST(sum(black_wins) AS BIGINT) AS black_wins,
       CAST(sum(draws) AS BIGINT) AS draws
FROM a GROUP BY ROLLUP (month, eco_group)
"""

CUBE_BUCKETS = f"""
WITH a AS ({AGG})
SELECT white_bucket, black_bucket, CAST(sum(games) AS BIGINT) AS games,
       CAST(sum(white_wins) AS BIGINT) AS white_wins,
       CAST(sum(black_wins) AS BIGINT) AS black_wins,
       CAST(sum(draws) AS BIGINT) AS draws
FROM a GROUP BY CUBE (white_bucket, black_bucket)
"""

ELO_GAP_PERFORMANCE = f"""
WITH a AS ({AGG}),
s AS (SELECT CAST(white_bucket - black_bucket AS INTEGER) AS gap,
             CAST(sum(games) AS BIGINT) AS games,
             CAST(sum(white_wins) AS BIGINT) AS white_wins,
             CAST(sum(black_wins) AS BIGINT) AS black_wins,
             CAST(sum(draws) AS BIGINT) AS draws
      FROM a GROUP BY 1)
SELECT gap, games, white_wins, black_wins, draws,
       CASE WHEN white_wins + black_wins + draws = 0 THEN NULL
            ELSE CAST(white_wins * 2 + draws AS DOUBLE)
                 / CAST((white_wins + black_wins + draws) * 2 AS DOUBLE) END AS white_score,
       CAST(draws AS DOUBLE) / CAST(games AS DOUBLE) AS draw_rate
FROM s
"""

OPENING_TREND = f"""
WITH a AS ({AGG}),
p AS (SELECT month, eco_group, CAST(sum(games) AS BIGINT) AS games FROM a
      WHERE month <> 'unknown' GROUP BY 1, 2),
s AS (SELECT month, eco_group, games,
             CAST(games AS DOUBLE) / CAST(sum(games) OVER (PARTITION BY month) AS DOUBLE) AS share
      FROM p)
SELECT eco_group, month, games, share,
       games - lag(games) OVER (PARTITION BY eco_group ORDER BY month) AS games_change,
       share - lag(share) OVER (PARTITION BY eco_group ORDER BY month) AS share_change
FROM s
"""

ORACLE_SQL: dict[str, str] = {
    "agg_full": AGG,
    "agg_total_games": TOTAL_GAMES,
    "agg_merge_batches": AGG,
    "upsert_additive": aggregate_sql(scale=2),
    "header_tags": HEADER_TAGS,
    "month_key": MONTH_KEY,
    "result_class": RESULT_CLASS,
    "eco_group_lookup": ECO_GROUP_LOOKUP,
    "elo_bucket_200": ELO_BUCKET_200,
    "elo_bucket_custom": ELO_BUCKET_CUSTOM,
    "game_scan_count": GAME_SCAN_COUNT,
    "csv_roundtrip": AGG,
    "csv_per_month": _per_source_month_sql(),
    "store_replay": AGG,
    "stream_agg": AGG,
    "landed_agg_100": aggregate_sql(100),
    "plan_range": plan_sql(),
    "plan_pending": plan_sql(pending=True),
    "ledger_state": LEDGER_STATE,
    "opening_popularity": OPENING_POPULARITY,
    "result_rates": RESULT_RATES,
    "elo_performance": ELO_PERFORMANCE,
    "monthly_trend": MONTHLY_TREND,
    "top_openings": TOP_OPENINGS,
    "rollup_counts": ROLLUP_COUNTS,
    "cube_buckets": CUBE_BUCKETS,
    "elo_gap_performance": ELO_GAP_PERFORMANCE,
    "opening_trend": OPENING_TREND,
    "upsert_versioned": aggregate_sql(scale=2),
}

ORACLE_SQL["sql_on_aggregates"] = f"WITH aggregates AS ({AGG}) {SQL_OPENING_RESULTS}"

# SQL over the ledger table, as run against the original database.
SQL_INGESTION_STATUS = """
SELECT status,
       CAST(count(*) AS BIGINT) AS months,
       CAST(sum(games) AS BIGINT) AS games,
       min(month) AS first_month,
       max(month) AS last_month
FROM ingestions
GROUP BY status
"""
ORACLE_SQL["sql_on_ingestions"] = f"WITH ingestions AS ({LEDGER_STATE}) {SQL_INGESTION_STATUS}"

ORACLE_SQL["landed_two_runs"] = aggregate_sql(100)
ORACLE_SQL["scan_compressed"] = AGG

# One more game for every file that ends in the separator: one file per even month.
ORACLE_SQL["scan_tail"] = f"""
WITH a AS ({AGG}),
t AS (SELECT count(DISTINCT strftime(l_shipdate, '%Y-%m')) AS n FROM lineitem
      WHERE month(l_shipdate) % 2 = 0),
u AS (SELECT * FROM a UNION ALL
      SELECT 'unknown', 'U00', 0, 0, CAST(n AS BIGINT), 0, 0, 0 FROM t)
SELECT month, eco_group, white_bucket, black_bucket, CAST(sum(games) AS BIGINT) AS games,
       CAST(sum(white_wins) AS BIGINT) AS white_wins, CAST(sum(black_wins) AS BIGINT) AS black_wins,
       CAST(sum(draws) AS BIGINT) AS draws
FROM u WHERE games > 0 GROUP BY month, eco_group, white_bucket, black_bucket
"""

ORACLE_SQL["scan_zst_frames"] = ORACLE_SQL["scan_tail"]
ORACLE_SQL["stream_running_totals"] = ORACLE_SQL["scan_tail"]
ORACLE_SQL["stream_bounded"] = f"SELECT *, 0 AS batches_over, 0 AS batches_missing FROM ({AGG}) a"

# The header inside an Event line is part of the Event's value; the game's own ECO line counts.
ORACLE_SQL["event_tag"] = f"""
SELECT CASE l_orderkey % 7 WHEN 3 THEN 'B45' WHEN 5 THEN 'Open, round "1"' ELSE 'Rated game' END AS event,
       CASE WHEN l_orderkey % 13 = 0 OR l_partkey % 17 = 0 THEN NULL ELSE {_CODE} END AS eco_code,
       CAST(count(*) AS BIGINT) AS games
FROM lineitem GROUP BY 1, 2
"""

ORACLE_SQL["ingest_resume"] = """
SELECT strftime(date_trunc('quarter', l_shipdate), '%Y-%m') AS month, 'success' AS status, CAST(count(*) AS BIGINT) AS games,
       CAST(count(*) AS BIGINT) AS stored
FROM lineitem GROUP BY 1
UNION ALL SELECT '2030-01', 'success', 0, 0
"""

ORACLE_SQL["store_reingest_changed"] = aggregate_sql().replace(
    "FROM lineitem", """FROM (SELECT * FROM lineitem
      WHERE month(l_shipdate) % 3 = 2 OR (month(l_shipdate) % 3 = 1 AND l_orderkey % 2 = 0)) lineitem""")

ORACLE_SQL["csv_order"] = f"""
SELECT *, CAST(row_number() OVER (ORDER BY games DESC, month, eco_group, white_bucket, black_bucket)
               AS INTEGER) AS position
FROM ({AGG}) a
"""

ORACLE_SQL["csv_order_width_1"] = ORACLE_SQL["csv_order"].replace(AGG, aggregate_sql(1))
ORACLE_SQL["rollup_incremental"] = ROLLUP_COUNTS
ORACLE_SQL["store_month_range"] = aggregate_sql().replace(
    "g\n    GROUP BY", "g WHERE source_month BETWEEN '1996-03' AND '2000-10' GROUP BY")

# The index lists orders in key order; a stable sort by month keeps that order within a month.
ORACLE_SQL["plan_order"] = plan_sql().replace(
    "AS url", """AS url,
           CAST(row_number() OVER (ORDER BY m, o_orderkey) AS INTEGER) AS position""").replace(
    _INDEX, _INDEX.replace("SELECT", "SELECT o_orderkey,"))

# Replay: the events of each month one after another, each changing the row as a statement would.
ORACLE_SQL["ledger_appends"] = """
WITH RECURSIVE e AS (
  SELECT strftime(o_orderdate, '%Y-%m') AS month,
         row_number() OVER (PARTITION BY strftime(o_orderdate, '%Y-%m') ORDER BY o_orderkey) AS k,
         o_orderkey % 5 < 2 AS is_start,
         strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS at,
         o_custkey % 1000 AS games, CAST(floor(o_totalprice) AS BIGINT) AS duration_ms,
         CASE WHEN o_orderkey % 5 = 4 THEN 'failed' ELSE 'success' END AS fstatus
  FROM orders),
s AS (
  SELECT DISTINCT month, CAST(0 AS BIGINT) AS k, false AS there, CAST(NULL AS VARCHAR) AS started_at,
         CAST(NULL AS VARCHAR) AS finished_at, CAST(0 AS BIGINT) AS games,
         CAST(0 AS BIGINT) AS duration_ms, CAST(NULL AS VARCHAR) AS status
  FROM e
  UNION ALL
  SELECT s.month, e.k, s.there OR e.is_start,
         CASE WHEN e.is_start THEN e.at ELSE s.started_at END,
         CASE WHEN NOT e.is_start AND s.there THEN e.at ELSE s.finished_at END,
         CASE WHEN NOT e.is_start AND s.there THEN e.games ELSE s.games END,
         CASE WHEN NOT e.is_start AND s.there THEN e.duration_ms ELSE s.duration_ms END,
         CASE WHEN e.is_start THEN 'started' WHEN s.there THEN e.fstatus ELSE s.status END
  FROM s JOIN e ON e.month = s.month AND e.k = s.k + 1)
SELECT s.month, 'https://example.org/standard/games_rated_' || s.month || '.pgn.zst' AS url,
       started_at, finished_at, games, duration_ms, status
FROM s JOIN (SELECT month, max(k) AS k FROM e GROUP BY month) l ON s.month = l.month AND s.k = l.k
WHERE there
"""
