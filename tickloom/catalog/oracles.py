"""SQL twins of the registered queries, for DuckDB over the same tables."""

from __future__ import annotations

# -- building blocks -------------------------------------------------------------------

RAW = """raw AS (
  SELECT event_type AS Comm, 'F' AS Contract_Type,
         CAST(strftime(ts, '%Y%m%d') AS INT) AS Trade_Date,
         CAST(strftime(ts, '%H%M%S') AS INT) AS Log_Time,
         value AS Price, CAST(json_extract_string(props, '$.k') AS BIGINT) AS Volume,
         CAST(6076 + (day(ts) - 1) // 2 AS INT) AS source_id, event_id AS seq
  FROM events)"""

TICKS = RAW + """,
ticks AS (SELECT * FROM raw WHERE Price > 0 AND Comm IS NOT NULL)"""

CODED = """ticks AS (
  SELECT event_type || '-' || CAST(user_id AS VARCHAR) AS Comm,
         CAST(strftime(ts, '%Y%m%d') AS INT) AS Trade_Date,
         CAST(strftime(ts, '%H%M%S') AS INT) AS Log_Time,
         value AS Price, CAST(json_extract_string(props, '$.k') AS BIGINT) AS Volume,
         CAST(6076 + (day(ts) - 1) // 2 AS INT) AS source_id, event_id AS seq
  FROM events WHERE value > 0)"""

BLOCKS = """blocks AS (
  SELECT o_orderpriority AS Comm, CAST(strftime(o_orderdate, '%Y%m%d') AS INT) AS Trade_Date,
         CAST(strftime(o_orderdate, '%H%M%S') AS INT) AS Log_Time,
         o_totalprice AS Price, q.Volume, CAST(year(o_orderdate) AS INT) AS source_id, o_orderkey AS seq
  FROM orders JOIN (SELECT l_orderkey, CAST(sum(l_quantity) AS BIGINT) AS Volume
                    FROM lineitem GROUP BY l_orderkey) q ON o_orderkey = l_orderkey)"""

HOUR = "CAST(Log_Time // 10000 AS INT)"

CLASS = """CASE WHEN Volume IS NULL THEN NULL WHEN Volume <= 5 THEN 'Retail' WHEN Volume <= 20 THEN 'Medium'
  WHEN Volume <= 100 THEN 'Shark' ELSE 'Whale' END"""

TOTALS = """CAST(sum(Volume) AS BIGINT) AS Total_Volume, round(sum(Price * Volume), 2) AS Total_Turnover,
  min(Price) AS Low, max(Price) AS High"""

ENDS = """arg_min(Price, row(Log_Time, seq)) AS Open, arg_max(Price, row(Log_Time, seq)) AS Close"""


def hourly(source: str = "ticks", extra: str = "") -> str:
    return f"""SELECT source_id, Comm, Trade_Date, {HOUR} AS Hour, {TOTALS}{extra}
      FROM {source} GROUP BY ALL"""


def session(source: str = "ticks") -> str:
    return f"""SELECT source_id, Comm, Trade_Date, {TOTALS}, {ENDS}
      FROM {source} GROUP BY source_id, Comm, Trade_Date"""


def distribution(source: str = "ticks") -> str:
    return f"""SELECT source_id, Comm, {CLASS} AS Trader_Type, count(Volume) AS Trade_Count,
      CAST(sum(Volume) AS BIGINT) AS Total_Volume FROM {source} GROUP BY ALL"""


def codes(source: str) -> str:
    return f"""SELECT CAST(row_number() OVER (ORDER BY Comm) AS INT) AS Comm_id, Comm AS Comm_Code
      FROM (SELECT DISTINCT Comm FROM {source})"""


TYPES = """types AS (SELECT * FROM (VALUES (1, 'Retail'), (2, 'Medium'), (3, 'Shark'), (4, 'Whale'))
  t(Trader_Type_id, Trader_Type_Name))"""

SESSION_FACT = """fact AS (
  SELECT source_id, Comm_id, max(Trade_Date) AS Date_id, CAST(sum(Total_Volume) AS BIGINT) AS Total_Volume,
         round(sum(Total_Turnover), 2) AS Total_Turnover, min(Low) AS Low, max(High) AS High,
         arg_min(Open, Trade_Date) AS Open, arg_max(Close, Trade_Date) AS Close
  FROM stg JOIN codes ON Comm = Comm_Code GROUP BY source_id, Comm_id)"""

PCT = "round(100.0 * (Close - Open) / NULLIF(Open, 0), 2)"

CALENDAR = """CAST(Full_Date AS DATE) AS Full_Date, CAST(year(Full_Date) AS INT) AS "Year",
  CAST(month(Full_Date) AS INT) AS "Month", CAST(quarter(Full_Date) AS INT) AS "Quarter",
  CAST(strftime(Full_Date, '%U') AS INT) AS Week_Num, dayname(Full_Date) AS Day_Name"""

LEDGER = """log AS (
  SELECT CAST(o_custkey AS INT) AS file_id,
         CASE o_orderstatus WHEN 'O' THEN 'PENDING' WHEN 'P' THEN 'PROCESSING'
              ELSE CASE WHEN o_orderkey % 3 = 0 THEN 'FAILED' ELSE 'SUCCESS' END END AS status,
         o_orderdate + to_seconds(o_orderkey % 86400) AS changed_at,
         CAST(o_orderkey % 300 AS INT) AS etl_sec, o_orderkey AS seq
  FROM orders)"""

STATUS = """SELECT file_id, arg_max(status, row(changed_at, seq)) AS status, min(changed_at) AS created_at,
    max(changed_at) AS updated_at, arg_max(etl_sec, row(changed_at, seq)) AS etl_sec,
    CAST(count(*) FILTER (status = 'FAILED') AS BIGINT) AS retry_count
  FROM {log} GROUP BY file_id"""

# Log lines as the landing writes them, with the broken ones.
LINES = RAW + """,
whole AS (SELECT *, Comm || ',F,' || Trade_Date || ',' || lpad(CAST(Log_Time AS VARCHAR), 6, '0') || ','
                 || printf('%.2f', Price) || ',' || Volume AS good FROM raw),
lines AS (
  SELECT *, CASE seq % 50
      WHEN 0 THEN good || ',surplus'
      WHEN 1 THEN Comm || ',F,' || Trade_Date
      WHEN 2 THEN Comm || ',F,yesterday,090000,' || printf('%.2f', Price) || ',1'
      WHEN 3 THEN 'NA' || substr(good, length(Comm) + 1)
      WHEN 4 THEN Comm || ',F,' || Trade_Date || ',93015123,' || printf('%.2f', Price) || ',1'
      WHEN 5 THEN Comm || ',F,' || Trade_Date || ',999999,' || printf('%.2f', Price) || ',1'
      WHEN 6 THEN Comm || ',F,' || Trade_Date || ',250000,' || printf('%.2f', Price) || ',1'
      WHEN 7 THEN Comm || ',F,' || Trade_Date || ',090000,' || printf('%.2f', Price) || ',-3'
      ELSE good END AS line,
    CASE seq % 50
      WHEN 0 THEN 'too many fields'
      WHEN 1 THEN 'missing or non-numeric integer'
      WHEN 2 THEN 'missing or non-numeric integer'
      WHEN 3 THEN 'missing code'
      WHEN 4 THEN 'not a time of day'
      WHEN 5 THEN 'not a time of day'
      WHEN 6 THEN 'not a time of day'
      WHEN 7 THEN 'negative volume' END AS reason
  FROM whole)"""

# The file id and the line number an event gets in the zipped logs.
ARCHIVE = "source_id"
LINE_NUMBER = f"row_number() OVER (PARTITION BY {ARCHIVE} ORDER BY seq)"

DIRTY = RAW + f""",
dirty AS (
  SELECT * REPLACE (Volume - 30 AS Volume, CASE WHEN seq % 7 = 0 THEN 0.0 ELSE Price END AS Price,
                    CASE WHEN seq % 97 <> 0 THEN Trade_Date END AS Trade_Date) FROM raw),
rolled AS (
  SELECT source_id, Comm, Trade_Date, {HOUR} AS Hour, sum(Volume) AS Total_Volume,
         sum(Price * Volume) AS Total_Turnover, min(Price) AS Lo, max(Price) AS Hi
  FROM dirty GROUP BY ALL),
stg AS (SELECT *, CASE WHEN Hour = 13 THEN Hi ELSE Lo END AS Low,
               CASE WHEN Hour = 13 THEN Lo ELSE Hi END AS High FROM rolled)"""

RULES = (
    ("NEGATIVE_TURNOVER", "BLOCKER", "Total_Turnover < 0"),
    ("NULL_TRADE_DATE", "BLOCKER", "Trade_Date IS NULL"),
    ("NEGATIVE_VOLUME", "BLOCKER", "Total_Volume < 0"),
    ("HIGH_BELOW_LOW", "BLOCKER", "High < Low"),
    ("ZERO_TURNOVER", "WARNING", "Total_Volume > 0 AND Total_Turnover = 0"),
)


def dq(by: str = "") -> str:
    keys, group = (f"{by}, ", f" GROUP BY {by}") if by else ("", "")
    checks = [
        f"SELECT {keys}'stg_hourly_stats' AS dataset, '{rule}' AS rule, '{severity}' AS severity, "
        f"CAST(count(*) FILTER ({violated}) AS BIGINT) AS violations FROM stg{group}"
        for rule, severity, violated in RULES
    ]
    if not by:
        checks.append(
            "SELECT 'stg_hourly_stats' AS dataset, 'EMPTY' AS rule, 'BLOCKER' AS severity, "
            "CAST(count(*) = 0 AS BIGINT) AS violations FROM stg"
        )
    return f"WITH {DIRTY} " + " UNION ALL ".join(checks)


def share(value: str, name: str) -> str:
    return f"""WITH {BLOCKS}, t AS (SELECT {CLASS} AS Trader_Type, {value} AS {name} FROM blocks GROUP BY ALL)
      SELECT Trader_Type, {name}, round(100.0 * CAST({name} AS DOUBLE) / (SELECT sum({name}) FROM t), 2) AS Share
      FROM t"""


def sla(max_sec: int, deadline: int, hours_east: int) -> str:
    return f"""WITH {LEDGER}, done AS (
        SELECT file_id, status, changed_at AS finished_at, etl_sec,
               CASE WHEN status = 'SUCCESS' THEN etl_sec > {max_sec} END AS too_slow,
               CASE WHEN status = 'SUCCESS'
                    THEN hour(changed_at + INTERVAL {hours_east} HOUR) >= {deadline} END AS too_late
        FROM log WHERE status IN ('SUCCESS', 'FAILED'))
      SELECT *, CASE WHEN status <> 'SUCCESS' THEN 'CRITICAL' WHEN too_slow OR too_late THEN 'WARNING'
                     ELSE 'PASS' END AS level FROM done"""


DISTRIBUTION_FACT = f"""WITH {BLOCKS}, {TYPES}, stg AS ({distribution("blocks")}), codes AS ({codes("stg")}),
fact AS (SELECT source_id, Comm_id, Trader_Type_id, CAST(sum(Trade_Count) AS BIGINT) AS Trade_Count,
                CAST(sum(Total_Volume) AS BIGINT) AS Total_Volume
         FROM stg JOIN codes ON Comm = Comm_Code JOIN types ON Trader_Type = Trader_Type_Name
         GROUP BY ALL)"""

MOVERS = f"""WITH {CODED}, stg AS ({session()})
SELECT Comm, {PCT} AS Pct_Change FROM stg ORDER BY {{order}}, Comm, source_id LIMIT 10"""

SESSION_STAR = f"WITH {TICKS}, stg AS ({session()}), codes AS ({codes('stg')}), {SESSION_FACT}"

# -- the queries -----------------------------------------------------------------------

ORACLES = {
    "valid_ticks": f"""WITH {RAW}, planted AS (
        SELECT * REPLACE (CASE seq % 20 WHEN 0 THEN 0.0 WHEN 1 THEN -Price WHEN 2 THEN NULL WHEN 3 THEN NULL
                          ELSE Price END AS Price, CASE WHEN seq % 20 <> 4 THEN Comm END AS Comm) FROM raw)
      SELECT * FROM planted WHERE Price > 0 AND Comm IS NOT NULL""",
    "tick_turnover": f"""WITH {TICKS}
      SELECT seq, Comm, Price, Volume, round(Price * Volume, 2) AS Turnover FROM ticks""",
    "tick_hour": f"WITH {TICKS} SELECT seq, Log_Time, {HOUR} AS Hour FROM ticks",
    "tick_trader_type": f"WITH {BLOCKS} SELECT seq, Volume, {CLASS} AS Trader_Type FROM blocks",
    "hourly_stats": f"WITH {TICKS} {hourly()}",
    "hourly_ohlc": f"WITH {TICKS} {hourly(extra=', ' + ENDS)}",
    "session_summary": f"WITH {TICKS} {session()}",
    "trade_distribution": f"WITH {TICKS} {distribution()}",
    "block_trade_distribution": f"WITH {BLOCKS} {distribution('blocks')}",
    "merge_hourly": f"WITH {TICKS} {hourly()}",
    "merge_session": f"WITH {TICKS} {session()}",
    "merge_distribution": f"WITH {TICKS} {distribution()}",
    "rollups_from_cells": f"WITH {TICKS} {session()}",
    "dim_commodity": f"WITH {CODED} {codes('ticks')}",
    "dim_commodity_incremental": f"""WITH {CODED},
      firsts AS ({codes("(SELECT * FROM ticks WHERE source_id <= 6078)")}),
      later AS (SELECT DISTINCT Comm FROM ticks WHERE Comm NOT IN (SELECT Comm_Code FROM firsts))
      SELECT * FROM firsts UNION ALL
      SELECT CAST((SELECT max(Comm_id) FROM firsts) + row_number() OVER (ORDER BY Comm) AS INT), Comm FROM later""",
    "dim_trader_type": f"""WITH {BLOCKS}, {TYPES}, stg AS ({distribution("blocks")})
      SELECT Trader_Type_id, Trader_Type_Name, CAST(sum(Trade_Count) AS BIGINT) AS Trade_Count
      FROM types LEFT JOIN stg ON Trader_Type = Trader_Type_Name GROUP BY ALL""",
    "dim_date": f"""WITH {TICKS}, {BLOCKS}, days AS (
        SELECT Trade_Date FROM ticks UNION SELECT Trade_Date FROM blocks),
      dated AS (SELECT Trade_Date AS Date_id, strptime(CAST(Trade_Date AS VARCHAR), '%Y%m%d') AS Full_Date FROM days)
      SELECT Date_id, {CALENDAR} FROM dated""",
    "fact_session_summary": f"{SESSION_STAR} SELECT * FROM fact",
    "fact_hourly_stats": f"""WITH {TICKS}, stg AS ({hourly()}), codes AS ({codes("stg")})
      SELECT source_id, Comm_id, Trade_Date AS Date_id, Hour, Total_Volume, Total_Turnover, Low, High
      FROM stg JOIN codes ON Comm = Comm_Code""",
    "fact_trade_distribution": f"{DISTRIBUTION_FACT} SELECT * FROM fact",
    "comm_change": f"""{SESSION_STAR}
      SELECT Comm_Code AS Comm, Total_Volume, Total_Turnover, {PCT} AS Pct_Change
      FROM fact JOIN codes USING (Comm_id) ORDER BY Pct_Change DESC NULLS LAST""",
    "top_gainers": MOVERS.format(order="Pct_Change DESC NULLS LAST"),
    "top_losers": MOVERS.format(order="Pct_Change ASC NULLS FIRST"),
    "hourly_profile": f"""WITH {TICKS}, stg AS ({hourly()})
      SELECT Hour, CAST(sum(Total_Volume) AS BIGINT) AS Total_Volume, round(sum(Total_Turnover), 2) AS Total_Turnover
      FROM stg GROUP BY Hour ORDER BY Hour""",
    "trader_type_totals": f"""{DISTRIBUTION_FACT}
      SELECT Trader_Type_Name AS Trader_Type, CAST(sum(Total_Volume) AS BIGINT) AS Total_Volume,
             CAST(sum(Trade_Count) AS BIGINT) AS Total_Count
      FROM fact JOIN types USING (Trader_Type_id) GROUP BY ALL""",
    "volume_share": share("CAST(sum(Volume) AS BIGINT)", "Total_Volume"),
    "count_share": share("count(Volume)", "Total_Count"),
    "price_spread": f"""WITH {TICKS}, stg AS ({session()})
      SELECT source_id, Comm, Trade_Date, round(High - Low, 2) AS Spread,
             round(100.0 * (High - Low) / NULLIF(Open, 0), 2) AS Spread_Pct FROM stg""",
    "session_leaderboard": f"""WITH {CODED}, stg AS ({session()}), ranked AS (
        SELECT *, CAST(row_number() OVER (PARTITION BY source_id, Trade_Date
                                          ORDER BY Total_Volume DESC, Comm) AS INT) AS "Rank" FROM stg)
      SELECT source_id, Trade_Date, "Rank", Comm, Total_Volume FROM ranked WHERE "Rank" <= 3""",
    "volume_spikes": f"""WITH {TICKS}, daily AS (
        SELECT Comm, Trade_Date, {HOUR} AS Hour, CAST(sum(Volume) AS BIGINT) AS Total_Volume FROM ticks GROUP BY ALL),
      trailed AS (SELECT *, avg(Total_Volume) OVER (PARTITION BY Comm, Hour ORDER BY Trade_Date
                                                    ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) AS Trailing_Volume
                  FROM daily)
      SELECT * FROM trailed WHERE Total_Volume > 2.0 * Trailing_Volume""",
    "session_trend": f"""WITH {BLOCKS}, stg AS ({session("blocks")}), codes AS ({codes("stg")}), {SESSION_FACT},
      daily AS (
        SELECT Comm_id, Date_id, sum(Total_Volume) AS Total_Volume, sum(Total_Turnover) AS Total_Turnover,
               min(Low) AS Low, max(High) AS High, arg_min(Open, source_id) AS Open,
               arg_max(Close, source_id) AS Close FROM fact GROUP BY ALL),
      dated AS (SELECT *, strptime(CAST(Date_id AS VARCHAR), '%Y%m%d') AS d FROM daily)
      SELECT Comm_Code AS Comm, CAST(year(d) AS INT) AS "Year", CAST(quarter(d) AS INT) AS "Quarter",
             CAST(sum(Total_Volume) AS BIGINT) AS Total_Volume, round(sum(Total_Turnover), 2) AS Total_Turnover,
             min(Low) AS Low, max(High) AS High, arg_min(Open, Date_id) AS Open, arg_max(Close, Date_id) AS Close
      FROM dated JOIN codes USING (Comm_id) GROUP BY ALL""",
    "dq_report": dq(),
    "dq_report_by_source": dq("source_id"),
    "dq_volatility": f"""WITH {TICKS}, stg AS ({session()}), moved AS (
        SELECT Comm, Trade_Date, Close,
               lag(Close) OVER (PARTITION BY Comm ORDER BY Trade_Date) AS Prev_Close FROM stg)
      SELECT Comm, Trade_Date, Close, Prev_Close,
             round((Close - Prev_Close) / NULLIF(Prev_Close, 0), 6) AS Change
      FROM moved WHERE abs((Close - Prev_Close) / NULLIF(Prev_Close, 0)) > 0.2""",
    "dq_unique": f"""WITH {TICKS}, stg AS ({session()})
      SELECT source_id, Comm, count(*) AS row_count FROM stg GROUP BY ALL HAVING count(*) > 1""",
    "dq_foreign_key": f"""WITH {TICKS}, {BLOCKS}, stg AS ({session("blocks")})
      SELECT Trade_Date, count(*) AS row_count FROM stg
      WHERE Trade_Date NOT IN (SELECT Trade_Date FROM ticks) GROUP BY Trade_Date""",
    "dq_missing_dim": f"""WITH {CODED}, stg AS ({session()})
      SELECT Comm, count(*) AS row_count FROM stg
      WHERE Comm NOT IN (SELECT Comm FROM ticks WHERE source_id = 6076) GROUP BY Comm""",
    "replace_by_source": f"""WITH {TICKS}, corrected AS (
        SELECT * REPLACE (CASE WHEN source_id % 2 = 1 THEN 2 * Volume ELSE Volume END AS Volume) FROM ticks)
      {session("corrected")}""",
    "append_table": f"WITH {TICKS} {distribution()}",
    "save_mart": f"""WITH {TICKS}, stg AS ({hourly()})
      SELECT Hour, CAST(sum(Total_Volume) AS BIGINT) AS Total_Volume, round(sum(Total_Turnover), 2) AS Total_Turnover
      FROM stg GROUP BY Hour""",
    "load_star": f"""{SESSION_STAR}
      SELECT fact.* EXCLUDE (Comm_id), CAST(1 + source_id % 2 AS BIGINT) AS load_id, Comm_Code AS Comm
      FROM fact JOIN codes USING (Comm_id)""",
    "load_files": f"""WITH {LINES}, good AS (
        SELECT * REPLACE ({ARCHIVE} AS source_id) FROM lines WHERE reason IS NULL AND Price > 0),
      counts AS (
        SELECT source_id, count(*) AS n FROM ({hourly("good")}) GROUP BY 1 UNION ALL
        SELECT source_id, count(*) AS n FROM ({session("good")}) GROUP BY 1 UNION ALL
        SELECT source_id, count(*) AS n FROM ({distribution("good")}) GROUP BY 1)
      SELECT source_id AS file_id, 'SUCCESS' AS status, CAST(0 AS BIGINT) AS retry_count,
             CAST(sum(n) AS BIGINT) AS row_count FROM counts GROUP BY source_id""",
    "load_files_nested": f"""WITH {LINES}, good AS (
        SELECT * REPLACE ({ARCHIVE} AS source_id) FROM lines WHERE reason IS NULL AND Price > 0),
      counts AS (
        SELECT source_id, count(*) AS n FROM ({hourly("good")}) GROUP BY 1 UNION ALL
        SELECT source_id, count(*) AS n FROM ({session("good")}) GROUP BY 1 UNION ALL
        SELECT source_id, count(*) AS n FROM ({distribution("good")}) GROUP BY 1)
      SELECT source_id AS file_id, 'SUCCESS' AS status, CAST(0 AS BIGINT) AS retry_count,
             CAST(sum(n) AS BIGINT) AS row_count FROM counts GROUP BY source_id""",
    "marts_from_facts": f"""{SESSION_STAR}
      SELECT 'Comm_change' AS mart, Comm_Code AS label, Total_Volume, {PCT} AS measure FROM fact JOIN codes USING (Comm_id)
      UNION ALL SELECT 'hourly_stats', CAST({HOUR} AS VARCHAR), CAST(sum(Volume) AS BIGINT), round(sum(Price * Volume), 2) FROM ticks GROUP BY 2
      UNION ALL SELECT 'Trader_Types', {CLASS}, CAST(sum(Volume) AS BIGINT), CAST(count(Volume) AS DOUBLE) FROM ticks GROUP BY 2""",
    "movers_from_facts": f"""{SESSION_STAR}, moved AS (SELECT Comm_Code AS Comm, source_id, {PCT} AS Pct_Change FROM fact JOIN codes USING (Comm_id))
      SELECT * FROM (SELECT Comm, Pct_Change, 'up' AS side FROM moved ORDER BY Pct_Change DESC NULLS LAST, Comm, source_id LIMIT 10)
      UNION ALL SELECT * FROM (SELECT Comm, Pct_Change, 'down' FROM moved ORDER BY Pct_Change ASC NULLS FIRST, Comm, source_id LIMIT 10)""",
    "hourly_fact_by_year": f"""WITH {TICKS} SELECT CAST(Trade_Date // 10000 AS INT) AS "year", {HOUR} AS Hour,
             CAST(sum(Volume) AS BIGINT) AS Total_Volume, round(sum(Price * Volume), 2) AS Total_Turnover FROM ticks GROUP BY ALL""",
    "request_backfill": f"""WITH {LEDGER} SELECT file_id, CASE WHEN file_id IN (1, 2, 4, 5, 7) THEN TIMESTAMP '2030-01-01' ELSE updated_at END AS updated_at
      FROM ({STATUS.format(log='log')}) WHERE status = 'PENDING' OR file_id IN (1, 2, 4, 5, 7)""",
    "dq_enforced": f"""SELECT dataset, rule, severity, violations, b.blockers FROM ({dq()}) r,
      (SELECT CAST(count(*) AS BIGINT) AS blockers FROM ({dq()}) x WHERE severity = 'BLOCKER' AND violations > 0) b
      WHERE severity = 'WARNING' AND violations > 0""",
    "load_pending_files": f"""WITH {RAW} SELECT DISTINCT source_id AS file_id, 'SUCCESS' AS status, CAST(0 AS BIGINT) AS illegal FROM raw
      UNION ALL SELECT 9999, 'FAILED', 0""",
    "reload_files": f"""WITH {RAW}, good AS (SELECT * FROM raw WHERE Price > 0 AND source_id % 4 = 3), counts AS (
        SELECT source_id, count(*) AS n FROM ({hourly("good")}) GROUP BY 1 UNION ALL
        SELECT source_id, count(*) AS n FROM ({session("good")}) GROUP BY 1 UNION ALL
        SELECT source_id, count(*) AS n FROM ({distribution("good")}) GROUP BY 1),
      seen AS (SELECT source_id, count(DISTINCT Comm) AS n FROM good GROUP BY 1)
      SELECT s.source_id AS file_id, CAST(coalesce((SELECT sum(n) FROM counts c WHERE c.source_id = s.source_id), 0) AS BIGINT) AS row_count,
             s.source_id % 4 = 1 AS empty, CAST(0 AS BIGINT) AS quarantined,
             CAST(coalesce((SELECT n FROM seen WHERE seen.source_id = s.source_id), 0) AS BIGINT) AS visible_sessions
      FROM (SELECT DISTINCT source_id FROM raw WHERE source_id % 2 = 1) s""",
    "job_log": f"""WITH {RAW} SELECT CAST(row_number() OVER (ORDER BY source_id) AS BIGINT) AS log_id, '1' AS run_id, CAST(source_id AS VARCHAR) AS file_id
      FROM (SELECT DISTINCT source_id FROM raw) UNION ALL
      SELECT count(DISTINCT source_id) + 1, '0', 'late' FROM raw""",
    "load_checks": """SELECT * FROM (VALUES
        ('fact_session_summary', 'PRIMARY_KEY'), ('fact_session_summary', 'FOREIGN_KEY_Comm_id'), ('fact_session_summary', 'FOREIGN_KEY_Date_id'),
        ('fact_hourly_stats', 'PRIMARY_KEY'), ('fact_hourly_stats', 'FOREIGN_KEY_Comm_id'), ('fact_hourly_stats', 'FOREIGN_KEY_Date_id'),
        ('fact_trade_distribution', 'PRIMARY_KEY'), ('fact_trade_distribution', 'FOREIGN_KEY_Comm_id'),
        ('fact_trade_distribution', 'FOREIGN_KEY_Trader_Type_id'), ('dim_commodity', 'PRIMARY_KEY_Comm_Code'),
        ('dim_commodity', 'PRIMARY_KEY_Comm_id'), ('dim_date', 'PRIMARY_KEY_Date_id')) r(dataset, rule),
      (SELECT 'BLOCKER' AS severity, CAST(0 AS BIGINT) AS violations)""",
    "ingest_ledger": f"""WITH {LINES}, good AS (SELECT * FROM lines WHERE reason IS NULL AND Price > 0),
      seen AS (SELECT source_id, count(DISTINCT Comm) AS n FROM good GROUP BY 1)
      SELECT source_id AS file_id, 'SUCCESS' AS status, CAST(n AS BIGINT) AS visible_sessions FROM seen
      UNION ALL SELECT 9999, 'FAILED', 0""",
    "rerun_load": f"""WITH {RAW}, kept AS (SELECT source_id, count(DISTINCT Comm) AS n, sum(Volume) AS v FROM raw WHERE Price > 0 AND source_id % 2 = 0 GROUP BY 1)
      SELECT source_id AS file_id, 'SUCCESS' AS status, CAST(1 AS BIGINT) AS retry_count, CAST(coalesce(any_value(n), 0) AS BIGINT) AS visible_sessions,
             CAST(coalesce(any_value(v), 0) AS BIGINT) AS visible_volume, CAST(0 AS BIGINT) AS illegal FROM raw LEFT JOIN kept USING (source_id) GROUP BY 1""",
    "compacted_facts": f"""{SESSION_STAR}
      SELECT fact.* EXCLUDE (Comm_id), CAST(CASE WHEN source_id % 2 = 1 THEN 4 ELSE 1 + source_id % 3 END AS BIGINT) AS load_id, Comm_Code AS Comm,
             CAST(1 AS BIGINT) AS folders FROM fact JOIN codes USING (Comm_id)""",
    "carried_volatility": f"""WITH {TICKS}, stg AS ({session()}), moved AS (
        SELECT Comm, Trade_Date, Close, lag(Close) OVER (PARTITION BY Comm ORDER BY Trade_Date) AS Prev_Close FROM (
          SELECT Comm, Trade_Date, arg_max(CASE WHEN source_id % 2 = 1 THEN 2 * Close ELSE Close END, source_id) AS Close FROM stg GROUP BY ALL))
      SELECT Comm, Trade_Date, Close, Prev_Close, round((Close - Prev_Close) / NULLIF(Prev_Close, 0), 6) AS Change
      FROM moved WHERE abs((Close - Prev_Close) / NULLIF(Prev_Close, 0)) > 0.2""",
    "ledger_snapshots": f"WITH {LEDGER} {STATUS.format(log='log')}",
    "ingest_replayed": f"""WITH {LINES}, good AS (SELECT * FROM lines WHERE reason IS NULL AND Price > 0)
      SELECT source_id AS file_id, CAST(3 AS BIGINT) AS ledger_rows, CAST(1 AS BIGINT) AS job_rows,
             CAST(count(DISTINCT Comm) AS BIGINT) AS visible_sessions, 'SUCCESS' AS status FROM good GROUP BY source_id""",
    "file_status": f"WITH {LEDGER} {STATUS.format(log='log')}",
    "pending_files": f"""WITH {LEDGER}, s AS ({STATUS.format(log='log')})
      SELECT file_id FROM s WHERE status = 'PENDING' ORDER BY file_id LIMIT 10""",
    "retryable_files": f"""WITH {LEDGER}, s AS ({STATUS.format(log='log')})
      SELECT file_id, retry_count FROM s WHERE status = 'FAILED' AND retry_count < 3""",
    "next_file_id": f"WITH {LEDGER} SELECT CAST(coalesce(max(file_id), 6075) + 1 AS INT) AS file_id FROM log",
    "seed_and_backfill": f"""WITH {LEDGER}, s AS ({STATUS.format(log='log')}), extended AS (
        SELECT * FROM log UNION ALL
        SELECT max(file_id) + 1, 'PENDING', TIMESTAMP '2030-01-01', 0, 0 FROM log UNION ALL
        SELECT file_id, 'PENDING', TIMESTAMP '2030-01-01', 0, 0 FROM s WHERE status = 'FAILED')
      {STATUS.format(log='extended')}""",
    "illegal_transitions": f"""WITH {LEDGER}, moves AS (
        SELECT file_id, changed_at, seq, status,
               lag(status) OVER (PARTITION BY file_id ORDER BY changed_at, seq) AS prev_status FROM log)
      SELECT file_id, changed_at, seq, prev_status, status FROM moves
      WHERE NOT coalesce(CASE WHEN prev_status IS NULL THEN status = 'PENDING'
                     WHEN prev_status = 'PENDING' THEN status = 'PROCESSING'
                     WHEN prev_status = 'PROCESSING' THEN status IN ('SUCCESS', 'FAILED')
                     ELSE status = 'PENDING' END, false)""",
    "sla_report": sla(120, 8, 0),
    "sla_report_local_time": sla(200, 18, 9),
    "job_report": f"""WITH {LEDGER} SELECT status, count(*) AS runs, CAST(sum(etl_sec) AS BIGINT) AS row_count,
             max(changed_at) AS last_run FROM log WHERE status IN ('SUCCESS', 'FAILED') GROUP BY status""",
    "job_log_ids": f"""WITH {LEDGER} SELECT 'load_files' AS task_id, CAST(seq AS VARCHAR) AS run_id,
             CAST(file_id AS VARCHAR) AS file_id, status, changed_at AS execution_time,
             CAST(row_number() OVER (ORDER BY changed_at, CAST(seq AS VARCHAR)) AS INT) AS log_id
      FROM log WHERE status IN ('SUCCESS', 'FAILED')""",
    "visible_facts": f"""WITH {TICKS}, stg AS ({distribution()}), loads AS (
        SELECT *, CAST(CASE WHEN source_id % 2 = 0 THEN 2 ELSE 1 END AS BIGINT) AS load_id FROM stg)
      SELECT * REPLACE (Total_Volume + load_id AS Total_Volume) FROM loads""",
    "read_tick_zips": f"""WITH {LINES}, numbered AS (SELECT *, {LINE_NUMBER} AS n FROM lines)
      SELECT {ARCHIVE} AS source_id, Comm, Contract_Type, Trade_Date, Log_Time,
             round(Price, 2) AS Price, Volume, n AS seq FROM numbered WHERE reason IS NULL""",
    "quarantine_zips": f"""WITH {LINES}, numbered AS (SELECT *, {LINE_NUMBER} AS n FROM lines)
      SELECT {ARCHIVE} AS source_id, n AS seq, reason, line FROM numbered WHERE reason IS NOT NULL""",
    "read_tick_csv": f"""WITH {LINES} SELECT source_id, Comm, Contract_Type, Trade_Date, Log_Time,
             round(Price, 2) AS Price, Volume FROM lines WHERE reason IS NULL""",
    "quarantine_csv": f"""WITH {LINES} SELECT source_id, reason, line FROM lines WHERE reason IS NOT NULL""",
    "hourly_stats_stream": f"WITH {TICKS} {hourly()}",
    "hourly_stream_late": f"""WITH {TICKS}, marked AS (SELECT *, seq % 10 = 0 AND Trade_Date % 100 <= 20 AS late FROM ticks)
      SELECT source_id, Comm, Trade_Date, {HOUR} AS Hour, {TOTALS}, CAST(coalesce(sum(Volume) FILTER (NOT late), 0) AS BIGINT) AS volume_in_time,
             count(*) FILTER (late) AS late_ticks FROM marked GROUP BY ALL""",
    "ingest_stream": f"""WITH {LINES}, good AS (
        SELECT * REPLACE ({ARCHIVE} AS source_id) FROM lines WHERE reason IS NULL AND Price > 0)
      {session("good")}""",
}
