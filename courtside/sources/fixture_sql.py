"""The raw-shaped views of ``tables.DriverTables`` as SQL text (DuckDB dialect).

Used only to build the independent oracle queries; the Spark side never runs this text.
"""

from __future__ import annotations

from pyspark.sql import types as T

from . import schemas

_SQL_TYPES = {
    T.LongType: "BIGINT", T.StringType: "VARCHAR", T.DoubleType: "DOUBLE", T.TimestampNTZType: "TIMESTAMP",
    T.DateType: "DATE", T.IntegerType: "INTEGER", T.BooleanType: "BOOLEAN",
}


def sql_type(dt: T.DataType) -> str:
    return _SQL_TYPES[type(dt)]


def _project(exprs: dict[str, str], schema: T.StructType) -> str:
    cols = []
    for f in schema.fields:
        e = exprs.get(f.name, "NULL")
        cols.append(f"CAST({e} AS {sql_type(f.dataType)}) AS {f.name}")
    return ",\n    ".join(cols)


_GAMES_BASE = """
    SELECT o.o_orderkey, o.o_custkey, o.o_orderdate, o.o_orderpriority, s.side,
           CASE WHEN s.side = 2 THEN o.o_custkey % 30 + 1 ELSE (o.o_custkey + s.side * 7) % 30 + 1 END AS team
    FROM orders o JOIN (VALUES (0), (1), (2)) s(side) ON s.side < 2 OR o.o_orderkey % 53 = 0
"""

GAMES_RAW = f"""games_raw AS (
  SELECT
    {_project({
        "id": "o_orderkey * 4 + side",
        "season_id": "(CASE WHEN side = 2 THEN '6' WHEN o_orderkey % 97 = 0 THEN '6' "
                     "ELSE substring(o_orderpriority, 1, 1) END) || CAST(year(o_orderdate) AS VARCHAR)",
        "team_id": "team",
        "team_abbreviation": "'T' || lpad(CAST(team AS VARCHAR), 2, '0')",
        "team_name": "'Team ' || CAST(team AS VARCHAR)",
        "game_id": "CAST(o_orderkey AS VARCHAR)",
        "game_date": "CAST(CAST(o_orderdate AS DATE) AS VARCHAR)",
        "wl": "CASE WHEN side = 2 THEN 'W' WHEN (o_orderkey + side) % 2 = 0 THEN 'W' ELSE 'L' END",
        "updated_at": "CASE WHEN side = 2 THEN o_orderdate + to_days(9) WHEN o_orderkey % 11 = 0 THEN NULL "
                      "ELSE o_orderdate + to_days(CAST(o_orderkey % 5 AS INTEGER)) END",
    }, schemas.GAMES)}
  FROM ({_GAMES_BASE}) g
)"""

_Q = "CAST(CAST(l_quantity AS INTEGER) AS VARCHAR)"

PLAYER_BOX_RAW = f"""player_box_raw AS (
  SELECT
    {_project({
        "id": "l_orderkey * 1000 + row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, "
              "l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_shipdate)",
        "game_id": "CAST(l_orderkey AS VARCHAR)",
        "team_id": "l_partkey % 30 + 1",
        "player_id": "l_suppkey",
        "player_name": "'player-' || CAST(l_suppkey AS VARCHAR) || CASE WHEN l_linenumber = 7 THEN '-jr' ELSE '' END",
        "min": f"CASE WHEN l_partkey % 37 = 0 THEN NULL WHEN l_suppkey % 50 = 7 THEN 'DNP' "
               f"WHEN l_linenumber = 4 THEN '0:00' WHEN l_linenumber = 2 THEN {_Q} || '-30' "
               f"WHEN l_linenumber = 3 THEN {_Q} || '.5' "
               f"ELSE {_Q} || ':' || lpad(CAST(l_partkey % 60 AS VARCHAR), 2, '0') END",
        "pts": "CASE WHEN l_partkey % 41 = 0 THEN NULL ELSE CAST(l_quantity AS BIGINT) END",
        "ast": "round(l_discount * 100)",
        "oreb": "round(l_tax * 100)",
        "dreb": "l_linenumber",
        "reb": "CAST(round(l_tax * 100) AS BIGINT) + l_linenumber",
        "stl": "l_partkey % 12", "blk": "l_suppkey % 11", "pf": "l_orderkey % 6",
        "fgm": "l_partkey % 15", "fg3m": "l_partkey % 5", "ftm": "l_orderkey % 8",
        "fga": "l_partkey % 15 + l_suppkey % 4 + l_orderkey % 5",
        "fg3a": "l_partkey % 5 + l_suppkey % 4",
        "fta": "l_orderkey % 8 + l_linenumber % 3",
        "updated_at": "CASE WHEN l_partkey % 17 = 0 THEN NULL ELSE l_shipdate END",
    }, schemas.PLAYER_BOX)}
  FROM lineitem
)"""

TEAM_BOX_RAW = f"""team_box_raw AS (
  SELECT
    {_project({
        "id": "l_orderkey * 2 + l_linenumber % 2",
        "game_id": "CAST(l_orderkey AS VARCHAR)",
        "team_id": "l_linenumber % 2",
        "pts": "sum(l_quantity)",
        "updated_at": "max(l_shipdate)",
    }, schemas.TEAM_BOX)}
  FROM lineitem WHERE l_orderkey % 10 <> 3
  GROUP BY l_orderkey, l_linenumber % 2
)"""

_ROLE = "CASE WHEN l_linenumber <= 5 THEN 'Starters' ELSE 'Bench' END"

BENCH_BOX_RAW = f"""bench_box_raw AS (
  SELECT
    {_project({
        "id": f"l_orderkey * 4 + (l_linenumber % 2) * 2 + CASE WHEN {_ROLE} = 'Starters' THEN 0 ELSE 1 END",
        "game_id": "CAST(l_orderkey AS VARCHAR)",
        "team_id": "l_linenumber % 2",
        "starters_bench": _ROLE,
        "pts": "sum(l_quantity)",
        "updated_at": "max(l_shipdate)",
    }, schemas.BENCH_BOX)}
  FROM lineitem
  GROUP BY l_orderkey, l_linenumber % 2, {_ROLE}
)"""

_STATUS = ("CASE WHEN day(o_orderdate) % 7 = 0 THEN 'pending' WHEN day(o_orderdate) % 11 = 0 THEN 'no_games' "
           "ELSE 'processed' END")
_CHECKED = "o_orderdate + to_days(CAST(day(o_orderdate) % 4 AS INTEGER))"

DATE_STATUS_RAW = f"""date_status_raw AS (
  SELECT
    {_project({
        "date": "o_orderdate",
        "status": _STATUS,
        "last_checked": _CHECKED,
        "retry_count": "day(o_orderdate) % 3",
        "created_at": "o_orderdate",
        "updated_at": f"CASE WHEN {_STATUS} <> 'pending' THEN {_CHECKED} END",
    }, schemas.DATE_STATUS)}
  FROM (SELECT DISTINCT o_orderdate FROM orders) d
)"""

API_CALLS_RAW = f"""api_calls_raw AS (
  SELECT
    {_project({
        "id": "event_id",
        "endpoint": "event_type",
        "call_time": "ts",
        "success": "event_type <> 'error'",
        "error_message": "CASE WHEN event_type = 'error' THEN props END",
    }, schemas.API_CALLS)}
  FROM events
)"""

GAME_SUMMARY_RAW = """game_summary_raw AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS game_id, CAST(o_orderdate AS DATE) AS game_date_est,
         'Final' AS game_status_text, o_orderdate + to_days(2) AS updated_at
  FROM orders WHERE o_orderstatus = 'F'
)"""

ALL = [GAMES_RAW, PLAYER_BOX_RAW, TEAM_BOX_RAW, BENCH_BOX_RAW, DATE_STATUS_RAW, API_CALLS_RAW, GAME_SUMMARY_RAW]


def with_fixtures(body: str, ctes: str = "") -> str:
    """``WITH <raw views>[, <ctes>] <body>``; DuckDB skips views the query does not use."""
    parts = list(ALL)
    if ctes.strip():
        parts.append(ctes.strip().rstrip(","))
    return "WITH " + ",\n".join(parts) + "\n" + body.strip()
