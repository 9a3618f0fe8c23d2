"""Explicit schemas of the raw tables (column names in lower case)."""

from __future__ import annotations

from pyspark.sql import types as T

L, S, D, TS, DT, I, B = (T.LongType(), T.StringType(), T.DoubleType(), T.TimestampNTZType(),
                         T.DateType(), T.IntegerType(), T.BooleanType())


def _struct(*cols) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in cols])


_STATS = ["fgm", "fga", "fg3m", "fg3a", "ftm", "fta", "oreb", "dreb", "reb", "ast", "stl", "blk"]

GAMES = _struct(
    ("id", L, False), ("season_id", S, True), ("team_id", L, True), ("team_abbreviation", S, True),
    ("team_name", S, True), ("game_id", S, True), ("game_date", S, True), ("matchup", S, True),
    ("wl", S, True), ("min", L, True), ("pts", L, True),
    *[(c, L, True) for c in ["fgm", "fga"]], ("fg_pct", D, True),
    *[(c, L, True) for c in ["fg3m", "fg3a"]], ("fg3_pct", D, True),
    *[(c, L, True) for c in ["ftm", "fta"]], ("ft_pct", D, True),
    *[(c, L, True) for c in ["oreb", "dreb", "reb", "ast", "stl", "blk", "tov", "pf"]],
    ("plus_minus", D, True), ("updated_at", TS, True),
)

PLAYER_BOX = _struct(
    ("id", L, False), ("game_id", S, True), ("team_id", L, True), ("team_abbreviation", S, True),
    ("team_city", S, True), ("player_id", L, True), ("player_name", S, True), ("nickname", S, True),
    ("start_position", S, True), ("comment", S, True), ("min", S, True),
    ("fgm", L, True), ("fga", L, True), ("fg_pct", D, True), ("fg3m", L, True), ("fg3a", L, True),
    ("fg3_pct", D, True), ("ftm", L, True), ("fta", L, True), ("ft_pct", D, True),
    *[(c, L, True) for c in ["oreb", "dreb", "reb", "ast", "stl", "blk", "to", "pf", "pts"]],
    ("plus_minus", D, True), ("updated_at", TS, True),
)

_TEAM_COMMON = [
    ("id", L, False), ("game_id", S, True), ("team_id", L, True), ("team_name", S, True),
    ("team_abbreviation", S, True), ("team_city", S, True), ("min", S, True),
    ("fgm", L, True), ("fga", L, True), ("fg_pct", D, True), ("fg3m", L, True), ("fg3a", L, True),
    ("fg3_pct", D, True), ("ftm", L, True), ("fta", L, True), ("ft_pct", D, True),
    *[(c, L, True) for c in ["oreb", "dreb", "reb", "ast", "stl", "blk", "to", "pf", "pts"]],
]

TEAM_BOX = _struct(*_TEAM_COMMON, ("plus_minus", D, True), ("updated_at", TS, True))

BENCH_BOX = _struct(*_TEAM_COMMON[:4], ("starters_bench", S, True), *_TEAM_COMMON[4:],
                    ("updated_at", TS, True))

DATE_STATUS = _struct(
    ("date", DT, False), ("status", S, False), ("last_checked", TS, True), ("retry_count", I, True),
    ("created_at", TS, True), ("updated_at", TS, True),
)

API_CALLS = _struct(
    ("id", L, False), ("endpoint", S, True), ("call_time", TS, True), ("success", B, True),
    ("error_message", S, True),
)

# One landed API response: the endpoint name, the raw JSON text and when it was fetched.
LANDING = _struct(("endpoint", S, True), ("request_key", S, True), ("payload", S, True),
                  ("fetched_at", TS, True))

# The candidate key columns of an API result set, in this order.
KEY_CANDIDATES = ["season_id", "team_id", "game_id", "player_id"]

# Explicit upsert key per raw table (the grain of each table, see trap T10).
TABLE_KEYS = {
    "games": ["season_id", "team_id", "game_id"],
    "player_box": ["team_id", "game_id", "player_id"],
    "team_box": ["team_id", "game_id"],
    "bench_box": ["team_id", "game_id", "starters_bench"],
    "date_status": ["date"],
    "api_calls": ["id"],
}

SCHEMAS = {
    "games": GAMES, "player_box": PLAYER_BOX, "team_box": TEAM_BOX, "bench_box": BENCH_BOX,
    "date_status": DATE_STATUS, "api_calls": API_CALLS,
}
