"""Staging models: game list, date status, box load times, API log, box-score status, daily summary.

Each model is a function DataFrame(s) -> DataFrame. The incremental models take an
optional high-water ``mark`` (a Column, typically a scalar subquery over the target);
``mark=None`` is the first, full run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import expressions as X


def stg_gamefinder(games: DataFrame) -> DataFrame:
    """M1: one row per team-game with the text date parsed."""
    return games.select(
        "game_id",
        F.to_date("game_date", "yyyy-MM-dd").alias("game_date"),
        "team_id",
        "team_abbreviation",
        F.col("wl").alias("result"),
    )


def stg_date_processing_status(date_status: DataFrame) -> DataFrame:
    """M2: the work queue with the date renamed."""
    return date_status.select(F.col("date").alias("game_date"), "status", "last_checked", "retry_count")


def stg_boxscores(player_box: DataFrame, bench_box: DataFrame, team_box: DataFrame) -> DataFrame:
    """M3: latest load time of any of the three box tables, per game."""
    combined = (player_box.select("game_id", "updated_at")
                .unionByName(bench_box.select("game_id", "updated_at"))
                .unionByName(team_box.select("game_id", "updated_at")))
    return combined.groupBy("game_id").agg(F.max("updated_at").alias("boxscore_loaded_at"))


def stg_api_call_logs(api_calls: DataFrame, mark: Column | None = None) -> DataFrame:
    """M4: API call log with a call date; incremental runs take calls at or after the mark."""
    src = api_calls if mark is None else api_calls.filter(F.col("call_time") >= mark)
    return src.select(
        "id", "endpoint", "call_time",
        F.col("call_time").cast("date").alias("call_date"),
        "success", "error_message",
        F.col("call_time").alias("updated_at"),
    )


def _box_presence(team_box: DataFrame, mark: Column | None) -> DataFrame:
    bp = team_box.select("game_id", "updated_at")
    if mark is not None:
        bp = bp.filter(F.col("updated_at") >= mark)
    return bp.distinct()


def _game_versions(games: DataFrame, mark: Column | None, latest_only: bool = False) -> DataFrame:
    gf = games.select("game_id", F.col("game_date").cast("date").alias("game_date"), "updated_at")
    if mark is not None:
        gf = gf.filter(F.col("updated_at") >= mark)
    gf = gf.distinct()
    if latest_only:
        # Trap T8: DISTINCT (game, date, stamp) keeps every stamped version of a game.
        # latest_only keeps the newest stamp per game (a game with only NULL stamps keeps one row).
        gf = gf.groupBy("game_id", "game_date").agg(F.max("updated_at").alias("updated_at"))
    return gf


def stg_game_boxscore_status(games: DataFrame, team_box: DataFrame, date_status: DataFrame,
                             mark: Column | None = None, latest_only: bool = False) -> DataFrame:
    """M5: per (game_date, game_id): is a team box loaded, the date's retry count, last change."""
    gf = _game_versions(games, mark, latest_only).alias("gf")
    bp = _box_presence(team_box, mark).alias("bp")
    dps = date_status.select(F.col("date").alias("dps_date"), F.col("retry_count").alias("dps_retry"),
                             F.col("last_checked").alias("dps_checked"))
    j = gf.join(bp, F.col("gf.game_id") == F.col("bp.game_id"), "left")
    # One status row per calendar date: adaptive execution sees its size and broadcasts it.
    j = j.join(dps, F.col("gf.game_date") == F.col("dps_date"), "left")
    if mark is not None:
        j = j.filter((F.col("gf.updated_at") >= mark) | (F.col("bp.updated_at") >= mark)
                     | (F.col("dps_checked") >= mark))
    return j.select(
        F.col("gf.game_date").alias("game_date"),
        F.col("gf.game_id").alias("game_id"),
        F.col("bp.game_id").isNotNull().alias("has_boxscore"),
        F.coalesce(F.col("dps_retry"), F.lit(0)).cast("int").alias("retry_count"),
        X.greatest_skip_nulls("gf.updated_at", "bp.updated_at", "dps_checked").alias("updated_at"),
    )


def game_box_flags(games: DataFrame, team_box: DataFrame, mark: Column | None = None) -> DataFrame:
    """Inner part of M6: game versions with a team-box flag and a combined stamp."""
    gf = _game_versions(games, mark).alias("gf")
    bp = _box_presence(team_box, mark).alias("bp")
    j = gf.join(bp, F.col("gf.game_id") == F.col("bp.game_id"), "left")
    return j.select(
        F.col("gf.game_date").alias("game_date"),
        F.col("gf.game_id").alias("game_id"),
        F.col("bp.game_id").isNotNull().alias("has_boxscore"),
        F.greatest(F.col("gf.updated_at"), F.coalesce(F.col("bp.updated_at"), F.col("gf.updated_at")))
        .alias("updated_at"),
    )


def stg_daily_game_summary(games: DataFrame, team_box: DataFrame, mark: Column | None = None) -> DataFrame:
    """M6: per game date: distinct games, distinct games with a team box, last change."""
    flags = game_box_flags(games, team_box, mark)
    out = flags.groupBy("game_date").agg(
        F.count_distinct("game_id").cast("bigint").alias("games_count"),
        F.count_distinct(F.when(F.col("has_boxscore"), F.col("game_id"))).cast("bigint").alias("boxscores_count"),
        F.max("updated_at").alias("updated_at"),
    )
    if mark is not None:
        out = out.filter(F.col("updated_at") >= mark)
    return out
