"""M7: season coverage - games found, box scores loaded, expected games per season."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import expressions as X


def season_decode(season_ids: DataFrame, season_col: str = "season_id") -> DataFrame:
    """Phase digit, phase name, start year and official flag of each season code."""
    s = F.col(season_col)
    return season_ids.select(
        s.alias("season_id"),
        X.season_phase(s).alias("season_part"),
        X.season_phase_name(s).alias("season_part_name"),
        X.season_start_year(s).alias("start_year"),
        X.is_official(s).alias("is_official"),
    )


def available_seasons(games: DataFrame, player_box: DataFrame) -> DataFrame:
    # One row per (season, game): a game listed under two seasons counts in both (trap T11).
    season_games = (games
                    .filter(F.col("season_id").isNotNull() & F.col("game_id").isNotNull())
                    .groupBy("season_id", "game_id")
                    .agg(F.min(F.col("game_date").cast("date")).alias("game_date"),
                         F.max("updated_at").alias("updated_at")))
    # "Has a box score" here means player stats exist (trap T9). Pre-aggregated before the join.
    boxes = (player_box.filter(F.col("game_id").isNotNull())
             .groupBy("game_id").agg(F.max("updated_at").alias("box_updated_at")))
    g = season_games.join(boxes.withColumnRenamed("game_id", "box_game_id"),
                          F.col("game_id") == F.col("box_game_id"), "left")
    rollup = g.groupBy("season_id").agg(
        F.min("game_date").alias("first_game_date"),
        F.max("game_date").alias("last_game_date"),
        F.count_distinct("game_id").cast("bigint").alias("found_games"),
        F.count_distinct(F.when(F.col("box_game_id").isNotNull(), F.col("game_id"))).cast("bigint")
        .alias("loaded_boxscores"),
        F.greatest(F.max("updated_at"), F.coalesce(F.max("box_updated_at"), X.epoch())).alias("latest_update"),
    )
    phase = X.season_phase("season_id")
    expected = X.expected_games(phase, "found_games")
    return rollup.select(
        "season_id",
        X.season_start_year("season_id").alias("start_year"),
        phase.alias("season_part"),
        X.season_phase_name("season_id").alias("season_part_name"),
        "first_game_date", "last_game_date", "found_games", "loaded_boxscores",
        expected.alias("expected_games"),
        (expected - F.col("found_games")).alias("games_to_load"),
        (F.col("found_games") - F.col("loaded_boxscores")).alias("missing_boxscores"),
        "latest_update",
    )
