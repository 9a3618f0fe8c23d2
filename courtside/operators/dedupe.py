"""Keep one version per key.

``row_number() = 1`` over the key, ordered by preference. Spark plans the filter on the
row number as a partial ``WindowGroupLimit`` before the shuffle: each map task sorts its
rows (code-generated sort) and keeps one row per key, so a key holding a third of all
rows is collapsed map-side instead of landing whole in one task. (A grouped ``max_by``
over a row struct gives the same rows but runs as an interpreted sort aggregate.)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import expressions as X


def keep_preferred(df: DataFrame, keys: list[str], order: list[Column],
                   columns: list[str] | None = None) -> DataFrame:
    """One row per ``keys``: the first row under ``order`` (sort expressions, most preferred first).

    ``order`` must be unique inside a key (end it with a unique id) for the pick to be
    deterministic.
    """
    cols = [c for c in (columns or df.columns) if c not in keys]
    w = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn("_rn", F.row_number().over(w))
    return ranked.filter(F.col("_rn") <= 1).select(*keys, *cols)


def newest_first(updated_at: str = "updated_at", tie: str = "id") -> list[Column]:
    """``coalesce(updated_at, epoch) DESC, id DESC``."""
    return [F.coalesce(F.col(updated_at), X.epoch()).desc(), F.col(tie).desc()]


def official_then_newest(season_id: str = "season_id", updated_at: str = "updated_at") -> list[Column]:
    """Official phase first (an unknown phase is not official, like any other that is not), then
    ``coalesce(updated_at, epoch) DESC``, then ``season_id DESC`` with NULLs first (the source
    database's DESC rule), then ``id DESC`` so that the pick is unique."""
    return [
        F.coalesce(X.is_official(season_id), F.lit(False)).desc(),
        F.coalesce(F.col(updated_at), X.epoch()).desc(),
        F.col(season_id).desc_nulls_first(),
        F.col("id").desc(),
    ]


def canonical_player_box(player_box: DataFrame, of_game: list[str] | None = None) -> DataFrame:
    """Latest version per (game_id, player_id), rows with a null key dropped; ``of_game`` are further columns to keep."""
    pb = player_box.filter(F.col("game_id").isNotNull() & F.col("player_id").isNotNull())
    cols = ["player_name", "team_id", "pts", "min", "ast", "reb", "dreb", "oreb", "stl", "blk", "pf",
            "fgm", "fga", "fg3m", "fg3a", "ftm", "fta", *(of_game or [])]
    return keep_preferred(pb, ["game_id", "player_id"], newest_first(), cols)


def canonical_games(games: DataFrame) -> DataFrame:
    """Preferred version per game_id: official phase first, newest, then season id desc."""
    return keep_preferred(games, ["game_id"], official_then_newest(), ["season_id", "game_date", "updated_at"])
