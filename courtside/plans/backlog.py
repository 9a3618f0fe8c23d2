"""Work queue and backlog: calendar of dates, status changes, missing box scores and summaries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import merge
from ..operators.ranking import fixed_batches
from ..sources import schemas

# ---------------------------------------------------------------------------------------------
# Default days queued per run, box scores per catch-up run, batch size.
LAST_N_DAYS = 3
MAX_BOXSCORES_PER_RUN = 5
BATCH_SIZE = 10
# ---------------------------------------------------------------------------------------------


def calendar(spark: SparkSession, start: str, end: str) -> DataFrame:
    """Every date from ``start`` to ``end``, both included, generated across partitions."""
    n = (dt.date.fromisoformat(end) - dt.date.fromisoformat(start)).days + 1
    return spark.range(max(n, 0)).select(F.date_add(F.lit(start).cast("date"), F.col("id").cast("int")).alias("date"))


def populate_pending_dates(spark: SparkSession, status: DataFrame, as_of: str,
                           last_n_days: int = LAST_N_DAYS) -> DataFrame:
    """Queue ``as_of - n .. as_of - 1`` as pending; dates already present stay as they are.

    New rows get the declared defaults: last_checked = the run time, retry_count = 0.
    """
    today = dt.datetime.fromisoformat(as_of)
    start = (today - dt.timedelta(days=last_n_days)).date().isoformat()
    end = (today - dt.timedelta(days=1)).date().isoformat()
    stamp = F.lit(as_of).cast("timestamp_ntz")
    rows = calendar(spark, start, end).select(
        "date", F.lit("pending").alias("status"), stamp.alias("last_checked"),
        F.lit(0).cast("int").alias("retry_count"), stamp.alias("created_at"),
        F.lit(None).cast("timestamp_ntz").alias("updated_at"))
    return merge.insert_ignore(status, rows, schemas.TABLE_KEYS["date_status"])


def pending_dates(status: DataFrame) -> DataFrame:
    """Pending dates, newest first (the equality filter reaches the parquet scan)."""
    return status.filter(F.col("status") == "pending").select("date").orderBy(F.col("date").desc())


def update_status(status: DataFrame, outcomes: DataFrame, as_of: str) -> DataFrame:
    """Pending -> processed / no_games for dates with a usable payload; an error outcome
    leaves the date unchanged; outcomes for dates not in the table insert nothing."""
    upd = (outcomes.filter(F.col("outcome") != "error")
           .select("date", F.col("outcome").alias("status"),
                   F.lit(as_of).cast("timestamp_ntz").alias("updated_at")))
    return merge.update_only(status, upd, ["date"], ["status", "updated_at"])


def missing_boxscores(games: DataFrame, team_box: DataFrame) -> DataFrame:
    """Games listed but without a team box score (set difference on game id)."""
    listed = games.select("game_id").filter(F.col("game_id").isNotNull()).distinct()
    loaded = team_box.select("game_id").filter(F.col("game_id").isNotNull()).distinct()
    return listed.join(loaded, "game_id", "left_anti")


def next_boxscore_batch(games: DataFrame, team_box: DataFrame, n: int = MAX_BOXSCORES_PER_RUN) -> DataFrame:
    """The next ``n`` missing games, in game-id order (the cap is the feature)."""
    return missing_boxscores(games, team_box).orderBy("game_id").limit(n)


def backlog_batches(games: DataFrame, team_box: DataFrame, size: int = BATCH_SIZE) -> DataFrame:
    """Every missing game with its batch number, ``size`` games per batch in game-id order."""
    return fixed_batches(missing_boxscores(games, team_box), ["game_id"], size)


def missing_summaries(games: DataFrame, summaries: DataFrame) -> DataFrame:
    """Games without a summary row, no cap."""
    listed = games.select("game_id").filter(F.col("game_id").isNotNull()).distinct()
    return listed.join(summaries.select("game_id").distinct(), "game_id", "left_anti")


def coverage_counts(games: DataFrame, team_box: DataFrame) -> DataFrame:
    """Total listed games, games missing a team box, games with one."""
    listed = games.select("game_id").filter(F.col("game_id").isNotNull()).distinct()
    loaded = team_box.select("game_id").filter(F.col("game_id").isNotNull()).distinct() \
        .withColumn("_loaded", F.lit(True))
    j = listed.join(loaded, "game_id", "left")
    return j.agg(
        F.count(F.lit(1)).cast("bigint").alias("total_games"),
        F.count_if(F.col("_loaded").isNull()).cast("bigint").alias("missing_games"),
        F.count_if(F.col("_loaded")).cast("bigint").alias("populated_games"),
    )


def games_in_date_range(games: DataFrame, start: str, end: str, league_prefix: str | None = None) -> DataFrame:
    """Game rows dated ``start..end`` inclusive, optionally one league's game ids.

    Stored dates are ISO text, whose order is that of the dates: both bounds reach the parquet scan.
    """
    out = games.filter(F.col("game_date").between(dt.date.fromisoformat(start).isoformat(),
                                                  dt.date.fromisoformat(end).isoformat()))
    if league_prefix is not None:
        out = out.filter(F.col("game_id").startswith(league_prefix))
    return out


def date_outcomes(landing_outcomes: DataFrame, status: DataFrame) -> DataFrame:
    """F14 for the pending dates: error (payload missing), no_games (no game ids), processed."""
    pend = status.filter(F.col("status") == "pending").select("date")
    return landing_outcomes.join(pend, "date")
