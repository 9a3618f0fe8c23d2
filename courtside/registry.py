"""Named queries over the driver's tables: ``name -> fn(spark, sf_dir) -> DataFrame``.

Each entry reads the whole raw-shaped tables of one scale-factor folder. Parameters are
fixed here (start date, recency, depth, clocks) so the oracles in ``oracles.py`` can use
the same literals.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import expressions as X
from .operators import dedupe
from .operators.joins import dimension
from .plans import leaderboard as LB
from .plans import seasons, staging
from .session import scratch_path
from .sources.driver_fixtures import DriverTables, box_landing, game_landing, summary_landing
from .sources.tables import register_views, store_bucketed

# Parameters of the registered queries on the driver's data (FIXTURES.md).
START_DATE = "2001-06-01"
AS_OF = "2001-08-02 00:00:00"
PARAMS = LB.Params(start_date=START_DATE, recency_days=10, k=20, as_of=AS_OF)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


_TABLES: dict[str, DriverTables] = {}


def tables(spark: SparkSession, sf_dir: str) -> DriverTables:
    """Raw-shaped views of one folder, defined once per session (plans are lazy; nothing is cached)."""
    key = sf_dir.rstrip("/")
    if key not in _TABLES or _TABLES[key].spark is not spark:
        _TABLES[key] = DriverTables(spark, sf_dir)
    return _TABLES[key]


def inputs(t: DriverTables) -> LB.Inputs:
    return LB.Inputs(player_box=t.player_box_by_game, games=t.games, date_status=t.date_status)


# -- scans (S1-S6) ----------------------------------------------------------------------------

@query("scan_games")
def q_scan_games(spark, sf_dir):
    return tables(spark, sf_dir).games


@query("scan_player_box")
def q_scan_player_box(spark, sf_dir):
    return tables(spark, sf_dir).player_box


@query("scan_team_box")
def q_scan_team_box(spark, sf_dir):
    return tables(spark, sf_dir).team_box


@query("scan_bench_box")
def q_scan_bench_box(spark, sf_dir):
    return tables(spark, sf_dir).bench_box


# -- staging models (M1-M6) --------------------------------------------------------------------

@query("stg_gamefinder")
def q_stg_gamefinder(spark, sf_dir):
    return staging.stg_gamefinder(tables(spark, sf_dir).games)


@query("stg_date_processing_status")
def q_stg_date_processing_status(spark, sf_dir):
    return staging.stg_date_processing_status(tables(spark, sf_dir).date_status)


@query("stg_boxscores")
def q_stg_boxscores(spark, sf_dir):
    t = tables(spark, sf_dir)
    return staging.stg_boxscores(t.player_box, t.bench_box, t.team_box)


@query("stg_api_call_logs")
def q_stg_api_call_logs(spark, sf_dir):
    return staging.stg_api_call_logs(tables(spark, sf_dir).api_calls)


@query("stg_game_boxscore_status")
def q_stg_game_boxscore_status(spark, sf_dir):
    t = tables(spark, sf_dir)
    return staging.stg_game_boxscore_status(t.games, t.team_box, t.date_status)


@query("stg_game_boxscore_status_latest")
def q_stg_game_boxscore_status_latest(spark, sf_dir):
    t = tables(spark, sf_dir)
    return staging.stg_game_boxscore_status(t.games, t.team_box, t.date_status, latest_only=True)


@query("stg_daily_game_summary")
def q_stg_daily_game_summary(spark, sf_dir):
    t = tables(spark, sf_dir)
    return staging.stg_daily_game_summary(t.games, t.team_box)


@query("available_seasons")
def q_available_seasons(spark, sf_dir):
    t = tables(spark, sf_dir)
    return seasons.available_seasons(t.games, t.player_box)


# -- expressions (C1-C20) ----------------------------------------------------------------------

@query("season_decode")
def q_season_decode(spark, sf_dir):
    ids = tables(spark, sf_dir).games.select("season_id").filter(F.col("season_id").isNotNull()).distinct()
    s = seasons.season_decode(ids)
    return s.select("*", X.expected_games("season_part", F.lit(0)).alias("expected_games_if_none_found"))


@query("minutes_parsed")
def q_minutes_parsed(spark, sf_dir):
    pb = tables(spark, sf_dir).player_box
    return pb.select(
        "id", F.col("min").alias("min_str"),
        X.minutes_seconds("min").cast("double").alias("minutes_sec"),
        X.minutes_decimal("min").alias("minutes_dec"),
        X.played("pts", "min").alias("played"),
    )


@query("ten_plus_count")
def q_ten_plus_count(spark, sf_dir):
    pb = tables(spark, sf_dir).player_box
    return pb.select("id", X.ten_plus_count().alias("ten_plus_count"))


@query("coerce_dates")
def q_coerce_dates(spark, sf_dir):
    t = tables(spark, sf_dir)
    g = t.games.select(
        "id", "game_date",
        X.coerce_date("game_date").alias("as_date"),
        X.coerce_date(F.concat(F.col("game_date"), F.lit("x"))).alias("junk_as_date"),
        X.coerce_date("updated_at", kind="datetime").alias("stamp_as_date"),
    )
    return g.select("*", X.to_mdy("as_date").alias("request_date"))


# -- dedupe and leaderboard chain (W1, W2, M8) -------------------------------------------------

@query("player_box_canonical")
def q_player_box_canonical(spark, sf_dir):
    return dedupe.canonical_player_box(tables(spark, sf_dir).player_box)


@query("games_canonical")
def q_games_canonical(spark, sf_dir):
    return dedupe.canonical_games(tables(spark, sf_dir).games)


@query("player_game_facts")
def q_player_game_facts(spark, sf_dir):
    return LB.player_game_facts(tables(spark, sf_dir).player_box).drop("minutes_sec").select(
        "*", X.minutes_decimal("min_str").alias("minutes_dec"))


@query("season_latest_dates")
def q_season_latest_dates(spark, sf_dir):
    return LB.season_latest_dates(dedupe.canonical_games(tables(spark, sf_dir).games))


@query("player_games_with_meta")
def q_player_games_with_meta(spark, sf_dir):
    pgm, _ = LB.build_meta(inputs(tables(spark, sf_dir)))
    return pgm.drop("minutes_sec").select("*", X.minutes_decimal("min_str").alias("minutes_dec"))


@query("processed_cutoffs")
def q_processed_cutoffs(spark, sf_dir):
    t = tables(spark, sf_dir)
    return LB.processed_cutoffs(staging.stg_date_processing_status(t.date_status), START_DATE)


@query("season_cutoffs")
def q_season_cutoffs(spark, sf_dir):
    t = tables(spark, sf_dir)
    _, latest = LB.build_meta(inputs(t))
    cut = LB.processed_cutoffs(staging.stg_date_processing_status(t.date_status), START_DATE)
    return LB.season_cutoffs(cut, latest, PARAMS)


@query("scoped_player_games")
def q_scoped_player_games(spark, sf_dir):
    t = tables(spark, sf_dir)
    pgm, latest = LB.build_meta(inputs(t))
    cut = LB.processed_cutoffs(staging.stg_date_processing_status(t.date_status), START_DATE)
    scoped = LB.scoped_player_games(pgm, LB.season_cutoffs(cut, latest, PARAMS))
    return scoped.select("cutoff_date", "season_id", "player_id", "game_id", "game_date", "team_id",
                         "latest_season_game_date", "pts",
                         F.col("minutes_sec").cast("double").alias("minutes_sec"), "ten_plus_count")


@query("player_latest_team")
def q_player_latest_team(spark, sf_dir):
    pgm, _ = LB.build_meta(inputs(tables(spark, sf_dir)))
    return pgm.groupBy("season_id", "player_id").agg(
        F.max_by("team_id", F.struct("game_date", "game_id")).alias("team_id"))


@query("player_aggregates")
def q_player_aggregates(spark, sf_dir):
    return LB.player_aggregates(inputs(tables(spark, sf_dir)), PARAMS, "running")


@query("leaderboard_long")
def q_leaderboard_long(spark, sf_dir):
    return LB.leaderboard_long(LB.player_aggregates(inputs(tables(spark, sf_dir)), PARAMS, "running"))


@query("top20_by_metric")
def q_top20_by_metric(spark, sf_dir):
    return LB.top20_by_metric(inputs(tables(spark, sf_dir)), PARAMS, "running")


@query("top20_by_metric_windowed")
def q_top20_windowed(spark, sf_dir):
    return LB.top20_by_metric(inputs(tables(spark, sf_dir)), PARAMS, "windowed")


@query("top20_by_metric_direct")
def q_top20_direct(spark, sf_dir):
    return LB.top20_by_metric(inputs(tables(spark, sf_dir)), PARAMS, "direct")


# -- simple aggregates (A10-A13) ---------------------------------------------------------------

@query("distinct_game_ids")
def q_distinct_game_ids(spark, sf_dir):
    from .sources.tables import distinct_game_ids
    return distinct_game_ids(spark, tables(spark, sf_dir).games)


@query("high_water_mark")
def q_high_water_mark(spark, sf_dir):
    """``max(updated_at)`` of the staged API log, as the incremental runs read it."""
    logs = staging.stg_api_call_logs(tables(spark, sf_dir).api_calls)
    return logs.agg(F.max("updated_at").alias("high_water_mark"), F.count(F.lit(1)).alias("rows_behind_mark"))


@query("distinct_game_versions")
def q_distinct_game_versions(spark, sf_dir):
    return tables(spark, sf_dir).team_box.select("game_id", "updated_at").distinct()


# -- backlog and work queue (M10-M15) ----------------------------------------------------------
from .operators import checks, merge  # noqa: E402
from .plans import backlog, daily_state, incremental, ingest  # noqa: E402
from .sources import landing  # noqa: E402

QUEUE_AS_OF = "2001-08-10 08:25:00"
QUEUE_DAYS = 30
RANGE_START, RANGE_END = "1996-01-01", "1996-12-31"
UPSERT_TARGET_BEFORE = "2000-01-01"
API_T0 = "2024-01-20 00:00:00"
BOX_T0 = "1998-01-01 00:00:00"
TOP20_FIRST_RUN_BEFORE = "2001-07-01"
GAME_BUCKETS = 16
BOX_BOUND, CLOCK = "14 days", "2010-01-01 00:00:00"


@query("populate_pending_dates")
def q_populate_pending_dates(spark, sf_dir):
    return backlog.populate_pending_dates(spark, tables(spark, sf_dir).date_status, QUEUE_AS_OF, QUEUE_DAYS)


@query("pending_dates")
def q_pending_dates(spark, sf_dir):
    return backlog.pending_dates(tables(spark, sf_dir).date_status)


@query("date_outcomes")
def q_date_outcomes(spark, sf_dir):
    t = tables(spark, sf_dir)
    return backlog.date_outcomes(landing.date_outcomes(game_landing(t)), t.date_status)


@query("update_status")
def q_update_status(spark, sf_dir):
    t = tables(spark, sf_dir)
    outcomes = backlog.date_outcomes(landing.date_outcomes(game_landing(t)), t.date_status)
    return backlog.update_status(t.date_status, outcomes, QUEUE_AS_OF)


@query("missing_boxscores")
def q_missing_boxscores(spark, sf_dir):
    t = tables(spark, sf_dir)
    return backlog.missing_boxscores(t.games, t.team_box)


@query("next_boxscore_batch")
def q_next_boxscore_batch(spark, sf_dir):
    t = tables(spark, sf_dir)
    return backlog.next_boxscore_batch(t.games, t.team_box)


@query("backlog_batches")
def q_backlog_batches(spark, sf_dir):
    t = tables(spark, sf_dir)
    return backlog.backlog_batches(t.games, t.team_box)


@query("missing_summaries")
def q_missing_summaries(spark, sf_dir):
    t = tables(spark, sf_dir)
    return backlog.missing_summaries(t.games, t.game_summary)


@query("coverage_counts")
def q_coverage_counts(spark, sf_dir):
    t = tables(spark, sf_dir)
    return backlog.coverage_counts(t.games, t.team_box)


@query("games_in_date_range")
def q_games_in_date_range(spark, sf_dir):
    return backlog.games_in_date_range(tables(spark, sf_dir).games, RANGE_START, RANGE_END)


# -- incremental models (I1-I5), two runs each ---------------------------------------------------

def _before(df, col: str, t0: str):
    """The state of a source before ``t0``: rows stamped earlier, or never stamped."""
    return df.filter(F.col(col).isNull() | (F.col(col) < F.lit(t0).cast("timestamp_ntz")))


def _stored(spark, first, name: str, part: str) -> tuple[str, DataFrame]:
    """A first run's rows as a partitioned table."""
    path = scratch_path(spark, name)
    return path, merge.materialize_at(spark, first, path, [part])


def _stored_by_month(spark, first, name: str) -> tuple[str, DataFrame]:
    """A first run's rows, stored by the month of their game date."""
    path = scratch_path(spark, name)
    return path, merge.materialize_at(spark, first.withColumn("month", merge.month_of("game_date")), path, ["month"]).drop("month")


def _replaced(spark, path: str, target: DataFrame, batch: DataFrame, keys: list[str], gone: DataFrame | None = None) -> DataFrame:
    return merge.replace_in_partitions(spark, path, target.schema, batch, keys, "month", gone, part=merge.month_of("game_date"))


@query("apilogs_incremental")
def q_apilogs_incremental(spark, sf_dir):
    t = tables(spark, sf_dir)
    first = incremental.apilogs_batch(_before(t.api_calls, "call_time", API_T0), None)
    path, target = _stored(spark, first, "apilogs", "call_date")
    batch = incremental.apilogs_batch(t.api_calls, target)
    return merge.replace_in_partitions(spark, path, target.schema, batch, ["id"], "call_date")


def _apilogs_by_day(spark, t) -> tuple[str, DataFrame, DataFrame]:
    """The log stored by a first run, and the second run's batch from calls stored by day."""
    first = incremental.apilogs_batch(_before(t.api_calls, "call_time", API_T0), None)
    path, target = _stored(spark, first, "apilogs", "call_date")
    _, calls = _stored(spark, t.api_calls.withColumn("call_date", F.col("call_time").cast("date")), "api-calls-by-day", "call_date")
    return path, target, incremental.apilogs_batch_by_day(calls, target)


@query("apilogs_incremental_by_day")
def q_apilogs_incremental_by_day(spark, sf_dir):
    """The mark prunes the folders of the input."""
    path, target, batch = _apilogs_by_day(spark, tables(spark, sf_dir))
    return merge.replace_in_partitions(spark, path, target.schema, batch, ["id"], "call_date")


def _daily_first(spark, t):
    return _stored_by_month(spark, incremental.daily_batch(_before(t.games, "updated_at", BOX_T0),
                                                           _before(t.team_box, "updated_at", BOX_T0), None), "daily")


@query("daily_incremental")
def q_daily_incremental(spark, sf_dir):
    t = tables(spark, sf_dir)
    path, target = _daily_first(spark, t)
    batch = incremental.daily_batch(t.games, t.team_box, target)
    return _replaced(spark, path, target, batch, ["game_date"])


@query("daily_incremental_state")
def q_daily_incremental_state(spark, sf_dir):
    """I2 with mergeable state: the counts of the rows before the mark are stored as bitmaps; the second run reads the
    rows since the mark and the state of the days they touch."""
    t = tables(spark, sf_dir)
    state = daily_state.DailyState.start(spark, _before(t.games, "updated_at", BOX_T0), _before(t.team_box, "updated_at", BOX_T0))
    since = F.col("updated_at") >= F.lit(BOX_T0).cast("timestamp_ntz")
    state.add(t.games.filter(since), t.team_box.filter(since))
    return state.summary()


def _known(df, column: str, t0: str):
    """The state of a source before ``t0`` when rows never stamped arrive later."""
    return df.filter(F.col(column) < F.lit(t0).cast("timestamp_ntz"))


def _moved(games, t0: str):
    """The games known before ``t0``; every seventh then stood a day earlier and has moved since."""
    known = _known(games, "updated_at", t0)
    touched = games.filter(~(F.col("updated_at") < F.lit(t0).cast("timestamp_ntz")) | F.col("updated_at").isNull())
    mark = touched.select("game_id").distinct().withColumn("_again", F.lit(True))
    earlier = F.date_sub(F.col("game_date").cast("date"), 1).cast("string")
    known = known.join(mark, "game_id", "left")
    return known.withColumn("game_date", F.when(F.col("_again") & (F.col("id") % 7 == 0), earlier)
                            .otherwise(F.col("game_date"))).drop("_again")


@query("daily_affected_keys")
def q_daily_affected_keys(spark, sf_dir):
    t = tables(spark, sf_dir)
    games, box = _moved(t.games, BOX_T0), _known(t.team_box, "updated_at", BOX_T0)
    path, target = _stored_by_month(spark, staging.stg_daily_game_summary(games, box), "daily")
    placed = games.select("game_id", F.col("game_date").cast("date").alias("game_date")).distinct()
    fresh, days = incremental.daily_affected_keys(t.games, t.team_box, placed, BOX_T0)
    return _replaced(spark, path, target, fresh, ["game_date"], days)


@query("gbs_incremental")
def q_gbs_incremental(spark, sf_dir):
    t = tables(spark, sf_dir)
    first = incremental.gbs_batch(_before(t.games, "updated_at", BOX_T0), _before(t.team_box, "updated_at", BOX_T0),
                                  _before(t.date_status, "last_checked", BOX_T0), None)
    path, target = _stored_by_month(spark, first, "gbs")
    batch = incremental.gbs_batch(t.games, t.team_box, t.date_status, target)
    return _replaced(spark, path, target, batch, ["game_date", "game_id"])


@query("gbs_affected_keys")
def q_gbs_affected_keys(spark, sf_dir):
    t = tables(spark, sf_dir)
    first = staging.stg_game_boxscore_status(_moved(t.games, BOX_T0), _known(t.team_box, "updated_at", BOX_T0),
                                             _known(t.date_status, "last_checked", BOX_T0))
    path, target = _stored_by_month(spark, first, "gbs")
    fresh, gone = incremental.gbs_affected_keys(t.games, t.team_box, t.date_status, target, BOX_T0)
    return _replaced(spark, path, target, fresh, ["game_date", "game_id"], gone)


@query("top20_incremental")
def q_top20_incremental(spark, sf_dir):
    t = tables(spark, sf_dir)
    early = LB.Inputs(player_box=t.player_box, games=t.games,
                      date_status=t.date_status.filter(F.col("date") < F.lit(TOP20_FIRST_RUN_BEFORE).cast("date")))
    path = scratch_path(spark, "top20")
    first = merge.materialize_at(spark, LB.top20_by_metric(early, PARAMS), path, ["cutoff_date"])
    # Second run: snapshots for dates the stored table lacks, appended as new partitions.
    new = LB.top20_by_metric(inputs(t), PARAMS, existing=first)
    return merge.append_partitions(spark, new, path, ["cutoff_date"], first)


# -- stored forms: full rebuild (K7), views (K8), changed columns on stored files (K11) --------------------

@query("available_seasons_rebuilt")
def q_available_seasons_rebuilt(spark, sf_dir):
    """K7: a model stored by an earlier run is rebuilt in full; readers change to the new version when it is complete."""
    t = tables(spark, sf_dir)
    early = seasons.available_seasons(_before(t.games, "updated_at", BOX_T0), t.player_box)
    path = scratch_path(spark, "available-seasons")
    merge.rebuild(spark, early, path)
    return merge.rebuild(spark, seasons.available_seasons(t.games, t.player_box), path)


@query("daily_summary_by_views")
def q_daily_summary_by_views(spark, sf_dir):
    """K8: the staging models as views, read by name: games and loaded box scores of each date."""
    t = tables(spark, sf_dir)
    register_views({"stg_gamefinder_view": staging.stg_gamefinder(t.games),
                    "stg_boxscores_view": staging.stg_boxscores(t.player_box, t.bench_box, t.team_box)})
    return spark.sql("""
        SELECT game_date, count(DISTINCT g.game_id) AS games, count(DISTINCT b.game_id) AS loaded, max(boxscore_loaded_at) AS last_loaded
        FROM stg_gamefinder_view g LEFT JOIN stg_boxscores_view b ON b.game_id = g.game_id GROUP BY game_date""")


@query("daily_columns_synced")
def q_daily_columns_synced(spark, sf_dir):
    """K11, ``sync_all_columns`` on stored files: the stored summary has a column that is gone since, lacks one that is
    new, and counts in a narrower type. Only the months of the new days are rewritten; older files are read with the
    new columns (null where they have none) and widened."""
    t = tables(spark, sf_dir)
    full = staging.stg_daily_game_summary(t.games, t.team_box)
    old = full.select("game_date", F.col("games_count").cast("int").alias("games_count"), F.lit("v1").alias("layout"), "updated_at")
    path, target = _stored_by_month(spark, old, "daily-v1")
    fresh = full.filter(F.col("game_date") >= F.lit(BOX_T0).cast("date"))
    return merge.replace_in_partitions(spark, path, target.schema, fresh, ["game_date"], "month", policy="sync_all_columns",
                                       part=merge.month_of("game_date"))


def colocated(spark, t: DriverTables, *names: str) -> dict[str, DataFrame]:
    """Raw tables stored in buckets of ``game_id``."""
    out = {}
    for name in names:
        path = scratch_path(spark, f"{name}-by-game")
        out[name] = store_bucketed(getattr(t, name), path.rsplit("/", 1)[1].replace("-", "_"), "game_id", path, GAME_BUCKETS)
    return out


@query("player_games_colocated")
def q_player_games_colocated(spark, sf_dir):
    """J1 over tables in buckets of ``game_id``: neither the dedupes nor the join exchange rows by game."""
    stored = colocated(spark, tables(spark, sf_dir), "games", "player_box")
    games = dedupe.canonical_games(stored["games"])
    # Seasons: counted, and broadcast under the helper's bound, so that games are not dealt by season.
    latest = dimension(LB.season_latest_dates(games))
    pgm = LB.player_games_with_meta(LB.player_game_facts(stored["player_box"]), games, F.broadcast(latest.df) if latest.small else latest.df)
    return pgm.drop("minutes_sec").select("*", X.minutes_decimal("min_str").alias("minutes_dec"))


@query("gbs_colocated")
def q_gbs_colocated(spark, sf_dir):
    """M5 (J5, J6) over tables in buckets of ``game_id``."""
    t = tables(spark, sf_dir)
    stored = colocated(spark, t, "games", "team_box")
    return staging.stg_game_boxscore_status(stored["games"], stored["team_box"], t.date_status)


# -- data checks (D1-D7) -----------------------------------------------------------------------

@query("dq_available_seasons")
def q_dq_available_seasons(spark, sf_dir):
    t = tables(spark, sf_dir)
    return checks.run_checks(seasons.available_seasons(t.games, t.player_box), checks.AVAILABLE_SEASONS_RULES)


@query("dq_top20")
def q_dq_top20(spark, sf_dir):
    return checks.run_checks(LB.top20_by_metric(inputs(tables(spark, sf_dir)), PARAMS), checks.TOP20_RULES)


@query("dq_available_seasons_observed")
def q_dq_available_seasons_observed(spark, sf_dir):
    """D1, D2, D4 while the model is written."""
    t = tables(spark, sf_dir)
    model = seasons.available_seasons(t.games, t.player_box)
    return checks.write_checked(model, checks.AVAILABLE_SEASONS_RULES, scratch_path(spark, "seasons-checked"))[1]


@query("dq_game_boxscore_status_observed")
def q_dq_game_boxscore_status_observed(spark, sf_dir):
    """D1, D3/D6 while the model is written."""
    t = tables(spark, sf_dir)
    model = staging.stg_game_boxscore_status(t.games, t.team_box, t.date_status)
    return checks.write_checked(model, checks.BOX_STATUS_RULES, scratch_path(spark, "gbs-checked"))[1]


@query("dq_api_call_logs")
def q_dq_api_call_logs(spark, sf_dir):
    return checks.run_checks(staging.stg_api_call_logs(tables(spark, sf_dir).api_calls), checks.API_LOG_RULES)


@query("dq_daily_game_summary")
def q_dq_daily_game_summary(spark, sf_dir):
    t = tables(spark, sf_dir)
    return checks.run_checks(staging.stg_daily_game_summary(t.games, t.team_box), checks.DAILY_SUMMARY_RULES)


@query("dq_game_boxscore_status")
def q_dq_game_boxscore_status(spark, sf_dir):
    t = tables(spark, sf_dir)
    return checks.run_checks(staging.stg_game_boxscore_status(t.games, t.team_box, t.date_status), checks.BOX_STATUS_RULES)


@query("dq_date_status")
def q_dq_date_status(spark, sf_dir):
    return checks.run_checks(tables(spark, sf_dir).date_status, checks.DATE_STATUS_RULES)


# -- ingest of landed responses (S13-S16, K1-K4) -------------------------------------------------

def _landings(t):
    return [game_landing(t), box_landing(t), summary_landing(t)]


def _responses(t):
    return reduce(DataFrame.unionByName, _landings(t))


@query("split_result_sets")
def q_split_result_sets(spark, sf_dir):
    s = landing.split_result_sets(_responses(tables(spark, sf_dir)))
    return s.select("table_name", "endpoint", "request_key", "result_set",
                    F.array_join("key_columns", ",").alias("key_columns"))


@query("box_payload_quarantine")
def q_box_payload_quarantine(spark, sf_dir):
    return landing.quarantine(box_landing(tables(spark, sf_dir)))


from .streaming import streams  # noqa: E402


@query("upsert_games")
def q_upsert_games(spark, sf_dir):
    """Target: the games dated before 2000 and those later ones that no response lists; batch: all
    landed responses. Together they hold every game."""
    t = tables(spark, sf_dir)
    return streams.upsert_landed(_held_games(t), game_landing(t))


def _held_games(t) -> DataFrame:
    listed = t.date_status.filter((F.col("status") != "no_games") & ~(
        (F.col("status") == "pending") & (F.dayofmonth("date") % 2 == 0))).select(F.col("date").cast("string").alias("game_date"))
    old, late = F.col("game_date") < UPSERT_TARGET_BEFORE, F.coalesce(F.col("game_date") >= UPSERT_TARGET_BEFORE, F.lit(True))
    return t.games.filter(old).unionByName(t.games.filter(late).join(listed, "game_date", "left_anti").select(*t.games.columns))


@query("upsert_all_sets")
def q_upsert_all_sets(spark, sf_dir):
    """Every landed result set into its own table; the summaries have neither a declared schema nor a target. The
    rows of all tables that result, under the names of all their columns (``min`` as text)."""
    t = tables(spark, sf_dir)
    held = {"games": _held_games(t), **{n: _before(getattr(t, n), "updated_at", BOX_T0) for n in ("player_box", "team_box", "bench_box")}}
    out = None
    for name, df in sorted(ingest.upsert_all(spark, held, _landings(t)).items()):
        df = df.withColumns({"table_name": F.lit(name)} | ({"min": F.col("min").cast("string")} if "min" in df.columns else {}))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


@query("append_api_calls")
def q_append_api_calls(spark, sf_dir):
    """K4: the stored log, with a row appended for every landed game-list response."""
    t = tables(spark, sf_dir)
    path = scratch_path(spark, "api-calls")
    stored = merge.materialize_at(spark, t.api_calls, path)
    top = stored.select(F.coalesce(F.max("id"), F.lit(0))).scalar()
    return merge.append_rows(spark, landing.log_rows(game_landing(t), top), path, stored)


# -- streaming (I1, I6): run the stream to the end, return the current table ---------------------

@query("apilogs_stream")
def q_apilogs_stream(spark, sf_dir):
    target, ckpt = scratch_path(spark, "apilogs-stream"), scratch_path(spark, "apilogs-stream-ckpt")
    streams.run_to_end(streams.api_log_stream(spark, sf_dir, target, ckpt, file_glob="events.parquet"))
    return streams.current_api_log(spark, target)


@query("apilogs_dedup_stream")
def q_apilogs_dedup_stream(spark, sf_dir):
    """I1 with bounded state: repeats are dropped in the stream, rows are stored once and read as they are."""
    target, ckpt = scratch_path(spark, "apilogs-dedup"), scratch_path(spark, "apilogs-dedup-ckpt")
    streams.run_to_end(streams.api_log_dedup_stream(spark, sf_dir, target, ckpt, file_glob="events.parquet"))
    return streams.appended_api_log(spark, target)


@query("games_upsert_stream")
def q_games_upsert_stream(spark, sf_dir):
    t = tables(spark, sf_dir)
    land = scratch_path(spark, "game-landing")
    game_landing(t).write.mode("overwrite").parquet(land)
    target, ckpt = scratch_path(spark, "games-stream"), scratch_path(spark, "games-stream-ckpt")
    streams.run_to_end(streams.games_upsert_stream(spark, land, target, ckpt))
    return streams.current_games(spark, target)


@query("catch_up_stream")
def q_catch_up_stream(spark, sf_dir):
    """M12 + I6: landed responses to stored games, then to the status of their dates, in one stream."""
    t = tables(spark, sf_dir)
    land, root, ckpt = (scratch_path(spark, n) for n in ("catch-up-landing", "catch-up", "catch-up-ckpt"))
    game_landing(t).write.mode("overwrite").parquet(land)
    streams.run_to_end(streams.catch_up_stream(spark, land, root, ckpt, t.date_status, QUEUE_AS_OF))
    return streams.current_status(spark, root, t.date_status)


@query("gbs_stream")
def q_gbs_stream(spark, sf_dir):
    """Games land the day after they are played, their boxes up to a week later; then both inputs' clocks move on."""
    t = tables(spark, sf_dir)
    games, boxes, target, ckpt = (scratch_path(spark, f"gbs-stream-{n}") for n in ("games", "boxes", "seen", "ckpt"))
    next_day = F.col("game_date").cast("timestamp") + F.expr("INTERVAL 1 DAY")
    played = t.games.select("game_id", "game_date").distinct()
    landed_games = t.games.withColumn("landed_at", next_day)
    landed_boxes = t.team_box.join(played, "game_id", "left").withColumn(
        "landed_at", F.coalesce(next_day, F.col("updated_at").cast("timestamp")) + F.make_dt_interval((F.col("id") % 8).cast("int")))
    clock = spark.range(1).select(F.lit(CLOCK).cast("timestamp").alias("landed_at"), F.lit(True).alias("clock"))
    for df, schema, path in ((landed_games, streams.GAMES_LANDED, games), (landed_boxes, streams.BOXES_LANDED, boxes)):
        df.withColumn("clock", F.lit(False)).select(*schema.names).unionByName(clock, allowMissingColumns=True) \
            .write.mode("overwrite").parquet(path)
    streams.run_to_end(streams.box_status_stream(spark, games, boxes, target, ckpt, BOX_BOUND))
    return streams.current_box_status(spark, target, t.date_status)
