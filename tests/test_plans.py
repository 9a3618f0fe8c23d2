"""Plan-shape guards for the scale properties the design relies on."""

import datetime as dt
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from courtside.operators import dedupe
from courtside.operators.joins import Dimension, join_dimension
from courtside.operators.ranking import top_k_per_group
from courtside.plans import leaderboard as LB
from courtside.plans import incremental
from courtside.registry import PARAMS, QUERIES, _apilogs_by_day, colocated, inputs, tables
from courtside.sources import landing
from courtside.sources.driver_fixtures import box_landing
from tests.conftest import make


def _plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def test_dimension_over_bound_is_not_hinted(spark):
    fact = spark.range(100).withColumn("k", F.col("id") % 10)
    dim = spark.range(10).withColumnRenamed("id", "k")
    small, big = Dimension(dim, max_rows=1000), Dimension(dim, max_rows=5)
    assert small.small and small.rows == 10
    assert not big.small
    assert join_dimension(fact, small, "k").count() == 100
    # Beyond the bound no broadcast hint is given; the planner (and AQE's own runtime size
    # check) decides, and the result is the same.
    hinted = join_dimension(fact, big, "k")._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" not in hinted.lower()
    assert join_dimension(fact, big, "k").count() == 100


def test_dedupe_collapses_keys_before_the_shuffle(spark, sf_dir):
    plan = _plan(dedupe.canonical_player_box(tables(spark, sf_dir).player_box))
    assert "WindowGroupLimit" in plan and "Partial" in plan


@pytest.mark.parametrize("form", ["running", "windowed", "direct"])
def test_leaderboard_rank_has_partial_top_k_and_no_cross_join(spark, sf_dir, form):
    plan = _plan(LB.top20_by_metric(inputs(tables(spark, sf_dir)), PARAMS, form))
    assert plan.count("WindowGroupLimit") >= 2
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_leaderboard_runs_no_job_before_the_action(spark, sf_dir):
    tracker, group = spark.sparkContext.statusTracker(), "plan-only"
    inp = inputs(tables(spark, sf_dir))
    spark.sparkContext.setJobGroup(group, group)
    try:
        LB.top20_by_metric(inp, PARAMS)
        assert list(tracker.getJobIdsForGroup(group)) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_clock_is_utc_whatever_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        got = spark.range(1).select(LB.Params().stamp().alias("t")).first()["t"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert abs((got - dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)).total_seconds()) < 120


@pytest.mark.parametrize("name, joins", [("player_games_colocated", 1), ("gbs_colocated", 1)])
def test_tables_in_buckets_meet_without_an_exchange_by_game(spark, sf_dir, name, joins):
    """With joins left to sorting, as on tables that are too large to broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(QUERIES[name](spark, sf_dir))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("SortMergeJoin") >= joins and "Bucketed: true" in plan
    assert "hashpartitioning(game_id" not in plan


def test_buckets_keep_every_row(spark, sf_dir):
    t = tables(spark, sf_dir)
    games = t.games.withColumn("game_id", F.when(F.col("id") % 9 > 0, F.col("game_id")))  # some without an id
    stored = colocated(spark, type("T", (), {"games": games, "none": games.limit(0)}), "games", "none")
    assert stored["none"].count() == 0 and stored["games"].count() == games.count()
    assert stored["games"].exceptAll(games).isEmpty() and len(stored["games"].inputFiles()) <= 16


def test_the_mark_prunes_the_folders_of_the_input(spark, sf_dir):
    _, target, batch = _apilogs_by_day(spark, tables(spark, sf_dir))
    calls = tables(spark, sf_dir).api_calls
    plain = incremental.apilogs_batch(calls, target)
    assert sorted(map(str, batch.collect())) == sorted(map(str, plain.collect()))
    # Files of the days before the mark are unreadable from now on: they are not opened.
    mark = str(target.agg(F.max("updated_at")).first()[0].date())
    files = {f: re.search("call_date=([^/]*)", f)[1] for f in batch.inputFiles()}
    early = [f for f, day in files.items() if day < mark]
    assert 0 < len(early) < len(files)
    for f in early:
        Path(f.removeprefix("file:")).write_bytes(b"not a table")
    assert sorted(map(str, batch.select("*").collect())) == sorted(map(str, plain.collect()))
    with pytest.raises(Exception, match="(?i)parquet|checksum|file"):
        spark.read.schema(calls.schema).parquet(early[0]).collect()


def test_a_filter_on_the_outcome_parses_each_payload_once(spark, sf_dir):
    """The filter is moved below the parsing; what it then computes may name the payload once."""
    plan = landing.quarantine(box_landing(tables(spark, sf_dir)))._jdf.queryExecution().optimizedPlan().toString()
    filters = [line for line in plan.splitlines() if re.search(r"^[\s:+-]*Filter ", line) and "from_json" in line]
    assert filters and all(line.count("from_json(") == 1 for line in filters)


def test_player_lines_are_dealt_as_they_are_read(spark, sf_dir):
    """Not as the wider rows made of them, whatever columns a query wants: all its uses can share one exchange."""
    for df in (tables(spark, sf_dir).player_box, tables(spark, sf_dir).player_box.select("id", "pts")):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        below = plan.splitlines()[next(i for i, line in enumerate(plan.splitlines()) if "Window [" in line):]
        assert not any(re.search(r"Project .* AS (pts|min|fga)#", line) for line in below)


@pytest.mark.parametrize("one_in", [1, 2, 64])
def test_bound_of_a_part_keeps_every_leader(spark, one_in):
    """Ties, nulls and groups smaller than k, against the plain rank; fewer rows reach it."""
    rows = spark.range(4000).select(
        F.to_date(F.lit("2024-01-01")).alias("cutoff_date"), F.concat(F.lit("s"), F.col("id") % 3).alias("season_id"),
        F.when(F.col("id") < 3970, F.lit("m")).otherwise("n").alias("metric_name"), F.col("id").alias("player_id"),
        F.when((F.col("id") % 400 > 0) | (F.col("id") % 3 == 0), (F.col("id") % 5).cast("double")).alias("metric_value"),
        (F.col("id") % 7).alias("games_played"))
    got = LB.rank_metrics(rows, 20, one_in)
    order = [F.col("metric_value").desc_nulls_first(), F.col("games_played").desc(), F.col("player_id").asc()]
    want = top_k_per_group(rows, ["cutoff_date", "season_id", "metric_name"], order, 20)
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


@pytest.mark.parametrize("form", ["windowed", "direct"])
def test_pairs_meet_summed_games_without_an_exchange(spark, sf_dir, form):
    """Games are added up before they meet the pairs, and the totals of the pairs are hashed where the games were dealt."""
    plan = _plan(LB.player_aggregates(inputs(tables(spark, sf_dir)), PARAMS, form)).split("== Initial Plan ==")[0]
    totals = [line for line in plan.splitlines() if re.search(r"Aggregate\(keys?=\[cutoff_date#\d+, season_id", line)]
    assert totals and all("HashAggregate" in line for line in totals)
    assert not re.search(r"hashpartitioning\(cutoff_date#\d+, season_id", plan)


def _game_responses(spark):
    made = [("LeagueGameFinder", "2001-01-01", '{"LeagueGameFinderResults":[{"GAME_ID":"g1","TEAM_ID":7,"SEASON_ID":null}]}', dt.datetime(2001, 1, 2)),
            ("LeagueGameFinder", "2001-01-02", None, dt.datetime(2001, 1, 3))]
    return spark.createDataFrame(made, "endpoint string, request_key string, payload string, fetched_at timestamp_ntz")


def test_a_payload_is_parsed_once_and_a_records_fields_are_one_element(spark):
    split = landing.split_result_sets(_game_responses(spark))
    plan = split._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1
    assert [r["key_columns"] for r in split.collect()] == [["season_id", "team_id", "game_id"]]
    typed = landing.records_as_table(split, landing.GAME_RESULT_SET, "games", arrival=True)
    assert typed._jdf.queryExecution().optimizedPlan().toString().count("lambdafunction") == 1
    assert [(r["game_id"], r["team_id"], r["season_id"], r["updated_at"]) for r in typed.collect()] == [("g1", 7, None, dt.datetime(2001, 1, 2))]


def _league(spark, players=60):
    """Two seasons in play, one long over; each player has two games of each; rows without a game id."""
    seasons = {"22024": ("2024-11-01", "2024-11-03"), "42024": ("2024-11-02", "2024-11-04"), "22019": ("2019-11-01", "2019-11-02")}
    games = [{"id": 10 * i + k, "season_id": s, "team_id": 1, "game_id": f"{s}-{k}", "game_date": d}
             for i, (s, days) in enumerate(seasons.items()) for k, d in enumerate(days)]
    lines = [{"id": 1000 * p + g["id"], "game_id": g["game_id"], "player_id": p, "player_name": f"p{p}", "team_id": g["id"] % 3,
              "pts": p % 7 + g["id"], "min": "10:00"} for p in range(players) for g in games]
    nowhere = [{"id": 900, "season_id": "22024", "team_id": 1, "game_id": None, "game_date": "2024-11-05", "updated_at": dt.datetime(2024, 11, 6)},
               {"id": 901, "season_id": "22024", "team_id": 1, "game_id": None, "game_date": "2024-11-20"}]
    lines.append({"id": 1, "game_id": None, "player_id": 1, "player_name": "p1", "team_id": 1, "pts": 99, "min": "10:00"})
    days = [{"date": dt.date(2024, 11, d), "status": "processed"} for d in range(1, 6)]
    return LB.Inputs(make(spark, "player_box", lines), make(spark, "games", games + nowhere), make(spark, "date_status", days))


LEAGUE = LB.Params(start_date="2024-10-01", as_of="2024-12-01 00:00:00")


def _long(spark):
    return LB.leaderboard_long(LB.player_aggregates(_league(spark), LEAGUE))


def test_long_form_of_a_league(spark):
    """Every cutoff from a player's first game on; the row without a game id gives the season its latest date, and no points."""
    got = {(r["cutoff_date"].day, r["season_id"]): (r["metric_value"], r["games_played"], r["latest_season_game_date"].day, r["team_id"])
           for r in _long(spark).filter("player_id = 8 AND metric_name = 'avg_pts'").collect()}
    assert got == {(1, "22024"): (1.0, 1, 5, 0), (2, "22024"): (1.0, 1, 5, 0), (3, "22024"): (1.5, 2, 5, 1), (4, "22024"): (1.5, 2, 5, 1),
                   (5, "22024"): (1.5, 2, 5, 1), (2, "42024"): (11.0, 1, 4, 1), (3, "42024"): (11.0, 1, 4, 1),
                   (4, "42024"): (11.5, 2, 4, 2), (5, "42024"): (11.5, 2, 4, 2)}
    assert _long(spark).count() == 60 * 9 * 20


@pytest.mark.parametrize("form", ["running", "windowed"])
def test_rows_of_the_long_form_stay_in_all_partitions(spark, form):
    """A player's rows become many behind their exchange: it is not put together by the few bytes that it holds."""
    long = LB.leaderboard_long(LB.player_aggregates(_league(spark), LEAGUE, form))
    assert long.select(F.spark_partition_id()).distinct().count() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_metrics_are_formed_before_the_cutoffs(spark):
    plan = _long(spark)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    cutoffs = next(i for i, line in enumerate(plan) if "Generate explode(cutoff_date" in line)
    assert not any("AS avg_pts#" in line for line in plan[:cutoffs]) and any("AS avg_pts#" in line for line in plan[cutoffs:])


def test_long_form_deals_lines_once_and_games_once_and_never_by_season(spark, sf_dir):
    """With joins left to sorting, as on large tables: lines are dealt by game, then by player; games by their id."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = _plan(LB.leaderboard_long(LB.player_aggregates(inputs(tables(spark, sf_dir)), PARAMS)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin [season_id" not in plan
    assert "hashpartitioning(l_orderkey" not in plan and not re.search(r"hashpartitioning\(game_id#\d+, player_id", plan)
