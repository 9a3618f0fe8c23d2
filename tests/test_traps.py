"""Literal fixtures for the semantic traps and the small operators."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from courtside.functions import expressions as X
from courtside.operators import checks, drift, merge
from courtside.operators.ranking import fixed_batches, global_row_number
from courtside.plans import backlog, seasons, staging
from courtside.plans import leaderboard as LB
from courtside.sources import landing
from tests.conftest import make, rows

P = LB.Params(start_date="2024-10-01", recency_days=10, k=20, as_of="2024-12-01 00:00:00")
D1, D2 = "2024-11-01", "2024-11-02"


def ts(s):
    return dt.datetime.fromisoformat(s)


def game(gid, season="22024", date=D1, team=1, stamp="2024-11-03 00:00:00", id_=None):
    return {"id": id_ or abs(hash((gid, season, team))) % 10**9, "season_id": season, "team_id": team,
            "game_id": gid, "game_date": date, "updated_at": ts(stamp) if stamp else None}


def line(id_, gid, pid, pts, minutes, team=1, stamp="2024-11-03 00:00:00", **stats):
    r = {"id": id_, "game_id": gid, "player_id": pid, "player_name": f"p{pid}", "team_id": team, "pts": pts,
         "min": minutes, "updated_at": ts(stamp) if stamp else None}
    r.update(stats)
    return r


def status(*dates, state="processed"):
    return [{"date": dt.date.fromisoformat(d), "status": state, "last_checked": ts(d + " 06:00:00"),
             "retry_count": 0} for d in dates]


def leaderboard(spark, games, lines, dates, form="running"):
    inp = LB.Inputs(player_box=make(spark, "player_box", lines), games=make(spark, "games", games),
                    date_status=make(spark, "date_status", dates))
    return LB.top20_by_metric(inp, P, form)


def metric(df, name):
    return [r for r in rows(df, ["cutoff_date", "rank"]) if r["metric_name"] == name]


def test_t1_null_metric_ranks_first(spark):
    g = [game("g1")]
    ls = [line(1, "g1", 1, 10, "DNP"), line(2, "g1", 2, 5, "30:00")]
    for form in ("running", "windowed", "direct"):
        top = metric(leaderboard(spark, g, ls, status(D1), form), "avg_minutes")
        assert [(r["rank"], r["player_id"], r["metric_value"]) for r in top] == [(1, 1, None), (2, 2, 30.0)]


def test_t4_equal_ratios_tie_then_games_then_id(spark):
    g = [game(f"g{i}") for i in range(6)]
    a = [line(10 + i, f"g{i}", 1, p, "10:00") for i, p in enumerate([3, 3, 4])]
    b = [line(20 + i, f"g{i}", 2, p, "10:00") for i, p in enumerate([3, 3, 3, 3, 4, 4])]
    top = metric(leaderboard(spark, g, a + b, status(D1)), "avg_pts")
    assert [r["player_id"] for r in top] == [2, 1]
    assert top[0]["metric_value"] == top[1]["metric_value"] == 10 / 3


def test_t5_minutes_formats(spark):
    cases = [("34:30", 34.5), ("34-30", 34.5), ("34.5", 34.5), ("34", 34.0), ("12:75", 13.25),
             ("0:00", 0.0), ("00:00", 0.0), ("DNP", None), ("", None), (None, None), ("34:30\n", None)]
    df = spark.createDataFrame([(c,) for c, _ in cases], "m string")
    got = [r[0] for r in df.select(X.minutes_decimal("m")).collect()]
    assert got == [e for _, e in cases]
    played = [r[0] for r in df.select(X.played(F.lit(1), "m")).collect()]
    assert played[5] is False and played[6] is True  # only the exact text '0:00' is "did not play"


def test_t6_null_in_stored_dates_does_not_block_new_dates(spark):
    stg = staging.stg_date_processing_status(make(spark, "date_status", status(D1, D2)))
    existing = spark.createDataFrame([(None,), (dt.date.fromisoformat(D1),)], "cutoff_date date")
    got = [r[0] for r in LB.processed_cutoffs(stg, "2024-10-01", existing).collect()]
    assert got == [dt.date.fromisoformat(D2)]


def test_t8_two_stamps_two_rows_unless_latest_only(spark):
    games = make(spark, "games", [game("g1", team=1, stamp="2024-11-03 00:00:00", id_=1),
                                  game("g1", team=2, stamp="2024-11-04 00:00:00", id_=2)])
    box = make(spark, "team_box", [{"id": 1, "game_id": "g1", "team_id": 1, "updated_at": ts("2024-11-03 01:00:00")}])
    st = make(spark, "date_status", status(D1))
    assert staging.stg_game_boxscore_status(games, box, st).count() == 2
    assert staging.stg_game_boxscore_status(games, box, st, latest_only=True).count() == 1


def test_t9_player_box_only_game(spark):
    games = make(spark, "games", [game("g1")])
    pb = make(spark, "player_box", [line(1, "g1", 1, 10, "10:00")])
    empty_team = make(spark, "team_box", [])
    empty_bench = make(spark, "bench_box", [])
    assert staging.stg_boxscores(pb, empty_bench, empty_team).count() == 1
    assert seasons.available_seasons(games, pb).first()["loaded_boxscores"] == 1
    assert staging.stg_game_boxscore_status(games, empty_team, make(spark, "date_status", [])).first()["has_boxscore"] is False
    assert staging.stg_daily_game_summary(games, empty_team).first()["boxscores_count"] == 0


def test_t10_starters_and_bench_both_survive_upsert(spark):
    target = make(spark, "bench_box", [])
    batch = make(spark, "bench_box", [
        {"id": 0, "game_id": "g1", "team_id": 1, "starters_bench": "Starters", "pts": 80},
        {"id": 0, "game_id": "g1", "team_id": 1, "starters_bench": "Bench", "pts": 20}]).drop("id")
    out = merge.upsert(target, batch, ["team_id", "game_id", "starters_bench"])
    assert sorted((r["starters_bench"], r["id"]) for r in out.collect()) == [("Bench", 1), ("Starters", 2)]


def test_t11_game_in_two_seasons(spark):
    g = [game("g1", season="22024", id_=1), game("g1", season="62024", id_=2, stamp="2024-11-09 00:00:00")]
    games = make(spark, "games", g)
    pb = make(spark, "player_box", [line(1, "g1", 1, 10, "10:00")])
    assert seasons.available_seasons(games, pb).count() == 2
    top = leaderboard(spark, g, [line(1, "g1", 1, 10, "10:00")], status(D1))
    assert {r["season_id"] for r in top.collect()} == {"22024"}  # official phase wins


def test_t13_null_team_on_latest_game_is_kept(spark):
    g = [game("g1", date=D1), game("g2", date=D2)]
    ls = [line(1, "g1", 1, 10, "10:00", team=5), line(2, "g2", 1, 10, "10:00", team=None)]
    top = leaderboard(spark, g, ls, status(D1, D2))
    by_cut = {r["cutoff_date"].isoformat(): r["team_id"] for r in metric(top, "avg_pts")}
    assert by_cut == {D1: 5, D2: None}


def test_c4_season_start_year(spark):
    df = spark.createDataFrame([("2",), ("",), ("22024",)], "s string")
    assert [r[0] for r in df.select(X.season_start_year("s")).collect()] == [None, None, 2024]
    with pytest.raises(Exception):
        spark.createDataFrame([("2x",)], "s string").select(X.season_start_year("s")).collect()


def test_k5_insert_existing_date_is_ignored(spark):
    st = make(spark, "date_status", status(D1))
    out = backlog.populate_pending_dates(spark, st, "2024-11-03 08:25:00", last_n_days=3)
    got = {r["date"].isoformat(): r["status"] for r in out.collect()}
    assert got == {"2024-10-31": "pending", D1: "processed", D2: "pending"}


def test_k6_update_of_missing_date_inserts_nothing(spark):
    st = make(spark, "date_status", status(D1, state="pending"))
    outcomes = spark.createDataFrame([(dt.date.fromisoformat(D1), "processed"), (dt.date.fromisoformat(D2), "no_games")],
                                     "date date, outcome string")
    out = backlog.update_status(st, outcomes, "2024-11-05 09:25:00").collect()
    assert [(r["date"].isoformat(), r["status"]) for r in out] == [(D1, "processed")]


def test_f14_payload_outcomes(spark):
    resp = spark.createDataFrame([
        ("LeagueGameFinder", "2024-11-01", None, None),
        ("LeagueGameFinder", "2024-11-02", '{"LeagueGameFinderResults": []}', None),
        ("LeagueGameFinder", "2024-11-03", '{"LeagueGameFinderResults": [{"GAME_ID": "1"}]}', None),
    ], "endpoint string, request_key string, payload string, fetched_at timestamp_ntz")
    got = {r["date"].isoformat(): r["outcome"] for r in landing.date_outcomes(resp).collect()}
    assert got == {"2024-11-01": "error", "2024-11-02": "no_games", "2024-11-03": "processed"}


def test_split_and_type_records(spark):
    resp = spark.createDataFrame([
        ("LeagueGameFinder", "2024-11-01",
         '{"LeagueGameFinderResults": [{"SEASON_ID": "22024", "TEAM_ID": 7, "GAME_ID": "g1", "GAME_DATE": "2024-11-01"}]}',
         ts("2024-11-02 00:00:00"))], "endpoint string, request_key string, payload string, fetched_at timestamp_ntz")
    split = landing.split_result_sets(resp)
    r = split.first()
    assert r["table_name"] == "leaguegamefinder__leaguegamefinderresults"
    assert r["key_columns"] == ["season_id", "team_id", "game_id"]
    g = landing.records_as_table(split, "LeagueGameFinderResults", "games").first()
    assert (g["team_id"], g["updated_at"]) == (7, ts("2024-11-02 00:00:00"))


def test_drift_policies(spark):
    a = spark.createDataFrame([(1, "x")], "id bigint, v string")
    b = spark.createDataFrame([(2, 3.0)], "id bigint, w double")
    with pytest.raises(drift.SchemaDriftError):
        drift.apply_policy(a, b, "fail")
    t, n = drift.apply_policy(a, b, "sync_all_columns")
    assert t.columns == ["id", "w"] and t.first()["w"] is None


def test_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, "z"), (None, "a")], "k int, v string")
    got = {(r["rule"], r["column_name"]): r["failures"] for r in checks.run_checks(df, [
        *checks.not_null("k", "v"), checks.unique("k"), checks.unique_combination("k", "v"),
        checks.accepted_values("v", ["a"])]).collect()}
    assert got == {("not_null", "k"): 1, ("not_null", "v"): 0, ("unique", "k"): 1,
                   ("unique_combination", "k,v"): 0, ("accepted_values", "v"): 1}


def test_global_row_number_and_batches(spark):
    df = spark.range(0, 95, numPartitions=5).select(F.format_string("%03d", (F.col("id") * 7) % 95).alias("g"))
    got = sorted((r["g"], r["row_number"]) for r in global_row_number(df.repartition(3), ["g"]).collect())
    assert [n for _, n in got] == list(range(1, 96))
    b = fixed_batches(df, ["g"], 10).groupBy("batch_id").count().orderBy("batch_id").collect()
    assert [r["count"] for r in b] == [10] * 9 + [5]


def test_m9_starter_models(spark):
    from courtside.plans import examples
    first = examples.rows_not_null(examples.inline_rows(spark))
    assert [r["id"] for r in first.collect()] == [1]
    assert [r["id"] for r in examples.id_one(first).collect()] == [1]


def test_s9_missing_table_gives_empty_set(spark, tmp_path):
    from courtside.sources.tables import distinct_game_ids
    assert distinct_game_ids(spark, str(tmp_path / "absent")).count() == 0
    assert distinct_game_ids(spark, "no_such_table").count() == 0
    g = make(spark, "games", [game("g1"), game("g1", team=2), game("g2")])
    assert sorted(r[0] for r in distinct_game_ids(spark, g).collect()) == ["g1", "g2"]


def test_t7_box_after_game_faithful_drifts_affected_keys_does_not(spark):
    from courtside.plans import incremental
    t0 = "2024-11-10 00:00:00"
    g_all = [game("g1", stamp="2024-11-02 00:00:00", id_=1), game("g2", date=D2, stamp="2024-11-05 00:00:00", id_=2)]
    box_late = {"id": 1, "game_id": "g1", "team_id": 1, "updated_at": ts("2024-11-12 00:00:00")}
    games = make(spark, "games", g_all)
    st = make(spark, "date_status", [{"date": dt.date.fromisoformat(d), "status": "processed",
                                      "last_checked": ts("2024-10-01 00:00:00"), "retry_count": 0} for d in (D1, D2)])
    box_before, box_now = make(spark, "team_box", []), make(spark, "team_box", [box_late])
    first = merge.materialize(spark, incremental.gbs_batch(games, box_before, st, None), "first")
    batch = incremental.gbs_batch(games, box_now, st, first)
    faithful = {r["game_id"]: r["has_boxscore"] for r in
                merge.keyed_replace(first, batch, ["game_date", "game_id"]).collect()}
    fresh, gone = incremental.gbs_affected_keys(games, box_now, st, first, t0)
    affected = {r["game_id"]: r["has_boxscore"] for r in
                merge.keyed_replace(first, fresh, ["game_date", "game_id"], gone).collect()}
    full = {r["game_id"]: r["has_boxscore"] for r in staging.stg_game_boxscore_status(games, box_now, st).collect()}
    assert full == {"g1": True, "g2": False}
    assert faithful["g1"] is False  # g1's stamp is below the mark, so its late box never joins
    assert affected == full


@pytest.mark.parametrize("stamp", ["2024-11-20 00:00:00", None])
def test_affected_keys_follow_moved_and_unstamped_games(spark, tmp_path, stamp):
    """g1 moves from 1 to 5 November; g3 is new. Their rows are stamped after the mark, or not at all."""
    from courtside.plans import incremental
    t0 = "2024-11-10 00:00:00"
    old = make(spark, "games", [game("g1", date="2024-11-01", id_=1), game("g2", date="2024-11-02", id_=2)])
    new = make(spark, "games", [game("g1", date="2024-11-05", stamp=stamp, id_=1), game("g2", date="2024-11-02", id_=2),
                                game("g3", date="2024-11-11", stamp=stamp, id_=3)])
    box = make(spark, "team_box", [{"id": 1, "game_id": "g1", "team_id": 1, "updated_at": ts("2024-11-03 00:00:00")}])
    st = make(spark, "date_status", [])
    daily = staging.stg_daily_game_summary(old, box)
    status_ = staging.stg_game_boxscore_status(old, box, st)
    for name, first, keys, refreshed, full in (
            ("daily", daily, ["game_date"], lambda: incremental.daily_affected_keys(new, box, status_, t0),
             staging.stg_daily_game_summary(new, box)),
            ("gbs", status_, ["game_date", "game_id"], lambda: incremental.gbs_affected_keys(new, box, st, status_, t0),
             staging.stg_game_boxscore_status(new, box, st))):
        path = f"file://{tmp_path}/{name}"
        target = merge.materialize_at(spark, first.withColumn("month", merge.month_of("game_date")), path, ["month"]).drop("month")
        fresh, gone = refreshed()
        stored = merge.replace_in_partitions(spark, path, target.schema, fresh, keys, "month", gone, part=merge.month_of("game_date"))
        with pytest.raises(ValueError, match="key of the table"):
            merge.replace_in_partitions(spark, path, target.schema, fresh, keys, "game_date", gone)
        assert rows(stored) == rows(full) and {str(r["game_date"]) for r in rows(full)} == {"2024-11-02", "2024-11-05", "2024-11-11"}


def test_only_touched_partitions_are_written(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    first = spark.createDataFrame([(k, f"2024-11-0{k % 3 + 1}", "old") for k in range(9)], "id int, day string, v string")
    target = merge.materialize_at(spark, first, path, ["day"])
    before = {p: p.stat().st_mtime_ns for p in tmp_path.glob("t/day=*/*.parquet")}
    batch = spark.createDataFrame([(3, "2024-11-02", "new"), (20, "2024-11-09", "new")], "id int, day string, v string")
    out = merge.replace_in_partitions(spark, path, target.schema, batch, ["id"], "day")
    assert sorted((r["id"], r["day"], r["v"]) for r in out.collect() if r["v"] == "new") == [
        (3, "2024-11-02", "new"), (20, "2024-11-09", "new")]
    assert out.count() == 10 and out.select("id").distinct().count() == 10
    after = {p: p.stat().st_mtime_ns for p in tmp_path.glob("t/day=*/*.parquet")}
    assert {p for p in before if p in after} == {p for p in before if "2024-11-03" in str(p)}
    wider = batch.withColumn("extra", F.lit(1))
    with pytest.raises(drift.SchemaDriftError):
        merge.replace_in_partitions(spark, path, target.schema, wider, ["id"], "day")
    with pytest.raises(drift.SchemaDriftError):
        merge.keyed_replace(first, wider, ["id"])
    assert merge.keyed_replace(first, wider, ["id"], policy="sync_all_columns").columns == wider.columns


def responses(spark, *found):
    return spark.createDataFrame([("LeagueGameFinder", day, payload, ts(at)) for day, payload, at in found],
                                 "endpoint string, request_key string, payload string, fetched_at timestamp_ntz")


def record(wl, gid="g1", date=D1):
    return ('{"SEASON_ID": "22024", "TEAM_ID": 7, "GAME_ID": "%s", "GAME_DATE": "%s", "WL": %s}'
            % (gid, date, "null" if wl is None else f'"{wl}"'))


def test_upsert_last_record_in_the_list_wins(spark):
    from courtside.streaming import streams
    both = '{"LeagueGameFinderResults": [%s, %s]}' % (record("W"), record("L"))
    target = make(spark, "games", [{**game("g1", team=7, id_=5), "wl": "W"}, game("g9", team=9, id_=8)])
    out = {r["game_id"]: (r["id"], r["wl"]) for r in
           streams.upsert_landed(target, responses(spark, (D1, both, "2024-11-02 00:00:00"))).collect()}
    assert out == {"g1": (5, "L"), "g9": (8, None)}


def test_upsert_reads_the_target_once(spark, tmp_path):
    path = f"file://{tmp_path}/games"
    make(spark, "games", [game("g1", team=7, id_=5)]).write.parquet(path)
    target = spark.read.parquet(path)
    batch = make(spark, "games", [game("g1", team=7, id_=0), game("g2", team=7, id_=0)]).drop("id")
    merged = merge.upsert(target, batch, ["season_id", "team_id", "game_id"], id_col=None)
    assert merged._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 1
    out = merge.upsert(target, batch, ["season_id", "team_id", "game_id"])
    assert {r["game_id"]: r["id"] for r in out.collect()} == {"g1": 5, "g2": 6}


def test_null_result_sets_are_quarantined(spark):
    box = spark.createDataFrame([("BoxScoreTraditionalV2", k, p, None) for k, p in (
        ("1", '{"PlayerStats": null}'), ("2", "{}"), ("3", '{"PlayerStats": [], "TeamStats": null}'), ("4", None),
        ("5", '{"PlayerStats": null, "TeamStats": [{"GAME_ID": "5"}]}'))],
        "endpoint string, request_key string, payload string, fetched_at timestamp_ntz")
    assert {r["request_key"]: r["reason"] for r in landing.quarantine(box).collect()} == {
        "1": "empty payload", "2": "empty payload", "3": "empty payload", "4": "unreadable or missing payload"}
    days = responses(spark, (D1, '{"LeagueGameFinderResults": null}', "2024-11-02 00:00:00"))
    assert landing.date_outcomes(days).first()["outcome"] == "no_games"


def test_w2_unknown_season_is_like_an_unofficial_one(spark):
    from courtside.operators.dedupe import canonical_games
    g = make(spark, "games", [game("g1", season="12024", stamp="2024-11-03 00:00:00", id_=1),
                              game("g1", season=None, stamp="2024-11-09 00:00:00", id_=2)])
    assert canonical_games(g).first()["season_id"] is None
    tie = make(spark, "games", [game("g1", date=D1, id_=1), game("g1", date=D2, team=2, id_=2)])
    assert canonical_games(tie).first()["game_date"] == D2


def test_log_rows(spark):
    found = landing.log_rows(responses(spark, (D1, None, "2024-11-03 00:00:00"), (D2, "{}", "2024-11-02 00:00:00")), F.lit(40))
    assert [(r["id"], r["success"], r["error_message"]) for r in rows(found, ["id"])] == [
        (41, True, None), (42, False, f"no payload for {D1}")]


def test_date_range_reaches_the_scan_of_a_raw_table(spark, tmp_path):
    from courtside.sources.tables import read_raw
    make(spark, "games", [game("g1", date=D1), game("g2", date="2024-12-24", id_=2)]).write.parquet(f"file://{tmp_path}/g")
    out = backlog.games_in_date_range(read_raw(spark, f"file://{tmp_path}/g", "games"), D1, D2, league_prefix="g")
    assert [r["game_id"] for r in out.collect()] == ["g1"]
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = out.select("game_id")._jdf.queryExecution().executedPlan().toString()
    assert f"GreaterThanOrEqual(game_date,{D1})" in plan and f"LessThanOrEqual(game_date,{D2})" in plan


def test_views(spark):
    from courtside.sources.tables import register_views
    register_views({"stg_gamefinder_v": staging.stg_gamefinder(make(spark, "games", [game("g1")]))})
    assert spark.sql("SELECT count(*) FROM stg_gamefinder_v").first()[0] == 1


def test_box_status_key_check_shows_trap_t8(spark):
    games = make(spark, "games", [game("g1", id_=1), game("g1", team=2, stamp="2024-11-04 00:00:00", id_=2), game("g2", id_=3)])
    box, st = make(spark, "team_box", []), make(spark, "date_status", [])
    found = checks.run_checks(staging.stg_game_boxscore_status(games, box, st), checks.BOX_STATUS_RULES)
    assert {r["rule"]: r["failures"] for r in found.collect()} == {"not_null": 0, "unique_combination": 1}


@pytest.mark.parametrize("write", ["insert_ignore", "append_rows", "append_partitions"])
def test_new_column_raises_in_every_keyed_write(spark, tmp_path, write):
    stored = spark.createDataFrame([(1, "a")], "id long, v string")
    new = spark.createDataFrame([(2, "b", 3)], "id long, v string, extra int")
    with pytest.raises(drift.SchemaDriftError):
        if write == "insert_ignore":
            merge.insert_ignore(stored, new, ["id"])
        elif write == "append_rows":
            merge.append_rows(spark, new, str(tmp_path / "t"), stored)
        else:
            merge.append_partitions(spark, new, str(tmp_path / "t"), ["v"], stored)
    assert not (tmp_path / "t").exists()
