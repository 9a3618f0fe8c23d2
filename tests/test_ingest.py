"""Every landed result set into its own table, and the daily summary from mergeable state."""

import datetime as dt
import json

import pytest

from courtside.operators import merge
from courtside.operators.drift import SchemaDriftError
from courtside.plans import daily_state, ingest, staging
from courtside.sources import schemas
from tests.conftest import make, rows


def landed(spark, *found):
    """``(endpoint, key, hour, sets)`` as landed responses."""
    return spark.createDataFrame([(e, k, None if s is None else json.dumps(s), dt.datetime(2024, 11, 9, h)) for e, k, h, s in found],
                                 schemas.LANDING)


def box(h, pts, **more):
    return ("BoxScoreTraditionalV2", "g1", h, {
        "PlayerStats": [{"GAME_ID": "g1", "TEAM_ID": 7, "PLAYER_ID": p, "PTS": pts + p, "MIN": "12:30", "FG_PCT": 0.5, **more} for p in (1, 2)],
        "TeamStats": [{"GAME_ID": "g1", "TEAM_ID": 7, "PTS": pts}], "TeamStarterBenchStats": []})


def test_each_set_goes_to_its_table(spark):
    held = {"team_box": make(spark, "team_box", [{"id": 5, "game_id": "g1", "team_id": 7, "pts": 1, "team_name": "x"},
                                                 {"id": 6, "game_id": "g0", "team_id": 7, "pts": 2}]),
            "player_box": make(spark, "player_box", [])}
    summary = ("BoxScoreSummaryV2", "g1", 3, {"GameSummary": [{"GAME_ID": "g1", "GAME_STATUS_ID": 3, "LIVE": True, "NOTE": None, "PACE": 98.5}],
                                              "Officials": [{"NAME": "a"}, {"NAME": "a"}]})
    later = ("BoxScoreSummaryV2", "g1", 4, {"GameSummary": [{"GAME_ID": "g1", "GAME_STATUS_ID": 4, "LIVE": False, "NOTE": None, "PACE": 99.5}]})
    out = ingest.upsert_all(spark, held, landed(spark, box(2, 20), box(1, 10), summary, later, ("BoxScoreSummaryV2", "g9", 5, None)))
    assert set(out) == {"team_box", "player_box", "boxscoresummaryv2__gamesummary", "boxscoresummaryv2__officials"}
    team = {r["game_id"]: (r["id"], r["pts"], r["team_name"]) for r in out["team_box"].collect()}
    assert team == {"g1": (5, 20, None), "g0": (6, 2, None)}
    players = [(r["id"], r["player_id"], r["pts"], r["min"], r["fg_pct"], r["updated_at"].hour) for r in out["player_box"].orderBy("id").collect()]
    assert players == [(1, 1, 21, "12:30", 0.5, 2), (2, 2, 22, "12:30", 0.5, 2)]
    games = out["boxscoresummaryv2__gamesummary"]
    assert [tuple(r) for r in games.select("game_id", "game_status_id", "live", "note").collect()] == [("g1", 4, False, None)]
    assert dict(games.dtypes)["game_status_id"] == "bigint" and dict(games.dtypes)["live"] == "boolean"
    assert out["boxscoresummaryv2__officials"].count() == 2  # no key: every record is kept


def test_unknown_fields_are_not_lost_in_silence(spark):
    held = {"player_box": make(spark, "player_box", [{"id": 1, "game_id": "g0", "team_id": 7, "player_id": 9}])}
    new = landed(spark, box(1, 10, SPEED=4.25))
    with pytest.raises(SchemaDriftError, match="speed"):
        ingest.upsert_all(spark, held, new)
    out = ingest.upsert_all(spark, held, new, policy="sync_all_columns")["player_box"]
    assert sorted((r["player_id"], r["speed"] and float(r["speed"])) for r in out.collect()) == [(1, 4.25), (2, 4.25), (9, None)]


def test_rebuild_keeps_the_version_before_for_its_readers(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    first = merge.rebuild(spark, spark.range(3).toDF("x"), path)
    second = merge.rebuild(spark, first.selectExpr("x + 10 AS x"), path)
    assert sorted(r["x"] for r in first.collect()) == [0, 1, 2] and sorted(r["x"] for r in second.collect()) == [10, 11, 12]
    merge.rebuild(spark, second, path)
    assert sorted(p.name for p in tmp_path.glob("t/[cv]*")) == ["current-2", "current-3", "v2", "v3"]


def test_daily_state_equals_a_full_refresh(spark):
    stamp = lambda d: dt.datetime(2024, 11, d)
    g = lambda i, gid, day, d: {"id": i, "game_id": gid, "game_date": day, "season_id": "22024", "team_id": i, "updated_at": d and stamp(d)}
    b = lambda i, gid, d: {"id": i, "game_id": gid, "team_id": i, "updated_at": d and stamp(d)}
    games = [[g(1, "a", "2024-11-01", 1), g(2, "a", "2024-11-01", 1), g(3, "b", "2024-11-01", None), g(4, None, "2024-11-02", 2), g(5, "c", None, 1)],
             [g(6, "d", "2024-11-01", 9), g(7, "a", "2024-11-03", 9), g(8, "b", "2024-11-01", 9), g(9, "e", None, 9)],
             [], [g(10, "f", "2024-12-24", 12)]]
    boxes = [[b(1, "a", 2), b(2, "zz", 2)], [b(3, "b", 10), b(4, "d", None)], [b(5, "a", 11), b(6, "a", 11), b(7, "c", 11), b(8, "f", 11)], []]
    make_all = lambda parts, k, table: make(spark, table, [r for p in parts[:k] for r in p])
    state = daily_state.DailyState.start(spark, make_all(games, 1, "games"), make_all(boxes, 1, "team_box"))
    for k in range(1, 5):
        if k > 1:
            state.add(make(spark, "games", games[k - 1]), make(spark, "team_box", boxes[k - 1]))
        full = staging.stg_daily_game_summary(make_all(games, k, "games"), make_all(boxes, k, "team_box"))
        assert rows(state.summary()) == rows(full), k


def test_checks_in_the_write_equal_the_plain_ones(spark, tmp_path):
    from courtside.operators import checks as C

    df = spark.createDataFrame([(1, "a", "x"), (1, "b", None), (None, "a", "x"), (None, "a", "y"), (2, None, "z"), (2, None, "z")],
                               "id int, part string, kind string")
    rules = [*C.not_null("id", "part"), C.unique("id"), C.unique("kind"), C.unique_combination("id", "part"),
             C.unique_combination("part", "kind"), C.accepted_values("kind", ["x"]), C.accepted_values("id", ["1", "2"])]
    stored, found = C.write_checked(df, rules, f"file://{tmp_path}/t")
    assert rows(found) == rows(C.run_checks(df, rules)) and rows(stored) == rows(df)
    assert rows(C.write_checked(df, C.not_null("id"), f"file://{tmp_path}/u")[1]) == rows(C.run_checks(df, C.not_null("id")))


def test_only_the_tables_stay(spark):
    """The routed records and the copies between steps are deleted when the tables are stored."""
    from pathlib import Path

    from courtside.session import ensure_checkpoint_dir

    folder = Path(ensure_checkpoint_dir(spark).removeprefix("file:")) / "courtside"
    found = lambda: {p.name for p in folder.iterdir()} if folder.exists() else set()
    before = found()
    out = ingest.upsert_all(spark, {"player_box": make(spark, "player_box", [])}, landed(spark, box(1, 10)))
    assert {n.rsplit("-", 1)[0] for n in found() - before} == set(out)
    assert out["player_box"].count() == 2


def test_a_table_is_merged_by_parts_of_its_keys(spark, monkeypatch):
    """The rows of one join, whatever the parts: keys that hold a null, keys that the target holds twice, repeats."""
    from pyspark.sql import functions as F

    from courtside.operators.joins import held_path, temporary

    monkeypatch.setattr(merge, "PART_BYTES", 1)
    line = lambda i, g, t, pts: {"id": i, "game_id": g, "team_id": t, "pts": pts, "team_city": f"c{i}"}
    keys = ["team_id", "game_id"]
    target = make(spark, "team_box", [line(i, f"g{i % 20}", 7, i) for i in range(40)] + [line(90, None, 7, 1), line(91, None, 7, 2), line(92, "g1", None, 3)])
    found = [line(0, f"g{i % 30}", 7 + i % 2, 100 + i) for i in range(90)] + [line(0, None, 7, 1000), line(0, None, None, 1001), line(0, None, 7, 1002)]
    batch = make(spark, "team_box", found).drop("id", "team_city").withColumn(
        "arrival", F.struct(F.lit(dt.datetime(2024, 1, 1)).alias("fetched_at"), F.lit("k").alias("request_key"), F.col("pts").alias("position")))
    plain = merge.upsert(target, merge.latest_per_key(batch, keys, F.col("arrival")).drop("arrival"), keys)
    with temporary(spark):
        batch.write.parquet(path := held_path(spark, "read"))
        joins = []
        monkeypatch.setattr(merge, "_merged", lambda *a, f=merge._merged: (joins.append(a), f(*a))[1])
        got = merge.upsert_by_parts(spark, target, spark.read.schema(batch.schema).parquet(path), keys, "arrival", read=[path])
        assert len(joins) == merge.MOST_PARTS
        assert not spark._jvm.java.io.File(path.removeprefix("file:")).exists()
        assert rows(got) == rows(plain)
        unnumbered = merge.upsert_by_parts(spark, target.drop("id"), batch, keys, "arrival")
        assert rows(unnumbered) == rows(plain.drop("id"))


def test_responses_of_several_sources_are_routed_one_after_another(spark):
    held = {"player_box": make(spark, "player_box", [{"id": 1, "game_id": "g0", "team_id": 7, "player_id": 9}])}
    first, second = landed(spark, box(2, 20)), landed(spark, box(1, 10), ("BoxScoreSummaryV2", "g1", 3, {"GameSummary": [{"GAME_ID": "g1"}]}))
    both, one = ingest.upsert_all(spark, held, [first, second]), ingest.upsert_all(spark, held, first.unionByName(second))
    assert set(both) == set(one) and len(one) == 3 and all(rows(both[n]) == rows(one[n]) for n in one)


def test_result_sets_whose_names_differ_by_case_share_a_table(spark):
    twice = ("BoxScoreSummaryV2", "g1", 3, {"Officials": [{"NAME": "a"}], "OFFICIALS": [{"NAME": "b"}]})
    out = ingest.upsert_all(spark, {}, landed(spark, twice))
    assert sorted(r["name"] for r in out["boxscoresummaryv2__officials"].collect()) == ["a", "b"]


def test_box_responses_hold_the_rows_of_the_three_tables(spark, tmp_path):
    """Odd lines: numbers that are null or below zero, repeats, a game whose team box is missing, lines without a game."""
    from courtside.sources import landing
    from courtside.sources.driver_fixtures import DriverTables, box_landing

    day = dt.datetime(2001, 1, 1)
    line = lambda k, n, q=3.0, p=5: (k, p, 7, n, q, 1.0, 0.05, 0.02, day if p else None)
    lines = [line(10, 1), line(10, 1), line(10, 2, None), line(10, 6, 2.5), line(10, 7, 2.5, None), line(13, 1), line(13, 2), line(14, None), line(14, -1),
             line(14, 5), line(99, 1), line(None, 1)]
    spark.createDataFrame(lines, "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
                          "l_discount double, l_tax double, l_shipdate timestamp_ntz").write.parquet(f"file://{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(k, 1, day, "1-URGENT", "F") for k in (10, 13, 14, 15, None)], "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz, "
                          "o_orderpriority string, o_orderstatus string").write.parquet(f"file://{tmp_path}/orders.parquet")
    t = DriverTables(spark, f"file://{tmp_path}")
    expected = {k: {} for k in ("10", "13", "14", "15")}
    for name, table in landing.BOX_RESULT_SETS.items():
        for r in sorted(getattr(t, table).collect(), key=lambda r: (r["id"] is not None, r["id"])):
            if r["game_id"] in expected:
                expected[r["game_id"]].setdefault(name, []).append(
                    {k.upper(): v for k, v in r.asDict().items() if v is not None and k not in ("id", "updated_at")})
    assert {r["request_key"]: json.loads(r["payload"]) for r in box_landing(t).collect()} == expected
    assert "TeamStats" not in expected["13"] and expected["15"] == {} and len(expected["14"]["TeamStarterBenchStats"]) == 3
    scans = lambda df: df._jdf.queryExecution().executedPlan().toString().count("FileScan parquet")
    assert scans(box_landing(t)) == 2  # the games, and the lines once for all three
