"""The same landed files give the same table in one micro-batch and in many."""

import datetime as dt
import json
import os
import tempfile
from pathlib import Path

import pytest

from courtside.plans import staging
from courtside.registry import tables
from courtside.sources import schemas
from courtside.sources.driver_fixtures import game_landing
from courtside.streaming import streams
from tests.conftest import make, rows


def _land_events(spark, sf_dir, n_files):
    """The events table landed as ``n_files`` files in one folder (a scratch folder: tests only)."""
    flat = tempfile.mkdtemp(prefix="cs-land-") + "/events"
    spark.read.parquet(f"{sf_dir}/events.parquet").repartition(n_files, "event_id").write.parquet(flat)
    return flat


def test_api_log_stream_one_vs_many_batches(spark, sf_dir):
    src = _land_events(spark, sf_dir, 4)
    expect = rows(staging.stg_api_call_logs(tables(spark, sf_dir).api_calls), ["id"])
    for per_trigger in (None, 1):
        tgt, ck = tempfile.mkdtemp(prefix="cs-t-") + "/t", tempfile.mkdtemp(prefix="cs-c-")
        streams.run_to_end(streams.api_log_stream(spark, src, tgt, ck, max_files_per_trigger=per_trigger))
        got = streams.current_api_log(spark, tgt).select(
            "id", "endpoint", "call_time", "call_date", "success", "error_message", "updated_at")
        assert rows(got, ["id"]) == expect


def test_games_upsert_stream_one_vs_many_batches(spark, sf_dir):
    t = tables(spark, sf_dir)
    src = tempfile.mkdtemp(prefix="cs-gl-")
    game_landing(t).repartition(3).write.mode("overwrite").parquet(src)
    results = []
    for per_trigger in (None, 1):
        tgt, ck = tempfile.mkdtemp(prefix="cs-t-") + "/t", tempfile.mkdtemp(prefix="cs-c-")
        streams.run_to_end(streams.games_upsert_stream(spark, src, tgt, ck, max_files_per_trigger=per_trigger))
        results.append(rows(streams.current_games(spark, tgt), ["id"]))
    assert results[0] == results[1] and len({r["id"] for r in results[0]}) == len(results[0])


LANDING = "endpoint string, request_key string, payload string, fetched_at timestamp_ntz"


def _game_file(spark, folder, gid, wl, day):
    rec = {"SEASON_ID": "22024", "TEAM_ID": 7, "GAME_ID": gid, "GAME_DATE": "2024-11-01", "WL": wl}
    at = dt.datetime.fromisoformat(day)
    spark.createDataFrame([("LeagueGameFinder", "2024-11-01", json.dumps({"LeagueGameFinderResults": [rec]}), at)], LANDING) \
        .coalesce(1).write.mode("append").parquet(folder)


@pytest.mark.parametrize("marker", ["true", "false"])
def test_later_batches_keep_earlier_games(spark, tmp_path, marker):
    """With or without marker files, and with a checkpoint lost in between."""
    conf = spark._jsc.hadoopConfiguration()
    conf.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", marker)
    try:
        src, tgt = f"file://{tmp_path}/src", f"file://{tmp_path}/t"
        for k, gid in enumerate(["g1", "g2", "g3"]):
            _game_file(spark, src, gid, "W", "2024-11-03")
            streams.run_to_end(streams.games_upsert_stream(spark, src, tgt, f"file://{tmp_path}/c{k // 2}"))
            assert {r["game_id"] for r in streams.current_games(spark, tgt).collect()} == {"g1", "g2", "g3"} - {"g3", "g2"} \
                if k == 0 else streams.current_games(spark, tgt).count() == k + 1
    finally:
        conf.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")


@pytest.mark.parametrize("order", [("2024-11-02", "2024-11-03"), ("2024-11-03", "2024-11-02")])
@pytest.mark.parametrize("batches", [1, 2])
def test_newest_response_wins_however_files_land(spark, tmp_path, order, batches):
    src, tgt, ck = (f"file://{tmp_path}/{x}" for x in "stc")
    for day in order:
        _game_file(spark, src, "g1", "W" if day.endswith("3") else "L", day)
        if batches == 2:
            streams.run_to_end(streams.games_upsert_stream(spark, src, tgt, ck))
    if batches == 1:
        streams.run_to_end(streams.games_upsert_stream(spark, src, tgt, ck))
    assert [(r["game_id"], r["wl"]) for r in streams.current_games(spark, tgt).collect()] == [("g1", "W")]


def test_restated_call_keeps_one_row(spark, tmp_path):
    src, tgt, ck = (f"file://{tmp_path}/{x}" for x in "stc")
    for day, kind in (("2024-01-01", "view"), ("2024-01-02", "error")):
        spark.createDataFrame([(1, dt.datetime.fromisoformat(day), 1, kind, 0.5, "late")], streams.EVENTS_SCHEMA) \
            .coalesce(1).write.mode("append").parquet(src)
        streams.run_to_end(streams.api_log_stream(spark, src, tgt, ck))
    got = streams.current_api_log(spark, tgt).collect()
    assert [(r["id"], str(r["call_date"]), r["error_message"]) for r in got] == [(1, "2024-01-02", "late")]
    assert streams.versions(spark, tgt, streams.API_LOG_SCHEMA).count() == 2
    streams.compact(spark, tgt, streams.API_LOG_SCHEMA, ["id"], streams._newest_call(), f"file://{tmp_path}/small")
    assert streams.current_api_log(spark, f"file://{tmp_path}/small").collect() == got


# -- the catch-up flow and the bounded log ---------------------------------------------------------------

class Lost(Exception):
    pass


@pytest.mark.parametrize("sink", ["games", "responses", "status"])
def test_catch_up_lost_between_sinks(spark, tmp_path, sink):
    """A run that ends after a sink is repeated: same tables as a run that was never lost, and no date is
    processed whose games are not stored."""
    day = "2024-11-0{}"
    rec = '{{"SEASON_ID": "22024", "TEAM_ID": 7, "GAME_ID": "g{}", "GAME_DATE": "{}"}}'
    made = lambda k, body: ("LeagueGameFinder", day.format(k), body, dt.datetime(2024, 11, 9, k))
    found = [made(1, '{"LeagueGameFinderResults": [%s]}' % rec.format(1, day.format(1))), made(2, '{"LeagueGameFinderResults": []}'), made(3, None),
             made(4, '{"LeagueGameFinderResults": [%s, %s]}' % (rec.format(4, day.format(4)), rec.format(5, day.format(4))))]
    status = make(spark, "date_status", [{"date": dt.date(2024, 11, k), "status": "pending", "retry_count": 0} for k in range(1, 6)])
    for k, row in enumerate(found):
        spark.createDataFrame([row], schemas.LANDING).write.mode("append").parquet(f"{tmp_path}/land")

    def run(root, ckpt, committed=lambda s: None):
        streams.run_to_end(streams.catch_up_stream(spark, f"file://{tmp_path}/land", f"file://{tmp_path}/{root}", f"file://{tmp_path}/{ckpt}",
                                                   status, "2024-11-10 00:00:00", max_files_per_trigger=2, committed=committed))

    state = lambda root: (sorted(map(str, streams.current_status(spark, f"file://{tmp_path}/{root}", status).collect())),
                          sorted(map(str, streams.current_games(spark, f"file://{tmp_path}/{root}/games").collect())))
    run("whole", "ckpt-whole")

    def lose(name):
        if name == sink:
            raise Lost

    with pytest.raises(Exception, match="Lost"):
        run("lost", "ckpt-lost", lose)
    half = streams.current_status(spark, f"file://{tmp_path}/lost", status).filter("status = 'processed'").select("date").collect()
    stored = {r["game_date"] for r in streams.current_games(spark, f"file://{tmp_path}/lost/games").collect()}
    assert {str(r["date"]) for r in half} <= stored
    run("lost", "ckpt-lost")
    assert state("lost") == state("whole")
    got = {r["date"].day: r["status"] for r in streams.current_status(spark, f"file://{tmp_path}/lost", status).collect()}
    assert got == {1: "processed", 2: "no_games", 3: "pending", 4: "processed", 5: "pending"}


def test_repeats_inside_and_outside_the_bound(spark, tmp_path):
    source, base = f"{tmp_path}/events", 1_700_000_000
    call = lambda k, day: (k, dt.datetime(2024, 1, day), 1, "ok", 0.0, None)
    # (landed after hours, calls): id 1 lands again after an hour, and after 25 days.
    for hours, calls in ((0, [call(1, 1), call(2, 1), call(1, 1)]), (1, [call(1, 1), call(3, 2)]), (240, [call(4, 3)]), (480, [call(5, 1)]), (500, [call(6, 1)]), (600, [call(1, 1)])):
        spark.createDataFrame(calls, streams.EVENTS_SCHEMA).coalesce(1).write.mode("append").parquet(source)
        for f in Path(source).glob("*.parquet"):
            if f.stat().st_mtime > base + 10_000_000:
                os.utime(f, (base + hours * 3600, base + hours * 3600))
    streams.run_to_end(streams.api_log_dedup_stream(spark, f"file://{source}", f"file://{tmp_path}/t", f"file://{tmp_path}/c", "7 days",
                                                    max_files_per_trigger=1))
    ids = sorted(r["id"] for r in streams.appended_api_log(spark, f"file://{tmp_path}/t").collect())
    assert ids == [1, 1, 2, 3, 4, 5, 6]
    assert sorted(r["id"] for r in streams.current_api_log(spark, f"file://{tmp_path}/t").collect()) == [1, 2, 3, 4, 5, 6]


# -- box status from two streams -------------------------------------------------------------------------

def _land(spark, folder, schema, rows):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)


@pytest.mark.parametrize("per_trigger", [None, 1])
def test_box_status_of_two_streams(spark, tmp_path, per_trigger):
    """A box before, after, twice and never; games again, without an id, on a date without status."""
    at = lambda day: dt.datetime(2024, 11, day)
    games, boxes = f"{tmp_path}/games", f"{tmp_path}/boxes"
    game = lambda g, day, landed: (g, f"2024-11-{day:02d}", at(day), at(landed), False)
    _land(spark, games, streams.GAMES_LANDED, [game("before", 2, 3), game("after", 2, 3), game("never", 2, 3), game("never", 2, 3)])
    _land(spark, boxes, streams.BOXES_LANDED, [("before", at(1), at(1), False), ("nobody", at(1), at(1), False)])
    _land(spark, games, streams.GAMES_LANDED, [game("twice", 3, 4), ("after", "2024-11-02", at(4), at(4), False), (None, "2024-11-03", None, at(4), False)])
    _land(spark, boxes, streams.BOXES_LANDED, [("after", at(5), at(5), False), ("twice", at(5), at(5), False), ("twice", at(6), at(6), False)])
    _land(spark, games, streams.GAMES_LANDED, [(None, None, None, at(25), True)])
    _land(spark, boxes, streams.BOXES_LANDED, [(None, None, at(25), True)])
    status = make(spark, "date_status", [{"date": dt.date(2024, 11, 2), "status": "processed", "retry_count": 2, "last_checked": at(3)}])

    def run():
        streams.run_to_end(streams.box_status_stream(spark, f"file://{games}", f"file://{boxes}", f"file://{tmp_path}/t", f"file://{tmp_path}/c",
                                                     "10 days", "1 hour", max_files_per_trigger=per_trigger))
        return sorted((r["game_id"] or "", r["has_boxscore"], r["retry_count"], r["updated_at"] and r["updated_at"].day)
                      for r in streams.current_box_status(spark, f"file://{tmp_path}/t", status).collect())

    whole = [("", False, 0, None), ("after", True, 2, 5), ("before", True, 2, 3), ("never", False, 2, 3),
             ("twice", True, 0, 5), ("twice", True, 0, 6)]
    assert run() == whole
    # Late: a box after its game's bound, and a game stamped long before the newest one. Neither changes the table.
    _land(spark, boxes, streams.BOXES_LANDED, [("never", at(26), at(26), False)])
    _land(spark, games, streams.GAMES_LANDED, [game("long ago", 2, 3)])
    assert run() == whole


def test_box_status_streams_without_rows(spark, tmp_path):
    for name, schema in (("games", streams.GAMES_LANDED), ("boxes", streams.BOXES_LANDED)):
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}")
    streams.run_to_end(streams.box_status_stream(spark, f"file://{tmp_path}/games", f"file://{tmp_path}/boxes", f"file://{tmp_path}/t",
                                                 f"file://{tmp_path}/c"))
    assert streams.current_box_status(spark, f"file://{tmp_path}/t", make(spark, "date_status", [])).count() == 0
