"""Properties: the three leaderboard forms agree, affected-keys refresh equals a full
refresh, upserting a batch twice equals once, and input row order does not matter."""

from pyspark.sql import functions as F

from courtside.operators import merge
from courtside.plans import incremental, staging
from courtside.plans import leaderboard as LB
from courtside.registry import PARAMS, inputs, tables
from tests.conftest import rows

KEY = ["cutoff_date", "season_id", "metric_name", "rank"]


def test_leaderboard_forms_agree(spark, sf_dir):
    inp = inputs(tables(spark, sf_dir))
    running = rows(LB.top20_by_metric(inp, PARAMS, "running"), KEY)
    assert running
    assert rows(LB.top20_by_metric(inp, PARAMS, "windowed"), KEY) == running
    assert rows(LB.top20_by_metric(inp, PARAMS, "direct"), KEY) == running


def test_input_order_does_not_matter(spark, sf_dir):
    t = tables(spark, sf_dir)
    base = rows(LB.top20_by_metric(inputs(t), PARAMS), KEY)
    shuffled = LB.Inputs(player_box=t.player_box.repartition(7, F.rand(3)).sortWithinPartitions(F.rand(5)),
                         games=t.games.repartition(5, F.rand(1)),
                         date_status=t.date_status.repartition(3))
    assert rows(LB.top20_by_metric(shuffled, PARAMS), KEY) == base


def test_affected_keys_equals_full_refresh(spark, sf_dir):
    """Rows never stamped arrive in the second run, which must find them."""
    t = tables(spark, sf_dir)
    for t0 in ["1996-06-01 00:00:00", "1999-01-01 00:00:00"]:
        before = lambda df, c: df.filter(F.col(c) < F.lit(t0).cast("timestamp_ntz"))
        games, box = before(t.games, "updated_at"), before(t.team_box, "updated_at")
        gbs0 = staging.stg_game_boxscore_status(games, box, before(t.date_status, "last_checked"))
        fresh, days = incremental.daily_affected_keys(t.games, t.team_box, gbs0, t0)
        got = merge.keyed_replace(staging.stg_daily_game_summary(games, box), fresh, ["game_date"], days)
        assert rows(got, ["game_date"]) == rows(staging.stg_daily_game_summary(t.games, t.team_box), ["game_date"])
        fresh, gone = incremental.gbs_affected_keys(t.games, t.team_box, t.date_status, gbs0, t0)
        full = staging.stg_game_boxscore_status(t.games, t.team_box, t.date_status)
        assert rows(merge.keyed_replace(gbs0, fresh, ["game_date", "game_id"], gone)) == rows(full)


def test_upsert_twice_equals_once(spark, sf_dir):
    t = tables(spark, sf_dir)
    keys = ["season_id", "team_id", "game_id"]
    target = t.games.filter(F.col("game_date") < "1997-01-01")
    batch = merge.latest_per_key(t.games.filter(F.col("game_date") >= "1996-07-01").drop("id"), keys,
                                 F.struct("updated_at", "wl"))
    once = merge.materialize(spark, merge.upsert(target, batch, keys), "once")
    twice = merge.upsert(once, batch, keys)
    assert rows(twice) == rows(once)
    assert once.count() == target.count() + batch.join(target, keys, "left_anti").count()
