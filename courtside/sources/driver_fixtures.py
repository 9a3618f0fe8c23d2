"""Raw-shaped tables and landed responses made from the driver's tables (FIXTURES.md). Only the registry
of queries and the tests use this module.

``DriverTables`` derives raw-shaped views from the TPC-H-like parquet files (orders, lineitem, events);
each is a narrow projection over one scan, so column pruning and filter pushdown reach the parquet
reader. ``game_landing`` / ``box_landing`` / ``summary_landing`` build API responses from them (one per
game, as the per-game endpoint returns; error and empty responses per date), so the ingest path is
exercised on data that grows with the tables.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.joins import join_dimension
from . import landing, schemas
from .tables import conform


def _days(n: Column) -> Column:
    return F.make_dt_interval(n.cast("int"))


def _mod(c: str | Column, m: int) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c % F.lit(m)


def _player_columns() -> dict[str, Column]:
    """Of a numbered line."""
    q = F.col("l_quantity").cast("int").cast("string")
    line = F.col("l_linenumber")
    minutes = (F.when(_mod("l_partkey", 37) == 0, F.lit(None).cast("string"))
               .when(_mod("l_suppkey", 50) == 7, F.lit("DNP"))
               .when(line == 4, F.lit("0:00"))
               .when(line == 2, F.concat(q, F.lit("-30")))
               .when(line == 3, F.concat(q, F.lit(".5")))
               .otherwise(F.concat(q, F.lit(":"), F.lpad(_mod("l_partkey", 60).cast("string"), 2, "0"))))
    oreb = F.round(F.col("l_tax") * 100).cast("bigint")
    dreb = line.cast("bigint")
    return {
        "id": (F.col("l_orderkey") * 1000 + F.col("position")).cast("bigint"),
        "game_id": F.col("game_id"),
        "team_id": (_mod("l_partkey", 30) + 1).cast("bigint"),
        "player_id": F.col("l_suppkey").cast("bigint"),
        "player_name": F.concat(F.lit("player-"), F.col("l_suppkey").cast("string"),
                                F.when(line == 7, F.lit("-jr")).otherwise(F.lit(""))),
        "min": minutes,
        "pts": F.when(_mod("l_partkey", 41) == 0, F.lit(None).cast("bigint")).otherwise(F.col("l_quantity").cast("bigint")),
        "ast": F.round(F.col("l_discount") * 100).cast("bigint"),
        "oreb": oreb, "dreb": dreb, "reb": oreb + dreb,
        "stl": _mod("l_partkey", 12).cast("bigint"),
        "blk": _mod("l_suppkey", 11).cast("bigint"),
        "pf": _mod("l_orderkey", 6).cast("bigint"),
        "fgm": _mod("l_partkey", 15).cast("bigint"),
        "fg3m": _mod("l_partkey", 5).cast("bigint"),
        "ftm": _mod("l_orderkey", 8).cast("bigint"),
        "fga": (_mod("l_partkey", 15) + _mod("l_suppkey", 4) + _mod("l_orderkey", 5)).cast("bigint"),
        "fg3a": (_mod("l_partkey", 5) + _mod("l_suppkey", 4)).cast("bigint"),
        "fta": (_mod("l_orderkey", 8) + _mod(line, 3)).cast("bigint"),
        "updated_at": F.when(_mod("l_partkey", 17) == 0, F.lit(None).cast("timestamp_ntz")).otherwise(F.col("l_shipdate")),
    }


def _side() -> Column:
    return _mod("l_linenumber", 2)


def _role() -> Column:
    return F.when(F.col("l_linenumber") <= 5, F.lit("Starters")).otherwise(F.lit("Bench"))


def _has_team_box() -> Column:
    return _mod("l_orderkey", 10) != 3


def _team_columns(side: Column) -> dict[str, Column]:
    return {"id": (F.col("l_orderkey") * 2 + side).cast("bigint"),
            "game_id": F.col("l_orderkey").cast("string"), "team_id": side.cast("bigint")}


def _bench_columns(side: Column, role: Column) -> dict[str, Column]:
    return {"id": (F.col("l_orderkey") * 4 + side * 2 + F.when(role == "Starters", 0).otherwise(1)).cast("bigint"),
            "game_id": F.col("l_orderkey").cast("string"), "team_id": side.cast("bigint"), "starters_bench": role}


def _named(columns: dict[str, Column]) -> list[Column]:
    return [c.alias(name) for name, c in columns.items()]


class DriverTables:
    """Raw-shaped views over one scale-factor folder of the driver's tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # -- games -------------------------------------------------------------------------------
    @cached_property
    def games(self) -> DataFrame:
        """Two team rows per order, plus a third (cup-final season) row for every 53rd order."""
        o = self._read("orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
        k = F.col("o_orderkey")
        side = F.col("side")
        sides = F.when(_mod(k, 53) == 0, F.array(F.lit(0), F.lit(1), F.lit(2))).otherwise(F.array(F.lit(0), F.lit(1)))
        g = o.withColumn("side", F.explode(sides))
        year = F.year("o_orderdate").cast("string")
        phase = (F.when(side == 2, F.lit("6"))
                 .when(_mod(k, 97) == 0, F.lit("6"))
                 .otherwise(F.substring("o_orderpriority", 1, 1)))
        team = F.when(side == 2, _mod("o_custkey", 30) + 1).otherwise(_mod(F.col("o_custkey") + side * 7, 30) + 1)
        stamp = (F.when(side == 2, F.col("o_orderdate") + _days(F.lit(9)))
                 .when(_mod(k, 11) == 0, F.lit(None).cast("timestamp_ntz"))
                 .otherwise(F.col("o_orderdate") + _days(_mod(k, 5))))
        out = g.select(
            (k * 4 + side).cast("bigint").alias("id"),
            F.concat(phase, year).alias("season_id"),
            team.cast("bigint").alias("team_id"),
            F.concat(F.lit("T"), F.lpad(team.cast("string"), 2, "0")).alias("team_abbreviation"),
            F.concat(F.lit("Team "), team.cast("string")).alias("team_name"),
            k.cast("string").alias("game_id"),
            F.col("o_orderdate").cast("date").cast("string").alias("game_date"),
            F.when(side == 2, F.lit("W")).when(_mod(k + side, 2) == 0, F.lit("W")).otherwise(F.lit("L")).alias("wl"),
            stamp.alias("updated_at"),
        )
        return conform(out, schemas.GAMES)

    # -- player box --------------------------------------------------------------------------
    @cached_property
    def player_box(self) -> DataFrame:
        return self._player_lines("l_orderkey")

    @cached_property
    def player_box_by_game(self) -> DataFrame:
        """The rows of ``player_box``, dealt by ``game_id`` for readers that group by it: they need no second exchange."""
        return self._player_lines("game_id")

    def _player_lines(self, dealt_by: str) -> DataFrame:
        return conform(self._lines(dealt_by).select(*_named(_player_columns())), schemas.PLAYER_BOX)

    def _lines(self, dealt_by: str) -> DataFrame:
        li = self._read("lineitem").select(
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
            "l_discount", "l_tax", "l_shipdate")
        # Surrogate id: order key * 1000 + position of the line inside its order (at most 7 lines). Numbered first, so
        # that the lines are dealt as they are read, not as the many columns made of them, nor with the key twice.
        game = F.col("l_orderkey").cast("string")
        if dealt_by == "game_id":
            li = li.withColumn("game_id", game)
        w = Window.partitionBy(dealt_by).orderBy(
            "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
            "l_tax", "l_shipdate")
        li = li.withColumn("position", F.row_number().over(w))
        return li if dealt_by == "game_id" else li.withColumn("game_id", game)

    # -- team and starter/bench box ----------------------------------------------------------
    def _team_rollup(self, extra_keys: list[Column], where: Column | None) -> DataFrame:
        li = self._read("lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate")
        if where is not None:
            li = li.filter(where)
        keys = [F.col("l_orderkey"), _side().alias("side"), *extra_keys]
        return li.groupBy(*keys).agg(
            F.sum("l_quantity").cast("bigint").alias("pts"),
            F.max("l_shipdate").alias("updated_at"),
        )

    @cached_property
    def team_box(self) -> DataFrame:
        t = self._team_rollup([], _has_team_box())
        return conform(t.select(*_named(_team_columns(F.col("side"))), "pts", "updated_at"), schemas.TEAM_BOX)

    @cached_property
    def bench_box(self) -> DataFrame:
        t = self._team_rollup([_role().alias("starters_bench")], None)
        out = t.select(*_named(_bench_columns(F.col("side"), F.col("starters_bench"))), "pts", "updated_at")
        return conform(out, schemas.BENCH_BOX)

    # -- box scores by game ------------------------------------------------------------------
    def boxes_by_game(self, sets: dict[str, str]) -> DataFrame:
        """Per game id, under the names of ``sets``, the records of its rows in the table of that name (one of
        ``player_box``, ``team_box`` and ``bench_box``); NULL where it has none. The lines are dealt once, by game, for all."""
        li = self._lines("game_id").filter(F.col("game_id").isNotNull()).withColumns({"_side": _side(), "_role": _role()})
        side, role = F.col("_side"), F.col("_role")
        # All are windows over the game's lines, which stay as they are read until the last one: no list and no row made
        # of a line is sorted or exchanged. The finest first, so that the coarser ones find their order.
        points = lambda *of: F.sum("l_quantity").over(Window.partitionBy("game_id", *of)).cast("bigint")
        li = li.withColumn("_bench_pts", points(side, role)).withColumn("_team_pts", points(side))
        team = {**_team_columns(side), "pts": F.col("_team_pts")}
        bench = {**_bench_columns(side, role), "pts": F.col("_bench_pts")}
        li = li.select("game_id", "position", _listed(schemas.PLAYER_BOX, _player_columns()).alias("player_box"),
                       F.when(_has_team_box(), _listed(schemas.TEAM_BOX, team)).alias("team_box"),
                       _listed(schemas.BENCH_BOX, bench).alias("bench_box"))
        # A rollup's row is found at each of its lines, equal, so a set holds it once.
        rows = {"player_box": F.collect_list, "team_box": F.collect_set, "bench_box": F.collect_set}
        game = Window.partitionBy("game_id")
        found = li.select("game_id", "position", *[rows[table](table).over(game).alias(name) for name, table in sets.items()]).filter("position = 1")
        return found.select("game_id", *[F.when(F.size(name) > 0, F.sort_array(name)["rec"]).alias(name) for name in sets])

    # -- work queue ----------------------------------------------------------------------------
    @cached_property
    def date_status(self) -> DataFrame:
        d = self._read("orders").select("o_orderdate").distinct()
        day = F.dayofmonth("o_orderdate")
        status = (F.when(day % 7 == 0, F.lit("pending"))
                  .when(day % 11 == 0, F.lit("no_games"))
                  .otherwise(F.lit("processed")))
        last_checked = F.col("o_orderdate") + _days(day % 4)
        out = d.select(
            F.col("o_orderdate").cast("date").alias("date"),
            status.alias("status"),
            last_checked.alias("last_checked"),
            (day % 3).cast("int").alias("retry_count"),
            F.col("o_orderdate").alias("created_at"),
            F.when(status != "pending", last_checked).alias("updated_at"),
        )
        return conform(out, schemas.DATE_STATUS)

    # -- api call log ----------------------------------------------------------------------------
    @cached_property
    def api_calls(self) -> DataFrame:
        e = self._read("events").select("event_id", "ts", "event_type", "props")
        out = e.select(
            F.col("event_id").alias("id"),
            F.col("event_type").alias("endpoint"),
            F.col("ts").alias("call_time"),
            (F.col("event_type") != "error").alias("success"),
            F.when(F.col("event_type") == "error", F.col("props")).alias("error_message"),
        )
        return conform(out, schemas.API_CALLS)

    # -- game summaries (loaded for finished orders only) ------------------------------------
    @cached_property
    def game_summary(self) -> DataFrame:
        o = self._read("orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
        return o.filter(F.col("o_orderstatus") == "F").select(
            F.col("o_orderkey").cast("string").alias("game_id"),
            F.col("o_orderdate").cast("date").alias("game_date_est"),
            F.lit("Final").alias("game_status_text"),
            (F.col("o_orderdate") + _days(F.lit(2))).alias("updated_at"),
        )


def _record(df: DataFrame, schema: T.StructType, skip: tuple[str, ...] = ("id", "updated_at")) -> Column:
    """A struct with the API's upper-case field names, from the raw-table columns."""
    return F.struct(*[F.col(f.name).alias(f.name.upper()) for f in schema.fields if f.name not in skip])


def _listed(schema: T.StructType, columns: dict[str, Column]) -> Column:
    """A row's id and ``_record``, from its columns' expressions and without fields that are always NULL."""
    rec = [columns[f.name].cast(f.dataType).alias(f.name.upper()) for f in schema if f.name in columns and f.name not in ("id", "updated_at")]
    return F.struct(columns["id"].alias("id"), F.struct(*rec).alias("rec"))


def game_landing(t: DriverTables) -> DataFrame:
    """Game-list responses: one per game on a processed date; per date, an empty response on a
    no-games date and a failed (NULL) response on every second pending date."""
    games = t.games
    # One response per game: the list holds that game's team rows (two or three), a bound set
    # by the sport, not by data volume.
    per_game = (games.groupBy("game_date", "game_id")
                .agg(F.sort_array(F.collect_list(F.struct("id", _record(games, schemas.GAMES).alias("rec")))).alias("listed"))
                .withColumn("recs", F.col("listed.rec"))
                .select(F.col("game_date").alias("request_key"),
                        F.to_json(F.create_map(F.lit(landing.GAME_RESULT_SET), F.col("recs"))).alias("payload")))
    status = t.date_status.select("date", "status")
    failed = (F.col("status") == "pending") & (F.dayofmonth("date") % 2 == 0)
    no_games = F.col("status") == "no_games"
    fetched = (F.col("date").cast("timestamp_ntz") + F.make_dt_interval(F.lit(1))).alias("fetched_at")
    per_date = status.filter(failed | no_games).select(
        F.lit(landing.GAME_ENDPOINT).alias("endpoint"),
        F.col("date").cast("string").alias("request_key"),
        F.when(failed, F.lit(None).cast("string")).otherwise(F.lit('{"%s":[]}' % landing.GAME_RESULT_SET)).alias("payload"),
        fetched)
    ok_dates = status.filter(~(failed | no_games)).select(F.col("date").cast("string").alias("request_key"), "date")
    # Dates are calendar-bounded: broadcast them (size checked) so a busy date is not one task.
    games_rows = join_dimension(per_game, ok_dates, "request_key", "inner").select(
        F.lit(landing.GAME_ENDPOINT).alias("endpoint"), "request_key", "payload", fetched)
    return per_date.unionByName(games_rows)


def box_landing(t: DriverTables) -> DataFrame:
    """Box-score responses, one per listed game; a game with no rows anywhere gets ``{}``."""
    # Each list holds one game's lines (a roster: bounded by the rules of the sport).
    games = t.games.select("game_id").filter(F.col("game_id").isNotNull()).distinct()
    j = games.join(t.boxes_by_game(landing.BOX_RESULT_SETS), "game_id", "left")
    # Result sets differ in shape, so they go into a struct; to_json drops the NULL (absent) ones.
    entries = F.struct(*[F.col(name) for name in landing.BOX_RESULT_SETS])
    return j.select(
        F.lit(landing.BOX_ENDPOINT).alias("endpoint"),
        F.col("game_id").alias("request_key"),
        F.to_json(entries).alias("payload"),
        F.lit("2001-08-02 00:00:00").cast("timestamp_ntz").alias("fetched_at"),
    )


def summary_landing(t: DriverTables) -> DataFrame:
    """Game-summary responses, one per game that has a loaded summary."""
    summ = t.game_summary
    rec = F.struct(F.col("game_id").alias("GAME_ID"), F.col("game_date_est").cast("string").alias("GAME_DATE_EST"),
                   F.col("game_status_text").alias("GAME_STATUS_TEXT"))
    return summ.select(
        F.lit(landing.SUMMARY_ENDPOINT).alias("endpoint"),
        F.col("game_id").alias("request_key"),
        F.to_json(F.create_map(F.lit(landing.SUMMARY_RESULT_SET), F.array(rec))).alias("payload"),
        F.col("updated_at").alias("fetched_at"),
    )
