"""M8: top-k players per (snapshot date, season, metric).

Steps: processed cutoff dates -> canonical player lines -> per-game facts -> canonical
games -> season latest dates -> facts with game metadata -> per-(cutoff, season, player)
aggregates -> unpivot to 20 metrics -> rank -> keep top k.

Three interchangeable forms compute the aggregates (all give the same rows):

* ``direct``   - every cutoff against every season, the reference's window test on each pair, its final
                 window filter on the pairs that pass.
* ``windowed`` - the window ``[latest - max(365, N), latest + N]`` is applied to
                 (season, cutoff) pairs before touching game rows (rewrite R1), and the
                 pairs are joined on season. Like ``direct`` it adds up a player's games between two
                 cutoffs before they meet the pairs.
* ``running``  - (default) aggregate once per (season, player, date), take running
                 totals over the player's dates, and look up the cutoffs that each date
                 interval holds in the season's calendar (rewrite R2). Rows become
                 players x cutoffs. No job runs while the plan is built.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import expressions as X
from ..operators.dedupe import canonical_games, canonical_player_box
from ..operators.ranking import top_k_per_group

# ---------------------------------------------------------------------------------------------
# Fixed values that must equal the reference's for right results.
#   Per-game averages, in the reference's metric order, then the three count metrics.
AVG_METRICS = ["pts", "ast", "reb", "dreb", "oreb", "stl", "blk", "minutes", "pf", "ftm", "fta",
               "fg2m", "fg2a", "fg3m", "fg3a", "fgm", "fga"]
COUNT_METRICS = ["doubles", "double_doubles", "triple_doubles"]
#   Minimum ten-plus categories for a double, double-double, triple-double.
COUNT_THRESHOLDS = {"doubles": 1, "double_doubles": 2, "triple_doubles": 3}
#   Snapshots look back this far from the season's latest game.
SEASON_WINDOW_DAYS = 365
#   Default parameters: recency window, first snapshot date, leaderboard depth.
RECENCY_DAYS = 10
START_DATE = "2025-04-01"
MAX_RANK = 20
#   The part of the players, one in so many, whose k-th row bounds a leaderboard (any value gives the same rows).
ONE_IN = 64
# ---------------------------------------------------------------------------------------------

METRIC_NAMES = [f"avg_{m}" for m in AVG_METRICS] + COUNT_METRICS
# What a game tells of each of its player lines.
GAME_META = ["season_id", "game_date", "latest_season_game_date"]
# Integer stats averaged directly; minutes are averaged from exact seconds.
INT_STATS = [m for m in AVG_METRICS if m != "minutes"]


@dataclass(frozen=True)
class Params:
    start_date: str = START_DATE
    recency_days: int = RECENCY_DAYS
    k: int = MAX_RANK
    as_of: str | None = None  # stamp written to updated_at; None = current time

    @property
    def lookback_days(self) -> int:
        return max(SEASON_WINDOW_DAYS, self.recency_days)

    def stamp(self) -> Column:
        if self.as_of is None:
            # The clock in UTC, whatever the session's zone (trap T2).
            return F.to_timestamp_ntz(F.date_format(F.convert_timezone(None, F.lit("UTC"), F.localtimestamp()), "yyyy-MM-dd HH:mm:ss"))
        return F.lit(self.as_of).cast("timestamp_ntz")


# -- inputs -----------------------------------------------------------------------------------

def processed_cutoffs(stg_status: DataFrame, start_date: str, existing: DataFrame | None = None) -> DataFrame:
    """Processed dates on or after ``start_date``; incremental runs drop dates already stored.

    ``existing`` is the stored target; the anti join ignores NULL dates in it (unlike
    ``NOT IN``, where one NULL would empty the result - trap T6).
    """
    c = (stg_status.filter((F.col("status") == "processed") & (F.col("game_date") >= F.lit(start_date).cast("date")))
         .select(F.col("game_date").alias("cutoff_date")))
    if existing is not None:
        seen = existing.select("cutoff_date").filter(F.col("cutoff_date").isNotNull()).distinct()
        c = c.join(seen, "cutoff_date", "left_anti")
    return c.distinct()


def player_game_facts(player_box: DataFrame, of_game: list[str] | None = None) -> DataFrame:
    """Canonical lines of players who played, with two-point, minutes and ten-plus columns; then the columns
    ``of_game``, which are the same in all lines of a game."""
    pgs = canonical_player_box(player_box, of_game).filter(X.played("pts", "min"))
    return pgs.select(
        "player_id", "player_name", "team_id", "game_id",
        *[F.col(s).cast("bigint").alias(s) for s in
          ["pts", "ast", "reb", "dreb", "oreb", "stl", "blk", "pf", "fgm", "fga", "fg3m", "fg3a", "ftm", "fta"]],
        (F.col("fgm") - F.col("fg3m")).cast("bigint").alias("fg2m"),
        (F.col("fga") - F.col("fg3a")).cast("bigint").alias("fg2a"),
        F.col("min").alias("min_str"),
        X.minutes_seconds("min").alias("minutes_sec"),
        X.ten_plus_count("pts", "reb", "ast", "stl", "blk").alias("ten_plus_count"),
        *(of_game or []),
    )


def season_latest_dates(games_canon: DataFrame) -> DataFrame:
    """Latest game date per season over all loaded games (not as of the cutoff - trap T3)."""
    return (games_canon.groupBy("season_id").agg(F.max("game_date").alias("latest_text"))
            .select("season_id", F.to_date("latest_text", "yyyy-MM-dd").alias("latest_season_game_date")))


def games_and_latest(games: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Canonical games that have an id, which player lines can meet, and the seasons' latest dates over all games.
    Rows without an id are one game, picked apart, so that both read the same exchange of the others."""
    known, unknown = (canonical_games(games.filter(c)) for c in ("game_id IS NOT NULL", "game_id IS NULL"))
    return known, season_latest_dates(known.unionByName(unknown))


def game_meta(games_canon: DataFrame, latest: DataFrame) -> DataFrame:
    """``(game_id, season_id, game_date, latest_season_game_date)`` of the games of the seasons in ``latest``."""
    g = games_canon.select("game_id", "season_id", F.to_date("game_date", "yyyy-MM-dd").alias("game_date"))
    return g.join(latest, "season_id").select("game_id", *GAME_META)


def player_games_with_meta(facts: DataFrame, games_canon: DataFrame, latest: DataFrame) -> DataFrame:
    # Season and game ride along on the games, which are fewer than the player lines.
    return facts.join(game_meta(games_canon, latest), "game_id")


def season_days(latest: DataFrame, first: Column, last: Column) -> DataFrame:
    """``(season_id, latest_season_game_date, cutoff_date)`` for every calendar day from ``first`` to ``last``."""
    return latest.select("season_id", "latest_season_game_date",
                         F.explode(F.when(last >= first, F.sequence(first, last))).alias("cutoff_date"))


def season_cutoffs(cutoffs: DataFrame, latest: DataFrame, p: Params) -> DataFrame:
    """(season, cutoff) pairs kept by the final filter: ``latest - max(365, N) <= cutoff <= latest + N``.

    Built without a cross join: each season expands to the at most ``max(365, N) + N + 1``
    calendar days of its window, then meets the cutoff dates on an equi-join. Seasons and days are
    few; the planner sees their size at run time and broadcasts them.
    """
    d = F.col("latest_season_game_date")
    days = season_days(latest, F.date_sub(d, p.lookback_days), F.date_add(d, p.recency_days))
    return days.join(cutoffs, "cutoff_date").select("season_id", "latest_season_game_date", "cutoff_date")


def season_calendar(pairs: DataFrame) -> DataFrame:
    """Per season its cutoffs in order (calendar-bounded), the first and the last of them, and for each
    day between those how many cutoffs lie before it."""
    c = pairs.groupBy("season_id").agg(F.sort_array(F.collect_set("cutoff_date")).alias("cutoffs"))
    c = c.select("season_id", "cutoffs", F.get("cutoffs", F.lit(0)).alias("first_cutoff"),
                 F.element_at("cutoffs", -1).alias("last_cutoff"))
    return c.withColumn("before", F.transform(
        F.sequence(F.lit(0), F.date_diff("last_cutoff", "first_cutoff")),
        lambda k: F.size(F.filter("cutoffs", lambda x: F.date_diff(x, "first_cutoff") < k))))


# -- aggregate forms --------------------------------------------------------------------------

def _metric_columns(sums: dict[str, Column], counts: dict[str, Column], min_sum: Column, min_n: Column,
                    tens: dict[str, Column]) -> list[Column]:
    out = []
    for m in AVG_METRICS:
        if m == "minutes":
            v = F.when(min_n > 0, min_sum.cast("double") / (min_n * F.lit(60)))
        else:
            v = F.when(counts[m] > 0, sums[m].cast("double") / counts[m])
        out.append(v.cast("double").alias(f"avg_{m}"))
    out += [tens[c].cast("bigint").alias(c) for c in COUNT_METRICS]
    return out


def _group_aggs() -> list[Column]:
    """Aggregates over game rows of one group (used by the direct/windowed forms and by the
    per-date pre-aggregation of the running form)."""
    aggs = [F.count(F.lit(1)).alias("n_games"),
            F.min("player_name").alias("player_name"),
            F.max("game_date").alias("last_date"),
            F.max("latest_season_game_date").alias("latest_season_game_date"),
            F.max_by("team_id", F.struct("game_date", "game_id")).alias("team_id"),
            F.sum("minutes_sec").alias("min_sum"), F.count("minutes_sec").alias("min_n")]
    for s in INT_STATS:
        aggs += [F.sum(s).alias(f"sum_{s}"), F.count(s).alias(f"n_{s}")]
    for c, t in COUNT_THRESHOLDS.items():
        aggs.append(F.sum(F.when(F.col("ten_plus_count") >= t, 1).otherwise(0)).alias(f"t_{c}"))
    return aggs


def _finish(grouped: DataFrame) -> DataFrame:
    sums = {s: F.col(f"sum_{s}") for s in INT_STATS}
    counts = {s: F.col(f"n_{s}") for s in INT_STATS}
    tens = {c: F.col(f"t_{c}") for c in COUNT_METRICS}
    return grouped.select(
        "cutoff_date", "season_id", "player_id", "player_name", "team_id",
        F.col("n_games").cast("bigint").alias("games_played"),
        *_metric_columns(sums, counts, F.col("min_sum"), F.col("min_n"), tens),
        F.col("last_date").alias("last_player_game_date_in_scope"),
        "latest_season_game_date",
    )


def aggregates_direct(pgm: DataFrame, cutoffs: DataFrame, latest: DataFrame, p: Params) -> DataFrame:
    """Reference form: the OR window tests every (season, cutoff) pair, the final filter drops some of them again.

    The window depends on the season alone, so each season first meets the cutoffs from a year
    before its latest date to the last one of all; no pair outside it is formed. The final filter, too,
    sees nothing but the pair: it is applied to the pairs, since the totals of a pair that it drops
    (every finished season, at every later cutoff) would be formed for nothing.
    """
    d = F.col("latest_season_game_date")
    end = cutoffs.select(F.max("cutoff_date")).scalar()
    days = season_days(latest, F.date_sub(d, max(SEASON_WINDOW_DAYS, p.recency_days)), end)
    in_window = ((F.col("cutoff_date") >= F.date_sub(d, p.recency_days))
                 | F.col("cutoff_date").between(F.date_sub(d, SEASON_WINDOW_DAYS), F.date_sub(d, 1)))
    final = d >= F.date_sub("cutoff_date", p.recency_days)
    return aggregates_windowed(pgm, days.filter(in_window).join(cutoffs, "cutoff_date").filter(final))


def scoped_player_games(pgm: DataFrame, pairs: DataFrame) -> DataFrame:
    """Game rows of each kept (cutoff, season): same season, played on or before the cutoff."""
    pairs = pairs.select(F.col("season_id").alias("p_season"), "cutoff_date")
    cond = (F.col("season_id") == F.col("p_season")) & (F.col("game_date") <= F.col("cutoff_date"))
    return pgm.join(pairs, cond).drop("p_season")


def place(day: str) -> Column:
    """How many cutoffs of a season's calendar lie before a day."""
    return (F.when(F.col(day) <= F.col("first_cutoff"), 0).when(F.col(day) > F.col("last_cutoff"), F.size("cutoffs"))
            .otherwise(F.get("before", F.date_diff(day, "first_cutoff"))))


def dealt_by_player(games: DataFrame) -> DataFrame:
    """Game rows by season and player, in as many partitions as the session sets: a player's few games become a
    row for every cutoff behind this exchange (and 20 for each of those in the long form), so its bytes, by which
    adaptive execution would put partitions together, do not tell how much work they hold."""
    n = int(games.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return games.repartition(n, "season_id", "player_id")


# Columns of ``_group_aggs`` that add up over groups.
ADDITIVE = ["n_games", "min_sum", "min_n", *[f"sum_{s}" for s in INT_STATS],
            *[f"n_{s}" for s in INT_STATS], *[f"t_{c}" for c in COUNT_METRICS]]


def aggregates_windowed(pgm: DataFrame, pairs: DataFrame) -> DataFrame:
    """Totals of each pair over the games up to its cutoff. Games of a player that the same cutoff is
    the first to see count in the same pairs: they are added up before they meet the pairs. All that follows
    stays where (season, player) was dealt, and the totals have no text among them, so that they are hashed:
    a name stands as its place among the player's names of the season."""
    calendar = F.broadcast(season_calendar(pairs))  # a row for each season
    first_seen = pgm.join(calendar, "season_id").withColumn("seen", F.get("cutoffs", place("game_date")))
    dealt = first_seen.filter("seen IS NOT NULL").drop(*[c for c in calendar.columns if c != "season_id"])
    parts = dealt_by_player(dealt).groupBy("season_id", "player_id", "seen").agg(*_group_aggs())
    w = Window.partitionBy("season_id", "player_id")
    parts = parts.withColumn("names", F.sort_array(F.collect_set("player_name").over(w)))
    parts = parts.withColumn("name", F.array_position("names", F.col("player_name"))).drop("player_name")
    of = F.broadcast(pairs.select(F.col("season_id").alias("p_season"), "cutoff_date"))  # seasons and days are few
    scoped = parts.join(of, (F.col("season_id") == F.col("p_season")) & (F.col("seen") <= F.col("cutoff_date")))
    totals = scoped.groupBy("cutoff_date", "season_id", "player_id", "names").agg(
        F.min("name").alias("name"), F.max_by("team_id", "seen").alias("team_id"), F.max("last_date").alias("last_date"),
        F.max("latest_season_game_date").alias("latest_season_game_date"), *[F.sum(c).alias(c) for c in ADDITIVE])
    return _finish(totals.withColumn("player_name", F.get("names", F.col("name").cast("int") - 1)))


def aggregates_running(pgm: DataFrame, pairs: DataFrame) -> DataFrame:
    """Rewrite R2. Valid because (game, player) is unique after dedupe and each game has one
    season, so games played = number of rows. A player's totals as of a date hold for the cutoffs
    from that date to the day before the next one: their places in the season's calendar are looked
    up by day, so only cutoffs that are hit are formed."""
    # Dealt once for the totals of a date and the window: a player has few games on a date to add up before.
    daily = dealt_by_player(pgm).groupBy("season_id", "player_id", "game_date").agg(*_group_aggs())
    # At most one row per calendar day of a season per player: the window never holds more
    # than a season's worth of dates, whatever the skew of players or teams.
    w = Window.partitionBy("season_id", "player_id").orderBy("game_date")
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = daily.select(
        "season_id", "player_id", "game_date", "team_id", "latest_season_game_date",
        F.lead("game_date").over(w).alias("next_date"),
        F.min("player_name").over(run).alias("player_name"),
        *[F.sum(c).over(run).alias(c) for c in ADDITIVE],
    ).filter("game_date IS NOT NULL")

    j = running.join(F.broadcast(season_calendar(pairs)), "season_id")  # a row for each season
    begin, end = place("game_date"), F.when(F.col("next_date").isNull(), F.size("cutoffs")).otherwise(place("next_date"))
    j = j.withColumn("cutoff_date", F.slice("cutoffs", begin + 1, end - begin))
    # All cutoffs of an interval see the same totals: the metrics are formed before the rows are.
    return _finish(j.withColumnRenamed("game_date", "last_date")).withColumn("cutoff_date", F.explode("cutoff_date"))


# -- reshaping and ranking --------------------------------------------------------------------

ID_COLS = ["cutoff_date", "season_id", "player_id", "player_name", "team_id", "games_played",
           "last_player_game_date_in_scope", "latest_season_game_date"]


def leaderboard_long(aggs: DataFrame) -> DataFrame:
    """Wide metrics -> one row per (group, metric); planned as a single Expand over one scan."""
    wide = aggs.select(*ID_COLS, *[F.col(m).cast("double").alias(m) for m in METRIC_NAMES])
    return wide.unpivot(ID_COLS, METRIC_NAMES, "metric_name", "metric_value")


def rank_metrics(long: DataFrame, k: int, one_in: int = ONE_IN) -> DataFrame:
    """Rank per (cutoff, season, metric): value desc with NULLs first (trap T1), games desc,
    player id asc; keep the first k. The planner adds a partial top-k before the shuffle.

    That partial top-k sorts all it is given, so rows that cannot be among the first k are left out before:
    the k-th of any part of a group's rows bounds the k-th of all, and a row behind it has k others
    ahead. The part is drawn by player, so that the totals of other players are not formed for it. About
    k * ``one_in`` rows of a group are left, whatever its size; a group whose part has fewer than k rows has no
    bound."""
    keys = ["cutoff_date", "season_id", "metric_name"]
    order = [F.col("metric_value").desc_nulls_first(), F.col("games_played").desc(), F.col("player_id").asc()]
    part = long.filter(F.pmod(F.xxhash64("player_id"), F.lit(one_in)) == 0)
    kth = top_k_per_group(part.select(*keys, "metric_value", "games_played", "player_id"), keys, order, k).filter(F.col("rank") == k)
    kth = kth.select(*keys, F.col("metric_value").alias("_value"), F.col("games_played").alias("_games"), F.col("player_id").alias("_player"))
    value, games, player = F.col("metric_value"), F.col("games_played"), F.col("player_id")
    tied = (games > F.col("_games")) | ((games == F.col("_games")) & (player <= F.col("_player")))
    ahead = (F.when(F.col("_value").isNull(), value.isNull() & tied)
             .otherwise(value.isNull() | (value > F.col("_value")) | ((value == F.col("_value")) & tied)))
    # At most one bound for each cutoff, season and metric.
    bounded = long.join(F.broadcast(kth), keys, "left").filter(F.col("_player").isNull() | F.coalesce(ahead, F.lit(True)))
    return top_k_per_group(bounded.select(*long.columns), keys, order, k, "rank")


# -- the model --------------------------------------------------------------------------------

@dataclass
class Inputs:
    player_box: DataFrame
    games: DataFrame
    date_status: DataFrame


def build_meta(inp: Inputs, seasons_in_play: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Facts joined to canonical game metadata, and the seasons' latest dates. With ``seasons_in_play``
    (their ids and latest dates) only games of those seasons meet the player facts (the season choice itself
    still sees every game row): player lines of other games cannot reach the output.

    A game id has one canonical game, so lines meet it before the dedupe as well as after: every version of a
    (game, player) has the same game. So all steps of a line are done where its game was dealt, and lines of games
    that are not in play are left out before the first. Seasons are few, and broadcast, so that games are not dealt
    by them."""
    games_canon, latest = games_and_latest(inp.games)
    g = game_meta(games_canon, F.broadcast(latest if seasons_in_play is None else seasons_in_play))
    facts = player_game_facts(inp.player_box.join(g, "game_id"), GAME_META)
    return facts.select("game_id", *[c for c in facts.columns if c != "game_id"]), latest


def stg_status(date_status: DataFrame) -> DataFrame:
    from .staging import stg_date_processing_status
    return stg_date_processing_status(date_status)


def player_aggregates(inp: Inputs, p: Params, form: str = "running",
                      existing: DataFrame | None = None, prune_seasons: bool = True) -> DataFrame:
    cutoffs = processed_cutoffs(stg_status(inp.date_status), p.start_date, existing)
    if form == "direct":
        pgm, latest = build_meta(inp)
        return aggregates_direct(pgm, cutoffs, latest, p)
    pairs = season_cutoffs(cutoffs, games_and_latest(inp.games)[1], p)
    # Only seasons whose snapshot window holds a cutoff can reach the output: the running form
    # prunes the game history to them before the fact join, so a daily run aggregates recent
    # seasons only (the windowed form's pair join already drops the rest).
    in_play = pairs.select("season_id", "latest_season_game_date").distinct() if prune_seasons and form == "running" else None
    pgm, _ = build_meta(inp, in_play)
    if form == "windowed":
        return aggregates_windowed(pgm, pairs)
    if form == "running":
        return aggregates_running(pgm, pairs)
    raise ValueError(f"unknown form {form!r}")


def top20_by_metric(inp: Inputs, p: Params = Params(), form: str = "running",
                    existing: DataFrame | None = None, sort_output: bool = False) -> DataFrame:
    aggs = player_aggregates(inp, p, form, existing)
    ranked = rank_metrics(leaderboard_long(aggs), p.k)
    out = ranked.filter((F.col("games_played") > 0)
                        & (F.col("latest_season_game_date") >= F.date_sub("cutoff_date", p.recency_days)))
    out = out.select(
        F.col("cutoff_date").cast("date").alias("cutoff_date"),
        F.col("season_id").cast("string").alias("season_id"),
        "metric_name",
        F.col("rank").cast("int").alias("rank"),
        "player_id", "player_name", "team_id",
        F.col("games_played").cast("int").alias("games_played"),
        F.col("metric_value").cast("double").alias("metric_value"),
        F.col("last_player_game_date_in_scope").cast("date").alias("last_player_game_date_in_scope"),
        F.col("latest_season_game_date").cast("date").alias("latest_season_game_date"),
        p.stamp().alias("updated_at"),
    )
    if sort_output:
        out = out.orderBy("cutoff_date", "season_id", "metric_name", "rank")
    return out
