"""Column expressions: season codes, minutes text, stat flags, date coercion.

All are built-in Spark expressions (no Python UDF), so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------------------------
# Fixed values that must equal the reference's for right results.
#   Season phase digit -> name; digits whose games count as official competition;
#   expected games per phase ("found" = the number of games found for that season).
PHASE_NAMES = {
    "1": "Preseason",
    "2": "Regular Season",
    "3": "All-Star",
    "4": "Playoffs",
    "5": "Play-In",
    "6": "NBA Cup Final",
}
UNKNOWN_PHASE = "Unknown"
OFFICIAL_PHASES = ["2", "4", "5"]
EXPECTED_GAMES = {"1": "found", "2": 1230, "3": 1, "4": "found", "5": 6, "6": 1}
#   Minutes text formats: "mm:ss", "mm-ss", or a plain (decimal) number of minutes.
MINUTES_COLON = r"^\d{1,3}:\d{2}\z"
MINUTES_DASH = r"^\d{1,3}-\d{2}\z"
MINUTES_NUMBER = r"^\d+(\.\d+)?\z"
#   A box-score line with these minutes did not play.
NOT_PLAYED_MINUTES = "0:00"
#   Categories counted for doubles / double-doubles / triple-doubles, and the threshold.
TEN_PLUS_STATS = ["pts", "reb", "ast", "stl", "blk"]
TEN_PLUS_THRESHOLD = 10
#   Epoch used where a missing timestamp must sort last.
EPOCH = "1970-01-01 00:00:00"
# ---------------------------------------------------------------------------------------------

# Seconds are held exactly (a plain number of minutes may have decimals).
SECONDS_TYPE = "decimal(20,6)"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch() -> Column:
    return F.lit(EPOCH).cast("timestamp_ntz")


def season_phase(season_id: str | Column = "season_id") -> Column:
    return F.substring(col(season_id).cast("string"), 1, 1)


def season_phase_name(season_id: str | Column = "season_id") -> Column:
    phase = season_phase(season_id)
    expr = None
    for digit, name in PHASE_NAMES.items():
        expr = (F.when(phase == digit, F.lit(name)) if expr is None else expr.when(phase == digit, F.lit(name)))
    return expr.otherwise(F.lit(UNKNOWN_PHASE))


def season_start_year(season_id: str | Column = "season_id") -> Column:
    """Year after the phase digit; empty -> NULL; junk raises under ANSI, like the source DB."""
    rest = F.substring(col(season_id).cast("string"), 2, 1 << 20)
    return F.nullif(rest, F.lit("")).cast("int")


def is_official(season_id: str | Column = "season_id") -> Column:
    return season_phase(season_id).isin(*OFFICIAL_PHASES)


def expected_games(phase: str | Column, found_games: str | Column) -> Column:
    phase, found = col(phase), col(found_games)
    expr = None
    for digit, value in EXPECTED_GAMES.items():
        v = found.cast("bigint") if value == "found" else F.lit(value).cast("bigint")
        expr = F.when(phase == digit, v) if expr is None else expr.when(phase == digit, v)
    return expr.otherwise(F.lit(None).cast("bigint"))


def minutes_seconds(minutes: str | Column = "min") -> Column:
    """Minutes text -> exact seconds; NULL when the text matches none of the three formats."""
    m = col(minutes)

    def mm_ss(sep: str) -> Column:
        return (F.split_part(m, F.lit(sep), F.lit(1)).cast(SECONDS_TYPE) * 60
                + F.split_part(m, F.lit(sep), F.lit(2)).cast(SECONDS_TYPE)).cast(SECONDS_TYPE)

    return (F.when(m.rlike(MINUTES_COLON), mm_ss(":"))
            .when(m.rlike(MINUTES_DASH), mm_ss("-"))
            .when(m.rlike(MINUTES_NUMBER), (m.cast(SECONDS_TYPE) * 60).cast(SECONDS_TYPE))
            .otherwise(F.lit(None).cast(SECONDS_TYPE)))


def minutes_decimal(minutes: str | Column = "min") -> Column:
    """Minutes text -> minutes as double (34:30 -> 34.5)."""
    return minutes_seconds(minutes).cast("double") / F.lit(60.0)


def played(pts: str | Column = "pts", minutes: str | Column = "min") -> Column:
    """The player actually played: points recorded, minutes recorded and not '0:00'."""
    return col(pts).isNotNull() & col(minutes).isNotNull() & (col(minutes) != F.lit(NOT_PLAYED_MINUTES))


def ten_plus_count(*stats: str | Column) -> Column:
    """Number of categories with 10 or more; NULL stats count as 0."""
    stats = stats or tuple(TEN_PLUS_STATS)
    total = None
    for s in stats:
        term = F.when(col(s) >= TEN_PLUS_THRESHOLD, F.lit(1)).otherwise(F.lit(0))
        total = term if total is None else total + term
    return total


def coerce_date(value: str | Column, kind: str = "string") -> Column:
    """Text 'YYYY-MM-DD' (kind="string") or a date/timestamp (kind="datetime") -> date.

    Text that does not parse gives NULL instead of failing the job.
    """
    v = col(value)
    if kind == "datetime":
        return v.cast("date")
    return F.try_to_date(v.cast("string"), "yyyy-M-d")


def to_mdy(d: str | Column) -> Column:
    """Date -> 'MM/DD/YYYY' text, the request format of the game-list endpoint."""
    return F.date_format(col(d), "MM/dd/yyyy")


def raw_table_name(endpoint: str | Column, result_set: str | Column) -> Column:
    return F.concat(F.lower(col(endpoint)), F.lit("__"), F.lower(col(result_set)))


def greatest_skip_nulls(*cols: str | Column) -> Column:
    """``greatest`` ignoring NULL inputs (NULL only if all are NULL) - same rule as the source DB."""
    return F.greatest(*[col(c) for c in cols])
