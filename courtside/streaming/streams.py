"""Structured Streaming paths for the two ingest loops.

* ``api_log_stream`` (I1): new API-call log files -> staged rows -> one row per id.
* ``games_upsert_stream`` (I6): landed game-list responses -> records -> one row per
  (season_id, team_id, game_id), the last record to arrive wins.
* ``box_status_stream`` (I3): landed games and landed box scores -> a left outer join of two
  streams -> whether each game's box score has come.

The target is a table of row versions. A micro-batch adds one folder, named by the stream and the
batch, that holds the newest version of each of its keys, and touches nothing else: its cost
follows the batch, not the table, and a repeated batch rewrites its own folder with the same rows.
Readers (``current_api_log``, ``current_games``) take the newest version of each key over all
batches, so the order in which files land does not matter. ``compact`` folds the versions into one
folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import expressions as X
from ..operators import merge
from ..operators.dedupe import keep_preferred
from ..operators.ranking import global_row_number
from ..plans import backlog, staging
from ..sources import landing, schemas

GAME_KEYS = schemas.TABLE_KEYS["games"]
BATCH = T.StructField("batch", T.StringType())


def _prepare(spark: SparkSession, path: str) -> None:
    """Make the table's folder before the stream starts; an existing table is left as it is."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)


def _batch_folder(path: str, stream: str, epoch_id: int) -> str:
    return f"{path}/batch={stream}-{epoch_id:09d}"


def add_versions(batch: DataFrame, epoch_id: int, path: str, stream: str) -> None:
    """Write a micro-batch into its own folder. A repeat of the same batch replaces that folder; batches
    of other streams, or of a stream started anew, have other names."""
    batch.write.mode("overwrite").parquet(_batch_folder(path, stream, epoch_id))


def versions(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All stored versions; an empty table is no rows."""
    return spark.read.schema(T.StructType([*schema.fields, BATCH])).parquet(path)


def compact(spark: SparkSession, path: str, schema: T.StructType, keys: list[str], newest: list[Column], to: str) -> None:
    """Write the newest version of each key as the only folder of a new table at ``to``."""
    keep_preferred(versions(spark, path, schema), keys, newest).select(*schema.names) \
        .write.mode("errorifexists").parquet(f"{to}/batch=compacted")


def _start(rows: DataFrame, keys: list[str], newest: list[Column], path: str, checkpoint: str):
    _prepare(rows.sparkSession, path)

    def each(batch: DataFrame, epoch_id: int) -> None:
        # The stream's id lives in its checkpoint: the same after a restart, another with a new one.
        stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        add_versions(keep_preferred(batch, keys, newest).select(*batch.columns), epoch_id, path, stream)

    return (rows.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


# -- I1: API call log ---------------------------------------------------------------------------

EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType()),
])


def api_calls_from_events(events: DataFrame, *more: str) -> DataFrame:
    return events.select(
        *more,
        F.col("event_id").alias("id"), F.col("event_type").alias("endpoint"), F.col("ts").alias("call_time"),
        (F.col("event_type") != "error").alias("success"),
        F.when(F.col("event_type") == "error", F.col("props")).alias("error_message"))


API_LOG_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("endpoint", T.StringType()),
    T.StructField("call_time", T.TimestampNTZType()), T.StructField("call_date", T.DateType()),
    T.StructField("success", T.BooleanType()), T.StructField("error_message", T.StringType()),
    T.StructField("updated_at", T.TimestampNTZType()),
])


def _newest_call() -> list[Column]:
    """The newest stamp; rows with equal stamps differ in nothing but their text."""
    return [F.col("updated_at").desc_nulls_last(), F.struct("endpoint", "success", "error_message").desc()]


def api_log_stream(spark: SparkSession, source: str, target_path: str, checkpoint: str,
                   max_files_per_trigger: int | None = None, file_glob: str | None = None):
    """Start the I1 stream with ``availableNow`` (process what has landed, then stop).

    ``source`` is the landing folder; ``file_glob`` restricts which files in it are logs.
    """
    reader = spark.readStream.schema(EVENTS_SCHEMA)
    if file_glob:
        reader = reader.option("pathGlobFilter", file_glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    staged = staging.stg_api_call_logs(api_calls_from_events(reader.parquet(source))).select(*API_LOG_SCHEMA.names)
    return _start(staged, ["id"], _newest_call(), target_path, checkpoint)


def api_log_dedup_stream(spark: SparkSession, source: str, target_path: str, checkpoint: str, bound: str = "7 days",
                         max_files_per_trigger: int | None = None, file_glob: str | None = None):
    """Start I1 with bounded state: a call id that lands again within ``bound`` of its first landing is dropped in the
    stream (``dropDuplicatesWithinWatermark`` on the time its file landed, so no call is late because it is old) and
    rows are appended once. State holds the ids of one ``bound``; a repeat after it (once a batch has moved the watermark
    on) is a row of its own, which readers
    of ``current_api_log`` still fold."""
    reader = spark.readStream.schema(EVENTS_SCHEMA)
    if file_glob:
        reader = reader.option("pathGlobFilter", file_glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    landed = reader.parquet(source).select("*", F.col("_metadata.file_modification_time").alias("landed_at"))
    calls = api_calls_from_events(landed, "landed_at").withWatermark("landed_at", bound).dropDuplicatesWithinWatermark(["id"])
    staged = calls.select(
        "id", "endpoint", "call_time", F.col("call_time").cast("date").alias("call_date"), "success", "error_message",
        F.col("call_time").alias("updated_at"))
    _prepare(spark, target_path)

    def each(batch: DataFrame, epoch_id: int) -> None:
        add_versions(batch, epoch_id, target_path, batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId"))

    return (staged.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def appended_api_log(spark: SparkSession, path: str) -> DataFrame:
    """The rows that ``api_log_dedup_stream`` stored, as they are."""
    return versions(spark, path, API_LOG_SCHEMA).select(*API_LOG_SCHEMA.names)


def current_api_log(spark: SparkSession, path: str) -> DataFrame:
    """One row per call id, the newest version."""
    found = versions(spark, path, API_LOG_SCHEMA)
    return keep_preferred(found, ["id"], [*_newest_call(), F.col("batch").desc()]).select(*API_LOG_SCHEMA.names)


# -- I6: games upsert ---------------------------------------------------------------------------

ARRIVAL = T.StructField("arrival", T.StructType([
    T.StructField("fetched_at", T.TimestampNTZType()), T.StructField("request_key", T.StringType()),
    T.StructField("position", T.IntegerType())]))
GAME_VERSION_SCHEMA = T.StructType([*[f for f in schemas.GAMES.fields if f.name != "id"], ARRIVAL])


def last_arrival() -> list[Column]:
    return [F.col("arrival").desc_nulls_last()]


def game_records(responses: DataFrame) -> DataFrame:
    """The game rows of landed responses, with the order of their arrival."""
    split = landing.split_result_sets(responses.filter(F.col("endpoint") == landing.GAME_ENDPOINT))
    return landing.records_as_table(split, landing.GAME_RESULT_SET, "games", arrival=True).select(*GAME_VERSION_SCHEMA.names)


def games_upsert_stream(spark: SparkSession, source: str, target_path: str, checkpoint: str,
                        max_files_per_trigger: int | None = None):
    """Start the I6 stream over landed responses (parquet files with the ``LANDING`` schema)."""
    reader = spark.readStream.schema(schemas.LANDING)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return _start(game_records(reader.parquet(source)), GAME_KEYS, last_arrival(), target_path, checkpoint)


def current_games(spark: SparkSession, path: str) -> DataFrame:
    """The games table: the last record of each key to arrive, numbered by key."""
    found = keep_preferred(versions(spark, path, GAME_VERSION_SCHEMA), GAME_KEYS, last_arrival())
    return global_row_number(found.drop("arrival", "batch"), GAME_KEYS, "id").select(*schemas.GAMES.names)


# -- M12 + I6: the catch-up flow, one micro-batch into sinks that depend on each other -----------------

RESPONSE_SCHEMA = T.StructType([T.StructField("date", T.DateType()), T.StructField("failed", T.BooleanType()),
                                T.StructField("n_stored", T.LongType())])
STATUS_VERSION_SCHEMA = T.StructType([*schemas.DATE_STATUS.fields, T.StructField("seen", T.LongType())])


def catch_up_stream(spark: SparkSession, source: str, root: str, checkpoint: str, date_status: DataFrame, as_of: str,
                    max_files_per_trigger: int | None = None, committed: Callable[[str], None] = lambda sink: None):
    """Start the catch-up flow over landed game-list responses. A micro-batch writes, in this order, the game
    versions, what of each response was stored (read back from the games' folder), and the status of the dates it
    touched (from all responses stored so far). Each sink is a folder named by stream and batch, so a batch that was
    lost between sinks is repeated whole without a trace, and no date is ``processed`` before its games are stored.
    ``committed`` is told each sink's name after its folder is written."""
    reader = spark.readStream.schema(schemas.LANDING)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    for part in ("games", "responses", "status"):
        _prepare(spark, f"{root}/{part}")

    def each(batch: DataFrame, epoch_id: int) -> None:
        session = batch.sparkSession
        stream = session.sparkContext.getLocalProperty("sql.streaming.queryId")
        records = game_records(batch)
        add_versions(keep_preferred(records, GAME_KEYS, last_arrival()), epoch_id, f"{root}/games", stream)
        committed("games")
        stored = session.read.schema(GAME_VERSION_SCHEMA).parquet(_batch_folder(f"{root}/games", stream, epoch_id))
        kept = records.filter("game_id IS NOT NULL").join(stored.select(*GAME_KEYS).distinct(), GAME_KEYS, "left_semi") \
            .groupBy(F.col("arrival.request_key").alias("request_key")).agg(F.count(F.lit(1)).alias("n_stored"))
        asked = landing.payload_outcome(batch).groupBy("request_key").agg(F.max(F.col("outcome") == "error").alias("failed"))
        asked.join(kept, "request_key", "left").select(
            F.col("request_key").cast("date").alias("date"), "failed", F.coalesce("n_stored", F.lit(0)).alias("n_stored")) \
            .write.mode("overwrite").parquet(_batch_folder(f"{root}/responses", stream, epoch_id))
        committed("responses")
        touched = session.read.schema(RESPONSE_SCHEMA).parquet(_batch_folder(f"{root}/responses", stream, epoch_id)).select("date").distinct()
        seen = versions(session, f"{root}/responses", RESPONSE_SCHEMA).join(touched, "date", "left_semi").groupBy("date").agg(
            F.max("failed").alias("failed"), F.sum("n_stored").alias("n"), F.count(F.lit(1)).alias("seen"))
        outcome = F.when(F.col("failed"), F.lit("error")).when(F.col("n") == 0, F.lit("no_games")).otherwise(F.lit("processed"))
        found = backlog.date_outcomes(seen.select("date", outcome.alias("outcome")), date_status)
        status = backlog.update_status(date_status.join(touched, "date", "left_semi").select(*date_status.columns), found, as_of)
        status.join(seen.select("date", "seen"), "date").select(*STATUS_VERSION_SCHEMA.names) \
            .write.mode("overwrite").parquet(_batch_folder(f"{root}/status", stream, epoch_id))
        committed("status")

    return (reader.parquet(source).writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def current_status(spark: SparkSession, root: str, date_status: DataFrame) -> DataFrame:
    """The work queue: of each date the status that has seen the most responses, else what it was."""
    newest = keep_preferred(versions(spark, f"{root}/status", STATUS_VERSION_SCHEMA), ["date"], [F.col("seen").desc(), F.col("batch").desc()])
    names = schemas.DATE_STATUS.names
    return newest.select(*names).unionByName(date_status.select(*names).join(newest.select("date"), "date", "left_anti").select(*names))


# -- I3: box status, a join of two streams --------------------------------------------------------------

_LANDED = [T.StructField("updated_at", T.TimestampNTZType()), T.StructField("landed_at", T.TimestampType()),
           T.StructField("clock", T.BooleanType())]
GAMES_LANDED = T.StructType([T.StructField("game_id", T.StringType()), T.StructField("game_date", T.StringType()), *_LANDED])
BOXES_LANDED = T.StructType([T.StructField("game_id", T.StringType()), *_LANDED])
BOX_SEEN_SCHEMA = T.StructType([
    T.StructField("game_date", T.DateType()), T.StructField("game_id", T.StringType()), T.StructField("seen", T.TimestampNTZType()),
    T.StructField("loaded", T.BooleanType()), T.StructField("box_at", T.TimestampNTZType())])


def box_status_stream(spark: SparkSession, games_source: str, box_source: str, target_path: str, checkpoint: str,
                      bound: str = "30 days", lateness: str = "1 hour", max_files_per_trigger: int | None = None):
    """Start I3 over landed games and landed team boxes (parquet files with ``GAMES_LANDED`` and ``BOXES_LANDED``).

    Event time is the time a row landed (its file's, where it has none). A game meets the boxes that land within
    ``bound`` before or after it; a game whose ``bound`` has passed on both inputs without one is stored as not
    loaded. State holds the rows of one ``bound`` on either side, and of each version one row within ``lateness``.
    A ``clock`` row carries no data and moves its input's watermark on, so that quiet inputs let games expire.

    Defined results: a box that lands later than ``bound`` after its game leaves the game as not loaded, unless the
    game itself lands again; a row stamped more than ``lateness`` behind the slower input's newest one is dropped.
    ``incremental.gbs_affected_keys`` brings in both. A game without an id has no box.
    """
    reach = F.expr(f"INTERVAL {bound}")

    def landed(source: str, schema: T.StructType, version: list[str]) -> DataFrame:
        reader = spark.readStream.schema(schema)
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        rows = reader.parquet(source).withColumn("landed_at", F.coalesce("landed_at", F.col("_metadata.file_modification_time")))
        # The test names the event time, or it would be pushed below the watermark and hide the clock rows from it.
        never = F.col("landed_at") < F.lit("0001-01-01 00:00:00").cast("timestamp")
        data = ~F.coalesce("clock", F.lit(False)) | never
        return rows.withWatermark("landed_at", lateness).filter(data).dropDuplicatesWithinWatermark(version)

    games = landed(games_source, GAMES_LANDED, ["game_id", "game_date", "updated_at"]).select(
        F.col("game_date").cast("date").alias("game_date"), "game_id", F.col("updated_at").alias("seen"), "landed_at")
    boxes = landed(box_source, BOXES_LANDED, ["game_id", "updated_at"]).select(
        F.col("game_id").alias("box_game"), F.col("updated_at").alias("box_at"), F.col("landed_at").alias("box_landed"))
    near = (F.col("box_landed") >= F.col("landed_at") - reach) & (F.col("box_landed") <= F.col("landed_at") + reach)
    joined = games.join(boxes, (F.col("game_id") == F.col("box_game")) & near, "leftOuter")
    seen = joined.select("game_date", "game_id", "seen", F.col("box_game").isNotNull().alias("loaded"), "box_at")
    _prepare(spark, target_path)

    def each(batch: DataFrame, epoch_id: int) -> None:
        add_versions(batch, epoch_id, target_path, batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId"))

    return (seen.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def current_box_status(spark: SparkSession, path: str, date_status: DataFrame) -> DataFrame:
    """M5 with the newest stamp of each game: of what the stream stored, a box that came beats that none had come."""
    game = Window.partitionBy("game_date", "game_id")
    found = versions(spark, path, BOX_SEEN_SCHEMA).groupBy("game_date", "game_id", "loaded", "box_at").agg(F.max("seen").alias("seen"))
    found = found.withColumns({"seen": F.max("seen").over(game), "_any": F.max("loaded").over(game)}).filter("loaded = _any")
    checked = date_status.select(F.col("date").alias("game_date"), "retry_count", "last_checked")
    return found.join(checked, "game_date", "left").select(
        "game_date", "game_id", F.col("loaded").alias("has_boxscore"), F.coalesce("retry_count", F.lit(0)).cast("int").alias("retry_count"),
        X.greatest_skip_nulls("seen", "box_at", "last_checked").alias("updated_at"))


def upsert_landed(target: DataFrame, responses: DataFrame) -> DataFrame:
    """Batch form of the upsert: the last record of each key to arrive, merged into ``target``."""
    batch = keep_preferred(game_records(responses), GAME_KEYS, last_arrival()).drop("arrival")
    return merge.upsert(target, batch, GAME_KEYS)


def run_to_end(query) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
