"""The daily summary (M6) from a mergeable state: exact distinct counts as bitmaps.

Games are numbered densely as they are first seen. A day's games, and those with a team box, are
bitmaps of their numbers (a row for each day and bucket of 32,768 numbers), which are merged by OR;
its last change is merged by max. A run reads the new rows, the narrow table of where games stand,
and the state of the days it touches; it rewrites those days' months only. Games and box rows are
added, never taken back: a game listed on another date counts there, too, as it does in M6 while
both rows are stored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import merge
from ..operators.joins import cut_lineage, temporary
from ..operators.ranking import global_row_number
from ..session import scratch_path

STATE = T.StructType([
    T.StructField("game_date", T.DateType()), T.StructField("bucket", T.LongType()), T.StructField("games", T.BinaryType()),
    T.StructField("boxed", T.BinaryType()), T.StructField("updated_at", T.TimestampNTZType())])
KNOWN = T.StructType([T.StructField("game_id", T.StringType()), T.StructField("number", T.LongType())])
PLACES = T.StructType([T.StructField("game_id", T.StringType()), T.StructField("game_date", T.DateType())])
NO_DATE = "0001-01-01"  # stands for a missing date, so that keys can be joined
BOXES = T.StructType([T.StructField("game_id", T.StringType()), T.StructField("box_at", T.TimestampNTZType())])


def _rows(dated: DataFrame) -> DataFrame:
    """State rows of ``(game_date, number, boxed, updated_at)``; a game without an id counts for nothing but its day."""
    number = F.col("number")
    return dated.withColumn("bucket", F.coalesce(F.bitmap_bucket_number("number"), F.lit(0))).groupBy("game_date", "bucket").agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("games"),
        F.bitmap_construct_agg(F.bitmap_bit_position(F.when(F.col("boxed"), number))).alias("boxed"),
        F.max("updated_at").alias("updated_at"))


@dataclass
class DailyState:
    spark: SparkSession
    root: str

    @classmethod
    def start(cls, spark: SparkSession, games: DataFrame, team_box: DataFrame) -> DailyState:
        state = cls(spark, scratch_path(spark, "daily-state"))
        for name, schema, parts in (("known", KNOWN, []), ("places", PLACES, []), ("boxes", BOXES, []),
                                    ("days", T.StructType([*STATE.fields, T.StructField("month", T.StringType())]), ["month"])):
            merge.materialize_at(spark, spark.createDataFrame([], schema), f"{state.root}/{name}", parts)
        state.add(games, team_box)
        return state

    def _read(self, name: str, schema: T.StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.root}/{name}")

    def _append(self, df: DataFrame, name: str, schema: T.StructType) -> None:
        merge.append_rows(self.spark, df.select(*schema.names), f"{self.root}/{name}", self._read(name, schema))

    def add(self, games: DataFrame, team_box: DataFrame) -> None:
        """Merge new rows of either input into the state."""
        with temporary(self.spark):
            known = self._read("known", KNOWN)
            listed = games.select("game_id", F.coalesce(F.col("game_date").cast("date"), F.lit(NO_DATE).cast("date")).alias("game_date"), "updated_at")
            # Several steps read either input: each is read, and box rows are added up, once.
            listed = cut_lineage(listed.distinct())
            fresh = listed.select("game_id").filter("game_id IS NOT NULL").distinct().join(known, "game_id", "left_anti")
            top = known.select(F.coalesce(F.max("number"), F.lit(0))).scalar()
            self._append(global_row_number(fresh, ["game_id"], "n").withColumn("number", top + F.col("n")), "known", KNOWN)
            # Where new games stand, and where games with a new box stood before.
            new_boxes = team_box.filter("game_id IS NOT NULL").groupBy("game_id").agg(F.max("updated_at").alias("box_at"))
            new_boxes = cut_lineage(new_boxes)
            before = self._read("places", PLACES).join(new_boxes.select("game_id"), "game_id", "left_semi") \
                .withColumn("updated_at", F.lit(None).cast("timestamp_ntz"))
            placed = listed.unionByName(before)
            boxes = self._read("boxes", BOXES).unionByName(new_boxes).join(placed.select("game_id"), "game_id", "left_semi") \
                .groupBy("game_id").agg(F.max("box_at").alias("box_at"), F.lit(True).alias("boxed"))
            dated = placed.join(self._read("known", KNOWN), "game_id", "left").join(boxes, "game_id", "left").select(
                "game_date", "number", F.coalesce("boxed", F.lit(False)).alias("boxed"), F.greatest("updated_at", "box_at").alias("updated_at"))
            delta = merge.materialize(self.spark, _rows(dated), "daily-delta")
            days = self._read("days", STATE).select(*STATE.names)
            merged = days.join(delta.select("game_date", "bucket"), ["game_date", "bucket"], "left_semi").unionByName(delta) \
                .groupBy("game_date", "bucket").agg(F.bitmap_or_agg("games").alias("games"), F.bitmap_or_agg("boxed").alias("boxed"),
                                                    F.max("updated_at").alias("updated_at"))
            merge.replace_in_partitions(self.spark, f"{self.root}/days", STATE, merged.select(*STATE.names), ["game_date", "bucket"], "month",
                                        part=merge.month_of("game_date"))
            self._append(listed.filter("game_id IS NOT NULL").select("game_id", "game_date").distinct(), "places", PLACES)
            self._append(new_boxes, "boxes", BOXES)

    def summary(self) -> DataFrame:
        """M6's rows."""
        day = F.nullif(F.col("game_date"), F.lit(NO_DATE).cast("date")).alias("game_date")
        return self._read("days", STATE).groupBy(day).agg(
            F.sum(F.bitmap_count("games")).cast("bigint").alias("games_count"),
            F.sum(F.bitmap_count("boxed")).cast("bigint").alias("boxscores_count"), F.max("updated_at").alias("updated_at"))
