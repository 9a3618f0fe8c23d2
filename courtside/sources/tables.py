"""Raw tables: reading stored ones with their explicit schema, scanning ids, publishing views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import schemas


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select ``schema``'s columns in order, casting present ones and null-filling the rest."""
    present = set(df.columns)
    return df.selectExpr(*[
        f"CAST({('`' + f.name + '`') if f.name in present else 'NULL'} AS {f.dataType.simpleString()}) AS `{f.name}`"
        for f in schema.fields
    ])


def read_raw(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Read a stored raw table with its declared schema (no inference)."""
    return spark.read.schema(schemas.SCHEMAS[table]).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    jp = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jp.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jp)


def distinct_game_ids(spark: SparkSession, table: DataFrame | str | None) -> DataFrame:
    """Distinct game ids of a table given as a DataFrame, a catalog table name or a parquet
    path; an empty set (not an error) when the table does not exist."""
    empty = spark.createDataFrame([], "game_id string")
    if table is None:
        return empty
    if isinstance(table, str):
        if "/" in table:
            if not path_exists(spark, table):
                return empty
            table = spark.read.parquet(table)
        elif spark.catalog.tableExists(table):
            table = spark.table(table)
        else:
            return empty
    return table.select(F.col("game_id").cast("string")).filter(F.col("game_id").isNotNull()).distinct()


def store_bucketed(df: DataFrame, name: str, key: str, path: str, buckets: int) -> DataFrame:
    """Store ``df`` as the catalog table ``name`` at ``path``, bucketed and sorted by ``key``, and read it back.

    Tables of equal ``buckets`` are joined, grouped and deduplicated by ``key`` (or by more columns that hold it)
    without an exchange: the shuffle is paid once, when a table is stored. Rows are dealt by ``key`` first, so that
    a bucket is one file; choose ``buckets`` so that this file is some hundred MB. For keys with few rows each, as a
    game's lines are: a key's rows, and all rows without a key, share one bucket.
    """
    (df.repartition(buckets, key).write.mode("errorifexists").format("parquet").option("path", path)
     .bucketBy(buckets, key).sortBy(key).saveAsTable(name))
    return df.sparkSession.table(name)


def register_views(tables: dict[str, DataFrame]) -> None:
    """K8: expose models as temporary views (``materialized='view'``)."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
