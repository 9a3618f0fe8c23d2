"""Ranking: top-k per group, and a distributed global row number for fixed-size batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .joins import cut_lineage, join_dimension


def top_k_per_group(df: DataFrame, keys: list[str], order: list[Column], k: int,
                    rank_col: str = "rank") -> DataFrame:
    """``row_number`` per group, first ``k`` kept.

    Filtering directly on the row number lets Spark insert a partial ``WindowGroupLimit``
    before the shuffle, so each map task ships at most ``k`` rows per group even when one
    group holds most of the data.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= k)


def global_row_number(df: DataFrame, order_cols: list[str], out_col: str = "row_number") -> DataFrame:
    """1-based position of each row in the total order of ``order_cols`` (must be unique).

    Distributed: a range-partitioned sort, per-partition row counts (one row per
    partition), running offsets over those counts, and a broadcast join of the offsets.
    No single task or the driver sees all rows.
    """
    sorted_df = df.sort(*order_cols).select(
        "*",
        F.spark_partition_id().alias("_pid"),
        F.monotonically_increasing_id().alias("_mid"),
    )
    # The sort must not be recomputed between the count and the numbering with a different
    # split, so it is cut once into the shared checkpoint folder (survives executor loss).
    sorted_df = cut_lineage(sorted_df)
    counts = sorted_df.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"),
                                         F.min("_mid").alias("_first"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", "_first", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_offset"))
    # One row per partition: bounded by the partition count.
    numbered = join_dimension(sorted_df, offsets, "_pid", "inner", checked=True)
    return numbered.select(
        *df.columns,
        (F.col("_offset") + (F.col("_mid") - F.col("_first")) + 1).alias(out_col),
    )


def fixed_batches(df: DataFrame, order_cols: list[str], size: int, batch_col: str = "batch_id") -> DataFrame:
    """Assign consecutive rows of the total order to batches of ``size`` rows (0-based ids)."""
    numbered = global_row_number(df, order_cols, "_rn")
    return numbered.select(*df.columns, F.floor((F.col("_rn") - 1) / F.lit(size)).cast("bigint").alias(batch_col),
                           F.col("_rn").alias("position"))
