"""Shared pieces of the llm operators: written tables, distributed running totals, Arrow batch sizes."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.merge import materialize_at
from ..session import scratch_path

# Words are runs of anything but space, tab, LF, VT, FF and CR.
SPACE = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE}]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Compute ``df`` once as a parquet table in the shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor re-reads this table, and values that a recomputation could
    deal differently (partition ids of a range partitioning) stay fixed.
    """
    path = scratch_path(df.sparkSession, name)
    out = materialize_at(df.sparkSession, df, path)
    out.scratch = path
    if held := _HELD.get():
        held[-1].append(out)
    return out


_COLLECTED = [0.0]


def discard(*tables: DataFrame) -> None:
    """Delete the files of ``written`` tables that no later plan reads, and let the driver's JVM find out
    which exchanges are over, so that executors delete their files, too."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.scratch)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
    if tables and time.monotonic() - _COLLECTED[0] > 5:
        tables[0].sparkSession._jvm.System.gc()
        _COLLECTED[0] = time.monotonic()


_HELD: ContextVar[tuple[list[DataFrame], ...]] = ContextVar("held", default=())


@contextmanager
def scratch() -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Tables ``written`` inside are deleted at the end, but for those that the given function is told to keep."""
    held: list[DataFrame] = []
    token = _HELD.set((*_HELD.get(), held))
    kept: list[DataFrame] = []

    def keep(table: DataFrame) -> DataFrame:
        kept.append(table)
        return table

    try:
        yield keep
    finally:
        _HELD.reset(token)
        stay = {t.scratch for t in kept}
        discard(*[t for t in held if t.scratch not in stay])
        if outer := _HELD.get():
            outer[-1].extend(kept)


@contextmanager
def arrow_batches(spark: SparkSession, rows: int, mb: int) -> Iterator[None]:
    """Bound the rows and bytes of the Arrow batches of what is computed inside; then all is as it was."""
    names = {"spark.sql.execution.arrow.maxRecordsPerBatch": str(rows),
             "spark.sql.execution.arrow.maxBytesPerBatch": str(mb << 20)}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def small_batches(spark: SparkSession, rows: int = 256) -> None:
    """Bound the rows of an Arrow batch, so that a Python worker holds few long texts at a time."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def uniform(seed: str, *cols: Column) -> Column:
    """A number in (0, 1) that depends on ``seed`` and ``cols`` alone (nulls count as empty text)."""
    key = F.concat_ws(":", F.lit(seed), *[F.coalesce(c.cast("string"), F.lit("")) for c in cols])
    top = F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("bigint")
    return (top.cast("double") + 0.5) / float(1 << 52)


def running_totals(df: DataFrame, order: Sequence[str], values: Sequence[str],
                   group: Sequence[str] = ()) -> DataFrame:
    """Add ``row_index`` and ``<value>_before``: rows and sums of ``values`` that precede a row within
    its ``group`` in ``order``. ``group`` columns must not be null; ``values`` must not be null.

    The rows are dealt into ranges of (group, order) and written once with the number of their
    range. One sum per range and group gives each range's start, and a window inside each range
    does the rest, so no task ever holds more than one range: a hot group spans many of them.
    Rows that tie in all of ``order`` share a range in an undefined order.
    """
    group, order = list(group), list(order)
    dealt = df.repartitionByRange(*group, *order).withColumn("range_no", F.spark_partition_id())
    dealt = written(dealt, "ranges")
    sums = dealt.groupBy("range_no", *group).agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(v).alias(f"_sum_{v}") for v in values])
    past = Window.partitionBy(*group).orderBy("range_no").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(
        "range_no", *group,
        F.coalesce(F.sum("_n").over(past), F.lit(0)).alias("_start_n"),
        *[F.coalesce(F.sum(f"_sum_{v}").over(past), F.lit(0)).alias(f"_start_{v}") for v in values])
    inside = Window.partitionBy("range_no", *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.select(
        "*", F.count(F.lit(1)).over(inside).alias("_in_n"),
        *[F.coalesce(F.sum(v).over(inside), F.lit(0)).alias(f"_in_{v}") for v in values])
    # One row per range and group: at most ranges + groups rows, as ranges follow the group order.
    return placed.join(F.broadcast(starts), ["range_no", *group]).select(
        *df.columns, (F.col("_start_n") + F.col("_in_n")).alias("row_index"),
        *[(F.col(f"_start_{v}") + F.col(f"_in_{v}")).alias(f"{v}_before") for v in values])
