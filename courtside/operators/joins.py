"""Joins against small dimension tables, broadcast only behind a size check."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

# Largest row count we agree to ship to every executor. Dimensions here are bounded by
# the calendar (dates), by season codes (phase digit x year) or by both together.
DEFAULT_MAX_BROADCAST_ROWS = 2_000_000


def cut_lineage(df: DataFrame) -> DataFrame:
    """Compute ``df`` once as a parquet table in the shared checkpoint folder; later plans read that copy, and of it no
    more columns than they need. Inside ``temporary`` the copy is deleted at the end.
    """
    path = held_path(df.sparkSession, "cut")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def held_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a copy; inside ``temporary`` it is deleted at the end."""
    path = scratch_path(spark, name)
    if (held := _HELD.get()) is not None:
        held.append(path)
    return path


_HELD: ContextVar[list[str] | None] = ContextVar("held_cuts", default=None)


@contextmanager
def temporary(spark: SparkSession) -> Iterator[list[str]]:
    """Copies that ``cut_lineage`` makes inside, and paths added to the list, are deleted at the end: all that reads them
    must have been stored by then. The driver's JVM is asked to find out which exchanges are over, so that executors
    delete their files, too."""
    held: list[str] = []
    token = _HELD.set(held)
    try:
        yield held
    finally:
        _HELD.reset(token)
        for path in held:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
        spark._jvm.System.gc()


class Dimension:
    """A small table computed once: written to the shared checkpoint folder, with its row count.

    Every later join reads the written copy, so the (possibly expensive) plan that produced
    it runs once, and its size check costs a scan of a few small files.
    """

    def __init__(self, df: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS):
        self.df = cut_lineage(df)
        self.rows = self.df.count()
        self.small = self.rows <= max_rows

    @property
    def columns(self) -> list[str]:
        return self.df.columns

    def select(self, *cols) -> "Dimension":
        """A projection keeps the row bound (no job)."""
        out = object.__new__(Dimension)
        out.df, out.rows, out.small = self.df.select(*cols), self.rows, self.small
        return out

    def distinct_bounded(self) -> "Dimension":
        """Distinct rows: at most as many as before (no job)."""
        out = object.__new__(Dimension)
        out.df, out.rows, out.small = self.df.distinct(), self.rows, self.small
        return out


def dimension(df: DataFrame | Dimension, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> Dimension:
    return df if isinstance(df, Dimension) else Dimension(df, max_rows)


def join_dimension(fact: DataFrame, dim: DataFrame | Dimension, on, how: str = "inner",
                   max_rows: int = DEFAULT_MAX_BROADCAST_ROWS, checked: bool | None = None) -> DataFrame:
    """Join ``fact`` to a small ``dim``.

    The dimension is broadcast only when its row count is checked to be at most
    ``max_rows``; beyond that the join is left to the planner (shuffle join, AQE skew
    handling). Broadcasting keeps a hot key of ``fact`` from landing in one task.
    ``checked`` lets a caller pass a bound proven elsewhere (e.g. one row per partition).
    """
    if checked is not None:
        side, small = (dim.df if isinstance(dim, Dimension) else dim), checked
    else:
        d = dimension(dim, max_rows)
        side, small = d.df, d.small
    return fact.join(F.broadcast(side) if small else side, on=on, how=how)
