"""Keyed writes on plain parquet tables: upsert, insert-ignore, update-only, keyed replace.

All are anti/semi/left joins plus ``unionByName`` producing the next version of a table;
callers write that version to a new path (a path cannot be overwritten while it is read).
``replace_in_partitions`` rewrites only the touched partitions of a stored table instead.
Plain parquet has no row-level MERGE, so none is assumed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from .dedupe import keep_preferred
from .drift import apply_policy
from .joins import cut_lineage, held_path, temporary
from .ranking import global_row_number

# ``upsert_by_parts`` merges so many bytes of stored rows at a time (an exchange holds some four times as many), in so
# many parts at most: that part of the rows is exchanged at once, whatever their number.
PART_BYTES, MOST_PARTS = 16 << 20, 8


def latest_per_key(batch: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """Collapse a batch to one row per key; the row with the greatest ``order`` wins
    (last writer wins when ``order`` is the arrival sequence)."""
    return keep_preferred(batch, keys, [order.desc()])


def keyed_replace(target: DataFrame, batch: DataFrame, keys: list[str], gone: DataFrame | None = None,
                  policy: str = "fail") -> DataFrame:
    """delete+insert: drop every target row whose key appears in the batch (or in ``gone``), then add
    the batch. A changed set of columns raises or is followed, by ``policy``."""
    target, batch = apply_policy(target, batch, policy)
    dead = batch.select(*keys) if gone is None else batch.select(*keys).unionByName(gone.select(*keys))
    return target.join(dead.distinct(), keys, "left_anti").unionByName(batch)


def month_of(date_col: str) -> Column:
    """The calendar month of a date as a partition value: a folder holds a month of rows."""
    return F.date_format(date_col, "yyyy-MM")


def replace_in_partitions(spark: SparkSession, path: str, schema: T.StructType, batch: DataFrame, keys: list[str],
                          partition_by: str, gone: DataFrame | None = None, policy: str = "fail",
                          part: Column | None = None) -> DataFrame:
    """``keyed_replace`` on the stored table at ``path``, writing only the partitions that hold a
    replaced or a new row; returns the whole table with the columns of ``batch``.

    ``part`` computes the partition of a row where the rows themselves do not hold ``partition_by``.
    A key column cannot be the partition: that would be a folder and a file per key.

    The new rows of those partitions are written to the checkpoint folder before the table is
    touched, so no read meets half-overwritten files. Partitions left without rows are removed last;
    repeating a run that was lost in between finds and removes them.
    """
    if partition_by in keys:
        raise ValueError(f"{partition_by} is a key of the table: store it by a wider range")
    names = batch.columns
    if part is not None:
        batch = batch.withColumn(partition_by, part)
    if partition_by not in schema.names:
        schema = T.StructType([*schema.fields, batch.schema[partition_by]])
    target = spark.read.schema(schema).parquet(path).select(*schema.names)
    target, batch = apply_policy(target, batch, policy)
    with temporary(spark):
        batch = cut_lineage(batch)
        dead = batch.select(*keys) if gone is None else batch.select(*keys).unionByName(gone.select(*keys))
        dead = cut_lineage(dead.distinct())
        # Partition values of one run: days or months of the calendar. As literals they prune the folders that are read.
        found = lambda df: {r[0] for r in df.select(partition_by).distinct().collect()}
        touched = found(target.join(dead, keys, "left_semi").select(partition_by).union(batch.select(partition_by)))
        here = F.col(partition_by).isin([v for v in touched if v is not None])
        kept = target.filter(here | F.col(partition_by).isNull() if None in touched else here).join(dead, keys, "left_anti")
        new = cut_lineage(kept.unionByName(batch))
        (new.hint("rebalance", partition_by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition_by).parquet(path))
        for value in touched - found(new):
            folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{partition_by}={'__HIVE_DEFAULT_PARTITION__' if value is None else value}")
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return spark.read.schema(batch.schema).parquet(path).select(*names)


def insert_ignore(target: DataFrame, rows: DataFrame, keys: list[str], order: Column | None = None) -> DataFrame:
    """Insert rows whose key is absent; existing keys are left untouched. Within ``rows`` the first
    row per key (smallest ``order``, default: of all columns) is the one inserted. A changed set of
    columns raises."""
    target, rows = apply_policy(target, rows)
    first = [order.asc()] if order is not None else [F.col(c).asc() for c in rows.columns]
    rows = keep_preferred(rows, keys, first)
    new = rows.join(target.select(*keys), keys, "left_anti")
    return target.unionByName(new.select(*target.columns))


def update_only(target: DataFrame, updates: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Set ``columns`` from ``updates`` where the key exists; absent keys are not inserted.
    ``updates`` must hold one row per key."""
    u = updates.select(*keys, *[F.col(c).alias(f"_u_{c}") for c in columns], F.lit(True).alias("_hit"))
    j = target.join(u, keys, "left")
    return j.select(*[
        (F.when(F.col("_hit"), F.col(f"_u_{c}")).otherwise(F.col(c)).cast(target.schema[c].dataType).alias(c)
         if c in columns else F.col(c))
        for c in target.columns
    ])


def upsert(target: DataFrame, batch: DataFrame, keys: list[str], id_col: str | None = "id",
           stamp: Column | None = None, policy: str = "fail") -> DataFrame:
    """Update rows whose key exists (columns present in the batch overwrite; others such as the
    surrogate id are kept), insert the rest with fresh ids after the current maximum.

    ``batch`` must hold one row per key (see ``latest_per_key``). ``stamp`` is written to
    ``updated_at`` of every batch row (one value per batch). Under policy ``fail`` a column that the
    target lacks, or of another type, raises. Target and batch are read once, in one full outer join.
    """
    if stamp is not None:
        batch = batch.withColumn("updated_at", stamp)
    own = [c for c in target.columns if c not in batch.columns]
    target, batch = apply_policy(target, _with_own(target, batch, own), policy)
    merged = _merged(target, batch, keys, own)
    if id_col is None or id_col not in own:
        return merged.select(*target.columns)
    return _with_ids(cut_lineage(merged), target.schema, keys, id_col)


def _with_own(target: DataFrame, batch: DataFrame, own: list[str]) -> DataFrame:
    return batch.select("*", *[F.lit(None).cast(target.schema[c].dataType).alias(c) for c in own])


def _merged(target: DataFrame, batch: DataFrame, keys: list[str], own: list[str]) -> DataFrame:
    """The columns of ``target`` and whether a row was in it (``_old``)."""
    given = [c for c in batch.columns if c not in keys and c not in own]
    b = batch.select(*keys, *[F.col(c).alias(f"_b_{c}") for c in given], F.lit(True).alias("_hit"))
    # The full outer join keeps rows of either side whose key holds a NULL apart.
    both = target.withColumn("_old", F.lit(True)).join(b, keys, "full_outer")
    return both.select(*[
        F.when(F.col("_hit"), F.col(f"_b_{c}")).otherwise(F.col(c)).alias(c) if c in given else F.col(c)
        for c in target.columns], F.coalesce("_old", F.lit(False)).alias("_old"))


def _with_ids(merged: DataFrame, schema: T.StructType, keys: list[str], id_col: str) -> DataFrame:
    """New rows of a stored ``_merged`` get ids. It is read by the numbering and by the result."""
    top = merged.select(F.coalesce(F.max(id_col), F.lit(0))).scalar()
    fresh = global_row_number(merged.filter(~F.col("_old")), keys, "_seq")
    fresh = fresh.withColumn(id_col, (top + F.col("_seq")).cast(schema[id_col].dataType))
    return merged.filter("_old").select(*schema.names).unionByName(fresh.select(*schema.names))


def upsert_by_parts(spark: SparkSession, target: DataFrame, batch: DataFrame, keys: list[str], order: str,
                    id_col: str | None = "id", policy: str = "fail", read: list[str] | None = None) -> DataFrame:
    """``upsert`` of the row with the greatest ``order`` (a column of the batch alone) of each key, for tables whose
    exchanges together would fill the disks: both sides are stored once in folders by hash of the key, and a part of the
    keys after the other is deduplicated and joined from them. The same rows as in one join. To be called inside
    ``temporary``, as it leaves copies there; ``read`` are paths that no one but the batch reads: deleted once it is stored.
    """
    rows = batch.drop(order)
    own = [c for c in target.columns if c not in rows.columns]
    target = apply_policy(target, _with_own(target, rows, own), policy)[0]
    held, size = [], 0
    for df, spent in ((target, []), (batch, read or [])):
        held.append((df.schema, path := held_path(spark, "by-key")))
        with temporary(spark) as gone:
            gone += spent
            part = F.pmod(F.hash(*keys), F.lit(MOST_PARTS)).alias("_part")
            df.select("*", part).write.option("compression", "zstd").partitionBy("_part").parquet(path)
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            size += folder.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(folder).getLength()
    old, new = (spark.read.schema(T.StructType([*schema.fields, T.StructField("_part", T.IntegerType())])).parquet(path)
                for schema, path in held)
    # A divisor of the parts, so that none is merged together with more of them than the others.
    times, out = min(MOST_PARTS, 1 << (size // PART_BYTES).bit_length()), held_path(spark, "merged")
    for k in range(times):
        mine = [p for p in range(MOST_PARTS) if p % times == k]
        here = F.col("_part").isin(mine)
        with temporary(spark) as gone:
            gone += [f"{path}/_part={p}" for _, path in held for p in mine] if k < times - 1 else [path for _, path in held]
            last = keep_preferred(new.filter(here).drop("_part"), keys, [F.col(order).desc()]).drop(order)
            part = _merged(old.filter(here).drop("_part"), _with_own(target, last, own), keys, own)
            part.write.mode("append").option("compression", "zstd").parquet(out)
    merged = spark.read.schema(part.schema).parquet(out)
    if id_col is None or id_col not in own:
        return merged.select(*target.columns)
    return _with_ids(merged, target.schema, keys, id_col)


def append_rows(spark: SparkSession, rows: DataFrame, path: str, schema_of: DataFrame) -> DataFrame:
    """Append ``rows`` as new files of the table at ``path`` and return the whole table."""
    _, rows = apply_policy(schema_of, rows)
    # They may be numbered from the table itself: their plan reads the files that it held when it was opened.
    rows.write.mode("append").parquet(path)
    return spark.read.schema(schema_of.schema).parquet(path)


def append_partitions(spark: SparkSession, new: DataFrame, path: str, partition_by: list[str],
                      schema_of: DataFrame) -> DataFrame:
    """Append ``new`` to the partitioned table at ``path`` (no rewrite of existing files)
    and return the whole table. A changed set of columns raises."""
    _, new = apply_policy(schema_of, new)
    new.write.mode("append").partitionBy(*partition_by).parquet(path)
    return spark.read.schema(schema_of.schema).parquet(path).select(*schema_of.columns)


def materialize(spark: SparkSession, df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as a new table version under the shared checkpoint folder and read it back.

    Cuts the lineage (a lost executor recomputes from this table, not from the sources) and
    gives the next keyed merge a stable input.
    """
    path = scratch_path(spark, name)
    return materialize_at(spark, df, path, partition_by)


def materialize_at(spark: SparkSession, df: DataFrame, path: str, partition_by: list[str] | None = None) -> DataFrame:
    # One task a partition value (large ones are split), else every task writes a file in every folder.
    w = (df.hint("rebalance", *partition_by) if partition_by else df).write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)


def rebuild(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    """K7: store ``df`` as the next version of the table at ``path`` and return it. A version is a folder of its own,
    complete before ``current`` names it, so a reader or a run lost half-way sees the one before; ``df`` may read it."""
    conf = spark._jsc.hadoopConfiguration()
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path
    folder = jvm_path(path)
    fs = folder.getFileSystem(conf)
    found = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
    version = 1 + max([int(n[1:]) for n in found if n.startswith("v")], default=0)
    out = materialize_at(spark, df, f"{path}/v{version}")
    fs.create(jvm_path(f"{path}/current-{version}"), True).close()
    # The version before stays for readers that began with it.
    for name in found:
        if name.startswith("v") and int(name[1:]) < version - 1:
            fs.delete(jvm_path(f"{path}/current-{name[1:]}"), False)
            fs.delete(jvm_path(f"{path}/{name}"), True)
    return out
