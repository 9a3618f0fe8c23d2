"""Sharding (native): global byte-size prefix sums, cut at equal targets into contiguous shards.

Documents are put in one global order, the MD5 of their text and then their id, so that equal
texts lie next to each other. Per-range byte totals give every range its start, a window inside
the range gives each document the bytes before it, and the shard follows from where the middle of
the document falls on the line of all bytes. Shards are contiguous in that order and differ by no
more than about one document's size.

Defined results: a null text has no bytes (size 1, the separator; CRC 0); a null id sorts first
among its copies; repeated rows each take a slot; an empty table gives no rows; a document larger
than a shard can leave a shard empty; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import running_totals


def document_bytes(text: Column) -> Column:
    """UTF-8 bytes of a text and one separator."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("bigint")


def assign_shards(docs: DataFrame, n_shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, text_key, size, text_crc32, shard, slot``.

    ``slot`` counts from 0 without gaps in each shard. ``(text_key, doc_id)`` is the global order.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.md5(text.cast("binary")).alias("text_key"),
        document_bytes(F.col(text_col)).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    placed = running_totals(rows, ["text_key", "doc_id"], ["size"])
    total = placed.select(F.max(F.col("size_before") + F.col("size"))).scalar()
    placed = placed.withColumn("total", total).withColumn(
        "shard", F.least(F.lit(n_shards - 1).cast("bigint"),
                         F.expr(f"({n_shards} * (2 * size_before + size)) div (2 * total)")).cast("int"))
    firsts = placed.groupBy("shard").agg(F.min("row_index").alias("first_index"))  # n_shards rows
    return placed.join(F.broadcast(firsts), "shard").select(
        "doc_id", "text_key", "size", "text_crc32", "shard",
        (F.col("row_index") - F.col("first_index")).alias("slot"))


def write_shards(docs: DataFrame, n_shards: int, path: str, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write ``docs`` under ``path/shard=k/``. The cuts are ``n_shards`` keys, so the texts are dealt
    once, by range, without a join."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    first = F.min(F.struct("text_key", "doc_id"))
    cuts = assign_shards(docs, n_shards, id_col, text_col).groupBy("shard").agg(first.alias("first")).collect()
    key = F.struct(F.md5(text.cast("binary")).alias("text_key"), F.col(id_col).alias("doc_id"))
    kind = docs.schema[id_col].dataType
    shard = F.lit(None).cast("int")
    for cut in sorted(cuts, key=lambda r: r["shard"]):
        at = F.struct(F.lit(cut["first"]["text_key"]).alias("text_key"),
                      F.lit(cut["first"]["doc_id"]).cast(kind).alias("doc_id"))
        shard = F.when(key >= at, F.lit(cut["shard"])).otherwise(shard)
    (docs.withColumn("shard", shard).repartitionByRange("shard", key)
     .write.mode("errorifexists").partitionBy("shard").parquet(path))
