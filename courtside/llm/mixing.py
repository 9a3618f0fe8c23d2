"""Mixing sources to target weights by Pareto order sampling.

Every source gets a word target: its weight's share of ``rate`` times all words, at most
``max_copies`` times its own words, the excess shared out again by weight. A document's expected
copies are target / size of its source (times its relative preference, if one is given). The whole
part is certain; the rest is its inclusion probability. Documents are ranked by random odds over
inclusion odds, (U / (1 - U)) / (p / (1 - p)), and taken in that order until the source's words
are used up: a sample of fixed size in words. One more document per source, that whose size is
nearest to the words still missing, closes the gap.

Defined results: a null source is a source of its own, last in order; a null text has no words; a
document without words is never taken; repeated rows are separate documents; an empty table gives
no rows; other columns are ignored. Random numbers depend on the seed, the id and the size alone,
so reruns agree.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import join_dimension
from .common import WORD, running_totals, uniform, written


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(sizes: DataFrame, weights: Sequence[float], rate: float, max_copies: int) -> DataFrame:
    """Per source (``source_key, source, source_size, source_no``) its ``target``.

    Works on one row per source. Sources by code point (null last) weigh ``weights``, repeating.
    Sources are filled in the order of cap / weight: one is held at its cap when the level that
    the rest could reach lies above it, and the others share what is left by weight.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    n = F.row_number().over(by_name) - 1
    listed = F.array(*[F.lit(float(w)) for w in weights])
    known = (sizes.groupBy("source_key").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"))
             .withColumn("source_no", n)
             .withColumn("weight", F.element_at(listed, (F.col("source_no") % len(weights) + 1).cast("int")))
             .withColumn("cap", F.lit(max_copies) * F.col("source_size").cast("double")))
    filling = Window.orderBy(F.col("cap") / F.col("weight"), "source_no")
    everything = Window.partitionBy()
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    ahead = filling.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    budget = F.lit(rate) * F.sum("source_size").over(everything)
    level = (budget - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(ahead)
    held = known.withColumn("budget", budget).withColumn("full", F.col("cap") <= level * F.col("weight"))
    used = F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(everything), F.lit(0.0))
    open_weight = F.sum(F.when(~F.col("full"), F.col("weight"))).over(everything)
    return held.select(
        "source_key", "source", "source_size", "source_no",
        F.when(F.col("full"), F.col("cap")).otherwise(
            F.least(F.col("cap"), (F.col("budget") - used) * F.col("weight") / open_weight)).alias("target"))


def source_key(source: Column) -> Column:
    return F.when(source.isNull(), F.lit("null")).otherwise(F.concat(F.lit("="), source.cast("string")))


def place_in_source(rows: DataFrame, max_copies: int, seed: str) -> DataFrame:
    """Add what a document's own values and its source's say: the certain copies, and the place in
    its source's Pareto order, ``(rank_value, key, size)``."""
    wanted = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")
                    * F.col("preference") / F.col("mean_preference")).otherwise(0.0)
    wanted = F.least(F.lit(float(max_copies)), wanted)
    certain = F.floor(wanted).cast("bigint")
    chance = F.greatest(F.lit(1e-9), F.least(F.lit(1 - 1e-9), wanted - certain))
    u = uniform(seed, F.col("doc_id"), F.col("size"))
    return (rows.withColumn("certain", certain)
            .withColumn("rank_value", (u / (1 - u)) / (chance / (1 - chance)))
            .withColumn("offered", F.when(certain < max_copies, F.col("size")).otherwise(F.lit(0)))
            .withColumn("key", F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))


def _sizes(docs: DataFrame, id_col: str, text_col: str, source_col: str, preference: Column | None) -> dict[str, Column]:
    prefer = F.lit(1.0) if preference is None else F.coalesce(preference.cast("double"), F.lit(1.0))
    return {"doc_id": F.col(id_col), "source": F.col(source_col).cast("string"), "source_key": source_key(F.col(source_col)),
            "size": word_count(F.col(text_col)), "preference": prefer}


def _decide(sizes: DataFrame, weights: Sequence[float], rate: float, max_copies: int, seed: str):
    """The sources' targets, and every document with ``chosen`` and ``closing``."""
    spread = sizes.groupBy("source_key").agg(
        (F.sum(F.col("size") * F.col("preference")) / F.sum("size")).alias("mean_preference"))
    targets = written(source_targets(sizes, weights, rate, max_copies).join(spread, "source_key"), "mix-targets")
    # The sources of a mix: counted, and broadcast only under the helper's bound.
    known = place_in_source(join_dimension(sizes.drop("source"), targets, "source_key"), max_copies, seed)
    ranked = running_totals(known, ["rank_value", "key", "size"], ["offered"], group=["source_no"])
    left = known.groupBy("source_no").agg((F.first("target") - F.sum(F.col("certain") * F.col("size"))).alias("room"))
    ranked = join_dimension(ranked, left, "source_no")
    ranked = written(ranked.withColumn("chosen", (F.col("offered") > 0)
                                       & (F.col("offered_before") + F.col("offered") <= F.col("room"))), "mix-ranked")
    gaps = ranked.groupBy("source_no").agg(
        (F.first("room") - F.coalesce(F.sum(F.when(F.col("chosen"), F.col("size"))), F.lit(0))).alias("gap"))
    ranked = join_dimension(ranked, gaps, "source_no")
    off = F.abs(F.col("offered") - F.col("gap"))
    closing = ranked.filter(~F.col("chosen") & (F.col("offered") > 0) & (off < F.abs("gap"))).groupBy("source_no").agg(
        F.min(F.struct(off, F.col("row_index"))).getField("row_index").alias("closing_index"))
    ranked = ranked.join(F.broadcast(closing), "source_no", "left")  # at most a row per source
    return targets, ranked.withColumn("closing", F.coalesce(F.col("row_index") == F.col("closing_index"), F.lit(False)))


def mix(docs: DataFrame, weights: Sequence[float], rate: float = 1.5, max_copies: int = 2, seed: str = "mix",
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        preference: Column | None = None) -> DataFrame:
    """One row per document: ``doc_id, source, size, source_size, target, copies, taken``.

    ``preference`` (positive, null as 1) scales a document's expected copies within its source.
    """
    sizes = written(docs.select(*[c.alias(n) for n, c in _sizes(docs, id_col, text_col, source_col, preference).items()]),
                    "mix-sizes")
    _, ranked = _decide(sizes, weights, rate, max_copies, seed)
    copies = (F.col("certain") + (F.col("chosen") | F.col("closing")).cast("int")).cast("bigint")
    return ranked.select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"),
                         (copies * F.col("size")).alias("taken"))


def mix_documents(docs: DataFrame, weights: Sequence[float], rate: float = 1.5, max_copies: int = 2, seed: str = "mix",
                  id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                  preference: Column | None = None) -> DataFrame:
    """``docs`` with every row as often as the mix takes it.

    The decisions come down to one row per source, the place where its order is cut and that of the
    closing document, so the texts are neither shuffled nor joined by id.
    """
    given = _sizes(docs, id_col, text_col, source_col, preference)
    sizes = written(docs.select(*[c.alias(n) for n, c in given.items()]), "mix-sizes")
    targets, ranked = _decide(sizes, weights, rate, max_copies, seed)
    place = F.struct("rank_value", "key", "size")
    cuts = ranked.groupBy("source_key").agg(F.max(F.when(F.col("chosen"), place)).alias("cut"),
                                            F.max(F.when(F.col("closing"), place)).alias("closing"))
    rules = written(targets.join(cuts, "source_key").drop("source"), "mix-rules")
    # Kept apart from the documents' own columns, whatever their names.
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("document"),
                       *[given[n].alias(n) for n in ("doc_id", "source_key", "size", "preference")])
    rows = place_in_source(join_dimension(rows, rules, "source_key"), max_copies, seed)
    extra = (F.col("offered") > 0) & (F.coalesce(place <= F.col("cut"), F.lit(False))
                                      | F.coalesce(place == F.col("closing"), F.lit(False)))
    copies = (F.col("certain") + extra.cast("int")).cast("int")
    return rows.filter((copies > 0) & (F.col("size") > 0)).select("document", F.explode(F.sequence(F.lit(1), copies)).alias("copy_no")) \
        .select("document.*")
