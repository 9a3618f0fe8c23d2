"""SpotSigs document fingerprints (native: DataFrame functions only).

A spot is a common word (an anchor) followed by a content word; its signature is the hash of the
anchor and of a chain of two content words from there on, common words between them left out. The
fingerprint of a text is the sorted set of its signatures. Two sets are alike by their Jaccard
ratio; the ratio of their lengths bounds it from above, so pairs out of bound are pruned before
the sets are compared, and only texts of equal or adjacent length partitions can be alike.

Defined results: a null text is empty, its set and its fingerprint too, and two empty sets have
likeness 1; a text without a spot has one signature, that of its whole word sequence (without words:
of the text), so that equal texts, and no others, agree; repeated rows each get a row; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import running_totals, written
from .components import connected_components
from .ngram_join import FAR, level, links_by_prefix

# Anchors: common words of English, German, French and Spanish (fixed values).
ANCHORS = (
    "the of and to in a is that it for on with as was by be are this from or an at not have has but they you "
    "der die das und zu den ist von mit dem ein eine für auf des im nicht als auch sich es er sie wie "
    "le la les de et en un une du est que pour dans avec par sur qui pas elle il ce au "
    "el los las y por con para del se su al lo una más como pero"
).split()
LAST = (1 << 63) - 1  # the place of documents without an id
_BETWEEN = r"[\s\p{Punct}]+"


def signatures(docs: DataFrame, text: Column, out_col: str) -> DataFrame:
    """``docs`` with the sorted set of spot signatures of a text."""
    names = [c for c in docs.columns if c != out_col]
    words = docs.select(*names, text.alias("_text")).select(
        *names, "_text", F.filter(F.split(F.lower("_text"), _BETWEEN), lambda w: w != "").alias("_words"))
    marked = words.select(*names, "_text", "_words", F.filter(
        F.transform("_words", lambda w, i: F.when(w.isin(ANCHORS), F.lit(-1)).otherwise(i)),
        lambda i: i >= 0).alias("_at"))  # where the content words stand
    at = lambda k: F.get("_at", k)
    spots = F.filter(F.sequence(F.lit(0), F.size("_at") - 2),
                     lambda k: at(k) - F.coalesce(at(k - 1), F.lit(-1)) > 1)
    chain = F.transform(spots, lambda k: F.hash(
        F.get("_words", at(k) - 1), F.get("_words", at(k)), F.get("_words", at(k + 1))))
    found = marked.select(*names, "_text", "_words", F.when(F.size("_at") > 1, chain).alias("_chain"))
    whole = F.when(F.size("_words") > 0, F.hash(F.concat_ws(" ", "_words"))).otherwise(F.hash("_text"))
    return found.select(*names, F.when(F.size("_chain") > 0, F.sort_array(F.array_distinct("_chain")))
                        .when(F.length("_text") > 0, F.array(whole))
                        .otherwise(F.array().cast("array<int>")).alias(out_col))


def fingerprint(signature_set: Column) -> Column:
    """The set as text, 8 hexadecimal digits a signature."""
    return F.lower(F.array_join(F.transform(signature_set, lambda s: F.substring(F.hex(s.cast("bigint") + (1 << 32)), -8, 8)), ""))


def length_partition(size: Column, least: float) -> Column:
    """Sets whose likeness reaches ``least`` lie in the same or in adjacent partitions."""
    return F.floor(F.log(F.greatest(size, F.lit(1))) / math.log(1 / least)).cast("int")


def likeness(a: Column, b: Column, least: float = 0.0) -> Column:
    """Jaccard ratio of two sets; 0 when their lengths alone keep it under ``least``."""
    small, large = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    common = F.size(F.array_intersect(a, b))
    return (F.when(large == 0, 1.0).when(small < large * least, 0.0)
            .otherwise(common / (F.size(a) + F.size(b) - common)))


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text, n_chars, head, next_signatures``: with each document the signatures of the next one in
    descending id (after the last: the first) and its first floor(n_chars / 2) code points.

    Only ids, digests and lengths are ordered; each text then meets its place by key, and of the
    next text no more travels than is needed. Documents that share an id stand in the order of
    their texts' digests; rows that repeat both count as one there.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select((-F.col(id_col).cast("bigint")).alias("place"), text.alias("text")).select(
        F.coalesce("place", F.lit(LAST)).alias("place"), F.md5(F.col("text").cast("binary")).alias("digest"), "text")
    order = rows.groupBy("place", "digest").agg(
        F.max(F.length("text")).alias("n_chars"), F.count(F.lit(1)).alias("repeats"))
    order = written(running_totals(order, ["place", "digest"], []), "order")
    total = order.count()
    before = order.select(F.pmod(F.col("row_index") + 1, F.lit(total)).alias("row_index"),
                          F.col("place").alias("prev_place"), F.col("digest").alias("prev_digest"),
                          F.floor(F.col("n_chars") / 2).cast("int").alias("need")) if total else order.limit(0).select(
        "row_index", F.col("place").alias("prev_place"), F.col("digest").alias("prev_digest"), F.lit(0).alias("need"))
    links = written(order.join(before, "row_index").drop("row_index"), "order-links")
    placed = rows.join(links, ["place", "digest"])
    heads = placed.select("prev_place", "prev_digest", "text", "need", "repeats")
    once = heads.filter("repeats = 1").union(heads.filter("repeats > 1").dropDuplicates(["prev_place", "prev_digest"]))
    heads = signatures(once.drop("repeats"), F.col("text"), "next_signatures").select(
        F.col("prev_place").alias("place"), F.col("prev_digest").alias("digest"), "next_signatures",
        F.expr("substring(text, 1, need)").alias("head"))
    # Both sides of this join read the one exchange of the texts.
    return placed.select("place", "digest", "text", "n_chars").join(heads, ["place", "digest"]) \
        .select((-F.nullif("place", F.lit(LAST))).alias("doc_id"), "text",
                F.col("n_chars").cast("bigint").alias("n_chars"), "head", "next_signatures")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_chars, signatures, fingerprint`` of every whole text."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    found = signatures(rows.withColumn("n_chars", F.length("text").cast("bigint")), F.col("text"), "signatures")
    return found.drop("text").withColumn("fingerprint", fingerprint(F.col("signatures")))


def compare_edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text, of its edited text (the last half taken from the next document)
    and the likeness of the text to both."""
    rows = with_next(docs, id_col, text_col)
    edited = F.concat(F.expr("substring(text, 1, int(n_chars - floor(n_chars / 2)))"), F.col("head"))
    rows = rows.withColumn("edited", edited).drop("head")
    rows = signatures(signatures(rows, F.col("text"), "own").drop("text"), F.col("edited"), "changed")
    return rows.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint(F.col("own")).alias("fingerprint"), fingerprint(F.col("changed")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed")).alias("near_edited"),
        likeness(F.col("own"), F.col("next_signatures")).alias("near_next"))


def near_duplicates(docs: DataFrame, least: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_signatures, class_id``: the least id among the documents that links of likeness
    ``least`` or more join. Documents without signatures stand alone.

    Equal sets are one class. A class's rarest signatures, few enough that a class alike must hold
    one of them, are listed under its length partition and the next one; only classes that meet
    there are compared, those out of the length bound left out.
    """
    percent = round(100 * least)
    marks = fingerprints(docs, id_col, text_col).select(
        "doc_id", F.size("signatures").alias("n"), F.xxhash64("fingerprint").alias("cls"),
        F.transform("signatures", lambda s: s.cast("bigint")).alias("signatures"))
    marks = written(marks, "marks")
    sets = written(marks.filter("n > 0").select("cls", "n", "signatures").dropDuplicates(["cls"]), "mark-sets")
    listed = sets.select("cls", "n", F.explode("signatures").alias("signature"))
    counts = listed.groupBy("signature").agg(F.count(F.lit(1)).alias("c"))
    rarest = Window.partitionBy("cls").orderBy("c", "signature")  # a class's own signatures
    listed = listed.join(counts, "signature").withColumn("place", F.row_number().over(rarest)) \
        .filter(F.col("place") <= F.col("n") - F.ceil(F.lit(percent) * F.col("n") / 100) + 1)
    part = length_partition(F.col("n"), percent / 100 * 0.999)
    listed = listed.select("cls", "n", "signature", F.explode(F.array(part, part + 1)).alias("part")) \
        .select("cls", "n", F.lit(1).alias("k"), F.xxhash64("signature", "part").alias("token"))

    def verify(pairs: DataFrame, differences: bool = False) -> DataFrame:
        known = sets.select("cls", "signatures")
        both = pairs.join(known.toDF("a", "set_a"), "a").join(known.toDF("b", "set_b"), "b")
        shared = F.size(F.array_intersect("set_a", "set_b"))
        both = both.withColumns({"shared": shared, "all": F.size("set_a") + F.size("set_b") - shared})
        both = both.withColumn("level", level(
            F.col("shared"), F.col("all"), percent, lambda test, then, other: F.when(test, then).otherwise(other)))
        keep, none = (F.col("level") < FAR) & F.lit(differences), F.array().cast("array<bigint>")
        return both.select(
            "a", "b", "level", F.when(keep, F.array_except("set_b", "set_a")).otherwise(none).alias("missing"),
            F.when(keep, F.array_except("set_a", "set_b")).otherwise(none).alias("outside"))

    labels = connected_components(links_by_prefix(listed, percent, verify))
    first = marks.filter("n > 0").groupBy("cls").agg(F.min("doc_id").alias("first_id")) \
        .join(labels.select(F.col("node").alias("cls"), "label"), "cls", "left").withColumn("label", F.coalesce("label", "cls"))
    named = first.join(first.groupBy("label").agg(F.min("first_id").alias("class_id")), "label").select("cls", "class_id")
    return marks.join(named, "cls", "left").select(
        "doc_id", F.col("n").cast("bigint").alias("n_signatures"),
        F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"))
