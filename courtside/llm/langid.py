"""Language identification by Bayesian evidence fusion.

Three kinds of evidence meet in one posterior over the languages known from labelled rows:

* the text: a naive Bayes model of byte trigrams, fitted on at most ``SAMPLE`` labelled rows a
  language (chosen by hash); its log likelihood is tempered, as trigrams overlap;
* the declared (markup) language, weighed by how often each language is declared for the texts
  that read like another, counted over all rows;
* the address: a prior for the host, smoothed towards that of its address suffix, and that towards
  the corpus, from the posteriors of all rows summed by (suffix, host). A row's own share is taken out.

Defined results: a text without letters (null and empty too) is ``und`` with confidence 0; a null or
unknown declaration, host or suffix is no evidence of its own kind; ties go to the first language
by name; repeated rows are separate; without labelled rows every row is ``und``; an empty table
gives no rows; other columns pass through, those named like the results are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.joins import join_dimension
from ..operators.ranking import top_k_per_group
from .common import small_batches, uniform, written

SAMPLE = 400       # labelled rows a language that the text model is fitted on
BUCKETS = 1 << 14  # hashed byte trigrams
TEMPER = 2.0       # a text of n trigrams counts as TEMPER * sqrt(n) independent ones
STRENGTH = 20.0    # rows' worth of the wider prior in a narrower one
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def trigrams(text: str | None) -> np.ndarray:
    """Buckets of the byte trigrams of a whole text, A-Z lower-cased."""
    raw = _LOWER[np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)].astype(np.uint32)
    if len(raw) < 3:
        return np.zeros(0, np.int64)
    code = raw[:-2] << 16 | raw[1:-1] << 8 | raw[2:]
    return (code * np.uint32(2654435761) >> np.uint32(18)).astype(np.int64)


def primary(tag: Column) -> Column:
    """The primary part of a language tag, lower-cased: ``en`` of ``en-GB``."""
    return F.lower(F.regexp_extract(tag.cast("string"), r"^\s*([A-Za-z]{2,8})(?:[-_].*)?\s*$", 1))


@dataclass
class TextModel:
    """Log probabilities of the buckets in each language. Languages x BUCKETS numbers."""

    languages: list[str]
    logp: np.ndarray

    def scores(self, texts) -> np.ndarray:
        out = np.zeros((len(texts), len(self.languages)))
        for k, t in enumerate(texts):
            if len(at := trigrams(t)):
                mean = sum(self.logp[at[i:i + 65536]].sum(0) for i in range(0, len(at), 65536)) / len(at)
                out[k] = TEMPER * len(at) ** 0.5 * (mean - mean.max())
        return out


def fit_text_model(rows: DataFrame, id_col: str, text_col: str, label: Column) -> TextModel:
    """Fit on a bounded sample of labelled rows; only bucket counts reach the driver."""
    small_batches(rows.sparkSession)
    labelled = rows.select(label.alias("label"), F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter("label <> ''")
    # The numbers of rows first, so that little more than the sample travels to be ranked.
    sizes = labelled.groupBy("label").agg(F.count(F.lit(1)).alias("rows"))
    share = F.least(F.lit(1.0), F.lit(4.0 * SAMPLE) / F.col("rows"))
    drawn = join_dimension(labelled, sizes, "label").withColumn("draw", uniform("langid", F.col("id"), F.length("text"))) \
        .filter(F.col("draw") < share)
    chosen = top_k_per_group(drawn.select("label", "text", "draw"), ["label"], [F.col("draw").asc()], SAMPLE)

    def count(batches):
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                at, n = np.unique(trigrams(text), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int64()), pa.array(n, pa.int64())],
                    names=["label", "bucket", "n"])

    counts = chosen.select("label", "text").mapInArrow(count, "label string, bucket bigint, n bigint") \
        .groupBy("label", "bucket").agg(F.sum("n").alias("n"))
    # Languages x BUCKETS numbers at most.
    packed = counts.groupBy("label").agg(F.collect_list(F.struct("bucket", "n")).alias("counts")).collect()
    packed.sort(key=lambda r: r["label"])
    logp = np.zeros((BUCKETS, len(packed)), np.float32)
    for k, r in enumerate(packed):
        n = np.zeros(BUCKETS)
        at = np.array([(c["bucket"], c["n"]) for c in r["counts"]], np.int64)
        n[at[:, 0]] = at[:, 1]
        logp[:, k] = np.log((n + 0.5) / (n.sum() + 0.5 * BUCKETS))
    return TextModel([r["label"] for r in packed], logp)


def _posterior(log_odds: Column) -> Column:
    """Softmax of an array column."""
    top = F.array_max(log_odds)
    odds = F.transform(log_odds, lambda x: F.exp(x - top))
    total = F.aggregate(odds, F.lit(0.0), lambda a, x: a + x)
    return F.transform(odds, lambda x: x / total)


def _add(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x + y)


def _by_language(column: str, n: int) -> list[Column]:
    return [F.sum(F.get(column, F.lit(k))).alias(f"p{k}") for k in range(n)]


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", declared: Column | None = None,
             host: Column | None = None, suffix: Column | None = None, label: Column | None = None) -> DataFrame:
    """``docs`` with ``detected`` (a language or ``und``) and ``confidence``.

    ``declared``, ``host`` and ``suffix`` are text columns or None; ``label`` (default: the declared
    language) says which rows can teach the text model.
    """
    nothing = F.lit(None).cast("string")
    declared = primary(nothing if declared is None else declared)
    host, suffix = (nothing if c is None else c.cast("string") for c in (host, suffix))
    model = fit_text_model(docs, id_col, text_col, primary(label) if label is not None else declared)
    out = [c for c in docs.columns if c not in ("detected", "confidence")]
    if not model.languages:
        return docs.select(*out, F.lit("und").alias("detected"), F.lit(0.0).alias("confidence"))
    names, n = model.languages, len(model.languages)
    listed = F.array(*map(F.lit, names))

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def text_odds(texts: pa.Array) -> pa.Array:
        return pa.array(list(model.scores(texts.to_pylist())), pa.list_(pa.float64()))

    rows = docs.withColumns({
        "_said": F.when(declared.isin(names), declared), "_host": F.coalesce(host, F.lit("")),
        "_suffix": F.coalesce(suffix, F.lit("")), "_odds": text_odds(F.col(text_col))})
    # Counts over all rows; a row weighs one in all, whatever its length.
    read = written(rows.select("_said", "_host", "_suffix", _posterior(F.col("_odds")).alias("_read")), "langid-read")
    said = {r["_said"]: [r[f"p{k}"] or 0.0 for k in range(n)] for r in
            read.groupBy("_said").agg(*_by_language("_read", n)).collect()}  # languages + 1 rows
    rule = np.array([said.get(name, [0.0] * n) for name in names]) + 1.0 + 4.0 * np.eye(n)
    rule = np.log(rule / rule.sum(0))  # P(declared | language), a column a language
    weight = F.lit(None).cast("array<double>")
    for k, name in enumerate(names):
        weight = F.when(F.col("_said") == name, F.array(*map(F.lit, rule[k].tolist()))).otherwise(weight)
    weight = F.coalesce(weight, F.array_repeat(F.lit(0.0), n))
    hosts = read.groupBy("_suffix", "_host").agg(F.count(F.lit(1)).alias("rows"), *_by_language("_read", n))
    hosts = written(hosts, "langid-hosts")
    sums = [F.sum(f"p{k}").alias(f"p{k}") for k in range(n)]
    whole = hosts.agg(F.sum("rows").alias("rows"), *sums).first()
    if whole["rows"] is None:
        return docs.select(*out, F.lit("und").alias("detected"), F.lit(0.0).alias("confidence"))
    wide = [((whole[f"p{k}"] or 0.0) + 1.0) / (whole["rows"] + n) for k in range(n)]
    suffixes = hosts.groupBy("_suffix").agg(F.sum("rows").alias("s_rows"), *sums)
    suffixes = suffixes.select("_suffix", *[((F.col(f"p{k}") + STRENGTH * wide[k]) / (F.col("s_rows") + STRENGTH)).alias(f"s{k}")
                                            for k in range(n)])
    hosts = hosts.join(suffixes, "_suffix").select(
        "_suffix", "_host", "rows", F.array(*[F.col(f"p{k}") for k in range(n)]).alias("_counts"),
        F.array(*[F.col(f"s{k}") for k in range(n)]).alias("_wider"))
    rows = join_dimension(rows, written(hosts, "langid-priors"), ["_suffix", "_host"])
    own = F.zip_with("_counts", _posterior(F.col("_odds")), lambda c, p: F.greatest(c - p, F.lit(0.0)))
    prior = F.zip_with(own, "_wider", lambda c, w: F.log((c + STRENGTH * w) / (F.col("rows") - 1 + STRENGTH)))
    rows = rows.select(*out, "_odds", weight.alias("_weight"), prior.alias("_prior"))
    final = rows.select(*out, _posterior(_add(_add(F.col("_odds"), F.col("_weight")), F.col("_prior"))).alias("_final"))
    readable = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))
    best = F.array_max("_final")
    return final.select(
        *out, F.when(readable, F.get(listed, F.array_position("_final", best).cast("int") - 1)).otherwise("und").alias("detected"),
        F.when(readable, best).otherwise(0.0).alias("confidence"))


def page_documents(pages: DataFrame, id_col: str = "page_id") -> DataFrame:
    """Web pages as rows for ``identify``: ``doc_id, text, declared, host, suffix``."""
    bare = F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1>|<!--.*?-->", " ")
    host = F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return pages.select(
        F.col(id_col).alias("doc_id"), F.regexp_replace(bare, r"(?s)<[^>]*>", " ").alias("text"),
        F.regexp_extract("html", r"(?i)<html\b[^>]*\blang\s*=\s*[\"']?([A-Za-z-]+)", 1).alias("declared"),
        F.when(host != "", host).alias("host"), F.regexp_extract(host, r"\.([a-z0-9-]+)$", 1).alias("suffix"))
