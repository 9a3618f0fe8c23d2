"""Quality by an interpolated modified Kneser-Ney model of characters, trained on trusted text.

Training: the n-grams of the highest order (padded, so that every lower one is a suffix) are
counted over all trusted documents but a tenth, which is held out by hash; each lower order counts
the distinct left extensions. Discounts come from the counts of counts of each order. Probabilities
are joins of count tables, from the lowest order up: an n-gram with its context's sums and with
the probability of its suffix. The result, log probabilities of n-grams and log weights of
contexts, is written as shards by hash.

Scoring: every position of a whole text asks for its longest n-gram. Questions are split by shard
and answered a shard at a time, so a task holds ``HELD_SHARDS`` of them however large the model;
no text is shuffled. A document's perplexity is kept or rejected by its language's quantile over
the held-out trusted documents, times ``margin``.

Defined results: a null or empty text has no perplexity and is not kept; a language without held-out
documents takes the quantile over all; without trusted text nothing can be judged and every text
with characters is kept; repeated rows are separate; an empty table gives no rows.
"""

from __future__ import annotations

from collections import OrderedDict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.joins import cut_lineage, join_dimension
from ..session import scratch_path
from .common import small_batches, uniform, written

ORDER = 5
HELD_OUT = 0.1
SHARD_ROWS = 1 << 21
HELD_SHARDS = 4
COUNT_CHARS = 1 << 22  # characters whose n-grams are counted at once
BEGIN, END = "\x02", "\x03"
_MULT = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _keys(points: np.ndarray, size: int, context: bool) -> np.ndarray:
    """A hash of each window of ``size`` code points; contexts hash apart from n-grams."""
    out = np.full(len(points) - size + 1, size * 2 + context, np.uint64)
    for k in range(size):
        out = _mix(out * _MULT + points[k:len(points) - size + 1 + k])
    return out


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)


def _joined(texts: list[str], order: int) -> tuple[str, np.ndarray]:
    """Padded texts in a row, and where each one's first n-gram starts."""
    padded = [BEGIN * (order - 1) + t + END for t in texts]
    return "".join(padded), np.cumsum([0, *map(len, padded)])


def count_ngrams(texts: DataFrame, order: int = ORDER) -> DataFrame:
    """``(gram, c)``, the n-grams of the highest order of a one-column table of texts."""
    small_batches(texts.sparkSession)

    def counted(texts):
        text, bounds = _joined(texts, order)
        inside = np.ones(len(text) - order + 1, bool)
        for k in range(1, order):  # windows that span two texts
            inside[bounds[1:-1] - k] = False
        at = np.flatnonzero(inside)
        _, first, n = np.unique(_keys(_points(text), order, False)[at], return_index=True, return_counts=True)
        return pa.RecordBatch.from_arrays(
            [pa.array([text[i:i + order] for i in at[first].tolist()]), pa.array(n, pa.int64())], names=["gram", "n"])

    def run(batches):
        held, size = [], 0
        for batch in batches:
            for t in batch.column(0).to_pylist():
                if t:
                    held.append(t)
                    size += len(t)
                    if size >= COUNT_CHARS:
                        yield counted(held)
                        held, size = [], 0
        if held:
            yield counted(held)

    return texts.mapInArrow(run, "gram string, n bigint").groupBy("gram").agg(F.sum("n").alias("c"))


def discounts(counts: dict[int, int]) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts for counts of one, two, and three or more."""
    n1, n2, n3, n4 = (counts.get(k, 0) for k in (1, 2, 3, 4))
    if not (n1 and n2 and n3):
        return 0.5, 0.75, 0.9
    y = n1 / (n1 + 2 * n2)
    raw = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return tuple(min(max(d, 0.05), k - 0.05) for k, d in enumerate(raw, 1))


def probabilities(top: DataFrame, order: int = ORDER) -> tuple[DataFrame, float]:
    """``(kind, gram, value)``: log probabilities of n-grams (kind 0) and log weights of contexts
    (kind 1), and the log probability of a character never seen."""
    orders = {order: written(top, f"grams-{order}")}
    for size in range(order - 1, 0, -1):
        orders[size] = written(orders[size + 1].groupBy(F.expr(f"right(gram, {size})").alias("gram"))
                               .agg(F.count(F.lit(1)).alias("c")), f"grams-{size}")
    out, lower, unknown = [], None, 0.0
    for size in range(1, order + 1):
        grams = orders[size]
        few = grams.filter("c <= 4").groupBy("c").count().collect()  # four rows
        d1, d2, d3 = discounts({int(r["c"]): r["count"] for r in few})
        cut = F.when(F.col("c") == 1, d1).when(F.col("c") == 2, d2).otherwise(d3)
        grams = grams.withColumn("h", F.expr(f"left(gram, {size - 1})"))
        context = grams.groupBy("h").agg(F.sum("c").alias("total"), F.sum(cut).alias("freed"))
        if size == 1:
            whole = context.first()
            letters = orders[1].count() + 1
            rest = (whole["freed"] / whole["total"]) / letters
            unknown = float(np.log(rest))
            p = grams.select("gram", ((F.col("c") - cut) / whole["total"] + rest).alias("p"))
        else:
            context = written(context.withColumn("weight", F.col("freed") / F.col("total")), "contexts")
            p = grams.join(context, "h").withColumn("tail", F.expr(f"right(gram, {size - 1})")) \
                .join(lower.select(F.col("gram").alias("tail"), F.col("p").alias("q")), "tail") \
                .select("gram", ((F.col("c") - cut) / F.col("total") + F.col("weight") * F.col("q")).alias("p"))
            out.append(context.select(F.lit(1).alias("kind"), F.col("h").alias("gram"), F.log("weight").alias("value")))
        lower = written(p, f"model-{size}")
        out.append(lower.select(F.lit(0).alias("kind"), "gram", F.log("p").alias("value")))
    model = out[0]
    for part in out[1:]:
        model = model.union(part)
    return model, unknown


@dataclass
class Model:
    """Where the shards are, how many, and the log probability of an unknown character."""

    path: str
    shards: int
    unknown: float
    order: int = ORDER

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The value of each key, NaN where there is none; a shard at a time."""
        out = np.full(len(keys), np.nan, np.float32)
        shard = (keys % np.uint64(self.shards)).astype(np.int64) if self.shards > 1 else np.zeros(len(keys), np.int64)
        for k in np.unique(shard):
            mine = np.flatnonzero(shard == k) if self.shards > 1 else slice(None)
            out[mine] = _shard(self.path, int(k)).find(keys[mine])
        return out

    def log_probabilities(self, texts: list[str]) -> np.ndarray:
        """Of each text, the sum over its characters and its end."""
        text, bounds = _joined(texts, self.order)
        points = _points(text)
        ends = np.concatenate([np.arange(a + self.order - 1, b) for a, b in zip(bounds[:-1], bounds[1:], strict=True)])
        total = np.zeros(len(points))
        ask = ends
        for size in range(self.order, 0, -1):
            value = self.find(_keys(points, size, False)[ask - size + 1])
            miss = np.isnan(value)
            total[ask[~miss]] += value[~miss]
            ask = ask[miss]
            if not len(ask):
                break
            if size > 1:  # leave the order by the weight of its context, where that is known
                weight = self.find(_keys(points, size - 1, True)[ask - size + 1])
                total[ask] += np.where(np.isnan(weight), 0.0, weight)
            else:
                total[ask] += self.unknown
        return np.add.reduceat(total, bounds[:-1])

    def perplexities(self, texts: list[str | None]) -> np.ndarray:
        out = np.full(len(texts), np.nan)
        at, size = [], 0
        for k, t in enumerate([*texts, None]):
            if t:
                at.append(k)
                size += len(t)
            if at and (size >= 1 << 21 or k == len(texts)):
                log = self.log_probabilities([texts[i] for i in at])
                out[at] = np.exp(-log / (np.array([len(texts[i]) for i in at]) + 1))
                at, size = [], 0
        return out


class _Shard:
    """Sorted keys with an index by their leading bits."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.values = keys[order], values[order].astype(np.float32)
        bits = max(1, int(len(keys)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.start = np.searchsorted((self.keys >> self.shift).astype(np.int64), np.arange((1 << bits) + 1)).astype(np.int32)
        self.longest = int(np.diff(self.start).max()) if len(keys) else 0

    def find(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), np.nan, np.float32)
        lead = (keys >> self.shift).astype(np.int64)
        at, end = self.start[lead], self.start[lead + 1]
        open_ = np.flatnonzero(at < end)
        at, end, keys = at[open_], end[open_], keys[open_]
        for _ in range(self.longest):
            hit = self.keys[at] == keys
            out[open_[hit]] = self.values[at[hit]]
            go = ~hit & (at + 1 < end)
            if not go.any():
                break
            open_, at, end, keys = open_[go], at[go] + 1, end[go], keys[go]
        return out


_SHARDS: OrderedDict[tuple[str, int], _Shard] = OrderedDict()


def _shard(path: str, k: int) -> _Shard:
    """A shard's table; a worker keeps the last ``HELD_SHARDS``."""
    if (path, k) not in _SHARDS:
        import pyarrow.dataset as ds
        from pyarrow import fs

        system, root = fs.FileSystem.from_uri(path) if ":" in path else (fs.LocalFileSystem(), path)
        files = [x.path for x in system.get_file_info(fs.FileSelector(f"{root}/shard={k}", allow_not_found=True))
                 if x.path.endswith(".parquet")]
        found = ds.dataset(files, filesystem=system, format="parquet").to_table(columns=["key", "value"]) if files else None
        keys = found.column("key").to_numpy().astype(np.int64).view(np.uint64) if files else np.zeros(0, np.uint64)
        while len(_SHARDS) >= HELD_SHARDS:
            _SHARDS.popitem(last=False)
        _SHARDS[path, k] = _Shard(keys, found.column("value").to_numpy() if files else np.zeros(0))
    _SHARDS.move_to_end((path, k))
    return _SHARDS[path, k]


def train(texts: DataFrame, order: int = ORDER) -> Model | None:
    """A model of a one-column table of texts, written to the shared checkpoint folder; None without text."""
    top = written(count_ngrams(texts, order), "ngrams")
    if top.isEmpty():
        return None
    rows, unknown = probabilities(top, order)

    def key(batches):
        for batch in batches:
            kind = batch.column(0).to_numpy()
            grams = batch.column(1).to_pylist()
            size = np.array([len(g) for g in grams], np.int64)
            keys = np.zeros(len(grams), np.uint64)
            for s in np.unique(size):
                for context in (0, 1):
                    mine = np.flatnonzero((size == s) & (kind == context))
                    if len(mine):
                        points = _points("".join([grams[i] for i in mine.tolist()])).reshape(len(mine), s)
                        value = np.full(len(mine), s * 2 + context, np.uint64)
                        for j in range(s):
                            value = _mix(value * _MULT + points[:, j])
                        keys[mine] = value
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), batch.column(2)], names=["key", "value"])

    rows = cut_lineage(rows)
    shards = -(-rows.count() // SHARD_ROWS)
    path = scratch_path(texts.sparkSession, "quality-model")
    # Unsigned remainder, as the readers take it.
    shard = F.expr(f"pmod(pmod(shiftrightunsigned(key, 1), {shards}) * 2 + (key & 1), {shards})").cast("int")
    rows.mapInArrow(key, "key bigint, value double").withColumn("shard", shard) \
        .repartition(int(shards), "shard").write.partitionBy("shard").parquet(path)
    return Model(path, int(shards), unknown, order)


def score(docs: DataFrame, model: Model, text_col: str = "text", out_col: str = "perplexity") -> DataFrame:
    """``docs`` with the perplexity of every whole text, null for those without characters."""
    small_batches(docs.sparkSession)

    @F.arrow_udf(T.DoubleType())
    def perplexity(texts: pa.Array) -> pa.Array:
        return pa.array(model.perplexities(texts.to_pylist()), from_pandas=True)

    return docs.withColumn(out_col, perplexity(F.col(text_col)))


def classify(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             lang_col: str = "lang", quantile: float = 0.99, margin: float = 1.3, order: int = ORDER) -> DataFrame:
    """``doc_id, lang, perplexity, threshold, kept`` of every document; ``trusted`` holds the ids (one
    column) of trusted documents."""
    mark = trusted.select(F.col(trusted.columns[0]).alias("_id")).dropDuplicates(["_id"]).withColumn("_trusted", F.lit(True))
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    rows = join_dimension(rows, mark, "_id", "left").withColumn("_trusted", F.coalesce("_trusted", F.lit(False)))
    held = uniform("quality", F.col("_id")) < HELD_OUT
    model = train(rows.filter(F.col("_trusted") & ~held).select("text"), order)
    scored = score(rows, model) if model else rows.withColumn("perplexity", F.when(F.length("text") > 0, F.lit(1.0)))
    scored = written(scored.select("_id", "lang", "perplexity", (F.col("_trusted") & held).alias("_held")), "perplexity")
    known = scored.filter("_held AND perplexity IS NOT NULL")
    cut = F.percentile_approx("perplexity", quantile, 10000) * margin
    overall = known.agg(cut.alias("t")).first()["t"]
    limits = known.filter("lang IS NOT NULL").groupBy("lang").agg(cut.alias("threshold"))
    scored = join_dimension(scored, limits, "lang", "left")  # languages
    return scored.select(
        F.col("_id").alias("doc_id"), "lang", "perplexity",
        F.coalesce("threshold", F.lit(float("inf") if overall is None else overall)).alias("threshold")).withColumn(
        "kept", F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(False)))
