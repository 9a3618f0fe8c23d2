"""Phrase collocations per language by partitioned mining (SON), with exact counts.

A phrase is two or more words that follow each other inside a piece of a text. Documents are dealt
into a few shards by id. What occurs at least ``support`` times in a language occurs in some shard at
least in proportion to the shard's share of that language's words, so:

1. Each shard is mined completely at that lowered support, level by level: its frequent words, then
   the pairs of frequent words, then longer phrases whose two shorter parts are frequent there. A
   shard is as large as its share of the corpus; it is mined by all tasks, not in one.
2. The phrases frequent in any shard are the candidates.
3. All occurrences of candidates are counted over the whole corpus, by their text.

Between the levels the frequent phrases travel as a bitmap of fixed size (``FILTER_BITS``) of their
hashes. A phrase that only shares a bit is counted too and then fails the exact support, so a full
bitmap costs time and changes no result.

A phrase's score is its lowest over all cuts into a first part and a rest: a * a / (l * r) in
millionths, floored, in exact arithmetic. A candidate goes when a longer one contains it and occurs
at least ``covered`` percent as often.

Defined results: null and empty texts hold no words; a null language is ``und``; A-Z count as a-z;
repeated rows count each; ties end with the phrase in byte order; an empty table gives no rows;
other columns are ignored. A text of any length is read whole, its hashes in blocks.
"""

from __future__ import annotations

from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import dimension, join_dimension
from ..operators.ranking import top_k_per_group
from .common import arrow_batches, discard, written

SHARDS = 4
FILTER_BITS = 27
BUFFER = 3 << 20   # bytes of text of one language and shard that are looked at together
BUFFERS = 12 << 20  # of all of them
BLOCK = 1 << 20    # bytes whose hashes are held at once
COUNT = "decimal(38,0)"

_KIND = np.zeros(256, np.uint8)
_KIND[[9, 32]] = 1
_KIND[[ord(c) for c in ".,;:!?\n\v\f\r"]] = 2
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_BASES = (0x5851F42D4C957F2D, 0xD1342543DE82EF95)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_table(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class Words:
    """The words of lower-cased texts joined by line feeds: where each begins and ends, its piece, two hashes."""

    def __init__(self, data: bytes):
        self.data = data
        kind = _KIND[np.frombuffer(data, np.uint8)]
        edge = np.flatnonzero(np.diff(np.concatenate([[False], kind == 0, [False]]).view(np.int8)))
        self.first, self.last = edge[::2], edge[1::2]
        self.piece = np.searchsorted(np.flatnonzero(kind == 2), self.first)
        self.hash = self._hashes(_BASES[0])

    def __len__(self) -> int:
        return len(self.first)

    @cached_property
    def other(self) -> np.ndarray:
        return self._hashes(_BASES[1])

    def _hashes(self, base: int) -> np.ndarray:
        """Sums of a polynomial modulo 2**64 from each word's begin to its end, moved down to its begin."""
        raw = np.frombuffer(self.data, np.uint8)
        size = min(BLOCK, max(1, len(raw)))
        powers, inverse = _power_table(base, size), _power_table(pow(base, -1, 1 << 64), size)
        sums = {"first": np.zeros(len(self), np.uint64), "last": np.zeros(len(self), np.uint64)}
        down = np.zeros(len(self), np.uint64)
        total, scale, back = 0, 1, 1
        for at in range(0, len(raw), size):
            part = raw[at:at + size]
            inside = np.concatenate([[np.uint64(0)], np.cumsum((part.astype(np.uint64) + np.uint64(1)) * powers[:len(part)],
                                                               dtype=np.uint64)])
            for name, edges in (("first", self.first), ("last", self.last)):
                a, b = np.searchsorted(edges, [at, at + len(part) + (name == "last")], "left")
                sums[name][a:b] = np.uint64(total) + inside[edges[a:b] - at] * np.uint64(scale)
                if name == "first":
                    down[a:b] = inverse[edges[a:b] - at] * np.uint64(back)
            total = (total + int(inside[-1]) * scale) & 0xFFFFFFFFFFFFFFFF
            scale = scale * pow(base, size, 1 << 64) & 0xFFFFFFFFFFFFFFFF
            back = back * pow(base, -size, 1 << 64) & 0xFFFFFFFFFFFFFFFF
        length = (self.last - self.first).astype(np.uint64)
        return _mix((sums["last"] - sums["first"]) * down + length * np.uint64(0x9E3779B97F4A7C15))

    def starts(self, size: int) -> np.ndarray:
        """The words at which a phrase of ``size`` words begins."""
        n = len(self) - size + 1
        return np.flatnonzero(self.piece[:n] == self.piece[size - 1:]) if n > 0 else np.zeros(0, np.int64)

    def keys(self, at: np.ndarray, size: int) -> np.ndarray:
        out = np.full(len(at), size, np.uint64)
        for k in range(size):
            out = _mix(out * np.uint64(0x9E3779B97F4A7C15) + self.hash[at + k])
        return out

    def numbers(self) -> np.ndarray:
        """Equal numbers for equal words (128 bits of hash), less than the number of words."""
        _, first, number = np.unique(self.hash, return_index=True, return_inverse=True)
        if (self.other[first][number] != self.other).any():
            order = np.lexsort((self.other, self.hash))
            new = np.concatenate([[False], (np.diff(self.hash[order]) != 0) | (np.diff(self.other[order]) != 0)])
            number = np.empty(len(self), np.int64)
            number[order] = np.cumsum(new)
        return number

    def phrases(self, at: np.ndarray, size: int) -> tuple[list[bytes], np.ndarray]:
        """The distinct phrases among those that begin at ``at``, and their counts."""
        if not len(at):
            return [], np.zeros(0, np.int64)
        number = self.numbers()
        key = number[at]
        for k in range(1, size):
            if k > 1:
                key = np.unique(key, return_inverse=True)[1]
            key = key * len(self) + number[at + k]
        _, which, counts = np.unique(key, return_index=True, return_counts=True)
        data, first, last = self.data, self.first, self.last
        spans = [zip(first[at[which] + k].tolist(), last[at[which] + k].tolist(), strict=True) for k in range(size)]
        return [b" ".join([data[a:b] for a, b in words]) for words in zip(*spans, strict=True)], counts


def _buffered(batches):
    """``(lang, salt, Words)`` of the texts of a task, many at a time."""
    held: dict[tuple, list[bytes]] = {}
    sizes: dict[tuple, int] = {}

    def made(key):
        sizes.pop(key)
        return *key, Words(b"\n".join(held.pop(key)))

    for batch in batches:
        for *key, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "salt", "text")), strict=True):
            key, data = tuple(key), text.encode("utf-8", "surrogatepass").translate(_LOWER)
            held.setdefault(key, []).append(data)
            sizes[key] = sizes.get(key, 0) + len(data) + 1
            if sizes[key] >= BUFFER:
                yield made(key)
        if sum(sizes.values()) >= BUFFERS:
            for key in list(held):
                yield made(key)
    for key in list(held):
        yield made(key)


def _holds(bitmap: np.ndarray, keys: np.ndarray, salt: int) -> np.ndarray:
    bits = len(bitmap).bit_length() + 2  # a power of two
    bit = (keys ^ np.uint64(salt & 0xFFFFFFFFFFFFFFFF)) >> np.uint64(64 - bits)
    return (bitmap[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 > 0


def _text(phrases: list[bytes]) -> pa.Array:
    return pa.array(phrases, pa.binary()).cast(pa.string())


def _count_level(size: int, frequent: np.ndarray | None):
    """Counts of the phrases of ``size`` words whose two shorter parts are in ``frequent``, by key."""
    def run(batches):
        for _, salt, words in _buffered(batches):
            at = words.starts(size)
            if size > 1:
                good = np.zeros(len(words) + 1, bool)
                parts = words.starts(size - 1)
                good[parts] = _holds(frequent, words.keys(parts, size - 1), salt)
                at = at[good[at] & good[at + 1]]
            keys, counts = np.unique(words.keys(at, size), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(salt, pa.int64()), len(keys)), pa.array(keys.view(np.int64)),
                                              pa.array(counts, pa.int64())], names=["salt", "key", "n"])
    return run


def _count_candidates(longest: int, candidates: np.ndarray):
    def run(batches):
        for lang, salt, words in _buffered(batches):
            for size in range(1, longest + 1):
                at = words.starts(size)
                at = at[_holds(candidates, words.keys(at, size), salt)]
                texts, counts = words.phrases(at, size)
                n = len(texts)
                yield pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(lang, pa.string()), n), pa.repeat(pa.scalar(size, pa.int32()), n),
                                                  _text(texts), pa.array(counts, pa.int64())], names=["lang", "size", "phrase", "n"])
    return run


def bitmap_of(keys: DataFrame) -> np.ndarray:
    """Bits of ``key`` under ``salt``: 2 ** FILTER_BITS of them, whatever the number of keys."""
    bit = F.shiftrightunsigned(F.col("key").bitwiseXOR(F.col("salt")), 64 - FILTER_BITS)
    rows = keys.select((bit % 32768).alias("bit"), F.shiftright(bit, 15).alias("bucket")) \
        .groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits")).toArrow()
    out = np.zeros((1 << FILTER_BITS) // 32768 * 4096, np.uint8).reshape(-1, 4096)
    for bucket, bits in zip(rows["bucket"].to_pylist(), rows["bits"].to_pylist(), strict=True):
        out[bucket] = np.frombuffer(bits, np.uint8)
    return out.reshape(-1)


def mined(docs: DataFrame, support: int, longest: int, shards: int) -> tuple[DataFrame, DataFrame]:
    """``(lang, n)``, and ``(lang, size, phrase, f)`` of the words and phrases that occur at least ``support`` times."""
    spark = docs.sparkSession
    docs = docs.filter("text IS NOT NULL").select("lang", "shard", "text")
    in_shard = docs.withColumn("salt", F.xxhash64("lang", "shard"))
    in_lang = docs.withColumn("salt", F.xxhash64("lang"))
    level, sizes, found = None, None, []
    with arrow_batches(spark, 2048, 4):
        # One row a language and shard.
        parts = written(in_shard.select("lang", "salt").distinct(), "parts")
        for size in range(1, longest + 1):
            counts = in_shard.select("lang", "salt", "text").mapInArrow(
                _count_level(size, None if level is None else bitmap_of(level)), "salt bigint, key bigint, n bigint")
            # The tasks have summed their own; a second sum before the exchange would save little.
            counts = counts.repartition("salt", "key").groupBy("salt", "key").agg(F.sum("n").alias("n"))
            if sizes is None:
                counts = written(counts, "words")
                here = counts.groupBy("salt").agg(F.sum("n").alias("n_shard")).join(parts, "salt")
                whole = written(here.groupBy("lang").agg(F.sum("n_shard").alias("n")), "sizes")
                sizes = dimension(here.join(whole.withColumnRenamed("n", "n_lang"), "lang"))
            enough = F.col("n").cast(COUNT) * F.col("n_lang").cast(COUNT) >= F.lit(support).cast(COUNT) * F.col("n_shard").cast(COUNT)
            level = written(join_dimension(counts, sizes, "salt").filter(enough).select("lang", "salt", "key"), f"frequent-{size}")
            found.append(level.select("key", F.xxhash64("lang").alias("salt")))
            if size == 1:
                discard(counts)
        candidates = found[0]
        for more in found[1:]:
            candidates = candidates.union(more)
        counts = in_lang.select("lang", "salt", "text").mapInArrow(
            _count_candidates(longest, bitmap_of(candidates)), "lang string, size int, phrase string, n bigint")
        counts = counts.groupBy("lang", "size", "phrase").agg(F.sum("n").alias("f")).filter(F.col("f") >= support)
        return whole, written(counts, "phrases")


def _joined(start: Column, size: Column) -> Column:
    return F.array_join(F.slice("words", start, size), " ")


def collocations(docs: DataFrame, support: int = 10, longest: int = 3, covered: int = 50, limit: int = 2000, shards: int = SHARDS,
                 id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The ``limit`` best phrases of each language: ``lang, rank, phrase, a, l, r, n, score``."""
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).alias("text"),
                       F.pmod(F.xxhash64(F.col(id_col)), F.lit(shards)).cast("int").alias("shard"))
    totals, counted = mined(rows, support, longest, shards)
    split = counted.filter("size > 1").withColumnRenamed("f", "a").withColumn("words", F.split("phrase", " ", -1))
    side = lambda x: counted.select("lang", F.col("phrase").alias(f"{x}_part"), F.col("f").alias(x))
    cuts = split.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1))).select(
        "lang", "phrase", "a", "k", _joined(F.lit(1), F.col("k")).alias("l_part"),
        _joined(F.col("k") + 1, F.col("size") - F.col("k")).alias("r_part"))
    cuts = cuts.join(side("l"), ["lang", "l_part"]).join(side("r"), ["lang", "r_part"])
    # 38 digits hold 1000000 * a * a for every a below 10 ** 15.
    ratio = F.expr("CAST(1000000 AS DECIMAL(7,0)) * CAST(a AS DECIMAL(15,0)) * CAST(a AS DECIMAL(15,0)) div "
                   "(CAST(l AS DECIMAL(18,0)) * CAST(r AS DECIMAL(18,0)))").cast("bigint")
    best = cuts.withColumn("score", ratio).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    inside = split.filter("size > 2").withColumn("m", F.explode(F.sequence(F.lit(2), F.col("size") - 1))) \
        .withColumn("at", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("m") + 1))) \
        .groupBy("lang", _joined(F.col("at"), F.col("m")).alias("phrase")).agg(F.max("a").alias("longer"))
    kept = best.join(inside, ["lang", "phrase"], "left").filter(
        F.col("longer").isNull() | (F.lit(100) * F.col("longer") < F.lit(covered) * F.col("a")))
    kept = kept.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    top = top_k_per_group(kept, ["lang"], [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()], limit)
    return join_dimension(top, totals, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
