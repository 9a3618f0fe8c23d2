"""Alignment of two tokenizers' tokens over whole texts, and how often their tokens meet.

A text is encoded by a byte-level BPE vocabulary (A, of a blank and the text) and by a SentencePiece
model (B, which adds the blank itself). Tokens are runs of the same bytes, so a token is known by
where it ends. The shorter of a text's two end lists drives the search in the longer one: each end
steps outwards from its proportional place, twice as far each time, until it is between two ends, and
then halves that range. All ends of a batch step together. Ends found in both lists cut the tokens
into groups, and the difference between one end's rank and the next is the range of tokens that a
token overlaps: its links.

An id pair's count is how many links of the corpus hold it. Texts are encoded once: what a text
needs later are its distinct pairs. Pairs with the highest counts (at most ``HOT_PAIRS`` of them)
are looked up inside the tasks; the others are rare and meet their counts in a join, so no hot pair
is ever a join key.

Defined results: texts that are null, empty, or whose tokens of either kind do not spell the blank
and the text (U+2581 in the text, for one) have no tokens: zeros and an empty digest. Strings of
special tokens are plain text. Repeated rows count each; an empty table gives no rows; other columns
are ignored. Texts are encoded whole; memory grows with the longest of them.
"""

from __future__ import annotations

import hashlib
import json
import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_batches, discard, written

DEFAULT_BYTE_BPE = "/opt/tokenizers/byte_bpe_50k.json"
DEFAULT_PIECES = "/opt/tokenizers/piece_bpe_32k.model"
HOT_PAIRS = 1 << 20
FLUSH = 1 << 21    # pairs that a task holds before it passes their counts on
MARK = "▁"
ID_BITS = 20       # of a token id in a pair

# Fixed value: the pre-tokenizing pattern of byte-level BPE vocabularies of this kind.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Letters, digits and blanks here are the same in every Unicode version and pattern library; texts
# with other characters are encoded by the slower library that the vocabulary file belongs to.
_PLAIN = re.compile("[\t\n\r\x20-\x7eÀ-ɏ]*")


def byte_alphabet() -> dict[str, int]:
    """The character for each byte in a byte-level vocabulary: itself if it prints, else the next from 256 on."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in prints]
    return {chr(b): b for b in prints} | {chr(256 + k): b for k, b in enumerate(others)}


class Spelling:
    """The bytes of every token id, one after the other."""

    def __init__(self, tokens: list[bytes]):
        self.size = np.array([len(t) for t in tokens], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)

    def of(self, ids: np.ndarray) -> np.ndarray:
        size = self.size[ids]
        ends = np.cumsum(size)
        return self.flat[np.repeat(self.start[ids] - (ends - size), size) + np.arange(int(ends[-1]) if len(ends) else 0)]


class Tokenizers:
    """Both encoders. Pickles as the files' contents; a worker builds them once."""

    def __init__(self, byte_bpe: str, pieces: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.files = byte_bpe, pieces
        self.slow = Tokenizer.from_str(byte_bpe)
        self.slow.encode_special_tokens = True
        model = json.loads(byte_bpe)
        alphabet = byte_alphabet()
        special = {t["content"] for t in model["added_tokens"]}
        vocabulary = {bytes(map(alphabet.__getitem__, t)): i for t, i in model["model"]["vocab"].items() if t not in special}
        kind = model["pre_tokenizer"]
        # Merges in the order of the ids they make: then the ids are the ranks.
        merges = [m if isinstance(m, str) else "".join(m) for m in model["model"]["merges"]]
        made = [model["model"]["vocab"][m.replace(" ", "")] for m in merges]
        plain = kind == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
        self.fast = None
        if plain and model["normalizer"] is None and made == sorted(made):
            self.fast = tiktoken.Encoding("byte-level", pat_str=_PATTERN, mergeable_ranks=vocabulary, special_tokens={})
        spelled = [b""] * (max(vocabulary.values()) + 1 + len(special))
        for t, i in vocabulary.items():
            spelled[i] = t
        self.a = Spelling(spelled)
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=pieces)
        spelled = []
        for i in range(self.pieces.get_piece_size()):
            piece = self.pieces.id_to_piece(i)
            spelled.append(bytes([int(piece[3:5], 16)]) if self.pieces.is_byte(i) else piece.replace(MARK, " ").encode())
        self.b = Spelling(spelled)
        if max(len(self.a.size), len(self.b.size)) >> ID_BITS:
            raise ValueError("vocabularies of a million ids and more do not fit a pair")
        digits = [str(i).encode() for i in range(max(len(self.a.size), len(self.b.size)))]
        self.digits = Spelling(digits)

    def __reduce__(self):
        return _tokenizers, self.files

    def encode_a(self, texts: list[str]) -> list[list[int]]:
        slow = [k for k, t in enumerate(texts) if self.fast is None or not _PLAIN.fullmatch(t)]
        coded = dict(zip(slow, self.slow.encode_batch([" " + texts[k] for k in slow], add_special_tokens=False), strict=True))
        return [coded[k].ids if k in coded else self.fast.encode_ordinary(" " + t) for k, t in enumerate(texts)]

    def encode(self, texts: list[str | None]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of both kinds for every text; none where one of them does not spell it."""
        none = np.zeros(0, np.int32)
        out = [none] * len(texts), [none] * len(texts)
        at = [k for k, t in enumerate(texts) if t]
        given = [texts[k] for k in at]
        coded_a, coded_b = self.encode_a(given), self.pieces.encode(given, num_threads=1) if given else []
        for k, text, a, b in zip(at, given, coded_a, coded_b, strict=True):
            a, b, data = np.array(a, np.int32), np.array(b, np.int32), b" " + text.encode()
            if self.a.of(a).tobytes() == data == self.b.of(b).tobytes():
                out[0][k], out[1][k] = a, b
        return out


_KNOWN: dict[int, Tokenizers] = {}


def _tokenizers(byte_bpe: str, pieces: bytes) -> Tokenizers:
    key = hash((byte_bpe, pieces))
    if key not in _KNOWN:
        _KNOWN[key] = Tokenizers(byte_bpe, pieces)
    return _KNOWN[key]


def load(byte_bpe: str = DEFAULT_BYTE_BPE, pieces: str = DEFAULT_PIECES) -> Tokenizers:
    """Both vocabularies, read on the driver and sent with the tasks."""
    with open(byte_bpe, encoding="utf-8") as first, open(pieces, "rb") as second:
        return _tokenizers(first.read(), second.read())


def gallop(ends: np.ndarray, wanted: np.ndarray, low: np.ndarray, high: np.ndarray, guess: np.ndarray) -> np.ndarray:
    """For each wanted number the first place in [low, high] whose end is not less; ends[high] never is.
    Steps that double from the guess on bracket it, then the bracket is halved."""
    left, right = guess.copy(), guess.copy()
    at, step = np.flatnonzero(ends[left] >= wanted), 1
    while len(at):
        right[at] = left[at]
        left[at] = np.maximum(low[at], left[at] - step)
        at = at[(ends[left[at]] >= wanted[at]) & (left[at] > low[at])]
        step *= 2
    at, step = np.flatnonzero(ends[right] < wanted), 1
    while len(at):
        left[at] = right[at] + 1
        right[at] = np.minimum(high[at], right[at] + step)
        at = at[ends[right[at]] < wanted[at]]
        step *= 2
    at = np.flatnonzero(left < right)
    while len(at):
        middle = (left[at] + right[at]) >> 1
        less = ends[middle] < wanted[at]
        left[at], right[at] = np.where(less, middle + 1, left[at]), np.where(less, right[at], middle)
        at = at[left[at] < right[at]]
    return left


class Aligned:
    """Texts whose tokens of kind ``short`` are not more than those of kind ``long``, one after the other."""

    def __init__(self, short: list[np.ndarray], long: list[np.ndarray], short_spelling: Spelling, long_spelling: Spelling):
        flat = lambda lists: np.concatenate([np.zeros(0, np.int32), *lists])
        self.n_short, self.n_long = (np.array([len(x) for x in lists], np.int64) for lists in (short, long))
        self.short, self.long = flat(short), flat(long)
        ends = np.cumsum(short_spelling.size[self.short])
        other = np.cumsum(long_spelling.size[self.long])
        self.text = np.repeat(np.arange(len(short)), self.n_short)
        start, begin = (np.cumsum(n) - n for n in (self.n_short, self.n_long))
        low, size = begin[self.text], self.n_long[self.text]
        place = np.arange(len(ends)) - start[self.text]
        guess = low + place * size // np.maximum(1, self.n_short[self.text])
        # A text's last end is in both lists, and so in the range.
        self.last = gallop(other, ends, low, low + size - 1, guess) if len(ends) else np.zeros(0, np.int64)
        self.common = other[self.last] == ends
        # A token begins where the one before ends: after that end's token, or inside it.
        self.first = np.concatenate([[0], self.last[:-1] + self.common[:-1]])[:len(ends)]

    def counts(self) -> tuple[np.ndarray, np.ndarray]:
        """Groups and links of every text."""
        n = len(self.n_short)
        links = np.bincount(self.text, self.last - self.first + 1, n).astype(np.int64)
        return np.bincount(self.text[self.common], minlength=n), links

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(text, short id, long id)`` of all pairs of tokens that overlap."""
        size = self.last - self.first + 1
        ends = np.cumsum(size)
        which = np.repeat(self.first - (ends - size), size) + np.arange(int(ends[-1]) if len(ends) else 0)
        return np.repeat(self.text, size), np.repeat(self.short, size), self.long[which]

    def spelled(self, digits: Spelling, swapped: bool) -> list[bytes]:
        """The groups of every text: ids of A, a bar, ids of B; B's tokens are the short ones if ``swapped``."""
        cut_s, cut_l = np.flatnonzero(self.common), self.last[self.common]
        group = np.arange(len(cut_s))
        in_group = lambda cut: np.repeat(group, np.diff(cut, prepend=-1))
        a, b, cut_a, cut_b = (self.long, self.short, cut_l, cut_s) if swapped else (self.short, self.long, cut_s, cut_l)
        group_a, group_b = in_group(cut_a), in_group(cut_b)
        before = np.concatenate([[0], cut_b + 1])
        at_a = np.arange(len(a)) + before[group_a]
        at_b = np.arange(len(b)) + cut_a[group_b] + 1
        ids, mark = np.empty(len(a) + len(b), np.int32), np.full(len(a) + len(b), ord(","), np.uint8)
        ids[at_a], ids[at_b] = a, b
        mark[at_a[cut_a]], mark[at_b[cut_b]] = ord("|"), ord(";")
        size = digits.size[ids]
        ends = np.cumsum(size + 1)
        out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
        out[ends - 1] = mark
        for k in range(int(size.max()) if len(size) else 0):
            at = np.flatnonzero(size > k)
            out[ends[at] - 1 - size[at] + k] = digits.flat[digits.start[ids[at]] + k]
        data = out.tobytes()
        upto = np.cumsum(self.n_short + self.n_long)
        stops = np.concatenate([[0], ends])[np.concatenate([[0], upto])]
        return [data[s:max(s, e - 1)] for s, e in zip(stops[:-1].tolist(), stops[1:].tolist(), strict=True)]


def align_batch(texts: list[str | None], both: Tokenizers) -> pa.RecordBatch:
    """Of every text ``n_a, n_b, n_groups, n_links, groups_sha256`` and its distinct pairs with how often it links them."""
    ids_a, ids_b = both.encode(texts)
    n = len(texts)
    n_a, n_b = (np.array([len(x) for x in ids], np.int64) for ids in (ids_a, ids_b))
    n_groups, n_links = np.zeros(n, np.int64), np.zeros(n, np.int64)
    digest = [""] * n
    keys = []
    for swapped in (False, True):
        at = np.flatnonzero((n_a > 0) & ((n_b < n_a) == swapped))
        mine = [ids_a[k] for k in at.tolist()], [ids_b[k] for k in at.tolist()]
        found = Aligned(mine[1], mine[0], both.b, both.a) if swapped else Aligned(*mine, both.a, both.b)
        n_groups[at], n_links[at] = found.counts()
        for k, groups in zip(at.tolist(), found.spelled(both.digits, swapped), strict=True):
            digest[k] = hashlib.sha256(groups).hexdigest()
        text, short, long = found.links()
        a, b = (long, short) if swapped else (short, long)
        keys.append(((at[text].astype(np.uint64) << np.uint64(2 * ID_BITS)) | (a.astype(np.uint64) << np.uint64(ID_BITS)) | b.astype(np.uint64)))
    keys, times = np.unique(np.concatenate(keys), return_counts=True)
    upto = np.searchsorted(keys >> np.uint64(2 * ID_BITS), np.arange(n + 1)).astype(np.int32)
    pairs = (keys & np.uint64((1 << 2 * ID_BITS) - 1)).astype(np.int64)
    return pa.RecordBatch.from_arrays(
        [*(pa.array(x, pa.int64()) for x in (n_a, n_b, n_groups, n_links)), pa.array(digest, pa.string()),
         pa.ListArray.from_arrays(pa.array(upto), pa.array(pairs, pa.int64())),
         pa.ListArray.from_arrays(pa.array(upto), pa.array(times, pa.int64()))],
        names=["n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"])


def align(docs: DataFrame, both: Tokenizers, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per row: ``doc_id, n_a, n_b, n_groups, n_links, groups_sha256, pairs, times``."""
    def run(batches):
        for batch in batches:
            found = align_batch(batch.column(1).to_pylist(), both)
            yield pa.RecordBatch.from_arrays([batch.column(0), *found.columns], names=["doc_id", *found.schema.names])

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
             "pairs array<bigint>, times array<bigint>")


def _summed(pairs: list[np.ndarray], times: list[np.ndarray]) -> pa.RecordBatch:
    keys, which = np.unique(np.concatenate(pairs), return_inverse=True)
    total = np.zeros(len(keys), np.int64)
    np.add.at(total, which, np.concatenate(times))
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(total, pa.int64())], names=["pair", "n"])


def pair_counts(aligned: DataFrame) -> DataFrame:
    """``(pair, n, best)``: how many links hold an id pair, and whether no pair of its B id has more."""
    def run(batches):
        pairs, times, held = [], [], 0
        for batch in batches:
            pairs.append(np.asarray(batch.column(0).flatten()))
            times.append(np.asarray(batch.column(1).flatten()))
            held += len(pairs[-1])
            if held >= FLUSH:
                yield _summed(pairs, times)
                pairs, times, held = [], [], 0
        if held:
            yield _summed(pairs, times)

    counts = aligned.select("pairs", "times").mapInArrow(run, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))
    counts = written(counts.withColumn("b", F.col("pair").bitwiseAND((1 << ID_BITS) - 1)), "pairs")
    most = counts.groupBy("b").agg(F.max("n").alias("most"))
    return counts.join(most, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def frequent(counts: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """Pairs of the highest counts, at most ``most`` of them, and the others. The border is a power of two."""
    level = F.floor(F.log2("n")).cast("int")
    # At most 63 rows.
    sizes = sorted(((r["level"], r["count"]) for r in counts.groupBy(level.alias("level")).count().collect()), reverse=True)
    total, border = 0, 63
    for k, size in sizes:
        total += size
        if total > most:
            break
        border = k
    return counts.filter(level >= border), counts.filter(level < border)


def cross_alignment(docs: DataFrame, both: Tokenizers | None = None, hot_pairs: int | None = None, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per row: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``."""
    spark = docs.sparkSession
    both = both or load()
    with arrow_batches(spark, 1024, 2):
        aligned = written(align(docs, both, id_col, text_col).withColumn("row_no", F.monotonically_increasing_id()), "aligned")
        counts = written(pair_counts(aligned), "pair-counts")
    hot, rare = frequent(counts, HOT_PAIRS if hot_pairs is None else hot_pairs)
    known = hot.toArrow()  # at most HOT_PAIRS rows
    keys = known["pair"].to_numpy()
    order = np.argsort(keys)
    keys, n = np.append(keys[order], np.int64(1 << 62)), np.append(known["n"].to_numpy()[order], np.int64(0))
    best = np.append(known["best"].to_numpy(zero_copy_only=False)[order], False)
    names = ["row_no", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]

    def run(batches):
        for batch in batches:
            pairs, times = np.asarray(batch.column("pairs").flatten()), np.asarray(batch.column("times").flatten())
            size = batch.column("pairs").value_lengths().to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(batch.num_rows), size)
            at = np.searchsorted(keys, pairs)
            hit = keys[at] == pairs
            total, good = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            np.add.at(total, row[hit], times[hit] * n[at[hit]])
            np.add.at(good, row[hit], times[hit] * best[at[hit]])
            upto = pa.array(np.concatenate([[0], np.cumsum(np.bincount(row[~hit], minlength=batch.num_rows))]).astype(np.int32))
            lists = [pa.ListArray.from_arrays(upto, pa.array(x[~hit], pa.int64())) for x in (pairs, times)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(good), pa.array(total), *lists],
                                             names=[*names, "n_best", "count_sum", "pairs", "times"])

    scored = aligned.select(*names, "pairs", "times").mapInArrow(
        run, "row_no bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
             "n_best bigint, count_sum bigint, pairs array<bigint>, times array<bigint>")
    with arrow_batches(spark, 1024, 2):
        scored = written(scored, "scored")
    discard(aligned)
    left = scored.select("row_no", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("row_no", "x.pairs", "x.times")
    left = left.join(rare.withColumnRenamed("pair", "pairs"), "pairs").groupBy("row_no").agg(
        F.sum(F.col("times") * F.col("n")).alias("more"), F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"))
    plus = lambda x, y: (F.col(x) + F.coalesce(y, F.lit(0))).cast("bigint").alias(x)
    return scored.drop("pairs", "times").join(left, "row_no", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", plus("n_best", "more_best"), plus("count_sum", "more"), "groups_sha256")
