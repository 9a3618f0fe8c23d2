"""SentencePiece encoding and decoding by batched Viterbi search in numpy.

The vocabulary of a public model is a set of pieces with scores. A text is normalised as the model
says (spaces become U+2581, one is put in front) and cut before each run of U+2581 that follows
another character: no piece crosses such a cut, so the best segmentation of a text is that of its
words. Distinct words of a batch are grouped by length and advance together, one code point a step:
rolling hashes of all substrings of a length are looked up among the sorted keys of the pieces of
that length, and vectorised maxima over the piece lengths store backpointers. The path with the
largest sum of scores wins, on ties that whose last piece is longer. Characters without a piece, and
U+2581 itself, become byte pieces, so decoding gives back every text exactly. A word longer than
``LONG`` advances alone, a window after the other; the scores of the last ``longest`` places are all
that the next window needs.

Defined results: a null or empty text has no ids; decoding no ids gives an empty text; a null list
decodes to an empty text; repeated rows are independent; other columns pass through.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import small_batches

DEFAULT_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
_CHUNK = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
_BASE = np.uint64(0x9E3779B97F4A7C15)
_PLACE = "\ud800"  # stands for U+2581 in a text; no text holds a lone surrogate
LONG = 2048      # code points; longer words are cut into windows
_ROW = 256       # code points of a window that are hashed in a row
_SLAB = 1 << 18  # code points whose hashes are held at once
_MEMO = 1 << 22  # ids remembered between batches; more only cost time


def _padded(values: np.ndarray, n: int) -> list[int]:
    return values.tolist() + [0] * (n - len(values))


class Vocabulary:
    """Pieces of a model as sorted substring hashes per length. Pickles as its pieces and scores."""

    def __init__(self, pieces: Sequence[str], scores: Sequence[float], plain: Sequence[bool], byte_ids: Sequence[int]):
        self.pieces, self.scores, self.plain, self.byte_ids = list(pieces), list(scores), list(plain), list(byte_ids)
        self.keys: dict[int, np.ndarray] = {}
        self.ids: dict[int, np.ndarray] = {}
        by_size: dict[int, list[int]] = {}
        for i, piece in enumerate(self.pieces):
            if self.plain[i]:
                by_size.setdefault(len(piece), []).append(i)
        self.longest = max(by_size)
        self.power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(self.longest, _BASE)]), dtype=np.uint64)
        for size, ids in by_size.items():
            points = np.frombuffer("".join(self.pieces[i] for i in ids).encode("utf-32-le"), np.uint32)
            keys = self._hashes(points.reshape(len(ids), size))[:, size]
            order = np.argsort(keys)
            self.keys[size], self.ids[size] = keys[order], np.array(ids, np.int32)[order]
            if len(np.unique(keys)) < len(keys):
                raise ValueError("two pieces share a hash")
        # The top 16 bits of a key tell most substrings that are no piece.
        self.seen = {size: np.bincount((k >> np.uint64(48)).astype(np.int64), minlength=1 << 16) > 0
                     for size, k in self.keys.items()}
        self.score = np.array(self.scores, np.float64)
        self.unknown = min(s for s, p in zip(self.scores, self.plain, strict=True) if p) - 10.0
        self.is_byte = np.zeros(len(self.pieces), bool)
        self.is_byte[self.byte_ids] = True
        self.byte_of = np.zeros(len(self.pieces), np.uint8)
        self.byte_of[self.byte_ids] = np.arange(256)
        self.is_high = self.is_byte & (self.byte_of > 127)  # the others are a character each
        self.texts = [chr(self.byte_of[i]) if self.is_byte[i] else p.replace(MARK, " ") for i, p in enumerate(self.pieces)]
        self.forget()

    def __reduce__(self):
        return _vocabulary, (self.pieces, self.scores, self.plain, self.byte_ids)

    def forget(self) -> None:
        self.memo: dict[str, int] = {}
        self.flat, self.start, self.size = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _hashes(self, points: np.ndarray) -> np.ndarray:
        """Rolling hashes of the prefixes of each row."""
        out = np.zeros((points.shape[0], points.shape[1] + 1), np.uint64)
        for j in range(points.shape[1]):
            out[:, j + 1] = out[:, j] * _BASE + (points[:, j].astype(np.uint64) + np.uint64(0x51ED2701))
        return out

    def _matches(self, hashes: np.ndarray, size: int) -> np.ndarray:
        """The piece, or -1, at each start of a substring of ``size`` code points."""
        sub = hashes[:, size:] - hashes[:, :-size] * self.power[size]
        found = np.full(sub.shape, -1, np.int32)
        rows, cols = np.nonzero(self.seen[size][(sub >> np.uint64(48)).astype(np.int64)])
        wanted, keys = sub[rows, cols], self.keys[size]
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        hit = keys[at] == wanted
        found[rows[hit], cols[hit]] = self.ids[size][at[hit]]
        return found

    def _slab(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words of one length, which advance together: all in a row, and how many each has."""
        n, length = len(words), len(words[0])
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(n, length)
        hashes = self._hashes(points)
        sizes = [s for s in sorted(self.keys, reverse=True) if s <= length]
        if 1 not in sizes:
            sizes.append(1)
        match = {s: self._matches(hashes, s) if s in self.keys else np.full((n, length), -1, np.int32) for s in sizes}
        gain = {s: np.where(m >= 0, self.score[m], -np.inf) for s, m in match.items()}
        gain[1] = np.where(match[1] >= 0, gain[1], self.unknown)
        best = np.zeros((n, length + 1))
        step = np.zeros((n, length + 1), np.int32)
        for end in range(1, length + 1):
            usable = [s for s in sizes if s <= end]
            options = np.stack([best[:, end - s] + gain[s][:, end - s] for s in usable])
            choice = options.argmax(0)
            best[:, end] = np.take_along_axis(options, choice[None], 0)[0]
            step[:, end] = np.array(usable, np.int32)[choice]
        rows, at = np.arange(n), np.full(n, length)
        back = []
        while (at > 0).any():
            size = step[rows, at]  # 0 where a word is at its start
            start = at - size
            ids = np.full(n, -2, np.int32)
            for s in np.unique(size[size > 0]):
                mine = size == s
                ids[mine] = match[int(s)][rows[mine], start[mine]]
            ids[ids == -1] = -3 - points[rows[ids == -1], start[ids == -1]].astype(np.int32)
            back.append(ids)
            at = start
        path = np.stack(back[::-1], 1)
        used = path != -2
        ids, size = path[used], used.sum(1)
        if (unknown := ids < -2).any():
            letters = [self._letters(-3 - i) for i in ids[unknown].tolist()]
            width = np.ones(len(ids), np.int64)
            width[unknown] = [len(x) for x in letters]
            size = np.add.reduceat(width, np.cumsum(size) - size)
            ids, unknown = np.repeat(ids, width), np.repeat(unknown, width)
            ids[unknown] = np.array(self.byte_ids, np.int32)[[b for x in letters for b in x]]
        return ids, size

    @staticmethod
    def _letters(point: int) -> list[int]:
        return list((MARK if point == ord(_PLACE) else chr(point)).encode("utf-8", "surrogatepass"))

    def _long(self, word: str) -> np.ndarray:
        """Ids of one long word, by the same sums as ``_slab``."""
        points = np.frombuffer(word.encode("utf-32-le", "surrogatepass"), np.uint32)
        n, reach, window = len(points), self.longest, _ROW * _ROW
        best = [0.0] + [-np.inf] * reach  # of the places from the window's begin on
        step, piece = np.zeros(n + 1, np.int32), np.full(n + 1, -1, np.int32)
        for at in range(0, n, window):
            size = min(window, n - at)
            rows = -(-size // _ROW)
            padded = np.full(rows * _ROW + reach, 0xFFFFFFFF, np.uint32)  # no code point
            padded[:min(len(padded), n - at)] = points[at:at + len(padded)]
            grid = padded[np.arange(rows)[:, None] * _ROW + np.arange(_ROW + reach)]
            hashes = self._hashes(grid)
            begins, sizes, ids = [], [], []
            for s in sorted(self.keys):
                found = self._matches(hashes[:, :_ROW + s], s)[:, :_ROW].reshape(-1)[:size]
                where = np.flatnonzero(found >= 0)
                begins.append(where)
                sizes.append(np.full(len(where), s))
                ids.append(found[where])
            alone = np.setdiff1d(np.arange(size), begins[0] if 1 in self.keys else [])
            begins, sizes, ids = (np.concatenate([x, *y]) for x, y in (
                (alone, begins), (np.ones(len(alone), np.int64), sizes), (np.full(len(alone), -1), ids)))
            order = np.lexsort((sizes, begins))
            gains = np.where(ids >= 0, self.score[ids], self.unknown)[order].tolist()
            best += [-np.inf] * size
            last, kind = [0] * len(best), [-1] * len(best)
            last[:reach + 1], kind[:reach + 1] = _padded(step[at:at + reach + 1], reach + 1), _padded(piece[at:at + reach + 1], reach + 1)
            for b, s, i, g in zip(begins[order].tolist(), sizes[order].tolist(), ids[order].tolist(), gains, strict=True):
                total, end = best[b] + g, b + s
                if total > best[end] or (total == best[end] and s > last[end]):
                    best[end], last[end], kind[end] = total, s, i
            upto = min(n + 1, at + len(best)) - at
            step[at:at + upto], piece[at:at + upto] = last[:upto], kind[:upto]
            best = best[size:]
        steps, kinds, out, at = step.tolist(), piece.tolist(), [], n
        while at > 0:
            kind, at = kinds[at], at - steps[at]
            out += [kind] if kind >= 0 else [self.byte_ids[b] for b in reversed(self._letters(int(points[at])))]
        return np.array(out[::-1], np.int32)

    def learn(self, words: list[str]) -> None:
        """Segment words that the memo lacks."""
        by_length: dict[int, list[str]] = {}
        for w in words:
            by_length.setdefault(len(w), []).append(w)
        flat, sizes, names = [], [], []
        for length, group in by_length.items():
            if length > LONG:
                names += group
                flat += (long := [self._long(w) for w in group])
                sizes.append(np.array([len(x) for x in long], np.int64))
                continue
            slab = max(1, _SLAB // length)
            for k in range(0, len(group), slab):
                names += group[k:k + slab]
                ids, size = self._slab(group[k:k + slab])
                flat.append(ids)
                sizes.append(size)
        size = np.concatenate(sizes)
        n = len(self.size)
        self.start = np.concatenate([self.start, len(self.flat) + np.cumsum(size) - size])
        self.size = np.concatenate([self.size, size])
        self.flat = np.concatenate([self.flat, *flat])
        self.memo.update(zip(names, range(n, n + len(names)), strict=True))

    def encode(self, texts: Sequence[str | None]) -> pa.ListArray:
        cut = [_CHUNK.findall(MARK + t.replace(MARK, _PLACE).replace(" ", MARK)) if t else [] for t in texts]
        n = sum(map(len, cut))
        word = np.fromiter(map(self.memo.get, chain.from_iterable(cut), repeat(-1)), np.int64, n)
        if len(new := np.flatnonzero(word < 0)):
            words = list(chain.from_iterable(cut))
            missing = [words[k] for k in new.tolist()]
            self.learn(list(dict.fromkeys(missing)))
            word[new] = np.fromiter(map(self.memo.__getitem__, missing), np.int64, len(new))
        size = self.size[word]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.flat[np.repeat(self.start[word] - (ends - size), size) + np.arange(total)]
        upto = np.concatenate([[0], np.cumsum([len(words) for words in cut])]).astype(np.int64)
        offsets = np.concatenate([[0], ends])[upto].astype(np.int32)
        if len(self.flat) > _MEMO:
            self.forget()
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids, pa.int32()))

    def decode(self, ids: np.ndarray) -> str:
        if not len(ids):
            return ""
        if self.is_high[ids].any():
            parts = [bytes([self.byte_of[i]]) if self.is_byte[i] else self.texts[i].encode() for i in ids]
            text = b"".join(parts).decode("utf-8", "replace")
        else:
            text = "".join(map(self.texts.__getitem__, ids.tolist()))
        return text[1:]


_KNOWN: dict[tuple, Vocabulary] = {}


def _vocabulary(pieces, scores, plain, byte_ids) -> Vocabulary:
    """One vocabulary a Python worker, kept between tasks."""
    key = (len(pieces), hash(tuple(pieces)), hash(tuple(scores)))
    if key not in _KNOWN:
        _KNOWN[key] = Vocabulary(pieces, scores, plain, byte_ids)
    return _KNOWN[key]


def load(model_path: str = DEFAULT_MODEL) -> Vocabulary:
    """The vocabulary of a public SentencePiece model file; read on the driver, sent with the tasks."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    n = model.get_piece_size()
    if model.normalize("a  b ") != f"{MARK}a{MARK}{MARK}b{MARK}":
        raise ValueError("only models that keep white space and put one mark in front are known")
    byte_ids = [i for i in range(n) if model.is_byte(i)]
    if len(byte_ids) != 256:
        raise ValueError("the model has no byte pieces")
    plain = [not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i)) for i in range(n)]
    return _vocabulary([model.id_to_piece(i) for i in range(n)], [model.get_score(i) for i in range(n)], plain, byte_ids)


def encode(docs: DataFrame, vocabulary: Vocabulary, text_col: str = "text", out_col: str = "ids") -> DataFrame:
    """``docs`` with the piece ids of every whole text."""
    small_batches(docs.sparkSession)

    # A step of its own, so that what uses the ids does not encode the texts again.
    names = [c for c in docs.columns if c != out_col]
    schema = T.StructType([*(docs.schema[c] for c in names), T.StructField(out_col, T.ArrayType(T.IntegerType()))])

    def run(batches):
        try:
            for batch in batches:
                ids = vocabulary.encode(batch.column(text_col).to_pylist())
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), ids], [*names, out_col])
        finally:
            vocabulary.forget()  # the worker lives on and serves other steps

    return docs.mapInArrow(run, schema)


def decode(docs: DataFrame, vocabulary: Vocabulary, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """``docs`` with the text of every list of piece ids."""
    small_batches(docs.sparkSession)

    @F.arrow_udf(T.StringType())
    def text(lists: pa.Array) -> pa.Array:
        flat = np.asarray(lists.flatten())
        ends = np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
        return pa.array([vocabulary.decode(flat[s:e]) for s, e in zip([0, *ends[:-1]], ends, strict=True)], pa.string())

    return docs.withColumn(out_col, text(F.col(ids_col)))
