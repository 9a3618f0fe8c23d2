import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from courtside.llm import collocations as C

from .cases import edge_docs, edge_rows, no_docs


def lower(text):
    return text.translate({k: k + 32 for k in range(65, 91)})


def brute(rows, support=10, longest=3, covered=50, limit=2000):
    counts, n = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", lower(text or "")):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for m in range(1, longest + 1):
                counts.setdefault(lang, Counter()).update(tuple(words[i:i + m]) for i in range(len(words) - m + 1))
    out = []
    for lang, f in counts.items():
        kept = []
        have = {p: a for p, a in f.items() if len(p) > 1 and a >= support}
        longer = Counter()
        for p, a in have.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    longer[p[i:i + m]] = max(longer[p[i:i + m]], a)
        for p, a in have.items():
            if 100 * longer[p] >= covered * a:
                continue
            score, _, left, right = min((1000000 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:limit], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def found(df, **kw):
    return sorted(tuple(r) for r in C.collocations(df, **kw).collect())


def prose(seed, docs=60, words=120):
    rng = random.Random(seed)
    vocabulary = ["ab", "Cd", "é", "fg", "hi", "jk", "lm", "x y", "no", "pq", "😀", "rs", "tu"] + [f"w{k}" for k in range(60)]
    ends = [" "] * 8 + ["  ", "\t", ". ", ",", "; ", "!", "\n", "\r\n", "\x0b"]
    # Some phrases stand in one shard only, others everywhere.
    text = lambda: "".join(rng.choice(vocabulary[:rng.choice([4, 13, 73])]) + rng.choice(ends) for _ in range(rng.randrange(words)))
    return [(k, text(), rng.choice(["en", "de", None, "und"])) for k in range(docs)]


@pytest.mark.parametrize(("seed", "kw"), [(1, {}), (2, {"support": 3, "limit": 7}), (3, {"longest": 5, "support": 2, "shards": 3}),
                                         (4, {"shards": 1}), (5, {"covered": 10, "shards": 9})])
def test_equals_brute_force(spark, seed, kw):
    rows = prose(seed)
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    assert found(df, **kw) == brute([r[1:] for r in rows], **{k: v for k, v in kw.items() if k != "shards"})


def test_a_full_bitmap_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(C, "bitmap_of", lambda keys: np.full(4096, 255, np.uint8))
    rows = prose(6)
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    assert found(df) == brute([r[1:] for r in rows])


def test_a_phrase_of_one_shard_is_found(spark):
    """Ten times in one document, nowhere else."""
    rows = [(k, "one two three. four", "en") for k in range(40)] + [(99, "rare pair, " * 10, "en")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    got = found(df)
    assert got == brute([r[1:] for r in rows]) and any(r[2] == "rare pair" for r in got)


def test_odd_rows(spark):
    assert found(edge_docs(spark), support=2) == brute([(r[1], r[2]) for r in edge_rows()], support=2)
    assert found(no_docs(spark)) == []


def test_hashes_do_not_depend_on_blocks(monkeypatch):
    data = lower("The stone. of THE é😀 " + "z" * 50 + " the stone, river\tof the").encode()
    whole = C.Words(data)
    monkeypatch.setattr(C, "BLOCK", 7)
    parts = C.Words(data)
    assert (whole.hash == parts.hash).all() and (whole.other == parts.other).all()
    texts = [data[a:b] for a, b in zip(whole.first, whole.last, strict=True)]
    assert len(set(whole.hash.tolist())) == len(set(texts)) == len(set(whole.numbers().tolist()))


def test_buffers_hold_each_text_once(monkeypatch):
    rows = prose(8)
    batch = pa.RecordBatch.from_pydict({"lang": [r[2] or "und" for r in rows], "salt": [r[0] % 3 for r in rows], "text": [r[1] for r in rows]})
    words = lambda: sum((Counter(w.phrases(w.starts(2), 2)[0]) for *_, w in C._buffered([batch, batch])), Counter())
    total = lambda: sum(len(w) for *_, w in C._buffered([batch, batch]))
    few, n = set(words()), total()
    monkeypatch.setattr(C, "BUFFER", 200)
    monkeypatch.setattr(C, "BUFFERS", 500)
    assert set(words()) == few and total() == n


def test_numbers_tell_words_of_equal_hash_apart():
    words = C.Words(b"a b a c b")
    words.hash = np.zeros(5, np.uint64)
    assert len(set(words.numbers().tolist())) == 3 and words.numbers()[0] == words.numbers()[2]
