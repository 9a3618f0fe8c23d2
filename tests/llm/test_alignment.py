import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from courtside.llm import alignment as A

from .cases import edge_docs, edge_rows, no_docs


@pytest.fixture(scope="module")
def both():
    return A.load()


def plain_tokens(text):
    """Tokens with their bytes by the libraries the files belong to, one text at a time."""
    import sentencepiece
    from tokenizers import Tokenizer

    if not hasattr(plain_tokens, "known"):
        t = Tokenizer.from_file(A.DEFAULT_BYTE_BPE)
        t.encode_special_tokens = True
        back = {i: bytes(A.byte_alphabet()[c] for c in s) for s, i in t.get_vocab().items() if not s.startswith("<|")}
        plain_tokens.known = t, back, sentencepiece.SentencePieceProcessor(model_file=A.DEFAULT_PIECES)
    t, back, model = plain_tokens.known
    if not text:
        return [], []
    a = [(i, back[i]) for i in t.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in model.encode(text):
        piece = model.id_to_piece(i)
        b.append((i, bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode()))
    data = (" " + text).encode()
    if b"".join(x for _, x in a) != data or b"".join(x for _, x in b) != data:
        return [], []
    return a, b


def brute(rows):
    docs, counts = [], Counter()
    for doc_id, text in rows:
        spans = []
        for tokens in plain_tokens(text):
            at, out = 0, []
            for i, data in tokens:
                out.append((i, at, at + len(data)))
                at += len(data)
            spans.append(out)
        a, b = spans
        links = [(i, j) for i, s, e in a for j, t, f in b if s < f and t < e] if len(a) < 400 else near_links(a, b)
        cuts = sorted({e for _, _, e in a} & {e for _, _, e in b})
        counts.update(links)
        groups, low = [], 0
        for cut in cuts:
            groups.append("|".join(",".join(str(i) for i, s, e in x if low <= s < cut) for x in (a, b)) if len(a) < 400 else None)
            low = cut
        docs.append((doc_id, a, b, groups, links))
    best = {}
    for (_, j), n in counts.items():
        best[j] = max(best.get(j, 0), n)
    out = []
    for doc_id, a, b, groups, links in docs:
        text = near_groups(a, b) if len(a) >= 400 else ";".join(groups)
        out.append((doc_id, len(a), len(b), len(groups), len(links), sum(counts[x] == best[x[1]] for x in links),
                    sum(counts[x] for x in links), hashlib.sha256(text.encode()).hexdigest() if a else ""))
    return sorted(out, key=str)


def near_links(a, b):
    """By two pointers, for long texts."""
    out, k = [], 0
    for i, s, e in a:
        while b[k][2] <= s:
            k += 1
        m = k
        while m < len(b) and b[m][1] < e:
            out.append((i, b[m][0]))
            m += 1
    return out


def near_groups(a, b):
    cuts = sorted({e for _, _, e in a} & {e for _, _, e in b})
    parts = []
    for side in (a, b):
        groups, k = [], 0
        for cut in cuts:
            ids = []
            while k < len(side) and side[k][2] <= cut:
                ids.append(str(side[k][0]))
                k += 1
            groups.append(",".join(ids))
        parts.append(groups)
    return ";".join(f"{x}|{y}" for x, y in zip(*parts, strict=True))


def found(df, **kw):
    return sorted((tuple(r) for r in A.cross_alignment(df, **kw).collect()), key=str)


TEXTS = ["a", " ", "  ", "\n", "hello world", "Hello  World\t\t\n", "naïve façade Straße", "日本語のテキスト", "😀😀 ok", "a▁b", "▁", "\x00x\x00",
         "<s>hi</s> <unk> <0x41> <|endoftext|>", "don't we'll I'D", "123 4567 ½ ²", "x" * 3000, " nbsp em", "\x85\x1c\x1f ctl", "é" * 50,
         "ﬁ ligature", "́combining", "a\r\nb\r", "مرحبا بالعالم", "tab\tend ", "word " * 500, "\U0010ffff￾"]


def test_equals_brute_force(spark, both):
    rng = random.Random(3)
    texts = TEXTS + ["".join(rng.choice(["the ", "ing", "é", " ", "\n", "Z", "9", "日", "-", ".", "ß"]) for _ in range(rng.randrange(60))) for _ in range(60)]
    rows = [(k % 70, t) for k, t in enumerate(texts)] + [(None, "hello world"), (3, None), (4, ""), (4, "")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = brute(rows)
    assert found(df) == want
    assert found(df, hot_pairs=0) == want  # every pair meets its count in the join
    assert found(df, hot_pairs=40) == want


def test_odd_rows(spark):
    assert found(edge_docs(spark)) == brute([(r[0], r[1]) for r in edge_rows()])
    assert found(no_docs(spark)) == []


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert found(docs) == brute([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_both_encoders_of_plain_texts_agree(both):
    rng = random.Random(9)
    letters = [chr(c) for c in [9, 10, 13, *range(32, 127), *range(0xC0, 0x250)]]
    texts = ["".join(rng.choices(letters, k=rng.randrange(80))) for _ in range(3000)]
    assert both.fast is not None and all(A._PLAIN.fullmatch(t) for t in texts)
    assert [both.fast.encode_ordinary(" " + t) for t in texts] == [x.ids for x in both.slow.encode_batch([" " + t for t in texts])]


def test_gallop_is_a_search():
    rng = np.random.default_rng(1)
    for n in (1, 2, 7, 300):
        ends = np.cumsum(rng.integers(1, 5, n))
        wanted = np.sort(rng.integers(0, ends[-1] + 1, 200))
        low = np.zeros(200, np.int64)
        for guess in (low, low + n - 1, rng.integers(0, n, 200)):
            assert (A.gallop(ends, wanted, low, low + n - 1, guess) == np.searchsorted(ends, wanted)).all()
