import random
import re
import time

import numpy as np
import pyarrow as pa

from courtside.llm import pieces, queries
from tests.llm.cases import edge_docs, edge_rows, no_docs

V = pieces.load()
INDEX = {p: i for i, p in enumerate(V.pieces) if V.plain[i]}


def best_path(chunk):
    """Plain Viterbi over one text, all pieces tried by their strings."""
    best, back = [0.0] + [None] * len(chunk), [None] * (len(chunk) + 1)
    for end in range(1, len(chunk) + 1):
        for size in range(min(V.longest, end), 0, -1):
            i = INDEX.get(chunk[end - size:end])
            if i is None and size > 1:
                continue
            total = best[end - size] + (V.scores[i] if i is not None else V.unknown)
            if best[end] is None or total > best[end]:
                best[end], back[end] = total, (size, i)
    out, end = [], len(chunk)
    while end:
        size, i = back[end]
        out.append([i] if i is not None else [V.byte_ids[b] for b in chunk[end - 1].replace("\ud800", pieces.MARK).encode()])
        end -= size
    return [i for part in out[::-1] for i in part]


def test_against_plain_viterbi_over_whole_texts():
    rng = random.Random(2)
    texts = ["".join(rng.choice("the anio tré\n  12😀zx▁") for _ in range(rng.randint(0, 60))) for _ in range(80)]
    texts += [None, "", " ", "   ", "a", "Hello world, this is a test."]
    for t, ids in zip(texts, V.encode(texts).to_pylist(), strict=True):
        assert ids == (plain(t) if t else []), t


def plain(text):
    """The mark itself, written in a text, is no blank: it has no piece."""
    return best_path(pieces.MARK + text.replace(pieces.MARK, "\ud800").replace(" ", pieces.MARK))


def test_long_words_in_windows(monkeypatch):
    rng = random.Random(4)
    words = ["".join(rng.choice(letters) for _ in range(n)) for letters, n in
             (("abcdefgh", 3000), ("theanioréing", 5000), ("x", 2500), ("zé😀▁q", 2100), ("ing", 70000))]
    want = [plain(w) for w in words]
    assert V.encode(words).to_pylist() == want
    monkeypatch.setattr(pieces, "_ROW", 8)  # many windows
    monkeypatch.setattr(pieces, "LONG", 5)
    V.forget()
    assert V.encode(words[:4]).to_pylist() == want[:4]
    V.forget()


def test_a_word_of_two_million_letters_takes_seconds():
    word = "".join(random.Random(5).choices("abcdefghijklmnopqrstuvwxyz", k=2_000_000))
    began = time.process_time()
    ids = np.array(V.encode([word]).to_pylist()[0])
    assert V.decode(ids) == word and time.process_time() - began < 60
    V.forget()


def test_the_table(spark, sf_dir):
    """The registered query, against plain Viterbi word by word."""
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    known = {}

    def ids(text):
        chunks = re.findall("▁*[^▁]+|▁+", "▁" + text.replace("▁", "\ud800").replace(" ", "▁")) if text else []
        return [i for c in chunks for i in (known.get(c) or known.setdefault(c, best_path(c)))]

    rows = queries.QUERIES["op5_pieces"](spark, sf_dir).collect()
    assert len(rows) == len(texts) and all(r["round_trip"] for r in rows)
    assert all(r["ids"] == ids(texts[r["doc_id"]]) and r["n_tokens"] == len(r["ids"]) for r in rows)


def test_the_mark_comes_back():
    texts = ["a▁b", "▁", " ▁ ▁▁", "x▁ y"]
    assert [V.decode(np.array(i)) for i in V.encode(texts).to_pylist()] == texts


def test_score_is_never_below_the_library_s_own_cut():
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=pieces.DEFAULT_MODEL)
    for t in ("the quick brown fox jumps over the lazy dog", "Schachzug und Lichtung", "ciónadoque las doa"):
        assert sum(V.scores[i] for i in V.encode([t]).to_pylist()[0]) >= sum(V.scores[i] for i in model.encode(t))


def test_round_trip(spark):
    docs = edge_docs(spark)
    out = pieces.decode(pieces.encode(docs, V), V).select("doc_id", "text", "ids", "decoded").collect()
    assert len(out) == len(edge_rows())
    assert all(r["decoded"] == (r["text"] or "") for r in out)
    assert pieces.encode(no_docs(spark), V).count() == 0


def test_memo_may_be_forgotten(monkeypatch):
    texts = [f"word{k} the {k % 3}" for k in range(300)]
    want = V.encode(texts).to_pylist()
    monkeypatch.setattr(pieces, "_MEMO", 8)
    assert [V.encode([t]).to_pylist()[0] for t in texts] == want
    assert V.decode(np.array(want[5])) == texts[5]


def test_workers_hold_no_words_after_a_task(spark):
    """A Python worker is used again by other steps: the words of the texts that it has encoded are let go."""
    pieces.encode(spark.range(2000).selectExpr("id", "concat('word', id, ' ', uuid()) AS text"), pieces.load()).select("ids").collect()

    def held(batches):
        from courtside.llm import pieces
        n = sum(len(v.memo) for v in pieces._KNOWN.values())
        yield from (pa.RecordBatch.from_arrays([pa.array([n] * b.num_rows, pa.int64())], names=["n"]) for b in batches)

    assert spark.range(64).mapInArrow(held, "n bigint").agg({"n": "max"}).first()[0] == 0
