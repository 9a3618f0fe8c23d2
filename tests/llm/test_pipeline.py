import re
from collections import Counter

import pytest

import __spark_entry__ as E
import corpus_pipeline
from courtside.llm import pieces, pii, queries
from tests.llm.cases import edge_docs, no_docs
from tests.llm.test_ngram_join import brute


def test_registered():
    assert "pipeline" in E.queries() and {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in queries.QUERIES}
    assert set(queries.ORACLES) <= set(queries.QUERIES) and "pipeline" not in E.oracle_sql()


def test_each_stage_by_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "ngram_jaccard_join", "pii", "source_mix", "sentencepiece"]
    kept = corpus_pipeline.identify_language(spark, docs, sf_dir)
    rows = [tuple(r) for r in kept.collect()]
    assert kept.columns == docs.columns and len(rows) >= 0.99 * docs.count()

    once = corpus_pipeline.drop_near_copies(spark, kept, sf_dir)
    want = {i for i, _, c in brute([(r[0], r[1]) for r in rows], 5, 80) if i == c}
    rows = [tuple(r) for r in once.collect()]
    assert once.columns == docs.columns and sorted(str(r[0]) for r in rows) == sorted(want)

    clean = corpus_pipeline.redact(spark, once, sf_dir)
    texts = {r["doc_id"]: r for r in clean.collect()}
    assert clean.columns == docs.columns
    for i, text, *_ in rows:
        assert texts[i]["text"] == pii.redact(text) and texts[i]["n_chars"] == len(texts[i]["text"])
        if not pii.find_spans(text):
            assert texts[i]["text"] == text

    mixed = corpus_pipeline.mix_sources(spark, clean, sf_dir)
    copies = Counter(r["doc_id"] for r in mixed.collect())
    words = {i: len(re.findall(r"[^\x20\x09-\x0D]+", r["text"])) for i, r in texts.items()}
    assert mixed.columns == docs.columns and set(copies.values()) <= {1, 2}
    total = sum(words.values())
    assert abs(sum(words[i] * n for i, n in copies.items()) - 1.5 * total) < 0.05 * total

    last = corpus_pipeline.encode(spark, mixed, sf_dir).collect()
    assert Counter(r["doc_id"] for r in last) == copies
    v = pieces.load()
    for r in last[:50]:
        assert r["ids"] == v.encode([texts[r["doc_id"]]["text"]]).to_pylist()[0] and r["n_tokens"] == len(r["ids"])


def test_repeated_and_missing_ids(spark, sf_dir):
    """No clean text goes with a copy that has its id; copies without an id go; one row of each component stays."""
    a, b, c, d = (" ".join(f"{x}{k}" for k in range(60)) for x in "abcd")
    rows = [(1, a), (1, b), (2, a), (2, c), (None, d), (None, d), (3, d + " tail"), (None, c + " end"), (None, "alone " * 9), (4, ""), (None, None),
            (4, ""), (5, "solo " * 12), (5, "solo " * 12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    once = sorted(((r["doc_id"], (r["text"] or "")[:6]) for r in corpus_pipeline.drop_near_copies(spark, docs, sf_dir).collect()), key=str)
    assert once == sorted([(1, a[:6]), (1, b[:6]), (2, c[:6]), (3, d[:6]), (None, "alone "), (4, ""), (4, ""), (None, ""), (5, "solo s")], key=str)


@pytest.mark.parametrize("stage", [n for n, _ in corpus_pipeline.STAGES])
def test_edge_rows(spark, sf_dir, stage):
    docs = edge_docs(spark)
    run = dict(corpus_pipeline.STAGES)[stage]
    for d in (docs, no_docs(spark)):
        out = run(spark, d, sf_dir)
        n = out.count()
        assert n <= 2 * d.count()
        if stage != "sentencepiece":
            assert out.columns == d.columns


def test_run(spark, sf_dir):
    out = corpus_pipeline.run(spark, sf_dir)
    assert {"doc_id", "ids", "n_tokens"} <= set(out.columns) and out.count() > 100
