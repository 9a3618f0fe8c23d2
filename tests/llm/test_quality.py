import math
from collections import Counter, defaultdict

import numpy as np
import pytest

from courtside.llm import quality, queries
from tests.llm.cases import edge_docs, no_docs


class Plain:
    """Interpolated modified Kneser-Ney by its formulas, over dictionaries."""

    def __init__(self, texts, order):
        self.order = order
        top = Counter(p[i:i + order] for t in texts if t for p in [quality.BEGIN * (order - 1) + t + quality.END]
                      for i in range(len(p) - order + 1))
        self.counts = {order: top}
        for n in range(order - 1, 0, -1):
            self.counts[n] = Counter(g[1:] for g in self.counts[n + 1])
        self.cut, self.sums = {}, {}
        for n, counts in self.counts.items():
            d = quality.discounts(Counter(c for c in counts.values() if c <= 4))
            self.cut[n] = lambda c, d=d: d[min(c, 3) - 1]
            total, freed = defaultdict(int), defaultdict(float)
            for g, c in counts.items():
                total[g[:-1]] += c
                freed[g[:-1]] += self.cut[n](c)
            self.sums[n] = total, freed

    def p(self, context, char):
        n = len(context) + 1
        total, freed = self.sums[n]
        lower = self.p(context[1:], char) if n > 1 else 1 / (len(self.counts[1]) + 1)
        if context not in total:
            return lower
        c = self.counts[n].get(context + char, 0)
        return (max(c - self.cut[n](c), 0) if c else 0) / total[context] + freed[context] / total[context] * lower

    def perplexity(self, text):
        p = quality.BEGIN * (self.order - 1) + text + quality.END
        logs = [math.log(self.p(p[i - self.order + 1:i], p[i])) for i in range(self.order - 1, len(p))]
        return math.exp(-sum(logs) / len(logs))


TEXTS = ["the cat sat on the mat", "the dog sat on the log", "a cat and a dog", None, "", "thé 😀 cat", "x" * 40, "the cat sat"]


@pytest.mark.parametrize("order", [2, 3, 5])
def test_perplexities_by_the_formulas(spark, order):
    model = quality.train(spark.createDataFrame([(t,) for t in TEXTS], "text string"), order)
    plain = Plain(TEXTS, order)
    asked = ["the cat", "zzz", "the dog sat on the cat", "é", None, "", "a" * 300]
    got = model.perplexities(asked)
    for t, p in zip(asked, got, strict=True):
        assert np.isnan(p) if not t else abs(p - plain.perplexity(t)) < 1e-3 * p, t


def test_probabilities_sum_to_one(spark):
    model = quality.train(spark.createDataFrame([(t,) for t in TEXTS], "text string"), 3)
    letters = sorted({c for t in TEXTS if t for c in t} | {quality.END})
    plain = Plain(TEXTS, 3)
    for context in ("th", "ca", "zz", quality.BEGIN * 2):
        total = sum(plain.p(context, c) for c in letters)
        assert abs(total + plain.p(context, "\x00") - 1) < 1e-9
    assert model.unknown < 0


def test_many_shards_answer_alike(spark, monkeypatch):
    docs = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    one = quality.train(docs).perplexities(["the cat sat", "qq"])
    monkeypatch.setattr(quality, "SHARD_ROWS", 25)
    monkeypatch.setattr(quality, "HELD_SHARDS", 2)
    many = quality.train(docs)
    assert many.shards > 3 and np.allclose(many.perplexities(["the cat sat", "qq"]), one)


def test_edge_rows(spark):
    docs = edge_docs(spark)
    trusted = docs.select("doc_id").filter("doc_id >= 1")
    out = quality.classify(docs, trusted).collect()
    assert len(out) == docs.count()
    for r in out:
        if r["doc_id"] in (3, 4):
            assert r["perplexity"] is None and not r["kept"]
        else:
            assert r["perplexity"] > 0
    untrained = quality.classify(docs, trusted.limit(0)).collect()
    assert {r["doc_id"] for r in untrained if not r["kept"]} == {3, 4}
    assert quality.classify(no_docs(spark), trusted).count() == 0


def test_query_rejects_junk_and_keeps_clean_text(spark):
    sf = "/root/testdata/sf0.01"
    out = {r["doc_id"]: r for r in queries.QUERIES["op8_kneser_ney_quality"](spark, sf).collect()}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert len(out) == 1000
    good = [out[i]["kept"] for i, q in labels.items() if q == 1]
    junk = [out[i]["kept"] for i, q in labels.items() if q == 0]
    assert np.mean(good) >= 0.98 and np.mean(junk) <= 0.15
