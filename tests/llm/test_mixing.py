import re
from collections import defaultdict

from courtside.llm import mixing
from tests.llm.cases import edge_docs, edge_rows, no_docs


def filled(sizes, weights, rate, cap):
    """Targets by raising a common level in rounds: held sources leave, the rest share anew."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    target, left, budget = {}, set(names), rate * sum(sizes.values())
    while left:
        level = budget / sum(weight[s] for s in left)
        over = {s for s in left if level * weight[s] > cap * sizes[s]}
        if not over:
            return target | {s: level * weight[s] for s in left}
        for s in over:
            target[s] = cap * sizes[s]
            budget -= target[s]
        left -= over
    return target


def test_targets_and_copies(spark):
    docs = edge_docs(spark)
    out = mixing.mix(docs, (3, 1, 2)).collect()
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")) for r in edge_rows()]
    assert sorted(r["size"] for r in out) == sorted(size)
    sums = defaultdict(int)
    for r, n in zip(edge_rows(), size, strict=True):
        sums[r[3]] += n
    want = filled(sums, (3, 1, 2), 1.5, 2)
    taken, smallest = defaultdict(int), defaultdict(lambda: 10**9)
    for r in out:
        assert r["source_size"] == sums[r["source"]] and abs(r["target"] - want[r["source"]]) < 1e-6
        assert 0 <= r["taken"] <= 2 * r["size"] and r["taken"] == r["copies"] * r["size"]
        taken[r["source"]] += r["taken"]
        smallest[r["source"]] = min(smallest[r["source"]], r["size"] or 10**9)
    assert all(abs(taken[s] - want[s]) <= max(r["size"] for r in out if r["source"] == s) for s in want)
    again = mixing.mix(docs.repartition(5), (3, 1, 2)).collect()
    assert sorted(map(str, again)) == sorted(map(str, out))


def test_documents_are_repeated_as_decided(spark):
    docs = edge_docs(spark)
    decided, got = defaultdict(int), defaultdict(int)
    for r in mixing.mix(docs, (3, 1, 2)).collect():
        decided[r["doc_id"]] += r["copies"] if r["size"] else 0
    mixed = mixing.mix_documents(docs, (3, 1, 2))
    assert mixed.columns == docs.columns
    for r in mixed.collect():
        got[r["doc_id"]] += 1
    # A closing document that is a repeated row is taken as often as it is there.
    assert {k: v for k, v in decided.items() if v and k != 1} == {k: v for k, v in got.items() if k != 1}
    assert abs(decided[1] - got[1]) <= 1


def test_pareto_order_prefers_larger_odds(spark):
    docs = spark.range(4000).selectExpr("id AS doc_id", "'a b' AS text", "'s' AS source", "id % 2 + 1 AS liked")
    out = mixing.mix(docs, (1,), rate=0.4, preference=docs["liked"]).collect()
    picked = [sum(r["copies"] for r in out if r["doc_id"] % 2 == k) for k in (0, 1)]
    assert abs(sum(picked) - 1600) <= 1 and 1.7 < picked[1] / picked[0] < 2.3


def test_no_documents(spark):
    assert mixing.mix(no_docs(spark), (3, 1, 2)).count() == 0
    assert mixing.mix_documents(no_docs(spark), (3, 1, 2)).count() == 0
