import numpy as np
import pytest

from courtside.llm import queries, vectors
from courtside.llm.vectors import Centroids


def brute(ids, x, query, k=5):
    unit = x / np.sqrt((x * x).sum(1, keepdims=True))
    out = {}
    for q in np.flatnonzero(query):
        score = np.round(unit @ unit[q], 12)
        score[ids == ids[q]] = -9
        order = np.lexsort((ids, -score))[:k]
        out[int(ids[q])] = [int(i) for i in ids[order] if i != ids[q]]
    return out


def found(rows):
    out = {}
    for r in sorted(rows, key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append(r["vec_id"])
    return out


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, list int, packed string, score double")


def test_small_tables_are_exact(spark, sf_dir):
    t = spark.read.parquet(f"{sf_dir}/embeddings.parquet").orderBy("vec_id").collect()
    ids, x = np.array([r["vec_id"] for r in t]), np.array([r["embedding"] for r in t], float)
    rows = queries.QUERIES["op6_posting_lists"](spark, sf_dir).collect()
    want = brute(ids, x, ids % 50 == 0)
    assert np.mean([len(set(want[q]) & set(g)) / 5 for q, g in found(rows).items()]) >= 0.9 and set(want) == set(found(rows))
    at = {i: v for i, v in zip(ids.tolist(), x, strict=True)}
    for r in rows:
        a, b = at[r["query_id"]], at[r["vec_id"]]
        assert abs(r["score"] - a @ b / np.sqrt((a @ a) * (b @ b))) < 1e-12


def test_edge_rows_and_a_common_vector(spark):
    rng = np.random.default_rng(1)
    v = rng.normal(size=(60, 8)).astype(np.float32).tolist()
    bad = [(900, None), (950, [0.0] * 8), (901, [float("nan")] * 8), (902, [float("inf")] + [1.0] * 7),
           (903, [None] + [1.0] * 7), (904, [1.0, 2.0]), (None, v[3]), (100, v[0])]
    rows = [(k, x, 1, 1, "p", 0.5) for k, x in [*enumerate(v), *[(200 + k, v[0]) for k in range(300)], *bad]]
    out = vectors.search(table(spark, rows), lambda i: i % 50 == 0).collect()
    got = found(out)
    # 0, 100 and 200..499 are one vector: the least ids among equals, never the query's own.
    assert got[0] == [100, 200, 201, 202, 203] and got[200] == [0, 100, 201, 202, 203] and got[100] == [0, 200, 201, 202, 203]
    ids = np.array([*range(60), *range(200, 500), 100])
    x = np.array(v + [v[0]] * 301, float)
    want = brute(ids, x, ids % 50 == 0)
    assert got == want and not {900, 950} & set(got)
    assert [r["rank"] for r in sorted(out, key=lambda r: (r["query_id"], r["rank"]))[:5]] == [1, 2, 3, 4, 5]


def test_few_or_no_vectors(spark):
    rows = [(0, [1.0, 0.0], 1, 1, "p", 0.5), (1, [1.0, 1.0], 1, 1, "p", 0.5)]
    assert found(vectors.search(table(spark, rows), lambda i: i % 50 == 0).collect()) == {0: [1]}
    assert vectors.search(table(spark, rows[:1]), lambda i: i % 50 == 0).count() == 0
    assert vectors.search(table(spark, []), lambda i: i % 50 == 0).count() == 0


def test_many_lists_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(vectors, "LIST_ROWS", 32)
    monkeypatch.setattr(vectors, "BLOCK", 64)
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(20, 16))
    x = (centres[rng.integers(0, 20, 3000)] + 0.4 * rng.normal(size=(3000, 16))).astype(np.float32)
    rows = [(k, v.tolist(), 1, 1, "p", 0.5) for k, v in enumerate(x)]
    got = found(vectors.search(table(spark, rows), lambda i: i % 50 == 0).collect())
    want = brute(np.arange(3000), x.astype(float), np.arange(3000) % 50 == 0)
    assert np.mean([len(set(want[q]) & set(got[q])) / 5 for q in want]) >= 0.9
    everything = found(vectors.search(table(spark, rows), lambda i: i % 50 == 0, reach=None).collect())
    assert everything == want


def test_very_large_and_small_components(spark):
    rows = [(0, [1e200, 0.0, 1e200]), (1, [1e-200, 0.0, 1e-200]), (2, [1.0, 0.0, 1.0]), (3, [1.0, 0.0, 0.0]), (4, [-1e300, 0.0, 1e300])]
    t = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    out = vectors.search(t, lambda i: i % 50 == 0).collect()
    assert found(out)[0] == [1, 2, 3, 4]
    assert np.allclose([r["score"] for r in sorted(out, key=lambda r: r["rank"])], [1, 1, 0.5 ** 0.5, 0], atol=1e-15)


def test_vectors_meet_those_of_their_length(spark):
    rows = [(k, [1.0, float(k)], 1, 1, "p", 0.5) for k in range(4)] + [(50 + k, [1.0, 0.0, float(k)], 1, 1, "p", 0.5) for k in range(3)]
    got = found(vectors.search(table(spark, rows), lambda i: i % 50 == 0).collect())
    assert got == {0: [1, 2, 3], 50: [51, 52]}


def test_recall_and_lists_read_at_a_thousand_lists():
    """Directions without any structure, the hardest case for lists."""
    rng = np.random.default_rng(8)
    x = vectors.unit(rng.normal(size=(64000, 32)))
    c = Centroids.fit(x[:32000], 1000)
    row, which = c.lists_of(x, vectors.SPREAD, vectors.COPIES)
    member = [set() for _ in range(len(x))]
    for r, w in zip(row.tolist(), which.tolist(), strict=True):
        member[r].add(w)
    at = np.arange(0, 64000, 320)
    row, which = c.lists_of(x[at], vectors.REACH)
    reads = [set(which[row == k].tolist()) for k in range(len(at))]
    score = x[at] @ x.T
    score[np.arange(len(at)), at] = -9
    best = np.argsort(-score, 1)[:, :5]
    recall = np.mean([bool(member[v] & reads[k]) for k in range(len(at)) for v in best[k].tolist()])
    share = np.mean([len(r) for r in reads]) / 1000
    assert recall >= 0.9 and share <= 0.5, (recall, share)


def test_graph_walk_finds_near_centroids():
    rng = np.random.default_rng(3)
    c = Centroids.fit(rng.normal(size=(20000, 24)), 300)
    assert len(c.points) == 300
    x = vectors.unit(rng.normal(size=(200, 24)))
    exact = np.sqrt(np.maximum(0, 2 - 2 * (x @ c.points.T)))
    near = exact <= 1.15 * exact.min(1, keepdims=True)
    walked = c.within(x, 1.15)
    assert np.isfinite(walked[near]).mean() > 0.98 and (walked.min(1) <= exact.min(1) + 1e-5).mean() > 0.98


def test_lists_are_balanced():
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.normal(size=(9000, 12)) * 0.05 + 1, rng.normal(size=(1000, 12))])
    c = Centroids.fit(x, 64)
    size = np.bincount(c.lists_of(vectors.unit(x), 1.0, 1)[1], minlength=64)
    assert size.max() <= 12 * len(x) / 64


@pytest.mark.parametrize("most", [2, 6])
def test_replicas_are_near_and_not_behind_each_other(most):
    rng = np.random.default_rng(5)
    c, x = Centroids.fit(rng.normal(size=(4000, 10)), 60), vectors.unit(rng.normal(size=(300, 10)))
    row, which = c.lists_of(x, 1.2, most)
    assert set(row) == set(range(300)) and np.bincount(row).max() <= most
    for k in range(300):
        d = np.sqrt(np.maximum(0, 2 - 2 * (c.points[which[row == k]] @ x[k])))
        assert (d <= 1.2 * d.min() + 1e-5).all()
