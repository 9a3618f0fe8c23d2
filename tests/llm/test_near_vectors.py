import numpy as np
import pytest
from pyspark.sql import functions as F

from courtside.llm import near_vectors
from courtside.llm.near_vectors import near_duplicates


SCHEMA = "vec_id bigint, embedding array<double>, label int, side string, cls string, dim string"


def brute(rows, least=0.98):
    """n_links and component of every row, by position."""
    n = len(rows)
    good = [bool(v) and lab is not None and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v, lab in rows]
    links = [set() for _ in range(n)]
    for i in range(n):
        for j in range(i):
            (_, a, la), (_, b, lb) = rows[i], rows[j]
            if good[i] and good[j] and la == lb and len(a) == len(b):
                a, b = np.array(a) / np.max(np.abs(a)), np.array(b) / np.max(np.abs(b))
                if a @ b / (np.sqrt(a @ a) * np.sqrt(b @ b)) >= least:
                    links[i].add(j)
                    links[j].add(i)
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for k in links[todo.pop()] - seen:
                seen.add(k)
                todo.append(k)
        ids = [rows[k][0] for k in seen if rows[k][0] is not None]
        least_id = min(ids) if ids else None
        out.append((rows[i][0], len(links[i]), least_id, rows[i][0] == least_id))
    return sorted(out, key=str)


def found(spark, rows, **kw):
    df = spark.createDataFrame([(a, b, c, "x", "y", "z") for a, b, c in rows], SCHEMA)
    return sorted((tuple(r) for r in near_duplicates(df, **kw).collect()), key=str)


def groups(n, dims, seed, labels=3, noise=0.1):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(max(1, n // 12), dims))
    x = centre[rng.integers(0, len(centre), n)] * rng.uniform(0.5, 2, (n, 1)) + noise * rng.normal(size=(n, dims))
    return [(int(i), v.tolist(), int(lab)) for i, v, lab in zip(rng.permutation(n), x, rng.integers(0, labels, n), strict=True)]


@pytest.mark.parametrize(("dims", "noise"), [(2, 0.02), (5, 0.1), (24, 0.12), (70, 0.1)])
def test_equals_brute_force(spark, dims, noise):
    rows = groups(240, dims, dims, noise=noise)
    assert found(spark, rows) == brute(rows)


def test_many_small_tiles_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(near_vectors, "TILE_BYTES", 0)  # 64 rows a tile
    rows = groups(400, 12, 5, labels=1, noise=0.12)
    assert found(spark, rows) == brute(rows)


def test_odd_rows(spark):
    big, tiny = [1e200, 0.0, 1e200], [1e-200, 0.0, 1e-200]
    rows = [(1, [1.0, 2.0, 3.0], 1), (1, [1.0, 2.0, 3.0], 1), (None, [1.0, 2.0, 3.01], 1), (4, None, 1), (5, [], 1),
            (6, [0.0, 0.0, 0.0], 1), (7, [float("nan"), 1.0, 1.0], 1), (8, [float("inf"), 1.0, 1.0], 1), (9, [None, 1.0, 1.0], 1),
            (10, [1.0, 2.0, 3.0], None), (11, [1.0, 2.0, 3.0], 2), (12, [1.0, 2.0], 1), (13, [2.0, 4.0], 1), (14, big, 3),
            (15, tiny, 3), (16, [1.0, 0.0, 1.0], 3), (17, [5e-324, 0.0, 5e-324], 3), (18, [-1.0, 0.0, -1.0], 3), (None, [0.0, 5.0], 7)]
    assert found(spark, rows) == brute(rows)


def test_pairs_at_the_threshold(spark):
    """Cosines of 0.6 exactly are links at 0.6."""
    rows = [(1, [1.0, 0.0], 1), (2, [3.0, 4.0], 1), (3, [3.0, 4.0000001], 1)]
    got = {r[0]: r[1] for r in found(spark, rows, least=0.6)}
    assert got == {1: 1, 2: 2, 3: 1}


def test_hot_group_of_copies_makes_no_pairs(spark):
    """Thousands of equal vectors are one class; near ones come back as counts, not as pairs."""
    rows = spark.range(6000).select(F.col("id").alias("vec_id"), F.array(F.lit(1.0), F.when(F.col("id") % 3 == 0, 1.0).otherwise(1.01))
                                    .alias("embedding"), F.lit(1).alias("label"))
    got = near_duplicates(rows).groupBy("n_links", "component_id").count().collect()
    assert [tuple(r) for r in got] == [(5999, 0, 6000)]


def test_empty_table(spark):
    assert found(spark, []) == []
    assert found(spark, [(3, None, 1)]) == [(3, 0, 3, True)]


def test_whole_table(spark, sf_dir):
    rows = [(r["vec_id"], [float(x) for x in r["embedding"]], r["label"]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    got = sorted((tuple(r) for r in near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet")).collect()), key=str)
    assert got == brute(rows)
