"""Approximate nearest neighbours by balanced posting lists (cosine).

Fitting: at most ``FIT_ROWS`` vectors, those of the least hashes, are halved again and again along
the line between two means, at the median, so the lists are balanced; a list's mean direction is
its centroid, at most ``MAX_LISTS`` of them. Indexing: every vector goes to its nearest centroid
and, near a boundary, to up to ``copies`` lists whose distance is within a ratio of the nearest and
that are not behind a list already chosen. Centroids are found by a walk of an in-memory graph of near
centroids, a batch of vectors at a time: all that are within a ratio of the nearest one so far pass
the walk on to their neighbours. Searching: a query reads every list whose centroid is within ``reach``
times the distance of its nearest one; without a ``reach`` it reads all lists, which is exact. Lists and
their queries are cut into blocks of bounded size, which meet block by block; the best of each block
are merged per query.

Equal vectors share their scores, and ties go to the smaller id, so only the k + 1 least ids of
equal vectors are indexed: the others can be in no result.

Defined results: vectors that are null, zero, or hold null or non-finite components take no part, nor
do rows without an id; a query's candidates are the vectors of its own length; components are scaled
by a power of two before they are multiplied; of rows with equal ids and vectors one counts; an empty
table gives no rows; fewer candidates than k give all; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import top_k_per_group
from .common import arrow_batches, uniform, written

FIT_ROWS = 1 << 17
MAX_LISTS = 1 << 13
LIST_ROWS = 256
BLOCK = 2048
SPREAD = 1.15  # distance ratio within which a vector is replicated
COPIES = 4     # lists of a vector at most; a list further on is found by the queries' reach
REACH = 1.3    # distance ratio within which a query reads a list


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows divided by the power of two of their largest component: squares neither overflow nor vanish."""
    x = x.astype(np.float64)
    return np.ldexp(x, -np.frexp(np.abs(x).max(1, initial=0.0))[1][:, None]) if len(x) else x


def unit(x: np.ndarray) -> np.ndarray:
    x = scaled(x)
    return (x / np.sqrt((x * x).sum(1, keepdims=True))).astype(np.float32)


@dataclass
class Centroids:
    """Unit centroids, the graph of their near neighbours, and where walks begin."""

    points: np.ndarray
    near: np.ndarray
    entries: np.ndarray

    @classmethod
    def fit(cls, sample: np.ndarray, lists: int, degree: int = 32) -> Centroids:
        parts, rng = [unit(sample)], np.random.default_rng(7)
        while len(parts) < lists:
            parts.sort(key=len)
            part = parts.pop()
            if len(part) < 2:
                parts.append(part)
                break
            a, b = part[rng.choice(len(part), 2, replace=False)]
            for _ in range(6):
                side = part @ (a - b)
                cut = np.median(side)
                left = side > cut
                if not left.any() or left.all():
                    left = np.arange(len(part)) < len(part) // 2
                a, b = part[left].mean(0), part[~left].mean(0)
            parts += [part[left], part[~left]]
        means = np.stack([p.mean(0) for p in parts])
        size = np.sqrt((means * means).sum(1, keepdims=True))
        points = (means / np.maximum(size, 1e-12)).astype(np.float32)
        near = np.stack([np.argsort(-(points @ p), kind="stable")[:degree + 1] for p in points]).astype(np.int32)
        # Walks begin at the best of an even choice over the tree of halves.
        entries = np.unique(np.linspace(0, len(points) - 1, max(8, int(len(points) ** 0.5))).astype(np.int32))
        return cls(points, near, entries)

    def within(self, x: np.ndarray, ratio: float) -> np.ndarray:
        """Distances (rows x centroids, infinite where the walk does not come) of unit rows to the centroids; the
        walk goes on from all centroids within ``ratio`` of a row's nearest one so far."""
        distance = np.full((len(x), len(self.points)), np.inf)

        def visit(rows: np.ndarray, which: np.ndarray) -> None:
            for k in range(0, len(rows), 1 << 16):
                r, c = rows[k:k + (1 << 16)], which[k:k + (1 << 16)]
                distance[r, c] = np.sqrt(np.maximum(0, 2 - 2 * np.einsum("nd,nd->n", x[r], self.points[c]).astype(np.float64)))

        rows, which = np.repeat(np.arange(len(x)), len(self.entries)), np.tile(self.entries, len(x))
        while len(rows):
            visit(rows, which)
            best = distance.min(1)
            go = distance[rows, which] <= ratio * best[rows] + 1e-9
            rows, which = np.repeat(rows[go], self.near.shape[1]), self.near[which[go]].ravel()
            fresh = np.isinf(distance[rows, which])
            key = np.unique(rows[fresh] * len(self.points) + which[fresh])
            rows, which = key // len(self.points), key % len(self.points)
        return distance

    def lists_of(self, x: np.ndarray, ratio: float | None, most: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(row, list) for each row's lists within ``ratio`` of its nearest (None: all). With ``most``, no more than
        that, without those that lie nearer to a list already chosen than to the row."""
        if ratio is None:
            return np.repeat(np.arange(len(x)), len(self.points)), np.tile(np.arange(len(self.points), dtype=np.int32), len(x))
        distance = self.within(x, ratio)
        keep = distance <= ratio * distance.min(1, keepdims=True) + 1e-9
        if most is None:
            row, which = np.nonzero(keep)
            return row, which.astype(np.int32)
        most = min(most, len(self.points))
        ids = np.argsort(distance, 1, kind="stable")[:, :most].astype(np.int32)
        dist, keep = np.take_along_axis(distance, ids, 1), np.take_along_axis(keep, ids, 1)
        for j in range(1, most):
            for i in range(j):
                between = np.sqrt(np.maximum(0, 2 - 2 * (self.points[ids[:, i]] * self.points[ids[:, j]]).sum(1)))
                keep[:, j] &= ~(keep[:, i] & (between < dist[:, j]))
        return np.nonzero(keep)[0], ids[keep]


def usable(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id, vector`` (doubles) of the rows that take part, each pair once."""
    v = F.col("vector")
    rows = rows.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
                       & F.exists(v, lambda x: x != 0.0))
    return rows.dropDuplicates(["vec_id", "vector"])


def _matrix(column, width: int) -> np.ndarray:
    """Rows of a list column, shorter ones filled up with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat, size = np.asarray(column.flatten(), np.float64), np.asarray(column.value_lengths(), np.int64)
    out = np.zeros((len(size), width))
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


def fit(rows: DataFrame, width: int) -> Centroids:
    """Centroids from a bounded sample, collected: at most FIT_ROWS vectors."""
    n = rows.count()
    lists = min(MAX_LISTS, max(1, n // LIST_ROWS))
    wanted = min(FIT_ROWS, 64 * lists + 1024)
    draw = uniform("fit", F.col("vec_id"))
    # Little more than the sample travels to be ranked.
    chosen = rows.filter(draw < min(1.0, 2.0 * wanted / max(1, n))).orderBy(draw, "vec_id").limit(wanted)
    sample = chosen.select("vector").toArrow().column("vector")
    return Centroids.fit(_matrix(sample, width), lists)


def into_lists(rows: DataFrame, centroids: Centroids, ratio: float | None, most: int | None = None) -> DataFrame:
    """``list, vec_id, packed``: a row for each list that a vector belongs to or reads. Vectors of different
    length are in different lists."""
    lists, width = centroids.points.shape

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                vectors = part.column(1)
                size = np.asarray(vectors.value_lengths(), np.int64)
                x = _matrix(vectors, width)
                row, which = centroids.lists_of(unit(x), ratio, most)
                packed = [v[:n].tobytes() for v, n in zip(x, size.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([
                    pa.array(size[row] * lists + which, pa.int64()), part.column(0).take(pa.array(row)),
                    pa.array([packed[k] for k in row.tolist()], pa.binary())], names=["list", "vec_id", "packed"])

    return rows.select("vec_id", "vector").mapInArrow(run, "list bigint, vec_id bigint, packed binary")


def _rows(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    packed = table.column("packed").to_pylist()
    return table.column("vec_id").to_numpy(), np.frombuffer(b"".join(packed), np.float64).reshape(len(packed), -1)


def best_of_block(queries: pa.Table, posting: pa.Table, k: int) -> pa.Table:
    """The k nearest rows of a block for each of its queries, scored in double precision."""
    out: list[list[np.ndarray]] = [[], [], []]
    if queries.num_rows and posting.num_rows:
        q_ids, q = _rows(queries)
        p_ids, p = _rows(posting)
        q, p = scaled(q), scaled(p)
        q_len, p_len = np.sqrt((q * q).sum(1)), np.sqrt((p * p).sum(1))
        for at in range(0, len(q), 512):
            part = slice(at, at + 512)
            rough = (q[part] / q_len[part, None]) @ (p / p_len[:, None]).T
            rough[q_ids[part, None] == p_ids[None]] = -np.inf
            if len(p) > k:
                limit = -np.partition(-rough, k - 1, 1)[:, k - 1] - 1e-9  # the exact order is found among these
                row, col = np.nonzero((rough >= limit[:, None]) & np.isfinite(rough))
            else:
                row, col = np.nonzero(np.isfinite(rough))
            score = (q[part][row] * p[col]).sum(1) / (q_len[part][row] * p_len[col])
            order = np.lexsort((p_ids[col], -score, row))
            row, col, score = row[order], col[order], score[order]
            place = np.arange(len(row)) - np.searchsorted(row, row)
            for a, b in zip(out, (q_ids[part][row], p_ids[col], score), strict=True):
                a.append(b[place < k])
    kinds = (pa.int64(), pa.int64(), pa.float64())
    return pa.table({c: pa.array(np.concatenate(x) if x else [], t)
                     for c, x, t in zip(("query_id", "vec_id", "score"), out, kinds, strict=True)})


def search(embeddings: DataFrame, is_query, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
           reach: float | None = REACH) -> DataFrame:
    """The k nearest rows (largest cosine) of every row for which ``is_query`` holds, its own id left out:
    ``query_id, rank, vec_id, score``. ``reach`` None compares with all rows."""
    spark = embeddings.sparkSession
    rows = written(usable(embeddings, id_col, vector_col), "vectors")
    indexed = written(top_k_per_group(rows, ["vector"], [F.col("vec_id").asc()], k + 1, "copy_no").drop("copy_no"), "indexed")
    width = indexed.agg(F.max(F.size("vector"))).first()[0]
    if width is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    centroids = fit(indexed, width)
    with arrow_batches(spark, 2048, 16):
        posting = written(into_lists(indexed, centroids, SPREAD, COPIES), "posting")
        queries = written(into_lists(rows.filter(is_query(F.col("vec_id"))), centroids, reach), "queries")
    blocks = lambda d, name: d.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias(name))
    # At most MAX_LISTS rows for each length of vectors.
    sizes = blocks(posting, "p_blocks").join(blocks(queries, "q_blocks"), "list")
    deal = lambda n: F.pmod(F.xxhash64("vec_id"), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    keys = ["list", "p", "q"]
    posting = posting.join(F.broadcast(sizes), "list").withColumn("p", deal("p_blocks")).withColumn("q", each("q_blocks"))
    queries = queries.join(F.broadcast(sizes), "list").withColumn("q", deal("q_blocks")).withColumn("p", each("p_blocks"))
    found = queries.select(*keys, "vec_id", "packed").groupBy(*keys).cogroup(
        posting.select(*keys, "vec_id", "packed").groupBy(*keys)).applyInArrow(
        lambda q, p: best_of_block(q, p, k), "query_id bigint, vec_id bigint, score double")
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return top_k_per_group(found, ["query_id"], [F.col("score").desc(), F.col("vec_id").asc()], k) \
        .select("query_id", "rank", "vec_id", "score")
