"""Near-duplicate vectors by PCA-ordered tiled comparison (cosine at or above a threshold).

1. Rows with equal label and equal vector are one class with a weight, counted before anything is
   compared: copies are never expanded into pairs.
2. The principal axes come from the second moments of all classes (a sum per task). Any orthonormal
   axes give the same links; these put most of a product into the leading coordinates.
3. The classes of a label stand in the order of their leading coordinates (slabs as wide as the
   largest distance of a link) and are cut into tiles of bounded size, so a hot label is many tiles.
   Two tiles meet only if their boxes in the leading coordinates are within that distance.
4. Inside a pair of tiles, blocks accumulate the products of the leading coordinates first. The
   product of the suffix norms bounds what is left: a pair stops as soon as its cosine cannot reach
   the threshold, or cannot stay below it. Pairs that the coordinates leave within 1e-9 of the
   threshold are decided on the vectors themselves.
5. Each pair of tiles returns, per class, the number of its links and one class of its component
   there, never the pairs themselves.

Work: quadratic in the rows of a label that are alike in the leading coordinates; a tile travels
once for every tile near it.

Defined results: a null, empty or zero vector, one that holds null or non-finite components and a
row without a label link with nothing and are components of their own; vectors of different length
do not link; very large and very small components are scaled first; repeated rows are vectors of
their own that link; a null id names a component only if all ids in it are null; ``kept`` is
whether the row's id is its component's; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_batches, discard, running_totals, written
from .components import connected_components

LEAD = 8              # coordinates that order and bound tiles, and that a block accumulates first
TILE_BYTES = 2 << 20  # of vectors in a tile
BLOCK = 512
SLACK = 1e-9
PART = ["label", "dim"]


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows divided by the power of two of their largest component: squares neither overflow nor vanish."""
    x = x.astype(np.float64)
    if not x.size:
        return x
    return np.ldexp(x, -np.frexp(np.abs(x).max(1))[1][:, None])


def unit(x: np.ndarray) -> np.ndarray:
    x = scaled(x)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Cosine of each row of x with the same row of y."""
    x, y = scaled(x), scaled(y)
    return (x * y).sum(1) / (np.sqrt((x * x).sum(1)) * np.sqrt((y * y).sum(1)))


def unpacked(column, dtype: str) -> np.ndarray:
    data = column.to_pylist()
    return np.frombuffer(b"".join(data), dtype).reshape(len(data), -1)


def keyed(rows: DataFrame, dtype: str) -> DataFrame:
    """``vec_id, label, dim, digest, packed``; the last three are null where a vector takes no part."""
    v = F.col("vector")
    good = F.col("label").isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) \
        & F.exists(v, lambda x: x != 0.0)
    rows = rows.withColumn("vector", F.when(good, v))

    def run(batches):
        for batch in batches:
            lists = batch.column("vector")
            flat = np.asarray(lists.flatten(), dtype)
            size = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            ends = np.cumsum(size)
            packed = [flat[e - n:e].tobytes() if n else None for n, e in zip(size, ends, strict=True)]
            yield pa.RecordBatch.from_arrays([
                batch.column("vec_id"), batch.column("label"), pa.array([n or None for n in size.tolist()], pa.int32()),
                pa.array([x and hashlib.blake2b(x, digest_size=16).digest() for x in packed], pa.binary()),
                pa.array(packed, pa.binary())], names=["vec_id", "label", "dim", "digest", "packed"])

    schema = T.StructType([T.StructField("vec_id", T.LongType()), rows.schema["label"], T.StructField("dim", T.IntegerType()),
                           T.StructField("digest", T.BinaryType()), T.StructField("packed", T.BinaryType())])
    return rows.select("vec_id", "label", "vector").mapInArrow(run, schema)


def principal_axes(classes: DataFrame, dims: int, dtype: str) -> np.ndarray:
    """Axes (columns) in the order of the second moments along them, over all classes. Shorter vectors
    count as filled with zeros, which changes no product."""
    def run(batches):
        total = np.zeros((dims, dims))
        for batch in batches:
            by_size: dict[int, list[bytes]] = {}
            for x in batch.column(0).to_pylist():
                by_size.setdefault(len(x), []).append(x)
            for data in by_size.values():
                x = unit(np.frombuffer(b"".join(data), dtype).reshape(len(data), -1))
                total[:x.shape[1], :x.shape[1]] += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))],
                                         names=["i", "sums"])

    sums = classes.select("packed").mapInArrow(run, "i int, sums array<double>").select("i", F.posexplode("sums").alias("j", "x"))
    # dims * dims rows, whatever the table's size.
    found = sums.groupBy("i", "j").agg(F.sum("x").alias("x")).toArrow()
    moments = np.zeros((dims, dims))
    moments[found["i"].to_numpy(), found["j"].to_numpy()] = found["x"].to_numpy()
    value, axes = np.linalg.eigh((moments + moments.T) / 2)
    return axes[:, np.argsort(-value, kind="stable")]


def along(x: np.ndarray, axes: np.ndarray) -> np.ndarray:
    return unit(x) @ axes[:x.shape[1]]


def ordered(classes: DataFrame, axes: np.ndarray, reach: float, dtype: str) -> DataFrame:
    """Classes with their leading coordinates ``z`` and their tile."""
    lead = min(LEAD, axes.shape[1])
    names = ["cls", *PART, "weight", "packed"]

    def run(batches):
        for batch in batches:
            z = np.zeros((batch.num_rows, LEAD))
            size = np.asarray(batch.column("dim"))
            for n in np.unique(size):
                at = np.flatnonzero(size == n)
                z[at, :lead] = along(unpacked(batch.column("packed").take(pa.array(at)), dtype), axes[:, :lead])
            slab = np.floor(z[:, :2] / reach).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                *(batch.column(c) for c in names), pa.array(list(z), pa.list_(pa.float64())), pa.array(slab[:, 0]),
                pa.array(slab[:, 1]), pa.array(z[:, 2])], names=[*names, "z", "slab_1", "slab_2", "z_3"])

    schema = T.StructType([classes.schema[c] for c in names] + [
        T.StructField("z", T.ArrayType(T.DoubleType())), T.StructField("slab_1", T.IntegerType()),
        T.StructField("slab_2", T.IntegerType()), T.StructField("z_3", T.DoubleType())])
    placed = classes.select(*names).mapInArrow(run, schema)
    placed = running_totals(placed, ["slab_1", "slab_2", "z_3", "cls"], [], PART)
    rows = F.greatest(F.lit(64), F.floor(F.lit(TILE_BYTES) / (F.col("dim") * np.dtype(dtype).itemsize)))
    return placed.select(*names, "z", F.floor(F.col("row_index") / rows).alias("tile"))


def tile_pairs(placed: DataFrame, reach: float) -> DataFrame:
    """``label, dim, p, q`` (p <= q) of the tiles whose boxes are within ``reach`` of each other."""
    axis = lambda f: F.array(*[f(F.col("z")[i]) for i in range(LEAD)])
    tiles = written(placed.groupBy(*PART, "tile").agg(axis(F.min).alias("lo"), axis(F.max).alias("hi")), "tiles")
    slabs = lambda lo, hi: F.explode(F.sequence(F.floor(lo / reach), F.floor(hi / reach)))
    side = lambda x, at: tiles.select(*PART, F.col("tile").alias(x), F.col("lo").alias(f"lo_{x}"),
                                      F.col("hi").alias(f"hi_{x}"), at.alias("slab"))
    near = side("p", slabs(F.col("lo")[0], F.col("hi")[0])).join(
        side("q", slabs(F.col("lo")[0] - reach, F.col("hi")[0] + reach)), [*PART, "slab"]).filter("p <= q")
    gaps = F.zip_with(F.zip_with("lo_p", "hi_q", lambda a, b: a - b), F.zip_with("lo_q", "hi_p", lambda a, b: a - b),
                      lambda a, b: F.greatest(a, b, F.lit(0.0)))
    far = F.aggregate(gaps, F.lit(0.0), lambda total, gap: total + gap * gap)
    return written(near.filter(far <= reach * reach).select(*PART, "p", "q").distinct(), "tile-pairs")


class Forest:
    """Union of nodes by arrays of numbers."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = x = self.up[self.up[x]]
        return x

    def join(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        self.up[max(a, b)] = min(a, b)


def block_links(a: np.ndarray, b: np.ndarray, tail_a: np.ndarray, tail_b: np.ndarray, cuts: list[int], least: float) -> tuple:
    """Links (boolean matrix) between the rows of two blocks of coordinates, and the pairs left to be
    decided on the vectors. ``tail_*`` are norms of what lies beyond each cut."""
    dots = a[:, :cuts[0]] @ b[:, :cuts[0]].T
    rest = tail_a[:, 0, None] * tail_b[None, :, 0]
    links = dots - rest >= least + SLACK
    open_ = (dots + rest >= least - SLACK) & ~links
    k = 1
    while k < len(cuts) and open_.any():
        part = slice(cuts[k - 1], cuts[k])
        if 8 * np.count_nonzero(open_) < open_.size:
            break
        dots += a[:, part] @ b[:, part].T
        rest = tail_a[:, k, None] * tail_b[None, :, k]
        sure = open_ & (dots - rest >= least + SLACK)
        links |= sure
        open_ &= (dots + rest >= least - SLACK) & ~sure
        k += 1
    row, col = np.nonzero(open_)
    dot = dots[row, col]
    for k in range(k, len(cuts)):  # few pairs are left: one by one
        if not len(row):
            break
        part = slice(cuts[k - 1], cuts[k])
        dot = dot + np.einsum("ij,ij->i", a[row, part], b[col, part])
        rest = tail_a[row, k] * tail_b[col, k]
        sure = dot - rest >= least + SLACK
        links[row[sure], col[sure]] = True
        left = ~sure & (dot + rest >= least - SLACK)
        row, col, dot = row[left], col[left], dot[left]
    return links, row, col


def components_of(links: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Component numbers of the rows and columns of a block of links; -1 without links."""
    n, m = links.shape
    far = n + m
    rows, cols = np.where(links.any(1), np.arange(n), far), np.full(m, far)
    while True:
        new_cols = np.minimum(cols, np.where(links, rows[:, None], far).min(0))
        new_rows = np.minimum(rows, np.where(links, new_cols[None], far).min(1))
        if (new_cols == cols).all() and (new_rows == rows).all():
            return np.where(rows < far, rows, -1), np.where(cols < far, cols, -1)
        rows, cols = new_rows, new_cols


def compare_tiles(table: pa.Table, axes: np.ndarray, least: float, dtype: str) -> pa.Table:
    """``cls, links, root`` of every class that links, in one pair of tiles (or in one tile)."""
    table = table.combine_chunks()
    side = table.column("side").to_numpy()
    x = unpacked(table.column("packed"), dtype)
    z = along(x, axes)
    order = np.lexsort((z[:, 0], side))
    side, x, z = side[order], x[order], z[order]
    cls, weight = table.column("cls").to_numpy()[order], table.column("weight").to_numpy()[order]
    width = x.shape[1]
    cuts = sorted({min(width, LEAD << k) for k in range(32) if LEAD << k < 2 * width} | {width})
    after = np.cumsum((z * z)[:, ::-1], 1)[:, ::-1]
    # Rounding must not make a tail shorter than it is.
    tails = np.stack([np.sqrt(after[:, c]) + 1e-12 if c < z.shape[1] else np.zeros(len(z)) for c in cuts], 1)
    reach = np.sqrt(max(0.0, 2 - 2 * least)) + 1e-6
    n = int((side == 0).sum())
    alone = n == len(side)
    counts, forest = np.zeros(len(side), np.int64), Forest(len(side))
    firsts = [slice(k, min(k + BLOCK, n)) for k in range(0, n, BLOCK)]
    seconds = firsts if alone else [slice(k, min(k + BLOCK, len(side))) for k in range(n, len(side), BLOCK)]
    for a in firsts:
        for b in seconds:
            if (alone and b.start < a.start) or z[b.start, 0] > z[a.stop - 1, 0] + reach or z[a.start, 0] > z[b.stop - 1, 0] + reach:
                continue
            links, row, col = block_links(z[a], z[b], tails[a], tails[b], cuts, least)
            if len(row):
                links[row, col] = cosines(x[a][row], x[b][col]) >= least
            if a == b:
                links = np.triu(links, 1)
            if not links.any():
                continue
            counts[a] += links @ weight[b]
            counts[b] += links.T @ weight[a]
            for at, found in zip((a, b), components_of(links), strict=True):
                for k in np.flatnonzero(found >= 0).tolist():
                    forest.join(at.start + k, a.start + int(found[k]))
    linked = np.flatnonzero(counts)
    roots = np.array([forest.root(k) for k in linked.tolist()], np.int64)
    return pa.table({"cls": pa.array(cls[linked], pa.int64()), "links": pa.array(counts[linked], pa.int64()),
                     "root": pa.array(cls[roots], pa.int64())})


def near_duplicates(embeddings: DataFrame, least: float = 0.98, id_col: str = "vec_id", vector_col: str = "embedding",
                    label_col: str = "label") -> DataFrame:
    """One row per row: ``vec_id, n_links, component_id, kept``. Rows of equal label link when the cosine
    of their vectors is at least ``least``."""
    spark = embeddings.sparkSession
    single = embeddings.schema[vector_col].dataType == T.ArrayType(T.FloatType())
    dtype = "<f4" if single else "<f8"
    rows = embeddings.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(label_col).alias("label"),
                             F.col(vector_col).cast("array<float>" if single else "array<double>").alias("vector"))
    reach = float(np.sqrt(max(0.0, 2 - 2 * least))) + 1e-6
    with arrow_batches(spark, 4096, 8):
        known = keyed(rows, dtype)
        classes = known.filter("digest IS NOT NULL").groupBy(*PART, "digest").agg(
            F.min("vec_id").alias("first_id"), F.count(F.lit(1)).alias("weight"), F.first("packed").alias("packed"))
        classes = written(classes.withColumn("cls", F.monotonically_increasing_id()), "classes")
        dims = classes.agg(F.max("dim")).first()[0]
        axes = principal_axes(classes, dims, dtype) if dims else np.zeros((1, 1))
        placed = written(ordered(classes, axes, reach, dtype), "placed")
        members = written(known.drop("packed"), "members")
    pairs = tile_pairs(placed, reach)
    tiles = placed.select(*PART, "tile", "cls", "weight", "packed")
    first = tiles.withColumnRenamed("tile", "p").join(pairs, [*PART, "p"]).withColumn("side", F.lit(0))
    second = tiles.withColumnRenamed("tile", "q").join(pairs.filter("p < q"), [*PART, "q"]).withColumn("side", F.lit(1))
    met = written(first.unionByName(second).groupBy(*PART, "p", "q").applyInArrow(
        lambda t: compare_tiles(t, axes, least, dtype), "cls bigint, links bigint, root bigint"), "met")
    discard(placed, pairs)
    labels = connected_components(met.filter("cls <> root"), "cls", "root")
    named = classes.select("cls", *PART, "digest", "first_id", "weight") \
        .join(met.groupBy("cls").agg(F.sum("links").alias("links")), "cls", "left") \
        .join(labels.select(F.col("node").alias("cls"), F.col("label").alias("component")), "cls", "left") \
        .withColumn("component", F.coalesce("component", "cls"))
    least_id = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = named.join(least_id, "component").select(
        *PART, "digest", "component_id", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    out = members.join(named, [*PART, "digest"], "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.when(F.col("digest").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
