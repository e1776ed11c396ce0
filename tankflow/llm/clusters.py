"""Operator 11: centroid clustering with integer arithmetic, nearest centroids by a tournament of bisectors.

Vectors with exactly ``dims`` components, none null or non-finite, are kept, and each component x becomes the integer
floor(scale * x). For centroids a < b the bisector is an integer normal 2 (c_b - c_a) and a threshold |c_b|² - |c_a|²:
a vector v is nearer to b exactly if v.normal > threshold, and nothing else (zero difference favours the smaller
number). A vector's nearest of k centroids takes k - 1 such linear tests: the winner so far meets the next number and
one of both is out. Only the winner's distance is computed, exactly.

Centroids 0, 1, ... start as the ``k`` kept vectors with the smallest sha256 of ``seed:<vec_id>``. Each round adds up
each task's vectors by cluster; Spark adds up these sums, and only k sums reach the driver (k and dims are parameters).
A centroid moves to the componentwise floor(sum / count), an empty one stays. No vector is shuffled.

Integers: while all components are below 2**26 in size, 64 bits hold every product and sum. With larger ones tasks use
Python integers, and sums travel in limbs of 48 bits, so results stay exact; a distance or inertia that doesn't fit
a long is null.

Cases: a vector that isn't kept has no row; repeated rows count each; with the same id the vector's components decide
which comes first as centroid; a null id hashes as ``seed:``; fewer than ``k`` kept vectors make as many centroids;
no kept vectors give no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tankflow.llm.common import map_batches, materialise

DIMS, SCALE, K, ROUNDS, SEED = 64, 256, 40, 5, "2"
#: Below this size of all components 64-bit integers are exact: a distance has 64 squares of 2**54 at most.
FAST = 1 << 26
LIMB = 48


def kept(vectors: DataFrame, dims: int = DIMS, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, v) of the usable vectors."""
    v = F.col(vec_col)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(math.inf)))
    return vectors.where(v.isNotNull() & (F.size(v) == dims) & fine).select(F.col(id_col).alias("vec_id"), v.cast("array<double>").alias("v"))


def integers(column: pa.Array, dims: int, scale: int) -> np.ndarray:
    """Rows of floor(scale * x): 64-bit integers, or Python integers where a component is large."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    x = column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, dims)
    if not x.size or np.abs(x).max() < FAST / scale:
        return np.floor(x * scale).astype(np.int64)
    whole = np.empty(x.shape, object)
    for at, value in np.ndenumerate(x):
        n, d = float(value).as_integer_ratio()
        whole[at] = scale * n // d
    return whole


class Tournament:
    """Nearest of some integer centroids by bisectors."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        big = centroids.size and max(abs(int(centroids.max())), abs(int(centroids.min()))) >= FAST
        c = centroids.astype(object) if big else centroids.astype(np.int64)
        self.c = c
        square = (c * c).sum(1)
        # of the pair a < b: normals[a, b], thresholds[a, b]
        self.normals = 2 * (c[None, :, :] - c[:, None, :])
        self.thresholds = square[None, :] - square[:, None]

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest centroid and squared distance of each row."""
        best = np.zeros(len(x), np.int64)
        whole = object in (x.dtype, self.c.dtype)
        for b in range(1, len(self.c)):
            normal, limit = self.normals[best, b], self.thresholds[best, b]
            side = (x * normal).sum(1) if whole else np.einsum("ij,ij->i", x, normal)
            best[side > limit] = b
        off = x - self.c[best]
        return best, (off * off).sum(1)


def _sums(vectors: DataFrame, centroids: np.ndarray, dims: int, scale: int, limbs: int) -> dict[int, tuple[int, list[int]]]:
    """Count and componentwise sum of the vectors of each cluster."""
    shared = vectors.sparkSession.sparkContext.broadcast(centroids)
    schema = pa.schema([("cluster", pa.int32()), ("n", pa.int64()), ("s", pa.list_(pa.int64()))])

    def run(batches):
        cup, n, s = Tournament(shared.value), {}, {}
        for b in batches:
            x = integers(b.column(0), dims, scale)
            best, _ = cup.nearest(x)
            for k in np.unique(best).tolist():
                mine = x[best == k]
                n[k] = n.get(k, 0) + len(mine)
                s[k] = s.get(k, 0) + mine.sum(0)
        parts = [[(int(v) >> LIMB * i) & ((1 << LIMB) - 1) if i < limbs - 1 else int(v) >> LIMB * i for v in s[k] for i in range(limbs)]
                 for k in n]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip((list(n), list(n.values()), parts), schema)], schema=schema)

    part = vectors.select("v").mapInArrow(run, "cluster int, n long, s array<long>")
    total = part.groupBy("cluster").agg(F.sum("n").alias("n"), *[F.sum(F.col("s")[i].cast("decimal(20,0)")).alias(f"s{i}")
                                                                for i in range(dims * limbs)]).collect()  # k rows at most
    return {r.cluster: (r.n, [sum(int(r[f"s{j * limbs + i}"]) << LIMB * i for i in range(limbs)) for j in range(dims)]) for r in total}


def _array(rows: list[list[int]], dims: int) -> np.ndarray:
    """Centroids, as 64-bit integers if they fit."""
    a = np.array(rows, object).reshape(-1, dims)
    return a.astype(np.int64) if all(abs(v) < FAST for v in a.flat) else a


def cluster(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, dims: int = DIMS, scale: int = SCALE, seed: str = SEED,
            id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every kept vector."""
    some = materialise(kept(vectors, dims, id_col, vec_col))
    out = f"vec_id {some.schema['vec_id'].dataType.simpleString()}, cluster int, distance long"
    salted = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    first = some.orderBy(salted, "vec_id", "v").limit(k).select("v").toArrow()  # k rows
    centroids = _array(integers(first.column("v"), dims, scale).tolist(), dims)
    largest = some.agg(F.max(F.array_max(F.transform("v", F.abs)))).first()[0] or 0.0
    bits = math.frexp(largest * scale if largest < 1e300 else largest)[1] + (scale.bit_length() if largest >= 1e300 else 0)
    limbs = 1 if largest < FAST / scale else 2 + bits // LIMB  # the last one holds what many rows add up to
    for _ in range(rounds if len(centroids) else 0):
        moved = centroids.tolist()
        for c, (n, s) in _sums(some, centroids, dims, scale, limbs).items():
            moved[c] = [v // n for v in s]
        centroids = _array(moved, dims)
    shared = some.sparkSession.sparkContext.broadcast(centroids)

    def make():
        cup = Tournament(shared.value)

        def f(b: pa.RecordBatch) -> list:
            best, distance = cup.nearest(integers(b.column(1), dims, scale))
            return [b.column(0), best.tolist(), [v if v < 1 << 63 else None for v in distance.tolist()]]
        return f

    found = materialise(map_batches(some, make, out))
    # a sum with a null in it is null, and so is one that doesn't fit
    total = lambda c: F.when(F.count(c) == F.count(F.lit(1)), F.sum(F.col(c).cast("decimal(38,0)")))
    by = {r.cluster: r.d for r in found.groupBy("cluster").agg(total("distance").alias("d")).collect()}  # k rows at most
    fits = lambda v: None if v is None or v >= 1 << 63 else int(v)
    whole = None if None in by.values() else sum(by.values())
    digest = [hashlib.sha256(",".join(str(int(v)) for v in c).encode()).hexdigest() for c in centroids.tolist()]
    of = lambda values, kind: F.element_at(F.array(*[F.lit(v).cast(kind) for v in values] or [F.lit(None).cast(kind)]), F.col("cluster") + 1)
    return found.select("vec_id", "cluster", "distance", of([fits(by.get(i)) for i in range(len(centroids))], "long").alias("cluster_inertia"),
                        F.lit(fits(whole)).cast("long").alias("inertia"), of(digest, "string").alias("centroid_sha256"))
