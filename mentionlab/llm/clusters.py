"""Operator 11: centroid clustering, exact, with geometrically tightened bounds.

Every vector keeps an upper bound of the distance to its own centroid and a lower bound of
the distance to all others.  When centroids move, bounds are loosened without looking at the
vector.  Full drift would take the whole way that a centroid went.  Here each cluster is
a sphere around its old centroid (its radius is the largest upper bound of its members), and
what a member can lose towards a moved centroid is bounded in the plane through the sphere's
centre and the centroid's old and new place: a point x that sees the way old -> new from the way's
midpoint under the angle t has |x - old| - |x - new| <= |new - old| * cos(t) (the points of
equal difference lie on a hyperbola inside the cone of its asymptotes), and the sphere bounds t
from below.  A vector whose bounds still separate stays where it is; of the ambiguous ones the
own distance is computed first, and those that stay ambiguous are compared with all centroids.

Arithmetic is exact: components and centroids are integers, distances are computed in
doubles only where every sum stays below 2^52, else in Python integers.  Bounds are
doubles with a margin far above their rounding, so they only ever cost a scan.

Each pass reads and writes the vectors with their bounds as a table in the shared folder, so a lost
executor repeats its part of one pass.  Per task and cluster one row of sums goes into a
shuffle; the driver sees k rows a dimension.  Nothing is gathered by cluster, so a hot cluster
is as spread as its vectors.

Defined cases: vectors that are null, of another length, or hold null or non-finite components
take no part; a null id counts as empty text where starting vectors are drawn; repeated rows are
vectors of their own; fewer vectors than k give as many centroids; an empty cluster's centroid
stays; ties go to the smaller number; distances beyond 2^63 - 1 are given as that; no vectors, no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mentionlab.llm.common import written

EXACT = 2.0 ** 22  # 64 squares of differences of such components stay below 2^53
MARGIN = 1e-9
LIMB = 40          # sums cross the shuffle in limbs of 40 bits
LONGEST = 2 ** 63 - 1


def tight_loss(centre: np.ndarray, radius: float, old: np.ndarray, new: np.ndarray) -> float:
    """An upper bound, at most |new - old|, of |x - old| - |x - new| for all x within ``radius`` of ``centre``."""
    way = new - old
    length = float(np.linalg.norm(way))
    if length == 0.0:
        return 0.0
    spoke = centre - (old + new) / 2
    off = float(np.linalg.norm(spoke))
    if off <= radius * (1 + MARGIN):
        return length * (1 + MARGIN)
    angle = np.arccos(np.clip(spoke @ way / (off * length), -1.0, 1.0)) - np.arcsin(min(radius / off, 1.0)) - MARGIN
    return length * max(float(np.cos(max(angle, 0.0))), 0.0) * (1 + MARGIN) + length * MARGIN


def _small(*arrays: np.ndarray) -> bool:
    return all(a.size == 0 or float(np.abs(a).max()) <= EXACT for a in arrays)


def _integers(x: np.ndarray) -> np.ndarray:
    return np.array([[int(v) for v in row] for row in x], dtype=object).reshape(x.shape)


def squared(x: np.ndarray, centroids: list[list[int]]) -> np.ndarray:
    """Exact squared distances of the rows of ``x`` (doubles that are integers) to all centroids."""
    c = np.array(centroids, dtype=np.float64)
    if _small(x, c):
        return (x * x).sum(axis=1)[:, None] - 2 * (x @ c.T) + (c * c).sum(axis=1)[None, :]
    xi = _integers(x)
    ci = np.array(centroids, dtype=object)
    return np.stack([((xi - row) ** 2).sum(axis=1) for row in ci], axis=1)


def _own_squared(x: np.ndarray, centroids: list[list[int]], cluster: np.ndarray) -> np.ndarray:
    c = np.array(centroids, dtype=np.float64)
    if _small(x, c):
        return ((x - c[cluster]) ** 2).sum(axis=1)
    return ((_integers(x) - np.array(centroids, dtype=object)[cluster]) ** 2).sum(axis=1)


def _roots(squares: np.ndarray) -> np.ndarray:
    return np.sqrt(squares.astype(np.float64))


def _scan(x: np.ndarray, centroids: list[list[int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Nearest centroid (the first of equal ones), its squared distance, upper and lower bound."""
    d = squared(x, centroids)
    near = d.argmin(axis=1) if d.dtype != object else np.array([min(range(len(r)), key=r.__getitem__) for r in d], dtype=int)
    rows = np.arange(len(x))
    best = d[rows, near]
    if d.shape[1] == 1:
        low = np.full(len(x), np.inf)
    else:
        rest = d.copy()
        rest[rows, near] = np.inf if d.dtype != object else max(max(r) for r in d) + 1
        low = _roots(rest.min(axis=1)) * (1 - MARGIN)
    return near, best, _roots(best) * (1 + MARGIN), low


def _vectors(column: pa.ChunkedArray | pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims)


def _lists(x: np.ndarray) -> pa.Array:
    offsets = np.arange(0, x.size + 1, x.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(x.reshape(-1)))


def _schema(kept: pa.Schema) -> pa.Schema:
    return pa.schema([*kept, ("v", pa.list_(pa.float64())), ("cluster", pa.int32()), ("upper", pa.float64()),
                      ("lower", pa.float64()), ("square", pa.int64()), ("scans", pa.int32())])


def _state(batch: pa.RecordBatch, kept: int, x: np.ndarray, cluster, upper, lower, square, scans) -> pa.RecordBatch:
    arrays = [batch.column(i) for i in range(kept)]
    if square.dtype == object:
        square = np.array([min(int(s), LONGEST) for s in square], dtype=np.int64)
    arrays += [_lists(x), pa.array(cluster.astype(np.int32)), pa.array(upper), pa.array(lower),
               pa.array(square.astype(np.int64)), pa.array(scans.astype(np.int32))]
    return pa.RecordBatch.from_arrays(arrays, schema=_schema(pa.schema(list(batch.schema)[:kept])))


def _first_pass(centroids: list[list[int]], kept: int, dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = _vectors(b.column("v"), dims)
                near, best, up, low = _scan(x, centroids)
                yield _state(b, kept, x, near, up, low, best, np.ones(len(x)))
    return run


def _next_pass(centroids: list[list[int]], grow: np.ndarray, loosen: np.ndarray, kept: int, dims: int, last: bool):
    """Loosens the bounds, and scans the vectors that they no longer separate."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = _vectors(b.column("v"), dims)
            cluster = b.column("cluster").to_numpy().astype(np.int64)
            up = b.column("upper").to_numpy() + grow[cluster]
            low = b.column("lower").to_numpy() - loosen[cluster]
            scans = b.column("scans").to_numpy().copy()
            square = np.zeros(len(x), dtype=np.float64)
            open_ = np.flatnonzero(up >= low)
            if len(open_):  # the own distance, exact
                up[open_] = _roots(_own_squared(x[open_], centroids, cluster[open_])) * (1 + MARGIN)
                open_ = open_[up[open_] >= low[open_]]
            if len(open_):
                near, _, u, lo = _scan(x[open_], centroids)
                cluster[open_], up[open_], low[open_] = near, u, lo
                scans[open_] += 1
            if last:
                square = _own_squared(x, centroids, cluster)
            yield _state(b, kept, x, cluster, up, low, square, scans)
    return run


_SUMS = pa.schema([("cluster", pa.int32()), ("limb", pa.int32()), ("count", pa.int64()), ("radius", pa.float64()),
                   ("sums", pa.list_(pa.int64()))])


def _partial_sums(k: int, dims: int):
    """A task's members, radius and sums of every cluster; sums in limbs of 40 bits."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [[0] * dims for _ in range(k)]
        counts, radius = [0] * k, [0.0] * k
        for b in batches:
            if not b.num_rows:
                continue
            x = _vectors(b.column("v"), dims)
            cluster, up = b.column("cluster").to_numpy(), b.column("upper").to_numpy()
            small = _small(x)
            for c in np.unique(cluster):
                own = cluster == c
                part = x[own].sum(axis=0) if small else _integers(x[own]).sum(axis=0)
                sums[c] = [s + int(p) for s, p in zip(sums[c], part, strict=True)]
                counts[c] += int(own.sum())
                radius[c] = max(radius[c], float(up[own].max()))
        rows = []
        for c in range(k):
            rest, limb = sums[c], 0
            while counts[c] and (limb == 0 or any(rest)):
                low = [abs(s) % (1 << LIMB) * (1 if s >= 0 else -1) for s in rest]
                rows.append((c, limb, counts[c] if limb == 0 else 0, radius[c], low))
                rest = [(abs(s) >> LIMB) * (1 if s >= 0 else -1) for s in rest]
                limb += 1
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(col), type=f.type) for col, f in zip(zip(*rows, strict=True), _SUMS, strict=True)], schema=_SUMS)
    return run


def _moved(state: DataFrame, centroids: list[list[int]], dims: int) -> tuple[list[list[int]], list[float]]:
    """The centroids after a round, and the radius of every cluster's sphere around its old one."""
    k = len(centroids)
    parts = state.select("v", "cluster", "upper").mapInArrow(
        _partial_sums(k, dims), "cluster int, limb int, count long, radius double, sums array<long>")
    per = parts.groupBy("cluster", "limb").agg(
        F.sum("count").alias("count"), F.max("radius").alias("radius"),
        F.array(*[F.sum(F.col("sums")[i]) for i in range(dims)]).alias("sums"))
    new, radius, total, counts = list(centroids), [0.0] * k, {}, [0] * k
    for r in per.collect():  # k rows, and k a further limb where values are huge
        sums = total.setdefault(r["cluster"], [0] * dims)
        total[r["cluster"]] = [s + (int(x) << (LIMB * r["limb"])) for s, x in zip(sums, r["sums"], strict=True)]
        counts[r["cluster"]] += r["count"]
        radius[r["cluster"]] = max(radius[r["cluster"]], r["radius"])
    for c, sums in total.items():
        new[c] = [s // counts[c] for s in sums]
    return new, radius


def drifts(old: list[list[int]], new: list[list[int]], radius: Sequence[float]) -> tuple[np.ndarray, np.ndarray]:
    """By cluster: how much the upper bound grows, and how much the lower one loosens."""
    a, b = np.array(old, dtype=np.float64), np.array(new, dtype=np.float64)
    k = len(old)
    grow = np.array([tight_loss(a[i], radius[i], b[i], a[i]) for i in range(k)])
    loosen = np.array([max((tight_loss(a[i], radius[i], a[j], b[j]) for j in range(k) if j != i), default=0.0)
                       for i in range(k)])
    return grow, loosen


def _number(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def cluster_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", k: int = 16, rounds: int = 3,
                    scale: int = 64, dims: int = 64, seed: int = 1,
                    keep: Sequence[str] = ()) -> tuple[DataFrame, list[list[int]]]:
    """Clusters the valid vectors; returns ``(id_col, *keep, cluster, distance, scans)`` and the centroids.

    Components become ``floor(scale * x)``; the centroids start as the k vectors of the smallest
    SHA-256 of ``seed:id``.  ``distance`` is squared; ``scans`` counts a vector's full scans.
    """
    names = {c: f"k{i}" for i, c in enumerate(dict.fromkeys([id_col, *keep]))}
    v = F.transform(vec_col, lambda x: x.cast("double"))
    valid = F.coalesce((F.size(vec_col) == dims) & F.forall(vec_col, lambda x: F.coalesce(
        ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")), F.lit(False))), F.lit(False))
    rows = vectors.filter(valid).select(*[F.col(c).alias(n) for c, n in names.items()], v.alias("x"))
    first = F.sha2(F.concat(F.lit(f"{seed}:"), _number(F.col(names[id_col]))), 256)
    start = rows.select(first.alias("h"), "x").orderBy("h", "x").limit(k).collect()
    centroids = [[int(c) for c in np.floor(scale * np.array(r["x"], dtype=np.float64))] for r in start]
    types = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    kept = ", ".join(f"{n} {types[n]}" for n in names.values())
    schema = f"{kept}, v array<double>, cluster int, upper double, lower double, square long, scans int"
    if not centroids:
        empty = rows.sparkSession.createDataFrame([], schema)
        return _named(empty, names), centroids

    def scaled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first_pass = _first_pass(centroids, len(names), dims)
        at = len(names)
        for b in batches:
            if b.num_rows:
                floors = np.floor(scale * _vectors(b.column("x"), dims))
                fields = pa.schema([*list(b.schema)[:at], ("v", pa.list_(pa.float64()))])
                yield from first_pass([pa.RecordBatch.from_arrays(
                    [*[b.column(i) for i in range(at)], _lists(floors)], schema=fields)])

    state = written(rows.mapInArrow(scaled, schema), "clusters")
    for n in range(rounds):
        moved, radius = _moved(state, centroids, dims)
        grow, loosen = drifts(centroids, moved, radius)
        centroids = moved
        state = written(state.mapInArrow(
            _next_pass(centroids, grow, loosen, len(names), dims, n == rounds - 1), schema), "clusters")
    return _named(state, names), centroids


def _named(state: DataFrame, names: dict[str, str]) -> DataFrame:
    return state.select(*[F.col(n).alias(c) for c, n in names.items()], "cluster", F.col("square").alias("distance"), "scans")


def centroid_digest(centroid: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()


def with_inertia(clustered: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """Adds ``cluster_inertia``, ``inertia`` and ``centroid_sha256``, from one row a cluster."""
    per = clustered.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("part")).collect()
    total = min(sum(int(r["part"]) for r in per), LONGEST)
    rows = [(r["cluster"], min(int(r["part"]), LONGEST), total, centroid_digest(centroids[r["cluster"]])) for r in per]
    side = clustered.sparkSession.createDataFrame(
        rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return clustered.join(F.broadcast(side), "cluster")  # at most k rows
