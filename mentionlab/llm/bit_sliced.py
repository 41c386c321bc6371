"""Exact top-k inner-product search over a bit-sliced index.

Vectors are cut into blocks of rows.  A block stores, for every attribute, the upper bits of
its quantised values as bitmaps over the rows (bit slices), and the exact integers beside
them.  For a query, the slices are added with bitmap arithmetic, column by column of equal
weight through carry-save adders, into the slices of a lower bound of every row's score.
Walking these from the most significant slice downward gives the k-th largest bound and then
all rows within the rounding error of it; only those boundary rows are scored exactly.

Queries come in blocks as well, and each meets each block of rows once: the work is the
stated query set against all rows, split into bounded pairs of blocks.  A block pair returns
at most k rows per query, and one window ranks them.

Defined cases: vectors that are null, empty or hold null or non-finite components take no
part, nor do rows without an id; exactly repeated rows count once; a query is compared with
vectors of its own dimension only, and never with rows of its own id; ties go to the smaller
id; fewer candidates than k give fewer rows.  Ids that hold several vectors are ranked for
each vector.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mentionlab.llm.common import written

ROWS = 16_384
QUERIES = 128
TURN = 64  # blocks of queries that one task takes through a part at most
DROP = 2  # low bits that the slices leave out
_SAFE = 1 << 24  # beyond this, products are computed with Python's integers


def quantise(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of every component as long; null where the vector takes no part."""
    x = F.transform(vector, lambda c: c.cast("double"))
    bad = lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))
    return F.when((F.size(vector) > 0) & ~F.exists(x, bad),
                  F.transform(x, lambda c: F.floor(c * F.lit(float(scale))).cast("bigint")))


class Slices:
    """Bit slices of the attributes of one block of rows."""

    def __init__(self, values: np.ndarray, drop: int = DROP):
        self.values, (self.n, self.dims) = values, values.shape
        self.low = values.min(axis=0)
        above = values - self.low
        self.bits = max(1, int(above.max()).bit_length())
        self.drop = min(drop, self.bits - 1)
        self.size = (self.n + 63) // 64 * 64
        padded = np.zeros((self.dims, self.size), dtype=np.int64)
        padded[:, :self.n] = above.T
        # maps[b][d]: bit drop + b of attribute d over the rows
        self.maps = [np.packbits((padded >> (self.drop + b)) & 1, axis=1, bitorder="little").view(np.uint64)
                     for b in range(self.bits - self.drop)]
        self.flipped = [~m for m in self.maps]
        self.rows = self.bitmap(np.ones(self.n, dtype=bool))

    def bitmap(self, mask: np.ndarray) -> np.ndarray:
        out = np.zeros(self.size, dtype=np.uint8)
        out[:self.n] = mask
        return np.packbits(out, bitorder="little").view(np.uint64)

    def members(self, bitmap: np.ndarray) -> np.ndarray:
        return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little")[:self.n])

    def add(self, weights: np.ndarray) -> list[np.ndarray]:
        """Slices of sum(|w| * a), where a is an attribute's upper bits, flipped if w < 0."""
        size = np.abs(weights)
        columns: dict[int, list[np.ndarray]] = {}
        for j in range(int(size.max()).bit_length()):
            bit = (size >> j) & 1 == 1
            for maps, chosen in ((self.maps, bit & (weights > 0)), (self.flipped, bit & (weights < 0))):
                if chosen.any():
                    for b, m in enumerate(maps):
                        columns.setdefault(j + b, []).append(m[chosen])
        out, k = [], 0
        while columns:
            stack = columns.pop(k, None)
            if stack is None:
                out.append(np.zeros(self.size // 64, dtype=np.uint64))
            else:
                total, carries = _count_column(np.concatenate(stack))
                out.append(total)
                if len(carries):
                    columns.setdefault(k + 1, []).append(carries)
            k += 1
        return out


def _count_column(maps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Carry-save addition of bitmaps of one weight: the sum's bitmap, the carries' bitmaps."""
    carries = []
    while len(maps) > 1:
        if len(maps) == 2:
            a, b = maps
            carries.append((a & b)[None])
            maps = (a ^ b)[None]
            break
        third = len(maps) // 3
        a, b, c = maps[:third], maps[third:2 * third], maps[2 * third:3 * third]
        ab = a ^ b
        carries.append((a & b) | (c & ab))
        maps = np.concatenate([ab ^ c, maps[3 * third:]])
    return maps[0], np.concatenate(carries) if carries else np.empty((0, maps.shape[1]), np.uint64)


def _ones(bitmap: np.ndarray) -> int:
    return int(np.bitwise_count(bitmap).sum())


def largest(slices: list[np.ndarray], rows: np.ndarray, k: int) -> int:
    """The k-th largest value among ``rows`` (the smallest, if there are fewer)."""
    sure, tied, value = np.zeros_like(rows), rows, 0
    for level in range(len(slices) - 1, -1, -1):
        ahead = tied & slices[level]
        if _ones(sure | ahead) >= k:
            tied, value = ahead, value | 1 << level
        else:
            sure, tied = sure | ahead, tied & ~slices[level]
    return value


def at_least(slices: list[np.ndarray], rows: np.ndarray, bound: int) -> np.ndarray:
    """The rows whose value is ``bound`` or more."""
    if bound <= 0:
        return rows
    if bound.bit_length() > len(slices):
        return np.zeros_like(rows)
    more, tied = np.zeros_like(rows), rows
    for level in range(len(slices) - 1, -1, -1):
        if bound >> level & 1:
            tied = tied & slices[level]
        else:
            more, tied = more | (tied & slices[level]), tied & ~slices[level]
    return more | tied


def top_rows(index: Slices, ids: np.ndarray, own: int, query: np.ndarray, k: int) -> list[tuple[int, int]]:
    """(score, id) of the k best rows of a block for one query, best first."""
    rows = index.bitmap(ids != own)
    wide = int(np.abs(query).max()) > _SAFE or int(np.abs(index.values).max()) > _SAFE
    if wide or not query.any():
        near = index.members(rows)
    else:
        slices = index.add(query)
        # each dropped low part adds between 0 and |w| * (2 ** drop - 1)
        slack = int(np.abs(query).sum()) * ((1 << index.drop) - 1) >> index.drop
        near = index.members(at_least(slices, rows, largest(slices, rows, k) - slack))
    if wide:
        scores = (index.values[near].astype(object) @ query.astype(object)) if len(near) else np.empty(0, object)
    else:
        scores = index.values[near] @ query
    best = sorted(zip((-s for s in scores.tolist()), ids[near].tolist(), strict=True))[:k]
    return [(-s, i) for s, i in best]


_BLOCK = pa.schema([("part", pa.int32()), ("dims", pa.int32()), ("ids", pa.binary()), ("vectors", pa.binary())])
_BLOCK_DDL = "part int, dims int, ids binary, vectors binary"


def _blocks(rows: int):
    """Packs rows (id, vector) of one dimension into blocks of at most ``rows``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        open_: dict[int, tuple[list, list]] = {}

        def pack(dims: int) -> pa.RecordBatch:
            ids, vectors = open_.pop(dims)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([dims], pa.int32()),
                 pa.array([np.array(ids, dtype=np.int64).tobytes()], pa.binary()),
                 pa.array([np.array(vectors, dtype=np.int64).tobytes()], pa.binary())], schema=_BLOCK)

        for batch in batches:
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids, vectors = open_.setdefault(len(v), ([], []))
                ids.append(i)
                vectors.append(v)
                if len(ids) == rows:
                    yield pack(len(v))
        for dims in list(open_):
            yield pack(dims)

    return run


def _matrix(ids: bytes, vectors: bytes, dims: int) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(ids, np.int64), np.frombuffer(vectors, np.int64).reshape(-1, dims)


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, index, ids = None, None, None
        for batch in batches:
            for row in batch.to_pylist():
                if last != (row["ids"], row["vectors"]):
                    ids, values = _matrix(row["ids"], row["vectors"], row["dims"])
                    last, index = (row["ids"], row["vectors"]), Slices(values)
                out = []
                for own, query in zip(*_matrix(row["q_ids"], row["q_vectors"], row["dims"]), strict=True):
                    out += [(int(own), query.tobytes(), i, s) for s, i in top_rows(index, ids, own, query, k)]
                columns = list(zip(*out, strict=True)) if out else [[]] * 4
                # a score past 64 bits keeps its sign and rank as the largest long
                edge = (1 << 63) - 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.binary()), pa.array(columns[2], pa.int64()),
                     pa.array([max(-edge, min(edge, s)) for s in columns[3]], pa.int64())],
                    names=["query_id", "query", "vec_id", "score"])

    return run


def top_k(vectors: DataFrame, k: int = 5, every: int = 50, id_col: str = "vec_id", vector_col: str = "embedding",
          scale: int = 256, rows: int = ROWS, queries: int = QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose id is divisible by ``every``, the
    ``k`` rows with the largest integer inner product."""
    data = written(vectors.select(F.col(id_col).cast("bigint").alias("id"), quantise(F.col(vector_col), scale).alias("v"))
                   .filter(F.col("id").isNotNull() & F.col("v").isNotNull()).distinct(), "quantised")
    asked = data.filter(F.pmod("id", F.lit(every)) == 0)
    n, m = data.agg(F.count(F.lit(1)), F.count(F.when(F.pmod("id", F.lit(every)) == 0, 1))).first()
    parts = max(1, -(-n // rows))
    index = data.repartition(parts).mapInArrow(_blocks(rows), _BLOCK_DDL)
    index = written(index, "blocks")
    wanted = asked.repartition(max(1, -(-m // queries))).mapInArrow(_blocks(queries), _BLOCK_DDL)
    # every block of queries goes to every part of the rows
    wanted = wanted.select(F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), "dims",
                           F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors"))
    # a task takes a part and one turn of the queries; there are as many turns as fill the cluster,
    # and a task never has more than TURN blocks of queries
    blocks = max(1, -(-m // queries))
    cores = vectors.sparkSession.sparkContext.defaultParallelism
    turns = max(-(-blocks // TURN), min(blocks, -(-2 * cores // parts)))
    wanted = wanted.withColumn("turn", F.pmod(F.xxhash64("q_ids"), F.lit(turns)).cast("int"))
    index = index.withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(turns - 1))))
    pairs = wanted.join(index, ["part", "dims", "turn"])
    found = pairs.mapInArrow(_search(k), "query_id bigint, query binary, vec_id bigint, score bigint")
    best = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
