"""MinHash near-duplicates with sequential Bayesian verification.

1. A row's words give a 128-bit key, the number of distinct shingles and a MinHash signature.
   Rows of one key are one class, so exact copies are compared once, whatever their number.
2. Signatures are cut into bands of ``ROWS`` hashes; the number of bands follows from the
   threshold and the probability ``miss`` that a link shares no band.  Classes that share a
   band are candidates.  Pairs of a bucket are never listed: first each member meets only the
   bucket's centre (its smallest class number, the smallest id of its texts).
3. Candidates are compared batch by batch of their signatures.  After each batch the posterior
   probability (uniform prior) that the similarity reaches the threshold is bounded; a pair
   under ``miss`` is pruned.  Survivors are verified exactly on their full shingle sets.
4. Verified links give components.  Where members of a bucket are still apart, those outside
   its commonest component meet all others in blocks of bounded size: same batches, same
   exact check, but pairs already joined are skipped and only the links that join components
   leave the task.  A pair of several buckets is compared in its first one only.

So every pair that shares a band is either in one component, pruned or verified, however
large a group is, and no group, link list or component is gathered in one place.

A class is numbered by its smallest id; of classes that share it, all but one by a hash
of their key, as are those without id.  So an id may hold any number of texts; the classes
of one id are linked.  Shingles are compared by 64-bit hashes.  Defined cases: rows without words
(null and empty texts too) are linked with nothing and stay; fewer words than a shingle make one
shingle of all of them; rows of one id are one document; rows without an id take part and come
after all ids; a component of such rows only has a null id and keeps the rows of one of its classes.
Ids lie below 2 ** 62.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mentionlab.llm.common import bounded_broadcast, emit, written

ROWS = 5
MISS = 1e-6
BATCH = 20
BLOCK_SHINGLES = 200_000  # shingles in one side of a block, 1.6 MB
NO_ID = 1 << 62


def bands_for(percent: int, rows: int = ROWS, miss: float = MISS) -> int:
    """Bands needed so that a pair at the threshold shares one but with probability ``miss``."""
    return math.ceil(math.log(miss) / math.log1p(-((percent / 100) ** rows)))


@lru_cache(maxsize=8)
def least_matches(percent: int, hashes: int, batch: int = BATCH, miss: float = MISS) -> tuple[tuple[int, int], ...]:
    """(n, m): after n hashes, fewer than m matches leave the pair a posterior under ``miss``.

    With a uniform prior the posterior is Beta(m + 1, n - m + 1), and its mass over t equals
    P(Binomial(n + 1, t) <= m).
    """
    t, out = percent / 100, []
    for n in [*range(batch, hashes, batch), hashes]:
        mass, m = 0.0, -1
        while mass < miss:
            m += 1
            mass += math.comb(n + 1, m) * t ** m * (1 - t) ** (n + 1 - m)
        out.append((n, m))
    return tuple(out)


def words_of(text: bytes | None) -> list[bytes]:
    return text.lower().split() if text else []


def shingle_set(words: list[bytes], k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of ``k`` words."""
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < k:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=1)], np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = len(words) - k + 1
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out = (out ^ h[j:j + n]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return np.unique(out)


@lru_cache(maxsize=4)
def _coefficients(hashes: int) -> tuple[np.ndarray, np.ndarray]:
    r = np.random.default_rng(2024)
    return (r.integers(0, 1 << 32, hashes, dtype=np.uint32) | np.uint32(1),
            r.integers(0, 1 << 32, hashes, dtype=np.uint32))


def signature(shingles: np.ndarray, hashes: int) -> np.ndarray:
    a, b = _coefficients(hashes)
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    best = np.full(hashes, 0xFFFFFFFF, np.uint32)
    for low in range(0, len(x), 512):
        best = np.minimum(best, (a[:, None] * x[low:low + 512] + b[:, None]).min(axis=1))
    return best


_SIGNED = pa.schema([("id", pa.int64()), ("text_hash", pa.int64()), ("key", pa.binary()), ("n", pa.int64()),
                     ("sig", pa.binary())])


def _sign(k: int, hashes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, counts, sigs = [], [], []
            for text in batch.column(1).to_pylist():
                words = words_of(text)
                shingles = shingle_set(words, k)
                keys.append(blake2b(b" ".join(words), digest_size=16).digest() if words else None)
                counts.append(len(shingles))
                sigs.append(signature(shingles, hashes).tobytes() if words else None)
            yield emit(_SIGNED, [batch.column(0).to_pylist(), batch.column(2).to_pylist(), keys, counts, sigs])

    return run


def _bands(bands: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            sig = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint32).reshape(n, bands, ROWS)
            bucket = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), (n, bands)).copy()
            for j in range(ROWS):
                bucket = (bucket ^ sig[:, :, j].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
                bucket ^= bucket >> np.uint64(31)
            node, size = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket.ravel().view(np.int64)), pa.array(np.tile(np.arange(bands, dtype=np.int32), n)),
                 pa.array(np.repeat(node, bands)), pa.array(np.repeat(size, bands))],
                names=["bucket", "band", "node", "n"])

    return run


def _plausible(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Indices of the rows of ``a`` and ``b`` (signatures) that no batch prunes."""
    alive, done = np.arange(len(a)), 0
    matches = np.zeros(len(a), np.int32)
    for n, least in least_matches(percent, a.shape[1]):
        matches = matches + (a[alive, done:n] == b[alive, done:n]).sum(axis=1)
        good = matches >= least
        alive, matches, done = alive[good], matches[good], n
        if not len(alive):
            break
    return alive


def _prune(percent: int, hashes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint32).reshape(-1, hashes) for c in (2, 3))
            yield batch.select([0, 1]).take(pa.array(_plausible(a, b, percent)))

    return run


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """The exact test on full sets."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def _verify(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = [linked(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64), percent)
                    for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield batch.select([0, 1]).filter(pa.array(good, pa.bool_()))

    return run


def _sets(k: int):
    schema = pa.schema([("key", pa.binary()), ("shingles", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, sets = [], []
            for text in batch.column(0).to_pylist():
                words = words_of(text)
                if words:
                    keys.append(blake2b(b" ".join(words), digest_size=16).digest())
                    sets.append(shingle_set(words, k).tobytes())
            yield emit(schema, [keys, sets])

    return run


class _Forest:
    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        while (y := self.up.get(x, x)) != x:
            self.up[x] = self.up.get(y, y)
            x = y
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        if x != y:
            self.up[max(x, y)] = min(x, y)
        return x != y


def _block(percent: int, hashes: int):
    """Links between the components of one block: outliers against members."""
    def run(part: pa.Table) -> pa.Table:
        band = part.column("band")[0].as_py()
        outlier = np.asarray(part.column("outlier"))
        node, comp, n = (np.asarray(part.column(c)) for c in ("node", "comp", "n"))
        sig = np.frombuffer(b"".join(part.column("sig").to_pylist()), np.uint32).reshape(-1, hashes)
        sets = [np.frombuffer(s, np.uint64) for s in part.column("shingles").to_pylist()]
        left, right = np.flatnonzero(outlier), np.flatnonzero(~outlier)
        forest, links = _Forest(), []
        for low in range(0, len(left), 64):
            i = left[low:low + 64]
            sizes = 100 * np.minimum(n[i][:, None], n[right]) >= percent * np.maximum(n[i][:, None], n[right])
            x, y = np.nonzero(sizes & (comp[i][:, None] != comp[right]))
            x, y = i[x], right[y]
            for from_ in range(0, len(x), 100_000):
                a, b = x[from_:from_ + 100_000], y[from_:from_ + 100_000]
                # two outliers meet twice, and a pair may share several bands: take it once
                both = np.isin(node[b], node[left])
                fresh = ~both | (node[a] < node[b])
                for j in range(band):
                    fresh &= (sig[a, j * ROWS:(j + 1) * ROWS] != sig[b, j * ROWS:(j + 1) * ROWS]).any(axis=1)
                a, b = a[fresh], b[fresh]
                good = _plausible(sig[a], sig[b], percent)
                alike = (sig[a[good]] == sig[b[good]]).sum(axis=1)
                for g in good[np.argsort(-alike, kind="stable")]:
                    s, t = int(comp[a[g]]), int(comp[b[g]])
                    if forest.root(s) != forest.root(t) and linked(sets[a[g]], sets[b[g]], percent):
                        forest.join(s, t)
                        links.append((s, t))
        return pa.table({"a": pa.array([s for s, _ in links], pa.int64()), "b": pa.array([t for _, t in links], pa.int64())})

    return run


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) of every node of the links (a, b): comp is the smallest node reachable.

    Every round takes the least label among neighbours and then the label's own label, so
    labels travel twice as far each time; rounds end when nothing changes.
    """
    both = written(edges.select("a", "b").union(edges.select("b", "a")).filter("a <> b").distinct(), "links")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                     .select("node", F.least("node", "m").alias("comp")), "labels")
    while True:
        near = (both.join(labels, both["b"] == labels["node"]).groupBy(F.col("a").alias("at"))
                .agg(F.min("comp").alias("m")))
        moved = labels.join(near, labels["node"] == near["at"]).select(
            "node", F.col("comp").alias("old"), F.least("comp", "m").alias("comp"))
        jump = moved.select(F.col("node").alias("via"), F.col("comp").alias("end"))
        labels = written(moved.join(jump, moved["comp"] == jump["via"]).select("node", "old", F.least("comp", "end").alias("comp")),
                         "labels")
        if labels.filter("old <> comp").isEmpty():
            return labels.select("node", "comp")
        labels = labels.select("node", "comp")


def _shingle_sets(docs: DataFrame, nodes: DataFrame, classes: DataFrame, k: int) -> DataFrame:
    """(node, shingles) for the class nodes in ``nodes``, from the texts of their rows."""
    keys = classes.join(nodes, "node", "left_semi")
    wanted = bounded_broadcast(written(keys.filter(F.col("least").isNotNull()).select("least").distinct(), "wanted"))
    named = docs.filter(F.col("id").isNotNull()).join(
        wanted, docs["id"] == wanted["least"], "left_semi").select("text")
    nameless = docs.filter(F.col("id").isNull()).select("text")
    sets = named.unionByName(nameless).mapInArrow(_sets(k), "key binary, shingles binary")
    return sets.join(keys.select("node", "key"), "key").select("node", "shingles").dropDuplicates(["node"])


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5,
                    percent: int = 80, miss: float = MISS, keys: bool = False) -> DataFrame:
    """Per row of ``docs``: (id, n_shingles, component_id, kept).

    Rows are linked if 100 * shared >= percent * united shingles; ``component_id`` is the
    smallest id reachable, and the row with that id is kept.  With ``keys`` come the 64-bit
    ``text_hash`` of the row's text and the ``class_key`` of its words (null without words), for
    decisions on rows that have no id.
    """
    bands = bands_for(percent, ROWS, miss)
    hashes = bands * ROWS
    docs = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("binary").alias("text"),
                       F.xxhash64(text_col).alias("text_hash"))
    base = written(docs.mapInArrow(_sign(shingle, hashes), "id bigint, text_hash bigint, key binary, n bigint, sig binary"),
                   "signed")
    found = written(base.filter(F.col("key").isNotNull()).groupBy("key")
                    .agg(F.min("id").alias("least"), F.first("n").alias("n"), F.first("sig").alias("sig")), "classes")
    # usually none: ids that are the smallest of several classes
    shared_ids = bounded_broadcast(written(
        found.filter(F.col("least").isNotNull()).groupBy("least").agg(F.min("key").alias("owner"), F.count(F.lit(1)).alias("c"))
        .filter("c > 1").select(F.col("least").alias("shared"), "owner"), "shared_ids"))
    other = F.lit(NO_ID) + F.shiftrightunsigned(F.xxhash64("key"), 3)
    own = F.col("least").isNotNull() & (F.col("owner").isNull() | (F.col("owner") == F.col("key")))
    classes = found.join(shared_ids, found["least"] == shared_ids["shared"], "left").select(
        "key", F.when(own, F.col("least")).otherwise(other).alias("node"), "least", "n", "sig")
    # rows of one id are one document, whatever their texts
    held = base.filter(F.col("key").isNotNull() & F.col("id").isNotNull()).select("id", "key").distinct()
    several = written(held.groupBy("id").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("id"), "several_texts")
    mine = written(held.join(bounded_broadcast(several), "id").join(classes.select("key", "node"), "key")
                   .select("id", "node"), "classes_of_one_id")
    of_one_id = (mine.join(mine.groupBy("id").agg(F.min("node").alias("a")), "id").filter("a <> node")
                 .select("a", F.col("node").alias("b")))

    banded = classes.select("node", "n", "sig").mapInArrow(_bands(bands), "bucket bigint, band int, node bigint, n bigint")
    shared = written(banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"), F.min("node").alias("centre"))
                     .filter("size > 1").select("bucket", "centre"), "buckets")
    members = written(banded.join(shared, "bucket"), "members")
    centre = members.filter("node = centre").select("bucket", F.col("n").alias("centre_n"))
    fits = (F.lit(100) * F.least("n", "centre_n") >= F.lit(percent) * F.greatest("n", "centre_n"))
    stars = (members.filter("node <> centre").join(centre, "bucket").filter(fits)
             .select(F.col("centre").alias("a"), F.col("node").alias("b")).distinct())
    signs = classes.select("node", "sig")
    met = (stars.join(signs.withColumnsRenamed({"node": "a", "sig": "sig_a"}), "a")
           .join(signs.withColumnsRenamed({"node": "b", "sig": "sig_b"}), "b").select("a", "b", "sig_a", "sig_b"))
    pairs = written(met.mapInArrow(_prune(percent, hashes), "a bigint, b bigint"), "pairs")
    nodes = written(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "nodes")
    sets = written(_shingle_sets(docs, nodes, classes, shingle), "sets")
    full = (pairs.join(sets.withColumnsRenamed({"node": "a", "shingles": "set_a"}), "a")
            .join(sets.withColumnsRenamed({"node": "b", "shingles": "set_b"}), "b").select("a", "b", "set_a", "set_b"))
    first = components(full.mapInArrow(_verify(percent), "a bigint, b bigint").unionByName(of_one_id))

    second = components(_rest(docs, members, classes, first, shingle, percent, hashes))
    named = (classes.select("key", "node").join(first, "node", "left")
             .select("key", F.col("node").alias("number"), F.coalesce("comp", "node").alias("mid"))
             .join(second.withColumnsRenamed({"node": "mid", "comp": "end"}), "mid", "left")
             .select("key", "number", F.coalesce("end", "mid").alias("component")))
    named = written(named, "components")
    # the smallest id of each component, and of one without ids the class that stays
    heads = found.select("key", "least").join(named, "key").groupBy("component").agg(
        F.min("least").alias("least"), F.min("number").alias("head"))
    out = base.select("id", "text_hash", "key", "n").join(named, "key", "left").join(heads, "component", "left")
    component = F.when(F.col("component").isNull(), F.col("id")).otherwise(F.col("least"))
    kept = (F.when(F.col("component").isNull(), True).when(F.col("id").isNotNull(), F.col("id") == F.col("least"))
            .otherwise(F.col("least").isNull() & (F.col("number") == F.col("head"))))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
                      kept.alias("kept"), *(["text_hash", F.col("key").alias("class_key")] if keys else []))


def _rest(docs: DataFrame, members: DataFrame, classes: DataFrame, first: DataFrame, shingle: int, percent: int,
          hashes: int) -> DataFrame:
    """Links (a, b) between components that the centres didn't show."""
    # pairs with the centre are done; so are buckets whose other members are in one component
    others = members.filter("node <> centre")
    others = others.join(first, "node", "left").withColumn("comp", F.coalesce("comp", "node")).select(
        "bucket", "band", "node", "n", "comp")
    weight = F.col("n") + 64
    per = others.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("size"), F.sum(weight).alias("w"))
    apart = per.groupBy("bucket").agg(F.count(F.lit(1)).alias("comps"), F.sum("w").alias("all_w"),
                                      F.max_by(F.struct("comp", "w"), F.struct("size", "comp")).alias("main"))
    blocks = lambda w: F.greatest(F.ceil(w / BLOCK_SHINGLES), F.lit(1)).cast("int")
    apart = written(apart.filter("comps > 1").select(
        "bucket", F.col("main.comp").alias("main"), blocks(F.col("all_w")).alias("n_all"),
        blocks(F.col("all_w") - F.col("main.w")).alias("n_out")), "apart")
    rows = written(others.join(apart, "bucket"), "open_members")
    nodes = written(rows.select("node").distinct(), "open_nodes")
    data = classes.select("node", "sig").join(_shingle_sets(docs, nodes, classes, shingle), "node")
    data = written(data.dropDuplicates(["node"]), "open_sets")
    place = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    common = ["bucket", "band", "node", "n", "comp"]
    outliers = rows.filter("comp <> main").select(*common, F.lit(True).alias("outlier"),
                                                  place("n_out").alias("o"), every("n_all").alias("m"))
    all_ = rows.select(*common, F.lit(False).alias("outlier"), every("n_out").alias("o"), place("n_all").alias("m"))
    dealt = outliers.unionByName(all_).join(data, "node")
    return dealt.groupBy("bucket", "o", "m").applyInArrow(_block(percent, hashes), "a bigint, b bigint").distinct()
