"""Benchmark decontamination: Wu-Manber search for windows of benchmark words.

The patterns are all windows of ``window`` consecutive words of each item (an item with fewer
words is one pattern).  Patterns of one length form one search:

* the shift table maps each block of ``BLOCK`` words that occurs in a pattern to how far the
  search may advance when that block ends at the current word; a block that no pattern holds
  lets it advance by ``length - BLOCK + 1`` words;
* shift 0 means the block ends a pattern: its bucket (by the suffix block) holds the patterns
  with that ending, and comparing the words in place confirms an occurrence.

Documents are read once, in the tasks that scan them; nothing is shuffled.  A Python worker builds
the tables once.  They take some 15 bytes for each byte of item text (55 while they are built), so
items are shipped only up to ``shard_bytes`` of text: a larger benchmark is cut into
shards of items by hash, every shard passes over the documents on its own, and the hit words
of a document are united afterwards.

Defined cases: a null or empty text has no words and no hits, and null or empty items have no
windows; items with one text all count; an item without an id marks words but is not listed;
rows are judged one by one, so repeated rows and null ids give a row each.  Without items,
nothing is hit.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mentionlab.llm.common import WORD_BYTES, Rows, written

WINDOW = 10
BLOCK = 3
SHARD_BYTES = 8 << 20  # some 0.12 GB of tables in a Python worker, and 0.45 GB while they are built


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(WORD_BYTES).split() if text else []


_MASK = (1 << 64) - 1
_ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93)  # a factor for each word of a block


def _window_hashes(words: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """128 bits for the ``length`` words from each start on."""
    out = []
    for base in _ODD[:2]:
        total = np.zeros(len(starts), np.uint64)
        for j in range(length):
            total = (total ^ words[starts + j].astype(np.uint64)) * np.uint64(base)
            total ^= total >> np.uint64(29)
        out.append(total)
    return out[0], out[1]


class WuManber:
    """Search for patterns of one length, the windows of some items.

    Words are numbers of a vocabulary.  Items lie end to end in one array, and a pattern is a place in
    it, so a pattern costs some bytes; the shift table has an entry for each block of words.
    """

    def __init__(self, length: int, rows: list[tuple[object, np.ndarray]]):
        self.length, self.block = length, min(BLOCK, length)
        self.far = length - self.block + 1
        sizes = np.array([len(ids) for _, ids in rows], np.int64)
        begins = np.cumsum(sizes) - sizes
        self.words = words = np.concatenate([ids for _, ids in rows])
        self.items = [item for item, _ in rows]
        row = np.repeat(np.arange(len(rows)), sizes)
        place = np.arange(len(words)) - begins[row]
        # equal windows are one pattern, with the items that hold it
        starts = np.flatnonzero(place <= sizes[row] - length)
        h1, h2 = _window_hashes(words, starts, length)
        order = np.lexsort((row[starts], h2, h1))
        starts, h1, h2 = starts[order], h1[order], h2[order]
        first = np.concatenate(([True], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])))
        self.owner_from = np.append(np.flatnonzero(first), len(starts))
        self.owners = row[starts].astype(np.int32)
        # buckets: patterns in the order of their last block
        at = starts[first]
        last = self._keys(at + length - self.block)
        by_last = np.argsort(last, kind="stable")
        self.last, self.pattern, self.at = last[by_last], by_last, at
        # a block that starts q words into its item lets the search move on by far - 1 - q words, or 0
        ends = np.flatnonzero(place <= sizes[row] - self.block)
        step = np.maximum(self.far - 1 - place[ends], 0)
        falling = np.argsort(-step, kind="stable")  # of equal blocks the smallest step is set last
        self.shift: dict[int, int] = dict(zip(self._keys(ends)[falling].tolist(), step[falling].tolist(), strict=True))

    def _keys(self, starts: np.ndarray) -> np.ndarray:
        total = np.zeros(len(starts), np.uint64)
        for j in range(self.block):
            total += self.words[starts + j].astype(np.uint64) * np.uint64(_ODD[j])
        return total

    def search(self, ids: list[int]) -> Iterator[tuple[int, set]]:
        """(start, items) of every place where a pattern stands; unknown words are -1."""
        shift, block, far, length = self.shift.get, self.block, self.far, self.length
        end, n = length, len(ids)
        while end <= n:
            key = sum(w * odd for w, odd in zip(ids[end - block:end], _ODD, strict=False)) & _MASK
            step = shift(key, far)
            if step == 0:
                found = self._compare(key, ids[end - length:end])
                if found is not None:
                    yield end - length, found
                step = 1
            end += step

    def _compare(self, key: int, window: list[int]) -> set | None:
        """The items of the pattern that is the window, of those whose last block has this key."""
        low, high = (int(np.searchsorted(self.last, np.uint64(key), side)) for side in ("left", "right"))
        for n in self.pattern[low:high].tolist():
            if self.words[self.at[n]:self.at[n] + self.length].tolist() == window:
                held = self.owners[self.owner_from[n]:self.owner_from[n + 1]]
                return {self.items[i] for i in held.tolist()} - {None}
        return None


class Searches:
    """The tables for (item_id, text as bytes) rows, one search per pattern length."""

    def __init__(self, items: list[tuple], window: int = WINDOW):
        self.vocabulary: dict[bytes, int] = {}
        by_length: dict[int, list[tuple[object, np.ndarray]]] = {}
        for item, text in items:
            words = words_of(text)
            ids = np.fromiter((self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words), np.int32, len(words))
            if len(ids):
                by_length.setdefault(min(window, len(ids)), []).append((item, ids))
        self.tables = [WuManber(length, rows) for length, rows in sorted(by_length.items())]

    def hits(self, words: list[bytes]) -> tuple[list[int], list[str]]:
        """Hit word positions and the ids of the items found, as sorted strings."""
        places, items = set(), set()
        number = self.vocabulary.get
        ids = [number(w, -1) for w in words]
        for table in self.tables:
            for start, found in table.search(ids):
                places.update(range(start, start + table.length))
                items |= found
        return sorted(places), sorted({str(i) for i in items})


_built: dict[str, Searches] = {}


class Pack:
    """Items shipped to the tasks; a Python worker builds their tables once."""

    def __init__(self, spark: SparkSession, rows: list[tuple], window: int):
        self.name, self.window = uuid.uuid4().hex, window
        self.items = spark.sparkContext.broadcast(rows)

    def searches(self) -> Searches:
        if self.name not in _built:
            _built.clear()
            _built[self.name] = Searches(self.items.value, self.window)
        return _built[self.name]


def items_digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(items).encode()).hexdigest()


_OUT = pa.schema([("row", pa.int64()), ("n_words", pa.int64()), ("places", pa.list_(pa.int32())),
                  ("items", pa.list_(pa.string()))])


def _scan(pack: Pack):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = pack.searches()
        out = Rows(_OUT)
        for batch in batches:
            for row, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = words_of(text)
                out.rows.append((row, len(words), *tables.hits(words)))
                if out.full():
                    yield out.take()
        yield out.take()

    return run


def _scan_rows(pack: Pack):
    """As ``_scan`` for one shard: the other columns ride along, so nothing has to be joined."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = pack.searches()
        for batch in batches:
            n_words, n_hit, found = [], [], []
            for text in batch.column(batch.num_columns - 1).to_pylist():
                words = words_of(text)
                places, names = tables.hits(words)
                n_words.append(len(words))
                n_hit.append(len(places))
                found.append(names)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()),
                 pa.array(found, pa.list_(pa.string()))],
                names=[*batch.schema.names[:-1], "_n_words", "_n_hit", "_items"])

    return run


def decontaminate(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id",
                  item_text: str = "text", window: int = WINDOW, shard_bytes: int = SHARD_BYTES,
                  keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with n_words, n_hit and items (sorted ids as text)."""
    spark = docs.sparkSession
    names = [c for c in (keep or docs.columns) if c.lower() not in ("n_words", "n_hit", "items")]
    bench = items.select(F.col(item_id).cast("string").alias("id"), F.col(item_text).cast("binary").alias("text"))
    size = bench.agg(F.coalesce(F.sum(F.octet_length("text") + 16), F.lit(0))).first()[0]
    shards = max(1, -(-size // shard_bytes))
    read = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(names)],
                       F.col(text_col).cast("binary").alias("_text"))
    types = ", ".join(f"c{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(names))
    back = [F.col(f"c{i}").alias(c) for i, c in enumerate(names)]
    if shards == 1:
        # at most shard_bytes of text
        pack = Pack(spark, [tuple(r) for r in bench.collect()], window)
        found = read.mapInArrow(_scan_rows(pack),
                                (f"{types}, " if names else "") + "_n_words bigint, _n_hit bigint, _items array<string>")
        return found.select(*back, F.col("_n_words").alias("n_words"), F.col("_n_hit").alias("n_hit"),
                            F.col("_items").alias("items"))
    # by id and text: an item that stands many times is one row, and items of one text are spread
    bench = bench.distinct()
    rows = written(read.withColumn("row", F.monotonically_increasing_id()), "texts")
    parts = None
    for shard in range(shards):
        part = bench.filter(F.pmod(F.xxhash64("id", "text"), F.lit(shards)) == shard)
        pack = Pack(spark, [tuple(r) for r in part.collect()], window)
        found = rows.select("row", "_text").mapInArrow(
            _scan(pack), "row bigint, n_words bigint, places array<int>, items array<string>")
        parts = found if parts is None else parts.unionByName(found)
    merged = parts.groupBy("row").agg(
        F.max("n_words").alias("n_words"),
        F.array_distinct(F.flatten(F.collect_list("places"))).alias("places"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    return rows.join(merged, "row").select(*back, "n_words", F.size("places").cast("bigint").alias("n_hit"), "items")
