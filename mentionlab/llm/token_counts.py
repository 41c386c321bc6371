"""Token counts without token ids.

The vocabulary of pre-tokens is counted over all texts, the tokenizer's model splits every
distinct pre-token exactly once, and a document's count is the sum over its pre-tokens of
(times it occurs) x (pieces it has).  No id list is ever built.

* Vocabulary: per Arrow batch the distinct pre-tokens and their frequency, then one
  aggregation with map-side combine.
* At most ``hot`` of the most frequent pre-tokens, of up to 64 bytes each (so at most
  ``64 * hot`` bytes, a proven bound), are joined inside the task that reads the document.  Every other pre-token
  goes through an ordinary shuffle join with the whole vocabulary; being outside the hot set,
  none of them can be a skewed key.

Suits tokenizers whose pre-tokens never hold white space (checked when the file is opened).

Defined cases: a null or empty text has 0 bytes and 0 tokens; rows are counted one by one, so
repeated rows and null ids give a row each; strings of special tokens inside a text count as
one token, as the library does by default.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from operator import mul

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mentionlab.llm.common import emit, written

HOT = 200_000
HOT_BYTES = 64
_MEMO = 800_000

# Fixed value: how the shipped word tokenizer separates pre-tokens.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# The letters of Latin-1.
LATIN_UPPER, LATIN_LOWER = "\xc0-\xd6\xd8-\xde", "\xdf-\xf6\xf8-\xff"


class PreTokens:
    """The library's normaliser, pre-tokenizer and model, one pre-token at a time."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        if any(s.isspace() for s, _ in self._plain("a b")) or self._plain("a b") != self._plain("a") + [
                (s, (i + 2, j + 2)) for s, (i, j) in self._plain("b")]:
            raise ValueError("the tokenizer's pre-tokens hold white space")
        self.special = {t.content for t in self.tok.get_added_tokens_decoder().values()}
        longest_first = sorted(map(re.escape, self.special), key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(longest_first) + ")") if longest_first else None
        self.memo: dict[bytes, list[str]] = {}
        # The library's calls cost far more than the work on a short word.  Where the file holds
        # just the pattern below, words of printable ASCII and Latin-1 letters are split by it
        # directly: they are in NFC, their lower case is one character each, and the library
        # itself says how it spells each letter's bytes.
        spec = json.loads(self.tok.to_str())
        self.simple = None
        if [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])] == ["NFC", "Replace", "Lowercase"] and \
                [(x["type"], x.get("pattern")) for x in spec["pre_tokenizer"].get("pretokenizers", [])] == \
                [("Split", {"Regex": PATTERN}), ("ByteLevel", None)]:
            self.simple = re.compile(r"[\x21-\x7e" + LATIN_UPPER + LATIN_LOWER + "]+")
            self.parts = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z" + LATIN_LOWER + "]+|[0-9]|[^a-z0-9" + LATIN_LOWER + "]+")
            self.spelt = {c: self._plain(chr(c))[0][0] for c in range(0xDF, 0x100) if c != 0xF7}

    def _plain(self, s: str) -> list:
        s = self.tok.normalizer.normalize_str(s) if self.tok.normalizer else s
        return self.tok.pre_tokenizer.pre_tokenize_str(s)

    def of(self, word: bytes) -> list[str]:
        """Pre-tokens of a run without ASCII white space; special strings stay whole."""
        s = word.decode("utf-8", "replace")
        if self.cut and self.cut.search(s):
            return [p for part in self.cut.split(s) if part for p in ([part] if part in self.special else self._of(part))]
        return self._of(s)

    def _of(self, s: str) -> list[str]:
        if self.simple and self.simple.fullmatch(s):
            found = self.parts.findall(s.lower())
            return found if s.isascii() else [p.translate(self.spelt) for p in found]
        return [p for p, _ in self._plain(s)]

    def pieces(self, pre_token: str) -> int:
        return 1 if pre_token in self.special else len(self.tok.model.tokenize(pre_token))


@lru_cache(maxsize=2)
def pre_tokens(path: str) -> PreTokens:
    """One per Python worker: opening the file takes longer than many small tasks."""
    return PreTokens(path)


def _vocabulary(path: str):
    schema = pa.schema([("pre_token", pa.string()), ("times", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = pre_tokens(path)
        for batch in batches:
            words: Counter = Counter()
            for text in batch.column(0):
                words.update((text.as_py() or b"").split())
            found: Counter = Counter()
            for word, n in words.items():
                for p in split.of(word):
                    found[p] += n
            yield pa.RecordBatch.from_arrays(
                [pa.array(found.keys(), pa.string()), pa.array(found.values(), pa.int64())], schema=schema)

    return run


def _pieces(path: str):
    schema = pa.schema([("pre_token", pa.string()), ("times", pa.int64()), ("pieces", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = pre_tokens(path)
        for batch in batches:
            n = [split.pieces(p) for p in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64())], schema=schema)

    return run


def _frequencies(path: str, hot):
    """A row per document with what its hot pre-tokens add up to, and one per other pre-token."""
    schema = pa.schema([("row", pa.int64()), ("id", pa.int64()), ("n_bytes", pa.int64()),
                        ("pre_token", pa.string()), ("times", pa.int64()), ("known", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, known = pre_tokens(path), hot.value
        sums: dict[bytes, int] = {}  # of a word's hot pre-tokens
        others: dict[bytes, list[str]] = {}  # its other pre-tokens, where it has any
        for batch in batches:
            columns: list[list] = [[] for _ in schema]
            for row, doc, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                text = text or b""
                words = Counter(text.split())
                for word in [w for w in words if w not in sums]:
                    parts = split.of(word)
                    rest = [p for p in parts if p not in known]
                    sums[word] = sum(known.get(p, 0) for p in parts)
                    if rest:
                        others[word] = rest
                # a pre-token never holds a space: this key joins with nothing and spreads the rows
                out = {f" {row}": 0}
                total = sum(map(mul, map(sums.__getitem__, words), words.values()))
                for word in words.keys() & others.keys():
                    for p in others[word]:
                        out[p] = out.get(p, 0) + words[word]
                for column, values in zip(columns, ([row] * len(out), [doc] * len(out), [len(text)] * len(out), out.keys(),
                                                    out.values(), [total] + [0] * (len(out) - 1)), strict=True):
                    column.extend(values)
                if len(columns[0]) >= 50_000:
                    yield emit(schema, columns)
                    columns = [[] for _ in schema]
                if len(sums) > _MEMO:
                    sums.clear()
                    others.clear()
            yield emit(schema, columns)

    return run


def vocabulary(texts: DataFrame, text: str, path: str) -> DataFrame:
    """(pre_token, times, pieces): every distinct pre-token of all texts, split once."""
    found = texts.select(F.col(text).cast("binary").alias("text")).mapInArrow(
        _vocabulary(path), "pre_token string, times bigint")
    return found.groupBy("pre_token").agg(F.sum("times").alias("times")).mapInArrow(
        _pieces(path), "pre_token string, times bigint, pieces bigint")


def _most_frequent(vocab: DataFrame, hot: int) -> DataFrame:
    """At most ``hot`` short pre-tokens: those over a frequency found from a small histogram
    (a top-n would send n rows of every partition to the driver)."""
    level = F.floor(F.log2("times") * 16)
    short = vocab.filter(F.octet_length("pre_token") <= HOT_BYTES).withColumn("level", level)
    total, least = 0, 1 << 30
    for row in sorted(short.groupBy("level").count().collect(), reverse=True):
        total += row["count"]
        if total > hot:
            break
        least = row["level"]
    return short.filter(F.col("level") >= least).select("pre_token", "pieces")


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                 hot: int = HOT) -> DataFrame:
    """One row per row of ``docs``: (id, n_bytes, n_tokens) under the tokenizer file ``path``."""
    spark = docs.sparkSession
    vocab = written(vocabulary(docs, text_col, path), "pre_tokens")
    known = spark.sparkContext.broadcast(dict(_most_frequent(vocab, hot).collect()))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("bigint").alias("id"),
                       F.col(text_col).cast("binary").alias("text")).mapInArrow(
        _frequencies(path, known),
        "row bigint, id bigint, n_bytes bigint, pre_token string, times bigint, known bigint")
    counted = rows.join(vocab.select("pre_token", "pieces"), "pre_token", "left")
    tokens = F.sum(F.col("known") + F.col("times") * F.coalesce("pieces", F.lit(0)))
    return counted.groupBy("row", "id", "n_bytes").agg(tokens.alias("n_tokens")).select(
        F.col("id").alias(id_col), "n_bytes", "n_tokens")
