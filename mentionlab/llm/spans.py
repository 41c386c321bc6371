"""Operator 9: substring deduplication over sliding spans of sentences.

A text is a sequence of sentences, which end at a final mark or a line break.  A sentence of
more than ``SHORT`` words is shown in pieces, cut at content-defined points: after a word whose hash
is the least among its neighbours within the sentence, and after ``LONGEST`` words at the latest.  So
passages that start or end inside a sentence have the same pieces from a few words on.

Every span of several consecutive pieces (at least two) and ``MIN_WORDS`` words that cannot be
shorter, from each piece on and up to each piece, has a hash (128 bits, lower case, white space
folded; a character of a script without spaces counts as a word).  Hashes are joined globally.  The
first document of a span is the one with the smallest id; a piece is covered if a span over it has its
first document elsewhere.  As any longer span that repeats is covered end to end by these shortest
ones, a piece is covered exactly if any span of pieces over it, however long, stands in a smaller
document.

Neighbouring covered pieces are one passage.  A passage goes if it holds ``MIN_SENTENCES`` whole
sentences or has ``FLOOR`` words: all its whole sentences, and of a sentence that it covers in
part the pieces if they have ``EDGE`` words (so that no sentence is cut for a few words).

Spans from each piece on are hashed for all texts, and of these only (id, hash) travels: it tells the
documents that share anything.  Only those are read again, for the spans up to each piece and the
places of all.  Counting hashes combines on the map side; the repeated ones are written and joined
back, so a passage of a third of all documents is a skewed join that AQE can split.  Only
texts that lose something are cut; the others pass as they are.

Defined cases: null and empty texts have no sentences and become empty; rows of one id are
one document and lose the same sentences; null ids come after all others and count as one
document; what repeats inside one document only is not removed.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mentionlab.llm.common import bounded_broadcast, null_safe, written

MIN_WORDS = 20
MIN_PIECES = 2
MIN_SENTENCES = 3
FLOOR = 36
EDGE = 12
SHORT = 12
REACH = 2
LONGEST = 16
FEW = 500_000  # ids that are broadcast, a few MB; more go through a shuffle join
_LAST = (1 << 63) - 1
_TOKENS = 1 << 18
_ENDS = frozenset(".!?…。！？")
_CLOSERS = "\"')]}»”’」』"
# characters of scripts without spaces, and full-width marks
_NO_SPACES = ("฀-໿က-႟ក-៿、-ヿ㐀-䶿一-鿿豈-﫿"
              "！-／：-＠\U00020000-\U0003ffff")
_ALONE = re.compile(f"[{_NO_SPACES}]")
_TOKEN = re.compile(rf"[{_NO_SPACES}]|[^\s{_NO_SPACES}]+")


def ends_sentence(word: str) -> bool:
    """Whether a word's last character is a final mark, closing quotes and brackets aside."""
    return word[-1] in _ENDS or (word[-1] in _CLOSERS and word.rstrip(_CLOSERS)[-1:] in _ENDS)


class _Hashes(dict):
    """Word -> 64 bits, of which the lowest says whether a sentence ends."""

    def __missing__(self, word: str) -> int:
        value = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass")) >> 1 << 1 | ends_sentence(word)
        self[word] = value
        return value


def line_words(text: str | None) -> list[list[str]]:
    """The words of every line, in lower case; ``_TOKEN`` finds as many in the text itself."""
    if not text:
        return []
    return [line.split() for line in (text if text.isascii() else _ALONE.sub(r" \g<0> ", text)).lower().split("\n")]


_U = np.uint64
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def _mixed(h: np.ndarray, odd: int) -> np.ndarray:
    h = (h ^ (h >> _U(32))) * _U(odd)
    return h ^ (h >> _U(29))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, _U)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=_U)


class Spans:
    """Pieces and shortest spans of some texts, laid end to end."""

    def __init__(self, texts: list[list[list[str]]], hashes: _Hashes):
        lines = np.array([len(line) for text in texts for line in text], np.int64)
        in_text = np.array([sum(map(len, text)) for text in texts], np.int64)
        self.begins = np.cumsum(in_text) - in_text
        n = int(in_text.sum())
        self.hashes = h = np.fromiter((hashes[w] for text in texts for line in text for w in line), _U, n)
        end = (h & _U(1)).astype(bool)
        end[np.cumsum(lines)[lines > 0] - 1] = True
        self.ends = end
        bound = self._bounds(h, end)
        self.starts = np.concatenate(([0], bound[:-1] + 1)) if n else np.zeros(0, np.int64)
        self.edges = np.append(self.starts, n)  # first word of every piece, and the end
        self.text_of = np.searchsorted(self.begins, self.starts, "right") - 1

    @staticmethod
    def _bounds(h: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Last word of every piece."""
        if not len(h):
            return np.zeros(0, np.int64)
        sentence = np.cumsum(end) - end
        cut = (np.bincount(sentence)[sentence] > SHORT) & ~end
        g = _mixed(h, 0xD6E8FEB86659FD93)
        for k in range(1, REACH + 1):
            apart = sentence[:-k] != sentence[k:]
            cut[:-k] &= apart | (g[:-k] < g[k:])
            cut[k:] &= apart | (g[k:] < g[:-k])
        cut |= end
        at = np.flatnonzero(cut)
        before = np.concatenate(([-1], at[:-1]))
        far = np.flatnonzero(at - before > LONGEST)
        if len(far):
            cut[np.concatenate([np.arange(before[i] + LONGEST, at[i], LONGEST) for i in far])] = True
            at = np.flatnonzero(cut)
        return at

    def spans(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pieces from a up to b, and whether it is the shortest from a on (else only up to b)."""
        count = len(self.starts)
        if count < MIN_PIECES:
            none = np.zeros(0, np.int64)
            return none, none, none.astype(bool)
        a = np.arange(count)
        b = np.maximum(a + MIN_PIECES, np.searchsorted(self.edges, self.starts + MIN_WORDS))
        fits = b <= count
        a, b = a[fits], b[fits]
        fits = self.text_of[b - 1] == self.text_of[a]
        a, b = a[fits], b[fits]
        till = np.arange(1, count + 1)
        since = np.minimum(till - MIN_PIECES, np.searchsorted(self.edges, self.edges[1:] - MIN_WORDS, "right") - 1)
        fits = since >= 0
        since, till = since[fits], till[fits]
        fits = self.text_of[till - 1] == self.text_of[since]
        since, till = since[fits], till[fits]
        new = ~np.isin(since * (count + 1) + till, a * (count + 1) + b)
        first = np.concatenate((np.ones(len(a), bool), np.zeros(int(new.sum()), bool)))
        return np.concatenate((a, since[new])), np.concatenate((b, till[new])), first

    def hash(self, a: np.ndarray, b: np.ndarray) -> list[np.ndarray]:
        """Two 64-bit hashes of the pieces of each span: polynomials in odd bases, from prefix sums."""
        low, high, out = self.edges[a], self.edges[b], []
        words = self.hashes.copy()
        words[self.edges[1:] - 1] ^= _U(0xA0761D6478BD642F)  # where pieces end
        for base, odd in zip(_BASES, (0xD6E8FEB86659FD93, 0xA0761D6478BD642F), strict=True):
            total = np.concatenate((np.zeros(1, _U), np.cumsum(words * _powers(base, len(words)), dtype=_U)))
            back = _powers(pow(base, -1, 1 << 64), len(words) + 1)
            out.append(_mixed((total[high] - total[low]) * back[low] + (high - low).astype(_U), odd))
        return out


def _chunks(batches: Iterator[pa.RecordBatch], text_at: int) -> Iterator[tuple[pa.RecordBatch, list[list[list[str]]]]]:
    """Slices of some _TOKENS words, or of one long text, with their words."""
    for batch in batches:
        low, words, size = 0, [], 0
        for n, text in enumerate(batch.column(text_at)):
            words.append(line_words(text.as_py()))
            size += sum(map(len, words[-1]))
            if size >= _TOKENS:
                yield batch.slice(low, n + 1 - low), words
                low, words, size = n + 1, [], 0
        if words:
            yield batch.slice(low), words


def _first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, hash) of the shortest span from each piece on of (id, text_hash, text) rows."""
    hashes = _Hashes()
    for part, words in _chunks(batches, 2):
        if len(hashes) > 1 << 20:
            hashes.clear()
        s = Spans(words, hashes)
        a, b, first = s.spans()
        a, b = a[first], b[first]
        h1, _ = s.hash(a, b)
        row = s.text_of[a] if len(a) else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(row)), pa.array(h1.view(np.int64))], names=["id", "h"])


_SPANS = "id bigint, text_hash bigint, a int, b int, h1 bigint, h2 bigint"


def _mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The spans of (id, text_hash, text) rows."""
    hashes = _Hashes()
    for part, words in _chunks(batches, 2):
        if len(hashes) > 1 << 20:
            hashes.clear()
        s = Spans(words, hashes)
        a, b, _ = s.spans()
        h1, h2 = s.hash(a, b)
        row = s.text_of[a] if len(a) else np.zeros(0, np.int64)
        offset = np.searchsorted(s.starts, s.begins)[row] if len(a) else row  # the text's first piece
        yield pa.RecordBatch.from_arrays(
            [part.column(0).take(pa.array(row)), part.column(1).take(pa.array(row)),
             pa.array((a - offset).astype(np.int32)), pa.array((b - offset).astype(np.int32)),
             pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64))], names=["id", "text_hash", "a", "b", "h1", "h2"])


def without(text: str, spans: list[dict], hashes: _Hashes, floor: int = FLOOR) -> tuple[str, int, int]:
    """(what stays, sentences that lose words, words removed) of a text with repeated spans."""
    s = Spans([line_words(text)], hashes)
    step = np.zeros(len(s.starts) + 1, np.int64)
    for one in spans:
        step[one["a"]] += 1
        step[one["b"]] -= 1
    covered = np.cumsum(step)[:-1] > 0
    sizes = np.diff(s.edges)
    sentence = (np.cumsum(s.ends) - s.ends)[s.starts]
    whole = np.bincount(sentence)
    turns = np.flatnonzero(np.diff(np.concatenate(([0], covered, [0])).astype(np.int8))).reshape(-1, 2)
    gone = np.zeros(len(covered), bool)
    for low, high in turns.tolist():  # a passage
        held = np.bincount(sentence[low:high], minlength=len(whole))
        full = (held == whole) & (held > 0)
        if full.sum() < MIN_SENTENCES and sizes[low:high].sum() < floor:
            continue
        part = np.bincount(sentence[low:high], weights=sizes[low:high], minlength=len(whole))
        gone[low:high] = (full | (part >= EDGE))[sentence[low:high]]
    if not gone.any():
        return text, 0, 0
    spots = [m.start() for m in _TOKEN.finditer(text)]
    cuts = [spots[i] for i in s.starts] + [len(text)]
    kept = text[:cuts[0]] + "".join(text[cuts[i]:cuts[i + 1]] for i in np.flatnonzero(~gone))
    return kept.strip(), len(np.unique(sentence[gone])), int(sizes[gone].sum())


def _cut(floor: int):
    """Texts without their passages; rows that have none pass as they are."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = _Hashes()
        for part in batches:
            n = part.num_columns
            texts, found = part.column(n - 2), part.column(n - 1)
            at = np.flatnonzero(found.is_valid().to_numpy(zero_copy_only=False))
            owners = part.column(n - 3)
            lost, removed = np.zeros(len(part), np.int64), np.zeros(len(part), np.int64)
            keep_owner = np.zeros(len(part), bool)
            cut = []
            for i in at.tolist():
                if len(hashes) > 1 << 20:
                    hashes.clear()
                text, lost[i], removed[i] = without(texts[i].as_py(), found[i].as_py(), hashes, floor)
                keep_owner[i] = removed[i] > 0
                cut.append(text)
            if len(at):
                mask = np.zeros(len(part), bool)
                mask[at] = True
                texts = pa.compute.replace_with_mask(texts, pa.array(mask), pa.array(cut, texts.type))
            none = pa.scalar([], owners.type)
            owners = pa.compute.if_else(pa.array(keep_owner), owners, none)
            texts = pa.compute.fill_null(texts, "")
            yield pa.RecordBatch.from_arrays(
                [*part.columns[:-3], owners, texts, pa.array(lost), pa.array(removed)],
                names=[*part.schema.names[:-3], "owners", "_text", "_lost", "_words"])

    return run


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, text_hash, a, b, owner)``: spans of pieces a to b whose first document is the smaller ``owner``."""
    texts = docs.select(*_ident(id_col, text_col), F.col(text_col).alias("text"))
    first = written(texts.mapInArrow(_first, "id bigint, h bigint"), "first_spans")
    # 64 bits suffice to leave out what is unique; owners go by all 128
    several = written(first.groupBy("h").agg(F.min("id").alias("low"), F.max("id").alias("top"))
                      .filter("low <> top").select("h"), "repeated_hashes")
    holders = written(first.join(several, "h", "left_semi").select("id").distinct(), "holders")
    spans = written(texts.join(bounded_broadcast(holders), "id", "left_semi").mapInArrow(_mark, _SPANS), "spans")
    owners = written(spans.groupBy("h1", "h2").agg(F.min("id").alias("owner"), F.max("id").alias("top"))
                     .filter("owner <> top").select("h1", "h2", "owner"), "span_owners")
    return spans.join(owners, ["h1", "h2"]).filter("id > owner").select("id", "text_hash", "a", "b", "owner")


def _ident(id_col: str, text_col: str):
    return [F.coalesce(F.col(id_col).cast("bigint"), F.lit(_LAST)).alias("id"), F.xxhash64(text_col).alias("text_hash")]


def span_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", floor: int = FLOOR) -> DataFrame:
    """``docs`` with repeated passages taken out of ``text_col`` and the columns n_removed
    (sentences that lose words), words_removed and repeats_of (the ids that keep them) added or
    replaced."""
    found = repeated_spans(docs, id_col, text_col)
    covered = written(found.groupBy("id", "text_hash").agg(
        F.collect_set(F.struct("a", "b")).alias("spans"), F.sort_array(F.collect_set("owner")).alias("owners")), "covered")
    added = ("n_removed", "words_removed", "repeats_of")
    names = [c for c in docs.columns if c.lower() not in added]
    rest = [c for c in names if c != text_col]
    base = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(rest)], F.col(text_col).alias("t"),
                       *_ident(id_col, text_col))
    kept = [f"c{i}" for i in range(len(rest))]
    ids = written(covered.select("id").distinct(), "covered_ids")
    few = ids.count() <= FEW
    # where a broadcast can tell which texts lose something, the others aren't shuffled
    some = base.join(F.broadcast(ids), "id", "left_semi") if few else base
    joined = some.join(covered, null_safe(some, covered, ["id", "text_hash"]), "left").select(
        *kept, "owners", F.col("t").alias("_text"), "spans")
    ddl = "".join(f"c{i} {docs.schema[c].dataType.simpleString()}, " for i, c in enumerate(rest))
    cut = joined.mapInArrow(_cut(floor), ddl + "owners array<bigint>, _text string, _lost bigint, _words bigint")
    if few:
        zero = F.lit(0).cast("bigint")
        cut = cut.unionByName(base.join(F.broadcast(ids), "id", "left_anti").select(
            *kept, F.array().cast("array<bigint>").alias("owners"), F.coalesce("t", F.lit("")).alias("_text"),
            zero.alias("_lost"), zero.alias("_words")))
    back = {c: F.col(f"c{i}").alias(c) for i, c in enumerate(rest)} | {text_col: F.col("_text").alias(text_col)}
    return cut.select(*[back[c] for c in names], F.col("_lost").alias("n_removed"),
                      F.col("_words").alias("words_removed"), F.col("owners").alias("repeats_of"))
