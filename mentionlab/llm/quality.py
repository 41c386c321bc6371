"""Quality classifier: a byte-level convolutional network in numpy.

A text is its UTF-8 bytes.  Each byte has a learned embedding and one more channel that says
whether it ends a run repeating the bytes 1 to ``LAGS`` places before.  Learned filters run
over chunks of ``2 * HALF`` bytes that start every ``HALF`` bytes, so the chunks overlap and
cover the whole text; each filter's response is max-pooled over all chunks, and a small dense
layer combines the maxima into one probability.  Long texts are worked off in bounded blocks
with a running maximum, so memory doesn't grow with the length; zeros between texts keep a
text's score apart from the rows beside it.

Fitting takes a bounded sample of labelled rows: at most ``rows`` of them, chosen by a hash of
the id, with texts of at most ``row_bytes`` bytes, so at most ``rows * row_bytes`` bytes reach
the driver.  The seed is fixed and reruns agree.  Scoring reads every text whole, in the
tasks that scan it, and shuffles nothing.

Defined cases: null and empty texts are scored as one empty chunk; repeated rows and null ids
give a row each; labels without id, null labels and rows of ``held_out`` teach nothing; with
no labels at all every text scores 1, and with one class only the score is a constant.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HALF = 16
LAGS = 40
RUN = 8
EMBED = 6
FILTERS = 24
HIDDEN = 16
ROWS = 4000
ROW_BYTES = 16_384
EPOCHS = 14
BLOCK = 32_768  # halves per block, 512 KB of text
THRESHOLD = 0.7
_GAP = -(-LAGS // HALF) * HALF  # zeros between texts, so that none looks back into another


def held_out(doc_id: Column) -> Column:
    """The rows that labels are never learned from."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(4)) == 2


def layout(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(all bytes with zeros between texts, first half and number of halves of each text)."""
    halves = np.array([max(1, -(-len(t) // HALF)) for t in texts], dtype=np.int64)
    starts = np.cumsum(halves + _GAP // HALF) - halves
    data = np.zeros(int(starts[-1] + halves[-1] + 1) * HALF if len(texts) else 0, dtype=np.uint8)
    for t, s in zip(texts, starts, strict=True):
        data[s * HALF:s * HALF + len(t)] = np.frombuffer(t, dtype=np.uint8)
    return data, starts, halves


def repeats(data: np.ndarray) -> np.ndarray:
    """1 where the last RUN bytes equal those some 1 to LAGS places before."""
    out = np.zeros(len(data), dtype=bool)
    for lag in range(1, min(LAGS, len(data) - 1) + 1):
        same = np.zeros(len(data), dtype=bool)
        np.equal(data[lag:], data[:-lag], out=same[lag:])
        step = 1
        while step < RUN:
            same[step:] &= same[:-step].copy()
            step *= 2
        out |= same
    return out & (data != 0)


class Network:
    """Parameters and passes.  ``w`` holds the filters of a chunk's first and second half."""

    def __init__(self, seed: int = 11):
        r = np.random.default_rng(seed)
        width = HALF * (EMBED + 1)
        self.p = {
            "emb": (r.standard_normal((256, EMBED)) * 0.3).astype(np.float32),
            "w": (r.standard_normal((2, width, FILTERS)) * (1.0 / np.sqrt(2 * width))).astype(np.float32),
            "b": np.zeros(FILTERS, np.float32),
            "v": (r.standard_normal((FILTERS, HIDDEN)) / np.sqrt(FILTERS)).astype(np.float32),
            "c": np.zeros(HIDDEN, np.float32),
            "u": (r.standard_normal(HIDDEN) / np.sqrt(HIDDEN)).astype(np.float32),
            "d": np.zeros(1, np.float32),
        }
        self.p["emb"][0] = 0
        self.fixed: float | None = None

    def halves(self, data: np.ndarray, rep: np.ndarray) -> np.ndarray:
        x = np.empty((len(data), EMBED + 1), np.float32)
        x[:, :EMBED] = self.p["emb"][data]
        x[:, EMBED] = rep
        return x.reshape(-1, HALF * (EMBED + 1))

    def pooled(self, data: np.ndarray, starts: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per text and filter: the largest response, and the chunk (by its half) that has it."""
        best = np.full((len(starts), FILTERS), -np.inf, np.float32)
        where = np.zeros((len(starts), FILTERS), np.int64)
        ends = starts + count
        total = len(data) // HALF
        both = np.concatenate([self.p["w"][0], self.p["w"][1]], axis=1)
        for low in range(0, total - 1, BLOCK):
            high = min(low + BLOCK, total - 1)  # chunks low .. high - 1
            back = min(low * HALF, _GAP)
            part = data[low * HALF - back:(high + 1) * HALF]
            rep = repeats(part)[back:]
            h = self.halves(part[back:], rep) @ both
            out = h[:-1, :FILTERS] + h[1:, FILTERS:]
            a, b = np.searchsorted(ends, low, side="right"), np.searchsorted(starts, high, side="left")
            for t in range(a, b):
                s, e = max(int(starts[t]), low) - low, min(int(ends[t]), high) - low
                at = out[s:e].argmax(axis=0)
                top = out[s:e][at, np.arange(FILTERS)]
                more = top > best[t]
                best[t, more], where[t, more] = top[more], at[more] + s + low
        return best, where

    def head(self, pool: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        a = np.maximum(pool + self.p["b"], 0)
        h = np.tanh(a @ self.p["v"] + self.p["c"])
        return a, h, 1 / (1 + np.exp(-(h @ self.p["u"] + self.p["d"][0]).astype(np.float64)))

    def score(self, texts: list[bytes]) -> np.ndarray:
        if self.fixed is not None or not texts:
            return np.full(len(texts), 1.0 if self.fixed is None else self.fixed)
        data, starts, count = layout(texts)
        pool, _ = self.pooled(data, starts, count)
        # products of another batch may differ in the last bits of a float; six digits don't
        return np.round(self.head(pool)[2], 6)

    def gradients(self, texts: list[bytes], y: np.ndarray) -> dict[str, np.ndarray]:
        data, starts, count = layout(texts)
        pool, where = self.pooled(data, starts, count)
        a, h, prob = self.head(pool)
        g = ((prob - y) / len(y)).astype(np.float32)
        out = {"d": g.sum(keepdims=True), "u": h.T @ g}
        gh = g[:, None] * self.p["u"] * (1 - h * h)
        out["c"], out["v"] = gh.sum(0), a.T @ gh
        ga = (gh @ self.p["v"].T) * (a > 0)
        out["b"] = ga.sum(0)
        # only the chunk that won each maximum has a gradient
        at = (where[..., None] * HALF + np.arange(2 * HALF))  # text, filter, byte
        won = data[at]
        need = np.unique(at)
        rep = np.zeros(len(data), np.float32)
        rep[need] = repeats(data)[need]
        x = np.concatenate([self.p["emb"][won], rep[at][..., None]], axis=-1).reshape(len(y), FILTERS, 2, -1)
        out["w"] = np.einsum("tf,tfhx->hxf", ga, x)
        w = self.p["w"].reshape(2 * HALF, EMBED + 1, FILTERS)[:, :EMBED]  # byte, channel, filter
        ge = np.einsum("tf,bcf->tfbc", ga, w).reshape(-1, EMBED)
        emb = np.zeros_like(self.p["emb"])
        for c in range(EMBED):
            emb[:, c] = np.bincount(won.ravel(), weights=ge[:, c], minlength=256)
        emb[0] = 0
        out["emb"] = emb
        return out

    def fit(self, texts: list[bytes], labels: list[int], epochs: int = EPOCHS, batch: int = 64, rate: float = 0.01,
            seed: int = 5) -> Network:
        y = np.array(labels, dtype=np.float64)
        if len(set(labels)) < 2:
            self.fixed = (float(y.sum()) + 1) / (len(y) + 1)
            return self
        self.p["d"][0] = np.log(y.mean() / (1 - y.mean()))
        r, steps = np.random.default_rng(seed), 0
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        s = {k: np.zeros_like(v) for k, v in self.p.items()}
        for epoch in range(epochs):
            order = r.permutation(len(texts))
            for low in range(0, len(order), batch):
                chosen = order[low:low + batch]
                steps += 1
                now = rate * 0.5 * (1 + np.cos(np.pi * epoch / epochs))
                for k, g in self.gradients([texts[i] for i in chosen], y[chosen]).items():
                    m[k] = 0.9 * m[k] + 0.1 * g
                    s[k] = 0.999 * s[k] + 0.001 * g * g
                    step = (m[k] / (1 - 0.9 ** steps)) / (np.sqrt(s[k] / (1 - 0.999 ** steps)) + 1e-8)
                    self.p[k] = (self.p[k] - now * step).astype(np.float32)
        return self


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                label_id: str = "doc_id", label_col: str = "quality", rows: int = ROWS,
                row_bytes: int = ROW_BYTES) -> Network:
    """A network fitted on at most ``rows`` labelled texts of at most ``row_bytes`` bytes."""
    known = labels.select(F.col(label_id).alias("_id"), F.col(label_col).cast("int").alias("_label")).filter(
        F.col("_id").isNotNull() & F.col("_label").isin(0, 1) & ~held_out(F.col("_id")))
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("binary").alias("_text"))
    texts = texts.filter(F.octet_length("_text") <= row_bytes)
    # labels without a usable text take no row's place; only ids travel here
    chosen = (known.join(texts.select("_id"), "_id", "left_semi")
              .orderBy(F.xxhash64("_id"), "_id", "_label").limit(rows))
    # at most ``rows`` rows, by the limit above
    sample = (texts.join(F.broadcast(chosen), "_id")
              .orderBy(F.xxhash64("_id"), "_id", "_text", "_label").limit(rows).collect())
    if not sample and not known.isEmpty() and not docs.isEmpty():
        raise ValueError(f"none of the labelled rows has a text of at most {row_bytes} bytes")
    return Network().fit([bytes(r["_text"]) for r in sample], [r["_label"] for r in sample])


def _score(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = model.value
        for batch in batches:
            scores = np.empty(batch.num_rows, np.float64)
            texts = [t or b"" for t in batch.column(batch.num_columns - 1).to_pylist()]
            low = 0
            while low < len(texts):
                high, size = low + 1, len(texts[low])
                while high < len(texts) and high - low < 512 and size + len(texts[high]) < 4 << 20:
                    size += len(texts[high])
                    high += 1
                scores[low:high] = network.score(texts[low:high])
                low = high
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(scores)],
                                             names=[*batch.schema.names[:-1], "_score"])

    return run


def quality_scores(docs: DataFrame, model: Network, text_col: str = "text", keep: list[str] | None = None,
                   out: str = "score") -> DataFrame:
    """``docs`` (or its columns ``keep``) with the probability of a good text."""
    names = [c for c in (keep or docs.columns) if c.lower() != out.lower()]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    read = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(names)], F.col(text_col).cast("binary").alias("_text"))
    ddl = "".join(f"c{i} {docs.schema[c].dataType.simpleString()}, " for i, c in enumerate(names)) + "_score double"
    return read.mapInArrow(_score(shared), ddl).select(
        *[F.col(f"c{i}").alias(c) for i, c in enumerate(names)], F.col("_score").alias(out))
