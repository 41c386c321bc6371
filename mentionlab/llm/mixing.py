"""Mixing sources to target weights by systematic sampling, with DataFrame functions only.

Within its source every document has the same expected number of copies, the source's target
over its size.  Documents are laid out by size, the expected copies are summed along that
order starting from one random offset of the source, and a document is taken once for each
whole number that its part of the sum crosses.  Because neighbours in the order have about
the same size, the words taken stay within about one (largest) document of the target.

A source may hold a third of all rows, so its prefix sum is not one window: rows are spread
by ``number_rows`` (range shuffle, local numbers, a small table of offsets).  Only
(source, id, size) rows travel there, not texts.

Defined cases: null or empty texts have size 0 and take part in the order; the null source
is a source of its own and comes last; a source without words has target 0 and is not taken;
equal rows are taken alike up to one copy, and the offset hangs on seed and source alone, so
reruns agree.  An empty table gives an empty mix.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mentionlab.llm.common import null_safe, written
from mentionlab.plans.ranking import number_rows

WEIGHTS = (5.0, 2.0, 1.0)
MAX_COPIES = 3
WORD = r"[^\x20\x09-\x0D]+"


def word_size(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("bigint")


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, max_copies: int = MAX_COPIES,
                   share: float = 1.0) -> DataFrame:
    """(source, source_size, target) from (source, size) rows.

    Water level: sources in the order of cap over weight; a source is full if its cap lies
    under the level that the ones after it would share.  One row per source is all that the
    windows here see.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    # the null source comes last; strings are ordered by code point
    rank = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1
    w = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(rank, F.lit(len(weights))) + 1).cast("int"))
    per = per.withColumn("weight", w).withColumn("cap", F.lit(max_copies) * F.col("source_size"))
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = ((F.lit(share) * F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0)))
             / F.sum("weight").over(onward))
    per = per.withColumn("level", level).withColumn("nth", F.row_number().over(by_ratio))
    # the first source that is not full ends the full ones, and its level holds from there on
    per = per.withColumn("stop", F.min(F.when(F.col("cap") > F.col("level") * F.col("weight"), F.col("nth"))).over(whole))
    final = F.max(F.when(F.col("nth") == F.col("stop"), F.col("level"))).over(whole)
    target = F.when(F.col("nth") >= F.col("stop"), final * F.col("weight")).otherwise(F.col("cap").cast("double"))
    return per.select("source", "source_size", target.alias("target"))


def offset_of(source: Column, seed: int) -> Column:
    """A number in [0, 1) from the first 32 bits of a hash of the seed and the source."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.concat(F.lit("s"), source), F.lit("null")))
    return F.conv(F.substring(F.md5(name), 1, 8), 16, 10).cast("double") / F.lit(2.0 ** 32)


def copies(sizes: DataFrame, order: Sequence[str], weights: Sequence[float] = WEIGHTS,
           max_copies: int = MAX_COPIES, seed: int = 7) -> DataFrame:
    """``sizes`` (source, size and the ``order`` columns) with source_size, target, copies."""
    targets = source_targets(sizes, weights, max_copies)
    placed = number_rows(sizes, ["source"], ["size", *order], out="place", base=1)
    joined = placed.join(targets, null_safe(placed, targets, ["source"])).select(
        placed["*"], targets["source_size"], targets["target"])
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    upto = lambda n: F.floor(n * F.col("rate") + F.col("offset"))
    return (joined.withColumn("rate", rate).withColumn("offset", offset_of(F.col("source"), seed))
            .withColumn("copies", (upto(F.col("place")) - upto(F.col("place") - 1)).cast("bigint"))
            .drop("place", "rate", "offset"))


def mix_sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
              seed: int = 7) -> DataFrame:
    """One row per document: (id, source, size, source_size, target, copies)."""
    sizes = written(docs.select(F.col(source_col).alias("source"), F.col(id_col).alias("id"),
                                word_size(F.col(text_col)).alias("size"),
                                F.xxhash64(text_col).alias("text_hash")), "sizes")
    return copies(sizes, ["id", "text_hash"], seed=seed)


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        seed: int = 7) -> DataFrame:
    """The mix itself: each document as often as it is taken, with ``copy`` counting from 1.

    Rows of equal id, source and text are told apart by nothing: so many of them take one number
    of copies and so many another (at most ``MAX_COPIES + 1`` numbers).  Where all take the same,
    nobody has to be told apart; else these rows are numbered, spread over partitions.
    """
    key = ["id", "source", "text_hash"]
    per = mix_sizes(docs, id_col, text_col, source_col, seed).groupBy(*key, "copies").agg(F.count(F.lit(1)).alias("rows"))
    shares = written(per.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("copies", "rows"))).alias("shares")), "shares")
    names = [c for c in docs.columns if c.lower() != "copy"]
    inner = [f"c{i}" for i in range(len(names))]
    base = docs.select(*[F.col(c).alias(n) for c, n in zip(names, inner, strict=True)], F.col(id_col).alias("id_"),
                       F.col(source_col).alias("source_"), F.xxhash64(text_col).alias("hash_"))

    def with_shares(which: Column) -> DataFrame:
        mine = shares.filter(which)
        return base.join(mine, base["id_"].eqNullSafe(mine["id"]) & base["source_"].eqNullSafe(mine["source"])
                         & (base["hash_"] == mine["text_hash"])).select(*inner, "id_", "source_", "hash_", "shares")

    alike = F.size("shares") == 1
    taken = with_shares(alike).select(*inner, F.col("shares")[0]["copies"].alias("share"))
    if not shares.filter(~alike).isEmpty():
        several = with_shares(~alike).withColumn("row_", F.monotonically_increasing_id())
        several = number_rows(several, ["id_", "source_", "hash_"], ["row_"], out="nth")
        start = F.struct(F.col("nth").alias("left"), F.lit(-1).cast("bigint").alias("share"))

        def step(acc: Column, s: Column) -> Column:
            return F.when(acc["share"] >= 0, acc).when(acc["left"] < s["rows"], F.struct(
                acc["left"].alias("left"), s["copies"].alias("share"))).otherwise(F.struct(
                    (acc["left"] - s["rows"]).alias("left"), acc["share"].alias("share")))

        taken = taken.unionByName(several.select(*inner, F.aggregate("shares", start, step)["share"].alias("share")))
    return (taken.filter(F.col("share") > 0)
            .select(*[F.col(n).alias(c) for c, n in zip(names, inner, strict=True)],
                    F.explode(F.sequence(F.lit(1), F.col("share").cast("int"))).alias("copy")))
