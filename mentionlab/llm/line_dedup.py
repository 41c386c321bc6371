"""Line deduplication across documents, with DataFrame functions only.

Lines are exploded and normalised, their keys hashed to 128 bits, the distinct documents of
each hash counted, and the lines over the threshold dropped; what stays is put together
again by position.

Shuffles: (hash, document) pairs, each pair once per document, for the count; the same pairs
once more for the join with the repeated hashes (a skewed join that AQE can split, as a line
may stand in a third of all documents); and the texts once, beside their dropped positions.
A document's lines are never gathered: its text stays one row and only positions travel.

Defined cases: null and empty texts are one empty line; keys under ``min_length`` code points
never drop; of the documents that hold a key the smallest id keeps it, null ids coming after
all others and counting as one document; rows with one id count as one document and keep or
lose a line alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mentionlab.llm.common import ASCII_SPACE, ascii_lower, null_safe, written


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(ASCII_SPACE)))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               min_length: int = 10, min_docs: int = 2) -> DataFrame:
    """``docs`` with the repeated lines taken out of ``text_col`` (null texts become empty),
    and the columns ``n_lines`` (before) and ``n_dropped`` added or replaced."""
    # (id, hash of the text) names a row's content: equal rows lose equal lines
    ident = [F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("_text")]
    first_of = F.struct(F.col("_id").isNull().alias("no_id"), F.col("_id").alias("id"))

    lines = docs.select(*ident, F.posexplode(lines_of(F.col(text_col))).alias("_pos", "_line"))
    keyed = (lines.select("_id", "_text", "_pos", line_key(F.col("_line")).alias("_key"))
             .filter(F.char_length("_key") >= min_length)
             .select("_id", "_text", "_pos", F.unhex(F.md5("_key")).alias("_hash")))

    holders = keyed.select("_hash", first_of.alias("_doc")).distinct()
    # written out, so that both sides of the join are shuffles and AQE can split a hot hash
    repeated = written(holders.groupBy("_hash").agg(F.count(F.lit(1)).alias("_docs"), F.min("_doc").alias("_first"))
                .filter(F.col("_docs") >= min_docs)
                .select("_hash", F.col("_first.id").alias("_keeper")), "repeated_lines")

    dropped = (keyed.join(repeated, "_hash")
               .filter(~F.col("_id").eqNullSafe(F.col("_keeper")))
               .groupBy("_id", "_text").agg(F.collect_set("_pos").alias("_dropped")))

    kept_cols = [c for c in docs.columns if c.lower() not in ("n_lines", "n_dropped")]
    base = docs.select(*kept_cols, *ident)
    joined = base.join(dropped, null_safe(base, dropped, ["_id", "_text"]), "left").select(
        *[base[c] for c in kept_cols], dropped["_dropped"])

    none = F.array().cast("array<int>")
    gone = F.coalesce(F.col("_dropped"), none)
    # the inner names bind the split text once, instead of once per line
    stay = F.transform(
        F.array(lines_of(F.col(text_col))),
        lambda ls: F.concat_ws("\n", F.transform(
            F.array_except(F.sequence(F.lit(0), F.size(ls) - 1), gone), lambda i: F.get(ls, i))))
    out = joined.withColumn("n_lines", F.size(lines_of(F.col(text_col))).cast("bigint")) \
        .withColumn("n_dropped", F.size(gone).cast("bigint"))
    text = F.when(F.col("_dropped").isNull(), F.coalesce(F.col(text_col), F.lit(""))).otherwise(F.get(stay, F.lit(0)))
    return out.withColumn(text_col, text).select(*kept_cols, "n_lines", "n_dropped")
