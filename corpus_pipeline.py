"""A training corpus from the table documents: filter, deduplicate, decontaminate, mix.

Each stage takes (spark, docs, sf_dir) and gets the rows that the one before it wrote.  All
but the last return the columns of their input; columns are renamed around each operator, so
that extra ones may have any name.  Stages go by whole texts and all rows; a table without
rows stays one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mentionlab.llm.common import bounded_broadcast, table, written
from mentionlab.llm.decontaminate import decontaminate
from mentionlab.llm.line_dedup import line_dedup
from mentionlab.llm.minhash import near_duplicates
from mentionlab.llm.mixing import mix
from mentionlab.llm.quality import THRESHOLD, fit_quality, quality_scores


def _apart(docs: DataFrame, work: Callable[[DataFrame, dict[str, str]], DataFrame]) -> DataFrame:
    """Runs ``work`` on ``docs`` with neutral column names and gives the old names back."""
    name = {c: f"in_{i}" for i, c in enumerate(docs.columns)}
    return work(docs.toDF(*name.values()), name).select(*name.values()).toDF(*name)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts, fitted on the labels of the documents at hand."""
    def work(rows: DataFrame, name: dict[str, str]) -> DataFrame:
        model = fit_quality(rows, table(spark, sf_dir, "labels"), name["doc_id"], name["text"])
        return quality_scores(rows, model, name["text"], out="score").filter(F.col("score") >= THRESHOLD)

    return _apart(docs, work)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that another one keeps."""
    def work(rows: DataFrame, name: dict[str, str]) -> DataFrame:
        out = line_dedup(rows, name["doc_id"], name["text"])
        return out.withColumn(name["n_chars"], F.char_length(name["text"]).cast("bigint")) if "n_chars" in name else out

    return _apart(docs, work)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near-duplicates; of a group without ids
    one row, the first by its JSON text."""
    def work(rows: DataFrame, name: dict[str, str]) -> DataFrame:
        ident = F.col(name["doc_id"])
        found = near_duplicates(rows, name["doc_id"], name["text"], keys=True).filter("kept")
        found = written(found.select(ident.alias("keep"), "text_hash", "class_key"), "kept_rows")
        ids = bounded_broadcast(written(found.select("keep").filter("keep IS NOT NULL").distinct(), "kept_ids"))
        named = rows.join(ids, ident == ids["keep"], "left_semi")
        # rows without id go by their text
        bare = found.filter("keep IS NULL")
        nameless = rows.filter(ident.isNull()).withColumn("hash_", F.xxhash64(name["text"]))
        wordless = bare.filter("class_key IS NULL").select(F.col("text_hash").alias("hash_")).distinct()
        chosen = bare.filter("class_key IS NOT NULL").groupBy("class_key").agg(F.min("text_hash").alias("hash_")).select("hash_")
        row = F.struct(*rows.columns)
        one = (nameless.join(chosen, "hash_", "left_semi").groupBy("hash_").agg(F.min_by(row, F.to_json(row)).alias("row"))
               .select("row.*"))
        return named.unionByName(nameless.join(wordless, "hash_", "left_semi").drop("hash_")).unionByName(one)

    return _apart(docs, work)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark window occurs."""
    def work(rows: DataFrame, name: dict[str, str]) -> DataFrame:
        return decontaminate(rows, table(spark, sf_dir, "benchmark"), name["text"]).filter(F.col("n_hit") == 0)

    return _apart(docs, work)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; ``copy`` counts from 1."""
    return mix(docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("line dedup", line_stage),
    ("near dedup", near_stage),
    ("benchmark decontamination", benchmark_stage),
    ("mixing", mix_stage),
]

# a network's scores and similarity search can't be said in SQL; tests/llm holds brute force against it
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to documents, each on the written rows of the one before."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
