"""The registered queries of the training-data operators, and their SQL where SQL can say it.

Each query is thin: it applies its operator with production parameters to the whole table and
derives the digest columns from the operator's output.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mentionlab.llm.bit_sliced import top_k
from mentionlab.llm.clusters import cluster_vectors, with_inertia
from mentionlab.llm.common import table
from mentionlab.llm.decontaminate import decontaminate
from mentionlab.llm.licenses import license_scan
from mentionlab.llm.line_dedup import line_dedup
from mentionlab.llm.merkle import fold, leaf_digest, merkle_manifest, path_digest
from mentionlab.llm.minhash import near_duplicates
from mentionlab.llm.mixing import mix_sizes
from mentionlab.llm.pages import extract_text
from mentionlab.llm.quality import THRESHOLD, fit_quality, held_out, quality_scores
from mentionlab.llm.spans import span_dedup
from mentionlab.llm.token_counts import token_counts
from mentionlab.llm.warc import round_trip

TOKENIZER = "word_bpe_49k.json"


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
    return counts.withColumn("over_limit", F.col("n_tokens") > 2048)


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=3, percent=85)


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan(table(spark, sf_dir, "documents"))
    return found.withColumn("n_spans", F.size("spans")).drop("spans")


def op4_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sizes(table(spark, sf_dir, "documents"))
    return mixed.select(F.col("id").alias("doc_id"), "size", "source_size", "target",
                        (F.col("copies") * F.col("size")).alias("taken"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = round_trip(table(spark, sf_dir, "pages"))
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "segments", "valid")


def op9_span_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = span_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.withColumn("repeated", F.col("n_removed") > 0)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit_quality(docs, table(spark, sf_dir, "labels"))
    scored = quality_scores(docs, model, keep=["doc_id"])
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def op11_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = with_inertia(*cluster_vectors(table(spark, sf_dir, "embeddings")))
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op12_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = extract_text(table(spark, sf_dir, "pages"))
    return text.withColumn("n_chars", F.char_length("text").cast("bigint"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every leaf is proved; where 7 divides the id's CRC, the row offered for proof has another n_chars."""
    docs = table(spark, sf_dir, "documents")
    fields = ["doc_id", "source", "lang", "n_chars", "text"]
    tampered = [F.col(c) + 1 if c == "n_chars" else F.col(c) for c in fields]
    touched = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, F.lit(False))
    leaf = leaf_digest([F.col(c) for c in fields])
    rows = docs.select("doc_id", "lang", leaf.alias("leaf"),
                       F.when(touched, leaf_digest(tampered)).alias("offered"))
    proved = merkle_manifest(rows, "lang", ["doc_id"], "leaf", ["doc_id", "offered"])
    folded = fold(F.coalesce("offered", "leaf"), F.col("path"))
    proved = proved.select("doc_id", "leaf", "subroot", "root", path_digest(F.col("path")).alias("proof_sha256"),
                           folded.alias("folded_root"))
    return proved.withColumn("verified", F.col("folded_root") == F.col("root"))


QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_near_duplicates": op2_near_duplicates,
    "op3_license_scan": op3_license_scan,
    "op4_exact_top_k": op4_exact_top_k,
    "op5_line_dedup": op5_line_dedup,
    "op6_mixing": op6_mixing,
    "op7_warc": op7_warc,
    "op8_decontaminate": op8_decontaminate,
    "op9_span_dedup": op9_span_dedup,
    "op10_quality": op10_quality,
    "op11_centroid_clusters": op11_centroid_clusters,
    "op12_page_text": op12_page_text,
    "op13_merkle_manifest": op13_merkle_manifest,
}


def _clusters_sql(k: int = 16, rounds: int = 3) -> str:
    """Plain k-means in SQL: every vector against every centroid, in each round."""
    parts = [r"""kept AS MATERIALIZED (
  SELECT row_number() OVER () AS n, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
)""", f"""c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('1:' || coalesce(vec_id::VARCHAR, '')), v) - 1 AS c, v
  FROM kept QUALIFY c < {k}
)"""]
    for r in range(rounds + 1):
        parts.append(f"""a{r} AS MATERIALIZED (
  SELECT n, any_value(vec_id) AS vec_id, any_value(v) AS v, arg_min(c, (d, c)) AS c, min(d) AS d FROM (
    SELECT n, vec_id, kept.v, c, list_sum(list_transform(list_zip(kept.v, c{r}.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
    FROM kept, c{r}) GROUP BY n
)""")
        if r < rounds:
            parts.append(f"""m{r} AS (
  SELECT c, list(m ORDER BY i) AS v FROM (
    SELECT c, i, ((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS m
    FROM (SELECT c, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM a{r}) GROUP BY c, i) GROUP BY c
), c{r + 1} AS MATERIALIZED (SELECT c, coalesce(m{r}.v, c{r}.v) AS v FROM c{r} LEFT JOIN m{r} USING (c))""")
    return "WITH " + ",\n".join(parts) + f"""
SELECT vec_id, a.c::INTEGER AS cluster, d AS distance, (sum(d) OVER (PARTITION BY a.c))::BIGINT AS cluster_inertia,
       (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(f.v, ',')) AS centroid_sha256
FROM a{rounds} a JOIN c{rounds} f ON a.c = f.c"""


_MERKLE_FIELD = "coalesce(strlen({0}::VARCHAR)::VARCHAR || ':' || {0}::VARCHAR, '-')"
_MERKLE_LEAF = "sha256(" + " || ".join(_MERKLE_FIELD.format(c) for c in ("doc_id", "source", "lang", "{n}", "text")) + ")"


def _merkle_tree(name: str, leaves: str) -> str:
    """Node digests by group, level and place; a group's last node is its root."""
    return f"""{name} AS (
  SELECT g, 0 AS level, pos, digest, count(*) OVER (PARTITION BY g) AS width FROM {leaves}
  UNION ALL
  SELECT g, level + 1, pos // 2, sha256(string_agg(digest, '' ORDER BY pos)), any_value((width + 1) // 2)
  FROM {name} WHERE width > 1 GROUP BY g, level, pos // 2
)"""


# CRC-32 of a decimal id: eight shifts a byte
_CRC_SQL = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda d: unicode(d)::BIGINT)),
  lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, (x & 1) * 3988292384))), 4294967295)"""
_MERKLE_SQL = f"""
WITH RECURSIVE leaf AS MATERIALIZED (
  SELECT doc_id, CASE WHEN lang IS NULL THEN 'n' ELSE 's' || lang END AS g, {_MERKLE_LEAF.format(n="n_chars")} AS digest,
         {_MERKLE_LEAF.format(n="(n_chars + 1)")} AS other
  FROM documents
), placed AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, digest) - 1 AS pos FROM leaf
), {_merkle_tree("tree", "placed")}, sub AS MATERIALIZED (
  SELECT g AS sg, '' AS g, digest, row_number() OVER (ORDER BY g) - 1 AS pos FROM tree WHERE width = 1
), {_merkle_tree("top", "sub")}, root AS (SELECT digest AS root FROM top WHERE width = 1
), low AS (
  SELECT p.g, p.pos, list((CASE WHEN s.pos IS NULL THEN '-' WHEN s.pos < t.pos THEN 'L' ELSE 'R' END) || coalesce(s.digest, '')
                          ORDER BY t.level) AS steps
  FROM placed p JOIN tree t ON t.g = p.g AND t.width > 1 AND t.pos = p.pos >> t.level
  LEFT JOIN tree s ON s.g = t.g AND s.level = t.level AND s.pos = xor(t.pos, 1::BIGINT) GROUP BY p.g, p.pos
), high AS (
  SELECT p.sg, list((CASE WHEN s.pos IS NULL THEN '-' WHEN s.pos < t.pos THEN 'L' ELSE 'R' END) || coalesce(s.digest, '')
                    ORDER BY t.level) AS steps
  FROM sub p JOIN top t ON t.width > 1 AND t.pos = p.pos >> t.level
  LEFT JOIN top s ON s.level = t.level AND s.pos = xor(t.pos, 1::BIGINT) GROUP BY p.sg
), proved AS (
  SELECT doc_id, placed.digest AS leaf, sub.digest AS subroot, root,
         list_concat(coalesce(low.steps, []), coalesce(high.steps, [])) AS steps,
         CASE WHEN crc % 7 = 0 THEN coalesce(other, placed.digest) ELSE placed.digest END AS offered
  FROM (SELECT *, {_CRC_SQL} AS crc FROM placed) placed JOIN sub ON sub.sg = placed.g, root
  LEFT JOIN low ON low.g = placed.g AND low.pos = placed.pos LEFT JOIN high ON high.sg = placed.g
)
SELECT doc_id, leaf, subroot, root,
       sha256(array_to_string(list_transform(steps, lambda s: s[2:]), '')) AS proof_sha256,
       list_reduce(list_prepend(offered, steps), lambda acc, s: sha256(
         CASE s[1] WHEN 'L' THEN s[2:] || acc WHEN 'R' THEN acc || s[2:] ELSE acc END)) AS folded_root,
       folded_root = root AS verified
FROM proved"""

ORACLES = {
    "op4_exact_top_k": r"""
WITH q AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS query_id, a.v AS qv, b.vec_id, list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM q a JOIN q b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE a.vec_id % 50 = 0
)
SELECT query_id, row_number() OVER (PARTITION BY query_id, qv ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score
FROM scored QUALIFY rank <= 5""",
    "op5_line_dedup": r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines
), rep AS (
  SELECT k, min(doc_id) AS keeper FROM keyed WHERE length(k) >= 10
  GROUP BY k HAVING count(DISTINCT doc_id) >= 2
), judged AS (
  SELECT doc_id, pos, line, coalesce(doc_id <> keeper, false) AS gone FROM keyed LEFT JOIN rep USING (k)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id""",
    "op6_mixing": r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
  FROM documents
), per AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rk
  FROM docs GROUP BY source
), src AS (
  SELECT source, source_size, 3 * source_size AS cap, [5.0, 2.0, 1.0][1 + rk % 3]::DOUBLE AS weight FROM per
), brk AS (
  SELECT a.cap / a.weight AS r, sum(least(b.cap, a.cap / a.weight * b.weight)) AS filled,
         (sum(b.source_size)::DOUBLE - coalesce(sum(b.cap) FILTER (b.cap / b.weight < a.cap / a.weight), 0))
         / sum(b.weight) FILTER (b.cap / b.weight >= a.cap / a.weight) AS level
  FROM src a, src b GROUP BY a.source, a.cap / a.weight
), tgt AS (
  SELECT source, source_size, coalesce(least(cap, weight * (
           SELECT arg_min(level, r) FROM brk WHERE filled >= (SELECT sum(source_size) FROM src))), cap)::DOUBLE AS target
  FROM src
), placed AS (
  SELECT doc_id, size, t.source_size, target,
         CASE WHEN t.source_size > 0 THEN target / t.source_size ELSE 0 END AS rate,
         ('0x' || substr(md5('7:' || coalesce('s' || d.source, 'null')), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS off,
         row_number() OVER (PARTITION BY d.source ORDER BY size, doc_id) AS n
  FROM docs d JOIN tgt t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       size * (floor(n * rate + off) - floor((n - 1) * rate + off))::BIGINT AS taken
FROM placed""",
    "op8_decontaminate": r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), iw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), pat AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS l, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS p
  FROM iw, LATERAL (SELECT unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i) WHERE len(w) > 0
), lens AS (SELECT DISTINCT l FROM pat
), win AS (
  SELECT doc_id, i, l, array_to_string(w[i:i + l - 1], ' ') AS p
  FROM dw, lens, LATERAL (SELECT unnest(range(1, len(w) - l + 2)) AS i) WHERE len(w) >= l
), occ AS (SELECT doc_id, i, win.l, item_id FROM win JOIN pat ON win.p = pat.p AND win.l = pat.l
), hit AS (
  SELECT doc_id, count(DISTINCT j) AS n_hit
  FROM occ, LATERAL (SELECT unnest(range(i, i + l)) AS j) GROUP BY doc_id
), its AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS s
  FROM (SELECT DISTINCT doc_id, item_id FROM occ) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)""",
    "op11_centroid_clusters": _clusters_sql(),
    "op13_merkle_manifest": _MERKLE_SQL,
}
