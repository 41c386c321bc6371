"""Independent SQL (DuckDB dialect) for the catalogue: the correctness oracle.

The CTEs mirror :mod:`mentionlab.plans.derived`; the queries say *what* each Spark
query computes, written plainly without the Spark plan's tricks.
"""

from __future__ import annotations

from mentionlab.schemas import GKG_COLUMNS

ARTICLES = """an AS (
  SELECT min(event_id) AS record_id,
         date_trunc('second', min(ts)) AS rec_ts,
         string_agg(event_type || ',' || CAST(event_id AS VARCHAR), ';' ORDER BY event_id) AS all_names,
         arg_min(event_type, event_id) AS first_type
  FROM events
  GROUP BY user_id, CAST(ts AS DATE), event_id // 256
),
ank AS (
  SELECT *, strftime(rec_ts, '%Y%m%d%H%M%S') || '-' || CAST(record_id AS VARCHAR) AS record_key FROM an
)"""

EVENT_MENTIONS = """m AS (
  SELECT CAST(event_id AS VARCHAR) AS record_id, ts, CAST(ts AS DATE) AS date, event_type AS topic
  FROM events
)"""

DOC_TOPICS = """dt AS (
  SELECT doc_id, DATE '2015-02-18' + CAST(doc_id % 7 AS INTEGER) AS date,
         unnest(regexp_extract_all(text, '([A-Z][a-z]+)', 1)) AS topic
  FROM documents
),
doc_hist AS (SELECT topic AS name, count(*) AS count FROM dt GROUP BY topic)"""


def article_mentions(rule: str = "last_offset", source: str = "ank", name: str = "am") -> str:
    """Mentions of the articles under a name rule, as a CTE called ``name``."""
    expr = {
        "last_offset": "regexp_replace(item, ',[0-9]+$', '')",
        "all_offsets": "regexp_replace(item, ',[0-9]+', '', 'g')",
        "head": "split_part(item, ',', 1)",
    }[rule]
    return f"""{name}_items AS (
  SELECT record_key, rec_ts, unnest(string_split(all_names, ';')) AS item
  FROM {source}
  WHERE rec_ts IS NOT NULL AND all_names IS NOT NULL AND all_names <> ''
),
{name} AS (
  SELECT record_id, ts, date, topic FROM (
    SELECT record_key AS record_id, rec_ts AS ts, CAST(rec_ts AS DATE) AS date, {expr} AS topic
    FROM {name}_items WHERE item <> '') WHERE topic <> ''
)"""


def topk_select(counts: str, k: int = 10) -> str:
    return f"""SELECT date, topic, count, rank FROM (
  SELECT date, topic, count,
         row_number() OVER (PARTITION BY date ORDER BY count DESC, topic) AS rank
  FROM {counts}) WHERE rank <= {k}"""


def counts_cte(mentions: str, name: str = "c") -> str:
    return f"{name} AS (SELECT date, topic, count(*) AS count FROM {mentions} GROUP BY date, topic)"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def gkg_line_sql(cols: dict[str, str]) -> str:
    """A 27-column tab-separated line, columns not given empty (twin of ``gkg_line``)."""
    parts = [f"coalesce(CAST({cols[c]} AS VARCHAR), '')" if c in cols else "''" for c in GKG_COLUMNS]
    return "concat_ws(chr(9), " + ", ".join(parts) + ")"


LINE_COLS = {
    "gkgrecordid": "record_key",
    "date": "strftime(rec_ts, '%Y%m%d%H%M%S')",
    "sourceCollectionIdentifier": "1",
    "sourceCommonName": "'events'",
    "allNames": "all_names",
}
