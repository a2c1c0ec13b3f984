"""DuckDB SQL for every registered query (the correctness oracle).

Each statement rebuilds the adapter views from ``part`` and ``lineitem``
and states the expected result independently of the Spark code.  Rounded
ratios use integer half-up arithmetic, because DuckDB rounds its double
quotients differently on ties (201 of 20,000 is 1.01, not 1.0).
"""

from __future__ import annotations

from folio import config as C
from folio.sources.adapters import NEAR_MISSES, TRICKY_SUFFIX, sql_views

V = "WITH " + sql_views()

_DEDUPED = "b AS (SELECT * FROM books_v QUALIFY row_number() OVER (PARTITION BY title ORDER BY seq) = 1)"

_TS = "make_timestamp({c} * 1000000)"


def _curated(join_cond: str, score: str = "COALESCE(r.review_score, 0.0)") -> str:
    return f"""{V}, {_DEDUPED}
SELECT r.title, r.user_id, {score} AS review_score,
       r.review_summary, r.review_text, {_TS.format(c='r.review_time')} AS review_date,
       b.authors, COALESCE(b.categories, 'Unknown') AS categories, b.publisher
FROM ratings_v r JOIN b ON {join_cond}"""


def _top_tenth(order: str) -> str:
    return f"""{V}
SELECT * FROM ratings_k ORDER BY {order} LIMIT (SELECT greatest(1, COUNT(*) // 10) FROM lineitem)"""


_COUNTS = f"""SELECT '{C.CATALOG_LABEL}' AS tabla, COUNT(*) AS registros FROM books_v
UNION ALL SELECT '{C.REVIEWS_LABEL}', COUNT(*) FROM ratings_v"""

_DISTRIBUTION = """SELECT review_score, COUNT(*) AS cantidad,
       CAST((COUNT(*) * 20000 + SUM(COUNT(*)) OVER ()) // (2 * SUM(COUNT(*)) OVER ()) AS DOUBLE) / 100.0
         AS porcentaje
FROM ratings_v WHERE review_score IS NOT NULL GROUP BY review_score"""

_TABLE_SQL = {"reviews": "ratings_v", "catalog": "books_v"}
_NULLS = "\nUNION ALL ".join(
    f"SELECT '{label}' AS metrica, COUNT(*) AS valor FROM {_TABLE_SQL[t]} WHERE {c} IS NULL"
    for label, t, c in C.NULL_METRICS)

_SCORE_RANGE = f"""SELECT MIN(review_score) AS score_minimo, MAX(review_score) AS score_maximo,
       CAST((CAST(SUM(review_score) AS BIGINT) * 200 + COUNT(*)) // (2 * COUNT(*)) AS DOUBLE) / 100.0
         AS score_promedio,
       COUNT(*) FILTER (WHERE review_score NOT BETWEEN {C.SCORE_MIN} AND {C.SCORE_MAX}) AS fuera_de_rango
FROM ratings_v WHERE review_score IS NOT NULL"""

_THRESHOLDS = ", ".join(f"('{k}', {v})" for k, v in C.VOLUME_THRESHOLDS.items())

ORACLE_SQL: dict[str, str] = {
    "curated_reviews": _curated("r.title IS NOT DISTINCT FROM b.title"),
    "curated_drop_null_keys": _curated("r.title = b.title"),
    "curated_salted": _curated("r.title IS NOT DISTINCT FROM b.title"),
    "curated_split_nulls": _curated("r.title IS NOT DISTINCT FROM b.title"),
    "curated_keep_null_scores": _curated("r.title IS NOT DISTINCT FROM b.title", "r.review_score"),
    "curated_auto_hot_keys": _curated("r.title IS NOT DISTINCT FROM b.title"),
    "dedupe_catalog": f"{V}\nSELECT * FROM books_v QUALIFY row_number() OVER (PARTITION BY title ORDER BY seq) = 1",
    "review_date": f"{V}\nSELECT *, {_TS.format(c='review_time')} AS review_date FROM ratings_v",
    "fill_defaults": f"""{V}, {_DEDUPED}
SELECT r.id, r.line_no, r.title, r.price, r.user_id, COALESCE(r.review_score, 0.0) AS review_score,
       r.review_time, r.review_summary, r.review_text, {_TS.format(c='r.review_time')} AS review_date,
       b.seq, b.description, b.authors, COALESCE(b.categories, 'Unknown') AS categories,
       b.publisher, b.ratings_count
FROM ratings_v r JOIN b ON r.title IS NOT DISTINCT FROM b.title""",
    "table_counts": f"{V}\n{_COUNTS}",
    "score_distribution": f"{V}\n{_DISTRIBUTION}",
    "null_profile": f"{V}\n{_NULLS}",
    "score_range": f"{V}\n{_SCORE_RANGE}",
    "date_range": f"""{V}
SELECT CAST({_TS.format(c='MIN(review_time)')} AS DATE) AS primera_resena,
       CAST({_TS.format(c='MAX(review_time)')} AS DATE) AS ultima_resena,
       COUNT(*) AS total_resenas
FROM ratings_v WHERE review_time IS NOT NULL""",
    "volume_gate": f"""{V}, counts AS ({_COUNTS}),
th AS (SELECT * FROM (VALUES {_THRESHOLDS}) t(tabla, minimo))
SELECT th.tabla, COALESCE(c.registros, 0) AS registros, CAST(th.minimo AS BIGINT) AS minimo,
       COALESCE(c.registros, 0) >= th.minimo AS ok
FROM th LEFT JOIN counts c ON c.tabla = th.tabla""",
    "audit_report": f"""{V}
SELECT *, '{C.SECTION_COUNTS}' AS seccion FROM ({_COUNTS})
UNION ALL BY NAME SELECT *, '{C.SECTION_DISTRIBUTION}' AS seccion FROM ({_DISTRIBUTION})
UNION ALL BY NAME SELECT *, '{C.SECTION_NULLS}' AS seccion FROM ({_NULLS})
UNION ALL BY NAME SELECT *, '{C.SECTION_SCORE_RANGE}' AS seccion FROM ({_SCORE_RANGE})""",
    "key_violations": f"""{V}
SELECT title, COUNT(*) AS n_rows FROM books_v GROUP BY title HAVING title IS NULL OR COUNT(*) > 1""",
    "orphan_reviews": f"""{V}
SELECT r.title, COUNT(*) AS n_reviews FROM ratings_v r
WHERE r.title IS NOT NULL AND NOT EXISTS (SELECT 1 FROM books_v b WHERE b.title = r.title)
GROUP BY r.title""",
    "table_scan": f"{V}\nSELECT * FROM ratings_v",
    "top_n": _top_tenth("id, line_no, part_key, user_id, price"),
    "top_n_cutoff": _top_tenth("line_no, price, id, part_key, user_id"),
    "top_n_tree": _top_tenth("title NULLS FIRST, review_score NULLS FIRST, id, line_no, part_key, user_id, price"),
}


def _sql_str(s: str) -> str:
    """A SQL string literal; newlines spelled as chr(10)."""
    parts = [("'" + p.replace("'", "''") + "'") for p in s.split("\n")]
    return " || chr(10) || ".join(parts)


def _na_tokens_sql() -> str:
    probes = list(C.NA_TOKENS) + list(NEAR_MISSES)
    width = len(probes) + 3
    cases = " ".join(f"WHEN {i} THEN {_sql_str(p)}" for i, p in enumerate(probes))
    tokens = ", ".join(_sql_str(t) for t in C.NA_TOKENS)
    return f"""SELECT p_partkey, raw_value,
       CASE WHEN raw_value IN ({tokens}) THEN NULL ELSE raw_value END AS value
FROM (SELECT p_partkey, CASE p_partkey % {width} {cases} ELSE p_name END AS raw_value FROM part)"""


def _review_ingest_sql(full_table: bool = False) -> str:
    """The exported reviews read back; ``full_table`` adds the absent raw columns as NULL."""
    absent = ("CAST(NULL AS VARCHAR) AS profile_name, CAST(NULL AS VARCHAR) AS helpfulness, "
              if full_table else "")
    return f"""{V}
SELECT CAST(id AS VARCHAR) AS id, title, price, user_id, {absent}review_score, review_time,
       review_summary, ' ' || review_text || {_sql_str(TRICKY_SUFFIX)} AS review_text
FROM ratings_v"""


ORACLE_SQL.update({
    "rename_columns": f"{V}\nSELECT * FROM books_v",
    "project_existing": f"""{V}
SELECT id, title, price, user_id, review_score, review_time, review_summary, review_text FROM ratings_v""",
    "na_tokens": _na_tokens_sql(),
    "typed_cast": """SELECT lpad(CAST(l_orderkey AS VARCHAR), 8, '0') AS id, l_linenumber AS line_no,
       CASE WHEN l_linenumber = 7 THEN NULL ELSE l_extendedprice END AS price,
       l_discount AS review_score,
       CASE WHEN l_linenumber = 5 THEN NULL ELSE CAST(epoch(l_shipdate) AS BIGINT) END AS review_time
FROM lineitem""",
    "csv_roundtrip": _review_ingest_sql(),
    "split_csv": _review_ingest_sql(),
    "header_orders": f"""SELECT * REPLACE (CASE WHEN id::BIGINT % 3 = 2 THEN NULL ELSE price END AS price)
FROM ({_review_ingest_sql(full_table=True)})""",
    "ingest_reviews": _review_ingest_sql(full_table=True),
    "stream_ingest": _review_ingest_sql(full_table=True),
    "table_overwrite": f"{V}\nSELECT * FROM books_v",
    "table_append": f"{V}\nSELECT * FROM ratings_v UNION ALL SELECT * FROM ratings_v",
    "append_by_name": f"{V}\nSELECT * FROM books_v",
    "recovered_load": f"""{V}
SELECT 'books_data' AS tabla, title, COUNT(*) AS registros FROM books_v GROUP BY title
UNION ALL SELECT 'books_rating', title, COUNT(*) FROM ratings_v GROUP BY title""",
    "etl_csv": _curated("r.title IS NOT DISTINCT FROM b.title"),
    "malformed_rows": f"""{V}
SELECT COUNT(*) AS rows, COUNT(title) AS titles,
       COUNT(*) FILTER (WHERE seq % 11 = 0 OR seq % 7 <> 0) AS authors,
       COUNT(*) FILTER (WHERE seq % 11 = 0 OR seq % 7 <> 0) AS publishers,
       COUNT(*) FILTER (WHERE seq % 11 = 0) AS wide_rows,
       COUNT(*) FILTER (WHERE seq % 11 <> 0 AND seq % 7 = 0) AS short_rows
FROM books_v""",
    "first_as_loaded": f"""{V}
SELECT title, description, authors, categories, publisher FROM books_v
QUALIFY row_number() OVER (PARTITION BY title ORDER BY seq % 2 DESC, seq DESC) = 1""",
    "catalog_tables": f"""{V}, b AS (
  SELECT * FROM books_v
  QUALIFY row_number() OVER (PARTITION BY title ORDER BY description, authors, categories NULLS FIRST, publisher) = 1)
SELECT r.title, r.user_id, COALESCE(r.review_score, 0.0) AS review_score, r.review_summary, 't' AS review_text,
       {_TS.format(c='r.review_time')} AS review_date, b.authors, COALESCE(b.categories, 'Unknown') AS categories, b.publisher
FROM ratings_v r JOIN b ON r.title IS NOT DISTINCT FROM b.title""",
    "bucketed_curation": _curated("r.title IS NOT DISTINCT FROM b.title"),
    "audit_job_report": f"""{V}, report AS (
SELECT *, '{C.SECTION_COUNTS}' AS seccion FROM ({_COUNTS})
UNION ALL BY NAME SELECT *, '{C.SECTION_DISTRIBUTION}' AS seccion FROM ({_DISTRIBUTION})
UNION ALL BY NAME SELECT *, '{C.SECTION_NULLS}' AS seccion FROM ({_NULLS})
UNION ALL BY NAME SELECT *, '{C.SECTION_SCORE_RANGE}' AS seccion FROM ({_SCORE_RANGE}))
SELECT * FROM report""",
    "audit_incremental": f"""{V}, report AS (
SELECT *, '{C.SECTION_COUNTS}' AS seccion FROM ({_COUNTS})
UNION ALL BY NAME SELECT *, '{C.SECTION_DISTRIBUTION}' AS seccion FROM ({_DISTRIBUTION})
UNION ALL BY NAME SELECT *, '{C.SECTION_NULLS}' AS seccion FROM ({_NULLS})
UNION ALL BY NAME SELECT *, '{C.SECTION_SCORE_RANGE}' AS seccion FROM ({_SCORE_RANGE}))
SELECT * FROM report""",
    "lookup_title": f"{V}\nSELECT * FROM ratings_v WHERE title = 'T77'",
    "lookup_user": f"{V}\nSELECT * FROM ratings_v WHERE user_id = '7'",
    "lookup_score": f"""{V}
SELECT * FROM ratings_v WHERE review_score = 3 AND user_id < '2'
UNION ALL SELECT * FROM ratings_v WHERE review_score = 6 AND title IS NULL""",
    "extreme_mean": f"""WITH p AS (
  SELECT SUM(CAST(l_extendedprice AS DECIMAL(18,2)))::DECIMAL(38,2) AS total, COUNT(*) AS n,
         COUNT(*) FILTER (WHERE l_extendedprice NOT BETWEEN {C.SCORE_MIN} AND {C.SCORE_MAX}) AS off FROM lineitem),
u AS (  -- in units of 10^-17; the others cancel out
  SELECT CAST(total * 100 AS HUGEINT) * 1000000000000000 + CAST(n AS HUGEINT) * 30000000000000004 AS units, n, off FROM p)
SELECT -1e300::DOUBLE AS score_minimo, 1e300::DOUBLE AS score_maximo,
       CAST((units * 2 + 8 * n * 1000000000000000::HUGEINT) // (16 * n * 1000000000000000::HUGEINT) AS DOUBLE) / 100.0 AS score_promedio,
       off + 7 * n AS fuera_de_rango
FROM u""",
    "price_range": f"""WITH p AS (SELECT CAST(l_extendedprice AS DECIMAL(18,2)) AS c FROM lineitem)
SELECT CAST(MIN(c)::VARCHAR || 'e-4' AS DOUBLE) AS score_minimo, CAST(MAX(c)::VARCHAR || 'e-4' AS DOUBLE) AS score_maximo,
       CAST((CAST(SUM(c) * 100 AS HUGEINT) + 5000 * COUNT(*)) // (10000 * COUNT(*)) AS DOUBLE) / 100.0 AS score_promedio,
       COUNT(*) FILTER (WHERE c / 10000.0 NOT BETWEEN {C.SCORE_MIN} AND {C.SCORE_MAX}) AS fuera_de_rango
FROM p""",
})
