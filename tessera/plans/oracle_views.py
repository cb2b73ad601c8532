"""The FIXTURES.md derived views written as DuckDB CTEs for the oracles.

These are independent SQL restatements of ``tessera.sources.views``; the
oracle checks compare the Spark jobs against them.
"""

from __future__ import annotations

from ..config import DEFAULT

AS_OF = f"TIMESTAMP '{DEFAULT.as_of.isoformat(sep=' ')}'"

V_PREDICTIONS = f"""predictions AS (
  SELECT event_id AS id,
         sha256(CAST(event_id AS VARCHAR)) AS input_text_hash,
         CAST(floor(value) + 1 AS INTEGER) AS input_length,
         CASE WHEN (event_id * 7919) % 100 < 40 + dayofmonth(ts)
              THEN 'positive' ELSE 'negative' END AS predicted_sentiment,
         CAST(CAST((event_id * 7919) % 5000 + 5000 AS DECIMAL(18,4)) / 10000 AS DECIMAL(5,4)) AS confidence,
         CAST(user_id % 3 + 1 AS VARCHAR) AS model_version,
         '{DEFAULT.registry_name}' AS model_name,
         CAST(round(value) AS INTEGER) AS latency_ms,
         ts AS created_at,
         event_type
  FROM events)"""

V_REVIEWS = """reviews AS (
  SELECT d.doc_id, d.text, l.quality AS label
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""

V_TRUTH_PRED = """truth_pred AS (
  SELECT l.doc_id, l.quality AS y_true, CAST(d.n_chars > 1000 AS INTEGER) AS y_pred
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"""

V_PROFILE = """profile AS (
  SELECT id, created_at, CAST(created_at AS DATE) AS day,
         predicted_sentiment,
         CAST(CAST(floor(confidence * 10) AS INTEGER) AS VARCHAR) AS confidence_bucket,
         model_version,
         CAST(CAST(least(floor(input_length / 50), 4) AS BIGINT) AS VARCHAR) AS length_bucket,
         event_type
  FROM predictions)"""

V_RUN_EVENTS = """run_events AS (
  SELECT event_id,
         CAST(user_id % 2 AS VARCHAR) AS dag_id,
         CAST(user_id AS VARCHAR) AS run_id,
         CASE event_type WHEN 'view' THEN 'start' WHEN 'purchase' THEN 'success' ELSE 'failed' END AS kind,
         ts AS evt_at,
         props AS metrics
  FROM events WHERE event_type IN ('view', 'purchase', 'error'))"""

V_RUNS = """runs AS (
  SELECT p_type AS experiment,
         md5(CAST(p_partkey AS VARCHAR)) AS run_id,
         p_partkey AS position,
         CAST(NULL AS VARCHAR) AS run_name_tag,
         'FINISHED' AS status,
         TIMESTAMP '2024-01-01 00:00:00' + to_seconds(p_partkey) AS start_time,
         ((p_partkey * 7919) % 1000) / 1000.0 AS f1_macro,
         p_size / 50.0 AS accuracy
  FROM part)"""

V_MODEL_VERSIONS = """model_versions AS (
  SELECT experiment AS name, position,
         row_number() OVER (PARTITION BY experiment ORDER BY position) AS version,
         run_id, start_time AS registered_at, TRUE AS has_metrics, f1_macro, accuracy
  FROM runs)"""

V_LOGITS = """logits AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS s FROM embeddings)"""


def with_views(*views: str) -> str:
    return "WITH " + ",\n".join(views) + "\n"


def sql_clean_text(expr: str) -> str:
    """The native cleaning steps (F2-F6) as DuckDB SQL, same patterns."""
    from ..functions.text import KEEP_RE, SPACE_RE, TAG_RE, URL_RE

    def q(p: str) -> str:
        return p.replace("'", "''")
    e = f"lower(coalesce({expr}, 'None'))"
    e = f"regexp_replace({e}, '{q(TAG_RE)}', '', 'g')"
    e = f"regexp_replace({e}, '{q(URL_RE)}', ' ', 'g')"
    e = f"regexp_replace({e}, '{q(KEEP_RE)}', ' ', 'g')"
    e = f"regexp_replace({e}, '{q(SPACE_RE)}', ' ', 'g')"
    return f"trim({e}, ' ')"


def sql_blank(expr: str) -> str:
    from ..functions.text import WS
    return f"coalesce(regexp_matches({expr}, '^[{WS}]*$'), FALSE)"


def sql_md5_order(key: str, seed: int, salt: str | None = None) -> str:
    s = f"'{seed}:' || " + (f"'{salt}:' || " if salt else "")
    return f"md5({s}CAST({key} AS VARCHAR))"
