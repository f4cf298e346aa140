"""Independent SQL (DuckDB dialect) for the registered queries.

Each text runs on the raw parquet tables registered as views. The common
table expressions below restate the issue mapping of
``slawatch.sources.testdata`` in plain SQL, so a query's Spark plan and its
SQL twin share no code.
"""

from __future__ import annotations

from ..functions.text import stop_words

# Issue chain: events -> unified -> enriched -> scored -> stg.
ISSUE_CTES = """
geo AS (
  SELECT c.c_custkey, c.c_mktsegment, n.n_name, r.r_name
  FROM customer c
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
),
ev AS (
  SELECT e.event_id, e.user_id, e.event_type, e.props,
         CASE WHEN e.event_id % 97 = 1 THEN NULL
              WHEN e.event_id % 7 = 3 THEN date_trunc('second', CAST(e.ts AS TIMESTAMP))
              ELSE CAST(e.ts AS TIMESTAMP) END AS created_at,
         CASE WHEN e.event_type = 'signup' OR e.event_id % 89 = 5 THEN NULL
              ELSE CAST(e.ts AS TIMESTAMP) + to_microseconds(CAST(round(e.value * 3600000000.0) AS BIGINT))
         END AS resolved_at,
         g.c_mktsegment, CASE WHEN e.event_id % 17 = 5 THEN NULL ELSE g.n_name END AS n_name,
         CASE WHEN e.event_id % 17 = 5 OR (e.event_type = 'view' AND e.user_id % 10 = 0) THEN NULL ELSE g.r_name END AS borough,
         CASE WHEN e.event_id % 101 = 7 THEN '' ELSE e.event_type END AS category,
         CASE WHEN e.event_id % 101 = 7 OR e.event_id % 13 = 4 THEN '' ELSE coalesce(e.props->>'$.k', '') END AS subcategory
  FROM events e LEFT JOIN geo g ON e.user_id = g.c_custkey
),
unified AS (
  SELECT CAST(event_id AS VARCHAR) AS issue_id,
         created_at,
         resolved_at,
         category AS raw_category,
         subcategory AS raw_subcategory,
         coalesce(borough, n_name, 'UNKNOWN') AS region,
         CASE WHEN event_type = 'signup' THEN 'Open' ELSE 'Closed' END AS status,
         n_name AS city,
         c_mktsegment AS raw_channel,
         category || ' - ' || subcategory AS issue_text,
         coalesce(c_mktsegment, '311') AS channel,
         'events' AS source_system,
         CAST(72 AS INTEGER) AS sla_hours_target,
         (epoch_us(resolved_at) - epoch_us(created_at)) / 3600000000.0 AS resolution_hours,
         coalesce((epoch_us(resolved_at) - epoch_us(created_at)) / 3600000000.0 > 72, false) AS sla_breached,
         event_id, user_id, event_type
  FROM ev WHERE created_at IS NOT NULL
),
assign AS (
  SELECT CAST(event_id AS VARCHAR) AS issue_id, CAST(TRY_CAST(props->>'$.k' AS INTEGER) % 15 AS INTEGER) AS topic_id
  FROM ev
  WHERE event_type <> 'signup' AND TRY_CAST(props->>'$.k' AS INTEGER) IS NOT NULL
),
terms AS (
  SELECT DISTINCT topic_id, 'topic ' || CAST(topic_id AS VARCHAR) AS topic_keywords FROM assign
),
enriched AS (
  SELECT u.*,
         CAST(u.created_at AS DATE) AS date,
         CAST(hour(u.created_at) AS INTEGER) AS hour,
         CAST(isodow(u.created_at) - 1 AS INTEGER) AS dow,
         CAST(coalesce(a.topic_id, -1) AS INTEGER) AS topic_id,
         coalesce(t.topic_keywords, 'UNKNOWN_TOPIC') AS topic_keywords,
         CAST(length(u.issue_text) AS BIGINT) AS text_len,
         CAST(len(regexp_extract_all(lower(u.issue_text), '\\p{L}+')) AS BIGINT) AS word_count,
         CASE WHEN u.event_id % 5 = 0 THEN NULL ELSE lower(u.event_type) END AS issue_keyword
  FROM unified u
  LEFT JOIN assign a ON u.issue_id = a.issue_id
  LEFT JOIN terms t ON a.topic_id = t.topic_id
),
scored AS (
  SELECT en.*,
         CASE WHEN event_id % 11 = 0 THEN NULL
              ELSE CAST((user_id * 37 + event_id * 11) % 1024 AS DOUBLE) / 1024.0 END AS risk_prob
  FROM enriched en
),
stg AS (
  SELECT issue_id, created_at,
         CAST(created_at AS DATE) AS issue_date,
         CAST(hour(created_at) AS INTEGER) AS issue_hour,
         CAST(dayofweek(created_at) + 1 AS INTEGER) AS issue_dow,
         region, channel, raw_category, topic_id, topic_keywords, sla_breached,
         risk_prob >= 0.5 AS predicted_label,
         risk_prob AS risk_score,
         resolution_hours,
         CASE WHEN risk_prob IS NULL THEN 'unknown'
              WHEN risk_prob < 0.2 THEN 'very_low'
              WHEN risk_prob < 0.4 THEN 'low'
              WHEN risk_prob < 0.6 THEN 'medium'
              WHEN risk_prob < 0.8 THEN 'high'
              ELSE 'very_high' END AS risk_bucket
  FROM scored
),
mart AS (
  SELECT issue_date, region,
         CAST(count(*) AS BIGINT) AS total_issues,
         avg(CASE WHEN sla_breached THEN 1 ELSE 0 END) AS sla_breach_rate,
         avg(risk_score) AS avg_risk_score,
         avg(CASE WHEN risk_bucket IN ('high', 'very_high') THEN 1 ELSE 0 END) AS high_risk_share,
         CAST(count_if(risk_bucket = 'very_low') AS BIGINT) AS cnt_very_low,
         CAST(count_if(risk_bucket = 'low') AS BIGINT) AS cnt_low,
         CAST(count_if(risk_bucket = 'medium') AS BIGINT) AS cnt_medium,
         CAST(count_if(risk_bucket = 'high') AS BIGINT) AS cnt_high,
         CAST(count_if(risk_bucket = 'very_high') AS BIGINT) AS cnt_very_high
  FROM stg
  GROUP BY issue_date, region
)"""


def with_issues(select: str) -> str:
    return f"WITH {ISSUE_CTES}\n{select}"


def stop_list_sql() -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in stop_words())


def text_ctes() -> str:
    """Normalised text and content tokens of ``documents``."""
    return f"""
docs AS (
  SELECT doc_id, text, lang, source,
         trim(regexp_replace(regexp_replace(lower(text), '[^\\p{{L}}]+', ' ', 'g'), ' +', ' ', 'g')) AS clean
  FROM documents
),
doc_words AS (
  SELECT doc_id, CASE WHEN clean = '' THEN [] ELSE string_split(clean, ' ') END AS ws FROM docs
),
tok AS (
  SELECT doc_id, w AS token
  FROM (SELECT doc_id, unnest(ws) AS w FROM doc_words)
  WHERE length(w) >= 2 AND w NOT IN ({stop_list_sql()})
)"""


def issue_word_ctes() -> str:
    """Words and keyword of each unified issue's text."""
    return f"""
issue_words AS (
  SELECT issue_id, CASE WHEN clean = '' THEN [] ELSE string_split(clean, ' ') END AS ws
  FROM (SELECT issue_id, trim(regexp_replace(lower(issue_text), '[^\\p{{L}}]+', ' ', 'g')) AS clean FROM unified)
),
issue_tf AS (
  SELECT issue_id, w AS token, count(*) AS tf FROM (SELECT issue_id, unnest(ws) AS w FROM issue_words)
  WHERE length(w) >= 2 AND w NOT IN ({stop_list_sql()}) GROUP BY ALL
),
issue_df AS (SELECT token, count(*) AS df FROM issue_tf GROUP BY token),
issue_key AS (
  SELECT issue_id, token FROM (
    SELECT issue_id, t.token, row_number() OVER (PARTITION BY issue_id ORDER BY
             round(tf * ln(((SELECT count(*) FROM unified) + 1.0) / (df + 1.0)), 6) DESC, t.token) AS rn
    FROM issue_tf t JOIN issue_df d ON t.token = d.token)
  WHERE rn = 1
)"""
