"""SQL twins of the registered queries, for any engine that reads the same Parquet tables."""

from __future__ import annotations

VIEWS = {
    "src_clicks": """
SELECT event_id + 1 AS id,
  CASE WHEN event_id % 53 = 0 THEN '   ' ELSE concat('  p', CAST(event_id % 50 AS VARCHAR), ' ') END AS short_code,
  CASE WHEN event_id % 97 = 0 THEN NULL ELSE ts END AS occurred_at,
  CASE event_type WHEN 'view' THEN ' Mobile ' WHEN 'click' THEN 'desktop' WHEN 'purchase' THEN 'TABLET'
    WHEN 'signup' THEN NULL ELSE 'smart-tv' END AS device_type,
  CASE event_id % 3 WHEN 0 THEN sha256(CAST(user_id AS VARCHAR)) WHEN 1 THEN 'not-a-hash' END AS hashed_ip,
  CAST(CASE WHEN event_id % 10 < 7 THEN NULL WHEN event_id % 40 = 8 THEN user_id + 1000000000 ELSE user_id END
    AS DOUBLE) AS user_id
FROM events""",
    "bronze_full": """
SELECT CASE WHEN id % 101 <> 0 THEN id END AS id, short_code, occurred_at, device_type, hashed_ip, user_id
FROM src_clicks WHERE id * 10 <= (SELECT max(id) FROM src_clicks) * 7""",
    "bronze_incremental": """
SELECT CASE WHEN id % 101 <> 0 THEN id END AS id, short_code, occurred_at, device_type, hashed_ip, user_id
FROM src_clicks WHERE id * 10 > (SELECT max(id) FROM src_clicks) * 6""",
    "bronze_clicks": "SELECT * FROM bronze_full UNION ALL SELECT * FROM bronze_incremental",
    "typed": """
SELECT CAST(id AS BIGINT) AS click_id, trim(short_code) AS short_code, CAST(occurred_at AS TIMESTAMP) AS occurred_at,
  CASE WHEN trim(lower(device_type)) IN ('mobile', 'desktop', 'tablet', 'unknown')
    THEN trim(lower(device_type)) ELSE 'unknown' END AS device_type,
  CASE WHEN regexp_full_match(trim(hashed_ip), '[0-9a-f]{64}') THEN trim(hashed_ip) END AS hashed_ip,
  CAST(user_id AS BIGINT) AS user_id
FROM bronze_clicks""",
    "clean": """
SELECT * FROM typed WHERE click_id IS NOT NULL AND occurred_at IS NOT NULL AND length(short_code) > 0""",
    "silver": "SELECT DISTINCT * FROM clean",
    "src_urls": """
SELECT page_id AS id, CASE WHEN page_id % 10 = 9 THEN NULL ELSE concat('p', CAST(page_id AS VARCHAR)) END AS short_code,
  url AS original_url, DATE '2023-12-01' + CAST(page_id % 30 AS INTEGER) AS created_at, page_id % 7 <> 0 AS is_active
FROM pages""",
    "src_users": """
SELECT c_custkey AS id, concat(lower(c_name), '@example.com') AS email,
  CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'PREMIUM' ELSE 'FREE' END AS plan_type
FROM customer""",
    "ledger_runs": """
SELECT CAST(o_orderkey AS VARCHAR) AS run_id, concat('pipeline_', CAST(o_custkey % 2 AS VARCHAR)) AS pipeline_name,
  CASE o_orderkey % 3 WHEN 0 THEN 'urls' WHEN 1 THEN 'users' ELSE 'clicks' END AS source_table,
  CASE WHEN o_orderkey % 3 = 2 THEN 'incremental' ELSE 'full' END AS load_type,
  CASE o_orderstatus WHEN 'F' THEN 'success' WHEN 'O' THEN 'failed' ELSE 'running' END AS status,
  CASE WHEN o_orderkey % 3 = 2 AND o_orderstatus = 'F' THEN o_orderkey END AS watermark_end,
  CASE WHEN o_orderstatus = 'F' THEN o_custkey END AS rows_written,
  CASE WHEN o_orderstatus = 'F' AND o_orderkey % 4 <> 0
    THEN concat('bronze/k', CAST(o_orderkey % 400 AS VARCHAR)) END AS bronze_key,
  o_orderdate AS started_at,
  CASE WHEN o_orderstatus = 'O' THEN repeat(concat('failed after ', CAST(o_orderkey AS VARCHAR), '; '), 150) END
    AS error_message
FROM orders""",
    "ledger_events": """
SELECT run_id, pipeline_name, source_table, load_type, 'running' AS status, CAST(NULL AS BIGINT) AS watermark_end,
  CAST(NULL AS BIGINT) AS rows_written, CAST(NULL AS VARCHAR) AS bronze_key, started_at, 1 AS event_seq FROM ledger_runs
UNION ALL
SELECT run_id, pipeline_name, source_table, load_type, status, watermark_end, rows_written, bronze_key, started_at, 2
FROM ledger_runs WHERE status <> 'running'""",
    "recorded": "SELECT bronze_key FROM ledger_runs WHERE status = 'success' AND bronze_key IS NOT NULL",
    "stored_objects": """
SELECT concat('bronze/k', CAST(doc_id % 450 + 30 AS VARCHAR)) AS path, n_chars * 4096 AS length,
  CASE doc_id % 3 WHEN 0 THEN 'urls' WHEN 1 THEN 'users' ELSE 'clicks' END AS source_table
FROM documents""",
    "stored_keys": "SELECT DISTINCT path AS bronze_key FROM stored_objects",
    "orphans": "SELECT bronze_key FROM stored_keys WHERE bronze_key NOT IN (SELECT bronze_key FROM recorded)",
    "missing": "SELECT bronze_key FROM recorded WHERE bronze_key NOT IN (SELECT bronze_key FROM stored_keys)",
    "dim_date": """
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(d AS DATE) AS full_date,
  CAST(dayofweek(d) AS SMALLINT) AS day_of_week, rpad(strftime(d, '%A'), 9, ' ') AS day_name,
  CAST(day(d) AS SMALLINT) AS day_of_month, CAST(month(d) AS SMALLINT) AS month,
  rpad(strftime(d, '%B'), 9, ' ') AS month_name, CAST(quarter(d) AS SMALLINT) AS quarter,
  CAST(year(d) AS SMALLINT) AS year, isodow(d) IN (6, 7) AS is_weekend
FROM (SELECT unnest(generate_series(DATE '2020-01-01', DATE '2030-12-31', INTERVAL 1 DAY)) AS d)""",
    "dim_device": """
SELECT * FROM (VALUES (1, 'mobile'), (2, 'desktop'), (3, 'tablet'), (4, 'unknown')) AS t(device_key, device_type)""",
    "dim_url": """
SELECT CAST(row_number() OVER (ORDER BY id) AS INTEGER) AS url_key, id AS url_id, short_code,
  nullif(regexp_extract(original_url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)', 1), '') AS original_url_domain,
  is_active, CAST(strftime(created_at, '%Y%m%d') AS INTEGER) AS created_date_key
FROM src_urls""",
    "dim_user": """
SELECT CAST(row_number() OVER (ORDER BY id) AS INTEGER) AS user_key, id AS user_id, plan_type, true AS is_known
FROM src_users UNION ALL SELECT -1, -1, 'UNKNOWN', false""",
    "resolved": """
SELECT s.click_id, d.date_key, u.url_key, coalesce(p.user_key, -1) AS user_key, v.device_key, s.short_code,
  s.occurred_at, CAST(1 AS SMALLINT) AS click_count,
  CASE WHEN u.url_key IS NULL THEN 'unknown_url' WHEN d.date_key IS NULL THEN 'unknown_date'
    WHEN v.device_key IS NULL THEN 'unknown_device' END AS reject_reason
FROM silver s
LEFT JOIN dim_date d ON d.full_date = CAST(s.occurred_at AS DATE)
LEFT JOIN dim_url u ON u.short_code = s.short_code
LEFT JOIN dim_user p ON p.user_id = s.user_id AND p.user_key <> -1
LEFT JOIN dim_device v ON v.device_type = s.device_type""",
    "fact_clicks": "SELECT * EXCLUDE (reject_reason) FROM resolved WHERE reject_reason IS NULL",
}

_NEEDS = {
    "src_clicks": [], "bronze_full": ["src_clicks"], "bronze_incremental": ["src_clicks"],
    "bronze_clicks": ["bronze_full", "bronze_incremental"], "typed": ["bronze_clicks"], "clean": ["typed"],
    "silver": ["clean"], "src_urls": [], "src_users": [], "ledger_runs": [], "ledger_events": ["ledger_runs"],
    "recorded": ["ledger_runs"], "stored_objects": [], "stored_keys": ["stored_objects"],
    "orphans": ["stored_keys", "recorded"], "missing": ["stored_keys", "recorded"], "dim_date": [], "dim_device": [],
    "dim_url": ["src_urls"], "dim_user": ["src_users"],
    "resolved": ["silver", "dim_date", "dim_url", "dim_user", "dim_device"], "fact_clicks": ["resolved"],
}


def with_views(views: list[str], query: str) -> str:
    """Prefix ``query`` with the views it uses and those they use in turn."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for parent in _NEEDS[name]:
            visit(parent)
        if name not in ordered:
            ordered.append(name)

    for view in views:
        visit(view)
    if not ordered:
        return query.strip()
    ctes = ",\n".join(f"{name} AS ({VIEWS[name].strip()})" for name in ordered)
    # A query that starts with a comma goes on with views of its own.
    joint = "" if query.lstrip().startswith(",") else "\n"
    return f"WITH {ctes}{joint}{query.strip()}"


def scatter(number: str, seed: int) -> str:
    """SQL twin of the spread integer behind the generators."""
    prime = 2147483647
    first = f"((({number}) % {prime}) * 48271 + {(seed * 69621 + 11) % prime}) % {prime}"
    second = f"(({first}) * ({first}) + {seed + 1}) % {prime}"
    return f"((({second}) * 16807 + ({first})) % {prime})"
