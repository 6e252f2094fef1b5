"""DuckDB SQL for each registered query (same column names and types).

Tables are the driver views ``region nation customer supplier part orders
lineitem events documents embeddings pages benchmark labels conversations``.
``train_logistic_lbfgs``, whose solver stops by itself, has no entry.
"""

from __future__ import annotations

# --- calendar ---------------------------------------------------------------

_P = "WITH p AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS processing_date FROM orders)"


def _contiguous_sql(lo: str, hi: str) -> str:
    return f"""{_P},
b AS (SELECT processing_date, {lo} AS lo, {hi} AS hi FROM p),
g AS (SELECT processing_date, lo, unnest(generate_series(0, datediff('day', lo, hi))) AS i FROM b)
SELECT processing_date, CAST(i AS BIGINT) AS pos, CAST(lo + CAST(i AS INTEGER) AS DATE) AS d FROM g"""


def _period_end_sql(n: int, d_expr: str) -> str:
    return f"""{_P},
g AS (SELECT processing_date, unnest(generate_series(0, {n - 1})) AS i FROM p)
SELECT processing_date, CAST(i AS BIGINT) AS pos, CAST({d_expr} AS DATE) AS d FROM g"""


CAL = {
    "window_contiguous_day": _contiguous_sql("processing_date - 4", "processing_date"),
    "window_contiguous_month": _contiguous_sql(
        "CAST(date_trunc('month', processing_date) - to_months(1) AS DATE)", "last_day(processing_date)"
    ),
    "window_contiguous_quarter": _contiguous_sql(
        "CAST(date_trunc('quarter', processing_date) - to_months(3) AS DATE)",
        "last_day(CAST(date_trunc('quarter', processing_date) AS DATE) + to_months(2))",
    ),
    "window_contiguous_year": _contiguous_sql(
        "make_date(year(processing_date) - 1, 1, 1)", "make_date(year(processing_date), 12, 31)"
    ),
    "window_period_end_day": _period_end_sql(5, "processing_date - 4 + CAST(i AS INTEGER)"),
    "window_period_end_month": _period_end_sql(3, "last_day(processing_date - to_months(CAST(i AS INTEGER)))"),
    "window_period_end_quarter": _period_end_sql(
        3, "last_day(CAST(date_trunc('quarter', processing_date) AS DATE) + to_months(2 - 3 * CAST(i AS INTEGER)))"
    ),
    "window_period_end_year": _period_end_sql(2, "make_date(year(processing_date) - CAST(i AS INTEGER), 12, 31)"),
}

_ISO = "([0-9]{4})-(1[0-2]|0[1-9]|[1-9])-(3[01]|[12][0-9]|0[1-9]|[1-9]| [1-9])"

VALID_ISO_DATE = f"""
WITH t AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders),
x AS (SELECT o_orderkey, CASE o_orderkey % 5
    WHEN 0 THEN strftime(d, '%Y-%m-%d')
    WHEN 1 THEN CAST(year(d) AS VARCHAR) || '-' || CAST(month(d) AS VARCHAR) || '-' || CAST(day(d) AS VARCHAR)
    WHEN 2 THEN CAST(year(d) AS VARCHAR) || '-' || lpad(CAST(month(d) AS VARCHAR), 2, '0') || '-' || lpad(CAST(day(d) + 3 AS VARCHAR), 2, '0')
    WHEN 3 THEN strftime(d, '%Y-%m-%d') || ' '
    ELSE replace(strftime(d, '%Y-%m-%d'), '-', '/') END AS s FROM t)
SELECT o_orderkey, s,
  COALESCE(regexp_full_match(s, '{_ISO}')
    AND regexp_extract(s, '^{_ISO}$', 1) <> '0000'
    AND try_strptime(regexp_extract(s, '^{_ISO}$', 1) || '-' || lpad(regexp_extract(s, '^{_ISO}$', 2), 2, '0')
                     || '-' || lpad(trim(regexp_extract(s, '^{_ISO}$', 3)), 2, '0'), '%Y-%m-%d') IS NOT NULL, false) AS valid
FROM x"""

# --- scans and sinks ----------------------------------------------------------

_EV = "SELECT *, CAST(ts AS DATE) AS processed_date FROM events"
_OD = "SELECT *, CAST(o_orderdate AS DATE) AS o_date FROM orders"
_FOLDER_COLS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority"
_NEW = f"SELECT * FROM ({_OD}) WHERE o_orderstatus = 'P' AND year(o_orderdate) = 1996"
_DYNAMIC = f"""WITH new AS ({_NEW}),
touched AS (SELECT DISTINCT o_date FROM new)
SELECT * FROM ({_OD}) WHERE o_date NOT IN (SELECT o_date FROM touched)
UNION ALL SELECT * FROM new"""

SCANS = {
    "scan_partition_window": f"SELECT * FROM ({_EV}) WHERE processed_date BETWEEN DATE '2024-01-11' AND DATE '2024-01-15'",
    "scan_partition_single_day": f"SELECT * FROM ({_EV}) WHERE processed_date = DATE '2024-01-15'",
    "scan_partition_all": _EV,
    "scan_static_filter_string": f"SELECT * FROM ({_EV}) WHERE event_type = 'click' AND value > 5",
    "scan_static_filter_list": f"SELECT * FROM ({_EV}) WHERE event_type = 'click' AND value > 5",
    "scan_folder_window": f"SELECT {_FOLDER_COLS} FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-03-11' AND DATE '1996-03-15'",
    "scan_folder_month_ends": f"SELECT {_FOLDER_COLS} FROM orders WHERE CAST(o_orderdate AS DATE) IN (DATE '1996-03-31', DATE '1996-02-29', DATE '1996-01-31')",
    "scan_folder_all": f"SELECT {_FOLDER_COLS} FROM orders",
    "scan_explicit_schema": "SELECT p_partkey, p_name, p_size FROM part",
    "scan_csv": "SELECT n_nationkey, n_name, n_regionkey FROM nation",
    "scan_parquet_glob": "SELECT n_nationkey, n_name, n_regionkey FROM nation",
    "scan_catalog_window": f"SELECT * FROM ({_OD}) WHERE o_date BETWEEN DATE '1996-03-01' AND DATE '1996-03-31'",
    "sink_append": _OD,
    "sink_overwrite_partitions": _DYNAMIC,
    "sink_overwrite_all": _NEW,
    "sink_table_overwrite_partitions": _DYNAMIC,
    "sink_create_partitioned": "SELECT * FROM supplier",
    "catalog_exists": """SELECT 'created' AS probe, true AS table_exists, (SELECT count(*) FROM region) AS n_rows
UNION ALL SELECT 'absent', false, CAST(0 AS BIGINT)
UNION ALL SELECT 'namespace_default', true, CAST(0 AS BIGINT)
UNION ALL SELECT 'namespace_described', true, CAST(0 AS BIGINT)""",
}

# --- inventory, completeness, paths ------------------------------------------

_LOC = """WITH loc AS (
  SELECT url AS location FROM pages
  UNION ALL
  SELECT unnest(['s3a://warehouse/' || lower(n_name), 'S3://warehouse/' || lower(n_name) || '/',
                 'hdfs://namenode:8020/data/' || lower(n_name), 'file:///data/' || lower(n_name),
                 '/data/raw/' || lower(n_name), 'lake.' || lower(n_name) || '.orders',
                 'cat.db.sub.' || lower(n_name), lower(n_name)]) FROM nation),
s AS (SELECT location, lower(regexp_extract(location, '^([A-Za-z][A-Za-z0-9+.-]*):', 1)) AS scheme FROM loc)
SELECT location,
  CASE WHEN scheme IN ('s3', 's3a') THEN 'object_store'
       WHEN scheme = 'hdfs' THEN 'hdfs'
       WHEN scheme = 'file' OR (scheme = '' AND strpos(location, '/') > 0) THEN 'local'
       WHEN scheme = '' AND length(location) > 0 THEN 'table'
       ELSE 'unsupported' END AS kind,
  regexp_extract(regexp_replace(regexp_replace(location, '^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?', ''), '/+$', ''), '([^/]*)$', 1) AS name
FROM s"""


def _missing_contiguous(lo: str, hi: str, dates_sql: str) -> str:
    return f"""WITH e AS (SELECT unnest(generate_series(0, datediff('day', DATE '{lo}', DATE '{hi}'))) AS i)
SELECT CAST(i AS BIGINT) AS pos, CAST(DATE '{lo}' + CAST(i AS INTEGER) AS DATE) AS d FROM e
WHERE CAST(DATE '{lo}' + CAST(i AS INTEGER) AS DATE) NOT IN ({dates_sql})"""


INVENTORY = {
    "inventory_hive": "SELECT DISTINCT CAST(ts AS DATE) AS d FROM events",
    "inventory_folder": "SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders",
    "inventory_table": "SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders",
    "path_kind": _LOC,
    "completeness_events_day": _missing_contiguous("2024-01-11", "2024-01-15", "SELECT CAST(ts AS DATE) FROM events"),
    "completeness_events_month": _missing_contiguous("2024-01-01", "2024-01-31", "SELECT CAST(ts AS DATE) FROM events"),
    "completeness_orders_year": _missing_contiguous("1998-01-01", "1998-12-31", "SELECT CAST(o_orderdate AS DATE) FROM orders"),
    "completeness_folder_month_ends": """WITH e(pos, d) AS (VALUES (0, DATE '2001-09-30'), (1, DATE '2001-08-31'), (2, DATE '2001-07-31'), (3, DATE '2001-06-30'))
SELECT CAST(pos AS BIGINT) AS pos, d FROM e
WHERE d NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders)""",
}

# --- table-format live partitions ----------------------------------------------

_INSERTED = """SELECT DISTINCT 'f' || CAST(o_orderkey AS VARCHAR) AS file_path, CAST(o_orderdate AS DATE) AS partition_date
FROM orders WHERE o_orderkey % 10 <> 0 AND o_orderkey % 3 IN (0, 1)"""
_REMOVED = """SELECT DISTINCT file_path FROM (
  SELECT 'f' || CAST(o_orderkey AS VARCHAR) AS file_path FROM orders WHERE o_orderkey % 3 = 2
  UNION ALL
  SELECT 'f' || CAST(l_orderkey AS VARCHAR) FROM lineitem WHERE l_linenumber - 1 + l_orderkey % 4 = 0)"""

TABLE_FORMAT = {
    "latest_metadata_entry": """SELECT file FROM (
  SELECT 'm' || CAST(o_orderkey AS VARCHAR) || '.metadata.json' AS file,
         o_orderdate + to_seconds(o_orderkey % 86400) AS ts FROM orders)
ORDER BY ts DESC, file DESC LIMIT 1""",
    "current_snapshot": """WITH s AS (SELECT o_orderkey AS table_id, o_orderkey * 10 + o_orderkey % 3 AS cur,
  unnest([o_orderkey * 10, o_orderkey * 10 + 1, o_orderkey * 10 + 2]) AS snapshot_id FROM orders)
SELECT table_id, snapshot_id, 'ml-' || CAST(snapshot_id AS VARCHAR) || '.avro' AS manifest_list FROM s WHERE snapshot_id = cur""",
    "live_partitions": f"SELECT DISTINCT partition_date FROM ({_INSERTED}) WHERE file_path NOT IN ({_REMOVED})",
    "live_partitions_inserted": _INSERTED,
    "live_partitions_table": f"SELECT DISTINCT partition_date FROM ({_INSERTED}) WHERE file_path NOT IN ({_REMOVED})",
    "delete_file_paths": "SELECT DISTINCT 'f' || CAST(o_orderkey AS VARCHAR) AS file_path FROM orders WHERE o_orderkey % 10 = 0",
    "live_partitions_removed": _REMOVED,
}

# --- transforms ------------------------------------------------------------------

_JOIN_LEFT = """SELECT o_orderkey AS id, o_orderpriority AS name, CAST(o_orderdate AS DATE) AS processed_date FROM orders
WHERE o_orderdate >= TIMESTAMP '1996-03-01' AND o_orderdate < TIMESTAMP '1996-04-01'"""
_JOIN_MAP = "SELECT DISTINCT CAST(l_shipdate AS DATE) AS created_at, l_returnflag FROM lineitem"
_JOIN_THIRD = "SELECT DISTINCT CAST(o_orderdate AS DATE) AS processed_date, o_orderpriority FROM orders"

TRANSFORMS = {
    "join_primary": f"SELECT l.id, l.name, l.processed_date FROM ({_JOIN_LEFT}) l JOIN ({_JOIN_MAP}) m ON l.processed_date = m.created_at",
    "join_primary_keyed": f"SELECT l.id, l.name, l.processed_date FROM ({_JOIN_LEFT}) l JOIN ({_JOIN_MAP}) m ON l.processed_date = m.created_at",
    "join_feature": f"""SELECT l.id, l.name, l.processed_date FROM ({_JOIN_LEFT}) l
JOIN ({_JOIN_MAP}) m ON l.processed_date = m.created_at
JOIN ({_JOIN_THIRD}) t ON l.processed_date = t.processed_date""",
    "passthrough_window": f"SELECT * FROM ({_EV}) WHERE processed_date BETWEEN DATE '2024-01-16' AND DATE '2024-01-20'",
}

# --- gating ------------------------------------------------------------------------

_SPECS_TEXT = """SELECT event_id, CASE event_id % 7
    WHEN 0 THEN event_type
    WHEN 1 THEN event_type || ':' || CAST(CAST(floor(value) AS BIGINT) % 13 AS VARCHAR) || 'd'
    WHEN 2 THEN event_type || ':' || CAST(CAST(floor(value) AS BIGINT) % 13 AS VARCHAR) || 'M'
    WHEN 3 THEN event_type || ':' || CAST(CAST(floor(value) AS BIGINT) % 13 AS VARCHAR) || 'q'
    WHEN 4 THEN event_type || ':' || CAST(CAST(floor(value) AS BIGINT) % 13 AS VARCHAR)
    WHEN 5 THEN event_type || ':*'
    ELSE event_type || ':' || props || ':1y' END AS spec FROM events"""

_PARSED = f"""WITH s AS ({_SPECS_TEXT}),
p AS (SELECT event_id, spec,
    CASE WHEN strpos(spec, ':') > 0 THEN split_part(spec, ':', 1) ELSE spec END AS name,
    CASE WHEN strpos(spec, ':') > 0 THEN substr(spec, strpos(spec, ':') + 1) END AS rest FROM s),
q AS (SELECT *,
    CASE WHEN regexp_full_match(rest, '[0-9]+[dDmMqQyY]') THEN TRY_CAST(regexp_extract(rest, '^([0-9]+)', 1) AS INTEGER)
         WHEN regexp_full_match(rest, '\\s*\\+?[0-9]+\\s*') THEN TRY_CAST(regexp_extract(rest, '([0-9]+)', 1) AS INTEGER) END AS n0,
    CASE WHEN regexp_full_match(rest, '[0-9]+[dDmMqQyY]') THEN
              CASE lower(right(rest, 1)) WHEN 'd' THEN 'day' WHEN 'm' THEN 'month' WHEN 'q' THEN 'quarter' WHEN 'y' THEN 'year' END
         WHEN regexp_full_match(rest, '\\s*\\+?[0-9]+\\s*') THEN 'day' END AS unit0 FROM p),
parsed AS (SELECT event_id, spec, name, CASE WHEN n0 > 0 THEN n0 END AS n, CASE WHEN n0 > 0 THEN unit0 END AS unit FROM q)"""

_EVENT_DATASETS = """ds AS (SELECT event_type AS dataset,
    CASE WHEN event_type = 'view' THEN 'folder' WHEN event_type = 'purchase' THEN 'table' ELSE 'partitioned' END AS kind,
    CASE WHEN event_type = 'purchase' THEN 'lake.sales.' || event_type ELSE 's3a://warehouse/' || event_type END AS location,
    CASE WHEN event_type = 'view' THEN NULL ELSE 'processed_date' END AS partition_column
  FROM (SELECT DISTINCT event_type FROM events) WHERE event_type <> 'error')"""

_TAGS = """WITH t AS (SELECT user_id AS step, ts, event_id,
    CAST(CAST(floor(value / 40) AS BIGINT) AS VARCHAR) AS n,
    (['day', 'month', 'quarter', 'year'])[user_id % 4 + 1] AS unit, event_type FROM events),
g AS (SELECT step, ts, event_id, CASE event_id % 3
    WHEN 0 THEN 'input--' || event_type || '--' || n || '--' || unit
    WHEN 1 THEN 'input--' || event_type || '--' || n
    ELSE 'output--' || event_type || '--' || n || '--' || unit END AS tag FROM t),
d AS (SELECT step, ts, event_id, string_split(tag, '--') AS parts FROM g),
k AS (SELECT step, ts, event_id, parts[2] AS name, TRY_CAST(parts[3] AS INTEGER) AS n,
    CASE WHEN len(parts) = 4 THEN parts[4] ELSE 'day' END AS unit
  FROM d WHERE parts[1] = 'input' AND len(parts) IN (3, 4) AND TRY_CAST(parts[3] AS INTEGER) > 0)
SELECT step, name, n, unit FROM (
  SELECT *, row_number() OVER (PARTITION BY step, name ORDER BY ts DESC, event_id DESC) AS rn FROM k) WHERE rn = 1"""

_GATE_SPECS = """specs(step, seq, direction, dataset, n, unit) AS (VALUES
  ('s1_copy', 1, 'input', 'ev', 5, 'day'),
  ('s1_copy', 1, 'output', 'out_missing', 5, 'day'),
  ('s2_month', 2, 'input', 'ev', 1, 'month'),
  ('s2_month', 2, 'output', 'out_missing', 1, 'month'),
  ('s3_done', 3, 'input', 'ev_unchecked', 1, 'month'),
  ('s3_done', 3, 'output', 'ev', 5, 'day'),
  ('s4_two_inputs', 4, 'input', 'ev', 5, 'day'),
  ('s4_two_inputs', 4, 'input', 'od', 3, 'month'),
  ('s4_two_inputs', 4, 'output', 'out_missing', 5, 'day'),
  ('s5_no_window', 5, 'input', 'ev', NULL, NULL),
  ('s5_no_window', 5, 'output', 'ev', NULL, NULL),
  ('s6_mixed_outputs', 6, 'input', 'ev', 3, 'day'),
  ('s6_mixed_outputs', 6, 'output', 'ev', 5, 'day'),
  ('s6_mixed_outputs', 6, 'output', 'od', NULL, NULL),
  ('s7_folder_none', 7, 'input', 'od', 1, 'day'),
  ('s7_folder_none', 7, 'output', 'od', 2, 'month'),
  ('s8_folder_done', 8, 'input', 'evf', 1, 'day'),
  ('s8_folder_done', 8, 'output', 'evf', 3, 'day'))"""

_GATE = f"""WITH {_GATE_SPECS},
datasets(dataset, kind, validate) AS (VALUES
  ('ev', 'partitioned', true), ('ev_unchecked', 'partitioned', false), ('od', 'folder', true), ('evf', 'folder', true), ('out_missing', 'partitioned', true)),
inv AS (
  SELECT DISTINCT 'ev' AS dataset, CAST(ts AS DATE) AS d FROM events
  UNION SELECT DISTINCT 'ev_unchecked', CAST(ts AS DATE) FROM events
  UNION SELECT DISTINCT 'evf', CAST(ts AS DATE) FROM events
  UNION SELECT DISTINCT 'od', CAST(o_orderdate AS DATE) FROM orders),
w AS (SELECT s.*, ds.kind, ds.validate, DATE '2024-01-15' AS p FROM specs s LEFT JOIN datasets ds USING (dataset) WHERE s.n > 0),
b AS (SELECT *,
    CASE unit WHEN 'day' THEN p - (n - 1)
              WHEN 'month' THEN CAST(date_trunc('month', p) - to_months(n - 1) AS DATE)
              WHEN 'quarter' THEN CAST(date_trunc('quarter', p) - to_months(3 * (n - 1)) AS DATE)
              ELSE make_date(year(p) - (n - 1), 1, 1) END AS lo,
    CASE unit WHEN 'day' THEN p
              WHEN 'month' THEN last_day(p)
              WHEN 'quarter' THEN last_day(CAST(date_trunc('quarter', p) AS DATE) + to_months(2))
              ELSE make_date(year(p), 12, 31) END AS hi
  FROM w),
expd AS (
  SELECT step, seq, direction, dataset, validate, CAST(lo + CAST(i AS INTEGER) AS DATE) AS d
  FROM (SELECT *, unnest(generate_series(0, datediff('day', lo, hi))) AS i FROM b WHERE kind <> 'folder')
  UNION ALL
  SELECT step, seq, direction, dataset, validate,
    CAST(CASE unit WHEN 'day' THEN p - (n - 1) + CAST(i AS INTEGER)
              WHEN 'month' THEN last_day(p - to_months(CAST(i AS INTEGER)))
              WHEN 'quarter' THEN last_day(CAST(date_trunc('quarter', p) AS DATE) + to_months(2 - 3 * CAST(i AS INTEGER)))
              ELSE make_date(year(p) - CAST(i AS INTEGER), 12, 31) END AS DATE) AS d
  FROM (SELECT *, unnest(generate_series(0, n - 1)) AS i FROM w WHERE kind = 'folder')),
miss AS (SELECT e.* FROM expd e WHERE NOT EXISTS (SELECT 1 FROM inv WHERE inv.dataset = e.dataset AND inv.d = e.d)),
steps AS (SELECT DISTINCT step, seq FROM specs),
gi AS (SELECT st.step, st.seq, COALESCE(m.missing_inputs, CAST([] AS VARCHAR[])) AS missing_inputs,
          CAST(COALESCE(m.n_missing_dates, 0) AS BIGINT) AS n_missing_dates
  FROM steps st LEFT JOIN (
    SELECT step, list_sort(list(DISTINCT dataset)) AS missing_inputs, count(*) AS n_missing_dates
    FROM miss WHERE direction = 'input' AND validate GROUP BY step) m USING (step)),
go AS (SELECT st.step, st.seq,
    CAST(COALESCE(c.n_outputs, 0) AS BIGINT) AS n_outputs,
    CAST(COALESCE(c.n_windowed_outputs, 0) AS BIGINT) AS n_windowed_outputs,
    CAST(COALESCE(m.n_missing_dates, 0) AS BIGINT) AS n_missing_dates,
    (COALESCE(c.n_windowed_outputs, 0) > 0 AND COALESCE(c.n_windowed_outputs, 0) = COALESCE(c.n_outputs, 0)
     AND COALESCE(m.n_missing_dates, 0) = 0) AS outputs_complete
  FROM steps st
  LEFT JOIN (SELECT step, count(*) AS n_outputs, count(CASE WHEN n > 0 THEN 1 END) AS n_windowed_outputs
             FROM specs WHERE direction = 'output' GROUP BY step) c USING (step)
  LEFT JOIN (SELECT step, count(*) AS n_missing_dates FROM miss WHERE direction = 'output' GROUP BY step) m USING (step))"""

GATING = {
    "parse_io_spec": f"{_PARSED} SELECT event_id, spec, name, n, unit FROM parsed",
    "parse_tags": _TAGS,
    "resolve_dataset": f"""{_PARSED}, {_EVENT_DATASETS}
SELECT event_id, name AS dataset, kind, location, partition_column, n, unit FROM parsed LEFT JOIN ds ON parsed.name = ds.dataset""",
    "unsatisfied_inputs": f"""WITH {_EVENT_DATASETS}
SELECT DISTINCT event_type AS dataset FROM events WHERE event_type NOT IN (SELECT dataset FROM ds)""",
    "gate_inputs": f"{_GATE} SELECT * FROM gi",
    "gate_outputs": f"{_GATE} SELECT * FROM go",
    "gate_decision": f"""{_GATE}
SELECT gi.step, gi.seq,
  CASE WHEN len(gi.missing_inputs) > 0 OR go.outputs_complete THEN 'SKIP' ELSE 'RUN' END AS decision,
  CASE WHEN len(gi.missing_inputs) > 0 THEN 'inputs' WHEN go.outputs_complete THEN 'outputs' END AS reason,
  gi.missing_inputs
FROM gi JOIN go USING (step)""",
    # The month's window ends on a day without events, so its step is skipped and the stage holds five days.
    "gated_run": f"""WITH e AS ({_EV}), w AS (SELECT * FROM e WHERE processed_date BETWEEN DATE '2024-01-11' AND DATE '2024-01-15'),
m AS (SELECT count(DISTINCT processed_date) = 31 AS whole FROM e WHERE processed_date BETWEEN DATE '2024-01-01' AND DATE '2024-01-31')
SELECT 'stage' AS step, 0 AS seq, 'SUCCESS' AS status, CAST(NULL AS VARCHAR) AS reason, 'SUCCESS' AS logged, (SELECT count(*) FROM w) AS n_rows FROM m
UNION ALL SELECT 'monthly', 1, CASE WHEN whole THEN 'SUCCESS' ELSE 'SKIP' END, CASE WHEN NOT whole THEN 'inputs' END, CASE WHEN whole THEN 'SUCCESS' ELSE 'SKIP' END, (SELECT count(*) FROM w) FROM m
UNION ALL SELECT 'clicks', 2, 'SUCCESS', NULL, 'SUCCESS', (SELECT count(*) FROM w WHERE event_type = 'click') FROM m""",
}

# --- run log and evaluation ------------------------------------------------------------

_TS = "strftime(ts, '%Y-%m-%d %H:%M:%S')"

RUNLOG = {
    "runlog_upsert_nodes": """SELECT user_id, event_type, event_id, ts, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""",
    "runlog_upsert_runs": """SELECT user_id, event_id, ts, event_type, value, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""",
    "runlog_max_id": "SELECT CAST(COALESCE(max(o_orderkey), 0) AS BIGINT) AS max_id FROM orders",
    "runlog_max_id_empty": "SELECT CAST(COALESCE(max(o_orderkey), 0) AS BIGINT) AS max_id FROM orders WHERE o_totalprice < 0",
    "run_report": f"""SELECT run_id, CAST(row_number() OVER (PARTITION BY run_id ORDER BY start_time, name, status, detail) - 1 AS BIGINT) AS pos,
  name, status, start_time, finish_time, detail FROM (
SELECT CAST(user_id AS VARCHAR) AS run_id, event_type AS name,
  CASE WHEN event_type = 'error' THEN 'ERROR' WHEN value < 10 THEN 'SKIP' ELSE 'SUCCESS' END AS status,
  {_TS} AS start_time,
  COALESCE(CASE WHEN value >= 50 THEN {_TS} END, '') AS finish_time,
  COALESCE(CASE WHEN event_type <> 'view' THEN props END, '') AS detail
FROM events)""",
    "runlog_arrays": """SELECT event_id,
  CASE WHEN event_type <> 'view' THEN [event_type] ELSE CAST([] AS VARCHAR[]) END AS inputs,
  CASE WHEN value > 20 THEN [event_type, props] ELSE CAST([] AS VARCHAR[]) END AS tags
FROM events""",
    "classification_metrics": """WITH c AS (SELECT quality AS y, toxic AS p, count(*) AS n FROM labels GROUP BY 1, 2),
pc AS (SELECT c, sum(support) AS support, sum(predicted) AS predicted, sum(tp) AS tp FROM (
    SELECT y AS c, n AS support, 0 AS predicted, CASE WHEN y = p THEN n ELSE 0 END AS tp FROM c
    UNION ALL SELECT p, 0, n, 0 FROM c) GROUP BY c),
s AS (SELECT *, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS prec,
               CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS rec FROM pc),
f AS (SELECT *, CASE WHEN prec + rec > 0 THEN 2 * prec * rec / (prec + rec) ELSE 0.0 END AS f1 FROM s)
SELECT round(sum(tp) / sum(support), 9) AS accuracy,
       round(sum(support * prec) / sum(support), 9) AS precision,
       round(sum(support * rec) / sum(support), 9) AS recall,
       round(sum(support * f1) / sum(support), 9) AS f1
FROM f""",
    "run_metrics_table": """SELECT 'n_features' AS metric, CAST(max(len(embedding)) AS DOUBLE) AS value, CAST(NULL AS VARCHAR) AS text FROM embeddings
UNION ALL SELECT 'n_classes', CAST(count(DISTINCT label) AS DOUBLE), NULL FROM embeddings
UNION ALL SELECT 'n_rows', CAST(count(*) AS DOUBLE), NULL FROM embeddings
UNION ALL SELECT 'max_iter', CAST(1000 AS DOUBLE), NULL
UNION ALL SELECT 'seed', CAST(42 AS DOUBLE), NULL
UNION ALL SELECT 'solver', NULL, 'l-bfgs'
UNION ALL SELECT 'family', NULL, 'multi''nomial'""",
    "test_split": "SELECT vec_id, label FROM embeddings WHERE CAST('0x' || substr(md5('42:' || CAST(vec_id AS VARCHAR)), 1, 8) AS BIGINT) < CAST(floor(0.2 * 4294967296) AS BIGINT)",
    "window_checks": """WITH e AS (SELECT event_id, CAST(event_id % 7 - 2 AS INTEGER) AS n, (['day', 'month', 'quarter', 'year', 'week'])[event_id % 5 + 1] AS unit FROM events)
SELECT *, n > 0 AND unit <> 'week' AS valid FROM e""",
}

# --- windows, spans and histories as tables ------------------------------------------

_PENDING = "SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders WHERE o_orderstatus = 'P'"
_ISLANDS = f"""WITH d AS ({_PENDING}), i AS (SELECT d, d - CAST(row_number() OVER (ORDER BY d) AS INTEGER) AS island FROM d),
s AS (SELECT min(d) AS first, max(d) AS last, count(*) AS n_dates FROM i GROUP BY island)"""

TABLES_OF_WINDOWS = {
    "inventory_spans": f"{_ISLANDS} SELECT first, last, n_dates FROM s",
    "inventory_gaps": f"""{_ISLANDS}, g AS (SELECT last + 1 AS first, lead(first) OVER (ORDER BY first) - 1 AS last FROM s)
SELECT CAST(first AS DATE) AS first, CAST(last AS DATE) AS last, datediff('day', first, last) + 1 AS n_dates FROM g WHERE last IS NOT NULL""",
    "completeness_all_dates": f"""{_P}, inv AS MATERIALIZED ({_PENDING}),
w AS (SELECT processing_date, 'day' AS unit, processing_date - 4 AS lo, processing_date AS hi FROM p
  UNION ALL SELECT processing_date, 'month', CAST(date_trunc('month', processing_date) - to_months(1) AS DATE), last_day(processing_date) FROM p
  UNION ALL SELECT processing_date, 'quarter', CAST(date_trunc('quarter', processing_date) - to_months(3) AS DATE),
    last_day(CAST(date_trunc('quarter', processing_date) AS DATE) + to_months(2)) FROM p
  UNION ALL SELECT processing_date, 'year', make_date(year(processing_date) - 1, 1, 1), make_date(year(processing_date), 12, 31) FROM p),
e AS (SELECT processing_date, unit, unnest(generate_series(0, datediff('day', lo, hi))) AS i, lo FROM w)
SELECT processing_date, unit, count(*) AS n_expected, count(*) - count(inv.d) AS n_missing
FROM e LEFT JOIN inv ON inv.d = CAST(e.lo + CAST(e.i AS INTEGER) AS DATE) GROUP BY 1, 2""",
    "scan_windows_table": f"""WITH e AS ({_EV}),
s AS (SELECT processed_date AS p FROM e WHERE event_type = 'error' AND value > 60 GROUP BY 1 HAVING max(value) > 300)
SELECT * FROM e WHERE EXISTS (SELECT 1 FROM s WHERE e.processed_date BETWEEN s.p - 1 AND s.p)""",
    "live_rows_by_date": """WITH f AS (SELECT CAST(o_orderdate AS DATE) AS d, o_orderkey % 5 AS k, count(*) FILTER (NOT (l_returnflag = 'R' OR l_discount > 0.05)) AS n
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2)
SELECT d AS partition_date, count(*) AS n_files, CAST(sum(n) AS BIGINT) AS n_rows FROM f WHERE n > 0 AND (dayofyear(d) + k) % 3 <> 2 GROUP BY 1""",
    "live_rows_equality": """WITH e AS (SELECT event_id, CASE WHEN event_id % 40 <> 0 THEN user_id END AS user_id, event_type FROM events)
SELECT event_id, user_id, event_type FROM e WHERE event_type <> 'error' AND NOT EXISTS (
  SELECT 1 FROM e x WHERE x.event_type = 'error' AND x.user_id IS NOT DISTINCT FROM e.user_id AND x.event_id > e.event_id)""",
    "live_dates_as_of": f"""{_P}, m AS (SELECT DISTINCT CAST(date_trunc('month', processing_date) AS DATE) AS m FROM p),
a AS (SELECT processing_date AS asked, (SELECT max(m) FROM m WHERE CAST(m.m + 9 AS TIMESTAMP) + INTERVAL 12 HOUR <= CAST(p.processing_date AS TIMESTAMP)) AS m FROM p),
l AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders WHERE o_orderkey % 10 <> 0 AND o_orderkey % 3 IN (0, 1))
SELECT asked, CAST(year(m) * 100 + month(m) AS BIGINT) AS snapshot_id, d AS live_date
FROM a JOIN l ON CAST(date_trunc('month', d) AS DATE) IN (m, CAST(m - to_months(1) AS DATE))""",
    "join_primary_bucketed": TRANSFORMS["join_primary"],
    "join_feature_bucketed": TRANSFORMS["join_feature"],
    "gated_run_unordered": GATING["gated_run"],
    "runlog_snapshot_tail": RUNLOG["runlog_upsert_nodes"],
}


def _newton_sql(rounds: int) -> str:
    """The rounds of the Newton solver one after another: probabilities, sums, new weights."""
    test = "CAST('0x' || substr(md5('42:' || CAST(vec_id AS VARCHAR)), 1, 8) AS BIGINT) < CAST(floor(0.2 * 4294967296) AS BIGINT)"
    sql = f"""WITH r AS MATERIALIZED (SELECT vec_id, label, {test} AS is_test, list_append(list_transform(embedding, lambda v: v::DOUBLE), 1.0::DOUBLE) AS x
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL),
k AS MATERIALIZED (SELECT DISTINCT label AS k FROM r WHERE NOT is_test),
j AS MATERIALIZED (SELECT unnest(range(1, (SELECT max(len(x)) FROM r) + 1)) AS j),
w0 AS (SELECT k, list_transform(range((SELECT max(len(x)) FROM r)), lambda i: 0.0::DOUBLE) AS w FROM k)"""
    for n in range(rounds):
        sql += f""",
z{n} AS (SELECT vec_id, label, x, k, w, exp(list_inner_product(x, w)) AS e FROM r, w{n} WHERE NOT is_test),
p{n} AS MATERIALIZED (SELECT *, e / sum(e) OVER (PARTITION BY vec_id) AS p FROM z{n}),
s{n} AS MATERIALIZED (SELECT k, j, any_value(w[j]) AS old, sum((p - (label = k)::INTEGER) * x[j]) AS g, sum(p * (1 - p) * x[j] * x[j]) AS c,
  CASE WHEN j < (SELECT max(j) FROM j) THEN 1.0 ELSE 0.0 END AS ridge FROM p{n}, j GROUP BY k, j),
w{n + 1} AS MATERIALIZED (SELECT k, list(CASE WHEN c + ridge > 0 THEN round(old - (g + ridge * old) / (c + ridge), 9) ELSE old END ORDER BY j) AS w FROM s{n} GROUP BY k)"""
    return sql + f"""
SELECT vec_id, label, CAST(arg_max(k, (round(list_inner_product(x, w), 9), -k)) AS INTEGER) AS prediction
FROM r, w{rounds} WHERE is_test GROUP BY vec_id, label"""


MODELS = {"train_logistic": _newton_sql(12)}

ORACLE_SQL: dict[str, str] = {
    **CAL,
    "valid_iso_date": VALID_ISO_DATE,
    **SCANS,
    **INVENTORY,
    **TABLE_FORMAT,
    **TRANSFORMS,
    **GATING,
    **RUNLOG,
    **TABLES_OF_WINDOWS,
    **MODELS,
}
