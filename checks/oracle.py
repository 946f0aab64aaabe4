"""SQL (DuckDB dialect) that must give the same rows as the queries of the same name."""

from __future__ import annotations

from tidemark.schemas import REGISTRATION_COLUMNS, REGISTRATION_WIDTHS

# Shaped views of the tables, shared by several queries.
USER_DAYS = """
user_days AS (
  SELECT user_id, data_date,
         CASE WHEN event_type = 'purchase' THEN 'P' ELSE 'N' END AS segment,
         CAST(CASE WHEN value < 5 THEN NULL WHEN value < 100 THEN 1 ELSE 2 END AS INTEGER) AS bucket
  FROM (SELECT *, CAST(ts AS DATE) AS data_date,
               row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) AS rn
        FROM events)
  WHERE rn = 1)
"""

HISTORY_SQL_NULL = """
history AS (
  SELECT user_id, data_date, segment, bucket
  FROM (SELECT *, lag(segment) OVER w AS p_segment, lag(bucket) OVER w AS p_bucket, row_number() OVER w AS rn
        FROM user_days WINDOW w AS (PARTITION BY user_id ORDER BY data_date))
  WHERE rn = 1 OR NOT coalesce(segment = p_segment AND bucket = p_bucket, FALSE))
"""

HISTORY_NULL_SAFE = """
history AS (
  SELECT user_id, data_date, segment, bucket
  FROM (SELECT *, lag(segment) OVER w AS p_segment, lag(bucket) OVER w AS p_bucket, row_number() OVER w AS rn
        FROM user_days WINDOW w AS (PARTITION BY user_id ORDER BY data_date))
  WHERE rn = 1 OR segment IS DISTINCT FROM p_segment OR bucket IS DISTINCT FROM p_bucket)
"""

SHIPPING_LOG = """
shipping_log AS (
  SELECT l_returnflag, l_linestatus, CAST(l_quantity AS INTEGER) AS quantity,
         CAST(round(l_discount * 100) AS INTEGER) AS discount, CAST(round(l_tax * 100) AS INTEGER) AS tax,
         CASE WHEN l_linenumber <= 2 THEN NULL WHEN l_linenumber <= 4 THEN '' ELSE 'late' END AS note,
         CAST(year(l_shipdate) AS INTEGER) AS batch
  FROM lineitem),
printed AS (
  SELECT *, md5(coalesce(l_returnflag, '') || '||' || coalesce(l_linestatus, '') || '||' ||
                coalesce(CAST(quantity AS VARCHAR), '') || '||' || coalesce(CAST(discount AS VARCHAR), '') || '||' ||
                coalesce(CAST(tax AS VARCHAR), '') || '||' ||
                coalesce(note, '')) AS fp
  FROM shipping_log)
"""

LOG_ORDER = "l_returnflag, l_linestatus, quantity, discount, tax, note NULLS FIRST"

DATED_ORDERS = """
dated_orders AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, CAST(o_orderdate AS DATE) AS data_date,
         CASE WHEN o_totalprice < 8000 THEN '##/##/####' ELSE strftime(o_orderdate, '%m/%d/%Y') END AS registr_dt
  FROM orders)
"""

PLACEHOLDERS = DATED_ORDERS + ", placeholders AS (SELECT * FROM dated_orders WHERE registr_dt = '##/##/####')"

FILES = """
files AS (
  SELECT 'feed_' || CAST(o_custkey AS VARCHAR) || '.txt' AS file_name,
         CASE WHEN count(*) > 5 THEN CAST(max(CAST(o_orderdate AS DATE)) AS VARCHAR) END AS "timestamp"
  FROM orders GROUP BY o_custkey),
ledger AS (
  SELECT 'feed_' || CAST(o_custkey AS VARCHAR) || '.txt' AS file_name,
         CAST(max(CAST(o_orderdate AS DATE)) AS VARCHAR) AS "timestamp",
         CASE WHEN count(*) > 3 THEN TRUE WHEN count(*) > 1 THEN FALSE END AS processed,
         CASE WHEN min(o_orderpriority) = '1-URGENT' THEN TRUE WHEN max(o_orderpriority) = '5-LOW' THEN FALSE END AS archived
  FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey),
pending AS (
  SELECT f.file_name, f."timestamp", l."timestamp" AS old_stamp, l.archived
  FROM files f LEFT JOIN ledger l USING (file_name)
  WHERE f."timestamp" IS NOT NULL
    AND (f."timestamp" IS DISTINCT FROM l."timestamp" OR NOT coalesce(l.processed, TRUE)))
"""

CODED = """
coded AS (
  SELECT user_id, data_date,
         segment || CASE WHEN weekofyear(data_date) % 2 = 0 THEN 'X' ELSE 'Y' END AS segment_abbrv,
         segment AS segment_desc, coalesce(bucket, 0) AS bucket, CAST(weekofyear(data_date) AS INTEGER) AS age
  FROM user_days),
coded_history AS (
  SELECT * EXCLUDE (pc, pd, pb, pa, rn)
  FROM (SELECT *, lag(segment_abbrv) OVER w AS pc, lag(segment_desc) OVER w AS pd, lag(bucket) OVER w AS pb,
               lag(age) OVER w AS pa, row_number() OVER w AS rn
        FROM coded WINDOW w AS (PARTITION BY user_id ORDER BY data_date))
  WHERE rn = 1 OR segment_abbrv <> pc OR segment_desc <> pd OR bucket <> pb OR age <> pa),
coded_changes AS (
  SELECT user_id, data_date, segment_abbrv, segment_desc, bucket, age,
         CASE WHEN rn > 1 AND segment_abbrv <> pc AND segment_desc = pd THEN 'segment_abbrv' ELSE '' END AS recoded,
         rn > 1 AND segment_abbrv <> pc AND segment_desc = pd AND bucket = pb AND (age = pa OR age = pa + 1) AS is_code_only
  FROM (SELECT *, lag(segment_abbrv) OVER w AS pc, lag(segment_desc) OVER w AS pd, lag(bucket) OVER w AS pb,
               lag(age) OVER w AS pa, row_number() OVER w AS rn
        FROM coded_history WINDOW w AS (PARTITION BY user_id ORDER BY data_date)))
"""

PEOPLE = """
people AS (
  SELECT CAST(user_id AS VARCHAR) AS ncid, data_date, segment AS party_cd, CAST(bucket + 1980 AS INTEGER) AS birth_year,
         'name ' || CAST(user_id AS VARCHAR) AS last_name
  FROM user_days)
"""

TURNOUT = """
turnout AS (
  SELECT CAST(l_partkey AS VARCHAR) AS ncid, make_date(2000, l_linenumber, 3) AS election_lbl,
         l_returnflag AS voting_method, l_linestatus AS voted_party_cd, make_date(year(l_shipdate), 12, 31) AS data_date
  FROM lineitem)
"""

FIRST_YEARS = """
      SELECT ncid, election_lbl, voting_method, voted_party_cd, data_date
      FROM (SELECT *, rank() OVER (PARTITION BY ncid, election_lbl, voting_method, voted_party_cd ORDER BY data_date) AS r FROM turnout)
      WHERE r = 1"""

# What the registration files hold as text; all other columns are empty.
_FILE_TEXT = {
    "ncid": "ncid", "party_cd": "party_cd", "birth_year": "coalesce(CAST(birth_year AS VARCHAR), '')", "age_at_year_end": "'44'",
    "last_name": "'  ' || replace(last_name, 'name ', 'name  ')",
}

# Percentages are rounded half up in whole numbers, so no binary fraction can shift a tie.
def _percent(part: str, whole: str) -> str:
    return f"CAST((20000 * ({part}) + ({whole})) // (2 * ({whole})) AS BIGINT) / 100.0"


def _kept(values: str, null_safe: bool, source: str, key: str = "ncid") -> str:
    names = [v.strip() for v in values.split(",")]
    lags = ", ".join(f"lag({n}) OVER w AS p_{n}" for n in names)
    if null_safe:
        differs = " OR ".join(f"{n} IS DISTINCT FROM p_{n}" for n in names)
    else:
        differs = "NOT coalesce(" + " AND ".join(f"{n} = p_{n}" for n in names) + ", FALSE)"
    return f"""
      SELECT {key}, data_date, {values}
      FROM (SELECT *, {lags}, row_number() OVER w AS rn FROM {source} WINDOW w AS (PARTITION BY {key} ORDER BY data_date))
      WHERE rn = 1 OR {differs}"""


def _with(*views: str) -> str:
    return "WITH " + ",".join(v.strip() for v in views)


SQL = {
    "latest_per_key": """
      SELECT user_id, event_id, event_type
      FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
      WHERE rn = 1""",
    "asof_view": _with(USER_DAYS) + """
      SELECT user_id, data_date, segment, bucket
      FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY data_date DESC) AS rn
            FROM user_days WHERE data_date <= DATE '2024-01-15')
      WHERE rn = 1""",
    "rebuild_changes_sql_null": _with(USER_DAYS, HISTORY_SQL_NULL) + " SELECT * FROM history",
    "rebuild_changes_null_safe": _with(USER_DAYS, HISTORY_NULL_SAFE) + " SELECT * FROM history",
    "apply_snapshot_sql_null": _with(USER_DAYS) + """
      SELECT * FROM user_days s
      WHERE data_date = (SELECT max(data_date) FROM user_days)
        AND NOT EXISTS (
          SELECT 1 FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY data_date DESC) AS rn
                         FROM user_days WHERE data_date < (SELECT max(data_date) FROM user_days)) l
          WHERE l.rn = 1 AND l.user_id = s.user_id AND l.segment = s.segment AND l.bucket = s.bucket)""",
    "apply_snapshot_null_safe": _with(USER_DAYS) + """
      SELECT * FROM user_days s
      WHERE data_date = (SELECT max(data_date) FROM user_days)
        AND NOT EXISTS (
          SELECT 1 FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY data_date DESC) AS rn
                         FROM user_days WHERE data_date < (SELECT max(data_date) FROM user_days)) l
          WHERE l.rn = 1 AND l.user_id = s.user_id AND l.segment = s.segment
            AND l.bucket IS NOT DISTINCT FROM s.bucket)""",
    "row_fingerprints": """
      SELECT o_orderkey,
             md5(coalesce(CAST(o_orderkey AS VARCHAR), '') || '||' || coalesce(CAST(o_custkey AS VARCHAR), '') || '||' ||
                 coalesce(o_orderstatus, '') || '||' ||
                 coalesce(CAST(CAST(o_orderdate AS DATE) - DATE '0001-01-01' AS VARCHAR), '') || '||' ||
                 coalesce(o_orderpriority, '')) AS fingerprint
      FROM orders""",
    "history_new_rows": _with(SHIPPING_LOG) + """
      SELECT l_returnflag, l_linestatus, quantity, discount, tax, note, batch FROM printed s
      WHERE batch = (SELECT max(batch) FROM printed)
        AND NOT EXISTS (SELECT 1 FROM printed h WHERE h.batch < (SELECT max(batch) FROM printed) AND h.fp = s.fp)""",
    "history_new_rows_dedupe": _with(SHIPPING_LOG) + f"""
      SELECT l_returnflag, l_linestatus, quantity, discount, tax, note, batch
      FROM (SELECT *, row_number() OVER (PARTITION BY fp ORDER BY {LOG_ORDER}) AS rn
            FROM printed WHERE batch = (SELECT max(batch) FROM printed)) s
      WHERE rn = 1
        AND NOT EXISTS (SELECT 1 FROM printed h WHERE h.batch < (SELECT max(batch) FROM printed) AND h.fp = s.fp)""",
    "history_rebuild": _with(SHIPPING_LOG) + """
      SELECT l_returnflag, l_linestatus, quantity, discount, tax, note, batch
      FROM (SELECT *, rank() OVER (PARTITION BY fp ORDER BY batch) AS r FROM printed) WHERE r = 1""",
    "history_rebuild_dedupe": _with(SHIPPING_LOG) + f"""
      SELECT l_returnflag, l_linestatus, quantity, discount, tax, note, batch
      FROM (SELECT *, row_number() OVER (PARTITION BY fp ORDER BY batch, {LOG_ORDER}) AS r FROM printed) WHERE r = 1""",
    "whitespace_normalized": r"""
      SELECT doc_id,
             trim(regexp_replace(text, '[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+', ' ', 'g'), ' ') AS text,
             trim(regexp_replace(source, '[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+', ' ', 'g'), ' ') AS source
      FROM documents""",
    "int_lenient": """
      WITH spelled AS (
        SELECT p_partkey,
               CASE WHEN p_size <= 4 THEN '' WHEN p_size <= 8 THEN CAST(p_size AS VARCHAR) || 'x0'
                    WHEN p_size <= 14 THEN CAST(p_size AS VARCHAR) || '.0' WHEN p_size <= 20 THEN '+' || CAST(p_size AS VARCHAR)
                    WHEN p_size <= 24 THEN CAST(p_size AS VARCHAR) || '.5' WHEN p_size <= 30 THEN '00' || CAST(p_size AS VARCHAR)
                    WHEN p_size <= 34 THEN CAST(p_size AS VARCHAR) || 'e2' WHEN p_size <= 38 THEN '99999999' || CAST(p_size AS VARCHAR)
                    ELSE CAST(p_size AS VARCHAR) END AS size_text
        FROM part),
      numbers AS (SELECT *, try_cast(size_text AS DOUBLE) AS n FROM spelled)
      SELECT p_partkey, size_text,
             CASE WHEN n = floor(n) AND n BETWEEN -2147483648 AND 2147483647 THEN CAST(n AS INTEGER) END AS size
      FROM numbers""",
    "date_lenient": _with(DATED_ORDERS) + """
      SELECT o_orderkey, CAST(try_strptime(registr_dt, '%m/%d/%Y') AS DATE) AS registered FROM dated_orders""",
    "schema_aligned": "SELECT c_mktsegment, c_custkey, CAST(NULL AS VARCHAR) AS c_phone, c_name FROM customer",
    "placeholder_by_count": _with(PLACEHOLDERS) + """
      SELECT data_date, count(*) AS record_count FROM placeholders GROUP BY data_date ORDER BY record_count DESC, data_date DESC""",
    "placeholder_by_date": _with(PLACEHOLDERS) + """
      SELECT data_date, count(*) AS record_count FROM placeholders GROUP BY data_date ORDER BY data_date DESC""",
    "placeholder_rows": _with(PLACEHOLDERS) + " SELECT * FROM placeholders ORDER BY data_date DESC, o_orderkey",
    "placeholder_breakdown": _with(PLACEHOLDERS) + f""",
      counts AS (SELECT o_orderstatus, o_orderpriority, count(*) AS record_count FROM placeholders GROUP BY ALL),
      total AS (SELECT CAST(sum(record_count) AS BIGINT) AS t FROM counts)
      SELECT o_orderstatus, o_orderpriority, record_count, {_percent("record_count", "t")} AS pct_of_placeholder_rows
      FROM counts, total ORDER BY record_count DESC""",
    "placeholder_share": _with(DATED_ORDERS) + f""",
      counts AS (SELECT o_custkey, count(*) AS record_count,
                        count(*) FILTER (registr_dt = '##/##/####') AS placeholder_count FROM dated_orders GROUP BY o_custkey),
      total AS (SELECT CAST(sum(placeholder_count) AS BIGINT) AS t FROM counts)
      SELECT o_custkey, record_count, placeholder_count,
             {_percent("placeholder_count", "record_count")} AS pct_of_group,
             {_percent("placeholder_count", "t")} AS pct_of_placeholder_rows
      FROM counts, total""",
    "placeholder_spikes": _with(PLACEHOLDERS) + """,
      counts AS (SELECT data_date, count(*) AS record_count FROM placeholders GROUP BY data_date)
      SELECT data_date, record_count FROM counts
      WHERE record_count * (SELECT count(*) FROM counts) > (SELECT sum(record_count) FROM counts)""",
    "placeholder_backfill": _with(DATED_ORDERS) + """
      SELECT *, CASE WHEN registr_dt <> '##/##/####' THEN registr_dt
                     ELSE first_value(CASE WHEN registr_dt <> '##/##/####' THEN registr_dt END IGNORE NULLS) OVER (
                       PARTITION BY o_custkey ORDER BY data_date, o_orderkey
                       ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) END AS registr_dt_filled
      FROM dated_orders""",
    "key_violations": """
      SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem GROUP BY ALL HAVING count(*) > 1""",
    "null_keys": _with(USER_DAYS) + " SELECT * FROM user_days WHERE user_id IS NULL OR bucket IS NULL",
    "duplicate_groups": """
      SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS row_count FROM events GROUP BY ALL HAVING count(*) > 1""",
    "duplicate_profile": """
      WITH groups AS (SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY ALL)
      SELECT count(*) FILTER (n > 1) AS duplicate_groups, CAST(sum(n) FILTER (n > 1) AS BIGINT) AS duplicate_rows,
             round(CAST(sum(n) FILTER (n > 1) AS DOUBLE) / count(*) FILTER (n > 1), 6) AS mean_rows_per_group,
             count(*) AS groups, CAST(sum(n) AS BIGINT) AS rows
      FROM groups""",
    "pending_files": _with(FILES) + ' SELECT file_name, "timestamp" FROM pending',
    "needs_backup": _with(FILES) + """
      SELECT coalesce(bool_or("timestamp" IS DISTINCT FROM old_stamp OR NOT coalesce(archived, FALSE)), FALSE) AS needs_backup
      FROM pending""",
    "ledger_upsert": _with(FILES) + """
      SELECT file_name, "timestamp", TRUE AS processed, archived FROM pending
      UNION ALL
      SELECT file_name, "timestamp", processed, archived FROM ledger WHERE file_name NOT IN (SELECT file_name FROM pending)""",
    "change_classification": _with(USER_DAYS, HISTORY_SQL_NULL) + """
      SELECT user_id, data_date, segment, bucket, segment_changed, bucket_changed,
             CASE WHEN rn = 1 THEN 'new' WHEN segment_changed THEN 'segment' WHEN bucket_changed THEN 'bucket' ELSE 'other' END AS change_class
      FROM (SELECT *, row_number() OVER w AS rn,
                   row_number() OVER w > 1 AND segment IS DISTINCT FROM lag(segment) OVER w AS segment_changed,
                   row_number() OVER w > 1 AND bucket IS DISTINCT FROM lag(bucket) OVER w AS bucket_changed
            FROM history WINDOW w AS (PARTITION BY user_id ORDER BY data_date))""",
    "code_only_changes": _with(USER_DAYS, CODED) + " SELECT * FROM coded_changes",
    "changes_per_key": _with(USER_DAYS, CODED) + """
      SELECT user_id, count(*) AS versions, count(*) - 1 AS changes,
             count(*) - 1 - count(*) FILTER (is_code_only) AS changes_without_code_only
      FROM coded_changes GROUP BY user_id""",
    "label_drift": f"""
      WITH counts AS (SELECT o_orderpriority, CAST(year(o_orderdate) AS INTEGER) AS period, count(*) AS record_count FROM orders GROUP BY ALL),
      totals AS (SELECT period, CAST(sum(record_count) AS BIGINT) AS t FROM counts GROUP BY period)
      SELECT o_orderpriority, period, record_count, {_percent("record_count", "t")} AS pct_of_period
      FROM counts JOIN totals USING (period)""",
    "label_span": """
      SELECT o_orderpriority, CAST(min(o_orderdate) AS DATE) AS first_seen, CAST(max(o_orderdate) AS DATE) AS last_seen,
             count(*) AS record_count
      FROM orders GROUP BY o_orderpriority""",
    "latest_label": """
      SELECT l_orderkey, l_linenumber, data_date, l_returnflag, l_linestatus, l_partkey
      FROM (SELECT *, CAST(l_shipdate AS DATE) AS data_date,
                   row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                     ORDER BY CAST(l_shipdate AS DATE) DESC, l_returnflag DESC, l_linestatus DESC, l_partkey DESC) AS rn
            FROM lineitem)
      WHERE rn = 1""",
    "layout_conformance": """
      SELECT 'c_name' AS column_name, 18 AS declared_width, CAST(max(length(c_name)) AS INTEGER) AS max_length,
             count(*) FILTER (length(c_name) > 18) AS rows_over_width, count(*) FILTER (length(c_name) > 18) = 0 AS conforms
      FROM customer
      UNION ALL
      SELECT 'c_mktsegment', 9, CAST(max(length(c_mktsegment)) AS INTEGER),
             count(*) FILTER (length(c_mktsegment) > 9), count(*) FILTER (length(c_mktsegment) > 9) = 0
      FROM customer""",
    "key_link": """
      SELECT o_orderkey, o_custkey, o_orderstatus, c_name, c_nationkey, c_acctbal, c_mktsegment
      FROM orders JOIN customer ON o_custkey = c_custkey""",
    "key_link_latest": _with(USER_DAYS) + """
      SELECT e.user_id, event_id, event_type, data_date, segment, bucket
      FROM events e
      JOIN (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY data_date DESC) AS rn FROM user_days) l
        ON l.user_id = e.user_id AND l.rn = 1""",
    "key_link_asof": """
      WITH bought AS (
        SELECT user_id, data_date, purchase_id, value
        FROM (SELECT user_id, CAST(ts AS DATE) AS data_date, event_id AS purchase_id, value,
                     row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY event_id DESC) AS rn
              FROM events WHERE event_type = 'purchase')
        WHERE rn = 1),
      others AS (SELECT user_id, event_id, event_type, CAST(ts AS DATE) AS day FROM events WHERE event_type <> 'purchase')
      SELECT o.user_id, event_id, event_type, day, data_date, purchase_id, value
      FROM others o ASOF JOIN bought b ON o.user_id = b.user_id AND o.day >= b.data_date""",
    "decode_codes": """
      SELECT c_custkey, c_nationkey, n_name AS nation
      FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_name <> 'NATION_7') ON c_nationkey = n_nationkey""",
    "unknown_codes": """
      SELECT c_nationkey, count(*) AS row_count FROM customer
      WHERE c_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_name <> 'NATION_7') GROUP BY c_nationkey""",
    "snapshot_scan": _with(DATED_ORDERS) + """
      SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderpriority, registr_dt,
             CAST(try_strptime(registr_dt, '%m/%d/%Y') AS DATE) AS registered
      FROM dated_orders""",
    "backup_restore": """
      SELECT doc_id, text, CASE WHEN lang = 'en' THEN '' WHEN lang <> 'de' THEN lang END AS lang, n_chars FROM documents""",
    "registration_rebuild_files": _with(USER_DAYS, PEOPLE) + _kept("party_cd, birth_year, last_name", False, "people"),
    "registration_stream": _with(USER_DAYS, PEOPLE) + _kept("party_cd, birth_year, last_name", True, "people"),
    "registration_incremental": _with(USER_DAYS, PEOPLE) + _kept("party_cd, birth_year, last_name", False, "people"),
    "registration_late": _with(USER_DAYS, PEOPLE) + _kept("party_cd, birth_year, last_name", False, "people"),
    "registration_layouts": _with(USER_DAYS, PEOPLE) + " SELECT * EXCLUDE (birth_year) FROM (" + _kept("party_cd, birth_year, last_name", True, "people") + ")",
    "registration_report": _with(USER_DAYS, PEOPLE) + """,
      aged AS (SELECT *, CASE WHEN party_cd <> 'P' THEN 44 END AS age FROM people),
      kept AS (""" + _kept("party_cd, birth_year, last_name, age", False, "aged") + """)
      SELECT strftime(data_date, '%Y%m%d') AS stamp, count(*) AS staged,
             count(*) FILTER ((ncid, data_date) IN (SELECT (ncid, data_date) FROM kept)) AS inserted,
             count(*) FILTER (party_cd = 'P') AS failed_values, CAST(0 AS BIGINT) AS short_rows, CAST(0 AS BIGINT) AS long_rows
      FROM aged GROUP BY data_date""",
    "quality_counts": """
      SELECT CAST(date_trunc('year', o_orderdate) AS DATE) AS data_date, count(*) AS staged, CAST(0 AS BIGINT) AS failed_values,
             count(*) FILTER (o_orderkey % 11 = 1) AS long_rows, count(*) FILTER (o_orderkey % 11 IN (2, 3)) AS short_rows,
             count(*) FILTER (o_orderkey % 11 = 3) AS broken_quotes
      FROM orders GROUP BY 1""",
    "layout_widths": _with(USER_DAYS, PEOPLE) + " UNION ALL ".join(
        f"""
      SELECT '{c}' AS column_name, {w} AS declared_width, CAST(max(length({_FILE_TEXT.get(c, "''")})) AS INTEGER) AS max_length,
             count(*) FILTER (length({_FILE_TEXT.get(c, "''")}) > {w}) AS rows_over_width,
             count(*) FILTER (length({_FILE_TEXT.get(c, "''")}) > {w}) = 0 AS conforms FROM people"""
        for c, w in REGISTRATION_WIDTHS.items() if c in REGISTRATION_COLUMNS
    ),
    "prepared_csv": "SELECT * FROM customer",
    "appended_rows": "SELECT o_orderkey, o_orderstatus, CAST(date_trunc('month', o_orderdate) AS DATE) AS data_date FROM orders WHERE o_orderstatus IN ('F', 'O', 'P')",
    "table_columns": " UNION ALL ".join(
        f"SELECT {k} AS position, '{c}' AS name, {str(c == 'data_date').lower()} AS is_date, count({'o_orderdate' if c == 'data_date' else c}) AS n_values FROM orders"
        for k, c in enumerate(["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority", "data_date"])
    ),
    "code_names": """
      SELECT c_custkey, CAST(c_nationkey AS VARCHAR) AS code, n_name AS nation FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "ledger_scan": _with(FILES) + """
      SELECT file_name, "timestamp", TRUE AS processed,
             CASE WHEN processed IS NULL AND contains(file_name, '9.txt') THEN NULL ELSE archived END AS archived
      FROM ledger""",
    "http_dates": "SELECT event_id, strftime(ts, '%a, %d %b %Y %H:%M:%S GMT') AS stamp FROM events",
    "duplicate_profile_wide": """
      WITH groups AS (SELECT l_returnflag, l_linestatus, l_quantity, l_discount, l_tax, count(*) AS n FROM lineitem GROUP BY ALL)
      SELECT count(*) FILTER (n > 1) AS duplicate_groups, CAST(coalesce(sum(n) FILTER (n > 1), 0) AS BIGINT) AS duplicate_rows,
             round(CAST(sum(n) FILTER (n > 1) AS DOUBLE) / count(*) FILTER (n > 1), 6) AS mean_rows_per_group,
             count(*) AS groups, CAST(sum(n) AS BIGINT) AS rows
      FROM groups""",
    "participation_incremental": _with(TURNOUT) + FIRST_YEARS + """
      UNION ALL
      SELECT 'new ' || ncid, election_lbl, voting_method, voted_party_cd, data_date FROM turnout
      WHERE data_date = (SELECT min(data_date) FROM turnout)""",
    "participation_backup": _with(TURNOUT) + FIRST_YEARS,
    "log_versions": _with(TURNOUT) + """
      SELECT CAST(data_date AS VARCHAR) AS day, count(*) AS n_rows
      FROM (SELECT ncid, election_lbl, voting_method, voted_party_cd, min(data_date) AS data_date FROM turnout GROUP BY ALL) GROUP BY day""",
    "participation_rebuild_files": _with(TURNOUT) + FIRST_YEARS,
    "participation_stream": _with(TURNOUT) + """
      SELECT ncid, election_lbl, voting_method, voted_party_cd, min(data_date) AS data_date FROM turnout GROUP BY ALL""",
}
