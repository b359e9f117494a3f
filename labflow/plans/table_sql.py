"""The table queries as ANSI SQL, written independently of the operators."""

FEED = """
feed AS (
  SELECT 'S-' || o_custkey AS sample_id,
         CASE WHEN o_orderkey % 41 = 0 THEN '12/01/2025' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS test_date,
         CASE WHEN o_orderkey % 17 = 0 THEN 'Positive' WHEN o_orderstatus = 'F' THEN 'POS'
              WHEN o_orderstatus = 'O' THEN 'NEG' ELSE 'N/A' END AS result,
         CASE WHEN o_orderkey % 29 = 0 THEN 'x' WHEN o_orderkey % 31 = 0 THEN NULL
              ELSE CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) END AS viral_load,
         'Lab_Results_' || (o_orderkey % 5) || '.csv' AS source_file,
         o_orderkey AS row_pos, o_orderdate
  FROM orders)"""

CHECKED = (
    FEED
    + """,
parsed AS (
  SELECT *,
         CASE WHEN regexp_full_match(test_date, '[0-9]{4}-[0-9]{2}-[0-9]{2}')
              THEN try_cast(test_date AS DATE) END AS valid_date,
         CASE WHEN regexp_full_match(viral_load, '[0-9]+') THEN try_cast(viral_load AS BIGINT) END AS valid_load
  FROM feed),
checked AS (
  SELECT *, sample_id IS NOT NULL AND valid_date IS NOT NULL AND coalesce(result IN ('POS', 'NEG', 'N/A'), false)
            AND valid_load IS NOT NULL AS ok
  FROM parsed)"""
)

VALID = (
    CHECKED
    + """,
valid AS (
  SELECT sample_id, valid_date AS test_date, result, valid_load AS viral_load, source_file, row_pos,
         CAST(year(valid_date) AS INTEGER) AS year, CAST(week(valid_date) AS INTEGER) AS week,
         row_pos % 2 = 1 AS is_batch
  FROM checked WHERE ok)"""
)

LAKE = (
    VALID
    + """,
lake AS (
  SELECT sample_id, test_date, result, viral_load, year, week FROM (
    SELECT *, row_number() OVER (PARTITION BY year, week, sample_id
                                 ORDER BY is_batch DESC, source_file DESC, row_pos DESC) AS rn FROM valid)
  WHERE rn = 1)"""
)

REQUESTS = """,
requests AS (
  SELECT sample_id, test_date, CAST(year(test_date) AS INTEGER) AS year, CAST(week(test_date) AS INTEGER) AS week,
         c_nationkey
  FROM (
    SELECT sample_id, CASE WHEN isodow(d) > 1 AND year(d - 1) = year(d) THEN d - 1
                           WHEN isodow(d) < 7 AND year(d + 1) = year(d) THEN d + 1 ELSE d END AS test_date, c_nationkey
    FROM customer JOIN (SELECT sample_id, max(test_date) AS d FROM valid GROUP BY 1) ON sample_id = 'S-' || c_custkey
    WHERE c_custkey % 10 = 0
    UNION ALL
    SELECT 'S-' || c_custkey, DATE '2031-01-06' + CAST(7 * c_nationkey AS INTEGER), c_nationkey FROM customer
    WHERE c_custkey % 100 = 0
    UNION ALL
    SELECT 'X-' || c_custkey, DATE '1992-01-06' + CAST(7 * (c_custkey % 331) AS INTEGER), c_nationkey FROM customer
    WHERE c_custkey % 10 = 1)),
keys AS (SELECT DISTINCT year, week, sample_id FROM requests)"""

DELETED = (
    LAKE
    + REQUESTS
    + """,
ids AS (
  SELECT DISTINCT l.year, l.week, l.sample_id FROM lake l
  JOIN keys k ON l.year = k.year AND l.week = k.week AND l.sample_id = k.sample_id),
asked AS (SELECT DISTINCT year, week FROM keys),
counts AS (
  SELECT a.year, a.week,
         CAST(count(i.sample_id) AS BIGINT) AS rows_deleted,
         CAST(count(l.sample_id) - count(i.sample_id) AS BIGINT) AS rows_remaining,
         CASE WHEN count(l.sample_id) = 0 THEN 'not_found' WHEN count(i.sample_id) = 0 THEN 'no_match'
              ELSE 'deleted' END AS status
  FROM asked a
  LEFT JOIN lake l ON a.year = l.year AND a.week = l.week
  LEFT JOIN ids i ON l.year = i.year AND l.week = i.week AND l.sample_id = i.sample_id
  GROUP BY a.year, a.week)"""
)

# Text of the four errors the derived feed can hold.
PIPELINE_ERROR = """
concat_ws('; ',
  CASE WHEN valid_date IS NULL THEN 'test_date: Input should be a valid date or datetime '
       || '[type=date_from_datetime_parsing, input=''' || test_date || ''']' END,
  CASE WHEN result NOT IN ('POS', 'NEG', 'N/A') THEN 'result: Value error, Invalid result code: ''' || result
       || '''. Must be POS, NEG, or N/A [type=value_error, input=''' || result || ''']' END,
  CASE WHEN viral_load IS NULL THEN 'viral_load: Input should be a valid integer [type=int_type, input=None]'
       WHEN valid_load IS NULL THEN 'viral_load: Input should be a valid integer, unable to parse string as an '
       || 'integer [type=int_parsing, input=''' || viral_load || ''']' END)"""

QUARANTINE = (
    CHECKED
    + f""",
quarantine AS (
  SELECT sample_id, test_date, result, viral_load, source_file, row_pos, valid_date, valid_load,
         {PIPELINE_ERROR} AS pipeline_error
  FROM checked WHERE NOT ok)"""
)

BY_CUSTOMER = (
    CHECKED
    + """,
files AS (SELECT * REPLACE ('Lab_' || sample_id || '.csv' AS source_file) FROM checked),
verdicts AS (
  SELECT source_file, bool_and(ok) AS passed, CAST(count(*) AS BIGINT) AS row_count FROM files GROUP BY source_file)"""
)

PRESENCE = """,
presence AS (
  SELECT {key}, count(*) FILTER (NOT is_batch) AS history_rows, count(*) FILTER (is_batch) AS batch_rows
  FROM {source} GROUP BY {key})"""

PER_PARTITION = """
SELECT year, week,
       CAST({inserted} AS BIGINT) AS rows_inserted,
       CAST(count(*) FILTER (batch_rows > 0 AND history_rows > 0) AS BIGINT) AS rows_updated,
       sum(history_rows) = 0 AS is_new
FROM presence GROUP BY year, week HAVING sum(batch_rows) > 0"""

INSERTED_IDS = "count(*) FILTER (batch_rows > 0 AND history_rows = 0)"
INSERTED_ROWS = f"CASE WHEN sum(history_rows) = 0 THEN sum(batch_rows) ELSE {INSERTED_IDS} END"

LOG = (
    CHECKED
    + """,
per_file AS (
  SELECT strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS execution_timestamp, source_file,
         count(*) FILTER (ok) AS valid_rows, count(*) FILTER (NOT ok) AS error_rows
  FROM checked GROUP BY 1, 2),
log AS (
  SELECT execution_timestamp, CAST(count(*) AS BIGINT) AS files_processed,
         CAST(sum(error_rows) AS BIGINT) AS rows_quarantined, CAST(sum(valid_rows) AS BIGINT) AS rows_inserted,
         CAST(0 AS BIGINT) AS rows_updated,
         CASE WHEN sum(error_rows) > 0 THEN string_agg('checked ' || source_file || ': ' || valid_rows
              || ' valid, ' || error_rows || ' rejected', ' | ' ORDER BY source_file) ELSE '' END AS processing_details
  FROM per_file GROUP BY 1)"""
)

LAX = """
feed AS (
  SELECT o_orderkey AS row_pos, strftime(o_orderdate, '%Y-%m-%d') AS day,
         CAST(date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS BIGINT) * 86400 AS epoch,
         CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) AS load,
         CASE WHEN o_orderkey % 17 = 0 THEN 'Positive' ELSE 'POS' END AS result
  FROM orders),
written AS (
  SELECT *,
         CASE row_pos % 12 WHEN 1 THEN day || 'T00:00:00' WHEN 2 THEN day || ' 00:00Z'
           WHEN 3 THEN day || 't00:00:00.000+05:30' WHEN 4 THEN day || 'T10:30:00' WHEN 5 THEN CAST(epoch AS VARCHAR)
           WHEN 6 THEN (epoch * 1000) || '.0' WHEN 7 THEN CAST(epoch + 1 AS VARCHAR) WHEN 8 THEN ' ' || day
           WHEN 9 THEN '2025-02-30' WHEN 10 THEN '0000-01-01' ELSE day END AS test_date,
         CASE row_pos % 11 WHEN 1 THEN '+' || load WHEN 2 THEN '-' || load WHEN 3 THEN '  00' || load || ' '
           WHEN 4 THEN load || '.00' WHEN 5 THEN '1_' || load WHEN 6 THEN load || '.5' WHEN 7 THEN load || 'e3'
           WHEN 8 THEN load || '99999999999999999999' WHEN 9 THEN '' ELSE load END AS viral_load
  FROM feed),
forms AS (
  SELECT *,
         regexp_full_match(test_date, '[0-9]{4}-[0-9]{2}-[0-9]{2}') AS is_date,
         regexp_full_match(test_date, '[0-9]{4}-[0-9]{2}-[0-9]{2}[Tt _]([01][0-9]|2[0-3]):[0-5][0-9]'
           || '(:[0-5][0-9]([.,][0-9]+)?)?([Zz]|[+-]([01][0-9]|2[0-3]):?[0-5][0-9])?') AS is_datetime,
         regexp_full_match(test_date, '.{10}.00:00(:00([.,]0{1,6})?)?([Zz]|[+-].*)?') AS is_midnight,
         CASE WHEN regexp_full_match(test_date, '[+-]?[0-9]+([.][0-9]*)?') THEN try_cast(test_date AS DOUBLE) END AS num,
         regexp_full_match(viral_load, '\\s*[+-]?[0-9]+(_[0-9]+)*([.]0+)?\\s*') AS is_int
  FROM written),
numbers AS (
  SELECT *, CASE WHEN abs(num) <= 20000000000 THEN num ELSE num / 1000 END AS seconds,
         try_cast(substr(test_date, 1, 10) AS DATE) AS written_date,
         CASE WHEN is_int THEN try_cast(regexp_replace(regexp_replace(viral_load, '[.]0+\\s*$', ''), '[\\s_]', '', 'g')
              AS BIGINT) END AS valid_load
  FROM forms),
dated AS (
  SELECT *, CASE WHEN is_date OR (is_datetime AND is_midnight)
                 THEN CASE WHEN year(written_date) >= 1 THEN written_date END
                 WHEN num IS NOT NULL AND seconds % 86400 = 0
                 THEN DATE '1970-01-01' + CAST(floor(seconds / 86400) AS INTEGER) END AS valid_date
  FROM numbers)
SELECT row_pos, valid_date IS NOT NULL AND result = 'POS' AND valid_load IS NOT NULL AS ok, valid_date, valid_load,
       concat_ws(',',
         CASE WHEN valid_date IS NULL THEN 'test_date:' || CASE
           WHEN is_date AND written_date IS NOT NULL THEN 'date_parsing'
           WHEN is_datetime OR num IS NOT NULL THEN 'date_from_datetime_inexact'
           ELSE 'date_from_datetime_parsing' END END,
         CASE WHEN result <> 'POS' THEN 'result:value_error' END,
         CASE WHEN valid_load IS NULL THEN 'viral_load:' || CASE WHEN is_int THEN 'int_overflow'
              ELSE 'int_parsing' END END) AS error_types
FROM dated"""

TWO_RUNS = """
SELECT CAST(5 AS BIGINT) AS files_processed,
       (SELECT CAST(count(*) AS BIGINT) FROM checked WHERE NOT ok AND row_pos % 2 = {rest}) AS rows_quarantined,
       {inserted} AS rows_inserted, {updated} AS rows_updated"""


def _with(ctes, query):
    return f"WITH {ctes}\n{query}"


def _presence(key, source="valid"):
    return VALID + PRESENCE.format(key=key, source=source)


WHOLE_LAKE = _with(LAKE, "SELECT sample_id, test_date, result, viral_load, year, week FROM lake")
REPORT = _with(LAKE, "SELECT sample_id, test_date, result, viral_load FROM lake")
RECORDS = "sample_id, test_date, result, viral_load"
KEYS = "year, week, sample_id"
BY_WEEKS = "(SELECT * REPLACE (NOT (row_pos % 2 = 0 AND week % 2 = 0) AS is_batch) FROM valid)"
WITHOUT_REQUESTED = _with(
    LAKE + REQUESTS,
    f"SELECT {RECORDS}, year, week FROM lake l WHERE NOT EXISTS (SELECT 1 FROM keys k "
    "WHERE k.year = l.year AND k.week = l.week AND k.sample_id = l.sample_id)",
)

SQL = {
    "validate_route": _with(CHECKED, "SELECT row_pos, ok, valid_date, valid_load FROM checked"),
    "validate_lax": f"WITH {LAX}",
    "validate_columns": _with(
        CHECKED,
        """SELECT row_pos, false AS ok, viral_load AS load,
       concat_ws('; ',
         CASE WHEN valid_date IS NULL THEN 'test_date: Input should be a valid date or datetime '
              || '[type=date_from_datetime_parsing, input=''' || test_date || ''']' END,
         CASE WHEN result NOT IN ('POS', 'NEG', 'N/A') THEN 'result: Value error, Invalid result code: ''' || result
              || '''. Must be POS, NEG, or N/A [type=value_error, input=''' || result || ''']' END,
         'viral_load: Field required [type=missing, input=None]') AS pipeline_error FROM checked""",
    ),
    "valid_records": _with(VALID, f"SELECT {RECORDS}, strftime(test_date, '%Y-%m-%d') AS date_text, row_pos FROM valid"),
    "quarantine_rows": _with(
        QUARANTINE,
        "SELECT sample_id, test_date, result, viral_load, pipeline_error, source_file, row_pos FROM quarantine",
    ),
    "drop_technical": _with(QUARANTINE, "SELECT sample_id, test_date, result, viral_load, row_pos FROM quarantine"),
    "file_counts": _with(
        CHECKED,
        "SELECT source_file, CAST(count(*) FILTER (ok) AS BIGINT) AS valid_rows, "
        "CAST(count(*) FILTER (NOT ok) AS BIGINT) AS error_rows FROM checked GROUP BY source_file",
    ),
    "file_gate": _with(BY_CUSTOMER, "SELECT source_file, passed, row_count FROM verdicts"),
    "gated_rows": _with(
        BY_CUSTOMER,
        "SELECT sample_id, test_date, result, viral_load, source_file, row_pos FROM files "
        "WHERE source_file IN (SELECT source_file FROM verdicts WHERE passed)",
    ),
    "partition_keys": _with(
        VALID, "SELECT row_pos, year, week, 'year=' || year || '/week=' || week AS partition_path FROM valid"
    ),
    "touched": _with(VALID, "SELECT DISTINCT year, week FROM valid"),
    "touched_total": _with(
        VALID, "SELECT CAST(count(*) AS BIGINT) AS partitions FROM (SELECT DISTINCT year, week FROM valid)"
    ),
    "single_partition": _with(VALID, f"SELECT {RECORDS}, row_pos FROM valid WHERE year = 1997 AND week = 1"),
    "union_batch": _with(VALID, f"SELECT {RECORDS}, is_batch, row_pos FROM valid"),
    "upsert_partitioned": WHOLE_LAKE,
    "upsert_append": _with(
        VALID,
        f"""SELECT {RECORDS}, year, week FROM (
  SELECT *, row_number() OVER (PARTITION BY year, week, sample_id
                               ORDER BY is_batch DESC, source_file DESC, row_pos DESC) AS rn,
         bool_and(is_batch) OVER (PARTITION BY year, week) AS is_new
  FROM {BY_WEEKS})
WHERE rn = 1 OR is_new""",
    ),
    "upsert_global": _with(
        VALID,
        f"""SELECT {RECORDS} FROM (
  SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY is_batch DESC, source_file DESC, row_pos DESC) AS rn
  FROM valid) WHERE rn = 1""",
    ),
    "upsert_counts": _with(_presence(KEYS), PER_PARTITION.format(inserted=INSERTED_IDS)),
    "upsert_append_counts": _with(_presence(KEYS, BY_WEEKS), PER_PARTITION.format(inserted=INSERTED_ROWS)),
    "upsert_totals": _with(
        _presence(KEYS),
        "SELECT CAST(sum(rows_inserted) AS BIGINT) AS rows_inserted, CAST(sum(rows_updated) AS BIGINT) AS rows_updated, "
        f"CAST(count(*) AS BIGINT) AS partitions FROM ({PER_PARTITION.format(inserted=INSERTED_IDS)})",
    ),
    "global_counts": _with(
        _presence("sample_id"),
        f"""SELECT CAST({INSERTED_IDS} AS BIGINT) AS rows_inserted,
       CAST(count(*) FILTER (batch_rows > 0 AND history_rows > 0) AS BIGINT) AS rows_updated,
       CAST(sum(history_rows) AS BIGINT) AS rows_before, CAST(count(*) AS BIGINT) AS rows_after FROM presence""",
    ),
    "request_files": _with(
        VALID + REQUESTS,
        """SELECT 'Requests_' || c_nationkey || '.csv' AS source_file,
       NOT bool_or(c_nationkey % 7 = 3 AND day(test_date) < 15) AS accepted,
       max(CASE WHEN c_nationkey % 7 = 3 AND day(test_date) < 15 THEN 'Invalid test_date' END) AS reason,
       CAST(count(*) AS BIGINT) AS requests
FROM requests GROUP BY c_nationkey""",
    ),
    "accepted_requests": _with(
        VALID + REQUESTS,
        """SELECT sample_id, test_date, 'Requests_' || c_nationkey || '.csv' AS source_file FROM requests
WHERE c_nationkey NOT IN (SELECT c_nationkey FROM requests WHERE c_nationkey % 7 = 3 AND day(test_date) < 15)""",
    ),
    "distinct_requests": _with(
        VALID + REQUESTS, "SELECT CAST(count(DISTINCT sample_id) AS BIGINT) AS ids FROM requests"
    ),
    "delete_partitioned": WITHOUT_REQUESTED,
    "delete_by_id": _with(
        LAKE + REQUESTS,
        f"SELECT {RECORDS}, year, week FROM lake WHERE sample_id NOT IN (SELECT sample_id FROM requests)",
    ),
    "deleted_ids": _with(DELETED, "SELECT year, week, sample_id FROM ids"),
    "delete_counts": _with(DELETED, "SELECT year, week, rows_deleted, rows_remaining, status FROM counts"),
    "delete_misses": _with(DELETED, "SELECT year, week, status FROM counts WHERE rows_deleted = 0"),
    "delete_totals": _with(
        DELETED,
        "SELECT CAST(sum(rows_deleted) AS BIGINT) AS rows_deleted, "
        "CAST(count(*) FILTER (rows_deleted > 0) AS BIGINT) AS partitions_updated FROM counts",
    ),
    "delete_lines": _with(
        DELETED,
        """SELECT year, week, 'year=' || year || '/week=' || week || ': ' || CASE status
         WHEN 'not_found' THEN 'not in the lake' WHEN 'no_match' THEN 'no requested sample'
         ELSE rows_deleted || ' removed, ' || rows_remaining || ' left' END AS line FROM counts
UNION ALL SELECT year, week, 'year=' || year || '/week=' || week || ': removed ' || sample_id FROM ids""",
    ),
    "report_rows": REPORT,
    "preview": _with(
        LAKE, f"SELECT {RECORDS} FROM lake ORDER BY test_date DESC, sample_id, viral_load LIMIT 1000"
    ),
    "feed_preview": _with(
        FEED,
        "SELECT sample_id, test_date, result, viral_load, source_file, row_pos FROM feed ORDER BY row_pos LIMIT 10",
    ),
    "report_facts": _with(LAKE, "SELECT CAST(count(*) AS BIGINT) AS row_count FROM lake"),
    "written_report_facts": _with(
        LAKE,
        """SELECT CAST(count(*) AS BIGINT) AS row_count,
  CAST(sum(strlen(sample_id) + 10 + strlen(result) + strlen(CAST(viral_load AS VARCHAR)) + 4) AS BIGINT) AS row_bytes,
  true AS size_is_shown, true AS time_is_known FROM lake""",
    ),
    "distinct_errors": _with(QUARANTINE, "SELECT DISTINCT source_file, pipeline_error FROM quarantine"),
    "error_counts": _with(
        QUARANTINE,
        """SELECT source_file, field, error_type, CAST(count(*) AS BIGINT) AS row_count FROM (
  SELECT source_file, 'test_date' AS field, 'date_from_datetime_parsing' AS error_type FROM quarantine
  WHERE valid_date IS NULL
  UNION ALL SELECT source_file, 'result', 'value_error' FROM quarantine WHERE result = 'Positive'
  UNION ALL SELECT source_file, 'viral_load', CASE WHEN viral_load IS NULL THEN 'int_type' ELSE 'int_parsing' END
  FROM quarantine WHERE valid_load IS NULL)
GROUP BY source_file, field, error_type""",
    ),
    "pending_files": _with(
        BY_CUSTOMER,
        "SELECT DISTINCT source_file FROM files WHERE NOT ok AND source_file NOT IN "
        "(SELECT source_file FROM files WHERE NOT ok AND row_pos % 3 = 0)",
    ),
    "rows_per_file": _with(
        QUARANTINE, "SELECT source_file, CAST(count(*) AS BIGINT) AS row_count FROM quarantine GROUP BY source_file"
    ),
    "apply_corrections": _with(
        QUARANTINE,
        """SELECT sample_id, CASE WHEN test_date = '12/01/2025' THEN '2025-12-01' ELSE test_date END AS test_date,
       CASE WHEN result = 'Positive' THEN 'POS' ELSE result END AS result, nullif(viral_load, 'x') AS viral_load, row_pos,
       source_file, CASE WHEN result = 'Positive' THEN 'new' ELSE 'old' END AS site, CAST(row_pos AS VARCHAR) AS row
FROM quarantine WHERE viral_load IS NOT NULL
UNION ALL SELECT 'N-' || n_nationkey, '2025-12-01', 'NEG', '0', CAST(-1 - n_nationkey AS BIGINT), 'Lab_Results_0.csv',
       NULL, NULL FROM nation""",
    ),
    "log_history": _with(LOG, "SELECT * FROM log"),
    "log_latest": _with(
        LOG,
        "SELECT execution_timestamp, files_processed, rows_quarantined, rows_inserted, rows_updated FROM log "
        "ORDER BY execution_timestamp DESC LIMIT 1",
    ),
    "log_with_details": _with(LOG, "SELECT * FROM log WHERE processing_details <> ''"),
    "log_labels": _with(
        LOG,
        "SELECT execution_timestamp, replace(execution_timestamp, 'T', ' ') AS shown_timestamp, "
        "'Run at ' || replace(execution_timestamp, 'T', ' ') AS run_label FROM log",
    ),
    "log_details": _with(
        LOG,
        """SELECT execution_timestamp, CAST(line_no AS INTEGER) AS line_no, lines[line_no + 1] AS line FROM (
  SELECT execution_timestamp, lines, unnest(range(len(lines))) AS line_no FROM (
    SELECT execution_timestamp, string_split(processing_details, ' | ') AS lines FROM log
    WHERE processing_details <> ''))""",
    ),
    "log_metrics": _with(
        LOG,
        "SELECT replace(execution_timestamp, 'T', ' ') AS execution_timestamp, files_processed, rows_quarantined, "
        "rows_inserted, rows_updated FROM log",
    ),
    "landing_scan": _with(
        FEED,
        """SELECT sample_id, test_date, CASE WHEN row_pos % 4 <> 3 THEN result END AS result, viral_load,
       CASE WHEN row_pos % 4 = 3 THEN 'result' ELSE '' END AS missing,
       CASE WHEN row_pos % 4 = 2 THEN 'site ' || row_pos END AS site,
       'layout_' || (row_pos % 4) || '.csv' AS source_file FROM feed""",
    ),
    "file_listing": _with(
        FEED,
        """SELECT DISTINCT source_file, CAST(NULL AS BIGINT) AS length, true AS filled FROM feed
UNION ALL SELECT 'empty.csv', 0, false
UNION ALL SELECT 'names.txt', CAST(sum(strlen(n_name) + 1) AS BIGINT), true FROM nation""",
    ),
    "quarantine_scan": _with(
        QUARANTINE, "SELECT sample_id, test_date, result, viral_load, pipeline_error FROM quarantine"
    ),
    "request_scan": _with(
        VALID,
        "SELECT replace(sample_id, 'S-', '000') AS sample_id, test_date, 'deletion_request_1.csv' AS source_file "
        "FROM valid",
    ),
    "log_scan": _with(
        LOG,
        "SELECT replace(execution_timestamp, 'T', ' ') AS execution_timestamp, files_processed, rows_quarantined, "
        "rows_inserted, rows_updated FROM log",
    ),
    "run_history": _with(
        LOG,
        "SELECT *, CASE WHEN processing_details = '' THEN 0 ELSE CAST(len(string_split(processing_details, ' | ')) "
        "AS INTEGER) END AS detail_lines FROM log",
    ),
    "lake_scan": _with(
        LAKE,
        "SELECT sample_id, year, week FROM lake WHERE (year = 1996 AND week = 1) OR (year = 1997 AND week = 52)",
    ),
    "lake_prefix_scan": _with(
        LAKE,
        f"SELECT {RECORDS}, year, week FROM lake WHERE year = 1998 OR (year = 1996 AND (week = 1 OR week BETWEEN 10 AND 19))",
    ),
    "ingest_job": WHOLE_LAKE,
    "ingest_log": _with(
        _presence(KEYS),
        TWO_RUNS.format(
            rest=0,
            inserted="(SELECT CAST(count(*) AS BIGINT) FROM presence WHERE history_rows > 0)",
            updated="CAST(0 AS BIGINT)",
        )
        + "\nUNION ALL"
        + TWO_RUNS.format(
            rest=1,
            inserted="(SELECT CAST(count(*) AS BIGINT) FROM presence WHERE history_rows = 0)",
            updated="(SELECT CAST(count(*) AS BIGINT) FROM presence WHERE history_rows > 0 AND batch_rows > 0)",
        ),
    ),
    "stream_job": WHOLE_LAKE,
    "deletion_job": _with(
        LAKE + REQUESTS,
        f"SELECT {RECORDS}, year, week FROM lake l WHERE NOT EXISTS (SELECT 1 FROM keys k "
        "WHERE k.year = l.year AND k.week = l.week AND k.sample_id = l.sample_id)",
    ),
    "deletion_log": _with(
        LAKE + REQUESTS,
        """SELECT CAST(1 AS BIGINT) AS files_processed, CAST(count(*) AS BIGINT) AS rows_deleted,
       CAST(count(DISTINCT l.year * 100 + l.week) AS BIGINT) AS partitions_updated
FROM lake l JOIN keys k ON k.year = l.year AND k.week = l.week AND k.sample_id = l.sample_id""",
    ),
    "deletion_rejects": _with(
        LAKE, f"SELECT {RECORDS}, year, week FROM lake WHERE CAST(substr(sample_id, 3) AS BIGINT) % 4 <> 0"
    ),
    "deletion_files_kept": """
SELECT 'column.csv' AS source_file, 'refused column.csv: Missing required columns' AS line
UNION ALL SELECT 'date.csv', 'refused date.csv: Invalid test_date'
UNION ALL SELECT 'long.csv', 'refused long.csv: Row longer than its header'""",
    "ingest_append_job": _with(
        VALID
        + REQUESTS
        + """,
both_sides AS (
  SELECT * FROM valid v WHERE is_batch OR NOT EXISTS (SELECT 1 FROM keys k
    WHERE k.year = v.year AND k.week = v.week AND k.sample_id = v.sample_id))""",
        f"""SELECT {RECORDS}, year, week FROM (
  SELECT *, row_number() OVER (PARTITION BY year, week, sample_id
                               ORDER BY is_batch DESC, source_file DESC, row_pos DESC) AS rn,
         bool_or(is_batch) OVER (PARTITION BY year, week) AS is_touched
  FROM both_sides)
WHERE rn = 1 OR NOT is_touched""",
    ),
    "lake_with_report": WHOLE_LAKE,
    "audit_lines": _with(
        _presence(KEYS),
        f"""SELECT 1 AS section, 'checked ' || source_file || ': ' || count(*) FILTER (ok) || ' valid, '
       || count(*) FILTER (NOT ok) || ' rejected' AS line FROM checked GROUP BY row_pos % 2, source_file
UNION ALL
SELECT 4, 'year=' || year || '/week=' || week || ': ' || count(DISTINCT sample_id) || ' inserted, new partition'
FROM valid WHERE NOT is_batch GROUP BY year, week
UNION ALL
SELECT 4, 'year=' || year || '/week=' || week || ': ' || rows_inserted || ' inserted, '
       || CASE WHEN is_new THEN 'new partition' ELSE rows_updated || ' updated' END
FROM ({PER_PARTITION.format(inserted=INSERTED_IDS)})""",
    ),
    "export_job": REPORT,
    "reingest_job": _with(
        CHECKED,
        """SELECT sample_id, test_date, CASE WHEN result = 'Positive' THEN 'POS' ELSE result END AS result,
       CASE WHEN coalesce(viral_load, 'x') = 'x' THEN '0' ELSE viral_load END AS viral_load,
       'Lab_' || (row_pos % 82) || '.csv' AS source_file
FROM checked WHERE row_pos % 82 NOT IN (SELECT row_pos % 82 FROM checked WHERE valid_date IS NULL)""",
    ),
}
