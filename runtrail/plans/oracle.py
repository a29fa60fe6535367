"""The catalogue's queries as SQL for another engine, as a second opinion on the results."""

from runtrail.plans.catalogue import BASE_ENV, HISTORY_BASE, MONTH
from runtrail.sources.derived import DERIVED, derived_sql

# Building blocks: name -> (names it needs, SQL).
BLOCKS = {
    "line_ids": (("submit_log",), r"""
        SELECT run_id, line_no,
          nullif(regexp_extract(line, '(application[0-9_]+)', 1), '') AS application_id,
          nullif(regexp_extract(line, 'pod name: ((.+?)-([a-z0-9]+)-driver)', 1), '') AS driver_pod,
          nullif(regexp_extract(line, 'exit code: (\d+)', 1), '') AS exit_digits,
          TRY_CAST(nullif(regexp_extract(line, 'exit code: (\d+)', 1), '') AS BIGINT) AS exit_code,
          nullif(regexp_extract(line, '(driver-[0-9\-]+)', 1), '') AS driver_id
        FROM submit_log"""),
    "folded": (("line_ids",), """
        SELECT run_id,
          arg_max(application_id, line_no) FILTER (WHERE application_id IS NOT NULL) AS application_id,
          arg_max(driver_pod, line_no) FILTER (WHERE driver_pod IS NOT NULL) AS driver_pod,
          TRY_CAST(arg_max(exit_digits, line_no) FILTER (WHERE exit_digits IS NOT NULL) AS BIGINT) AS exit_code,
          arg_min(driver_id, line_no) FILTER (WHERE driver_id IS NOT NULL) AS driver_id,
          arg_min(application_id, line_no) FILTER (WHERE application_id IS NOT NULL)
            AS announced_application_id,
          min(line_no) FILTER (WHERE application_id IS NOT NULL) AS announced_line_no,
          count(driver_pod) AS pod_notices
        FROM line_ids GROUP BY run_id"""),
    "resolved": (("runs", "connections"), """
        SELECT r.*, c.conn_id IS NOT NULL AS conn_found,
          (SELECT count(*) FROM connections d WHERE d.conn_id = r.conn_id) > 1 AS conn_repeated,
          CASE WHEN c.conn_id IS NULL THEN 'yarn'
            WHEN coalesce(c.port, 0) <> 0 THEN c.host || ':' || CAST(c.port AS VARCHAR)
            ELSE c.host END AS master,
          json_extract_string(c.extra, '$.queue') AS queue,
          json_extract_string(c.extra, '$."deploy-mode"') AS deploy_mode,
          json_extract_string(c.extra, '$."spark-home"') AS spark_home,
          CASE WHEN r.spark_binary <> '' THEN r.spark_binary
            WHEN list_contains(json_keys(c.extra), 'spark-binary')
              THEN json_extract_string(c.extra, '$."spark-binary"')
            ELSE 'spark-submit' END AS "binary",
          CASE WHEN list_contains(json_keys(r.conf), 'spark.kubernetes.namespace')
            THEN json_extract_string(r.conf, '$."spark.kubernetes.namespace"')
            ELSE json_extract_string(c.extra, '$.namespace') END AS namespace
        FROM runs r LEFT JOIN connections c ON r.conn_id = c.conn_id"""),
    "flags": (("resolved",), """
        SELECT *,
          CASE WHEN is_yarn AND deploy_mode IS NOT DISTINCT FROM 'cluster' THEN 'app'
            WHEN is_k8s THEN 'pod' WHEN is_tracked THEN 'driver' END AS route
        FROM (SELECT *, contains(master, 'yarn') AS is_yarn, contains(master, 'k8s') AS is_k8s,
            contains(master, 'spark://') AND deploy_mode IS NOT DISTINCT FROM 'cluster' AS is_tracked,
            master IS NULL AS invalid_connection
          FROM resolved)"""),
    "routed_lines": (("line_ids", "flags"), """
        SELECT l.run_id, l.line_no, f.route,
          CASE WHEN f.route = 'app' THEN l.application_id END AS application_id,
          CASE WHEN f.route = 'pod' THEN l.driver_pod END AS driver_pod,
          CASE WHEN f.route = 'pod' THEN l.exit_digits END AS exit_digits,
          CASE WHEN f.route = 'pod' THEN l.exit_code END AS exit_code,
          CASE WHEN f.route = 'driver' THEN l.driver_id END AS driver_id
        FROM line_ids l LEFT JOIN flags f ON l.run_id = f.run_id"""),
    "routed_ids": (("routed_lines",), """
        SELECT run_id,
          arg_max(application_id, line_no) FILTER (WHERE application_id IS NOT NULL) AS application_id,
          arg_max(driver_pod, line_no) FILTER (WHERE driver_pod IS NOT NULL) AS driver_pod,
          arg_max(exit_digits, line_no) FILTER (WHERE exit_digits IS NOT NULL) AS exit_digits,
          TRY_CAST(arg_max(exit_digits, line_no) FILTER (WHERE exit_digits IS NOT NULL) AS BIGINT) AS exit_code,
          arg_min(driver_id, line_no) FILTER (WHERE driver_id IS NOT NULL) AS driver_id,
          arg_min(application_id, line_no) FILTER (WHERE application_id IS NOT NULL)
            AS announced_application_id,
          min(line_no) FILTER (WHERE application_id IS NOT NULL) AS announced_line_no,
          count(driver_pod) AS pod_notices
        FROM routed_lines GROUP BY run_id"""),
    "routed": (("flags", "routed_ids"), """
        SELECT f.*, i.application_id, i.driver_pod, i.exit_code, i.exit_digits, i.driver_id,
          i.announced_application_id, i.announced_line_no,
          coalesce(i.pod_notices, 0) AS pod_notices
        FROM flags f LEFT JOIN routed_ids i ON f.run_id = i.run_id"""),
    "programs": (("flags",), """
        SELECT *, CASE WHEN coalesce(spark_home, '') = '' OR starts_with("binary", '/')
          THEN "binary"
          ELSE CASE WHEN ends_with(spark_home, '/') THEN spark_home ELSE spark_home || '/' END
            || 'bin/' || "binary" END AS executable
        FROM flags"""),
    "masked": (("programs",), r"""
        SELECT *, regexp_replace(
          executable || ' ' || array_to_string([t FOR t IN tokens IF t <> ''], ' '),
          '(\S*?(?:secret|password)\S*?\s*=\s*'')[^'']*''', '\1******''', 'gi') AS masked_command
        FROM (SELECT *, string_split_regex(cmd, '\s+') AS tokens FROM programs)"""),
    "polls": (("status_polls",), """
        SELECT run_id, poll_no,
          coalesce(arg_max(state, line_no) FILTER (WHERE state IS NOT NULL), 'UNKNOWN') AS state,
          max(returncode) AS returncode, bool_or(malformed) AS malformed
        FROM (SELECT *,
            CASE WHEN contains(line, 'driverState') THEN trim(replace(replace(
              string_split(trim(line), ' : ')[2], ',', ''), '"', '')) END AS state,
            contains(line, 'driverState') AND NOT contains(trim(line), ' : ') AS malformed
          FROM status_polls)
        GROUP BY run_id, poll_no"""),
    "counted_polls": (("polls",), """
        SELECT *, sum(CASE WHEN returncode <> 0 THEN 1 ELSE 0 END) OVER (
          PARTITION BY run_id ORDER BY poll_no
          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS misses
        FROM polls"""),
    "stops": (("counted_polls",), """
        SELECT run_id, CASE WHEN gave_up THEN 'POLL_GAVE_UP' ELSE state END AS tracked_state,
          state AS driver_state, poll_no AS stop_poll, returncode AS stop_returncode,
          CAST(misses AS INTEGER) AS misses, gave_up
        FROM (SELECT run_id, poll_no, returncode, misses, misses >= 11 AND NOT malformed AS gave_up,
            CASE WHEN malformed THEN 'MALFORMED' ELSE state END AS state,
            row_number() OVER (PARTITION BY run_id ORDER BY poll_no) AS nth
          FROM counted_polls
          WHERE misses >= 11 OR malformed
            OR state IN ('FINISHED', 'UNKNOWN', 'KILLED', 'FAILED', 'ERROR'))
        WHERE nth = 1"""),
    "tracked": (("polls", "stops"), """
        SELECT p.run_id, coalesce(s.tracked_state, 'STILL_RUNNING') AS tracked_state,
          s.driver_state, s.stop_poll, s.misses, coalesce(s.gave_up, false) AS gave_up
        FROM (SELECT DISTINCT run_id FROM polls) p LEFT JOIN stops s ON p.run_id = s.run_id"""),
    "outcomes": (("routed", "stops"), """
        SELECT r.*, s.stop_returncode,
          CASE WHEN r.is_tracked AND r.driver_id IS NOT NULL AND r.returncode = 0
            THEN coalesce(s.tracked_state, 'STILL_RUNNING') END AS tracked_state,
          CASE WHEN r.is_tracked AND r.driver_id IS NOT NULL AND r.returncode = 0
            THEN s.misses END AS misses,
          CASE WHEN r.returncode IS NULL THEN 'STILL_RUNNING'
            WHEN r.returncode <> 0 OR (r.is_k8s AND r.exit_code IS DISTINCT FROM 0)
              THEN 'SUBMIT_FAILED'
            WHEN r.is_tracked AND r.driver_id IS NULL THEN 'NO_DRIVER_ID'
            WHEN r.is_tracked AND s.run_id IS NULL THEN 'STILL_RUNNING'
            WHEN r.is_tracked AND s.gave_up THEN 'POLL_GAVE_UP'
            WHEN r.is_tracked AND s.tracked_state = 'MALFORMED' THEN 'POLL_MALFORMED'
            WHEN r.is_tracked AND s.driver_state <> 'FINISHED' THEN 'DRIVER_' || s.driver_state
            ELSE 'SUCCESS' END AS outcome,
          CASE WHEN r.returncode IS NULL THEN 'no return code'
            WHEN r.returncode <> 0 THEN 'return code'
            WHEN r.is_k8s AND r.exit_digits IS NULL THEN 'no exit code'
            WHEN r.is_k8s AND r.exit_code IS DISTINCT FROM 0 THEN 'exit code'
            WHEN r.is_tracked AND r.driver_id IS NULL THEN 'no driver id'
            WHEN r.is_tracked AND s.run_id IS NULL THEN 'no final poll'
            WHEN r.is_tracked AND s.gave_up THEN 'failed polls'
            WHEN r.is_tracked AND s.tracked_state = 'MALFORMED' THEN 'malformed status'
            WHEN r.is_tracked AND s.driver_state <> 'FINISHED' THEN 'driver state' END AS reason
        FROM routed r LEFT JOIN stops s ON r.run_id = s.run_id"""),
    "fetches": (("outcomes", "page_texts"), """
        SELECT *, fetch_log AND is_yarn AND application_id IS NOT NULL AS fetch_yarn,
          fetch_log AND is_k8s AND (NOT is_yarn OR (application_id IS NOT NULL AND page_attempt IS NOT NULL)) AS fetch_pod
        FROM (SELECT o.*, t.attempt AS page_attempt, outcome IN ('SUBMIT_FAILED', 'SUCCESS') AS fetch_log
          FROM outcomes o LEFT JOIN page_texts t ON o.run_id = t.run_id)"""),
    "pod_texts": (("pod_log",), r"""
        SELECT run_id, count(*) AS pod_lines, arg_min(text, line_no) AS pod_first, arg_max(text, line_no) AS pod_last
        FROM (SELECT *, regexp_extract(line, '[\x{4E00}-\x{9FA5}]+.*', 0) AS text FROM pod_log
          WHERE regexp_matches(line, '[\x{4E00}-\x{9FA5}]'))
        GROUP BY run_id"""),
    "errors": (("outcomes", "masked"), """
        SELECT o.run_id, o.outcome, CASE
          WHEN o.outcome = 'SUBMIT_FAILED' THEN 'Cannot execute: ' || m.masked_command
            || '. Error code is: ' || CAST(o.returncode AS VARCHAR) || '.'
          WHEN o.outcome = 'NO_DRIVER_ID' THEN 'No driver id is known: something went wrong '
            || 'when executing the spark submit command'
          WHEN o.outcome = 'POLL_GAVE_UP' THEN 'Failed to poll for the driver status 10 times: '
            || 'returncode = ' || CAST(o.stop_returncode AS VARCHAR)
          WHEN starts_with(o.outcome, 'DRIVER_') THEN 'ERROR : Driver ' || o.driver_id
            || ' badly exited with status ' || o.tracked_state END AS error_text
        FROM outcomes o JOIN masked m ON o.run_id = m.run_id"""),
    "addresses": (("routed",), """
        SELECT run_id, CASE WHEN is_tracked AND ends_with(master, ':6066')
          THEN replace(master, 'spark://', 'http://') || '/v1/submissions/status/' || driver_id
          END AS poll_address FROM routed"""),
    "first_replies": (("history",), """
        SELECT h.run_id, g.attempt, g.body, h.beyond_limit
        FROM (SELECT run_id, count(*) FILTER (attempt > 30) AS beyond_limit FROM history
          GROUP BY run_id) h
        LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY attempt) AS nth
          FROM history WHERE status_code = 200 AND attempt <= 30) g
        ON h.run_id = g.run_id AND g.nth = 1"""),
    "page_texts": (("log_pages",), r"""
        SELECT run_id, min(attempt) FILTER (WHERE log_text IS NOT NULL) AS attempt,
          arg_min(log_text, attempt) FILTER (WHERE log_text IS NOT NULL) AS log_text,
          count(*) FILTER (attempt > 11) AS beyond_limit
        FROM (SELECT run_id, attempt, CASE WHEN attempt <= 11 THEN
            replace(replace(replace(replace(list_reduce(
              list_concat([raw], regexp_extract_all(raw, '&#x?[0-9a-fA-F]+;')),
              lambda t, r: replace(t, r, chr(replace(replace(r[3:-2], 'x', '0x'), '00x', '0x')::INTEGER))),
              '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&')
            END AS log_text
          FROM (SELECT run_id, attempt, regexp_replace(regexp_replace(
              regexp_extract_all(html, '<pre(?:\s(?:[^>\x27"]|\x27[^\x27]*\x27|"[^"]*")*)?>(.*?)</(?:pre\s*|div)>', 1, 'si')[-1],
              '^.*<pre>', '', 's'), '</?[A-Za-z][^>]*>', '', 'g') AS raw
            FROM log_pages))
        GROUP BY run_id"""),
    "log_addresses": (("app_info",), """
        SELECT run_id, json_extract_string(body, '$.app.amContainerLogs') AS log_address
        FROM app_info"""),
}

_IDS = "application_id, driver_pod, exit_code, driver_id"
_FOLDED = f"run_id, {_IDS}, announced_application_id, announced_line_no, pod_notices"
_TRACKED = "run_id, tracked_state, driver_state, stop_poll, misses, gave_up"
_SPACE = (
    r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
_BASE_NAMES = ", ".join(f"'{name}'" for name in sorted(BASE_ENV))

CJK_OF_BYTES = r"""
        SELECT run_id, CAST(generate_subscripts(texts, 1) - 1 AS INTEGER) AS text_no,
          unnest(texts) AS cjk_text, false AS invalid_utf8
        FROM (SELECT run_id,
            regexp_extract_all(log, '[\x{4E00}-\x{9FA5}]+[^\n]*') AS texts
          FROM pod_log_text WHERE run_id % 10 <> 3)
        UNION ALL SELECT run_id, NULL, NULL, true FROM pod_log_text WHERE run_id % 10 = 3"""

# Queries: name -> (block, SELECT).
SELECTS = {
    "classify_runs": ("outcomes", f"""
        SELECT run_id, conn_id, master, {_IDS}, tracked_state, outcome, reason FROM outcomes"""),
    "fold_submit_log": (("runs", "folded"), f"""
        SELECT r.run_id, {_IDS} FROM runs r LEFT JOIN folded f ON r.run_id = f.run_id"""),
    "strip_lines": ("submit_log", f"""
        SELECT run_id, line_no, regexp_replace(line, '^[{_SPACE}]+|[{_SPACE}]+$', '', 'g') AS line
        FROM submit_log"""),
    "extract_line_ids": ("line_ids", "SELECT * EXCLUDE (exit_digits) FROM line_ids"),
    "strict_application_ids": ("submit_log", r"""
        SELECT run_id, line_no,
          nullif(regexp_extract(line, '(application_\d+_\d+)', 1), '') AS application_id
        FROM submit_log"""),
    "route_lines": ("routed_lines", "SELECT * EXCLUDE (exit_digits) FROM routed_lines"),
    "fold_routed_log": ("routed", f"SELECT run_id, route, {_IDS} FROM routed"),
    "id_notices": ("routed", """
        SELECT run_id, announced_application_id, announced_line_no, pod_notices FROM routed"""),
    "resolve_connections": ("resolved", """
        SELECT run_id, conn_id, conn_found, conn_repeated, master, queue, deploy_mode, spark_home, "binary",
          namespace FROM resolved"""),
    "resolve_connections_via_operator": (("runs", "connections"), """
        SELECT r.run_id, CASE WHEN r.spark_binary IS NULL THEN 'spark-submit'
          WHEN r.spark_binary <> '' THEN r.spark_binary
          WHEN list_contains(json_keys(c.extra), 'spark-binary')
            THEN json_extract_string(c.extra, '$."spark-binary"')
          ELSE 'spark-submit' END AS "binary"
        FROM runs r LEFT JOIN connections c ON r.conn_id = c.conn_id"""),
    "resolve_connections_as_of": (("started_runs", "connection_versions"), """
        SELECT run_id, conn_id, valid_from IS NOT NULL AS conn_found, valid_from AS conn_since,
          CASE WHEN valid_from IS NULL THEN 'yarn'
            WHEN coalesce(port, 0) <> 0 THEN host || ':' || CAST(port AS VARCHAR) ELSE host END AS master,
          json_extract_string(extra, '$.queue') AS queue,
          json_extract_string(extra, '$."deploy-mode"') AS deploy_mode,
          json_extract_string(extra, '$."spark-home"') AS spark_home,
          CASE WHEN spark_binary <> '' THEN spark_binary
            WHEN list_contains(json_keys(extra), 'spark-binary')
              THEN json_extract_string(extra, '$."spark-binary"')
            ELSE 'spark-submit' END AS "binary",
          CASE WHEN list_contains(json_keys(conf), 'spark.kubernetes.namespace')
            THEN json_extract_string(conf, '$."spark.kubernetes.namespace"')
            ELSE json_extract_string(extra, '$.namespace') END AS namespace
        FROM (SELECT r.*, v.valid_from, v.host, v.port, v.extra,
            row_number() OVER (PARTITION BY r.run_id ORDER BY v.valid_from DESC NULLS LAST) AS nth
          FROM started_runs r LEFT JOIN connection_versions v ON r.conn_id = v.conn_id AND v.valid_from <= r.started_at)
        WHERE nth = 1"""),
    "classify_runs_of_month": (("outcomes", "started_runs"), f"""
        SELECT o.run_id, o.conn_id, outcome, reason FROM outcomes o JOIN started_runs s ON o.run_id = s.run_id
        WHERE date_trunc('month', started_at) = DATE '{MONTH}'"""),
    "deployment_flags": ("flags", """
        SELECT run_id, is_yarn, is_k8s, is_tracked, invalid_connection, route FROM flags"""),
    "executable_path": ("programs", "SELECT run_id, executable FROM programs"),
    "env_overlay": ("runs", f"""
        SELECT run_id, CAST({len(BASE_ENV)} + coalesce(len(
            [k FOR k IN json_keys(env_vars) IF k NOT IN ({_BASE_NAMES})]), 0) AS INTEGER) AS variables,
          coalesce(json_extract_string(env_vars, '$.PATH'), '{BASE_ENV["PATH"]}') AS env_path,
          coalesce(json_extract_string(env_vars, '$.SPARK_USER'), '{BASE_ENV["SPARK_USER"]}')
            AS env_spark_user,
          json_extract_string(env_vars, '$.B') AS env_b
        FROM runs"""),
    "mask_command": ("masked", "SELECT run_id, masked_command FROM masked"),
    "tokenize_command": ("masked", r"""
        SELECT run_id, CAST(len([t FOR t IN tokens IF t <> '']) AS INTEGER) AS token_count,
          array_to_string([t FOR t IN string_split_regex(masked_command, '\s+') IF t <> ''], '|')
            AS masked_tokens FROM masked"""),
    "error_text": ("errors", "SELECT * FROM errors"),
    "poll_address": ("addresses", "SELECT * FROM addresses"),
    "fold_polls": ("polls", "SELECT * FROM polls"),
    "track_polls": ("tracked", f"SELECT {_TRACKED} FROM tracked"),
    "log_fetch_plan": ("fetches", """
        SELECT run_id, outcome, fetch_log, fetch_yarn, fetch_pod FROM fetches"""),
    "cleanup_actions": (("routed", "programs"), """
        SELECT run_id, 1 AS seq, 'driver' AS kind,
          executable || ' --master ' || r.master || ' --kill ' || driver_id AS target, NULL AS namespace
        FROM routed r JOIN (SELECT run_id, executable FROM programs) USING (run_id) WHERE cancelled AND is_tracked AND driver_id IS NOT NULL
        UNION ALL SELECT run_id, 2, 'launcher', "binary", NULL
        FROM routed WHERE cancelled AND launcher_alive
        UNION ALL SELECT run_id, 3, 'application', 'yarn application -kill ' || application_id, NULL
        FROM routed WHERE cancelled AND launcher_alive AND application_id IS NOT NULL
        UNION ALL SELECT run_id, 4, 'pod', driver_pod, namespace
        FROM routed WHERE cancelled AND launcher_alive AND driver_pod IS NOT NULL"""),
    "app_log_address": ("log_addresses", "SELECT * FROM log_addresses"),
    "first_history_reply": ("first_replies", "SELECT * FROM first_replies"),
    "history_address": (("routed", "first_replies"), f"""
        SELECT r.run_id, r.application_id,
          CAST(json_array_length(nullif(h.body, ''), '$.attempts') AS INTEGER) AS attempts,
          '{HISTORY_BASE}/' || r.application_id || '/'
            || CAST(json_array_length(nullif(h.body, ''), '$.attempts') AS VARCHAR)
            || '/executors' AS executors_address
        FROM routed r LEFT JOIN first_replies h ON r.run_id = h.run_id
        WHERE r.application_id IS NOT NULL"""),
    "driver_log_links": ("executors", """
        SELECT run_id, json_extract_string(driver, '$.executorLogs.stdout') AS stdout,
          json_extract_string(driver, '$.executorLogs.stderr') AS stderr
        FROM (SELECT run_id, CASE WHEN status_code = 200 THEN [e FOR e IN json_extract(body, '$[*]')
            IF json_extract_string(e, '$.id') = 'driver'][1] END AS driver
          FROM executors)"""),
    "first_log_text": ("page_texts", "SELECT * FROM page_texts"),
    "cjk_lines": ("pod_log", r"""
        SELECT run_id, line_no, regexp_extract(line, '[\x{4E00}-\x{9FA5}]+.*', 0) AS cjk_text
        FROM pod_log WHERE regexp_matches(line, '[\x{4E00}-\x{9FA5}]')"""),
    "cjk_lines_of_bytes": ("pod_log_text", CJK_OF_BYTES),
    "cjk_lines_of_chunks": ("pod_log_text", CJK_OF_BYTES),
    "run_report": (
        ("fetches", "programs", "masked", "errors", "addresses", "log_addresses", "page_texts", "pod_texts"), """
        SELECT f.run_id, f.conn_id, f.master, f.deploy_mode, f.queue, f.namespace, p.executable,
          m.masked_command, f.application_id, f.driver_pod, f.exit_code, f.driver_id,
          f.tracked_state, f.misses, f.outcome, f.reason, e.error_text, a.poll_address,
          CASE WHEN f.fetch_yarn THEN l.log_address END AS log_address,
          CASE WHEN f.fetch_yarn THEN t.log_text END AS log_text, f.fetch_pod,
          CASE WHEN f.fetch_pod THEN coalesce(pod_lines, 0) END AS pod_lines,
          CASE WHEN f.fetch_pod THEN pod_first END AS pod_first,
          CASE WHEN f.fetch_pod THEN pod_last END AS pod_last
        FROM fetches f JOIN programs p ON f.run_id = p.run_id JOIN masked m ON f.run_id = m.run_id
        JOIN errors e ON f.run_id = e.run_id JOIN addresses a ON f.run_id = a.run_id
        LEFT JOIN log_addresses l ON f.run_id = l.run_id
        LEFT JOIN page_texts t ON f.run_id = t.run_id
        LEFT JOIN pod_texts d ON f.run_id = d.run_id"""),
    "stream_fold": ("folded", f"SELECT {_FOLDED} FROM folded"),
    "stream_fold_stateful": ("folded", f"SELECT {_FOLDED} FROM folded"),
    "stream_fold_evicting": (("folded", "timed_log"), """
        SELECT t.run_id, application_id, driver_pod, exit_code, driver_id, announced_application_id,
          announced_line_no, coalesce(pod_notices, 0) AS pod_notices
        FROM (SELECT run_id, max(logged_at) AS last FROM timed_log GROUP BY run_id) t
        LEFT JOIN folded f ON t.run_id = f.run_id
        WHERE last + INTERVAL 30 MINUTE <= (SELECT max(logged_at) - INTERVAL 1 HOUR FROM timed_log)"""),
    "stream_track_timed": (("tracked", "timed_polls"), f"""
        SELECT {_TRACKED}, stop_poll IS NULL AS silent FROM tracked
        JOIN (SELECT run_id AS polled, max(polled_at) AS last FROM timed_polls GROUP BY run_id) ON run_id = polled
        WHERE last + INTERVAL 30 MINUTE <= (SELECT max(polled_at) - INTERVAL 1 HOUR FROM timed_polls)"""),
    "stream_fold_compacted": ("folded", f"SELECT {_FOLDED} FROM folded"),
    "stream_track_compacted": ("tracked", f"SELECT {_TRACKED} FROM tracked"),
    "read_pod_log_bytes": ("pod_log_text", "SELECT run_id, hex(encode(log)) AS log FROM pod_log_text"),
    "stream_line_ids": ("line_ids", "SELECT * EXCLUDE (exit_digits) FROM line_ids"),
    "read_submit_log_text": ("submit_log", "SELECT * FROM submit_log"),
    "stream_track": ("tracked", f"SELECT {_TRACKED} FROM tracked"),
    "sink_run_facts": ("resolved", """
        SELECT r.run_id, r.master, r."binary",
          CAST(date_trunc('month', o.o_orderdate) AS DATE) AS run_date
        FROM resolved r JOIN orders o ON r.run_id = o.o_orderkey"""),
    "read_submit_log_json": ("submit_log", "SELECT * FROM submit_log"),
} | {
    f"read_{name}": (name, f"SELECT * FROM {name}")
    for name in ("submit_log", "status_polls", "app_info", "history", "executors", "log_pages",
                 "pod_log")
}

SELECTS |= {
    "classify_runs_by_run": SELECTS["classify_runs"],
    **{f"{name}_landed": SELECTS[name] for name in ("app_log_address", "history_address", "driver_log_links")},
}


def _with(names):
    """The blocks and derived tables a query needs, each after those it is built from."""
    ordered = []

    def add(name):
        if name not in ordered:
            for needed in BLOCKS[name][0] if name in BLOCKS else ():
                add(needed)
            ordered.append(name)

    for name in names:
        add(name)
    return ",\n".join(
        derived_sql(name) if name in DERIVED else f"{name} AS ({BLOCKS[name][1]})"
        for name in ordered
    )


ORACLE = {
    query: f"WITH {_with((needs,) if isinstance(needs, str) else needs)}\n{select}"
    for query, (needs, select) in SELECTS.items()
}
