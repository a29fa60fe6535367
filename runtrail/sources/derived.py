"""The input tables, derived from ``orders`` and ``nation``.

The given tables hold no logs, so the runs of a platform are derived from them: one run
per order. Column texts run unchanged in Spark and in DuckDB. Spark multiplies rows by
exploding a sequence, without a join; the SQL text lists the numbers.
"""

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Derived:
    base: str
    columns: dict
    numbers: dict = field(default_factory=dict)


_RUN = "o_orderkey"

# The columns the tables are derived from.
BASES = {
    "nation": "n_nationkey bigint",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderpriority string, o_orderdate timestamp_ntz",
}

DERIVED = {
    # Runs name more connections than there are nations, so that some lookups miss.
    "connections": Derived(
        base="nation",
        columns={
            "conn_id": "CONCAT('conn_', CAST(n_nationkey AS STRING))",
            "host": """CASE n_nationkey % 5 WHEN 0 THEN 'yarn'
                WHEN 1 THEN CASE WHEN n_nationkey = 21 THEN 'k8s://yarn.example.org'
                    ELSE 'k8s://https://k8s.example.org' END
                WHEN 2 THEN 'spark://spark.example.org'
                WHEN 3 THEN 'local' ELSE 'yarn-rm.example.org' END""",
            "port": """CASE n_nationkey % 5 WHEN 1 THEN 6443
                WHEN 2 THEN CASE WHEN n_nationkey % 2 = 0 THEN 7077 ELSE 6066 END
                WHEN 4 THEN 0 END""",
            "extra": """CASE n_nationkey % 5
                WHEN 0 THEN '{"deploy-mode":"cluster","queue":"etl"}'
                WHEN 1 THEN '{"deploy-mode":"cluster","namespace":"ns-conn"}'
                WHEN 2 THEN '{"deploy-mode":"cluster","spark-home":"/opt/spark/"}'
                WHEN 3 THEN '{"deploy-mode":"client","spark-binary":null}'
                ELSE '{"deploy-mode":"cluster","spark-home":"/opt/spark","spark-binary":"spark3-submit"}'
                END""",
        },
    ),
    "runs": Derived(
        base="orders",
        columns={
            "run_id": _RUN,
            "conn_id": "CONCAT('conn_', CAST(o_custkey % 28 AS STRING))",
            "spark_binary": "CASE o_orderkey % 7 WHEN 0 THEN '' WHEN 1 THEN 'spark2-submit' END",
            "conf": """CASE o_orderkey % 4
                WHEN 0 THEN '{"spark.kubernetes.namespace":"ns-conf"}'
                WHEN 1 THEN '{"spark.kubernetes.namespace":null}' WHEN 2 THEN '{}' END""",
            "cmd": """CONCAT('--name  job', CAST(o_orderkey AS STRING),
                ' --conf db.Password=''pw', CAST(o_custkey AS STRING),
                '''  app.py  --clientSecret = ''s ', o_orderpriority, ''' ')""",
            # NULL where the launcher has not returned yet.
            "returncode": """CASE WHEN o_orderkey % 11 = 0 THEN 1 WHEN o_orderkey % 13 = 0 THEN -9
                WHEN o_orderkey % 17 = 0 THEN NULL ELSE 0 END""",
            "env_vars": """CASE WHEN o_orderkey % 4 = 1 THEN NULL
                ELSE '{"SPARK_USER":"run","B":"x"}' END""",
            "cancelled": "o_orderkey % 3 = 0",
            "launcher_alive": "o_orderkey % 2 = 0",
        },
    ),
    "submit_log": Derived(
        base="orders",
        numbers={"line_no": 8},
        columns={
            "run_id": _RUN,
            "line_no": "line_no",
            "line": """CASE (o_orderkey + 3 * line_no) % 10
                WHEN 0 THEN CONCAT('  Submitted application_17', CAST(o_custkey AS STRING), '_',
                    CAST(line_no AS STRING), ' and application_9_9')
                WHEN 1 THEN CONCAT('   pod name: job-', CAST(o_custkey AS STRING), '-driver ')
                WHEN 2 THEN CONCAT('   exit code: ', CASE WHEN o_orderkey % 29 = 2
                    THEN '99999999999999999999999' ELSE CAST(o_orderkey % 3 AS STRING) END)
                WHEN 3 THEN CONCAT('Driver driver-2024', CAST(o_custkey AS STRING), '-',
                    CAST(line_no AS STRING), ' submitted')
                WHEN 4 THEN 'spark.application_name set' WHEN 5 THEN 'Exit Code: 5'
                WHEN 6 THEN '' ELSE 'INFO waiting' END""",
        },
    ),
    "status_polls": Derived(
        base="orders",
        numbers={"poll_no": 16, "line_no": 2},
        columns={
            "run_id": _RUN,
            "poll_no": "poll_no",
            "line_no": "line_no",
            "line": """CASE line_no WHEN 1 THEN '{' ELSE
                CASE WHEN poll_no <= o_orderkey % 17 THEN
                    CASE WHEN o_orderkey % 19 = 3 AND poll_no = 4 THEN 'curl: (28) timed out'
                    WHEN o_orderkey % 23 = 5 AND poll_no = 3 THEN '  "driverState": "RUNNING",'
                    WHEN poll_no = 2 THEN '  "driverState" : "RELAUNCHING",'
                    ELSE '  "driverState" : "RUNNING",' END
                ELSE CASE o_orderkey % 5 WHEN 0 THEN '  "driverState" : "FAILED",'
                    WHEN 1 THEN '  "driverState" : "KILLED",'
                    ELSE '  "driverState" : "FINISHED",' END END END""",
            "returncode": """CASE WHEN o_orderkey % 6 = 0 THEN 1
                WHEN o_orderkey % 19 = 3 AND poll_no = 4 THEN 28 ELSE 0 END""",
        },
    ),
    "app_info": Derived(
        base="orders",
        columns={
            "run_id": _RUN,
            "body": """CASE WHEN o_orderkey % 9 = 0 THEN '{"app":{"state":"ACCEPTED"}}'
                ELSE CONCAT('{"app":{"id":"application_17_', CAST(o_orderkey AS STRING),
                '","amContainerLogs":"http://nm.example.org/logs/',
                CAST(o_orderkey AS STRING), '"}}') END""",
        },
    ),
    "history": Derived(
        base="orders",
        numbers={"attempt": 32},
        columns={
            "run_id": _RUN,
            "attempt": "attempt",
            "status_code": "CASE WHEN attempt <= o_orderkey % 33 THEN 503 ELSE 200 END",
            "body": """CASE WHEN attempt <= o_orderkey % 33 THEN ''
                WHEN o_orderkey % 2 = 0 THEN '{"attempts":[{"attemptId":"1"}]}'
                ELSE '{"attempts":[{"attemptId":"2"},{"attemptId":"1"}]}' END""",
        },
    ),
    "executors": Derived(
        base="orders",
        columns={
            "run_id": _RUN,
            "status_code": "CASE WHEN o_orderkey % 8 = 0 THEN 404 ELSE 200 END",
            "body": """CASE WHEN o_orderkey % 5 = 0
                THEN '[{"id":"1","executorLogs":{"stdout":"u1","stderr":"v1"}}]'
                ELSE CONCAT('[{"id":"1","executorLogs":{"stdout":"u1","stderr":"v1"}},',
                '{"id":"driver","executorLogs":{"stdout":"o', CAST(o_orderkey AS STRING),
                '","stderr":"e', CAST(o_orderkey AS STRING), '"}}]') END""",
        },
    ),
    "log_pages": Derived(
        base="orders",
        numbers={"attempt": 13},
        columns={
            "run_id": _RUN,
            "attempt": "attempt",
            "html": """CASE WHEN attempt <= o_orderkey % 14
                THEN '<html><body>wait</body></html>'
                WHEN o_orderkey % 5 = 1 THEN CONCAT('<pre title=''a>b''>q &#65;&#x42; <b>', CAST(o_orderkey AS STRING), '</b></pre>')
                WHEN o_orderkey % 5 = 2 THEN CONCAT('<pre>out <pre>in ', CAST(attempt AS STRING), '</pre> rest</pre>')
                WHEN o_orderkey % 5 = 3 THEN CONCAT('<div><pre>kept ', CAST(o_orderkey AS STRING), '</div> after</pre>')
                ELSE CONCAT('<html><pre>stderr</pre><PRE class="o">1 < 2 and 3 > 2 out &lt;',
                CAST(o_orderkey AS STRING), '&gt; try ', CAST(attempt AS STRING),
                '</PRE></html>') END""",
        },
    ),
    "pod_log": Derived(
        base="orders",
        numbers={"line_no": 6},
        columns={
            "run_id": _RUN,
            "line_no": "line_no",
            "line": """CASE (o_orderkey + line_no) % 4
                WHEN 0 THEN CONCAT('24/01/01 INFO 处理完成 rows=', CAST(o_custkey AS STRING))
                WHEN 1 THEN 'WARN no match' WHEN 2 THEN '错误: 表不存在 retry 重试'
                ELSE '' END""",
        },
    ),
    # Whole pod logs; a carriage return does not end a Chinese text.
    "pod_log_text": Derived(
        base="orders",
        columns={
            "run_id": _RUN,
            "log": """CONCAT('24/01/01 INFO 处理完成 rows=', CAST(o_custkey AS STRING), CHR(10),
                CASE WHEN o_orderkey % 3 = 0 THEN CONCAT('WARN no match', CHR(10)) ELSE '' END,
                '错误: 表不存在', CHR(13), ' retry 重试', CHR(10), 'end ', CAST(o_orderkey AS STRING))""",
        },
    ),
}

# Lines with their times: a minute apart, from the order's day on.
for _name, _timed, _time, _number in (
    ("submit_log", "timed_log", "logged_at", "line_no"), ("status_polls", "timed_polls", "polled_at", "poll_no"),
):
    _at = f"CAST(o_orderdate AS TIMESTAMP) + INTERVAL '1' MINUTE * {_number}"
    DERIVED[_timed] = Derived("orders", DERIVED[_name].columns | {_time: _at}, DERIVED[_name].numbers)


# Runs with their start, and connections whose settings change: the master moves in 1997 and again in 1999.
DERIVED["started_runs"] = Derived(
    "orders", DERIVED["runs"].columns
    | {"started_at": "CAST(o_orderdate AS TIMESTAMP) + INTERVAL '1' MINUTE * (o_orderkey % 1440)"},
)
DERIVED["connection_versions"] = Derived(
    "nation",
    {
        "conn_id": DERIVED["connections"].columns["conn_id"],
        "valid_from": """CAST(CASE version WHEN 1 THEN '1995-02-01 12:00:00' WHEN 2 THEN '1997-06-10 00:30:00'
            ELSE '1999-06-01 00:00:00' END AS TIMESTAMP) + INTERVAL '1' DAY * n_nationkey""",
        "host": f"CASE WHEN version = 1 THEN {DERIVED['connections'].columns['host']} ELSE CONCAT('yarn-v', CAST(version AS STRING)) END",
        "port": DERIVED["connections"].columns["port"],
        "extra": DERIVED["connections"].columns["extra"],
    },
    {"version": 3},
)


def derive(base: DataFrame, name: str) -> DataFrame:
    """The named table from its base table, batch or stream."""
    table = DERIVED[name]
    rows = base
    for column, last in table.numbers.items():
        rows = rows.selectExpr("*", f"explode(sequence(1, {last})) AS {column}")
    return rows.selectExpr(*[f"{text} AS {column}" for column, text in table.columns.items()])


def _spread(base: DataFrame, table: Derived) -> DataFrame:
    """Orders over all tasks, in turn: the given file may be a single task's work, and the narrow
    rows are the cheap ones to move, before texts are built and rows multiplied. They are not
    dealt by key, so that the operators' own shuffles stay in the plans."""
    if table.base != "orders":
        return base
    tasks = int(base.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return base.repartition(tasks)


def derived_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The named table over the given folder."""
    table = DERIVED[name]
    base = spark.read.schema(BASES[table.base]).parquet(f"{sf_dir}/{table.base}.parquet")
    return derive(_spread(base, table), name)


def derived_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The named table as a stream over the base table's files.

    The pattern matches the one name; Spark streams a pattern whether it is a file or a folder.
    """
    table = DERIVED[name]
    files = spark.readStream.schema(BASES[table.base])
    return derive(_spread(files.parquet(f"{sf_dir}/{table.base}.[p]arquet"), table), name)


def derived_sql(*names: str) -> str:
    """The named tables as SQL common table expressions."""
    parts = []
    for name in names:
        table = DERIVED[name]
        columns = ", ".join(f"{text} AS {column}" for column, text in table.columns.items())
        sources = [table.base] + [
            f"(VALUES {', '.join(f'({n})' for n in range(1, last + 1))}) AS {column}_t({column})"
            for column, last in table.numbers.items()
        ]
        parts.append(f"{name} AS (SELECT {columns} FROM {' CROSS JOIN '.join(sources)})")
    return ",\n".join(parts)
