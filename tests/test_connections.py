import pytest

from runtrail import schemas
from runtrail.operators import connections as conn

CONNECTIONS = [
    ("yarn", "yarn", None, '{"deploy-mode":"cluster","queue":"q","namespace":"a"}'),
    ("port0", "host", 0, None),
    ("k8s", "k8s://https://h", 6443, '{"namespace":"a","spark-home":"/s"}'),
    ("alone", "spark://h", 7077, '{"deploy-mode":"cluster"}'),
    ("client", "spark://h", 7077, '{"deploy-mode":"client"}'),
    ("case", "spark://h", 7077, '{"deploy-mode":"Cluster"}'),
    ("both", "k8s://yarn-box", 1, '{"deploy-mode":"cluster"}'),
    ("yarnbox", "spark://yarn-box", 7077, '{"deploy-mode":"cluster"}'),
    ("binary", "local", None, '{"spark-binary":"spark3-submit"}'),
    ("nullbinary", "local", None, '{"spark-binary":null}'),
    ("nohost", None, 7077, "not json"),
]


def resolve(spark, runs, **options):
    """``runs`` holds (conn_id, spark_binary, conf) rows; gives the resolved rows in order."""
    rows = [(n, c, b, conf, "x", 0, None, False, False) for n, (c, b, conf) in enumerate(runs)]
    connections = spark.createDataFrame(CONNECTIONS, schemas.CONNECTIONS)
    resolved = conn.resolve_connections(
        spark.createDataFrame(rows, schemas.RUNS), connections, **options
    )
    return conn.deployment_flags(resolved).orderBy("run_id").collect()


def test_master_and_settings(spark):
    names = ["yarn", "port0", "k8s", "missing", None, "nohost"]
    rows = resolve(spark, [(n, None, None) for n in names])
    assert [r.master for r in rows] == ["yarn", "host", "k8s://https://h:6443", "yarn", "yarn", None]
    assert [r.conn_found for r in rows] == [True, True, True, False, False, True]
    assert [r.queue for r in rows] == ["q", None, None, None, None, None]
    assert [r.deploy_mode for r in rows] == ["cluster", None, None, None, None, None]
    assert [r.spark_home for r in rows] == [None, None, "/s", None, None, None]
    assert [r.invalid_connection for r in rows] == [False] * 5 + [True]


def test_binary(spark):
    runs = [(c, b, None) for c in ("binary", "nullbinary", "yarn", "missing") for b in ("own", "", None)]
    hook = [r.binary for r in resolve(spark, runs)]
    assert hook == ["own", "spark3-submit", "spark3-submit", "own", None, None,
                    "own", "spark-submit", "spark-submit", "own", "spark-submit", "spark-submit"]
    task = [r.binary for r in resolve(spark, runs, via_operator=True)]
    assert task == ["own", "spark3-submit", "spark-submit", "own", None, "spark-submit",
                    "own", "spark-submit", "spark-submit", "own", "spark-submit", "spark-submit"]


def test_namespace_of_the_conf_wins_even_if_null(spark):
    confs = ['{"spark.kubernetes.namespace":"b"}', '{"spark.kubernetes.namespace":null}', "{}", None]
    rows = resolve(spark, [("k8s", None, c) for c in confs] + [("missing", None, confs[0])])
    assert [r.namespace for r in rows] == ["b", None, "a", "a", "b"]


def test_flags_and_route(spark):
    names = ["yarn", "missing", "k8s", "alone", "client", "case", "both", "yarnbox", "binary", "nohost"]
    rows = resolve(spark, [(n, None, None) for n in names])
    assert [r.route for r in rows] == [
        "app", None, "pod", "driver", None, None, "app", "app", None, None,
    ]
    assert [n for n, r in zip(names, rows) if r.is_tracked] == ["alone", "yarnbox"]
    assert [n for n, r in zip(names, rows) if r.is_yarn] == ["yarn", "missing", "both", "yarnbox"]
    assert [n for n, r in zip(names, rows) if r.is_k8s] == ["k8s", "both"]


def test_settings_may_be_maps(spark):
    connections = spark.createDataFrame(
        [("c", "h", 1, {"namespace": "a", "spark-binary": None})],
        "conn_id string, host string, port int, extra map<string,string>",
    )
    runs = spark.createDataFrame(
        [(1, "c", None, {"spark.kubernetes.namespace": None}), (2, "c", None, {})],
        "run_id bigint, conn_id string, spark_binary string, conf map<string,string>",
    )
    rows = conn.resolve_connections(runs, connections).orderBy("run_id").collect()
    assert [(r.binary, r.namespace) for r in rows] == [(None, None), (None, "a")]


@pytest.mark.parametrize("threshold", ["-1", "10485760"])
def test_lookup_gives_the_same_beyond_the_broadcast_limit(spark, threshold):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        rows = resolve(spark, [("yarn", None, None)] * 50 + [("missing", None, None)])
        assert [r.queue for r in rows] == ["q"] * 50 + [None]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_env_overlay(spark):
    runs = spark.createDataFrame(
        [(1, '{"A":"x","B":null}'), (2, None), (3, "{}")], "run_id bigint, env_vars string"
    )
    env = {r.run_id: r.env for r in conn.env_overlay(runs, {"A": "1", "C": "2"}).collect()}
    assert env == {1: {"A": "x", "B": None, "C": "2"}, 2: {"A": "1", "C": "2"}, 3: {"A": "1", "C": "2"}}


def test_the_last_of_a_repeated_key_counts(spark):
    runs = spark.createDataFrame([(1, '{"B":"1","B":"2","A":"x"}')], "run_id bigint, env_vars string")
    assert conn.env_overlay(runs, {"C": "3"}).first().env == {"A": "x", "B": "2", "C": "3"}
    again = [("c", "h", 1, '{"queue":"a","queue":"b"}')]
    connections = spark.createDataFrame(again, schemas.CONNECTIONS)
    rows = [(1, "c", None, None, "x", 0, None, False, False)]
    found = conn.resolve_connections(spark.createDataFrame(rows, schemas.RUNS), connections).first()
    assert (found.queue, found.conn_repeated) == ("b", False)


def test_a_repeated_connection_does_not_repeat_its_runs(spark):
    twice = [("c", "h2", 2, '{"queue":"b"}'), ("c", "h1", 1, '{"queue":"a"}'), ("d", "h", 1, None)]
    connections = spark.createDataFrame(twice, schemas.CONNECTIONS)
    rows = [(n, c, None, None, "x", 0, None, False, False) for n, c in enumerate("ccd")]
    found = conn.resolve_connections(spark.createDataFrame(rows, schemas.RUNS), connections).orderBy("run_id").collect()
    assert [(r.master, r.queue, r.conn_repeated) for r in found] == [
        ("h1:1", "a", True), ("h1:1", "a", True), ("h:1", None, False),
    ]
