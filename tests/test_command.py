import random
import re

import pytest
from pyspark.sql import functions as F

from runtrail.functions import command, replies


def mask(column):
    return command.mask_command(F.split(column, "\\|"))


@pytest.mark.parametrize("argv, masked", [
    ("--conf|HivePassword='abc'|x", "--conf HivePassword='******' x"),
    ("a.secret.b = 'v w' c", "a.secret.b = '******' c"),
    ("password=abc", "password=abc"),
    ("PASSWORD='a", "PASSWORD='a"),
    ('password="a"', 'password="a"'),
    ("Secret='a'|Secret2='b'", "Secret='******' Secret2='******'"),
    ("password='a|b|c'|d", "password='******' d"),
    ("password=''", "password='******'"),
    ("xpasswordy=z='q'", "xpasswordy=z='******'"),
])
def test_mask_command(apply, argv, masked):
    assert apply(mask, [argv]) == [masked]


def test_mask_command_against_the_whole_key_form(apply):
    """Matching only from the key word on gives what matching the whole key gives."""
    whole = re.compile(r"(\S*?(?:secret|password)\S*?\s*=\s*')[^']*(?=')", re.IGNORECASE)
    rng = random.Random(7)
    parts = ["secret", "Password", "=", "'", "''", " ", "|", "x", "a=b", "--conf", " = '", "k'"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 14))) for _ in range(600)]
    expected = [whole.sub(r"\1******", " ".join(t.split("|"))) for t in texts]
    assert apply(mask, texts) == expected


def test_long_commands_are_masked_in_reasonable_time(apply):
    jars = ",".join(f"/opt/jars/lib-{n}.jar" for n in range(20000))
    masked = apply(mask, [f"--jars|{jars}|p.password='x'"])[0]
    assert masked == f"--jars {jars} p.password='******'"


@pytest.mark.parametrize("home, binary, path", [
    ("/opt/spark/", "spark-submit", "/opt/spark/bin/spark-submit"),
    ("/opt/spark", "spark-submit", "/opt/spark/bin/spark-submit"),
    ("/opt/spark", "/usr/bin/s", "/usr/bin/s"),
    ("", "spark-submit", "spark-submit"),
    (None, "spark-submit", "spark-submit"),
    (None, None, None),
    ("/opt/spark", None, None),
])
def test_executable(spark, home, binary, path):
    row = spark.createDataFrame([(home, binary)], "home string, binary string")
    assert row.select(command.executable(row.home, row.binary)).first()[0] == path


def test_argv_of_an_unknown_program_or_command_is_unknown(spark):
    rows = spark.createDataFrame(
        [(1, "p", " a  b "), (2, None, "a"), (3, "p", None), (4, "p", "")],
        "n int, program string, cmd string",
    )
    argv = rows.select("n", command.build_argv(rows.program, rows.cmd).alias("a"))
    assert {r.n: r.a for r in argv.collect()} == {1: ["p", "a", "b"], 2: None, 3: None, 4: ["p"]}


@pytest.mark.parametrize("master, address", [
    ("spark://h:6066", "http://h:6066/v1/submissions/status/driver-1"),
    ("spark://h:7077", None),
])
def test_poll_address(spark, master, address):
    row = spark.createDataFrame([(master, "driver-1")], "m string, d string")
    assert row.select(command.poll_address(row.m, row.d)).first()[0] == address


def test_error_texts(spark):
    row = spark.createDataFrame([("x y", -9, "driver-1", "KILLED")], "m string, rc int, d string, s string")
    texts = row.select(
        command.submit_error(row.m, row.rc), command.driver_error(row.d, row.s),
        command.poll_error(row.rc),
    ).first()
    assert list(texts) == [
        "Cannot execute: x y. Error code is: -9.",
        "ERROR : Driver driver-1 badly exited with status KILLED",
        "Failed to poll for the driver status 10 times: returncode = -9",
    ]


def test_overlay(spark):
    rows = spark.createDataFrame(
        [(1, {"A": "1", "B": "2"}, {"B": "3", "C": None}), (2, {"A": "1"}, None), (3, None, {"A": "x"})],
        "n int, base map<string,string>, over map<string,string>",
    )
    env = rows.select("n", command.overlay(rows.base, rows.over).alias("env")).collect()
    assert {r.n: r.env for r in env} == {1: {"A": "1", "B": "3", "C": None}, 2: {"A": "1"}, 3: {"A": "x"}}


def test_replies(apply):
    assert apply(replies.container_log_address, [
        '{"app":{"amContainerLogs":"http://n/l"}}', '{"app":{}}', '{}', "no json", None,
    ]) == ["http://n/l", None, None, None, None]
    assert apply(replies.attempt_count, ['{"attempts":[{"a":1},{"a":2}]}', '{"attempts":[]}', ""]) == [2, 0, None]
    logs = apply(replies.driver_logs, [
        '[{"id":"1","executorLogs":{"stdout":"a","stderr":"b"}},'
        '{"id":"driver","executorLogs":{"stdout":"c","stderr":"d"}},'
        '{"id":"driver","executorLogs":{"stdout":"e","stderr":"f"}}]',
        "[]", "{}",
    ])
    assert [l and tuple(l) for l in logs] == [("c", "d"), None, None]


def test_executors_address(spark):
    row = spark.createDataFrame([("application_1_2", 3)], "a string, n int")
    address = replies.executors_address("http://h/api/", row.a, row.n)
    assert row.select(address).first()[0] == "http://h/api/application_1_2/3/executors"
