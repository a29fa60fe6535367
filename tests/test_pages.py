from pyspark.sql import functions as F
from runtrail import schemas
from runtrail.operators import pages

WAIT, PRE = "<html>wait</html>", "<pre>{}</pre>"


def test_first_log_text(spark):
    rows = (
        [(1, n, WAIT) for n in range(1, 12)] + [(1, 12, PRE.format("late"))]
        + [(2, n, WAIT) for n in range(1, 11)] + [(2, 11, PRE.format("last try"))]
        + [(3, 2, PRE.format("b")), (3, 1, WAIT), (3, 3, PRE.format("c"))]
        + [(4, 1, "<!-- <pre>x</pre> -->"), (4, 2, "<pre></pre>"), (4, 3, PRE.format("d"))]
    )
    found = pages.first_log_text(spark.createDataFrame(rows, schemas.LOG_PAGES).repartition(3))
    assert {tuple(r) for r in found.collect()} == {
        (1, None, None, 1), (2, 11, "last try", 0), (3, 2, "b", 0), (4, 2, "", 0),
    }
    unlimited = pages.first_log_text(spark.createDataFrame(rows, schemas.LOG_PAGES), None)
    assert [r.log_text for r in unlimited.where("run_id = 1").collect()] == ["late"]


def test_first_history_reply(spark):
    rows = [
        (1, 1, 503, ""), (1, 3, 200, "c"), (1, 2, 200, "b"),
        (2, 31, 200, "late"), (2, 30, 404, ""),
        (3, 30, 200, "in time"),
    ]
    found = pages.first_history_reply(spark.createDataFrame(rows, schemas.HISTORY).repartition(3))
    assert {tuple(r) for r in found.collect()} == {
        (1, 2, "b", 0), (2, None, None, 1), (3, 30, "in time", 0),
    }
    unlimited = pages.first_history_reply(spark.createDataFrame(rows, schemas.HISTORY), None)
    assert [r.body for r in unlimited.where("run_id = 2").collect()] == ["late"]


def test_history_address(spark):
    ids = spark.createDataFrame([(1, "application_1"), (2, "application_2"), (3, None)],
                                "run_id bigint, application_id string")
    history = spark.createDataFrame([(1, 1, 200, '{"attempts":[{},{}]}'), (3, 1, 200, '{"attempts":[]}')],
                                    schemas.HISTORY)
    found = pages.history_address(ids, history, "http://h")
    assert {tuple(r) for r in found.collect()} == {
        (1, "application_1", 2, "http://h/application_1/2/executors"),
        (2, "application_2", None, None),
    }


def test_driver_log_links(spark):
    body = '[{"id":"driver","executorLogs":{"stdout":"o","stderr":"e"}}]'
    rows = [(1, 200, body), (2, 404, body), (3, 200, "[]")]
    found = pages.driver_log_links(spark.createDataFrame(rows, schemas.EXECUTORS))
    assert {tuple(r) for r in found.collect()} == {(1, "o", "e"), (2, None, None), (3, None, None)}


def test_app_log_address(spark):
    rows = [(1, '{"app":{"amContainerLogs":"u"}}'), (2, "{}")]
    found = pages.app_log_address(spark.createDataFrame(rows, schemas.APP_INFO))
    assert {tuple(r) for r in found.collect()} == {(1, "u"), (2, None)}


def test_cjk_lines(spark):
    rows = [(1, 1, "x 完成 1"), (1, 2, "no"), (2, 1, "错"), (2, 2, None)]
    found = pages.cjk_lines(spark.createDataFrame(rows, schemas.POD_LOG))
    assert {tuple(r) for r in found.collect()} == {(1, 1, "完成 1"), (2, 1, "错")}
    whole = [(1, "x 完成 1\nno\n错".encode()), (2, b"\xff"), (3, b"no")]
    found = pages.cjk_lines_of_bytes(spark.createDataFrame(whole, schemas.POD_LOG_BYTES))
    assert {tuple(r) for r in found.collect()} == {
        (1, 0, "完成 1", False), (1, 1, "错", False), (2, None, None, True),
    }


def test_history_is_folded_by_hash_without_sorting(spark):
    """The first good try and its count go into one integer; missing counts and odd tries are kept apart."""
    rows = [
        (1, 2, 200, '{"attempts":[{},{}]}'), (1, 3, 200, '{"attempts":[{}]}'), (2, 1, 503, ""), (3, 1, 200, "none"),
        (4, -5, 200, '{"attempts":[{}]}'), (4, 1, 200, '{"attempts":[{},{}]}'), (5, None, 200, '{"attempts":[{}]}'), (6, 99, 200, "{}"),
    ]
    history = spark.createDataFrame(rows, schemas.HISTORY)
    ids = spark.createDataFrame([(n, f"application_{n}") for n in range(1, 7)], "run_id bigint, application_id string")
    packed = pages.history_address(ids, history, "http://h")
    wide = pages.history_address(ids, history.withColumn("attempt", F.col("attempt").cast("bigint")), "http://h")
    assert packed.schema == wide.schema and sorted(packed.collect()) == sorted(wide.collect())
    assert "SortAggregate" not in packed._jdf.queryExecution().executedPlan().toString()
