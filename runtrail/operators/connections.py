"""Connection settings of each run and what they mean for it."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from runtrail import fixed_values as fixed
from runtrail.functions.command import executable, overlay
from runtrail.functions.replies import as_map


def _one_each(connections):
    """One row per connection. Of repeated ones the first by host, port and settings counts.

    The id is built anew afterwards: a join on it then shuffles both its sides, and only so
    can Spark split a connection that many runs share.
    """
    kind = connections.schema["extra"].dataType
    extra = F.to_json("extra") if kind.typeName() == "map" else F.col("extra")
    row = F.min_by(F.struct("host", "port", "extra"), F.struct("host", "port", extra))
    return connections.groupBy("conn_id").agg(
        row.alias("row"), (F.count("*") > 1).alias("conn_repeated")
    ).select(F.concat(F.lit(""), "conn_id").alias("conn_id"), "row.*", "conn_repeated")


def _lookup(connections):
    """One row per connection with its settings taken out of ``extra``, read once each."""
    return _settings(_one_each(connections), connections.schema["extra"].dataType, "conn_repeated")


def _settings(rows, kind, *keep):
    """The settings of each row, taken out of ``extra``."""
    extra = as_map(F.col("extra"), kind)

    def setting(key):
        return f"try_element_at(extra, '{key}')"

    return rows.select("conn_id", "host", "port", extra.alias("extra"), *keep).selectExpr(
        "conn_id", *keep,
        """CASE WHEN host IS NULL THEN NULL WHEN coalesce(port, 0) != 0
            THEN concat(host, ':', port) ELSE host END AS conn_master""",
        f"{setting(fixed.EXTRA_QUEUE)} AS queue",
        f"{setting(fixed.EXTRA_DEPLOY_MODE)} AS deploy_mode",
        f"{setting(fixed.EXTRA_SPARK_HOME)} AS spark_home",
        f"map_contains_key(extra, '{fixed.EXTRA_SPARK_BINARY}') AS conn_has_binary",
        f"{setting(fixed.EXTRA_SPARK_BINARY)} AS conn_binary",
        f"{setting(fixed.EXTRA_NAMESPACE)} AS conn_namespace",
        "true AS conn_found",
    )


def resolve_connections(runs: DataFrame, connections: DataFrame, via_operator=False) -> DataFrame:
    """Add master, queue, deploy_mode, spark_home, binary and namespace to each run.

    Runs whose connection is unknown get the defaults; ``conn_repeated`` marks those whose
    connection has several rows, of which one counts. A setting that is present but
    null stays null. ``via_operator`` models runs started through the task type, whose
    own binary defaults to the launcher's name and so hides the connection's.

    The join carries no hint: Spark broadcasts the connections while their size is under
    ``spark.sql.autoBroadcastJoinThreshold`` and otherwise joins by shuffle, where the
    adaptive skew join splits a connection that many runs share.
    """
    joined = runs.join(_lookup(connections), "conn_id", "left")
    return _resolved(joined, runs, via_operator, "coalesce(conn_repeated, false) AS conn_repeated")


def _resolved(joined: DataFrame, runs: DataFrame, via_operator: bool, *more: str) -> DataFrame:
    """The runs with what their connection, found or not, means for them."""
    conf = as_map(F.col("conf"), runs.schema["conf"].dataType)
    joined = joined.withColumn("conf_map", conf)
    own_binary = f"coalesce(spark_binary, '{fixed.DEFAULT_BINARY if via_operator else ''}')"
    return joined.selectExpr(
        *runs.columns,
        "coalesce(conn_found, false) AS conn_found",
        *more,
        f"CASE WHEN conn_found THEN conn_master ELSE '{fixed.DEFAULT_MASTER}' END AS master",
        "queue", "deploy_mode", "spark_home",
        f"""CASE WHEN {own_binary} != '' THEN {own_binary}
            WHEN conn_has_binary THEN conn_binary
            ELSE '{fixed.DEFAULT_BINARY}' END AS binary""",
        f"""CASE WHEN map_contains_key(conf_map, '{fixed.NAMESPACE_CONF}')
            THEN try_element_at(conf_map, '{fixed.NAMESPACE_CONF}')
            ELSE conn_namespace END AS namespace""",
    )


def last_versions(
    events: DataFrame, versions: DataFrame, key: str, at: str, since: str, slice_of: str
) -> DataFrame:
    """Each event with ``version``, the newest of its key that began at or before it (an as-of join).

    Events and versions are merged and ordered in one window, which carries the newest version on.
    The window is split by key and time slice (``slice_of`` is an expression over a column ``moment``),
    so that a key with most events spreads over its slices; each slice starts from the version it
    inherits, found among the few versions alone. Of versions that begin together the last by their
    values counts. Events without key or time have none; versions without them never begin.
    """
    columns = [c for c in versions.columns if c != key]
    began = versions.where(F.col(key).isNotNull() & F.col(since).isNotNull()).select(
        F.col(key).alias("k"), F.col(since).alias("moment"), F.struct(since, *[c for c in columns if c != since]).alias("version")
    ).withColumn("slice", F.expr(slice_of))
    asked = events.select(F.struct(*events.columns).alias("event"), F.col(key).alias("k"), F.col(at).alias("moment")).withColumn(
        "slice", F.expr(slice_of)
    )
    nothing = F.lit(None).cast(began.schema["version"].dataType)
    no_event = F.lit(None).cast(asked.schema["event"].dataType)
    # A row for every slice of a key that holds events or versions, and the newest version before it.
    slices = asked.where("k IS NOT NULL AND moment IS NOT NULL").select("k", "slice", nothing.alias("version")).distinct()
    newest = began.select("k", "slice", "version").unionByName(slices).groupBy("k", "slice").agg(F.max("version").alias("version"))
    earlier = Window.partitionBy("k").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    inherited = newest.select("k", "slice", F.max("version").over(earlier).alias("version")).where("version IS NOT NULL")
    merged = (
        asked.select("k", "slice", "moment", F.lit(2).alias("kind"), nothing.alias("version"), "event")
        .unionByName(began.select("k", "slice", "moment", F.lit(1).alias("kind"), "version", no_event.alias("event")))
        .unionByName(inherited.select(
            "k", "slice", F.lit(None).cast(asked.schema["moment"].dataType).alias("moment"), F.lit(0).alias("kind"), "version",
            no_event.alias("event")))
    )
    in_order = Window.partitionBy("k", "slice").orderBy(F.col("moment").asc_nulls_first(), "kind").rangeBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    known = F.when(F.col("k").isNotNull() & F.col("moment").isNotNull(), F.max("version").over(in_order))
    return merged.withColumn("version", known).where("kind = 2").select("event.*", "version")


def resolve_connections_as_of(
    runs: DataFrame, versions: DataFrame, via_operator: bool = False, started: str = "started_at",
    slice_of: str = "date_trunc('month', moment)",
) -> DataFrame:
    """``resolve_connections`` with the settings that held when each run started.

    ``versions`` has the connections' columns and ``valid_from``. A run that started before its
    connection's first version gets the defaults, like one whose connection is unknown; the same
    holds for a run without a start.
    """
    found = last_versions(runs, versions.select("conn_id", "valid_from", "host", "port", "extra"), "conn_id", started,
                          "valid_from", slice_of)
    read = _settings(
        found.where("version IS NOT NULL").select(*runs.columns, "version.host", "version.port", "version.extra", "version.valid_from"),
        versions.schema["extra"].dataType, *[c for c in runs.columns if c != "conn_id"], "valid_from",
    )
    return _resolved(
        read.unionByName(found.where("version IS NULL").select(*runs.columns), allowMissingColumns=True), runs, via_operator,
        "valid_from AS conn_since",
    )


def deployment_flags(resolved: DataFrame) -> DataFrame:
    """Add the kind of cluster and which kind of id its log lines are searched for.

    Branch order matters: YARN in cluster mode first, then Kubernetes, then a tracked
    standalone driver. The flags themselves may overlap.
    """
    cluster = f"deploy_mode <=> '{fixed.CLUSTER_MODE}'"
    return resolved.selectExpr(
        "*",
        f"coalesce(contains(master, '{fixed.YARN_MARK}'), false) AS is_yarn",
        f"coalesce(contains(master, '{fixed.K8S_MARK}'), false) AS is_k8s",
        f"""coalesce(contains(master, '{fixed.STANDALONE_MARK}'), false) AND {cluster}
            AS is_tracked""",
        "master IS NULL AS invalid_connection",
    ).selectExpr(
        "*",
        f"""CASE WHEN is_yarn AND {cluster} THEN 'app' WHEN is_k8s THEN 'pod'
            WHEN is_tracked THEN 'driver' END AS route""",
    )


def executable_path(resolved: DataFrame) -> DataFrame:
    return resolved.withColumn("executable", executable(F.col("spark_home"), F.col("binary")))


def env_overlay(runs: DataFrame, base: dict) -> DataFrame:
    """Add each run's environment: the base variables with the run's own on top."""
    pairs = [F.lit(part) for item in sorted(base.items()) for part in item]
    base_map = F.create_map(*pairs).cast("map<string,string>")
    own = as_map(F.col("env_vars"), runs.schema["env_vars"].dataType)
    return runs.withColumn("own_env", own).withColumn(
        "env", overlay(base_map, F.col("own_env"))
    ).drop("own_env")
