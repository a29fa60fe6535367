"""Column functions on service replies kept as JSON text."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from runtrail import fixed_values as fixed


def as_map(column: Column, kind):
    """Settings as ``map<string,string>``, from a map or from JSON text.

    JSON text may repeat a key; as in any JSON reader the last one counts.
    """
    if kind.typeName() == "map":
        return column
    read = F.from_json(column, "map<string,string>")
    keys = F.map_keys(read)
    backwards = F.reverse(keys)
    last = F.filter(
        F.map_entries(read),
        lambda entry, at: at == F.size(keys) - F.array_position(backwards, entry["key"]),
    )
    repeats = F.size(F.array_distinct(keys)) < F.size(keys)
    return F.when(repeats, F.map_from_entries(last)).otherwise(read)


def container_log_address(body: Column, parsed: bool = False):
    """Address of the driver's log page in a resource-manager reply, JSON text or ``parsed``."""
    path = "$.app.amContainerLogs"
    return F.try_variant_get(body, path, "string") if parsed else F.get_json_object(body, path)


def attempt_count(body: Column, parsed: bool = False):
    """How many attempts a history reply lists."""
    if parsed:
        attempts = F.try_variant_get(body, "$.attempts", "array<variant>")
        return F.when(attempts.isNotNull(), F.size(attempts))
    return F.json_array_length(F.get_json_object(body, "$.attempts"))


def executors_address(base: str, application_id: Column, attempts: Column):
    """Address of the executor list of an application's latest attempt."""
    latest = attempts.cast("string")
    return F.concat(F.lit(base.rstrip("/") + "/"), application_id, F.lit("/"), latest,
                    F.lit("/executors"))


def driver_logs(body: Column, parsed: bool = False):
    """stdout and stderr addresses of the first executor named ``driver``."""
    if parsed:
        executors = F.try_variant_get(body, "$", "array<variant>")
        named = F.filter(executors, lambda e: F.try_variant_get(e, "$.id", "string") == fixed.DRIVER_ENTRY)
        logs = F.get(named, F.lit(0))
        places = {c: F.try_variant_get(logs, f"$.executorLogs.{c}", "string") for c in ("stdout", "stderr")}
        return F.struct(*[place.alias(c) for c, place in places.items()])
    kind = "array<struct<id:string,executorLogs:struct<stdout:string,stderr:string>>>"
    drivers = F.filter(F.from_json(body, kind), lambda e: e["id"] == fixed.DRIVER_ENTRY)
    return F.get(drivers, F.lit(0))["executorLogs"]
