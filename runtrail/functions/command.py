"""Column functions on commands, addresses and messages."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from runtrail import fixed_values as fixed
from runtrail.functions.text import tokenize


def executable(spark_home: Column, binary: Column):
    """Path of the launcher: under the home's ``bin`` unless the binary is absolute."""
    home = F.when(spark_home.endswith("/"), spark_home).otherwise(F.concat(spark_home, F.lit("/")))
    under_home = F.concat(home, F.lit("bin/"), binary)
    plain = spark_home.isNull() | (spark_home == "") | binary.startswith("/")
    return F.when(plain, binary).otherwise(under_home)


def build_argv(program: Column, cmd: Column):
    """Program and command tokens; NULL if either is unknown (array_join would skip it)."""
    argv = F.concat(F.array(program), tokenize(cmd))
    return F.when(program.isNotNull() & cmd.isNotNull(), argv)


def mask_command(argv: Column):
    """The command as text with every single-quoted secret value hidden."""
    joined = F.array_join(argv, " ")
    return F.regexp_replace(joined, fixed.SECRET_VALUE, "$1" + fixed.HIDDEN)


def poll_address(master: Column, driver_id: Column):
    """Where the state of a driver can be looked up, for masters with the REST port."""
    http = F.replace(master, F.lit("spark://"), F.lit("http://"))
    address = F.concat(http, F.lit(fixed.POLL_PATH), driver_id)
    return F.when(master.endswith(fixed.REST_PORT_MARK), address)


def submit_error(masked: Column, returncode: Column):
    text = F.format_string(fixed.SUBMIT_ERROR, masked, returncode)
    return F.when(masked.isNotNull() & returncode.isNotNull(), text)


def driver_error(driver_id: Column, state: Column):
    return F.format_string(fixed.DRIVER_ERROR, driver_id, state)


def poll_error(returncode: Column, tolerated: int = fixed.TOLERATED_MISSES):
    return F.format_string(fixed.POLL_ERROR, F.lit(tolerated), returncode)


def overlay(base: Column, over: Column):
    """Map union in which ``over`` wins; a missing map counts as empty."""
    empty = F.create_map().cast("map<string,string>")
    over = F.coalesce(over, empty)
    kept = F.map_filter(F.coalesce(base, empty), lambda k, _: ~F.map_contains_key(over, k))
    return F.map_concat(kept, over)
