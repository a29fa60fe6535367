"""Facts from service replies, log pages and pod logs."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from runtrail import fixed_values as fixed
from runtrail.functions import replies
from runtrail.functions.html import has_pre, last_pre
from runtrail.functions.text import cjk_text, cjk_texts, has_cjk


def _reply(table: DataFrame) -> tuple:
    """The column of replies, and whether it is parsed: landed as a variant, not JSON text."""
    parsed = "reply" in table.columns
    return F.col("reply" if parsed else "body"), parsed


def app_log_address(app_info: DataFrame) -> DataFrame:
    return app_info.select(
        "run_id", replies.container_log_address(*_reply(app_info)).alias("log_address")
    )


def _within(max_attempts):
    return F.lit(True) if max_attempts is None else F.col("attempt") <= max_attempts


def _beyond(max_attempts):
    """How many rows of a run lie past the limit."""
    return F.count_if(~_within(max_attempts)).alias("beyond_limit")


def first_history_reply(
    history: DataFrame, max_attempts: int | None = fixed.HISTORY_ATTEMPTS
) -> DataFrame:
    """The first good reply within ``max_attempts`` tries, NULL for runs that got none.

    None allows every try; ``beyond_limit`` counts the tries that were left out.
    """
    good = (F.col("status_code") == fixed.HTTP_OK) & _within(max_attempts)
    first = F.min(F.when(good, F.struct("attempt", "body"))).alias("first")
    return history.groupBy("run_id").agg(first, _beyond(max_attempts)).select(
        "run_id", "first.attempt", "first.body", "beyond_limit"
    )


def history_address(
    ids: DataFrame, history: DataFrame, base: str,
    max_attempts: int | None = fixed.HISTORY_ATTEMPTS,
) -> DataFrame:
    """Address of the executor list for each run with an application id and a good reply.

    Replies shrink to their number of attempts before they are shuffled. Where the number of the try
    fits, both go into one integer, whose minimum Spark takes by hash without sorting the replies.
    """
    good = (F.col("status_code") == fixed.HTTP_OK) & _within(max_attempts)
    attempts = replies.attempt_count(*_reply(history))
    packs = max_attempts is not None and history.schema["attempt"].dataType == IntegerType()
    if packs:
        # No count is the least value of an integer, as null is in a struct.
        low = F.coalesce(attempts.cast("bigint"), F.lit(-(1 << 31))) + F.lit(1 << 31)
        first = F.min(F.when(good, F.shiftleft(F.col("attempt").cast("bigint"), 32) + low)).alias("first")
        count = F.nullif(F.col("first").bitwiseAND(F.lit((1 << 32) - 1)) - F.lit(1 << 31), F.lit(-(1 << 31)))
        attempts = count.cast("int").alias("attempts")
    else:
        first = F.min(F.when(good, F.struct("attempt", attempts.alias("attempts")))).alias("first")
        attempts = F.col("first.attempts")
    counted = history.groupBy("run_id").agg(first).select("run_id", attempts)
    known = ids.select("run_id", "application_id").where(F.col("application_id").isNotNull())
    address = replies.executors_address(base, F.col("application_id"), F.col("attempts"))
    return known.join(counted.hint("merge"), "run_id", "left").select(
        "run_id", "application_id", "attempts", address.alias("executors_address")
    )


def driver_log_links(executors: DataFrame) -> DataFrame:
    """stdout and stderr addresses of each run's driver, NULL where the reply has none."""
    good = F.col("status_code") == fixed.HTTP_OK
    logs = F.when(good, replies.driver_logs(*_reply(executors)))
    return executors.select("run_id", logs.alias("logs")).select(
        "run_id", F.col("logs.stdout").alias("stdout"), F.col("logs.stderr").alias("stderr")
    )


def page_attempts(pages: DataFrame, max_attempts: int | None = fixed.PAGE_ATTEMPTS) -> DataFrame:
    """``page_attempt``: the first within ``max_attempts`` tries with a log, NULL if none has one."""
    ready = F.when(_within(max_attempts) & has_pre(F.col("html")), F.col("attempt"))
    return pages.groupBy("run_id").agg(F.min(ready).alias("page_attempt"))


def first_log_text(
    pages: DataFrame, max_attempts: int | None = fixed.PAGE_ATTEMPTS
) -> DataFrame:
    """Last ``<pre>`` text of the first page within ``max_attempts`` tries that has one, NULL if
    none has. None allows every try; ``beyond_limit`` counts the pages that were left out.

    The page is chosen by its mark and only the chosen one is parsed.
    """
    pick = F.when(_within(max_attempts) & has_pre(F.col("html")), F.struct("attempt", "html"))
    first = pages.groupBy("run_id").agg(F.min(pick).alias("first"), _beyond(max_attempts))
    return first.select(
        "run_id", "first.attempt", last_pre(F.col("first.html")).alias("log_text"), "beyond_limit"
    )


def cjk_lines(pod_log: DataFrame) -> DataFrame:
    """Lines of the pod logs that hold Chinese text, from its first character on."""
    line = F.col("line")
    return pod_log.where(has_cjk(line)).select(
        "run_id", "line_no", cjk_text(line).alias("cjk_text")
    )


def pod_texts(pod_log: DataFrame) -> DataFrame:
    """Per run with Chinese lines in its pod log: how many, the first and the last text."""
    text = F.struct("line_no", "cjk_text")
    return cjk_lines(pod_log).groupBy("run_id").agg(
        F.count("*").alias("pod_lines"), F.min(text)["cjk_text"].alias("pod_first"), F.max(text)["cjk_text"].alias("pod_last")
    )


def cjk_lines_of_bytes(pod_log: DataFrame) -> DataFrame:
    """The same for pod logs given whole as bytes.

    A log that is not UTF-8 gives one row without text, marked ``invalid_utf8``.
    """
    texts = F.posexplode_outer(cjk_texts(F.col("log"))).alias("text_no", "cjk_text")
    invalid = F.col("log").isNotNull() & F.try_validate_utf8(F.col("log")).isNull()
    rows = pod_log.select("run_id", invalid.alias("invalid_utf8"), "log").select(
        "run_id", texts, "invalid_utf8"
    )
    return rows.where(F.col("cjk_text").isNotNull() | F.col("invalid_utf8"))


def _cut_chunks(chunks: DataFrame) -> DataFrame:
    """What one chunk can tell by itself: ``head``, the bytes up to its first line end (all of them
    if it has none), ``tail``, those after its last one (null if it has none), and of the whole lines
    in between the Chinese ``texts``, null where they are not UTF-8.

    ISO-8859-1 turns bytes into characters one by one, so that text functions can cut anywhere.
    """
    latin = F.decode(F.coalesce("bytes", F.lit(b"")), "ISO-8859-1")
    with_text = chunks.select("run_id", "chunk_no", latin.alias("latin"))
    first = F.instr("latin", "\n")
    last = F.length("latin") - F.instr(F.reverse("latin"), "\n") + 1
    placed = with_text.select("*", first.alias("first"), last.alias("last"))
    middle = F.substring("latin", F.col("first") + 1, F.greatest(F.col("last") - F.col("first"), F.lit(0)))
    ended = F.col("first") > 0
    return placed.select(
        "run_id", "chunk_no", ended.alias("ended"),
        F.when(ended, F.substring("latin", F.lit(1), F.col("first") - 1)).otherwise(F.col("latin")).alias("head"),
        F.when(ended, F.substring("latin", F.col("last") + 1, F.length("latin"))).alias("tail"),
        F.when(ended, cjk_texts(F.encode(middle, "ISO-8859-1"))).otherwise(F.array().cast("array<string>")).alias("texts"),
    )


#: Chunks that lie together, as a power of two: a task takes whole slices of so many chunks of a log.
SLICE_BITS = 8


def _lines_of_cuts(cut: DataFrame) -> DataFrame:
    """Each piece with the chunk that its ``line`` starts in, -1 for the log's first line: a chunk's ``head``
    ends an earlier line; its ``tail`` starts one, and comes with the ``texts`` of the lines before it.
    """
    place = F.shiftright("chunk_no", SLICE_BITS).alias("slice")
    cut = cut.select("*", place)
    last = F.max(F.when(F.col("ended"), F.col("chunk_no")))
    slices = cut.groupBy("run_id", "slice").agg(last.alias("last"))
    earlier = Window.partitionBy("run_id").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    inherited = slices.select("run_id", "slice", F.max("last").over(earlier).alias("inherited")).where("inherited IS NOT NULL")
    in_slice = Window.partitionBy("run_id", "slice").orderBy("chunk_no")
    placed = cut.select(
        "*", last.over(in_slice.rangeBetween(Window.unboundedPreceding, -1)).alias("opened"),
        F.count("*").over(in_slice.rangeBetween(0, 0)).alias("copies"),
    ).join(inherited.hint("merge"), ["run_id", "slice"], "left")
    opened = F.coalesce("opened", "inherited", F.lit(-1))
    # A chunk number that comes again follows the first, so its head ends the line that the first one starts.
    again = F.array_repeat(F.when(F.col("ended"), F.col("chunk_no")).otherwise(F.col("start")), F.col("copies").cast("int") - 1)
    starts = F.when(F.col("copies") > 1, F.concat(F.array("start"), again)).otherwise(F.array("start"))
    none = F.array().cast("array<string>")
    heads = F.transform(starts, lambda start: F.struct(
        start.alias("line"), F.col("head").alias("piece"), none.alias("texts")))
    tail = F.struct(F.col("chunk_no").alias("line"), F.col("tail").alias("piece"), F.col("texts"))
    nothing = F.filter(heads, lambda _: F.lit(False))
    known = F.col("run_id").isNotNull() & F.col("chunk_no").isNotNull() & (F.col("head") != "")
    pieces = F.concat(F.when(known, heads).otherwise(nothing), F.when(F.col("ended"), F.array(tail)).otherwise(nothing))
    return placed.withColumn("start", opened).select("run_id", "chunk_no", F.inline_outer(pieces)).where("piece IS NOT NULL")


def cjk_lines_of_chunks(chunks: DataFrame) -> DataFrame:
    """The same as ``cjk_lines_of_bytes`` for pod logs cut into chunks anywhere, inside characters too.

    Each chunk is read by itself; the pieces of the lines that a cut went through meet, keyed by the
    chunk that a line starts in, and are put together in order. Chunks and lines move once each, by
    slices of a log; what comes before a slice is known from numbers alone: the last chunk with a line
    end, and how many texts there were. So a log of any length spreads over all tasks by its slices, a
    row holds a chunk, or a line with the texts before it. A null chunk is empty; ``chunk_no`` is unique
    within its run.
    """
    pieces = _lines_of_cuts(_cut_chunks(chunks)).withColumn("slice", F.shiftright("line", SLICE_BITS))
    cuts = F.array_sort(F.collect_list(F.when(F.col("piece") != "", F.struct("chunk_no", "piece"))))
    joined = F.array_join(F.transform(cuts, lambda p: p["piece"]), "")
    # The line that starts in a chunk comes after the lines that lie in it.
    lines = pieces.repartition("run_id", "slice").groupBy("run_id", "slice", "line").agg(
        F.collect_list(F.when(F.size("texts") > 0, F.col("texts"))).alias("of_chunk"), joined.alias("latin"),
        F.max(F.col("texts").isNull()).alias("broken"),
    ).select("run_id", "slice", "line", "broken", "of_chunk", cjk_texts(F.encode("latin", "ISO-8859-1")).alias("of_line"))
    found = lines.withColumn("inner", F.flatten("of_chunk")).withColumns({
        "n": F.size("inner") + F.coalesce(F.size("of_line"), F.lit(0)), "invalid": F.col("broken") | F.col("of_line").isNull(),
    })
    of_run = Window.partitionBy("run_id")
    by_slice, by_line = of_run.orderBy("slice"), Window.partitionBy("run_id", "slice").orderBy("line")
    so_far = (Window.unboundedPreceding, -1)
    slices = found.groupBy("run_id", "slice").agg(F.sum("n").alias("n"), F.max("invalid").alias("invalid")).select(
        "run_id", "slice", F.coalesce(F.sum("n").over(by_slice.rowsBetween(*so_far)), F.lit(0)).alias("before_slice"),
        F.max("invalid").over(of_run).alias("invalid_utf8"), (F.row_number().over(by_slice) == 1).alias("first_slice"),
    )
    placed = found.select(
        "run_id", "slice", "of_chunk", "inner", "of_line", (F.row_number().over(by_line) == 1).alias("first_line"),
        F.coalesce(F.sum("n").over(by_line.rowsBetween(*so_far)), F.lit(0)).alias("before"),
    )
    texts = F.transform(F.concat("inner", "of_line"), lambda text, at: F.struct(at.alias("at"), text.alias("cjk_text")))
    copies = F.size("of_chunk")
    again = F.flatten(F.array_repeat(F.slice(texts, F.lit(1), F.size("inner")), copies - 1))
    nothing = F.lit(None).cast("array<struct<at:int,cjk_text:string>>")
    # A full join keeps what has no run or no number, and leaves both sides' exchange the same, so that it runs once.
    texts_of_run = F.when(F.col("invalid_utf8"), nothing).otherwise(F.when(copies > 1, F.concat(texts, again)).otherwise(texts))
    marked = F.col("invalid_utf8") & F.col("first_slice") & F.coalesce("first_line", F.lit(True))
    rows = placed.join(slices.hint("merge"), ["run_id", "slice"], "full").select(
        "run_id", "before_slice", "before", "invalid_utf8", marked.alias("marked"), F.inline_outer(texts_of_run)
    ).where("marked OR NOT invalid_utf8 AND cjk_text IS NOT NULL")
    number = (F.col("before_slice") + F.col("before") + F.col("at")).cast("int")
    return rows.select("run_id", number.alias("text_no"), "cjk_text", "invalid_utf8")
