"""Mixing sources to target weights by weighted fair queueing.

Each source is a queue of its shuffled documents, once per repeat. A document's virtual finish
time is the words its source has sent up to its end, divided by the source's target. All
documents are ordered by that time over the whole corpus, and nothing but the total budget cuts this
one order: what comes before the cut is taken whole, the document that the cut goes through gives
its first words, what comes after gives none. So a source's words come within one document of its
target, and a source at its limit gives all its repeats.

Running sums never gather a source in one task. A source is split by the leading digits of its
shuffle tag, the global order by equal widths of finish time (which fair queueing fills evenly),
and only the sums of these slices meet in one window. There are about as many slices as a slice
has rows, the square root of all, so that both windows grow with the root only: of 10 billion
documents either orders some 100,000 rows.

The targets' windows run over the sources, a row each, in one task: they are few.

Defined results: a null or empty text has size 0 and takes nothing; null is a source of its own,
after all others; documents without id are shuffled by their text; documents of equal id (or text,
without one), source and size may swap places, which changes no result; very long texts are counted
whole and can only be cut at the budget; an empty table gives an empty mix. Further columns are only
carried, so none clashes.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from runtrail.llm.common import narrow, others, words_of, written


def source_targets(
    sized: DataFrame, weights: tuple[int, ...], share: float, repeats: int
) -> DataFrame:
    """Source, size and target: ``share`` of all words by weight, at most ``repeats`` times each.

    Sources at their limit leave the excess to the others: sorted by limit per weight, the level
    of the first source that is not filled is the words per weight that the rest gets.
    """
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weighed = sums.withColumn(
        "weight", F.element_at(F.array(*map(F.lit, weights)), (place - 1) % len(weights) + 1)
    ).withColumn("most", F.col("source_size") * repeats)
    by_ratio = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    filled = F.coalesce(F.sum("most").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    open_weight = F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing))
    everything = Window.partitionBy(F.lit(1))
    level = (F.sum("source_size").over(everything) * F.lit(share) - filled) / open_weight
    levels = weighed.withColumn("level", level)
    first = F.min_by("level", F.struct(F.col("most") / F.col("weight"), F.col("source").isNull(), "source"))
    at = levels.where(F.col("level") <= F.col("most") / F.col("weight")).agg(first).scalar()
    target = F.least(
        F.col("most").cast("double"),
        F.coalesce(at * F.col("weight"), F.col("most").cast("double")),
    )
    return levels.select("source", "source_size", target.alias("target"))


def running(frame: DataFrame, group: list[str], piece: str, order: list, size: str, name: str) -> DataFrame:
    """Words before each row within its group, added up slice by slice."""
    sums = frame.groupBy(*group, piece).agg(F.sum(size).alias("slice_size"))
    before = Window.partitionBy(*(group or [F.lit(1)])).orderBy(piece).rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(
        *[F.col(c).alias(f"of_{c}") for c in [*group, piece]],
        F.coalesce(F.sum("slice_size").over(before), F.lit(0)).alias("slice_start"),
    )
    same = F.lit(True)
    for c in [*group, piece]:
        same = same & F.col(c).eqNullSafe(F.col(f"of_{c}"))
    inside = Window.partitionBy(*group, piece).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    summed = frame.withColumn(name, F.sum(size).over(inside) - F.col(size))
    return summed.join(starts, same).withColumn(name, F.col(name) + F.col("slice_start")).select(
        *frame.columns, name
    )


def schedule(
    sized: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, repeats: int = 2
) -> tuple[DataFrame, DataFrame]:
    """The mix of rows (``row``, ``source``, ``size``, ``tag``), and the sources' targets.

    The mix has one row per document and repeat that is in it: ``row``, ``copy`` (from 0),
    ``taken`` (its first words) and ``start`` (words of the mix before it).
    """
    targets = written(source_targets(sized, weights, share, repeats), "mix-targets")
    slices = math.isqrt(sized.count()) + 1
    digits = 1
    while 16**digits < slices:
        digits += 1
    queued = running(
        sized.withColumn("slice", F.substring("tag", 1, digits)), ["source"], "slice",
        [F.col("tag"), F.col("size"), F.col("row")], "size", "words_before",
    )
    t = targets.withColumnRenamed("source", "of_source")
    copies = queued.join(t, F.col("source").eqNullSafe(F.col("of_source"))).withColumn(
        "copy", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1)))
    ).withColumn("words_before", F.col("words_before") + F.col("copy") * F.col("source_size"))
    finishing = copies.where("size > 0").withColumn(
        "finish", (F.col("words_before") + F.col("size")) / F.col("target")
    )
    ordered = running(
        finishing.withColumn("at", F.floor(F.col("finish") * slices)), [], "at",
        [F.col("finish"), F.col("source").asc_nulls_last(), F.col("tag"), F.col("size"), F.col("copy"), F.col("row")],
        "size", "start",
    )
    # Rounded, so that the order in which the targets are added up does not matter.
    budget = targets.agg(F.floor(F.round(F.sum("target"), 6))).scalar()
    taken = F.least(F.col("size"), budget - F.col("start"))
    return ordered.withColumn("taken", taken).where("taken > 0").select("row", "copy", "taken", "start"), targets


def sized_rows(docs: DataFrame, source_col: str, seed: str) -> DataFrame:
    """A number for each row, and what queueing needs of it."""
    return docs.select(
        "row", "doc_id", F.col(source_col).alias("source"),
        F.size(words_of(F.col("text"))).cast("long").alias("size"),
        F.md5(F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.md5(F.coalesce("text", F.lit("")))))).alias("tag"),
    )


def mix_sizes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, repeats: int = 2, seed: str = "mix:",
) -> DataFrame:
    """Per document: ``doc_id``, ``source``, ``size``, ``source_size``, ``target``, ``taken``."""
    plain = docs.select(
        docs[id_col].alias("doc_id"), docs[text_col].alias("text"), docs[source_col].alias("source"),
        F.monotonically_increasing_id().alias("row"),
    )
    sized = written(sized_rows(plain, "source", seed), "mix-sizes")
    mix, targets = schedule(sized, weights, share, repeats)
    taken = mix.groupBy(F.col("row").alias("mix_row")).agg(F.sum("taken").alias("taken"))
    t = targets.withColumnRenamed("source", "of_source")
    joined = sized.join(taken, sized["row"] == taken["mix_row"], "left")
    return joined.join(t, F.col("source").eqNullSafe(F.col("of_source"))).select(
        "doc_id", "source", "size", "source_size", "target",
        F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
    )


def mix_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, repeats: int = 2, seed: str = "mix:",
) -> DataFrame:
    """The mix itself: the columns of ``docs`` once per repeat, with ``mix_copy``, ``mix_taken``
    and ``mix_start`` (order by it). A text that is cut keeps its first words, joined by a space.
    """
    rest = others(docs, id_col, text_col)
    numbered = written(
        narrow(docs, id_col, text_col, rest).withColumn("row", F.monotonically_increasing_id()), "mix-documents"
    )
    sized = written(sized_rows(numbered, f"rest.{source_col}", seed), "mix-sizes")
    mix, _ = schedule(sized, weights, share, repeats)
    joined = numbered.join(mix, "row")
    words = words_of(F.col("text"))
    text = F.when(F.size(words) <= F.col("taken"), F.col("text")).otherwise(
        F.array_join(F.slice(words, 1, F.col("taken").cast("int")), " ")
    )
    own = {id_col: F.col("doc_id"), text_col: text}
    columns = [(own[c] if c in own else F.col("rest").getField(c)).alias(c) for c in docs.columns]
    return joined.select(
        *columns, F.col("copy").alias("mix_copy"), F.col("taken").alias("mix_taken"),
        F.col("start").alias("mix_start"),
    )
