"""Line dedup: lines that several documents share stay in the first document only.

Lines are exploded and hashed, once, and the hashes written; each hash counts its distinct
documents; the lines of hashes over the threshold are dropped and each text is put together again by
position. Only hashes, ids and positions are shuffled by line; a text moves once, to meet the
positions it loses. Hot lines are counted in every task before the shuffle. Lines with more than a
``HOT``-th of all rows are ``HOT`` at most: their answers are broadcast and meet their rows where
these are, so no task gets all rows of one line. The other lines' rows meet their answers by a join.

Defined results: a null or empty text is one empty line. Documents without id count as one
document that comes after all others. Rows that repeat id and text lose the same lines. Texts of
any number of lines are put together in time in proportion to it, but for one sort. An empty table
gives an empty table. Further columns are only carried, under ``rest``, so none clashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from runtrail.llm.common import BLANKS, ascii_lower, narrow, written

#: Lines that may be broadcast, each with at least this share of all rows.
HOT = 4096


def _lines(text):
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_rows(docs: DataFrame, min_chars: int) -> DataFrame:
    """One row per line that is long enough: document, position and 128 bits of its key."""
    # Hashed below the explode: beside it, the whole text would be hashed once for each of its lines.
    hashed = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), _lines(ascii_lower(F.col("text"))).alias("lines"))
    exploded = hashed.select("doc_id", "text_hash", F.posexplode("lines").alias("position", "line"))
    keyed = exploded.withColumn("line", F.btrim("line", F.lit(BLANKS)))
    return keyed.where(F.length("line") >= min_chars).select(
        "doc_id", "text_hash", "position",
        F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"),
    )


def repeated_lines(rows: DataFrame, min_docs: int) -> DataFrame:
    """Hashes found in at least ``min_docs`` documents, the smallest id that holds each, and its rows."""
    counts = rows.groupBy("h1", "h2").agg(
        F.count("*").alias("n_rows"),
        F.countDistinct("doc_id").alias("n_docs"),
        F.max(F.col("doc_id").isNull().cast("int")).alias("nameless"),
        F.min("doc_id").alias("first_doc"),
    )
    return counts.where(F.col("n_docs") + F.col("nameless") >= min_docs).select(
        "h1", "h2", "first_doc", "n_rows"
    )


def lost_lines(rows: DataFrame, repeated: DataFrame) -> DataFrame:
    """The rows of repeated lines that are not in the first document that holds them."""
    total = F.greatest(F.lit(1), rows.agg(F.count("*").alias("n")).scalar())
    is_hot = F.col("n_rows") * HOT > total
    hot = F.broadcast(repeated.where(is_hot).drop("n_rows"))
    cold = repeated.where(~is_hot).drop("n_rows")
    key = ["h1", "h2"]
    of_cold = rows.join(hot.select(*key), key, "left_anti").join(cold, key)
    return rows.join(hot, key).unionByName(of_cold).where(
        F.col("first_doc").isNotNull() & (F.col("doc_id").isNull() | (F.col("doc_id") > F.col("first_doc")))
    )


def kept_lines(lines: Column, lost: Column) -> Column:
    """The lines, joined again, without those at the ``lost`` positions.

    A mark for each lost position is sorted ahead of its line, so that every line only looks at
    what stands before it.
    """
    own = F.transform(lines, lambda line, at: F.struct(at.alias("at"), F.lit(1).alias("is_line"), line.alias("line")))
    marks = F.transform(lost, lambda at: F.struct(at.alias("at"), F.lit(0).alias("is_line"), F.lit("").alias("line")))

    def kept(row: Column, j: Column, rows: Column) -> Column:
        before = F.get(rows, j - 1)
        marked = (before["at"] == row["at"]) & (before["is_line"] == 0)
        return (row["is_line"] == 1) & ~F.coalesce(marked, F.lit(False))

    def joined(rows: Column) -> Column:
        stay = F.filter(rows, lambda row, j: kept(row, j, rows))
        return F.array_join(F.transform(stay, lambda row: row["line"]), "\n")

    # The sort is done once, inside the transform of a list of one.
    return F.get(F.transform(F.array(F.sort_array(F.concat(own, marks))), joined), F.lit(0))


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10,
    min_docs: int = 2, carry: tuple[str, ...] = (),
) -> DataFrame:
    """One row per document: ``doc_id``, ``text`` without the dropped lines, ``n_lines`` before
    dropping, ``n_dropped``, and the carried columns in ``rest``.
    """
    docs = narrow(docs, id_col, text_col, carry)
    rows = written(line_rows(docs, min_chars), "line-hashes")
    lost = lost_lines(rows, written(repeated_lines(rows, min_docs), "repeated-lines"))
    lost = lost.groupBy("doc_id", "text_hash").agg(F.collect_set("position").alias("lost")).select(
        F.col("doc_id").alias("lost_id"), F.col("text_hash").alias("lost_hash"), "lost"
    )
    keyed = docs.withColumn("text_hash", F.xxhash64("text"))
    joined = keyed.join(
        lost, keyed.doc_id.eqNullSafe(lost.lost_id) & (keyed.text_hash == lost.lost_hash), "left"
    )
    lines = _lines(F.col("text"))
    return joined.select(
        "doc_id",
        F.when(F.col("lost").isNull(), F.col("text")).otherwise(kept_lines(lines, F.col("lost"))).alias("text"),
        F.size(lines).cast("long").alias("n_lines"),
        F.coalesce(F.size("lost"), F.lit(0)).cast("long").alias("n_dropped"),
        *(["rest"] if carry else []),
    )
