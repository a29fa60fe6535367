"""From raw documents to a training mix, stage by stage.

Each stage gets what its predecessor kept, written as Parquet, and works on all of it. All but the
last return the columns of ``documents``; where a stage changes a text, ``n_chars`` follows.
Intermediate tables go to the shared folder of the session.

1. language ID: rejects texts in none of the languages of the labelled ones: null ones, those without
   a letter, and those of 40 letters and more that need more pieces per symbol than the limit
   calibrated on labelled texts. Without any labelled text it rejects nothing; with too few texts to
   calibrate on there is no limit.
2. line dedup: drops the lines that an earlier document holds.
3. near dedup: keeps of each group of SimHash neighbours one document, of the smallest id.
4. decontamination: cuts benchmark passages out of the texts; a document that has no other words
   goes.
5. mixing: repeats and truncates sources to their target weights.

Null ids, texts and sources pass through every stage; an empty table gives an empty table. What a
stage writes for itself, and its predecessor's result, go once its own result is written.
"""

from __future__ import annotations

import os
import sys
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import Column, DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from runtrail.llm.common import (  # noqa: E402
    delete_folder,
    others,
    restored,
    shared_folder,
    temporary_tables,
)
from runtrail.llm.decontaminate import find_contamination  # noqa: E402
from runtrail.llm.language import (  # noqa: E402
    held_out,
    learn_languages,
    predict_languages,
    rejection_limit,
)
from runtrail.llm.lines import dedup_lines  # noqa: E402
from runtrail.llm.mixing import mix_documents  # noqa: E402
from runtrail.llm.simhash import first_of_groups  # noqa: E402

#: Texts with fewer letters are too short to be told from those in no language.
LEAST_LETTERS = 40


def _columns(found: DataFrame, docs: DataFrame, changed: Column | None = None) -> DataFrame:
    """The columns of ``docs``; ``n_chars`` counts anew where the text has changed."""
    out = found.select(
        *restored(found, docs.columns, "doc_id", "text"),
        *([] if changed is None else [changed.alias("text_has_changed")]),
    )
    if changed is None:
        return out
    columns = [out[c] for c in docs.columns]
    if "n_chars" in docs.columns:
        at = docs.columns.index("n_chars")
        counted = F.when(out["text_has_changed"], F.length(out["text"])).otherwise(out["n_chars"])
        columns[at] = counted.cast(docs.schema["n_chars"].dataType).alias("n_chars")
    return out.select(*columns)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labelled = docs.where(~held_out(docs["doc_id"]))
    parser = learn_languages(labelled)
    if not parser.languages:
        return docs
    limit = rejection_limit(labelled, parser, least_letters=LEAST_LETTERS)
    found = predict_languages(docs, parser, carry=others(docs, "doc_id", "text"))
    kept = F.col("lang_pred") != "und"
    if limit is not None:
        kept = kept & ((F.col("letters") < LEAST_LETTERS) | (F.col("pieces_per_symbol") <= limit))
    return _columns(found.where(kept), docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = dedup_lines(docs, carry=others(docs, "doc_id", "text"))
    return _columns(found, docs, F.col("n_dropped") > 0)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return first_of_groups(docs, width=3, distance=3)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = find_contamination(docs, benchmark, cut=True, carry=others(docs, "doc_id", "text"))
    kept = found.where((F.col("n_hit") == 0) | (F.col("n_hit") < F.col("n_words")))
    return _columns(kept, docs, F.col("n_hit") > 0)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Also ``mix_copy``, ``mix_taken`` and ``mix_start``, the order of the mix."""
    return mix_documents(docs)


STAGES = [
    ("language ID", language_id),
    ("line dedup", line_dedup),
    ("near dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
]

#: SQL expresses neither the parse by automata nor connected components.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for number, (_, stage) in enumerate(STAGES):
        with temporary_tables(spark):
            stage(spark, docs, sf_dir).write.parquet(path := f"{folder}/{number}")
        docs = spark.read.parquet(path)
        if number:
            delete_folder(spark, f"{folder}/{number - 1}")
    return docs
