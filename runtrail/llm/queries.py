"""The named queries of the subpackage, with production parameters, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from runtrail.llm import language, toxicity
from runtrail.llm.bpe import Vocabulary, decode_ids, encode_texts
from runtrail.llm.common import words_of
from runtrail.llm.decontaminate import find_contamination
from runtrail.llm.language import learn_languages, predict_languages
from runtrail.llm.lines import dedup_lines
from runtrail.llm.mixing import mix_sizes
from runtrail.llm.quality import judge_quality
from runtrail.llm.simhash import near_duplicates
from runtrail.llm.substrings import find_repeats
from runtrail.llm.toxicity import learn_toxicity, score_toxicity
from runtrail.llm.trie import ordered_turns, prefix_trie, rebuilt_turns
from runtrail.llm.urls import Rule, filter_urls
from runtrail.llm.warc import read_records, write_archives
from runtrail.llm.whitening import whiten

URL_RULES = [
    Rule("net", "/", "block"),
    Rule("example.net", "/en/", "allow"),
    Rule("example.com", "/de/", "block"),
    Rule("org", "/fr/", "allow"),
]
#: A page reached by a tracking parameter puts its host and path on the block list.
TRACKED = "url RLIKE '[?&]utm_'"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_repeats(_table(spark, sf_dir, "documents"), width=35)
    return found.select(
        "doc_id", "n_words", "n_removed", F.sha2(F.array_join(words_of(F.col("text")), " "), 256).alias("kept_sha256")
    )


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    parser = learn_languages(docs.where(~language.held_out(F.col("doc_id"))))
    return predict_languages(docs, parser).select(
        "doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "pieces_per_symbol"
    )


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"), width=3, distance=3)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_quality(_table(spark, sf_dir, "documents"), reported=True).drop("text", "rejected_by")


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    kind = pages.schema["page_id"].dataType
    return read_records(write_archives(pages)).select(
        F.col("page_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"),
    )


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(_table(spark, sf_dir, "pages"), URL_RULES, F.coalesce(F.expr(TRACKED), F.lit(False)))


def op8_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sizes(_table(spark, sf_dir, "documents")).drop("source")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    model = learn_toxicity(docs, labels.where(~toxicity.held_out(F.col("doc_id"))))
    return score_toxicity(docs, model).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    deduped = dedup_lines(_table(spark, sf_dir, "documents"))
    return deduped.select(
        "doc_id", "n_lines", "n_dropped",
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"),
    )


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = ordered_turns(_table(spark, sf_dir, "conversations"))
    conv = F.col("conv")
    head = F.crc32(conv.cast("string").cast("binary")) % 6
    return prefix_trie(*rebuilt_turns(turns, base=conv - conv % 100, head=head, most_head=5))


def op12_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    vocabulary = Vocabulary(public_tokenizers.path("word_bpe_49k.json"))
    encoded = encode_texts(_table(spark, sf_dir, "documents"), vocabulary)
    decimals = F.array_join(F.transform("ids", lambda i: i.cast("string")), " ")
    return decode_ids(encoded, vocabulary).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(decimals, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(_table(spark, sf_dir, "embeddings"), k=16)


QUERIES = {
    "op1_decontaminate": op1_decontaminate,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_language": op3_language,
    "op4_near_dedup": op4_near_dedup,
    "op5_quality": op5_quality,
    "op6_warc": op6_warc,
    "op7_url_filter": op7_url_filter,
    "op8_mix": op8_mix,
    "op9_toxicity": op9_toxicity,
    "op10_line_dedup": op10_line_dedup,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_bpe": op12_bpe,
    "op13_whitening": op13_whitening,
}
