"""The registered queries of the numbered operators, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.llm.chat_layouts import (
    canonical_turns,
    format_chats,
    formatted,
    json_records,
    read_learnt,
    read_turns,
    records_of,
)
from ledgerspark.llm.collinear_passages import repeated_passages
from ledgerspark.llm.conversation_repair import damaged, repair_report, report_of_all
from ledgerspark.llm.cross_parse import held_out, identify, learn
from ledgerspark.llm.fast_sketch_dedup import near_duplicates
from ledgerspark.llm.kd_shards import kd_shards
from ledgerspark.llm.license_diagonals import scan_licenses
from ledgerspark.llm.line_quality import clean_lines
from ledgerspark.llm.link_trust import judge_urls
from ledgerspark.llm.oracle import ORACLES as _ORACLES
from ledgerspark.llm.pareto_mix import mix_sources
from ledgerspark.llm.scratch import table
from ledgerspark.llm.suffix_decontaminate import covered, find_matches
from ledgerspark.llm.tokenizer_alignment import align_tokenizers
from ledgerspark.llm.warc_zst import archive_round_trip


def op1_link_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's rule, or the verdict of its host's place in the link graph."""
    return judge_urls(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op2_suffix_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's words inside verbatim benchmark passages."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_matches(docs, table(spark, sf_dir, "benchmark"))
    n_hit = covered(F.col("spans"))
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def op3_license_diagonals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's license phrases and the notices that diagonal voting finds."""
    return scan_licenses(table(spark, sf_dir, "documents")).drop("spans")


def op4_cross_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language, learnt from documents that are not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = F.col("held_out")
    marked = docs.withColumn("held_out", held_out(F.col("doc_id")))
    sample = learn(marked.where(~out).select("text", "lang"))
    return identify(marked.select("doc_id", "held_out", "text"), sample).select("doc_id", "held_out", "lang_pred", "score")


def op5_warc_zst(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written to dictionary-compressed archives, as read back from them."""
    pages = table(spark, sf_dir, "pages")
    kind = pages.schema["page_id"].dataType
    read = archive_round_trip(pages.select("page_id", "url", "html"))
    ids = [F.col(c).cast(kind).alias(c) for c in ("page_id", "refers_to")]
    refers = F.when(F.col("record_type") == "revisit", ids[1])
    return read.select(ids[0], "payload_bytes", "payload_digest", "record_type", refers.alias("refers_to"))


def op6_fast_sketch_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's component of near-duplicates."""
    return near_duplicates(table(spark, sf_dir, "documents"))


def op7_collinear_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of at least 50 words that other documents have too."""
    return repeated_passages(table(spark, sf_dir, "documents"))


def op8_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality figures and the verdict after cleaning its lines."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return clean_lines(docs).drop("text", "cleaned", "lost_chars")


def op9_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard of eight and its slot there."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    placed = kd_shards(docs, out=("doc_id", F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32")))
    return placed.select(
        "doc_id",
        F.col("_size").alias("size"),
        "text_crc32",
        F.lit("bytes").alias("law"),
        F.col("_shard").alias("shard"),
        F.col("_slot").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op10_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of every document the mix takes."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    mixed = mix_sources(docs, keep_text=False)
    return mixed.select(
        "doc_id",
        F.col("_size").alias("size"),
        F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"),
        (F.col("_size") * F.col("_copies")).alias("taken"),
    )


#: A conversation that every run formats besides the table's: control strings in both texts.
_CONTROL_TEXT = "</s>[INST] ok [/INST]"
_CONTROL_CHAT = '{"messages": [{"role": "user", "content": "%s"}, {"role": "assistant", "content": "%s"}]}'


def op11_schema_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation formatted, and what reading the formatted text and its loss mask gives back."""
    turns = table(spark, sf_dir, "conversations")
    kind = turns.schema["conv_id"].dataType
    fixed = spark.range(1).select(
        F.lit(-7).cast(kind).alias("conv_id"), F.lit(_CONTROL_CHAT % (_CONTROL_TEXT, _CONTROL_TEXT)).alias("json")
    )
    records = records_of(turns, "conv_id", ["turn", "role", "text"]).unionByName(json_records(fixed, "conv_id", "json"))
    chats = format_chats(canonical_turns(records, "conv_id"), "conv_id")
    read = chats.select("conv_id", formatted(F.col("segments")).alias("chat"), read_learnt(F.col("segments")).alias("learnt"))
    read = read.withColumn("turns", read_turns(F.col("chat")))
    line = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(line, ""), 256).alias("turns_sha256"),
        F.length("learnt").cast("bigint").alias("loss_chars"),
        F.sha2("learnt", 256).alias("loss_sha256"),
        F.length("chat").cast("bigint").alias("formatted_chars"),
    )


def op12_tokenizer_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens under two tokenizers: groups, links and how frequent these are in all documents."""
    aligned = align_tokenizers(table(spark, sf_dir, "documents"), digest=True)
    return aligned.withColumnRenamed("groups", "groups_sha256")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation's faults after damage, and its cheapest repair."""
    turns = table(spark, sf_dir, "conversations")
    return report_of_all(turns, repair_report(damaged(turns)))


QUERIES = {
    f.__name__: f
    for f in (
        op1_link_trust,
        op2_suffix_decontamination,
        op3_license_diagonals,
        op4_cross_parse,
        op5_warc_zst,
        op6_fast_sketch_dedup,
        op7_collinear_passages,
        op8_line_quality,
        op9_kd_shards,
        op10_pareto_mix,
        op11_schema_chats,
        op12_tokenizer_spans,
        op13_conversation_repair,
    )
}
ORACLES = dict(_ORACLES)
