"""One query for each operator, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketry.llm.bpe import encode
from ticketry.llm.common import doc_id, documents
from ticketry.llm.html_text import extract_text
from ticketry.llm.licenses import scan_licenses
from ticketry.llm.mixing import mix
from ticketry.llm.packing import pack
from ticketry.llm.prefix_trie import prefix_trie, sequences, with_openings
from ticketry.llm.quality_rules import BASE, judge
from ticketry.llm.sharding import shard
from ticketry.llm.simhash import near_duplicates
from ticketry.llm.spelling import spelling_variants, vocabulary
from ticketry.llm.substring_dedup import substring_dedup
from ticketry.llm.suffix_dedup import suffix_dedup
from ticketry.llm.topk import top_k


def op1_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return top_k(vectors, F.col("vec_id") % 100 == 0, k=10, scale=1024)


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(documents(spark, sf_dir).select("doc_id", "text"), 3, 3)
    return found.select(
        doc_id(), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"))


def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup(documents(spark, sf_dir).select("doc_id", "text"), 400)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return found.select(
        doc_id(), "n_bytes", removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )


def op5_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = encode(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select(
        doc_id(), (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op6_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_licenses(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select(doc_id(), *[c for c in found.columns if not c.startswith("__")])


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir).select("doc_id", "text"), capacity=4096)


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup(documents(spark, sf_dir).select("doc_id", "text"), 50, layout=False)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return found.select(
        doc_id(), "n_words", removed.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256")
    )


def op9_weighted_tree_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(documents(spark, sf_dir).select("doc_id", "text"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = documents(spark, sf_dir).select("doc_id", "text", "lang", "source")
    found = judge(rows, columns=["doc_id"])
    return found.select(
        "doc_id", *[F.col(f"__m.{c}").alias(c) for c in BASE],
        F.col("__base_failed").alias("base_failed"), F.col("__kept").alias("kept"),
    )


def op11_curriculum_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(documents(spark, sf_dir).select("doc_id", "text", "source"))
    taken = F.aggregate("copies", F.lit(0).cast("long"), lambda a, c: a + c["words"])
    first = F.array_min(F.transform("copies", lambda c: c["position"]))
    return mixed.select(
        "doc_id", "size", "source_size", "target", taken.alias("taken"), first.alias("first_position")
    ).orderBy(F.asc_nulls_last("first_position"), "doc_id")


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    return prefix_trie(with_openings(sequences(turns), every=100, most=5))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(vocabulary(documents(spark, sf_dir).select("doc_id", "text")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_topk_search, op2_simhash_near_dedup, op3_html_extraction, op4_suffix_array_dedup, op5_bpe_codec,
        op6_license_scans, op7_best_fit_packing, op8_substring_dedup, op9_weighted_tree_sharding, op10_quality_rules,
        op11_curriculum_mixing, op12_conversation_trie, op13_spelling_variants,
    )
}
