"""The registered queries of the corpus operators, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from public_tokenizers import path
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from phrasetide.llm import (
    alignment, bpe, exact_dedup, language, line_dedup, merkle, minhash, packing, resampling,
    sharding, substring, token_files, warc,
)
from phrasetide.llm.common import ship_code, table
from phrasetide.llm.oracle import SQL as ORACLES
from phrasetide.session import new_work_dir

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = dict(ORACLES)

SHARDS = 8


def register(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(ship_code(spark), sf_dir)

    run.__name__, run.__doc__ = query.__name__, query.__doc__
    QUERIES[query.__name__] = run
    return run


@register
def op2_virtual_slots(spark, sf):
    """All documents in eight shards of near equal bytes, by a rebalanced slot map."""
    docs = table(spark, sf, "documents")
    path = new_work_dir(spark, "slot-map")
    sizes = sharding.slot_bytes(docs)
    sharding.write_map(sharding.first_map(spark, SHARDS), path)
    sharding.write_map(sharding.rebalanced(sharding.read_map(spark, path), sizes, SHARDS), path)
    placed = sharding.place(docs, sharding.read_map(spark, path), sizes)
    text = F.col("record.text")
    return placed.select(
        F.col("record.doc_id").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("bigint").alias("size"),
        F.crc32(F.coalesce(text, F.lit(""))).alias("text_crc32"),
        F.lit("bytes").alias("law"), "shard", F.col("slot").cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot")


@register
def op8_mixture_language(spark, sf):
    """The main language of every document, by its mixture of languages."""
    made = language.identified(table(spark, sf, "documents"))
    return made.select("doc_id", "held_out", "lang_pred", "score", "mixture")


@register
def op9_quotient_filters(spark, sf):
    """For every document, which of its exact copies stays."""
    return exact_dedup.duplicate_groups(table(spark, sf, "documents"))


@register
def op3_arrow_sequences(spark, sf):
    """Ids of all documents written as Arrow sequence files and read back."""
    folder = new_work_dir(spark, "token-files")
    token_files.write_tokens(table(spark, sf, "documents"), folder, path("byte_bpe_50k.json"))
    made = token_files.read_documents(spark, folder)
    return made.select("doc_id", "start", F.expr("octet_length(ids) div 4").alias("n_tokens"),
                       F.crc32("ids").alias("ids_crc32"))


@register
def op4_window_packing(spark, sf):
    """All documents packed into sequences of 2,048 ids, cut by dynamic programming."""
    return packing.packed_pieces(table(spark, sf, "documents"), path("word_bpe_49k.json"))


@register
def op7_forced_boundaries(spark, sf):
    """All documents encoded in fragments and decoded again."""
    return bpe.round_trip(table(spark, sf, "documents"), path("byte_bpe_50k.json"))


@register
def op1_merkle_tree(spark, sf):
    """Merkle fingerprints of all documents and of their half edited texts."""
    return merkle.half_edits(table(spark, sf, "documents"))


@register
def op10_bbit_minhash(spark, sf):
    """The near-duplicate component of every document."""
    return minhash.near_duplicates(table(spark, sf, "documents"))


@register
def op6_chunked_records(spark, sf):
    """All pages written as archives by chunks, and read back."""
    folder = new_work_dir(spark, "archives")
    pages = warc.with_references(table(spark, sf, "pages"))
    warc.write_archives(warc.chunked(pages), folder)
    made = warc.read_records(spark, folder)
    return made.select(F.col("record_id").alias("page_id"), "payload_bytes", "payload_digest",
                       "record_type", "refers_to")


@register
def op5_similar_lines(spark, sf):
    """All documents without lines similar to an earlier line."""
    made = line_dedup.without_repeated_lines(table(spark, sf, "documents"))
    return made.select("doc_id", "n_lines", "n_removed",
                       F.sha2("text", 256).alias("text_sha256"))


@register
def op13_window_repeats(spark, sf):
    """All documents without passages of 13 words that an earlier document has."""
    made = substring.without_repeats(table(spark, sf, "documents"))
    return made.select("doc_id", "n_words", "n_removed",
                       F.sha2("text", 256).alias("kept_sha256"))


@register
def op12_threshold_resampling(spark, sf):
    """All documents scored by likeness to the benchmark texts, a tenth of them drawn."""
    made = resampling.resampled(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return made.select("doc_id", "n_features", "weight", "score", "rank")


@register
def op11_distinct_alignment(spark, sf):
    """The tokens of two vocabularies aligned in every document."""
    made = alignment.aligned(table(spark, sf, "documents"), path("byte_bpe_50k.json"),
                             path("piece_bpe_32k.model"))
    return made.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                       "groups_sha256")
