"""One query per operator of this folder, over the shared tables."""

from __future__ import annotations

import hashlib
from functools import lru_cache

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tableloom.functions.columns import column
from tableloom.llm.byte_cnn import classify, fit, held_out
from tableloom.llm.chunks import chunk_tokens, containment, rendered
from tableloom.llm.fertility import fertility
from tableloom.llm.impact_index import top_products
from tableloom.llm.licenses import scan_licenses
from tableloom.llm.mixing import mix, source_table
from tableloom.llm.neighbours import map_with_next
from tableloom.llm.norm_buckets import rank_documents
from tableloom.llm.packing import pack
from tableloom.llm.search_oracles import CONVERSATION_TRIE, RANKED_LEXICAL, TOP_PRODUCTS
from tableloom.llm.tables import load, texts, word_count
from tableloom.llm.token_files import read_checksums, write_tokens
from tableloom.llm.transcripts import parse_transcripts
from tableloom.llm.turn_trie import conversation_trie
from tableloom.llm.url_rules import HostRule, filter_urls
from tableloom.llm.weighted_minhash import class_rows, near_duplicates
from tableloom.session import scratch_path

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORD_PIECES = public_tokenizers.path("word_bpe_49k.json")
END_ID = 1

HOST_RULES = (
    HostRule("allow", "com"),
    HostRule("block", "example.com", "/en/"),
    HostRule("allow", "www.example.com", "/en/"),
    HostRule("block", "net", "/es/"),
    HostRule("block", "net", "/fr/"),
)


def chat_format(spark: SparkSession, folder: str) -> DataFrame:
    return parse_transcripts(load(spark, folder, "conversations"))


def quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return fertility(load(spark, folder, "documents"), PIECES)


def quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = load(spark, folder, "documents")
    network = fit(docs, load(spark, folder, "labels"))
    scored = classify(docs, network)
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")


def mixing_rows(docs: DataFrame, carried: Column) -> DataFrame:
    """What mixing reads of documents, next to a carried column."""
    text, source = column("text"), column("source")
    return docs.select(
        carried,
        word_count(text).alias("_size"),
        F.array(source).alias("_sources"),
        F.xxhash64(column("doc_id"), F.coalesce(text, F.lit(""))).alias("_id"),
    )


def mixed_documents(docs: DataFrame) -> DataFrame:
    """Rows of documents as often as the mixture takes them."""
    taken, _ = mix(mixing_rows(docs, F.struct(*docs.columns).alias("_doc")))
    often = taken.where("copies > 0").select(
        "_doc", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))
    )
    return often.select("_doc.*")


def packed_documents(docs: DataFrame) -> DataFrame:
    """Documents packed by words; equal texts with words are a cluster."""
    rows = texts(docs, "doc_id", "text", "source")
    return pack(
        rows.select(
            "doc_id",
            word_count(F.col("text")).alias("_size"),
            F.col("source").alias("_source"),
            F.when(word_count(F.col("text")) > 0, F.md5("text")).alias("_cluster"),
        )
    )


def mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = load(spark, folder, "documents")
    taken, plan = mix(mixing_rows(docs, column("doc_id").alias("doc_id")))
    return taken.join(source_table(plan), "_pattern").select(
        "doc_id",
        F.col("_size").alias("size"),
        "source_size",
        "target",
        (F.col("copies") * F.col("_size")).alias("taken"),
    )


def packing(spark: SparkSession, folder: str) -> DataFrame:
    return packed_documents(load(spark, folder, "documents"))


def near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return class_rows(near_duplicates(load(spark, folder, "documents")))


def url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return filter_urls(load(spark, folder, "pages"), "page_id", "url", HOST_RULES)


recent_tokens = lru_cache(maxsize=2)(chunk_tokens)


def compare_with_edit(text: str, following: str) -> tuple:
    """Fingerprints of a text and of the text with its second half exchanged."""
    half = len(text) // 2
    edited = text[: len(text) - half] + following[:half]
    own, other = recent_tokens(text), recent_tokens(following)
    changed = chunk_tokens(edited)
    return (
        len(text),
        hashlib.sha256(edited.encode("utf-8")).hexdigest(),
        rendered(own),
        rendered(changed),
        containment(own, changed),
        containment(own, other),
    )


def fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    names = [
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        "near_edited",
        "near_next",
    ]
    schema = (
        "n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double"
    )
    return map_with_next(load(spark, folder, "documents"), compare_with_edit, names, schema)


def license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return scan_licenses(load(spark, folder, "documents"))


def token_files(spark: SparkSession, folder: str) -> DataFrame:
    files = scratch_path(spark, "tokens")
    write_tokens(load(spark, folder, "documents"), WORD_PIECES, END_ID, files)
    return read_checksums(spark, files)


def top_vectors(spark: SparkSession, folder: str) -> DataFrame:
    asked = F.col("vec") % 50 == 0
    return top_products(load(spark, folder, "embeddings"), "vec_id", "embedding", asked, 5)


def trie(spark: SparkSession, folder: str) -> DataFrame:
    return conversation_trie(load(spark, folder, "conversations"))


def lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return rank_documents(load(spark, folder, "documents"), load(spark, folder, "benchmark"), 10)


QUERIES = {
    "op1_chat_format": chat_format,
    "op2_quality_rules": quality_rules,
    "op3_quality_classifier": quality_classifier,
    "op4_mixing": mixing,
    "op5_packing": packing,
    "op6_url_filter": url_filter,
    "op7_fingerprints": fingerprints,
    "op8_near_dedup": near_dedup,
    "op9_license_scan": license_scan,
    "op10_token_files": token_files,
    "op11_top_products": top_vectors,
    "op12_conversation_trie": trie,
    "op13_lexical_search": lexical_search,
}

ORACLES: dict[str, str] = {
    "op11_top_products": TOP_PRODUCTS,
    "op12_conversation_trie": CONVERSATION_TRIE,
    "op13_lexical_search": RANKED_LEXICAL,
}
