"""The operators over the whole test tables, as registered queries."""

from __future__ import annotations

import importlib.util
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import backoff_model, conversation_repair, decontaminate, html_blocks, license_rules, line_quality, ngram_join, order_minhash, piece_lattice, prefix_trie, pseudonyms, sentence_spans, suffix_dedup

#: The key of the pseudonyms in these queries; in use it is the caller's secret.
KEY = b"a key for the test tables only"


def model_file() -> str:
    """The installed public vocabulary."""
    found = importlib.util.find_spec("public_tokenizers")
    home = Path(found.origin).parent if found else Path("/opt/tokenizers")
    return str(home / "piece_bpe_32k.model")


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.joined(_table(spark, folder, "documents"))


def op2_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    rows = suffix_dedup.without_repeats(_table(spark, folder, "documents").select("doc_id", "text"))
    # A cut may fall inside a character; its bytes are shown as U+FFFD here, the hash is that of the bytes.
    text = F.make_valid_utf8(F.col("kept").cast("string")).alias("text")
    return rows.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", text)


def op3_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.automata(_table(spark, folder, "benchmark"))
    rows = decontaminate.contaminated(_table(spark, folder, "documents"), found, passed=["doc_id"])
    return rows.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op4_pseudonyms(spark: SparkSession, folder: str) -> DataFrame:
    rows = pseudonyms.pseudonymised(_table(spark, folder, "documents"), KEY, passed=["doc_id"])
    return rows.select("doc_id", "text", "n_private", F.col("private.kind").alias("kinds"))


def op5_order_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return order_minhash.fingerprinted(_table(spark, folder, "documents"))


def op6_line_quality(spark: SparkSession, folder: str) -> DataFrame:
    documents, labels = _table(spark, folder, "documents"), _table(spark, folder, "labels")
    model = line_quality.learn(documents, labels.where(~line_quality.held_out()))
    rows = line_quality.scored(documents, model, passed=["doc_id"])
    return rows.select("doc_id", line_quality.held_out().alias("held_out"), "score", "predicted")


def op7_html_blocks(spark: SparkSession, folder: str) -> DataFrame:
    rows = html_blocks.extracted(_table(spark, folder, "pages"), passed=["page_id", "url"])
    return rows.select("page_id", "url", "text", "n_chars")


def op8_sentence_spans(spark: SparkSession, folder: str) -> DataFrame:
    rows = sentence_spans.without_repeats(_table(spark, folder, "documents").select("doc_id", "text"))
    return rows.select("doc_id", "n_sentences", "n_removed", "text")


def op9_license_rules(spark: SparkSession, folder: str) -> DataFrame:
    rows = license_rules.scanned(_table(spark, folder, "documents").select("doc_id", "text"))
    return rows.select(
        "doc_id",
        F.size("sentence_ids").cast("long").alias("n_known"),
        F.concat_ws(",", "sentence_ids").alias("sentence_ids"),
        F.concat_ws(",", "licenses").alias("licenses"),
    )


def op10_piece_lattice(spark: SparkSession, folder: str) -> DataFrame:
    rows = piece_lattice.encoded(_table(spark, folder, "documents"), model_file(), with_ids=False, passed=["doc_id", "n_chars"])
    return rows.select("doc_id", "n_pieces", "best_score", "scores", "n_best", "ids_sha256", "alternatives_sha256", "decoded_sha256")


def op11_backoff_automaton(spark: SparkSession, folder: str) -> DataFrame:
    documents = _table(spark, folder, "documents")
    rows = backoff_model.scored(documents, backoff_model.trained(), passed=["doc_id"])
    held_out = (~backoff_model.trained()).alias("held_out")
    return rows.select("doc_id", held_out, "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    rows = conversation_repair.damaged(_table(spark, folder, "conversations"))
    return conversation_repair.repaired(rows, present=F.col("present"))


def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.nodes(*prefix_trie.rebuilt(_table(spark, folder, "conversations")))


QUERIES = {
    name: query
    for name, query in list(globals().items())
    if name.startswith("op") and name[2:3].isdigit() and callable(query)
}
