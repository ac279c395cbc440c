"""From raw documents to token ids: quality, near copies, contamination, personal data, pieces.

Each stage takes (spark, docs, sf_dir) and works on everything its predecessor kept. All stages but the
last return the columns of `docs` as they came, whatever else these are; the last returns the ids.
"""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopperflow.llm import decontaminate, line_quality, ngram_join, piece_lattice, pseudonyms
from shopperflow.llm.queries import KEY as TEST_KEY
from shopperflow.llm.queries import model_file
from shopperflow.plans.durable import settle

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
log = logging.getLogger(__name__)

#: The caller's secret, see `key`.
KEY: bytes | None = None
#: A prefix for a stage's own columns, so that they never meet a column of the documents.
_OWN = "__pipeline_"


def key() -> bytes:
    """The secret of the pseudonyms: set it here for a corpus that matters (`corpus_pipeline.KEY = ...`).

    Until it is set, the key of the test tables is used, with which anybody can lead the pseudonyms back.
    """
    if KEY is None:
        log.warning("personal_data: corpus_pipeline.KEY is not set, using the key of the test tables")
    return TEST_KEY if KEY is None else KEY


def _apart(docs: DataFrame) -> DataFrame:
    """id and text for an operator, the whole row beside them."""
    return docs.select(F.col("doc_id"), F.col("text"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(f"{_OWN}row"))


def _back(rows: DataFrame) -> DataFrame:
    return rows.select(f"{_OWN}row.*")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects what the line classifier predicts as bad; it learns from labels that are not held out."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = line_quality.learn(docs, labels.where(~line_quality.held_out()))
    return _back(line_quality.scored(_apart(docs), model).where("predicted = 1"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies, that with the smallest id; unlike texts of one id all stay."""
    return ngram_join.one_of_each(docs)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that hold a window of a benchmark item."""
    found = decontaminate.automata(spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return _back(decontaminate.contaminated(_apart(docs), found).where("not contaminated"))


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by pseudonyms; n_chars, where there is one, counts the new text."""
    rows = pseudonyms.pseudonymised(_apart(docs), key())
    new = {"text": F.col("text"), "n_chars": F.when(F.col(f"{_OWN}row.n_chars").isNotNull(), F.length("text")) if "n_chars" in docs.columns else None}
    return rows.select(*[
        (new[c].cast(docs.schema[c].dataType) if c in new else F.col(f"{_OWN}row")[c]).alias(c) for c in docs.columns
    ])


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_pieces, scores of the N best segmentations, and the hash of the text decoded from the ids."""
    rows = piece_lattice.encoded(docs, model_file(), passed=["doc_id"])
    return rows.select("doc_id", "ids", "n_pieces", "scores", "alternatives_sha256", "decoded_sha256")


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("near_copies", near_copies),
    ("decontamination", uncontaminated),
    ("personal_data", without_personal_data),
    ("pieces", pieces),
]

#: A fitted classifier, keyed permutations and a lattice search are not SQL; tests/llm holds run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = settle(docs)
    return docs
