"""Documents to tokens: the stages of a training-data pipeline, one after the other.

Each stage takes (spark, docs, folder) and returns what it keeps, with the
columns of documents; the last returns the token digests. ``run`` writes every
stage's result to the shared folder and reads it again as the next one's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from groundburn.llm import byte_bpe, host_quality, language_id, near_dup, wu_manber
from groundburn.llm.base import staged, table
from groundburn.llm.queries import BYTE_BPE

#: Posterior below which the language of a document counts as unknown.
MIN_LANGUAGE_SCORE = 0.5


def _packed(docs: DataFrame) -> DataFrame:
    """Whole rows beside what a stage reads, so that no name of theirs can clash."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "text", "source", "lang")


def known_language(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Keeps documents whose language is recognised; null and letterless texts go."""
    model = language_id.fit(docs)
    found = language_id.identified(_packed(docs), model, keep=["row"])
    return found.where((F.col("lang_pred") != "und") & (F.col("score") >= MIN_LANGUAGE_SCORE)).select("row.*")


def good_quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Keeps documents that pass the base rules and their host's verdict."""
    return host_quality.judged_by_host(_packed(docs), columns=["row"]).where("kept").select("row.*")


def distinct(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Keeps the first document, by id, of each class of near duplicates."""
    return near_dup.without_copies(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Keeps documents without a window of any benchmark item."""
    found = wu_manber.contamination(_packed(docs), table(spark, folder, "benchmark"), keep=["row"])
    return found.where(F.col("n_hit") == 0).select("row.*")


def tokenized(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """doc_id, n_tokens and digests of the ids and of what they decode to."""
    return byte_bpe.round_trip(docs, BYTE_BPE, keep=["doc_id"])


STAGES = [
    ("language", known_language),
    ("quality", good_quality),
    ("near-duplicates", distinct),
    ("decontamination", decontaminated),
    ("tokens", tokenized),
]

#: Language models, weighted sampling and tokenizers are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
