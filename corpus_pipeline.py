"""From raw documents to token ids: five stages, each written before the next.

Every stage takes any table with the columns of documents, in any order and
beside any others, whatever their names. Rows with null texts, languages,
sources or keys pass like all others: a null text has no words and no ids, a
row without a key links with nothing, is never cut and is drawn by a hash of its
other columns. Repeated rows stay or go together, ties are settled by the
smaller key, texts of any length are handled whole, and an empty table stays
empty.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftframe.llm import bpe, minhash, substrings, toxicity
from siftframe.llm.common import fresh
from siftframe.llm.queries import mix_documents, table, toxicity_model
from siftframe.session import stage


COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def set_aside(docs: DataFrame) -> tuple[DataFrame, list]:
    """``docs`` with its extra columns under names that no operator uses, and
    the columns that give them back."""
    p = fresh(docs)
    inner = {c: c if c in COLUMNS else f"{p}{i}" for i, c in enumerate(docs.columns)}
    back = [F.col(n).alias(c) for c, n in inner.items()]
    return docs.select(*[F.col(f"`{c}`").alias(n) for c, n in inner.items()]), back


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score stays below the threshold."""
    docs, back = set_aside(docs)
    scored = toxicity.score(docs, toxicity_model(docs, table(spark, sf_dir, "labels")))
    return scored.where(F.col("score") < toxicity.THRESHOLD).select(*back)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every group of near copies."""
    docs, back = set_aside(docs)
    return minhash.near_copies(docs).where("kept").select(*back)


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that an earlier document has; a text that keeps
    all its words keeps its white space too."""
    docs, back = set_aside(docs)
    found = substrings.without_repeats(docs)
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text"))
    found = found.withColumn("text", text).withColumn("n_chars", F.length("text").cast("long"))
    return found.select(*back)


def mixed_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample that meets the target shares of sources, languages and topics."""
    docs, back = set_aside(docs)
    return mix_documents(docs, "n_tokens", "topic").select(*back)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their token ids."""
    vocabulary = bpe.load_vocabulary(public_tokenizers.path("byte_bpe_50k.json"))
    return bpe.encode(docs, vocabulary, packed=False)


STAGES = [
    ("toxicity", without_toxic),
    ("minhash near-dedup", without_near_copies),
    ("substring dedup", without_repeated_passages),
    ("mixing", mixed_to_targets),
    ("bpe", encoded),
]

# Stages learn a model and draw random samples: SQL has no counterpart.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are written as Parquet to
    the shared folder and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage_of in STAGES:
        docs = stage(stage_of(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
