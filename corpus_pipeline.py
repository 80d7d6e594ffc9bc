"""A training-data pipeline over ``documents``: five stages, each a table for the next.

``run`` writes every stage as Parquet below the shared folder and reads it back, so a
stage's work is done once and outlives any executor.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyferry.llm import bpe_automaton, line_dedup, mixing, ngram_join, toxicity
from tallyferry.llm.queries import tokenizer_path
from tallyferry.session import materialise

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject; a model without weights rejects none.

    Null and empty texts have no features and are scored like any other; a null id is
    never learned from. Repeated rows get the same score. An empty table stays empty.
    """
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    weights = toxicity.fit(docs, labels)
    if not weights:
        return docs
    kept = toxicity.score(docs.drop("score"), weights).where(f"score < {toxicity.THRESHOLD}")
    return kept.select(*docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that an earlier one holds; n_chars follows the text.

    A null text becomes an empty one; a document that loses all lines keeps an empty text.
    Rows of one id, and all rows without id (the last id), count as one document: lines they
    share stay in each. No row goes. An empty table stays empty.
    """
    return line_dedup.dedup_lines(docs).selectExpr(
        *[f"cast(length(text) as bigint) as {c}" if c == "n_chars" else f"`{c}`" for c in docs.columns]
    )


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by 0.8 of their 5-word shingles.

    Texts without words are linked with nothing and stay. Of a group the row with the
    smallest id stays, and of rows of that id one. An empty table stays empty.
    """
    return ngram_join.one_per_group(docs).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix by source weights draws them.

    A null source is a source, the last one. Documents without words have size 0 and no
    share to fill. Rows of one id, or without id, are drawn each on its own. An empty
    table stays empty.
    """
    return mixing.mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each drawn document: doc_id, source, n_tokens and ids.

    A null or empty text has no ids. Repeated rows are encoded each. Empty in, empty out.
    """
    ids = bpe_automaton.encode_documents(docs, tokenizer_path(), columns=["doc_id", "source"])
    return ids.selectExpr("doc_id", "source", "cast(size(ids) as bigint) as n_tokens", "ids")


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("ngram_join", drop_near_copies),
    ("mixing", mix_sources),
    ("bpe_encoding", encode),
]

#: Learned weights, components and byte-pair merges are not SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
