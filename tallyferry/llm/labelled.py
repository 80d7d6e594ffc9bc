"""Labelled rows for fitting: the training fold and bounded samples of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(id_col: str = "doc_id") -> Column:
    """The fold that no model learns from: crc32 of the id as text, modulo 5, is 0. A null id is not in it."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, label: str, limit: int) -> DataFrame:
    """doc_id, text and ``label`` of at most ``limit`` labelled training documents, chosen by hash.

    Only the sample's ids are broadcast, so ``limit`` bounds them. Rows without id,
    text or label teach nothing.
    """
    chosen = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out())
        .select("doc_id", F.col(label).cast("int").alias("label"))
        .dropDuplicates(["doc_id"])
        .orderBy(F.xxhash64("doc_id", F.lit(5)), "doc_id")
        .limit(limit)
    )
    return docs.select("doc_id", "text").where("text is not null").join(F.broadcast(chosen), "doc_id")
