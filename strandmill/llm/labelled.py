"""Bounded samples of labelled documents for training, and the folds that they come from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of doc_id as text, modulo folds; 0 for a null doc_id."""
    return F.pmod(F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8")), F.lit(folds)).cast("int")


def sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, rows: int) -> list[tuple[int, str, int]]:
    """(doc_id, whole text, label) of at most `rows` labelled documents outside the held-out fold, whatever their length.

    Which ones is decided by a hash of doc_id, so the sample doesn't depend on partitions. Texts come to the driver one
    partition at a time.
    """
    fit = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & (fold(F.col("doc_id"), folds) != held_out))
    fit = fit.groupBy("doc_id").agg(F.max(label).alias("label"))
    texts = docs.select("doc_id", "text").where("doc_id is not null and text is not null")
    ids = fit.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)  # a fixed number, broadcast
    found = texts.join(F.broadcast(ids), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.max("label").alias("label"))
    return [tuple(r) for r in found.orderBy(F.xxhash64("doc_id"), "doc_id").toLocalIterator()]
