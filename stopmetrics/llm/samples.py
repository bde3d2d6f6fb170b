"""Bounded samples of labelled documents for fitting small models."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def slices(batch: pa.Array, rows: int = 500) -> Iterator[list]:
    """Python values of an Arrow batch, a few rows at a time: texts need not all be in memory twice."""
    for at in range(0, len(batch), rows):
        yield batch.slice(at, rows).to_pylist()


def is_held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document serves to test only: crc32 of its id as text, divisible by 5."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows_per_class: int, classes: int = 2) -> DataFrame:
    """(doc_id, text, label long) of at most `rows_per_class` documents of each class, chosen by a hash of their id.

    Only rows of `labels` with a doc_id and a label that are not held out count; a repeated doc_id counts once, with the text whose hash is least. At most
    `rows_per_class * classes` ids, eight bytes each, are broadcast to the scan of `docs`.
    """
    usable = labels.select(F.col("doc_id").cast("long"), F.col(label).cast("long").alias("label"))
    usable = usable.where(F.col("doc_id").isNotNull() & F.col("label").between(0, classes - 1) & ~is_held_out())
    usable = usable.groupBy("doc_id").agg(F.min("label").alias("label"))
    chosen = None
    for value in range(classes):
        part = usable.where(F.col("label") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows_per_class)
        chosen = part if chosen is None else chosen.unionByName(part)
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    met = texts.join(F.broadcast(chosen), "doc_id")
    return met.groupBy("doc_id", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text")).select("doc_id", "text", "label")


def class_sizes(labels: DataFrame, label: str) -> dict[int, int]:
    """Rows per label among those not held out; one row per class reaches the driver."""
    kept = labels.where(~is_held_out() & F.col(label).isNotNull() & F.col("doc_id").isNotNull())
    return {int(row[0]): row[1] for row in kept.groupBy(F.col(label).cast("long")).count().collect()}
