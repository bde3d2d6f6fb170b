"""Token ids in ORC: run-length encoded, with row indexes and Bloom filters on document ids."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stopmetrics.llm.word_tokens import WordTokenizer
from stopmetrics.llm.worker_memory import release_memory

FILE_SCHEMA = "part int, row long, doc_id long, n_tokens int, ids array<int>"

# Orc's writer keeps integers run-length encoded by itself; these add what readers prune by.
_ORC_OPTIONS = {
    "compression": "zstd",
    "orc.create.index": "true",
    "orc.row.index.stride": "1000",
    "orc.stripe.size": str(16 << 20),
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
}


def _lists(encoded: list[bytes], end_id: int | None) -> pa.ListArray:
    end = b"" if end_id is None else int(end_id).to_bytes(4, "little")
    offsets = np.concatenate(([0], np.cumsum([len(ids) + len(end) for ids in encoded], dtype=np.int64))) // 4
    values = np.frombuffer(end.join(encoded) + (end if encoded else b""), dtype="<i4")
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values))


def encoded(
    docs: DataFrame, tokenizer_path: str, end_id: int | None, specials_as_text: bool = False
) -> DataFrame:
    """(doc_id, ids) in the order of `docs`; a NULL text has the end id only."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = WordTokenizer.of_worker(tokenizer_path, specials_as_text)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                ids = _lists(tokenizer.encode(part.column(1).to_pylist()), end_id)
                yield pa.RecordBatch.from_arrays([part.column(0), ids], names=["doc_id", "ids"])
        release_memory()

    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return texts.mapInArrow(of_batches, "doc_id long, ids array<int>")


def write_token_files(
    docs: DataFrame, path: str, tokenizer_path: str, end_id: int | None = None, specials_as_text: bool = False
) -> None:
    """Write the token ids of every document of `docs` (doc_id, text, ...) as ORC files, by ascending doc_id.

    Files cover successive ranges of doc_id (rows without one first, equal ones by a hash of their text), named by
    column `part`; `row` counts within a file. Documents are range-partitioned once, so a file's size follows the
    session's number of shuffle partitions. The string of a special token in a text is that token, as the tokenizers
    library has it, unless `specials_as_text`. No documents give files without rows. Further columns are not used.
    """
    spread = docs.select("doc_id", "text").withColumn("tie", F.xxhash64("text"))
    count = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = spread.repartitionByRange(count, F.col("doc_id").asc_nulls_first(), "tie").sortWithinPartitions(
        F.col("doc_id").asc_nulls_first(), "tie"
    )
    numbered = encoded(ordered, tokenizer_path, end_id, specials_as_text).select(
        F.spark_partition_id().alias("part"), F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("row"), "doc_id", F.size("ids").alias("n_tokens"), "ids"
    )
    numbered.write.options(**_ORC_OPTIONS).orc(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(part, row, doc_id, n_tokens, ids); tasks read stripes in parallel, and filters on doc_id skip stripes and row groups."""
    return spark.read.schema(FILE_SCHEMA).orc(path)


def with_starts(rows: DataFrame, files: DataFrame, *kept: str) -> DataFrame:
    """(doc_id, start, n_tokens, `kept`...): start counts the ids of all documents before, over all `files`.

    `rows` has part, row and n_tokens of each document. Sums run within each file, and over one total per file; the ids
    themselves are not moved.
    """
    totals = files.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("part").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    local = rows.withColumn("before", F.coalesce(F.sum("n_tokens").over(within), F.lit(0)))
    start = (F.col("base") + F.col("before")).cast("long").alias("start")
    return local.join(bases, "part").select("doc_id", start, "n_tokens", *kept)


def token_digests(files: DataFrame) -> DataFrame:
    """(part, row, doc_id, n_tokens, ids_crc32) from the ids as little-endian unsigned 32-bit integers."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            if not isinstance(lists, pa.ListArray):
                lists = lists.cast(pa.list_(pa.int32()))
            offsets = lists.offsets.to_numpy()
            values = lists.values.to_numpy(zero_copy_only=False).astype("<i4", copy=False)
            sums = [zlib.crc32(values[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(np.diff(offsets).astype(np.int64)), pa.array(sums, pa.int64())],
                names=["part", "row", "doc_id", "n_tokens", "ids_crc32"],
            )

    schema = "part int, row long, doc_id long, n_tokens long, ids_crc32 long"
    return files.select("part", "row", "doc_id", "ids").mapInArrow(of_batches, schema)
