"""Removal of multi-line chunks that repeat anywhere in a corpus; chunk borders follow the content, not positions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stopmetrics.scratch import written

_FACTOR = 31  # of the rolling hash


def line_hashes(lines: str | Column) -> Column:
    """A 32-bit number per line: the first eight hex digits of its MD5."""
    return F.transform(lines, lambda line: F.conv(F.substring(F.md5(line), 1, 8), 16, 10).cast("long"))


def chunk_ends(hashes: Column, divisor: int) -> Column:
    """Line numbers, from 1, after which a chunk ends: where the rolling hash over a line and the one before it is
    divisible by `divisor`, and the last line. Lines put in elsewhere do not move them."""

    def ends(number: Column) -> Column:
        rolling = F.get(hashes, number - 1) + _FACTOR * F.coalesce(F.get(hashes, number - 2), F.lit(0))
        return (rolling % divisor == 0) | (number == F.size(hashes))

    return F.filter(F.sequence(F.lit(1), F.size(hashes)), ends)


def with_chunks(docs: DataFrame, divisor: int) -> DataFrame:
    """`docs` with `chunks`: per chunk its text and its number of lines that are not blank."""
    cut = docs.withColumn("lines", F.split(F.coalesce("text", F.lit("")), "\n", -1))
    cut = cut.withColumn("hashes", line_hashes("lines"))
    cut = cut.withColumn("ends", chunk_ends(F.col("hashes"), divisor))

    def chunk(end: Column, place: Column) -> Column:
        start = F.coalesce(F.get("ends", place - 1), F.lit(0)) + 1
        own = F.slice("lines", start, end - start + 1)
        filled = F.size(F.filter(own, lambda line: F.length(F.trim(line)) > 0))
        return F.struct(F.array_join(own, "\n").alias("text"), filled.alias("filled"))

    return cut.withColumn("chunks", F.transform("ends", chunk)).drop("lines", "hashes", "ends")


def remove_repeated_chunks(docs: DataFrame, divisor: int = 4, least_lines: int = 2) -> DataFrame:
    """`docs` (doc_id, text, ...) without chunks of at least `least_lines` filled lines that occurred before.

    The first occurrence, by doc_id (rows without one come last) and place, stays in every row of that doc_id; each
    other one goes, if its bytes are the same: hashes only nominate. Adds n_chunks and n_removed, replacing such
    columns; other columns stay, and a text that loses nothing stays as it is, NULL included. A text that loses all is
    empty. Rows that are equal in doc_id and text are one document.

    Two shuffles carry text: multi-line chunks to the hashes that repeat, and the documents to their removed chunks. Both
    are joins whose hot keys adaptive execution can split, after counts that combine before they shuffle. `divisor` is
    the mean number of lines per chunk.
    """
    names = [name for name in docs.columns if name not in ("n_chunks", "n_removed")]
    rest = [f"`{name}`" for name in names if name not in ("doc_id", "text")]
    plain = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.xxhash64(F.col("text").cast("string")).alias("version"),
        F.struct(*rest).alias("rest") if rest else F.lit(None).cast("int").alias("rest"),
    )
    chunked = with_chunks(plain.select("doc_id", "version", "text"), divisor)
    # Outer, though no text is without a chunk: of a plain posexplode Spark infers a filter on the array's size, which it
    # pushes below the projections that build the array, and then computes their arrays anew for every element.
    each = chunked.select("doc_id", "version", F.posexplode_outer("chunks").alias("place", "chunk"))
    several = each.where(F.col("chunk.filled") >= least_lines).select(
        F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "place").alias("at"),
        "version",
        F.xxhash64("chunk.text").alias("hash"),
        F.col("chunk.text").alias("piece"),
    )
    first, last = F.min("at").alias("first"), F.max("at").alias("last")
    repeated = several.groupBy("hash").agg(first, last).where("first <> last").select("hash")
    nominated = written(several.join(repeated, "hash"), "chunks")
    kept = nominated.groupBy("hash", "piece").agg(first)
    removed = nominated.join(kept, ["hash", "piece"]).where("at <> first")
    by_document = removed.groupBy(F.col("at.doc_id").alias("own_id"), F.col("version").alias("own_version")).agg(
        F.collect_set("at.place").alias("gone")
    )
    own = plain["doc_id"].eqNullSafe(F.col("own_id")) & (F.col("version") == F.col("own_version"))
    marked = with_chunks(plain.join(by_document, own, "left"), divisor)
    left = F.filter("chunks", lambda chunk, place: ~F.array_contains("gone", place))
    text = F.when(F.col("gone").isNull(), F.col("text")).otherwise(
        F.array_join(F.transform(left, lambda chunk: chunk["text"]), "\n")
    )
    shown = {"doc_id": F.col("doc_id"), "text": text.alias("text")}
    result = F.struct(
        *[shown[name] if name in shown else F.col(f"rest.`{name}`").alias(name) for name in names],
        F.size("chunks").alias("n_chunks"),
        F.coalesce(F.size("gone"), F.lit(0)).alias("n_removed"),
    )
    # By way of a one-element array, which a caller's filter is not pushed through: see above.
    return marked.select(F.inline_outer(F.array(result)))
