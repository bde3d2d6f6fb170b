"""SimHash near-duplicates found by covering locality-sensitive hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stopmetrics.llm.graph import connected_components
from stopmetrics.llm.samples import slices
from stopmetrics.llm.worker_memory import release_memory
from stopmetrics.scratch import written

BITS = 64
SEED = 42
_PIECE = 1 << 16  # shingles turned into bits at a time


def text_fingerprint(text: str | None, words_per_shingle: int = 3) -> int:
    """Majority bits of the XXH64 hashes of all word shingles of `text`; zero for a text without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(word) + 1 for word in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(words_per_shingle, len(words))
    spans = zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist())
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], dtype="<u8")
    counts = np.zeros(BITS, dtype=np.int64)
    for at in range(0, len(hashes), _PIECE):
        bits = np.unpackbits(hashes[at : at + _PIECE].view(np.uint8), bitorder="little").reshape(-1, BITS)
        counts += bits.sum(axis=0, dtype=np.int32)
    majority = np.packbits(counts * 2 > len(hashes), bitorder="little")
    return int(majority.view("<u8")[0])


def fingerprints(docs: DataFrame, words_per_shingle: int = 3) -> DataFrame:
    """`docs` (doc_id, text, ...) with `simhash`, the fingerprint's 64 bits as a long; a clashing column is replaced.

    A-Z are lower-cased, words are runs of anything but ASCII blanks, shingles count as often as they occur, a text of
    fewer words is one shingle, and a NULL or empty text has fingerprint 0. Only texts go to Python.
    """

    def of_batch(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            found = [text_fingerprint(text, words_per_shingle) for part in slices(batch) for text in part]
            yield pa.array(np.array(found, dtype=np.uint64).view(np.int64))
        release_memory()

    return docs.withColumn("simhash", F.arrow_udf(of_batch, "long")("text"))


def covering_masks(radius: int, bits: np.ndarray | None = None, bits_total: int = BITS) -> list[int]:
    """Masks such that two words that differ in at most `radius` of `bits` agree on all bits of one mask.

    Each bit carries a non-zero vector of radius + 1 zeros and ones; the mask of a non-zero vector v keeps the bits
    whose vector has an odd product with v. At most `radius` differing bits span at most `radius` dimensions, so some
    v is orthogonal to all their vectors, and its mask drops every bit that differs.
    """
    places = np.arange(bits_total) if bits is None else bits
    size = radius + 1
    vectors = np.arange(len(places)) % ((1 << size) - 1) + 1  # dealt evenly over all non-zero vectors
    masks = []
    for v in range(1, 1 << size):
        kept = [int(place) for place, a in zip(places, vectors) if bin(int(a) & v).count("1") % 2 == 1]
        masks.append(sum(1 << place for place in kept))
    return masks


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def _forest(values: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links that join all of `values` which chains of distances up to `radius` join; one fewer than members each."""
    links, left = [], values
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            at = queue.pop()
            near = np.bitwise_count(left ^ at) <= radius
            queue.extend(left[near])
            links.extend((int(at), int(value)) for value in left[near])
            left = left[~near]
    return links


_BRUTE = 2048  # larger buckets are split again by masks over the bits that still differ


def bucket_links(values: np.ndarray, radius: int, free: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links that connect every pair of different uint64 `values` within `radius`, all members of one bucket.

    Small buckets are searched outright. A large one is covered anew over its `free` bits, those the members do not
    share, so that no bucket costs the square of its size and none is cut off.
    """
    if free is None:
        spread = np.bitwise_or.reduce(values ^ values[0])
        free = np.array([bit for bit in range(BITS) if int(spread) >> bit & 1])
    if len(values) <= _BRUTE or len(free) <= 11:
        return _forest(values, radius)
    links = set()
    for mask in covering_masks(radius, free):
        keys = values & np.uint64(mask)
        order = np.argsort(keys, kind="stable")
        cuts = np.flatnonzero(np.diff(keys[order])) + 1
        rest = np.array([bit for bit in free if not mask >> int(bit) & 1])
        for part in np.split(values[order], cuts):
            if len(part) > 1:
                links.update(bucket_links(part, radius, rest))
    return list(links)


_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _links_of_sorted(batches: Iterator[pa.RecordBatch], radius: int) -> Iterator[pa.RecordBatch]:
    """Rows (t, k, simhash) ordered by bucket; the open bucket carries over to the next batch."""

    def out(buckets: list[np.ndarray]) -> pa.RecordBatch:
        found = [link for bucket in buckets for link in bucket_links(bucket, radius)]
        ends = np.array(found, dtype=np.uint64).reshape(-1, 2).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(ends[:, 0]), pa.array(ends[:, 1])], schema=_LINKS)

    held, key = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        t, k, value = (column.to_numpy() for column in batch.columns)
        cuts = np.flatnonzero((np.diff(t) != 0) | (np.diff(k) != 0)) + 1
        parts = np.split(value.view(np.uint64), cuts)
        if key == (t[0], k[0]):
            parts[0] = np.concatenate([*held, parts[0]])
            held = []
        closed = [np.concatenate(held)] if held else []
        closed += parts[:-1]
        held, key = [parts[-1]], (t[-1], k[-1])
        yield out([part for part in closed if len(part) > 1])
    if held:
        last = np.concatenate(held)
        if len(last) > 1:
            yield out([last])


def near_duplicates(docs: DataFrame, words_per_shingle: int = 3, radius: int = 3) -> DataFrame:
    """(doc_id, simhash, component_id, component) per row of `docs`; clashing and further columns of `docs` are not used.

    Fingerprints at `radius` or fewer differing bits are linked, and component_id is the smallest doc_id that links
    reach. Equal fingerprints collapse to one class first, so copies cost one row each however many there are. Every
    class is dealt to one bucket per covering mask; within a bucket only a spanning forest of links leaves the task.
    Buckets hold different fingerprints only, eight bytes each. A row without doc_id takes part but names no
    component: component_id is NULL where no member has an id; `component` is a fingerprint that names it in any case. No documents give no rows.
    """
    marked = fingerprints(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), words_per_shingle)
    rows = written(marked.select("doc_id", "simhash"), "simhash")
    classes = rows.groupBy("simhash").agg(F.min("doc_id").alias("least"))
    masks = covering_masks(radius)
    keys = F.array(
        *[
            F.struct(F.lit(t).alias("t"), F.col("simhash").bitwiseAND(F.lit(_signed(mask))).alias("k"))
            for t, mask in enumerate(masks)
        ]
    )
    dealt = classes.select("simhash", F.explode(keys).alias("key")).select("key.t", "key.k", "simhash")
    ordered = dealt.repartition("t", "k").sortWithinPartitions("t", "k")
    links = ordered.mapInArrow(lambda batches: _links_of_sorted(batches, radius), "a long, b long")
    joined = connected_components(links)
    labelled = classes.join(joined.withColumnRenamed("node", "simhash"), "simhash", "left").select(
        "simhash", "least", F.coalesce("component", "simhash").alias("component")
    )
    smallest = labelled.groupBy("component").agg(F.min("least").alias("component_id"))
    by_class = labelled.join(smallest, "component").select("simhash", "component_id", "component")
    return rows.join(by_class, "simhash").select("doc_id", "simhash", "component_id", "component")


def keep_one_per_component(docs: DataFrame, words_per_shingle: int = 3, radius: int = 3) -> DataFrame:
    """One row of `docs` per component, of the doc_id that names it; rows without doc_id all stay.

    Rows that repeat a doc_id with another text are rows of their own: each stays that is the first of its doc_id in its
    component, by fingerprint and then by a hash of the text. Only such rows are fingerprinted again, to tell them apart.
    """
    found = near_duplicates(docs, words_per_shingle, radius)
    named = F.col("doc_id") == F.col("component_id")
    of_id = found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(named).alias("own")).where("own > 0")
    ids = written(of_id.select("doc_id", (F.col("n") > 1).alias("repeated")), "kept-ids")
    kept = docs.join(ids.where("NOT repeated").select("doc_id"), "doc_id", "left_semi")
    repeated = ids.where("repeated").select("doc_id")
    if not repeated.isEmpty():
        first = found.join(repeated, "doc_id", "left_semi").where(named).groupBy("doc_id", "component")
        wanted = first.agg(F.min("simhash").alias("simhash")).select("doc_id", "simhash")
        whole = docs.select("doc_id", "text", F.struct("*").alias("row"))
        marked = fingerprints(whole.join(repeated, "doc_id", "left_semi"), words_per_shingle)
        best = Window.partitionBy("doc_id", "simhash").orderBy(F.xxhash64("text"))
        ranked = marked.join(wanted, ["doc_id", "simhash"], "left_semi").withColumn("place", F.row_number().over(best))
        kept = kept.unionByName(ranked.where("place = 1").select("row.*"))
    return kept.unionByName(docs.where("doc_id IS NULL")).select(*docs.columns)
