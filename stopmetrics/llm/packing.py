"""Best-fit decreasing packing of token sequences into sequences of a fixed capacity."""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stopmetrics.llm.word_tokens import WordTokenizer
from stopmetrics.llm.worker_memory import release_memory
from stopmetrics.scratch import written

_PIECES = "length int, rank_in_part long, doc_id long, piece int, start long, ids_crc32 long, ids binary"


def _ranks(lengths: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """The rank of each piece among those of its length, of which `seen` came before; counts them in `seen`."""
    order = np.argsort(lengths, kind="stable")
    ordered = lengths[order]
    first = np.flatnonzero(np.diff(ordered, prepend=-1))
    within = np.arange(len(ordered)) - np.repeat(first, np.diff(first, append=len(ordered)))
    ranks = np.empty(len(lengths), dtype=np.int64)
    ranks[order] = within + seen[ordered]
    seen += np.bincount(lengths, minlength=len(seen))
    return ranks


def _pieces(doc_ids: pa.Array, encoded: list[bytes], end_id: int, capacity: int, seen: np.ndarray, with_ids: bool) -> pa.RecordBatch:
    """All pieces of some documents, each with its rank among this task's pieces of the same length."""
    end = int(end_id).to_bytes(4, "little")
    totals = np.array([len(ids) // 4 + 1 for ids in encoded], dtype=np.int64)
    number = -(-totals // capacity)
    doc = np.repeat(np.arange(len(encoded)), number)
    piece = np.arange(len(doc)) - np.repeat(np.cumsum(number) - number, number)
    lengths = np.minimum(totals[doc] - piece * capacity, capacity)
    crc32, sums, own = zlib.crc32, [], []
    for ids, parts in zip(encoded, number.tolist()):
        if parts == 1 and not with_ids:
            sums.append(crc32(end, crc32(ids)))
            continue
        ids += end
        for at in range(0, len(ids), 4 * capacity):
            cut = ids[at : at + 4 * capacity]
            sums.append(crc32(cut))
            if with_ids:
                own.append(cut)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(lengths.astype(np.int32)),
            pa.array(_ranks(lengths, seen)),
            doc_ids.take(pa.array(doc)),
            pa.array(piece.astype(np.int32)),
            pa.array(piece * capacity),
            pa.array(sums, pa.int64()),
            pa.array(own, pa.binary()) if with_ids else pa.nulls(len(doc), pa.binary()),
        ],
        names=[name.split()[0] for name in _PIECES.split(", ")],
    )


def _cut(
    docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int, with_ids: bool, specials_as_text: bool
) -> DataFrame:
    """Pieces of at most `capacity` ids, each with its rank among this task's pieces of the same length."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = WordTokenizer.of_worker(tokenizer_path, specials_as_text)
        seen = np.zeros(capacity + 1, dtype=np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                encoded = tokenizer.encode(part.column(1).to_pylist())
                yield _pieces(part.column(0), encoded, end_id, capacity, seen, with_ids)
        release_memory()

    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return texts.mapInArrow(of_batches, _PIECES).withColumn("part", F.spark_partition_id())


class CapacityTree:
    """Segment tree over remaining capacities that finds the smallest one, at least a given size, with an open bin."""

    def __init__(self, capacity: int) -> None:
        self.leaves = 1 << capacity.bit_length()
        self.open = bytearray(2 * self.leaves)

    def mark(self, remaining: int, is_open: bool) -> None:
        at = self.leaves + remaining
        self.open[at] = is_open
        while at > 1:
            at //= 2
            self.open[at] = self.open[2 * at] | self.open[2 * at + 1]

    def tightest(self, size: int) -> int | None:
        at = self.leaves + size
        if self.open[at]:
            return size
        while at > 1:
            if at % 2 == 0 and self.open[at + 1]:
                at += 1
                while at < self.leaves:
                    at = 2 * at if self.open[2 * at] else 2 * at + 1
                return at - self.leaves
            at //= 2
        return None


def best_fit_plan(counts: Iterable[tuple[int, int]], capacity: int) -> np.ndarray:
    """Best-fit decreasing for `counts` of (length, pieces): rows (length, first rank, pieces per bin, first bin, offset).

    The pieces of one length are alike, and after one of them enters a bin, that bin stays the tightest while it has
    room. So whole runs of bins with equal remaining capacity fill at once, and the result is that of placing piece by
    piece. From its first rank on, a row puts every `pieces per bin` ranks into the next bin, from `offset` on. The work
    and the rows depend on the number of lengths, at most `capacity`, not on the number of pieces.
    """
    tree = CapacityTree(capacity)
    runs: dict[int, deque[tuple[int, int]]] = {}
    plan, bins = [], 0

    def put(remaining: int, first: int, number: int) -> None:
        if remaining and number:
            if not runs.setdefault(remaining, deque()):
                tree.mark(remaining, True)
            runs[remaining].append((first, number))

    for length, left in sorted(counts, reverse=True):
        rank = 0
        while left:
            remaining = tree.tightest(length)
            if remaining is None:
                remaining, per = capacity, capacity // length
                first, number = bins, -(-left // per)
                bins += number
            else:
                per = remaining // length
                first, number = runs[remaining].popleft()
                if not runs[remaining]:
                    tree.mark(remaining, False)
            full, partly = min(number, left // per), 0
            if full < number:
                partly = left - full * per
            plan.append((length, rank, per, first, capacity - remaining))
            taken = full * per + partly
            rank, left = rank + taken, left - taken
            put(remaining - per * length, first, full)
            if partly:
                put(remaining - partly * length, first + full, 1)
            used = full + bool(partly)
            put(remaining, first + used, number - used)
    return np.array(plan, dtype=np.int64).reshape(-1, 5)


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int,
    capacity: int = 4096,
    with_ids: bool = True,
    specials_as_text: bool = False,
) -> DataFrame:
    """Every piece of every document of `docs` (doc_id, text, ...), and its place in a sequence.

    Returns (doc_id, piece, start, length, ids, ids_crc32, sequence_id, offset): `ids` are little-endian 32-bit ids,
    `start` counts the document's ids before the piece, `offset` its place in the sequence. Only documents of more than
    `capacity` ids, the end id included, are cut. NULL and empty texts have the end id only; rows with equal or NULL
    doc_id are packed one by one; no documents give no rows. Further columns of `docs` are not used. Without `with_ids`
    the ids are left NULL. The string of a special token in a text is that token, as the tokenizers library has it,
    unless `specials_as_text`.

    The pieces are written once. The driver gets their number by length, at most `capacity` rows, and plans the whole
    packing from them; the plan goes to the tasks, where each piece's rank among those of its length finds its row.
    """
    pieces = written(_cut(docs, tokenizer_path, end_id, capacity, with_ids, specials_as_text), "pieces")
    by_part = pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = by_part.select("length", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    counts = by_part.groupBy("length").agg(F.sum("n")).collect()
    plan = best_fit_plan([(row[0], row[1]) for row in counts], capacity)
    order = np.lexsort((plan[:, 1], plan[:, 0]))
    length_of, rank_of, per_of, bin_of, offset_of = plan[order].T
    keys = (length_of << 48) + rank_of

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        size = length.to_numpy(np.int64)
        row = np.searchsorted(keys, (size << 48) + rank.to_numpy(np.int64), side="right") - 1
        nth = rank.to_numpy(np.int64) - rank_of[row]
        return pd.DataFrame(
            {"sequence_id": bin_of[row] + nth // per_of[row], "offset": offset_of[row] + nth % per_of[row] * size}
        )

    ranked = pieces.join(bases, ["length", "part"]).withColumn("rank", F.col("base") + F.col("rank_in_part"))
    placed = ranked.withColumn("place", place("length", "rank"))
    return placed.select(
        "doc_id", "piece", "start", F.col("length").cast("long"), "ids", "ids_crc32", "place.sequence_id", "place.offset"
    )
