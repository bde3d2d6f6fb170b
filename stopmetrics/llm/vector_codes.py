"""Product codes of vectors, trained by Lloyd rounds over members that stay with the owner of their codebook entry."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopmetrics.llm.worker_memory import release_memory
from stopmetrics.scratch import written

_INT = (1 << 31) - 1
_LONG = (1 << 63) - 1
_EXACT = 1 << 20  # up to here products and sums of a part are whole numbers to a double
_ROWS = 8192  # parts compared with a codebook at a time
_LABEL_SALTS = 32

Codebook = list[np.ndarray]  # by part position: one row of integers per entry


def _bounds(width: int, parts: int) -> list[int]:
    return [width * i // parts for i in range(parts + 1)]


def integer_vectors(vectors: DataFrame, scale: int) -> DataFrame:
    """(row long, vec_id long, label, v array<int>) of the usable vectors: v is floor(scale * x).

    Vectors that are NULL or hold NULL or non-finite components are dropped; components beyond 32 bits take the nearest
    bound. `row` numbers the rows, so that repeated ids stay apart. Written once.
    """
    x = F.col("embedding").cast("array<double>")
    finite = F.forall(x, lambda a: F.coalesce(F.abs(a) < float("inf"), F.lit(False)))
    scaled = F.transform(
        x, lambda a: F.floor(F.greatest(F.least(a * scale, F.lit(float(_INT))), F.lit(float(-_INT)))).cast("int")
    )
    label = F.col("label") if "label" in vectors.columns else F.lit(None).cast("string").alias("label")
    usable = vectors.where(F.col("embedding").isNotNull() & F.coalesce(finite, F.lit(False)))
    kept = usable.select(F.col("vec_id").cast("long"), label, scaled.alias("v"))
    return written(kept.withColumn("row", F.monotonically_increasing_id()), "vectors")


def nearest(points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry, the lower one on a tie, and its squared distance, at most a long, both exact."""
    small = max((int(np.abs(a).max()) for a in (points, entries) if a.size), default=0) < _EXACT
    if small:
        p, e = points.astype(np.float64), entries.astype(np.float64)
        far = (p * p).sum(axis=1)[:, None] - 2 * (p @ e.T) + (e * e).sum(axis=1)
        best = far.argmin(axis=1)
        return best, far[np.arange(len(p)), best].astype(np.int64)
    p, e = points.astype(object), entries.astype(object)
    far = [[int(((a - b) ** 2).sum()) for b in e] for a in p]
    best = np.array([one.index(min(one)) for one in far], dtype=np.int64)
    return best, np.array([min(min(one), _LONG) for one in far], dtype=np.int64)


_MEMBER = "row long, position int, entry int, part array<int>"
_JUDGED = _MEMBER + ", new_entry int, distance long"


def _matrix(column: pa.Array, rows: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1)


def _first_assignment(codebook: Codebook, width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    cuts = _bounds(width, len(codebook))

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                part = batch.slice(at, _ROWS)
                vectors = _matrix(part.column(1), part.num_rows)
                for position, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
                    own = np.ascontiguousarray(vectors[:, a:b])
                    entry, _ = nearest(own, codebook[position])
                    offsets = np.arange(part.num_rows + 1, dtype=np.int32) * (b - a)
                    yield pa.RecordBatch.from_arrays(
                        [
                            part.column(0),
                            pa.array(np.full(part.num_rows, position, dtype=np.int32)),
                            pa.array(entry.astype(np.int32)),
                            pa.ListArray.from_arrays(pa.array(offsets), pa.array(own.reshape(-1))),
                        ],
                        names=["row", "position", "entry", "part"],
                    )
        release_memory()

    return of_batches


def _of_position(batch: pa.RecordBatch, position: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(position, its rows in the batch, their parts); parts of one position have one width."""
    for p in np.unique(position):
        rows = np.flatnonzero(position == p)
        yield int(p), rows, _matrix(batch.column(3).take(pa.array(rows)), len(rows))


def _judge(codebook: Codebook) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                some = batch.slice(at, _ROWS)
                entry = np.zeros(some.num_rows, dtype=np.int32)
                distance = np.zeros(some.num_rows, dtype=np.int64)
                for position, rows, parts in _of_position(some, some.column(1).to_numpy()):
                    entry[rows], distance[rows] = nearest(parts, codebook[position])
                yield pa.RecordBatch.from_arrays(
                    [*some.columns, pa.array(entry), pa.array(distance)],
                    names=["row", "position", "entry", "part", "new_entry", "distance"],
                )
        release_memory()

    return of_batches


def _member_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums and counts of the members an owner's task holds: one row per (position, entry) of the task."""
    sums: dict[tuple[int, int], list] = {}
    for batch in batches:
        position, entry = batch.column(1).to_numpy(), batch.column(2).to_numpy()
        for p, rows, parts in _of_position(batch, position):
            order = np.argsort(entry[rows], kind="stable")
            found, first = np.unique(entry[rows][order], return_index=True)
            if parts.shape[1]:
                totals = np.add.reduceat(parts[order].astype(np.int64), first, axis=0).tolist()
            else:
                totals = [[] for _ in found]
            counts = np.diff([*first, len(rows)]).tolist()
            for e, total, n in zip(found.tolist(), totals, counts):
                known = sums.setdefault((p, e), [[0] * len(total), 0])
                known[0] = [a + b for a, b in zip(known[0], total)]
                known[1] += n
    rows = [(p, e, i, value, n) for (p, e), (total, n) in sums.items() for i, value in enumerate(total)]
    columns = list(zip(*rows)) or [()] * 5
    kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64())
    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["position", "entry", "i", "total", "n"])


def _updated(members: DataFrame, codebook: Codebook) -> Codebook:
    """Each entry's members' componentwise floor(sum / count); an entry without members stays.

    Every task sums the members resident in it; one row per component of the codebook reaches the driver.
    """
    summed = members.mapInArrow(_member_sums, "position int, entry int, i int, total long, n long")
    wide = F.sum(F.col("total").cast("decimal(38,0)"))
    means = summed.groupBy("position", "entry", "i").agg(wide.alias("total"), F.sum("n").alias("n"))
    new = [entries.copy() for entries in codebook]
    for position, entry, i, total, n in means.collect():
        new[position][entry, i] = int(total) // n
    return new


def codebooks_digest(codebook: Codebook) -> str:
    listed = ",".join(str(value) for entries in codebook for value in entries.reshape(-1).tolist())
    return hashlib.sha256(listed.encode()).hexdigest()


def train(vectors: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2) -> tuple[Codebook, DataFrame]:
    """Codebooks of `vectors` (row, vec_id, v; stored) and (row, position, entry, distance) of every part by them.

    The codebook of a position starts as that part of the vectors with the smallest `entries` vec_ids, ascending (NULL
    ids last, equal ids by their components). A member is a part of a vector; it is shuffled once to the owner of its
    entry, a task that holds a (position, entry, salt), and stored there. In each round the owners sum their resident
    members into new entries; then every owner judges its members by the new codebook where they are. Those whose entry
    is the same stay in the files they are in, and only the others migrate, in that round's shuffle, to their new owner's.
    The salt is a hash of the row, so that an entry that holds most of the parts of a position has as many owners as the
    session has shuffle partitions. The codebook, entries * width integers, is all that reaches the driver and goes back.
    """
    spark = vectors.sparkSession
    seeds = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).select("v").collect()
    width = len(seeds[0][0]) if seeds else 0
    first = np.array([row[0] for row in seeds if len(row[0]) == width], dtype=np.int64).reshape(-1, width)
    cuts = _bounds(width, parts)
    codebook = [np.ascontiguousarray(first[:, a:b]) for a, b in zip(cuts[:-1], cuts[1:])]
    if not seeds:
        return codebook, spark.createDataFrame([], "row long, position int, entry int, distance long")
    salts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    salt = F.pmod(F.xxhash64("row"), F.lit(salts))
    usable = vectors.where(F.size("v") == width).select("row", "v")
    placed = usable.mapInArrow(_first_assignment(codebook, width), _MEMBER)
    members = written(placed.repartition("position", "entry", salt), "members")
    for number in range(1, rounds + 1):
        codebook = _updated(members, codebook)
        judged = written(members.mapInArrow(_judge(codebook), _JUDGED), "judged")
        if number == rounds:  # the final assignment: no update follows that a migration would serve
            return codebook, judged.select("row", "position", F.col("new_entry").alias("entry"), "distance")
        stay = judged.where("entry = new_entry").select("row", "position", "entry", "part")
        change = judged.where("entry <> new_entry").select("row", "position", F.col("new_entry").alias("entry"), "part")
        members = stay.unionByName(written(change.repartition("position", "entry", salt), "migrated"))
    final = members.mapInArrow(_judge(codebook), _JUDGED)
    return codebook, final.select("row", "position", "entry", "distance")


def encode(vectors: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2, scale: int = 256) -> DataFrame:
    """(vec_id, label, code, error, label_error, codebooks_sha256) of every usable row of `vectors` (vec_id, embedding, label).

    `code` has two hex digits per part, the index of its entry; at most 256 entries. `error` is the sum of the parts'
    squared distances, `label_error` its sum over the rows of a label, rows without one together; both end at the
    largest long. Without a label column all rows are of one label. Rows that repeat, with or without an id, are coded
    each; vectors of another length than that with the smallest id cannot be compared and are left out; a width
    that `parts` does not divide is cut as evenly as can be. No usable rows give no rows. Further columns are not used.
    """
    if not 1 <= entries <= 256:
        raise ValueError("entries must be 1 to 256: a code has two hex digits per part.")
    kept = integer_vectors(vectors, scale)
    codebook, assigned = train(kept, parts, entries, rounds)
    digits = F.lower(F.lpad(F.hex("entry"), 2, "0"))
    listed = F.array_sort(F.collect_list(F.struct("position", digits.alias("digits"))))
    wide = F.sum(F.col("distance").cast("decimal(38,0)"))
    whole = assigned.groupBy("row").agg(
        F.concat_ws("", F.transform(listed, lambda one: one["digits"])).alias("code"),
        F.least(wide, F.lit(_LONG)).cast("long").alias("error"),
    )
    coded = written(kept.drop("v").join(whole, "row"), "codes")
    # A label may hold most of the rows, and there may be many labels: each sum meets its rows under several salts.
    sums = coded.groupBy("label").agg(
        F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(_LONG)).cast("long").alias("label_error")
    )
    salted = sums.select(
        F.col("label").alias("of_label"), "label_error", F.explode(F.sequence(F.lit(0), F.lit(_LABEL_SALTS - 1))).alias("salt")
    )
    rows = coded.withColumn("own_salt", F.pmod(F.xxhash64("row"), F.lit(_LABEL_SALTS)))
    met = rows.join(salted, F.col("label").eqNullSafe(F.col("of_label")) & (F.col("own_salt") == F.col("salt")))
    return met.select(
        "vec_id", "label", "code", "error", "label_error", F.lit(codebooks_digest(codebook)).alias("codebooks_sha256")
    )
