"""Exact top-k search by inner product: a kNN join over Voronoi cells that ships only the rows a bound cannot exclude."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stopmetrics.scratch import written

_BLOCK_ROWS = 20_000  # rows of a cell that one task compares at a time
_BLOCK_QUERIES = 2_000
_STEP = 4096


def quantized(vectors: DataFrame, scale: int = 64) -> DataFrame:
    """(vec_id, v) with v the components floor(scale * x) as packed longs; unusable vectors are left out.

    A vector that is NULL, empty, or holds a NULL or non-finite component is unusable, as is a row without vec_id.
    """

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, packed = [], []
            for vec_id, vector in zip(batch.column(0).to_pylist(), batch.column(1)):
                values = vector.values if vector.is_valid else None
                if vec_id is None or values is None or not len(values) or values.null_count:
                    continue
                x = np.floor(scale * values.to_numpy(zero_copy_only=False).astype(np.float64))
                if np.isfinite(x).all():
                    ids.append(vec_id)
                    packed.append(x.astype("<i8").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(packed, pa.binary())], ["vec_id", "v"])

    chosen = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"))
    return chosen.mapInArrow(of_batches, "vec_id long, v binary")


def _matrix(packed: list[bytes], width: int) -> np.ndarray:
    """Rows of longs; shorter vectors end in zeros."""
    return np.frombuffer(b"".join(one.ljust(8 * width, b"\0") for one in packed), dtype="<i8").reshape(-1, width)


class _Cells:
    """The pivots, and what is known of each query group: its radius and the score its queries reach at least."""

    def __init__(self, pivots: np.ndarray) -> None:
        self.pivots = pivots.astype(np.float64)
        self.squares = (self.pivots**2).sum(axis=1)
        self.radius = np.zeros(len(pivots))
        self.floor = np.full(len(pivots), np.inf)  # no queries: nothing is needed

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cell = (self.squares - 2 * (x @ self.pivots.T)).argmin(axis=1)
        return cell, np.sqrt(((x - self.pivots[cell]) ** 2).sum(axis=1))

    def bounds(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest inner product of each row with any query of each group; a margin covers rounding."""
        middle = x @ self.pivots.T
        norm = np.sqrt((x**2).sum(axis=1))[:, None]
        reach = norm * self.radius + 1e-9 * (1 + np.abs(middle) + norm * (self.radius + np.sqrt(self.squares)))
        return middle - reach, middle + reach


def _assign(cells: _Cells, width: int):
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cell, distance = cells.nearest(_matrix(batch.column(1).to_pylist(), width).astype(np.float64))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(cell.astype(np.int32)), pa.array(distance)],
                    ["vec_id", "v", "cell", "distance"],
                )

    return of_batches


def _best_floors(cells: _Cells, width: int, most: int):
    """Per task and group the `most` greatest lower bounds met; few numbers, however many rows."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = np.full((most, len(cells.pivots)), -np.inf)
        for batch in batches:
            x = _matrix(batch.column(0).to_pylist(), width).astype(np.float64)
            for at in range(0, len(x), _STEP):
                low, _ = cells.bounds(x[at : at + _STEP])
                best = -np.sort(-np.vstack([best, low]), axis=0)[:most]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(cells.pivots), dtype=np.int32)), pa.array(list(best.T))], ["cell", "low"]
        )

    return of_batches


def _replicate(cells: _Cells, width: int):
    """A row per vector and group that may need it."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _STEP):
                part = batch.slice(at, _STEP)
                _, high = cells.bounds(_matrix(part.column(1).to_pylist(), width).astype(np.float64))
                row, group = np.nonzero(high >= cells.floor)
                taken = part.take(pa.array(row))
                yield pa.RecordBatch.from_arrays(
                    [*taken.columns, pa.array(group.astype(np.int32))], ["vec_id", "v", "cell"]
                )

    return of_batches


def _scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    if float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * q.shape[1] < 2**53:
        return (q.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64)
    return q @ x.T


def _solve(width: int, k: int):
    def of_group(table: pa.Table) -> pa.Table:
        is_query = table.column("is_query").to_numpy()
        ids = table.column("vec_id").to_numpy()
        values = _matrix(table.column("v").to_pylist(), width)
        q_ids, q, x_ids, x = ids[is_query], values[is_query], ids[~is_query], values[~is_query]
        order = np.argsort(x_ids, kind="stable")
        x_ids, x = x_ids[order], x[order]
        found: list[list[np.ndarray]] = [[], [], []]
        for at in range(0, len(q) if len(x) else 0, 64):
            score = _scores(q[at : at + 64], x)
            for query, row in zip(q_ids[at : at + 64], score):
                keep = x_ids != query
                own, names = row[keep], x_ids[keep]
                if len(own) > k:  # everything that ties with the k-th takes part in the sort
                    close = own >= np.partition(own, len(own) - k)[len(own) - k]
                    own, names = own[close], names[close]
                top = np.lexsort((names, -own))[:k]
                found[0].append(np.full(len(top), query))
                found[1].append(names[top])
                found[2].append(own[top])
        columns = [np.concatenate(part) if part else np.zeros(0, np.int64) for part in found]
        return pa.table([pa.array(column, pa.int64()) for column in columns], ["query_id", "vec_id", "score"])

    return of_group


def top_k(vectors: DataFrame, is_query: Column, k: int = 20, scale: int = 64, pivots: int = 64) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query row its `k` greatest integer inner products with other rows.

    `vectors` has vec_id and embedding; further columns may serve in `is_query` over vec_id only. Components become
    floor(scale * x). Ties go to the smaller vec_id. Candidates are all usable rows with another vec_id than the
    query's; of several query rows with one vec_id the first by its packed components counts. Vectors of different
    length compare as if the shorter ended in zeros. Fewer than `k` candidates are all returned; no usable rows give
    no rows.

    `pivots` rows, taken by a hash of their id, split space into Voronoi cells, and the queries into groups. Each group
    gets, from lower bounds to all rows, a score that each of its queries reaches k times; a row goes to the group only
    if its upper bound reaches that score. Within a group, blocks of rows by hash meet blocks of queries, so neither a
    cell that holds most rows nor a group that holds most queries lands in one task.
    """
    spark = vectors.sparkSession
    rows = written(quantized(vectors, scale).withColumn("is_query", F.coalesce(is_query, F.lit(False))), "vectors")
    width = (rows.agg(F.max(F.length("v"))).first()[0] or 8) // 8
    chosen = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(pivots).select("v").collect()
    cells = _Cells(np.unique(_matrix([row[0] for row in chosen] or [b""], width), axis=0))
    queries = rows.where("is_query").groupBy("vec_id").agg(F.min("v").alias("v"))
    schema = "vec_id long, v binary, cell int, distance double"
    grouped = written(queries.mapInArrow(_assign(cells, width), schema), "queries")
    groups = {r[0]: r for r in grouped.groupBy("cell").agg(F.max("distance"), F.count(F.lit(1))).collect()}
    for cell, (_, radius, _) in groups.items():
        cells.radius[cell] = radius * (1 + 1e-9)

    lows = rows.select("v").mapInArrow(_best_floors(cells, width, k + 1), "cell int, low array<double>")
    merged = F.slice(F.sort_array(F.flatten(F.collect_list("low")), asc=False), k + 1, 1)
    for cell, low in lows.groupBy("cell").agg(merged).collect():
        if cell in groups:
            cells.floor[cell] = low[0] if low else -np.inf

    sent = rows.select("vec_id", "v").mapInArrow(_replicate(cells, width), "vec_id long, v binary, cell int")
    sent = written(sent, "replicas")
    plan = spark.createDataFrame(
        [
            (cell, max(1, -(-n // _BLOCK_ROWS)), -(-groups[cell][2] // _BLOCK_QUERIES))
            for cell, n in sent.groupBy("cell").count().collect()
        ],
        "cell int, row_blocks int, query_blocks int",
    )

    def block(count: str) -> Column:
        return F.pmod(F.xxhash64("vec_id"), F.col(count)).cast("int")

    def every(count: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    planned = F.broadcast(plan)  # one row per pivot
    data = sent.join(planned, "cell").withColumn("row_block", block("row_blocks"))
    data = data.withColumn("query_block", every("query_blocks")).withColumn("is_query", F.lit(False))
    asked = grouped.join(planned, "cell").withColumn("query_block", block("query_blocks"))
    asked = asked.withColumn("row_block", every("row_blocks")).withColumn("is_query", F.lit(True))
    names = ["cell", "row_block", "query_block", "is_query", "vec_id", "v"]
    blocks = data.select(names).unionByName(asked.select(names)).groupBy("cell", "row_block", "query_block")
    partial = blocks.applyInArrow(_solve(width, k), "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = partial.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
