"""Exact inner-product search by branch and bound over columns of vector components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lingofold.session import ship_package, stage_table

SCALE = 1024
DIM_BLOCK = 8
ROW_BLOCK = 2048
QUERY_BLOCK = 256
#: Queries that travel to the tasks at once; a larger query set takes several passes.
GROUP_BYTES = 32 << 20
#: Share of pairs still alive from which on they are kept as a list instead of a matrix.
SPARSE_SHARE = 0.2
PAIR_STEP = 1 << 16
EXACT = float(1 << 53)
MOST_MASS = float(1 << 62)
FOUND = "query_id long, vec_id long, score long"


def column_blocks(batch: pa.RecordBatch, scale: int, rows: int) -> Iterator[tuple]:
    """(ids, null ids, columns) for at most ``rows`` vectors of one length: component j is row j."""
    ids, lists = batch.column(0), batch.column(1)
    null_id = np.asarray(ids.is_null())
    ids = ids.fill_null(np.iinfo(np.int64).max).to_numpy()
    ends = lists.offsets.to_numpy()
    values = lists.values.to_numpy(zero_copy_only=False).astype(np.float64)
    with np.errstate(over="ignore", invalid="ignore"):
        values = np.floor(values * scale)
    spoilt = np.concatenate(([0], np.cumsum(~np.isfinite(values))))
    usable = (spoilt[ends[1:]] == spoilt[ends[:-1]]) & ~np.asarray(lists.is_null())
    lengths = np.diff(ends)
    for dims in np.unique(lengths[usable]):
        own = np.flatnonzero(usable & (lengths == dims))
        for start in range(0, len(own), rows):
            part = own[start : start + rows]
            matrix = values[ends[part][:, None] + np.arange(dims)]
            fits = np.einsum("ij,ij->i", matrix, matrix) < MOST_MASS
            part, matrix = part[fits], matrix[fits]
            if len(part):
                yield ids[part], null_id[part], np.ascontiguousarray(matrix.T)


def rest_mass(columns: np.ndarray) -> np.ndarray:
    """Row j: norms of what is left of the vectors from component j on."""
    squares = np.zeros((len(columns) + 1, columns.shape[1]))
    squares[:-1] = np.cumsum((columns * columns)[::-1], axis=0)[::-1]
    return np.sqrt(squares)


class QueryBlock:
    """Queries of one length with the best ``k`` candidates that this task has met.

    ``floor`` is a score that the k-th best of a query is known to reach (-inf: none known).
    """

    def __init__(self, ids: np.ndarray, columns: np.ndarray, floor: np.ndarray, k: int):
        self.ids, self.columns, self.floor, self.k = ids, columns, floor.copy(), k
        self.energy = np.einsum("ij,ij->i", columns, columns)
        self.most = float(np.einsum("ij,ij->j", columns, columns).max(initial=0))
        none = np.zeros(0, dtype=np.int64)
        self.best = (none, none, none, none)  # query number, score, id, null id
        self.pairs = self.finished = 0

    def meet(self, ids: np.ndarray, null_id: np.ndarray, columns: np.ndarray) -> None:
        """Search one block of candidates; those with a query's own id are left out for it."""
        energy = self.energy * np.einsum("ij,ij->i", columns, columns)
        order = np.argsort(-energy, kind="stable")
        ours, theirs = self.columns[order], columns[order]
        slack = 1.0
        if max(self.most, float(np.einsum("ij,ij->j", columns, columns).max(initial=0))) >= EXACT:
            slack = 4096.0  # bounds are floats, sums stay exact in whole numbers
            ours, theirs = ours.astype(np.int64), theirs.astype(np.int64)
        q_rest, c_rest = rest_mass(self.columns[order]), rest_mass(columns[order])
        own = (self.ids[:, None] == ids) & ~null_id
        self.pairs += own.size

        cols = np.arange(len(ids))
        sums = np.zeros((len(self.ids), len(ids)), dtype=ours.dtype)
        at, dims, pairs = 0, len(order), None
        rising = np.isneginf(self.floor).any()
        while at < dims and pairs is None and len(cols):
            sums = sums + ours[at : at + DIM_BLOCK].T @ theirs[at : at + DIM_BLOCK, cols]
            at = min(dims, at + DIM_BLOCK)
            reach = q_rest[at][:, None] * c_rest[at][cols] * (1 + 1e-9) + slack
            if rising:
                self._raise_floor(np.where(own[:, cols], -np.inf, sums - reach))
            alive = (sums + reach >= self.floor[:, None]) & ~own[:, cols]
            if at == dims or alive.sum() < SPARSE_SHARE * alive.size:
                pairs = np.nonzero(alive)
            else:
                some = alive.any(axis=0)
                cols, sums = cols[some], sums[:, some]
        if pairs is None:
            pairs = np.nonzero(~own[:, cols])
        q, c, score = pairs[0], cols[pairs[1]], sums[pairs]
        while at < dims and len(q):
            end = min(dims, at + DIM_BLOCK)
            for start in range(0, len(q), PAIR_STEP):
                part = slice(start, start + PAIR_STEP)
                score[part] += np.einsum("ij,ij->j", ours[at:end, q[part]], theirs[at:end, c[part]])
            at = end
            reach = q_rest[at][q] * c_rest[at][c] * (1 + 1e-9) + slack
            alive = score + reach >= self.floor[q]
            q, c, score = q[alive], c[alive], score[alive]
        self.finished += len(q)
        self._keep(q, score.astype(np.int64), ids[c], null_id[c].astype(np.int64))

    def _raise_floor(self, lower: np.ndarray) -> None:
        if lower.shape[1] >= self.k:
            self.floor = np.maximum(self.floor, np.partition(lower, -self.k, axis=1)[:, -self.k])

    def _keep(self, *found: np.ndarray) -> None:
        q, score, ids, null_id = (np.concatenate(x) for x in zip(self.best, found))
        order = np.lexsort((ids, null_id, -score, q))
        q, score, ids, null_id = q[order], score[order], ids[order], null_id[order]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        kept = place < self.k
        self.best = (q[kept], score[kept], ids[kept], null_id[kept])
        last = place == self.k - 1
        self.floor[q[last]] = np.maximum(self.floor[q[last]], score[last])


def _search(rows: DataFrame, group: list[tuple], k: int, scale: int) -> DataFrame:
    """The best ``k`` candidates that each task finds among its own rows."""
    shared = rows.sparkSession.sparkContext.broadcast(group)
    names = [f.split()[0] for f in FOUND.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = [QueryBlock(*own, k) for own in shared.value]
        for batch in batches:
            for ids, null_id, columns in column_blocks(batch, scale, ROW_BLOCK):
                for block in blocks:
                    if len(block.columns) == len(columns):
                        block.meet(ids, null_id, columns)
        for block in blocks:
            q, score, ids, null_id = block.best
            found = (block.ids[q], pa.array(ids, mask=null_id.astype(bool)), score)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], names=names)

    return rows.mapInArrow(run, FOUND)


def _group(queries: DataFrame, floors: dict[int, float], scale: int) -> list[tuple]:
    blocks = []
    for batch in queries.toArrow().combine_chunks().to_batches():
        for ids, _, columns in column_blocks(batch, scale, QUERY_BLOCK):
            blocks.append((ids, columns, np.array([floors.get(int(i), -np.inf) for i in ids])))
    return blocks


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int = 10, scale: int = SCALE, id_col: str = "vec_id",
    vector_col: str = "embedding", group_bytes: int = GROUP_BYTES,
) -> DataFrame:
    """The ``k`` rows of ``vectors`` with the largest inner product for every row of ``queries``:
    query_id, rank (from 1), vec_id, score. Ties go to the smaller id, null ids come last.

    A component x counts as floor(scale * x) and the score is a whole number. Vectors that are null
    or hold null or non-finite components take no part, nor do those whose squared components sum
    to 2^62 or more (their products may not be longs). Only vectors of equal length meet; empty ones
    score 0 with each other. Rows with a query's id are its own and no candidates for it; other
    repeated rows are candidates each. Of several queries with one id the smallest vector asks;
    queries without an id are left out. A query without candidates has no row; empty tables give no
    rows; other columns are not read.

    Candidates stay where they are scanned. Each task turns its rows into columns and adds up
    products ``DIM_BLOCK`` components at a time, those with the most mass first. What the rest can
    still add is at most the product of the two remaining norms, so pairs that cannot reach the
    k-th best known score are dropped between the steps and the survivors are compacted. A first
    search among the queries themselves gives that score, so what tasks emit does not grow with
    their number. Queries go out in groups of about ``group_bytes``, with one pass for each.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    rows = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector")
    )
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    asked = queries.select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector")
    ).where(F.col("vec_id").isNotNull() & finite)
    asked = stage_table(asked.groupBy("vec_id").agg(F.min("vector").alias("vector")), "topk-queries")
    width = asked.agg(F.sum(F.size("vector") * 8 + 32).alias("bytes")).first()["bytes"] or 0
    groups = -(-width // group_bytes)
    passes = []
    for number in range(groups):
        own = asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(groups)) == number) if groups > 1 else asked
        seeds = _best(_search(asked, _group(own, {}, scale), k, scale), k).where(F.col("rank") == k)
        floors = {r["query_id"]: float(r["score"]) for r in seeds.collect()}  # one per query of the group
        found = _best(_search(rows, _group(own, floors, scale), k, scale), k)
        passes.append(found if groups == 1 else stage_table(found, "topk-pass"))
    if not passes:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    out = passes[0]
    for found in passes[1:]:
        out = out.unionByName(found)
    return out
