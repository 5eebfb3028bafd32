"""Operator 11: exact Lloyd clustering of integer vectors by Shallot search.

A vector keeps its centroid, its second-nearest centroid, an upper bound of the distance to the
first and a lower bound of the distance to all others; the bounds follow the centroids' moves. When
they do not prove that the vector stays, both remembered centroids are measured and the scan starts
from the closer one: the other centroids come in order of their distance from it, and the scan
ends at the first that lies outside a ball whose radius (distance to the start plus distance to the
second best so far) shrinks as better ones are found. Distances that decide are integers, so
equal distances are seen as equal and go to the smaller number.

Rounds read and write a table (vector, its two centroids, bounds) without a shuffle; only the
centroids (at most ``clusters`` of them) and their sums pass through the driver. The sums are added
up in every task, then by cluster and component. A round's table is dropped when the next is written.

Results: rows without exactly ``dims`` components, or with a null, NaN or infinite one, or a null
vector, are left out. Fewer rows than ``clusters`` give as many centroids as rows. Repeated rows are
rows of their own; among equal ids the smaller vector is the first to become a centroid, a null id
counts as empty text. An empty centroid stays where it is. An empty table gives no rows. Other
columns are not read. A component beyond LARGEST / 256 is an error, since squared distances of
such vectors may not fit in 64 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import discard, materialize

SCALE, LARGEST = 256, 1 << 27
#: relative slack of comparisons of floating-point bounds
SLACK = 1e-9
#: vectors that a task works on at once
SLICE_ROWS = 16_384
STATE = "vec_id long, v array<int>, a int, b int, u double, l double"


@dataclass(frozen=True)
class Search:
    """Centroids of a round, what they are apart, and how far they moved since the last round."""

    centroids: np.ndarray
    order: np.ndarray
    apart: np.ndarray
    moved: np.ndarray
    others_moved: np.ndarray

    @classmethod
    def of(cls, centroids: np.ndarray, before: np.ndarray | None = None) -> Search:
        k = len(centroids)
        apart = np.sqrt(np.array([squared(centroids, c) for c in centroids], np.float64).reshape(k, k))
        np.fill_diagonal(apart, np.inf)
        order = np.argsort(apart, axis=1, kind="stable")[:, :max(k - 1, 0)]
        moved = np.zeros(k) if before is None else np.sqrt(squared(centroids, before).astype(np.float64))
        others = np.array([np.delete(moved, j).max(initial=0.0) for j in range(k)])
        return cls(centroids, order, np.take_along_axis(apart, order, 1), moved, others)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = a - b
    return np.einsum("ij,ij->i", d, d)


def integer_vectors(table: DataFrame, id_col: str, vector_col: str, dims: int) -> DataFrame:
    """(vec_id, v): floor(SCALE * x) of the rows that count."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = pc.fill_null(pc.equal(pc.list_value_length(batch.column(1)), dims), False)
            batch = batch.filter(whole)
            if not batch.num_rows:
                continue
            x = pc.list_flatten(batch.column(1)).to_numpy(zero_copy_only=False).reshape(-1, dims)
            fine = np.isfinite(x).all(axis=1)
            v = np.floor(SCALE * x[fine])
            if (np.abs(v) > LARGEST).any():
                raise ValueError(f"a component is beyond {LARGEST // SCALE}: squared distances may not fit in 64 bits")
            yield _batch([batch.column(0).filter(pa.array(fine)), _lists(v.astype(np.int32))], ["vec_id", "v"])

    rows = table.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    return rows.mapInArrow(run, "vec_id long, v array<int>")


def _batch(columns: list, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names)


def _lists(v: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(np.arange(len(v) + 1, dtype=np.int32) * v.shape[1], pa.array(v.ravel()))


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for whole in batches:
        for at in range(0, whole.num_rows, SLICE_ROWS):
            batch = whole.slice(at, SLICE_ROWS)
            yield batch, pc.list_flatten(batch.column("v")).to_numpy().reshape(batch.num_rows, -1).astype(np.int64)


def nearest(search: Search, v: np.ndarray, a: np.ndarray, b: np.ndarray, u: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, ...]:
    """Nearest and second-nearest centroids and bounds of a slice, from those of the round before."""
    k = len(search.centroids)
    a, b, u, low = a.copy(), b.copy(), u + search.moved[a], low - search.others_moved[a]
    if k == 1:
        return a, b, u, low

    def proved(rows: np.ndarray) -> np.ndarray:
        safe = np.maximum(low[rows], search.apart[a[rows], 0] / 2)
        return u[rows] * (1 + SLACK) < safe * (1 - SLACK)

    every = np.arange(len(v))
    rows = every[~proved(every)]
    first = squared(v[rows], search.centroids[a[rows]])
    u[rows] = np.sqrt(first)
    still = ~proved(rows)
    rows, first = rows[still], first[still]
    second = squared(v[rows], search.centroids[b[rows]])
    swap = (second < first) | ((second == first) & (b[rows] < a[rows]))
    a[rows[swap]], b[rows[swap]] = b[rows[swap]], a[rows[swap]]
    first, second = np.where(swap, second, first), np.where(swap, first, second)
    start, other = a[rows], b[rows].copy()
    to_start = np.sqrt(first)
    for c in np.unique(start):
        live = np.flatnonzero(start == c)  # positions in rows
        for j, far in zip(search.order[c], search.apart[c]):
            live = live[far * (1 - SLACK) <= (to_start[live] + np.sqrt(second[live])) * (1 + SLACK)]
            if not len(live):
                break
            new = live[other[live] != j]
            d = squared(v[rows[new]], search.centroids[j])
            r = rows[new]
            best = (d < first[new]) | ((d == first[new]) & (j < a[r]))
            next_best = ~best & (d < second[new])
            second[new[best]], b[r[best]] = first[new[best]], a[r[best]]
            first[new[best]], a[r[best]] = d[best], j
            second[new[next_best]], b[r[next_best]] = d[next_best], j
    u[rows], low[rows] = np.sqrt(first), np.sqrt(second)
    return a, b, u, low


def _assign(state: DataFrame, search: Search) -> DataFrame:
    shared = state.sparkSession.sparkContext.broadcast(search)  # clusters x (dims + 2 clusters) numbers
    fresh = "a" not in state.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, v in _slices(batches):
            n = len(v)
            old = ((np.zeros(n, np.int64), np.full(n, min(1, len(shared.value.centroids) - 1)), np.full(n, np.inf), np.full(n, -np.inf)) if fresh
                   else tuple(batch.column(c).to_numpy() for c in "abul"))
            a, b, u, low = nearest(shared.value, v, *old)
            yield _batch([batch.column("vec_id"), batch.column("v"), a.astype(np.int32), b.astype(np.int32), u, low], ["vec_id", "v", "a", "b", "u", "l"])

    return materialize(state.mapInArrow(run, STATE), "clusters")


def _means(state: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """floor(sum / count) of every cluster and component; an empty cluster keeps its centroid."""
    k, dims = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((k, dims + 1), np.int64)
        for batch, v in _slices(batches):
            a = batch.column("a").to_numpy()
            order = np.argsort(a, kind="stable")
            held, begin = np.unique(a[order], return_index=True)
            sums[held, :dims] += np.add.reduceat(v[order], begin, axis=0)
            sums[:, dims] += np.bincount(a, minlength=k)
        c, p = np.nonzero(sums)
        yield _batch([c.astype(np.int32), p.astype(np.int32), sums[c, p]], ["c", "p", "s"])

    total = np.zeros((k, dims + 1), np.int64)
    for c, p, s in state.select("a", "v").mapInArrow(run, "c int, p int, s long").groupBy("c", "p").agg(F.sum("s")).collect():
        total[c, p] = s  # clusters x dims rows at most
    n = total[:, dims:]
    return np.where(n > 0, total[:, :dims] // np.maximum(n, 1), centroids)


def cluster(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", dims: int = 64,
            clusters: int = 40, rounds: int = 5, seed: int = 2) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every vector that counts."""
    spark = table.sparkSession
    state = materialize(integer_vectors(table, id_col, vector_col, dims), "vectors")
    rank = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    chosen = state.select(rank.alias("h"), "v").orderBy("h", "v").limit(clusters).collect()
    schema = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    if not chosen:
        return spark.createDataFrame([], schema)
    centroids = np.array([r["v"] for r in chosen], np.int64)
    search = Search.of(centroids)
    for turn in range(rounds + 1):
        before, state = state, _assign(state, search)
        discard(before)
        if turn < rounds:
            moved = _means(state, centroids)
            search, centroids = Search.of(moved, centroids), moved
    shared = spark.sparkContext.broadcast(centroids)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, v in _slices(batches):
            yield _batch([batch.column("vec_id"), batch.column("a"), squared(v, shared.value[batch.column("a").to_numpy()])], ["vec_id", "cluster", "distance"])

    out = materialize(state.mapInArrow(measure, "vec_id long, cluster int, distance long"), "distances")
    discard(state)
    sums = {r["cluster"]: r["s"] for r in out.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    rows = [(j, s, sum(sums.values()), hashlib.sha256(",".join(map(str, centroids[j].tolist())).encode()).hexdigest()) for j, s in sums.items()]
    by_cluster = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return out.join(F.broadcast(by_cluster), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
