"""Approximate nearest neighbours by collision-counting hashing.

Each of m projections on a random direction is one sorted array. A query's window in it is centred
on the query's own projection and grows by virtual rehashing: no buckets are built again, the
window just reaches further. A vector that lies in enough of the m windows is verified.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.shared import saved
from tidemart.llm.vectors import in_blocks, nearest, proper

PROJECTIONS = 24
WIDTH = 2.719            # window of radius 1
RADIUS = 0.6             # first radius; points and queries have length 1
GROWTH = 1.2             # the next radius
QUERIES_AT_ONCE = 512    # whose counts are held together
MISS = 1.0               # deviations below its mean count at which a vector is still verified
SCHEMA = "query_row bigint, query_id bigint, vec_id bigint, score double"


def collision_threshold(m: int = PROJECTIONS, width: float = WIDTH, miss: float = MISS) -> int:
    """Windows that a vector at exactly the radius falls into, less `miss` standard deviations."""
    p = math.erf(width / 2 / math.sqrt(2))
    return max(1, math.floor(m * p - miss * math.sqrt(m * p * (1 - p))))


class Projections:
    """Sorted arrays of a block's projections."""

    def __init__(self, points: np.ndarray, m: int, seed: int):
        self.directions = np.random.default_rng(seed).standard_normal((points.shape[1], m))
        projected = points @ self.directions
        self.order = np.argsort(projected, axis=0, kind="stable").T.copy()
        self.values = np.take_along_axis(projected.T, self.order, axis=1)

    def windows(self, centres: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray]:
        """Where the windows centre +- reach begin and end, by query and projection."""
        low, high = np.empty(centres.shape, np.int32), np.empty(centres.shape, np.int32)
        for i, v in enumerate(self.values):
            low[:, i] = np.searchsorted(v, centres[:, i] - reach)
            high[:, i] = np.searchsorted(v, centres[:, i] + reach, side="right")
        return low, high

    def inside(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """How many of the stretches low to high hold each point; stretch i is of array i modulo m."""
        some = np.flatnonzero(low < high)
        held = [self.order[i % len(self.order), a:b] for i, a, b in zip(
            some.tolist(), low[some].tolist(), high[some].tolist())]
        return np.bincount(np.concatenate(held) if held else [], minlength=self.order.shape[1])


def grow(index: Projections, queries: np.ndarray, verify, k: int, threshold: int,
         radius: float = RADIUS, width: float = WIDTH, growth: float = GROWTH
         ) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each query points and scores, at least k of them if there are, by growing windows.

    `verify(query number, points)` gives (distances, scores). A query ends when k verified points lie
    within the radius whose windows have been counted in full, or when the windows hold everything.
    """
    m, n = index.order.shape
    centres = queries @ index.directions
    counts = np.zeros((len(queries), n), np.uint8)
    known = np.zeros((len(queries), n), bool)
    met = [([], [], []) for _ in queries]
    low, high = index.windows(centres, 0.0)
    high = low.copy()
    active = np.arange(len(queries))
    while len(active):
        a, b = index.windows(centres[active], width * radius / 2)
        a, b = np.minimum(a, low[active]), np.maximum(b, high[active])
        going = []
        for row, q in enumerate(active.tolist()):
            counts[q] += index.inside(np.concatenate([a[row], high[q]]),
                                      np.concatenate([low[q], b[row]])).astype(np.uint8)
            points, distances, scores = met[q]
            new = np.flatnonzero((counts[q] >= threshold) & ~known[q])
            if len(new):
                known[q, new] = True
                d, s = verify(q, new)
                points.append(new)
                distances.append(d)
                scores.append(s)
            whole = not a[row].any() and bool((b[row] == n).all())
            if not whole and sum(int((d <= radius).sum()) for d in distances) < k:
                going.append(q)
        low[active], high[active] = a, b
        active = np.array(going, np.int64)
        radius *= growth
    return [(np.concatenate(p), np.concatenate(s)) if p else (np.zeros(0, np.int64), np.zeros(0))
            for p, _, s in met]


def search_block(queries: np.ndarray, query_rows: np.ndarray, points: np.ndarray, rows: np.ndarray,
                 ids: np.ndarray, k: int, largest: float, m: int = PROJECTIONS, seed: int = 17
                 ) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each query its nearest of the block by inner product: (ids, scores), k at the most, its own
    row left out.

    Inner products order points as distances do once a coordinate brings all points to the length
    `largest`: |x - q|^2 = largest^2 + |q|^2 - 2 q.x, with queries scaled to that length too.
    """
    lengths = np.einsum("ij,ij->i", points, points)
    more = np.sqrt(np.maximum(largest ** 2 - lengths, 0.0))
    index = Projections(np.column_stack([points, more]) / largest, m, seed)
    norms = np.linalg.norm(queries, axis=1)
    threshold = collision_threshold(m)
    order = np.argsort(ids, kind="stable")
    place = np.empty(len(ids), np.int64)
    place[order] = np.arange(len(ids))

    def verify(q: int, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        scores = points.take(found, axis=0) @ queries[q]
        gap = np.sqrt(np.maximum(2 - 2 * scores / (norms[q] * largest), 0.0))
        return np.where(rows[found] == query_rows[q], np.inf, gap), scores

    out = []
    for at in range(0, len(queries), QUERIES_AT_ONCE):
        some = slice(at, at + QUERIES_AT_ONCE)
        lifted = np.column_stack([queries[some] / norms[some, None], np.zeros(len(norms[some]))])
        for q, (found, scores) in enumerate(grow(index, lifted, lambda q, f: verify(at + q, f), k,
                                                 threshold), at):
            other = rows[found] != query_rows[q]
            found, scores = found[other], scores[other]
            if len(found) > k:      # all that are about as near as the kth, then in order
                about = 1e-12 * norms[q] * largest
                found = found[scores >= np.partition(scores, -k)[-k] - about]
            # equal vectors get equal scores, wherever they stand
            scores = np.einsum("ij,j->i", points.take(found, axis=0), queries[q])
            best = np.lexsort((place[found], -scores))[:k]
            out.append((ids[found[best]], scores[best]))
    return out


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    values = column.combine_chunks()
    return values.flatten().to_numpy(zero_copy_only=False).reshape(len(values), -1)


def near(vectors: DataFrame, k: int = 20, every: int = 20, key: str = "vec_id",
         vector: str = "embedding", block: int = 8192, chunk: int = 4096, m: int = PROJECTIONS,
         seed: int = 17) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose id is divisible by `every`, the k other
    rows found nearest by inner product (double precision), ties to the smaller id. Every row is a
    candidate, and a query, of its own: rows that share an id meet each other.

    All rows are indexed, in blocks. Vectors that take no part: `proper`. Vectors meet others of
    their own length only. A query with fewer than k candidates gets all of them.
    """
    rows = saved(proper(vectors, key, vector).withColumn("size", F.size("v")), "vectors")
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    counts = rows.agg(F.count(F.lit(1)), F.count_if(F.col("vec_id") % every == 0),
                      F.max(length)).first()
    largest = float(counts[2] or 1.0)

    def search(queries: pa.Table, points: pa.Table) -> pa.Table:
        query_ids, query_rows = (queries.column(c).to_numpy() for c in ("vec_id", "row"))
        found = []
        if queries.num_rows and points.num_rows:
            found = search_block(_matrix(queries.column("v")), query_rows, _matrix(points.column("v")),
                                 points.column("row").to_numpy(), points.column("vec_id").to_numpy(),
                                 k, largest, m, seed)
        ids = np.concatenate([f[0] for f in found]) if found else np.zeros(0, np.int64)
        scores = np.concatenate([f[1] for f in found]) if found else np.zeros(0)
        owners = np.repeat(np.arange(len(found)), [len(f[0]) for f in found])
        return pa.table({"query_row": pa.array(query_rows[owners], pa.int64()),
                         "query_id": pa.array(query_ids[owners], pa.int64()), "vec_id": pa.array(ids, pa.int64()),
                         "score": pa.array(scores, pa.float64())})

    queries = rows.where(F.col("vec_id") % every == 0)
    found = in_blocks(rows, queries, search, SCHEMA, ["size"], -(-counts[0] // block) or 1,
                      -(-counts[1] // chunk) or 1)
    return nearest(found, k, F.col("score").desc(), F.col("vec_id")).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
