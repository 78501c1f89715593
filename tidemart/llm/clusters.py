"""Centroid clustering over zone maps along a Hilbert curve.

Vectors of integers are ordered by a Hilbert curve through all their dimensions and cut into blocks,
each with the least and largest value of every component and the sum of its vectors. Which centroids
can be nearest to some vector of a block follows from its box alone: over a box the difference of
the squared distances to two centroids has an exact minimum. A block with one candidate is assigned
without reading its vectors; the others compare their vectors with their candidates, exactly.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.shared import saved, small_batches

BLOCK = 128
BITS = 4                # of the curve, per component
MOST = 1 << 27          # of a component: a squared distance of 64 of them fits 63 bits
BLOCKS = ("low array<bigint>, high array<bigint>, total array<bigint>, ids array<bigint>, "
          "vectors binary")


def whole_numbers(vectors: DataFrame, key: str, vector: str, width: int, scale: int) -> DataFrame:
    """(vec_id, v): floor(scale * x) of vectors with `width` components, none null or non-finite."""
    x = F.col("x")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    rows = vectors.select(F.col(f"`{key}`").cast("bigint").alias("vec_id"),
                          F.col(f"`{vector}`").cast("array<double>").alias("x"))
    large = F.exists(x, lambda c: F.abs(c) * scale > float(MOST))
    said = F.raise_error(F.lit(f"a component is larger than {MOST} / {scale}")).cast("array<bigint>")
    return rows.where(F.size(x) == width).where(~bad).select("vec_id", F.when(large, said).otherwise(
        F.transform(x, lambda c: F.floor(c * F.lit(float(scale))).cast("bigint"))).alias("v"))


def hilbert(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Places on the curve of cells (rows of numbers below 2 ** bits), as rows of bytes in order."""
    x = cells.T.astype(np.uint32)
    n = len(x)
    for level in range(bits - 1, 0, -1):
        q, p = np.uint32(1 << level), np.uint32((1 << level) - 1)
        for i in range(n):      # turn the lower bits as the curve turns in this half
            hit = (x[i] & q) != 0
            swap = np.where(hit, 0, (x[0] ^ x[i]) & p).astype(np.uint32)
            x[0] ^= np.where(hit, p, swap)
            x[i] ^= swap
    for i in range(1, n):       # Gray code
        x[i] ^= x[i - 1]
    turn = np.zeros(x.shape[1], np.uint32)
    for level in range(bits - 1, 0, -1):
        turn ^= np.where((x[n - 1] >> np.uint32(level)) & 1, (1 << level) - 1, 0).astype(np.uint32)
    x ^= turn
    planes = [(x >> np.uint32(b)) & 1 for b in range(bits - 1, -1, -1)]
    return np.packbits(np.concatenate(planes).T.astype(np.uint8), axis=1)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), width)


def _spread(rows: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of each component; one row for each reaches the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = _matrix(batch.column(0), width).astype(float)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(width)), pa.array(np.full(width, float(len(v)))),
                 pa.array(v.sum(0)), pa.array((v * v).sum(0))], names=["place", "n", "s", "q"])

    sums = rows.select("v").mapInArrow(run, "place bigint, n double, s double, q double").groupBy(
        "place").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q"))
    found = np.array([tuple(r)[1:] for r in sums.orderBy("place").collect()])
    mean = found[:, 1] / found[:, 0]
    return mean, np.sqrt(np.maximum(found[:, 2] / found[:, 0] - mean ** 2, 0)) + 1e-9


def in_blocks(rows: DataFrame, width: int, block: int = BLOCK) -> DataFrame:
    """The vectors of `whole_numbers` along the curve, `block` of them to a row of `BLOCKS`.

    The curve's cells reach two deviations to both sides of the mean, the outermost ones further.
    Equal vectors may end in several blocks: rows are ordered by place, then by number.
    """
    mean, deviation = _spread(rows, width)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = _matrix(batch.column(2), width)
            cells = np.floor(((v - mean) / (4 * deviation) + 0.5) * (1 << BITS))
            keys = hilbert(np.clip(cells, 0, (1 << BITS) - 1).astype(np.uint32))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([k.tobytes() for k in keys], pa.binary())],
                names=["row", "vec_id", "v", "place"])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left: list[pa.RecordBatch] = []
        for batch in batches:
            left.append(batch)
            table = pa.Table.from_batches(left)
            whole = len(table) // block * block
            for at in range(0, whole, block):
                yield _block(table.slice(at, block), width)
            left = table.slice(whole).combine_chunks().to_batches()
        if left:
            yield _block(pa.Table.from_batches(left), width)

    numbered = rows.select(F.monotonically_increasing_id().alias("row"), "vec_id", "v")
    along = numbered.mapInArrow(placed, "row bigint, vec_id bigint, v array<bigint>, place binary")
    return along.repartitionByRange("place", "row").sortWithinPartitions("place", "row").select(
        "vec_id", "v").mapInArrow(packed, BLOCKS)


def _block(table: pa.Table, width: int) -> pa.RecordBatch:
    v = _matrix(table.column("v").combine_chunks(), width)
    edges = [pa.array([x.tolist()], pa.list_(pa.int64())) for x in (v.min(0), v.max(0), v.sum(0))]
    return pa.RecordBatch.from_arrays(
        [*edges, pa.array([table.column("vec_id").to_pylist()], pa.list_(pa.int64())),
         pa.array([v.astype("<i4").tobytes()], pa.binary())],
        names=["low", "high", "total", "ids", "vectors"])


def candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Numbers of the centroids that may be nearest to a vector within the box, in order.

    One is left out if the centroid nearest to the middle of the box is nearer to all of the box, or
    as near and of a smaller number.
    """
    first = int(((2 * centroids - (low + high)) ** 2).sum(1).argmin())
    own = centroids[first]
    farthest = np.where(centroids > own, high, low)     # where the other one gains most
    least = (centroids ** 2 - own ** 2 - 2 * farthest * (centroids - own)).sum(1)
    number = np.arange(len(centroids))
    return number[(least < 0) | ((least == 0) & (number < first)) | (number == first)]


def nearest(vectors: np.ndarray, centroids: np.ndarray, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest of the centroids numbered `some` for each vector, and its squared distance."""
    found = np.stack([((vectors - centroids[c]) ** 2).sum(1) for c in some], axis=1)
    at = found.argmin(1)        # of equal ones the first, which is the smallest number
    return some[at], found[np.arange(len(found)), at]


def _values(column: pa.Array, i: int, width: int) -> np.ndarray:
    return np.frombuffer(column[i].as_buffer(), "<i4").reshape(-1, width).astype(np.int64)


def moved(blocks: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Each centroid's vectors' floored means; those without vectors stay.

    Tasks add up their blocks first; a sum for each centroid and component reaches the driver.
    """
    k, width = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((k, width + 1), np.int64)      # the last component counts
        for batch in batches:
            low, high, total = (_matrix(batch.column(i), width) for i in range(3))
            sizes = np.diff(batch.column(3).offsets.to_numpy())
            for i in range(len(batch)):
                some = candidates(low[i], high[i], centroids)
                if len(some) == 1:
                    sums[some[0], :-1] += total[i]
                    sums[some[0], -1] += sizes[i]
                    continue
                v = _values(batch.column(4), i, width)
                own, _ = nearest(v, centroids, some)
                for c in some:
                    sums[c, :-1] += v[own == c].sum(0)
                    sums[c, -1] += (own == c).sum()
        number, place = np.divmod(np.arange(sums.size), width + 1)
        yield pa.RecordBatch.from_arrays([pa.array(number), pa.array(place), pa.array(sums.ravel())],
                                         names=["number", "place", "value"])

    rows = small_batches(blocks).mapInArrow(run, "number bigint, place bigint, value bigint").groupBy(
        "number", "place").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect()
    sums = {(r["number"], r["place"]): int(r["value"]) for r in rows}
    return np.array([[sums[c, j] // sums[c, width] for j in range(width)]
                     if sums.get((c, width)) else centroids[c].tolist() for c in range(k)], np.int64)


def assigned(blocks: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(vec_id, cluster, distance) of every vector."""
    width = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low, high = (_matrix(batch.column(i), width) for i in range(2))
            found = [nearest(_values(batch.column(4), i, width), centroids,
                             candidates(low[i], high[i], centroids)) for i in range(len(batch))]
            if found:
                own, distance = map(np.concatenate, zip(*found))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(3).flatten(), pa.array(own, pa.int32()), pa.array(distance)],
                    names=["vec_id", "cluster", "distance"])

    return small_batches(blocks).mapInArrow(run, "vec_id bigint, cluster int, distance bigint")


def clustered(vectors: DataFrame, k: int = 8, rounds: int = 10, seed: str = "3", key: str = "vec_id",
              vector: str = "embedding", width: int = 64, scale: int = 1024,
              block: int = BLOCK) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of each vector.

    Vectors that are null, of another width, or hold null or non-finite components take no part; the
    others count as integers floor(scale * x). The first centroids are the k vectors with the least
    sha256 of `seed:vec_id`, then the least vector; rows without an id are taken last. With fewer
    vectors there are fewer centroids, with none no rows. Repeated rows each take part. Components
    beyond 2 ** 27 after scaling are an error, as are inertias beyond 63 bits.
    """
    if width * (2 * MOST) ** 2 >= 1 << 63:
        raise ValueError("distances of so many components may not fit 63 bits")
    rows = saved(whole_numbers(vectors, key, vector, width, scale), "vectors")
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = rows.orderBy(order.asc_nulls_last(), "v").limit(k).collect()
    schema = "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, " \
             "centroid_sha256 string"
    if not first:
        return vectors.sparkSession.createDataFrame([], schema)
    centroids = np.array([r["v"] for r in first], np.int64)
    blocks = saved(in_blocks(rows, width, block), "blocks")
    for _ in range(rounds):
        centroids = moved(blocks, centroids)
    found = saved(assigned(blocks, centroids), "assigned")
    sums = {r["cluster"]: int(r["d"]) for r in found.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()}
    facts = [(c, d, sum(sums.values()), hashlib.sha256(",".join(map(str, centroids[c])).encode())
              .hexdigest()) for c, d in sums.items()]
    known = vectors.sparkSession.createDataFrame(
        facts, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return found.join(F.broadcast(known), "cluster").select(     # at most k rows
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
