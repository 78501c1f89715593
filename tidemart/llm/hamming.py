"""Exact top-k by Hamming distance: multi-index hashing with growing search radii."""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.llm.shared import saved
from tidemart.llm.vectors import in_blocks, nearest, proper

WORD = 64
SEGMENT = 16
SCHEMA = "query_row bigint, query_id bigint, vec_id bigint, distance int"


@lru_cache(maxsize=SEGMENT + 1)
def flips(radius: int) -> np.ndarray:
    """Segment values with `radius` bits set."""
    return np.array([sum(1 << b for b in c) for c in combinations(range(SEGMENT), radius)],
                    np.int64)


class SegmentIndex:
    """For each segment of the codes, rows of words of 64 bits, the codes by its value."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.bits = codes.shape[1] * WORD
        self.segments = self.bits // SEGMENT
        parts = codes.view("<u2").reshape(-1, self.segments)
        self.order = np.argsort(parts, axis=0, kind="stable")
        self.starts = [np.searchsorted(parts[self.order[:, s], s], np.arange((1 << SEGMENT) + 1))
                       for s in range(self.segments)]

    def holding(self, segment: int, values: np.ndarray) -> np.ndarray:
        starts = self.starts[segment]
        low, n = starts[values], starts[values + 1] - starts[values]
        on = n > 0
        low, n = low[on], n[on]
        ends = np.cumsum(n)
        places = np.arange(ends[-1] if len(ends) else 0) + np.repeat(low - ends + n, n)
        return self.order[places, segment]

    def search(self, code: np.ndarray, k: int, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes and distances, all those up to the distance of the kth row.

        `weights`: rows of each code. After segments have been searched to radius r, every code at
        a distance up to segments * (r + 1) - 1 has been met, as it differs by at most r bits in some
        segment; the search ends when that covers the kth smallest distance so far.
        """
        parts = np.ascontiguousarray(code).view("<u2").astype(np.int64)
        known = np.zeros(len(self.codes), bool)
        rows_at = np.zeros(self.bits + 1, np.int64)
        found, distances = [], []
        for radius in range(SEGMENT + 1):
            for s in range(self.segments):
                met = self.holding(s, parts[s] ^ flips(radius))
                met = met[~known[met]]
                if len(met):
                    known[met] = True
                    d = np.bitwise_count(self.codes[met] ^ code).sum(1, dtype=np.int64)
                    found.append(met)
                    distances.append(d)
                    np.add.at(rows_at, d, weights[met])
            covered = self.segments * (radius + 1) - 1
            if rows_at[:covered + 1].sum() >= k:
                break
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(found), np.concatenate(distances).astype(np.int64)


def sign_code(words: int, vector: str = "v") -> Column:
    """An array of `words` numbers of 64 bits: bit i is 1 where component i is above 0. Components that a
    shorter vector lacks count as 0."""
    def bit(n: Column, i: int) -> Column:
        value = F.lit(1 << i if i < WORD - 1 else -(1 << WORD - 1)).cast("bigint")
        return F.when(F.get(F.col(vector), n * WORD + i) > 0, value).otherwise(F.lit(0).cast("bigint"))

    def word(n: Column) -> Column:
        code = F.lit(0).cast("bigint")
        for i in range(WORD):
            code = code.bitwiseOR(bit(n, i))
        return code

    return F.transform(F.sequence(F.lit(0), F.lit(words - 1)), word)


def _words(codes: DataFrame) -> DataFrame:
    """The rows with a number, `row`, if they have none, and with codes of one word as arrays."""
    if "row" not in codes.columns:
        codes = codes.withColumn("row", F.monotonically_increasing_id())
    code = F.col("code") if isinstance(codes.schema["code"].dataType, T.ArrayType) else F.array("code")
    return codes.select("row", "vec_id", code.alias("code"))


def top_k(codes: DataFrame, queries: DataFrame, k: int = 10, block: int = 16384, chunk: int = 4096
          ) -> DataFrame:
    """(query_id, rank, vec_id, distance): for each query (vec_id, code) the k rows of `codes`
    (vec_id, code) that are nearest by Hamming distance, its own row left out, ties to the smaller
    id. Exact. Fewer than k other rows: all of them. Codes are numbers of 64 bits or arrays of such,
    all of one length. Queries are rows of `codes`; rows that share an id are rows of their own.

    Rows with equal codes are one entry with its smallest k + 1 ids; no others can be among the k.
    """
    codes, asked = _words(codes), saved(_words(queries), "queries")
    smallest = F.slice(F.array_sort(F.collect_list("vec_id")), 1, k + 1)
    # parts by row first, so that a code that most rows share is gathered in bounded lists
    part = F.pmod(F.xxhash64("row"), F.lit(256))
    few = codes.groupBy("code", part.alias("part")).agg(smallest.alias("ids"))
    grouped = few.groupBy("code").agg(F.slice(F.array_sort(F.flatten(F.collect_list("ids"))), 1,
                                              k + 1).alias("ids"))
    entries = saved(grouped.select(F.xxhash64("code").alias("row"), "code", "ids"), "codes")

    def matrix(column: pa.ChunkedArray) -> np.ndarray:
        values = column.combine_chunks()
        flat = values.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        return np.ascontiguousarray(flat.view(np.uint64).reshape(len(values), -1))

    def search(chunk_rows: pa.Table, block_rows: pa.Table) -> pa.Table:
        out: list[tuple[int, int, int, int]] = []
        if chunk_rows.num_rows and block_rows.num_rows:
            lists = block_rows.column("ids").to_pylist()
            sizes = np.array([len(x) for x in lists])
            index = SegmentIndex(matrix(block_rows.column("code")))
            for row, own, code in zip(chunk_rows.column("row").to_pylist(),
                                      chunk_rows.column("vec_id").to_pylist(),
                                      matrix(chunk_rows.column("code"))):
                found, distances = index.search(code, k + 1, sizes)
                near = np.flatnonzero(distances <= np.sort(np.repeat(distances, sizes[found]))[
                    :k + 1][-1]) if len(found) else []
                rows = sorted((int(distances[i]), x) for i in near for x in lists[found[i]])
                if (0, own) in rows:        # its own row: of rows equal to it any one
                    rows.remove((0, own))
                out += [(row, own, x, d) for d, x in rows[:k]]
        return pa.table({"query_row": pa.array([o[0] for o in out], pa.int64()),
                         "query_id": pa.array([o[1] for o in out], pa.int64()),
                         "vec_id": pa.array([o[2] for o in out], pa.int64()),
                         "distance": pa.array([o[3] for o in out], pa.int32())})

    n, q = entries.count(), asked.count()
    found = in_blocks(entries, asked, search, SCHEMA, [], -(-n // block) or 1, -(-q // chunk) or 1)
    return nearest(found, k, F.col("distance"), F.col("vec_id")).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "distance")


def similar_signs(vectors: DataFrame, k: int = 10, every: int = 100, key: str = "vec_id",
                  vector: str = "embedding") -> DataFrame:
    """Top k by sign codes of vectors, for each row whose id is divisible by `every`.

    Codes have a bit for every component of the longest vector. Vectors that take no part: `proper`.
    """
    rows = saved(proper(vectors, key, vector), "vectors")
    longest = rows.agg(F.max(F.size("v"))).first()[0] or 1
    codes = rows.select("row", "vec_id", sign_code(-(-longest // WORD)).alias("code"))
    return top_k(codes, codes.where(F.col("vec_id") % every == 0), k)
