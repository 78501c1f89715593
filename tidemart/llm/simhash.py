"""SimHash near-duplicates: fingerprints, pigeonhole blocks, verified links, components."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemart.llm.shared import components, saved, small_batches

BITS = 64
AT_ONCE = 1 << 16   # shingles whose bits are counted in one step


def fingerprint(text: bytes | None, width: int = 3, seed: int = 42) -> int:
    """Majority bits of the hashes of all word shingles; 0 without words.

    Words are runs of other than ASCII white space, A-Z in lower case. Fewer words than `width` are
    one shingle. Memory beyond the text itself: its words, and the bits of AT_ONCE shingles.
    """
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = [e + i for i, e in enumerate(accumulate(map(len, words)))]
    starts = [0, *(e + 1 for e in ends[:-1])]
    spans = list(zip(starts, ends[width - 1:])) or [(0, len(joined))]
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(spans), AT_ONCE):
        ones += _ones(np.array([xxhash.xxh64_intdigest(joined[a:b], seed)
                                for a, b in spans[at:at + AT_ONCE]], dtype="<u8"))
    return _majority(ones, len(spans))


def fingerprint_of(hashes: np.ndarray) -> int:
    """Majority bits of hashes at hand; 0 without any."""
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), AT_ONCE):
        ones += _ones(hashes[at:at + AT_ONCE].astype("<u8"))
    return _majority(ones, len(hashes))


def _ones(hashes: np.ndarray) -> np.ndarray:
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.sum(axis=0, dtype=np.int64)


def _majority(ones: np.ndarray, n: int) -> int:
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def fingerprints(documents: DataFrame, text: str = "text", width: int = 3, seed: int = 42,
                 keep: tuple[str, ...] = ("doc_id",), name: str = "fp") -> DataFrame:
    """The columns `keep` and a column `name`: the fingerprint's 64 bits as a long.

    A null or empty text has fingerprint 0. Only `keep` and the text travel to Python.
    """
    rows = documents.select(*[F.col(f"`{c}`") for c in keep],
                            F.col(f"`{text}`").cast("binary").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array([fingerprint(t.as_py(), width, seed) for t in batch.column("__text")],
                              dtype=np.uint64).view(np.int64)
            kept = [batch.column(c) for c in keep]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(values)], names=[*keep, name])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in
                       documents.select(*[F.col(f"`{c}`") for c in keep]).schema)
    return small_batches(rows).mapInArrow(run, f"{schema}, `{name}` bigint")


def fingerprint_text(fp: str = "fp") -> Column:
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def block_masks(distance: int, blocks: int) -> list[int]:
    """Masks of the block sets that two fingerprints at most `distance` apart must share one of.

    Of `blocks` blocks at most `distance` hold a differing bit, so some blocks - distance agree.
    """
    bounds = [BITS * i // blocks for i in range(blocks + 1)]
    masks = [(1 << b) - (1 << a) for a, b in zip(bounds, bounds[1:])]
    return [sum(c) for c in combinations(masks, blocks - distance)]


def links(fps: DataFrame, distance: int = 2, blocks: int = 4, largest: int = 64) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column fp) at most `distance` bits apart.

    Every class of fingerprints that are linked, directly or through others, is linked the same in
    the result. Fingerprints that share blocks meet in a group; groups of up to `largest` are joined
    with themselves and each pair is verified. Larger groups would give too many pairs: there, for a
    distance of 2, two fingerprints are that close exactly if some bit pattern is at most one bit
    from both, so each is filed under its 1 + free bits patterns, and linked to the smallest
    of a pattern. Distances of 0 to 2 are supported, larger ones are an error.
    """
    masks = block_masks(distance, blocks)
    parts = F.array(*[F.struct(F.lit(i).alias("part"),
                               F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key"))
                      for i, m in enumerate(masks)])
    filed = fps.select("fp", F.explode(parts).alias("p")).select("fp", "p.part", "p.key")
    groups = filed.groupBy("part", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = saved(filed.join(groups, ["part", "key"]), "members")
    few = members.where(F.col("n") <= largest)
    apart = F.bit_count(F.col("x.fp").bitwiseXOR(F.col("y.fp")))
    pairs = few.alias("x").join(few.alias("y"), (
        F.col("x.part") == F.col("y.part")) & (F.col("x.key") == F.col("y.key"))
        & (F.col("x.fp") < F.col("y.fp")) & (apart <= distance)).select(
            F.col("x.fp").alias("a"), F.col("y.fp").alias("b"))
    return pairs.unionByName(_hot_links(members.where(F.col("n") > largest), distance, masks))


def _hot_links(members: DataFrame, distance: int, masks: list[int]) -> DataFrame:
    if distance > 2:
        raise ValueError("groups beyond `largest` are linked for distances of up to 2")
    patterns = F.lit(None).cast("array<bigint>")
    for i, mask in enumerate(masks):
        flips = [0, *(_signed(1 << b) for b in range(BITS) if not mask >> b & 1)]
        if distance < 2:
            flips = flips if distance else [0]
        every = F.array(*[F.col("fp").bitwiseXOR(F.lit(f).cast("long")) for f in flips])
        patterns = F.when(F.col("part") == i, every).otherwise(patterns)
    near = members.select("fp", "part", F.explode(patterns).alias("pattern"))
    least = near.groupBy("part", "pattern").agg(F.min("fp").alias("low"))
    apart = F.bit_count(F.col("fp").bitwiseXOR(F.col("low")))
    return near.join(least, ["part", "pattern"]).where(
        (F.col("fp") != F.col("low")) & (apart <= distance)).select(
            F.col("low").alias("a"), F.col("fp").alias("b")).distinct()


def classes(rows: DataFrame, first: str = "doc_id", distance: int = 2, blocks: int = 4,
            largest: int = 64) -> DataFrame:
    """Rows with `fp` get `component_id`, the smallest `first` of all rows reachable by links.

    Equal fingerprints are one node, so a group of copies of any size is one row here. Null ids are
    passed over for the smallest; a class of null ids only has component_id null.
    """
    nodes = saved(rows.groupBy("fp").agg(F.min(first).alias("least")), "nodes")
    roots = components(links(nodes.select("fp"), distance, blocks, largest))
    placed = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp"))
    least = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = placed.join(least, "root").select("fp", "component_id")
    return rows.join(labels, "fp")


def near_duplicates(documents: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    distance: int = 2, blocks: int = 4) -> DataFrame:
    """(doc_id, fp, component_id) for every row, repeated rows included.

    Empty and null texts have fingerprint 0 and are linked like others. An empty table gives none.
    """
    fps = saved(fingerprints(documents.withColumnRenamed(doc_id, "doc_id"), text), "fingerprints")
    return classes(fps, "doc_id", distance, blocks)


def one_of_each(documents: DataFrame, doc_id: str = "doc_id", text: str = "text",
                distance: int = 2, blocks: int = 4) -> DataFrame:
    """The documents, one row of each class of near duplicates: the smallest id (null last).

    Rows are told apart by two hashes of id and text; of rows equal in both one stays. The texts are
    sent once, to meet the rows that stay; `merge` keeps that join the same at every size. Columns
    are those of `documents`.
    """
    columns = documents.columns
    marks = ("__first", "__second")
    if set(marks) & set(columns):
        raise ValueError(f"columns {marks} are in use")
    known = F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("~")), F.col(f"`{text}`")
    marked = documents.withColumns({"__first": F.xxhash64(*known), "__second": F.hash(*known)})
    fps = saved(fingerprints(marked, text, keep=(doc_id, *marks)).withColumnRenamed(
        doc_id, "doc_id"), "fingerprints")
    whole = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", *marks)
    nodes = saved(fps.groupBy("fp").agg(F.min(whole).alias("low")), "nodes")
    roots = components(links(nodes.select("fp"), distance, blocks))
    stay = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").groupBy(
        F.coalesce("root", "fp").alias("root")).agg(F.min("low").alias("low")).select(
            "low.__first", "low.__second")
    met = marked.join(stay.hint("merge"), list(marks))
    one = Window.partitionBy(*marks).orderBy(*marks)
    return met.withColumn("__n", F.row_number().over(one)).where("__n = 1").select(
        *[F.col(f"`{c}`") for c in columns])
