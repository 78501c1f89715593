"""Mixing sources to target weights: water-filled targets, hash thresholds from histograms.

Native throughout: no Python runs on executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemart.llm.shared import HASH_BITS, row_hash, saved

WORD = "[^\\x20\\x09-\\x0D]+"
LEVEL_BITS = 10
LEVELS = 3          # 30 bits of the hash in all: buckets at last hold few keys of any source
COPIES_AT_ONCE = 10_000


def words(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(f"`{text}`"), F.lit(WORD)), F.lit(0)).cast("bigint")


def targets(sizes: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5,
            most: float = 2.0) -> DataFrame:
    """(source, source_size) get `target`: `share` times all sizes, by weight, at most `most` times
    the source's size.

    Weights go round the sources in code-point order, a null source last. What lies above a limit is
    shared by weight among the rest until none is above: all sources below their limit then have
    target = level * weight, and with sources in order of limit / weight, the level is the first at
    which the next source stays below its limit. Windows here run over sources, one row each.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(order) - 1) % len(weights)
    weight = F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int"))
    rows = sizes.withColumn("weight", weight.cast("double")).withColumn(
        "limit", F.col("source_size") * F.lit(float(most)))
    fill = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    so_far = fill.rowsBetween(Window.unboundedPreceding, -1)
    onward = fill.rowsBetween(0, Window.unboundedFollowing)
    whole = Window.partitionBy(F.lit(1))
    rows = rows.withColumn("budget", F.sum("source_size").over(whole) * F.lit(float(share)))
    left = F.col("budget") - F.coalesce(F.sum("limit").over(so_far), F.lit(0.0))
    rows = rows.withColumn("level", left / F.sum("weight").over(onward))
    fits = F.col("level") * F.col("weight") <= F.col("limit")
    level = F.min(F.when(fits, F.struct(F.col("limit") / F.col("weight"), F.col("level")))).over(
        whole)["level"]
    filled = F.least(F.col("limit"), level * F.col("weight"))
    return rows.select("source", "source_size",
                       F.coalesce(filled, F.col("limit")).alias("target"))


def _narrowed(rows: DataFrame, edge: DataFrame, place: str, levels: int, bits: int) -> DataFrame:
    """(source, start, rest): the bucket of the values `place` in which a source's running total of
    sizes reaches the rest, and what is left of it there.

    Level by level a histogram of sizes by source and bucket finds the bucket; only its rows are cut
    finer. If no bucket reaches the rest, it is the last one.
    """
    for level in range(1, levels + 1):
        width = HASH_BITS - level * bits
        near = rows.select("source", F.col(place).alias("h"), "size").alias("r").join(
            edge.alias("e"), F.col("r.source").eqNullSafe(F.col("e.source"))).where(
                F.shiftright("h", width + bits) == F.shiftright("start", width + bits))
        bucket = (F.shiftright("h", width) % (1 << bits)).alias("bucket")
        sums = near.groupBy(F.col("r.source").alias("source"), bucket, "start", "rest").agg(
            F.sum("size").cast("double").alias("size"))
        run = Window.partitionBy("source").orderBy("bucket")
        total = F.sum("size").over(run.rowsBetween(Window.unboundedPreceding, 0))
        at = F.struct("bucket", (F.col("total") - F.col("size")).alias("before"))
        found = sums.withColumn("total", total).groupBy("source", "start", "rest").agg(F.coalesce(
            F.min(F.when(F.col("total") >= F.col("rest"), at)), F.max(at)).alias("p"))
        edge = saved(found.select(
            "source", (F.col("start") + F.shiftleft(F.col("p.bucket").cast("bigint"), width))
            .alias("start"), (F.col("rest") - F.col("p.before")).alias("rest")), "edges")
    return edge


def thresholds(rows: DataFrame, goals: DataFrame, levels: int = LEVELS,
               bits: int = LEVEL_BITS) -> DataFrame:
    """For each (source, goal): where the rows end whose sizes add up to about the goal.

    `rows`: source, h and tie (HASH_BITS uniform bits each), size; rows of one tie are equal. They
    are in order of the first bits of h, one bucket each, and within a bucket by tie. Below the goal
    lie the buckets before `bound`, in its bucket the rows with a tie below `tie_bound`, and of the
    `n` rows with that tie `copies`, as many as end nearest to the goal. Ends are nested: a smaller
    mix is part of a larger one.
    """
    start = F.lit(0).cast("bigint").alias("start")
    edge = _narrowed(rows, goals.select("source", F.col("goal").cast("double").alias("rest"), start),
                     "h", levels, bits)
    # the boundary bucket holds one key as a rule, which may have a third of all rows
    same = F.col("r.source").eqNullSafe(F.col("e.source"))
    width = HASH_BITS - levels * bits
    ties = saved(rows.alias("r").join(edge.alias("e"), same).where(
        F.shiftright("h", width) == F.shiftright("start", width)).groupBy("r.source", "tie").agg(
            F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")), "ties")
    inner = _narrowed(ties, edge.select("source", "rest", start), "tie", levels, bits)
    last = ties.alias("r").join(inner.alias("e"), same).where(
        F.shiftright("tie", width) == F.shiftright("start", width)).select(
            "r.source", "tie", "size", "n", "rest")
    run = Window.partitionBy("source").orderBy("tie").rowsBetween(Window.unboundedPreceding, 0)
    at = F.struct("tie", "n", "size", (F.col("rest") - F.col("total") + F.col("size")).alias("left"))
    found = last.withColumn("total", F.sum("size").over(run)).groupBy("source").agg(F.coalesce(
        F.min(F.when(F.col("total") >= F.col("rest"), at)), F.max(at)).alias("p"))
    nearest = F.when(F.col("p.size") > 0, F.floor(
        (2 * F.col("p.left") * F.col("p.n") + F.col("p.size")) / (2 * F.col("p.size")))).otherwise(0)
    ends = saved(found.select("source", F.col("p.tie").alias("tie_bound"), F.col("p.n").alias("n"),
                              F.greatest(F.lit(0), F.least("p.n", nearest)).cast("bigint")
                              .alias("copies")), "ends")
    return edge.alias("r").join(ends.alias("e"), same).select(
        "r.source", F.col("start").alias("bound"), "tie_bound", "n", "copies")


def plan(rows: DataFrame, weights: tuple[int, ...], share: float, most: float) -> DataFrame:
    """(source, source_size, target, whole, bound, tie_bound, n, copies) from rows (source, size, h,
    tie): rows of a source are taken `whole` times, and once more those that `thresholds` finds."""
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    goals = saved(targets(sizes, weights, share, most), "targets")
    whole = F.when(F.col("source_size") > 0,
                   F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    goals = goals.withColumn("whole", whole.cast("bigint"))
    ends = thresholds(rows, goals.where("source_size > 0").where(
        "target > whole * source_size").select(
            "source", (F.col("target") - F.col("whole") * F.col("source_size")).alias("goal")))
    return saved(goals.alias("g").join(
        ends.alias("b"), F.col("g.source").eqNullSafe(F.col("b.source")), "left").select(
            F.col("g.source").alias("source"), "source_size", "target", "whole", "bound",
            "tie_bound", "n", "copies"), "plan")


def _times(rows: DataFrame, made: DataFrame, source: str, keep: list[str]) -> DataFrame:
    """The columns `keep` of rows with __h and __tie, the plan's source_size and target, and `times`.

    Of equal rows that the boundary parts, the copies are counted before the shuffle and written out
    again by number, COPIES_AT_ONCE in a row.
    """
    shift = HASH_BITS - LEVELS * LEVEL_BITS
    made = made.withColumnRenamed("source", "__source")
    found = rows.join(made, F.col(f"`{source}`").eqNullSafe(F.col("__source")))
    bucket, bound = F.shiftright("__h", shift), F.shiftright("bound", shift)
    at = (bucket == bound) & (F.col("__tie") == F.col("tie_bound"))
    below = (bucket < bound) | (bucket == bound) & (F.col("__tie") < F.col("tie_bound")) | at & (
        F.col("copies") == F.col("n"))
    more = F.when(below, F.lit(1)).otherwise(F.lit(0))
    columns = [*keep, "source_size", "target"]
    parted = F.col("copies").between(1, F.col("n") - 1)
    if made.where(parted).isEmpty():
        return found.select(*columns, (F.col("whole") + more).alias("times"))
    split = F.coalesce(at & parted, F.lit(False))
    counted = found.where(split).groupBy("__source", "__tie").agg(
        *[F.first(c).alias(c) for c in (*columns, "whole", "n", "copies")])
    chunks = counted.select("*", F.explode(F.sequence(
        F.lit(0).cast("bigint"), F.floor((F.col("n") - 1) / COPIES_AT_ONCE))).alias("chunk"))
    begin = F.col("chunk") * COPIES_AT_ONCE
    numbered = chunks.repartition("__tie", "chunk").select("*", F.explode(F.sequence(
        begin, F.least(begin + COPIES_AT_ONCE, F.col("n")) - 1)).alias("copy"))
    one = F.when(F.col("copy") < F.col("copies"), F.lit(1)).otherwise(F.lit(0))
    return found.where(~split).select(*columns, (F.col("whole") + more).alias("times")).unionByName(
        numbered.select(*columns, (F.col("whole") + one).alias("times")))


def _key_hash(key: str, seed: int) -> Column:
    return row_hash(F.col(f"`{key}`").cast("string"), seed=seed)


def _tie(documents: DataFrame, seed: int) -> Column:
    """HASH_BITS bits of all columns, with which of them are null."""
    parts = [c for name in documents.columns for c in (F.col(f"`{name}`"), F.col(f"`{name}`").isNull())]
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *parts), 64 - HASH_BITS)


def mix(documents: DataFrame, source: str = "source", text: str = "text", key: str = "doc_id",
        weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0,
        seed: int = 11) -> DataFrame:
    """(key, size, source_size, target, times) of each row: how often the mix takes it.

    A source whose target is r times its size takes every row floor(r) times, and once more the rows
    whose hash lies below the bound for the rest. Size: words of the text, none for null. A source
    without words has target 0 and its rows are not taken. Rows with equal keys share a hash; at the
    boundary they are parted by a hash of all columns, and equal rows by number, so that a key with
    many rows is taken in part. Null sources are a source of their own. No rows: no rows.
    """
    rows = saved(documents.select(
        F.col(f"`{key}`").alias("key"), F.col(f"`{source}`").alias("source"), words(text).alias("size"),
        _key_hash(key, seed).alias("h"), _tie(documents, seed).alias("tie")), "sizes")
    found = _times(rows.withColumnsRenamed({"h": "__h", "tie": "__tie"}),
                   plan(rows, weights, share, most), "source", ["key", "size"])
    return found.select(F.col("key").alias(key), "size", "source_size", "target", "times")


def mixed(documents: DataFrame, source: str = "source", text: str = "text", key: str = "doc_id",
          weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0,
          seed: int = 11) -> DataFrame:
    """The documents of the mix, a row as often as `mix` takes it, with the columns of `documents`.

    The texts meet the plan by their source, so that they are not sent where the plan is small.
    """
    own, hashes = F.col(f"`{source}`"), (_key_hash(key, seed), _tie(documents, seed))
    rows = documents.select(own.alias("source"), words(text).alias("size"), hashes[0].alias("h"),
                            hashes[1].alias("tie"))
    made = plan(saved(rows, "sizes"), weights, share, most)
    held = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"),
                            own.alias("own"), hashes[0].alias("__h"), hashes[1].alias("__tie"))
    found = _times(held, made, "own", ["row"]).where("times > 0").select(
        "row", F.explode(F.array_repeat(F.lit(0), F.col("times").cast("int"))))
    return found.select("row.*")
