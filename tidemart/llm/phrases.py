"""Phrase collocations from an FM-index per shard over word ids.

A shard is a run of words of one language, with the forward and the backward index of its words: the
word before each place, places being ordered by the words that follow them, to the depth of the
longest phrase. A phrase is an interval in both; words put before it or behind it are read off one
index, and the interval moves on in the other. Phrases grow by a word at a time, in all shards, and
their counts are summed over the shards before they grow again: only what occurs often enough
in all shards together can be part of a longer phrase that does. Shards learn this from a bit set of
bounded size, which lets all frequent phrases pass and few others; these the sums then drop.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemart.llm.shared import giving_back, saved, small_batches

WORDS = 1 << 20             # that a task gathers before it builds a shard of its largest language
ROWS_AT_ONCE = 1 << 17      # places whose phrases grow together
MOST_BITS = 1 << 27         # of a set of frequent phrases: 16 MB
BITS_EACH = 64              # bits for each phrase, as long as MOST_BITS allows
BUCKET = 1 << 15            # bits to a row while a set is made
TURN = 21
SHARDS = "lang string, vocabulary array<string>, forward binary, backward binary"
COUNTS = "lang string, phrase string, n bigint"


def before_each(ids: np.ndarray, depth: int) -> np.ndarray:
    """The word before each of the places ordered by the `depth` words from them on: each step puts one word
    before what is in order already."""
    n = len(ids)
    order = np.arange(1, n + 1, dtype=np.int64)
    for _ in range(depth):
        order -= 1
        order[order < 0] += n
        keys = ids[order] * np.int64(n)
        keys += np.arange(n)
        keys.sort()
        keys %= n
        order = order[keys]
    return ids[order - 1].astype("<i4")


class Index:
    """One direction: `before[i]` is the word before the i-th place, 0 at the edge of a piece."""

    def __init__(self, before: np.ndarray):
        self.before, self.n = before, len(before)
        self.occurrences = before.astype(np.int64)
        self.occurrences *= self.n
        self.occurrences += np.arange(self.n)
        self.occurrences.sort()

    def starts(self, words: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where the intervals begin that `words` put before those at `at`."""
        return np.searchsorted(self.occurrences, words * self.n + at)


class Intervals:
    """Phrases (a row of word ids each) and where their intervals begin in both indexes."""

    def __init__(self, words: np.ndarray, n: np.ndarray, here: np.ndarray, there: np.ndarray):
        self.words, self.n, self.here, self.there = words, n, here, there

    @classmethod
    def single(cls, index: Index, words: int) -> Intervals:
        n = np.bincount(index.before, minlength=words + 1)
        begin = (np.cumsum(n) - n)[1:]
        return cls(np.arange(1, words + 1)[:, None], n[1:], begin, begin)

    def where(self, kept: np.ndarray) -> Intervals:
        return Intervals(self.words[kept], self.n[kept], self.here[kept], self.there[kept])

    def parts(self, rows: int) -> Iterator[Intervals]:
        """The phrases in parts of some `rows` places together."""
        part = (np.cumsum(self.n) - 1) // rows
        for i in np.unique(part):
            yield self.where(part == i)

    def turned(self) -> Intervals:
        """The same phrases read backward: the indexes change places."""
        return Intervals(self.words[:, ::-1], self.n, self.there, self.here)

    def extended(self, index: Index) -> Intervals:
        """All phrases that one word more before these gives, by `index`, in which `here` counts."""
        own = np.repeat(np.arange(len(self.n)), self.n)
        first = np.cumsum(self.n) - self.n
        size = np.int64(index.before.max(initial=0) + 1)
        keys = (self.here - first)[own] + np.arange(len(own))
        keys = own * size + index.before[keys]
        keys.sort()
        new = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[:len(keys)])
        keys, n = keys[new], np.diff(np.append(new, len(keys)))
        own, word = np.divmod(keys, size)
        smaller = np.cumsum(n) - n - first[own]     # of the same phrase, behind smaller words
        grown = Intervals(np.column_stack([word, self.words[own]]), n,
                          index.starts(word, self.here[own]), self.there[own] + smaller)
        return grown.where(word > 0)


class Frequent:
    """The bit sets of the frequent phrases of each length so far."""

    def __init__(self) -> None:
        self.sets: list[np.ndarray] = []

    def holds(self, hashes: np.ndarray, length: int) -> np.ndarray:
        bits = self.sets[length - 1]
        at = hashes & np.uint64(len(bits) * 8 - 1)
        return bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1 > 0

    def add(self, counts: DataFrame) -> None:
        """A set of the phrases in `counts`; Spark sets the bits, the finished set reaches the driver."""
        size = BUCKET
        while size < min(MOST_BITS, counts.count() * BITS_EACH):
            size *= 2
        at = phrase_hash(F.col("lang"), F.col("phrase")).bitwiseAND(F.lit(size - 1)) + 1
        rows = counts.groupBy(F.bitmap_bucket_number(at).alias("bucket")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits")).collect()
        bits = np.zeros(size // 8, np.uint8)
        for r in rows:
            begin = (r["bucket"] - 1) * BUCKET // 8
            bits[begin:begin + BUCKET // 8] = np.frombuffer(r["bits"], np.uint8)
        self.sets.append(bits)


def _turned(value: Column) -> Column:
    return F.shiftleft(value, TURN).bitwiseOR(F.shiftrightunsigned(value, 64 - TURN))


def phrase_hash(lang: Column, phrase: Column) -> Column:
    """The language's and the words' hashes, turned and mixed one after another."""
    return F.aggregate(F.split(phrase, " "), F.xxhash64(lang),
                       lambda value, word: _turned(value).bitwiseXOR(F.xxhash64(word)))


def phrase_hashes(lang: str, words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """`phrase_hash` of rows of word ids; `hashes` has that of each word."""
    value = np.full(len(words), xxhash.xxh64_intdigest(lang.encode(), 42), np.uint64)
    for column in words.T:
        value = (value << np.uint64(TURN) | value >> np.uint64(64 - TURN)) ^ hashes[column]
    return value


def _tokens(texts: pa.Array) -> pa.Array:
    """Words of texts with A-Z in lower case, and a line feed where a piece or a text ends."""
    low = pc.ascii_lower(pc.fill_null(texts, ""))
    parted = pc.replace_substring_regex(low, "[.,;:!?\n\x0b\x0c\r]+", " \n ")
    ended = pc.binary_join_element_wise(pc.replace_substring(parted, "\t", " "), "\n", " ")
    return pc.split_pattern(ended, " ").flatten()


def _coded(tokens: list[pa.Array]) -> tuple[np.ndarray, pa.Array]:
    """Word ids from 1 on, 0 between pieces and at both ends; the words."""
    coded = pa.chunked_array(tokens).combine_chunks().dictionary_encode()
    known = coded.dictionary
    word = pc.and_(pc.not_equal(known, ""), pc.not_equal(known, "\n")).to_numpy(zero_copy_only=False)
    number = np.where(word, np.cumsum(word), 0)
    number[pc.equal(known, "").to_numpy(zero_copy_only=False)] = -1
    ids = number[coded.indices.to_numpy()]
    ids = np.concatenate([[0], ids[ids >= 0], [0]])
    return ids[np.append(True, (ids[1:] > 0) | (ids[:-1] > 0))], known.filter(pa.array(word))


def _runs(ids: np.ndarray, most: int) -> Iterator[np.ndarray]:
    """Runs of some `most` words, cut between pieces only; a longer piece is a run of its own."""
    edges, at = np.flatnonzero(ids == 0), 0
    while at < len(ids) - 1:
        ends = edges[edges > at]
        end = ends[max(0, np.searchsorted(ends, at + most, "right") - 1)]
        yield ids[at:end + 1]
        at = end


def shards(documents: DataFrame, text: str, lang: str, depth: int, words: int = WORDS) -> DataFrame:
    """The rows of `SHARDS`: a task's documents by language, some `words` words at the most."""
    rows = documents.select(F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"),
                            F.col(f"`{text}`").alias("text"))

    def built(name: str, tokens: list[pa.Array]) -> Iterator[pa.RecordBatch]:
        ids, known = _coded(tokens)
        for run in _runs(ids, words):
            kinds, own = np.unique(np.append(0, run), return_inverse=True)
            own = own[1:].astype(np.int64)
            before = [before_each(x, depth).tobytes() for x in (own, own[::-1])]
            yield pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.array([known.take(pa.array(kinds[1:] - 1)).to_pylist()],
                                            pa.list_(pa.string())),
                 *[pa.array([b], pa.binary()) for b in before]],
                names=["lang", "vocabulary", "forward", "backward"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[pa.Array]] = {}
        sizes: dict[str, int] = {}
        for batch in batches:
            langs = batch.column(0)
            for name in pc.unique(langs).to_pylist():
                tokens = _tokens(batch.column(1).filter(pc.equal(langs, name)))
                held.setdefault(name, []).append(tokens)
                sizes[name] = sizes.get(name, 0) + len(tokens)
            while sum(sizes.values()) > words:
                largest = max(sizes, key=sizes.get)
                sizes.pop(largest)
                yield from built(largest, held.pop(largest))
        for name, tokens in held.items():
            yield from built(name, tokens)

    return small_batches(rows).mapInArrow(giving_back(run), SHARDS)


def counts(indexed: DataFrame, length: int, frequent: Frequent) -> DataFrame:
    """(lang, phrase, n): phrases of `length` words by shard, grown from the frequent shorter ones.

    Phrases grow at the left and at the right in turn.
    """
    def found(name: str, now: Intervals, hashes: np.ndarray, sides: list[Index]) -> Intervals:
        for size in range(1, length):
            now = now.where(frequent.holds(phrase_hashes(name, now.words, hashes), size))
            if size % 2:
                now = now.extended(sides[0])
            else:
                now = now.turned().extended(sides[1]).turned()
            held = [frequent.holds(phrase_hashes(name, part, hashes), size)
                    for part in (now.words[:, 1:], now.words[:, :-1])]
            now = now.where(held[0] & held[1])
        return now

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, name in enumerate(batch.column(0).to_pylist()):
                known = batch.column(1)[i].values
                # phrases of one word need no index, those of two the forward one
                sides = [Index(np.frombuffer(batch.column(c)[i].as_buffer(), "<i4"))
                         for c in (2, 3)[:max(1, length - 1)]]
                hashes = np.fromiter((xxhash.xxh64_intdigest(w.as_buffer(), 42) for w in known),
                                     np.uint64, len(known)) if length > 1 else np.zeros(0, np.uint64)
                for some in Intervals.single(sides[0], len(known)).parts(ROWS_AT_ONCE):
                    now = found(name, some, np.append(np.uint64(0), hashes), sides)
                    words = [known.take(pa.array(column - 1)) for column in now.words.T]
                    phrase = pc.binary_join_element_wise(*words, " ") if length > 1 else words[0]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(phrase), pa.string()), phrase, pa.array(now.n)],
                        names=["lang", "phrase", "n"])

    return indexed.mapInArrow(giving_back(run), COUNTS)


@contextmanager
def few_at_once(spark: SparkSession, rows: int = 1) -> Iterator[None]:
    """Python gets `rows` rows at a time meanwhile: a shard is as large as a batch of texts."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def phrase_counts(documents: DataFrame, text: str, lang: str, longest: int, least: int,
                  words: int = WORDS) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, n, length) of all phrases of up to `longest` words that occur `least` times or
    more, and (lang, n) of all words."""
    indexed = saved(shards(documents, text, lang, longest, words), "shards", at_once=1)
    frequent, levels, total = Frequent(), [], None
    for length in range(1, longest + 1):
        # a shard gives each phrase once: there is nothing to add up before the rows are dealt out
        rows = counts(indexed, length, frequent).repartition("lang", "phrase")
        found = rows.groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
        with few_at_once(documents.sparkSession):
            found = saved(found if length == 1 else found.where(F.col("n") >= least), "phrases")
        if length == 1:
            total = found.groupBy("lang").agg(F.sum("n").alias("n"))
        levels.append(found.where(F.col("n") >= least))
        if length < longest:
            frequent.add(levels[-1])
    every = levels[0].withColumn("length", F.lit(1))
    for i, level in enumerate(levels[1:], 2):
        every = every.unionByName(level.withColumn("length", F.lit(i)))
    return every, total


def collocations(documents: DataFrame, text: str = "text", lang: str = "lang", shortest: int = 2,
                 longest: int = 3, least: int = 10, share: int = 50, top: int = 2000,
                 words: int = WORDS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score, most_left, most_right: each language's best phrases.

    Words are what stands between blanks and tabs, with A-Z in lower case; phrases lie within a
    piece, that is between `.,;:!?`, line ends and a text's ends. a: how often a phrase of
    `shortest` to `longest` words occurs, overlaps included, `least` times at the least. Cut behind its
    first words, l and r are the same for its two parts, score the floor of 1000000 a a / (l r) at
    the lowest-scoring cut (the first of equal ones). n: all words of the language, `und` for null.
    A phrase is dropped if a longer one that holds it, dropped or not, occurs at least `share`
    percent as often. most_left, most_right: the count of the most frequent phrase with one word more
    on that side, null if none occurs `least` times or is too long. Ties in score and a rank by bytes.
    Null and empty texts have no words, repeated rows count repeatedly. Texts are taken whole; a
    task's memory grows with `words` and with the longest piece.
    """
    every, total = phrase_counts(documents, text, lang, longest, least, words)

    def part(begin: Column | int, size: Column) -> Column:
        return F.array_join(F.slice(F.split("phrase", " "), begin, size), " ")

    less = F.col("length") - 1
    # what a phrase with a word less on one side learns from this one
    longer = every.where("length > 1").select("lang", "n", F.explode(F.array(
        F.struct(part(2, less).alias("phrase"), F.lit("left").alias("side")),
        F.struct(part(1, less).alias("phrase"), F.lit("right").alias("side")))).alias("x"))
    most = longer.groupBy("lang", F.col("x.phrase").alias("phrase")).agg(
        *[F.max(F.when(F.col("x.side") == s, F.col("n"))).alias(f"most_{s}") for s in ("left", "right")])
    kept = every.where(F.col("length") >= shortest).join(most, ["lang", "phrase"], "left").where(
        F.coalesce(100 * F.greatest("most_left", "most_right") < share * F.col("n"), F.lit(True)))
    cut = kept.select("lang", "phrase", F.col("n").alias("a"), "most_left", "most_right", F.explode(
        F.sequence(F.lit(1), F.col("length") - 1)).alias("k"), "length")
    cut = cut.select("*", part(1, F.col("k")).alias("first"),
                     part(F.col("k") + 1, F.col("length") - F.col("k")).alias("rest"))
    for name, side in (("first", "l"), ("rest", "r")):
        known = every.select("lang", F.col("phrase").alias(name), F.col("n").alias(side))
        cut = cut.join(known, ["lang", name])
    whole = {c: F.col(c).cast("decimal(19,0)") for c in "alr"}
    cut = cut.withColumns({"x": whole["a"] * whole["a"] * F.lit(1_000_000).cast("decimal(7,0)"),
                           "y": whole["l"] * whole["r"]}).withColumn("score", F.expr("x div y"))
    best = cut.groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("b"),
        *[F.first(c).alias(c) for c in ("a", "most_left", "most_right")])
    by = Window.partitionBy("lang").orderBy(F.desc("b.score"), F.desc("a"), "phrase")
    ranked = best.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= top)
    return ranked.join(total, "lang").select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "b.l", "b.r", "n", "b.score",
        "most_left", "most_right")
