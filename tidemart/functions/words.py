"""Keyword splitting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.session import shared_dir

# Everything that is neither a letter nor a digit ends a word.
SEPARATORS = r"[^\p{L}\p{N}]+"

# Letters per piece when a long run of letters is cut up.
PIECE = 256

# Letters of the longest words that a place carries as text; longer ones are told by hashes.
SHORT = 64


def words(text) -> Column:
    """Lower-case words of a text as an array."""
    return F.filter(F.split(F.lower(text), SEPARATORS), lambda word: word != "")


def split_words(df: DataFrame, text: str, word: str = "word") -> DataFrame:
    """One row per word of `text`; the text itself is dropped."""
    rest = [c for c in df.columns if c != text]
    return df.select(*rest, F.explode(words(F.col(text))).alias(word))


def _known(dictionary: DataFrame, word: str) -> tuple[DataFrame, list[int]]:
    """The words of a dictionary, each once, and their lengths.

    Lengths shape the plan, so words and lengths are read together: a copy below the shared folder,
    which stays as it is while a stream runs.
    """
    path = f"{shared_dir(dictionary.sparkSession)}/dictionary"
    dictionary.select(word).where(F.length(word) > 0).distinct().write.parquet(path)
    words = dictionary.sparkSession.read.schema(f"`{word}` string").parquet(path)
    return words, sorted(r[0] for r in words.select(F.length(word)).distinct().collect())


def _pieces(runs: DataFrame, run: str, longest: int) -> DataFrame:
    """Runs cut into pieces that overlap by one letter less than the longest word: the rest of the
    columns, `piece`, and `starts`, the letters at which a word of this piece may begin. So work
    and memory stay in proportion to the longest word even for a run that is a whole book."""
    rest = [c for c in runs.columns if c != run]
    size, step = F.length(run), max(PIECE, longest)
    last = F.floor((size - 1) / step).cast("int")
    pieces = runs.select(*rest, run, F.explode(F.sequence(F.lit(0), last)).alias("at"))
    return pieces.select(
        *rest, F.least(F.lit(step), size - F.col("at") * step).cast("int").alias("starts"),
        F.substring(F.col(run), F.col("at") * step + 1, F.lit(step + longest - 1)).alias("piece"))


def _short_places(runs: DataFrame, run: str, words: DataFrame, word: str, lengths: list[int]) -> DataFrame:
    """Places of words of up to SHORT letters, by their text.

    Each letter of a run is one place. The letters from it on that the shortest word has are its
    seed; only a place whose seed begins some word goes on, with the lengths of those words.
    """
    rest = [c for c in runs.columns if c != run]
    shortest, longest = lengths[0], lengths[-1]
    pieces = _pieces(runs, run, longest)
    starts = F.transform(F.sequence(F.lit(1), F.col("starts")),
                         lambda n: F.substring(F.col("piece"), n, F.lit(longest)))
    places = pieces.select(*rest, F.explode(starts).alias("tail"))
    places = places.where(F.length("tail") >= shortest).withColumn(
        "seed", F.substring("tail", 1, shortest))
    seeds = words.groupBy(F.substring(word, 1, shortest).alias("seed")).agg(
        F.collect_set(F.length(word)).alias("lengths"))
    fitting = F.filter("lengths", lambda n: n <= F.length("tail"))
    cuts = places.join(seeds, "seed").select(*rest, F.explode(F.transform(
        fitting, lambda n: F.substring(F.col("tail"), F.lit(1), n))).alias(word))
    return cuts.join(words, word, "left_semi")


def _rungs(rows: DataFrame, text: str, lengths: list[int]) -> DataFrame:
    """`rows` with rung_0, rung_1 ...: hashes of the 1, 2, 4 ... letters from each letter on, as far as
    the lengths need them. A rung is made of pairs of the one below."""
    rows = rows.withColumn("rung_0", F.transform(F.split(F.col(text), ""), lambda x: F.struct(
        F.xxhash64(x).alias("a"), F.xxhash64(F.lit(7), x).alias("b"))))
    for i in range(1, lengths[-1].bit_length()):
        below, apart = F.col(f"rung_{i - 1}"), 1 << (i - 1)
        n = F.greatest(F.lit(0), F.size(below) - apart)
        rows = rows.withColumn(f"rung_{i}", F.zip_with(
            F.slice(below, 1, n), F.slice(below, apart + 1, n), lambda x, y: F.struct(
                F.xxhash64(x["a"], y["a"]).alias("a"), F.xxhash64(x["b"], y["b"]).alias("b"))))
    return rows


def _spans(length: Column, starts: Column, lengths: list[int]) -> Column:
    """(__n, __a, __b): the hashes of all runs of `length` letters that begin at the first `starts` ones.

    The two halves overlap: the largest power of two that fits, from the first letter on and up to
    the last one.
    """
    rung = F.length(F.bin(length)) - 1
    hashes = F.element_at(F.array(*[F.col(f"rung_{i}") for i in range(lengths[-1].bit_length())]), rung + 1)
    shift = length - F.pow(F.lit(2), rung).cast("int")
    n = F.least(starts, F.greatest(F.lit(0), F.size(hashes) - shift))
    return F.zip_with(F.slice(hashes, 1, n), F.slice(hashes, shift + 1, n), lambda x, y: F.struct(
        length.alias("__n"), F.xxhash64(x["a"], y["a"]).alias("__a"), F.xxhash64(x["b"], y["b"]).alias("__b")))


def _long_places(runs: DataFrame, run: str, words: DataFrame, word: str, lengths: list[int]) -> DataFrame:
    """Places of longer words: a place carries a length and two hashes, never its letters.

    Hashes of runs of 1, 2, 4 ... letters give that of any run, so a piece takes memory in proportion
    to its own letters. Two runs of one length are taken as equal if both 64-bit hashes are.
    """
    rest = [c for c in runs.columns if c != run]
    signs = _rungs(words.select(F.col(word).alias("__word")), "__word", lengths).select(
        "__word", F.inline(_spans(F.length("__word"), F.lit(1), lengths)))
    pieces = _rungs(_pieces(runs.where(F.length(run) >= lengths[0]), run, lengths[-1]), "piece", lengths)
    # one length after another, so that the spans of one of them are held at a time
    places = pieces.withColumn("__length", F.explode(F.array(*map(F.lit, lengths)))).where(
        F.size("rung_0") >= F.col("__length"))
    spans = places.select(*rest, F.inline(_spans(F.col("__length"), F.col("starts"), lengths)))
    return spans.join(signs, ["__n", "__a", "__b"]).select(*rest, F.col("__word").alias(word))


def _places(runs: DataFrame, run: str, dictionary: DataFrame, word: str) -> DataFrame:
    """One row per place where a dictionary word stands in a run, words of any length."""
    words, lengths = _known(dictionary, word)
    rest = [c for c in runs.columns if c != run]
    short, long = [n for n in lengths if n <= SHORT], [n for n in lengths if n > SHORT]
    found = []
    if short:
        found.append(_short_places(runs, run, words.where(F.length(word) <= SHORT), word, short))
    if long:
        found.append(_long_places(runs, run, words.where(F.length(word) > SHORT), word, long))
    if not found:
        return runs.where("false").select(*rest, F.col(run).alias(word))
    both = [f.select(*rest, word) for f in found]
    return both[0] if len(both) == 1 else both[0].unionByName(both[1])


def dictionary_matches(df: DataFrame, text: str, dictionary: DataFrame,
                       word: str = "word") -> DataFrame:
    """One row per place where a dictionary word stands in a text; no state, so fit for streams.

    For text written without spaces. `dictionary` has one column named as `word`. Words inside
    other words are found as well.
    """
    return _places(split_words(df, text, "run"), "run", dictionary, word)


def dictionary_words(df: DataFrame, text: str, dictionary: DataFrame,
                     word: str = "word", count: str = "ct") -> DataFrame:
    """Number of places of every dictionary word, per group of the other columns.

    Equal runs of letters are counted before they are cut, so each distinct run is cut only
    once per group; what is no dictionary word is left out before the counts are added up.
    """
    rest = [c for c in df.columns if c != text]
    runs = (split_words(df, text, "run").groupBy(*rest, "run")
            .agg(F.count(F.lit(1)).alias("copies")))
    return (_places(runs, "run", dictionary, word).groupBy(*rest, word)
            .agg(F.sum("copies").alias(count)))


def register_split_words(spark: SparkSession, name: str = "split_words") -> None:
    """The table function form, for `FROM t, LATERAL split_words(text)`.

    It is written in SQL, which Spark puts in its place in the plan: rows never leave the JVM.
    """
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}(text STRING) RETURNS TABLE (word STRING)
        RETURN SELECT w.word FROM LATERAL explode(
            filter(split(lower(text), r'{SEPARATORS}'), x -> x <> '')) AS w(word)""")
