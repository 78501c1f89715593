"""Token counts of whole texts: pieces are counted once for each distinct pre-token.

No token reaches over white space, so a text's tokens are those of its words between white space,
which are the pre-tokens here; where the tokenizer parts letters from stops and knows no capitals,
stops stand apart and ASCII words are alike in both cases. No ids of texts are made: texts become
words with frequencies, each distinct word of all documents goes through the tokenizer once, and a
document's count is the sum of its frequencies times the pieces. Words that many documents share (a
fixed number of the most frequent ones, so their size is bounded) are looked up beside the documents;
the others are joined.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemart.llm.shared import saved, small_batches

FREQUENT = 1 << 17      # words that are looked up without a join
LONGEST = 512           # their characters at the most, which bounds what every task holds
# steps that treat words alike whether they stand alone or between white space
LOCAL_STEPS = {"Sequence", "NFC", "NFD", "Replace", "Lowercase", "Split", "ByteLevel"}
# fixed value: a pattern that never matches over a letter or digit and a stop behind it
LETTERS_OR_MARKS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
STOP = "([A-Za-z0-9])([.,;:!?])"


@lru_cache(maxsize=2)
def tokenizer_of(source: str) -> Tokenizer:
    """The tokenizer written in `source`; an error if its tokens may reach over white space."""
    found, known = Tokenizer.from_str(source), json.loads(source)
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["content"].split() != [t["content"]]
           for t in known["added_tokens"]):
        raise ValueError("special strings that hold white space or depend on what stands beside them")
    before = found.pre_tokenizer
    apart = [[p for p, _ in before.pre_tokenize_str(t)] if before else [t] for t in ("a", " a \t\n")]
    if not _steps(known["normalizer"]) | _steps(known["pre_tokenizer"]) <= LOCAL_STEPS or apart[0] != apart[1]:
        raise ValueError("a tokenizer whose tokens may reach over white space")
    found.no_truncation()
    found.no_padding()
    return found


@lru_cache(maxsize=2)
def same_words(source: str) -> tuple[bool, bool, tuple[str, ...]]:
    """How words may be made alike without a change of their tokens: whether stops behind letters and
    digits may stand apart, whether words in ASCII may be put in lower case, and the special strings,
    in which neither may happen."""
    known = json.loads(source)
    special = tuple(t["content"] for t in known["added_tokens"])
    steps = known["normalizer"] or {}
    steps = steps.get("normalizers", [steps])
    ends = known["pre_tokenizer"].get("pretokenizers", [known["pre_tokenizer"]])
    apart = ends[0].get("pattern") == {"Regex": LETTERS_OR_MARKS} and not any(
        re.search(STOP, t) for t in special)
    low = any(s.get("type") == "Lowercase" for s in steps) and all(
        s.get("pattern") == {"Regex": "\\s+"} for s in steps if s.get("type") == "Replace")
    return apart, low, special


def _alike(words: pa.Array, special: tuple[str, ...]) -> pa.Array:
    """Words in ASCII in lower case, but for those in which that makes a special string."""
    low = pc.if_else(pc.string_is_ascii(words), pc.ascii_lower(words), words)
    for t in special:
        low = pc.if_else(pc.equal(pc.count_substring(low, t), pc.count_substring(words, t)), low, words)
    return low


def _steps(step: dict | None) -> set[str]:
    if not step:
        return set()
    inner = step.get("normalizers", []) + step.get("pretokenizers", [])
    return {step["type"]}.union(*map(_steps, inner))


def frequencies(documents: DataFrame, source: str, text: str, keep: tuple[str, ...]) -> DataFrame:
    """(row, k_<keep>, n_bytes, words, times): the words of each row with frequencies."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    rows = documents.select(
        F.monotonically_increasing_id().alias("row"), *[F.col(f"`{c}`").alias(f"k_{c}") for c in keep],
        F.octet_length(body).cast("bigint").alias("n_bytes"), body.alias("words"),
        F.array().cast("array<int>").alias("times"))

    apart, low, special = same_words(source)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(len(batch.schema) - 2)
            if apart:
                texts = pc.replace_substring_regex(texts, STOP, r"\1 \2")
            split = pc.ascii_split_whitespace(texts)
            coded = split.flatten().dictionary_encode()
            kinds = (_alike(coded.dictionary, special) if low else coded.dictionary).dictionary_encode()
            ids = kinds.indices.to_numpy()[coded.indices.to_numpy()].astype(np.int64)
            size = max(1, len(kinds.dictionary))
            rows = np.repeat(np.arange(len(split)), np.diff(split.offsets.to_numpy()))
            full = pc.binary_length(kinds.dictionary).to_numpy() > 0
            found, times = np.unique((rows * size + ids)[full[ids]], return_counts=True)
            ends = np.searchsorted(found, np.arange(len(split) + 1) * size).astype(np.int32)
            words = kinds.dictionary.take(pa.array(found % size))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-2], pa.ListArray.from_arrays(ends, words),
                 pa.ListArray.from_arrays(ends, pa.array(times.astype(np.int32)))],
                names=batch.schema.names)

    schema = rows.withColumn("words", F.array("words")).schema
    return small_batches(rows).mapInArrow(run, schema)


def single(rows: DataFrame) -> DataFrame:
    """(row, word, n): one row for each word of each row."""
    return rows.select("row", F.explode(F.arrays_zip("words", "times")).alias("x")).select(
        "row", F.col("x.words").alias("word"), F.col("x.times").cast("bigint").alias("n"))


def vocabulary(rows: DataFrame, source: str) -> DataFrame:
    """(word, total, pieces): each distinct word, how often it occurs, and its pieces, counted once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = tokenizer_of(source)
        for batch in batches:
            n = [len(tokenizer.encode(w, add_special_tokens=False)) for w in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(n, pa.int64())],
                                             names=["word", "total", "pieces"])

    distinct = single(rows).groupBy("word").agg(F.sum("n").alias("total"))
    return distinct.mapInArrow(run, "word string, total bigint, pieces bigint")


def looked_up(rows: DataFrame, known: pa.Table) -> DataFrame:
    """`rows` with `sum`, the pieces of their words in `known`; the other words stay."""
    places = [rows.columns.index(c) for c in ("words", "times")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values = known.column("word").combine_chunks()
        weights = np.append(known.column("pieces").to_numpy(), 0)    # place -1 is the last one
        for batch in batches:
            words, times = (batch.column(i) for i in places)
            ends = words.offsets.to_numpy() - words.offsets[0].as_py()
            at = pc.fill_null(pc.index_in(words.flatten(), values), -1).to_numpy()
            value = np.append(0, np.cumsum(times.flatten().to_numpy() * weights[at]))
            rest, others = np.append(0, np.cumsum(at < 0))[ends].astype(np.int32), pa.array(at < 0)
            columns = list(batch.columns)
            for i in places:
                columns[i] = pa.ListArray.from_arrays(rest, columns[i].flatten().filter(others))
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(value[ends[1:]] - value[ends[:-1]])], names=[*batch.schema.names, "sum"])

    return rows.mapInArrow(run, rows.withColumn("sum", F.lit(None).cast("bigint")).schema)


def counted(documents: DataFrame, tokenizer: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",),
            limit: int = 2048, frequent: int = FREQUENT) -> DataFrame:
    """`keep`, n_bytes, n_tokens, over_limit for each row; `tokenizer` is a file of `tokenizers`.

    n_tokens is what that library gives without begin, end or padding; special strings in a text are
    tokens. A null text is an empty one: no bytes, no tokens. Repeated rows give repeated results,
    whatever their ids. A kept column with the name of a result is replaced by the result. Texts are
    taken whole, however long. Tokenizers whose tokens may reach over white space are an error.
    """
    with open(tokenizer, encoding="utf-8") as f:
        source = f.read()
    tokenizer_of(source)    # an error, if there is one, comes here
    keep = tuple(c for c in keep if c not in ("n_bytes", "n_tokens", "over_limit"))
    rows = saved(frequencies(documents, source, text, keep), "words", "zstd")
    pieces = saved(vocabulary(rows, source), "pieces", "zstd")
    common = pieces.where(F.length("word") <= LONGEST).orderBy(F.desc("total"), "word").limit(frequent)
    rows = saved(looked_up(rows, common.select("word", "pieces").toArrow()), "words", "zstd")
    rest = single(rows).join(pieces.select("word", "pieces"), "word").groupBy("row").agg(
        F.sum(F.col("n") * F.col("pieces")).alias("more"))
    n = F.col("sum") + F.coalesce("more", F.lit(0))
    return rows.drop("words", "times").join(rest, "row", "left").select(
        *[F.col(f"k_{c}").alias(c) for c in keep], "n_bytes", n.alias("n_tokens"),
        (n > limit).alias("over_limit"))
