"""Language ID with hyperdimensional profiles of letter trigrams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.llm.shared import HASH_BITS, row_hash, small_batches

DIMENSIONS = 512
CLASSES = 4096         # letters by code point modulo this; class 0 is everything that is no letter
DOCUMENTS_AT_ONCE = 32
LETTERS_AT_ONCE = 1 << 20
UNKNOWN = "und"


@lru_cache(maxsize=1)
def letter_classes() -> np.ndarray:
    """Class of every code point: 0 for what is no letter, else 1 to CLASSES - 1."""
    return np.array([1 + c % (CLASSES - 1) if chr(c).isalpha() else 0 for c in range(0x110000)],
                    np.int32)


@lru_cache(maxsize=4)
def letter_vectors(dimensions: int, seed: int) -> tuple[np.ndarray, ...]:
    """Random +-1 vectors of the classes, permuted (rotated) twice, once and not at all."""
    plain = np.random.default_rng(seed).integers(0, 2, (CLASSES, dimensions), np.int8) * 2 - 1
    return np.roll(plain, 2, axis=1), np.roll(plain, 1, axis=1), plain


def trigram_codes(text: str) -> np.ndarray:
    """Codes of the letter trigrams of a text in lower case, runs of other characters as one gap.

    The text is framed by gaps, so that a single letter has a trigram. No letters: no trigrams.
    """
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letters = np.concatenate([[0], letter_classes()[points], [0]])
    kept = letters[(letters > 0) | np.concatenate([[True], letters[:-1] > 0])].astype(np.int64)
    return (kept[:-2] * CLASSES + kept[1:-1]) * CLASSES + kept[2:]


def bundle(texts: list[str | None], dimensions: int, seed: int) -> np.ndarray:
    """One row per text: the sum of its trigrams' vectors, each bound from its letters' vectors."""
    out = np.zeros((len(texts), dimensions), np.float32)
    codes, owners, held = [], [], 0

    def add() -> None:
        if not held:
            return
        kinds, which = np.unique(np.concatenate(codes), return_inverse=True)
        rows = np.array([i for i, c in zip(owners, codes) if len(c)])
        lengths = [len(c) for c in codes if len(c)]
        places = np.repeat(np.arange(len(rows)), lengths) * len(kinds) + which
        counts = np.bincount(places, minlength=len(rows) * len(kinds)).reshape(len(rows), -1)
        first, second, third = letter_vectors(dimensions, seed)
        vectors = (first[kinds // CLASSES ** 2] * second[kinds // CLASSES % CLASSES]
                   * third[kinds % CLASSES])
        np.add.at(out, rows, counts.astype(np.float32) @ vectors.astype(np.float32))

    for i, text in enumerate(texts):
        whole = trigram_codes(text) if text else np.zeros(0, np.int64)
        for at in range(0, len(whole), LETTERS_AT_ONCE):
            part = whole[at:at + LETTERS_AT_ONCE]
            codes.append(part)
            owners.append(i)
            held += len(part)
            if held >= LETTERS_AT_ONCE or len(set(owners)) >= DOCUMENTS_AT_ONCE:
                add()
                codes, owners, held = [], [], 0
    add()
    return out


def unit(rows: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, norms, out=np.zeros_like(rows), where=norms > 0)


@dataclass(frozen=True)
class LanguageModel:
    """Unit prototypes of the languages, in order of their names."""
    names: tuple[str, ...]
    prototypes: np.ndarray
    seed: int

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """The nearest prototype's language and (1 + cosine) / 2; `und` and 0 without a letter."""
        vectors = bundle(texts, self.prototypes.shape[1], self.seed)
        some = np.abs(vectors).any(axis=1) | np.array(
            [any(map(str.isalpha, t)) if t and not v.any() else False
             for t, v in zip(texts, vectors)], bool)
        if not self.names:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        cosines = unit(vectors) @ self.prototypes.T
        best = cosines.argmax(axis=1)
        score = np.clip((1 + cosines[np.arange(len(texts)), best].astype(float)) / 2, 0, 1)
        return ([self.names[b] if s else UNKNOWN for b, s in zip(best, some)],
                np.where(some, score, 0.0))


def sampled(documents: DataFrame, learn: Column, text: str, lang: str, key: str, per_language: int,
            seed: int) -> DataFrame | None:
    """(lang, text) of the rows to learn from, at most `per_language` a language; None without any.

    Where a language has more, rows are drawn by a hash of the key and the row's place in the table,
    so that rows that share a key, or are the same, are drawn one by one.
    """
    place = F.monotonically_increasing_id().cast("string")
    rows = documents.select(
        F.col(f"`{lang}`").alias("lang"), F.col(f"`{text}`").alias("text"), learn.alias("learn"),
        row_hash(F.col(f"`{key}`").cast("string"), place, seed=seed).alias("h")).where(
            F.col("learn") & F.col("lang").isNotNull())
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not sizes:
        return None
    share = F.lit(0)
    for name, n in sizes.items():
        # so many that the draw hardly ever exceeds what is taken
        some = 1.0 if n <= per_language else max(1.0, per_language - 3 * per_language ** 0.5) / n
        bound = int(some * (1 << HASH_BITS))
        share = F.when(F.col("lang") == name, F.lit(bound)).otherwise(share)
    first = F.row_number().over(Window.partitionBy("lang").orderBy("h"))
    drawn = rows.where(F.col("h") < share).withColumn("rank", first)
    return drawn.where(F.col("rank") <= per_language).select("lang", "text")


def fit(documents: DataFrame, learn: Column, text: str = "text", lang: str = "lang",
        key: str = "doc_id", per_language: int = 4000, dimensions: int = DIMENSIONS,
        seed: int = 7) -> LanguageModel:
    """Prototypes: the sum of the unit vectors of documents of a language.

    Learnt from the rows with `learn` and a language. `per_language` bounds the rows that a language
    is learnt from: where it has more, nearly so many are drawn (`sampled`).
    The number of languages is taken to fit the driver; nothing else reaches it. Texts without
    letters add nothing; a language with such texts only is learnt as no vector, and never chosen.
    """
    chosen = sampled(documents, learn, text, lang, key, per_language, seed)
    if chosen is None:
        return LanguageModel((), np.zeros((0, dimensions), np.float32), seed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            vectors = unit(bundle(batch.column("text").to_pylist(), dimensions, seed))
            langs = np.array(batch.column("lang").to_pylist(), object)
            for name in set(langs):
                sums[name] = sums.get(name, 0) + vectors[langs == name].sum(axis=0, dtype=float)
        for name, total in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * dimensions), pa.array(np.arange(dimensions)), pa.array(total)],
                names=["lang", "place", "value"])

    totals = small_batches(chosen).mapInArrow(run, "lang string, place bigint, value double").groupBy(
        "lang", "place").agg(F.sum("value").alias("value")).collect()
    names = tuple(sorted({r["lang"] for r in totals}))
    prototypes = np.zeros((len(names), dimensions))
    for r in totals:
        prototypes[names.index(r["lang"]), r["place"]] = r["value"]
    return LanguageModel(names, unit(prototypes).astype(np.float32), seed)


def predict(documents: DataFrame, model: LanguageModel, text: str = "text",
            lang_pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """The rows with `lang_pred` and `score` added.

    A text that is null, empty or without a letter is `und` with score 0. Ties go to the language
    that is first by name.
    """
    handed = model

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = handed.predict(batch.column(text).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=[*batch.schema.names, lang_pred, score])

    if {lang_pred, score} & set(documents.columns):
        raise ValueError(f"{lang_pred} or {score} is in use")
    schema = T.StructType([*documents.schema.fields, T.StructField(lang_pred, T.StringType()),
                           T.StructField(score, T.DoubleType())])
    return small_batches(documents).mapInArrow(run, schema)
