"""Quality scores by Bradley-Terry ranking of preference pairs, cut at a quantile of the scores."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemart.llm.shared import HASH_BITS, giving_back, row_hash, saved, small_batches

FEATURES = ("words", "word_length", "longest_word", "distinct_words", "repeated_next",
            "upper", "digits", "stops", "shouts", "bars", "symbols", "white", "beyond_ascii",
            "marked_words", "line_words", "repeated_lines", "frequent_word")
CUT = 0.7   # the score of a document that lies on the quantile


def _of(*chars: str) -> np.ndarray:
    mask = np.zeros(256)
    mask[list("".join(chars).encode())] = 1
    return mask


_UPPER, _DIGITS = _of("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _of("0123456789")
_STOPS, _SHOUTS, _BARS = _of(".,;:?"), _of("!"), _of("|")
_SYMBOLS, _WHITE = _of("#$%&*+<=>@[]^_`{}~\\/"), _of(" \t\n\r")
_BEYOND = np.concatenate([np.zeros(128), np.ones(128)])
_MASKS = np.stack([_UPPER, _DIGITS, _STOPS, _SHOUTS, _BARS, _SYMBOLS, _WHITE, _BEYOND])


def features(text: bytes | None) -> list[float]:
    """Surface measures of a text in UTF-8: sizes as logarithms, the rest as shares from 0 to 1.

    Null and empty texts have zeros throughout.
    """
    if not text:
        return [0.0] * len(FEATURES)
    shares = _MASKS @ np.bincount(np.frombuffer(text, np.uint8), minlength=256) / len(text)
    words = text.lower().split()
    n = len(words) or 1
    kinds = {}
    for w in words:
        kinds[w] = kinds.get(w, 0) + 1
    lines = [line for line in text.split(b"\n") if line]
    lengths = sum(map(len, words))
    return [np.log1p(len(words)), np.log1p(lengths / n), np.log1p(max(map(len, words), default=0)),
            len(kinds) / n, sum(map(bytes.__eq__, words, words[1:])) / n, *shares[:6].tolist(),
            float(shares[6]), float(shares[7]),
            sum(not w.isalpha() for w in words) / n, np.log1p(n / (len(lines) or 1)),
            1 - len(set(lines)) / (len(lines) or 1), max(kinds.values(), default=0) / n]


def featured(documents: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)
             ) -> DataFrame:
    """The columns `keep` and the array `x` of FEATURES."""
    kept = documents.select(*[F.col(f"`{c}`") for c in keep])
    rows = documents.select(*kept.columns, F.col(f"`{text}`").cast("binary").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [features(t.as_py()) for t in batch.column("__text")]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(values, pa.list_(pa.float64()))],
                names=[*batch.schema.names[:-1], "x"])

    schema = T.StructType([*kept.schema.fields, T.StructField("x", T.ArrayType(T.DoubleType()))])
    return small_batches(rows).mapInArrow(giving_back(run), schema)


@dataclass(frozen=True)
class QualityModel:
    """Utility of a document: weights . (expanded features); score: CUT where the utility is `cut`."""
    mean: tuple[float, ...]
    scale: tuple[float, ...]
    weights: tuple[float, ...]
    cut: float = 0.0

    def utility(self, x: Column) -> Column:
        total = F.lit(0.0)
        n = len(self.mean)
        for i in range(n):
            z = _bounded((x[i] - F.lit(self.mean[i])) / F.lit(self.scale[i]))
            total = total + z * F.lit(self.weights[i]) + z * z * F.lit(self.weights[n + i])
        return total

    def utilities(self, x: np.ndarray) -> np.ndarray:
        """The same for rows of features on one machine."""
        return expand(x, np.array(self.mean), np.array(self.scale)) @ np.array(self.weights)

    def score(self, utility: Column) -> Column:
        """Between 0 and 1, rising with the utility, CUT at the cut: the chance to beat a document
        there, with its odds moved so that even odds read as CUT."""
        odds = float(np.log(CUT / (1 - CUT)))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(self.cut - odds) - utility))


REACH = 8.0   # features farther than this many deviations from the mean count as that far


def _bounded(z: Column) -> Column:
    return F.least(F.greatest(z, F.lit(-REACH)), F.lit(REACH))


def expand(x: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    z = np.clip((x - mean) / scale, -REACH, REACH)
    return np.hstack([z, z * z])


def bradley_terry(good: np.ndarray, bad: np.ndarray, pairs: int = 60_000, ridge: float = 3.0,
                  seed: int = 5, rounds: int = 30) -> np.ndarray:
    """Weights that make `good` rows beat `bad` rows: logistic loss on feature differences.

    Every row of the larger class is drawn at least once, if `pairs` allows, against rows of the
    other drawn at random. Newton steps with a ridge term.
    """
    rng = np.random.default_rng(seed)
    left = good[np.resize(rng.permutation(len(good)), pairs)]
    right = bad[np.resize(rng.permutation(len(bad)), pairs)[rng.permutation(pairs)]]
    gap = left - right
    w = np.zeros(gap.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(np.clip(gap @ w, -500, 500)))        # chance that the worse one wins
        slope = gap.T @ p - ridge * w
        curve = (gap * (p * (1 - p))[:, None]).T @ gap + ridge * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def labelled(rows: DataFrame, labels: DataFrame, learn: Column, doc_id: str = "doc_id",
             quality: str = "quality") -> DataFrame:
    """Rows (doc_id, x) with their label `good`; a document with several labels takes the least.

    Labels without an id or a quality count for nothing.
    """
    marks = labels.select(F.col(doc_id).alias("doc_id"), F.col(quality).alias("good")).where(
        "good IS NOT NULL").groupBy("doc_id").agg(F.min("good").alias("good"))
    return rows.where(learn).join(marks, "doc_id")


def fit(rows: DataFrame, labels: DataFrame, learn: Column, most: int = 20_000, steps: int = 400,
        seed: int = 5) -> QualityModel:
    """Learn from rows (doc_id, x) with `learn` that have a label.

    Weights are fitted on the driver to a sample of `most` labelled rows at the most, chosen by a hash
    of the id and the row's place, so that rows that share an id are drawn one by one. The cut is a quantile of the utilities of all rows, the one (of `steps`) at
    which all labelled rows are told apart best, both classes weighing the same; of a run of
    equally good quantiles the middle. With one class only there are no pairs: all weights are 0, and
    the cut is such that every document is predicted to be of that class (1 where there are none).
    """
    placed = rows.withColumn("place", F.monotonically_increasing_id().cast("string"))
    known = labelled(placed, labels, learn)
    n = known.count()
    some = 1.0 if n <= most else max(1.0, most - 3 * most ** 0.5) / n
    chosen = known.where(row_hash("doc_id", "place", seed=seed) < int(some * (1 << HASH_BITS)))
    sample = chosen.select("good", "x").limit(most).collect()
    x = np.array([r["x"] for r in sample]).reshape(len(sample), len(FEATURES))
    good = np.array([r["good"] >= 1 for r in sample], bool)
    if not good.any() or good.all():
        zeros = tuple([0.0] * len(FEATURES))
        return QualityModel(zeros, tuple([1.0] * len(FEATURES)), zeros * 2,
                            1.0 if len(good) and not good.any() else -1.0)
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale = np.where(scale > 1e-9, scale, 1.0)
    wide = expand(x, mean, scale)
    weights = bradley_terry(wide[good], wide[~good], seed=seed)
    model = QualityModel(tuple(mean.tolist()), tuple(scale.tolist()), tuple(weights.tolist()))
    return QualityModel(model.mean, model.scale, model.weights,
                        quantile_cut(rows, known, model, steps))


def quantile_cut(rows: DataFrame, known: DataFrame, model: QualityModel, steps: int,
                 bins: int = 4096) -> float:
    """The utility at the best of the quantiles 1/steps, 2/steps ... of all rows.

    Utilities are counted in `bins` equal bins between the least and the largest, so quantiles are
    bin edges; only these counts reach the driver.
    """
    utility = model.utility(F.col("x"))
    least, largest = rows.agg(F.min(utility), F.max(utility)).first()
    width = max(largest - least, 1e-9) / bins
    at = F.least(F.floor((utility - F.lit(least)) / F.lit(width)), F.lit(bins - 1)).alias("at")
    everything, counts = np.zeros(bins), np.zeros((bins, 2))
    for r in rows.groupBy(at).count().collect():
        everything[r["at"]] = r["count"]
    for r in known.groupBy(at, (F.col("good") >= 1).cast("int").alias("good")).count().collect():
        counts[r["at"], r["good"]] = r["count"]
    below, totals = everything.cumsum(), np.maximum(counts.sum(axis=0), 1)
    levels = below[-1] * np.arange(1, steps) / steps
    edges = np.unique(np.append(np.searchsorted(below, levels), [0]))   # the cut is above this bin
    worse, better = counts.cumsum(axis=0)[edges, 0], totals[1] - counts.cumsum(axis=0)[edges, 1]
    right = worse / totals[0] + better / totals[1]
    best = np.flatnonzero(right >= right.max() - 1e-12)
    run = np.split(best, np.flatnonzero(np.diff(best) > 1) + 1)[0]
    return float(least + width * (1 + (edges[run[0]] + edges[run[-1]]) / 2))


def scored(documents: DataFrame, labels: DataFrame, learn: Column, text: str = "text",
           doc_id: str = "doc_id", most: int = 20_000) -> DataFrame:
    """(doc_id, score, predicted) of every row; rows without text are scored like any other."""
    rows = saved(featured(documents.withColumnRenamed(doc_id, "doc_id"), text), "features")
    model = fit(rows, labels, learn, most)
    score = model.score(model.utility(F.col("x")))
    return rows.select("doc_id", score.alias("score"),
                       (score >= CUT).cast("int").alias("predicted"))


def kept(documents: DataFrame, model: QualityModel, text: str = "text") -> DataFrame:
    """The documents whose utility is at least the cut, in one pass over their texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text).cast(pa.binary())
            x = np.array([features(t.as_py()) for t in texts]).reshape(-1, len(FEATURES))
            yield batch.filter(pa.array(model.utilities(x) >= model.cut))

    return small_batches(documents).mapInArrow(giving_back(run), documents.schema)
