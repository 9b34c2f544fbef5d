"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

Features are the distinct 5- and 7-grams of a lower-cased text's bytes, hashed into 2**20 buckets. A
bucket's scale is the log ratio of its document rates in the two classes; buckets seen in fewer than
`least_docs` documents or with a ratio below `least_ratio` are left out. A logistic regression is then
fitted on the scaled features. Counts and fit use a documented, bounded sample of labelled rows; the
scores cover every whole text.

Defined cases: a null text is empty; an empty text has the score of its padding; without an example of
either class nothing can be told and every score is 0; rows may repeat and are scored alike; an empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidescore.llm.labelled import fold_of, labelled_sample, predictions, scored_rows, texts_of

BITS = 20
BUCKETS = 1 << BITS
MIX = np.uint64(0x9E3779B97F4A7C15)  # 2**64 over the golden ratio
SHIFT = np.uint64(64 - BITS)


class Grams:
    """Distinct n-gram buckets of a text; keeps one table of positions per worker."""

    def __init__(self):
        self.slot = np.zeros(BUCKETS, np.int64)

    def __call__(self, text: str) -> np.ndarray:
        b = np.frombuffer(f" {text.lower()}      ".encode(), np.uint8).astype(np.uint64)
        two = b[:-1] | b[1:] << np.uint64(8)
        four = two[:-2] | two[2:] << np.uint64(16)
        five = four[:-1] | b[4:] << np.uint64(32) | np.uint64(5 << 56)
        seven = four[:-3] | two[4:-1] << np.uint64(32) | b[6:] << np.uint64(48) | np.uint64(7 << 56)
        h = (np.concatenate([five, seven]) * MIX >> SHIFT).astype(np.int64)
        # A bucket's last position wins the slot, so exactly one position per bucket finds itself there.
        at = np.arange(len(h))
        self.slot[h] = at
        return h[self.slot[h] == at]


@dataclass
class Model:
    weights: np.ndarray  # scale times coefficient, one per bucket
    bias: float
    known: bool  # whether both classes had examples


def class_counts(sample: DataFrame) -> DataFrame:
    """Documents of each class per bucket: bucket, plain, toxic."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, counts = Grams(), np.zeros((2, BUCKETS), np.int32)
        for part, texts in texts_of(batches, 0):
            for text, label in zip(texts, part.column(1).to_pylist()):
                counts[int(label > 0)][grams(text)] += 1
        bucket = np.nonzero(counts.any(axis=0))[0]
        yield pa.RecordBatch.from_arrays(
            [pa.array(bucket, pa.int32()), *(pa.array(c[bucket], pa.int32()) for c in counts)], ["bucket", "plain", "toxic"])

    found = sample.select("text", "label").mapInArrow(run, "bucket int, plain int, toxic int")
    return found.groupBy("bucket").agg(F.sum("plain").alias("plain"), F.sum("toxic").alias("toxic"))


def log_ratios(sample: DataFrame, smoothing: float, least_ratio: float, least_docs: int) -> np.ndarray | None:
    """Scale per bucket, 0 where it is left out; None unless both classes have examples."""
    docs = {int(r["toxic"]): r["n"] for r in sample.groupBy((F.col("label") > 0).cast("int").alias("toxic"))
            .agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(docs) < 2:
        return None
    rate = lambda c, k: F.log((F.col(c) + smoothing) / (docs[k] + 2 * smoothing))
    rows = (
        class_counts(sample).where(F.col("plain") + F.col("toxic") >= least_docs)
        .select("bucket", (rate("toxic", 1) - rate("plain", 0)).alias("ratio"))
        .where(F.abs("ratio") >= least_ratio).toArrow()
    )
    out = np.zeros(BUCKETS)
    out[rows["bucket"].to_numpy()] = rows["ratio"].to_numpy()
    return out


def fit_logistic(cols: np.ndarray, ends: np.ndarray, y: np.ndarray, scale: np.ndarray, rounds: int, l2: float):
    """Full-batch AdaGrad on rows given as runs of bucket numbers."""
    n = len(y)
    used, cols = np.unique(cols, return_inverse=True)
    scale = scale[used]
    row, value = np.repeat(np.arange(n), np.diff(ends)), scale[cols]
    w, seen, bias, seen_bias = np.zeros(len(used)), np.full(len(used), 1e-12), np.log(y.mean() / (1 - y.mean())), 1e-12
    for _ in range(rounds):
        z = np.bincount(row, weights=value * w[cols], minlength=n) + bias
        error = 1 / (1 + np.exp(-z)) - y
        slope = np.bincount(cols, weights=value * error[row], minlength=len(used)) / n + l2 * w
        seen += slope * slope
        seen_bias += error.mean() ** 2
        w -= 0.1 * slope / np.sqrt(seen)
        bias -= 0.1 * error.mean() / np.sqrt(seen_bias)
    out = np.zeros(BUCKETS)
    out[used] = w * scale
    return out, bias


def fit(
    sample: DataFrame, smoothing: float = 1.0, least_ratio: float = 1.75, least_docs: int = 6, rounds: int = 100,
    l2: float = 1e-4,
) -> Model:
    """Fit on a sample (text, label) of bounded size: counts on all executors, the regression in one task."""
    ratio = log_ratios(sample, smoothing, least_ratio, least_docs)
    if ratio is None:
        return Model(np.zeros(BUCKETS, np.float32), 0.0, False)
    sent = sample.sparkSession.sparkContext.broadcast(ratio)

    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams()
        for part, texts in texts_of(batches, 0):
            kept = []
            for text in texts:
                found = grams(text)
                kept.append(np.sort(found[sent.value[found] != 0]).astype("<i4").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(kept, pa.binary()), part.column(1)], ["grams", "label"])

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs, y = [], []
        for batch in batches:
            runs += batch.column(0).to_pylist()
            y += [float(v > 0) for v in batch.column(1).to_pylist()]
        order = sorted(range(len(runs)), key=lambda i: (runs[i], y[i]))  # a result that no row order changes
        cols = np.frombuffer(b"".join([runs[i] for i in order]), "<i4").astype(np.int64)
        ends = np.cumsum([0] + [len(runs[i]) // 4 for i in order])
        w, bias = fit_logistic(cols, ends, np.array([y[i] for i in order]), sent.value, rounds, l2)
        yield pa.RecordBatch.from_arrays(
            [pa.array([w.astype("<f4").tobytes()], pa.binary()), pa.array([float(bias)])], ["weights", "bias"])

    selected = sample.select("text", "label").mapInArrow(select, "grams binary, label int")
    best = selected.repartition(1).mapInArrow(solve, "weights binary, bias double").first()
    return Model(np.frombuffer(best["weights"], "<f4"), best["bias"], True)


def scorer(model: Model):
    """Builds the function from texts to scores between 0 and 1."""
    def make():
        grams = Grams()

        def score(texts: list[str]) -> np.ndarray:
            z = np.array([model.weights[grams(t)].sum(dtype=np.float64) for t in texts]) + model.bias
            return 1 / (1 + np.exp(-np.clip(z, -500, 500))) if model.known else np.zeros(len(texts))

        return score

    return make


def scored(
    docs: DataFrame, labels: DataFrame, carried: list[str], label_col: str, folds: int, held_fold: int, sample_rows: int,
    id_col: str, text_col: str,
) -> DataFrame:
    sample = labelled_sample(
        docs, labels, label_col, fold_of(F.col("doc"), folds) != held_fold, sample_rows, id_col, text_col)
    sent = docs.sparkSession.sparkContext.broadcast(fit(sample))
    return scored_rows(docs, carried, text_col, lambda: scorer(sent.value)())


def classify(
    docs: DataFrame, labels: DataFrame, label_col: str = "toxic", folds: int = 5, held_fold: int = 0,
    sample_rows: int = 24_000, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Learn from labelled rows outside the held-out fold (at most `sample_rows`), then score every text."""
    rows = scored(docs, labels, [id_col], label_col, folds, held_fold, sample_rows, id_col, text_col)
    return predictions(rows, id_col, folds, held_fold)


def drop_toxic(
    docs: DataFrame, labels: DataFrame, label_col: str = "toxic", folds: int = 5, held_fold: int = 0,
    sample_rows: int = 24_000, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """The rows of `docs`, all columns, whose score is below 0.5."""
    rows = scored(docs, labels, docs.columns, label_col, folds, held_fold, sample_rows, id_col, text_col)
    return rows.where(F.col("score") < 0.5).select("row.*")
