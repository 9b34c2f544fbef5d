"""Quality by nearest-neighbour voting in a latent-semantic space.

A text's terms are its byte trigrams, hashed into 2**12 buckets, and a few shape terms (bands of the
share of capitals, digits, symbols, repeated words and lines). Both kinds are weighted by TF-IDF with
document frequencies over all documents and scaled to equal length; a truncated singular value
decomposition of a bounded sample gives the latent space. A bounded sample of labelled vectors is
broadcast, every document is compared with all of them by blocked cosine products, and its nearest
neighbours' labels are averaged with weights that grow with the cosine.

Defined cases: a null text is empty, and an empty text has a vector too; without labelled rows every
score is 0.5 and so kept; ties between neighbours go to the smaller labelled id; rows may repeat; an
empty table gives no rows.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidescore.llm.labelled import fold_of, labelled_sample, predictions, scored_rows, texts_of

BITS = 12
BUCKETS = 1 << BITS
# Bounds between the bands of a share; each share has one term per band.
BANDS = np.array([0.002, 0.01, 0.03, 0.08, 0.2, 0.5])
SHARES = 7
TERMS = BUCKETS + SHARES * (len(BANDS) + 1)
CAPITAL, DIGIT, SYMBOL, WIDE, SPACE = range(1, 6)


def byte_kinds() -> np.ndarray:
    kinds = np.zeros(256, np.int64)
    for b in range(256):
        c = chr(b)
        kinds[b] = (
            CAPITAL if "A" <= c <= "Z" else DIGIT if "0" <= c <= "9" else WIDE if b >= 128
            else SPACE if b <= 32 else 0 if c.isalpha() else SYMBOL
        )
    return kinds


KINDS = byte_kinds()


def term_counts(text: str) -> np.ndarray:
    """Counts of all terms of one text."""
    raw = np.frombuffer(f"{text}   ".encode(), np.uint8)
    b = raw.astype(np.uint32)
    h = (b[:-2] | b[1:-1] << np.uint32(8) | b[2:] << np.uint32(16)) * np.uint32(0x9E3779B1) >> np.uint32(32 - BITS)
    words, lines = text.split(), [x for x in text.split("\n") if x]
    kinds = np.bincount(KINDS[raw[:-3]], minlength=6)[1:] / max(1, len(raw) - 3)
    again = sum(map(operator.eq, words, words[1:])) / max(1, len(words) - 1)
    shares = [*kinds, again, 1 - len(set(lines)) / max(1, len(lines))]
    out = np.zeros(TERMS, np.float32)
    out[:BUCKETS] = np.bincount(h, minlength=BUCKETS)
    for i, share in enumerate(shares):
        out[BUCKETS + i * (len(BANDS) + 1) + np.searchsorted(BANDS, share, side="right")] = 1
    return out


def counts_of(texts: list[str]) -> np.ndarray:
    return np.array([term_counts(t) for t in texts], np.float32).reshape(-1, TERMS)


def unit(rows: np.ndarray) -> np.ndarray:
    return rows / (np.linalg.norm(rows, axis=1, keepdims=True) + 1e-12)


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(counts) * idf
    return np.hstack([unit(x[:, :BUCKETS]), unit(x[:, BUCKETS:])]).astype(np.float32)


@dataclass
class Model:
    idf: np.ndarray
    space: np.ndarray  # terms x dimensions
    vectors: np.ndarray  # labelled unit vectors
    labels: np.ndarray


def inverse_frequencies(docs: DataFrame, text_col: str) -> np.ndarray:
    """log((1 + documents) / (1 + documents with the term)) + 1, over all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(TERMS + 1, np.int64)
        for _, texts in texts_of(batches, 0, 256):
            seen[:TERMS] += (counts_of(texts) > 0).sum(axis=0)
            seen[TERMS] += len(texts)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(TERMS + 1), pa.int32()), pa.array(seen)], ["term", "n"])

    source = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = source.mapInArrow(run, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    seen = np.zeros(TERMS + 1)
    seen[rows["term"].to_numpy()] = rows["n"].to_numpy()
    return (np.log((1 + seen[TERMS]) / (1 + seen[:TERMS])) + 1).astype(np.float32)


def latent_space(sample: DataFrame, idf, dimensions: int, sweeps: int = 4) -> np.ndarray:
    """Leading right singular vectors of the sample's TF-IDF rows, by subspace iteration in one bounded task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [(d, weighted(counts_of([t]), idf.value)[0]) for part, texts in texts_of(batches, 0)
                for d, t in zip(part.column(1).to_pylist(), texts)]
        a = np.array([r for _, r in sorted(rows, key=lambda x: (x[0], x[1].tobytes()))], np.float32)
        base = np.random.default_rng(7).standard_normal((TERMS, dimensions + 16)).astype(np.float32)
        for _ in range(sweeps):
            base, _ = np.linalg.qr(a.T @ (a @ base))
        _, _, right = np.linalg.svd(a @ base, full_matrices=False)
        space = (base @ right.T[:, :dimensions]).astype("<f4")
        yield pa.RecordBatch.from_arrays([pa.array([space.tobytes()], pa.binary())], ["space"])

    best = sample.select("text", "doc").repartition(1).mapInArrow(run, "space binary").first()
    return np.frombuffer(best["space"], "<f4").reshape(TERMS, -1)


def fit(docs: DataFrame, sample: DataFrame, text_col: str, space_rows: int, dimensions: int) -> Model | None:
    """`sample`: labelled rows of bounded number; the `space_rows` first of them span the latent space."""
    first = sample.orderBy("hash", "doc").limit(space_rows)
    if first.isEmpty():
        return None
    context = docs.sparkSession.sparkContext
    idf = inverse_frequencies(docs, text_col)
    sent_idf = context.broadcast(idf)
    space = latent_space(first, sent_idf, dimensions)
    sent = context.broadcast((idf, space))

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_idf, own_space = sent.value
        for part, texts in texts_of(batches, 0, 256):
            vectors = unit(weighted(counts_of(texts), own_idf) @ own_space).astype("<f4")
            yield pa.RecordBatch.from_arrays(
                [part.column(1), part.column(2), pa.array([v.tobytes() for v in vectors], pa.binary())],
                ["doc", "label", "vector"])

    kind = sample.schema["doc"].dataType.simpleString()
    rows = (
        sample.select("text", "doc", "label").mapInArrow(project, f"doc {kind}, label int, vector binary")
        .orderBy("doc", "vector").toArrow()
    )
    vectors = np.frombuffer(b"".join(rows["vector"].to_pylist()), "<f4").reshape(len(rows), -1)
    return Model(idf, space, vectors, (rows["label"].to_numpy() > 0).astype(np.float32))


def nearest(near: np.ndarray, k: int) -> np.ndarray:
    """Columns of the k largest values of each row; of equal ones those of smaller columns."""
    if k >= near.shape[1]:
        return np.tile(np.arange(near.shape[1]), (len(near), 1))
    at = np.argpartition(-near, k - 1, axis=1)[:, :k]
    least = np.take_along_axis(near, at, 1).min(axis=1)
    for row in np.flatnonzero((near >= least[:, None]).sum(axis=1) > k):
        among = np.flatnonzero(near[row] >= least[row])
        at[row] = among[np.argsort(-near[row, among], kind="stable")[:k]]
    return at


def votes(model: Model, texts: list[str], neighbours: int, power: float) -> np.ndarray:
    x = unit(weighted(counts_of(texts), model.idf) @ model.space)
    near = x @ model.vectors.T
    k = min(neighbours, near.shape[1])
    at = nearest(near, k)
    weight = np.maximum(np.take_along_axis(near, at, 1), 1e-6).astype(np.float64) ** power
    return (weight * model.labels[at]).sum(axis=1) / weight.sum(axis=1)


def scored(
    docs: DataFrame, labels: DataFrame, carried: list[str], label_col: str, folds: int, held_fold: int, sample_rows: int,
    space_rows: int, dimensions: int, neighbours: int, power: float, id_col: str, text_col: str,
) -> DataFrame:
    sample = labelled_sample(
        docs, labels, label_col, fold_of(F.col("doc"), folds) != held_fold, sample_rows, id_col, text_col)
    sent = docs.sparkSession.sparkContext.broadcast(fit(docs, sample, text_col, space_rows, dimensions))

    def score(texts: list[str]) -> np.ndarray:
        if sent.value is None:
            return np.full(len(texts), 0.5)
        return np.clip(votes(sent.value, texts, neighbours, power), 0, 1)

    return scored_rows(docs, carried, text_col, lambda: score)


def classify(
    docs: DataFrame, labels: DataFrame, label_col: str = "quality", folds: int = 3, held_fold: int = 1,
    sample_rows: int = 8192, space_rows: int = 3072, dimensions: int = 64, neighbours: int = 9, power: float = 8.0,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Learn from labelled rows outside the held-out fold (at most `sample_rows`), then score every text."""
    rows = scored(docs, labels, [id_col], label_col, folds, held_fold, sample_rows, space_rows, dimensions, neighbours,
                  power, id_col, text_col)
    return predictions(rows, id_col, folds, held_fold)


def keep_good(
    docs: DataFrame, labels: DataFrame, label_col: str = "quality", folds: int = 3, held_fold: int = 1,
    sample_rows: int = 8192, space_rows: int = 3072, dimensions: int = 64, neighbours: int = 9, power: float = 8.0,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """The rows of `docs`, all columns, whose score is at least 0.5."""
    rows = scored(docs, labels, docs.columns, label_col, folds, held_fold, sample_rows, space_rows, dimensions,
                  neighbours, power, id_col, text_col)
    return rows.where(F.col("score") >= 0.5).select("row.*")
