"""Quality classifier: random-indexing word vectors, pooled per document, and a two-layer network with calibrated probabilities.

Tokens are words and runs of other signs; a word equal to the one before it, and a word in capitals, count as marks
of their own. Tokens are hashed into BUCKETS. Each bucket has a fixed sparse ternary index vector; its context vector
is the sum, over all its occurrences in all documents, of the index vectors of the tokens up to two places away. The
sums are taken per partition in numpy and then by a grouped sum, and the table has BUCKETS rows whatever the input, so
it is broadcast. A document is the mean of its tokens' index and scaled context vectors. The network (tanh, then
logistic) is trained on a bounded sample of labelled rows; a tenth of it, set aside, gives the temperature.

Nulls: a null text is an empty one, whose vector is 0; null labels and null ids aren't learned from. Repeated rows and
extra columns are ordinary. Without labels of both kinds every score is the share of label 1 (0.5 without any).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandmill.llm.labelled import fold, sample
from strandmill.llm.shared import small_batches
from strandmill.llm.words import ALNUM, SPACED, U, bucketed, chunks, mix, split_words, text_bytes

BITS, DIM = 15, 16
BUCKETS = 1 << BITS
REPEATED, CAPITALS = 0, 1
SIGNS = SPACED & ~ALNUM
TRAIN_ROWS = 6000
RESULT_SCHEMA = "doc_id bigint, held_out boolean, score double, predicted int"


def index_vectors() -> np.ndarray:
    """Ternary rows, an eighth of the entries 1 and an eighth -1."""
    draw = (mix(np.arange(1, BUCKETS * DIM + 1, dtype=U)) >> U(61)).astype(np.int8).reshape(BUCKETS, DIM)
    return (draw == 0).astype(np.int8) - (draw == 1).astype(np.int8)


def token_buckets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of each token, first token of each document)."""
    words, signs = split_words(data, offsets, ALNUM), split_words(data, offsets, SIGNS)
    bucket = np.maximum(bucketed(words.hash, BITS), 2)
    if len(words.hash) > 1:
        same = np.zeros(len(bucket), bool)
        same[1:] = words.hash[1:] == words.hash[:-1]
        same[words.first[:-1][words.first[:-1] < len(same)]] = False
        upper = np.concatenate([[0], np.cumsum((data >= 65) & (data <= 90), dtype=np.int32)])
        size = words.end - words.start
        bucket[(size > 2) & (upper[words.end] - upper[words.start] == size)] = CAPITALS
        bucket[same] = REPEATED
    order = np.argsort(np.concatenate([words.start, signs.start]))
    both = np.concatenate([bucket, np.maximum(bucketed(signs.hash, BITS), 2)])[order]
    return both, words.first + signs.first


def context_sums(docs: DataFrame) -> np.ndarray:
    """Summed index vectors of the neighbours of each bucket, over all documents: BUCKETS rows."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = index_vectors().astype(np.float32)
        total = np.zeros((DIM, BUCKETS))
        for part in chunks(batches, "text", 1 << 19):
            bucket, first = token_buckets(*text_bytes(part.column(0)))
            doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
            own = index[bucket]
            near = np.zeros_like(own)
            for k in (1, 2):
                if len(bucket) > k:
                    inside = (doc[k:] == doc[:-k])[:, None]
                    near[k:] += own[:-k] * inside
                    near[:-k] += own[k:] * inside
            for d in range(DIM):
                total[d] += np.bincount(bucket, near[:, d], BUCKETS)
        used = np.flatnonzero(total.any(0))
        step = 1 << 13
        for i in range(0, len(used), step):
            b = used[i : i + step]
            yield pa.RecordBatch.from_arrays([pa.array(b.astype(np.int32)), *(pa.array(total[d, b].astype(np.int64)) for d in range(DIM))], ["bucket", *(f"c{d}" for d in range(DIM))])

    schema = "bucket int, " + ", ".join(f"c{d} bigint" for d in range(DIM))
    sums = docs.select("text").mapInArrow(work, schema).groupBy("bucket").agg(*(F.sum(f"c{d}").alias(f"c{d}") for d in range(DIM)))
    out = np.zeros((BUCKETS, DIM))
    got = sums.toPandas().to_numpy()  # at most BUCKETS rows
    out[got[:, 0].astype(int)] = got[:, 1:]
    return out


def word_vectors(sums: np.ndarray) -> np.ndarray:
    """Index vectors, and context vectors scaled to length 1."""
    scale = np.sqrt((sums**2).sum(1, keepdims=True))
    return np.hstack([index_vectors(), sums / np.maximum(scale, 1)]).astype(np.float32)


def pooled(data: np.ndarray, offsets: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Mean vector of each document, and the logarithm of its tokens."""
    bucket, first = token_buckets(data, offsets)
    n = np.diff(first)
    out = np.zeros((len(n), vectors.shape[1] + 1))
    full = np.flatnonzero(n)
    if len(full):
        out[full, :-1] = np.add.reduceat(vectors[bucket], first[full], axis=0) / n[full, None]
    out[:, -1] = np.log1p(n) / 10
    return out


class Network:
    """Two layers, standardised inputs, Adam on the whole sample; probabilities at a fitted temperature."""

    def __init__(self, x: np.ndarray, y: np.ndarray, hidden: int = 24, rounds: int = 600, seed: int = 7):
        self.prior = float(y.mean()) if len(y) else 0.5
        self.trained = len(y) >= 20 and 0 < y.sum() < len(y)
        if not self.trained:
            return
        rng = np.random.default_rng(seed)
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-6
        x = (x - self.mean) / self.scale
        aside = rng.random(len(y)) < 0.1
        if not 0 < y[aside].sum() < aside.sum():
            aside[:] = True
        fit = ~aside if (~aside).any() else aside
        p = {"w": rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], hidden)), "b": np.zeros(hidden), "v": rng.normal(0, 1 / np.sqrt(hidden), hidden), "c": np.array(np.log(self.prior / (1 - self.prior)))}
        m, s = {k: 0 * v for k, v in p.items()}, {k: 0 * v for k, v in p.items()}
        for t in range(1, rounds + 1):
            h = np.tanh(x[fit] @ p["w"] + p["b"])
            e = (1 / (1 + np.exp(-(h @ p["v"] + p["c"]))) - y[fit]) / fit.sum()
            back = np.outer(e, p["v"]) * (1 - h**2)
            g = {"w": x[fit].T @ back + 1e-3 * p["w"], "b": back.sum(0), "v": h.T @ e + 1e-3 * p["v"], "c": e.sum()}
            for k in p:
                m[k] = 0.9 * m[k] + 0.1 * g[k]
                s[k] = 0.999 * s[k] + 0.001 * g[k] ** 2
                p[k] = p[k] - 0.01 * (m[k] / (1 - 0.9**t)) / (np.sqrt(s[k] / (1 - 0.999**t)) + 1e-8)
        self.p, self.temperature = p, 1.0
        z = np.tanh(x[aside] @ p["w"] + p["b"]) @ p["v"] + p["c"]
        loss = lambda t: np.logaddexp(0, z / t).mean() - (y[aside] * z / t).mean()
        self.temperature = float(min(np.geomspace(0.25, 8, 61), key=loss))

    def __call__(self, x: np.ndarray) -> np.ndarray:
        if not self.trained:
            return np.full(len(x), self.prior)
        z = np.tanh((x - self.mean) / self.scale @ self.p["w"] + self.p["b"]) @ self.p["v"] + self.p["c"]
        return 1 / (1 + np.exp(-np.clip(z / self.temperature, -60, 60)))


def score_quality(docs: DataFrame, labels: DataFrame, folds: int = 4, held_out: int = 2, threshold: float = 0.7, rows: int = TRAIN_ROWS) -> DataFrame:
    """doc_id, held_out, score and predicted of every document. rows bounds the training sample."""
    small_batches(docs.sparkSession)
    vectors = word_vectors(context_sums(docs))
    learned = sample(docs, labels, "quality", folds, held_out, rows)
    texts = pa.RecordBatch.from_arrays([pa.array([t for _, t, _ in learned], pa.string())], ["text"])
    features = [pooled(*text_bytes(part.column(0)), vectors) for part in chunks(iter([texts]), "text", 1 << 19)]
    features = np.concatenate(features) if features else np.zeros((0, vectors.shape[1] + 1))
    model = docs.sparkSession.sparkContext.broadcast((vectors, Network(features, np.array([y for *_, y in learned], float))))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, network = model.value
        for part in chunks(batches, "text", 1 << 19):
            score = network(pooled(*text_bytes(part.column(2)), table))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(score), pa.array((score >= threshold).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    return docs.select(F.col("doc_id").cast("bigint"), (fold(F.col("doc_id"), folds) == held_out).alias("held_out"), "text").mapInArrow(work, RESULT_SCHEMA)


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text of documents, scored for quality."""
    return score_quality(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
