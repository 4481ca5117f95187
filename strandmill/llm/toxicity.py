"""Toxicity: a bidirectional gated recurrent network with attention pooling, over character and word inputs, in numpy.

A word's input is the embedding of its hash bucket beside the mean embedding of its byte trigrams. Windows of WINDOW
words overlap by WINDOW - STRIDE words and the last one ends with the text, so every word is in a full window; shorter
texts are one padded window. Two recurrent passes read a window, attention weighs their states, and a logistic output
scores it. A document's score is that of its highest window. In training, only the highest window of each document
gets a gradient (a label says that some passage is toxic, not which); word embeddings start from the log odds of
words in the training sample.

Nulls: a null text is an empty one; texts without words score the share of toxic rows in the sample. Null labels and
ids aren't learned from. Repeated rows and extra columns are ordinary. Without labels of both kinds every score is
that share (0.5 without any).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandmill.llm.labelled import fold, sample
from strandmill.llm.shared import release, small_batches
from strandmill.llm.words import FOLD, U, Words, bucketed, chunks, mix, split_words, text_bytes

WINDOW, STRIDE = 40, 30
WORD_BITS, CHAR_BITS = 14, 12
WORD_DIM, CHAR_DIM, HIDDEN, ATTEND = 6, 6, 8, 4
TRAIN_ROWS, EPOCHS, STEPS = 3000, 8, 200
RESULT_SCHEMA = "doc_id bigint, held_out boolean, score double, predicted int"
F32 = np.float32


def distinct_words(data: np.ndarray, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(number of each word, bucket of each distinct word, trigrams of distinct words, where each one's trigrams start)."""
    hashes, at, number = np.unique(words.hash, return_index=True, return_inverse=True)
    start, end = words.start[at], words.end[at]
    size = end - start
    first = np.concatenate([[0], np.cumsum(size)[:-1]]) if len(size) else np.zeros(0, np.int64)
    place = np.repeat(start - first, size) + np.arange(size.sum())
    own = FOLD[data[place]].astype(np.int64) if len(place) else place
    before, after = np.zeros_like(own), np.zeros_like(own)
    if len(own):
        before[1:], after[:-1] = own[:-1], own[1:]
        before[first], after[np.concatenate([first[1:] - 1, [len(own) - 1]])] = 1, 2
    return number, bucketed(hashes, WORD_BITS), bucketed(mix((before << 16 | own << 8 | after).astype(U) + U(1)), CHAR_BITS), first


def windows(first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, first word) of every window; documents without words have none."""
    n = np.diff(first)
    many = np.where(n > WINDOW, -(-(n - WINDOW) // STRIDE) + 1, (n > 0).astype(np.int64))
    doc = np.repeat(np.arange(len(n)), many)
    turn = np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many)
    return doc, first[doc] + np.minimum(turn * STRIDE, np.maximum(n[doc] - WINDOW, 0))


def new_parameters(rng: np.random.Generator) -> dict[str, np.ndarray]:
    d, h = WORD_DIM + CHAR_DIM, HIDDEN
    draw = lambda *shape: (rng.normal(0, 1 / np.sqrt(shape[-1]), shape)).astype(F32)
    return {
        "word": (0.1 * rng.normal(size=(1 << WORD_BITS, WORD_DIM))).astype(F32), "char": (0.1 * rng.normal(size=(1 << CHAR_BITS, CHAR_DIM))).astype(F32),
        "wx": draw(6 * h, d), "bx": np.zeros((6 * h, 1), F32), "uf": draw(3 * h, h), "ub": draw(3 * h, h),
        "wa": draw(ATTEND, 2 * h), "va": draw(ATTEND), "wo": draw(2 * h), "bo": np.zeros(1, F32),
    }


def inputs(p: dict, bucket: np.ndarray, trigram: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word inputs, their gate inputs as 6h x words)."""
    count = np.diff(np.append(start, len(trigram)))
    chars = np.add.reduceat(p["char"][trigram], start, axis=0) / count[:, None] if len(start) else np.zeros((0, CHAR_DIM), F32)
    x = np.hstack([p["word"][bucket], chars]).astype(F32)
    return x, p["wx"] @ x.T + p["bx"]


def _read(u: np.ndarray, gates: np.ndarray, ids: np.ndarray, live: np.ndarray | None, order: range, keep: bool) -> tuple[np.ndarray, list]:
    """States (time, h, windows) of one direction; keep also returns what the gradient needs."""
    h, n = HIDDEN, ids.shape[1]
    states = np.empty((len(order), h, n), F32)
    state, saved = np.zeros((h, n), F32), []
    for t in order:
        x, back = np.take(gates, ids[t], axis=1), u @ state
        zr = np.tanh(0.5 * (x[: 2 * h] + back[: 2 * h]))
        zr += 1
        zr *= 0.5
        z, r = zr[:h], zr[h:]
        new = np.tanh(x[2 * h :] + r * back[2 * h :])
        nxt = new + z * (state - new)
        if live is not None:
            nxt = np.where(live[t], nxt, state)
        if keep:
            saved.append((t, state, z, r, new, back[2 * h :]))
        state = states[t] = nxt
    return states, saved


def forward(p: dict, gates: np.ndarray, ids: np.ndarray, live: np.ndarray | None, keep: bool = False):
    """Logits of windows; ids is (time, windows) of word numbers, live marks real words where some are padding."""
    h, steps = HIDDEN, ids.shape[0]
    ahead, sf = _read(p["uf"], gates[: 3 * h], ids, live, range(steps), keep)
    back, sb = _read(p["ub"], gates[3 * h :], ids, live, range(steps - 1, -1, -1), keep)
    both = np.concatenate([ahead, back], axis=1)
    hid = np.tanh(p["wa"] @ both)
    score = np.einsum("a,tan->tn", p["va"], hid)
    if live is not None:
        score = np.where(live, score, -30)
    weight = np.exp(score - score.max(0))
    weight /= weight.sum(0)
    pool = np.einsum("tn,tdn->dn", weight, both)
    logit = p["wo"] @ pool + p["bo"][0]
    return (logit, (sf, sb, both, hid, weight, pool)) if keep else logit


def gradients(p: dict, gates: np.ndarray, ids: np.ndarray, live: np.ndarray, saved: tuple, error: np.ndarray) -> tuple[dict, np.ndarray]:
    """Of the parameters, and of the gate inputs, for an error per window logit."""
    sf, sb, both, hid, weight, pool = saved
    h = HIDDEN
    g = {"wo": pool @ error, "bo": np.array([error.sum()], F32)}
    dpool = np.outer(p["wo"], error)
    dboth = weight[:, None, :] * dpool
    dweight = np.einsum("tdn,dn->tn", both, dpool)
    dscore = weight * (dweight - (weight * dweight).sum(0)) * live
    g["va"] = np.einsum("tn,tan->a", dscore, hid)
    dhid = dscore[:, None, :] * p["va"][None, :, None] * (1 - hid**2)
    g["wa"] = np.einsum("tan,tdn->ad", dhid, both)
    dboth += np.einsum("ad,tan->tdn", p["wa"], dhid)
    dgates = np.zeros_like(gates)
    for name, at, states in (("uf", 0, sf), ("ub", 1, sb)):
        u, du, carry = p[name], np.zeros_like(p[name]), 0
        each = np.empty((3 * h, *ids.shape), gates.dtype)
        for t, state, z, r, new, back in reversed(states):
            d = dboth[t, at * h : (at + 1) * h] + carry
            on = live[t]
            dn = d * (1 - z) * (1 - new**2) * on
            dz = d * (state - new) * z * (1 - z) * on
            dr = dn * back * r * (1 - r)
            each[:, t] = np.concatenate([dz, dr, dn])
            dback = np.concatenate([dz, dr, dn * r])
            du += dback @ state.T
            carry = np.where(on, d * z, d) + u.T @ dback
        for row in range(3 * h):
            dgates[at * 3 * h + row] = np.bincount(ids.ravel(), each[row].ravel(), gates.shape[1])
        g[name] = du
    return g, dgates


class Reader:
    """Texts as words, distinct words and windows, ready for the network."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        words = split_words(data, offsets)
        self.number, self.bucket, self.trigram, self.start = distinct_words(data, words)
        self.first = words.first
        self.doc, self.at = windows(words.first)

    def ids(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray | None]:
        """(time, windows) of word numbers, and of which are real (None: all)."""
        place = self.at[which] + np.arange(WINDOW)[:, None]
        end = self.first[self.doc[which] + 1]
        live = place < end
        return self.number[np.minimum(place, len(self.number) - 1)], None if live.all() else live


def highest(p: dict, gates: np.ndarray, reader: Reader, which: np.ndarray, step: int = 2048) -> np.ndarray:
    """Logits of the windows; padded ones go together."""
    out = np.empty(len(which), F32)
    short = np.diff(reader.first)[reader.doc[which]] < WINDOW
    for group in (np.flatnonzero(~short), np.flatnonzero(short)):
        for i in range(0, len(group), step):
            own = group[i : i + step]
            out[own] = forward(p, gates, *reader.ids(which[own]))
    return out


def train(texts: list[str], labels: np.ndarray, epochs: int = EPOCHS, steps: int = STEPS, seed: int = 11) -> dict:
    """Parameters, with the share of label 1 as prior; untrained where the sample has one label only. A small sample takes more epochs, for as many steps."""
    prior = float(labels.mean()) if len(labels) else 0.5
    if len(labels) < 20 or not 0 < labels.sum() < len(labels):
        return {"prior": prior}
    rng = np.random.default_rng(seed)
    p = new_parameters(rng)
    reader = Reader(*text_bytes(pa.array(texts, pa.string())))
    n_docs = len(texts)
    word_doc = np.unique(np.repeat(np.arange(n_docs), np.diff(reader.first)) << 32 | reader.bucket[reader.number])
    hot = labels[word_doc >> 32] > 0
    with_, without = np.bincount(word_doc[hot] & 0xFFFFFFFF, minlength=1 << WORD_BITS), np.bincount(word_doc[~hot] & 0xFFFFFFFF, minlength=1 << WORD_BITS)
    odds = np.log((with_ + 0.5) / (labels.sum() + 1)) - np.log((without + 0.5) / (n_docs - labels.sum() + 1))
    p["word"][:, 0] = np.where(with_ + without >= 4, np.clip(odds, -3, 3), 0)
    p["bo"][0] = np.log(prior / (1 - prior))
    order = np.argsort(reader.doc, kind="stable")
    edge = np.searchsorted(reader.doc[order], np.arange(n_docs + 1))
    usable = np.flatnonzero(edge[1:] > edge[:-1])
    mean, square, t = {k: np.zeros_like(v) for k, v in p.items()}, {k: np.zeros_like(v) for k, v in p.items()}, 0
    epochs = max(epochs, -(-steps // max(1, len(usable) // 64)))
    for epoch in range(epochs):
        for batch in np.array_split(rng.permutation(usable), max(1, len(usable) // 64)):
            which = np.concatenate([order[edge[d] : edge[d + 1]] for d in batch])
            many = edge[batch + 1] - edge[batch]
            used = np.unique(np.concatenate([reader.number[reader.first[d] : reader.first[d + 1]] for d in batch]))
            size = np.diff(np.append(reader.start, len(reader.trigram)))[used]
            start = np.cumsum(size) - size
            tri = reader.trigram[np.repeat(reader.start[used] - start, size) + np.arange(size.sum())]
            x, gates = inputs(p, reader.bucket[used], tri, start)
            local = _Local(reader, used)
            logit = highest(p, gates, local, which)
            low = np.cumsum(many) - many
            top = np.array([a + int(logit[a : a + m].argmax()) for a, m in zip(low, many, strict=True)])
            ids, live = local.ids(which[top])
            live = np.ones(ids.shape, bool) if live is None else live
            best, saved = forward(p, gates, ids, live, True)
            error = ((1 / (1 + np.exp(-best)) - labels[batch]) / len(batch)).astype(F32)
            g, dgates = gradients(p, gates, ids, live, saved, error)
            g["wx"], g["bx"] = dgates @ x, dgates.sum(1, keepdims=True)
            dx = dgates.T @ p["wx"]
            g["word"], g["char"] = np.zeros_like(p["word"]), np.zeros_like(p["char"])
            np.add.at(g["word"], reader.bucket[used], dx[:, :WORD_DIM])
            np.add.at(g["char"], tri, np.repeat(dx[:, WORD_DIM:] / size[:, None], size, axis=0))
            t += 1
            for k in p:
                mean[k] = 0.9 * mean[k] + 0.1 * g[k]
                square[k] = 0.99 * square[k] + 0.01 * g[k] ** 2
                p[k] -= (0.01 * (1 - epoch / epochs) * (mean[k] / (1 - 0.9**t)) / (np.sqrt(square[k] / (1 - 0.99**t)) + 1e-7)).astype(F32)
    p["prior"] = prior
    return p


class _Local(Reader):
    """A reader whose word numbers count only the words of a batch."""

    def __init__(self, whole: Reader, used: np.ndarray):
        self.first, self.doc, self.at, self.number = whole.first, whole.doc, whole.at, whole.number
        self.used = used

    def ids(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray | None]:
        ids, live = super().ids(which)
        if live is not None:
            ids = np.where(live, ids, self.used[0])
        return np.searchsorted(self.used, ids), live


def scores(p: dict, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The highest window score of each text."""
    n = len(offsets) - 1
    out = np.full(n, p["prior"])
    if "wx" not in p:
        return out
    reader = Reader(data, offsets)
    if not len(reader.doc):
        return out
    _, gates = inputs(p, reader.bucket, reader.trigram, reader.start)
    gates = np.ascontiguousarray(gates)
    logit = highest(p, gates, reader, np.arange(len(reader.doc)))
    top = np.full(n, -np.inf)
    np.maximum.at(top, reader.doc, logit)
    full = np.isfinite(top)
    out[full] = 1 / (1 + np.exp(-np.clip(top[full], -60, 60)))
    return out


def learn(docs: DataFrame, labels: DataFrame, folds: int = 5, held_out: int = 0, rows: int = TRAIN_ROWS) -> dict:
    """A network trained on at most `rows` labelled documents."""
    learned = sample(docs, labels, "toxic", folds, held_out, rows)
    out = train([t for _, t, _ in learned], np.array([y for *_, y in learned], F32))
    del learned
    release(docs.sparkSession)
    return out


def score_toxicity(docs: DataFrame, parameters: dict, folds: int = 5, held_out: int = 0, threshold: float = 0.5) -> DataFrame:
    """doc_id, held_out, score and predicted of every document, from all its windows."""
    model = docs.sparkSession.sparkContext.broadcast(parameters)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, "text", 2 << 20):
            score = scores(model.value, *text_bytes(part.column(2)))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(score), pa.array((score >= threshold).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    return docs.select(F.col("doc_id").cast("bigint"), (fold(F.col("doc_id"), folds) == held_out).alias("held_out"), "text").mapInArrow(work, RESULT_SCHEMA)


def keep_clean(docs: DataFrame, parameters: dict, threshold: float = 0.5) -> DataFrame:
    """The rows of docs, whatever their columns, whose score is below the threshold."""
    small_batches(docs.sparkSession)
    model, at = docs.sparkSession.sparkContext.broadcast(parameters), docs.columns.index("text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                named = pa.RecordBatch.from_arrays([batch.column(at)], ["text"])
                parts = [scores(model.value, *text_bytes(part.column(0))) for part in chunks(iter([named]), "text", 2 << 20)]
                yield batch.filter(pa.array(np.concatenate(parts) < threshold))

    return docs.mapInArrow(work, docs.schema)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text of documents, scored for toxicity."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return score_toxicity(docs, learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
