"""Product codes of vectors, by Lloyd rounds that Elkan's bounds prune.

Components become integers, floor(1024 * x); a vector is cut into equal parts, and each part position has a codebook.
Every round is one pass over a stored table that holds, for each vector and part, its entry, an upper bound of the
distance to it and one lower bound for every entry. Between rounds the bounds are shifted by how far entries have moved.
An entry j can only be nearer than the present one a, or as near, if neither its lower bound nor half the distance from a
to j is above the upper bound (strictly: equality may be a tie); only such pairs are compared, in integers, and ties go
to the lower index. Upper bounds are rounded up and lower ones down: to one byte, in steps of a 255th of a part's largest.
So the codes are exactly those of plain Lloyd. Only codebooks (entries x dimension numbers) and sums of that size pass
the driver; each round's table replaces the one before, so a lost executor costs no earlier round.

Rows whose vector is null or empty, or has null or non-finite components, are dropped, and so are those of another length than
the vector of the smallest vec_id. Where the parts don't divide the length, zeros are added at the end. Integers are held
within LIMIT of zero (an |x| of 16,384). A null vec_id is coded but starts no entry; of a repeated vec_id the
smallest vector starts one, and all its rows are coded. With fewer ids than entries the codebooks are as much smaller; an
empty table gives an empty result. Extra columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandmill.llm.shared import attach, drop_table, text_key, write_table

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
LIMIT = 1 << 24
#: Vectors handled at once.
BLOCK = 2048
STATE = "`vector` binary, `codes` binary, `upper` binary, `step` binary, `lower` binary"
UP, DOWN = 1 + 1e-6, 1 - 1e-6


@dataclass
class Codebooks:
    """entries[p] is an integer array (entries, part dimension)."""

    entries: np.ndarray

    @property
    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()

    def half_gaps(self) -> np.ndarray:
        """[p, i, j]: at most half the distance between entries i and j of part p."""
        return np.stack([np.sqrt(squared(e, e).astype(float)) * (DOWN / 2) for e in self.entries])


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of x from all rows of y. Products go through floating point only where they are exact."""
    most = max(int(np.abs(x).max(initial=0)), int(np.abs(y).max(initial=0)))
    if 4 * most * most * max(x.shape[1], 1) < 1 << 53:
        a, b = x.astype(float), y.astype(float)
        return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)).astype(np.int64)
    return (x * x).sum(1)[:, None] - 2 * (x @ y.T) + (y * y).sum(1)


def usable(vectors: DataFrame, column: str) -> DataFrame:
    """Rows whose vector has components, finite ones only."""
    v = F.col(column)
    return vectors.where((F.size(v) > 0) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))


def integers(values: np.ndarray, dimension: int, padded: int) -> np.ndarray:
    """(rows, padded) integers of a flat array of components."""
    out = np.zeros((len(values) // dimension, padded), np.int32)
    out[:, :dimension] = np.clip(np.floor(values.astype(float).reshape(-1, dimension) * SCALE), -LIMIT, LIMIT)
    return out


def kept_vectors(vectors: DataFrame, column: str = "embedding", parts: int = PARTS, entries: int = ENTRIES) -> tuple[DataFrame, Codebooks] | None:
    """(the rows that are coded, the codebooks they start with); None if no row has a vec_id."""
    rows = usable(vectors.select("vec_id", "label", F.col(column).alias("vector")), "vector")
    known = rows.where("vec_id is not null")
    first = known.orderBy("vec_id", "vector").limit(1).collect()
    if not first:
        return None
    n = len(first[0]["vector"])
    rows, known = rows.where(F.size("vector") == n), known.where(F.size("vector") == n)
    seeds = known.orderBy("vec_id", "vector").limit(entries).select("vec_id", "vector").collect()  # a fixed number
    if len({r[0] for r in seeds}) < len(seeds):
        ids = known.select("vec_id").distinct().orderBy("vec_id").limit(entries)
        seeds = known.join(F.broadcast(ids), "vec_id").groupBy("vec_id").agg(F.min("vector").alias("vector")).orderBy("vec_id").collect()
    padded = -(-n // parts) * parts
    start = integers(np.array([x for r in seeds for x in r[1]], float), n, padded)
    return rows, Codebooks(start.reshape(len(seeds), parts, -1).transpose(1, 0, 2).astype(np.int64))


def lowered(distance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(step, bytes) of lower bounds (rows, entries): bytes times step is at most the bound."""
    step = (distance.max(1, initial=0) / 255 * UP).astype(np.float32)
    safe = np.where(step > 0, step, 1)
    return step, np.minimum(distance / safe[:, None] * DOWN, 255).astype(np.uint8)


def assign_first(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code, squared distance to it, lower bounds) of the rows of x."""
    d = squared(x, entries)
    code = d.argmin(1)
    return code, d[np.arange(len(x)), code], np.sqrt(d.astype(float)) * DOWN


def assign_again(x: np.ndarray, entries: np.ndarray, gaps: np.ndarray, code: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(code, upper bound, lower bounds, pairs compared) of the rows of x, from bounds that hold for these entries."""
    code, upper, lower = code.copy(), upper.copy(), lower.copy()
    open_ = (lower <= upper[:, None]) & (gaps[code] <= upper[:, None])
    open_[np.arange(len(x)), code] = False
    rows = np.flatnonzero(open_.any(1))
    if not len(rows):
        return code, upper, lower, 0
    own = ((x[rows] - entries[code[rows]]) ** 2).sum(1)
    upper[rows] = np.sqrt(own.astype(float)) * UP
    lower[rows, code[rows]] = np.sqrt(own.astype(float)) * DOWN
    still = open_[rows] & (lower[rows] <= upper[rows, None]) & (gaps[code[rows]] <= upper[rows, None])
    best = np.full(still.shape, np.iinfo(np.int64).max)
    at, to = np.nonzero(still)
    for k in range(0, len(at), 1 << 16):
        i, j = at[k : k + (1 << 16)], to[k : k + (1 << 16)]
        best[i, j] = ((x[rows[i]] - entries[j]) ** 2).sum(1)
    lower[rows[at], to] = np.sqrt(best[at, to].astype(float)) * DOWN
    best[np.arange(len(rows)), code[rows]] = own
    code[rows] = best.argmin(1)
    upper[rows] = np.sqrt(best.min(1).astype(float)) * UP
    return code, upper, lower, len(at) + len(rows)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            yield batch.slice(at, BLOCK)


def _fixed(values: np.ndarray) -> pa.Array:
    """One binary value per row."""
    values = np.ascontiguousarray(values)
    n, width = len(values), values.itemsize * int(np.prod(values.shape[1:]))
    offsets = pa.array(np.arange(n + 1, dtype=np.int32) * width)
    return pa.Array.from_buffers(pa.binary(), n, [None, offsets.buffers()[1], pa.py_buffer(values.tobytes())])


def _array(column: pa.Array, kind: type, *shape: int) -> np.ndarray:
    """The inverse of _fixed."""
    _, where, data = column.buffers()
    o = np.frombuffer(where, np.int32)[column.offset : column.offset + len(column) + 1]
    if o[-1] == o[0]:
        return np.zeros((len(column), *shape), kind)
    return np.frombuffer(data, np.uint8)[o[0] : o[-1]].view(kind).reshape(len(column), *shape)


def first_state(rows: DataFrame, books: Codebooks) -> DataFrame:
    """vec_id, label and the state of every row after its first assignment."""
    e = books.entries
    parts, _, width = e.shape

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _blocks(batches):
            flat = b.column(2).flatten().to_numpy(zero_copy_only=False)
            x = integers(flat, len(flat) // b.num_rows, parts * width)
            out = [assign_first(x.reshape(-1, parts, width)[:, p].astype(np.int64), e[p]) for p in range(parts)]
            yield _state(b, x, out)

    return rows.select("vec_id", "label", "vector").mapInArrow(work, _schema(rows))


def _schema(rows: DataFrame) -> str:
    return f"vec_id {rows.schema['vec_id'].dataType.simpleString()}, label {rows.schema['label'].dataType.simpleString()}, {STATE}"


def _state(b: pa.RecordBatch, x: np.ndarray, found: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    codes = np.stack([f[0] for f in found], 1).astype(np.uint8)
    upper = (np.sqrt(np.stack([f[1] for f in found], 1).astype(float)) * UP).astype(np.float32) * np.float32(UP)
    step, low = zip(*(lowered(f[2]) for f in found), strict=True)
    columns = [*b.columns[:2], _fixed(x), _fixed(codes), _fixed(upper), _fixed(np.stack(step, 1)), _fixed(np.stack(low, 1))]
    return pa.RecordBatch.from_arrays(columns, ["vec_id", "label", "vector", "codes", "upper", "step", "lower"])


def next_state(state: DataFrame, books: Codebooks, before: Codebooks) -> DataFrame:
    """The state after an assignment to books, from the one that held for the codebooks before."""
    e, gaps = books.entries, books.half_gaps()
    parts, k, width = e.shape
    moved = np.sqrt(((e - before.entries) ** 2).sum(2).astype(float)) * UP

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _blocks(batches):
            x, codes = _array(b.column(2), np.int32, parts, width), _array(b.column(3), np.uint8, parts).astype(np.int64)
            upper, step, low = _array(b.column(4), np.float32, parts), _array(b.column(5), np.float32, parts), _array(b.column(6), np.uint8, parts, k)
            out = []
            for p in range(parts):
                own = x[:, p].astype(np.int64)
                up = upper[:, p].astype(float) * UP + moved[p][codes[:, p]]
                down = np.maximum(low[:, p] * (step[:, p].astype(float) * DOWN)[:, None] - moved[p], 0)
                code, up, down, _ = assign_again(own, e[p], gaps[p], codes[:, p], up, down)
                out.append((code, up * up, down))
            yield _state(b, x, out)

    return state.select("vec_id", "label", "vector", "codes", "upper", "step", "lower").mapInArrow(work, _schema(state))


def moved_books(state: DataFrame, books: Codebooks) -> Codebooks:
    """Each entry replaced by the floor of the mean of its parts; unused entries stay. Sums are made per task, then over tasks."""
    e = books.entries
    parts, k, width = e.shape

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((parts, k, width), np.int64), np.zeros((parts, k), np.int64)
        for b in _blocks(batches):
            x, codes = _array(b.column(0), np.int32, parts, width), _array(b.column(1), np.uint8, parts)
            for p in range(parts):
                order = np.argsort(codes[:, p], kind="stable")
                own, first = np.unique(codes[order, p], return_index=True)
                total[p, own] += np.add.reduceat(x[order, p].astype(np.int64), first)
                count[p] += np.bincount(codes[:, p], minlength=k)
        p, j = np.nonzero(count)
        # A count stands at place -1 before an entry's sums.
        entry, place = np.repeat(p * k + j, width + 1), np.tile(np.arange(-1, width), len(p))
        yield pa.RecordBatch.from_arrays([pa.array(entry), pa.array(place), pa.array(np.concatenate([count[p, j][:, None], total[p, j]], 1).ravel())], ["entry", "place", "total"])

    sums = state.select("vector", "codes").mapInArrow(work, "entry bigint, place bigint, total bigint").groupBy("entry", "place").agg(F.sum("total").alias("total"))
    rows = sums.collect()  # entries x (dimension + 1) rows at most
    n = {entry: total for entry, at, total in rows if at < 0}
    new = e.copy()
    for entry, at, total in rows:
        if at >= 0:
            new[entry // k, entry % k, at] = total // n[entry]
    return Codebooks(new)


def errors(state: DataFrame, books: Codebooks) -> DataFrame:
    """vec_id, label, code (two hex digits a part) and error (exact squared distance to the entries) of every row."""
    e = books.entries
    parts, _, width = e.shape

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _blocks(batches):
            x, codes = _array(b.column(2), np.int32, parts, width).astype(np.int64), _array(b.column(3), np.uint8, parts)
            total = sum(((x[:, p] - e[p][codes[:, p]]) ** 2).sum(1) for p in range(parts))
            yield pa.RecordBatch.from_arrays([*b.columns[:2], b.column(3), pa.array(total)], ["vec_id", "label", "codes", "error"])

    kinds = _schema(state).split(", `")[0].rsplit(", `vector`")[0]
    out = state.select("vec_id", "label", "vector", "codes").mapInArrow(work, f"{kinds}, codes binary, error bigint")
    return out.select("vec_id", "label", F.lower(F.hex("codes")).alias("code"), "error")


def encode(vectors: DataFrame, column: str = "embedding", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, Codebooks]:
    """(a stored table of vec_id, label, code and error, the final codebooks). vectors has vec_id, label and the vector's column."""
    if not 0 < entries <= 256 or parts < 1 or rounds < 0:
        raise ValueError("codes hold one to 256 entries a part")
    spark, kinds = vectors.sparkSession, {f.name: f.dataType.simpleString() for f in vectors.schema}
    found = kept_vectors(vectors, column, parts, entries)
    if not found:
        return spark.createDataFrame([], f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error bigint"), Codebooks(np.zeros((parts, 0, 0), np.int64))
    rows, books = found
    state, path = write_table(first_state(rows, books), "codes")
    for _ in range(rounds):
        new = moved_books(state, books)
        after, then = write_table(next_state(state, new, books), "codes")
        drop_table(spark, path)
        state, path, books = after, then, new
    coded, _ = write_table(errors(state, books), "coded")
    drop_table(spark, path)
    return coded, books


def decode(coded: DataFrame, books: Codebooks) -> DataFrame:
    """coded with vector: the middle of each integer's range, of the entries that the code names (padding included)."""
    parts = books.entries.shape[0]
    tables = [F.array(*(F.array(*(F.lit(float((v + 0.5) / SCALE)) for v in row)) for row in part)) for part in books.entries.tolist()]
    at = lambda p: F.conv(F.substring("code", 2 * p + 1, 2), 16, 10).cast("int")
    return coded.withColumn("vector", F.concat(*(tables[p][at(p)] for p in range(parts))))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes and errors of all vectors, errors by label, and a digest of the codebooks."""
    coded, books = encode(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label"))
    keyed = coded.withColumn("same", text_key(F.col("label")))
    sums, _ = write_table(keyed.groupBy("same").agg(F.sum("error").alias("label_error")), "label-errors")
    out = attach(keyed, sums, "same", "vec_id")
    return out.select("vec_id", "code", "error", "label_error", F.lit(books.digest).alias("codebooks_sha256"))
