"""Best-fit packing of token sequences by linear grouping.

Documents are tokenised once into pieces. Piece lengths are whole numbers up to the capacity, so the packing is
solved on their histogram, at most `capacity` numbers on the driver whatever the input:

1. lengths above capacity / 4 are sorted and cut into groups of equal cardinality, and rounded up to their group's
   largest length;
2. the configuration programme over these few sizes is solved by column generation (knapsack pricing) and rounded
   down;
3. actual lengths take the slots: each the longest length up to its size, and the last slot of a bin the longest that
   fits beside the others, which makes good what rounding lost. A configuration is left once its bins would have more
   than `spare` tokens more free than configured, so that few sequences are lost to rounding;
4. the large lengths left over, then the small lengths, are put by best fit, longest first, into the space that remains.

The plan is a list of runs (length, first rank, bins, first sequence, offset). Executors number the pieces of each
length - in salted buckets, so that no length lands in one task - and look their place up.

Nulls: a null text is an empty one (one end token); null doc_ids are kept. Repeated rows are packed one by one. Very
long texts are cut. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandmill.llm.shared import write_table

CAPACITY = 1024
END_ID = 2
PIECE_SCHEMA = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
PLACED_SCHEMA = PIECE_SCHEMA + ", sequence_id bigint, offset bigint"
#: Texts of these characters alone are split alike by both libraries; others go to the slower one.
_PLAIN = re.compile("[\t\n\r\x20-\x7e¡-¬®-ɏ]*")


class Encoder:
    """Token ids of byte_bpe_50k.json. Texts of plain characters take the library that is five times as fast on the same vocabulary."""

    def __init__(self, vocabulary: str, ranks: str, pattern: str):
        import tiktoken

        self.vocabulary, self.whole = vocabulary, None
        with open(ranks, "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines)}
        self.plain = tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=table, special_tokens={})

    def __call__(self, text: str) -> np.ndarray:
        if "<|" in text or not _PLAIN.fullmatch(text):
            if self.whole is None:
                from tokenizers import Tokenizer

                self.whole = Tokenizer.from_file(self.vocabulary)
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, np.uint32)
        return np.frombuffer(self.plain.encode_to_numpy(text).astype(np.uint32), np.uint32)


def default_encoder() -> Encoder:
    import public_tokenizers as tokenizers_of

    return Encoder(tokenizers_of.path("byte_bpe_50k.json"), tokenizers_of.path("byte_bpe_50k.tiktoken"), tokenizers_of.PATTERN)


_encoders: dict = {}


def _encoder(make):
    """One encoder a worker process. Workers find this function by its name; a dict used in a task's own function would be copied into each task."""
    if make not in _encoders:
        _encoders[make] = make()
    return _encoders[make]


def tokenize_pieces(docs: DataFrame, make_encoder=default_encoder, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pieces of at most capacity ids; of a longer document only the first may be shorter."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, tail = _encoder(make_encoder), np.array([end_id], np.uint32)
        for batch in batches:
            cols = [[], [], [], [], []]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.concatenate([encode(text.as_py() or ""), tail]).astype("<u4")
                cuts = [0, *range(len(ids) % capacity or capacity, len(ids) + 1, capacity)] if len(ids) > capacity else [0, len(ids)]
                for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    for c, v in zip(cols, (doc_id, k, a, b - a, zlib.crc32(ids[a:b].tobytes())), strict=True):
                        c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(work, PIECE_SCHEMA)


class _Prices:
    """Knapsack pricing for sizes above a quarter of the capacity: a bin holds three of them at most."""

    def __init__(self, sizes: np.ndarray, capacity: int):
        i, j = np.triu_indices(len(sizes))
        total = sizes[i] + sizes[j]
        fits = total <= capacity
        order = np.argsort(total[fits], kind="stable")
        self.i, self.j, total = i[fits][order], j[fits][order], total[fits][order]
        # Of the pairs in order of their sum, so many leave room for each size as the third.
        self.room = np.searchsorted(total, capacity - sizes, "right")

    def best(self, price: np.ndarray) -> tuple[float, list[int]]:
        """The dearest bin: its price and the numbers of its sizes."""
        k = int(price.argmax())
        value, items = float(price[k]), [k]
        if not len(self.i):
            return value, items
        pairs = price[self.i] + price[self.j]
        x = int(pairs.argmax())
        if pairs[x] > value:
            value, items = float(pairs[x]), [int(self.i[x]), int(self.j[x])]
        third = np.flatnonzero(self.room)
        if len(third):
            threes = np.maximum.accumulate(pairs)[self.room[third] - 1] + price[third]
            k = int(threes.argmax())
            if threes[k] > value:
                x = int(pairs[: self.room[third[k]]].argmax())
                value, items = float(threes[k]), [int(self.i[x]), int(self.j[x]), int(third[k])]
        return value, items


def _inverted(matrix: np.ndarray) -> np.ndarray:
    """The inverse by Gauss and Jordan, in plain array arithmetic: the driver's threads must not wait for a linear algebra library's."""
    n = len(matrix)
    both = np.hstack([matrix, np.eye(n)])
    for c in range(n):
        r = c + int(np.abs(both[c:, c]).argmax())
        both[[c, r]] = both[[r, c]]
        both[c] /= both[c, c]
        way = both[:, c].copy()
        way[c] = 0
        both -= way[:, None] * both[c]
    return both[:, n:]


def configurations(sizes: np.ndarray, demand: np.ndarray, capacity: int, rounds: int = 4000) -> tuple[np.ndarray, np.ndarray]:
    """(patterns, how often): the basic optimum of the configuration programme for falling sizes above capacity / 4.

    rounds bounds the pivots, after which the basis is still feasible.
    """
    prices = _Prices(sizes, capacity)
    basis = np.diag(capacity // sizes).astype(float)
    inverse = np.diag(1 / (capacity // sizes))
    amount = (inverse * demand).sum(1)
    for turn in range(1, rounds + 1):
        value, items = prices.best(np.maximum(inverse.sum(0), 0))
        if value <= 1 + 1e-6:
            break
        way = inverse[:, items].sum(1)
        ratio = np.where(way > 1e-9, np.maximum(amount, 0) / np.where(way > 1e-9, way, 1), np.inf)
        out = int(ratio.argmin())
        step = ratio[out]
        amount -= step * way
        amount[out] = step
        basis[:, out] = np.bincount(items, minlength=len(sizes))
        row = inverse[out] / way[out]
        inverse -= way[:, None] * row
        inverse[out] = row
        if not turn % 500:
            inverse = _inverted(basis)
            amount = (inverse * demand).sum(1)
    return basis.T.astype(int), np.maximum(amount, 0)


def _equal_groups(left: np.ndarray, small: int, groups: int) -> tuple[np.ndarray, np.ndarray]:
    """(sizes, pieces): lengths above small in groups of equal cardinality, rounded up to their group's largest length; longest first."""
    lengths = np.arange(len(left) - 1, small, -1)
    ends = np.cumsum(left[lengths])
    total = int(ends[-1])
    groups = max(1, min(groups, total // 8))
    edges = np.unique(np.linspace(0, total, groups + 1).astype(np.int64))
    sizes = lengths[np.searchsorted(ends, edges[:-1], "right")]
    size, first = np.unique(-sizes, return_index=True)
    return -size, np.diff(np.append(edges[:-1][first], total))


def _longest(left: np.ndarray, small: int, space: int, taken: list[int]) -> int:
    """The longest length above small and up to space that is left beside those taken; 0 if none."""
    for length in range(space, small, -1):
        if left[length] > taken.count(length):
            return length
    return 0


def _substituted(slots: list[int], bins: int, left: np.ndarray, small: int, spare: int) -> Iterator[tuple[int, list[int]]]:
    """(bins, actual lengths) of a configuration used `bins` times, as runs of bins that hold the same lengths.

    A slot takes the longest length up to its size, and the last one the longest up to the space that is there, so
    what rounding lost in the others is made good. It stops when bins would have over `spare` tokens more free than
    configured.
    """
    capacity = len(left) - 1
    while bins > 0:
        taken: list[int] = []
        for k, size in enumerate(slots):
            length = _longest(left, small, size if k < len(slots) - 1 else capacity - sum(taken), taken)
            if not length:
                return
            taken.append(length)
        if sum(taken) < sum(slots) - spare:
            return
        step = min(bins, *(int(left[n]) // taken.count(n) for n in taken))
        for n in taken:
            left[n] -= step
        yield step, taken
        bins -= step


def _best_fit(left: np.ndarray, runs: list[list], capacity: int) -> None:
    """Put the remaining pieces, longest first, into the runs with least space that fits, and into new ones."""
    by_space: list[list[int]] = [[] for _ in range(capacity + 1)]
    for i, (_, space, _) in enumerate(runs):
        by_space[space].append(i)
    for length in range(capacity, 0, -1):
        need, space = int(left[length]), length
        while need:
            while space <= capacity and not by_space[space]:
                space += 1
            if space > capacity:
                runs.append([-(-need // (capacity // length)), capacity, []])
                by_space[capacity].append(len(runs) - 1)
                space = length
                continue
            i = by_space[space].pop()
            bins, _, made = runs[i]
            take = min(bins, need)
            if take < bins:
                runs.append([bins - take, space, list(made)])
                by_space[space].append(len(runs) - 1)
            runs[i] = [take, space - length, [*made, (length, capacity - space)]]
            by_space[space - length].append(i)
            need -= take
            if space - length >= length:
                space = length


@dataclass
class Plan:
    """The runs of a packing and how they came about."""

    #: Rows (length, first rank, bins, first sequence, offset): pieces of the length with ranks from first rank on lie one in a bin.
    rows: np.ndarray
    sequences: int
    #: Pieces above a quarter of the capacity, and how many of them lie in bins that a configuration made.
    large: int
    configured: int


def plan_packing(counts: np.ndarray, capacity: int = CAPACITY, groups: int = 256, spare: int = 1) -> Plan:
    """The plan for counts[n] pieces of length n."""
    left, small = counts.astype(np.int64).copy(), capacity // 4
    runs: list[list] = []  # [bins, space left, [(length, offset), ...]]
    if left[capacity]:
        runs.append([int(left[capacity]), 0, [(capacity, 0)]])
        left[capacity] = 0
    large = int(left[small + 1 :].sum())
    if large:
        sizes, demand = _equal_groups(left, small, groups)
        patterns, amount = configurations(sizes, demand.astype(float), capacity)
        used = [(int(n), sorted((int(s) for s, c in zip(sizes, pattern, strict=True) for _ in range(c)), reverse=True)) for pattern, n in zip(patterns, np.floor(amount + 1e-6).astype(np.int64), strict=True)]
        # Fullest configurations first: those with free space are content with what others leave.
        for bins, slots in sorted(used, key=lambda x: (-sum(x[1]), x[1])):
            for step, taken in _substituted(slots, bins, left, small, spare):
                ends = np.cumsum([0, *taken])
                runs.append([step, capacity - int(ends[-1]), [(n, int(at)) for n, at in zip(taken, ends, strict=False)]])
    configured = large - int(left[small + 1 :].sum())
    _best_fit(left, runs, capacity)
    ranks, sequence, rows = np.zeros(capacity + 1, np.int64), 0, []
    for bins, _, made in runs:
        for length, offset in made:
            rows.append((length, ranks[length], bins, sequence, offset))
            ranks[length] += bins
        sequence += bins * bool(made)
    assert (ranks == counts).all()
    return Plan(np.array(sorted(rows), np.int64).reshape(-1, 5), sequence, large, configured)


def pack(pieces: DataFrame, capacity: int = CAPACITY, bucket_rows: int = 1_000_000) -> DataFrame:
    """Pieces with sequence_id and offset. pieces is read several times: pass a stored table."""
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in pieces.groupBy("length").count().collect():  # at most `capacity` rows
        counts[length] = n
    plan = plan_packing(counts, capacity).rows
    buckets = max(64, int(counts.max()) // bucket_rows + 1)
    dealt = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(buckets)).cast("int"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    firsts = dealt.groupBy("length", "bucket").count().select("length", "bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first"))
    own = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    ranked = dealt.withColumn("own", F.row_number().over(own) - 1).join(firsts, ["length", "bucket"]).withColumn("rank", F.col("first") + F.col("own"))
    edges = plan[:, 0] << 44 | plan[:, 1]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length, rank = b.column(3).to_numpy(), b.column(5).to_numpy()
            row = plan[np.searchsorted(edges, length.astype(np.int64) << 44 | rank, "right") - 1]
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(row[:, 3] + rank - row[:, 1]), pa.array(row[:, 4])], ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", F.col("rank").cast("bigint")).mapInArrow(work, PLACED_SCHEMA)


def pack_documents(docs: DataFrame) -> DataFrame:
    pieces, _ = write_table(tokenize_pieces(docs), "op9-pieces")
    return pack(pieces)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 1024 tokens."""
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
