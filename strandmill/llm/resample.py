"""Importance resampling towards a target distribution.

1. A feature is a run of 1 to `runs` words; its bucket is its crc32 modulo `buckets`. Bucket counts are summed per task
   and then over tasks, for the documents and for the target.
2. A bucket's gain is an integer in an array of `buckets` places, the only thing that goes to every task; a document's
   weight is the sum of the gains of its features. A score adds a Gumbel number made from doc_id.
3. The key (score descending, doc_id ascending) of the last document to draw is found exactly by radix selection: each
   round counts the next DIGIT_BITS bits of the keys that share the prefix found so far, in an aggregate of at most
   2**DIGIT_BITS rows. Nothing is sorted for it.
4. Only the rows up to that key are range-sorted and ranked.

Nulls: a null text has no words; a null doc_id draws its number from an empty id and comes after all others. Of equal
scores and ids the smaller number of features comes first, then a hash of the text; rows that repeat id and text are
drawn one by one. Empty texts have weight 0. Very long texts are handled whole, each in one task. An empty table, or one
with too few long documents, draws nothing; an empty target leaves gains that depend on the documents alone. Extra
columns are left out of the scores and kept by `draw`, whatever their names.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandmill.llm.bloom import only_possible
from strandmill.llm.shared import fresh, range_sorted, row_key, spread_join, write_table
from strandmill.llm.words import ALNUM, FOLD, Words, chunks, split_words, text_bytes

BUCKETS = 10_000
RUNS = 1
SEED = "2024"
MIN_WORDS = 20
PERCENT = 10
DIGIT_BITS = 12
SCORE_SCHEMA = "doc_id bigint, row bigint, n_words bigint, n_features bigint, weight bigint"
#: Longer words are hashed one by one.
_LONG = 64


def _crc_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> 1) ^ np.uint32(0xEDB88320), c >> 1).astype(np.uint32)
    return c


_TABLE = _crc_table()


def feed(state: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """crc32 states (before the last inversion) after the folded bytes start to end of data."""
    out, size = state.copy(), end - start
    order = np.argsort(-np.minimum(size, _LONG + 1), kind="stable")
    long = order[: int((size > _LONG).sum())]
    for i in long.tolist():
        out[i] = zlib.crc32(FOLD[data[start[i] : end[i]]].tobytes(), int(state[i]) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF
    order = order[len(long) :]
    now, at, left = out[order], start[order], size[order]
    for j in range(int(left[0]) if len(left) else 0):
        n = int(np.searchsorted(-left, -j, "left"))  # those of more than j bytes stand first
        now[:n] = _TABLE[(now[:n] ^ FOLD[data[at[:n] + j]]) & 0xFF] ^ (now[:n] >> 8)
    out[order] = now
    return out


def run_buckets(data: np.ndarray, words: Words, runs: int, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(document, bucket) of all runs of n words, for n from 1 to runs; words of a run are joined by one space."""
    doc, n = words.doc, len(words.start)
    state = np.full(n, 0xFFFFFFFF, np.uint32)
    for length in range(1, runs + 1):
        count = max(n - length + 1, 0)
        if length > 1:
            state = _TABLE[(state[:count] ^ 0x20) & 0xFF] ^ (state[:count] >> 8)
        state = feed(state[:count], data, words.start[length - 1 :][:count], words.end[length - 1 :][:count])
        whole = doc[:count] == doc[length - 1 :][:count]
        yield doc[:count][whole], ((state ^ 0xFFFFFFFF)[whole] % buckets).astype(np.int64)


def bucket_counts(texts: DataFrame, runs: int = RUNS, buckets: int = BUCKETS) -> np.ndarray:
    """Features in each bucket, over all rows of texts (a column text). One row a task and bucket is shuffled."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for part in chunks(batches, "text"):
            data, offsets = text_bytes(part.column(0))
            for _, bucket in run_buckets(data, split_words(data, offsets, ALNUM), runs, buckets):
                total += np.bincount(bucket, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    rows = texts.select("text").mapInArrow(work, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    for bucket, n in rows.collect():  # `buckets` rows at most
        out[bucket] = n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket floor(1000 * ln of the smoothed target share over the smoothed source share), in doubles."""
    b, s_all, t_all = float(len(source)), float(source.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1.0) * (s_all + b) / ((s + 1.0) * (t_all + b)))) for s, t in zip(source.tolist(), target.tolist(), strict=True)], np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, runs: int = RUNS) -> DataFrame:
    """doc_id, row, n_words, n_features and weight of every row of docs."""
    buckets = len(gain)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, "text"):
            data, offsets = text_bytes(part.column(2))
            words = split_words(data, offsets, ALNUM)
            count, weight = np.zeros(part.num_rows, np.int64), np.zeros(part.num_rows, np.int64)
            for doc, bucket in run_buckets(data, words, runs, buckets):
                ends = np.searchsorted(doc, np.arange(part.num_rows + 1))
                total = np.concatenate([[0], np.cumsum(gain[bucket])])
                count += np.diff(ends)
                weight += np.diff(total[ends])
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(np.diff(words.first)), pa.array(count), pa.array(weight)], SCORE_COLUMNS)

    return docs.select(F.col("doc_id").cast("bigint"), row_key().alias("row"), "text").mapInArrow(work, SCORE_SCHEMA)


SCORE_COLUMNS = [c.split()[0] for c in SCORE_SCHEMA.split(", ")]


def with_score(weighed: DataFrame, seed: str = SEED) -> DataFrame:
    """weighed with score: weight plus a Gumbel number, in thousandths, that doc_id and the seed decide."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    return weighed.withColumn("score", F.col("weight") + F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0))))


def scores(docs: DataFrame, target: DataFrame, runs: int = RUNS, buckets: int = BUCKETS, seed: str = SEED) -> DataFrame:
    """A stored table of every document's doc_id, row, n_words, n_features, weight and score. target has a column text."""
    gain = gains(bucket_counts(docs, runs, buckets), bucket_counts(target, runs, buckets))
    return write_table(with_score(weigh(docs, gain, runs), seed), "scores")[0]


# A key's columns, most significant first, each with its direction; none holds nulls.
KEY = [("score", True), ("no_id", False), ("id", False), ("n_features", False), ("row", False)]


def with_key(scored: DataFrame) -> DataFrame:
    return scored.withColumns({"no_id": F.col("doc_id").isNull().cast("bigint"), "id": F.coalesce("doc_id", F.lit(0).cast("bigint"))})


def _ordered(name: str, descending: bool) -> Column:
    """The column's bits such that their unsigned order is the wanted one."""
    x = F.bitwise_not(F.col(name)) if descending else F.col(name)
    return x.bitwiseXOR(F.lit(-(1 << 63)))


def _unsigned(v: int, descending: bool) -> int:
    return ((~v if descending else v) ^ -(1 << 63)) & ((1 << 64) - 1)


def _signed(u: int, descending: bool) -> int:
    v = u - (1 << 63)
    return ~v if descending else v


def kth_key(rows: DataFrame, k: int, key: list[tuple[str, bool]] = KEY) -> tuple[list[int], int]:
    """(values of the leading key columns, n): the first k rows in key order are those before these values and n of those
    that hold them. Columns that nothing depends on any more are left off. rows is a stored table of at least k rows, k > 0."""
    found: list[int] = []
    for name, descending in key:
        low, high, n = rows.agg(F.min(name), F.max(name), F.count("*")).first()
        if n == k and found:
            break
        ends = sorted(_unsigned(v, descending) for v in (low, high))
        bits = (ends[0] ^ ends[1]).bit_length()
        prefix, u = ends[0] >> bits, _ordered(name, descending)
        while bits:
            width = min(bits, DIGIT_BITS)
            bits -= width
            part = F.shiftrightunsigned(u, bits).alias("digit")
            near = rows if prefix == ends[0] >> (bits + width) == ends[1] >> (bits + width) else rows.where(F.shiftrightunsigned(u, bits + width) == prefix)
            for digit, n in sorted((d & ((1 << 64) - 1), n) for d, n in near.groupBy(part).count().collect()):  # 2**DIGIT_BITS rows at most
                if k <= n:
                    break
                k -= n
            prefix = digit
        value = _signed(prefix, descending)
        found.append(value)
        rows = rows.where(F.col(name) == value)
    return found, k


def before(values: list[int], key: list[tuple[str, bool]] = KEY) -> tuple[Column, Column]:
    """(whether a row stands before these values of the leading key columns, whether it holds them)."""
    less, same = F.lit(False), F.lit(True)
    for (name, descending), v in zip(key, values, strict=False):
        less = less | (same & (F.col(name) > v if descending else F.col(name) < v))
        same = same & (F.col(name) == v)
    return less, same


def ranked(scored: DataFrame, min_words: int = MIN_WORDS, percent: int = PERCENT) -> DataFrame:
    """scored (a stored table) with rank: 1, 2, 3 ... of the drawn rows by score, ties to the smaller doc_id; null for the others."""
    names = [*scored.columns, "rank"]
    keyed = with_key(scored)
    long = keyed.where(F.col("n_words") >= min_words)
    k = percent * long.count() // 100
    none = F.lit(None).cast("bigint").alias("rank")
    if not k:
        return scored.select("*", none)
    values, n = kth_key(long, k)
    less, same = before(values)
    fits = F.col("n_words") >= min_words
    tied, out = long.where(same), [keyed.where(~(fits & (less | same)))]
    chosen = long.where(less | same)
    if n < (m := tied.count()):  # rows that repeat id and text: which of them are drawn makes no difference
        one = tied.limit(1)
        of = lambda n: scored.sparkSession.range(n).select().join(F.broadcast(one))  # noqa: E731  n copies of one row
        chosen = long.where(less).unionByName(of(n))
        out.append(of(m - n))
    order = [F.col(c).desc() if d else F.col(c).asc() for c, d in KEY]
    table = range_sorted(chosen, order, "drawn", "part", "place")
    # One row a partition of the sort.
    starts = table.groupBy("part").agg(F.count("*").alias("n")).select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("start"))
    placed = table.join(F.broadcast(starts), "part").withColumn("rank", F.col("start") + F.col("place") + 1)
    return reduce(DataFrame.unionByName, [df.select(*scored.columns, none) for df in out], placed.select(*names))


def draw(docs: DataFrame, target: DataFrame, min_words: int = MIN_WORDS, percent: int = PERCENT, runs: int = RUNS, buckets: int = BUCKETS, seed: str = SEED) -> DataFrame:
    """The drawn documents with all their columns and a new column rank. Only rows that a Bloom filter lets through are joined."""
    found = ranked(scores(docs, target, runs, buckets, seed), min_words, percent).where("rank is not null")
    drawn, _ = write_table(found.select(F.col("row").alias("entry"), "rank"), "ranks")
    key = fresh(docs.columns, "row")
    held = only_possible(docs.withColumn(key, row_key()), key, drawn).dropDuplicates([key])
    whole = held.select(F.col(key).alias("entry"), F.struct(*(F.col(c) for c in docs.columns)).alias("doc"))
    return spread_join(drawn, whole, "entry", "rank", drawn).select("doc.*", F.col("rank").alias(fresh(docs.columns, "rank")))


def op11_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's features, weight, score and rank among the tenth of all long documents drawn towards benchmark."""
    docs, target = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return ranked(scores(docs, target)).select("doc_id", "n_features", "weight", "score", "rank")


OP11_SQL = r"""
WITH RECURSIVE steps(i, k, c) AS (
  SELECT i, 0, i FROM range(256) t(i)
  UNION ALL SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM steps WHERE k < 8),
crc(t) AS (SELECT list(c ORDER BY i) FROM steps WHERE k = 8),
texts AS (SELECT 's' AS kind, doc_id, text FROM documents UNION ALL SELECT 't', NULL, text FROM benchmark),
words AS (
  SELECT kind, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word
  FROM texts),
hexed AS (SELECT word, hex(encode(word)) AS h FROM (SELECT DISTINCT word FROM words)),
hashed AS (
  SELECT word, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(length(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT)),
                               lambda a, b: xor(crc.t[(xor(a, b) & 255) + 1], a >> 8)), 4294967295) % 10000 AS bucket
  FROM hexed, crc),
features AS (SELECT kind, doc_id, bucket FROM words JOIN hashed USING (word)),
counts AS (
  SELECT b AS bucket, count(*) FILTER (kind = 's') AS s, count(*) FILTER (kind = 't') AS t
  FROM range(10000) r(b) LEFT JOIN features ON bucket = b GROUP BY b),
gains AS (
  SELECT bucket, floor(1000 * ln((t + 1.0::DOUBLE) * ((SELECT sum(s) FROM counts)::DOUBLE + 10000) / ((s + 1.0::DOUBLE) * ((SELECT sum(t) FROM counts)::DOUBLE + 10000))))::BIGINT AS gain
  FROM counts),
weights AS (SELECT doc_id, count(*) AS n, sum(gain)::BIGINT AS weight FROM features JOIN gains USING (bucket) WHERE kind = 's' GROUP BY doc_id),
scored AS (
  SELECT d.doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || d.doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM documents d LEFT JOIN weights w USING (doc_id)),
placed AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, 10 * count(*) OVER () // 100 AS k FROM scored WHERE n_features >= 20)
SELECT s.doc_id, s.n_features::BIGINT AS n_features, s.weight, s.score, CASE WHEN r <= k THEN r END::BIGINT AS rank
FROM scored s LEFT JOIN placed USING (doc_id)
"""
