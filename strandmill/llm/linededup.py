"""Line dedup by pairwise alignment.

1. Each line that isn't blank gets a hash. Documents stand in the order of doc_id (those of one doc_id: of a hash of the
   text). A run is a sequence of lines (blank ones don't count) of at least min_words words that has no shorter one at its
   start, or at its end; its key comes from the hashes of its lines. Two documents with a common block of min_words words
   share the keys of the runs at its start and its end.
2. A key has some owners: the first document that has it, and the first in each of OWNERS random parts. Documents to align a
   later one with are found through its rarest keys first: the owner that has most keys not yet accounted for, until each
   key has a partner. So a hot passage costs a document one partner.
3. Each pair is aligned with patience diff on line hashes: equal ends, then the longest increasing chain of lines that are
   unique in both, then between those again. Lines that are consecutive in both documents form common blocks. What this
   leaves (passages in another order, or repeated in either document) is aligned again, wherever it stands in the partner:
   the runs of what is left are looked up among the partner's.
4. Common blocks of at least min_words words with one partner are deleted, with blank lines between deleted lines. Lines
   that the partner has in other places, or that only several partners have together, stay. So what goes is every common
   block of min_words words with any earlier document.

Lines equal byte for byte share a hash (64 bits); so do rows, by doc_id and text. Nulls: a null text has no lines and
stays null; a document with a null doc_id has no place in the order and stays as it is. Rows with the same doc_id and
text are one document: they don't delete each other's lines. Empty and very long texts are ordinary. Extra columns of
documents are kept, whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandmill.llm.bloom import split_possible
from strandmill.llm.shared import drop_table, fresh, row_key, small_batches, spread_join, write_table
from strandmill.llm.words import SPACED, _power_tables, chunks, hashed, mix, split_words, text_bytes

MIN_WORDS = 20
SALTS = 16
OWNERS = 3
_SAME = np.arange(256, dtype=np.uint8)
LINE_SCHEMA = "doc_id bigint, row bigint, hashes array<bigint>, words array<int>, keys array<bigint>"
GONE_SCHEMA = "entry bigint, kept array<struct<at int, n int>>, n_lines int, n_words int, partners array<bigint>"


def runs(hashes: np.ndarray, words: np.ndarray, first: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, key) of the runs of each document, whose lines are first[i] to first[i + 1]; no line is blank."""
    n = len(hashes)
    total = np.concatenate([[0], np.cumsum(words, dtype=np.int64)])
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    power, inverse = _power_tables(n + 1)
    value = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes.view(np.uint64) * power[:n], out=value[1:])
    place = np.arange(n)
    to = np.searchsorted(total, total[:-1] + min_words)
    since = np.searchsorted(total, total[1:] - min_words, "right") - 1
    ahead, back = to <= first[1:][doc], since >= first[:-1][doc]
    start, end = np.concatenate([place[ahead], since[back]]), np.concatenate([to[ahead], place[back] + 1])
    return start, end, mix((value[end] - value[start]) * inverse[start] + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)).view(np.int64)


def line_table(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Per document with a doc_id and a text: its row key, hash (0 for a blank line) and words of each line, and the keys of its runs."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, "text"):
            data, offsets = text_bytes(part.column(2))
            breaks = np.flatnonzero(data == 10)
            start = np.sort(np.concatenate([offsets[:-1], breaks + 1]))
            # A text's last byte may be a line break: the empty line after it starts where the next text does.
            at = np.searchsorted(breaks, offsets)
            first = at + np.arange(len(offsets))
            end = np.sort(np.concatenate([breaks, offsets[1:]]))
            word = split_words(data, offsets, SPACED)
            count = np.searchsorted(word.start, end) - np.searchsorted(word.start, start)
            hashes = np.where(count > 0, hashed(data, start, end, _SAME), 0).astype(np.uint64).view(np.int64)
            full = np.flatnonzero(count > 0)
            begin, _, key = runs(hashes[full], count[full], np.searchsorted(full, first), min_words)
            of = np.searchsorted(first, full[begin], "right") - 1
            once = np.lexsort((key, of))
            of, key = of[once], key[once]
            new = np.ones(len(key), bool)
            new[1:] = (of[1:] != of[:-1]) | (key[1:] != key[:-1])
            ends = pa.array(first.astype(np.int32))
            keys = pa.ListArray.from_arrays(pa.array(np.searchsorted(of[new], np.arange(len(offsets))).astype(np.int32)), pa.array(key[new]))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.ListArray.from_arrays(ends, pa.array(hashes)), pa.ListArray.from_arrays(ends, pa.array(count.astype(np.int32))), keys], ["doc_id", "row", "hashes", "words", "keys"])

    own = docs.select(F.col("doc_id").cast("bigint"), row_key().alias("row"), "text")
    return own.where("doc_id is not null and text is not null").mapInArrow(work, LINE_SCHEMA)


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 64) -> Iterator[pa.RecordBatch]:
    """Few rows at a time, as their keys become Python numbers."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def blocks(flags: np.ndarray, words: np.ndarray, min_words: int) -> list[tuple[int, int]]:
    """Ranges of lines: maximal runs of flagged lines, over blank lines between them, with enough words."""
    out, start, end, total = [], -1, -1, 0
    for i in range(len(words) + 1):
        if i < len(words) and not words[i]:
            continue
        if i < len(words) and flags[i]:
            if start < 0:
                start, total = i, 0
            end, total = i + 1, total + int(words[i])
        elif start >= 0:
            if total >= min_words:
                out.append((start, end))
            start = -1
    return out


def patience(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """(place in b, place in a) of the lines that patience diff aligns; 0 is no anchor."""
    found, todo = [], [(0, len(a), 0, len(b))]
    while todo:
        i, j, k, m = todo.pop()
        while i < j and k < m and a[i] == b[k]:
            found.append((k, i))
            i, k = i + 1, k + 1
        while i < j and k < m and a[j - 1] == b[m - 1]:
            found.append((m - 1, j - 1))
            j, m = j - 1, m - 1
        if i >= j or k >= m:
            continue
        once_a, once_b = Counter(a[i:j]), Counter(b[k:m])
        where = {h: x for x, h in enumerate(a[i:j], i) if h and once_a[h] == 1}
        pairs = [(x, where[h]) for x, h in enumerate(b[k:m], k) if h in where and once_b[h] == 1]
        tails: list[int] = []
        ends: list[int] = []
        back = [-1] * len(pairs)
        for n, (_, y) in enumerate(pairs):
            p = bisect_left(tails, y)
            tails[p:p + 1] = [y]
            ends[p:p + 1] = [n]
            back[n] = ends[p - 1] if p else -1
        chain, n = [], ends[-1] if ends else -1
        while n >= 0:
            chain.append(pairs[n])
            n = back[n]
        if not chain:
            continue
        at_a, at_b = i, k
        for x, y in reversed(chain):
            todo.append((at_a, y, at_b, x))
            found.append((x, y))
            at_a, at_b = y + 1, x + 1
        todo.append((at_a, j, at_b, m))
    return found


def common_lines(a: np.ndarray, b: np.ndarray, words: np.ndarray, min_words: int) -> np.ndarray:
    """Places in b of the lines in common blocks with a: consecutive in both but for blank lines (0), of at least min_words words."""
    at, a = np.flatnonzero(b), a[a != 0]
    b, words = b[at], words[at].astype(np.int64)
    total = np.concatenate([[0], np.cumsum(words)])
    gone = np.zeros(len(b) + 1, np.int64)
    pairs = np.array(sorted(patience(a.tolist(), b.tolist())), np.int64).reshape(-1, 2)
    if len(pairs):
        cut = np.flatnonzero((np.diff(pairs, axis=0) != 1).any(1)) + 1
        start, end = pairs[np.concatenate([[0], cut]), 0], pairs[np.concatenate([cut, [len(pairs)]]) - 1, 0] + 1
        good = total[end] - total[start] >= min_words
        np.add.at(gone, start[good], 1)
        np.add.at(gone, end[good], -1)
    known, where = np.unique(b, return_index=True)
    if (np.isin(b, a) & (np.cumsum(gone[:-1]) == 0)).any():
        # Lines of a that b doesn't have end a run there.
        place = np.minimum(np.searchsorted(known, a), len(known) - 1)
        held = np.flatnonzero(known[place] == a)
        first = np.concatenate([[0], np.flatnonzero(np.diff(held) != 1) + 1, [len(held)]])
        *_, theirs = runs(a[held], words[where[place[held]]], first, min_words)
        start, end, key = runs(b, words, np.array([0, len(b)]), min_words)
        same = np.isin(key, theirs)
        np.add.at(gone, start[same], 1)
        np.add.at(gone, end[same], -1)
    return at[np.cumsum(gone[:-1]) > 0]


def partners_for(rarity: dict[int, int], owners: dict[int, list[tuple[int, int]]]) -> list[tuple[int, int]]:
    """Owners (doc_id, row) that together have every key, found from the rarest key on."""
    keys = sorted(owners, key=lambda h: (rarity[h], h))
    of: dict[tuple[int, int], set[int]] = {}
    for h in keys:
        for o in owners[h]:
            of.setdefault(o, set()).add(h)
    out, open_ = [], set(keys)
    for h in keys:
        if h in open_:
            best = max(owners[h], key=lambda o: (len(of[o] & open_), (-o[0], -o[1])))
            out.append(best)
            open_ -= of[best]
    return out


def gone_lines(lines: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """GONE_SCHEMA: per row that loses lines, the ranges of those that stay, and the doc_ids that have the others. lines is read several times."""
    spark, paths = lines.sparkSession, []

    def stored(df: DataFrame, tag: str) -> DataFrame:
        table, path = write_table(df, tag)
        paths.append(path)
        return table

    single = lines.dropDuplicates(["row"])
    place = F.struct("doc_id", "row")
    each = lines.select("doc_id", "row", F.explode("keys").alias("hash"))
    part = F.pmod(F.col("row"), F.lit(OWNERS))
    owners = each.groupBy("hash").agg(F.count("*").alias("rarity"), F.max(place).alias("last"), *(F.min(F.when(part == k, place)).alias(f"o{k}") for k in range(OWNERS)))
    owners = owners.withColumn("owners", F.filter(F.array(*(f"o{k}" for k in range(OWNERS))), lambda o: o.isNotNull() & (o < F.col("last")))).where(F.size("owners") > 0)
    # A hot line's rows are dealt to SALTS tasks, each with a copy of its owners.
    salted = owners.select("hash", "rarity", "owners", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    owned = each.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int")).join(salted, ["hash", "salt"])
    owned = owned.select("row", "hash", "rarity", F.filter("owners", lambda o: o < F.struct(F.col("doc_id"), F.col("row"))).alias("owners")).where(F.size("owners") > 0)
    shared = owned.distinct().groupBy("row").agg(F.collect_list(F.struct("hash", "rarity", "owners")).alias("known"))

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            out: list[tuple] = []
            for i, known in enumerate(batch.column(3).to_pylist()):
                owners = {k["hash"]: [(o["doc_id"], o["row"]) for o in k["owners"]] for k in known}
                out += [(i, of, other) for of, other in partners_for({k["hash"]: k["rarity"] for k in known}, owners)]
            rows = pa.array([o[0] for o in out], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), pa.array([o[1] for o in out], pa.int64()), pa.array([o[2] for o in out], pa.int64()), batch.column(1).take(rows), batch.column(2).take(rows)], ["row", "doc_id", "partner", "hashes", "words"])

    pairs = single.join(shared, "row").select("row", "hashes", "words", "known").mapInArrow(choose, "row bigint, doc_id bigint, partner bigint, hashes array<bigint>, words array<int>")
    pairs = stored(pairs, "op6-pairs")

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            each = [[x.values.to_numpy(zero_copy_only=False) for x in batch.column(i)] for i in (2, 3, 4)]
            at = [common_lines(a, b, w, min_words) for w, a, b in zip(*each, strict=True)]
            ends = pa.array(np.concatenate([[0], np.cumsum([len(x) for x in at])]).astype(np.int32))
            found = pa.ListArray.from_arrays(ends, pa.array(np.concatenate([np.zeros(0, np.int64), *at]).astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], found], ["row", "doc_id", "words", "at"])

    theirs = single.select(F.col("row").alias("partner"), F.col("hashes").alias("theirs"))
    found = spread_join(pairs, theirs, "partner", "row", pairs).select("row", "doc_id", "words", "theirs", "hashes").mapInArrow(align, "row bigint, doc_id bigint, words array<int>, at array<int>")
    merged = found.groupBy("row").agg(F.first("words").alias("words"), F.collect_list(F.struct("doc_id", "at")).alias("found"))

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept_type = pa.list_(pa.struct([("at", pa.int32()), ("n", pa.int32())]))
        for batch in _slices(batches):
            out: list[tuple] = []
            for row, words, matches in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                flags, words = np.zeros(len(words), bool), np.array(words)
                for m in matches:
                    flags[m["at"]] = True
                ranges = blocks(flags, words, 1)
                if ranges:
                    lost = np.zeros(len(words), bool)
                    for a, b in ranges:
                        lost[a:b] = True
                    stay = [(a, b) for a, b in zip([0, *(b for _, b in ranges)], [*(a for a, _ in ranges), len(words)], strict=True) if a < b]
                    out.append((row, [{"at": a, "n": b - a} for a, b in stay], int(lost.sum()), int(words[lost].sum()), sorted({m["doc_id"] for m in matches if lost[m["at"]].any()})))
            types = [pa.int64(), kept_type, pa.int32(), pa.int32(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], t) for c, t in enumerate(types)], ["entry", "kept", "n_lines", "n_words", "partners"])

    gone, _ = write_table(merged.mapInArrow(decide, GONE_SCHEMA), "op6-gone")
    for path in paths:
        drop_table(spark, path)
    return gone


def deduped(docs: DataFrame, min_words: int = MIN_WORDS) -> tuple[DataFrame, str]:
    """docs with their text less the deleted blocks, and the name of one more column: n_lines, n_words and partners of what was deleted, null where nothing was."""
    spark, names = docs.sparkSession, docs.columns
    small_batches(spark)
    lines, path = write_table(line_table(docs, min_words), "op6-lines")
    gone = gone_lines(lines, min_words)
    drop_table(spark, path)
    key, entry, change = fresh(names, "row"), fresh(names, "entry"), fresh(names, "change")
    table = gone.select(F.col("entry").alias(entry), F.struct("kept", "n_lines", "n_words", "partners").alias(change))
    # Documents that surely lose nothing aren't shuffled.
    same, touched = split_possible(docs.withColumn(key, row_key()), key, gone)
    joined = touched.join(table, F.col(key) == F.col(entry), "left").select(*names, change)
    out = same.select(*names, F.lit(None).cast(joined.schema[change].dataType).alias(change)).unionByName(joined)
    lines_ = F.split("text", "\n", -1)
    left = F.array_join(F.flatten(F.transform(F.col(change)["kept"], lambda r: F.slice(lines_, r["at"] + 1, r["n"]))), "\n")
    return out.select(*(F.when(F.col(change).isNull(), F.col("text")).otherwise(left).alias("text") if n == "text" else F.col(n) for n in names), change), change


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """docs with their text less the deleted blocks, then n_removed_lines, n_removed_words and partners (null where nothing was deleted) unless docs has such a column."""
    out, change = deduped(docs, min_words)
    more = {"n_removed_lines": F.coalesce(F.col(change)["n_lines"], F.lit(0)), "n_removed_words": F.coalesce(F.col(change)["n_words"], F.lit(0)), "partners": F.col(change)["partners"]}
    return out.select(*docs.columns, *(c.alias(n) for n, c in more.items() if n not in docs.columns))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the blocks of 20 words or more that earlier documents have line for line."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return dedup_lines(docs)
