"""Benchmark decontamination by a distributed positional inverted index.

build_index() turns documents into segments: each row holds some whole documents, the sorted hashes of their words
and, per word, the ascending places where it stands. Segments are independent, so the index is built and searched
without a shuffle, on as many machines as there are partitions, and can be stored and searched again. A search
takes the rarest word of each phrase in the segment, shifts its places by the word's offset in the phrase, and
intersects them with the lists of the other words from rare to frequent. proximity_matches() finds documents where
all words of an item lie within a span.

Items are searched in blocks of bounded size, one broadcast at a time: with more than one, a pass writes the index with
what it found so far, and the last pass reports.

Nulls: a null text has no words; a null doc_id is kept as it is. A null or wordless item never matches, nor does one
without an item_id, which could not be named. Repeated
rows are kept, each with its own result. Extra columns are ignored. Empty tables give empty results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandmill.llm.shared import drop_table, write_table
from strandmill.llm.words import U, chunks, split_words, text_bytes

INDEX_SCHEMA = "docs array<bigint>, firsts binary, terms binary, ends binary, places binary"
MATCH_SCHEMA = "doc_id bigint, item_id bigint, at bigint, n_words bigint"
REPORT_SCHEMA = "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean"
#: Phrases travel to the executors in blocks of at most so many bytes.
BLOCK_BYTES = 32 << 20


def build_index(docs: DataFrame, segment_bytes: int = 2 << 20) -> DataFrame:
    """One row per segment of about segment_bytes of text; a longer text is a segment of its own."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, "text", segment_bytes):
            words = split_words(*text_bytes(part.column(1)))
            order = np.argsort(words.hash)
            ordered = words.hash[order]
            new = np.ones(len(ordered), bool)
            new[1:] = ordered[1:] != ordered[:-1]
            slot = np.cumsum(new) - 1
            places = (np.sort(slot << 32 | order) & 0xFFFFFFFF).astype(np.uint32)
            ends = np.append(np.flatnonzero(new)[1:], len(ordered)).astype(np.uint32) if len(ordered) else np.zeros(0, np.uint32)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([part.column(0).to_pylist()], pa.list_(pa.int64())),
                    *(pa.array([x.tobytes()], pa.binary()) for x in (words.first.astype(np.uint32), ordered[new], ends, places)),
                ],
                ["docs", "firsts", "terms", "ends", "places"],
            )

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(build, INDEX_SCHEMA)


class Phrases:
    """Windows of item words: term numbers (padded with -1), item of each, and the sorted distinct term hashes."""

    def __init__(self, items: list[tuple[int, str]], window: int):
        items = [(i, t) for i, t in items if t and i is not None]
        words = split_words(*text_bytes(pa.array([t for _, t in items], pa.string())))
        self.terms, number = np.unique(words.hash, return_inverse=True)
        rows, whose = [], []
        for k, (item, _) in enumerate(items):
            own = number[words.first[k] : words.first[k + 1]]
            size = min(window, len(own))
            for at in range(len(own) - size + 1) if size else ():
                rows.append(np.pad(own[at : at + size], (0, window - size), constant_values=-1))
                whose.append(item)
        table = np.array(rows, np.int64).reshape(len(rows), window)
        both, self.of = np.unique(np.column_stack([whose, table]) if rows else np.zeros((0, window + 1), np.int64), axis=0, return_index=True)
        self.items, self.table = both[:, 0], both[:, 1:]
        self.sizes = (self.table >= 0).sum(1)
        # Phrases are looked up by their rarest term among all phrases.
        if len(self.table):
            often = np.append(np.bincount(self.table[self.table >= 0], minlength=len(self.terms)), np.iinfo(np.int64).max)
            key = self.table[np.arange(len(self.table)), often[self.table].argmin(1)]
            self.by_key = np.argsort(key, kind="stable")
            self.key_first = np.searchsorted(key[self.by_key], np.arange(len(self.terms) + 1))


class Segment:
    """A row of the index, with its lists as numpy arrays."""

    def __init__(self, row: dict):
        self.docs = row["docs"]
        self.first = np.frombuffer(row["firsts"], np.uint32).astype(np.int64)
        self.terms = np.frombuffer(row["terms"], U)
        self.ends = np.frombuffer(row["ends"], np.uint32).astype(np.int64)
        self.places = np.frombuffer(row["places"], np.uint32)
        self.starts = np.concatenate([[0], self.ends[:-1]]) if len(self.ends) else self.ends

    def slots(self, terms: np.ndarray) -> np.ndarray:
        """The number here of each term hash, or -1."""
        if not len(self.terms) or not len(terms):
            return np.full(len(terms), -1)
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        return np.where(self.terms[at] == terms, at, -1)

    def keys(self, slots: np.ndarray) -> np.ndarray:
        """Ascending slot << 32 | place of the lists of these ascending slots."""
        sizes = self.ends[slots] - self.starts[slots]
        where = np.repeat(self.starts[slots] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        return np.repeat(slots, sizes) << 32 | self.places[where].astype(np.int64)

    def phrases(self, query: Phrases) -> tuple[np.ndarray, np.ndarray]:
        """(phrase number, first place) of every occurrence that lies within one document."""
        none = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if not len(query.table):
            return none
        slot = np.append(self.slots(query.terms), -2)  # -2 stands for padding
        here = np.flatnonzero(slot[:-1] >= 0)
        low, many = query.key_first[here], query.key_first[here + 1] - query.key_first[here]
        alive = query.by_key[np.repeat(low - np.cumsum(many) + many, many) + np.arange(many.sum())]
        table = slot[query.table[alive]]
        whole = (table != -1).all(1)
        alive, table = alive[whole], table[whole]
        if not len(alive):
            return none
        size = np.where(table >= 0, (self.ends - self.starts)[np.maximum(table, 0)], np.iinfo(np.int64).max)
        rank = np.argsort(size, axis=1, kind="stable")
        keys = self.keys(np.unique(table[table >= 0]))
        own = table[np.arange(len(alive)), rank[:, 0]]
        low, high = np.searchsorted(keys, own << 32), np.searchsorted(keys, (own + 1) << 32)
        which = np.repeat(np.arange(len(alive)), high - low)
        place = keys[np.repeat(low - np.cumsum(high - low) + (high - low), high - low) + np.arange(len(which))] & 0xFFFFFFFF
        place = place - rank[which, 0]
        keep = place >= 0
        which, place = which[keep], place[keep]
        for j in range(1, table.shape[1]):
            column = rank[which, j]
            term = table[which, column]
            wanted = term << 32 | (place + column)
            at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
            keep = (term < 0) | (keys[at] == wanted)
            which, place = which[keep], place[keep]
        which = alive[which]
        doc = np.searchsorted(self.first, place, "right") - 1
        keep = place + query.sizes[which] <= self.first[doc + 1] if len(place) else np.zeros(0, bool)
        return which[keep], place[keep]


def _blocks(items: DataFrame, window: int, block_bytes: int) -> Iterator[list[tuple[int, str]]]:
    """The stated query set in blocks of bounded size; one block is on the driver at a time."""
    block, size = [], 0
    for r in items.select(F.col("item_id").cast("bigint"), "text").toLocalIterator():
        block.append((r[0], r[1]))
        size += (len(r[1] or "") // 2 + 1) * 8 * window
        if size > block_bytes:
            yield block
            block, size = [], 0
    if block:
        yield block


def phrase_matches(index: DataFrame, items: DataFrame, window: int = 13, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Every exact occurrence of a window: document, item, word number of the start, words."""
    out = None
    for block in _blocks(items, window, block_bytes):
        query = index.sparkSession.sparkContext.broadcast(Phrases(block, window))

        def search(batches, query=query):
            for batch in batches:
                for row in batch.to_pylist():
                    seg = Segment(row)
                    which, place = seg.phrases(query.value)
                    doc = np.searchsorted(seg.first, place, "right") - 1
                    yield pa.RecordBatch.from_arrays([pa.array([seg.docs[d] for d in doc], pa.int64()), pa.array(query.value.items[which]), pa.array(place - seg.first[doc]), pa.array(query.value.sizes[which])], ["doc_id", "item_id", "at", "n_words"])

        found = index.mapInArrow(search, MATCH_SCHEMA)
        out = found if out is None else out.unionByName(found)
    return index.sparkSession.createDataFrame([], MATCH_SCHEMA) if out is None else out


def proximity_matches(index: DataFrame, items: DataFrame, span: int = 40, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Documents with all distinct words of an item within span consecutive words: (doc_id, item_id, at), at the first such place."""
    out = None
    for block in _blocks(items, 1, block_bytes):
        lists = []
        for item, text in block:
            terms = np.unique(split_words(*text_bytes(pa.array([text or ""]))).hash)
            if len(terms):
                lists.append((item, terms))
        query = index.sparkSession.sparkContext.broadcast(lists)

        def search(batches, query=query):
            for batch in batches:
                for row in batch.to_pylist():
                    seg, found = Segment(row), []
                    for item, terms in query.value:
                        slots = seg.slots(terms)
                        if (slots < 0).any():
                            continue
                        rare = slots[np.argmin((seg.ends - seg.starts)[slots])]
                        low = np.zeros(0, np.int64)
                        # A span that holds all words has one that starts at some word of the item.
                        key = seg.keys(np.unique(slots))
                        for a in np.unique(key & 0xFFFFFFFF):
                            d = int(np.searchsorted(seg.first, a, "right")) - 1
                            stop = min(a + span, seg.first[d + 1])
                            if all(np.searchsorted(key, s << 32 | a) < np.searchsorted(key, s << 32 | stop) for s in (rare, *slots)):
                                low = np.append(low, a)
                        docs = np.searchsorted(seg.first, low, "right") - 1
                        for d, i in zip(*np.unique(docs, return_index=True), strict=True):
                            found.append((seg.docs[d], item, int(low[i] - seg.first[d])))
                    yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in range(3)], ["doc_id", "item_id", "at"])

        part = index.mapInArrow(search, "doc_id bigint, item_id bigint, at bigint")
        out = part if out is None else out.unionByName(part)
    return index.sparkSession.createDataFrame([], "doc_id bigint, item_id bigint, at bigint") if out is None else out


#: The index and what earlier blocks of items found: the words that hits begin and end at, and (document, item) pairs.
FOUND_SCHEMA = INDEX_SCHEMA + ", steps binary, found array<struct<doc:bigint,item:bigint>>"


def _search(batches: Iterator[pa.RecordBatch], query: Phrases) -> Iterator[tuple[dict, Segment, np.ndarray, list]]:
    """(row, segment, steps, pairs found) of each row, with the block's finds added to those of earlier ones."""
    for batch in batches:
        for row in batch.to_pylist():
            seg = Segment(row)
            step = np.frombuffer(row["steps"], np.int64).copy() if row.get("steps") else np.zeros(int(seg.first[-1]) + 1, np.int64)
            found = [(x["doc"], x["item"]) for x in row.get("found") or ()]
            which, place = seg.phrases(query)
            np.add.at(step, place, 1)
            np.add.at(step, place + query.sizes[which], -1)
            doc = np.searchsorted(seg.first, place, "right") - 1
            if len(doc):
                found += [(int(d), int(i)) for d, i in np.unique(np.column_stack([doc, query.items[which]]), axis=0)]
            yield row, seg, step, found


def contamination(index: DataFrame, items: DataFrame, window: int = 13, one_in: int = 20, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per document its words, words inside any occurrence, items that occur, and whether hits are at least 1 in one_in words."""
    spark, path, blocks = index.sparkSession, None, _blocks(items, window, block_bytes)
    block = next(blocks, [])
    while (following := next(blocks, None)) is not None:
        query = spark.sparkContext.broadcast(Phrases(block, window))

        def add(batches: Iterator[pa.RecordBatch], query=query) -> Iterator[pa.RecordBatch]:
            schema = pa.schema([("docs", pa.list_(pa.int64())), *((n, pa.binary()) for n in ("firsts", "terms", "ends", "places", "steps")), ("found", pa.list_(pa.struct([("doc", pa.int64()), ("item", pa.int64())])))])
            for row, _, step, found in _search(batches, query.value):
                yield pa.RecordBatch.from_pylist([{**row, "steps": step.tobytes(), "found": [{"doc": d, "item": i} for d, i in found]}], schema)

        before = path
        index, path = write_table(index.mapInArrow(add, FOUND_SCHEMA), "found")
        if before:
            drop_table(spark, before)
        query.destroy()
        block = following
    last = spark.sparkContext.broadcast(Phrases(block, window))

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        empty = hashlib.sha256(b"").hexdigest()
        for _, seg, step, found in _search(batches, last.value):
            n = np.diff(seg.first)
            items_of: dict[int, set[str]] = {}
            for d, i in found:
                items_of.setdefault(d, set()).add(str(i))
            hit = np.concatenate([[0], np.cumsum(np.cumsum(step[:-1]) > 0)])
            hits = hit[seg.first[1:]] - hit[seg.first[:-1]]
            names = [sorted(items_of.get(d, ())) for d in range(len(n))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(seg.docs, pa.int64()), pa.array(n), pa.array(hits), pa.array([len(x) for x in names], pa.int64()), pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() if x else empty for x in names]), pa.array((hits > 0) & (one_in * hits >= n))],
                REPORT_SCHEMA.replace(" bigint", "").replace(" string", "").replace(" boolean", "").split(", "),
            )

    return index.mapInArrow(report, REPORT_SCHEMA)


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored index of all documents, searched for all 13-word windows of the benchmark."""
    index, _ = write_table(build_index(spark.read.parquet(f"{sf_dir}/documents.parquet")), "op7-index")
    return contamination(index, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


OP7_SQL = r"""
WITH texts AS (
  SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'i', item_id, text FROM benchmark),
words AS (
  SELECT kind, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
wanted AS (
  SELECT DISTINCT id AS item_id, k, array_to_string(w[i:i + k - 1], ' ') AS s
  FROM (SELECT id, w, least(13, len(w)) AS k, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM words WHERE kind = 'i' AND len(w) > 0)),
places AS (SELECT id AS doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM words WHERE kind = 'd'),
found AS (
  SELECT doc_id, i, k, item_id
  FROM (SELECT doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') AS s FROM places, (SELECT DISTINCT k FROM wanted) WHERE i + k - 1 <= len(w)) JOIN wanted USING (k, s)),
hit AS (SELECT doc_id, count(DISTINCT spot) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS spot FROM found) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS name FROM found) GROUP BY doc_id)
SELECT id AS doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM words LEFT JOIN hit ON hit.doc_id = id LEFT JOIN items ON items.doc_id = id WHERE kind = 'd'
"""
