"""N-gram Jaccard join: a size-aware heavy-light join of shingle sets, exact at every size.

Two sets of sizes n and m link when their overlap is at least ceil(t * (n + m) / (1 + t)).

Light sets (at most `boundary` shingles) enumerate fixed-size subsets: for each size m that can link, all subsets of
exactly the needed overlap. Heavy sets are scanned through inverted lists. A list of single shingles would grow with
every passage that many documents share, so a list stands for a block of shingles: the hash space is cut into g
parts, and a set appears in the list of its content in each part. Linked sets differ in at most k shingles, so with
g > k parts some part is equal in both; parts that are empty are allowed for by x more parts, and a set with more
than x empty ones also enters the list of such sets. g and k follow from size levels, each 1 / t wide: a set enters
its own level and the one below. The boundary is the largest size at which the subsets cost less than the lists.

This departs from lists of single shingles, rare ones first: whatever order the shingles have, the passage that a third
of all documents share would be in the prefix of short ones and make one list of them all.

Sets that share a list are candidates, and overlap is always counted on the whole sets:
* equal sets are one node from the start;
* a list's pivot is the member with most shared lists, near the middle of its family; each node is held against the
  pivot it meets most often. That is one pair a node, and gives most components;
* lists that still hold several components are compared in numpy, in blocks of bounded size, but only nodes that are in
  as many of them as a link needs.
Before its sets are fetched, a pair must pass a bound: a part's signature is a byte of its hash and its number of
shingles, and parts that differ add up to a least difference of the sets, which a link of these sizes must allow. So no
link between different components is lost, and no list is turned into all its pairs.

A list key is 34 bits of the part's hash, 6 of its number of shingles (63: that or more), 16 of its place and 8 of the
level's tag, its number + 1. Subset keys have tag 0.

Nodes and shingles are 64-bit hashes, and so are rows: row is the hash of doc_id and text. Nulls and texts without words
have no set and link with nothing. Repeated rows link with each other through their node. A null doc_id is kept with its
own row; its text links as any other, and a component of such rows alone has a null id. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache
from itertools import combinations
from math import ceil, comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandmill.llm.bloom import only_possible
from strandmill.llm.graph import connected_components
from strandmill.llm.shared import drop_table, release, row_key, small_batches, spread_join, write_table
from strandmill.llm.words import SPACED, U, chunks, mix, shingles, split_words, text_bytes

SET_SCHEMA = "doc_id bigint, row bigint, n bigint, node bigint, keys array<bigint>"
VECTOR_SCHEMA = "node bigint, n bigint, own int, tag int, need int, parts int, vector binary"
#: Work for a key in an inverted list, against a subset key: its candidates have to be verified.
LIST_COST = 8
#: The part number in the key of the list of sets with many empty parts.
SPARSE = 0xFFFF
_HASH = 0xFFFFFFFFC0000000
_SUBSET = 0xFFFFFFFFFFFFFF00
#: Largest number of shingles that a key and a signature tell.
MANY = 63
#: Members of a list that one task compares with as many others.
BLOCK = 1024
#: Sets with more parts than this don't take their signatures to every list; the lists that two of them share are counted instead.
VECTOR_PARTS = 512


class Plan:
    """Sizes, levels and parts for links at similarity num / den."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        self.boundary = 1
        while self.subset_keys(self.boundary + 1) <= LIST_COST * self.list_keys(self.boundary + 1):
            self.boundary += 1
        self.lowest = -(-num * (self.boundary + 1) // den)
        self.starts = [self.lowest]

    def overlap(self, n: int, m: int) -> int:
        return -(-self.num * (n + m) // (self.num + self.den))

    def partners(self, n: int) -> range:
        return range(-(-self.num * n // self.den), n * self.den // self.num + 1)

    def subset_keys(self, n: int) -> int:
        return sum(comb(n, self.overlap(n, m)) for m in self.partners(n) if self.overlap(n, m) <= min(n, m))

    def list_keys(self, n: int) -> int:
        return 2 * self._parts(n)[0]

    def _parts(self, top: int) -> tuple[int, int]:
        """(g, x) of a level whose largest set has top shingles."""
        k = (top + top * self.den // self.num) * (self.den - self.num) // (self.den + self.num)
        x = 5 + ceil(0.04 * k)
        return k + 1 + x, x

    def level(self, n: int) -> int:
        while self.starts[-1] <= n:
            self.starts.append(self.starts[-1] * self.den // self.num + 1)
        return int(np.searchsorted(self.starts, n, "right")) - 1

    @cache  # noqa: B019
    def parts(self, level: int) -> tuple[np.ndarray, int]:
        """Lower ends of the parts of a level, and x."""
        self.level(self.starts[level])
        g, x = self._parts(self.starts[level + 1] - 1)
        return np.array([(i << 64) // g for i in range(g)], U), x

    def apart(self, total: np.ndarray | int):
        """Most shingles that linked sets of so many together differ in."""
        return total - 2 * -(-self.num * total // (self.num + self.den))

    def vectors(self, n: int, keys: np.ndarray) -> list[tuple[int, int, int, int, bytes]]:
        """(own tag, tag, need, parts, signature) of a set at its own tag and the one below; sets below all levels have tag 0 alone.

        A linked set of no lower tag shares `need` lists of the tag at least.
        """
        own = self.level(n) + 1 if n >= self.lowest else 0
        out = []
        for tag in {own, max(own - 1, 0)}:
            if not tag:
                out.append((own, 0, 1, 0, b""))
                continue
            g = len(self.parts(tag - 1)[0])
            mine = keys[(keys & U(0xFF)) == U(tag)]
            place = (mine >> U(8) & U(SPARSE)).astype(np.int64)
            mine, place = mine[place < g], place[place < g]
            both = np.zeros((2, g), np.uint8)
            both[0, place] = (mine >> U(56)).astype(np.uint8)
            both[1, place] = (mine >> U(24) & U(MANY)).astype(np.uint8)
            out.append((own, tag, max(1, len(place) - int(self.apart(n + n * self.den // self.num))), g, both.tobytes()))
        return out

    def keys(self, shingle: np.ndarray) -> np.ndarray:
        """List and subset keys of an ascending set."""
        n, out = len(shingle), []
        mixed = mix(shingle)
        total = np.concatenate([np.zeros(1, U), np.cumsum(mixed, dtype=U)])
        if n <= self.boundary:
            for m in self.partners(n):
                size = self.overlap(n, m)
                if size > min(n, m):
                    continue
                low, high = min(n, m), max(n, m)
                drop = np.array([sum(int(mixed[i]) for i in gone) & (2**64 - 1) for gone in combinations(range(n), n - size)], U)
                out.append(mix(total[-1] - drop + U((low << 20 | high) * 0x9E3779B97F4A7C15 & (2**64 - 1))) & U(_SUBSET))
        if n >= self.lowest:
            own = self.level(n)
            for level in (own, own - 1) if own else (own,):
                edges, x = self.parts(level)
                cut = np.append(np.searchsorted(shingle, edges), n)
                full = np.flatnonzero(cut[1:] > cut[:-1])
                part = total[cut[full + 1]] - total[cut[full]]
                count = np.minimum(cut[full + 1] - cut[full], MANY).astype(U)
                out.append(mix(part) & U(_HASH) | count << U(24) | (full.astype(U) & U(SPARSE)) << U(8) | U(level + 1))
                if len(edges) - len(full) > x:
                    out.append(np.array([SPARSE << 8 | level + 1], U))
        return np.concatenate(out) if out else np.zeros(0, U)


def shingle_sets(part: pa.RecordBatch, words_in_shingle: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, ascending distinct shingles) of the rows that have any."""
    doc, hashes = shingles(split_words(*text_bytes(part.column(part.schema.get_field_index("text"))), SPACED), words_in_shingle)
    if len(doc) and (doc[1:] < doc[:-1]).any():
        order = np.argsort(doc, kind="stable")
        doc, hashes = doc[order], hashes[order]
    edge = np.searchsorted(doc, np.arange(part.num_rows + 1))
    for i in np.flatnonzero(edge[1:] > edge[:-1]):
        yield int(i), np.unique(hashes[edge[i] : edge[i + 1]])


def rows_of(docs: DataFrame) -> DataFrame:
    """doc_id, row (a key of the row's id and text, never null) and text."""
    return docs.select(F.col("doc_id").cast("bigint"), row_key().alias("row"), "text")


def _node(own: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(own.tobytes(), digest_size=8).digest(), "little", signed=True)


def keyed_sets(docs: DataFrame, words_in_shingle: int, num: int, den: int) -> DataFrame:
    """Per document: row, set size, node (hash of the set; null without a set) and list keys."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = Plan(num, den)
        for part in chunks(batches, "text"):
            n, node = np.zeros(part.num_rows, np.int64), np.zeros(part.num_rows, np.int64)
            keys: list = [np.zeros(0, np.int64)] * part.num_rows
            for i, own in shingle_sets(part, words_in_shingle):
                n[i], node[i], keys[i] = len(own), _node(own), plan.keys(own).view(np.int64)
            ends = np.concatenate([[0], np.cumsum([len(k) for k in keys])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(keys)))
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(n), pa.array(node, mask=n == 0), lists], ["doc_id", "row", "n", "node", "keys"])

    return rows_of(docs).mapInArrow(work, SET_SCHEMA)


def _vectors(single: DataFrame, num: int, den: int) -> DataFrame:
    """The signatures of each row's set; rows of one node give the same."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = Plan(num, den)
        for batch in batches:
            rows = []
            for node, n, keys in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                own = keys.values.to_numpy().view(U)
                rows += [(node, n, *v) for v in plan.vectors(n, own)]
            names = [x.split(" ")[0] for x in VECTOR_SCHEMA.split(", ")]
            types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in enumerate(types)], names)

    return single.select("node", "n", "keys").mapInArrow(work, VECTOR_SCHEMA).dropDuplicates(["node", "tag"])


def _whole_sets(docs: DataFrame, words_in_shingle: int, rows: DataFrame) -> DataFrame:
    """(node, members) of the documents whose row is an entry of rows, and of a few others."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, "text"):
            node, sets = [], []
            for _, own in shingle_sets(part, words_in_shingle):
                node.append(_node(own))
                sets.append(own.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(sets, pa.binary())], ["node", "members"])

    return only_possible(rows_of(docs), "row", rows).mapInArrow(work, "node bigint, members binary").dropDuplicates(["node"])


def least_difference(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The fewest shingles in which sets with the signatures a (rows, 2, parts) can differ from one with b."""
    x, y = a[:, 1].astype(np.int16), b[1].astype(np.int16)
    count = np.maximum(np.abs(x - y), 1 + ((x == y) & (x < MANY)))
    return np.where((a[:, 0] == b[0]) & (x == y), 0, count).sum(1)


def _may_link(pairs: DataFrame, vectors: DataFrame, num: int, den: int) -> DataFrame:
    """The distinct pairs (a, b) that the bound allows."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = Plan(num, den)
        for batch in batches:
            n, m = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            keep = den * np.minimum(n, m) >= num * np.maximum(n, m)
            most = plan.apart(n + m)
            for i in np.flatnonzero(keep):
                x, y = (np.frombuffer(batch.column(c)[i].as_buffer(), np.uint8).reshape(2, -1) for c in (4, 5))
                keep[i] = least_difference(x[None], y)[0] <= most[i]
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], ["a", "b"])

    of = lambda x: vectors.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("own").alias(f"own_{x}"), F.col("tag").alias(f"tag_{x}"), F.col("vector").alias(f"of_{x}"))
    both = pairs.distinct().join(of("a"), "a").join(of("b"), "b").where((F.col("tag_a") == F.col("tag_b")) & (F.col("tag_a") == F.least("own_a", "own_b")))
    return both.select("a", "b", "n_a", "n_b", "of_a", "of_b").mapInArrow(work, "a bigint, b bigint")


def _verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) of nodes whose whole sets link."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                p, q = np.frombuffer(x.as_buffer(), U), np.frombuffer(y.as_buffer(), U)
                if len(p) > len(q):
                    p, q = q, p
                if den * len(p) < num * len(q):
                    keep.append(False)
                    continue
                at = np.minimum(np.searchsorted(q, p), len(q) - 1)
                both = int((q[at] == p).sum())
                keep.append(den * both >= num * (len(p) + len(q) - both))
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], ["a", "b"])

    with_a = pairs.join(sets.select(F.col("node").alias("a"), F.col("members").alias("of_a")), "a")
    with_b = spread_join(with_a, sets.select(F.col("node").alias("b"), F.col("members").alias("of_b")), "b", "a", pairs)
    return with_b.select("a", "b", "of_a", "of_b").mapInArrow(work, "a bigint, b bigint")


def _across(rest: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs (a, b) of nodes of different roots that share a list and may link. rest is dealt and sorted by (key, i, j).

    Where signatures came along, a pair must pass the bound (need 0); else it comes once a shared list, with the number
    of lists that a link needs: all parts, less those that may differ and those that may be empty in both.
    """

    def group_pairs(plan: Plan, key: int, cross: bool, side: np.ndarray, node: np.ndarray, n: np.ndarray, root: np.ndarray, need: np.ndarray, parts: np.ndarray, own: np.ndarray, vector: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        tag = key & 0xFF
        if not tag:  # the smallest set links with all others of its list
            pivot = np.lexsort((node, n))[0]
            other = np.flatnonzero(root != root[pivot])
            return np.full(len(other), node[pivot]), node[other], np.zeros(len(other), np.int64)
        table = None
        if parts[0] <= VECTOR_PARTS:
            table = np.frombuffer(b"".join(vector), np.uint8).reshape(len(n), 2, int(parts[0]))
        found = []
        for r in range(len(n)):
            fit = (side > side[r]) if cross else np.arange(len(n)) > r
            fit &= (root != root[r]) & (np.minimum(own, own[r]) == tag) & (den * np.minimum(n, n[r]) >= num * np.maximum(n, n[r]))
            to = np.flatnonzero(fit)
            most = plan.apart(n[to] + n[r])
            if table is None:
                least = np.maximum(need[to], need[r])
            else:
                to = to[least_difference(table[to], table[r]) <= most]
                least = np.zeros(len(to), np.int64)
            found.append((np.full(len(to), node[r]), node[to], least))
        return tuple(np.concatenate([x[c] for x in found]) for c in range(3))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan, rest_of = Plan(num, den), None

        def pairs(batch: pa.RecordBatch, whole: bool):
            """Pairs of the whole groups of the batch, and the rows of its last group unless whole."""
            key, i, j, side, node, n, root, need, parts, own = (batch.column(c).to_numpy() for c in range(10))
            edge = np.flatnonzero((key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])) + 1
            starts = np.concatenate([[0], edge])
            stops = np.append(edge, len(key))
            out = []
            for a, b in zip(starts, stops, strict=True) if whole else zip(starts[:-1], stops[:-1], strict=True):
                if (root[a:b] != root[a]).any():
                    out.append(group_pairs(plan, int(key[a]), i[a] != j[a], side[a:b], node[a:b], n[a:b], root[a:b], need[a:b], parts[a:b], own[a:b], batch.column(10)[int(a) : int(b)].to_pylist()))
            x, y, least = (np.concatenate([o[c] for o in out]) if out else np.zeros(0, np.int64) for c in range(3))
            found = pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y), pa.int64()), pa.array(np.maximum(x, y), pa.int64()), pa.array(least, pa.int64())], ["a", "b", "need"])
            return found, batch.slice(int(starts[-1]))

        for batch in batches:
            if not batch.num_rows:
                continue
            if rest_of is not None:
                batch = pa.Table.from_batches([rest_of, batch]).combine_chunks().to_batches()[0]
            found, rest_of = pairs(batch, False)
            yield found
        if rest_of is not None:
            yield pairs(rest_of, True)[0]

    emitted = rest.mapInArrow(work, "a bigint, b bigint, need bigint")
    return emitted.groupBy("a", "b").agg(F.count("*").alias("shared"), F.min("need").alias("need")).where("shared >= need").select("a", "b")


def linked_rows(docs: DataFrame, words_in_shingle: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """One row per document: doc_id, row, n, node and root. Rows of one root are linked; wordless ones have neither node nor root."""
    spark = docs.sparkSession
    small_batches(spark)
    paths: dict[str, str] = {}

    def stored(df: DataFrame, tag: str) -> DataFrame:
        table, paths[tag] = write_table(df, tag)
        return table

    def drop(*tags: str) -> None:
        for tag in tags:
            drop_table(spark, paths.pop(tag))

    keyed = stored(keyed_sets(docs, words_in_shingle, num, den), "keyed")
    sets, _ = write_table(keyed.select("doc_id", "row", "n", "node"), "sets")
    nodes = sets.where("node is not null")
    # Keys are counted once a node: only its first row goes on (and, harmlessly, a few that the filter takes for one).
    firsts = stored(nodes.groupBy("node").agg(F.min("row").alias("entry")), "firsts")
    single = only_possible(keyed.where("node is not null"), "row", firsts)
    postings = single.select(F.explode("keys").alias("key"), "node")
    shared = stored(postings.groupBy("key").agg(F.count("*").alias("c")).where("c > 1").select("key"), "lists")
    release(spark)
    held = only_possible(postings, "key", shared.select(F.col("key").alias("entry"))).distinct().join(shared, "key", "left_semi")
    held = stored(held, "held")
    degree = stored(held.groupBy("node").agg(F.count("*").alias("degree")), "degree")
    vectors = stored(_vectors(only_possible(single, "node", degree.select(F.col("node").alias("entry"))), num, den), "vectors")
    drop("keyed", "lists")
    release(spark)

    def linked(pairs: DataFrame, tag: str) -> DataFrame:
        """The pairs that link, by their whole sets, which are made for these nodes alone."""
        pairs = stored(_may_link(pairs, vectors, num, den), f"{tag}-pairs")
        ends = pairs.select("a").unionByName(pairs.select(F.col("b").alias("a"))).distinct()
        wanted = stored(ends.withColumnRenamed("a", "node").join(firsts, "node").select("entry"), f"{tag}-wanted")
        whole = stored(_whole_sets(docs, words_in_shingle, wanted), f"{tag}-whole")
        found = stored(_verified(pairs, whole, num, den), tag)
        drop(f"{tag}-pairs", f"{tag}-wanted", f"{tag}-whole")
        return found

    pivots = held.join(degree, "node").groupBy("key").agg(F.max(F.struct("degree", "node")).alias("top")).select("key", F.col("top.node").alias("pivot"))
    met = held.join(pivots, "key").where("node <> pivot").groupBy("node", "pivot").agg(F.count("*").alias("times"))
    star = met.groupBy("node").agg(F.max(F.struct("times", "pivot")).alias("best")).select(F.col("node").alias("a"), F.col("best.pivot").alias("b"))
    near = linked(star, "near")
    drop("degree")

    roots = connected_components(near)
    labelled = stored(held.join(roots, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root")), "labelled")
    drop("held")
    release(spark)
    mixed = labelled.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("many")).where("low < high")
    rest = labelled.join(mixed.select("key", F.ceil(F.col("many") / BLOCK).cast("int").alias("blocks")), "key").withColumn("tag", F.col("key").bitwiseAND(F.lit(0xFF)).cast("int"))
    # A set of a higher tag than the list's is there for those of a lower one; both come with their signature at the list's tag.
    wide = rest.join(vectors, ["node", "tag"]).withColumn("lists", F.count("*").over(Window.partitionBy("node", "tag"))).where("lists >= need")
    wide = wide.withColumn("side", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    vector = F.when(F.col("parts") <= VECTOR_PARTS, F.col("vector")).otherwise(F.lit(b""))
    dealt = wide.select("key", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"), "side", "node", "n", "root", F.col("need").cast("bigint").alias("need"), "parts", "own", vector.alias("vector"))
    across = stored(_across(dealt.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j"), num, den), "across")
    drop("labelled")
    release(spark)
    more = linked(across, "more")

    roots = connected_components(near.unionByName(more))
    names, _ = write_table(nodes.select("node").distinct().join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root")), "names")
    drop(*paths)
    return spread_join(nodes, names, "node", "row", nodes).select("doc_id", "row", "n", "node", "root").unionByName(sets.where("node is null").select("doc_id", "row", "n", "node", F.lit(None).cast("bigint").alias("root")))


def similarity_components(docs: DataFrame, words_in_shingle: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest doc_id reachable by links)."""
    rows, _ = write_table(linked_rows(docs, words_in_shingle, num, den), "linked")
    least = rows.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    alone = rows.where("root is null").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return spread_join(rows.where("root is not null"), least, "root", "row", rows.where("root is not null")).select("doc_id", F.col("n").alias("n_shingles"), "component_id").unionByName(alone)


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents by sets of 4-word shingles, linked at a similarity of 0.85 or more."""
    return similarity_components(spark.read.parquet(f"{sf_dir}/documents.parquet"), 4, 85, 100)


OP5_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, [w FOR w IN string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+') IF w <> ''] AS w FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] ELSE list_distinct([array_to_string(w[i:i + 3], ' ') FOR i IN range(1, greatest(len(w) - 2, 2))]) END AS s FROM words),
each AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM each a JOIN each b USING (shingle) WHERE a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
edges AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
reach(x, y) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.x, b.y FROM reach r JOIN edges b ON b.x = r.y)
SELECT s.doc_id, len(s.s) AS n_shingles, (SELECT min(y) FROM reach r WHERE r.x = s.doc_id) AS component_id FROM sets s
"""
