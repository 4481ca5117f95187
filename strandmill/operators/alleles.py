"""Alleles of records: explosion and normalisation."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandmill.functions.genotype import alts_of, exclusion_reason
from strandmill.operators.context import chunked
from strandmill.operators.stored import Stored


def explode_alleles(records: DataFrame) -> DataFrame:
    """One row per ALT: alt_index from 1, allele and why it can't be normalised ('' if it can). A malformed REF or ALT raises."""
    each = records.select("*", F.posexplode(alts_of(F.col("alt"))).alias("_at", "allele"))
    return each.withColumns({"alt_index": F.col("_at") + 1, "exclusion_reason": reason_or_raise(F.col("ref"), F.col("allele"))}).drop("_at")


def reason_or_raise(ref: Column, allele: Column) -> Column:
    malformed = F.raise_error(F.concat(F.lit("malformed REF or ALT: "), F.coalesce(ref, F.lit("null")), F.lit(" "), F.coalesce(allele, F.lit("null")))).cast("string")
    return F.coalesce(exclusion_reason(ref, allele), malformed)


def left_align(sequence: str, pos: int, ref: str, alt: str) -> tuple[int, str, str]:
    """Smallest, leftmost form of a variant in a sequence whose first base is at 1 (Tan, Abecasis & Kang 2015)."""
    while ref and alt and ref[-1] == alt[-1] and ref != alt:
        if (len(ref) == 1 or len(alt) == 1) and pos == 1:
            break  # nothing stands before the contig's first base
        ref, alt = ref[:-1], alt[:-1]
        if not ref or not alt:
            pos -= 1
            base = sequence[pos - 1]
            ref, alt = base + ref, base + alt
    while len(ref) >= 2 and len(alt) >= 2 and ref[0] == alt[0]:
        ref, alt, pos = ref[1:], alt[1:], pos + 1
    return pos, ref, alt


#: Bases of a piece that a moving variant is compared with at once, and cells of one comparison.
CHUNK, CELLS = 1024, 1 << 22
#: Variants up to which a round is broadcast to the pieces, so that the reference isn't shuffled again.
BROADCAST_VARIANTS = 100_000
KEY = ["contig", "pos", "ref", "allele"]


def common_prefix(a: list[str], b: list[str]) -> np.ndarray:
    """How many letters each pair shares from its start; pairs of like length are compared as matrices."""
    least = np.array([min(len(x), len(y)) for x, y in zip(a, b, strict=True)], np.int64)
    out, order = least.copy(), np.argsort(least, kind="stable")
    size = least[order]
    at = 0
    while at < len(order):
        most = max(2 * int(size[at]), 64)
        step = min(int(np.searchsorted(size, most, "right")) - at, max(1, CELLS // most))
        own = order[at : at + step]
        at += step
        wide = int(least[own[-1]])
        if wide:
            x, y = (np.array([t[i][:wide].encode() for i in own], f"S{wide}").view(np.uint8).reshape(len(own), wide) for t in (a, b))
            apart = x != y
            out[own] = np.minimum(np.where(apart.any(1), apart.argmax(1), wide), least[own])
    return out


def trimmed(ref: list[str], alt: list[str], pos: list[int]) -> tuple[list[int], list[str], list[str], list[bool]]:
    """Position and alleles without what both share at their ends. True where one is then empty: the other can move left from
    the base before pos. Such a variant at a contig's first base keeps its last base."""
    tail = np.where(np.array([r == a for r, a in zip(ref, alt, strict=True)], bool), 0, common_prefix([r[::-1] for r in ref], [a[::-1] for a in alt]))
    least = np.array([min(len(r), len(a)) for r, a in zip(ref, alt, strict=True)], np.int64)
    moves = (tail == least) & (least > 0)
    at_start = moves & (np.array(pos, np.int64) == 1)
    moves &= ~at_start
    tail = tail - at_start
    ref, alt = ([x[: len(x) - t] for x, t in zip(xs, tail.tolist(), strict=True)] for xs in (ref, alt))
    head = np.where(moves, 0, np.minimum(common_prefix(ref, alt), np.maximum(np.array([min(len(r), len(a)) for r, a in zip(ref, alt, strict=True)], np.int64) - 1, 0)))
    return (np.array(pos, np.int64) + head).tolist(), [x[h:] for x, h in zip(ref, head.tolist(), strict=True)], [x[h:] for x, h in zip(alt, head.tolist(), strict=True)], moves.tolist()


def _trim(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        up = [[x.upper() for x in b.column(i).to_pylist()] for i in (2, 3)]
        at, ref, alt, moves = trimmed(*up, b.column(1).to_pylist())
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(at, pa.int64()), pa.array(ref, pa.string()), pa.array(alt, pa.string()), pa.array(moves, pa.bool_())], [*KEY, "at", "x", "y", "moves"])


def _move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One step to the left: `left` ends with the base before the moving letters, which are compared with it."""
    for b in batches:
        at, x, y, chunk, left = (b.column(i).to_pylist() for i in range(4, 9))
        unit = [p or q for p, q in zip(x, y, strict=True)]
        line = [s + u for s, u in zip(left, unit, strict=True)]
        by = common_prefix([s[::-1] for s in left], [s[::-1] for s in line])
        size = np.array([len(s) for s in left], np.int64)
        first = np.array(chunk, np.int64) == 0
        by = np.where(first, np.minimum(by, size - 1), by)  # nothing stands before a contig's first base
        on = by == size
        new = [s[n - k : n - k + len(u)] for s, n, k, u in zip(line, size.tolist(), by.tolist(), unit, strict=True)]
        base = ["" if o else s[n - k - 1] for s, n, k, o in zip(left, size.tolist(), by.tolist(), on.tolist(), strict=True)]
        columns = [pa.array([a - k for a, k in zip(at, by.tolist(), strict=True)], pa.int64()), pa.array([g + u if p else g for g, u, p in zip(base, new, x, strict=True)], pa.string()), pa.array([g if p else g + u for g, u, p in zip(base, new, x, strict=True)], pa.string()), pa.array(on.tolist(), pa.bool_())]
        yield pa.RecordBatch.from_arrays([*b.columns[:4], *columns], [*KEY, "at", "x", "y", "moves"])


def canonical(variants: DataFrame, contigs: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """A stored table of contig, pos, ref, allele, canonical_pos, canonical_ref and canonical_alt of each distinct variant.

    Variants of which one allele is used up by trimming move left in rounds: those still moving meet the piece of their
    contig to the left, of `chunk` bases, and carry on from where they stopped. No row holds a contig.
    """
    once = variants.select("contig", F.col("pos").cast("bigint").alias("pos"), "ref", "allele").distinct()
    kinds = "contig string, pos bigint, ref string, allele string, at bigint, x string, y string, moves boolean"
    now = Stored(once.mapInArrow(_trim, kinds), "variants").table
    done, pieces = [], chunked(contigs.select("contig", "sequence"), 0, chunk)
    while True:
        done.append(now.where(~F.col("moves")).select(*KEY, F.col("at").alias("canonical_pos"), F.col("x").alias("canonical_ref"), F.col("y").alias("canonical_alt")))
        moving = now.where("moves")
        n = moving.count()
        if not n:
            return reduce(DataFrame.unionByName, done)
        first = len(done) == 1
        # `at` is the place after the base that comes next.
        near = moving.withColumn("at", F.col("at") - 1).withColumn("chunk", F.floor((F.col("at") - 1) / chunk).cast("int"))
        met = (F.broadcast(near) if n <= BROADCAST_VARIANTS else near).join(pieces, ["contig", "chunk"])
        left = F.expr(f"substring(piece, 1, cast(at - cast(chunk as bigint) * {chunk} as int))")
        ready = met.select(*KEY, "at", "x", "y", "chunk", left.alias("left"))
        step = ready.mapInArrow(_move, kinds).withColumn("at", F.col("at") + F.col("moves").cast("int"))
        now = Stored(step, "variants").table
        if now.count() != n:
            raise ValueError(f"variants on unknown contigs or past their ends: {n - now.count()} of {n}" + ("" if first else " while moving"))


def normalise(alleles: DataFrame, contigs: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """alleles (contig, pos, ref, allele, exclusion_reason and more) with the canonical allele, null where a reason stands.

    Substitutions of one base are canonical already; each other variant is moved once, however many rows have it. A row
    whose variant was lost is an error.
    """
    plain = (F.length("ref") == 1) & (F.length("allele") == 1)
    ok = F.col("exclusion_reason") == ""
    single = alleles.where(~ok | plain).withColumns({"canonical_pos": F.when(ok, F.col("pos")).cast("bigint"), "canonical_ref": F.when(ok, F.upper("ref")), "canonical_alt": F.when(ok, F.upper("allele"))})
    rest = alleles.where(ok & ~plain)
    found = rest.join(canonical(rest, contigs, chunk), KEY, "left").select(*alleles.columns, "canonical_pos", "canonical_ref", "canonical_alt")
    lost = F.raise_error(F.concat(F.lit("lost variant at "), "contig", F.lit(":"), F.col("pos").cast("string"))).cast("bigint")
    return single.unionByName(found.withColumn("canonical_pos", F.coalesce("canonical_pos", lost)))
