"""Windows of reference sequence around records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandmill.functions.identity import window_id

CHUNK = 1 << 16
#: A REF of so many bases is compared on its window's piece.
SHORT = 1024


def chunked(contigs: DataFrame, overlap: int, chunk: int = CHUNK, key: str = "contig") -> DataFrame:
    """(key, chunk, piece): pieces of a contig (contig, sequence) that overlap to the right, so that a join carries kilobytes a row and not a chromosome."""
    each = contigs.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.greatest(F.ceil(F.length("sequence") / chunk).cast("int") - 1, F.lit(0)))))
    return each.select(key, "chunk", F.expr(f"substring(sequence, chunk * {chunk} + 1, {chunk + overlap})").alias("piece"))


def add_windows(records: DataFrame, contigs: DataFrame, flank: int, reference: str, chunk: int = CHUNK) -> DataFrame:
    """records (contig, pos, ref) with start, stop, window_id, eligible, window_sequence and ref_agrees.

    contigs: contig, sequence, length. A window past an end of its contig isn't eligible and has no sequence. A record
    on an unknown contig is an error.
    """
    sized = records.join(contigs.select("contig", "length"), "contig", "left")
    known = F.when(F.col("length").isNull(), F.raise_error(F.concat(F.lit("unknown contig "), "contig")).cast("bigint")).otherwise(F.col("length"))
    r = sized.withColumn("length", known).withColumns({"start": F.col("pos") - flank, "stop": F.col("pos") + flank})
    r = r.withColumn("eligible", (F.col("start") >= 1) & (F.col("stop") <= F.col("length")))
    r = r.withColumn("chunk", F.floor((F.greatest(F.col("start"), F.lit(1)) - 1) / chunk).cast("int"))
    # The longest thing cut from a piece: a window, or a REF of up to SHORT bases from pos on.
    reach = 2 * flank + 1 + SHORT
    joined = r.join(chunked(contigs, reach, chunk), ["contig", "chunk"], "left").withColumn("_at", (F.col("chunk").cast("bigint") * chunk))
    window = F.expr(f"substring(piece, cast(start - _at as int), {2 * flank + 1})")
    ref = F.expr("substring(piece, cast(pos - _at as int), length(ref))")
    out = joined.withColumns({"window_sequence": F.when(F.col("eligible"), window), "ref_agrees": F.coalesce(ref == F.upper("ref"), F.lit(False)), "window_id": window_id(reference, F.col("contig"), F.col("start"), F.col("stop"))}).drop("piece", "_at", "chunk")
    # Longer ones are compared in parts, and only their rows are joined with the outcome.
    long_ref = F.coalesce(F.length("ref") > SHORT, F.lit(False))
    agreed = long_refs(records.where(long_ref), contigs, chunk)
    rest = out.where(long_ref).drop("ref_agrees").join(agreed, ["contig", "pos", "ref"], "left").withColumn("ref_agrees", F.coalesce("ref_agrees", F.lit(False)))
    return out.where(~long_ref).unionByName(rest)


def long_refs(records: DataFrame, contigs: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(contig, pos, ref, ref_agrees) of records' distinct places: a REF of any length, cut where its contig's pieces end. One past an end doesn't agree."""
    once = records.select("contig", F.col("pos").cast("bigint").alias("pos"), "ref").distinct()
    size = F.lit(chunk).cast("bigint")
    each = once.withColumn("chunk", F.explode(F.sequence(F.floor((F.col("pos") - 1) / size).cast("int"), F.floor((F.col("pos") + F.length("ref") - 2) / size).cast("int"))))
    begin = F.greatest(F.col("pos"), F.col("chunk") * size + 1)
    end = F.least(F.col("pos") + F.length("ref") - 1, (F.col("chunk") + 1) * size)
    parts = each.select("contig", "pos", "ref", "chunk", (begin - F.col("chunk") * size).cast("int").alias("at"), F.upper(F.substring("ref", (begin - F.col("pos") + 1).cast("int"), (end - begin + 1).cast("int"))).alias("part"))
    met = parts.join(chunked(contigs, 0, chunk), ["contig", "chunk"], "left")
    same = F.coalesce(F.substring("piece", F.col("at"), F.length("part")) == F.col("part"), F.lit(False))
    return met.groupBy("contig", "pos", "ref").agg(F.bool_and(same).alias("ref_agrees"))


def scan_windows(records: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Distinct eligible windows of ALT carriers; one id with two sequences is an error."""
    carrier = F.exists(F.split("gt", "[/|]"), lambda x: ~x.isin(".", "0"))
    keys = ["window_id", *(by or [])]
    once = records.where(F.col("eligible") & carrier).groupBy(*keys).agg(F.min("window_sequence").alias("sequence"), F.max("window_sequence").alias("other"), F.min("contig").alias("contig"), F.min("pos").alias("pos"))
    checked = F.when(F.col("sequence") == F.col("other"), F.col("sequence")).otherwise(F.raise_error(F.concat(F.lit("two sequences of "), "window_id")))
    return once.withColumn("sequence", checked).drop("other")
