"""Annotation of every genotype record with the best hit of its window."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandmill.functions.genotype import all_missing, alleles_of, has_alt, scoreable
from strandmill.functions.rules import midpoint
from strandmill.operators.evidence import best_hits, winner_in_window


def checked_hits(hits: DataFrame, ranks: DataFrame, windows: DataFrame) -> DataFrame:
    """hits (motif_id, window_id, start, stop, ...) with family_id and rank. A motif outside the library, an unknown window or a place outside its window is an error.

    ranks: motif_id, family_id, rank, as many rows as the library has motifs; windows: window_id, sequence.
    """
    ranked = hits.join(F.broadcast(ranks.select("motif_id", "family_id", "rank", F.lit(True).alias("_known"))), "motif_id", "left")
    sized = ranked.join(windows.select("window_id", F.length("sequence").alias("_length")), "window_id", "left")
    place = F.concat_ws(" ", F.lit("hit"), "motif_id", "window_id", F.col("start").cast("string"), F.col("stop").cast("string"))
    fault = F.when(F.col("_known").isNull(), "unknown motif in ").when(F.col("_length").isNull(), "unknown window in ").when((F.col("start") < 1) | (F.col("stop") < F.col("start")) | (F.col("stop") > F.col("_length")), "place outside its window in ")
    checked = F.when(fault.isNull(), F.col("motif_id")).otherwise(F.raise_error(F.concat(fault, place)))
    return sized.withColumn("motif_id", checked).drop("_known", "_length")


def identity_counts(records: DataFrame, annotation: DataFrame, key: list[str], columns: list[str]) -> DataFrame:
    """Per dataset: rows of one side only, and rows that differ in any of the columns (numbers, strings, booleans); nulls are equal to each other."""
    # Sides that stand partitioned by a part of the key are grouped where they are; a join would shuffle both by the whole key.
    # Columns are compared by a digest of all of them, so that a wide row isn't sorted or spilled.
    text = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
    side = lambda df, one: df.select(*key, F.unhex(F.sha2(text, 256)).alias("_digest"), F.lit(one).alias("_record"))
    alike = side(records, 1).unionAll(side(annotation, 0)).groupBy(*key, "_digest").agg(F.sum("_record").alias("_records"), F.sum(1 - F.col("_record")).alias("_annotations"))
    each = alike.groupBy(*key).agg(F.sum("_records").alias("_records"), F.sum("_annotations").alias("_annotations"), F.sum(F.col("_records") * F.col("_annotations")).alias("_same"))
    # As in a full join on the key: of several rows of one key each meets each, and a null key meets none.
    met = reduce(and_, (F.col(k).isNotNull() for k in key)) & (F.col("_records") > 0) & (F.col("_annotations") > 0)
    total = lambda value: F.coalesce(F.sum(value), F.lit(0)).cast("bigint")
    return each.groupBy("dataset_id").agg(
        total(F.when(~met, F.col("_annotations"))).alias("only_annotation"),
        total(F.when(~met, F.col("_records"))).alias("only_record"),
        total(F.when(met, F.col("_records") * F.col("_annotations") - F.col("_same"))).alias("differing"),
    )


def window_winners(hits: DataFrame, flank: int) -> DataFrame:
    """Per window: the winning hit, its midpoint and the number of distinct motifs."""
    # The best of each motif, then the best of these: one pass over the hits.
    each = best_hits(hits, ["window_id", "motif_id"], "winner")
    best = best_hits(each.withColumn("distinct_motif_count", F.lit(1).cast("bigint")), ["window_id"], "winner", {"distinct_motif_count": F.sum("distinct_motif_count")})
    return best.withColumn("midpoint_distance", midpoint(F.col("start"), F.col("stop"), flank))


BEST = ("motif_id", "family_id", "score", "p", "start", "stop", "strand", "matched")


def _scannable(min_width: int | None) -> Column:
    """Can the record's window have a winner: an ALT carrier, whole, and wide enough for a model."""
    fit = F.lit(False) if min_width is None else scoreable(F.col("window_sequence"), min_width)
    return has_alt(alleles_of(F.col("gt"))) & F.col("eligible") & fit


def _judged(rows: DataFrame, min_width: int | None) -> DataFrame:
    """rows with status and reason; `_able` tells of _scannable."""
    alleles = alleles_of(F.col("gt"))
    carrier, none, hit = has_alt(alleles), F.lit(min_width is None), F.col("best_motif_id").isNotNull()
    status = F.when(~carrier, "not_applicable").when(~F.col("eligible"), "not_scanned").when(none, "unclassified").when(~F.col("_able"), "not_scanned").when(hit, "promising").otherwise("unclassified")
    reason = F.when(~carrier & all_missing(alleles), "missing_gt").when(~carrier, "reference_only").when(~F.col("eligible"), "boundary_window").when(none, "no_selected_motifs").when(~F.col("_able"), "no_scoreable_segment").otherwise("")
    return rows.withColumns({"annotation_status": status, "annotation_reason": reason, "distinct_motif_count": F.coalesce("distinct_motif_count", F.lit(0).cast("bigint"))}).drop("_able")


def annotate(records: DataFrame, winners: DataFrame, min_width: int | None) -> DataFrame:
    """records with annotation_status, annotation_reason and the winner's columns; no record is lost.

    records: gt, eligible, window_id, window_sequence. min_width is that of the narrowest model, null without models.
    """
    won = winners.select("window_id", *(F.col(c).alias(f"best_{c}") for c in BEST), "midpoint_distance", "distinct_motif_count")
    # Only carriers in scanned windows can have a winner: others get no key and so no partner, each dealt by its own record.
    able = records.withColumn("_able", F.coalesce(_scannable(min_width), F.lit(False)))
    keyed = able.withColumn("_window", F.when(F.col("_able"), F.col("window_id")).otherwise(F.concat(F.lit("-"), F.col("window_id"), F.lit("-"), F.col("ordinal").cast("string"))))
    return _judged(keyed.join(won.withColumnRenamed("window_id", "_window"), "_window", "left").drop("_window"), min_width)


def annotate_in_place(records: DataFrame, scan: Callable[[DataFrame], DataFrame], min_width: int | None, flank: int) -> DataFrame:
    """annotate without a shuffle, for records that seldom share a window: each record's own window is scanned.

    scan gives rows with a column sequence, null where there is nothing to scan, the array `hits` instead.
    """
    able = records.withColumn("_able", F.coalesce(_scannable(min_width), F.lit(False)))
    won = winner_in_window(scan(able.withColumn("sequence", F.when(F.col("_able"), F.col("window_sequence")))))
    best = won.withColumns({f"best_{c}": F.col("best")[c] for c in BEST}).drop("best")
    return _judged(best.withColumn("midpoint_distance", midpoint(F.col("best_start"), F.col("best_stop"), flank)), min_width)


def annotation_counts(annotated: DataFrame) -> DataFrame:
    return annotated.groupBy("dataset_id", "sample_name", "annotation_status", "annotation_reason").agg(F.count("*").alias("record_count"))


def application_positions(annotated: DataFrame) -> DataFrame:
    """Distinct (dataset, window) of promising records by motif and whole midpoint."""
    once = annotated.where("annotation_status = 'promising'").select("dataset_id", "window_id", F.col("best_motif_id").alias("motif_id"), F.floor("midpoint_distance").cast("int").alias("midpoint_bin")).distinct()
    return once.groupBy("dataset_id", "motif_id", "midpoint_bin").agg(F.count("*").alias("window_count"))
