"""Folds: indivisible contig groups dealt to five folds by length."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FOLDS = 5


def group_of(contig: Column, pattern: str) -> Column:
    """The first capture of the pattern at the start of the name; null where it doesn't match."""
    found = F.regexp_extract(contig, rf"\A(?:{pattern})", 1)
    return F.when(contig.rlike(rf"\A(?:{pattern})"), found)


def longest_first(groups: DataFrame, folds: int = FOLDS) -> DataFrame:
    """(group_id, fold_id): groups (group_id, bp) by falling length, then name, each to the lightest fold, the first of equals.

    The order is sequential by definition, so the totals - one row per group of contigs of a reference - are folded in
    one ordered aggregate.
    """
    ordered = groups.agg(F.array_sort(F.collect_list(F.struct((-F.col("bp")).alias("minus"), "group_id"))).alias("all"))
    start = F.struct(F.array_repeat(F.lit(0).cast("bigint"), folds).alias("load"), F.array().cast("array<struct<group_id:string,fold_id:int>>").alias("out"))

    def step(acc: Column, g: Column) -> Column:
        at = F.array_position(acc["load"], F.array_min(acc["load"])).cast("int")
        load = F.transform(acc["load"], lambda x, i: F.when(i == at - 1, x - g["minus"]).otherwise(x))
        return F.struct(load.alias("load"), F.concat(acc["out"], F.array(F.struct(g["group_id"].alias("group_id"), at.alias("fold_id")))).alias("out"))

    return ordered.select(F.explode(F.aggregate("all", start, step)["out"]).alias("x")).select("x.group_id", "x.fold_id")


def assign_folds(contigs: DataFrame, pattern: str | None = None) -> DataFrame:
    """(contig, length_bp, group_id, fold_id, inclusion_status, reason); unmatched contigs are excluded. Fewer groups than folds are an error."""
    named = contigs.select("contig", F.col("length").alias("length_bp"), (F.col("contig") if pattern is None else group_of(F.col("contig"), pattern)).alias("group_id"))
    deal = longest_first(named.where("group_id is not null").groupBy("group_id").agg(F.sum("length_bp").alias("bp")))
    few = F.raise_error(F.concat(F.lit(f"fewer than {FOLDS} contig groups: "), F.col("groups").cast("string"))).cast("int")
    deal = deal.withColumn("groups", F.count("*").over(Window.partitionBy(F.lit(0)))).withColumn("fold_id", F.when(F.col("groups") >= FOLDS, F.col("fold_id")).otherwise(few)).drop("groups")
    out = named.join(F.broadcast(deal), "group_id", "left")  # as many rows as groups of contigs
    inside = F.col("group_id").isNotNull()
    return out.select("contig", "length_bp", "group_id", "fold_id", F.when(inside, "included").otherwise("excluded").alias("inclusion_status"), F.when(inside, "").otherwise("unmatched_group_regex").alias("reason"))


def fold_balance(assignments: DataFrame, folds: int = FOLDS) -> DataFrame:
    """(fold_id, total_bp, largest_over_smallest), empty folds included."""
    sums = assignments.where("fold_id is not null").groupBy("fold_id").agg(F.sum("length_bp").alias("bp"))
    every = assignments.sparkSession.range(1, folds + 1).select(F.col("id").cast("int").alias("fold_id"))
    dense = every.join(sums, "fold_id", "left").select("fold_id", F.coalesce("bp", F.lit(0)).alias("total_bp"))
    ends = dense.agg(F.max("total_bp").alias("most"), F.min("total_bp").alias("least"))
    return dense.crossJoin(F.broadcast(ends)).select("fold_id", "total_bp", F.when(F.col("least") > 0, F.col("most") / F.col("least")).alias("largest_over_smallest"))


def windows_per_fold(windows: DataFrame, by: list[str], folds: int = FOLDS, counted: Column | None = None) -> DataFrame:
    """Eligible windows of each fold and group, with zeros for folds that have none, in one pass. counted: which windows count; the others still make their group known."""
    own = F.lit(True) if counted is None else counted
    each = F.array(*(F.struct(F.lit(f).alias("fold_id"), F.count_if((F.col("fold_id") == f) & own).alias("n_windows")) for f in range(1, folds + 1)))
    return windows.groupBy(*by).agg(each.alias("folds")).select(*by, F.inline("folds"))


def rotations(windows: DataFrame, folds: int = FOLDS) -> DataFrame:
    """Each window in every rotation: held out (test) in that of its fold, train in the others."""
    return windows.withColumn("rotation", F.explode(F.sequence(F.lit(1), F.lit(folds)))).withColumn("part", F.when(F.col("fold_id") == F.col("rotation"), "test").otherwise("train"))
