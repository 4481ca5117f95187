"""Best hits, enrichment of real over control windows, gates and votes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandmill.functions.rules import coverage_ratio, is_central, is_exact_center, midpoint, safe_div, strand_order, supported


def _keys(kind: str, of: Callable[[str], Column] = F.col) -> list[Column]:
    """positional: highest score first; union: lowest p, then motif; winner: lowest p, then library rank."""
    score, p, start, stop, strand = -of("score"), of("p"), of("start"), of("stop"), strand_order(of("strand"))
    return {"positional": [score, p, start, stop, strand], "union": [p, of("motif_id"), score, start, stop, strand], "winner": [p, of("rank"), score, start, stop, strand]}[kind]


def best_hits(hits: DataFrame, by: list[str], kind: str, sums: dict[str, Column] | None = None) -> DataFrame:
    """The first hit of each group in the order of that kind; min_by combines on the map side, so hot windows don't gather. sums: columns that tell of the whole group."""
    sums = sums or {}
    rest = [c for c in hits.columns if c not in by and c not in sums]
    key = F.struct(*(k.alias(f"k{i}") for i, k in enumerate(_keys(kind))))
    best = hits.groupBy(*by).agg(F.min_by(F.struct(*rest), key).alias("best"), *(c.alias(n) for n, c in sums.items()))
    return best.select(*by, *(F.col(f"best.{c}").alias(c) for c in rest), *sums)


def _keyed(kind: str, by: str | None = None) -> Column:
    own = lambda h: [h[by].alias("group")] if by else []
    return F.transform("hits", lambda h: F.struct(*own(h), *(k.alias(f"k{i}") for i, k in enumerate(_keys(kind, lambda c: h[c]))), h.alias("hit")))


def best_in_window(windows: DataFrame, by: str, kind: str) -> DataFrame:
    """windows with the array `hits` reduced to the first of each value of `by` in the order of that kind: best_hits where a window is one row."""
    # A column of its own: sorted once a row, not once for each comparison; by a plain order, as array_sort evaluates a lambda for each comparison.
    ordered = windows.withColumn("_ordered", F.sort_array(_keyed(kind, by)))
    first = F.filter("_ordered", lambda x, i: (i == 0) | (x["group"] != F.get("_ordered", i - 1)["group"]))
    return ordered.withColumn("hits", F.transform(first, lambda x: x["hit"])).drop("_ordered")


def winner_in_window(windows: DataFrame) -> DataFrame:
    """windows with `best`, the winning one of `hits` (null without hits), and the number of distinct motifs, instead of hits."""
    count = F.size(F.array_distinct("hits.motif_id")).cast("bigint")
    return windows.withColumns({"best": F.array_min(_keyed("winner"))["hit"], "distinct_motif_count": count}).drop("hits")


def metrics(best: DataFrame, totals: DataFrame, by: list[str], flank: int, radius: int) -> DataFrame:
    """Enrichment by group: best holds kind (real or control), start and stop; totals holds the windows scanned of each group, hit or not.

    Groups without hits have zeros and null proportions; without windows, null coverages.
    """
    counts = best.groupBy(*by).agg(*_counts(flank, radius))
    return _proportions(totals.join(counts, by, "left").fillna(0, COUNTS), by)


def scanned_metrics(best: DataFrame, models: DataFrame, by: list[str], flank: int, radius: int) -> DataFrame:
    """metrics by `by` and motif_id of one pass over windows: best has a row for each window and kind (real and control), with its best hits as the array `hits`, empty without any.

    models: motif_id, a row each; every group has every model. A map holds at most as many entries as the library has motifs.
    """
    window = F.struct(F.lit(None).cast("string").alias("motif_id"), F.lit(None).cast("int").alias("start"), F.lit(None).cast("int").alias("stop"))
    each = F.concat(F.array(window), F.transform("hits", lambda h: F.struct(h["motif_id"].alias("motif_id"), h["start"].alias("start"), h["stop"].alias("stop"))))
    rows = best.select(*by, "kind", F.explode_outer(each).alias("hit")).select(*by, "kind", "hit.*")
    counts = rows.groupBy(*by, "motif_id").agg(*_counts(flank, radius))
    scanned = F.col("motif_id").isNull()
    own = F.collect_list(F.when(~scanned, F.struct("motif_id", F.struct(*COUNTS))))
    groups = counts.groupBy(*by).agg(F.max(F.when(scanned, F.col("real_hits"))).alias("n_windows"), F.map_from_entries(own).alias("own"))
    dense = groups.crossJoin(F.broadcast(models.select("motif_id"))).withColumn("own", F.try_element_at("own", F.col("motif_id")))
    return _proportions(dense.select(*by, "motif_id", "n_windows", *(F.coalesce(F.col("own")[c], F.lit(0)).alias(c) for c in COUNTS)), [*by, "motif_id"])


COUNTS = ["real_hits", "control_hits", "rc", "cc", "re", "ce"]


def _counts(flank: int, radius: int) -> list[Column]:
    real, control = F.col("kind") == "real", F.col("kind") == "control"
    central, exact = is_central(F.col("start"), F.col("stop"), flank, radius), is_exact_center(F.col("start"), F.col("stop"), flank)
    return [F.count_if(c).alias(n) for n, c in zip(COUNTS, (real, control, real & central, control & central, real & exact, control & exact), strict=True)]


def _proportions(out: DataFrame, by: list[str]) -> DataFrame:
    n, r, c = F.col("n_windows"), F.col("real_hits"), F.col("control_hits")
    rp, cp = safe_div(F.col("rc"), r), safe_div(F.col("cc"), c)
    return out.select(
        *by, n, r, c, safe_div(r, n).alias("real_coverage"), safe_div(c, n).alias("control_coverage"), (safe_div(r, n) - safe_div(c, n)).alias("coverage_difference"), coverage_ratio(r, c, n).alias("coverage_ratio"),
        safe_div(F.col("rc"), n).alias("real_central_coverage"), safe_div(F.col("cc"), n).alias("control_central_coverage"), safe_div(F.col("re"), n).alias("real_exact_center_coverage"), safe_div(F.col("ce"), n).alias("control_exact_center_coverage"),
        rp.alias("real_central_proportion"), cp.alias("control_central_proportion"), (rp - cp).alias("central_difference"), F.when(n > 0, "complete").otherwise("insufficient_evaluation_windows").alias("status"),
    )


def candidate_gate(models: DataFrame, metric: DataFrame, ratio_min: float, central: bool, e_max: float) -> DataFrame:
    """Every model with eligible and reason; a model without a metric row is an error."""
    joined = models.join(metric, "motif_id", "left")
    ok = supported(F.col("coverage_ratio"), F.col("coverage_difference"), F.col("central_difference"), ratio_min, central, F.col("evalue"), e_max)
    checked = F.when(F.col("n_windows").isNull(), F.raise_error(F.concat(F.lit("no metrics for "), "motif_id")).cast("boolean")).otherwise(ok)
    return joined.select("motif_id", checked.alias("eligible")).join(models.select("motif_id", "evalue"), "motif_id").select("motif_id", "eligible", F.when(F.col("eligible"), "accepted").when(F.col("evalue").isNull(), "unavailable_evalue").otherwise("heldout_support_or_evalue_failed").alias("reason"))


def vote(rows: DataFrame, by: list[str], configured: Column, required: Column) -> DataFrame:
    """rows with a boolean column support: passes if all configured rows are there and enough support."""
    out = rows.groupBy(*by).agg(F.count_if("support").alias("supporting_count"), F.count("*").alias("n_rows"))
    out = out.withColumns({"configured_count": configured.cast("bigint"), "required_count": required.cast("bigint")})
    return out.withColumn("pass", (F.col("n_rows") == F.col("configured_count")) & (F.col("supporting_count") >= F.col("required_count"))).drop("n_rows")


def position_histogram(best: DataFrame, by: list[str], flank: int) -> DataFrame:
    """Share of real and control best hits at each whole midpoint from -flank to flank; null where a kind has none."""
    bins = best.groupBy(*by, F.floor(midpoint(F.col("start"), F.col("stop"), flank)).cast("int").alias("midpoint_bin")).agg(F.count_if(F.col("kind") == "real").alias("real"), F.count_if(F.col("kind") == "control").alias("control"))
    # At most 2 * flank + 1 bins a group travel in one map.
    totals = bins.groupBy(*by).agg(F.sum("real").alias("real_hit_windows"), F.sum("control").alias("control_hit_windows"), F.map_from_entries(F.collect_list(F.struct("midpoint_bin", F.struct("real", "control")))).alias("bins"))
    dense = totals.withColumn("midpoint_bin", F.explode(F.sequence(F.lit(-flank), F.lit(flank)))).withColumn("own", F.try_element_at("bins", F.col("midpoint_bin")))
    out = dense.withColumns({"real": F.col("own")["real"], "control": F.col("own")["control"]})
    r, c = (safe_div(F.coalesce(F.col(k), F.lit(0)), F.col(f"{k}_hit_windows")) for k in ("real", "control"))
    return out.select(*by, "midpoint_bin", r.alias("real_conditional_proportion"), c.alias("control_conditional_proportion"), (r - c).alias("conditional_difference"), "real_hit_windows", "control_hit_windows")


def mark_loci(rows: DataFrame, loci: DataFrame, on: list[str], name: str) -> DataFrame:
    """rows with a boolean: is their locus among the distinct loci."""
    return rows.join(loci.select(*on).distinct().withColumn(name, F.lit(True)), on, "left").withColumn(name, F.coalesce(name, F.lit(False)))
