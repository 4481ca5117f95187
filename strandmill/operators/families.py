"""Motif similarity, complete-link families, stability, validation and ranking."""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandmill.functions.identity import canonical
from strandmill.functions.rules import safe_div


def passing_edges(matches: DataFrame, q_max: float, min_overlap: int) -> DataFrame:
    """Directed matches (query, target, q, overlap) within the limits; self matches go."""
    return matches.where((F.col("q") <= q_max) & (F.col("overlap") >= min_overlap) & (F.col("query") != F.col("target")))


def reciprocal_edges(matches: DataFrame, q_max: float, min_overlap: int) -> DataFrame:
    """Unordered pairs (a, b) that match in both directions, by one grouped pass instead of a self join."""
    low, high = F.least("query", "target"), F.greatest("query", "target")
    pairs = passing_edges(matches, q_max, min_overlap).select(low.alias("a"), high.alias("b"), (F.col("query") < F.col("target")).alias("up"))
    return pairs.groupBy("a", "b").agg(F.bool_or("up").alias("there"), F.bool_or(~F.col("up")).alias("back")).where("there and back").select("a", "b")


def complete_link(ids: list[str], edges: set[frozenset[str]]) -> list[dict]:
    """Families of a model pool: each id, ascending, joins the first family all of whose members it matches. Sequential; pools are some hundreds."""
    near: dict[str, set[str]] = {i: set() for i in ids}
    for e in edges:
        a, b = tuple(e)
        near[a].add(b)
        near[b].add(a)
    families: list[list[str]] = []
    for i in sorted(ids):
        home = next((f for f in families if near[i].issuperset(f)), None)
        if home is None:
            families.append([i])
        else:
            home.append(i)
    return [{"family_id": "fam_" + hashlib.sha256(canonical(f)).hexdigest()[:16], "members": f} for f in families]


def family_table(ids: DataFrame, edges: DataFrame) -> DataFrame:
    """(family_id, motif_id) of a pool of motif ids and its edges (a, b)."""
    pool = [r[0] for r in ids.select("motif_id").collect()]
    found = complete_link(pool, {frozenset((r["a"], r["b"])) for r in edges.collect()})
    return ids.sparkSession.createDataFrame([(f["family_id"], m) for f in found for m in f["members"]], "family_id string, motif_id string")


#: Bins of a column distance, from 0 to the largest, the root of 2.
BINS = 1000


def binned_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Binned Euclidean distance of every column of a to every column of b."""
    square = np.maximum((a**2).sum(1)[:, None] + (b**2).sum(1)[None] - 2 * a @ b.T, 0.0)
    return np.rint(np.sqrt(square / 2) * BINS).astype(np.int64)


def null_tails(columns: np.ndarray, longest: int) -> list[np.ndarray]:
    """Per overlap up to longest: the exact probability that the binned distances of so many random pairs of columns sum to at most each total."""
    pairs = np.zeros(BINS + 1)
    for at in range(0, len(columns), 256):
        pairs += np.bincount(binned_distances(columns[at : at + 256], columns).ravel(), minlength=BINS + 1)[: BINS + 1]
    pairs /= max(pairs.sum(), 1.0)
    mass, tails = np.ones(1), []
    for _ in range(longest + 1):
        tails.append(np.minimum(np.cumsum(mass), 1.0))
        mass = np.convolve(mass, pairs)
    return tails


def similarity(models: dict[str, np.ndarray], min_overlap: int = 6) -> list[dict]:
    """Directed matches of a pool with Benjamini-Hochberg q-values within each query.

    The null of a summed column distance is exact for independent pairs of the pool's columns, by dynamic programming
    over binned distances. The placement of lowest p on either strand (of those, the longest) is corrected for the
    number of placements.
    """
    columns = np.concatenate(list(models.values())) if models else np.zeros((0, 4))
    tails = null_tails(columns, max(map(len, models.values()), default=0))
    rows = []
    for q in sorted(models):
        tested = []
        for t in sorted(models):
            if q == t:
                continue
            places = []
            for strand, other in (("+", models[t]), ("-", models[t][::-1, ::-1])):
                apart = binned_distances(models[q], other)
                for offset in range(-len(other) + min_overlap, len(models[q]) - min_overlap + 1):
                    # A placement is a diagonal of the column distances.
                    line = apart.diagonal(-offset)
                    if len(line) >= min_overlap:
                        places.append((float(tails[len(line)][line.sum()]), -len(line), strand))
            if not places:
                continue
            p, n, strand = min(places)
            tested.append([float(-np.expm1(len(places) * np.log1p(-p))) if p < 1 else 1.0, t, -n, strand])
        tested.sort()
        q_value = 1.0
        for rank in range(len(tested), 0, -1):
            p, t, n, strand = tested[rank - 1]
            q_value = min(q_value, p * len(tested) / rank)
            rows.append({"query": q, "target": t, "q": q_value, "overlap": n, "strand": strand})
    return rows


def stability(rows: DataFrame, min_rotations: int, require_all: bool = True, configured: DataFrame | None = None) -> DataFrame:
    """Per family: clones, stable clones, fewest supported rotations, and pass. rows: family_id, dataset_id, rotation, support.

    A family passes if all (or any) of its clones are supported in enough rotations. A configured clone (a short table
    with dataset_id) without rows counts as never supported, and rows of other clones, or two of one clone and rotation,
    are an error.
    """
    once = rows.groupBy("family_id", "dataset_id", "rotation").agg(F.max("support").alias("support"), F.count("*").alias("n"))
    repeated = F.raise_error(F.concat_ws(" ", F.lit("repeated support of"), "family_id", F.col("dataset_id").cast("string"), F.col("rotation").cast("string"))).cast("boolean")
    once = once.withColumn("support", F.when(F.col("n") == 1, F.col("support")).otherwise(repeated))
    clones = once.groupBy("family_id", "dataset_id").agg(F.count_if("support").alias("supported"))
    if configured is not None:
        known = F.broadcast(configured.select("dataset_id").distinct())
        every = clones.select("family_id").distinct().crossJoin(known).withColumn("known", F.lit(True))
        joined = every.join(clones, ["family_id", "dataset_id"], "full")
        other = F.raise_error(F.concat_ws(" ", F.lit("clone that isn't configured:"), F.col("dataset_id").cast("string"))).cast("bigint")
        clones = joined.select("family_id", "dataset_id", F.when(F.col("known").isNull(), other).otherwise(F.coalesce("supported", F.lit(0))).alias("supported"))
    clones = clones.withColumn("stable", F.col("supported") >= min_rotations)
    out = clones.groupBy("family_id").agg(F.count("*").alias("clones"), F.count_if("stable").alias("stable_clones"), F.min("supported").alias("min_supported_rotations"), (F.bool_and("stable") if require_all else F.bool_or("stable")).alias("pass"))
    return out


def validate(rows: DataFrame, required: DataFrame) -> DataFrame:
    """Per candidate: passes if every required group has its own support and that of its transfer vote; no group, no pass.

    rows: candidate, group_id, own_support, transfer_support; required: candidate, group_id.
    """
    all_ = required.join(rows, ["candidate", "group_id"], "left")
    good = F.coalesce(F.col("own_support") & F.col("transfer_support"), F.lit(False))
    return all_.groupBy("candidate").agg(F.count("*").alias("groups"), F.bool_and(good).alias("pass"))


def family_statistics(coverage: DataFrame, expected_rows: int) -> DataFrame:
    """Per family and dataset: median ratio and difference with null rows left out, and how many were null or absent."""
    missing = lambda c: (expected_rows - F.count(c)).cast("bigint")
    return coverage.groupBy("family_id", "dataset_id").agg(F.median("coverage_ratio").alias("median_ratio"), F.median("coverage_difference").alias("median_difference"), missing("coverage_ratio").alias("missing_ratio_rows"), missing("coverage_difference").alias("missing_difference_rows"))


def weakest(statistics: DataFrame) -> DataFrame:
    """Per family the least median ratio and difference of its datasets; null if one has none."""
    least = lambda c, name: F.when(F.count(c) == F.count("*"), F.min(c)).alias(name)
    return statistics.groupBy("family_id").agg(least("median_ratio", "weakest_ratio"), least("median_difference", "weakest_difference"))


#: Components of the family rank, most important first; higher is better and null is worst.
RANK_BY = ["stable_clones", "min_supported_rotations", "min_fraction", "weakest_ratio", "pooled_ratio", "weakest_difference", "mean_coverage"]


def rank_families(components: DataFrame) -> DataFrame:
    """components with rank, ties by family_id. Families are some hundreds: one ordered partition."""
    order = Window.orderBy(*(F.desc_nulls_last(c) for c in RANK_BY), F.asc("family_id"))
    return components.withColumn("rank", F.row_number().over(order))


def best_representative(candidates: DataFrame) -> DataFrame:
    """The first candidate of each family: highest least ratio, median ratio, least difference and source coverage, then lowest evalue and id."""
    key = F.struct(*((-F.col(c)).alias(c) for c in ("min_ratio", "median_ratio", "min_difference", "source_coverage")), "evalue", "motif_id")
    return candidates.groupBy("family_id").agg(F.min_by("motif_id", key).alias("representative"))


def support_fraction(supporting: Column, configured: Column) -> Column:
    return safe_div(supporting, configured)
