"""From variant calls to annotations and consensus: the stages as functions over DataFrames.

prepare -> discover -> transfer -> select -> apply -> consensus. Datasets, rotations and kinds are columns or short
driver loops over configured samples; each stage's tables can be written and read again between calls.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandmill.functions.genotype import alts_of, parse_gt
from strandmill.functions.identity import dataset_id, seed_table
from strandmill.functions.rules import ceil_float, supported
from strandmill.operators import consensus as C
from strandmill.operators import evidence as E
from strandmill.operators import families as M
from strandmill.operators.alleles import explode_alleles, normalise
from strandmill.operators.annotate import annotate, checked_hits, window_winners
from strandmill.operators.context import add_windows, scan_windows
from strandmill.operators.discover import discover
from strandmill.operators.folds import assign_folds
from strandmill.operators.scan import Pwm, pwm_hits
from strandmill.operators.shuffle import shuffled
from strandmill.plans.config import Config
from strandmill.sources.text import read_fasta
from strandmill.sources.vcf import read_vcf, sample_records


@dataclass(frozen=True)
class Model:
    """A discovered motif with where it comes from."""

    motif_id: str
    sample: str
    rotation: int
    evalue: float
    pwm: Pwm


def load_contigs(spark: SparkSession, fasta: str) -> DataFrame:
    """(ord, contig, sequence, length); repeated names are an error."""
    c = read_fasta(spark, fasta).select("ord", F.col("name").alias("contig"), "sequence", F.length("sequence").cast("bigint").alias("length"))
    if repeated := [r[0] for r in c.groupBy("contig").count().where("count > 1").limit(5).collect()]:
        raise ValueError(f"repeated contigs: {repeated}")
    return c


def prepare(spark: SparkSession, contigs: DataFrame, vcf_path: str, role: str, names: list[str], config: Config, reference: str) -> DataFrame:
    """Genotype records of the samples with windows and folds. A malformed genotype, a REF that differs or a letter that no sequence has raises."""
    vcf = read_vcf(spark, vcf_path, required=names)
    r = sample_records(vcf, names).select("ordinal", "sample_name", F.col("CHROM").alias("contig"), F.col("POS").alias("pos"), F.col("ID").alias("id"), F.col("REF").alias("ref"), F.col("ALT").alias("alt"), F.col("GT").alias("gt"))
    parsed = parse_gt(F.col("gt"), F.size(alts_of(F.col("alt"))))
    r = r.withColumn("gt_status", F.when(parsed.isNull(), F.raise_error(F.concat(F.lit("malformed GT "), "gt"))).otherwise(parsed["gt_status"]))
    r = add_windows(r, contigs, config.flank_bp, reference)
    r = r.withColumn("ref", F.when(F.col("ref_agrees"), F.col("ref")).otherwise(F.raise_error(F.concat(F.lit("REF differs at "), "contig", F.lit(":"), F.col("pos").cast("string")))))
    # The letters of a reference sequence, bases and ambiguity codes.
    foreign = F.raise_error(F.concat(F.lit("foreign letters in the window at "), "contig", F.lit(":"), F.col("pos").cast("string")))
    r = r.withColumn("window_sequence", F.when(F.col("window_sequence").rlike("[^ACGTRYSWKMBDHVN]"), foreign).otherwise(F.col("window_sequence")))
    folds = assign_folds(contigs, config.grouping_regex).select("contig", "fold_id", F.col("inclusion_status").alias("fold_status"))
    if config.unmatched == "error" and config.grouping_regex and not folds.where("fold_id is null").isEmpty():
        raise ValueError("contigs that no group matches")
    return r.join(folds, "contig", "left").withColumns({"role": F.lit(role), "dataset_id": dataset_id(F.lit(role), F.col("sample_name"))})


def seeds(config: Config) -> dict[tuple[str, int, str], int]:
    """By (sample, rotation, role)."""
    platforms = {"pacbio": list(config.pacbio_samples), "illumina": [m for v in config.corresponding.values() for m in v]}
    rows = seed_table(config.base_seed, platforms, list(config.rotations), {"pacbio": ["train_shuffle", "test_shuffle", "streme"], "illumina": ["test_shuffle"]}, config.explicit_seeds())
    return {(r["sample_name"], r["rotation"], r["role"]): r["seed"] for r in rows}


def discover_models(records: DataFrame, config: Config, motifs: int | None = None) -> list[Model]:
    """All motifs below e_max (or the first `motifs`) of every pacbio sample and rotation, from the windows outside the held-out fold."""
    windows, seed, out = scan_windows(records, ["sample_name", "fold_id"]), seeds(config), []
    for sample in config.pacbio_samples:
        for rotation in config.rotations:
            train = windows.where((F.col("sample_name") == sample) & (F.col("fold_id") != rotation)).select("window_id", "sequence")
            control = shuffled(train, config.shuffle_kmer, seed[sample, rotation, "train_shuffle"])
            both = train.withColumn("is_control", F.lit(False)).unionByName(control.withColumn("is_control", F.lit(True)))
            for k, (pwm, evalue) in enumerate(discover(both, range(config.min_width, config.max_width + 1), motifs, config.e_max), 1):
                name = f"{sample}__r{rotation:02d}__m{k:04d}"
                out.append(Model(name, sample, rotation, evalue, Pwm(name, pwm.matrix, pwm.nsites)))
    return out


Letters = tuple[float, ...]
UNIFORM: Letters = (0.25, 0.25, 0.25, 0.25)


def evaluation(records: DataFrame, models: list[Model], config: Config, background: Letters = UNIFORM) -> tuple[DataFrame, DataFrame]:
    """(best, totals) of every model on every sample's held-out fold of the model's rotation.

    best: kind, motif_id, sample_name, rotation, window_id and the best hit; totals: sample_name, rotation, n_windows. Each
    distinct window is scanned once with all models; controls are shuffled by the test seed of sample and rotation, so each
    has its own.
    """
    spark = records.sparkSession
    windows = scan_windows(records.where("fold_id is not null"), ["sample_name", "fold_id"]).withColumnRenamed("fold_id", "rotation")
    known = [(s, r, n) for (s, r, role), n in seeds(config).items() if role == "test_shuffle"]
    seed = spark.createDataFrame(known, "sample_name string, rotation int, seed long")  # a configured list
    missing = F.raise_error(F.concat(F.lit("no test seed for "), "sample_name")).cast("bigint")
    windows = windows.join(F.broadcast(seed), ["sample_name", "rotation"], "left").withColumn("seed", F.coalesce("seed", missing))
    pwms, place = [m.pwm for m in models], F.concat_ws("|", "rotation", "window_id", "sample_name")
    table = F.broadcast(spark.createDataFrame([(m.motif_id, m.rotation) for m in models], "motif_id string, rotation int"))
    real = E.best_hits(pwm_hits(windows.select("window_id", "sequence").dropDuplicates(["window_id"]), pwms, background, config.p_threshold), ["motif_id", "window_id"], "positional")
    real = real.join(table, "motif_id").join(windows.select("window_id", "sample_name", "rotation"), ["window_id", "rotation"])
    control = E.best_hits(pwm_hits(shuffled(windows.withColumn("window_id", place), config.shuffle_kmer, "seed"), pwms, background, config.p_threshold), ["motif_id", "window_id"], "positional")
    part = F.split("window_id", r"\|", 3)
    control = control.withColumns({"at": part[0].cast("int"), "sample_name": part[2], "window_id": part[1]}).join(table, "motif_id").where("at = rotation")
    columns = ["motif_id", "sample_name", "rotation", "window_id", "start", "stop", "strand", "score", "p"]
    best = real.select(F.lit("real").alias("kind"), *columns).unionByName(control.select(F.lit("control").alias("kind"), *columns))
    return best, windows.groupBy("sample_name", "rotation").agg(F.count("*").alias("n_windows"))


def model_metrics(best: DataFrame, totals: DataFrame, models: list[Model], config: Config) -> DataFrame:
    """Enrichment of every model on every sample's held-out fold of the model's rotation."""
    table = F.broadcast(best.sparkSession.createDataFrame([(m.motif_id, m.rotation) for m in models], "motif_id string, rotation int"))
    return E.metrics(best, totals.join(table, "rotation"), ["sample_name", "rotation", "motif_id"], config.flank_bp, config.center_radius_bp)


def evaluate(records: DataFrame, models: list[Model], config: Config, background: Letters = UNIFORM) -> DataFrame:
    return model_metrics(*evaluation(records, models, config, background), models, config)


def transferable(metrics: DataFrame, models: list[Model], config: Config) -> list[Model]:
    """Models supported on their own held-out fold and, by vote, on their corresponding samples."""
    m = metrics.withColumns({"own": supported(F.col("coverage_ratio"), F.col("coverage_difference"), F.col("central_difference"), config.pacbio_ratio_min, config.require_central), "support": supported(F.col("coverage_ratio"), F.col("coverage_difference"), F.col("central_difference"), config.illumina_ratio_min, config.require_central)})
    spark = metrics.sparkSession
    link = spark.createDataFrame([(x.motif_id, s, len(config.corresponding[x.sample])) for x in models for s in config.corresponding[x.sample]], "motif_id string, sample_name string, n long")
    votes = E.vote(m.join(F.broadcast(link), ["motif_id", "sample_name"]), ["motif_id", "n"], F.col("n"), ceil_float(config.support_fraction, F.col("n"))).where("pass")
    passed = {r[0] for r in votes.select("motif_id").collect()}
    source = spark.createDataFrame([(x.motif_id, x.sample) for x in models], "motif_id string, sample_name string")
    own = {r[0] for r in m.join(F.broadcast(source), ["motif_id", "sample_name"]).where("own").select("motif_id").collect()}
    return [x for x in models if x.motif_id in passed & own and x.evalue < config.e_max]


def group_support(rows: DataFrame, by: list[str], config: Config) -> DataFrame:
    """Per by and group_id: own_support, transfer_support and the votes. rows: by, group_id, sample_name, own, configured, support; a sample is supported by any of its rows."""
    each = rows.groupBy(*by, "group_id", "sample_name", "own", "configured").agg(F.bool_or("support").alias("support"))
    votes = E.vote(each.where(~F.col("own")), [*by, "group_id", "configured"], F.col("configured"), ceil_float(config.support_fraction, F.col("configured")))
    own = each.where("own").select(*by, "group_id", F.col("support").alias("own_support"))
    return own.join(votes.select(*by, "group_id", F.col("pass").alias("transfer_support"), "supporting_count", "configured_count"), [*by, "group_id"], "left")


def model_families(models: list[Model], config: Config) -> list[dict]:
    """Complete-link families of the models: family_id and members."""
    import numpy as np

    rows = M.similarity({m.motif_id: np.array(m.pwm.matrix) for m in models}, config.min_overlap_bp)
    passing = {(r["query"], r["target"]) for r in rows if r["q"] <= config.q_max and r["overlap"] >= config.min_overlap_bp}
    return M.complete_link([m.motif_id for m in models], {frozenset(p) for p in passing if p[::-1] in passing})


def _gate(config: Config, own: Column) -> Column:
    by = [supported(F.col("coverage_ratio"), F.col("coverage_difference"), F.col("central_difference"), low, config.require_central) for low in (config.pacbio_ratio_min, config.illumina_ratio_min)]
    return F.when(own, by[0]).otherwise(by[1])


def _links(spark: SparkSession, config: Config) -> DataFrame:
    return F.broadcast(spark.createDataFrame([(p, s, s == p, len(c)) for p, c in config.corresponding.items() for s in (p, *c)], "group_id string, sample_name string, own boolean, configured long"))


def family_coverage(families: list[dict], models: list[Model], best: DataFrame, totals: DataFrame, config: Config) -> DataFrame:
    """Enrichment of every family in every group, rotation and sample: family_id, group_id, rotation, sample_name, own,
    configured, members, the metrics and support.

    A window's hit is the best of all members that the group's pacbio sample gave in that rotation (lowest p first). Without
    such members there are no hits and no support, but the rows are there.
    """
    spark, by_id = best.sparkSession, {m.motif_id: m for m in models}
    of = spark.createDataFrame([(f["family_id"], i, by_id[i].sample, by_id[i].rotation) for f in families for i in f["members"]], "family_id string, motif_id string, group_id string, rotation int")
    names = spark.createDataFrame([(f["family_id"],) for f in families], "family_id string")
    link = _links(spark, config)
    hits = best.join(F.broadcast(of), ["motif_id", "rotation"]).join(link.select("group_id", "sample_name"), ["group_id", "sample_name"])
    by = ["family_id", "group_id", "rotation", "sample_name"]
    union = E.best_hits(hits, ["kind", *by, "window_id"], "union")
    size = of.groupBy("family_id", "group_id", "rotation").agg(F.count("*").alias("members"))
    # Configured names only: families, rotations, samples.
    grid = link.withColumn("rotation", F.explode(F.array(*map(F.lit, config.rotations)))).crossJoin(F.broadcast(names))
    grid = grid.join(totals, ["sample_name", "rotation"], "left").fillna(0, ["n_windows"])
    metric = E.metrics(union, grid.select(*by, "n_windows"), by, config.flank_bp, config.center_radius_bp)
    out = metric.join(link, ["group_id", "sample_name"]).join(F.broadcast(size), ["family_id", "group_id", "rotation"], "left").fillna(0, ["members"])
    return out.withColumn("support", (F.col("members") > 0) & _gate(config, F.col("own")))


def family_components(coverage: DataFrame, config: Config) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(groups, required, components) from family_coverage's rows.

    groups: family_id, group_id, rotation, support (the pacbio sample's own and the vote of the others) and the vote;
    required: (family_id, group_id) that a representative must hold in, of families that pass; components: what families
    are ranked by. Medians leave null rows out, and are over the rotations of the required groups' samples; a sample without
    any ratio makes the family's weakest one null, which ranks last.
    """
    groups = group_support(coverage, ["family_id", "rotation"], config).withColumn("support", F.coalesce(F.col("own_support") & F.col("transfer_support"), F.lit(False)))
    stable = M.stability(groups.withColumnRenamed("group_id", "dataset_id"), config.min_supported_rotations, config.require_all_clones).where("pass")
    counts = groups.groupBy("family_id", "group_id").agg(F.count_if("support").alias("supported"))
    required = counts.where(F.lit(config.require_all_clones) | (F.col("supported") >= config.min_supported_rotations)).join(stable.select("family_id"), "family_id")
    fewest = required.groupBy("family_id").agg(F.min("supported").alias("min_supported_rotations"))
    fraction = groups.where("support").groupBy("family_id").agg(F.min(M.support_fraction(F.col("supporting_count"), F.col("configured_count"))).alias("min_fraction"))
    used = coverage.join(required.select("family_id", "group_id"), ["family_id", "group_id"]).withColumnRenamed("sample_name", "dataset_id")
    pooled = used.groupBy("family_id").agg(F.median("coverage_ratio").alias("pooled_ratio"), F.avg("real_coverage").alias("mean_coverage"))
    each = M.weakest(M.family_statistics(used, len(config.rotations)))
    return groups, required.select("family_id", "group_id"), stable.drop("min_supported_rotations").join(fewest, "family_id").join(fraction, "family_id", "left").fillna(0.0, ["min_fraction"]).join(each, "family_id").join(pooled, "family_id")


def select_library(models: list[Model], metrics: DataFrame, families: list[dict], coverage: DataFrame, config: Config) -> list[tuple[Model, str, int]]:
    """(representative, family, rank) of families supported in enough rotations, ranked by their weakest evidence.

    A group is a pacbio sample with its corresponding samples; a family's support there and in a rotation is that of the
    union of its members' hits (coverage). Only a member that contributes to a supported group and whose own matrix is
    supported, on the held-out fold of its rotation, in every required group (all of them, or the stable ones) can represent
    its family; a family without one is left out.
    """
    by_id = {m.motif_id: m for m in models}
    spark = metrics.sparkSession
    # A row for each model and sample, or family, sample and rotation: read once, as the plans below use them often.
    metrics, coverage = (spark.createDataFrame(x.collect(), x.schema) for x in (metrics, coverage))
    groups, required, components = family_components(coverage, config)
    of = F.broadcast(spark.createDataFrame([(f["family_id"], i, by_id[i].sample, by_id[i].rotation, by_id[i].evalue) for f in families for i in f["members"]], "family_id string, motif_id string, source string, rotation int, evalue double"))
    scored = metrics.join(of, ["motif_id", "rotation"]).join(_links(spark, config), "sample_name").withColumn("support", _gate(config, F.col("own")))
    contributing = groups.where("support").join(required, ["family_id", "group_id"]).select("family_id", F.col("group_id").alias("source"), "rotation")
    candidates = of.join(contributing, ["family_id", "source", "rotation"]).select("family_id", F.col("motif_id").alias("candidate"))
    exact = group_support(scored, ["motif_id"], config).withColumnRenamed("motif_id", "candidate")
    valid = M.validate(exact, candidates.join(required, "family_id").select("candidate", "group_id")).where("pass").select(F.col("candidate").alias("motif_id"))
    used = scored.join(valid, "motif_id").join(required, ["family_id", "group_id"]).where("own or support")
    least = used.groupBy("family_id", "motif_id", "evalue").agg(F.min("coverage_ratio").alias("min_ratio"), F.median("coverage_ratio").alias("median_ratio"), F.min("coverage_difference").alias("min_difference"), F.max(F.when(F.col("sample_name") == F.col("source"), F.col("real_coverage"))).alias("source_coverage"))
    selected = components.join(M.best_representative(least), "family_id")
    return [(by_id[r["representative"]], r["family_id"], r["rank"]) for r in M.rank_families(selected).orderBy("rank").collect()]


def apply_library(records: DataFrame, library: list[tuple[Pwm, str, int]], config: Config, background: Letters = UNIFORM) -> DataFrame:
    """Every record annotated with the frozen library (matrix, family, rank): each distinct window is scanned once."""
    spark = records.sparkSession
    ranks = spark.createDataFrame([(p.motif_id, f, r) for p, f, r in library] or [], "motif_id string, family_id string, rank int")
    windows = scan_windows(records).select("window_id", "sequence")
    hits = pwm_hits(windows, [p for p, *_ in library], background, config.p_threshold)
    hits = checked_hits(hits.withColumnRenamed("matched_sequence", "matched"), ranks, windows)
    winners = window_winners(hits, config.flank_bp)
    return annotate(records, winners, min((len(p.matrix) for p, *_ in library), default=None))


def group_consensus(annotated: DataFrame, contigs: DataFrame, members: DataFrame, required: int) -> tuple[DataFrame, DataFrame]:
    """(support per site, member matrix) of one group: members is (group_id, dataset_id, sample_name, member_ord)."""
    own = annotated.join(F.broadcast(members.select("group_id", "dataset_id")), "dataset_id")
    alleles = normalise(explode_alleles(own), contigs)
    seen = C.observe(C.called(C.record_arrays(alleles)).join(F.broadcast(members.select("group_id", "dataset_id")), "dataset_id"))
    matrix = C.member_matrix(C.candidates(seen), members, C.resolve(seen, ["group_id", "dataset_id", *C.SITE]))
    return C.group_support(matrix, F.lit(required)), matrix
