"""From files to annotated calls, exports and consensus in one call, each set of files published whole.

    python -m strandmill.plans.run --reference r.fa --pacbio p.vcf --illumina i.vcf --config settings.json --out folder

folder/library holds the frozen motifs, folder/vcf_outputs a folder for every data set and, under groups, for every
consensus group; outputs.complete.json there is written last. A library whose inputs and settings are the same is used
again, so other external samples or groups don't repeat the discovery. Tables between the steps are Parquet in the
folder that spark.checkpoint.dir names; the driver holds configured names, the contig list and the motifs.
"""

from __future__ import annotations

import argparse
import hashlib
import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandmill.operators import consensus as C
from strandmill.operators.alleles import explode_alleles, normalise
from strandmill.operators.scan import Pwm
from strandmill.operators.stored import Stored
from strandmill.plans import workflow as W
from strandmill.plans.config import Config
from strandmill.plans.freeze import Stale, file_hash, freeze, signature, verify_freeze
from strandmill.plans.group_outputs import Group, write_group
from strandmill.plans.identity_checks import check_identities, evidence_context, group_plan
from strandmill.plans.publish import publish, publish_all, published, range_hashes, staging
from strandmill.sources import ordered
from strandmill.sources.export import write_bytes
from strandmill.sources.motifs import Motif, background, format_meme, parse_meme
from strandmill.sources.vcf import read_vcf

Library = list[tuple[Pwm, str, int]]

#: Columns of the annotation table.
ANNOTATION = ["dataset_id", "role", "sample_name", "source_record_index", "record_id", "CHROM", "POS", "ID", "REF", "ALT", "GT", "window_id", "interval_start", "interval_end", "fold_id", "annotation_status", "annotation_reason", "best_final_motif_id", "best_family_id", "reported_p_value", "local_start", "local_stop", "local_strand", "matched_sequence", "midpoint_distance", "distinct_motif_count"]
_NAMES = {"ordinal": "source_record_index", "contig": "CHROM", "pos": "POS", "id": "ID", "ref": "REF", "alt": "ALT", "gt": "GT", "best_motif_id": "best_final_motif_id", "best_p": "reported_p_value", "best_start": "local_start", "best_stop": "local_stop", "best_strand": "local_strand", "best_matched": "matched_sequence"}


@dataclass(frozen=True)
class Inputs:
    """Paths; clones gives clone ids of all samples, where they are known."""

    reference: str
    pacbio: str
    illumina: str
    external: str | None = None
    external_samples: tuple[str, ...] = ()
    clones: dict[str, str] | None = None

    def roles(self, config: Config) -> list[tuple[str, str, list[str]]]:
        """(role, calls, samples)."""
        out = [("pacbio", self.pacbio, list(config.pacbio_samples)), ("illumina", self.illumina, [m for v in config.corresponding.values() for m in v])]
        if bool(self.external) != bool(self.external_samples):
            raise ValueError("external calls need their sample names, and names their calls")
        return [*out, ("other_illumina", self.external, list(self.external_samples))] if self.external else out


def dataset(role: str, name: str) -> str:
    return f"{role}_{hashlib.sha256(name.encode()).hexdigest()[:16]}"


def frozen_library(spark: SparkSession, folder: str, letters: tuple[float, ...], inputs: dict[str, str], config: Config, select) -> Library:
    """The folder's library if it is whole and has these inputs and settings; else that of select(), written and frozen."""
    parameters = config.scientific()
    try:
        fresh = published(spark, folder)["signature"] == signature(inputs, parameters)
    except Stale:
        fresh = False
    if not fresh:
        os.makedirs(folder, exist_ok=True)
        chosen = select()
        with staging(folder) as at:
            motifs = [Motif(m.motif_id, len(m.pwm.matrix), repr(float(m.pwm.nsites)), float(m.evalue), tuple(tuple(repr(float(x)) for x in row) for row in m.pwm.matrix)) for m, _, _ in chosen]
            write_bytes(os.path.join(at, "library.meme"), format_meme(motifs, letters).encode())
            ranks = ["motif_id\tfamily_id\trank", *(f"{m.motif_id}\t{f}\t{r}" for m, f, r in chosen)]
            write_bytes(os.path.join(at, "ranks.tsv"), ("\n".join(ranks) + "\n").encode())
            freeze(at, ["library.meme", "ranks.tsv"], parameters)
            publish(spark, at, folder, ["library.meme", "ranks.tsv", "freeze.json"], inputs, parameters, {"motifs": len(chosen)})
    verify_freeze(folder, parameters)
    with open(os.path.join(folder, "library.meme")) as f:
        pwms = {m.motif_id: m.pwm() for m in parse_meme(f.read())}
    with open(os.path.join(folder, "ranks.tsv")) as f:
        rows = [x.rstrip("\n").split("\t") for x in f][1:]
    if sorted(pwms) != sorted(m for m, *_ in rows):
        raise Stale("motifs and ranks differ")
    return [(pwms[m], family, int(rank)) for m, family, rank in rows]


def select(pacbio: DataFrame, illumina: DataFrame, config: Config, letters: tuple[float, ...]) -> list[tuple[W.Model, str, int]]:
    """Representatives with family and rank, from the records of the samples that select."""
    models = W.discover_models(pacbio.where("fold_id is not null"), config)
    if not models:
        return []
    best, totals = (Stored(x, "evaluation") for x in W.evaluation(pacbio.unionByName(illumina), models, config, letters))
    metrics = Stored(W.model_metrics(best.table, totals.table, models, config), "metrics")
    kept = W.transferable(metrics.table, models, config)
    if not kept:
        return []
    families = W.model_families(kept, config)
    out = W.select_library(kept, metrics.table, families, W.family_coverage(families, kept, best.table, totals.table, config), config)
    for table in (best, totals, metrics):
        table.drop()
    return out


def write_dataset(annotated: DataFrame, calls: str, role: str, sample: str, source_hash: str, freeze_hash: str, folder: str, inputs: dict[str, str], partitions: int | None = None) -> dict:
    """annotations.tsv.gz of a sample's records in file order, and promising.vcf.gz with its index: the promising records as they were."""
    spark, names = annotated.sparkSession, ["annotations.tsv.gz", "promising.vcf.gz", "promising.vcf.gz.csi"]
    own = annotated.where(F.col("sample_name") == sample)
    vcf = read_vcf(spark, calls, required=[sample])
    os.makedirs(folder, exist_ok=True)
    with staging(folder) as at:
        record = F.concat_ws("_", "dataset_id", F.lit(source_hash), F.col("ordinal").cast("string"))
        ordered.write_tsv(own.withColumn("record_id", record).withColumnsRenamed(_NAMES), os.path.join(at, names[0]), ANNOTATION, ["source_record_index"], partitions)
        kept = vcf.records.select("ordinal", "raw").join(own.where("annotation_status = 'promising'").select("ordinal"), "ordinal", "left_semi")
        ordered.write_promising_vcf(vcf.header, sample, vcf.samples.index(sample), kept, os.path.join(at, names[1]), partitions=partitions)
        return publish(spark, at, folder, names, inputs, {}, {"dataset_id": dataset(role, sample), "role": role, "sample_name": sample, "source_sha256": source_hash, "freeze_sha256": freeze_hash})


def run(spark: SparkSession, inputs: Inputs, config: Config, folder: str, partitions: int | None = None) -> dict:
    """Everything, and the record of the whole."""
    roles = inputs.roles(config)
    chosen = [s for role, _, names in roles for s in names if role != "other_illumina"]
    status = check_identities(chosen, list(inputs.external_samples), inputs.clones) if inputs.external else "header_names_only"
    known = {s: role for role, _, names in roles for s in names}
    plan = group_plan(dict(config.groups), known, config.consensus_fraction)
    hashes = range_hashes(spark, sorted({inputs.reference, *(path for _, path, _ in roles)}))
    contigs = Stored(W.load_contigs(spark, inputs.reference), "contigs")
    lengths = {r["contig"]: r["length"] for r in contigs.table.select("ord", "contig", "length").orderBy("ord").collect()}
    letters = background(contigs.table)
    records = {role: Stored(W.prepare(spark, contigs.table, path, role, names, config, hashes[inputs.reference]), f"records-{role}") for role, path, names in roles}
    library_inputs = {"reference": hashes[inputs.reference], "pacbio": hashes[inputs.pacbio], "illumina": hashes[inputs.illumina]}
    library = frozen_library(spark, os.path.join(folder, "library"), letters, library_inputs, config, lambda: select(records["pacbio"].table, records["illumina"].table, config, letters))
    freeze_hash = file_hash(os.path.join(folder, "library", "freeze.json"))
    outputs, parts, annotated, sources = os.path.join(folder, "vcf_outputs"), {}, {}, []
    for role, path, names in roles:
        done = W.apply_library(records[role].table, library, config, letters).withColumnsRenamed({"start": "interval_start", "stop": "interval_end"})
        annotated[role] = Stored(done, f"annotated-{role}")
        for sample in names:
            did = dataset(role, sample)
            write_dataset(annotated[role].table, path, role, sample, hashes[path], freeze_hash, os.path.join(outputs, did), library_inputs | {"source": hashes[path], "freeze": freeze_hash}, partitions)
            parts[did] = {"dataset_id": did, "freeze_sha256": freeze_hash}
            table = os.path.join(outputs, did, "annotations.tsv.gz")
            sources.append((did, path, hashes[path], table, published(spark, os.path.join(outputs, did))["files"]["annotations.tsv.gz"]["hash"], freeze_hash))
    listed = spark.createDataFrame(sources, "dataset_id string, source_vcf string, source_sha256 string, annotation_path string, annotation_sha256 string, freeze_sha256 string")
    for g in plan:
        members = tuple((dataset(g["role"], s), s, evidence_context(g["role"], status)[1]) for s in g["members"])
        group = Group(g["group_id"], g["role"], members, g["required_support"], config.consensus_fraction, freeze_hash)
        own = annotated[g["role"]].table.where(F.col("sample_name").isin(g["members"]))
        alleles = Stored(normalise(explode_alleles(own), contigs.table), "alleles")
        seen = Stored(C.observe(C.called(C.record_arrays(alleles.table)).withColumn("group_id", F.lit(group.group_id))), "seen")
        matrix = Stored(C.member_matrix(C.candidates(seen.table), group.table(own).drop("evidence_context"), C.resolve(seen.table, ["group_id", "dataset_id", *C.SITE])), "matrix")
        support = Stored(C.group_support(matrix.table, F.lit(group.required)), "support")
        part = os.path.join("groups", group.group_id)
        write_group(group, support.table, matrix.table, seen.table, alleles.table, listed, lengths, os.path.join(outputs, part), {"freeze": freeze_hash} | {d: hashes[p] for d, p, *_ in sources if d in {m[0] for m in members}}, partitions)
        parts[part] = {"group_id": group.group_id, "member_count": g["n"], "required_support": g["required_support"], "freeze_sha256": freeze_hash}
        for table in (alleles, seen, matrix, support):
            table.drop()
    for table in (contigs, *records.values(), *annotated.values()):
        table.drop()
    return publish_all(spark, outputs, parts, {"consensus_fraction": config.consensus_fraction, "groups": dict(config.groups)})


def main(arguments: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description="Motif evidence for variant calls, from files to consensus")
    for name in ("reference", "pacbio", "illumina", "config", "out"):
        p.add_argument(f"--{name}", required=True)
    p.add_argument("--external")
    p.add_argument("--external-sample", action="append", default=[])
    a = p.parse_args(arguments)
    with open(a.config) as f:
        config = Config.load(f.read())
    spark = SparkSession.builder.getOrCreate()
    run(spark, Inputs(a.reference, a.pacbio, a.illumina, a.external, tuple(a.external_sample)), config, a.out)


if __name__ == "__main__":
    main()
