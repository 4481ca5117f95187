"""The files of a consensus group: the VCF with its index, support, member evidence and excluded alleles, published together.

All are written by the executors (`sources/ordered.py`); the driver holds the contig list and the configured members.
"""

from __future__ import annotations

import os
from dataclasses import dataclass
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandmill.functions.genotype import alleles_of
from strandmill.functions.identity import escape_sample
from strandmill.operators.consensus import SITE
from strandmill.plans.publish import publish, staging
from strandmill.sources import ordered

#: Columns of the tables.
SUPPORT = ["group_id", "role", "CHROM", "POS", "REF", "ALT", "group_n", "required_support", "support_count", "support_percent", "supporting_samples", "genotype_disagreement", "conflicting_samples", "retained"]
EVIDENCE = ["group_id", "role", "dataset_id", "sample_name", "CHROM", "POS", "REF", "ALT", "selection_participant", "evidence_context", "call_state", "presence_state", "presence_conflict", "projected_GT", "support", "duplicate_count", "dosage_disagreement", "ploidy_disagreement", "duplicate_genotype_disagreement", "missingness", "annotation_disagreement", "source_occurrences"]
EXCLUDED = ["group_id", "role", "dataset_id", "sample_name", "source_vcf", "source_sha256", "source_record_index", "record_id", "CHROM", "POS", "ID", "REF", "ALT", "GT", "original_alt_index", "original_alt", "annotation_status", "window_id", "interval_start", "interval_end", "selection_participant", "evidence_context", "exclusion_reason"]
#: INFO fields of the file.
INFO = [
    ("GROUP_N", "1", "Integer", "Members of the group"),
    ("REQUIRED_SUPPORT", "1", "Integer", "Least support"),
    ("PROMISING_SUPPORT", "1", "Integer", "Members with a promising occurrence"),
    ("PROMISING_PERCENT", "1", "Float", "Support in percent of all members"),
    ("PROMISING_SAMPLES", ".", "String", "Supporting samples, escaped"),
    ("CONFLICTING_SAMPLES", ".", "String", "Samples with conflicting records, escaped"),
    ("GT_DISAGREEMENT", "0", "Flag", "Genotypes or ploidies differ"),
]


@dataclass(frozen=True)
class Group:
    """members: (dataset_id, sample_name, evidence context) in order."""

    group_id: str
    role: str
    members: tuple[tuple[str, str, str], ...]
    required: int
    fraction: str
    freeze_hash: str

    @property
    def participant(self) -> bool:
        return self.role == "illumina"

    def table(self, like: DataFrame) -> DataFrame:
        rows = [(self.group_id, d, s, i, c) for i, (d, s, c) in enumerate(self.members)]
        return F.broadcast(like.sparkSession.createDataFrame(rows, "group_id string, dataset_id string, sample_name string, member_ord int, evidence_context string"))


def consensus_head(group: Group, lengths: dict[str, int]) -> bytes:
    part, contexts = Fraction(group.fraction), sorted({c for *_, c in group.members})
    # Names of the file's own header lines.
    own = {
        "motif_label": "prioritization_only",
        "motif_freeze_sha256": group.freeze_hash,
        "motif_consensus_group": group.group_id,
        "motif_consensus_fraction": f"{part.numerator}/{part.denominator}",
        "motif_role": group.role,
        "motif_selection_participant": str(group.participant).lower(),
        "motif_evidence_context": contexts[0] if len(contexts) == 1 else "mixed",
    }
    lines = ["##fileformat=VCFv4.2", *(f"##{k}={v}" for k, v in own.items()), *(f"##contig=<ID={c},length={n}>" for c, n in lengths.items())]
    lines += [f'##INFO=<ID={name},Number={number},Type={kind},Description="{text}">' for name, number, kind, text in INFO]
    lines += ['##FORMAT=<ID=GT,Number=1,Type=String,Description="Genotype projected on this allele">', "\t".join(["#CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT", *(s for _, s, _ in group.members)])]
    return ("\n".join(lines) + "\n").encode()


def _contig_order(df: DataFrame, lengths: dict[str, int]) -> DataFrame:
    """With contig_ord; a contig that the index lacks raises."""
    order = F.broadcast(df.sparkSession.createDataFrame([(c, i) for i, c in enumerate(lengths)], "contig string, contig_ord int"))
    unknown = F.raise_error(F.concat(F.lit("unknown contig "), "contig")).cast("int")
    return df.join(order, "contig", "left").withColumn("contig_ord", F.coalesce("contig_ord", unknown))


def consensus_lines(support: DataFrame, matrix: DataFrame, lengths: dict[str, int], group: Group) -> DataFrame:
    """(contig_ord, pos, ref, alt, body) of the retained sites of the group."""
    by = ["group_id", *SITE]
    listed = lambda flag: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col(flag), F.struct("member_ord", escape_sample(F.col("sample_name")).alias("s"))))), lambda x: x["s"]), ",")
    calls = matrix.groupBy(*by).agg(F.transform(F.array_sort(F.collect_list(F.struct("member_ord", "projected_GT"))), lambda x: x["projected_GT"]).alias("gt"), listed("support").alias("yes"), listed("presence_conflict").alias("no"))
    rows = _contig_order(support.where(F.col("retained") & (F.col("group_id") == group.group_id)).join(calls, by), lengths)
    named = lambda key, value: F.concat(F.lit(f"{key}="), value.cast("string"))
    info = F.concat_ws(
        ";", named("GROUP_N", F.col("group_n")), named("REQUIRED_SUPPORT", F.col("required_support")), named("PROMISING_SUPPORT", F.col("support_count")), named("PROMISING_PERCENT", F.col("support_percent")),
        named("PROMISING_SAMPLES", F.col("yes")), named("CONFLICTING_SAMPLES", F.when(F.col("no") == "", ".").otherwise(F.col("no"))), F.when(F.col("genotype_disagreement"), "GT_DISAGREEMENT"),
    )
    line = F.concat_ws("\t", "contig", F.col("canonical_pos").cast("string"), F.lit("."), "canonical_ref", "canonical_alt", F.lit("."), F.lit("."), info, F.lit("GT"), F.array_join("gt", "\t"))
    return rows.select("contig_ord", F.col("canonical_pos").alias("pos"), F.col("canonical_ref").alias("ref"), F.col("canonical_alt").alias("alt"), ordered.line_body(line).alias("body"))


def _text(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(""))


def source_occurrences(alleles: DataFrame, sources: DataFrame) -> DataFrame:
    """(dataset_id, contig, ordinal, source): a record with all its alleles as one structure, values as in the tables' text.

    sources (dataset_id, source_vcf, source_sha256, annotation_path, annotation_sha256, freeze_sha256) is a configured list.
    """
    canonical = F.when(F.col("exclusion_reason") == "", F.array("contig", F.col("canonical_pos").cast("string"), "canonical_ref", "canonical_alt"))
    status = F.when(F.col("exclusion_reason") == "", "normalized").otherwise("excluded")
    allele = F.struct("alt_index", "allele", canonical.alias("canonical"), status.alias("normalization_status"), "exclusion_reason")
    own = {"original_CHROM": "contig", "original_POS": "pos", "original_ID": "id", "original_REF": "ref", "original_ALT": "alt", "original_GT": "gt", "window_id": "window_id", "interval_start": "interval_start", "interval_end": "interval_end", "annotation_status": "annotation_status", "annotation_reason": "annotation_reason", "best_final_motif_id": "best_motif_id", "best_family_id": "best_family_id", "reported_p_value": "best_p", "local_start": "best_start", "local_stop": "best_stop"}
    first = F.first(F.struct(*(_text(c).alias(n) for n, c in own.items()))).alias("own")
    rows = alleles.groupBy("dataset_id", "contig", "ordinal").agg(first, F.array_sort(F.collect_list(allele)).alias("alts")).join(F.broadcast(sources), "dataset_id")
    name = F.concat_ws("_", "dataset_id", "source_sha256", F.col("ordinal").cast("string"))
    whole = F.struct(
        "source_vcf", "source_sha256", F.col("ordinal").cast("string").alias("source_record_index"), name.alias("source_record_id"), *(F.col(f"own.{n}").alias(n) for n in own),
        F.transform("alts", lambda a: a["allele"]).alias("original_ALT_list"), F.transform("alts", lambda a: a["alt_index"]).alias("original_alt_indexes"), F.col("alts").alias("original_alt_alleles"), "annotation_path", "annotation_sha256", "freeze_sha256",
    )
    return rows.select("dataset_id", "contig", "ordinal", whole.alias("source"))


def member_evidence(matrix: DataFrame, seen: DataFrame, sources: DataFrame, group: Group) -> DataFrame:
    """Every candidate site with every member, and the member's records there as JSON; no records give an empty list.

    matrix and seen are `group_consensus`'s rows, sources those of `source_occurrences`.
    """
    by = ["group_id", "dataset_id", *SITE]
    each = seen.select(*by, "ordinal", "presence", "targets").join(sources, ["dataset_id", "contig", "ordinal"])
    entry = F.struct("ordinal", F.struct("source.*", F.col("presence").alias("target_presence"), F.array_sort("targets").alias("target_alt_indexes")).alias("entry"))
    listed = F.transform(F.array_sort(F.collect_list(entry), lambda a, b: F.when(a["ordinal"] < b["ordinal"], -1).when(a["ordinal"] > b["ordinal"], 1).otherwise(0)), lambda x: x["entry"])
    found = each.groupBy(*by).agg(F.to_json(listed, {"ignoreNullFields": "false"}).alias("source_occurrences"))
    rows = matrix.where(F.col("group_id") == group.group_id).join(found, by, "left").drop("evidence_context").join(group.table(matrix).select("dataset_id", "evidence_context"), "dataset_id")
    return rows.withColumns({"role": F.lit(group.role), "selection_participant": F.lit(group.participant), "source_occurrences": F.coalesce("source_occurrences", F.lit("[]"))}).withColumnsRenamed({"canonical_pos": "POS", "canonical_ref": "REF", "canonical_alt": "ALT"}).withColumn("CHROM", F.col("contig"))


def excluded_alleles(alleles: DataFrame, sources: DataFrame, group: Group) -> DataFrame:
    """Alleles that members carry and that have no canonical form, with the reason."""
    carried = F.exists(alleles_of(F.col("gt")), lambda a: F.coalesce(a == F.col("alt_index"), F.lit(False)))
    kept = alleles.where((F.col("exclusion_reason") != "") & carried)
    rows = kept.drop("sample_name", "group_id", "role", "evidence_context").join(group.table(alleles), "dataset_id").join(F.broadcast(sources.select("dataset_id", "source_vcf", "source_sha256")), "dataset_id")
    name = F.concat_ws("_", "dataset_id", "source_sha256", F.col("ordinal").cast("string"))
    return rows.select(
        "group_id", F.lit(group.role).alias("role"), "dataset_id", "sample_name", "member_ord", "source_vcf", "source_sha256", F.col("ordinal").alias("source_record_index"), name.alias("record_id"), F.col("contig").alias("CHROM"), F.col("pos").alias("POS"), F.col("id").alias("ID"), F.col("ref").alias("REF"), F.col("alt").alias("ALT"),
        F.col("gt").alias("GT"), F.col("alt_index").alias("original_alt_index"), F.col("allele").alias("original_alt"), "annotation_status", "window_id", "interval_start", "interval_end", F.lit(group.participant).alias("selection_participant"), "evidence_context", "exclusion_reason",
    )


def write_group(group: Group, support: DataFrame, matrix: DataFrame, seen: DataFrame, alleles: DataFrame, sources: DataFrame, lengths: dict[str, int], folder: str, inputs: dict[str, str] | None = None, partitions: int | None = None) -> dict:
    """consensus.vcf.gz with its index, support.tsv.gz, member_evidence.tsv.gz and excluded_alleles.tsv.gz, under complete.json; its record.

    alleles are the normalised, annotated alleles of the members (`normalise`), support, matrix and seen the steps of the
    consensus. Each is read several times: pass stored tables.
    """
    site = {"CHROM": F.col("contig"), "POS": F.col("canonical_pos"), "REF": F.col("canonical_ref"), "ALT": F.col("canonical_alt")}
    order = ["contig_ord", "POS", "REF", "ALT"]
    names = ["consensus.vcf.gz", "consensus.vcf.gz.csi", "support.tsv.gz", "member_evidence.tsv.gz", "excluded_alleles.tsv.gz"]
    os.makedirs(folder, exist_ok=True)
    with staging(folder) as at:
        path = [os.path.join(at, n) for n in names]
        ordered.write_blocked(consensus_lines(support, matrix, lengths, group), path[0], ["contig_ord", "pos", "ref", "alt"], consensus_head(group, lengths), index=True, partitions=partitions)
        own = support.where(F.col("group_id") == group.group_id).withColumns({**site, "role": F.lit(group.role)})
        ordered.write_tsv(_contig_order(own, lengths), path[2], SUPPORT, order, partitions)
        evidence = member_evidence(matrix, seen, source_occurrences(alleles, sources), group)
        ordered.write_tsv(_contig_order(evidence, lengths), path[3], EVIDENCE, [*order, "member_ord"], partitions)
        ordered.write_tsv(excluded_alleles(alleles, sources, group), path[4], EXCLUDED, ["member_ord", "source_record_index", "original_alt_index"], partitions)
        detail = {"group_id": group.group_id, "role": group.role, "member_dataset_ids": [d for d, *_ in group.members], "member_count": len(group.members), "required_support": group.required, "freeze_sha256": group.freeze_hash}
        return publish(support.sparkSession, at, folder, names, inputs or {}, {"consensus_fraction": group.fraction}, detail)
