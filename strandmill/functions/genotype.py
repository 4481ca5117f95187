"""Genotype and allele expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

GT_GRAMMAR = r"\A(?:\.|[0-9]+)(?:[/|](?:\.|[0-9]+))*\z"
BASES = r"\A[ACGTNacgtn]+\z"


def alts_of(alt: Column) -> Column:
    """ALT text as an array; '.' is none."""
    return F.when(alt == ".", F.array().cast("array<string>")).otherwise(F.split(alt, ","))


def alleles_of(gt: Column) -> Column:
    """Allele numbers, null for '.'."""
    return F.transform(F.split(gt, "[/|]"), lambda x: F.when(x != ".", x.try_cast("int")))


def gt_valid(gt: Column, alt_count: Column) -> Column:
    return F.coalesce(gt.rlike(GT_GRAMMAR) & ~F.coalesce(F.exists(alleles_of(gt), lambda a: F.coalesce(a > alt_count, F.lit(False))), F.lit(False)), F.lit(False))


def has_alt(alleles: Column) -> Column:
    return F.exists(alleles, lambda a: F.coalesce(a > 0, F.lit(False)))


def all_missing(alleles: Column) -> Column:
    return F.forall(alleles, lambda a: a.isNull())


def gt_status(alleles: Column) -> Column:
    return F.when(has_alt(alleles), "alt").when(all_missing(alleles), "missing").otherwise("reference_only")


def partial_missing(alleles: Column) -> Column:
    return F.exists(alleles, lambda a: a.isNull()) & F.exists(alleles, lambda a: a.isNotNull())


def parse_gt(gt: Column, alt_count: Column) -> Column:
    """struct(alleles, ploidy, partial_missing, gt_status), null where the GT is malformed or out of range."""
    a = alleles_of(gt)
    return F.when(gt_valid(gt, alt_count), F.struct(a.alias("alleles"), F.size(a).alias("ploidy"), partial_missing(a).alias("partial_missing"), gt_status(a).alias("gt_status")))


def variant_type(ref: Column, alt: Column) -> Column:
    kinds = F.array_distinct(F.transform(F.split(alt, ","), lambda x: F.when((F.length(ref) == 1) & (F.length(x) == 1), "SNP").when(F.length(ref) == F.length(x), "MNV").otherwise("indel")))
    return F.when(F.exists(F.split(alt, ","), lambda x: ~x.rlike(BASES)), "symbolic").when(F.size(kinds) == 1, kinds[0]).otherwise("mixed")


#: What each shape of ALT is, in order.
_BREAKEND = r"\A(?:[ACGTNacgtn]+([\[\]])[^\s\[\]]+:[1-9][0-9]*\1|([\[\]])[^\s\[\]]+:[1-9][0-9]*\2[ACGTNacgtn]+)\z"
_SINGLE_BREAKEND = r"\A(?:\.[ACGTNacgtn]+|[ACGTNacgtn]+\.)\z"


def exclusion_reason(ref: Column, alt: Column) -> Column:
    """Why an allele can't be normalised; '' if it can, null if REF or ALT is malformed."""
    return (
        F.when(~ref.rlike(BASES), F.lit(None).cast("string"))
        .when(alt.isin("<NON_REF>", "<*>"), "unspecified_alt")
        .when(alt == "*", "spanning_deletion")
        .when(alt.rlike(r"\A<[A-Za-z0-9_.:-]+>\z"), "symbolic_alt")
        .when(alt.rlike(_BREAKEND) | alt.rlike(_SINGLE_BREAKEND), "breakend_alt")
        .when(~alt.rlike(BASES), F.lit(None).cast("string"))
        .when(F.upper(F.concat(ref, alt)).contains("N"), "ambiguous_sequence")
        .otherwise("")
    )


def project_gt(gt: Column, targets: Column) -> Column:
    """gt seen from the target alleles: 0 stays, targets become 1, others and '.' become '.'; separators stay."""
    marks = F.regexp_extract_all(gt, F.lit("[/|]"), F.lit(0))
    new = F.transform(alleles_of(gt), lambda a: F.when(a == 0, "0").when(F.array_contains(targets, a), "1").otherwise("."))
    return F.array_join(F.zip_with(new, marks, lambda x, m: F.concat(x, F.coalesce(m, F.lit("")))), "")


def format_value(keys: Column, values: Column, name: str) -> Column:
    """A sample's value for a FORMAT key; '.' where it is absent."""
    at = F.array_position(F.split(keys, ":"), name).cast("int")
    return F.coalesce(F.when(at > 0, F.try_element_at(F.split(values, ":"), at)), F.lit("."))


def reverse_complement(sequence: Column) -> Column:
    return F.reverse(F.translate(sequence, "ACGT", "TGCA"))


def ambiguity_count(sequence: Column) -> Column:
    return F.length(F.regexp_replace(sequence, "[ACGT]", ""))


def scoreable(sequence: Column, width: int) -> Column:
    return sequence.rlike(f"[ACGT]{{{width},}}")
