"""Variant calls: the header on the driver, records as a DataFrame in file order."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandmill.functions.genotype import BASES, format_value
from strandmill.sources.text import numbered_lines

FIXED = ["CHROM", "POS", "ID", "REF", "ALT", "QUAL", "FILTER", "INFO", "FORMAT"]


@dataclass(frozen=True)
class Vcf:
    """header: lines before the records; samples: their names; records: ordinal, the nine fixed fields, values (one a sample) and the raw line."""

    header: list[str]
    samples: list[str]
    records: DataFrame


def check_header(header: list[str], lengths: dict[str, int] | None = None, required: list[str] | None = None) -> list[str]:
    """The sample names of a valid header: unique, with those required, one GT of Number 1 and Type String, contigs as in the index."""
    if not header or not header[-1].startswith("#CHROM\t"):
        raise ValueError("no column line")
    names = header[-1].split("\t")[9:]
    if len(set(names)) != len(names):
        raise ValueError("repeated sample names")
    if missing := set(required or ()) - set(names):
        raise ValueError(f"samples missing: {sorted(missing)}")
    gts = [h for h in header if re.match(r"##FORMAT=<ID=GT,", h)]
    if len(gts) != 1 or "Number=1" not in gts[0] or "Type=String" not in gts[0]:
        raise ValueError("GT must be declared once, as one String")
    for line in header:
        found = re.match(r"##contig=<ID=([^,>]+)(?:.*?,length=(\d+))?", line)
        if found and lengths is not None:
            if found[1] not in lengths:
                raise ValueError(f"unknown contig {found[1]}")
            if found[2] and int(found[2]) != lengths[found[1]]:
                raise ValueError(f"length of {found[1]} differs from the index")
    return names


def row_problem(fields: Column, samples: int) -> Column:
    """What is wrong with a record's fields, or null."""
    keys = F.split(fields[8], ":")
    return (
        F.when(F.size(fields) != 9 + samples, "field count")
        .when(~fields[1].rlike(r"\A[1-9][0-9]*\z"), "position")
        .when(~fields[3].rlike(BASES), "reference allele")
        .when(F.exists(keys, lambda k: ~k.rlike(r"\A[A-Za-z_][0-9A-Za-z_.]*\z")) | (F.size(F.array_distinct(keys)) < F.size(keys)), "format keys")
        .when(F.exists(F.slice(fields, 10, samples), lambda v: F.size(F.split(v, ":")) > F.size(keys)), "too many values")
    )


def read_vcf(spark: SparkSession, path: str, lengths: dict[str, int] | None = None, required: list[str] | None = None) -> Vcf:
    """Plain or gzip. Malformed records raise when they are read."""
    lines = numbered_lines(spark, path)
    header = [r[0] for r in lines.where(F.col("value").startswith("#")).orderBy("line").select("value").collect()]
    samples = check_header(header, lengths, required)
    f = F.split("value", "\t", -1)
    rows = lines.where(~F.col("value").startswith("#") & (F.col("value") != "")).select((F.col("line") - len(header)).alias("ordinal"), "value", f.alias("f"))
    problem = row_problem(F.col("f"), len(samples))
    safe = F.when(problem.isNull(), F.col("f")).otherwise(F.raise_error(F.concat(F.lit("record "), F.col("ordinal").cast("string"), F.lit(": "), problem)).cast("array<string>"))
    rows = rows.withColumn("f", safe)
    fixed = [F.col("f")[i].cast("bigint" if n == "POS" else "string").alias(n) for i, n in enumerate(FIXED)]
    return Vcf(header, samples, rows.select("ordinal", *fixed, F.slice("f", 10, max(len(samples), 1)).alias("values"), F.col("value").alias("raw")))


def sample_records(vcf: Vcf, names: list[str]) -> DataFrame:
    """One row per record and chosen sample: sample_name, fixed fields, value and GT."""
    if unknown := set(names) - set(vcf.samples):
        raise ValueError(f"unknown samples: {sorted(unknown)}")
    each = vcf.records.withColumn("picked", F.explode(F.array(*(F.struct(F.lit(n).alias("name"), F.col("values")[vcf.samples.index(n)].alias("value")) for n in names))))
    return each.select("ordinal", F.col("picked.name").alias("sample_name"), *FIXED, F.col("picked.value").alias("value"), format_value(F.col("FORMAT"), F.col("picked.value"), "GT").alias("GT"))


def read_query_rows(spark: SparkSession, path: str) -> DataFrame:
    """A captured query stream without a header: line, CHROM, POS, ID, REF, ALT and GT; a line with other than six fields raises."""
    f = F.split("value", "\t", -1)
    message = F.concat(F.lit(f"malformed query stream {path}: line "), F.col("line").cast("string"))
    checked = F.when(F.size(f) == 6, f).otherwise(F.raise_error(message).cast("array<string>"))
    rows = numbered_lines(spark, path).withColumn("f", checked)
    return rows.select("line", *(F.col("f")[i].cast("bigint" if n == "POS" else "string").alias(n) for i, n in enumerate(["CHROM", "POS", "ID", "REF", "ALT", "GT"])))
