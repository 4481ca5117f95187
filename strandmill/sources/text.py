"""Text files with their line numbers, without a single-task pass.

A file is read in blocks; lines are numbered within their block and shifted by the lines of earlier blocks of the
file, so the numbers are those of the file whatever the partitions. Compressed files are one block.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line, value), line from 1."""
    raw = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("_id"))
    inside = raw.withColumn("n", F.row_number().over(Window.partitionBy("file", "block").orderBy("_id")))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = raw.groupBy("file", "block").agg(F.count("*").alias("c")).select("file", "block", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("first"))
    # One row per block.
    return inside.join(F.broadcast(starts), ["file", "block"]).select("file", (F.col("first") + F.col("n")).alias("line"), "value")


def read_tsv(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Tab-separated with a header; gzip by suffix. Columns are bound by header names; without a schema all are text."""
    table = spark.read.option("sep", "\t").option("header", True).option("quote", "").option("emptyValue", "").option("nullValue", None).csv(path)
    if schema is None:
        return table
    wanted = [part.strip().rsplit(" ", 1) for part in schema.split(",")]
    if missing := [n for n, _ in wanted if n not in table.columns]:
        raise ValueError(f"columns missing in {path}: {missing}")
    return table.select(*(F.col(f"`{n}`").cast(t).alias(n) for n, t in wanted))


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """(ord, name, sequence), upper case; the name is the header's first word. Sequence before a header is an error."""
    lines = numbered_lines(spark, path).withColumn("head", F.col("value").startswith(">").cast("int")).withColumn("chunk", F.floor(F.col("line") / 100_000))
    before = Window.partitionBy("file").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = lines.groupBy("file", "chunk").agg(F.sum("head").alias("heads")).select("file", "chunk", F.coalesce(F.sum("heads").over(before), F.lit(0)).alias("earlier"))
    running = F.sum("head").over(Window.partitionBy("file", "chunk").orderBy("line").rowsBetween(Window.unboundedPreceding, 0))
    numbered = lines.withColumn("own", running).join(F.broadcast(starts), ["file", "chunk"]).withColumn("ord", F.col("earlier") + F.col("own"))
    numbered = numbered.where(F.trim("value") != "").withColumn("ord", F.when(F.col("ord") == 0, F.raise_error(F.lit("sequence before the first header")).cast("bigint")).otherwise(F.col("ord")))
    parts = F.array_sort(F.collect_list(F.when(F.col("head") == 0, F.struct("line", F.upper(F.trim("value")).alias("s")))))
    name = F.max(F.when(F.col("head") == 1, F.regexp_extract("value", r"^>\s*(\S+)", 1)))
    return numbered.groupBy("file", "ord").agg(name.alias("name"), F.array_join(F.transform(parts, lambda p: p["s"]), "").alias("sequence")).drop("file")


def read_fai(spark: SparkSession, path: str) -> DataFrame:
    """(ord, contig, length) in file order; malformed, nonpositive or repeated entries are errors."""
    rows = numbered_lines(spark, path).where(F.trim("value") != "").withColumn("f", F.split("value", "\t"))
    length = F.try_element_at("f", F.lit(2)).try_cast("bigint")
    good = (F.size("f") >= 2) & (F.col("f")[0] != "") & (F.coalesce(length, F.lit(0)) > 0)
    checked = F.when(good, length).otherwise(F.raise_error(F.concat(F.lit("malformed index line: "), "value")).cast("bigint"))
    out = rows.select(F.col("line").alias("ord"), F.col("f")[0].alias("contig"), checked.alias("length"))
    once = Window.partitionBy("contig")
    repeated = F.count("*").over(once) > 1
    return out.withColumn("length", F.when(repeated, F.raise_error(F.concat(F.lit("repeated contig: "), "contig")).cast("bigint")).otherwise(F.col("length")))
