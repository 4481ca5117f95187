"""From documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written and read again before the next one.
All but the last return the columns of documents. Extra columns pass through; nulls, empty texts and repeated rows
are treated as the operators' docstrings say. No stage has an equivalent in SQL (a trained network comes first), so
ORACLE_SQL is None and tests hold the stages against plain Python.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandmill.llm.bloom import split_possible, without_keys
from strandmill.llm.decontamination import build_index, contamination
from strandmill.llm.linededup import deduped
from strandmill.llm.packing import pack_documents
from strandmill.llm.setjoin import linked_rows
from strandmill.llm.shared import drop_table, fresh, row_key, spread_join, write_table
from strandmill.llm.toxicity import keep_clean, learn


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose highest window isn't toxic."""
    return keep_clean(docs, learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the blocks of lines that earlier ones have; one with no words left goes, and n_chars counts the new text."""
    names = docs.columns
    out, change = deduped(docs)
    changed = F.col(change).isNotNull()
    out = out.where(~changed | F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False)))
    if "n_chars" in names:
        out = out.withColumn("n_chars", F.when(changed, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out.select(*names)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked at 0.8 or more in five-word shingles, the one of smallest doc_id.

    Ids may repeat or be null: a row counts by its id and text. Null ids come last, rows of one id in the order of a hash
    of the text, and of rows with the same id and text one stays. Documents without words have no links and all stay.
    """
    rows, path = write_table(linked_rows(docs, 5, 80, 100).where("root is not null").select("doc_id", "row", "root"), "near-rows")
    first = rows.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row"))["row"].alias("first"))
    gone, _ = write_table(spread_join(rows, first, "root", "row", rows).where("row <> first").select(F.col("row").alias("entry")).distinct(), "near-gone")
    again, _ = write_table(rows.groupBy("row").count().where("count > 1").select(F.col("row").alias("entry")), "near-again")
    drop_table(spark, path)
    key = fresh(docs.columns, "row")
    kept = without_keys(docs.withColumn(key, row_key()), key, gone)
    if again.isEmpty():
        return kept.select(*docs.columns)
    once, doubtful = split_possible(kept, key, again)
    alone = doubtful.join(again, F.col(key) == again["entry"], "left_anti")
    several = doubtful.join(again, F.col(key) == again["entry"], "left_semi").dropDuplicates([key])
    return once.unionByName(alone).unionByName(several).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with less than a twentieth of their words in benchmark windows. A row counts by its id and text, so ids may repeat or be null."""
    index, path = write_table(build_index(docs.select(row_key().alias("doc_id"), "text")), "index")
    found = contamination(index, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).where("contaminated")
    gone, _ = write_table(found.select(F.col("doc_id").alias("entry")).distinct(), "contaminated")
    drop_table(spark, path)
    key = fresh(docs.columns, "row")
    return without_keys(docs.withColumn(key, row_key()), key, gone).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 1024 tokens."""
    return pack_documents(docs)


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("packing", packing),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        docs, path = write_table(stage(spark, docs, sf_dir), f"stage-{name}")
        if before:  # nothing reads a stage's result once the next one is written
            drop_table(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
