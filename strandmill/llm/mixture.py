"""Mixing sources to target weights.

1. A document's size is its number of words; sizes are summed per source. Sources, in code point order with null last,
   take the weights in turn; a source's target is its weight's share of the budget, up to `epochs` times its size, and what
   is over is shared again by weight until no source is above. This runs on a table of sources.
2. A document's key is random but fixed: an md5 of seed and doc_id (of the text where that is null). Documents are
   range-sorted by source and key, so a source with a third of all rows lies in many partitions.
3. Sizes are summed along each partition, and the sums of a source's partitions along the source: a prefix sum that no
   task sees whole.
4. A source is taken whole as often as its target holds it; in the last epoch documents are taken in key order up to the
   source's exact budget, the floor of its target. One document a source is cut, so the words taken equal that budget.

Nulls: a null text has size 0; null is a source of its own. Empty texts have size 0 and nothing is taken of them. Very
long texts are counted whole. Documents that repeat doc_id have one key and stand by size; rows equal in both are
interchangeable. An empty table gives an empty result. Extra columns are ignored by the plan and kept by `mixed`.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from strandmill.llm.bloom import only_possible
from strandmill.llm.shared import attach, fresh, range_sorted, spread_join, text_key, write_table

WEIGHTS = (5, 2, 1)
PERCENT = 150
EPOCHS = 2
SEED = "2024"
WORD = r"[^\x20\x09-\x0D]+"
#: More than there are partitions.
PARTS = 1 << 24


def mix_key(source: str) -> Column:
    """A key of a row's doc_id, text and source."""
    return F.xxhash64(F.col("doc_id").cast("bigint"), "text", text_key(F.col(source)))


def sized(docs: DataFrame, source: str = "source", seed: str = SEED) -> DataFrame:
    """A stored table of row, doc_id, from (the source as a key that isn't null), size, key and line (a row's number)."""
    own = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("text:"), F.md5(F.coalesce(F.col("text"), F.lit("")))))
    key = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), own)), 1, 15), 16, 10).cast("bigint")
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint")
    out = docs.select(mix_key(source).alias("row"), F.col("doc_id").cast("bigint"), text_key(F.col(source)).alias("from"), size.alias("size"), key.alias("key"), F.monotonically_increasing_id().alias("line"))
    return write_table(out, "sized")[0]


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, percent: int = PERCENT, epochs: int = EPOCHS) -> DataFrame:
    """A stored table of from, nth (the source's place), source_size, target and limit (words to take) of each source."""
    sums, _ = write_table(sizes.groupBy("from").agg(F.sum("size").alias("source_size")), "source-sizes")
    order = [F.when(F.col("from") == "", 1).otherwise(0), F.col("from")]
    table = range_sorted(sums, order, "sources")
    starts = table.groupBy("part").agg(F.count("*").alias("n")).select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("start"))  # one row a partition
    nth = (F.col("start") + F.col("place")).alias("nth")
    turn = F.array(*(F.lit(w).cast("bigint") for w in weights))
    placed = table.join(F.broadcast(starts), "part").select("from", "source_size", nth).withColumn("weight", turn[F.pmod("nth", F.lit(len(weights))).cast("int")])
    placed, _ = write_table(placed, "weights")
    most = F.col("source_size") * epochs
    total = (placed.agg(F.sum("source_size")).first()[0] or 0) * percent / 100
    level = -1.0  # words for each unit of weight; rises until no source that isn't full is above its limit
    while True:
        full = most <= level * F.col("weight")
        held, left = placed.agg(F.sum(F.when(full, most)), F.sum(F.when(~full, F.col("weight")))).first()
        now = (total - (held or 0)) / left if left else float("inf")
        if now <= level or not left:
            break
        level = now
    target = F.when(most <= F.lit(level) * F.col("weight"), most.cast("double")).otherwise(F.lit(level) * F.col("weight"))
    return write_table(placed.select("from", "nth", "source_size", target.alias("target"), F.floor(target).alias("limit")), "targets")[0]


def _running(rows: DataFrame) -> DataFrame:
    """rows with `inside`: sizes of the earlier rows of the same source in the same partition. rows are sorted by source."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, carry = -1, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            names = batch.schema.names
            nth, size = (batch.column(names.index(c)).to_numpy() for c in ("nth", "size"))
            before = np.cumsum(size) - size
            first = np.flatnonzero(np.concatenate([[True], nth[1:] != nth[:-1]]))
            base = before[first].copy()
            if nth[0] == last:
                base[0] -= carry
            inside = before - np.repeat(base, np.diff(np.append(first, len(nth))))
            last, carry = int(nth[-1]), int(inside[-1] + size[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(inside)], [*names, "inside"])

    return rows.mapInArrow(work, ", ".join(f"`{c}` {t}" for c, t in rows.dtypes) + ", inside bigint")


def mix_plan(docs: DataFrame, source: str = "source", weights: tuple[int, ...] = WEIGHTS, percent: int = PERCENT, epochs: int = EPOCHS, seed: str = SEED) -> DataFrame:
    """Per row of docs: row, doc_id, size, source_size, target, full (epochs that take it whole), part (words of the last
    epoch) and taken (words in all)."""
    sizes = sized(docs, source, seed)
    targets = source_targets(sizes, weights, percent, epochs)
    joined = attach(sizes, targets, "from", "line").select("row", "doc_id", "size", "nth", "source_size", "target", "limit", "key", "line")
    keys = [F.col(c) for c in ("nth", "key", "doc_id", "size", "line")]
    laid = joined.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("at", F.col("nth") * PARTS + F.spark_partition_id()).drop("key", "line")
    table, _ = write_table(_running(laid), "mixed")
    sums = table.groupBy("nth", "at").agg(F.sum("size").alias("n"))
    earlier = Window.partitionBy("nth").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    # A row for each source and partition that meet: at most one for each of both, as sources stand in order.
    starts, _ = write_table(sums.select("at", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start")), "starts")
    some = F.col("source_size") > 0
    full, rest = F.when(some, F.expr("limit div source_size")).otherwise(0), F.when(some, F.pmod("limit", "source_size")).otherwise(0)
    out = attach(table, starts, "at", "row").withColumns({"full": full, "part": F.greatest(F.lit(0), F.least("size", rest - F.col("start") - F.col("inside")))})
    return out.select("row", "doc_id", "size", "source_size", "target", "full", "part", (F.col("full") * F.col("size") + F.col("part")).alias("taken"))


@F.pandas_udf(StringType())
def _first_words(text: pd.Series, words: pd.Series) -> pd.Series:
    return pd.Series([t[: next(islice(re.finditer(WORD, t), n - 1, None)).end()] for t, n in zip(text, words, strict=True)])


def mixed(docs: DataFrame, plan: DataFrame, source: str = "source") -> DataFrame:
    """The mix itself: docs' columns for each time a row with words is taken, with new columns epoch (from 0) and words; the
    text of a document that is cut ends after the last word taken. plan is what mix_plan says of docs."""
    names = docs.columns
    copies = F.transform(F.sequence(F.lit(0), F.col("full").cast("int")), lambda e: F.struct(e.alias("epoch"), F.when(e < F.col("full"), F.col("size")).otherwise(F.col("part")).alias("words")))
    takes, _ = write_table(plan.where("taken > 0").select("row", "size", F.explode(copies).alias("take")).select(F.col("row").alias("entry"), "size", "take.*").where("words > 0"), "takes")
    key = fresh(names, "row")
    held = only_possible(docs.withColumn(key, mix_key(source)), key, takes).dropDuplicates([key])
    whole = held.select(F.col(key).alias("entry"), F.struct(*(F.col(c) for c in names)).alias("doc"))
    out = spread_join(takes, whole, "entry", "epoch", takes).where("doc is not null")
    told = [F.col("epoch").alias(fresh(names, "epoch")), F.col("words").alias(fresh(names, "words"))]
    uncut = out.where("words = size").select("doc.*", *told)
    # One document a source is cut.
    cut = out.where("words < size").withColumn("doc", F.col("doc").withField("text", _first_words("doc.text", "words"))).select("doc.*", *told)
    return uncut.unionByName(cut)


def op12_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix of all sources by 5, 2, 1 takes of every document."""
    return mix_plan(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "size", "source_size", "target", "taken")


OP12_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5('2024:' || coalesce(doc_id::VARCHAR, 'text:' || md5(coalesce(text, '')))), 1, 15))::BIGINT AS key
  FROM documents),
sources AS (
  SELECT source, sum(size)::DOUBLE AS s, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END::DOUBLE AS w
  FROM sized GROUP BY source),
filled AS (
  SELECT *, (1.5 * sum(s) OVER () - coalesce(sum(2 * s) OVER before, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER before, 0)) AS level
  FROM sources WINDOW before AS (ORDER BY 2 * s / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, s, CASE WHEN 2 * s <= l * w THEN 2 * s ELSE l * w END AS target
  FROM filled, (SELECT max(level) AS l FROM filled)),
laid AS (
  SELECT doc_id, size, s::BIGINT AS source_size, target, floor(target)::BIGINT AS most,
         (sum(size) OVER (PARTITION BY z.source ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING) - size)::BIGINT AS earlier
  FROM sized z JOIN targets t ON z.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CASE WHEN source_size = 0 THEN 0 ELSE most // source_size * size + greatest(0, least(size, most % source_size - earlier)) END::BIGINT AS taken
FROM laid
"""
