"""Checks of order and completeness over whole tables: distributed, with every break reported or raised."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandmill.sources.text import numbered_lines

SPAN = 100_000  # lines that one task orders at a time


def multiset_difference(left: DataFrame, right: DataFrame, columns: list[str]) -> DataFrame:
    """Rows that one side has more often: the columns and surplus, left's count less right's. Nulls equal each other.

    One pass with partial sums before the shuffle, so a row that repeats without bound is a few counts.
    """
    one, other = left.select(*columns, F.lit(1).alias("_n")), right.select(*columns, F.lit(-1).alias("_n"))
    return one.unionByName(other).groupBy(*columns).agg(F.sum("_n").alias("surplus")).where("surplus <> 0")


def check_merge(filtered: DataFrame, original: DataFrame, columns: list[str]) -> None:
    """Raises unless both have the same rows as often as each other."""
    some = multiset_difference(filtered, original, columns).orderBy(*columns).limit(5).collect()
    if some:
        what = ["added" if r["surplus"] > 0 else "omitted" for r in some]
        raise ValueError("merge disagrees with its records: " + "; ".join(f"{w} {tuple(r)[:-1]}" for w, r in zip(what, some)))


def with_previous(rows: DataFrame, line: str, value: str) -> DataFrame:
    """rows with previous, the value of the line before, without one window over all.

    line is a unique whole number. Lines are ordered a span at a time; the last value of each span (a row for each
    100,000 lines) is carried to the next. Null values are carried as they are.
    """
    placed = rows.withColumn("_span", F.floor(F.col(line) / SPAN))
    w = Window.partitionBy("_span").orderBy(line)
    ends = placed.groupBy("_span").agg(F.max_by(value, line).alias("_last"))
    carried = ends.select("_span", F.lag("_last").over(Window.orderBy("_span")).alias("_carried"))
    inside = placed.withColumns({"_first": F.row_number().over(w) == 1, "_before": F.lag(value).over(w)})
    return inside.join(carried, "_span").withColumn("previous", F.when(F.col("_first"), F.col("_carried")).otherwise(F.col("_before"))).drop("_span", "_first", "_before", "_carried")


def increasing(rows: DataFrame, line: str, value: str, what: str) -> DataFrame:
    """The same rows; reading one whose value doesn't exceed that of the line before raises."""
    checked = with_previous(rows, line, value)
    bad = F.col(value).isNull() | (F.col("previous") >= F.col(value))
    message = F.concat(F.lit(f"{what}: "), F.coalesce(F.col(value).cast("string"), F.lit("null")), F.lit(" after "), F.coalesce(F.col("previous").cast("string"), F.lit("null")))
    kind = rows.schema[value].dataType
    return checked.withColumn(value, F.when(F.coalesce(bad, F.lit(False)), F.raise_error(message).cast(kind)).otherwise(F.col(value))).select(*rows.columns)


def read_annotations(spark: SparkSession, path: str, dataset: str, key: str = "dataset_id", ordinal: str = "source_record_index") -> DataFrame:
    """A data set's rows of an annotation table, every column as text but the ordinal; ordinals that aren't positive and increasing in the file raise."""
    lines = numbered_lines(spark, path)
    head = lines.where("line = 1").select("value").first()
    names = head[0].split("\t") if head else []
    if missing := {key, ordinal} - set(names):
        raise ValueError(f"columns missing in {path}: {sorted(missing)}")
    f = F.split("value", "\t", -1)
    fields = F.when(F.size(f) == len(names), f).otherwise(F.raise_error(F.concat(F.lit("field count in line "), F.col("line").cast("string"))).cast("array<string>"))
    rows = lines.where("line > 1").withColumn("_f", fields).select("line", *(F.col("_f")[i].alias(n) for i, n in enumerate(names)))
    text: Column = F.col(ordinal)
    number = F.when(text.rlike(r"\A[1-9][0-9]*\z"), text.try_cast("bigint")).otherwise(F.raise_error(F.concat(F.lit("ordinal "), text)).cast("bigint"))
    own = rows.where(F.col(key) == dataset).withColumn(ordinal, number)
    return increasing(own, "line", ordinal, f"ordinals of {dataset} don't increase").drop("line")
