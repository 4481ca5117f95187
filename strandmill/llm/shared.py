"""The folder that driver and executors share, and tables written there to cut lineage."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_own: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where that is unset, one temporary folder per application, in local mode only."""
    conf = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if conf:
        return conf.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = tempfile.mkdtemp(prefix="strandmill-")
        spark.sparkContext.setCheckpointDir(_own[app])
    return _own[app]


def fresh(names: Iterable[str], stem: str) -> str:
    """A column name that none of the names clashes with."""
    taken = {n.lower() for n in names}
    while stem.lower() in taken:
        stem += "_"
    return stem


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """At most so many rows in a batch for Python from now on: two workers share an executor's memory outside the heap."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name, "10000")) <= rows:
        spark.conf.set(name, str(rows))


def write_table(df: DataFrame, tag: str) -> tuple[DataFrame, str]:
    """Write df as Parquet in the shared folder and read it back; a lost executor then costs no recomputation."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{tag}-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(schema).parquet(path), path


def drop_table(spark: SparkSession, path: str) -> None:
    """Delete a table that a later table has replaced."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def release(spark: SparkSession) -> None:
    """Let Spark delete shuffle files that no plan needs any more; it does so when the driver collects its garbage. The driver's own free memory goes back to the system."""
    gc.collect()
    spark._jvm.System.gc()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # of the GNU C library
        trim(0)


def row_key() -> Column:
    """A key of a document's doc_id and text, never null."""
    return F.xxhash64(F.col("doc_id").cast("bigint"), "text")


def spread_join(many: DataFrame, one: DataFrame, key: str, by: str, counted: DataFrame, hot: int = 256) -> DataFrame:
    """many joined with one, whose keys are distinct; the rows of a hot key are dealt by the column `by` to several copies of its partner.

    counted is a stored table with many's keys. A key is hot above `hot` rows and above a ten-thousandth of all rows, so
    at most 10,000 hot keys are broadcast.
    """
    sizes = counted.groupBy(key).agg(F.count("*").alias("rows_of_key"))
    limit = max(hot, counted.count() // 10_000)
    copies = F.broadcast(sizes.where(F.col("rows_of_key") > limit).select(key, F.ceil(F.col("rows_of_key") / limit).cast("int").alias("copies")))
    copy = F.coalesce(F.pmod(F.xxhash64(by), F.col("copies")).cast("int"), F.lit(0))
    dealt = many.join(copies, key, "left").withColumn("copy", copy).drop("copies")
    spread = one.join(copies, key, "left").withColumn("copy", F.explode(F.sequence(F.lit(0), F.coalesce("copies", F.lit(1)) - 1))).drop("copies")
    return dealt.join(spread, [key, "copy"]).drop("copy")


def text_key(column: Column) -> Column:
    """A column as a string that is never null: two values have the same one exactly if they are equal or both null."""
    return F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit(""))


def attach(many: DataFrame, one: DataFrame, key: str, by: str, few: int = 100_000) -> DataFrame:
    """many joined with one, whose keys are distinct and which is broadcast if it has at most `few` rows; else hot keys are
    dealt out. many is a stored table; its keys aren't null."""
    if one.count() <= few:
        return many.join(F.broadcast(one), key)
    return spread_join(many, one, key, by, many)


def range_sorted(df: DataFrame, keys: list[Column], tag: str, part: str = "part", place: str = "place") -> DataFrame:
    """df as a stored table in global order: rows of a smaller `part` come first, within one those of a smaller `place`,
    from 0. No task holds more than one range of the keys, which should be nearly distinct."""
    at = F.monotonically_increasing_id()
    out = df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumns({part: F.shiftright(at, 33).cast("int"), place: at.bitwiseAND(F.lit((1 << 33) - 1))})
    return write_table(out, tag)[0]
