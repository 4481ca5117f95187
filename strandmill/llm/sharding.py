"""Sharding by fixed virtual slots, with DataFrame functions only.

A record's key is hashed into one of SLOTS virtual slots, for ever. Bytes are summed per slot (one row per slot, so
at most SLOTS rows whatever the input), and a slot-to-shard map gives each slot a shard. Maps are versioned tables in
the shared folder; rebalancing writes a new version that moves a few slots and leaves the others where they are.

Nulls: a null text has size OVERHEAD; records without a key are dealt by their text. Repeated rows are placed one by one. Extra columns
are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import heapq
import zlib

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandmill.llm.shared import shared_folder, write_table

SLOTS = 8192
OVERHEAD = 16


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(slots)).cast("int")


def slot_sizes(records: DataFrame) -> DataFrame:
    """(vslot, bytes, n) from (vslot, size); partial sums come before the shuffle."""
    return records.groupBy("vslot").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))


def balance(sizes: dict[int, int], shards: int, slots: int = SLOTS) -> list[int]:
    """The first map: largest slots first, each to the shard with fewest bytes."""
    heap = [(0, s) for s in range(shards)]
    out = [0] * slots
    for slot in sorted(range(slots), key=lambda s: (-sizes.get(s, 0), s)):
        load, shard = heapq.heappop(heap)
        out[slot] = shard
        heapq.heappush(heap, (load + sizes.get(slot, 0), shard))
    return out


def rebalance(old: list[int], sizes: dict[int, int], shards: int, slack: float = 0.02) -> list[int]:
    """The next version: slots of shards that are gone, and the smallest slots of shards over the mean by slack, move to the lightest shards."""
    out, load = list(old), [0] * shards
    held: dict[int, list[int]] = {s: [] for s in range(shards)}
    homeless = []
    for slot, shard in enumerate(old):
        if shard < shards:
            load[shard] += sizes.get(slot, 0)
            held[shard].append(slot)
        else:
            homeless.append(slot)
    limit = (sum(sizes.values()) / shards) * (1 + slack)
    for shard, own in held.items():
        own.sort(key=lambda s: (sizes.get(s, 0), s))
        for slot in own:
            if load[shard] <= limit:
                break
            if sizes.get(slot, 0):
                load[shard] -= sizes[slot]
                homeless.append(slot)
    heap = [(b, s) for s, b in enumerate(load)]
    heapq.heapify(heap)
    for slot in sorted(homeless, key=lambda s: (-sizes.get(s, 0), s)):
        b, shard = heapq.heappop(heap)
        out[slot] = shard
        heapq.heappush(heap, (b + sizes.get(slot, 0), shard))
    return out


def map_versions(spark: SparkSession, folder: str) -> list[int]:
    """The versions of the map that are stored whole in the folder, ascending."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    done = [str(f.getPath().getName()) for f in fs.listStatus(path) if fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f.getPath(), "_SUCCESS"))]
    return sorted(int(n[1:]) for n in done if n[:1] == "v" and n[1:].isdigit())


def store_map(spark: SparkSession, folder: str, shard_of: list[int], version: int) -> None:
    """One row per slot: (version, vslot, shard). The map is one literal, so no Python runs on executors."""
    text = ",".join(map(str, shard_of))
    table = spark.range(len(shard_of), numPartitions=1).select(F.lit(version).alias("version"), F.col("id").cast("int").alias("vslot"), F.split(F.lit(text), ",")[F.col("id").cast("int")].cast("int").alias("shard"))
    table.write.mode("overwrite").parquet(f"{folder}/v{version}")


def read_map(spark: SparkSession, folder: str, version: int | None = None) -> DataFrame:
    """A stored version of the map, the last one by default."""
    known = map_versions(spark, folder)
    if not known or version is not None and version not in known:
        raise ValueError(f"no map version {version or 1} in {folder}")
    return spark.read.schema("version int, vslot int, shard int").parquet(f"{folder}/v{version or known[-1]}")


def loads(shard_of: list[int], sizes: dict[int, int], shards: int) -> list[int]:
    out = [0] * shards
    for slot, shard in enumerate(shard_of):
        out[shard] += sizes.get(slot, 0)
    return out


def current_map(spark: SparkSession, folder: str, sizes: dict[int, int], shards: int, slack: float = 0.001) -> DataFrame:
    """The map for these slot sizes: version 1 where the folder has none; else the last one, edited into a new version if
    the number of shards differs or one is over the mean by more than slack and a mean slot. An edit that can't get
    there is replaced by a new deal of all slots."""
    known = map_versions(spark, folder)
    if not known:
        store_map(spark, folder, balance(sizes, shards), 1)
        return read_map(spark, folder)
    old = [r["shard"] for r in read_map(spark, folder).orderBy("vslot").collect()]  # SLOTS rows
    most = sum(sizes.values()) * ((1 + slack) / shards + 1 / len(old))
    fits = lambda m: max(m) < shards and max(loads(m, sizes, shards)) <= most
    if max(old) + 1 != shards or not fits(old):
        new = rebalance(old, sizes, shards, slack)
        store_map(spark, folder, new if fits(new) else balance(sizes, shards), known[-1] + 1)
    return read_map(spark, folder)


def read_sizes(sizes: DataFrame) -> dict[int, int]:
    """At most one row per slot, a fixed number."""
    return {r[0]: r[1] for r in sizes.select("vslot", "bytes").collect()}


def place(records: DataFrame, sizes: DataFrame, slot_map: DataFrame, order: list[str]) -> DataFrame:
    """records with shard and slot (place in the shard, from 0 without gaps).

    Places are numbered within each virtual slot, thousands of them, and shifted by the rows in the shard's earlier
    virtual slots; so no task sees a whole shard.
    """
    before = Window.partitionBy("shard").orderBy("vslot").rowsBetween(Window.unboundedPreceding, -1)
    starts = slot_map.join(F.broadcast(sizes), "vslot").withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0))).select("vslot", "shard", "start")
    rank = F.row_number().over(Window.partitionBy("vslot").orderBy(*order)) - 1
    # One row per virtual slot: SLOTS rows at most are broadcast.
    return records.withColumn("place", rank).join(F.broadcast(starts), "vslot").withColumn("slot", (F.col("start") + F.col("place")).cast("bigint"))


def op8_sharding(spark: SparkSession, sf_dir: str, shards: int = 40) -> DataFrame:
    """All documents in 40 shards of nearly equal bytes, by the last version of this input's slot map."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    text = F.coalesce(F.col("text"), F.lit(""))
    records, _ = write_table(docs.select("doc_id", (F.octet_length(text) + OVERHEAD).cast("bigint").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), slot_of(F.coalesce(F.col("doc_id").cast("bigint"), F.xxhash64(text))).alias("vslot")), "op8-records")
    sizes, _ = write_table(slot_sizes(records), "op8-sizes")
    folder = f"{shared_folder(spark)}/op8-map-{zlib.crc32(sf_dir.rstrip('/').encode()):08x}"
    slot_map = current_map(spark, folder, read_sizes(sizes), shards)
    placed = place(records, sizes, slot_map, ["doc_id", "text_crc32", "size"])
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
