"""Sets of files that appear whole or not at all.

Files are written into a staging folder. publish() removes the set's old marker, moves the files to their names and writes
the marker last; it names every file with its size and hash. Readers refuse a set without a marker, or with a file that
isn't as it says, so a killed run leaves nothing that can be read. Files are hashed on the executors, a range at a time.
"""

from __future__ import annotations

import hashlib
import json
import os
import shutil
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from strandmill.plans.freeze import Stale, file_hash, signature
from strandmill.sources.export import write_json

RANGE = 256 << 20  # bytes that one task hashes


def _digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = []
        for path, at, n in zip(batch["path"], batch["at"], batch["n"]):
            digest = hashlib.sha256()
            with open(path, "rb") as f:
                f.seek(at)
                while n > 0 and (block := f.read(min(n, 1 << 20))):
                    digest.update(block)
                    n -= len(block)
            out.append(digest.hexdigest())
        yield batch.assign(digest=out)[["path", "at", "digest"]]


def range_hashes(spark: SparkSession, paths: list[str], size: int = RANGE) -> dict[str, str]:
    """By path: the hash of the hashes of its ranges. An empty file has one empty range."""
    if not paths:
        return {}
    files = spark.createDataFrame([(p, os.path.getsize(p)) for p in paths], "path string, size long")  # the files of a set
    at = files.select("path", "size", F.explode(F.sequence(F.lit(0), F.greatest(F.col("size") - 1, F.lit(0)), F.lit(size))).alias("at"))
    each = at.withColumn("n", F.least(F.lit(size), F.col("size") - F.col("at"))).repartition("path", "at").mapInPandas(_digests, "path string, at long, digest string")
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "digest"))), lambda x: x["digest"]), "")
    return {r["path"]: r["hash"] for r in each.groupBy("path").agg(F.sha2(F.encode(whole, "UTF-8"), 256).alias("hash")).collect()}


@contextmanager
def staging(folder: str) -> Iterator[str]:
    """A folder beside the published files, gone at the end."""
    path = os.path.join(folder, f".staging-{uuid.uuid4().hex}")
    os.makedirs(path)
    try:
        yield path
    finally:
        shutil.rmtree(path, ignore_errors=True)


def publish(spark: SparkSession, staged: str, folder: str, names: list[str], inputs: dict[str, str], parameters: dict, detail: dict, marker: str = "complete.json") -> dict:
    """Move the staged files to the folder under a new marker; the marker's record. Of the same content, what is there stays."""
    hashes = range_hashes(spark, [os.path.join(staged, n) for n in names])
    files = {n: {"size": os.path.getsize(os.path.join(staged, n)), "hash": hashes[os.path.join(staged, n)]} for n in names}
    record = {"schema_version": 1, "signature": signature(inputs, parameters), "inputs": inputs, "parameters": parameters, "files": files, **detail}
    place = os.path.join(folder, marker)
    try:
        if json.loads(json.dumps(record)) == published(spark, folder, marker):
            return record
    except (Stale, json.JSONDecodeError):
        pass
    if os.path.exists(place):
        os.unlink(place)
    for n in names:
        os.replace(os.path.join(staged, n), os.path.join(folder, n))
    write_json(place, record)
    return record


def published(spark: SparkSession, folder: str, marker: str = "complete.json", expected: dict | None = None) -> dict:
    """The marker's record, if every file is as it says and it holds the expected values."""
    place = os.path.join(folder, marker)
    if not os.path.exists(place):
        raise Stale(f"{folder} isn't complete")
    with open(place) as f:
        record = json.load(f)
    paths = {n: os.path.join(folder, n) for n in record["files"]}
    if wrong := sorted(n for n, p in paths.items() if not os.path.exists(p) or os.path.getsize(p) != record["files"][n]["size"]):
        raise Stale(f"files missing or of another size: {wrong}")
    hashes = range_hashes(spark, list(paths.values()))
    if wrong := sorted(n for n, p in paths.items() if hashes[p] != record["files"][n]["hash"]):
        raise Stale(f"files with other content: {wrong}")
    if wrong := sorted(k for k, v in (expected or {}).items() if record.get(k) != v):
        raise Stale(f"the record differs in {wrong}")
    return record


def publish_all(spark: SparkSession, folder: str, parts: dict[str, dict], parameters: dict, marker: str = "outputs.complete.json") -> dict:
    """A marker over the markers of several sets (folder below: expected values), each checked first."""
    inputs = {}
    for part, expected in sorted(parts.items()):
        published(spark, os.path.join(folder, part), expected=expected)
        inputs[f"{part}/complete.json"] = file_hash(os.path.join(folder, part, "complete.json"))
    record = {"schema_version": 1, "signature": signature(inputs, parameters), "inputs": inputs, "parameters": parameters, "files": {}, "count": len(parts)}
    write_json(os.path.join(folder, marker), record)
    return record
