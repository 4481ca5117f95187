"""Frozen libraries, provenance and reuse of stages by content."""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandmill.functions.identity import canonical
from strandmill.sources.export import write_json


class Stale(ValueError):
    """What was frozen or recorded isn't what is there."""


def file_hash(path: str) -> str:
    digest = hashlib.sha256()
    with open(path, "rb") as f:
        for block in iter(lambda: f.read(1 << 20), b""):
            digest.update(block)
    return digest.hexdigest()


def content_hash(df: DataFrame) -> str:
    """Of a table's rows whatever their order and files: rows hashed on the executors, hashes summed in two halves with the count."""
    row = F.sha2(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}), 256)
    part = lambda at: F.sum(F.conv(F.substring(row, at, 8), 16, 10).cast("decimal(38,0)"))
    r = df.select(row.alias("_r"), *df.columns).agg(F.count("*").alias("n"), *(part(a).alias(f"p{a}") for a in (1, 9, 17, 25, 33, 41, 49, 57))).first()
    return hashlib.sha256(canonical([str(x) for x in r])).hexdigest()


def signature(inputs: dict[str, str], parameters: dict) -> str:
    """Of named input hashes and parameters."""
    return hashlib.sha256(canonical({"inputs": inputs, "parameters": parameters})).hexdigest()


def freeze(directory: str, names: list[str], parameters: dict) -> str:
    """Record the hashes of library files and the thresholds that gave them; the hash of the record."""
    path = os.path.join(directory, "freeze.json")
    write_json(path, {"schema_version": 1, "files": {n: file_hash(os.path.join(directory, n)) for n in names}, "parameters": parameters})
    return file_hash(path)


def verify_freeze(directory: str, parameters: dict | None = None) -> dict:
    """The frozen record, if every file is as it was (and the parameters are these)."""
    with open(os.path.join(directory, "freeze.json")) as f:
        record = json.load(f)
    for name, digest in record["files"].items():
        path = os.path.join(directory, name)
        if not os.path.exists(path) or file_hash(path) != digest:
            raise Stale(f"{name} isn't as frozen")
    if parameters is not None and canonical(record["parameters"]) != canonical(parameters):
        raise Stale("parameters differ from the frozen ones")
    return record


def verify_folds(assignments: DataFrame, again: DataFrame) -> None:
    """A recomputed partition must give the same rows."""
    if content_hash(assignments) != content_hash(again):
        raise Stale("folds differ when they are computed again")


def stage(directory: str, name: str, inputs: dict[str, str], parameters: dict, make: Callable[[str], list[str]]) -> list[str]:
    """Run make(directory) unless its record has this signature and all outputs are as recorded; the paths of the outputs."""
    record_path = os.path.join(directory, f"{name}.provenance.json")
    sign = signature(inputs, parameters)
    if os.path.exists(record_path):
        with open(record_path) as f:
            record = json.load(f)
        if record["signature"] == sign and all(os.path.exists(p) and file_hash(p) == h for p, h in record["outputs"].items()):
            return list(record["outputs"])
    outputs = make(directory)
    write_json(record_path, {"schema_version": 1, "signature": sign, "inputs": inputs, "parameters": parameters, "outputs": {p: file_hash(p) for p in outputs}})
    return outputs


def invalidated(changed: set[str], depends: dict[str, set[str]]) -> set[str]:
    """changed and every stage that depends on it, directly or not."""
    out = set(changed)
    while more := {s for s, on in depends.items() if on & out} - out:
        out |= more
    return out
