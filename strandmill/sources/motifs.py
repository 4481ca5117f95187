"""Motif files and scan tables of outside tools."""

from __future__ import annotations

import hashlib
import math
import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandmill.functions.identity import canonical
from strandmill.operators.scan import Pwm
from strandmill.sources.text import read_tsv


@dataclass(frozen=True)
class Motif:
    """A model with its exact probability text, which is what is hashed and written again."""

    motif_id: str
    width: int
    nsites: str
    evalue: float | None
    matrix: tuple[tuple[str, ...], ...]

    @property
    def matrix_hash(self) -> str:
        return hashlib.sha256(canonical([self.width, self.nsites, [list(r) for r in self.matrix]])).hexdigest()

    def pwm(self) -> Pwm:
        return Pwm(self.motif_id, tuple(tuple(map(float, r)) for r in self.matrix), float(self.nsites))


def parse_meme(text: str) -> list[Motif]:
    """Motifs in file order; ids are unique, rows have four finite nonnegative numbers of sum 1 within 0.002. An invalid E is none."""
    out: list[Motif] = []
    lines = iter(text.splitlines())
    name = None
    for line in lines:
        if line.startswith("MOTIF "):
            name = line.split()[1]
        elif line.startswith("letter-probability matrix"):
            said = dict(re.findall(r"(\w+)\s*=\s*(\S+)", line))
            width = int(said["w"])
            rows = tuple(tuple(next(lines, "").split()) for _ in range(width))
            for row in rows:
                values = [float(x) for x in row]
                if len(values) != 4 or any(not math.isfinite(v) or v < 0 for v in values) or abs(sum(values) - 1) > 0.002:
                    raise ValueError(f"bad matrix row of {name}: {row}")
            try:
                evalue = float(said.get("E", "nan"))
            except ValueError:
                evalue = math.nan
            if name is None or any(m.motif_id == name for m in out):
                raise ValueError(f"missing or repeated motif id: {name}")
            out.append(Motif(name, width, said.get("nsites", "20"), evalue if math.isfinite(evalue) and evalue >= 0 else None, rows))
    return out


def format_meme(motifs: list[Motif], background: tuple[float, ...] = (0.25, 0.25, 0.25, 0.25)) -> str:
    """The same motifs as text, probabilities as they were given."""
    head = ["MEME version 4", "", "ALPHABET= ACGT", "", "strands: + -", "", "Background letter frequencies", " ".join(f"{b} {v:g}" for b, v in zip("ACGT", background, strict=True)), ""]
    for m in motifs:
        e = "" if m.evalue is None else f" E= {m.evalue:g}"
        head += [f"MOTIF {m.motif_id}", f"letter-probability matrix: alength= 4 w= {m.width} nsites= {m.nsites}{e}", *(" ".join(r) for r in m.matrix), ""]
    return "\n".join(head) + "\n"


def parse_background(text: str) -> tuple[float, ...]:
    """Four positive frequencies of sum 1 within 0.001."""
    found = {a: float(b) for a, b in re.findall(r"^([ACGT])\s+(\S+)", text, re.M)}
    if set(found) != set("ACGT") or min(found.values()) <= 0 or abs(sum(found.values()) - 1) > 0.001:
        raise ValueError("background needs four positive frequencies of sum 1")
    return tuple(found[b] for b in "ACGT")


def background(contigs: DataFrame, pseudo: float = 0.1, both_strands: bool = False) -> tuple[float, ...]:
    """Base frequencies of all sequences with a total pseudocount; pooled over both strands if asked."""
    sums = contigs.agg(*(F.sum(F.regexp_count("sequence", F.lit(b))).alias(b) for b in "ACGT")).first()
    n = {b: float(sums[b] or 0) for b in "ACGT"}
    if both_strands:
        n = {b: n[b] + n[{"A": "T", "T": "A", "C": "G", "G": "C"}[b]] for b in "ACGT"}
    total = sum(n.values()) + pseudo
    return tuple((n[b] + pseudo / 4) / total for b in "ACGT")


def read_occurrences(spark: SparkSession, path: str, motif_ids: list[str] | None = None, windows: DataFrame | None = None) -> DataFrame:
    """A scan table: motif_id, sequence_name, start, stop, strand, score, p (numbers, and text as given), matched_sequence; bad rows raise.

    With windows (window_id), so does a row of a window that isn't there.
    """
    t = read_tsv(spark, path).where(~F.coalesce(F.col("motif_id").startswith("#"), F.lit(False)) & F.col("sequence_name").isNotNull())
    start, stop = F.col("start").try_cast("bigint"), F.col("stop").try_cast("bigint")
    p, score = F.col("`p-value`").try_cast("double"), F.col("score").try_cast("double")
    good = F.coalesce((start >= 1) & (stop >= start) & F.col("strand").isin("+", "-") & (p >= 0) & (p <= 1) & (F.abs(score) < float("inf")), F.lit(False))
    if motif_ids is not None:
        good &= F.col("motif_id").isin(*motif_ids)
    checked = F.when(good, start).otherwise(F.raise_error(F.concat(F.lit("bad occurrence of "), F.coalesce("motif_id", F.lit("?")))).cast("bigint"))
    out = t.select("motif_id", F.col("sequence_name").alias("window_id"), checked.alias("start"), stop.alias("stop"), "strand", score.alias("score"), p.alias("p"), F.col("score").alias("score_text"), F.col("`p-value`").alias("p_text"), F.col("matched_sequence"))
    if windows is None:
        return out
    known = out.join(windows.select("window_id", F.lit(True).alias("_known")).distinct(), "window_id", "left")
    missing = F.raise_error(F.concat(F.lit("bad occurrence in unknown window "), "window_id"))
    return known.withColumn("window_id", F.when(F.col("_known"), F.col("window_id")).otherwise(missing)).select(*out.columns)


def read_similarity(spark: SparkSession, path: str, ids: list[str]) -> DataFrame:
    """A similarity table: query, target, q, overlap; footer rows go, unknown ids raise."""
    t = read_tsv(spark, path).where(~F.coalesce(F.col("Query_ID").startswith("#"), F.lit(True)) & (F.coalesce("Target_ID", F.lit("")) != ""))
    q, n = F.col("`q-value`").try_cast("double"), F.col("Overlap").try_cast("int")
    good = F.coalesce(F.col("Query_ID").isin(*ids) & F.col("Target_ID").isin(*ids) & (q >= 0) & (q <= 1) & (n >= 0), F.lit(False))
    return t.select(F.when(good, F.col("Query_ID")).otherwise(F.raise_error(F.lit("bad similarity row"))).alias("query"), F.col("Target_ID").alias("target"), q.alias("q"), n.alias("overlap"))
