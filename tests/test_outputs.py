"""Files of a group against the driver's writer and plain Python; sets of files that are whole or unreadable."""

import csv
import gzip
import io
import json
import os

import pytest
from pyspark.sql import functions as F

from strandmill.operators import consensus as C
from strandmill.plans import group_outputs as GO
from strandmill.plans import publish as P
from strandmill.plans.freeze import Stale
from strandmill.sources import export as X

ALLELES = "dataset_id string, contig string, ordinal long, gt string, id string, ref string, alt string, pos long, annotation_status string, annotation_reason string, window_id string, interval_start long, interval_end long, best_motif_id string, best_family_id string, best_p double, best_start int, best_stop int, alt_index int, allele string, exclusion_reason string, canonical_pos long, canonical_ref string, canonical_alt string"


def table(path):
    return list(csv.DictReader(io.StringIO(gzip.open(path, "rt", newline="").read()), delimiter="\t"))


def test_group_files(spark, tmp_path):
    names = ["S1", "S,2", "S3"]
    rows = []

    def record(d, ordinal, contig, pos, gt, alts, status="promising"):
        for i, a in enumerate(alts, 1):
            bad = a.startswith("<")
            rows.append((f"d{d}", contig, ordinal, gt, "x\"y", "A", ",".join(alts), pos, status, "", f"w{pos}", pos - 5, pos + 5, "m", "fam", 1e-5, 2, 7, i, a, "symbolic_alt" if bad else "", None if bad else pos, None if bad else "A", None if bad else a))

    for d, gt in enumerate(("0/1", "1/1", "0/0")):
        record(d, 1, "c2", 10, gt, ["C"])
    for d, gt in enumerate(("0/1", "0/1", "2/1")):
        record(d, 2, "c1", 70, gt, ["G", "<DEL>"])
    record(1, 3, "c1", 70, "0/0", ["G"])
    record(0, 4, "c1", 90, "0/1", ["T"], "unclassified")
    alleles = spark.createDataFrame(rows, ALLELES)
    group = GO.Group("g", "other_illumina", tuple((f"d{i}", n, "external") for i, n in enumerate(names)), 2, "0.5", "f" * 64)
    members = spark.createDataFrame([("g", f"d{i}", n, i) for i, n in enumerate(names)], "group_id string, dataset_id string, sample_name string, member_ord int")
    seen = C.observe(C.called(C.record_arrays(alleles)).withColumn("group_id", F.lit("g"))).persist()
    matrix = C.member_matrix(C.candidates(seen), members, C.resolve(seen, ["group_id", "dataset_id", *C.SITE])).persist()
    support = C.group_support(matrix, F.lit(2)).persist()
    sources = spark.createDataFrame([(f"d{i}", "v.vcf", "s" * 4, "a.tsv", "h", "f" * 64) for i in range(3)], "dataset_id string, source_vcf string, source_sha256 string, annotation_path string, annotation_sha256 string, freeze_sha256 string")
    folder, lengths = str(tmp_path / "g"), {"c1": 100, "c2": 50}
    made = GO.write_group(group, support, matrix, seen, alleles, sources, lengths, folder, partitions=2)
    assert sorted(os.listdir(folder)) == sorted([*made["files"], "complete.json"])
    whole = gzip.open(f"{folder}/consensus.vcf.gz", "rt").read()
    assert X.csi(open(f"{folder}/consensus.vcf.gz", "rb").read()) == open(f"{folder}/consensus.vcf.gz.csi", "rb").read()
    body = [x.split("\t") for x in whole.splitlines() if not x.startswith("#")]
    assert [(b[0], b[1], b[4], *b[9:]) for b in body] == [("c1", "70", "G", "0/1", "./.", "./1"), ("c2", "10", "C", "0/1", "1/1", "0/0")]
    assert body[0][7] == "GROUP_N=3;REQUIRED_SUPPORT=2;PROMISING_SUPPORT=2;PROMISING_PERCENT=66.666667;PROMISING_SAMPLES=S1,S3;CONFLICTING_SAMPLES=S%2C2;GT_DISAGREEMENT" and "CONFLICTING_SAMPLES=.;" in body[1][7]
    head = whole.split("#CHROM")[0].splitlines()
    assert head[1:10] == ["##motif_label=prioritization_only", f"##motif_freeze_sha256={'f' * 64}", "##motif_consensus_group=g", "##motif_consensus_fraction=1/2", "##motif_role=other_illumina", "##motif_selection_participant=false", "##motif_evidence_context=external", "##contig=<ID=c1,length=100>", "##contig=<ID=c2,length=50>"]
    kept = table(f"{folder}/support.tsv.gz")
    assert [(r["CHROM"], r["POS"], r["retained"], r["supporting_samples"]) for r in kept] == [("c1", "70", "true", '["S1","S3"]'), ("c1", "90", "false", "[]"), ("c2", "10", "true", '["S1","S,2"]')]
    evidence = table(f"{folder}/member_evidence.tsv.gz")
    assert [(r["CHROM"], r["POS"], r["sample_name"]) for r in evidence] == [(c, p, n) for c, p in (("c1", "70"), ("c1", "90"), ("c2", "10")) for n in names]
    found = {(r["POS"], r["sample_name"]): json.loads(r["source_occurrences"]) for r in evidence}
    assert found["90", "S3"] == [] and [(x["source_record_index"], x["target_presence"], x["target_alt_indexes"]) for x in found["70", "S,2"]] == [("2", "present", [1]), ("3", "absent", [1])]
    one = found["70", "S3"][0]
    assert one["original_ALT_list"] == ["G", "<DEL>"] and one["original_alt_alleles"][1] == {"alt_index": 2, "allele": "<DEL>", "canonical": None, "normalization_status": "excluded", "exclusion_reason": "symbolic_alt"}
    assert one["original_alt_alleles"][0]["canonical"] == ["c1", "70", "A", "G"] and one["source_record_id"] == "d2_ssss_2" and one["original_ID"] == 'x"y'
    assert [(r["sample_name"], r["original_alt"], r["GT"], r["ID"]) for r in table(f"{folder}/excluded_alleles.tsv.gz")] == [("S3", "<DEL>", "2/1", 'x"y')]
    assert P.published(spark, folder, expected={"member_count": 3})["required_support"] == 2
    with pytest.raises(Stale, match="differs"):
        P.published(spark, folder, expected={"member_count": 4})
    assert P.publish_all(spark, str(tmp_path), {"g": {"group_id": "g"}}, {})["count"] == 1


def test_a_set_is_whole_or_unreadable(spark, tmp_path, monkeypatch):
    folder = str(tmp_path)

    def run(text):
        with P.staging(folder) as at:
            for n in "ab":
                open(os.path.join(at, n), "w").write(text * (n == "b"))
            return P.publish(spark, at, folder, ["a", "b"], {"i": "1"}, {}, {"k": 1})

    with pytest.raises(Stale, match="complete"):
        P.published(spark, folder)
    assert run("one") == run("one") == P.published(spark, folder) and sorted(os.listdir(folder)) == ["a", "b", "complete.json"]
    replace, moved = os.replace, []

    def killed(a, b):
        if moved:
            raise KeyboardInterrupt
        moved.append(b)
        replace(a, b)

    monkeypatch.setattr(os, "replace", killed)
    with pytest.raises(KeyboardInterrupt):
        run("two")
    monkeypatch.undo()
    with pytest.raises(Stale, match="complete"):
        P.published(spark, folder)
    run("two")
    for change in ("owt", "longer"):
        (tmp_path / "b").write_text(change)
        with pytest.raises(Stale, match="content|size"):
            P.published(spark, folder)
    big = tmp_path / "c"
    big.write_bytes(bytes(range(256)) * 10)
    assert P.range_hashes(spark, [str(big)], 1000) != P.range_hashes(spark, [str(big)], 999)
