"""The whole run from files, and what it uses again."""

import csv
import gzip
import os

import pytest

from strandmill.operators.guards import read_annotations
from strandmill.plans import run as R
from strandmill.plans.config import Config
from strandmill.plans.freeze import Stale
from strandmill.plans.publish import published
from tests.test_workflow import genome  # noqa: F401


def test_run_from_files(spark, genome, tmp_path, monkeypatch):  # noqa: F811
    files, _ = genome
    settings = dict(pacbio_samples=("P1",), corresponding={"P1": ("I1", "I2")}, flank_bp=30, min_width=7, max_width=7, min_overlap_bp=5, p_threshold=1e-3, min_supported_rotations=3, e_max=1e-20)
    vcf, out = str(files / "v.vcf"), str(tmp_path)
    inputs = R.Inputs(str(files / "r.fa"), vcf, vcf, vcf, ("X1", "X2"))
    record = R.run(spark, inputs, Config(**settings, groups={"g": ("X1", "X2")}), out, partitions=2)
    names = {s: R.dataset(role, s) for role, s in (("pacbio", "P1"), ("illumina", "I1"), ("illumina", "I2"), ("other_illumina", "X1"), ("other_illumina", "X2"))}
    assert record["count"] == 6 and published(spark, f"{out}/vcf_outputs", "outputs.complete.json")["signature"] == record["signature"]
    source = [x.split("\t") for x in open(vcf).read().splitlines() if not x.startswith("##")]
    for sample, did in names.items():
        rows = list(csv.DictReader(gzip.open(f"{out}/vcf_outputs/{did}/annotations.tsv.gz", "rt", newline=""), delimiter="\t"))
        assert [r["source_record_index"] for r in rows] == [str(i) for i in range(1, len(source))]
        assert read_annotations(spark, f"{out}/vcf_outputs/{did}/annotations.tsv.gz", did).count() == len(rows)
        promising = [int(r["source_record_index"]) for r in rows if r["annotation_status"] == "promising"]
        assert promising
        body = [x.split("\t") for x in gzip.open(f"{out}/vcf_outputs/{did}/promising.vcf.gz", "rt").read().splitlines() if not x.startswith("##")]
        at = source[0].index(sample)
        assert body == [[*source[i][:9], source[i][at]] for i in [0, *promising]]
    group = f"{out}/vcf_outputs/groups/g"
    sites = [x for x in gzip.open(f"{group}/consensus.vcf.gz", "rt").read().splitlines() if not x.startswith("#")]
    assert sites and published(spark, group)["member_dataset_ids"] == [names["X1"], names["X2"]]
    # The same selection and other groups: the library is used again, and the group's files are of the new group.
    before = os.stat(f"{out}/library/library.meme").st_mtime_ns
    monkeypatch.setattr(R, "select", lambda *a: pytest.fail("selected again"))
    again = R.run(spark, R.Inputs(str(files / "r.fa"), vcf, vcf, vcf, ("X1",)), Config(**settings, groups={"h": ("X1",)}), out, partitions=2)
    assert again["count"] == 5 and os.stat(f"{out}/library/library.meme").st_mtime_ns == before
    with pytest.raises(ValueError, match="took part"):
        R.run(spark, R.Inputs(str(files / "r.fa"), vcf, vcf, vcf, ("I1",)), Config(**settings), out)
    (tmp_path / "library" / "ranks.tsv").write_text("x\n")
    with pytest.raises(Stale):
        published(spark, f"{out}/library")
