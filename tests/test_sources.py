"""Readers, writers, settings and frozen files."""

import gzip
import json

import pytest
from pyspark.sql import functions as F

from strandmill.operators import consensus as C
from strandmill.plans.config import Config, ConfigError
from strandmill.plans.freeze import Stale, content_hash, freeze, invalidated, stage, verify_freeze
from strandmill.plans.identity_checks import check_identities, group_plan
from strandmill.plans import group_outputs as GO
from strandmill.sources import export as X
from strandmill.sources import motifs as S
from strandmill.sources import text as T
from strandmill.sources.vcf import check_header, read_query_rows, read_vcf, sample_records

HEADER = ["##fileformat=VCFv4.2", "##contig=<ID=c1,length=50>", '##FORMAT=<ID=GT,Number=1,Type=String,Description="g">', "\t".join("#CHROM POS ID REF ALT QUAL FILTER INFO FORMAT A B".split())]
ROWS = ["c1\t1\t.\tA\tC\t.\t.\t.\tDP:GT\t8:0/1\t7:./.", "c1\t9\tx\tAC\tA,T\t.\t.\t.\tGT\t1|2\t0/0", "c1\t12\t.\tG\t.\t.\t.\t.\tDP\t4\t3"]


def test_vcf(spark, tmp_path):
    for name, opener in (("a.vcf", open), ("b.vcf.gz", gzip.open)):
        with opener(tmp_path / name, "wt") as f:
            f.write("\n".join(HEADER + ROWS) + "\n")
        vcf = read_vcf(spark, str(tmp_path / name), {"c1": 50}, ["B"])
        assert vcf.samples == ["A", "B"]
        got = sample_records(vcf, ["B", "A"]).orderBy("ordinal", "sample_name").select("ordinal", "sample_name", "POS", "GT").collect()
        assert [tuple(r) for r in got] == [(1, "A", 1, "0/1"), (1, "B", 1, "./."), (2, "A", 9, "1|2"), (2, "B", 9, "0/0"), (3, "A", 12, "."), (3, "B", 12, ".")]
        body = X.promising_vcf(vcf.header, "B", 1, vcf.records.where("ordinal = 1"), ["##kept=1"])
        assert body.splitlines()[-1] == "c1\t1\t.\tA\tC\t.\t.\t.\tDP:GT\t7:./."
    for bad in ("c1\t0\t.\tA\tC\t.\t.\t.\tGT\t0\t0", "c1\t4\t.\tA\tC\t.\t.\t.\tGT\t0", "c1\t4\t.\tA\tC\t.\t.\t.\tGT\t0:1\t0", "c1\t4\t.\t!\tC\t.\t.\t.\tGT\t0\t0"):
        (tmp_path / "bad.vcf").write_text("\n".join([*HEADER, bad]) + "\n")
        with pytest.raises(Exception, match="record 1"):
            read_vcf(spark, str(tmp_path / "bad.vcf")).records.collect()
    for broken in (HEADER[:2] + HEADER[3:], [*HEADER[:-1], HEADER[-1] + "\tA"]):
        with pytest.raises(ValueError):
            check_header(broken)
    with pytest.raises(ValueError):
        check_header(HEADER, {"c1": 49})


def test_numbered_lines_over_blocks(spark, tmp_path):
    (tmp_path / "big.txt").write_text("".join(f"line {i}\n" for i in range(1, 20_001)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "32k")
    try:
        lines = T.numbered_lines(spark, str(tmp_path / "big.txt"))
        assert spark.read.text(str(tmp_path / "big.txt")).rdd.getNumPartitions() > 1
        assert lines.where(F.concat(F.lit("line "), "line") != F.col("value")).count() == 0 and lines.count() == 20_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_fasta_and_index(spark, tmp_path):
    (tmp_path / "r.fa").write_text(">one first\nacgT\nAC\n\n>two\n>three x\nNN\n")
    got = T.read_fasta(spark, str(tmp_path / "r.fa")).orderBy("ord").collect()
    assert [(r["name"], r["sequence"]) for r in got] == [("one", "ACGTAC"), ("two", ""), ("three", "NN")]
    (tmp_path / "bad.fa").write_text("ACGT\n>one\nA\n")
    with pytest.raises(Exception, match="before the first header"):
        T.read_fasta(spark, str(tmp_path / "bad.fa")).collect()
    (tmp_path / "r.fai").write_text("c2\t50\t0\t1\t2\nc1\t7\t0\t1\t2\n")
    assert [tuple(r)[1:] for r in T.read_fai(spark, str(tmp_path / "r.fai")).orderBy("ord").collect()] == [("c2", 50), ("c1", 7)]
    for text in ("c\t0\n", "c\tx\n", "c\t5\nc\t6\n", "c\n"):
        (tmp_path / "bad.fai").write_text(text)
        with pytest.raises(Exception):
            T.read_fai(spark, str(tmp_path / "bad.fai")).collect()


def test_tsv_bytes(spark, tmp_path):
    df = spark.createDataFrame([("b", 2, True), ("a", None, False)], "n string, v int, f boolean")
    path = str(tmp_path / "t.tsv.gz")
    assert X.write_tsv(df, path, ["n", "v", "f"], ["n"]) and not X.write_tsv(df, path, ["n", "v", "f"], ["n"])
    assert gzip.open(path, "rt").read() == "n\tv\tf\na\t\tfalse\nb\t2\ttrue\n"
    assert [tuple(r) for r in T.read_tsv(spark, path, "v int, n string").orderBy("n").collect()] == [(None, "a"), (2, "b")]
    with pytest.raises(ValueError):
        T.read_tsv(spark, path, "zz int")
    X.write_json(str(tmp_path / "j.json"), {"b": float("inf"), "a": [float("-inf"), "é"]})
    assert (tmp_path / "j.json").read_text() == '{"a":["-Inf","é"],"b":"Inf"}\n'


def test_blocked_gzip(tmp_path):
    body = "".join(f"c{i // 5000}\t{i % 5000 + 1}\t.\tA\tC\t.\t.\t.\n" for i in range(12_000))
    path = str(tmp_path / "x.vcf.gz")
    X.write_bgzf(path, "#head\n" + body)
    assert gzip.open(path, "rt").read() == "#head\n" + body
    index = gzip.open(path + ".csi", "rb").read()
    assert index[:4] == b"CSI\x01" and b"c0\0c1\0c2\0" in index
    data = bytearray(open(path, "rb").read())
    data[40] ^= 1
    with pytest.raises(Exception):
        list(X.bgzf_blocks(bytes(data)))
    with pytest.raises(ValueError):
        list(X.bgzf_blocks(open(path, "rb").read()[:-28]))


MEME = "MEME version 4\n\nMOTIF m1\nletter-probability matrix: alength= 4 w= 2 nsites= 7 E= 0.5\n0.25 0.25 0.25 0.25\n1.0 0 0 0\n\nMOTIF m2\nletter-probability matrix: alength= 4 w= 1 nsites= 7 E= x\n0.5 0.5 0 0\n"


def test_motif_files(spark, tmp_path):
    found = S.parse_meme(MEME)
    assert [(m.motif_id, m.width, m.evalue) for m in found] == [("m1", 2, 0.5), ("m2", 1, None)]
    assert [m.matrix_hash for m in S.parse_meme(S.format_meme(found))] == [m.matrix_hash for m in found]
    for bad in (MEME.replace("m2", "m1"), MEME.replace("0.5 0.5 0 0", "0.5 0.4 0 0"), MEME.replace("1.0 0 0 0", "1.0 0 0")):
        with pytest.raises(ValueError):
            S.parse_meme(bad)
    assert S.parse_background("A 0.3\nC 0.2\nG 0.2\nT 0.3\n") == (0.3, 0.2, 0.2, 0.3)
    contigs = spark.createDataFrame([("AACG",)], "sequence string")
    assert abs(sum(S.background(contigs)) - 1) < 1e-12 and S.background(contigs, both_strands=True)[0] == S.background(contigs, both_strands=True)[3]
    (tmp_path / "f.tsv").write_text("motif_id\tmotif_alt_id\tsequence_name\tstart\tstop\tstrand\tscore\tp-value\tq-value\tmatched_sequence\nm1\t\tw1\t2\t3\t+\t7.5\t1e-5\t\tAC\n")
    assert S.read_occurrences(spark, str(tmp_path / "f.tsv"), ["m1"]).first()["p"] == 1e-5
    with pytest.raises(Exception, match="bad occurrence"):
        S.read_occurrences(spark, str(tmp_path / "f.tsv"), ["other"]).collect()
    windows = spark.createDataFrame([("w1",), ("w1",)], "window_id string")
    assert S.read_occurrences(spark, str(tmp_path / "f.tsv"), ["m1"], windows).count() == 1
    with pytest.raises(Exception, match="unknown window w1"):
        S.read_occurrences(spark, str(tmp_path / "f.tsv"), ["m1"], windows.where("window_id = 'w2'")).collect()
    (tmp_path / "t.tsv").write_text("Query_ID\tTarget_ID\tq-value\tOverlap\nm1\tm2\t0.01\t6\n# done\t\t\t\n")
    assert [tuple(r) for r in S.read_similarity(spark, str(tmp_path / "t.tsv"), ["m1", "m2"]).collect()] == [("m1", "m2", 0.01, 6)]


BASE = {"pacbio_samples": ["p"], "corresponding": {"p": ["i1", "i2"]}}


@pytest.mark.parametrize("change", [{"flank_bp": -1}, {"center_radius_bp": 51}, {"rotations": [1, 2]}, {"shuffle_kmer": 7}, {"min_width": 0}, {"e_max": 0}, {"illumina_ratio_min": 0}, {"min_supported_rotations": 6}, {"require_central": 1}, {"corresponding": {"x": ["i"]}}, {"corresponding": {"p": ["i", "i"]}}, {"unmatched": "x"}, {"grouping_regex": "a"}, {"consensus_fraction": "1.5"}, {"groups": {"g": []}}, {"nonsense": 1}])
def test_config_rejects(change):
    with pytest.raises((ConfigError, ValueError)):
        Config.load(json.dumps(BASE), **change)


def test_config():
    c = Config.load(json.dumps(BASE), groups={"g": ["a", "b"]})
    assert c.scientific() == Config.load(json.dumps(BASE), external_source="elsewhere").scientific() and c.value("corresponding.p") == ("i1", "i2")
    with pytest.raises(ConfigError):
        Config.load('{"flank_bp": 1, "flank_bp": 2}')


def test_freeze_and_reuse(spark, tmp_path):
    (tmp_path / "lib.txt").write_text("motifs")
    freeze(str(tmp_path), ["lib.txt"], {"e": 0.05})
    assert verify_freeze(str(tmp_path), {"e": 0.05})["files"]
    with pytest.raises(Stale):
        verify_freeze(str(tmp_path), {"e": 0.1})
    runs = []

    def make(d):
        runs.append(1)
        (tmp_path / "out").write_text("x")
        return [str(tmp_path / "out")]

    for inputs in ({"a": "1"}, {"a": "1"}, {"a": "2"}):
        stage(str(tmp_path), "s", inputs, {}, make)
    (tmp_path / "out").write_text("tampered")
    stage(str(tmp_path), "s", {"a": "2"}, {}, make)
    assert len(runs) == 3
    (tmp_path / "lib.txt").write_text("other")
    with pytest.raises(Stale):
        verify_freeze(str(tmp_path))
    df = spark.range(100).withColumn("t", F.when(F.col("id") > 3, "x"))
    assert content_hash(df) == content_hash(df.repartition(7)) != content_hash(df.where("id < 99"))
    assert invalidated({"a"}, {"b": {"a"}, "c": {"b"}, "d": {"e"}}) == {"a", "b", "c"}


def test_identities_and_groups():
    assert check_identities(["a"], ["b"]) == "header_names_only"
    assert check_identities(["a"], ["b"], {"a": "1", "b": "2"}) == "explicit_clone_metadata"
    for args in ((["a"], ["a"]), (["a"], ["b"], {"a": "1", "b": "1"}), (["a"], ["b"], {"a": "1"}), (["a"], ["b"], {"b": "2", "z": "3"})):
        with pytest.raises(ValueError):
            check_identities(*args)
    plan = group_plan({"g": list("abcdef")}, dict.fromkeys("abcdef", "other_illumina"), "0.75")
    assert plan[0]["required_support"] == 5


def test_six_member_consensus(spark):
    """Fixed denominators: five of six carriers are kept at 0.75, four aren't; conflicts and missing calls stay evidence."""
    calls = {3: ["0/1"] * 5 + ["0/0"], 4: ["0/1"] * 4 + ["0/0"] * 2, 5: ["0/1"] * 5 + ["0/1", "0/0"], 6: ["0/1"] * 4 + ["./."] + ["0/1", "0/0"]}
    rows = []
    for pos, gts in calls.items():
        for i, gt in enumerate(gts):
            m = min(i, 5)
            rows.append((f"d{m}", "c1", pos * 10 + i, gt, "A", pos, "promising", 1, "C", "", pos, "A", "C"))
    alleles = spark.createDataFrame(rows, "dataset_id string, contig string, ordinal long, gt string, ref string, pos long, annotation_status string, alt_index int, allele string, exclusion_reason string, canonical_pos long, canonical_ref string, canonical_alt string")
    names = [*(f"OTHER-{i + 1}" for i in range(5)), "OTHER,6"]
    members = spark.createDataFrame([("g", f"d{i}", n, i) for i, n in enumerate(names)], "group_id string, dataset_id string, sample_name string, member_ord int")
    seen = C.observe(C.called(C.record_arrays(alleles)).withColumn("group_id", F.lit("g")))
    matrix = C.member_matrix(C.candidates(seen), members, C.resolve(seen, ["group_id", "dataset_id", *C.SITE]))
    support = C.group_support(matrix, F.lit(5))
    got = {r["canonical_pos"]: r for r in support.collect()}
    assert {p: (r["support_count"], r["retained"], r["support_percent"], r["group_n"]) for p, r in got.items()} == {3: (5, True, "83.333333", 6), 4: (4, False, "66.666667", 6), 5: (5, True, "83.333333", 6), 6: (4, False, "66.666667", 6)}
    assert got[5]["genotype_disagreement"] and got[5]["conflicting_samples"] == '["OTHER,6"]'
    group = GO.Group("g", "other_illumina", tuple((f"d{i}", n, "x") for i, n in enumerate(names)), 5, "3/4", "")
    lines = GO.consensus_lines(support, matrix, {"c1": 100}, group).orderBy("contig_ord", "pos", "ref", "alt").collect()
    text = GO.consensus_head(group, {"c1": 100}).decode() + "".join(r["body"].decode() for r in lines)
    body = [x.split("\t") for x in text.splitlines() if not x.startswith("#")]
    assert [b[1] for b in body] == ["3", "5"] and "CONFLICTING_SAMPLES=OTHER%2C6" in body[1][7] and "GT_DISAGREEMENT" in body[1][7] and body[0][9:] == ["0/1"] * 5 + ["0/0"] or body[0][14] == "."


def test_query_rows(spark, tmp_path):
    (tmp_path / "q.tsv").write_text("c\t5\t.\tA\tC\t0/1\nc\t6\tx\tA\t\t\n")
    assert [tuple(r) for r in read_query_rows(spark, str(tmp_path / "q.tsv")).orderBy("line").collect()] == [(1, "c", 5, ".", "A", "C", "0/1"), (2, "c", 6, "x", "A", "", "")]
    for bad in ("c\t5\t.\tA\tC\n", "c\t5\t.\tA\tC\t0/1\t\n", "\n"):
        (tmp_path / "q.tsv").write_text(bad)
        with pytest.raises(Exception, match="malformed query stream"):
            read_query_rows(spark, str(tmp_path / "q.tsv")).collect()
