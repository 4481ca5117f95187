"""The executors' sink against the driver's: the same bytes whatever the partitions."""

import gzip
import os
import random

import pytest
from pyspark.sql import functions as F

from strandmill.sources import export as X
from strandmill.sources import ordered as O
from strandmill.sources.vcf import read_vcf


def calls(n, seed=1):
    rng, out = random.Random(seed), []
    for contig in ("c2", "c1", "c10"):
        pos = 1
        for _ in range(n):
            pos += rng.choice((0, 1, 50, 9000))
            ref = "A" * rng.choice((1, 1, 1, 5, 20000 if rng.random() < 0.01 else 2))
            out.append(f"{contig}\t{pos}\t.\t{ref}\tC\t.\t.\tX={rng.random()}\tGT\t0/1")
    return out


def frame(spark, lines):
    rows = spark.createDataFrame(list(enumerate(lines)), "n long, line string")
    return rows.select("n", O.line_body(F.col("line")).alias("body")).orderBy(F.rand(3))


@pytest.mark.parametrize("n,parts,segment", [(0, 2, O.SEGMENT), (3000, 1, O.SEGMENT), (3000, 5, 1000)])
def test_blocked_file_and_index_equal_the_drivers(spark, tmp_path, n, parts, segment):
    lines, head = calls(n), "##head\n#CHROM\tPOS\n"
    text = head + "".join(f"{x}\n" for x in lines)
    path, data = str(tmp_path / "a.vcf.gz"), X.bgzf(text.encode())
    assert O.write_blocked(frame(spark, lines), path, ["n"], head.encode(), index=True, partitions=parts, segment=segment)
    assert open(path, "rb").read() == data
    assert open(path + ".csi", "rb").read() == X.csi(data)
    assert not O.write_blocked(frame(spark, lines), path, ["n"], head.encode(), partitions=parts)
    assert sorted(os.listdir(tmp_path)) == ["a.vcf.gz", "a.vcf.gz.csi"]


def test_text_that_ends_with_a_block(spark, tmp_path):
    lines = ["c\t1\t.\tA\t" + "C" * (O.BLOCK - 10), "c\t2\t.\tA\t" + "C" * (O.BLOCK - 10)]
    lines = [x + "G" * (O.BLOCK - 1 - len(x)) for x in lines]
    data = X.bgzf("".join(f"{x}\n" for x in lines).encode())
    path = str(tmp_path / "a.vcf.gz")
    O.write_blocked(frame(spark, lines), path, ["n"], index=True, partitions=3)
    assert open(path, "rb").read() == data and open(path + ".csi", "rb").read() == X.csi(data)


def test_contigs_that_stand_apart_raise(spark, tmp_path):
    lines = ["a\t1\t.\tA\tC", "b\t1\t.\tA\tC", "a\t2\t.\tA\tC"]
    with pytest.raises(ValueError, match="sorted by contig"):
        O.write_blocked(frame(spark, lines), str(tmp_path / "a.vcf.gz"), ["n"], index=True, partitions=2)


def test_tables_fasta_and_samples(spark, tmp_path):
    rows = [(i % 7, None if i % 3 else "xé", i % 2 == 0) for i in range(200)]
    df = spark.createDataFrame(rows, "a long, b string, c boolean")
    fields = ["a", "b", "c"]
    expected = "a\tb\tc\n" + "".join(sorted((f"{a}\t{b or ''}\t{str(c).lower()}\n" for a, b, c in rows), key=lambda x: x.encode()))
    for name in ("t.tsv", "t.tsv.gz"):
        O.write_tsv(df, str(tmp_path / name), fields, fields, partitions=3)
        raw = open(tmp_path / name, "rb").read()
        assert (gzip.decompress(raw) if name.endswith("gz") else raw).decode() == expected
    windows = spark.createDataFrame([("w2", "AC", 1), ("w1", "GG", 0), ("w3", "TT", None)], "window_id string, sequence string, fold int")
    train, test = O.write_train_test(windows, F.col("fold") == 0, str(tmp_path))
    assert open(train).read() == ">w2\nAC\n" and open(test).read() == ">w1\nGG\n"
    X.write_fasta(windows.where("fold is not null"), str(tmp_path / "x.fasta"))
    O.write_fasta(windows.where("fold is not null"), str(tmp_path / "y.fasta"))
    assert open(tmp_path / "x.fasta").read() == open(tmp_path / "y.fasta").read()
    body = "##FORMAT=<ID=GT,Number=1,Type=String,Description=\"g\">\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tA\tB\n" + "".join(f"c\t{i + 1}\t.\tA\tC\t.\t.\t.\tGT:DP\t0/1:3\t1/1:{i}\n" for i in range(50))
    (tmp_path / "in.vcf").write_text(body)
    vcf = read_vcf(spark, str(tmp_path / "in.vcf"))
    O.write_promising_vcf(vcf.header, "B", 1, vcf.records.where("ordinal % 2 = 1"), str(tmp_path / "B.vcf.gz"), ["##kept=1"])
    assert gzip.decompress(open(tmp_path / "B.vcf.gz", "rb").read()).decode() == X.promising_vcf(vcf.header, "B", 1, vcf.records.where("ordinal % 2 = 1"), ["##kept=1"])


def test_a_failed_write_leaves_the_old_file(spark, tmp_path):
    path = str(tmp_path / "a.txt")
    O.write_ordered(frame(spark, ["old"]), path, ["n"])
    bad = spark.createDataFrame([(1, bytearray(b"x\n")), (2, None)], "n long, body binary")
    with pytest.raises(Exception, match="without a body"):
        O.write_ordered(bad, path, ["n"])
    assert open(path).read() == "old\n" and os.listdir(tmp_path) == ["a.txt"]
