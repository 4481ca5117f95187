"""A small planted genome from files to consensus."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from strandmill.operators.context import add_windows
from strandmill.operators.scan import ScoringTable, scan_sequence
from strandmill.operators.shuffle import shuffle_letters
from strandmill.plans import workflow as W
from strandmill.plans.config import Config
from strandmill.sources.motifs import background
from strandmill.sources.vcf import read_vcf


@pytest.fixture(scope="module")
def genome(tmp_path_factory):
    rng = random.Random(187)
    folder = tmp_path_factory.mktemp("genome")
    contigs = {}
    for c in range(5):
        s = [rng.choice("ACGT") for _ in range(4000)]
        for p in range(200, 3800, 100):
            s[p - 4 : p + 4] = "GATTACAC"
        contigs[f"seg_{c}"] = "".join(s)
    (folder / "r.fa").write_text("".join(f">{n} x\n{s[:1999]}\n{s[1999:].lower()}\n" for n, s in contigs.items()))
    head = ["##fileformat=VCFv4.2", '##FORMAT=<ID=GT,Number=1,Type=String,Description="g">', "\t".join("#CHROM POS ID REF ALT QUAL FILTER INFO FORMAT P1 I1 I2 X1 X2".split())]
    rows = []
    for n, s in contigs.items():
        for p in [10, *range(201, 3801, 100), 3990]:
            ref = s[p - 1]
            alt = "ACGT"["ACGT".index(ref) - 1]
            last = "./." if p % 400 == 1 else "0/1"
            rows.append("\t".join([n, str(p), ".", ref, alt, ".", ".", ".", "GT", "0/1", "1/1", "0/1", "0/1", last]))
    (folder / "v.vcf").write_text("\n".join(head + rows) + "\n")
    return folder, contigs


def test_workflow(spark, genome):
    folder, sequences = genome
    config = Config(pacbio_samples=("P1",), corresponding={"P1": ("I1", "I2")}, flank_bp=30, min_width=7, max_width=7, min_overlap_bp=5, p_threshold=1e-3, min_supported_rotations=3)
    contigs = W.load_contigs(spark, str(folder / "r.fa")).persist()
    assert {r["contig"]: r["sequence"] for r in contigs.collect()} == sequences
    pb = W.prepare(spark, contigs, str(folder / "v.vcf"), "pacbio", ["P1"], config, "ref")
    il = W.prepare(spark, contigs, str(folder / "v.vcf"), "illumina", ["I1", "I2"], config, "ref")
    both = pb.unionByName(il).persist()
    for r in both.limit(50).collect():
        assert r["eligible"] == (r["pos"] > 30 and r["pos"] + 30 <= 4000)
        assert r["window_sequence"] == (sequences[r["contig"]][r["pos"] - 31 : r["pos"] + 30] if r["eligible"] else None)
    assert {r[0] for r in both.select("fold_id").distinct().collect()} == {1, 2, 3, 4, 5}
    models = W.discover_models(pb.where("fold_id <= 5"), config, 1)
    assert len(models) == 5
    letters = background(contigs)
    best, totals = (x.persist() for x in W.evaluation(both, models, config, letters))
    metrics = W.model_metrics(best, totals, models, config).persist()
    kept = W.transferable(metrics, models, config)
    assert len(kept) >= 3
    families = W.model_families(kept, config)
    library = W.select_library(kept, metrics, families, W.family_coverage(families, kept, best, totals, config), config)
    assert library and library[0][2] == 1
    word = "".join("ACGT"[max(range(4), key=c.__getitem__)] for c in library[0][0].pwm.matrix)
    assert word in "GATTACAC" or word in "GTGTAATC"
    ext = W.prepare(spark, contigs, str(folder / "v.vcf"), "other_illumina", ["X1", "X2"], config, "ref")
    annotated = W.apply_library(ext, [(m.pwm, f, r) for m, f, r in library], config, letters).persist()
    counts = {(r["annotation_status"], r["annotation_reason"]): r["count"] for r in annotated.groupBy("annotation_status", "annotation_reason").count().collect()}
    assert counts["promising", ""] > 250 and counts["not_scanned", "boundary_window"] == 20 and counts["not_applicable", "missing_gt"] == 45
    assert W.apply_library(ext, [], config).where("annotation_reason = 'no_selected_motifs'").count() > 250
    members = annotated.select(F.lit("g").alias("group_id"), "dataset_id", "sample_name").distinct().withColumn("member_ord", F.substring("sample_name", 2, 1).cast("int"))
    support, matrix = W.group_consensus(annotated, contigs, members, 2)
    got = support.groupBy("support_count", "retained").count().collect()
    assert {(r["support_count"], r["retained"]) for r in got} <= {(0, False), (1, False), (2, True)} and sum(r["count"] for r in got) == 5 * 38
    assert matrix.count() == 2 * 5 * 38


def test_library_holds_validated_matrices_only(spark):
    config = Config(pacbio_samples=("P1", "P2"), corresponding={"P1": ("I1", "I2"), "P2": ("I3", "I4")}, min_supported_rotations=1, support_fraction=0.5)
    samples = ["P1", "I1", "I2", "P2", "I3", "I4"]
    # Per model: word, where it was found, ratio, and the samples without any hit.
    planted = {
        "a": ("GATTACACCA", "P1", 2.0, ""), "b": ("GATTACACCA", "P2", 9.0, "I1 I2"),
        "c": ("CCGTGCGAGG", "P1", 9.0, "I3 I4"), "d": ("CCGTGCGAGG", "P2", 9.0, "I1 I2"),
        "e": ("TTTGTCTATT", "P1", 5.0, "I2 I4"), "f": ("TTTGTCTATT", "P2", 4.0, "I1 I3"),
    }
    models = [W.Model(i, s, 1, 1e-9, W.Pwm(i, tuple(tuple(0.97 if x == y else 0.01 for y in "ACGT") for x in w), 50.0)) for i, (w, s, _, _) in planted.items()]
    rows = [(i, s, 1, None if s in lost else ratio, None if s in lost else 0.1, 0.1, 0.2) for i, (_, _, ratio, lost) in planted.items() for s in samples]
    metrics = spark.createDataFrame(rows, "motif_id string, sample_name string, rotation int, coverage_ratio double, coverage_difference double, central_difference double, real_coverage double")
    families = W.model_families(models, config)
    assert sorted(tuple(f["members"]) for f in families) == [("a", "b"), ("c", "d"), ("e", "f")]
    # The union of a family's members in a group is here its one member found there.
    own = {(f["family_id"], i): planted[i][1] for f in families for i in f["members"]}
    cover = [(f, g, 1, s, s == g, 2, 1, *next(r[3:] for r in rows if r[0] == i and r[1] == s)) for (f, i), g in own.items() for s in (g, *config.corresponding[g])]
    coverage = spark.createDataFrame(cover, "family_id string, group_id string, rotation int, sample_name string, own boolean, configured long, members long, coverage_ratio double, coverage_difference double, central_difference double, real_coverage double")
    coverage = coverage.withColumn("support", F.coalesce((F.col("coverage_ratio") > 1) & (F.col("coverage_difference") > 0), F.lit(False)))
    # b is stronger than a but fails in P1's group; c and d each fail in the other's; half the votes of e and f rank them below a.
    assert [(m.motif_id, rank) for m, _, rank in W.select_library(models, metrics, families, coverage, config)] == [("a", 1), ("e", 2)]


def test_family_evidence_is_that_of_the_union(spark):
    """Against plain Python, where the union of two members passes and neither does by itself."""
    config = Config(pacbio_samples=("P",), corresponding={"P": ("I", "J")}, flank_bp=10, center_radius_bp=3, min_supported_rotations=1, support_fraction=0.5, pacbio_ratio_min=1.5, illumina_ratio_min=1.5)
    model = lambda i, r: W.Model(i, "P", r, 1e-9, W.Pwm(i, ((0.25,) * 4,) * 6, 9.0))
    models = [model("a", 1), model("b", 1), model("c", 2), model("z", 1)]
    families = [{"family_id": "fam_1", "members": ["a", "b", "c"]}, {"family_id": "fam_2", "members": ["z"]}]
    rng, hits = random.Random(4), []
    for s in ("P", "I", "J"):
        for k in range(30):
            # Each of a and b hits 8 real and 6 control windows: 1.33 times; together 16 and 6.
            for m, real in (("a", range(8)), ("b", range(8, 16)), ("c", range(0))):
                r = 2 if m == "c" else 1
                hits += [("real", m, s, r, f"w{k}", (at := rng.randint(1, 15)), at + 5, "+-"[k % 2], 1.0 * k, 1e-5 * rng.randint(1, 3))] * (k in real) + [("control", m, s, r, f"w{k}", (at := rng.randint(1, 15)), at + 5, "+", 1.0, 1e-5 * rng.randint(1, 3))] * (k < 6 and m != "c")
    best = spark.createDataFrame(hits, "kind string, motif_id string, sample_name string, rotation int, window_id string, start int, stop int, strand string, score double, p double")
    totals = spark.createDataFrame([(s, r, 30) for s in ("P", "I", "J") for r in (1, 2, 3)], "sample_name string, rotation int, n_windows long")
    alone = {(r["motif_id"], r["sample_name"]): r["coverage_ratio"] for r in W.model_metrics(best, totals, models, config).where("rotation = 1").collect()}
    assert all(abs(alone[m, s] - 8 / 6) < 1e-9 for m in "ab" for s in "PIJ")
    rows = W.family_coverage(families, models, best, totals, config).persist()
    assert rows.count() == 2 * 5 * 3
    for r in rows.collect():
        own = [h for h in hits if h[2] == r["sample_name"] and h[3] == r["rotation"] and h[1] in next(f["members"] for f in families if f["family_id"] == r["family_id"])]
        win = {}
        for h in own:
            key = (h[9], h[1], -h[8], h[5], h[6], h[7] != "+")
            if (h[0], h[4]) not in win or key < win[h[0], h[4]][0]:
                win[h[0], h[4]] = (key, abs((h[5] + h[6]) / 2 - 11) <= 3)
        real, control = ([v[1] for k, v in win.items() if k[0] == kind] for kind in ("real", "control"))
        n = 30 if r["rotation"] <= 3 else 0
        assert (r["real_hits"], r["control_hits"], r["n_windows"], r["members"]) == (len(real), len(control), n, sum(m.rotation == r["rotation"] and m.motif_id in next(f["members"] for f in families if f["family_id"] == r["family_id"]) for m in models))
        assert not real or abs(r["real_central_proportion"] - sum(real) / len(real)) < 1e-9
        assert r["support"] == (r["family_id"] == "fam_1" and r["rotation"] == 1)
    groups, required, components = W.family_components(rows, config)
    assert [(r["family_id"], r["rotation"]) for r in groups.where("support").collect()] == [("fam_1", 1)] and [tuple(r) for r in required.collect()] == [("fam_1", "P")]
    c = components.collect()[0]
    # Ratios: 16 / 6 in one rotation, null in the four without hits; differences: 1 / 3, 0, 0, and two without windows.
    assert (c["stable_clones"], c["min_supported_rotations"], c["min_fraction"]) == (1, 1, 1.0) and abs(c["weakest_ratio"] - 16 / 6) < 1e-9 and abs(c["pooled_ratio"] - 16 / 6) < 1e-9
    assert c["weakest_difference"] == 0 and abs(c["mean_coverage"] - 16 / 30 / 3) < 1e-9


def test_controls_have_the_seed_of_their_sample_and_rotation(spark):
    config = Config(pacbio_samples=("P",), corresponding={"P": ("I",)}, flank_bp=10, p_threshold=0.9, seed_overrides=(("illumina", "I", 2, "test_shuffle", 77), ("pacbio", "P", 1, "streme", 5), ("pacbio", "P", 1, "train_shuffle", 5)))
    seeds = W.seeds(config)
    assert seeds["I", 2, "test_shuffle"] == 77 and seeds["P", 1, "streme"] == seeds["P", 1, "train_shuffle"] == 5
    for bad in ((("pacbio", "P", 1, "streme", 5), ("pacbio", "P", 2, "streme", 5)), (("pacbio", "P", 1, "streme", 0),), (("pacbio", "P", 1, "streme"),)):
        with pytest.raises(ValueError):
            Config(pacbio_samples=("P",), corresponding={"P": ("I",)}, seed_overrides=bad)
    rng = random.Random(8)
    text = ["".join(rng.choice("ACGT") for _ in range(21)) for _ in range(6)]
    records = spark.createDataFrame([(f"w{i}", t, s, f, "0/1", True, "c", i) for i, t in enumerate(text) for s in "PI" for f in (1, 2)], "window_id string, window_sequence string, sample_name string, fold_id int, gt string, eligible boolean, contig string, pos long")
    pwm = W.Pwm("m", ((0.7, 0.1, 0.1, 0.1), (0.1, 0.7, 0.1, 0.1), (0.1, 0.1, 0.7, 0.1)), 50.0)
    models = [W.Model(f"m{r}", "P", r, 1e-9, W.Pwm(f"m{r}", pwm.matrix, pwm.nsites)) for r in (1, 2)]
    letters = (0.4, 0.1, 0.1, 0.4)
    best, totals = W.evaluation(records, models, config, letters)
    got = {(r["kind"], r["motif_id"], r["sample_name"], r["window_id"]): (r["start"], r["strand"], round(r["score"], 9)) for r in best.collect()}
    table = ScoringTable(pwm, letters)
    assert len(got) == 48, sorted(got)
    for i, t in enumerate(text):
        for m in models:
            for s in "PI":
                own = int.from_bytes(hashlib.sha256(f"{seeds[s, m.rotation, 'test_shuffle']}|{m.rotation}|w{i}|{s}".encode()).digest()[:8], "big")
                for kind, sequence in (("real", t), ("control", shuffle_letters(t, config.shuffle_kmer, own))):
                    start, strand, score, p = min(scan_sequence(sequence, table, 0.9), key=lambda h: (-h[2], h[3], h[0], h[1] != "+"))
                    assert got.pop((kind, m.motif_id, s, f"w{i}")) == (start, strand, round(score, 9))
    assert not got and {tuple(r) for r in totals.collect()} == {(s, f, 6) for s in "PI" for f in (1, 2)}


def test_broken_inputs(spark, genome, tmp_path):
    folder, _ = genome
    config = Config(pacbio_samples=("P1",), corresponding={"P1": ("I1",)}, flank_bp=30)
    contigs = W.load_contigs(spark, str(folder / "r.fa"))
    text = (folder / "v.vcf").read_text().split("\n")
    f = text[3].split("\t")
    for change in ({3: "N"}, {9: "0/7"}, {0: "nowhere"}):
        row = [change.get(i, x) for i, x in enumerate(f)]
        (tmp_path / "b.vcf").write_text("\n".join([*text[:3], "\t".join(row)]) + "\n")
        with pytest.raises(Exception, match="REF differs|malformed GT|unknown contig"):
            W.prepare(spark, contigs, str(tmp_path / "b.vcf"), "pacbio", ["P1"], config, "ref").collect()
    with pytest.raises(ValueError):
        read_vcf(spark, str(folder / "v.vcf"), required=["nobody"])
    strange = contigs.withColumn("sequence", F.concat(F.substring("sequence", 1, 3900), F.repeat(F.lit("Z"), 100)))
    with pytest.raises(Exception, match="foreign letters|REF differs"):
        W.prepare(spark, strange, str(folder / "v.vcf"), "pacbio", ["P1"], config, "ref").collect()
    within = contigs.withColumn("sequence", F.concat(F.substring("sequence", 1, 210), F.lit("Z"), F.expr("substring(sequence, 212)")))
    with pytest.raises(Exception, match="foreign letters"):
        W.prepare(spark, within, str(folder / "v.vcf"), "pacbio", ["P1"], config, "ref").collect()


def test_chunks_give_the_same_windows(spark, genome):
    folder, sequences = genome
    contigs = W.load_contigs(spark, str(folder / "r.fa"))
    records = spark.createDataFrame([(c, p, s[p - 1 : p + 1]) for c, s in sequences.items() for p in (1, 31, 64, 65, 1000, 3969, 3970, 3971, 4000)], "contig string, pos long, ref string")
    for chunk in (64, 1000, 1 << 16):
        for r in add_windows(records, contigs, 30, "ref", chunk).collect():
            s, p = sequences[r["contig"]], r["pos"]
            assert r["ref_agrees"] and r["window_sequence"] == (s[p - 31 : p + 30] if 31 <= p <= 3970 else None)
