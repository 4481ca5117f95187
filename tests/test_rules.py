"""Truth tables of genotypes, rules, scans and controls."""

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandmill.functions import genotype as G
from strandmill.functions import identity as ids
from strandmill.functions import rules as R
from strandmill.operators import alleles as A
from strandmill.operators import families as M
from strandmill.operators.alleles import left_align, normalise
from strandmill.operators.consensus import observe, resolve
from strandmill.operators import discover as D
from strandmill.operators import folds as FO
from strandmill.operators.folds import assign_folds
from strandmill.operators.scan import Pwm, ScoringTable, pwm_hits, scan_codes, scan_sequence
from strandmill.operators.shuffle import shuffle_letters, shuffled
from strandmill.plans import driver_views as V
from strandmill.plans import queries as Q


def one(spark, expr, **values):
    row = spark.createDataFrame([tuple(values.values())], list(values)) if values else spark.range(1)
    return row.select(expr.alias("x")).first()["x"]


@pytest.mark.parametrize(("gt", "status"), [("1/.", "alt"), ("0/1", "alt"), ("1|2/.", "alt"), ("2", "alt"), ("0/.", "reference_only"), (".", "missing"), ("3/0", None), ("-1", None), ("0//1", None), ("1x2", None), ("", None), ("0/1\n", None)])
def test_parse_gt(spark, gt, status):
    got = one(spark, G.parse_gt(F.col("gt"), F.lit(2)), gt=gt)
    assert (got and got["gt_status"]) == status


@pytest.mark.parametrize(("gt", "targets", "expected"), [("0/2", [1], "0/."), ("0|2/1", [1], "0|./1"), ("1/2", [1, 2], "1/1"), (".", [1], "."), ("./.", [1], "./."), ("0/0", [1], "0/0"), ("1", [1], "1")])
def test_project_gt(spark, gt, targets, expected):
    assert one(spark, G.project_gt(F.col("gt"), F.array(*map(F.lit, targets))), gt=gt) == expected


@pytest.mark.parametrize(("ref", "alt", "reason"), [("A", "<NON_REF>", "unspecified_alt"), ("A", "<*>", "unspecified_alt"), ("A", "*", "spanning_deletion"), ("A", "<DEL>", "symbolic_alt"), ("A", "A[chr1:2[", "breakend_alt"), ("A", "]chr1:2]A", "breakend_alt"), ("A", "A[chr1:2[A", None), ("A", ".A", "breakend_alt"), ("A", "N", "ambiguous_sequence"), ("A", "c", ""), ("A", "Q", None), ("", "A", None)])
def test_exclusion_reason(spark, ref, alt, reason):
    assert one(spark, G.exclusion_reason(F.col("r"), F.col("a")), r=ref, a=alt) == reason


def test_thresholds(spark):
    n = spark.range(1, 41).select("id", R.ceil_float(0.28, F.col("id")).alias("f"), R.ceil_rational("0.28", F.col("id")).alias("r")).collect()
    assert {x["id"]: (x["f"], x["r"]) for x in n}[25] == (8, 7)
    assert all(x["r"] == -(-28 * x["id"] // 100) for x in n)


def test_identities(spark):
    text = 'é"\\x'
    assert one(spark, ids.json_text(F.col("t")), t=text).encode() == ids.canonical(text)
    want = "w_" + hashlib.sha256(ids.canonical(["ref", text, -3, 9])).hexdigest()[:16]
    assert one(spark, ids.window_id("ref", F.col("t"), F.lit(-3), F.lit(9)), t=text) == want
    seeds = ids.seed_table(42, {"pacbio": ["a", "b"]}, [1, 2], {"pacbio": ["x"]}, {("pacbio", "a", 1, "x"): 5})
    assert len({s["seed"] for s in seeds}) == 4 and seeds[0]["seed"] == 5


def _resolve(spark, rows):
    frame = [("d", i, gt, status, [(1, "c1"), (2, "c2")], targets) for i, (gt, targets, status) in enumerate(rows)]
    df = spark.createDataFrame(frame, "dataset_id string, ordinal int, gt string, annotation_status string, alts array<struct<alt_index:int,identity:string>>, targets array<int>")
    return resolve(observe(df), ["dataset_id"]).first()


@pytest.mark.parametrize(
    ("rows", "state", "support", "projected"),
    [
        ([("0/1", [1], "promising"), ("0/0", [1], "promising")], "duplicate_conflict", False, "./."),
        ([("0/1", [1], "promising"), ("./.", [1], "promising")], "target_alt", True, "./."),
        ([("0/1", [1], "promising"), ("1", [1], "promising")], "target_alt", True, "."),
        ([("0/1", [1], "unclassified")], "target_alt", False, "0/1"),
        ([("0/2", [1], "promising")], "other_alt_only", False, "0/."),
        ([("./.", [1], "promising")], "missing", False, "./."),
        ([("0/0", [1], "promising")], "reference_only", False, "0/0"),
        ([("0|1", [1], "promising"), ("1|0", [1], "promising")], "target_alt", True, "0|1"),
    ],
)
def test_resolve(spark, rows, state, support, projected):
    got = _resolve(spark, rows)
    assert (got["call_state"], got["support"], got["projected_GT"]) == (state, support, projected)


def test_left_align_forms(spark):
    ref = "CAAAAG"
    assert left_align(ref, 2, "AA", "A") == left_align(ref, 1, "CA", "C") == (1, "CA", "C")
    assert left_align("AAAA", 2, "AA", "A") == (1, "AA", "A")
    rng = random.Random(3)
    rows = []
    for _ in range(60):
        s = "".join(rng.choice("AC") for _ in range(40))
        p = rng.randint(1, 36)
        r = s[p - 1 : p - 1 + rng.randint(1, 4)]
        a = "".join(rng.choice("AC") for _ in range(rng.randint(1, 4)))
        q, x, y = left_align(s, p, r, a)
        assert s[: p - 1] + a + s[p - 1 + len(r) :] == s[: q - 1] + y + s[q - 1 + len(x) :]
        assert left_align(s, q, x, y) == (q, x, y)
        rows.append((s, p, r, a, "", q, x, y))
    # Long runs and repeated units that cross many pieces, up to a contig's first base; alleles longer than a piece.
    long = [("A" * 300, 299, 2, "A"), ("C" + "AG" * 90, 170, 1, "GAG"), ("ACG" * 60, 178, 3, "ACGACG"), ("T" * 50 + "C" + "ACGT" * 40, 211, 1, "T" + "ACGT" * 30), ("AC" * 80, 1, 2, "ACAC"), ("G" * 64, 64, 1, "GG"), ("GATTACA" * 20, 100, 1, "A"), ("CCC", 1, 2, "C"), ("AC" * 90, 3, 150, "AC")]
    for s, p, n, a in long:
        r = s[p - 1 : p - 1 + n]
        rows.append((s, p, r, a, "", *left_align(s, p, r, a)))
    contigs = spark.createDataFrame([(f"c{i}", r[0]) for i, r in enumerate(rows)], "contig string, sequence string")
    df = spark.createDataFrame([(f"c{i}", *r[1:]) for i, r in enumerate(rows)], "contig string, pos long, ref string, allele string, exclusion_reason string, q long, x string, y string")
    df = df.unionByName(df).unionByName(df.limit(1).withColumn("exclusion_reason", F.lit("symbolic")))
    for chunk in (16, 64, 1000):
        out = normalise(df, contigs, chunk)
        assert out.count() == 2 * len(rows) + 1 and "left" not in out.columns
        assert out.where("exclusion_reason = '' and not (q <=> canonical_pos and x <=> canonical_ref and y <=> canonical_alt)").count() == 0
        assert out.where("exclusion_reason <> '' and canonical_pos is null").count() == 1
    with pytest.raises(ValueError, match="unknown contigs"):
        normalise(df.where("contig = 'c60'"), contigs.where("contig <> 'c60'"))


def test_left_align_carries_no_contig(spark):
    """Neither the plan of a round nor its stored rows hold more than a piece of a contig."""
    contigs = spark.createDataFrame([("c", "ACGT" * 5000)], "contig string, sequence string")
    df = spark.createDataFrame([("c", 19000, "T", "TACGT", "")], "contig string, pos long, ref string, allele string, exclusion_reason string")
    move = A._move

    def watched(batches):
        for b in batches:
            assert max(len(x) for x in b.column(8).to_pylist()) <= 512
            yield from move(iter([b]))

    A._move, old = watched, A._move
    try:
        out = normalise(df, contigs, 512).collect()
    finally:
        A._move = old
    assert (out[0]["canonical_pos"], out[0]["canonical_ref"], out[0]["canonical_alt"]) == left_align("ACGT" * 5000, 19000, "T", "TACGT")


def test_scan_against_brute_force(spark):
    rng = np.random.default_rng(5)
    matrix = rng.dirichlet([0.5] * 4, 5)
    pwm = Pwm("m", tuple(map(tuple, matrix)), 20)
    table = ScoringTable(pwm, (0.25,) * 4)
    every = np.array(np.meshgrid(*[range(4)] * 5)).reshape(5, -1).T
    totals = table.whole[np.arange(5), every].sum(1)
    for t in np.unique(totals)[::50]:
        assert abs((totals >= t).mean() - table.tail[t]) < 1e-9
    sequence = "".join(rng.choice(list("ACGTN"), 200, p=[0.24] * 4 + [0.04]))
    flip = str.maketrans("ACGT", "TGCA")
    expected = []
    for i in range(196):
        word = sequence[i : i + 5]
        if "N" not in word:
            for strand, w in (("+", word), ("-", word[::-1].translate(flip))):
                total = sum(table.whole[k]["ACGT".index(c)] for k, c in enumerate(w))
                if table.tail[total] < 0.05:
                    expected.append((i + 1, strand))
    assert [(s, d) for s, d, *_ in scan_sequence(sequence, table, 0.05)] == sorted(expected)
    windows = spark.createDataFrame([("w", sequence), ("e", ""), ("n", None)], "window_id string, sequence string")
    assert pwm_hits(windows, [pwm], threshold=0.05).count() == len(expected)
    assert pwm_hits(windows, []).count() == 0


def test_shuffle_keeps_words(spark):
    rng = random.Random(1)
    for k in (1, 2, 3, 4):
        for n in (0, 1, 3, 60):
            s = "".join(rng.choice("ACGT") for _ in range(n))
            t = shuffle_letters(s, k, 9)
            assert Counter(s[i : i + k] for i in range(n - k + 1)) == Counter(t[i : i + k] for i in range(n - k + 1)) and len(t) == n
    df = spark.createDataFrame([(str(i), "ACGTTGCAAC" * 3) for i in range(20)], "window_id string, sequence string")
    a, b = (dict(shuffled(df.repartition(n), 2, 4).collect()) for n in (1, 4))
    assert a == b and len(set(a.values())) > 5


def test_planted_motif_is_found(spark):
    rng = random.Random(2)
    rows = []
    for i in range(200):
        s = "".join(rng.choice("ACGT") for _ in range(60))
        rows += [(f"p{i}", s[:20] + "GATTACA" + s[27:], False), (f"c{i}", s, True)]
    found = D.discover(spark.createDataFrame(rows, WINDOW), range(7, 8), 1)
    word = "".join("ACGT"[int(np.argmax(r))] for r in found[0][0].matrix)
    assert word in ("GATTACA", "TGTAATC") and found[0][1] < 1e-6


def _discovered(rows, widths, e_max):
    """(matrix, sites, E-value) of each motif by the rounds of the module's text, in plain Python."""
    n, m = (sum(c == k for *_, c in rows) for k in (False, True))
    seqs = [[s or "", c] for _, s, c in rows]

    def words(s):
        return {min(w, D.flip(w)) for k in widths for i in range(len(s) - k + 1) if set(w := s[i : i + k]) <= set("ACGT")}

    def counts():
        out = {}
        for s, c in seqs:
            for w in words(s):
                out.setdefault(w, [0, 0])[c] += 1
        return out

    now = counts()
    tests, found = len(now), []
    limit = math.log10(e_max / tests) if tests else 0

    def placements(s, t):
        for i in range(len(s) - t.width + 1):
            for x in (s[i : i + t.width], D.flip(s[i : i + t.width])):
                yield sum(t.whole[k]["ACGT".index(ch)] for k, ch in enumerate(x)) if set(x) <= set("ACGT") else -1, i, x

    while n >= 2:
        tested = sorted((D.fisher_tail(a, n, b, m), w) for w, (a, b) in now.items() if a / n > b / max(m, 1))
        seeds = D.batch_of([x for x in tested if x[0] < limit][: D.LOOK], D.BATCH)
        if not seeds:
            return found
        tables, cuts = [], []
        for _, w in seeds:
            near = np.array([[max(0, (z := now.get(min(y, D.flip(y)), [0, 0]))[0] - z[1] * n / max(m, 1)) for y in (w[:i] + base + w[i + 1 :] for base in "ACGT")] for i in range(len(w))])
            t = ScoringTable(Pwm("", tuple(map(tuple, D.shares(near))), now[w][0]), (0.25,) * 4)
            best = {}
            for s, c in seqs:
                if (top := max((x[0] for x in placements(s, t)), default=-1)) >= 0:
                    best.setdefault(int(top), [0, 0])[c] += 1
            tables.append(t)
            own = sum(t.whole[k]["ACGT".index(ch)] for k, ch in enumerate(w))
            least = min(own - t.whole[k]["ACGT".index(ch)] + t.whole[k][j] for k, ch in enumerate(w) for j in range(4) if near[k][j] > 0)
            cuts.append(D.site_threshold(best, n, m, int(own), int(least)))
        free, letters, taken = [[0, 0] for _ in seeds], [np.zeros((t.width, 4)) for t in tables], [set() for _ in seqs]
        marks = [[[i for v, i, _ in placements(s, t) if v >= cut] for s, _ in seqs] for t, cut in zip(tables, cuts, strict=True)]
        for k, (t, cut) in enumerate(zip(tables, cuts, strict=True)):
            for j, (s, c) in enumerate(seqs):
                own = [x for x in placements(s, t) if x[0] >= cut and not taken[j] & set(range(x[1], x[1] + t.width))]
                if own:
                    free[k][c] += 1
                    if not c:
                        for i, ch in enumerate(max(own, key=lambda x: x[0])[2]):
                            letters[k][i]["ACGT".index(ch)] += 1
                taken[j] |= {i + d for i in marks[k][j] for d in range(t.width)}
        kept = [k for k in range(len(seeds)) if not k or D.fisher_tail(free[k][0], n, free[k][1], m) < limit]
        found += [(D.shares(letters[k]), free[k][0], tests * 10 ** seeds[k][0]) for k in kept]
        for j, x in enumerate(seqs):
            gone = {i + d for k in kept for i in marks[k][j] for d in range(tables[k].width)}
            x[0] = "".join("N" if i in gone else ch for i, ch in enumerate(x[0]))
        now = counts()
    return found


WINDOW = "window_id string, sequence string, is_control boolean"


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_discovery_against_plain_python(spark, monkeypatch, seed):
    monkeypatch.setattr(D, "BROADCAST_WORDS", 0 if seed == 2 else 500_000)
    rng = random.Random(seed)
    rows = [("odd1", None, False), ("odd2", "", True), ("odd3", "ACG", False), ("odd4", "NNNNACGTNN", False), ("odd5", "ACGTTGCA" * 6, False)]
    # Overlapping, repeated and degenerate words; the second and third share letters.
    for k, word in enumerate(["GATTACA", "CCGTGCG", "GTGCGAA", "TTT" + "GGT", "ACGTACG"]):
        for i in range(30):
            s = "".join(rng.choice("ACGT") for _ in range(rng.choice([24, 30])))
            w = word if i % 6 else word[:2] + rng.choice("ACGT") + word[3:]
            at = rng.randint(0, len(s) - len(w))
            rows += [(f"p{k}.{i}", s[:at] + (w if i % 2 else D.flip(w)) + s[at + len(w) :], False), (f"c{k}.{i}", "".join(rng.choice("ACGT") for _ in range(len(s))), True)]
    found = D.discover(spark.createDataFrame(rows, WINDOW).repartition(3), range(5, 8))
    want = _discovered(rows, range(5, 8), 0.05)
    assert len(found) == len(want) >= 2
    for (pwm, e), (matrix, sites, e2) in zip(found, want, strict=True):
        assert np.allclose(pwm.matrix, matrix) and pwm.nsites == sites and np.isclose(e, e2)


def test_discovery_loses_no_planted_motif(spark):
    """60 words of 6 to 15 letters, two of which share four in a row: each that is significant at first is found."""
    rng = random.Random(60)
    planted = ["".join(rng.choice("ACGT") for _ in range(6 + k % 10)) for k in range(58)] + ["ACGTTGCACTGA", "GCTAGACCTTGC"]
    random_text = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    rows = []
    for k, w in enumerate(planted):
        for i in range({6: 160, 7: 100, 8: 70}.get(len(w), 45)):
            s, at = random_text(41), rng.randint(0, 41 - len(w))
            rows += [(f"p{k}.{i}", s[:at] + (w if i % 2 else D.flip(w)) + s[at + len(w) :], False), (f"c{k}.{i}", random_text(41), True)]
    found = [pwm.matrix for pwm, e in D.discover(spark.createDataFrame(rows, WINDOW).repartition(8), range(6, 16)) if e < 0.05]

    def fits(matrix, word):
        """Whether all of the word, or all but two columns of the matrix, stand in each other; a column has the letters of over 0.15."""
        columns = [{c for c, x in zip("ACGT", r, strict=True) if x > 0.15} for r in matrix]
        size = min(len(word), max(6, len(columns) - 2))
        return any(all(c in s for c, s in zip(x[i:], columns[j : j + size], strict=False)) for x in (word, D.flip(word)) for i in range(len(x) - size + 1) for j in range(len(columns) - size + 1))

    lost = [w for w in planted if not any(fits(m, w) for m in found)]
    assert not lost and len(found) < 80


def test_discovery_of_little(spark):
    none = spark.createDataFrame([], WINDOW)
    assert D.discover(none) == []
    one = spark.createDataFrame([("a", "ACGTACGTAC", False), ("b", "ACGTACGTAC", True)], WINDOW)
    assert D.discover(one) == []
    assert D.discover(spark.createDataFrame([("a", None, False), ("b", "AC", False)], WINDOW)) == []
    same = spark.createDataFrame([(str(i), "ACGTTGCA", i % 2 == 0) for i in range(40)], WINDOW)
    assert D.discover(same) == []


def test_families():
    e = lambda *p: {frozenset(x) for x in p}
    assert [f["members"] for f in M.complete_link(list("abcd"), e("ab", "bc", "ac", "cd"))] == [["a", "b", "c"], ["d"]]
    rows = M.similarity({"x": np.eye(4)[[0, 1, 2, 3, 0, 1]], "y": np.eye(4)[[0, 1, 2, 3, 0, 1]], "z": np.full((6, 4), 0.25)}, 4)
    best = {(r["query"], r["target"]): r["q"] for r in rows}
    assert best["x", "y"] < best["x", "z"]


def test_similar_motifs_stay_significant_in_a_large_pool():
    rng = np.random.default_rng(4)
    pool = {f"r{i:03d}": rng.dirichlet([0.3] * 4, 10) for i in range(200)}
    pool |= {f"x{i}": pool["r000"] for i in range(3)}
    pool["back"] = pool["r000"][::-1, ::-1]
    rows = {(r["query"], r["target"]): r for r in M.similarity(pool, 6)}
    same = ["r000", "x0", "x1", "x2", "back"]
    for a in same:
        assert all(rows[a, b]["q"] < 1e-6 and rows[a, b]["overlap"] == 10 for b in same if a != b)
    assert rows["r000", "back"]["strand"] == "-" and rows["r000", "x1"]["strand"] == "+"
    assert sum(r["q"] <= 0.05 for k, r in rows.items() if not set(k) <= set(same)) < 0.01 * len(rows)


def test_null_tail_is_exact():
    columns = np.eye(4)[[0, 0, 0, 1]]
    # A pair of columns is equal with probability 10 / 16, else as far apart as can be.
    tails = M.null_tails(columns, 3)
    for n in range(4):
        want = [sum(math.comb(n, k) * (6 / 16) ** k * (10 / 16) ** (n - k) for k in range(total // M.BINS + 1)) for total in range(n * M.BINS + 1)]
        assert np.allclose(tails[n], want)


def test_folds(spark):
    df = spark.createDataFrame([(f"contig{i}", 100 + 10 * i) for i in range(7)], "contig string, length long")
    got = {r["contig"]: r["fold_id"] for r in assign_folds(df).collect()}
    loads = [0] * 5
    for i in range(6, -1, -1):
        at = loads.index(min(loads))
        assert got[f"contig{i}"] == at + 1
        loads[at] += 100 + 10 * i


def test_malformed_alleles_raise(spark):
    rows = lambda ref, alt: spark.createDataFrame([(ref, alt)], "ref string, alt string")
    assert [r["exclusion_reason"] for r in A.explode_alleles(rows("A", "C,<DEL>")).orderBy("alt_index").collect()] == ["", "symbolic_alt"]
    for ref, alt in (("A", "C,x"), ("A", "["), ("?", "C")):
        with pytest.raises(Exception, match="malformed REF or ALT"):
            A.explode_alleles(rows(ref, alt)).collect()


def test_word_scan_in_place(spark):
    """Words of several lengths, both strands, twins, palindromes and letters of several bytes, against plain Python; nothing is exploded before it is a hit."""
    import random

    from strandmill.operators.evidence import best_hits, best_in_window, winner_in_window
    from strandmill.operators.scan import hit_rows, word_hits, word_places

    rng = random.Random(3)
    texts = ["".join(rng.choice("ACGT") for _ in range(rng.randint(0, 60))) for _ in range(300)] + [None, "", "éACGTéTTGCA", "AAAAAA"]
    library = [("ACGT", "f1", 1), ("AAA", "f1", 2), ("TTGCA", "f2", 3), ("TTGCA", "f3", 4), ("é", "f4", 5)]
    flip = lambda w: w[::-1].translate(str.maketrans("ACGT", "TGCA"))
    want = sorted((str(n), m, r, i + 1, i + len(m), s) for n, t in enumerate(texts) if t for m, _, r in library for s, w in (("+", m), ("-", flip(m))) for i in range(len(t)) if t[i : i + len(w)] == w)
    windows = spark.createDataFrame([(str(n), t) for n, t in enumerate(texts)], "window_id string, sequence string")
    models = spark.createDataFrame(library, "motif_id string, family_id string, rank int")
    hits = word_hits(windows, models)
    assert sorted(tuple(r) for r in hits.select("window_id", "motif_id", "rank", "start", "stop", "strand").collect()) == want
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "Exchange" not in plan
    places = word_places(windows, models)
    for by, kind in (("motif_id", "positional"), ("family_id", "union")):
        ours = hit_rows(best_in_window(places, by, kind)).select("window_id", f"hit.{by}", "hit.start", "hit.strand", "hit.rank")
        ours_df = ours.collect()
        key = lambda r: (r["window_id"], r[by], r["start"], r["strand"])
        assert sorted(map(key, ours_df)) == sorted(map(key, best_hits(hits, ["window_id", by], kind).collect()))
    won = {r["window_id"]: (r["rank"], r["distinct_motif_count"]) for r in winner_in_window(places).select("window_id", "best.rank", "distinct_motif_count").collect()}
    assert won["300"] == (None, 0) and len(won) == len(texts)
    assert all(won[w][1] == len({m for x, m, *_ in want if x == w}) for w in won)


def test_consensus_stays_in_place(spark):
    """Calls, candidates and the matrix of the test tables need no shuffle beyond those by contig and those of the members' list; no row is copied for a distinct count."""
    import re

    from strandmill.plans import queries as Q

    for name in ("member_support", "member_matrix", "group_support"):
        plan = Q.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "Expand" not in plan
        wide = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
        assert all(re.match(r"(contig#|slot#|doc_id#)", w) for w in wide), wide
        assert sum(w.startswith("contig#") for w in wide) == 3  # contigs, lines, and records after their scan


def test_folded_letters(spark):
    texts = ["aZ é-YzİK9", "", None, "\nÅngström"]
    fold = dict(zip(V.LETTERS, V.FOLDED, strict=True))
    want = [None if t is None else "".join(fold[c.upper()] for c in t if c.isascii() and c.isalpha()) for t in texts]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    assert [r[0] for r in rows.select("i", V.folded()("t").alias("s")).orderBy("i").select("s").collect()] == want


def test_windows_per_fold_in_one_pass(spark):
    rows = spark.createDataFrame([("a", 1, True), ("a", 1, True), ("a", 3, False), ("b", 2, False)], "g string, fold_id int, own boolean")
    found = FO.windows_per_fold(rows, ["g"], counted=F.col("own"))
    assert sorted(map(tuple, found.collect())) == [("a", 1, 2), *(("a", f, 0) for f in range(2, 6)), *(("b", f, 0) for f in range(1, 6))]
    assert found._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") + found._jdf.queryExecution().optimizedPlan().toString().count("LocalRelation") == 1


def test_fold_counts_read_the_lines_once(spark):
    plan = Q.QUERIES["fold_counts_dense"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("lineitem.parquet") == 1


def test_matrix_scan_against_each_placement():
    rng = np.random.default_rng(4)
    codes = rng.integers(0, 5, (30, 20)).astype(np.uint8)
    for width in (1, 2, 3, 7, 20, 21):
        table = ScoringTable(Pwm("m", tuple(map(tuple, rng.dirichlet(np.ones(4), width))), 20), (0.25,) * 4)
        row, at, plus, score, p = scan_codes(codes, [table], 0.2)[0]
        want = []
        for strand, matrix in ((True, table.whole), (False, table.whole[::-1, ::-1])):
            for r in range(30):
                for a in range(20 - width + 1):
                    letters = codes[r, a : a + width]
                    if (letters < 4).all():
                        total = matrix[np.arange(width), letters].sum()
                        if table.tail[total] < 0.2:
                            want.append((r, a + 1, strand, table.score(total), table.tail[total]))
        assert list(zip(row.tolist(), at.tolist(), plus.tolist(), score.tolist(), p.tolist(), strict=True)) == want


@pytest.mark.parametrize("seed", [0, 5, 2**64 - 1])
def test_shuffle_makes_no_call_for_a_draw(monkeypatch, seed):
    """The same draws as numpy's generator gives, from numbers that are taken many at a time."""
    from strandmill.operators import shuffle as S

    rng = np.random.default_rng(seed)
    real, calls = np.random.default_rng, []
    monkeypatch.setattr(S.np.random, "default_rng", lambda s: calls.append(s) or real(s))
    text = "".join("ACGT"[i] for i in np.random.PCG64(3).random_raw(101) % 4)
    assert sorted(S.shuffle_letters(text, 3, seed)[i : i + 3] for i in range(99)) == sorted(text[i : i + 3] for i in range(99))
    assert not calls
    number = S._numbers(seed).__next__
    for n in range(2, 300):
        v = number() * n
        assert v & 0xFFFFFFFF < n or v >> 32 == rng.integers(n)


def test_discovery_keeps_only_words_that_can_matter(spark):
    rng = random.Random(3)
    words = {"".join(rng.choice("ACGT") for _ in range(w)) for w in (5, 6, 7) for _ in range(300)}
    counts = {D.word_key(w): (rng.choice([0, 1, 2, 3, 30]), rng.choice([0, 1, 9])) for w in words}
    n, m, e_max = 100, 100, 0.05
    tests, live = D.live_counts(spark.createDataFrame([(k, *v) for k, v in counts.items()], "word bigint, primary bigint, control bigint"), n, m, e_max)
    limit = math.log10(e_max) - math.log10(len(counts))
    able = {D.word_of(k) for k, (a, _) in counts.items() if a and D.fisher_tail(a, n, 0, m) < limit}
    near = {D.word_key(w[:i] + c + w[i + 1 :]) for w in able for i in range(len(w)) for c in "ACGT"}
    assert tests == len(counts) and able
    assert {r["word"]: (r["primary"], r["control"]) for r in live.table.collect()} == {k: v for k, v in counts.items() if k in near and v[0]}


@pytest.mark.parametrize("draws", [384, 180, 64])
def test_shuffles_in_step_have_the_draws_of_one_at_a_time(monkeypatch, draws):
    """Also when some run out of numbers in step, beside others that don't."""
    from strandmill.operators import shuffle as S

    monkeypatch.setattr(S, "DRAWS", draws)
    rng, alone = random.Random(5), []
    one = S.shuffle_letters
    monkeypatch.setattr(S, "shuffle_letters", lambda *a: alone.append(a) or one(*a))
    for k in (2, 3, 5):
        texts = [None, b"", "\xe9AC\xe9".encode() * 3, *("".join(rng.choice("ACGTN"[: rng.choice([1, 2, 4, 5])]) for _ in range(n)).encode() for n in (k, k + 1, 30, 101) for _ in range(400 if n == 101 else 50))]
        seeds = [0, 5, 2**64 - 1, *(rng.getrandbits(64) for _ in texts[3:])]
        alone.clear()
        assert S.shuffled_texts(texts, k, seeds) == [None if t is None else one(t.decode(), k, s).encode() for t, s in zip(texts, seeds, strict=True)]
        assert len(alone) <= 52 or draws < 384


def test_digest_of_sorted_words(spark):
    from hashlib import sha256

    from strandmill.operators.shuffle import sorted_words_digest

    texts = ["ACGTTGCA", "AC", None, "", "TTTTACG", "GATTACAGATTACA"]
    for k in (2, 3, 4):
        want = [None if t is None else sha256(",".join(sorted(t[i : i + k] for i in range(len(t) - k + 1))).encode()).hexdigest() for t in texts]
        rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").withColumn("d", sorted_words_digest(k)("t"))
        assert [r["d"] for r in rows.orderBy("i").collect()] == want


def test_identity_counts_as_a_full_join(spark):
    """Repeated and null keys too, and null columns beside the word null."""
    from strandmill.operators.annotate import identity_counts

    rng = random.Random(6)
    rows = lambda n: [(rng.choice(["d1", "d2"]), rng.choice(["c1", None]), rng.randint(1, 6), rng.choice([1, None]), rng.choice(["null", None, 'a"'])) for _ in range(n)]
    a, b = rows(60), rows(50)
    schema = "dataset_id string, contig string, ordinal int, x int, y string"
    found = identity_counts(spark.createDataFrame(a, schema), spark.createDataFrame(b, schema), ["dataset_id", "contig", "ordinal"], ["x", "y"])
    want = {}
    for d in ("d1", "d2"):
        pairs = [(p, q) for p in a for q in b if p[0] == d and p[:3] == q[:3] and None not in p[:3]]
        alone = lambda one, other: sum(p[0] == d and (None in p[:3] or all(p[:3] != q[:3] for q in other)) for p in one)  # noqa: B023, E731
        want[d] = (alone(b, a), alone(a, b), sum(p != q for p, q in pairs))
    assert {r[0]: tuple(r[1:]) for r in found.collect()} == want


def test_identity_counts_shuffle_records_by_contig_only(spark):
    import re

    plan = Q.QUERIES["record_annotation_identity"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    wide = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    assert wide and all(re.match(r"(contig#\d+|dataset_id#\d+), \d+$", w) for w in wide), wide


def test_site_finder_against_each_placement():
    """More matrices than share one table, of all widths, and letters other than ACGT."""
    rng = np.random.default_rng(4)
    for size in (3, 8, 40):
        codes = rng.choice(5, (30, size), p=[0.24] * 4 + [0.04]).astype(np.uint8)
        tables = [ScoringTable(Pwm("m", tuple(map(tuple, rng.dirichlet(np.ones(4) * 0.3, int(rng.integers(1, 16))))), 20), (0.25,) * 4) for _ in range(70)]
        sites = [(t, int(t.whole.max(1).sum() * rng.uniform(0.3, 0.9))) for t in tables]
        found = {(t, *x) for t, *columns in D.SiteFinder(sites).find(codes) for x in zip(*map(np.ndarray.tolist, columns), strict=True)}
        want = set()
        for t, (table, limit) in enumerate(sites):
            for minus, matrix in enumerate((table.whole, table.whole[::-1, ::-1])):
                for r, at in np.ndindex(30, max(0, size - table.width + 1)):
                    letters = codes[r, at : at + table.width]
                    if (letters < 4).all() and (score := int(matrix[np.arange(table.width), letters].sum())) >= limit:
                        want.add((t, r, at, minus, score))
        assert found == want and (want or size < 4)


def test_words_are_counted_in_parts(spark):
    """Words of both sides, those lost by erasing too; tasks send many words in a row."""
    rng = random.Random(8)
    rows = [(s, "".join("N" if rng.random() < 0.1 else c for c in s), rng.random() < 0.5) for s in ("".join(rng.choice("ACGTN" if n == 20 else "ACGT") for _ in range(n)) for n in (0, 2, 20, 30) for _ in range(40))]
    words = lambda s: {D.word_key(w) for k in range(1, 16) for i in range(len(s) - k + 1) if set(w := s[i : i + k]) <= set("ACGT")}
    windows = spark.createDataFrame([(b, a, c) for a, b, c in rows], "sequence string, before string, is_control boolean").repartition(3)
    for before, own in ((None, lambda a, b: words(b)), ("before", lambda a, b: words(a) - words(b))):
        want: dict = {}
        for a, b, c in rows:
            for w in own(a, b):
                want.setdefault(w, [0, 0])[c] += 1
        found = D._counted(windows, range(1, 16), before)
        assert {r["word"]: [r["primary"], r["control"]] for r in found.collect()} == want
    assert "hashpartitioning(word" not in found._jdf.queryExecution().executedPlan().toString()
