"""Stages of the pipeline on a small corpus."""

import random

from pyspark.sql import functions as F

import corpus_pipeline as P
from strandmill.llm import toxicity

SF = "/root/testdata/sf0.001"


def _docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t) if t is not None else None) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").withColumn("entry", F.lit(1))


def test_stages(spark):
    assert [n for n, _ in P.STAGES] == ["toxicity", "line_dedup", "near_duplicates", "decontamination", "packing"] and P.ORACLE_SQL is None
    rng = random.Random(1)
    text = lambda n: " ".join("".join(rng.choice("aeioustrn") for _ in range(5)) for _ in range(n))
    block = "\n".join(text(12) for _ in range(5))
    near = text(200)
    item = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy(F.desc(F.length("text"))).first()["text"]
    rows = [(1, block + "\n" + text(30)), (2, text(30) + "\n" + block), (3, block), (4, near), (5, near + " tail"), (6, text(80)), (7, item), (8, None), (9, ""), (10, text(3000))]
    docs = _docs(spark, rows)
    stages = dict(P.STAGES)
    line = stages["line_dedup"](spark, docs, SF)
    got = {r["doc_id"]: r for r in line.collect()}
    assert set(got) == {1, 2, 4, 5, 6, 7, 8, 9, 10} and line.columns == docs.columns
    assert got[2]["text"] == rows[1][1].split("\n")[0] and got[2]["n_chars"] == len(got[2]["text"]) and got[1]["text"] == rows[0][1]
    kept = stages["near_duplicates"](spark, docs, SF)
    assert {r["doc_id"] for r in kept.collect()} == {1, 2, 3, 4, 6, 7, 8, 9, 10} and kept.columns == docs.columns
    clean = stages["decontamination"](spark, docs, SF)
    assert {r["doc_id"] for r in clean.collect()} == {1, 2, 3, 4, 5, 6, 8, 9, 10} and clean.columns == docs.columns
    assert {r["doc_id"] for r in stages["packing"](spark, docs, SF).collect()} == set(range(1, 11))


def test_stages_know_rows_by_id_and_text(spark):
    """Repeated and null ids, repeated rows, and columns named as those used inside."""
    rng = random.Random(2)
    text = lambda n: " ".join("".join(rng.choice("aeioustrn") for _ in range(6)) for _ in range(n))
    one, two, three, four = (text(60) for _ in range(4))
    item = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy(F.desc(F.length("text"))).first()["text"]
    rows = [(1, one), (5, one), (5, two), (7, three), (7, three), (None, four), (None, four), (None, one), (8, ""), (8, ""), (9, None)]
    inside = ["row", "entry", "n_removed_lines", "change", "block", "w0", "possible", "kept", "words", "key", "node", "root", "salt"]
    docs = _docs(spark, rows).withColumns({n: F.lit(7) for n in inside if n != "entry"})
    stages = dict(P.STAGES)
    kept = stages["near_duplicates"](spark, docs, SF)
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str) == sorted([(1, one), (5, two), (7, three), (None, four), (8, ""), (8, ""), (9, None)], key=str)
    assert kept.columns == docs.columns and kept.where("possible <> 7 or block <> 7 or row <> 7").isEmpty()
    more = _docs(spark, [*rows, (None, item), (7, item)]).withColumns({n: F.lit(7) for n in inside if n != "entry"})
    clean = stages["decontamination"](spark, more, SF)
    assert sorted(((r["doc_id"], r["text"]) for r in clean.collect()), key=str) == sorted(rows, key=str) and clean.columns == docs.columns
    block = "\n".join(text(12) for _ in range(4))
    lines = _docs(spark, [(1, block), (2, f"{block}\nown line"), (2, "another text"), (None, block), (3, None)]).withColumns({n: F.lit(7) for n in inside if n != "entry"})
    got = {(r["doc_id"], r["text"], r["n_chars"], r["n_removed_lines"]) for r in stages["line_dedup"](spark, lines, SF).collect()}
    assert got == {(1, block, len(block), 7), (2, "own line", 8, 7), (2, "another text", 12, 7), (None, block, len(block), 7), (3, None, None, 7)}


def test_stages_on_empty_tables(spark):
    docs = _docs(spark, [(1, "x")]).limit(0)
    for name, stage in P.STAGES:
        out = stage(spark, docs, SF)
        assert out.count() == 0 and (name == "packing" or out.columns == docs.columns)


def test_toxicity_stage_agrees_with_scores(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    p = toxicity.learn(docs, labels)
    scores = {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(docs, p).collect()}
    kept = toxicity.keep_clean(docs, p, 0.2)
    assert kept.schema == docs.schema and {r["doc_id"] for r in kept.collect()} == {d for d, s in scores.items() if s < 0.2}


def test_run(spark):
    out = P.run(spark, SF)
    docs = {r[0] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect()}
    ids = {r["doc_id"] for r in out.collect()}
    assert ids <= docs and len(ids) > len(docs) // 2


def test_near_copies_lose_their_common_lines_first(spark):
    """The join catches near copies of whole documents at any edit rate that leaves a similarity of 0.8; after line dedup the
    later one holds nothing but its own lines, and stays as that."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("aeioustrn") for _ in range(7))
    shingles = lambda t: {tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)}
    rows, linked, unlinked, edited = [], set(), set(), {}
    for k, edits in enumerate([0, 1, 2, 3, 4, 5, 6, 8, 12, 20] * 4):
        lines = [[word() for _ in range(10)] for _ in range(20)]
        copy = [list(x) for x in lines]
        for place in rng.sample(range(200), edits):
            copy[place // 10][place % 10] = word()
        a, b = ("\n".join(" ".join(x) for x in t) for t in (lines, copy))
        rows += [(2 * k, a), (2 * k + 1, b)]
        x, y = shingles(a), shingles(b)
        (linked if len(x & y) * 100 >= 80 * len(x | y) else unlinked).add(2 * k + 1)
        edited[2 * k + 1] = {" ".join(n) for o, n in zip(lines, copy, strict=True) if o != n}
    docs, stages = _docs(spark, rows), dict(P.STAGES)
    kept = {r["doc_id"] for r in stages["near_duplicates"](spark, docs, SF).collect()}
    assert len(linked) >= 12 and len(unlinked) >= 8
    assert kept == {i for i, _ in rows} - linked
    left = {r["doc_id"]: r["text"] for r in stages["line_dedup"](spark, docs, SF).collect()}
    for i, own in edited.items():
        # Runs of under 20 words between two edited lines stay too.
        assert (i in left) == bool(own) and (not own or own <= set(left[i].split("\n")))
