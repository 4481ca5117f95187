"""Importance resampling, mixing and vector codes against plain Python, and on odd inputs."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strandmill.llm import mixture, resample, vectorcodes
from strandmill.llm.shared import write_table
from strandmill.llm.words import ALNUM, split_words, text_bytes

DOC = "doc_id long, text string, source string"
ODD = [
    (1, None, "a"), (2, "", None), (3, " \n\t\n", "a"), (4, "x y z", "b"), (4, "x y z", "b"), (4, "other words here", "b"), (None, "a b c d e f", ""), (None, "a b c d e f", ""), (5, "Été ÉTÉ naïve — 数据 " * 9, None),
    (6, "word " * 30_000, "c"), (7, "!!! ??? ...", "c"), (8, "w" * 100_000, "c"), (9, "Long-Word" + "q" * 90 + " tail", "d"), (-(1 << 63), "one two " * 15, "d"), ((1 << 63) - 1, "three four " * 15, "d"),
]
INSIDE = ["row", "entry", "rank", "copies", "copy", "size", "key", "doc", "epoch", "words", "possible", "block", "w0", "taken", "n", "part"]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOC).withColumns({c: F.lit(7) for c in INSIDE})


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOC)


def folded(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def features(text, runs):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", folded(text))
    return words, [" ".join(words[i : i + n]) for n in range(1, runs + 1) for i in range(len(words) - n + 1)]


@pytest.mark.parametrize("runs", [1, 3])
def test_run_buckets(runs):
    rng = random.Random(3)
    texts = ["".join(rng.choice("aAbZ9 .é数") for _ in range(rng.randint(0, 200))) for _ in range(200)] + [None, "", "k" * 70, "Z" * 200_000 + " y z", "é" * 33 + " a"]
    data, offsets = text_bytes(pa.array(texts))
    got = Counter()
    for doc, bucket in resample.run_buckets(data, split_words(data, offsets, ALNUM), runs, 10_000):
        assert (np.diff(doc) >= 0).all()
        got.update(zip(doc.tolist(), bucket.tolist(), strict=True))
    assert got == Counter((i, zlib.crc32(f.encode()) % 10_000) for i, t in enumerate(texts) for f in features(t, runs)[1])


def resampled(rows, target, runs, buckets, min_words, percent):
    """(doc_id, n_features, weight, score, rank) by the rule in plain Python."""
    bucket = lambda t: [zlib.crc32(f.encode()) % buckets for f in features(t, runs)[1]]
    s, t = Counter(b for r in rows for b in bucket(r[1])), Counter(b for x in target for b in bucket(x))
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (t_all * 0 + s_all + buckets) / ((s[b] + 1) * (t_all + buckets))))
    out = []
    for doc_id, text, *_ in rows:
        weight = sum(map(gain, bucket(text)))
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append([doc_id, len(bucket(text)), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(features(text, 1)[0])])
    long = sorted((r for r in out if r[4] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    drawn = {id(r): k for k, r in enumerate(long[: percent * len(long) // 100], 1)}
    return sorted([(*r[:4], drawn.get(id(r))) for r in out], key=str)


@pytest.mark.parametrize(("runs", "min_words", "percent"), [(1, 1, 50), (2, 2, 100), (1, 3, 30), (3, 20, 99)])
def test_resample(spark, odd, runs, min_words, percent):
    target = ["x y other", None, "word tail", "数据 été"]
    held = spark.createDataFrame([(t,) for t in target], "text string")
    got = resample.ranked(resample.scores(odd, held, runs, 50), min_words, percent).select("doc_id", "n_features", "weight", "score", "rank").collect()
    want = resampled(ODD, target, runs, 50, min_words, percent)
    assert sorted(map(tuple, got), key=str) == want
    drawn = resample.draw(odd, held, min_words, percent, runs, 50)
    assert drawn.columns == [*odd.columns, "rank_"] and drawn.where("rank <> 7 or row <> 7 or copies <> 7").isEmpty()
    assert sorted((r["rank_"], r["doc_id"]) for r in drawn.select("rank_", "doc_id").collect()) == sorted((w[4], w[0]) for w in want if w[4])


def test_resample_on_empty_tables(spark, none, odd):
    texts = odd.select("text")
    assert resample.ranked(resample.scores(none, texts)).count() == 0
    assert resample.draw(none, texts).count() == 0
    got = resample.ranked(resample.scores(odd, texts.limit(0)))
    assert got.count() == len(ODD) and got.where("rank is not null").isEmpty()


def test_kth_key(spark):
    """Against sorting, with ties in all columns, negative numbers and the ends of the range."""
    rng = random.Random(8)
    pool = [-(1 << 63), (1 << 63) - 1, 0, -1, 5, 6, 1 << 40, 10**12 + 1]
    rows = [(rng.choice(pool), rng.choice(pool), rng.randint(-3, 3)) for _ in range(400)]
    table, _ = write_table(spark.createDataFrame(rows, "a long, b long, c long"), "kth")
    key = [("a", True), ("b", False), ("c", True)]
    order = sorted(rows, key=lambda r: (-r[0], r[1], -r[2]))
    for k in (1, 7, 100, 399, 400):
        values, n = resample.kth_key(table, k, key)
        less, same = resample.before(values, key)
        assert sorted(map(tuple, table.where(less).collect())) == sorted(order[: k - n])
        assert [r[: len(values)] for r in order[k - n : k]] == [tuple(values)] * n and table.where(same).count() >= n


# --- mixing


def mix(rows, weights, percent, epochs):
    """(doc_id, size, source_size, target, taken) by the rule in plain Python."""
    size = lambda t: len(re.findall(mixture.WORD, t or ""))
    names = sorted({r[2] for r in rows}, key=lambda s: (s is None, s or ""))
    total = {s: sum(size(r[1]) for r in rows if r[2] == s) for s in names}
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    goal, full, left = {}, set(), Fraction(sum(total.values()) * percent, 100)
    while True:
        rest = [s for s in names if s not in full]
        share = {s: (left - sum(epochs * total[f] for f in full)) * weight[s] / sum(weight[r] for r in rest) for s in rest}
        over = {s for s in rest if share[s] > epochs * total[s]}
        if not over:
            break
        full |= over
    goal = {s: Fraction(epochs * total[s]) if s in full else share[s] for s in names}
    key = lambda r: int(hashlib.md5(f"2024:{'text:' + hashlib.md5((r[1] or '').encode()).hexdigest() if r[0] is None else r[0]}".encode()).hexdigest()[:15], 16)
    out = []
    for s in names:
        limit, before = math.floor(goal[s]), 0
        for r in sorted((r for r in rows if r[2] == s), key=lambda r: (key(r), r[0] or 0, size(r[1]))):
            n = size(r[1])
            whole, rest = divmod(limit, total[s]) if total[s] else (0, 0)
            out.append((r[0], n, total[s], float(goal[s]), whole * n + max(0, min(n, rest - before))))
            before += n
    return sorted(out, key=str)


@pytest.mark.parametrize(("weights", "percent", "epochs"), [((5, 2, 1), 150, 2), ((1,), 40, 1), ((3, 1), 290, 3)])
def test_mixture(spark, odd, weights, percent, epochs):
    rng = random.Random(6)
    rows = ODD + [(100 + i, "w " * rng.randint(0, 40), rng.choice(["hot", "hot", "hot", "b", None, "zz"])) for i in range(300)]
    docs = spark.createDataFrame(rows, DOC).withColumns({c: F.lit(7) for c in INSIDE})
    plan = mixture.mix_plan(docs, weights=weights, percent=percent, epochs=epochs)
    got = sorted(map(tuple, plan.select("doc_id", "size", "source_size", "target", "taken").collect()), key=str)
    want = mix(rows, weights, percent, epochs)
    assert [g[:3] + g[4:] for g in got] == [w[:3] + w[4:] for w in want]
    assert all(abs(g[3] - w[3]) <= 1e-9 * w[3] for g, w in zip(got, want, strict=True))
    out = mixture.mixed(docs, plan)
    assert out.columns == [*docs.columns, "epoch_", "words_"] and out.where("epoch <> 7 or words <> 7 or doc <> 7").isEmpty()
    texts = {}
    for r in out.select("doc_id", "text", "words_").collect():
        assert len(re.findall(mixture.WORD, r["text"])) == r["words_"]
        texts.setdefault(r["doc_id"], []).append(r["words_"])
    taken = Counter()
    for w in want:
        taken[w[0]] += w[4]
    assert {d: sum(n) for d, n in texts.items()} == {d: n for d, n in taken.items() if n}


def test_mixture_on_empty_tables(spark, none):
    assert mixture.mix_plan(none).count() == 0
    blank = spark.createDataFrame([(1, "", "a"), (2, None, None), (2, None, None)], DOC)
    plan = mixture.mix_plan(blank)
    assert [(r["size"], r["target"], r["taken"]) for r in plan.collect()] == [(0, 0.0, 0)] * 3
    assert mixture.mixed(blank, plan).count() == 0


def test_attach_deals_hot_keys_out(spark):
    many, _ = write_table(spark.range(3000).select(F.col("id").alias("line"), F.when(F.col("id") < 1500, "hot").otherwise(F.col("id").cast("string")).alias("key")), "many")
    one, _ = write_table(many.select("key", F.length("key").alias("n")).distinct(), "one")
    for few in (0, 100_000):
        assert mixture.attach(many, one, "key", "line", few).where("n = length(key)").count() == 3000


# --- vector codes


def lloyd(vectors, parts, entries, rounds):
    """({place of a row: (code, error)}, codebooks) by plain Lloyd rounds."""
    rows = [(k, i, v) for k, (i, v, *_) in enumerate(vectors) if v and all(x is not None and math.isfinite(x) for x in v)]
    known = sorted((i, v) for _, i, v in rows if i is not None)
    if not known:
        return {}, []
    n = len(known[0][1])
    ints = lambda v: [max(-vectorcodes.LIMIT, min(vectorcodes.LIMIT, math.floor(1024 * x))) for x in v] + [0] * (-n % parts)
    cut = lambda v: [v[p * len(v) // parts : (p + 1) * len(v) // parts] for p in range(parts)]
    rows = [(k, cut(ints(v))) for k, i, v in rows if len(v) == n]
    first = {}
    for i, v in known:
        if len(v) == n:
            first.setdefault(i, v)
    start = [cut(ints(first[i])) for i in sorted(first)[:entries]]
    books = [[s[p] for s in start] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    nearest = lambda p, v: min((far(v, e), j) for j, e in enumerate(books[p]))
    for _ in range(rounds):
        for p in range(parts):
            held = {}
            for _, v in rows:
                held.setdefault(nearest(p, v[p])[1], []).append(v[p])
            for j, vs in held.items():
                books[p][j] = [sum(c) // len(vs) for c in zip(*vs, strict=True)]
    out = {}
    for k, v in rows:
        best = [nearest(p, v[p]) for p in range(parts)]
        out[k] = ("".join(f"{j:02x}" for _, j in best), sum(d for d, _ in best))
    return out, books


@pytest.mark.parametrize(("width", "parts", "entries", "rounds"), [(8, 4, 16, 4), (7, 3, 5, 3), (4, 4, 256, 2), (6, 2, 8, 0), (0, 4, 4, 1)])
def test_codes(spark, width, parts, entries, rounds):
    """Against plain Lloyd: ties on a coarse grid, repeated ids and vectors, nulls, other lengths, huge numbers, a null id."""
    rng = random.Random(width)
    grid = lambda: [rng.choice([-1, 0, 1, 2]) / rng.choice([1, 512]) for _ in range(width)]
    rows = [(i, grid(), i % 3 or None) for i in range(150)] + [(3, grid(), 1), (3, grid(), 1), (None, grid(), 2), (7, [0.5] * width, 0)]
    rows += [(900, None, 1), (901, [None] * max(width, 1), 1), (902, [float("nan")] * max(width, 1), 1), (903, [float("inf")] * max(width, 1), 1), (904, [1.0] * (width + 1), 1), (905, [3e38] * width, 1), (906, [-3e38] * width, 1)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumns({"codes": F.lit(1), "vector": F.lit(1), "error": F.lit(1)})
    coded, books = vectorcodes.encode(table, "embedding", parts, entries, rounds)
    single = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], lab) for i, v, lab in rows]
    want, entries_ = lloyd(single, parts, entries, rounds)
    assert books.entries.tolist() == entries_
    got = sorted((str(r["vec_id"]), r["code"], r["error"]) for r in coded.collect())
    assert got == sorted((str(rows[k][0]), *v) for k, v in want.items())
    wide = vectorcodes.decode(coded, books)
    assert wide.where(F.size("vector") != parts * books.entries.shape[2]).isEmpty()


def test_bounds_prune_and_hold():
    """Bounds stay valid while entries move, and save most comparisons on clustered vectors."""
    rng = np.random.default_rng(2)
    entries = rng.integers(-400, 400, (64, 12))
    x = entries[rng.integers(0, 64, 3000)] + rng.integers(-20, 20, (3000, 12))
    code, d, low = vectorcodes.assign_first(x, entries)
    upper, compared = np.sqrt(d.astype(float)) * vectorcodes.UP, 0
    for _ in range(5):
        new = entries + rng.integers(-8, 9, entries.shape)
        moved = np.sqrt(((new - entries) ** 2).sum(1)) * vectorcodes.UP
        step, small = vectorcodes.lowered(low)
        assert (small * step[:, None].astype(float) <= low).all()
        low = np.maximum(small * (step.astype(float) * vectorcodes.DOWN)[:, None] - moved, 0)
        upper = upper + moved[code]
        gaps = vectorcodes.Codebooks(new[None]).half_gaps()[0]
        code, upper, low, n = vectorcodes.assign_again(x, new, gaps, code, upper, low)
        true = vectorcodes.squared(x, new)
        assert (code == true.argmin(1)).all() and (low <= np.sqrt(true)).all() and (upper >= np.sqrt(true.min(1))).all()
        entries, compared = new, compared + n
    assert compared < 5 * 3000 * 64 * 0.1


def test_codes_of_empty_tables(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    coded, books = vectorcodes.encode(none)
    assert coded.count() == 0 and coded.columns == ["vec_id", "label", "code", "error"] and books.entries.size == 0
    only = spark.createDataFrame([(None, [1.0], 1), (1, None, 2)], none.schema)
    assert vectorcodes.encode(only)[0].count() == 0
    with pytest.raises(ValueError, match="256"):
        vectorcodes.encode(none, entries=257)
