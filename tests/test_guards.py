"""Order and completeness checks against plain Python."""

import random
from collections import Counter

import pytest

from strandmill.operators import guards as G


def test_merge_in_both_directions_with_multiplicity(spark):
    rng = random.Random(4)
    left = [(rng.randrange(5), rng.choice("ab") if rng.random() < 0.8 else None) for _ in range(60)]
    right = [(rng.randrange(5), rng.choice("ab") if rng.random() < 0.8 else None) for _ in range(60)]
    frame = lambda rows: spark.createDataFrame(rows, "k long, v string")
    expected = Counter(left)
    expected.subtract(Counter(right))
    got = {(r["k"], r["v"]): r["surplus"] for r in G.multiset_difference(frame(left), frame(right), ["k", "v"]).collect()}
    assert got == {k: n for k, n in expected.items() if n}
    G.check_merge(frame(left), frame(left[::-1]), ["k", "v"])
    G.check_merge(frame([]), frame([]), ["k", "v"])
    for changed, word in ((left[1:], "omitted"), ([*left, left[0]], "added"), ([*left[1:], (9, "z")], "added")):
        with pytest.raises(ValueError, match=word):
            G.check_merge(frame(changed), frame(left), ["k", "v"])


@pytest.mark.parametrize("span", [1, 3, 100])
def test_previous_value_crosses_spans(spark, monkeypatch, span):
    monkeypatch.setattr(G, "SPAN", span)
    rng = random.Random(span)
    values = [rng.choice([None, 1, 2, 3]) for _ in range(20)]
    rows = spark.createDataFrame([(i * 2, v) for i, v in enumerate(values)], "line long, v long").repartition(3)
    got = {r["line"]: r["previous"] for r in G.with_previous(rows, "line", "v").collect()}
    assert got == {i * 2: p for i, p in enumerate([None, *values[:-1]])}


def test_annotations_in_file_order(spark, tmp_path):
    head = "dataset_id\tsource_record_index\tstatus\n"

    def read(lines, dataset="a"):
        (tmp_path / "t.tsv").write_text(head + "".join(f"{x}\n" for x in lines))
        return [(r["source_record_index"], r["status"]) for r in G.read_annotations(spark, str(tmp_path / "t.tsv"), dataset).collect()]

    good = ["a\t1\tx", "b\t7\t", "a\t2\t", "b\t3\tz", "a\t10\ty"]
    assert sorted(read(good)) == [(1, "x"), (2, ""), (10, "y")] and read(good, "c") == []
    for bad in (["a\t2\tx", "a\t1\tx"], ["a\t1\tx", "a\t1\tx"], ["a\t0\tx"], ["a\t01\tx"], ["a\t1"]):
        with pytest.raises(Exception, match="ordinal|field count"):
            read(bad)
    with pytest.raises(ValueError, match="columns missing"):
        G.read_annotations(spark, str(tmp_path / "t.tsv"), "a", ordinal="other")
