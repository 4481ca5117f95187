"""Arriving records get the same annotation as a batch of them."""

from strandmill.operators.annotate import annotate, window_winners
from strandmill.streaming.incremental import annotate_stream

SCHEMA = "dataset_id string, ordinal long, gt string, eligible boolean, window_id string, window_sequence string"


def test_stream_equals_batch(spark, tmp_path):
    records = spark.createDataFrame([("d", 1, "0/1", True, "w1", "ACGTACGT"), ("d", 2, "0/0", True, "w1", "ACGTACGT"), ("d", 3, "1/1", True, "w2", "NNNNNN"), ("d", 4, "1", False, "w3", None), ("d", 5, "./.", True, "w4", "ACGTT"), ("d", 6, "0/1", True, "w5", "TTTTT")], SCHEMA)
    hits = spark.createDataFrame([("m1", "f1", 1, "w1", 1, 4, "+", "ACGT", 7.5, 1e-5), ("m2", "f1", 2, "w1", 2, 5, "-", "CGTA", 9.0, 1e-4)], "motif_id string, family_id string, rank int, window_id string, start int, stop int, strand string, matched string, score double, p double")
    winners = window_winners(hits, 3)
    want = {r["ordinal"]: (r["annotation_status"], r["annotation_reason"], r["best_motif_id"], r["distinct_motif_count"]) for r in annotate(records, winners, 4).collect()}
    assert want == {1: ("promising", "", "m1", 2), 2: ("not_applicable", "reference_only", None, 0), 3: ("not_scanned", "no_scoreable_segment", None, 0), 4: ("not_scanned", "boundary_window", None, 0), 5: ("not_applicable", "missing_gt", None, 0), 6: ("unclassified", "", None, 0)}
    assert {r["annotation_reason"] for r in annotate(records, winners, None).where("ordinal = 1").collect()} == {"no_selected_motifs"}
    for i in range(3):
        records.where(f"ordinal % 3 = {i}").write.parquet(str(tmp_path / f"in/part{i}"))
    stream = spark.readStream.schema(SCHEMA).option("recursiveFileLookup", True).option("maxFilesPerTrigger", 2).parquet(str(tmp_path / "in"))
    query = annotate_stream(stream, winners, 4, lambda rows, n: rows.write.mode("overwrite").parquet(str(tmp_path / f"out/{n}")), str(tmp_path / "state"))
    query.awaitTermination(60)
    got = spark.read.option("recursiveFileLookup", True).parquet(str(tmp_path / "out"))
    assert {r["ordinal"]: (r["annotation_status"], r["annotation_reason"], r["best_motif_id"], r["distinct_motif_count"]) for r in got.collect()} == want
