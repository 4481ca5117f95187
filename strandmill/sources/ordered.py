"""Ordered files written by the executors: one file, the same bytes whatever the partitions, nothing whole on the driver.

Lines are range-partitioned and sorted, and each task packs its share into segments of bounded size that know where
they start within the share. The sizes of the shares (a row a partition) give every segment its place in the text, so a
segment can be cut at the block borders of the whole file by any task; blocks that two segments share are joined from
their parts. Prefix sums of the compressed sizes give every block its place in the file, where a task writes it.
Writing the same bytes to the same place twice does no harm, so retried and speculative tasks are safe. The file's
folder must be one that driver and executors share. The file appears under its name when it is whole.

The index of a blocked VCF comes from the same segments: runs of lines of one bin, joined where one ends as the next
begins, with block places for virtual offsets. It is written by the same sink.

Rows are ordered by the given columns, then by their bytes; repeated rows are all written. Null bodies raise. An empty
table gives the head alone. One line is handled by one task, whatever its length.
"""

from __future__ import annotations

import filecmp
import os
import struct
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandmill.operators.stored import Stored
from strandmill.sources.export import BGZF_END, _bin

BLOCK = 65280  # bytes of text in a block
SEGMENT = 4 << 20  # bytes of text in a segment, or one longer line
GROUP = 4096  # blocks whose sizes are summed together


def block_bytes(part: bytes) -> bytes:
    """One member of a blocked gzip file."""
    z = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = z.compress(part) + z.flush()
    return struct.pack("<4BI2BH2BHH", 31, 139, 8, 4, 0, 0, 255, 6, 66, 67, 2, len(body) + 25) + body + struct.pack("<2I", zlib.crc32(part), len(part))


def _packer(limit: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted bodies of a partition as (part, before, n, body)."""
        part, before, held, size = TaskContext.get().partitionId(), 0, [], 0

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int64()), "before": pa.array([before], pa.int64()), "n": pa.array([size], pa.int64()), "body": pa.array([b"".join(held)], pa.binary())})

        for batch in batches:
            for body in batch.column("body"):
                held.append(body.as_py())
                size += len(held[-1])
                if size >= limit:
                    yield flush()
                    before, held, size = before + size, [], 0
        if size:
            yield flush()

    return pack


def segments(lines: DataFrame, head: bytes, order: list[str], partitions: int | None = None, segment: int = SEGMENT) -> tuple[Stored, DataFrame, int]:
    """(stored segments, the segments with their start in the text, length of the text); lines: the order columns and body, binary. They are read twice, first to find the ranges."""
    spark = lines.sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    body = F.when(F.col("body").isNull(), F.raise_error(F.lit("a row without a body")).cast("binary")).otherwise(F.col("body"))
    rows = lines.select(*order, body.alias("body")).withColumn("_hash", F.xxhash64("body"))
    rows = rows.repartitionByRange(partitions, *order, "_hash").sortWithinPartitions(*order, "_hash", "body").select("body")
    stored = Stored(rows.mapInArrow(_packer(segment), "part long, before long, n long, body binary"), "segments")
    # One row for each partition.
    shares = stored.table.groupBy("part").agg(F.sum("n").alias("bytes"))
    earlier = F.sum("bytes").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    shares = shares.select("part", (F.coalesce(earlier, F.lit(0)) + len(head)).alias("first"))
    placed = stored.table.join(F.broadcast(shares), "part").select((F.col("first") + F.col("before")).alias("start"), "n", "body")
    if head:
        first = spark.createDataFrame([(0, len(head), bytearray(head))], "start long, n long, body binary")
        placed = first.unionByName(placed)
    total = stored.table.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] + len(head)
    return stored, placed, total


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments cut at block borders: whole blocks compressed, the others as parts with their place in the block."""
    for batch in batches:
        for start, body in zip(batch.column("start").to_pylist(), batch.column("body")):
            text, rows, at = body.as_py(), [], 0
            while at < len(text):
                block, inside = divmod(start + at, BLOCK)
                piece = text[at : at + BLOCK - inside]
                whole = len(piece) == BLOCK
                rows.append((block, inside, not whole, block_bytes(piece) if whole else piece))
                at += len(piece)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.bool_(), pa.binary()))], ["block", "at", "part", "data"])


def _join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks from their parts."""
    for batch in batches:
        data = []
        for parts in batch.column("parts").to_pylist():
            text, end = b"", 0
            for p in parts:
                if p["at"] != end:
                    raise ValueError("parts of a block don't meet")
                text, end = text + p["data"], end + len(p["data"])
            data.append(block_bytes(text))
        yield pa.RecordBatch.from_arrays([batch.column("block"), pa.array(data, pa.binary())], ["block", "data"])


def blocks(placed: DataFrame) -> Stored:
    """(block, size, data): the compressed blocks of the text."""
    cut = Stored(placed.select("start", "body").mapInArrow(_cut, "block long, at long, part boolean, data binary"), "cut")
    shared = cut.table.where("part").groupBy("block").agg(F.array_sort(F.collect_list(F.struct("at", "data"))).alias("parts"))  # one block's parts: 65,280 bytes
    joined = shared.mapInArrow(_join, "block long, data binary")
    out = Stored(cut.table.where("not part").select("block", "data").unionByName(joined).select("block", F.length("data").cast("bigint").alias("size"), "data"), "blocks")
    cut.drop()
    return out


def places(table: DataFrame) -> DataFrame:
    """Rows of blocks (block, size and others) with place, the sum of the sizes before."""
    rows = table.withColumn("_group", F.floor(F.col("block") / GROUP))
    inside = F.sum("size").over(Window.partitionBy("_group").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    # One row for each 267 MB of text.
    groups = table.groupBy(F.floor(F.col("block") / GROUP).alias("_group")).agg(F.sum("size").alias("_bytes"))
    earlier = F.sum("_bytes").over(Window.orderBy("_group").rowsBetween(Window.unboundedPreceding, -1))
    groups = groups.select("_group", F.coalesce(earlier, F.lit(0)).alias("_first"))
    return rows.withColumn("_inside", F.coalesce(inside, F.lit(0))).join(groups, "_group").withColumn("place", F.col("_first") + F.col("_inside")).drop("_group", "_inside", "_first")


def _write(df: DataFrame, path: str, end: bytes) -> bool:
    """Rows (place, data) to their places in the file, then the end; each task reads back what it wrote. True if the file is new or differs."""
    temporary = f"{path}.{uuid.uuid4().hex}.tmp"

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        written = 0
        with open(temporary, "r+b") as out:
            for batch in batches:
                for place, data in zip(batch.column("place").to_pylist(), batch.column("data")):
                    data = data.as_py()
                    out.seek(place)
                    out.write(data)
                    out.flush()
                    out.seek(place)
                    if out.read(len(data)) != data:
                        raise OSError(f"{temporary} doesn't hold what was written at {place}")
                    written += len(data)
            os.fsync(out.fileno())
        yield pa.RecordBatch.from_pydict({"written": pa.array([written], pa.int64())})

    with open(temporary, "xb"):
        pass
    try:
        size = df.select("place", "data").mapInArrow(put, "written long").agg(F.coalesce(F.sum("written"), F.lit(0))).first()[0]
        with open(temporary, "r+b") as out:
            out.seek(0, os.SEEK_END)
            if out.tell() != size:
                raise OSError(f"{temporary} has {out.tell()} bytes, not {size}")
            out.write(end)
            out.flush()
            os.fsync(out.fileno())
        if os.path.exists(path) and filecmp.cmp(path, temporary, shallow=False):
            return False
        os.replace(temporary, path)
        return True
    finally:
        if os.path.exists(temporary):
            os.unlink(temporary)


def write_ordered(lines: DataFrame, path: str, order: list[str], head: bytes = b"", partitions: int | None = None) -> bool:
    """Plain text: the head, then every body in order. False if the file had these bytes already."""
    stored, placed, _ = segments(lines, head, order, partitions)
    written = _write(placed.select(F.col("start").alias("place"), F.col("body").alias("data")), path, b"")
    stored.drop()
    return written


def write_blocked(lines: DataFrame, path: str, order: list[str], head: bytes = b"", index: bool = False, partitions: int | None = None, segment: int = SEGMENT) -> bool:
    """Blocked gzip of the same text, with path.csi if index is set (a VCF's lines). Byte for byte what `export.bgzf` gives for the text."""
    stored, placed, total = segments(lines, head, order, partitions, segment)
    packed = blocks(placed)
    written = _write(places(packed.table).select("place", "data"), path, BGZF_END)
    if index:
        pieces, first = index_pieces(placed, packed.table.select("block", "size"), total)
        written |= write_blocked(pieces, f"{path}.csi", ["contig_ord", "bin"], first, partitions=partitions, segment=segment)
    stored.drop()
    packed.drop()
    return written


SHIFT, DEPTH = 14, 5  # Fixed values: the smallest bin's bits and the levels of an index


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(contig, bin, u0, u1): texts from u0 to u1 whose lines follow each other and share a bin."""
    for batch in batches:
        for start, body in zip(batch.column("start").to_pylist(), batch.column("body")):
            rows, at = [], start
            for line in body.as_py().split(b"\n")[:-1]:
                end = at + len(line) + 1
                if line and not line.startswith(b"#"):
                    f = line.split(b"\t", 5)
                    pos = int(f[1]) - 1
                    contig, number = f[0].decode(), _bin(pos, pos + max(1, len(f[3])), SHIFT, DEPTH)
                    if rows and rows[-1][0] == contig and rows[-1][1] == number and rows[-1][3] == at:
                        rows[-1][3] = end
                    else:
                        rows.append([contig, number, at, end])
                at = end
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.int64(), pa.int64(), pa.int64()))], ["contig", "bin", "u0", "u1"])


def _bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data = [struct.pack("<IQi", number, chunks[0]["v0"], len(chunks)) + b"".join(struct.pack("<2Q", c["v0"], c["v1"]) for c in chunks) for number, chunks in zip(batch.column("bin").to_pylist(), batch.column("chunks").to_pylist())]
        yield pa.RecordBatch.from_arrays([batch.column("contig_ord"), batch.column("bin"), pa.array(data, pa.binary())], ["contig_ord", "bin", "body"])


def _islands(runs: DataFrame, by: list[str]) -> DataFrame:
    """Runs of a key joined where one begins as another ends."""
    w = Window.partitionBy(*by).orderBy("u0")
    marked = runs.withColumn("_new", (F.col("u0") != F.coalesce(F.lag("u1").over(w), F.lit(-1))).cast("int"))
    marked = marked.withColumn("_n", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.groupBy(*by, "_n").agg(F.min("u0").alias("u0"), F.max("u1").alias("u1")).drop("_n")


def index_runs(placed: DataFrame) -> DataFrame:
    """(contig, bin, u0, u1): runs of lines that follow each other and share a bin."""
    return _islands(placed.select("start", "body").mapInArrow(_runs, "contig string, bin long, u0 long, u1 long"), ["contig", "bin"])


def index_pieces(placed: DataFrame, sizes: DataFrame, total: int) -> tuple[DataFrame, bytes]:
    """((contig_ord, bin, body), first bytes) of the index of a blocked VCF. A contig whose records stand apart raises."""
    spark = placed.sparkSession
    runs = Stored(index_runs(placed), "runs")
    # One row for each contig; a contig stands apart if another's lines begin between its first and last line.
    spans = runs.table.groupBy("contig").agg(F.min("u0").alias("u0"), F.max("u1").alias("u1"), F.count_distinct("bin").alias("n")).orderBy("u0").collect()
    for one, next_one in zip(spans, spans[1:]):
        if next_one["u0"] < one["u1"]:
            raise ValueError(f"records aren't sorted by contig: {one['contig']}, {next_one['contig']}")
    at = places(sizes).select("block", "place")
    end = sizes.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]  # the empty end block's place

    def virtual(df: DataFrame, u: str, v: str) -> DataFrame:
        found = df.withColumn("block", F.floor(F.col(u) / BLOCK)).join(at, "block", "left")
        offset: Column = F.shiftleft(F.col("place"), 16) + F.col(u) % BLOCK
        return found.withColumn(v, F.when(F.col(u) == total, F.lit(end << 16)).otherwise(offset)).drop("block", "place")

    ords = F.broadcast(spark.createDataFrame([(s["contig"], i) for i, s in enumerate(spans)], "contig string, contig_ord long"))
    chunks = virtual(virtual(runs.table, "u0", "v0"), "u1", "v1").join(ords, "contig")
    bins = chunks.groupBy("contig_ord", "bin").agg(F.array_sort(F.collect_list(F.struct("v0", "v1"))).alias("chunks"))
    counts = spark.createDataFrame([(i, -1, bytearray(struct.pack("<i", s["n"]))) for i, s in enumerate(spans)], "contig_ord long, bin long, body binary")
    names = b"".join(s["contig"].encode() + b"\0" for s in spans)
    aux = struct.pack("<7i", 2, 1, 2, 0, ord("#"), 0, len(names)) + names
    return counts.unionByName(bins.mapInArrow(_bins, "contig_ord long, bin long, body binary")), b"CSI\x01" + struct.pack("<3i", SHIFT, DEPTH, len(aux)) + aux + struct.pack("<i", len(spans))


def line_body(line: Column) -> Column:
    return F.encode(F.concat(line, F.lit("\n")), "UTF-8")


def tsv_body(df: DataFrame, fields: list[str]) -> Column:
    """A row's fields as a line: null is empty, booleans are words, and what holds a quote, tab or line end is quoted."""

    def cell(name: str) -> Column:
        text = F.coalesce(F.col(name).cast("string"), F.lit(""))
        return F.when(text.rlike(r'["\t\r\n]'), F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(text)

    return line_body(F.array_join(F.array(*map(cell, fields)), "\t"))


def write_tsv(df: DataFrame, path: str, fields: list[str], order: list[str], partitions: int | None = None) -> bool:
    """The chosen columns, ordered, with a header; blocked gzip where the name ends in .gz. Any program that reads gzip reads it."""
    keys = [F.col(c).alias(f"_o{i}") for i, c in enumerate(order)]
    lines, head = df.select(*keys, tsv_body(df, fields).alias("body")), ("\t".join(fields) + "\n").encode()
    names = [f"_o{i}" for i in range(len(order))]
    return (write_blocked if path.endswith(".gz") else write_ordered)(lines, path, names, head, partitions=partitions)


def write_fasta(df: DataFrame, path: str, name: str = "window_id", partitions: int | None = None) -> bool:
    """Records by name."""
    body = line_body(F.concat(F.lit(">"), F.col(name), F.lit("\n"), F.col("sequence")))
    return write_ordered(df.select(F.col(name).alias("_name"), body.alias("body")), path, ["_name"], partitions=partitions)


def write_train_test(windows: DataFrame, held_out: Column, folder: str, partitions: int | None = None) -> list[str]:
    """train.fasta and test.fasta of windows (window_id, sequence), by window; a window whose fold is unknown is in neither."""
    out = []
    for tag, chosen in (("train", ~held_out), ("test", held_out)):
        out.append(os.path.join(folder, f"{tag}.fasta"))
        write_fasta(windows.where(chosen), out[-1], partitions=partitions)
    return out


def write_promising_vcf(header: list[str], sample: str, at: int, records: DataFrame, path: str, extra: list[str] | None = None, partitions: int | None = None) -> bool:
    """Raw records (ordinal, raw) verbatim in columns 1 to 9 with one sample's value, in file order, with the index."""
    head = [*header[:-1], *(extra or ()), "\t".join([*header[-1].split("\t")[:9], sample])]
    f = F.split("raw", "\t", -1)
    kept = F.array_join(F.concat(F.slice(f, 1, 9), F.slice(f, 10 + at, 1)), "\t")
    return write_blocked(records.select("ordinal", line_body(kept).alias("body")), path, ["ordinal"], ("\n".join(head) + "\n").encode(), index=True, partitions=partitions)
