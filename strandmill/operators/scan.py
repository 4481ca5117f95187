"""Pattern scans of windows: exact words, and position weight matrices with exact p-values.

Windows are deduplicated before a scan and every scan takes all models at once. Hit coordinates are local, 1-based,
inclusive and forward, whatever the strand.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandmill.functions.genotype import reverse_complement

#: Two strands of so many words take some megabytes.
BROADCAST_WORDS = 50_000
#: An odd multiplier that spreads rolling keys.
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
HIT = "struct<motif_id:string,family_id:string,rank:int,start:int,stop:int,strand:string,matched:string,score:double,p:double>"
HIT_FIELDS = [f.split(":")[0] for f in HIT[7:-1].split(",")]
#: Letters of windows that are scored together.
SLICE = 1 << 18
PWM_SCHEMA = "motif_id string, window_id string, start int, stop int, strand string, score double, p double, matched_sequence string"


class WordFinder:
    """Where words stand in texts. Rolling 64-bit keys of each word length go through a small table; what passes is compared byte by byte."""

    def __init__(self, words: list[str]):
        owners: dict[bytes, list[int]] = {}
        for i, word in enumerate(words):
            owners.setdefault(word.encode(), []).append(i)
        owners.pop(b"", None)
        self.bits = max(12, len(owners).bit_length() + 6)
        self.lists: dict[int, tuple] = {}
        for width in sorted(set(map(len, owners))):
            letters = np.array([np.frombuffer(w, np.uint8) for w in owners if len(w) == width])
            key = self._key(letters)
            order = np.argsort(key, kind="stable")
            own = [v for w, v in owners.items() if len(w) == width]
            count = np.array([len(own[i]) for i in order])
            table = np.zeros(1 << self.bits, bool)
            table[self._cell(key)] = True
            entries = np.array([e for i in order for e in own[i]], np.int32)
            self.lists[width] = key[order], letters[order], count, np.cumsum(count) - count, entries, table

    def _key(self, letters: np.ndarray) -> np.ndarray:
        key = letters[:, 0].astype(np.uint64)
        for k in range(1, letters.shape[1]):
            key = key * MULTIPLIER + letters[:, k]
        return key

    def _cell(self, key: np.ndarray) -> np.ndarray:
        return (key * MULTIPLIER) >> np.uint64(64 - self.bits)

    def find(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, entry, start): by rows, start in characters from 1. Null texts have nothing."""
        texts = texts.cast(pa.large_string()).fill_null("")
        at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        parts = [(np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int64))]
        if self.lists and at[-1] > at[0]:
            letters = np.frombuffer(texts.buffers()[2], np.uint8)
            first = 0
            while first < len(texts):
                end = max(first + 1, int(np.searchsorted(at, at[first] + SLICE, "right")) - 1)
                parts += [(first + row, entry, start) for row, entry, start in self._slice(letters[at[first] : at[end]], at[first : end + 1] - at[first])]
                first = end
        row, entry, start = (np.concatenate([p[c] for p in parts]) for c in range(3))
        order = np.argsort(row, kind="stable")
        return row[order], entry[order], start[order]

    def _slice(self, data: np.ndarray, at: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        wide = data.astype(np.uint64)
        # Places count characters, of which all bytes but the first are continuations.
        before = None if not len(data) or data.max() < 128 else np.concatenate([[0], np.cumsum(data & 0xC0 != 0x80)])
        key = wide
        for width in range(1, max(self.lists) + 1):
            if len(data) < width:
                return
            if width > 1:
                key = key[:-1] * MULTIPLIER
                key += wide[width - 1 :]
            if width not in self.lists:
                continue
            keys, words, count, begin, entries, table = self.lists[width]
            place = np.flatnonzero(table[self._cell(key)])
            row = np.searchsorted(at, place, "right") - 1
            inside = place + width <= at[row + 1]
            place, row = place[inside], row[inside]
            word = np.minimum(np.searchsorted(keys, key[place]), len(keys) - 1)
            same = (data[place[:, None] + np.arange(width)] == words[word]).all(1)
            place, row, word = place[same], row[same], word[same]
            times = count[word]
            which = np.repeat(begin[word] - np.cumsum(times) + times, times) + np.arange(times.sum())
            start = place - at[row] if before is None else before[place] - before[at[row]]
            yield np.repeat(row, times), entries[which], np.repeat(start + 1, times)


def _entries(models: DataFrame) -> list[tuple[str, str, int, str, str]]:
    """(motif_id, family_id, rank, strand, word) of every model on both strands."""
    both = [models.select("motif_id", "family_id", F.col("rank").cast("int"), F.lit("+"), F.col("motif_id").alias("word")), models.select("motif_id", "family_id", F.col("rank").cast("int"), F.lit("-"), reverse_complement(F.col("motif_id")).alias("word"))]
    return [tuple(r) for df in both for r in df.where("word is not null").collect()]


def word_places(windows: DataFrame, models: DataFrame) -> DataFrame:
    """windows with `hits` in place of sequence: an array of what word_hits returns, for a library of up to BROADCAST_WORDS words.

    Hits stay in their window's row, so what is best in a window needs no shuffle.
    """
    library = _entries(models)
    finder = WordFinder([x[4] for x in library])
    types = [pa.string(), pa.string(), pa.int32(), pa.string(), pa.string()]
    fields = [pa.array([x[c] for x in library], t) for c, t in enumerate(types)]
    width = np.array([len(x[4]) for x in library], np.int64)

    @F.arrow_udf(f"array<{HIT}>")
    def places(texts: pa.Array) -> pa.Array:
        row, entry, start = finder.find(texts)
        size = width[entry]
        motif, family, rank, strand, word = (f.take(pa.array(entry)) for f in fields)
        columns = [motif, family, rank, pa.array(start, pa.int32()), pa.array(start + size - 1, pa.int32()), strand, word, pa.array(2.0 * size, pa.float64()), pa.array(0.25**size, pa.float64())]
        bounds = np.searchsorted(row, np.arange(len(texts) + 1))
        return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.StructArray.from_arrays(columns, HIT_FIELDS))

    return windows.withColumn("hits", places("sequence")).drop("sequence")


def hit_rows(windows: DataFrame) -> DataFrame:
    """A row for each of `hits`, as the struct `hit`. The outer explode keeps Spark from putting a filter on the array's size, and with it a second scan, before it."""
    return windows.select(*(c for c in windows.columns if c != "hits"), F.explode_outer("hits").alias("hit")).where("hit is not null")


def word_hits(windows: DataFrame, models: DataFrame) -> DataFrame:
    """Every place where a model's word stands on either strand. windows: kind, window_id, sequence and more, which is kept; models: motif_id, family_id (strings), rank (int).

    A library of up to BROADCAST_WORDS words goes to the tasks, which look all its words up at once; only hits become rows.
    With a larger one every place of a window is taken once for each word length and joined on the word by shuffle. Work
    grows with windows, not with windows times models. A word scores 2 bits a letter, and p is that of the word in random letters.
    """
    sizes = models.groupBy(F.length("motif_id").alias("width")).count().where("width is not null").collect()
    kept = [c for c in windows.columns if c != "sequence"]
    if sum(r["count"] for r in sizes) <= BROADCAST_WORDS:
        return hit_rows(word_places(windows, models)).select(*kept, *(f"hit.{c}" for c in HIT_FIELDS))
    both = models.select("*", F.col("motif_id").alias("word"), F.lit("+").alias("strand")).unionByName(models.select("*", reverse_complement(F.col("motif_id")).alias("word"), F.lit("-").alias("strand")))
    # Explode, substring and join all stay inside generated code.
    places = windows.select(*kept, "sequence", F.explode(F.array(*map(F.lit, sorted(r["width"] for r in sizes)))).alias("width"))
    places = places.where(F.length("sequence") >= F.col("width")).select("*", F.explode(F.sequence(F.lit(1), F.length("sequence") - F.col("width") + 1)).alias("start"))
    places = places.select(*kept, "width", "start", F.substring("sequence", F.col("start"), F.col("width")).alias("matched"))
    found = places.join(both, F.col("matched") == F.col("word"))
    score, p = (2.0 * F.col("width")).alias("score"), F.pow(F.lit(0.25), F.col("width")).alias("p")
    return found.select(*kept, "motif_id", "family_id", "rank", "start", (F.col("start") + F.col("width") - 1).alias("stop"), "strand", "matched", score, p)


@dataclass(frozen=True)
class Pwm:
    """Probability matrix (width x 4, A C G T) of nsites sites."""

    motif_id: str
    matrix: tuple[tuple[float, ...], ...]
    nsites: float


class ScoringTable:
    """Integer log-odds of a PWM and the exact tail of their distribution under the background (Staden 1989)."""

    def __init__(self, pwm: Pwm, background: tuple[float, ...], pseudo: float = 0.1, steps: int = 1000):
        bg = np.asarray(background)
        smooth = (pwm.nsites * np.asarray(pwm.matrix) + pseudo * bg) / (pwm.nsites + pseudo)
        odds = np.log2(smooth / bg)
        self.low, self.scale = odds.min(), steps / max(odds.max() - odds.min(), 1e-9)
        self.whole = np.rint((odds - self.low) * self.scale).astype(np.int64)
        mass = np.ones(1)
        for column in self.whole:
            nxt = np.zeros(len(mass) + column.max())
            for base in range(4):
                nxt[column[base] : column[base] + len(mass)] += bg[base] * mass
            mass = nxt
        self.tail = np.minimum(np.cumsum(mass[::-1])[::-1], 1.0)
        self.width = len(self.whole)

    def score(self, total: np.ndarray) -> np.ndarray:
        return total / self.scale + self.width * self.low


_CODE = np.full(256, 4, np.uint8)
_CODE[[65, 67, 71, 84]] = 0, 1, 2, 3


def scan_codes(codes: np.ndarray, tables: list[ScoringTable], threshold: float) -> list[tuple[np.ndarray, ...]]:
    """Per table: (row, start, plus strand, score, p) of placements with p below the threshold in windows of one length.

    codes has a row a window; placements over letters other than ACGT are skipped.
    """
    out = []
    one = codes.astype(np.intp)
    # Three letters make one look-up.
    three = one[:, :-2] * 25 + one[:, 1:-1] * 5 + one[:, 2:] if codes.shape[1] > 2 else one
    for table in tables:
        if codes.shape[1] < table.width:
            out.append(tuple(np.zeros(0, t) for t in (np.int64, np.int64, bool, float, float)))
            continue
        parts, places = [], codes.shape[1] - table.width + 1
        # The tail falls, so a placement's p is below the threshold from one total on.
        least = int(np.searchsorted(-table.tail, -threshold, "right"))
        for plus, matrix in ((True, table.whole), (False, table.whole[::-1, ::-1])):
            m = np.concatenate([matrix, np.full((table.width, 1), -(1 << 40))], 1)
            total, k = np.zeros((len(codes), places), np.int64), 0
            while k + 3 <= table.width:
                total += (m[k][:, None, None] + m[k + 1][:, None] + m[k + 2]).ravel()[three[:, k : k + places]]
                k += 3
            for j in range(k, table.width):
                total += m[j][one[:, j : j + places]]
            row, at = np.nonzero(total >= least)
            own = total[row, at]
            parts.append((row, at + 1, np.full(len(row), plus), table.score(own), table.tail[own]))
        out.append(tuple(np.concatenate([x[c] for x in parts]) for c in range(5)))
    return out


def scan_sequence(sequence: str, table: ScoringTable, threshold: float) -> list[tuple[int, str, float, float]]:
    """(start, strand, score, p) of placements with p below the threshold; placements over other letters are skipped."""
    _, start, plus, score, p = scan_codes(_CODE[np.frombuffer(sequence.encode(), np.uint8)][None], [table], threshold)[0]
    return sorted((int(a), "+" if s else "-", float(x), float(y)) for a, s, x, y in zip(start, plus, score, p, strict=True))


def pwm_hits(windows: DataFrame, models: list[Pwm], background: tuple[float, ...] = (0.25, 0.25, 0.25, 0.25), threshold: float = 1e-4, pseudo: float = 0.1) -> DataFrame:
    """All hits of all models in all windows (window_id, sequence), models shipped once. No models or windows: no hits.

    Windows of one length are stacked into a matrix, SLICE letters at a time.
    """
    tables = [(m.motif_id, ScoringTable(m, background, pseudo)) for m in models]
    names = [x.split(" ")[0] for x in PWM_SCHEMA.split(", ")]
    types = [pa.string(), pa.string(), pa.int32(), pa.int32(), pa.string(), pa.float64(), pa.float64(), pa.string()]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), [(s or "").encode() for s in batch.column(1).to_pylist()]
            by_length: dict[int, list[int]] = {}
            for i, t in enumerate(texts):
                by_length.setdefault(len(t), []).append(i)
            cols: list[list] = [[] for _ in types]
            for size, own in by_length.items():
                step = max(1, SLICE // max(size, 1))
                for first in range(0, len(own), step):
                    some = own[first : first + step]
                    codes = _CODE[np.frombuffer(b"".join(texts[i] for i in some), np.uint8)].reshape(len(some), size)
                    for (motif, table), (row, start, plus, score, p) in zip(tables, scan_codes(codes, [t for _, t in tables], threshold), strict=True):
                        which = [some[r] for r in row.tolist()]
                        begin = start.tolist()
                        for c, v in zip(cols, ([motif] * len(which), [ids[i] for i in which], begin, (start + table.width - 1).tolist(), ["+" if s else "-" for s in plus.tolist()], score.tolist(), p.tolist(), [texts[i][a - 1 : a - 1 + table.width].decode() for i, a in zip(which, begin, strict=True)]), strict=True):
                            c += v
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names)

    return windows.select("window_id", "sequence").mapInArrow(work, PWM_SCHEMA)
