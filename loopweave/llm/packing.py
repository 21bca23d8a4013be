"""Packing token sequences into windows by non-negative least squares over length combinations.

Documents longer than a window are cut into full windows and a rest, so every piece has one of ``window`` lengths and
all planning is done on the histogram of lengths: at most ``window`` numbers reach the driver, whatever the input.

The plan enumerates shallow combinations (one, two or three lengths) that fill a window exactly, solves how often to
repeat each by non-negative least squares against the histogram, rounds the repeats down to what the histogram holds,
and packs what is left greedily, largest first, again by counts. A combination with its repeats is a run of sequences; a
piece's place follows from its rank among the pieces of its length. Ranks come from one counter per written partition
and a running sum over partitions, so a length that a third of all pieces share is never gathered.

Defined cases: null text counts as empty, an empty document is its end id alone, repeated rows are packed each, null ids
stay, an empty table gives an empty result, texts of any length are cut. Extra columns are not looked at.
"""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import settle
from .byte_bpe import encoder
from .common import text_of

WINDOW = 2048
#: Three-length combinations kept for each largest length; they differ in their second length by equal steps.
TRIPLES = 12
STEPS = 200


def combinations(lengths: np.ndarray, window: int, triples: int = TRIPLES) -> list[tuple[int, ...]]:
    """Combinations of one to three of the given lengths, longest first, that fill a window exactly."""
    have = set(int(n) for n in lengths)
    out: list[tuple[int, ...]] = [(window,)] if window in have else []
    for a in sorted(have, reverse=True):
        b = window - a
        if 0 < b <= a and b in have:
            out.append((a, b))
        found = [(a, b, window - a - b) for b in sorted(have) if 0 < window - a - b <= b <= a and window - a - b in have]
        out += [found[i] for i in sorted({i * len(found) // triples for i in range(triples)}) if i < len(found)]
    return out


def repeats(patterns: list[tuple[int, ...]], histogram: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """Non-negative repeats x that bring A x near the histogram, column j of A counting pattern j's lengths.

    Multiplicative steps: x keeps its sign and the squared error never grows.
    """
    width = 3
    index = np.zeros((len(patterns), width), dtype=np.int64)  # length 0 stands for none
    for j, p in enumerate(patterns):
        index[j, : len(p)] = p
    used = (index > 0).astype(float)
    target = histogram.astype(float)
    x = np.full(len(patterns), max(target.sum() / (3 * max(len(patterns), 1)), 1e-9))
    want = (target[index] * used).sum(1)
    for _ in range(steps):
        made = np.bincount(index.ravel(), (x[:, None] * used).ravel(), len(target))
        x *= want / np.maximum((made[index] * used).sum(1), 1e-12)
    return x


def plan(histogram: dict[int, int], window: int = WINDOW) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a sequence, how often) over the whole histogram: every piece has a place, none is over."""
    left = np.zeros(window + 1, dtype=np.int64)
    for n, c in histogram.items():
        left[n] = c
    out: list[tuple[tuple[int, ...], int]] = []

    def take(pattern: tuple[int, ...], most: int) -> None:
        need: dict[int, int] = defaultdict(int)
        for n in pattern:
            need[n] += 1
        times = int(min([most, *(left[n] // k for n, k in need.items())]))
        if times > 0:
            out.append((pattern, times))
            for n, k in need.items():
                left[n] -= k * times

    patterns = combinations(np.flatnonzero(left), window)
    if patterns:
        x = repeats(patterns, left)
        for j in np.argsort(-x, kind="stable"):
            take(patterns[j], int(x[j] + 0.5))
    while left.any():  # greedy: the longest piece, then the longest that still fits
        rest, room, pattern = left.copy(), window, []
        while True:
            fits = np.flatnonzero(rest[: room + 1])
            if not len(fits):
                break
            n = int(fits[-1])
            k = int(min(rest[n], room // n))
            pattern += [n] * k
            rest[n] -= k
            room -= k * n
        take(tuple(pattern), int(left.max()))
    return out


def slots(packed: list[tuple[tuple[int, ...], int]]) -> dict[int, np.ndarray]:
    """Per length rows (first rank, sequence of that rank, offset), by rank; ranks up to the next row go to the sequences that follow."""
    rows: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    taken: dict[int, int] = defaultdict(int)
    sequence = 0
    for pattern, times in packed:
        offset = 0
        for n in pattern:
            rows[n].append((taken[n], sequence, offset))
            taken[n] += times
            offset += n
        sequence += times
    return {n: np.array(r, dtype=np.int64) for n, r in rows.items()}


def pack(
    docs: DataFrame,
    spec: bytes,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    end_id: int = 1,
) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document's ids are those of the byte-level BPE tokenizer file ``spec`` and then ``end_id``.
    """
    sc = docs.sparkSession.sparkContext
    shared = sc.broadcast(spec)  # one vocabulary file
    kind = dict(docs.dtypes)[id_col]
    end = int(end_id).to_bytes(4, "little")
    names = ["start", "length", "ids_crc32", "doc_tokens", "local"]

    def cut(batches):
        bpe = encoder(shared.value)
        seen: dict[int, int] = defaultdict(int)
        for batch in batches:
            ids, columns = [], [[] for _ in names]
            for i, text in enumerate(batch.column("text").to_pylist()):
                data = bpe.encode(text) + end
                total = len(data) // 4
                for start in range(0, total, window):
                    n = min(window, total - start)
                    crc = zlib.crc32(memoryview(data)[4 * start : 4 * (start + n)])
                    for column, v in zip(columns, (start, n, crc, total, seen[n])):
                        column.append(v)
                    seen[n] += 1
                    ids.append(i)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(pa.array(ids, pa.int64())), *(pa.array(c, pa.int64()) for c in columns)],
                names=["id", *names],
            )

    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    longs = ", ".join(f"{c} long" for c in names)
    cutted = rows.mapInArrow(cut, f"id {kind}, {longs}").withColumn("part", F.spark_partition_id())
    pieces = settle(cutted)
    counts = settle(pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # <= window rows
    places = sc.broadcast(slots(plan(histogram, window)))  # bounded by the combinations, not by the pieces

    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))

    def place(batches):
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for n in np.unique(length):
                at = np.flatnonzero(length == n)
                table = places.value[int(n)]
                row = np.searchsorted(table[:, 0], rank[at], side="right") - 1
                sequence[at] = table[row, 1] + rank[at] - table[row, 0]
                offset[at] = table[row, 2]
            kept = [batch.column(c) for c in ("id", "start", "length", "ids_crc32", "doc_tokens")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(sequence), pa.array(offset)],
                names=["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
            )

    ranked = pieces.join(bases, ["part", "length"]).withColumn("rank", F.col("base") + F.col("local"))
    out = ranked.select("id", "start", "length", "ids_crc32", "doc_tokens", "rank").mapInArrow(
        place,
        f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long",
    )
    return out.withColumnRenamed("id", id_col)
