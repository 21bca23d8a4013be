"""Exact top-k search by inner product: columnar branch-and-bound over blocks of dimensions.

A component x becomes the integer floor(scale * x). Vectors that are equal then form a class: a class is scored once and
stands for its k + 1 smallest ids, so a vector that a third of all rows share costs no more than any other.

Classes are dealt by hash into chunks, queries into slices, and a task gets one cell: a slice against a chunk. Both have a
fixed largest size, so memory is bounded; a chunk is copied once per slice of queries, a query once per chunk. In a cell
the candidates lie dimension by dimension. A block of dimensions adds to the scores of a tile of queries; what the blocks
still to come can add is at most the sum of the products of the blocks' norms, and a candidate that can't reach a query's
k-th best any more is left out. While many are left the scores are a dense matrix; after that only the surviving pairs are
kept, and they are compacted after each block.

Scores are integers without rounding: 32- or 64-bit floats only where every partial sum is exact in them, Python's integers
beyond.

Defined cases: vectors that are null or hold null or non-finite components take no part, as query or candidate, nor do rows
with a null id. Rows equal in id and integers count once. Rows with the same id and other integers are rows of their own
that find each other. Vectors of different lengths are compared over their common components. Components and scores
beyond 64 bits stay at the largest 64-bit value. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import settle

#: Most classes in a chunk, most queries in a slice: they bound a task's memory.
CHUNK, SLICE = 1 << 18, 1 << 16
#: Below this many classes a chunk isn't divided for the sake of more tasks.
LEAST = 256
#: Queries scored together, candidates scored together, dimensions between two looks at the bounds.
TILE, BLOCK, DIMS = 256, 4096, 8
#: Share of pairs alive from which pairs are kept one by one.
DENSE = 1 / 8
_LIMIT = 9.2e18


def quantised(vectors: pa.Array, scale: float) -> list[bytes | None]:
    """Per vector the item size and the little-endian integers in the least size that holds all; None if it takes no part."""
    out: list[bytes | None] = [None] * len(vectors)
    if not len(vectors):
        return out
    sizes = np.asarray(vectors.value_lengths().fill_null(-1))
    flat = vectors.flatten()
    bad = np.asarray(flat.is_null()) if flat.null_count else np.zeros(len(flat), bool)
    values = np.asarray(flat.cast(pa.float64()).fill_null(0.0) if flat.null_count else flat.cast(pa.float64()), dtype=np.float64)
    bad = bad | ~np.isfinite(values)
    with np.errstate(over="ignore", invalid="ignore"):
        whole = np.clip(np.nan_to_num(np.floor(values * scale), nan=0.0, posinf=_LIMIT, neginf=-_LIMIT), -_LIMIT, _LIMIT)
    ends = np.cumsum(np.maximum(sizes, 0))
    for i, (n, end) in enumerate(zip(sizes.tolist(), ends.tolist())):
        if n < 0 or bad[end - n : end].any():
            continue
        part = whole[end - n : end]
        most = np.abs(part).max() if n else 0.0
        size = 2 if most < 1 << 15 else 4 if most < 1 << 31 else 8
        out[i] = bytes([size]) + part.astype(f"<i{size}").tobytes()
    return out


def _matrices(codes: list[bytes]):
    """(rows, matrix) for the codes of each form; a matrix holds a vector per row."""
    forms: dict[tuple[int, int], list[int]] = {}
    for i, code in enumerate(codes):
        forms.setdefault((len(code), code[0]), []).append(i)
    for (length, size), rows in sorted(forms.items()):
        raw = np.frombuffer(b"".join(codes[i] for i in rows), np.uint8).reshape(len(rows), length)[:, 1:]
        yield np.array(rows), np.ascontiguousarray(raw).view(f"<i{size}").astype(np.int64).reshape(len(rows), (length - 1) // size)


class _Best:
    """The best ``k`` (score, id, class) of each query of a tile, ties to the smaller id."""

    def __init__(self, n: int, k: int) -> None:
        self.k = k
        self.row, self.score, self.id, self.at = (np.zeros(0, np.int64) for _ in range(4))
        self.floor = np.full(n, -np.inf)

    def add(self, row: np.ndarray, score: np.ndarray, at: np.ndarray, ids: np.ndarray, starts: np.ndarray) -> None:
        """Candidate classes ``at``: their ids are ids[starts[c]:starts[c + 1]]."""
        count = starts[at + 1] - starts[at]
        within = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        row = np.concatenate([self.row, np.repeat(row, count)])
        score = np.concatenate([self.score, np.repeat(score, count)])
        found = np.concatenate([self.id, ids[np.repeat(starts[at], count) + within]])
        at = np.concatenate([self.at, np.repeat(at, count)])
        order = np.lexsort((at, found, -score, row))
        row, score, found, at = row[order], score[order], found[order], at[order]
        first = np.searchsorted(row, row)
        keep = np.arange(len(row)) - first < self.k
        self.row, self.score, self.id, self.at = row[keep], score[keep], found[keep], at[keep]
        last = np.arange(len(row)) - first == self.k - 1
        self.floor[row[last]] = score[last]


def _survivors(q: np.ndarray, v: np.ndarray, q_mass: np.ndarray, v_mass: np.ndarray, floor: np.ndarray, k: int):
    """(query, candidate, score) of the pairs of a tile and a block that may be among the k best, all such pairs.

    ``q`` holds queries by dimension, ``v`` dimensions by candidate, the masses the norms of each block of dimensions.
    """
    blocks = range(0, q.shape[1], DIMS)
    limit = floor[:, None]
    score = np.zeros((len(q), v.shape[1]), q.dtype)
    row = at = None
    for b, low in enumerate(blocks):
        part = slice(low, low + DIMS)
        if row is None:
            score += q[:, part] @ v[part]
            rest = (q_mass[:, b + 1 :] @ v_mass[b + 1 :]) * 1.0001 + 1
            alive = score + rest >= limit
            if np.count_nonzero(alive) < DENSE * alive.size:
                row, at = np.nonzero(alive)
                score = score[row, at]
        else:
            score = score + (q[row, part].T * v[part][:, at]).sum(axis=0)
            rest = (q_mass[row, b + 1 :].T * v_mass[b + 1 :][:, at]).sum(axis=0) * 1.0001 + 1
            alive = score + rest >= floor[row]
            row, at, score = row[alive], at[alive], score[alive]
    if row is None:
        if score.shape[1] > k:  # the k-th best class of this block is a bound for the row too
            limit = np.maximum(limit, np.partition(score, score.shape[1] - k, axis=1)[:, -k][:, None])
        row, at = np.nonzero(score >= limit)
        score = score[row, at]
    return row, at, score.astype(np.int64)


def _norms(m: np.ndarray) -> np.ndarray:
    """Norms of a matrix's rows over each block of dimensions."""
    squares = np.add.reduceat(m.astype(np.float64) ** 2, np.arange(0, m.shape[1], DIMS), axis=1) if m.shape[1] else np.zeros((len(m), 0))
    return np.sqrt(squares)


def search_cell(queries: list[bytes], classes: list[bytes], ids: np.ndarray, starts: np.ndarray, k: int):
    """(query, class, id, score) of the best ``k`` ids of each query among the classes of a cell."""
    candidates = [(rows, m, _norms(m)) for rows, m in _matrices(classes)]
    for q_rows, q_all in _matrices(queries):
        q_norms = _norms(q_all)
        for low in range(0, len(q_all), TILE):
            tile = slice(low, low + TILE)
            best = _Best(len(q_rows[tile]), k)
            for c_rows, c_all, c_norms in candidates:
                dims = min(q_all.shape[1], c_all.shape[1])
                most = float(np.sqrt((q_norms[tile] ** 2).sum(axis=1).max(initial=0)) * np.sqrt((c_norms**2).sum(axis=1).max(initial=0)))
                kind = np.float32 if most < 1 << 23 else np.float64 if most < 1 << 52 else object
                q = q_all[tile, :dims].astype(kind)
                if kind is object:
                    for c in range(len(c_rows)):
                        exact = [max(-(1 << 63), min((1 << 63) - 1, sum(int(x) * int(y) for x, y in zip(a, c_all[c])))) for a in q]
                        best.add(np.arange(len(q)), np.array(exact, np.int64), np.full(len(q), c_rows[c]), ids, starts)
                    continue
                q_mass = _norms(q).astype(kind)
                for start in range(0, len(c_rows), BLOCK):
                    part = slice(start, start + BLOCK)
                    v = np.ascontiguousarray(c_all[part, :dims].T).astype(kind)
                    v_mass = np.ascontiguousarray(_norms(v.T).T).astype(kind)
                    row, at, score = _survivors(q, v, q_mass, v_mass, best.floor.astype(kind), k)
                    best.add(row, score, c_rows[part][at], ids, starts)
            yield q_rows[tile][best.row], best.at, best.id, best.score


def top_k(df: DataFrame, queries: Column, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding", scale: float = 256.0) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row where ``queries`` holds its ``k`` best rows by integer inner product.

    ``queries`` is a condition over the id column. Exact; the cases in the module's text.
    """
    spark = df.sparkSession
    rows = df.where(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull())
    rows = rows.select(F.col(id_col).cast("long").alias("id"), F.coalesce(queries, F.lit(False)).alias("asks"), F.col(vec_col).alias("vec"))

    def pack(batches):
        for batch in batches:
            codes = pa.array(quantised(batch.column("vec"), scale), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("asks"), codes], ["id", "asks", "code"]).filter(codes.is_valid())

    packed = settle(rows.mapInArrow(pack, "id long, asks boolean, code binary").distinct())
    leading = Window.partitionBy("code").orderBy("id")
    few = packed.select("code", "id").withColumn("n", F.row_number().over(leading)).where(F.col("n") <= k + 1)
    numbered = few.groupBy("code").agg(F.sort_array(F.collect_list("id")).alias("ids")).withColumn("q", F.monotonically_increasing_id())
    classes = settle(numbered)
    asked = settle(classes.select("q", "code").join(packed.where("asks").select("code").distinct(), "code", "left_semi"))
    n_classes, n_asked = classes.count(), asked.count()

    wanted = int(spark.conf.get("spark.sql.shuffle.partitions"))
    chunks = max(1, math.ceil(n_classes / CHUNK), min(wanted, math.ceil(n_classes / LEAST)))
    slices = max(1, math.ceil(n_asked / SLICE))
    place = F.xxhash64("code")

    def each(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))

    left = asked.select(F.pmod(place, F.lit(slices)).alias("s"), each(chunks).alias("c"), "q", "code")
    right = classes.select(each(slices).alias("s"), F.pmod(place, F.lit(chunks)).alias("c"), "q", "code", "ids")
    left, right = left.repartition(chunks * slices, "s", "c"), right.repartition(chunks * slices, "s", "c")

    def cell(asks: pa.Table, has: pa.Table) -> pa.Table:
        found = [], [], [], []
        if len(asks) and len(has):
            numbers, others = np.asarray(asks.column("q")), np.asarray(has.column("q"))
            lists = has.column("ids").combine_chunks()
            starts = np.concatenate([[0], np.cumsum(np.asarray(lists.value_lengths()))]).astype(np.int64)
            own = np.asarray(lists.flatten())
            for at, hits, ids, scores in search_cell(asks.column("code").to_pylist(), has.column("code").to_pylist(), own, starts, k + 1):
                for column, values in zip(found, (numbers[at], others[hits], ids, scores)):
                    column.append(values)
        arrays = [pa.array(np.concatenate(c) if c else np.zeros(0, np.int64), pa.int64()) for c in found]
        return pa.table(arrays, names=["q", "of", "id", "score"])

    cells = left.groupBy("s", "c").cogroup(right.groupBy("s", "c")).applyInArrow(cell, "q long, of long, id long, score long")
    ranked = cells.withColumn("n", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "id", "of"))).where(F.col("n") <= k + 1)
    best = settle(ranked.groupBy("q").agg(F.sort_array(F.collect_list(F.struct("n", "of", "id", "score"))).alias("best")))
    answers = settle(asked.join(best, "q").select("q", "code", "best"))
    others = F.slice(F.filter("best", lambda x: (x["id"] != F.col("query_id")) | (x["of"] != F.col("q"))), 1, k)
    return (
        packed.where("asks")
        .select(F.col("id").alias("query_id"), "code")
        .join(answers, "code")
        .select("query_id", F.posexplode(others).alias("p", "hit"))
        .select("query_id", (F.col("p") + 1).alias("rank"), F.col("hit.id").alias("vec_id"), F.col("hit.score").alias("score"))
    )
