"""Top-k search against brute force: ties, copies, odd vectors, small cells."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from loopweave.llm import queries, top_k_search

SCHEMA = "vec_id long, embedding array<double>, code string, q string"  # the last two clash with names used inside


def brute(rows, k=5, every=5):
    """Rows by identity after equal (id, integers) are made one."""
    kept = {}
    for vec_id, vec, *_ in rows:
        if vec_id is None or vec is None or any(x is None or not math.isfinite(x) for x in vec):
            continue
        kept[vec_id, tuple(math.floor(256.0 * x) for x in vec)] = None
    out = []
    for q, a in kept:
        if q % every:
            continue
        scores = [(-sum(x * y for x, y in zip(a, b)), c) for c, b in kept if (c, b) != (q, a)]
        out += [(q, n, c, -s) for n, (s, c) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


def found(spark, rows, **kw):
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    return sorted(map(tuple, top_k_search.top_k(df, F.col("vec_id") % 5 == 0, **kw).collect()))


@pytest.mark.parametrize("spread", [0.02, 0.5])
def test_equals_brute_force(spark, monkeypatch, spread):
    monkeypatch.setattr(top_k_search, "LEAST", 16)
    monkeypatch.setattr(top_k_search, "SLICE", 8)
    rng = np.random.default_rng(7)
    centres = rng.normal(0, 0.3, (6, 20))
    vectors = [(centres[i % 6] + rng.normal(0, spread, 20)).tolist() for i in range(150)]
    rows = list(enumerate(vectors)) + [(1000 + i, vectors[3]) for i in range(60)]  # a vector with many copies
    rows += [(2000 + i, [1.0 if j == i % 20 else 0.0 for j in range(20)]) for i in range(40)]  # ties
    assert found(spark, rows) == brute(rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [0.5, -0.25]), (0, [0.5, -0.25]), (0, [1.0, 1.0]), (5, [0.5, -0.25]), (5, None), (10, [nan, 1.0]), (15, [1.0, None]),
        (20, [inf, 1.0]), (None, [1.0, 1.0]), (25, []), (3, [2.0]), (4, [1.0, 2.0, 3.0]), (6, [1e6, -1e6]), (7, [0.001, -0.001]),
    ]
    assert found(spark, rows) == brute(rows)
    assert found(spark, []) == []
    assert found(spark, [(0, [1.0])]) == []


def test_beyond_floats(spark):
    rows = [(0, [1e6, 1.0]), (1, [1e6, 1e6]), (2, [1e6, 1e6 + 1 / 256]), (5, [3e6, -7.0]), (6, [1e6, 1e6 - 1 / 256])]
    assert found(spark, rows) == brute(rows)
    limit = found(spark, [(0, [1e300]), (1, [1e300]), (2, [-1e300])])
    assert [r[3] for r in limit] == [(1 << 63) - 1, -(1 << 63)]


def test_bounds_leave_the_best(monkeypatch):
    """Pairs are compacted while blocks of dimensions come, whatever the share of pairs alive."""
    rng = np.random.default_rng(3)
    m = rng.integers(-80, 80, (400, 37)).astype(np.int64)
    codes = [bytes([2]) + v.astype("<i2").tobytes() for v in m]
    ids, starts = np.arange(400), np.arange(401)
    want = [sorted((-(int(a @ b)), i) for i, b in enumerate(m))[:4] for a in m[:30]]
    for dense in (0.0, 0.2, 1.1):
        for block in (32, 4096):
            monkeypatch.setattr(top_k_search, "DENSE", dense)
            monkeypatch.setattr(top_k_search, "BLOCK", block)
            got = [[] for _ in range(30)]
            for rows, _, hit, score in top_k_search.search_cell(codes[:30], codes, ids, starts, 4):
                for r, i, s in zip(rows, hit, score):
                    got[r].append((-int(s), int(i)))
            assert got == want


def test_query_is_its_oracle(spark):
    import duckdb

    d = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.sql(f"create view embeddings as select * from '{d}/embeddings.parquet'")
    want = sorted(con.sql(queries.ORACLES["op13_top_k_search"]).fetchall())
    assert sorted(map(tuple, queries.op13_top_k_search(spark, d).collect())) == want
