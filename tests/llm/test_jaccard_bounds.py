"""Bounds of the Jaccard join against the sets themselves."""

import numpy as np
import pytest

from loopweave.llm import jaccard_join as jj


def sets(rng, n, gone, new):
    base = rng.integers(0, 2**64, n, dtype=np.uint64)
    return np.unique(base), np.unique(np.concatenate([base[gone:], rng.integers(0, 2**64, new, dtype=np.uint64)]))


@pytest.mark.parametrize("percent", [80, 85])
def test_bounds_lose_no_link(percent):
    rng = np.random.default_rng(5)
    pruned = apart = 0
    for n in [1, 2, 7, 20, 64, 65, 300, 3000]:
        for share in [0, 0.05, 0.08, 0.1, 0.3, 1]:
            for _ in range(20):
                a, b = sets(rng, n, int(share * n), int(rng.integers(0, int(share * n) + 1)))
                if not len(b):
                    continue
                common = len(np.intersect1d(a, b))
                linked = 100 * common >= percent * (len(a) + len(b) - common)
                kept = jj.may_link(len(a), jj.parity(a), len(b), jj.parity(b), percent)
                assert kept or not linked
                pruned += not kept
                apart += not linked
                leaves = [{"c": i, "n": len(s), "comp": i, "f": i, "odd": jj.parity(s)} for i, s in enumerate((a, b))]
                assert bool(list(jj._leaf_pairs(9, leaves, None, percent))) == kept
                assert bool(list(jj._leaf_pairs(9, leaves[:1], leaves[1:], percent))) == kept
                if linked:  # whatever the filter puts last, a linked pair meets
                    last = rng.integers(0, 256, 4096, dtype=np.uint8)
                    assert len(np.intersect1d(jj.leading(a, percent, last), jj.leading(b, percent, last)))
    assert apart > 100 and 2 * pruned > apart  # and the bound is worth its bytes


def test_pairs_that_met_before_are_left_out():
    s = np.arange(1, 40, dtype=np.uint64)
    leaf = {"n": len(s), "odd": jj.parity(s)}
    x, y = {**leaf, "c": 1, "comp": 1, "f": 3}, {**leaf, "c": 2, "comp": 2, "f": 3}
    assert list(jj._leaf_pairs(4, [x], [y], 80)) == []  # both are in the tree of 3
    assert list(jj._leaf_pairs(3, [x], [y], 80)) == [(1, 2)]
    assert list(jj._leaf_pairs(3, [x], [{**y, "comp": 1}], 80)) == []  # one component


def test_filter_of_common_tokens(spark):
    keys = [-(2**63), -7, 0, 5, 2**63 - 1, *range(10**9, 10**9 + 3000)]
    bits = jj.filter_bytes(spark.createDataFrame([(k,) for k in keys], "t long"), "t")
    tokens = np.sort(np.array(keys, np.int64).view(np.uint64))
    other = np.array([11, 12], np.uint64)
    front = jj.leading(np.sort(np.concatenate([tokens, other])), 1, bits)
    assert front[:2].tolist() == [11, 12] and len(front) == jj.prefix_length(len(keys) + 2, 1)
    assert len(jj.filter_bytes(spark.createDataFrame([], "t long"), "t")) == 0


def leaf(c, tokens, ts):
    return {"c": c, "n": len(tokens), "comp": c, "f": min(ts), "odd": jj.parity(tokens, jj.TREE_BITS_PER_TOKEN), "ts": np.array(ts).tobytes()}


def test_a_pair_comes_out_of_one_tree():
    s = np.arange(1, 60, dtype=np.uint64)
    x, y, z = leaf(1, s, [2, 5, 7, 9]), leaf(2, s, [9, 7, 3, 5]), leaf(3, s, [9, 8])
    found = {t: list(jj.met_first(t, jj._leaf_pairs(t, [x, z], [y], 80), [x, z, y])) for t in (5, 7, 9)}
    assert found == {5: [(1, 2)], 7: [], 9: [(2, 3)]}
    assert list(jj.met_first(9, jj._leaf_pairs(9, [x, y, z], None, 80), [x, y, z])) == [(1, 3), (2, 3)]


def test_wide_parities_leave_few_pairs_below_the_threshold():
    rng = np.random.default_rng(2)
    left = {bits: 0 for bits in (jj.BITS_PER_TOKEN, jj.TREE_BITS_PER_TOKEN)}
    for _ in range(300):
        a, b = sets(rng, 146, 18, 18)  # 36 tokens differ, 32 may
        for bits in left:
            left[bits] += jj.may_link(len(a), jj.parity(a, bits), len(b), jj.parity(b, bits), 80)
    assert 3 * left[jj.TREE_BITS_PER_TOKEN] < left[jj.BITS_PER_TOKEN]
    assert len(jj.parity(rng.integers(0, 2**64, 20_000, dtype=np.uint64), 8)) == jj.TREE_BITS // 8


def test_classes_outside_the_largest_component_meet_it_under_each_token(spark):
    rows = [(t, c, 100, 1 if c < 6 else c) for t in (1, 2) for c in range(1, 9)] + [(3, 9, 100, 9), (3, 10, 50, 10)]
    got = [tuple(r) for r in jj._outside(spark.createDataFrame(rows, "t long, c long, n long, comp long"), 80).collect()]
    assert len(got) == len(set(got)) <= 6 and {b for _, b in got} == {6, 7, 8} and {a for a, _ in got} <= set(range(1, 6))


def test_a_large_family_leaves_no_square_of_pairs(spark, monkeypatch):
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in range(150)]
    texts = []
    for k in range(400):
        words = base[:]
        for at in rng.integers(0, 150, int(rng.integers(0, 5))):
            words[at] = f"x{k}_{at}"
        texts.append(" ".join(words))
    made, verify = [], jj._verify
    monkeypatch.setattr(jj, "_verify", lambda pairs, *rest: (made.append(pairs.count()), verify(pairs, *rest))[1])
    got = jj.jaccard_components(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    shingles = [{" ".join(w[i : i + 5]) for i in range(146)} for w in map(str.split, texts)]
    root = list(range(400))
    for i in range(400):
        for j in range(i):
            if 10 * len(shingles[i] & shingles[j]) >= 8 * len(shingles[i] | shingles[j]):
                a, b = root[i], root[j]
                root = [min(a, b) if x in (a, b) else x for x in root]
    assert {r["doc_id"]: r["component_id"] for r in got} == dict(enumerate(root))
    assert sum(made) < 400 * 12
