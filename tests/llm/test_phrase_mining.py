"""Phrase mining against brute force: whatever the sample proposes, the counts and the report are the same."""

import random
import re
from collections import Counter

import pytest

from loopweave.llm import phrase_mining, queries

SCHEMA = "doc_id long, text string, lang string, hash long, phrase string, size string"  # the last three clash with names used inside
LOWER = {i: i + 32 for i in range(65, 91)}


def brute(rows, support, top=2000):
    counts, totals = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, 6):
                for i in range(len(words) - k + 1):
                    counts[lang, tuple(words[i : i + k])] += 1
    long = {key: a for key, a in counts.items() if len(key[1]) > 1 and a >= support}
    held = {}
    for (lang, w), a in long.items():
        for k in range(2, len(w)):
            for i in range(len(w) - k + 1):
                key = lang, w[i : i + k]
                held[key] = max(held.get(key, 0), a)
    out = {}
    for (lang, w), a in long.items():
        if held.get((lang, w), 0) >= a:
            continue
        cuts = [(1000 * a * totals[lang] // (counts[lang, w[:k]] * counts[lang, w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), counts[lang, w[:k]], counts[lang, w[k:]]))
    return sorted(
        (lang, n, p.decode(), -a, left, right, totals[lang], -s) for lang, found in out.items() for n, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1)
    )


def corpus(seed, docs=300, words=40):
    rng = random.Random(seed)
    vocabulary = ["Aa", "b", "c", "dé", "e f", "ß", "漢字"] + [f"w{i}" for i in range(30)]
    weights = [20, 15, 12, 8, 6, 5, 4] + [1] * 30
    out = []
    for _ in range(docs):
        text = ""
        for w in rng.choices(vocabulary, weights, k=rng.randrange(words)):
            text += w + rng.choice([" ", " ", " ", "\t", "  ", ". ", "\n", "\x0b", ",", "; x y z t u v "])
        out.append((text, rng.choice(["en", "fr", None])))
    return out


def mined(spark, rows, **kw):
    df = spark.createDataFrame([(i % 7, *r, 1, "p", "s") for i, r in enumerate(rows)], SCHEMA)
    return sorted(map(tuple, phrase_mining.collocations(df, **kw).collect()))


@pytest.mark.parametrize("lowered", [0.05, 0.4, 3.0])
def test_equals_brute_force_whatever_is_proposed(spark, monkeypatch, lowered):
    """With a threshold three times too high little is proposed, and the expansion finds the rest."""
    monkeypatch.setattr(phrase_mining, "LOWERED", lowered)
    monkeypatch.setattr(phrase_mining, "PART", 700)
    passes = []
    counted = phrase_mining._counted
    monkeypatch.setattr(phrase_mining, "_counted", lambda *a, only=0: (passes.append(only), counted(*a, only=only))[1])
    rows = corpus(1)
    assert mined(spark, rows, support=12) == brute(rows, 12)
    if lowered > 1:
        assert passes.count(0) == 2


def test_full_bitmap_and_short_report(spark, monkeypatch):
    """With a bitmap far too small nearly every run is counted by its text; the report is cut per language."""
    monkeypatch.setattr(phrase_mining, "LEAST_BITS", 1 << 15)
    monkeypatch.setattr(phrase_mining, "MOST_BITS", 1 << 15)
    monkeypatch.setattr(phrase_mining, "BITS", 1)
    rows = corpus(2, docs=400, words=60)
    assert mined(spark, rows, support=5, top=7) == brute(rows, 5, 7)


def test_odd_tables(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(None, None), ("", "en"), (" \t\n", "en")]) == []
    copies = [("To be, or not to be. " * 3, "en")] * 100 + [("x " * 5000, None)]
    assert mined(spark, copies) == brute(copies, 100)


def test_products_beyond_64_bits(spark, monkeypatch):
    from pyspark.sql import functions as F

    big = 3_000_000_000_000_000
    counted = spark.createDataFrame(
        [("en", "a", big + 1), ("en", "b", big + 7), ("en", "a b", big - 5), ("en", "b c", 100), ("en", "c", 101)],
        "lang string, phrase string, n long",
    )
    totals = spark.createDataFrame([("en", 2 * big + 11)], "lang string, n long")
    monkeypatch.setattr(phrase_mining, "frequent_phrases", lambda *a: (counted, totals))
    got = {r["phrase"]: r["score"] for r in phrase_mining.collocations(spark.range(1).select(F.lit("").alias("text"))).collect()}
    assert got == {
        "a b": 1000 * (big - 5) * (2 * big + 11) // ((big + 1) * (big + 7)),
        "b c": 1000 * 100 * (2 * big + 11) // ((big + 7) * 101),
    }


def test_query_is_its_oracle(spark):
    import duckdb

    d = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{d}/documents.parquet'")
    want = sorted(con.sql(queries.ORACLES["op11_phrase_mining"]).fetchall())
    got = queries.op11_phrase_mining(spark, d)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == want and want
