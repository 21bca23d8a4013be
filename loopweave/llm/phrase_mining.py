"""Phrases of two to five words that stick together, found by Toivonen's sampling.

A phrase is a run of words inside a piece of text, counted per language with overlaps. Phrases with a count of ``support``
and more are frequent, and so is every part of them.

1. A sample of the documents proposes phrases: level by level those that reach a lowered threshold in the sample.
2. One full pass counts the proposed phrases and their negative border: every phrase that isn't proposed while the phrases
   without its last and without its first word are (for single words: all others).
3. A phrase of the border that turns out frequent is a failure: longer phrases that hold it have not been counted. Then an
   expansion pass counts the failures and, level upon level, every phrase that holds a failure and whose parts are
   proposed or counted in this pass too.

That closes the search: of the frequent phrases not counted take a shortest. Its two parts are frequent, so counted. If both
are proposed, it is proposed or of the border; if not, a part is a failure or holds one, and the expansion counts it.

Proposals reach the tasks as a bitmap of hashes whose size is set by their number and has a fixed maximum. A bit set by
chance only means that a phrase more is counted; with a full bitmap a pass is a plain count of all runs of words, linear in
the text. Proposed phrases are counted by their text, border phrases by a 64-bit hash: a collision there can only add to a
border count and so propose a phrase that isn't frequent, which its count by text then shows. Within a task words and
phrases have exact numbers, so equal hashes never merge two of them.

Each task counts blocks of some megabytes of text, cut between pieces, so its memory doesn't depend on the length of a
document or the number of documents, and only (phrase, count) rows are shuffled, summed before and after. No key gathers
the rows of a language until the final report, which Spark prunes to ``top`` rows per task before the shuffle.

Defined cases: null text counts as empty, null language as ``und``; documents without words add nothing; ids aren't used, so
null and repeated ones are fine, and repeated rows count as often as they occur. Other columns are ignored. An empty table
gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import settle
from .common import BITMAP_BITS, key_filter, text_of
from .shingles import mixed

#: One document in so many is in the sample; a phrase is proposed if it reaches this share of its expected count there.
SAMPLE, LOWERED = 8, 0.4
#: Bytes of text that a task counts at once.
PART = 2 << 20
#: Bits of the bitmap per proposed phrase and per failure, and a bitmap's least and largest size.
BITS, RARE, LEAST_BITS, MOST_BITS = 16, 256, 1 << 20, 1 << 30
LONGEST = 5
_FOLD = bytes(10 if b in b".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))
_ODD = np.uint64(0x9E3779B97F4A7C15)
_COUNTS = "lang string, phrase string, hash long, n long"


def parts(batches):
    """(languages, blocks of folded text) of a task's batches: pieces end with a line feed, blocks between pieces."""
    langs, texts, size = [], [], 0
    for batch in (whole.slice(i, 256) for whole in batches for i in range(0, whole.num_rows, 256)):  # few texts as Python strings at once
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            data, at = text.encode("utf-8", "surrogatepass").translate(_FOLD), 0
            while at < len(data):
                cut = data.find(b"\n", at + PART) if len(data) - at > PART else -1
                piece = data[at : cut if cut >= 0 else len(data)]
                at += len(piece) + 1
                langs.append(lang)
                texts.append(piece)
                size += len(piece)
                if size >= PART:
                    yield langs, texts
                    langs, texts, size = [], [], 0
    if texts:
        yield langs, texts


def words_of(texts: list[bytes]):
    """(number of each word, piece of each word, text of each word, the different words) of folded texts."""
    data = np.frombuffer(b"\n".join(texts), np.uint8)
    ends_piece = data == 10
    inside = ~(ends_piece | (data == 32))
    edge = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    packed = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])])
    coded = packed.dictionary_encode()
    piece = np.cumsum(ends_piece)[starts] if len(starts) else starts
    text = np.searchsorted(np.cumsum([0] + [len(t) + 1 for t in texts]), starts, side="right") - 1
    return np.asarray(coded.indices).astype(np.int64), piece, text, coded.dictionary.to_pylist()


def _has(bits: np.ndarray | None, hashes: np.ndarray) -> np.ndarray:
    if bits is None:
        return np.zeros(len(hashes), bool)
    place = hashes & np.uint64(len(bits) * 8 - 1)
    return (bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1


def count_part(langs: list[str], texts: list[bytes], proposed: np.ndarray | None, failed: np.ndarray | None = None, only: int = 0):
    """(languages, phrases, hashes, counts) of a block; languages and phrases, or else hashes, are None.

    Without ``failed``: the proposed phrases by text, their border by hash, and without phrases the words of each language.
    With ``failed``: by text the failures, and every phrase that holds one and whose parts are proposed or counted here too.
    With ``only``: the phrases of that size whose parts are proposed, by hash.
    """
    word, piece, text, different = words_of(texts)
    if not len(word):
        return
    lang_of_text, names = pd.factorize(np.array(langs, dtype=object))
    lang = lang_of_text[text]
    names = pa.array(names, pa.string())
    if not only and failed is None:
        total = np.bincount(lang, minlength=len(names))
        yield names, None, None, total
    word_hash = np.array([xxhash.xxh64_intdigest(w) for w in different], np.uint64)
    lang_hash = np.array([xxhash.xxh64_intdigest(x.encode()) for x in names.to_pylist()], np.uint64)
    # number of the phrase at each place, or -1; of each phrase: hash, language, text, whether a failure let it in
    number, unique = pd.factorize(lang * len(different) + word)
    code, last, at_lang = number, unique % len(different), unique // len(different)
    hashes = mixed(word_hash[last] ^ lang_hash[at_lang])
    places, let_in, prefix = np.arange(len(word)), np.zeros(len(unique), bool), None
    phrases: list[bytes] = []
    for size in range(1, LONGEST + 1):
        if size > 1:
            here = places[places < len(word) - 1]
            here = here[(number[here] >= 0) & (number[here + 1] >= 0)]
            places = here[piece[here] == piece[here + size - 1]]
            if not len(places):
                return
            code, unique = pd.factorize(number[places] * len(different) + word[places + size - 1])
            first = np.empty(len(unique), np.int64)
            first[code[::-1]] = places[::-1]
            prefix, last = unique // len(different), unique % len(different)
            let_in = let_in[prefix] | let_in[number[first + 1]]
            hashes = mixed(hashes[prefix] * _ODD + word_hash[last])
            at_lang = at_lang[prefix]
        member = _has(proposed, hashes) & ~let_in
        let_in |= _has(failed, hashes) & ~member
        n = np.bincount(code, minlength=len(hashes))
        if only == size:
            yield None, None, hashes.view(np.int64), n
            return
        kept = np.flatnonzero(member | let_in)
        if not only:
            if size == 1:
                phrases = [different[w] for w in last[kept]]
            else:
                phrases = [phrases[p] + b" " + different[w] for p, w in zip(prefix[kept].tolist(), last[kept].tolist())]
            asked = np.arange(len(kept)) if failed is None else np.flatnonzero(let_in[kept])
            if len(asked):
                yield names.take(pa.array(at_lang[kept[asked]])), [phrases[i] for i in asked], None, n[kept[asked]]
            if failed is None:
                border = np.flatnonzero(~member)
                yield None, None, hashes[border].view(np.int64), n[border]
        # only proposed phrases and those let in keep a number
        dense = np.full(len(hashes), -1)
        dense[kept] = np.arange(len(kept))
        number = np.full(len(word), -1)
        number[places] = dense[code]
        hashes, at_lang, let_in = hashes[kept], at_lang[kept], let_in[kept]


def _rows(found) -> pa.RecordBatch:
    lang, phrase, hashes, n = found
    arrays = [
        pa.nulls(len(n), pa.string()) if lang is None else lang,
        pa.nulls(len(n), pa.string()) if phrase is None else pa.array(phrase, pa.binary()).cast(pa.string()),
        pa.nulls(len(n), pa.int64()) if hashes is None else pa.array(hashes),
        pa.array(n.astype(np.int64)),
    ]
    return pa.RecordBatch.from_arrays(arrays, ["lang", "phrase", "hash", "n"])


def _counted(docs: DataFrame, proposed: np.ndarray | None, failed: np.ndarray | None = None, only: int = 0) -> DataFrame:
    """The counts of ``count_part``, summed over the table."""
    shared = docs.sparkSession.sparkContext.broadcast((proposed, failed))

    def count(batches):
        for langs, texts in parts(batches):
            for found in count_part(langs, texts, *shared.value, only):
                yield _rows(found)

    return docs.mapInArrow(count, _COUNTS).groupBy("lang", "phrase", "hash").agg(F.sum("n").alias("n"))


def _bitmap(hashes: DataFrame, each: int) -> np.ndarray:
    """A bitmap over the column ``hash`` with ``each`` bits per row or somewhat more, within its least and largest size."""
    bits = min(MOST_BITS, max(LEAST_BITS, 1 << (each * hashes.count()).bit_length()))
    out = np.zeros(bits // 8, np.uint8)
    size = BITMAP_BITS // 8
    for row in key_filter(hashes, "hash", bits // BITMAP_BITS).collect():
        low = (row["_bucket"] - 1) * size
        out[low : low + size] = np.frombuffer(row["_bits"], np.uint8)
    return out


def frequent_phrases(docs: DataFrame, support: int = 100, text_col: str = "text", lang_col: str = "lang") -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, n) of all phrases of up to five words with a count of ``support``; (lang, n) of all words."""
    language = F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang")
    docs = docs.select(language, text_of(text_col).alias("text"))
    sample = settle(docs.where(F.pmod(F.xxhash64("text", F.monotonically_increasing_id()), F.lit(SAMPLE)) == 0))
    least = max(1, math.floor(support / SAMPLE * LOWERED))
    levels, bits = sample.select(F.lit(0).cast("long").alias("hash")).limit(0), np.zeros(LEAST_BITS // 8, np.uint8)
    for size in range(1, LONGEST + 1):
        level = settle(_counted(sample, bits, only=size).where(F.col("n") >= least).select("hash"))
        if level.isEmpty():
            break
        levels = levels.union(level)
        bits = _bitmap(levels, BITS)

    frequent = F.col("n") >= support
    total = F.col("phrase").isNull() & F.col("hash").isNull()
    counts = settle(_counted(docs, bits).where(frequent | total))
    found, totals = counts.where(F.col("phrase").isNotNull()), counts.where(total).select("lang", "n")
    failures = counts.where(F.col("hash").isNotNull()).select("hash")
    if not failures.isEmpty():
        found = found.union(settle(_counted(docs, bits, _bitmap(failures, RARE)).where(frequent)))
    return found.select("lang", "phrase", "n"), totals


def collocations(docs: DataFrame, support: int = 100, top: int = 2000, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): per language the first ``top`` phrases by their weakest cut.

    a, l and r count the phrase and the two sides of the cut, n all words; the score is floor(1000 * a * n / (l * r)), worked
    out in exact decimals. A phrase that a longer one with the same count holds is left out.
    """
    counted, totals = frequent_phrases(docs, support, text_col, lang_col)
    counted = counted.select("*", F.split("phrase", " ").alias("w")).select("*", F.size("w").alias("size"))
    words = counted.where("size > 1").select("lang", "phrase", "size", F.col("n").alias("a"), "w")

    # a longer phrase with the same count means that one longer by one word has it too: counts never rise with length
    inner = F.explode(F.array(F.slice("w", 1, F.col("size") - 1), F.slice("w", 2, F.col("size") - 1)))
    held = words.where("size > 2").select("lang", "a", inner.alias("w")).select("lang", "a", F.array_join("w", " ").alias("phrase")).distinct()
    kept = words.join(held, ["lang", "phrase", "a"], "left_anti")

    def side(of: Column, name: str) -> Column:
        return F.array_join(of, " ").alias(name)

    cuts = kept.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.select("lang", "phrase", "a", "k", side(F.slice("w", F.lit(1), F.col("k")), "first"), side(F.slice("w", F.col("k") + 1, F.col("size")), "rest"))
    cuts = cuts.join(counted.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l")), ["lang", "first"])
    cuts = cuts.join(counted.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r")), ["lang", "rest"])
    cuts = cuts.join(totals, "lang")
    wide = [F.col(c).cast("decimal(19,0)") for c in ("a", "n", "l", "r")]
    products = cuts.withColumns({"an": (wide[0] * wide[1]).cast("decimal(34,0)"), "lr": wide[2] * wide[3]})
    scored = products.withColumn("score", F.expr("cast(1000 * an div lr as bigint)"))
    weakest = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    flat = weakest.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    ranked = flat.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
