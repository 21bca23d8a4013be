"""Language identification with interpolated Kneser-Ney character models, one per language.

Training. Of every language at most ``SAMPLE`` labelled documents are taken, in the order of a hash of their id: those of
at most ``SAMPLE_CHARS`` characters first, whole; where they are too few, a slice of that size, at a place given by the hash,
of longer ones. Every eighth of them is held back for calibration. The other
texts, lower-cased, white space, digits and signs each folded to one mark, give the character n-grams up to order 5.
Interpolated Kneser-Ney smoothing with one discount per order turns the counts into probabilities; lower orders count the
different characters before an n-gram, the lowest one backs off to the uniform distribution.

Storage. The log-probability of the last character of every n-gram that any language has met is computed for all
languages and stored in one row of a matrix; the 64-bit hashes of the n-grams stand in a sorted array beside it, with an
index on their leading bits. A text's score is a sum over its characters: the longest stored n-gram that ends there. An
n-gram that no language has met backs off by the same amount in each, so it decides nothing and the shorter one counts.

Decision. The language with the lowest cross-entropy per character wins. The score is a logistic function of two numbers:
the lead over the second-best and the distance from the cross-entropies that the held-back texts of that language show.
Scores below ``reject_below`` give ``und`` instead (off by default).

Defined cases: null text and text without a letter give ``und`` with score 0; without any labelled row all do; a single
language wins wherever there is a letter; ties go to the first language by name. Repeated rows get the same answer, an
empty table gives an empty result, texts of any length are read whole in slices. Extra columns are not looked at.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import text_of

ORDER = 5
SAMPLE, SAMPLE_CHARS = 120, 8192
DISCOUNT = 0.75
UNKNOWN = "und"
#: Characters scored at once.
SLICE = 1 << 19
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_TOP = 16

_folds: list[np.ndarray] = []


def fold_table() -> np.ndarray:
    """Lower-cased code point of every character of the basic plane; 1 for any that is not a letter."""
    if not _folds:
        table = np.ones(0x10000, dtype=np.uint32)
        for c in range(0x10000):
            ch = chr(c)
            if ch.isalpha():
                low = ch.lower()
                table[c] = ord(low) if len(low) == 1 else c
        _folds.append(table)
    return _folds[0]


def symbols(text: str) -> np.ndarray:
    """Symbols of a text: lower-cased letters, runs of all else as one mark, a mark at either end."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    low = np.where(codes < 0x10000, fold_table()[np.minimum(codes, 0xFFFF)], codes)
    low = np.concatenate([np.ones(1, np.uint32), low, np.ones(1, np.uint32)])
    return low[np.concatenate([[True], (low[1:] != 1) | (low[:-1] != 1)])]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[1]
    x = (x ^ (x >> np.uint64(27))) * _MIX[2]
    return x ^ (x >> np.uint64(31))


def gram_hashes(s: np.ndarray, order: int) -> list[np.ndarray]:
    """For n = 1 to ``order``: the hashes of the n-grams ending at each symbol from the n-th on."""
    one = _mixed(s.astype(np.uint64) + _MIX[0])
    out = [one]
    for n in range(2, order + 1):
        out.append(_mixed(out[-1][:-1] * _MIX[0] + one[n - 1 :]) if len(one) >= n else one[:0])
    return out


class KneserNey:
    """Counts of one language and the probabilities of single n-grams."""

    def __init__(self, texts: list[str], order: int = ORDER, discount: float = DISCOUNT):
        self.order, self.d = order, discount
        self.count: list[dict[tuple, int]] = [defaultdict(int) for _ in range(order + 1)]
        grams: set[tuple] = set()
        for text in texts:
            s = tuple(symbols(text).tolist())
            for i in range(len(s) - order + 1):
                self.count[order][s[i : i + order]] += 1
            # n-grams at the text's start have nothing before them and count themselves
            for n in range(1, order):
                if len(s) >= n:
                    self.count[n][s[:n]] += 1
                    grams.add(s[:n])
        for n in range(order, 1, -1):
            for gram in self.count[n]:
                self.count[n - 1][gram[1:]] += 1
        self.total: list[dict[tuple, int]] = [defaultdict(int) for _ in range(order + 1)]
        self.kinds: list[dict[tuple, int]] = [defaultdict(int) for _ in range(order + 1)]
        for n in range(1, order + 1):
            for gram, c in self.count[n].items():
                self.total[n][gram[:-1]] += c
                self.kinds[n][gram[:-1]] += 1

    def probability(self, gram: tuple, uniform: float) -> float:
        """Interpolated probability of the last symbol after the others."""
        p = uniform
        for n in range(1, len(gram) + 1):
            tail = gram[len(gram) - n :]
            total = self.total[n].get(tail[:-1], 0)
            if total:
                p = (max(self.count[n].get(tail, 0) - self.d, 0) + self.d * self.kinds[n][tail[:-1]] * p) / total
        return p


class Model:
    """Sorted hashes of all n-grams met, per n, with the log-probabilities in all languages."""

    def __init__(self, samples: dict[str, list[str]], order: int = ORDER):
        self.langs = sorted(samples)
        self.order = order
        fitted = {lang: KneserNey([t for i, t in enumerate(samples[lang]) if i % 8 or len(samples[lang]) < 8], order) for lang in self.langs}
        alphabet = {g for m in fitted.values() for g in m.count[1]}
        uniform = 1.0 / (len(alphabet) + 1)
        self.unseen = np.log(uniform)
        self.hashes, self.index, self.values = [], [], []
        for n in range(1, order + 1):
            met = sorted({g for m in fitted.values() for g in m.count[n]})
            table = np.array([[np.log(m.probability(g, uniform)) for m in (fitted[x] for x in self.langs)] for g in met])
            keys = np.array([gram_hashes(np.array(g, np.uint32), n)[n - 1][0] for g in met], dtype=np.uint64)
            at = np.argsort(keys)
            self.hashes.append(keys[at])
            self.values.append(table.reshape(len(met), len(self.langs))[at].astype(np.float32))
            self.index.append(np.searchsorted(self.hashes[-1], np.arange((1 << _TOP) + 1, dtype=np.uint64) << np.uint64(64 - _TOP)))
            self.index[-1][-1] = len(keys)
        self._calibrate(samples)

    def _find(self, n: int, keys: np.ndarray) -> np.ndarray:
        """Row of each hash among those of order n, -1 if it isn't there."""
        have = self.hashes[n - 1]
        if not len(have):
            return np.full(len(keys), -1)
        top = (keys >> np.uint64(64 - _TOP)).astype(np.int64)
        at, end = self.index[n - 1][top].astype(np.int64), self.index[n - 1][top + 1]
        found = np.full(len(keys), -1)
        live = np.flatnonzero(at < end)
        while len(live):  # a few steps: the index leaves a handful of hashes for each leading bits
            here = have[at[live]]
            hit = here == keys[live]
            found[live[hit]] = at[live[hit]]
            live = live[~hit & (here < keys[live])]
            at[live] += 1
            live = live[at[live] < end[live]]
        return found

    def log_likelihoods(self, s: np.ndarray) -> np.ndarray:
        """Per symbol and language, by the longest n-gram met that ends there."""
        out = np.full((len(s), len(self.langs)), self.unseen, dtype=np.float32)
        todo = np.ones(len(s), dtype=bool)
        hashes = gram_hashes(s, self.order)
        for n in range(self.order, 0, -1):
            where = np.flatnonzero(todo[n - 1 :])
            if not len(where):
                continue
            row = self._find(n, hashes[n - 1][where])
            hit = row >= 0
            out[where[hit] + n - 1] = self.values[n - 1][row[hit]]
            todo[where[hit] + n - 1] = False
        return out

    def entropies(self, texts: list[str]) -> np.ndarray:
        """Cross-entropy per symbol of every text in every language, in nats."""
        out = np.zeros((len(texts), len(self.langs)))
        group: list[np.ndarray] = []
        members: list[int] = []
        size = 0

        def flush():
            nonlocal group, members, size
            if group:
                scores = self.log_likelihoods(np.concatenate(group))
                starts = np.concatenate([[0], np.cumsum([len(g) for g in group])[:-1]]).astype(int)
                np.add.at(out, np.array(members), np.add.reduceat(scores, starts, axis=0))
            group, members, size = [], [], 0

        lengths = np.zeros(len(texts))
        for i, text in enumerate(texts):
            for at in range(0, max(len(text), 1), SLICE):
                s = symbols(text[at : at + SLICE])
                lengths[i] += len(s)
                group.append(s)
                members.append(i)
                size += len(s)
                if size >= SLICE:
                    flush()
        flush()
        return -out / np.maximum(lengths, 1)[:, None]

    def _calibrate(self, samples: dict[str, list[str]]) -> None:
        """Mean and spread of each language's own held-back cross-entropies, and the slope that the leads ask for."""
        self.mean, self.spread, leads = np.zeros(len(self.langs)), np.ones(len(self.langs)), []
        for k, lang in enumerate(self.langs):
            texts = samples[lang]
            held = [t for i, t in enumerate(texts) if i % 8 == 0] if len(texts) >= 8 else texts
            h = self.entropies(held)
            self.mean[k], self.spread[k] = np.median(h[:, k]), max(h[:, k].std(), 0.05)
            if len(self.langs) > 1:
                leads += list(np.delete(h, k, axis=1).min(1) - h[:, k])
        self.slope = 6.0 / max(np.median(leads), 1e-3) if leads else 0.0

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        h = self.entropies(texts)
        best = h.argmin(1)
        row = np.arange(len(texts))
        lead = np.sort(h, axis=1)[:, 1] - h[row, best] if len(self.langs) > 1 else np.full(len(texts), 1.0)
        sure = 1 / (1 + np.exp(-np.clip(self.slope * lead, 0, 30)))
        far = np.maximum((h[row, best] - self.mean[best]) / self.spread[best] - 4, 0)
        return [self.langs[k] for k in best], sure * np.exp(-far / 8)


def sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str, per_lang: int, chars: int) -> dict[str, list[str]]:
    """At most ``per_lang`` texts of each language: short ones whole, then slices of long ones, in the order of a hash of their id."""
    size, text = F.length(text_col), F.col(text_col)
    rows = docs.where(F.col(lang_col).isNotNull() & text.isNotNull() & (size > 0))
    h = F.xxhash64(id_col)
    long = size > chars
    start = F.when(long, F.pmod(h, F.greatest(size - chars, F.lit(1)))).otherwise(0).cast("int") + 1
    taken = rows.select(F.col(lang_col).alias("l"), long.alias("long"), h.alias("h"), F.xxhash64(text_col).alias("x"), F.substring(text, start, F.lit(chars)).alias("t"))
    # ranked with the slices: Spark keeps per_lang rows of a language in each task before it shuffles any
    rank = Window.partitionBy("l").orderBy("long", "h", "x")
    chosen = taken.withColumn("n", F.row_number().over(rank)).where(F.col("n") <= per_lang)
    out: dict[str, list[str]] = defaultdict(list)
    for r in sorted(chosen.select("l", "n", "t").collect(), key=lambda r: (r["l"], r["n"])):
        out[r["l"]].append(r["t"])
    return dict(out)


def train(docs: DataFrame, id_col="doc_id", text_col="text", lang_col="lang", per_lang=SAMPLE, chars=SAMPLE_CHARS) -> Model | None:
    """The model of the labelled rows of ``docs``; None if there are none. ``per_lang`` and ``chars`` bound what reaches the driver."""
    samples = sample(docs, id_col, text_col, lang_col, per_lang, chars)
    return Model(samples) if samples else None


def identify(docs: DataFrame, model: Model | None, id_col="doc_id", text_col="text", reject_below: float = 0.0) -> DataFrame:
    """One row per document: id, lang_pred, score. No shuffle; the model is broadcast, its size bounded by the sample."""
    kind = dict(docs.dtypes)[id_col]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(id_col).alias("id"), F.when(F.col(text_col).rlike(r"\p{L}"), F.col(text_col)).alias("text"))

    def predict(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            at = [i for i, t in enumerate(texts) if t is not None]
            lang, score = [UNKNOWN] * len(texts), [0.0] * len(texts)
            if shared.value is not None and at:
                for i, name, p in zip(at, *shared.value.predict([texts[i] for i in at])):
                    if p >= reject_below:
                        lang[i] = name
                    score[i] = float(p)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(lang, pa.string()), pa.array(score, pa.float64())], names=["id", "lang_pred", "score"]
            )

    out = rows.mapInArrow(predict, f"id {kind}, lang_pred string, score double")
    return out.withColumnRenamed("id", id_col)
