"""Toxicity by compression distance: how much shorter a window gets with a dictionary of toxic text than with one of ordinary text.

Training. At most ``SAMPLE`` labelled documents of either class, in the order of a hash of their id, exact copies once: those
of at most ``SAMPLE_BYTES`` bytes first, whole; where they are too few, a slice of longer ones at a place given by the hash.
Both zstandard dictionaries end with the same content, trained on windows of ordinary
texts, so that ordinary language costs the same with either. Before it the toxic dictionary holds the segments that its
class repeats and the other does not: words, and beginnings of words from four letters on, so that inflected forms count.
A segment is one if the documents that hold it, or those of whose words it makes up a two hundredth, differ between the
classes at a fixed level of the log-likelihood ratio; how strong other segments are does not matter, and none is left out
for room. Of segments that begin one another the strongest stands. The ordinary dictionary holds zeros there.

Scoring. A text is lower-cased and cut into windows of eight words. A window counts as a hit if one of its words
begins with a segment and the toxic dictionary makes it shorter; what lies inside other words is chance. How far the
number of hits lies above that of ordinary text of the same length, as the root of the deviance, goes through a logistic
function fitted on the sample; that is the score.

Defined cases: null and empty texts have no window and get the score of that; without rows of both classes every score
is 0; a document with several labels is toxic if one says so; null labels are ignored; ties in the sample are broken by
id; repeated rows get the same score; an empty table gives an empty result; long texts are scored whole.
Extra columns are not looked at.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import settle
from .common import text_of

SAMPLE, SAMPLE_BYTES = 2000, 16384
WINDOW_WORDS, LEAST_SAVING = 8, 1
#: Least log-likelihood ratio of a segment: one in 100,000 of the segments that do not tell the classes apart reaches it.
LEVEL = 19.51
#: Letters of word beginnings, shortest and longest.
BEGINNING = 4, 12
#: A document is dense in a segment that is one in so many of its words.
DENSE = 200
BASE_BYTES = 1500
WORD = re.compile(r"\w+")

_compressors: dict[int, tuple] = {}


def windows(text: str):
    """Windows of eight words."""
    words = WORD.findall(text.lower())
    for i in range(0, len(words), WINDOW_WORDS):
        yield words[i : i + WINDOW_WORDS]


def written(words: list[str]) -> bytes:
    """Words as bytes with a space on either side, so that a word's beginning and end can be told."""
    return f" {' '.join(words)} ".encode("utf-8", "surrogatepass")


def segments(texts: list[tuple[int, str]]) -> list[str]:
    """What the documents of class 1 hold more often, strongest last: beginnings of words as " abcd", words as " abcd "."""
    least, most = BEGINNING
    n = [sum(label == c for label, _ in texts) for c in (0, 1)]
    holding = {kind: (Counter(), Counter()) for kind in ("any", "dense")}
    # below so many documents of class 1 no segment reaches the level, even if the other class has none
    fewest = LEVEL / (2 * math.log(sum(n) / n[1])) if all(n) else math.inf
    of_word: dict[str, list[str]] = {}
    for class_ in (1, 0):
        for text in (t for label, t in texts if label == class_):
            words, found = Counter(WORD.findall(text.lower())), Counter()
            for word, k in words.items():
                if word not in of_word:
                    mine = [f" {word} ", *(f" {word[:i]}" for i in range(least, min(len(word), most) + 1))]
                    of_word[word] = mine if class_ else [x for x in mine if x in holding["any"][1]]
                for x in of_word[word]:
                    found[x] += k
            holding["any"][class_].update(found.keys())
            holding["dense"][class_].update(x for x, k in found.items() if k * DENSE >= words.total())
        for x in [x for x, k in holding["any"][1].items() if k < fewest]:
            del holding["any"][1][x]
        of_word.clear()

    def ratio(kind: str, segment: str) -> float:
        b, a = (c[segment] for c in holding[kind])
        if a * n[0] <= b * n[1]:
            return 0.0
        expected = (a + b) * n[1] / (n[0] + n[1])
        return 2 * (a * math.log(a / expected) + (b * math.log(b / (a + b - expected)) if b else 0.0))

    ranked = sorted(((max(ratio("any", x), ratio("dense", x)), len(x), x) for x in holding["any"][1]), reverse=True)
    out, begun = {}, set()  # the chosen in order; their beginnings, themselves included
    for r, _, x in ranked:
        if r < LEVEL:
            break
        if x not in begun and not any(x[:i] in out for i in range(least + 1, len(x))):
            out[x] = r
            begun.update(x[:i] for i in range(least + 1, len(x) + 1))
    return [*reversed(out)]


class Model:
    def __init__(self, texts: list[tuple[int, str]]):
        import zstandard

        ordinary = [written(w) for label, t in texts if not label for w in windows(t)]
        try:
            base = zstandard.train_dictionary(2048, ordinary[:: max(len(ordinary) // 20_000, 1)], k=16, d=6).as_bytes()
        except zstandard.ZstdError:  # too few windows for the trainer
            base = b" ".join(ordinary)
        found = segments(texts)
        self.words = {x[1:-1] for x in found if x.endswith(" ")}
        self.beginnings = {x[1:] for x in found if not x.endswith(" ")}
        self.lengths = sorted({len(x) for x in self.beginnings})
        toxic = ("".join(found) + " ").encode("utf-8", "surrogatepass")
        self.dictionaries = (bytes(len(toxic)) + base[-BASE_BYTES:], toxic + base[-BASE_BYTES:])
        counts = [(label, *self.hits(t)) for label, t in texts]
        clean = [(h, n) for label, h, n in counts if not label]
        self.background = (sum(h for h, _ in clean) + 1) / (sum(n for _, n in clean) + 200)
        points = np.array([self.features(h, n) for _, h, n in counts])
        self.weights = fit(points, np.array([label for label, _ in texts], dtype=float))

    def compressors(self) -> tuple:
        import zstandard as z

        key = hash(self.dictionaries)
        if key not in _compressors:
            size = max(12, (len(self.dictionaries[1]) + 1024).bit_length())  # the whole dictionary lies in the window
            options = z.ZstdCompressionParameters(
                window_log=size, hash_log=size, chain_log=size, search_log=3, min_match=4, strategy=z.STRATEGY_GREEDY, target_length=16
            )
            _compressors[key] = tuple(
                z.ZstdCompressor(dict_data=z.ZstdCompressionDict(d, dict_type=z.DICT_TYPE_RAWCONTENT), compression_params=options)
                for d in self.dictionaries
            )
        return _compressors[key]

    def hits(self, text: str) -> tuple[int, int]:
        """Windows with a segment that the toxic dictionary makes shorter, and all windows."""
        ordinary, toxic = (c.compress for c in self.compressors())
        hits = n = 0
        for window in windows(text):
            n += 1
            if any(w in self.words or any(w[:i] in self.beginnings for i in self.lengths) for w in window):
                piece = written(window)
                hits += len(ordinary(piece)) - len(toxic(piece)) >= LEAST_SAVING
        return hits, n

    def features(self, hits: int, n: int) -> tuple[float, float, float]:
        """Signed root of the deviance of the hits from those that ordinary text of that length has, plain and bent."""
        expected = self.background * n
        over = 2 * (hits * math.log(hits / expected) - hits + expected) if hits > expected else 0.0
        z = math.sqrt(max(over, 0.0))
        return 1.0, z, min(z, 2.0)

    def scores(self, texts: list[str]) -> np.ndarray:
        points = np.array([self.features(*self.hits(t)) for t in texts]).reshape(-1, 3)
        return 1 / (1 + np.exp(-np.clip(points @ self.weights, -30, 30)))


def fit(points: np.ndarray, labels: np.ndarray, ridge: float = 0.1, steps: int = 50) -> np.ndarray:
    """Weights of a logistic regression by Newton's method."""
    w = np.zeros(points.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(points @ w, -30, 30)))
        gradient = points.T @ (p - labels) + ridge * w
        hessian = (points * (p * (1 - p))[:, None]).T @ points + ridge * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


def train(
    docs: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text", label_col="toxic", per_class=SAMPLE, max_bytes=SAMPLE_BYTES
) -> Model | None:
    """The model of the labelled documents; ``per_class`` and ``max_bytes`` bound what reaches the driver."""
    marked = (
        labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias("id"))
        .agg((F.max(label_col) > 0).cast("int").alias("label"))
    )
    ids = docs.select(F.col(id_col).alias("id"), (F.octet_length(text_of(text_col)) > max_bytes).alias("long"))
    # only ids and sizes meet the labels; per class the first rows that have a document
    held = settle(ids.join(marked, "id").groupBy("id", "label").agg(F.min("long").alias("long")))
    order = [F.col("long"), F.xxhash64("id"), F.col("id")]
    parts = [held.where(F.col("label") == c).orderBy(*order).limit(per_class).select("id", "label") for c in (0, 1)]
    chosen = parts[0].unionAll(parts[1])  # at most 2 * per_class rows
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    found = rows.join(F.broadcast(chosen), "id")
    room = max_bytes // 4  # characters that surely fit
    long, size = F.octet_length("text") > max_bytes, F.length("text")
    start = F.pmod(F.xxhash64("id"), F.greatest(size - room, F.lit(1))).cast("int") + 1
    found = found.withColumn("text", F.when(long, F.substring("text", start, F.lit(room))).otherwise(F.col("text")))
    found = found.groupBy("text").agg(F.max("label").alias("label"))
    found = found.orderBy(F.xxhash64("text"), "text").limit(4 * per_class).collect()  # an id may have many texts
    texts = sorted((r["label"], r["text"]) for r in found)
    return Model(texts) if len({label for label, _ in texts}) == 2 else None


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, score, predicted. No shuffle; the model is two dictionaries of a few kB and three weights."""
    kind = dict(docs.dtypes)[id_col]
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    out = rows.mapInArrow(_scorer(model), f"id {kind}, score double, predicted int")
    return out.withColumnRenamed("id", id_col)


def _scorer(model: Model | None):
    def run(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            p = model.scores(texts) if model is not None and texts else np.zeros(len(texts))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in batch.schema.names if c != "text"), pa.array(p), pa.array((p >= 0.5).astype(np.int32))],
                names=[*(c for c in batch.schema.names if c != "text"), "score", "predicted"],
            )

    return run


def keep_clean(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """The documents that the model does not call toxic, with all their columns; no shuffle."""
    schema = docs.schema

    def run(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column(text_col).to_pylist()]
            if model is None or not texts:
                yield batch
            else:
                yield batch.filter(pa.array(model.scores(texts) < 0.5))

    return docs.mapInArrow(run, schema)
