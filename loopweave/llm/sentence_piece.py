"""SentencePiece encoding and decoding over a lattice of words, substrings and pieces.

A text with its spaces written as U+2581 falls into words, each a run of that mark and what follows it. No piece of such a
vocabulary goes over a word's end, so words are encoded one by one, and each different word of a batch once.

The lattice of the words is relational: every substring of at most the longest piece's length is exploded, equi-joined
with the piece table by hash, and the edges that remain are grouped by word. What is folded over it depends on the model:

* unigram models: ``viterbi``, the best sum of scores, as a Spark higher-order aggregate over a word's edges in order of
  their ends, and a second one back from the end (``encode_words``, DataFrame code throughout);
* BPE models: their segmentation is not the best sum of scores but the result of merges in order of score, so the Viterbi
  fold can't give it. The fold over the same edges merges, in every step, the best edge that joins two neighbours, in all
  words at once (``merge_words``).

Characters without a piece become the byte pieces of their UTF-8 form, or the unknown piece in models without those.

The texts are encoded where they are read: the occurrences of words are not shuffled. Words longer than ``WIDE`` are
merged one at a time with a heap. Workers keep the ids of the words met lately: when ``WORDS_KEPT`` are held these become
the older ones, what was older before goes, and an older word that is met again is one of the newer.

Defined cases: null text counts as empty and gives no pieces; an empty text has none; repeated rows get the same ids; an
empty table gives an empty result; texts and words of any length are encoded whole; decoding writes U+2581 as a space.
Extra columns are not looked at.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_of
from .shingles import mixed

MARK = "▁"
WIDE = 24
WORDS_KEPT = 200_000
#: Words merged at once.
GROUP = 8192
#: Bits of a hash that the table of beginnings leaves out.
SHIFT = 44
UNKNOWN_PENALTY = 10.0

_workers: dict[int, "Bpe"] = {}


@dataclass(frozen=True)
class Pieces:
    """The piece table of a model: texts, ids and scores of ordinary pieces, ids of the byte pieces, and its kind."""

    texts: tuple[str, ...]
    ids: tuple[int, ...]
    scores: tuple[float, ...]
    bytes_: tuple[int, ...]
    unknown: int
    all_: tuple[str, ...]

    @classmethod
    def read(cls, path: str) -> "Pieces":
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        every = range(sp.get_piece_size())
        plain = [i for i in every if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        names = {sp.id_to_piece(i): i for i in every if sp.is_byte(i)}
        return cls(
            tuple(sp.id_to_piece(i) for i in plain),
            tuple(plain),
            tuple(sp.get_score(i) for i in plain),
            tuple(names[f"<0x{b:02X}>"] for b in range(256)) if len(names) == 256 else (),
            sp.unk_id(),
            tuple(sp.id_to_piece(i) for i in every),
        )


def marked(text: str) -> str:
    return MARK + text.replace(" ", MARK) if text else ""


def words_of(text: str) -> list[str]:
    """Words of a marked text: each a run of marks and the characters up to the next mark."""
    out, held = [], ""
    for part in text.split(MARK)[1:] if text else []:
        held += MARK
        if part:
            out.append(held + part)
            held = ""
    return out + [held] if held else out


def keys_of(text: str) -> list[str]:
    """Words of a text, each without the mark that it begins with."""
    if MARK in text or "  " in text or text[:1] in ("", " ") or text[-1] == " ":
        return [word[1:] for word in words_of(marked(text))]
    return text.split(" ")


class Bpe:
    """Merges words by the scores of the pieces that their substrings are."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.table = {t: (s, i) for t, i, s in zip(pieces.texts, pieces.ids, pieces.scores)}
        self.longest = max(map(len, pieces.texts), default=1)
        codes = [np.array([ord(c) for c in t], np.uint64) for t in pieces.texts]
        hashes = np.array([self._hash(c[None, :])[0] for c in codes], np.uint64)
        order = np.argsort(hashes)
        self.hashes = hashes[order]
        # rank of a piece by score, best first: what a merge compares
        rank = np.empty(len(hashes), np.int64)
        rank[np.lexsort((np.arange(len(hashes)), -np.array(pieces.scores)))] = np.arange(len(hashes))
        self.rank = rank[order].astype(np.int32)
        self.by_rank = np.empty(len(hashes), np.int32)
        self.by_rank[rank] = pieces.ids
        # whether a piece's hash may begin with these bits: most substrings are no piece
        self.begun = np.zeros(1 << (64 - SHIFT), bool)
        self.begun[self.hashes >> np.uint64(SHIFT)] = True
        # ids, as bytes, of words without their first mark
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    @staticmethod
    def _hash(codes: np.ndarray) -> np.ndarray:
        h = np.zeros(len(codes), np.uint64)
        for k in range(codes.shape[1]):
            h = h * np.uint64(0x9E3779B97F4A7C15) + mixed(codes[:, k] + np.uint64(1))
        return h

    def edges(self, codes: np.ndarray) -> np.ndarray:
        """Rank of the piece that each substring [i, j] of each word is, or a number beyond all: the lattice as (word, i, j)."""
        n, width = codes.shape
        none = np.int32(len(self.hashes))
        out = np.full((n, width, width), none, np.int32)
        letters = mixed(codes.astype(np.uint64) + np.uint64(1))
        h = np.zeros((n, width), np.uint64)
        for length in range(1, min(width, self.longest) + 1):
            starts = width - length + 1
            h = h[:, :starts] * np.uint64(0x9E3779B97F4A7C15) + letters[:, length - 1 :]
            row, i = np.nonzero(self.begun[h >> np.uint64(SHIFT)])
            mine = h[row, i]
            at = np.minimum(np.searchsorted(self.hashes, mine), len(self.hashes) - 1)
            same = self.hashes[at] == mine
            row, i = row[same], i[same]
            out[row, i, i + length - 1] = self.rank[at[same]]
        return out

    def merge_words(self, words: list[str]) -> list[bytes]:
        """Ids of words of one and the same length."""
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(words), -1)
        n, width = codes.shape
        lattice = self.edges(codes)
        none = np.int32(len(self.hashes))
        place = np.arange(width)
        ends = np.tile(place, (n, 1))  # last character of the symbol that starts here; -1: none starts here
        begins = ends.copy()  # first character of the symbol that ends here
        joins = np.full((n, width), none, np.int32)  # rank of the piece that the symbol that starts here and the next one make
        joins[:, :-1] = lattice[:, place[:-1], place[1:]]
        live = np.arange(n)
        while len(live):
            at = joins[live]
            best = at.argmin(1)
            going = at[np.arange(len(live)), best] < none
            live, best = live[going], best[going]
            gone = ends[live, best] + 1
            end = ends[live, gone]
            ends[live, best], ends[live, gone] = end, -1
            begins[live, end] = best
            joins[live, gone] = none
            # only the merged symbol's joins with its neighbours are others now
            after = np.minimum(end + 1, width - 1)
            joins[live, best] = np.where(end + 1 < width, lattice[live, best, ends[live, after]], none)
            inner = best > 0
            row, before = live[inner], begins[live[inner], best[inner] - 1]
            joins[row, before] = lattice[row, before, end[inner]]
        row, start = np.nonzero(ends >= 0)
        ranks = lattice[row, start, ends[row, start]]
        ids = np.where(ranks < none, self.by_rank[np.minimum(ranks, none - 1)], -1).astype(np.int32)
        bounds = np.searchsorted(row, np.arange(n + 1)) * 4
        data, edges = ids.tobytes(), bounds.tolist()
        out = [data[a:b] for a, b in zip(edges[:-1], edges[1:])]
        for k in np.unique(row[ids < 0]).tolist():
            mine = slice(edges[k] // 4, edges[k + 1] // 4)
            parts = ([i] if i >= 0 else self.fallback(words[k][at]) for at, i in zip(start[mine].tolist(), ids[mine].tolist()))
            out[k] = np.array([x for part in parts for x in part], np.int32).tobytes()
        return out

    def fallback(self, char: str) -> list[int]:
        if not self.pieces.bytes_:
            return [self.pieces.unknown]
        return [self.pieces.bytes_[b] for b in char.encode("utf-8", "surrogatepass")]

    def merge_long(self, word: str) -> np.ndarray:
        """Ids of a word of any length: the same merges in order of score and place, from a heap."""
        parts: list[str | None] = list(word)
        right = list(range(1, len(parts))) + [-1]
        left = list(range(-1, len(parts) - 1))
        heap: list[tuple[float, int, str]] = []

        def offer(i: int) -> None:
            j = right[i]
            if j >= 0 and len(parts[i]) + len(parts[j]) <= self.longest:
                joined = parts[i] + parts[j]
                if joined in self.table:
                    heapq.heappush(heap, (-self.table[joined][0], i, joined))

        for i in range(len(parts) - 1):
            offer(i)
        while heap:
            _, i, joined = heapq.heappop(heap)
            j = right[i]
            if parts[i] is None or j < 0 or parts[i] + parts[j] != joined:
                continue
            parts[i], parts[j] = joined, None
            right[i] = right[j]
            if right[i] >= 0:
                left[right[i]] = i
            offer(i)
            if left[i] >= 0:
                offer(left[i])
        ids = [x for p in parts if p is not None for x in ([self.table[p][1]] if p in self.table else self.fallback(p))]
        return np.array(ids, np.int32)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        split = [keys_of(t) for t in texts]
        if len(self.known) > WORDS_KEPT:
            self.known, self.older = {}, self.known
        known = self.known
        groups: dict[int, list[str]] = {}
        long: dict[str, bytes] = {}
        for key in set(chain.from_iterable(split)).difference(known):
            if key in self.older:
                known[key] = self.older[key]
            elif len(key) >= WIDE:
                long[key] = self.merge_long(MARK + key).tobytes()
            else:
                groups.setdefault(len(key), []).append(key)
        for keys in groups.values():
            for at in range(0, len(keys), GROUP):
                part = keys[at : at + GROUP]
                known.update(zip(part, self.merge_words([MARK + key for key in part])))
        known.update(long)
        out = [np.frombuffer(b"".join(map(known.__getitem__, keys)), np.int32) for keys in split]
        for key in long:  # not kept: their number of ids has no bound
            del known[key]
        return out


def worker(pieces: Pieces) -> Bpe:
    key = hash(pieces)
    if key not in _workers:
        _workers[key] = Bpe(pieces)
    return _workers[key]


def decode_ids(ids: list[int], pieces: Pieces) -> str:
    """The text of a row of ids; bytes of byte pieces are joined first."""
    value = {i: b for b, i in enumerate(pieces.bytes_)}
    out = b"".join(bytes([value[i]]) if i in value else pieces.all_[i].encode("utf-8", "surrogatepass") for i in ids)
    text = out.decode("utf-8", "surrogatepass").replace(MARK, " ")
    return text[1:] if text.startswith(" ") else text


def _batches(texts: list[str], most: int = 1 << 21):
    """Rows in groups of bounded characters."""
    group, size = [], 0
    for t in texts:
        if group and size + len(t) > most:
            yield group
            group, size = [], 0
        group.append(t)
        size += len(t)
    if group:
        yield group


def encode(docs: DataFrame, pieces: Pieces, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ids (array<int>), by the merges of a BPE model. No shuffle; the piece table is broadcast, its size that of one model."""
    shared = docs.sparkSession.sparkContext.broadcast(pieces)
    kind = dict(docs.dtypes)[id_col]

    def run(batches):
        bpe = worker(shared.value)
        for batch in batches:
            at = 0
            for group in _batches(batch.column("text").to_pylist()):
                ids = bpe.encode(group)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.cumsum([0] + [len(x) for x in ids]), pa.int32()), pa.array(np.concatenate(ids), pa.int32())
                )
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(at, len(group)), lists], names=["id", "ids"])
                at += len(group)

    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    return rows.mapInArrow(run, f"id {kind}, ids array<int>").withColumnRenamed("id", id_col)


def decode(rows: DataFrame, pieces: Pieces, ids_col: str = "ids", text_col: str = "text") -> DataFrame:
    """The table with the text of its ids in ``text_col``; null ids give the empty text."""
    shared = rows.sparkSession.sparkContext.broadcast(pieces)
    schema = rows.drop(text_col).schema.add(text_col, "string")
    names = schema.names

    def run(batches):
        for batch in batches:
            texts = [decode_ids(ids or [], shared.value) for ids in batch.column(ids_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names[:-1]), pa.array(texts, pa.string())], names=names)

    return rows.drop(text_col).mapInArrow(run, schema)


def encode_words(words: DataFrame, pieces: DataFrame, unknown: int = 0, longest: int = 16) -> DataFrame:
    """(word, ids) for unigram models. ``words``: word, distinct, marks included; ``pieces``: piece, id, score.

    Explodes the substrings of at most ``longest`` characters, joins them to the pieces, groups the edges by word and
    folds Viterbi. A character that is no piece is an edge of the unknown piece with the lowest score less ten.
    """
    n = F.length("word")
    spans = words.where(n > 0).select("word", F.explode(F.sequence(F.lit(1), n)).alias("start"))
    spans = spans.select(
        "word", "start", F.explode(F.sequence("start", F.least(F.col("start") + longest - 1, F.length("word")))).alias("end")
    )
    cut = spans.withColumn("piece", F.substring("word", F.col("start"), F.col("end") - F.col("start") + 1))
    floor = pieces.agg(F.min("score").alias("floor"))
    joined = cut.join(pieces, "piece", "left").where("id is not null or start = end").join(F.broadcast(floor))
    edge = F.struct(
        F.col("end"),
        (F.col("start") - 1).alias("start"),
        F.coalesce("id", F.lit(unknown)).alias("id"),
        F.coalesce(F.col("score"), F.col("floor") - UNKNOWN_PENALTY).cast("double").alias("score"),
    )
    lattice = joined.groupBy("word").agg(F.array_sort(F.collect_list(edge)).alias("edges"))
    origin = F.array(F.struct(F.lit(0.0).alias("s"), F.lit(-1).alias("back"), F.lit(-1).alias("id")))

    def step(best, e):
        here = F.struct((F.get(best, e["start"])["s"] + e["score"]).alias("s"), e["start"].alias("back"), e["id"].alias("id"))
        return (
            F.when(F.size(best) <= e["end"], F.concat(best, F.array(here)))
            .when(here["s"] > F.get(best, e["end"])["s"], F.concat(F.slice(best, 1, e["end"]), F.array(here)))
            .otherwise(best)
        )

    def back(state, p):
        cell = F.get(state["best"], p)
        return F.when(
            state["at"] == p,
            F.struct(state["best"].alias("best"), cell["back"].alias("at"), F.concat(F.array(cell["id"]), state["ids"]).alias("ids")),
        ).otherwise(state)

    folded = lattice.withColumn("best", F.aggregate("edges", origin, step))
    start = F.struct(F.col("best"), F.length("word").alias("at"), F.array().cast("array<int>").alias("ids"))
    return folded.select("word", F.aggregate(F.sequence(F.length("word"), F.lit(1), F.lit(-1)), start, back)["ids"].alias("ids"))
