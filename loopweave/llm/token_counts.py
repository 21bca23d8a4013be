"""Token counts of whole texts; huge documents are encoded as overlapping chunks by many tasks and resynchronised.

A text of at most ``huge`` characters is counted where it is read. A longer one becomes chunks that overlap; the chunks
are dealt out over the cluster and encoded with offsets. The pre-tokenizer reads from left to right and looks at no
character to the left of where it stands, so once two chunks have a pre-token starting at the same place, both go on
alike until the left one's end comes in sight. Such a place in the overlap, not the first of the right chunk and well
before the end of the left one, is a proven common boundary: tokens left of it are counted in the left chunk, tokens
from it on in the right one. Documents with a pair of chunks without a common boundary come again with a wider overlap,
and with longer chunks when need be, in the end as one chunk; no such document is left out.

Defined cases: null text counts as empty, an empty text has no tokens, repeated rows are counted each, null ids stay,
an empty table gives an empty result. Extra columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import settle
from .byte_bpe import PATTERN, ByteBpe, encoder
from .common import text_of

HUGE, CHUNK, OVERLAP = 1 << 16, 1 << 15, 256


def pre_tokens(text: str, special: dict[str, int]) -> Iterator[tuple[int, int]]:
    """Start and end of every pre-token; special strings are cut out first, as the library does."""
    import regex

    cut = regex.compile("|".join(regex.escape(s) for s in special) or r"(?!)")
    words = regex.compile(PATTERN)
    start = 0
    for m in [*cut.finditer(text), None]:
        end = m.start() if m else len(text)
        yield from ((start + a, start + b) for a, b in (w.span() for w in words.finditer(text[start:end])))
        if m:
            yield m.span()
            start = m.end()


def encode_chunk(bpe: ByteBpe, text: str, at: int, overlap: int, first: bool, last: bool) -> dict:
    """Tokens of a chunk that starts at ``at``, and the boundaries in its overlaps with the tokens before each."""
    margin = 2 * max(map(len, bpe.special), default=1)
    head, tail, n = [], [], 0
    lengths: dict[str, int] = {}  # of the chunk's pre-tokens
    for k, (a, b) in enumerate(pre_tokens(text, bpe.special)):
        if not first and k and a < overlap:
            head.append((at + a, n))
        if not last and len(text) - overlap <= a and b < len(text) - margin:
            tail.append((at + a, n))
        piece = text[a:b]
        if piece not in lengths:
            lengths[piece] = len(bpe.ids(piece)) // 4
        n += lengths[piece]
    return {"n": n, "head": head, "tail": tail}


def _chunk_counts(huge: DataFrame, spec, chunk: int, overlap: int) -> DataFrame:
    """(row, n_tokens) of the texts of ``huge``; null where two chunks have no common boundary."""
    step = chunk - overlap

    def cut(batches):
        for batch in batches:
            for row, text in zip(batch.column("row").to_pylist(), batch.column("text").to_pylist()):
                for k, at in enumerate(range(0, max(len(text) - overlap, 1), step)):
                    part = text[at : at + chunk]
                    yield pa.RecordBatch.from_pylist(
                        [{"row": row, "k": k, "at": at, "last": at + chunk >= len(text), "part": part}]
                    )

    def count(batches):
        bpe = encoder(spec.value)
        for batch in batches:
            out = []
            for x in batch.to_pylist():
                got = encode_chunk(bpe, x["part"], x["at"], overlap, x["k"] == 0, x["last"])
                out.append(
                    {"row": x["row"], "k": x["k"], "last": x["last"], "n": got["n"]}
                    | {f"{side}_{what}": [v[i] for v in got[side]] for side in ("head", "tail") for i, what in ((0, "at"), (1, "n"))}
                )
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    arrays = "head_at array<long>, head_n array<long>, tail_at array<long>, tail_n array<long>"
    schema = pa.schema(
        [("row", pa.int64()), ("k", pa.int64()), ("last", pa.bool_()), ("n", pa.int64())]
        + [(c, pa.list_(pa.int64())) for c in ("head_at", "head_n", "tail_at", "tail_n")]
    )
    parts = huge.select("row", "text").mapInArrow(cut, "row long, k long, at long, last boolean, part string")
    dealt = parts.repartition("row", "k")
    chunks = settle(dealt.mapInArrow(count, f"row long, k long, last boolean, n long, {arrays}"))
    right = chunks.select("row", (F.col("k") - 1).alias("k"), F.col("head_at").alias("r_at"), F.col("head_n").alias("r_n"))
    pairs = chunks.where("not last").join(right, ["row", "k"])
    common = pairs.withColumn("p", F.array_min(F.array_intersect("tail_at", "r_at")))
    value = lambda at, n: F.get(n, (F.array_position(at, F.col("p")) - 1).cast("int"))
    # tokens that the pair counts twice or wrongly: the left chunk's beyond the boundary, the right one's before it
    over = common.select(
        "row",
        F.when(F.col("p").isNull(), 1).otherwise(0).alias("lost"),
        F.when(F.col("p").isNotNull(), F.col("n") - value(F.col("tail_at"), F.col("tail_n")) + value(F.col("r_at"), F.col("r_n"))).alias(
            "twice"
        ),
    )
    whole = chunks.select("row", "n", F.lit(0).alias("lost"))
    both = whole.unionByName(over.select("row", (-F.col("twice")).alias("n"), "lost"))
    return both.groupBy("row").agg(F.when(F.sum("lost") == 0, F.sum("n")).alias("n_tokens"))


def token_counts(
    docs: DataFrame,
    spec: bytes,
    id_col: str = "doc_id",
    text_col: str = "text",
    huge: int = HUGE,
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
) -> DataFrame:
    """One row per document: id, n_bytes, n_tokens. ``spec`` is the content of the byte-level BPE tokenizer's file."""
    shared = docs.sparkSession.sparkContext.broadcast(spec)  # one vocabulary file

    def count(batches):
        bpe = encoder(shared.value)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            long_ = [len(t) > huge for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    batch.column("row"),
                    batch.column("n_bytes"),
                    pa.array([None if l else len(bpe.encode(t)) // 4 for t, l in zip(texts, long_)], pa.int64()),
                    pa.array([t if l else None for t, l in zip(texts, long_)], pa.string()),
                ],
                names=["id", "row", "n_bytes", "n_tokens", "text"],
            )

    rows = docs.select(
        F.col(id_col).alias("id"),
        F.monotonically_increasing_id().alias("row"),
        text_of(text_col).alias("text"),
    ).withColumn("n_bytes", F.octet_length("text").cast("long"))
    kind = dict(docs.dtypes)[id_col]
    first = settle(rows.select("id", "row", "n_bytes", "text").mapInArrow(count, f"id {kind}, row long, n_bytes long, n_tokens long, text string"))
    pending = first.where("text is not null").select("row", "text")
    counted = None
    while not pending.isEmpty():
        got = settle(_chunk_counts(pending, shared, chunk, overlap))
        counted = got if counted is None else counted.unionAll(got)
        pending = pending.join(got.where("n_tokens is null").select("row"), "row", "left_semi")
        overlap *= 4
        chunk = max(chunk, 4 * overlap)
    out = first.where("text is null").select("id", "n_bytes", "n_tokens")
    if counted is not None:
        done = counted.where("n_tokens is not null")
        long_rows = first.where("text is not null").select("id", "row", "n_bytes")
        out = out.unionAll(long_rows.join(done, "row").select("id", "n_bytes", "n_tokens"))
    return out.withColumnRenamed("id", id_col)
