"""Document fingerprints: a Merkle tree over sections, paragraphs and sentences.

The tree covers the text exactly. A paragraph is a line with its line end; a section ends after a paragraph whose own
hash is divisible by four, so that a change moves no border but its own; a leaf is at most five words of
one sentence. Node hashes cover their children's hashes, so equal roots mean equal texts, equal section hashes let a
comparison skip whole branches, and the leaves of the others locate the edit.

A fingerprint is text: the root in hex, a colon, then the sections divided by ``/``, each as its hash, ``=`` and its
paragraphs divided by ``.``, each as the hashes of its leaves, eight hex digits each.

Neighbours by id come from one shuffle: documents are dealt to ranges of ids, bounds taken from quantiles, sorted inside
a range, and each range also gets the first document of the next one. No text passes through the driver.

Defined cases: null text counts as empty; two empty texts are alike (1.0), an empty and another text are not (0.0); null
ids come first; rows with the same id are ordered by the hash of their text, repeated rows follow each other; a single
document is its own next one; an empty table gives an empty result. Extra columns are not looked at.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_of

SENTENCE = re.compile(r"[^.!?]+[.!?]*\s*|[.!?]+\s*")
WORDS = re.compile(r"\s*(?:\S+\s+){1,5}|\s*\S+|\s+")
#: Sections end after one paragraph in so many.
SECTION = 4


def _hash(kind: bytes, parts: list[bytes]) -> bytes:
    return hashlib.blake2b(b"".join(parts), digest_size=16, person=kind).digest()


def leaves(paragraph: str) -> list[str]:
    """Sentences of a paragraph in pieces of at most five words; joined they are the paragraph."""
    out = []
    for sentence in SENTENCE.findall(paragraph):
        out += WORDS.findall(sentence)
    return out


def tree(text: str) -> tuple[bytes, list[tuple[bytes, list[list[bytes]]]]]:
    """(root, sections), a section being (hash, paragraphs), a paragraph the list of its leaves' hashes."""
    sections, members, nodes = [], [], []
    for paragraph in text.splitlines(keepends=True):
        hashes = [_hash(b"leaf", [x.encode("utf-8", "surrogatepass")]) for x in leaves(paragraph)]
        node = _hash(b"paragraph", hashes)
        members.append(hashes)
        nodes.append(node)
        if node[0] % SECTION == 0:
            sections.append((_hash(b"section", nodes), members))
            members, nodes = [], []
    if members:
        sections.append((_hash(b"section", nodes), members))
    return _hash(b"root", [s for s, _ in sections]), sections


def fingerprint(text: str) -> str:
    root, sections = tree(text)
    body = "/".join(
        s.hex()[:16] + "=" + ".".join("".join(h.hex()[:8] for h in p) for p in members) for s, members in sections
    )
    return f"{root.hex()}:{body}"


def _sections(print_: str) -> list[tuple[str, list[str]]]:
    body = print_.split(":", 1)[1]
    out = []
    for section in body.split("/") if body else []:
        name, _, paragraphs = section.partition("=")
        packed = paragraphs.replace(".", "")
        out.append((name, [packed[i : i + 8] for i in range(0, len(packed), 8)]))
    return out


def likeness(a: str, b: str) -> float:
    """Leaves that two fingerprints share as a part of the larger one's leaves; 1.0 exactly if the roots are equal."""
    if a.split(":", 1)[0] == b.split(":", 1)[0]:
        return 1.0
    left, right = _sections(a), _sections(b)
    most = max(sum(len(x) for _, x in left), sum(len(x) for _, x in right))
    same = Counter(s for s, _ in left) & Counter(s for s, _ in right)
    skip_left, skip_right, shared = same.copy(), same.copy(), 0
    rest_left, rest_right = Counter(), Counter()
    for sections, skip, rest in ((left, skip_left, rest_left), (right, skip_right, rest_right)):
        for name, found in sections:
            if skip[name] > 0:
                skip[name] -= 1
                shared += len(found) if sections is left else 0
            else:
                rest.update(found)
    shared += sum((rest_left & rest_right).values())
    return min(shared / most, 1.0 - 1e-9) if most else 0.0


def changed_leaves(a: str, b: str) -> list[tuple[int, int]]:
    """(section, leaf in it) of ``b`` under branches that ``a`` doesn't hold: where an edit lies."""
    known = Counter(s for s, _ in _sections(a))
    have = Counter(h for _, found in _sections(a) for h in found)
    out = []
    for i, (name, found) in enumerate(_sections(b)):
        if known[name] > 0:
            known[name] -= 1
            continue
        for k, h in enumerate(found):
            if have[h] > 0:
                have[h] -= 1
            else:
                out.append((i, k))
    return out


def _fingerprints(batches):
    for batch in batches:
        texts = batch.column("text").to_pylist()
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in batch.schema.names if c != "text"), pa.array([fingerprint(t) for t in texts])],
            names=[*(c for c in batch.schema.names if c != "text"), "fingerprint"],
        )


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_chars, fingerprint of every document; no shuffle."""
    kind = dict(docs.dtypes)[id_col]
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    rows = rows.select("id", F.length("text").cast("long").alias("n_chars"), "text")
    return rows.mapInArrow(_fingerprints, f"id {kind}, n_chars long, fingerprint string").withColumnRenamed("id", id_col)


def edit(text: str, following: str) -> str:
    """The text with its last quarter replaced by as many characters from the start of the next one."""
    k = len(text) // 4
    return text[: len(text) - k] + following[:k]


def with_next(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(range, id, tie, text, extra): ranges of ascending ids; the last row of a range is the first of the next one, extra."""
    spark = docs.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    ids = docs.select(F.col(id_col).alias("id"))
    found = ids.where("id is not null").approxQuantile("id", [i / parts for i in range(1, parts)], 0.1 / parts) if parts > 1 else []
    bounds = sorted({int(b) for b in found})
    place = F.size(F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b <= F.col("id"))) if bounds else F.lit(0)
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    rows = rows.select(
        F.when(F.col("id").isNull(), 0).otherwise(place).cast("int").alias("range"),
        "id",
        F.xxhash64("text").alias("tie"),
        "text",
        F.lit(False).alias("extra"),
    )
    first = rows.groupBy("range").agg(F.min(F.struct(F.coalesce(F.col("id").cast("long"), F.lit(-(2**63))).alias("k"), "tie")).alias("x"))
    heads = first.select("range", "x.k", "x.tie").orderBy("range").collect()  # a row per range
    if not heads:
        return rows
    before = {h["range"]: heads[i - 1]["range"] for i, h in enumerate(heads)}
    named = spark.createDataFrame([(h["range"], h["k"], h["tie"], before[h["range"]]) for h in heads], "r int, k long, t long, to int")
    key = F.coalesce(F.col("id").cast("long"), F.lit(-(2**63)))
    extra = rows.join(F.broadcast(named), (F.col("range") == F.col("r")) & (key == F.col("k")) & (F.col("tie") == F.col("t")))
    extra = extra.select("to", "id", "tie", "text").dropDuplicates(["to"])
    extra = extra.select(F.col("to").alias("range"), "id", "tie", "text", F.lit(True).alias("extra"))
    order = ["range", "extra", "id", "tie"]
    return rows.unionAll(extra).repartition(parts, "range").sortWithinPartitions(*order)


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, n_changed.

    The edited text is ``edit`` of the document and the next one by id, after the last the first; ``n_changed`` counts
    the leaves that the edited tree does not share.
    """
    kind = dict(docs.dtypes)[id_col]
    names = ["n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "n_changed"]
    types = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64()]

    def compare(batches):
        held = None  # the document that waits for the next one
        for batch in batches:
            ids, columns = [], [[] for _ in names]
            for at, i, text in zip(*(batch.column(c).to_pylist() for c in ("range", "id", "text"))):
                print_ = fingerprint(text)
                if held and held[0] == at:
                    _, old_id, old, old_print = held
                    new = edit(old, text)
                    new_print = fingerprint(new)
                    ids.append(old_id)
                    values = (
                        len(old),
                        hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest(),
                        old_print,
                        new_print,
                        likeness(old_print, new_print),
                        likeness(old_print, print_),
                        len(changed_leaves(old_print, new_print)),
                    )
                    for column, v in zip(columns, values):
                        column.append(v)
                held = (at, i, text, print_)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, batch.schema.field("id").type), *(pa.array(c, t) for c, t in zip(columns, types))],
                names=["id", *names],
            )

    rows = with_next(docs, id_col, text_col).select("range", "id", "text")
    out = rows.mapInArrow(
        compare,
        f"id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, "
        "near_next double, n_changed long",
    )
    return out.withColumnRenamed("id", id_col)
