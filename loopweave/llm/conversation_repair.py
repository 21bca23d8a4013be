"""Conversations are brought into the form ``s?(ua)+`` (or nothing) by their cheapest edits, found by a parallel Viterbi.

Rows are read in order of turn (nulls first; equal turns by role, then by the SHA-256 of the text). A row's first fault
counts: blank, duplicate (role and text seen earlier), truncated. Each row is kept, given the role that fits, or deleted, and
empty rows may be inserted anywhere; blank and duplicate rows are always deleted.

The state is what the repaired rows end with: nothing, ``s``, ``u`` or ``a``. A backward pass gives for each row the cost to
the end from every state; a forward trace then takes, of the edits that keep to the least cost, the first in ASCII order.

Conversations are short as a rule: up to ``chunk`` rows are one chunk, dealt by the conversation. Longer ones may hold a third
of the table. They are sorted over the cluster and cut into chunks, each packed as one byte per row:

1. Every chunk runs backward from a speculative vector of costs (all equal).
2. Fix-up: a chunk whose successor's result differs from the vector it began with by more than a constant runs again from
   that result, until no vector differs. Costs converge fast, since being out of step costs only a few edits.
3. Runs of rows that are all best deleted pass a vector on unchanged, and a fix-up moves on by one chunk only. After ``PASSES``
   the chunks give their transition costs between all states instead, and these are combined by doubling distances.
4. Each chunk traces its edits from each state it may begin in; the states are stitched by doubling distances.

A digest of a whole conversation, as a contract asks, is one sequential sum: it is streamed, in order, through a task that
keeps one chunk in memory, and so are the counts.

Defined cases: null conversation ids form one conversation; null roles, texts, ids and turns count as one space in the damage
and in what follows, but a null turn stays null in the order. A role is taken by its first character; with an empty role, or
another initial than s, u and a, it can't be kept. Repeated rows are duplicates. Other columns are ignored. An empty table
gives no rows.
"""

from __future__ import annotations

import hashlib
import itertools
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..scratch import settle
from .common import flag_keys, key_filter

#: Rows in a chunk; fix-up passes before distances are doubled.
CHUNK, PASSES = 256, 6
BLANKS = " \t\n\x0b\x0c\r"
#: A row's code is its initial (s, u, a, other) and four times its fault.
INITIALS, OTHER = "sua", 3
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)
DELETE, INSERT, REROLE, CUT_OFF = 2, 5, 1, 5
#: States: nothing, s, u, a. The state after the row that fits by its role, and the state after a kept s, u or a (or none).
FITS = (2, 2, 3, 2)
AFTER = ((1, 2, None, None), (None, 2, None, None), (None, None, 3, None), (None, 2, None, None))
ROLES = {2: "user", 3: "assistant"}
_NEVER = 1 << 40
#: Costs to the end of a conversation from each state, with what has to be inserted.
END = (0, 10, 5, 0)
ANY = (0, 0, 0, 0)

Costs = tuple[int, int, int, int]


def _with_inserts(costs: list[int]) -> list[int]:
    n, s, u, a = costs
    u, a = min(u, INSERT + a), min(a, INSERT + u)
    return [min(n, INSERT + u), min(s, INSERT + u), u, a]


def _of_row(code: int, after: Costs, state: int) -> dict[str, tuple[int, int]]:
    """Edits of a row from a state: its cost, with the costs after it, and the state it leads to."""
    fault, cut = code >> 2, CUT_OFF if code >> 2 == TRUNCATED else 0
    edits = {"D": (DELETE + after[state], state)}
    if fault not in (BLANK, DUPLICATE):
        to = AFTER[state][code & 3]
        if to is not None:
            edits["K"] = (cut + after[to], to)
        edits["R"] = (REROLE + cut + after[FITS[state]], FITS[state])
    return edits


@lru_cache(maxsize=1 << 16)
def _before(code: int, after: Costs) -> tuple[Costs, int]:
    """The costs before a row as differences, and what was taken off them."""
    costs = _with_inserts([min(c for c, _ in _of_row(code, after, s).values()) for s in range(4)])
    least = min(costs)
    return tuple(min(c - least, _NEVER) for c in costs), least


@lru_cache(maxsize=1 << 16)
def _edit(code: int, after: Costs, state: int) -> tuple[str, int, int]:
    """(edits up to and with this row, their cost, the state then): of the cheapest the first in ASCII order."""
    costs, taken = _before(code, after)
    out, spent = "", 0
    while True:
        left = costs[state] + taken
        edits = _of_row(code, after, state)
        if edits["D"][0] == left:
            return out + "D", spent + DELETE, state
        if INSERT + costs[FITS[state]] + taken == left:
            out, spent, state = out + "I", spent + INSERT, FITS[state]
            continue
        letter = "K" if edits.get("K", (None,))[0] == left else "R"
        cost, to = edits[letter]
        return out + letter, spent + cost - after[to], to


def backward(codes: bytes, after: Costs) -> list[Costs]:
    """Costs before each row as differences, and ``after`` at the end."""
    out = [after]
    for code in reversed(codes):
        out.append(_before(code, out[-1])[0])
    return out[::-1]


def trace(codes: bytes, costs: list[Costs], state: int, last: bool) -> tuple[str, int, int]:
    """(edits, cost, state at the end) of a chunk entered in ``state``; ``costs`` from the backward pass."""
    out, spent = [], 0
    for code, after in zip(codes, costs[1:]):
        edits, cost, state = _edit(code, after, state)
        out.append(edits)
        spent += cost
    while last and state in (1, 2):
        out.append("I")
        spent, state = spent + INSERT, FITS[state]
    return "".join(out), spent, state


def transitions(codes: bytes) -> list[int]:
    """Least cost from each state before a chunk to each state after it, by rows of four."""
    columns = []
    for end in range(4):
        costs, total = tuple(0 if s == end else _NEVER for s in range(4)), 0
        for code in reversed(codes):
            costs, least = _before(code, costs)
            total += least
        columns.append([min(_NEVER, c + total) if c < _NEVER // 2 else _NEVER for c in costs])
    return [columns[end][s] for s in range(4) for end in range(4)]


class Summary:
    """What is returned of one conversation, gathered row by row."""

    def __init__(self, key: str) -> None:
        self.key, self.faults, self.illegal, self.cost, self.audit = key, [0, 0, 0, 0], 0, 0, []
        self.last, self.state, self.digest, self.first = None, 0, hashlib.sha256(), True

    def begin(self, codes: bytes, edits: str, cost: int) -> None:
        """A chunk of rows follows."""
        for code in codes:
            self.faults[code >> 2] += 1
            if self.last is not None and (self.last & 3, code & 3) not in ((0, 1), (1, 2), (2, 1)):
                self.illegal += 1
            self.last = code
        self.audit.append(edits)
        self.cost += cost
        self.edits, self.codes = iter(edits), iter(codes)

    def _write(self, role: str, text: str) -> None:
        self.digest.update((("" if self.first else "\n") + role + ":" + text).encode("utf-8", "surrogatepass"))
        self.first = False

    def _inserted(self) -> None:
        self.state = FITS[self.state]
        self._write(ROLES[self.state], "")

    def row(self, role: str, text: str) -> None:
        code = next(self.codes)
        for edit in self.edits:
            if edit == "I":
                self._inserted()
                continue
            if edit == "K":
                self.state = AFTER[self.state][code & 3]
                self._write(role, text)
            elif edit == "R":
                self.state = FITS[self.state]
                self._write(ROLES[self.state], text)
            return

    def finish(self) -> dict:
        for _ in getattr(self, "edits", ()):
            self._inserted()
        return {
            "key": self.key, "blank": self.faults[BLANK], "duplicate": self.faults[DUPLICATE], "truncated": self.faults[TRUNCATED],
            "illegal": self.illegal, "cost": self.cost, "audit": "".join(self.audit), "repaired_sha256": self.digest.hexdigest(),
        }


_SUMMARY = "key string, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_SCHEMA = pa.schema([(x.split()[0], pa.string() if x.endswith("string") else pa.int64()) for x in _SUMMARY.split(", ")])


def _written(summaries):
    while found := list(itertools.islice(summaries, 1000)):
        yield pa.RecordBatch.from_pylist(found, schema=_SCHEMA)


def _rows_of(batches, columns):
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in columns))


def _whole(batches):
    """Summaries of conversations of one chunk; rows come sorted by conversation."""

    def summaries():
        for key, rows in itertools.groupby(_rows_of(batches, ("key", "role", "text", "code")), key=lambda r: r[0]):
            seen, codes, kept = set(), bytearray(), []
            for _, role, text, code in rows:
                if (role, text) in seen and code >> 2 != BLANK:
                    code = code & 3 | DUPLICATE << 2
                seen.add((role, text))
                codes.append(code)
                kept.append((role, text))
            edits, cost, _ = trace(codes, backward(codes, END), 0, True)
            summary = Summary(key)
            summary.begin(bytes(codes), edits, cost)
            for role, text in kept:
                summary.row(role, text)
            yield summary.finish()

    yield from _written(summaries())


def _streamed(batches):
    """Summaries of conversations of many chunks; a chunk's codes and edits come before its rows."""

    def summaries():
        for key, rows in itertools.groupby(_rows_of(batches, ("key", "codes", "edits", "cost", "role", "text")), key=lambda r: r[0]):
            summary = Summary(key)
            for _, codes, edits, cost, role, text in rows:
                if codes is not None:
                    summary.begin(codes, edits, cost)
                else:
                    summary.row(role, text)
            yield summary.finish()

    yield from _written(summaries())


def damaged(df: DataFrame) -> DataFrame:
    """(key, conv_id, turn, role, text, copies): what the contract's damage does to each row; 0 copies drop it."""
    space = F.lit(" ")
    conv, turn = F.col("conv_id").cast("string"), F.col("turn").cast("string")
    kind = F.crc32(F.concat(F.coalesce(conv, space), F.lit(":"), F.coalesce(turn, space))) % 20
    text, role = F.coalesce("text", space), F.coalesce("role", space)
    return df.select(
        F.coalesce(F.concat(F.lit("="), conv), F.lit("")).alias("key"),
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.when(kind == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    )


def _code() -> Column:
    """The code of a row by itself, that is but for duplicates."""
    bare = F.rtrim("text", F.lit(BLANKS))
    initial = F.substring("role", 1, 1)
    number = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(OTHER)
    fault = F.when(bare == "", BLANK).when(F.right(bare, F.lit(1)).isin(".", "!", "?"), SOUND).otherwise(TRUNCATED)
    return (number + 4 * fault).cast("int")


def repair(rows: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of rows as ``damaged`` gives them."""
    by_turn = rows.groupBy("key", "conv_id", "turn").agg(F.sum("copies").alias("n"))
    there = F.when(F.col("n") > 0, F.col("turn"))
    wide = [f(there).cast("decimal(20,0)") for f in (F.max, F.min)]
    gaps = F.coalesce(wide[0] - wide[1] + 1 - F.count(there), F.lit(0))
    sizes = settle(by_turn.groupBy("key", "conv_id").agg(F.sum("n").alias("n"), F.least(gaps, F.lit((1 << 63) - 1)).cast("long").alias("gaps")))

    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.greatest("copies", F.lit(1))))).where("copies > 0")
    rows = rows.select("key", "turn", "role", "text", F.sha2(F.encode("text", "utf-8"), 256).alias("digest"), _code().alias("code"))
    long_keys = sizes.where(F.col("n") > chunk).select(F.xxhash64("key").alias("hash"))
    order = [F.col("key"), F.asc_nulls_first("turn"), F.col("role"), F.col("digest")]
    if long_keys.isEmpty():
        short, found = rows, None
    else:
        # a filter of fixed size; a short conversation that it takes along goes the other way with all its rows
        flagged = flag_keys(rows.withColumn("hash", F.xxhash64("key")), "hash", key_filter(long_keys, "hash"), "long").drop("hash")
        short, found = flagged.where("not long"), _chunked(flagged.where("long").drop("long"), order, chunk)
    summary = short.repartition("key").sortWithinPartitions(*order).select("key", "role", "text", "code").mapInArrow(_whole, _SUMMARY)
    summary = summary if found is None else summary.union(found)
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    counts = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")]
    text = [F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", empty).alias("repaired_sha256")]
    return sizes.join(summary, "key", "left").select("conv_id", "gaps", *counts, *text)


def _chunked(rows: DataFrame, order: list[Column], chunk: int) -> DataFrame:
    """Summaries of long conversations."""
    rows = rows.withColumn("tie", F.monotonically_increasing_id()).orderBy(*order, "tie")
    # numbers that rise with the order: the sorted partition above, the place in it below
    rows = settle(rows.withColumn("pos", F.monotonically_increasing_id()))
    rows = rows.withColumn("part", F.shiftright("pos", 33)).withColumn("piece", F.floor((F.col("pos") - F.shiftleft("part", 33)) / chunk))
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    pieces = rows.groupBy("part").agg((F.max("piece") + 1).alias("pieces"))
    base = settle(pieces.select("part", F.coalesce(F.sum("pieces").over(ahead), F.lit(0)).alias("base")))
    rows = rows.join(base, "part").withColumn("g", F.col("base") + F.col("piece"))

    first = rows.groupBy("key", "role", "digest").agg(F.min("pos").alias("pos")).select("pos", F.lit(True).alias("first"))
    marked = rows.select("pos", "key", "g", "code").join(first, "pos", "left")
    repeated = F.col("first").isNull() & (F.shiftright("code", 2) != BLANK)
    marked = marked.withColumn("code", F.when(repeated, F.col("code").bitwiseAND(F.lit(3)) + 4 * DUPLICATE).otherwise(F.col("code")))
    listed = F.sort_array(F.collect_list(F.struct("pos", "code")))
    chunks = settle(marked.groupBy("key", "g").agg(listed.alias("rows")).select("key", "g", F.col("rows.code").alias("codes")))

    traced = settle(_traced(chunks, _settled_ends(chunks)))
    heads = traced.select("key", "g", F.lit(-1).cast("long").alias("pos"), "codes", "edits", "cost", F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"))
    bodies = rows.select("key", "g", "pos", F.lit(None).cast("binary").alias("codes"), F.lit(None).cast("string").alias("edits"), F.lit(None).cast("long").alias("cost"), "role", "text")
    return heads.union(bodies).repartition("key").sortWithinPartitions("key", "g", "pos").mapInArrow(_streamed, _SUMMARY)


def _mapped(df: DataFrame, fn, schema: str, keep: tuple[str, ...] = ("key", "g")) -> DataFrame:
    """Rows with the columns of ``schema`` from ``fn`` of each row as a dictionary."""
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches):
        for batch in batches:
            found = [fn(r) for r in batch.to_pylist()]
            arrays = [batch.column(c) for c in keep]
            kinds = [pa.list_(pa.int64()) if "array" in x else pa.binary() if "binary" in x else pa.string() if "string" in x else pa.int64() for x in schema.split(", ")]
            arrays += [pa.array([f[i] for f in found], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(arrays, [*keep, *names])

    return df.mapInArrow(run, "key string, g long, " + schema)


def _settled_ends(chunks: DataFrame) -> DataFrame:
    """(key, g, ends): the costs after each chunk, but for a constant."""

    def ran(df: DataFrame) -> DataFrame:
        return _mapped(df, lambda r: (r["ends"], list(backward(bytes(r["codes"]), tuple(r["ends"]))[0])), "ends array<long>, starts array<long>")

    def vector(costs: Costs) -> Column:
        return F.array(*[F.lit(c).cast("long") for c in costs])

    state = settle(ran(chunks.withColumn("ends", vector(ANY))))
    for _ in range(PASSES):
        coming = state.select("key", (F.col("g") - 1).alias("g"), F.col("starts").alias("coming"))
        # vectors are kept as differences, so they are equal if they differ by a constant
        seen = state.join(coming, ["key", "g"], "left").withColumn("coming", F.coalesce("coming", vector(END)))
        seen = settle(seen)
        moved = seen.where("coming != ends").select("key", "g", F.col("coming").alias("ends"))
        if moved.isEmpty():
            return seen.select("key", "g", "ends")
        state = settle(seen.where("coming = ends").select("key", "g", "ends", "starts").union(ran(chunks.join(moved, ["key", "g"]))))
    matrix = _mapped(chunks, lambda r: (transitions(bytes(r["codes"])),), "m array<long>")

    def product(a: Column, b: Column) -> Column:
        return F.array(*[F.least(*[a[4 * s + k] + b[4 * k + e] for k in range(4)], F.lit(_NEVER)) for s in range(4) for e in range(4)])

    reach = _combined(settle(matrix), product, 1)
    total = [F.least(*[F.col("m")[4 * s + k] + END[k] for k in range(4)]) for s in range(4)]
    starts = reach.select("key", (F.col("g") - 1).alias("g"), F.array(*total).alias("starts"))
    starts = starts.select("key", "g", F.transform("starts", lambda x: x - F.array_min("starts")).alias("ends"))
    return chunks.select("key", "g").join(starts, ["key", "g"], "left").select("key", "g", F.coalesce("ends", vector(END)).alias("ends"))


def _combined(parts: DataFrame, both, step: int) -> DataFrame:
    """(key, g, m): each chunk's ``m`` combined with those of all chunks of its key in direction ``step``, by doubling distances."""
    state = parts.select("key", "g", "m", (F.col("g") + step).alias("far"))
    while True:
        other = state.select("key", F.col("g").alias("far"), F.col("m").alias("m2"), F.col("far").alias("far2"))
        joined = state.join(other, ["key", "far"], "left")
        state = settle(joined.select("key", "g", F.when(F.col("m2").isNull(), F.col("m")).otherwise(both(F.col("m"), F.col("m2"))).alias("m"), F.col("far2").alias("far")))
        if state.where("far is not null").isEmpty():
            return state.select("key", "g", "m")


def _traced(chunks: DataFrame, ends: DataFrame) -> DataFrame:
    """(key, g, codes, edits, cost) of every chunk, entered in the state that the chunks before it leave."""
    after = chunks.select("key", (F.col("g") - 1).alias("g"), F.lit(False).alias("last"))
    whole = settle(chunks.join(ends, ["key", "g"]).join(after, ["key", "g"], "left").withColumn("last", F.coalesce("last", F.lit(True))))

    def exits(r):
        codes = bytes(r["codes"])
        costs = backward(codes, tuple(r["ends"]))
        return ([trace(codes, costs, s, r["last"])[2] for s in range(4)],)

    # m[s]: the state that the chunks so far lead to from s
    maps = settle(_mapped(whole, exits, "m array<long>"))
    reached = _combined(maps, lambda late, early: F.transform(early, lambda s: late[s.cast("int")]), -1)
    entry = reached.select("key", (F.col("g") + 1).alias("g"), F.col("m")[0].alias("state"))

    def edits(r):
        codes = bytes(r["codes"])
        found, cost, _ = trace(codes, backward(codes, tuple(r["ends"])), r["state"], r["last"])
        return codes, found, cost

    entered = whole.join(entry, ["key", "g"], "left").withColumn("state", F.coalesce("state", F.lit(0).cast("long")))
    return _mapped(entered, edits, "codes binary, edits string, cost long")
