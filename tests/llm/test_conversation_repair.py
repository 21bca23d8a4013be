"""Conversation repair against brute force over all edit sequences, and long conversations against short ones."""

import hashlib
import heapq
import random
import re
import zlib

import pytest

from loopweave.llm import conversation_repair as repair
from loopweave.llm import queries

SCHEMA = "conv_id long, turn long, role string, text string, key string, copies string, code long"  # the last three clash
BLANKS = " \t\n\x0b\x0c\r"
NAMES = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out += [(conv, turn, role, text)] * (2 if kind == 3 else 1)
    return out


def cheapest(rows, faults):
    """Dijkstra over (cost, audit) from the front; independent of the module's tables and direction."""
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, roles, made = heapq.heappop(heap)
        end = re.fullmatch("(s?(ua)+)?", roles) is not None
        tail = "" if roles == "" else roles[0] if len(roles) == 1 else "." + roles[-1]  # what the form still depends on
        if (i, tail) in done:
            continue
        done.add((i, tail))
        if i == len(rows) and end:
            return cost, audit, [rows[k] if k is not None and r is None else (r, rows[k][1] if k is not None else "") for k, r in made]
        steps = []
        for role in ("user", "assistant"):
            steps.append((5, "I", i, role[0], ((None, role),)))
        if i < len(rows):
            extra = 5 if faults[i] == "truncated" else 0
            steps.append((2, "D", i + 1, "", ()))
            if faults[i] not in ("blank", "duplicate"):
                steps.append((extra, "K", i + 1, rows[i][0][:1] or "?", ((i, None),)))
                for role in ("user", "assistant"):
                    steps.append((1 + extra, "R", i + 1, role[0], ((i, role),)))
        for more, letter, j, initial, row in steps:
            if re.fullmatch("s?(ua)*u?", roles + initial):
                heapq.heappush(heap, (cost + more, audit + letter, j, roles + initial, made + row))


def brute(rows):
    """Expected rows, for damaged rows with their conversations."""
    rows = list(rows)
    out = {}
    for conv in {r[0] for r in rows}:
        own = [r[1:] for r in damage([r for r in rows if r[0] == conv])]
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).hexdigest()))
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        seen, faults = set(), []
        for _, role, text in own:
            bare = text.rstrip(BLANKS)
            faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
            seen.add((role, text))
        pairs = [(role, text) for _, role, text in own]
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(pairs, pairs[1:]))
        cost, audit, fixed = cheapest(pairs, faults)
        text = "\n".join(f"{r}:{t}" for r, t in fixed)
        out[conv] = (conv, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return out


def conversations(seed, n, longest):
    rng = random.Random(seed)
    rows = []
    for conv in range(n):
        for turn in range(rng.randrange(1, longest)):
            role = rng.choice(["user", "assistant"]) if rng.random() < 0.4 else ("user", "assistant")[turn % 2]
            role = rng.choice(["system", "tool", "", None, "unknown", "Ärger"]) if rng.random() < 0.12 else role
            text = rng.choice(["Yes.", "No", " ", "", None, "What?\n", "é!", f"Reply {rng.random()}.", f"Cut {rng.random()}", "\x0b"])
            rows.append((conv if conv else None, None if rng.random() < 0.05 else turn + rng.choice([0, 0, 0, 2]), role, text))
    return rows


def found(spark, rows, chunk):
    df = spark.createDataFrame([(*r, "k", "c", 5) for r in rows], SCHEMA)
    result = repair.repair(repair.damaged(df), chunk=chunk)
    assert result.columns == NAMES
    return {r[0]: tuple(r) for r in result.collect()}


@pytest.mark.parametrize("chunk", [256, 3])
def test_equals_brute_force(spark, chunk):
    """With chunks of three rows nearly every conversation goes through speculation, fix-up and stitching."""
    rows = conversations(5, 60, 16)
    assert found(spark, rows, chunk) == brute(rows)


def test_vectors_that_do_not_converge(spark, monkeypatch):
    """Rows that are all best deleted pass every difference on; the distances are doubled then."""
    monkeypatch.setattr(repair, "PASSES", 2)
    combined, steps = repair._combined, []
    monkeypatch.setattr(repair, "_combined", lambda *a: (steps.append(a[2]), combined(*a))[1])
    rows = [(1, t, "system" if t == 0 else "tool", "Cut off") for t in range(60)] + [(1, 60, "assistant", "Yes.")]
    rows += [(2, t, ("user", "assistant")[t % 2], "x" * t + ".") for t in range(50)] + [(3, t, "user", "same.") for t in range(40)]
    assert found(spark, rows, 2) == brute(rows)
    assert steps == [1, -1]


def test_odd_tables(spark):
    assert found(spark, [], 256) == {}
    same = [(7, 1, "user", "Hello.")] * 50 + [(8, None, None, None)] * 3 + [(9, -(1 << 63), "user", "a."), (9, (1 << 63) - 1, "assistant", "b." * 40000)]
    for chunk in (256, 4):
        got = found(spark, same, chunk)
        want = brute(same)
        got[9], want[9] = (got[9][0], *got[9][2:]), (want[9][0], *want[9][2:])  # the gap is more than 64 bits
        assert got == want


def test_dropped_conversation(spark):
    conv = next(c for c in range(10**6) if zlib.crc32(f"{c}:1".encode()) % 20 == 0)
    assert found(spark, [(conv, 1, "user", "x")], 256) == {conv: (conv, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_query_equals_brute_force(spark):
    d = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert {r[0]: tuple(r) for r in queries.op12_conversation_repair(spark, d).collect()} == brute(rows)
