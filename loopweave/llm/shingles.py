"""Sets of word shingles of whole texts, vectorised over an Arrow batch."""

from __future__ import annotations

import numpy as np

#: Bytes hashed at once.
PIECE = 1 << 18
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_ODD = 0x9E3779B97F4A7C15
_state: dict[str, np.ndarray] = {}


def mixed(x: np.ndarray) -> np.ndarray:
    """A permutation of the 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_state.get("up", ())) < n:
        n = max(n, PIECE + 4096)
        step = np.full(n, _ODD, dtype=np.uint64)
        step[0] = 1
        back = np.full(n, pow(_ODD, -1, 1 << 64), dtype=np.uint64)
        back[0] = 1
        _state["up"], _state["down"] = np.multiply.accumulate(step), np.multiply.accumulate(back)
        _state["byte"] = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(_ODD))
    return _state["up"], _state["down"]


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(hash, start) of every word of ASCII-lower-cased bytes, words being runs without white space."""
    hashes, starts, base = [], [], 0
    while base < len(data):
        end = min(base + PIECE, len(data))
        while end < len(data) and not _SPACE[data[end]]:  # a word is never divided
            end += 1
        part = np.frombuffer(data, np.uint8, end - base, base)
        up, down = _powers(len(part))
        gap = _SPACE[part]
        first = np.flatnonzero(~gap & np.concatenate([[True], gap[:-1]]))
        last = np.flatnonzero(~gap & np.concatenate([gap[1:], [True]]))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_state["byte"][part] * up[: len(part)], dtype=np.uint64)])
        length = (last - first + 1).astype(np.uint64)
        hashes.append(mixed((sums[last + 1] - sums[first]) * down[first] + length))
        starts.append(first + base)
        base = end
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(starts)


def shingle_sets(texts: list[str], size: int) -> list[np.ndarray]:
    """Per text the sorted distinct hashes of its runs of ``size`` words; of all its words if there are fewer."""
    out: list[np.ndarray] = []
    at = 0
    while at < len(texts):
        group, total = [], 0
        while at < len(texts) and (not group or total < PIECE):
            data = texts[at].encode("utf-8", "surrogatepass").translate(_LOWER)
            group.append(data)
            total += len(data) + 1
            at += 1
        words, starts = word_hashes(b" ".join(group))
        edges = np.cumsum([0] + [len(d) + 1 for d in group])
        bounds = np.searchsorted(starts, edges)
        runs = words[: max(len(words) - size + 1, 0)].copy()
        for k in range(1, size):
            runs = runs * np.uint64(_ODD) + words[k : k + len(runs)]
        runs = mixed(runs)
        for a, b in zip(bounds[:-1], bounds[1:]):
            if b - a >= size:
                out.append(np.unique(runs[a : b - size + 1]))
            elif b > a:
                h = np.uint64(b - a)
                for w in words[a:b]:
                    h = mixed(np.array([h ^ w]))[0]
                out.append(np.array([h], np.uint64))
            else:
                out.append(np.zeros(0, np.uint64))
    return out
