"""Byte-level BPE inside tasks: ids of whole texts as the tokenizer file's own library gives them.

The pre-tokenizer cuts before every single space that has other characters on both sides, whatever stands further left
or right, so a long text may be encoded in parts cut there. A text or part is one call of the BPE library: where a
tenth of the words are new, as in these tables, a call for each new word takes longer than one for the whole.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

#: Fixed value: the pre-tokenizer pattern of this family of byte-level BPE vocabularies.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters that are encoded at once, about.
SLICE = 1 << 20

_encoders: dict[int, "ByteBpe"] = {}


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary file, by its rule."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def encoder(spec: bytes) -> "ByteBpe":
    """The encoder of a tokenizer file's content, made once per worker."""
    key = hash(spec)
    if key not in _encoders:
        _encoders[key] = ByteBpe(spec)
    return _encoders[key]


class ByteBpe:
    def __init__(self, spec: bytes):
        import tiktoken

        data = json.loads(spec)
        letters = byte_alphabet()
        self.special = {t["content"]: t["id"] for t in data.get("added_tokens", [])}
        ranks = {
            bytes(letters[c] for c in piece): i for piece, i in data["model"]["vocab"].items() if piece not in self.special
        }
        self.bpe = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=self.special)

    def ids(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids of a text that is encoded at once."""
        return self.bpe.encode_to_numpy(text, allowed_special="all").astype("<u4").tobytes()

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids of the whole text, special strings taken as special tokens."""
        if len(text) <= SLICE:
            return self.ids(text)
        return b"".join(self.ids(part) for part in slices(text, SLICE))


def slices(text: str, size: int) -> Iterator[str]:
    """Parts of about ``size`` characters, cut before a space that has other characters on both sides, where there is one."""
    start = 0
    while len(text) - start > size:
        cut = text.find(" ", start + size)
        while cut != -1 and (text[cut - 1].isspace() or text[cut + 1 : cut + 2].isspace() or cut + 1 == len(text)):
            cut = text.find(" ", cut + 1)
        if cut == -1:
            break
        yield text[start:cut]
        start = cut
    yield text[start:]
