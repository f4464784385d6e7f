"""Token ids of whole texts from ids of their chunks, which repeat.

A chunk is a stretch of text that a tokenizer encodes by itself: no pre-token
crosses its borders. Ids of chunks seen before come from a bounded cache of the
worker process; only new chunks are encoded.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable

import numpy as np

#: The characters with the Unicode property White_Space.
_WHITE = "".join(map(chr, (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
                           0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
#: One optional space and a run without white space; else white space, of which
#: the last character stays for what follows. The byte-level pattern splits
#: white space in the same way, and everything else only within such a run.
SPACED_RUNS = re.compile(f" ?[^{_WHITE}]+|[{_WHITE}]+(?![^{_WHITE}])|[{_WHITE}]+")


def plain_runs(text: str) -> list[str]:
    """Runs between spaces and line ends, for tokenizers that drop white space."""
    return [c for c in text.replace("\n", " ").split(" ") if c]


def spaced_runs(definition: str) -> Callable[[str], list[str]]:
    """Cut of a text into chunks for a byte-level tokenizer, from its JSON. The
    library cuts added tokens out of the whole text first, the longest where
    several begin, so each is a chunk and white space before it ends its run."""
    added = json.loads(definition).get("added_tokens") or []
    if not added:
        return SPACED_RUNS.findall
    # Those that take white space beside them, stand as words only or are looked
    # for after normalizing are left to the library, with the whole text.
    special = any(t.get(k) for t in added for k in ("lstrip", "rstrip", "single_word", "normalized"))
    longest_first = sorted((t["content"] for t in added), key=len, reverse=True)
    tokens = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")")

    def split(text: str) -> list[str]:
        parts = tokens.split(text)
        if len(parts) == 1:
            return SPACED_RUNS.findall(text)
        if special:
            return [text]
        # Every second part is an added token.
        return [c for i, part in enumerate(parts) for c in ([part] if i % 2 else SPACED_RUNS.findall(part))]
    return split


class ChunkCache:
    """Ids of chunks, as little-endian 32-bit integers.

    Two generations of at most ``most`` chunks: when the young one is full it
    becomes the old one, and chunks met again move back, so frequent chunks stay.
    """

    def __init__(self, encode: Callable[[list[str]], list[list[int]]], most: int = 800_000):
        self.encode, self.most = encode, most
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def learn(self, chunks: list[str]) -> dict[str, bytes]:
        """A dictionary that holds all of ``chunks``."""
        young, old = self.young, self.old
        missing = set(chunks).difference(young)
        if missing:
            if len(young) + len(missing) > self.most:
                self.old = old = young
                self.young = young = {}
                missing = set(chunks)
            again = {c: old[c] for c in missing if c in old}
            young.update(again)
            new = [c for c in missing if c not in again]
            for chunk, ids in zip(new, self.encode(new), strict=True):
                young[chunk] = np.array(ids, "<u4").tobytes()
        return young

    def texts(self, texts: list[str], split: Callable[[str], list[str]]) -> list[bytes]:
        """The ids of each text."""
        cut = [split(t) for t in texts]
        known = self.learn([c for chunks in cut for c in chunks])
        return [b"".join(map(known.__getitem__, chunks)) for chunks in cut]


_caches: dict[object, ChunkCache] = {}


def cache_of(key: object, make: Callable[[], Callable[[list[str]], list[list[int]]]]) -> ChunkCache:
    """The worker's cache for a vocabulary; ``make`` builds its encoder once."""
    if key not in _caches:
        _caches.clear()     # one vocabulary at a time
        _caches[key] = ChunkCache(make())
    return _caches[key]


def library_encoder(definition: str) -> Callable[[list[str]], list[list[int]]]:
    """Encoder of chunks by the tokenizers library, from a tokenizer's JSON."""
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_str(definition)

    def encode(chunks: list[str]) -> list[list[int]]:
        out = []
        for i in range(0, len(chunks), 5000):
            out += [e.ids for e in tokenizer.encode_batch_fast(chunks[i:i + 5000], add_special_tokens=False)]
        return out
    return encode


def read_text(path: str) -> str:
    """A vocabulary file of a few MB, read on the driver."""
    with open(path, encoding="utf-8") as f:
        return f.read()
