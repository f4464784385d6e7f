"""Token ids of whole Arrow columns of texts, by the tokenizers library.

A column is cut into chunks that the library encodes by themselves, with numpy
over the bytes; Arrow's dictionary leaves each different chunk once; only those
not met before by the worker are encoded; the ids of the texts are gathered from
the chunks' ids. No step runs over single words in Python.

Where a text is cut (no token crosses these places):

* ``SPACED`` (byte-level tokenizers): before a run without white space and the
  one space before it; before other white space, of which the last character
  stands alone; after a run of ASCII letters.
* ``PLAIN`` (tokenizers that drop white space): around spaces and line ends; after
  a run of ASCII letters.
* The library takes added tokens out of the whole text first, the longest where
  several begin: each is a chunk, and what stands beside it is cut like a text
  of its own. Texts with added tokens that take white space beside them, stand
  as words only or are looked for after normalizing are one chunk each.
"""

from __future__ import annotations

import json
import os
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACED, PLAIN = "spaced", "plain"
#: Different chunks that a worker keeps, in each of two generations.
KEPT = 800_000
#: Chunks that one call of the library encodes.
TOGETHER = 5000

#: The bytes and byte sequences (UTF-8) of white space.
_ASCII_WHITE = (0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20)
_LONG_WHITE = [c.encode() for c in map(chr, (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
                                             0x2028, 0x2029, 0x202F, 0x205F, 0x3000))]

_IS_WHITE = np.zeros(256, bool)
_IS_WHITE[list(_ASCII_WHITE)] = True
_IS_GAP = np.zeros(256, bool)
_IS_GAP[[0x20, 0x0A]] = True
_IS_LETTER = np.zeros(256, bool)
_IS_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_ENDS_LETTERS = ~_IS_LETTER & ~_IS_WHITE
_ENDS_LETTERS[0x80:] = False


def _white(data: np.ndarray) -> np.ndarray:
    """The bytes that are part of white space."""
    white = _IS_WHITE[data]
    for lead in {c[0] for c in _LONG_WHITE}:
        at = np.flatnonzero(data == lead)
        if not len(at):
            continue
        for c in _LONG_WHITE:
            if c[0] == lead:
                here = at[at + len(c) <= len(data)]
                for i, byte in enumerate(c[1:], 1):
                    here = here[data[here + i] == byte]
                for i in range(len(c)):
                    white[here + i] = True
    return white


def chunk_starts(data: np.ndarray, begins: np.ndarray, how: str) -> np.ndarray:
    """A flag for each byte that begins a chunk. ``begins``: where texts, and what
    is cut like a text, begin."""
    starts = np.zeros(len(data), bool)
    if not len(data):
        return starts
    letters_end = _IS_LETTER[data[:-1]] & _ENDS_LETTERS[data[1:]]
    if how == PLAIN:
        gap = _IS_GAP[data]
        starts[1:] = (gap[1:] != gap[:-1]) | letters_end
    else:
        white = _white(data)
        starts[1:] = (white[1:] & ~white[:-1]) | letters_end
        after = np.zeros(len(data), bool)
        after[1:] = ~white[1:] & white[:-1]
        after[begins] = False
        after = np.flatnonzero(after)
        last = after - np.where(data[after - 1] < 0x80, 1, np.where(data[after - 2] == 0xC2, 2, 3))
        starts[last] = True
        starts[after[data[last] != 0x20]] = True
    starts[begins] = True
    return starts


class _AddedTokens:
    def __init__(self, definition: str):
        tokens = json.loads(definition).get("added_tokens") or []
        self.contents = sorted((t["content"] for t in tokens), key=len, reverse=True)
        self.pattern = re.compile("|".join(map(re.escape, self.contents)).encode()) if tokens else None
        self.special = any(t.get(k) for t in tokens for k in ("lstrip", "rstrip", "single_word", "normalized"))

    def ranges(self, column: pa.Array, at: np.ndarray, data: np.ndarray) -> list[tuple[int, int]]:
        """Where the added tokens are in the column's bytes; whole texts where
        only the library can tell."""
        if self.pattern is None:
            return []
        found = pc.match_substring(column, self.contents[0])
        for c in self.contents[1:]:
            found = pc.or_(found, pc.match_substring(column, c))
        out = []
        for row in np.flatnonzero(np.asarray(found)).tolist():
            a, b = int(at[row]), int(at[row + 1])
            if self.special:
                out.append((a, b))
            else:
                out += [(a + m.start(), a + m.end()) for m in self.pattern.finditer(data[a:b].tobytes())]
        return out


class TextEncoder:
    """Ids of texts, with the ids of ``most`` to twice ``most`` chunks at hand:
    when the young generation is full it becomes the old one, and chunks met
    again move back, so frequent chunks stay."""

    def __init__(self, definition: str, how: str, most: int = KEPT):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer, self.how, self.most = Tokenizer.from_str(definition), how, most
        self.added = _AddedTokens(definition)
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.separator = None
        if self.added.contents and not self.added.special:
            self.separator = self.added.contents[-1]
            self.separator_id = self.tokenizer.token_to_id(self.separator)

    def _library(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _together(self, chunks: list[bytes]) -> list[bytes]:
        """Ids of chunks from one text, in which an added token parts them. Each
        part is encoded by itself; where a chunk and its neighbour make an added
        token, parts are missing and the chunks are encoded one by one."""
        texts = [c.decode("utf-8", "replace") for c in chunks]
        if self.separator is not None and not any(self.separator in t for t in texts):
            ids = np.array(self._library([self.separator.join(texts)])[0], "<u4")
            ends = np.flatnonzero(ids == self.separator_id).tolist()
            if len(ends) == len(texts) - 1:
                raw = ids.tobytes()
                return [raw[4 * a:4 * b] for a, b in zip([0, *[e + 1 for e in ends]], [*ends, len(ids)], strict=True)]
        return [np.array(ids, "<u4").tobytes() for ids in self._library(texts)]

    def _known(self, chunks: list[bytes]) -> list[bytes]:
        young, old = self.young, self.old
        missing = [c for c in chunks if c not in young]
        if missing:
            if len(young) + len(missing) > self.most:
                self.old = old = young
                self.young = young = {}
                missing = chunks
            new = []
            for c in missing:
                if c in old:
                    young[c] = old[c]
                else:
                    new.append(c)
            for i in range(0, len(new), TOGETHER):
                part = new[i:i + TOGETHER]
                young.update(zip(part, self._together(part), strict=True))
        return [young[c] for c in chunks]

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, number of ids of each text)"""
        column = column.cast(pa.large_string())
        at = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
        if not len(column) or at[0] == at[-1]:
            return np.zeros(0, np.uint32), np.zeros(len(column), np.int64)
        data = np.frombuffer(column.buffers()[2], np.uint8)[at[0]:at[-1]]
        at = at - at[0]
        ranges = self.added.ranges(column, at, data)
        begins = np.concatenate([at[:-1], np.array(ranges, np.int64).reshape(-1)])
        starts = chunk_starts(data, begins[begins < len(data)], self.how)
        for a, b in ranges:
            starts[a + 1:b] = False
        starts = np.flatnonzero(starts)
        offsets = np.append(starts, len(data)).astype(np.int64)
        chunks = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
        chunks = chunks.dictionary_encode()
        different = chunks.dictionary.to_pylist()
        if self.how == PLAIN:
            texts = [c for c in different if c.strip(b" \n")]
            known = iter(self._known(texts))
            ids = [next(known) if c.strip(b" \n") else b"" for c in different]
        else:
            ids = self._known(different)
        pool = np.frombuffer(b"".join(ids), "<u4")
        lengths = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        code = np.asarray(chunks.indices)
        sizes = lengths[code]
        ends = np.cumsum(sizes)
        shift = (np.cumsum(lengths) - lengths)[code] - (ends - sizes)
        gathered = pool[np.repeat(shift, sizes) + np.arange(ends[-1])]
        before = np.r_[0, ends][np.searchsorted(starts, at)]
        return gathered, np.diff(before)


_encoders: dict[tuple, TextEncoder] = {}


def encoder_of(definition: str, how: str) -> TextEncoder:
    """The worker's encoder for a tokenizer; one at a time is kept."""
    key = (zlib.crc32(definition.encode()), len(definition), how)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = TextEncoder(definition, how)
    return _encoders[key]


def with_end(ids: np.ndarray, counts: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids with an end id after each text, and where each text ends then."""
    ends = np.cumsum(counts + 1)
    out = np.full(len(ids) + len(counts), end_id, np.uint32)
    own = np.ones(len(out), bool)
    own[ends - 1] = False
    out[own] = ids
    return out, ends
