"""Fill-in-middle transformation by memoized content-defined chunks (operator 12).

A text of n code points is cut at two places that its id decides, and written as
prefix, suffix, middle (``psm``) or suffix, prefix, middle (``spm``), each behind
its mark; some texts, by their id, stay ``plain``.

The places are numbers of code points; texts are bytes (UTF-8). To find them
without walking over every text:

1. A rolling hash over the last ``WINDOW`` bytes cuts a text into chunks of
   ``LEAST`` to ``MOST`` bytes. A border depends on the bytes before it only, so
   texts that share a passage share its inner chunks.
2. A chunk met before is found in a bounded cache by its content (its hash finds
   it, its bytes are compared) with its summary: the code points that begin in it,
   whether it holds a mark, and its first and last bytes, with which marks across
   borders are found. A chunk may begin or end inside a code point.
3. Summaries combine: running sums of the chunks' counts give n and the chunk of
   each cut, whose own code points are then counted to the byte.

Edge cases: a null text is the empty text, which is plain, as is a text that holds
a mark; equal cuts leave the middle empty; a null id counts as an empty one
(``1:``); rows that share an id are cut at the same shares of their own lengths;
texts of any length are handled in slices of rows; an empty table gives no rows;
other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadence.llm.common import slices, whole_text

#: Fixed values of the format.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
TRANSFORMED_PERCENT = 90
SPM_PERCENT = 20

WINDOW = 32
LEAST, MOST = 256, 8192
BORDER_BITS = 10        # a border every 1024 bytes or so
#: Bytes of chunks that a worker keeps, in each of two generations.
KEPT_BYTES = 32_000_000

_MARKS = tuple(m.encode() for m in (PREFIX, SUFFIX, MIDDLE))
# The hash of a byte, from a fixed rule.
_GEAR = (np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)).astype(np.uint32)


def rolling_hashes(data: np.ndarray) -> np.ndarray:
    """For each byte the hash of it and the ``WINDOW`` - 1 before it: the sum of
    their table values, shifted by their distance. Doubled spans, no loop over
    bytes."""
    hashes = _GEAR[data]
    span = 1
    while span < WINDOW:
        shifted = hashes[:-span] << np.uint32(span)
        hashes = hashes.copy()
        hashes[span:] += shifted
        span *= 2
    return hashes


def chunk_ends(data: np.ndarray, at: np.ndarray) -> list[list[int]]:
    """Where the chunks of each text end. ``at``: where the texts begin, and the
    end of the last. A chunk is longer than the window, so that no border depends
    on the text before."""
    if len(data) <= LEAST:
        return [[int(b)] if b > a else [] for a, b in zip(at[:-1], at[1:], strict=True)]
    # The low bits of the sum see only the last bytes; the high ones see all.
    borders = np.flatnonzero(rolling_hashes(data) >> np.uint32(32 - BORDER_BITS) == 0) + 1
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        ends = []
        while b - a > LEAST:
            k = int(np.searchsorted(borders, a + LEAST))
            a = min(int(borders[k]) if k < len(borders) else b, a + MOST, b)
            ends.append(a)
        if b > a:
            ends.append(b)
        out.append(ends)
    return out


def _begins(chunk: bytes) -> np.ndarray:
    """The bytes at which a code point begins."""
    return np.flatnonzero((np.frombuffer(chunk, np.uint8) & 0xC0) != 0x80)


Summary = tuple[int, bool, bytes, bytes]


def summary(chunk: bytes) -> Summary:
    """(code points that begin here, holds a mark, first two bytes, last two)"""
    return len(_begins(chunk)), any(m in chunk for m in _MARKS), chunk[:2], chunk[-2:]


class ChunkMemo:
    """Summaries by content: two generations of at most ``most`` bytes of chunks.
    When the young one is full it becomes the old one; chunks met again move back."""

    def __init__(self, most: int = KEPT_BYTES):
        self.most, self.held = most, 0
        self.young: dict[bytes, Summary] = {}
        self.old: dict[bytes, Summary] = {}
        self.found = self.missed = 0

    def of(self, chunk: bytes) -> Summary:
        known = self.young.get(chunk)
        if known is not None:
            self.found += 1
            return known
        known = self.old.get(chunk)
        if known is None:
            self.missed += 1
            known = summary(chunk)
        else:
            self.found += 1
        if self.held + len(chunk) > self.most:
            self.old, self.young, self.held = self.young, {}, 0
        self.young[chunk] = known
        self.held += len(chunk)
        return known


class ChunkedText:
    """A text as the combined summaries of its chunks."""

    def __init__(self, data: bytes, start: int, ends: list[int], memo: ChunkMemo):
        self.data, self.starts, self.ends = data, [start, *ends[:-1]], ends
        self.before = [0]       # code points before each chunk, and in all
        self.marked = False
        tail = b""
        for a, b in zip(self.starts, ends, strict=False):
            count, marked, first, last = memo.of(data[a:b])
            self.before.append(self.before[-1] + count)
            # A mark of three bytes crosses a border within two bytes on each side.
            self.marked = self.marked or marked or any(m in tail + first for m in _MARKS)
            tail = (tail + last)[-2:] if b - a < 2 else last
        self.length = self.before[-1]

    def offset(self, units: int) -> int:
        """Where code point number ``units`` begins, or the end of the text."""
        if units >= self.length:
            return self.ends[-1] if self.ends else self.starts[0]
        chunk = int(np.searchsorted(self.before, units, "right")) - 1
        own = _begins(self.data[self.starts[chunk]:self.ends[chunk]])
        return self.starts[chunk] + int(own[units - self.before[chunk]])


SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
_memo = ChunkMemo()


def _transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    for batch in batches:
        for part in slices(batch, "text", 4_000_000):
            column = part.column("text").cast(pa.large_binary())
            at = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
            data = memoryview(column.buffers()[2])[at[0]:at[-1]].tobytes() if at[-1] > at[0] else b""
            at = at - at[0]
            ends = chunk_ends(np.frombuffer(data, np.uint8), at)
            h = [part.column(c).to_pylist() for c in ("h1", "h2", "h3", "h4")]
            ns, forms, befores, middles, outputs = [], [], [], [], []
            for row, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist(), strict=True)):
                text = ChunkedText(data, a, ends[row], _memo)
                n = text.length
                ns.append(n)
                if not n or text.marked or h[2][row] % 100 >= TRANSFORMED_PERCENT:
                    forms.append("plain")
                    befores.append(None)
                    middles.append(None)
                    outputs.append(data[a:b])
                    continue
                low, high = sorted((h[0][row] % (n + 1), h[1][row] % (n + 1)))
                x, y = text.offset(low), text.offset(high)
                prefix, middle, suffix = data[a:x], data[x:y], data[y:b]
                spm = h[3][row] % 100 < SPM_PERCENT
                forms.append("spm" if spm else "psm")
                befores.append(low)
                middles.append(high - low)
                first = (_MARKS[1], suffix, _MARKS[0], prefix) if spm else (_MARKS[0], prefix, _MARKS[1], suffix)
                outputs.append(b"".join((*first, _MARKS[2], middle)))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(ns, pa.int64()), pa.array(forms, pa.string()), pa.array(befores, pa.int64()),
                 pa.array(middles, pa.int64()), pa.array(outputs, pa.binary()).view(pa.string())], names=names)


def _hash(number: int, digest: Column) -> Column:
    """One of the 8-digit groups of a hex digest as a number."""
    return F.conv(F.substring(digest, 8 * number - 7, 8), 16, 10).cast("long")


def transformed(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row for each row: id, n (code points), form, prefix_chars and
    middle_chars (null if plain), output (the text to train on)."""
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), whole_text(text_column).alias("text"))
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    return (rows.select("doc_id", "text", *[_hash(i, digest).alias(f"h{i}") for i in (1, 2, 3, 4)])
            .mapInArrow(_transform, SCHEMA).withColumnRenamed("doc_id", id_column))


def restored(output: Column | str, form: Column | str) -> Column:
    """The text that an output of a form was made from. A transformed text holds
    no mark, so each mark of its output is the only one."""
    output, form = (F.col(c) if isinstance(c, str) else c for c in (output, form))
    head, middle = F.substring_index(output, MIDDLE, 1), F.substring_index(output, MIDDLE, -1)

    def between(mark: str) -> tuple[Column, Column]:
        """What stands before and behind ``mark``, without the mark at the front."""
        return F.substring_index(F.substring(head, 4, 2**31 - 1), mark, 1), F.substring_index(head, mark, -1)

    psm_prefix, psm_suffix = between(SUFFIX)
    spm_suffix, spm_prefix = between(PREFIX)
    return (F.when(form == "plain", output)
            .when(form == "psm", F.concat(psm_prefix, middle, psm_suffix))
            .otherwise(F.concat(spm_prefix, middle, spm_suffix)))


def digests(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The transformed rows with the sha256 of output and rebuilt text instead of
    the output."""
    return transformed(docs, id_column, text_column).select(
        id_column, "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored("output", "form"), 256).alias("restored_sha256"))
