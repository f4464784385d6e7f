"""Packing of documents into training sequences (operator 10).

A document is its token ids and an end id, cut into pieces: whole sequences of
``SEQUENCE`` ids as long as they last, then a rest. A sequence is padded to
``SEQUENCE`` unless its length is a power of two.

1. Texts are encoded where they are read; only lengths and checksums travel.
2. Documents are dealt into random groups of about ``GROUP`` documents.
3. In each group the rests are packed first-fit decreasing: the bins' free
   capacities are the leaves of a tournament tree whose inner nodes hold the
   largest capacity below them, so the first bin that fits is found in
   O(log bins). A group is a few thousand numbers, whatever the corpus is.

Edge cases: a null or empty text is the end id alone; repeated rows and rows
that share an id are packed one by one; a null id stays null; texts of any
length are cut; other columns are not looked at.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.llm.chunks import read_text
from cadence.llm.common import slices, whole_text
from cadence.llm.encoding import PLAIN, encoder_of, with_end

SEQUENCE = 4096
END_ID = 2
GROUP = 4000

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, row long"


def _encode(definition: str, sequence: int, end_id: int):
    names = [c.split()[0] for c in PIECES.split(", ")]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(definition, PLAIN)
        for batch in batches:
            for part in slices(batch, "text", 4_000_000):
                ids, ends = with_end(*encoder.encode(part.column("text")), end_id)
                raw, at = memoryview(ids.astype("<u4").tobytes()), 0
                out: list[tuple] = []
                for doc, row, end in zip(part.column("doc_id").to_pylist(), part.column("row").to_pylist(), ends.tolist(),
                                         strict=True):
                    for start in range(at, end, sequence):
                        piece = raw[4 * start:4 * min(start + sequence, end)]
                        out.append((doc, start - at, len(piece) // 4, zlib.crc32(piece), end - at, row))
                    at = end
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=names)
    return encode


class CapacityTree:
    """Tournament tree over the free capacities of bins, in the order opened."""

    def __init__(self, capacity: int):
        self.capacity, self.leaves, self.used = capacity, 1, 0
        self.top = [0, capacity]        # 1-based heap; leaves start at self.leaves

    def first_fit(self, length: int) -> tuple[int, int]:
        """Puts ``length`` into the first bin with room: (bin, offset there)."""
        top = self.top
        if top[1] < length:     # double: new bins are empty
            old, self.leaves = self.leaves, self.leaves * 2
            leaves = top[old:] + [self.capacity] * old
            self.top = top = [0] * self.leaves + leaves
            for i in range(self.leaves - 1, 0, -1):
                top[i] = max(top[2 * i], top[2 * i + 1])
        node = 1
        while node < self.leaves:
            node = 2 * node if top[2 * node] >= length else 2 * node + 1
        offset = self.capacity - top[node]
        top[node] -= length
        bin_ = node - self.leaves
        node //= 2
        while node:
            top[node] = max(top[2 * node], top[2 * node + 1])
            node //= 2
        self.used = max(self.used, bin_ + 1)
        return bin_, offset


def packed_lengths(lengths: list[int], capacity: int = SEQUENCE) -> list[tuple[int, int]]:
    """(bin, offset) of each length, first-fit decreasing; ties in given order."""
    tree, out = CapacityTree(capacity), [(0, 0)] * len(lengths)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        out[i] = tree.first_fit(lengths[i])
    return out


PLACED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def _pack(capacity: int):
    """Rows of one group come together."""
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]

    def place(group: int, held: list[list]) -> pa.RecordBatch:
        at = packed_lengths(held[2], capacity)
        columns = [*held, [(group << 32) | b for b, _ in at], [o for _, o in at]]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=[*names, "sequence_id", "offset"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, [[] for _ in names]
        for batch in batches:
            groups = np.asarray(batch.column("grp"))
            borders = [0, *(np.flatnonzero(np.diff(groups)) + 1).tolist(), len(groups)] if len(groups) else [0]
            for a, b in zip(borders[:-1], borders[1:], strict=True):
                if groups[a] != now:
                    if now is not None:
                        yield place(now, held)
                    now, held = int(groups[a]), [[] for _ in names]
                for store, name in zip(held, names, strict=True):
                    store += batch.column(name).slice(a, b - a).to_pylist()
        if now is not None:
            yield place(now, held)
    return pack


def packed(docs: DataFrame, tokenizer: str, id_column: str = "doc_id", text_column: str = "text",
           sequence: int = SEQUENCE, end_id: int = END_ID, group: int = GROUP) -> DataFrame:
    """One row for each piece: where it starts in its document, its length and
    checksum, the document's ids, and its sequence and offset there.
    ``tokenizer``: path of a tokenizer's JSON on the driver."""
    groups = max(1, round(docs.count() / group))
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), whole_text(text_column).alias("text"),
                       F.monotonically_increasing_id().alias("row"))
    pieces = rows.mapInArrow(_encode(read_text(tokenizer), sequence, end_id), PIECES)
    # The row number deals rows that share an id to different groups.
    dealt = pieces.withColumn("grp", F.pmod(F.xxhash64("doc_id", "row"), F.lit(groups))).drop("row")
    order = ["grp", "doc_id", "start", "ids_crc32", "length"]
    return dealt.repartition("grp").sortWithinPartitions(*order).mapInArrow(_pack(sequence), PLACED)
