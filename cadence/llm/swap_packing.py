"""Best-fit packing with swap-based local search (operator 13).

A document is its token ids and an end id. One of at most ``SEQUENCE`` ids stays
whole; a longer one is cut into pieces of ``SEQUENCE``, the first of which may be
shorter. The pieces go into as few sequences as can be found:

1. Texts are encoded where they are read; only lengths and checksums travel.
2. Pieces are dealt into random groups of about ``GROUP``. A group is packed
   best-fit decreasing: the fullest bin with room takes the piece.
3. Local search on the bins that are not full, fullest first: from one of the
   ``DONORS`` emptiest bins a piece moves over, or is exchanged against one or two
   of the bin's pieces, or two are exchanged against one; of all these the one
   that fills most is done. Each raises the sum of the squared fills, so the
   emptiest bins drain until they are gone or nothing is left to do.
4. The bins below ``FULL`` of all groups are dealt anew, whole, and searched once
   more together (the better of their bins as they are and best-fit decreasing),
   so that a group's rest does not cost a sequence.

A group is a few thousand numbers, whatever the corpus is; groups are random, so
a hot source or a group of copies is spread over all of them.

Edge cases: a null or empty text is the end id alone; repeated rows and rows that
share an id are packed one by one; a null id stays null; texts of any length are
cut; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.llm.chunks import read_text
from cadence.llm.common import slices, whole_text, written
from cadence.llm.encoding import SPACED, encoder_of, with_end

SEQUENCE = 2048
END_ID = 0
GROUP = 8000
DONORS = 8
FULL = 15 / 16
#: Exchanges tried in one group at most; the pieces stay where they are then.
EXCHANGES = 20_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, row long"
PLACED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long, fill long"


def cuts(length: int, sequence: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document: only the first may be short."""
    first = length % sequence or sequence
    return [(0, first), *((at, sequence) for at in range(first, length, sequence))]


def _encode(definition: str, sequence: int, end_id: int):
    names, kinds = [c.split()[0] for c in PIECES.split(", ")], [pa.int64(), pa.int32(), *[pa.int64()] * 4]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(definition, SPACED)
        for batch in batches:
            for part in slices(batch, "text", 4_000_000):
                ids, ends = with_end(*encoder.encode(part.column("text")), end_id)
                raw, at = memoryview(ids.astype("<u4").tobytes()), 0
                out: list[tuple] = []
                for doc, row, end in zip(part.column("doc_id").to_pylist(), part.column("row").to_pylist(), ends.tolist(),
                                         strict=True):
                    for number, (start, length) in enumerate(cuts(end - at, sequence)):
                        piece = raw[4 * (at + start):4 * (at + start + length)]
                        out.append((doc, number, start, length, zlib.crc32(piece), row))
                    at = end
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)],
                                                 names=names)
    return encode


def best_fit(lengths: list[int], capacity: int) -> list[int]:
    """The bin of each length, best-fit decreasing; ties in the given order."""
    with_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0       # bit r is set while a bin has room r
    out, bins = [0] * len(lengths), 0
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        length = lengths[i]
        fitting = rooms >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            bin_ = with_room[room].pop()
            if not with_room[room]:
                rooms &= ~(1 << room)
        else:
            room, bin_, bins = capacity, bins, bins + 1
        out[i] = bin_
        if room > length:
            with_room[room - length].append(bin_)
            rooms |= 1 << (room - length)
    return out


class LocalSearch:
    """Bins of pieces that exchange pieces until nothing fills a bin further."""

    def __init__(self, lengths: list[int], bins: list[int], capacity: int):
        self.lengths, self.capacity = lengths, capacity
        self.held: list[list[int]] = [[] for _ in range(max(bins, default=-1) + 1)]
        for i, b in enumerate(bins):
            self.held[b].append(i)
        self.fill = [sum(lengths[i] for i in held) for held in self.held]

    def _different(self, bin_: int) -> dict[int, list[int]]:
        """The bin's pieces by length."""
        out: dict[int, list[int]] = {}
        for i in self.held[bin_]:
            out.setdefault(self.lengths[i], []).append(i)
        return out

    def _pairs(self, different: dict[int, list[int]]) -> dict[int, tuple[int, int]]:
        """Two of the bin's pieces for each sum of two lengths."""
        found: dict[int, tuple[int, int]] = {}
        sizes = sorted(different)
        for n, a in enumerate(sizes):
            if len(different[a]) > 1:
                found.setdefault(2 * a, (different[a][0], different[a][1]))
            for b in sizes[n + 1:]:
                found.setdefault(a + b, (different[a][0], different[b][0]))
        return found

    def _best(self, target: int, donors: list[int]) -> tuple[int, int, tuple, tuple] | None:
        """(gain, donor, pieces that come, pieces that go) that fills ``target``
        most, one piece at least moving towards it."""
        room = self.capacity - self.fill[target]
        mine = self._different(target)
        one_out = {0: ()} | {size: (which[0],) for size, which in mine.items()}
        two_out = self._pairs(mine)
        best = None
        for donor in donors:
            theirs = self._different(donor)
            one_in = {size: (which[0],) for size, which in theirs.items()}
            for come, go in ((one_in, one_out), (one_in, two_out), (self._pairs(theirs), {s: w for s, w in one_out.items() if s})):
                if not come or not go:
                    continue
                sizes, leaving = np.array(sorted(come)), np.array(list(go))
                at = np.searchsorted(sizes, leaving + room, "right") - 1
                gain = np.where(at >= 0, sizes[at] - leaving, 0)
                k = int(gain.argmax())
                if gain[k] > (best[0] if best else 0):
                    best = int(gain[k]), donor, come[int(sizes[at[k]])], go[int(leaving[k])]
            if best and best[0] == room:
                break
        return best

    def run(self, exchanges: int = EXCHANGES, donors: int = DONORS) -> list[int]:
        """The bin of each piece afterwards."""
        changed = True
        while changed and exchanges:
            changed = False
            underfull = [b for b, f in enumerate(self.fill) if 0 < f < self.capacity]
            for target in sorted(underfull, key=lambda b: -self.fill[b]):
                while exchanges and 0 < self.fill[target] < self.capacity:
                    # Only from emptier bins: what fills the target raises the squared fills.
                    emptier = [b for b in underfull if b != target and 0 < self.fill[b] <= self.fill[target]]
                    found = self._best(target, heapq.nsmallest(donors, emptier, key=lambda b: self.fill[b]))
                    if found is None:
                        break
                    gain, donor, come, go = found
                    for moved, a, b in ((come, donor, target), (go, target, donor)):
                        for i in moved:
                            self.held[a].remove(i)
                            self.held[b].append(i)
                    self.fill[target] += gain
                    self.fill[donor] -= gain
                    exchanges -= 1
                    changed = True
        out = [0] * len(self.lengths)
        for b, held in enumerate(self.held):
            for i in held:
                out[i] = b
        return out


def placed(lengths: list[int], capacity: int, given: list[int] | None = None) -> tuple[list[int], list[int], list[int]]:
    """(bin, offset there, fill of the bin) of each piece; bins are numbered from
    0 without gaps. ``given``: bins to start from, if these are not more."""
    bins = best_fit(lengths, capacity)
    if given is not None and len(set(given)) <= max(bins, default=-1) + 1:
        number = {b: n for n, b in enumerate(dict.fromkeys(given))}
        bins = [number[b] for b in given]
    bins = LocalSearch(lengths, bins, capacity).run()
    number = {b: n for n, b in enumerate(dict.fromkeys(bins))}
    fill, offsets = [0] * len(number), []
    bins = [number[b] for b in bins]
    for b, length in zip(bins, lengths, strict=True):
        offsets.append(fill[b])
        fill[b] += length
    return bins, offsets, [fill[b] for b in bins]


def _pack(capacity: int, sequence_of: Callable[[int, int], int], again: bool):
    """Rows of one group come together."""
    names = [c.split()[0] for c in PLACED.split(", ")]
    kept = names[:5] + (["sequence_id"] if again else [])

    def place(group: int, parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(parts).combine_chunks()
        given = rows.column("sequence_id").to_pylist() if again else None
        bins, offsets, fill = placed(rows.column("length").to_pylist(), capacity, given)
        made = [pa.array([sequence_of(group, b) for b in bins], pa.int64()), pa.array(offsets, pa.int64()),
                pa.array(fill, pa.int64())]
        return pa.RecordBatch.from_arrays([*(rows.column(c).combine_chunks() for c in names[:5]), *made], names=names)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts = None, []
        for batch in batches:
            groups = np.asarray(batch.column("grp"))
            borders = [0, *(np.flatnonzero(np.diff(groups)) + 1).tolist(), len(groups)] if len(groups) else [0]
            for a, b in zip(borders[:-1], borders[1:], strict=True):
                if groups[a] != now:
                    if parts:
                        yield place(now, parts)
                    now, parts = int(groups[a]), []
                parts.append(batch.slice(a, b - a).select(kept))
        if parts:
            yield place(now, parts)
    return pack


def packed(docs: DataFrame, tokenizer: str, id_column: str = "doc_id", text_column: str = "text",
           sequence: int = SEQUENCE, end_id: int = END_ID, group: int = GROUP) -> DataFrame:
    """One row for each piece: its document and number there, where it starts,
    its length and checksum, its sequence and the offset there. ``tokenizer``:
    path of a byte-level tokenizer's JSON on the driver."""
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), whole_text(text_column).alias("text"),
                       F.monotonically_increasing_id().alias("row"))
    pieces = written(rows.mapInArrow(_encode(read_text(tokenizer), sequence, end_id), PIECES), "pieces")

    def dealt(frame: DataFrame, by: list[str], within: list[str], again: bool) -> DataFrame:
        groups = max(1, round(frame.count() / group))
        numbered = frame.withColumn("grp", F.pmod(F.xxhash64(*by), F.lit(groups)))
        return (numbered.repartition("grp").sortWithinPartitions("grp", *within)
                .mapInArrow(_pack(sequence, lambda g, b: (2 * g + again) << 32 | b, again), PLACED))

    first = written(dealt(pieces, ["row", "piece"], ["row", "piece"], False), "first")
    enough = F.col("fill") >= int(sequence * FULL)
    rest = first.where(~enough).drop("offset", "fill")
    order = ["sequence_id", "doc_id", "piece", "length", "ids_crc32"]
    return first.where(enough).unionByName(dealt(rest, ["sequence_id"], order, True)).drop("fill")
