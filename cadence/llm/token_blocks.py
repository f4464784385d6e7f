"""Token ids in patched frame-of-reference blocks (operator 1).

The ids of all documents form one long sequence, in ascending order of the
document ids, an end id after each document. It is written in *segments*, each
a binary record of a Parquet file in the shared folder, so that any store and
any writer of Spark will do and a lost executor costs its task only.

A segment holds four streams: document ids, null flags of these, document
lengths, token ids. A stream is cut into blocks of ``BLOCK`` values:

* the block's minimum is subtracted;
* the block is packed at the width that ``PERCENTILE`` of its values fit;
* values that need more bits are patched: their places and high bits are in the
  block's exception list;
* an index has each block's start, so that a block is read by itself.

A segment knows its partition and the ids before it there; the ids before a
partition are the sums of the ones before, so positions in the whole sequence
need no pass over the ids.

Edge cases: a null or empty text is the end id alone; a null document id comes
first and stays null; rows that share an id, or are repeated, all stay, side by
side; a text longer than a segment gets a longer segment; other columns are not
looked at; an empty table gives no rows.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cadence.llm.chunks import read_text
from cadence.llm.common import slices, whole_text
from cadence.llm.encoding import SPACED, encoder_of, with_end

BLOCK = 256
PERCENTILE = 90
END_ID = 0
SEGMENT_IDS = 1 << 18
MAGIC = b"PFR1"
_U = np.uint64
_LANES = BLOCK // 64


def _bits(values: np.ndarray) -> np.ndarray:
    """Bits that each value needs."""
    out = np.zeros(values.shape, np.int64)
    for step in (32, 16, 8, 4, 2, 1):
        high = (values >> _U(step)) > 0
        out += high * step
        values = np.where(high, values >> _U(step), values)
    return out + (values > 0)


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of BLOCK values below 2**width, as rows of 64-bit words."""
    lanes = np.ascontiguousarray(values.reshape(-1, 64).T)
    out = np.zeros((width, lanes.shape[1]), _U)
    for i in range(64):
        word, shift = divmod(i * width, 64)
        out[word] |= lanes[i] << _U(shift)
        if shift + width > 64:
            out[word + 1] |= lanes[i] >> _U(64 - shift)
    return out.T.reshape(len(values), _LANES * width)


def _unpack(words: np.ndarray, width: int) -> np.ndarray:
    lanes = np.ascontiguousarray(words.reshape(-1, width).T)
    out = np.empty((64, lanes.shape[1]), _U)
    mask = _U((1 << width) - 1)
    for i in range(64):
        word, shift = divmod(i * width, 64)
        x = lanes[word] >> _U(shift)
        if shift + width > 64:
            x = x | (lanes[word + 1] << _U(64 - shift))
        out[i] = x & mask
    return out.T.reshape(-1, BLOCK)


def encoded_stream(values: np.ndarray, percentile: int = PERCENTILE) -> bytes:
    """A stream of unsigned 64-bit values in blocks."""
    values = np.asarray(values, _U)
    n = len(values)
    blocks = -(-n // BLOCK)
    full = np.empty(blocks * BLOCK, _U)
    full[:n] = values
    if n:
        full[n:] = values[-1]
    full = full.reshape(blocks, BLOCK)
    least = full.min(1) if blocks else np.zeros(0, _U)
    rest = full - least[:, None]
    nth = -(-BLOCK * percentile // 100) - 1
    width = _bits(np.partition(rest, nth, 1)[:, nth]) if blocks else np.zeros(0, np.int64)
    high = np.where(width[:, None] < 64, rest >> np.minimum(width, 63).astype(_U)[:, None], _U(0))
    block, place = np.nonzero(high)
    starts = np.r_[0, np.cumsum(width * _LANES)]
    packed = np.zeros(int(starts[-1]), _U)
    for w in np.unique(width[width > 0]).tolist():
        which = np.flatnonzero(width == w)
        low = rest[which] & _U((1 << w) - 1)
        packed[(starts[which][:, None] + np.arange(w * _LANES)).ravel()] = _pack(low, w).ravel()
    exceptions = np.bincount(block, minlength=blocks)
    return b"".join((
        struct.pack("<qqq", n, len(packed), len(block)),
        least.astype("<u8").tobytes(), width.astype("u1").tobytes(), starts[:-1].astype("<u4").tobytes(),
        exceptions.astype("<u2").tobytes(), packed.astype("<u8").tobytes(),
        place.astype("u1").tobytes(), high[block, place].astype("<u8").tobytes()))


def decoded_stream(raw: memoryview) -> tuple[np.ndarray, memoryview]:
    """The values of the stream at the beginning of ``raw``, and what follows it."""
    n, words, patched = struct.unpack_from("<qqq", raw)
    raw = raw[24:]
    blocks = -(-n // BLOCK)

    def take(kind: str, count: int) -> np.ndarray:
        nonlocal raw
        out = np.frombuffer(raw, kind, count)
        raw = raw[out.nbytes:]
        return out

    least, width, starts = take("<u8", blocks), take("u1", blocks), take("<u4", blocks).astype(np.int64)
    exceptions, packed = take("<u2", blocks), take("<u8", words)
    place, high = take("u1", patched), take("<u8", patched)
    out = np.zeros((blocks, BLOCK), _U)
    for w in np.unique(width[width > 0]).tolist():
        which = np.flatnonzero(width == w)
        out[which] = _unpack(packed[(starts[which][:, None] + np.arange(w * _LANES)).ravel()], w)
    block = np.repeat(np.arange(blocks), exceptions)
    out[block, place] |= high << width[block].astype(_U)
    out += least[:, None]
    return out.ravel()[:n], raw


def encoded_segment(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray) -> bytes:
    missing = np.array([d is None for d in doc_ids], _U)
    known = np.array([d or 0 for d in doc_ids], np.int64).view(_U)
    return b"".join((MAGIC, encoded_stream(known), encoded_stream(missing),
                     encoded_stream(np.array(lengths, _U)), encoded_stream(ids)))


def decoded_segment(payload: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """(document ids, lengths, token ids)"""
    if payload[:4] != MAGIC:
        raise ValueError("not a token segment")
    known, raw = decoded_stream(memoryview(payload)[4:])
    missing, raw = decoded_stream(raw)
    lengths, raw = decoded_stream(raw)
    ids, _ = decoded_stream(raw)
    docs = [None if m else d for d, m in zip(known.view(np.int64).tolist(), missing.tolist(), strict=True)]
    return docs, lengths.astype(np.int64), ids.astype("<u4")


SEGMENTS = "part int, number int, before long, n_docs long, n_ids long, payload binary"


def _segments(definition: str, end_id: int, most: int):
    names = [c.split()[0] for c in SEGMENTS.split(", ")]
    kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(definition, SPACED)
        part_number = TaskContext.get().partitionId()
        docs: list = []
        lengths: list[int] = []
        parts: list[np.ndarray] = []
        number = before = held = 0

        def segment() -> pa.RecordBatch:
            nonlocal number, before, held
            payload = encoded_segment(docs, lengths, np.concatenate(parts))
            row = (part_number, number, before, len(docs), held, payload)
            number, before, held = number + 1, before + held, 0
            for full in (docs, lengths, parts):
                full.clear()
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names=names)

        for batch in batches:
            for piece in slices(batch, "text", 4_000_000):
                ids, ends = with_end(*encoder.encode(piece.column("text")), end_id)
                owners, at, done = piece.column("doc_id").to_pylist(), 0, 0
                while at < len(owners):
                    # Up to and with the document that fills the segment.
                    to = min(int(np.searchsorted(ends, done + most - held)) + 1, len(owners))
                    docs += owners[at:to]
                    lengths += np.diff(ends[at:to], prepend=done).tolist()
                    parts.append(ids[done:ends[to - 1]])
                    held, at, done = held + int(ends[to - 1]) - done, to, int(ends[to - 1])
                    if held >= most:
                        yield segment()
        if docs:
            yield segment()
    return encode


def write_tokens(docs: DataFrame, path: str, tokenizer: str, id_column: str = "doc_id", text_column: str = "text",
                 end_id: int = END_ID, segment_ids: int = SEGMENT_IDS) -> None:
    """Writes the ids of all texts to ``path``. ``tokenizer``: path of a
    tokenizer's JSON on the driver."""
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), whole_text(text_column).alias("text"),
                       F.monotonically_increasing_id().alias("row"))
    # The row number lets rows that share an id go to several partitions.
    dealt = rows.repartitionByRange("doc_id", "row").sortWithinPartitions("doc_id", "row").drop("row")
    dealt.mapInArrow(_segments(read_text(tokenizer), end_id, segment_ids), SEGMENTS).write.parquet(path)


def placed_segments(spark: SparkSession, path: str) -> DataFrame:
    """The segments with ``start``: the ids of all segments before."""
    segments = spark.read.schema(SEGMENTS).parquet(path)
    # One row a partition: a small table, whatever the partitions hold.
    sums = segments.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select("part", F.coalesce(F.sum("ids").over(earlier), F.lit(0)).alias("base"))
    # Broadcast: a number for each partition written, so that the ids stay where they are.
    return segments.join(F.broadcast(base), "part").withColumn("start", F.col("base") + F.col("before")).drop("base")


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start, payload in zip(batch.column("start").to_pylist(), batch.column("payload"), strict=True):
            docs, lengths, ids = decoded_segment(payload.as_buffer().to_pybytes())
            ends = np.cumsum(lengths)
            raw = memoryview(ids.tobytes())
            sums = [zlib.crc32(raw[4 * (e - n):4 * e]) for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(docs, pa.int64()), pa.array(start + ends - lengths), pa.array(lengths), pa.array(sums, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"])


def token_digests(spark: SparkSession, path: str) -> DataFrame:
    """Reads the files back: where each document's ids start, how many they are
    and their checksum."""
    return placed_segments(spark, path).select("start", "payload").mapInArrow(
        _digest, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start, payload in zip(batch.column("start").to_pylist(), batch.column("payload"), strict=True):
            docs, lengths, ids = decoded_segment(payload.as_buffer().to_pybytes())
            offsets = np.r_[0, np.cumsum(lengths)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(docs, pa.int64()), pa.array(start + offsets[:-1]),
                 pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids.astype(np.int32)))],
                names=["doc_id", "start", "ids"])


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, ids) of every document in the files."""
    return placed_segments(spark, path).select("start", "payload").mapInArrow(
        _documents, "doc_id long, start long, ids array<int>")
