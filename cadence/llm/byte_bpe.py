"""Byte-level BPE encoding and decoding (operator 7).

A text is split by the vocabulary's pattern; each match is encoded by itself:

* *First tier*: a minimal perfect hash over the vocabulary. A match that is a
  token already is resolved by one lookup: its 64-bit hash picks a bucket, the
  bucket's seed picks the slot, and the slot's bytes confirm it.
* *Second tier*: any other match starts as a linked list of its bytes. A heap
  holds the mergeable neighbours by rank; the lowest rank is merged first, the
  leftmost of equal ranks, and stale entries are skipped when popped.

Matches that do not hold white space within are found in runs of text that
repeat; their ids are kept in the worker's bounded cache (``chunks``).

The vocabulary, its tables included, is a few MB whatever the corpus is; it is
built on the driver and shipped with the task.

Edge cases: a null or empty text has no ids and decodes to no bytes; texts are
encoded whole; repeated rows and shared or null ids change nothing; other
columns are not looked at.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadence.llm.chunks import SPACED_RUNS, cache_of
from cadence.llm.common import slices, whole_text
from cadence.llm.words import mixed

BUCKET = 4      # keys of a bucket, on average


def read_ranks(path: str) -> list[bytes]:
    """Tokens by rank, from a file of base64 tokens and ranks."""
    ranks = {}
    with open(path, "rb") as lines:
        for line in lines:
            if line.strip():
                token, rank = line.split()
                ranks[int(rank)] = base64.b64decode(token)
    if sorted(ranks) != list(range(len(ranks))):
        raise ValueError("ranks have gaps")
    return [ranks[i] for i in range(len(ranks))]


class PerfectHash:
    """Minimal perfect hash by hash and displace: the keys of a bucket share the
    first seed that gives them free, different slots; full buckets come first. A
    bucket of one key names its slot itself, as a negative seed."""

    def __init__(self, keys: list[bytes]):
        self.slots = n = max(1, len(keys))
        self.buckets = max(1, n // BUCKET)
        hashes = np.array([xxhash.xxh3_64_intdigest(k) for k in keys], np.uint64)
        if len(np.unique(hashes)) != len(hashes):
            raise ValueError("equal keys")
        bucket = (hashes % np.uint64(self.buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        starts = np.searchsorted(bucket[order], np.arange(self.buckets + 1))
        self.seeds = np.zeros(self.buckets, np.int64)
        self.key_at = np.full(n, -1, np.int64)
        free = np.ones(n, bool)
        spare = None
        for b in np.argsort(-np.diff(starts), kind="stable").tolist():
            own = order[starts[b]:starts[b + 1]]
            if len(own) == 0:
                break
            if len(own) == 1:
                spare = iter(np.flatnonzero(free).tolist()) if spare is None else spare
                places, seed = np.array([next(spare)]), 0
                self.seeds[b] = -1 - places[0]
            else:
                places, seed = self._place(hashes[own], free)
                self.seeds[b] = seed
                free[places] = False
            self.key_at[places] = own
        self.seed_list, self.key_list = self.seeds.tolist(), self.key_at.tolist()

    def _place(self, hashes: np.ndarray, free: np.ndarray) -> tuple[np.ndarray, int]:
        """Slots for the keys of a bucket and the first seed that gives them."""
        seed, step = 0, 16
        while True:
            places = self._slot(hashes, np.arange(seed, seed + step))
            ok = free[places].all(1)
            if len(hashes) > 1:
                ok &= (np.diff(np.sort(places, 1), axis=1) > 0).all(1)
            if ok.any():
                at = int(np.argmax(ok))
                return places[at], seed + at
            seed, step = seed + step, min(step * 2, 4096)

    def _slot(self, hashes: np.ndarray, seeds: np.ndarray) -> np.ndarray:
        """One row of slots for each seed."""
        salt = seeds.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed(hashes[None, :] ^ salt[:, None]) % np.uint64(self.slots)).astype(np.int64)

    def find(self, key: bytes) -> int:
        """Number of the only key that may equal ``key``, or -1."""
        h = xxhash.xxh3_64_intdigest(key)
        seed = self.seed_list[h % self.buckets]
        if seed < 0:
            return self.key_list[-1 - seed]
        x = h ^ (seed * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
        x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & 0xFFFFFFFFFFFFFFFF
        x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & 0xFFFFFFFFFFFFFFFF
        return self.key_list[(x ^ (x >> 31)) % self.slots]


class ByteBPE:
    """A vocabulary of ranked byte strings and the pattern that splits texts."""

    def __init__(self, tokens: list[bytes], pattern: str, whole: PerfectHash | None = None):
        self.tokens = tokens
        self.split = regex.compile(pattern).findall
        self.whole = whole or PerfectHash(tokens)
        self.single = [self.rank(bytes([b])) for b in range(256)]
        # Every way to join two tokens to a token, as left << 32 | right: rank.
        known = {t: i for i, t in enumerate(tokens)}
        self.pairs = {known[t[:k]] << 32 | known[t[k:]]: i for i, t in enumerate(tokens)
                      for k in range(1, len(t)) if t[:k] in known and t[k:] in known}
        sizes = np.array([len(t) for t in tokens], np.int64)
        self.offsets = np.r_[0, np.cumsum(sizes)]
        self.sizes = sizes
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)

    def rank(self, piece: bytes) -> int:
        """The rank of a token, or -1."""
        n = self.whole.find(piece)
        return n if n >= 0 and self.tokens[n] == piece else -1

    def merged(self, piece: bytes) -> list[int]:
        """Ids of a piece that is no token, by merges in rank order."""
        ids = [self.single[b] for b in piece]
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        pair = self.pairs.get
        heap = [(rank, i, ids[i], ids[i + 1]) for i in range(n - 1)
                if (rank := pair(ids[i] << 32 | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, left, right = heapq.heappop(heap)
            j = after[i]
            if ids[i] != left or j >= n or ids[j] != right:
                continue
            ids[i], ids[j] = rank, -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (new := pair(rank << 32 | ids[k])) is not None:
                    heapq.heappush(heap, (new, i, rank, ids[k]))
            h = before[i]
            if h >= 0 and (new := pair(ids[h] << 32 | rank)) is not None:
                heapq.heappush(heap, (new, h, ids[h], rank))
        return [x for x in ids if x >= 0]

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        for match in self.split(text):
            piece = match.encode()
            rank = self.rank(piece)
            if rank >= 0:
                out.append(rank)
            else:
                out += self.merged(piece)
        return out

    def decode(self, ids: np.ndarray) -> bytes:
        ids = np.asarray(ids, np.int64)
        size = self.sizes[ids]
        ends = np.cumsum(size)
        at = np.repeat(self.offsets[ids] - (ends - size), size) + np.arange(int(ends[-1]) if len(ids) else 0)
        return self.bytes[at].tobytes()


DIGESTS = "id {}, n_tokens long, ids_sha256 string, decoded_sha256 string"
IDS = "id {}, ids array<int>"

_models: dict[str, ByteBPE] = {}


def vocabulary_key(tokens: list[bytes], pattern: str) -> str:
    """A digest of the whole vocabulary and the pattern."""
    digest = hashlib.sha256(pattern.encode())
    for token in tokens:
        digest.update(len(token).to_bytes(4, "little") + token)
    return digest.hexdigest()


def _model(key: str, tokens: list[bytes], pattern: str, whole: PerfectHash) -> ByteBPE:
    if key not in _models:
        _models.clear()
        _models[key] = ByteBPE(tokens, pattern, whole)
    return _models[key]


def _encoded(tokens: list[bytes], pattern: str, whole: PerfectHash):
    """Batches of rows with the ids of their texts."""
    key = vocabulary_key(tokens, pattern)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes], ByteBPE]]:
        model = _model(key, tokens, pattern, whole)
        cache = cache_of(("bpe", key), lambda: lambda chunks: [model.encode(c) for c in chunks])
        for batch in batches:
            for part in slices(batch, "text", 500_000):
                yield part, cache.texts(part.column("text").to_pylist(), SPACED_RUNS.findall), model
    return rows


def _input(docs: DataFrame, id_column: str, text_column: str) -> tuple[DataFrame, str]:
    rows = docs.select(F.col(id_column).alias("id"), whole_text(text_column).alias("text"))
    return rows, rows.schema["id"].dataType.simpleString()


def encoded(docs: DataFrame, ranks: str, pattern: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, ids) of every row. ``ranks``: path of the rank file on the driver."""
    tokens = read_ranks(ranks)
    run = _encoded(tokens, pattern, PerfectHash(tokens))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, ids, _ in run(batches):
            offsets = np.r_[0, np.cumsum([len(i) // 4 for i in ids])].astype(np.int32)
            flat = np.frombuffer(b"".join(ids), "<u4").astype(np.int32)
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))],
                                             names=["id", "ids"])
    rows, kind = _input(docs, id_column, text_column)
    return rows.mapInArrow(work, IDS.format(kind)).withColumnRenamed("id", id_column)


def decoded(ids: DataFrame, ranks: str, pattern: str, id_column: str = "doc_id", ids_column: str = "ids") -> DataFrame:
    """(id, decoded): the bytes of every row's ids."""
    tokens = read_ranks(ranks)
    whole, key = PerfectHash(tokens), vocabulary_key(tokens, pattern)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(key, tokens, pattern, whole)
        for batch in batches:
            out = [model.decode(i or []) for i in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(out, pa.binary())], names=["id", "decoded"])
    rows = ids.select(F.col(id_column).alias("id"), F.col(ids_column).alias("ids"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(work, f"id {kind}, decoded binary").withColumnRenamed("id", id_column)


def round_trip(docs: DataFrame, ranks: str, pattern: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row for each row: id, n_tokens, ids_sha256 (of the decimal ids joined
    by one space), decoded_sha256 (of the bytes that the ids decode to)."""
    tokens = read_ranks(ranks)
    run = _encoded(tokens, pattern, PerfectHash(tokens))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decimal = [str(i) for i in range(len(tokens))]
        for part, ids, model in run(batches):
            counts, shas, decoded_shas = [], [], []
            for raw in ids:
                numbers = np.frombuffer(raw, "<u4")
                counts.append(len(numbers))
                shas.append(hashlib.sha256(" ".join(map(decimal.__getitem__, numbers.tolist())).encode()).hexdigest())
                decoded_shas.append(hashlib.sha256(model.decode(numbers)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array(counts, pa.int64()), pa.array(shas, pa.string()), pa.array(decoded_shas, pa.string())],
                names=["id", "n_tokens", "ids_sha256", "decoded_sha256"])
    rows, kind = _input(docs, id_column, text_column)
    return rows.mapInArrow(work, DIGESTS.format(kind)).withColumnRenamed("id", id_column)
