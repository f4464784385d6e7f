"""Comparison of the members of groups block against block.

A group of n members is cut into blocks; each pair of blocks is one piece of
work, so that no task holds a whole group and no pair becomes a row of its own:
a pair of blocks returns sums for its members and a spanning forest of its links.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

EDGES = "a binary, b binary"
LINKS = "a binary, b binary, links long"
JUDGED = "a binary, b binary, links long, low int, high int"
_ARROW = {
    EDGES: [("a", pa.binary()), ("b", pa.binary())],
    LINKS: [("a", pa.binary()), ("b", pa.binary()), ("links", pa.int64())],
    JUDGED: [("a", pa.binary()), ("b", pa.binary()), ("links", pa.int64()), ("low", pa.int32()), ("high", pa.int32())],
}


def in_block_pairs(rows: DataFrame, group: str, count: str, block: int, key: str) -> DataFrame:
    """Adds ``pair``: the groups' members cut into blocks of about ``block``, a
    row for each pair of blocks that its own is part of, and ``own``: its block."""
    blocks = F.ceil(F.col(count) / F.lit(block)).cast("int")
    own = F.pmod(F.xxhash64(key), blocks).cast("int")
    return (rows.withColumn("own", own)
            .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
            .withColumn("low", F.least("own", "other")).withColumn("high", F.greatest("own", "other"))
            .drop("other"))


def streamed_groups(frame: DataFrame, by: list[str], schema: str,
                    work: Callable[[dict, dict], Iterator[tuple]], columns: list[str]) -> DataFrame:
    """Rows dealt and sorted by ``by``; ``work(first values of by, columns of the
    group)`` for one group after the other, which need fit memory one at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out_schema = None
        now, held, out = None, None, []

        def flush() -> pa.RecordBatch:
            table = pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], f.type) for i, f in enumerate(out_schema)],
                                               schema=out_schema)
            out.clear()
            return table

        out_schema = pa.schema(_ARROW[schema])
        for batch in batches:
            values = [batch.column(c).to_pylist() for c in by]
            data = [batch.column(c).to_pylist() for c in columns]
            for i, group in enumerate(zip(*values, strict=True)):
                if group != now:
                    if now is not None:
                        out.extend(work(now, held))
                        if len(out) > 10_000:
                            yield flush()
                    now, held = group, [[] for _ in columns]
                for store, column in zip(held, data, strict=True):
                    store.append(column[i])
        if now is not None:
            out.extend(work(now, held))
        yield flush()
    return frame.repartition(*by).sortWithinPartitions(*by).mapInArrow(run, schema)


def forest(n: int, left: np.ndarray, right: np.ndarray) -> Iterator[tuple[int, int]]:
    """A spanning forest of the pairs."""
    parent = list(range(n))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in zip(left.tolist(), right.tolist(), strict=True):
        x, y = root(a), root(b)
        if x != y:
            parent[x] = y
            yield a, b
