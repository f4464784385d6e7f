"""Near-duplicate embeddings by quantised tile products (operator 9).

Vectors with equal labels whose cosine in double precision reaches the
threshold are linked; links chain to components.

1. Equal vectors of a label collapse to one that counts its copies.
2. A vector is scaled to length 1 and quantised to int8; the norm of what the
   rounding leaves is its error. For u = a + e and v = b + f with quantised
   parts a and b,  |u.v - a.b| <= |a||f| + |e||b| + |e||f|,  which is rigorous.
3. The vectors of a label are cut into tiles; a pair of tiles is one matrix
   product of int8 values (exact in float32 up to ``EXACT_DIMENSIONS`` products,
   longer vectors are summed in parts).
4. Pairs whose product plus bound reaches the threshold are linked where product
   minus bound does so too; the others of them are computed again, in double
   precision from the given components, which decides. The doubles move only for
   vectors in such pairs; to all tile pairs go codes and bounds.
5. Each pair of tiles returns summed link counts and a spanning forest.

All pairs of a label are compared, as asked; the work is quadratic in a label's
different vectors, the rows that move grow with their number times the tiles.

Edge cases: a vector that is null, zero or empty, holds null or non-finite
components, or has no label links with nothing; vectors of different length are
not compared; equal ids and repeated rows are vectors of their own; a null id
is no candidate for the smallest id; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadence.llm.blocks import JUDGED, LINKS, in_block_pairs, streamed_groups
from cadence.llm.common import written
from cadence.llm.components import components

THRESHOLD = 0.93
TILE = 4096
EXACT_DIMENSIONS = 1 << 24 >> 14        # 127 * 127 * this < 2 ** 24
_SLACK = 1e-9       # for rounding in the bound itself


def _usable() -> Column:
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite
            & F.exists("embedding", lambda x: x != 0))


def _keyed(vectors: DataFrame, id_column: str, vector_column: str, label_column: str) -> DataFrame:
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(label_column).cast("string").alias("label"),
                          F.col(vector_column).cast("array<double>").alias("embedding"))
    # A vector that links with nothing gets a key that no other kind of row has.
    own = F.concat(F.lit("-"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    text = F.concat_ws("|", "label", F.col("embedding").cast("string"))
    rows = rows.withColumn("usable", F.coalesce(_usable(), F.lit(False)))
    return rows.withColumn("key", F.when(F.col("usable"), F.unhex(F.md5(text))).otherwise(own.cast("binary")))


QUANTISED = "key binary, label string, dimensions int, copies long, scale double, norm double, error double, codes binary, exact binary"


def quantised(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(codes, scale, norm of the quantised part, norm of the error) of each row."""
    scale = np.abs(unit).max(1) / 127
    codes = np.rint(unit / scale[:, None]).astype(np.int8)
    near = codes * scale[:, None]
    return codes, scale, np.linalg.norm(near, axis=1), np.linalg.norm(unit - near, axis=1)


def _unit(rows: np.ndarray) -> np.ndarray:
    rows = rows / np.abs(rows).max(1, keepdims=True)        # no overflow in the norm
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _quantise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        vectors = batch.column("embedding")
        lengths = np.asarray(vectors.value_lengths())
        for n in np.unique(lengths).tolist():
            part = batch.filter(pa.array(lengths == n))
            rows = np.asarray(part.column("embedding").flatten()).reshape(-1, n)
            codes, scale, norm, error = quantised(_unit(rows))
            yield pa.RecordBatch.from_arrays(
                [part.column("key"), part.column("label"), pa.array(np.full(len(rows), n, np.int32)), part.column("copies"),
                 pa.array(scale), pa.array(norm), pa.array(error), pa.array([c.tobytes() for c in codes], pa.binary()),
                 pa.array([r.astype("<f8").tobytes() for r in rows], pa.binary())],
                names=[c.split()[0] for c in QUANTISED.split(", ")])


def different_vectors(rows: DataFrame) -> DataFrame:
    """One quantised row for each different vector of a label."""
    found = (rows.where("usable").groupBy("key")
             .agg(F.any_value("label").alias("label"), F.any_value("embedding").alias("embedding"),
                  F.count(F.lit(1)).alias("copies")))
    return found.mapInArrow(_quantise, QUANTISED)


def tile_products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact products of int8 rows."""
    out = np.zeros((len(left), len(right)))
    for at in range(0, left.shape[1], EXACT_DIMENSIONS):
        cut = slice(at, at + EXACT_DIMENSIONS)
        out += left[:, cut].astype(np.float32) @ right[:, cut].astype(np.float32).T
    return out


class _Tiles:
    """The vectors of a pair of tiles, without their doubles."""

    def __init__(self, dimensions: int, low: int, high: int, keys: list, own: list, copies: list, scale: list, norm: list,
                 error: list, codes: list):
        self.keys, own, self.copies = keys, np.asarray(own), np.asarray(copies)
        self.scale, self.norm, self.error = np.asarray(scale), np.asarray(norm), np.asarray(error)
        self.codes = np.frombuffer(b"".join(codes), np.int8).reshape(-1, dimensions)
        self.left = np.flatnonzero(own == low)
        self.right = self.left if low == high else np.flatnonzero(own == high)
        self.same = low == high
        self.counts = np.zeros(len(keys), np.int64)
        self.group = np.arange(len(keys))
        self.tree: list[tuple[int, int]] = []

    def judged(self, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(vectors of the left tile, whether each pair with the right one is surely
        linked, whether it is possibly linked), a few hundred vectors at a time."""
        for at in range(0, len(self.left), 256):
            mine, right = self.left[at:at + 256], self.right
            near = tile_products(self.codes[mine], self.codes[right]) * self.scale[mine][:, None] * self.scale[right][None, :]
            most = (self.norm[mine][:, None] * self.error[right][None, :] + self.error[mine][:, None] * self.norm[right][None, :]
                    + self.error[mine][:, None] * self.error[right][None, :])
            counted = mine[:, None] < right[None, :] if self.same else np.ones(near.shape, bool)
            sure = (near - most >= threshold + _SLACK) & counted
            yield mine, sure, (near + most >= threshold - _SLACK) & counted & ~sure

    def link(self, one: int, others: np.ndarray) -> None:
        """Counts the links of a vector and keeps those that join two groups."""
        self.counts[one] += self.copies[others].sum()
        self.counts[others] += self.copies[one]
        others = others[self.group[others] != self.group[one]]
        if len(others):
            labels, first = np.unique(self.group[others], return_index=True)
            self.group[np.isin(self.group, labels)] = self.group[one]
            self.tree += [(one, int(other)) for other in others[first]]

    def result(self) -> Iterator[tuple]:
        for a, b in self.tree:
            yield self.keys[a], self.keys[b], None
        for i in np.flatnonzero(self.counts):
            yield self.keys[i], None, int(self.counts[i])


def _sure(threshold: float):
    """Links that the bound decides; a row (key, null, null) for each vector of a
    pair that it does not."""
    def work(group: tuple, held: list) -> Iterator[tuple]:
        _, dimensions, low, high = group
        tiles = _Tiles(dimensions, low, high, *held)
        open_ = np.zeros(len(tiles.keys), bool)
        for mine, sure, possible in tiles.judged(threshold):
            for i in np.flatnonzero(sure.any(1)):
                tiles.link(int(mine[i]), tiles.right[sure[i]])
            open_[mine[possible.any(1)]] = True
            open_[tiles.right[possible.any(0)]] = True
        for a, b, links in tiles.result():
            yield a, b, links, low, high
        for i in np.flatnonzero(open_):
            yield tiles.keys[i], None, None, low, high
    return work


def _possible(threshold: float):
    """Links among the pairs that the bound does not decide, in double precision."""
    def work(group: tuple, held: list) -> Iterator[tuple]:
        _, dimensions, low, high = group
        tiles = _Tiles(dimensions, low, high, *held[:-1])
        rows = _unit(np.frombuffer(b"".join(held[-1]), "<f8").reshape(-1, dimensions))
        for mine, _, possible in tiles.judged(threshold):
            for i in np.flatnonzero(possible.any(1)):
                others = tiles.right[possible[i]]
                others = others[rows[others] @ rows[mine[i]] >= threshold]
                if len(others):
                    tiles.link(int(mine[i]), others)
        yield from tiles.result()
    return work


_CODED = ["key", "own", "copies", "scale", "norm", "error", "codes"]
_TILE = ["label", "dimensions", "low", "high"]


def links(different: DataFrame, threshold: float = THRESHOLD, tile: int = TILE) -> DataFrame:
    """Rows (a, b, null) of a spanning forest of the links, and rows (a, null,
    links) to be summed. ``different``: written ``different_vectors``. Codes and
    bounds go to the tile pairs; doubles only of vectors in pairs still open."""
    sizes = different.groupBy("label", "dimensions").agg(F.count(F.lit(1)).alias("n"))
    coded = different.drop("exact").join(sizes, ["label", "dimensions"])
    first = written(streamed_groups(in_block_pairs(coded, "label", "n", tile, "key"), _TILE, JUDGED, _sure(threshold), _CODED), "sure")
    still = first.where(F.col("b").isNull() & F.col("links").isNull()).select(F.col("a").alias("key"), "low", "high")
    blocks = F.ceil(F.col("n") / F.lit(tile)).cast("int")
    whole = different.join(sizes, ["label", "dimensions"]).withColumn("own", F.pmod(F.xxhash64("key"), blocks).cast("int"))
    second = streamed_groups(still.join(whole, "key"), _TILE, LINKS, _possible(threshold), [*_CODED, "exact"])
    decided = first.where(F.col("b").isNotNull() | F.col("links").isNotNull()).select("a", "b", "links")
    return decided.unionByName(second)


def near_duplicates(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding",
                    label_column: str = "label", threshold: float = THRESHOLD) -> DataFrame:
    """One row for each vector: id, n_links, component_id (least id reachable),
    kept (the id is the component's)."""
    rows = _keyed(vectors, id_column, vector_column, label_column)
    different = written(different_vectors(rows), "vectors")
    found = written(links(different, threshold), "links")
    roots = written(components(found.where(F.col("b").isNotNull()).select("a", "b")).withColumnRenamed("node", "key"), "roots")
    sums = found.where(F.col("b").isNull()).groupBy(F.col("a").alias("key")).agg(F.sum("links").alias("links"))
    ids = (rows.groupBy("key").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("copies"),
                                   F.any_value("usable").alias("usable")))
    known = written(ids.join(roots, "key", "left").join(sums, "key", "left").select(
        "key", F.coalesce("root", "key").alias("root"), "least", "usable",
        F.when(F.col("usable"), F.col("copies") - 1 + F.coalesce("links", F.lit(0))).otherwise(F.lit(0)).cast("long").alias("n_links")),
        "known")
    heads = known.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = written(known.join(heads, "root").select("key", "n_links", "component_id"), "classes")
    return rows.join(classes, "key").select(
        F.col("id").alias(id_column), "n_links",
        F.when(F.col("usable"), F.col("component_id")).otherwise(F.col("id")).alias("component_id"),
        F.coalesce(~F.col("usable") | (F.col("id") == F.col("component_id")), F.lit(False)).alias("kept"))
