"""N-gram Jaccard join by a MinHash LSH forest (operator 2).

Texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more
are linked; links chain to classes.

1. *Signatures* (one scan): ``PLACES`` MinHash values a text. Each tree reads them
   in an order of its own (``tree_places``): the values in that order are a text's
   label, a tree's sorted labels are its prefix trie, and the texts that share a
   prefix are a node. Equal texts collapse to one row that counts its copies.
2. *Prefixes*: labels are shortened as far as the nodes they lead to allow. In nodes
   of at most ``NODE_LIMIT`` texts the matched prefix is ``LENGTHS[0]`` long. The texts
   of fuller nodes (a common passage fills some) keep a longer one, the next of
   ``LENGTHS``, and so on; the longest is matched however full its nodes are. The shorter
   the prefix, the fewer trees reach the target recall: every length has as many as it
   needs (``trees_for``). A pair that shares a full node takes both of its texts to the
   next length, so the misses of the lengths add up at most, and the target is divided
   among them: the recall does not depend on the size of the table. A full node
   is first compared with one of its texts; if all are like it (near copies of one
   text), they are joined already and keep no longer prefix.
3. *Candidates*: within a node, block against block, pairs whose whole
   signatures agree in far fewer places than the threshold asks for are dropped;
   of the others only a spanning forest is kept. Its components hold all possible
   links.
4. *Exact verification*: the texts of a component are compared by their whole
   shingle sets, block against block. Each block pair returns the links of each
   text, summed, and a spanning forest, so a group of n near copies gives rows
   in proportion to n, not to its square.
5. The components of the verified links are the classes.

Edge cases: null and empty texts are equal texts; equal texts are linked
whatever their length; a text of one to four words is one shingle; repeated
rows are copies; a null id counts as the smallest id; other columns are not
looked at; an empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache, reduce
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadence.llm.blocks import EDGES, LINKS, forest, in_block_pairs, streamed_groups
from cadence.llm.common import slices, text_key, whole_text, written
from cadence.llm.components import components
from cadence.llm.words import Words

SHINGLE = 5
THRESHOLD = 0.8
PLACES = 96             # values of a signature
LENGTHS = (4, 7, 10)    # of matched prefixes
TARGET_RECALL = 0.9995
NODE_LIMIT = 4000       # texts of a node whose labels are not shortened to it
NODE_BLOCK = 1000       # signatures of one side of a block pair
TEXT_BLOCK = 256        # texts of one side of a block pair
_LEAST_ID = -(1 << 63)
_FACTORS = np.random.default_rng(7).integers(1, 2**31, PLACES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_SHIFTS = np.random.default_rng(8).integers(0, 2**32, PLACES, dtype=np.uint32)


def missed(length: int, trees: int, threshold: float = THRESHOLD) -> float:
    """Share of the pairs at the threshold that agree in no tree's prefix of this
    length. Trees that share no place are independent; of trees that do, each
    prefix is a random choice of places, k of which agree."""
    if length == LENGTHS[0] and length * trees <= PLACES:
        return (1 - threshold ** length) ** trees
    total = 0.0
    for k in range(PLACES + 1):
        weight = comb(PLACES, k) * threshold ** k * (1 - threshold) ** (PLACES - k)
        total += weight * (1 - comb(k, length) / comb(PLACES, length)) ** trees
    return total


@lru_cache
def trees_for(length: int, recall: float = TARGET_RECALL, threshold: float = THRESHOLD) -> int:
    """The fewest trees whose share of the misses is within the target's."""
    most = (1 - recall) / len(LENGTHS)
    return bisect_left(range(1, 1 << 16), -most, key=lambda t: -missed(length, t, threshold)) + 1


def tree_places(tree: int) -> np.ndarray:
    """The places of the signature in the order in which a tree reads them. The
    shortest prefixes of the first trees share no place."""
    order = np.random.default_rng([11, tree]).permutation(PLACES)
    first = np.arange(PLACES)[tree * LENGTHS[0]:(tree + 1) * LENGTHS[0]]
    return np.r_[first, order[~np.isin(order, first)]][:max(LENGTHS)]


def shingles(words: Words, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of all shingles, text after text, and each text's first one."""
    prints = words.fingerprints()
    grams = words.window_fingerprints(prints, width)
    ok = words.window_starts(width)
    counts = words.counts()
    short = np.flatnonzero((counts > 0) & (counts < width))
    for d in short:         # one shingle: all words
        a, b = words.first[d], words.first[d + 1]
        ok[a] = True
        grams[a] = np.bitwise_xor.reduce(prints[a:b] * (np.arange(b - a, dtype=np.uint64) * np.uint64(2) + np.uint64(3)))
    return grams[ok], np.r_[0, np.cumsum(ok)][words.first]


def signatures(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """MinHash values, one row a text; a text without shingles has all ones."""
    n = len(first) - 1
    out = np.full((n, len(_FACTORS)), 0xFFFFFFFF, np.uint32)
    filled = np.flatnonzero(np.diff(first))
    if len(filled):
        low = (values ^ (values >> np.uint64(32))).astype(np.uint32)
        starts = first[filled]
        for j, (factor, shift) in enumerate(zip(_FACTORS, _SHIFTS, strict=True)):
            x = low * factor + shift
            x ^= x >> np.uint32(15)
            out[filled, j] = np.minimum.reduceat(x, starts)
    return out


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text", 1_000_000):
            words = Words(part.column("text"))
            values, first = shingles(words)
            rows = signatures(values, first)
            yield pa.RecordBatch.from_arrays(
                [part.column("key"), part.column("id"), pa.array(np.diff(first)),
                 pa.array([r.astype(">u4").tobytes() for r in rows], pa.binary())],
                names=["key", "id", "size", "signature"])


def _keyed(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    return docs.select(text_key(text_column).alias("key"),
                       F.coalesce(F.col(id_column).cast("long"), F.lit(_LEAST_ID)).alias("id"),
                       whole_text(text_column).alias("text"))


def signed_texts(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row for each different text: key, least id, copies, size, signature."""
    rows = _keyed(docs, id_column, text_column).mapInArrow(_sign, "key binary, id long, size long, signature binary")
    return rows.groupBy("key").agg(
        F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"),
        F.any_value("size").alias("size"), F.any_value("signature").alias("signature"))


# --- candidates -------------------------------------------------------------

def _alike(least_share: float):
    """Spanning forest of the pairs whose signatures agree often enough."""
    def work(group: tuple, held: list) -> Iterator[tuple]:
        keys, own, signs = held
        _, low, high = group
        # Only equality counts, so the bytes need no swap; one row a place.
        places = np.ascontiguousarray(np.frombuffer(b"".join(signs), np.uint32).reshape(len(keys), -1).T)
        own = np.asarray(own)
        left = np.flatnonzero(own == low)
        right = left if low == high else np.flatnonzero(own == high)
        need = least_share * len(places)
        left_places, right_places = places[:, left], places[:, right]
        found_a, found_b = [], []
        for start in range(0, len(left), 64):
            mine = left[start:start + 64]
            agree = np.zeros((len(mine), len(right)), np.uint8)
            for a, b in zip(left_places[:, start:start + 64], right_places, strict=True):
                agree += (a[:, None] == b[None, :]).view(np.uint8)
            x, y = np.nonzero(agree >= need)
            x, y = mine[x], right[y]
            ok = x < y if low == high else x != y
            found_a.append(x[ok])
            found_b.append(y[ok])
        if found_a:
            for a, b in forest(len(keys), np.concatenate(found_a), np.concatenate(found_b)):
                yield keys[a], keys[b]
    return work


def _least_share(threshold: float) -> float:
    """Five standard errors of the estimated similarity below the threshold."""
    return threshold - 5 * (threshold * (1 - threshold) / PLACES) ** 0.5


def labelled(signed: DataFrame, length: int, trees: int) -> DataFrame:
    """(key, node) of each text and tree: the node is a fingerprint of the tree, the
    length and the prefix."""
    places = np.stack([tree_places(t)[:length] for t in range(trees)])
    odd = np.random.default_rng(12).integers(1, 2**63, length, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    seeds = np.random.default_rng([13, length]).integers(1, 2**63, trees, dtype=np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                n = part.num_rows
                values = np.frombuffer(b"".join(part.column("signature").to_pylist()), ">u4").reshape(n, PLACES).astype(np.uint64)
                nodes = np.broadcast_to(seeds, (n, trees)).copy()
                for i in range(length):
                    nodes = (nodes ^ values[:, places[:, i]]) * odd[i]
                    nodes ^= nodes >> np.uint64(29)
                yield pa.RecordBatch.from_arrays(
                    [part.column("key").take(pa.array(np.repeat(np.arange(n), trees))),
                     pa.array(nodes.reshape(-1).view(np.int64))], names=["key", "node"])
    return signed.select("key", "signature").mapInArrow(run, "key binary, node long")


def _compared(met: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Forests of the like pairs of each node, block against block."""
    signed = met.join(texts.select("key", "signature"), "key")
    blocks = in_block_pairs(signed, "node", "n", NODE_BLOCK, "key")
    return streamed_groups(blocks, ["node", "low", "high"], EDGES, _alike(_least_share(threshold)),
                           ["key", "own", "signature"])


def _beside_heads(full: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """(node, head, key, alike): the texts of full nodes beside the node's least text."""
    heads = (full.groupBy("node").agg(F.min("key").alias("head"))
             .join(texts.select(F.col("key").alias("head"), F.col("signature").alias("head_signature")), "head"))
    pairs = full.select("node", "key").join(heads, "node").join(texts.select("key", "signature"), "key")
    need = _least_share(threshold) * PLACES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint32).reshape(-1, PLACES)
                    for c in ("signature", "head_signature"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), batch.column("head"), batch.column("key"), pa.array((a == b).sum(1) >= need)],
                names=["node", "head", "key", "alike"])
    return pairs.mapInArrow(run, "node long, head binary, key binary, alike boolean")


def candidate_edges(texts: DataFrame, threshold: float = THRESHOLD, recall: float = TARGET_RECALL,
                    node_limit: int | None = None) -> DataFrame:
    """Edges (a, b) whose components hold all pairs that may be linked.
    ``texts``: written ``signed_texts``."""
    limit = NODE_LIMIT if node_limit is None else node_limit
    matched = texts.where(F.col("size") > 0)
    edges = []
    for length in LENGTHS:
        labels = labelled(matched, length, trees_for(length, recall, threshold))
        nodes = written(labels.groupBy("node").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= 2), "nodes")
        met = written(labels.join(nodes, "node"), "met")
        if length == max(LENGTHS):
            edges.append(_compared(met, texts, threshold))
            break
        edges.append(_compared(met.where(F.col("n") <= limit), texts, threshold))
        if nodes.where(F.col("n") > limit).isEmpty():
            break
        beside = written(_beside_heads(met.where(F.col("n") > limit), texts, threshold), "beside")
        edges.append(beside.where(F.col("alike") & (F.col("key") != F.col("head")))
                     .select(F.col("head").alias("a"), F.col("key").alias("b")))
        mixed = beside.where(~F.col("alike")).select("node").distinct()
        keys = beside.join(mixed, "node", "left_semi").select("key").distinct()
        matched = written(texts.select("key", "signature").join(keys, "key"), "matched")
        if matched.isEmpty():
            break
    return reduce(DataFrame.unionByName, edges)


# --- verification -----------------------------------------------------------

def overlaps(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the left with the right sets, as products
    of their incidence matrices over shingles found in two sets or more."""
    used = np.union1d(left, right)
    joined = np.concatenate([sets[i] for i in used]) if len(used) else np.zeros(0, np.uint64)
    owner = np.repeat(used, [len(sets[i]) for i in used])
    vocabulary, place, times = np.unique(joined, return_inverse=True, return_counts=True)
    shared = times[place] > 1
    number = np.cumsum(times > 1) - 1
    column, owner = number[place[shared]], owner[shared]
    out = np.zeros((len(left), len(right)), np.float32)
    at = {int(i): k for k, i in enumerate(left)}, {int(i): k for k, i in enumerate(right)}
    rows = [np.array([m.get(int(i), -1) for i in range(len(sets))]) for m in at]
    total, step = int((times > 1).sum()), 8192
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    for start in range(0, total, step):
        a, b = np.searchsorted(column, [start, start + step])
        c, o = column[a:b] - start, owner[a:b]
        sides = []
        for row, n in zip(rows, (len(left), len(right)), strict=True):
            ok = row[o] >= 0
            matrix = np.zeros((n, min(step, total - start)), np.float32)
            matrix[row[o[ok]], c[ok]] = 1
            sides.append(matrix)
        out += sides[0] @ sides[1].T
    return out


def _verify(threshold: float):
    def work(group: tuple, held: list) -> Iterator[tuple]:
        keys, copies, own, texts = held
        _, low, high = group
        words = Words(pa.array(texts, pa.large_string()))
        values, first = shingles(words)
        sets = [np.unique(values[a:b]) for a, b in zip(first[:-1], first[1:], strict=True)]
        size = np.array([len(s) for s in sets])
        own, copies = np.asarray(own), np.asarray(copies)
        left = np.flatnonzero(own == low)
        right = left if low == high else np.flatnonzero(own == high)
        both = overlaps(sets, left, right).astype(np.int64)
        either = size[left][:, None] + size[right][None, :] - both
        linked = both / np.maximum(either, 1) >= threshold
        if low == high:
            np.fill_diagonal(linked, False)
        links = np.zeros(len(keys), np.int64)
        links[left] += linked @ copies[right]
        if low != high:
            links[right] += linked.T @ copies[left]
        x, y = np.nonzero(np.triu(linked) if low == high else linked)
        for a, b in forest(len(keys), left[x], right[y]):
            yield keys[a], keys[b], None
        for i in np.flatnonzero(links):
            yield keys[i], None, int(links[i])
    return work


def verified_links(docs: DataFrame, texts: DataFrame, edges: DataFrame, id_column: str = "doc_id",
                   text_column: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Rows (a, b, null) of a spanning forest of the links between different
    texts, and rows (a, null, links) to be summed for each text."""
    groups = written(components(edges), "candidate-groups")
    sizes = written(groups.groupBy("root").agg(F.count(F.lit(1)).alias("n")), "candidate-sizes")
    members = (groups.join(sizes, "root").withColumnRenamed("node", "key")
               .join(texts.select("key", "id", "copies"), "key"))
    held = (_keyed(docs, id_column, text_column).join(members, ["key", "id"]).groupBy("key", "id")
            .agg(*[F.any_value(c).alias(c) for c in ("text", "root", "n", "copies")]))
    blocks = in_block_pairs(held, "root", "n", TEXT_BLOCK, "key")
    return streamed_groups(blocks, ["root", "low", "high"], LINKS, _verify(threshold),
                           ["key", "copies", "own", "text"])


def classes(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
            threshold: float = THRESHOLD) -> DataFrame:
    """One row for each different text: key, id (least id with this text),
    class_id (least id of its class), class_key (a text of the class with that
    id), n_links (rows linked to each row with this text)."""
    texts = written(signed_texts(docs, id_column, text_column), "signed")
    edges = written(candidate_edges(texts, threshold), "candidates")
    links = written(verified_links(docs, texts, edges, id_column, text_column, threshold), "links")
    roots = written(components(links.where(F.col("b").isNotNull()).select("a", "b")), "roots")
    sums = links.where(F.col("b").isNull()).groupBy(F.col("a").alias("key")).agg(F.sum("links").alias("links"))
    known = (texts.select("key", "id", "copies").join(roots.withColumnRenamed("node", "key"), "key", "left")
             .join(sums, "key", "left")
             .select("key", "id", F.coalesce("root", "key").alias("root"),
                     (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).cast("long").alias("n_links")))
    known = written(known, "known")
    heads = written(known.groupBy("root").agg(F.min(F.struct("id", "key")).alias("head")), "heads")
    return written(known.join(heads, "root").select(
        "key", "id", F.col("head.id").alias("class_id"), F.col("head.key").alias("class_key"), "n_links"), "classes")


def _id_or_null(column: Column) -> Column:
    return F.when(column != _LEAST_ID, column)


def join_report(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row for each row of ``docs``: id, class_id (least id of its class),
    n_links (other rows whose text is linked to its own or equal to it), kept
    (true where the row's id is the class id and its text the class's text)."""
    found = classes(docs, id_column, text_column).select(F.col("key").alias("__key"), "class_id", "class_key", "n_links")
    rows = docs.select(F.col(id_column), text_key(text_column).alias("__key"))
    own = F.coalesce(F.col(id_column).cast("long"), F.lit(_LEAST_ID))
    return rows.join(found, "__key").select(
        id_column, _id_or_null(F.col("class_id")).alias("class_id"), "n_links",
        ((own == F.col("class_id")) & (F.col("__key") == F.col("class_key"))).alias("kept"))


def one_of_each(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row, with all its columns, of each class."""
    heads = (classes(docs, id_column, text_column)
             .where((F.col("key") == F.col("class_key")) & (F.col("id") == F.col("class_id")))
             .select(F.col("key").alias("__key"), F.col("id").alias("__id")))
    rows = docs.select(text_key(text_column).alias("__key"),
                       F.coalesce(F.col(id_column).cast("long"), F.lit(_LEAST_ID)).alias("__id"),
                       F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"))
    # Rows repeated as a whole share id and text; one of them stays.
    one = rows.join(heads, ["__key", "__id"]).groupBy("__key", "__id").agg(F.any_value("__row").alias("__row"))
    return one.select(*[F.col("__row")[c].alias(c) for c in docs.columns])
