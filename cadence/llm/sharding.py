"""Sharding by extendible hashing (operator 6).

A row's address is a string of hash bits. The directory starts as one bucket;
only a bucket over the byte limit is split, on the next bit, until every shard
fits. So a shard is a bit prefix, its length the bucket's local depth, and more
data split only the shards that grow over the limit.

The splits are decided on counts, not on rows: bytes are summed by the next
``STEP`` bits in one aggregate, the sums are rolled up to all shorter prefixes,
and each cell takes the shortest prefix that fits. Cells that do not fit go on
with the next ``STEP`` bits. The first bits hash the key, so equal keys stay
together while they fit; the bits after hash the row's number as well, so a key
that holds a large part of all rows is split like any other bucket.

A row weighs the bytes of its text and ``ROW_BYTES`` for its other columns, so
rows without a text fill shards as well.

Edge cases: a null text has no bytes; a row that alone is over the limit is a
shard of its own; null and shared keys and repeated rows are rows like any other;
other columns are kept by ``write_shards`` and else not looked at; an empty table
gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadence.llm.common import whole_text, written

LIMIT = 64 << 20
STEP = 20
ROW_BYTES = 64
ROUNDS = 5      # of STEP bits: the first two hash the key, the others the row


def _segment(round_: int) -> Column:
    """The ``STEP`` address bits of a round, as an integer."""
    word = F.xxhash64("id") if round_ < 2 else F.xxhash64("id", "row")
    return F.shiftrightunsigned(word, 64 - STEP * (round_ % 3 + 1)).bitwiseAND(F.lit((1 << STEP) - 1))


def _bits(value: Column, depth: Column) -> Column:
    """The first ``depth`` of the ``STEP`` bits of a value, as text."""
    return F.substring(F.lpad(F.bin(value), STEP, "0"), F.lit(1), depth)


def _directory(cells: DataFrame, limit: int) -> DataFrame:
    """(prefix, cell, depth, shard_bytes, shard_docs): for each cell the shortest
    prefix that fits; depth is null where none does."""
    prefixes = cells.select("*", F.explode(F.sequence(F.lit(0), F.lit(STEP))).alias("depth")).select(
        "*", F.expr(f"shiftright(cell, {STEP} - depth)").alias("head"))
    sums = (prefixes.groupBy("prefix", "depth", "head")
            .agg(F.sum("bytes").alias("shard_bytes"), F.sum("docs").alias("shard_docs"))
            .where((F.col("shard_bytes") <= limit) | (F.col("shard_docs") == 1)))
    fits = prefixes.join(sums, ["prefix", "depth", "head"]).groupBy("prefix", "cell").agg(
        F.min(F.struct("depth", "shard_bytes", "shard_docs")).alias("best"))
    return (cells.select("prefix", "cell").join(fits, ["prefix", "cell"], "left")
            .select("prefix", "cell", "best.depth", "best.shard_bytes", "best.shard_docs"))


def assigned(rows: DataFrame, limit: int = LIMIT) -> DataFrame:
    """``rows`` (id, row, bytes) with shard, depth, shard_bytes and shard_docs.
    ``row`` numbers the rows; ``rows`` is read once a round, so it is written."""
    left = written(rows.withColumn("prefix", F.lit("")), "rows")
    done = None
    for round_ in range(ROUNDS):
        celled = left.withColumn("cell", _segment(round_))
        cells = celled.groupBy("prefix", "cell").agg(F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("docs"))
        directory = written(_directory(cells, limit), "directory")
        placed = celled.join(directory, ["prefix", "cell"])
        fit = placed.where(F.col("depth").isNotNull()).select(
            "id", "row", "bytes", F.concat("prefix", _bits(F.col("cell"), F.col("depth"))).alias("shard"),
            (F.length("prefix") + F.col("depth")).alias("depth"), "shard_bytes", "shard_docs")
        done = fit if done is None else done.unionByName(fit)
        if directory.where(F.col("depth").isNull()).limit(1).count() == 0:
            return done
        left = written(placed.where(F.col("depth").isNull()).select(
            "id", "row", "bytes", F.concat("prefix", _bits(F.col("cell"), F.lit(STEP))).alias("prefix")), "rows")
    raise RuntimeError("equal addresses over all bits")


def row_weight(text_column: str) -> Column:
    return (F.octet_length(whole_text(text_column)) + F.lit(ROW_BYTES)).cast("long")


def _numbered(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    return docs.select(F.col(id_column).alias("id"), F.monotonically_increasing_id().alias("row"),
                       row_weight(text_column).alias("bytes"))


def shard_report(docs: DataFrame, limit: int = LIMIT, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row for each row: id, n_bytes (its weight), shard (bits), depth,
    shard_bytes, shard_docs."""
    return assigned(_numbered(docs, id_column, text_column), limit).select(
        F.col("id").alias(id_column), F.col("bytes").alias("n_bytes"), "shard", F.col("depth").cast("int").alias("depth"),
        "shard_bytes", "shard_docs")


def write_shards(docs: DataFrame, path: str, limit: int = LIMIT, id_column: str = "doc_id", text_column: str = "text") -> None:
    """Writes the rows, with all their columns, to one folder a shard
    (``shard=b...``). Row numbers must be the same in two reads, so the rows are
    numbered once and written."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    held = written(docs.select(row.alias("doc"), F.col(id_column).alias("id"), F.monotonically_increasing_id().alias("row"),
                               row_weight(text_column).alias("bytes")), "numbered")
    shards = written(assigned(held.select("id", "row", "bytes"), limit).select("row", "shard"), "shards")
    out = held.join(shards, "row").select(F.concat(F.lit("b"), "shard").alias("shard"), "doc")
    out.repartition("shard").write.partitionBy("shard").parquet(path)
