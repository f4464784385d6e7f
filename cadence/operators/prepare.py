"""Preparation of the transaction table: active customers, reversals, split by mark.

Scale notes. Both row-level joins here are declared as semi/anti joins on their
natural keys: Spark shuffles the transactions once per join and AQE splits a
skewed partition (a customer with a third of all rows) into several tasks
(``spark.sql.adaptive.skewJoin.enabled``, supported for left semi and left anti
joins). The right-hand sides are distinct key sets, deduplicated map-side by a
partial aggregate before they are shuffled; AQE turns a join into a broadcast
only once the materialised key set is measured below the broadcast threshold.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from cadence.config import DEFAULT_CONFIG, RecurrenceConfig
from cadence.functions.dates import as_date, months_before
from cadence.sources.schema import (
    AMOUNT, COMMERCE, CUSTOMER, DATE, DEBIT_TYPE, MESSAGE_TYPE, OPERATION1, REVERSAL_KEYS,
)


def reference_date(tx: DataFrame, as_of=None) -> Column:
    """The reference date as a column: the given date, or else the last
    operation date of the table as a scalar subquery (evaluated once by Spark
    inside the query, no driver round trip)."""
    if as_of is not None:
        return as_date(as_of)
    return tx.select(F.max(DATE)).scalar()


def recent_customers(tx: DataFrame, as_of: Column,
                     config: RecurrenceConfig = DEFAULT_CONFIG) -> DataFrame:
    """Customers with an operation on or after ``as_of`` minus ``months_back``
    months (later rows count too; there is no upper bound). The date filter
    goes to the scan; the distinct is a partial aggregate before the shuffle."""
    return (tx.where(F.col(DATE) >= months_before(as_of, config.months_back))
              .select(CUSTOMER).distinct())


def recent_customers_counted(tx: DataFrame, as_of: Column, config: RecurrenceConfig = DEFAULT_CONFIG) -> DataFrame:
    """The recent customers with ``rows``, the number of all their rows: one
    aggregate over customer and date, map-side combined."""
    last, rows = F.max(DATE).alias("_last"), F.count(F.lit(1)).alias("rows")
    return (tx.groupBy(CUSTOMER).agg(last, rows)
              .where(F.col("_last") >= months_before(as_of, config.months_back)).drop("_last"))


def active_customers(tx: DataFrame, as_of: Column,
                     config: RecurrenceConfig = DEFAULT_CONFIG) -> DataFrame:
    """All rows of the recent customers."""
    return _of_customers(tx, recent_customers(tx, as_of, config), config)


def _of_customers(rows: DataFrame, recent: DataFrame, config: RecurrenceConfig) -> DataFrame:
    """The rows of the customers. They are spread by all that ``fit`` reads of a row, so
    that what is dealt below has the columns of ``fit`` and Spark can share it."""
    if config.partitions:
        return joined_by_key(rows, recent, [CUSTOMER], [COMMERCE, DEBIT_TYPE, OPERATION1, DATE, AMOUNT], config.partitions)
    return rows.join(recent, CUSTOMER, "left_semi")


# Tasks over which the rows of one key are dealt for a join with a table of keys.
COPIES = 4


def joined_by_key(rows: DataFrame, keyed: DataFrame, keys: list[str], spread: list[str], partitions: int) -> DataFrame:
    """The rows whose ``keys`` are in ``keyed`` (null-safe), with its other columns; it
    has a key once. Both sides are dealt over ``partitions`` by the keys and a hash of the
    columns ``spread``, so that a hot key lies in ``COPIES`` tasks.

    A merge join, and no semi join: Spark's estimate knows nothing of the rows that a
    generator adds, so it may take any side for small enough to broadcast, and it moves a
    semi join below the dealing, to the rows as they are read.
    """
    share = F.pmod(F.xxhash64(*spread), F.lit(COPIES)).cast("int").alias("_share")
    # One type for both sides, nullable fields included, else they would be dealt once more.
    kind = StructType([StructField(k, rows.schema[k].dataType) for k in keys] + [StructField("_share", IntegerType())])
    left = rows.select("*", F.struct(*keys, share).cast(kind).alias("_key")).repartition(partitions, "_key")
    others = [c for c in keyed.columns if c not in keys]
    copies = keyed.select("*", F.explode(F.array(*[F.lit(i) for i in range(COPIES)])).alias("_share"))
    right = copies.select(F.struct(*keys, "_share").cast(kind).alias("_of"), *others).repartition(partitions, "_of")
    return left.join(right.hint("merge"), F.col("_key") == F.col("_of")).select(*rows.columns, *others)


def net_of_reversals(tx: DataFrame, config: RecurrenceConfig = DEFAULT_CONFIG,
                     reversals_from: DataFrame | None = None) -> DataFrame:
    """Drop every group of equal operations (same eight reversal keys) that
    holds a message type at or above the reversal type, original included.

    Message types compare as strings. NULLs in the keys form a group of their
    own, hence the null-safe join. ``reversals_from`` lets the reversal keys be
    read from a wider table (the raw source) so that the filter on message type
    goes straight to the scan; keys of other customers never match.
    """
    source = tx if reversals_from is None else reversals_from
    if config.partitions:
        return _net_by_operation(tx, source, config)
    reversed_keys = (source.where(F.col(MESSAGE_TYPE) >= config.reversal_message_type)
                           .select(*[F.col(k).alias(f"_rev_{k}") for k in REVERSAL_KEYS])
                           .distinct())
    same_operation = reduce(
        lambda a, b: a & b,
        [F.col(k).eqNullSafe(F.col(f"_rev_{k}")) for k in REVERSAL_KEYS],
    )
    return tx.join(reversed_keys, same_operation, "left_anti")


def _net_by_operation(tx: DataFrame, source: DataFrame, config: RecurrenceConfig) -> DataFrame:
    """``net_of_reversals`` over ``config.partitions``: the eight keys travel as one
    struct, whose equality is null-safe field by field, so that both sides can be dealt
    by the very key of the join. A merge join: the reversals grow with the rows, however
    small Spark takes them for. Not an anti join, which Spark would move below the
    dealing, once for each branch of a union; the reversed keys are distinct."""
    operation = F.struct(*REVERSAL_KEYS).alias("_operation")
    reversed_operations = (source.where(F.col(MESSAGE_TYPE) >= config.reversal_message_type)
                           .select(operation).distinct().withColumnRenamed("_operation", "_reversed"))
    others = [c for c in tx.columns if c not in REVERSAL_KEYS]
    kept = (tx.select(operation, *others).repartition(config.partitions, "_operation")
              .join(reversed_operations.repartition(config.partitions, "_reversed").hint("merge"),
                    F.col("_operation") == F.col("_reversed"), "left")
              .where(F.col("_reversed").isNull()))
    return kept.select(*[F.col("_operation")[c].alias(c) if c in REVERSAL_KEYS else F.col(c) for c in tx.columns])


def marked_recurring_daily(net: DataFrame, config: RecurrenceConfig = DEFAULT_CONFIG) -> DataFrame:
    """Payments marked as recurring, summed per customer, commerce and day."""
    return (net.where(F.col(DEBIT_TYPE) == config.marked_debit_type)
               .groupBy(CUSTOMER, COMMERCE, DATE)
               .agg(F.sum(AMOUNT).alias(AMOUNT)))


def not_marked(net: DataFrame, config: RecurrenceConfig = DEFAULT_CONFIG) -> DataFrame:
    """All other payments, row by row. A NULL debit type is in neither half."""
    return (net.where(F.col(DEBIT_TYPE) != config.marked_debit_type)
               .select(CUSTOMER, COMMERCE, AMOUNT, DATE))


def prepared(tx: DataFrame, as_of: Column, config: RecurrenceConfig = DEFAULT_CONFIG,
             reversals_first: bool = False) -> DataFrame:
    """Active customers without reversed operations.

    ``reversals_first`` is for a query that reads ``fit``'s stages beside these rows: the
    customer is one of the reversal keys, so the rows are the same, and the dealing of all
    rows by operation is shared with ``fit``. Read alone, the rows of the active customers
    are fewer to look for reversals in."""
    if reversals_first:
        return _of_customers(net_of_reversals(tx, config), recent_customers(tx, as_of, config), config)
    return net_of_reversals(active_customers(tx, as_of, config), config, reversals_from=tx)
