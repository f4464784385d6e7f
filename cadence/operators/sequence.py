"""Payment patterns and the sequence variables of each payment.

A *pattern* is a group of payments that may recur: marked payments with the
same customer, commerce and day-summed amount (scope AMOUNT), or all remaining
payments of a customer at a commerce (scope COMMERCE). Instead of splitting the
rows into complementary tables and unioning them again, every payment carries
its pattern key ``(customer, commerce, scope, pattern_amount)``.

Scale notes. No window runs over raw payments. Identical payments collapse
into counted blocks first, and blocks of very many copies are cut into chunks.
Sequence positions are a two-pass prefix count (``numbered``): blocks are dealt by
ranges of (keys, order), written, counted per range, and the counts before a
range are added to the positions in it. So a pattern, or one day of it, with a
third of all rows lies in many ranges, whatever its keys and amounts are.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadence.config import DEFAULT_CONFIG, RecurrenceConfig
from cadence.sources.schema import (
    AMOUNT, COMMERCE, CUSTOMER, DATE, DAY_MONTH, DEBIT_TYPE, DIFFERENCE_OF_DAYS, MARKED, WEIGHT, NU_PAYMENTS, OPERATION1, ORDER,
    ORDER_DESC, PAIR_KEYS, PATTERN_AMOUNT, PAYMENT_COLUMNS, PREVIOUS_AMOUNT, SCOPE,
    SCOPE_AMOUNT, SCOPE_COMMERCE, TRIPLE_KEYS,
)
from cadence.storage import written


DAY_PAYMENTS = "day_payments"
DAY_AMOUNT = "day_amount"
RAW_ROWS = "raw_rows"
NO_SCOPE = "NONE"


def null_safe_on(keys: list[str], prefix: str):
    """Join condition ``key <=> prefix+key`` over all keys."""
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(prefix + k)) for k in keys])


def scoped_payments(marked_daily: DataFrame, other: DataFrame,
                    config: RecurrenceConfig = DEFAULT_CONFIG) -> DataFrame:
    """All payments with their pattern key.

    A marked day-sum belongs to an AMOUNT pattern when its customer, commerce
    and amount occur on more than two days; otherwise, like every unmarked
    payment, to the COMMERCE pattern of its customer and commerce. The window
    counts day-sums, so it holds at most one row per calendar day.
    """
    same_amount = Window.partitionBy(*TRIPLE_KEYS)
    in_amount_scope = F.count(F.lit(1)).over(same_amount) >= config.min_payments
    marked = marked_daily.select(
        *PAYMENT_COLUMNS,
        F.when(in_amount_scope, F.lit(SCOPE_AMOUNT)).otherwise(F.lit(SCOPE_COMMERCE)).alias(SCOPE),
        F.when(in_amount_scope, F.col(AMOUNT)).alias(PATTERN_AMOUNT),
        F.lit(True).alias(MARKED),
    )
    amount_type = marked.schema[PATTERN_AMOUNT].dataType
    rest = other.select(
        *PAYMENT_COLUMNS,
        F.lit(SCOPE_COMMERCE).alias(SCOPE),
        F.lit(None).cast(amount_type).alias(PATTERN_AMOUNT),
        F.lit(False).alias(MARKED),
    )
    return marked.unionByName(rest)


# Tasks over which the rows of one customer and commerce are dealt.
SALTS = 16
SALT = "_salt"


def dealt_by_pair(rows: DataFrame, partitions: int) -> DataFrame:
    """The rows dealt over ``partitions`` by customer, commerce and a salt of the
    operation, so that a hot pair, or one day of it, lies in ``SALTS`` tasks. Groups
    of a salt need no further shuffle; the groups of all salts are merged after."""
    salt = F.pmod(F.xxhash64(DATE, OPERATION1, AMOUNT), F.lit(SALTS)).cast("int")
    return rows.withColumn(SALT, salt).repartition(partitions, CUSTOMER, COMMERCE, SALT)


def payment_blocks(net: DataFrame, config: RecurrenceConfig = DEFAULT_CONFIG) -> DataFrame:
    """All payments with their pattern key, as counted blocks, from one
    aggregate over the rows (one scan, one shuffle, map-side combine).

    A marked group (customer, commerce, day) is one payment: the day-sum of the
    marked rows. An unmarked group (customer, commerce, day, amount) is a block
    of identical payments, ``payments`` of them. Rows with a NULL debit type are
    in neither half. Scope as in ``scoped_payments``: the window counts marked
    day-sums per amount, at most one per calendar day.
    """
    is_marked = F.col(DEBIT_TYPE) == config.marked_debit_type
    payments = net.where(F.col(DEBIT_TYPE).isNotNull())
    keys = [CUSTOMER, COMMERCE, DATE, is_marked.alias(MARKED), F.when(~is_marked, F.col(AMOUNT)).alias("_block_amount")]
    measures = [F.sum(AMOUNT).alias("_day_sum"), F.count(F.lit(1)).alias("_rows")]
    if config.partitions:
        # Dealt for the window as well: it looks at marked groups, which have no block amount,
        # and an unmarked group's amount is its block amount.
        groups = (dealt_by_pair(payments, config.partitions).groupBy(*keys, SALT).agg(*measures)
                  .repartition(config.partitions, CUSTOMER, COMMERCE, MARKED, "_block_amount")
                  .groupBy(CUSTOMER, COMMERCE, DATE, MARKED, "_block_amount")
                  .agg(F.sum("_day_sum").cast(_sum_type(net)).alias("_day_sum"), F.sum("_rows").alias("_rows")))
    else:
        groups = payments.groupBy(*keys).agg(*measures)
    marked = F.col(MARKED)
    blocks = groups.select(
        CUSTOMER, COMMERCE, DATE, MARKED, "_block_amount",
        F.when(marked, F.col("_day_sum")).otherwise(F.col("_block_amount")).alias(AMOUNT),
        F.when(marked, F.lit(1).cast("long")).otherwise(F.col("_rows")).alias(WEIGHT),
    )
    dealt = ["_block_amount"] if config.partitions else []
    same_amount = Window.partitionBy(CUSTOMER, COMMERCE, MARKED, *dealt, AMOUNT)
    in_amount_scope = marked & (F.count(F.lit(1)).over(same_amount) >= config.min_payments)
    return blocks.select(
        CUSTOMER, COMMERCE, AMOUNT, DATE,
        F.when(in_amount_scope, F.lit(SCOPE_AMOUNT)).otherwise(F.lit(SCOPE_COMMERCE)).alias(SCOPE),
        F.when(in_amount_scope, F.col(AMOUNT)).alias(PATTERN_AMOUNT),
        MARKED, WEIGHT,
    )


def _sum_type(rows: DataFrame):
    """Type of a sum of the rows' amounts."""
    return rows.select(F.sum(AMOUNT).alias(AMOUNT)).schema[AMOUNT].dataType


def _merged_salts(groups: DataFrame, sum_type) -> DataFrame:
    """The day groups of all salts in one: second moments within a salt, and those of
    the salts' means (``SALTS`` at most) around the mean of the day."""
    part = F.when(F.col("_f_n") > 0, F.struct("_f_n", "_f_sum", (F.col("_f_var") * F.col("_f_n")).alias("_m2")))
    merged = groups.groupBy(CUSTOMER, COMMERCE, DATE, MARKED).agg(
        F.sum(DAY_AMOUNT).cast(sum_type).alias(DAY_AMOUNT), F.sum("_rows").alias("_rows"), F.sum("_f_n").alias("_f_n"),
        F.sum("_f_sum").alias("_f_sum"), F.max("_f_max").alias("_f_max"), F.min("_f_min").alias("_f_min"),
        F.collect_list(part).alias("_parts"))
    mean = F.try_divide("_f_sum", F.col("_f_n").cast("double"))

    def share(p):
        apart = p["_f_sum"] / p["_f_n"] - mean
        return p["_m2"] + p["_f_n"] * apart * apart

    m2 = F.aggregate("_parts", F.lit(0.0), lambda a, p: a + share(p))
    return merged.withColumn("_f_var", F.when(F.size("_parts") == 1, F.col("_parts")[0]["_m2"]).otherwise(m2) / F.nullif(F.col("_f_n"), F.lit(0))).drop("_parts")


def day_groups(net: DataFrame, config: RecurrenceConfig = DEFAULT_CONFIG, untyped: bool = False) -> DataFrame:
    """One row per customer, commerce, day and mark, with the pattern key. With
    ``untyped`` also the groups of rows without a debit type, which are no payments
    (scope ``NO_SCOPE``); ``raw_rows`` counts the rows of any group.

    One aggregate over the rows with map-side combine; all measures merge, so a
    day with very many payments is no window and no list. A marked group is one
    payment, the day-sum; an unmarked group keeps the moments of its amounts at
    the model's 32-bit precision. The groups are then dealt by customer and
    commerce, which serves the scope window here and every later step of
    ``patterns``; a pair has two rows a day at most.
    """
    is_marked = F.col(DEBIT_TYPE) == config.marked_debit_type
    f = F.col(AMOUNT).cast("float").cast("double")
    rows = net if untyped else net.where(F.col(DEBIT_TYPE).isNotNull())
    keys = [CUSTOMER, COMMERCE, DATE, is_marked.alias(MARKED)]
    measures = [F.sum(AMOUNT).alias(DAY_AMOUNT), F.count(F.lit(1)).alias("_rows"), F.count(AMOUNT).alias("_f_n"),
                F.sum(f).alias("_f_sum"), F.var_pop(f).alias("_f_var"), F.max(f).alias("_f_max"), F.min(f).alias("_f_min")]
    if config.partitions:
        salted = dealt_by_pair(rows, config.partitions).groupBy(*keys, SALT).agg(*measures)
        groups = _merged_salts(salted.repartition(config.partitions, CUSTOMER, COMMERCE), _sum_type(net))
    else:
        groups = rows.groupBy(*keys).agg(*measures).repartition(CUSTOMER, COMMERCE)
    marked = F.col(MARKED)
    day_sum = F.col(DAY_AMOUNT).cast("float").cast("double")
    known = F.when(F.col(DAY_AMOUNT).isNotNull(), F.lit(1)).otherwise(F.lit(0)).cast("long")
    same_amount = Window.partitionBy(CUSTOMER, COMMERCE, MARKED, DAY_AMOUNT)
    in_amount_scope = marked & (F.count(F.lit(1)).over(same_amount) >= config.min_payments)
    scope = F.when(in_amount_scope, F.lit(SCOPE_AMOUNT)).otherwise(F.lit(SCOPE_COMMERCE))
    if untyped:
        scope = F.when(marked.isNull(), F.lit(NO_SCOPE)).otherwise(scope)
    return groups.select(
        CUSTOMER, COMMERCE, DATE, MARKED, DAY_AMOUNT,
        scope.alias(SCOPE),
        F.when(in_amount_scope, F.col(DAY_AMOUNT)).alias(PATTERN_AMOUNT),
        F.when(marked, F.lit(1)).when(marked.isNull(), F.lit(0)).otherwise(F.col("_rows")).cast("long").alias(DAY_PAYMENTS),
        F.col("_rows").alias(RAW_ROWS),
        F.when(marked, known).otherwise(F.col("_f_n")).alias("_f_n"),
        F.when(marked, day_sum).otherwise(F.col("_f_sum")).alias("_f_sum"),
        F.when(marked, F.lit(0.0)).otherwise(F.col("_f_var") * F.col("_f_n")).alias("_f_m2"),
        F.when(marked, day_sum).otherwise(F.col("_f_max")).alias("_f_max"),
        F.when(marked, day_sum).otherwise(F.col("_f_min")).alias("_f_min"),
    )


def commerce_scope(payments: DataFrame) -> DataFrame:
    """The rows looked at per customer and commerce: unmarked payments plus
    marked day-sums that are not an AMOUNT pattern. Blocks keep their count."""
    counted = [WEIGHT] if WEIGHT in payments.columns else []
    return payments.where(F.col(SCOPE) == SCOPE_COMMERCE).select(*PAYMENT_COLUMNS, *counted)


# Copies of a payment that one row stands for at most, before it is expanded.
CHUNK = 512


def in_chunks(blocks: DataFrame, count: str) -> DataFrame:
    """Blocks cut into chunks of at most ``CHUNK`` copies, numbered ``_chunk``."""
    chunk = F.col("_chunk")
    return (blocks.withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col(count) - 1) / CHUNK))))
            .withColumn(count, F.least(F.lit(CHUNK).cast("long"), F.col(count) - chunk * CHUNK)))


def expanded(blocks: DataFrame, count: str) -> DataFrame:
    """One row per copy of each block or chunk, numbered ``_i`` = 1..``count``."""
    return blocks.select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col(count))).alias("_i"))


def numbered(blocks: DataFrame, keys: list[str], order: list[str], count: str, name: str,
             partitions: int | None = None) -> DataFrame:
    """Adds to every block, for its group ``keys`` ordered by ``order``:
    ``{name}n`` payments of the group, ``{name}before`` payments before the
    block, and ``{name}date`` and ``{name}amount`` of the payment before it.

    ``order`` tells all blocks of a group apart. The blocks are dealt by ranges of
    (keys, order), balanced by Spark's sample of them, and written with the number
    of their range; so both passes see the same ranges. Only the groups that lie
    in several ranges, two for each range at most, are looked up.
    """
    dealt = blocks.repartitionByRange(partitions, *keys, *order) if partitions else blocks.repartitionByRange(*keys, *order)
    ranged = written(dealt.withColumn("_range", F.spark_partition_id()), "ranges")
    before = (Window.unboundedPreceding, -1)
    last = F.struct(*order, F.col(DATE).alias("_date"), F.col(AMOUNT).alias("_amount"))
    group = Window.partitionBy(*keys)
    by_range = group.orderBy("_range")
    if partitions:
        ranged = ranged.repartition(partitions, "_range", *keys)
    groups = ranged.groupBy(*keys, "_range").agg(F.sum(count).alias("_rows"), F.max(last).alias("_last"))
    spanning = (
        (groups.repartition(partitions, *keys) if partitions else groups)
        .select(*[F.col(k).alias("_d_" + k) for k in keys], F.col("_range").alias("_d__range"),
                F.count(F.lit(1)).over(group).alias("_ranges"), F.sum("_rows").over(group).alias("_all"),
                F.coalesce(F.sum("_rows").over(by_range.rowsBetween(*before)), F.lit(0)).alias("_earlier"),
                F.lag("_last").over(by_range).alias("_previous"))
        .where(F.col("_ranges") > 1))
    in_range = Window.partitionBy("_range", *keys)
    walk = in_range.orderBy(*order)
    first = F.col("_k") == 1
    return (
        ranged.select("*", F.row_number().over(walk).alias("_k"), F.sum(count).over(in_range).alias("_own"),
                      F.coalesce(F.sum(count).over(walk.rowsBetween(*before)), F.lit(0)).alias("_in"),
                      F.lag(DATE).over(walk).alias("_date"), F.lag(AMOUNT).over(walk).alias("_amount"))
        .join(spanning, null_safe_on([*keys, "_range"], "_d_"), "left")
        .select(*blocks.columns, F.coalesce("_all", "_own").alias(f"{name}n"),
                (F.coalesce("_earlier", F.lit(0)) + F.col("_in")).alias(f"{name}before"),
                F.when(first, F.col("_previous._date")).otherwise(F.col("_date")).alias(f"{name}date"),
                F.when(first, F.col("_previous._amount")).otherwise(F.col("_amount")).alias(f"{name}amount"))
    )


def payment_sequence(rows: DataFrame, keys: list[str], order: list[str] = (DATE,), partitions: int | None = None) -> DataFrame:
    """Sequence variables of every payment within the group ``keys``, ordered by
    ``order``: any columns of the rows, for example the pair (customer, commerce)
    by date.

    Ties are ordered by date, then amount, customer and commerce; what is still
    equal are copies, so the result does not depend on the order among them:

    * ``difference_of_days``: days since the previous payment, NULL for the first;
    * ``impoper_f``: amount of the previous payment;
    * ``day_month``: day of the month;
    * ``nu_payments``: payments in the group;
    * ``order``: position in the group; ``order2``: position from the end among
      the payments of the same customer and commerce, by date.

    ``rows`` are payments, or counted blocks of equal payments (a column
    ``payments``), a few of which may be equal themselves. NULLs in a key are a group of their own, and come first in an order.
    """
    keys, order = list(dict.fromkeys(keys)), list(order)
    needed = list(dict.fromkeys([*PAYMENT_COLUMNS, *keys, *order]))
    if not keys:
        raise ValueError("a payment sequence needs a key")
    if missing := [c for c in needed if c not in rows.columns]:
        raise ValueError(f"the payments lack columns: {missing}")

    def all_of(first: list[str], but: list[str]) -> list[str]:
        """An order that tells the chunks of a group with equal ``but`` apart."""
        return [c for c in dict.fromkeys([*first, DATE, AMOUNT, CUSTOMER, COMMERCE, *needed, "_chunk"]) if c not in but]

    if WEIGHT in rows.columns:
        blocks = rows.select(*needed, F.col(WEIGHT).cast("long").alias("_c"))
    else:
        blocks = rows.groupBy(*needed).agg(F.count(F.lit(1)).alias("_c"))
    chunks = in_chunks(blocks, "_c")
    placed = numbered(chunks, keys, all_of(order, keys), "_c", "g_", partitions)
    same = set(keys) == set(PAIR_KEYS) and all_of(order, keys) == all_of([DATE], PAIR_KEYS)
    if not same:
        placed = numbered(placed, PAIR_KEYS, all_of([DATE], PAIR_KEYS), "_c", "p_", partitions)
    copied = expanded(placed, "_c")
    position = (F.col("g_before") + F.col("_i")).cast("int")
    from_end = F.col("g_n" if same else "p_n") - F.col("g_before" if same else "p_before") - F.col("_i") + 1
    first = F.col("_i") == 1
    return copied.select(
        *PAYMENT_COLUMNS,
        F.when(first, F.datediff(F.col(DATE), F.col("g_date"))).otherwise(F.lit(0)).cast("int").alias(DIFFERENCE_OF_DAYS),
        F.when(first, F.col("g_amount")).otherwise(F.col(AMOUNT)).alias(PREVIOUS_AMOUNT),
        F.dayofmonth(DATE).alias(DAY_MONTH),
        F.col("g_n").cast("long").alias(NU_PAYMENTS),
        position.alias(ORDER),
        from_end.cast("int").alias(ORDER_DESC),
    )


def payments_of(blocks: DataFrame, partitions: int | None = None) -> DataFrame:
    """The payments that counted blocks stand for, row by row. The chunks are
    dealt over tasks first, so that the copies of one payment are."""
    chunks = in_chunks(blocks, WEIGHT)
    by = [CUSTOMER, COMMERCE, DATE, AMOUNT, "_chunk"]
    return expanded(chunks.repartition(partitions, *by) if partitions else chunks.repartition(*by), WEIGHT).drop(WEIGHT, "_chunk", "_i")


def amount_recurrences(marked_daily: DataFrame, config: RecurrenceConfig = DEFAULT_CONFIG) -> DataFrame:
    """Marked day-sums with their sequence over (customer, commerce, amount),
    kept when the amount repeats more than twice. A pair has one day-sum a day,
    so every window holds the days of its history at most."""
    group = Window.partitionBy(*TRIPLE_KEYS)
    by_day = group.orderBy(DATE)
    from_end = Window.partitionBy(*PAIR_KEYS).orderBy(F.col(DATE).desc())
    return marked_daily.select(
        *PAYMENT_COLUMNS,
        F.datediff(F.col(DATE), F.lag(DATE).over(by_day)).alias(DIFFERENCE_OF_DAYS),
        F.lag(AMOUNT).over(by_day).alias(PREVIOUS_AMOUNT),
        F.dayofmonth(DATE).alias(DAY_MONTH),
        F.count(F.lit(1)).over(group).alias(NU_PAYMENTS),
        F.row_number().over(by_day).alias(ORDER),
        F.row_number().over(from_end).alias(ORDER_DESC),
    ).where(F.col(NU_PAYMENTS) >= config.min_payments)


def commerce_recurrences(payments: DataFrame, config: RecurrenceConfig = DEFAULT_CONFIG) -> DataFrame:
    """Commerce-scope payments with their sequence over (customer, commerce),
    kept when the pair has more than two payments."""
    seq = payment_sequence(commerce_scope(payments), PAIR_KEYS, partitions=config.partitions)
    return seq.where(F.col(NU_PAYMENTS) >= config.min_payments)
