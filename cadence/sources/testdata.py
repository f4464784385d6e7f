"""Transaction tables derived by Spark from the driver's test tables.

The mappings, described in FIXTURES.md:

* ``customer_transactions`` (F1): payment histories generated from ``customer``
  with integer arithmetic; periods of 7, 15, 23 and 31 days, reversals, a marked
  merchant, a varying and a constant one.
* ``lineitem_transactions`` (F2): one payment per line item, for volume.
* ``event_transactions`` (F3): short histories from ``events``, many ties.
* ``customer_transactions_with_gaps`` (F4): F1 with NULL merchants, dates,
  customers, message types and operation ids, NULL and zero amounts, and message
  types above the reversal type.
* ``lineitem_transactions_with_returns`` (F5), ``event_transactions_with_returns``
  (F6): F2 and F3 with whole and partial reversals of the marked payments.

All are projections of the rows as they are; ``conform`` drops what has no date
or customer.

The SQL text is shared with the DuckDB oracle (``{customer}`` etc. name the
source table), so both engines start from identical rows.
"""

from __future__ import annotations

import math
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadence.sources.transactions import transaction_projection

F1_SQL = """
with base as (
  select c_custkey as customer_id, cast(m.k as int) as commerce_affiliation_id, cast(j.j as int) as seq,
         date '2001-01-01' + cast(j.j*(7+(c_custkey%4)*8) + ((c_custkey*7 + j.j*j.j*5 + m.k*3) % (1 + c_custkey%13)) as int) as operation_date,
         cast(10 + c_custkey%20 + case when m.k=2 then ((j.j*c_custkey)%17)*4 else 0 end as decimal(12,2)) as transaction_amount,
         case when m.k=1 then 'CR' when c_custkey%17=0 and m.k=3 then null else 'DB' end as debit_type
  from {customer} cross join range(1,4) m(k) cross join range(0,9) j(j)
  where j.j <= 1 + (c_custkey + m.k)%8),
f as (
  select customer_id, commerce_affiliation_id, seq, operation_date, transaction_amount, debit_type, '1200' as message_type, 0 as dup from base
  union all select customer_id, commerce_affiliation_id, seq, operation_date, transaction_amount, debit_type, '1420', 0 from base where customer_id%11=0 and seq=2
  union all select customer_id, commerce_affiliation_id, seq, operation_date, transaction_amount, debit_type, '1200', 1 from base where customer_id%5=0 and seq=3 and commerce_affiliation_id=1),
g as (select *, customer_id*1000 + commerce_affiliation_id*100 + seq*2 + dup as operation_id from f)
select customer_id, operation_id, '00' as return_type, debit_type,
       commerce_affiliation_id%2 as line_of_business_id, commerce_affiliation_id, message_type, operation_date,
       cast(operation_id%86400 as int) as operation_time_date, transaction_amount,
       operation_id*7 as authorization_reference_number, operation_id as operation1_id,
       'A' as partitioning_type, 'T' as operation_card_owner_type, '0' as lynx_validation_type,
       transaction_amount as original_transaction_amount
from g
"""

F2_SQL = """
select o.o_custkey as customer_id,
       l.l_orderkey*8 + l.l_linenumber as operation_id,
       '00' as return_type,
       case when l.l_returnflag = 'R' then 'CR' else 'DB' end as debit_type,
       cast(l.l_suppkey % 2 as int) as line_of_business_id,
       cast(l.l_suppkey % 4 as int) as commerce_affiliation_id,
       '1200' as message_type,
       cast(l.l_shipdate as date) as operation_date,
       cast((l.l_orderkey*8 + l.l_linenumber) % 86400 as int) as operation_time_date,
       cast(10*ceil(l.l_quantity/10) as decimal(12,2)) as transaction_amount,
       (l.l_orderkey*8 + l.l_linenumber)*7 as authorization_reference_number,
       l.l_orderkey*8 + l.l_linenumber as operation1_id,
       'A' as partitioning_type, 'T' as operation_card_owner_type, '0' as lynx_validation_type,
       cast(10*ceil(l.l_quantity/10) as decimal(12,2)) as original_transaction_amount
from {lineitem} l join {orders} o on l.l_orderkey = o.o_orderkey
"""

F3_SQL = """
select user_id as customer_id, event_id as operation_id, '00' as return_type,
       case when event_id % 3 = 0 then 'CR' else 'DB' end as debit_type,
       0 as line_of_business_id, event_type as commerce_affiliation_id, '1200' as message_type,
       cast(ts as date) as operation_date, cast(event_id % 86400 as int) as operation_time_date,
       cast(floor(value/5)*5 as decimal(12,2)) as transaction_amount,
       event_id*7 as authorization_reference_number, event_id as operation1_id,
       'A' as partitioning_type, 'T' as operation_card_owner_type, '0' as lynx_validation_type,
       cast(floor(value/5)*5 as decimal(12,2)) as original_transaction_amount
from {events}
"""

# Spark reads the same rows with the payment slots generated per customer by
# ``explode(sequence(...))`` (a generator on each row) instead of joining with
# two constant ranges.
F1_SQL_SPARK = F1_SQL.replace(
    "from {customer} cross join range(1,4) m(k) cross join range(0,9) j(j)",
    "from {customer} lateral view explode(sequence(1, 3)) m as k "
    "lateral view explode(sequence(0, 8)) j as j")
assert F1_SQL_SPARK != F1_SQL

# the F1 rows with missing and degenerate values set by rule: NULL
# merchants, NULL and zero amounts, NULL operation ids (reversal groups with a
# NULL key), NULL dates and customers, NULL message types and ones above the
# reversal type. ``{f1}`` is the F1 query.
F4_SQL = """
select case when customer_id % 29 = 8 and commerce_affiliation_id = 3 then null else customer_id end as customer_id,
       case when customer_id % 9 = 4 then null else operation_id end as operation_id,
       return_type, debit_type, line_of_business_id,
       case when customer_id % 7 = 3 and commerce_affiliation_id = 2 then null
            else commerce_affiliation_id end as commerce_affiliation_id,
       case when customer_id % 31 = 3 then null
            when customer_id % 31 = 9 and commerce_affiliation_id = 2 then '1500' else message_type end as message_type,
       case when customer_id % 19 = 6 and commerce_affiliation_id = 1 then null else operation_date end as operation_date,
       operation_time_date,
       case when customer_id % 23 = 7 and commerce_affiliation_id = 1 then null
            when customer_id % 13 = 5 and commerce_affiliation_id = 3 then cast(0 as decimal(12,2))
            else transaction_amount end as transaction_amount,
       authorization_reference_number, operation1_id, partitioning_type,
       operation_card_owner_type, lynx_validation_type, original_transaction_amount
from ({f1}) f1
"""

# the rows of F2 or F3 (``{paid}``) with further messages for marked
# payments, by their amount: 40 and more are reversed whole (a row of equal keys,
# original and reversal go), those of 10 in part (another amount, so the original
# stays), and those of 20 are followed by a message below the reversal type (both stay).
RETURNS_SQL = """
select customer_id, operation_id, return_type, debit_type, line_of_business_id, commerce_affiliation_id,
       message.message_type, operation_date, operation_time_date,
       case when message.message_type = '1420' and transaction_amount = 10 then cast(5 as decimal(12,2))
            else transaction_amount end as transaction_amount,
       authorization_reference_number, operation1_id, partitioning_type,
       operation_card_owner_type, lynx_validation_type, original_transaction_amount
from ({paid}) paid cross join (select unnest(['1200', '1400', '1420']) as message_type) message
where message.message_type = '1200'
   or debit_type = 'CR' and message.message_type = '1400' and transaction_amount = 20
   or debit_type = 'CR' and message.message_type = '1420' and (transaction_amount >= 40 or transaction_amount = 10)
"""

# As for F1: a generator on each row instead of a join with constant rows.
RETURNS_SQL_SPARK = RETURNS_SQL.replace(
    "cross join (select unnest(['1200', '1400', '1420']) as message_type) message",
    "lateral view explode(array('1200', '1400', '1420')) message as message_type")
assert RETURNS_SQL_SPARK != RETURNS_SQL

# Test dates of F1: the reference date and the forecast horizon [begin, end).
F1_AS_OF = date(2001, 6, 30)
F1_BEGIN = date(2001, 7, 1)
F1_END = date(2001, 7, 31)


# The columns that F2 reads, in the order of the tables (another took a tenth more of a shuffle).
LINEITEM_COLUMNS = ["l_orderkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag", "l_shipdate"]
ORDERS_COLUMNS = ["o_orderkey", "o_custkey"]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Rows of transactions in a task: its sorts and windows take about 1 KB a row.
TASK_ROWS = 150_000
# Transactions that come of a row of a table, about: 9 slots of 3 merchants of which 13.5 are
# used, and their reversals and copies; a further message for one line item in four.
ROWS_EACH = {"customer": 17, "lineitem": 1.3, "events": 1.3}


def partitions(spark: SparkSession, sf_dir: str, name: str) -> int | None:
    """Partitions for the transactions of a table by its rows (a count that reads the
    file footers), all cores at least; None for a table of one task."""
    wanted = math.ceil(_table(spark, sf_dir, name).count() * ROWS_EACH[name] / TASK_ROWS)
    return max(wanted, spark.sparkContext.defaultParallelism) if wanted > 1 else None


def _spread(spark: SparkSession, sf_dir: str, name: str, *by: str, like: str | None = None,
            columns: list[str] | None = None) -> DataFrame:
    """A table, dealt over the partitions of ``like`` (itself): a small file may be one
    task's, whatever number of transactions come of it. ``columns``: dealt with these
    once for all readers, see ``_as_dealt``."""
    table, parts = _table(spark, sf_dir, name), partitions(spark, sf_dir, like or name)
    if not parts:
        return table
    return _as_dealt(table.select(*columns).repartition(parts, *by)) if columns else table.repartition(parts, *by)


def _as_dealt(dealt: DataFrame) -> DataFrame:
    """The rows behind a condition on all their columns that holds for every row, but
    that Spark cannot decide beforehand and so does not move. Each branch of a query reads
    other columns and rows of the transactions; pruned and filtered below the dealing,
    that is a shuffle of the table for each branch. So all branches share one."""
    always = F.spark_partition_id() >= 0
    return dealt.where(reduce(lambda a, c: a | F.col(c).isNull(), dealt.columns, always))


def customer_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transaction_projection(spark.sql(F1_SQL_SPARK, customer=_spread(spark, sf_dir, "customer", "c_custkey")))


def customer_transactions_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    f1 = spark.sql(F1_SQL_SPARK, customer=_spread(spark, sf_dir, "customer", "c_custkey"))
    return transaction_projection(spark.sql(F4_SQL, f1=f1))


def lineitem_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transaction_projection(spark.sql(
        F2_SQL,
        lineitem=_spread(spark, sf_dir, "lineitem", "l_orderkey", columns=LINEITEM_COLUMNS),
        orders=_spread(spark, sf_dir, "orders", "o_orderkey", like="lineitem", columns=ORDERS_COLUMNS),
    ))


def event_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transaction_projection(spark.sql(F3_SQL, events=_table(spark, sf_dir, "events")))


def _with_returns(paid: DataFrame) -> DataFrame:
    return transaction_projection(paid.sparkSession.sql(RETURNS_SQL_SPARK, paid=paid))


def lineitem_transactions_with_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_returns(lineitem_transactions(spark, sf_dir))


def event_transactions_with_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_returns(event_transactions(spark, sf_dir))


def duckdb_text(sql: str) -> str:
    """The same SQL over the DuckDB views of the driver."""
    f1 = F1_SQL.format(customer="customer")
    return sql.format(customer="customer", lineitem="lineitem", orders="orders", events="events", f1=f1)


def duckdb_returns(paid: str) -> str:
    """F5 or F6 over the text of F2 or F3."""
    return RETURNS_SQL.format(paid=duckdb_text(paid))
