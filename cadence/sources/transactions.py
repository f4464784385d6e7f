"""The card-transaction source: column check, projection and clean-up."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DateType, DecimalType, IntegralType, StringType, StructField, StructType, TimestampNTZType, TimestampType,
)

from cadence.sources.schema import (
    AMOUNT, AUTHORIZATION, CARD_OWNER, COMMERCE, CUSTOMER, DATE, DEBIT_TYPE, LINE_OF_BUSINESS, MESSAGE_TYPE, OPERATION,
    OPERATION1, ORIGINAL_AMOUNT, PARTITIONING, RETURN_TYPE, TIME, TRANSACTION_COLUMNS, VALIDATION,
)

_IDENTIFIER = (IntegralType, StringType)
_CODE = (StringType,)
#: What each of the 16 columns may be. Days are DATE (a time of day would split the
#: day-sums), amounts DECIMAL (they are pattern keys), message types STRING (they
#: compare as strings); identifiers are whole numbers or strings.
ALLOWED_TYPES = {
    CUSTOMER: _IDENTIFIER, OPERATION: _IDENTIFIER, RETURN_TYPE: _CODE, DEBIT_TYPE: _CODE, LINE_OF_BUSINESS: _IDENTIFIER,
    COMMERCE: _IDENTIFIER, MESSAGE_TYPE: _CODE, DATE: (DateType,), TIME: (*_IDENTIFIER, TimestampType, TimestampNTZType),
    AMOUNT: (DecimalType,), AUTHORIZATION: _IDENTIFIER, OPERATION1: _IDENTIFIER, PARTITIONING: _CODE, CARD_OWNER: _CODE,
    VALIDATION: _CODE, ORIGINAL_AMOUNT: (DecimalType,),
}


def reconciled_schema(df: DataFrame) -> StructType:
    """The 16 fields with the table's own types, all nullable. Raises with the
    names of the columns that are missing (also if only the case differs or a name
    is there twice), or whose type is not allowed."""
    if missing := [c for c in TRANSACTION_COLUMNS if df.columns.count(c) != 1]:
        raise ValueError(f"transaction table lacks columns: {missing}")
    wrong = [c for c in TRANSACTION_COLUMNS if not isinstance(df.schema[c].dataType, ALLOWED_TYPES[c])]
    if wrong:
        found = ", ".join(f"column {c} must be {_names(ALLOWED_TYPES[c])}, not {df.schema[c].dataType.simpleString()}" for c in wrong)
        raise TypeError(found)
    return StructType([StructField(c, df.schema[c].dataType, True) for c in TRANSACTION_COLUMNS])


def _names(kinds: tuple) -> str:
    return " or ".join("a whole number" if k is IntegralType else k.typeName() for k in kinds)


def transaction_projection(df: DataFrame) -> DataFrame:
    """The 16 columns the model works on, in their usual order, of allowed types."""
    return df.to(reconciled_schema(df))


def conform(df: DataFrame) -> DataFrame:
    """Projection plus removal of rows without an operation date or customer.

    A payment without a date has no place in a sequence; the original model
    failed on such rows further down, here they are dropped at the source. A
    row without a customer never passed the original's join on active
    customers. Filtering both here, once, also keeps every branch of the plan
    on the same scan, so Spark reuses their shuffles.
    """
    return transaction_projection(df).where(F.col(DATE).isNotNull() & F.col(CUSTOMER).isNotNull())


def read_transactions(spark: SparkSession, path: str) -> DataFrame:
    """Parquet (or a directory of parquet files) with the transaction columns."""
    return conform(spark.read.parquet(path))
