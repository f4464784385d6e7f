"""Column names and types of the card-transaction table and of the derived tables.

Fixed values: the names below are the public data contract of the original
recurrence model (input columns, the names of its sequence variables, pattern
statistics, recurrence table and non-recurrent level). They must stay spelled
exactly like this so that existing consumers of those tables keep working.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values: input columns, in the order of the 16-column projection ---
CUSTOMER = "customer_id"
OPERATION = "operation_id"
RETURN_TYPE = "return_type"
DEBIT_TYPE = "debit_type"
LINE_OF_BUSINESS = "line_of_business_id"
COMMERCE = "commerce_affiliation_id"
MESSAGE_TYPE = "message_type"
DATE = "operation_date"
TIME = "operation_time_date"
AMOUNT = "transaction_amount"
AUTHORIZATION = "authorization_reference_number"
OPERATION1 = "operation1_id"
PARTITIONING = "partitioning_type"
CARD_OWNER = "operation_card_owner_type"
VALIDATION = "lynx_validation_type"
ORIGINAL_AMOUNT = "original_transaction_amount"

# --- Fixed values: sequence variables of one payment ---
DIFFERENCE_OF_DAYS = "difference_of_days"
PREVIOUS_AMOUNT = "impoper_f"
DAY_MONTH = "day_month"
NU_PAYMENTS = "nu_payments"
ORDER = "order"
ORDER_DESC = "order2"

# --- Fixed values: pattern statistics ---
MEAN_AMOUNT = "MEAN_transaction_amount"
MEAN_DAY_MONTH = "MEAN_DAY_MONTH"
MEAN_DIFF_DAYS = "MEAN_DIFF_DAYS"
NUM_PAGOS = "num_pagos"
SD_AMOUNT = "SD_transaction_amount"
SD_DAY_MONTH = "SD_dia_mes"
SD_DIFF_DAYS = "SD_days_diff"
MAX_AMOUNT = "MAX_transaction_amount"
MIN_AMOUNT = "MIN_transaction_amount"
MAX_DAY_MONTH = "MAX_day_month"
MIN_DAY_MONTH = "MIN_day_month"
MAX_DIFF_DAYS = "MAX_days_diff"
MIN_DIFF_DAYS = "MIN_days_diff"
MAX_FECHA = "MAX_FECHA"
RANGE_AMOUNT = "RANGE_transaction_amount"
RANGE_DAY_MONTH = "RANGE_days_month"
RANGE_DIFF_DAYS = "RANGE_days_diff"
SRE_AMOUNT = "SRE_transaction_amount"
SRE_DAY_MONTH = "SRE_dia_mes"
SRE_DIFF_DAYS = "SRE_days_diff"
CV_AMOUNT = "CV_transaction_amount"
CV_FILTER = "CV_filter"

# --- Fixed values: unified recurrence table ---
IMP_OPER = "imp_oper"
MAX_FEC_TRANS = "max_fec_trans"
DELTA_AVG = "delta_avg"
DELTA_STD = "delta_std"

# --- Fixed values: non-recurrent level ---
YEAR = "year"
MONTH = "month"
SUM_IMPORTE = "sum_importe"
PERCENTILE = "percentile"
NUM_ROWS = "num_rows"
PERCENTILE_IM = "percentile_im"
MONTH_IM = "month_im"

# --- Names introduced by this library ---
SCOPE = "scope"                    # AMOUNT or COMMERCE
PATTERN_AMOUNT = "pattern_amount"  # the amount of an AMOUNT pattern, NULL for COMMERCE
STATUS = "status"                  # fate of a pattern, see operators.classify
MARKED = "marked"                  # payment is a day-sum of payments marked as recurring
WEIGHT = "payments"                # identical payments a block row stands for
HORIZON = "horizon_date"
CALENDAR_DATE = "calendar_date"
EXPECTED_AMOUNT = "expected_amount"

SCOPE_AMOUNT = "AMOUNT"
SCOPE_COMMERCE = "COMMERCE"

TRANSACTION_COLUMNS = [
    CUSTOMER, OPERATION, RETURN_TYPE, DEBIT_TYPE, LINE_OF_BUSINESS, COMMERCE,
    MESSAGE_TYPE, DATE, TIME, AMOUNT, AUTHORIZATION, OPERATION1, PARTITIONING,
    CARD_OWNER, VALIDATION, ORIGINAL_AMOUNT,
]

# Equal operations: a reversal and its original share all eight values.
REVERSAL_KEYS = [
    CUSTOMER, OPERATION, RETURN_TYPE, DATE, TIME, AMOUNT, AUTHORIZATION, OPERATION1,
]

PAIR_KEYS = [CUSTOMER, COMMERCE]
TRIPLE_KEYS = [CUSTOMER, COMMERCE, AMOUNT]
# One key for both scopes: an AMOUNT pattern is (customer, commerce, amount),
# a COMMERCE pattern is (customer, commerce) with a NULL pattern amount.
PATTERN_KEYS = [CUSTOMER, COMMERCE, SCOPE, PATTERN_AMOUNT]
PAYMENT_COLUMNS = [CUSTOMER, COMMERCE, AMOUNT, DATE]

# Declared types. The amount is a decimal because it is a grouping key.
TRANSACTION_SCHEMA = T.StructType([
    T.StructField(CUSTOMER, T.LongType()),
    T.StructField(OPERATION, T.LongType()),
    T.StructField(RETURN_TYPE, T.StringType()),
    T.StructField(DEBIT_TYPE, T.StringType()),
    T.StructField(LINE_OF_BUSINESS, T.IntegerType()),
    T.StructField(COMMERCE, T.IntegerType()),
    T.StructField(MESSAGE_TYPE, T.StringType()),
    T.StructField(DATE, T.DateType()),
    T.StructField(TIME, T.IntegerType()),
    T.StructField(AMOUNT, T.DecimalType(12, 2)),
    T.StructField(AUTHORIZATION, T.LongType()),
    T.StructField(OPERATION1, T.LongType()),
    T.StructField(PARTITIONING, T.StringType()),
    T.StructField(CARD_OWNER, T.StringType()),
    T.StructField(VALIDATION, T.StringType()),
    T.StructField(ORIGINAL_AMOUNT, T.DecimalType(12, 2)),
])
