"""DuckDB oracle: the recurrence model written row by row in plain SQL.

This is the brute-force reading of the model: sequence variables by window
functions over the payment rows, statistics joined back to the rows, the
complementary tables split and unioned again, exactly the way the original
class chains them. The Spark library computes the same results from day-level
tables and aggregates; the driver compares both at sf0.01.
"""

from __future__ import annotations

PAIR = "customer_id, commerce_affiliation_id"
TRIPLE = "customer_id, commerce_affiliation_id, transaction_amount"
BASE4 = "customer_id, commerce_affiliation_id, transaction_amount, operation_date"


def _sequence(name: str, src: str, keys: str) -> str:
    return f"""{name} AS (
  SELECT {BASE4},
    datediff('day', lag(operation_date) OVER w, operation_date) AS difference_of_days,
    lag(transaction_amount) OVER w AS impoper_f,
    dayofmonth(operation_date) AS day_month,
    count(*) OVER (PARTITION BY {keys}) AS nu_payments,
    row_number() OVER w AS "order",
    row_number() OVER (PARTITION BY {PAIR}
                       ORDER BY operation_date DESC, transaction_amount DESC NULLS LAST) AS order2
  FROM {src}
  WINDOW w AS (PARTITION BY {keys} ORDER BY operation_date ASC, transaction_amount ASC NULLS FIRST))"""


def _statistics(name: str, src: str, keys: str) -> str:
    amt = "CAST(transaction_amount AS FLOAT)"
    gap = "CASE WHEN \"order\" <> 1 THEN CAST(difference_of_days AS FLOAT) END"
    gap_i = "CASE WHEN \"order\" <> 1 THEN CAST(difference_of_days AS INTEGER) END"
    n = "max(CAST(nu_payments AS FLOAT))"
    mean_amt = f"CAST(avg({amt}) AS FLOAT)"
    mean_dom = "CAST(avg(CAST(day_month AS FLOAT)) AS FLOAT)"
    mean_gap = f"CAST(avg({gap}) AS FLOAT)"
    sd_amt = f"CAST(stddev_samp({amt}) AS FLOAT)"
    sd_dom = "CAST(stddev_samp(CAST(day_month AS FLOAT)) AS FLOAT)"
    sd_gap = f"CAST(stddev_samp({gap}) AS FLOAT)"

    def sre(sd, count, mean):
        return f"CAST({sd} AS DOUBLE) / nullif(sqrt(CAST({count} AS DOUBLE)) * CAST({mean} AS DOUBLE), 0)"

    return f"""{name} AS (
  SELECT {keys},
    max(nu_payments) AS nu_payments,
    {mean_amt} AS MEAN_transaction_amount,
    {mean_dom} AS MEAN_DAY_MONTH,
    {mean_gap} AS MEAN_DIFF_DAYS,
    {n} AS num_pagos,
    {sd_amt} AS SD_transaction_amount,
    {sd_dom} AS SD_dia_mes,
    {sd_gap} AS SD_days_diff,
    max({amt}) AS MAX_transaction_amount,
    min({amt}) AS MIN_transaction_amount,
    max(CAST(day_month AS INTEGER)) AS MAX_day_month,
    min(CAST(day_month AS INTEGER)) AS MIN_day_month,
    max(CAST(difference_of_days AS INTEGER)) AS MAX_days_diff,
    min({gap_i}) AS MIN_days_diff,
    max(operation_date) AS MAX_FECHA,
    CAST(max({amt}) - min({amt}) AS FLOAT) AS RANGE_transaction_amount,
    max(CAST(day_month AS INTEGER)) - min(CAST(day_month AS INTEGER)) AS RANGE_days_month,
    max(CAST(difference_of_days AS INTEGER)) - min({gap_i}) AS RANGE_days_diff,
    {sre(sd_amt, n, mean_amt)} AS SRE_transaction_amount,
    {sre(sd_dom, n, mean_dom)} AS SRE_dia_mes,
    {sre(sd_gap, f"CAST({n} - 1 AS FLOAT)", mean_gap)} AS SRE_days_diff
  FROM {src} GROUP BY {keys})"""


def _horizon(name: str, src: str) -> str:
    return f"""{name} AS (
  SELECT s.*, CAST(MAX_FECHA + (2 * CAST(trunc(SD_days_diff) AS INTEGER)
                                + CAST(trunc(MEAN_DIFF_DAYS) AS INTEGER)) AS DATE) AS horizon_date,
         CASE WHEN RANGE_days_diff < MEAN_DIFF_DAYS AND SRE_days_diff < 0.045::DOUBLE THEN 'HARD'
              WHEN RANGE_days_diff < MEAN_DIFF_DAYS AND SRE_days_diff > 0.045::DOUBLE THEN 'SOFT'
              WHEN RANGE_days_diff > MEAN_DIFF_DAYS THEN 'IRREGULAR'
              ELSE 'UNCLASSIFIED' END AS regularity
  FROM {src} s)"""


def pipeline_ctes(source_sql: str, as_of_sql: str) -> str:
    """All stages as one WITH list. ``as_of_sql`` is a DuckDB date expression
    over ``tx`` (a literal, or the last operation date)."""
    ctes = [
        f"transactions AS ({source_sql})",
        "tx AS (SELECT * FROM transactions WHERE operation_date IS NOT NULL)",
        f"params AS (SELECT CAST({as_of_sql} AS DATE) AS as_of)",
        """active_ids AS (SELECT DISTINCT customer_id FROM tx, params
                   WHERE operation_date >= CAST(as_of - INTERVAL 3 MONTH AS DATE))""",
        "active AS (SELECT tx.* FROM tx JOIN active_ids USING (customer_id))",
        """flagged AS (SELECT *, CASE WHEN max(message_type) OVER (PARTITION BY customer_id, operation_id,
                     return_type, operation_date, operation_time_date, transaction_amount,
                     authorization_reference_number, operation1_id) >= '1420' THEN 1 ELSE 0 END AS flag_reverse
                FROM active)""",
        "net AS (SELECT * EXCLUDE (flag_reverse) FROM flagged WHERE flag_reverse = 0)",
        f"""cr_daily AS (SELECT customer_id, commerce_affiliation_id, operation_date,
                          sum(transaction_amount) AS transaction_amount
                   FROM net WHERE debit_type = 'CR' GROUP BY customer_id, commerce_affiliation_id, operation_date)""",
        f"not_marked AS (SELECT {BASE4} FROM net WHERE debit_type <> 'CR')",
        _sequence("amount_seq", "cr_daily", TRIPLE),
        "amount_rec AS (SELECT * FROM amount_seq WHERE nu_payments > 2)",
        f"amount_rest AS (SELECT {BASE4} FROM amount_seq WHERE nu_payments <= 2)",
        f"commerce_in AS (SELECT {BASE4} FROM amount_rest UNION ALL SELECT {BASE4} FROM not_marked)",
        _sequence("commerce_seq", "commerce_in", PAIR),
        "commerce_rec AS (SELECT * FROM commerce_seq WHERE nu_payments > 2)",
        f"nonrec1 AS (SELECT {BASE4} FROM commerce_seq WHERE nu_payments <= 2)",
        _statistics("amount_stats", "amount_rec", TRIPLE),
        f"""last4 AS (SELECT {PAIR},
              CAST(avg(CASE WHEN order2 <= 4 THEN CAST(transaction_amount AS FLOAT) END) AS FLOAT) AS MEAN_transaction_amount,
              CAST(stddev_samp(CASE WHEN order2 <= 4 THEN CAST(transaction_amount AS FLOAT) END) AS FLOAT) AS SD_transaction_amount
            FROM commerce_rec GROUP BY {PAIR})""",
        """last4cv AS (SELECT *, CAST(CAST(SD_transaction_amount AS DOUBLE)
                 / nullif(CAST(MEAN_transaction_amount AS DOUBLE), 0) AS FLOAT) AS CV_transaction_amount FROM last4)""",
        f"""commerce_cv AS (SELECT r.*, CASE WHEN l.CV_transaction_amount < 0.5::DOUBLE THEN 1 ELSE 0 END AS CV_filter
                   FROM commerce_rec r JOIN last4cv l USING ({PAIR}))""",
        "commerce_similar AS (SELECT * EXCLUDE (CV_filter) FROM commerce_cv WHERE CV_filter = 1)",
        f"nonrec2 AS (SELECT {BASE4} FROM nonrec1 UNION ALL SELECT {BASE4} FROM commerce_cv WHERE CV_filter = 0)",
        _statistics("commerce_stats", "commerce_similar", PAIR),
        _horizon("amount_h", "amount_stats"),
        _horizon("commerce_h", "commerce_stats"),
        "amount_live AS (SELECT a.* FROM amount_h a, params WHERE as_of <= horizon_date)",
        "commerce_live AS (SELECT c.* FROM commerce_h c, params WHERE as_of <= horizon_date)",
        "amount_lapsed AS (SELECT a.* FROM amount_h a, params WHERE as_of > horizon_date)",
        "commerce_lapsed AS (SELECT c.* FROM commerce_h c, params WHERE as_of > horizon_date)",
        f"""amount_lapsed_rows AS (SELECT r.customer_id, r.commerce_affiliation_id, r.transaction_amount, r.operation_date
                  FROM amount_rec r JOIN amount_lapsed s USING ({TRIPLE}))""",
        f"""commerce_lapsed_rows AS (SELECT r.customer_id, r.commerce_affiliation_id, r.transaction_amount, r.operation_date
                  FROM commerce_similar r JOIN commerce_lapsed s USING ({PAIR}))""",
        f"""nonrec3 AS (SELECT {BASE4} FROM nonrec2 UNION ALL SELECT {BASE4} FROM amount_lapsed_rows
                 UNION ALL SELECT {BASE4} FROM commerce_lapsed_rows)""",
        f"""amount_irregular_rows AS (SELECT r.customer_id, r.commerce_affiliation_id, r.transaction_amount, r.operation_date
                  FROM amount_rec r JOIN (SELECT * FROM amount_live WHERE regularity = 'IRREGULAR') s USING ({TRIPLE}))""",
        f"""commerce_irregular_rows AS (SELECT r.customer_id, r.commerce_affiliation_id, r.transaction_amount, r.operation_date
                  FROM commerce_similar r JOIN (SELECT * FROM commerce_live WHERE regularity = 'IRREGULAR') s USING ({PAIR}))""",
        f"""nonrec AS (SELECT {BASE4} FROM nonrec3 UNION ALL SELECT {BASE4} FROM amount_irregular_rows
                UNION ALL SELECT {BASE4} FROM commerce_irregular_rows)""",
        """recurrences AS (
          SELECT customer_id, MEAN_transaction_amount AS imp_oper, MAX_FECHA AS max_fec_trans,
                 MEAN_DIFF_DAYS AS delta_avg, SD_days_diff AS delta_std
          FROM (SELECT * FROM amount_live WHERE regularity IN ('HARD', 'SOFT')
                UNION ALL BY NAME SELECT * FROM commerce_live WHERE regularity IN ('HARD', 'SOFT')))""",
        """monthly AS (SELECT customer_id, year(operation_date) AS year, month(operation_date) AS month,
                   sum(transaction_amount) AS sum_importe FROM nonrec GROUP BY customer_id, year(operation_date), month(operation_date))""",
        """pct AS (SELECT *, percent_rank() OVER (PARTITION BY customer_id ORDER BY sum_importe ASC NULLS FIRST) AS percentile,
                   count(*) OVER (PARTITION BY customer_id) AS num_rows FROM monthly)""",
        """pct2 AS (SELECT *, CASE WHEN percentile >= 1.0::DOUBLE - 1.0::DOUBLE / num_rows THEN sum_importe END AS percentile_im
                 FROM pct)""",
        "level AS (SELECT customer_id, min(percentile_im) / 30 AS month_im FROM pct2 GROUP BY customer_id)",
    ]
    return "WITH " + ",\n".join(ctes)


def calendar_ctes(begin: str, end: str) -> str:
    """Horizon days ``[begin, end)`` and the expected payments (continues a WITH list)."""
    return f""",
days AS (SELECT CAST(d AS DATE) AS calendar_date
         FROM range(DATE '{begin}', DATE '{end}', INTERVAL 1 DAY) t(d)),
cycle AS (SELECT r.customer_id, d.calendar_date, r.imp_oper,
                 CAST(r.delta_avg AS DOUBLE) AS delta, 2 * CAST(r.delta_std AS DOUBLE) AS spread,
                 datediff('day', r.max_fec_trans, d.calendar_date) AS elapsed
          FROM recurrences r, days d),
cycle2 AS (SELECT *, CASE WHEN pos = 0 THEN delta ELSE pos END AS pos1
           FROM (SELECT *, CASE WHEN CAST(elapsed AS DOUBLE) % delta < 0
                             THEN ((CAST(elapsed AS DOUBLE) % delta) + delta) % delta
                             ELSE CAST(elapsed AS DOUBLE) % delta END AS pos FROM cycle)),
cycle3 AS (SELECT *, CAST(trunc(delta - pos1) AS INTEGER) AS next_payment FROM cycle2),
expected AS (
  SELECT customer_id, calendar_date,
    CASE WHEN next_payment = CAST(trunc(spread) AS INTEGER)
           OR (calendar_date = DATE '{begin}' AND next_payment < spread)
           OR (calendar_date = DATE '{begin}' AND next_payment >= delta - spread)
         THEN CAST(imp_oper AS FLOAT) ELSE CAST(0.0 AS FLOAT) END AS expected_amount
  FROM cycle3),
recurrent_calendar AS (SELECT customer_id, calendar_date, sum(expected_amount) AS expected_amount
                       FROM expected GROUP BY customer_id, calendar_date),
nonrecurrent_calendar AS (SELECT l.customer_id, d.calendar_date, l.month_im FROM level l, days d)"""
