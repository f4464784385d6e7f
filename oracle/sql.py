"""DuckDB SQL for every registered query (same names, same column spec)."""

from __future__ import annotations

from cadence.functions.dates import horizon_days
from cadence.plans import queries as Q
from cadence.sources import testdata
from oracle.pipeline import BASE4, PAIR, TRIPLE, calendar_ctes, pipeline_ctes

SOURCE_SQL = {
    "customer": testdata.duckdb_text(testdata.F1_SQL),
    "lineitem": testdata.duckdb_text(testdata.F2_SQL),
    "events": testdata.duckdb_text(testdata.F3_SQL),
    "gaps": testdata.duckdb_text(testdata.F4_SQL),
    "lineitem_returns": testdata.duckdb_returns(testdata.F2_SQL),
    "event_returns": testdata.duckdb_returns(testdata.F3_SQL),
}

_PATTERN_AMOUNT = "transaction_amount AS pattern_amount"
_STATUS = "CASE WHEN p.as_of > s.horizon_date THEN 'LAPSED' ELSE s.regularity END"

CANDIDATES_SQL = f"""
  SELECT 'AMOUNT' AS scope, {_PATTERN_AMOUNT}, s.*, {_STATUS} AS status FROM amount_h s, params p
  UNION ALL BY NAME
  SELECT 'COMMERCE' AS scope, NULL AS pattern_amount, s.*, {_STATUS} AS status FROM commerce_h s, params p"""

INNER = {
    "active_customers": "SELECT * FROM active",
    "transaction_projection": "SELECT * FROM transactions",
    "net_of_reversals": "SELECT * FROM net",
    "marked_recurring_daily": "SELECT * FROM cr_daily",
    "not_marked": "SELECT * FROM not_marked",
    "payment_blocks": """
      SELECT customer_id, commerce_affiliation_id, operation_date, true AS marked, transaction_amount,
             1 AS payments, CASE WHEN nu_payments > 2 THEN 'AMOUNT' ELSE 'COMMERCE' END AS scope,
             CASE WHEN nu_payments > 2 THEN transaction_amount END AS pattern_amount
      FROM amount_seq
      UNION ALL
      SELECT customer_id, commerce_affiliation_id, operation_date, false, transaction_amount,
             count(*), 'COMMERCE', NULL
      FROM not_marked GROUP BY customer_id, commerce_affiliation_id, operation_date, transaction_amount""",
    "payment_sequence": "SELECT * FROM commerce_seq",
    "amount_recurrences": "SELECT * FROM amount_rec",
    "commerce_recurrences": "SELECT * FROM commerce_rec",
    "pattern_statistics": f"""
      SELECT 'AMOUNT' AS scope, {_PATTERN_AMOUNT}, * FROM amount_stats
      UNION ALL BY NAME SELECT 'COMMERCE' AS scope, NULL AS pattern_amount, * FROM commerce_stats""",
    "recent_amount_variation": "SELECT * FROM last4cv",
    "similar_amount_recurrences": f"SELECT {BASE4}, CV_filter FROM commerce_cv",
    "pattern_transactions": f"""
      SELECT r.customer_id, r.commerce_affiliation_id, r.transaction_amount, r.operation_date,
             'AMOUNT' AS scope, r.transaction_amount AS pattern_amount, {_STATUS} AS status
      FROM amount_rec r JOIN amount_h s USING ({TRIPLE}), params p
      UNION ALL
      SELECT r.customer_id, r.commerce_affiliation_id, r.transaction_amount, r.operation_date,
             'COMMERCE', NULL, {_STATUS}
      FROM commerce_similar r JOIN commerce_h s USING ({PAIR}), params p""",
    "recurrence_horizon": CANDIDATES_SQL,
    "live_recurrences": f"SELECT * FROM ({CANDIDATES_SQL}) WHERE status <> 'LAPSED'",
    "lapsed_recurrences": f"SELECT * FROM ({CANDIDATES_SQL}) WHERE status = 'LAPSED'",
    "lapsed_to_nonrecurrent": f"""
      SELECT {BASE4} FROM amount_lapsed_rows UNION ALL SELECT {BASE4} FROM commerce_lapsed_rows""",
    "regularity_class": f"SELECT * FROM ({CANDIDATES_SQL}) WHERE status <> 'LAPSED'",
    "categorized_recurrences": f"""
      SELECT {PAIR}, 'COMMERCE' AS scope, NULL AS pattern_amount, max(nu_payments) AS nu_payments,
             'SINGLE' AS status FROM commerce_seq WHERE nu_payments <= 2 GROUP BY {PAIR}
      UNION ALL BY NAME
      SELECT {PAIR}, 'COMMERCE' AS scope, NULL AS pattern_amount, max(nu_payments) AS nu_payments,
             'DROPPED' AS status FROM commerce_rec WHERE commerce_affiliation_id IS NULL GROUP BY {PAIR}
      UNION ALL BY NAME
      SELECT {PAIR}, 'COMMERCE' AS scope, NULL AS pattern_amount, max(nu_payments) AS nu_payments,
             'DISSIMILAR' AS status FROM commerce_cv WHERE CV_filter = 0 GROUP BY {PAIR}
      UNION ALL BY NAME
      SELECT * FROM ({CANDIDATES_SQL})""",
    "nonrecurrent_monthly": "SELECT * FROM monthly",
    "monthly_percentile": "SELECT * FROM pct2",
    "nonrecurrent_level": "SELECT * FROM level",
    "unified_recurrences": "SELECT * FROM recurrences",
    "expected_payment": "SELECT * FROM expected",
    "recurrent_calendar": "SELECT * FROM recurrent_calendar",
    "nonrecurrent_calendar": "SELECT * FROM nonrecurrent_calendar",
    "stage_counts": """
      SELECT 'active_customers' AS stage, count(*) AS rows FROM active_ids WHERE customer_id IS NOT NULL
      UNION ALL SELECT 'without_date', count(*) FROM transactions WHERE operation_date IS NULL
      UNION ALL SELECT 'without_customer', count(*) FROM transactions
                WHERE operation_date IS NOT NULL AND customer_id IS NULL
      UNION ALL SELECT 'filtered_transactions', count(*) FROM active
      UNION ALL SELECT 'after_reversals', count(*) FROM net
      UNION ALL SELECT 'without_debit_type', count(*) FROM net WHERE debit_type IS NULL
      UNION ALL SELECT 'recurrents', count(*) FROM cr_daily
      UNION ALL SELECT 'no_recurrents', count(*) FROM not_marked
      UNION ALL SELECT 'evaluated_amount', count(*) FROM amount_seq
      UNION ALL SELECT 'amount_recurrents', count(*) FROM amount_rec
      UNION ALL SELECT 'amount_no_recurrents', count(*) FROM amount_rest
      UNION ALL SELECT 'evaluated_commerce', count(*) FROM commerce_seq
      UNION ALL SELECT 'commerce_recurrents', count(*) FROM commerce_rec
      UNION ALL SELECT 'commerce_no_recurrents', count(*) FROM nonrec1""",
    "fit": """
      SELECT customer_id, 'recurrence' AS kind, imp_oper, max_fec_trans, delta_avg, delta_std FROM recurrences
      UNION ALL BY NAME SELECT customer_id, 'level' AS kind, month_im FROM level""",
    "predict": """
      SELECT customer_id, 'recurrent' AS kind, calendar_date, CAST(expected_amount AS DOUBLE) AS amount
      FROM recurrent_calendar
      UNION ALL SELECT customer_id, 'nonrecurrent', calendar_date, CAST(month_im AS DOUBLE) FROM nonrecurrent_calendar""",
}


# Sources with equal payments on one day: which of them comes first is open, so
# both positions are numbered in one order.
TIED = {
    name: "SELECT * REPLACE (nu_payments - \"order\" + 1 AS order2) FROM commerce_seq"
    for name in ("payment_sequence_lineitem", "payment_sequence_events", "payment_sequence_gaps")
}


def _wide_inner(name: str, source) -> str:
    days = horizon_days(source.begin, source.end)
    if name.startswith("recurrent"):
        cols = ", ".join(f"sum(CASE WHEN calendar_date = DATE '{d}' THEN expected_amount END) AS \"{d}\""
                         for d in days)
        return f"SELECT customer_id, {cols} FROM expected GROUP BY customer_id"
    cols = ", ".join(f"month_im AS \"{d}\"" for d in days)
    return f"SELECT customer_id, {cols} FROM level"


def _present(name: str, kind: str) -> str:
    q = f'"{name}"'
    if kind == Q.LONG:
        return f"CAST({q} AS BIGINT) AS {q}"
    if kind == Q.FLOAT:
        return f"round(CAST({q} AS DOUBLE), 6) AS {q}"
    if kind == Q.MONEY:
        return f"CAST({q} AS DECIMAL(38,2)) AS {q}"
    if kind == Q.RATIO:
        return f"CAST({q} AS DECIMAL(38,6)) AS {q}"
    return q


def _base_name(query: Q.Query) -> str:
    for suffix in ("_lineitem_returns", "_event_returns", "_lineitem", "_events", "_gaps"):
        if query.name.endswith(suffix):
            return query.name[: -len(suffix)]
    return query.name


def oracle_for(query: Q.Query) -> str:
    source = query.source
    as_of = (f"DATE '{source.as_of}'" if source.as_of is not None
             else "(SELECT max(operation_date) FROM tx)")
    head = pipeline_ctes(SOURCE_SQL[source.name], as_of) + calendar_ctes(str(source.begin), str(source.end))
    base = _base_name(query)
    inner = TIED.get(query.name) or (_wide_inner(base, source) if base.endswith("_wide") else INNER[base])
    cols = ", ".join(_present(n, k) for n, k in query.columns(source))
    return f"{head}\nSELECT {cols} FROM ({inner}) q"


def oracle_sql() -> dict[str, str]:
    return {q.name: oracle_for(q) for q in Q.QUERIES}
