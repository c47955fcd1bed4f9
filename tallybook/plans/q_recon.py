"""Registered reconciliation queries (G1-G4, B11) with their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallybook.operators import lookup as L
from tallybook.operators import recon as R
from tallybook.plans.fixtures import NOW
from tallybook.plans.inputs import Inputs
from tallybook.plans.registry import register


def _items(x: Inputs):
    return R.match_items(x.raw("fx_statement"), x.raw("fx_internal"), NOW)


_BATCH = "concat('RB:', source_system, ':', cast(statement_date AS string))"

_ITEMS_SQL = f"""
st AS (SELECT *, {_BATCH} AS b FROM fx_statement),
ranked AS (SELECT *, row_number() OVER (PARTITION BY b, external_reference, currency_code
                                        ORDER BY value_at, statement_line_id) AS rn FROM st),
firsts AS (SELECT * FROM ranked WHERE rn = 1),
it AS (SELECT *, {_BATCH} AS b FROM fx_internal),
items AS (
  SELECT COALESCE(f.b, i.b) AS reconciliation_batch_id,
         COALESCE(f.external_reference, i.external_reference) AS external_reference,
         COALESCE(f.currency_code, i.currency_code) AS currency_code,
         i.journal_transaction_id, i.journal_line_id,
         f.amount AS statement_amount, i.amount AS internal_amount,
         COALESCE(f.amount, i.amount) AS amount
  FROM firsts f FULL OUTER JOIN it i
    ON f.b = i.b AND f.external_reference = i.external_reference
   AND f.currency_code = i.currency_code)"""

_MARKED_SQL = f"""
WITH {_ITEMS_SQL},
m AS (
  SELECT *, statement_amount IS NOT NULL AND internal_amount IS NOT NULL AS both_sides,
         cast(abs(statement_amount - internal_amount) AS decimal(20,8)) AS v
  FROM items),
marked AS (
  SELECT concat(reconciliation_batch_id, ':', external_reference, ':', currency_code) AS id,
         reconciliation_batch_id, amount,
         CASE WHEN both_sides AND v <= 0 THEN 'matched' ELSE 'exception' END AS status,
         CASE WHEN both_sides THEN internal_amount ELSE cast(0 AS decimal(20,8)) END
             AS matched_amount,
         CASE WHEN both_sides THEN v ELSE cast(0 AS decimal(20,8)) END AS variance_amount,
         CASE WHEN internal_amount IS NULL THEN 'missing_internal'
              WHEN statement_amount IS NULL THEN 'missing_external'
              WHEN NOT (both_sides AND v <= 0) THEN 'amount' END AS variance_reason
  FROM m)"""


@register("create_batch", oracle=f"""
SELECT {_BATCH} AS id, source_system, statement_date, 'pending' AS status,
       cast(SUM(amount) AS decimal(38,8)) AS expected_total_amount,
       cast(count(*) AS int) AS expected_total_count
FROM fx_statement GROUP BY source_system, statement_date
""")
def q_create_batch(spark, d):
    return R.create_batch(Inputs(spark, d).raw("fx_statement"), NOW).drop("started_at")


@register("match_items", oracle=f"""
WITH {_ITEMS_SQL}
SELECT concat(reconciliation_batch_id, ':', external_reference, ':', currency_code) AS id,
       reconciliation_batch_id, journal_transaction_id, journal_line_id, external_reference,
       currency_code, cast(amount AS decimal(20,8)) AS amount, statement_amount, internal_amount
FROM items
""")
def q_match_items(spark, d):
    items, _ = _items(Inputs(spark, d))
    return items.select("id", "reconciliation_batch_id", "journal_transaction_id",
                        "journal_line_id", "external_reference", "currency_code", "amount",
                        "statement_amount", "internal_amount")


@register("match_items_rejects", oracle=f"""
WITH {_ITEMS_SQL}
SELECT statement_line_id, b AS reconciliation_batch_id, external_reference,
       'duplicate external reference' AS reason
FROM ranked WHERE rn > 1
""")
def q_match_items_rejects(spark, d):
    _, rej = _items(Inputs(spark, d))
    return rej


@register("mark_matched", oracle=_MARKED_SQL + """
SELECT id, status, matched_amount, variance_amount, variance_reason FROM marked
""")
def q_mark_matched(spark, d):
    items, _ = _items(Inputs(spark, d))
    return R.mark_matched(items, NOW).select("id", "status", "matched_amount", "variance_amount",
                                             "variance_reason")


@register("batch_rollup", oracle=_MARKED_SQL + f""",
b AS (SELECT {_BATCH} AS id, source_system, statement_date,
             cast(SUM(amount) AS decimal(38,8)) AS expected_total_amount,
             cast(count(*) AS int) AS expected_total_count
      FROM fx_statement GROUP BY source_system, statement_date),
agg AS (SELECT reconciliation_batch_id,
               cast(SUM(CASE WHEN status = 'matched' THEN amount ELSE 0 END) AS decimal(38,8)) AS mta,
               cast(count(*) FILTER (WHERE status = 'matched') AS int) AS mtc,
               cast(SUM(CASE WHEN status <> 'matched' THEN amount ELSE 0 END) AS decimal(38,8)) AS xta,
               cast(count(*) FILTER (WHERE status <> 'matched') AS int) AS xtc
        FROM marked GROUP BY reconciliation_batch_id)
SELECT b.id, b.source_system, b.statement_date,
       CASE WHEN COALESCE(agg.xtc, 0) = 0 THEN 'matched' ELSE 'mismatch' END AS status,
       b.expected_total_amount, b.expected_total_count,
       COALESCE(agg.mta, 0) AS matched_total_amount, COALESCE(agg.mtc, 0) AS matched_total_count,
       COALESCE(agg.xta, 0) AS mismatch_total_amount, COALESCE(agg.xtc, 0) AS mismatch_total_count
FROM b LEFT JOIN agg ON agg.reconciliation_batch_id = b.id
""")
def q_batch_rollup(spark, d):
    x = Inputs(spark, d)
    items, _ = _items(x)
    marked = R.mark_matched(items, NOW)
    batches = R.create_batch(x.raw("fx_statement"), NOW)
    return R.batch_rollup(batches, marked, NOW).drop("finished_at")


@register("items_for_batch", oracle=f"""
WITH {_ITEMS_SQL}
SELECT concat(reconciliation_batch_id, ':', external_reference, ':', currency_code) AS id,
       reconciliation_batch_id, amount
FROM items WHERE reconciliation_batch_id LIKE 'RB:bank_a:1996%'
""")
def q_items_for_batch(spark, d):
    x = Inputs(spark, d)
    items, _ = _items(x)
    batches = R.create_batch(x.raw("fx_statement"), NOW).filter(
        (F.col("source_system") == "bank_a") & (F.year("statement_date") == 1996))
    return L.items_for_batch(items, batches).select("id", "reconciliation_batch_id", "amount")
