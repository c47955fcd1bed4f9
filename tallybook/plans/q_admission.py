"""Registered admission queries (F5) with a sequential DuckDB oracle (recursive CTE)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallybook.operators import admission as A
from tallybook.plans.inputs import Inputs
from tallybook.plans.registry import register

# The oracle replays the ops one by one (a recursive CTE carrying the balances of the
# touched accounts and the accepted, still open holds), i.e. the sequential definition.
_SEQUENTIAL = """
WITH RECURSIVE o AS (
  SELECT f.*, row_number() OVER (ORDER BY op_ts, seq_key) AS rn,
         CASE WHEN op_type = 'transfer' THEN amount + fee_amount ELSE amount END AS need,
         concat(source_account_id, ':', f.currency_code) AS sk,
         concat(destination_account_id, ':', f.currency_code) AS dk,
         CASE WHEN a.ledger_normal_side = 'debit' AND op_type = 'transfer' THEN -1 ELSE 1 END AS ss,
         CASE WHEN b.ledger_normal_side = 'debit' THEN -1 ELSE 1 END AS ds
  FROM fx_ops f LEFT JOIN fx_accounts a ON a.id = f.source_account_id
  LEFT JOIN fx_accounts b ON b.id = f.destination_account_id),
p AS (SELECT concat(account_id, ':', currency_code) AS k, account_id, currency_code,
             cast(available_balance AS decimal(38,8)) AS v
      FROM fx_projections WHERE balance_kind = 'available'),
op0 AS (SELECT map_from_entries(list(struct_pack(k := k, v := v))) AS bal FROM p
        WHERE k IN (SELECT sk FROM o UNION SELECT dk FROM o)),
s(rn, bal, holds, op_id, status) AS (
  SELECT 0::BIGINT, (SELECT bal FROM op0), MAP {'': 0::DECIMAL(38,8)}, NULL::VARCHAR, NULL::VARCHAR
  UNION ALL
  SELECT o.rn,
    CASE
      WHEN o.op_type = 'deposit' THEN map_concat(s.bal, MAP {o.dk:
            cast(COALESCE(s.bal[o.dk], 0) + o.ds * o.amount AS decimal(38,8))})
      WHEN o.op_type = 'transfer' AND COALESCE(s.bal[o.sk], 0) >= o.need
        THEN map_concat(s.bal, MAP {o.sk: cast(COALESCE(s.bal[o.sk], 0) - o.ss * o.need AS decimal(38,8))},
                        MAP {o.dk: cast(COALESCE(s.bal[o.dk], 0) + o.ds * o.amount AS decimal(38,8))})
      WHEN o.op_type = 'hold' AND COALESCE(s.bal[o.sk], 0) >= o.need
        THEN map_concat(s.bal, MAP {o.sk: cast(COALESCE(s.bal[o.sk], 0) - o.need AS decimal(38,8))})
      WHEN o.op_type = 'settle_failed' AND s.holds[o.hold_op_id] IS NOT NULL
        THEN map_concat(s.bal, MAP {o.sk: cast(COALESCE(s.bal[o.sk], 0) + o.amount AS decimal(38,8))})
      ELSE s.bal END,
    CASE
      WHEN o.op_type = 'hold' AND COALESCE(s.bal[o.sk], 0) >= o.need
        THEN map_concat(s.holds, MAP {o.op_id: cast(o.amount AS decimal(38,8))})
      ELSE s.holds END,
    o.op_id,
    CASE
      WHEN o.op_type = 'deposit' THEN 'accepted'
      WHEN o.op_type IN ('transfer', 'hold')
        THEN CASE WHEN COALESCE(s.bal[o.sk], 0) >= o.need THEN 'accepted' ELSE 'rejected' END
      ELSE CASE WHEN s.holds[o.hold_op_id] IS NOT NULL THEN 'accepted' ELSE 'rejected' END END
  FROM s JOIN o ON o.rn = s.rn + 1)
"""


def _opening(x: Inputs):
    return x.projections.filter(F.col("balance_kind") == "available").select(
        "account_id", "currency_code", "available_balance")


@register("admit", oracle=_SEQUENTIAL + """
SELECT o.op_id, o.op_type, s.status FROM s JOIN o USING (op_id)
""")
def q_admit(spark, d):
    x = Inputs(spark, d)
    return A.admit(x.ops, _opening(x), x.accounts).select("op_id", "op_type", "status")


@register("admitted_balances", oracle=_SEQUENTIAL + """
, last AS (SELECT bal FROM s WHERE rn = (SELECT max(rn) FROM s)),
fin AS (SELECT unnest(map_keys(bal)) AS k, unnest(map_values(bal)) AS v FROM last)
SELECT split_part(k, ':', 1) AS account_id, split_part(k, ':', 2) AS currency_code,
       cast(v AS decimal(38,8)) AS available_balance FROM fin
UNION ALL
SELECT account_id, currency_code, v FROM p WHERE k NOT IN (SELECT k FROM fin)
""")
def q_admitted_balances(spark, d):
    x = Inputs(spark, d)
    opening = _opening(x)
    return A.admitted_balances(A.admit(x.ops, opening, x.accounts), opening, x.accounts)
