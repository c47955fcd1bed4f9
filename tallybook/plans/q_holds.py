"""Registered hold and callback-settlement queries (F9, F10) with their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallybook.operators import holds as H
from tallybook.operators import posting as P
from tallybook.operators import validate as V
from tallybook.plans.fixtures import NOW
from tallybook.plans.inputs import Inputs
from tallybook.plans.registry import register
from tallybook.sources.messages import parse_envelope

_HOLD_OUT = ["id", "status", "remaining_amount", "released_amount", "captured_amount"]


def _winners(action: str) -> str:
    return f"""
WITH r AS (SELECT * FROM fx_hold_requests WHERE action = '{action}'),
j AS (SELECT r.*, h.status AS st, h.remaining_amount AS rem FROM r
      LEFT JOIN fx_holds h ON h.id = r.hold_id),
w AS (SELECT hold_id, arg_min(request_id, seq) AS win_req, arg_min(amount, seq) AS win_amt,
             min(seq) AS wseq
      FROM j WHERE st = 'active' AND rem >= amount AND amount > 0 GROUP BY hold_id)"""


@register("consume_holds", oracle=_winners("consume") + """
SELECT h.id, CASE WHEN w.hold_id IS NOT NULL THEN 'consumed' ELSE h.status END AS status,
       CASE WHEN w.hold_id IS NOT NULL THEN cast(0 AS decimal(20,8)) ELSE h.remaining_amount END
           AS remaining_amount,
       CASE WHEN w.hold_id IS NOT NULL
            THEN cast(h.released_amount + h.remaining_amount - w.win_amt AS decimal(20,8))
            ELSE h.released_amount END AS released_amount,
       CASE WHEN w.hold_id IS NOT NULL THEN cast(h.captured_amount + w.win_amt AS decimal(20,8))
            ELSE h.captured_amount END AS captured_amount
FROM fx_holds h LEFT JOIN w ON w.hold_id = h.id
""")
def q_consume_holds(spark, d):
    x = Inputs(spark, d)
    req = x.raw("fx_hold_requests").filter(F.col("action") == "consume")
    out, _ = H.consume_holds(x.holds, req, NOW)
    return out.select(*_HOLD_OUT)


@register("consume_holds_rejects", oracle=_winners("consume") + """
SELECT j.request_id, j.hold_id,
       CASE WHEN j.st IS NULL THEN 'hold not found'
            WHEN j.amount IS NULL OR j.amount <= 0 THEN 'invalid amount'
            WHEN j.st <> 'active' OR w.wseq < j.seq THEN 'hold not active'
            WHEN j.rem < j.amount THEN 'insufficient remaining' END AS reason
FROM j LEFT JOIN w ON w.hold_id = j.hold_id
WHERE w.win_req IS NULL OR w.win_req <> j.request_id
""")
def q_consume_holds_rejects(spark, d):
    x = Inputs(spark, d)
    req = x.raw("fx_hold_requests").filter(F.col("action") == "consume")
    _, rej = H.consume_holds(x.holds, req, NOW)
    return rej.select("request_id", "hold_id", "reason")


@register("release_holds", oracle=_winners("release") + """
SELECT h.id, CASE WHEN w.hold_id IS NOT NULL THEN 'released' ELSE h.status END AS status,
       CASE WHEN w.hold_id IS NOT NULL THEN cast(h.remaining_amount - w.win_amt AS decimal(20,8))
            ELSE h.remaining_amount END AS remaining_amount,
       CASE WHEN w.hold_id IS NOT NULL THEN cast(h.released_amount + w.win_amt AS decimal(20,8))
            ELSE h.released_amount END AS released_amount,
       h.captured_amount
FROM fx_holds h LEFT JOIN w ON w.hold_id = h.id
""")
def q_release_holds(spark, d):
    x = Inputs(spark, d)
    req = x.raw("fx_hold_requests").filter(F.col("action") == "release")
    out, _ = H.release_holds(x.holds, req, NOW)
    return out.select(*_HOLD_OUT)


_EXPIRE_AT = "2024-01-15 00:00:00"


@register("expire_holds", oracle=f"""
SELECT id,
       CASE WHEN status = 'active' AND expires_at <= cast('{_EXPIRE_AT}' AS timestamp)
            THEN 'expired' ELSE status END AS status,
       CASE WHEN status = 'active' AND expires_at <= cast('{_EXPIRE_AT}' AS timestamp)
            THEN cast(0 AS decimal(20,8)) ELSE remaining_amount END AS remaining_amount,
       CASE WHEN status = 'active' AND expires_at <= cast('{_EXPIRE_AT}' AS timestamp)
            THEN cast(released_amount + remaining_amount AS decimal(20,8))
            ELSE released_amount END AS released_amount,
       captured_amount
FROM fx_holds
""")
def q_expire_holds(spark, d):
    return H.expire_holds(Inputs(spark, d).holds, _EXPIRE_AT).select(*_HOLD_OUT)


@register("create_holds", oracle="""
SELECT concat('hold:', request_id) AS id, source_account_id AS account_id,
       request_id AS transfer_request_id, 'active' AS status, amount,
       amount AS remaining_amount, requested_at + INTERVAL '24 hours' AS expires_at
FROM fx_withdrawals
""")
def q_create_holds(spark, d):
    x = Inputs(spark, d)
    trf = P.create_transfer_requests(x.withdrawals, x.accounts, "withdrawal")
    return H.create_holds(trf).select("id", "account_id", "transfer_request_id", "status",
                                      "amount", "remaining_amount", "expires_at")


def _settle(spark, d):
    x = Inputs(spark, d)
    accepted, _ = V.verify_provider_token(x.raw("fx_callbacks"), x.raw("fx_providers"))
    parsed, _ = parse_envelope(accepted)
    trf = P.create_transfer_requests(x.withdrawals, x.accounts, "withdrawal")
    holds = H.create_holds(trf)
    return H.settle_callbacks(parsed, trf, holds, x.accounts, NOW)


_SETTLE = """
WITH acc AS (SELECT c.* FROM fx_callbacks c JOIN fx_providers p
             ON p.provider = c.provider AND c.token = p.secret),
cb AS (SELECT hook_id, received_at, json_extract_string(body, '$.event') AS event,
              json_extract_string(body, '$.data.reference') AS transfer_id
       FROM acc WHERE CASE WHEN json_valid(body) THEN json_type(body) = 'OBJECT' ELSE false END),
cbk AS (SELECT *, CASE WHEN event = 'transfer.success' THEN 'success'
                       WHEN event IN ('transfer.failed', 'transfer.reversed') THEN 'failure' END AS kind
        FROM cb),
trf AS (SELECT request_id AS id, 'pending' AS status,
               EXISTS (SELECT 1 FROM fx_accounts a WHERE a.account_type = 'settlement'
                       AND a.currency_code = w.currency_code) AS settles FROM fx_withdrawals w),
hold AS (SELECT request_id AS transfer_id, concat('hold:', request_id) AS hold_id,
                requested_at + INTERVAL '24 hours' AS exp FROM fx_withdrawals),
j AS (SELECT cbk.*, trf.status AS tst, trf.settles, hold.hold_id, hold.exp FROM cbk
      LEFT JOIN trf ON trf.id = cbk.transfer_id LEFT JOIN hold ON hold.transfer_id = cbk.transfer_id),
app AS (SELECT *, row_number() OVER (PARTITION BY transfer_id ORDER BY received_at, hook_id) AS rn
        FROM j WHERE kind IS NOT NULL AND tst IS NOT NULL AND tst NOT IN ('posted', 'failed')
          AND hold_id IS NOT NULL AND (exp IS NULL OR exp > received_at)
          AND (kind = 'failure' OR settles)),
w AS (SELECT transfer_id, hook_id AS win_hook, kind AS win_kind, received_at AS win_at
      FROM app WHERE rn = 1),
x AS (SELECT j.*, w.win_hook, w.win_kind,
             w.win_hook IS NOT NULL AND (j.received_at > w.win_at
               OR (j.received_at = w.win_at AND j.hook_id > w.win_hook)) AS after_win
      FROM j LEFT JOIN w ON w.transfer_id = j.transfer_id),
y AS (SELECT *, CASE WHEN after_win THEN CASE WHEN win_kind = 'success' THEN 'posted'
                                              ELSE 'failed' END
                     ELSE tst END AS seen,
             COALESCE(win_hook = hook_id, false) AS is_win
      FROM x)
"""


@register("settle_callbacks_outcomes", oracle=_SETTLE + """
SELECT hook_id, transfer_id, event,
       CASE WHEN kind IS NULL THEN 'rejected' WHEN tst IS NULL THEN 'rejected'
            WHEN is_win THEN CASE WHEN kind = 'success' THEN 'posted' ELSE 'failed' END
            WHEN kind = 'failure' AND seen = 'failed' THEN 'skipped'
            ELSE 'rejected' END AS outcome,
       CASE WHEN kind IS NULL THEN concat('unhandled event: ', COALESCE(event, ''))
            WHEN tst IS NULL THEN 'transfer not found'
            WHEN is_win THEN NULL
            WHEN kind = 'failure' AND seen = 'failed' THEN 'transfer already failed'
            WHEN kind = 'success' AND seen = 'posted' THEN 'transfer already processed'
            WHEN NOT after_win AND exp > received_at AND NOT settles THEN 'no settlement account'
            ELSE 'no active hold' END AS reason
FROM y
""")
def q_settle_outcomes(spark, d):
    return _settle(spark, d)["outcomes"]


@register("settle_callbacks_transfers", oracle=_SETTLE + f"""
SELECT transfer_id AS id, CASE WHEN kind = 'success' THEN 'posted' ELSE 'failed' END AS status,
       CASE WHEN kind = 'success' THEN cast('{NOW}' AS timestamp) END AS posted_at,
       CASE WHEN kind = 'failure' THEN cast('{NOW}' AS timestamp) END AS failed_at
FROM y WHERE is_win
""")
def q_settle_transfers(spark, d):
    return _settle(spark, d)["transfers"].select("id", "status", "posted_at", "failed_at")


@register("settle_callbacks_holds", oracle=_SETTLE + """
, win AS (SELECT transfer_id, kind FROM y WHERE is_win)
SELECT concat('hold:', w.request_id) AS id,
       CASE WHEN win.kind = 'success' THEN 'consumed' WHEN win.kind = 'failure' THEN 'released'
            ELSE 'active' END AS status,
       CASE WHEN win.kind IS NOT NULL THEN cast(0 AS decimal(20,8)) ELSE w.amount END
           AS remaining_amount,
       CASE WHEN win.kind = 'failure' THEN w.amount ELSE cast(0 AS decimal(20,8)) END
           AS released_amount,
       CASE WHEN win.kind = 'success' THEN w.amount ELSE cast(0 AS decimal(20,8)) END
           AS captured_amount
FROM fx_withdrawals w LEFT JOIN win ON win.transfer_id = w.request_id
""")
def q_settle_holds(spark, d):
    return _settle(spark, d)["holds"].select(*_HOLD_OUT)


@register("settle_callbacks_legs", oracle=_SETTLE + f"""
, win AS (SELECT transfer_id FROM y WHERE is_win AND kind = 'success'),
legs AS (
  SELECT w.request_id, 1 AS n, w.source_account_id AS account_id, 'debit' AS side, w.amount
  FROM fx_withdrawals w JOIN win ON win.transfer_id = w.request_id
  UNION ALL
  SELECT w.request_id, 2, a.id, 'credit', w.amount
  FROM fx_withdrawals w JOIN win ON win.transfer_id = w.request_id
  LEFT JOIN fx_accounts a ON a.account_type = 'settlement' AND a.currency_code = w.currency_code)
SELECT concat('withdrawal:', request_id, '#', cast(n AS string)) AS id,
       concat('withdrawal:', request_id) AS journal_transaction_id, n AS line_number,
       account_id, side, amount, 'ledger' AS balance_kind,
       cast('{NOW}' AS timestamp) AS created_at
FROM legs
""")
def q_settle_legs(spark, d):
    return _settle(spark, d)["legs"].select("id", "journal_transaction_id", "line_number",
                                            "account_id", "side", "amount", "balance_kind",
                                            "created_at")


@register("settle_callbacks_events", oracle=_SETTLE + """
SELECT concat(CASE WHEN y.kind = 'success' THEN 'transfer.posted' ELSE 'transfer.failed' END,
              ':', y.transfer_id) AS id,
       CASE WHEN y.kind = 'success' THEN 'transfer.posted' ELSE 'transfer.failed' END AS event_type,
       w.source_account_id AS partition_key
FROM y JOIN fx_withdrawals w ON w.request_id = y.transfer_id WHERE y.is_win
""")
def q_settle_events(spark, d):
    return _settle(spark, d)["events"].select("id", "event_type", "partition_key")
