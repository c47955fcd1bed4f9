"""Stand-in ledger inputs derived from the driver's test tables.

Each fixture is one SQL ``SELECT`` over the test tables (or earlier
fixtures) written in the subset of SQL that both Spark and DuckDB run, so the
Spark query and its DuckDB oracle read exactly the same input rows. Fixtures
only shape rows into the ledger schemas; none of them does an operator's work.

Placeholders: ``{TS}`` is the timestamp-without-time-zone type name.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
               "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

# Fixed evaluation instant of every job that needs "now".
NOW = "2024-02-01 00:00:00"

FIXTURES: dict[str, str] = {}
DEPS: dict[str, list[str]] = {}


def _fx(name: str, sql: str) -> None:
    FIXTURES[name] = sql.strip()
    DEPS[name] = sorted(set(re.findall(r"\b(fx_\w+)\b", sql)) - {name})


_fx("fx_customers", """
SELECT concat('U', cast(c_custkey AS string)) AS id,
       concat('cust_', cast(c_custkey AS string)) AS external_ref,
       c_name AS full_name,
       CASE WHEN c_custkey % 250 = 249
            THEN concat('CUSTOMER#', lpad(cast(c_custkey - 1 AS string), 9, '0'), '@X.TEST')
            ELSE concat(lower(c_name), '@x.test') END AS email,
       cast(NULL AS string) AS phone,
       cast(NULL AS string) AS national_id,
       CASE WHEN c_acctbal < -500 THEN 'closed' WHEN c_acctbal < 0 THEN 'suspended'
            ELSE 'active' END AS status,
       CASE WHEN c_custkey % 400 = 7 THEN '[]' ELSE '{}' END AS metadata,
       cast('1995-01-01 00:00:00' AS {TS}) + c_custkey * INTERVAL '1 minute' AS created_at,
       cast('1995-01-01 00:00:00' AS {TS}) + c_custkey * INTERVAL '1 minute' AS updated_at
FROM customer
UNION ALL
SELECT 'SYS', 'system_customer', 'System Ledger Customer', 'system@corebank.local',
       cast(NULL AS string), cast(NULL AS string), 'active', '{}',
       cast('1990-01-01 00:00:00' AS {TS}), cast('1990-01-01 00:00:00' AS {TS})
""")

_fx("fx_accounts", """
SELECT concat('C', cast(c_custkey AS string)) AS id,
       concat('U', cast(c_custkey AS string)) AS customer_id,
       concat('acct_C', cast(c_custkey AS string)) AS external_ref,
       concat('1', lpad(cast(c_custkey AS string), 9, '0')) AS account_number,
       'customer' AS account_type,
       CASE WHEN c_acctbal < -900 THEN 'closed' WHEN c_acctbal < 0 THEN 'frozen'
            ELSE 'active' END AS status,
       CASE WHEN c_nationkey = 24 THEN 'USD' ELSE 'NGN' END AS currency_code,
       CASE WHEN c_nationkey % 5 = 0 THEN 'debit' ELSE 'credit' END AS ledger_normal_side,
       '{}' AS metadata,
       cast('1995-01-01 00:00:00' AS {TS}) + c_custkey * INTERVAL '1 minute' AS opened_at,
       CASE WHEN c_acctbal < -990 THEN cast('1999-01-01 00:00:00' AS {TS}) END AS closed_at,
       cast('1995-01-01 00:00:00' AS {TS}) + c_custkey * INTERVAL '1 minute' AS created_at,
       cast('1995-01-01 00:00:00' AS {TS}) + c_custkey * INTERVAL '1 minute' AS updated_at
FROM customer
UNION ALL
SELECT concat('S', cast(s_suppkey AS string)), 'SYS',
       concat('acct_S', cast(s_suppkey AS string)),
       concat('2', lpad(cast(s_suppkey AS string), 9, '0')),
       'customer', 'active', 'NGN', 'credit', '{}',
       cast('1994-01-01 00:00:00' AS {TS}), cast(NULL AS {TS}),
       cast('1994-01-01 00:00:00' AS {TS}) + s_suppkey * INTERVAL '1 second',
       cast('1994-01-01 00:00:00' AS {TS}) + s_suppkey * INTERVAL '1 second'
FROM supplier
UNION ALL SELECT 'SYS_CASH', 'SYS', 'system_cash_ngn', '0000000001', 'system', 'active', 'NGN',
       'debit', '{}', cast('1990-01-01 00:00:00' AS {TS}), cast(NULL AS {TS}),
       cast('1990-01-01 00:00:01' AS {TS}), cast('1990-01-01 00:00:01' AS {TS})
UNION ALL SELECT 'SYS_SETTLEMENT', 'SYS', 'system_settlement_ngn', '0000000002', 'settlement',
       'active', 'NGN', 'credit', '{}', cast('1990-01-01 00:00:00' AS {TS}), cast(NULL AS {TS}),
       cast('1990-01-01 00:00:02' AS {TS}), cast('1990-01-01 00:00:02' AS {TS})
UNION ALL SELECT 'SYS_FEE', 'SYS', 'system_fee_revenue_ngn', '0000000003', 'fee', 'active', 'NGN',
       'credit', '{}', cast('1990-01-01 00:00:00' AS {TS}), cast(NULL AS {TS}),
       cast('1990-01-01 00:00:03' AS {TS}), cast('1990-01-01 00:00:03' AS {TS})
UNION ALL SELECT 'SYS_BANK', 'SYS', 'external_bank_ngn', '0000000005', 'customer', 'active', 'NGN',
       'debit', '{}', cast('1990-01-01 00:00:00' AS {TS}), cast(NULL AS {TS}),
       cast('1990-01-01 00:00:04' AS {TS}), cast('1990-01-01 00:00:04' AS {TS})
""")

# Transfer requests: one per order, customer account -> supplier account.
_fx("fx_transfers", """
SELECT concat('T', cast(o_orderkey AS string)) AS id,
       concat('K', cast(o_orderkey AS string)) AS idempotency_key_id,
       concat('U', cast(o_custkey AS string)) AS customer_id,
       concat('C', cast(o_custkey AS string)) AS source_account_id,
       concat('S', cast(o_orderkey % (SELECT count(*) FROM supplier) AS string))
           AS destination_account_id,
       'NGN' AS currency_code,
       cast(o_totalprice AS decimal(20,8)) AS amount,
       cast(CASE WHEN o_orderpriority = '5-LOW' THEN 0 ELSE 50 END AS decimal(20,8)) AS fee_amount,
       CASE o_orderstatus WHEN 'F' THEN 'posted' WHEN 'P' THEN 'pending' ELSE 'failed' END
           AS status,
       concat('CR', cast(o_orderkey AS string)) AS client_reference,
       concat('EXT', cast(o_orderkey AS string)) AS external_reference,
       '{}' AS metadata,
       o_orderdate AS requested_at,
       CASE WHEN o_orderstatus = 'F' THEN o_orderdate END AS posted_at,
       CASE WHEN o_orderstatus = 'O' THEN o_orderdate END AS failed_at,
       o_orderdate AS created_at,
       o_orderdate AS updated_at
FROM orders
""")

# Journal headers: one per transfer plus one opening deposit per customer with a positive balance.
_fx("fx_journal", """
SELECT concat('J', cast(o_orderkey AS string)) AS id,
       concat('REF', cast(o_orderkey AS string)) AS transaction_ref,
       concat('T', cast(o_orderkey AS string)) AS transfer_request_id,
       concat('K', cast(o_orderkey AS string)) AS idempotency_key_id,
       CASE o_orderstatus WHEN 'F' THEN 'posted' WHEN 'P' THEN 'pending' ELSE 'failed' END
           AS status,
       'transfer' AS entry_type,
       cast(o_orderdate AS date) AS accounting_date,
       o_orderdate AS effective_at,
       CASE WHEN o_orderstatus = 'F' THEN o_orderdate END AS posted_at,
       'core' AS source_system,
       concat('E', cast(o_orderkey AS string)) AS source_event_id,
       '{}' AS metadata,
       o_orderdate AS created_at
FROM orders
UNION ALL
SELECT concat('D', cast(c_custkey AS string)), concat('DREF', cast(c_custkey AS string)),
       cast(NULL AS string), concat('DK', cast(c_custkey AS string)), 'posted', 'deposit',
       cast('1994-12-31' AS date),
       cast('1994-12-31 00:00:00' AS {TS}) + c_custkey * INTERVAL '1 second',
       cast('1994-12-31 00:00:00' AS {TS}) + c_custkey * INTERVAL '1 second',
       'provider', concat('DEP-', cast(c_custkey AS string)), '{}',
       cast('1994-12-31 00:00:00' AS {TS}) + c_custkey * INTERVAL '1 second'
FROM customer WHERE c_acctbal > 0
""")

# Journal lines: 2-3 legs per transfer, 2 legs per opening deposit.
_fx("fx_lines", """
SELECT concat('L', cast(o_orderkey AS string), '_1') AS id,
       concat('J', cast(o_orderkey AS string)) AS journal_transaction_id,
       1 AS line_number,
       concat('C', cast(o_custkey AS string)) AS account_id,
       'debit' AS side,
       cast(cast(o_totalprice AS decimal(20,8))
         + cast(CASE WHEN o_orderpriority = '5-LOW' THEN 0 ELSE 50 END AS decimal(20,8))
         AS decimal(20,8)) AS amount,
       'NGN' AS currency_code,
       CASE WHEN o_orderkey % 3 = 0 THEN 'ledger' ELSE 'available' END AS balance_kind,
       '{}' AS metadata,
       o_orderdate AS created_at
FROM orders
UNION ALL
SELECT concat('L', cast(o_orderkey AS string), '_2'), concat('J', cast(o_orderkey AS string)), 2,
       concat('S', cast(o_orderkey % (SELECT count(*) FROM supplier) AS string)), 'credit',
       cast(o_totalprice AS decimal(20,8)), 'NGN',
       CASE WHEN o_orderkey % 3 = 0 THEN 'ledger' ELSE 'available' END, '{}', o_orderdate
FROM orders
UNION ALL
SELECT concat('L', cast(o_orderkey AS string), '_3'), concat('J', cast(o_orderkey AS string)), 3,
       'SYS_FEE', 'credit', cast(50 AS decimal(20,8)), 'NGN',
       CASE WHEN o_orderkey % 3 = 0 THEN 'ledger' ELSE 'available' END, '{}', o_orderdate
FROM orders WHERE o_orderpriority <> '5-LOW'
UNION ALL
SELECT concat('DL', cast(c_custkey AS string), '_1'), concat('D', cast(c_custkey AS string)), 1,
       'SYS_SETTLEMENT', 'debit', cast(c_acctbal AS decimal(20,8)), 'NGN', 'available', '{}',
       cast('1994-12-31 00:00:00' AS {TS}) + c_custkey * INTERVAL '1 second'
FROM customer WHERE c_acctbal > 0
UNION ALL
SELECT concat('DL', cast(c_custkey AS string), '_2'), concat('D', cast(c_custkey AS string)), 2,
       concat('C', cast(c_custkey AS string)), 'credit', cast(c_acctbal AS decimal(20,8)), 'NGN',
       'available', '{}', cast('1994-12-31 00:00:00' AS {TS}) + c_custkey * INTERVAL '1 second'
FROM customer WHERE c_acctbal > 0
""")

# A corrupted copy of the lines: a missing leg and an amount that is off by one.
_fx("fx_lines_bad", """
SELECT id, journal_transaction_id, line_number, account_id,
       CASE WHEN journal_transaction_id LIKE 'J%'
                 AND cast(substr(journal_transaction_id, 2) AS bigint) % 1000 = 3
                 AND line_number = 2 THEN 'sideways' ELSE side END AS side,
       CASE WHEN journal_transaction_id LIKE 'J%'
                 AND cast(substr(journal_transaction_id, 2) AS bigint) % 1000 = 2
                 AND line_number = 1
            THEN cast(amount + cast(1 AS decimal(20,8)) AS decimal(20,8)) ELSE amount END AS amount,
       currency_code, balance_kind, metadata, created_at
FROM fx_lines
WHERE NOT (journal_transaction_id LIKE 'J%'
           AND cast(substr(journal_transaction_id, 2) AS bigint) % 1000 = 1
           AND line_number = 2)
""")

# Funds holds from click events; the status mix follows event_id % 4.
_fx("fx_holds", """
SELECT concat('H', cast(event_id AS string)) AS id,
       concat('C', cast(user_id AS string)) AS account_id,
       concat('W', cast(event_id AS string)) AS transfer_request_id,
       concat('HJ', cast(event_id AS string)) AS journal_transaction_id,
       concat('HK', cast(event_id AS string)) AS idempotency_key_id,
       CASE event_id % 4 WHEN 1 THEN 'consumed' WHEN 2 THEN 'released' ELSE 'active' END AS status,
       'NGN' AS currency_code,
       cast(value AS decimal(20,8)) AS amount,
       CASE event_id % 4 WHEN 0 THEN cast(value AS decimal(20,8))
            WHEN 3 THEN cast(value / 2 AS decimal(20,8))
            ELSE cast(0 AS decimal(20,8)) END AS remaining_amount,
       CASE WHEN event_id % 4 = 2 THEN cast(value AS decimal(20,8))
            ELSE cast(0 AS decimal(20,8)) END AS released_amount,
       CASE event_id % 4 WHEN 1 THEN cast(value AS decimal(20,8))
            WHEN 3 THEN cast(cast(value AS decimal(20,8)) - cast(value / 2 AS decimal(20,8))
                             AS decimal(20,8))
            ELSE cast(0 AS decimal(20,8)) END AS captured_amount,
       ts + INTERVAL '24 hours' AS expires_at,
       ts AS created_at,
       ts AS updated_at
FROM events WHERE event_type = 'click'
""")


# Stored balance projections (the "before" state for rebuild, drift and versioned upserts).
_fx("fx_projections", """
SELECT concat('C', cast(c_custkey AS string)) AS account_id,
       CASE WHEN c_nationkey = 24 THEN 'USD' ELSE 'NGN' END AS currency_code,
       'available' AS balance_kind,
       cast(CASE WHEN c_acctbal > 0 THEN c_acctbal ELSE 0 END AS decimal(20,8)) AS ledger_balance,
       cast(CASE WHEN c_acctbal > 0 THEN c_acctbal ELSE 0 END AS decimal(20,8)) AS available_balance,
       cast(0 AS decimal(20,8)) AS held_balance,
       cast(c_custkey % 4 AS bigint) AS version,
       cast('2024-01-15 00:00:00' AS {TS}) AS computed_at
FROM customer WHERE c_custkey % 11 <> 0
""")


# Typed deposit requests (signup events) and withdrawal requests (click events).
_fx("fx_deposits", """
SELECT concat('DEP', cast(event_id AS string)) AS request_id,
       concat('IK', cast(event_id AS string)) AS idempotency_key_id,
       concat('U', cast(user_id AS string)) AS customer_id,
       cast(NULL AS string) AS source_account_id,
       concat('C', cast(user_id AS string)) AS destination_account_id,
       'NGN' AS currency_code,
       cast(value AS decimal(20,8)) AS amount,
       cast(CASE WHEN event_id % 2 = 0 THEN 1 ELSE 0 END AS decimal(20,8)) AS fee_amount,
       'paystack' AS source_system, 'deposit' AS description,
       CASE WHEN event_id % 9 = 0 THEN '' ELSE concat('CR', cast(event_id AS string)) END
           AS client_reference,
       concat('DEP-', cast(event_id AS string)) AS external_reference,
       '{}' AS metadata,
       ts AS requested_at
FROM events WHERE event_type = 'signup'
""")

_fx("fx_withdrawals", """
SELECT concat('W', cast(event_id AS string)) AS request_id,
       concat('WK', cast(event_id AS string)) AS idempotency_key_id,
       concat('U', cast(user_id AS string)) AS customer_id,
       concat('C', cast(user_id AS string)) AS source_account_id,
       cast(NULL AS string) AS destination_account_id,
       CASE WHEN event_id % 13 = 0 THEN 'USD' ELSE 'NGN' END AS currency_code,
       cast(value AS decimal(20,8)) AS amount,
       cast(0 AS decimal(20,8)) AS fee_amount,
       'core' AS source_system, 'withdrawal' AS description,
       concat('CR', cast(event_id AS string)) AS client_reference,
       concat('WD-', cast(event_id AS string)) AS external_reference,
       '{}' AS metadata,
       ts AS requested_at
FROM events WHERE event_type = 'click'
""")

# Ordered money operations for admission (F5) and balance deltas (F6):
# signup -> deposit, purchase -> transfer to another user (fee 5), click -> hold;
# clicks are settled one hour later (failed when event_id % 3 = 1, success when % 3 = 0).
_fx("fx_ops", """
SELECT concat('O', cast(event_id AS string)) AS op_id,
       ts AS op_ts,
       2 * event_id AS seq_key,
       CASE event_type WHEN 'signup' THEN 'deposit' WHEN 'purchase' THEN 'transfer'
            ELSE 'hold' END AS op_type,
       CASE WHEN event_type = 'signup' THEN cast(NULL AS string)
            ELSE concat('C', cast(user_id AS string)) END AS source_account_id,
       CASE WHEN event_type = 'signup' THEN concat('C', cast(user_id AS string))
            WHEN event_type = 'purchase'
            THEN concat('C', cast((7 * user_id + 1) % (SELECT max(user_id) + 1 FROM events) AS string))
       END AS destination_account_id,
       CASE WHEN event_id % 13 = 0 THEN 'USD' ELSE 'NGN' END AS currency_code,
       CASE WHEN event_type = 'signup'
            THEN cast(cast(value AS decimal(20,8)) * cast(1.2 AS decimal(3,1)) AS decimal(20,8))
            ELSE cast(value AS decimal(20,8)) END AS amount,
       cast(CASE WHEN event_type = 'purchase' THEN 5 ELSE 0 END AS decimal(20,8)) AS fee_amount,
       cast(NULL AS string) AS hold_op_id
FROM events
WHERE event_type IN ('signup', 'purchase', 'click')
  AND NOT (event_type = 'purchase'
           AND (7 * user_id + 1) % (SELECT max(user_id) + 1 FROM events) = user_id)
UNION ALL
SELECT concat('X', cast(event_id AS string)), ts + INTERVAL '1 hour', 2 * event_id + 1,
       CASE WHEN event_id % 3 = 1 THEN 'settle_failed' ELSE 'settle_success' END,
       concat('C', cast(user_id AS string)), cast(NULL AS string),
       CASE WHEN event_id % 13 = 0 THEN 'USD' ELSE 'NGN' END,
       cast(value AS decimal(20,8)), cast(0 AS decimal(20,8)),
       concat('O', cast(event_id AS string))
FROM events WHERE event_type = 'click' AND event_id % 3 <> 2
""")

# Reversal transactions for posted orders with key % 50 = 0; mirrored legs, except a wrong
# amount when key % 100 = 0.
_fx("fx_reversal_journal", """
SELECT concat('RV', cast(o_orderkey AS string)) AS id,
       'reversal' AS entry_type, 'posted' AS status,
       concat('J', cast(o_orderkey AS string)) AS reversal_of_transaction_id
FROM orders WHERE o_orderstatus = 'F' AND o_orderkey % 50 = 0
""")

_fx("fx_reversal_lines", """
SELECT concat('RV', substr(l.journal_transaction_id, 2), '_', cast(l.line_number AS string)) AS id,
       concat('RV', substr(l.journal_transaction_id, 2)) AS journal_transaction_id,
       l.line_number, l.account_id,
       CASE WHEN l.side = 'debit' THEN 'credit' ELSE 'debit' END AS side,
       CASE WHEN cast(substr(l.journal_transaction_id, 2) AS bigint) % 100 = 0 AND l.line_number = 2
            THEN cast(l.amount + cast(1 AS decimal(20,8)) AS decimal(20,8)) ELSE l.amount END
           AS amount,
       l.currency_code, l.balance_kind, l.created_at
FROM fx_lines l JOIN fx_reversal_journal r ON r.reversal_of_transaction_id = l.journal_transaction_id
""")

# Transactions to post now: the pending transfers with an even order key (plus a few already posted).
_fx("fx_post_ids", """
SELECT concat('J', cast(o_orderkey AS string)) AS id FROM orders
WHERE (o_orderstatus = 'P' AND o_orderkey % 2 = 0) OR (o_orderstatus = 'F' AND o_orderkey % 9 = 0)
""")

# Status changes for transfers, customers and accounts.
_fx("fx_status_changes", """
SELECT concat('T', cast(o_orderkey AS string)) AS id,
       CASE WHEN o_orderkey % 2 = 0 THEN 'posted' ELSE 'failed' END AS status,
       concat('NEWEXT', cast(o_orderkey AS string)) AS external_reference
FROM orders WHERE o_orderstatus = 'P' AND o_orderkey % 7 = 0
""")


# Provider callbacks (JSON bodies in the provider's envelope) from click/view/error events.
# Event kind by event_id % 4; a repeat delivery when % 10 = 0; broken JSON when % 101 = 0;
# a wrong token when % 50 = 0; an unknown provider when % 77 = 0.
_fx("fx_callbacks", """
WITH b AS (
  SELECT event_id, user_id, ts, value,
         CASE WHEN event_id % 77 = 0 THEN 'acme' WHEN user_id % 7 = 0 THEN 'flutterwave'
              ELSE 'paystack' END AS provider,
         CASE event_id % 4 WHEN 0 THEN 'transfer.success' WHEN 1 THEN 'transfer.failed'
              WHEN 2 THEN 'transfer.reversed' ELSE 'charge.unknown' END AS ev,
         CASE event_id % 4 WHEN 0 THEN 'success' WHEN 1 THEN 'failed' WHEN 2 THEN 'reversed'
              ELSE 'unknown' END AS st
  FROM events WHERE event_type IN ('click', 'view', 'error')),
j AS (
  SELECT event_id, ts, provider,
         concat('{"event":"', ev, '","id":"evt', cast(event_id AS string),
                '","type":"transfer","provider":"', provider,
                '","data":{"reference":"W', cast(event_id AS string), '","status":"', st,
                '","id":"', cast(event_id AS string), '","provider":"', provider,
                '","Amount":"', cast(cast(value AS decimal(20,8)) AS string),
                '","Currency":"NGN","Domain":"test","account_number":"',
                lpad(cast(user_id AS string), 10, '0'), '","bank_code":"058","full_name":"user ',
                cast(user_id AS string), '","failure_reason":"',
                CASE WHEN st = 'failed' THEN 'insufficient funds at bank' ELSE '' END, '"}}') AS body
  FROM b),
k AS (
  SELECT event_id, ts, provider,
         CASE WHEN event_id % 101 = 0 THEN substr(body, 1, 40) ELSE body END AS body,
         CASE WHEN event_id % 50 = 0 THEN 'wrong-token' ELSE concat('sk_', provider) END AS token
  FROM j)
SELECT concat('CB', cast(event_id AS string)) AS hook_id, provider, token, body, ts AS received_at,
       event_id AS src_event
FROM k
UNION ALL
SELECT concat('CB', cast(event_id AS string), 'r'), provider, token, body,
       ts + INTERVAL '5 minutes', event_id
FROM k WHERE event_id % 10 = 0
""")

_fx("fx_providers", """
SELECT 'paystack' AS provider, 'sk_paystack' AS secret
UNION ALL SELECT 'flutterwave', 'sk_flutterwave'
""")

# Incoming-webhook rows (already stored): withdrawal callbacks and deposit messages.
_fx("fx_webhooks", """
SELECT hook_id AS id, provider,
       CASE WHEN src_event % 101 <> 0 THEN concat('evt', cast(src_event AS string)) END
           AS external_event_id,
       'withdrawal.webhook' AS event_type,
       body AS payload, '{}' AS headers,
       CASE WHEN src_event % 5 = 0 THEN 'success' ELSE 'pending' END AS status,
       received_at AS created_at, received_at AS updated_at
FROM fx_callbacks
UNION ALL
SELECT concat('DW', cast(event_id AS string)), 'paystack', concat('DEP-', cast(event_id AS string)),
       'deposit.transfer',
       concat('{"provider":"paystack","external_reference":"DEP-', cast(event_id AS string), '"}'),
       '{}', 'pending', ts, ts
FROM events WHERE event_type = 'signup'
""")

# Raw request bodies (JSON text) per scope; keys repeat (k in props is 0..99).
# A blank customer id when event_id % 37 = 0; amount "not-a-number" when % 53 = 0.
_fx("fx_request_bodies", """
WITH b AS (
  SELECT event_id, ts, user_id,
         CASE event_type WHEN 'signup' THEN 'deposit_create' WHEN 'purchase' THEN 'transfer_create'
              ELSE 'withdrawal_create' END AS scope,
         CASE event_type WHEN 'signup' THEN 'deposit' WHEN 'purchase' THEN 'transfer'
              ELSE 'withdrawal' END AS kind,
         concat('k', regexp_extract(props, '([0-9]+)', 1)) AS idempotency_key,
         CASE WHEN event_id % 53 = 0 THEN 'not-a-number'
              ELSE cast(cast(floor(value / 100) AS bigint) * 100 + 100 AS string) END AS amount
  FROM events WHERE event_type IN ('signup', 'purchase', 'click'))
SELECT concat('R', cast(event_id AS string)) AS request_id, scope, kind, idempotency_key,
       concat('{"idempotency_key_id":"', idempotency_key,
              '","customer_id":"', CASE WHEN event_id % 37 = 0 THEN ''
                                        ELSE concat('U', cast(user_id AS string)) END,
              '","source_account_id":"C', cast(user_id AS string),
              '","destination_account_id":"C', cast((user_id + 1) % 150 AS string),
              '","currency_code":"NGN","amount":"', amount,
              '","fee_amount":"0","source_system":"core","provider":"paystack",',
              '"client_reference":"cr', idempotency_key, '","external_reference":"ext',
              idempotency_key, '","description":"', kind, '"}') AS body,
       ts AS arrival
FROM b
""")

# Idempotency keys stored by an earlier run: requests that arrived before 2024-01-03.
_fx("fx_idem_keys", """
SELECT concat('IDK-', scope, '-', idempotency_key) AS id, idempotency_key, scope,
       sha2(min(body), 256) AS request_hash,
       CASE WHEN idempotency_key LIKE '%3' THEN cast(NULL AS int) ELSE 201 END AS response_code,
       CASE WHEN idempotency_key LIKE '%3' THEN cast(NULL AS string)
            ELSE concat('{"status":"ok","key":"', idempotency_key, '"}') END AS response_body,
       min(arrival) AS locked_at,
       min(arrival) + INTERVAL '24 hours' AS expires_at,
       min(arrival) AS created_at, min(arrival) AS updated_at
FROM fx_request_bodies WHERE arrival < cast('2024-01-03 00:00:00' AS {TS})
GROUP BY scope, idempotency_key
""")

# Bank statement lines against posted transfers: 10% missing, amount off by 1.00 when
# key % 7 = 0, extra unknown lines when key % 50 = 0, a repeated line when key % 97 = 0.
_fx("fx_statement", """
WITH t AS (
  SELECT o_orderkey AS k, o_orderdate, cast(o_totalprice AS decimal(20,8)) AS amount
  FROM orders WHERE o_orderstatus = 'F')
SELECT CASE WHEN k % 2 = 0 THEN 'bank_a' ELSE 'bank_b' END AS source_system,
       cast(date_trunc('month', o_orderdate) AS date) AS statement_date,
       concat('EXT', cast(k AS string)) AS external_reference, 'NGN' AS currency_code,
       CASE WHEN k % 7 = 0 THEN cast(amount + cast(1 AS decimal(20,8)) AS decimal(20,8))
            ELSE amount END AS amount,
       o_orderdate AS value_at, concat('SL-', cast(k AS string)) AS statement_line_id
FROM t WHERE k % 10 <> 0
UNION ALL
SELECT CASE WHEN k % 2 = 0 THEN 'bank_a' ELSE 'bank_b' END,
       cast(date_trunc('month', o_orderdate) AS date),
       concat('X', cast(k AS string)), 'NGN', amount, o_orderdate,
       concat('SLX-', cast(k AS string))
FROM t WHERE k % 50 = 0
UNION ALL
SELECT CASE WHEN k % 2 = 0 THEN 'bank_a' ELSE 'bank_b' END,
       cast(date_trunc('month', o_orderdate) AS date),
       concat('EXT', cast(k AS string)), 'NGN', amount, o_orderdate + INTERVAL '1 second',
       concat('SLR-', cast(k AS string))
FROM t WHERE k % 97 = 0 AND k % 10 <> 0
""")

# Provider attempts: three attempts (priorities 0..2) per request id.
_fx("fx_attempts", """
SELECT concat('R', cast(cast(floor(event_id / 3) AS bigint) AS string)) AS request_id,
       cast(event_id % 3 AS int) AS priority,
       concat('p', cast(user_id % 3 AS string)) AS provider,
       event_type <> 'error' AS success,
       value AS latency_ms,
       ts AS attempted_at,
       CASE WHEN event_type = 'error' THEN concat('provider error ', cast(event_id AS string)) END
           AS error_message
FROM events
""")

# Outbox rows; status by event type, retry_count = user_id % 8.
_fx("fx_outbox", """
SELECT concat('OB', cast(event_id AS string)) AS id, 'transfer' AS aggregate_type,
       concat('T', cast(event_id AS string)) AS aggregate_id, 'transfer.posted' AS event_type,
       CASE event_type WHEN 'error' THEN 'failed' WHEN 'click' THEN 'processing'
            WHEN 'purchase' THEN 'published' ELSE 'pending' END AS status,
       concat('{"k":', regexp_extract(props, '([0-9]+)', 1), '}') AS payload,
       '{}' AS headers, concat('C', cast(user_id AS string)) AS partition_key,
       cast(user_id % 8 AS int) AS retry_count,
       CASE WHEN event_type = 'error'
            THEN ts + cast(power(2, user_id % 8) AS bigint) * INTERVAL '1 second' END
           AS next_retry_at,
       ts AS created_at, ts AS updated_at
FROM events
""")

# Delivery results of one publish attempt.
_fx("fx_delivery", """
SELECT id, cast(substr(id, 3) AS bigint) % 3 <> 0 AS delivered,
       CASE WHEN cast(substr(id, 3) AS bigint) % 3 = 0 THEN 'BROKER_TIMEOUT' END AS error_code,
       CASE WHEN cast(substr(id, 3) AS bigint) % 3 = 0 THEN 'publish timed out' END AS error_message
FROM fx_outbox WHERE status = 'processing' OR cast(substr(id, 3) AS bigint) % 4 = 0
""")

# The journal lines as read at a later time: some deleted, some amounts changed.
_fx("fx_lines_after", """
SELECT id, journal_transaction_id, line_number, account_id, side,
       CASE WHEN journal_transaction_id LIKE 'J%'
                 AND cast(substr(journal_transaction_id, 2) AS bigint) % 333 = 0
            THEN cast(amount + cast(0.01 AS decimal(20,8)) AS decimal(20,8)) ELSE amount END
           AS amount,
       currency_code, balance_kind, metadata, created_at
FROM fx_lines
WHERE NOT (journal_transaction_id LIKE 'J%'
           AND cast(substr(journal_transaction_id, 2) AS bigint) % 500 = 0)
""")


# Queue messages as they arrive on the two intake topics.
_fx("fx_messages", """
SELECT hook_id AS message_id, 'withdrawal.webhook' AS topic, hook_id AS message_key, body AS value,
       received_at AS timestamp
FROM fx_callbacks
UNION ALL
SELECT concat('DM', cast(event_id AS string)), 'deposit.transfer', concat('U', cast(user_id AS string)),
       concat('{"provider":"paystack","external_reference":"DEP-', cast(event_id AS string),
              '","customer_id":"U', cast(user_id AS string), '","amount":"',
              cast(cast(value AS decimal(20,8)) AS string), '"}'),
       ts
FROM events WHERE event_type = 'signup'
""")


# The same callbacks arriving up to 29 hours later, so that some come after their hold has expired.
_fx("fx_late_callbacks", """
SELECT hook_id, provider, token, body, received_at + (src_event % 30) * INTERVAL '1 hour' AS received_at
FROM fx_callbacks
""")

# Hold events as they happen: creates (every tenth hold never expires), one or two moves an hour apart,
# some for more than is left, some after the expiry, some before the hold exists, some for unknown holds.
_fx("fx_hold_events", """
SELECT concat('H', cast(event_id AS string)) AS hold_id, 'create' AS action,
       cast(value AS decimal(20,8)) AS amount,
       CASE WHEN event_id % 10 <> 3 THEN ts + INTERVAL '24 hours' END AS expires_at,
       ts AS event_time, event_id * 10 AS seq
FROM events WHERE event_type = 'click'
UNION ALL
SELECT concat('H', cast(event_id AS string)), CASE WHEN event_id % 4 = 1 THEN 'release' ELSE 'consume' END,
       CASE WHEN event_id % 6 = 2 THEN cast(cast(value AS decimal(20,8)) + cast(1 AS decimal(20,8)) AS decimal(20,8))
            ELSE cast(value / 2 AS decimal(20,8)) END,
       cast(NULL AS {TS}),
       CASE WHEN event_id % 9 = 4 THEN ts + INTERVAL '24 hours' WHEN event_id % 9 = 5 THEN ts - INTERVAL '1 hour'
            ELSE ts + INTERVAL '1 hour' END,
       event_id * 10 + 1
FROM events WHERE event_type = 'click' AND event_id % 5 <> 0
UNION ALL
SELECT concat('H', cast(event_id AS string)), CASE WHEN event_id % 8 = 1 THEN 'consume' ELSE 'release' END,
       cast(0.01 AS decimal(20,8)), cast(NULL AS {TS}),
       CASE WHEN event_id % 3 = 0 THEN ts + INTERVAL '1 hour' ELSE ts + INTERVAL '30 hours' END, event_id * 10 + 2
FROM events WHERE event_type = 'click' AND event_id % 7 IN (1, 2, 3)
UNION ALL
SELECT concat('HX', cast(event_id AS string)), 'consume', cast(1 AS decimal(20,8)), cast(NULL AS {TS}), ts,
       event_id * 10 + 3
FROM events WHERE event_type = 'click' AND event_id % 50 = 7
""")

# Instants at which balances are asked for: half of them on the fee account, some before the first
# entry or in the currency of no entry, some without a time.
_fx("fx_probes", """
SELECT concat('P', cast(o_orderkey AS string)) AS probe_id,
       CASE WHEN o_orderkey % 2 = 0 THEN 'SYS_FEE' ELSE concat('C', cast(o_custkey AS string)) END AS account_id,
       CASE WHEN o_orderkey % 19 = 1 THEN 'EUR' ELSE 'NGN' END AS currency_code,
       CASE WHEN o_orderkey % 97 = 1 THEN cast(NULL AS {TS})
            WHEN o_orderkey % 50 = 3 THEN cast('1980-01-01 00:00:00' AS {TS})
            ELSE o_orderdate + (o_orderkey % 400) * INTERVAL '1 day' END AS at
FROM orders
""")

# The journal headers at an earlier time: some entries not there yet, others in another state.
_fx("fx_journal_before", """
SELECT id, transaction_ref, transfer_request_id, idempotency_key_id,
       CASE WHEN n % 7 = 0 AND status = 'posted' THEN 'pending' WHEN n % 11 = 0 AND status = 'pending' THEN 'posted'
            WHEN n % 17 = 0 AND status = 'failed' THEN 'posted' ELSE status END AS status,
       entry_type, accounting_date, effective_at, posted_at, source_system, source_event_id, metadata, created_at
FROM (SELECT *, cast(regexp_extract(id, '([0-9]+)', 1) AS bigint) AS n FROM fx_journal) j
WHERE n % 13 <> 5
""")

# Hold transition requests against fx_holds (consume / release, some repeated or unknown).
_fx("fx_hold_requests", """
SELECT concat('HR', cast(event_id AS string), 'a') AS request_id,
       concat('H', cast(event_id AS string)) AS hold_id,
       CASE WHEN event_id % 6 = 2
            THEN cast(cast(value AS decimal(20,8)) + cast(1 AS decimal(20,8)) AS decimal(20,8))
            ELSE cast(value / 2 AS decimal(20,8)) END AS amount,
       event_id * 10 AS seq,
       CASE WHEN event_id % 6 IN (1, 4) THEN 'release' ELSE 'consume' END AS action
FROM events WHERE event_type = 'click' AND event_id % 6 IN (0, 1, 2, 4)
UNION ALL
SELECT concat('HR', cast(event_id AS string), 'b'), concat('H', cast(event_id AS string)),
       cast(0.01 AS decimal(20,8)), event_id * 10 + 1,
       CASE WHEN event_id % 6 IN (1, 4) THEN 'release' ELSE 'consume' END
FROM events WHERE event_type = 'click' AND event_id % 12 IN (0, 1)
UNION ALL
SELECT concat('HR', cast(event_id AS string), 'x'), concat('HX', cast(event_id AS string)),
       cast(1 AS decimal(20,8)), event_id * 10 + 2, 'consume'
FROM events WHERE event_type = 'click' AND event_id % 50 = 7
""")

# Versioned projection updates: one per customer account, a second (chained) one for some.
_fx("fx_versions", """
SELECT concat('C', cast(c_custkey AS string)) AS account_id,
       CASE WHEN c_nationkey = 24 THEN 'USD' ELSE 'NGN' END AS currency_code,
       'available' AS balance_kind,
       cast(c_acctbal + 1000 AS decimal(20,8)) AS ledger_balance,
       cast(c_acctbal + 1000 AS decimal(20,8)) AS available_balance,
       cast(0 AS decimal(20,8)) AS held_balance,
       concat('J', cast(c_custkey AS string)) AS last_transaction_id,
       concat('L', cast(c_custkey AS string), '_1') AS last_line_id,
       cast(c_custkey % 5 AS bigint) AS expected_version,
       cast(c_custkey AS bigint) AS seq
FROM customer
UNION ALL
SELECT concat('C', cast(c_custkey AS string)),
       CASE WHEN c_nationkey = 24 THEN 'USD' ELSE 'NGN' END, 'available',
       cast(c_acctbal + 2000 AS decimal(20,8)), cast(c_acctbal + 2000 AS decimal(20,8)),
       cast(0 AS decimal(20,8)), concat('J2', cast(c_custkey AS string)),
       concat('L2', cast(c_custkey AS string), '_1'),
       cast(c_custkey % 5 + 1 AS bigint), cast(c_custkey AS bigint) + 1000000
FROM customer WHERE c_custkey % 13 = 0
""")

# Account creation requests: existing refs, new refs (some repeated), new refs reusing a number.
_fx("fx_account_requests", """
SELECT concat('AR', cast(c_custkey AS string)) AS request_id,
       concat('U', cast(c_custkey AS string)) AS customer_id,
       CASE WHEN c_custkey % 3 = 0 THEN concat('acct_C', cast(c_custkey AS string))
            ELSE concat('new_C', cast(c_custkey AS string)) END AS external_ref,
       CASE WHEN c_custkey % 10 = 2 THEN concat('1', lpad(cast(c_custkey AS string), 9, '0'))
            ELSE concat('9', lpad(cast(c_custkey AS string), 9, '0')) END AS account_number,
       'customer' AS account_type, 'active' AS status, 'NGN' AS currency_code,
       'credit' AS ledger_normal_side, '{}' AS metadata,
       cast(c_custkey AS bigint) AS seq
FROM customer
UNION ALL
SELECT concat('AR', cast(c_custkey AS string), 'dup'), concat('U', cast(c_custkey AS string)),
       concat('new_C', cast(c_custkey AS string)),
       concat('8', lpad(cast(c_custkey AS string), 9, '0')),
       'customer', 'active', 'NGN', 'credit', '{}', cast(c_custkey AS bigint) + 100000
FROM customer WHERE c_custkey % 9 = 1
UNION ALL
SELECT concat('AR', cast(c_custkey AS string), 'num'), concat('U', cast(c_custkey AS string)),
       concat('other_C', cast(c_custkey AS string)),
       concat('9', lpad(cast(c_custkey - 3 AS string), 9, '0')),
       'customer', 'active', 'NGN', 'credit', '{}', cast(c_custkey AS bigint) + 200000
FROM customer WHERE c_custkey % 21 = 4
""")

# The internal side of reconciliation: posted transfers with the bank they settle at.
_fx("fx_internal", """
SELECT CASE WHEN o_orderkey % 2 = 0 THEN 'bank_a' ELSE 'bank_b' END AS source_system,
       cast(date_trunc('month', o_orderdate) AS date) AS statement_date,
       concat('EXT', cast(o_orderkey AS string)) AS external_reference, 'NGN' AS currency_code,
       cast(o_totalprice AS decimal(20,8)) AS amount,
       concat('J', cast(o_orderkey AS string)) AS journal_transaction_id,
       concat('L', cast(o_orderkey AS string), '_2') AS journal_line_id
FROM orders WHERE o_orderstatus = 'F'
""")


# Customer creation requests: existing refs, new refs, repeated new refs.
_fx("fx_customer_requests", """
SELECT concat('CR', cast(c_custkey AS string)) AS request_id,
       CASE WHEN c_custkey % 2 = 0 THEN concat('cust_', cast(c_custkey AS string))
            ELSE concat('newcust_', cast(c_custkey % 700 AS string)) END AS external_ref,
       c_name AS full_name, concat('new', cast(c_custkey AS string), '@x.test') AS email,
       'active' AS status, '{}' AS metadata, cast(c_custkey AS bigint) AS seq
FROM customer
""")


# The constrained columns of every table, with rows that repeat each unique key ('~d') and rows whose
# references lead nowhere ('~o').
_fx("fx_cat_customers", """
SELECT id, external_ref, email, phone, national_id FROM fx_customers
UNION ALL SELECT concat(id, '~d'), external_ref, upper(email), '0800', 'N1' FROM fx_customers WHERE id LIKE '%7'
""")
_fx("fx_cat_accounts", """
SELECT id, customer_id, external_ref, account_number FROM fx_accounts
UNION ALL SELECT concat(id, '~d'), 'NOBODY', external_ref, account_number FROM fx_accounts WHERE id LIKE '%9'
""")
_fx("fx_cat_idempotency_keys", """
SELECT id, scope, idempotency_key FROM fx_idem_keys
UNION ALL SELECT concat(id, '~d'), scope, idempotency_key FROM fx_idem_keys WHERE id LIKE '%3'
UNION ALL SELECT idempotency_key_id, 'transfer', id FROM fx_transfers WHERE id NOT LIKE '%44'
""")
_fx("fx_cat_transfer_requests", """
SELECT id, idempotency_key_id, customer_id, source_account_id, destination_account_id, client_reference,
       external_reference FROM fx_transfers
UNION ALL SELECT concat(id, '~d'), idempotency_key_id, customer_id, source_account_id, destination_account_id,
       client_reference, external_reference FROM fx_transfers WHERE id LIKE '%5'
UNION ALL SELECT concat(id, '~o'), concat('NK', id), 'NOBODY', 'NOWHERE', 'NOWHERE', NULL, NULL
FROM fx_transfers WHERE id LIKE '%1'
""")
_fx("fx_cat_journal_transactions", """
SELECT id, transaction_ref, transfer_request_id, idempotency_key_id, cast(NULL AS string) AS reversed_transaction_id,
       cast(NULL AS string) AS reversal_of_transaction_id, source_system, source_event_id FROM fx_journal
UNION ALL SELECT concat(id, '~d'), transaction_ref, transfer_request_id, idempotency_key_id, id, id, source_system,
       source_event_id FROM fx_journal WHERE id LIKE '%5'
UNION ALL SELECT concat(id, '~o'), concat('o', transaction_ref), 'NOTHING', concat('NK', id), 'NOTHING', concat('RV', id),
       source_system, NULL FROM fx_journal WHERE id LIKE '%1'
""")
_fx("fx_cat_journal_lines", """
SELECT id, journal_transaction_id, line_number, account_id FROM fx_lines
UNION ALL SELECT concat(id, '~d'), journal_transaction_id, line_number, account_id FROM fx_lines WHERE id LIKE '%7_1'
UNION ALL SELECT concat(id, '~o'), concat('NJ', id), line_number, 'NOWHERE' FROM fx_lines WHERE id LIKE '%2_1'
""")
_fx("fx_cat_funds_holds", """
SELECT id, account_id, transfer_request_id, journal_transaction_id, idempotency_key_id FROM fx_holds
UNION ALL SELECT concat(id, '~d'), account_id, cast(NULL AS string), cast(NULL AS string), idempotency_key_id FROM fx_holds
WHERE id LIKE '%4'
UNION ALL SELECT concat(id, '~o'), 'NOWHERE', 'NOTHING', 'NOTHING', concat('NK', id) FROM fx_holds WHERE id LIKE '%6'
""")
_fx("fx_cat_balance_projections", """
SELECT concat(account_id, currency_code) AS id, account_id, currency_code, balance_kind,
       cast(NULL AS string) AS last_transaction_id, cast(NULL AS string) AS last_line_id FROM fx_projections
UNION ALL SELECT concat(account_id, '~d'), account_id, currency_code, balance_kind, 'NOTHING', 'NOTHING' FROM fx_projections
WHERE account_id LIKE '%2'
UNION ALL SELECT concat(account_id, '~o'), concat('NO', account_id), currency_code, balance_kind, cast(NULL AS string),
       cast(NULL AS string) FROM fx_projections WHERE account_id LIKE '%3'
""")
_fx("fx_cat_outbox_events", """
SELECT id, CASE WHEN id LIKE '%1' THEN 'NOKEY' WHEN id LIKE '%2' THEN concat('K', substr(id, 3)) END AS idempotency_key_id
FROM fx_outbox
""")
_fx("fx_cat_reconciliation_batches", """
SELECT DISTINCT concat(source_system, cast(statement_date AS string)) AS id FROM fx_statement WHERE source_system <> 'bank_b'
""")
_fx("fx_cat_reconciliation_items", """
SELECT statement_line_id AS id, concat(source_system, cast(statement_date AS string)) AS reconciliation_batch_id,
       external_reference, concat('J', substr(external_reference, 4)) AS journal_transaction_id,
       concat('L', substr(external_reference, 4), '_9') AS journal_line_id FROM fx_statement
UNION ALL SELECT concat(statement_line_id, '~d'), concat(source_system, cast(statement_date AS string)), external_reference,
       'NOTHING', cast(NULL AS string) FROM fx_statement WHERE statement_line_id LIKE '%3'
""")


# Tables whose rows break their domain rules one after the other.
_fx("fx_dom_keys", """
SELECT id, CASE WHEN id LIKE '%11' THEN ' ' WHEN id LIKE '%12' THEN NULL ELSE idempotency_key END AS idempotency_key,
       CASE WHEN id LIKE '%13' THEN '' WHEN id LIKE '%14' THEN NULL ELSE scope END AS scope,
       CASE WHEN id LIKE '%15' THEN NULL ELSE request_hash END AS request_hash, created_at,
       CASE WHEN id LIKE '%16' THEN created_at WHEN id LIKE '%17' THEN NULL ELSE expires_at END AS expires_at
FROM fx_idem_keys
""")
_fx("fx_dom_journal", """
SELECT id, CASE WHEN id LIKE '%11' THEN NULL ELSE transaction_ref END AS transaction_ref,
       CASE WHEN id LIKE '%21' THEN NULL ELSE idempotency_key_id END AS idempotency_key_id,
       CASE WHEN id LIKE '%31' THEN NULL WHEN id LIKE '%41' THEN 'done' ELSE status END AS status,
       CASE WHEN id LIKE '%51' THEN NULL WHEN id LIKE '%61' THEN ' ' ELSE entry_type END AS entry_type,
       CASE WHEN id LIKE '%71' THEN NULL WHEN id LIKE '%81' THEN '' ELSE source_system END AS source_system,
       CASE WHEN id LIKE '%91' THEN '[1]' WHEN id LIKE '%05' THEN NULL ELSE metadata END AS metadata,
       CASE WHEN id LIKE '%15' THEN id WHEN id LIKE '%25' THEN 'J1' END AS reversed_transaction_id,
       CASE WHEN id LIKE '%35' THEN id WHEN id LIKE '%45' THEN 'J1' END AS reversal_of_transaction_id
FROM fx_journal
""")
_fx("fx_dom_projections", """
SELECT concat('B', account_id) AS id, CASE WHEN account_id LIKE '%1' THEN NULL ELSE account_id END AS account_id,
       CASE WHEN account_id LIKE '%2' THEN 'ngn' WHEN account_id LIKE '%3' THEN NULL ELSE currency_code END AS currency_code,
       CASE WHEN account_id LIKE '%4' THEN 'spare' WHEN account_id LIKE '%5' THEN NULL ELSE balance_kind END AS balance_kind,
       CASE WHEN account_id LIKE '%6' THEN cast(-1 AS decimal(20,8)) ELSE ledger_balance END AS ledger_balance,
       CASE WHEN account_id LIKE '%7' THEN cast(available_balance + cast(1 AS decimal(20,8)) AS decimal(20,8)) ELSE available_balance END
         AS available_balance, held_balance
FROM fx_projections
""")
_fx("fx_dom_outbox", """
SELECT id, CASE WHEN id LIKE '%11' THEN NULL WHEN id LIKE '%12' THEN ' ' ELSE aggregate_type END AS aggregate_type,
       CASE WHEN id LIKE '%13' THEN NULL ELSE aggregate_id END AS aggregate_id,
       CASE WHEN id LIKE '%14' THEN NULL WHEN id LIKE '%15' THEN '' ELSE event_type END AS event_type,
       CASE WHEN id LIKE '%16' THEN NULL WHEN id LIKE '%17' THEN 'lost' ELSE status END AS status,
       CASE WHEN id LIKE '%18' THEN NULL WHEN id LIKE '%19' THEN '[]' ELSE payload END AS payload,
       CASE WHEN id LIKE '%21' THEN 'no json' ELSE headers END AS headers,
       CASE WHEN id LIKE '%22' THEN -1 ELSE retry_count END AS retry_count
FROM fx_outbox
""")
_fx("fx_dom_webhooks", """
SELECT id, CASE WHEN id LIKE '%11' THEN NULL WHEN id LIKE '%12' THEN ' ' ELSE provider END AS provider,
       CASE WHEN id LIKE '%13' THEN NULL ELSE payload END AS payload, CASE WHEN id LIKE '%14' THEN '3' ELSE headers END AS headers
FROM fx_webhooks
""")
_fx("fx_dom_audit", """
SELECT concat('AU', cast(event_id AS string)) AS id,
       CASE event_id % 40 WHEN 1 THEN NULL WHEN 2 THEN '' ELSE 'system' END AS actor_type,
       CASE event_id % 40 WHEN 3 THEN NULL WHEN 4 THEN 'guess' WHEN 5 THEN 'reverse' ELSE 'update' END AS action,
       CASE event_id % 40 WHEN 6 THEN NULL WHEN 7 THEN ' ' ELSE 'journal_lines' END AS entity_type,
       CASE event_id % 40 WHEN 8 THEN '[]' WHEN 9 THEN NULL ELSE '{}' END AS metadata,
       CASE event_id % 40 WHEN 10 THEN '1' WHEN 11 THEN NULL ELSE '{"a":1}' END AS before_state,
       CASE event_id % 40 WHEN 12 THEN 'x' WHEN 13 THEN NULL ELSE '{"a":2}' END AS after_state,
       CASE event_id % 40 WHEN 14 THEN '"a"' WHEN 15 THEN NULL ELSE '{"a":{}}' END AS diff
FROM events
""")
_fx("fx_dom_batches", """
SELECT concat('RB', cast(o_orderkey AS string)) AS id,
       CASE o_orderkey % 30 WHEN 1 THEN NULL WHEN 2 THEN '' ELSE 'bank' END AS source_system,
       CASE o_orderkey % 30 WHEN 3 THEN NULL WHEN 4 THEN 'open' ELSE 'pending' END AS status,
       CASE o_orderkey % 30 WHEN 5 THEN '[]' ELSE '{}' END AS metadata,
       cast(CASE o_orderkey % 30 WHEN 6 THEN -1 ELSE 5 END AS decimal(20,8)) AS expected_total_amount,
       cast(CASE o_orderkey % 30 WHEN 7 THEN -1 ELSE 5 END AS decimal(20,8)) AS matched_total_amount,
       cast(CASE o_orderkey % 30 WHEN 0 THEN -1 ELSE 5 END AS decimal(20,8)) AS mismatch_total_amount,
       cast(CASE o_orderkey % 30 WHEN 3 THEN -1 ELSE 1 END AS int) AS expected_total_count,
       cast(CASE o_orderkey % 30 WHEN 2 THEN -1 ELSE 1 END AS int) AS matched_total_count, 0 AS mismatch_total_count
FROM orders
""")
_fx("fx_dom_items", """
SELECT concat('RI', cast(o_orderkey AS string)) AS id,
       CASE o_orderkey % 30 WHEN 1 THEN NULL ELSE 'RB1' END AS reconciliation_batch_id,
       CASE o_orderkey % 30 WHEN 2 THEN NULL WHEN 3 THEN 'ng' ELSE 'NGN' END AS currency_code,
       cast(CASE o_orderkey % 30 WHEN 4 THEN NULL WHEN 5 THEN 0 ELSE 5 END AS decimal(20,8)) AS amount,
       CASE o_orderkey % 30 WHEN 6 THEN NULL WHEN 7 THEN 'lost' ELSE 'matched' END AS status,
       cast(CASE o_orderkey % 30 WHEN 0 THEN -1 ELSE 5 END AS decimal(20,8)) AS matched_amount,
       cast(CASE o_orderkey % 30 WHEN 1 THEN -1 ELSE 0 END AS decimal(20,8)) AS variance_amount,
       CASE o_orderkey % 30 WHEN 2 THEN NULL WHEN 3 THEN '{' ELSE '{}' END AS metadata
FROM orders
""")


def render(sql: str, dialect: str) -> str:
    ts = "timestamp_ntz" if dialect == "spark" else "timestamp"
    out = sql.replace("{TS}", ts)
    if dialect != "spark":
        # SHA-256 hex: sha2(x, 256) in Spark, sha256(x) in DuckDB.
        out = re.sub(r"sha2\(([^()]*(?:\([^()]*\))?[^()]*), 256\)", r"sha256(\1)", out)
    return out


def _closure(names: list[str]) -> list[str]:
    """Fixtures in dependency order, including what the given ones read."""
    out: list[str] = []

    def visit(n: str) -> None:
        if n in out:
            return
        for d in DEPS[n]:
            visit(d)
        out.append(n)

    for n in names:
        visit(n)
    return out


def with_fixtures(body: str, dialect: str = "duckdb") -> str:
    """Prefix ``body`` with the CTEs of every fixture it mentions."""
    used = sorted(set(re.findall(r"\b(fx_\w+)\b", body)) & set(FIXTURES))
    names = _closure(used)
    if not names:
        return render(body, dialect)
    ctes = ",\n".join(f"{n} AS (\n{FIXTURES[n]}\n)" for n in names)
    stripped = body.lstrip()
    if stripped[:15].upper() == "WITH RECURSIVE ":
        return render(f"WITH RECURSIVE {ctes},\n{stripped[15:]}", dialect)
    if stripped[:5].upper() == "WITH ":
        return render(f"WITH {ctes},\n{stripped[5:]}", dialect)
    return render(f"WITH {ctes}\n{body}", dialect)


def register_base(spark: SparkSession, sf_dir: str) -> None:
    for t in BASE_TABLES:
        spark.read.parquet(f"{sf_dir}/{t}.parquet").createOrReplaceTempView(t)


_MATERIALIZED: dict[tuple[str, str], str] = {}


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The fixture as a Spark DataFrame (plan analysed now, so later view swaps do not leak).

    A fixture materialised by ``materialize`` is read back from its parquet copy.
    """
    path = _MATERIALIZED.get((sf_dir, name))
    if path is not None:
        return spark.read.parquet(path)
    register_base(spark, sf_dir)
    return spark.sql(with_fixtures(f"SELECT * FROM {name}", dialect="spark"))


def materialize(spark: SparkSession, sf_dir: str, where: str,
                names: list[str] | None = None) -> None:
    """Write the fixtures once as parquet tables under ``where`` and serve them from there —
    the ledger tables at rest, as a production job would read them (used by the benchmark)."""
    for n in names or list(FIXTURES):
        path = f"{where}/{n}"
        fixture(spark, sf_dir, n).write.mode("overwrite").parquet(path)
        _MATERIALIZED[(sf_dir, n)] = path
