"""Registered versioned-upsert and get-or-create queries (E5, F12) with their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallybook.operators import projections as PJ
from tallybook.plans.fixtures import NOW
from tallybook.plans.inputs import Inputs
from tallybook.plans.registry import register

# Chains of at most two updates per key in the fixture; the oracle spells both steps out.
_UPSERT = f"""
WITH u AS (SELECT *, row_number() OVER (PARTITION BY account_id, currency_code, balance_kind
                                        ORDER BY seq) AS k FROM fx_versions),
u1 AS (SELECT * FROM u WHERE k = 1), u2 AS (SELECT * FROM u WHERE k = 2),
s AS (SELECT * FROM fx_projections),
j AS (SELECT COALESCE(s.account_id, u1.account_id) AS account_id,
             COALESCE(s.currency_code, u1.currency_code) AS currency_code,
             COALESCE(s.balance_kind, u1.balance_kind) AS balance_kind,
             s.version AS v0, s.ledger_balance AS s_ledger, s.computed_at AS s_at,
             u1.seq AS seq1, u1.expected_version AS e1, u1.ledger_balance AS l1,
             u2.seq AS seq2, u2.expected_version AS e2, u2.ledger_balance AS l2
      FROM s FULL OUTER JOIN u1 ON s.account_id = u1.account_id
        AND s.currency_code = u1.currency_code AND s.balance_kind = u1.balance_kind
      LEFT JOIN u2 ON u2.account_id = COALESCE(s.account_id, u1.account_id)
        AND u2.currency_code = COALESCE(s.currency_code, u1.currency_code)
        AND u2.balance_kind = COALESCE(s.balance_kind, u1.balance_kind)),
a AS (SELECT *, seq1 IS NOT NULL AND (v0 IS NULL OR e1 = v0) AS ok1 FROM j),
b AS (SELECT *, CASE WHEN ok1 THEN COALESCE(v0, 0) + 1 ELSE v0 END AS v1 FROM a),
c AS (SELECT *, seq2 IS NOT NULL AND (v1 IS NULL OR e2 = v1) AS ok2 FROM b)
"""


@register("upsert_expected_version", oracle=_UPSERT + f"""
SELECT account_id, currency_code, balance_kind,
       CASE WHEN ok2 THEN l2 WHEN ok1 THEN l1 ELSE s_ledger END AS ledger_balance,
       CASE WHEN ok2 THEN v1 + 1 ELSE v1 END AS version,
       CASE WHEN ok1 OR ok2 THEN cast('{NOW}' AS timestamp) ELSE s_at END AS computed_at
FROM c
""")
def q_upsert_expected_version(spark, d):
    x = Inputs(spark, d)
    out, _ = PJ.upsert_expected_version(x.projections, x.raw("fx_versions"), NOW)
    return out.select("account_id", "currency_code", "balance_kind", "ledger_balance", "version",
                      "computed_at")


@register("upsert_expected_version_conflicts", oracle=_UPSERT + """
SELECT account_id, currency_code, balance_kind, seq1 AS seq, e1 AS expected_version
FROM c WHERE seq1 IS NOT NULL AND NOT ok1
UNION ALL
SELECT account_id, currency_code, balance_kind, seq2, e2 FROM c WHERE seq2 IS NOT NULL AND NOT ok2
""")
def q_upsert_conflicts(spark, d):
    x = Inputs(spark, d)
    _, conflicts = PJ.upsert_expected_version(x.projections, x.raw("fx_versions"), NOW)
    return conflicts.select("account_id", "currency_code", "balance_kind", "seq",
                            "expected_version")


_GOC = """
WITH r AS (SELECT q.*, a1.id AS by_ref, a2.id AS by_num FROM fx_account_requests q
           LEFT JOIN fx_accounts a1 ON a1.external_ref = q.external_ref
           LEFT JOIN fx_accounts a2 ON a2.account_number = q.account_number),
known AS (SELECT request_id, COALESCE(by_ref, by_num) AS account_id, false AS created
          FROM r WHERE COALESCE(by_ref, by_num) IS NOT NULL),
n AS (SELECT * FROM r WHERE COALESCE(by_ref, by_num) IS NULL),
rw AS (SELECT external_ref, arg_min(request_id, seq) AS ref_winner FROM n GROUP BY external_ref),
nw AS (SELECT n.* FROM n JOIN rw ON rw.ref_winner = n.request_id),
numw AS (SELECT account_number, arg_min(request_id, seq) AS num_req,
                arg_min(external_ref, seq) AS num_ref FROM nw GROUP BY account_number),
target AS (SELECT nw.request_id AS ref_winner, concat('A:', numw.num_ref) AS account_id,
                  nw.request_id = numw.num_req AS is_final
           FROM nw JOIN numw ON numw.account_number = nw.account_number),
resolved AS (SELECT n.request_id, t.account_id,
                    n.request_id = t.ref_winner AND t.is_final AS created
             FROM n JOIN rw ON rw.external_ref = n.external_ref
             JOIN target t ON t.ref_winner = rw.ref_winner)
"""


@register("get_or_create_accounts", oracle=_GOC + """
SELECT * FROM known UNION ALL SELECT * FROM resolved
""")
def q_get_or_create_accounts(spark, d):
    x = Inputs(spark, d)
    return PJ.get_or_create_accounts(x.accounts, x.raw("fx_account_requests"), NOW)["results"]


@register("get_or_create_accounts_new", oracle=_GOC + """
SELECT t.account_id AS id, nw.external_ref, nw.account_number, 'active' AS status
FROM target t JOIN nw ON nw.request_id = t.ref_winner WHERE t.is_final
""")
def q_get_or_create_accounts_new(spark, d):
    x = Inputs(spark, d)
    out = PJ.get_or_create_accounts(x.accounts, x.raw("fx_account_requests"), NOW)["accounts"]
    return out.filter(F.col("id").startswith("A:")).select("id", "external_ref",
                                                           "account_number", "status")


@register("get_or_create_customers", oracle="""
WITH r AS (SELECT q.*, c.id AS cid FROM fx_customer_requests q
           LEFT JOIN fx_customers c ON c.external_ref = q.external_ref),
w AS (SELECT external_ref, arg_min(request_id, seq) AS win FROM r WHERE cid IS NULL
      GROUP BY external_ref)
SELECT request_id, cid AS customer_id, false AS created FROM r WHERE cid IS NOT NULL
UNION ALL
SELECT r.request_id, concat('U:', r.external_ref), r.request_id = w.win
FROM r JOIN w ON w.external_ref = r.external_ref WHERE r.cid IS NULL
""")
def q_get_or_create_customers(spark, d):
    x = Inputs(spark, d)
    return PJ.get_or_create_customers(x.customers, x.raw("fx_customer_requests"),
                                      NOW)["results"]


@register("seed_system_accounts", oracle="""
SELECT id, external_ref, account_type FROM fx_accounts
WHERE external_ref NOT IN ('system_settlement_ngn')
UNION ALL SELECT 'A:system_settlement_ngn', 'system_settlement_ngn', 'settlement'
""")
def q_seed_system_accounts(spark, d):
    """Seeds into a ledger that lacks the settlement account: only that one is added."""
    x = Inputs(spark, d)
    acc = x.accounts.filter(F.col("external_ref") != "system_settlement_ngn")
    _, accounts = PJ.seed_system(x.customers, acc, NOW)
    return accounts.select("id", "external_ref", "account_type")
