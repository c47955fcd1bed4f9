"""Declared schemas of the ledger tables (never inferred).

Ids are strings (deterministic business-key ids, never random), money is
``decimal(20,8)``, timestamps are ``timestamp_ntz`` in UTC wall time, JSON
objects are JSON text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(20, 8)
# Sums of money keep scale 8 but get the widest precision.
TOTAL = T.DecimalType(38, 8)
TS = T.TimestampNTZType()

_TYPES = {
    "s": T.StringType(), "m": MONEY, "t": TS, "d": T.DateType(), "i": T.IntegerType(),
    "l": T.LongType(), "b": T.BooleanType(),
}


def _schema(spec: str) -> T.StructType:
    """``"id:s customer_id:s amount:m"`` → StructType (all nullable; NOT NULL is checked by C1/C2)."""
    fields = []
    for item in spec.split():
        name, code = item.split(":")
        fields.append(T.StructField(name, _TYPES[code], True))
    return T.StructType(fields)


CUSTOMERS = _schema(
    "id:s external_ref:s full_name:s email:s phone:s national_id:s status:s metadata:s "
    "created_at:t updated_at:t deleted_at:t")
ACCOUNTS = _schema(
    "id:s customer_id:s external_ref:s account_number:s account_type:s status:s currency_code:s "
    "ledger_normal_side:s metadata:s opened_at:t closed_at:t created_at:t updated_at:t deleted_at:t")
IDEMPOTENCY_KEYS = _schema(
    "id:s idempotency_key:s scope:s request_hash:s response_code:i response_body:s locked_at:t "
    "expires_at:t created_at:t updated_at:t")
TRANSFER_REQUESTS = _schema(
    "id:s idempotency_key_id:s customer_id:s source_account_id:s destination_account_id:s "
    "currency_code:s amount:m fee_amount:m status:s client_reference:s external_reference:s "
    "failure_code:s failure_reason:s metadata:s requested_at:t reserved_at:t submitted_at:t "
    "posted_at:t rejected_at:t cancelled_at:t expired_at:t failed_at:t created_at:t updated_at:t "
    "deleted_at:t")
JOURNAL_TRANSACTIONS = _schema(
    "id:s transaction_ref:s transfer_request_id:s idempotency_key_id:s status:s entry_type:s "
    "accounting_date:d effective_at:t posted_at:t reversed_transaction_id:s "
    "reversal_of_transaction_id:s source_system:s source_event_id:s description:s metadata:s "
    "created_at:t updated_at:t deleted_at:t")
JOURNAL_LINES = _schema(
    "id:s journal_transaction_id:s line_number:i account_id:s side:s amount:m currency_code:s "
    "balance_kind:s memo:s metadata:s created_at:t")
FUNDS_HOLDS = _schema(
    "id:s account_id:s transfer_request_id:s journal_transaction_id:s idempotency_key_id:s "
    "status:s currency_code:s amount:m remaining_amount:m released_amount:m captured_amount:m "
    "reason_code:s reason:s expires_at:t captured_at:t released_at:t cancelled_at:t created_at:t "
    "updated_at:t deleted_at:t")
BALANCE_PROJECTIONS = _schema(
    "id:s account_id:s currency_code:s balance_kind:s ledger_balance:m available_balance:m "
    "held_balance:m last_transaction_id:s last_line_id:s version:l computed_at:t created_at:t "
    "updated_at:t")
OUTBOX_EVENTS = _schema(
    "id:s aggregate_type:s aggregate_id:s event_type:s status:s idempotency_key_id:s payload:s "
    "headers:s partition_key:s published_at:t retry_count:i next_retry_at:t error_code:s "
    "error_message:s created_at:t updated_at:t")
INCOMING_WEBHOOKS = _schema(
    "id:s provider:s external_event_id:s event_type:s payload:s headers:s status:s "
    "processed_at:t error_message:s created_at:t updated_at:t")
AUDIT_LOGS = _schema(
    "id:s actor_type:s actor_id:s action:s entity_type:s entity_id:s before_state:s after_state:s "
    "diff:s request_id:s correlation_id:s metadata:s created_at:t")
RECONCILIATION_BATCHES = _schema(
    "id:s source_system:s source_file_name:s source_reference:s status:s statement_date:d "
    "expected_total_amount:m expected_total_count:i matched_total_amount:m matched_total_count:i "
    "mismatch_total_amount:m mismatch_total_count:i started_at:t finished_at:t metadata:s "
    "created_at:t updated_at:t")
RECONCILIATION_ITEMS = _schema(
    "id:s reconciliation_batch_id:s journal_transaction_id:s journal_line_id:s "
    "external_reference:s status:s currency_code:s amount:m matched_amount:m variance_amount:m "
    "variance_reason:s matched_at:t metadata:s created_at:t updated_at:t")

TABLES = {
    "customers": CUSTOMERS,
    "accounts": ACCOUNTS,
    "idempotency_keys": IDEMPOTENCY_KEYS,
    "transfer_requests": TRANSFER_REQUESTS,
    "journal_transactions": JOURNAL_TRANSACTIONS,
    "journal_lines": JOURNAL_LINES,
    "funds_holds": FUNDS_HOLDS,
    "balance_projections": BALANCE_PROJECTIONS,
    "outbox_events": OUTBOX_EVENTS,
    "incoming_webhooks": INCOMING_WEBHOOKS,
    "audit_logs": AUDIT_LOGS,
    "reconciliation_batches": RECONCILIATION_BATCHES,
    "reconciliation_items": RECONCILIATION_ITEMS,
}

# Fixed values of the reference's data model (enum domains, seeds, limits).
ENUMS = {
    "customer_status": ["active", "suspended", "closed"],
    "account_type": ["system", "settlement", "fee", "customer"],
    "account_status": ["pending", "active", "frozen", "closed"],
    "transfer_request_status": ["pending", "reversed", "posted", "failed"],
    "journal_transaction_status": ["pending", "posted", "reversed", "voided", "failed"],
    "journal_line_side": ["debit", "credit"],
    "hold_status": ["active", "released", "consumed", "expired"],
    "outbox_status": ["pending", "processing", "published", "failed", "dead_letter"],
    "audit_action": ["insert", "update", "delete", "status_change", "reconcile", "reverse",
                     "void", "adjust"],
    "reconciliation_status": ["pending", "matched", "mismatch", "reviewed", "resolved", "closed"],
    "reconciliation_item_status": ["pending", "matched", "exception"],
    "ledger_balance_kind": ["ledger", "available", "held"],
}

# Seeded system customer and accounts (external_ref, account_number, type, normal side), NGN.
SYSTEM_CUSTOMER_REF = "system_customer"
SYSTEM_ACCOUNTS = [
    ("system_cash_ngn", "0000000001", "system", "debit"),
    ("system_settlement_ngn", "0000000002", "settlement", "credit"),
    ("system_fee_revenue_ngn", "0000000003", "fee", "credit"),
    ("external_bank_ngn", "0000000005", "customer", "debit"),
]
SYSTEM_CURRENCY = "NGN"

# Topic names (one constant; the reference created one spelling and used another).
TOPIC_DEPOSIT = "deposit.transfer"
TOPIC_WITHDRAWAL_WEBHOOK = "withdrawal.webhook"


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project onto ``schema``: cast present columns, add absent ones as typed nulls."""
    have = set(df.columns)
    return df.select([
        (F.col(f.name).cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType))
        .alias(f.name) for f in schema.fields])
