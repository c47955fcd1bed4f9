"""Validation: constraints, triggers and business rules as data-quality jobs.

Every check returns ``(valid, violations)``; violations have the columns
``rule, table_name, key, detail``. Rules are Column expressions evaluated in
one projection (``inline`` of an array of (rule, ok) structs), so a table is
scanned once however many rules it has.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.functions.text import json_is_object
from tallybook.schemas import ENUMS
from tallybook.session import BROADCAST_ROWS, stage

VIOLATION_COLS = ["rule", "table_name", "key", "detail"]

# Required request fields per request kind (the reference's handler checks).
REQUIRED_FIELDS = {
    "deposit": ["provider", "idempotency_key_id", "customer_id", "destination_account_id",
                "currency_code", "source_system", "amount", "fee_amount", "client_reference",
                "external_reference"],
    "withdrawal": ["idempotency_key_id", "customer_id", "destination_account_id", "currency_code",
                   "source_system", "amount", "fee_amount", "client_reference",
                   "external_reference"],
    "transfer": ["idempotency_key_id", "customer_id", "source_account_id",
                 "destination_account_id", "currency_code", "description"],
    "account": ["external_ref", "account_number", "customer_id", "account_type", "currency_code",
                "ledger_normal_side"],
    "user": ["external_ref", "full_name", "email"],
}

CURRENCY_PATTERN = "^[A-Z]{3}$"


def _empty(c: Column) -> Column:
    return c.isNull() | (c.cast("string") == "")


def check_required(df: DataFrame, kind: str, key: str = "request_id") -> tuple[DataFrame, DataFrame]:
    """Missing required fields per request kind (null or empty text counts as missing)."""
    fields = REQUIRED_FIELDS[kind]
    have = set(df.columns)
    flags = [F.when(_empty(F.col(f)) if f in have else F.lit(True), F.lit(f)) for f in fields]
    x = df.withColumn("_missing", F.filter(F.array(*flags), lambda v: v.isNotNull()))
    valid = x.filter(F.size("_missing") == 0).drop("_missing")
    bad = x.filter(F.size("_missing") > 0).select(
        F.lit("required").alias("rule"), F.lit(kind).alias("table_name"),
        F.col(key).cast("string").alias("key"),
        F.concat(F.lit("missing: "), F.array_join("_missing", ", ")).alias("detail"))
    return valid, bad


def _not_blank(c: str) -> Column:
    return F.length(F.trim(F.col(c))) > 0


def _in(c: str, enum: str) -> Column:
    return F.col(c).isin(ENUMS[enum])


def _currency(c: str = "currency_code") -> Column:
    return F.col(c).rlike(CURRENCY_PATTERN)


def _nonneg(*cs: str) -> Column:
    out = None
    for c in cs:
        e = F.col(c) >= 0
        out = e if out is None else out & e
    return out


def domain_rules(table: str) -> list[tuple[str, Column]]:
    """(rule name, ok-expression) pairs: the CHECK constraints, NOT NULLs and enum domains.

    A null ``ok`` (comparison with null) counts as passing, as in SQL CHECK constraints;
    NOT NULL rules are explicit.
    """
    nn = lambda *cs: [(f"{c}_not_null", F.col(c).isNotNull()) for c in cs]
    if table == "customers":
        return nn("external_ref", "full_name", "status", "metadata") + [
            ("status_domain", _in("status", "customer_status")),
            ("metadata_is_object", json_is_object("metadata"))]
    if table == "accounts":
        return nn("customer_id", "external_ref", "account_number", "account_type", "status",
                  "currency_code", "ledger_normal_side", "metadata") + [
            ("currency_code_check", _currency()),
            ("account_type_domain", _in("account_type", "account_type")),
            ("status_domain", _in("status", "account_status")),
            ("normal_side_domain", _in("ledger_normal_side", "journal_line_side")),
            ("metadata_is_object", json_is_object("metadata")),
            ("closed_at_requires_closed",
             (F.col("closed_at").isNull() & (F.col("status") != "closed"))
             | F.col("closed_at").isNotNull())]
    if table == "idempotency_keys":
        return nn("idempotency_key", "scope", "request_hash", "expires_at") + [
            ("scope_not_blank", _not_blank("scope")),
            ("key_not_blank", _not_blank("idempotency_key")),
            ("expires_future", F.col("expires_at") > F.col("created_at"))]
    if table == "transfer_requests":
        return nn("idempotency_key_id", "customer_id", "source_account_id",
                  "destination_account_id", "currency_code", "amount", "fee_amount", "status") + [
            ("amount_positive", F.col("amount") > 0),
            ("fee_nonnegative", F.col("fee_amount") >= 0),
            ("currency_code_check", _currency()),
            ("status_domain", _in("status", "transfer_request_status")),
            ("metadata_is_object", json_is_object("metadata")),
            ("distinct_accounts", F.col("source_account_id") != F.col("destination_account_id"))]
    if table == "journal_transactions":
        return nn("transaction_ref", "idempotency_key_id", "status", "entry_type",
                  "source_system") + [
            ("status_domain", _in("status", "journal_transaction_status")),
            ("metadata_is_object", json_is_object("metadata")),
            ("entry_type_not_blank", _not_blank("entry_type")),
            ("source_system_not_blank", _not_blank("source_system")),
            ("distinct_reversal", F.col("reversed_transaction_id").isNull()
             | (F.col("reversed_transaction_id") != F.col("id"))),
            ("distinct_reversal_of", F.col("reversal_of_transaction_id").isNull()
             | (F.col("reversal_of_transaction_id") != F.col("id")))]
    if table == "journal_lines":
        return nn("journal_transaction_id", "line_number", "account_id", "side", "amount",
                  "currency_code", "balance_kind") + [
            ("amount_positive", F.col("amount") > 0),
            ("currency_code_check", _currency()),
            ("side_domain", _in("side", "journal_line_side")),
            ("balance_kind_domain", _in("balance_kind", "ledger_balance_kind")),
            ("metadata_is_object", json_is_object("metadata"))]
    if table == "funds_holds":
        return nn("account_id", "idempotency_key_id", "status", "currency_code", "amount",
                  "remaining_amount") + [
            ("amount_positive", F.col("amount") > 0),
            ("remaining_nonnegative", F.col("remaining_amount") >= 0),
            ("released_nonnegative", F.col("released_amount") >= 0),
            ("captured_nonnegative", F.col("captured_amount") >= 0),
            ("components_sum", F.col("remaining_amount") + F.col("released_amount")
             + F.col("captured_amount") == F.col("amount")),
            ("currency_code_check", _currency()),
            ("status_domain", _in("status", "hold_status"))]
    if table == "balance_projections":
        return nn("account_id", "currency_code", "balance_kind") + [
            ("currency_code_check", _currency()),
            ("balance_kind_domain", _in("balance_kind", "ledger_balance_kind")),
            ("balances_nonnegative", _nonneg("ledger_balance", "available_balance",
                                             "held_balance")),
            ("available_formula", F.col("available_balance") + F.col("held_balance")
             == F.col("ledger_balance"))]
    if table == "outbox_events":
        return nn("aggregate_type", "aggregate_id", "event_type", "status", "payload") + [
            ("payload_is_object", json_is_object("payload")),
            ("headers_is_object", json_is_object("headers")),
            ("aggregate_not_blank", _not_blank("aggregate_type")),
            ("event_type_not_blank", _not_blank("event_type")),
            ("retry_count_nonnegative", F.col("retry_count") >= 0),
            ("status_domain", _in("status", "outbox_status"))]
    if table == "incoming_webhooks":
        return nn("provider", "payload") + [
            ("payload_is_object", json_is_object("payload")),
            ("headers_is_object", json_is_object("headers")),
            ("provider_not_blank", _not_blank("provider"))]
    if table == "audit_logs":
        opt_obj = lambda c: F.col(c).isNull() | json_is_object(c)
        return nn("actor_type", "action", "entity_type") + [
            ("action_domain", _in("action", "audit_action")),
            ("metadata_is_object", json_is_object("metadata")),
            ("before_state_is_object", opt_obj("before_state")),
            ("after_state_is_object", opt_obj("after_state")),
            ("diff_is_object", opt_obj("diff")),
            ("actor_type_not_blank", _not_blank("actor_type")),
            ("entity_type_not_blank", _not_blank("entity_type"))]
    if table == "reconciliation_batches":
        return nn("source_system", "status") + [
            ("source_not_blank", _not_blank("source_system")),
            ("status_domain", _in("status", "reconciliation_status")),
            ("metadata_is_object", json_is_object("metadata")),
            ("amounts_nonnegative", _nonneg("expected_total_amount", "matched_total_amount",
                                            "mismatch_total_amount")),
            ("counts_nonnegative", _nonneg("expected_total_count", "matched_total_count",
                                           "mismatch_total_count"))]
    if table == "reconciliation_items":
        return nn("reconciliation_batch_id", "currency_code", "amount", "status") + [
            ("currency_code_check", _currency()),
            ("amount_positive", F.col("amount") > 0),
            ("matched_amount_nonnegative", F.col("matched_amount") >= 0),
            ("variance_amount_nonnegative", F.col("variance_amount") >= 0),
            ("status_domain", _in("status", "reconciliation_item_status")),
            ("metadata_is_object", json_is_object("metadata"))]
    raise ValueError(f"no rules for table {table}")


def check_domains(df: DataFrame, table: str, key: str = "id") -> tuple[DataFrame, DataFrame]:
    """Every CHECK / NOT NULL / enum rule of ``table``; one violation row per failed rule."""
    rules = domain_rules(table)
    checks = F.array(*[F.struct(F.lit(name).alias("rule"),
                                F.coalesce(ok, F.lit(True)).alias("ok")) for name, ok in rules])
    x = df.withColumn("_checks", checks)
    failed = F.filter("_checks", lambda c: ~c["ok"])
    valid = x.filter(F.size(failed) == 0).drop("_checks")
    bad = (x.select(F.col(key).cast("string").alias("key"), F.explode(failed).alias("_c"))
           .select(F.col("_c.rule").alias("rule"), F.lit(table).alias("table_name"), "key",
                   F.lit(None).cast("string").alias("detail")))
    return valid, bad


def check_unique(df: DataFrame, keys: Sequence[str], table: str,
                 case_insensitive: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Duplicated (composite) keys; rows with a null key part never collide (SQL UNIQUE).

    ``case_insensitive`` columns compare lower-cased (citext email).
    """
    kcols = [F.lower(F.col(k)) if k in case_insensitive else F.col(k) for k in keys]
    notnull = None
    for k in keys:
        e = F.col(k).isNotNull()
        notnull = e if notnull is None else notnull & e
    # Grouped by the columns themselves; the joined text is only the label of a violation.
    parts = [c.alias(f"_k{i}") for i, c in enumerate(kcols)]
    names = [f"_k{i}" for i in range(len(kcols))]
    dups = (df.filter(notnull).select(*parts).groupBy(*names).agg(F.count(F.lit(1)).alias("_n"))
            .filter(F.col("_n") > 1)
            .withColumn("_k", F.concat_ws("|", *[F.col(n).cast("string") for n in names])))
    bad = dups.select(F.lit("unique_" + "_".join(keys)).alias("rule"),
                      F.lit(table).alias("table_name"), F.col("_k").alias("key"),
                      F.concat(F.lit("rows: "), F.col("_n").cast("string")).alias("detail"))
    same = None
    for c, n in zip(kcols, names, strict=True):
        same = (c == F.col(n)) if same is None else same & (c == F.col(n))
    valid = df.join(dups.select(*names), same, "left_anti")
    return valid, bad


def check_references(df: DataFrame, fk: str, parent: DataFrame, parent_key: str, table: str,
                     key: str = "id") -> tuple[DataFrame, DataFrame]:
    """C4: rows whose non-null foreign key has no parent row.

    Each key named meets the parents once (anti join of distinct keys), however many rows name it; rows then look
    for their key among the missing ones, which are few in a sound ledger and broadcast up to a checked number.
    """
    pk = parent.select(F.col(parent_key).alias("_pk")).distinct()
    named = df.filter(F.col(fk).isNotNull()).select(F.col(fk).alias("_fk")).distinct()
    missing = stage(named.join(pk.hint("shuffle_hash"), F.col("_fk") == F.col("_pk"), "left_anti"), "missing-parents")
    few = missing.count() <= BROADCAST_ROWS
    orphans = df.join(F.broadcast(missing) if few else missing.hint("shuffle_hash"), F.col(fk) == F.col("_fk"), "left_semi")
    bad = orphans.select(F.lit(f"fk_{fk}").alias("rule"), F.lit(table).alias("table_name"),
                         F.col(key).cast("string").alias("key"),
                         F.col(fk).cast("string").alias("detail"))
    valid = df.join(orphans.select(F.col(key).alias("_bad")), F.col(key) == F.col("_bad"),
                    "left_anti")
    return valid, bad


def _tx_sums(lines: DataFrame, by: Sequence[str]) -> DataFrame:
    amt = F.coalesce(F.col("amount"), F.lit(0))
    return lines.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.sum(F.when(F.col("side") == "debit", amt).otherwise(0)).alias("debits"),
        F.sum(F.when(F.col("side") == "credit", amt).otherwise(0)).alias("credits"),
        F.bool_or(~F.coalesce(F.col("side").isin("debit", "credit"), F.lit(False)))
        .alias("bad_side"))


def check_double_entry(lines: DataFrame, per_currency: bool = False
                       ) -> tuple[DataFrame, DataFrame]:
    """Per transaction (optionally per currency) at least two lines and Σ debit = Σ credit.

    Valid output: the lines of balanced transactions.
    """
    by = ["journal_transaction_id"] + (["currency_code"] if per_currency else [])
    s = _tx_sums(lines, by)
    bad_tx = s.filter((F.col("n_lines") < 2) | (F.col("debits") != F.col("credits")))
    bad = bad_tx.select(
        F.when(F.col("n_lines") < 2, "min_two_lines").otherwise("unbalanced").alias("rule"),
        F.lit("journal_lines").alias("table_name"),
        F.concat_ws("|", *[F.col(c) for c in by]).alias("key"),
        F.concat(F.lit("lines="), F.col("n_lines").cast("string"),
                 F.lit(" debits="), F.col("debits").cast("decimal(38,8)").cast("string"),
                 F.lit(" credits="), F.col("credits").cast("decimal(38,8)").cast("string"))
        .alias("detail"))
    valid = lines.join(bad_tx.select(*by), by, "left_anti")
    return valid, bad


def check_legs(legs: DataFrame, key: str = "journal_transaction_id"
               ) -> tuple[DataFrame, DataFrame]:
    """Before posting, Σ debit − Σ credit = 0 per transaction; a side other than debit/credit
    is an error; a null amount counts as 0."""
    s = _tx_sums(legs, [key])
    bad_tx = s.filter(F.col("bad_side") | (F.col("debits") != F.col("credits")))
    bad = bad_tx.select(
        F.when(F.col("bad_side"), "invalid_side").otherwise("unbalanced").alias("rule"),
        F.lit("legs").alias("table_name"), F.col(key).alias("key"),
        F.when(F.col("bad_side"), F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("remainder "),
                            (F.col("debits") - F.col("credits")).cast("decimal(38,8)")
                            .cast("string"))).alias("detail"))
    valid = legs.join(bad_tx.select(key), key, "left_anti")
    return valid, bad


def check_eligibility(requests: DataFrame, customers: DataFrame, accounts: DataFrame, kind: str
                      ) -> DataFrame:
    """The first failing eligibility rule per request as ``reason`` (null = eligible).

    deposit: customer found, customer active, destination active, currency = destination's.
    withdrawal: customer found, source found, source active, currency = source's.
    transfer: customer found, currency = source's and destination's.
    """
    cust = customers.select(F.col("id").alias("_cid"), F.col("status").alias("_cstatus"))
    acc = accounts.select("id", "status", "currency_code")
    src = acc.select(F.col("id").alias("_sid"), F.col("status").alias("_sstatus"),
                     F.col("currency_code").alias("_scur"))
    dst = acc.select(F.col("id").alias("_did"), F.col("status").alias("_dstatus"),
                     F.col("currency_code").alias("_dcur"))
    x = requests.join(cust, F.col("customer_id") == F.col("_cid"), "left")
    if kind in ("withdrawal", "transfer"):
        x = x.join(src, F.col("source_account_id") == F.col("_sid"), "left")
    if kind in ("deposit", "transfer"):
        x = x.join(dst, F.col("destination_account_id") == F.col("_did"), "left")
    no_cust = F.col("_cid").isNull()
    cur = F.col("currency_code")
    if kind == "deposit":
        reason = (F.when(no_cust, "customer not found")
                  .when(F.col("_cstatus") != "active", "customer is not active")
                  .when(F.coalesce(F.col("_dstatus"), F.lit("")) != "active",
                        "destination account is not active")
                  .when(F.coalesce(F.col("_dcur"), F.lit("")) != cur, "currency code mismatch"))
    elif kind == "withdrawal":
        reason = (F.when(no_cust, "customer not found")
                  .when(F.col("_sid").isNull(), "source account not found")
                  .when(F.col("_sstatus") != "active", "source account is not active")
                  .when(F.col("_scur") != cur, "currency code mismatch"))
    elif kind == "transfer":
        reason = (F.when(no_cust, "customer not found")
                  .when((F.coalesce(F.col("_scur"), F.lit("")) != cur)
                        | (F.coalesce(F.col("_dcur"), F.lit("")) != cur),
                        "currency code mismatch"))
    else:
        raise ValueError(kind)
    return x.select(*requests.columns, reason.alias("reason"))


def check_append_only(before: DataFrame, after: DataFrame, key: str = "id",
                      table: str = "journal_lines") -> DataFrame:
    """Rows of an immutable table that were updated or deleted between two snapshots.

    Rows are compared by a 64-bit hash of all columns, each with a marker of being null (so a
    value that moved between nullable columns shows); the hash keeps the join payload to two columns.
    """
    cols = [c for c in before.columns]
    h = lambda df: df.select(F.col(key).alias("_k"),
                             F.xxhash64(*[x for c in cols for x in (F.col(c).isNull(), F.col(c))])
                             .alias("_h"))
    b, a = h(before), h(after.select(*cols)).withColumnRenamed("_h", "_ah")
    j = b.join(a, "_k", "left")
    changed = j.filter(F.col("_ah").isNull() | (F.col("_ah") != F.col("_h")))
    return changed.select(
        F.when(F.col("_ah").isNull(), "deleted").otherwise("updated").alias("rule"),
        F.lit(table).alias("table_name"), F.col("_k").alias("key"),
        F.lit(None).cast("string").alias("detail"))


def verify_provider_token(hooks: DataFrame, providers: DataFrame, token_col: str = "token"
                          ) -> tuple[DataFrame, DataFrame]:
    """Accept callbacks whose provider is known and whose header token equals its secret."""
    p = providers.select(F.col("provider").alias("_p"), F.col("secret").alias("_secret"))
    j = hooks.join(p, F.col("provider") == F.col("_p"), "left")
    reason = (F.when(F.col("_p").isNull(), "unknown provider")
              .when(F.col(token_col).isNull() | (F.col(token_col) != F.col("_secret")),
                    "invalid signature"))
    x = j.select(*hooks.columns, reason.alias("reason"))
    return x.filter(F.col("reason").isNull()).drop("reason"), x.filter(F.col("reason").isNotNull())


def sufficient_funds(requests: DataFrame, projections: DataFrame, kind: str,
                     projection_kind: str = "available") -> DataFrame:
    """Single-shot funds check against a projection snapshot (missing projection = 0).

    transfer: available ≥ amount + fee; withdrawal: available ≥ amount (fee ignored).
    """
    p = projections.filter(F.col("balance_kind") == projection_kind).select(
        F.col("account_id").alias("_acc"), F.col("currency_code").alias("_cur"),
        F.col("available_balance").alias("_avail"))
    j = requests.join(p, (F.col("source_account_id") == F.col("_acc"))
                      & (F.col("currency_code") == F.col("_cur")), "left")
    need = F.col("amount") + (F.coalesce(F.col("fee_amount"), F.lit(0))
                              if kind == "transfer" else F.lit(0))
    avail = F.coalesce(F.col("_avail"), F.lit(0).cast("decimal(20,8)"))
    return j.select(*requests.columns, avail.alias("available_balance"),
                    need.cast("decimal(20,8)").alias("needed"),
                    (avail >= need).alias("sufficient"))
