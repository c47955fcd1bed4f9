"""Posting: request rows → transfer rows, journal headers, numbered legs, balance deltas.

Legs are built as an ``ARRAY<STRUCT>`` per request and exploded with
``posexplode`` — a narrow, per-row transformation (no shuffle). Ids are
derived from the request id, so a retried job writes the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.functions.money import money
from tallybook.functions.text import ts_literal
from tallybook.schemas import TRANSFER_REQUESTS, conform

SETTLEMENT_TYPE = "settlement"
FEE_TYPE = "fee"


def journal_id(entry_type: str | Column, request_id: str | Column) -> Column:
    """Deterministic journal transaction id: ``<entry_type>:<request id>``."""
    et = F.lit(entry_type) if isinstance(entry_type, str) else entry_type
    rid = F.col(request_id) if isinstance(request_id, str) else request_id
    return F.concat(et, F.lit(":"), rid)


def system_accounts(accounts: DataFrame, account_type: str, alias: str) -> DataFrame:
    """(currency_code, <alias>) of the system account of a type, the smallest id per currency.

    One row per currency code in use; whether it is broadcast is left to its measured size.
    """
    return (accounts.filter(F.col("account_type") == account_type)
            .groupBy("currency_code").agg(F.min("id").alias(alias)))


def missing_system_accounts(ops: DataFrame, accounts: DataFrame) -> DataFrame:
    """Ops whose currency lacks a system account they need (op_id, reason).

    Deposits and successful settlements need a settlement account, transfers with a fee a fee
    account. Such ops get no legs and no balance deltas.
    """
    settle = system_accounts(accounts, SETTLEMENT_TYPE, "_settlement_account")
    fee_acc = system_accounts(accounts, FEE_TYPE, "_fee_account")
    o = ops.join(settle, "currency_code", "left").join(fee_acc, "currency_code", "left")
    reason = (F.when(F.col("op_type").isin("deposit", "settle_success")
                     & F.col("_settlement_account").isNull(), "no settlement account")
              .when((F.col("op_type") == "transfer") & (F.coalesce("fee_amount", F.lit(0)) > 0)
                    & F.col("_fee_account").isNull(), "no fee account"))
    return o.select("op_id", reason.alias("reason")).filter(F.col("reason").isNotNull())


def _leg(account: Column, side: str, amount: Column, kind: str, memo: str | None = None) -> Column:
    return F.struct(account.alias("account_id"), F.lit(side).alias("side"),
                    money(amount).alias("amount"), F.lit(kind).alias("balance_kind"),
                    F.lit(memo).cast("string").alias("memo"))


def _explode_legs(df: DataFrame, tx_id: Column, legs: Column, created_at: Column) -> DataFrame:
    """Numbered journal lines (line_number = position + 1) from an array of leg structs."""
    x = df.select(tx_id.alias("journal_transaction_id"), F.col("currency_code"),
                  created_at.alias("created_at"), F.posexplode(legs).alias("_pos", "_leg"))
    return x.select(
        F.concat(F.col("journal_transaction_id"), F.lit("#"), (F.col("_pos") + 1).cast("string"))
        .alias("id"),
        "journal_transaction_id",
        (F.col("_pos") + 1).cast("int").alias("line_number"),
        F.col("_leg.account_id").alias("account_id"),
        F.col("_leg.side").alias("side"),
        F.col("_leg.amount").alias("amount"),
        "currency_code",
        F.col("_leg.balance_kind").alias("balance_kind"),
        F.col("_leg.memo").alias("memo"),
        F.lit("{}").alias("metadata"),
        "created_at")


def transfer_legs(transfers: DataFrame, accounts: DataFrame) -> DataFrame:
    """debit source amount+fee, credit destination amount, credit the fee account the fee
    (only when fee > 0); kind ``available``. No legs without the fee account a fee needs."""
    fee_acc = system_accounts(accounts, FEE_TYPE, "_fee_account")
    fee = F.coalesce(F.col("fee_amount"), F.lit(0))
    t = (transfers.join(fee_acc, "currency_code", "left")
         .filter(F.col("_fee_account").isNotNull() | (fee <= 0)))
    legs = F.array(
        _leg(F.col("source_account_id"), "debit", F.col("amount") + fee, "available"),
        _leg(F.col("destination_account_id"), "credit", F.col("amount"), "available"),
        _leg(F.col("_fee_account"), "credit", fee, "available"))
    legs = F.filter(legs, lambda g: (g["side"] == "debit") | (g["amount"] > 0))
    return _explode_legs(t, journal_id("transfer", "id"), legs, F.col("requested_at"))


def deposit_legs(deposits: DataFrame, accounts: DataFrame) -> DataFrame:
    """debit settlement, credit destination, both the amount; the fee gets no leg.
    No legs in a currency without a settlement account."""
    settle = system_accounts(accounts, SETTLEMENT_TYPE, "_settlement_account")
    t = deposits.join(settle, "currency_code")
    legs = F.array(_leg(F.col("_settlement_account"), "debit", F.col("amount"), "available"),
                   _leg(F.col("destination_account_id"), "credit", F.col("amount"), "available"))
    return _explode_legs(t, journal_id("deposit", "id"), legs, F.col("requested_at"))


def hold_legs(withdrawals: DataFrame) -> DataFrame:
    """move the amount from ``available`` to ``held`` on the source account (pending)."""
    memo = "funds reserved for withdrawal"
    legs = F.array(_leg(F.col("source_account_id"), "debit", F.col("amount"), "available", memo),
                   _leg(F.col("source_account_id"), "credit", F.col("amount"), "held", memo))
    return _explode_legs(withdrawals, journal_id("hold", "id"), legs, F.col("requested_at"))


def settlement_legs(withdrawals: DataFrame, accounts: DataFrame,
                    settled_at: str | Column | None = None) -> DataFrame:
    """on a successful callback debit the customer and credit settlement, kind ``ledger``.
    No legs in a currency without a settlement account."""
    settle = system_accounts(accounts, SETTLEMENT_TYPE, "_settlement_account")
    t = withdrawals.join(settle, "currency_code")
    memo = "withdrawal settled"
    legs = F.array(_leg(F.col("source_account_id"), "debit", F.col("amount"), "ledger", memo),
                   _leg(F.col("_settlement_account"), "credit", F.col("amount"), "ledger", memo))
    when = (ts_literal(settled_at) if isinstance(settled_at, str)
            else settled_at if settled_at is not None else F.col("requested_at"))
    return _explode_legs(t, journal_id("withdrawal", "id"), legs, when)


def create_transfer_requests(requests: DataFrame, accounts: DataFrame, kind: str) -> DataFrame:
    """Typed request → transfer_requests row (status pending).

    Deposits come from the settlement account; withdrawals go to it.
    """
    settle = system_accounts(accounts, SETTLEMENT_TYPE, "_settlement_account")
    r = requests.join(settle, "currency_code", "left")
    src = F.col("_settlement_account") if kind == "deposit" else F.col("source_account_id")
    dst = F.col("_settlement_account") if kind == "withdrawal" else F.col("destination_account_id")
    return conform(r.select(
        F.col("request_id").alias("id"), "idempotency_key_id", "customer_id",
        src.alias("source_account_id"), dst.alias("destination_account_id"), "currency_code",
        money("amount").alias("amount"),
        money(F.coalesce(F.col("fee_amount"), F.lit(0))).alias("fee_amount"),
        F.lit("pending").alias("status"),
        F.when(F.length("client_reference") > 0, F.col("client_reference")).alias("client_reference"),
        F.when(F.length("external_reference") > 0, F.col("external_reference"))
        .alias("external_reference"),
        F.coalesce(F.col("metadata"), F.lit("{}")).alias("metadata"),
        F.col("requested_at"), F.col("requested_at").alias("created_at"),
        F.col("requested_at").alias("updated_at")), TRANSFER_REQUESTS)


ENTRY_TYPES = {"transfer": "transfer", "deposit": "deposit", "withdrawal": "hold"}


def create_journal(transfers: DataFrame, entry_type: str, source_system: str | Column = "core"
                   ) -> DataFrame:
    """One pending journal header per transfer row."""
    ss = F.lit(source_system) if isinstance(source_system, str) else source_system
    return transfers.select(
        journal_id(entry_type, "id").alias("id"),
        F.concat(F.lit("ref:"), journal_id(entry_type, "id")).alias("transaction_ref"),
        F.col("id").alias("transfer_request_id"), "idempotency_key_id",
        F.lit("pending").alias("status"), F.lit(entry_type).alias("entry_type"),
        F.to_date("requested_at").alias("accounting_date"),
        F.col("requested_at").alias("effective_at"),
        F.lit(None).cast("timestamp_ntz").alias("posted_at"),
        ss.alias("source_system"), F.col("id").alias("source_event_id"),
        F.col("metadata"), F.col("requested_at").alias("created_at"))


def post_transactions(txs: DataFrame, to_post: DataFrame, now: str) -> DataFrame:
    """F8: mark the given transactions posted (posted_at = now); posted ones stay untouched."""
    ids = to_post.select(F.col("id").alias("_pid")).distinct().withColumn("_hit", F.lit(True))
    j = txs.join(ids, txs["id"] == ids["_pid"], "left")
    hit = F.coalesce(F.col("_hit"), F.lit(False)) & (F.col("status") != "posted")
    return j.select(*[
        (F.when(hit, F.lit("posted")).otherwise(F.col("status")).alias("status") if c == "status"
         else F.when(hit, ts_literal(now)).otherwise(F.col("posted_at")).alias("posted_at")
         if c == "posted_at"
         else F.when(hit, ts_literal(now)).otherwise(F.col("updated_at")).alias("updated_at")
         if c == "updated_at" else F.col(c))
        for c in txs.columns])


def _touch(df: DataFrame, changes: DataFrame, key: str, sets: dict[str, Column]) -> DataFrame:
    """Left join of a change table on ``key`` and per-column replacement where a change exists.

    Repeated changes of one id count once: the one with the highest ``seq`` where the table has it,
    else the greatest values.
    """
    values = F.struct(*[F.col(c) for c in changes.columns if c not in (key, "seq")])
    best = (F.max_by(values, F.struct("seq", values)) if "seq" in changes.columns else F.max(values))
    ch = (changes.groupBy(F.col(key).alias("_ck")).agg(best.alias("_v"))
          .select("_ck", *[F.col("_v." + c).alias("_new_" + c)
                           for c in changes.columns if c not in (key, "seq")]))
    j = df.join(ch, df[key] == ch["_ck"], "left")
    hit = F.col("_ck").isNotNull()
    return j.select(*[F.when(hit, sets[c]).otherwise(F.col(c)).alias(c) if c in sets else F.col(c)
                      for c in df.columns])


def _only(changes: DataFrame, column: str) -> DataFrame:
    return changes.select("id", column, *[c for c in ("seq",) if c in changes.columns])


def update_transfer_status(transfers: DataFrame, changes: DataFrame, now: str) -> DataFrame:
    """New status; posted_at = now only when the new status is ``posted``."""
    n = ts_literal(now)
    return _touch(transfers, _only(changes, "status"), "id", {
        "status": F.col("_new_status"),
        "posted_at": F.when(F.col("_new_status") == "posted", n).otherwise(F.col("posted_at")),
        "failed_at": F.when(F.col("_new_status") == "failed", n).otherwise(F.col("failed_at")),
        "updated_at": n})


def update_transfer_external_ref(transfers: DataFrame, changes: DataFrame, now: str) -> DataFrame:
    """Replace external_reference."""
    return _touch(transfers, _only(changes, "external_reference"), "id", {
        "external_reference": F.col("_new_external_reference"), "updated_at": ts_literal(now)})


def update_customer_status(customers: DataFrame, changes: DataFrame, now: str) -> DataFrame:
    """Customer status."""
    return _touch(customers, _only(changes, "status"), "id", {
        "status": F.col("_new_status"), "updated_at": ts_literal(now)})


def update_account_status(accounts: DataFrame, changes: DataFrame, now: str) -> DataFrame:
    """F11d: account status; closed_at set to now on ``closed``, kept otherwise."""
    n = ts_literal(now)
    return _touch(accounts, _only(changes, "status"), "id", {
        "status": F.col("_new_status"),
        "closed_at": F.when(F.col("_new_status") == "closed", n).otherwise(F.col("closed_at")),
        "updated_at": n})


# F6 balance deltas: per op type, the (account, leg side, amount, which balances move).
def balance_deltas(ops: DataFrame, accounts: DataFrame) -> DataFrame:
    """per op, the change of ledger / held / available on every account it touches.

    Ledger moves honour each account's normal side (a leg on the normal side adds); holds and
    their release move the amount between available and held whatever the side. Ops that lack a
    system account (see :func:`missing_system_accounts`) have no deltas.
    Op types: deposit, transfer, hold, settle_success, settle_failed.
    """
    settle = system_accounts(accounts, SETTLEMENT_TYPE, "_settlement_account")
    fee_acc = system_accounts(accounts, FEE_TYPE, "_fee_account")
    o = ops.join(settle, "currency_code", "left").join(fee_acc, "currency_code", "left")
    amt = F.col("amount")
    fee = F.coalesce(F.col("fee_amount"), F.lit(0))
    src, dst = F.col("source_account_id"), F.col("destination_account_id")
    st, fa = F.col("_settlement_account"), F.col("_fee_account")

    o = o.join(missing_system_accounts(ops, accounts), "op_id", "left_anti")

    def d(acc, side, a, ledger, held, avail):
        # ledger/held/available factors of the amount; side None: not signed by the normal side
        return F.struct(acc.alias("account_id"), F.lit(side).cast("string").alias("side"),
                        a.alias("amount"), F.lit(ledger).alias("l"), F.lit(held).alias("h"), F.lit(avail).alias("v"))

    t = F.col("op_type")
    entries = (
        F.when(t == "deposit", F.array(d(st, "debit", amt, 1, 0, 1), d(dst, "credit", amt, 1, 0, 1)))
        .when(t == "transfer", F.array(d(src, "debit", amt + fee, 1, 0, 1),
                                       d(dst, "credit", amt, 1, 0, 1),
                                       d(fa, "credit", fee, 1, 0, 1)))
        .when(t == "hold", F.array(d(src, None, amt, 0, 1, -1)))
        .when(t == "settle_success", F.array(d(src, "debit", amt, 1, 0, 0), d(src, None, amt, 0, -1, 0),
                                             d(st, "credit", amt, 1, 0, 1)))
        .when(t == "settle_failed", F.array(d(src, None, amt, 0, -1, 1))))
    x = (o.select("op_id", "currency_code", F.explode(entries).alias("e"))
         .filter(F.col("e.amount") > 0)
         .select("op_id", "currency_code", "e.*"))
    normal = accounts.select(F.col("id").alias("account_id"), "ledger_normal_side")
    x = x.join(normal, "account_id", "left")
    signed = F.when(F.col("side").isNull(), F.col("amount")).when(F.col("side") == F.coalesce(F.col("ledger_normal_side"), F.lit("credit")),
                    F.col("amount")).otherwise(-F.col("amount"))
    return (x.groupBy("op_id", "account_id", "currency_code")
            .agg(money(F.sum(signed * F.col("l"))).alias("d_ledger"),
                 money(F.sum(signed * F.col("h"))).alias("d_held"),
                 money(F.sum(signed * F.col("v"))).alias("d_available")))


def last_entries_of_ops(ops: DataFrame, accounts: DataFrame) -> DataFrame:
    """(account_id, currency_code, last_transaction_id, last_line_id) that posted ops leave on the accounts.

    Per account the line of the newest op, in (op_ts, seq_key, op_id) order, that has a leg on it; a failed
    settlement has none. Ids are those of the leg builders; ops that lack a system account have no legs.
    """
    settle = system_accounts(accounts, SETTLEMENT_TYPE, "_settlement_account")
    fee_acc = system_accounts(accounts, FEE_TYPE, "_fee_account")
    o = (ops.join(missing_system_accounts(ops, accounts), "op_id", "left_anti")
         .join(settle, "currency_code", "left").join(fee_acc, "currency_code", "left"))
    t = F.col("op_type")
    src, dst, st, fa = (F.col(c) for c in ("source_account_id", "destination_account_id", "_settlement_account", "_fee_account"))

    def line(n: int, account: Column) -> Column:
        return F.struct(F.lit(n).alias("n"), account.alias("account_id"))
    fee_line = F.when(F.coalesce("fee_amount", F.lit(0)) > 0, F.array(line(3, fa))).otherwise(F.array().cast("array<struct<n:int,account_id:string>>"))
    lines = (F.when(t == "deposit", F.array(line(1, st), line(2, dst)))
             .when(t == "transfer", F.concat(F.array(line(1, src), line(2, dst)), fee_line))
             .when(t == "hold", F.array(line(1, src)))
             .when(t == "settle_success", F.array(line(1, src), line(2, st))))
    of = F.when(t == "settle_success", F.coalesce("hold_op_id", "op_id")).otherwise(F.col("op_id"))
    kind = F.when(t == "settle_success", "withdrawal").otherwise(t)
    x = (o.select("op_ts", "seq_key", "op_id", "currency_code", F.concat(kind, F.lit(":"), of).alias("tx"),
                  F.explode(lines).alias("e"))
         .select("*", F.col("e.account_id").alias("account_id"),
                 F.concat("tx", F.lit("#"), F.col("e.n").cast("string")).alias("line")))
    best = F.max_by(F.struct("tx", "line"), F.struct("op_ts", "seq_key", "op_id", -F.col("e.n")))
    return (x.groupBy("account_id", "currency_code").agg(best.alias("b"))
            .select("account_id", "currency_code", F.col("b.tx").alias("last_transaction_id"),
                    F.col("b.line").alias("last_line_id")))


def apply_deltas(proj: DataFrame, deltas: DataFrame, now: str, projection_kind: str = "available",
                 lasts: DataFrame | None = None) -> DataFrame:
    """new projection = stored + Σ deltas per (account, currency); new keys start at 0,
    version + 1 for every touched key, untouched keys and other balance kinds unchanged. The last
    transaction and line are taken from ``lasts`` (:func:`last_entries_of_ops`), else carried along where the
    projection has them."""
    agg = (deltas.groupBy("account_id", "currency_code")
           .agg(F.sum("d_ledger").alias("_dl"), F.sum("d_held").alias("_dh"),
                F.sum("d_available").alias("_dv")))
    p = proj.filter(F.col("balance_kind") == projection_kind)
    j = p.join(agg, ["account_id", "currency_code"], "full_outer")
    touched = F.col("_dl").isNotNull()
    z = F.lit(0)
    ids = ["last_transaction_id", "last_line_id"]
    last = [c for c in ids if c in proj.columns]
    if lasts is not None:
        new = lasts.select("account_id", "currency_code", *[F.col(c).alias("_" + c) for c in ids])
        j = j.join(new, ["account_id", "currency_code"], "left")
        last = [F.coalesce("_" + c, *[c for _ in (0,) if c in proj.columns]).alias(c) for c in ids]
    moved = j.select(
        "account_id", "currency_code", F.lit(projection_kind).alias("balance_kind"),
        money(F.coalesce(F.col("ledger_balance"), z) + F.coalesce(F.col("_dl"), z))
        .alias("ledger_balance"),
        money(F.coalesce(F.col("available_balance"), z) + F.coalesce(F.col("_dv"), z))
        .alias("available_balance"),
        money(F.coalesce(F.col("held_balance"), z) + F.coalesce(F.col("_dh"), z))
        .alias("held_balance"),
        (F.coalesce(F.col("version"), F.lit(0)).cast("bigint")
         + F.when(touched, 1).otherwise(0)).alias("version"),
        F.when(touched, ts_literal(now)).otherwise(F.col("computed_at")).alias("computed_at"), *last)
    rest = proj.filter(~F.col("balance_kind").eqNullSafe(projection_kind))
    return moved.unionByName(rest.select(*[
        (F.col(f.name) if f.name in proj.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in moved.schema]))


def transfer_payload() -> Column:
    """A transfer as events and stored responses carry it."""
    return F.to_json(F.struct(
        F.col("id").alias("transfer_id"), "status", "source_account_id", "destination_account_id",
        F.col("amount").cast("string").alias("amount"),
        F.col("fee_amount").cast("string").alias("fee_amount"), "currency_code"))


def outbox_from_transfers(transfers: DataFrame, event_types: dict[str, str] | None = None,
                          aggregate_type: str = "transfer_request", entry_type: str = "transfer") -> DataFrame:
    """F16: one pending outbox event per posted / failed transfer or deposit.

    ``event_types`` maps transfer status → event type (default posted → transfer.posted,
    failed → transfer.failed). ``aggregate_type`` is ``deposit_request`` for deposits (``entry_type``
    ``deposit``). Headers: content type, source system (``core`` unless the rows carry one), the reference of the
    journal transaction and the client's reference. Partition key: destination account.
    """
    et = event_types or {"posted": "transfer.posted", "failed": "transfer.failed"}
    m = F.create_map(*[F.lit(x) for kv in et.items() for x in kv])
    t = transfers.filter(F.col("status").isin(list(et)))
    source = F.col("source_system") if "source_system" in transfers.columns else F.lit(None)
    headers = F.to_json(F.struct(
        F.coalesce("client_reference", F.lit("")).alias("client_reference"),
        F.lit("application/json").alias("content_type"),
        F.concat(F.lit("ref:"), journal_id(entry_type, "id")).alias("event_transaction"),
        F.coalesce(source, F.lit("core")).alias("source_system")))
    ev = m[F.col("status")]
    return t.select(
        F.concat(ev, F.lit(":"), F.col("id")).alias("id"),
        F.lit(aggregate_type).alias("aggregate_type"), F.col("id").alias("aggregate_id"),
        ev.alias("event_type"), F.lit("pending").alias("status"), "idempotency_key_id",
        transfer_payload().alias("payload"), headers.alias("headers"),
        F.col("destination_account_id").alias("partition_key"),
        F.lit(0).alias("retry_count"),
        F.col("updated_at").alias("created_at"), F.col("updated_at").alias("updated_at"))


def link_reversals(txs: DataFrame, lines: DataFrame) -> DataFrame:
    """pair each reversal with its original and check the legs mirror each other.

    A reversal mirrors when, per (account, currency, kind), the original's debits equal the
    reversal's credits and vice versa.
    """
    rev = txs.filter(F.col("reversal_of_transaction_id").isNotNull()).select(
        F.col("id").alias("reversal_id"), F.col("reversal_of_transaction_id").alias("original_id"))
    per = (lines.groupBy("journal_transaction_id", "account_id", "currency_code", "balance_kind")
           .agg(F.sum(F.when(F.col("side") == "debit", F.col("amount")).otherwise(0)).alias("dr"),
                F.sum(F.when(F.col("side") == "credit", F.col("amount")).otherwise(0)).alias("cr")))
    o = per.join(rev, per["journal_transaction_id"] == rev["original_id"]).select(
        "reversal_id", "original_id", "account_id", "currency_code", "balance_kind",
        F.col("dr").alias("o_dr"), F.col("cr").alias("o_cr"))
    r = per.join(rev.select("reversal_id"),
                 per["journal_transaction_id"] == F.col("reversal_id")).select(
        "reversal_id", "account_id", "currency_code", "balance_kind",
        F.col("dr").alias("r_dr"), F.col("cr").alias("r_cr"))
    k = ["reversal_id", "account_id", "currency_code", "balance_kind"]
    j = o.join(r, k, "full_outer")
    ok = (F.coalesce(F.col("o_dr"), F.lit(0)) == F.coalesce(F.col("r_cr"), F.lit(0))) & \
         (F.coalesce(F.col("o_cr"), F.lit(0)) == F.coalesce(F.col("r_dr"), F.lit(0)))
    per_rev = j.groupBy("reversal_id").agg(F.bool_and(ok).alias("mirrored"),
                                           F.count(F.lit(1)).alias("n_keys"))
    return rev.join(per_rev, "reversal_id", "left").select(
        "reversal_id", "original_id", F.coalesce(F.col("mirrored"), F.lit(False)).alias("mirrored"),
        F.coalesce(F.col("n_keys"), F.lit(0)).alias("n_keys"))
