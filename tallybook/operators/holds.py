"""Funds holds and provider-callback settlement.

Hold transitions are guarded like the reference's UPDATEs (``status =
'active' AND remaining_amount >= amount``). When several requests target the
same hold in one batch, the result equals applying them one by one in request
order: once a transition succeeds the hold is terminal, so the first request
that passes the guard wins. The winner per hold is found with a ``min_by``
aggregate (partial + final, safe for a hold or transfer with very many
requests), never with a per-key sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.functions.money import money
from tallybook.functions.text import ts_literal
from tallybook.operators.posting import SETTLEMENT_TYPE, journal_id, settlement_legs, system_accounts
from tallybook.session import stage

HOLD_TTL = "24 hours"
HOLD_COLS = ["id", "account_id", "transfer_request_id", "journal_transaction_id",
             "idempotency_key_id", "status", "currency_code", "amount", "remaining_amount",
             "released_amount", "captured_amount", "reason_code", "reason", "expires_at",
             "captured_at", "released_at", "created_at", "updated_at"]


def _now(now: str | Column) -> Column:
    return ts_literal(now) if isinstance(now, str) else now


def create_holds(withdrawals: DataFrame, ttl: str = HOLD_TTL) -> DataFrame:
    """One active hold per withdrawal transfer, expiring ``ttl`` after the request."""
    return withdrawals.select(
        F.concat(F.lit("hold:"), F.col("id")).alias("id"),
        F.col("source_account_id").alias("account_id"),
        F.col("id").alias("transfer_request_id"),
        journal_id("hold", "id").alias("journal_transaction_id"),
        "idempotency_key_id", F.lit("active").alias("status"), "currency_code",
        money("amount").alias("amount"), money("amount").alias("remaining_amount"),
        money(F.lit(0)).alias("released_amount"), money(F.lit(0)).alias("captured_amount"),
        F.lit("withdrawal").alias("reason_code"),
        F.lit("funds reserved for withdrawal").alias("reason"),
        (F.col("requested_at") + F.expr(f"INTERVAL {ttl}")).alias("expires_at"),
        F.lit(None).cast("timestamp_ntz").alias("captured_at"),
        F.lit(None).cast("timestamp_ntz").alias("released_at"),
        F.col("requested_at").alias("created_at"), F.col("requested_at").alias("updated_at"))


def _transition(holds: DataFrame, requests: DataFrame, now: str, action: str,
                release_remainder: bool) -> tuple[DataFrame, DataFrame]:
    """Shared guarded transition. ``requests``: (request_id, hold_id, amount[, seq])."""
    order = F.col("seq") if "seq" in requests.columns else F.col("request_id")
    r = requests.select("request_id", "hold_id", money("amount").alias("req_amount"),
                        order.alias("_seq"))
    h = holds.select(F.col("id").alias("hold_id"), F.col("status").alias("_st"),
                     F.col("remaining_amount").alias("_rem"))
    j = r.join(h, "hold_id", "left")
    passes = (F.col("_st") == "active") & (F.col("_rem") >= F.col("req_amount")) \
        & (F.col("req_amount") > 0)
    winners = (j.filter(passes).groupBy("hold_id")
               .agg(F.min_by(F.struct("request_id", "req_amount"), F.col("_seq")).alias("_w"),
                    F.min("_seq").alias("_wseq"))
               .select("hold_id", F.col("_w.request_id").alias("_win_req"),
                       F.col("_w.req_amount").alias("_win_amount"), "_wseq"))
    jr = j.join(winners, "hold_id", "left")
    reason = (F.when(F.col("_st").isNull(), "hold not found")
              .when(F.col("req_amount").isNull() | (F.col("req_amount") <= 0), "invalid amount")
              .when((F.col("_st") != "active") | (F.col("_wseq") < F.col("_seq")),
                    "hold not active")
              .when(F.col("_rem") < F.col("req_amount"), "insufficient remaining"))
    rejects = (jr.filter(F.col("_win_req").isNull() | (F.col("_win_req") != F.col("request_id")))
               .select("request_id", "hold_id", "req_amount", reason.alias("reason")))
    n = ts_literal(now)
    hw = holds.join(winners.select("hold_id", "_win_amount"),
                    holds["id"] == winners["hold_id"], "left")
    hit = F.col("_win_amount").isNotNull()
    amt = F.col("_win_amount")
    rem_after = F.col("remaining_amount") - amt
    if action == "consume":
        captured = F.col("captured_amount") + amt
        released = F.col("released_amount") + (rem_after if release_remainder else F.lit(0))
        remaining = F.lit(0) if release_remainder else rem_after
        status, stamp_col = "consumed", "captured_at"
    else:
        captured = F.col("captured_amount")
        released = F.col("released_amount") + amt
        remaining = rem_after
        status, stamp_col = "released", "released_at"
    sets = {"status": F.lit(status), "remaining_amount": money(remaining),
            "captured_amount": money(captured), "released_amount": money(released),
            stamp_col: n, "updated_at": n}
    if action == "consume" and release_remainder:
        sets["released_at"] = F.when(rem_after > 0, n).otherwise(F.col("released_at"))
    out = hw.select(*[F.when(hit, sets[c]).otherwise(F.col(c)).alias(c) if c in sets
                      else F.col(c) for c in holds.columns])
    return out, rejects


def consume_holds(holds: DataFrame, requests: DataFrame, now: str,
                  release_remainder: bool = True) -> tuple[DataFrame, DataFrame]:
    """Capture ``amount`` of an active hold (and by default release what is left, the
    intent of the reference's consume-then-release). Returns ``(holds', rejects)``."""
    return _transition(holds, requests, now, "consume", release_remainder)


def release_holds(holds: DataFrame, requests: DataFrame, now: str) -> tuple[DataFrame, DataFrame]:
    """Release ``amount`` of an active hold back to available. Returns ``(holds', rejects)``."""
    return _transition(holds, requests, now, "release", False)


def expire_holds(holds: DataFrame, now: str) -> DataFrame:
    """F10d: active holds past expires_at become ``expired``; the remainder is released."""
    n = ts_literal(now)
    due = (F.col("status") == "active") & F.col("expires_at").isNotNull() & (F.col("expires_at") <= n)
    sets = {"status": F.lit("expired"), "remaining_amount": money(F.lit(0)),
            "released_amount": money(F.col("released_amount") + F.col("remaining_amount")),
            "released_at": n, "updated_at": n}
    return holds.select(*[F.when(due, sets[c]).otherwise(F.col(c)).alias(c) if c in sets
                          else F.col(c) for c in holds.columns])


# Callback event names and what they do.
SUCCESS_EVENTS = ["transfer.success"]
FAILURE_EVENTS = ["transfer.failed", "transfer.reversed"]


def settle_callbacks(callbacks: DataFrame, transfers: DataFrame, holds: DataFrame,
                     accounts: DataFrame, now: str) -> dict[str, DataFrame]:
    """apply provider callbacks (parsed envelopes, A4) to withdrawals.

    ``callbacks``: hook_id, event, received_at, data.reference (= transfer id).
    Per transfer, callbacks are applied in (received_at, hook_id) order:

    * success → consume the active hold, transfer ``posted``, settlement legs (F4),
      event ``transfer.posted``;
    * failed / reversed → release the active hold, transfer ``failed``, event
      ``transfer.failed``;
    * a transfer already ``failed`` skips a failure callback; a transfer already
      ``posted`` rejects a success callback; any callback finding no hold active at
      its arrival (consumed, released or expired) or one that holds less than the
      transfer's amount is rejected;
    * a success in a currency without settlement account is rejected (it could post no legs); the hold
      stays active;
    * other events are rejected as unhandled.

    Returns a dict: ``outcomes`` (one row per callback), ``transfers`` (changed
    transfers), ``holds`` (all holds after), ``legs``, ``events``.
    """
    n = ts_literal(now)
    cb = callbacks.select(
        "hook_id", "event", "received_at",
        F.col("data.reference").alias("transfer_id"),
        F.when(F.col("event").isin(SUCCESS_EVENTS), "success")
        .when(F.col("event").isin(FAILURE_EVENTS), "failure").alias("kind"))
    settle = system_accounts(accounts, SETTLEMENT_TYPE, "_settlement")
    trf = (transfers.join(settle, "currency_code", "left")
           .select(F.col("id").alias("transfer_id"), F.col("status").alias("_tst"), F.col("amount").alias("_amt"),
                   F.col("_settlement").isNotNull().alias("_settles")))
    active = holds.filter(F.col("status") == "active").select(
        "transfer_request_id", F.col("id").alias("_hold_id"), F.col("expires_at").alias("_exp"),
        F.col("remaining_amount").alias("_rem"))
    # GetActiveHoldByTransferRequestID ... LIMIT 1: one active hold per transfer.
    active = (active.groupBy("transfer_request_id")
              .agg(F.min_by(F.struct("_hold_id", "_exp", "_rem"), F.col("_hold_id")).alias("_h"))
              .select(F.col("transfer_request_id").alias("transfer_id"), "_h.*"))
    # Parsed and joined once, though every output reads it; so are the winners below.
    j = stage(cb.join(trf, "transfer_id", "left").join(active, "transfer_id", "left"), "settle-callbacks")
    hold_live = F.col("_hold_id").isNotNull() & (F.col("_exp").isNull()
                                                 | (F.col("_exp") > F.col("received_at")))
    applicable = (F.col("kind").isNotNull() & F.col("_tst").isNotNull()
                  & ~F.col("_tst").isin("posted", "failed") & hold_live
                  & (F.col("_rem") >= F.col("_amt")) & (F.col("_amt") > 0)
                  & ((F.col("kind") == "failure") | F.col("_settles")))
    order = F.struct("received_at", "hook_id")
    win = (j.filter(applicable).groupBy("transfer_id")
           .agg(F.min_by(F.struct("hook_id", "kind"), order).alias("_w"),
                F.min(order).alias("_word"))
           .select("transfer_id", F.col("_w.hook_id").alias("_win_hook"),
                   F.col("_w.kind").alias("_win_kind"), "_word"))
    x = j.join(win, "transfer_id", "left")
    is_win = F.col("_win_hook") == F.col("hook_id")
    after_win = F.col("_word").isNotNull() & (F.col("_word") < order)
    # Transfer status as this callback sees it.
    seen = F.when(after_win, F.when(F.col("_win_kind") == "success", "posted").otherwise("failed")) \
        .otherwise(F.col("_tst"))
    outcome = (F.when(F.col("kind").isNull(), "rejected")
               .when(F.col("_tst").isNull(), "rejected")
               .when(is_win, F.when(F.col("kind") == "success", "posted").otherwise("failed"))
               .when((F.col("kind") == "failure") & (seen == "failed"), "skipped")
               .otherwise("rejected"))
    reason = (F.when(F.col("kind").isNull(), F.concat(F.lit("unhandled event: "),
                                                      F.coalesce(F.col("event"), F.lit(""))))
              .when(F.col("_tst").isNull(), "transfer not found")
              .when(is_win, F.lit(None))
              .when((F.col("kind") == "failure") & (seen == "failed"), "transfer already failed")
              .when((F.col("kind") == "success") & (seen == "posted"),
                    "transfer already processed")
              .when(hold_live & ~after_win & (F.col("_rem") >= F.col("_amt")) & (F.col("_amt") > 0),
                    "no settlement account")
              .when(hold_live & F.col("_word").isNull(), "insufficient hold")
              .otherwise("no active hold"))
    outcomes = x.select("hook_id", "transfer_id", "event", outcome.alias("outcome"),
                        reason.alias("reason"))
    winners = stage(x.filter(is_win).select("transfer_id", "kind", "_hold_id"), "settle-winners")

    t = transfers.join(winners.select(F.col("transfer_id").alias("_t"), "kind"),
                       transfers["id"] == F.col("_t"))
    new_status = F.when(F.col("kind") == "success", "posted").otherwise("failed")
    changed = t.select(*[
        new_status.alias("status") if c == "status"
        else F.when(F.col("kind") == "success", n).otherwise(F.col("posted_at")).alias(c)
        if c == "posted_at"
        else F.when(F.col("kind") == "failure", n).otherwise(F.col("failed_at")).alias(c)
        if c == "failed_at"
        else n.alias(c) if c == "updated_at" else F.col(c)
        for c in transfers.columns])

    req = (t.join(winners.select(F.col("transfer_id").alias("_t2"), "_hold_id"),
                  F.col("id") == F.col("_t2"))
           .select(F.col("id").alias("request_id"), F.col("_hold_id").alias("hold_id"),
                   "amount", "kind"))
    h1, _ = consume_holds(holds, req.filter(F.col("kind") == "success").drop("kind"), now)
    h2, _ = release_holds(h1, req.filter(F.col("kind") == "failure").drop("kind"), now)

    posted = changed.filter(F.col("status") == "posted")
    legs = settlement_legs(posted, accounts, settled_at=n)
    payload = F.to_json(F.struct(F.col("id").alias("transfer_id"), "status",
                                 "source_account_id", F.col("amount").cast("string").alias("amount"),
                                 "currency_code"))
    ev_type = F.when(F.col("status") == "posted", "transfer.posted").otherwise("transfer.failed")
    events = changed.select(
        F.concat(ev_type, F.lit(":"), F.col("id")).alias("id"),
        F.lit("transfer_request").alias("aggregate_type"), F.col("id").alias("aggregate_id"),
        ev_type.alias("event_type"), F.lit("pending").alias("status"), "idempotency_key_id",
        payload.alias("payload"),
        F.to_json(F.struct(F.lit("application/json").alias("content_type"),
                           F.col("id").alias("client_reference"))).alias("headers"),
        F.col("source_account_id").alias("partition_key"), F.lit(0).alias("retry_count"),
        n.alias("created_at"), n.alias("updated_at"))
    return {"outcomes": outcomes, "transfers": changed, "holds": h2, "legs": legs,
            "events": events}
