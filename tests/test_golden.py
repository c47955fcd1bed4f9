"""The reference's end-to-end golden balances, replayed through the set-wise operators:
admission (F5), balance deltas (F6), projection update (F7), idempotency (F13), settlement
(F9) and holds (F10)."""

from decimal import Decimal

from pyspark.sql import functions as F

from helpers import SYSTEM, D, accounts, as_dict, empty_projection, ops
from tallybook.operators import admission as A
from tallybook.operators import posting as P

NOW = "2024-02-01 00:00:00"


def _run(spark, op_rows, accts):
    acc = accounts(spark, accts + SYSTEM)
    o = ops(spark, op_rows)
    decided = A.admit(o, spark.createDataFrame([], "account_id string, available_balance decimal(20,8)"))
    accepted = decided.filter(F.col("status") == "accepted")
    deltas = P.balance_deltas(accepted, acc)
    proj = P.apply_deltas(empty_projection(spark), deltas, NOW)
    return decided, proj


CUST = [("A", "customer", "credit", "NGN"), ("B", "customer", "credit", "NGN")]


def test_deposit_50000(spark):
    _, proj = _run(spark, [("d1", 0, "deposit", None, "A", 50000, 0, None)], CUST)
    assert as_dict(proj, "account_id", "available_balance")["A"] == D(50000)


def test_transfer_with_fee(spark):
    _, proj = _run(spark, [
        ("d1", 0, "deposit", None, "A", 100000, 0, None),
        ("t1", 1, "transfer", "A", "B", 30000, 100, None)], CUST)
    bal = as_dict(proj, "account_id", "available_balance")
    assert bal["A"] == D(69900) and bal["B"] == D(30000) and bal["FEE"] == D(100)


def test_ten_transfers(spark):
    rows = [("d1", 0, "deposit", None, "A", 500000, 0, None)] + [
        (f"t{i}", i + 1, "transfer", "A", "B", 10000, 100, None) for i in range(10)]
    _, proj = _run(spark, rows, CUST)
    bal = as_dict(proj, "account_id", "available_balance")
    assert bal["A"] == D(399000) and bal["B"] == D(100000)


def test_insufficient_funds_rejected(spark):
    decided, proj = _run(spark, [
        ("d1", 0, "deposit", None, "A", 10000, 0, None),
        ("t1", 1, "transfer", "A", "B", 50000, 0, None)], CUST)
    assert as_dict(decided, "op_id", "status")["t1"] == "rejected"
    assert as_dict(proj, "account_id", "available_balance")["A"] == D(10000)


def test_hold_then_success(spark):
    decided, proj = _run(spark, [
        ("d1", 0, "deposit", None, "A", 50000, 0, None),
        ("h1", 1, "hold", "A", None, 10000, 0, None),
        ("s1", 2, "settle_success", "A", None, 10000, 0, "h1")], CUST)
    bal = {r["account_id"]: r for r in proj.collect()}
    assert bal["A"]["available_balance"] == D(40000)
    assert bal["A"]["held_balance"] == D(0)
    assert bal["A"]["ledger_balance"] == D(40000)
    assert as_dict(decided, "op_id", "status")["s1"] == "accepted"


def test_hold_stays_active(spark):
    _, proj = _run(spark, [
        ("d1", 0, "deposit", None, "A", 100000, 0, None),
        ("h1", 1, "hold", "A", None, 25000, 0, None)], CUST)
    a = {r["account_id"]: r for r in proj.collect()}["A"]
    assert (a["available_balance"], a["held_balance"], a["ledger_balance"]) == (
        D(75000), D(25000), D(100000))


def test_failed_settlement_returns_funds(spark):
    _, proj = _run(spark, [
        ("d1", 0, "deposit", None, "A", 100000, 0, None),
        ("h1", 1, "hold", "A", None, 25000, 0, None),
        ("s1", 2, "settle_failed", "A", None, 25000, 0, "h1")], CUST)
    a = {r["account_id"]: r for r in proj.collect()}["A"]
    assert (a["available_balance"], a["held_balance"]) == (D(100000), D(0))


def test_duplicate_deposit_is_replay(spark):
    """Same key and body twice: the second is a replay and posts nothing (60000, not 70000)."""
    from tallybook.operators import idempotency as I
    body = '{"amount":"10000"}'
    reqs = spark.createDataFrame(
        [("r1", "deposit_create", "k1", body, "2024-01-01 00:00:01"),
         ("r2", "deposit_create", "k1", body, "2024-01-01 00:00:02")],
        "request_id string, scope string, idempotency_key string, body string, arrival string"
    ).withColumn("arrival", F.to_timestamp_ntz("arrival"))
    keys = spark.createDataFrame([], "id string, scope string, idempotency_key string, "
                                     "request_hash string, response_code int, response_body string")
    st = as_dict(I.classify_requests(reqs, keys), "request_id", "status")
    assert st == {"r1": "new", "r2": "replay"}
    new = [r for r, s in st.items() if s == "new"]
    rows = [("d0", 0, "deposit", None, "A", 50000, 0, None)] + [
        (r, 1, "deposit", None, "A", 10000, 0, None) for r in new]
    _, proj = _run(spark, rows, CUST)
    assert as_dict(proj, "account_id", "available_balance")["A"] == D(60000)


def test_money_is_conserved(spark):
    """Σ signed deltas over every leg is zero per op (double entry in the projection)."""
    rows = [("d1", 0, "deposit", None, "A", 100, 0, None),
            ("t1", 1, "transfer", "A", "B", 30, 5, None)]
    acc = accounts(spark, CUST + SYSTEM)
    deltas = P.balance_deltas(ops(spark, rows), acc)
    # all accounts are credit-normal except none; settlement debit counts negative
    tot = deltas.groupBy("op_id").agg(F.sum("d_ledger").alias("s")).collect()
    # deposit: settlement (credit-normal) debited -100, A +100 → 0; transfer: -35 +30 +5 → 0
    assert all(r["s"] == Decimal(0) for r in tot)


def test_five_concurrent_transfers(spark):
    """Five transfers of 5000 + 50 fee from 75000: all accepted, 49750 left."""
    rows = [("d1", 0, "deposit", None, "A", 75000, 0, None)] + [
        (f"t{i}", 1, "transfer", "A", "B", 5000, 50, None) for i in range(5)]
    decided, proj = _run(spark, rows, CUST)
    assert {r["status"] for r in decided.filter(F.col("op_type") == "transfer").collect()} \
        == {"accepted"}
    bal = as_dict(proj, "account_id", "available_balance")
    assert bal["A"] == D(49750) and bal["B"] == D(25000) and bal["FEE"] == D(250)
