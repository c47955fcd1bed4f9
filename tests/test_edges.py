"""Edge rows of posting, settlement, validation, reconciliation and delivery."""

from datetime import timedelta

from pyspark.sql import functions as F

from helpers import D, T0, accounts, ops
from tallybook import schemas as S
from tallybook.operators import holds as H
from tallybook.operators import outbox as O
from tallybook.operators import posting as P
from tallybook.operators import recon as R
from tallybook.operators import validate as V

NOW = "2024-02-01 00:00:00"
ACC = [("D1", "customer_wallet", "debit", "NGN"), ("C1", "customer_wallet", "credit", "NGN"),
       ("SETTLE", "settlement", "credit", "NGN")]


def test_holds_do_not_depend_on_the_normal_side(spark):
    acc = accounts(spark, ACC)
    o = ops(spark, [("h1", 0, "hold", "D1", None, 10, 0, None), ("h2", 1, "hold", "C1", None, 10, 0, None),
                    ("f1", 2, "settle_failed", "D1", None, 10, 0, "h1"),
                    ("s1", 3, "settle_success", "C1", None, 10, 0, "h2")])
    got = {(r["op_id"], r["account_id"]): (r["d_ledger"], r["d_held"], r["d_available"])
           for r in P.balance_deltas(o, acc).collect()}
    assert got[("h1", "D1")] == got[("h2", "C1")] == (D(0), D(10), D(-10))
    assert got[("f1", "D1")] == (D(0), D(-10), D(10))
    assert got[("s1", "C1")] == (D(-10), D(-10), D(0)) and got[("s1", "SETTLE")] == (D(10), D(0), D(10))


def test_ops_without_their_system_account_are_rejected(spark):
    acc = accounts(spark, ACC)              # no fee account at all, no settlement account in USD
    o = ops(spark, [("t1", 0, "transfer", "C1", "D1", 5, 1, None), ("t2", 1, "transfer", "C1", "D1", 5, 0, None),
                    ("d1", 2, "deposit", None, "C1", 5, 0, None)])
    o = o.unionByName(o.filter("op_id = 'd1'").withColumn("op_id", F.lit("d2")).withColumn("currency_code", F.lit("USD")))
    assert {(r["op_id"], r["reason"]) for r in P.missing_system_accounts(o, acc).collect()} == {
        ("t1", "no fee account"), ("d2", "no settlement account")}
    d = P.balance_deltas(o, acc)
    assert {r["op_id"] for r in d.collect()} == {"t2", "d1"} and d.filter("account_id is null").count() == 0
    legs = P.transfer_legs(o.filter("op_type = 'transfer'").select(
        F.col("op_id").alias("id"), "*", F.col("op_ts").alias("requested_at")), acc)
    assert {r["journal_transaction_id"] for r in legs.collect()} == {"transfer:t2"}


def test_deltas_keep_other_balance_kinds(spark):
    rows = [dict(account_id="C1", currency_code="NGN", balance_kind=k, ledger_balance=D(7), available_balance=D(7),
                 held_balance=D(0), version=3, last_line_id="l1") for k in ("available", "ledger")]
    proj = S.conform(spark.createDataFrame(rows), S.BALANCE_PROJECTIONS)
    d = P.balance_deltas(ops(spark, [("h", 0, "hold", "C1", None, 2, 0, None)]), accounts(spark, ACC))
    out = {r["balance_kind"]: r for r in P.apply_deltas(proj, d, NOW).collect()}
    assert (out["available"]["version"], out["available"]["held_balance"], out["available"]["last_line_id"]) == (4, D(2), "l1")
    assert (out["ledger"]["version"], out["ledger"]["ledger_balance"]) == (3, D(7))


def test_a_callback_cannot_post_more_than_its_hold(spark):
    acc = accounts(spark, ACC)
    trf = S.conform(spark.createDataFrame([dict(id="w1", source_account_id="C1", currency_code="NGN", amount=D(10),
                                                status="processing", requested_at=T0)]), S.TRANSFER_REQUESTS)
    hold = S.conform(spark.createDataFrame([dict(
        id="hold:w1", account_id="C1", transfer_request_id="w1", status="active", currency_code="NGN", amount=D(10),
        remaining_amount=D(5), released_amount=D(0), captured_amount=D(5), expires_at=T0 + timedelta(days=9))]),
        S.FUNDS_HOLDS)
    cb = spark.createDataFrame([("k1", "transfer.success", T0, ("w1",))],
                               "hook_id string, event string, received_at timestamp_ntz, data struct<reference:string>")
    out = H.settle_callbacks(cb, trf, hold, acc, NOW)
    assert [(r["outcome"], r["reason"]) for r in out["outcomes"].collect()] == [("rejected", "insufficient hold")]
    assert out["legs"].count() == out["events"].count() == out["transfers"].count() == 0
    assert out["holds"].first()["remaining_amount"] == D(5)


def test_unique_keys_and_changed_rows(spark):
    df = spark.createDataFrame([("a|b", "c", 1), ("a", "b|c", 2), ("x", "y", 3), ("x", "y", 4), (None, "y", 5)],
                               "k string, l string, id long")
    valid, bad = V.check_unique(df, ["k", "l"], "t")
    assert bad.count() == 1 and {r["id"] for r in valid.collect()} == {1, 2, 5}
    before = spark.createDataFrame([("1", "v", None), ("2", "v", None)], "id string, a string, b string")
    after = spark.createDataFrame([("1", None, "v"), ("2", "v", None)], "id string, a string, b string")
    assert [r["key"] for r in V.check_append_only(before, after).collect()] == ["1"]


def test_duplicate_internal_records_are_reported(spark):
    st = spark.createDataFrame([("bank", T0.date(), "s1", "r1", "NGN", D(5), T0)],
                               "source_system string, statement_date date, statement_line_id string, "
                               "external_reference string, currency_code string, amount decimal(20,8), value_at timestamp_ntz")
    own = spark.createDataFrame([("bank", T0.date(), "r1", "NGN", D(5), t, "l") for t in ("j1", "j2")],
                                "source_system string, statement_date date, external_reference string, currency_code string, "
                                "amount decimal(20,8), journal_transaction_id string, journal_line_id string")
    items, rejects = R.match_items(st, own, NOW)
    assert [r["journal_transaction_id"] for r in items.collect()] == ["j1"]
    assert [(r["statement_line_id"], r["reason"]) for r in rejects.collect()] == [("j2", "duplicate internal record")]
    done = R.mark_matched(items, NOW)
    batches = R.create_batch(st, NOW)
    assert [r["status"] for r in R.batch_rollup(batches, done, NOW).collect()] == ["matched"]
    assert [r["status"] for r in R.batch_rollup(batches, done.limit(0), NOW).collect()] == ["pending"]


def test_repeated_results_change_a_row_once(spark):
    box = S.conform(spark.createDataFrame([dict(id="e1", status="processing", retry_count=0)]), S.OUTBOX_EVENTS)
    res = spark.createDataFrame([("e1", False, "x", "m")] * 3,
                                "id string, delivered boolean, error_code string, error_message string")
    assert [(r["status"], r["retry_count"]) for r in O.mark_failed(box, res, NOW).collect()] == [("failed", 1)]
    hooks = S.conform(spark.createDataFrame([dict(id="h1", status="pending")]), S.INCOMING_WEBHOOKS)
    said = spark.createDataFrame([("h1", "failed", "e", 1), ("h1", "success", None, 2)],
                                 "id string, status string, error_message string, seq long")
    assert [r["status"] for r in O.update_webhook_status(hooks, said, NOW).collect()] == ["success"]
    acc = accounts(spark, ACC[:1])
    moves = spark.createDataFrame([("D1", "frozen", 1), ("D1", "closed", 2)], "id string, status string, seq long")
    assert [r["status"] for r in P.update_account_status(acc, moves, NOW).collect()] == ["closed"]
