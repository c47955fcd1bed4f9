"""F5 against a sequential loop on random inputs, including a hot account."""

import random
from decimal import Decimal

import pytest

from pyspark.sql import functions as F

from helpers import D, opening, ops
from tallybook.functions.graph import account_components
from tallybook.operators import admission as A


def sequential(op_rows, open_rows):
    bal = {a: D(b) for a, b in open_rows}
    dec = {}
    for o, _m, t, s, d, a, f, h in op_rows:          # rows are already in order
        a, f = D(a), D(f)
        if t == "deposit":
            dec[o] = "accepted"
            bal[d] = bal.get(d, Decimal(0)) + a
        elif t in ("transfer", "hold"):
            need = a + (f if t == "transfer" else 0)
            if bal.get(s, Decimal(0)) >= need:
                dec[o] = "accepted"
                bal[s] = bal.get(s, Decimal(0)) - need
                if t == "transfer":
                    bal[d] = bal.get(d, Decimal(0)) + a
            else:
                dec[o] = "rejected"
        else:
            dec[o] = dec.get(h)
            if t == "settle_failed" and dec.get(h) == "accepted":
                bal[s] = bal.get(s, Decimal(0)) + a
    return dec


def random_ops(seed, n, n_accounts, hot=False):
    rnd = random.Random(seed)
    accts = [f"A{i}" for i in range(n_accounts)]
    rows, holds = [], []
    for i in range(n):
        pick = (lambda: "A0") if hot and rnd.random() < 0.5 else (lambda: rnd.choice(accts))
        r = rnd.random()
        if r < 0.25:
            rows.append((f"o{i}", i, "deposit", None, pick(), rnd.randint(1, 50), 0, None))
        elif r < 0.7:
            s = pick()
            d = rnd.choice([x for x in accts if x != s])
            rows.append((f"o{i}", i, "transfer", s, d, rnd.randint(1, 60), rnd.choice([0, 1]),
                         None))
        elif r < 0.85:
            s = pick()
            rows.append((f"o{i}", i, "hold", s, None, rnd.randint(1, 40), 0, None))
            holds.append((f"o{i}", s, rows[-1][5]))
        elif holds:
            h, s, a = holds.pop(rnd.randrange(len(holds)))
            t = rnd.choice(["settle_failed", "settle_success"])
            rows.append((f"o{i}", i, t, s, None, a, 0, h))
    return rows


@pytest.mark.parametrize("seed,n,k,hot,cut,worth", [
    (1, 120, 5, False, 30, 0), (2, 200, 3, False, 10_000, 0), (3, 150, 8, True, 60, 16), (4, 40, 2, True, 10, 0),
    (5, 300, 60, False, 25, 0)])
def test_admit_equals_sequential(spark, monkeypatch, seed, n, k, hot, cut, worth):
    """``worth`` 0: one round of bounds, then components in slices; 16: the shipped rule."""
    monkeypatch.setattr(A, "WORTH", worth)
    rows = random_ops(seed, n, k, hot)
    open_rows = [("A1", 30)]
    got = {r["op_id"]: r["status"] for r in A.admit(ops(spark, rows), opening(spark, open_rows), slice_ops=cut).collect()}
    assert got == sequential(rows, open_rows)


def test_account_components(spark):
    rnd = random.Random(3)
    links = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(180)] + [(i, i + 1) for i in range(1000, 1300)]
    links += [(2000, i) for i in range(2001, 2400)]
    up = {}

    def top(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x
    for a, b in links:
        x, y = sorted((top(a), top(b)))
        up[y] = x
    got = {r.node: r.component for r in account_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: top(x) for x in up}
    assert account_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_admit_hold_settled_on_another_account(spark):
    """The accounts that one hold and its settlements name are one component."""
    rows = [("o1", 0, "hold", "A1", None, 10, 0, None), ("o2", 1, "settle_failed", "A2", None, 10, 0, "o1"),
            ("o3", 2, "settle_failed", "A3", None, 10, 0, "o1"), ("o4", 3, "transfer", "A2", "A3", 10, 0, None),
            ("o5", 4, "transfer", "A3", "A1", 20, 0, None)]
    for cut in (2, 100):
        got = A.admit(ops(spark, rows), opening(spark, [("A1", 10)]), slice_ops=cut).collect()
        assert {r["op_id"]: r["status"] for r in got} == {f"o{k}": "accepted" for k in range(1, 6)}


def test_admit_excludes_system_accounts(spark):
    rows = [("o1", 0, "transfer", "SYS", "A1", 100, 0, None),
            ("o2", 1, "transfer", "A1", "A2", 60, 0, None),
            ("o3", 2, "transfer", "A1", "A2", 60, 0, None)]
    ex = spark.createDataFrame([("SYS",)], "id string")
    got = {r["op_id"]: r["status"] for r in
           A.admit(ops(spark, rows), opening(spark, []), exclude_accounts=ex).collect()}
    assert got == {"o1": "accepted", "o2": "accepted", "o3": "rejected"}


def test_admit_long_chain_and_untimed_op(spark):
    """500 accounts, each paying the next with what it has just received; an op without a time."""
    rows = [(f"t{i}", i, "transfer", f"A{i}", f"A{i + 1}", 10, 0, None) for i in range(500)]
    frame = ops(spark, rows)
    bad = frame.limit(1).withColumn("op_id", F.lit("bad")).withColumn(
        "op_ts", F.lit(None).cast("timestamp_ntz"))
    out = A.admit(frame.unionByName(bad), opening(spark, [("A0", 10)]), slice_ops=120).collect()
    assert {r["rounds"] for r in out} == {1 + 5}           # bounds, then five slices of the one component
    assert {r["op_id"]: r["status"] for r in out} == {r[0]: "accepted" for r in rows} | {"bad": "invalid"}


def test_admit_currencies_and_sides(spark):
    """Balances in another currency do not count; a debit-normal account grows by debits."""
    o = ops(spark, [("o1", 0, "transfer", "A1", "A2", 10, 0, None), ("o2", 1, "hold", "D1", None, 10, 0, None),
                    ("o3", 2, "hold", "D1", None, 10, 0, None), ("o4", 3, "settle_failed", "D1", None, 10, 0, "o3")])
    bal = spark.createDataFrame([("A1", "USD", D(50)), ("D1", "NGN", D(15))],
                                "account_id string, currency_code string, available_balance decimal(20,8)")
    acc = spark.createDataFrame([("A1", "credit"), ("A2", "credit"), ("D1", "debit")],
                                "id string, ledger_normal_side string")
    got = A.admit(o, bal, acc)
    assert {r["op_id"]: r["status"] for r in got.collect()} == {
        "o1": "rejected", "o2": "accepted", "o3": "rejected", "o4": "rejected"}
    left = {(r["account_id"], r["currency_code"]): r["available_balance"]
            for r in A.admitted_balances(got, bal, acc).collect()}
    assert left[("D1", "NGN")] == D(5) and left[("A1", "USD")] == D(50)


@pytest.mark.parametrize("cut", [2, 10_000])
def test_admit_ops_without_account_or_amount(spark, cut):
    o = ops(spark, [("o1", 0, "transfer", None, "A1", 10, 0, None), ("o2", 1, "hold", "A1", None, 10, 0, None),
                    ("o3", 2, "transfer", "A1", "A2", 5, 0, None), ("o4", 3, "transfer", "A1", None, 5, 0, None),
                    ("o5", 4, "hold", "A1", None, 15, 0, None), ("o6", 5, "deposit", None, "A1", 5, 0, None)])
    o = o.withColumn("amount", F.expr("if(op_id in ('o3', 'o6'), null, amount)"))
    got = A.admit(o, opening(spark, [("A1", 24)]), slice_ops=cut)
    assert {r["op_id"]: r["status"] for r in got.collect()} == {
        "o1": "invalid", "o2": "accepted", "o3": "invalid", "o4": "invalid", "o5": "rejected", "o6": "invalid"}
    left = {r["account_id"]: r["available_balance"]
            for r in A.admitted_balances(got, opening(spark, [("A1", 24)])).collect()}
    assert left == {"A1": D(14)}
