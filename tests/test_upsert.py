"""E5 against a sequential replay: long chains, stale updates, new keys."""

import random

from pyspark.sql import functions as F

from helpers import D
from tallybook import schemas as S
from tallybook.operators import projections as PJ

UPDATES = ("account_id string, currency_code string, balance_kind string, ledger_balance decimal(20,8), "
           "available_balance decimal(20,8), held_balance decimal(20,8), last_transaction_id string, "
           "last_line_id string, expected_version long, seq long")


def test_long_chains_equal_a_replay(spark):
    rng = random.Random(9)
    stored = {"A": 5, "B": 0, "C": 2}
    rows = [("A", 5 + i, i) for i in range(200)]                       # one key, 200 good updates
    rows += [(k, rng.randrange(6), 1000 + i) for i, k in enumerate(rng.choices("BCDE", k=120))]
    proj = spark.createDataFrame([dict(account_id=k, currency_code="NGN", balance_kind="available",
                                       ledger_balance=D(0), available_balance=D(0), held_balance=D(0), version=v)
                                  for k, v in stored.items()])
    proj = S.conform(proj, S.BALANCE_PROJECTIONS)
    ups = spark.createDataFrame([(k, "NGN", "available", D(q), D(q), D(0), None, f"l{q}", e, q) for k, e, q in rows],
                                UPDATES)
    state, conflicts = {k: (v, D(0)) for k, v in stored.items()}, set()
    for k, e, q in sorted(rows, key=lambda r: r[2]):
        if k not in state or state[k][0] == e:
            state[k] = (state[k][0] + 1 if k in state else 1, D(q))
        else:
            conflicts.add((k, q))
    out, bad = PJ.upsert_expected_version(proj, ups, "2024-02-01 00:00:00")
    assert {r["account_id"]: (r["version"], r["ledger_balance"]) for r in out.collect()} == state
    assert {(r["account_id"], r["seq"]) for r in bad.collect()} == conflicts
    assert state["A"][0] == 205
    again, none = PJ.upsert_expected_version(proj, ups.limit(0), "2024-02-01 00:00:00")
    assert none.count() == 0 and again.agg(F.sum("version")).first()[0] == 7


def test_many_updates_expect_one_version(spark):
    """300 updates of one key expect version 1; one of them applies, after the update that leads there."""
    rows = [("A", 1, q) for q in range(100)] + [("A", 0, 100)] + [("A", 1, q) for q in range(101, 300)] + [("A", 2, 300)]
    proj = S.conform(spark.createDataFrame([dict(account_id="A", currency_code="NGN", balance_kind="available", ledger_balance=D(0),
                                                 available_balance=D(0), held_balance=D(0), version=0)]), S.BALANCE_PROJECTIONS)
    ups = spark.createDataFrame([(k, "NGN", "available", D(q), D(q), D(0), None, f"l{q}", e, q) for k, e, q in rows], UPDATES)
    out, bad = PJ.upsert_expected_version(proj, ups, "2024-02-01 00:00:00")
    assert [(r["version"], r["last_line_id"]) for r in out.collect()] == [(3, "l300")]
    assert {r["seq"] for r in bad.collect()} == set(range(300)) - {100, 101}
