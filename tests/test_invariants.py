"""Invariants on operator outputs over the sf0.001 fixtures: balanced legs, hold components,
projection formula, conflicts never applied."""

from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL


def _q(spark, name):
    return E.queries()[name](spark, SF_SMALL)


def _balanced(legs):
    s = legs.groupBy("journal_transaction_id").agg(
        F.sum(F.when(F.col("side") == "debit", F.col("amount")).otherwise(-F.col("amount")))
        .alias("r"))
    return s.filter(F.col("r") != 0).count() == 0


def test_all_leg_builders_balance(spark):
    for name in ("transfer_legs", "deposit_legs", "hold_legs", "settlement_legs",
                 "settle_callbacks_legs"):
        assert _balanced(_q(spark, name)), name


def test_hold_components_sum(spark):
    from tallybook.plans.inputs import Inputs
    amounts = Inputs(spark, SF_SMALL).holds.select("id", "amount")
    for name in ("consume_holds", "release_holds", "expire_holds"):
        df = _q(spark, name).join(amounts, "id")
        bad = df.filter(F.col("remaining_amount") + F.col("released_amount")
                        + F.col("captured_amount") != F.col("amount"))
        assert bad.count() == 0, name
        assert df.filter(F.col("remaining_amount") < 0).count() == 0, name


def test_rebuilt_projection_formula(spark):
    df = _q(spark, "rebuild_projection")
    assert df.filter(F.col("available_balance") + F.col("held_balance")
                     != F.col("ledger_balance")).count() == 0


def test_trial_balance_rollup_zero_for_balanced_journal(spark):
    tb = _q(spark, "trial_balance")
    grand = tb.filter(F.col("currency_code").isNull() & F.col("accounting_date").isNull())
    assert grand.first()["difference"] == 0


def test_upsert_conflicts_not_applied(spark):
    out = _q(spark, "upsert_expected_version")
    conflicts = _q(spark, "upsert_expected_version_conflicts")
    assert out.count() == out.select("account_id", "currency_code", "balance_kind").distinct().count()
    assert conflicts.count() > 0


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["account_id", "currency_code", "ledger_balance", "n_lines"]
