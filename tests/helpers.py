"""Tiny typed frames for scenario tests."""

from datetime import datetime, timedelta
from decimal import Decimal

from pyspark.sql import functions as F

from tallybook import schemas as S

T0 = datetime(2024, 1, 1)


def D(x) -> Decimal:
    return Decimal(str(x)).quantize(Decimal("0.00000001"))


def accounts(spark, rows):
    """rows: (id, type, normal_side, currency)."""
    data = [dict(id=i, customer_id="U" + i, external_ref="ref_" + i, account_number="n" + i,
                 account_type=t, status="active", currency_code=c, ledger_normal_side=s,
                 metadata="{}") for i, t, s, c in rows]
    df = spark.createDataFrame(data)
    return S.conform(df, S.ACCOUNTS)


SYSTEM = [("SETTLE", "settlement", "credit", "NGN"), ("FEE", "fee", "credit", "NGN")]


def ops(spark, rows):
    """rows: (op_id, minutes, type, source, dest, amount, fee, hold_op_id)."""
    data = [dict(op_id=o, op_ts=T0 + timedelta(minutes=m), seq_key=i, op_type=t,
                 source_account_id=s, destination_account_id=d, currency_code="NGN",
                 amount=D(a), fee_amount=D(f), hold_op_id=h)
            for i, (o, m, t, s, d, a, f, h) in enumerate(rows)]
    schema = ("op_id string, op_ts timestamp_ntz, seq_key long, op_type string, "
              "source_account_id string, destination_account_id string, currency_code string, "
              "amount decimal(20,8), fee_amount decimal(20,8), hold_op_id string")
    return spark.createDataFrame(data, schema)


def empty_projection(spark):
    return spark.createDataFrame([], S.BALANCE_PROJECTIONS)


def opening(spark, rows):
    return spark.createDataFrame([(a, D(b)) for a, b in rows],
                                 "account_id string, available_balance decimal(20,8)")


def as_dict(df, key, value):
    return {r[key]: r[value] for r in df.select(key, value).collect()}


def col(name):
    return F.col(name)
