"""Two-level running sums agree with a plain window when one key holds most rows and its rows
span many chunks (the shape of a system account)."""

from datetime import datetime, timedelta
from decimal import Decimal

from pyspark.sql import Window
from pyspark.sql import functions as F

from tallybook.functions.windows import chunked_running_sum


def test_chunked_running_sum_matches_window_on_hot_key(spark):
    t0 = datetime(2024, 1, 1)
    rows = [("HOT" if i % 10 else f"K{i % 7}", t0 + timedelta(minutes=7 * i), i,
             Decimal(i % 13) - Decimal(6)) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, seq long, v decimal(20,8)")
    order = [F.col("ts"), F.col("seq")]
    got = chunked_running_sum(df, ["k"], order, {"run": F.col("v")},
                              F.window("ts", "1 hour").start)
    got_ex = chunked_running_sum(df, ["k"], order, {"before": F.col("v")},
                                 F.window("ts", "1 hour").start, inclusive=False)
    w = Window.partitionBy("k").orderBy(*order)
    want = df.select("seq", F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0))
                     .alias("run"),
                     F.coalesce(F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, -1)),
                                F.lit(0)).alias("before"))
    a = {r["seq"]: r["run"] for r in got.collect()}
    b = {r["seq"]: r["before"] for r in got_ex.collect()}
    for r in want.collect():
        assert a[r["seq"]] == r["run"] and b[r["seq"]] == r["before"]


def test_account_statement_hot_account(spark):
    """A statement where one account takes every line still equals the direct running sum."""
    import __spark_entry__ as E
    from conftest import SF_SMALL
    st = E.queries()["account_statement"](spark, SF_SMALL)
    hot = st.groupBy("account_id").count().orderBy(F.desc("count")).first()["account_id"]
    rows = st.filter(F.col("account_id") == hot).orderBy(
        "posted_at", "journal_transaction_id", "line_number").collect()
    run = Decimal(0)
    for r in rows:
        run += r["signed_amount"]
        assert r["running_balance"] == run
