"""Column helpers and small operators, mirroring the reference's unit-test subjects: UUID
parsing, decimal round trip, hash determinism, balanced / unbalanced legs, paging bounds."""

import hashlib
from decimal import Decimal

from pyspark.sql import functions as F

from tallybook.functions.money import money, money_text
from tallybook.functions.text import is_uuid, json_is_object, request_hash
from tallybook.operators import lookup as L
from tallybook.operators import validate as V


def test_page_bounds():
    assert L.page_bounds(None, None) == (50, 0)
    assert L.page_bounds(0, -3) == (50, 0)
    assert L.page_bounds(5000, 7) == (1000, 7)
    assert L.page_bounds(10, 20) == (10, 20)


def test_text_helpers(spark):
    df = spark.createDataFrame(
        [("0f8fad5b-d9cb-469f-a165-70867728950e", '{"a":1}', "100.005000001", "body"),
         ("not-a-uuid", "[]", "not-a-number", "body"),
         (None, "{", None, "other")],
        "u string, j string, amt string, b string")
    r = df.select(is_uuid("u").alias("uuid"), json_is_object("j").alias("obj"),
                  F.col("amt").try_cast("decimal(20,8)").alias("m"),
                  money_text(F.col("amt").try_cast("decimal(20,8)")).alias("txt"),
                  request_hash("b").alias("h")).collect()
    assert [x["uuid"] for x in r] == [True, False, None]
    assert [x["obj"] for x in r] == [True, False, False]
    assert r[0]["m"] == Decimal("100.00500000") and r[1]["m"] is None
    assert r[1]["txt"] == "0.00"
    assert r[0]["h"] == r[1]["h"] == hashlib.sha256(b"body").hexdigest()


def test_money_rounds_half_up(spark):
    v = spark.range(1).select(money(F.lit(Decimal("0.000000005"))).alias("m")).first()["m"]
    assert v == Decimal("0.00000001")


def test_legs_balanced_and_unbalanced(spark):
    legs = spark.createDataFrame(
        [("ok", "debit", Decimal(100)), ("ok", "credit", Decimal(100)),
         ("bad", "debit", Decimal(100)), ("bad", "credit", Decimal(50)),
         ("side", "debit", Decimal(10)), ("side", "sideways", Decimal(10)),
         ("null", "debit", None), ("null", "credit", Decimal(0))],
        "journal_transaction_id string, side string, amount decimal(20,8)")
    valid, bad = V.check_legs(legs)
    got = {r["key"]: r["rule"] for r in bad.collect()}
    assert got == {"bad": "unbalanced", "side": "invalid_side"}
    assert {r["journal_transaction_id"] for r in valid.collect()} == {"ok", "null"}


def test_lookup_non_unique_takes_smallest_id(spark):
    hooks = spark.createDataFrame([("h2", "p", "e1"), ("h1", "p", "e1"), ("h3", "p", "e2")],
                                  "id string, provider string, external_event_id string")
    keys = spark.createDataFrame([("p", "e1"), ("p", "e9")],
                                 "provider string, external_event_id string")
    out = {(r["external_event_id"]): (r["r_id"], r["found"]) for r in
           L.lookup(hooks, keys, ["provider", "external_event_id"], unique=False).collect()}
    assert out == {"e1": ("h1", True), "e9": (None, False)}
