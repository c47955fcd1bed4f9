"""Properties of the two streaming queries without a SQL oracle (output depends on
micro-batch boundaries / on how far the final watermark moved)."""

from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL
from tallybook.plans.inputs import Inputs


def test_stream_post_one_outcome_per_request(spark):
    out = E.queries()["stream_post"](spark, SF_SMALL)
    reqs = Inputs(spark, SF_SMALL).raw("fx_request_bodies")
    assert out.count() == reqs.count()
    assert out.select("request_id").distinct().count() == reqs.count()
    allowed = {"accepted", "rejected", "invalid", "ineligible", "replay", "conflict",
               "in_progress"}
    assert {r["outcome"] for r in out.select("outcome").distinct().collect()} <= allowed


def test_stream_post_matches_batch_when_one_batch(spark):
    """With everything in one micro-batch the stream equals the batch posting step."""
    from tallybook.schemas import IDEMPOTENCY_KEYS, conform
    from tallybook.streaming.posting import post_batch
    x = Inputs(spark, SF_SMALL)
    keys0 = conform(x.raw("fx_idem_keys"), IDEMPOTENCY_KEYS)
    res = post_batch(x.raw("fx_request_bodies"), x.customers, x.accounts, keys0,
                     x.projections, "2024-02-01 00:00:00")
    legs = res["legs"]
    bad = (legs.groupBy("journal_transaction_id")
           .agg(F.sum(F.when(F.col("side") == "debit", F.col("amount"))
                      .otherwise(-F.col("amount"))).alias("r"))
           .filter(F.col("r") != 0))
    assert bad.count() == 0
    assert res["leg_errors"].count() == 0
    proj = res["projection"]
    assert proj.filter(F.col("available_balance") + F.col("held_balance")
                       != F.col("ledger_balance")).count() == 0
    n_acc = res["outcomes"].filter(F.col("outcome") == "accepted").count()
    n_tx = legs.select("journal_transaction_id").distinct().count()
    assert n_acc == n_tx


def _request(rid, minute, kind, body, key=None):
    import json
    from helpers import T0
    from datetime import timedelta
    return (rid, kind, kind, key or rid, json.dumps(body), T0 + timedelta(minutes=minute))


REQUEST = "request_id string, scope string, kind string, idempotency_key string, body string, arrival timestamp_ntz"


def _deposit(rid, minute, to, amount, key=None):
    return _request(rid, minute, "deposit", dict(
        provider="p", idempotency_key_id=key or rid, customer_id="U" + to, destination_account_id=to, currency_code="NGN",
        source_system="app", amount=str(amount), fee_amount="0", client_reference="c" + (key or rid),
        external_reference="e" + (key or rid)), key)


def _transfer(rid, minute, a, b, amount, key=None):
    return _request(rid, minute, "transfer", dict(
        idempotency_key_id=key or rid, customer_id="U" + a, source_account_id=a, destination_account_id=b,
        currency_code="NGN", description="d", amount=str(amount), fee_amount="1", source_system="web",
        client_reference="c" + (key or rid)), key)


def _withdrawal(rid, minute, a, amount):
    return _request(rid, minute, "withdrawal", dict(
        idempotency_key_id=rid, customer_id="U" + a, source_account_id=a, destination_account_id=a, currency_code="NGN",
        source_system="app", amount=str(amount), fee_amount="0", client_reference="c" + rid, external_reference="e" + rid))


def _post_stream(spark, tmp_path, batches, compact_every):
    """One file per micro-batch."""
    from helpers import SYSTEM, accounts, empty_projection
    from tallybook import schemas as S
    from tallybook.streaming import jobs as J
    from tallybook.streaming import posting as SP
    acc = accounts(spark, SYSTEM + [("A", "customer", "credit", "NGN"), ("B", "customer", "credit", "NGN")])
    cust = S.conform(spark.createDataFrame([("UA", "active"), ("UB", "active"), ("USETTLE", "active"), ("UFEE", "active")],
                                           "id string, status string"), S.CUSTOMERS)
    where = str(tmp_path)
    for rows in batches:
        spark.createDataFrame(rows, REQUEST).coalesce(1).write.mode("append").parquet(f"{where}/in")
    stream = J.read_requests(spark, fmt="parquet", path=f"{where}/in", schema=spark.createDataFrame([], REQUEST).schema,
                             options={"maxFilesPerTrigger": 1})
    q = SP.stream_post(spark, stream, cust, acc, S.conform(spark.createDataFrame([], "id string"), S.IDEMPOTENCY_KEYS),
                       empty_projection(spark), f"{where}/out", f"{where}/ckpt", None, compact_every=compact_every)
    q.awaitTermination()
    assert q.exception() is None
    rows = lambda t: SP.committed_rows(spark, f"{where}/out", t).collect()
    state = {t: SP.read_state(spark, f"{where}/out", t, 10 ** 9, spark.createDataFrame([], schema)).collect()
             for t, schema in (("keys", S.IDEMPOTENCY_KEYS), ("projection", S.BALANCE_PROJECTIONS), ("holds", S.FUNDS_HOLDS))}
    return rows, state


def test_stream_post_scenario(spark, tmp_path):
    """Deposits, transfers, retries, a withdrawal whose hold expires: state carried over four batches."""
    from helpers import D
    day = 24 * 60
    batches = [
        [_deposit("d1", 0, "A", 100), _transfer("t1", 1, "A", "B", 30), _transfer("t2", 2, "A", "B", 500)],
        [_deposit("d1r", 3, "A", 100, key="d1"), _transfer("t1x", 4, "A", "B", 31, key="t1"), _withdrawal("w1", 5, "A", 50)],
        [_transfer("t3", 6, "A", "B", 40), _transfer("t4", 7, "A", "B", 10)],
        [_transfer("t5", day + 10, "A", "B", 40)]]
    for every in (2,):                        # a full copy of the state after two batches
        rows, state = _post_stream(spark, tmp_path / str(every), batches, every)
        assert {r.request_id: r.outcome for r in rows("outcomes")} == {
            "d1": "accepted", "t1": "accepted", "t2": "rejected", "d1r": "replay", "t1x": "conflict", "w1": "accepted",
            "t3": "rejected", "t4": "accepted", "t5": "accepted"}
        assert {r.id: r.status for r in rows("transfers")} == {
            "d1": "posted", "t1": "posted", "w1": "pending", "t4": "posted", "t5": "posted"}
        heads = {r.id: (r.status, r.entry_type, r.source_system) for r in rows("journal")}
        assert heads == {"deposit:d1": ("posted", "deposit", "app"), "transfer:t1": ("posted", "transfer", "web"),
                         "hold:w1": ("pending", "hold", "core"), "transfer:t4": ("posted", "transfer", "web"),
                         "transfer:t5": ("posted", "transfer", "web")}
        assert {r.journal_transaction_id for r in rows("legs")} == set(heads)
        events = {r.id: (r.aggregate_type, r.headers) for r in rows("events")}
        assert set(events) == {"transfer.posted:" + i for i in ("d1", "t1", "t4", "t5")}
        assert events["transfer.posted:d1"] == ("deposit_request", '{"client_reference":"cd1","content_type":"application/json",'
                                                '"event_transaction":"ref:deposit:d1","source_system":"app"}')
        (hold,) = state["holds"]
        assert (hold.id, hold.status, hold.released_amount, hold.remaining_amount) == ("hold:w1", "expired", D(50), D(0))
        bal = {r.account_id: (r.ledger_balance, r.available_balance, r.held_balance, r.last_transaction_id, r.last_line_id)
               for r in state["projection"]}
        assert bal["A"] == (D(17), D(17), D(0), "transfer:t5", "transfer:t5#1")       # 100 - 31 - 11 - 41
        assert bal["B"] == (D(80), D(80), D(0), "transfer:t5", "transfer:t5#2")
        assert bal["FEE"][0] == D(3) and bal["SETTLE"][3:] == ("deposit:d1", "deposit:d1#1")
        assert {r.idempotency_key: r.response_code for r in state["keys"]}["t5"] == 201


def test_stream_post_does_not_depend_on_batches(spark, tmp_path):
    import random
    rnd = random.Random(4)
    rows = [_deposit("d0", 0, "A", 60), _deposit("d00", 0, "B", 60)]
    for k in range(40):
        a, b = rnd.sample("AB", 2)
        rows.append(_transfer(f"t{k:02}", k + 1, a, b, rnd.randint(1, 40)) if k % 3 else _withdrawal(f"w{k:02}", k + 1, a, rnd.randint(1, 20)))
    got = []
    for name, cuts in (("one", [0, 42]), ("many", [0, 6, 30, 42])):
        said, state = _post_stream(spark, tmp_path / name, [rows[i:j] for i, j in zip(cuts, cuts[1:])], 3)
        got.append((sorted((r.request_id, r.outcome) for r in said("outcomes")), sorted(r.id for r in said("legs")),
                    sorted((r.account_id, r.ledger_balance, r.held_balance, r.last_line_id) for r in state["projection"]),
                    sorted((r.id, r.status) for r in state["holds"])))
    assert got[0] == got[1]
    assert {o for _, o in got[0][0]} == {"accepted", "rejected"}


# ---------------------------------------------------------------- stateful processors

def _stream(spark, tmp_path, parts, schema):
    from tallybook.streaming import jobs as J
    for rows in parts:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    return J.read_requests(spark, fmt="parquet", path=f"{tmp_path}/in", schema=spark.createDataFrame([], schema).schema,
                           options={"maxFilesPerTrigger": 1})


def _drain(spark, df, where):
    from tallybook.streaming import jobs as J
    q = J.run(df.writeStream.foreachBatch(J.batch_sink(f"{where}/out")), f"{where}/ckpt")
    q.awaitTermination()
    assert q.exception() is None
    return J.read_sink(spark, f"{where}/out").drop("batch_id").collect()


def test_hold_lifecycle_whatever_the_batches(spark, tmp_path):
    """Out of order within the lateness, at-least-once repeats, no expiry, moves at and after the expiry."""
    from datetime import timedelta
    from decimal import Decimal
    from helpers import D, T0
    from tallybook.streaming import stateful as S
    t = lambda h: None if h is None else T0 + timedelta(hours=h)
    ev = [("h1", "create", D(10), t(24), t(0), 1), ("h1", "consume", D(4), None, t(1), 2), ("h1", "release", D(1), None, t(2), 3),
          ("h2", "create", D(10), None, t(0), 1), ("h2", "release", D(4), None, t(400), 2),
          ("h3", "create", D(5), t(24), t(0), 1), ("h3", "consume", D(6), None, t(1), 2), ("h3", "consume", D(5), None, t(24), 3),
          ("h4", "consume", D(1), None, t(0), 1), ("h4", "create", D(2), t(3), t(1), 2), ("h4", "consume", D(2), None, t(2), 3),
          ("h5", "create", D(7), None, t(5), 1), ("h6", "create", D(0), t(9), t(1), 1), ("h6", "consume", None, None, t(2), 2)]
    want = {("h1", "active", D(10), D(0), D(0), t(0)), ("h1", "consumed", D(0), D(4), D(6), t(1)),
            ("h2", "active", D(10), D(0), D(0), t(0)), ("h2", "released", D(6), D(0), D(4), t(400)),
            ("h3", "active", D(5), D(0), D(0), t(0)), ("h3", "expired", D(0), D(0), D(5), t(24)),
            ("h4", "active", D(2), D(0), D(0), t(1)), ("h4", "consumed", D(0), D(2), D(0), t(2)),
            ("h5", "active", D(7), D(0), D(0), t(5))}
    schema = "hold_id string, action string, amount decimal(20,8), expires_at timestamp_ntz, event_time timestamp_ntz, seq long"
    end = [("~end", "tick", None, None, t(10_000), 0)]
    for name, parts in (("one", [ev, end]), ("mixed", [ev[::2], ev[1::2] + ev[:3], end]), ("back", [ev[7:], ev[:7], end])):
        where = tmp_path / name
        out = S.stream_hold_timers(_stream(spark, where, parts, schema), late="500 hours")
        got = _drain(spark, out, where)
        assert len(got) == len(want)
        assert {(r.hold_id, r.status, r.remaining_amount, r.captured_amount, r.released_amount, r.event_time) for r in got} == want
    assert Decimal(0) == D(0)


def test_settlement_desk(spark, tmp_path):
    from datetime import timedelta
    from helpers import D, SYSTEM, T0, accounts
    from tallybook.streaming import stateful as S
    from pyspark.sql import functions as F
    t = lambda h: T0 + timedelta(hours=h)
    acc = accounts(spark, SYSTEM + [("A", "customer", "credit", "NGN")])
    wd = [("w1", "A", "NGN", D(5), t(0)), ("w2", "A", "NGN", D(6), t(0)), ("w3", "A", "USD", D(7), t(0)), ("w4", "A", "NGN", D(8), t(1)),
          ("w5", "A", "NGN", D(9), t(1))]
    ok, bad, odd = "transfer.success", "transfer.failed", "charge.unknown"
    cb = [("c1", "w1", ok, t(1)), ("c2", "w1", bad, t(2)), ("c3", "w1", ok, t(3)), ("c4", "w2", odd, t(1)), ("c5", "w2", bad, t(2)),
          ("c6", "w2", bad, t(3)), ("c7", "w3", ok, t(1)), ("c8", "w4", ok, t(25)), ("c9", "w9", ok, t(1))]
    w = _stream(spark, tmp_path / "w", [wd, [("~", "A", "NGN", D(1), t(9000))]],
                "request_id string, source_account_id string, currency_code string, amount decimal(20,8), requested_at timestamp_ntz")
    c = _stream(spark, tmp_path / "c", [cb[::-1], [("~", "~none", ok, t(9000))]],
                "hook_id string, ref string, event string, received_at timestamp_ntz")
    out = S.stream_settlement(w, c.withColumn("data", F.struct(F.col("ref").alias("reference"))), acc)
    got = {(r.transfer_id, r.hook_id): (r.outcome, r.reason) for r in _drain(spark, out, tmp_path)}
    assert got == {("w1", "c1"): ("posted", None), ("w1", "c2"): ("rejected", "no active hold"),
                   ("w1", "c3"): ("rejected", "transfer already processed"), ("w2", "c4"): ("rejected", "unhandled event: charge.unknown"),
                   ("w2", "c5"): ("failed", None), ("w2", "c6"): ("skipped", "transfer already failed"),
                   ("w3", "c7"): ("rejected", "no settlement account"), ("w3", None): ("expired", "no callback in time"),
                   ("w4", "c8"): ("rejected", "no active hold"), ("w4", None): ("expired", "no callback in time"),
                   ("w5", None): ("expired", "no callback in time")}
