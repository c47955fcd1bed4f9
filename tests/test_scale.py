"""What a step costs as its input grows: state calls, shuffles, passes over the input, rows of a task."""

from pyspark.sql import functions as F

from helpers import D, SYSTEM, T0, accounts
from tallybook import schemas as S
from tallybook import session
from tallybook.operators import constraints as K
from tallybook.operators import holds as H
from tallybook.operators import lookup as L
from tallybook.operators import validate as V
from tallybook.sources import ledger_io as IO
from tallybook.streaming import stateful as ST


class _Store:
    """One state value and the timers of a key, with the number of calls made."""

    def __init__(self):
        self.value, self.timers, self.calls = None, set(), 0

    def getValueState(self, name, schema):
        return self

    def exists(self):
        self.calls += 1
        return self.value is not None

    def get(self):
        self.calls += 1
        return self.value

    def update(self, value):
        self.calls += 1
        self.value = value

    def clear(self):
        self.calls += 1
        self.value = None

    def registerTimer(self, at):
        self.calls += 1
        self.timers.add(at)

    def deleteTimer(self, at):
        self.calls += 1
        self.timers.discard(at)

    def listTimers(self):
        self.calls += 1
        return iter(sorted(self.timers))


class _Clock:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms

    getExpiryTimeInMs = getCurrentWatermarkInMs


def _event(i, status="pending", at=1_000_000, retry=0):
    from pyspark.sql import Row
    return Row(id=f"OB{i}", status=status, retry_count=retry, changed_us=at, next_retry_us=None, event_type="t",
               partition_key="p", payload="{}")


def test_outbox_state_calls_do_not_grow_with_the_events():
    store = _Store()
    odd = lambda m: ("E", "no") if int(m["id"][2:]) % 2 and m["retry_count"] < 2 else None
    job = ST.OutboxRetry(odd, 5, True)
    job.init(store)
    list(job.handleInputRows((0,), iter([_event(i) for i in range(200)]), _Clock(0)))
    # A newer state of one event replaces it, an older one and one that is published elsewhere do not come out.
    list(job.handleInputRows((0,), iter([_event(0, at=999_999), _event(2, "published", 2_000_000), _event(4, at=3_000_000)]), _Clock(0)))
    first = list(job.handleExpiredTimer((0,), _Clock(1001), _Clock(1001)))
    assert {r.id for r in first} == {f"OB{i}" for i in range(200)} - {"OB2", "OB4"}
    assert {r.status for r in first if int(r.id[2:]) % 2} == {"failed"}
    rest = list(job.handleExpiredTimer((0,), _Clock(10 ** 9), _Clock(max(store.timers))))
    assert sorted((r.id, r.attempt, r.at_us, r.status) for r in rest if r.id in ("OB1", "OB4")) == [
        ("OB1", 2, 2_000_000, "failed"), ("OB1", 3, 4_000_000, "published"), ("OB4", 1, 3_000_000, "published")]
    assert len(rest) == 201 and store.value is None and store.calls < 30


def test_catalogue_meets_in_one_aggregate_of_fixed_width(spark):
    cust = spark.createDataFrame([("U1", "r"), ("U2", "r")], "id string, external_ref string")
    acc = spark.createDataFrame([("A1", "U1"), ("A2", "U9"), ("A3", "U9")], "id string, customer_id string")
    bad, _ = K.check_ledger({"customers": cust, "accounts": acc}, domains=False)
    plan = bad._jdf.queryExecution().executedPlan().toString()
    assert "ObjectHashAggregate" not in plan and plan.count("Exchange hashpartitioning") == 1
    assert {tuple(r) for r in bad.collect()} == {("unique_external_ref", "customers", "r", 2),
                                                 ("fk_customer_id", "accounts", "U9", 2)}


def test_references_do_not_shuffle_rows_by_their_key(spark, monkeypatch):
    rows = spark.range(500).select(F.col("id").cast("string").alias("id"), F.when(F.col("id") % 100 == 7, F.concat(F.lit("lost"), "id"))
                                   .when(F.col("id") != 3, F.lit("hot")).alias("a"))
    parent = spark.createDataFrame([("hot",), ("hot",), (None,)], "id string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for few in (V.BROADCAST_ROWS, 0):
            monkeypatch.setattr(V, "BROADCAST_ROWS", few)
            valid, bad = V.check_references(rows, "a", parent, "id", "t")
            assert "SortMergeJoin" not in bad._jdf.queryExecution().executedPlan().toString()
            assert sorted((r.key, r.detail) for r in bad.collect()) == sorted((str(k), f"lost{k}") for k in (7, 107, 207, 307, 407))
            assert valid.count() == 495
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_lines_for_transactions_tasks_follow_the_rows(spark, monkeypatch):
    monkeypatch.setattr(session, "ROWS_PER_TASK", 20)
    lines = spark.range(400).select((F.col("id") % 50).cast("string").alias("journal_transaction_id"),
                                    (400 - F.col("id")).alias("line_number"))
    txs = spark.createDataFrame([(str(k),) for k in [*range(0, 50, 2), 4, None]], "id string")
    for few in (L.BROADCAST_ROWS, 0):
        monkeypatch.setattr(L, "BROADCAST_ROWS", few)
        out = L.lines_for_transactions(lines, txs)
        assert out.rdd.getNumPartitions() >= 10
        got = [tuple(r) for r in out.collect()]
        assert got == sorted(got) and len(got) == 200


def _counted(spark, df):
    """``df`` with a filter that keeps and counts every row it is asked for."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("boolean")
    def keep(_):
        seen.add(1)
        return True
    return df.filter(keep.asNondeterministic()("id" if "id" in df.columns else "hook_id")), seen


def test_append_reads_the_lines_once(spark, tmp_path):
    heads = S.conform(spark.range(30).select(F.col("id").cast("string").alias("id"), F.lit("posted").alias("status"), F.expr(
        "date_add(date'2024-01-01', cast(id * 3 as int))").alias("accounting_date")), S.JOURNAL_TRANSACTIONS)
    legs = S.conform(spark.range(90).select(F.col("id").cast("string").alias("id"),
                                            (F.col("id") % 30).cast("string").alias("journal_transaction_id")), S.JOURNAL_LINES)
    legs, seen = _counted(spark, legs)
    IO.append_journal(heads, legs, str(tmp_path), rows_per_file=20)
    assert seen.value == 90
    t = IO.load_ledger(spark, str(tmp_path), ["journal_transactions", "journal_lines"])
    assert t["journal_lines"].count() == 90 and t["journal_transactions"].count() == 30


def test_settlement_reads_the_callbacks_once(spark):
    acc = accounts(spark, SYSTEM + [("A", "customer", "credit", "NGN")])
    trf = S.conform(spark.createDataFrame([(f"w{k}", "A", "NGN", D(5), T0, "pending") for k in range(4)],
                                          "id string, source_account_id string, currency_code string, amount decimal(20,8), "
                                          "requested_at timestamp_ntz, status string"), S.TRANSFER_REQUESTS)
    cb = spark.createDataFrame([(f"c{k}", e, T0, (f"w{k % 4}",)) for k, e in enumerate(
        ["transfer.success", "transfer.failed", "other", "transfer.success", "transfer.failed"])],
        "hook_id string, event string, received_at timestamp_ntz, data struct<reference: string>")
    cb, seen = _counted(spark, cb)
    out = H.settle_callbacks(cb, trf, H.create_holds(trf), acc, "2024-02-01 00:00:00")
    assert {r.id: r.status for r in out["holds"].collect()} == {"hold:w0": "consumed", "hold:w1": "released",
                                                                "hold:w2": "active", "hold:w3": "consumed"}
    assert out["legs"].count() == 4 and out["outcomes"].count() == 5 and seen.value == 5


def _hold_row(hold_id, action, amount, expires_us, at_us, seq):
    import json
    from pyspark.sql import Row
    cells = (hold_id, at_us, seq, action, amount, expires_us)
    return Row(bucket=0, event=json.dumps([None if c is None else str(c) for c in cells]))


def _holds_said(batches, release_remainder=True):
    """Transitions of one bucket, with the watermark a millisecond behind each batch and far ahead at the end; and its store."""
    store, said = _Store(), []
    job = ST.HoldLifecycle(release_remainder)
    job.init(store)
    ends = [max(b[4] for b in rows) // 1000 - 1 if rows else 0 for rows in batches[:-1]] + [10 ** 12]
    for rows, end in zip(batches, ends):
        list(job.handleInputRows((0,), iter([_hold_row(*r) for r in rows]), _Clock(0)))
        while store.timers and min(store.timers) <= end:
            fired = min(store.timers)
            for row in job.handleExpiredTimer((0,), _Clock(end), _Clock(fired)):
                said += [tuple(t.values()) for t in row.said]
            store.timers.discard(fired)
            assert len(store.timers) <= 1
    return sorted(said, key=str), store


def test_hold_state_calls_do_not_grow_with_the_holds():
    ms = 1000
    rows = [(f"H{i}", "create", "10.00000000", 90_000 * ms if i % 2 else None, i * ms, 1) for i in range(200)]
    rows += [(f"H{i}", "consume", "4.00000000", None, (500 + i) * ms, 2) for i in range(0, 200, 4)]
    got, store = _holds_said([rows, [("~", "tick", None, None, 10 ** 6 * ms, 0)]])
    assert store.calls < 30
    assert [sum(t[1] == s for t in got) for s in ("active", "consumed", "expired")] == [200, 50, 100]
    assert ("H4", "consumed", D(0), D(4), D(6), 504 * ms) in got and ("H1", "expired", D(0), D(0), D(10), 90_000 * ms) in got
    assert store.value is not None and not store.timers            # the 50 that never expire stay open
    keep, _ = _holds_said([rows], release_remainder=False)
    assert ("H4", "consumed", D(6), D(4), D(0), 504 * ms) in keep


def test_hold_bucket_does_not_depend_on_batches():
    """Odd ids, repeats, holds opened again and expiries between batches: as if each hold were alone, in one batch."""
    import random
    rnd = random.Random(7)
    ids = [None, "null", 'a"],["b', "é\n", *(f"H{k}" for k in range(8))]
    rows = sorted((((rnd.choice(ids), rnd.choice(["create", "create", "consume", "release", "tick"]),
                     rnd.choice([None, "-1", "0E-8", "3.50000000", "7.00000001"]),
                     rnd.choice([None, at + 20_000, at + 90_000, at - 1]), at, seq))
                   for seq, at in enumerate(rnd.randrange(0, 400_000) for _ in range(600))), key=lambda r: r[4])
    whole, _ = _holds_said([rows])
    assert {t[1] for t in whole} == {"active", "consumed", "released", "expired"}
    alone = [t for i in ids for t in _holds_said([[r for r in rows if r[0] == i]])[0]]
    assert sorted(alone, key=str) == whole
    cuts = [0, 1, 150, 150, 160, 480, 600]
    parts = [rnd.sample(rows[a:b], b - a) + rows[b - 3:b] * (b > a) for a, b in zip(cuts, cuts[1:])]
    assert _holds_said(parts)[0] == whole


def test_hold_rows_travel_as_one_text_each(spark, tmp_path):
    from datetime import timedelta
    from test_streaming import _drain, _stream
    t = lambda h: T0 + timedelta(hours=h)
    parts = [[('q"],[', "create", D(10), t(24), t(0), None), (None, "create", D(3), None, t(0), 1), ("h", None, D(1), None, t(0), 1),
              ("x", "create", D("0.00000001"), t(5), t(1), 1)],
             [('q"],[', "release", D(4), None, t(2), 2), ("late", "create", D(1), None, None, 1), ("m", "tick", None, None, t(20), 1)],
             [(None, "consume", D(3), None, t(20), 2), ("~end", "tick", None, None, t(1000), 0)]]
    schema = "hold_id string, action string, amount decimal(20,8), expires_at timestamp_ntz, event_time timestamp_ntz, seq long"
    got = _drain(spark, ST.stream_hold_timers(_stream(spark, tmp_path, parts, schema), buckets=2), tmp_path)
    assert {tuple(r) for r in got} == {
        ('q"],[', "active", D(10), D(0), D(0), t(0)), ('q"],[', "released", D(6), D(0), D(4), t(2)),
        (None, "active", D(3), D(0), D(0), t(0)), (None, "consumed", D(0), D(3), D(0), t(20)),
        ("x", "active", D("0.00000001"), D(0), D(0), t(1)), ("x", "expired", D(0), D(0), D("0.00000001"), t(5))}
    assert len(got) == 6
