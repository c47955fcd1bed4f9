"""Balances at instants, incremental totals, journal appends, snapshot digests, constraint catalogue, latency sketches."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from helpers import D, T0
from tallybook import schemas as S
from tallybook.operators import balances as B
from tallybook.operators import constraints as K
from tallybook.operators import provider as PR
from tallybook.plans.inputs import Inputs
from tallybook.session import checkpoint_dir
from tallybook.sources import ledger_io as IO
from tallybook.sources import snapshots as SN


def journal(spark, rows):
    """rows: (id, status, day) → headers."""
    data = [(i, s, date(2024, 1, 1) + timedelta(days=d), T0 + timedelta(days=d) if s == "posted" else None, T0)
            for i, s, d in rows]
    return S.conform(spark.createDataFrame(
        data, "id string, status string, accounting_date date, posted_at timestamp_ntz, created_at timestamp_ntz"), S.JOURNAL_TRANSACTIONS)


def lines(spark, rows):
    """rows: (tx, number, account, side, amount) → lines."""
    data = [(f"{t}#{n}", t, n, a, s, D(m), "NGN", "available", T0) for t, n, a, s, m in rows]
    return S.conform(spark.createDataFrame(
        data, "id string, journal_transaction_id string, line_number int, account_id string, side string, "
              "amount decimal(20,8), currency_code string, balance_kind string, created_at timestamp_ntz"), S.JOURNAL_LINES)


def accounts(spark, ids):
    return S.conform(spark.createDataFrame([(i, "credit", "NGN") for i in ids],
                                           "id string, ledger_normal_side string, currency_code string"), S.ACCOUNTS)


def random_journal(seed, n=120, n_accounts=4, hot=0.9):
    rnd = random.Random(seed)
    heads, legs = [], []
    for k in range(n):
        heads.append((f"J{k:03}", rnd.choice(["posted", "posted", "posted", "pending", "failed"]), rnd.randrange(90)))
        a, b = ("A0" if rnd.random() < hot else f"A{rnd.randrange(n_accounts)}"), f"A{rnd.randrange(n_accounts)}"
        m = rnd.randint(1, 50)
        legs += [(f"J{k:03}", 1, a, "debit", m), (f"J{k:03}", 2, b, "credit", m)]
    return heads, legs


def test_balances_at_against_a_loop(spark):
    heads, legs = random_journal(1)
    rnd = random.Random(2)
    day = {h[0]: h[2] for h in heads if h[1] == "posted"}
    order = sorted((day[t], t, n, a, m if s == "credit" else -m) for t, n, a, s, m in legs if t in day)
    asked = [(f"p{k}", "A0" if k % 5 else f"A{k % 4}", "NGN" if k % 7 else "USD", None if k % 41 == 40 else
              T0 + timedelta(days=rnd.randrange(-3, 95))) for k in range(200)]
    probes = spark.createDataFrame(asked, "probe_id string, account_id string, currency_code string, at timestamp_ntz")
    got = {r.probe_id: r for r in B.balances_at(probes, lines(spark, legs), journal(spark, heads), accounts(spark, ["A0", "A1", "A2", "A3"])).collect()}
    assert len(got) == 200
    for p, a, cur, at in asked:
        r = got[p]
        if at is None:
            assert r.balance is None and r.n_lines is None
            continue
        seen = [x for x in order if x[3] == a and cur == "NGN" and T0 + timedelta(days=x[0]) <= at]
        assert (r.balance, r.n_lines) == (D(sum(x[4] for x in seen)), len(seen))
        assert r.last_line_id == (f"{seen[-1][1]}#{seen[-1][2]}" if seen else None)


@pytest.mark.parametrize("seed", [3, 4])
def test_totals_after_any_split_equal_a_rebuild(spark, seed):
    heads, legs = random_journal(seed)
    rnd = random.Random(seed)
    all_lines = lines(spark, legs)
    totals = B.side_totals(all_lines, journal(spark, []))
    state, before = {}, journal(spark, [])
    for _ in range(4):
        for i, s, d in heads:
            if rnd.random() < 0.5:
                state[i] = (i, rnd.choice(["posted", "posted", "pending", "reversed", "failed"]), d)
            elif rnd.random() < 0.1:
                state.pop(i, None)
        after = journal(spark, sorted(state.values()))
        totals = B.maintain_totals(totals, B.journal_changes(before, after), all_lines)
        before = after
        want = sorted(map(tuple, B.side_totals(all_lines, after).collect()))
        assert sorted(map(tuple, totals.collect())) == want


def test_only_changed_periods_are_read(spark):
    heads, legs = random_journal(5)
    where = f"{checkpoint_dir(spark)}/periods-{seed_name()}"
    IO.append_journal(journal(spark, heads), lines(spark, legs), where, batch="x")
    stored = IO.journal_lines_by_period(spark, where)
    feed = B.journal_changes(journal(spark, []), journal(spark, [h for h in heads if h[2] < 31]))
    out = B.maintain_totals(B.side_totals(lines(spark, []), journal(spark, [])), feed, stored)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "2024-01-01" in plan and "2024-02-01" not in plan and "2024-03-01" not in plan
    kept = journal(spark, [h for h in heads if h[2] < 31])
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, B.side_totals(lines(spark, legs), kept).collect()))


def seed_name():
    import uuid
    return uuid.uuid4().hex


def test_repeated_and_unfinished_appends(spark):
    heads, legs = random_journal(6, n=30)
    where = f"{checkpoint_dir(spark)}/appends-{seed_name()}"
    h, l = journal(spark, heads), lines(spark, legs)
    IO.append_journal(h, l, where, batch="b1")
    IO.append_journal(h, l, where, batch="b1")
    (l.withColumn("accounting_period", F.lit("2024-01-01").cast("date")).write.partitionBy("accounting_period")
     .parquet(f"{where}/journal_lines/batch=lost"))
    t = IO.load_ledger(spark, where, ["journal_transactions", "journal_lines"])
    assert (t["journal_transactions"].count(), t["journal_lines"].count()) == (30, 60)
    assert IO.append_journal(h.limit(0), l.limit(0), where) not in ("b1", "lost")
    assert IO.load_ledger(spark, where, ["journal_lines"])["journal_lines"].count() == 60


def test_colocated_lines_are_not_shuffled(spark):
    heads, legs = random_journal(7, n=40)
    name = f"colocated_{seed_name()}"
    IO.create_journal_tables(spark, name, f"{checkpoint_dir(spark)}/{name}", buckets=4)
    for _ in range(2):
        IO.append_to_journal_tables(journal(spark, heads), lines(spark, legs), name, "b1")
    h, l = IO.journal_tables(spark, name)
    assert (h.count(), l.count()) == (40, 80)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = B.posted_lines(l, h)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_snapshots_read_changed_buckets_only(spark):
    rows = [(f"L{k:04}", k % 7, None if k % 3 else "x") for k in range(2000)]
    df = spark.createDataFrame(rows, "id string, v int, w string")
    where = f"{checkpoint_dir(spark)}/snap-{seed_name()}"
    changed = (df.filter("id <> 'L0005'").withColumn("v", F.expr("if(id = 'L0010', 99, v)"))
               .withColumn("w", F.expr("if(id = 'L0012', null, w)"))
               .unionByName(spark.createDataFrame([("NEW", 1, "n")], df.schema)))
    for name, frame in (("a", df), ("same", df.repartition(7, "v")), ("b", changed)):
        SN.write_snapshot(frame, f"{where}/{name}", buckets=32)
    assert SN.changed_buckets(spark, f"{where}/a", f"{where}/same") == []
    assert SN.audit_between(spark, f"{where}/a", f"{where}/same", "t").count() == 0
    hit = SN.changed_buckets(spark, f"{where}/a", f"{where}/b")
    assert 1 <= len(hit) <= 4
    read = SN._rows(spark, f"{where}/a", hit)
    files = [r[0] for r in read.select(F.input_file_name()).distinct().collect()]
    assert {int(f.split("bucket=")[1].split("/")[0]) for f in files} == set(hit)
    assert "PartitionFilters: [bucket#" in read._jdf.queryExecution().executedPlan().toString()
    audit = {r.entity_id: r for r in SN.audit_between(spark, f"{where}/a", f"{where}/b", "t", request_id="r1").collect()}
    assert {k: r.action for k, r in audit.items()} == {"L0005": "delete", "L0010": "update", "L0012": "update", "NEW": "insert"}
    assert audit["L0010"].diff == '{"v":{"before":"3","after":"99"}}' and audit["NEW"].request_id == "r1"
    bad = {r.key: r.rule for r in SN.append_only_violations(spark, f"{where}/a", f"{where}/b").collect()}
    assert bad == {"L0005": "deleted", "L0010": "updated", "L0012": "updated"}
    empty = df.limit(0)
    SN.write_snapshot(empty, f"{where}/none", buckets=32)
    assert {r.rule for r in SN.append_only_violations(spark, f"{where}/a", f"{where}/none").collect()} == {"deleted"}


def test_catalogue_finds_each_constraint(spark):
    assert sum(map(len, K.UNIQUE.values())) == 17 and sum(map(len, K.REFERENCES.values())) == 22
    x = Inputs(spark, SF_SMALL)
    names = [*K.UNIQUE, "outbox_events", "reconciliation_batches"]
    bad, seen = K.check_ledger({t: x.raw(f"fx_cat_{t}") for t in names}, domains=False)
    rules = {(r.table_name, r.rule) for r in bad.collect()}
    assert {(t, "unique_" + "_".join(c)) for t, keys in K.UNIQUE.items() for c in keys} <= rules
    assert {(t, f"fk_{c}") for t, fks in K.REFERENCES.items() for c in fks} <= rules
    assert seen["accounts"].get["rows"] == x.raw("fx_cat_accounts").count()


def test_catalogue_small(spark):
    cust = spark.createDataFrame([("U1", "r1", "a@x"), ("U2", "r1", "A@X"), ("U3", None, None), ("U4", None, None)],
                                 "id string, external_ref string, email string")
    acc = spark.createDataFrame([("A1", "U1", "x|y"), ("A2", "U9", "x"), ("A3", None, "z"), ("A4", "U9", "x")],
                                "id string, customer_id string, external_ref string")
    bad, _ = K.check_ledger({"customers": cust, "accounts": acc}, domains=False)
    assert {tuple(r) for r in bad.collect()} == {
        ("unique_external_ref", "customers", "r1", 2), ("unique_email", "customers", "a@x", 2),
        ("unique_external_ref", "accounts", "x", 2), ("fk_customer_id", "accounts", "U9", 2)}
    bad, seen = K.check_ledger({"customers": cust})
    rows = bad.filter("rule = 'external_ref_not_null'").collect()
    assert sorted(r.key for r in rows) == ["U3", "U4"]
    bad.write.format("noop").mode("overwrite").save()
    assert seen["customers"].get["external_ref_not_null"] == 2 and seen["customers"].get["rows"] == 4


def test_sketches_stay_within_the_stated_rank_error(spark):
    rnd = random.Random(11)
    rows = [(f"p{k % 3}", rnd.random() < 0.9, rnd.expovariate(0.01), datetime(2024, 1, 1) + timedelta(minutes=3 * k)) for k in range(6000)]
    df = spark.createDataFrame(rows, "provider string, success boolean, latency_ms double, attempted_at timestamp_ntz")
    sketches = PR.latency_sketches(df, k=128)
    assert sketches.count() == len({(p, t.replace(minute=0, second=0, microsecond=0)) for p, _, _, t in rows})
    for r in PR.sla_from_sketches(sketches, k=128).collect():
        own = sorted(x for p, _, x, _ in rows if r.provider in (p, "*"))
        assert r.n == len(own) and r.min_ms == own[0] and r.max_ms == own[-1]
        for q, v in ((0.5, r.p50_ms), (0.95, r.p95_ms), (0.99, r.p99_ms)):
            rank = sum(x <= v for x in own) / len(own)
            assert abs(rank - q) <= PR.rank_error(128) + 1 / len(own)
    days = PR.sla_from_sketches(sketches, "day", k=128)
    assert days.groupBy("provider").agg(F.sum("n").alias("n")).filter("provider = '*'").first().n == 6000
    assert PR.sla_from_sketches(PR.latency_sketches(df.limit(0))).count() == 0
