"""Ordered admission of money operations (F5): bound-and-decide rounds.

Sequential rule (the reference's row-locked check): in the total order
(op_ts, seq_key), a transfer or hold is accepted iff its source's available
balance — opening balance plus the effects of every earlier *accepted*
operation — covers its need (amount + fee for transfers, amount for holds).
Deposits are always accepted; a failed settlement gives the held amount back
only if its hold was accepted; a successful settlement does not touch
available and copies its hold's decision.

Set-wise algorithm. Every op contributes rows per (account, currency) it touches (a
debit at the source, a credit at the destination). Each round computes, for every
undecided debit, bounds on the balance it will see:

    lo = base + Σ accepted effects before it − Σ undecided decreases before it
    hi = base + Σ accepted effects before it + Σ undecided increases before it

and accepts when lo ≥ need, rejects when hi < need. The earliest undecided op
overall has no undecided rows before it, so lo = hi and it is always decided:
every round makes progress and the result equals the sequential run.

After each round the decided prefix of every account is folded into its ``base``
and its rows are dropped, as are rejected rows and accounts without an open
check, so a round works on what is still open only. The open rows are range
partitioned by (account, order) and written to the shared folder together with
their partition number, which serves as the chunk of the two-level running sum:
chunks follow the volume, so a busy account is split however its ops cluster in
time.

Bounds decide most ops where balances are ample, but only one per round of a chain of
accounts that each pay on what they have just received. So when a round decides less than
one open check in ``WORTH``, what is left is replayed by the graph of accounts: accounts
joined by an undecided op form components (``functions.graph.account_components``),
which cannot influence each other, and each component is replayed in order in a task of its
own. A component with more than ``slice_ops`` open ops is cut into time slices of that many;
slice k of all components is replayed together, on the balances slice k - 1 left. So a task sees
``slice_ops`` ops whatever the input, and the number of slices is that of the largest component.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.functions.graph import account_components
from tallybook.functions.windows import chunked_running_sum
from tallybook.session import stage, unstage

CHECKED = ("transfer", "hold")
WORTH = 16              # a round of bounds goes on while it decides one open check in so many
SLICE_OPS = 100_000     # ops that one task replays


KEYS = ["account_id", "currency_code"]
ORDER = ["op_ts", "seq_key", "op_id"]
_D = "decimal(22,8)"


def _with_currency(df: DataFrame, keyed: bool) -> DataFrame:
    """``currency_code`` as part of the key, or one blank currency where balances carry none."""
    return df if keyed else df.withColumn("currency_code", F.lit(""))


def _valid(keyed: bool) -> Column:
    """Whether an op has a time, an amount, the accounts it touches and, where balances do, a currency."""
    t = F.coalesce("op_type", F.lit(""))
    moves = t.isin(*CHECKED, "deposit", "settle_failed")
    source, dest = t.isin(*CHECKED, "settle_failed"), t.isin("transfer", "deposit")
    told = F.col("amount").isNotNull() & (F.col("currency_code").isNotNull() | F.lit(not keyed))
    return (F.col("op_ts").isNotNull() & (~moves | told)
            & (~source | F.col("source_account_id").isNotNull())
            & (~dest | F.col("destination_account_id").isNotNull()))


def op_rows(ops: DataFrame, accounts: DataFrame | None = None) -> DataFrame:
    """Per-account effect rows of each op on *available*.

    Columns: op_id, decider (the op whose decision governs the row), account_id,
    currency_code, op_ts, seq_key, delta (signed), need (for the check row), is_check.
    With ``accounts`` (id, ledger_normal_side) debits and credits are signed by the normal
    side, as the balance deltas are; holds and their release do not depend on the side.
    """
    fee = F.coalesce(F.col("fee_amount"), F.lit(0))
    t = F.col("op_type")
    need = F.when(t == "transfer", F.col("amount") + fee).otherwise(F.col("amount")).cast(_D)
    amount = F.col("amount").cast(_D)
    no_need = F.lit(None).cast(_D)
    rows = F.array(
        # debit at the source of a transfer / hold: the row that is checked
        F.when(t.isin(*CHECKED), F.struct(
            F.col("source_account_id").alias("account_id"), (-need).alias("delta"),
            need.alias("need"), F.lit(True).alias("is_check"), F.col("op_id").alias("decider"),
            (t == "transfer").alias("sided"))),
        # credit at the destination of a transfer / deposit
        F.when(t.isin("transfer", "deposit"), F.struct(
            F.col("destination_account_id").alias("account_id"), amount.alias("delta"),
            no_need.alias("need"), F.lit(False).alias("is_check"), F.col("op_id").alias("decider"),
            F.lit(True).alias("sided"))),
        # a failed settlement returns the held amount if its hold was accepted
        F.when(t == "settle_failed", F.struct(
            F.col("source_account_id").alias("account_id"), amount.alias("delta"),
            no_need.alias("need"), F.lit(False).alias("is_check"),
            F.col("hold_op_id").alias("decider"), F.lit(False).alias("sided"))))
    x = ops.select("op_id", "currency_code", "op_ts", "seq_key", F.explode(rows).alias("r")).filter(
        F.col("r").isNotNull())
    x = x.select("op_id", "currency_code", "op_ts", "seq_key", "r.*")
    if accounts is not None:
        side = accounts.select(F.col("id").alias("account_id"), "ledger_normal_side")
        x = x.join(side, "account_id", "left").withColumn("delta", F.when(
            F.col("sided") & (F.col("ledger_normal_side") == "debit"), -F.col("delta"))
            .otherwise(F.col("delta")))
    return x.select("op_id", "decider", "account_id", "currency_code", "op_ts", "seq_key",
                    F.col("delta").cast(_D).alias("delta"), F.col("need").cast(_D).alias("need"),
                    "is_check")


def _fold(rows: DataFrame) -> DataFrame:
    """Add the decided prefix of each account to its base; keep only what is still open."""
    order = F.struct(*ORDER)
    open_ = F.col("st") == "U"
    state = rows.groupBy(*KEYS).agg(
        F.min(F.when(open_, order)).alias("_first"),
        F.max((open_ & F.col("is_check")).cast("int")).alias("_checks"))
    x = rows.join(state.filter("_checks = 1").drop("_checks"), KEYS)
    before = order < F.col("_first")
    prefix = (x.filter(before & (F.col("st") == "A")).groupBy(*KEYS)
              .agg(F.sum("delta").alias("_folded")))
    return (x.filter(~before & (F.col("st") != "R")).join(prefix, KEYS, "left")
            .withColumn("base", (F.col("base") + F.coalesce("_folded", F.lit(0))).cast("decimal(38,8)"))
            .drop("_first", "_folded"))


def _in_order(rows):
    """Decide one component's open rows of a slice one after the other (pandas, a bounded group)."""
    import pandas as pd
    rows = rows.sort_values([*ORDER, "is_check"], ascending=[True, True, True, False])
    balance, said = {}, {}
    for r in rows.itertuples(index=False):
        key = (r.account_id, r.currency_code)
        have = balance.get(key, r.base)
        if r.st == "U" and r.is_check:
            said[r.op_id] = "A" if have >= r.need else "R"
        if r.st == "A" or (r.st == "U" and said.get(r.decider) == "A"):
            have += r.delta
        balance[key] = have
    return pd.DataFrame({"op_id": list(said), "new": list(said.values())}, dtype=object)


def _replay(rows_open: DataFrame, slice_ops: int) -> tuple[list[DataFrame], int]:
    """Decisions (op_id, new) for all open rows, component by component, and the number of slices."""
    node = F.xxhash64(*KEYS)                          # accounts that share a number only share a task
    rows = rows_open.drop("chunk").withColumn("node", node)
    touched = rows.filter(F.col("st") == "U").select("decider", "node").distinct()
    first = touched.groupBy("decider").agg(F.min("node").alias("b"))
    edges = touched.join(first, "decider").select(F.col("node").alias("a"), "b").distinct()
    component = stage(account_components(edges), "admit-components")
    rows = stage(rows.join(component, "node", "left").withColumn("component", F.coalesce("component", "node"))
                 .drop("node"), "admit-graph")
    # Slices are cut between ops, by their number in the component's order.
    each = rows.groupBy("component", *ORDER).agg(F.lit(1).alias("one"))
    placed = chunked_running_sum(each, ["component"], [F.col(c) for c in ORDER], {"place": F.lit(1).cast("long")},
                                 inclusive=False)
    sliced = stage(rows.join(placed.select("component", "op_id", F.floor(F.col("place") / slice_ops).alias("slice")),
                             ["component", "op_id"]), "admit-slices")
    slices = (sliced.agg(F.max("slice")).first()[0] or 0) + 1
    said: list[DataFrame] = []
    past = None                                       # what the slices so far did to each account
    for k in range(slices):
        now = sliced.filter(F.col("slice") == k)
        if said:
            known = said[0]
            for more in said[1:]:
                known = known.unionByName(more)
            # Holds that settlements of this slice name may have been decided in an earlier one.
            now = (now.join(known.select(F.col("op_id").alias("decider"), "new"), "decider", "left")
                   .withColumn("st", F.coalesce("new", "st")).drop("new").filter("st <> 'R'"))
            now = (now.join(past, KEYS, "left").withColumn(
                "base", (F.col("base") + F.coalesce("past", F.lit(0))).cast("decimal(38,8)")).drop("past"))
        said.append(stage(now.select(*KEYS, *ORDER, "decider", "delta", "need", "is_check", "st", "base", "component")
                          .groupBy("component").applyInPandas(lambda pdf: _in_order(pdf), "op_id string, new string"),
                          "admit-decided"))
        if k + 1 < slices:
            done = (now.join(said[-1].select(F.col("op_id").alias("decider"), "new"), "decider", "left")
                    .filter(F.coalesce("new", "st") == "A").select(*KEYS, F.col("delta").alias("past")))
            if past is not None:
                done = done.unionByName(past)
            new = stage(done.groupBy(*KEYS).agg(F.sum("past").cast(_D).alias("past")), "admit-past")
            unstage(past)
            past = new
    unstage(past)
    for done in (component, rows, sliced):
        unstage(done)
    return said, slices


def admit(ops: DataFrame, opening: DataFrame, accounts: DataFrame | None = None,
          exclude_accounts: DataFrame | None = None, slice_ops: int = SLICE_OPS) -> DataFrame:
    """accept / reject every op in order. Returns ops with ``status`` and ``rounds``.

    ``ops``: op_id, op_ts, seq_key, op_type, source_account_id, destination_account_id,
    currency_code, amount, fee_amount, hold_op_id. ``opening``: account_id, available_balance
    and, where balances are kept per currency, currency_code. ``accounts``: see
    :func:`op_rows`. ``exclude_accounts`` (id): accounts never checked (system accounts):
    their debits are always accepted and their rows are not tracked.

    Ops without a time have no place in the order, and those without an amount, an account they
    touch or the currency of their balance (settlements: failed ones only) cannot be weighed: they come out ``invalid``, without effect; a
    settlement whose hold is missing or later than itself copies nothing.
    """
    keyed = "currency_code" in opening.columns
    ops = stage(ops, "admit-ops")          # evaluated once, read by every step below
    timed = ops.filter(_valid(keyed))
    rows = _with_currency(op_rows(timed, accounts), keyed)
    holds = timed.filter(F.col("op_type") == "hold").select(
        F.col("op_id").alias("decider"), F.struct(*ORDER).alias("_held"))
    own = F.col("decider") == F.col("op_id")
    later = rows.filter(~own | F.col("decider").isNull()).join(holds, "decider") \
        .filter(F.col("_held") < F.struct(*ORDER)).drop("_held")
    rows = rows.filter(own).unionByName(later.select(*rows.columns))
    kinds = timed.select(F.col("op_id").alias("decider"), F.col("op_type").alias("_kind"))
    st = F.when(F.col("_kind") == "deposit", "A").otherwise("U")
    rows = rows.join(kinds, "decider").withColumn("st", st).drop("_kind")
    auto = None
    if exclude_accounts is not None:
        ex = exclude_accounts.select(F.col("id").alias("account_id")).distinct()
        auto = (rows.join(ex, "account_id", "left_semi").filter("is_check")
                .select(F.col("op_id").alias("decider"), F.lit("A").alias("_auto")))
        rows = (rows.join(ex, "account_id", "left_anti").join(auto, "decider", "left")
                .withColumn("st", F.coalesce("_auto", "st")).drop("_auto"))
    start = (_with_currency(opening, keyed).groupBy(*KEYS)
             .agg(F.sum("available_balance").alias("_opening")))
    rows = rows.join(start, KEYS, "left").withColumn(
        "base", F.coalesce("_opening", F.lit(0)).cast("decimal(38,8)")).drop("_opening")
    decisions, last, rounds = [], None, 0
    while True:
        rows_open = stage(_fold(rows).repartitionByRange(*KEYS, *ORDER)
                          .withColumn("chunk", F.spark_partition_id()), "admit-rows")
        unstage(last)
        last = rows_open
        left = rows_open.count()
        if left == 0:
            break
        rounds += 1
        checks = rows_open.filter(F.col("is_check") & (F.col("st") == "U")).count()
        s, d = F.col("st"), F.col("delta")
        zero = F.lit(0)
        r = chunked_running_sum(
            rows_open, KEYS, [F.col(c) for c in ORDER],
            {"a_net": F.when(s == "A", d).otherwise(zero),
             "u_deb": F.when((s == "U") & (d < 0), -d).otherwise(zero),
             "u_cred": F.when((s == "U") & (d > 0), d).otherwise(zero)},
            F.col("chunk"), inclusive=False)
        base = F.col("base") + F.col("a_net")
        lo, hi = base - F.col("u_deb"), base + F.col("u_cred")
        decided = stage(r.filter(F.col("is_check") & (s == "U"))
                        .select("op_id", F.when(lo >= F.col("need"), "A")
                                .when(hi < F.col("need"), "R").alias("new"))
                        .filter(F.col("new").isNotNull()), "admit-decided")
        decisions.append(decided)
        worth = decided.count() * WORTH >= checks
        rows = (rows_open.drop("chunk")
                .join(decided.withColumnRenamed("op_id", "decider"), "decider", "left")
                .withColumn("st", F.coalesce("new", "st")).drop("new"))
        if not worth:
            rest = stage(_fold(rows), "admit-rows")
            more, slices = _replay(rest, slice_ops)
            decisions += more
            rounds += slices
            unstage(rest)
            break
    unstage(last)
    status = timed.filter(F.col("op_type") == "deposit").select("op_id", F.lit("A").alias("_s"))
    if auto is not None:
        status = status.unionByName(auto.select(F.col("decider").alias("op_id"), F.col("_auto").alias("_s")))
    for d in decisions:
        status = status.unionByName(d.select("op_id", F.col("new").alias("_s")))
    # Settlements copy their hold's decision.
    copied = (timed.filter(F.col("op_type").isin("settle_failed", "settle_success"))
              .select("op_id", F.struct(*ORDER).alias("_at"), F.col("hold_op_id").alias("decider"))
              .join(holds, "decider").filter(F.col("_held") < F.col("_at"))
              .join(status.withColumnRenamed("op_id", "decider"), "decider").select("op_id", "_s"))
    out = ops.join(status.unionByName(copied), "op_id", "left")
    return out.select(*ops.columns,
                      F.when(~_valid(keyed), "invalid").when(F.col("_s") == "A", "accepted")
                      .when(F.col("_s") == "R", "rejected").alias("status"),
                      F.lit(rounds).alias("rounds"))


def admitted_balances(ops_status: DataFrame, opening: DataFrame, accounts: DataFrame | None = None
                      ) -> DataFrame:
    """Available balance per account (and currency, where ``opening`` has it) after the accepted ops."""
    keyed = "currency_code" in opening.columns
    keys = KEYS if keyed else KEYS[:1]
    timed = ops_status.filter(_valid(keyed))
    rows = op_rows(timed.filter(F.col("status") == "accepted"), accounts)
    eff = rows.groupBy(*keys).agg(F.sum("delta").alias("_d"))
    o = opening.groupBy(*keys).agg(F.sum("available_balance").alias("_o"))
    j = o.join(eff, keys, "full_outer")
    return j.select(*keys, (F.coalesce(F.col("_o"), F.lit(0)) + F.coalesce(F.col("_d"), F.lit(0)))
                    .cast("decimal(38,8)").alias("available_balance"))
