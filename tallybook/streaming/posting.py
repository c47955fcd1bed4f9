"""Request micro-batches through the posting rules, written exactly once per batch.

``post_batch`` is the whole posting step for one set of raw requests and is
used unchanged by the batch job and by every streaming micro-batch:

    F14 key expiry, F10 hold expiry → A5 parse → F13 classify against stored keys → C7 eligibility → F5 ordered
    admission against the current projection → F17 transfers and journal headers → F1/F2/F3 legs → C6 leg
    check → F10 holds → F6 deltas → F7 new projection → F16 events → F15 keys and responses.

``stream_post`` runs it in ``foreachBatch``; each output table is written to
``<out>/<table>/batch_id=N`` (overwrite, so a replayed batch rewrites its own
files) and a commit marker is written last; readers only take batches with a marker.
Keys, projection and holds are state: a batch writes the rows it changed, the state of batch N is the latest row
per key of the batches up to N, and every ``compact_every`` batches the whole state is written once more so that
reading it does not grow with the number of batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.functions.money import money
from tallybook.operators import admission as A
from tallybook.operators import holds as H
from tallybook.operators import idempotency as I
from tallybook.operators import posting as P
from tallybook.operators import validate as V
from tallybook.schemas import BALANCE_PROJECTIONS, FUNDS_HOLDS, IDEMPOTENCY_KEYS, JOURNAL_TRANSACTIONS, conform
from tallybook.session import stage, unstage
from tallybook.sources.messages import parse_requests

KIND_TO_OP = {"deposit": "deposit", "transfer": "transfer", "withdrawal": "hold"}


def _valid_at(now: str | None, raw: DataFrame) -> str:
    """``now``, or the time of the newest request of the batch."""
    if now is not None:
        return now
    return raw.agg(F.max("arrival").cast("string")).first()[0] or "1970-01-01 00:00:00"


def released_by_expiry(holds: DataFrame, now: str) -> tuple[DataFrame, DataFrame]:
    """Holds that expire at ``now`` (after F10d) and the balance deltas that free their remainder."""
    due = holds.filter((F.col("status") == "active") & (F.col("expires_at") <= F.to_timestamp_ntz(F.lit(now))))
    zero = money(F.lit(0))
    deltas = due.select(F.concat(F.lit("expire:"), F.col("id")).alias("op_id"), "account_id", "currency_code",
                        zero.alias("d_ledger"), money(-F.col("remaining_amount")).alias("d_held"),
                        money("remaining_amount").alias("d_available"))
    return H.expire_holds(due, now), deltas


def post_batch(raw: DataFrame, customers: DataFrame, accounts: DataFrame, keys: DataFrame,
               projection: DataFrame, now: str | None, persist: bool = False, holds: DataFrame | None = None
               ) -> dict[str, DataFrame]:
    """Post one batch of raw requests (request_id, scope, kind, idempotency_key, body, arrival and, where the
    source has one, ``position``: requests that arrive at the same instant are ordered by it, then by id).

    Returns outcomes (request_id, outcome, reason), transfers, journal, legs, leg_errors, holds (new and expired
    ones), events, and the whole projection and keys after the batch. ``now`` None: the newest arrival.
    With ``persist=True`` the intermediates every output reuses are persisted
    (memory and disk) and returned under ``"_persisted"`` for the caller to unpersist.
    """
    at = _valid_at(now, raw)
    keys, _ = I.expire_keys(keys, at)
    expired = None
    if holds is not None:
        expired, freed = released_by_expiry(holds, at)
        expired, freed = stage(expired, "post-expired"), stage(freed, "post-freed")
        projection = conform(P.apply_deltas(projection, freed, at), BALANCE_PROJECTIONS)
    parsed, bad = parse_requests(raw)
    cls = I.classify_requests(raw, keys).select("request_id", F.col("status").alias("idem"))
    p = parsed.join(cls, "request_id")
    if "position" in raw.columns and "position" not in p.columns:
        p = p.join(raw.select("request_id", "position"), "request_id")
    if persist:
        p = p.persist()
    fresh = p.filter(F.col("idem") == "new")
    elig = None
    for kind in ("deposit", "transfer", "withdrawal"):
        part = fresh.filter(F.col("kind") == kind)
        part, _ = V.check_required(part, kind)
        checked = V.check_eligibility(part, customers, accounts, kind).withColumn(
            "op_type", F.lit(KIND_TO_OP[kind]))
        elig = checked if elig is None else elig.unionByName(checked)
    required_missing = fresh.join(elig.select("request_id"), "request_id", "left_anti")
    if persist:
        elig = elig.persist()
    ok = elig.filter(F.col("reason").isNull())
    position = F.coalesce(F.col("position").cast("long"), F.lit(0)) if "position" in raw.columns else F.lit(0).cast("long")
    ops = stage(ok.select(
        F.col("request_id").alias("op_id"), F.col("arrival").alias("op_ts"),
        position.alias("seq_key"), "op_type",
        F.when(F.col("op_type") != "deposit", F.col("source_account_id"))
        .alias("source_account_id"),
        F.when(F.col("op_type") != "hold", F.col("destination_account_id"))
        .alias("destination_account_id"),
        "currency_code", money("amount").alias("amount"),
        money(F.coalesce(F.col("fee_amount"), F.lit(0))).alias("fee_amount"),
        F.lit(None).cast("string").alias("hold_op_id")), "post-ops")
    proj = projection.filter(F.col("balance_kind") == "available")
    lacking = P.missing_system_accounts(ops, accounts)
    # Decisions and legs feed every output: written once instead of planned again for each.
    decided = stage(A.admit(ops.join(lacking, "op_id", "left_anti"),
                            proj.select("account_id", "currency_code", "available_balance"),
                            accounts), "post-decided")
    accepted = decided.filter(F.col("status") == "accepted")
    reqs = (ok.join(accepted.select(F.col("op_id").alias("request_id")), "request_id",
                    "left_semi")
            .withColumn("requested_at", F.col("arrival"))
            .withColumn("metadata", F.coalesce(F.to_json("metadata"), F.lit("{}"))))

    def trf(kind: str) -> DataFrame:
        return P.create_transfer_requests(reqs.filter(F.col("kind") == kind), accounts, kind)

    legs = (P.transfer_legs(trf("transfer"), accounts)
            .unionByName(P.deposit_legs(trf("deposit"), accounts))
            .unionByName(P.hold_legs(trf("withdrawal"))))
    legs = stage(legs, "post-legs")
    legs_ok, legs_bad = V.check_legs(legs)
    # Only transactions whose legs passed the check move balances.
    sound = legs_ok.select(F.element_at(F.split("journal_transaction_id", ":", 2), 2).alias("op_id"))
    posted_ops = stage(accepted.join(sound.distinct(), "op_id", "left_semi"), "post-posted")
    ids = posted_ops.select(F.col("op_id").alias("id"))
    n = F.to_timestamp_ntz(F.lit(at))
    system = reqs.select(F.col("request_id").alias("id"), "source_system")

    def rows(kind: str) -> DataFrame:
        """Transfers, deposits (posted at once) or withdrawals (pending until their callback)."""
        done = kind != "withdrawal"
        t = trf(kind).join(ids, "id", "left_semi")
        return t.withColumns({"status": F.lit("posted"), "posted_at": n, "updated_at": n}) if done else t

    transfers, journal, events = {}, [], []
    for kind in ("transfer", "deposit", "withdrawal"):
        t = stage(rows(kind), f"post-{kind}")
        transfers[kind] = t
        entry = P.ENTRY_TYPES[kind]
        source = F.coalesce("source_system", F.lit("core")) if kind != "withdrawal" else F.lit("core")
        head = P.create_journal(t.join(system, "id", "left").withColumn("source_system", source), entry,
                                F.col("source_system"))
        if kind != "withdrawal":
            head = head.withColumns({"status": F.lit("posted"), "posted_at": n})
            events.append(P.outbox_from_transfers(t.join(system, "id", "left"), aggregate_type=f"{kind}_request",
                                                  entry_type=entry))
        journal.append(conform(head, JOURNAL_TRANSACTIONS))
    every = transfers["transfer"].unionByName(transfers["deposit"]).unionByName(transfers["withdrawal"])
    new_holds = conform(H.create_holds(transfers["withdrawal"]), FUNDS_HOLDS)
    changed_holds = new_holds if expired is None else new_holds.unionByName(conform(expired, FUNDS_HOLDS))
    deltas = P.balance_deltas(posted_ops.select("op_id", "op_type", "source_account_id",
                                              "destination_account_id", "currency_code",
                                              "amount", "fee_amount"), accounts)
    new_proj = P.apply_deltas(projection, deltas, at, lasts=P.last_entries_of_ops(posted_ops, accounts))
    # A posted request's answer is stored with its key: a later retry of it is a replay.
    said = (every.select(F.col("id").alias("request_id"), P.transfer_payload().alias("response_body"))
            .join(raw.select("request_id", "scope", "idempotency_key"), "request_id"))
    upserted = I.upsert_keys(keys, raw)
    responses = said.join(upserted.select("id", "scope", "idempotency_key"), ["scope", "idempotency_key"]).select(
        "id", F.lit(201).alias("response_code"), "response_body", F.lit(0).cast("long").alias("seq"))
    new_keys = I.save_responses(upserted, responses)
    outcome = (
        bad.select("request_id", F.lit("invalid").alias("outcome"), "reason")
        .unionByName(p.filter(F.col("idem") != "new").select(
            "request_id", F.col("idem").alias("outcome"), F.lit(None).cast("string")
            .alias("reason")))
        .unionByName(required_missing.select("request_id", F.lit("invalid").alias("outcome"),
                                             F.lit("missing required fields").alias("reason")))
        .unionByName(elig.filter(F.col("reason").isNotNull()).select(
            "request_id", F.lit("ineligible").alias("outcome"), "reason"))
        .unionByName(lacking.select(F.col("op_id").alias("request_id"),
                                    F.lit("ineligible").alias("outcome"), "reason"))
        .unionByName(decided.select(F.col("op_id").alias("request_id"),
                                    F.col("status").alias("outcome"),
                                    F.when(F.col("status") == "rejected", "insufficient funds")
                                    .alias("reason"))))
    out = {"outcomes": outcome, "transfers": every,
           "journal": journal[0].unionByName(journal[1]).unionByName(journal[2]), "legs": legs_ok,
           "leg_errors": legs_bad, "holds": changed_holds,
           "projection": conform(new_proj, BALANCE_PROJECTIONS),
           "keys": conform(new_keys, IDEMPOTENCY_KEYS), "events": events[0].unionByName(events[1])}
    if persist:
        out["_persisted"] = [p, elig]
        out["_staged"] = [ops, decided, legs, posted_ops, *transfers.values()]
        if holds is not None:
            out["_staged"] += [expired, freed]
    return out


#: Tables that one batch hands to the next, by their keys.
STATE = {"keys": ["scope", "idempotency_key"], "projection": ["account_id", "currency_code", "balance_kind"],
         "holds": ["id"]}


def _commits(spark: SparkSession, out: str) -> DataFrame | None:
    """Commit markers (a one-row table per committed batch); None before the first one.

    Only a missing folder means that nothing was committed; any other read error fails the batch.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{out}/_commits")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return None
    return (spark.read.schema("batch_id LONG, full BOOLEAN").option("recursiveFileLookup", "true")
            .json(f"{out}/_commits"))


def committed_rows(spark: SparkSession, out: str, table: str) -> DataFrame:
    """All rows of a per-batch table that belong to committed batches."""
    rows = spark.read.parquet(f"{out}/{table}")
    return rows.join(_commits(spark, out).select("batch_id").distinct(), "batch_id", "left_semi").drop("batch_id")


def read_state(spark: SparkSession, out: str, table: str, before: int, start: DataFrame) -> DataFrame:
    """A state table as the committed batches below ``before`` left it (``start``: before the first).

    The newest full copy, then the rows later batches changed: the latest row per key counts; a row marked as
    gone (``_gone``) takes its key away.
    """
    marks = _commits(spark, out)
    start = start.withColumn("_gone", F.lit(False))
    if marks is None:
        return start.drop("_gone")
    known = marks.filter(F.col("batch_id") < before)
    full = known.filter("full").agg(F.max("batch_id")).first()[0]
    later = [r[0] for r in known.filter(F.col("batch_id") > (-1 if full is None else full)).select("batch_id").distinct().collect()]
    base = start if full is None else spark.read.parquet(f"{out}/{table}_full/batch_id={full}").withColumn("_gone", F.lit(False))
    if not later:
        return base.drop("_gone")
    changed = spark.read.parquet(*[f"{out}/{table}/batch_id={b}" for b in later]) if len(later) == 1 else \
        spark.read.option("basePath", f"{out}/{table}").parquet(*[f"{out}/{table}/batch_id={b}" for b in later])
    if "batch_id" not in changed.columns:
        changed = changed.withColumn("batch_id", F.lit(later[0]))
    cols = [c for c in changed.columns if c != "batch_id"]
    both = base.withColumn("batch_id", F.lit(-1)).select("batch_id", *cols).unionByName(changed.select("batch_id", *cols))
    latest = both.groupBy(*STATE[table]).agg(F.max_by(F.struct(*cols), F.col("batch_id")).alias("r")).select("r.*")
    return latest.filter(~F.col("_gone")).drop("_gone")


def _changes(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``after`` that are new or differ, and the keys that are gone (``_gone``)."""
    cols = after.columns
    old = before.select(*[F.col(c).alias("_o_" + c) for c in cols], F.lit(True).alias("_was"))
    same = [F.col(c).eqNullSafe(F.col("_o_" + c)) for c in cols]
    on = [F.col(k).eqNullSafe(F.col("_o_" + k)) for k in keys]
    j = after.withColumn("_is", F.lit(True)).join(old, on, "full_outer")
    equal = same[0]
    for e in same[1:]:
        equal = equal & e
    gone = F.col("_is").isNull()
    return j.filter(gone | F.col("_was").isNull() | ~equal).select(
        *[F.when(gone, F.col("_o_" + c)).otherwise(F.col(c)).alias(c) for c in cols], gone.alias("_gone"))


def stream_post(spark: SparkSession, requests: DataFrame, customers: DataFrame,
                accounts: DataFrame, keys0: DataFrame, projection0: DataFrame, out: str,
                checkpoint: str, now: str | None, trigger: dict | None = None, holds0: DataFrame | None = None,
                compact_every: int = 50):
    """Run ``post_batch`` on each micro-batch; batch N+1 reads the state that batch N left.

    Outputs below ``out``: outcomes, transfers, journal, legs, leg_errors, events, and the rows of keys, projection
    and holds that a batch changed. ``now`` None: each batch's newest arrival.
    """
    from tallybook.streaming.jobs import run
    holds0 = spark.createDataFrame([], FUNDS_HOLDS) if holds0 is None else holds0
    start = {"keys": conform(keys0, IDEMPOTENCY_KEYS), "projection": conform(projection0, BALANCE_PROJECTIONS),
             "holds": conform(holds0, FUNDS_HOLDS)}

    def each(df: DataFrame, batch_id: int) -> None:
        df = df.persist()
        state = {t: stage(read_state(spark, out, t, batch_id, start[t]), f"post-state-{t}") for t in STATE}
        res = post_batch(df, customers, accounts, state["keys"], state["projection"], now, persist=True,
                         holds=state["holds"])
        cached, staged = res.pop("_persisted"), res.pop("_staged")
        after = {"keys": res.pop("keys"), "projection": res.pop("projection")}
        for name, frame in after.items():
            res[name] = _changes(state[name], frame, STATE[name])
        res["holds"] = res["holds"].withColumn("_gone", F.lit(False))
        for name, frame in res.items():
            frame.write.mode("overwrite").parquet(f"{out}/{name}/batch_id={batch_id}")
        full = batch_id % compact_every == compact_every - 1
        if full:
            for t in STATE:
                moved = spark.read.parquet(f"{out}/{t}/batch_id={batch_id}")
                kept = state[t].join(moved.select(*STATE[t]), STATE[t], "left_anti")
                kept.unionByName(moved.filter(~F.col("_gone")).drop("_gone")).write.mode("overwrite").parquet(
                    f"{out}/{t}_full/batch_id={batch_id}")
        for frame in [*cached, df]:   # this batch's intermediates only
            frame.unpersist()
        for frame in [*staged, *state.values()]:
            unstage(frame)
        (spark.range(1).select(F.lit(batch_id).cast("long").alias("batch_id"), F.lit(full).alias("full"))
         .write.mode("overwrite").json(f"{out}/_commits/batch={batch_id}"))
    return run(requests.writeStream.foreachBatch(each), checkpoint, trigger)
