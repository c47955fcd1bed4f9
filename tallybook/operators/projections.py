"""Versioned projection upserts and idempotent creates.

E5 applies per-key update chains without replaying them one by one: a key's first applicable
update is one aggregate; every update points at the next one it would allow (the first later
update expecting the version after its own), and the updates really applied are those reached
from the first along these pointers, found by pointer doubling. Rounds are logarithmic in the
longest chain, each is one self-join of the pointers still in use, and a key with many updates, or with many
that expect one version, never has to fit in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybook.functions.money import money
from tallybook.functions.text import ts_literal
from tallybook.functions.windows import chunked_next
from tallybook.schemas import (ACCOUNTS, CUSTOMERS, SYSTEM_ACCOUNTS, SYSTEM_CURRENCY,
                               SYSTEM_CUSTOMER_REF, conform)
from tallybook.session import stage, unstage

KEY = ["account_id", "currency_code", "balance_kind"]
VALUES = ["ledger_balance", "available_balance", "held_balance", "last_transaction_id",
          "last_line_id"]


def _applied(first: DataFrame, updates: DataFrame) -> DataFrame:
    """(KEY, seq) of every applied update: those reached from each key's first one."""
    moving = updates.join(first.withColumnRenamed("seq", "_start"), KEY).filter("seq >= _start")
    asks = moving.select(*KEY, (F.col("expected_version") + 1).alias("_v"), "seq",
                         F.lit(False).alias("_offers"))
    offers = moving.select(*KEY, F.col("expected_version").alias("_v"), "seq",
                           F.lit(True).alias("_offers"))
    # Per key and version the first offer after each ask; a version that most updates of a hot key expect is
    # split by volume.
    both = asks.unionByName(offers).withColumn("_at", 2 * F.col("seq") + F.when(F.col("_offers"), 0).otherwise(1))
    jump = (chunked_next(both, [*KEY, "_v"], "_at", F.when(F.col("_offers"), F.col("seq")), "_to")
            .filter(~F.col("_offers") & F.col("_to").isNotNull()).select(*KEY, "seq", "_to"))
    jump = stage(jump, "upsert-jumps")
    reached = first.select(*KEY, "seq")
    while not jump.isEmpty():
        step = reached.join(jump, [*KEY, "seq"]).select(*KEY, F.col("_to").alias("seq"))
        wider = stage(reached.unionByName(step).distinct(), "upsert-reached")
        twice = stage(jump.join(jump.select(*KEY, F.col("seq").alias("_to"),
                                            F.col("_to").alias("_far")), [*KEY, "_to"])
                      .select(*KEY, "seq", F.col("_far").alias("_to")), "upsert-jumps")
        unstage(reached)
        unstage(jump)
        reached, jump = wider, twice
    return reached


def upsert_expected_version(proj: DataFrame, updates: DataFrame, now: str
                            ) -> tuple[DataFrame, DataFrame]:
    """E5: insert → version 1; update only when the stored version equals ``expected_version``
    → version + 1; several updates of one key apply in ``seq`` order (``seq`` is unique per key).

    ``updates``: KEY, VALUES, expected_version, seq. Returns ``(projection', conflicts)``
    where conflicts are the updates that were not applied.
    """
    t = ts_literal(now)
    u = updates.select(*KEY, *VALUES, F.col("expected_version").cast("long").alias(
        "expected_version"), F.col("seq").cast("long").alias("seq"))
    stored = proj.select(*KEY, F.col("version").cast("long").alias("_v"), F.lit(True).alias("_old"))
    seen = stage(u.join(stored, KEY, "left").select(
        *KEY, "seq", "expected_version", F.col("_v"), F.col("_old").isNull().alias("_new")),
        "upsert-updates")
    ok = F.col("_new") | (F.col("expected_version") == F.col("_v"))
    first = (seen.filter(ok).groupBy(*KEY).agg(F.min("seq").alias("seq"),
                                               F.max("_new").alias("_insert")))
    # The update that inserts a key leaves version 1 behind, as if it had expected 0.
    chain = (seen.select(*KEY, "seq", "expected_version")
             .join(first.filter("_insert").drop("_insert").withColumn("_zero", F.lit(True)),
                   [*KEY, "seq"], "left")
             .select(*KEY, "seq", F.when(F.col("_zero"), F.lit(0).cast("long"))
                     .otherwise(F.col("expected_version")).alias("expected_version")))
    applied = _applied(first.select(*KEY, "seq"), chain)
    last = (u.join(applied, [*KEY, "seq"]).groupBy(*KEY)
            .agg(F.max_by(F.struct(*VALUES), F.col("seq")).alias("_u"),
                 F.count(F.lit(1)).alias("_n")))
    j = proj.join(last, KEY, "full_outer")
    hit = F.col("_n").isNotNull()
    value = {c: F.when(hit, F.col("_u." + c)).otherwise(F.col(c)) for c in VALUES}
    out = j.select(*KEY, *[(money(value[c]) if c.endswith("balance") else value[c]).alias(c)
                           for c in VALUES],
                   (F.coalesce(F.col("version").cast("long"), F.lit(0))
                    + F.coalesce(F.col("_n"), F.lit(0))).alias("version"),
                   F.when(hit, t).otherwise(F.col("computed_at")).alias("computed_at"))
    return out, u.join(applied, [*KEY, "seq"], "left_anti")


def get_or_create_accounts(accounts: DataFrame, requests: DataFrame, now: str
                           ) -> dict[str, DataFrame]:
    """idempotent account creation.

    Each request resolves to an existing account by external_ref, else by
    account_number, else to a new account; new requests repeating an
    external_ref or an account_number resolve to the first of them (by seq).
    Returns ``results`` (request_id, account_id, created), ``accounts`` (existing
    ∪ new) and ``projections`` (a zero projection per new account).
    """
    t = ts_literal(now)
    req = requests.withColumn("seq", F.col("seq").cast("long"))
    by_ref = accounts.select(F.col("external_ref").alias("_r"), F.col("id").alias("_id_ref"))
    by_num = accounts.select(F.col("account_number").alias("_n"), F.col("id").alias("_id_num"))
    j = (req.join(by_ref, F.col("external_ref") == F.col("_r"), "left")
         .join(by_num, F.col("account_number") == F.col("_n"), "left"))
    existing = F.coalesce(F.col("_id_ref"), F.col("_id_num"))
    known = j.filter(existing.isNotNull()).select("request_id", existing.alias("account_id"),
                                                  F.lit(False).alias("created"))
    new = j.filter(existing.isNull()).drop("_r", "_id_ref", "_n", "_id_num")
    ref_win = (new.groupBy("external_ref")
               .agg(F.min_by("request_id", F.col("seq")).alias("_ref_winner")))
    new = new.join(ref_win, "external_ref")
    winners = new.filter(F.col("request_id") == F.col("_ref_winner"))
    num_win = (winners.groupBy("account_number")
               .agg(F.min_by(F.struct("request_id", "external_ref"), F.col("seq")).alias("_nw")))
    winners = winners.join(num_win, "account_number")
    final = winners.filter(F.col("request_id") == F.col("_nw.request_id"))
    new_id = F.concat(F.lit("A:"), F.col("external_ref"))
    ref_target = winners.select(F.col("request_id").alias("_ref_winner"),
                                F.concat(F.lit("A:"), F.col("_nw.external_ref")).alias("_target"))
    resolved = new.join(ref_target, "_ref_winner").select(
        "request_id", F.col("_target").alias("account_id"),
        (F.col("request_id") == F.col("_ref_winner")).alias("_rw"))
    created_ids = final.select(F.col("request_id").alias("_c")).withColumn("_is", F.lit(True))
    resolved = resolved.join(created_ids, F.col("request_id") == F.col("_c"), "left").select(
        "request_id", "account_id", F.coalesce(F.col("_is"), F.lit(False)).alias("created"))
    results = known.unionByName(resolved)
    created = final.select(
        new_id.alias("id"), "customer_id", "external_ref", "account_number", "account_type",
        F.coalesce(F.col("status"), F.lit("pending")).alias("status"), "currency_code",
        "ledger_normal_side", F.coalesce(F.col("metadata"), F.lit("{}")).alias("metadata"),
        t.alias("opened_at"), F.lit(None).cast("timestamp_ntz").alias("closed_at"),
        t.alias("created_at"), t.alias("updated_at"),
        F.lit(None).cast("timestamp_ntz").alias("deleted_at"))
    all_accounts = accounts.unionByName(created.select(*accounts.columns))
    zero = money(F.lit(0))
    projections = created.select(
        F.col("id").alias("account_id"), "currency_code", F.lit("available").alias("balance_kind"),
        zero.alias("ledger_balance"), zero.alias("available_balance"), zero.alias("held_balance"),
        F.lit(0).cast("long").alias("version"), t.alias("computed_at"))
    return {"results": results, "accounts": all_accounts, "projections": projections}


def get_or_create_customers(customers: DataFrame, requests: DataFrame, now: str
                            ) -> dict[str, DataFrame]:
    """idempotent customer creation by external_ref (the first request of a new ref wins;
    later ones and requests for existing refs return the stored customer)."""
    t = ts_literal(now)
    req = requests.withColumn("seq", F.col("seq").cast("long"))
    known_ids = customers.select(F.col("external_ref").alias("_r"), F.col("id").alias("_cid"))
    j = req.join(known_ids, F.col("external_ref") == F.col("_r"), "left")
    known = j.filter(F.col("_cid").isNotNull()).select(
        "request_id", F.col("_cid").alias("customer_id"), F.lit(False).alias("created"))
    new = j.filter(F.col("_cid").isNull()).drop("_r", "_cid")
    win = new.groupBy("external_ref").agg(F.min_by("request_id", F.col("seq")).alias("_w"))
    new = new.join(win, "external_ref")
    resolved = new.select("request_id",
                          F.concat(F.lit("U:"), F.col("external_ref")).alias("customer_id"),
                          (F.col("request_id") == F.col("_w")).alias("created"))
    created = new.filter(F.col("request_id") == F.col("_w")).select(
        F.concat(F.lit("U:"), F.col("external_ref")).alias("id"), "external_ref", "full_name",
        "email", F.coalesce(F.col("status"), F.lit("active")).alias("status"),
        F.coalesce(F.col("metadata"), F.lit("{}")).alias("metadata"),
        t.alias("created_at"), t.alias("updated_at"))
    return {"results": known.unionByName(resolved),
            "customers": customers.unionByName(conform(created, CUSTOMERS))}


def seed_system(customers: DataFrame, accounts: DataFrame, now: str
                ) -> tuple[DataFrame, DataFrame]:
    """F12 seeds: add the system customer and the four system accounts where missing
    (``NOT EXISTS`` by external_ref, as the seed migration does). Returns the new tables."""
    spark = customers.sparkSession
    t = ts_literal(now)
    sys_c = spark.createDataFrame(
        [("SYS", SYSTEM_CUSTOMER_REF, "System Ledger Customer", "ledger-system@example.com",
          "active", "{}")],
        "id string, external_ref string, full_name string, email string, status string, "
        "metadata string").withColumn("created_at", t).withColumn("updated_at", t)
    new_c = sys_c.join(customers.select("external_ref"), "external_ref", "left_anti")
    all_c = customers.unionByName(conform(new_c, CUSTOMERS))
    owner = (all_c.filter(F.col("external_ref") == SYSTEM_CUSTOMER_REF)
             .groupBy(F.col("external_ref").alias("owner_ref"))
             .agg(F.min("id").alias("customer_id")))
    seeds = spark.createDataFrame(
        [(ref, num, typ, side, SYSTEM_CUSTOMER_REF) for ref, num, typ, side in SYSTEM_ACCOUNTS],
        "external_ref string, account_number string, account_type string, "
        "ledger_normal_side string, owner_ref string")
    new_a = (seeds.join(accounts.select("external_ref"), "external_ref", "left_anti")
             .join(owner, "owner_ref")
             .select(F.concat(F.lit("A:"), F.col("external_ref")).alias("id"), "customer_id",
                     "external_ref", "account_number", "account_type",
                     F.lit("active").alias("status"), F.lit(SYSTEM_CURRENCY).alias("currency_code"),
                     "ledger_normal_side", F.lit("{}").alias("metadata"), t.alias("opened_at"),
                     t.alias("created_at"), t.alias("updated_at")))
    return all_c, accounts.unionByName(conform(new_a, ACCOUNTS))
