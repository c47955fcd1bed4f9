"""Statement reconciliation.

Items are matched with a full outer join on (batch, external_reference,
currency); duplicates of a reference in one batch are rejected (the unique
key of reconciliation_items) using a ``min_by`` aggregate, so a reference
repeated many times never lands in one sorted window.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.functions.money import money, total
from tallybook.functions.text import ts_literal


def batch_id(source_system: Column, statement_date: Column) -> Column:
    return F.concat(F.lit("RB:"), source_system, F.lit(":"), statement_date.cast("string"))


def create_batch(statement: DataFrame, now: str) -> DataFrame:
    """G1: one pending batch per (source_system, statement_date): expected total and count."""
    return (statement.groupBy("source_system", "statement_date")
            .agg(total(F.sum("amount")).alias("expected_total_amount"),
                 F.count(F.lit(1)).cast("int").alias("expected_total_count"))
            .select(batch_id(F.col("source_system"), F.col("statement_date")).alias("id"),
                    "source_system", "statement_date", F.lit("pending").alias("status"),
                    "expected_total_amount", "expected_total_count",
                    ts_literal(now).alias("started_at")))


def match_items(statement: DataFrame, internal: DataFrame, now: str
                ) -> tuple[DataFrame, DataFrame]:
    """One item per statement line, linked to the internal record with the same
    (batch, external reference, currency); internal records absent from the statement become
    items too (amount = internal amount). Of several statement lines, and of several internal records,
    with one key the first counts and the others are rejected. Returns ``(items, duplicate_rejects)``;
    a rejected internal record has its journal transaction as ``statement_line_id``.

    ``statement``: source_system, statement_date, statement_line_id, external_reference,
    currency_code, amount, value_at. ``internal``: source_system, statement_date,
    external_reference, currency_code, amount, journal_transaction_id, journal_line_id.
    """
    key = ["_batch", "external_reference", "currency_code"]
    st = statement.withColumn("_batch", batch_id(F.col("source_system"), F.col("statement_date")))
    firsts = (st.groupBy(*key)
              .agg(F.min_by(F.struct("statement_line_id", "amount"),
                            F.struct("value_at", "statement_line_id")).alias("_f"))
              .select(*key, F.col("_f.statement_line_id").alias("statement_line_id"),
                      F.col("_f.amount").alias("statement_amount")))
    dups = st.join(firsts.select("statement_line_id"), "statement_line_id", "left_anti").select(
        "statement_line_id", F.col("_batch").alias("reconciliation_batch_id"),
        "external_reference", F.lit("duplicate external reference").alias("reason"))
    own = internal.withColumn("_batch", batch_id(F.col("source_system"), F.col("statement_date")))
    one = F.struct("journal_transaction_id", "journal_line_id", "amount")
    it = own.groupBy(*key).agg(F.min(one).alias("_i"))
    # Every further record is rejected, copies of the first one too.
    each = own.groupBy(*key, one.alias("_one")).agg(F.count(F.lit(1)).alias("_n")).join(it, key)
    extra = F.col("_n") - F.col("_one").eqNullSafe(F.col("_i")).cast("long")
    more = (each.filter(extra > 0).select("*", F.explode(F.sequence(F.lit(1).cast("long"), extra)))
            .select(F.col("_one.journal_transaction_id").alias("statement_line_id"),
                    F.col("_batch").alias("reconciliation_batch_id"), "external_reference",
                    F.lit("duplicate internal record").alias("reason")))
    dups = dups.unionByName(more)
    it = (it
          .select(*key, F.col("_i.amount").alias("internal_amount"),
                  "_i.journal_transaction_id", "_i.journal_line_id"))
    j = firsts.join(it, key, "full_outer")
    n = ts_literal(now)
    items = j.select(
        F.concat(F.col("_batch"), F.lit(":"), F.col("external_reference"), F.lit(":"),
                 F.col("currency_code")).alias("id"),
        F.col("_batch").alias("reconciliation_batch_id"), "journal_transaction_id",
        "journal_line_id", "external_reference", F.lit("pending").alias("status"),
        "currency_code",
        money(F.coalesce(F.col("statement_amount"), F.col("internal_amount"))).alias("amount"),
        money(F.lit(0)).alias("matched_amount"), money(F.lit(0)).alias("variance_amount"),
        F.lit(None).cast("string").alias("variance_reason"),
        F.lit(None).cast("timestamp_ntz").alias("matched_at"), F.lit("{}").alias("metadata"),
        n.alias("created_at"), n.alias("updated_at"),
        money("statement_amount").alias("statement_amount"),
        money("internal_amount").alias("internal_amount"))
    return items, dups


def mark_matched(items: DataFrame, now: str, tolerance: Decimal | int = 0) -> DataFrame:
    """matched_amount, variance = |statement − internal|, status matched / exception with a
    reason: missing_internal, missing_external, amount. Items are new rows (items are immutable)."""
    s, i = F.col("statement_amount"), F.col("internal_amount")
    var = money(F.abs(s - i))
    both = s.isNotNull() & i.isNotNull()
    ok = both & (var <= F.lit(Decimal(tolerance)))
    reason = (F.when(i.isNull(), "missing_internal").when(s.isNull(), "missing_external")
              .when(~ok, "amount"))
    sets = {"status": F.when(ok, "matched").otherwise("exception"),
            "matched_amount": money(F.when(both, i).otherwise(F.lit(0))),
            "variance_amount": F.when(both, var).otherwise(money(F.lit(0))),
            "variance_reason": reason,
            "matched_at": F.when(ok, ts_literal(now)),
            "updated_at": ts_literal(now)}
    return items.select(*[sets[c].alias(c) if c in sets else F.col(c) for c in items.columns])


def batch_rollup(batches: DataFrame, items: DataFrame, now: str) -> DataFrame:
    """Matched / mismatch totals and counts per batch; status matched when every item is, and a batch
    without any item stays as it was unless it expected none."""
    m = F.col("status") == "matched"
    agg = (items.groupBy("reconciliation_batch_id")
           .agg(total(F.sum(F.when(m, F.col("amount")).otherwise(0))).alias("matched_total_amount"),
                F.count_if(m).cast("int").alias("matched_total_count"),
                total(F.sum(F.when(~m, F.col("amount")).otherwise(0))).alias("mismatch_total_amount"),
                F.count_if(~m).cast("int").alias("mismatch_total_count")))
    j = batches.join(agg, batches["id"] == agg["reconciliation_batch_id"], "left")
    z = F.lit(0)
    return j.select(
        "id", "source_system", "statement_date",
        F.when(F.col("mismatch_total_count") == 0, "matched")
        .when(F.col("mismatch_total_count") > 0, "mismatch")
        .when(F.col("expected_total_count") == 0, "matched")
        .otherwise(F.col("status")).alias("status"),
        "expected_total_amount", "expected_total_count",
        F.coalesce(F.col("matched_total_amount"), z.cast("decimal(38,8)")).alias("matched_total_amount"),
        F.coalesce(F.col("matched_total_count"), z).alias("matched_total_count"),
        F.coalesce(F.col("mismatch_total_amount"), z.cast("decimal(38,8)")).alias("mismatch_total_amount"),
        F.coalesce(F.col("mismatch_total_count"), z).alias("mismatch_total_count"),
        ts_literal(now).alias("finished_at"))
