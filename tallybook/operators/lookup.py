"""Lookups, paging and response shapes as batch operators.

A point read of the reference (``WHERE id = $1``) becomes a key join of a key
table against the whole table: the key table may hold one key or millions.
Broadcasting is left to Spark's size-checked ``autoBroadcastJoinThreshold`` /
AQE, so a large key table falls back to a shuffle join by itself.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybook.functions.money import money_text
from tallybook.session import BROADCAST_ROWS, tasks_for

DEFAULT_LIMIT = 50
MAX_LIMIT = 1000


def lookup(df: DataFrame, keys: DataFrame, on: Sequence[str] | str,
           case_insensitive: Sequence[str] = (), unique: bool = True) -> DataFrame:
    """B1: every key row with the matching table row and a ``found`` flag; a missing key gives
    nulls and ``found = false``.

    ``unique=False`` (a lookup column without a unique constraint, e.g. webhooks by
    provider + external id) keeps the row with the smallest id per key — the
    reference's ``LIMIT 1`` — via a partial+final ``min_by`` aggregate, which
    stays bounded even when one key holds a large share of the rows.
    """
    on = [on] if isinstance(on, str) else list(on)
    norm = lambda c: F.lower(F.col(c)) if c in case_insensitive else F.col(c)
    right = df.select(*[norm(c).alias("_k_" + c) for c in on],
                      *[F.col(c).alias("r_" + c) for c in df.columns])
    if not unique:
        order = "r_id" if "id" in df.columns else "r_" + df.columns[0]
        rest = [c for c in right.columns if not c.startswith("_k_")]
        right = (right.groupBy(*["_k_" + c for c in on])
                 .agg(F.min_by(F.struct(*rest), F.col(order)).alias("_row"))
                 .select(*["_k_" + c for c in on], "_row.*"))
    cond = None
    for c in on:
        e = norm(c) == F.col("_k_" + c)
        cond = e if cond is None else cond & e
    j = keys.join(right, cond, "left")
    return j.select(*keys.columns, *[F.col("r_" + c) for c in df.columns],
                    F.col("_k_" + on[0]).isNotNull().alias("found"))


def accounts_by_ids(accounts: DataFrame, ids: DataFrame) -> DataFrame:
    """B2: the accounts whose id is in ``ids`` (semi join), ordered by id."""
    return (accounts.join(ids.select(F.col("id").alias("_id")).distinct(),
                          F.col("id") == F.col("_id"), "left_semi").orderBy("id"))


def balances_by_ids(proj: DataFrame, ids: DataFrame, currency: str, kind: str) -> DataFrame:
    """Projections of the given accounts in one currency and kind, ordered by account id."""
    return (proj.filter((F.col("currency_code") == currency) & (F.col("balance_kind") == kind))
            .join(ids.select(F.col("id").alias("_id")).distinct(),
                  F.col("account_id") == F.col("_id"), "left_semi")
            .orderBy("account_id"))


def page_bounds(limit: int | None, offset: int | None) -> tuple[int, int]:
    """The reference's paging rules: limit ≤ 0 → 50, limit capped at 1000, offset ≥ 0."""
    lim = limit if limit and limit > 0 else DEFAULT_LIMIT
    return min(lim, MAX_LIMIT), max(offset or 0, 0)


def _newest_first(ts: str = "created_at", tie: str = "id") -> list[Column]:
    return [F.col(ts).desc_nulls_last(), F.col(tie).desc()]


def list_page(df: DataFrame, limit: int | None = None, offset: int | None = None,
              ts: str = "created_at", tie: str = "id") -> DataFrame:
    """One newest-first page (top-k: ``TakeOrderedAndProject``, no global sort)."""
    lim, off = page_bounds(limit, offset)
    return df.orderBy(*_newest_first(ts, tie)).offset(off).limit(lim)


def list_page_per_key(df: DataFrame, key: str = "customer_id", limit: int | None = None,
                      offset: int | None = None, ts: str = "created_at", tie: str = "id"
                      ) -> DataFrame:
    """The same newest-first page for every key at once (rank within key).

    ``row_number`` over a key only needs the rows up to offset+limit per key:
    Spark's window-group-limit optimisation cuts each partition's sort to that
    rank before the shuffle, so a customer with millions of rows costs a top-k.
    """
    lim, off = page_bounds(limit, offset)
    w = Window.partitionBy(key).orderBy(*_newest_first(ts, tie))
    return (df.withColumn("page_rank", F.row_number().over(w))
            .filter((F.col("page_rank") > off) & (F.col("page_rank") <= off + lim)))


def lines_for_transactions(lines: DataFrame, txs: DataFrame) -> DataFrame:
    """The lines of the given transactions, ordered by transaction and line number.

    Lines meet the ids, and are put in order, in as many tasks as there are rows for (counted first); a task keeps
    its ids in a hash table and sorts its range of the result only.
    """
    spark = lines.sparkSession
    ids = txs.select(F.col("id").alias("_tx"))
    n_ids, n = ids.count(), tasks_for(spark, lines.count())
    if n_ids <= BROADCAST_ROWS:
        ids = F.broadcast(ids.distinct())
    else:
        lines = lines.repartition(n, "journal_transaction_id")
        ids = ids.repartition(n, "_tx").distinct().hint("shuffle_hash")
    order = ["journal_transaction_id", "line_number"]
    return (lines.join(ids, F.col("journal_transaction_id") == F.col("_tx"), "left_semi")
            .repartitionByRange(n, *order).sortWithinPartitions(*order))


def active_holds(holds: DataFrame, accounts: DataFrame | None = None,
                 transfers: DataFrame | None = None) -> DataFrame:
    """Active holds newest first, optionally only of some accounts or transfer requests."""
    h = holds.filter(F.col("status") == "active")
    if accounts is not None:
        h = h.join(accounts.select(F.col("id").alias("_a")).distinct(),
                   F.col("account_id") == F.col("_a"), "left_semi")
    if transfers is not None:
        h = h.join(transfers.select(F.col("id").alias("_t")).distinct(),
                   F.col("transfer_request_id") == F.col("_t"), "left_semi")
    return h.orderBy(F.col("created_at").desc(), F.col("id").desc())


def _money(amount: Column, currency: Column) -> Column:
    return F.struct(money_text(amount).alias("amount"), currency.alias("currency"))


def balances_report(proj: DataFrame, accounts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Per account its balances ordered by currency, kind as nested money structs.

    Returns ``(report, missing)``: ``missing`` lists projection rows whose account
    does not exist (the reference answers 404 for them).
    """
    acc = accounts.select(F.col("id").alias("_aid"))
    j = proj.join(acc, F.col("account_id") == F.col("_aid"), "left")
    cur = F.col("currency_code")
    report = (j.filter(F.col("_aid").isNotNull())
              .select("account_id", F.col("currency_code").alias("currency"),
                      "balance_kind",
                      _money(F.col("ledger_balance"), cur).alias("ledger"),
                      _money(F.col("available_balance"), cur).alias("available"),
                      _money(F.col("held_balance"), cur).alias("held"),
                      F.col("computed_at").alias("as_of"))
              .orderBy("account_id", "currency", "balance_kind"))
    missing = j.filter(F.col("_aid").isNull()).select(
        "account_id", F.lit("account not found").alias("reason"))
    return report, missing


def transfer_report(transfers: DataFrame, journal: DataFrame) -> DataFrame:
    """Transfer with its journal transaction id (joined on transfer_request_id), and the
    response as JSON with null fields omitted."""
    jt = journal.groupBy("transfer_request_id").agg(F.min("id").alias("journal_transaction_id"))
    j = transfers.join(jt, transfers["id"] == jt["transfer_request_id"], "left")
    cur = F.col("currency_code")
    body = F.struct(
        F.col("id").alias("id"), "status", "source_account_id", "destination_account_id",
        _money(F.col("amount"), cur).alias("amount"),
        _money(F.col("fee_amount"), cur).alias("fee"),
        "client_reference", "external_reference", "journal_transaction_id",
        "failure_reason", "requested_at", "posted_at")
    return j.select(F.col("id"), "status", "journal_transaction_id",
                    F.to_json(body).alias("response"))


def hold_report(holds: DataFrame) -> DataFrame:
    """Hold response shape (money structs; optional timestamps stay null)."""
    cur = F.col("currency_code")
    return holds.select(
        "id", "account_id", "status",
        _money(F.col("amount"), cur).alias("amount"),
        _money(F.col("remaining_amount"), cur).alias("remaining"),
        _money(F.col("captured_amount"), cur).alias("captured"),
        _money(F.col("released_amount"), cur).alias("released"),
        "reason_code", "expires_at", "captured_at", "released_at", "created_at")


def funding_report(journal: DataFrame, lines: DataFrame) -> DataFrame:
    """Funding (deposit) response: journal id, entry type, status, credited amount and
    account, external reference = source event id."""
    credit = (lines.filter(F.col("side") == "credit")
              .groupBy("journal_transaction_id")
              .agg(F.min_by(F.struct("account_id", "amount", "currency_code"),
                            F.col("line_number")).alias("_c")))
    j = journal.filter(F.col("entry_type") == "deposit").join(
        credit, journal["id"] == credit["journal_transaction_id"], "left")
    return j.select(
        F.col("id").alias("journal_transaction_id"), "entry_type", "status",
        _money(F.col("_c.amount"), F.col("_c.currency_code")).alias("amount"),
        F.col("_c.account_id").alias("account_id"), "posted_at",
        F.col("source_event_id").alias("external_reference"))


def user_report(customers: DataFrame) -> DataFrame:
    """User response shape."""
    return customers.select("id", "external_ref", "full_name", "email", "phone", "status",
                            "created_at", "updated_at")


def account_report(accounts: DataFrame) -> DataFrame:
    """B10d: account response shape."""
    return accounts.select("id", "customer_id", "external_ref", "account_number", "account_type",
                           "status", "currency_code", "ledger_normal_side", "opened_at",
                           "closed_at", "created_at")


def items_for_batch(items: DataFrame, batches: DataFrame | None = None) -> DataFrame:
    """Reconciliation items (of the given batches) ordered by batch, created_at, id."""
    it = items
    if batches is not None:
        it = it.join(batches.select(F.col("id").alias("_b")).distinct(),
                     F.col("reconciliation_batch_id") == F.col("_b"), "left_semi")
    return it.orderBy("reconciliation_batch_id", "created_at", "id")
