"""The ledger's constraint catalogue, checked in one pass per table.

``UNIQUE`` and ``REFERENCES`` are data; :func:`check_ledger` compiles them, with the domain rules of
:mod:`validate`, to one projection per table that turns a row into its entries: the keys it must not
share, the parents it names, the rows that name it as a parent, and the domain rules it breaks. All tables'
entries meet in one aggregate, by a number of the constraint group and the key: keys are counted before the
shuffle, so an account that most lines name, or a value repeated a billion times, is one entry per task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tallybook.operators.validate import domain_rules
from tallybook.schemas import TABLES

# The data model's unique keys (a part in ``CASELESS`` compares lower-cased) ...
UNIQUE: dict[str, list[list[str]]] = {
    "customers": [["external_ref"], ["email"], ["phone"], ["national_id"]],
    "accounts": [["external_ref"], ["account_number"]],
    "idempotency_keys": [["scope", "idempotency_key"]],
    "transfer_requests": [["idempotency_key_id"], ["client_reference"], ["external_reference"]],
    "journal_transactions": [["transaction_ref"], ["idempotency_key_id"], ["source_system", "source_event_id"]],
    "journal_lines": [["journal_transaction_id", "line_number"]],
    "funds_holds": [["idempotency_key_id"]],
    "balance_projections": [["account_id", "currency_code", "balance_kind"]],
    "reconciliation_items": [["reconciliation_batch_id", "external_reference"]],
}
CASELESS = {("customers", "email")}
# ... and its foreign keys: column → parent table, by its id.
REFERENCES: dict[str, dict[str, str]] = {
    "accounts": {"customer_id": "customers"},
    "transfer_requests": {"idempotency_key_id": "idempotency_keys", "customer_id": "customers",
                          "source_account_id": "accounts", "destination_account_id": "accounts"},
    "journal_transactions": {"transfer_request_id": "transfer_requests", "idempotency_key_id": "idempotency_keys",
                             "reversed_transaction_id": "journal_transactions",
                             "reversal_of_transaction_id": "journal_transactions"},
    "journal_lines": {"journal_transaction_id": "journal_transactions", "account_id": "accounts"},
    "funds_holds": {"account_id": "accounts", "transfer_request_id": "transfer_requests",
                    "journal_transaction_id": "journal_transactions", "idempotency_key_id": "idempotency_keys"},
    "balance_projections": {"account_id": "accounts", "last_transaction_id": "journal_transactions",
                            "last_line_id": "journal_lines"},
    "outbox_events": {"idempotency_key_id": "idempotency_keys"},
    "reconciliation_items": {"reconciliation_batch_id": "reconciliation_batches",
                             "journal_transaction_id": "journal_transactions", "journal_line_id": "journal_lines"},
}
THERE = -1              # the slot of a parent's own rows


def _joined(table: str, cols: list[str]) -> Column:
    """The key as text; a part's own separators are escaped, so that different keys stay different."""
    parts = [F.lower(F.col(c)) if (table, c) in CASELESS else F.col(c).cast("string") for c in cols]
    if len(parts) == 1:
        return parts[0]
    return F.concat_ws("|", *[F.replace(F.replace(p, F.lit("\\"), F.lit("\\\\")), F.lit("|"), F.lit("\\|")) for p in parts])


def constraints(tables: dict[str, DataFrame], domains: bool = True) -> list[tuple[str, str, list[tuple[str, str]]]]:
    """The groups whose entries meet by key: (kind, subject, the (rule, table) of each slot).

    Unique keys and domain rules have a group each; all references to one parent share one.
    """
    out = [("unique", t, [("unique_" + "_".join(cols), t)]) for t in tables for cols in UNIQUE.get(t, [])]
    for parent in tables:
        named = [(f"fk_{col}", t) for t in tables for col, p in REFERENCES.get(t, {}).items() if p == parent]
        out += [("names", parent, named)] if named else []
    if domains:
        out += [("domain", t, [(rule, t)]) for t in tables for rule, _ in domain_rules(t)]
    return out


def row_entries(table: str, groups: list[tuple[str, str, list[tuple[str, str]]]]) -> list[Column]:
    """What a row of ``table`` says about the constraints: (group, slot, key) each, with a null key where it says nothing.

    The broken domain rules are read from the row's ``_broken``.
    """
    unique = {"unique_" + "_".join(cols): cols for cols in UNIQUE.get(table, [])}
    out = []

    def say(group: int, slot: int, key: Column) -> None:
        out.append(F.struct(F.lit(group).alias("group"), F.lit(slot).alias("slot"), key.cast("string").alias("key")))

    for g, (kind, subject, slots) in enumerate(groups):
        if kind == "names" and subject == table:
            say(g, THERE, F.col("id"))
        for s, (rule, of) in enumerate(slots):
            if of != table:
                continue
            if kind == "unique":
                there = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in unique[rule]])
                say(g, s, F.when(there, _joined(table, unique[rule])))
            elif kind == "names":
                say(g, s, F.col(rule.removeprefix("fk_")))
            else:
                say(g, s, F.when(F.col("_broken")[rule], F.coalesce(F.col("id").cast("string"), F.lit(""))))
    return out


def check_ledger(tables: dict[str, DataFrame], domains: bool = True) -> tuple[DataFrame, dict[str, Observation]]:
    """C2-C4 over all given tables: violations (rule, table_name, key, rows) and what each pass observed.

    ``rule``: a domain rule, ``unique_<columns>`` or ``fk_<column>``. ``key``: the row's id, the shared key, or the
    missing parent's id; ``rows``: how many rows of the table break the rule with that key. A key with a null part
    shares nothing, a null reference names nothing. References into tables that are not given are not checked.
    The observations hold, per table, ``rows`` and the number of rows that break each domain rule, once an action
    on the violations has run.
    """
    said, seen = [], {}
    groups = constraints(tables, domains)
    for table, df in tables.items():
        missing = [f.name for f in TABLES[table].fields if f.name not in df.columns]
        df = df.select("*", *[F.lit(None).cast(TABLES[table][c].dataType).alias(c) for c in missing])
        counts = []
        if domains:                   # worked out once, then counted and told
            rules = domain_rules(table)
            df = df.withColumn("_broken", F.struct(*[(~F.coalesce(ok, F.lit(True))).alias(rule) for rule, ok in rules]))
            counts = [F.count_if(F.col("_broken")[rule]).alias(rule) for rule, _ in rules]
        seen[table] = Observation(f"constraints-{table}")
        df = df.observe(seen[table], F.count(F.lit(1)).alias("rows"), *counts)
        entries = row_entries(table, groups)
        if entries:
            said.append(df.select(F.inline(F.array(*entries))).filter(F.col("key").isNotNull()))
    # One aggregate of fixed width: a count per slot of the key's group.
    width = max(len(slots) for _, _, slots in groups)
    met = reduce(DataFrame.unionByName, said).groupBy("group", "key").agg(
        F.bool_or(F.col("slot") == THERE).alias("there"),
        *[F.count_if(F.col("slot") == s).alias(f"n{s}") for s in range(width)])
    kinds = {k: [g for g, (kind, _, _) in enumerate(groups) if kind == k] for k in ("unique", "names")}
    broken = met.filter(F.when(F.col("group").isin(kinds["unique"]), F.col("n0") > 1)
                        .when(F.col("group").isin(kinds["names"]), ~F.col("there")).otherwise(True))
    v = broken.select("group", "key", F.posexplode(F.array(*[F.col(f"n{s}") for s in range(width)])).alias("slot", "rows"))
    names = F.create_map(*[F.lit(x) if isinstance(x, int) else F.struct(F.lit(x[0]).alias("rule"), F.lit(x[1]).alias("table"))
                           for g, (_, _, slots) in enumerate(groups) for s, of in enumerate(slots) for x in (g * width + s, of)])
    return v.filter("rows > 0").withColumn("of", names[F.col("group") * width + F.col("slot")]).select(
        F.col("of.rule").alias("rule"), F.col("of.table").alias("table_name"), "key", "rows"), seen
