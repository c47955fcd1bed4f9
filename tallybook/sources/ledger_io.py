"""Ledger tables at rest: declared-schema reads, append-only journal writes, audit rows."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook.schemas import JOURNAL_LINES, JOURNAL_TRANSACTIONS, TABLES


def load_ledger(spark: SparkSession, location: str, tables: Sequence[str] | None = None,
                fmt: str = "parquet", options: dict | None = None, only_live: bool = False
                ) -> dict[str, DataFrame]:
    """A1: read ledger tables with their declared schemas (never inferred).

    ``fmt='parquet'`` reads ``<location>/<table>``; ``fmt='jdbc'`` reads table
    ``<table>`` from the JDBC url ``location`` (pass partitionColumn/lowerBound/
    upperBound/numPartitions in ``options`` for parallel reads).
    ``only_live`` drops soft-deleted rows (deleted_at set). Of a journal that ``append_journal`` has written,
    only committed batches are read.
    """
    out = {}
    committed = None if fmt == "jdbc" else _committed(spark, location)
    for t in (tables or list(TABLES)):
        schema = TABLES[t]
        if fmt == "jdbc":
            r = spark.read.format("jdbc").option("url", location).option("dbtable", t)
            for k, v in (options or {}).items():
                r = r.option(k, v)
            df = r.load().select([F.col(f.name).cast(f.dataType) for f in schema.fields])
        else:
            r = spark.read.schema(schema)
            for k, v in (options or {}).items():
                r = r.option(k, v)
            df = r.format(fmt).load(f"{location}/{t}")
            if committed is not None and t in ("journal_transactions", "journal_lines"):
                df = _only_committed(spark, df, location, t, committed)
        # Declared columns only (drops layout helpers such as the period folder column).
        df = df.select(*[f.name for f in schema.fields])
        if only_live and "deleted_at" in df.columns:
            df = df.filter(F.col("deleted_at").isNull())
        out[t] = df
    return out


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def _and(schema: T.StructType, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(name, kind)])


def _committed(spark: SparkSession, location: str) -> DataFrame | None:
    """(batch) of the committed appends of a journal folder, None if it has no commit log."""
    if not _exists(spark, f"{location}/_commits"):
        return None
    return spark.read.schema("batch string").json(f"{location}/_commits/*").distinct()


def _only_committed(spark: SparkSession, df: DataFrame, location: str, table: str, committed: DataFrame) -> DataFrame:
    # The batch is a folder: the semi join prunes the folders of unfinished appends at run time.
    whole = spark.read.schema(_and(df.schema, "batch", T.StringType())).option("basePath", f"{location}/{table}")
    return whole.parquet(f"{location}/{table}").join(committed, "batch", "left_semi").drop("batch")


def journal_lines_by_period(spark: SparkSession, location: str) -> DataFrame:
    """Committed journal lines with their ``accounting_period`` folder column (a partition filter prunes)."""
    df = spark.read.schema(_and(JOURNAL_LINES, "accounting_period", T.DateType())).parquet(f"{location}/journal_lines")
    committed = _committed(spark, location)
    return df if committed is None else _only_committed(spark, df, location, "journal_lines", committed)


def append_journal(txs: DataFrame, lines: DataFrame, location: str, grain: str = "month",
                   rows_per_file: int = 5_000_000, batch: str | None = None) -> str:
    """Append-only write of journal headers and lines (call after C5 passes). Returns the batch id.

    An append is a ``batch``: both tables are written to ``<table>/batch=<id>`` with overwrite, then a
    commit marker ``_commits/<id>`` is written. Readers see committed batches only, so neither a failed append
    nor a repeated one (the same id again, after whatever failure) leaves half an entry or a line twice.

    Inside a batch both are partitioned by ``accounting_period`` = the header's accounting_date truncated
    to ``grain``, so reads over a time range prune folders. Each period is spread over as many
    writers as its volume asks for (rebalanced in one pass, no count first; a file has at most ``rows_per_file``
    rows), so a full month is never written by one task. Lines are sorted by account inside files: per-account reads skip row
    groups by min/max.
    """
    spark = txs.sparkSession
    batch = batch or uuid.uuid4().hex
    headers = txs.withColumn("accounting_period", F.trunc("accounting_date", grain))
    periods = headers.select(F.col("id").alias("journal_transaction_id"), "accounting_period")
    dated = lines.join(periods, "journal_transaction_id", "left")

    def spread(df: DataFrame, name: str, sort: Sequence[str] = ()) -> None:
        out = df.hint("rebalance", "accounting_period")
        if sort:
            out = out.sortWithinPartitions("accounting_period", *sort)
        (out.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).partitionBy("accounting_period")
         .parquet(f"{location}/{name}/batch={batch}"))
    spread(dated, "journal_lines", ["account_id", "journal_transaction_id"])
    spread(headers, "journal_transactions")
    spark.range(1).select(F.lit(batch).alias("batch")).write.mode("overwrite").json(f"{location}/_commits/{batch}")
    return batch


def create_journal_tables(spark: SparkSession, database: str, location: str, buckets: int = 4096) -> None:
    """Journal tables laid out so that lines meet their headers without a shuffle.

    ``<database>.journal_lines`` is bucketed and sorted by journal_transaction_id, ``journal_transactions`` by id, with
    the same number of buckets, both partitioned by the append batch, under ``location`` (shared storage).
    Needs a catalog that keeps table definitions between sessions.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{location}'")
    for name, schema, key in (("journal_lines", JOURNAL_LINES, "journal_transaction_id"),
                              ("journal_transactions", JOURNAL_TRANSACTIONS, "id")):
        cols = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({cols}, batch STRING) USING parquet "
                  f"PARTITIONED BY (batch) CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS")


def append_to_journal_tables(txs: DataFrame, lines: DataFrame, database: str, batch: str) -> None:
    """A6 into the co-located tables: the batch's partition is overwritten, headers last.

    A repeated append of one batch id changes nothing. Lines whose headers are not there yet are invisible to
    every reader that joins posted headers.
    """
    spark = txs.sparkSession
    literal = batch.replace("\\", "\\\\").replace("'", "\\'")
    for name, df, schema in (("journal_lines", lines, JOURNAL_LINES), ("journal_transactions", txs, JOURNAL_TRANSACTIONS)):
        view = f"append_{uuid.uuid4().hex}"
        df.select(*schema.names).createOrReplaceTempView(view)
        spark.sql(f"INSERT OVERWRITE TABLE {database}.{name} PARTITION (batch = '{literal}') SELECT * FROM {view}")
        spark.catalog.dropTempView(view)


def journal_tables(spark: SparkSession, database: str) -> tuple[DataFrame, DataFrame]:
    """(headers, lines) of the co-located tables."""
    return tuple(spark.table(f"{database}.{name}").drop("batch") for name in ("journal_transactions", "journal_lines"))


def _state(df: DataFrame, cols: Sequence[str]) -> F.Column:
    return F.to_json(F.struct(*[F.col(c) for c in cols]))


def audit_from_snapshots(before: DataFrame, after: DataFrame, key: str, entity_type: str,
                         actor_type: str = "system", now: str | None = None, request_id: str | None = None,
                         correlation_id: str | None = None) -> DataFrame:
    """Audit rows from two snapshots of a table: insert / update / delete.

    ``request_id`` and ``correlation_id`` say what caused the change (the request, or the job's run).

    before_state / after_state are the rows as JSON objects; diff is a JSON object
    ``{column: {"before": old, "after": new}}`` of the changed columns only.
    Unchanged rows produce no audit row.
    """
    cols = [c for c in before.columns]
    b = before.select(*[F.col(c).alias("b_" + c) for c in cols])
    a = after.select(*[F.col(c).alias("a_" + c) for c in cols])
    j = b.join(a, F.col("b_" + key) == F.col("a_" + key), "full_outer")
    pairs = F.array(*[F.struct(F.lit(c).alias("k"),
                               F.struct(F.col("b_" + c).cast("string").alias("before"),
                                        F.col("a_" + c).cast("string").alias("after"))
                               .alias("v")) for c in cols if c != key])
    changed = F.filter(pairs, lambda p: ~p["v"]["before"].eqNullSafe(p["v"]["after"]))
    action = (F.when(F.col("b_" + key).isNull(), "insert")
              .when(F.col("a_" + key).isNull(), "delete").otherwise("update"))
    bstate = F.when(F.col("b_" + key).isNotNull(),
                    F.to_json(F.struct(*[F.col("b_" + c).alias(c) for c in cols])))
    astate = F.when(F.col("a_" + key).isNotNull(),
                    F.to_json(F.struct(*[F.col("a_" + c).alias(c) for c in cols])))
    x = j.select(F.coalesce(F.col("b_" + key), F.col("a_" + key)).alias("entity_id"),
                 action.alias("action"), bstate.alias("before_state"),
                 astate.alias("after_state"), changed.alias("_changed"))
    x = x.filter((F.col("action") != "update") | (F.size("_changed") > 0))
    created = F.to_timestamp_ntz(F.lit(now)) if now else F.lit(None).cast("timestamp_ntz")
    return x.select(
        F.sha2(F.concat_ws("|", F.lit(entity_type), F.col("entity_id"), F.col("action"),
                           F.coalesce(F.col("after_state"), F.lit(""))), 256).alias("id"),
        F.lit(actor_type).alias("actor_type"), F.lit(None).cast("string").alias("actor_id"),
        "action", F.lit(entity_type).alias("entity_type"), "entity_id", "before_state",
        "after_state",
        F.when(F.col("action") == "update",
               F.to_json(F.map_from_entries(F.transform("_changed", lambda p: F.struct(
                   p["k"], p["v"]))))).alias("diff"),
        F.when(F.col("action") == "update",
               F.array_join(F.transform("_changed", lambda p: p["k"]), ","))
        .otherwise(F.lit("")).alias("changed_columns"),
        F.lit(request_id).cast("string").alias("request_id"),
        F.lit(correlation_id).cast("string").alias("correlation_id"),
        F.lit("{}").alias("metadata"), created.alias("created_at"))


def append_audit(audit: DataFrame, location: str) -> None:
    """Append-only write of audit rows."""
    audit.write.mode("append").parquet(f"{location}/audit_logs")
