"""Message parsing: request bodies, provider callback envelopes, webhook rows.

All parsing is ``from_json`` with a declared schema (JVM-side, no Python).
Malformed input never fails a job: it is routed to a reject output.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook.functions.text import json_is_object
from tallybook.schemas import MONEY, TOPIC_DEPOSIT, TOPIC_WITHDRAWAL_WEBHOOK

# Field names of the request bodies the reference accepts.
REQUEST_FIELDS = ["idempotency_key_id", "customer_id", "source_account_id",
                  "destination_account_id", "currency_code", "amount", "fee_amount",
                  "source_system", "provider", "client_reference", "external_reference",
                  "description", "memo"]
REQUEST_SCHEMA = T.StructType([T.StructField(f, T.StringType()) for f in REQUEST_FIELDS]
                              + [T.StructField("metadata", T.MapType(T.StringType(),
                                                                     T.StringType()))])

# Fixed value: the header that carries the provider's request id on stored webhooks.
REQUEST_ID_HEADER = "X-Paystack-Request-Id"

# The provider envelope and its transfer data (note the capitalised keys).
CALLBACK_DATA_SCHEMA = T.StructType([T.StructField(f, T.StringType()) for f in [
    "id", "provider", "Amount", "Currency", "Domain", "account_number", "bank_code", "full_name",
    "reference", "status", "failure_reason"]])
ENVELOPE_SCHEMA = T.StructType([
    T.StructField("provider", T.StringType()), T.StructField("event", T.StringType()),
    T.StructField("id", T.StringType()), T.StructField("type", T.StringType()),
    T.StructField("data", CALLBACK_DATA_SCHEMA)])


def _try_money(c: Column) -> Column:
    return F.trim(c).try_cast(MONEY)


def parse_requests(df: DataFrame, body: str = "body") -> tuple[DataFrame, DataFrame]:
    """A5: request JSON → typed request (amount and fee as decimal(20,8)).

    Returns ``(parsed, rejects)``; rejects carry ``reason``: invalid json,
    invalid amount, invalid fee amount. Blank amounts are left to C1.
    """
    p = F.from_json(F.col(body), REQUEST_SCHEMA)
    x = df.withColumn("_ok_json", json_is_object(body)).withColumn("_r", p)
    fields = [F.col("_r." + f).alias(f) for f in REQUEST_FIELDS if f not in ("amount",
                                                                            "fee_amount")]
    x = x.select(*df.columns, "_ok_json", *fields,
                 F.col("_r.amount").alias("amount_text"),
                 F.col("_r.fee_amount").alias("fee_text"),
                 F.col("_r.metadata").alias("metadata"))
    x = x.withColumn("amount", _try_money(F.col("amount_text"))) \
         .withColumn("fee_amount", _try_money(F.col("fee_text")))
    filled = lambda c: F.col(c).isNotNull() & (F.trim(F.col(c)) != "")
    reason = (F.when(~F.col("_ok_json"), "invalid json")
              .when(filled("amount_text") & F.col("amount").isNull(), "invalid amount")
              .when(filled("fee_text") & F.col("fee_amount").isNull(), "invalid fee amount"))
    x = x.withColumn("reason", reason).drop("_ok_json")
    return x.filter(F.col("reason").isNull()).drop("reason"), x.filter(F.col("reason").isNotNull())


def parse_envelope(df: DataFrame, body: str = "body") -> tuple[DataFrame, DataFrame]:
    """A4: callback body → event, id, type, provider and typed ``data``; bad JSON → rejects."""
    x = df.withColumn("_ok", json_is_object(body)).withColumn(
        "_e", F.from_json(F.col(body), ENVELOPE_SCHEMA))
    out = x.select(*df.columns, "_ok",
                   F.col("_e.event").alias("event"), F.col("_e.id").alias("event_id"),
                   F.col("_e.type").alias("event_kind"),
                   F.col("_e.provider").alias("body_provider"),
                   F.col("_e.data").alias("data"))
    good = out.filter(F.col("_ok")).drop("_ok")
    bad = out.filter(~F.col("_ok")).select(*df.columns, F.lit("invalid json").alias("reason"))
    return good, bad


def webhooks_from_messages(messages: DataFrame, id_col: str = "message_id",
                           value: str = "value", topic: str = "topic",
                           ts: str = "timestamp") -> tuple[DataFrame, DataFrame]:
    """Queue message → pending incoming_webhooks row.

    external_event_id = ``id`` of a withdrawal callback, ``external_reference`` of a
    deposit message; provider from the body; headers carry the request id.
    Messages whose body is not a JSON object go to the reject output.
    """
    ext = (F.when(F.col(topic) == TOPIC_WITHDRAWAL_WEBHOOK, F.get_json_object(value, "$.id"))
           .when(F.col(topic) == TOPIC_DEPOSIT, F.get_json_object(value, "$.external_reference")))
    x = messages.withColumn("_ok", json_is_object(value))
    rows = x.filter(F.col("_ok")).select(
        F.col(id_col).alias("id"),
        F.get_json_object(value, "$.provider").alias("provider"),
        ext.alias("external_event_id"),
        F.col(topic).alias("event_type"),
        F.col(value).alias("payload"),
        F.to_json(F.struct(ext.alias(REQUEST_ID_HEADER))).alias("headers"),
        F.lit("pending").alias("status"),
        F.lit(None).cast("timestamp_ntz").alias("processed_at"),
        F.lit(None).cast("string").alias("error_message"),
        F.col(ts).alias("created_at"), F.col(ts).alias("updated_at"))
    rejects = x.filter(~F.col("_ok")).select(F.col(id_col).alias("id"), F.col(topic),
                                             F.lit("invalid json").alias("reason"))
    return rows, rejects


def outbox_messages(outbox: DataFrame) -> DataFrame:
    """A3 (shape): outbox row → queue record: topic = event_type, key = partition_key,
    value = the row as JSON."""
    return outbox.select(F.col("event_type").alias("topic"),
                         F.col("partition_key").alias("key"),
                         F.to_json(F.struct(*[F.col(c) for c in outbox.columns])).alias("value"))


def publish_outbox(outbox: DataFrame, sink: str = "kafka", options: dict | None = None,
                   path: str | None = None) -> DataFrame:
    """A3: write the due events to the message sink (Kafka in production, JSON files in tests).

    Returns the records written.
    """
    msgs = outbox_messages(outbox)
    if sink == "kafka":
        w = msgs.write.format("kafka")
        for k, v in (options or {}).items():
            w = w.option(k, v)
        w.save()
    else:
        msgs.write.mode("append").partitionBy("topic").json(path)
    return msgs
