"""Stateful jobs on ``transformWithState`` (I6 settlement, I7 hold lifecycle, I8 retries).

Each is a processor with typed state per key and event-time timers. Events are kept
under their own time until the watermark has passed it and are applied in event order then, so results
do not depend on how the input was cut into micro-batches or in which order rows of a batch came (I8 keeps the newest
state of an event only; I7 and I8 keep the state of a bucket of ids together). A timer
handles all that the watermark has passed, what it sets off itself included.
A key's state is gone when its last timer has fired. Times travel as microseconds (``*_us``), which keeps
them exact and free of any session time zone; timers have milliseconds and fire just after.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from tallybook.functions.text import utc_instant, utc_wall
from tallybook.operators.holds import FAILURE_EVENTS, SUCCESS_EVENTS
from tallybook.operators.outbox import MAX_RETRIES
from tallybook.operators.posting import SETTLEMENT_TYPE, system_accounts

MONEY = "decimal(20,8)"
NOTHING = Decimal(0)
STUCK_US = 300_000_000          # H5's five minutes


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _typed_state(df: DataFrame) -> DataFrame:
    """``df`` in a session whose new streams keep their state in RocksDB, which processors with several state
    variables and timers need. Streams that restart keep the store their checkpoint names."""
    df.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    return df


def timer_of(us: int) -> int:
    """The first timer (ms) that lies after a time in microseconds."""
    return us // 1000 + 1


def _passed(timer_values, fired, event_time: bool = True) -> int:
    """The time (ms) up to which everything is known: the watermark, or the clock."""
    now = timer_values.getCurrentWatermarkInMs() if event_time else timer_values.getCurrentProcessingTimeInMs()
    return max(now, fired.getExpiryTimeInMs())


def _us(ntz: str) -> Column:
    return F.unix_micros(utc_instant(ntz))


def _wall(us: str) -> Column:
    return utc_wall(F.timestamp_micros(F.col(us)))


# ---------------------------------------------------------------- I7

class HoldLifecycle(StatefulProcessor):
    """The holds of one bucket: create, then the first consume or release that fits, or expiry at expires_at.

    As in I8, the state of a bucket is one value with one timer at the earliest due time: its open holds (JSON: id,
    amount, expires_us) and the events that the watermark has not passed (JSON rows, joined by commas as they came).
    Rows only add to the events; what the watermark has passed is sorted by hold and time and applied at once, and
    comes out as one row that holds all transitions.
    """

    OUT = (f"said array<struct<hold_id: string, status: string, remaining_amount: {MONEY}, captured_amount: {MONEY}, "
           f"released_amount: {MONEY}, event_us: long>>")

    def __init__(self, release_remainder: bool):
        self.release_remainder = release_remainder

    def init(self, handle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", "holds string, events string, timer_ms long")

    def _set_timer(self, due: int | None, timer: int | None, fired: int | None = None) -> None:
        """One timer, at ``due`` instead of ``timer``; the one that fired is gone with its handler."""
        if due != timer:
            if timer is not None and timer != fired:
                self.handle.deleteTimer(timer)
            if due is not None:
                self.handle.registerTimer(due)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        new = ",".join(r.event for r in rows if r.event is not None)
        if new:
            holds, events, timer = self.open.get() or ("[]", "", None)
            due = min(timer_of(int(e[1])) for e in json.loads(f"[{new}]"))
            due = due if timer is None else min(due, timer)
            self._set_timer(due, timer)
            self.open.update((holds, f"{events},{new}" if events else new, due))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        upto, fired = _passed(timerValues, expiredTimerInfo), expiredTimerInfo.getExpiryTimeInMs()
        kept = self.open.get()
        if kept is None:
            return iter(())
        holds = {hold_id: (amount, expires) for hold_id, amount, expires in json.loads(kept[0])}
        due, later, out = {}, [], []
        for e in json.loads(f"[{kept[1]}]"):
            hold_id, at, seq, action, amount, expires = e
            if timer_of(int(at)) <= upto:                 # a repeat of an event takes its place
                due.setdefault(hold_id, {})[int(at), int(seq), action] = amount, None if expires is None else int(expires)
            else:
                later.append(e)
        for hold_id, (_, expires) in holds.items():
            if expires is not None and timer_of(expires) <= upto:
                due.setdefault(hold_id, {})
        for hold_id, moves in due.items():
            hold = self._advance(hold_id, holds.pop(hold_id, None), sorted(moves.items()), upto, out)
            if hold is not None:
                holds[hold_id] = hold
        timer = min((timer_of(us) for us in (*(int(e[1]) for e in later), *(h[1] for h in holds.values() if h[1] is not None))),
                    default=None)
        self._set_timer(timer, kept[2], fired)
        if holds or later:
            self.open.update((json.dumps([(h, *held) for h, held in holds.items()]), json.dumps(later)[1:-1], timer))
        else:
            self.open.clear()
        return iter([Row(said=out)] if out else ())

    def _advance(self, hold_id, hold, moves, upto: int, out: list) -> tuple[str, int | None] | None:
        """The hold (amount, expires_us) after ``moves`` in order and all that expired until then; None when over."""
        held, expires = (None, None) if hold is None else (Decimal(hold[0]), hold[1])

        def say(status: str, remaining: Decimal, captured: Decimal, released: Decimal, at: int) -> None:
            out.append({"hold_id": hold_id, "status": status, "remaining_amount": remaining, "captured_amount": captured,
                        "released_amount": released, "event_us": at})

        for (at, _, action), (amount, until) in moves:
            amount = None if amount is None else Decimal(amount)
            if held is not None and expires is not None and at >= expires:
                say("expired", NOTHING, NOTHING, held, expires)
                held = None
            if action == "create" and held is None and amount is not None and amount > 0:
                held, expires = amount, until
                say("active", amount, NOTHING, NOTHING, at)
            elif action in ("consume", "release") and held is not None and amount is not None and 0 < amount <= held:
                left = held - amount
                if action == "release":
                    # what is neither released nor captured stays as the remainder.
                    say("released", left, NOTHING, amount, at)
                elif self.release_remainder:
                    say("consumed", NOTHING, amount, left, at)
                else:
                    say("consumed", left, amount, NOTHING, at)
                held = None
        if held is not None and expires is not None and timer_of(expires) <= upto:
            say("expired", NOTHING, NOTHING, held, expires)
            held = None
        return None if held is None else (str(held), expires)

    def close(self) -> None:
        pass


def stream_hold_timers(hold_events: DataFrame, late: str = "1 hour", release_remainder: bool = True,
                       buckets: int = 4096) -> DataFrame:
    """Hold lifecycle per hold id, with a timer at expires_at.

    ``hold_events``: hold_id, action (create / consume / release), amount, expires_at, event_time, seq.
    Emits every transition with what remains, was captured and released, like F10: a consume captures its
    amount and by default releases the rest, a release frees its amount, either ends the hold; one that asks for
    more than is left, or is dated at or after expires_at, is ignored. A hold without expires_at never
    expires. Events of one hold apply in (event_time, seq) order, ``late`` after they happened. A finished
    hold keeps no state: whatever arrives for it later finds no hold, and a repeated create is older than
    the watermark by then. State is kept per bucket of ids: ``buckets`` is chosen so that a bucket's open holds fit a
    task, and fixed while a checkpoint lives.
    """
    ev = hold_events.withColumn("event_time", utc_instant("event_time")).withWatermark("event_time", late)
    # A row travels as one JSON text beside its time, which the watermark needs: Python takes rows cell by cell.
    at = F.unix_micros("event_time")
    event = F.to_json(F.array(*[c.cast("string") for c in (
        F.col("hold_id"), at, F.coalesce(F.col("seq").cast("long"), F.lit(0)), F.col("action"),
        F.col("amount").cast(MONEY), _us("expires_at"))]))
    ev = ev.select(F.pmod(F.xxhash64("hold_id"), F.lit(buckets)).cast("int").alias("bucket"), "event_time",
                   F.when(at.isNotNull() & F.col("action").isNotNull(), event).alias("event"))
    out = _typed_state(ev).groupBy("bucket").transformWithState(HoldLifecycle(release_remainder), HoldLifecycle.OUT,
                                                                "append", "EventTime")
    return out.select(F.inline("said")).withColumn("event_time", _wall("event_us")).drop("event_us")


# ---------------------------------------------------------------- I6

class Settlement(StatefulProcessor):
    """One withdrawal: its callbacks in order of arrival, until its hold expires."""

    OUT = ("transfer_id string, hook_id string, event string, outcome string, reason string, event_us long, "
           f"source_account_id string, currency_code string, amount {MONEY}")

    def init(self, handle) -> None:
        self.handle = handle
        self.transfer = handle.getValueState(
            "transfer", f"source_account_id string, currency_code string, amount {MONEY}, settles boolean, "
                        "expires_us long, status string")
        self.pending = handle.getMapState("pending", "at_us long, hook_id string", "event string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        for r in rows:
            if not self.transfer.exists():
                self.transfer.update((r.source_account_id, r.currency_code, r.amount, r.settles, r.expires_us, "open"))
                self.handle.registerTimer(timer_of(r.expires_us))
            if r.hook_id is not None:
                self.pending.updateValue((r.received_us, r.hook_id), (r.event,))
                self.handle.registerTimer(timer_of(r.received_us))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if not self.transfer.exists():
            return iter(())
        upto, out = _passed(timerValues, expiredTimerInfo), []
        account, currency, amount, settles, expires, status = self.transfer.get()

        def say(hook, event, outcome, reason, at) -> None:
            out.append(Row(transfer_id=key[0], hook_id=hook, event=event, outcome=outcome, reason=reason, event_us=at,
                           source_account_id=account, currency_code=currency, amount=amount))

        for at, hook in sorted(tuple(k) for k in self.pending.keys() if timer_of(k[0]) <= upto):
            (event,) = self.pending.getValue((at, hook))
            self.pending.removeKey((at, hook))
            success, failure = event in SUCCESS_EVENTS, event in FAILURE_EVENTS
            if not success and not failure:
                say(hook, event, "rejected", f"unhandled event: {event or ''}", at)
            elif failure and status == "failed":
                say(hook, event, "skipped", "transfer already failed", at)
            elif success and status == "posted":
                say(hook, event, "rejected", "transfer already processed", at)
            elif status != "open" or at >= expires:
                say(hook, event, "rejected", "no active hold", at)
            elif amount is None or amount <= 0:
                say(hook, event, "rejected", "insufficient hold", at)
            elif success and not settles:
                say(hook, event, "rejected", "no settlement account", at)
            else:
                status = "posted" if success else "failed"
                say(hook, event, status, None, at)
        if timer_of(expires) <= upto:
            if status == "open":
                say(None, None, "expired", "no callback in time", expires)
            self.transfer.clear()
        else:
            self.transfer.update((account, currency, amount, settles, expires, status))
        return iter(out)

    def close(self) -> None:
        pass


def stream_settlement(withdrawals: DataFrame, callbacks: DataFrame, accounts: DataFrame, within: str = "24 hours",
                      late: str = "1 hour") -> DataFrame:
    """I6 to its end: withdrawals left-outer joined to their callbacks within ``within``, then state per transfer.

    Two chained stateful steps: the interval join (both watermarks; a withdrawal no callback reached comes out
    alone once its window has passed) and :class:`Settlement`, which decides like F9: the first applicable callback
    in (received_at, hook_id) order posts or fails the transfer, later ones are skipped or rejected, a success
    in a currency without settlement account is rejected, and a transfer still open when its hold expires
    comes out as ``expired``. One row per callback and expiry: transfer_id, hook_id, event, outcome, reason,
    event_time, source_account_id, currency_code, amount.
    """
    settle = system_accounts(accounts, SETTLEMENT_TYPE, "_settlement").select("currency_code", "_settlement")
    w = (withdrawals.withColumn("w_ts", utc_instant("requested_at")).withWatermark("w_ts", late)
         .join(settle, "currency_code", "left")
         .select(F.col("request_id").alias("w_id"), "w_ts", "source_account_id", "currency_code",
                 F.col("amount").cast(MONEY).alias("amount"), F.col("_settlement").isNotNull().alias("settles")))
    c = (callbacks.withColumn("c_ts", utc_instant("received_at")).withWatermark("c_ts", late)
         .select("hook_id", F.col("data.reference").alias("c_ref"), "event", "c_ts"))
    span = F.expr(f"INTERVAL {within}")
    joined = w.join(c, (F.col("c_ref") == F.col("w_id")) & (F.col("c_ts") >= F.col("w_ts"))
                    & (F.col("c_ts") <= F.col("w_ts") + span), "left_outer")
    rows = joined.select(
        F.col("w_id").alias("transfer_id"), "w_ts", "hook_id", "event", "source_account_id", "currency_code", "amount",
        "settles", F.unix_micros("c_ts").alias("received_us"), F.unix_micros(F.col("w_ts") + span).alias("expires_us"))
    out = _typed_state(rows).groupBy("transfer_id").transformWithState(Settlement(), Settlement.OUT, "append", "EventTime")
    return out.withColumn("event_time", _wall("event_us")).drop("event_us")


# ---------------------------------------------------------------- I8

#: What a delivery says: None when delivered, else (error code, error message).
Deliver = Callable[[dict], "tuple[str, str] | None"]


def always(message: dict) -> None:
    """Every attempt counts as delivered; the sink writes the messages."""
    return None


class OutboxRetry(StatefulProcessor):
    """The outbox events of one bucket: attempts at their due times until they are delivered or dead.

    A call to the state store costs more than the work on an event, so the open events of a bucket are one state
    value (JSON: id → status, retry_count, due_us, changed_us, attempt, message columns) that a batch reads and
    writes once, with one timer at the earliest due time. A delivered or dead event leaves it.
    """

    OUT = ("id string, attempt int, at_us long, status string, retry_count int, next_retry_us long, "
           "error_code string, error_message string, event_type string, partition_key string, payload string")

    def __init__(self, deliver: Deliver, max_retries: int, event_time: bool):
        self.deliver, self.max_retries, self.event_time = deliver, max_retries, event_time

    def init(self, handle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", "events string, timer_ms long")

    def _load(self) -> tuple[dict, int | None]:
        """The bucket's open events and the timer that is set for them."""
        kept = self.open.get()
        return ({}, None) if kept is None else (json.loads(kept[0]), kept[1])

    def _save(self, events: dict, timer: int | None, fired: int | None = None) -> None:
        due = min((timer_of(e[2]) for e in events.values()), default=None)
        if due != timer:
            if timer is not None and timer != fired:      # the one that fired is gone with its handler
                self.handle.deleteTimer(timer)
            if due is not None:
                self.handle.registerTimer(due)
        if events:
            self.open.update((json.dumps(events), due))
        elif timer is not None:
            self.open.clear()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        newest = {}
        for r in rows:
            known = newest.get(r.id)
            if known is None or (r.changed_us, r.retry_count) > (known.changed_us, known.retry_count):
                newest[r.id] = r
        events, timer = self._load()
        changed = False
        for r in newest.values():
            old = events.get(r.id)
            if old is not None and old[3] > r.changed_us:
                continue                                  # an older state of the event
            if r.status in ("pending", "failed", "processing"):
                due = (r.changed_us + STUCK_US if r.status == "processing"
                       else max(r.changed_us, r.next_retry_us or r.changed_us))
                events[r.id] = (r.status, r.retry_count, due, r.changed_us, old[4] if old else 0, r.event_type,
                                r.partition_key, r.payload)
                changed = True
            elif old is not None:                         # published or dead elsewhere
                del events[r.id]
                changed = True
        if changed:
            self._save(events, timer)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        upto, fired = _passed(timerValues, expiredTimerInfo, self.event_time), expiredTimerInfo.getExpiryTimeInMs()
        clock = 0 if self.event_time else timerValues.getCurrentProcessingTimeInMs() * 1000
        events, timer = self._load()
        out = []
        for id_ in [i for i, e in events.items() if timer_of(e[2]) <= upto]:
            status, retry, due, changed, attempt, *rest = events.pop(id_)
            while timer_of(due) <= upto:
                due = max(due, clock)
                if status == "processing":                # H5: nobody finished it
                    retry += 1
                attempt += 1
                failed = self.deliver({"id": id_, "retry_count": retry, "event_type": rest[0], "partition_key": rest[1],
                                       "payload": rest[2]})
                again = due + (1 << retry) * 1_000_000 if failed and retry <= self.max_retries else None
                said = "published" if not failed else "failed" if again else "dead_letter"
                out.append(Row(id=id_, attempt=attempt, at_us=due, status=said, retry_count=retry + bool(again),
                               next_retry_us=again, error_code=failed[0] if failed else None,
                               error_message=failed[1] if failed else None, event_type=rest[0], partition_key=rest[1],
                               payload=rest[2]))
                if not again:
                    break
                status, retry, due = "failed", retry + 1, again
            else:                                         # its next attempt lies ahead
                events[id_] = (status, retry, due, changed, attempt, *rest)
        self._save(events, timer, fired)
        return iter(out)

    def close(self) -> None:
        pass


def stream_outbox_retries(outbox_changes: DataFrame, deliver: Deliver = always, max_retries: int = MAX_RETRIES,
                          late: str = "1 hour", time_mode: str = "EventTime", buckets: int = 4096) -> DataFrame:
    """I8 with its retry loop: every attempt of every outbox event, fed back by a timer at next_retry_at.

    A pending or failed event is tried when due (H1), one stuck in ``processing`` five minutes after its last
    change, with one retry more (H5). A failed attempt comes back after 2^retry seconds (H3) until its
    retry_count is above ``max_retries`` (H4). ``deliver`` runs in the task that holds the event's state, at least
    once per attempt; a newer change row of the event replaces its schedule, ``published`` or ``dead_letter`` ends it.
    ``time_mode``: ``EventTime`` follows the watermark (replays), ``ProcessingTime`` the clock (live). State is kept per
    bucket of ids: ``buckets`` is chosen so that a bucket's open events fit a task, and fixed while a checkpoint lives.
    One row per attempt: id, attempt, attempted_at, status, retry_count, next_retry_at, error_code, error_message and
    the message's columns.
    """
    event_time = time_mode == "EventTime"
    ev = outbox_changes.withColumn("event_time", utc_instant("updated_at"))
    if event_time:
        ev = ev.withWatermark("event_time", late)
    ev = ev.filter(F.col("event_time").isNotNull() & F.col("id").isNotNull()).select(
        "id", "status", F.coalesce("retry_count", F.lit(0)).cast("int").alias("retry_count"), "event_time",
        F.unix_micros("event_time").alias("changed_us"), _us("next_retry_at").alias("next_retry_us"),
        "event_type", "partition_key", "payload")
    ev = ev.withColumn("bucket", F.pmod(F.xxhash64("id"), F.lit(buckets)).cast("int"))
    out = _typed_state(ev).groupBy("bucket").transformWithState(OutboxRetry(deliver, max_retries, event_time),
                                                                OutboxRetry.OUT, "append", time_mode)
    return (out.withColumn("attempted_at", _wall("at_us")).withColumn("next_retry_at", _wall("next_retry_us"))
            .drop("at_us", "next_retry_us"))
