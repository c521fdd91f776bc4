"""Sessions and pending requests of a connection: keyed state, in a table of events and as a stream (STR-4, STR-5, AGG-10).

An event has a connection, a time, an order among equal times, a kind and an
item.  ``attach`` opens a session for the item and ``detach`` closes it;
``disconnect`` closes all sessions of the connection.  ``request`` leaves the
item pending until ``response`` or until it expires; a disconnect leaves pending
requests alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def connection_counts(events: DataFrame, connection: str, at: str, order: str, expiry: str) -> DataFrame:
    """Per connection, after its last event: open sessions and requests that neither were answered nor expired.

    Columns ``kind`` and ``item`` as above.  The last event of each kind and item
    is enough, so one row an item and kind is moved, not the events.
    """
    when = F.struct(F.col(at).alias("at"), F.col(order).alias("order"))
    last = lambda *kinds: F.max(F.when(F.col("kind").isin(*kinds), when))
    ends = events.groupBy(connection).agg(F.max(when).alias("_end"), last("disconnect").alias("_cut"))
    items = events.where("kind != 'disconnect'").groupBy(connection, "item").agg(last("attach").alias("_on"), last("detach").alias("_off"), last("request").alias("_asked"), last("response").alias("_answered"))
    after = lambda a, b: F.col(a).isNotNull() & (F.col(b).isNull() | (F.col(a) > F.col(b)))
    both = ends.join(items, connection, "left")
    open_ = after("_on", "_off") & after("_on", "_cut")
    waits = after("_asked", "_answered") & (F.col("_asked.at") + F.expr(f"INTERVAL {expiry}") > F.col("_end.at"))
    return both.groupBy(connection).agg(F.count_if(open_).alias("sessions"), F.count_if(waits).alias("pending"))


def session_stream(events: DataFrame, idle_ms: int = 3_600_000) -> DataFrame:
    """A stream of events (connection: long, at: timestamp with a watermark, kind, item) → connection, sessions, one row for each batch that has events of it.

    State is the set of open items; a disconnect empties it, and a connection
    that is silent until the watermark is ``idle_ms`` past its last event is
    closed.
    """

    def step(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            yield pd.DataFrame({"connection": [key[0]], "sessions": [0]})
            return
        open_ = set(state.get[0]) if state.exists else set()
        rows = pd.concat(list(parts)).sort_values("at", kind="stable")
        for kind, item in zip(rows["kind"], rows["item"], strict=True):
            if kind == "attach":
                open_.add(item)
            elif kind == "detach":
                open_.discard(item)
            elif kind == "disconnect":
                open_.clear()
        state.update((sorted(open_),))
        state.setTimeoutTimestamp(max(int(rows["at"].max().timestamp() * 1000) + idle_ms, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame({"connection": [key[0]], "sessions": [len(open_)]})

    return events.groupBy("connection").applyInPandasWithState(step, "connection long, sessions long", "items array<string>", "append", GroupStateTimeout.EventTimeTimeout)


def polled(waits: DataFrame, ready: DataFrame, key: list[str], wait_id: str, asked: str, done: str, every_s: float = 0.5, most_s: float = 15.0) -> DataFrame:
    """Each wait with what polling finds (STR-3): status complete or timeout, and the number of polls.

    A wait looks every ``every_s`` seconds whether something of its key got ready
    after it was asked, and ends after ``most_s``.  A wait that timed out stays in
    the result: callers go on with it.
    """
    from .correlate import match_requests

    found = match_requests(waits, ready, key, wait_id, asked, done, f"{int(most_s * 1000)} milliseconds")
    late = (F.col("answered").cast("timestamp").cast("double") - F.col(asked).cast("timestamp").cast("double")) / every_s
    polls = F.greatest(F.ceil(F.round(late, 6)), F.lit(1))
    most = int(most_s / every_s)
    complete = F.col("answered").isNotNull() & (polls < most)  # the timer fires first
    return found.select(wait_id, F.when(complete, "complete").otherwise("timeout").alias("status"), F.when(complete, polls).otherwise(most - 1).cast("int").alias("polls"))
