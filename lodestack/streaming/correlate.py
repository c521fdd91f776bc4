"""Requests and responses by key, with expiry (STR-2, JOIN-2)."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def match_requests(requests: DataFrame, responses: DataFrame, key: list[str], request_id: str, asked: str, answered: str, expiry: str) -> DataFrame:
    """Each request with the first response of its key within ``expiry``, else status timeout.

    One pass over the union, ordered by time within the key, instead of a range
    join: the first response at or after a request is the next one in order.
    """
    r = requests.select(*key, F.col(asked).alias("_at"), F.lit(0).alias("_side"), F.struct(*requests.columns).alias("_row"))
    a = responses.select(*key, F.col(answered).alias("_at"), F.lit(1).alias("_side"), F.lit(None).cast(r.schema["_row"].dataType).alias("_row"))
    ahead = Window.partitionBy(*key).orderBy("_at", "_side").rowsBetween(0, Window.unboundedFollowing)
    first = F.first(F.when(F.col("_side") == 1, F.col("_at")), ignorenulls=True).over(ahead)
    out = r.unionByName(a).withColumn("answered", first).where("_side = 0")
    in_time = F.col("answered") <= F.col("_at") + F.expr(f"INTERVAL {expiry}")
    return out.select("_row.*", F.when(in_time, F.col("answered")).alias("answered")).withColumn("status", F.when(F.col("answered").isNull(), "timeout").otherwise("answered"))


def match_stream(messages: DataFrame, expiry_ms: int = 30_000) -> DataFrame:
    """A stream of messages (id: long, kind: request or response, at: timestamp with a watermark) → id, status.

    State is kept for pending ids only: a response settles its id at once; an id
    whose event time falls ``expiry_ms`` behind the watermark is timed out.  A
    response without a request is left out.
    """

    def step(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            yield pd.DataFrame({"id": [key[0]], "status": ["timeout"]})
            return
        asked = state.get[0] if state.exists else None
        answered = False
        for p in parts:
            q = p[p["kind"] == "request"]["at"]
            if len(q):
                first = int(q.min().timestamp() * 1000)
                asked = first if asked is None else min(asked, first)
            answered = answered or (p["kind"] == "response").any()
        if asked is not None and answered:
            if state.exists:
                state.remove()
            yield pd.DataFrame({"id": [key[0]], "status": ["answered"]})
        elif asked is not None:
            state.update((asked,))
            state.setTimeoutTimestamp(max(asked + expiry_ms, state.getCurrentWatermarkMs() + 1))

    return messages.groupBy("id").applyInPandasWithState(step, "id long, status string", "asked long", "append", GroupStateTimeout.EventTimeTimeout)
