"""Queries over events and conversations: runs, patterns, incremental intake, request matching."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..catalog import query, sql_rows
from ..functions import strings
from ..operators import classify, evolve
from ..operators.tables import FIRST_HAND
from ..session import table
from ..sources.shared import scratch


@query("AGG-11 D14", "SELECT user_id, md5(string_agg(event_type, ',' ORDER BY ts, event_type)) AS sequence_md5, count(DISTINCT event_type) AS distinct_tools FROM events GROUP BY 1")
def tool_sequence(spark, sf):
    u = evolve.tool_use(table(spark, sf, "events"), "user_id", "event_type", "ts")
    return u.select("user_id", F.md5(F.array_join("sequence", ",")).alias("sequence_md5"), "distinct_tools")


@query("SORT-2 SORT-3", "SELECT event_type, round(sum(value), 2) AS impact FROM events GROUP BY 1 ORDER BY sum(value) DESC, event_type LIMIT 2")
def top_patterns(spark, sf):
    per = table(spark, sf, "events").groupBy("event_type").agg(F.sum("value").alias("impact"))
    return evolve.top_k(per, F.col("impact"), 2, "event_type").select("event_type", F.round("impact", 2).alias("impact"))


@query("SORT-4", "SELECT user_id, event_id, place FROM (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS place FROM events) WHERE place <= 3")
def main_tools(spark, sf):
    return evolve.top_k_each(table(spark, sf, "events"), "user_id", [F.desc("value"), F.col("event_id")], 3).select("user_id", "event_id", F.col("place").cast("long").alias("place"))


@query("AGG-7 AGG-9 JOIN-16 JOIN-18 D15", "WITH r AS (SELECT conv_id, avg(length(text)) FILTER (role = 'user') AS a, avg(length(text)) FILTER (role = 'assistant') AS b FROM conversations GROUP BY 1) SELECT conv_id, round(a, 4) AS n_a, round(b, 4) AS n_b, round((b - a) / nullif(a, 0), 6) AS n_change, round(b - a, 4) AS n_gap FROM r")
def run_compare(spark, sf):
    c = table(spark, sf, "conversations").withColumn("n", F.char_length("text"))
    r = evolve.paired(c, ["conv_id"], "role", "user", "assistant", "n")
    return r.select("conv_id", F.round("n_a", 4).alias("n_a"), F.round("n_b", 4).alias("n_b"), F.round("n_change", 6).alias("n_change"), F.round("n_gap", 4).alias("n_gap"))


@query("AGG-4 AGG-5", "WITH p AS (SELECT event_type AS category, count(*) FILTER (value > 10) AS s, count(*) FILTER (value <= 10) AS f FROM events GROUP BY 1) SELECT category, s AS success_count, round(s / nullif(s + f, 0), 6) AS rate FROM p")
def pattern_rates(spark, sf):
    p = table(spark, sf, "events").groupBy(F.col("event_type").alias("category")).agg(F.count_if(F.col("value") > 10).alias("success_count"), F.count_if(F.col("value") <= 10).alias("f"))
    return p.select("category", "success_count", F.round(evolve.success_rate(F.col("success_count"), F.col("f")), 6).alias("rate"))


@query("AGG-4 D7", "WITH p AS (SELECT event_type AS category, count(*) FILTER (value > 10) AS s FROM events GROUP BY 1) SELECT CAST(sum(s) AS BIGINT) AS total_evolutions, (SELECT category FROM p ORDER BY s DESC, category LIMIT 1) AS most_effective_category FROM p")
def library_meta(spark, sf):
    p = table(spark, sf, "events").select(F.col("event_type").alias("category"), (F.col("value") > 10).cast("long").alias("success_count"))
    return evolve.library_meta(p)


@query("AGG-6", "WITH f AS (SELECT user_id AS id, count(*) FILTER (value > 10) AS s, count(*) FILTER (NOT value > 10) AS x FROM events WHERE event_type = 'error' GROUP BY 1), p AS (SELECT DISTINCT user_id AS id FROM events) SELECT p.id, CAST(1 + coalesce(s, 0) AS INT) AS success_count, CAST(coalesce(x, 0) AS INT) AS failure_count, coalesce(x, 0) >= 3 AND coalesce(x, 0) > 1 + coalesce(s, 0) AS demoted FROM p LEFT JOIN f ON f.id = p.id")
def feedback_counters(spark, sf):
    e = table(spark, sf, "events")
    patterns = e.select(F.col("user_id").alias("id")).distinct().select("id", F.lit(1).alias("success_count"), F.lit(None).cast("int").alias("failure_count"))
    return evolve.apply_feedback(patterns, e.where("event_type = 'error'").select(F.col("user_id").alias("id"), (F.col("value") > 10).alias("success")))


@query("FN-J1", "SELECT CAST(sum(CAST(json_extract(props, '$.k') AS BIGINT)) AS BIGINT) AS total, count(*) AS n FROM events")
def json_unpack(spark, sf):
    return table(spark, sf, "events").agg(F.sum(F.get_json_object("props", "$.k").cast("long")).alias("total"), F.count("*").alias("n"))


@query("FN-J1 FN-A2", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, coalesce(CASE event_type WHEN 'view' THEN 'read' WHEN 'click' THEN 'act' END, 'other') AS kind FROM events")
def json_fields(spark, sf):
    from ..functions.strings import lookup

    return table(spark, sf, "events").select("event_id", F.from_json("props", "k bigint")["k"].alias("k"), lookup({"view": "read", "click": "act"}, F.col("event_type"), "other").alias("kind"))


@query("JOIN-2", "WITH q AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'view'), a AS (SELECT user_id, ts FROM events WHERE event_type = 'purchase'), m AS (SELECT q.event_id, min(a.ts) AS answered FROM q LEFT JOIN a ON a.user_id = q.user_id AND a.ts >= q.ts AND a.ts <= q.ts + INTERVAL 6 HOUR GROUP BY 1) SELECT event_id, CASE WHEN answered IS NULL THEN 'timeout' ELSE 'answered' END AS status FROM m")
def request_match(spark, sf):
    """Views answered by the same user's purchase within six hours, else timed out."""
    from ..streaming.correlate import match_requests

    e = table(spark, sf, "events")
    q = e.where("event_type = 'view'").select("event_id", "user_id", F.col("ts").alias("asked"))
    a = e.where("event_type = 'purchase'").select("user_id", F.col("ts").alias("answered"))
    return match_requests(q, a, ["user_id"], "event_id", "asked", "answered", "6 hours").select("event_id", "status")


@query("JOIN-3", "WITH s AS (SELECT user_id, max(event_id) AS session FROM events WHERE event_type = 'signup' GROUP BY 1) SELECT e.event_id, coalesce(s.session, -1) AS session, s.session IS NOT NULL AS hit FROM events e LEFT JOIN s ON s.user_id = e.user_id WHERE e.event_type = 'click'")
def session_lookup(spark, sf):
    from ..operators.registry import sessions_with_fallback

    e = table(spark, sf, "events")
    s = e.where("event_type = 'signup'").groupBy("user_id").agg(F.max("event_id").alias("session"))
    return sessions_with_fallback(e.where("event_type = 'click'").select("event_id", "user_id"), s, "user_id", "session", F.lit(-1)).select("event_id", "session", "hit")


@query("STR-1", "SELECT CAST(b AS BIGINT) AS batch, count(*) AS items, count(DISTINCT event_id) AS distinct_items FROM (SELECT event_id, min(event_id % 2) AS b FROM events GROUP BY 1) GROUP BY 1")
def incremental_intake(spark, sf):
    """Two overlapping batches of events taken in by a file stream, even ids and then all; each id once, in the batch that has it first."""
    from ..streaming.intake import demo_two_batches

    return demo_two_batches(spark, table(spark, sf, "events"), "event_id")


@query("SRC-16", "SELECT user_id, event_id, floor((row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1) / 5)::BIGINT AS page, count(*) OVER (PARTITION BY user_id) AS total FROM events")
def listing_pages(spark, sf):
    from ..operators.pages import paginate

    return paginate(table(spark, sf, "events").select(F.col("user_id").alias("key"), "event_id"), "event_id").select(F.col("key").alias("user_id"), "event_id", "page", "total")


_KINDS = [k for k, _ in FIRST_HAND]
_SOURCES = [*(s for _, s in FIRST_HAND), "press"]


@query("CLS-20", f"""WITH c AS (SELECT user_id, list_extract({[*_KINDS]!r}, (user_id % 4 + 1)::INT) AS kind, list_extract({[*_SOURCES]!r}, (event_id % 5 + 1)::INT) AS source FROM events), t AS (SELECT user_id, max((f.source IS NOT NULL)::INT) AS f, count(DISTINCT c.source) AS sources FROM c LEFT JOIN (VALUES {sql_rows(FIRST_HAND)}) AS f(kind, source) ON f.kind = c.kind AND f.source = c.source GROUP BY 1)
SELECT user_id, sources, CASE WHEN f = 1 THEN 'first-hand' WHEN sources = 1 THEN 'single source' ELSE 'secondary' END AS tier FROM t""")
def evidence_tiers(spark, sf):
    """Each user is a claim of one of four kinds, each event a source of it: first-hand if the kind's own source is among them."""
    at = lambda values, key: F.element_at(F.array(*map(F.lit, values)), (F.col(key) % len(values) + 1).cast("int"))
    e = table(spark, sf, "events").select("user_id", at(_KINDS, "user_id").alias("kind"), at(_SOURCES, "event_id").alias("source"))
    return classify.evidence_tier(e.withColumn("first", classify.first_hand(F.col("kind"), F.col("source"))), "user_id", "source", "first")


_ROLES = {"view": "attach", "click": "detach", "error": "disconnect", "signup": "request", "purchase": "response"}


@query("AGG-10 STR-4 STR-5", """WITH e AS (SELECT user_id, ts, event_id, event_type, CAST(event_id % 7 AS INT) AS item FROM events),
z AS (SELECT user_id, max((ts, event_id)) AS fin, max(ts) AS fin_ts, max((ts, event_id)) FILTER (event_type = 'error') AS cut FROM e GROUP BY 1),
i AS (SELECT user_id, item, max((ts, event_id)) FILTER (event_type = 'view') AS a, max((ts, event_id)) FILTER (event_type = 'click') AS d, max((ts, event_id)) FILTER (event_type = 'signup') AS q, max(ts) FILTER (event_type = 'signup') AS q_ts, max((ts, event_id)) FILTER (event_type = 'purchase') AS p FROM e WHERE event_type <> 'error' GROUP BY 1, 2)
SELECT z.user_id, count(*) FILTER (a IS NOT NULL AND (d IS NULL OR a > d) AND (cut IS NULL OR a > cut)) AS sessions, count(*) FILTER (q IS NOT NULL AND (p IS NULL OR q > p) AND q_ts + INTERVAL 7 DAY > fin_ts) AS pending FROM z LEFT JOIN i ON i.user_id = z.user_id GROUP BY 1""")
def connection_state(spark, sf):
    """Users as connections: open sessions and pending requests after the last event; a disconnect clears the sessions only."""
    from ..streaming.sessions import connection_counts

    e = table(spark, sf, "events").select("user_id", "ts", "event_id", strings.lookup(_ROLES, F.col("event_type"), "other").alias("kind"), (F.col("event_id") % 7).cast("int").alias("item"))
    return connection_counts(e, "user_id", "ts", "event_id", "7 days")


@query("STR-3", "WITH q AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'view'), m AS (SELECT q.event_id, (epoch_us(min(a.ts)) - epoch_us(q.ts)) / 1e6 / 1800 AS late FROM q LEFT JOIN events a ON a.event_type = 'purchase' AND a.user_id = q.user_id AND a.ts >= q.ts AND a.ts <= q.ts + INTERVAL 15 HOUR GROUP BY q.event_id, q.ts) SELECT event_id, CASE WHEN late IS NOT NULL AND greatest(ceil(round(late, 6)), 1) < 30 THEN 'complete' ELSE 'timeout' END AS status, CAST(CASE WHEN late IS NOT NULL AND greatest(ceil(round(late, 6)), 1) < 30 THEN greatest(ceil(round(late, 6)), 1) ELSE 29 END AS INT) AS polls FROM m")
def poll_status(spark, sf):
    """Views wait for the same user's purchase, looking every half hour up to 15 hours."""
    from ..streaming.sessions import polled

    e = table(spark, sf, "events")
    waits = e.where("event_type = 'view'").select("event_id", "user_id", F.col("ts").alias("asked"))
    ready = e.where("event_type = 'purchase'").select("user_id", F.col("ts").alias("done"))
    return polled(waits, ready, ["user_id"], "event_id", "asked", "done", 1800.0, 54000.0)


@query("STR-2", "SELECT user_id AS id, CASE WHEN count(*) FILTER (event_type = 'purchase') > 0 THEN 'answered' ELSE 'timeout' END AS status FROM events WHERE event_type IN ('view', 'purchase') GROUP BY 1 HAVING count(*) FILTER (event_type = 'view') > 0")
def request_stream(spark, sf):
    """Each user's views and purchases as a stream of requests and responses; later messages move the watermark on, so that what is pending times out."""
    from ..streaming.correlate import match_stream
    from ..streaming.intake import replayed

    kind = strings.lookup({"view": "request", "purchase": "response"}, F.col("event_type"), "other")
    messages = table(spark, sf, "events").where("event_type IN ('view', 'purchase')").select(F.col("user_id").alias("id"), kind.alias("kind"), F.col("ts").cast("timestamp").alias("at"))
    later = [messages.groupBy().agg(F.lit(-1).cast("long").alias("id"), F.lit("response").alias("kind"), (F.max("at") + F.expr(f"INTERVAL {d} DAYS")).alias("at")).where("at IS NOT NULL") for d in (2, 4)]
    out = replayed([messages, *later], scratch(spark, "requests"), lambda stream: match_stream(stream.withWatermark("at", "1 minute")))
    return out.select("id", "status")


@query("STR-4", """WITH e AS (SELECT user_id, ts, event_id, event_type, CAST(event_id % 7 AS INT) AS item FROM events WHERE event_type IN ('view', 'click', 'error')), z AS (SELECT user_id, max((ts, event_id)) FILTER (event_type = 'error') AS cut FROM e GROUP BY 1),
i AS (SELECT user_id, item, max((ts, event_id)) FILTER (event_type = 'view') AS a, max((ts, event_id)) FILTER (event_type = 'click') AS d FROM e WHERE event_type <> 'error' GROUP BY 1, 2)
SELECT z.user_id AS connection, count(*) FILTER (a IS NOT NULL AND (d IS NULL OR a > d) AND (cut IS NULL OR a > cut)) AS sessions FROM z LEFT JOIN i ON i.user_id = z.user_id GROUP BY 1""")
def session_counts(spark, sf):
    """Each user's open sessions at the end of a stream that arrives in two parts; state is kept for each connection, and emptied by a disconnect."""
    from ..streaming.intake import replayed
    from ..streaming.sessions import session_stream

    e = table(spark, sf, "events").where("event_type IN ('view', 'click', 'error')")
    rows = e.select(F.col("user_id").alias("connection"), F.col("ts").cast("timestamp").alias("at"), strings.lookup(_ROLES, F.col("event_type"), "other").alias("kind"), (F.col("event_id") % 7).cast("string").alias("item"))
    half = F.lit(rows.agg(F.timestamp_seconds((F.unix_micros(F.min("at")) + F.unix_micros(F.max("at"))) / 2e6)).first()[0])
    out = replayed([rows.where(F.col("at") < half), rows.where(F.col("at") >= half)], scratch(spark, "sessions"), lambda stream: session_stream(stream.withWatermark("at", "400 days"), 40_000_000_000))
    return out.groupBy("connection").agg(F.max_by("sessions", "batch").alias("sessions"))
