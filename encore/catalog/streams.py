"""Incremental jobs run to completion over the given files."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from encore.catalog.base import SCHEMAS, link_corpus, query, table, tracks
from encore.catalog.linking import LINKED_SQL
from encore.session import scratch_path
from encore.streaming.ingest import (
    ABSENT,
    FAILED,
    FOUND,
    attempt_pending,
    attempts,
    ingest_new,
    link_incrementally,
)


_FILE_ROWS = 1_000_000


def _land(rows, seq, folder):
    """Two files or more, of bounded size, in order of ``seq`` and one after the other, so that
    their times follow it."""
    low, high, n = rows.agg(F.min(seq), F.max(seq), F.count("*")).first()
    if not n:
        return
    files = max(2, -(-n // _FILE_ROWS))
    cuts = [low + (high + 1 - low) * i // files for i in range(files + 1)]
    for first, end in zip(cuts, cuts[1:]):
        own = rows.where((F.col(seq) >= first) & (F.col(seq) < end))
        own.coalesce(1).write.mode("append").parquet(folder)


@query(
    "incremental_ingest",
    """SELECT user_id, event_id, event_type, value FROM (SELECT *, ROW_NUMBER() OVER
        (PARTITION BY user_id ORDER BY event_id) AS r FROM events) WHERE r = 1""",
)
def incremental_ingest(spark, sf):
    work = scratch_path(spark, "ingest")
    landed = f"{work}/landing"

    def run():
        return ingest_new(
            spark, landed, SCHEMAS["events"], f"{work}/out", f"{work}/state",
            key="user_id", seq="event_id", files_per_batch=1,
        )

    # Events land in order, in several files; the second half lands after a first run has ended,
    # and is resumed from its checkpoint.
    events = table(spark, sf, "events")
    half = events.agg(F.expr("percentile_approx(event_id, 0.5)")).first()[0] or 0
    for part in (F.col("event_id") <= half, F.col("event_id") > half):
        _land(events.where(part), "event_id", landed)
        out = run()
    return out.select("user_id", "event_id", "event_type", "value")


@query("incremental_link", LINKED_SQL, ("tracks", "link_corpus"))
def incremental_link(spark, sf):
    work = scratch_path(spark, "link")
    # The corpus lands as several files, in order, as a crawler would leave it.
    landed = f"{work}/landing"
    _land(link_corpus(spark, sf), "seq", landed)
    schema = "seq bigint, artist string, title string, lyrics string"
    return link_incrementally(
        spark, landed, schema, tracks(spark, sf), f"{work}/out", f"{work}/state", files_per_batch=1
    )


_TRIES = 3


@query(
    "retry_failed",
    f"""WITH e AS (SELECT user_id, event_type, value,
            ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY event_id) AS r FROM events),
    f AS (SELECT user_id, MIN(r) AS hit FROM e WHERE event_type IN ('purchase', 'error') GROUP BY user_id),
    n AS (SELECT user_id, COUNT(*) AS n FROM e GROUP BY user_id)
    SELECT n.user_id, CAST(CASE WHEN hit <= {_TRIES} THEN hit
            WHEN n < {_TRIES} THEN n + 1 ELSE {_TRIES} END AS BIGINT) AS tries,
        CASE WHEN hit <= {_TRIES} THEN CASE event_type WHEN 'purchase' THEN 'found' ELSE 'absent' END
            WHEN n < {_TRIES} THEN 'absent' ELSE 'failed' END AS outcome,
        CASE WHEN hit <= {_TRIES} AND event_type = 'purchase' THEN value END AS value
    FROM n LEFT JOIN f USING (user_id) LEFT JOIN e ON e.user_id = n.user_id AND e.r = f.hit""",
)
def retry_failed(spark, sf):
    """Three runs over all users. A try's answer is the user's next event: a purchase is found, an
    error, or no event, is absent, all else fails."""
    events = table(spark, sf, "events")
    turn = Window.partitionBy("user_id").orderBy("event_id")
    answers = events.select(
        F.col("user_id").alias("_u"), "event_type", "value", F.row_number().over(turn).alias("_r")
    )
    kind = F.col("event_type")
    outcome = (
        F.when(kind == "purchase", FOUND).when(kind.isNull() | (kind == "error"), ABSENT).otherwise(FAILED)
    )

    def fetch(pending):
        own = (F.col("user_id") == F.col("_u")) & (F.col("_r") == F.col("tries") + 1)
        rows = pending.join(answers, own, "left").withColumn("outcome", outcome)
        return rows.withColumn("value", F.when(F.col("outcome") == FOUND, F.col("value")))

    path = f"{scratch_path(spark, 'attempts')}/log"
    for _ in range(_TRIES):
        log = attempt_pending(
            spark, events, fetch, path, "user_id bigint, outcome string, value double", key="user_id"
        )
    found = log.where(F.col("outcome") == FOUND).select("user_id", "value")
    return attempts(log, "user_id").join(found, "user_id", "left")
