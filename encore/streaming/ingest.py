"""Resumable ingestion over landed files.

Both jobs run to the end of what has landed and stop (``availableNow``), remember their place in
a checkpoint, and may be started again at any time. Each micro-batch is written under its own
batch id, so a batch replayed after a failure replaces itself instead of adding rows.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.config import FUZZY_CUT
from encore.operators.linking import exact_index, fuzzy_index, link_targets, target_keys


def pending_ids(wanted: DataFrame, attempted: DataFrame, key: str = "mbid") -> DataFrame:
    """Distinct usable ids not attempted yet."""
    usable = F.col(key).isNotNull() & (F.col(key).cast("string") != "")
    return wanted.where(usable).select(key).distinct().join(attempted.select(key), key, "left_anti")


def covered_ids(wanted: DataFrame, popularity: DataFrame, key: str = "mbid") -> DataFrame:
    """Distinct ids that have popularity."""
    return wanted.select(key).distinct().join(popularity.select(key), key, "left_semi")


FOUND, ABSENT, FAILED = "found", "absent", "failed"


def attempts(log: DataFrame, key: str = "mbid") -> DataFrame:
    """``(key, tries, outcome)``: how often each id was tried and what came of it last."""
    return log.groupBy(key).agg(
        F.count("*").alias("tries"), F.max_by("outcome", "run").alias("outcome")
    )


def attempt_pending(
    spark: SparkSession,
    wanted: DataFrame,
    fetch: Callable[[DataFrame], DataFrame],
    log: str,
    schema: str,
    key: str = "mbid",
    most: int | None = None,
) -> DataFrame:
    """Try all ids that are not settled yet, once, and return the whole log.

    ``fetch`` turns ``(key, tries so far)`` into one row an id of ``schema``, which has the key, an
    ``outcome`` and whatever was fetched. Found and absent ids are settled; failed ones come back
    with the next run, up to ``most`` tries where that is given. A run is one folder of the log, which
    holds outcomes and what was fetched: a run that dies leaves no trace, and its ids come back.
    """
    everything = f"{schema}, run bigint"

    def read() -> DataFrame:
        if _latest(spark, log, 1 << 62, "run=") is None:
            return spark.createDataFrame([], everything)
        return spark.read.schema(everything).parquet(log)

    tried = attempts(read(), key)
    settled = F.col("outcome") != FAILED
    if most is not None:
        settled = settled | (F.col("tries") >= most)
    pending = pending_ids(wanted, tried.where(settled), key).join(
        tried.select(key, "tries"), key, "left"
    )
    rows = fetch(pending.withColumn("tries", F.coalesce("tries", F.lit(0))))
    last = _latest(spark, log, 1 << 62, "run=")
    run = 0 if last is None else last + 1
    names = [f.name for f in spark.createDataFrame([], schema).schema]
    rows.select(*names).write.mode("overwrite").parquet(f"{log}/run={run}")
    return read()


def _run(
    stream: DataFrame,
    each: Callable[[DataFrame, int], None],
    checkpoint: str,
    enough: Callable[[], bool] | None = None,
) -> None:
    """Run to the end of what has landed, or until ``enough``, asked after each batch."""
    ended = threading.Event()

    def batch(rows: DataFrame, n: int) -> None:
        if not ended.is_set():
            each(rows, n)
            if enough and enough():
                ended.set()

    query = (
        stream.writeStream.foreachBatch(batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    if enough is None:
        query.awaitTermination()
    while query.isActive and not query.awaitTermination(1):
        if ended.is_set():
            query.stop()
    if failure := query.exception():
        raise failure


def _done(spark: SparkSession, out: str, schema: str, before: int) -> DataFrame:
    """Rows of earlier batches; a batch never sees its own half-written output."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(out)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(path):  # nothing written yet
        return spark.createDataFrame([], f"{schema}, batch bigint")
    return spark.read.schema(f"{schema}, batch bigint").parquet(out).where(F.col("batch") < before)


def _written(spark: SparkSession, out: str, schema: str) -> DataFrame:
    return _done(spark, out, schema, 1 << 62).drop("batch")


def _write_batch(rows: DataFrame, batch: int, out: str) -> None:
    rows.write.mode("overwrite").parquet(f"{out}/batch={batch}")


def ingest_new(
    spark: SparkSession,
    landing: str,
    schema: str,
    out: str,
    checkpoint: str,
    key: str = "mbid",
    seq: str = "ingest_seq",
    fmt: str = "parquet",
    files_per_batch: int | None = None,
    name_pattern: str = "*",
) -> DataFrame:
    """Append landed rows whose key was not taken before; the earliest row of a key in its batch
    wins. Earlier keys live in the output table, not in unbounded stream state."""
    reader = spark.readStream.schema(schema).format(fmt).option("pathGlobFilter", name_pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    def each(rows: DataFrame, batch: int) -> None:
        taken = _done(rows.sparkSession, out, schema, batch).select(key)
        rest = [c for c in rows.columns if c != key]
        fresh = (
            rows.where(F.col(key).isNotNull())
            .groupBy(key)
            .agg(F.min_by(F.struct(*rest), F.col(seq)).alias("r"))
            .select(key, "r.*")
            .join(taken, key, "left_anti")
        )
        _write_batch(fresh, batch, out)

    _run(reader.load(landing), each, checkpoint)
    return spark.read.schema(schema).option("recursiveFileLookup", True).parquet(out)


def _latest(
    spark: SparkSession, index: str, before: int, prefix: str = "batch="
) -> int | None:
    """The last numbered folder that was written in full."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(index)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(path):
        return None
    done = [
        int(f.getPath().getName().removeprefix(prefix))
        for f in files.listStatus(path)
        if files.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f.getPath(), "_SUCCESS"))
    ]
    return max((n for n in done if n < before), default=None)


def shrink(index: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """Mark the items found and keep those whose artist still has an item without a text.

    Names that differ in leading "the"s are one artist: a text can reach no item of another one, and
    which item it reaches doesn't depend on others. So leaving whole artists out changes no link.
    """
    hit = found.select(F.col(key).alias("id"), F.lit(True).alias("_hit")).distinct()
    marked = index.join(hit, "id", "left").select(
        "id", "a", "t", "target", "root", (F.col("done") | F.col("_hit").isNotNull()).alias("done")
    )
    return marked.join(marked.where("NOT done").select("root").distinct(), "root", "left_semi")


def link_incrementally(
    spark: SparkSession,
    landing: str,
    schema: str,
    items: DataFrame,
    out: str,
    checkpoint: str,
    fmt: str = "parquet",
    files_per_batch: int | None = None,
    key: str = "mbid",
    key_type: str = "bigint",
    index: str | None = None,
    artist: str = "artist_name",
    title: str = "title",
    **options,
) -> DataFrame:
    """Link corpus files as they land; an item keeps the first text that reached it.

    Normalised items lie in ``index`` (beside the checkpoint unless given), written at the first
    start; each batch leaves a version without the artists whose items all have texts. Once it is
    empty no file is read any more, and the query ends. ``options`` go to ``link_targets``.
    """
    links = f"{key} {key_type}, seq bigint, text string"
    index = index or f"{checkpoint.rstrip('/')}-index"
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if _latest(spark, index, 0) is None:
        keys = target_keys(items, key, artist, title)
        reached = exact_index(keys).select("id")
        if options.get("cut", FUZZY_CUT) is not None:
            reached = reached.union(fuzzy_index(keys).select("best.id"))
        # Items that yield every title to another one aren't waited for.
        reached = reached.distinct().withColumn("_reached", F.lit(True))
        keys = keys.join(reached, "id", "left").select(
            "id", "a", "t", "target", F.regexp_replace("a", "^(the )+", "").alias("root"),
            F.col("_reached").isNull().alias("done"),
        )
        keys.write.mode("overwrite").parquet(f"{index}/batch=-1")
    types = spark.read.parquet(f"{index}/batch={_latest(spark, index, 1 << 62)}").schema

    def version(session: SparkSession, before: int) -> DataFrame:
        at = _latest(session, index, before)
        return session.read.schema(types).parquet(f"{index}/batch={at}")

    def each(rows: DataFrame, batch: int) -> None:
        # Every item of an open artist stays a candidate, so a text never moves to a second-best
        # item just because its best one already has a text.
        session = rows.sparkSession
        now = version(session, batch)
        if now.isEmpty():
            return
        found = link_targets(rows, now.drop("root", "done"), key=key, **options)
        taken = now.where("done").select(F.col("id").alias(key))
        _write_batch(found.join(taken, key, "left_anti"), batch, out)
        written = session.read.schema(links).parquet(f"{out}/batch={batch}")
        shrink(now, written, key).write.mode("overwrite").parquet(f"{index}/batch={batch}")

    everything = 1 << 62
    if not version(spark, everything).isEmpty():
        _run(reader.load(landing), each, checkpoint, lambda: version(spark, everything).isEmpty())
    return _written(spark, out, links)
