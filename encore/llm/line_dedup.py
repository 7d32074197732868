"""Line deduplication over levelled sorted runs of line hashes.

Documents come in batches. A batch's lines become a run: one row per line key with the number of
documents that hold it, hashed to buckets and sorted. The run is merge-anti-joined with the older
runs, which tells the keys seen for the first time; those get their owner here. Runs of a level
are compacted into one run of the next level as soon as there are ``FANOUT``. Runs lie in bucketed
tables, so neither the joins nor the compaction shuffle the older runs.

The query hands its batches over by falling document id, so a key's first run holds the largest
id: its owner, which alone keeps the line where enough documents hold it.

Only DataFrame functions are used. Keys are compared by 128 bits of hash.

Defined cases. A null text has one empty line, like an empty one. Rows are documents: repeated
rows count apart, and all rows of the owning id keep the line. A row without an id keeps its lines
and isn't counted. An empty table gives an empty result. In ``dedup_lines`` other columns pass
through, whatever their names, but for names that begin with ``_runs_``.
"""

from __future__ import annotations

import string
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.llm.base import BLANKS, query, table
from encore.session import scratch_path, stage_table

MIN_CHARS = 20
MIN_DOCS = 3
BATCHES = 4
FANOUT = 2


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_key(line: Column) -> Column:
    """The line without blanks at its ends and with A-Z, but no other letter, lower-cased."""
    bare = F.btrim(line, F.lit(BLANKS))
    ascii_only = F.octet_length(bare) == F.char_length(bare)
    folded = F.translate(bare, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(ascii_only, F.lower(bare)).otherwise(folded)


def hashed(key: Column) -> Column:
    return F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2"))


def key_hashes(lines: Column) -> Column:
    """Hashes of the distinct keys that are long enough."""
    keys = F.transform(lines, line_key)
    return F.array_distinct(
        F.transform(F.filter(keys, lambda k: F.char_length(k) >= MIN_CHARS), hashed)
    )


class LineRuns:
    """The runs: per level, tables of counts and tables of owners."""

    def __init__(self, spark: SparkSession, fanout: int = FANOUT):
        self.spark, self.fanout = spark, fanout
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[tuple[DataFrame, DataFrame]]] = []

    def _write(self, rows: DataFrame) -> DataFrame:
        name = f"line_run_{uuid.uuid4().hex}"
        (
            rows.repartition(self.buckets, "h1")
            .write.bucketBy(self.buckets, "h1")
            .sortBy("h1", "h2")
            .option("path", scratch_path(self.spark, name))
            .saveAsTable(name)
        )
        return self.spark.table(name)

    def runs(self) -> list[tuple[DataFrame, DataFrame]]:
        return [run for level in self.levels for run in level]

    def add(self, lines: DataFrame) -> None:
        """Add a batch of (doc_id, h1, h2), one row for each document and key."""
        counts = self._write(
            lines.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.max("doc_id").alias("owner"))
        )
        fresh = counts.select("h1", "h2", "owner")
        for _, older in self.runs():
            fresh = fresh.join(older.hint("merge"), ["h1", "h2"], "left_anti")
        self._push(0, (counts.select("h1", "h2", "n"), self._write(fresh)))

    def _push(self, level: int, run: tuple[DataFrame, DataFrame]) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fanout:
            counts, owners = (self._union(i, self.levels[level]) for i in (0, 1))
            merged = counts.groupBy("h1", "h2").agg(F.sum("n").alias("n"))
            self.levels[level] = []
            self._push(level + 1, (self._write(merged), self._write(owners)))

    @staticmethod
    def _union(side: int, runs: list) -> DataFrame:
        out = runs[0][side]
        for run in runs[1:]:
            out = out.unionByName(run[side])
        return out

    def repeated(self, min_docs: int = MIN_DOCS) -> DataFrame:
        """(h1, h2, owner) of the keys that so many documents hold."""
        runs = self.runs()
        totals = self._union(0, runs).groupBy("h1", "h2").agg(F.sum("n").alias("n"))
        return totals.where(F.col("n") >= min_docs).drop("n").join(self._union(1, runs), ["h1", "h2"])


def dropped_keys(docs: DataFrame, batches: int = BATCHES, min_docs: int = MIN_DOCS) -> DataFrame:
    """_runs_id and _runs_drops: for each document that loses lines, the hashes of their keys."""
    spark = docs.sparkSession
    lines = stage_table(
        docs.where(F.col("doc_id").isNotNull())
        .select(F.col("doc_id").cast("bigint").alias("doc_id"), F.explode(key_hashes(split_lines(F.col("text")))).alias("k"))
        .select("doc_id", "k.h1", "k.h2"),
        "lines",
    )
    low, high = lines.agg(F.min("doc_id"), F.max("doc_id")).first()
    runs = LineRuns(spark)
    if low is None:
        return spark.createDataFrame([], "_runs_id bigint, _runs_drops array<struct<h1: bigint, h2: bigint>>")
    cuts = [low + (high + 1 - low) * i // batches for i in range(batches + 1)]
    for first, end in reversed([c for c in zip(cuts, cuts[1:]) if c[0] < c[1]]):
        runs.add(lines.where((F.col("doc_id") >= first) & (F.col("doc_id") < end)))
    repeated = stage_table(runs.repeated(min_docs), "repeated-lines")
    return (
        lines.join(repeated, ["h1", "h2"])
        .where(F.col("doc_id") < F.col("owner"))
        .groupBy(F.col("doc_id").alias("_runs_id"))
        .agg(F.collect_list(F.struct("h1", "h2")).alias("_runs_drops"))
    )


def dedup_lines(docs: DataFrame, **how) -> DataFrame:
    """``docs`` with _runs_lines (all lines) and _runs_kept (those that stay)."""
    drops = dropped_keys(docs, **how)
    key = F.col("doc_id").cast("bigint") == F.col("_runs_id")
    lines, gone = F.col("_runs_lines"), F.col("_runs_drops")
    kept = F.filter(lines, lambda line: ~F.array_contains(gone, hashed(line_key(line))))
    return (
        docs.join(drops, key, "left")
        .withColumn("_runs_lines", split_lines(F.col("text")))
        .withColumn("_runs_kept", F.when(gone.isNull(), lines).otherwise(kept))
        .drop("_runs_id", "_runs_drops")
    )


def keep_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with the lines that go taken from ``text``."""
    text = F.array_join("_runs_kept", "\n").alias("text")
    return dedup_lines(docs).select(*[text if c == "text" else F.col(c) for c in docs.columns])


_AZ, _az = string.ascii_uppercase, string.ascii_lowercase


@query(
    "op1_line_dedup",
    f"""
    WITH lines AS (
        SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS pos
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)),
    keyed AS (
        SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                            '{_AZ}', '{_az}') AS key
        FROM lines),
    common AS (
        SELECT key, max(doc_id) AS owner FROM keyed WHERE length(key) >= 20
        GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
    marked AS (
        SELECT k.*, coalesce(c.owner <> k.doc_id, false) AS gone
        FROM keyed k LEFT JOIN common c ON k.key = c.key)
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), ''))
               AS kept_sha256
    FROM marked GROUP BY doc_id""",
)
def op1_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    lines, kept = F.col("_runs_lines"), F.col("_runs_kept")
    return dedup_lines(docs).select(
        "doc_id",
        F.size(lines).cast("bigint").alias("n_lines"),
        (F.size(lines) - F.size(kept)).cast("bigint").alias("n_dropped"),
        F.sha2(F.array_join(kept, "\n"), 256).alias("kept_sha256"),
    )
