"""Registry of the package's queries and what its operators share."""

from __future__ import annotations

import tempfile
import zipfile
import zlib
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

#: The blanks that separate words and are stripped from lines: [\x20\x09-\x0D].
BLANKS = " \t\n\x0b\x0c\r"

#: Most bytes of rows that one Arrow batch carries to a Python worker. Rows, their texts and lists of
#: their words stand side by side there, several times as large as the batch.
BATCH_BYTES = 8 << 20


def query(name: str, oracle: str | None = None) -> Callable:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return fn

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def utf8(column: str) -> Column:
    """The whole text as bytes; null counts as empty."""
    return F.coalesce(F.col(column).cast("binary"), F.lit(b""))


def fold(column: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % parts


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Make ready for Python workers: limit their batches, and send them this library's modules,
    once per application."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    if (app := spark.sparkContext.applicationId) not in _SHIPPED:
        top = Path(__file__).resolve().parents[1]
        path = f"{tempfile.mkdtemp()}/{top.name}.zip"
        with zipfile.ZipFile(path, "w") as out:
            for p in sorted(top.rglob("*.py")):
                out.write(p, p.relative_to(top.parent))
        spark.sparkContext.addPyFile(path)
        _SHIPPED.add(app)


def map_batches(
    df: DataFrame, fn: Callable[[pa.RecordBatch], dict | pa.RecordBatch], schema: str
) -> DataFrame:
    """Apply ``fn`` to the Arrow batches of ``df``; a dict of columns becomes a batch of ``schema``.

    Batches are limited by bytes as well as by rows, so a worker's memory doesn't follow the
    length of texts.
    """
    spark = df.sparkSession
    ship(spark)
    wanted = to_arrow(spark, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = fn(batch)
                yield pa.RecordBatch.from_arrays(
                    [as_array(out[f.name], f.type) for f in wanted], schema=wanted
                )

    return df.mapInArrow(run, schema)


def as_array(values, kind: pa.DataType) -> pa.Array:
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    return values.cast(kind) if isinstance(values, pa.Array) else pa.array(values, kind)


def sparse_rows(
    table: pa.Table, at: str, value: str, *keys: str
) -> tuple[list[tuple[np.ndarray, np.ndarray]], list[tuple]]:
    """The pairs of lists of two columns, as views of the table, and the keys beside them; in the
    order of the keys."""
    rows = []
    for batch in table.to_batches():
        bounds = batch.column(at).offsets.to_numpy()
        flat = [batch.column(n).values.to_numpy(zero_copy_only=False) for n in (at, value)]
        rows += [tuple(f[a:b] for f in flat) for a, b in zip(bounds, bounds[1:])]
    beside = list(zip(*[table.column(k).to_pylist() for k in keys]))
    order = sorted(range(len(rows)), key=beside.__getitem__)
    return [rows[i] for i in order], [beside[i] for i in order]


#: Arrow types of the column types in use here.
_KINDS = {
    "bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(),
    "string": pa.string(), "binary": pa.binary(), "array<int>": pa.list_(pa.int32()),
    "array<bigint>": pa.list_(pa.int64()), "array<double>": pa.list_(pa.float64()),
    "array<string>": pa.list_(pa.string()), "array<float>": pa.list_(pa.float32()),
}


def to_arrow(spark: SparkSession, schema: str) -> pa.Schema:
    return pa.schema([pa.field(n, _KINDS[k]) for n, k in (c.split() for c in schema.split(", "))])


#: Most kinds (languages, classes) that a bounded sample is drawn for.
KINDS = 1_000


def bounded(df: DataFrame, rows: int, by: str, kind: str | None = None) -> DataFrame:
    """So many rows at most (of each kind, if a column of kinds is named): those with the smallest
    hashes of ``by``. A first cut by hash, from counts, leaves about twice as many to rank, so
    neither the ranking nor what it reads grows with ``df``. Columns that begin with _b_ are lost.
    """
    mark = df.withColumn("_b_kind", F.col(kind) if kind else F.lit(0)).withColumn("_b_hash", F.xxhash64(by))
    counts = mark.groupBy("_b_kind").count().limit(KINDS + 1).collect()
    if len(counts) > KINDS:
        raise ValueError(f"more than {KINDS} values of {kind}")
    shares = 1 << 30
    share = F.lit(0)
    for value, n in counts:
        own = F.col("_b_kind").eqNullSafe(F.lit(value))
        share = F.when(own, int(shares * min(1.0, (2.0 * rows + 200) / n)) + 1).otherwise(share)
    rank = Window.partitionBy("_b_kind").orderBy("_b_hash", by)
    return (
        mark.where(F.pmod("_b_hash", F.lit(shares)) < share)
        .withColumn("_b_rank", F.row_number().over(rank))
        .where(F.col("_b_rank") <= rows)
        .drop("_b_kind", "_b_hash", "_b_rank")
    )


#: Bits of one row of a table of marks, as ``bitmap_construct_agg`` makes them, and bits for each key.
MARK_BITS, BITS_A_KEY = 1 << 15, 16


def likely(df: DataFrame, key: Column, keys: DataFrame) -> DataFrame:
    """The rows of ``df`` whose key (a long) may be in the one column of ``keys``: all that are, and about
    one in ``BITS_A_KEY`` of the others. What it broadcasts takes two bytes a key, so wide rows that a
    join would drop aren't shuffled for it. Columns that begin with _m_ are lost."""
    parts = 1
    wanted = keys.count() * BITS_A_KEY
    while parts * MARK_BITS < wanted:
        parts *= 2
    at = lambda c: F.pmod(F.xxhash64(c, F.lit(7)), F.lit(parts * MARK_BITS))
    place = F.col("_m_at")
    marks = keys.select(at(F.col(keys.columns[0])).alias("_m_at"))
    marks = marks.groupBy(F.floor(place / MARK_BITS).cast("int").alias("_m_part")).agg(
        F.bitmap_construct_agg(place % MARK_BITS).alias("_m_bits")
    )
    own = df.withColumn("_m_at", at(key)).withColumn("_m_own", F.floor(place / MARK_BITS).cast("int"))
    byte = F.expr(f"cast(conv(hex(substring(_m_bits, cast(_m_at % {MARK_BITS} / 8 as int) + 1, 1)), 16, 10) as int)")
    found = own.join(F.broadcast(marks), F.col("_m_own") == F.col("_m_part"))
    return found.where(byte.bitwiseAND(F.expr("shiftleft(1, cast(_m_at % 8 as int))")) != 0).select(*df.columns)


class Memo(dict):
    """A dict that computes what it lacks. Emptied by its user when it has grown past ``limit``."""

    def __init__(self, fn: Callable, limit: int = 400_000):
        super().__init__()
        self.fn, self.limit = fn, limit

    def __missing__(self, key):
        out = self[key] = self.fn(key)
        return out


def crc(value: object) -> int:
    return zlib.crc32(str(value).encode())


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))
