"""Reading and writing stage tables, corpora, reports and fitted models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_BAD = "_bad_row"


def read_table(
    spark: SparkSession, path: str, schema: str | StructType, columns: Sequence[str] = (),
    fmt: str = "parquet",
) -> DataFrame:
    """A typed scan; with ``columns`` only those are read. A missing path fails."""
    reader = spark.read.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True).option("escape", '"')
    df = reader.format(fmt).load(path)
    return df.select(*columns) if columns else df


def read_corpus_csv(
    spark: SparkSession,
    path: str,
    header: Sequence[str] = ("title", "artist", "lyrics"),
    columns: Sequence[str] = ("title", "artist", "lyrics"),
    split: bool = True,
) -> DataFrame:
    """Text columns of a large CSV whose fields may hold line breaks.

    Rows with too many fields are skipped, short rows are padded with nulls, and rows with a null
    among ``columns`` are dropped. One file is read by many tasks: see ``csv_records``. With
    ``split=False`` a file is one task, which also bears a quote inside an unquoted field.
    """
    schema = ", ".join(f"`{c}` string" for c in header) + f", {_BAD} string"
    # Judge whole rows, not only the selected columns.
    options = {
        "multiLine": "true", "quote": '"', "escape": '"', "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": _BAD, "columnPruning": "false",
    }
    if split:
        records = csv_records(spark, path)
        rows = records.select(F.from_csv("record", schema, options).alias("r")).select("r.*")
    else:
        rows = spark.read.schema(schema).option("header", True).options(**options).csv(path)
    # A flagged row whose last field is present had too many fields.
    usable = F.col(_BAD).isNull() | F.col(header[-1]).isNull()
    return rows.where(usable).select(*columns).na.drop(subset=list(columns))


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """``record``: the records of CSV files below their headers, as text, read in byte ranges.

    Lines are dealt out by ranges of the file. A first scan counts the quotes of each range; their
    running sum tells whether a range begins within a quoted field. Each task then cuts its lines
    into records where the quotes are even. Only what a range's edge cuts apart, one record a
    range, is gathered and put together. Line ends within fields stay as they are. What the driver holds is one entry for each range that
    begins within a field. Quotes must stand in quoted fields, doubled inside them, as CSV has it.
    """
    lines = (
        spark.read.option("lineSep", "\n").text(path)
        .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.col("value").alias("line"))
    )
    quotes = F.length("line") - F.length(F.replace("line", F.lit('"'), F.lit("")))
    counted = lines.groupBy("file", "start").agg(F.sum(quotes).alias("quotes"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    within = counted.withColumn("before", F.sum("quotes").over(before)).where("before % 2 = 1")
    odd = {(r["file"], r["start"]) for r in within.select("file", "start").toLocalIterator()}
    odd_ranges = spark.sparkContext.broadcast(odd)

    def cut(batches):
        import pyarrow as pa

        columns = ("file", "start", "whole", "opens", "header", "record")
        at, within, opens, header, held, out = None, False, True, False, [], []

        def emit(whole):
            out.append((*at, whole, opens, header, "\n".join(held)))
            held.clear()

        for batch in batches:
            for file, start, line in zip(*(batch.column(c).to_pylist() for c in ("file", "start", "line"))):
                if (file, start) != at:
                    if held:
                        emit(False)
                    at = (file, start)
                    within = at in odd_ranges.value
                    opens, header = not within, start == 0
                held.append(line)
                if line.count('"') % 2:
                    within = not within
                if not within:
                    emit(opens)
                    opens, header = True, False
            if len(out) > 1000:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=columns)
                out.clear()
        if held:
            emit(False)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=columns)

    pieces = lines.mapInArrow(cut, "file string, start bigint, whole boolean, opens boolean, header boolean, record string")
    order = Window.partitionBy("file").orderBy("start", "opens")
    edges = pieces.where("not whole").withColumn("nth", F.sum(F.col("opens").cast("int")).over(order))
    mended = edges.groupBy("file", "nth").agg(
        F.array_sort(F.collect_list(F.struct("start", "opens", "record"))).alias("parts"), F.max("header").alias("header")
    )
    text = F.array_join(F.transform("parts", lambda p: p.record), "\n")
    return (
        pieces.where("whole").select("header", "record")
        .union(mended.select("header", text))
        .where("not header")
        .select(F.regexp_replace("record", "\\r$", "").alias("record"))
    )


def attribute_rows(spark: SparkSession, rows: DataFrame | None, schema: str) -> DataFrame:
    """``rows`` in the given schema; a missing source becomes an empty typed frame."""
    empty = spark.createDataFrame([], schema)
    return empty if rows is None else rows.select(*[F.col(c).cast(t) for c, t in empty.dtypes])


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; arrays join with ``; `` because CSV has no lists."""
    flat = df.select(
        *[
            F.array_join(c, "; ").alias(c) if t.startswith("array") else F.col(c)
            for c, t in df.dtypes
        ]
    )
    flat.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_summary(df: DataFrame, path: str) -> None:
    """A one-row report as a JSON document."""
    df.coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
