from conftest import rows

from encore.operators.linking import link_texts
from pyspark.sql import functions as F

from encore.streaming.ingest import attempt_pending, attempts, covered_ids, ingest_new, link_incrementally, pending_ids

SCHEMA = "mbid string, ingest_seq int, v string"


def land(spark, folder, data, schema=SCHEMA):
    spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(folder)


def test_ingest_resumes_and_never_repeats(spark, tmp_path):
    landing, out, state = (str(tmp_path / p) for p in ("in", "out", "state"))
    run = lambda: ingest_new(spark, landing, SCHEMA, out, state, files_per_batch=1)
    land(spark, landing, [("a", 2, "late"), ("a", 1, "first"), ("b", 3, "b"), (None, 4, "x")])
    assert rows(run(), "mbid") == [("a", 1, "first"), ("b", 3, "b")]
    land(spark, landing, [("a", 5, "again"), ("c", 6, "c")])
    assert rows(run(), "mbid") == [("a", 1, "first"), ("b", 3, "b"), ("c", 6, "c")]
    assert run().count() == 3  # nothing new landed
    # Losing the checkpoint replays every file; earlier batches replace themselves.
    again = ingest_new(spark, landing, SCHEMA, out, str(tmp_path / "state2"))
    assert {r[0] for r in rows(again)} == {"a", "b", "c"}


def test_linking_as_a_stream_equals_the_batch(spark, tmp_path):
    items = spark.createDataFrame(
        [(1, "the band", "red widget", 5.0), (2, "band", "blue bolt", 3.0), (3, "solo", "ring", 1.0)],
        "mbid bigint, artist_name string, title string, log_repeat_listens double",
    )
    schema = "seq bigint, artist string, title string, lyrics string"
    first = [(1, "Band", "widget red", "t1"), (2, "x", "y", "t2")]
    second = [(3, "The Band", "Red Widget", "t3"), (4, "band", "blue bolts", "t4"), (5, "solo", "ring", None)]
    landing = str(tmp_path / "in")
    run = lambda: link_incrementally(
        spark, landing, schema, items, str(tmp_path / "out"), str(tmp_path / "state"), files_per_batch=1
    )
    land(spark, landing, first, schema)
    assert rows(run(), "mbid") == [(1, 1, "t1")]
    land(spark, landing, second, schema)
    batch = link_texts(spark.createDataFrame(first + second, schema), items)
    assert rows(run(), "mbid") == rows(batch, "mbid") == [(1, 1, "t1"), (2, 4, "t4")]


def test_resume_sets(spark):
    wanted = spark.createDataFrame([("a",), ("b",), ("a",), ("",), (None,)], "mbid string")
    done = spark.createDataFrame([("b",)], "mbid string")
    assert rows(pending_ids(wanted, done)) == [("a",)]
    assert rows(covered_ids(wanted, done)) == [("b",)]


def test_linking_ends_when_all_items_have_texts(spark, tmp_path):
    """The last file is no Parquet: reading it would fail. Twins that yield every title aren't waited for."""
    items = spark.createDataFrame(
        [(1, "the band", "red widget", 5.0), (2, "solo", "ring", 1.0), (3, "solo", "ring", 2.0), (4, "solo", "ring", 3.0),
         (5, "none", None, 1.0)],
        "mbid bigint, artist_name string, title string, log_repeat_listens double",
    )
    schema = "seq bigint, artist string, title string, lyrics string"
    landing, out, state = (str(tmp_path / p) for p in ("in", "out", "state"))
    run = lambda: link_incrementally(spark, landing, schema, items, out, state, files_per_batch=1)
    land(spark, landing, [(1, "Band", "widget red", "t1")], schema)
    assert rows(run(), "mbid") == [(1, 1, "t1")]
    left = spark.read.parquet(f"{state}-index/batch=0")
    assert {r["root"] for r in left.collect()} == {"solo"}  # the other artist is left out
    land(spark, landing, [(2, "solo", "ring", "t2"), (3, "Solo", "rings", "t3")], schema)
    want = [(1, 1, "t1"), (2, 2, "t2"), (4, 3, "t3")]
    assert rows(run(), "mbid") == want
    (tmp_path / "in" / "part-zzz.parquet").write_bytes(b"not a table")
    assert rows(run(), "mbid") == want


def test_failed_ids_come_back(spark, tmp_path):
    wanted = spark.createDataFrame([("a",), ("b",), ("c",), ("c",), (None,)], "mbid string")
    plan = {"a": ["found"], "b": ["failed", "failed", "found"], "c": ["absent"]}
    asked = []

    def fetch(pending):
        tried = rows(pending, "mbid")
        asked.append([r[0] for r in tried])
        got = [(i, plan[i][n], f"{i}{n}") for i, n in tried]
        return spark.createDataFrame(got, "mbid string, outcome string, v string")

    def run(log, **more):
        return attempt_pending(spark, wanted, fetch, str(tmp_path / log), "mbid string, outcome string, v string", **more)

    for _ in range(4):
        log = run("log")
    assert asked == [["a", "b", "c"], ["b"], ["b"], []]
    assert rows(attempts(log), "mbid") == [("a", 1, "found"), ("b", 3, "found"), ("c", 1, "absent")]
    assert rows(log.where(F.col("outcome") == "found").select("mbid", "v"), "mbid") == [("a", "a0"), ("b", "b2")]
    asked.clear()
    for _ in range(3):
        run("log2", most=1)
    assert asked == [["a", "b", "c"], [], []]
