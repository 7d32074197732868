import math

from conftest import rows
from pyspark.sql import functions as F

from encore.config import FeatureConfig
from encore.operators import prepare, profile, rollups
from encore.plans.processed import build_processed
from encore.sources import schemas
from encore.sources.tables import attribute_rows

CFG = FeatureConfig(as_of_year=2025)


def raw(spark):
    keys = [c.split()[0] for c in schemas.RAW_RECORDS.replace("\n", " ").split(",")]
    base = dict.fromkeys(keys)

    def rec(seq, mbid, genre, **kw):
        return tuple({**base, "ingest_seq": seq, "mbid": mbid, "genre": genre, **kw}[k] for k in keys)

    return spark.createDataFrame(
        [
            rec(3, "a", "rock", title="late", release_year="1990", artist_name="x"),
            rec(1, "a", "pop", title=None, release_year="1999", artist_name="x", duration_ms=2_000_000, artist_begin="1985"),
            rec(2, "a", "pop", title="mid"),
            rec(4, "b", None, title="b", release_year="2026", artist_name="y", duration_ms=90_000),
            rec(5, "c", "jazz", title="c", release_year="1899", artist_name="y"),
            rec(6, None, "jazz", title="no id"),
            rec(7, "d", "jazz", title="d", release_year="x1", artist_name="z", duration_ms=30_000),
        ],
        schemas.RAW_RECORDS,
    )


def popularity(spark):
    return spark.createDataFrame([("a", 100, 40), ("b", 9, 9), ("c", 3, 5), ("d", 50, 1)], schemas.POPULARITY)


def audio(spark):
    return spark.createDataFrame(
        [("a", 120.0, None, "C", "major", -5.0, None), ("d", 100.0, 2.0, None, None, None, None)], schemas.AUDIO
    )


def test_collapse_takes_the_first_record_whole(spark):
    got = {r["mbid"]: r for r in prepare.collapse_records(raw(spark).repartition(5)).collect()}
    assert set(got) == {"a", "b", "c", "d"}
    assert got["a"]["title"] is None and got["a"]["release_year"] == "1999"
    assert (got["a"]["genre"], got["a"]["genre_tags_text"], got["a"]["genre_match_count"]) == ("pop", "pop | rock", 2)
    assert (got["b"]["genre"], got["b"]["genre_tags_text"], got["b"]["genre_match_count"]) == ("Unknown", "", 0)


def test_processed_table(spark):
    out = build_processed(raw(spark), popularity(spark), audio(spark), CFG)
    got = {r["mbid"]: r for r in out.collect()}
    assert set(got) == {"a", "b", "d"}  # c has fewer listens than users
    a, b, d = got["a"], got["b"], got["d"]
    assert a["repeat_listens"] == 60 and math.isclose(a["log_repeat_listens"], math.log(61))
    assert (a["release_year"], a["release_decade"], a["track_age"], a["artist_career_age"]) == (1999, 1990, 26, 14)
    # Interaction uses the clipped-at-900 duration, before winsorising.
    assert math.isclose(a["career_x_duration_min"], 14 * 900 / 60)
    assert b["release_year"] is None and b["track_age"] is None and b["career_x_duration_min"] == 0
    assert (a["has_audio_features"], a["audio_feature_missing_count"]) == (1, 2)
    assert (b["has_audio_features"], b["audio_feature_missing_count"]) == (0, 4)
    assert a["tempo_x_dance"] is None and d["tempo_x_dance"] == 200.0
    assert b["key"] == "Unknown" and a["key"] == "C"
    assert (a["genre_enc"], b["genre_enc"], d["genre_enc"]) == (2, 0, 1)
    assert [got[k]["is_high_replay"] for k in "abd"] == [1, 0, 0]
    want = [c.split()[0] for c in schemas.PROCESSED.replace("\n", " ").split(",")]
    assert out.columns == want


def test_absent_enrichment_is_typed(spark):
    out = prepare.with_audio(spark.range(1).withColumnRenamed("id", "mbid"), None)
    assert dict(out.dtypes)["tempo"] == "double" and dict(out.dtypes)["key"] == "string"
    full = build_processed(raw(spark), popularity(spark), None, CFG)
    assert {r["has_audio_features"] for r in full.collect()} == {0}


def test_popularity_join_becomes_inner(spark):
    joined = raw(spark).select("mbid").join(popularity(spark), "mbid", "left")
    plan = prepare.with_target(joined)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftOuter" not in plan and "Inner" in plan


def test_rollup_guards_and_empty_results(spark):
    rows_ = [("g", "solo", "Unknown", 2000, 10, 2.0, None, 0)]
    df = spark.createDataFrame(
        rows_, "genre string, artist_name string, artist_country string, release_decade int, repeat_listens int,"
        " log_repeat_listens double, duration_sec double, has_audio_features int",
    )
    assert rows(rollups.period_trend(df)) == [(2000, 1, 2.0, None)]
    assert rows(rollups.trend_band(df)) == [(2000, 2.0, 0.0, 2.0, 2.0)]
    for empty in (rollups.top_entities(df), rollups.segment_breakdown(df), rollups.bucket_rollup(df)):
        assert empty.count() == 0 and len(empty.columns) >= 3
    assert rows(rollups.coverage_scalar(df)) == [(1, 0, 0.0, None, 2.0)]


def test_report_sizes_and_totals_agree(spark):
    df = spark.range(300).select(
        F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("genre"),
        F.concat(F.lit("x"), (F.col("id") % 7).cast("string")).alias("artist_name"),
        F.lit("US").alias("artist_country"),
        (F.col("id") % 4 * 10 + 1980).cast("int").alias("release_decade"),
        F.col("id").alias("repeat_listens"),
        F.log1p("id").alias("log_repeat_listens"),
        (F.col("id") * 2.0).alias("duration_sec"),
        (F.col("id") % 2).cast("int").alias("has_audio_features"),
        (F.col("id") % 3).cast("int").alias("genre_match_count"),
    )
    reports = rollups.run_reports(df)
    sizes = dict(rows(rollups.report_sizes(reports)))
    assert sizes["genre_summary"] == 2 and sizes["audio_coverage"] == 1 and sizes["duration_buckets"] == 6
    for name in ("genre_summary", "decade_trend", "duration_buckets", "genre_overlap", "audio_by_genre"):
        assert reports[name].agg(F.sum("n_tracks")).first()[0] == 300


def test_search_and_lookup(spark):
    df = spark.createDataFrame(
        [(1, "Red", "X", 1.0), (2, "Blue", "Y", 3.0), (3, None, "Y", 9.0), (4, "Blue", "Y", 2.0)],
        "mbid int, title string, artist_name string, log_repeat_listens double",
    )
    listed = rollups.catalog(df, 2)
    assert [r["label"] for r in listed.collect()] == ["Blue — Y", "Blue — Y"]
    assert rollups.search_catalog(listed, "E — y").count() == 2
    assert rollups.search_catalog(listed, "%").count() == 0
    assert rows(rollups.find_item(df, 1, "Blue", "Y"))[0][0] == 1
    assert rows(rollups.find_item(df, 99, "Blue", "Y"))[0][0] == 2


def test_profile_fallbacks(spark):
    df = spark.createDataFrame([("x", None, None), ("", None, "4"), (None, None, "no")], "a string, b int, c string")
    assert rows(profile.option_list(df, "a")) == [("x",)]
    assert rows(profile.option_list(df.where("a = ''"), "a")) == [("Unknown",)]
    assert rows(profile.option_list(df, "zzz")) == [("Unknown",)]
    assert rows(profile.median_default(df, "c", 7.0)) == [(4.0,)]
    assert rows(profile.median_default(df, "b", 7.0)) == [(7.0,)]
    assert rows(profile.range_bounds(df, "b", 1950, 2020)) == [(1950, 2020, [])]
    assert profile.observed_columns(df, ["c", "b", "a", "c", "zzz"]) == ["c", "a"]
    assert rows(profile.missingness(df))[0] == ("b", 3, 100.0)


def test_summaries(spark):
    out = build_processed(raw(spark), popularity(spark), audio(spark), CFG)
    s = profile.dataset_summary(out).first()
    assert (s["row_count"], s["column_count"], s["unique_tracks"], s["genres"]) == (3, 39, 3, ["Unknown", "jazz", "pop"])
    assert s["median_repeat_listens"] == 49.0 and s["audio_feature_coverage_pct"] == 66.67
    assert s["null_counts"]["title"] == 1
    c = profile.collection_summary(raw(spark), popularity(spark), attribute_rows(spark, None, schemas.AUDIO)).first()
    assert (c["musicbrainz_rows"], c["unique_recordings"], c["listenbrainz_coverage_pct"]) == (7, 4, 100.0)
    assert c["acousticbrainz_coverage_pct"] == 0.0 and {g["genre"]: g["n"] for g in c["genre_counts"]}["Unknown"] == 1
