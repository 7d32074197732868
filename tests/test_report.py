from conftest import rows
from pyspark.sql import functions as F

from encore.operators import terms
from encore.plans import report


def test_eda_report(spark):
    df = spark.range(200).select(
        F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("genre"),
        F.col("id").alias("repeat_listens"),
        F.log1p("id").alias("log_repeat_listens"),
        (F.col("id") * 2.0).alias("duration_sec"),
        (F.col("id") % 2).cast("int").alias("has_audio_features"),
    )
    got = {(s, k): v for s, _, k, v in rows(report.eda_report(df))}
    assert got["dataset", "rows"] == "200" and got["dataset", "audio_pct"] == "50.0"
    assert got["median repeats", "b"] == "100.0" and got["spearman", "rho"] == "1.0"
    assert got["kruskal-wallis", "groups"] == "2"


def test_model_report(spark):
    results = spark.createDataFrame(
        [("Ridge", 0.2, 2.0, 1.0), ("GBM", 0.3, 1.5, 0.9)], "model string, test_r2 double, test_rmse double, test_mae double"
    )
    importance = spark.createDataFrame(
        [("GBM", f"f{i}", float(i)) for i in range(12)] + [("Ridge", "x", 99.0)], "model string, feature string, importance double"
    )
    imbalance = spark.createDataFrame([("plain", 0.3, 0.7), ("balanced", 0.5, 0.7)], "model string, f1 double, roc_auc double")
    pca = spark.createDataFrame([(0, 0.9, 0.9), (1, 0.06, 0.96)], "component int, explained double, cumulative double")
    got = rows(report.model_report(results, importance, imbalance, pca))
    assert ("best model", 0, "model", "GBM") in got and ("pca", 0, "components", "2") in got
    top = [r for r in got if r[0] == "top features"]
    assert len(top) == 10 and ("top features", 1, "f11", "11.0") in top


def test_text_report(spark):
    texts = spark.createDataFrame([(1, "love love night\nlove"), (2, "sad sea"), (3, "blue moon blue")], "mbid int, text string")
    lexicon = spark.createDataFrame([("love", 3.0), ("sad", -2.0)], "word string, valence double")
    freq = spark.createDataFrame([("love", 0.5)], "word string, freq double")
    y = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, 4.0)], "mbid int, log_repeat_listens double")
    merged = terms.text_features(texts, lexicon, freq).join(y, "mbid")
    words = spark.createDataFrame([("a", 2.0), ("b", 0.5)], "word string, freq_ratio double")
    topics = spark.createDataFrame([(0, 0, "x", 0.5), (0, 1, "y", 0.4)], "topic int, position int, word string, weight double")
    got = rows(report.text_report(merged, words, words, topics))
    assert ("means", 0, "texts", "3") in got and ("topics", 0, "0", "x, y") in got
    assert ("high words", 1, "a", "2.0") in got and ("low pairs", 1, "b", "0.5") in got
    assert len([r for r in got if r[0] == "correlations"]) == 9
