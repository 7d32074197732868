import math

import numpy as np
import pytest
from conftest import rows
from pyspark.ml import Pipeline
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from encore.config import FeatureConfig
from encore.learning import metrics, models, prepare, splits
from encore.plans import scoring
from encore.sources import load_model, save_model


@pytest.fixture(scope="module")
def numbers(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(60, 3)) * [1, 5, 0.2]
    y = x @ [2.0, -0.3, 1.0] + 4 + rng.normal(size=60)
    data = [([float(v) for v in a], float(b)) for a, b in zip(x, y)]
    df = spark.createDataFrame(data, "a array<double>, log_repeat_listens double")
    return x, y, df.select(array_to_vector("a").alias("features"), "log_repeat_listens").persist()


def test_ridge_equals_closed_form(numbers):
    x, y, df = numbers
    for alpha in (0.0, 1.0, 10.0, 200.0):
        model = models.Ridge(alpha=alpha).fit(df)
        xc, yc = x - x.mean(0), y - y.mean()
        w = np.linalg.solve(xc.T @ xc + alpha * np.eye(3), xc.T @ yc)
        assert np.allclose(model.coefficients.toArray(), w, rtol=1e-5)
        assert math.isclose(model.intercept, y.mean() - x.mean(0) @ w, rel_tol=1e-5)


def test_lasso_meets_its_optimality_conditions(numbers):
    x, y, df = numbers
    alpha = 0.4
    lasso = LinearRegression(labelCol="log_repeat_listens", regParam=alpha, elasticNetParam=1.0, standardization=False, maxIter=20000, tol=1e-12)
    w = lasso.fit(df).coefficients.toArray()
    xc, yc = x - x.mean(0), y - y.mean()
    slope = xc.T @ (yc - xc @ w) / len(y)
    for s, v in zip(slope, w):
        assert (abs(s) <= alpha + 1e-4) if v == 0 else math.isclose(s, alpha * np.sign(v), abs_tol=1e-4)


def table(spark):
    data = [(i, float(i % 7), None if i % 5 == 0 else float(i % 3), "ab"[i % 2] if i % 9 else None, float(i % 7) * 2 + (i % 2)) for i in range(90)]
    return spark.createDataFrame(data, "mbid int, n1 double, n2 double, c string, log_repeat_listens double")


def test_fills_come_from_the_fitted_rows_only(spark):
    df = table(spark)
    fitted = prepare.FillMissing(numericCols=["n2"], categoricalCols=["c"]).fit(df.where("mbid < 3"))
    got = fitted.transform(df.where("mbid = 45")).first()
    assert got["n2__filled"] == 1.5 and got["n2"] is None  # median of 1, 2
    assert got["c__filled"] == "a"  # one `a`, one `b`: the smaller wins


def test_unseen_category_is_all_zeros(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",)], "c string")
    fitted = Pipeline(stages=prepare.preprocessing([], ["c"])).fit(df)
    new = spark.createDataFrame([("a",), ("z",), (None,)], "c string")
    got = [r[0] for r in fitted.transform(new).select(vector_to_array("features")).collect()]
    assert got == [[1.0, 0.0], [0.0, 0.0], [0.0, 1.0]]


def test_model_survives_saving(spark, tmp_path):
    df = table(spark)
    model = prepare.pca_pipeline(models.Ridge(alpha=5.0, featuresCol="components"), ["n1", "n2"], ["c"]).fit(df)
    save_model(model, str(tmp_path / "m"))
    a = [r[0] for r in model.transform(df).orderBy("mbid").select("prediction").collect()]
    b = [r[0] for r in load_model(str(tmp_path / "m")).transform(df).orderBy("mbid").select("prediction").collect()]
    assert a == b


def test_pca_keeps_the_fewest_components(spark):
    df = table(spark)
    model = prepare.pca_pipeline(models.Ridge(alpha=5.0, featuresCol="components"), ["n1", "n2"], ["c"]).fit(df)
    shares = [r["cumulative"] for r in models.pca_summary(model).orderBy("component").collect()]
    assert shares[-1] >= 0.95 and all(s < 0.95 for s in shares[:-1])


def test_evaluate_and_reports(spark):
    df = splits.with_fold(splits.with_holdout(table(spark), "mbid"), "mbid", 3)
    train, test = df.where("not is_test").persist(), df.where("is_test").persist()
    chosen = models.line_up(["n1", "n2"], ["c"], trees=3, boosts=2)
    row, ridge = models.evaluate("Ridge", chosen["Ridge"], train, test, folds=3)
    got = row.first()
    assert list(row.columns) == ["model", "cv_rmse_mean", "cv_rmse_std", "cv_mae_mean", "cv_mae_std", "cv_r2_mean", "cv_r2_std", "test_rmse", "test_mae", "test_r2"]
    assert got["cv_r2_mean"] > 0.8 and got["test_r2"] > 0.8
    forest = chosen["Random Forest"].fit(train)
    imp = models.importance_table({"Ridge": ridge, "Random Forest": forest}, train, ["n1", "n2"], ["c"])
    assert {(r["feature"], r["source_feature"]) for r in imp.collect()} == {("n1", "n1"), ("n2", "n2"), ("c_a", "c"), ("c_b", "c")}
    assert models.importance_top(imp, "Random Forest", 1).first()["feature"] == "n1"
    wide = models.prediction_table({"Ridge": ridge, "Random Forest": forest}, test)
    assert wide.columns == ["mbid", "y_true", "pred_ridge", "pred_random_forest"]
    assert models.resolve_prediction(wide.columns, "Random Forest") == "pred_random_forest"
    assert models.resolve_prediction(wide.columns, "Lasso") == "pred_random_forest"
    assert models.resolve_prediction(["x"], "Lasso") is None


def test_search_draws(spark):
    drawn = models.draw_settings(models.BOOST_GRID, 15)
    assert len(drawn) == 15 and len({tuple(sorted(d.items())) for d in drawn}) == 15
    assert drawn == models.draw_settings(models.BOOST_GRID, 15)
    assert len(models.draw_settings({"a": [1, 2]}, 15)) == 2


def test_stratified_split(spark):
    df = spark.createDataFrame([(i, "a" if i < 900 else "b" if i < 1000 else "c") for i in range(1003)], "k int, l string")
    for parts in (1, 6):
        got = splits.with_stratified_holdout(df.repartition(parts), "k", "l")
        sizes = {r["l"]: r["n"] for r in got.where("is_test").groupBy("l").agg(F.count("*").alias("n")).collect()}
        assert got.count() == 1003 and sizes == {"a": 180, "b": 20}


def test_metrics(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 2.0), (3.0, 5.0), (None, 1.0)], "y double, p double")
    got = metrics.regression_metrics(df, "y", "p").first()
    assert got["n"] == 3 and np.allclose([got["rmse"], got["mae"], got["r2"]], [math.sqrt(4 / 3), 2 / 3, -1.0])
    one = metrics.regression_metrics(df.limit(1), "y", "p").first()
    assert one["r2"] is None
    c = spark.createDataFrame([(1, 0.9), (0, 0.9), (1, 0.4), (0, 0.1)], "y int, s double")
    got = metrics.classification_metrics(c, "y", "s").first()
    assert (got["accuracy"], got["f1"], got["roc_auc"]) == (0.5, 0.5, 0.625)
    w = dict(rows(metrics.class_weights(spark.createDataFrame([(0,)] * 3 + [(1,)], "y int"), "y").select("y", "weight")))
    assert w == {0: 4 / 6, 1: 2.0}


def test_feature_gate(spark):
    cfg = FeatureConfig(numeric=("n1", "zzz"), optional_numeric=("n2",), categorical=("c",), optional_categorical=(), coverage_flag="f")
    low = table(spark).withColumn("f", F.lit(0))
    assert prepare.choose_features(low, cfg)[:2] == (["n1"], ["c"])
    high = table(spark).withColumn("f", (F.col("mbid") % 2).cast("int"))
    assert prepare.choose_features(high, cfg)[0] == ["n1", "n2"]
    frame = prepare.model_frame(table(spark).withColumn("n1", F.lit("bad")), ["n1"], ["c"])
    assert frame.columns == ["mbid", "n1", "c", "log_repeat_listens"] and frame.first()["n1"] is None


def test_profiles_and_scores(spark):
    profiles = spark.createDataFrame(
        [(1999, 120.0, 6, 100.0, 2.0, -5.0, 1.0, True, "a"), (2000, 60.0, 1, 100.0, 2.0, -5.0, 1.0, False, "b")],
        "release_year int, duration_sec double, artist_career_age int, tempo double, danceability double,"
        " loudness double, dynamic_complexity double, use_audio boolean, genre string",
    )
    a, b = scoring.complete_profiles(profiles, cfg=FeatureConfig(as_of_year=2025)).orderBy("release_year").collect()
    assert (a["tempo_x_dance"], a["release_decade"], a["track_age"], a["career_x_duration_min"]) == (200.0, 1990.0, 26.0, 12.0)
    assert (b["tempo"], b["tempo_x_dance"], b["audio_feature_missing_count"]) == (None, 0.0, 4.0)
    ref = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 2.0)], "genre string, log_repeat_listens double")
    scored = spark.createDataFrame([("a", 1.0, 2.0), ("b", 5.0, -1.0), ("b", None, 1.0)], "genre string, log_repeat_listens double, prediction double")
    got = {r["prediction"]: r for r in scoring.score_items(scored, ref).collect()}
    assert got[2.0]["direction"] == "above" and math.isclose(got[2.0]["percentile"], 200 / 3) and got[2.0]["category_median"] == 2.0
    assert got[-1.0]["predicted_repeats"] == 0.0 and got[-1.0]["direction"] == "below"
    assert got[1.0]["residual"] is None and got[1.0]["direction"] is None
