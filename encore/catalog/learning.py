"""Feature gating, splits, preprocessing, models and their scores.

Model queries train on every row at the library's defaults. The tuned boosting search (15 draws of
five folds and up to 500 rounds) is a library function without a query: see the README.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.catalog.base import query, state_of, tracks
from encore.config import TARGET, FeatureConfig
from encore.learning import metrics, models, moments, prepare, splits
from encore.operators.profile import coverage, existing
from encore.operators.stats import high_label
from encore.session import stage_table

T = ("tracks",)
CFG = FeatureConfig(
    numeric=(
        "duration_sec", "release_year", "release_decade", "track_age", "genre_match_count",
        "has_audio_features",
    ),
    categorical=("genre", "release_type", "artist_type", "artist_country"),
    optional_categorical=("key",),
)
_NUM = ["duration_sec", "release_year", "track_age", "genre_match_count", "has_audio_features"]
_CAT = ["genre", "release_type", "artist_country"]
_HASH = "('0x' || substr(md5(CAST(mbid AS VARCHAR)), 1, 8))::BIGINT"


def _framed(spark, sf):
    """Model rows, staged once because fitting reads them many times."""
    rows = tracks(spark, sf)
    frame = prepare.model_frame(rows, _NUM, _CAT)
    return stage_table(splits.with_fold(splits.with_holdout(frame, "mbid"), "mbid", 5, "f"), "frame")


def _halves(spark, sf):
    rows = _framed(spark, sf)
    return rows.where(~F.col("is_test")), rows.where(F.col("is_test"))


@query(
    "coverage_gate",
    """SELECT ROUND(AVG(has_audio_features), 6) AS coverage,
        AVG(has_audio_features) >= 0.5 AS use_audio,
        'duration_sec,release_year,release_decade,track_age,genre_match_count,has_audio_features'
        || CASE WHEN AVG(has_audio_features) >= 0.5
            THEN ',tempo,danceability,loudness,dynamic_complexity' ELSE '' END AS numeric_features
    FROM tracks""",
    T,
)
def coverage_gate(spark, sf):
    rows = tracks(spark, sf)
    numeric, _, context = prepare.choose_features(rows, CFG)
    return coverage(rows).select(
        F.round("coverage", 6).alias("coverage"),
        F.lit(context["use_audio_features"]).alias("use_audio"),
        F.lit(",".join(existing(numeric, rows.columns))).alias("numeric_features"),
    )


@query(
    "model_frame",
    """SELECT mbid, title, artist_name, genre, CAST(duration_sec AS DOUBLE) AS duration_sec,
        CAST(release_year AS DOUBLE) AS release_year, CAST(track_age AS DOUBLE) AS track_age,
        CAST(genre_match_count AS DOUBLE) AS genre_match_count,
        CAST(has_audio_features AS DOUBLE) AS has_audio_features, release_type, artist_country,
        ROUND(log_repeat_listens, 9) AS log_repeat_listens
    FROM tracks WHERE log_repeat_listens IS NOT NULL""",
    T,
)
def model_frame(spark, sf):
    frame = prepare.model_frame(tracks(spark, sf), _NUM, _CAT)
    return frame.withColumn("log_repeat_listens", F.round("log_repeat_listens", 9))


@query(
    "impute",
    """WITH m AS (SELECT MEDIAN(duration_sec) AS d, MEDIAN(release_year) AS y FROM tracks),
    t AS (SELECT release_type AS v FROM tracks WHERE release_type IS NOT NULL GROUP BY 1
          ORDER BY COUNT(*) DESC, 1 LIMIT 1)
    SELECT mbid, COALESCE(duration_sec, d) AS duration_sec,
        COALESCE(CAST(release_year AS DOUBLE), y) AS release_year,
        COALESCE(release_type, v) AS release_type FROM tracks, m, t""",
    T,
)
def impute(spark, sf):
    rows = tracks(spark, sf).select("mbid", "duration_sec", "release_year", "release_type")
    numeric, categorical = ["duration_sec", "release_year"], ["release_type"]
    filled = prepare.FillMissing(numericCols=numeric, categoricalCols=categorical).fit(rows)
    return filled.transform(rows).select(
        "mbid", *[F.col(c + prepare.FILLED).alias(c) for c in numeric + categorical]
    )


@query(
    "standardize",
    """SELECT mbid, ROUND((d - AVG(d) OVER ()) / STDDEV_SAMP(d) OVER (), 6) AS duration_sec,
        ROUND((g - AVG(g) OVER ()) / STDDEV_SAMP(g) OVER (), 6) AS genre_match_count
    FROM (SELECT mbid, COALESCE(duration_sec, (SELECT MEDIAN(duration_sec) FROM tracks)) AS d,
            genre_match_count AS g FROM tracks)""",
    T,
)
def standardize(spark, sf):
    rows = tracks(spark, sf).select("mbid", "duration_sec", "genre_match_count")
    stages = prepare.preprocessing(["duration_sec", "genre_match_count"], [])
    scaled = Pipeline(stages=stages).fit(rows).transform(rows)
    v = vector_to_array("features")
    return scaled.select(
        "mbid",
        F.round(v[0], 6).alias("duration_sec"),
        F.round(v[1], 6).alias("genre_match_count"),
    )


@query(
    "one_hot",
    """SELECT mbid, CAST(artist_type = 'Group' AS INT) AS is_group, 0 AS is_person
    FROM tracks WHERE artist_type = 'Group'
    UNION ALL SELECT mbid, 0, 0 FROM tracks WHERE artist_type = 'Person'""",
    T,
)
def one_hot(spark, sf):
    """Fitted on one category only: the unseen one becomes all zeros."""
    rows = tracks(spark, sf).select("mbid", "artist_type")
    fitted = Pipeline(stages=prepare.preprocessing([], ["artist_type"])).fit(
        rows.where(F.col("artist_type") == "Group")
    )
    v = vector_to_array("features")
    return fitted.transform(rows).select(
        "mbid",
        v[0].cast("int").alias("is_group"),
        F.coalesce(F.get(v, F.lit(1)).cast("int"), F.lit(0)).alias("is_person"),
    )


@query(
    "split_holdout",
    f"SELECT mbid, {_HASH} % 100 < 20 AS is_test FROM tracks",
    T,
)
def split_holdout(spark, sf):
    return splits.with_holdout(tracks(spark, sf).select("mbid"), "mbid")


@query("fold_assign", f"SELECT mbid, CAST({_HASH} % 5 AS INT) AS fold FROM tracks", T)
def fold_assign(spark, sf):
    return splits.with_fold(tracks(spark, sf).select("mbid"), "mbid")


@query(
    "split_stratified",
    f"""SELECT mbid, genre, RANK() OVER (PARTITION BY genre ORDER BY {_HASH}) - 1
        < FLOOR(COUNT(*) OVER (PARTITION BY genre) * 0.2) AS is_test FROM tracks""",
    T,
)
def split_stratified(spark, sf):
    rows = tracks(spark, sf).select("mbid", "genre")
    return splits.with_stratified_holdout(rows, "mbid", "genre")


@query(
    "class_weights",
    """WITH l AS (SELECT CASE WHEN repeat_listens > c THEN 1 ELSE 0 END AS is_high_replay
        FROM tracks, (SELECT quantile_cont(repeat_listens, 0.75) AS c FROM tracks))
    SELECT is_high_replay, COUNT(*) AS n,
        ROUND((SELECT COUNT(*) FROM l) / (2.0 * COUNT(*)), 9) AS weight
    FROM l GROUP BY is_high_replay""",
    T,
)
def class_weights(spark, sf):
    labelled = high_label(tracks(spark, sf)).withColumn(
        "is_high_replay", F.col("is_high_replay").cast("int")
    )
    return metrics.class_weights(labelled, "is_high_replay").withColumn(
        "weight", F.round("weight", 9)
    )


_GUESS_SQL = """g AS (SELECT t.*, m AS guess FROM tracks t JOIN
    (SELECT artist_name AS a, AVG(log_repeat_listens) AS m FROM tracks GROUP BY artist_name)
    ON artist_name = a)"""


def _guessed(spark, sf, rows=None):
    """Items with a simple prediction: the mean target of their artist."""
    rows = tracks(spark, sf) if rows is None else rows
    means = rows.groupBy(F.col("artist_name").alias("_a")).agg(
        F.avg("log_repeat_listens").alias("guess")
    )
    return rows.join(means, F.col("artist_name") == F.col("_a")).drop("_a")


@query(
    "regression_metrics",
    f"""WITH {_GUESS_SQL} SELECT genre, COUNT(*) AS n,
        ROUND(SQRT(AVG((guess - log_repeat_listens) ** 2)), 6) AS rmse,
        ROUND(AVG(ABS(guess - log_repeat_listens)), 6) AS mae,
        ROUND(1 - SUM((guess - log_repeat_listens) ** 2)
            / (VAR_POP(log_repeat_listens) * COUNT(*)), 6) AS r2
    FROM g GROUP BY genre""",
    T,
)
def regression_metrics(spark, sf):
    out = metrics.regression_metrics(_guessed(spark, sf), "log_repeat_listens", "guess", ["genre"])
    return out.select("genre", "n", *[F.round(c, 6).alias(c) for c in ("rmse", "mae", "r2")])


@query(
    "classification_metrics",
    f"""WITH {_GUESS_SQL}, x AS (SELECT CASE WHEN repeat_listens > c THEN 1 ELSE 0 END AS y,
            ROUND(guess / 10, 9) AS s
          FROM g, (SELECT quantile_cont(repeat_listens, 0.75) AS c FROM tracks)),
    r AS (SELECT *, RANK() OVER (ORDER BY s) + (COUNT(*) OVER (PARTITION BY s) - 1) / 2.0 AS rk
          FROM x)
    SELECT COUNT(*) AS n, ROUND(AVG(CASE WHEN (s > 0.65) = (y = 1) THEN 1.0 ELSE 0 END), 6)
            AS accuracy,
        ROUND(2.0 * COUNT(*) FILTER (y = 1 AND s > 0.65) / (2 * COUNT(*) FILTER (y = 1 AND s > 0.65)
            + COUNT(*) FILTER (y = 0 AND s > 0.65) + COUNT(*) FILTER (y = 1 AND NOT s > 0.65)), 6)
            AS f1,
        ROUND((SUM(rk) FILTER (y = 1) - SUM(y) * (SUM(y) + 1) / 2)
            / (SUM(y) * COUNT(*) FILTER (y = 0)), 6) AS roc_auc
    FROM r""",
    T,
)
def classification_metrics(spark, sf):
    scored = _guessed(spark, sf, high_label(tracks(spark, sf))).select(
        "is_high_replay", F.round(F.col("guess") / 10, 9).alias("s")
    )
    rows = stage_table(scored, "scored")
    out = metrics.classification_metrics(rows, "is_high_replay", "s", 0.65)
    return out.select("n", *[F.round(c, 6).alias(c) for c in ("accuracy", "f1", "roc_auc")])


_STUDIED: dict[tuple, object] = {}


def _once(spark, sf, what, make):
    """What ``make`` gives, once for an application and a state of the input files."""
    at = (spark.sparkContext.applicationId, *state_of(spark, sf, "lineitem", "orders", "part"), what)
    if at not in _STUDIED:
        _STUDIED[at] = make()
    return _STUDIED[at]


def _frame(spark, sf):
    """Model rows with holdout and folds on the features that the coverage gate chooses."""

    def make():
        rows = tracks(spark, sf)
        numeric, categorical, _ = prepare.choose_features(rows, CFG)
        numeric, categorical = existing(numeric, rows.columns), existing(categorical, rows.columns)
        frame = splits.with_holdout(prepare.model_frame(rows, numeric, categorical), "mbid")
        return stage_table(splits.with_fold(frame, "mbid", 5), "study-frame"), numeric, categorical

    return _once(spark, sf, "frame", make)


def _moments(spark, sf):
    return _once(spark, sf, "moments", lambda: moments.Moments(*_frame(spark, sf), TARGET))


def _linear(spark, sf):
    return _once(spark, sf, "linear", lambda: moments.linear_results(_moments(spark, sf)))


def _trees(spark, sf):
    return _once(spark, sf, "trees", lambda: models.TreeStudy(_moments(spark, sf)))


def _tree(spark, sf, name):
    """The fit of a tree model on all of the training rows."""
    _, numeric, categorical = _frame(spark, sf)

    def make():
        return _trees(spark, sf).fit(models.line_up(numeric, categorical)[name].getStages()[-1])

    return _once(spark, sf, name, make)


def _tree_result(spark, sf, name):
    """Its result row: cross-validated in five folds, and held out."""
    _, numeric, categorical = _frame(spark, sf)

    def make():
        model = models.line_up(numeric, categorical)[name].getStages()[-1]
        row, _ = _trees(spark, sf).evaluate(name, model, lambda: _tree(spark, sf, name))
        return stage_table(row, "model-result")

    return _once(spark, sf, ("result", name), make)


def _results(spark, sf):
    _trees(spark, sf).stage()
    trees = _side_by_side(spark, sf, _tree_result)
    return reduce(DataFrame.unionByName, trees, _linear(spark, sf)[0])


def _fits(spark, sf):
    linear = _linear(spark, sf)[1]
    _trees(spark, sf).rows(moments.ALL)
    return {**linear, **dict(zip(_TREES, _side_by_side(spark, sf, _tree)))}


def _side_by_side(spark, sf, make):
    """``make`` for each tree model at once: a round of boosting is too short a job to keep a cluster busy."""
    one = inheritable_thread_target(spark)(lambda name: make(spark, sf, name))
    with ThreadPoolExecutor(len(_TREES)) as pool:
        return list(pool.map(one, _TREES))


_TREES = ("Random Forest", "Gradient Boosting")


@query("pca_summary")
def pca_summary(spark, sf):
    return models.pca_summary(_linear(spark, sf)[1]["PCA + Ridge"])


@query("fit_linear")
def fit_linear(spark, sf):
    return _linear(spark, sf)[0]


@query("fit_forest")
def fit_forest(spark, sf):
    return _tree_result(spark, sf, "Random Forest")


@query("fit_gbt")
def fit_gbt(spark, sf):
    return _tree_result(spark, sf, "Gradient Boosting")


@query("model_results")
def model_results(spark, sf):
    """The compared models, best held-out score first."""
    return _results(spark, sf).orderBy(F.desc("test_r2"), "model")


@query("importance_table")
def importance_table(spark, sf):
    frame, *columns = _frame(spark, sf)
    return models.importance_table(_fits(spark, sf), frame, *columns)


@query("importance_top")
def importance_top(spark, sf):
    frame, *columns = _frame(spark, sf)
    fits = {"Random Forest": _tree(spark, sf, "Random Forest")}
    return models.importance_top(models.importance_table(fits, frame, *columns), "Random Forest")


@query("prediction_table")
def prediction_table(spark, sf):
    return models.prediction_table(_fits(spark, sf), _frame(spark, sf)[0].where("is_test"))


def _imbalance(spark, sf):
    rows = high_label(tracks(spark, sf)).withColumn(
        "is_high_replay", F.col("is_high_replay").cast("int")
    )
    split = stage_table(
        splits.with_stratified_holdout(
            rows.select("mbid", *_NUM, *_CAT, "is_high_replay"), "mbid", "is_high_replay"
        ),
        "labelled",
    )
    return models.imbalance_comparison(
        split.where(~F.col("is_test")), split.where(F.col("is_test")), _NUM, _CAT,
        "is_high_replay",
    )


@query("imbalance")
def imbalance(spark, sf):
    return _imbalance(spark, sf)
