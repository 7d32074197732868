"""Model input: feature choice, imputing, scaling, one-hot coding."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.feature import (
    PCA,
    OneHotEncoder,
    StandardScaler,
    StringIndexer,
    VectorAssembler,
)
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.config import DEFAULT_FEATURES, FeatureConfig
from encore.functions import lenient
from encore.operators.order import column_quantiles
from encore.operators.profile import coverage, existing, observed_columns


def choose_features(
    df: DataFrame, cfg: FeatureConfig = DEFAULT_FEATURES
) -> tuple[list[str], list[str], dict]:
    """Numeric and categorical names; optional ones only above the coverage threshold.

    Reads one coverage number. Columns without any value are left out.
    """
    share = 0.0
    if cfg.coverage_flag in df.columns:
        share = coverage(df, cfg.coverage_flag).first()["coverage"]
    numeric, categorical = list(cfg.numeric), list(cfg.categorical)
    wide = share >= cfg.coverage_threshold
    if wide:
        numeric += cfg.optional_numeric
        categorical += cfg.optional_categorical
    seen = set(observed_columns(df, numeric + categorical))
    context = {
        "audio_coverage": share,
        "use_audio_features": wide,
        "audio_threshold": cfg.coverage_threshold,
    }
    return (
        [c for c in numeric if c in seen],
        [c for c in categorical if c in seen],
        context,
    )


def model_frame(
    df: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str],
    target: str = DEFAULT_FEATURES.target,
    meta: Sequence[str] = ("mbid", "title", "artist_name", "genre"),
) -> DataFrame:
    """Needed columns only, numbers as double, rows with a target."""
    keep = existing([*meta, *numeric, *categorical, target], df.columns)
    numbers = set(existing([*numeric, target], df.columns))
    typed = [lenient(c, "double").alias(c) if c in numbers else F.col(c) for c in keep]
    return df.select(*typed).where(F.col(target).isNotNull())


def column_modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column, mode)``: the most frequent value, the smallest on ties; counted, not buffered."""
    long = df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot(
        [], list(columns), "column", "value"
    )
    counts = long.where(F.col("value").isNotNull()).groupBy("column", "value").agg(
        F.count("*").alias("n")
    )
    return counts.groupBy("column").agg(
        F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("mode")
    )


# Filled copies keep the source columns as they are.
FILLED = "__filled"


class _FillParams(Params):
    numericCols = Param(Params._dummy(), "numericCols", "", TypeConverters.toListString)
    categoricalCols = Param(Params._dummy(), "categoricalCols", "", TypeConverters.toListString)
    medians = Param(Params._dummy(), "medians", "", TypeConverters.toListFloat)
    modes = Param(Params._dummy(), "modes", "", TypeConverters.toListString)


class FillMissing(Estimator, _FillParams, DefaultParamsReadable, DefaultParamsWritable):
    """Exact median for numbers, mode for categories; fitted inside each fold."""

    @keyword_only
    def __init__(self, *, numericCols=None, categoricalCols=None):
        super().__init__()
        self._setDefault(numericCols=[], categoricalCols=[])
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> FillMissingModel:
        numeric = self.getOrDefault(self.numericCols)
        categorical = self.getOrDefault(self.categoricalCols)
        medians = dict.fromkeys(numeric, 0.0)
        modes = dict.fromkeys(categorical, "")
        # One row per column comes back.
        if numeric:
            for r in column_quantiles(dataset, numeric, [0.5]).collect():
                medians[r["column"]] = r["q"][0]
        if categorical:
            for r in column_modes(dataset, categorical).collect():
                modes[r["column"]] = r["mode"]
        model = FillMissingModel()
        model._set(
            numericCols=numeric,
            categoricalCols=categorical,
            medians=list(medians.values()),
            modes=list(modes.values()),
        )
        return model


class FillMissingModel(Model, _FillParams, DefaultParamsReadable, DefaultParamsWritable):
    def _transform(self, dataset: DataFrame) -> DataFrame:
        fills = {
            f"{c}{FILLED}": F.coalesce(F.col(c).cast("double"), F.lit(v))
            for c, v in zip(self.getOrDefault(self.numericCols), self.getOrDefault(self.medians))
        }
        fills.update(
            {
                f"{c}{FILLED}": F.coalesce(F.col(c).cast("string"), F.lit(v))
                for c, v in zip(
                    self.getOrDefault(self.categoricalCols), self.getOrDefault(self.modes)
                )
            }
        )
        return dataset.withColumns(fills) if fills else dataset


class _ShareParams(Params):
    inputCol = Param(Params._dummy(), "inputCol", "", TypeConverters.toString)
    outputCol = Param(Params._dummy(), "outputCol", "", TypeConverters.toString)
    share = Param(Params._dummy(), "share", "", TypeConverters.toFloat)


class VarianceSharePCA(Estimator, _ShareParams, DefaultParamsReadable, DefaultParamsWritable):
    """PCA keeping the fewest components that explain ``share`` of the variance."""

    @keyword_only
    def __init__(self, *, inputCol="features", outputCol="components", share=0.95):
        super().__init__()
        self._setDefault(inputCol="features", outputCol="components", share=0.95)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame):
        source, out = self.getOrDefault(self.inputCol), self.getOrDefault(self.outputCol)
        width = len(dataset.select(source).first()[0])
        full = PCA(k=width, inputCol=source, outputCol=out).fit(dataset)
        explained = full.explainedVariance.toArray()
        total, k = 0.0, 0
        while k < width and total < self.getOrDefault(self.share) - 1e-12:
            total += float(explained[k])
            k += 1
        return PCA(k=max(k, 1), inputCol=source, outputCol=out).fit(dataset)


def preprocessing(
    numeric: Sequence[str], categorical: Sequence[str], scale: bool = True
) -> list:
    """Stages ending in ``features``. An unseen category becomes all zeros: it takes the extra
    index, and the encoder drops exactly that slot."""
    numeric, categorical = list(numeric), list(categorical)
    stages: list = [FillMissing(numericCols=numeric, categoricalCols=categorical)]
    parts = []
    if numeric:
        stages.append(VectorAssembler(inputCols=[c + FILLED for c in numeric], outputCol="num"))
        parts.append("num")
        if scale:
            stages.append(
                StandardScaler(inputCol="num", outputCol="num_scaled", withMean=True, withStd=True)
            )
            parts = ["num_scaled"]
    if categorical:
        indexed = [f"{c}__index" for c in categorical]
        hot = [f"{c}__hot" for c in categorical]
        stages += [
            StringIndexer(
                inputCols=[c + FILLED for c in categorical],
                outputCols=indexed,
                handleInvalid="keep",
                stringOrderType="alphabetAsc",
            ),
            OneHotEncoder(inputCols=indexed, outputCols=hot, dropLast=True),
        ]
        parts += hot
    return [*stages, VectorAssembler(inputCols=parts, outputCol="features")]


def pipeline(estimator, numeric, categorical, scale: bool = True) -> Pipeline:
    return Pipeline(stages=[*preprocessing(numeric, categorical, scale), estimator])


def pca_pipeline(estimator, numeric, categorical, share: float = 0.95) -> Pipeline:
    """``estimator`` must read ``components``."""
    reduce = VarianceSharePCA(inputCol="features", outputCol="components", share=share)
    return Pipeline(stages=[*preprocessing(numeric, categorical, True), reduce, estimator])
