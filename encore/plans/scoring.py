"""Batch scoring of hypothetical profiles and of existing items."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.config import AUDIO_SIGNALS, DEFAULT_FEATURES, TARGET, FeatureConfig
from encore.functions import null_column
from encore.operators.order import group_median
from encore.operators.stats import share_at_or_below
from encore.session import stage_table


def back_transform(prediction: Column) -> Column:
    """Log prediction to a repeat count, never below zero."""
    return F.greatest(F.expm1(prediction), F.lit(0.0))


def complete_profiles(
    profiles: DataFrame, use_audio: str = "use_audio", cfg: FeatureConfig = DEFAULT_FEATURES
) -> DataFrame:
    """Derived inputs for profiles given by year, duration, career age and optional audio.

    Without audio its values are null, the flag is 0 and four are missing; the tempo product is
    then 0 here, although training rows keep null.
    """
    on = F.col(use_audio)
    year, age = F.col("release_year"), F.col("artist_career_age")
    with_signals = profiles.withColumns(
        {c: F.when(on, F.col(c)).otherwise(null_column("double")) for c in AUDIO_SIGNALS}
    )
    return with_signals.withColumns(
        {
            "release_decade": (F.floor(year / 10) * 10).cast("double"),
            "track_age": (F.lit(cfg.as_of_year) - year).cast("double"),
            "has_audio_features": F.when(on, 1.0).otherwise(0.0),
            "audio_feature_missing_count": F.when(on, 0.0).otherwise(4.0),
            "career_x_duration_min": (age * F.col("duration_sec") / 60).cast("double"),
            "tempo_x_dance": F.coalesce(F.col("tempo") * F.col("danceability"), F.lit(0.0)),
        }
    )


def explain_scores(
    scored: DataFrame,
    reference: DataFrame,
    prediction: str = "prediction",
    category: str = "genre",
    target: str = TARGET,
) -> DataFrame:
    """Add the predicted count, the percentile among reference targets and the category median."""
    ranked = share_at_or_below(scored, prediction, reference, target, "percentile")
    medians = group_median(reference, target, [category], "category_median").withColumnRenamed(
        category, "_c"
    )
    medians = stage_table(medians, "category-medians")  # of measured size when the join is planned
    return ranked.join(medians, F.col(category).eqNullSafe(F.col("_c")), "left").drop("_c").withColumn(
        "predicted_repeats", back_transform(F.col(prediction))
    )


def score_profiles(
    model: PipelineModel, profiles: DataFrame, reference: DataFrame, **kw
) -> DataFrame:
    inputs = complete_profiles(profiles)
    scored = model.transform(inputs).select(*inputs.columns, "prediction")
    return explain_scores(scored, reference, **kw)


def residuals(scored: DataFrame, prediction: str = "prediction", target: str = TARGET) -> DataFrame:
    """Signed gap on the log scale and on which side of the truth the model lands."""
    gap = F.col(prediction) - F.col(target)
    return scored.withColumn("residual", gap).withColumn(
        "direction", F.when(gap > 0, F.lit("above")).when(gap.isNotNull(), F.lit("below"))
    )


def score_items(scored: DataFrame, reference: DataFrame, prediction: str = "prediction", **kw):
    return residuals(explain_scores(scored, reference, prediction, **kw), prediction)
