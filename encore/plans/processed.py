"""The processed table, from raw records to labelled features."""

from __future__ import annotations

from pyspark.sql import DataFrame

from encore.config import AUDIO_SIGNALS, DEFAULT_FEATURES, UNKNOWN, FeatureConfig
from encore.operators.order import with_codes
from encore.operators.prepare import (
    canonical,
    collapse_records,
    with_audio,
    with_dates,
    with_interactions,
    with_target,
)
from encore.operators.stats import high_label, winsorize
from encore.session import stage_table


def build_processed(
    raw: DataFrame,
    popularity: DataFrame,
    audio: DataFrame | None = None,
    cfg: FeatureConfig = DEFAULT_FEATURES,
    stage: bool = True,
) -> DataFrame:
    """Collapse, join, derive, label, clip, encode.

    Collapsing leaves the rows hashed by id, so both joins reuse that exchange. Interactions use
    values before clipping. The joined rows are staged once in the shared folder (``stage``)
    because the quantile, level and label passes each read them again.
    """
    joined = with_audio(collapse_records(raw).join(popularity, "mbid", "left"), audio)
    features = with_interactions(with_dates(with_target(joined), cfg))
    if stage:
        features = stage_table(features, "joined-records")
    # Each statistic reads only its own columns of the staged rows.
    labelled = high_label(features)
    clipped = winsorize(labelled, [*AUDIO_SIGNALS, "duration_sec"])
    return canonical(with_codes(clipped, cfg.all_categorical, filler=UNKNOWN), cfg)
