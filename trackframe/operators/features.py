"""Respondent features: within-wave weight normalisation, NPS segment, top-box flag.

Every feature is row-local or computed within one wave, so processing one
wave alone gives the same rows as processing all waves together; this is what
makes incremental runs safe.

Weight normalisation divides each weight by its wave's mean weight. A
window over the wave would send every row of a wave through one task; the
per-wave means are aggregated instead (partial aggregation, one small row per
wave per task) and joined back. The join carries no hint: the means are a few rows,
which AQE sees at run time and broadcasts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from trackframe.config import TrackerConfig
from trackframe.functions.expressions import nps_segment, top_box

WEIGHT_NORM = "weight_norm"


def _norm(weight: Column, mean: Column) -> Column:
    # A null or zero wave mean normalises every row of that wave to 1.0.
    return F.when(mean.isNull() | (mean == 0), F.lit(1.0)).otherwise(weight / mean)


def wave_weight_means(df: DataFrame, wave_col: str = "wave", weight_col: str = "weight") -> DataFrame:
    """One row per wave (null wave included): ``(__wave, __wave_mean)``."""
    return df.groupBy(F.col(wave_col).alias("__wave")).agg(F.avg(weight_col).alias("__wave_mean"))


def normalise_weights(
    df: DataFrame,
    *,
    wave_col: str = "wave",
    weight_col: str = "weight",
    out_col: str = WEIGHT_NORM,
    means: DataFrame | None = None,
) -> DataFrame:
    """Add ``weight / mean(weight within the wave)``; nothing runs until the result is used.

    The mean skips null weights; a null weight gives a null norm unless its
    wave's mean is null or zero, in which case every row of the wave gets 1.0.

    ``df``'s plan is evaluated twice (for the means only its wave and weight
    columns): give it a scan of stored or staged data, as the runs do, where its plan is expensive, or the
    ``means`` (``__wave``, ``__wave_mean``) if they are known (``wave_means`` of a metric state).
    """
    if means is None:
        means = wave_weight_means(df, wave_col, weight_col)
    joined = df.join(means, F.col(wave_col).eqNullSafe(F.col("__wave")), "left")
    return joined.select(*df.columns, _norm(F.col(weight_col), F.col("__wave_mean")).alias(out_col))


def row_features(df: DataFrame, config: TrackerConfig | None = None) -> DataFrame:
    """Attach the features that need nothing but their row: ``nps_segment`` and ``top2box``."""
    config = config or TrackerConfig()
    return df.select(
        "*",
        nps_segment(F.col("nps_score"), config.promoter_min, config.detractor_max).alias("nps_segment"),
        top_box(F.col("satisfaction"), config.top2box_min).alias("top2box"),
    )


def add_features(df: DataFrame, config: TrackerConfig | None = None, *, means: DataFrame | None = None) -> DataFrame:
    """Attach ``weight_norm`` (from ``means`` if given), ``nps_segment`` and ``top2box``."""
    return row_features(normalise_weights(df, means=means), config)
