"""Feature table: one row per entity from text, channel statistics and band power."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Imputer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.operators import metadata, pieces, recordings, spectral
from cohortloom.operators.scale import skew_join

# The default channel list, in feature order.
CHANNELS = (
    "Fp1-F7", "F7-T3", "T3-T5", "T5-O1", "Fp2-F8", "F8-T4", "T4-T6", "T6-O2", "Fp1-F3",
    "F3-C3", "C3-P3", "P3-O1", "Fp2-F4", "F4-C4", "C4-P4", "P4-O2", "Fz-Cz", "Cz-Pz",
)
METADATA_FEATURES = ("age", "female", "male", "other", "rosc", "ohca", "vfib", "ttm")


def channel_columns(measure: str, channels: Sequence[str]) -> list[str]:
    return [f"{measure}_{re.sub(r'[^0-9A-Za-z]+', '_', c)}" for c in channels]


def feature_names(
    channels: Sequence[str] = CHANNELS, bands: Mapping[str, tuple[float, float]] = spectral.BANDS
) -> list[str]:
    """Names in vector order; 8 + 6 per channel + 1 for the default bands."""
    measures = [n for m in ("mean", "std", *bands) for n in channel_columns(m, channels)]
    return [*METADATA_FEATURES, *measures, "quality"]


def feature_matrix(
    entity_text: DataFrame,
    index: DataFrame,
    samples: DataFrame,
    channels: Sequence[str] = CHANNELS,
    n_fft: int = spectral.DEFAULT_N_FFT,
    bands: Mapping[str, tuple[float, float]] = spectral.BANDS,
) -> DataFrame:
    """entity_id and the feature columns as DOUBLE; what is missing is NULL.

    ``samples`` is long (entity_id, record_id, channel, idx, value, sampling_frequency) or array
    pieces (start and samples in place of idx and value). Statistics come from all recordings
    that the index lists, band power and quality from the latest one. Samples stay where they
    are: the index's rows come to them, statistics are merged from states of the pieces, and
    only the ends of pieces move to fill whole segments.
    """
    record = ["entity_id", "record_id"]
    series = ["entity_id", "channel", "record_id", "sampling_frequency"]
    known = samples.where(F.col("channel").isin(*channels))
    if "samples" not in samples.columns:
        known = pieces.pieces_from_samples(known, series)
    latest = recordings.latest_recording(index)
    listed = index.where(F.col("record_id").isNotNull()).select(*record).distinct()
    marked = listed.join(latest.select(*record, F.lit(True).alias("is_latest")), record, "left")
    known = skew_join(known.select(*series, "start", "samples"), marked, record)
    keys = ["entity_id", "channel"]
    stats = pieces.channel_stats(pieces.states(known, keys))
    segments = pieces.segments(known.where("is_latest"), series, n_fft)
    power = spectral.band_power(segments, keys, n_fft, bands)
    by_channel = stats.join(power, keys, "left")
    spread = [
        F.max(F.when(F.col("channel") == c, F.col(measure))).alias(out)
        for measure in ("mean", "std", *bands)
        for c, out in zip(channels, channel_columns(measure, channels))
    ]
    wide = by_channel.groupBy("entity_id").agg(*spread)
    joined = (
        metadata.metadata_features(entity_text)
        .join(wide, "entity_id", "left")
        .join(latest.select("entity_id", "quality"), "entity_id", "left")
    )
    names = feature_names(channels, bands)
    return joined.select("entity_id", *[F.col(n).cast("double").alias(n) for n in names])


def usable_features(features: DataFrame, names: Sequence[str]) -> list[str]:
    """Columns holding at least one value, found in one pass; the others cannot be imputed."""
    counts = features.agg(*[F.count(F.when(~F.isnan(n), F.col(n))).alias(n) for n in names]).head()
    return [n for n in names if counts[n]]


def mean_imputer(names: Sequence[str]) -> Imputer:
    return Imputer(strategy="mean", inputCols=list(names), outputCols=[f"{n}_filled" for n in names])


def mean_impute(features: DataFrame, names: Sequence[str]) -> DataFrame:
    """Missing values replaced by column means; all-missing columns are dropped."""
    usable = usable_features(features, names)
    filled = mean_imputer(usable).fit(features).transform(features)
    return filled.select("entity_id", *[F.col(f"{n}_filled").alias(n) for n in usable])
