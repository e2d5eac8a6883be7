"""Band power by Welch's method.

Segments of n_fft samples without overlap, mean removed per segment, periodic Hamming
window, one-sided density scaled by 1/(fs * sum(w^2)), mean over segments. The last
partial segment is dropped and a series shorter than one segment gives no row. A missing
sample makes its series NULL. A segment is the unit of parallel work, so one long recording spreads over all tasks.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.functions.text import nan_to_null
from cohortloom.operators.scale import skew_join

# Band limits in hertz, both ends included.
BANDS = {"delta": (0.5, 8.0), "theta": (4.0, 8.0), "alpha": (8.0, 12.0), "beta": (12.0, 30.0)}
DEFAULT_N_FFT = 256


def segments_from_samples(
    samples: DataFrame, keys: list[str], n_fft: int = DEFAULT_N_FFT
) -> DataFrame:
    """Cut long samples (idx counts 0, 1, ...) into whole segments of n_fft values.

    Samples are shuffled by segment and sorted, and runs of n_fft rows become one row.
    """
    kept = [samples.schema[k] for k in [*keys, "sampling_frequency"]]
    values = T.StructField("segment_values", T.ArrayType(T.DoubleType()))
    schema = T.StructType([*kept, values])
    names = [f.name for f in kept]
    segment = F.floor(F.col("idx") / n_fft)
    cut = samples.select(
        *names,
        segment.alias("segment"),
        F.xxhash64(*keys, segment).alias("mark"),
        (F.col("idx") % n_fft).cast("int").alias("offset"),
        F.coalesce(F.col("value").cast("double"), F.lit(float("nan"))).alias("value"),
    )
    # The mark decides nearly every comparison; the keys keep equal marks apart.
    order = ["mark", *keys, "segment", "offset"]
    ordered = cut.repartition("mark").sortWithinPartitions(*order)
    # Only the first row of a segment carries the keys to Python.
    first_row = F.col("offset") == 0
    sent = ordered.select(
        *[F.when(first_row, F.col(n)).alias(n) for n in names], "mark", "offset", "value"
    )

    def whole_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.RecordBatch | None = None
        for batch in batches:
            table = pa.Table.from_batches([b for b in (rest, batch) if b is not None])
            joined = table.combine_chunks().to_batches()
            if not joined:
                continue
            rows = joined[0]
            mark, offset = rows["mark"].to_numpy(), rows["offset"].to_numpy()
            fresh = (mark[1:] != mark[:-1]) | (offset[1:] <= offset[:-1])
            starts = np.r_[0, np.flatnonzero(fresh) + 1]
            lengths = np.diff(np.r_[starts, len(mark)])
            # A run that is whole needs no further rows; a shorter last one may go on.
            whole = starts[lengths == n_fft]
            rest = rows.slice(starts[-1]) if lengths[-1] < n_fft else None
            if len(whole):
                picked = (whole[:, None] + np.arange(n_fft)).ravel()
                flat = pa.array(rows["value"].to_numpy()[picked])
                offsets = pa.array(np.arange(0, len(picked) + 1, n_fft, dtype=np.int32))
                first = pa.array(whole)
                columns = [rows[f.name].take(first) for f in kept]
                columns.append(pa.ListArray.from_arrays(offsets, flat))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return sent.mapInArrow(whole_runs, schema)


def segments_from_arrays(
    signals: DataFrame, keys: list[str], n_fft: int = DEFAULT_N_FFT, samples: str = "samples"
) -> DataFrame:
    """The same from array signals; rows are cut in place, without a shuffle."""
    whole = F.floor(F.size(samples) / n_fft).cast("int")
    cut = F.transform(
        F.sequence(F.lit(0), whole - 1),
        lambda i: F.slice(F.col(samples), i * n_fft + 1, n_fft).cast("array<double>"),
    )
    long_enough = signals.where(F.size(samples) >= n_fft)
    return long_enough.select(*keys, "sampling_frequency", F.explode(cut).alias("segment_values"))


def _densities(batch: pa.RecordBatch, n_fft: int) -> tuple[np.ndarray, np.ndarray]:
    """Power density (rows, bins) of a batch of segments, and the rows' frequencies."""
    x = batch["segment_values"].flatten().to_numpy(zero_copy_only=False).reshape(-1, n_fft)
    fs = batch["sampling_frequency"].to_numpy(zero_copy_only=False).astype(float)
    window = 0.54 - 0.46 * np.cos(2 * np.pi * np.arange(n_fft) / n_fft)
    spectrum = np.fft.rfft((x - x.mean(axis=1, keepdims=True)) * window, axis=1)
    power = np.abs(spectrum) ** 2 / (fs[:, None] * np.sum(window**2))
    power[:, 1 : (n_fft + 1) // 2] *= 2
    return power, fs


def _segment_rows(
    segments: DataFrame, keys: list[str], n_fft: int, names: list[str], per_segment
) -> DataFrame:
    """One row per segment: the keys and the columns ``per_segment`` computes."""
    fields = [segments.schema[k] for k in [*keys, "sampling_frequency"]]
    kind = T.ArrayType(T.DoubleType()) if names == ["psd"] else T.DoubleType()
    schema = T.StructType(fields + [T.StructField(n, kind) for n in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                kept = [batch[f.name] for f in fields]
                yield pa.RecordBatch.from_arrays(
                    kept + per_segment(*_densities(batch, n_fft)), names=schema.names
                )

    return segments.mapInArrow(run, schema)


def welch_psd(segments: DataFrame, keys: list[str], n_fft: int = DEFAULT_N_FFT) -> DataFrame:
    """Mean density per frequency bin: keys, bin, frequency, psd."""

    def lists(power: np.ndarray, fs: np.ndarray) -> list[pa.Array]:
        offsets = np.arange(0, power.size + 1, power.shape[1], dtype=np.int32)
        return [pa.ListArray.from_arrays(pa.array(offsets), pa.array(power.ravel()))]

    rows = _segment_rows(segments, keys, n_fft, ["psd"], lists)
    by_bin = rows.select(*keys, "sampling_frequency", F.posexplode("psd").alias("bin", "p"))
    return (
        by_bin.groupBy(*keys, "sampling_frequency", "bin")
        .agg(nan_to_null(F.avg("p")).alias("psd"))
        .select(
            *keys, "bin", (F.col("bin") * F.col("sampling_frequency") / n_fft).alias("frequency"),
            "psd",
        )
    )


def band_power(
    segments: DataFrame,
    keys: list[str],
    n_fft: int = DEFAULT_N_FFT,
    bands: Mapping[str, tuple[float, float]] = BANDS,
) -> DataFrame:
    """Mean density per band, one column each; NULL for a band without a bin.

    Every segment of a series has the same bins, so averaging bins inside the segment
    first leaves one small row per segment to aggregate.
    """
    limits = dict(bands)

    def means(power: np.ndarray, fs: np.ndarray) -> list[pa.Array]:
        frequency = np.arange(power.shape[1])[None, :] * fs[:, None] / n_fft
        columns = []
        for low, high in limits.values():
            inside = (frequency >= low) & (frequency <= high)
            bins = inside.sum(axis=1)
            total = np.where(inside, power, 0.0).sum(axis=1)
            columns.append(pa.array(total / np.maximum(bins, 1), mask=bins == 0))
        return columns

    rows = _segment_rows(segments, keys, n_fft, list(limits), means)
    return rows.groupBy(*keys).agg(*[nan_to_null(F.avg(b)).alias(b) for b in limits])


def latest_samples(samples: DataFrame, latest: DataFrame) -> DataFrame:
    """Only the samples of each entity's latest recording."""
    keys = ["entity_id", "record_id"]
    return skew_join(samples, latest.select(*keys), keys, "left_semi")
