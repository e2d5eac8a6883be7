import cmath
import math

import pytest
from cohortloom.operators import spectral
from pyspark.sql import functions as F

FS, N = 64.0, 16


def brute_psd(x):
    """Definition written out: per segment, then the mean."""
    w = [0.54 - 0.46 * math.cos(2 * math.pi * j / N) for j in range(N)]
    segments = [x[i : i + N] for i in range(0, len(x) - N + 1, N)]
    out = []
    for k in range(N // 2 + 1):
        total = 0.0
        for s in segments:
            m = sum(s) / N
            z = sum((s[j] - m) * w[j] * cmath.exp(-2j * math.pi * k * j / N) for j in range(N))
            total += abs(z) ** 2 * (1 if k in (0, N // 2) else 2) / (FS * sum(v * v for v in w))
        out.append(total / len(segments))
    return out


SERIES = {
    "tone": [3 * math.sin(2 * math.pi * 8 * i / FS) for i in range(80)],
    "odd": [((i * 37) % 11) / 3 + i / 50 for i in range(45)],
    "short": [1.0] * 10,
}


@pytest.fixture(scope="module")
def arrays(spark):
    data = [(k, FS, v) for k, v in SERIES.items()] + [("none", FS, [])]
    return spark.createDataFrame(
        data, "entity_id string, sampling_frequency double, samples array<double>"
    )


def test_psd_matches_definition(arrays):
    long = arrays.select("entity_id", "sampling_frequency", F.posexplode("samples").alias("idx", "value"))
    for segments in (
        spectral.segments_from_arrays(arrays, ["entity_id"], N),
        spectral.segments_from_samples(long.repartition(5), ["entity_id"], N),
    ):
        got = spectral.welch_psd(segments, ["entity_id"], N).collect()
        assert {r.entity_id for r in got} == {"tone", "odd"}
        for r in got:
            assert r.psd == pytest.approx(brute_psd(SERIES[r.entity_id])[r.bin], abs=1e-12)
            assert r.frequency == r.bin * FS / N
        tone = {r.bin: r.psd for r in got if r.entity_id == "tone"}
        assert max(tone, key=tone.get) == 2  # 8 Hz


def test_band_power_includes_both_limits(arrays):
    segments = spectral.segments_from_arrays(arrays, ["entity_id"], N)
    bands = {**spectral.BANDS, "empty": (4.5, 7.5)}
    got = {r.entity_id: r for r in spectral.band_power(segments, ["entity_id"], N, bands).collect()}
    psd = brute_psd(SERIES["odd"])  # bins at 0, 4, 8, ... 32 Hz
    row = got["odd"]
    assert row.delta == row.theta == pytest.approx((psd[1] + psd[2]) / 2)
    assert row.alpha == pytest.approx((psd[2] + psd[3]) / 2)
    assert row.beta == pytest.approx(sum(psd[3:8]) / 5)
    assert row.empty is None


def test_missing_sample_gives_null(spark):
    gap = spark.createDataFrame(
        [("g", FS, i, None if i == 3 else float(i)) for i in range(32)],
        "entity_id string, sampling_frequency double, idx int, value double",
    )
    segments = spectral.segments_from_samples(gap, ["entity_id"], N)
    assert spectral.band_power(segments, ["entity_id"], N).head().delta is None


def test_segments_cross_batches(spark):
    series = spark.range(0, 5000, 1, 7).selectExpr(
        "cast(id % 3 as string) as entity_id", "64.0D as sampling_frequency",
        "id div 3 as idx", "cast(id as double) as value",
    )
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        rows = spectral.segments_from_samples(series, ["entity_id"], N).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(rows) == sum(((5000 - e + 2) // 3) // N for e in range(3))
    for r in rows:
        e, v = int(r.entity_id), r.segment_values
        assert (v[0] - e) % (3 * N) == 0 and v == [v[0] + 3 * j for j in range(N)]


def test_swapped_bands_would_show(spark, data):
    """The bands of the fine query have bins of their own, and another band gives other numbers."""
    from cohortloom.plans import catalog

    df = catalog.queries()["band_power_fine"](spark, data)
    rows_ = [r for r in df.collect() if r.theta is not None]
    assert len(rows_) > 100
    for a, b in (("delta", "theta"), ("theta", "alpha"), ("alpha", "beta")):
        assert sum(r[a] != r[b] for r in rows_) > 0.99 * len(rows_)


def test_recordings_outside_the_index_are_not_features(spark):
    from cohortloom.operators import features as ft

    text = spark.createDataFrame([("e", "Age: 3\nOutcome: Good\nCPC: 1")], "entity_id string, text string")
    index = spark.createDataFrame([("e", 0, 1.0, 0.5, "r0")], "entity_id string, seq int, hour double, quality double, record_id string")
    samples = spark.createDataFrame(
        [("e", r, "Fz-Cz", i, v, 32.0) for r, v in (("r0", 1.0), ("r9", 101.0)) for i in range(8)],
        "entity_id string, record_id string, channel string, idx int, value double, sampling_frequency double",
    )
    (row,) = ft.feature_matrix(text, index, samples, ["Fz-Cz"], 4).collect()
    assert (row.mean_Fz_Cz, row.std_Fz_Cz) == (1.0, 0.0)
