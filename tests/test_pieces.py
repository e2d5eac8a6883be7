"""Pieces, chunks and states against plain loops over all samples."""

import random

import numpy as np
import pytest
from cohortloom.operators import features as ft
from cohortloom.operators import pieces as pc
from cohortloom.operators import recordings
from pyspark.sql import functions as F

KEYS = ["entity_id", "channel"]


def series(seed=1):
    rng = random.Random(seed)
    sizes = [0, 1, 5, 16, 17, 100, 333]
    return {(f"e{i}", c): [rng.randrange(-50, 50) for _ in range(rng.choice(sizes))] for i in range(6) for c in "ab"}


def cut(found, longest, seed=2):
    """Rows (entity, channel, start, samples) of pieces of any length."""
    rng, rows = random.Random(seed), []
    for (entity, channel), values in found.items():
        at = 0
        while at < len(values):
            n = rng.randrange(1, longest + 1)
            rows.append((entity, channel, at, values[at : at + n]))
            at += n
    rng.shuffle(rows)
    return rows


def frame(spark, rows, kind="long"):
    return spark.createDataFrame(rows, f"entity_id string, channel string, start long, samples array<{kind}>").repartition(4)


@pytest.mark.parametrize("longest, size", [(3, 16), (40, 16), (400, 7), (16, 1), (9, 1000)])
def test_chunks_of_any_pieces(spark, longest, size):
    found = series()
    got = {}
    for r in pc.chunks(frame(spark, cut(found, longest)), KEYS, size).collect():
        assert r.start == r.chunk * size and (r.entity_id, r.channel, r.chunk) not in got
        got[r.entity_id, r.channel, r.chunk] = r.samples
    wanted = {(*k, i // size): v[i : i + size] for k, v in found.items() for i in range(0, len(v), size)}
    assert got == wanted


def test_missing_samples_cut_a_chunk(spark):
    rows = [("e", "a", 0, [1, 2, 3]), ("e", "a", 5, [6, 7]), ("e", "a", 7, [8, 9, 10, 11]), ("e", "b", 2, []), ("e", "c", 9, None)]
    got = sorted((r.chunk, r.start, r.samples) for r in pc.chunks(frame(spark, rows), KEYS, 8).collect())
    assert got == [(0, 0, [1, 2, 3]), (0, 5, [6, 7, 8]), (1, 8, [9, 10, 11])]
    assert pc.chunks(frame(spark, rows).limit(0), KEYS, 8).collect() == []


def test_only_ends_of_pieces_move(spark):
    """One long piece and its neighbours: whole chunks don't pass the exchange."""
    rows = [("e", "a", 0, list(range(10_003))), ("e", "a", 10_003, list(range(90)))]
    parts = pc.chunks(frame(spark, rows), KEYS, 100)
    moved = []
    kept = pc._stitched

    def spied(ends, keys):
        moved.append(ends.select(F.sum(F.size("samples"))).head()[0])
        return kept(ends, keys)

    pc._stitched = spied
    try:
        assert pc.chunks(frame(spark, rows), KEYS, 100).count() == parts.count() == 101
    finally:
        pc._stitched = kept
    assert moved == [93]


@pytest.mark.parametrize("ordered", [True, False])
def test_long_samples_as_pieces(spark, ordered):
    found = series(3)
    rows = [(*k, i, float(x) if x % 9 else None) for k, v in found.items() for i, x in enumerate(v)]
    if not ordered:
        random.Random(4).shuffle(rows)
    long = spark.createDataFrame(rows, "entity_id string, channel string, idx int, value double").repartition(3)
    got = {}
    for r in pc.pieces_from_samples(long, KEYS).collect():
        got.update({(r.entity_id, r.channel, r.start + i): x for i, x in enumerate(r.samples)})
    assert got == {(e, c, i): x for e, c, i, x in rows}


def test_numbered_pieces_get_their_place(spark):
    found = series(5)
    rows = sorted(cut(found, 30))
    numbered = spark.createDataFrame(
        [(e, c, i, s) for i, (e, c, _, s) in enumerate(rows)], "entity_id string, channel string, number long, samples array<long>"
    )
    got = pc.place_pieces(numbered, KEYS, "number").collect()
    assert sorted((r.entity_id, r.channel, r.start, r.samples) for r in got) == rows


def test_states_of_parts_merge_to_the_state_of_all(spark):
    rng = random.Random(6)
    found = {k: [1e6 + rng.gauss(0, 1) if i % 7 else (None if i % 2 else float("nan")) for i in range(len(v))] for k, v in series(7).items()}
    df = frame(spark, cut(found, 50), "double")
    parts = [pc.merged_states(pc.states(df.where(F.col("start") % 3 == i), KEYS), KEYS) for i in range(3)]
    merged = pc.merged_states(parts[0].unionByName(parts[1]).unionByName(parts[2]), KEYS).collect()
    assert {(r.entity_id, r.channel) for r in merged} == {k for k, v in found.items() if v}
    for r in merged:
        own = found[r.entity_id, r.channel]
        x = np.array([v for v in own if v is not None and v == v])
        assert (r.n, r.first_at, r.first) == (len(x), 0, None)
        if len(x):
            assert r.total == pytest.approx(x.sum()) and r.mean == pytest.approx(x.mean())
            assert r.m2 == pytest.approx(((x - x.mean()) ** 2).sum(), rel=1e-6, abs=1e-6)


def test_slots_that_share_a_recording(spark):
    index = spark.createDataFrame([("e", 0, "r"), ("e", 1, None), ("e", 2, "r"), ("e", 3, "none")], "entity_id string, seq int, record_id string")
    headers = spark.createDataFrame(
        [("e", "r", 64.0, 3, 0, "b", 2.0, 1), ("e", "r", 64.0, 3, 1, "a", 4.0, 0)],
        "entity_id string, record_id string, sampling_frequency double, num_samples long, position int, channel string, gain double, adc_offset long",
    )
    signals = spark.createDataFrame(
        [("e", "r", "b", 0, [1, 3]), ("e", "r", "b", 2, [5]), ("e", "r", "a", 0, [4, 8, 2])],
        "entity_id string, record_id string, channel string, start long, samples array<long>",
    )
    got = sorted(tuple(r) for r in recordings.entity_signals(index, headers, signals, 2).collect())
    one = [("a", 1, 0, 0, [1.0, 2.0]), ("a", 1, 1, 2, [0.5]), ("b", 0, 0, 0, [0.0, 1.0]), ("b", 0, 1, 2, [2.0])]
    assert got == [("e", seq, "r", *x) for seq in (0, 2) for x in one]
    slots = sorted(tuple(r) for r in recordings.entity_recordings(index, headers).collect())
    assert slots == [("e", 0, "r", 64.0, ["b", "a"], 3), ("e", 1, None, None, None, None),
                     ("e", 2, "r", 64.0, ["b", "a"], 3), ("e", 3, "none", None, None, None)]


def test_features_move_no_samples(spark):
    text = spark.createDataFrame([("e", "Age: 3")], "entity_id string, text string")
    index = spark.createDataFrame([("e", 0, "r", 0.0, 1.0)], "entity_id string, seq int, record_id string, hour double, quality double")
    signals = spark.createDataFrame(
        [("e", "r", "Cz-Pz", 64.0, 0, [float(i % 5) for i in range(1024)])],
        "entity_id string, record_id string, channel string, sampling_frequency double, start long, samples array<double>",
    )
    got = ft.feature_matrix(text, index, signals).head()
    assert got.mean_Cz_Pz == pytest.approx(np.mean([i % 5 for i in range(1024)])) and got.delta_Cz_Pz > 0
