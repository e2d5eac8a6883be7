"""Codes, errors and codebooks against a loop over all entries in Python's integers."""

import hashlib
import math
import random

import numpy as np
import pytest
from cohortloom.llm import ball_codes, registry


def brute(rows, parts=16, entries=64, rounds=2):
    """Rows (key, vector, label) as (key, code, error, label_error, digest)."""
    kept = [r for r in rows if r[1] and all(x is not None and math.isfinite(x) for x in r[1])]
    # Rows of one key stand in the order of their vectors.
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    kept = [(k, [math.floor(256 * x) for x in v], label) for k, v, label in kept]
    if not kept:
        return []
    width = len(kept[0][1]) // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, v, _ in kept]
    books = [[list(c[p]) for c in cut[:entries]] for p in range(parts)]

    def nearest(p, x):
        distances = [sum((a - b) ** 2 for a, b in zip(x, e)) for e in books[p]]
        return min(range(len(distances)), key=lambda i: (distances[i], i)), min(distances)

    for _ in range(rounds):
        codes = [[nearest(p, c[p])[0] for p in range(parts)] for c in cut]
        for p in range(parts):
            for e in range(len(books[p])):
                own = [c[p] for c, code in zip(cut, codes) if code[p] == e]
                if own:
                    books[p][e] = [sum(x) // len(own) for x in zip(*own)]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    found = [[nearest(p, c[p]) for p in range(parts)] for c in cut]
    errors = [sum(d for _, d in f) for f in found]
    total = {}
    for (_, _, label), error in zip(kept, errors):
        total[label] = total.get(label, 0) + error
    return [
        (k, "".join(f"{e:02x}" for e, _ in f), error, total[label], digest)
        for (k, _, label), f, error in zip(kept, found, errors)
    ]


def check(spark, rows, tmp_path):
    df = spark.createDataFrame(
        [(*r, 1, "x") for r in rows],
        "vec_id long, embedding array<float>, label int, error int, code string",
    ).repartition(5)
    df.write.parquet(f"{tmp_path}/embeddings.parquet")
    got = [tuple(r) for r in registry.op11_ball_codes(spark, str(tmp_path)).collect()]
    order = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted(got, key=order) == sorted(brute(rows), key=order)
    return got


def floats(rng, n, scale=1.0):
    return [float(np.float32(rng.gauss(0, scale))) for _ in range(n)]


@pytest.mark.parametrize("n, width, scale", [(400, 32, 1.0), (30, 16, 1.0), (300, 64, 0.01), (200, 16, 3e5)])
def test_against_all_entries(spark, tmp_path, n, width, scale):
    rng = random.Random(n)
    rows = [(rng.randrange(1000), floats(rng, width, scale), rng.choice([None, 0, 1, 2])) for _ in range(n)]
    check(spark, rows, tmp_path)


def test_ties_repeats_nulls_and_odd_values(spark, tmp_path):
    rng = random.Random(3)
    few = [[float(rng.randrange(-1, 2)) / 4 for _ in range(16)] for _ in range(40)]
    rows = [(i, few[rng.randrange(40)], i % 3 or None) for i in range(200)]
    rows += [(None, few[0], None), (3, few[1], 5), (3, few[1], 5), (3, few[2], 5)]
    rows += [(900, None, 1), (901, [None, *few[0][1:]], 1), (902, [math.nan, *few[0][1:]], 1)]
    rows += [(-5, [math.inf, *few[0][1:]], 1), (-6, [-math.inf, *few[0][1:]], 1), (904, [-0.0, *few[0][1:]], 1)]
    got = check(spark, rows, tmp_path)
    assert len(got) == 205


def test_no_usable_row_and_odd_lengths(spark, tmp_path):
    assert check(spark, [(1, None, 1), (2, [], 1)], tmp_path) == []
    df = spark.createDataFrame([(2, [1.0] * 15, 1), (3, [0.5] * 16, 1), (4, [0.5] * 32, 1)], "vec_id long, embedding array<double>, label int")
    found = ball_codes.compress(df)
    assert [(r.key, r.error) for r in found.rows.collect()] == [(3, 0)]


def test_blocks_and_partial_sums(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ball_codes, "BLOCK_VALUES", 500)
    rng = random.Random(9)
    check(spark, [(i, floats(rng, 32), i % 2) for i in range(300)], tmp_path)


def test_balls_leave_out_entries():
    """Far clusters: members of a ball are compared with none of the far entries."""
    rng = np.random.default_rng(1)
    centres = rng.integers(-10_000, 10_000, (64, 4))
    x = (centres[rng.integers(0, 64, 3000)] + rng.integers(-5, 6, (3000, 4))).reshape(3000, 1, 4).astype(np.float64)
    books = [centres.tolist()]
    code, _ = ball_codes.assign(x, books, np.zeros((3000, 1), np.int64))
    seen = []
    squared = ball_codes._squared

    def counted(a, b):
        seen.append(len(a) * len(b))
        return squared(a, b)

    ball_codes._squared = counted
    try:
        again, _ = ball_codes.assign(x, books, code)
    finally:
        ball_codes._squared = squared
    assert (again == code).all() and sum(seen) == 64 * 64
