import hashlib
import itertools
import math
import random
from fractions import Fraction

import pytest
from conftest import rows
from cohortloom.operators import hypothesis as hy
from cohortloom.plans import jobs

random.seed(5)
PAIRS = [
    (i, random.choice([0, 1, 2, 3, 4]), random.choice([0, 1, 2, 3, 4, 5]) if i % 17 else None)
    for i in range(700)
]


@pytest.fixture(scope="module")
def pairs(spark):
    return spark.createDataFrame(PAIRS, "entity_id long, actual int, predicted int")


@pytest.fixture(scope="module")
def complete(pairs):
    return pairs.dropna()


def brute_permutation(data, n, seed):
    pool = [(f"a{i}", x) for i, x, _ in data if x is not None]
    n_x = len(pool)
    pool += [(f"p{i}", y) for i, _, y in data if y is not None]
    n_y, values = len(pool) - n_x, [v for _, v in pool]

    def gap(order):
        return abs(sum(order[:n_x]) * n_y - sum(order[n_x:]) * n_x)

    above = 0
    for k in range(n):
        key = {r: (hashlib.md5(f"{seed}|{k}|{r}".encode()).hexdigest(), r) for r, _ in pool}
        above += gap([v for _, v in sorted(pool, key=lambda p: key[p[0]])]) > gap(values)
    return above


def test_permutation_matches_brute_force(pairs):
    got = hy.permutation_test(pairs, 150, "7", "order").head()
    assert (got.n_x, got.n_y, got.n_permutations) == (700, 658, 150)
    assert got.n_above == brute_permutation(PAIRS, 150, "7")
    assert got.p_value == got.n_above / 150


def test_permutation_p_inside(spark):
    data = [(i, i * 7 % 10, (i * 3 + 1) % 10 + (i % 9 == 0)) for i in range(300)]
    df = spark.createDataFrame(data, "entity_id long, actual int, predicted int")
    got = hy.permutation_test(df.repartition(6), 200, "1", "order").head()
    assert 0 < got.p_value < 1
    assert got.n_above == brute_permutation(data, 200, "1")
    assert tuple(got) == tuple(hy.permutation_test(df.coalesce(1), 200, "1", "order").head())


def test_permutation_zone_is_checked(pairs, monkeypatch):
    monkeypatch.setattr(hy, "ZONE_SIGMAS", 0.01)
    with pytest.raises(Exception, match="split point"):
        hy.permutation_test(pairs, 50, method="order").collect()


@pytest.mark.parametrize("factor", [1.0, 1e-12, 1e10, 1e-300, 1e300])
@pytest.mark.parametrize("method", ["order", "draws"])
def test_permutation_takes_any_doubles(spark, factor, method):
    rng = random.Random(8)
    data = [(i, factor * rng.gauss(2, 1), factor * rng.gauss(2.1, 1) if i % 3 else None) for i in range(200)]
    df = spark.createDataFrame(data, "entity_id long, actual double, predicted double")
    got = hy.permutation_test(df, 120, "3", method).head()
    exact = [(i, Fraction(x), None if y is None else Fraction(y)) for i, x, y in data]
    if method == "order":
        assert got.n_above == brute_permutation(exact, 120, "3")
    assert 0 < got.p_value < 1 and (got.n_x, got.n_y) == (200, 133)
    y = [p for _, _, p in data if p is not None]
    assert got.statistic == pytest.approx(abs(sum(x for _, x, _ in data) / 200 - sum(y) / 133), rel=1e-9)


def enumerated(x, y):
    """p over all splits of the pool, by exact sums."""
    pool = [Fraction(v) for v in x + y]
    total, n_x = sum(pool), len(x)
    gap = lambda s: abs(s * len(y) - (total - s) * n_x)
    seen = gap(sum(pool[:n_x]))
    splits = [sum(c) for c in itertools.combinations(pool, n_x)]
    return sum(gap(s) > seen for s in splits) / len(splits)


@pytest.mark.parametrize("x, y", [
    ([1, 1, 2, 2, 5, 5], [1, 2, 3, 3, 3, 4, 4]), ([0.1, 0.2, 0.3, 1e-12], [0.15, 0.25, 7.5]),
    ([1e10, 2e10, 1.5e10], [1e10, 3e10, 1e10, 1e10]), ([2, 2, 2], [2, 2]), ([-1e-12, 3e-12], [1e-12, 1e-12, 2e-12]),
])
def test_draws_against_all_splits(spark, monkeypatch, x, y):
    data = [(i, a, None) for i, a in enumerate(map(float, x))] + [(i + 50, None, b) for i, b in enumerate(map(float, y))]
    df = spark.createDataFrame(data, "entity_id long, actual double, predicted double")
    p, n = enumerated(x, y), 4_000
    for per_bucket in (50_000, 2):
        monkeypatch.setattr(hy, "VALUES_PER_BUCKET", per_bucket)
        got = hy.permutation_test(df.repartition(3), n, "9").head()
        assert (got.n_x, got.n_y, got.n_permutations) == (len(x), len(y), n)
        assert abs(got.p_value - p) <= 5 * math.sqrt(p * (1 - p) / n)
        assert tuple(got) == tuple(hy.permutation_test(df.coalesce(1), n, "9").head())


def test_unpaired_values_count_where_they_can(spark):
    actual = spark.createDataFrame([("a", 1.25), ("b", 2.5), ("c", 3.0), ("d", 4.5)], "entity_id string, label double")
    predicted = spark.createDataFrame([("b", 2.0), ("c", 3.75), ("d", 4.0), ("e", 9.0)], "entity_id string, label double")
    found = {r.test: r for r in jobs.compare_predictions(actual, predicted, permutations=10).collect()}
    assert found["permutation"].statistic == pytest.approx(abs(11.25 / 4 - 18.75 / 4))
    assert found["wilcoxon_simple"].statistic == 2.0


def test_wald(complete):
    x = [p[1] for p in PAIRS if p[2] is not None]
    y = [p[2] for p in PAIRS if p[2] is not None]

    def mean_var(v):
        m = sum(v) / len(v)
        return m, sum((a - m) ** 2 for a in v) / (len(v) - 1) / len(v)

    (m1, v1), (m2, v2) = mean_var(x), mean_var(y)
    z = (m1 - m2) / math.sqrt(v1 + v2)
    got = hy.wald_test(complete).head()
    assert got.statistic == pytest.approx(z)
    assert got.p_value == pytest.approx(math.erfc(abs(z) / math.sqrt(2)))


def brute_ranks(data):
    diffs = [(i, x - y) for i, x, y in data if y is not None and x != y]
    order = sorted(abs(d) for _, d in diffs)
    return [(i, d, (1 if d > 0 else -1) * (order.index(abs(d)) + 1)) for i, d in diffs]


def test_ranks_and_wilcoxon(pairs, complete):
    ranks = brute_ranks(PAIRS)
    for limit in (2, 2_000_000):
        assert rows(hy.signed_ranks(pairs, limit)) == sorted(ranks, key=repr)
        got = hy.wilcoxon_simple(complete, limit).head()
        t = min(sum(r for *_, r in ranks if r > 0), -sum(r for *_, r in ranks if r < 0))
        n = len(ranks)
        assert (got.n, got.statistic) == (n, t)
        assert got.p_value == pytest.approx(2 * (1 - (t - 0.5) / (n * (n + 1) * (2 * n + 1) / 6)))


def test_wilcoxon_normal(complete):
    diffs = [x - y for _, x, y in PAIRS if y is not None and x != y]
    order = sorted(map(abs, diffs))
    mean_rank = {d: sum(i + 1 for i, o in enumerate(order) if o == d) / order.count(d) for d in set(order)}
    w = min(
        sum(mean_rank[abs(d)] for d in diffs if d > 0), sum(mean_rank[abs(d)] for d in diffs if d < 0)
    )
    n = len(diffs)
    ties = sum(order.count(d) ** 3 - order.count(d) for d in set(order))
    z = (w - n * (n + 1) / 4) / math.sqrt(n * (n + 1) * (2 * n + 1) / 24 - ties / 48)
    got = hy.wilcoxon_normal(complete).head()
    assert got.statistic == w
    assert got.z == pytest.approx(z)
    assert got.p_value == pytest.approx(math.erfc(abs(z) / math.sqrt(2)))


def test_no_differences(spark):
    df = spark.createDataFrame([(1, 2, 2)], "entity_id long, actual int, predicted int")
    assert hy.wilcoxon_simple(df).head().p_value is None
    assert hy.signed_ranks(df).count() == 0


def test_decisions(complete):
    got = {r.test: r for r in hy.test_decisions(complete, permutations=60).collect()}
    assert set(got) == {"permutation", "wald", "wilcoxon_simple", "wilcoxon_normal"}
    for r in got.values():
        assert r.decision == ("Reject H0" if r.p_value <= 0.05 else "Fail to Reject H0")
