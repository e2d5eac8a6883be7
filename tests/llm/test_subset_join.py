"""Components against a comparison of all pairs of sets."""

import random
import re

import pytest
from cohortloom.llm import hubs, packs, registry, subset_join


def shingles(text, size):
    words = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def brute(rows, size=3, percent=90):
    sets = [shingles(t, size) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, x in enumerate(sets):
        for j in range(i):
            y = sets[j]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                root[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[find(i)] = min(key, least.get(find(i), key))
    order = lambda r: (r[0] is None, r[0] or 0, r[1:])
    return sorted(((k, len(s), least.get(find(i))) for i, ((k, _), s) in enumerate(zip(rows, sets))), key=order)


def check(spark, rows, **options):
    df = spark.createDataFrame([(*r, 7, "x") for r in rows], "doc_id long, text string, n long, node string")
    got = subset_join.join(df.repartition(4), **options).collect()
    order = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted((tuple(r) for r in got), key=order) == brute(rows, **options)
    return got


def corpus(seed, sizes, n=60):
    """Texts, chains of edits of them, copies, pieces of others, and odd ones."""
    rng = random.Random(seed)
    free = lambda k: rng.choices([f"w{i}" for i in range(400)], k=k)
    common = free(40)
    texts = [None, "", " \t\n", "one", "ONE", "one two", "One\x0btwo", "a b c", "a  b c ", "b c", "É b c", "é b c"]
    for _ in range(n):
        words = free(rng.choice(sizes))
        if rng.random() < 0.3:
            words += common[: rng.randrange(40)]
        for _ in range(rng.randrange(1, 6)):
            texts.append(" ".join(words))
            words = list(words)
            for _ in range(rng.randrange(0, max(2, len(words) // 40))):
                words[rng.randrange(len(words))] = f"w{rng.randrange(400)}"
            if rng.random() < 0.4:
                words = words[: len(words) - rng.randrange(3)] or words
    rng.shuffle(texts)
    return list(enumerate(texts, 1)) + [(None, texts[-1]), (3, texts[-1]), (3, texts[-1]), (None, None)]


@pytest.mark.parametrize("seed, sizes, rounds", [(1, range(1, 30), 3), (2, range(20, 120), 1), (3, (9, 10, 11, 12, 20, 21, 22), 2)])
def test_against_all_pairs(spark, monkeypatch, seed, sizes, rounds):
    monkeypatch.setattr(packs, "PACK_BYTES", 2_000)
    monkeypatch.setattr(packs, "PACK_GROWTH", 0)
    monkeypatch.setattr(packs, "PART_ENTRIES", 500)
    monkeypatch.setattr(subset_join, "STAR_ROUNDS", rounds)
    monkeypatch.setattr(hubs, "CHUNK", 3)
    check(spark, corpus(seed, list(sizes)))


@pytest.mark.parametrize("boundary", [10, 24])
def test_every_boundary_gives_the_same(spark, monkeypatch, boundary):
    monkeypatch.setattr(subset_join, "BOUNDARIES", range(boundary, boundary + 1))
    check(spark, corpus(5, list(range(8, 40)), n=40))


@pytest.mark.parametrize("size, percent", [(1, 60), (2, 75), (5, 80), (3, 100)])
def test_other_shares_and_sizes(spark, size, percent):
    check(spark, corpus(6, list(range(2, 25)), n=40), size=size, percent=percent)


def test_large_group_of_near_copies(spark):
    """One text with a few words exchanged, hundreds of times: many pairs of copies are not linked."""
    rng = random.Random(8)
    base = [f"v{i}" for i in range(150)]
    rows = [(0, " ".join(base))]
    for i in range(1, 300):
        words = list(base)
        for _ in range(rng.randrange(1, 5)):
            words[rng.randrange(len(words))] = f"u{rng.randrange(10_000)}"
        rows.append((i, " ".join(words)))
    check(spark, rows)


def test_empty_tables_and_long_text(spark):
    df = spark.createDataFrame([(1, "x " * 300_000), (2, "x x x"), (3, None)], "doc_id long, text string")
    got = sorted(tuple(r) for r in subset_join.join(df).collect())
    assert got == [(1, 1, 1), (2, 1, 1), (3, 0, 3)]
    assert subset_join.join(df.limit(0)).collect() == []
    assert subset_join.join(df.where("text is null")).collect() == [(3, 0, 3)]


def test_query_on_whole_table(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = registry.op13_subset_join(spark, sf_dir).collect()
    assert sorted(tuple(r) for r in got) == brute(rows)
    assert any(r.component_id != r.doc_id for r in got)
