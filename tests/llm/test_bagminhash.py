"""Classes against all pairs by brute force; registers agree as often as the bags do."""

import random
import re
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from cohortloom.llm import bagminhash, registry
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def bag(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return None
    size = min(5, len(words))
    return Counter(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def brute_classes(rows):
    """Smallest key of each row's class, by all pairs."""
    bags = [bag(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        x, y = bags[i], bags[j]
        if x and y:
            n, m = sum(x.values()), sum(y.values())
            if min(n, m) < 0.8 * max(n, m):
                continue
            common = sum((x & y).values())
            if common >= 0.8 * (n + m - common):
                parent[root(i)] = root(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[root(i)] = min(key, least.get(root(i), key))
    return [least.get(root(i)) for i in range(len(rows))]


def corpus(seed=3):
    rng = random.Random(seed)
    free = lambda n: [f"w{rng.randrange(5000)}" for _ in range(n)]

    def edited(words, n):
        words = list(words)
        for i in rng.sample(range(len(words)), n):
            words[i] = f"new{rng.randrange(10**9)}"
        return words

    texts = [None, "", " \n", "one", "ONE", "one two", "a b c d e", "A b  c\td e", "\x00 \x1c", "é é é é é é"]
    texts += ["go " * n for n in (50, 52, 60, 80, 2_000, 2_400, 3_000)]
    first = free(300)
    texts += [" ".join(edited(first, n)) for n in (0, 0, 1, 2, 3, 4, 5, 6, 8, 12, 20)]
    # Copies that are near the first text and less near each other.
    texts += [" ".join(edited(first, 5)) for _ in range(25)]
    chain = free(200)
    for _ in range(8):
        texts.append(" ".join(chain))
        chain = chain[6:] + free(6)
    texts += [" ".join(free(rng.randrange(1, 80))) for _ in range(30)] + [" ".join(first + free(60)), texts[17] + " tail"]
    rng.shuffle(texts)
    return texts


def test_classes_against_all_pairs(spark):
    rows = [(7 * i % 1009, t) for i, t in enumerate(corpus())]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, bag string").repartition(3)
    found = {r.doc_id: r.class_id for r in bagminhash.classes(df).collect()}
    assert found == {key: c for (key, _), c in zip(rows, brute_classes(rows))}
    kept = bagminhash.keep_one(df)
    assert kept.columns == df.columns
    alone = {key for key, t in rows if bag(t) is None}
    assert {r.doc_id for r in kept.collect()} == {c for c in found.values()} | alone


def test_query_on_whole_table(spark):
    sf_dir = "/root/testdata/sf0.001"
    table = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    found = {r.doc_id: r.class_id for r in registry.op4_bagminhash(spark, sf_dir).collect()}
    assert found == {key: c for (key, _), c in zip(table, brute_classes(table))}
    assert len(set(found.values())) < len(found)


def test_null_and_repeated_keys_and_empty_table(spark):
    text = " ".join(f"w{i}" for i in range(30))
    df = spark.createDataFrame([(None, text), (4, text), (4, text), (9, text + " x"), (None, None), (5, ""), (5, "")], "doc_id long, text string")
    rows = bagminhash.classes(df).collect()
    assert sorted(str(r.class_id) for r in rows) == ["4", "4", "4", "4", "5", "5", "None"]
    kept = sorted((r.doc_id or 0, r.text or "") for r in bagminhash.keep_one(df).collect())
    assert kept == [(0, ""), (4, text), (5, ""), (5, "")]
    assert bagminhash.classes(df.where("doc_id = 99")).collect() == []
    assert bagminhash.keep_one(df.where("doc_id = 99")).collect() == []


@pytest.mark.parametrize("weights", [(1, 1), (1, 3), (5, 8), (40, 64)])
def test_registers_are_unbiased(weights):
    rng = np.random.default_rng(9)
    estimates, shares = [], []
    for _ in range(60):
        prints = rng.integers(0, 2**63, 60, dtype=np.uint64)
        prints.sort()
        a = np.full(60, weights[0])
        b = np.where(rng.random(60) < 0.5, weights[1], weights[0])
        gone = rng.random(60) < 0.2
        doc = np.concatenate([np.zeros(60, int), np.ones((~gone).sum(), int)])
        signed = bagminhash.signatures(doc, np.append(prints, prints[~gone]), np.append(a, b[~gone]), 2)
        assert np.isfinite(signed).all()
        estimates.append((signed[0] == signed[1]).mean())
        b = np.where(gone, 0, b)
        shares.append(np.minimum(a, b).sum() / np.maximum(a, b).sum())
    assert abs(np.mean(estimates) - np.mean(shares)) < 0.02


def test_sketch_agreement(spark):
    texts = [" ".join(f"w{i}" for i in range(200)), " ".join(f"w{i}" for i in range(190)), "other words " * 40]
    signed = {r.k: r for r in bagminhash.sign(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "k long, text string")).collect()}
    df = spark.createDataFrame([(signed[0].sketch, signed[i].sketch) for i in range(3)], "a array<long>, b array<long>")
    same = [r[0] for r in df.select(bagminhash.agreement(df.a, df.b)).collect()]
    assert same[0] == 1.0 and 0.8 < same[1] < 1.0 and same[2] < 0.1


def test_pairs_across_classes_come_once(spark):
    shared = {"p": [1, 2, 3, 5], "q": [2, 3, 5], "r": [3, 5, 9], "s": [9], "t": [4]}
    label = {"p": "p", "q": "q", "r": "q", "s": "s", "t": "t"}
    rows = [(band, bag.encode(), 7, label[bag].encode()) for bag, bands in shared.items() for band in bands]
    buckets = spark.createDataFrame(rows, "band long, bag binary, degree long, label binary").repartition(3)
    cells = spark.createDataFrame([(bag.encode(), bag != "s") for bag in shared], "bag binary, fits boolean")
    allowed = lambda one, other: F.col(f"{one}.fits") | F.col(f"{other}.fits")
    found = sorted((r.a.decode(), r.b.decode()) for r in bagminhash.across(buckets, cells, allowed).collect())
    assert found == [("q", "p"), ("r", "p"), ("s", "r")]
    neither = lambda one, other: F.col(f"{one}.fits") & F.col(f"{other}.fits")
    assert bagminhash.across(buckets, cells, neither).count() == 2
