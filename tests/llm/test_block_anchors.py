"""Removed words against a count of all windows by a dictionary."""

import hashlib
import random
import re
from collections import Counter

import pytest
from cohortloom.llm import block_anchors, packs, registry

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(texts, width):
    split = [WORD.findall(t or "") for t in texts]
    counts = Counter(tuple(w[i : i + width]) for w in split for i in range(len(w) - width + 1))
    out = []
    for w in split:
        gone = set()
        for i in range(len(w) - width + 1):
            if counts[tuple(w[i : i + width])] > 1:
                gone.update(range(i, i + width))
        out.append((len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


def corpus(width, seed=1):
    rng = random.Random(seed)
    words = ["a", "bb", "é", "the", "x\xa0y", "\x85", "of", "42"]
    free = lambda n: [rng.choice(words) + str(rng.randrange(30)) for _ in range(n)]
    shared = [free(n) for n in (width - 1, width, width + 1, 3 * width)]
    texts = [None, "", " \t\n\x0b\x0c\r ", "one", "rep " * (3 * width), "z" * 5000]
    for _ in range(60):
        parts = []
        for _ in range(rng.randrange(1, 5)):
            parts += free(rng.randrange(2 * width)) + rng.choice([[], rng.choice(shared)])
        texts.append(rng.choice([" ", "\n", "  \t"]).join(parts))
    texts += [texts[-1], texts[-1], " ".join(shared[0]), " ".join(shared[1]), " " + " ".join(shared[3]) + "\n"]
    return texts


@pytest.mark.parametrize("width, size, entries", [(35, None, 4_000_000), (6, 900, 200), (5, 300, 50)])
def test_against_counting(spark, monkeypatch, width, size, entries):
    monkeypatch.setattr(packs, "PART_ENTRIES", entries)
    if size:
        monkeypatch.setattr(packs, "PACK_BYTES", size)
        monkeypatch.setattr(packs, "PACK_GROWTH", 0)
    texts = corpus(width)
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, pack string").repartition(4)
    rows = sorted(tuple(r) for r in block_anchors.remove_repeats(df, width).collect())
    assert rows == [(i, *x) for i, x in enumerate(plain(texts, width))]


def test_query_on_whole_table(spark):
    sf_dir = "/root/testdata/sf0.001"
    table = sorted(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())
    rows = sorted(tuple(r) for r in registry.op9_block_anchors(spark, sf_dir).collect())
    wanted = [
        (r.doc_id, n, gone, hashlib.sha256(kept.encode()).hexdigest())
        for r, (n, gone, kept) in zip(table, plain([r.text for r in table], block_anchors.WINDOW))
    ]
    assert rows == wanted and any(r[2] for r in rows)


def test_null_keys_and_empty_table(spark):
    text = " ".join(map(str, range(40)))
    df = spark.createDataFrame([(None, text), (None, text), (1, text + " tail")], "doc_id long, text string")
    rows = sorted(((r.doc_id or 0, r.n_removed, r.kept) for r in block_anchors.remove_repeats(df).collect()))
    assert rows == [(0, 40, ""), (0, 40, ""), (1, 40, "tail")]
    assert block_anchors.remove_repeats(df.where("doc_id = 9")).collect() == []
