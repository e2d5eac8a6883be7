"""Suffix arrays against sorting; removed bytes against a dictionary of all strings."""

import hashlib
import random

import numpy as np
import pytest
from cohortloom.llm import packs, registry, suffix_dedup


@pytest.mark.parametrize("seed", range(12))
def test_suffix_array_against_sorting(seed):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(0, 60)) if seed else 500
    symbols = rng.integers(1, 2 + seed % 4, n)
    wanted = sorted(range(n), key=lambda i: symbols[i:].tolist())
    assert suffix_dedup.suffix_array(symbols).tolist() == wanted
    period = np.tile([2, 1, 1], 40)
    assert suffix_dedup.suffix_array(period).tolist() == sorted(range(120), key=lambda i: period[i:].tolist())


def plain(rows, length):
    seen, out = set(), []
    for key, text in rows:
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for i in range(len(data) - length + 1):
            piece = data[i : i + length]
            if piece in seen:
                gone[i : i + length] = True
            seen.add(piece)
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((key, len(data), int(gone.sum()), spans, kept))
    return out


def corpus(length, seed=2):
    rng = random.Random(seed)
    free = lambda n: "".join(rng.choices("abcdeé \n", k=n))
    shared = [free(n) for n in (length - 1, length, length + 3, 3 * length)]
    texts = [None, "", "a", "z" * (5 * length), "ab" * (4 * length), free(20 * length)]
    for _ in range(50):
        parts = []
        for _ in range(rng.randrange(1, 4)):
            parts += [free(rng.randrange(2 * length)), rng.choice(["", *shared])]
        texts.append("".join(parts))
    near = list(texts[5])
    near[len(near) // 2] = "#"
    return texts + [texts[-1], texts[-1], "".join(near), shared[0] * 2, shared[3][:-1]]


@pytest.mark.parametrize("length, mark, size, entries, hot", [
    (100, 64, None, 4_000_000, 1 << 20), (20, 11, 700, 300, 1 << 20), (20, 20, 700, 300, 1 << 20), (12, 5, 250, 60, 60),
])
def test_against_dictionary(spark, monkeypatch, length, mark, size, entries, hot):
    monkeypatch.setattr(packs, "PART_ENTRIES", entries)
    monkeypatch.setattr(suffix_dedup, "HOT_BYTES", hot)
    if size:
        monkeypatch.setattr(packs, "PACK_BYTES", size)
        monkeypatch.setattr(packs, "PACK_GROWTH", 0)
        monkeypatch.setattr(suffix_dedup, "ARRAY_BYTES", 2_000)
        monkeypatch.setattr(suffix_dedup, "MOST_STRINGS", 16)
    rows = list(enumerate(corpus(length)))
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, mark string").repartition(4)
    got = sorted(tuple(r) for r in suffix_dedup.remove_duplicates(df, length, mark).collect())
    assert [(*r[:4], bytes(r[4])) for r in got] == plain(rows, length)


@pytest.mark.parametrize("text", ["abcde" * 21, "x" * 101, "abcde" * 21 + "f", "#" + "ab" * 60])
def test_text_that_repeats_itself(spark, text):
    df = spark.createDataFrame([(5, text)], "doc_id long, text string")
    (row,) = suffix_dedup.remove_duplicates(df).collect()
    assert (5, *row[1:4], bytes(row.kept)) == plain([(5, text)], 100)[0]


@pytest.mark.parametrize("copies", [1, 2])
def test_every_period_against_dictionary(spark, copies):
    rng = random.Random(7)
    lines = ["".join(rng.choices("abcdefghij ", k=period - 1)) + "\n" for period in range(1, 101)]
    texts = [(line * 400)[: 137 + 3 * len(line)] for line in lines for _ in range(copies)]
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(tuple(r) for r in suffix_dedup.remove_duplicates(df).collect())
    assert [(*r[:4], bytes(r[4])) for r in got] == plain(rows, 100)


def test_frequent_string_meets_in_no_array(spark, monkeypatch):
    search = suffix_dedup._later_runs

    def bounded(frame, length):
        if len(frame) > 60:
            raise AssertionError("a frequent string went to one suffix array")
        return search(frame, length)

    monkeypatch.setattr(suffix_dedup, "HOT_BYTES", 2_500)
    monkeypatch.setattr(suffix_dedup, "_later_runs", bounded)
    rng = random.Random(3)
    passage = "".join(rng.choices("abcdefghij ", k=180))
    free = lambda: "".join(rng.choices("abcdefghij ", k=60))
    rows = [(i, free() + passage + free()) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(tuple(r) for r in suffix_dedup.remove_duplicates(df).collect())
    assert [(*r[:4], bytes(r[4])) for r in got] == plain(rows, 100)


def test_long_stretches_of_one_mark(spark):
    """3,600 stretches of 611 bytes are too few to be many and too long for one array."""
    rng = random.Random(4)
    run = "".join(rng.choices("abcdefghij ", k=400))
    free = lambda: "".join(rng.choices("klmnopqrst ", k=105))
    rows = [(i, free() + run + free()) for i in range(3_600)]
    stretches = [(1, 0, i, 0, 512, text.encode()) for i, text in rows]
    df = spark.createDataFrame(stretches, "mark long, key long, pack long, at long, n int, context binary")
    got = {}
    for r in suffix_dedup._sorted_out(df, 100).collect():
        got.setdefault(r.pack, set()).update(range(r.at, r.at + r.n))
    seen, wanted = set(), {}
    for i, text in rows:
        for at in range(len(text) - 99):
            if text[at : at + 100] in seen:
                wanted.setdefault(i, set()).add(at)
            seen.add(text[at : at + 100])
    assert got == wanted


def test_marks_spread_over_parts():
    rng = random.Random(5)
    text = "".join(rng.choices("abcdefghij klmnop", k=1 << 20)).encode()
    row = {"text": text, "sizes": np.array([len(text)]), "keys": [1]}
    marks = np.unique(suffix_dedup._Marked(row, 100, 64).mark)
    share = np.bincount((marks >> np.uint64(58)).astype(int), minlength=64) * 64 / len(marks)
    assert 0.5 < share.min() and share.max() < 2


def test_symbols_out_of_range_raise():
    with pytest.raises(ValueError):
        suffix_dedup.suffix_array(np.array([1, 1 << 21, 2, 3]))


def test_query_on_whole_table(spark):
    sf_dir = "/root/testdata/sf0.001"
    table = sorted(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect())
    got = sorted(tuple(r) for r in registry.op6_suffix_array(spark, sf_dir).collect())
    wanted = plain(table, suffix_dedup.LENGTH)
    assert got == [(*r[:4], hashlib.sha256(r[4]).hexdigest()) for r in wanted]
    assert any(r[2] for r in got)


def test_null_keys_repeated_rows_and_empty_table(spark):
    text = "".join(map(str, range(80)))
    df = spark.createDataFrame([(None, text), (3, text), (3, text), (1, "x" + text)], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.n_removed) for r in suffix_dedup.remove_duplicates(df).collect())
    assert got == [(0, 0), (1, len(text)), (3, len(text)), (3, len(text))]
    assert suffix_dedup.remove_duplicates(df.where("doc_id = 9")).collect() == []
