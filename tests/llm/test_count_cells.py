"""Ranks against a loop over all terms in Python's integers, and against the SQL."""

import random
import re
from collections import Counter

import parity
import pytest
from cohortloom.llm import count_cells, registry

TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def brute(rows, least, top):
    def terms(text):
        return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]

    docs = [(lang or "", source or "", terms(text)) for text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        within = Counter(t for _, _, words in own for t in set(words))
        kept = sorted(t for t, n in within.items() if n >= least)
        counts = {}
        for _, source, words in own:
            counts.setdefault(source, Counter()).update(words)
        everything = sum(counts.values(), Counter())

        def shares(found):
            total = sum(found[t] for t in kept)
            return {t: 1 + 10**9 * (found[t] + 5) // (total + 5 * len(kept)) for t in kept}

        q = shares(everything)
        p = {s: shares(found) for s, found in counts.items()}
        for s in p:
            pairs = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode()) for o in p if o != s]
            over = [(q[t] - p[s][t], t.encode()) for t in kept if counts[s][t] > 0 and p[s][t] > q[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(over)[:top])):
                out += [(lang, s, part, i.decode(), -v, r) for r, (v, i) in enumerate(found, 1)]
    return sorted(out)


def corpus(seed):
    rng = random.Random(seed)
    words = [f"w{chr(97 + i)}" for i in range(26)] + ["É", "é", "漢字", "WA", "ﬁ", "ÀB", "𝒳"]
    rows = [(None, None, None), ("", "en", "empty"), ("123 !!", "en", None), ("a" * 9_000, "long", "s1")]
    for _ in range(150):
        some = words[: rng.randrange(2, len(words))]
        text = rng.choice([" ", "-", "_1"]).join(rng.choices(some, k=rng.randrange(0, 40)))
        rows.append((text, rng.choice(["en", "fr", None, ""]), rng.choice(["s1", "s2", "S2", "é", None])))
    return rows + rows[-20:]


@pytest.mark.parametrize("seed, least, top", [(1, 5, 50), (2, 1, 3), (3, 30, 10), (4, 10**6, 50)])
def test_against_all_terms(spark, monkeypatch, seed, least, top):
    monkeypatch.setattr(count_cells, "HELD_TERMS", 20)
    monkeypatch.setattr(count_cells, "SLICE_BYTES", 50)
    monkeypatch.setattr(count_cells, "HELD_SUMS", 2)
    rows = corpus(seed)
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "text string, lang string, source string, rank int, term string")
    got = count_cells.audit(df.repartition(4), min_documents=least, top=top).collect()
    assert sorted(tuple(r) for r in got) == brute(rows, least, top)
    assert got and count_cells.audit(df.limit(0)).collect() == []


def test_many_terms_of_one_value(spark):
    """A cell with far more terms than are asked for, cut in the order of their bytes."""
    names = [chr(97 + i // 26) + chr(97 + i % 26) for i in range(500)]
    rows = [(" ".join(names), "en", "a"), ("zz " * 2_000, "en", "b")]
    df = spark.createDataFrame(rows, "text string, lang string, source string")
    got = [tuple(r) for r in count_cells.audit(df, min_documents=1).collect()]
    assert sorted(got) == brute(rows, 1, 50)


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_query_matches_sql(spark, size):
    sf_dir = f"/root/testdata/{size}"
    df = registry.op12_count_cells(spark, sf_dir)
    assert df.where("part = 'term'").count() > 0
    assert parity.difference(df, parity.connect(sf_dir), registry.oracle_sql()["op12_count_cells"]) is None
