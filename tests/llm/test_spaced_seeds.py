"""Planted passages are found, changed words or not; the SQL gives the same rows."""

import itertools

import parity
import pytest
from cohortloom.llm import registry, spaced_seeds

ITEM = "alpha bravo charlie delta echo foxtrot golf hotel india juliett kilo lima mike november oscar papa".split()


def found(spark, texts, items):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, seed string")
    bench = spark.createDataFrame([(i, t, "x") for i, t in enumerate(items)], "item_id long, text string, same string")
    rows = spaced_seeds.overlaps(docs, bench)
    return docs, bench, sorted((r.doc_id, r.item_id, r.best_same) for r in rows.collect())


def changed(words, *places):
    return " ".join("zulu" if i in places else w for i, w in enumerate(words))


def test_substitutions_and_awkward_texts(spark):
    texts = [
        None, "", "...", "one two", " ".join(ITEM), "so: " + ", ".join(w.upper() for w in ITEM) + "!",
        "x " * 40_000 + changed(ITEM, 5, 11), changed(ITEM, 2, 5, 8, 11, 14), " ".join(ITEM[:7]),
        " ".join(reversed(ITEM)), " ".join(ITEM[3:]) + " tail", " ".join(ITEM), "é " * 30,
        "head " + " ".join(ITEM[:10]) + " alpha " * 9,
    ]
    docs, bench, rows = found(spark, texts, [" ".join(ITEM), None, "", "too short", " ".join(ITEM[:9])])
    items = {}
    for doc, item, same in rows:
        items.setdefault(doc, {})[item] = same
    assert items[4] == {0: 13, 4: 9} and items[5] == {0: 13, 4: 9} and items[11] == {0: 13, 4: 9}
    assert items[6][0] >= 11 and items[10][0] == 13 and items[13][0] == 10
    # Seven words of an item of nine count as found, as ten of thirteen do.
    assert items[8] == {4: 7}
    assert not {0, 1, 2, 3, 9, 12} & items.keys()
    kept = spaced_seeds.clean(docs, bench)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == set(range(len(texts))) - items.keys()


def brute(texts, items):
    """All alignments, without seeds."""
    out = {}
    for doc, text in enumerate(texts):
        for item, wanted in enumerate(items):
            have, want = text.split(), wanted.split()
            n = min(13, len(want))
            for shift in range(1 - len(want), len(have)):
                same = [0 <= j + shift < len(have) and have[j + shift] == w for j, w in enumerate(want)]
                best = max(sum(same[s : s + n]) for s in range(len(same) - n + 1))
                if 13 * best >= 10 * n:
                    out[doc, item] = max(best, out.get((doc, item), 0))
    return sorted((*k, v) for k, v in out.items())


def test_texts_shorter_than_the_item(spark):
    item = ITEM[:8]
    texts = [" ".join(item[:7]), " ".join(item[1:]), " ".join([*item[:7], "zulu"]), " ".join(item[:6]), " ".join(ITEM[:10])]
    rows = found(spark, texts, [" ".join(item), " ".join(ITEM[:13])])[2]
    assert rows == brute(texts, [" ".join(item), " ".join(ITEM[:13])])
    assert {(0, 0, 7), (1, 0, 7), (2, 0, 7), (4, 1, 10)} <= set(rows)


def test_every_pattern_of_exchanged_words(spark):
    items = [" ".join(f"w{n}x{i}" for i in range(n)) for n in range(1, 18)]
    texts = []
    for item in items:
        own = item.split()
        n = min(13, len(own))
        for places in itertools.combinations(range(n), n - -(-n * 10 // 13)):
            texts.append("some words before " + changed(own, *places, *range(13, len(own))) + " and then a few more")
        texts += [changed(own, *range(n // 2)) + " one two three four five six", " ".join(own[: n - 1])]
    assert found(spark, texts, items)[2] == brute(texts, items)


@pytest.mark.parametrize("window, min_same", [(13, 10), (9, 7), (6, 6), (20, 13), (5, 1)])
def test_masks_miss_no_pattern(window, min_same):
    for n in range(1, window + 1):
        same = -(-n * min_same // window)
        at = [{p + i for i, c in enumerate(m) if c == "1"} for m in spaced_seeds.family(n, window, min_same) for p in range(n - len(m) + 1)]
        assert all(any(not a & set(gone) for a in at) for gone in itertools.combinations(range(n), n - same))


def test_null_ids_and_repeated_rows(spark):
    text = " ".join(ITEM)
    docs = spark.createDataFrame([(None, text), (1, text), (1, text), (1, "clean"), (None, "clean")], "doc_id long, text string")
    bench = spark.createDataFrame([(7, text), (7, text)], "item_id long, text string")
    rows = spaced_seeds.overlaps(docs, bench).collect()
    assert sorted((r.doc_id, r.item_id) for r in rows if r.doc_id) == [(1, 7)] and len(rows) == 2
    assert sorted(r.doc_id or 0 for r in spaced_seeds.clean(docs, bench).collect()) == [0, 1]
    for a, b in ((docs.limit(0), bench), (docs, bench.limit(0))):
        assert spaced_seeds.overlaps(a, b).collect() == []
    assert spaced_seeds.clean(docs, bench.limit(0)).count() == 5


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_query_matches_sql(spark, size):
    sf_dir = f"/root/testdata/{size}"
    sql = registry.oracle_sql()["op10_spaced_seeds"]
    df = registry.op10_spaced_seeds(spark, sf_dir)
    assert df.count() > 0
    assert parity.difference(df, parity.connect(sf_dir), sql) is None


def test_no_python_in_the_plan(spark):
    df = registry.op10_spaced_seeds(spark, "/root/testdata/sf0.001")
    assert "Python" not in df._jdf.queryExecution().toString()
