"""Phrase counts against a parse by substring search, and accuracy on held-out documents."""

import random
import zlib

import numpy as np
from cohortloom.llm import cross_parse, registry


def plain_phrases(text: bytes, learned: bytes) -> int:
    count = 0
    for at in range(0, len(text), cross_parse.BLOCK):
        block, i = text[at : at + cross_parse.BLOCK], 0
        while i < len(block):
            n = 1
            while i + n < len(block) and block[i : i + n + 1] in learned:
                n += 1
            i += n
            count += 1
    return count


def test_phrases_match_substring_search():
    rng = random.Random(4)
    learned = {k: "".join(rng.choices("abcdé ", w, k=700)).encode() for k, w in
               (("x", (5, 1, 1, 1, 1, 2)), ("y", (1, 5, 1, 0, 2, 2)))}
    texts = [b"", b"a", b"zz\xff", b"ab" * 700, *("".join(rng.choices("abcdéz ", k=n)).encode() for n in (1, 511, 512, 513, 3000))]
    model = cross_parse.Model(learned)
    got = model.phrases(texts)
    assert got.tolist() == [[plain_phrases(t, learned[k]) for k in ("x", "y")] for t in texts]


def test_automaton_reads_exactly_the_substrings():
    text = b"abcbcabbabca"
    follow = cross_parse.suffix_automaton(text)

    def reads(word):
        state = 0
        for symbol in word:
            if symbol not in follow[state]:
                return False
            state = follow[state][symbol]
        return True

    words = {bytes(w) for n in range(1, 5) for w in np.ndindex(*(3,) * n)}
    for word in words:
        word = bytes(97 + x for x in word)
        assert reads(word) == (word in text)


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in registry.op7_cross_parse(spark, sf_dir).collect()}
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert len(got) == len(rows)
    kept = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert {i for i, r in got.items() if r.held_out} == {r.doc_id for r in kept}
    assert sum(got[r.doc_id].lang_pred == r.lang for r in kept) >= 0.97 * len(kept)
    assert all(0.0 <= r.score <= 1.0 for r in got.values())


def test_awkward_rows(spark, tmp_path):
    good = [(i, ("the thing of the " if i % 2 else "el nino de la ") * 9, "en" if i % 2 else "es", "q") for i in range(40)]
    odd = [(100, None, "en", "q"), (101, "", None, "q"), (102, "123 ...", "en", "q"), (103, "¡ñ", None, "q"),
           (104, "the of " * 30_000, None, "q"), (104, "the of " * 30_000, None, "q"), (None, "the thing", "en", "q"),
           (105, "漢字", None, "q")]
    df = spark.createDataFrame(good + odd, "doc_id long, text string, lang string, score string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    rows = registry.op7_cross_parse(spark, str(tmp_path)).collect()
    assert len(rows) == len(good + odd)
    pred = {r.doc_id: r.lang_pred for r in rows}
    assert [pred[i] for i in (100, 101, 102)] == ["und"] * 3
    assert pred[104] == "en" and pred[None] == "en" and pred[103] in ("en", "es") and pred[105] in ("en", "es")
    # Neither labels nor ids of the row itself matter.
    model = cross_parse.Model(cross_parse.training_texts(df, "text", "lang", "doc_id"))
    other = df.selectExpr("doc_id", "text", "'xx' as lang")
    again = {r.doc_id: r.lang_pred for r in cross_parse.predict(other, model).collect()}
    assert again == pred


def test_nothing_learned_and_empty_table(spark):
    df = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    model = cross_parse.Model(cross_parse.training_texts(df, "text", "lang", "doc_id"))
    assert [tuple(r) for r in cross_parse.predict(df, model).collect()] == [(1, "und", 0.0)]
    assert cross_parse.predict(df.where("doc_id = 2"), model).collect() == []


def test_learned_texts_are_bounded_and_from_all_over(spark):
    # One id for many long texts, and a language whose texts are short.
    long = [(7, "".join(chr(97 + (i * 7 + j // 900) % 26) for j in range(9_000)), "en") for i in range(90)]
    short = [(i, f"kort {i}", "nl") for i in range(1000, 1090)]
    df = spark.createDataFrame(long + short + long[:5] * 3, "doc_id long, text string, lang string")
    got = cross_parse.training_texts(df, "text", "lang", "doc_id", rows=8, size=1_600)
    assert 1_500 < len(got["en"]) <= 1_600
    pieces = got["en"].split(b"\n")
    # A share holds letters of the start, the middle and the end of its text.
    assert len(pieces) == 8 and all(len(set(p)) >= 4 for p in pieces)
    texts = {t.encode() for _, t, _ in short}
    assert len(got["nl"].split(b"\n")) == 8 and set(got["nl"].split(b"\n")) <= texts
    again = cross_parse.training_texts(df.repartition(5), "text", "lang", "doc_id", rows=8, size=1_600)
    assert again == got
