"""Base phrases against a plain search over words; templates tolerate changed words."""

import re

from cohortloom.llm import license_index, registry

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
MIT = next(t.text for t in license_index.TEMPLATES if t.label == "mit")
TEXTS = [
    None, "", "...", "license", "MIT License", "mit  license, MIT-LICENSE; mit", "GNU general\npublic LICENSE",
    "the Apache license apache license", "cc by cc by cc", "mitlicense", "émit license mit licenseé",
    "CC BY-NC 4.0", "gnu gnu general public license general public license", "İ mit license ſ",
    "mit license " * 20_000, "license " * 50_000 + "apache license", "x " * 100_000, MIT.upper(),
    MIT.replace("software", "material"), MIT.replace("hereby", "now"), "cc" * 70_000 + " by",
    "Licensed under the Apache License, Version 2.0.", "by cc", "cc, by", "A" * 10 + "\x00mit\x7flicense",
]


def plain(text):
    words = [w for w in WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))]
    places = []
    for phrase, label in license_index.BASE.items():
        wanted = phrase.split()
        places += [
            (i, label) for i in range(len(words)) if words[i : i + len(wanted)] == wanted
        ]
    starts = [i for i, _ in places]
    return (
        len(words), len(places), min(starts, default=None), max(starts, default=None),
        ",".join(sorted({x for _, x in places})),
    )


def test_query_matches_plain_search(spark, tmp_path):
    rows = [(i, t, "z") for i, t in enumerate(TEXTS)] + [(4, "MIT License", "z"), (None, "cc by", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, labels string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    found = registry.op5_license_index(spark, str(tmp_path)).collect()
    got = sorted((tuple(r)[:6] for r in found), key=repr)
    assert got == sorted(((i, *plain(t)) for i, t, _ in rows), key=repr)
    for r in found:
        assert set(r.base_labels.split(",")) - {""} <= set(r.labels.split(","))
        assert 0.0 <= r.score <= 1.0 and (r.score > 0) == (r.labels != "")
    labels = {r.doc_id: r.labels for r in found}
    assert labels[11] == "cc-by,cc-by-nc"
    assert labels[TEXTS.index(MIT.upper())] == "mit"
    # Changed words cost score, changed key phrases the label.
    assert labels[18] == "mit" and labels[19] == ""
    score = {r.doc_id: r.score for r in found}
    assert license_index.MIN_SCORE <= score[18] < 1.0


def test_spans_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a MIT license")], "doc_id long, text string")
    (row,) = license_index.scan_licenses(df).collect()
    assert [tuple(s) for s in row.spans] == [("mit", 1, 2, 1.0, True)]
    assert license_index.scan_licenses(df.where("doc_id = 2")).collect() == []


def test_frequencies_cover_all_documents(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "text string").repartition(5)
    found = license_index.document_frequencies(df, [b"license", b"mit", b"cc"])
    assert found[b""] == len(TEXTS)
    words = [set(license_index.words_of(t or "")) for t in TEXTS]
    assert found[b"license"] == sum(b"license" in w for w in words)
