"""Licence notices found by a positional index of their rarest words."""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.shared import arrow_rows, filled, map_arrow

# The base phrases and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}


@dataclass(frozen=True)
class Template:
    """A notice, the label it stands for, and phrases of it that a file must hold.

    A template without key phrases is a phrase: every word of it must match.
    """

    label: str
    text: str
    keys: tuple[str, ...] = ()


# Sentences by which the licences name themselves.
TEMPLATES = (
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this "
        "software and associated documentation files the software to deal in the software "
        "without restriction",
        ("permission is hereby granted", "without restriction"),
    ),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are "
        "permitted provided that the following conditions are met",
        ("redistribution and use in source and binary forms",),
    ),
    Template(
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or "
        "without fee is hereby granted",
        ("for any purpose with or without fee",),
    ),
    Template(
        "apache-2.0",
        "licensed under the apache license version 2 0",
        ("apache license version 2 0",),
    ),
    Template(
        "gpl-3.0",
        "licensed under the gnu general public license version 3",
        ("general public license version 3",),
    ),
    Template(
        "gpl-2.0",
        "licensed under the gnu general public license version 2",
        ("general public license version 2",),
    ),
    Template("lgpl", "gnu lesser general public license"),
    Template("agpl", "gnu affero general public license"),
    Template("mpl", "mozilla public license"),
    Template("cc-by-nc", "cc by nc"),
    Template("cc-by-sa", "cc by sa"),
    Template("cc-by", "creative commons attribution"),
    Template(
        "unlicense",
        "this is free and unencumbered software released into the public domain",
        ("free and unencumbered software",),
    ),
)
#: Share of a template's word weight that an alignment must reach.
MIN_SCORE = 0.7
#: Rarest words of a template whose places may propose an alignment.
ANCHORS = 3

_WORD_BYTES = bytes(
    (b | 32 if 65 <= b <= 90 else b) if 48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128
    else 32
    for b in range(256)
)


def words_of(text: str) -> list[bytes]:
    """Lower-cased (A to Z only) runs of digits, letters and non-ASCII characters."""
    return text.encode().translate(_WORD_BYTES).split()


def document_frequencies(df: DataFrame, vocabulary: Sequence[bytes], text: str = "text") -> dict:
    """Documents that hold each word, over all documents; as many rows as the vocabulary has."""
    known = frozenset(vocabulary)

    def run(batches):
        found: dict[bytes, int] = defaultdict(int)
        n = 0
        for batch in batches:
            for cell in batch[0].to_pylist():
                n += 1
                for word in known.intersection(words_of(cell)):
                    found[word] += 1
        yield from arrow_rows(
            {"word": pa.binary(), "n": pa.int64()}, iter([*found.items(), (b"", n)])
        )

    counted = map_arrow(df.select(filled(text).alias("text")), run, "word binary, n long")
    return {bytes(r.word): r.n for r in counted.groupBy("word").agg(F.sum("n").alias("n")).collect()}


@dataclass
class Index:
    """Postings of the templates' words, and each template's words from the rarest on."""

    templates: list[tuple[str, list[bytes], list[tuple[int, list[bytes]]], bool]]
    weight: dict[bytes, float]
    postings: dict[bytes, list[tuple[int, int]]] = field(default_factory=dict)

    def __post_init__(self):
        postings = defaultdict(list)
        for t, (_, words, keys, _) in enumerate(self.templates):
            rare = sorted(range(len(words)), key=lambda p: (-self.weight[words[p]], p))
            # A phrase needs all of its words, so its rarest one finds every place.
            for p in rare[: ANCHORS if keys else 1]:
                postings[words[p]].append((t, p))
        self.postings = dict(postings)

    def scan(self, words: list[bytes]) -> list[tuple[int, int, float]]:
        """(template, start, score) of every alignment that verifies, in order."""
        present = self.postings.keys() & words if len(words) > 1 else ()
        if not present:
            return []
        starts: dict[int, set[int]] = defaultdict(set)
        for i, word in enumerate(words):
            if word in present:
                for t, p in self.postings[word]:
                    starts[t].add(i - p)
        return sorted(
            (t, s, score)
            for t, own in starts.items()
            for s in own
            if (score := self.verified(words, t, s)) is not None
        )

    def verified(self, words: list[bytes], t: int, start: int) -> float | None:
        _, wanted, keys, _ = self.templates[t]
        if not keys:
            return 1.0 if start >= 0 and words[start : start + len(wanted)] == wanted else None
        for at, key in keys:
            if start + at < 0 or words[start + at : start + at + len(key)] != key:
                return None
        weights = [self.weight[w] for w in wanted]
        same = sum(
            x
            for p, (w, x) in enumerate(zip(wanted, weights))
            if 0 <= start + p < len(words) and words[start + p] == w
        )
        score = min(1.0, same / sum(weights))
        return score if score >= MIN_SCORE else None


def build_index(
    frequencies: Mapping[bytes, int],
    base: Mapping[str, str] = BASE,
    templates: Sequence[Template] = TEMPLATES,
) -> Index:
    """Index over base phrases and templates, weighted by the corpus' inverse frequencies."""
    n = frequencies.get(b"", 0)
    entries = [(label, words_of(phrase), [], True) for phrase, label in base.items()]
    for template in templates:
        words = words_of(template.text)
        keys = []
        for phrase in map(words_of, template.keys):
            at = next(
                (i for i in range(len(words)) if words[i : i + len(phrase)] == phrase), None
            )
            if at is None:
                raise ValueError(f"a key phrase of {template.label} isn't in its text")
            keys.append((at, phrase))
        entries.append((template.label, words, keys, False))
    weight = {
        w: math.log((n + 1) / (frequencies.get(w, 0) + 0.5)) + 1e-6
        for _, words, _, _ in entries
        for w in words
    }
    return Index(entries, weight)


def vocabulary(
    base: Mapping[str, str] = BASE, templates: Sequence[Template] = TEMPLATES
) -> list[bytes]:
    texts = [*base, *(t.text for t in templates)]
    return sorted({w for text in texts for w in words_of(text)})


def scan_licenses(
    df: DataFrame,
    base: Mapping[str, str] = BASE,
    templates: Sequence[Template] = TEMPLATES,
    text: str = "text",
    key: str = "doc_id",
) -> DataFrame:
    """Licence notices of every text (key, n_words and what was found).

    ``spans`` lists every alignment: label, first word, number of words, score, and whether
    it is a base phrase. ``n_base``, ``first_word`` and ``last_word`` count base phrases only,
    overlapping and repeated places included; the last two are null without any. Labels are
    distinct and sorted, '' without any. ``score`` is the best alignment's, 0 without any.
    A null text is empty. Repeated rows each give a row. The table is read twice: for the
    frequencies, of which the driver sees one number for each template word, and for the scan.
    """
    index = build_index(document_frequencies(df, vocabulary(base, templates), text), base, templates)
    span = "struct<label:string,first:bigint,words:bigint,score:double,base:boolean>"
    span_type = pa.struct(
        [("label", pa.string()), ("first", pa.int64()), ("words", pa.int64()),
         ("score", pa.float64()), ("base", pa.bool_())]
    )

    def run(batches):
        for batch in batches:
            counts, spans = [], []
            for cell in batch["text"].to_pylist():
                words = words_of(cell)
                counts.append(len(words))
                spans.append(
                    [
                        {"label": e[0], "first": s, "words": len(e[1]), "score": x, "base": e[3]}
                        for t, s, x in index.scan(words)
                        for e in [index.templates[t]]
                    ]
                )
            cells = [batch["key"], pa.array(counts, pa.int64()), pa.array(spans, pa.list_(span_type))]
            yield pa.RecordBatch.from_arrays(cells, names=["key", "n_words", "spans"])

    source = df.select(F.col(key).alias("key"), filled(text).alias("text"))
    kind = source.schema["key"].dataType.simpleString()
    found = map_arrow(source, run, f"key {kind}, n_words long, spans array<{span}>")
    based = F.filter("spans", lambda s: s["base"])

    def labels(spans):
        return F.array_join(F.array_sort(F.array_distinct(spans["label"])), ",")

    return found.select(
        F.col("key").alias(key),
        "n_words",
        F.size(based).cast("long").alias("n_base"),
        F.array_min(based["first"]).alias("first_word"),
        F.array_max(based["first"]).alias("last_word"),
        labels(based).alias("base_labels"),
        labels(F.col("spans")).alias("labels"),
        F.coalesce(F.array_max(F.col("spans")["score"]), F.lit(0.0)).alias("score"),
        "spans",
    )
