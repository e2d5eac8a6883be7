"""Divergence of sources within a language: terms ranked by cells of equal counts."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.llm.shared import arrow_rows, filled, map_arrow, written_table
from cohortloom.operators.scale import maybe_broadcast

#: Documents of a language that a kept term stands in, and terms that are reported for a group.
MIN_DOCUMENTS, TOP_TERMS = 30, 50
#: Steps of a share, and what is added to every count.
UNITS, ADDED = 1_000_000_000, 5
#: Distinct terms that a task counts before it passes them on, and rows of a batch of them; bytes
#: of a text counted at once.
HELD_TERMS, HELD_ROWS, SLICE_BYTES = 400_000, 1 << 14, 4 << 20
#: Numbers of a table of sums that a task keeps before it passes them on.
HELD_SUMS = 1 << 20
# Fixed value: letters of ASCII and all bytes of other characters, after A-Z are lower-cased.
_TERM = re.compile(rb"[a-z\x80-\xff]+")


def _slices(text: bytes):
    """The text in pieces of bounded size that break no term (a longer term stays whole)."""
    at = 0
    while len(text) - at > SLICE_BYTES:
        gap = re.compile(rb"[^A-Za-z\x80-\xff]").search(text, at + SLICE_BYTES)
        to = gap.end() if gap else len(text)
        yield text[at:to]
        at = to
    yield text[at:]


def term_counts(df: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of every term in every group.

    Terms are runs of letters of ASCII and of all characters beyond it, with A-Z lower-cased.
    Nulls are ''. A group also has one row of term '' with n and docs 0, so that groups without
    terms are there. Tasks count terms before anything is shuffled.
    """
    rows = df.select(filled(lang).alias("lang"), filled(source).alias("source"), filled(text).cast("binary").alias("text"))

    def run(batches):
        groups: dict[tuple, tuple[Counter, Counter]] = {}

        def flush():
            for group, (n, docs) in groups.items():
                terms, counts, within = [b"", *n], [0, *n.values()], [0, *map(docs.__getitem__, n)]
                for at in range(0, len(terms), HELD_ROWS):
                    own = terms[at : at + HELD_ROWS]
                    cells = [pa.repeat(pa.scalar(name, pa.string()), len(own)) for name in group]
                    cells += [pa.array(own, pa.binary())]
                    cells += [pa.array(x[at : at + HELD_ROWS], pa.int64()) for x in (counts, within)]
                    yield pa.RecordBatch.from_arrays(cells, names=["lang", "source", "term", "n", "docs"])
            groups.clear()

        for batch in batches:
            for *group, text in zip(*(c.to_pylist() for c in batch.columns)):
                n, docs = groups.setdefault(tuple(group), (Counter(), Counter()))
                seen: set[bytes] = set()
                for piece in _slices(text):
                    terms = _TERM.findall(piece.lower())
                    n.update(terms)
                    seen.update(terms)
                docs.update(seen)
            if sum(len(n) for n, _ in groups.values()) > HELD_TERMS:
                yield from flush()
        yield from flush()

    found = map_arrow(rows, run, "lang string, source string, term binary, n long, docs long")
    named = found.withColumn("term", F.col("term").cast("string"))
    return named.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(UNITS * (count + ADDED) / (total + ADDED * terms)), exact for any counts."""
    above = (count + ADDED).cast("decimal(20,0)") * F.lit(UNITS).cast("decimal(10,0)")
    below = (total + ADDED * terms).cast("decimal(20,0)")
    return F.call_function("div", above, below) + 1


def audit(
    df: DataFrame, text: str = "text", lang: str = "lang", source: str = "source",
    min_documents: int = MIN_DOCUMENTS, top: int = TOP_TERMS,
) -> DataFrame:
    """How far sources of a language differ, and by which terms (lang, source, part, item, value, rank).

    A language keeps the terms that stand in ``min_documents`` of its documents or more. Every
    (lang, source) group and every language gives each kept term a ``share``. Part ``pair``
    lists all other sources of the language with the differences of shares summed over kept
    terms (0 without kept terms). Part ``term`` lists the ``top`` terms of the group whose share
    exceeds that of the language, by how much. Ranks go down by value, then up by the item's
    bytes. Nulls are '' throughout; repeated rows are documents each; an empty table gives no rows.

    Terms with the same count in the group and in the language have the same value: it is
    computed once for each such cell. Cells of equal value are merged and ranked, their
    multiplicities summed until ``top`` terms are reached, and only the cells up to there are
    expanded to terms. So the ranking sorts cells, at most ``top`` of a group, and not terms.
    """
    counts = written_table(term_counts(df, text, lang, source), "terms")
    kept = counts.where("term <> ''").groupBy("lang", "term").agg(
        F.sum("n").alias("n_lang"), F.sum("docs").alias("docs")
    ).where(F.col("docs") >= min_documents).drop("docs")
    kept = written_table(kept, "kept")
    found = counts.where("term <> ''").join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "n_lang")
    found = written_table(found, "kept_counts")
    languages = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("n_lang").alias("total_lang"))
    totals = found.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = counts.where("term = ''").select("lang", "source").join(languages, "lang", "left").join(
        totals, ["lang", "source"], "left"
    )
    groups = written_table(groups.na.fill(0, ["terms", "total_lang", "total"]), "groups")
    by = F.col("value").desc()
    terms = _top_terms(found, groups, top)
    pairs = _pairs(found, groups)
    ranked = pairs.withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(by, "item"))
    )
    return ranked.select("lang", "source", F.lit("pair").alias("part"), "item", "value", "rank").unionByName(terms)


def _top_terms(found: DataFrame, groups: DataFrame, top: int) -> DataFrame:
    group = ["lang", "source"]
    cells = found.groupBy(*group, "n", "n_lang").agg(F.count(F.lit(1)).alias("many"))
    own = share(F.col("n"), F.col("total"), F.col("terms"))
    whole = share(F.col("n_lang"), F.col("total_lang"), F.col("terms"))
    valued = cells.join(maybe_broadcast(groups), group).select(*group, "n", "n_lang", "many", (own - whole).alias("value"))
    valued = written_table(valued.where("value > 0"), "cells")
    merged = valued.groupBy(*group, "value").agg(F.sum("many").alias("many"))
    order = Window.partitionBy(*group).orderBy(F.col("value").desc())
    # Every value has a term or more, so that the first ``top`` values are enough.
    first = merged.withColumn("place", F.row_number().over(order)).where(F.col("place") <= top)
    before = F.sum("many").over(order.rowsBetween(Window.unboundedPreceding, -1))
    reached = first.withColumn("before", F.coalesce(before, F.lit(0))).where(F.col("before") < top)
    chosen = valued.join(maybe_broadcast(reached.select(*group, "value", "before")), [*group, "value"])
    chosen = written_table(chosen.select(*group, "n", "n_lang", "value", "before"), "chosen")
    expanded = found.join(maybe_broadcast(chosen), [*group, "n", "n_lang"])
    inside = F.row_number().over(Window.partitionBy(*group, "value").orderBy("term"))
    placed = expanded.withColumn("inside", inside).where(F.col("inside") <= top)
    rank = (F.col("before") + F.col("inside")).cast("int")
    return placed.select(
        *group, F.lit("term").alias("part"), F.col("term").alias("item"), "value", rank.alias("rank")
    ).where(F.col("rank") <= top)


def _pairs(found: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value): every ordered pair of sources of a language.

    The shares of a term in all sources of its language form a row; tasks sum differences over
    many rows, with shares of count 0 where a source lacks the term, and pass on tables of sums.
    """
    place = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    zero = F.when(F.col("terms") > 0, share(F.lit(0), F.col("total"), F.col("terms"))).otherwise(0)
    placed = written_table(groups.withColumn("place", place).withColumn("zero", zero), "placed")
    own = share(F.col("n"), F.col("total"), F.col("terms"))
    valued = found.join(maybe_broadcast(placed), ["lang", "source"]).select("lang", "term", "place", own.alias("share"))
    rows = valued.groupBy("lang", "term").agg(F.collect_list(F.struct("place", "share")).alias("held"))
    zeros = placed.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("place", "zero"))).alias("zeros"))
    rows = rows.join(maybe_broadcast(zeros), "lang").select(
        "lang", F.col("held.place").alias("place"), F.col("held.share").alias("share"), F.col("zeros.zero").alias("zero")
    )

    def run(batches):
        def summed():
            held: dict[str, np.ndarray] = {}

            def flush():
                for lang, sums in held.items():
                    for i, row in enumerate(sums.tolist()):
                        yield lang, i, row
                held.clear()

            for batch in batches:
                frame = batch.to_pandas()
                for lang, own in frame.groupby("lang", sort=False):
                    zero = np.array(own["zero"].iloc[0], np.int64)
                    shares = np.tile(zero, (len(own), 1))
                    row = np.repeat(np.arange(len(own)), own["place"].str.len().to_numpy())
                    shares[row, np.concatenate(own["place"].to_numpy())] = np.concatenate(own["share"].to_numpy())
                    sums = held.setdefault(lang, np.zeros((len(zero), len(zero)), np.int64))
                    for i in range(len(zero)):
                        sums[i] += np.abs(shares - shares[:, i : i + 1]).sum(axis=0)
                if sum(s.size for s in held.values()) > HELD_SUMS:
                    yield from flush()
            yield from flush()

        yield from arrow_rows({"lang": pa.string(), "place": pa.int32(), "sums": pa.list_(pa.int64())}, summed(), 256)

    sums = map_arrow(rows, run, "lang string, place int, sums array<long>")
    values = sums.select("lang", "place", F.posexplode("sums").alias("other", "value")).groupBy(
        "lang", "place", "other"
    ).agg(F.sum("value").alias("value"))
    names = placed.select("lang", "source", "place")
    both = names.join(names.select("lang", F.col("source").alias("item"), F.col("place").alias("other")), "lang")
    both = both.where("place <> other").join(values, ["lang", "place", "other"], "left")
    return both.select("lang", "source", "item", F.coalesce("value", F.lit(0)).cast("long").alias("value"))


def oracle_sql(min_documents: int = MIN_DOCUMENTS, top: int = TOP_TERMS) -> str:
    """The same result in DuckDB's SQL, term by term and without cells."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

    def p(count: str, total: str) -> str:
        return f"CAST(1 + (CAST({UNITS} AS HUGEINT) * ({count} + {ADDED})) // ({total} + {ADDED} * v) AS BIGINT)"

    return f"""
    WITH d AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
      regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'),
        '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents),
    g AS (SELECT DISTINCT lang, source FROM d),
    f AS (SELECT lang, term FROM (SELECT lang, unnest(list_distinct(w)) AS term FROM d)
      GROUP BY lang, term HAVING count(*) >= {min_documents}),
    t AS (SELECT lang, source, term, count(*) AS n FROM (SELECT lang, source, unnest(w) AS term FROM d)
      GROUP BY lang, source, term),
    k AS (SELECT t.* FROM t JOIN f USING (lang, term)),
    kl AS (SELECT lang, term, CAST(sum(n) AS BIGINT) AS n FROM k GROUP BY lang, term),
    l AS (SELECT lang, count(*) AS v, CAST(sum(n) AS BIGINT) AS total FROM kl GROUP BY lang),
    gt AS (SELECT g.lang, g.source, coalesce(sum(n), 0) AS total FROM g LEFT JOIN k USING (lang, source) GROUP BY ALL),
    a AS (SELECT gt.lang, gt.source, kl.term, coalesce(k.n, 0) AS n, {p("coalesce(k.n, 0)", "gt.total")} AS p,
        {p("kl.n", "l.total")} AS q
      FROM gt JOIN l USING (lang) JOIN kl USING (lang) LEFT JOIN k USING (lang, source, term)),
    pairs AS (SELECT x.lang, x.source, y.source AS item, coalesce(s.value, 0) AS value
      FROM g x JOIN g y ON x.lang = y.lang AND x.source <> y.source
      LEFT JOIN (SELECT m.lang, m.source, o.source AS item, sum(abs(m.p - o.p)) AS value
        FROM a m JOIN a o ON m.lang = o.lang AND m.term = o.term AND m.source <> o.source GROUP BY ALL) s
      ON s.lang = x.lang AND s.source = x.source AND s.item = y.source),
    terms AS (SELECT lang, source, term AS item, p - q AS value FROM a WHERE n > 0 AND p > q)
    SELECT lang, source, 'pair' AS part, item, CAST(value AS BIGINT) AS value,
      CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM pairs
    UNION ALL
    SELECT lang, source, 'term', item, CAST(value AS BIGINT), rank FROM (SELECT *,
      CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM terms)
    WHERE rank <= {top}"""
