"""Benchmark decontamination by spaced seeds, in DataFrame operations only."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.shared import broadcast_texts, free_name, row_id, written_table
from cohortloom.operators.scale import maybe_broadcast

#: Aligned words that are compared, and how many of them must be equal.
WINDOW, MIN_SAME = 13, 10
#: Masks over consecutive words, 1 is hashed and 0 may be any word, for items of so many words
#: (the window, at least). Wherever 10 of 13 aligned words are
#: equal, or that share of a shorter item, one of its masks stands on equal words.
FAMILIES = {
    1: ("1",), 2: ("11",), 3: ("111",), 4: ("1111",), 5: ("1111", "11101", "11011", "10111"),
    6: ("1111", "11011"), 7: ("11011",), 8: ("111011", "11111"), 9: ("11101", "1010011"),
    10: ("111011", "11010011", "11111"), 11: ("1101011", "1110011"), 12: ("111011", "11111"),
    13: ("111011", "1100001011", "11110001"),
}


def family(size: int, window: int = WINDOW, min_same: int = MIN_SAME) -> tuple[str, ...]:
    """Masks that miss no item of ``size`` words (at most the window) that counts as found."""
    if (window, min_same) == (WINDOW, MIN_SAME):
        return FAMILIES[size]
    # Words exchanged cut the equal ones into runs, and the longest has this many at least.
    same = -(-size * min_same // window)
    return ("1" * -(-same // (size - same + 1)),)


def words(text: Column) -> Column:
    """Lower-cased words between white space and ASCII punctuation; null has none."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\s\p{Punct}]+"), "")


def bound(value: Column, body) -> Column:
    """``body`` of the value, which is computed once however often lambdas in ``body`` use it.

    Without this, neighbouring projections merge and a lambda repeats the value's expression
    for every element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def seed_hashes(tokens: Column, mask: str, number: int) -> Column:
    """Hash of the mask's words at every position; none for fewer words than the mask."""
    offsets = [i for i, m in enumerate(mask) if m == "1"]
    starts = F.size(tokens) - len(mask) + 1
    positions = F.when(starts > 0, F.sequence(F.lit(0), starts - 1)).otherwise(
        F.array().cast("array<int>")
    )
    return F.transform(
        positions, lambda p: F.xxhash64(F.lit(number), *(F.get(tokens, p + o) for o in offsets))
    )


def _seeds(df: DataFrame, keys: Sequence[str], masks: Sequence[str]) -> DataFrame:
    """A row for each mask and position: the keys, seed, and the position of its first word."""
    hashed = df.select(
        *keys,
        bound(
            words(F.col("text")),
            lambda tokens: F.struct(
                F.size(tokens).alias("n"),
                F.concat(*(seed_hashes(tokens, m, int(m, 2)) for m in masks)).alias("seeds"),
            ),
        ).alias("all"),
    )
    rows = hashed.select(
        *keys, F.col("all.n").alias("n"), F.posexplode("all.seeds").alias("at", "seed")
    )
    position, before, cases = F.col("at"), F.lit(0), None
    for mask in masks:
        size = F.greatest(F.lit(0), F.col("n") - len(mask) + 1)
        fits, inside = position < before + size, position - before
        cases = F.when(fits, inside) if cases is None else cases.when(fits, inside)
        before = before + size
    return rows.select(*keys, "seed", cases.alias("position"))


def overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    item: str = "item_id",
    masks: Sequence[str] | None = None,
    window: int = WINDOW,
    min_same: int = MIN_SAME,
) -> DataFrame:
    """Benchmark items that stand in documents, some words exchanged or not.

    Returns one row for each document and item: key, item, row_key (of key and text, also for
    null keys), best_same (equal words in the best stretch of ``window`` aligned words) and
    overlap (best_same as a share of the stretch). A document and an item are aligned where
    they share a seed, and reported if some stretch of the alignment has ``min_same`` equal
    words; an item of fewer words than the stretch is compared whole with the same share.
    Without ``masks``, every size of item has masks of which one hits each such stretch, so
    that none is missed. Null and empty texts match nothing; a text shorter than an item matches
    it if it holds that many of its words. Repeated rows give one row. The benchmark's seeds are broadcast after counting them, or joined by
    shuffle beyond the limit; aligned documents are read again, only those.
    """
    source = docs.select(F.col(key).alias("doc"), "text").withColumn(
        "row_key", row_id("doc", "text")
    )
    items = benchmark.select(F.col(item).alias("item"), "text").distinct()
    if masks is None:
        sized = items.withColumn("n", F.least(F.lit(window), F.size(words(F.col("text")))))
        sizes = [r.n for r in sized.select("n").distinct().collect() if r.n] or [window]
        parts = [_seeds(sized.where(F.col("n") == n), ["item"], family(n, window, min_same)) for n in sizes]
        seeds = functools.reduce(DataFrame.unionByName, parts)
        masks = sorted({m for n in sizes for m in family(n, window, min_same)})
    else:
        seeds = _seeds(items, ["item"], masks)
    seeds = seeds.withColumnRenamed("position", "item_position")
    found = _seeds(source.select("row_key", "text"), ["row_key"], masks)
    hits = found.join(maybe_broadcast(seeds), "seed").select(
        "row_key", "item", (F.col("position") - F.col("item_position")).alias("shift")
    )
    aligned = written_table(hits.distinct(), "alignments")

    chosen = source.join(
        maybe_broadcast(aligned.select("row_key").distinct()), "row_key", "left_semi"
    )
    tokens = chosen.distinct().select("row_key", "doc", words(F.col("text")).alias("tokens"))
    wanted = items.select("item", words(F.col("text")).alias("item_tokens"))
    pairs = tokens.join(maybe_broadcast(aligned), "row_key").join(
        broadcast_texts(wanted, items, "text"), "item"
    )

    def equal_words(stretch):
        skipped = F.least(F.lit(0), F.col("shift"))
        return F.transform(
            "item_tokens",
            lambda w, j: F.when(
                (j + skipped >= 0) & (F.get(stretch, F.greatest(F.lit(0), j + skipped)) == w), 1
            ).otherwise(0),
        )

    length = F.least(F.lit(window), F.size("item_tokens"))

    def best(same):
        return F.array_max(
            F.transform(
                F.sequence(F.lit(0), F.size(same) - length),
                lambda s: F.aggregate(F.slice(same, s + 1, length), F.lit(0), lambda a, x: a + x),
            )
        )

    stretch = F.slice("tokens", F.greatest(F.lit(0), F.col("shift")) + 1, F.size("item_tokens"))
    scored = pairs.select(
        "row_key", "doc", "item", "shift", length.alias("length"),
        bound(bound(stretch, equal_words), best).alias("same"),
    )
    needed = F.ceil(F.col("length") * min_same / window)
    return (
        scored.where(F.col("same") >= needed)
        .groupBy("row_key", "doc", "item", "length")
        .agg(F.max("same").alias("best_same"))
        .select(
            F.col("doc").alias(key),
            F.col("item").alias(item),
            "row_key",
            "best_same",
            (F.col("best_same") / F.col("length")).alias("overlap"),
        )
    )


def clean(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """The documents without any benchmark item, all columns and repeated rows kept."""
    found = written_table(overlaps(docs, benchmark, key, **options).select("row_key"), "leaks")
    name = free_name(docs, "row_key")
    marked = docs.withColumn(name, row_id(key, "text"))
    dirty = found.distinct().withColumnRenamed("row_key", name)
    return marked.join(maybe_broadcast(dirty), name, "left_anti").drop(name)


def oracle_sql(window: int = WINDOW, min_same: int = MIN_SAME) -> str:
    """The same result in DuckDB's SQL: seeds as lists of words instead of hashes."""
    sizes = {n: family(n, window, min_same) for n in range(1, window + 1)}
    masks = sorted({m for family_ in sizes.values() for m in family_})

    def seeds(table: str, key: str, of_items: bool) -> str:
        parts = []
        for number, mask in enumerate(masks):
            picked = ", ".join(f"w[p + {i}]" for i, m in enumerate(mask) if m == "1")
            own = ", ".join(str(n) for n, family_ in sizes.items() if mask in family_)
            only = f"WHERE least({window}, len(w)) IN ({own})" if of_items else ""
            parts.append(
                f"SELECT {key}, p, {number} AS mask, [{picked}] AS seed FROM "
                f"(SELECT {key}, w, unnest(range(1, greatest(1, len(w) - {len(mask)} + 2))) AS p FROM {table} {only})"
            )
        return " UNION ALL ".join(parts)

    def split(name: str, key: str, table: str) -> str:
        return (
            f"{name} AS (SELECT DISTINCT {key}, list_filter(regexp_split_to_array(lower(coalesce(text, '')), "
            f"'[ \\t\\n\\x0B\\f\\r!-/:-@\\[-`{{-~]+'), lambda x: x <> '') AS w FROM {table})"
        )

    return f"""
    WITH {split("d", "doc_id", "documents")}, {split("b", "item_id", "benchmark")},
    ds AS ({seeds("d", "doc_id", False)}), bs AS ({seeds("b", "item_id", True)}),
    aligned AS (SELECT DISTINCT doc_id, item_id, ds.p - bs.p AS shift FROM ds JOIN bs USING (mask, seed)),
    compared AS (SELECT doc_id, item_id, least({window}, len(b.w)) AS n,
      list_transform(range(1, len(b.w) + 1),
        lambda j: CASE WHEN j + shift >= 1 AND d.w[j + shift] = b.w[j] THEN 1 ELSE 0 END) AS same
      FROM aligned JOIN d USING (doc_id) JOIN b USING (item_id)),
    scored AS (SELECT doc_id, item_id, n, list_max(list_transform(range(1, len(same) - n + 2),
      lambda s: list_sum(same[s : s + n - 1]))) AS best FROM compared)
    SELECT doc_id, item_id, CAST(max(best) AS INTEGER) AS best_same, max(best) / n AS overlap
    FROM scored WHERE best >= ceil(n * {min_same} / {window}.0) GROUP BY doc_id, item_id, n"""
