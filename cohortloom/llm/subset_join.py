"""Jaccard join of word n-grams: subsets of small sets, inverted lists of large ones."""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.llm import hubs
from cohortloom.llm import packs as pk
from cohortloom.llm.bagminhash import components
from cohortloom.llm.block_anchors import Words
from cohortloom.llm.shared import arrow_rows, map_arrow, written_table
from cohortloom.operators.scale import maybe_broadcast, skew_join

SHINGLE_WORDS, PERCENT = 3, 90
#: Sizes between which the boundary of small and large sets is chosen.
BOUNDARIES = range(10, 41)
#: Rows of subsets that weigh as much as a row of a list, whose sets are compared whole.
LIST_WEIGHT = 4
#: Rounds in which lists are compared with one of their sets, before what is left of them is joined.
STAR_ROUNDS = 3
#: Bits that a set is folded to.
FOLDED_BITS = 512
_BASE = 0xD1B54A32D192ED03


def least_overlap(a: int, b: int, percent: int = PERCENT) -> int:
    """Common members that sets of these sizes need: percent of the union or more."""
    return -(-percent * (a + b) // (100 + percent))


def partner_sizes(n: int, percent: int = PERCENT) -> range:
    """Sizes of the sets that a set of size n can be linked with."""
    return range(-(-percent * n // 100), 100 * n // percent + 1)


def shingle_sets(texts: bytes, sizes: np.ndarray, size: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of every document: its number and the shingle's hash, sorted by both.

    A document of fewer words than a shingle has one, its whole sequence; without words, none.
    """
    words = Words(texts.lower(), sizes, families=1)
    inside = words.inside(size)
    prints = pk.rolling(words.hashes[0], size, _BASE)[inside] if len(inside) else np.zeros(0, np.uint64)
    doc = words.doc[: len(inside)][inside]
    short = np.flatnonzero((words.counts > 0) & (words.counts < size))
    joined = [words.hashes[0][words.doc_first[d] :][: words.counts[d]].tobytes() for d in short]
    prints = np.append(prints, np.array([xxhash.xxh3_64_intdigest(x) for x in joined], np.uint64))
    doc = np.append(doc, short)
    order = np.lexsort((prints, doc))
    doc, prints = doc[order], prints[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (prints[1:] != prints[:-1])
    return doc[new], prints[new]


class _Shared:
    """The question of packs: which shingles does another document have, too?"""

    def __init__(self, size: int, entries: int, parts: int):
        # False hits keep a set that could be left out, and lose nothing.
        self.drop = np.uint64(64 - min(64, 8 * -(-(entries.bit_length() + 16) // 8)))
        self.size, self.parts = size, parts

    def asked(self, row: dict):
        doc, prints = shingle_sets(row["text"], row["sizes"], self.size)
        return doc, prints, np.unique((prints >> self.drop) << self.drop, return_inverse=True, return_counts=True)

    def send(self, row: dict):
        _, _, (distinct, _, counts) = self.asked(row)
        return distinct, ((counts > 1).astype(np.uint8),)

    @staticmethod
    def answer(prints, packs, more):
        if not len(prints):
            return np.zeros(0, bool)
        start = np.flatnonzero(np.concatenate([[True], prints[1:] != prints[:-1]]))
        size = np.diff(np.append(start, len(prints)))
        return np.repeat((size > 1) | (np.maximum.reduceat(more[0].view(np.uint8), start) > 0), size)


def _sets(packs: DataFrame, shared: _Shared, percent: int) -> DataFrame:
    """(key, n, node, held, bits): size of every row's set; of those that can be linked, its id, and
    at one row of each pack the shingles that other documents share, sorted, and all folded to
    bits."""

    def run(batches):
        def rows():
            for row in pk.pack_rows(batches):
                doc, prints, (distinct, inverse, _) = shared.asked(row)
                repeated = pk.answers_of(distinct, row["answers0"], shared.parts)[inverse]
                edges = np.searchsorted(doc, np.arange(len(row["sizes"]) + 1))
                seen = set()
                for d, key in enumerate(row["keys"]):
                    own, common = prints[edges[d] : edges[d + 1]], repeated[edges[d] : edges[d + 1]]
                    n = len(own)
                    # At least percent of the set must stand elsewhere.
                    if not n or 100 * int(common.sum()) < percent * n:
                        yield key, n, None, None, None
                        continue
                    node = xxhash.xxh3_128_digest(own.tobytes())
                    if node in seen:
                        yield key, n, node, None, None
                        continue
                    yield key, n, node, own[common].tobytes(), hubs.folded(own, None, FOLDED_BITS)
                    seen.add(node)

        cells = {"key": pa.int64(), "n": pa.int64(), "node": pa.binary(), "held": pa.binary(), "bits": pa.list_(pa.int64())}
        yield from arrow_rows(cells, rows())

    return map_arrow(packs, run, "key long, n long, node binary, held binary, bits array<long>")


def _entries(nodes: DataFrame, percent: int) -> DataFrame:
    """(token, node, n, c, at): where sets stand in inverted lists.

    All sets are ordered alike, shingles that nothing shares first and the others by hash. Two
    linked sets share one of the first n - ceil(percent * n) + 1 of each, so that only these are
    listed. ``at`` is the place in the order, ``c`` the number of shared shingles.
    """

    def run(batches):
        def rows():
            for batch in batches:
                for node, n, held in zip(*(c.to_pylist() for c in batch.columns)):
                    tokens = np.frombuffer(held, "<i8")
                    alone = n - len(tokens)
                    first = n - (-(-percent * n // 100)) + 1 - alone
                    for i, token in enumerate(tokens[:first].tolist()):
                        yield token, node, n, len(tokens), alone + i

        cells = {"token": pa.int64(), "node": pa.binary(), "n": pa.int64(), "c": pa.int64(), "at": pa.int64()}
        yield from arrow_rows(cells, rows())

    large = nodes.where(F.col("n") >= -(-percent * BOUNDARIES[0] // 100)).select("node", "n", "held")
    return map_arrow(large, run, "token long, node binary, n long, c long, at long")


def _boundary(nodes: DataFrame, members: DataFrame, percent: int) -> int:
    """Size from which sets go through lists: least rows of subsets and lists together."""
    top = BOUNDARIES[-1]
    small = nodes.where(F.col("n") < top).groupBy("n", F.floor(F.octet_length("held") / 8).alias("c")).count().collect()
    listed = members.groupBy(F.least("n", F.lit(top)).alias("n")).agg(F.count(F.lit(1)).alias("rows")).collect()

    def rows(boundary: int) -> int:
        subsets = sum(
            r["count"] * sum(math.comb(r.c, least_overlap(m, r.n, percent)) for m in partner_sizes(r.n, percent) if m < boundary)
            for r in small
            if r.n < boundary
        )
        return subsets + LIST_WEIGHT * sum(r.rows for r in listed if 100 * r.n >= percent * boundary)

    return min(BOUNDARIES, key=rows)


def _subset_links(nodes: DataFrame, boundary: int, percent: int) -> DataFrame:
    """Links (a, b) that connect all linked sets below the boundary.

    For every size m that a set of size n can be linked with, each subset of as many members as
    the two need to share is a row. Sets of size m and n in one bucket share these, so they are
    linked; each goes to the least of the other size. A hot bucket costs one row a set.
    """

    def run(batches):
        def rows():
            for batch in batches:
                for node, n, held in zip(*(c.to_pylist() for c in batch.columns)):
                    members = np.frombuffer(held, "<u8")
                    marks = np.stack([pk.scrambled(members + np.uint64(s)) for s in (1, 2)])
                    whole = marks.sum(axis=1, dtype=np.uint64)
                    for m in partner_sizes(n, percent):
                        left_out = len(members) - least_overlap(m, n, percent)
                        if m >= boundary or left_out < 0:
                            continue
                        for gone in itertools.combinations(range(len(members)), left_out):
                            low, high = (whole - marks[:, list(gone)].sum(axis=1, dtype=np.uint64)).view(np.int64).tolist()
                            yield min(m, n), max(m, n), low, high, n, node

        cells = {"m": pa.int64(), "n": pa.int64(), "low": pa.int64(), "high": pa.int64(), "own": pa.int64(), "node": pa.binary()}
        yield from arrow_rows(cells, rows())

    small = nodes.where(F.col("n") < boundary).select("node", "n", "held")
    table = map_arrow(small, run, "m long, n long, low long, high long, own long, node binary")
    table = written_table(table, "subsets")
    bucket = ["m", "n", "low", "high"]
    least = table.groupBy(*bucket).agg(
        F.min(F.when(F.col("own") == F.col("m"), F.col("node"))).alias("of_m"),
        F.min(F.when(F.col("own") == F.col("n"), F.col("node"))).alias("of_n"),
        F.count(F.lit(1)).alias("many"),
    )
    shared = least.where("many > 1 and of_m is not null and of_n is not null").drop("many")
    joined = skew_join(table, written_table(shared, "buckets"), bucket)
    other = F.when(F.col("own") == F.col("m"), F.col("of_n")).otherwise(F.col("of_m"))
    links = joined.select(F.greatest("node", other).alias("a"), F.least("node", other).alias("b"))
    return links.where("a <> b").distinct()


def _possible(one: str, other: str, boundary: int, percent: int) -> Column:
    """Whether two entries of a list can be of linked sets, not both below the boundary.

    Linked sets share no more than their shared shingles, and no more than what stands from
    their first common shingle on; another common shingle may refuse a pair, the first never does.
    """
    def of(side: str, name: str) -> Column:
        return F.col(f"{side}.{name}")

    most = F.least(*(e for s in (one, other) for e in (of(s, "c"), of(s, "n") - of(s, "at"))))
    fits = (100 + percent) * most >= percent * (of(one, "n") + of(other, "n"))
    return fits & (F.greatest(of(one, "n"), of(other, "n")) >= boundary)


def _linked(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are linked, by their members."""

    def linked(one, other):
        (m, held), (n, own) = one, other
        x, y = np.frombuffer(held, "<u8"), np.frombuffer(own, "<u8")
        common = len(x) + len(y) - len(np.union1d(x, y))
        return 100 * common >= percent * (m + n - common)

    return hubs.linked_pairs(pairs, nodes.select("node", "n", "held"), linked)


def _members(entry: DataFrame, percent: int) -> DataFrame:
    """Entries of lists that can link something, with ``one``: the set that all others of the list meet first.

    That is the set with the fewest shingles of its own, as the text that others were copied
    from. An entry so far back that not even the smallest set of its list is in reach goes.
    """
    one = F.struct((F.col("n") - F.col("c")).alias("alone"), "node", "n", "c", "at")
    lists = entry.groupBy("token").agg(
        F.count(F.lit(1)).alias("many"), F.min("n").alias("least_n"), F.min(one).alias("one")
    )
    lists = written_table(lists.where("many > 1").drop("many"), "list_sizes")
    most = F.least(F.col("c"), F.col("n") - F.col("at"))
    reaches = (100 + percent) * most >= percent * (F.col("n") + F.col("least_n"))
    return skew_join(entry, lists, ["token"]).where(reaches).drop("least_n")


def _list_links(members: DataFrame, nodes: DataFrame, links: DataFrame, boundary: int, percent: int) -> DataFrame:
    """Labels (node, label) after all lists were compared, with the links found before.

    In every list all sets meet one, which then leaves it; lists whose sets are connected by now
    are done, for sets with one label need no further link. What is left after a few rounds is
    joined within the lists, only across labels and only pairs that sizes, shared shingles, places
    and folded bits allow.
    """
    large = members.where(100 * F.col("n") >= percent * boundary)
    open_ = large.where(F.col("node") != F.col("one.node")).drop("one")
    met = large.withColumn("other", F.struct("node", "n", "c", "at")).where(F.col("node") != F.col("one.node"))
    tried, labels = None, None
    for turn in range(STAR_ROUNDS + 1):
        pairs = met.where(_possible("one", "other", boundary, percent))
        pairs = pairs.select(F.col("one.node").alias("a"), F.col("other.node").alias("b")).distinct()
        if tried is not None:
            pairs = pairs.join(maybe_broadcast(tried), ["a", "b"], "left_anti")
        pairs = written_table(pairs, "candidates")
        if labels is None or not pairs.isEmpty():
            tried = pairs if tried is None else written_table(tried.unionByName(pairs), "tried")
            links = written_table(links.unionByName(_linked(pairs, nodes, percent)).distinct(), "links")
            labels = written_table(components(links), "labels")
        named = labels.withColumnRenamed("label", "found")
        labelled = open_.join(maybe_broadcast(named), "node", "left").withColumn("label", F.coalesce("found", "node")).drop("found")
        mixed = labelled.groupBy("token").agg(F.min("label").alias("x"), F.max("label").alias("y"))
        mixed = written_table(mixed.where("x <> y").select("token"), "mixed")
        if turn == STAR_ROUNDS or mixed.isEmpty():
            break
        open_ = written_table(labelled.join(maybe_broadcast(mixed), "token"), "lists")
        row = F.struct((F.col("n") - F.col("c")).alias("alone"), "node", "n", "c", "at", "label")
        if turn < STAR_ROUNDS - 1:
            first = written_table(open_.groupBy("token").agg(F.min(row).alias("one")), "centres")
            met = skew_join(open_, first, ["token"]).withColumn("other", row).where(F.col("node") != F.col("one.node"))
            open_ = met.select("token", "node", "n", "c", "at")
            met = met.where(F.col("one.label") != F.col("other.label"))
        else:
            folded = written_table(open_.join(nodes.select("node", "bits"), "node"), "folded")
            one, other = folded.alias("one"), folded.alias("other")
            rank = (F.struct(F.col(f"{s}.n") - F.col(f"{s}.c"), F.col(f"{s}.node")) for s in ("one", "other"))
            apart = hubs.differing_bits(F.col("one.bits"), F.col("other.bits"), FOLDED_BITS)
            near = (100 + percent) * apart <= (100 - percent) * (F.col("one.n") + F.col("other.n"))
            met = one.join(other, (F.col("one.token") == F.col("other.token")) & (next(rank) < next(rank))
                           & (F.col("one.label") != F.col("other.label"))
                           & _possible("one", "other", boundary, percent) & near)
    return labels


def join(
    df: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE_WORDS, percent: int = PERCENT
) -> DataFrame:
    """(key, n_shingles, component_id) of every row: what links of ``percent`` overlap connect.

    Words stand between blanks (space, 0x09 to 0x0D), A-Z are lower-cased; a row's set are its
    distinct shingles of ``size`` words, or the whole sequence of fewer words. Rows are linked if
    their common shingles are ``percent`` or more of their union. ``component_id`` is the
    smallest key of the component (null if it has none). Null texts and texts without words have
    no shingle and are alone; repeated rows give a row each; an empty table gives none.

    Rows with equal sets are one node. Which shingles stand in two documents or more is asked
    of packs; a set of which less than ``percent`` do can't be linked. The others are joined by
    size: sets below a boundary meet in subsets of the size they need to share, larger ones in
    inverted lists of their first shingles, and the boundary is where both take the fewest rows.
    """
    packs, total = pk.write_packs(df, text, key)
    entries = max(1, total // 6)
    parts = pk.parts_for(entries)
    shared = _Shared(size, entries, parts)
    asked = pk.with_answers(packs, pk.exchange(packs, shared.send, shared.answer, parts))
    sets = written_table(_sets(asked, shared, percent), "sets")
    nodes = sets.where("held is not null").select("node", "n", "held", "bits").dropDuplicates(["node"])
    nodes = written_table(nodes, "nodes")
    members = written_table(_members(written_table(_entries(nodes, percent), "entries"), percent), "members")
    boundary = _boundary(nodes, members, percent)
    labels = _list_links(members, nodes, _subset_links(nodes, boundary, percent), boundary, percent)
    alone = sets.where("node is null").select("key", "n", F.col("key").alias("component_id"))
    named = skew_join(sets.where("node is not null").select("key", "n", "node"), labels, ["node"], "left")
    named = written_table(named.select("key", "n", F.coalesce("label", "node").alias("label")), "labelled")
    least = written_table(named.groupBy("label").agg(F.min("key").alias("component_id")), "least")
    found = skew_join(named, least, ["label"]).select("key", "n", "component_id")
    return alone.unionByName(found).select(F.col("key").alias(key), F.col("n").alias("n_shingles"), "component_id")
