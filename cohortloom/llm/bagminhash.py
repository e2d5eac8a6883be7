"""Near copies by BagMinHash signatures of word shingles counted with multiplicity."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.llm import hubs
from cohortloom.llm import packs as pk
from cohortloom.llm.block_anchors import Words
from cohortloom.llm.shared import arrow_rows, filled, free_name, map_arrow, row_id, written_table
from cohortloom.operators.scale import maybe_broadcast, skew_join

SHINGLE_WORDS, MIN_SIMILARITY = 5, 0.8
#: Registers of a signature, and rows of a band: a pair at the least similarity shares no band
#: with a probability of 5e-8.
REGISTERS, BAND_ROWS = 128, 4
#: Pairs whose signatures agree less than this are no candidates: five standard deviations.
MIN_AGREEMENT = MIN_SIMILARITY - 5 * math.sqrt(MIN_SIMILARITY * (1 - MIN_SIMILARITY) / REGISTERS)
#: Bits that a bag is folded to.
FOLDED_BITS = 1024
#: Rows with signatures and folded bits, some 300 bytes each, that may be sent to every executor.
BROADCAST_SIGNED = 20_000
_BASE = 0xB5297A4D3F84D5B5


def bags(texts: list[bytes], size: int = SHINGLE_WORDS):
    """Shingles of texts: arrays of document, shingle hash and count, sorted by the first two.

    Words stand between blanks, ASCII letters are lower-cased. A text of fewer words than a
    shingle is one shingle of all its words; one without words has none.
    """
    words = Words(b"".join(texts).lower(), np.array([len(t) for t in texts], dtype=np.int64))
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
    first = np.flatnonzero(new)
    return doc[first], prints[first], np.diff(np.append(first, len(doc)))


def _uniform(keys: np.ndarray, turn: np.ndarray, salt: int) -> np.ndarray:
    """Numbers above 0 up to 1 that depend on key, turn and salt alone."""
    mixed = pk.scrambled(keys + turn.astype(np.uint64) * np.uint64(_BASE) + np.uint64(salt))
    return ((mixed >> np.uint64(11)).astype(np.float64) + 1) * 2.0**-53


def signatures(doc, prints, counts, n_docs: int, registers: int = REGISTERS) -> np.ndarray:
    """Registers of every document's bag, as times; documents without shingles keep infinity.

    Weights are discretised to 0, 1, 2, 4, 8 and so on. Every shingle has a Poisson process
    for each step between these, at a rate of the step's width, which any bag that holds the
    shingle sees alike. A point carries a register and a level within its step, and counts for a
    bag if the level isn't above its weight; a register keeps its earliest point. So two bags
    agree in a register with the probability of their weighted Jaccard similarity. Points are
    made in order of time, for each document only up to the time at which its last register is
    set: that takes about as many points for long documents as for short ones.
    """
    steps = [(np.arange(len(doc)), 0)]
    while True:
        step = steps[-1][1] + 1
        heavy = np.flatnonzero(counts > 1 << (step - 1))
        if not len(heavy):
            break
        steps.append((heavy, step))
    own = np.concatenate([i for i, _ in steps])
    step = np.concatenate([np.full(len(i), s) for i, s in steps])
    below = np.where(step > 0, 1 << np.maximum(step - 1, 0), 0)
    width = np.where(step > 0, below, 1).astype(np.float64)
    weight, doc_of = counts[own], doc[own]
    key = pk.scrambled(prints[own] + step.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))

    out = np.full(n_docs * registers, np.inf)
    total = np.bincount(doc, weights=counts, minlength=n_docs)
    limit = registers * (math.log(registers) + 1.0) / np.maximum(total, 1)
    turn = np.zeros(len(key), np.int64)
    time = -np.log(_uniform(key, turn, 1)) / width
    waiting = np.arange(len(key))
    while len(waiting):
        now = waiting[time[waiting] <= limit[doc_of[waiting]]]
        while len(now):
            register = (_uniform(key[now], turn[now], 2) * registers).astype(np.int64) % registers
            level = below[now] + np.ceil(_uniform(key[now], turn[now], 3) * width[now])
            fits = level <= weight[now]
            np.minimum.at(out, (doc_of[now] * registers + register)[fits], time[now][fits])
            turn[now] += 1
            time[now] += -np.log(_uniform(key[now], turn[now], 1)) / width[now]
            now = now[time[now] <= limit[doc_of[now]]]
        unset = ~(out.reshape(n_docs, registers).max(axis=1) <= limit)
        waiting = waiting[unset[doc_of[waiting]]]
        limit = np.where(unset, limit * 1.5, limit)
    return out.reshape(n_docs, registers)


def _parts(batches, room: int = 1 << 20) -> Iterator[tuple[list, list[bytes]]]:
    """(other cells, texts) of rows, in parts of bounded bytes."""
    held, texts, size = [], [], 0
    for batch in batches:
        names = batch.schema.names
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            text = row[names.index("text")].encode()
            if texts and size + len(text) > room:
                yield held, texts
                held, texts, size = [], [], 0
            held.append(row[: names.index("text")])
            texts.append(text)
            size += len(text) + 64
    if texts:
        yield held, texts


def _bag_id(prints: np.ndarray, counts: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(prints.tobytes() + counts.astype("<i8").tobytes())


def sign(df: DataFrame, text: str = "text") -> DataFrame:
    """Replace texts, beside columns of longs or bytes, by bag (id of the shingles and counts; null without words), n_shingles,
    bands (a hash for each band), sketch (8 bits of every register, 7 to a number) and bits (the
    bag folded to bits)."""
    kept = [c for c in df.columns if c != text]
    source = df.select(*kept, filled(text).alias("text"))
    plain = {"bigint": pa.int64(), "binary": pa.binary()}
    others_types = {c: plain[df.schema[c].dataType.simpleString()] for c in kept}

    def run(batches):
        def rows():
            for others, texts in _parts(batches):
                doc, prints, counts = bags(texts)
                times = signatures(doc, prints, counts, len(texts))
                codes = times.astype(np.float32).view(np.uint32).astype(np.uint64)
                rows = codes.reshape(len(texts), -1, BAND_ROWS)
                bands = np.tile(np.arange(rows.shape[1], dtype=np.uint64), (len(texts), 1))
                for i in range(BAND_ROWS):
                    bands = pk.scrambled(bands * np.uint64(_BASE) + rows[:, :, i])
                low = pk.scrambled(codes + np.uint64(1)) & np.uint64(255)
                low = np.pad(low, ((0, 0), (0, -REGISTERS % 7))).reshape(len(texts), -1, 7)
                sketch = (low << (np.arange(7, dtype=np.uint64) * np.uint64(8))).sum(axis=2)
                edges = np.searchsorted(doc, np.arange(len(texts) + 1))
                for i, cells in enumerate(others):
                    a, b = edges[i], edges[i + 1]
                    if a == b:
                        yield *cells, None, 0, [], [], []
                    else:
                        yield (
                            *cells, _bag_id(prints[a:b], counts[a:b]), int(counts[a:b].sum()),
                            bands[i].view(np.int64), sketch[i].view(np.int64),
                            hubs.folded(prints[a:b], counts[a:b], FOLDED_BITS),
                        )

        cells = dict(others_types)
        cells |= {"bag": pa.binary(), "n_shingles": pa.int64()}
        lists = {c: pa.list_(pa.int64()) for c in ("bands", "sketch", "bits")}
        yield from arrow_rows(cells | lists, rows())

    fields = "".join(f"`{c}` {df.schema[c].dataType.simpleString()}, " for c in kept)
    fields += "bag binary, n_shingles long, bands array<long>, sketch array<long>, bits array<long>"
    return map_arrow(source, run, fields)


def agreement(a: Column, b: Column) -> Column:
    """Share of registers in which two sketches agree."""
    differing = None
    for i in range(-(-REGISTERS // 7)):
        x = F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i)))
        # The top bit of each byte is set where the byte isn't zero; seven bytes leave room.
        seven, high = F.lit(0x7F7F7F7F7F7F7F), F.lit(0x80808080808080)
        found = F.bit_count((x.bitwiseAND(seven) + seven).bitwiseOR(x).bitwiseAND(high))
        differing = found if differing is None else differing + found
    return 1 - differing / REGISTERS


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node connected with each node of the edges (a, b).

    Edges are turned to ever smaller nodes, over larger and over smaller neighbours in turn,
    until they form stars; no node's neighbours are gathered in one row. Every round is written
    to the shared scratch folder, and the driver sees two numbers of it.
    """
    edges = written_table(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = None
    while True:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("root"))
        larger = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("root").alias("b"))
        larger = larger.where("a <> b").distinct()
        roots = larger.groupBy("a").agg(F.min("b").alias("root"))
        joined = larger.join(roots, "a")
        smaller = joined.select(F.col("b").alias("a"), F.col("root").alias("b")).unionAll(
            joined.select("a", F.col("root").alias("b"))
        )
        edges = written_table(smaller.where("a <> b").distinct(), "edges")
        state = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).head())
        if state == seen:
            break
        seen = state
    found = edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return found.unionAll(found.select(F.col("label").alias("node"), "label").distinct())


def _verified(pairs: DataFrame, texts: DataFrame, min_similarity: float) -> DataFrame:
    """The pairs (a, b) of bags whose weighted Jaccard similarity reaches the least, exactly."""
    pairs = written_table(pairs, "pairs")
    wanted = pairs.select(F.col("a").alias("bag")).unionAll(pairs.select("b")).distinct()
    sources = texts.join(maybe_broadcast(wanted), "bag", "left_semi")

    def counted(batches):
        def rows():
            for others, parts in _parts(batches):
                doc, prints, counts = bags(parts)
                edges = np.searchsorted(doc, np.arange(len(parts) + 1))
                for i, (bag,) in enumerate(others):
                    a, b = edges[i], edges[i + 1]
                    yield bag, prints[a:b].tobytes() + counts[a:b].astype("<u8").tobytes()

        yield from arrow_rows({"bag": pa.binary(), "held": pa.binary()}, rows())

    held = written_table(map_arrow(sources, counted, "bag binary, held binary").dropDuplicates(["bag"]), "bags")

    def linked(one, other):
        return similarity(one[0], other[0]) >= min_similarity - 1e-12

    return hubs.linked_pairs(pairs, held.withColumnRenamed("bag", "node"), linked)


def similarity(x: bytes, y: bytes) -> float:
    """Weighted Jaccard similarity of two packed bags."""
    (p, v), (q, w) = (np.frombuffer(z, "<u8").reshape(2, -1) for z in (x, y))
    _, i, j = np.intersect1d(p, q, assume_unique=True, return_indices=True)
    common = int(np.minimum(v[i], w[j]).sum())
    return common / max(1, int(v.sum()) + int(w.sum()) - common)


def across(buckets: DataFrame, cells: DataFrame, allowed: Callable[[str, str], Column]) -> DataFrame:
    """Pairs (a, b) of bags with different labels that share a bucket and are allowed, each once.

    ``buckets`` has band, bag, degree and label, ``cells`` what ``allowed`` compares of each bag. All
    filters are part of the join, which so puts out only what they let through, and a pair only in
    the first of the bands that its two bags share.
    """
    shared = buckets.groupBy("bag").agg(F.array_sort(F.collect_list("band")).alias("shared"))
    cells = cells.join(maybe_broadcast(written_table(shared, "shared")), "bag")
    known = written_table(buckets.join(cells, "bag"), "open")
    one, other = known.alias("one"), known.alias("other")
    rank = [F.struct(f"{side}.degree", f"{side}.bag") for side in ("one", "other")]
    apart = (F.col("one.band") == F.col("other.band")) & (rank[0] > rank[1])
    apart &= F.col("one.label") != F.col("other.label")
    first = F.array_min(F.array_intersect("one.shared", "other.shared")) == F.col("one.band")
    pairs = one.join(other, apart & allowed("one", "other") & first)
    return pairs.select(F.col("one.bag").alias("a"), F.col("other.bag").alias("b"))


def classes(
    df: DataFrame, key: str = "doc_id", text: str = "text", min_similarity: float = MIN_SIMILARITY
) -> DataFrame:
    """Near-copy class of every row (key, row_key, class_id, n_shingles).

    Two texts are linked if the weighted Jaccard similarity of their word shingles, counted with
    multiplicity, reaches ``min_similarity``; classes are what links connect, and ``class_id`` is
    the smallest key of the class (null if it has none). A text without words is alone. ``row_key`` has 128 bits and tells apart rows of one key. Texts with equal shingles are
    one node, so that exact copies in any number cost nothing further. In every bucket of a band all
    nodes are compared with the one that shares the most buckets; where that leaves several
    classes in a bucket, once more, and then all pairs across the classes left. Pairs are compared
    by signature first and by their shingles before they count; no bucket is capped.
    """
    rows = df.select(F.col(key).cast("long").alias("key"), row_id(key, text).alias("row_key"), F.col(text).alias("text"))
    signed = written_table(sign(rows), "signatures")
    nodes = signed.where("bag is not null").select("bag", "n_shingles", "bands", "sketch", "bits").dropDuplicates(["bag"])
    nodes = written_table(nodes, "nodes")
    # Dealt by band once, for the counts and for the join with them.
    placed = nodes.select("bag", F.explode("bands").alias("band")).repartition("band")
    shared = placed.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = written_table(placed.join(shared, "band"), "members")
    degree = members.groupBy("bag").agg(F.sum("n").alias("degree"))
    members = written_table(members.join(degree, "bag").select("band", "bag", "degree"), "buckets")
    bag_of = signed.where("bag is not null").select("row_key", "bag")
    marked = rows.select("row_key", filled("text").alias("text"))
    small = nodes.select("bag", "n_shingles", "sketch", "bits")

    def allowed(one: str, other: str) -> Column:
        """Whether sizes, signatures and folded bits of two bags allow the least similarity."""
        (n, m), (s, t), (x, y) = ([F.col(f"{side}.{c}") for side in (one, other)] for c in ("n_shingles", "sketch", "bits"))
        sizes = F.least(n, m) >= min_similarity * F.greatest(n, m) - 1e-9
        close = agreement(s, t) >= MIN_AGREEMENT - MIN_SIMILARITY + min_similarity
        apart = hubs.differing_bits(x, y, FOLDED_BITS)
        return sizes & (apart * (1 + min_similarity) <= (1 - min_similarity) * (n + m) + 1e-6) & close

    def likely(pairs: DataFrame) -> DataFrame:
        """Distinct pairs that are allowed; ``a``, a centre, may stand in very many."""
        # Joins below count frequent keys first, and so read the pairs more than once.
        pairs = written_table(pairs.distinct(), "pairs")
        paired = pairs.select(F.col("a").alias("bag")).unionAll(pairs.select("b")).distinct()
        known = written_table(small.join(maybe_broadcast(written_table(paired, "paired")), "bag", "left_semi"), "paired")
        for side in "ab":
            cells = F.struct("n_shingles", "sketch", "bits").alias(f"of_{side}")
            pairs = skew_join(
                pairs, known.select(F.col("bag").alias(side), cells), [side], broadcast_rows=BROADCAST_SIGNED
            )
        return pairs.where(allowed("of_a", "of_b")).select("a", "b")

    def checked(pairs: DataFrame) -> DataFrame:
        pairs = written_table(pairs, "candidates")
        involved = pairs.select(F.col("a").alias("bag")).unionAll(pairs.select("b")).distinct()
        one = bag_of.join(involved, "bag", "left_semi").groupBy("bag").agg(F.min("row_key").alias("row_key"))
        one = written_table(one, "involved")
        texts = marked.join(maybe_broadcast(one), "row_key").select("bag", "text")
        return written_table(_verified(pairs, texts, min_similarity), "links")

    def starred(buckets: DataFrame) -> DataFrame:
        centre = buckets.groupBy("band").agg(F.max_by("bag", F.struct("degree", "bag")).alias("centre"))
        pairs = buckets.join(centre, "band").where("bag <> centre")
        return pairs.select(F.col("centre").alias("a"), F.col("bag").alias("b"))

    links = checked(likely(starred(members)))
    labels = written_table(components(links), "labels")
    for last in (False, True):
        labelled = members.join(labels.withColumnRenamed("node", "bag"), "bag", "left").withColumn("label", F.coalesce("label", "bag"))
        mixed = labelled.groupBy("band").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x <> y").select("band")
        open_ = written_table(labelled.join(mixed, "band"), "open")
        if open_.isEmpty():
            break
        if last:
            found = across(open_, small, allowed)
        else:
            # The centres so far have been compared; the next in each bucket are others.
            centres = open_.groupBy("band").agg(F.max_by("label", F.struct("degree", "bag")).alias("done"))
            fresh = open_.join(centres, "band").where("label <> done").groupBy("band").agg(
                F.max_by(F.struct("degree", "bag", "label"), F.struct("degree", "bag")).alias("next")
            )
            # The one that shares more buckets first, so that a pair has one form.
            own, other = F.struct("degree", "bag"), F.struct("next.degree", "next.bag")
            pairs = open_.join(fresh, "band").where("label <> next.label").select(
                F.greatest(own, other)["bag"].alias("a"), F.least(own, other)["bag"].alias("b")
            )
            found = likely(pairs)
        found = checked(found)
        links = written_table(links.unionByName(found).distinct(), "links")
        labels = written_table(components(links), "labels")

    owned = signed.select("key", "row_key", "bag", "n_shingles").join(
        labels.withColumnRenamed("node", "bag"), "bag", "left"
    ).withColumn("label", F.coalesce("label", "bag"))
    least = owned.where("label is not null").groupBy("label").agg(F.min("key").alias("class_id"))
    return owned.join(least, "label", "left").select(
        F.col("key").alias(key),
        "row_key",
        F.when(F.col("label").isNull(), F.col("key")).otherwise(F.col("class_id")).alias("class_id"),
        "n_shingles",
        "label",
    )


def keep_one(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of every class, that of the smallest key (nulls last); all columns stay.

    Rows without words are alone and stay, each of them.
    """
    found = written_table(classes(df, key, text).where("label is not null"), "classes")
    order = F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("key"), "row_key")
    first = found.groupBy("label").agg(F.min(order).alias("first"))
    kept = found.join(first, "label").withColumn("stays", F.col("row_key") == F.col("first.row_key"))
    name = free_name(df, "row_key")
    gone = kept.where("not stays").select(F.col("row_key").alias(name)).distinct()
    many = kept.where("stays").groupBy(F.col("row_key").alias(name)).count().where("count > 1").select(name)
    marked = df.withColumn(name, row_id(key, text))
    left = marked.join(maybe_broadcast(written_table(gone, "gone")), name, "left_anti")
    # Rows alike in key and text: one of each stays.
    many = maybe_broadcast(written_table(many, "repeated"))
    single = left.join(many, name, "left_anti")
    repeated = left.join(many, name, "left_semi").dropDuplicates([name])
    return single.unionByName(repeated).drop(name)
