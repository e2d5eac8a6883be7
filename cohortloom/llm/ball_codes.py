"""Vectors as short codes: integer product codebooks fitted by ball k-means."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.shared import map_arrow, written_table
from cohortloom.operators.scale import skew_join

PARTS, ENTRIES, ROUNDS = 16, 64, 2
#: A component becomes a whole number of steps of 1 / SCALE.
SCALE = 256
#: Components of the rows whose parts are assigned at once.
BLOCK_VALUES = 1 << 22
#: Doubles hold whole numbers exactly below this.
EXACT = 1 << 53


@dataclass
class Compressed:
    """Rows (key, label, code, error) and the codebooks: by part, entry and place whole numbers."""

    rows: DataFrame
    codebooks: list[list[list[int]]]

    def codebooks_text(self) -> str:
        return ",".join(str(x) for book in self.codebooks for entry in book for x in entry)


def whole_steps(values: np.ndarray) -> np.ndarray:
    """floor(SCALE * x) as exact whole numbers: doubles where these hold them, else Python's."""
    steps = np.floor(values.astype(np.float64) * SCALE)
    if steps.size and np.abs(steps).max() >= 1 << 24:
        return np.array([int(v) for v in steps.ravel()], dtype=object).reshape(steps.shape)
    return steps


def _squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances of every row of x to every row of y, exact."""
    return (x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1)[None, :] - 2 * (x @ y.T)


def _kind(x: np.ndarray, books: list) -> type:
    """Doubles if no squared distance can leave their exact range, else Python's integers."""
    largest = max(int(abs(x).max()) if x.size else 0, max((abs(v) for b in books for e in b for v in e), default=0))
    return np.float64 if 16 * largest * largest * max(1, x.shape[2]) < EXACT else object


def assign(x: np.ndarray, books: list, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry of every part, ties to the lower index, and its squared distance.

    ``x`` is (rows, parts, width) and ``code`` a first guess, the entry each part had so far.
    Parts with one guess form its ball. Entries further from its centre than twice its radius
    can't be nearest for any of them, the others are its neighbours. A part less than half the
    way to the nearest neighbour is in the stable core and keeps its entry; any other lies in a
    ring and is compared only with the neighbours no further than twice its own distance (rings
    are taken together by doubling numbers of neighbours). Comparisons are of squares of whole
    numbers, so that nothing is rounded.
    """
    kind = _kind(x, books)
    x = x.astype(kind)
    out, error = code.copy(), np.zeros(code.shape, dtype=kind)
    for part, book in enumerate(books):
        entries, points, guess = np.array(book, dtype=kind), x[:, part], code[:, part]
        apart = _squared(entries, entries)
        own = points - entries[guess]
        own = (own * own).sum(axis=1)
        order = np.argsort(guess, kind="stable")
        edges = np.searchsorted(guess[order], np.arange(len(entries) + 1))
        for e in np.flatnonzero(np.diff(edges)):
            ball = order[edges[e] : edges[e + 1]]
            twice = 4 * own[ball]
            near = np.argsort(apart[e], kind="stable")
            near = near[near != e]
            near = near[apart[e][near] <= twice.max()]
            reach = np.searchsorted(apart[e][near], twice, side="right")
            ring = np.ceil(np.log2(np.maximum(reach, 1))).astype(int)
            for step in np.unique(ring[reach > 0]):
                rows = ball[(ring == step) & (reach > 0)]
                # In order of their index, so that the first of equal distances is the lowest.
                candidates = np.sort(np.append(near[: 1 << step], e))
                distance = _squared(points[rows], entries[candidates])
                best = distance.argmin(axis=1)
                out[rows, part] = candidates[best]
                own[rows] = distance[np.arange(len(rows)), best]
        error[:, part] = own
    return out, error


def _blocks(batches):
    """Record batches joined to blocks of BLOCK_VALUES components or a little more."""
    held, size = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += len(batch["vector"].flatten())
        if size >= BLOCK_VALUES:
            yield pa.Table.from_batches(held).combine_chunks()
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _coded(rows: DataFrame, books: list, parts: int, last: bool) -> DataFrame:
    """All rows with code and error; unless it is the ``last`` round, each task's sums of the
    parts by entry come as further rows (key, label and vector null)."""
    shared = rows.sparkSession.sparkContext.broadcast(books)
    sums_type = pa.list_(pa.struct([("part", pa.int32()), ("entry", pa.int32()), ("place", pa.int32()),
                                    ("n", pa.int64()), ("total", pa.decimal128(38, 0))]))

    def run(batches):
        books = shared.value
        totals: dict[tuple, list] = {}
        names = None
        for block in _blocks(batches):
            flat = block["vector"].combine_chunks()
            values = flat.flatten().to_numpy(zero_copy_only=False)
            x = whole_steps(values).reshape(block.num_rows, parts, -1)
            before = b"".join(block["code"].to_pylist())
            guess = np.frombuffer(before, np.uint8).reshape(-1, parts).astype(np.int64)
            code, error = assign(x, books, guess)
            cells = pa.array([r.tobytes() for r in code.astype(np.uint8)], pa.binary())
            total = pa.array([int(e) for e in error.sum(axis=1)], pa.int64())
            table = block.set_column(block.schema.get_field_index("code"), "code", cells)
            table = table.append_column("error", total)
            if not last:
                table = table.append_column("sums", pa.nulls(table.num_rows, sums_type))
                _add(totals, x, code, books)
            names = table.schema
            yield from table.to_batches(max_chunksize=4096)
        if totals:
            found = [
                {"part": p, "entry": e, "place": i, "n": n, "total": int(v)}
                for (p, e), (n, sums) in totals.items()
                for i, v in enumerate(sums)
            ]
            empty = [pa.nulls(1, f.type) for f in names][:-1]
            yield pa.RecordBatch.from_arrays([*empty, pa.array([found], sums_type)], schema=names)

    types = {f.name: f.dataType.simpleString() for f in rows.schema}
    fields = f"key long, label {types['label']}, vector {types['vector']}, code binary, error long"
    if not last:
        fields += ", sums array<struct<part: int, entry: int, place: int, n: long, total: decimal(38,0)>>"
    return map_arrow(rows, run, fields)


def _add(totals: dict, x: np.ndarray, code: np.ndarray, books: list) -> None:
    """Add counts and sums of a block's parts by (part, entry)."""
    for part, book in enumerate(books):
        order = np.argsort(code[:, part], kind="stable")
        edges = np.searchsorted(code[order, part], np.arange(len(book) + 1))
        for e in np.flatnonzero(np.diff(edges)):
            own = x[order[edges[e] : edges[e + 1]], part]
            count, sums = totals.get((part, int(e)), (0, [0] * own.shape[1]))
            # A block's sum of whole numbers below 2^24 stays exact in doubles.
            totals[part, int(e)] = count + len(own), [a + int(b) for a, b in zip(sums, own.sum(axis=0))]


def usable(df: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector holds values, none of them null or not finite."""
    finite = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return df.where(F.coalesce(finite & (F.size(vector) > 0), F.lit(False)))


def compress(
    df: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
) -> Compressed:
    """Code of every usable row: for each part the index of its codebook's nearest entry.

    Components become whole numbers floor(SCALE * x), vectors are cut into ``parts`` equal
    parts. The codebook of a part starts from the rows of the smallest keys (fewer rows, fewer
    entries; null keys come last, rows of one key by their vector) and is fitted in ``rounds``:
    every part goes to its nearest entry, ties to the lower index, and every used entry
    becomes floor(sum / count) of its parts. ``error`` is the squared distance to the final
    entries, summed over parts. Rows whose vector is null, empty or holds null or non-finite
    components are left out, and so are vectors whose length isn't that of the first row or
    can't be cut equally. Repeated rows are coded each; a table without usable rows gives none.

    The rows move nowhere: every round is a pass that writes them with their codes, and the
    next starts from those balls. The driver sees the codebooks and one sum for each component.
    """
    kind = "array<float>" if df.schema[vector].dataType.simpleString() == "array<float>" else "array<double>"
    source = usable(df, vector).select(
        F.col(key).cast("long").alias("key"), F.col(label).alias("label"), F.col(vector).cast(kind).alias("vector")
    )
    order = F.col("key").asc_nulls_last(), F.col("vector").asc()
    whole = source.where(F.size("vector") % parts == 0)
    first = [r.vector for r in whole.orderBy(*order).limit(1).collect()]
    if not first:
        found = source.select("key", "label", F.lit(b"").alias("code"), F.lit(0).cast("long").alias("error"))
        return Compressed(found.limit(0), [[] for _ in range(parts)])
    size = len(first[0])
    alike = whole.where(F.size("vector") == size)
    first = [r.vector for r in alike.orderBy(*order).limit(entries).collect()]
    start = whole_steps(np.array(first, dtype=np.float64))
    books = [[[int(v) for v in e] for e in start.reshape(len(start), parts, -1)[:, p]] for p in range(parts)]
    rows = alike.withColumn("code", F.lit(bytes(parts)))
    for _ in range(rounds):
        table = written_table(_coded(rows, books, parts, last=False), "codes")
        sums = table.where("sums is not null").select(F.explode("sums").alias("s")).groupBy(
            "s.part", "s.entry", "s.place"
        ).agg(F.sum("s.n").alias("n"), F.sum("s.total").alias("total"))
        for s in sums.collect():
            books[s.part][s.entry][s.place] = int(s.total) // s.n
        rows = table.where("sums is null").select("key", "label", "vector", "code")
    coded = _coded(rows, books, parts, last=True).select("key", "label", "code", "error")
    return Compressed(coded, books)


def digests(found: Compressed, key: str = "vec_id") -> DataFrame:
    """key, code in hexadecimal, error, label_error (summed over equal labels) and the codebooks' digest."""
    rows = written_table(found.rows, "coded").withColumn("none", F.col("label").isNull()).withColumn(
        "name", F.coalesce(F.col("label").cast("string"), F.lit(""))
    )
    total = rows.groupBy("none", "name").agg(F.sum("error").alias("label_error"))
    return skew_join(rows, total, ["none", "name"]).select(
        F.col("key").alias(key),
        F.lower(F.hex("code")).alias("code"),
        "error",
        "label_error",
        F.lit(hashlib.sha256(found.codebooks_text().encode()).hexdigest()).alias("codebooks_sha256"),
    )
