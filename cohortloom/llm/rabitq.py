"""Nearest neighbours by randomly rotated one-bit codes, with bounds that choose what to rerank."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rows of the sample that the cell centres are fitted on, and rows that ask for one more cell.
SAMPLE_ROWS, ROWS_PER_CELL, MOST_CELLS = 4096, 1024, 1024
#: Share of the cells, the nearest ones, that a query probes. The given vectors hardly form
#: cells: half of them hold 0.85 of the neighbours, so that the default probes all.
PROBED = 1.0
#: Width of the error bounds in standard deviations.
EPSILON = 2.5
#: Rows of a cell, and queries, that meet in one task.
CELL_ROWS, CELL_QUERIES = 8192, 4096
#: Queries and rows that are compared in one matrix.
STEP_QUERIES, STEP_ROWS = 256, 2048


def rotation(dimension: int, seed: int = 7) -> np.ndarray:
    """Random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dimension, dimension)))
    return q * np.sign(np.diag(r))


def fit_centres(sample: np.ndarray, cells: int, rounds: int = 8) -> np.ndarray:
    """Centres of unit vectors by a few rounds of k-means, started at sample rows."""
    centres = sample[np.linspace(0, len(sample) - 1, cells).astype(int)].copy()
    for _ in range(rounds):
        nearest = (sample @ centres.T - (centres**2).sum(1) / 2).argmax(1)
        for k in np.unique(nearest):
            centres[k] = sample[nearest == k].mean(0)
    return centres


class Codes:
    """One-bit codes of unit vectors around their cells' centres, with correction scalars.

    A vector o in the cell of centre c is c + r u with a unit vector u. The code is the signs
    of the rotated u; ``fit`` is the inner product of u and its code. For any y, <o, y> is
    estimated by <c, y> + r <code, y - c> / fit + r <u, c>, of which the last term is kept as a
    scalar and the bound of the error shrinks with r and with the length of y - c.
    """

    def __init__(self, centres: np.ndarray, turn: np.ndarray):
        self.centres, self.turn = centres, turn

    def cells(self, unit: np.ndarray, n: int = 1) -> np.ndarray:
        closeness = unit @ self.centres.T - (self.centres**2).sum(1) / 2
        return np.argsort(-closeness, axis=1, kind="stable")[:, :n]

    def encode(self, unit: np.ndarray, cell: np.ndarray):
        """Packed bits, r, fit and <r u, c> of every vector."""
        away = unit - self.centres[cell]
        r = np.sqrt((away**2).sum(1))
        turned = away @ self.turn.T
        bits = turned > 0
        size = math.sqrt(unit.shape[1])
        with np.errstate(invalid="ignore", divide="ignore"):
            fit = np.abs(turned).sum(1) / size / r
        fit = np.where(r > 0, fit, 1.0)
        return np.packbits(bits, axis=1), r, fit, (away * self.centres[cell]).sum(1)

    def estimate(self, packed, r, fit, along, cell: int, queries: np.ndarray):
        """Estimated inner products (queries x rows) and the bounds of their errors."""
        d = queries.shape[1]
        away = queries - self.centres[cell]
        bits = np.unpackbits(packed, axis=1, count=d).astype(np.float32)
        turned = (away @ self.turn.T).astype(np.float32)
        # <signs, y> = 2 <bits, y> - sum(y)
        signs = 2 * (turned @ bits.T) - turned.sum(1, keepdims=True)
        base = (queries @ self.centres[cell])[:, None]
        scale = r / fit / math.sqrt(d)
        spread = r * np.sqrt(np.maximum(0, 1 - fit**2)) / fit / math.sqrt(max(1, d - 1))
        length = np.sqrt((away**2).sum(1))
        return base + signs * scale + along, EPSILON * length[:, None] * spread + 1e-5


def _nearest(codes: Codes, k: int, rows: pd.DataFrame, asked: pd.DataFrame) -> Iterator[tuple]:
    """(query, key, vec, score) of the k best rows of one part of a cell for every query."""
    cell = int(rows["cell"].iloc[0])
    rows = rows.sort_values("vec_id", kind="stable")
    ids, keys, copies = (rows[c].to_numpy() for c in ("vec_id", "key", "copies"))
    vectors = _matrix(rows["vector"])
    norms = np.sqrt((vectors**2).sum(1))
    packed = np.frombuffer(b"".join(rows["code"]), np.uint8).reshape(len(rows), -1)
    r, fit, along = (rows[c].to_numpy() for c in ("r", "fit", "along"))
    for at in range(0, len(asked), STEP_QUERIES):
        some = asked.iloc[at : at + STEP_QUERIES]
        queries = _matrix(some["vector"])
        lengths = np.sqrt((queries**2).sum(1))
        parts = [
            codes.estimate(packed[i:j], r[i:j], fit[i:j], along[i:j], cell, queries / lengths[:, None])
            for i in range(0, len(rows), STEP_ROWS)
            for j in [i + STEP_ROWS]
        ]
        estimate, error = (np.concatenate(x, axis=1) for x in zip(*parts))
        # A query is no candidate of its own, but another row with the same id and vector is.
        own = keys[None, :] == some["key"].to_numpy()[:, None]
        others = np.broadcast_to(copies, own.shape) - own
        low = np.where(others > 0, estimate - error, -np.inf)
        # Rows whose upper bound reaches the k-th best lower bound are compared exactly.
        kth = np.partition(low, -min(k, len(ids)), axis=1)[:, -min(k, len(ids))]
        chosen = (estimate + error >= kth[:, None]) & (others > 0)
        for q, (query_id, key) in enumerate(zip(some["query_id"], some["key"])):
            near = np.flatnonzero(chosen[q])
            exact = (vectors[near] * queries[q]).sum(1) / (norms[near] * lengths[q])
            best = np.lexsort((ids[near], -exact))[:k]
            for x in np.repeat(best, np.minimum(k, others[q, near[best]]))[:k]:
                yield query_id, key, ids[near[x]], exact[x]


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(x, dtype=np.float64) for x in column])


def usable(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(vec_id, vector) of the vectors that take part.

    Left out are null ids, and vectors that are null, empty, zero, hold null or non-finite
    components, or have another length than most (the smaller length on a tie).
    """
    rows = df.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & finite).where(
        F.exists("vector", lambda x: x != 0)
    )
    lengths = rows.groupBy(F.size("vector").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    common = lengths.orderBy(F.desc("n"), "d").limit(1).collect()
    return rows.where(F.size("vector") == (common[0].d if common else 0))


def nearest(
    df: DataFrame, every: int = 50, k: int = 5, key: str = "vec_id", vector: str = "embedding",
    probed: float = PROBED,
) -> DataFrame:
    """The k nearest rows by cosine of every row whose id is divisible by ``every``.

    Returns query_id, rank (from 1), vec_id and score (the cosine in double precision), nearest
    first, ties to the smaller id; all candidates if there are fewer. Every row but the query's own
    is a candidate, also one with the same id: rows of a repeated id each have their own list, and
    equal rows (compared once, with their number) have equal lists. Cell centres are fitted on at most SAMPLE_ROWS rows of smallest id hash; every row is coded. A query meets the
    rows of its ``probed`` nearest cells, in tasks of CELL_ROWS rows and CELL_QUERIES queries;
    what the bounds of the estimates don't rule out is compared exactly there, so that only k
    rows for each query and task move on.
    """
    schema = "query_id long, rank int, vec_id long, score double"
    spark = df.sparkSession
    rows = usable(df, key, vector).groupBy("vec_id", "vector").agg(F.count(F.lit(1)).alias("copies"))
    # Told apart by 128 bits of a hash of id and components.
    written = F.concat(F.col("vec_id").cast("string"), F.lit(":"), F.array_join("vector", ","))
    rows = rows.withColumn("key", F.md5(written))
    total = rows.count()
    if not total:
        return spark.createDataFrame([], schema)
    sample = rows.orderBy(F.xxhash64("key"), "key").select("vector").limit(SAMPLE_ROWS).collect()
    unit = np.array([r.vector for r in sample])
    unit /= np.sqrt((unit**2).sum(1, keepdims=True))
    cells = min(MOST_CELLS, math.ceil(total / ROWS_PER_CELL), len(unit))
    codes = Codes(fit_centres(unit, cells), rotation(unit.shape[1]))
    probes = max(1, math.ceil(cells * probed))

    def coded(frames):
        for f in frames:
            if len(f):
                vectors = _matrix(f["vector"])
                unit = vectors / np.sqrt((vectors**2).sum(1, keepdims=True))
                cell = codes.cells(unit)[:, 0]
                packed, r, fit, along = codes.encode(unit, cell)
                f["cell"], f["code"], f["r"], f["fit"], f["along"] = cell, list(map(bytes, packed)), r, fit, along
                yield f

    def asking(frames):
        for f in frames:
            if len(f):
                vectors = _matrix(f["vector"])
                unit = vectors / np.sqrt((vectors**2).sum(1, keepdims=True))
                f["cells"] = list(codes.cells(unit, probes).astype(np.int32))
                yield f

    coded_rows = rows.mapInPandas(
        coded, "vec_id long, vector array<double>, copies long, key string, cell int, code binary, r double, fit double, along double"
    )
    queries = rows.where(F.col("vec_id") % every == 0).mapInPandas(
        asking, "vec_id long, vector array<double>, copies long, key string, cells array<int>"
    ).select(F.col("vec_id").alias("query_id"), "vector", "copies", "key", F.explode("cells").alias("cell"))

    # Rows and queries of each cell, as many numbers as cells: how often each side is split.
    def pieces(df, size):
        counts = df.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
        return {r.cell: math.ceil(r.n / size) for r in counts.collect()}

    row_parts, query_parts = pieces(coded_rows, CELL_ROWS), pieces(queries, CELL_QUERIES)
    splits = F.broadcast(
        spark.createDataFrame(
            [(c, row_parts.get(c, 1), query_parts.get(c, 1)) for c in range(cells)],
            "cell int, row_parts int, query_parts int",
        )
    )
    own = F.pmod(F.xxhash64("key"), F.col("row_parts")).cast("int")
    left = coded_rows.join(splits, "cell").withColumn("part", own).withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.col("query_parts") - 1))
    ).drop("row_parts", "query_parts")
    own = F.pmod(F.xxhash64("key"), F.col("query_parts")).cast("int")
    right = queries.join(splits, "cell").withColumn("block", own).withColumn(
        "part", F.explode(F.sequence(F.lit(0), F.col("row_parts") - 1))
    ).drop("row_parts", "query_parts")

    def compare(rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        found = list(_nearest(codes, k, rows, asked)) if len(rows) and len(asked) else []
        return pd.DataFrame(found, columns=["query_id", "key", "vec_id", "score"])

    met = left.groupBy("cell", "part", "block").cogroup(
        right.groupBy("cell", "part", "block")
    ).applyInPandas(compare, "query_id long, key string, vec_id long, score double")
    order = Window.partitionBy("query_id", "key").orderBy(F.desc("score"), "vec_id")
    ranked = met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    # Equal query rows were searched once; each gets the list.
    repeated = rows.where((F.col("vec_id") % every == 0) & (F.col("copies") > 1)).select("key", "copies")
    each = F.explode(F.sequence(F.lit(1), F.coalesce("copies", F.lit(1))))
    listed = ranked.join(repeated, "key", "left").withColumn("copy", each)
    return listed.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
