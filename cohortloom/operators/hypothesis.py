"""Tests on actual against predicted values: permutation, Wald and signed ranks.

Input is a table of pairs (entity_id, actual, predicted); a missing value is NULL.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.functions import digests
from cohortloom.operators.scale import ROWS_PER_TASK, running_total, skew_join, written_table

# Half-width of the uncertain zone around the split point, in standard deviations.
ZONE_SIGMAS = 10.0
# Significance level of every decision.
ALPHA = 0.05
# Bits that the largest value of a pool may take as a whole number.
VALUE_BITS = 52
# Distinct values that a task draws from, and buckets of them at most.
VALUES_PER_BUCKET, MOST_BUCKETS = 50_000, 1_000
# Rows that the generator of the draws can take.
MOST_DRAWN = 1_000_000_000
# Hashes of permuted rows that a task computes.
HASHES_PER_TASK = 100_000_000
# Bits of the lower part of a value: sums of either part fit 64 bits.
LOW_BITS = 26
# Exact whole numbers wider than a BIGINT.
_WIDE = "decimal(38,0)"


@F.pandas_udf(T.DoubleType())
def _two_sided_p(z: pd.Series) -> pd.Series:
    """Two-sided normal p-value; only ever sees the single summary row of a test."""
    return z.map(lambda v: math.erfc(abs(v) / math.sqrt(2)), na_action="ignore")


def _pool(pairs: DataFrame) -> DataFrame:
    """Both columns stacked: row_id, is_x, value as a double; missing and NaN values are left out."""

    def side(column: str, prefix: str, is_x: bool) -> DataFrame:
        return pairs.where(F.col(column).isNotNull()).select(
            F.concat(F.lit(prefix), F.col("entity_id").cast("string")).alias("row_id"),
            F.lit(is_x).alias("is_x"),
            F.col(column).cast("double").alias("value"),
        )

    both = side("actual", "a", True).unionByName(side("predicted", "p", False))
    return both.where(~F.isnan("value"))


def _times_power(value: Column, power: int) -> Column:
    """value * 2^power, in two steps so that the factors stay finite."""
    half = power // 2
    return value * F.lit(2.0**half) * F.lit(2.0 ** (power - half))


def _whole_values(pool: DataFrame) -> tuple[DataFrame, int]:
    """Values as whole numbers (``scaled``, a multiple of 2^-power) and the power.

    A power that keeps every value exactly is used where one is small enough; else the largest
    value takes VALUE_BITS bits, and the others are rounded to its last bit, as adding doubles does.
    """
    largest = pool.agg(F.max(F.abs("value"))).head()[0] or 0.0
    if math.isinf(largest):
        raise ValueError("the permutation test needs finite values")
    most = VALUE_BITS - (math.frexp(largest)[1] if largest else 0)
    steps = [p for p in range(0, max(0, most) + 1, 4) if p < most] + [most]
    whole = [
        F.count_if(F.rint(_times_power(F.col("value"), p)) != _times_power(F.col("value"), p)).alias(str(p))
        for p in steps
    ]
    broken = pool.agg(*whole).head()
    power = next((p for p in steps if not broken[str(p)]), most)
    scaled = F.rint(_times_power(F.col("value"), power)).cast("long")
    return pool.select("row_id", "is_x", scaled.alias("scaled")), power


def permutation_test(
    pairs: DataFrame, permutations: int = 1000, seed: str = "42", method: str = "draws"
) -> DataFrame:
    """Share of random splits whose mean difference exceeds the observed one, strictly.

    Values may be any finite doubles: they are taken as whole multiples of a power of two, so
    that sums and the comparison are exact. Either column may lack values; each keeps all it has.
    ``draws`` samples, for every permutation, how often each distinct value falls into the first
    sample; ``order`` sorts the rows by a hash, which SQL can repeat. Pools of MOST_DRAWN rows
    or more are always ordered.
    """
    pool, power = _whole_values(_pool(pairs))
    wide = F.col("scaled").cast(_WIDE)
    size = pool.agg(
        F.count_if("is_x").alias("n_x"),
        F.count_if(~F.col("is_x")).alias("n_y"),
        F.sum(F.when(F.col("is_x"), wide)).alias("s_x"),
        F.sum(F.when(~F.col("is_x"), wide)).alias("s_y"),
    ).head()
    n_x, n_y = size.n_x, size.n_y
    if not n_x or not n_y:
        raise ValueError("both samples need at least one value")
    n, total = n_x + n_y, int(size.s_x) + int(size.s_y)
    observed = abs(int(size.s_x) * n_y - int(size.s_y) * n_x)
    if method == "draws" and n < MOST_DRAWN:
        sums = _drawn_sums(pool, permutations, seed, n_x)
    elif method in ("draws", "order"):
        sums = _ordered_sums(pool, permutations, seed, n_x, n)
    else:
        raise ValueError(f"unknown method: {method}")
    difference = F.abs(F.col("s_x") * F.lit(n).cast(_WIDE) - F.lit(str(total * n_x)).cast(_WIDE))
    above = F.count_if(difference > F.lit(str(observed)).cast(_WIDE))
    return sums.agg(above.alias("n_above"), F.count(F.lit(1)).alias("n_permutations")).select(
        F.lit(n_x).cast("long").alias("n_x"),
        F.lit(n_y).cast("long").alias("n_y"),
        F.lit(math.ldexp(observed / (n_x * n_y), -power)).alias("statistic"),
        "n_permutations",
        "n_above",
        (F.col("n_above") / F.col("n_permutations")).alias("p_value"),
    )


def _ordered_sums(pool: DataFrame, permutations: int, seed: str, n_x: int, n: int) -> DataFrame:
    """s_x of every permutation, by sorting rows.

    Permutation k orders the pool by md5(seed|k|row) and puts the first n_x rows in the
    first sample. That cut lies near the share n_x/n of the hash range: hashes well
    below it are only summed, those well above are dropped, and just the few around it
    (about sqrt(n) per permutation) are ranked. Work spreads over rows and
    permutations alike; a task hashes its rows for many permutations at once and sums in place.
    """
    share = n_x / n
    zone = ZONE_SIGMAS * math.sqrt(share * (1 - share) / n)

    def hash_at(position: float) -> int:
        return 16**15 if position >= 1 else int(max(position, 0.0) * 16**15)

    low_end, high_end = hash_at(share - zone), hash_at(share + zone)
    schema = "perm int, place binary, n long, high long, low long"
    types = [pa.int32(), pa.binary(), *[pa.int64()] * 3]
    names = [part.split()[0] for part in schema.split(", ")]
    low_bits, held_rows, most_bytes = LOW_BITS, digests.CHUNK, digests.MAX_BYTES
    salted_md5, leading, digest_bytes = digests.salted_md5, digests.leading, digests.digest_bytes

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        below = np.zeros((permutations, 3), dtype=np.int64)

        def batch(*cells) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cells, types)], names=names)

        def zone_rows(ids: list[bytes] | None, value: np.ndarray, prefixes: list[bytes]) -> Iterator[pa.RecordBatch]:
            """Adds the rows below the zone to the sums and gives those inside it."""
            high, low = value >> low_bits, value & ((1 << low_bits) - 1)
            # Sums of this many rows are exact in doubles.
            parts = np.stack([np.ones(len(value)), high, low], axis=1)
            for part, words in salted_md5(ids if ids is not None else [b""], prefixes):
                lead = leading(words)
                # Rows without an id have no place of their own.
                first = lead < np.uint64(low_end if ids is not None else high_end)
                if ids is None:
                    first = np.repeat(first, len(value), axis=1)
                below[part] += np.rint(first.astype(np.float64) @ parts).astype(np.int64)
                if ids is not None:
                    at = np.nonzero((lead >= np.uint64(low_end)) & (lead < np.uint64(high_end)))
                    if len(at[0]):
                        places = [d + ids[i] for d, i in zip(digest_bytes(words, at), at[1].tolist())]
                        ones = np.ones(len(places), dtype=np.int64)
                        yield batch(at[0] + part.start, places, ones, high[at[1]], low[at[1]])

        def rows_of(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(held)
            ids, value = table["row_id"].cast(pa.binary()).to_pylist(), table["value"].to_numpy()
            prefixes = [f"{seed}|{k}|".encode() for k in range(permutations)]
            kind = np.array([-1 if i is None else len(i) + len(prefixes[-1]) > most_bytes for i in ids])
            for k in (0, 1):
                if (kind == k).any():
                    yield from zone_rows([ids[i] for i in np.flatnonzero(kind == k)], value[kind == k], prefixes)
            if (kind == -1).any():
                yield from zone_rows(None, value[kind == -1], [p[:-1] for p in prefixes])

        held, size = [], 0
        for one in batches:
            held, size = [*held, one], size + one.num_rows
            if size >= held_rows:
                yield from rows_of(held)
                held, size = [], 0
        if size:
            yield from rows_of(held)
        n_below, high, low = below.T
        yield batch(np.arange(permutations), [None] * permutations, n_below, high, low)

    tasks = max(pool.sparkSession.sparkContext.defaultParallelism, math.ceil(n * permutations / HASHES_PER_TASK))
    rows = pool.select("row_id", F.col("scaled").alias("value")).repartition(tasks, "row_id")
    # Rows below the zone share one group per permutation; zone rows are their own.
    groups = rows.mapInArrow(sums, schema).where("n > 0").repartition("perm").groupBy("perm", "place").agg(
        *[F.sum(c).alias(c) for c in ("n", "high", "low")]
    )
    filled = F.expr(
        "sum(n) over (partition by perm order by place asc nulls first "
        "rows between unbounded preceding and current row)"
    )
    inside = F.col("filled") <= n_x
    per_perm = (
        groups.withColumn("filled", filled)
        .groupBy("perm")
        .agg(
            F.sum(F.when(inside, F.col("high"))).alias("high"),
            F.sum(F.when(inside, F.col("low"))).alias("low"),
            F.count_if(F.col("filled") == n_x).alias("cut_found"),
        )
    )
    s_x = F.col("high").cast(_WIDE) * F.lit(1 << LOW_BITS).cast("decimal(9,0)") + F.col("low").cast(_WIDE)
    return per_perm.select(
        F.when(F.col("cut_found") == 1, s_x.cast(_WIDE)).otherwise(
            F.raise_error(F.lit("split point outside its zone; raise ZONE_SIGMAS")).cast(_WIDE)
        ).alias("s_x")
    )


def _drawn_sums(pool: DataFrame, permutations: int, seed: str, n_x: int) -> DataFrame:
    """s_x of every permutation, by multivariate hypergeometric draws from the counts of values.

    A split's sum depends only on how many of each distinct value fall into the first sample.
    The pool collapses to counts of values, on the map side. Buckets of values are drawn from
    first, in the driver, which sees a number for each bucket and permutation; a task then draws
    from the values of its bucket. Work is distinct values times permutations. The same seed
    gives the same draws, however the rows are partitioned.
    """
    counts = pool.groupBy("scaled").agg(F.count(F.lit(1)).alias("n"))
    counts = written_table(counts, "values")
    buckets = min(MOST_BUCKETS, max(1, math.ceil(counts.count() / VALUES_PER_BUCKET)))
    dealt = counts.withColumn("bucket", F.pmod(F.xxhash64("scaled"), F.lit(buckets)).cast("int"))
    sizes = {r.bucket: r.n for r in dealt.groupBy("bucket").agg(F.sum("n").alias("n")).collect()}
    start = list(hashlib.sha256(seed.encode()).digest())
    names = sorted(sizes)
    first = np.random.default_rng([*start, 0]).multivariate_hypergeometric(
        [sizes[b] for b in names], n_x, size=permutations, method="marginals"
    )
    shares = {b: first[:, i].copy() for i, b in enumerate(names)}

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def sums(bucket: int, held: list[pa.RecordBatch]) -> pa.RecordBatch:
            table = pa.Table.from_batches(held)
            value, n = table["scaled"].to_numpy(), table["n"].to_numpy()
            rng = np.random.default_rng([*start, 1, bucket])
            # Two halves of the bits, so that sums of 1e9 rows fit 64 bits.
            high, low = value >> 26, value & ((1 << 26) - 1)
            drawn = (rng.multivariate_hypergeometric(n, int(k), method="marginals") for k in shares[bucket])
            found = [(int(d @ high), int(d @ low)) for d in drawn]
            cells = [pa.array(range(permutations), pa.int32()), *(pa.array(x, pa.int64()) for x in zip(*found))]
            return pa.RecordBatch.from_arrays(cells, names=["perm", "high", "low"])

        held: list[pa.RecordBatch] = []
        for batch in batches:
            bucket = batch["bucket"].to_numpy()
            edges = [0, *(np.flatnonzero(bucket[1:] != bucket[:-1]) + 1).tolist(), len(bucket)]
            for a, b in zip(edges[:-1], edges[1:]):
                if a < b and held and held[0]["bucket"][0].as_py() != bucket[a]:
                    yield sums(held[0]["bucket"][0].as_py(), held)
                    held = []
                if a < b:
                    held.append(batch.slice(a, b - a))
        if held:
            yield sums(held[0]["bucket"][0].as_py(), held)

    ordered = dealt.repartition(buckets, "bucket").sortWithinPartitions("bucket", "scaled")
    partial = ordered.mapInArrow(draw, "perm int, high long, low long")
    whole = F.sum(F.col("high").cast(_WIDE)) * F.lit(1 << 26).cast("decimal(9,0)") + F.sum(F.col("low").cast(_WIDE))
    return partial.groupBy("perm").agg(whole.cast(_WIDE).alias("s_x")).select("s_x")


def wald_test(pairs: DataFrame) -> DataFrame:
    """z = (m1 - m2) / sqrt(v1/n1 + v2/n2) and its two-sided normal p-value."""
    a, p = F.col("actual").cast("double"), F.col("predicted").cast("double")
    s = pairs.agg(
        (F.avg(a) - F.avg(p)).alias("difference"),
        (F.var_samp(a) / F.count(a) + F.var_samp(p) / F.count(p)).alias("variance"),
    )
    z = s.select(F.try_divide("difference", F.sqrt("variance")).alias("statistic"))
    return z.withColumn("p_value", _two_sided_p("statistic"))


def _differences(pairs: DataFrame) -> DataFrame:
    diff = F.col("actual") - F.col("predicted")
    return pairs.select("entity_id", diff.alias("diff")).where("diff <> 0")


def _tie_groups(pairs: DataFrame, rows_per_task: int) -> DataFrame:
    """Per absolute difference: counts by sign and the lowest rank of the group.

    Rows collapse to distinct values on the map side, which are written once; the ranks are a
    running total over those, cut into order buckets.
    """
    groups = _differences(pairs).groupBy(F.abs("diff").alias("abs_diff")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("diff") > 0).alias("n_positive")
    )
    ranked = running_total(
        written_table(groups, "ties"), F.col("n"), "earlier", order=["abs_diff"], rows_per_task=rows_per_task
    )
    return ranked.select("abs_diff", "n", "n_positive", (F.col("earlier") + 1).alias("low_rank"))


def signed_ranks(pairs: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """entity_id, diff, signed_rank of every non-zero difference; ties share the lowest rank."""
    ranks = _tie_groups(pairs, rows_per_task).select("abs_diff", "low_rank")
    rows = _differences(pairs).withColumn("abs_diff", F.abs("diff"))
    joined = skew_join(rows, ranks, ["abs_diff"])
    signed = F.when(F.col("diff") > 0, F.col("low_rank")).otherwise(-F.col("low_rank"))
    return joined.select("entity_id", "diff", signed.alias("signed_rank"))


def _rank_sums(pairs: DataFrame, rank: Column, rows_per_task: int) -> DataFrame:
    """n, smaller rank sum and tie term, as one row."""
    negative = F.col("n") - F.col("n_positive")
    t = F.col("n").cast("double")
    sums = _tie_groups(pairs, rows_per_task).agg(
        F.sum("n").cast("double").alias("n"),
        F.sum(rank * F.col("n_positive").cast("decimal(18,0)")).alias("w_positive"),
        F.sum(rank * negative.cast("decimal(18,0)")).alias("w_negative"),
        F.sum(t * t * t - t).alias("ties"),
    )
    smaller = F.least("w_positive", "w_negative").cast("double")
    return sums.select("n", smaller.alias("statistic"), "ties")


def wilcoxon_simple(pairs: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """T with lowest ranks on ties and p = 2 * (1 - |z|), z = (T - 0.5) / (n(n+1)(2n+1)/6).

    Kept as defined by its users although this p is no probability.
    """
    rank = F.col("low_rank").cast("decimal(18,0)")
    sums = _rank_sums(pairs, rank, rows_per_task)
    n = F.col("n")
    z = F.try_divide(F.col("statistic") - 0.5, n * (n + 1) * (2 * n + 1) / 6)
    return sums.select(n.cast("long").alias("n"), "statistic", (2 * (1 - F.abs(z))).alias("p_value"))


def wilcoxon_normal(pairs: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """The signed-rank test with mean ranks on ties and a normal p-value."""
    rank = (F.col("low_rank") + (F.col("n") - 1) / 2).cast("decimal(18,1)")
    sums = _rank_sums(pairs, rank, rows_per_task)
    n = F.col("n")
    mean = n * (n + 1) / 4
    variance = n * (n + 1) * (2 * n + 1) / 24 - F.col("ties") / 48
    z = F.try_divide(F.col("statistic") - mean, F.sqrt(variance))
    return sums.select(n.cast("long").alias("n"), "statistic", z.alias("z")).withColumn(
        "p_value", _two_sided_p("z")
    )


def decision(p_value: Column, alpha: float = ALPHA) -> Column:
    return F.when(p_value <= alpha, "Reject H0").otherwise("Fail to Reject H0")


def test_decisions(
    pairs: DataFrame, permutations: int = 1000, seed: str = "42", method: str = "draws"
) -> DataFrame:
    """test, statistic, p_value, decision of all tests on the same pairs.

    The permutation and Wald tests use all values of each column, paired or not; the signed
    ranks use the entities that have both.
    """
    results = {
        "permutation": permutation_test(pairs, permutations, seed, method),
        "wald": wald_test(pairs),
        "wilcoxon_simple": wilcoxon_simple(pairs),
        "wilcoxon_normal": wilcoxon_normal(pairs),
    }
    rows = [
        df.select(F.lit(name).alias("test"), "statistic", "p_value")
        for name, df in results.items()
    ]
    table = rows[0]
    for row in rows[1:]:
        table = table.unionByName(row)
    return table.withColumn("decision", decision(F.col("p_value")))


# The name starts with "test" by trade, not for the test runner.
test_decisions.__test__ = False
