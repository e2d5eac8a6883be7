"""Building blocks that keep hot keys and long orders off a single task."""

from __future__ import annotations

import math
import re
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Rows one task may sort or one key may hold before the work is split.
ROWS_PER_TASK = 10_000_000
# Narrow rows (keys and a few numbers) that may be sent to every executor.
BROADCAST_ROWS = 200_000

_local_scratch: dict[str, str] = {}


def scratch_path(spark: SparkSession, label: str) -> str:
    """Fresh folder under the shared ``spark.checkpoint.dir``.

    Only a session that runs in one process may go without that setting; it then gets a
    temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        # "local-cluster[...]" has executors of its own, which need the shared folder.
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        app = spark.sparkContext.applicationId
        if app not in _local_scratch:
            _local_scratch[app] = tempfile.mkdtemp(prefix="cohortloom-")
        base = _local_scratch[app]
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def written_table(df: DataFrame, label: str) -> DataFrame:
    """Write once to shared storage and read back.

    Cuts the lineage of a result used several times; a lost executor costs nothing.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(scan: DataFrame) -> DataFrame:
    """Repartition a table scan that comes in fewer pieces than there are cores.

    For scans in front of costly row work; a large table passes unchanged.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores)


def order_bounds(df: DataFrame, order: str, buckets: int) -> list[float]:
    """Boundaries that cut ``order`` into buckets of similar size, by approximate quantiles."""
    shares = [i / buckets for i in range(1, buckets)]
    position = _position(df, order)
    found = df.agg(F.percentile_approx(position, shares, max(10_000, 20 * buckets))).head()[0]
    # The bucketizer wants two buckets or more; an empty one does no harm.
    return [-math.inf, *(sorted(set(found or [])) or [0.0]), math.inf]


def _position(df: DataFrame, order: str) -> Column:
    position = F.col(order)
    if df.schema[order].dataType.simpleString() in ("date", "timestamp_ntz"):
        position = position.cast("timestamp")
    return position.cast("double")


def _sum_before(value: Column, keys: list[str], order: list[str]) -> Column:
    earlier = Window.partitionBy(*keys).orderBy(*order)
    earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(earlier), F.lit(0)).cast("long")


def _frequent_keys(df: DataFrame, keys: list[str], rows: int) -> tuple[DataFrame, int]:
    """The keys of more than ``rows`` rows with the pieces each is cut into, and all their rows.

    There are no more of them than the table has pieces of that size; they are written once.
    """
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    known = counted.where(F.col("n_rows") > rows).dropna(subset=keys)
    parts = F.ceil(F.col("n_rows") / rows).cast("int").alias("parts")
    hot = written_table(known.select(*keys, "n_rows", parts), "hot-keys")
    return hot.select(*keys, "parts"), hot.agg(F.sum("n_rows")).head()[0] or 0


def _mark_parts(df: DataFrame, hot: DataFrame, keys: list[str]) -> DataFrame:
    """Add ``parts``: pieces a hot key is cut into, 1 for other keys."""
    marked = df.join(maybe_broadcast(hot), keys, "left")
    return marked.withColumn("parts", F.coalesce("parts", F.lit(1)))


def running_total(
    df: DataFrame,
    value: Column,
    out: str,
    keys: Sequence[str] = (),
    order: Sequence[str] = (),
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Add the sum of ``value`` over the earlier rows of the same key (keys not NULL).

    ``order`` must be unique per key and start with a numeric, date or timestamp
    column. Keys are counted first; while none exceeds ``rows_per_task`` this is one
    window per key. Larger keys, and the whole table when there are no keys, are cut
    into order buckets: totals per bucket give each bucket's start and the window runs
    inside the buckets, so that no task holds a hot key.
    """
    keys, order, value = list(keys), list(order), value.cast("long")
    if keys:
        hot, split_rows = _frequent_keys(df, keys, rows_per_task)
        if not split_rows:
            return df.withColumn(out, _sum_before(value, keys, order))
        marked = _mark_parts(df, hot, keys)
    else:
        split_rows = df.count()
        marked = df.withColumn("parts", F.lit(2))
    is_hot = F.col("parts") > 1

    # The bounds cut the rows of all hot keys together, wherever in the order each key lies.
    buckets = max(2, math.ceil(split_rows / rows_per_task))
    bounds = order_bounds(marked.where(is_hot), order[0], buckets)
    split = Bucketizer(splits=bounds, inputCol="position", outputCol="bucket").transform(
        marked.withColumn("position", _position(df, order[0]))
    )
    split = split.withColumn("bucket", F.when(is_hot, F.col("bucket")).otherwise(-1.0))
    totals = split.where(is_hot).groupBy(*keys, "bucket").agg(F.sum(value).alias("total"))
    # A row per bucket and key reaches this window.
    starts = totals.select(
        *keys, "bucket", _sum_before(F.col("total"), keys, ["bucket"]).alias("start")
    )
    inside = _sum_before(value, [*keys, "bucket"], order)
    placed = split.join(starts, [*keys, "bucket"], "left")
    start = F.coalesce("start", F.lit(0))
    return placed.withColumn(out, start + inside).select(*df.columns, out)


def maybe_broadcast(small: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint only after counting no more than ``limit`` rows."""
    return F.broadcast(small) if small.limit(limit + 1).count() <= limit else small


def skew_join(
    big: DataFrame,
    small: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    hot_rows: int = ROWS_PER_TASK,
    broadcast_rows: int = BROADCAST_ROWS,
    count_on: DataFrame | None = None,
) -> DataFrame:
    """Join ``big`` to ``small`` (one row per key) without sending a hot key to one task.

    A small side of at most ``broadcast_rows`` rows, counted first, is broadcast and
    ``big`` does not move; pass 0 where its rows are wide. Otherwise the most frequent
    keys are counted, on ``count_on`` where a cheaper table has the same frequencies. The
    keys above ``hot_rows`` each get a salt per ``hot_rows`` of their rows, and their row of ``small`` is repeated for every salt, which adds no more
    rows than ``big`` has pieces. All other rows have salt 0: it stays one equi-join.
    """
    on = list(on)
    if broadcast_rows and small.limit(broadcast_rows + 1).count() <= broadcast_rows:
        return big.join(F.broadcast(small), on, how)
    hot, split_rows = _frequent_keys(count_on if count_on is not None else big, on, hot_rows)
    if not split_rows:
        return big.join(small, on, how)
    others = [c for c in big.columns if c not in on] or on
    salt = F.pmod(F.xxhash64(*others), F.col("parts")).cast("int")
    salted = _mark_parts(big, hot, on).withColumn("salt", salt)
    repeated = _mark_parts(small, hot, on).withColumn(
        "salt", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    )
    joined = salted.drop("parts").join(repeated.drop("parts"), [*on, "salt"], how)
    return joined.drop("salt")
