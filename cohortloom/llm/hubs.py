"""Pairs of sets, compared whole: hubs of very many pairs are sent a few times, not with each pair."""

from __future__ import annotations

import functools
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.shared import arrow_rows, map_arrow, written_table
from cohortloom.operators.scale import maybe_broadcast, skew_join

#: Sets that one copy of a frequent set is compared with.
CHUNK = 256


def folded(prints: np.ndarray, counts: np.ndarray | None, bits: int) -> list[int]:
    """A set, or a bag with counts, folded to bits: whether an odd number has the same remainder.

    Two sets differ in as many members as their folded bits, or more.
    """
    place = (prints % np.uint64(bits)).astype(np.int64)
    odd = np.bincount(place, weights=counts, minlength=bits).astype(np.int64) & 1
    return np.packbits(odd.astype(np.uint8)).view("<i8").tolist()


def differing_bits(one: Column, other: Column, bits: int) -> Column:
    """Bits in which two folded sets differ."""
    each = (F.bit_count(F.get(one, F.lit(i)).bitwiseXOR(F.get(other, F.lit(i)))) for i in range(bits // 64))
    return functools.reduce(lambda x, y: x + y, each)


def linked_pairs(pairs: DataFrame, sets: DataFrame, linked: Callable[[tuple, tuple], bool]) -> DataFrame:
    """The pairs (a, b) for which ``linked`` holds of the cells of both in ``sets``.

    ``sets`` has node and any further cells. ``a`` may be in very many pairs: it is sent once for
    every chunk of them, and a task holds one such set and a batch of others.
    """
    pairs = written_table(pairs, "pairs")
    many = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / CHUNK).alias("chunks"))
    chunk = F.pmod(F.xxhash64("b"), F.col("chunks"))
    split = written_table(skew_join(pairs, many, ["a"]).select("a", "b", chunk.alias("chunk")), "pairs")
    cells = [c for c in sets.columns if c != "node"]
    centres = split.select("a", "chunk").distinct()
    first = sets.withColumnRenamed("node", "a").join(maybe_broadcast(centres), "a")
    second = sets.withColumnRenamed("node", "b").join(maybe_broadcast(split), "b")
    columns = ["a", "chunk", "b", *cells]
    both = first.withColumn("b", F.lit(None).cast("binary")).select(*columns).unionByName(second.select(*columns))
    ordered = both.repartition("a", "chunk").sortWithinPartitions("a", "chunk", F.col("b").asc_nulls_first())

    def run(batches):
        def rows():
            centre = None
            for batch in batches:
                for a, _, b, *own in zip(*(c.to_pylist() for c in batch.columns)):
                    if b is None:
                        centre = own
                    elif linked(centre, own):
                        yield a, b

        yield from arrow_rows({"a": pa.binary(), "b": pa.binary()}, rows())

    return map_arrow(ordered, run, "a binary, b binary")
