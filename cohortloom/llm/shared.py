"""Helpers that the text operators share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.operators.scale import scratch_path, written_table

__all__ = [
    "arrow_rows", "broadcast_texts", "documents", "filled", "free_name", "map_arrow", "row_id",
    "scratch_path", "written_table",
]

#: Bytes of a batch that goes to a Python worker; one long text may exceed it alone.
BATCH_BYTES = 4 << 20
#: Bytes of texts that may be sent to every executor.
BROADCAST_BYTES = 16 << 20
_BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The table of documents, only the columns asked for."""
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(*columns)


def filled(column: str = "text"):
    """A text column with null as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def free_name(df: DataFrame, stem: str) -> str:
    """The stem, with underscores after it until the table has no such column in any case."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem += "_"
    return stem


def row_id(key: str, text: str) -> Column:
    """128 bits that tell rows of different key or text apart; nulls differ from empty texts."""
    cells = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in (key, text)]
    return F.unhex(F.md5(F.concat_ws(":", *cells)))


def broadcast_texts(df: DataFrame, source: DataFrame, text: str) -> DataFrame:
    """Broadcast hint only if the texts that ``df`` is made of have few bytes in all."""
    size = source.agg(F.sum(F.octet_length(text) + 64)).head()[0] or 0
    return F.broadcast(df) if size <= BROADCAST_BYTES else df


def map_arrow(df: DataFrame, function, schema: str) -> DataFrame:
    """``mapInArrow`` with batches bounded in bytes, so that long texts fit the workers.

    A batch size that the session already sets is kept.
    """
    spark = df.sparkSession
    if spark.conf.get(_BATCH_CONF, None) is None:
        spark.conf.set(_BATCH_CONF, str(BATCH_BYTES))
    return df.mapInArrow(_releasing(function), schema)


def _releasing(function):
    """The function, giving free memory back to the system between batches and at its end.

    Spark keeps Python workers for later tasks, and with them all that their allocators hold.
    """

    def release():
        import ctypes
        import gc

        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)

    def run(batches):
        for i, batch in enumerate(function(batches)):
            yield batch
            if i % 16 == 15:
                release()
        release()

    return run


def arrow_rows(
    columns: dict[str, pa.DataType], rows: Iterator[tuple], size: int = 4096, room: int = 2 << 20
) -> Iterator[pa.RecordBatch]:
    """Rows gathered into record batches, cut by rows and by bytes of their binary cells."""
    names, types = list(columns), list(columns.values())
    held, weight = [], 0
    for row in rows:
        held.append(row)
        weight += sum(len(x) for x in row if isinstance(x, (bytes, str)))
        if len(held) >= size or weight >= room:
            yield _batch(held, names, types)
            held, weight = [], 0
    if held:
        yield _batch(held, names, types)


def _batch(rows, names, types):
    cells = [pa.array(column, t) for column, t in zip(zip(*rows), types)]
    return pa.RecordBatch.from_arrays(cells, names=names)
