"""Documents in packs, and questions about fingerprints that packs ask each other.

A pack is a row that holds the compressed texts of about a megabyte of documents. To learn which of its
fingerprints also occur elsewhere, a pack sends its distinct ones, sorted and split by their
leading bits into parts, a row for each part; a task that holds a part merges what the packs
sent and answers with a bit for each. So the rows that Spark moves are few and compact, a
fingerprint that is in a third of all documents costs a part one entry for each pack, and the
texts stay where they are.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.llm.shared import arrow_rows, filled, map_arrow, scratch_path

#: Least bytes of text in a pack, and what it grows by with the square root of all bytes, so
#: that neither packs nor the parts they send become too many.
PACK_BYTES, PACK_GROWTH = 1 << 20, 8
#: Fingerprints that a task merges.
PART_ENTRIES = 1_000_000


def write_packs(
    df: DataFrame, text: str = "text", key: str = "doc_id", ordered: bool = False,
    pack_bytes: int | None = None, carried: Sequence[str] = (),
) -> tuple[DataFrame, int]:
    """Pack all rows into a table in the shared scratch folder; also returns the bytes of text.

    With ``ordered``, the packs' numbers follow the keys, null keys first. Null texts are empty.
    ``carried`` names columns that go along with their types, as a struct in ``more``.
    """
    more = F.struct(*(F.col(f"`{c}`") for c in carried)) if carried else F.lit(None).cast("string")
    rows = df.select(
        F.col(key).cast("long").alias("key"), more.alias("more"), filled(text).alias("text")
    )
    total = rows.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    size = pack_bytes or max(PACK_BYTES, PACK_GROWTH * math.isqrt(total))
    if ordered:
        order = F.col("key").asc_nulls_first(), F.xxhash64("text")
        ranges = max(1, math.ceil(total / (8 * size)))
        rows = rows.repartitionByRange(ranges, *order).sortWithinPartitions(*order, "text")
    placed = rows.select(F.spark_partition_id().alias("place"), "key", "more", "text")

    schema = T.StructType([
        T.StructField("pack", T.LongType()), T.StructField("keys", T.ArrayType(T.LongType())),
        T.StructField("sizes", T.ArrayType(T.IntegerType())),
        T.StructField("more", T.ArrayType(placed.schema["more"].dataType)),
        T.StructField("text", T.BinaryType()),
    ])

    def gather(batches):
        batches = iter(batches)
        first = next(batches, None)
        if first is None:
            return
        cells = {"pack": pa.int64(), "keys": pa.list_(pa.int64()), "sizes": pa.list_(pa.int32()),
                 "more": pa.list_(first.schema.field("more").type), "text": pa.binary()}

        def packed():
            docs, held, number, place = [], 0, 0, 0

            def pack():
                keys, more, texts = map(list, zip(*docs))
                data = zstandard.ZstdCompressor(level=3).compress(b"".join(texts))
                return place << 32 | number, keys, [*map(len, texts)], more, data

            for batch in itertools.chain([first], batches):
                for place, key, more, text in zip(*(c.to_pylist() for c in batch.columns)):
                    data = text.encode()
                    if held and held + len(data) > size:
                        yield pack()
                        docs, held, number = [], 0, number + 1
                    docs.append((key, more, data))
                    held += len(data) + 16
            if docs:
                yield pack()

        yield from arrow_rows(cells, packed(), 1)

    path = scratch_path(df.sparkSession, "packs")
    map_arrow(placed, gather, schema).write.parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path), total


def squeezed(values: np.ndarray) -> bytes:
    """Sorted unsigned integers, as compressed bytes of their differences."""
    steps = np.diff(values, prepend=values.dtype.type(0))
    planes = np.ascontiguousarray(steps.view(np.uint8).reshape(len(steps), -1).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unsqueezed(data: bytes, dtype=np.uint64) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    width = np.dtype(dtype).itemsize
    steps = np.ascontiguousarray(planes.reshape(width, -1).T).view(dtype).ravel()
    return np.cumsum(steps, dtype=dtype)


def parts_for(entries: int) -> int:
    """Parts, a power of two, so that each merges about PART_ENTRIES fingerprints."""
    return 1 << max(0, math.ceil(math.log2(max(1, entries / PART_ENTRIES))))


def exchange(packs: DataFrame, send: Callable, answer: Callable, parts: int) -> DataFrame:
    """Ask all packs' parts a question and return the answers, a row for each pack.

    ``send`` turns a pack's row (a dict) into sorted distinct 64-bit fingerprints and a tuple of
    arrays that go with them. ``answer`` gets the fingerprints of a part from all packs, sorted
    by fingerprint and then by pack, with the numbers of their packs and the arrays, and returns
    a boolean for each. The result has pack and ``answers``, the bits by part, for
    ``answers_of``. Fingerprints should be spread evenly.
    """
    shift = 64 - parts.bit_length() + 1

    def split(batches):
        def rows():
            for row in pack_rows(batches):
                prints, more = send(row)
                number = (prints >> np.uint64(shift)).astype(np.int64) if parts > 1 else np.zeros(len(prints), np.int64)
                edges = np.searchsorted(number, np.arange(parts + 1))
                for part in np.flatnonzero(np.diff(edges)):
                    a, b = edges[part], edges[part + 1]
                    payload = squeezed(prints[a:b]), *(m[a:b].tobytes() for m in more)
                    yield int(part), row["pack"], b"".join(len(x).to_bytes(8, "little") + x for x in payload)

        yield from arrow_rows({"part": pa.int32(), "pack": pa.int64(), "payload": pa.binary()}, rows(), 256)

    def merge(batches):
        def rows():
            held: dict[int, list] = {}
            for batch in batches:
                for part, pack, payload in zip(*(c.to_pylist() for c in batch.columns)):
                    # Rows come sorted by part: one part is in memory at a time.
                    if held and part not in held:
                        yield from _answered(held, answer)
                        held = {}
                    held.setdefault(part, []).append((pack, payload))
            yield from _answered(held, answer)

        yield from arrow_rows({"part": pa.int32(), "pack": pa.int64(), "bits": pa.binary()}, rows(), 256)

    sent = map_arrow(packs, split, "part int, pack long, payload binary")
    gathered = sent.repartition(parts, "part").sortWithinPartitions("part")
    answered = map_arrow(gathered, merge, "part int, pack long, bits binary")
    return answered.groupBy("pack").agg(F.collect_list(F.struct("part", "bits")).alias("answers"))


def _answered(held: dict[int, list], answer: Callable) -> Iterator[tuple]:
    for part, entries in held.items():
        entries.sort(key=lambda e: e[0])
        fields = []
        for _, payload in entries:
            cells, at = [], 0
            while at < len(payload):
                n = int.from_bytes(payload[at : at + 8], "little")
                cells.append(payload[at + 8 : at + 8 + n])
                at += 8 + n
            fields.append((unsqueezed(cells[0]), cells[1:]))
        sizes = [len(p) for p, _ in fields]
        prints = np.concatenate([p for p, _ in fields])
        packs = np.repeat(np.array([p for p, _ in entries], dtype=np.int64), sizes)
        more = [
            np.concatenate([np.frombuffer(c[i], f"V{len(c[i]) // n}") for (_, c), n in zip(fields, sizes)])
            for i in range(len(fields[0][1]))
        ]
        order = np.argsort(prints, kind="stable")
        found = np.zeros(len(prints), dtype=bool)
        found[order] = answer(prints[order], packs[order], [m[order] for m in more])
        at = 0
        for (pack, _), n in zip(entries, sizes):
            yield part, pack, np.packbits(found[at : at + n]).tobytes()
            at += n


def answers_of(prints: np.ndarray, answers, parts: int) -> np.ndarray:
    """The booleans for the fingerprints that a pack sent, in their order."""
    shift = 64 - parts.bit_length() + 1
    number = (prints >> np.uint64(shift)).astype(np.int64) if parts > 1 else np.zeros(len(prints), np.int64)
    edges = np.searchsorted(number, np.arange(parts + 1))
    out = np.zeros(len(prints), dtype=bool)
    for cell in answers or ():
        a, b = edges[cell["part"]], edges[cell["part"] + 1]
        out[a:b] = np.unpackbits(np.frombuffer(cell["bits"], np.uint8), count=b - a)
    return out


def with_answers(packs: DataFrame, *answers: DataFrame) -> DataFrame:
    """Packs joined with what they were answered (pack, answers), as answers0, answers1 and so on."""
    for i, found in enumerate(answers):
        named = found.withColumnRenamed("answers", f"answers{i}")
        packs = packs.join(named.hint("shuffle_hash"), "pack", "left")
    return packs


def pack_rows(batches) -> Iterator[dict]:
    """Rows of packs one by one, with sizes as an array, ``more`` as Arrow holds it and the plain text."""
    for batch in batches:
        plain = batch.select([c for c in batch.schema.names if c != "more"])
        for i in range(batch.num_rows):
            row = plain.slice(i, 1).to_pylist()[0]
            row["more"] = batch.column("more")[i].values
            row["sizes"] = np.array(row["sizes"], dtype=np.int64)
            row["text"] = zstandard.ZstdDecompressor().decompress(row["text"])
            yield row


def scrambled(x: np.ndarray) -> np.ndarray:
    """Mix 64-bit numbers so that all their bits depend on each other."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def byte_codes(seed: int) -> np.ndarray:
    """A random odd 64-bit number for each byte."""
    return np.random.default_rng(seed).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def rolling(codes: np.ndarray, width: int, base: int) -> np.ndarray:
    """Polynomial hash, modulo 2^64, of every run of ``width`` codes, by doubling the runs."""
    out, covered, power, span = None, 0, codes, 1
    n = len(codes)
    if n < width:
        return np.zeros(0, np.uint64)
    left = width
    while left:
        if left & 1:
            if out is None:
                out, covered = power, span
            else:
                m = n - covered - span + 1
                out = out[:m] * np.uint64(pow(base, span, 1 << 64)) + power[covered : covered + m]
                covered += span
        left >>= 1
        if left:
            m = n - 2 * span + 1
            power = power[:m] * np.uint64(pow(base, span, 1 << 64)) + power[span : span + m]
            span *= 2
    return scrambled(out[: n - width + 1])
