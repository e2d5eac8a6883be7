"""Token ids in wavelet matrices: bit planes with rank directories, one file for each shard."""

from __future__ import annotations

import json
import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortloom.llm.shared import arrow_rows, filled, map_arrow, scratch_path

#: Bits that one entry of a rank directory counts.
RANK_BITS = 512
#: Ids of one matrix; a longer shard holds several, a longer document goes across them.
MATRIX_IDS = 1 << 19
#: Bytes of text that one shard takes; each shard learns its words anew.
SHARD_BYTES = 64 << 20
#: Shape of the files: a row for each matrix.
SCHEMA = "shard int, matrix int, n long, planes int, bits binary, ranks binary, docs binary, ends binary, split boolean"


class WaveletMatrix:
    """A sequence of ids as one bit plane for each bit, from the highest on.

    Each plane holds one bit of every id, in an order in which the ids with 0 in the plane
    before come first. The directory counts the ones before every RANK_BITS bits.
    """

    def __init__(self, n: int, planes: np.ndarray, ranks: np.ndarray):
        self.n, self.planes, self.ranks = n, planes, ranks
        self.ones = [self.rank(p, n) for p in range(len(planes))]

    @classmethod
    def build(cls, ids: np.ndarray, bits: int) -> WaveletMatrix:
        n = len(ids)
        width = -(-n // RANK_BITS) * (RANK_BITS // 8)
        planes = np.zeros((bits, width), dtype=np.uint8)
        ranks = np.zeros((bits, width * 8 // RANK_BITS + 1), dtype="<u4")
        order = ids.astype(np.uint16) if bits <= 16 else ids
        for p in range(bits):
            bit = (order & order.dtype.type(1 << (bits - 1 - p))).astype(bool)
            planes[p, : -(-n // 8)] = np.packbits(bit)
            counts = np.bitwise_count(planes[p].view("<u8").reshape(-1, RANK_BITS // 64)).sum(1)
            ranks[p, 1:] = np.cumsum(counts)
            before, order = order, np.empty_like(order)
            zeros = n - int(ranks[p, -1])
            np.compress(~bit, before, out=order[:zeros])
            np.compress(bit, before, out=order[zeros:])
        return cls(n, planes, ranks)

    @classmethod
    def load(cls, n: int, bits: int, planes: bytes, ranks: bytes) -> WaveletMatrix:
        return cls(
            n,
            np.frombuffer(planes, np.uint8).reshape(bits, -1),
            np.frombuffer(ranks, "<u4").reshape(bits, -1),
        )

    def rank(self, plane: int, at: int) -> int:
        """Ones of a plane before position ``at``."""
        block, rest = divmod(at, RANK_BITS)
        row = self.planes[plane]
        byte, left = divmod(rest, 8)
        first = block * (RANK_BITS // 8)
        count = int(self.ranks[plane, block]) + int(np.bitwise_count(row[first : first + byte]).sum())
        return count + (int(row[first + byte]) >> (8 - left)).bit_count() if left else count

    def select(self, plane: int, bit: int, k: int) -> int:
        """Position of the k-th (from 0) bit of a kind in a plane, by halving over ranks."""
        low, high = 0, self.n
        while low < high:
            middle = (low + high) // 2
            ones = self.rank(plane, middle + 1)
            if (ones if bit else middle + 1 - ones) <= k:
                low = middle + 1
            else:
                high = middle
        return low

    def access(self, at: int) -> int:
        """The id at a position."""
        if not 0 <= at < self.n:
            raise IndexError(at)
        value = 0
        for p in range(len(self.planes)):
            ones = self.rank(p, at)
            bit = self.rank(p, at + 1) - ones
            at = self.n - self.ones[p] + ones if bit else at - ones
            value = value * 2 + bit
        return value

    def _range(self, value: int, start: int, end: int) -> tuple[int, int]:
        bits = len(self.planes)
        if value >> bits:
            return 0, 0
        for p in range(bits):
            a, b = self.rank(p, start), self.rank(p, end)
            if value >> (bits - 1 - p) & 1:
                zeros = self.n - self.ones[p]
                start, end = zeros + a, zeros + b
            else:
                start, end = start - a, end - b
        return start, end

    def count(self, value: int, start: int = 0, end: int | None = None) -> int:
        """Occurrences of an id between two positions."""
        a, b = self._range(value, start, self.n if end is None else end)
        return b - a

    def locate(self, value: int, k: int) -> int:
        """Position of the k-th (from 0) occurrence of an id."""
        start, end = self._range(value, 0, self.n)
        if not 0 <= k < end - start:
            raise IndexError(k)
        at = start + k
        for p in reversed(range(len(self.planes))):
            bit = value >> (len(self.planes) - 1 - p) & 1
            zeros = self.n - self.ones[p]
            at = self.select(p, bit, at - zeros if bit else at)
        return at

    def decode(self) -> np.ndarray:
        """All ids in order: every plane, from the last, puts its rows back where they were."""
        value = np.zeros(self.n, dtype=np.uint16 if len(self.planes) <= 16 else np.uint32)
        for p in reversed(range(len(self.planes))):
            bit = np.unpackbits(self.planes[p], count=self.n).view(bool)
            zeros = self.n - self.ones[p]
            value[zeros:] |= value.dtype.type(1 << (len(self.planes) - 1 - p))
            back = np.empty_like(value)
            back[~bit], back[bit] = value[:zeros], value[zeros:]
            value = back
        return value.astype(np.uint32)


class WordCodec:
    """Ids of whole texts by a tokenizer file, with each different word encoded once.

    The file's normaliser and splitter work on a text as a whole; within Latin-1 text without
    control characters they come to lower-casing and the splitter's own pattern, so that words
    may be looked up. Such texts are cut all at once, by the kinds of their bytes in Latin-1, and the
    different words among them are told apart by Arrow. Any other text goes to the library whole, as
    does one that holds the content of an added token, in letters of either case.
    """

    #: Words kept between batches, and words that go to the library as one text.
    MOST_WORDS, JOINED_WORDS = 600_000, 100
    #: Kinds of bytes in Latin-1.
    BLANK, LETTER, DIGIT, SIGN = range(4)

    def __init__(self, definition: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self._forget()
        # Signs that count as numbers are odd, as are control characters.
        self.odd = re.compile(r"[^\t\n\r -~¡-±´-¸º»¿-ÿ]")
        self.kinds = np.full(256, self.SIGN, dtype=np.uint8)
        self.kinds[list(b"\t\n\r ")] = self.BLANK
        self.kinds[list(b"0123456789")] = self.DIGIT
        letters = "abcdefghijklmnopqrstuvwxyzªµº" + "".join(map(chr, range(0xDF, 0x100))).replace("÷", "")
        self.kinds[list(letters.encode("latin-1"))] = self.LETTER
        file = json.loads(definition)
        # Words that are lower-cased and cut already need neither the normaliser nor the splitter.
        splitter = file.get("pre_tokenizer") or {}
        after = [p for p in splitter.get("pretokenizers", [splitter]) if p and p["type"] != "Split"]
        bare = {"type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, *after]}
        self.by_word = Tokenizer.from_str(
            json.dumps(file | {"normalizer": None, "added_tokens": [], "pre_tokenizer": bare})
        )
        self.added = [t["content"].lower() for t in file.get("added_tokens") or ()]
        ending = file["model"].get("end_of_word_suffix") or ""
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        if ending:
            self.ends[[i for token, i in vocabulary.items() if token.endswith(ending)]] = True

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        plain = [self._plain(t) for t in texts]
        odd = iter(self._library([t for t, data in zip(texts, plain) if data is None], self.tokenizer))
        looked_up = iter(self._look_up([data for data in plain if data is not None]))
        return [next(odd) if data is None else next(looked_up) for data in plain]

    def _plain(self, text: str) -> bytes | None:
        """The lower-cased bytes of a text whose words may be looked up; None for any other."""
        if self.odd.search(text):
            return None
        lower = text.lower()
        return None if any(a in lower for a in self.added) else lower.encode("latin-1")

    def _look_up(self, texts: list[bytes]) -> list[np.ndarray]:
        """Ids of texts by their words."""
        data = b" ".join(texts)
        if not data:
            return [np.empty(0, dtype="<u4")] * len(texts)
        edges = self._edges(data)
        # What lies between edges, blanks too, as one column over the bytes as they are.
        cells = pa.Array.from_buffers(
            pa.large_binary(), len(edges) - 1, [None, pa.py_buffer(edges), pa.py_buffer(data)]
        ).dictionary_encode()
        places = self._places(cells.dictionary)[cells.indices.to_numpy()]
        counts = self.sizes[places]
        after = np.cumsum(counts)
        ids = self.ids[np.repeat(self.starts[places] - after + counts, counts) + np.arange(after[-1])]
        # A text's first word starts at or after its first byte.
        firsts = np.cumsum([len(t) + 1 for t in texts[:-1]], dtype=np.int64)
        return np.split(ids, np.append(0, after)[np.searchsorted(edges[:-1], firsts)])

    def _places(self, words: pa.Array) -> np.ndarray:
        """Where different words stand among the known ones, the new ones learned."""
        if len(self.known) > self.MOST_WORDS:
            self._forget()
        places = pc.index_in(words, value_set=self.known)
        absent = places.is_null()
        places = places.fill_null(0).to_numpy(zero_copy_only=False)
        if pc.any(absent).as_py():
            new, at = words.filter(absent), absent.to_numpy(zero_copy_only=False)
            places = places.copy()
            places[at] = len(self.known) + np.arange(len(new))
            sizes, ids = self._learned(new.to_pylist())
            self.known = pa.concat_arrays([self.known, new])
            self.starts = np.append(self.starts, len(self.ids) + np.cumsum(sizes) - sizes)
            self.sizes = np.append(self.sizes, sizes)
            self.ids = np.append(self.ids, ids)
        return places

    def _forget(self) -> None:
        """No words but the empty one are known."""
        self.known = pa.array([b""], pa.large_binary())
        self.starts, self.sizes, self.ids = np.zeros(1, np.int64), np.zeros(1, np.int64), np.empty(0, "<u4")

    def _edges(self, data: bytes) -> np.ndarray:
        """Where the splitter's words and the blanks between them begin, and the end of the bytes.

        Letters, signs and blanks run on, every digit is a word; an apostrophe before which no sign
        stands takes the letters of 's 't 'm 'd 're 've 'll with it.
        """
        raw = np.frombuffer(data, np.uint8)
        kinds = self.kinds[raw]
        starts = np.flatnonzero((kinds[1:] != kinds[:-1]) | (kinds[1:] == self.DIGIT)) + 1
        edges = np.concatenate([[0], starts, [len(raw)]])
        lone = np.flatnonzero((raw[edges[:-1]] == ord("'")) & (np.diff(edges) == 1))
        lone = lone[edges[lone] + 1 < len(raw)]
        first = raw[edges[lone] + 1]
        second = raw[np.minimum(edges[lone] + 2, len(raw) - 1)]
        second[edges[lone] + 2 >= len(raw)] = 0
        taken = np.isin(first, list(b"stmd")) + 2 * (
            np.isin(first, list(b"rv")) & (second == ord("e")) | (first == ord("l")) & (second == ord("l"))
        )
        edges[lone + 1] += taken
        return edges

    def _learned(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of ids of words, and the ids: many words go as one text, cut after the tokens that end a word."""
        sizes, out = np.zeros(len(words), np.int64), []
        full = np.array([not w.isspace() for w in words])
        firsts = range(0, len(words), self.JOINED_WORDS)
        groups = [words[i : i + self.JOINED_WORDS] for i in firsts]
        for i, group, ids in zip(firsts, groups, self._library([b" ".join(g).decode("latin-1") for g in groups], self.by_word)):
            places = i + np.flatnonzero(full[i : i + len(group)])
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) == len(places):
                sizes[places] = np.diff(ends, prepend=0)
                out.append(ids)
            else:
                single = self._library([w.decode("latin-1") for w in group], self.by_word)
                sizes[i : i + len(group)] = [len(x) for x in single]
                out += single
        return sizes, np.concatenate(out)

    @staticmethod
    def _library(texts: list[str], tokenizer) -> list[np.ndarray]:
        found = tokenizer.encode_batch_fast(texts, add_special_tokens=False) if texts else []
        return [np.array(x.ids, dtype="<u4") for x in found]


def write_shards(
    df: DataFrame, path: str, definition: str, end_id: int, text: str = "text", key: str = "doc_id"
) -> None:
    """Encode every whole text, end each with ``end_id``, and write the ids in key order.

    Shards are ranges of keys (null keys first, equal keys in the order of their texts' hashes)
    of about SHARD_BYTES of text; each is one sorted file at ``path`` with a row for each matrix:
    number of ids, bit planes and rank directory, and the keys and ends of the documents that end in
    it. A null text is empty and has just the end id. A lost task writes its file anew.
    """
    import os

    rows = df.select(F.col(key).cast("long").alias("key"), filled(text).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text") + 16)).head()[0] or 1
    shards = math.ceil(size / SHARD_BYTES)
    ordered = rows.repartitionByRange(
        shards, F.col("key").asc_nulls_first(), F.xxhash64("text")
    ).sortWithinPartitions(F.col("key").asc_nulls_first(), F.xxhash64("text"), "text")
    placed = ordered.select(F.spark_partition_id().alias("shard"), "key", "text")

    def run(batches):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        codec = WordCodec(definition)
        bits = max(1, max(end_id, codec.tokenizer.get_vocab_size() - 1).bit_length())
        yield from arrow_rows(_cells(), _matrices(batches, codec, end_id, bits), 8)

    map_arrow(placed, run, SCHEMA).write.option("compression", "zstd").parquet(path)


def _cells():
    return {
        "shard": pa.int32(), "matrix": pa.int32(), "n": pa.int64(), "planes": pa.int32(),
        "bits": pa.binary(), "ranks": pa.binary(), "docs": pa.binary(), "ends": pa.binary(),
        "split": pa.bool_(),
    }


def _matrices(batches, codec: WordCodec, end_id: int, bits: int) -> Iterator[tuple]:
    held, room, docs, ends, matrix, shard = [], MATRIX_IDS, [], [], 0, 0
    # Keys are 64-bit numbers; the smallest stands for null.
    null = np.iinfo(np.int64).min

    def full(split: bool) -> tuple:
        ids = np.concatenate(held)
        made = WaveletMatrix.build(ids, bits)
        return (
            shard, matrix, len(ids), bits, made.planes.tobytes(), made.ranks.tobytes(),
            np.array(docs, "<i8").tobytes(), np.array(ends, "<i8").tobytes(), split,
        )

    for batch in batches:
        keys, shards = batch["key"].to_pylist(), batch["shard"].to_pylist()
        coded = codec.encode(batch["text"].to_pylist())
        for doc, shard, ids in zip(keys, shards, coded):
            ids = np.append(ids, np.uint32(end_id))
            while len(ids) > room:
                held.append(ids[:room])
                yield full(True)
                ids = ids[room:]
                held, room, docs, ends, matrix = [], MATRIX_IDS, [], [], matrix + 1
            held.append(ids)
            room -= len(ids)
            docs.append(null if doc is None else doc)
            ends.append(MATRIX_IDS - room)
            if not room:
                yield full(False)
                held, room, docs, ends, matrix = [], MATRIX_IDS, [], [], matrix + 1
    if held:
        yield full(False)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """The matrices as they were written."""
    return spark.read.schema(SCHEMA).parquet(path)


def read_documents(spark: SparkSession, path: str, key: str = "doc_id") -> DataFrame:
    """Per document of the files its place and ids, decoded from the bit planes.

    Returns key, start (ids before it in all files), n_tokens and ids_crc32 (of the ids as
    little-endian unsigned 32-bit integers). Every matrix is decoded by itself; of a document
    that goes across matrices, the checksum is put together from those of its pieces.
    """
    files = read_shards(spark, path)
    # One row for each matrix: half a million ids.
    sizes = files.groupBy("shard").agg(F.sum("n").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shard_start"))

    def run(batches):
        cells = {"shard": pa.int32(), "matrix": pa.int32(), "piece": pa.int32(), "key": pa.int64(),
                 "ends_here": pa.bool_(), "n": pa.int64(), "crc": pa.int64()}
        yield from arrow_rows(cells, _pieces(batches))

    pieces = map_arrow(
        files, run, "shard int, matrix int, piece int, key long, ends_here boolean, n long, crc long"
    )
    place = Window.partitionBy("shard").orderBy("matrix", "piece").rowsBetween(
        Window.unboundedPreceding, -1
    )
    # A shard's documents are a bounded number: its texts have a bounded size.
    numbered = pieces.select(
        "*",
        F.coalesce(F.sum("n").over(place), F.lit(0)).alias("at"),
        F.coalesce(F.sum(F.col("ends_here").cast("long")).over(place), F.lit(0)).alias("doc"),
    )
    whole = numbered.groupBy("shard", "doc").agg(
        F.max("key").alias("key"),
        F.min("at").alias("at"),
        F.sum("n").alias("n"),
        F.array_sort(F.collect_list(F.struct("matrix", "piece", "n", "crc"))).alias("parts"),
    )
    joined = F.when(F.size("parts") == 1, F.col("parts")[0]["crc"]).otherwise(_joined_crc("parts"))
    null = F.col("key") == F.lit(int(np.iinfo(np.int64).min))
    return whole.join(F.broadcast(starts), "shard").select(
        F.when(~null, F.col("key")).alias(key),
        (F.col("shard_start") + F.col("at")).alias("start"),
        F.col("n").alias("n_tokens"),
        joined.alias("ids_crc32"),
    )


def _pieces(batches) -> Iterator[tuple]:
    for batch in batches:
        for row in batch.to_pylist():
            made = WaveletMatrix.load(row["n"], row["planes"], row["bits"], row["ranks"])
            data = made.decode().astype("<u4").tobytes()
            docs = np.frombuffer(row["docs"], "<i8").tolist()
            ends = np.frombuffer(row["ends"], "<i8").tolist()
            at = 0
            for piece, (doc, end) in enumerate(zip(docs, ends)):
                yield row["shard"], row["matrix"], piece, doc, True, end - at, zlib.crc32(data[4 * at : 4 * end])
                at = end
            if row["split"]:
                yield row["shard"], row["matrix"], len(docs), None, False, row["n"] - at, zlib.crc32(data[4 * at :])


def crc32_joined(first: int, second: int, size: int) -> int:
    """The checksum of two byte strings put together, from theirs and the second's size."""
    zeros = bytes(1 << 16)
    shifted, plain = first, 0
    # The checksum is affine over bits: zeros in the place of the second move the first along.
    while size:
        step = min(size, len(zeros))
        shifted, plain = zlib.crc32(zeros[:step], shifted), zlib.crc32(zeros[:step], plain)
        size -= step
    return shifted ^ plain ^ second


def _joined_crc(parts: str):
    @F.pandas_udf("long")
    def join(column: pd.Series) -> pd.Series:
        out = []
        for pieces in column:
            crc = 0
            for piece in pieces:
                crc = crc32_joined(crc, piece["crc"], 4 * piece["n"])
            out.append(crc)
        return pd.Series(out, dtype="int64")

    return join(F.col(parts))


def round_trip(
    df: DataFrame, definition: str, end_id: int, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """Write the shards into the shared scratch folder and read the documents back."""
    path = scratch_path(df.sparkSession, "wavelet")
    write_shards(df, path, definition, end_id, text, key)
    return read_documents(df.sparkSession, path, key)
