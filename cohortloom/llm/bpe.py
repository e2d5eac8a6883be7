"""Byte-level BPE: texts to token ids by a local rank file, and ids back to raw bytes."""

from __future__ import annotations

import base64
from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.shared import filled, map_arrow

#: Characters that go to the tokenizer at once; longer texts are cut at safe boundaries.
PART_CHARS = 1 << 15
#: White space as the tokenizer's pattern engine sees it (the property White_Space).
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Between an ASCII letter or digit and a space or line break, no match of the splitting
#: pattern goes across: words hold no white space and white space starts no earlier.
SAFE_CUT = r"(?<=[0-9A-Za-z])(?=[ \n])"


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a base64 token and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(t): int(r) for t, r in (x.split() for x in lines if x.strip())}


class Codec:
    """Encoder and decoder that a task builds once from the ranks."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex
        import tiktoken

        self.encoding = tiktoken.Encoding(
            "ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
        )
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.cut = regex.compile(SAFE_CUT)
        self.pieces = regex.compile(
            pattern.replace(r"[^\s", rf"[^{WHITE}").replace(r"\s", f"[{WHITE}]").replace(
                r"\S", f"[^{WHITE}]"
            )
        )

    def parts(self, text: str):
        """The text in parts of about PART_CHARS that may be encoded one by one."""
        start = 0
        while len(text) - start > PART_CHARS:
            found = self.cut.search(text, start + PART_CHARS)
            if not found:
                break
            yield text[start : found.start()]
            start = found.start()
        yield text[start:]

    def encode(self, text: str) -> list[int]:
        if len(text) <= PART_CHARS:
            return self.encoding.encode_ordinary(text)
        ids: list[int] = []
        for part in self.parts(text):
            if len(part) <= 2 * PART_CHARS:
                ids += self.encoding.encode_ordinary(part)
            else:
                # No boundary for long: matches one by one, since the library's pattern
                # engine runs out of stack on endless runs of white space.
                for match in self.pieces.finditer(part):
                    ids += self.encoding._encode_single_piece(match.group())
        return ids

    def decode(self, ids) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


def encode(
    df: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text", out: str = "ids"
) -> DataFrame:
    """Replace the text by its token ids, packed as little-endian unsigned 32-bit integers.

    Other columns stay, but one already named ``out`` is replaced. A null or empty text has
    no ids. Every match of ``pattern`` is merged on its own and no special token is known,
    so that strings that look like one are ordinary text.
    Rows never move: a row lost with its executor is encoded anew.
    """
    kept = [c for c in df.columns if c not in (text, out)]
    return _coded(df, ranks, pattern, kept, filled(text).alias(out), out, _packed)


def decode(
    df: DataFrame, ranks: dict[bytes, int], pattern: str, ids: str = "ids", out: str = "decoded"
) -> DataFrame:
    """Replace packed token ids by the bytes they stand for, which need not be valid text.

    A null cell decodes to no bytes; an id without a rank raises KeyError.
    """
    kept = [c for c in df.columns if c not in (ids, out)]
    cell = F.coalesce(F.col(ids), F.lit(b"")).alias(out)
    return _coded(df, ranks, pattern, kept, cell, out, _unpacked)


def _packed(codec: Codec, text: str) -> bytes:
    import numpy as np

    return np.array(codec.encode(text), dtype="<u4").tobytes()


def _unpacked(codec: Codec, cell: bytes) -> bytes:
    import numpy as np

    return codec.decode(np.frombuffer(cell, dtype="<u4").tolist())


def _coded(df, ranks, pattern, kept, cell, out, function) -> DataFrame:
    # A rank file is a fixed vocabulary: its size doesn't follow the data.
    shared = df.sparkSession.sparkContext.broadcast(ranks)

    def run(batches):
        codec = Codec(shared.value, pattern)
        for batch in batches:
            cells = pa.array([function(codec, x) for x in batch[out].to_pylist()], pa.binary())
            columns = [*(batch[c] for c in kept), cells]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, out])

    source = df.select(*kept, cell)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema[: len(kept)])
    return map_arrow(source, run, ", ".join(filter(None, (fields, f"`{out}` binary"))))


def round_trip(
    df: DataFrame, ranks: dict[bytes, int], pattern: str, keys: Sequence[str] = ("doc_id",)
) -> DataFrame:
    """Per document the key columns, its ids, and the bytes decoded from them."""
    coded = encode(df.select(*keys, "text"), ranks, pattern)
    again = coded.select(*keys, "ids", F.col("ids").alias("decoded"))
    return decode(again, ranks, pattern, "decoded", "decoded")


def digests(coded: DataFrame) -> DataFrame:
    """Sizes and SHA-256 of the ids and of the decoded bytes, computed in the JVM."""
    return coded.select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
