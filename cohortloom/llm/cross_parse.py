"""Language identification by cross-parsing: how few phrases of a language spell a text."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.llm.shared import filled, map_arrow

#: Bound of the sample that is fitted: texts of each language, and bytes of their joined text.
TRAIN_ROWS = 64
TRAIN_BYTES = 1 << 14
#: Bytes of a text that are parsed in step with others; a phrase ends where its block ends.
BLOCK = 512
#: Bytes that are parsed at once; a multiple of the block.
STEP_BYTES = 1 << 20
#: Places of a long text from which its share of the learned bytes is taken.
PIECES = 4
UNDETERMINED = "und"


def held_out(key: Column, folds: int = 5) -> Column:
    """Whether a row is kept from learning: crc32 of its key as text is a multiple of folds."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % folds == 0, F.lit(False))


def suffix_automaton(text: bytes) -> list[dict[int, int]]:
    """Transitions of the smallest automaton that reads exactly the substrings of ``text``."""
    follow: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for symbol in text:
        new = len(follow)
        follow.append({})
        link.append(0)
        length.append(length[last] + 1)
        at = last
        while at >= 0 and symbol not in follow[at]:
            follow[at][symbol] = new
            at = link[at]
        if at >= 0:
            target = follow[at][symbol]
            if length[target] != length[at] + 1:
                copy = len(follow)
                follow.append(dict(follow[target]))
                link.append(link[target])
                length.append(length[at] + 1)
                while at >= 0 and follow[at].get(symbol) == target:
                    follow[at][symbol] = copy
                    at = link[at]
                link[target] = copy
                target = copy
            link[new] = target
        last = new
    return follow


class Model:
    """One automaton for each language, as tables that parse many texts in step.

    ``classes`` maps a byte to its column; bytes that no language has share one column, and
    the last column is padding. A cell holds the offset of the next state's row, or, where
    no phrase goes on, the complement of the row that reading the byte from the start gives.
    A byte that a language lacks leads to a last row, from which every byte is a new phrase.
    """

    def __init__(self, texts: dict[str, bytes]):
        self.languages = sorted(texts)
        seen = sorted(set(b"".join(texts.values())))
        self.classes = np.full(256, len(seen), dtype=np.int64)
        self.classes[seen] = np.arange(len(seen))
        self.padding = len(seen) + 1
        width = len(seen) + 2
        self.tables, self.bits = [], []
        for language in self.languages:
            follow = suffix_automaton(texts[language])
            start = np.full(width, len(follow) * width, dtype=np.int64)
            for symbol, target in follow[0].items():
                start[self.classes[symbol]] = target * width
            table = np.tile(~start, (len(follow) + 1, 1))
            table[0] = start
            for state, moves in enumerate(follow):
                if moves:
                    table[state, self.classes[list(moves)]] = np.array([*moves.values()]) * width
            table[:, self.padding] = 0
            self.tables.append(table.astype(np.int32).ravel())
            self.bits.append(math.log2(max(2, len(texts[language]))))

    def phrases(self, texts: list[bytes]) -> np.ndarray:
        """Phrases of every text (rows) in every language (columns)."""
        out = np.zeros((len(texts), len(self.tables)), dtype=np.int64)
        held: list[tuple[int, bytes]] = []
        room = STEP_BYTES
        for i, text in enumerate(texts):
            for at in range(0, len(text), STEP_BYTES):
                part = text[at : at + STEP_BYTES]
                if len(part) > room and held:
                    np.add.at(out, [i for i, _ in held], self._parsed([t for _, t in held]))
                    held, room = [], STEP_BYTES
                held.append((i, part))
                room -= len(part)
        if held:
            np.add.at(out, [i for i, _ in held], self._parsed([t for _, t in held]))
        return out

    def _parsed(self, texts: list[bytes]) -> np.ndarray:
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        blocks = -(-sizes // BLOCK)
        first = np.concatenate([[0], np.cumsum(blocks)])
        grid = np.full(first[-1] * BLOCK, self.padding, dtype=np.int64)
        flat = self.classes[np.frombuffer(b"".join(texts), dtype=np.uint8)]
        gap = first[:-1] * BLOCK - (np.cumsum(sizes) - sizes)
        grid[np.arange(len(flat)) + np.repeat(gap, sizes)] = flat
        steps = np.ascontiguousarray(grid.reshape(-1, BLOCK).T)
        out = np.zeros((len(texts), len(self.tables)), dtype=np.int64)
        rows = np.repeat(np.arange(len(texts)), blocks)
        for k, table in enumerate(self.tables):
            state = np.zeros(first[-1], dtype=np.int64)
            count = np.zeros(first[-1], dtype=np.int64)
            for column in steps:
                state = table[state + column].astype(np.int64)
                ended = state >> 63
                count -= ended
                state ^= ended
            # Where a block ends, the phrase under way is one more.
            out[:, k] = np.bincount(rows, weights=count + 1, minlength=len(texts))
        return out

    def rates(self, texts: list[bytes]) -> np.ndarray:
        """Estimated bits for each byte: phrases times the bits that name one, by length."""
        sizes = np.maximum(1, [len(t) for t in texts])
        return self.phrases(texts) * np.array(self.bits) / sizes[:, None]


def training_texts(
    df: DataFrame, text: str, label: str, key: str, rows: int = TRAIN_ROWS, size: int = TRAIN_BYTES
) -> dict[str, bytes]:
    """At most ``size`` bytes of text for each label, from ``rows`` different texts picked by their hash.

    Held-out rows, null labels and texts without a letter are left out. Every text gives an equal
    share, so that one odd text cannot pass for its language; what short texts leave goes to the
    longer ones, whose share comes from places all over the text. The driver gets no more than
    ``rows`` texts of ``size`` characters for each label, however often a key repeats.
    """
    usable = df.where(
        ~held_out(F.col(key)) & F.col(key).isNotNull() & F.col(label).isNotNull()
        & F.col(text).rlike(r"\p{L}")
    ).select(F.col(label).alias("label"), F.col(text).alias("text"), F.xxhash64(text).alias("order"))
    # Only hashes are ranked, copies once; a task passes no more than ``rows`` of a label on.
    place = F.row_number().over(Window.partitionBy("label").orderBy("order"))
    hashes = usable.select("label", "order").distinct()
    picked = hashes.withColumn("place", place).where(F.col("place") <= rows).drop("place")
    chosen = usable.join(F.broadcast(picked), ["label", "order"])
    texts = chosen.select("label", "order", _spread("text", size).alias("text")).distinct()
    found: dict[str, list[bytes]] = {}
    for row in sorted(texts.collect(), key=lambda r: (r.label, r.order, r.text)):
        found.setdefault(row.label, []).append(prepared(row.text))
    return {label: _shares(texts, size) for label, texts in found.items()}


def _spread(text: str, size: int) -> Column:
    """A text of at most ``size`` characters whole, else pieces of equal length from all over it."""
    step = (F.length(text) - F.lit(size // PIECES)) / (PIECES - 1)
    pieces = [F.substring(text, F.floor(step * i).cast("int") + 1, F.lit(size // PIECES)) for i in range(PIECES)]
    return F.when(F.length(text) <= size, F.col(text)).otherwise(F.concat(*pieces))


def _shares(texts: list[bytes], size: int) -> bytes:
    """The texts' shares of ``size`` bytes, the shortest first, so that what they leave is shared."""
    parts, left = [], size
    for i, text in enumerate(sorted(texts, key=len)):
        room = max(PIECES, left // (len(texts) - i) - 1)
        if len(text) > room:
            long = room // PIECES
            starts = (k * (len(text) - long) // (PIECES - 1) for k in range(PIECES))
            text = b"".join(text[at : at + long] for at in starts)
        parts.append(text)
        left -= len(text) + 1
    return b"\n".join(parts)[:size]


def prepared(text: str) -> bytes:
    return text.lower().encode()


def with_language(
    df: DataFrame, model: Model, text: str = "text", pred: str = "lang_pred", score: str = "score"
) -> DataFrame:
    """All columns, and the language of every whole text with its score.

    The language whose automaton spells the text with the fewest normalised phrases wins, ties
    go to the first name. ``score`` is the lead over the second, from 0 to 1 (1 if only one
    language was learned). A text that is null or has no letter is 'und' with score 0, and so
    is every text if nothing was learned. Rows don't move and each gives one row. Columns that
    are already named ``pred`` or ``score`` give way.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in df.columns if c not in (pred, score)]
    inner = [f"c{i}" for i in range(len(kept))]

    def run(batches):
        import regex

        letter, model = regex.compile(r"\p{L}"), shared.value
        for batch in batches:
            cells = batch["text"].to_pylist()
            known = [i for i, t in enumerate(cells) if letter.search(t)] if model.languages else []
            language, lead = [UNDETERMINED] * len(cells), [0.0] * len(cells)
            if known:
                rates = model.rates([prepared(cells[i]) for i in known])
                order = np.argsort(rates, axis=1, kind="stable")
                for row, i in enumerate(known):
                    best = rates[row, order[row, 0]]
                    second = rates[row, order[row, 1]] if rates.shape[1] > 1 else math.inf
                    language[i] = model.languages[order[row, 0]]
                    lead[i] = float(1 - best / second)
            columns = [batch[c] for c in inner]
            columns += [pa.array(language, pa.string()), pa.array(lead, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*inner, "pred", "score"])

    source = df.select(
        *(F.col(f"`{c}`").alias(i) for c, i in zip(kept, inner)), filled(text).alias("text")
    )
    told = [T.StructField("pred", T.StringType()), T.StructField("score", T.DoubleType())]
    found = map_arrow(source, run, T.StructType([*source.schema.fields[: len(kept)], *told]))
    return found.toDF(*kept, pred, score)


def predict(df: DataFrame, model: Model, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Language of every whole text (key, lang_pred, score), as ``with_language`` finds it."""
    source = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return with_language(source, model).select(F.col("key").alias(key), "lang_pred", "score")
