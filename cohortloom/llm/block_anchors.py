"""Repeated windows of words, found from fixed blocks and extended to maximal repeats."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.llm import packs as pk
from cohortloom.llm.shared import arrow_rows, map_arrow

#: Words of a window that counts as a repeat.
WINDOW = 35
# Fixed value: the bytes between words are the space and 0x09 to 0x0D.
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F)


class Words:
    """The words of a pack: where each starts and ends, its document, and two hashes of it (or one)."""

    def __init__(self, text: bytes, sizes: np.ndarray, families: int = 2):
        data = np.frombuffer(text, np.uint8)
        self.doc_ends = np.cumsum(sizes)
        blank = _BLANK[data]
        # A document's first byte starts a word, whatever stands before it.
        first = np.zeros(len(data) + 1, dtype=bool)
        first[self.doc_ends - sizes] = True
        before = np.concatenate([[True], blank[:-1]]) | first[:-1] if len(data) else blank
        after = np.concatenate([blank[1:], [True]]) if len(data) else blank
        last = first[1:].copy()
        if len(last):
            last[-1] = True
        self.start = np.flatnonzero(~blank & before)
        self.end = np.flatnonzero(~blank & (after | last)) + 1
        self.doc = np.searchsorted(self.doc_ends, self.start, side="right")
        self.counts = np.bincount(self.doc, minlength=len(sizes))
        self.doc_first = np.cumsum(self.counts) - self.counts
        self.hashes = [self._hashes(data, seed, base) for seed, base in enumerate(_BASES[:families])]

    def _hashes(self, data: np.ndarray, seed: int, base: int) -> np.ndarray:
        """Polynomial hash of every word from prefix sums of the codes of its bytes."""
        codes, n = pk.byte_codes(seed)[data], len(data)
        out = np.zeros(len(self.start), dtype=np.uint64)
        if not n:
            return out
        powers = _powers(base, n)
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(codes * powers)])
        back = _powers(pow(base, -1, 1 << 64), n)
        size = (self.end - self.start).astype(np.uint64)
        return pk.scrambled((total[self.end] - total[self.start]) * back[self.start] + size)

    def inside(self, width: int) -> np.ndarray:
        """Whether the run of ``width`` words from each word on ends in the same document."""
        n = len(self.doc)
        return self.doc[: n - width + 1] == self.doc[width - 1 :] if n >= width else np.zeros(0, bool)

    def place(self) -> np.ndarray:
        """Every word's number in its document."""
        return np.arange(len(self.doc)) - self.doc_first[self.doc]


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, dtype=np.uint64)
    span = 1
    while span < n:
        out[span : 2 * span] = out[: min(span, n - span)] * np.uint64(pow(base, span, 1 << 64))
        span *= 2
    return out


def _distinct(prints: np.ndarray):
    """Sorted distinct fingerprints, the number of each one's occurrences, and each one's place."""
    return np.unique(prints, return_inverse=True, return_counts=True)


class _Blocks:
    """First question: which runs of a block's length equal a reference block elsewhere?"""

    def __init__(self, window: int, keep_bits: int):
        # Every window of 2 b - 1 words holds a whole block of b words that starts at a multiple.
        self.width = (window + 1) // 2
        self.drop = np.uint64(64 - keep_bits)

    def prints(self, words: Words):
        rolled = pk.rolling(words.hashes[0], self.width, _BASES[2])
        inside = words.inside(self.width)
        return (rolled[inside] >> self.drop) << self.drop, np.flatnonzero(inside)

    def send(self, row: dict):
        words = Words(row["text"], row["sizes"])
        prints, at = self.prints(words)
        distinct, inverse, counts = _distinct(prints)
        reference = np.zeros(len(distinct), dtype=np.uint8)
        reference[inverse[words.place()[at] % self.width == 0]] = 1
        return distinct, (reference | (counts > 1).astype(np.uint8) << 1,)

    @staticmethod
    def answer(prints, packs, more):
        flags = more[0].view(np.uint8)
        return _by_print(prints, lambda s, n: (n > 1) | (np.maximum.reduceat(flags >> 1, s) > 0)) & _by_print(
            prints, lambda s, n: np.maximum.reduceat(flags & 1, s) > 0
        )


class _Windows:
    """Second question: which windows around such runs occur elsewhere?"""

    def __init__(self, window: int, blocks: _Blocks, parts: int):
        self.window, self.blocks, self.parts = window, blocks, parts

    def prints(self, words: Words, answers):
        """Two fingerprints of every window that a hit block lies in, and the windows' places."""
        block, at = self.blocks.prints(words)
        distinct, inverse, _ = _distinct(block)
        hit = np.zeros(len(words.doc) + 1, dtype=np.int64)
        hit[at] = pk.answers_of(distinct, answers, self.parts)[inverse]
        before = np.concatenate([[0], np.cumsum(hit)])
        inside = words.inside(self.window)
        n = len(inside)
        reach = self.window - self.blocks.width + 1
        near = before[reach : n + reach] - before[:n] > 0
        places = np.flatnonzero(inside & near)
        main, check = (pk.rolling(h, self.window, _BASES[2])[places] for h in words.hashes) if n else (places.astype(np.uint64),) * 2
        return main, check.astype(np.uint32), places

    def sent(self, row: dict):
        words = Words(row["text"], row["sizes"])
        main, check, places = self.prints(words, row["answers0"])
        order = np.lexsort((check, main))
        main, check = main[order], check[order]
        new = np.ones(len(main), dtype=bool)
        new[1:] = (main[1:] != main[:-1]) | (check[1:] != check[:-1])
        group = np.cumsum(new) - 1
        return words, main[new], check[new], np.bincount(group, minlength=0), group, places[order]

    def send(self, row: dict):
        _, main, check, counts, _, _ = self.sent(row)
        return main, (check, (counts > 1).astype(np.uint8))

    @staticmethod
    def answer(prints, packs, more):
        check, many = more[0].view(np.uint32), more[1].view(np.uint8)
        order = np.lexsort((check, prints))
        main, second = prints[order], check[order]
        new = np.ones(len(main), dtype=bool)
        new[1:] = (main[1:] != main[:-1]) | (second[1:] != second[:-1])
        start = np.flatnonzero(new)
        size = np.diff(np.append(start, len(main)))
        found = np.zeros(len(main), dtype=bool)
        if len(main):
            found[order] = np.repeat((size > 1) | (np.maximum.reduceat(many[order], start) > 0), size)
        return found


def _by_print(prints: np.ndarray, verdict) -> np.ndarray:
    if not len(prints):
        return np.zeros(0, dtype=bool)
    start = np.flatnonzero(np.concatenate([[True], prints[1:] != prints[:-1]]))
    size = np.diff(np.append(start, len(prints)))
    return np.repeat(verdict(start, size), size)


def remove_repeats(
    df: DataFrame, window: int = WINDOW, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """Remove every word that a repeated window of words covers (key, n_words, n_removed, kept).

    Words stand between blanks (space, 0x09 to 0x0D) and stay unchanged; ``kept`` joins those
    left by one space. A window is repeated if its words also start anywhere else, in the same
    document or another; all its occurrences go, judged on the input. Non-overlapping reference
    blocks of (window + 1) / 2 words are indexed, every rolling run of that length is looked up,
    and the windows around hits are compared whole, by 96 bits of their hashes, which extends the
    hits to maximal repeats. A null text has no words; repeated rows repeat each other.
    """
    packs, total = pk.write_packs(df, text, key)
    # Bits of a block's fingerprint: false hits stay rare, and cost a comparison, not a word.
    entries = max(1, total // 6)
    blocks = _Blocks(window, min(64, 8 * -(-(entries.bit_length() + 16) // 8)))
    parts = pk.parts_for(entries)
    first = pk.exchange(packs, blocks.send, blocks.answer, parts)
    asked = pk.with_answers(packs, first)
    windows = _Windows(window, blocks, parts)
    second = pk.exchange(asked, windows.send, windows.answer, parts)

    def keep(batches):
        def rows():
            for row in pk.pack_rows(batches):
                words, main, _, _, group, places = windows.sent(row)
                repeated = pk.answers_of(main, row["answers1"], parts)
                marks = np.zeros(len(words.doc) + 1, dtype=np.int64)
                starts = places[repeated[group]]
                np.add.at(marks, starts, 1)
                np.add.at(marks, starts + window, -1)
                kept = np.cumsum(marks[:-1]) == 0
                view = row["text"]
                for d, doc_key in enumerate(row["keys"]):
                    a = words.doc_first[d]
                    own = np.flatnonzero(kept[a : a + words.counts[d]]) + a
                    pieces = [view[s:e] for s, e in zip(words.start[own].tolist(), words.end[own].tolist())]
                    n = int(words.counts[d])
                    yield doc_key, n, n - len(own), b" ".join(pieces).decode()

        cells = {"key": pa.int64(), "n_words": pa.int64(), "n_removed": pa.int64(), "kept": pa.string()}
        yield from arrow_rows(cells, rows())

    found = map_arrow(
        pk.with_answers(packs, first, second), keep, "key long, n_words long, n_removed long, kept string"
    )
    return found.withColumnRenamed("key", key)


def digests(kept: DataFrame, key: str = "doc_id") -> DataFrame:
    return kept.select(key, "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
