"""Exact duplicate bytes by suffix arrays, built with the difference cover modulo 3."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.llm import packs as pk
from cohortloom.llm.shared import arrow_rows, map_arrow, written_table
from cohortloom.operators.scale import maybe_broadcast, skew_join

#: Bytes of a string that counts as a repeat.
LENGTH = 100
#: Bytes whose hash marks the strings that hold them.
MARK = 64
#: Strings of one stretch; bytes that one suffix array covers; bytes, ends included, of all
#: stretches of a mark beyond which they do not fit one array.
MOST_STRINGS, ARRAY_BYTES, HOT_BYTES = 512, 500_000, 1 << 20
_BASES = (0xA0761D6478BD642F, 0xE7037ED1A0B428DB)


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Starts of all suffixes in order, for symbols from 1 to below 2^21.

    The suffixes that start at places 1 and 2 modulo 3 are sorted by triples; while names
    repeat, the names themselves are sorted as a text a third as long twice over. The others
    follow from their first symbol and the next suffix's rank, and are merged in.
    """
    n = len(symbols)
    if n and max(n, symbols.max()) >= 1 << 21:
        raise ValueError("symbols and their number must stay below 2^21")
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: symbols[i:].tolist()), dtype=np.int64)
    s = np.concatenate([symbols.astype(np.int64), np.zeros(3, np.int64)])
    ones, twos = np.arange(1, n + 1, 3), np.arange(2, n + 1, 3)
    sample = np.concatenate([ones, twos])
    key = s[sample] << 42 | s[sample + 1] << 21 | s[np.minimum(sample + 2, n + 2)]
    order = np.argsort(key, kind="stable")
    new = np.concatenate([[True], key[order][1:] != key[order][:-1]])
    names = np.empty(len(sample), np.int64)
    names[order] = np.cumsum(new)
    if names.max() < len(sample):
        text = np.concatenate([names[: len(ones)], names[len(ones) :]])
        # The last of the first half ends with padding, so that no comparison runs on.
        order = suffix_array(text)
    rank = np.zeros(n + 4, np.int64)
    rank[sample[order]] = np.arange(1, len(sample) + 1)
    sampled = sample[order]
    sampled = sampled[sampled < n]
    zeros = np.arange(0, n, 3)
    zero_key = s[zeros] << 21 | rank[zeros + 1]
    by_zero = np.argsort(zero_key, kind="stable")
    zeros, zero_key = zeros[by_zero], zero_key[by_zero]
    first, second = sampled[sampled % 3 == 1], sampled[sampled % 3 == 2]
    before = np.searchsorted(s[first] << 21 | rank[first + 1], zero_key)
    second_key = s[second] << 42 | s[second + 1] << 21 | rank[second + 2]
    before += np.searchsorted(second_key, s[zeros] << 42 | s[zeros + 1] << 21 | rank[zeros + 2])
    out = np.empty(n, np.int64)
    place = np.arange(len(zeros)) + before
    rest = np.ones(n, bool)
    rest[place] = False
    out[place], out[rest] = zeros, sampled
    return out


def repeated_strings(stretches: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray]:
    """Group number of every string of ``length`` bytes in the stretches, and its start.

    The stretches stand one after the other, each ended by a symbol of its own. Neighbours in
    the suffix array are compared over their first bytes; equal ones are a group.
    """
    sizes = np.array([len(x) for x in stretches], dtype=np.int64)
    ends = np.cumsum(sizes + 1) - 1
    text = np.zeros(int((sizes + 1).sum()), np.int64)
    body = np.ones(len(text), bool)
    body[ends] = False
    raw = np.zeros(len(text) + length, np.uint8)
    raw[: len(text)][body] = np.frombuffer(b"".join(stretches), np.uint8)
    text[body] = raw[: len(text)][body].astype(np.int64) + 1
    text[ends] = 257 + np.arange(len(ends))
    left = np.repeat(ends, sizes + 1) - np.arange(len(text))
    order = suffix_array(text)
    order = order[left[order] >= length]
    group = np.zeros(len(order), np.int64)
    views = np.lib.stride_tricks.sliding_window_view(raw, length)
    for at in range(1, len(order), 20_000):
        some = order[at - 1 : at + 20_000]
        group[at : at + 20_000] = (views[some[1:]] != views[some[:-1]]).any(axis=1)
    return np.cumsum(group), order


def _sliding(extreme, values: np.ndarray, width: int) -> np.ndarray:
    """The extreme of every run of ``width`` values, by doubling the runs."""
    span = 1
    while span < width:
        step = min(span, width - span)
        if len(values) <= step:
            return values[:0]
        values, span = extreme(values[:-step], values[step:]), span + step
    return values if span == width else values[:0]


class _Marked:
    """The strings of a pack in stretches: neighbours with the same mark and document."""

    def __init__(self, row: dict, length: int, mark: int):
        self.data = row["text"]
        raw = np.frombuffer(self.data, np.uint8)
        sizes = row["sizes"]
        ends = np.cumsum(sizes)
        n = max(0, len(raw) - length + 1)
        doc = np.repeat(np.arange(len(sizes)), sizes)[:n]
        inside = ends[doc] - np.arange(n) >= length if n else np.zeros(0, bool)
        hashes = pk.rolling(pk.byte_codes(7)[raw], mark, _BASES[0])
        reach = length - mark + 1
        low = _sliding(np.minimum, hashes, reach)[:n]
        turn = np.ones(n, bool)
        turn[1:] = (low[1:] != low[:-1]) | (doc[1:] != doc[:-1]) | ~inside[:-1]
        starts = np.flatnonzero(turn & inside)
        stops = np.append(np.flatnonzero(turn | ~inside), n)
        stop = stops[np.searchsorted(stops, starts, side="right")] if len(starts) else starts
        # Endless repetitions have one mark: their stretches are cut to a fixed size.
        pieces = -(-(stop - starts) // MOST_STRINGS)
        number = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        self.start = np.repeat(starts, pieces) + number * MOST_STRINGS
        self.count = np.minimum(np.repeat(stop, pieces) - self.start, MOST_STRINGS)
        self.doc = doc[self.start] if len(self.start) else self.start
        # Least hashes lie near 0: mixed once more they spread evenly over the parts.
        self.mark = pk.scrambled(low[self.start]) if len(self.start) else np.zeros(0, np.uint64)
        keys = np.array([-(1 << 63) if k is None else k for k in row["keys"]], dtype=np.int64)
        self.key = keys[self.doc] if len(self.start) else np.zeros(0, np.int64)
        self.length = length
        # A stretch repeats itself only where its mark stands in it twice, as in "abababab".
        edge = np.zeros(reach - 1, np.uint64)
        high = _sliding(np.maximum, np.concatenate([edge, low, edge]), reach)
        least = np.flatnonzero(hashes == high) if len(low) else np.zeros(0, np.int64)
        near = np.diff(least) <= reach
        twin = least[:-1][near & (hashes[least[:-1]] == hashes[least[1:]])] if len(least) else least
        self.twin = np.searchsorted(twin, self.start) < np.searchsorted(
            twin, self.start + self.count + reach
        )

    def contexts(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """128 bits of the hash of the bytes of chosen stretches, as two numbers."""
        tail = self.length - 1
        spans = zip(self.start[chosen].tolist(), (self.start + self.count)[chosen].tolist())
        digests = b"".join(xxhash.xxh3_128_digest(self.data[a : b + tail]) for a, b in spans)
        both = np.frombuffer(digests, "<u8").reshape(-1, 2)
        return both[:, 0].copy(), both[:, 1].copy()


class _Questions:
    """What packs ask each other, and what the answers leave undecided."""

    def __init__(self, length: int, mark: int, parts: int):
        self.length, self.mark, self.parts = length, mark, parts

    def marked(self, row):
        return _Marked(row, self.length, self.mark)

    # Which marks occur more than once?
    def send_marks(self, row):
        marked = self.marked(row)
        distinct, inverse, counts = np.unique(marked.mark, return_inverse=True, return_counts=True)
        many = counts > 1
        many[inverse[marked.twin]] = True
        return distinct, (many.astype(np.uint8),)

    @staticmethod
    def many_marks(prints, packs, more):
        many = more[0].view(np.uint8)
        return _per_print(prints, lambda a, n: (n > 1) | (np.maximum.reduceat(many, a) > 0))

    def repeated(self, row):
        """The stretches whose mark is repeated."""
        marked = self.marked(row)
        distinct, inverse = np.unique(marked.mark, return_inverse=True)
        chosen = np.flatnonzero(pk.answers_of(distinct, row["answers0"], self.parts)[inverse])
        return marked, chosen, *marked.contexts(chosen)

    # Which repeated marks have stretches of different bytes?
    def send_kinds(self, row):
        marked, chosen, main, _ = self.repeated(row)
        # A stretch that repeats itself counts as two kinds.
        twice = marked.twin[chosen]
        marks = marked.mark[chosen]
        return _extremes(np.append(marks, marks[twice]), np.append(main, ~main[twice]))

    @staticmethod
    def kinds(prints, packs, more):
        least, most = (m.view(np.uint64) for m in more)
        return _per_print(
            prints, lambda a, n: np.minimum.reduceat(least, a) != np.maximum.reduceat(most, a)
        )

    # Which stretches are not the first with their bytes?
    def firsts(self, row):
        """Distinct stretches of a pack: hashes, the first stretch of each, and each one's group."""
        marked, chosen, main, check = self.repeated(row)
        order = np.lexsort((marked.start[chosen], marked.key[chosen], check, main))
        main, check, own = main[order], check[order], chosen[order]
        new = np.ones(len(main), bool)
        new[1:] = (main[1:] != main[:-1]) | (check[1:] != check[:-1])
        return marked, main[new], check[new], own, new

    def send_firsts(self, row):
        marked, main, check, own, new = self.firsts(row)
        return main, (check, marked.key[own[new]])

    @staticmethod
    def later(prints, packs, more):
        check, key = more[0].view(np.uint64), more[1].view(np.int64)
        order = np.lexsort((packs, key, check, prints))
        a, b = prints[order], check[order]
        found = np.zeros(len(a), bool)
        found[order[1:]] = (a[1:] == a[:-1]) & (b[1:] == b[:-1])
        return found

    def decided(self, row):
        """Stretches that go whole, and first ones that other bytes with their mark may repeat."""
        marked, main, _, own, new = self.firsts(row)
        later = pk.answers_of(main, row["answers2"], self.parts)
        gone = ~new
        gone[new] = later
        distinct, inverse = np.unique(marked.mark[own], return_inverse=True)
        kinds = pk.answers_of(distinct, row["answers1"], self.parts)[inverse] if len(own) else gone
        return marked, own[gone], own[~gone & kinds]


def _per_print(prints, verdict):
    if not len(prints):
        return np.zeros(0, bool)
    start = np.flatnonzero(np.concatenate([[True], prints[1:] != prints[:-1]]))
    size = np.diff(np.append(start, len(prints)))
    return np.repeat(verdict(start, size), size)


def _extremes(marks, values):
    order = np.lexsort((values, marks))
    marks, values = marks[order], values[order]
    if not len(marks):
        return marks, (values, values)
    start = np.flatnonzero(np.concatenate([[True], marks[1:] != marks[:-1]]))
    stop = np.append(start[1:], len(marks)) - 1
    return marks[start], (values[start], values[stop])


def _sorted_out(rows: DataFrame, length: int) -> DataFrame:
    """Strings of undecided stretches that start earlier elsewhere: (pack, at, n), runs of starts.

    Equal strings have equal marks, so that the stretches of a mark share a suffix array. The
    strings of a mark whose stretches exceed an array's bytes are compared one by one instead: the first of
    each is found by an aggregate, and all others are told by a join that splits frequent ones.
    """
    counted = rows.groupBy("mark").agg(F.sum(F.octet_length("context") + 1).alias("n"))
    hot = written_table(counted.where(F.col("n") > HOT_BYTES).select("mark"), "hot_marks")
    if hot.isEmpty():
        return _in_arrays(rows, length)
    hot = maybe_broadcast(hot)
    single = F.explode(F.sequence(F.lit(0), F.col("n") - 1))
    strings = rows.join(hot, "mark", "left_semi").select("*", single.alias("i")).select(
        F.struct("key", "pack", (F.col("at") + F.col("i")).alias("at")).alias("place"),
        F.substring("context", F.col("i") + 1, F.lit(length)).alias("context"),
    )
    first = strings.groupBy("context").agg(
        F.min("place").alias("first"), F.count(F.lit(1)).alias("many")
    )
    repeated = written_table(first.where("many > 1").drop("many"), "first_strings")
    later = skew_join(strings, repeated, ["context"]).where(F.col("place") > F.col("first"))
    single_runs = later.select("place.pack", "place.at", F.lit(1).cast("long").alias("n"))
    return _in_arrays(rows.join(hot, "mark", "left_anti"), length).unionByName(single_runs)


def _in_arrays(rows: DataFrame, length: int) -> DataFrame:
    """The same by suffix arrays, for marks of few stretches."""
    size = rows.agg(F.sum(F.octet_length("context"))).head()[0] or 1
    arrays = math.ceil(size / ARRAY_BYTES)
    dealt = rows.withColumn("array", F.pmod(F.xxhash64("mark"), F.lit(arrays)).cast("int"))

    def search(batches):
        cells = {"pack": pa.int64(), "at": pa.int64(), "n": pa.int64()}

        def rows():
            held, current = [], None
            for batch in batches:
                frame = batch.to_pandas()
                for array, own in frame.groupby("array", sort=True):
                    if current is not None and array != current:
                        yield from _later_runs(pd.concat(held), length)
                        held = []
                    current = array
                    held.append(own)
            if held:
                yield from _later_runs(pd.concat(held), length)

        yield from arrow_rows(cells, rows())

    ordered = dealt.repartition(arrays, "array").sortWithinPartitions("array", "mark")
    return map_arrow(ordered, search, "pack long, at long, n long")


def _later_runs(frame: pd.DataFrame, length: int):
    """Runs of starts of strings that have an earlier equal, by suffix arrays of bounded size."""
    size = frame["context"].str.len().to_numpy() + 1
    mark = frame["mark"].to_numpy()
    new = np.concatenate([[True], mark[1:] != mark[:-1]])
    first = np.flatnonzero(new)
    total = np.concatenate([[0], np.cumsum(size)])
    at = 0
    while at < len(first):
        # Whole marks together, as many as one array takes.
        to = at + 1
        while to < len(first) and total[first[to + 1] if to + 1 < len(first) else len(size)] - total[first[at]] <= ARRAY_BYTES:
            to += 1
        a, b = first[at], first[to] if to < len(first) else len(size)
        yield from _later_in(frame.iloc[a:b], length)
        at = to


def _later_in(frame: pd.DataFrame, length: int):
    stretches = frame["context"].tolist()
    group, order = repeated_strings(stretches, length)
    if not len(order):
        return
    sizes = np.array([len(x) + 1 for x in stretches])
    begins = np.cumsum(sizes) - sizes
    row = np.searchsorted(begins, order, side="right") - 1
    key, pack = frame["key"].to_numpy()[row], frame["pack"].to_numpy()[row]
    place = frame["at"].to_numpy()[row] + order - begins[row]
    by = np.lexsort((place, pack, key, group))
    later = np.zeros(len(by), bool)
    later[1:] = group[by][1:] == group[by][:-1]
    pack, place = pack[by][later], place[by][later]
    if not len(pack):
        return
    by = np.lexsort((place, pack))
    pack, place = pack[by], place[by]
    new = np.concatenate([[True], (pack[1:] != pack[:-1]) | (place[1:] != place[:-1] + 1)])
    start = np.flatnonzero(new)
    count = np.diff(np.append(start, len(pack)))
    yield from zip(pack[start].tolist(), place[start].tolist(), count.tolist())


def _widen(removed: np.ndarray, raw: np.ndarray, sizes: np.ndarray) -> None:
    """Take, in place, all bytes of characters of which a byte is removed, in texts one after the other."""
    inner = (raw & 0xC0) == 0x80
    starts = np.cumsum(sizes) - sizes
    inner[starts[starts < len(raw)]] = False
    # A character has three bytes after its first at most.
    for _ in range(3):
        removed[:-1] |= removed[1:] & inner[1:]
    for _ in range(3):
        removed[1:] |= removed[:-1] & inner[1:]


def remove_duplicates(
    df: DataFrame, length: int = LENGTH, mark: int = MARK, text: str = "text", key: str = "doc_id",
    carried: Sequence[str] = (), characters: bool = False,
) -> DataFrame:
    """Remove bytes that a string seen earlier covers (key, n_bytes, n_removed, n_spans, kept).

    A byte of a text's UTF-8 goes if a string of ``length`` bytes that covers it also starts
    earlier: in a row of smaller key (null keys first), or earlier in the same text. Rows of one
    key stand in a fixed order. Strings never cross texts and are judged on the input. ``kept``
    holds the bytes left, which may break a character unless ``characters`` widens every cut to
    whole ones; ``n_spans`` counts removed runs. Columns named in ``carried`` are returned, unchanged, as a struct ``more``.

    Sorting all suffixes would move the text many times. So strings are first told apart by the
    least hash of the ``mark``-byte runs in them: a string whose mark is nowhere else can't be
    repeated, and of stretches with the same bytes all but the first go. Only first stretches
    whose mark also stands in other bytes are left to the suffix arrays; stretches with the same
    mark meet in one array, which is built by the difference cover.
    """
    packs, total = pk.write_packs(df, text, key, carried=carried)
    parts = pk.parts_for(2 * total // (length - mark + 2))
    asked = _Questions(length, mark, parts)
    marks = pk.exchange(packs, asked.send_marks, asked.many_marks, parts)
    once = pk.with_answers(packs, marks)
    kinds = pk.exchange(once, asked.send_kinds, asked.kinds, parts)
    later = pk.exchange(once, asked.send_firsts, asked.later, parts)
    answered = pk.with_answers(packs, marks, kinds, later)

    def decide(batches):
        def rows():
            for row in pk.pack_rows(batches):
                marked, gone, open_ = asked.decided(row)
                runs = np.stack([marked.start[gone], marked.count[gone]]).astype("<i8")
                yield None, None, row["pack"], None, None, runs.tobytes()
                for i in open_.tolist():
                    a, n = int(marked.start[i]), int(marked.count[i])
                    yield (
                        int(marked.mark[i].astype(np.int64)), int(marked.key[i]), row["pack"], a, n,
                        marked.data[a : a + n + length - 1],
                    )

        cells = {"mark": pa.int64(), "key": pa.int64(), "pack": pa.int64(), "at": pa.int64(),
                 "n": pa.int32(), "context": pa.binary()}
        yield from arrow_rows(cells, rows())

    schema = "mark long, key long, pack long, at long, n int, context binary"
    # One table holds both what is decided, a row for each pack, and the stretches left open.
    table = written_table(map_arrow(answered, decide, schema), "stretches")
    decided = table.where("mark is null").select("pack", F.col("context").alias("answers"))
    runs = _sorted_out(table.where("mark is not null"), length).groupBy("pack").agg(
        F.collect_list(F.struct("at", "n")).alias("answers")
    )

    def cut(batches):
        # A batch for each pack, so that carried columns stay as Arrow holds them.
        for row in pk.pack_rows(batches):
            start, count = np.frombuffer(row["answers0"], "<i8").reshape(2, -1)
            found = row["answers1"] or ()
            raw = np.frombuffer(row["text"], np.uint8)
            marks = np.zeros(len(raw) + 1, np.int64)
            at = np.append(start, np.array([x["at"] for x in found], np.int64))
            n = np.append(count, np.array([x["n"] for x in found], np.int64))
            np.add.at(marks, at, 1)
            np.add.at(marks, at + n + length - 1, -1)
            removed = np.cumsum(marks[:-1]) > 0
            if characters:
                _widen(removed, raw, row["sizes"])
            end, spans, kept = 0, [], []
            for size in row["sizes"].tolist():
                own = removed[end : end + size]
                kept.append(raw[end : end + size][~own].tobytes())
                spans.append(int(own[:1].sum() + (own[1:] & ~own[:-1]).sum()))
                end += size
            lengths = row["sizes"] - np.array([len(x) for x in kept], np.int64)
            cells = {
                "key": pa.array(row["keys"], pa.int64()), "n_bytes": pa.array(row["sizes"]),
                "n_removed": pa.array(lengths), "n_spans": pa.array(spans, pa.int64()),
                "more": row["more"], "kept": pa.array(kept, pa.binary()),
            }
            yield pa.RecordBatch.from_arrays(list(cells.values()), names=list(cells))

    one = T.StructField("more", packs.schema["more"].dataType.elementType)
    counts = [T.StructField(c, T.LongType()) for c in ("key", "n_bytes", "n_removed", "n_spans")]
    schema = T.StructType([*counts, one, T.StructField("kept", T.BinaryType())])
    found = map_arrow(pk.with_answers(packs, decided, runs), cut, schema)
    found = found.withColumnRenamed("key", key)
    return found if carried else found.drop("more")


def digests(kept: DataFrame, key: str = "doc_id") -> DataFrame:
    return kept.select(
        key, "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )
