"""md5 of many short messages at once, in numpy.

A message fits one block of 64 bytes: MAX_BYTES bytes at most. The digest's four words are computed
for whole arrays of messages; one call per message would cost several times as much.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np

MAX_BYTES = 55
# Messages hashed together: their words and the working arrays fit a core's cache.
CHUNK = 1 << 15
_START = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)
_SINES = [int(abs(math.sin(i + 1)) * 2**32) for i in range(64)]
_TURNS = [(7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21)]


def blocks(messages: list[bytes], start: int) -> np.ndarray:
    """(16, n) words of padded messages whose first ``start`` bytes are left zero.

    ``messages`` hold what follows those bytes.
    """
    held = np.zeros((len(messages), 64), dtype=np.uint8)
    sizes = np.fromiter(map(len, messages), dtype=np.int64, count=len(messages))
    if len(messages) and start + sizes.max() > MAX_BYTES:
        raise ValueError(f"a message has more than {MAX_BYTES} bytes")
    rows = np.repeat(np.arange(len(messages)), sizes)
    places = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    held[rows, start + places] = np.frombuffer(b"".join(messages), dtype=np.uint8)
    held[np.arange(len(messages)), start + sizes] = 0x80
    words = np.ascontiguousarray(held.view("<u4").T).astype(np.uint32)
    words[14] = (start + sizes) * 8
    return words


def with_prefixes(words: np.ndarray, prefixes: list[bytes]) -> list[np.ndarray]:
    """The words with every prefix, all of one length, in the bytes left zero: (prefixes, n) or (1, n)."""
    wide = -(-len(prefixes[0]) // 4)
    front = np.frombuffer(b"".join(p.ljust(4 * wide, b"\0") for p in prefixes), dtype="<u4").reshape(-1, wide)
    return [words[None, i] | front[:, i, None] if i < wide else words[None, i] for i in range(16)]


def md5_words(words: list[np.ndarray]) -> tuple[np.ndarray, ...]:
    """The digest's four words; ``words`` are sixteen arrays of uint32, the first of full shape."""
    shape = words[0].shape
    a, b, c, d, f, t = (np.empty(shape, dtype=np.uint32) for _ in range(6))
    for held, value in zip((a, b, c, d), _START):
        held.fill(value)
    # Words that no message uses add nothing.
    used = [w if w.any() else None for w in words]
    for i in range(64):
        turn = i // 16
        if turn == 0:
            np.bitwise_xor(c, d, out=f)
            np.bitwise_and(f, b, out=f)
            np.bitwise_xor(f, d, out=f)
            g = i
        elif turn == 1:
            np.bitwise_xor(b, c, out=f)
            np.bitwise_and(f, d, out=f)
            np.bitwise_xor(f, c, out=f)
            g = (5 * i + 1) % 16
        elif turn == 2:
            np.bitwise_xor(b, c, out=f)
            np.bitwise_xor(f, d, out=f)
            g = (3 * i + 5) % 16
        else:
            np.bitwise_not(d, out=f)
            np.bitwise_or(f, b, out=f)
            np.bitwise_xor(f, c, out=f)
            g = (7 * i) % 16
        np.add(f, a, out=f)
        np.add(f, np.uint32(_SINES[i]), out=f)
        if used[g] is not None:
            np.add(f, used[g], out=f)
        s = _TURNS[turn][i % 4]
        np.left_shift(f, np.uint32(s), out=t)
        np.right_shift(f, np.uint32(32 - s), out=f)
        np.bitwise_or(f, t, out=f)
        np.add(f, b, out=f)
        a, d, c, b, f = d, c, b, f, a
    return tuple(held + np.uint32(value) for held, value in zip((a, b, c, d), _START))


def salted_md5(messages: list[bytes], prefixes: list[bytes]) -> Iterator[tuple[slice, tuple[np.ndarray, ...]]]:
    """md5 of every prefix followed by every message, as words of shape (prefixes, messages).

    Comes in slices of the prefixes, which are sorted by length. Messages that don't fit one block are
    hashed one at a time.
    """
    longest = max(map(len, messages), default=0)
    most, at = max(1, CHUNK // max(1, len(messages))), 0
    words, start = None, -1
    while at < len(prefixes):
        size = len(prefixes[at])
        same = [p for p in prefixes[at : at + most] if len(p) == size]
        if size + longest > MAX_BYTES:
            held = b"".join(hashlib.md5(p + m).digest() for p in same for m in messages)
            held = np.frombuffer(held, dtype="<u4").reshape(len(same), len(messages), 4)
            found = tuple(held[..., i] for i in range(4))
        else:
            if start != size:
                words, start = blocks(messages, size), size
            found = md5_words(with_prefixes(words, same))
        yield slice(at, at + len(same)), found
        at += len(same)


def leading(words: tuple[np.ndarray, ...]) -> np.ndarray:
    """The first 15 hex digits of each digest as a number."""
    first, second = words[0].byteswap().astype(np.uint64), words[1].byteswap().astype(np.uint64)
    return (first << np.uint64(32) | second) >> np.uint64(4)


def digest_bytes(words: tuple[np.ndarray, ...], at: tuple[np.ndarray, ...]) -> list[bytes]:
    """The 16 bytes of the digests at some places."""
    held = np.stack([w[at] for w in words], axis=1).astype("<u4").tobytes()
    return [held[i : i + 16] for i in range(0, len(held), 16)]
