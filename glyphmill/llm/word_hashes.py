"""Words and word shingles of many texts at once, as numpy arrays over UTF-8 bytes."""

from __future__ import annotations

import numpy as np

# The ASCII white space that divides words, and the constants of XXH64.
WHITE_SPACE = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
P1, P2, P3, P4, P5 = (
    np.uint64(11400714785074694791),
    np.uint64(14029467366897019727),
    np.uint64(1609587929392839161),
    np.uint64(9650029242287828579),
    np.uint64(2870177450012600261),
)

IS_SPACE = np.zeros(256, bool)
IS_SPACE[list(WHITE_SPACE)] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def word_spans(data: np.ndarray, bounds: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of each run of ``inside`` bytes; a run ends where its text ends."""
    if not len(data):
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    cut = np.zeros(len(data) + 1, bool)
    cut[bounds] = True
    start = inside.copy()
    start[1:] &= ~inside[:-1] | cut[1:-1]
    end = inside.copy()
    end[:-1] &= ~inside[1:] | cut[1:-1]
    starts = np.flatnonzero(start)
    return starts, np.flatnonzero(end) + 1, np.searchsorted(bounds, starts, "right") - 1


def joined_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All words divided by single spaces, and where each starts."""
    size = ends - starts
    at = np.cumsum(size + 1) - size - 1
    total = int(size.sum())
    out = np.full(total + len(size), 0x20, np.uint8)
    move = np.repeat(starts - (np.cumsum(size) - size), size)
    source = np.arange(total) + move
    out[np.arange(total) + np.repeat(np.arange(len(size)), size)] = data[source]
    return out, at


def word_shingles(text_of_word: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last word of each shingle of ``n`` words; a text with fewer words is one shingle."""
    words = len(text_of_word)
    place = np.arange(words)
    first_of_text = np.searchsorted(text_of_word, text_of_word, "left")
    end_of_text = np.searchsorted(text_of_word, text_of_word, "right")
    whole = place + n <= end_of_text
    short = (place == first_of_text) & (end_of_text - first_of_text < n)
    first = place[whole | short]
    return first, np.minimum(first + n, end_of_text[first]) - 1


def _rotated(value: np.ndarray, bits: int) -> np.ndarray:
    return value << np.uint64(bits) | value >> np.uint64(64 - bits)


def _round(state, lane):
    return _rotated(state + lane * P2, 31) * P1


def xxh64(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, seed: int) -> np.ndarray:
    """XXH64 of many byte ranges of one buffer; every step works on all ranges that still need it."""
    padded = np.zeros(len(data) + 16, np.uint8)
    padded[: len(data)] = data
    lanes = np.ndarray((len(data) + 8,), "<u8", padded, strides=(1,)).copy()
    with np.errstate(over="ignore"):
        seed = np.uint64(seed)
        at, left = starts.copy(), sizes.copy()
        value = np.full(len(starts), seed + P5)
        long = np.flatnonzero(sizes >= 32)
        if len(long):
            position, remain = at[long], left[long]
            state = [np.full(len(long), s) for s in (seed + P1 + P2, seed + P2, seed, seed - P1)]
            live = np.arange(len(long))
            while len(live):
                for lane in range(4):
                    state[lane][live] = _round(state[lane][live], lanes[position[live] + 8 * lane])
                position[live] += 32
                remain[live] -= 32
                live = live[remain[live] >= 32]
            mixed = sum((_rotated(s, r) for s, r in zip(state[1:], (7, 12, 18))), _rotated(state[0], 1))
            for s in state:
                mixed = (mixed ^ _round(np.uint64(0), s)) * P1 + P4
            value[long], at[long], left[long] = mixed, position, remain
        value += sizes.astype(np.uint64)
        for _ in range(3):
            step = _rotated(value ^ _round(np.uint64(0), lanes[at]), 27) * P1 + P4
            more = left >= 8
            value = np.where(more, step, value)
            at += 8 * more
            left -= 8 * more
        step = _rotated(value ^ (lanes[at] & np.uint64(0xFFFFFFFF)) * P1, 23) * P2 + P3
        more = left >= 4
        value = np.where(more, step, value)
        at += 4 * more
        left -= 4 * more
        rest = lanes[at]
        for byte in range(3):
            one = rest >> np.uint64(8 * byte) & np.uint64(0xFF)
            value = np.where(left > byte, _rotated(value ^ one * P5, 11) * P1, value)
        value = (value ^ value >> np.uint64(33)) * P2
        value = (value ^ value >> np.uint64(29)) * P3
        return value ^ value >> np.uint64(32)


# Letters of words for language models: ASCII letters and every byte of other characters.
IS_LETTER = np.zeros(256, bool)
IS_LETTER[0x80:] = True
IS_LETTER[ord("a") : ord("z") + 1] = True
IS_LETTER[ord("A") : ord("Z") + 1] = True

_BASE = 0x9E3779B97F4A7C15
_powers = np.ones(1, np.uint64), np.ones(1, np.uint64)


def _power_tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse, modulo 2**64."""
    global _powers
    if len(_powers[0]) < size:
        inverse = pow(_BASE, -1, 1 << 64)
        with np.errstate(over="ignore"):
            _powers = tuple(
                np.cumprod(np.append(np.uint64(1), np.full(2 * size, base, np.uint64))) for base in (_BASE, inverse)
            )
    return _powers


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit polynomial hash of each byte range, from prefix sums; equal bytes give equal hashes."""
    power, inverse = _power_tables(len(data) + 1)
    with np.errstate(over="ignore"):
        prefix = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)], out=prefix[1:])
        value = (prefix[ends] - prefix[starts]) * inverse[starts]
        value = (value ^ value >> np.uint64(31)) * P1
        return value ^ value >> np.uint64(29)
