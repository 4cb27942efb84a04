"""Whole texts as numbers: word hashes, shingles and character codes over Arrow columns."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE = 1 << 18  # bytes worked on at a time; a longer text is cut at white space

_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def constants(n: int, seed: int) -> np.ndarray:
    """``n`` fixed odd 64-bit numbers."""
    steps = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return mix(steps + np.uint64(seed)) | np.uint64(1)


_PLACE = constants(64, 12)


def _byte_values(between: np.ndarray, fold: bool) -> np.ndarray:
    """Number of each byte, 0 for those between words; ``fold`` gives A to Z the numbers of a to z."""
    values = constants(256, 11)
    if fold:
        values[ord("A"):ord("Z") + 1] = values[ord("a"):ord("z") + 1]
    values[between] = 0
    return values


_MARKS = np.array([b < 0x80 and not chr(b).isalnum() for b in range(256)])
# ways to split a text: which bytes are between words, and the numbers of the others
BY_SPACE = _WHITE, _byte_values(_WHITE, False)
BY_SPACE_FOLDED = _WHITE, _byte_values(_WHITE, True)
BY_MARK = _MARKS, _byte_values(_MARKS, False)


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all values and their offsets; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.cast(pa.large_binary())
    values = pc.fill_null(values, b"") if values.null_count else values
    if not len(values):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(values.buffers()[1], np.int64, len(values) + 1, values.offset * 8)
    buffer = values.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def offsets_of(column: pa.Array) -> np.ndarray:
    """Offsets of the values' bytes, without copying these; null counts as empty."""
    lengths = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    return np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])


def give_back() -> None:
    """Return unused memory to the system; idle workers would keep it from the next stage."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


Batches = Iterator[pa.RecordBatch]


def lean(work: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """``work`` over the batches of a partition, giving memory back at its end."""
    @functools.wraps(work)
    def run(batches: Batches) -> Batches:
        try:
            yield from work(batches)
        finally:
            give_back()
    return run


def groups_of(offsets: np.ndarray, limit: int = PIECE) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes, or of one row."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = max(last, first + 1)
        yield first, last
        first = last


def _powers(n: int) -> np.ndarray:
    global _PLACE
    if n > len(_PLACE):
        _PLACE = constants(2 * n, 12)
    return _PLACE


def _piece_hashes(data: np.ndarray, breaks: np.ndarray, split: tuple, prefix: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of every word of ``data``; a word also ends at the positions ``breaks``."""
    between, values = split
    solid = ~between[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    breaks = breaks[breaks < len(data)]
    first[breaks] = solid[breaks]
    starts = np.flatnonzero(first)
    if not len(starts):
        return starts, np.zeros(0, np.uint64)
    here = np.arange(len(data))
    place = here - np.maximum.accumulate(np.where(first, here, 0))
    sums = values[data] * _powers(int(place.max()) + 1)[place]
    if prefix:
        sums[place >= prefix] = 0
    return starts, mix(np.add.reduceat(sums, starts))


def word_hashes(data: np.ndarray, offsets: np.ndarray, split: tuple = BY_SPACE, prefix: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and start byte of each word of the texts, and the number of words up to each text.

    ``BY_SPACE`` words are runs of bytes other than 0x20 and 0x09 to 0x0D, the folded
    ones with A to Z in lower case; ``BY_MARK`` words are runs of ASCII letters and
    digits and of bytes beyond ASCII. ``prefix`` hashes only so many first bytes.
    """
    between, hashes, places, at, end = split[0], [], [], 0, len(data)
    while at < end:
        stop = min(end, at + PIECE)
        if stop < end:  # on to the next gap or text
            text_end = int(offsets[np.searchsorted(offsets, stop, "left")])
            white = stop
            while white < text_end:
                gap = np.flatnonzero(between[data[white:white + 4096]])
                if len(gap):
                    white += int(gap[0])
                    break
                white += 4096
            stop = min(white, text_end)
        inside = offsets[np.searchsorted(offsets, at):np.searchsorted(offsets, stop, "right")] - at
        starts, sums = _piece_hashes(data[at:stop], inside, split, prefix)
        hashes.append(sums)
        places.append(starts + at)
        at = stop
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    places = np.concatenate(places)
    return np.concatenate(hashes), places, np.searchsorted(places, offsets)


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Distinct hashes of runs of ``size`` words, sorted; all words as one run if there are fewer."""
    n, places = len(words), constants(size, 13)
    if not n:
        return np.zeros(0, np.uint64)
    if n < size:
        return mix(np.array([(words * places[:n]).sum(dtype=np.uint64) + np.uint64(n)], np.uint64))
    sums = np.zeros(n - size + 1, np.uint64)
    for i in range(size):
        sums += words[i:n - size + 1 + i] * places[i]
    return np.unique(mix(sums))


def permutations(count: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Multipliers and addends of ``count`` universal hash functions (multiply and shift)."""
    return constants(count, seed), mix(constants(count, seed + 1))


def minhash(values: np.ndarray, functions: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Per function the least hash of ``values`` (upper halves of 64-bit hashes), as 32 bits."""
    times, plus = functions
    least = np.full(len(times), np.iinfo(np.uint64).max, np.uint64)
    upper = values >> np.uint64(32)
    for at in range(0, len(upper), 1024):
        part = upper[None, at:at + 1024] * times[:, None]
        part += plus[:, None]
        np.minimum(least, part.min(axis=1), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def codes(text: str) -> np.ndarray:
    """Code points of a text."""
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _letters() -> np.ndarray:
    import regex

    every = "".join(map(chr, (c for c in range(0x110000) if not 0xD800 <= c < 0xE000)))
    table = np.zeros(0x110000, bool)
    for match in regex.finditer(r"\p{L}+", every):
        table[codes(match[0])] = True
    return table


_LETTERS: list[np.ndarray] = []


def is_letter() -> np.ndarray:
    """Whether each code point is a letter; made once per worker."""
    if not _LETTERS:
        _LETTERS.append(_letters())
    return _LETTERS[0]


def gram_buckets(points: np.ndarray, sizes: tuple[int, ...], bits: int) -> np.ndarray:
    """Buckets, below 2 ** ``bits``, of all runs of ``sizes`` code points."""
    found = [np.zeros(0, np.int64)]
    times = constants(max(sizes), 51)
    wide = points.astype(np.uint64) + np.uint64(1)
    for size in sizes:
        if len(wide) >= size:
            sums = np.full(len(wide) - size + 1, np.uint64(size))
            for i in range(size):
                sums += wide[i:len(wide) - size + 1 + i] * times[i]
            sums = (sums ^ (sums >> np.uint64(32))) * times[0]
            found.append((sums >> np.uint64(64 - bits)).astype(np.int64))
    return np.concatenate(found)
