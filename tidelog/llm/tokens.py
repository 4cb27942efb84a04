"""Token ids of a public byte-level BPE vocabulary, looked up word by word over whole batches."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from tidelog.llm.textnum import codes, constants, groups_of, mix, offsets_of

SPACE, LETTER, NUMBER, OTHER, END = range(5)
SENTINEL = 0x110000  # stands between texts
SLOTS = 1 << 20      # words remembered by a worker
STORED = 1 << 23     # their ids; all is forgotten beyond


def _kinds() -> np.ndarray:
    """Kind of every code point, as the split pattern of the vocabulary distinguishes them."""
    import regex

    every = "".join(map(chr, (c for c in range(SENTINEL) if not 0xD800 <= c < 0xE000)))
    kinds = np.full(SENTINEL + 1, OTHER, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        for match in regex.finditer(pattern, every):
            kinds[codes(match[0])] = kind
    kinds[SENTINEL] = END
    return kinds


def _byte_letters() -> dict[str, int]:
    """Characters that stand for bytes in a byte-level vocabulary: printable ones for themselves, the rest from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class WordTokens:
    """Splits texts into words by array operations; only words not seen lately meet the merges.

    ``encode`` takes strings of added tokens as ordinary text; ``encode_added`` gives their ids.
    """

    def __init__(self, path: str):
        import tiktoken

        letters = _byte_letters()
        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        added = model.get("added_tokens", [])
        for token in added:  # those that are found in the text as it stands
            if any(token.get(flag) for flag in ("single_word", "lstrip", "rstrip")) or token.get("normalized") and model.get("normalizer"):
                raise ValueError(f"added token {token['content']!r} has options that are not supported")
        special = {t["content"] for t in added}
        self.added = {t["content"]: np.array([t["id"]], np.uint32) for t in added}
        # of two that begin at one place the longer is meant
        self.split = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")").split if added else None
        ranks = {bytes(letters[c] for c in word): number for word, number in model["model"]["vocab"].items() if word not in special}
        # ids rise with the order of the merges, which is all the merging needs
        self.merge = tiktoken.Encoding("words", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece
        self.wide = max(ranks.values()) >= 1 << 16
        self.kinds, self.places = _kinds(), constants(64, 21)
        self.forget()

    def forget(self) -> None:
        self.keys = np.zeros(SLOTS, np.uint64)
        self.at, self.count = np.zeros(SLOTS, np.int64), np.zeros(SLOTS, np.int64)
        self.ids, self.used = np.zeros(1 << 16, np.uint32), 0

    def _learn(self, points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Store the ids of words; where they are stored and how many they are."""
        lengths = ends - starts
        stops = np.cumsum(lengths)
        text = points[np.arange(stops[-1]) - np.repeat(stops - lengths - starts, lengths)].tobytes().decode("utf-32-le", "surrogatepass")
        merge, ids = self.merge, []
        counts = np.zeros(len(starts), np.int64)
        for i, (lo, hi) in enumerate(zip((stops - lengths).tolist(), stops.tolist())):
            found = merge(text[lo:hi].encode("utf-8", "replace"))
            counts[i] = len(found)
            ids += found
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(len(self.ids), np.uint32)])
        self.ids[self.used:self.used + len(ids)] = ids
        at = self.used + np.cumsum(counts) - counts
        self.used += len(ids)
        return at, counts

    def _starts(self, points: np.ndarray) -> np.ndarray:
        """Where words begin. ``points`` ends with the sentinel."""
        kinds = self.kinds[points]
        solid = (kinds == LETTER) | (kinds == NUMBER) | (kinds == OTHER)
        gap = kinds == SPACE
        begin = np.ones(len(points), bool)
        begin[1:] = (kinds[1:] != kinds[:-1]) | (kinds[1:] == END)
        begin[1:] &= ~(solid[1:] & (points[:-1] == 0x20))  # one space goes with what follows
        begin[1:-1] |= gap[1:-1] & gap[:-2] & solid[2:]    # the last of several spaces stands apart
        quotes = np.flatnonzero(points == 0x27)
        if len(quotes):  # 's 't 'm 'd 're 've 'll
            before = np.where(quotes > 0, kinds[quotes - 1], END)
            free = (before != OTHER) & ((before != SPACE) | (points[quotes - 1] != 0x20))
            quotes = quotes[free]
            one, two = points[quotes + 1], points[np.minimum(quotes + 2, len(points) - 1)]
            short = np.isin(one, [ord(c) for c in "stmd"])
            pair = one.astype(np.uint64) << np.uint64(32) | two
            long = np.isin(pair, np.array([ord(a) << 32 | ord(b) for a, b in ("re", "ve", "ll")], np.uint64))
            begin[quotes[short] + 1] = False
            begin[quotes[short] + 2] = True
            begin[quotes[long] + 1] = False
            begin[quotes[long] + 3] = True
        return np.flatnonzero(begin)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text."""
        if self.used > STORED:
            self.forget()
        end = np.array([SENTINEL], np.uint32)
        points = np.concatenate([part for text in texts for part in (codes(text), end)])
        starts = self._starts(points)
        place = np.arange(len(points)) - np.repeat(starts, np.diff(np.append(starts, len(points))))
        longest = int(place.max()) + 1
        if longest > len(self.places):
            self.places = constants(2 * longest, 21)
        hashes = mix(np.add.reduceat((points + np.uint64(1)) * self.places[place], starts)) | np.uint64(1)
        stops = np.flatnonzero(points[starts] == SENTINEL)
        slots = (hashes >> np.uint64(40)).astype(np.int64) % SLOTS
        at, count = self.at[slots], self.count[slots]
        new = self.keys[slots] != hashes
        new[stops] = False
        count[stops] = 0
        missing = np.flatnonzero(new)
        if len(missing):
            fresh, first, which = np.unique(hashes[missing], return_index=True, return_inverse=True)
            ends = np.append(starts, len(points))
            words = missing[first]
            found_at, found_count = self._learn(points, starts[words], ends[words + 1])
            at[missing], count[missing] = found_at[which], found_count[which]
            where = (fresh >> np.uint64(40)).astype(np.int64) % SLOTS
            self.keys[where], self.at[where], self.count[where] = fresh, found_at, found_count
        upto = np.cumsum(count)
        ids = self.ids[np.arange(upto[-1] if len(upto) else 0) - np.repeat(upto - count - at, count)]
        return np.split(ids, upto[stops])[:len(texts)]

    def encode_added(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, as the library gives them with ``add_special_tokens=False``: the text is first split at added tokens."""
        if not any(token in text for token in self.added for text in texts):
            return self.encode(texts)
        pieces = [self.split(text) for text in texts]  # every second piece is an added token
        ids = iter(self.encode([p for found in pieces for p in found[::2]]))
        return [np.concatenate([self.added[p] if i % 2 else next(ids) for i, p in enumerate(found)]) for found in pieces]


_LOADED: dict[str, WordTokens] = {}


def word_tokens(path: str) -> WordTokens:
    """The vocabulary at ``path``, loaded once per worker."""
    if path not in _LOADED:
        _LOADED[path] = WordTokens(path)
    return _LOADED[path]


def token_ids(column: pa.Array, path: str) -> Iterator[np.ndarray]:
    """Ids of each text of a column; null counts as empty."""
    vocabulary = word_tokens(path)
    offsets = offsets_of(column)
    for first, last in groups_of(offsets, 1 << 19):
        yield from vocabulary.encode_added([t or "" for t in column[first:last].to_pylist()])
