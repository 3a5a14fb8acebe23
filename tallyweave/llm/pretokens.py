"""Splitting text into pre-tokens for byte-level BPE, and compact caches of their ids.

No match of the rank files' pattern runs from visible text into white space, and what
follows such a place does not depend on what stands before it. So a text is cut into
pieces there (white space and the visible text behind it), and equal pieces have equal
tokens wherever they stand. All pieces of a batch are looked up at once, by their bytes or,
if there are over 15, by a cryptographic hash; only unknown pieces go through the pattern,
and only unknown pre-tokens through the merges.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import regex

from tallyweave.llm.hashing import eights, mix, text_bytes, wide_digests

# White space as UTF-8.
_ASCII_SPACE = np.zeros(256, dtype=bool)
_ASCII_SPACE[[9, 10, 11, 12, 13, 32]] = True
_WIDE_SPACE = [chr(c).encode() for c in (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]
_WIDE_BY_LEAD = {lead: [m for m in _WIDE_SPACE if m[0] == lead] for lead in sorted({m[0] for m in _WIDE_SPACE})}
# Marks that end a word and are a pre-token of their own there.
_ENDS = frozenset(".,;:!?")
# Entries kept in a cache, at about 60 bytes each; a full cache keeps its most used half.
CACHE_ENTRIES = 250_000
# Longer pieces are encoded without being kept.
LONGEST_KEPT = 64


def spans(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The places ``start`` to ``start + count`` of every span, one after the other."""
    ends = np.cumsum(count)
    return np.repeat(start - (ends - count), count) + np.arange(int(ends[-1]) if len(ends) else 0)


class IdCache:
    """Ids by the 128 bits that stand for a piece, in arrays with open addressing."""

    def __init__(self, kind: type, most: int) -> None:
        self.kind, self.most = kind, most
        self.clear()

    def clear(self) -> None:
        self.bits, self.size = 12, 0
        self.slots = np.full(1 << self.bits, -1, dtype=np.int32)
        self.keys = np.empty((0, 2), dtype=np.uint64)
        self.start, self.count = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int32)
        self.ids = np.empty(0, dtype=self.kind)
        self.uses = np.empty(0, dtype=np.int32)

    def _slot(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        return (mix(one ^ mix(two)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _keep_most_used(self, entries: int) -> None:
        """Drops all but the entries that were found most often."""
        order = np.sort(np.argsort(-self.uses, kind="stable")[:entries])
        keys, start, count, uses, ids = self.keys[order], self.start[order], self.count[order], self.uses[order] // 2, self.ids
        self.clear()
        self._append(keys, ids[spans(start, count)], count.astype(np.int64))
        self.uses = uses

    def find(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Entry of each piece, -1 where there is none."""
        out = np.full(len(one), -1, dtype=np.int64)
        if not self.size:
            return out
        open_ = np.arange(len(one))
        slot = self._slot(one, two)
        while len(open_):
            entry = self.slots[slot]
            taken = entry >= 0
            open_, slot, entry = open_[taken], slot[taken], entry[taken]
            hit = (self.keys[entry, 0] == one[open_]) & (self.keys[entry, 1] == two[open_])
            out[open_[hit]] = entry[hit]
            open_, slot = open_[~hit], (slot[~hit] + 1) & ((1 << self.bits) - 1)
        self.uses += np.bincount(out[out >= 0], minlength=self.size).astype(np.int32)
        return out

    def add(self, one: np.ndarray, two: np.ndarray, ids: np.ndarray, count: np.ndarray) -> None:
        """New pieces, all distinct and not held yet; a full cache forgets what it used least."""
        if self.size + len(one) > self.most:
            self._keep_most_used(max(0, min(self.most // 2, self.most - len(one))))
        if len(one) <= self.most:
            self._append(np.stack([one, two], axis=1), ids, count)

    def _append(self, keys: np.ndarray, ids: np.ndarray, count: np.ndarray) -> None:
        begin = len(self.ids) + np.cumsum(count) - count
        self.keys = np.concatenate([self.keys, keys])
        self.uses = np.concatenate([self.uses, np.zeros(len(keys), dtype=np.int32)])
        self.start, self.count = np.concatenate([self.start, begin]), np.concatenate([self.count, count.astype(np.int32)])
        self.ids = np.concatenate([self.ids, ids])
        new = np.arange(self.size, len(self.keys))
        self.size = len(self.keys)
        if self.size * 2 > 1 << self.bits:
            self.bits = int(self.size * 4 - 1).bit_length()
            self.slots = np.full(1 << self.bits, -1, dtype=np.int32)
            new = np.arange(self.size)
        slot = self._slot(self.keys[new, 0], self.keys[new, 1])
        while len(new):
            free = np.flatnonzero(self.slots[slot] < 0)
            _, first = np.unique(slot[free], return_index=True)
            put = free[first]
            self.slots[slot[put]] = new[put]
            left = np.ones(len(new), dtype=bool)
            left[put] = False
            new, slot = new[left], (slot[left] + 1) & ((1 << self.bits) - 1)


class PieceEncoder:
    """Ids of whole texts by way of cached pieces.

    ``encode_many`` gets distinct pre-tokens and returns the ids of all of them, and how
    many each has. A text that holds one of ``specials`` goes to it as a whole.
    """

    def __init__(
        self, pattern: str, encode_many: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], kind: type,
        specials: tuple[str, ...] = (), entries: int | None = None,
    ) -> None:
        self.matches = regex.compile(pattern).findall
        self.encode_many, self.kind = encode_many, kind
        self.specials = specials
        most = CACHE_ENTRIES if entries is None else entries
        self.pieces, self.pretokens = IdCache(kind, most), IdCache(kind, most)

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a column one after the other, and how many each text has."""
        data, offsets = text_bytes(column)
        cut = np.zeros(len(data) + 1, dtype=bool)
        blank = _blanks(data)
        cut[1 : len(data)] = blank[1:] & ~blank[:-1]
        raw = data.tobytes()
        for i in self._special_texts(raw, offsets):
            cut[offsets[i] : offsets[i + 1]] = False
        cut[offsets] = True
        cut[len(data)] = False
        start = np.flatnonzero(cut)
        end = np.append(start[1:], len(data))
        one, two = _keys(data, start, end)
        entry = self.pieces.find(one, two)
        at = np.searchsorted(start, offsets)
        count = np.empty(len(start), dtype=np.int64)
        known = entry >= 0
        place = np.zeros(len(start), dtype=np.int64)
        count[known], place[known] = self.pieces.count[entry[known]], self.pieces.start[entry[known]]
        table = self.pieces.ids
        if not known.all():
            unknown = np.flatnonzero(~known)
            first, back = _distinct(one[unknown], two[unknown])
            new = unknown[first]
            texts = [raw[a:b].decode() for a, b in zip(start[new].tolist(), end[new].tolist())]
            ids, sizes = self._encode_pieces(texts)
            place[unknown] = (len(table) + np.cumsum(sizes) - sizes)[back]
            count[unknown] = sizes[back]
            table = np.concatenate([table, ids])
            keep = end[new] - start[new] <= LONGEST_KEPT
            self.pieces.add(one[new][keep], two[new][keep], ids[np.repeat(keep, sizes)], sizes[keep])
        total = np.concatenate([[0], np.cumsum(count)])
        return table[spans(place, count)], total[at[1:]] - total[at[:-1]]

    def _special_texts(self, raw: bytes, offsets: np.ndarray) -> list[int]:
        marks = [m.encode() for m in self.specials]
        if not any(m in raw for m in marks):
            return []
        return [i for i in range(len(offsets) - 1) if any(m in raw[offsets[i] : offsets[i + 1]] for m in marks)]

    def _split(self, piece: str) -> list[str]:
        body = piece[1:] if piece[0] == " " else piece
        if body.isalpha():
            return [piece]
        if body[-1:] in _ENDS and body[:-1].isalpha():
            return [piece[:-1], piece[-1]]
        if any(s in piece for s in self.specials):
            return [piece]
        return self.matches(piece)

    def _encode_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        split = [self._split(p) for p in pieces]
        tokens = [t for s in split for t in s]
        sizes = np.fromiter(map(len, split), dtype=np.int64, count=len(split))
        data, offsets = text_bytes(pa.array(tokens, pa.string()))
        one, two = _keys(data, offsets[:-1], offsets[1:])
        entry = self.pretokens.find(one, two)
        known = entry >= 0
        count, place = np.zeros(len(tokens), dtype=np.int64), np.zeros(len(tokens), dtype=np.int64)
        count[known], place[known] = self.pretokens.count[entry[known]], self.pretokens.start[entry[known]]
        table = self.pretokens.ids
        if not known.all():
            unknown = np.flatnonzero(~known)
            first, back = _distinct(one[unknown], two[unknown])
            new = unknown[first]
            ids, each = self.encode_many([tokens[i] for i in new.tolist()])
            place[unknown] = (len(table) + np.cumsum(each) - each)[back]
            count[unknown] = each[back]
            table = np.concatenate([table, ids])
            keep = (offsets[1:] - offsets[:-1])[new] <= LONGEST_KEPT
            self.pretokens.add(one[new][keep], two[new][keep], ids[np.repeat(keep, each)], each[keep])
        total = np.concatenate([[0], np.cumsum(count)])
        at = np.concatenate([[0], np.cumsum(sizes)])
        return table[spans(place, count)], total[at[1:]] - total[at[:-1]]


def _blanks(data: np.ndarray) -> np.ndarray:
    """Which bytes belong to white space."""
    out = _ASCII_SPACE[data]
    # Few texts have other white space; their lead bytes are looked for first.
    for lead_byte, marks in _WIDE_BY_LEAD.items():
        lead = np.flatnonzero(data == lead_byte)
        for mark in marks if len(lead) else ():
            at = lead[lead + len(mark) <= len(data)]
            for k, b in enumerate(mark[1:], start=1):
                at = at[data[at + k] == b]
            for k in range(len(mark)):
                out[at + k] = True
    return out


def _keys(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits for each piece: up to 15 bytes and their number as they are, or the hash of
    more bytes under a number that no short piece has."""
    wide, size = eights(data), end - start
    one = wide[start] & _FIRST[np.minimum(size, 8)]
    two = (wide[np.minimum(start + 8, len(data))] & _FIRST[np.clip(size - 8, 0, 7)]) | (size.astype(np.uint64) << np.uint64(56))
    long = np.flatnonzero(size > 15)
    if len(long):
        found = np.frombuffer(b"".join(wide_digests(data, start[long], end[long])), dtype=np.uint64).reshape(-1, 2)
        one[long], two[long] = found[:, 0], found[:, 1] | np.uint64(0xFF << 56)
    return one, two


_FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)


def _distinct(one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A row of each distinct pair, and for each row the number of its pair."""
    order = np.lexsort((two, one))
    a, b = one[order], two[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    back = np.empty(len(order), dtype=np.int64)
    back[order] = np.cumsum(new) - 1
    return order[new], back
