"""Re-Pair grammars of id sequences, and shards of documents stored as such grammars.

A grammar replaces pairs of neighbouring symbols that are frequent by new symbols (nonterminals),
again and again. A round replaces all pairs about as frequent as the most frequent one at once, in
passes over arrays. Rules of a round use symbols of earlier rounds only, so a sequence is expanded in
as many passes as there were rounds. Plain functions of one shard.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np

#: A pair is replaced if it stands so often at least (a rule costs two symbols).
MIN_PAIRS = 4
#: A round takes the pairs that are at least as frequent as the most frequent one divided by this.
SPREAD = 64
#: Slots of the table in which pairs are counted.
SLOT_BITS = 18
#: Ids of a rule up to which its expansion is looked up as a whole.
LONG = 64
#: Symbols between two entries of the index from ids to symbols.
SAMPLE = 64
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_MAGIC = b"RPG1"
_FIELDS = ("length", "part", "shard", "docs", "ids", "first", "rules", "symbols", "bits")


def _count(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Slot of each key, whether the slot is its own, and key and number of keys of each slot.

    A slot is that of the last key in it; others that fall into it wait for a later round, when
    fewer keys are left.
    """
    bits = min(SLOT_BITS, max(10, int(len(keys)).bit_length()))
    slots = ((keys * _MULTIPLIER) >> np.uint64(64 - bits)).view(np.int64)
    owner = np.zeros(1 << bits, np.uint64)
    owner[slots] = keys
    own = owner.take(slots) == keys
    return slots, own, owner, np.bincount(slots if own.all() else slots[own], minlength=1 << bits)


def _places(at: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Which of the pairs at ``at`` (in order) are replaced: of two that overlap the one of lower rank,
    of a run of equal pairs every second one from its begin."""
    touch = np.diff(at) == 1
    same = touch & (rank[1:] == rank[:-1])
    kept = np.ones(len(at), bool)
    if same.any():
        number = np.arange(len(at), dtype=np.int32)
        begins = number.copy()
        begins[1:][same] = 0
        kept = (number - np.maximum.accumulate(begins)) & 1 == 0
    kept[1:] &= ~(touch & (rank[:-1] < rank[1:]))
    kept[:-1] &= ~(touch & (rank[1:] < rank[:-1]))
    return np.flatnonzero(kept)


@dataclass
class Grammar:
    """``symbols`` expand to the ids; symbol ``first + r`` stands for the two of ``rules[r]``."""

    first: int
    rules: np.ndarray
    symbols: np.ndarray

    @classmethod
    def of(cls, ids: np.ndarray, least: int = MIN_PAIRS) -> Grammar:
        first = int(ids.max(initial=-1)) + 1
        symbols, rules, made = ids.astype(np.uint32), [np.zeros((0, 2), np.uint64)], 0
        # pairs that may be frequent: a count only falls, but for pairs with a new symbol
        live = np.ones(len(symbols), bool)
        live[-1:] = False
        while len(at := np.flatnonzero(live)):
            keys = symbols.take(at).astype(np.uint64)
            keys <<= np.uint64(32)
            keys |= symbols.take(at + 1)
            slots, own, owner, counts = _count(keys)
            most = int(counts.max())
            if most < least:
                if own.all():
                    break
                live[at[own]] = False
                continue
            taken = np.flatnonzero(counts >= max(least, most // SPREAD))
            taken = taken[np.lexsort((owner[taken], -counts[taken]))]
            pairs = np.stack((owner[taken] >> np.uint64(32), owner[taken] & np.uint64(0xFFFFFFFF)), axis=1)
            rank = np.where(counts >= least, np.int32(-1), np.int32(-2))
            rank[taken] = np.arange(len(taken), dtype=np.int32)
            rank = rank.take(slots)
            live[at] = ~own | (rank > -2)
            chosen = np.flatnonzero(own & (rank >= 0))
            at, rank = at[chosen], rank[chosen]
            placed = _places(at, rank)
            at, rank = at[placed], rank[placed]
            good = np.bincount(rank, minlength=len(taken)) >= least
            if not good.all():
                # overlaps leave too few of these; what is left of them is counted anew
                at, rank = at[good[rank]], rank[good[rank]]
                if not len(at):
                    break
            new = (first + made + np.cumsum(good) - 1).astype(np.uint32)
            symbols[at] = new[rank]
            live[at] = True
            live[np.maximum(at - 1, 0)] = True
            kept = np.ones(len(symbols), bool)
            kept[at + 1] = False
            symbols, live = symbols[kept], live[kept]
            live[-1:] = False
            rules.append(pairs[good])
            made += int(good.sum())
        return cls(first, np.concatenate(rules).astype(np.int64), symbols)

    def lengths(self) -> np.ndarray:
        """Ids that each rule expands to."""
        out = np.ones(self.first + len(self.rules), np.int64)
        done = 0
        while done < len(self.rules):
            # rules that use only symbols known by now: those of a round stand together
            known = self.first + done
            end = done + int(np.argmax(np.append((self.rules[done:] >= known).any(axis=1), True)))
            out[known : self.first + end] = out[self.rules[done:end]].sum(axis=1)
            done = end
        return out[self.first :]


def gather(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``flat[start : start + size]`` of each, one behind another."""
    place = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
    place += np.arange(len(place))
    return flat.take(place)


def expand(symbols: np.ndarray, first: int, rules: np.ndarray, only: np.ndarray | None = None) -> np.ndarray:
    """The sequence with symbols replaced by those they stand for until none is left (of ``only``,
    which says for each rule whether it is to be replaced)."""
    while True:
        inner = np.flatnonzero(symbols >= first)
        if only is not None:
            inner = inner[only[symbols[inner] - first]]
        if not len(inner):
            return symbols
        counts = np.ones(len(symbols), np.int64)
        counts[inner] = 2
        ends = np.cumsum(counts)
        out = np.empty(int(ends[-1]), symbols.dtype)
        pairs = rules[symbols[inner] - first]
        out[ends - counts] = symbols
        out[ends[inner] - 2], out[ends[inner] - 1] = pairs[:, 0], pairs[:, 1]
        symbols = out


class _Table:
    """The ids of every rule of at most ``LONG`` ids, one behind another after the single ids."""

    def __init__(self, first: int, rules: np.ndarray, lengths: np.ndarray):
        self.first, self.rules, self.long = first, rules, lengths > LONG
        short = np.flatnonzero(~self.long)
        flat = expand(rules[short].reshape(-1), first, rules)
        self.flat = np.concatenate((np.arange(first), flat)).astype(np.uint32)
        self.sizes = np.ones(first + len(rules), np.int64)
        self.sizes[first:] = np.where(self.long, 0, lengths)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        if self.long.any():
            symbols = expand(symbols, self.first, self.rules, self.long)
        return gather(self.flat, self.starts.take(symbols), self.sizes.take(symbols))


def pack(values: np.ndarray, bits: int) -> bytes:
    """Whole numbers as ``bits`` bits each, low bits first."""
    parts = []
    for begin in range(0, len(values), 1 << 16):
        part = values[begin : begin + (1 << 16)].astype(np.uint32)
        octets = part.astype("<u4").view(np.uint8).reshape(len(part), 4)
        parts.append(np.packbits(np.unpackbits(octets, axis=1, bitorder="little", count=bits), bitorder="little").tobytes())
    return b"".join(parts)


def unpack(data: np.ndarray, bits: int, begin: int, end: int) -> np.ndarray:
    """Numbers ``begin`` to before ``end`` of ``pack``; ``data`` goes on for 16 bytes after them at least."""
    at = np.arange(begin, end, dtype=np.int64) * bits
    low = begin * bits >> 3
    part = data[low : low + ((end - begin) * bits >> 3) + 9]
    # the number that the eight bytes from each byte on are; no copy of the bytes is needed for it
    words = np.lib.stride_tricks.as_strided(part[:8].view("<u8"), (max(0, len(part) - 7),), (1,))
    word = words[(at >> 3) - low] >> (at & 7).astype(np.uint64)
    return (word & np.uint64((1 << bits) - 1)).astype(np.int64)


def write_shard(part: int, shard: int, doc_ids: Sequence[int | None], sizes: np.ndarray, ids: np.ndarray) -> bytes:
    """A shard as bytes: header, documents, rules with their expansion lengths, index, symbols.

    ``ids`` are those of all documents one behind another, ``sizes`` how many each has.
    """
    grammar = Grammar.of(ids)
    lengths = grammar.lengths()
    bits = max(1, int(grammar.first + len(grammar.rules) - 1).bit_length())
    each = np.concatenate((np.ones(grammar.first, np.int64), lengths))[grammar.symbols]
    ends = np.cumsum(each)
    arrays = [
        np.array([0 if i is None else i for i in doc_ids], "<i8").tobytes(),
        np.array([i is not None for i in doc_ids], np.uint8).tobytes(),
        np.cumsum(sizes).astype("<i8").tobytes(),
        grammar.rules.astype("<u4").tobytes(),
        lengths.astype("<u4").tobytes(),
        (ends - each)[::SAMPLE].astype("<i8").tobytes(),
        pack(grammar.symbols, bits) + b"\0" * 16,
    ]
    body = b"".join(a + b"\0" * (-len(a) % 8) for a in arrays)
    size = 8 + 8 * len(_FIELDS) + len(body)
    head = (size, part, shard, len(doc_ids), len(ids), grammar.first, len(grammar.rules), len(grammar.symbols), bits)
    return _MAGIC + b"\0" * 4 + np.array(head, "<i8").tobytes() + body


class Shard:
    """A shard over its bytes. Any stretch of ids is decoded from the symbols that hold it."""

    def __init__(self, data: bytes | memoryview):
        view = memoryview(data)
        if bytes(view[:4]) != _MAGIC:
            raise ValueError("not a token shard")
        head = np.frombuffer(view, "<i8", len(_FIELDS), 8).tolist()
        self.length, self.part, self.shard, docs, self.size, self.first, rules, self.symbols, self.bits = head
        at = 8 + 8 * len(_FIELDS)

        def array(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(view, kind, n, at)
            at += out.nbytes + -out.nbytes % 8
            return out

        values, valid = array("<i8", docs), array("u1", docs)
        self.doc_ids = [v if ok else None for v, ok in zip(values.tolist(), valid.tolist())]
        self.ends = array("<i8", docs)
        self.rules = array("<u4", 2 * rules).reshape(-1, 2).astype(np.int64)
        self.lengths = array("<u4", rules)
        self.index = array("<i8", -(-self.symbols // SAMPLE))
        self.data = array("u1", self.length - at)

    @cached_property
    def _table(self) -> _Table:
        return _Table(self.first, self.rules, self.lengths)

    def ids(self, begin: int = 0, end: int | None = None) -> np.ndarray:
        """Ids ``begin`` to before ``end`` of the shard; only the symbols around them are read."""
        end = self.size if end is None else min(end, self.size)
        if begin >= end:
            return np.zeros(0, np.int64)
        low = (int(np.searchsorted(self.index, begin, "right")) - 1) * SAMPLE
        high = min(self.symbols, int(np.searchsorted(self.index, end, "left")) * SAMPLE)
        symbols = unpack(self.data, self.bits, low, high)
        each = np.ones(len(symbols), np.int64)
        inner = symbols >= self.first
        each[inner] = self.lengths[symbols[inner] - self.first]
        ends = np.cumsum(each) + int(self.index[low // SAMPLE])
        a, b = int(np.searchsorted(ends, begin, "right")), int(np.searchsorted(ends, end, "left")) + 1
        out = self._table.expand(symbols[a:b])
        return out[begin - int(ends[a] - each[a]) :][: end - begin]

    def document(self, n: int) -> np.ndarray:
        """The ids of the ``n``-th document of the shard."""
        return self.ids(int(self.ends[n - 1]) if n else 0, int(self.ends[n]))


def shards(data: bytes) -> list[Shard]:
    """The shards of a file: one behind another, each followed by a line end."""
    found, at, view = [], 0, memoryview(data)
    while at < len(view):
        found.append(Shard(view[at:]))
        at += found[-1].length + 1
    return found
