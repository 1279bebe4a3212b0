"""A minimal acyclic transducer from byte strings to id sequences, kept as flat arrays.

Words with equal endings share states. An edge carries how many accepted words come before those
that go through it, so the sum along a path is the word's number among all words in byte order, and
the number finds its ids. States and edges are arrays in one block of bytes that a process maps.
"""

from __future__ import annotations

import mmap
import tempfile
from collections.abc import Mapping

import numpy as np

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_FIELDS = (("keys", np.int64), ("targets", np.int32), ("skips", np.int32), ("accepts", np.uint8),
           ("offsets", np.int32), ("ids", np.int32))


def _slot(keys: np.ndarray, bits: int) -> np.ndarray:
    return ((keys.astype(np.uint64) * _MULTIPLIER) >> np.uint64(64 - bits)).astype(np.int64)


def compile_lexicon(words: Mapping[bytes, list[int]]) -> bytes:
    """The automaton of ``words`` as bytes, built word by word in byte order.

    The states of the last word's path stay open until the next word leaves it; a closed state that
    equals a registered one (same edges, same acceptance) is replaced by it.
    """
    ordered = sorted(words)
    final, edges = [False], [{}]  # state 0 is the start
    register: dict[tuple, int] = {}
    path: list[int] = [0]
    last = b""

    def close(depth: int) -> None:
        while len(path) - 1 > depth:
            state, parent = path.pop(), path[-1]
            form = (final[state], tuple(edges[state].items()))
            known = register.setdefault(form, state)
            if known != state:
                edges[parent][last[len(path) - 1]] = known

    for word in ordered:
        shared = 0
        while shared < min(len(word), len(last)) and word[shared] == last[shared]:
            shared += 1
        close(shared)
        for octet in word[shared:]:
            final.append(False)
            edges.append({})
            edges[path[-1]][octet] = len(edges) - 1
            path.append(len(edges) - 1)
        final[path[-1]] = True
        last = word
    close(0)

    count: dict[int, int] = {}
    for state in [*register.values(), 0]:  # registered states are closed after those they lead to
        count[state] = final[state] + sum(count[t] for t in edges[state].values())
    number = {state: i for i, state in enumerate([0, *register.values()])}
    rows = []
    for state, i in number.items():
        before = int(final[state])
        for octet in sorted(edges[state]):
            target = edges[state][octet]
            rows.append((i << 8 | octet, number[target], before))
            before += count[target]
    bits = max(4, int(np.ceil(np.log2(max(1, len(rows)) * 2))))
    keys = np.full(1 << bits, -1, np.int64)
    targets, skips = np.zeros(1 << bits, np.int32), np.zeros(1 << bits, np.int32)
    at = _slot(np.array([r[0] for r in rows], np.int64), bits) if rows else []
    for (key, target, skip), slot in zip(rows, at):
        while keys[slot] >= 0:
            slot = (slot + 1) & (len(keys) - 1)
        keys[slot], targets[slot], skips[slot] = key, target, skip
    accepts = np.array([final[s] for s in number], np.uint8)
    lists = [words[w] for w in ordered]
    offsets = np.concatenate(([0], np.cumsum([len(x) for x in lists]))).astype(np.int32)
    ids = np.array([i for x in lists for i in x], np.int32)
    arrays = [keys, targets, skips, accepts, offsets, ids]
    head = np.array([len(a) for a in arrays], np.int64).tobytes()
    return head + b"".join(a.tobytes() + b"\0" * (-a.nbytes % 8) for a in arrays)


class Lexicon:
    """The automaton over a memory map of its bytes; ``find`` walks many words at once."""

    def __init__(self, data: bytes):
        with tempfile.TemporaryFile() as file:  # a scratch copy that goes with the process
            file.write(data)
            file.flush()
            self._map = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
        sizes = np.frombuffer(self._map, np.int64, len(_FIELDS))
        at = sizes.nbytes
        for (name, kind), size in zip(_FIELDS, sizes.tolist()):
            array = np.frombuffer(self._map, kind, size, at)
            setattr(self, name, array)
            at += array.nbytes + -array.nbytes % 8
        self._bits = int(np.log2(len(self.keys)))

    def find(self, words: list[bytes]) -> np.ndarray:
        """The number of each word, -1 where it is not in the lexicon."""
        found = np.full(len(words), -1, np.int64)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        flat = np.frombuffer(b"".join(words), np.uint8)
        starts = np.cumsum(lengths) - lengths
        live = np.arange(len(words))
        state, total = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        at = 0
        while len(live):
            done = lengths[live] == at
            ended = live[done]
            ok = self.accepts[state[done]] == 1
            found[ended[ok]] = total[done][ok]
            live, state, total = live[~done], state[~done], total[~done]
            if not len(live):
                break
            key = state << 8 | flat[starts[live] + at]
            slot = _slot(key, self._bits)
            while True:
                held = self.keys[slot]
                wait = (held != key) & (held >= 0)
                if not wait.any():
                    break
                slot = np.where(wait, (slot + 1) & (len(self.keys) - 1), slot)
            hit = held == key
            live, slot = live[hit], slot[hit]
            state, total = self.targets[slot].astype(np.int64), total[hit] + self.skips[slot]
            at += 1
        return found
