"""A minimal acyclic transducer: sorted words in, a shared-suffix automaton with outputs out.

States with equal futures are merged while the words are added in order, so suffixes are
stored once.  Every arc carries the number of words that sort before the ones behind it;
the sum along a path is the word's rank, which addresses its output.  The automaton is a
handful of flat arrays in one buffer, written to a file and memory-mapped by its readers.
"""

from __future__ import annotations

import mmap
import struct
import tempfile
from array import array
from bisect import bisect_left
from collections.abc import Mapping

import numpy as np

_HEADER = struct.Struct("<4I")


def compile_words(outputs: Mapping[bytes, bytes]) -> bytes:
    """The automaton of ``{word: output}`` as one buffer (any words, the empty one included)."""
    words = sorted(outputs)
    arcs: list[list[tuple[int, int]]] = [[]]
    final = [False]
    known: dict[tuple, int] = {}
    path = [0]  # states of the last word
    last = b""

    def settle(depth: int) -> None:
        """Replace the states of the last word below ``depth`` by equal known ones."""
        while len(path) > depth + 1:
            state = path.pop()
            same = known.setdefault((final[state], tuple(arcs[state])), state)
            if same != state:
                label, _ = arcs[path[-1]][-1]
                arcs[path[-1]][-1] = (label, same)

    for word in words:
        common = 0
        while common < min(len(word), len(last)) and word[common] == last[common]:
            common += 1
        settle(common)
        for label in word[common:]:
            arcs.append([])
            final.append(False)
            arcs[path[-1]].append((label, len(arcs) - 1))
            path.append(len(arcs) - 1)
        final[path[-1]] = True
        last = word
    settle(0)

    # Number the reachable states; count the words behind each.
    order, number = [0], {0: 0}
    for state in order:
        for _, to in arcs[state]:
            if to not in number:
                number[to] = len(order)
                order.append(to)
    behind: dict[int, int] = {}
    stack = [0]
    while stack:
        state = stack[-1]
        todo = [to for _, to in arcs[state] if to not in behind]
        if todo:
            stack.extend(todo)
        else:
            behind[state] = final[state] + sum(behind[to] for _, to in arcs[state])
            stack.pop()
    first, labels, targets, skips = [0], [], [], []
    for state in order:
        before = int(final[state])
        for label, to in arcs[state]:
            labels.append(label)
            targets.append(number[to])
            skips.append(before)
            before += behind[to]
        first.append(len(labels))
    values = [outputs[w] for w in words]
    ends = np.cumsum([0] + [len(v) for v in values], dtype="<u4")
    parts = [_HEADER.pack(len(order), len(labels), len(words), int(ends[-1])),
             *(np.array(x, dtype="<u4").tobytes() for x in (first, targets, skips)), ends.tobytes(),
             bytes(final[s] for s in order), bytes(labels), b"".join(values)]
    return b"".join(parts)


class Transducer:
    """Lookups in a memory-mapped automaton."""

    def __init__(self, blob: bytes):
        with tempfile.TemporaryFile() as f:  # the mapping outlives the unnamed file
            f.write(blob)
            f.flush()
            self._map = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        view = memoryview(self._map)
        n_states, n_arcs, self.n_words, n_out = _HEADER.unpack_from(view)
        self.n_states, self.n_arcs = n_states, n_arcs
        at = _HEADER.size

        def take(n: int, kind: str) -> memoryview:
            nonlocal at
            size = n * array(kind).itemsize
            part = view[at:at + size].cast(kind)
            at += size
            return part

        self._first, self._to, self._skip = take(n_states + 1, "I"), take(n_arcs, "I"), take(n_arcs, "I")
        self._ends = take(self.n_words + 1, "I")
        self._final, self._label, self._out = take(n_states, "B"), take(n_arcs, "B"), take(n_out, "B")
        # Arcs lie in order of (state, label).
        owner = np.repeat(np.arange(n_states), np.diff(np.asarray(self._first)))
        self._arc = owner << 8 | np.asarray(self._label)

    def get(self, word: bytes) -> bytes | None:
        """The word's output, or None for a word that is not in the automaton."""
        first, label = self._first, self._label
        state = rank = 0
        for byte in word:
            low, high = first[state], first[state + 1]
            arc = bisect_left(label, byte, low, high)
            if arc == high or label[arc] != byte:
                return None
            rank += self._skip[arc]
            state = self._to[arc]
        if not self._final[state]:
            return None
        return bytes(self._out[self._ends[rank]:self._ends[rank + 1]])

    def get_all(self, words: list[bytes]) -> list[bytes | None]:
        """The outputs of many words, walked through the automaton in step."""
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        flat = np.frombuffer(b"".join(words), dtype=np.uint8)
        at = np.cumsum(sizes) - sizes
        to, skip = np.asarray(self._to), np.asarray(self._skip)
        out: list[bytes | None] = [None] * len(words)
        live = np.arange(len(words))
        state, rank = np.zeros(len(words), dtype=np.int64), np.zeros(len(words), dtype=np.int64)
        step = 0
        while len(live):
            done = sizes[live] == step
            if done.any():
                final = done & (np.asarray(self._final)[state] == 1)
                for word, r in zip(live[final].tolist(), rank[final].tolist()):
                    out[word] = bytes(self._out[self._ends[r]:self._ends[r + 1]])
                live, state, rank = live[~done], state[~done], rank[~done]
            if not self.n_arcs:
                break
            key = state << 8 | flat[at[live] + step]
            arc = np.minimum(np.searchsorted(self._arc, key), self.n_arcs - 1)
            hit = self._arc[arc] == key
            arc, live = arc[hit], live[hit]
            state, rank = to[arc].astype(np.int64), rank[hit] + skip[arc]
            step += 1
        return out


__all__ = ["compile_words", "Transducer"]
