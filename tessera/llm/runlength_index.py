"""A run-length compressed Burrows-Wheeler index with sampled run ends, and matching statistics against it.

The index of a set of byte strings keeps, per run of the transform, its symbol, first row
and the row its first symbol maps to, and the text positions (suffix array samples) of its
two ends; thresholds between neighbouring runs of one symbol tell which of the two ends
shares more with a row between them.  Nothing else of the suffix array is kept.

Matching statistics of many patterns are streamed right to left in step: each pattern
holds a row and a text position, extends by its next symbol where the row's run has it,
and otherwise jumps to the nearer end of a neighbouring run of that symbol.  The position
reached is that of a longest match, as far as ``DEPTH`` symbols decide.
"""

from __future__ import annotations

import numpy as np

DEPTH = 128       # symbols up to which suffixes are compared for thresholds and classes
_COMPARE_ROWS = 1 << 15


def suffix_array(codes: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling; ``codes`` (from 1) must end in a symbol found nowhere else."""
    n = len(codes)
    bits = int(codes.max()).bit_length()
    h = max(1, 62 // bits)
    padded = np.concatenate((codes.astype(np.int64), np.zeros(h, dtype=np.int64)))
    key = np.zeros(n, dtype=np.int64)
    for i in range(h):
        key = key << bits | padded[i:i + n]
    while True:
        order = np.argsort(key, kind="stable") if n < 1 << 12 else np.argsort(key)
        ordered = key[order]
        step = np.concatenate(([0], (ordered[1:] != ordered[:-1]).astype(np.int64)))
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.cumsum(step) + 1
        if int(step.sum()) == n - 1:
            return order
        key = rank << 32
        key[:n - h] |= rank[h:]
        h *= 2


class RunLengthIndex:
    """Index of byte strings for windows of ``window`` bytes (at most ``DEPTH``)."""

    def __init__(self, strings: list[bytes], window: int):
        self.window = window
        lengths = np.array([len(s) for s in strings], dtype=np.int64)
        raw = np.frombuffer(b"\0".join(strings) + b"\0", dtype=np.uint8)
        n = len(raw)  # each string and one separator; the last one ends the text
        ends = np.cumsum(lengths + 1) - 1
        inner = np.ones(n, dtype=bool)
        inner[ends] = False
        present = np.zeros(256, dtype=bool)
        present[raw[inner]] = True
        # Codes: 0 for bytes that the index does not hold, 1 the end, 2 a separator, then the bytes in order.
        code = np.where(present, np.cumsum(present) + 2, 0)
        self.code = code.astype(np.uint8 if code.max() < 256 else np.uint16)
        codes = self.code[raw]
        codes[ends] = 2
        codes[n - 1] = 1
        self.codes = np.concatenate((codes, np.ones(window + DEPTH, dtype=codes.dtype)))
        order = suffix_array(codes)
        shifted = codes[order - 1].astype(np.int64)  # the transform; the row of position 0 holds the last separator
        heads = np.flatnonzero(np.concatenate(([True], shifted[1:] != shifted[:-1])))
        self.run_first = heads
        self.run_symbol = shifted[heads]
        run_last = np.append(heads[1:], n) - 1
        self.run_last = run_last
        self.first_position, self.last_position = order[heads], order[run_last]
        sizes = run_last - heads + 1
        # Rows of a symbol are the runs of that symbol in order.
        by_symbol = np.argsort(self.run_symbol, kind="stable")
        self.run_target = np.empty(len(heads), dtype=np.int64)
        self.run_target[by_symbol] = np.cumsum(sizes[by_symbol]) - sizes[by_symbol]
        self.by_symbol = by_symbol
        self.symbol_key = self.run_symbol[by_symbol] * len(heads) + by_symbol
        common = self._common(order)
        self.class_first = np.flatnonzero(np.concatenate(([True], common < window)))
        # Threshold of each run: the row with the least common prefix since the run of its symbol before.
        self.threshold = np.zeros(len(heads), dtype=np.int64)
        low = (np.concatenate(([0], common)) << 40) | np.arange(n)
        previous, following = by_symbol[:-1], by_symbol[1:]
        pair = self.run_symbol[previous] == self.run_symbol[following]
        previous, following = previous[pair], following[pair]
        self.threshold[following] = _range_min(low, run_last[previous] + 1, heads[following]) & ((1 << 40) - 1)

    def _common(self, order: np.ndarray) -> np.ndarray:
        """Common prefix lengths of neighbouring rows, up to DEPTH."""
        views = np.lib.stride_tricks.sliding_window_view(self.codes, DEPTH)
        out = np.empty(max(0, len(order) - 1), dtype=np.int64)
        for at in range(0, len(out), _COMPARE_ROWS):
            a, b = order[at:at + _COMPARE_ROWS], order[at + 1:at + 1 + _COMPARE_ROWS]
            m = min(len(a), len(b))
            differ = views[a[:m]] != views[b[:m]]
            first = differ.argmax(axis=1)
            out[at:at + m] = np.where(differ[np.arange(m), first], first, DEPTH)
        return out

    def matches(self, patterns: list[bytes], wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(pattern, place, class) of each window that occurs in the index text.

        Only the first ``wanted[i]`` windows of pattern ``i`` are asked for.  Windows of one
        class are equal.
        """
        sizes = np.array([len(p) for p in patterns], dtype=np.int64)
        order = np.argsort(-sizes, kind="stable")  # long ones first: the active patterns are a prefix
        sizes, wanted = sizes[order], wanted[order]
        flat = self.code[np.frombuffer(b"".join([patterns[i] for i in order]), dtype=np.uint8)]
        base = np.cumsum(sizes) - sizes
        row = np.zeros(len(patterns), dtype=np.int64)
        position = np.full(len(patterns), self.first_position[0])
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        for place in range(int(sizes[0]) - 1 if len(sizes) else -1, -1, -1):
            active = int(np.searchsorted(-sizes, -place, side="left"))  # sizes > place
            symbol = flat[base[:active] + place].astype(np.int64)
            q, p = row[:active], position[:active]
            run = np.searchsorted(self.run_first, q, side="right") - 1
            hit = self.run_symbol[run] == symbol
            jump = np.flatnonzero(~hit)
            if len(jump):
                key = symbol[jump] * len(self.run_first) + run[jump]
                after = np.searchsorted(self.symbol_key, key)
                n = len(self.symbol_key)
                up = self.by_symbol[np.minimum(after, n - 1)]
                down = self.by_symbol[np.maximum(after - 1, 0)]
                has_up = (after < n) & (self.run_symbol[up] == symbol[jump])
                has_down = (after > 0) & (self.run_symbol[down] == symbol[jump])
                take_down = has_down & (~has_up | (q[jump] < self.threshold[up]))
                run[jump] = np.where(take_down, down, up)
                q[jump] = np.where(take_down, self.run_last[down], self.run_first[up])
                p[jump] = np.where(take_down, self.last_position[down], self.first_position[up])
                lost = jump[~(has_up | has_down)]  # the symbol is not in the index
            q[:] = self.run_target[run] + q - self.run_first[run]
            p[:] = p - 1
            if len(jump) and len(lost):
                q[lost], p[lost] = 0, self.first_position[0]
            ask = np.flatnonzero((wanted[:active] > place) & (sizes[:active] >= place + self.window))
            if len(ask):
                found.append((ask, np.full(len(ask), place), q[ask].copy(), p[ask].copy()))
        if not found:
            none = np.empty(0, dtype=np.int64)
            return none, none, none
        pattern, place, row, position = (np.concatenate(f) for f in zip(*found))
        ours = np.lib.stride_tricks.sliding_window_view(flat, self.window)
        theirs = np.lib.stride_tricks.sliding_window_view(self.codes, self.window)
        equal = np.zeros(len(pattern), dtype=bool)
        for at in range(0, len(pattern), _COMPARE_ROWS):
            s = slice(at, at + _COMPARE_ROWS)
            equal[s] = (ours[base[pattern[s]] + place[s]] == theirs[np.maximum(position[s], 0)]).all(axis=1)
        equal &= position >= 0
        kind = np.searchsorted(self.class_first, row[equal], side="right") - 1
        return order[pattern[equal]], place[equal], kind


def _range_min(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Minimum of ``values[start:end + 1]`` for many ranges, by doubling tables."""
    out = np.empty(len(start), dtype=values.dtype)
    level = np.frexp(end - start + 1)[1] - 1
    table, width = values, 1
    for j in range(int(level.max()) + 1 if len(level) else 0):
        if j:
            table = np.minimum(table[:-width], table[width:])
            width *= 2
        pick = np.flatnonzero(level == j)
        if len(pick):
            out[pick] = np.minimum(table[start[pick]], table[end[pick] - width + 1])
    return out


__all__ = ["suffix_array", "RunLengthIndex"]
