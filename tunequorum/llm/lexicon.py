"""A minimal acyclic transducer from words to token ids, as one file that workers map into memory."""

from __future__ import annotations

import struct
from collections.abc import Iterable

import numpy as np

_HEADER = "<4s5I"  # magic, states, arcs, words, ids, longest word
_MAGIC = b"MATL"


def build(entries: Iterable[tuple[bytes, list[int]]]) -> bytes:
    """Compile distinct (word, ids) into the automaton's file.

    Equal suffixes share their states. An arc carries how many words sort before those that pass it, so the sum on a
    word's path is the word's number, and the number gives its ids.
    """
    ordered = sorted(entries)
    register: dict[tuple, int] = {}
    finals: list[bool] = []
    arcs_of: list[tuple] = []

    def settled(node: list) -> int:
        """The one state for this right language; ``node`` is [final, {label: state}]."""
        key = (node[0], tuple(sorted(node[1].items())))
        if key not in register:
            register[key] = len(finals)
            finals.append(node[0])
            arcs_of.append(key[1])
        return register[key]

    path: list[list] = [[False, {}]]  # open nodes along the last word
    last = b""
    for word, _ in ordered:
        shared = 0
        while shared < min(len(word), len(last)) and word[shared] == last[shared]:
            shared += 1
        for depth in range(len(last), shared, -1):
            path[depth - 1][1][last[depth - 1]] = settled(path.pop())
        path += [[False, {}] for _ in word[shared:]]
        path[-1][0] = True
        last = word
    for depth in range(len(last), 0, -1):
        path[depth - 1][1][last[depth - 1]] = settled(path.pop())
    root = settled(path[0])

    below = np.zeros(len(finals), np.int64)  # words from each state; arcs lead to states settled before
    keys, targets, skips = [], [], []
    for state, arcs in enumerate(arcs_of):
        seen = int(finals[state])
        for label, target in arcs:
            keys.append(state << 8 | label)
            targets.append(target)
            skips.append(seen)
            seen += int(below[target])
        below[state] = seen
    ids = [i for _, found in ordered for i in found]
    ends = np.cumsum([len(found) for _, found in ordered])
    longest = max((len(w) for w, _ in ordered), default=0)
    head = struct.pack(_HEADER, _MAGIC, len(finals), len(keys), len(ordered), len(ids), longest)
    parts = [
        np.array(keys, "<u8"), np.array(targets, "<u4"), np.array(skips, "<u4"),
        np.r_[0, ends].astype("<u4"), np.array(ids, "<u4"), np.array([*finals, root], "<u4"),
    ]
    return head + b"".join(p.tobytes() for p in parts)


class Lexicon:
    """The compiled file, mapped: only the pages that lookups touch are read, and processes share them."""

    def __init__(self, path: str):
        data = np.memmap(path, np.uint8, "r")
        magic, states, arcs, words, n_ids, self.longest = struct.unpack_from(_HEADER, data)
        if magic != _MAGIC:
            raise ValueError("not a lexicon")
        at = struct.calcsize(_HEADER)

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            size = np.dtype(kind).itemsize * n
            at += size
            return data[at - size : at].view(kind)

        self.keys, self.targets, self.skips = take("<u8", arcs), take("<u4", arcs), take("<u4", arcs)
        self.ends, self.ids = take("<u4", words + 1), take("<u4", n_ids)
        self.finals, self.root = take("<u4", states), int(take("<u4", 1)[0])

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """Number of each word, -1 if unknown; all words walk side by side, a byte at a time."""
        number = np.full(len(words), -1, np.int64)
        lengths = np.array([len(w) for w in words], np.int64)
        on = np.flatnonzero((lengths <= self.longest) & (lengths > 0)) if len(self.keys) else np.zeros(0, np.int64)
        every = np.frombuffer(b"".join(words), np.uint8)
        start = np.r_[0, np.cumsum(lengths)[:-1]] if len(words) else lengths
        state, total = np.full(len(on), self.root, np.uint64), np.zeros(len(on), np.int64)
        step = 0
        while len(on):
            key = state << np.uint64(8) | every[start[on] + step]
            arc = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            hit = self.keys[arc] == key
            on, arc = on[hit], arc[hit]
            state, total = self.targets[arc].astype(np.uint64), total[hit] + self.skips[arc]
            step += 1
            over = lengths[on] == step
            done = over & (self.finals[state.astype(np.int64)] == 1)
            number[on[done]] = total[done]
            on, state, total = on[~over], state[~over], total[~over]
        return number

    def packed_ids(self, number: int) -> bytes:
        """Little-endian unsigned 32-bit ids of a word."""
        return self.ids[self.ends[number] : self.ends[number + 1]].tobytes()
