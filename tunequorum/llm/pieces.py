"""Texts as pieces that can be tokenized apart from each other."""

from __future__ import annotations

import re
import sys
from collections.abc import Callable, Iterable, Iterator
from types import ModuleType

import numpy as np
import pyarrow as pa

#: Byte-level tokenizers never join what stands on the two sides of a place before a single space between
#: characters that aren't white space, so a text may be cut there.
_CUT = re.compile(r"(?<=\S) (?=\S)")
_OTHER_SPACE = re.compile(r"[^\S \n]")

#: Nor do they join a letter or digit with marks like these behind it.
MARKS = ".,;:!?|#$%&*"

#: Characters of texts that are in work together.
CHUNK_CHARS = 1 << 20
#: Bytes that a worker remembers of each kind of piece before what it hasn't met again goes, and what an entry takes
#: besides its texts.
MEMORY_BYTES = 192 << 20
ENTRY_BYTES = 220


def cut(text: str) -> list[str]:
    """``text`` cut at such spaces, which are left out."""
    if "  " in text or " \n" in text or "\n " in text or text[:1] == " " or text[-1:] == " " or _OTHER_SPACE.search(text):
        return _CUT.split(text)
    return text.split(" ")


def pieces(text: str) -> list[str]:
    """``text`` cut before such spaces; joined, the pieces give the text."""
    first, *rest = cut(text)
    return [first, *[" " + p for p in rest]] if text else []


def chunks(texts: Iterable[str | None]) -> Iterator[list[str]]:
    """Texts in their order, in lists of about CHUNK_CHARS characters; null is empty."""
    held, size = [], 0
    for text in texts:
        held.append(text or "")
        size += len(held[-1])
        if size >= CHUNK_CHARS:
            yield held
            held, size = [], 0
    if held:
        yield held


class Memory:
    """What is known of pieces, in two generations: when the young one is full the old one goes and the young one takes
    its place, so what is met again stays and the bytes held are bounded whatever the length of pieces."""

    def __init__(self):
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.held = 0

    def add(self, pieces: list[str], ids: list[bytes]) -> None:
        self.young.update(zip(pieces, ids))
        self.held += sum(map(len, pieces)) + sum(map(len, ids)) + ENTRY_BYTES * len(pieces)

    def recall(self, pieces: set[str]) -> list[str]:
        """Take pieces that the old generation knows into the young one; the others are returned."""
        known = [p for p in pieces if p in self.old] if self.old else []
        self.add(known, [self.old[p] for p in known])
        return list(pieces.difference(known))

    def age(self, limit: int) -> None:
        if 2 * self.held > limit:
            self.young, self.old, self.held = {}, self.young, 0


def worker_values() -> dict:
    """What outlives a task in its Python worker; functions sent by value have no globals that do."""
    return vars(sys.modules.setdefault("tunequorum_worker_memory", ModuleType("tunequorum_worker_memory")))


def worker_memory(key: str) -> dict[str, Memory]:
    """Memories that outlive a task. There is one for each ``key``, which names what the ids depend on."""
    return worker_values().setdefault(key, {kind: Memory() for kind in ("first", "later", "marks")})


class PieceEncoder:
    """Encodes texts through ``encode_new``, which gets distinct strings and returns each one's packed ids.

    ``memory`` holds what is known of the first pieces of texts, of those behind a space, and of the marks behind both,
    each within ``limit`` bytes beside what a chunk of texts needs at once.
    """

    def __init__(
        self, encode_new: Callable[[list[str]], list[bytes]], memory: dict[str, Memory], limit: int = MEMORY_BYTES
    ):
        self.encode_new, self.memory, self.limit = encode_new, memory, limit

    def __call__(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        for chunk in chunks(texts):
            for known in self.memory.values():
                known.age(self.limit)
            first, later = self.memory["first"].young, self.memory["later"].young
            parts = [cut(text) for text in chunk]
            found = [list(map(later.get, rest)) for _, *rest in parts]
            self._learn("first", {p[0] for p in parts if p[0] not in first}, "")
            lacking = [k for k, ids in enumerate(found) if None in ids]
            self._learn("later", {p for k in lacking for p, ids in zip(parts[k][1:], found[k]) if ids is None}, " ")
            for k in lacking:
                found[k] = map(later.__getitem__, parts[k][1:])
            for part, ids in zip(parts, found):
                yield first[part[0]] + b"".join(ids)

    def _learn(self, kind: str, pieces: set[str], before: str) -> None:
        known, marks = self.memory[kind], self.memory["marks"]
        plain, marked = set(), []
        for piece in known.recall(pieces):
            stem = piece.rstrip(MARKS)
            if len(stem) == len(piece) or not stem or not stem[-1].isalnum():
                plain.add(piece)
            else:
                marked.append((piece, stem, piece[len(stem) :]))
        plain.update(known.recall({stem for _, stem, _ in marked if stem not in known.young and stem not in plain}))
        new = list(plain)
        known.add(new, self.encode_new([before + piece for piece in new]))
        new = marks.recall({mark for _, _, mark in marked if mark not in marks.young})
        marks.add(new, self.encode_new(new))
        known.add([piece for piece, _, _ in marked], [known.young[stem] + marks.young[mark] for _, stem, mark in marked])


def joined(pieces: list[str], size: int) -> tuple[list[list[int]], list[int]]:
    """(groups, others): places of pieces that begin with one space and neither go on nor end with white space, in groups of
    ``size``, and of all others.

    A group's pieces one behind the other are a text that is cut between them, so it may be encoded in one go.
    """
    plain, others = [], []
    for k, piece in enumerate(pieces):
        whole = piece[:1] == " " and len(piece) > 1 and not piece[1].isspace() and not piece[-1].isspace()
        (plain if whole else others).append(k)
    return [plain[at : at + size] for at in range(0, len(plain), size)], others


#: Bytes of text that are cut and looked up together, and what ArrayEncoder remembers of pieces.
WINDOW_BYTES = 2 << 20
ARRAY_MEMORY_BYTES = 64 << 20
#: Marks behind a letter or digit that are cut off together, at most.
MARK_RUN = 4
#: More bytes than those behind a place that decide whether it is one: marks, a space or line feed, and white space of 3 bytes.
AHEAD = 16


def _among(of: bytes) -> np.ndarray:
    return np.isin(np.arange(256), list(of))


_WHITE = _among(b" \t\n\v\f\r\x1c\x1d\x1e\x1f")
_MARK = _among(MARKS.encode())
_ALNUM = _among(bytes(b for b in range(128) if chr(b).isalnum()))
#: Second bytes of the letters from U+00C0 to U+00FF, whose first byte is 0xC3.
_LATIN = _among(bytes(c - 0x40 for c in range(0xC0, 0x100) if chr(c).isalpha()))
#: First bytes of white space beyond ASCII in UTF-8, and all of it.
_WIDE_FIRST = _among(b"\xc2\xe1\xe2\xe3")
_WIDE = [chr(c).encode() for c in (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]


def cut_places(data: np.ndarray) -> np.ndarray:
    """For every byte of UTF-8 ``data`` whether a piece may begin there: at a single space or on both sides of a single line
    feed between other characters than white space, and at up to MARK_RUN marks between a letter or digit and such a place.
    """
    white = _WHITE[data]
    lead = np.flatnonzero(_WIDE_FIRST[data])
    for wide in _WIDE if len(lead) else []:
        at = lead[lead + len(wide) <= len(data)]
        for j, byte in enumerate(wide):
            at = at[data[at + j] == byte]
        for j in range(len(wide)):
            white[at + j] = True
    alone = white.copy()
    alone[1:] &= ~white[:-1]
    alone[:-1] &= ~white[1:]
    line = alone & (data == 0x0A)
    places = line | (alone & (data == 0x20))
    places[1:] |= line[:-1]
    end = np.flatnonzero(places[1:] & _MARK[data[:-1]])  # marks that stand last in a run
    for _ in range(MARK_RUN):
        end = end[(end > 0) & _MARK[data[end]]]
        before = data[end - 1]
        places[end[_ALNUM[before] | (_LATIN[before] & (end > 1) & (data[end - 2] == 0xC3))]] = True
        end = end - 1
    return places


class ArrayEncoder:
    """Encodes a column of texts through ``encode_new``, which gets distinct strings and returns each one's packed ids.

    Works on windows of the column's bytes: a window is cut into pieces without copying them, each of its different pieces is
    looked up once, and the ids of all are gathered from those. However long texts are, what is held is bounded by the
    window and by ``limit`` bytes of ``memory``, as long as pieces are.
    """

    def __init__(
        self, encode_new: Callable[[list[str]], list[bytes]], memory: Memory, end_id: int, limit: int = ARRAY_MEMORY_BYTES,
        window: int = WINDOW_BYTES,
    ):
        self.encode_new, self.memory, self.end, self.limit, self.window = encode_new, memory, np.array([end_id], "<u4").tobytes(), limit, window

    def __call__(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(ids, stops) of each window: token ids, the end id behind each text, and the places behind the end ids. A text's
        ids may begin in windows before the one where they stop; null is empty."""
        texts = texts.cast(pa.large_string()).fill_null("")
        _, edges, data = texts.buffers()
        edges = np.frombuffer(edges, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
        data = np.frombuffer(data or b"", np.uint8)[edges[0] : edges[-1]]
        edges = edges - edges[0]
        at, done, window = 0, 0, self.window
        while done < len(texts):
            stop = min(at + window, len(data))
            part = data[at:stop]
            places = cut_places(part)
            places[edges[np.searchsorted(edges, at) : np.searchsorted(edges, stop)] - at] = True
            places[:1] = True
            starts = np.flatnonzero(places)
            if stop < len(data):  # places near the window's end depend on bytes behind it
                starts = starts[starts < len(part) - AHEAD]
                if len(starts) < 2:
                    window *= 2
                    continue
                stop, starts = at + int(starts[-1]), starts[:-1]
            last = int(np.searchsorted(edges[1:], stop, "right"))
            yield self._window(data[at:stop], starts, edges[done + 1 : last + 1] - at)
            at, done, window = stop, last, self.window

    def _window(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        bounds = np.append(starts, len(data)).astype(np.int32) if len(starts) else np.zeros(1, np.int32)
        found = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(data)]).dictionary_encode()
        names = found.dictionary.to_pylist()
        packed = [*self._learned(names), self.end]
        sizes = np.fromiter(map(len, packed), np.int64, len(packed)) // 4
        first = (np.cumsum(sizes) - sizes).astype(np.int32)
        before = np.searchsorted(bounds[:-1], ends)  # pieces before the end of each text
        which = np.insert(found.indices.to_numpy(), before, len(names))
        size_of = sizes[which]
        stops = np.cumsum(size_of)
        places = np.repeat(first[which] - (stops - size_of).astype(np.int32), size_of)
        places += np.arange(len(places), dtype=np.int32)
        return np.frombuffer(b"".join(packed), "<u4")[places], stops[before + np.arange(len(ends))]

    def _learned(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of different pieces."""
        known = self.memory
        known.age(self.limit)
        found = list(map(known.young.get, pieces))
        lacking = [k for k, ids in enumerate(found) if ids is None]
        if lacking:
            again = list(map(known.old.get, [pieces[k] for k in lacking]))
            new = [k for k, ids in zip(lacking, again) if ids is None]
            made = iter(self.encode_new([pieces[k].decode("utf-8") for k in new]))
            again = [next(made) if ids is None else ids for ids in again]
            known.add([pieces[k] for k in lacking], again)
            for k, ids in zip(lacking, again):
                found[k] = ids
        return found
