"""Licence scans with a generalised suffix automaton.

The automaton holds every run of words of all templates. A text streams through it: at each word the state gives the
longest run ending there that some template has (matching statistics), and its suffix links the longest run of every
other template. Runs that cannot be made longer in their template are matches; matches of one template that lie in the
same order in text and template are chained, and a chain that covers enough of the template labels that span of the text.
Short notices are names of licences: they are matched by runs of two words, and only fillers may be missing or added.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: The base phrases with their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Notices and opening passages of public licences, by label.
TEMPLATES = [
    ("mit", "MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
            "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
            "the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
            "conditions: The above copyright notice and this permission notice shall be included in all copies or "
            "substantial portions of the Software."),
    ("apache-2.0", "Apache License, Version 2.0"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                   "compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
                   "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
                   "CONDITIONS OF ANY KIND, either express or implied."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
            "the following conditions are met: Redistributions of source code must retain the above copyright notice, this "
            "list of conditions and the following disclaimer."),
    ("gpl-3.0", "GNU General Public License, version 3"),
    ("gpl-2.0", "GNU General Public License, version 2"),
    ("gpl-notice", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                   "General Public License as published by the Free Software Foundation, either version 3 of the License, "
                   "or (at your option) any later version."),
    ("lgpl", "GNU Lesser General Public License"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
                "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("cc-by-nc", "CC BY-NC 4.0"),
    ("cc-by-sa", "CC BY-SA 4.0"),
    ("cc-by-nc", "Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-sa", "Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-4.0", "Creative Commons Attribution 4.0 International License"),
    ("cc0", "CC0 1.0 Universal"),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    # other names
    ("apache-2.0", "Apache License, Version 2"), ("apache-2.0", "Apache License v2"), ("apache-2.0", "Apache 2.0 License"),
    ("bsd", "BSD License"), ("bsd", "BSD 2-Clause"), ("bsd", "BSD 3-Clause"), ("bsd", "2-Clause BSD"), ("bsd", "3-Clause BSD"),
    ("isc", "ISC License"),
    ("mpl-2.0", "Mozilla Public License, Version 2.0"), ("mpl-2.0", "Mozilla Public License v2"), ("mpl-2.0", "MPL 2.0"), ("mpl-2.0", "MPL v2"),
    ("gpl-3.0", "GNU General Public License v3"), ("gpl-3.0", "GNU General Public License 3"), ("gpl-3.0", "Version 3 of the GNU General Public License"),
    ("gpl-2.0", "GNU General Public License v2"), ("gpl-2.0", "GNU General Public License 2"), ("gpl-2.0", "Version 2 of the GNU General Public License"),
    ("lgpl", "GNU LGPL"),
    ("cc-by-nc", "CC BY-NC"), ("cc-by-nc", "Creative Commons Attribution-NonCommercial"),
    ("cc-by-sa", "CC BY-SA"), ("cc-by-sa", "Creative Commons Attribution-ShareAlike"),
    ("cc-by-nc-sa", "CC BY-NC-SA"), ("cc-by-nc-sa", "Creative Commons Attribution-NonCommercial-ShareAlike"),
    ("cc-by-nd", "CC BY-ND"), ("cc-by-nd", "Creative Commons Attribution-NoDerivatives"), ("cc-by-nd", "Creative Commons Attribution-NoDerivs"),
    ("cc-by-nc-nd", "CC BY-NC-ND"), ("cc-by-nc-nd", "Creative Commons Attribution-NonCommercial-NoDerivatives"),
    ("cc-by-nc-nd", "Creative Commons Attribution-NonCommercial-NoDerivs"),
    ("cc-by-4.0", "CC BY 4.0"),
]

#: Words of a match that counts for longer templates, and for short ones, of fewer than SHORT words; words between two
#: matches of a chain; share of a template that a chain must cover; words that a short notice may lack or have besides.
MIN_MATCH = 4
MIN_SHORT = 2
SHORT = 9
MAX_GAP = 24
MIN_COVER = 0.75
FILLERS = frozenset(b"a an the in its of or under gnu v ver version license licence licensed software international universal unported generic".split())

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def words_of(text: str | None) -> list[bytes]:
    """Runs of ASCII digits and letters (in lower case) and of anything beyond ASCII."""
    return _WORD.findall((text or "").encode("utf-8", "surrogatepass").lower())


class SuffixAutomaton:
    """All runs of words of the given sequences. State 0 is the empty run."""

    def __init__(self, sequences: list[list[bytes]]):
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]
        ends: list[list[tuple[int, int]]] = [[]]  # (sequence, words up to the end) of the state's runs
        for number, sequence in enumerate(sequences):
            state = 0
            for k, word in enumerate(sequence):
                state = self._extend(state, word)
                while len(ends) < len(self.next):
                    ends.append([])
                ends[state].append((number, k + 1))
        for state in sorted(range(1, len(self.next)), key=lambda s: -self.length[s]):
            ends[self.link[state]] += ends[state]
        self.ends = ends

    def _new(self, length: int, link: int, arcs: dict[bytes, int]) -> int:
        self.next.append(arcs)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _split(self, state: int, word: bytes) -> int:
        """The state of the longest run of ``state`` followed by ``word``, made its own if it shares one."""
        old = self.next[state][word]
        if self.length[old] == self.length[state] + 1:
            return old
        copy = self._new(self.length[state] + 1, self.link[old], dict(self.next[old]))
        self.link[old] = copy
        while state >= 0 and self.next[state].get(word) == old:
            self.next[state][word] = copy
            state = self.link[state]
        return copy

    def _extend(self, last: int, word: bytes) -> int:
        if word in self.next[last]:
            return self._split(last, word)
        new = self._new(self.length[last] + 1, 0, {})
        while last >= 0 and word not in self.next[last]:
            self.next[last][word] = new
            last = self.link[last]
        if last >= 0:
            self.link[new] = self._split(last, word)
        return new


class LicenceScanner:
    def __init__(self, phrases: dict[str, str] = PHRASES, templates: list[tuple[str, str]] = TEMPLATES):
        phrase_words = [words_of(p) for p in phrases]
        self.phrase_labels = list(phrases.values())
        self.labels = [label for label, _ in templates]
        self.sizes = [len(words_of(t)) for _, t in templates]
        self.automaton = a = SuffixAutomaton([words_of(t) for _, t in templates] + phrase_words)
        self.known = frozenset(a.next[0])
        n = len(templates)
        # a phrase is a sequence of its own, so its state's longest run is the phrase itself
        own: dict[int, tuple[int, int]] = {}
        for k, phrase in enumerate(phrase_words):
            state = 0
            for word in phrase:
                state = a.next[state][word]
            own[state] = (len(phrase), k)
        self.phrases_at: list[list[tuple[int, int]]] = [[] for _ in a.next]
        for state in sorted(range(1, len(a.next)), key=lambda s: a.length[s]):
            self.phrases_at[state] = self.phrases_at[a.link[state]] + ([own[state]] if state in own else [])
        self.least = [min(MIN_SHORT if size < SHORT else MIN_MATCH, size) for size in self.sizes]
        self.words = [words_of(t) for _, t in templates]
        # (template, words up to the end of the run, longest run that ends there, word after it) by state
        following = [t[1:] + [b""] for t in self.words]
        self.hits: list[list[tuple[int, int, int, bytes]]] = [[] for _ in a.next]
        for state in sorted(range(1, len(a.next)), key=lambda s: a.length[s]):
            own_ends = {(t, end) for t, end in a.ends[state] if t < n}
            self.hits[state] = [(t, end, a.length[state], following[t][end - 1]) for t, end in sorted(own_ends) if a.length[state] >= self.least[t]]
            self.hits[state] += [hit for hit in self.hits[a.link[state]] if hit[:2] not in own_ends]

    def scan(self, text: str | None) -> dict:
        words = words_of(text)
        a, known = self.automaton, self.known
        arcs, link, length, phrases_at, hits = a.next, a.link, a.length, self.phrases_at, self.hits
        places: list[tuple[int, int]] = []
        matches: dict[int, list[tuple[int, int, int]]] = {}
        state = run = 0
        for i, word in enumerate(words):
            if word not in known:
                state = run = 0
                continue
            if word not in arcs[state]:
                while state and word not in arcs[state]:
                    state = link[state]
                run = length[state]
            state = arcs[state][word]
            run += 1
            for size, k in phrases_at[state]:
                if size <= run:
                    places.append((i + 1 - size, k))
            if hits[state]:
                self._collect(matches, words, i + 1, state, run)
        chains = sorted(chain for t, found in matches.items() for chain in self._chains(t, found, words))
        best = max((covered / self.sizes[t] for _, _, t, covered, _ in chains), default=0.0)
        spans = self._spans(chains)
        base = sorted({self.phrase_labels[k] for _, k in places})
        starts = [start for start, _ in places]
        return {
            "n_words": len(words), "n_base": len(places), "first_word": min(starts, default=None),
            "last_word": max(starts, default=None), "base_labels": ",".join(base),
            "labels": ",".join(sorted({*base, *(label for _, _, label, _ in spans)})),
            "score": 1.0 if places else round(best, 6),
            "spans": [{"start": s, "end": e, "label": label, "cover": cover} for s, e, label, cover in spans],
        }

    def _collect(self, matches: dict, words: list[bytes], end: int, state: int, run: int) -> None:
        """Note the longest run before ``end`` of every template in which the text's next word does not carry it on."""
        after = words[end] if end < len(words) else None
        for t, template_end, longest, following in self.hits[state]:
            n = min(run, longest)
            if n >= self.least[t] and following != after:
                matches.setdefault(t, []).append((end - n, template_end - n, n))

    def _chains(self, t: int, matches: list[tuple[int, int, int]], words: list[bytes]) -> list[tuple[int, int, int, int, bool]]:
        """(start, end, template, words of it covered, whether nothing that matters is missing) of chains that do not overlap, the best ones first.

        A chain of a short notice counts if only fillers are missing or added, or for the score if it has MIN_MATCH words.
        """
        matches = sorted(matches)
        short, template, lacking = self.sizes[t] < SHORT, self.words[t], set()
        covered, came, begins = [0] * len(matches), [-1] * len(matches), [0] * len(matches)
        first = 0
        for j, (x, y, n) in enumerate(matches):
            covered[j], begins[j] = n, x
            while matches[first][0] < x - MAX_GAP - self.sizes[t]:  # no template run is longer than the template
                first += 1
            for i in range(first, j):
                u, v, m = matches[i]
                overlap = max(u + m - x, v + m - y, 0)
                if x > u and y > v and x - u - m <= MAX_GAP and overlap < n and covered[i] + n - overlap > covered[j] and not (
                    short and not FILLERS.issuperset(words[u + m : x + overlap] + template[v + m : y + overlap])
                ):
                    covered[j], came[j], begins[j] = covered[i] + n - overlap, i, begins[i]
        if short:
            for j, (_, y, n) in enumerate(matches):
                first = j
                while came[first] >= 0:
                    first = came[first]
                if not FILLERS.issuperset(template[: matches[first][1]] + template[y + n :]):
                    lacking.add(j)
        continued = set(came)
        chains, taken = [], []
        for j in sorted((j for j in range(len(matches)) if j not in continued), key=lambda j: (-covered[j], j)):
            if j in lacking and covered[j] < MIN_MATCH:
                continue
            start, end = begins[j], matches[j][0] + matches[j][2]
            at = bisect_left(taken, (start, end))
            if (at and taken[at - 1][1] > start) or (at < len(taken) and taken[at][0] < end):
                continue
            taken.insert(at, (start, end))
            chains.append((start, end, t, covered[j], j not in lacking))
        return chains

    def _spans(self, chains: list[tuple[int, int, int, int, bool]]) -> list[tuple[int, int, str, float]]:
        """(start, end, label, share covered) of chains that cover enough. One that lacks words of its template yields
        to a chain of another label over the same text that covers more words, or as many and more of its template; a short
        notice also yields to a longer one that holds it."""
        good = [(s, e, t, n) for s, e, t, n, whole in chains if whole and n >= MIN_COVER * self.sizes[t]]

        good.sort()
        starts, longest = [s for s, *_ in good], max((e - s for s, e, *_ in good), default=0)

        def yields(s: int, e: int, t: int, n: int) -> bool:
            size, label = self.sizes[t], self.labels[t]
            around = range(bisect_right(starts, s - longest), bisect_left(starts, e))  # no span farther off can overlap
            return any(
                (label != self.labels[u] and n < size and s < f and b < e and (m, m / self.sizes[u]) > (n, n / size))
                or (size < SHORT and self.sizes[u] < SHORT and n < m and b <= s and e <= f)
                for b, f, u, m in (good[i] for i in around)
            )

        return [(s, e, self.labels[t], n / self.sizes[t]) for s, e, t, n in good if not yields(s, e, t, n)]


_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("label", pa.string()), ("cover", pa.float64())])
_RESULT = pa.struct([
    ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
    ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()), ("spans", pa.list_(_SPAN)),
])
_RESULT_TYPE = (
    "struct<n_words:long,n_base:long,first_word:long,last_word:long,base_labels:string,labels:string,score:double,"
    "spans:array<struct<start:long,end:long,label:string,cover:double>>>"
)


def licence_report(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    phrases: dict[str, str] = PHRASES, templates: list[tuple[str, str]] = TEMPLATES,
) -> DataFrame:
    """(id_col, n_words, n_base, first_word, last_word, base_labels, labels, score, spans): one row for each row.

    ``spans`` are the stretches of words (from 0, end exclusive) that cover at least MIN_COVER of a template. ``score`` is
    the largest share of a template that a text covers, 1 where a phrase stands. Null and empty texts have no words and score 0.
    Repeated rows and ids each get their row, an empty table gives none, other columns are not read. The work grows
    with a text's length alone: a chain is matched within its template's reach, a span is held against those it overlaps.
    """
    scanner = LicenceScanner(phrases, templates)  # a few thousand states, sent with the function

    @F.arrow_udf(_RESULT_TYPE)
    def scan(texts: pa.Array) -> pa.Array:
        return pa.array([scanner.scan(t.as_py()) for t in texts], _RESULT)

    return docs.select(F.col(id_col), scan(F.col(text_col)).alias("x")).select(id_col, "x.*")
