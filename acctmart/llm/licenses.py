"""License scans (operator 4): MinHash bands over overlapping windows find templates, exact containment verifies.

A text's words are cut into windows twice as long as a template, each starting half a window after the one before, so that any
place of a template lies whole in a window. Window and template are sets of five-word shingles. Each has ``bands(...)`` MinHash values, every one a band: so many
that a window holding ``CONTAINED`` of a template misses all of them with a probability below ``MISS``. A window that shares a band with
a template is a candidate; it is a match if it holds that share of the template's shingles, counted exactly. Each place in a
matching window gives a row: the shingles there are cut where the template begins anew, and of what overlaps, as the same place met by
two windows, the part with the largest share stays.

A minimum that equals a template's is a shingle of that template. So windows without any template shingle can't share a band, and only the
others get their values computed: the result is that of computing all.

A template of fewer than five words is one shingle of all its words, met by windows of that width: a match holds it whole, and is
found by comparing the hashes, without bands. A name of a license, in a table of its own, is a match only if one of ``CUES`` stands at most ``NEAR``
words before or behind it, or if it fills its line.

Templates are a bounded table given by the caller and go to the tasks with the code; there is no shuffle, and a task holds one
slice of texts. Words are lower-cased (A-Z) and stripped of the punctuation and comment marks around them, so a header in a source file reads as its text. Defined results: null and empty texts, and texts shorter than
any template, match nothing and give no row. Repeated rows give repeated results. Very long texts are scanned whole. Columns of the input that
aren't carried along don't matter.
"""

from __future__ import annotations

import math
from bisect import bisect
from itertools import accumulate

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acctmart.llm.common import add_columns
from acctmart.llm.license_texts import FULL_TEXTS
from acctmart.llm.neardup import SHINGLE, mixed, word_hashes

#: Share of a template's shingles that a window must hold, and the chance to miss such a window.
CONTAINED, MISS = 0.8, 1e-6
#: Notices by license (fixed values): (license, name, text).
TEMPLATES = (
    ("Apache-2.0", "apache line", "Licensed under the Apache License, Version 2.0"),
    (
        "Apache-2.0",
        "apache header",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at"
        " http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software"
        ' distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND',
    ),
    ("MIT", "mit line", "Released under the MIT License"),
    ("MIT", "mit line of license", "Licensed under the MIT License"),
    (
        "MIT",
        "mit permission",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
        ' documentation files (the "Software"), to deal in the Software without restriction, including without limitation'
        " the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    ),
    (
        "BSD",
        "bsd redistribution",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the"
        " following conditions are met",
    ),
    ("GPL-3.0", "gpl line", "licensed under the GNU General Public License, version 3"),
    (
        "GPL",
        "gpl notice",
        "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the"
        " Free Software Foundation",
    ),
    ("CC-BY-NC-4.0", "cc by-nc line", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-4.0", "cc by line", "Licensed under CC BY 4.0"),
    (
        "CC-BY-4.0",
        "cc by notice",
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
    ),
    ("MPL-2.0", "mpl notice", "subject to the terms of the Mozilla Public License, v. 2.0"),
)
#: Notices of fewer than five words, in the same form.
SHORT_NOTICES = (
    ("all-rights-reserved", "all rights reserved", "All rights reserved"),
    *(
        (name, f"spdx {name.lower()}", f"SPDX-License-Identifier: {name}")
        for name in (
            "Apache-2.0", "MIT", "MIT-0", "BSD-2-Clause", "BSD-3-Clause", "0BSD", "ISC", "Zlib", "Unlicense", "BSL-1.0", "GPL-2.0-only",
            "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only",
            "LGPL-3.0-or-later", "AGPL-3.0-only", "AGPL-3.0-or-later", "MPL-2.0", "EPL-2.0", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0",
            "CC-BY-NC-4.0",
        )
    ),
)
#: Names of licenses, in the same form: notices only where the text around speaks of licensing, or alone in a line. A longer notice holds some of them too.
NAMES = (
    ("Apache-2.0", "apache name", "Apache License, Version 2.0"),
    ("Apache-2.0", "apache short name", "Apache License 2.0"),
    ("MIT", "mit name", "MIT License"),
    ("BSD", "bsd name", "BSD License"),
    ("GPL", "gpl name", "GNU General Public License"),
    ("MPL-2.0", "mpl name", "Mozilla Public License"),
    ("CC-BY-4.0", "cc by name", "CC BY 4.0"),
    ("CC-BY-SA-4.0", "cc by-sa name", "CC BY-SA 4.0"),
    ("CC-BY-NC-4.0", "cc by-nc name", "CC BY-NC 4.0"),
    ("ISC", "isc name", "ISC License"),
    ("Zlib", "zlib name", "zlib License"),
    ("BSL-1.0", "boost name", "Boost Software License"),
    ("EPL-2.0", "epl name", "Eclipse Public License 2.0"),
)
#: Words that speak of licensing, and how near a name one must stand.
CUES, NEAR = frozenset("license licensed licenses licence licenced copyright released distributed terms under spdx".encode().split()), 4
#: All that the query looks for but the names.
NOTICES = TEMPLATES + FULL_TEXTS + SHORT_NOTICES
#: Punctuation and the marks of comments; words of nothing else are left out.
_AROUND = b".,;:!?()[]\"'#*/-<>"
_SEEDS = mixed(np.arange(1, 513, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_FACTOR = np.uint64(0xD6E8FEB86659FD93)


def plain_words(text: str | None) -> list[bytes]:
    """A text's words, lower-cased and without the marks around them."""
    return [w for raw in (text or "").encode().lower().split() if (w := raw.strip(_AROUND))]


def word_values(text: str | None, memo) -> np.ndarray:
    """The 64-bit hashes of a text's words, in order."""
    found = plain_words(text)
    return np.fromiter(map(memo.__getitem__, found), np.uint64, len(found))


def shingles(h: np.ndarray, width: int = SHINGLE) -> np.ndarray:
    """The 64-bit hashes of the shingles of so many words, in order; none for fewer words."""
    if len(h) < width:
        return np.empty(0, np.uint64)
    total = np.zeros(len(h) - width + 1, np.uint64)
    for k in range(width):
        total = total * _FACTOR + h[k : len(h) - width + 1 + k]
    return mixed(total)


def bands(template_shingles: int, window_shingles: int, contained: float = CONTAINED, miss: float = MISS) -> int:
    """How many MinHash values make a window with that share of a template miss all with a chance below ``miss``."""
    held = math.ceil(contained * template_shingles)
    similarity = held / (window_shingles + template_shingles - held)
    return 1 if similarity >= 1 else math.ceil(math.log(miss) / math.log1p(-similarity))


def minhash(values: np.ndarray, n: int) -> np.ndarray:
    return mixed(values[None, :] ^ _SEEDS[:n, None]).min(axis=1)


def runs(at: np.ndarray, ranks: np.ndarray) -> list[np.ndarray]:
    """Places of a template's shingles, cut where their order in the template (-1 for none) doesn't rise."""
    ranked = np.flatnonzero(ranks >= 0)
    return np.split(at, ranked[1:][np.diff(ranks[ranked]) <= 0])


def rounds(at: np.ndarray, values: np.ndarray) -> list[np.ndarray]:
    """The same, cut where a shingle comes again."""
    cuts, seen = [], set()
    for k, value in enumerate(values.tolist()):
        if value in seen:
            cuts.append(k)
            seen.clear()
        seen.add(value)
    return np.split(at, cuts)


class Around:
    """What stands around the words of a text."""

    def __init__(self, text: str):
        lines = [plain_words(line) for line in text.split("\n")]
        self.words = [w for line in lines for w in line]
        self.starts = list(accumulate((len(line) for line in lines), initial=0))

    def licensing(self, at: int, width: int) -> bool:
        """Whether these words fill their line, or one near them speaks of licensing."""
        near = self.words[max(0, at - NEAR) : at] + self.words[at + width : at + width + NEAR]
        k = bisect(self.starts, at) - 1
        return self.starts[k] == at and self.starts[k + 1] == at + width or not CUES.isdisjoint(near)


class Scanner:
    def __init__(self, templates, contained: float = CONTAINED, miss: float = MISS, names=()):
        self.memo, self.contained, self.first_name = word_hashes(), contained, len(templates)
        self.templates, self.short, self.ranks = [], [], {}
        for number, (_, name, text) in enumerate([*templates, *names]):
            h = word_values(text, self.memo)
            if not len(h):
                raise ValueError(f"template {name!r} has no words")
            if number >= self.first_name and len(h) >= SHINGLE:
                raise ValueError(f"name {name!r} has more than {SHINGLE - 1} words")
            if len(h) < SHINGLE:
                self.short.append((number, len(h), shingles(h, len(h))[0]))
                continue
            values, first, times = np.unique(shingles(h), return_index=True, return_counts=True)
            self.ranks[number] = np.where(times == 1, first, -1)
            # the words of a template, and of a window: places of shingles are counted, not words
            step = len(values) + SHINGLE - 1
            window = 2 * step - SHINGLE + 1
            n = bands(len(values), window, contained, miss)
            if n > len(_SEEDS):
                raise ValueError(f"template {name!r} would need {n} bands")
            self.templates.append((number, values, step, window, minhash(values, n)))
        self.known = np.unique(np.concatenate([np.empty(0, np.uint64), *[t[1] for t in self.templates]]))
        self.widths = {width for _, width, _ in self.short}

    def _places(self, values: np.ndarray, number: int, template: np.ndarray, parts: list[np.ndarray]) -> list[tuple[float, int, int]]:
        """(containment, first word, last word) of each place, in order, from the shingles' places in the windows that match."""
        starts, taken = [], []  # what is taken, in order, without overlaps

        def share(at: np.ndarray) -> float:
            return len(np.unique(values[at])) / len(template)

        def take(at: np.ndarray) -> None:
            first, last = int(at[0]), int(at[-1]) + SHINGLE - 1
            k = bisect(starts, last)
            if not k or taken[k - 1][2] < first:
                starts.insert(k, first)
                taken.insert(k, (share(at), first, last))

        ranks = [self.ranks[number][np.searchsorted(template, values[at])] for at in parts]
        whole = [run for at, r in zip(parts, ranks) for run in runs(at, r) if share(run) >= self.contained]
        for run in sorted(whole, key=lambda run: (-share(run), run[0])):
            take(run)
        # places whose shingles stand in another order: from what lies between those taken
        for at in parts:
            before = np.searchsorted(starts, at, side="right")
            ends = np.array([-1, *[last for _, _, last in taken]])
            free = at > ends[before]
            for k in np.unique(before[free]).tolist():
                piece = at[free & (before == k)]
                if share(piece) >= self.contained:
                    again = [p for p in rounds(piece, values[piece]) if share(p) >= self.contained]
                    for p in again or [piece]:
                        take(p)
        return taken

    def scan(self, text: str | None) -> list[tuple[int, float, int, int]]:
        """(template, containment, first word, last word) of each place of a template, by template and place."""
        h = word_values(text, self.memo)
        values = shingles(h)
        marked = np.flatnonzero(np.isin(values, self.known))
        found = []
        for number, template, step, window, signature in self.templates if len(marked) else ():
            parts = []
            # windows start at multiples of a step; those with a marked shingle
            last = marked // step
            starts = np.unique(np.concatenate([last, last - 1])) * step
            for start in starts[starts >= 0].tolist():
                part = np.unique(values[start : start + window])
                if not len(part) or not (minhash(part, len(signature)) == signature).any():
                    continue
                if len(np.intersect1d(part, template, assume_unique=True)) / len(template) >= self.contained:
                    parts.append(start + np.flatnonzero(np.isin(values[start : start + window], template)))
            if parts:
                found += [(number, *place) for place in self._places(values, number, template, parts)]
        by_width = {width: shingles(h, width) for width in self.widths}
        around = None
        for number, width, value in self.short:
            end = 0
            for at in np.flatnonzero(by_width[width] == value).tolist():
                if number >= self.first_name:
                    around = around or Around(text)
                    if not around.licensing(at, width):
                        continue
                if at >= end:
                    end = at + width
                    found.append((number, 1.0, at, end - 1))
        return found


def license_scan(
    docs: DataFrame, text: str = "text", templates=TEMPLATES, keep: list[str] | None = None, names=()
) -> DataFrame:
    """A row for each row of ``docs`` and place of a template or, in a notice, of one of ``names`` in it: license, template, containment, first_word, last_word.

    Words are numbered from 0, those of nothing but punctuation or comment marks left out.
    """

    def make():
        scanner = Scanner(templates, names=names)
        return lambda texts: ([scanner.scan(t) for t in texts],)

    kind = "found array<struct<number:int,containment:double,first_word:int,last_word:int>>"
    called = [F.struct(F.lit(a).alias("license"), F.lit(b).alias("template")) for a, b, _ in [*templates, *names]]
    scanned = add_columns(docs, [text], kind, make, keep)
    carried: list[Column] = [F.col(f"`{c}`") for c in scanned.columns if c != "found"]
    return scanned.select(*carried, F.explode("found").alias("found")).select(
        *carried,
        F.array(*called)[F.col("found.number")]["license"].alias("license"),
        F.array(*called)[F.col("found.number")]["template"].alias("template"),
        "found.containment",
        "found.first_word",
        "found.last_word",
    )
