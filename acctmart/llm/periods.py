"""Runs of repeated words, found by longest common extensions on a difference cover (operator 13).

A run is a stretch of words with smallest period q, at least ``LEAST_PERIODS`` periods and ``LEAST_LENGTH`` words long, that neither neighbour extends.

Positions i and j of a text have the shift d < 31 at which i+d and j+d are both in the cover, the positions whose remainder by
31 is in a perfect difference set of six. Only the suffixes at cover positions are sorted: by three words at a
time while they tie, and from 31 words on by the ranks of the suffixes 31, 62, 124, ... words later, which are cover positions too. A sparse
table over the common lengths of neighbours then gives the common extension of any two positions: compare at
most d words, then look up the minimum between two ranks. The same over the reversed words extends to the left.

Runs are enumerated on a harmonic grid: a run of period p holds at least 3p positions whose word returns p
words later, so one of them is a multiple of 3p. Each multiple whose word returns is extended both ways; the sum of n/3p over all p is
n log n / 3. Stretches found under several periods keep the least one, which is their smallest period.

Texts of a slice are laid side by side, with a mark of its own after each, so that numpy works on long arrays; the
texts of a period too long for them are left out of its grid. There is no shuffle; a task holds one slice of about ``SLICE_WORDS``
words, or one longer text.

Defined results: a null or empty text has no words and no runs, and collapses to an empty text. Repeated rows are treated row by row. A column
with the name of an added one gives way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from acctmart.llm.common import add_columns

#: Periods and words that a run holds at least. The grid rests on four periods.
LEAST_PERIODS, LEAST_LENGTH = 4, 6
#: Words of texts that are indexed together.
SLICE_WORDS = 250_000
#: Grid points that are tried at once.
GRID_POINTS = 1_000_000
#: A perfect difference set: every remainder by MODULUS is a difference of two members once (fixed values).
MODULUS = 31
COVER = (1, 5, 11, 24, 25, 27)
ADDED = "n_words long, runs array<struct<start:long,length:long,period:long>>, best struct<start:long,length:long,period:long>, collapsed string"


class Extensions:
    """Longest common extensions to the right of any two positions of an array of word numbers."""

    def __init__(self, words):
        import numpy as np

        n = len(words)
        self.n = n
        # beyond the end stands a word of its own
        self.words = np.concatenate([words, np.full(MODULUS + 3, -1, words.dtype)])
        member = np.zeros(MODULUS, bool)
        member[list(COVER)] = True
        # the shift that brings two remainders into the cover
        self.shift = np.zeros((MODULUS, MODULUS), "i8")
        for a in range(MODULUS):
            for b in range(MODULUS):
                self.shift[a, b] = next(d for d in range(MODULUS) if member[(a + d) % MODULUS] and member[(b + d) % MODULUS])
        cover = np.flatnonzero(member[np.arange(n + 1) % MODULUS])
        self._sort(cover, n)
        self._table(self.common)

    def _sort(self, cover, n: int):
        """Ranks of the cover's suffixes, and the common length of each with the one before it."""
        import numpy as np

        words, m = self.words, len(cover)
        order = np.arange(m)
        group = np.zeros(m, "i8")  # by sorted place: first place of the group of equal prefixes
        common = np.full(m, 1 << 62)  # until the two are told apart
        rank = np.full(n + 1, -1, "i8")  # by position
        bits = int(max(words.max(), 0) + 2).bit_length()
        width = min(3, 62 // bits)

        def refine(tied, key, found):
            """Sort tied places by their group and key; ``found(places)`` gives common lengths at new borders."""
            by = np.lexsort((key, group[tied]))
            order[tied] = order[tied][by]
            key = key[by]
            border = np.concatenate([[False], (key[1:] != key[:-1]) & (group[tied][1:] == group[tied][:-1])])
            places = tied[border]
            common[places] = found(places)
            head = np.concatenate([[True], group[tied][1:] != group[tied][:-1]]) | border
            group[tied] = tied[np.maximum.accumulate(np.where(head, np.arange(len(tied)), 0))]

        def ties():
            same = np.concatenate([group[1:] == group[:-1], [False]])
            return np.flatnonzero(same | np.concatenate([[False], same[:-1]]))

        end = len(words) - 1

        def by_words(offset, count):
            def found(places):
                a, b = cover[order[places]] + offset, cover[order[places - 1]] + offset
                out = np.full(len(places), offset)
                same = np.ones(len(places), bool)
                for k in range(count):
                    same &= words[np.minimum(a + k, end)] == words[np.minimum(b + k, end)]
                    out += same
                return out

            return found

        offset, tied = 0, np.arange(m) if m > 1 else np.arange(0)
        while len(tied) and offset < MODULUS:
            count = min(width, MODULUS - offset)
            at, key = cover[order[tied]] + offset, np.zeros(len(tied), "i8")
            for k in range(count):
                key = (key << bits) | (words[np.minimum(at + k, end)].astype("i8") + 1)
            refine(tied, key, by_words(offset, count))
            offset += count
            tied = ties()
        step = MODULUS
        while len(tied):
            rank[cover[order]] = group
            at = np.minimum(cover + step, n)
            self._table(common)  # settled between different groups, which is all that is looked up

            def found(places, at=at, step=step):
                a, b = rank[at[order[places]]], rank[at[order[places - 1]]]
                return step + self._least(np.minimum(a, b), np.maximum(a, b))

            refine(tied, rank[at[order[tied]]], found)
            step *= 2
            tied = ties()
        rank[cover[order]] = np.arange(m)
        self.rank, self.common = rank, common

    def _table(self, common):
        """Minima over spans of 1, 2, 4, ... neighbours."""
        import numpy as np

        self.levels = [common]
        while (half := 1 << (len(self.levels) - 1)) * 2 <= len(common):
            below = self.levels[-1]
            self.levels.append(np.minimum(below[:-half], below[half:]))

    def _least(self, low, high):
        """Minimum of the common lengths after ``low`` up to ``high``; 0 before the first rank."""
        import numpy as np

        out = np.zeros(len(low), "i8")
        span = high - low
        level = np.frexp(span.astype("f8"))[1] - 1
        for k in np.unique(level).tolist():
            if k >= 0:
                of = np.flatnonzero((level == k) & (low >= 0))
                minima = self.levels[k]
                out[of] = np.minimum(minima[low[of] + 1], minima[high[of] + 1 - (1 << k)])
        return out

    def __call__(self, i, j):
        """Words that the suffixes at the different positions ``i`` and ``j`` begin with alike."""
        import numpy as np

        shift = self.shift[i % MODULUS, j % MODULUS]
        out = np.zeros(len(i), "i8")
        going = np.arange(len(i))
        for d in range(MODULUS):
            at = shift[going] == d
            if at.any():
                sure = going[at]
                a, b = self.rank[i[sure] + d], self.rank[j[sure] + d]
                out[sure] = d + self._least(np.minimum(a, b), np.maximum(a, b))
                going = going[~at]
            if not len(going):
                break
            same = self.words[i[going] + d] == self.words[j[going] + d]
            out[going] = d + same
            going = going[same]
        return out


def _grid(ends):
    """(positions, periods) of the grid in bounded parts; ``ends[p]`` is the end of the texts that can hold period p."""
    import numpy as np

    step = 3 * np.arange(1, len(ends), dtype="i8")
    points = -(-np.asarray(ends[1:], "i8") // step)
    total, low = np.cumsum(points), 0
    while low < len(points):
        before = total[low - 1] if low else 0
        high = max(int(np.searchsorted(total, before + GRID_POINTS, "right")), low + 1)
        count = points[low:high]
        period = np.repeat(np.arange(low + 1, high + 1), count)
        yield (np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)) * 3 * period, period
        low = high


def find_runs(texts: list[list]) -> list[list[tuple[int, int, int]]]:
    """For each list of words its runs as (start, length, period), in order."""
    import numpy as np

    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    by_size = sorted((k for k, t in enumerate(texts) if len(t) >= LEAST_LENGTH), key=lambda k: -len(texts[k]))
    if not by_size:
        return found
    numbers: dict = {}
    parts, starts = [], []
    size = 0
    for k in by_size:
        text = texts[k]
        for word in text:
            if word not in numbers:
                numbers[word] = len(numbers)
        parts.append(np.fromiter(map(numbers.__getitem__, text), "i8", len(text)))
        starts.append(size)
        size += len(text) + 1
    words = np.empty(size, "i8")
    for i, (start, part) in enumerate(zip(starts, parts)):
        words[start : start + len(part)] = part
        words[start + len(part)] = len(numbers) + i  # a mark of its own
    lengths = np.array([len(p) for p in parts])
    # the texts with at least four periods come first, as texts are laid out by falling length
    most = int(lengths[0]) // LEAST_PERIODS
    fitting = np.searchsorted(-lengths, -LEAST_PERIODS * np.arange(most + 1), "right")
    ends = [0] + [starts[f - 1] + int(lengths[f - 1]) for f in fitting[1:]]
    at, period = [], []
    for x, p in _grid(ends):
        back = x + p
        hit = np.flatnonzero(back < size)
        hit = hit[words[x[hit]] == words[back[hit]]]
        at.append(x[hit])
        period.append(p[hit])
    at, period = np.concatenate(at), np.concatenate(period)
    if not len(at):
        return found
    right = Extensions(words)(at, at + period)
    # positions of the reversed words, one step to the left
    left = np.zeros(len(at), "i8")
    inner = np.flatnonzero(at > 0)
    back = size - at[inner]
    left[inner] = Extensions(words[::-1])(back, back - period[inner])
    length = left + right + period
    wanted = np.flatnonzero(length >= np.maximum(LEAST_LENGTH, LEAST_PERIODS * period))
    start, length, period = (at - left)[wanted], length[wanted], period[wanted]
    order = np.lexsort((period, length, start))
    before = None
    for s, n, p in zip(start[order].tolist(), length[order].tolist(), period[order].tolist()):
        if (s, n) == before:
            continue
        before = s, n
        text = int(np.searchsorted(starts, s, "right")) - 1
        found[by_size[text]].append((s - starts[text], n, p))
    for runs in found:
        runs.sort(key=lambda r: (r[0], r[2]))
    return found


def best_run(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the greatest exact length by period; of equal ones the first, then the one of the least period."""
    best = None
    for run in runs:  # in the order of start, then period
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that a run holds after its first period."""
    if not runs:
        return words
    kept, at = [], 0
    for low, high in sorted((s + p, s + n) for s, n, p in runs):
        if high > at:
            kept += words[at : max(low, at)]
            at = high
    return kept + words[at:]


def _rows(texts: list[str | None]):
    split = [(t or "").encode().split() for t in texts]  # at space and the five ASCII control blanks
    rows, low, size = [], 0, 0
    for k, words in enumerate(split):
        size += len(words)
        if size >= SLICE_WORDS or k == len(split) - 1:
            rows += find_runs(split[low : k + 1])
            low, size = k + 1, 0
    as_dict = lambda r: r and dict(zip(("start", "length", "period"), r))
    return (
        list(map(len, split)),
        [[as_dict(r) for r in runs] for runs in rows],
        [as_dict(best_run(runs)) for runs in rows],
        [b" ".join(collapse(words, runs)).decode() for words, runs in zip(split, rows)],
    )


def periodic_runs(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``n_words``, ``runs`` (by start, then period), ``best`` (of them) and ``collapsed``.

    ``collapsed`` is the text's words, joined by one space, without those that a run holds after its first period.
    """
    return add_columns(docs, [text], ADDED, lambda: _rows, keep)
