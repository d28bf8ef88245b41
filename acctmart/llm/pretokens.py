"""Splitting a text into pre-tokens, and remembering results per chunk of text between spaces."""

from __future__ import annotations

from collections.abc import Callable

#: The public split pattern of the byte-level vocabularies (a fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Entries that each of a memo's two generations holds, for words and for other pre-tokens, and the longest text remembered.
WORD_ENTRIES = 250_000
MEMO_ENTRIES = 40_000
MEMO_CHARS = 64
#: Marks that are one pre-token in a run after letters: the ASCII ones.
MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
#: Characters of texts that are cut into chunks at once, and rows that a task turns into Python values for that.
PART_CHARS = 2 << 20
PART_ROWS = 512


def splitter() -> Callable[[str], list[str]]:
    import regex

    return regex.compile(PATTERN).findall


class Memo(dict):
    """Results by key, computed when missing; long keys aren't kept, and the size is bounded.

    Results are kept in two generations: when the younger one is full it takes the place of the older one, whose
    results come back into the younger one as they are asked for.
    """

    def __init__(self, compute: Callable, entries: int = MEMO_ENTRIES, chars: int = MEMO_CHARS):
        super().__init__()
        self.compute, self.entries, self.chars = compute, entries, chars
        self.older: dict = {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.compute(key)
        if len(key) <= self.chars:
            if len(self) >= self.entries:
                self.older = dict(self)
                self.clear()
            self[key] = value
        return value


class Chunks(Memo):
    """Results for chunks of text that follow a space, of which plain words are remembered.

    ``by_token`` gives the results of single pre-tokens, and results add up. A run of marks after a word is a pre-token of
    its own, and so is a line break between two characters other than blanks.
    """

    def __init__(self, compute: Callable, by_token: Memo, entries: int = WORD_ENTRIES):
        super().__init__(compute, entries)
        self.by_token = by_token

    def __missing__(self, piece):
        if piece.isalpha():
            return super().__missing__(piece)
        word = piece.rstrip(MARKS)
        if word.isalpha():
            return self[word] + self.by_token[piece[len(word) :]]
        first, *lines = piece.split("\n")
        if lines and first and not first[0].isspace() and not first[-1].isspace() and all(map(self._plain, lines)):
            total, by_token = self[first], self.by_token
            for line in lines:
                word = line.rstrip(MARKS)
                total += by_token["\n"] + by_token[word]
                if len(word) < len(line):
                    total += by_token[line[len(word) :]]
            return total
        return self.compute(piece)

    @staticmethod
    def _plain(line: str) -> bool:
        return line.rstrip(MARKS).isalpha()


class NotAlone(Exception):
    """The chunk goes on with the blanks before it, so that its text is to be split as a whole."""


def chunked_texts(texts: list[str], of_chunk: Callable, of_text: Callable) -> tuple:
    """The texts cut before their spaces, each different chunk looked at once.

    A space opens a pre-token unless it stands in a longer run of blanks. Only a chunk that is empty or starts with a
    blank goes on with such a run: ``of_chunk`` raises ``NotAlone`` for it, and its text is left to ``of_text`` as
    a whole. Returns the results of different chunks, after which come those of each text's first chunk or of the whole text; for
    every chunk of the texts, in order, its place in these results; and where each text's chunks begin and end.
    """
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    pieces = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
    starts = pieces.offsets.to_numpy()
    coded = pieces.flatten().dictionary_encode()
    codes = coded.indices.to_numpy().astype("i8")
    inner = np.ones(len(codes), bool)
    inner[starts[:-1]] = False
    different = coded.dictionary.to_pylist()
    used = np.zeros(len(different), bool)
    used[codes[inner]] = True
    results, whole = [], np.zeros(len(different), bool)
    for k, (chunk, wanted) in enumerate(zip(different, used.tolist())):
        try:
            results.append(of_chunk(chunk) if wanted else None)
        except NotAlone:
            results.append(None)
            whole[k] = True
    spoilt = whole[codes] & inner
    doc = np.repeat(np.arange(len(texts)), np.diff(starts))
    whole_text = np.zeros(len(texts), bool)
    whole_text[doc[spoilt]] = True
    firsts = coded.indices.take(pa.array(starts[:-1])).to_pylist()
    results += [of_text(t if w else different[f]) for t, w, f in zip(texts, whole_text.tolist(), firsts)]
    codes[starts[:-1]] = len(different) + np.arange(len(texts))
    keep = ~whole_text[doc] | ~inner
    ends = np.concatenate([[0], np.cumsum(np.bincount(doc[keep], minlength=len(texts)))])
    return results, codes[keep], ends


def in_parts(texts: list[str], function: Callable[[list[str]], list]) -> list:
    """``function`` of the texts, of a bounded number of characters (one text at least) at a time."""
    out, low, size = [], 0, 0
    for k, text in enumerate(texts):
        size += len(text)
        if size >= PART_CHARS or k == len(texts) - 1:
            out += function(texts[low : k + 1])
            low, size = k + 1, 0
    return out


