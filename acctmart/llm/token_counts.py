"""Token counts with a whole-token shortcut (operator 9).

Before any text is read, the driver proves for every string of the vocabulary whether the merges turn
its bytes into that one token. A pre-token among the proven ones counts one at once; only the rest
goes through the merges. The vocabulary and the proof have a bounded size (that of the vocabulary file) and go
to the tasks as a broadcast; counting has no shuffle, and a task holds one slice of texts and bounded memos.

Defined results: a null or empty text has 0 bytes and 0 tokens; special strings of the vocabulary inside a text
count one token each, as the library does by default. Repeated rows are counted row by row; a column with
the name of an added one gives way.
"""

from __future__ import annotations

import heapq
import json

from pyspark.sql import DataFrame

from acctmart.llm.common import add_columns, digest, held
from acctmart.llm.pretokens import PART_ROWS, Chunks, Memo, NotAlone, chunked_texts, in_parts, splitter

#: Above any rank of a merge.
_NO_RANK = 1 << 60
#: Symbols up to which looking through all pairs is faster than a heap.
SHORT = 40


def byte_characters() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabulary files."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    others = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(others)}


def _merged_short(symbols: list[str], ranks: dict[tuple[str, str], int]) -> list[str]:
    """The same, looking through all pairs at each step."""
    symbols, rank = list(symbols), ranks.get
    found = [rank(pair, _NO_RANK) for pair in zip(symbols, symbols[1:])]
    while found and (best := min(found)) != _NO_RANK:
        at = found.index(best)
        symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
        del found[at]
        if at < len(found):
            found[at] = rank((symbols[at], symbols[at + 1]), _NO_RANK)
        if at:
            found[at - 1] = rank((symbols[at - 1], symbols[at]), _NO_RANK)
    return symbols


def merged(symbols: list[str], ranks: dict[tuple[str, str], int]) -> list[str]:
    """Apply the merges: always the pair of lowest rank, leftmost first, in n log n steps."""
    n = len(symbols)
    if n < 2:
        return symbols
    if n <= SHORT:
        return _merged_short(symbols, ranks)
    left, right = list(range(-1, n - 1)), list(range(1, n + 1))
    heap = [(r, i) for i in range(n - 1) if (r := ranks.get((symbols[i], symbols[i + 1]))) is not None]
    heapq.heapify(heap)
    symbols = list(symbols)
    while heap:
        rank, i = heapq.heappop(heap)
        j = right[i] if symbols[i] else n
        if j >= n or ranks.get((symbols[i], symbols[j])) != rank:
            continue
        symbols[i] += symbols[j]
        symbols[j] = ""
        right[i] = after = right[j]
        if after < n:
            left[after] = i
            if (r := ranks.get((symbols[i], symbols[after]))) is not None:
                heapq.heappush(heap, (r, i))
        before = left[i]
        if before >= 0 and (r := ranks.get((symbols[before], symbols[i]))) is not None:
            heapq.heappush(heap, (r, before))
    return [s for s in symbols if s]


def load_vocabulary(path: str) -> dict:
    """Merges, special strings, and the strings proven to be one token, from a byte-level BPE file."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model = spec["model"]
    if model["type"] != "BPE" or spec.get("normalizer") or spec["pre_tokenizer"]["type"] != "ByteLevel":
        raise ValueError("a byte-level BPE vocabulary without normaliser is wanted")
    pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
    ranks = {(a, b): k for k, (a, b) in enumerate(pairs)}
    back = {c: b for b, c in byte_characters().items()}
    whole = set()
    for string in model["vocab"]:
        if all(c in back for c in string) and merged(list(string), ranks) == [string]:
            whole.add(bytes(back[c] for c in string))
    special = [t["content"] for t in spec.get("added_tokens", []) if t.get("special")]
    return {"ranks": ranks, "whole": whole, "special": special}


class Counter:
    """Counts the tokens of texts by a loaded vocabulary."""

    def __init__(self, vocabulary: dict):
        self.ranks, self.special = vocabulary["ranks"], vocabulary["special"]
        self.whole = {w for raw in vocabulary["whole"] if (w := raw.decode("utf-8", "replace")).encode() == raw}
        self.letters = byte_characters()
        self.split = splitter()
        self.by_token = Memo(self._token)
        self.by_chunk = Chunks(self._chunk, self.by_token)

    def _token(self, token: str) -> int:
        if token in self.whole:
            return 1
        return len(merged([self.letters[b] for b in token.encode()], self.ranks))

    def _tokens(self, text: str) -> int:
        return sum(map(self.by_token.__getitem__, self.split(text)))

    def _chunk(self, piece: str) -> int:
        if piece.isalpha():  # one pre-token
            return self._token(" " + piece)
        if not piece or piece[0].isspace():
            raise NotAlone
        return self._tokens(" " + piece)

    def count(self, texts: list[str]) -> list[int]:
        return in_parts(texts, self._count)

    def _count(self, texts: list[str]) -> list[int]:
        import numpy as np

        for mark in self.special:
            if any(mark in t for t in texts):
                parts = [t.split(mark) for t in texts]
                counts = iter(self._count([p for some in parts for p in some]))
                return [len(some) - 1 + sum(next(counts) for _ in some) for some in parts]
        results, codes, ends = chunked_texts(texts, self.by_chunk.__getitem__, self._tokens)
        numbers = np.array([r or 0 for r in results], "i8")
        return np.add.reduceat(numbers[codes], ends[:-1]).tolist()


def token_counts(
    docs: DataFrame, path: str, text: str = "text", limit: int = 512, keep: list[str] | None = None
) -> DataFrame:
    """``docs`` with ``n_bytes``, ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens)."""
    vocabulary, key = docs.sparkSession.sparkContext.broadcast(load_vocabulary(path)), digest(path)

    def make():
        counter = held("counter", key, lambda: Counter(vocabulary.value))

        def run(texts):
            texts = [t or "" for t in texts]
            counts = counter.count(texts)
            return [len(t.encode()) for t in texts], counts, [n > limit for n in counts]

        return run

    return add_columns(docs, [text], "n_bytes long, n_tokens long, over_limit boolean", make, keep, PART_ROWS)
