"""Byte-level BPE encoding and decoding (operator 10).

Bytes are mapped to Latin-1 characters, so that an Aho-Corasick automaton over the vocabulary finds longest
matches. A sequence of tokens is what the merges give exactly if each two neighbours are: a merge across the
border of a pair would be made in the pair alone as well. So encoding takes the longest match, steps to the next
shorter prefix where a token doesn't go with the one before, and goes back where none is left; places
found to lead nowhere aren't tried again, which keeps the work linear. Whether two tokens go together is found by
merging the two alone, once, and remembered. Tokens that the merges don't make of their own bytes are left
out of the automaton; a whole pre-token in the vocabulary is its token in any case, as in the library.

The ranks have a bounded size (that of the vocabulary file) and go to the tasks as a broadcast. There is no
shuffle; a task holds one slice of texts and bounded memos.

Defined results: a null or empty text has no ids and decodes to no bytes. Repeated rows are encoded row by row.
A column with the name of an added one gives way.
"""

from __future__ import annotations

import base64
import struct

from pyspark.sql import DataFrame

from acctmart.llm.common import add_columns, digest, held
from acctmart.llm.pretokens import PART_ROWS, Chunks, Memo, NotAlone, chunked_texts, in_parts, splitter

#: Pairs of tokens that each generation of a task's memo of pairs holds.
PAIR_ENTRIES = 100_000


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


#: Above any rank.
_NO_RANK = 1 << 60


def merged(piece: str, ranks: dict[str, int]) -> list[str]:
    """The tokens that merging by lowest rank, leftmost first, gives for a short piece."""
    parts, rank = list(piece), ranks.get
    found = [rank(a + b, _NO_RANK) for a, b in zip(parts, parts[1:])]
    while found and (best := min(found)) != _NO_RANK:
        at = found.index(best)
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
        del found[at]
        if at < len(found):
            found[at] = rank(parts[at] + parts[at + 1], _NO_RANK)
        if at:
            found[at - 1] = rank(parts[at - 1] + parts[at], _NO_RANK)
    return parts


class Codec:
    """Encodes texts to ids, packed as little-endian unsigned 32-bit integers, and back to bytes."""

    def __init__(self, ranks: dict[bytes, int]):
        import ahocorasick

        self.ranks = {token.decode("latin-1"): rank for token, rank in ranks.items()}
        self.tokens = {rank: token for token, rank in ranks.items()}
        own = [t for t in self.ranks if merged(t, self.ranks) == [t]]
        self.automaton = ahocorasick.Automaton()
        for token in own:
            self.automaton.add_word(token, token)
        self.automaton.make_automaton()
        made = set(own)
        self.shorter = {
            t: next((t[:k] for k in range(len(t) - 1, 0, -1) if t[:k] in made), None) for t in own
        }
        self.by_id = None
        self.packed = {t: struct.pack("<I", rank) for t, rank in self.ranks.items()}
        self.pairs = Memo(self._together, PAIR_ENTRIES, 2)
        self.split = splitter()
        self.by_token = Memo(self._token)
        self.by_chunk = Chunks(self._chunk, self.by_token)

    def _together(self, pair: tuple[str, str]) -> bool:
        return merged(pair[0] + pair[1], self.ranks) == [*pair]

    def pieces(self, s: str) -> list[str]:
        """The tokens of one pre-token, its bytes written as Latin-1."""
        if s in self.ranks:
            return [s]
        greedy = [token for _, token in self.automaton.iter_long(s)]
        pairs = self.pairs
        for k, pair in enumerate(zip(greedy, greedy[1:])):
            if not pairs[pair]:
                return self._search(s, greedy[: k + 1], self.shorter[greedy[k + 1]])
        return greedy

    def _search(self, s: str, done: list[str], token: str | None) -> list[str]:
        """Continue after ``done``, whose neighbours go together, by trying ``token`` next."""
        at, end, dead = sum(map(len, done)), len(s), set()
        pairs, shorter, longest = self.pairs, self.shorter, self.automaton.iter_long
        while True:
            before = done[-1] if done else None
            while token is not None:
                after = at + len(token)
                if after not in dead and (before is None or pairs[before, token]):
                    break
                token = shorter[token]
            if token is None:
                dead.add(at)
                token = done.pop()
                at -= len(token)
                continue
            done.append(token)
            at = after
            if at == end:
                return done
            token = next(longest(s, at))[1]

    def _token(self, token: str) -> bytes:
        spelled = token if token.isascii() else token.encode().decode("latin-1")
        return b"".join(map(self.packed.__getitem__, self.pieces(spelled)))

    def _tokens(self, text: str) -> bytes:
        return b"".join(map(self.by_token.__getitem__, self.split(text)))

    def _chunk(self, piece: str) -> bytes:
        if piece.isalpha():  # one pre-token
            return self._token(" " + piece)
        if not piece or piece[0].isspace():
            raise NotAlone
        return self._tokens(" " + piece)

    def encode(self, texts: list[str]) -> list[bytes]:
        return in_parts(texts, self._encode)

    def _encode(self, texts: list[str]) -> list[bytes]:
        import pyarrow as pa

        results, codes, ends = chunked_texts(texts, self.by_chunk.__getitem__, self._tokens)
        return _joined(pa.array(results, pa.large_binary()), codes, ends)

    def decode(self, packed: list[bytes]) -> list[bytes]:
        """The bytes of each sequence of packed ids."""
        import numpy as np
        import pyarrow as pa

        if not any(packed):
            return [b""] * len(packed)
        ids = np.frombuffer(b"".join(packed), "<u4")
        if self.by_id is None:
            self.by_id = pa.array([self.tokens.get(k) for k in range(max(self.tokens) + 1)], pa.large_binary())
        if ids.max() >= len(self.by_id):
            raise ValueError("an id is not in the vocabulary")
        return _joined(self.by_id, ids, np.cumsum([0, *(len(p) // 4 for p in packed)]))


def _joined(values, places, ends) -> list[bytes]:
    """Values taken at the places and joined, between each two of the ends."""
    import numpy as np
    import pyarrow as pa

    taken = values.take(pa.array(places))
    _, offsets, data = taken.buffers()
    cuts = np.frombuffer(offsets, "<i8")[ends].tolist()
    data = memoryview(data) if data is not None else b""
    return [bytes(data[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]


def encode(
    docs: DataFrame, path: str, text: str = "text", decoded: bool = False, keep: list[str] | None = None
) -> DataFrame:
    """``docs`` with ``ids``, and with ``decoded`` also the bytes that these ids stand for."""
    shared, key = docs.sparkSession.sparkContext.broadcast(load_ranks(path)), digest(path)

    def make():
        codec = held("codec", key, lambda: Codec(shared.value))

        def run(texts):
            ids = codec.encode([t or "" for t in texts])
            return (ids, codec.decode(ids)) if decoded else (ids,)

        return run

    added = "ids binary, decoded binary" if decoded else "ids binary"
    return add_columns(docs, [text], added, make, keep, PART_ROWS)


def decode(rows: DataFrame, path: str, ids: str = "ids", keep: list[str] | None = None) -> DataFrame:
    """``rows`` with ``decoded``, the bytes that packed ids stand for; null ids decode to no bytes."""
    shared, key = rows.sparkSession.sparkContext.broadcast(load_ranks(path)), digest(path)

    def make():
        codec = held("codec", key, lambda: Codec(shared.value))
        return lambda packed: (codec.decode([x or b"" for x in packed]),)

    return add_columns(rows, [ids], "decoded binary", make, keep, PART_ROWS)
