"""Alignment of two tokenizers over a corpus, with pair counts from sorted external runs (operator 12).

Both token sequences of a text cover the same bytes. Where both end a token, a group ends; tokens whose byte ranges overlap
are linked. The count of a pair of ids is the number of documents that hold it linked.

How it runs: documents are read in chunks (``runs``). A chunk's distinct pairs are radix-partitioned by the last bits of
their A id into buckets and sorted by A id, then B id; each bucket of a chunk is a zstd run of pairs with their number of
documents, beside one of the documents and how often they hold the pair. Runs of a bucket are merged by a heap over their A ids,
``FAN_IN`` at a time, in as many rounds as that needs; the last round knows all counts of an A id at once and so its highest.
A pair or an A id that is in every document is one entry, or one short list of partners, per run, so no key grows with the
corpus. A bucket's counts then stream past the bucket's runs, which give each document's part of the sums back to its
chunk, where the parts of all buckets are added. A bucket's chunks go in groups of ``GROUP_CHUNKS``, each with a copy of the bucket's
counts, so that no task holds more than one bucket's counts and one run. The number of different pairs is bounded by the two
vocabularies, and both vocabulary files go to the tasks as broadcasts of their size.

Defined results: a null or empty text, and one whose tokens of either side don't join to its bytes, has no tokens, zeros and empty groups.
Special strings inside texts are plain text. Repeated rows count as documents of their own. Empty tables give no rows. A column with the name of
an added one gives way.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acctmart.llm.common import cut, digest, held
from acctmart.llm.pretokens import PATTERN
from acctmart.llm.runs import CHUNK_BYTES, ascending, chunked, gaps, pack, streamed, unpack
from acctmart.llm.token_counts import byte_characters

#: Bits of the A id that name its bucket.
BUCKET_BITS = 6
#: Runs that meet in one merge, and chunks whose runs meet one copy of a bucket's counts.
FAN_IN = 64
GROUP_CHUNKS = 1024
#: Characters of texts that are aligned at once; their links wait for the rest of the chunk.
PART_CHARS = 1 << 20
ADDED = ("n_a", "n_b", "n_groups", "n_links", "groups", "n_best", "count_sum")


def load_byte_bpe(path: str) -> dict[bytes, int]:
    """Bytes of every token of a byte-level BPE file, with its id, by which merges are ranked."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model = spec["model"]
    if model["type"] != "BPE" or spec.get("normalizer") or spec["pre_tokenizer"]["type"] != "ByteLevel":
        raise ValueError("a byte-level BPE vocabulary without normaliser is wanted")
    back, vocab = {c: b for b, c in byte_characters().items()}, model["vocab"]
    special = {t["content"] for t in spec.get("added_tokens", [])}
    ranks = {bytes(back[c] for c in t): k for t, k in vocab.items() if t not in special}
    merged = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
    if merged != sorted(merged):
        raise ValueError("the ids of the vocabulary are not in the order of its merges")
    return ranks


class Aligner:
    """Tokens of a chunk of texts on both sides, with what links them."""

    def __init__(self, ranks: dict[bytes, int], model: bytes):
        import numpy as np
        import sentencepiece
        import tiktoken

        self.a = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.a_bytes = {k: t for t, k in ranks.items()}
        pieces = [self.b.id_to_piece(k) for k in range(self.b.get_piece_size())]
        single = re.compile("<0x([0-9A-F]{2})>")
        self.b_bytes = [
            bytes([int(m[1], 16)]) if (m := single.fullmatch(p)) else p.replace("▁", " ").encode() for p in pieces
        ]
        n_a = max(ranks.values()) + 1
        self.a_length = np.array([len(self.a_bytes.get(k, b"")) for k in range(n_a)])
        self.b_length = np.array(list(map(len, self.b_bytes)))
        # an id as text, followed by what stands between ids of its group and by what ends its side of the group
        self.a_text, self.b_text = (
            np.array([f"{k}{e}" for k in range(size) for e in ends], object)
            for size, ends in ((n_a, ",|"), (len(pieces), ",;"))
        )

    def tokens(self, texts: list[str | None]) -> tuple[list, list]:
        """Ids of both sides; none where either side doesn't join to a space and the text."""
        import numpy as np

        some = iter(self.b.encode([t for t in texts if t], num_threads=1))
        none = np.array([], "i4")
        sides: tuple[list, list] = [], []
        for text in texts:
            a = b = none
            if text:
                whole, ids = (" " + text).encode(), next(some)
                if b"".join(map(self.b_bytes.__getitem__, ids)) == whole:
                    found = self.a.encode_ordinary(" " + text)
                    if self.a.decode_bytes(found) == whole:
                        a, b = np.array(found, "i4"), np.array(ids, "i4")
            sides[0].append(a)
            sides[1].append(b)
        return sides

    def align(self, texts: list[str | None], bits: int) -> tuple[list[list], list[tuple]]:
        """Columns of the texts' rows, and a pair of runs per bucket."""
        import numpy as np

        columns: list[list] = [[] for _ in range(5)]
        records, low, size = [], 0, 0
        for k, text in enumerate(texts):
            size += len(text or "")
            if size >= PART_CHARS or k == len(texts) - 1:
                more, pair, doc = self._part(texts[low : k + 1], bits)
                for column, values in zip(columns, more):
                    column += values
                records.append(pair * len(texts) + (doc + low))
                low, size = k + 1, 0
        return columns, list(self._runs(np.concatenate(records), len(texts), bits))

    def _part(self, texts: list[str | None], bits: int):
        """Columns of some texts' rows, and their links: number of the pair, number of the text."""
        import numpy as np

        sides = self.tokens(texts)
        n, (n_a, n_b) = len(texts), ([len(x) for x in side] for side in sides)
        a, b = map(np.concatenate, sides)
        # both sides of a text have the same bytes, so ends may run on from text to text
        a_end, b_end = np.cumsum(self.a_length[a]), np.cumsum(self.b_length[b])
        last = np.searchsorted(b_end, a_end)  # the B token that holds the last byte of each A token
        first = np.searchsorted(b_end, a_end - self.a_length[a], "right")
        a_cut = b_end[last] == a_end if len(b) else np.zeros(0, bool)
        b_cut = np.zeros(len(b), bool)
        b_cut[last[a_cut]] = True
        times = last - first + 1
        doc_a = np.repeat(np.arange(n), n_a)
        groups = np.bincount(doc_a[a_cut], minlength=n)
        links = np.bincount(doc_a, times, n).astype("i8")
        columns = [n_a, n_b, groups.tolist(), links.tolist(), self._texts(a, b, a_cut, b_cut, n_a, n_b)]
        to_b = np.arange(times.sum()) + np.repeat(first - (np.cumsum(times) - times), times)
        # bucket, rest of the A id, B id: ascending numbers are in bucket order, then A-major
        a = a.astype("i8")
        side = (a & ((1 << bits) - 1)) * self._high(bits) + (a >> bits)
        return columns, np.repeat(side * len(self.b_length), times) + b[to_b], np.repeat(doc_a, times)

    def _high(self, bits: int) -> int:
        return (len(self.a_length) >> bits) + 1

    def _texts(self, a, b, a_cut, b_cut, n_a, n_b) -> list[str]:
        import numpy as np

        # a group's A ids, then its B ids, each at its place in the text of all
        a_group, b_group = np.cumsum(a_cut) - a_cut, np.cumsum(b_cut) - b_cut
        a_before, b_before = (np.concatenate([[0], np.flatnonzero(x) + 1]) for x in (a_cut, b_cut))
        out = np.empty(len(a) + len(b), object)
        out[np.arange(len(a)) + b_before[a_group]] = self.a_text[2 * a + a_cut]
        out[np.arange(len(b)) + a_before[b_group + 1]] = self.b_text[2 * b + b_cut]
        out, at, texts = out.tolist(), 0, []
        for size in map(sum, zip(n_a, n_b)):
            texts.append("".join(out[at : at + size])[:-1])
            at += size
        return texts

    def _runs(self, records, n: int, bits: int):
        import numpy as np

        if not len(records):
            return
        record, times = np.unique(records, return_counts=True)
        pair, doc = record // n, record % n
        first = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]]))
        docs = np.diff(np.append(first, len(pair)))
        pair = pair[first]
        bucket = pair // (self._high(bits) * len(self.b_length))
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(pair)]]).tolist()
        first = np.append(first, len(doc))
        for s, e in zip(cuts[:-1], cuts[1:]):
            x, y = first[s], first[e]
            yield int(bucket[s]), pack(gaps(pair[s:e]), docs[s:e]), pack(doc[x:y], times[x:y])


def _by_side(pairs, n_b: int):
    """A sorted run's A sides, and where each begins and ends."""
    import numpy as np

    side = pairs // np.uint64(n_b)
    first = np.flatnonzero(np.concatenate([[True], side[1:] != side[:-1]]))
    return side[first].tolist(), first.tolist() + [len(pairs)]


def merge_runs(runs: list[bytes], n_b: int, last: bool) -> bytes:
    """One sorted run of the pairs of several with their counts added; the last one marks an A id's highest counts."""
    import numpy as np

    open_runs, heap = [], []
    for k, run in enumerate(runs):
        differences, counts = unpack(run)[:2]
        pairs = ascending(differences)
        sides, cuts = _by_side(pairs, n_b)
        open_runs.append((pairs, counts, sides, cuts))
        heap.append((sides[0], k, 0))
    heapq.heapify(heap)
    out_pairs, out_counts, out_best = [], [], []
    while heap:
        side, some_pairs, some_counts = heap[0][0], [], []
        while heap and heap[0][0] == side:
            _, k, at = heap[0]
            pairs, counts, sides, cuts = open_runs[k]
            some_pairs.append(pairs[cuts[at] : cuts[at + 1]])
            some_counts.append(counts[cuts[at] : cuts[at + 1]])
            if at + 1 < len(sides):
                heapq.heapreplace(heap, (sides[at + 1], k, at + 1))
            else:
                heapq.heappop(heap)
        if len(some_pairs) == 1:
            found, totals = some_pairs[0], some_counts[0].astype("i8")
        else:
            found, number = np.unique(np.concatenate(some_pairs), return_inverse=True)
            totals = np.zeros(len(found), "i8")
            np.add.at(totals, number, np.concatenate(some_counts).astype("i8"))
        out_pairs.append(found)
        out_counts.append(totals)
        if last:
            out_best.append(totals == totals.max())
    done = [gaps(np.concatenate(out_pairs)), np.concatenate(out_counts)]
    return pack(*done, np.concatenate(out_best).view("u1")) if last else pack(*done)


def _merged(rows, n_b: int, last: bool):
    """One run per (bucket, group) of rows that come in that order."""
    now, runs = None, []
    for bucket, group, run in rows:
        if (bucket, group) != now and runs:
            yield *now, merge_runs(runs, n_b, last)
            runs = []
        now = bucket, group
        runs.append(run)
    if runs:
        yield *now, merge_runs(runs, n_b, last)


def pair_counts(runs: DataFrame, n_b: int) -> DataFrame:
    """(bucket, group, pairs): one run per bucket with the counts of its pairs and marks of the highest per A id."""
    ddl, now = "bucket int, group long, pairs binary", runs.select("bucket", F.col("chunk").alias("group"), "pairs")
    most = runs.groupBy("bucket").count().agg(F.max("count")).first()[0] or 0
    while True:
        groups = -(-most // FAN_IN) if most > FAN_IN else 1
        last = groups == 1
        dealt = now.withColumn("group", F.pmod(F.xxhash64("group"), F.lit(groups)))
        now = streamed(dealt, lambda rows, last=last: _merged(rows, n_b, last), ddl, ["bucket", "group"])
        if last:
            return now
        most = groups


def _contributions(rows):
    """Each document's part of its sums, from a bucket's counts followed by the bucket's runs of chunks."""
    import numpy as np

    for _, _, chunk, pairs, docs in rows:
        if chunk is None:
            differences, counts, best = unpack(pairs)
            known, counts = ascending(differences), counts.astype("i8")
            continue
        differences, sizes = unpack(pairs)
        doc, times = (x.astype("i8") for x in unpack(docs))
        at = np.repeat(np.searchsorted(known, ascending(differences)), sizes)
        some, number = np.unique(doc, return_inverse=True)
        sums, bests = np.zeros(len(some), "i8"), np.zeros(len(some), "i8")
        np.add.at(sums, number, times * counts[at])
        np.add.at(bests, number, times * best[at])
        yield chunk, pack(some, bests, sums)


def _added(rows):
    """Documents' sums over the parts that all buckets gave to their chunk."""
    import numpy as np

    def settle(chunk, parts):
        doc, bests, sums = (np.concatenate(x).astype("i8") for x in zip(*map(unpack, parts)))
        some, number = np.unique(doc, return_inverse=True)
        totals = np.zeros((2, len(some)), "i8")
        np.add.at(totals[0], number, bests)
        np.add.at(totals[1], number, sums)
        yield from zip([chunk] * len(some), some.tolist(), *totals.tolist())

    now, parts = None, []
    for chunk, part in rows:
        if chunk != now and parts:
            yield from settle(now, parts)
            parts = []
        now = chunk
        parts.append(part)
    if parts:
        yield from settle(now, parts)


def align(
    docs: DataFrame,
    a_path: str,
    b_path: str,
    text: str = "text",
    keep: list[str] | None = None,
    shape: Callable[[DataFrame], DataFrame] | None = None,
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """``docs`` with tokens, groups and links of two tokenizers, and sums over the links' corpus counts.

    ``groups`` reads ``a1,a2|b1;a3|b2,b3``: ids of A and B in order. It is several times as long as the text;
    ``shape`` may put something else in its place before the rows are written, given rows with ``groups``.
    """
    keep = [c for c in docs.columns if c not in ADDED] if keep is None else keep
    with open(b_path, "rb") as f:
        files = docs.sparkSession.sparkContext.broadcast((load_byte_bpe(a_path), f.read()))

    key = digest(a_path, b_path)

    def make():
        aligner = held("aligner", key, lambda: Aligner(*files.value))
        return lambda values: aligner.align(values[0], BUCKET_BITS)

    import sentencepiece

    n_b = sentencepiece.SentencePieceProcessor(model_file=b_path).get_piece_size()
    numbers = ["n_a", "n_b", "n_groups", "n_links"]
    per_doc = ", ".join(f"{c} long" for c in numbers) + ", groups string"
    per_run = "bucket int, pairs binary, docs binary"
    made = chunked(docs, [F.col(f"`{text}`")], keep, per_doc, per_run, make, chunk_bytes)
    read = cut(made if shape is None else shape(made))
    runs = read.where("place is null").select("bucket", "chunk", "pairs", "docs")
    counts = pair_counts(runs, n_b)
    chunks = runs.agg(F.count_distinct("chunk")).first()[0]
    groups = max(1, -(-chunks // GROUP_CHUNKS))
    dealt = runs.withColumn("group", F.pmod(F.xxhash64("chunk"), F.lit(groups)))
    copies = counts.select(
        "bucket", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))).alias("group"),
        F.lit(None).cast("long").alias("chunk"), "pairs", F.lit(None).cast("binary").alias("docs"),
    )
    columns = ["bucket", "group", "chunk", "pairs", "docs"]
    both = copies.union(dealt.select(*columns))  # ascending order puts the counts, without a chunk, first
    parts = streamed(both, _contributions, "chunk long, part binary", ["bucket", "group"], ["chunk"])
    sums = streamed(parts, _added, "chunk long, place int, n_best long, count_sum long", ["chunk"])
    rest = [c for c in read.columns if c not in {"chunk", "place", "bucket", "pairs", "docs"}]
    rows = read.where("place is not null").select("chunk", "place", *rest)
    joined = rows.join(sums, ["chunk", "place"], "left")
    named = [F.col(f"_{k}").alias(c) for k, c in enumerate(keep)]
    zero = F.lit(0).cast("long")
    return joined.select(
        *named, *rest[len(keep) :], *(F.coalesce(c, zero).alias(c) for c in ("n_best", "count_sum"))
    )
