"""Language-model scores and tokenizer alignment against plain Python over whole small tables."""

import bisect
import hashlib
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import SF, no_docs, odd_docs
from pyspark.sql import functions as F

from acctmart.llm import alignment, queries, runs, scoring

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2**64 - 1), max_size=20), max_size=4))
def test_runs_come_back(columns):
    arrays = [np.array(c, "u8") for c in columns]
    assert [a.tolist() for a in runs.unpack(runs.pack(*arrays))] == columns
    for c in columns:
        up = np.array(sorted(c), "u8")
        assert runs.ascending(runs.gaps(up)).tolist() == up.tolist()


def tokens(text):
    return [w.decode() for w in (text or "").encode().lower().split()] + ["\n"]


class PlainModel:
    """The same model with dictionaries: counts by n-gram, weights by repeated passes."""

    def __init__(self, kept, deleted, order):
        self.order = order
        self.kept, both = self.count(kept), self.count([*kept, *deleted])
        self.n_kept, self.types = sum(map(len, kept)), len({w for t in [*kept, *deleted] for w in t})
        start, before = scoring.start_weights(order), None
        self.weights = start.copy()
        events = [e for t in deleted for e in self.events(t, self.kept)]
        for _ in range(scoring.PASSES):
            if not events:
                break
            sums, n, gain = np.zeros_like(start), Counter(), 0.0
            for context, c1, found in events:
                shares = self.weights[context] * [1 / (self.types + 1), c1 / max(self.n_kept, 1), *found]
                sums[context] += shares / shares.sum()
                n[context] += 1
                gain += math.log10(shares.sum()) / len(events)
            for context, k in n.items():
                self.weights[context] = (start[context] + sums[context]) / (k + 1)
            if before is not None and gain - before < scoring.LEAST_GAIN:
                break
            before = gain
        self.counts, self.n = both, sum(map(len, kept)) + sum(map(len, deleted))

    def count(self, texts):
        counts = Counter()
        for t in texts:
            t = ["\t"] * (self.order - 1) + t
            for k in range(self.order):
                counts[("\t",) * (k + 1)] += 1
                for i in range(self.order - 1, len(t)):
                    counts[tuple(t[i - k : i + 1])] += 1
        return counts

    def events(self, t, counts):
        t = ["\t"] * (self.order - 1) + t
        for i in range(self.order - 1, len(t)):
            context, found = 0, []
            for k in range(1, self.order):
                known = counts[tuple(t[i - k : i])]
                context = 64 * k + known.bit_length() if known else context
                found.append(counts[tuple(t[i - k : i + 1])] / max(known, 1))
            yield context, counts[t[i],], found

    def score(self, t):
        total = 0.0
        for context, c1, found in self.events(t, self.counts):
            p1 = c1 / self.n if self.n else 1 / (self.types + 1)
            total += math.log10(self.weights[context] @ [1 / (self.types + 1), p1, *found])
        return total

    def base(self, t):
        return sum(math.log10((self.counts[w,] + 1) / (self.n + self.types + 1)) for w in t)


@pytest.mark.parametrize(("clash", "order"), [(False, 2), (True, 3)])
def test_scores_equal_the_plain_model(spark, clash, order):
    docs = odd_docs(spark, clash).withColumn("row", F.monotonically_increasing_id())
    docs = spark.createDataFrame(docs.collect(), docs.schema)
    train = F.col("row") % 4 != 1
    deleted = F.col("row") % 4 == 2
    rows = {r.row: r for r in docs.collect()}
    part = lambda wanted: [tokens(r.text) for k, r in rows.items() if k % 4 in wanted]
    model = PlainModel(part({0, 3}), part({2}), order)
    got = scoring.lm_scores(docs, train, deleted, order=order, chunk_bytes=20_000).collect()
    assert len(got) == len(rows)
    for r in got:
        t = tokens(rows[r.row].text)
        assert (r.n_tokens, r.train_tokens) == (len(t), model.n)
        assert r.n_known == sum(model.counts[w,] > 0 for w in t)
        assert r.base_score == pytest.approx(model.base(t), rel=1e-9)
        assert r.score == pytest.approx(model.score(t), rel=1e-4)
    assert scoring.lm_scores(no_docs(spark), F.lit(True)).count() == 0
    nothing = scoring.lm_scores(docs, F.lit(False)).collect()
    assert len(nothing) == len(rows) and all(r.score == r.base_score == 0 for r in nothing)


@pytest.mark.parametrize("order", [2, 3])
def test_probabilities_add_up_to_one(order):
    texts = [list("abcab"), list("abd"), list("cab"), list("ba"), list("e")]
    model = PlainModel([[*t, "\n"] for t in texts[:4]], [[*t, "\n"] for t in texts[4:]], order)
    words = [w for w in "abcde"] + ["\n", "unknown"]
    for before in ("a", "ab", "abc", ""):
        p = [10 ** (model.score([*before, w]) - model.score([*before])) for w in words]
        assert sum(p) == pytest.approx(1, abs=1e-9)


def test_query_beats_its_base_on_held_out_texts(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d in texts}
    counts = Counter(w for d, t in texts.items() if not held[d] for w in tokens(t))
    n, types = sum(counts.values()), len(counts)
    got = {r.doc_id: r for r in queries.op11_lm_scoring(spark, SF).collect()}
    assert got.keys() == texts.keys()
    for d, r in got.items():
        t = tokens(texts[d])
        base = sum(math.log10((counts[w] + 1) / (n + types + 1)) for w in t)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[d], len(t), sum(w in counts for w in t), n)
        assert r.base_score == pytest.approx(base, rel=1e-9)
    apart = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in apart) > 0.95 * sum(r.base_score for r in apart)


def plain_alignment(texts):
    """Rows by walking over the bytes, and counts by dictionaries."""
    import sentencepiece
    from tokenizers import Tokenizer

    left = Tokenizer.from_file(A)
    left.encode_special_tokens = True
    right = sentencepiece.SentencePieceProcessor(model_file=B)
    letters = {c: b for b, c in alignment.byte_characters().items()}
    docs = []
    for text in texts:
        whole = (" " + text).encode() if text else b""
        a = left.encode(" " + text, add_special_tokens=False) if text else None
        a = [(k, bytes(letters[c] for c in left.id_to_token(k))) for k in (a.ids if a else [])]
        b = []
        for k in right.encode(text) if text else []:
            piece = right.id_to_piece(k)
            byte = len(piece) == 6 and piece[:3] == "<0x"
            b.append((k, bytes([int(piece[3:5], 16)]) if byte else piece.replace("▁", " ").encode()))
        if b"".join(t for _, t in a) != whole or b"".join(t for _, t in b) != whole:
            a, b = [], []
        spans, ends = [], []
        for side in (a, b):
            at, out = 0, []
            for k, t in side:
                out.append((k, at, at + len(t)))
                at += len(t)
            spans.append(out)
            ends.append({e for _, _, e in out})
        at = [n for n, (_, s, e) in enumerate(spans[1]) for _ in range(s, e)]  # the B token of each byte
        links = [(x, spans[1][n][0]) for x, s, e in spans[0] for n in sorted(set(at[s:e]))]
        cuts = sorted(ends[0] & ends[1])
        inside = [([], []) for _ in cuts]
        for side in (0, 1):
            for k, s, _ in spans[side]:
                inside[bisect.bisect_right(cuts, s)][side].append(str(k))
        groups = ["|".join(map(",".join, g)) for g in inside]
        docs.append((len(a), len(b), links, groups))
    count = Counter(pair for *_, links, _ in docs for pair in set(links))
    most = defaultdict(int)
    for (x, _), n in count.items():
        most[x] = max(most[x], n)
    for a, b, links, groups in docs:
        best = sum(count[p] == most[p[0]] for p in links)
        yield a, b, len(groups), len(links), ";".join(groups), best, sum(count[p] for p in links)


@pytest.mark.parametrize("clash", [False, True])
def test_alignment_equals_walking_over_bytes(spark, clash):
    docs = odd_docs(spark, clash)
    more = ["a▁b", "<0x41> <s> </s> <unk>", "x  y\n\nz\t", "日本語のテキスト と emoji 🎉🎉", "ﬁ ligature Ａ", "\x00 nul", " lead", "<|endoftext|>"]
    docs = docs.unionByName(spark.createDataFrame([(900 + k, t) for k, t in enumerate(more)], "doc_id long, text string"), allowMissingColumns=True)
    docs = docs.where("coalesce(length(text), 0) < 5000")
    rows = alignment.align(docs, A, B, chunk_bytes=3_000).select("text", "n_a", "n_b", "n_groups", "n_links", "groups", "n_best", "count_sum").collect()
    assert len(rows) == docs.count()
    assert [tuple(r)[1:] for r in rows] == list(plain_alignment([r.text for r in rows]))
    assert alignment.align(no_docs(spark), A, B).count() == 0


def test_alignment_does_not_depend_on_chunks(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    take = lambda **o: sorted(map(tuple, alignment.align(docs, A, B, keep=["doc_id"], **o).collect()))
    whole = take()
    monkeypatch.setattr(alignment, "FAN_IN", 3)
    monkeypatch.setattr(alignment, "GROUP_CHUNKS", 2)
    assert take(chunk_bytes=20_000) == whole
    short = [r for r in whole if r[1] < 3_000]
    assert len(short) > 0.9 * len(whole)


def test_alignment_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    ids = sorted(texts, key=str)
    rows = {r.doc_id: r for r in queries.op12_tokenizer_alignment(spark, SF).collect()}
    sha = lambda g: hashlib.sha256(g.encode()).hexdigest() if g else ""
    if sum(len(t or "") for t in texts.values()) < 2_000_000:
        for d, want in zip(ids, plain_alignment([texts[d] for d in ids])):
            r = rows[d]
            assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.groups_sha256, r.n_best, r.count_sum) == (*want[:4], sha(want[4]), *want[5:])
