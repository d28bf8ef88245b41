"""Periodic runs against all stretches of short texts, and the query against plain Python."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import SF, no_docs, odd_docs

from acctmart.llm import periods, queries


def brute_runs(w):
    """Every period at every place, by comparing words."""
    n, found = len(w), {}
    for p in range(1, n // 4 + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and w[j] == w[j + p]:
                j += 1
            if j + p - i >= max(6, 4 * p):
                found.setdefault((i, j + p - i), p)  # by rising period, so the smallest stays
            i = max(j, i) + 1
    return sorted(((s, n, p) for (s, n), p in found.items()), key=lambda r: (r[0], r[2]))


def brute_collapse(w, runs):
    dropped = {i for s, n, p in runs for i in range(s + p, s + n)}
    return [x for i, x in enumerate(w) if i not in dropped]


repeats = st.lists(st.tuples(st.lists(st.sampled_from("abc"), min_size=1, max_size=7), st.integers(1, 9)), max_size=8)


@settings(max_examples=300, deadline=None)
@given(st.lists(repeats, max_size=4))
def test_runs_equal_all_stretches(texts):
    texts = [[x for part, k in text for x in part * k] for text in texts]
    assert periods.find_runs(texts) == [brute_runs(t) for t in texts]
    for t in texts:
        runs = brute_runs(t)
        assert periods.collapse(t, runs) == brute_collapse(t, runs)
        want = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
        assert periods.best_run(runs) == want


def test_runs_of_long_texts():
    pick = random.Random(5)
    period = [f"w{pick.randrange(50)}" for _ in range(700)]
    texts = [
        period * 9,
        ["x"] * 30_000,
        ["a", "b"] * 5_000 + ["c"] * 40 + ["a", "b"] * 2_000,
        [f"w{pick.randrange(3)}" for _ in range(4_000)],
    ]
    got = periods.find_runs(texts)
    assert (0, 6300, 700) in got[0] and got[1] == [(0, 30_000, 1)]
    assert [r for r in got[2] if r[1] > 100] == [(0, 10_000, 2), (10_040, 4_000, 2)]
    assert got[3] == brute_runs(texts[3])


def test_extensions_equal_comparing_words():
    pick = random.Random(6)
    for letters, n in ((1, 300), (2, 500), (3, 2_000), (1, 1), (2, 5)):
        w = np.array([pick.randrange(letters) for _ in range(n)])
        w[n // 2 :] = w[: n - n // 2]  # a long repeat
        lce = periods.Extensions(w)
        pairs = [(pick.randrange(n), pick.randrange(n)) for _ in range(400)]
        pairs = [(i, j) for i, j in pairs if i != j]
        got = lce(np.array([i for i, _ in pairs], int), np.array([j for _, j in pairs], int)).tolist()
        for (i, j), found in zip(pairs, got):
            k = 0
            while max(i, j) + k < n and w[i + k] == w[j + k]:
                k += 1
            assert found == k


def test_cover_gives_every_difference():
    gaps = sorted((a - b) % periods.MODULUS for a in periods.COVER for b in periods.COVER if a != b)
    assert gaps == list(range(1, periods.MODULUS))


def test_odd_rows(spark):
    for clash in (False, True):
        docs = odd_docs(spark, clash)
        rows = periods.periodic_runs(docs).collect()
        assert len(rows) == docs.count()
        for r in rows:
            w = (r.text or "").encode().split()
            runs = brute_runs(w) if len(w) < 1_000 else None
            assert r.n_words == len(w)
            if runs is not None:
                assert [tuple(x) for x in r.runs] == runs
                assert r.collapsed.encode() == b" ".join(brute_collapse(w, runs))
    assert periods.periodic_runs(no_docs(spark)).count() == 0


def expected(doc_id, text):
    w = (text or "").encode().split()
    n, h = len(w), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(w)
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None,) * 3)
    lines = "".join(f"{s},{k},{p}\n" for s, k, p in runs)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    milli = best[0] if best[0] is None else 1000 * best[1] // best[2]
    return (doc_id, len(runs), *best, milli, sha(lines.encode()), sha(b" ".join(brute_collapse(w, runs))))


def test_query_against_plain_python(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.op13_periodic_runs(spark, SF).collect()
    assert len(rows) == len(texts) and sum(r.n_runs > 0 for r in rows) > 10
    for r in rows:
        if len((texts[r.doc_id] or "").split()) < 3_000:
            assert tuple(r) == expected(r.doc_id, texts[r.doc_id])
