"""Quality rules, token counts, byte-level BPE and license scans against plain Python and the libraries."""

import hashlib
import random
import re
import struct

import public_tokenizers as P
import pytest
from llm_cases import SF, no_docs, odd_docs, prose
from pyspark.sql import functions as F

from acctmart.llm import bpe, licenses, quality, queries, token_counts

WORD = re.compile(r"[^\x20\x09-\x0D]+")
RANKS = P.path("byte_bpe_multi_50k.tiktoken")
JSON = P.path("byte_bpe_50k.json")


def repeated(ws):
    seen, covered = {}, set()
    for i in range(len(ws) - 7):
        window = tuple(ws[i : i + 8])
        if window in seen:
            covered |= {*range(i, i + 8), *range(seen[window], seen[window] + 8)}
        else:
            seen[window] = i
    return len(covered)


def measures(text):
    text = text or ""
    ws = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(ws) < 20 or 100 * repeated(ws) > 30 * len(ws)
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    return len(ws), sum(map(len, ws)), symbols, len(lines) - len(set(lines)), repeated(ws), failed


@pytest.mark.parametrize("clash", [False, True])
def test_quality_counts(spark, clash):
    texts = ["a b c d e f g h i\na b c d e f g h i", "x\nx\n \n\nx", "# * $ % & | < >", " ".join(["same words here again"] * 40)]
    more = spark.createDataFrame([(200 + i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    docs = odd_docs(spark, clash).unionByName(more, allowMissingColumns=True)
    got = quality.quality(docs)
    rows = got.collect()
    assert len(rows) == docs.count()
    for r in rows:
        want = measures(r.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == want
        assert r.kept is False if r.base_failed else r.kept is not None
    assert quality.quality(no_docs(spark)).count() == 0


def test_quality_over_a_table_and_its_labels(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r.doc_id: r for r in queries.op8_quality_rules(spark, SF).collect()}
    for r in docs.collect():
        assert tuple(got[r.doc_id])[1:7] == measures(r.text)
    good = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").collect() if r.quality == 1}
    assert all(got[d].kept for d in good if not got[d].base_failed)


def test_quality_against_sql(spark):
    import duckdb

    from workload.compare import differences

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    assert differences(queries.op8_quality_rules(spark, SF), con, queries.ORACLES["op8_quality_rules"]) == []


def test_filter_on_the_verdict_measures_once(spark):
    plan = quality.quality(odd_docs(spark)).filter("kept").select("doc_id")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("split(") <= 2 and "Python" not in plan and "Exchange hash" not in plan


def test_quality_of_clean_text_does_not_depend_on_its_length(spark):
    import corpus_pipeline

    rows = []
    for k, line in enumerate(quality.STOP_WORDS.values()):
        common = line.split()
        # so many different words that those of the whole list are less than a thousandth of them
        for n in (40, 400, 60_000):
            ws = [common[i // 2 % len(common)] if i % 2 else f"word{i}" for i in range(n)]
            rows.append((10 * k + len(str(n)), " ".join(ws + [f"more{i}" for i in range(n)])))
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("x") for c in ("lang", "source", "n_chars")})
    got = quality.quality(docs).collect()
    assert any(r.n_stop < 0.001 * r.n_different for r in got) and all(r.kept for r in got)
    assert corpus_pipeline.quality_stage(spark, docs, SF).count() == len(rows)


def fuzz():
    pick = random.Random(5)
    some = [chr(c) for c in range(1, 0x2FFF)] + [" "] * 3000 + ["\n"] * 900 + list("thean'slr") * 300
    texts = ["".join(pick.choice(some) for _ in range(pick.randint(0, 60))) for _ in range(1500)]
    pieces = ["the", "an", "ing", " ", "  ", "\n", "é", "日本", "123", "'s", "\t", "　", "<|endoftext|>"]
    texts += ["".join(pick.choice(pieces) for _ in range(30)) for _ in range(1500)]
    return texts + ["a" * 3000, " " * 999, "ab" * 999, "", " ", " \n", "a ", "  a", "\n a", "a \n b", "=-" * 300]


def test_bpe_equals_the_library():
    import tiktoken

    ranks = bpe.load_ranks(RANKS)
    codec = bpe.Codec(ranks)
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = fuzz()
    for text, ids in zip(texts, codec.encode(texts), strict=True):
        assert list(memoryview(ids).cast("I")) == library.encode_ordinary(text)
        assert codec.decode([ids]) == [text.encode()]


def test_token_counts_equal_the_library():
    from tokenizers import Tokenizer

    counter = token_counts.Counter(token_counts.load_vocabulary(JSON))
    library = Tokenizer.from_file(JSON)
    texts = fuzz()
    want = [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    assert counter.count(texts) == want and counter.count([]) == []


def test_memos_start_anew_and_stay_right():
    codec = bpe.Codec(bpe.load_ranks(RANKS))
    texts = [prose(3000, 8), "  ", "éa, b\nc!? d\n\ne"] * 3
    want = codec.encode(texts)
    for memo in (codec.by_chunk, codec.by_token, codec.pairs):
        memo.entries = 10
        memo.clear()
    assert codec.encode(texts) == want and len(codec.by_chunk) <= 10


def test_vocabularies_of_one_process_stay_apart(spark):
    """One after the other in the same workers, also where the first one is gone."""
    import tiktoken

    docs = odd_docs(spark)
    for _ in range(2):
        for path in (RANKS, P.path("byte_bpe_50k.tiktoken")):
            library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.load_ranks(path), special_tokens={})
            for r in bpe.encode(docs, path).collect():
                assert list(memoryview(r.ids).cast("I")) == library.encode_ordinary(r.text or "")


@pytest.mark.parametrize("clash", [False, True])
def test_coding_odd_rows(spark, clash):
    docs = odd_docs(spark, clash)
    coded = bpe.encode(docs, RANKS).collect()
    assert len(coded) == docs.count()
    codec = bpe.Codec(bpe.load_ranks(RANKS))
    assert [r.ids for r in coded] == codec.encode([r.text or "" for r in coded])
    back = bpe.decode(bpe.encode(docs, RANKS, keep=["doc_id", "text"]), RANKS).collect()
    assert all(r.decoded == (r.text or "").encode() for r in back)
    counts = token_counts.token_counts(docs, JSON).collect()
    assert all(r.n_bytes == len((r.text or "").encode()) and r.over_limit == (r.n_tokens > 512) for r in counts)
    assert bpe.encode(no_docs(spark), RANKS).count() == token_counts.token_counts(no_docs(spark), JSON).count() == 0


def test_coding_whole_tables_equals_the_libraries(spark):
    import tiktoken
    from tokenizers import Tokenizer

    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.load_ranks(RANKS), special_tokens={})
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.op10_byte_bpe(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
    order = list(texts)
    want = Tokenizer.from_file(JSON).encode_batch([texts[d] for d in order], add_special_tokens=False)
    counts = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in queries.op9_token_counts(spark, SF).collect()}
    assert counts == {d: (len(texts[d].encode()), len(e.ids), len(e.ids) > 512) for d, e in zip(order, want)}


def test_tasks_let_go_what_other_operators_held(monkeypatch):
    from acctmart.llm import common

    monkeypatch.setattr(common, "_HELD", {})
    one = common.made(lambda: common.held("codec", "x", object))
    assert common.made(lambda: common.held("codec", "x", object)) is one
    assert common.made(lambda: common.held("counter", "y", object)) is not one and list(common._HELD) == ["counter"]
    common.made(lambda: None)
    assert common._HELD == {}


def plain_scan(text, contained=licenses.CONTAINED):
    """The best containment of each template over all of its windows, by sets of words."""
    def shingles(t):
        ws = [w for raw in t.encode().lower().split() if (w := raw.strip(licenses._AROUND))]
        return [tuple(ws[i : i + 5]) for i in range(len(ws) - 4)]

    found, all_ = {}, shingles(text or "")
    for _, name, template in licenses.TEMPLATES:
        own = set(shingles(template))
        step = len(own) + 4
        shares = [len(set(all_[s : s + 2 * step - 4]) & own) / len(own) for s in range(0, len(all_), step)]
        if shares and max(shares) >= contained:
            found[name] = max(shares)
    return found


def test_license_scan_against_all_windows(spark):
    texts = []
    for k, (_, _, template) in enumerate(licenses.TEMPLATES * 4):
        words = template.split(" ")
        if k >= len(licenses.TEMPLATES) and len(words) > 20:
            words[k % len(words)] = "other"
        texts.append(f"{prose(k * 3, k)} {' '.join(words)}. {prose(40, k + 1)}".strip())
    texts += [t for r in spark.read.parquet(f"{SF}/documents.parquet").collect() for t in [r.text]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {}
    for r in licenses.license_scan(docs, keep=["doc_id"]).collect():
        got.setdefault(r.doc_id, {})[r.template] = r.containment
    want = {i: w for i, t in enumerate(texts) if (w := plain_scan(t))}
    assert got == want and sum(map(len, want.values())) >= 2 * len(licenses.TEMPLATES)


def test_license_scan_of_odd_rows(spark):
    rows = licenses.license_scan(odd_docs(spark, clash=True)).collect()
    assert [(r.doc_id, r.license) for r in rows] == [(16, "Apache-2.0")] and rows[0].first_word == 0
    assert licenses.license_scan(no_docs(spark)).count() == 0
    for _, values, _, window, signature in licenses.Scanner(licenses.TEMPLATES).templates:
        held = -(-len(values) * 8 // 10)
        assert (1 - held / (window + len(values) - held)) ** len(signature) <= licenses.MISS


def test_license_scan_finds_short_notices(spark):
    texts = [
        f"{prose(50, 1)}\n(c) 2020 Some One. All rights reserved.", "SPDX-License-Identifier: MIT", "MIT License", "all rights are reserved",
        "all rights", "Under the Apache License, Version 2.0 now",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    scanned = licenses.license_scan(docs, templates=licenses.NOTICES, names=licenses.NAMES)
    got = [(r.doc_id, r.template, r.containment, r.first_word, r.last_word) for r in scanned.collect()]
    want = [(0, "all rights reserved", 54, 56), (1, "spdx mit", 0, 1), (2, "mit name", 0, 1), (5, "apache name", 2, 5)]
    assert sorted(got) == [(d, name, 1.0, first, last) for d, name, first, last in want]


@pytest.mark.parametrize("first, mark, last", [("", "# ", ""), ("", "// ", ""), ("/*\n", " * ", "\n */"), ("<!--\n", " - ", "\n-->"), ("", "-- ", "")])
def test_license_scan_reads_comments(spark, first, mark, last):
    texts = []
    for _, _, template in licenses.NOTICES:
        ws = template.split(" ")
        lines = [" ".join(ws[i : i + 9]) for i in range(0, len(ws), 9)]
        texts.append(first + "\n".join(mark + line for line in lines) + last)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {(r.doc_id, r.template) for r in licenses.license_scan(docs, templates=licenses.NOTICES).filter("containment = 1").collect()}
    assert got >= {(i, name) for i, (_, name, _) in enumerate(licenses.NOTICES)}


def test_license_scan_gives_each_place():
    names = [name for _, name, _ in licenses.NOTICES]
    scanner = licenses.Scanner(licenses.NOTICES)
    for number, (_, name, template) in enumerate(licenses.NOTICES):
        ws = template.split(" ")
        edited = " ".join(["other", *ws[1:]]) if len(ws) > 20 else template
        third = len(ws) // 3
        turned = " ".join(ws[-third:] + ws[third:-third] + ws[:third]) if len(ws) > 45 else template
        copies = [template, template, edited, template, turned, template]
        for gap in ("", prose(7, 1), prose(90, 2)):
            text, at, want = prose(11, 3), 11, []
            for copy in copies:
                want.append(at)
                text += f" {copy} {gap}"
                at += len(ws) + len(gap.split())
            got = [(share, first, last) for k, share, first, last in scanner.scan(text) if names[k] == name]
            assert len(got) == len(copies), (name, gap, got)
            assert [x[1:] for x in got[:2]] == [(first, first + len(ws) - 1) for first in want[:2]]
            assert all(x[0] == 1 for x in got[:2]) and all(a[2] < b[1] for a, b in zip(got, got[1:]))


def test_license_names_count_in_notices_only():
    scanner = licenses.Scanner(licenses.NOTICES, names=licenses.NAMES)
    names = [name for _, name, _ in [*licenses.NOTICES, *licenses.NAMES]]
    found = lambda text: [names[k] for k, *_ in scanner.scan(text)]
    assert found("the MIT license plate story") == [] and found("They wrote about the BSD license at length.") == []
    for _, name, text in licenses.NAMES:
        for notice in (text, f"one two three\n# {text}.\nfour five", f"Released under the {text}", f"{prose(20, 1)} ({text}) is the license of it"):
            assert name in found(notice), (name, notice)
        assert name not in found(f"{prose(20, 1)} {text} {prose(20, 2)}")


def test_license_texts_are_told_apart():
    """Each text is found as its own, and no text as one of another license that it doesn't hold, by sets of words."""
    scanner = licenses.Scanner(licenses.NOTICES)
    general = {"GPL", "BSD", "permissive-disclaimer", "all-rights-reserved"}
    pieces = {
        ("BSD-2-Clause", "BSD-2-Clause"), ("NCSA", "MIT"),
    }
    for number, (license_, name, text) in enumerate(licenses.TEMPLATES + licenses.FULL_TEXTS):
        found = {k: share for k, share, *_ in scanner.scan(f"{prose(30, 1)} {text} {prose(30, 2)}")}
        assert found[number] == 1, name
        others = {licenses.NOTICES[k][0] for k in found} - {license_} - general
        assert others <= {b for a, b in pieces if a == license_}, (name, others)
        # with a word of fifty changed, long texts are still found
        words = text.split(" ")
        if len(words) > 60:
            edited = " ".join("other" if i % 50 == 25 else w for i, w in enumerate(words))
            assert number in {k for k, *_ in scanner.scan(edited)}, name
    assert len({license_ for license_, *_ in licenses.NOTICES}) >= 35


def test_license_query_finds_the_reserved_rights(spark):
    held = {r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").filter("text ILIKE '%all rights reserved%'").collect()}
    found = {r.doc_id for r in queries.op4_license_scan(spark, SF).filter("template = 'all rights reserved'").collect()}
    assert held and found == held


def test_no_fixed_row_limits(spark):
    docs = odd_docs(spark)
    assert docs.filter(F.length("text") > 100_000).count() == 1
