"""Near duplicates, vectors, components, mixing and chats against brute force."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from llm_cases import SF, changed, no_docs, odd_docs, prose
from pyspark.sql import Window
from pyspark.sql import functions as F

from acctmart.llm import chats, components, mixing, neardup, queries, vectorjoin


def lowest(nodes, links):
    lead = {n: n for n in nodes}

    def root(x):
        while lead[x] != x:
            x = lead[x]
        return x

    for a, b in links:
        low, high = sorted((root(a), root(b)))
        lead[high] = low
    return {n: root(n) for n in nodes}


def test_components(spark):
    pick = random.Random(4)
    links = [(k, k + 1) for k in range(100, 160)] + [(pick.randrange(400, 700), pick.randrange(400, 700)) for _ in range(200)]
    links += [(900, k) for k in range(901, 1200)] + [(5, 5), (3, 2), (2, 3)]
    df = spark.createDataFrame(links, "x long, y long").repartition(4)
    got = {r.id: r.component for r in components.components(df).collect()}
    nodes = {n for a, b in links if a != b for n in (a, b)}
    assert got == lowest(nodes, [x for x in links if x[0] != x[1]])
    assert components.components(df.limit(0)).count() == 0


def plain_sets(rows):
    sets = {}
    for d, t in rows:
        w = (t or "").encode().lower().split()
        sets[d] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    return sets


def plain_groups(sets):
    ids = sorted(sets)
    links = []
    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
                links.append((a, b))
    return lowest(ids, links)


@pytest.mark.parametrize("rows", [24, 512])
def test_near_duplicates_against_all_pairs(spark, monkeypatch, rows):
    """Chains, copies and groups with hubs that don't link with all; blocks of any size."""
    monkeypatch.setattr(neardup, "GROUP_ROWS", rows)
    texts, pick = [], random.Random(9)
    for g in range(6):
        base = prose(120, 1000 + g)
        texts += [base] * 3
        for k in range(25):
            words = base.split(" ")
            for _ in range(pick.randint(0, 4)):
                words[pick.randrange(len(words))] = f"new{g}{k}"
            texts.append(" ".join(words))
        chain = base
        for k in range(8):
            chain = changed(chain, 97 - k)
            texts.append(chain)
    texts += [prose(60, 5000 + k) for k in range(40)]
    order = list(range(len(texts)))
    pick.shuffle(order)
    data = [(order[i], t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(data, "doc_id long, text string").repartition(4)
    sets = plain_sets(data)
    want = plain_groups(sets)
    for r in neardup.near_duplicates(docs).collect():
        assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), want[r.doc_id], want[r.doc_id] == r.doc_id)


@pytest.mark.parametrize("clash", [False, True])
def test_near_duplicates_of_odd_rows(spark, clash):
    docs = odd_docs(spark, clash)
    got = neardup.near_duplicates(docs).collect()
    assert len(got) == docs.count()
    sets = plain_sets([(r.doc_id, r.text) for r in docs.collect() if r.doc_id is not None])
    want = plain_groups(sets)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert r.component_id == want[r.doc_id] and r.n_shingles == len(sets[r.doc_id])
    assert want[8] == want[7] == 6 and want[15] == 14 and want[3] == 3
    assert neardup.near_duplicates(no_docs(spark)).count() == 0


def test_near_duplicates_over_repeated_ids(spark):
    """The texts of one id link, also through an id that has no words in one of its rows."""
    a, b, c = prose(60, 1), prose(60, 2), prose(60, 3)
    rows = [(1, a), (5, a), (5, b), (9, b), (9, ""), (11, c), (11, None), (12, c), (20, prose(50, 4)), (20, prose(50, 5)), (21, "")]
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = {1: 1, 5: 1, 9: 1, 11: 11, 12: 11, 20: 20, 21: 21}
    assert len(got) == len(rows) and {(r.doc_id, r.component_id) for r in got} == set(want.items())


def test_large_component_is_sent_once_for_each_block_of_the_rest(spark):
    """20,000 classes of which 19,700 are one component: these don't meet each other, all else does."""
    groups = spark.range(20_000).select(F.col("id").alias("rep"), F.lit(0).cast("long").alias("group"))
    component = F.when(F.col("rep") < 19_700, F.lit(0)).otherwise(F.col("rep") - F.col("rep") % 3).cast("long")
    placed = groups.select(F.explode(F.array(F.lit(1), F.lit(2))).alias("band"), "rep", component.alias("component"))
    classes = groups.select("rep", F.lit(9).cast("long").alias("n_shingles"), F.lit(b"r").alias("registers"))
    texts = groups.select(F.col("rep").alias("doc_id"), F.lit("t").alias("text"))
    met = neardup._meetings(groups, placed, classes, texts)
    sent = met.groupBy("rep", "component", "block").agg(F.count("*").alias("n"), F.collect_set(F.struct("lo", "hi")).alias("at")).collect()
    assert len(sent) == 20_000
    main = [r for r in sent if r.component == 0]
    rest = [r for r in sent if r.component != 0]
    assert len(main) == 19_700 and {r.n for r in main} == {1}
    blocks = {r.block for r in sent}
    assert len(blocks) == 40 and {r.block for r in rest} == {39}
    for r in rest:
        assert {lo for lo, hi in r.at} == blocks and {hi for lo, hi in r.at} == {39}
    assert all(r.at == [(r.block, 39)] for r in main)
    assert max(r["count"] for r in met.groupBy("lo", "hi").count().collect()) < 2 * neardup.GROUP_ROWS


def test_registers_merge_and_tell_similarity():
    pick = np.random.default_rng(3)
    x = np.unique(pick.integers(0, 2**63, 3000).astype(np.uint64))
    a, b = x[:2000], x[200:2200]
    ra, rb, both = neardup.registers([a, b, np.union1d(a, b)])
    assert (np.maximum(ra, rb) == both).all()
    assert (neardup.registers([a])[0] == ra).all()  # alone or in a batch
    similarity = 1800 / 2200
    assert abs((ra == rb).mean() - similarity) < 4.5 * math.sqrt(similarity * (1 - similarity) / neardup.REGISTERS) + 0.02
    sizes = np.array([2000.0])
    assert neardup.plausible(ra[None], rb[None], sizes, sizes, 80)[0]
    assert not neardup.plausible(ra[None], neardup.registers([x[1000:3000]]), sizes, sizes, 85)[0]
    assert len({bytes(r) for r in neardup.registers([x[:1], x[:1]])}) == 1


def test_plausible_keeps_pairs_at_the_threshold():
    pick = np.random.default_rng(5)
    sets = []
    for _ in range(150):
        x = pick.integers(0, 2**63, 460).astype(np.uint64)
        sets += [np.unique(x[:430]), np.unique(x[34:])]  # 396 of 460 in common: 0.86
    r = neardup.registers(sets)
    n = np.array([len(s) for s in sets], float)
    assert neardup.plausible(r[::2], r[1::2], n[::2], n[1::2]).all()
    assert ((r[::2] == r[1::2]).sum(axis=1) >= neardup.LEAST_SAME).all()


def vectors(spark):
    pick = np.random.default_rng(11)
    rows, number = [], 0
    for label in (0, 1, None):
        for _ in range(40):
            base = pick.normal(size=16)
            for k in range(pick.integers(1, 5)):
                v = base + pick.normal(size=16) * 0.12 * k
                rows.append((number, [float(np.float32(x)) for x in v * pick.uniform(0.1, 50)], label))
                number += 1
    same = rows[0][1]
    rows += [(number + k, same, 0) for k in range(30)]
    odd = [None, [], [0.0] * 16, [float("nan")] * 16, [1.0, None] * 8, [float("inf")] + [1.0] * 15, [1e-30] * 16, [1e30] * 16, [1.0] * 3]
    rows += [(1000 + k, v, 0) for k, v in enumerate(odd)] + [(1000 + k, v, 1) for k, v in enumerate(odd)] + [(None, same, 0)]
    return rows, spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3)


@pytest.mark.parametrize("interval", [16, 1024])
def test_vectors_against_all_pairs(spark, monkeypatch, interval):
    monkeypatch.setattr(vectorjoin, "BLOCK", 8)
    monkeypatch.setattr(vectorjoin.intervals, "__defaults__", (interval,))
    rows, df = vectors(spark)

    def usable(v, label):
        return label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    unit = {}
    for i, (_, v, label) in enumerate(rows):
        if usable(v, label):
            x = np.asarray(v, np.float32).astype(float)
            unit[i] = x / np.linalg.norm(x)
    links = [
        (i, j) for i in unit for j in unit
        if i < j and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.93
    ]
    counts = Counter(k for pair in links for k in pair)
    # rows of one id are one node; the row without id links its neighbours
    nodes = {i: rows[i][0] if rows[i][0] is not None else -1 for i in range(len(rows))}
    sets = lowest(set(nodes.values()) | {10**9}, [(nodes[i] if nodes[i] >= 0 else 10**9, nodes[j] if nodes[j] >= 0 else 10**9) for i, j in links])
    got = vectorjoin.linked_vectors(df.withColumn("rep", F.lit(1)).withColumn("key", F.lit("x"))).collect()
    assert len(got) == len(rows)
    assert Counter((r.vec_id, r.n_links) for r in got) == Counter((rows[i][0], counts[i]) for i in range(len(rows)))
    for r in got:
        if r.vec_id is not None and r.vec_id < 1000:
            assert r.component_id == sets[r.vec_id] and r.kept == (sets[r.vec_id] == r.vec_id)
    assert len(links) > 400 and vectorjoin.linked_vectors(df.limit(0)).count() == 0


def water(sizes, weights=(3, 1, 2)):
    total, open_, out = 1.5 * sum(sizes.values()), sorted(sizes, key=lambda s: (s is None, s or "")), {}
    weight = {s: weights[i % 3] for i, s in enumerate(open_)}
    while open_:
        left = total - sum(out.values())
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        above = [s for s in open_ if share[s] > 2 * sizes[s]]
        if not above:
            return out | share
        out |= {s: 2.0 * sizes[s] for s in above}
        open_ = [s for s in open_ if s not in above]
    return out


def test_vectors_in_double_precision(spark):
    """Doubles keep their digits and their range; pairs at the threshold are told apart by them."""
    at = lambda c: [c, math.sqrt(1 - c * c)]
    rows = [(1, [1.0, 0.0], 0), (2, at(0.93 + 4e-9), 0), (3, [1.0, 0.0], 1), (4, at(0.93 - 4e-9), 1), (5, [1e39, 0.0], 2), (6, [1e-200, 0.0], 2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in vectorjoin.linked_vectors(df).collect()}
    assert got == {1: (1, 1), 2: (1, 1), 3: (0, 3), 4: (0, 4), 5: (1, 5), 6: (1, 5)}


@pytest.mark.parametrize("clash", [False, True])
def test_mix_takes_what_the_targets_say(spark, clash):
    more = spark.createDataFrame(
        [(500 + k, prose(20 + k % 50, k), "en", f"t{k % 5}" if k % 2 else "hot", 0) for k in range(600)],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    docs = odd_docs(spark, clash).unionByName(more, allowMissingColumns=True).repartition(5)
    rows = mixing.draws(docs, block_docs=50).collect()
    again = mixing.draws(docs.repartition(2), block_docs=50).collect()
    key = lambda r: (str(r.doc_id), str(r.text), str(r.draws))
    assert sorted(map(key, rows)) == sorted(map(key, again)) and len(rows) == docs.count()
    sizes = Counter()
    for r in rows:
        assert r.size == len((r.text or "").encode().split()) or " " in r.text or " " in r.text
        sizes[r.source] += r.size
    target = water(sizes)
    assert sum(target.values()) == pytest.approx(1.5 * sum(sizes.values()))
    taken = Counter()
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source]) and len(r.draws) <= 2
        taken[r.source] += r.size * len(r.draws)
    for s, t in target.items():
        assert t - 60 <= taken[s] <= t or sizes[s] > 20_000 and taken[s] <= t
    shards = Counter(d.shard for r in rows for d in r.draws)
    assert set(shards) <= set(range(mixing.SHARDS))
    assert mixing.draws(no_docs(spark)).count() == mixing.mix(no_docs(spark)).count() == 0


def test_splitting_tree_gives_exact_quotas(spark):
    counts = {"a": 700, "b": 90, None: 41, "c": 1}
    df = spark.createDataFrame(list(counts.items()), "source string, blocks long")
    for shards in (1, 5, 8):
        rows = mixing.shard_quotas(df, shards).collect()
        per_source, per_shard = Counter(), Counter()
        for r in rows:
            per_source[r.source] += r.quota
            per_shard[r.shard] += r.quota
        assert per_source == counts and sorted(per_shard) == list(range(shards))
        assert max(per_shard.values()) - min(per_shard.values()) <= 3
    a = [r.quota for r in mixing.shard_quotas(df, 8).filter("source = 'a'").collect()]
    assert 60 < min(a) and max(a) < 110 and len(set(a)) > 1


def test_query_draws_by_the_quotas_of_the_tree(spark):
    """Each unit (a block in a pass) of the query's own draws is in one shard, and the shards have equal numbers of units."""
    sf = SF.replace("0.001", "0.1")
    rows = queries.op2_mix_sources(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "source"), "doc_id")
    lot = F.xxhash64(F.lit(mixing.SEED), F.col("doc_id"))
    blocks = F.least(F.ceil(F.count("*").over(Window.partitionBy("source")) / mixing.BLOCK_DOCS), F.lit(mixing.MOST_BLOCKS))
    units = (
        rows.withColumn("blocks", blocks)
        .withColumn("block", F.pmod(F.xxhash64(F.lit("block"), lot), F.col("blocks")))
        .withColumn("d", F.explode("draws"))
        .groupBy("source", "block", "d.pass")
        .agg(F.min("d.shard").alias("shard"), F.max("d.shard").alias("other"))
        .collect()
    )
    assert len(units) > 20 and all(u.shard == u.other for u in units)
    shards = Counter(u.shard for u in units)
    assert max(shards.values()) - min(shards[k] for k in range(mixing.SHARDS)) <= 2
    assert rows.filter("taken <> size * size(draws)").count() == 0


def test_mix_rows(spark):
    docs = odd_docs(spark)
    want = Counter()
    for r in mixing.draws(docs).collect():
        want[r.doc_id, r.text] += len(r.draws)
    got = mixing.mix(docs)
    assert got.columns == [*docs.columns, "shard"]
    assert Counter((r.doc_id, r.text) for r in got.collect()) == +want


@pytest.mark.parametrize("block_docs", [1, 40])
def test_mix_fills_on_with_the_next_blocks(spark, block_docs):
    rows = [(k, prose(1 + k * k % 61 if k % 50 else 2000, k), f"s{k % 4}") for k in range(400)]
    rows += [(None, prose(30, k), "s0") for k in range(40)] + [(7, prose(9, k), None) for k in range(5)] + [(8, "one word", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    got = mixing.draws(docs, block_docs=block_docs).collect()
    taken, lots, times = Counter(), Counter(), {}
    for r in got:
        taken[r.source] += r.size * len(r.draws)
        lots[r.source, r.doc_id] += r.size
        times.setdefault((r.source, r.doc_id), set()).add(len(r.draws))
    assert all(len(t) == 1 for t in times.values())
    for source, size, target in {(r.source, r.source_size, r.target) for r in got}:
        out = [lots[k] for k, (n,) in times.items() if k[0] == source and n <= target // size]
        assert 0 <= target - taken[source] < min(out, default=1)


def test_mix_keeps_the_order_of_a_shard(spark, conf):
    conf(spark__sql__adaptive__coalescePartitions__enabled="false")
    docs = spark.createDataFrame([(k, prose(20, k), f"s{k % 3}") for k in range(900)], "doc_id long, text string, source string")
    want = sorted((d.shard, d.place, r.doc_id) for r in mixing.draws(docs, block_docs=50, shards=2).collect() for d in r.draws)
    got = mixing.mix(docs, place="at", block_docs=50, shards=2)
    assert got.columns == [*docs.columns, "shard", "at"] and got.rdd.getNumPartitions() > 2
    # in the order of the partitions, the pieces of a shard follow each other
    assert [(r.shard, r.at, r.doc_id) for r in got.collect()] == want
    assert [r.doc_id for r in mixing.mix(docs, block_docs=50, shards=2).collect()] == [d for _, _, d in want]


def turns():
    rows = []
    for k in range(6):
        talk = [("user" if i % 2 == 0 else "assistant", f"text {k} {i}") for i in range(5)]
        for n in range(1, 6):  # snapshots
            rows += [(10 * k + n, i, r, t) for i, (r, t) in enumerate(talk[:n])]
    rows += [(90, i, r, t) for i, (r, t) in enumerate(talk)]  # an equal one
    rows += [(91, 0, None, None), (92, 0, "", ""), (92, 1, "user", None), (93, 7, None, None), (93, None, "user", "x")]
    rows += [(None, 0, "user", "text 0 0"), (None, 1, "user", "other"), (94, 0, "user", "dup"), (94, 0, "user", "dup")]
    return rows + [(95, i, "user", f"long {i}") for i in range(2500)] + [(96, i, "user", f"long {i}") for i in range(1200)]


def test_chats_against_all_prefixes(spark):
    df = spark.createDataFrame(turns(), "conv_id long, turn long, role string, text string").repartition(4)
    talks = {}
    order = lambda t: tuple((x is not None, x) for x in t)
    for n, (c, *rest) in enumerate(turns()):
        talks.setdefault(("none", n) if c is None else c, []).append(tuple(rest))
    talks = {c: tuple((r, t) for _, r, t in sorted(v, key=order)) for c, v in talks.items()}
    first = {}
    for c in sorted(talks, key=lambda c: (isinstance(c, tuple), c)):
        first.setdefault(talks[c], c)
    keep = {c: t for t, c in first.items() if not any(len(o) > len(t) and o[: len(t)] == t for o in first)}
    got = {r.conv_id: r for r in chats.format_chats(df.withColumn("place", F.lit(1)).withColumn("run", F.lit(2))).collect()}
    keep = {None if isinstance(c, tuple) else c: t for c, t in keep.items()}
    assert set(got) == set(keep) and None in keep
    equal = Counter(talks.values())
    for c, t in keep.items():
        chat = "".join(f"<|im_start|>{r or ''}\n{x or ''}<|im_end|>\n" for r, x in t)
        assert (got[c].n_turns, got[c].n_equal, got[c].chat) == (len(t), equal[t], chat)
    assert chats.format_chats(df.limit(0)).count() == 0


def test_chats_against_sql(spark):
    from workload.compare import differences

    import duckdb

    con = duckdb.connect()
    odd = spark.createDataFrame(turns(), "conv_id long, turn long, role string, text string").toPandas()
    con.execute("CREATE VIEW conversations AS SELECT * FROM odd")
    assert len(odd) and differences(chats.format_chats(spark.createDataFrame(turns(), "conv_id long, turn long, role string, text string")), con, chats.ORACLE) == []
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF}/conversations.parquet'")
    assert differences(queries.op1_chat_formatting(spark, SF), con, queries.ORACLES["op1_chat_formatting"]) == []


@pytest.mark.parametrize("name", ["op1_chat_formatting", "op2_mix_sources", "op8_quality_rules"])
def test_native_plans(spark, name):
    plan = queries.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))
