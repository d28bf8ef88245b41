"""Near duplicates by SetSketch registers (operator 5).

A document's set is its distinct five-word shingles. Each element is a Poisson process whose arrivals fall on the
registers at random, so that a register's first arrival over the set is exponential; a register holds
the logarithm (base ``BASE``) of that minimum, truncated to a byte. Arrivals come in ascending order, and those
beyond what any register can still use are never drawn: the cost per document is about that of its
shingles. Registers merge by maximum, and two sets agree in a register with a probability near their similarity.

1. Equal sets collapse to a class with the smallest doc_id, combined before the shuffle.
2. Bands of registers put classes into buckets. Each member of a bucket is paired with its hub, the smallest member:
   a number of pairs linear in the rows, whatever the size of a bucket.
3. A pair goes on unless its registers and set sizes make a similarity of the threshold or more implausible (by the ratio of likelihoods).
   What remains is verified on the full sets, and the links' components are found.
4. Buckets that still hold several components, and share members, make up groups. Each group is dealt into blocks, its largest
   component apart from the rest, and each two blocks but those of that component meet in a task, which estimates and verifies in the same way the pairs that aren't in one component yet, and returns the links that join
   components. So every pair of a bucket is either within one component or tested, and no pairs are emitted.

``BANDS`` and ``ROWS`` leave a pair at the threshold without a common bucket with probability (1 - 0.85^8)^40 < 4e-6.

Defined results: null and empty texts and texts without words have an empty set, link with nothing and are kept. Rows with one
doc_id are one document, linked if any of its texts is. Rows with a null doc_id have no component and are kept. Very long
texts are sketched whole. An empty table gives an empty result. Only the id and the text are read; other columns don't matter.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from acctmart.llm.common import add_columns, cut
from acctmart.llm.components import components
from acctmart.llm.pretokens import Memo

SHINGLE = 5
#: Links need 100 * intersection >= PERCENT * union.
PERCENT = 85
BANDS, ROWS = 40, 8
REGISTERS = BANDS * ROWS
#: Base and shift of the registers: with these a byte holds sets of one to some hundred thousand elements.
BASE, SHIFT = 1.1, 30.0
#: A pair is given up if the likelihood of the best similarity is so many times (as a logarithm) that of the threshold.
GIVE_UP = 16.0
#: Registers in which a pair at the threshold agrees at least, but for a chance below 1e-9.
LEAST_SAME = math.floor(REGISTERS * PERCENT / 100 - 6.5 * math.sqrt(REGISTERS * PERCENT / 100 * (1 - PERCENT / 100)))
#: Classes, and bytes of their texts, in a block of a group.
GROUP_ROWS, GROUP_BYTES = 512, 4_000_000
#: Word hashes in each of the two generations that a task remembers.
WORD_ENTRIES = 150_000

_M1, _M2, _STEP = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)
_FACTOR = np.uint64(0xD6E8FEB86659FD93)


def mixed(x: np.ndarray) -> np.ndarray:
    """A finaliser that spreads 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def word_hashes() -> Memo:
    import xxhash

    return Memo(xxhash.xxh3_64_intdigest, WORD_ENTRIES)


def shingle_set(text: str | None, memo: Memo) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's shingles."""
    # bytes.lower and bytes.split do just what is wanted: A-Z, and the six ASCII blanks
    found = (text or "").encode().lower().split()
    if not found:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(memo.__getitem__, found), np.uint64, len(found))
    width = min(SHINGLE, len(h))
    total = np.full(len(h) - width + 1, width, np.uint64)
    for k in range(width):
        total = total * _FACTOR + h[k : len(h) - width + 1 + k]
    return np.unique(mixed(total))


def similar(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether two full sets are as similar as a link needs."""
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 0 < 100 * both >= PERCENT * (len(x) + len(y) - both)


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """The registers of some non-empty sets, one row each."""
    m = REGISTERS
    sizes = np.array([len(s) for s in sets])
    minima = np.full(len(sets) * m, np.inf)
    owner = np.repeat(np.arange(len(sets)), sizes)
    state = np.concatenate(sets)
    # beyond this, an arrival is unlikely to be the first of any register; raised where that was wrong
    limit = (math.log(m) + 3.0) / sizes
    at = np.zeros(len(state))
    waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []

    def draw(owner, state, at):
        """The next arrival of each element: its new state, its time and its register."""
        state = state + _STEP
        first = mixed(state)
        second = mixed(first ^ _FACTOR)
        wait = -np.log(((second >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / m
        slot = ((first >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)
        return state, at + wait, owner * m + slot.astype(np.int64)

    state, at, slot = draw(owner, state, at)
    while True:
        while len(owner):
            inside = at <= limit[owner]
            if not inside.all():
                late = ~inside
                waiting.append((owner[late], state[late], at[late], slot[late]))
                owner, state, at, slot = owner[inside], state[inside], at[inside], slot[inside]
            np.minimum.at(minima, slot, at)
            state, at, slot = draw(owner, state, at)
        # a register is right once its minimum is within the limit
        short = (minima.reshape(-1, m).max(axis=1) > limit).nonzero()[0]
        if not len(short):
            break
        limit[short] *= 2
        back = np.zeros(len(sets), bool)
        back[short] = True
        owner, state, at, slot = (np.concatenate(x) for x in zip(*waiting))
        go = back[owner]
        waiting = [(owner[~go], state[~go], at[~go], slot[~go])]
        owner, state, at, slot = owner[go], state[go], at[go], slot[go]
    logs = np.floor(SHIFT - np.log(minima) / math.log(BASE))
    return np.clip(logs, 0, 255).astype(np.uint8).reshape(-1, m)


def sketch(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``n_shingles``, a ``digest`` of the set, and its ``registers`` (null for the empty set)."""

    def make():
        memo = word_hashes()

        def run(texts):
            sets = [shingle_set(t, memo) for t in texts]
            digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
            fresh = {d: s for d, s in zip(digests, sets) if len(s)}
            done: dict[bytes, bytes] = {}
            some: list[bytes] = []
            for d, s in fresh.items():
                some.append(d)
                if sum(len(fresh[x]) for x in some) > 100_000 or len(some) == 64:
                    done |= zip(some, map(bytes, registers([fresh[x] for x in some])))
                    some = []
            if some:
                done |= zip(some, map(bytes, registers([fresh[x] for x in some])))
            return [len(s) for s in sets], digests, [done.get(d) for d in digests]

        return run

    return add_columns(docs, [text], "n_shingles long, digest binary, registers binary", make, keep)


def plausible(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Whether each pair's registers and sizes leave a similarity of ``percent`` or more plausible.

    The similarity is estimated by the joint likelihood of the numbers of registers that are larger, smaller
    and equal, the sizes being known.
    """
    m = a.shape[1]
    more = (a > b).sum(axis=1)[:, None].astype(float)
    less = (a < b).sum(axis=1)[:, None].astype(float)
    same = m - more - less
    u = (n_a / (n_a + n_b))[:, None]
    v = 1.0 - u
    most = np.minimum(u / v, v / u)

    def p(x):
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / math.log(BASE)

    def likelihood(j):
        up, down = p(u - v * j), p(v - u * j)
        tiny = 1e-12
        return (
            more * np.log(np.maximum(up, tiny))
            + less * np.log(np.maximum(down, tiny))
            + same * np.log(np.maximum(1.0 - up - down, tiny))
        )

    steps = np.linspace(0.0, 1.0, 65)[None, :]
    least = percent / 100.0
    free = likelihood(steps * most).max(axis=1)
    high = likelihood(least + steps * np.maximum(most - least, 0.0)).max(axis=1)
    return (most[:, 0] >= least - 1e-9) & (free - high <= GIVE_UP)


def _estimated(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs (a, b) whose registers leave a link plausible."""
    sides = {
        k: classes.select(F.col("rep").alias(k), F.col("n_shingles").alias(f"n_{k}"), F.col("registers").alias(f"r_{k}"))
        for k in "ab"
    }
    known = pairs.join(sides["a"], "a").filter(F.col("r_a").isNotNull()).join(sides["b"], "b")

    def rows(column):
        return np.frombuffer(b"".join(column), np.uint8).reshape(len(column), -1)

    def make():
        def run(r_a, r_b, n_a, n_b):
            return (plausible(rows(r_a), rows(r_b), np.array(n_a, float), np.array(n_b, float)).tolist(),)

        return run

    judged = add_columns(known, ["r_a", "r_b", "n_a", "n_b"], "plausible boolean", make, ["a", "b"])
    return judged.filter("plausible").select("a", "b").distinct()


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs whose full sets are as similar as a link needs."""
    joined = pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("t_a")), "a").join(
        texts.select(F.col("doc_id").alias("b"), F.col("text").alias("t_b")), "b"
    )

    def make():
        memo = word_hashes()
        last: dict[str, tuple] = {"t": ("", np.empty(0, np.uint64))}

        def linked(t_a, t_b):
            if last["t"][0] != t_a:
                last["t"] = (t_a, shingle_set(t_a, memo))
            return similar(last["t"][1], shingle_set(t_b, memo))

        return lambda t_a, t_b: ([linked(x, y) for x, y in zip(t_a, t_b)],)

    return add_columns(joined, ["t_a", "t_b"], "linked boolean", make, ["a", "b"]).filter("linked").select("a", "b")


def _bands(classes: DataFrame) -> DataFrame:
    """A row (band, rep) for each band of each class, the band's registers hashed with its number."""
    keys = F.transform(
        F.sequence(F.lit(0), F.lit(BANDS - 1)),
        lambda k: F.xxhash64(k, F.substring(F.col("registers"), k * ROWS + 1, F.lit(ROWS))),
    )
    return classes.select("rep", F.explode(keys).alias("band"))


def _open_links(rows: pd.DataFrame) -> pd.DataFrame:
    """Links between different components in one or two blocks of a group; no more than connect them."""
    rows = rows.reset_index(drop=True)
    first = np.flatnonzero(rows["block"] == rows["lo"])
    other = first if (rows["lo"] == rows["hi"]).all() else np.flatnonzero(rows["block"] != rows["lo"])
    own = np.frombuffer(b"".join(rows["registers"]), np.uint8).reshape(len(rows), -1)
    sizes = rows["n_shingles"].to_numpy(float)
    reps, places = rows["rep"].to_numpy(), rows["component"].to_numpy()
    lead: dict[int, int] = {}
    memo, sets = word_hashes(), {}

    def root(x: int) -> int:
        while lead.setdefault(x, x) != x:
            lead[x] = lead[lead[x]]
            x = lead[x]
        return x

    def full(i: int) -> np.ndarray:
        if i not in sets:
            sets[i] = shingle_set(rows["text"][i], memo)
        return sets[i]

    found = []
    for start in range(0, len(first), 32):
        some = first[start : start + 32]
        # a pair at the threshold agrees in fewer registers with a chance below 1e-9
        same = (own[some][:, None, :] == own[other][None, :, :]).sum(axis=2)
        i, j = np.nonzero((same >= LEAST_SAME) & (places[some][:, None] != places[other][None, :]))
        i, j = some[i], other[j]
        i, j = i[reps[i] != reps[j]], j[reps[i] != reps[j]]
        if not len(i):
            continue
        go = plausible(own[i], own[j], sizes[i], sizes[j])
        for x, y in zip(i[go].tolist(), j[go].tolist()):
            if root(places[x]) != root(places[y]) and similar(full(x), full(y)):
                lead[root(places[x])] = root(places[y])
                found.append((min(reps[x], reps[y]), max(reps[x], reps[y])))
    return pd.DataFrame(found, columns=["a", "b"]).astype("int64")


def _meetings(groups: DataFrame, placed: DataFrame, classes: DataFrame, texts: DataFrame) -> DataFrame:
    """The classes of each group (rep, group), dealt into blocks, once for each other block that theirs has to meet.

    The classes of a group's largest component make blocks of their own, the first ones. These needn't meet each other, so that
    such a class is sent once for each block of the group's other classes, however large its component is.
    """
    members = groups.join(placed.select("rep", "component").distinct(), "rep")
    held = members.join(texts.select(F.col("doc_id").alias("rep"), F.octet_length("text").alias("bytes")), "rep")
    sizes = held.groupBy("group", "component").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"))

    def n_blocks(n, bytes_):
        return F.greatest(F.ceil(n / GROUP_ROWS), F.ceil(bytes_ / GROUP_BYTES), F.lit(1)).cast("int")

    blocks = (
        sizes.groupBy("group")
        .agg(F.max(F.struct("n", "component", "bytes")).alias("most"), F.sum("n").alias("n"), F.sum("bytes").alias("bytes"))
        .select(
            "group",
            F.col("most.component").alias("main"),
            n_blocks(F.col("most.n"), F.col("most.bytes")).alias("n_main"),
            n_blocks(F.col("n") - F.col("most.n"), F.col("bytes") - F.col("most.bytes")).alias("n_rest"),
        )
    )
    in_main = F.col("component") == F.col("main")
    dealt = members.join(blocks, "group").withColumn("in_main", in_main).withColumn(
        "block",
        F.when(in_main, F.pmod(F.xxhash64("rep"), F.col("n_main")))
        .otherwise(F.col("n_main") + F.pmod(F.xxhash64("rep"), F.col("n_rest")))
        .cast("int"),
    )
    whole = dealt.join(classes.select("rep", "n_shingles", "registers"), "rep").join(
        texts.withColumnRenamed("doc_id", "rep"), "rep"
    )
    others = F.sequence(F.when(F.col("in_main"), F.col("n_main")).otherwise(F.lit(0)), F.col("n_main") + F.col("n_rest") - 1)
    return whole.withColumn("other", F.explode(others)).select(
        "group", "block", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"),
        "rep", "component", "n_shingles", "registers", "text",
    )


def _open_groups(members: DataFrame, placed: DataFrame, classes: DataFrame, texts: DataFrame) -> DataFrame:
    """Links (a, b) that the hubs left out, between classes of buckets that hold several components.

    Buckets that share a member make up a group. A group's classes are dealt into blocks of bounded rows and bytes, and each two blocks that may
    hold different components meet in one task. So a group of any size is tested, whole, in bounded tasks, and each returns only links that join components.
    """
    several = (
        placed.groupBy("band")
        .agg(F.min("component").alias("low_component"), F.max("component").alias("high_component"))
        .filter("low_component <> high_component")
        .select("band")
    )
    edges = members.join(several, "band").filter("rep <> low").select("rep", "low").distinct()
    groups = cut(components(edges)).toDF("rep", "group")
    met = _meetings(groups, placed, classes, texts)
    return met.groupBy("group", "lo", "hi").applyInPandas(_open_links, "a long, b long")


def link_classes(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """(id, component) of the classes that link with others."""
    banded = _bands(classes)
    hubs = (
        banded.groupBy("band")
        .agg(F.min("rep").alias("low"), F.max("rep").alias("high"))
        .filter("low <> high")
        .drop("high")
    )
    members = cut(banded.join(hubs, "band"))
    texts = cut(
        docs.select("doc_id", "text").join(
            members.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi"
        )
    )
    pairs = members.filter("rep <> low").select(F.col("low").alias("a"), F.col("rep").alias("b")).distinct()
    links = cut(_verified(_estimated(pairs, classes), texts))
    first = cut(components(links))
    placed = cut(
        members.join(first.withColumnRenamed("id", "rep"), "rep", "left").select(
            "band", "rep", F.coalesce("component", "rep").alias("component")
        )
    )
    more = cut(_open_groups(members, placed, classes, texts))
    if more.isEmpty():
        return first
    # components of components: few edges between the roots found so far
    joined = (
        more.join(first.toDF("a", "ra"), "a", "left")
        .join(first.toDF("b", "rb"), "b", "left")
        .select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b"))
    )
    second = cut(components(joined)).toDF("component", "top")
    ids = first.union(second.select("component", "component")).distinct()
    return ids.join(second, "component", "left").select("id", F.coalesce("top", "component").alias("component"))


def _shared_ids(sketched: DataFrame) -> DataFrame | None:
    """The ids whose rows have several sets, if there are any."""
    several = (
        sketched.filter("doc_id IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.min("digest").alias("a"), F.max("digest").alias("b"))
        .filter("a <> b")
        .select("doc_id")
    )
    return None if several.isEmpty() else several


def _over_shared_ids(linked: DataFrame, several: DataFrame, sketched: DataFrame, classes: DataFrame) -> DataFrame:
    """(id, component) of the classes and ids that link, where the texts of one doc_id link as well.

    Each class of an id with several sets is joined with that id by a link.
    """
    owned = sketched.filter("n_shingles > 0").select("doc_id", "digest").join(several, "doc_id").distinct()
    shared = owned.join(classes.select("digest", "rep"), "digest").select(
        F.col("rep").alias("a"), F.col("doc_id").alias("b")
    )
    both = linked.toDF("b", "a").select("a", "b").union(shared)
    # an id that links with itself alone is no link, but its own component
    alone = shared.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    joined = cut(components(both))
    return joined.union(alone.join(joined.select("id"), "id", "left_anti"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id and kept."""
    docs = docs.select(F.col(f"`{doc_id}`").cast(T.LongType()).alias("doc_id"), F.col(f"`{text}`").alias("text"))
    sketched = cut(sketch(docs, keep=["doc_id"]))
    classes = cut(
        sketched.filter("n_shingles > 0")
        .groupBy("digest")
        .agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n_shingles"), F.first("registers").alias("registers"))
        .filter("rep IS NOT NULL")
    )
    linked, shared = link_classes(docs, classes), _shared_ids(sketched)
    found = linked if shared is None else _over_shared_ids(linked, shared, sketched, classes)
    named = classes.select("digest", "rep").join(found.toDF("rep", "component"), "rep", "left").select(
        "digest", F.coalesce("component", "rep").alias("component")
    )
    rows = sketched.select("doc_id", "n_shingles", "digest").join(named, "digest", "left")
    if shared is not None:
        # a row without words belongs to its document's component through the id
        rows = rows.join(found.toDF("doc_id", "by_id"), "doc_id", "left")
        rows = rows.withColumn("component", F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("by_id")))
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return (
        rows.select("doc_id", "n_shingles", own.alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )
