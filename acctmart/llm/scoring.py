"""Language-model scores by deleted interpolation (operator 11).

The probability of a token is a mixture of 1/(V+1) and of the maximum-likelihood estimates after no word, one word, and so on
up to ``order`` - 1 words. The mixture weights depend on how often the longest context known from
training was seen, by powers of two, and are learned by expectation-maximisation: a tenth of the training texts is deleted from the
counts, and the weights are those under which the deleted tokens are most likely by the rest's counts. The scores then
use the counts of all training texts with these weights.

How it runs: documents are read in chunks (``runs``), the deleted ones in chunks of their own. A chunk's n-grams are made distinct with
their counts and sent as sorted runs of 64-bit hashes to buckets by the hash's first bits; a bucket adds up and answers each chunk
with the corpus counts of its n-grams. So an n-gram that is a third of all tokens is one entry per chunk. The number of buckets grows
with the number of tokens, so that a bucket holds about ``BUCKET_ENTRIES`` entries. Chunks and answers are written to the checkpoint
folder. Expectation-maximisation reads the estimates of the deleted tokens only, and one small table of sums a pass
reaches the driver. Nothing is capped, pruned or left out. Two n-grams are held for one if their 64-bit hashes agree: with
10^9 different ones, one in about 40 corpora has such a pair.

Defined results: words are ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case, and a text ends with one end token, which a
null or empty text has alone. Repeated rows are scored row by row, and learned from as often as they stand there. Rows whose ``train`` is null
are learned from. Without training rows the base score is 0 for every text and so is the score. A column with the name of an added one
gives way.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acctmart.llm.common import cut
from acctmart.llm.runs import ascending, chunked, gaps, pack, streamed, unpack

#: Words of the longest n-gram.
ORDER = 2
#: Entries of runs that meet in one bucket.
BUCKET_ENTRIES = 4_000_000
LEAST_BUCKETS = 16
#: Bytes of text in a chunk: the longer, the fewer n-grams stand in several.
SCORE_CHUNK = 16 << 20
#: Passes of expectation-maximisation, and the gain in log10 a token at which it ends.
PASSES, LEAST_GAIN = 15, 1e-4
ADDED = ("n_tokens", "n_known", "train_tokens", "base_score", "score")
#: Classes of contexts for each length of the longest known one: the binary digits of its count.
CLASSES = 64
_OUT, _KEPT, _DELETED = 0, 1, 2  # flags of documents
_END, _BEGIN = 0, 1  # numbers of marks in a chunk's vocabulary


def _mixed(x):
    """A 64-bit finaliser over unsigned numbers."""
    import numpy as np

    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _longer(context, word):
    """Hashes of n-grams from those of their contexts and last words."""
    import numpy as np

    return _mixed(context * np.uint64(0x9E3779B97F4A7C15) + word)


class _Numbers(dict):
    """Numbers of words in the order in which they come first."""

    def __missing__(self, word):
        self[word] = number = len(self)
        return number


#: The marks stand in the vocabulary as blanks, which are in no word.
_MARKS = (b"\n", b"\t")


def _state(texts: list[str | None], flags: list[int]) -> tuple[bytes, list[int]]:
    """Hashes of the texts' vocabulary, their words by number, their lengths and flags."""
    import numpy as np
    import xxhash

    numbers = _Numbers({mark: k for k, mark in enumerate(_MARKS)})
    ids, lengths = [], []
    for text in texts:
        words = (text or "").encode().lower().split()  # splits at space and the five ASCII control blanks
        ids.append(np.fromiter(map(numbers.__getitem__, words), "u4", len(words)))
        ids.append(np.array([_END], "u4"))
        lengths.append(len(words) + 1)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, numbers), "u8", len(numbers))
    return pack(hashes, np.concatenate(ids), np.array(lengths, "u4"), np.array(flags, "u1")), lengths


class Chunk:
    """The n-grams of a chunk by order: hashes of the distinct ones, ascending, and their numbers by token."""

    def __init__(self, state: bytes, order: int):
        import numpy as np

        hashes, ids, lengths, self.flags = unpack(state)
        self.lengths = lengths.astype("i8")
        self.starts = np.cumsum(self.lengths) - self.lengths
        ids, docs = ids.astype("i4"), len(lengths)
        by_hash = np.argsort(hashes)
        place = np.empty(len(hashes), "i4")
        place[by_hash] = np.arange(len(hashes))
        # of every order, the n-grams that end at each token, and those of nothing but begin marks
        self.keys, self.number, self.begin = [hashes[by_hash]], [place[ids]], [int(place[_BEGIN])]
        word, gram, only = hashes[ids], hashes[ids], hashes[_BEGIN]
        for _ in range(1, order):
            context = np.empty_like(gram)
            context[1:] = gram[:-1]
            context[self.starts] = only
            gram = _longer(context, word)
            only = _longer(np.array([only]), hashes[_BEGIN])[0]
            found, number = np.unique(np.append(gram, only), return_inverse=True)
            self.keys.append(found)
            self.number.append(number[:-1])
            self.begin.append(int(number[-1]))
        self.docs = docs

    def counts(self, flag: int) -> list:
        """By order, how often each distinct n-gram stands in documents with the flag."""
        import numpy as np

        wanted = np.repeat(self.flags == flag, self.lengths)
        all_of = []
        for keys, number, begin in zip(self.keys, self.number, self.begin):
            counts = np.bincount(number[wanted], minlength=len(keys))
            counts[begin] += int((self.flags == flag).sum())
            all_of.append(counts)
        return all_of

    def estimates(self, totals: list):
        """Of each token: class of its context, count, and estimates after one and more words."""
        import numpy as np

        count = [t[n] for t, n in zip(totals, self.number)]
        context, found = np.zeros(len(count[0]), "i8"), []
        for k in range(1, len(totals)):
            known = np.empty_like(count[0])
            known[1:] = count[k - 1][:-1]
            known[self.starts] = totals[k - 1][self.begin[k - 1]]
            digits = np.frexp(known.astype("f8"))[1].clip(0, CLASSES - 1)
            context = np.where(known > 0, CLASSES * k + digits, context)
            found.append(count[k] / np.maximum(known, 1))
        return context, count[0], found


def _requests(bits: int, order: int):
    """A unit's runs: by bucket, for each order the hashes, counts in kept and counts in deleted documents."""

    def run(rows):
        import numpy as np

        edges = np.arange(1, 1 << bits, dtype="u8") << np.uint64(64 - bits)
        for unit, state in rows:
            grams = Chunk(state, order)
            kept, deleted = grams.counts(_KEPT), grams.counts(_DELETED)
            cuts = [[0, *np.searchsorted(keys, edges).tolist(), len(keys)] for keys in grams.keys]
            for bucket in range(1 << bits):
                parts = []
                for k, cut_at in enumerate(cuts):
                    a, b = cut_at[bucket], cut_at[bucket + 1]
                    parts += [gaps(grams.keys[k][a:b]), kept[k][a:b], deleted[k][a:b]]
                yield unit, bucket, pack(*parts)

    return run


def _answers(rows):
    """Add up a bucket's runs; answer every unit, and tell the number of words known from training."""
    import numpy as np
    import xxhash

    begin = np.uint64(xxhash.xxh64_intdigest(_MARKS[_BEGIN]))

    def settle(bucket, units, runs):
        runs = list(map(unpack, runs))
        out = [[] for _ in runs]
        for k in range(0, len(runs[0]), 3):
            found, number = np.unique(np.concatenate([ascending(r[k]) for r in runs]), return_inverse=True)
            totals = [np.zeros(len(found), "i8") for _ in range(2)]
            for total, j in zip(totals, (k + 1, k + 2)):
                np.add.at(total, number, np.concatenate([r[j] for r in runs]).astype("i8"))
            if k == 0:
                yield -1, bucket, None, int(((totals[0] + totals[1] > 0) & (found != begin)).sum())
            at = 0
            for answer, run in zip(out, runs):
                part = number[at : at + len(run[k])]
                at += len(run[k])
                answer += [total[part] for total in totals]
        for unit, answer in zip(units, out):
            yield unit, bucket, pack(*answer), None

    now, units, runs = None, [], []
    for unit, bucket, run in rows:
        if bucket != now and runs:
            yield from settle(now, units, runs)
            units, runs = [], []
        now = bucket
        units.append(unit)
        runs.append(run)
    if runs:
        yield from settle(now, units, runs)


def _with_answers(rows, settle):
    """``settle(unit, state, totals)`` of every unit, from its state followed by its answers in the order of buckets.

    ``totals`` holds for each order the counts in kept and the counts in deleted documents.
    """
    import numpy as np

    def given(unit, state, answers):
        columns = [np.concatenate(c).astype("i8") for c in zip(*map(unpack, answers))]
        return settle(unit, state, list(zip(columns[::2], columns[1::2])))

    now, state, answers = None, None, []
    for unit, bucket, run in rows:
        if unit != now and now is not None:
            yield from given(now, state, answers)
        if unit != now:
            now, answers = unit, []
        if bucket == -1:
            state = run
        else:
            answers.append(run)
    if now is not None:
        yield from given(now, state, answers)


def _events(order: int):
    """Classes, counts and estimates of the tokens of deleted units, by the kept documents."""

    def settle(_, state, totals):
        context, c1, found = Chunk(state, order).estimates([kept for kept, _ in totals])
        yield (pack(context, c1, *(p.astype("f4") for p in found)),)

    return lambda rows: _with_answers(rows, settle)


def _shares(weights, context, p0: float, *found):
    """Shares of the estimates in each token's probability."""
    w = weights[context]
    return [w[:, 0] * p0, *(w[:, k + 1] * p for k, p in enumerate(found))]


def start_weights(order: int = ORDER):
    """Equal weights of the estimates that a context allows."""
    import numpy as np

    weights = np.zeros((CLASSES * order, order + 1))
    for level in range(order):
        weights[CLASSES * level : CLASSES * (level + 1), : level + 2] = 1 / (level + 2)
    return weights


def learn_weights(events: DataFrame, tokens: int, types: int, order: int = ORDER):
    """Weights by expectation-maximisation over the deleted tokens; ``tokens`` counts those that were kept."""
    import numpy as np

    start = start_weights(order)  # counts as one token more, so that no weight reaches zero
    weights, before = start.copy(), None
    sums = [f"s{k}" for k in range(order + 1)]
    columns = "context int, " + ", ".join(f"{c} double" for c in sums) + ", n long, gain double"
    p0 = 1 / (types + 1)
    for _ in range(PASSES):

        def expected(rows, weights=weights):
            total, n, gain = np.zeros_like(weights), np.zeros(len(weights), "i8"), np.zeros(len(weights))
            for (run,) in rows:
                context, c1, *found = unpack(run)
                shares = np.stack(_shares(weights, context, p0, c1 / max(tokens, 1), *found), axis=1)
                p = shares.sum(axis=1)
                shares /= p[:, None]
                for k in range(order + 1):
                    total[:, k] += np.bincount(context, shares[:, k], len(weights))
                n += np.bincount(context, minlength=len(weights))
                gain += np.bincount(context, np.log10(p), len(weights))
            for b in np.flatnonzero(n).tolist():
                yield b, *total[b].tolist(), int(n[b]), float(gain[b])

        by_class = streamed(events, expected, columns).groupBy("context")
        found = by_class.agg(*(F.sum(c).alias(c) for c in (*sums, "n", "gain"))).collect()  # one row a class
        if not found:
            break
        for r in found:
            weights[r.context] = (start[r.context] + [r[c] for c in sums]) / (r.n + 1)
        likely = sum(r.gain for r in found) / sum(r.n for r in found)
        if before is not None and likely - before < LEAST_GAIN:
            break
        before = likely
    # sums of floats differ in their last digits from run to run
    return np.array([[float(f"{w:.9g}") for w in row] for row in weights])


def _scores(weights, tokens: int, types: int, order: int):
    import numpy as np

    p0 = 1 / (types + 1)

    def settle(unit, state, totals):
        grams = Chunk(state, order)
        context, c1, found = grams.estimates([kept + deleted for kept, deleted in totals])
        p1 = c1 / tokens if tokens else np.full(len(c1), p0)
        p = np.log10(sum(_shares(weights, context, p0, p1, *found)))
        base = np.log10((c1 + 1) / (tokens + types + 1))
        sums = [np.add.reduceat(x, grams.starts).tolist() for x in ((c1 > 0).astype("i8"), base, p)]
        yield from zip([unit] * grams.docs, range(grams.docs), grams.lengths.tolist(), *sums)

    return lambda rows: _with_answers(rows, settle)


def lm_scores(
    docs: DataFrame,
    train: Column,
    deleted: Column | None = None,
    text: str = "text",
    keep: list[str] | None = None,
    order: int = ORDER,
    chunk_bytes: int = SCORE_CHUNK,
) -> DataFrame:
    """``docs`` with ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score``.

    The model learns from the rows where ``train`` holds; of these, the rows where ``deleted`` holds serve to learn the
    weights (by default a tenth of the texts, chosen by their content, so that exact copies are on one side).
    ``base_score`` is that of single words with one added to every count, ``score`` the model's log10 probability.
    """
    keep = [c for c in docs.columns if c not in ADDED] if keep is None else keep
    if deleted is None:
        deleted = F.pmod(F.xxhash64(F.col(f"`{text}`")), F.lit(10)) == 0
    flag = F.when(~F.coalesce(train, F.lit(True)), _OUT).when(deleted, _DELETED).otherwise(_KEPT)

    def make():
        def run(values):
            places, units, made = [None] * len(values[0]), [None] * len(values[0]), []
            for part, wanted in enumerate(((_OUT, _KEPT), (_DELETED,))):
                some = [k for k, f in enumerate(values[1]) if f in wanted]
                if some:
                    flags = [values[1][k] for k in some]
                    state, lengths = _state([values[0][k] for k in some], flags)
                    trained = sum(n for n, f in zip(lengths, flags) if f != _OUT)
                    made.append((part, state, sum(lengths), trained))
                    for at, k in enumerate(some):
                        places[k], units[k] = at, part
            return [units, places], made

        return run

    ddl = "part int, state binary, tokens long, trained long"
    read = cut(chunked(docs, [F.col(f"`{text}`"), flag], keep, "of_part int, of_place int", ddl, make, chunk_bytes))
    states = read.where("place is null").withColumn("unit", F.col("chunk") * 2 + F.col("part"))
    by_part = {r.part: r for r in states.groupBy("part").agg(F.sum("tokens").alias("tokens"), F.sum("trained").alias("trained")).collect()}
    tokens = sum(r.trained for r in by_part.values())
    kept = by_part[0].trained if 0 in by_part else 0
    entries = order * sum(r.tokens for r in by_part.values())
    bits = max(math.ceil(math.log2(max(entries / BUCKET_ENTRIES, 1))), int(math.log2(LEAST_BUCKETS)))
    asked = streamed(states.select("unit", "state"), _requests(bits, order), "unit long, bucket long, run binary")
    answered = cut(streamed(asked, _answers, "unit long, bucket long, run binary, types long", ["bucket"]))
    types = answered.agg(F.coalesce(F.sum("types"), F.lit(0))).first()[0]
    answers = answered.where("unit >= 0").select("unit", "bucket", "run")
    homes = states.select("unit", F.lit(-1).cast("long").alias("bucket"), F.col("state").alias("run"))
    only = lambda df: df.where(F.col("unit") % 2 == 1)
    events = cut(streamed(only(homes).union(only(answers)), _events(order), "run binary", ["unit"], ["bucket"]))
    weights = learn_weights(events, kept, types, order)
    ddl = "unit long, at int, n_tokens long, n_known long, base_score double, score double"
    scored = streamed(homes.union(answers), _scores(weights, tokens, types, order), ddl, ["unit"], ["bucket"])
    rows = read.where("place is not null").select(
        *[f"_{k}" for k in range(len(keep))],
        (F.col("chunk") * 2 + F.col("of_part")).alias("unit"),
        F.col("of_place").alias("at"),
    )
    joined = rows.join(scored, ["unit", "at"])
    named = [F.col(f"_{k}").alias(c) for k, c in enumerate(keep)]
    return joined.select(
        *named, "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"), "base_score", "score"
    )
