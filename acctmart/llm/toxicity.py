"""Toxicity by weak supervision (operator 7).

Many voters say of a text that it may be toxic: words of a public lexicon, words and word beginnings found in the labelled rows,
and patterns of writing. The given labels are one more voter, which speaks on the labelled texts only, and so is silence, that no voter
speaks. A generative model estimates by expectation and maximisation how often each of them speaks in toxic and in clean texts, the labels' own
accuracy among them, from how they agree over labelled and unlabelled texts, and how far voters that speak together say the same, so that a
correlated group doesn't count as many times as it has members. Its posteriors are the labels for a linear classifier over the
voters, which scores every whole text.

Learned from: rows whose ``crc32(doc_id as text) mod 4`` isn't 2, of the labelled ones the ``SAMPLE`` with the smallest hash and of the others the ``UNLABELLED``
with the smallest, equal texts once. These bounds are the only ones; they make what is sent to the driver, the different votes of the
sample with their counts, and the broadcast, its ids, bounded. Labels, language, source and id aren't inputs of a score. Scoring is one pass without a shuffle.

Defined results: null and empty texts get the score of a text on which no voter speaks. A null id is not held out and not learned
from; a null label isn't learned from; of several labels of a row the toxic one holds. Without labels the voters learn from
their agreement with the lexicon. Repeated rows are scored row by row; empty tables give empty results; a column with the name of an added one gives way.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acctmart.llm.common import add_columns, cut

#: Labelled and unlabelled rows learned from at most, and voters found in the labelled ones at most.
SAMPLE, UNLABELLED, FOUND = 20_000, 20_000, 400
#: What an unlabelled row counts in the model: so little that many unsure posteriors don't outvote the labels (chosen by
#: cross-validation over labelled rows learned from; a larger weight lost recall).
UNLABELLED_WEIGHT = 0.02
#: A found voter speaks in so many toxic texts at least, and in so many times the share of clean ones.
LEAST_TOXIC, LIFT = 3, 8.0
#: Lengths of word beginnings that can be voters.
PREFIXES = (4, 5, 6)
THRESHOLD = 0.3
#: How often a given label is thought to be right before the voters are heard, and how many rows that belief counts as.
GOLD, GOLD_WEIGHT = 0.98, 200.0
#: How often a lexicon word is thought to speak before any label is seen, and how often all are silent.
PRIOR_TOXIC, PRIOR_CLEAN, PRIOR_WEIGHT = 0.3, 0.002, 20.0
QUIET_TOXIC, QUIET_CLEAN = 0.2, 0.8
#: A public list of plain insults (fixed values).
LEXICON = (
    "asshole bastard bitch clown coward dirtbag disgusting dumb dumbass fool garbage idiot idiotic idiots imbecile "
    "jerk liar loser losers lowlife maggot moron morons moronic parasite pathetic scum scumbag shit stupid "
    "subhuman trash ugly useless vermin worthless "
    "abschaum arschloch dummkopf trottel vollidiot widerlich wertlos "
    "connard crétin débile dégoûtant imbécile ordure salaud "
    "basura cabrón estúpido gilipollas idiota imbécil inútil mierda"
).split()
#: Patterns of writing.
PATTERNS = {
    "shouting": r"(?:\b[^\W\d_a-zà-ÿ]{4,}\b\W*){5}",
    "exclaiming": r"!{3}",
    "stars in a word": r"\b[^\W\d_]+\*+[^\W\d_]*\b",
    "you are a": r"\b(?i:you(?:'re| are)|tu es|du bist|eres)\s+(?i:an?|ein|eine|un|une|una|such|so)\b",
}
_WORDS = re.compile(r"[^\W\d_]+")


class Voters:
    """Which voters speak on a text. Names are ``w:word``, ``p:beginning`` and ``r:pattern``."""

    def __init__(self, names: Iterable[str]):
        self.names = list(names)
        place = {n: k for k, n in enumerate(self.names)}
        self.words = {n[2:]: k for n, k in place.items() if n[:2] == "w:"}
        begins = {n[2:]: k for n, k in place.items() if n[:2] == "p:"}
        self.begins = [(size, some) for size in PREFIXES if (some := {b: k for b, k in begins.items() if len(b) == size})]
        self.patterns = [(re.compile(PATTERNS[n[2:]]), k) for n, k in place.items() if n[:2] == "r:"]

    def speaking(self, text: str | None) -> list[int]:
        if not text:
            return []
        found = set(_WORDS.findall(text.lower()))
        out = [self.words[w] for w in found & self.words.keys()]
        for size, some in self.begins:
            out += [some[b] for b in {w[:size] for w in found} & some.keys()]
        out += [k for pattern, k in self.patterns if pattern.search(text)]
        return sorted(out)


def held_out(doc_id: str = "doc_id") -> Column:
    rest = F.crc32(F.col(f"`{doc_id}`").cast("string").cast("binary")) % 4
    return F.coalesce(rest == 2, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, unlabelled: int = UNLABELLED) -> DataFrame:
    """(text, toxic) of the rows learned from, toxic null without a label; equal texts once."""
    labelled = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out())
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )
    others = (
        docs.filter(F.col("doc_id").isNotNull() & ~held_out())
        .select(F.col("doc_id").cast(labels.schema["doc_id"].dataType).alias("doc_id"))
        .join(labelled.select("doc_id"), "doc_id", "left_anti")
        .distinct()
    )

    def some(rows, n):
        return rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)

    known = some(labelled, sample).unionByName(some(others, unlabelled).withColumn("toxic", F.lit(None).cast("int")))
    # the ids are ``sample`` and ``unlabelled`` rows at most
    met = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").filter("text IS NOT NULL")
    return cut(
        met.groupBy(F.xxhash64("text").alias("h"), F.sha2("text", 256).alias("s"))
        .agg(F.first("text").alias("text"), F.max("toxic").alias("toxic"))
        .select("text", "toxic")
    )


def find_voters(rows: DataFrame, most: int = FOUND) -> list[str]:
    """Words and word beginnings that speak far more often in the toxic ones of the labelled texts, the best ``most`` of them."""
    rows = rows.filter("toxic IS NOT NULL")
    tokens = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0)))
    begins = [
        F.transform(F.filter("t", lambda w, n=n: F.char_length(w) >= n), lambda w, n=n: F.concat(F.lit("p:"), F.substring(w, 1, n)))
        for n in PREFIXES
    ]
    named = rows.select("toxic", tokens.alias("t")).select(
        "toxic", F.explode(F.array_distinct(F.concat(F.transform("t", lambda w: F.concat(F.lit("w:"), w)), *begins))).alias("name")
    )
    totals = rows.agg(F.sum("toxic").alias("toxic"), F.count("*").alias("n")).first()
    n_toxic, n_clean = (totals.toxic or 0), totals.n - (totals.toxic or 0)
    if not n_toxic or not n_clean:
        return []
    spoken = named.groupBy("name").agg(F.sum("toxic").alias("x"), F.count("*").alias("n")).filter(F.col("x") >= LEAST_TOXIC)
    toxic_rate, clean_rate = (F.col("x") + 0.5) / (n_toxic + 1), (F.col("n") - F.col("x") + 0.5) / (n_clean + 1)
    best = (
        spoken.filter(toxic_rate >= LIFT * clean_rate)
        .withColumn("gain", F.col("x") * F.log(toxic_rate / clean_rate))
        .orderBy(F.desc("gain"), "name")
        .limit(most)
    )
    return [r["name"] for r in best.select("name").collect()]


class LabelModel(NamedTuple):
    """What the label model found; rates are shares of toxic and of clean texts."""

    posterior: np.ndarray
    #: Each voter's log odds, its part in a correlated group counted, and those of a text on which none speaks.
    weights: np.ndarray
    bias: float
    #: How often each voter speaks in toxic and clean texts, and how much of its weight those that repeat it leave.
    speaks_toxic: np.ndarray
    speaks_clean: np.ndarray
    share: np.ndarray
    #: How often a given label is right on toxic and on clean texts.
    label_toxic: float
    label_clean: float


def _correlated(votes: np.ndarray, mass: np.ndarray) -> np.ndarray:
    """Correlations of the voters among rows of these masses; what chance alone may give is nought."""
    n = mass.sum()
    dev = (votes - votes.T @ mass / n) * np.sqrt(mass)[:, None]
    cov = dev.T @ dev / n
    scale = np.sqrt(np.maximum(np.diag(cov), 1e-9))
    alike = cov / scale / scale[:, None]
    alike = np.where(alike > max(0.1, 3 / np.sqrt(n)), np.clip(alike, 0, 1), 0.0)
    np.fill_diagonal(alike, 1.0)
    return alike


def label_model(
    votes: np.ndarray,
    gold: np.ndarray,
    prior: np.ndarray,
    times: np.ndarray | None = None,
    unlabelled_weight: float = UNLABELLED_WEIGHT,
    rounds: int = 12,
) -> LabelModel:
    """The generative model of ``votes`` (rows x voters of 0 and 1), ``gold`` (given labels, nan for none) and silence.

    A voter that doesn't speak abstains, and so does a label that isn't given. ``prior`` marks voters believed in from the start, ``times`` counts
    equal rows. The first estimate is that of the labelled rows and the priors, the later ones are of all rows, of which one without a label counts
    ``unlabelled_weight``.
    """
    given = ~np.isnan(gold)
    times = np.where(given, 1.0, unlabelled_weight) * (1.0 if times is None else times)
    said = np.where(given, gold, 0.0)
    quiet = votes.sum(axis=1) == 0
    strength = np.where(prior, PRIOR_WEIGHT, 1.0)
    p_toxic, p_clean = np.where(prior, PRIOR_TOXIC, 0.05), np.where(prior, PRIOR_CLEAN, 0.02)
    base = max(0.01, min(0.5, ((times * said).sum() + 1) / ((times * given).sum() + 10)))
    posterior = np.where(said == 1, GOLD, 1 - GOLD)
    mass = times * given
    for _ in range(rounds):
        m1, m0 = mass * posterior, mass * (1 - posterior)
        n1, n0 = m1.sum(), m0.sum()
        rate1 = (votes.T @ m1 + strength * p_toxic) / (n1 + strength)
        rate0 = (votes.T @ m0 + strength * p_clean) / (n0 + strength)
        still1 = (m1[quiet].sum() + PRIOR_WEIGHT * QUIET_TOXIC) / (n1 + PRIOR_WEIGHT)
        still0 = (m0[quiet].sum() + PRIOR_WEIGHT * QUIET_CLEAN) / (n0 + PRIOR_WEIGHT)
        right1 = ((m1 * said).sum() + GOLD_WEIGHT * GOLD) / (m1[given].sum() + GOLD_WEIGHT)
        right0 = ((m0 * (given - said)).sum() + GOLD_WEIGHT * GOLD) / (m0[given].sum() + GOLD_WEIGHT)
        # a voter shares its weight with those that repeat it
        share = 1.0 / _correlated(votes, m1).sum(axis=1) if n1 > 1 else np.ones(votes.shape[1])
        speak = share * np.log(rate1 / rate0)
        label = np.where(said == 1, np.log(right1 / (1 - right0)), np.log((1 - right1) / right0))
        odds = np.log(base / (1 - base)) + votes @ speak + quiet * np.log(still1 / still0) + given * label
        posterior = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        mass = times
    rest = ((times * posterior)[quiet].sum() + 1) / (times[quiet].sum() + 50)
    bias = min(np.log(base / (1 - base)), np.log(rest / (1 - rest)))
    return LabelModel(posterior, speak, float(bias), rate1, rate0, share, float(right1), float(right0))


def fit_linear(votes: np.ndarray, target: np.ndarray, times: np.ndarray, start: np.ndarray, bias: float, ridge: float = 0.3):
    """Logistic regression on soft labels of rows that count ``times`` each, by Newton steps, drawn towards ``start`` rather than nought."""
    x = np.hstack([votes, np.ones((len(votes), 1))])
    centre = np.append(start, bias)
    weights = centre.copy()
    penalty = np.append(np.full(len(start), ridge), 0.01)
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (times * (p - target)) + penalty * (weights - centre)
        curve = (x * (times * p * (1 - p))[:, None]).T @ x + np.diag(penalty + 1e-6)
        step = np.linalg.solve(curve, slope)
        weights -= step * min(1.0, 5.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-4:
            break
    return weights[:-1], weights[-1]


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, unlabelled: int = UNLABELLED) -> dict:
    """The voters' names, weights and the bias."""
    rows = training_rows(docs, labels, sample, unlabelled)
    names = list(dict.fromkeys([f"w:{w}" for w in LEXICON] + [f"r:{r}" for r in PATTERNS] + find_voters(rows)))

    def make():
        voters = Voters(names)
        return lambda texts: ([voters.speaking(t) for t in texts],)

    spoken = add_columns(rows, ["text"], "votes array<int>", make, ["toxic"]).groupBy("votes", "toxic").count().collect()
    # in one order, so that the sums are the same in every run
    spoken.sort(key=lambda r: (r.votes, -1 if r.toxic is None else r.toxic))
    votes = np.zeros((len(spoken), len(names)), np.float64)
    for i, row in enumerate(spoken):
        votes[i, row.votes] = 1.0
    gold = np.array([np.nan if r.toxic is None else r.toxic for r in spoken], np.float64)
    times = np.array([r["count"] for r in spoken], np.float64)
    trusted = np.array([n[2:] in LEXICON and n[:2] == "w:" for n in names])
    model = label_model(votes, gold, trusted, times)
    weights, bias = model.weights, model.bias
    if times[gold == 1].sum() >= 2 and times[gold == 0].sum() >= 2:
        counted = np.where(np.isnan(gold), UNLABELLED_WEIGHT, 1.0) * times
        weights, bias = fit_linear(votes, model.posterior, counted, weights, bias)
    return {"names": names, "weights": weights.tolist(), "bias": float(bias)}


def score(
    docs: DataFrame, model: dict, text: str = "text", threshold: float = THRESHOLD, keep: list[str] | None = None
) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from the threshold on)."""

    def make():
        voters, weights, bias = Voters(model["names"]), model["weights"], model["bias"]

        def run(texts):
            sums = np.array([bias + sum(weights[k] for k in voters.speaking(t)) for t in texts], float)
            scores = 1 / (1 + np.exp(-np.clip(sums, -30, 30)))
            return scores.tolist(), (scores >= threshold).astype(int).tolist()

        return run

    return add_columns(docs, [text], "score double, predicted int", make, keep)


def toxicity(docs: DataFrame, labels: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Train on a sample of ``docs`` and the labels of some, and score all of them."""
    return score(docs, train(docs, labels), keep=keep)
