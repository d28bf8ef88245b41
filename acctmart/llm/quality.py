"""Quality rules (operator 8): a table of thresholds compiled into one Spark projection.

Every metric is a built-in expression over the whole text, and every rule bounds one metric; the
verdict is their conjunction. There is no user function and no shuffle.

The rules cover English, German, French and Spanish, the languages of ``STOP_WORDS``: a text without any
of these words isn't kept, so texts in other languages need lists of their own (``stop_words``). One listed word is
enough whatever the length of the text, as a share of the different words would fall with it.

Defined results: a null or empty text has no words and fails the base rules; a null never reaches
the verdict. Repeated rows are judged row by row. Other columns pass through untouched unless they
have the name of a metric or a verdict, which then replaces them.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acctmart.llm.common import WORD, let, words

#: Symbols that count as such.
SYMBOLS = "#*$%&|<>"
#: What is counted in a text.
COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_exclamations",
    "n_different", "n_stop",
)
#: Words in a window that is looked for again in the same text.
WINDOW = 8
#: Beyond so many words a text needs no more different ones.
VARIETY_WORDS = 200
#: Common words of the languages that the rules know.
STOP_WORDS = {
    "en": "the of and to a in is that for it was on with be as this at by are from",
    "de": "der die und in zu den von das mit sich des auf für ist im nicht dem ein eine als",
    "fr": "de la le et les des en un du une que est pour au dans sur qui par pas avec",
    "es": "de la que el en los y se del un por las con una no su para lo al es",
}


@dataclass(frozen=True)
class Rule:
    """A document passes where ``low <= metric <= high``; a bound of None doesn't bind."""

    name: str
    metric: str
    low: float | None = None
    high: float | None = None


#: The base rules: long enough, and little of the text said twice.
BASE = (
    Rule("too few words", "n_words", low=20),
    Rule("repeated passages", "repeat_pct", high=30),
)
#: The method's own rules.
RULES = (
    Rule("mean word length", "mean_word_chars", low=1.5, high=20),
    Rule("symbols to words", "symbol_ratio", high=0.25),
    Rule("exclamations to words", "exclamation_ratio", high=0.3),
    Rule("different words to words", "variety", low=0.4),
    Rule("lines seen before", "dup_line_ratio", high=0.6),
    Rule("different common words", "n_stop", low=1),
)


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole == 0, F.lit(0.0)).otherwise(part / whole)


def _count(text: Column, characters: str) -> Column:
    """How often any of some ASCII characters occurs."""
    gone = [F.octet_length(text) - F.octet_length(F.replace(text, F.lit(c))) for c in characters]
    return reduce(lambda a, b: a + b, gone)


def _pairs(hashes: Column, apart: int) -> Column:
    """For each place the hash of what starts there and what starts ``apart`` places on."""
    rest = F.slice(hashes, apart + 1, F.greatest(F.size(hashes) - apart, F.lit(0)))
    both = F.zip_with(hashes, rest, lambda a, b: F.xxhash64(a, b))
    return F.slice(both, 1, F.greatest(F.size(hashes) - apart, F.lit(0)))


def _covered(sorted_pairs: Column) -> Column:
    """Words covered by the windows whose hash is that of a neighbour in the sorted order."""

    def twice(x: Column, k: Column) -> Column:
        before = F.try_element_at(sorted_pairs, F.when(k > 0, k).otherwise(F.lit(-1)))
        after = F.try_element_at(sorted_pairs, k + 2)
        return ((k > 0) & (before["h"] == x["h"])) | F.coalesce(after["h"] == x["h"], F.lit(False))

    def total(at: Column) -> Column:
        gaps = F.transform(
            at, lambda i, k: F.least(F.lit(WINDOW), F.coalesce(F.try_element_at(at, k + 2) - i, F.lit(WINDOW)))
        )
        return F.aggregate(gaps, F.lit(0), lambda sum_, gap: sum_ + gap)

    return let(F.sort_array(F.transform(F.filter(sorted_pairs, twice), lambda x: x["i"])), total)


def _repeat_words(hashes: Column) -> Column:
    """Words inside a window of eight that occurs more than once in the text, the first time included.

    Windows are compared by 64-bit hashes, made of those of two halves. A window of eight repeats
    only if its first four words do, so most texts are done when the hashes of four all differ; then
    those of eight are tried. Only where these repeat are they sorted with their places: a window
    repeats if its neighbour is equal, and covers the words up to the next repeated one, eight at most.
    """

    def differ(a: Column) -> Column:
        return F.size(F.array_distinct(a)) == F.size(a)

    def covered(eight: Column) -> Column:
        placed = F.transform(eight, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        return F.when(differ(eight), F.lit(0)).otherwise(let(F.sort_array(placed), _covered))

    def of_four(four: Column) -> Column:
        return F.when(differ(four), F.lit(0)).otherwise(let(_pairs(four, 4), covered))

    fours = let(_pairs(hashes, 1), lambda two: _pairs(two, 2))
    return F.when(F.size(hashes) <= WINDOW, F.lit(0)).otherwise(let(fours, of_four))


def compile_rules(rules: tuple[Rule, ...]) -> Column:
    """One boolean expression for a table of thresholds."""
    parts = []
    for rule in rules:
        if rule.low is not None:
            parts.append(F.col(rule.metric) >= F.lit(rule.low))
        if rule.high is not None:
            parts.append(F.col(rule.metric) <= F.lit(rule.high))
    return reduce(lambda a, b: a & b, parts, F.lit(True))


def quality(
    docs: DataFrame,
    text: str = "text",
    base: tuple[Rule, ...] = BASE,
    rules: tuple[Rule, ...] = RULES,
    stop_words: dict[str, str] = STOP_WORDS,
) -> DataFrame:
    """All rows and columns of ``docs`` with metrics, ``base_failed`` and ``kept``."""
    body = F.coalesce(F.col(text), F.lit(""))
    listed = {w for line in stop_words.values() for w in line.split()}
    common = F.array(*[F.xxhash64(F.lit(w)) for w in sorted(listed | {w.capitalize() for w in listed})])
    ws, hashes, lines, n = F.col("_words"), F.col("_hashes"), F.col("_lines"), F.col("n_words")
    measured = (
        docs.withColumns(
            {
                "_words": words(F.col(text)),
                "_lines": F.filter(F.split(body, "\n"), lambda line: line.rlike(WORD)),
            }
        )
        .withColumn("_hashes", F.transform(ws, lambda w: F.xxhash64(w)))
        .withColumn(
            "_measured",
            F.struct(
                F.size(ws).cast("long").alias("n_words"),
                F.char_length(F.array_join(ws, "")).cast("long").alias("word_chars"),
                _count(body, SYMBOLS).cast("long").alias("n_symbols"),
                (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
                _repeat_words(hashes).cast("long").alias("n_repeat_words"),
                F.size(lines).cast("long").alias("n_lines"),
                _count(body, "!").cast("long").alias("n_exclamations"),
                F.size(F.array_distinct(hashes)).cast("long").alias("n_different"),
                F.size(F.array_intersect(hashes, common)).cast("long").alias("n_stop"),
            ),
        )
        .drop("_words", "_lines", "_hashes")
        # a generator of one row each: filters on the verdict stay above it, so nothing is measured twice
        .withColumn("_measured", F.explode(F.array("_measured")))
    )
    counts = {name: F.col(f"_measured.{name}") for name in COUNTS}
    return (
        measured.withColumns(counts)
        .drop("_measured")
        .withColumns(
            {
                "mean_word_chars": _ratio(F.col("word_chars"), n),
                "symbol_ratio": _ratio(F.col("n_symbols"), n),
                "repeat_pct": _ratio(100 * F.col("n_repeat_words"), n),
                "exclamation_ratio": _ratio(F.col("n_exclamations"), n),
                "variety": _ratio(F.col("n_different"), F.least(n, F.lit(VARIETY_WORDS))),
                "dup_line_ratio": _ratio(F.col("n_dup_lines"), F.col("n_lines")),
                "stop_ratio": _ratio(F.col("n_stop"), F.col("n_different")),
            }
        )
        .withColumn("base_failed", ~compile_rules(base))
        .withColumn("kept", ~F.col("base_failed") & compile_rules(rules))
    )


def _sql_rules(rules: tuple[Rule, ...]) -> str:
    parts = [f"{r.metric} >= {r.low}" for r in rules if r.low is not None]
    parts += [f"{r.metric} <= {r.high}" for r in rules if r.high is not None]
    return " AND ".join(parts)


_COMMON = sorted({w for line in STOP_WORDS.values() for w in line.split()})
#: The same by lists and by rows of windows compared as text.
ORACLE = rf"""
WITH split AS (
  SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS body,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), windows AS (
  SELECT k, unnest(list_transform(range(1, len(ws) - 6), lambda i: {{'i': i, 'w': list_slice(ws, i, i + 7)}})) AS x
  FROM split
), twice AS (
  SELECT k, x.i AS i FROM windows QUALIFY count(*) OVER (PARTITION BY k, x.w) > 1
), covered AS (
  SELECT k, count(DISTINCT p) AS n FROM (SELECT k, unnest(range(i, i + 8)) AS p FROM twice) GROUP BY k
), counted AS (
  SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(array_to_string(ws, '')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(body, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
         len(lines) AS n_lines, len(regexp_extract_all(body, '!')) AS n_exclamations, len(list_distinct(ws)) AS n_different,
         len(list_intersect(list_distinct(ws), {_COMMON + [w.capitalize() for w in _COMMON]})) AS n_stop
  FROM split LEFT JOIN covered USING (k)
), rated AS (
  SELECT *, CASE WHEN n_words = 0 THEN 0 ELSE word_chars / n_words END AS mean_word_chars,
         CASE WHEN n_words = 0 THEN 0 ELSE n_symbols / n_words END AS symbol_ratio,
         CASE WHEN n_words = 0 THEN 0 ELSE 100 * n_repeat_words / n_words END AS repeat_pct,
         CASE WHEN n_words = 0 THEN 0 ELSE n_exclamations / n_words END AS exclamation_ratio,
         CASE WHEN n_words = 0 THEN 0 ELSE n_different / least(n_words, {VARIETY_WORDS}) END AS variety,
         CASE WHEN n_lines = 0 THEN 0 ELSE n_dup_lines / n_lines END AS dup_line_ratio,
         CASE WHEN n_different = 0 THEN 0 ELSE n_stop / n_different END AS stop_ratio
  FROM counted
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, NOT ({_sql_rules(BASE)}) AS base_failed,
       {_sql_rules(BASE)} AND {_sql_rules(RULES)} AS kept
FROM rated
"""
