"""Chat formatting after a cumulative-snapshot collapse (operator 1), with DataFrame functions only.

A log that saves a conversation again after each turn holds every prefix of the longest version. Rolling hashes of turn
prefixes, one per turn, identify a conversation that is a prefix of a longer one: its full hash is the other's hash at its
length. Anti-joins leave the maximal conversations, one of each set of equal ones (the smallest id), and these are rendered.

The rolling hash is the exclusive or of two independent 64-bit hashes of (place, role, text). Turns are summed up in runs of
``RUN`` turns of a conversation, and then within a run, so a conversation of any length is spread over tasks. Prefixes and
full hashes are made distinct before they meet, combined before the shuffle: a very common first turn or conversation is one row.

Rendering gathers one conversation's turns, which are one value of the result. Turns stand in the order of ``turn`` (null first),
then role and text; their place in it counts, not the number. Defined results: repeated rows are turns of their own. A null
role or text differs from an empty one in comparing, and is rendered as empty. A row with a null conv_id is a
conversation of one turn; it has an id only if an equal one has. Rows of one conversation with equal or null ``turn`` are put in
order in one task. An empty table gives an empty result; other columns don't matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acctmart.llm.common import cut, meet

#: Turns that are summed up together.
RUN = 1000
#: How a turn is written: before the role, after it, and after the text.
OPEN, BETWEEN, CLOSE = "<|im_start|>", "\n", "<|im_end|>\n"


def _places(turns: DataFrame) -> DataFrame:
    """``turns`` with ``run`` and ``place``, its number from 1 in its conversation."""
    run = F.coalesce(F.floor(F.col("turn") / RUN), F.lit(-(1 << 62)))
    turns = turns.withColumn("run", run)
    sizes = turns.groupBy("conv_id", "run").agg(F.count("*").alias("n"))
    before = Window.partitionBy("conv_id").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("conv_id", "run", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    order = Window.partitionBy("conv_id", "run").orderBy("turn", "role", "text")
    numbered = turns.withColumn("k", F.row_number().over(order))
    return meet(numbered, starts, "conv_id", "run").withColumn("place", F.col("start") + F.col("k")).drop("k", "start")


def _hashes() -> list[Column]:
    parts = [F.col("place"), F.col("role").isNull(), F.col("role"), F.col("text").isNull(), F.col("text")]
    return [F.xxhash64(*parts).alias("h1"), F.xxhash64(F.lit("second"), *parts[::-1]).alias("h2")]


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv_id, place, p1, p2): the hash of the first ``place`` turns of each conversation."""
    hashed = cut(_places(turns).select("conv_id", "run", "place", *_hashes()))
    sums = hashed.groupBy("conv_id", "run").agg(F.bit_xor("h1").alias("r1"), F.bit_xor("h2").alias("r2"))
    earlier = Window.partitionBy("conv_id").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    carried = sums.select(
        "conv_id", "run", *[F.coalesce(F.bit_xor(f"r{k}").over(earlier), zero).alias(f"c{k}") for k in (1, 2)]
    )
    within = Window.partitionBy("conv_id", "run").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    rolled = hashed.select(
        "conv_id", "run", "place", *[F.bit_xor(f"h{k}").over(within).alias(f"s{k}") for k in (1, 2)]
    )
    return meet(rolled, carried, "conv_id", "run").select(
        "conv_id", "place", *[F.col(f"s{k}").bitwiseXOR(F.col(f"c{k}")).alias(f"p{k}") for k in (1, 2)]
    )


def maximal(turns: DataFrame) -> DataFrame:
    """(conv_id, n_turns, n_equal, only) of the conversations that are no prefix of a longer one, equal ones once.

    ``only`` is the turn of a conversation without id.
    """
    rolled = cut(prefixes(turns.filter("conv_id IS NOT NULL")))
    lengths = rolled.groupBy("conv_id").agg(F.max("place").alias("n_turns"))
    both = rolled.join(lengths, "conv_id")
    turn = F.struct("role", "text")
    single = turns.filter("conv_id IS NULL").withColumn("place", F.lit(1).cast("long"))
    single = single.select("place", *[h.alias(f"p{k}") for k, h in enumerate(_hashes(), 1)], turn.alias("only"))
    kind = single.schema["only"].dataType
    ends = both.filter("place = n_turns").select("place", "p1", "p2", "conv_id", F.lit(None).cast(kind).alias("only"))
    full = (
        ends.unionByName(single, allowMissingColumns=True)
        .groupBy("place", "p1", "p2")
        .agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_equal"), F.min("only").alias("only"))
    )
    inner = both.filter("place < n_turns").select("place", "p1", "p2").distinct()
    return full.join(inner, ["place", "p1", "p2"], "left_anti").select(
        "conv_id", F.col("place").alias("n_turns"), "n_equal", "only"
    )


def format_chats(
    turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """Per maximal conversation: conv_id, n_turns, n_equal (conversations equal to it, itself included) and ``chat``."""
    turns = turns.select(
        F.col(f"`{conv_id}`").alias("conv_id"),
        F.col(f"`{turn}`").cast("long").alias("turn"),
        F.col(f"`{role}`").cast("string").alias("role"),
        F.col(f"`{text}`").cast("string").alias("text"),
    )
    chosen = cut(maximal(turns))

    def shown(role: Column, text: Column) -> Column:
        blank = F.lit("")
        return F.concat(F.lit(OPEN), F.coalesce(role, blank), F.lit(BETWEEN), F.coalesce(text, blank), F.lit(CLOSE))

    written = shown(F.col("role"), F.col("text"))
    lines = F.transform(
        F.sort_array(F.collect_list(F.struct("turn", "role", "text", written.alias("written")))), lambda t: t["written"]
    )
    named = chosen.filter("conv_id IS NOT NULL").drop("only")
    rendered = (
        turns.join(named, "conv_id").groupBy("conv_id", "n_turns", "n_equal").agg(F.array_join(lines, "").alias("chat"))
    )
    alone = chosen.filter("conv_id IS NULL").select(
        "conv_id", "n_turns", "n_equal", shown(F.col("only.role"), F.col("only.text")).alias("chat")
    )
    return rendered.unionByName(alone)


#: The same by whole turn lists: a conversation stays if none longer starts with it, and it is the first of its equals.
ORACLE = """
WITH lists AS (
    SELECT conv_id, alone, CAST(count(*) AS BIGINT) AS n_turns,
           list({'r': role, 't': text} ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS turns,
           string_agg('<|im_start|>' || coalesce(role, '') || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10), ''
                      ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS chat
    FROM (SELECT *, CASE WHEN conv_id IS NULL THEN row_number() OVER () END AS alone FROM conversations)
    GROUP BY conv_id, alone
), firsts AS (
    SELECT min(conv_id) AS conv_id, CAST(count(*) AS BIGINT) AS n_equal, n_turns, turns, chat
    FROM lists GROUP BY n_turns, turns, chat
), inner_ AS (
    SELECT DISTINCT list_slice(f.turns, 1, k) AS turns FROM firsts f, LATERAL (SELECT unnest(range(1, f.n_turns)) AS k)
)
SELECT f.conv_id, f.n_turns, f.n_equal, f.chat
FROM firsts f WHERE f.turns NOT IN (SELECT turns FROM inner_)
"""
