"""Mixing sources to target weights (operator 2), with DataFrame functions only.

Documents fall into blocks per source by a hash of their id. A source whose target is T words of its S is
passed over T div S times in full; of the last pass it gives blocks in a permuted order up to its target, and of
the block in which the target falls, documents in a permuted order as far as they fit; what is left then goes to the documents of the next
blocks that fit into it, in rounds. So a document is taken whole, zero to ``cap`` times, and a source's words miss its target by less than
the smallest document left out of its last pass (all rows of one id in a source counting as one).

The blocks taken are dealt to the output shards by a multivariate-hypergeometric splitting tree: a node splits its exact
block counts per source between its halves as if all its blocks were shuffled (selection sampling on the counts), down to the
shards. Each shard then draws its own run of each source's permuted blocks, so that no block is drawn twice, and orders its
documents by a hash.

Every choice is a hash of ids and the seed: reruns agree. Shuffled are sizes per block, then the rows once, to meet their
block's draws; a block has a bounded share of its source, so a hot source is spread over its blocks. What a single task
folds are block counts (at most ``most_blocks`` times the passes per source), and one block's documents, as (hash, size).

Defined results: null and empty texts have size 0 and don't count. A null source is a source of its own, the last. Rows that
repeat an id in a source are taken or left together. A source of size 0 has target 0. An empty table gives an empty result. Other
columns pass through; a column with the name of an added one gives way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acctmart.llm.common import cut, let, meet, words
from acctmart.operators.joins import fits_broadcast

#: Weights of the sources in their order, repeated.
WEIGHTS = (3, 1, 2)
#: Blocks of a source are as many as make its documents ``BLOCK_DOCS`` to a block, within a bound: beyond it blocks grow.
#: The mix's size as a share of all words, and the most times a source is used.
SHARE, CAP = 1.5, 2.0
BLOCK_DOCS, MOST_BLOCKS, SHARDS, SEED = 500, 65_536, 64, 7


def _targets(sizes: DataFrame, weights: tuple[int, ...], share: float, cap: float) -> DataFrame:
    """Per source: source_size, target. ``sizes`` has one row (source, source_size) per source.

    Shares by weight stop at ``cap`` times the size; what is above goes to the rest by weight. In the order of cap
    to weight, a source is capped if the level of those from it on, after all before took their caps, is above its own.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    place = F.row_number().over(by_name) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    everything = Window.partitionBy()
    rising = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    onward = rising.rowsBetween(0, Window.unboundedFollowing)
    return (
        sizes.withColumn("weight", weight)
        .withColumn("most", F.lit(cap) * F.col("source_size"))
        .withColumn("ratio", F.col("most") / F.col("weight"))
        .withColumn("total", F.lit(share) * F.sum("source_size").over(everything))
        .withColumn(
            "level",
            (F.col("total") - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / F.sum("weight").over(onward),
        )
        .withColumn("capped", F.col("level") > F.col("ratio"))
        .withColumn("shared", F.min_by(F.when(~F.col("capped"), F.col("level")), F.when(~F.col("capped"), F.col("ratio"))).over(everything))
        .withColumn(
            "target",
            F.when(F.col("capped"), F.col("most")).otherwise(F.least("most", F.col("shared") * F.col("weight"))),
        )
        .select("source", "source_size", "target")
    )


def _chance(*of: Column) -> Column:
    """A number in [0, 1) from a hash."""
    return F.shiftrightunsigned(F.xxhash64(*of), 11).cast("double") / F.lit(float(1 << 53))


def _left_counts(seed: int) -> Column:
    """For a node's ``quotas``: how many blocks of each source its left half takes, ``need`` in all.

    Selection sampling: a block goes left with the chance of places left over blocks left. So the counts
    have the multivariate hypergeometric distribution, and their sum is exact.
    """

    def one(node: Column, source: Column) -> Column:
        steps = F.when(source["q"] > 0, F.sequence(F.lit(1).cast("long"), source["q"])).otherwise(
            F.array().cast("array<bigint>")
        )

        def step(state: Column, i: Column) -> Column:
            chance = _chance(F.lit(seed), F.col("node"), source["k"], i)
            took = F.when(chance * state["rest"] < state["need"], F.lit(1).cast("long")).otherwise(F.lit(0).cast("long"))
            return let(
                took,
                lambda t: F.struct(
                    (state["need"] - t).alias("need"),
                    (state["rest"] - F.lit(1).cast("long")).alias("rest"),
                    (state["got"] + t).alias("got"),
                ),
            )

        start = F.struct(node["need"].alias("need"), node["rest"].alias("rest"), F.lit(0).cast("long").alias("got"))
        done = F.aggregate(steps, start, step)
        return let(
            done,
            lambda d: F.struct(
                d["need"].alias("need"), d["rest"].alias("rest"), F.concat(node["out"], F.array(d["got"])).alias("out")
            ),
        )

    begin = F.struct(
        F.col("need").alias("need"), F.col("rest").alias("rest"), F.array().cast("array<bigint>").alias("out")
    )
    return F.aggregate("quotas", begin, one, lambda s: s["out"])


def shard_quotas(counts: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """(shard, source, quota) from (source, blocks): the splitting tree, one level per halving of the shards."""
    listed = counts.agg(F.array_sort(F.collect_list(F.struct("source", F.col("blocks").cast("long").alias("q")))).alias("s"))
    nodes = listed.select(
        F.lit(1).cast("long").alias("node"),
        F.lit(0).alias("first"),
        F.lit(shards).alias("width"),
        F.transform("s", lambda x, k: F.struct(x["source"].alias("source"), k.alias("k"), x["q"].alias("q"))).alias("quotas"),
    )
    width = shards
    while width > 1:
        rest = F.aggregate("quotas", F.lit(0).cast("long"), lambda t, x: t + x["q"])
        half = F.floor(F.col("width") / 2).cast("int")
        split = (
            nodes.withColumn("rest", rest)
            .withColumn("need", F.floor(F.col("rest") * half / F.col("width")).cast("long"))
            .withColumn("left", _left_counts(seed))
        )

        def side(of) -> Column:
            return F.zip_with(
                "quotas", "left", lambda x, n: F.struct(x["source"].alias("source"), x["k"].alias("k"), of(x["q"], n).alias("q"))
            )

        lower = F.struct(
            (F.col("node") * 2).alias("node"), F.col("first"), half.alias("width"), side(lambda q, n: n).alias("quotas")
        )
        upper = F.struct(
            (F.col("node") * 2 + 1).alias("node"),
            (F.col("first") + half).alias("first"),
            (F.col("width") - half).alias("width"),
            side(lambda q, n: q - n).alias("quotas"),
        )
        whole = F.struct("node", "first", "width", "quotas")
        parts = F.when(F.col("width") > 1, F.array(lower, upper)).otherwise(F.array(whole))
        nodes = split.select(F.explode(parts).alias("n")).select("n.*")
        width -= width // 2
    return nodes.select(F.col("first").alias("shard"), F.explode("quotas").alias("x")).select(
        "shard", F.col("x.source").alias("source"), F.col("x.q").alias("quota")
    )


def _fitting(docs: Column, left: Column) -> Column:
    """Of (lot, size), in the order of lots, those that fit into what is left after those before; and what is left at the end."""

    def step(state: Column, doc: Column) -> Column:
        fits = (doc["size"] > 0) & (doc["size"] <= state["left"])
        return F.struct(
            F.when(fits, state["left"] - doc["size"]).otherwise(state["left"]).alias("left"),
            F.when(fits, F.concat(state["lots"], F.array(doc["lot"]))).otherwise(state["lots"]).alias("lots"),
        )

    start = F.struct(left.cast("double").alias("left"), F.array().cast("array<bigint>").alias("lots"))
    return F.aggregate(F.sort_array(docs), start, step)


def _fill(docs: DataFrame) -> DataFrame:
    """(source, block, turn, rest, lots) from (source, block, turn, left, lot, size): the lots of a block that fit into its left."""
    return (
        docs.groupBy("source", "block", "turn", "left")
        .agg(F.collect_list(F.struct("lot", "size")).alias("docs"))
        .withColumn("fit", _fitting(F.col("docs"), F.col("left")))
        .select("source", "block", "turn", F.col("fit.left").alias("rest"), F.col("fit.lots").alias("lots"))
    )


def _fill_on(first: DataFrame, lots: DataFrame) -> DataFrame:
    """``first``, the blocks in which the targets fall, and the later blocks with lots that fit into what is left.

    ``lots`` has (source, block, turn, lot, size) of the later blocks. A round takes, of the lots that fit into the rest by themselves, all of the
    first blocks as far as their sum fits, and of the block after these as many as fit; the next round goes on behind it with what is
    left. A task folds the lots of one block.
    """
    filled = first
    ends = first.select("source", F.col("turn").alias("after"), "rest")
    fits = (F.col("turn") > F.col("after")) & (F.col("size") > 0) & (F.col("size") <= F.col("rest"))
    lots = cut(meet(lots, ends, "source").filter(fits).drop("after", "rest"))
    before = Window.partitionBy("source").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    while not lots.isEmpty():
        open_ = meet(lots, ends, "source").filter(fits)
        sums = open_.groupBy("source", "block", "turn", "rest").agg(F.sum("size").alias("words"))
        left = F.col("rest") - F.coalesce(F.sum("words").over(before), F.lit(0))
        # of sums that only rise, those beyond the first one that doesn't fit have nothing left
        some = sums.withColumn("left", left).filter("left > 0").select("source", "block", "left")
        got = cut(_fill(meet(open_.drop("after", "rest"), some, "source", "block")))
        if got.isEmpty():
            break
        filled = filled.unionByName(got)
        ends = cut(got.groupBy("source").agg(F.max("turn").alias("after"), F.max_by("rest", "turn").alias("rest")))
    return filled


def draws(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    cap: float = CAP,
    block_docs: int = BLOCK_DOCS,
    most_blocks: int = MOST_BLOCKS,
    shards: int = SHARDS,
    seed: int = SEED,
    keep: list[str] | None = None,
) -> DataFrame:
    """``docs`` with size, source_size, target and ``draws``: an array of (pass, shard, place), one for each time it is taken.

    ``place`` orders the documents within their shard.
    """
    added = {"size", "source_size", "target", "draws", "_source", "_lot", "_block", "_passes", "_drawn", "_lots", "_blocks"}
    carried = [c for c in (docs.columns if keep is None else keep) if c not in added]
    size = F.size(words(F.col(f"`{text}`"))).cast("long")
    lot = F.xxhash64(F.lit(seed), F.col(f"`{doc_id}`"))
    rows = docs.select(
        *[F.col(f"`{c}`") for c in carried], F.col(f"`{source}`").alias("_source"), lot.alias("_lot"), size.alias("size")
    )
    if text in carried:
        sized = cut(rows.select("_source", "_lot", "size"))
    else:
        sized = rows = cut(rows)  # the sizes are all that is left of the texts
    blocks = F.least(F.ceil(F.count("*") / block_docs), F.lit(most_blocks)).cast("long")
    blocks = cut(sized.groupBy("_source").agg(blocks.alias("_blocks")))
    if fits_broadcast(blocks)[0]:
        blocks = F.broadcast(blocks)
    block = F.pmod(F.xxhash64(F.lit("block"), F.col("_lot")), F.col("_blocks"))
    rows = meet(rows, blocks, "_source").withColumn("_block", block).drop("_blocks")
    sized = meet(sized, blocks, "_source").select(
        F.col("_source").alias("source"), block.alias("block"), F.col("_lot").alias("lot"), "size"
    )
    per_block = cut(sized.groupBy("source", "block").agg(F.sum("size").alias("words")))
    totals = per_block.groupBy("source").agg(F.sum("words").alias("source_size"))
    targets = cut(_targets(totals, weights, share, cap))
    order = Window.partitionBy("source").orderBy(F.xxhash64(F.lit(seed), F.lit("last pass"), "block"), "block")
    last = (
        meet(per_block, targets, "source")
        .withColumn("passes", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int"))
        .withColumn("left", F.col("target") - F.col("passes") * F.col("source_size"))
        .withColumn("left", F.col("left") - F.coalesce(F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("turn", F.row_number().over(order))
        .withColumn("part", F.when(F.col("words") <= F.col("left"), "all").when(F.col("left") > 0, "some").otherwise("none"))
    )
    last = cut(last)
    def lots_of(chosen: DataFrame) -> DataFrame:
        names = chosen.columns
        return meet(sized, chosen, "source", "block").groupBy(*names, "lot").agg(F.sum("size").alias("size"))

    first = cut(_fill(lots_of(last.filter("part = 'some'").select("source", "block", "turn", "left"))))
    later = lots_of(last.filter("part = 'none' AND left < 0").select("source", "block", "turn"))
    fitting = _fill_on(first, later).filter(F.size("lots") > 0).select("source", "block", "lots")
    last = meet(last.drop("turn"), fitting, "source", "block", how="left")
    # a block in which nothing fits isn't drawn in the last pass
    last = cut(last.withColumn("part", F.when(F.col("lots").isNotNull(), "some").when(F.col("part") == "all", "all").otherwise("none")))
    # a unit is one drawing of a block; each source's units stand in a permuted order, pass by pass
    times = F.col("passes") + (F.col("part") != "none").cast("int")
    passes = F.when(times > 0, F.sequence(F.lit(0), times - 1))
    units = last.select("source", "block", F.explode(passes).alias("pass"))
    turn = Window.partitionBy("source").orderBy("pass", F.xxhash64(F.lit(seed), F.lit("turn"), "pass", "block"), "block")
    units = cut(units.withColumn("turn", F.row_number().over(turn) - 1))
    quotas = shard_quotas(units.groupBy("source").agg(F.count("*").alias("blocks")), shards, seed)
    ends = (
        quotas.groupBy("source")
        .agg(F.array_sort(F.collect_list(F.struct("shard", "quota"))).alias("q"))
        .select(
            "source",
            F.aggregate(
                "q",
                F.array().cast("array<bigint>"),
                lambda out, x: F.concat(out, F.array(F.coalesce(F.try_element_at(out, F.lit(-1)), F.lit(0)) + x["quota"])),
            ).alias("ends"),
        )
    )
    ends = cut(ends)
    dealt = (
        meet(units, ends, "source")
        .select("source", "block", "pass", F.size(F.filter("ends", lambda e: e <= F.col("turn"))).alias("shard"))
        .groupBy("source", "block")
        .agg(F.sort_array(F.collect_list(F.struct("pass", "shard"))).alias("drawn"))
    )
    plan = meet(last, dealt, "source", "block", how="left")
    plan = cut(
        plan.select(
            F.col("source").alias("_source"),
            F.col("block").alias("_block"),
            "source_size",
            "target",
            F.col("passes").alias("_passes"),
            F.coalesce("drawn", F.array().cast("array<struct<pass:int,shard:int>>")).alias("_drawn"),
            F.col("lots").alias("_lots"),
        )
    )
    mine = F.filter(
        "_drawn",
        lambda d: (d["pass"] < F.col("_passes")) | F.col("_lots").isNull() | F.array_contains("_lots", F.col("_lot")),
    )
    placed = F.transform(
        mine,
        lambda d: F.struct(
            d["pass"].alias("pass"),
            d["shard"].alias("shard"),
            F.xxhash64(F.lit(seed), d["shard"], d["pass"], F.col("_lot")).alias("place"),
        ),
    )
    met = meet(rows, plan, "_source", "_block")
    return met.select(*[F.col(f"`{c}`") for c in carried], "size", "source_size", "target", placed.alias("draws"))


def mix(docs: DataFrame, place: str | None = None, **options) -> DataFrame:
    """The mix: each row of ``docs`` as often as it is taken, with its ``shard``, dealt to the shards and ordered within them.

    The rows are dealt by ranges of shard and place, so that a shard may be larger than a task and its pieces follow each other in order:
    partitions, and the files written of them, by their number hold the shards one after the other, each in its order. ``place`` names a column
    that orders the rows of a shard where that is lost, as when files are read in another order.
    """
    drawn = draws(docs, **options)
    rows = drawn.withColumn("_draw", F.explode("draws")).withColumn("shard", F.col("_draw.shard"))
    carried = [c for c in drawn.columns if c in docs.columns and c != place]
    return (
        rows.withColumn("_place", F.col("_draw.place"))
        .repartitionByRange("shard", "_place")
        .sortWithinPartitions("shard", "_place")
        .select(*carried, "shard", *([F.col("_place").alias(place)] if place else []))
    )
