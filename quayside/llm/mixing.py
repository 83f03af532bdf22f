"""Mixing sources to target weights, in DataFrame operations only.

1. Sizes per source and, by water filling, the words each source gives to the mix.
2. Each source is cut into blocks of documents (by a hash of the id). A source's deck is its
   blocks in a permuted order, once for every pass over the source; the first ``quota``
   block copies of the deck make up its target.
3. A splitting tree shares the quotas out among the output shards. A node holds the number
   of block copies of every source; its left child draws half of them at random without
   replacement, which is a multivariate hypergeometric draw, taken source by source from
   conditional hypergeometric distributions. Only counts pass through the tree.
4. A leaf's counts are consecutive, so disjoint, stretches of the sources' decks. Rows
   are shuffled inside their shard by a hash.

All random choices are hashes of ids and the seed, so reruns agree.

Nulls: a null text has size 0; a null source is a source of its own, the last; a null id is
an id. Rows equal in id, source and text fall into the same block. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.common import WORD, unit_hash, written

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MAX_REPEAT = 2
WORDS_PER_SHARD = 1 << 22
MIN_SHARDS = 8
MIN_BLOCKS = 1024


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MAX_REPEAT) -> DataFrame:
    """(source, source_size) → plus ``target`` and ``source_no``: least(most * size, level *
    weight) with the level at which the targets add up to ``share`` of all sizes.

    The windows without a partition hold one row per source, no documents."""
    everything = Window.partitionBy()
    named = sizes.withColumn("source_no", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    named = named.withColumn("_w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("source_no") - 1) % len(weights) + 1))
    named = named.withColumn("_cap", F.lit(float(most)) * F.col("source_size"))
    by_ratio = Window.orderBy(F.col("_cap") / F.col("_w"), "source_no")
    level = (F.lit(float(share)) * F.sum("source_size").over(everything) - F.coalesce(F.sum("_cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))) / F.sum("_w").over(by_ratio.rowsBetween(0, Window.unboundedFollowing))
    named = named.withColumn("_level", level)
    free = F.when(F.col("_level") * F.col("_w") <= F.col("_cap"), F.struct(F.col("_cap") / F.col("_w"), F.col("source_no"), F.col("_level").alias("level")))
    named = named.withColumn("_at", F.min(free).over(everything).getField("level"))
    return named.select("source", "source_no", "source_size", F.least(F.col("_cap"), F.coalesce(F.col("_at") * F.col("_w"), F.col("_cap"))).alias("target"))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once (a lambda's variable)."""
    return F.element_at(F.transform(F.array(value), use), 1)


def hypergeometric(total: Column, good: Column, draws: Column, u: Column) -> Column:
    """The value at ``u`` of the distribution function of the number of good items among
    ``draws`` from ``total``. The probabilities go outward from the mode by their ratios, 12
    standard deviations and 12 values each way."""
    n, g, d = (c.cast("double") for c in (total, good, draws))
    lo, hi = F.greatest(F.lit(0.0), d - (n - g)), F.least(g, d)
    middle = F.least(F.greatest(F.floor((d + 1) * (g + 1) / (n + 2)).cast("double"), lo), hi)
    sd = F.sqrt(F.greatest(F.lit(0.0), d * g * (n - g) * (n - d) / (n * n * F.greatest(n - 1, F.lit(1.0)))))
    reach = F.ceil(sd * 12).cast("double") + 12

    def walk(mode: Column, up: bool, start: Column, meet: Callable[[Column], Column]) -> Column:
        """From the mode outward, (``p`` over that of the mode, their running ``sum``, value ``k``), up to
        the first sum that ``meet``s."""
        def step(acc: Column, k: Column) -> Column:
            if up:
                ratio = (g - (k - 1)) * (d - (k - 1)) / (k * (n - g - d + k))
            else:
                ratio = (k + 1) * (n - g - d + k + 1) / ((g - k) * (d - k))
            p = acc["p"] * ratio
            new = F.struct(p.alias("p"), (acc["sum"] + p).alias("sum"), k.alias("k"), meet(acc["sum"] + p).alias("met"))
            return F.when(acc["met"], acc).otherwise(new)

        last = F.least(hi, mode + reach) if up else F.greatest(lo, mode - reach)
        path = F.slice(F.sequence(mode.cast("long"), last.cast("long")), F.lit(2), F.lit(2**31 - 2))
        return F.aggregate(F.transform(path, lambda k: k.cast("double")), start, step)

    def begin(mode: Column, total: float, met: Column) -> Column:
        return F.struct(F.lit(1.0).alias("p"), F.lit(total).alias("sum"), mode.alias("k"), met.alias("met"))

    never = lambda _: F.lit(False)

    def pick(mode: Column) -> Column:
        """The value where the running sum from the lowest value on first exceeds ``u`` of the whole."""
        def found(sums: Column) -> Column:
            below, aim = sums["below"], (sums["below"] + sums["rest"]) * u
            lower = walk(mode, False, begin(mode, 0.0, F.lit(False)), lambda s: below - s <= aim)
            upper = walk(mode, True, begin(mode, 1.0, below + 1 > aim), lambda s: below + s > aim)
            return F.when(aim < below, lower["k"]).otherwise(upper["k"])

        below = walk(mode, False, begin(mode, 0.0, F.lit(False)), never)["sum"]
        rest = walk(mode, True, begin(mode, 1.0, F.lit(False)), never)["sum"]
        return let(F.struct(below.alias("below"), rest.alias("rest")), found)

    return F.when(hi <= lo, lo).otherwise(let(middle, pick)).cast("long")


def split_quotas(quotas: DataFrame, depth: int, seed: int) -> DataFrame:
    """(source_no, quota) → (source_no, shard, blocks): the quotas shared out among ``2 **
    depth`` shards. A node is one row with an array of one count per source."""
    nodes = quotas.groupBy().agg(F.sort_array(F.collect_list(F.struct("source_no", "quota"))).alias("_q")).select(F.lit(0).cast("long").alias("node"), F.transform("_q", lambda x: x["source_no"]).alias("sources"), F.transform("_q", lambda x: x["quota"]).alias("counts"))
    for level in range(depth):
        total = F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x)
        start = F.struct(total.alias("n"), F.floor((total + F.pmod(F.xxhash64(F.col("node"), F.lit(seed)), F.lit(2))) / 2).cast("long").alias("d"), F.lit(0).alias("i"), F.array().cast("array<bigint>").alias("out"))

        def draw(acc: Column, count: Column) -> Column:
            x = hypergeometric(acc["n"], count, acc["d"], unit_hash(F.col("node"), F.col("level"), acc["i"], F.lit(seed)))
            return let(x, lambda v: F.struct((acc["n"] - count).alias("n"), (acc["d"] - v).alias("d"), (acc["i"] + 1).alias("i"), F.concat(acc["out"], F.array(v)).alias("out")))

        nodes = nodes.withColumn("level", F.lit(level)).withColumn("left", F.aggregate("counts", start, draw)["out"])
        children = F.array(
            F.struct((F.col("node") * 2).alias("node"), F.col("left").alias("counts")),
            F.struct((F.col("node") * 2 + 1).alias("node"), F.zip_with("counts", "left", lambda a, b: a - b).alias("counts")),
        )
        nodes = nodes.select("sources", F.explode(children).alias("c")).select("c.node", "sources", "c.counts")
        if level % 6 == 5:
            nodes = nodes.repartition("node")
    return nodes.select(F.col("node").alias("shard"), F.explode(F.arrays_zip("sources", "counts")).alias("x")).select("shard", F.col("x.sources").alias("source_no"), F.col("x.counts").alias("blocks"))


def _planned(docs: DataFrame, weights: tuple[float, ...], share: float, n_shards: int | None, seed: int) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, source, text_key, size, source_size, target``, the passes
    over the whole source (``full``), whether the last pass takes the document too (``last``), and the shard of
    its block in every pass (``block_shards``)."""
    spark = docs.sparkSession
    sized = written(spark, docs.select("doc_id", "source", F.xxhash64("text").alias("text_key"), word_count(F.col("text")).alias("size")), "mix-sizes")
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = written(spark, source_targets(sizes, weights, share), "mix-targets")
    total = targets.agg(F.sum("source_size")).first()[0] or 0
    depth = math.ceil(math.log2(n_shards or max(MIN_SHARDS, total / WORDS_PER_SHARD)))
    n_blocks = max(MIN_BLOCKS, 8 * 2**depth)
    placed = sized.withColumn("block", F.pmod(F.xxhash64("doc_id", "text_key", F.lit(seed)), F.lit(n_blocks)).cast("int"))

    same = lambda a, b: a["source"].eqNullSafe(b["source"])
    blocks = placed.groupBy("source", "block").agg(F.sum("size").alias("block_size")).alias("b")
    blocks = blocks.join(targets.alias("t"), F.col("b.source").eqNullSafe(F.col("t.source"))).drop(F.col("t.source"))
    deck = Window.partitionBy("source_no").orderBy(F.xxhash64("source_no", "block", F.lit(seed)), "block")
    blocks = blocks.withColumn("place", F.row_number().over(deck) - 1).withColumn("deck_size", F.count("*").over(Window.partitionBy("source_no")))
    blocks = blocks.withColumn("end", F.sum("block_size").over(deck.rowsBetween(Window.unboundedPreceding, 0)))
    full = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") + 1e-12)).otherwise(F.lit(0)).cast("int")
    rest = F.greatest(F.lit(0.0), F.col("target") - full * F.col("source_size"))
    blocks = blocks.withColumn("full", full).withColumn("room", rest - (F.col("end") - F.col("block_size")))
    # of the last pass: blocks that fit whole, and the first one that does not, in part
    blocks = blocks.withColumn("in_last", (F.col("room") > 0).cast("int"))
    blocks = written(spark, blocks, "mix-blocks")

    quotas = blocks.groupBy("source_no").agg(F.sum(F.col("full") + F.col("in_last")).cast("long").alias("quota"))
    leaves = split_quotas(quotas, depth, seed).filter("blocks > 0")
    # a leaf's stretch of the deck begins where those of the shards before it end; a block copy belongs to the
    # last leaf that begins at its position or before: one sorted window over both
    stretch = Window.partitionBy("source_no").orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)
    begins = leaves.select("source_no", (F.sum("blocks").over(stretch) - F.col("blocks")).alias("at"), "shard")
    turns = F.slice(F.sequence(F.lit(0), F.col("full") + F.col("in_last")), F.lit(1), F.col("full") + F.col("in_last"))
    copies = blocks.select("source_no", "block", "place", "deck_size", F.explode(turns).alias("turn"))
    copies = copies.select("source_no", (F.col("turn") * F.col("deck_size") + F.col("place")).cast("long").alias("at"), "block", "turn")
    along = Window.partitionBy("source_no").orderBy("at", F.asc_nulls_last("shard")).rowsBetween(Window.unboundedPreceding, 0)
    merged = begins.unionByName(copies, allowMissingColumns=True).withColumn("shard", F.last("shard", ignorenulls=True).over(along))
    shards = F.sort_array(F.collect_list(F.struct("turn", "shard")))  # at most MAX_REPEAT + 1
    of_block = merged.filter(F.col("turn").isNotNull()).groupBy("source_no", "block").agg(F.transform(shards, lambda x: x["shard"]).alias("block_shards"))
    blocks = blocks.join(of_block, ["source_no", "block"], "left").withColumn("block_shards", F.coalesce("block_shards", F.array().cast("array<bigint>")))

    p, b = placed.alias("p"), blocks.select("source", "block", "source_size", "target", "full", "room", "block_size", "block_shards").alias("b")
    rows = p.join(b, same({"source": F.col("p.source")}, {"source": F.col("b.source")}) & (F.col("p.block") == F.col("b.block"))).select("p.doc_id", "p.source", "p.text_key", "p.size", "p.block", *[f"b.{c}" for c in ("source_size", "target", "full", "room", "block_size", "block_shards")])
    inside = Window.partitionBy("source", "block").orderBy(F.xxhash64("doc_id", F.lit(seed + 1)), "doc_id", "text_key").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_before", F.sum("size").over(inside) - F.col("size"))
    last = (F.col("_before") + F.col("size") / 2 <= F.col("room")) & (F.col("room") > 0) & (F.col("full") < MAX_REPEAT)
    return rows.select("doc_id", "source", "text_key", "size", "source_size", "target", "full", last.cast("int").alias("last"), "block_shards")


def plan_mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, n_shards: int | None = None, seed: int = 7) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, source, size, source_size, target, copies,
    taken, shards`` (the shard of every copy). A document is taken at most ``MAX_REPEAT``
    times, whole each time; a source's taken words miss its target by half a document at
    most."""
    rows = _planned(docs, weights, share, n_shards, seed).withColumn("copies", F.col("full") + F.col("last"))
    return rows.select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).cast("long").alias("taken"), F.slice("block_shards", F.lit(1), F.col("copies")).alias("shards"))


def mix_documents(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, n_shards: int | None = None, seed: int = 7) -> DataFrame:
    """The mix itself: the rows of ``docs`` (all their columns), each as often as it is
    taken, grouped by shard and shuffled inside it. Documents without words are not taken.

    The plan is joined back by id, source and text. Rows equal in these are interchangeable in the plan: it says how many
    of them the last pass takes. Only where it takes some of them but not all, rows are numbered to take as many, within the tasks
    that read them first, so that very many equal rows are not numbered by one task."""
    key = ["doc_id", "source", "text_key"]
    plan = _planned(docs, weights, share, n_shards, seed).filter("size > 0").groupBy(*key).agg(
        F.count("*").alias("_rows"), F.sum("last").alias("_taken_last"), F.max("full").alias("_full"), F.max("block_shards").alias("_shards"))
    plan = plan.filter((F.col("_full") > 0) | (F.col("_taken_last") > 0)).select(*[F.col(c).alias(f"_{c}") for c in key], "_rows", "_taken_last", "_full", "_shards")
    plan = written(docs.sparkSession, plan, "mix-plan")
    d = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("d"))
    d = d.withColumn("_text_key", F.xxhash64("d.text")).withColumn("_part", F.spark_partition_id())
    on = F.col("d.doc_id").eqNullSafe(F.col("_doc_id")) & F.col("d.source").eqNullSafe(F.col("_source")) & (d["_text_key"] == plan["_text_key"])
    some = (F.col("_taken_last") > 0) & (F.col("_taken_last") < F.col("_rows"))
    rows = d.join(plan.filter(~some), on).select("d", "_shards", (F.col("_full") + (F.col("_taken_last") > 0).cast("int")).alias("_copies"))
    if plan.filter(some).limit(1).count():
        rows = rows.unionByName(_numbered(d.join(plan.filter(some), on).drop(plan["_text_key"])))
    rows = rows.filter("_copies > 0").select("d", F.posexplode(F.slice("_shards", F.lit(1), F.col("_copies"))).alias("_copy", "_shard"))
    slot = F.xxhash64("d.doc_id", "d.text", "_copy", "_shard")
    return rows.repartition("_shard", F.pmod(slot, F.lit(16))).sortWithinPartitions("_shard", slot).select(*[F.col(f"d.`{c}`").alias(c) for c in docs.columns])


def _numbered(rows: DataFrame) -> DataFrame:
    """``d, _shards, _copies`` of equal rows of which the last pass takes ``_taken_last``: those numbered first. Numbers are given
    within the tasks that read the rows (``_part``) and moved by the rows of the tasks before."""
    equal = ["_doc_id", "_source", "_text_key"]
    place = F.row_number().over(Window.partitionBy(*equal, "_part").orderBy(F.to_json("d")))
    sums = rows.groupBy(*equal, "_part").agg(F.count("*").alias("_n"))
    offset = F.sum("_n").over(Window.partitionBy(*equal).orderBy("_part")) - F.col("_n")
    before = sums.select(*[F.col(c).alias(f"o{c}") for c in [*equal, "_part"]], offset.alias("_offset"))
    match = F.col("_part") == F.col("o_part")
    for c in equal:
        match = match & F.col(c).eqNullSafe(F.col(f"o{c}"))
    taken = F.col("_place") + F.col("_offset") <= F.col("_taken_last")
    return rows.withColumn("_place", place).join(before, match).select("d", "_shards", (F.col("_full") + taken.cast("int")).alias("_copies"))
