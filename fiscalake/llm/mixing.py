"""Mixing sources to target weights by a hypergeometric splitting tree.

Each source is cut into blocks by a hash of its documents. Its target says how many words
to take; blocks are drawn in a permuted order, round after round, until the target is
reached, the last block by single documents. What the output shards get is decided on
counts alone: a tree halves the shards again and again, and at each node the blocks that
go left are a draw without replacement from the node's blocks of all sources, so that the
shards get equal numbers of blocks and exactly the quotas drawn. A shard then takes its
quota from the next blocks in each source's permuted order, and shuffles locally.

Only DataFrame functions run. Windows see at most one row per source, per block, or per
document of one block of a source; a source may hold any share of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import pick, staged, table

WEIGHTS = (5, 2, 1)
SHARE, MOST = 1.5, 2.0


def word_count(text: Column) -> Column:
    """Words between blanks, tabs and line breaks; 0 for null."""
    blank = F.translate(text, "\t\n\x0b\x0c\r", "     ")
    return F.coalesce(F.size(F.array_remove(F.split(blank, " "), "")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``target`` for each source of ``sizes`` (source, source_size).

    The sources by code point, null last, weigh ``weights``, repeating, and divide
    ``share`` times all words; nobody gets more than ``most`` times its size, and what is
    over goes to the others by weight. So some level exists at which a source gets level
    times weight or its cap. Sources reach their caps in the order of cap per weight: the
    level is the first at which the next source in that order stays below its cap."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, map(float, weights))), F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1)
    rows = sizes.withColumn("weight", weight).withColumn("cap", most * F.col("source_size"))
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    everyone = Window.partitionBy()
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    capped = F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    heavier = F.sum("weight").over(by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    level = (share * F.sum("source_size").over(everyone) - capped) / heavier
    rows = rows.withColumn("level", level).withColumn("turn", F.row_number().over(by_cap))
    fits = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct("turn", "level"))
    level = F.min(fits).over(everyone)["level"]
    target = F.least("cap", F.coalesce(level * F.col("weight"), F.col("cap")))
    return rows.select("source", "source_size", "weight", target.alias("target"))


def _uniform(*parts: Column) -> Column:
    """A number from 0 to 1 made from a hash, the same in every run."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 40)) / float(1 << 40)


def split(node: Column, quotas: Column, capacity: Column, seed: int) -> Column:
    """How many blocks of each source go left: a draw of ``capacity`` blocks without
    replacement from a node that holds ``quotas`` of each. Block after block goes left
    with probability (places left) / (blocks left), which is that very distribution."""
    total = F.aggregate(quotas, F.lit(0).cast("long"), lambda s, q: s + q)
    state = F.struct(F.array().cast("array<long>").alias("left"), capacity.cast("long").alias("places"), total.alias("blocks"))

    def block(s: Column, i: Column, source: Column) -> Column:
        taken = (_uniform(F.lit(seed), node, source, i) * s["blocks"] < s["places"]).cast("long")
        return F.struct((s["hits"] + taken).alias("hits"), (s["places"] - taken).alias("places"), (s["blocks"] - 1).alias("blocks"))

    def source(s: Column, q: Column) -> Column:
        start = F.struct(F.lit(0).cast("long").alias("hits"), s["places"].alias("places"), s["blocks"].alias("blocks"))
        # A source without blocks has an empty sequence to go through.
        numbers = F.slice(F.sequence(F.lit(0).cast("long"), q), 2, F.greatest(q.cast("int"), F.lit(0)))
        end = F.aggregate(numbers, start, lambda a, i: block(a, i, F.size(s["left"])))
        return F.struct(F.concat(s["left"], F.array(end["hits"])).alias("left"), end["places"].alias("places"), end["blocks"].alias("blocks"))

    return F.aggregate(quotas, state, source)["left"]


def shard_quotas(draws: DataFrame, levels: int, seed: int) -> DataFrame:
    """(place, shard, blocks): ``draws`` (place, blocks) of all sources, place counting them
    from 0, dealt to 2**levels shards."""
    nodes = draws.agg(
        F.transform(F.array_sort(F.collect_list(F.struct("place", F.col("blocks").cast("long").alias("blocks")))), lambda x: x["blocks"]).alias("quotas")
    ).select(F.lit(0).alias("node"), "quotas", F.aggregate("quotas", F.lit(0).cast("long"), lambda s, q: s + q).alias("blocks"))
    for level in range(levels):
        half = F.floor(F.col("blocks") / 2) + F.pmod(F.col("blocks"), F.lit(2)) * F.pmod(F.col("node"), F.lit(2))
        halved = staged(
            nodes.withColumn("half", half.cast("long")).withColumn("left", split(F.col("node") + (1 << level), F.col("quotas"), F.col("half"), seed)),
            "mix-tree",
        )
        children = F.array(
            F.struct((F.col("node") * 2).alias("node"), F.col("left").alias("quotas"), F.col("half").alias("blocks")),
            F.struct((F.col("node") * 2 + 1).alias("node"), F.zip_with("quotas", "left", lambda q, h: q - h).alias("quotas"), (F.col("blocks") - F.col("half")).alias("blocks")),
        )
        nodes = halved.select(F.inline(children))
    return nodes.select(F.col("node").alias("shard"), F.posexplode("quotas").alias("place", "blocks"))


def mix(
    docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST,
    blocks: int = 512, levels: int = 4, seed: int = 1, keep: tuple[str, ...] = (),
) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, source, and the columns to ``keep``):
    doc_id, size (words), source_size, target (its source's words to take), taken (words
    taken of it, repeats counted), copies, and shards: for each copy the shard it goes to
    and its place in that shard's order.

    A document is taken whole, never more than twice with ``most`` at 2. Where the last
    block ends short of a source's target, that document follows whose size comes nearest
    to what is missing, if it comes nearer at all. Documents
    without words (null, empty, blank) have size 0 and are never taken. A null source is a
    source of its own; so is the empty one. Repeated rows are drawn each for itself, and
    draws depend on the documents only, so reruns agree. An empty table gives an empty
    result. ``blocks`` is the number of blocks of a source, 2**``levels`` that of shards.
    """
    rows = pick(docs, "doc_id", "text", "source", *(k for k in keep if k not in ("doc_id", "text", "source")))
    rows = rows.withColumn("size", word_count(F.col("text")))
    order = F.xxhash64(F.lit(seed), F.col("doc_id").cast("string"), "size")
    if "text" not in keep:
        rows = rows.drop("text")
    rows = staged(
        rows.withColumn("row", F.monotonically_increasing_id()).withColumn("order", order).withColumn("block", F.pmod(F.xxhash64("order", F.lit(0)), F.lit(blocks)).cast("int")),
        "mix-rows",
    )
    filled = staged(rows.groupBy("source", "block").agg(F.sum("size").alias("words")), "mix-blocks")
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    wanted = targets(filled.groupBy("source").agg(F.sum("words").alias("source_size")), weights, share, most)
    wanted = staged(wanted.withColumn("place", F.row_number().over(by_name) - 1), "mix-targets")

    # Rounds through a source's blocks, each in its own order, until the target is reached.
    name = F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))
    rounds = filled.where("words > 0").select("*", F.explode(F.sequence(F.lit(0), F.lit(max(1, int(-(-most // 1))) - 1))).alias("round"))
    turn = Window.partitionBy("source").orderBy("round", F.xxhash64(F.lit(seed), name, "block", "round"), "block")
    drawn = (
        rounds.withColumn("rank", F.row_number().over(turn) - 1)
        .withColumn("before", F.sum("words").over(turn.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("words"))
        .join(wanted.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")))
        .where(F.col("before") < F.col("target"))
        .withColumn("room", F.col("target") - F.col("before"))
        .select("source", "block", "round", "rank", "place", "room", (F.col("words") > F.col("room")).alias("partial"))
    )
    drawn = staged(drawn, "mix-draws")
    quotas = shard_quotas(wanted.select("place").join(drawn.groupBy("place").agg(F.count("*").alias("blocks")), "place", "left").fillna(0, "blocks"), levels, seed)
    upto = Window.partitionBy("place").orderBy("shard")
    dealt = (
        quotas.withColumn("end", F.sum("blocks").over(upto))
        .where("blocks > 0")
        .select("place", "shard", F.explode(F.sequence(F.col("end") - F.col("blocks"), F.col("end") - 1)).alias("rank"))
    )
    drawn = drawn.join(dealt, ["place", "rank"])
    # The last block of a source is taken by documents, as many as there is room for.
    plain = rows.select("row", "source", "block", "order", "size").where("size > 0")
    cut = drawn.where("partial").select(
        F.col("source").alias("cut_source"), F.col("block").alias("cut_block"), F.col("round").alias("cut_round"), F.col("shard").alias("cut_shard"), "room"
    )
    near = Window.partitionBy("source").orderBy("order", "row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = (
        plain.join(cut, F.col("source").eqNullSafe(F.col("cut_source")) & (F.col("block") == F.col("cut_block")))
        .withColumn("upto", F.sum("size").over(near))
        .where(F.col("upto") <= F.col("room"))
        .groupBy("cut_source", "cut_block")
        .agg(F.max(F.struct("order", "row")).alias("end"))
    )
    draw = F.struct("round", "shard", "partial")
    plan = staged(
        drawn.groupBy(F.col("source").alias("of"), F.col("block").alias("from"))
        .agg(F.array_sort(F.collect_list(draw)).alias("draws"))
        .join(last, F.col("of").eqNullSafe(F.col("cut_source")) & (F.col("from") == F.col("cut_block")), "left")
        .select("of", "from", "draws", "end"),
        "mix-plan",
    )

    def with_draws(some: DataFrame) -> DataFrame:
        inside = F.coalesce(F.struct("order", "row") <= F.col("end"), F.lit(False))
        none = F.array().cast("array<struct<round:int,shard:int,partial:boolean>>")
        mine = F.filter(F.coalesce("draws", none), lambda d: (F.col("size") > 0) & (~d["partial"] | inside))
        return (
            some.join(plan, F.col("source").eqNullSafe(F.col("of")) & (F.col("block") == F.col("from")), "left")
            .withColumn("draws", mine)
            .drop("of", "from", "end")
        )

    # One more document where that comes nearer to the target.
    first = with_draws(plain)
    missing = (
        first.groupBy("source")
        .agg(F.sum(F.size("draws") * F.col("size")).alias("words"))
        .join(wanted.select(F.col("source").alias("of"), "target"), F.col("source").eqNullSafe(F.col("of")))
        .join(cut, F.col("of").eqNullSafe(F.col("cut_source")))
        .select("cut_source", "cut_round", "cut_shard", (F.col("target") - F.col("words")).alias("gap"))
    )
    off = F.abs(F.col("size") - F.col("gap"))
    more = (
        first.join(missing, F.col("source").eqNullSafe(F.col("cut_source")))
        .where((off < F.col("gap")) & ~F.exists("draws", lambda d: d["round"] == F.col("cut_round")))
        .groupBy("cut_source", "cut_round", "cut_shard")
        .agg(F.min(F.struct(off.alias("off"), "order", "row"))["row"].alias("more"))
        .select("more", F.struct(F.col("cut_round").alias("round"), F.col("cut_shard").alias("shard"), F.lit(True).alias("partial")).alias("extra"))
    )
    draws = F.when(F.col("extra").isNull(), F.col("draws")).otherwise(F.concat("draws", F.array("extra")))
    position = lambda d: F.xxhash64(F.lit(seed), d["round"], "order")
    taken = (
        with_draws(rows)
        .join(more, F.col("row") == F.col("more"), "left")
        .withColumn("shards", F.transform(draws, lambda d: F.struct(d["shard"].alias("shard"), position(d).alias("position"))))
        .withColumn("copies", F.size("shards"))
        .withColumn("taken", F.col("copies") * F.col("size"))
    )
    sources = wanted.select(F.col("source").alias("of"), "source_size", "target")
    return taken.join(sources, F.col("source").eqNullSafe(F.col("of"))).select(
        "doc_id", *(k for k in keep if k != "doc_id"), "size", "source_size", "target", "taken", "copies", "shards"
    )


def op6_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mix(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies", "shards")
