"""Mixing sources to target weights by a splitting tree of block quotas.

Each source's documents are dealt into blocks of about ``block_words`` words by a keyed hash.
A source whose target is t times its size is drawn t times round: its blocks come in a keyed
order, whole rounds first, and the last round stops at the target, within a block by whole
documents and within the last document by words. This gives an exact number of block draws per
source, its quota.

The quotas of all sources are split among the output shards by a binary tree: a node with n
draws and k shards gives its left child a share that belongs to half of its shards, and how many
of each source these are is a multivariate-hypergeometric draw, just as if all draws had been
shuffled and dealt out. A shard's draws of a source are then consecutive in the source's order,
so shards are disjoint, and rows are put in keyed order inside each shard.

Everything is column expressions: the tree works on one row per node that holds an array of
quotas, the hypergeometric draws invert their distribution function on both sides of the mean
as far as a double can tell.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stationlake.llm.common import let
from stationlake.session import materialise

# White space between words, and weights by the sources' order.
WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0

BLOCK_WORDS = 100_000
SHARD_WORDS = 2_000_000


def word_count(text: Column) -> Column:
    """Runs of characters other than ASCII white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def _hash(seed: int, *columns: Column | str) -> Column:
    return F.xxhash64(F.lit(f"mixing {seed}"), *columns)


def source_targets(
    sources: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
) -> DataFrame:
    """Targets from rows (source, source_size): columns weight and target are added.

    Sources in code point order, null last, weigh ``weights`` in turn and share ``share`` times
    all sizes; no target exceeds ``most`` times its source's size, and the excess is shared
    again by weight. The sources that stop are those with the least size for their weight, so
    one pass in that order finds the level of the others. One row per source meets in one task,
    of about 50 bytes; no document does.
    """
    place = Window.orderBy(F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    order = F.array(*[F.lit(float(w)) for w in weights])
    turn = ((F.row_number().over(place) - 1) % len(weights) + 1).cast("int")
    weighed = sources.withColumn("weight", F.element_at(order, turn)).withColumn(
        "_cap", F.col("source_size") * F.lit(float(most))
    )
    fill = Window.orderBy(F.col("_cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    after = fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    total = F.sum("source_size").over(every) * F.lit(float(share))
    level = (total - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) / F.sum("weight").over(
        after
    )
    levels = weighed.withColumn("_level", level)
    stops = F.col("_cap") <= F.col("_level") * F.col("weight")
    free = F.min(F.when(~stops, F.struct("_rank", "_level"))).over(every)["_level"]
    return (
        levels.withColumn("_rank", F.row_number().over(fill))
        .withColumn("_free", free)
        .withColumn(
            "target",
            F.least("_cap", F.coalesce(F.col("_free") * F.col("weight"), F.col("_cap"))),
        )
        .drop("_cap", "_level", "_rank", "_free")
    )


def _ln_factorial(n: Column) -> Column:
    """ln n!, by Stirling's series for n + 8."""
    low = n + 1
    for i in range(2, 8):
        low = low * (n + float(i))

    def series(z: Column) -> Column:
        cube = z * z * z
        return (z - 0.5) * F.log(z) - z + 1 / (12 * z) - 1 / (360 * cube)

    return let(n + 8, series) + F.lit(0.5 * math.log(2 * math.pi)) - F.log(low)


def hypergeometric(total: Column, marked: Column, drawn: Column, uniform: Column) -> Column:
    """How many of ``drawn`` items, out of ``total`` with ``marked`` ones, are marked.

    ``uniform`` in [0, 1) picks the value by the distribution function. Values further than 9
    standard deviations from the mean, of less than 1e-16 together, are left out.
    """
    n, k, m = (F.greatest(c, F.lit(0)).cast("double") for c in (total, marked, drawn))

    def spread(v: Column) -> Column:
        n, k, m = v["n"], v["k"], v["m"]
        safe, left = F.greatest(n, F.lit(1.0)), F.greatest(n - 1, F.lit(1.0))
        mean = m * k / safe
        variance = mean * (1 - k / safe) * (n - m) / left
        reach = 9 * F.sqrt(F.greatest(variance, F.lit(0.0))) + 4
        return F.struct(v.alias("v"), mean.alias("mean"), reach.alias("reach"))

    def ends(w: Column) -> Column:
        n, k, m = w["v"]["n"], w["v"]["k"], w["v"]["m"]
        low = F.floor(F.greatest(F.lit(0.0), m + k - n, w["mean"] - w["reach"]))
        high = F.floor(F.least(m, k, w["mean"] + w["reach"] + 1))
        return F.struct(
            w["v"].alias("v"), low.cast("double").alias("low"), high.cast("double").alias("high")
        )

    def invert(e: Column) -> Column:
        n, k, m, u = (e["v"][c] for c in "nkmu")
        low, high = e["low"], e["high"]
        counts = F.array(k, n - k, m, n - m, low, k - low, m - low, n - k - m + low, n)
        logs = F.transform(counts, _ln_factorial)

        def start(f: Column) -> Column:
            above, below = f[0] + f[1] + f[2] + f[3], f[4] + f[5] + f[6] + f[7] + f[8]
            return F.exp(above - below)

        def step(state: Column, x: Column) -> Column:
            at = low + x
            more = (k - at) * (m - at) / ((at + 1) * F.greatest(n - k - m + at + 1, F.lit(1.0)))
            done = state["below"] + state["p"]
            value = F.when(done <= u, F.least(at + 1, high)).otherwise(state["value"])
            return F.struct(
                (state["p"] * more).alias("p"), done.alias("below"), value.alias("value")
            )

        begin = F.struct(
            let(logs, start).alias("p"), F.lit(0.0).alias("below"), low.alias("value")
        )
        tries = F.sequence(F.lit(0), F.greatest(high - low, F.lit(0.0)).cast("int"))
        return F.aggregate(tries, begin, step)["value"].cast("bigint")

    given = F.struct(n.alias("n"), k.alias("k"), m.alias("m"), uniform.alias("u"))
    return let(let(let(given, spread), ends), invert)


def split_quotas(quotas: DataFrame, shards: int, seed: int = 0) -> DataFrame:
    """Split rows (source, quota) among ``shards``: rows (shard, source, first, quota).

    ``first`` is the number of the source's draws in earlier shards. The shards' totals differ
    by one at most, and over all shards each source's quotas add up to the given one. One row
    per tree node holds an array with an entry per source.
    """
    entry = F.struct(F.lit(0).cast("bigint").alias("first"), "source", "quota")
    tree = quotas.groupBy().agg(
        F.array_sort(F.collect_list(entry), _by_source).alias("parts"),
        F.lit(0).alias("shard"),
        F.lit(shards).alias("width"),
    )
    for level in range(max(shards - 1, 0).bit_length()):
        tree = _split(tree, level, seed)
    return tree.select("shard", F.explode("parts").alias("part")).select("shard", "part.*")


def _by_source(a: Column, b: Column) -> Column:
    x, y = a["source"], b["source"]
    return (
        F.when(x.eqNullSafe(y), 0)
        .when(x.isNull(), 1)
        .when(y.isNull(), -1)
        .when(x < y, -1)
        .otherwise(1)
    )


def _split(tree: DataFrame, level: int, seed: int) -> DataFrame:
    """Each node of several shards becomes its two children."""
    total = F.aggregate("parts", F.lit(0).cast("bigint"), lambda s, p: s + p["quota"])
    half = F.floor((F.col("width") + 1) / 2).cast("int")
    sized = tree.withColumns({"_total": total, "_half": half}).withColumn(
        # shards come in order; each has the total divided by their number, some one more
        "_left", F.ceil(F.col("_total") * F.col("_half") / F.col("width")).cast("bigint")
    )
    state = F.struct(
        F.col("_total").alias("total"),
        F.col("_left").alias("left"),
        F.expr("array()").cast("array<bigint>").alias("taken"),
    )

    def draw(s: Column, p: Column) -> Column:
        bits = F.shiftrightunsigned(_hash(seed, F.lit(level), F.col("shard"), p["source"]), 11)
        uniform = bits.cast("double") / F.lit(float(1 << 53))
        mine = F.when(s["total"] <= p["quota"], s["left"]).otherwise(
            hypergeometric(s["total"], p["quota"], s["left"], uniform)
        )
        return F.struct(
            (s["total"] - p["quota"]).alias("total"),
            (s["left"] - mine).alias("left"),
            F.concat(s["taken"], F.array(mine)).alias("taken"),
        )

    drawn = sized.withColumn("_taken", F.aggregate("parts", state, draw)["taken"])

    def child(right: bool) -> Column:
        def part(p: Column, i: Column) -> Column:
            left = F.get("_taken", i)
            return F.struct(
                (p["first"] + left if right else p["first"]).alias("first"),
                p["source"].alias("source"),
                (p["quota"] - left if right else left).alias("quota"),
            )

        return F.struct(
            (F.col("shard") + F.col("_half") if right else F.col("shard")).alias("shard"),
            (F.col("width") - F.col("_half") if right else F.col("_half")).alias("width"),
            F.transform("parts", part).alias("parts"),
        )

    children = F.when(F.col("width") > 1, F.array(child(False), child(True))).otherwise(
        F.array(F.struct("shard", "width", "parts"))
    )
    return drawn.select(F.explode(children).alias("node")).select("node.*")


def plan(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    block_words: int = BLOCK_WORDS,
    shard_words: int = SHARD_WORDS,
    seed: int = 0,
    cut: bool = True,
    whole_rows: bool = False,
) -> DataFrame:
    """What the mix takes of each row of ``docs``.

    Returns ``docs`` without its text (with it, if ``whole_rows``), with size, source_size, target and ``draws``: an array of
    (round, words, shard, place). Words is the whole size but for the document at which a
    source reaches its target: with ``cut`` it gives just the words that are missing, without
    it the whole if at least half of them are missing. A shard holds about ``shard_words``
    words; places order its rows.

    Null texts have size 0, as empty ones; a null source is a source of its own, the last.
    Documents without words are never drawn. Rows may repeat: equal rows (same id and text) are
    ranked in any order, which gives the same rows. An empty table gives an empty plan. Columns
    called as those above are replaced.
    """
    own = {"size", "source_size", "target", "draws"} if not whole_rows else {"draws"}
    keep = [c for c in docs.columns if c not in own and (whole_rows or c != text)]
    sized = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("_row"),
        F.col(source).alias("_source"),
        word_count(F.col(text)).alias("_size"),
        _hash(seed, F.col(doc_id), F.col(text)).alias("_key"),
    )
    if not whole_rows:
        sized = materialise(sized)  # narrow rows; texts are rather read again
    slim = sized.select("_source", "_size", "_key")
    if whole_rows:
        slim = materialise(slim)
    totals = slim.groupBy(F.col("_source").alias("source")).agg(
        F.sum("_size").alias("source_size"), F.count(F.lit(1)).alias("_rows")
    )
    goals = materialise(
        source_targets(totals)
        .withColumn("_goal", F.round("target").cast("bigint"))
        .withColumn(
            "_blocks",
            F.ceil((F.col("source_size") + F.col("_rows")) / block_words).cast("bigint"),
        )
    )
    # a row per source; no hint, so that Spark broadcasts them by their size
    def dealt_in(rows: DataFrame) -> DataFrame:
        known = rows.join(goals, F.col("_source").eqNullSafe(F.col("source")), "left")
        return known.withColumn("_block", F.pmod(F.col("_key"), F.col("_blocks")))

    blocks = dealt_in(slim).groupBy("source", "_block").agg(F.sum("_size").alias("_words"))
    blocks = blocks.join(
        goals.select(F.col("source").alias("_s"), "_goal", "_blocks", "source_size"),
        F.col("source").eqNullSafe(F.col("_s")),
    ).drop("_s")
    order = [F.col("source").asc_nulls_last(), _hash(seed, "source", "_block"), F.col("_block")]
    starts = materialise(_earlier(blocks, order))
    rest = F.greatest(F.col("_goal") - F.col("_round") * F.col("source_size"), F.lit(0))
    rounds = F.when(F.col("source_size") > 0, F.floor(F.col("_goal") / F.col("source_size")))
    starts = starts.withColumn("_round", F.coalesce(rounds, F.lit(0))).withColumn("_rest", rest)
    # draws of a source: its whole rounds, and the blocks that the last round reaches
    reached = F.col("_words_before") < F.col("_rest")
    quotas = starts.groupBy("source").agg(
        (F.sum("_round") + F.sum(reached.cast("bigint"))).alias("quota")
    )
    quotas = quotas.where("quota > 0")
    shards = max(1, math.ceil((goals.agg(F.sum("_goal")).first()[0] or 0) / shard_words))
    parts = split_quotas(quotas, shards, seed)
    edges = _edges(dealt_in(slim).select("_source", "_block", "_size", "_key"), starts)
    # both have their size on disk, by which Spark broadcasts them: texts stay where they are
    edges = edges.select(F.col("_s").alias("_source"), F.col("_b").alias("_block"), "_edge", "_past")
    dealt = _dealt(starts, parts, seed).join(edges, _in_block(), "left").drop("_source", "_block")
    dealt = materialise(dealt)
    ends = materialise(dealt.where("_edge IS NOT NULL"))
    known = dealt_in(sized)
    placed = known.select("_row", "_source", "_size", "_key", "_block", "source_size", "target")
    return _draws(placed, dealt, ends, keep, seed, cut)


def _in_block() -> Column:
    return F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_block") == F.col("_b"))


def _edges(rows: DataFrame, starts: DataFrame) -> DataFrame:
    """The key in order at which a source reaches its target, and the words of its block before it.

    Rows (_s, _b, _edge, _past), one for each source that ends within a block. Only narrow rows
    are put in order.
    """
    crossing = (F.col("_words_before") < F.col("_rest")) & (
        F.col("_words_before") + F.col("_words") > F.col("_rest")
    )
    ends = starts.where(crossing).select(
        F.col("source").alias("_s"),
        F.col("_block").alias("_b"),
        (F.col("_rest") - F.col("_words_before")).alias("_missing"),
    )
    inside = rows.join(ends, _in_block()).groupBy("_s", "_b", "_missing", "_key")
    inside = inside.agg(F.sum("_size").alias("_size"))
    order = Window.partitionBy("_s", "_b").orderBy("_key")
    past = F.sum("_size").over(order.rowsBetween(Window.unboundedPreceding, -1))
    inside = inside.withColumn("_past", F.coalesce(past, F.lit(0)))
    reached = (F.col("_past") <= F.col("_missing")) & (
        F.col("_past") + F.col("_size") > F.col("_missing")
    )
    return inside.where(reached).select("_s", "_b", F.col("_key").alias("_edge"), "_past")


def _earlier(blocks: DataFrame, order: list[Column]) -> DataFrame:
    """Blocks with the words and the number of their source's blocks before them in order."""
    ranged = materialise(
        blocks.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    )
    parts = ranged.groupBy("source", "_part").agg(
        F.sum("_words").alias("_w"), F.count(F.lit(1)).alias("_n")
    )
    past = Window.partitionBy("source").orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    # at most a row per source and part of the ranges that the source reaches
    before = parts.select(
        F.col("source").alias("_s"),
        F.col("_part").alias("_p"),
        F.coalesce(F.sum("_w").over(past), F.lit(0)).alias("_w"),
        F.coalesce(F.sum("_n").over(past), F.lit(0)).alias("_n"),
    )
    inside = Window.partitionBy("source", "_part").orderBy(*order[1:])
    up_to = inside.rowsBetween(Window.unboundedPreceding, -1)
    return (
        ranged.withColumns(
            {
                "_wi": F.coalesce(F.sum("_words").over(up_to), F.lit(0)),
                "_ni": F.row_number().over(inside) - 1,
            }
        )
        .join(before, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_part") == F.col("_p")))
        .withColumn("_words_before", F.col("_wi") + F.col("_w"))
        .withColumn("_place", (F.col("_ni") + F.col("_n")).cast("bigint"))
        .drop("_s", "_p", "_w", "_n", "_wi", "_ni", "_part")
    )


def _dealt(starts: DataFrame, parts: DataFrame, seed: int) -> DataFrame:
    """Blocks with the shard of each round: a source's draws are dealt to shards in order."""
    runs = (
        parts.where("quota > 0")
        .groupBy(F.col("source").alias("_s"))
        .agg(F.array_sort(F.collect_list(F.struct("first", "shard"))).alias("_runs"))
    )
    draws = F.sequence(F.lit(0).cast("bigint"), F.col("_round"))

    def shard(i: Column) -> Column:
        at = F.col("_place") + i * F.col("_blocks")
        return F.element_at(F.filter("_runs", lambda r: r["first"] <= at), -1)["shard"]

    joined = starts.join(runs, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")
    return joined.select(
        F.col("source").alias("_s"),
        F.col("_block").alias("_b"),
        "_round",
        "_rest",
        "_words",
        "_words_before",
        F.transform(draws, shard).alias("_shards"),
    )


def _draws(
    placed: DataFrame, dealt: DataFrame, ends: DataFrame, keep: list[str], seed: int, cut: bool
) -> DataFrame:
    # only equal rows at the key where a source reaches its target need an order: all before
    # them are in the last round, and none behind them
    at_edge = F.col("_key") == F.col("_edge")
    inside = placed.join(ends, _in_block() & at_edge)
    rows = Window.partitionBy("_source", "_block").orderBy("_key")
    before = F.coalesce(
        F.sum("_size").over(rows.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    missing = F.col("_rest") - F.col("_words_before") - F.col("_past") - F.col("_before")
    part = F.greatest(F.least(missing, F.col("_size")), F.lit(0))
    if not cut:
        part = F.when(2 * part >= F.col("_size"), F.col("_size")).otherwise(0)
    last = inside.withColumn("_before", before).withColumn("_last", part).drop("_before")
    other = placed.join(dealt, _in_block(), "left")
    other = other.where(~F.coalesce(at_edge, F.lit(False))).withColumn(
        "_last",
        F.when(
            (F.col("_words_before") < F.col("_rest"))
            & (F.col("_edge").isNull() | (F.col("_key") < F.col("_edge"))),
            F.col("_size"),
        ).otherwise(0),
    )
    both = last.unionByName(other)

    def draw(i: Column) -> Column:
        words = F.when(i < F.col("_round"), F.col("_size")).otherwise(F.col("_last"))
        return F.struct(
            i.alias("round"),
            words.cast("bigint").alias("words"),
            F.get("_shards", i.cast("int")).alias("shard"),
            _hash(seed, F.lit("place"), "_key", i).alias("place"),
        )

    rounds = F.sequence(F.lit(0).cast("bigint"), F.coalesce("_round", F.lit(0).cast("bigint")))
    draws = F.filter(F.transform(rounds, draw), lambda d: d["words"] > 0)
    found = {"size": "_size", "source_size": "source_size", "target": "target"}
    added = [F.col(c).alias(name) for name, c in found.items() if name not in keep]
    drawn = both.withColumn("_draws", draws)
    return drawn.select(
        *[F.col("_row")[c].alias(c) for c in keep], *added, F.col("_draws").alias("draws")
    )


def taken() -> Column:
    """The words that a row of a plan gives to the mix, repeats counted."""
    return F.aggregate("draws", F.lit(0).cast("bigint"), lambda s, d: s + d["words"])


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: the drawn rows with all columns of ``docs``, and shard and place.

    Columns of these names are replaced.

    A document drawn twice comes twice, and none is cut: a source's last document comes whole
    if at least half of it is missing. Rows are partitioned by shard and in the order of place
    inside each, ready to be written. Options and special cases are those of ``plan``.
    """
    docs = docs.drop("shard", "place", "draws")
    drawn = plan(docs, cut=False, whole_rows=True, **options)
    draw = F.explode("draws").alias("_draw")
    rows = drawn.select(*docs.columns, draw).select(*docs.columns, "_draw.shard", "_draw.place")
    return rows.repartition("shard").sortWithinPartitions("shard", "place")
