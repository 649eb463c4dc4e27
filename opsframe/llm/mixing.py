"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

A source's documents stand in the order of a seeded hash, cut into blocks of
about equal numbers of documents. Its target is so many passes over all its
blocks and a part of one more, each pass in a seeded permutation of its own: whole
blocks and, of the block in which the target ends, the documents that come nearest
to it. The block draws of all sources are split among the output shards by a
binary tree: each node halves every source's quota by hypergeometric draws, one
source after the other, so that both sides get exactly their share. A shard then
takes its quota of each source's permuted blocks, disjoint from every other
shard's; a document is taken as often as a shard's quota holds its block.

Only one row per source and at most ``MOST_BLOCKS`` rows per source are gathered
on the way; documents are read where they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opsframe.sources.scratch import written

# Sources in order weigh 1, 2, 3, and again; none is taken more than 3 times.
WEIGHTS = (1.0, 2.0, 3.0)
MOST_TIMES = 3
SHARDS = 16
BLOCK_WORDS = 16_384
#: Blocks of a source, at most, a power of two; beyond, blocks grow with their source.
MOST_BLOCKS = 4_096
#: Rounds of the permutation of a pass.
ROUNDS = 6
SEED = 10
_SPAN = float(1 << 62)


def n_words(text: Column) -> Column:
    """Words between ASCII white space; null has none."""

    @F.arrow_udf("long")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            raw = batch.cast(pa.binary())
            yield pa.array([len((x.as_py() or b"").split()) for x in raw], pa.int64())

    return of(text)


def filled(sizes: np.ndarray, weights: np.ndarray, most: float = MOST_TIMES) -> np.ndarray:
    """Shares of the total size by weight, none above ``most`` times its own size.

    What a full source cannot take is shared out again by weight among the rest.
    """
    targets = np.zeros(len(sizes))
    caps = most * sizes.astype(float)
    free = np.ones(len(sizes), bool)
    while free.any():
        left = sizes.sum() - caps[~free].sum()
        share = left * weights / weights[free].sum()
        over = free & (share > caps)
        if not over.any():
            targets[free] = share[free]
            break
        free &= ~over
    targets[~free] = caps[~free]
    return targets


class SplittingTree:
    """Splits one source's draws after another among shards with exact capacities."""

    def __init__(self, total: int, shards: int, rng: np.random.Generator) -> None:
        self.rng = rng
        capacity = [total // shards + (i < total % shards) for i in range(shards)]
        self.capacity = np.r_[0, np.cumsum(capacity)]
        self.left: dict[tuple[int, int], int] = {}
        self.all: dict[tuple[int, int], int] = {}

    def split(self, quota: int, low: int = 0, high: int | None = None) -> list[int]:
        """Per shard of ``low:high`` its part of the quota, given what earlier sources took."""
        high = len(self.capacity) - 1 if high is None else high
        if high - low == 1:
            return [quota]
        middle, node = (low + high) // 2, (low, high)
        left = self.left.setdefault(node, int(self.capacity[middle] - self.capacity[low]))
        every = self.all.setdefault(node, int(self.capacity[high] - self.capacity[low]))
        mine = int(self.rng.hypergeometric(quota, every - quota, left)) if left and quota else 0
        self.left[node], self.all[node] = left - mine, every - quota
        return self.split(mine, low, middle) + self.split(quota - mine, middle, high)


def _ordered(sources: pd.DataFrame, by: str = "source") -> pd.DataFrame:
    """By code point, null last."""
    return sources.sort_values(by, na_position="last", kind="stable", key=lambda x: x.map(
        lambda s: s if s is None else s.encode()
    )).reset_index(drop=True)


def _targets(weights: tuple[float, ...], block_words: int):
    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = list(batches)
        if not parts or not sum(map(len, parts)):
            return
        sources = _ordered(pd.concat(parts))
        sizes = sources["source_size"].to_numpy(np.int64)
        weight = np.array(weights)[np.arange(len(sizes)) % len(weights)]
        target = filled(sizes, weight)
        passes = np.where(sizes > 0, np.floor(target / np.maximum(sizes, 1) + 1e-12), 0)
        sources["target"] = target
        sources["passes"] = passes.astype(np.int64)
        sources["rest"] = np.maximum(target - passes * sizes, 0.0)
        bits = np.ceil(np.log2(np.clip(sizes / block_words, 1, MOST_BLOCKS))).astype(np.int64)
        sources["blocks"] = 1 << bits
        sources["side"] = 1 << (bits // 2)
        yield sources

    return of


def _places(shards: int, seed: int):
    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = list(batches)
        if not parts or not sum(map(len, parts)):
            return
        sources = _ordered(pd.concat(parts), "v")
        rng = np.random.default_rng(seed)
        draws = (sources["passes"] * sources["blocks"] + sources["last"] + 1).astype(int)
        tree = SplittingTree(int(draws.sum()), shards, rng)
        sources["ends"] = [np.cumsum(tree.split(int(n))).tolist() for n in draws]
        yield sources[["v", "ends"]]

    return of


_PLAN = "source string, source_size long, target double, passes long, rest double, blocks long, side long"


def _in_order(seed: int, id_col: str, text_col: str) -> Column:
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), id_col, text_col), 2)


def _block(order: Column, blocks: Column) -> Column:
    return F.least(F.floor(order / F.lit(_SPAN) * blocks), blocks - 1)


def _place(block: Column, plan: Column, number: Column | int, seed: int) -> Column:
    """The block's place among all draws of its source, in the pass of that number.

    The block is two numbers, each in turn moved by a hash of the other: a
    permutation of all blocks, for every source and pass another one.
    """
    number = F.lit(number) if isinstance(number, int) else number
    number, side = number.cast("long"), plan["side"]
    across = F.floor(plan["blocks"] / side)

    def moved(pair: Column, k: Column) -> Column:
        """One round. Rounds are steps of a fold, for nested they would double the expression."""
        by = F.xxhash64(
            F.lit(seed + 1), plan["source"], number, k, F.when(k % 2 == 0, pair["low"]).otherwise(pair["high"])
        )
        high = F.when(k % 2 == 0, (pair["high"] + F.pmod(by, across)) % across).otherwise(pair["high"])
        low = F.when(k % 2 == 0, pair["low"]).otherwise((pair["low"] + F.pmod(by, side)) % side)
        return F.struct(high.alias("high"), low.alias("low"))

    start = F.struct(F.floor(block / side).cast("long").alias("high"), (block % side).cast("long").alias("low"))
    end = F.aggregate(
        F.array(*[F.lit(k) for k in range(ROUNDS)]), start, moved, lambda pair: pair["high"] * side + pair["low"]
    )
    return number * plan["blocks"] + end


def planned(
    rows: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    shards: int = SHARDS,
    block_words: int = BLOCK_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """One row per source for stored ``rows`` of (source, size, h): target, passes, what is
    taken of one more pass, and the ends of the shards' shares of its block draws."""
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = written(
        sources.coalesce(1).mapInPandas(_targets(weights, block_words), _PLAN), "targets"
    )
    keyed = rows.join(plan.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
    own = F.struct("source", "blocks", "side")
    place = _place(_block(F.col("h"), F.col("blocks")), own, F.col("passes"), seed)
    keyed = keyed.withColumn("block", place - F.col("passes") * F.col("blocks"))
    so_far = Window.partitionBy("source").orderBy("block")
    sums = keyed.groupBy("source", "block", "rest").agg(F.sum("size").alias("n"))
    ends = sums.withColumn("end", F.sum("n").over(so_far.rowsBetween(Window.unboundedPreceding, 0)))
    # The place of the block in which the target ends, in the last pass, and what stands before it.
    last = written(
        ends.where((F.col("end") > F.col("rest")) & (F.col("rest") > 0))
        .groupBy("source")
        .agg(F.min(F.struct("block", (F.col("end") - F.col("n")).alias("before"))).alias("x"))
        .select(F.col("source").alias("t"), F.col("x.block").alias("last"), "x.before"),
        "last",
    )
    one = keyed.join(last, F.col("source").eqNullSafe(F.col("t")) & (F.col("block") == F.col("last")))
    order = Window.partitionBy("source").orderBy("h", "size").rowsBetween(Window.unboundedPreceding, 0)
    one = one.withColumn("end", F.sum("size").over(order) + F.col("before"))
    one = written(one.select("source", "h", "size", "rest", "before", "end"), "last-blocks")
    whole = one.groupBy("source", "rest", "before").agg(
        F.max(F.when(F.col("end") <= F.col("rest"), F.col("h"))).alias("cut"),
        F.max(F.when(F.col("end") <= F.col("rest"), F.col("end"))).alias("end"),
    )
    gap = whole.select(
        F.col("source").alias("u"), "cut", (F.col("rest") - F.coalesce("end", "before")).alias("gap")
    )
    # One more document of the block, if that comes nearer to the target.
    off = F.abs(F.col("size") - F.col("gap"))
    extra = one.join(gap, F.col("source").eqNullSafe(F.col("u"))).groupBy("u", "cut").agg(
        F.min(
            F.when((F.col("end") > F.col("rest")) & (off < F.col("gap")), F.struct(off, F.col("h")))
        )["h"].alias("extra")
    )
    plan = (
        plan.join(last.select("t", "last"), F.col("source").eqNullSafe(F.col("t")), "left")
        .join(extra, F.col("source").eqNullSafe(F.col("u")), "left")
        .select(*plan.columns, F.coalesce("last", F.lit(-1)).alias("last"), "cut", "extra")
    )
    plan = written(plan, "plan")
    places = plan.select(F.col("source").alias("v"), "passes", "blocks", "last").coalesce(1)
    places = places.mapInPandas(_places(shards, seed), "v string, ends array<long>")
    placed = plan.join(places, F.col("source").eqNullSafe(F.col("v"))).drop("v")
    return written(placed, "mix")


def mixed(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[float, ...] = WEIGHTS,
    shards: int = SHARDS,
    block_words: int = BLOCK_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """``docs`` with a struct ``mix``: size, source_size, target, times, taken, and what
    ``drawn`` places copies by.

    Size is the number of words; a null text has none. Null is a source of its
    own, the last. ``times`` is how often the mix takes the document, 0 to 3,
    and ``taken`` the words of that. A source without words has target zero.
    Rows that repeat id and text are taken alike. Equal tables give equal
    results, however they are stored. A column ``mix`` that was there is replaced.
    """
    sized = docs.withColumns(
        {"__size": n_words(F.col(text_col)), "__h": _in_order(seed, id_col, text_col)}
    )
    rows = written(
        sized.select(
            F.col(source_col).cast("string").alias("source"),
            F.col("__size").alias("size"),
            F.col("__h").alias("h"),
        ),
        "sizes",
    )
    plan = planned(rows, weights, shards, block_words, seed).select(
        F.struct("*").alias("__plan"), F.col("source").alias("__source")
    )
    plan_of, h = F.col("__plan"), F.col("__h")
    block = _block(h, plan_of["blocks"])
    # All draws of the shards together; the last one, if the target ends in it, is a part of its block.
    draws = F.element_at(plan_of["ends"], -1)
    part = (plan_of["last"] >= 0).cast("long")
    cut = F.coalesce(h <= plan_of["cut"], F.lit(False)) | h.eqNullSafe(plan_of["extra"])
    places = F.transform(
        F.array(*[F.lit(n) for n in range(MOST_TIMES)]), lambda n: _place(block, plan_of, n, seed)
    )
    whole = draws - part
    taken = F.filter(places, lambda at: (at < whole) | ((at == whole) & (part == 1) & cut))
    times = F.size(taken).cast("long")
    return (
        sized.join(plan, F.col(source_col).cast("string").eqNullSafe(F.col("__source")))
        .withColumn(
            "mix",
            F.struct(
                F.col("__size").alias("size"),
                plan_of["source_size"].alias("source_size"),
                plan_of["target"].alias("target"),
                times.alias("times"),
                (times * F.col("__size")).alias("taken"),
                h.alias("h"),
                block.alias("block"),
                plan_of["blocks"].alias("blocks"),
                plan_of["side"].alias("side"),
                plan_of["source"].alias("source"),
                plan_of["ends"].alias("ends"),
            ),
        )
        .drop("__size", "__h", "__plan", "__source")
    )


def drawn(mix: DataFrame, seed: int = SEED) -> DataFrame:
    """The rows of ``mixed`` as often as they are taken, with ``shard`` and ``mix_order``.

    The shard is the one whose share of the source's draws the block's place in the
    copy's pass falls into. ``mix_order`` shuffles a shard's rows when they are sorted
    by it.
    """
    m = F.col("mix")
    # A document's copies are of the passes in order: every pass but the last takes all blocks.
    copies = mix.where("mix.times > 0").withColumn(
        "__pass", F.explode(F.sequence(F.lit(0).cast("long"), m["times"] - 1))
    )
    at = F.col("__pass")
    place = _place(m["block"], m, at, seed)
    shard = F.size(F.filter(m["ends"], lambda end: end <= place))
    return copies.withColumns(
        {"shard": shard, "mix_order": F.xxhash64(F.lit(seed), m["h"], at)}
    ).drop("__pass", "mix")


def shuffled_shards(draws: DataFrame, pieces: int = 8) -> DataFrame:
    """The draws with each shard's rows together, in pieces, and in shuffled order."""
    piece = F.pmod(F.col("mix_order"), F.lit(pieces))
    return draws.repartition("shard", piece).sortWithinPartitions("shard", "mix_order")
