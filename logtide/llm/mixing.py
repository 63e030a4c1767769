"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Each source gets a target in words. Its documents are dealt by hash into blocks of about
equal size; whole passes over a source and a last, partial one make its quota of block draws.
A tree splits these quotas among output shards: at each node the draws that go left are one
multivariate-hypergeometric draw, so every shard gets exact quotas that are a fair sample of
the rest. A source's blocks, permuted anew for each pass, are then handed to the shards in
turn, so that draws are disjoint, and a shard shuffles what it holds by hash.

Any number of sources is mixed: their figures stay in a table. The tree splits ``Mix.strata`` quotas
at most; with more sources than that, some share a quota, and as the draws of a quota are in
random order each of them is still split fairly. Only sums, counts of draws per quota and one count per
task go through the driver; parts of the tree are split in tasks of their own.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logtide.llm.common import SPACE, ship, words_of, written

WEIGHTS = (5, 2, 1)
BLOCK_WORDS = 65_536
MAX_BLOCKS = 1_000_000
SHARD_BLOCKS = 256
# Leading bits of the position that tell the runs of a shard apart; one task puts a run in order.
SLICE_BITS = 4
# Shards of the tree that one task splits.
TASK_SHARDS = 64


@dataclass(frozen=True)
class Mix:
    """Weights repeat over the sources in code-point order, null last."""

    weights: tuple[int, ...] = WEIGHTS
    share_percent: int = 150  # of all words
    max_passes: int = 2
    seed: int = 7
    strata: int = 20_000  # quotas that the tree splits, at most


def word_count(text: Column) -> Column:
    return F.size(words_of(text)).cast("long")


def split_quotas(
    quotas: np.ndarray, shards: int, seed: int, first: int = 0, end: int | None = None
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Yield (shard, draws of each quota given to the shards before it, draws it gets) for the
    shards from ``first`` to before ``end``: exact parts of ``quotas`` by the splitting tree."""
    end = shards if end is None else end

    def split(left: np.ndarray, given: np.ndarray, low: int, high: int):
        if high <= first or low >= end:
            return
        if high - low == 1:
            yield low, given, left
            return
        middle = (low + high) // 2
        n = int(left.sum()) * (middle - low) // (high - low)
        # The seed is the node: a part of the tree comes out the same on its own.
        draw = np.random.default_rng([seed, low, high])
        part = _draw(draw, left, n)
        yield from split(part, given, low, middle)
        yield from split(left - part, given + part, middle, high)

    quotas = quotas.astype("int64")
    yield from split(quotas, np.zeros_like(quotas), 0, shards)


def _draw(draw: np.random.Generator, left: np.ndarray, n: int) -> np.ndarray:
    """One multivariate-hypergeometric draw of ``n`` out of ``left``, source after source."""
    part, rest = np.zeros_like(left), int(left.sum())
    for k in np.flatnonzero(left):
        have = int(left[k])
        part[k] = draw.hypergeometric(have, rest - have, n) if n and rest > have else min(n, have)
        rest -= have
        n -= int(part[k])
    return part


def sized(docs: DataFrame, columns: list[str], mix: Mix) -> DataFrame:
    """``row`` (a struct of ``columns``), source, size in words and the hash that deals the row."""
    return docs.select(
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"),
        F.col("source").cast("string").alias("source"),
        F.size(words_of(F.col("text"))).cast("long").alias("size"),
        F.xxhash64(F.lit(mix.seed), "doc_id", "text").alias("h"),
    )


def _numbered(slim: DataFrame) -> DataFrame:
    """Size of each source and its number in code-point order, null last. The sources are sorted in
    parts and the parts counted, so no task holds all of them."""
    found = slim.groupBy("source").agg(F.sum("size").alias("n"))
    ordered = found.orderBy(F.col("source").asc_nulls_last()).withColumn("at", F.monotonically_increasing_id())
    ordered = written(ordered, "sources")  # strings order by code point
    before, starts = 0, []
    for task, n in sorted(ordered.groupBy(F.shiftright("at", 33).alias("task")).count().collect()):
        starts.append((task, before))
        before += n
    starts = slim.sparkSession.createDataFrame(starts, "task long, start long")
    placed = ordered.withColumn("task", F.shiftright("at", 33)).join(F.broadcast(starts), "task")  # a line per task
    return placed.select("source", "n", (F.col("start") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))).alias("s"))


def _level(sources: DataFrame, mix: Mix) -> tuple[Column, float, int, int]:
    """Who is full, the words left for the others, their weight, and all words.

    A source is full when its share by weight is above ``max_passes`` times its size; the excess is
    shared again by weight until none is above. Each round only raises the share of a unit of
    weight, so the full ones are always those above the newest share: one aggregate a round, in
    whole numbers (hundredths of words), and nothing kept but two sums.
    """

    def whole(n: int) -> Column:
        return F.lit(str(n)).cast("decimal(38,0)")

    words, weight = (int(v or 0) for v in sources.agg(F.sum("n"), F.sum("weight")).first())
    rest, others, seen = words * mix.share_percent, weight, 0
    while True:
        full = whole(rest) * F.col("weight") > whole(100 * mix.max_passes) * F.col("n") * whole(others)
        sums = sources.where(full).agg(F.count("*"), F.sum("n"), F.sum("weight")).first()
        count, filled, taken = (int(v or 0) for v in sums)
        if count == seen:
            return full, rest / 100, others, words
        if taken == weight:
            return F.lit(True), 0.0, 1, words
        seen, others = count, weight - taken
        rest = words * mix.share_percent - 100 * mix.max_passes * filled


def _sources(slim: DataFrame, mix: Mix) -> DataFrame:
    """One row per source: number, size, target, blocks, whole passes, words of the partial one."""
    weights = F.array(*map(F.lit, mix.weights))
    turn = (F.pmod("s", F.lit(len(mix.weights))) + 1).cast("int")
    sources = written(_numbered(slim).withColumn("weight", F.element_at(weights, turn)), "numbered")
    full, rest, others, words = _level(sources, mix)
    block_words = max(BLOCK_WORDS, math.ceil(words / MAX_BLOCKS))
    limit = F.lit(mix.max_passes) * F.col("n")
    target = F.when(full, limit.cast("double")).otherwise(F.lit(rest) * F.col("weight") / F.lit(float(others or 1)))
    aimed = sources.withColumn("target", target).withColumn("quota", F.least(F.bround("target").cast("long"), limit))
    aimed = aimed.withColumn("whole", F.when(F.col("n") > 0, F.expr("quota div n")).otherwise(0).cast("int"))
    return written(
        aimed.select(
            "s",
            F.col("source").alias("name"),
            F.col("n").alias("source_size"),
            "target",
            F.greatest(F.lit(1), F.ceil(F.col("n") / block_words)).cast("long").alias("blocks"),
            "whole",
            (F.col("quota") - F.col("whole") * F.col("n")).alias("rest"),
        ),
        "targets",
    )


def _dealt(rows: DataFrame, sources: DataFrame) -> DataFrame:
    # No hint: sources may be many. Few are broadcast by measured size, else a skewed join is split.
    joined = rows.join(sources, F.col("source").eqNullSafe(F.col("name")))
    return joined.withColumn("block", F.pmod("h", "blocks")).drop("source", "name", "blocks")


def _runs(spark: SparkSession, quotas: np.ndarray, seed: int) -> DataFrame:
    """Which run of a quota's draws each shard gets: stratum, low, high (included), shard."""
    shards = max(1, math.ceil(int(quotas.sum()) / SHARD_BLOCKS))
    tasks = math.ceil(shards / TASK_SHARDS)

    def split(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for task in (int(n) for part in parts for n in part["id"]):
            first = task * TASK_SHARDS
            for shard, given, part in split_quotas(quotas, shards, seed, first, min(first + TASK_SHARDS, shards)):
                some = np.flatnonzero(part)
                yield pd.DataFrame(
                    {"stratum": some, "low": given[some], "high": given[some] + part[some] - 1, "shard": shard}
                )

    ship(spark)
    return spark.range(0, tasks, 1, tasks).mapInPandas(split, "stratum long, low long, high long, shard int")


def _placed(blocks: DataFrame, mix: Mix) -> DataFrame:
    """Draws of blocks: s, block, pass, ``part`` (words left of a partly drawn block, else null), shard."""
    n_passes = F.col("whole") + (F.col("rest") > 0).cast("int")
    each = blocks.where(n_passes > 0).withColumn("pass", F.explode(F.sequence(F.lit(1), n_passes)))
    each = each.withColumn("turn", F.xxhash64(F.lit(mix.seed), "s", "pass", "block"))
    # Blocks are permuted anew in each pass. A pass of a source is at most a million blocks.
    order = Window.partitionBy("s", "pass").orderBy("turn", "block")
    before = F.coalesce(F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    each = each.withColumn("left", F.col("rest") - before).where("pass <= whole OR left > 0")
    each = each.withColumn("part", F.when(F.expr("pass > whole AND left < words"), F.col("left")))
    # A quota is one source, or the few of many that fall together.
    each = each.withColumn("stratum", F.pmod("s", F.lit(mix.strata)))
    slots = Window.partitionBy("stratum").orderBy("pass", "turn", "s", "block")
    each = each.withColumn("slot", F.row_number().over(slots).cast("long") - 1)
    each = written(each.select("s", "block", "pass", "part", "stratum", "slot"), "draws")

    counts = each.groupBy("stratum").count().collect()  # at most Mix.strata
    quotas = np.zeros(1 + max((r["stratum"] for r in counts), default=0), "int64")
    for r in counts:
        quotas[r["stratum"]] = r["count"]
    runs = _runs(blocks.sparkSession, quotas, mix.seed)
    shards = runs.select("stratum", "shard", F.explode(F.sequence("low", "high")).alias("slot"))
    return each.join(shards, ["stratum", "slot"]).drop("stratum", "slot")


def drawn(docs: DataFrame, columns: list[str] | None = None, mix: Mix = Mix()) -> DataFrame:
    """What the mix takes of ``docs`` (doc_id, text, source): a line per row.

    Columns: row (a struct of ``columns``, all by default), size, source_size, target (of its
    source), takes: an array with pass, words, shard and position (place in the shard) for
    each draw of the row's block, words being 0 where a partial pass ends before it. Words are runs of non-blanks; null or
    empty text has none. A null source is a source, the last. Rows that repeat are drawn each.
    """
    rows = sized(docs, columns or docs.columns, mix)
    slim = written(rows.select("source", "size", "h"), "sizes")
    return _drawn(rows, slim, mix)


def _drawn(rows: DataFrame, slim: DataFrame, mix: Mix) -> DataFrame:
    sources = _sources(slim, mix)
    dealt = _dealt(slim, sources)
    blocks = dealt.groupBy("s", "block").agg(
        F.sum("size").alias("words"), F.first("whole").alias("whole"), F.first("rest").alias("rest")
    )
    placed = written(_placed(written(blocks, "blocks"), mix), "placed")

    # A partly drawn block, one per source at most, gives its rows in hash order until its
    # words are used up; rows that share the last hash share what is left.
    cut = placed.where("part IS NOT NULL").select("s", "block", "pass", "part")
    upto = Window.partitionBy("s", "pass").orderBy("h").rowsBetween(Window.unboundedPreceding, -1)
    ends = (
        dealt.join(cut, ["s", "block"])
        .groupBy("s", "block", "pass", "part", "h")
        .agg(F.sum("size").alias("n"), F.count("*").alias("ties"))
        .withColumn("left", F.col("part") - F.coalesce(F.sum("n").over(upto), F.lit(0)))
        .where("left > 0 AND left <= n")
        .selectExpr("s", "block", "pass", "h AS end", "left div ties AS end_words")
    )
    draws = placed.join(ends, ["s", "block", "pass"], "left").groupBy("s", "block").agg(
        F.collect_list(F.struct("pass", "shard", "end", "end_words")).alias("draws")  # one for each pass
    )
    draws = written(draws, "block-draws")
    each = _dealt(rows, sources).join(draws, ["s", "block"], "left")

    def take(draw: Column) -> Column:
        words = (
            F.when(draw["end"].isNull() | (F.col("h") < draw["end"]), F.col("size"))
            .when(F.col("h") == draw["end"], F.least("size", draw["end_words"]))
            .otherwise(0)
        )
        position = F.xxhash64(F.lit(mix.seed), draw["shard"], draw["pass"], F.col("h"))
        return F.struct(
            draw["pass"].alias("pass"), draw["shard"].alias("shard"), words.alias("words"), position.alias("position")
        )

    none = F.expr("cast(array() as array<struct<pass: int, shard: int, end: bigint, end_words: bigint>>)")
    takes = F.transform(F.coalesce("draws", none), take)
    return each.select("row", "size", "source_size", "target", takes.alias("takes"))


def mix_report(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """Per row of ``docs``: doc_id, size, source_size, target (its source's), taken, and for each time
    that words of it are drawn the shard and the position inside it (``shards``, ``positions``).

    Null and empty texts have size 0 and are never taken; rows that repeat are reported each; rows
    of one position are in any order; an empty table gives no rows.
    """
    rows = written(sized(docs, ["doc_id"], mix), "sizes")
    return _drawn(rows, rows, mix).select(
        "row.doc_id",
        "size",
        "source_size",
        "target",
        F.aggregate("takes", F.lit(0).cast("long"), lambda n, t: n + t["words"]).alias("taken"),
        F.transform(F.filter("takes", lambda t: t["words"] > 0), lambda t: t["shard"]).alias("shards"),
        F.transform(F.filter("takes", lambda t: t["words"] > 0), lambda t: t["position"]).alias("positions"),
    )


def mixed(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """The mix itself, in the columns of ``docs``: a row for each time it is drawn.

    Shards are shuffled: rows come by shard and, inside it, by hash. A shard is cut into 16 runs of
    positions, each in order in one task, so its size in text does not bound a task.
    A row drawn in part keeps its first words, up to the end of the last one taken, and its
    n_chars, where there is one, follows. Rows without words are drawn with their block.
    """
    each = drawn(docs, mix=mix).select("row", "size", F.explode("takes").alias("take")).where("take.words > 0 OR size = 0")
    run = F.shiftright("take.position", 64 - SLICE_BITS)
    each = each.repartition(F.col("take.shard"), run).sortWithinPartitions("take.shard", "take.position")
    text, words = F.col("row.text"), F.col("take.words").cast("int")
    whole = F.col("take.words") == F.col("size")
    # Words and the blanks between them alternate; a cut row keeps whole words and their blanks.
    tokens = F.regexp_extract_all(text, F.lit("(" + SPACE + ")?([^\\x20\\x09-\\x0D]+)"), F.lit(0))
    shorter = F.when(whole, text).otherwise(F.array_join(F.slice(tokens, 1, words), ""))
    kept = each.withColumn("cut_text", shorter)
    columns = []
    for name in docs.columns:
        column = F.col(f"row.`{name}`")
        if name == "text":
            column = F.col("cut_text")
        elif name == "n_chars":
            column = F.when(whole, column).otherwise(F.length("cut_text")).cast(docs.schema[name].dataType)
        columns.append(column.alias(name))
    return kept.select(*columns)
