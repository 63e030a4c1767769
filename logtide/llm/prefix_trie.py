"""Prefix trie of conversations, its subtree totals by a roll-up over depth bands.

A node is a distinct sequence of first turns, known by 128 bits: hashes of its turns, each
together with its place, combined by exclusive or. So the key of a prefix comes from running
combinations, which are cut into blocks; no conversation has to fit into one task.

Depths are cut into bands. Inside a band every node sends what it counts to its ancestors
there, as many copies at most as the band is high. The roots of the bands, one table per band,
then collect from the deepest band upwards, and each completed total goes once to the ancestors
in the band above. Rounds are depth over height, and copies of a node at most the height.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logtide.llm.common import ship, words_of, written
from logtide.session import scratch_dir

FAMILY = 20  # a conversation shares turns with the one whose id is the multiple of this below
LONGEST = 3  # most turns that are shared
BLOCK_BITS = 10
BLOCK = 1 << BLOCK_BITS  # turns of a conversation, and ids of a digest, that are handled together
FIRST_BLOCK = -(1 << 62)
KEY = ["p1", "p2"]


def said(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, block, two hashes of role and text, and the words of the text, per row with a conv_id."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turn = F.col("turn").cast("long")
    return conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        turn.alias("turn"),
        # Without a turn number first: a block below all others.
        F.coalesce(F.shiftright(turn, BLOCK_BITS), F.lit(FIRST_BLOCK)).alias("block"),
        *[F.xxhash64(F.lit(k), role, text).alias(f"h{k}") for k in (1, 2)],
        F.size(words_of(text)).cast("long").alias("words"),
    )


def _before(order: str):
    return Window.partitionBy("conv_id").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)


def _families(blocks: DataFrame) -> DataFrame:
    """conv_id, base, shared (turns asked of the base), taken (turns it has), length once rebuilt."""
    convs = blocks.groupBy("conv_id").agg(F.sum("n").alias("n")).withColumns(
        {
            "base": F.col("conv_id") - F.col("conv_id") % FAMILY,
            "shared": F.crc32(F.col("conv_id").cast("string").cast("binary")) % (LONGEST + 1),
        }
    )
    bases = convs.where("conv_id = base").select("base", F.least("n", F.lit(LONGEST)).alias("n_base"))
    taken = F.least("shared", F.coalesce("n_base", F.lit(0)))
    rest = F.greatest(F.col("n") - F.col("shared"), F.lit(0))
    return convs.join(bases, "base", "left").select("conv_id", "base", "shared", taken.alias("taken"), (taken + rest).alias("length"))


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns (conv_id, pos from 1, h1, h2, words, ends) and conversations (conv_id, length) after rebuilding."""
    rows = written(said(conversations), "said")
    blocks = written(rows.groupBy("conv_id", "block").agg(F.count("*").alias("n")), "blocks")
    convs = written(_families(blocks), "families")
    # Where a block starts is known from the counts, so turns are numbered block by block.
    starts = blocks.withColumn("start", F.coalesce(F.sum("n").over(_before("block")), F.lit(0))).drop("n")
    starts = starts.join(convs.drop("base"), "conv_id")
    inside = Window.partitionBy("conv_id", "block").orderBy("turn", "h1", "h2")
    placed = rows.withColumn("at", F.row_number().over(inside)).join(starts, ["conv_id", "block"])
    placed = written(placed.withColumn("at", F.col("start") + F.col("at")).drop("start", "block", "turn"), "placed")
    own = placed.where("at > shared").withColumn("pos", F.col("taken") + F.col("at") - F.col("shared"))
    # At most LONGEST turns of a base, each for less than two times FAMILY conversations.
    heads = placed.where(f"conv_id % {FAMILY} = 0 AND at <= {LONGEST}").select(F.col("conv_id").alias("base"), "at", "h1", "h2", "words")
    lent = heads.join(convs, "base").where("at <= shared").withColumn("pos", F.col("at"))
    columns = ["conv_id", "pos", "h1", "h2", "words", (F.col("pos") == F.col("length")).alias("ends")]
    return own.select(*columns).union(lent.select(*columns)), convs.select("conv_id", "length")


def prefixes(turns: DataFrame, height: int) -> DataFrame:
    """conv_id, depth, key, words, ends and path per turn: path holds the keys of the proper ancestors from
    the root of the parent's band down to the parent."""
    tagged = turns.withColumn("block", F.shiftright(F.col("pos") - 1, BLOCK_BITS)).withColumns(
        {f"t{k}": F.xxhash64(F.lit(k), "pos", "h1", "h2") for k in (1, 2)}
    )
    blocks = tagged.groupBy("conv_id", "block").agg(*[F.bit_xor(f"t{k}").alias(f"x{k}") for k in (1, 2)])
    above = blocks.select("conv_id", "block", *[F.bit_xor(f"x{k}").over(_before("block")).alias(f"o{k}") for k in (1, 2)])
    inside = Window.partitionBy("conv_id", "block").orderBy("pos")
    so_far = inside.rowsBetween(Window.unboundedPreceding, 0)
    rows = tagged.withColumns({f"p{k}": F.bit_xor(f"t{k}").over(so_far) for k in (1, 2)})
    rows = rows.join(above.where("block > 0"), ["conv_id", "block"], "left").withColumns(
        {f"p{k}": F.col(f"p{k}").bitwiseXOR(F.coalesce(f"o{k}", F.lit(0))) for k in (1, 2)}
    )
    parent = F.struct(*[F.col(f"p{k}").bitwiseXOR(F.col(f"t{k}")).alias(f"p{k}") for k in (1, 2)])
    # A band starts after a multiple of the height; blocks hold whole bands.
    last = F.collect_list(parent).over(inside.rowsBetween(1 - height, 0))
    in_band = ((F.col("pos") - 1) % height + 1).cast("int")
    return rows.select(
        "conv_id", F.col("pos").alias("depth"), *KEY, "words", "ends", F.slice(last, -in_band, in_band).alias("path")
    )


def _nodes(rows: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per node with its members, smallest member and children, and that of its parent."""
    root = convs.agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id")).where("n_convs > 0")
    root = root.select(
        *[F.lit(0).cast("long").alias(k) for k in KEY], F.lit(0).cast("long").alias("depth"), "conv_id", "n_convs",
        F.lit(0).cast("long").alias("words"), F.array().cast("array<struct<p1:bigint,p2:bigint>>").alias("path"),
    )
    found = rows.groupBy(*KEY).agg(
        F.max("depth").alias("depth"),
        F.min("conv_id").alias("conv_id"),
        F.count("*").alias("n_convs"),
        F.max("words").alias("words"),
        F.first("path").alias("path"),  # the same for all members
    )
    nodes = written(found.select(root.columns).union(root), "nodes")
    parent = F.element_at("path", -1)
    below = nodes.where("depth > 0").select("*", parent["p1"].alias("u1"), parent["p2"].alias("u2"))
    children = below.groupBy("u1", "u2").agg(F.count("*").alias("n_children")).withColumnsRenamed({"u1": "p1", "u2": "p2"})
    parents = nodes.select(F.col("p1").alias("u1"), F.col("p2").alias("u2"), F.col("conv_id").alias("parent_conv_id"))
    both = below.join(parents, ["u1", "u2"], "left").drop("u1", "u2")
    both = both.unionByName(nodes.where("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long")))
    both = both.join(children, KEY, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    return written(
        both.withColumns({"leaves": (F.col("n_children") == 0).cast("long"), "saved": (F.col("n_convs") - 1) * F.col("words")}),
        "nodes",
    )


def _sums(rows: DataFrame, key: Column) -> DataFrame:
    picked = rows.select(key.alias("k"), "leaves", "saved").select("k.*", "leaves", "saved")
    return picked.groupBy(*KEY).agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))


def band_totals(nodes: DataFrame, height: int, deepest: int) -> DataFrame:
    """Key, leaves and saved, summed over the subtree of each node.

    ``nodes`` has key, depth, path, and what each node counts itself (leaves, saved).
    """
    top = F.get("path", F.lit(0))
    roots = nodes.where(F.col("depth") % height == 0).withColumn("band", (F.col("depth") / height).cast("int"))
    others = nodes.where(F.col("depth") % height != 0)
    gathered = _sums(others, top).withColumnsRenamed({"leaves": "l", "saved": "s"})
    roots = roots.join(gathered, KEY, "left").select(
        *KEY, "band", "path",
        (F.col("leaves") + F.coalesce("l", F.lit(0))).alias("leaves"), (F.col("saved") + F.coalesce("s", F.lit(0))).alias("saved"),
    )
    folder = scratch_dir(nodes.sparkSession, "roots")
    roots.write.partitionBy("band").parquet(folder)
    bands = nodes.sparkSession.read.schema(roots.schema).parquet(folder)
    done, arrived = [], None
    for band in range(deepest // height, 0, -1):  # the root of all needs no total before the last step
        now = bands.where(F.col("band") == band).drop("band")
        if arrived is not None:
            now = now.join(arrived, KEY, "left").select(
                *KEY, "path", *[(F.col(c) + F.coalesce(n, F.lit(0))).alias(c) for c, n in (("leaves", "l"), ("saved", "s"))]
            )
        done.append(written(now, "band"))
        arrived = _sums(done[-1], top).withColumnsRenamed({"leaves": "l", "saved": "s"})
    sent = others.select("path", "leaves", "saved")
    for total in done:
        sent = sent.union(total.select("path", "leaves", "saved"))
    sent = sent.select(F.explode("path").alias("k"), "leaves", "saved").select("k.*", "leaves", "saved")
    every = nodes.select(*KEY, "leaves", "saved").union(sent)
    return every.groupBy(*KEY).agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))


def digests(ends: DataFrame) -> DataFrame:
    """Key and SHA-256 of the ascending conv_ids, joined by commas, of those that end at a node.

    Blocks of ids are joined to text in parallel; a task then feeds the blocks of a node to the
    hash one after the other and holds one batch of them.
    """
    blocks = ends.groupBy(*KEY, F.shiftright("conv_id", BLOCK_BITS).alias("block")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda i: i.cast("string")), ",").alias("ids")
    )

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist(
                [{"p1": k[0], "p2": k[1], "ends_sha256": h.hexdigest()} for k, h in rows],
                pa.schema([("p1", pa.int64()), ("p2", pa.int64()), ("ends_sha256", pa.string())]),
            )

        key, state, out = None, None, []
        for part in batches:
            for p1, p2, _, ids in zip(*(c.to_pylist() for c in part.columns), strict=True):
                if (p1, p2) == key:
                    state.update(b"," + ids.encode())
                    continue
                if state is not None:
                    out.append((key, state))
                key, state = (p1, p2), hashlib.sha256(ids.encode())
            yield batch(out)
            out = []
        if state is not None:
            yield batch([(key, state)])

    ordered = blocks.repartition(*KEY).sortWithinPartitions(*KEY, "block")
    return ordered.mapInArrow(hashed, "p1 long, p2 long, ends_sha256 string")


def prefix_trie(conversations: DataFrame, height: int = 8) -> DataFrame:
    """One row per node of the trie of rebuilt conversations.

    ``conversations`` has conv_id, turn, role, text. ``height`` (a power of two up to 1024) is the
    least height of a band; it is doubled until rounds are no more than levels of a band, or 1024.

    Null roles and texts are empty. Turns without a number come first; turns of a conversation
    with the same number follow each other in an order fixed by their content, repeated rows are
    turns of their own. Rows without a conv_id belong to no conversation and are left out. Texts
    of any length are read whole. No conversations give no rows, not even a root. Other columns
    are not read.
    """
    if height not in {1 << k for k in range(BLOCK_BITS + 1)}:
        raise ValueError(f"height {height} is no power of two up to {BLOCK}")
    ship(conversations.sparkSession)
    turns, convs = rebuilt(conversations)
    convs = written(convs, "conversations")
    deepest = convs.agg(F.max("length")).first()[0] or 0
    while height * height < deepest and height < BLOCK:
        height *= 2
    rows = written(prefixes(turns, height), "prefixes")
    nodes = _nodes(rows, convs)
    nothing = [F.lit(0).cast("long").alias(k) for k in KEY]
    ends = rows.where("ends").select(*KEY, "conv_id").union(convs.where("length = 0").select(*nothing, "conv_id"))
    joined = nodes.join(band_totals(nodes, height, deepest), KEY).join(digests(ends), KEY, "left")
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    return joined.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", empty).alias("ends_sha256"),
    )
