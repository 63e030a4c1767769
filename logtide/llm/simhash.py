"""SimHash near-duplicates by anchor-point covering.

Two fingerprints that differ in at most two bits differ in at most one bit in one of their
halves. In a half, 31 bits are covered by the perfect Hamming code of that length: every
pattern is within one bit of exactly one code word, the anchors. A fingerprint is at home at
its nearest anchor and is copied to every anchor within two bits (covering radius plus the
threshold of a half), sixteen at most. The half where a pair differs in at most one bit then
brings them together at the home of either, whatever bit the code leaves out, so no pair is
missed. Fingerprints that meet are compared in full.

Equal fingerprints are one node: copies are never paired. Meeting is an equi-join, whose
large groups adaptive execution splits, and only pairs that pass leave it.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logtide.llm.common import ship, written
from logtide.llm.components import components

CODE_BITS = 31
# Positions 1..31 whose number has bit j: their parity is bit j of the syndrome.
CHECKS = [sum(1 << (p - 1) for p in range(1, CODE_BITS + 1) if p >> j & 1) for j in range(5)]


def fingerprints(docs: DataFrame, shingle: int = 3, marks: tuple[str, ...] = ()) -> DataFrame:
    """Per row of ``docs``: doc_id, ``fp``, the 64-bit SimHash of its whole text as a long, and the long columns ``marks``.

    Null and empty texts, and texts of white space, have fingerprint zero.
    """
    import numpy as np

    ship(docs.sparkSession)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest

        for batch in batches:
            out = []
            for text in batch.column(1).cast(pa.binary()).to_pylist():
                words = (text or b"").lower().split()
                if not words:
                    out.append(0)
                    continue
                joined = b" ".join(words)
                ends = np.cumsum([len(w) + 1 for w in words]) - 1
                starts = np.concatenate(([0], ends[:-1] + 1))
                size = min(shingle, len(words))
                spans = zip(starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist(), strict=True)
                h = np.array([xxh64_intdigest(joined[a:b], 42) for a, b in spans], "<u8")
                ones = np.zeros(64, "int64")
                for at in range(0, len(h), 65536):  # bits of one slice at a time
                    ones += np.unpackbits(h[at : at + 65536].view("u1").reshape(-1, 8), axis=1, bitorder="little").sum(0, "int64")
                bits = np.packbits((2 * ones > len(h)).astype("u1"), bitorder="little")
                out.append(int(bits.view("<i8")[0]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.int64()), *batch.columns[2:]], ["doc_id", "fp", *marks])

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = ", ".join([f"doc_id {kind}", "fp long", *(f"{m} long" for m in marks)])
    return docs.select("doc_id", "text", *marks).mapInArrow(hashed, schema)


def _parity(bits: Column, mask: int) -> Column:
    return F.bit_count(bits.bitwiseAND(F.lit(mask))).bitwiseAND(F.lit(1))


def anchors(fps: DataFrame) -> DataFrame:
    """(half, anchor, fp, home): one home row and the copies of each fingerprint and half."""
    halves = fps.select("fp", F.explode(F.array(F.lit(0), F.lit(1))).alias("half"))
    bits = F.expr("shiftrightunsigned(fp, 32 * half)").bitwiseAND(F.lit((1 << CODE_BITS) - 1))
    halves = halves.withColumn("bits", bits)
    syndrome = sum((_parity(F.col("bits"), mask) * (1 << j) for j, mask in enumerate(CHECKS)), F.lit(0))
    halves = halves.withColumn("s", syndrome.cast("int"))
    # Flip position s to reach the only code word within one bit; flip i and i xor s for
    # those at two bits. A code word (s = 0) has no other within two bits.
    one = F.expr("CASE WHEN s = 0 THEN 0L ELSE shiftleft(1L, s - 1) END")
    two = F.expr(
        f"transform(filter(sequence(1, {CODE_BITS}), i -> s <> 0 AND (i ^ s) > i),"
        " i -> shiftleft(1L, i - 1) | shiftleft(1L, (i ^ s) - 1))"
    )
    flips = F.concat(F.array(one), two)
    spread = halves.select("fp", "half", "bits", F.posexplode(flips).alias("k", "flip"))
    return spread.select("half", F.col("bits").bitwiseXOR(F.col("flip")).alias("anchor"), "fp", (F.col("k") == 0).alias("home"))


def near_pairs(fps: DataFrame, threshold: int = 2) -> DataFrame:
    """(a, b) of different fingerprints at ``threshold`` (at most 2) or fewer differing bits; may repeat."""
    if threshold > 2:
        raise ValueError("the anchors cover two differing bits")
    copies = written(anchors(fps), "anchors")
    home = copies.where("home").select("half", "anchor", F.col("fp").alias("a"))
    guest = copies.select("half", "anchor", F.col("fp").alias("b"))
    close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= threshold
    same = (home["half"] == guest["half"]) & (home["anchor"] == guest["anchor"])
    return home.join(guest, same & (F.col("a") < F.col("b")) & close).select("a", "b")


def near_duplicates(docs: DataFrame, threshold: int = 2) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, fingerprint in hex, component_id.

    Rows link when their fingerprints differ in at most ``threshold`` bits; the component's
    id is its smallest doc_id. Null and empty texts share fingerprint zero and link with each
    other. Rows with a null id link like others but never name a component, unless all are
    null. Repeated rows come out each. Other columns are not read; no rows give no rows.
    """
    rows = written(fingerprints(docs), "fingerprints")
    rooted = _rooted(rows, F.min("doc_id"), threshold)
    names = written(rooted.groupBy("root").agg(F.min("low").alias("component_id")), "names")
    named = written(rooted.join(names, "root").select("fp", "component_id"), "named")
    return rows.join(named, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def _rooted(rows: DataFrame, low: Column, threshold: int) -> DataFrame:
    """fp, low, root for each fingerprint: ``low`` is an aggregate of its ``rows``, the root names its component."""
    nodes = written(rows.groupBy("fp").agg(low.alias("low")), "nodes")
    roots = components(near_pairs(nodes.select("fp"), threshold))
    # Fingerprints without a link are roots of their own.
    rooted = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root")
    )
    return written(rooted, "rooted")


def one_of_each(docs: DataFrame, threshold: int = 2) -> DataFrame:
    """One row of each group of near-duplicates, the one with the smallest doc_id, columns unchanged.

    Null ids come last. If rows repeat an id, the one with the smallest hash of all columns stays.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    # Two hashes of all columns and of which are null, which a hash passes over, tell rows apart.
    every = [*columns, *[c.isNull() for c in columns]]
    marks = [F.xxhash64(F.lit(k), *every).alias(f"k{k}") for k in (1, 2)]
    packed = docs.select(F.struct(*columns).alias("row"), "doc_id", "text", *marks)
    rows = written(fingerprints(packed, marks=("k1", "k2")), "fingerprints")
    key = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "k1", "k2")
    keep = _rooted(rows, F.min(key), threshold).groupBy("root").agg(F.min("low").alias("low")).select("low.k1", "low.k2")
    kept = packed.join(written(keep, "kept"), ["k1", "k2"], "left_semi")
    # Only rows that are the same in all columns are left to share a key.
    return kept.groupBy("k1", "k2").agg(F.first("row").alias("row")).select("row.*")
