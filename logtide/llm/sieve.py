"""A sieve of fixed size in front of a join.

Keys set bits in a table of at most ``SLOTS`` rows, whatever their number, so it may be
broadcast. Rows whose bit is not set have no partner and need no shuffle; the others go on to
the join, which decides. The more keys, the less is held back; nothing is lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLOT_BITS = 19
SLOTS = 1 << SLOT_BITS  # of 64 bits each: 8 MB


def _place(h: Column) -> tuple[Column, Column]:
    return h.bitwiseAND(F.lit(SLOTS - 1)), F.shiftright(h, SLOT_BITS).bitwiseAND(F.lit(63)).cast("int")


def sifted(rows: DataFrame, h: Column, keys: DataFrame, key: Column) -> DataFrame:
    """``rows`` with ``maybe``: false where no row of ``keys`` has the hash ``h`` (a 64-bit ``key`` there).

    A null hash is never in the sieve.
    """
    slot, bit = _place(key)
    slots = keys.select(slot.alias("sieve_slot"), bit.alias("sieve_bit")).groupBy("sieve_slot").agg(
        F.bit_or(F.expr("shiftleft(1L, sieve_bit)")).alias("sieve_bits")
    )
    slot, bit = _place(h)
    met = rows.withColumns({"sieve_at": slot, "sieve_bit": bit}).join(
        F.broadcast(slots), F.col("sieve_at") == F.col("sieve_slot"), "left"
    )
    maybe = F.coalesce(F.getbit("sieve_bits", F.col("sieve_bit")) == 1, F.lit(False))
    return met.withColumn("maybe", maybe).drop("sieve_at", "sieve_slot", "sieve_bit", "sieve_bits")
