"""Filter interaction audit: contingency tensors, contracted once per part.

Which of five filters a document fails is all that any order of them depends on. Documents are
counted into 2x2x2x2x2 cells per part (combined before the shuffle, 32 rows a part at most).
A contraction takes, along each axis, those that pass, those that fail or all; every figure of
every step of every order is one of these contractions.
"""

from __future__ import annotations

from itertools import permutations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logtide.llm.common import ship, words_of, written

FILTERS = "ABCDE"
FAILS = [f"fails_{f}" for f in FILTERS]
MEASURES = ["n", "good", "toxic"]
PASS, FAIL, ALL = range(3)
AUDIT = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
    "good_lost long, toxic_lost long, shapley long"
)


def failures(docs: DataFrame) -> DataFrame:
    """doc_id, part (lang), two hashes of the text and the failures of A to D, per row of ``docs``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id", F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"), text.alias("text"), words_of(text).alias("words")
    )
    n, capitals = F.size("words").cast("long"), F.length(F.regexp_replace("text", "[^A-Z]+", ""))
    return rows.select(
        "doc_id",
        "part",
        *[F.xxhash64(F.lit(k), "text").alias(f"k{k}") for k in (1, 2)],
        (n < 200).alias("fails_A"),
        (100 * F.size(F.array_distinct("words")).cast("long") < 50 * n).alias("fails_B"),
        (100 * capitals.cast("long") > 3 * F.length("text").cast("long")).alias("fails_C"),
        F.col("text").rlike("[#$%&*|]").alias("fails_D"),
    )


def cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents, good and toxic ones, per part and combination of failures.

    E joins on text and id together, so a text with very many copies is no hot key.
    """
    rows = written(failures(docs), "failures")
    first = rows.groupBy("k1", "k2").agg(F.min("doc_id").alias("low")).withColumn("is_first", F.lit(True))
    first = first.withColumnsRenamed({"k1": "f1", "k2": "f2"})
    same = (F.col("k1") == F.col("f1")) & (F.col("k2") == F.col("f2")) & F.col("doc_id").eqNullSafe(F.col("low"))
    marks = labels.groupBy(F.col("doc_id").alias("labelled")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    joined = rows.join(first, same, "left").join(marks, F.col("doc_id") == F.col("labelled"), "left")
    joined = joined.withColumn("fails_E", F.col("is_first").isNull())
    return joined.groupBy("part", *FAILS).agg(
        F.count("*").alias("n"),
        *[F.sum(F.coalesce(m, F.lit(0))).cast("long").alias(m) for m in MEASURES[1:]],
    )


def contracted(part: pd.DataFrame) -> pd.DataFrame:
    """The 600 rows of one part from its cells (at most 32 rows)."""
    import numpy as np

    tensor = np.zeros((len(MEASURES), *[2] * len(FILTERS)), "int64")
    tensor[(slice(None), *part[FAILS].to_numpy("int64").T)] = part[MEASURES].to_numpy("int64").T
    select = np.array([[1, 0], [0, 1], [1, 1]])  # pass, fail, all
    # One contraction for every choice of pass, fail or all on the five axes.
    chosen = np.einsum("mabcde,va,wb,xc,yd,ze->mvwxyz", tensor, *[select] * len(FILTERS))

    def of(measure: str, passing=(), failing=(), rest: int = ALL) -> int:
        axes = [PASS if f in passing else FAIL if f in failing else rest for f in FILTERS]
        return int(chosen[(MEASURES.index(measure), *axes)])

    out, share = [], dict.fromkeys(FILTERS, 0)
    for order in permutations(FILTERS):
        for step, f in enumerate(order):
            removed = of("n", order[:step], f)
            share[f] += removed
            lost = [of(m, order[:step], f) for m in MEASURES[1:]]
            redundant, alone = of("n", failing=f) - removed, of("n", failing=f, rest=PASS)
            out.append([part["part"].iloc[0], "".join(order), step + 1, of("n", order[: step + 1]), removed, redundant, alone, *lost, f])
    for row in out:
        row[-1] = share[row[-1]]
    return pd.DataFrame(out, columns=[c.split()[0] for c in AUDIT.split(", ")])


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the five filters and step.

    ``docs`` has doc_id, text, lang; ``labels`` has doc_id, quality, toxic. Filters, by what
    fails them: A under 200 words; B fewer distinct words than half; C more than 3 % capitals
    A-Z; D any of ``#$%&*|``; E a text that a smaller doc_id has.

    Null text is empty, null lang the part named by the empty string (with rows whose lang is
    empty). A null doc_id comes after all others for E and has no labels; rows that share an
    id and a text are counted each, none being smaller. Of repeated labels of an id one with
    the value 1 counts; null labels count as 0. Texts of any length are read whole. No
    documents give no rows. Other columns are not read.
    """
    ship(docs.sparkSession)
    return cells(docs, labels).groupBy("part").applyInPandas(contracted, AUDIT)
