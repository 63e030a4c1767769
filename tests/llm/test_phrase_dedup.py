"""Substring dedup against a search window by window."""

import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F
from samples import DOC_DDL, PROSE, doc, sorted_rows

from logtide.llm import phrase_dedup
from logtide.llm.phrase_dedup import substring_dedup
from logtide.llm.sieve import sifted


def cut_by_hand(rows, window=20):
    """A null id is larger than all others; equal ids are not earlier than each other."""
    split = [(i, (text or "").encode().split()) for i, text in rows]
    smallest = defaultdict(lambda: (2, 0))
    order = lambda i: (1, 0) if i is None else (0, i)
    for i, words in split:
        for at in range(len(words) - window + 1):
            key = tuple(words[at : at + window])
            smallest[key] = min(smallest[key], order(i))
    for i, words in split:
        gone, seen = set(), set()
        for at in range(len(words) - window + 1):
            key = tuple(words[at : at + window])
            if key in seen or smallest[key] < order(i):
                gone.update(range(at, at + window))
            seen.add(key)
        kept = b" ".join(w for k, w in enumerate(words) if k not in gone)
        yield i, len(words), len(gone), hashlib.sha256(kept).hexdigest()


def check(table, **options):
    rows = [tuple(r) for r in table.select("doc_id", "text").collect()]
    want = list(cut_by_hand(rows, options.get("window", 20)))
    assert sorted_rows(substring_dedup(table, **options).collect()) == sorted_rows(want)
    return sum(w[2] for w in want)


def corpus(seed, n=160):
    draw = random.Random(seed)
    word = lambda: f"w{draw.randrange(400)}"
    pieces = [[word() for _ in range(draw.choice([12, 19, 20, 21, 45, 90, 300]))] for _ in range(14)]
    rows = []
    for i in range(n):
        words = []
        for _ in range(draw.randint(0, 4)):
            piece = list(draw.choice(pieces))
            if draw.random() < 0.3:
                piece[draw.randrange(len(piece))] = word()
            words += piece + [word() for _ in range(draw.randint(0, 40))]
        if draw.random() < 0.1:
            words = ["ha"] * draw.randint(1, 500)
        text = "".join(w + draw.choice([" ", "\n", " \t"]) for w in words)
        rows.append(doc(draw.choice([i, i, i, None, 7]), text))
    draw.shuffle(rows)
    return rows + rows[:5] + [doc(999, rows[3][1])]


def test_odd_rows(odd, none):
    assert check(odd) > 0
    assert substring_dedup(none).count() == 0


@pytest.mark.parametrize("seed, window, phrase", [(1, 20, 8), (2, 20, 8), (3, 5, 2), (4, 20, 20), (5, 3, 1)])
def test_drawn(spark, seed, window, phrase):
    assert check(spark.createDataFrame(corpus(seed), DOC_DDL).repartition(6), window=window, phrase=phrase) > 1000


def test_shard():
    """A phrase that one document of a shard brings is found in the others."""
    words = [w.encode() for w in PROSE.split()[:40]]
    shard = [(words, [*range(33)], []), (words[5:35], [], []), ([b"x"] * 30, [], [])]
    found = [(starts, again) for _, starts, again in phrase_dedup.locate(shard, 20, 8)]
    assert found == [([*range(21)], []), ([*range(11)], []), ([], [])]


def test_sieve_holds_back_no_partner(spark):
    keys = spark.range(0, 4000, 8).select(F.xxhash64("id").alias("h"))
    rows = spark.range(4000).withColumn("h", F.xxhash64("id")).union(spark.range(1).withColumn("h", F.lit(None).cast("long")))
    passed = {r["id"]: r["maybe"] for r in sifted(rows.where("h IS NOT NULL"), F.col("h"), keys, F.col("h")).collect()}
    assert all(passed[i] for i in range(0, 4000, 8)) and sum(passed.values()) < 600
    assert not sifted(rows.where("h IS NULL"), F.col("h"), keys, F.col("h")).first()["maybe"]


def test_automaton_finds_every_occurrence():
    words = [f"w{k}".encode() for k in range(30)]
    twice = words[5:15] + words + [b"x"] * 3 + words
    digests, starts, again = next(iter(phrase_dedup.locate([(twice, [2], [])], 10, 5)))
    # The phrase stands at 2, 17 and 50, in windows of ten words that start up to five before.
    assert set(starts + again) <= {*range(0, 3), *range(12, 18), *range(45, 51)}
    # Windows that name it do so wherever they stand.
    assert {i + 33 for i in starts if i >= 12} == {i for i in again if i >= 45} and len(set(digests)) == len(starts)


def test_sizes(spark):
    with pytest.raises(ValueError):
        substring_dedup(spark.createDataFrame([], DOC_DDL), window=5, phrase=6)
