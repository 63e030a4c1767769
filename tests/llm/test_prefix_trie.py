"""The trie of conversations against one built node by node."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from samples import sorted_rows

from logtide.llm.prefix_trie import prefix_trie

TURN_DDL = "conv_id BIGINT, turn BIGINT, role STRING, text STRING, depth STRING, p1 INT, path STRING, words STRING, block INT"


def trie_by_hand(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns, key=lambda t: t[:2])] for c, turns in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 4
        turns = own.get(c - c % 20 if c >= 0 else c + -c % 20, [])[:h] + own[c][h:]
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    below = defaultdict(list)
    for k in members:
        if k:
            below[k[:-1]].append(k)
    leaves, saved = {}, {}
    for k in sorted(members, key=len, reverse=True):
        leaves[k] = sum(leaves[b] for b in below[k]) or 1
        words = len(re.findall(r"[^\x20\x09-\x0d]+", k[-1][1])) if k else 0
        saved[k] = (len(members[k]) - 1) * words + sum(saved[b] for b in below[k])
    for k, own_members in members.items():
        digest = hashlib.sha256(",".join(map(str, ends[k])).encode()).hexdigest()
        up = members[k[:-1]][0] if k else None
        yield own_members[0], len(k), up, len(own_members), len(below[k]), leaves[k], saved[k], digest


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y", "z", 2) for r in rows], TURN_DDL).repartition(4)


def check(spark, rows, **options):
    found = prefix_trie(frame(spark, rows), **options)
    assert sorted_rows(found.collect()) == sorted_rows(trie_by_hand(rows))
    return found


def drawn(seed, conversations, longest):
    draw, rows = random.Random(seed), []
    for c in conversations:
        for turn in range(draw.randint(1, longest)):
            role = draw.choice(["user", "assistant", None])
            rows.append((c, turn, role, draw.choice(["yes no", "a  b\tc", "", None, "d"])))
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("height", [1, 2, 4, 8])
def test_trie(spark, height):
    check(spark, drawn(1, [*range(70), *range(101, 130), *range(-45, -15)], 12), height=height)


def test_odd_rows(spark):
    rows = drawn(2, range(25), 3)
    rows += [(None, 0, "user", "lost"), (40, None, "user", "first"), (40, 0, "user", "x"), (40, None, None, None)][:3]
    # Without a base and with no more turns than it should share: no turns are left.
    rows += [(c, 0, "user", "only") for c in range(61, 80)]
    rows += [(200, k, "user", "long " * 50_000) for k in range(2)]
    found = check(spark, rows)
    assert found.where("depth = 0").first()["n_children"] > 1
    assert prefix_trie(frame(spark, [])).count() == 0
    assert prefix_trie(frame(spark, [(None, 1, "user", "x")])).count() == 0


def test_turns_with_the_same_number(spark):
    """Any fixed order will do, the same for the same content."""
    rows = [(c, 0, "user", t) for c in (20, 40, 60) for t in ("b", "a", "a", "c")]
    found = prefix_trie(frame(spark, rows))
    assert found.count() == 5 and {r["n_convs"] for r in found.collect()} == {3}


def test_long_and_many(spark):
    """More turns and members than a block holds, and a first turn that all share."""
    rows = [(0, k, "user", f"t{k % 7}") for k in range(2600)] + [(20, k, "user", f"t{k % 7}") for k in range(2500)]
    rows += [(1000 + k, 0, "user", "hello") for k in range(0, 60_000, 20)]
    check(spark, rows)


def test_height(spark):
    with pytest.raises(ValueError):
        prefix_trie(frame(spark, []), height=3)
