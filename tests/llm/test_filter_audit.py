"""The audit of filters against filters applied one document at a time."""

import re
from collections import Counter, defaultdict
from itertools import permutations

import pytest
from samples import DOC_DDL, PROSE, doc, sorted_rows

from logtide.llm.filter_audit import filter_audit

LABELS = "doc_id BIGINT, quality INT, toxic INT, part STRING, low INT, n INT"


def fails(rows):
    lows = {}
    for i, text, _ in rows:
        if i is not None:
            lows[text or ""] = min(i, lows.get(text or "", i))
    for i, text, lang in rows:
        text = text or ""
        words, low = re.findall(r"[^\x20\x09-\x0d]+", text), lows.get(text)
        yield i, lang or "", {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
            "D": bool(re.search("[#$%&*|]", text)),
            "E": low is not None and (i is None or i > low),
        }


def audit_by_hand(rows, good, toxic):
    checked, out, share = list(fails(rows)), [], Counter()
    for part in {p for _, p, _ in checked}:
        own = [(i, f) for i, p, f in checked if p == part]
        for order in permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [(i, b) for i, b in left if b[f]]
                left = [(i, b) for i, b in left if not b[f]]
                failing = sum(b[f] for _, b in own)
                alone = sum(b[f] and sum(b.values()) == 1 for _, b in own)
                lost = [sum(i in ids for i, _ in gone) for ids in (good, toxic)]
                share[part, f] += len(gone)
                out.append([part, "".join(order), step, len(left), len(gone), failing - len(gone), alone, *lost, f])
    return [(*row[:-1], share[row[0], row[-1]]) for row in out]


def check(spark, table, labels):
    rows = [tuple(r) for r in table.select("doc_id", "text", "lang").collect()]
    good, toxic = ({r[0] for r in labels if r[k] == 1 and r[0] is not None} for k in (1, 2))
    found = filter_audit(table, spark.createDataFrame([(*r, "x", 1, 2) for r in labels], LABELS))
    assert sorted_rows(found.collect()) == sorted_rows(audit_by_hand(rows, good, toxic))
    return found


def test_odd_rows(spark, odd):
    labels = [(5, 1, 0), (5, 0, 1), (6, None, 1), (7, 1, None), (None, 1, 1), (99, 1, 1)]
    assert check(spark, odd, labels).count() == 600


def test_copies_and_parts(spark):
    many = PROSE.replace(".", "") * 4
    lower = " ".join(f"w{k}" for k in range(250))
    texts = [many, lower, lower + " #", lower.upper(), "", None, lower + "\U0001f600", PROSE * 3]
    rows = [doc(i, texts[i % len(texts)]) for i in range(60)] + [doc(None, lower), doc(None, "alone"), doc(1, lower)]
    rows = [(r[0], r[1], [None, "", "en", "de"][k % 4], *r[3:]) for k, r in enumerate(rows)]
    found = check(spark, spark.createDataFrame(rows, DOC_DDL).repartition(5), [(i, i % 2, int(i % 3 == 0)) for i in range(0, 60, 4)])
    assert found.count() == 3 * 600
    parts = defaultdict(int)
    for r in found.where("step = 5").collect():
        parts[r["part"]] += 1
    assert parts == {"": 120, "en": 120, "de": 120}


def test_sums_agree(spark, docs):
    """What all steps of an order remove and what is kept at its end are all documents."""
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    found = filter_audit(docs, labels).toPandas()
    total = docs.groupBy("lang").count().toPandas().set_index("lang")["count"]
    by = found.groupby(["part", "filter_order"])
    kept = found[found.step == 5].set_index(["part", "filter_order"]).kept
    assert (by.removed.sum() + kept == [total[p] for p, _ in kept.index]).all()
    assert (found[found.step == 1].redundant == 0).all()


@pytest.mark.parametrize("rows", [[], [doc(None, None)]])
def test_few_rows(spark, rows):
    table = spark.createDataFrame([(*r[:2], None, *r[3:]) for r in rows], DOC_DDL)
    assert filter_audit(table, spark.createDataFrame([], LABELS)).count() == 600 * len(rows)
