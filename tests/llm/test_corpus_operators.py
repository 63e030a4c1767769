"""Operators on whole corpora against brute force, and the pipeline."""

import random
import zlib
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F
from samples import sorted_rows
from test_text_operators import WORD, quality_by_hand

import corpus_pipeline
from logtide.llm import catalog, packing
from logtide.llm.common import words_of
from logtide.llm.components import components
from logtide.llm.exact_topk import exact_topk
from logtide.llm.mixing import Mix, mix_report, mixed, split_quotas
from logtide.llm.simhash import near_duplicates, near_pairs, one_of_each
from logtide.llm.token_counts import vocabulary_path


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def roots(nodes, pairs):
    up = {n: n for n in nodes}

    def find(n):
        while up[n] != n:
            up[n] = up[up[n]]
            n = up[n]
        return n

    for a, b in pairs:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_anchors_miss_no_pair(spark):
    draw = random.Random(3)
    values = {0, (1 << 64) - 1}
    for _ in range(40):
        base = draw.getrandbits(64)
        values.add(base)
        for _ in range(14):
            near = base
            for _ in range(draw.randint(1, 3)):
                near ^= 1 << draw.randrange(64)
            values.add(near)
    values = sorted(map(signed, values))
    want = {(a, b) for i, b in enumerate(values) for a in values[:i] if ((a ^ b) & (1 << 64) - 1).bit_count() <= 2}
    found = near_pairs(spark.createDataFrame([(v,) for v in values], "fp BIGINT"))
    assert {tuple(r) for r in found.collect()} == want and len(want) > 400


def test_components(spark):
    draw = random.Random(5)
    pairs = [(draw.randrange(120), draw.randrange(120)) for _ in range(60)]
    pairs += [(200 + k, 201 + k) for k in range(40)] + [(300, 300 + k) for k in range(1, 50)] + [(7, 7)]
    want = {n: r for n, r in roots({n for p in pairs for n in p}, pairs).items() if any(n in p for p in pairs if p[0] != p[1])}
    found = components(spark.createDataFrame(pairs + [(None, 1)], "a BIGINT, b BIGINT"))
    assert {r["node"]: r["root"] for r in found.collect()} == want
    assert components(spark.createDataFrame([], "a BIGINT, b BIGINT")).count() == 0


def fingerprint(text):
    import xxhash

    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    ones = Counter(k for s in shingles for h in [xxhash.xxh64_intdigest(s, 42)] for k in range(64) if h >> k & 1)
    return sum(1 << k for k, n in ones.items() if 2 * n > len(shingles))


@pytest.mark.parametrize("which", ["odd", "docs"])
def test_near_duplicates(request, which):
    table = request.getfixturevalue(which)
    rows = [(r["doc_id"], fingerprint(r["text"])) for r in table.select("doc_id", "text").collect()]
    values = sorted({fp for _, fp in rows})
    root = roots(values, [(a, b) for i, b in enumerate(values) for a in values[:i] if (a ^ b).bit_count() <= 2])
    low = {}
    for i, fp in rows:
        if i is not None:
            low[root[fp]] = min(i, low.get(root[fp], i))
    want = [(i, f"{fp:016x}", low.get(root[fp])) for i, fp in rows]
    assert sorted_rows(near_duplicates(table).collect()) == sorted_rows(want)


def test_one_of_each(odd, none):
    kept = one_of_each(odd)
    assert kept.columns == odd.columns
    groups = {r["component_id"] for r in near_duplicates(odd).collect()}
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(groups)
    assert one_of_each(none).count() == 0 and near_duplicates(none).count() == 0


def test_one_of_each_with_null_and_repeated_ids(spark):
    draw = random.Random(11)
    texts = [" ".join(f"w{draw.randrange(10**6)}" for _ in range(40)) for _ in range(6)]
    null, same = texts[:3], texts[3:5]
    rows = [(None, t, "a") for t in null] + [(7, t, "a") for t in same]
    rows += [(None, null[0], "b"), (None, null[0], None), (8, same[0], "a"), (7, same[1], "a")]  # copies
    rows += [(None, texts[5], "a"), (9, texts[5], "a")]
    kept = one_of_each(spark.createDataFrame(rows, "doc_id BIGINT, text STRING, source STRING").repartition(4)).collect()
    want = [(None, t) for t in null] + [(7, t) for t in same] + [(9, texts[5])]
    assert sorted_rows((r["doc_id"], r["text"]) for r in kept) == sorted_rows(want)


def topk_by_hand(rows, k=10):
    out = []
    sound = []
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            sound.append((i, [int(np.floor(1024 * float(np.float32(x)))) for x in v]))
    for q, v in {(q, tuple(v)) for q, v in sound if q % 100 == 0}:
        scores = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in sound if i != q)
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return out


def test_exact_topk(spark):
    draw = random.Random(9)
    rows = [(i, [draw.choice([0.0, draw.uniform(-1, 1)]) for _ in range(8)]) for i in range(260)]
    rows += [(1000 + i, [0.5] * 8) for i in range(40)] + [(1000, [0.5] * 8)]
    rows += [(2000, None), (2100, [1.0, None]), (2200, [float("nan")] * 8), (2300, [float("inf")] * 8), (2400, [0.25]), (None, [1.0]), (2500, [])]
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id BIGINT, embedding ARRAY<FLOAT>, block STRING, rank INT")
    found = exact_topk(table, table.where("vec_id % 100 = 0"))
    assert sorted_rows(found.collect()) == sorted_rows(topk_by_hand(rows))
    few = table.where("vec_id IN (0, 1, 2)")
    assert exact_topk(few, few.where("vec_id = 0")).count() == 2
    assert exact_topk(table.limit(0), table.limit(0)).count() == 0


def check_packing(rows, texts, capacity):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(vocabulary_path("word_bpe_49k.json"))
    want = []
    for i, text in texts:
        ids = library.encode(text or "", add_special_tokens=False).ids + [0]
        for k in range(0, len(ids), capacity):
            part = np.array(ids[k : k + capacity], "<u4").tobytes()
            want.append((i, k // capacity, k, len(part) // 4, zlib.crc32(part)))
    assert sorted_rows(tuple(r)[:5] for r in rows) == sorted_rows(want)
    held = defaultdict(list)
    for r in rows:
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in held.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    return len(held)


@pytest.mark.parametrize("which, capacity", [("odd", 2048), ("docs", 2048), ("docs", 100)])
def test_pack(request, which, capacity):
    table = request.getfixturevalue(which)
    rows = packing.pack(table, capacity).collect()
    n = check_packing(rows, [(r["doc_id"], r["text"]) for r in table.select("doc_id", "text").collect()], capacity)
    assert n <= 1.02 * -(-sum(r["length"] for r in rows) // capacity) + 1


def test_ids_of_runs_are_the_library_s(monkeypatch):
    words = packing.WordIds(vocabulary_path("word_bpe_49k.json"))
    letters = [c for c in map(chr, range(0x250)) if words.word(c)] + [chr(c) for c in range(0x410, 0x450)]
    texts = [f"{a}{b}{end} {b.lower()}{end}" for a, b in zip(letters, letters[7:], strict=False) for end in ("", ".", "?!)")]
    texts += ["don't we'LL 1st x_y _", "\u0130stanbul, \u212bngstr\u00f6m. \u1e9e", "<|endoftext|> a<|b", "e\u0301t\u00e9)", "\u03a3\u0391\u03a3.", "\x1ca\x00b", ""]
    monkeypatch.setattr(packing, "MEMO", 64)
    for _ in range(2):
        for text in texts:
            ids = words.tokenizer.encode(text, add_special_tokens=False).ids
            assert np.frombuffer(words.ids(text.encode("utf-8")), "<u4").tolist() == ids, text
            assert len(words) <= 64


def test_new_words_take_one_look_up_of_the_model(monkeypatch):
    """A word, its capital and the marks behind it share one entry, and a full memo forgets its newer half."""
    words = packing.WordIds(vocabulary_path("word_bpe_49k.json"))
    asked, ask = [], words.tokenize
    words.tokenize = lambda spelled: asked.append(spelled) or ask(spelled)
    monkeypatch.setattr(packing, "MEMO", 8)
    words.ids(b"thonsh Thonsh thonsh. THONSH, thonsh")
    assert asked == ["thonsh", ".", ","] and len(words) == 6
    words.ids(b"bleed wheed sheed")
    assert len(words) == 5
    words.ids(b"Thonsh thonsh.")
    assert asked.count("thonsh") == 1


def test_pack_with_ids_and_nothing(docs, none):
    row = packing.pack(docs.limit(3), with_ids=True).first()
    assert zlib.crc32(np.array(row["ids"], "<u4").tobytes()) == row["ids_crc32"]
    assert packing.pack(none).count() == 0


def fewest(items, capacity):
    """Fewest sequences, by search over all placements."""
    best = [len(items)]

    def place(k, bins):
        if len(bins) >= best[0]:
            return
        if k == len(items):
            best[0] = len(bins)
            return
        for b in sorted(set(bins)):
            if b + items[k] <= capacity:
                rest = list(bins)
                rest.remove(b)
                place(k + 1, rest + [b + items[k]])
        place(k + 1, bins + [items[k]])

    place(0, [])
    return best[0]


def test_reduction_keeps_a_best_packing():
    draw = random.Random(1)
    for _ in range(250):
        capacity = draw.choice([10, 20, 30])
        items = sorted((draw.randint(1, capacity) for _ in range(draw.randint(1, 8))), reverse=True)
        plan = packing.pack_lengths(Counter(items), capacity)
        packed = Counter()
        for held, times in plan:
            assert sum(w * n for w, n in held.items()) <= capacity
            for w, n in held.items():
                packed[w] += n * times
        assert packed == Counter(items)
        # Fixing the sets that dominate leaves the optimum as it was.
        stock, fixed = packing.Stock(dict(Counter(items))), 0
        for item in sorted(set(items), reverse=True):
            while stock.counts.get(item):
                held = packing.dominating(stock, item, capacity - item)
                if held is None:
                    break
                times = stock.times(held)
                stock.take(held, times)
                fixed += times
        rest = [w for w, n in stock.counts.items() for _ in range(n)]
        assert fixed + fewest(sorted(rest, reverse=True), capacity) == fewest(items, capacity)


def targets_by_hand(sizes, weights=(5, 2, 1)):
    total, w = 1.5 * sum(sizes), [weights[k % 3] for k in range(len(sizes))]
    capped = {}
    while True:
        free = [k for k in range(len(sizes)) if k not in capped]
        share, weight = total - sum(capped.values()), sum(w[k] for k in free)
        above = [k for k in free if share * w[k] / weight > 2 * sizes[k] + 1e-9]
        if not above:
            return [capped.get(k, share * w[k] / (weight or 1)) for k in range(len(sizes))]
        capped |= {k: 2.0 * sizes[k] for k in above}


@pytest.mark.parametrize("which", ["odd", "docs"])
def test_mix_report(request, which):
    table = request.getfixturevalue(which)
    rows = table.select("doc_id", "text", "source").collect()
    size = Counter()
    for r in rows:
        size[r["source"]] += len(WORD.findall(r["text"] or ""))
    names = sorted(size, key=lambda s: (s is None, s or ""))
    aim = dict(zip(names, targets_by_hand([size[s] for s in names])))
    report = mix_report(table).collect()
    assert len(report) == len(rows)
    found = sorted_rows((r["doc_id"], r["size"], r["source_size"], round(r["target"], 3)) for r in report)
    hand = [(r["doc_id"], len(WORD.findall(r["text"] or "")), size[r["source"]], round(aim[r["source"]], 3)) for r in rows]
    assert found == sorted_rows(hand)
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in report)
    taken = Counter()
    for r in report:
        taken[round(r["target"], 6), r["source_size"]] += r["taken"]
    wanted = Counter()
    for s in names:
        wanted[round(aim[s], 6), size[s]] += aim[s]
    assert all(abs(taken[k] - v) <= 1 + len(rows) * 0 + 2 for k, v in wanted.items())
    assert sorted_rows(report) == sorted_rows(mix_report(table.repartition(5)).collect())


def test_mixed_texts(odd, none):
    rows = mixed(odd).collect()
    report = mix_report(odd).collect()
    assert sum(len(WORD.findall(r["text"] or "")) for r in rows) == sum(r["taken"] for r in report)
    texts = {r["text"] for r in odd.collect()}
    for r in rows:
        assert r["text"] in texts or any(t and t.startswith(r["text"]) for t in texts)
        assert r["text"] is None or r["n_chars"] == len(r["text"])
    assert mixed(odd).columns == odd.columns
    assert mixed(none).count() == 0 and mix_report(none).count() == 0


@pytest.mark.parametrize("strata", [7, 20_000])
def test_many_sources(spark, strata):
    """30,000 sources with a hot one: targets by hand, every source within a word of its own."""
    n, words = 30_000, [1 + k % 6 for k in range(30_000)]
    words[11] = 40_000
    name = F.concat(F.lit("s"), F.lpad(F.col("id").cast("string"), 6, "0"))
    size = F.when(F.col("id") == 11, 40_000).otherwise(1 + F.col("id") % 6).cast("int")
    many = spark.range(n).select(F.col("id").alias("doc_id"), name.alias("source"), F.repeat(F.lit("w "), size).alias("text"))
    report = {r["doc_id"]: r for r in mix_report(many, Mix(strata=strata)).collect()}
    assert len(report) == n
    for k, aim in enumerate(targets_by_hand(words)):
        assert report[k]["size"] == words[k] and abs(report[k]["target"] - aim) < 1e-6
        assert abs(report[k]["taken"] - aim) <= 0.5 + 1e-6


def test_shards_are_shuffled_locally(spark):
    docs = spark.range(4000).select(
        F.col("id").alias("doc_id"), F.lit("a").alias("source"), F.repeat(F.concat_ws("-", F.lit("w"), "id", F.lit(" ")), 400).alias("text")
    )
    places = {}
    for r in mix_report(docs).collect():
        places[r["doc_id"]] = sorted(zip(r["shards"], r["positions"]))
    lines = {}
    for r in mixed(docs).select("doc_id", F.spark_partition_id().alias("task"), F.monotonically_increasing_id().alias("at")).collect():
        lines.setdefault(r["task"], []).append((r["at"], r["doc_id"]))
    for rows in lines.values():
        last = (-1, 0)
        for _, i in sorted(rows):  # the next free place of the document must not lie before the last row
            last = min(p for p in places[i] if p >= last)
            places[i].remove(last)
    assert not any(places.values())


def test_part_of_the_tree_on_its_own():
    quotas = np.array([5, 7, 1000, 3, 250])
    whole = [(s, g.tolist(), p.tolist()) for s, g, p in split_quotas(quotas, 13, 7)]
    parts = [(s, g.tolist(), p.tolist()) for a in (0, 5, 10) for s, g, p in split_quotas(quotas, 13, 7, a, min(a + 5, 13))]
    assert whole == parts
    for (_, given, part), (_, after, _) in zip(whole, whole[1:]):
        assert (np.array(given) + part == after).all()


def test_splitting_tree_is_exact():
    quotas = np.array([0, 7, 1000, 3, 250])
    parts = {shard: part for shard, _, part in split_quotas(quotas, 13, 7)}
    assert sorted(parts) == list(range(13)) and (sum(parts.values()) == quotas).all()
    sizes = [int(p.sum()) for p in parts.values()]
    assert max(sizes) - min(sizes) <= 2 and all((p >= 0).all() for p in parts.values())
    assert (np.abs(np.array([p[2] for p in parts.values()]) - 1000 / 13) < 25).all()


def test_pipeline_stages(spark, docs):
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    now, seen = docs, {}
    for name, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, "").persist()
        seen[name] = now
    quality, near, secret, mix, packed = seen.values()
    kept = {r["doc_id"] for r in quality.collect()}
    assert kept == {i for i, t in rows.items() if quality_by_hand(t)[6]}
    fps = {i: fingerprint(rows[i]) for i in kept}
    root = roots(kept, [(a, b) for a in kept for b in kept if a < b and (fps[a] ^ fps[b]).bit_count() <= 2])
    assert {r["doc_id"] for r in near.collect()} == set(root.values())
    assert secret.count() == near.count() and secret.where("text LIKE '%token = \"%'").count() == 0
    sizes = {r["doc_id"]: len(WORD.findall(r["text"])) for r in secret.collect()}
    total = sum(len(WORD.findall(r["text"])) for r in mix.collect())
    assert abs(total - 1.5 * sum(sizes.values())) <= 25
    assert all(stage.columns == docs.columns for stage in (quality, near, secret, mix))
    check_packing(packed.collect(), [(r["doc_id"], r["text"]) for r in mix.collect()], 2048)
    whole = corpus_pipeline.run(SimpleNamespace(read=SimpleNamespace(parquet=lambda _: docs), conf=spark.conf), "x")
    assert sorted_rows(whole.collect()) == sorted_rows(packed.collect())


def test_pipeline_of_nothing(spark, none):
    now = none
    for _, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, "")
    assert now.count() == 0


def test_every_query_is_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in catalog.QUERIES)
    assert numbers == list(range(1, 14)) and words_of


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_equals_sql(spark, name):
    from oracle import compare, connect

    folder = "/root/testdata/sf0.001"
    assert compare(spark, connect(folder), folder, name)[0] is None
