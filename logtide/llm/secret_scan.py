"""Secret scans: fixed patterns, and strings that a character Markov model finds random.

Positions come from cutting a text at a pattern: the pieces between the matches and the
matches themselves alternate, so their lengths add up to the spans. Everything is a built-in
expression over one row, linear in the length of the text.

The model is two first-order Markov chains over characters, one of random strings and one of
ordinary identifiers. A candidate's score is the sum over its transitions of the logarithm of
their ratio; the sums of both chains are one table in the plan.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logtide.llm.common import written

# Fixed values of the contract: the three base patterns and their shortest lengths.
ASSIGN = r"""((?i)password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"()(AKIA[A-Z0-9]{14,})"
HEX = r"()([0-9a-f]{16,})"
# Strings the model judges: long runs of the characters of keys. Runs without any letter are rules,
# dates and numbers; one in 10^13 random strings is such a run, and 16 digits in a row are of kind hex.
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_RUN = "[A-Za-z0-9+/_=-]"
RANDOM = rf"()((?<!{_RUN})(?={_RUN}{{20}})(?={_RUN}*[A-Za-z]){_RUN}+)"
PLACEHOLDER = "[SECRET]"
CHUNK = 512


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    shortest: int  # of the second group


BASE = (Kind("assign", ASSIGN, 12), Kind("access", ACCESS, 18), Kind("hex", HEX, 16))
RANDOM_KIND = Kind("random", RANDOM, 20)


@dataclass(frozen=True)
class Training:
    """Bounds of the sample the chains are trained on; the model is the same for all rows."""

    documents: int = 1_000  # those with the smallest hash of doc_id
    random_strings: int = 2_000  # of each alphabet
    smoothing: float = 0.5
    threshold: float = 45.0  # nats in favour of a random string


def samples(docs: DataFrame, training: Training = Training()) -> DataFrame:
    """Labelled strings (sample, label): digests in several alphabets are random (1); words of a
    bounded sample of ``docs``, and names built from them, are ordinary (0)."""
    spark = docs.sparkSession
    digest = F.sha2(F.concat(F.lit("sample-"), F.col("id").cast("string")), 256)
    alphabets = [
        digest,
        F.upper(digest),
        F.base64(F.unhex(digest)),
        F.translate(F.base64(F.unhex(digest)), "+/=", "-_"),
        F.regexp_replace(F.base64(F.unhex(digest)), "[^A-Z0-9]", ""),
        F.regexp_replace(F.base64(F.unhex(digest)), "[^A-Za-z0-9]", ""),
    ]
    random = spark.range(training.random_strings).select(F.explode(F.array(*alphabets)).alias("sample"))
    mark = F.xxhash64(F.lit(training.documents), "doc_id")
    ids = docs.select("doc_id").distinct().orderBy(mark, "doc_id").limit(training.documents)
    # The sample is written first (ids: bounded by ``documents``): a filter on its words would else be
    # moved below the join, and the words of every text be cut.
    sampled = written(docs.join(F.broadcast(ids), "doc_id", "left_semi").select("text"), "sample")
    text = F.regexp_replace(F.coalesce("text", F.lit("")), "|".join(k.pattern for k in BASE), " ")
    words = F.regexp_extract_all(text, F.lit("[A-Za-z]{2,30}"), F.lit(0))
    triples = sampled.select(words.alias("w")).where("size(w) >= 3").select(
        F.posexplode(F.expr("transform(sequence(0, size(w) div 3 - 1), k -> slice(w, 3 * k + 1, 3))")).alias("form", "t")
    )
    low = F.transform("t", lambda w: F.lower(w))
    names = F.array(
        F.array_join("t", ""),
        F.array_join(low, "_"),
        F.array_join(low, "-"),
        F.upper(F.array_join("t", "_")),
        F.array_join(F.transform("t", lambda w: F.initcap(w)), ""),
        F.concat(F.array_join(low, "_"), F.lit("_"), F.length(F.col("t")[0]).cast("string"), F.length(F.col("t")[1]).cast("string")),
        F.concat(F.array_join(low, "/"), F.lit("/20"), F.length(F.col("t")[0]).cast("string"), F.length(F.col("t")[1]).cast("string")),
    )
    ordinary = triples.select(F.get(names, F.col("form") % 7).alias("sample"))  # one form each, in turn
    return random.withColumn("label", F.lit(1)).union(ordinary.withColumn("label", F.lit(0)))


def train(labelled: DataFrame, training: Training = Training()) -> list[float]:
    """Log-likelihood ratios of all transitions, row by row, from (sample, label) rows.

    What reaches the driver is one count per label and pair of letters.
    """
    letters = F.split("sample", "")
    pairs = F.transform(
        F.slice(letters, 1, F.greatest(F.length("sample") - 1, F.lit(0))),
        lambda c, i: F.concat(c, F.get(letters, i + 1)),
    )
    counted = labelled.select("label", F.explode(pairs).alias("pair")).groupBy("label", "pair").count().collect()
    n = len(LETTERS)
    counts = [[training.smoothing] * (n * n) for _ in range(2)]
    place = {c: k for k, c in enumerate(LETTERS)}
    for row in counted:
        a, b = row["pair"][:1], row["pair"][1:]
        if a in place and b in place:
            counts[row["label"]][place[a] * n + place[b]] += row["count"]
    chains = []
    for table in counts:
        sums = [sum(table[k * n : (k + 1) * n]) for k in range(n)]
        chains.append([math.log(v / sums[k // n]) for k, v in enumerate(table)])
    return [round(r - o, 6) for o, r in zip(*chains, strict=True)]


def _score(value: Column, ratios: list[float]) -> Column:
    """Sum of the ratios over the transitions of a string of LETTERS."""
    n = len(LETTERS)
    codes = [-1] * 128
    for k, c in enumerate(LETTERS):
        codes[ord(c)] = k
    # Literals: folded once into the plan.
    table = F.split(F.lit(",".join(map(str, ratios))), ",").cast("array<double>")
    code_of = F.split(F.lit(",".join(map(str, codes))), ",").cast("array<int>")
    start = F.struct(F.lit(-1).alias("last"), F.lit(0.0).alias("sum"))

    def step(acc: Column, letter: Column) -> Column:
        code = F.get(code_of, F.ascii(letter))
        gain = F.when(acc["last"] >= 0, F.get(table, acc["last"] * n + code)).otherwise(0.0)
        return F.struct(code.alias("last"), (acc["sum"] + gain).alias("sum"))

    return F.aggregate(F.split(value, ""), start, step, lambda acc: acc["sum"])


def _matches(text: Column, kind: Kind) -> Column:
    """(gap, match, value) for each match of a pattern: what stands before it, itself, its second group."""
    return F.zip_with(
        F.zip_with(F.split(text, kind.pattern), F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)), _pair),
        F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(2)),
        lambda pair, value: F.struct(pair["gap"].alias("gap"), pair["match"].alias("match"), value.alias("value")),
    )


def _pair(gap: Column, match: Column) -> Column:
    return F.struct(gap.alias("gap"), match.alias("match"))


def _accepted(value: Column, kind: Kind, ratios: list[float] | None, threshold: float) -> Column:
    long_enough = F.length(value) >= kind.shortest
    if kind.name != RANDOM_KIND.name:
        return F.coalesce(long_enough, F.lit(False))
    return F.coalesce(long_enough & (_score(value, ratios) >= threshold), F.lit(False))


SPAN = "array<struct<start: int, rank: int, end: int, kind: string>>"


def _spans(name: str, kind: Kind, rank: int, ok: Column) -> Column:
    """Spans of the accepted matches in column ``name``. Lengths are added up in chunks, so that
    a text with very many matches costs no more than in proportion."""
    m = F.col(name)
    chunks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(m) - 1) / CHUNK).cast("int")), lambda b: F.slice(m, b * CHUNK + 1, F.lit(CHUNK))
    )

    def length(x: Column) -> Column:
        return F.length(x["gap"]) + F.coalesce(F.length(x["match"]), F.lit(0))

    totals = F.transform(chunks, lambda c: F.aggregate(c, F.lit(0), lambda n, x: n + length(x)))
    empty = F.expr("cast(array() as array<int>)")
    offsets = F.aggregate(
        totals,
        F.struct(F.lit(0).alias("at"), empty.alias("all")),
        lambda acc, n: F.struct((acc["at"] + n).alias("at"), F.concat(acc["all"], F.array(acc["at"])).alias("all")),
        lambda acc: acc["all"],
    )
    none = F.expr(f"cast(array() as {SPAN})")

    def inside(chunk: Column, offset: Column) -> Column:
        def step(acc: Column, x: Column) -> Column:
            start = acc["at"] + F.length(x["gap"])
            end = start + F.coalesce(F.length(x["match"]), F.lit(0))
            span = F.struct(start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), F.lit(kind.name).alias("kind"))
            spans = F.when(ok_of(x), F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"])
            return F.struct(end.alias("at"), spans.alias("spans"))

        return F.aggregate(chunk, F.struct(offset.alias("at"), none.alias("spans")), step, lambda acc: acc["spans"])

    ok_of = ok
    return F.when(F.size(m) > 0, F.flatten(F.zip_with(chunks, offsets, inside))).otherwise(none)


def _joined(spans: Column) -> Column:
    parts = F.transform(
        F.array_sort(spans),
        lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
    )
    return F.array_join(parts, ",")


def _cut(text: Column, kind: Kind) -> Column:
    """The matches of a text, or none without cutting where the pattern does not occur."""
    return F.when(text.rlike(kind.pattern), _matches(text, kind)).otherwise(
        F.expr("cast(array() as array<struct<gap: string, match: string, value: string>>)")
    )


def _replaced(name: str, text: Column, ok, by) -> Column:
    """A text with its accepted matches replaced; ``name`` is the column of its matches."""
    m = F.col(name)
    parts = F.transform(
        m, lambda x: F.concat(x["gap"], F.when(ok(x), by(x)).otherwise(F.coalesce(x["match"], F.lit(""))))
    )
    return F.when(F.size(m) > 0, F.array_join(parts, "")).otherwise(text)


def _without(rows: DataFrame, kinds, ok, by) -> DataFrame:
    """``rows`` with the accepted matches of each kind replaced in ``text``, kind after kind."""
    for kind in kinds:
        rows = rows.withColumn("m_out", _cut(F.col("text"), kind))
        rows = rows.withColumn("text", _replaced("m_out", F.col("text"), ok(kind), by)).drop("m_out")
    return rows


def secret_scan(docs: DataFrame, ratios: list[float], threshold: float = Training.threshold) -> DataFrame:
    """Secrets of each row of ``docs`` (doc_id, text).

    Returns doc_id, n_assign, n_access, n_hex, base_sha256 (of the base spans), spans (all of
    them, as kind:start:end in code points). Random strings are looked for outside base spans.
    Null text counts as empty: no spans. Null ids and repeated rows stay; other columns are
    not read; no rows give no rows.
    """

    def ok(kind: Kind):
        return lambda x: _accepted(x["value"], kind, ratios, threshold)

    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumns({f"m_{k.name}": _cut(F.col("text"), k) for k in BASE})
    rows = rows.withColumns({f"s_{k.name}": _spans(f"m_{k.name}", k, r, ok(k)) for r, k in enumerate(BASE)})
    # Base spans are blanked, at their length, before random strings are looked for.
    rows = _without(rows, BASE, ok, lambda x: F.repeat(F.lit(" "), F.length(x["match"])))
    rows = rows.withColumn("m_random", _cut(F.col("text"), RANDOM_KIND))
    rows = rows.withColumn("s_random", _spans("m_random", RANDOM_KIND, len(BASE), ok(RANDOM_KIND)))
    base = F.concat(*[F.col(f"s_{k.name}") for k in BASE])
    return rows.select(
        "doc_id",
        *[F.size(f"s_{k.name}").cast("long").alias(f"n_{k.name}") for k in BASE],
        F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(F.concat(base, "s_random")).alias("spans"),
    )


def redact(docs: DataFrame, ratios: list[float], threshold: float = Training.threshold) -> DataFrame:
    """``docs`` with every secret replaced by a placeholder; n_chars, where there is one, follows.

    Kinds are replaced one after the other. Where two overlap, what the first leaves of the
    second is judged again on its own. Texts without secrets, null ones too, are unchanged.
    """

    def ok(kind: Kind):
        return lambda x: _accepted(x["value"], kind, ratios, threshold)

    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.coalesce("text", F.lit("")).alias("text"))
    rows = _without(rows, (*BASE, RANDOM_KIND), ok, lambda x: F.lit(PLACEHOLDER))
    changed = F.col("row.text").isNotNull() & (F.col("row.text") != F.col("text"))
    columns = []
    for name in docs.columns:
        column = F.col(f"row.`{name}`")
        if name == "text":
            column = F.when(changed, F.col("text")).otherwise(column)
        elif name == "n_chars":
            column = F.when(changed, F.length("text").cast(docs.schema[name].dataType)).otherwise(column)
        columns.append(column.alias(name))
    return rows.select(*columns)
