"""Quality rules: one table of thresholds, compiled into one projection of ratios.

Everything is a built-in expression, so a text is read once and nothing is shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logtide.llm.common import BLANKS, words_of

# Very frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "a an and are as at be by for from has he in is it its of on or that the this to was were will with "
    "als auch auf aus bei das dem den der des die ein eine für im ist mit nicht sich sie sind und von zu "
    "au aux ce dans de des du elle en est et il la le les ne pas pour qui que sur un une "
    "al como con del el es esta la las lo los más no para por se su una y"
).split()
STOP_FORMS = sorted({form for w in STOP_WORDS for form in (w, w.capitalize(), w.upper())})


@dataclass(frozen=True)
class Rule:
    """``low * den <= 100 * num <= high * den``, in whole numbers; a missing bound is open."""

    name: str
    num: str
    den: str
    low: int | None = None
    high: int | None = None

    def holds(self) -> Column:
        part, whole = 100 * F.col(self.num), F.col(self.den)
        tests = [part >= self.low * whole] if self.low is not None else []
        tests += [part <= self.high * whole] if self.high is not None else []
        return tests[0] & tests[1] if len(tests) == 2 else tests[0]


# Loose on purpose: no document of the supplied tables that is labelled good fails one of them.
# Repeated lines count by their characters, so that a short line said twice weighs little.
RULES = (
    Rule("word length", "word_chars", "n_words", low=200, high=1500),
    Rule("symbols", "n_symbols", "n_words", high=10),
    Rule("repeated lines", "n_dup_line_chars", "n_line_chars", high=30),
    Rule("stop words", "n_stop_words", "n_words", low=1),
)
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50


def text_counts(texts: DataFrame) -> DataFrame:
    """Counts of each row's ``text``; other columns stay. ``texts`` must not hold names starting with ``q_``.

    Repeated words: the 3-word windows are hashed, equal hashes are neighbours after a sort,
    and the words under any repeated window are counted once. Texts without a repeated
    window, most of them, skip the sort.
    """
    others = [F.col(f"`{c}`") for c in texts.columns]
    text = F.coalesce(F.col("text"), F.lit(""))
    q = texts.select(*others, words_of(F.col("text")).alias("q_words"))
    q = q.withColumn(
        "q_windows",
        F.transform(
            F.slice("q_words", 1, F.greatest(F.size("q_words") - 2, F.lit(0))),
            lambda w, i: F.xxhash64(w, F.col("q_words")[i + 1], F.col("q_words")[i + 2]),
        ),
    )
    q = q.withColumn(
        "q_sorted",
        F.when(
            F.size(F.array_distinct("q_windows")) < F.size("q_windows"),
            F.sort_array(F.transform("q_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ),
    )
    seen = F.col("q_sorted")
    repeated = F.filter(
        seen,
        lambda w, k: F.when(k > 0, seen[F.greatest(k - 1, F.lit(0))]["h"] == w["h"]).otherwise(False)
        | F.when(k < F.size(seen) - 1, seen[F.least(k + 1, F.size(seen) - 1)]["h"] == w["h"]).otherwise(False),
    )
    q = q.withColumn("q_at", F.sort_array(F.transform(repeated, lambda w: w["i"])))
    covered = F.aggregate(
        "q_at",
        F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n")),
        lambda acc, i: F.struct(i.alias("last"), (acc["n"] + F.least(F.lit(3), i - acc["last"])).alias("n")),
        lambda acc: acc["n"],
    )
    q = q.withColumn(
        "q_lines", F.filter(F.split(text, "\n"), lambda line: F.length(F.btrim(line, F.lit(BLANKS))) > 0)
    )
    return q.select(
        *others,
        F.size("q_words").cast("long").alias("n_words"),
        F.length(F.array_join("q_words", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        (F.size("q_lines") - F.size(F.array_distinct("q_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.length(F.array_join("q_lines", "")).cast("long").alias("n_line_chars"),
        (F.length(F.array_join("q_lines", "")) - F.length(F.array_join(F.array_distinct("q_lines"), ""))).cast("long").alias("n_dup_line_chars"),
        F.size(F.filter("q_words", lambda w: w.isin(*STOP_FORMS))).cast("long").alias("n_stop_words"),
    )


def judged(counts: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Add ``base_failed`` and ``kept`` to rows of ``text_counts``."""
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    verdict = ~failed
    for rule in rules:
        verdict = verdict & rule.holds()
    return counts.withColumns({"base_failed": failed, "kept": verdict})


def quality_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): its counts, base verdict and verdict.

    Null or empty text: no words, so it fails. Null ids and repeated rows stay as they are;
    columns other than doc_id and text are not looked at. No rows give no rows.
    """
    return judged(text_counts(docs.select("doc_id", "text")), rules).drop("text")


def keep_good(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``docs`` that pass, with their columns unchanged."""
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("text"))
    # An exploded array instead of a filter: a filter would be pushed below the counts and
    # have them computed again for each of its terms.
    kept = F.explode(F.when(F.col("kept"), F.array("row")))
    return judged(text_counts(packed), rules).select(kept.alias("row")).select("row.*")
