"""Quality rules as a short-circuit cascade ordered by rejection per cost.

Every rule is one boolean column.  Each is first evaluated alone over a
sample, which gives its rejection rate and its cost (seconds inside a task); the cascade is
a ``CASE`` that tries the rules from the most rejections per second down, so a
document leaves at its first failed rule and dear rules see few documents.
The order changes only the time: the verdict is the conjunction of all rules.

Defined cases: a null, empty or blank text has no words and fails the base
rule; rows and ids may repeat (each row is judged by its own text); an empty
table gives an empty table and keeps the rules in their given order; other
columns are ignored.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsemart.llm.common import SPACES, let, words

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SAMPLE_ROWS = 2000                 # rows on which costs and selectivities are estimated (expected number)
REPEATS, RUNS = 8, 3               # evaluations of a rule on a sample row, and runs of the task
LEAST_SECONDS = 1e-3               # a cost below this is noise
POSITION_BITS = 24
HASH_MASK = (1 << 40) - 1


@dataclass(frozen=True)
class Rule:
    """``passes`` is true where the document is fine by this rule."""

    name: str
    passes: Column


def _positions(n: Column) -> Column:
    return F.sequence(F.lit(0), n - 3)


def _covered(positions: Column) -> Column:
    """Words covered by the 3-word windows that start at sorted positions."""
    steps = F.transform(
        positions, lambda p, k: F.least(F.lit(3), F.coalesce(F.get(positions, k + 1) - p, F.lit(3)))
    )
    return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)


def _same_as_neighbour(sorted_items: Column, key) -> Column:
    return F.filter(
        sorted_items,
        lambda x, j: F.coalesce(key(x) == key(F.get(sorted_items, j - 1)), F.lit(False))
        | F.coalesce(key(x) == key(F.get(sorted_items, j + 1)), F.lit(False)),
    )


def _repeats_by_text(w: Column) -> Column:
    windows = F.array_sort(F.transform(
        _positions(F.size(w)),
        lambda i: F.struct(F.concat_ws(" ", w[i], w[i + 1], w[i + 2]).alias("k"), i.alias("p")),
    ))
    return let(windows, lambda s: let(
        F.sort_array(F.transform(_same_as_neighbour(s, lambda x: x["k"]), lambda x: x["p"].cast("long"))),
        _covered,
    ))


def repeated_words(w: Column) -> Column:
    """Words inside 3-word windows that occur at least twice in ``w``.

    Windows are packed as (40-bit hash, position) into longs and sorted, so
    equal windows are neighbours.  Neighbours of one hash are compared word by
    word; should two different windows share a hash (or the text be longer
    than positions can say) the windows themselves are sorted instead.
    """
    def packed(i: Column) -> Column:
        h = F.xxhash64(w[i], w[i + 1], w[i + 2]).bitwiseAND(F.lit(HASH_MASK))
        return F.shiftleft(h, POSITION_BITS).bitwiseOR(i.cast("long"))

    def hash_of(x: Column) -> Column:
        return F.shiftrightunsigned(x, POSITION_BITS)

    def position(x: Column) -> Column:
        return x.bitwiseAND(F.lit((1 << POSITION_BITS) - 1)).cast("int")

    def differ(a: Column, b: Column) -> Column:
        return ~((w[a] == w[b]) & (w[a + 1] == w[b + 1]) & (w[a + 2] == w[b + 2]))

    def counted(dup: Column) -> Column:
        clash = F.exists(
            F.transform(dup, lambda x, j: (hash_of(x) == hash_of(F.get(dup, j - 1)))
                        & differ(position(x), position(F.get(dup, j - 1)))),
            lambda b: F.coalesce(b, F.lit(False)),
        )
        exact = let(F.sort_array(F.transform(dup, lambda x: position(x).cast("long"))), _covered)
        return F.when(F.size(dup) == 0, F.lit(0).cast("long")).when(clash, _repeats_by_text(w)).otherwise(exact)

    n = F.size(w)
    fast = let(F.sort_array(F.transform(_positions(n), packed)),
               lambda s: let(_same_as_neighbour(s, hash_of), counted))
    return F.when(n < 3, F.lit(0).cast("long")).when(
        n >= (1 << POSITION_BITS), _repeats_by_text(w)
    ).otherwise(fast)


def base_counts(text: Column) -> Column:
    """Struct of the base counts of one text (null: no words)."""
    text = F.coalesce(text, F.lit(""))
    spaced = F.filter(F.split(text, "\n", -1), lambda line: F.btrim(line, F.lit(SPACES)) != "")
    dup_lines = let(spaced, lambda ls: (F.size(ls) - F.size(F.array_distinct(ls))).cast("long"))
    of_words = let(words(text), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"),
        repeated_words(w).alias("n_repeat_words"),
    ))
    return F.struct(
        of_words.alias("w"),
        F.char_length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        dup_lines.alias("n_dup_lines"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )


def standard_rules(text: str = "text") -> list[Rule]:
    """Rules over the base counts (cheap) and over the text (dear)."""
    t = F.coalesce(F.col(text), F.lit(""))
    lines = F.split(t, "\n", -1)
    return [
        Rule("mean_word_length", F.col("word_chars").between(2 * F.col("n_words"), 14 * F.col("n_words"))),
        Rule("symbols", 10 * F.col("n_symbols") <= F.col("n_words")),
        Rule("dup_lines", let(F.size(lines), lambda n: 10 * F.col("n_dup_lines") <= 3 * n)),
        Rule("bullet_lines", let(lines, lambda ls: 10 * F.size(
            F.filter(ls, lambda x: F.ltrim(x).rlike("^[-*•]"))) <= 9 * F.size(ls))),
        Rule("ellipsis_lines", let(lines, lambda ls: 10 * F.size(
            F.filter(ls, lambda x: F.rtrim(x).rlike("(\\.\\.\\.|…)$"))) <= 3 * F.size(ls))),
        Rule("digits", 4 * F.char_length(F.regexp_replace(t, "[^0-9]+", "")) <= F.col("word_chars")),
        Rule("letters", let(words(t), lambda w: 10 * F.size(
            F.filter(w, lambda x: x.rlike("\\p{L}"))) >= 7 * F.size(w))),
    ]


def measured(sample: DataFrame, rules: Sequence[Rule]) -> list[tuple[int, float]]:
    """Rejected rows and cost of every rule on a sample with its base counts.

    A rule's cost is the time that one task takes to evaluate it ``REPEATS`` times
    on each row, less the time of the same task without a rule: what starting a job
    and reading the sample take drops out.  Each task runs ``RUNS`` times, the first
    time to have its code compiled, and the shortest counts.
    """
    times = F.explode(F.sequence(F.lit(1), F.lit(REPEATS)))
    repeated = sample.coalesce(1).withColumn("__again", times)          # a bounded sample

    def run(counted: Column) -> tuple[int, float]:
        found, best = 0, float("inf")
        for _ in range(RUNS):
            began = time.perf_counter()
            found = repeated.agg(counted.alias("r")).first()["r"]
            best = min(best, time.perf_counter() - began)
        return found, best

    _, empty = run(F.count("__again"))
    out = []
    for rule in rules:
        rejected, seconds = run(F.count_if(~F.coalesce(rule.passes, F.lit(False))))
        out.append((rejected // REPEATS, max(LEAST_SECONDS, seconds - empty)))
    return out


def ordered_by_benefit(sample: DataFrame, rules: Sequence[Rule]) -> list[Rule]:
    """Rules by rejections per second on a sample with its base counts, best
    first; of rules that reject nothing the cheapest first.  Only counts reach the
    driver; an empty sample keeps the order."""
    sample = sample.persist()
    try:
        if not sample.count():
            return list(rules)
        costs = measured(sample, rules)
    finally:
        sample.unpersist()
    benefit = [(-rejected / seconds, seconds) for rejected, seconds in costs]
    return [rule for _, rule in sorted(zip(benefit, rules), key=lambda x: x[0])]


def cascade(rules: Sequence[Rule]) -> Column:
    """True where every rule passes; evaluation stops at the first that fails."""
    verdict = F.when(base_failed(), F.lit(False))
    for rule in rules:
        verdict = verdict.when(~F.coalesce(rule.passes, F.lit(False)), F.lit(False))
    return verdict.otherwise(F.lit(True))


def quality_rules(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    rules: Sequence[Rule] | None = None, sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """Every row of ``docs`` with its base counts, ``base_failed`` and ``kept``."""
    rules = list(standard_rules() if rules is None else rules)
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    counts = ("word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

    def counted(df: DataFrame) -> DataFrame:
        one = df.select("id", "text", F.explode(F.array(base_counts(F.col("text")))).alias("c"))
        return one.select("id", "text", "c.w.n_words", "c.w.word_chars", "c.n_symbols", "c.n_dup_lines",
                          "c.w.n_repeat_words")

    total = src.count()                  # from the files' metadata
    sample = src.sample(min(1.0, sample_rows / max(1, total)), seed=17)
    order = ordered_by_benefit(counted(sample), rules)
    return counted(src).select(
        F.col("id").alias(id_col), "text", "n_words", *counts,
        base_failed().alias("base_failed"), cascade(order).alias("kept"),
    )
