"""Mixing sources to target weights by Pareto order sampling.

A source's target words are shared among its documents by length class (the binary
digits of the word count): a document of class k is to be taken ``k`` times a
source-wide factor, at most ``MOST`` times, so longer documents are likelier.  The
whole part of that is taken for certain; the rest is the document's inclusion
probability.  Documents are ranked by their random odds over their inclusion
odds (Rosen's Pareto sampling), and a source's first documents in that
order are taken until its words are met: a sample of fixed size in words with
unequal probabilities.

The cut is found without sorting a source in one task: words are counted in
4096 buckets of the rank (partial sums per task), running sums over those
buckets name the one that holds the cut, and only that bucket's rows
are put in order.  Random numbers are hashes of the document id, so reruns
agree.

Defined cases: a null text or one without words has size 0 and is taken with
0 words; a null source is a source, last in order; a null id is hashed as
such; rows with equal ids share their random number and are cut in order of
size; an empty table gives an empty table; input columns named like the
output's are replaced by ``mix_sources`` and kept by ``mixed_rows``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsemart.llm.common import broadcast_small, stored, text_hash, whole_rows, words

WEIGHTS = (3, 1, 2)                # of the sources in order, repeating
PERCENT = 150                      # of all words: the size of the mix
MOST = 2                           # no source or document above so many times its size
BUCKETS = 4096
RATE_BYTES = 96                    # a row of the per-source tables in memory


def source_targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, percent: int = PERCENT, most: int = MOST,
) -> DataFrame:
    """Each ``source`` with ``source_size`` and ``target`` words.

    Targets share ``percent`` of all words by weight; those above ``most``
    times their source stop there and the excess is shared by weight again
    until none is above.  In ascending order of bound per weight, the sources
    up to the first one below its bound are the stopped ones, so the
    level (words per weight) at that one is final.  One row per source.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    kinds = F.array(*[F.lit(int(w)) for w in weights])
    weighed = per_source.withColumn("rank", F.row_number().over(in_order)).withColumn(
        "weight", F.get(kinds, (F.col("rank") - 1) % len(weights)).cast("long")
    )
    steps = Window.orderBy(F.col("bound") / F.col("weight"), "rank")
    before, onward = steps.rowsBetween(Window.unboundedPreceding, -1), steps.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    mix = F.sum("source_size").over(everything) * percent / F.lit(100.0)
    leveled = weighed.withColumn("bound", most * F.col("source_size")).withColumn(
        "level", (mix - F.coalesce(F.sum("bound").over(before), F.lit(0))) / F.sum("weight").over(onward)
    )
    final = F.min(F.when(F.col("bound") > F.col("weight") * F.col("level"), F.struct(
        (F.col("bound") / F.col("weight")).alias("b"), "rank", "level"))).over(everything)["level"]
    target = F.least(F.col("bound").cast("double"), F.coalesce(F.col("weight") * final, F.col("bound").cast("double")))
    return leveled.select("source", "source_size", target.alias("target"))


def uniform(doc: Column) -> Column:
    """A number in (0, 1) that depends on the id alone."""
    digits = F.substring(F.md5(F.coalesce(doc.cast("string"), F.lit("null"))), 1, 12)
    return (F.conv(digits, 16, 10).cast("long") + 0.5) / F.lit(float(1 << 48))


def length_class(size: Column) -> Column:
    """Binary digits of the word count: 1 for none or one word, one more for each doubling."""
    return F.length(F.bin(size)).cast("long")


def class_rates(sizes: DataFrame, targets: DataFrame, most: int = MOST) -> DataFrame:
    """Per source and length class: ``whole`` copies, inclusion probability ``p``, and the
    source's ``wanted`` words beyond the whole copies.

    A class k is to be taken ``factor * k`` times; classes above ``most`` stop there,
    longest first, and the factor of the others takes in what is left.  At most 64
    rows a source meet in a window.
    """
    classes = sizes.groupBy("source", "size_class").agg(F.sum("size").alias("words")).join(
        targets, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    of_source = Window.partitionBy("source")
    longest = of_source.orderBy(F.col("size_class").desc())
    longer = longest.rowsBetween(Window.unboundedPreceding, -1)
    onward = longest.rowsBetween(0, Window.unboundedFollowing)
    left = F.col("target") - most * F.coalesce(F.sum("words").over(longer), F.lit(0))
    weight = F.sum(F.col("size_class") * F.col("words")).over(onward)
    tried = classes.withColumn("factor", F.when(weight > 0, left / weight).otherwise(F.lit(0.0)))
    # the first class that stays below the bound fixes the factor of all below it
    final = F.max(F.when(F.col("factor") * F.col("size_class") <= most, F.struct("size_class", "factor"))).over(of_source)["factor"]
    rate = F.least(F.lit(float(most)), F.greatest(F.lit(0.0), F.coalesce(final, F.lit(float(most))) * F.col("size_class")))
    rated = tried.withColumn("rate", rate).withColumn("whole", F.floor("rate").cast("int"))
    return rated.select(
        F.col("source").alias("s"), F.col("size_class").alias("c"), "source_size", "target", "whole",
        (F.col("rate") - F.col("whole")).alias("p"),
        (F.col("target") - F.sum(F.col("whole") * F.col("words")).over(of_source)).alias("wanted"),
    )


def rank_bucket(doc: Column, p: Column) -> tuple[Column, Column]:
    """A document's place ``q`` in the Pareto order and the bucket it falls into; null
    without an inclusion probability."""
    u = uniform(doc)
    q = F.when(p > 0, (u / (1 - u)) / (p / (1 - p)))
    return q, F.when(q.isNotNull(), F.least(F.lit(BUCKETS - 1), F.floor(BUCKETS * (q / (1 + q)))).cast("int"))


def _plan(
    docs: DataFrame, id_col: str, text_col: str, source_col: str, weights: Sequence[int], percent: int, most: int,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(ranked, rates, cuts): every document with its size and place, the class rates with
    each source's cut, and the documents of the cut buckets with ``picked``: in
    order of ``q``, those whose middle word comes no later than the wanted words."""
    src = docs.select(
        F.col(id_col).alias("doc"), F.col(source_col).alias("source"),
        F.size(words(F.col(text_col))).cast("long").alias("size"), text_hash(F.col(text_col)),
    )
    sizes = stored(src.withColumn("size_class", length_class(F.col("size"))), "mix_sizes")      # the texts are read once
    targets = source_targets(sizes, weights, percent, most).withColumnRenamed("source", "s")
    rates = stored(class_rates(sizes, stored(targets, "mix_targets"), most), "mix_rates")
    known = sizes.join(
        broadcast_small(rates, RATE_BYTES), F.col("source").eqNullSafe(F.col("s")) & (F.col("size_class") == F.col("c"))).drop("s", "c")
    q, bucket = rank_bucket(F.col("doc"), F.col("p"))
    ranked = known.withColumn("q", q).withColumn("bucket", bucket)
    sums = ranked.filter("q is not null").groupBy("source", "wanted", "bucket").agg(F.sum("size").alias("words"))
    running = F.sum("words").over(Window.partitionBy("source").orderBy("bucket"))
    cut = sums.withColumn("end", running).filter(
        (F.col("end") > F.col("wanted")) & (F.col("end") - F.col("words") <= F.col("wanted"))
    ).select(F.col("source").alias("s2"), F.col("bucket").alias("cut"), (F.col("end") - F.col("words")).alias("before"))
    cut = stored(cut, "mix_cuts")                       # a row per source
    # a source whose words are all wanted has no cut: every bucket is before it
    rates = stored(rates.join(cut, F.col("s").eqNullSafe(F.col("s2")), "left").withColumn(
        "cut", F.coalesce("cut", F.lit(BUCKETS))).drop("s2"), "mix_plan")
    inside = ranked.join(broadcast_small(cut, RATE_BYTES), F.col("source").eqNullSafe(F.col("s2")) & (F.col("bucket") == F.col("cut")))
    order = Window.partitionBy("source").orderBy("q", F.col("doc").asc_nulls_first(), "size")
    earlier = F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    picked = F.col("before") + earlier + F.col("size") / 2 <= F.col("wanted")
    return ranked, rates, inside.withColumn("picked", picked)


def mix_sources(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: Sequence[int] = WEIGHTS, percent: int = PERCENT, most: int = MOST,
) -> DataFrame:
    """One row per document: its id, ``text_hash``, ``source``, ``size`` (words), ``source_size``,
    ``target`` (its source's), ``copies`` and ``taken`` (words)."""
    ranked, rates, inside = _plan(docs, id_col, text_col, source_col, weights, percent, most)
    cuts = rates.select("s", "c", "cut")
    at = ranked.join(
        broadcast_small(cuts, RATE_BYTES), F.col("source").eqNullSafe(F.col("s")) & (F.col("size_class") == F.col("c")))
    at = at.withColumn("bucket", F.coalesce("bucket", F.lit(BUCKETS + 1)))
    outside = at.filter(F.col("bucket") != F.col("cut")).withColumn("picked", F.col("bucket") < F.col("cut"))
    columns = ["doc", "text_hash", "source", "size", "source_size", "target", "whole", "picked"]
    every = outside.select(*columns).unionByName(inside.select(*columns))
    copies = F.col("whole") + F.col("picked").cast("int")
    return every.select(
        F.col("doc").alias(id_col), "text_hash", "source", "size", "source_size", "target",
        copies.alias("copies"), (copies * F.col("size")).cast("long").alias("taken"),
    )


def mixed_rows(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: Sequence[int] = WEIGHTS, percent: int = PERCENT, most: int = MOST,
) -> DataFrame:
    """The rows of ``docs``, all their columns, each as often as the mix takes it; equal
    rows are taken equally often.

    A row's copies follow from its source, its length class and its random number; only
    the rows of the cut buckets, one in ``BUCKETS``, are looked up, so no text is
    shuffled for the others.
    """
    _, rates, inside = _plan(docs, id_col, text_col, source_col, weights, percent, most)
    picks = stored(inside.groupBy(F.col("doc").alias("d"), F.col("text_hash").alias("h")).agg(
        F.max("picked").alias("picked")), "mix_picks")
    text = F.col(f"row.{text_col}")
    rows = whole_rows(docs).withColumn("size_class", length_class(F.size(words(text)).cast("long")))
    rows = rows.join(
        broadcast_small(rates, RATE_BYTES), F.col(f"row.{source_col}").eqNullSafe(F.col("s")) & (F.col("size_class") == F.col("c")))
    bucket = F.coalesce(rank_bucket(F.col(f"row.{id_col}"), F.col("p"))[1], F.lit(BUCKETS + 1))
    rows = rows.select("row", "whole", "cut", bucket.alias("bucket"))
    outside = rows.filter(F.col("bucket") != F.col("cut")).select(
        "row", (F.col("whole") + (F.col("bucket") < F.col("cut")).cast("int")).alias("copies"))
    own = F.col(f"row.{id_col}").eqNullSafe(F.col("d")) & (text_hash(text) == F.col("h"))
    inside = rows.filter(F.col("bucket") == F.col("cut")).join(broadcast_small(picks, RATE_BYTES), own).select(
        "row", (F.col("whole") + F.col("picked").cast("int")).alias("copies"))
    taken = outside.unionByName(inside).filter("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("copies")))).select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
