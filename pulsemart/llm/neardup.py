"""Near-duplicate documents by min-max hashing.

Each permutation of the shingle hashes gives two signature values, its
minimum and its maximum, so half the hash evaluations fill a signature
(Ji et al., "Min-max hash for Jaccard similarity", 2013).  Signatures are cut
into bands; documents of one shingle set are one class, and only classes
are banded.  A bucket's classes are compared with the bucket's most often
colliding class (a star, not all pairs) and the links found are joined into
components.  A bucket whose classes then lie in several components is
unsettled; its classes meet once more in an exact prefix-filtered set join,
which compares classes of different components only if they share one of the
shingles that, rarest first, a pair of their sizes can't do without.  So every
colliding pair is linked through a component, compared on the full sets, or
shown by counting to be too different, and no group's pairs are all listed.

Defined cases: a null text, or one without words, has no shingles and is
linked with nothing; fewer words than a shingle form one shingle; rows with
equal ids and different texts are separate documents that may share an
id; null ids are larger than all others and never name a component that
has another id; an empty table gives an empty table; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsemart.llm import sketch
from pulsemart.llm.common import stored, text_hash
from pulsemart.llm.components import components

WIDTH = 5
PERCENT = 80
PERMUTATIONS = 40                  # 80 signature values
BAND_ROWS = 4                      # 20 bands: misses a pair of similarity 0.8 once in 2.9e4, of 0.85 once in 2.6e6
SEED = 20130


def _sets(column: pa.Array, width: int) -> Iterator[np.ndarray]:
    for _, words in sketch.documents(column):
        yield np.unique(sketch.shingles(words, width))


def _sketched(width: int, permutations: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = list(_sets(batch.column("text"), width))
            full = [i for i, s in enumerate(sets) if len(s)]
            bands: list = [None] * len(sets)
            if full:
                keys = sketch.band_keys(
                    sketch.extremes([sets[i] for i in full], permutations, SEED, maxima=True), rows
                ).view(np.int64)
                for i, k in zip(full, keys):
                    bands[i] = k
            yield pa.RecordBatch.from_arrays([
                batch.column("doc"), batch.column("text_hash"),
                pa.array([sketch.set_key(s) if len(s) else None for s in sets], pa.binary()),
                pa.array([len(s) for s in sets], pa.int64()), pa.array(bands, pa.list_(pa.int64())),
            ], ["doc", "text_hash", "cls", "n", "bands"])
    return run


def _full_sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = list(_sets(batch.column("text"), width))
            yield pa.RecordBatch.from_arrays([
                pa.array([sketch.set_key(s) if len(s) else None for s in sets], pa.binary()),
                pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
            ], ["cls", "members"])
    return run


def similar(a: Column, b: Column, percent: int) -> Column:
    """100 * intersection >= percent * union, on full sets."""
    both = F.size(F.array_intersect(a, b)).cast("long")
    return 100 * both >= percent * (F.size(a) + F.size(b) - both)


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (``a``, ``b``) whose full sets are similar enough."""
    left = sets.select(F.col("cls").alias("a"), F.col("members").alias("of_a"))
    right = sets.select(F.col("cls").alias("b"), F.col("members").alias("of_b"))
    return pairs.join(left, "a").join(right, "b").filter(similar(F.col("of_a"), F.col("of_b"), percent)).select("a", "b")


def _needed_overlap(n: Column, m: Column, percent: int) -> Column:
    """Least intersection of sets of n and m members that are similar enough."""
    return F.ceil((percent * (n + m)) / (100 + percent))


def prefix_pairs(classes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """All pairs of ``classes`` (``cls``, ``n``, ``root``) in different components that
    pass the prefix, length and positional filters of the similarity join.

    Members are ordered by how many of the classes hold them.  Those that one
    class alone holds come first and match nothing, so they are only counted.
    """
    members = stored(classes.join(sets, "cls").select("cls", "n", "root", F.explode("members").alias("t")), "near_members")
    shared = stored(members.groupBy("t").agg(F.count(F.lit(1)).alias("df")).filter("df > 1"), "near_shared")
    held = members.join(shared, "t")
    rank = Window.partitionBy("cls").orderBy("df", "t")
    whole = Window.partitionBy("cls")
    placed = held.withColumn(
        "pos", F.col("n") - F.count(F.lit(1)).over(whole) + F.row_number().over(rank) - 1
    ).filter(F.col("pos") <= F.col("n") - F.ceil(percent * F.col("n") / 100))
    prefix = stored(placed.select("t", "cls", "n", "root", "pos"), "near_prefixes")
    other = prefix.select("t", F.col("cls").alias("b"), F.col("n").alias("m"), F.col("root").alias("root_b"), F.col("pos").alias("at"))
    within = F.least(F.col("n") - F.col("pos"), F.col("m") - F.col("at")) >= _needed_overlap(F.col("n"), F.col("m"), percent)
    return prefix.withColumnRenamed("cls", "a").join(other, "t").filter(
        (F.col("root") < F.col("root_b")) & within).select("a", "b").distinct()


def star_centers(banded: DataFrame) -> DataFrame:
    """Buckets (``k``, ``cls``, ``n``, ``center``) of two or more classes; the center is
    the class that shares the most buckets' places, then the largest."""
    sizes = stored(banded.groupBy("k").agg(F.count(F.lit(1)).alias("c")).filter("c > 1"), "near_sizes")
    hits = stored(banded.join(sizes, "k"), "near_hits")
    often = stored(hits.groupBy("cls").agg(F.sum("c").alias("often")), "near_often")
    ranked = stored(hits.select("k", "cls", "n").join(often, "cls"), "near_ranked")
    centers = stored(ranked.groupBy("k").agg(F.max_by("cls", F.struct("often", "cls")).alias("center")), "near_centers")
    return stored(ranked.select("k", "cls", "n").join(centers, "k"), "near_buckets")


def linked_classes(buckets: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(``node``, ``root``) of every class linked to another.

    ``buckets`` (``k``, ``cls``, ``n``, ``center``) holds the buckets of two or
    more classes, ``sets`` the full set of each class in them.
    """
    stars = buckets.filter(F.col("cls") != F.col("center")).select(
        F.col("center").alias("a"), F.col("cls").alias("b")).distinct()
    links = stored(verified(stars, sets, percent), "near_links")
    roots = components(links)

    placed = stored(buckets.join(roots, F.col("cls") == F.col("node"), "left").select(
        "k", "cls", "n", F.coalesce("root", "cls").alias("root")), "near_placed")
    parts = placed.groupBy("k").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    unsettled = placed.join(stored(parts.filter("low < high").select("k"), "near_unsettled"), "k")
    crossing = prefix_pairs(unsettled.select("cls", "n", "root").distinct(), sets, percent)
    more = stored(verified(crossing, sets, percent), "near_more")
    return components(links.unionByName(more)) if more.limit(1).count() else roots


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, percent: int = PERCENT,
    permutations: int = PERMUTATIONS, rows: int = BAND_ROWS,
) -> DataFrame:
    """One row per document: its id, ``text_hash``, ``n_shingles``, ``component_id`` (the
    smallest id reachable over links), ``kept`` (the id is that one) and ``component``,
    which tells components apart whatever their ids are (null without a word).

    Documents are linked when their sets of ``width``-word shingles have a
    Jaccard similarity of at least ``percent`` / 100.
    """
    src = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"), text_hash(F.col(text_col)))
    id_type = src.schema["doc"].dataType.simpleString()
    sig = stored(src.mapInArrow(
        _sketched(width, permutations, rows), f"doc {id_type}, text_hash long, cls binary, n long, bands array<long>"), "near_sketches")
    classes = stored(sig.filter("n > 0").groupBy("cls").agg(
        F.min("doc").alias("rep"), F.first("n").alias("n"), F.first("bands").alias("bands")), "near_classes")
    banded = stored(classes.select("cls", "n", F.explode("bands").alias("k")), "near_bands")
    buckets = star_centers(banded)
    needed = stored(classes.join(buckets.select("cls").distinct(), "cls").select("cls", "rep"), "near_needed")
    texts = src.join(needed.select("rep").distinct(), F.col("doc").eqNullSafe(F.col("rep")), "left_semi").select("text")
    full = texts.mapInArrow(_full_sets(width), "cls binary, members array<long>")
    sets = stored(full.join(needed.select("cls"), "cls", "left_semi").dropDuplicates(["cls"]), "near_sets")

    roots = linked_classes(buckets, sets, percent)
    named = classes.join(roots, F.col("cls") == F.col("node"), "left").select(
        "cls", "rep", F.coalesce("root", "cls").alias("root"))
    named = stored(named, "near_named")
    least = stored(named.groupBy("root").agg(F.min("rep").alias("component_id")), "near_roots")
    by_class = stored(named.join(least, "root").select("cls", "component_id", F.col("root").alias("component")), "near_components")
    out = sig.select("doc", "text_hash", "cls", "n").join(by_class, "cls", "left")
    component = F.when(F.col("cls").isNull(), F.col("doc")).otherwise(F.col("component_id"))
    return out.select(
        F.col("doc").alias(id_col), "text_hash", F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.col("doc").eqNullSafe(component).alias("kept"), "component",
    )
