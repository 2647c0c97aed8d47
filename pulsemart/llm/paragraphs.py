"""Removal of repeated paragraphs by MinHash banding.

Paragraphs are taken as written, line by line, and are cut by content too: such a one ends after a word pair whose hash is the
least within ``RADIUS`` words on either side, wherever the lines break.  So a passage
copied into another text falls into the same paragraphs there, but for its
edges, and an edited line is still near its source.  A paragraph is its set of 5-word shingles.  Equal paragraphs are one class;
classes are banded, colliding ones verified by exact Jaccard similarity and
joined into components (``neardup.linked_classes``); a component that several
documents share keeps its first paragraph and loses the others.  Runs of
repeated paragraphs under ``MIN_RUN`` words (a common line, a formula) are left alone.

Equal passages of ``PASSAGE`` words are found wherever they begin: of each
``PASSAGE - SPAN + 1`` consecutive runs of ``SPAN`` words the one with the least hash is
a seed (Schleimer et al., "Winnowing", 2003), so two texts with such a passage
share a seed in it.  Neighbouring seeds leave no word between them; from the outer
ones the passage is followed word by word to its ends.  Every such run of words
that several documents share is kept at its first place and removed at the others.

The bands are tuned: of all (bands, rows) that find a pair at the threshold with
probability ``RECALL``, the one that lets the fewest pairs below it through, in at most
``MOST_BANDS`` bands: a band is a stored key of every paragraph.

No table holds the paragraphs themselves: the first pass over the texts gives classes
and their bands, a later one the places of the classes that turned out to be repeated.
Tables are removed once their last reader has run, shuffles of all paragraphs at once.

Defined cases: null texts and paragraphs of fewer than ``MIN_WORDS`` words have
no part in it; repeated rows and ids are documents of one id, so a paragraph that
only they share is not shared by several documents; null ids come last; an
empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsemart.llm import sketch
from pulsemart.llm.common import broadcast_small, drop_shuffles, stored, working_tables
from pulsemart.llm.neardup import linked_classes, star_centers
from pulsemart.llm.scratch import Scratch

RADIUS = 7
MIN_WORDS = RADIUS + 1
MIN_RUN = 20                       # words in a run of repeated paragraphs at least
WIDTH = 5
PERCENT = 80
PASSAGE = 50                       # words of an equal passage that is found for certain
SPAN = 26                          # words of a seed: more than the distance of two seeds (PASSAGE - SPAN + 1)
RECALL = 0.99
MOST_BANDS = 5
SEED = 88
LINE_SALT = 0x5851F42D4C957F2D
FILTER_BITS = 24                   # a bit table of the wanted classes (2 MB at any size); a join settles the rest
REMEMBERED = 1 << 18               # classes a task remembers not to send their set twice
KEY_BYTES = 32                     # a key or class, and what is known of it, in memory


def tuned_bands(percent: int = PERCENT, recall: float = RECALL, most_bands: int = MOST_BANDS) -> tuple[int, int]:
    """(bands, rows): of all that find a pair at the threshold with probability ``recall``
    in at most ``most_bands`` bands (or as few as can), those that let the fewest pairs
    through whose similarity, even between 0 and the threshold, is lower."""
    low = np.linspace(0, percent / 100, 101)
    options = []
    for rows in range(1, 9):
        bands = int(np.ceil(np.log(1 - recall) / np.log(1 - (percent / 100) ** rows)))
        options.append((float(np.mean(1 - (1 - low ** rows) ** bands)), bands, rows))
    most = max(most_bands, min(bands for _, bands, _ in options))
    return min(o for o in options if o[1] <= most)[1:]


def _boundaries(pairs: np.ndarray, doc: np.ndarray, n_docs: int) -> np.ndarray:
    """Words after which a paragraph ends: strict minima on the left, minima on the right."""
    place = np.arange(len(pairs)) + RADIUS * (doc + 1)
    padded = np.full(len(pairs) + RADIUS * (n_docs + 2), np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[place] = pairs
    least = np.ones(len(pairs), dtype=bool)
    for k in range(1, RADIUS + 1):
        least &= (pairs < padded[place - k]) & (pairs <= padded[place + k])
    return np.flatnonzero(least)


def _cut(data: np.ndarray, offsets: np.ndarray):
    """(document, first byte, end byte, first word, words, first and end shingle)
    of each paragraph of MIN_WORDS words, the shingles, and what tells a line's
    class and keys from those of a piece: a line would collide with its own pieces."""
    starts, ends = sketch.word_bounds(data, offsets)
    hashes = sketch.word_hashes(data, starts, ends)
    if len(hashes) < MIN_WORDS:
        return None
    doc = np.searchsorted(offsets, starts, "right") - 1
    pairs = np.empty_like(hashes)
    pairs[0] = hashes[0]
    pairs[1:] = sketch.shingles(hashes, 2)
    first_of_doc = np.searchsorted(starts, offsets)
    ends_of_docs = first_of_doc[1:] - 1
    lines = np.searchsorted(np.flatnonzero(data == 10), starts)      # newlines before each word
    by_line = np.flatnonzero(lines[1:] != lines[:-1])
    spans, salts = [], []
    for marks, salt in ((_boundaries(pairs, doc, len(offsets) - 1), 0), (by_line, LINE_SALT)):
        last = np.union1d(marks, ends_of_docs)
        last = last[last >= 0]
        a, b = np.concatenate(([0], last[:-1] + 1)), last + 1
        long = b - a >= MIN_WORDS
        spans.append((a[long], b[long]))
        salts.append(np.full(int(long.sum()), salt, dtype=np.uint64))
    (a, b), salt = (np.concatenate(x) for x in zip(*spans)), np.concatenate(salts)
    base = offsets[doc[a]] if len(a) else np.zeros(0, np.int64)
    return doc[a], starts[a] - base, ends[b - 1] - base, a - first_of_doc[doc[a]], b - a, a, b - WIDTH + 1, sketch.shingles(hashes, WIDTH), salt


def _reduced(how, values: np.ndarray, a: np.ndarray, e: np.ndarray) -> np.ndarray:
    """``how`` over values[a:e] of each span."""
    spans = np.stack([a, e], axis=1).ravel()
    return how.reduceat(np.append(values, np.uint64(0)), spans)[::2]


def _paragraphs(bands: int, rows: int):
    a_hash, b_hash = sketch.random_odd(bands * rows, SEED), sketch.random_odd(bands * rows, SEED + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, offsets in sketch.slices(batch.column("text")):
                cut = _cut(data, offsets)
                if cut is None or not len(cut[0]):
                    continue
                doc, *_, a, e, shingles, salt = cut
                mins = np.empty((len(a), bands * rows), dtype=np.uint64)
                for j in range(bands * rows):
                    y = shingles * a_hash[j]
                    y ^= y >> np.uint64(32)
                    y *= b_hash[j]
                    mins[:, j] = _reduced(np.minimum, y, a, e)
                keys = (sketch.band_keys(mins, rows) ^ salt[:, None]).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc").take(pa.array(row + doc)), pa.array(_classes(a, e, shingles, salt)),
                     *[pa.array(np.ascontiguousarray(keys[:, j])) for j in range(bands)]],
                    ["doc", "cls", *[f"k{j}" for j in range(bands)]])
    return run


def _classes(a: np.ndarray, e: np.ndarray, shingles: np.ndarray, salt: np.ndarray) -> np.ndarray:
    """The class of each paragraph, by its shingles in any order."""
    return (sketch.mixed(_reduced(np.add, sketch.mixed(shingles), a, e)) ^ salt).view(np.int64)


def _bit_table(classes: DataFrame) -> np.ndarray:
    """A bit for every value of the low FILTER_BITS bits that some class has, as
    64-bit words: at most 2**(FILTER_BITS - 6) rows, whatever the number of classes."""
    low = F.col("cls").bitwiseAND(F.lit((1 << FILTER_BITS) - 1))
    words = classes.groupBy(F.shiftright(low, 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(cls & 63 as int))")).alias("bits")).toArrow()
    out = np.zeros(1 << (FILTER_BITS - 6), dtype=np.uint64)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return out


def _maybe(classes: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Positions of the classes whose bit is set."""
    own = classes.view(np.uint64)
    word = words[((own & np.uint64((1 << FILTER_BITS) - 1)) >> np.uint64(6)).astype(np.int64)]
    return np.flatnonzero((word >> (own & np.uint64(63))) & np.uint64(1))


def _sets(shared):
    """Shingle sets of the paragraphs whose class may be wanted."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = shared.value
        done: set[int] = set()
        for batch in batches:
            classes, members = [], []
            for _, data, offsets in sketch.slices(batch.column("text")):
                cut = _cut(data, offsets)
                if cut is None or not len(cut[0]):
                    continue
                *_, a, e, shingles, salt = cut
                cls = _classes(a, e, shingles, salt)
                for i in _maybe(cls, words).tolist():
                    if int(cls[i]) not in done:
                        if len(done) < REMEMBERED:
                            done.add(int(cls[i]))
                        classes.append(cls[i])
                        members.append(np.unique(shingles[a[i]:e[i]]).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(classes, pa.int64()), pa.array(members, pa.list_(pa.int64()))], ["cls", "members"])
    return run


def _places(shared):
    """The paragraphs whose class may be wanted, and where they stand."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = shared.value
        for batch in batches:
            for row, data, offsets in sketch.slices(batch.column("text")):
                cut = _cut(data, offsets)
                if cut is None or not len(cut[0]):
                    continue
                doc, begin, end, word, n_words, *of_class = cut
                cls = _classes(*of_class)
                found = _maybe(cls, words)
                at = pa.array(row + doc[found])
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc").take(at), batch.column("text_hash").take(at),
                    *[pa.array(x[found].astype(np.int32)) for x in (begin, end, word, n_words)], pa.array(cls[found]),
                ], ["doc", "text_hash", "begin", "end", "word", "n_words", "cls"])
    return run


def _sliding(how, values: np.ndarray, width: int) -> np.ndarray:
    """``how`` over values[i:i + width] of each i, by doubling."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = how(out[:-step], out[step:])
        have += step
    return out


def _seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The least of each PASSAGE - SPAN + 1 consecutive runs of SPAN words within a text."""
    width = PASSAGE - SPAN + 1
    for batch in batches:
        for row, data, offsets in sketch.slices(batch.column("text")):
            starts, ends = sketch.word_bounds(data, offsets)
            if len(starts) < PASSAGE:
                continue
            doc = np.searchsorted(offsets, starts, "right") - 1
            runs = sketch.shingles(sketch.word_hashes(data, starts, ends), SPAN)
            least = _sliding(np.minimum, runs, width)
            least[doc[:len(least)] != doc[PASSAGE - 1:]] = 0           # a window of two texts names no seed
            around = np.zeros(len(runs) + width - 1, dtype=np.uint64)
            around[width - 1:width - 1 + len(least)] = least
            at = np.flatnonzero((_sliding(np.maximum, around, width) == runs) & (doc[:len(runs)] == doc[SPAN - 1:]))
            own, base = pa.array(row + doc[at]), offsets[doc[at]]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc").take(own), batch.column("text_hash").take(own),
                pa.array((starts[at] - base).astype(np.int32)), pa.array((ends[at + SPAN - 1] - base).astype(np.int32)),
                pa.array((at - np.searchsorted(starts, offsets)[doc[at]]).astype(np.int32)),
                pa.array(runs[at].view(np.int64)),
            ], ["doc", "text_hash", "begin", "end", "word", "h"])


def _followed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The runs of SPAN words before (even) and after (odd numbers) a text's outer
    seeds, ``at`` = 2 * word + side, as far as the next seed of a passage may be."""
    reach = np.arange(1, PASSAGE - SPAN + 1)
    for batch in batches:
        parts = []
        sides = batch.column("at").to_pylist()
        for row, data, offsets in sketch.slices(batch.column("text")):
            starts, ends = sketch.word_bounds(data, offsets)
            runs = sketch.shingles(sketch.word_hashes(data, starts, ends), SPAN)
            first = np.searchsorted(starts, offsets)
            for i in range(len(offsets) - 1):
                at = np.array(sides[row + i], dtype=np.int64)
                word = np.unique((at >> 1)[:, None] + np.where(at & 1, 1, -1)[:, None] * reach)
                word = word[(word >= 0) & (word <= first[i + 1] - first[i] - SPAN)]
                k = first[i] + word
                parts.append((np.full(len(k), row + i), starts[k] - offsets[i], ends[k + SPAN - 1] - offsets[i], word, runs[k]))
        if parts:
            own, begin, end, word, h = (np.concatenate(x) for x in zip(*parts))
            own = pa.array(own)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc").take(own), batch.column("text_hash").take(own), pa.array(begin.astype(np.int32)),
                pa.array(end.astype(np.int32)), pa.array(word.astype(np.int32)), pa.array(h.view(np.int64)),
            ], ["doc", "text_hash", "begin", "end", "word", "h"])


def _of_several(runs: DataFrame, name: str) -> DataFrame:
    """The runs of words that documents of several ids hold, with the smallest
    id (``component``) and whether they stand at another place than the first."""
    place = F.struct(F.col("doc").isNull().alias("no_id"), "doc", "text_hash", "begin")
    ids = runs.groupBy("h").agg(F.min("doc").alias("component"), F.max("doc").alias("most"))
    several = stored(ids.filter("component < most").select("h", "component"), f"{name}_several")
    held = stored(runs.join(broadcast_small(several, KEY_BYTES), "h").distinct(), f"{name}_held")
    drop_shuffles(runs.sparkSession)
    firsts = stored(held.groupBy("h").agg(F.min(place).alias("first")), f"{name}_firsts")
    return stored(held.join(firsts, "h").withColumn("removed", place != F.col("first")).drop("first"), name)


def _passages(src: DataFrame) -> DataFrame:
    """A row per equal passage of PASSAGE words or more that several documents share."""
    id_type = src.schema["doc"].dataType.simpleString()
    schema = f"doc {id_type}, text_hash long, begin int, end int, word int, h long"
    seeds = _of_several(stored(src.mapInArrow(_seeds, schema), "passage_seeds"), "passage_shared")
    own = Window.partitionBy("doc", "text_hash").orderBy("word")
    far = PASSAGE - SPAN + 1
    ends = seeds.select("h", (F.col("word") - F.lag("word").over(own)).alias("back"), (F.lead("word").over(own) - F.col("word")).alias("on"))
    outer = ends.filter(F.coalesce(F.col("back") > far, F.lit(True))).select("h", F.lit(0).alias("side")).unionByName(
        ends.filter(F.coalesce(F.col("on") > far, F.lit(True))).select("h", F.lit(1).alias("side")))
    outer = stored(outer.distinct(), "passage_outer")      # an outer seed of one text is followed in all
    sides = stored(seeds.join(outer, "h").groupBy(F.col("doc").alias("d"), F.col("text_hash").alias("t")).agg(
        F.collect_set((2 * F.col("word") + F.col("side")).cast("int")).alias("at")), "passage_sides")
    texts = src.join(sides, F.col("doc").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("t")))
    more = _of_several(stored(texts.select("doc", "text_hash", "text", "at").mapInArrow(_followed, schema), "passage_ends"), "passage_more")

    runs = seeds.unionByName(more)
    group = ("doc", "text_hash", "component", "removed")
    before = Window.partitionBy(*group).orderBy("word").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("starts", F.coalesce(F.max("word").over(before) + SPAN < F.col("word"), F.lit(True)).cast("int"))
    runs = runs.withColumn("run", F.sum("starts").over(before.rowsBetween(Window.unboundedPreceding, 0)))
    return runs.groupBy(*group, "run").agg(
        F.min("begin").alias("begin"), F.max("end").alias("end"), (F.max("word") + SPAN - F.min("word")).alias("n_words"))


def repeated_paragraphs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, recall: float = RECALL,
) -> DataFrame:
    """A row per paragraph or equal passage that several documents share: the document's id and
    ``text_hash``, ``begin`` and ``end`` (bytes of the UTF-8 text), ``n_words``,
    ``component`` (the smallest id that holds the passage) and ``removed``."""
    spark = docs.sparkSession
    bands, rows = tuned_bands(percent, recall)
    text = F.coalesce(F.col(text_col), F.lit(""))
    src = docs.select(F.col(id_col).alias("doc"), text.alias("text"), F.xxhash64(text).alias("text_hash"))
    id_type = src.schema["doc"].dataType.simpleString()
    scratch = Scratch(spark, "paragraphs")
    place = F.struct(F.col("doc").isNull().alias("no_id"), "doc", "text_hash", "begin")
    with working_tables(spark):
        own_keys = [f"k{j}" for j in range(bands)]
        found = src.select("doc", "text").mapInArrow(
            _paragraphs(bands, rows), f"doc {id_type}, cls long, " + ", ".join(f"{k} long" for k in own_keys))
        classes = found.groupBy("cls", *own_keys).agg(F.min("doc").alias("low"), F.max("doc").alias("high"))
        classes = stored(classes, "paragraph_classes")
        drop_shuffles(spark)
        banded = classes.select("cls", F.explode(F.array(*own_keys)).alias("k"))
        shared = stored(banded.groupBy("k").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("k"), "paragraph_keys")
        drop_shuffles(spark)
        hits = stored(banded.join(broadcast_small(shared, KEY_BYTES), "k"), "paragraph_hits")
        wanted = stored(hits.select("cls").distinct(), "paragraph_wanted")
        sets = src.select("text").mapInArrow(
            _sets(spark.sparkContext.broadcast(_bit_table(wanted))), "cls long, members array<long>")
        sets = sets.join(wanted, "cls", "left_semi")
        sets = stored(sets.dropDuplicates(["cls"]), "paragraph_sets")
        with working_tables(spark):
            sized = hits.join(sets.select("cls", F.size("members").cast("long").alias("n")), "cls")
            roots = scratch.store(linked_classes(star_centers(sized.select("k", "cls", "n")), sets, percent), "roots")
        rooted = classes.select("cls", "low", "high").join(broadcast_small(roots, KEY_BYTES), F.col("cls") == F.col("node"), "left")
        rooted = stored(rooted.filter("root is not null or low < high").select(       # a class alone in one document is no repeat
            "cls", F.coalesce("root", "cls").alias("root"), "low", "high"), "paragraph_roots")
        drop_shuffles(spark)
        several = stored(rooted.groupBy("root").agg(F.min("low").alias("component"), F.max("high").alias("most"))
                         .filter("component < most").select("root", "component"), "paragraph_components")
        repeated = stored(rooted.select("cls", "root").join(several, "root"), "paragraph_repeated")
        places = src.mapInArrow(_places(spark.sparkContext.broadcast(_bit_table(repeated))),
                                f"doc {id_type}, text_hash long, begin int, end int, word int, n_words int, cls long")
        located = scratch.store(places.join(repeated, "cls").drop("cls").distinct(), "located")
        firsts = scratch.store(located.groupBy("root").agg(F.min(place).alias("first")), "firsts")
    scratch.drop("roots")
    own = Window.partitionBy("doc", "text_hash").orderBy("word", "n_words")
    stop = F.col("word") + F.col("n_words")
    starts = F.coalesce(F.max(stop).over(own.rowsBetween(Window.unboundedPreceding, -1)) < F.col("word"), F.lit(True))
    out = located.join(firsts, "root").withColumn("starts", starts.cast("int"))
    out = out.withColumn("run", F.sum("starts").over(own.rowsBetween(Window.unboundedPreceding, 0)))
    of_run = Window.partitionBy("doc", "text_hash", "run")
    out = out.withColumn("run_words", F.max(stop).over(of_run) - F.min("word").over(of_run))
    columns = (F.col("doc").alias(id_col), "text_hash", "begin", "end", "n_words", "component", "removed")
    out = out.filter(F.col("run_words") >= MIN_RUN).withColumn("removed", place != F.col("first")).select(*columns)
    with working_tables(spark):
        passages = scratch.store(_passages(src), "passages")
    return out.unionByName(passages.select(*columns))


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
            raw, at, kept = (text or "").encode("utf-8", "surrogatepass"), 0, []
            for span in sorted((s["begin"], s["end"]) for s in spans or ()):
                kept.append(raw[at:span[0]])
                at = max(at, span[1])
            texts.append(b"".join([*kept, raw[at:]]).decode("utf-8", "surrogatepass") if spans else text)
        yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.array(texts, pa.string())], ["doc", "text"])


def without_paragraphs(docs: DataFrame, repeated: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text) of every document, without its removed paragraphs."""
    lost = repeated.filter("removed").groupBy(F.col(id_col).alias("d"), F.col("text_hash").alias("h")).agg(
        F.collect_set(F.struct("begin", "end")).alias("spans"))
    src = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"))
    src = src.withColumn("h0", F.xxhash64(F.coalesce("text", F.lit(""))))
    joined = src.join(lost, F.col("doc").eqNullSafe(F.col("d")) & (F.col("h0") == F.col("h")), "left")
    id_type = src.schema["doc"].dataType.simpleString()
    return joined.select("doc", "text", "spans").mapInArrow(_without, f"doc {id_type}, text string").toDF(id_col, text_col)
