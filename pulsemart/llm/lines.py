"""Line dedup over range-partitioned line hashes; keep bitmaps instead of text.

Each line's key (stripped, A-Z lower-cased) is hashed to 128 bits.  The
hashes are range-partitioned by (hash, document) and sorted by document and
position within a partition, so a line that fills a third of the table is
spread over many partitions, and the first occurrence of a line in a document
is the head of its run.  Only those first occurrences are counted per key, after a
partial count in each range; the largest document among them keeps the line.  What leaves the operator is a run-length keep bitmap per
document; the search never shuffles a text, attaching the bitmaps does.

Defined cases: a null or empty text is one empty line; a null ``doc_id``
counts as one document, smaller than every other; rows that repeat a
``doc_id`` are told apart by their text, and equal rows get equal bitmaps; an
empty table gives an empty table; other columns of the input are ignored, so
their names can't clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsemart.llm.common import SPACES, let, lower_az, stored

MIN_CHARS = 40
MIN_DOCS = 5


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """Spaces stripped at both ends, A-Z lower-cased."""
    return lower_az(F.btrim(line, F.lit(SPACES)))


def _kept_runs(n: Column, dropped: Column) -> Column:
    """Runs (start, length) of kept lines between sorted dropped positions."""
    def run(k: Column) -> Column:
        start = F.coalesce(F.get(dropped, k - 1) + 1, F.lit(0))
        return F.struct(start.alias("start"), (F.coalesce(F.get(dropped, k), n) - start).alias("length"))

    return F.filter(F.transform(F.sequence(F.lit(0), F.size(dropped)), run), lambda r: r["length"] > 0)


def keep_bitmaps(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
) -> DataFrame:
    """One row per distinct (document, text) that loses lines: ``doc``,
    ``text_hash``, ``n_dropped`` and ``kept``, the run-length keep bitmap as
    an array of (start, length).

    A key of at least ``min_chars`` code points found in at least ``min_docs``
    documents loses its lines everywhere but in the largest document id.
    """
    src = docs.select(F.col(id_col).alias("doc"), F.coalesce(text_col, F.lit("")).alias("text"))
    lines = src.select(
        "doc", F.xxhash64("text").alias("text_hash"), F.posexplode(_lines(F.col("text"))).alias("pos", "line")
    ).filter(F.char_length("line") >= min_chars)
    keyed = lines.select("doc", "text_hash", "pos", line_key(F.col("line")).alias("k")).filter(
        F.char_length("k") >= min_chars
    )
    occurrences = stored(
        keyed.select(F.unhex(F.md5("k")).alias("h"), "doc", "text_hash", "pos"), "line_hashes"
    )
    # Ranges hold whole (h, doc), sorted by position, so the window needs no exchange and
    # no further sort: it streams, and the first row of each run is a first occurrence.
    ranged = occurrences.select("h", "doc", "pos").repartitionByRange("h", "doc").sortWithinPartitions("h", "doc", "pos")
    place = F.row_number().over(Window.partitionBy("h", "doc").orderBy("pos"))
    firsts = ranged.withColumn("place", place).filter("place = 1")
    spread = stored(
        firsts.groupBy("h").agg(F.count(F.lit(1)).alias("n_docs"), F.max("doc").alias("keeper"))
        .filter(F.col("n_docs") >= min_docs).select("h", "keeper"),
        "line_keys",
    )
    lost = occurrences.join(spread, "h").filter(~F.col("doc").eqNullSafe(F.col("keeper")))
    return lost.groupBy("doc", "text_hash").agg(F.sort_array(F.collect_set("pos")).alias("dropped"))


def line_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
) -> DataFrame:
    """Every row of ``docs`` with ``n_lines``, ``n_dropped``, ``kept`` (the
    run-length keep bitmap) and ``kept_text``."""
    lost = keep_bitmaps(docs, id_col, text_col, min_chars, min_docs)
    src = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("body"))
    src = src.withColumn("body_hash", F.xxhash64("body"))
    joined = src.join(
        lost, F.col("id").eqNullSafe(F.col("doc")) & (F.col("body_hash") == F.col("text_hash")), "left"
    )
    n_lines = F.char_length("body") - F.char_length(F.replace("body", F.lit("\n"), F.lit(""))) + 1
    none = F.array(F.struct(F.lit(0).alias("start"), n_lines.alias("length")))
    kept = F.when(F.col("dropped").isNull(), none).otherwise(_kept_runs(n_lines, F.col("dropped")))
    text = F.when(F.col("dropped").isNull(), F.col("body")).otherwise(
        let(_lines(F.col("body")), lambda all_lines: F.array_join(
            F.transform(
                _kept_runs(F.size(all_lines), F.col("dropped")),
                lambda r: F.array_join(F.slice(all_lines, r["start"] + 1, r["length"]), "\n"),
            ), "\n",
        ))
    )
    return joined.select(
        F.col("id").alias(id_col), n_lines.cast("long").alias("n_lines"),
        F.when(F.col("dropped").isNull(), 0).otherwise(F.size("dropped")).cast("long").alias("n_dropped"),
        kept.alias("kept"), text.alias("kept_text"),
    )
