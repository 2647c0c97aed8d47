"""Benchmark decontamination as a prefix-filtered set join.

A benchmark window (ten consecutive item words, or a shorter item whole) is
the set of its 3-word shingles.  Containment needs every shingle, so one
necessary token is enough as the join prefix: the window's rarest shingle by
its count over all documents.  A document position that holds a prefix token
fixes where the window would have to start; windows that would begin before
the document or run past its end fall to the positional and length bounds, and the
rest are compared word for word.

The benchmark's windows are counted in bytes first and joined in blocks under
``BLOCK_BYTES``, each sent to the tasks as a dictionary; a larger benchmark
means more blocks, each counted and probed over the documents.  Which items a
found window stands for is a shuffled join on the few windows found.

Defined cases: null or wordless texts have no words and no hits; an item
without words has no window; equal windows of several items count for each of
them; repeated rows get equal results; without items, or without
documents, nothing is hit or the result is empty; other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsemart.llm import sketch
from pulsemart.llm.common import rows_again, stored, whole_rows

WINDOW = 10
WIDTH = 3
BLOCK_BYTES = 16 << 20
SEPARATOR = np.ones(256, dtype=bool)      # words: digits, letters a-z and everything beyond ASCII
SEPARATOR[48:58] = SEPARATOR[65:91] = SEPARATOR[97:123] = SEPARATOR[128:] = False
FILTER_BITS = 22


def _texts(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes in lower case, word starts, word ends, word hashes) of each text."""
    for _, data, offsets in sketch.slices(column):
        starts, ends = sketch.word_bounds(data, offsets, SEPARATOR)
        hashes = sketch.word_hashes(data, starts, ends)
        lower = sketch.LOWER[data]
        cuts = np.searchsorted(starts, offsets)
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            yield lower, starts[lo:hi], ends[lo:hi], hashes[lo:hi]


def _run(lower: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> bytes:
    """Consecutive words joined by single spaces."""
    return b" ".join(lower[s:e].tobytes() for s, e in zip(starts, ends))


def _item_windows(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items, found = [], []
            for item, (lower, starts, ends, _) in zip(batch.column("item").to_pylist(), _texts(batch.column("text"))):
                size = min(window, len(starts))
                own = {_run(lower, starts[i:i + size], ends[i:i + size]) for i in range(len(starts) - size + 1)} if size else ()
                items += [item] * len(own)
                found += own
            yield pa.RecordBatch.from_arrays(
                [pa.array(items, batch.column("item").type), pa.array(found, pa.binary())], ["item", "win"])
    return run


class Block:
    """Windows of one block with their shingle hashes."""

    def __init__(self, windows: list[bytes]):
        self.windows = windows
        column = pa.array(windows, pa.binary())
        self.shingles = [sketch.shingles(h, WIDTH) for _, _, _, h in _texts(column)]
        self.sizes = [len(w.split(b" ")) for w in windows]
        self.widths = sorted({min(WIDTH, n) for n in self.sizes})

    def prefixes(self, counts: dict[int, int]) -> dict[int, list[tuple[int, int]]]:
        """Rarest shingle -> (window, its position in the window)."""
        out: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for i, s in enumerate(self.shingles):
            at = min(range(len(s)), key=lambda k: (counts.get(int(s[k]), 0), int(s[k]), k))
            out[int(s[at])].append((i, at))
        return dict(out)


class Lookup:
    """Membership of 64-bit hashes in a fixed set, by a bit table and then a search."""

    def __init__(self, keys):
        self.keys = np.unique(np.array(list(keys), dtype=np.uint64))
        self.table = np.zeros(1 << FILTER_BITS, dtype=bool)
        self.table[(self.keys >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True

    def positions(self, hashes: np.ndarray) -> np.ndarray:
        maybe = np.flatnonzero(self.table[(hashes >> np.uint64(64 - FILTER_BITS)).astype(np.int64)])
        if not len(maybe):
            return maybe
        at = np.minimum(np.searchsorted(self.keys, hashes[maybe]), len(self.keys) - 1)
        return maybe[self.keys[at] == hashes[maybe]]


def _count_shingles(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        lookup = Lookup(h for s in block.shingles for h in s)
        for batch in batches:
            hits = []
            for _, _, _, hashes in _texts(batch.column("text")):
                for width in block.widths:
                    if len(hashes) >= width:
                        own = sketch.shingles(hashes, width)
                        hits.append(own[lookup.positions(own)])
            found, n = np.unique(np.concatenate(hits) if hits else np.zeros(0, np.uint64), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found.view(np.int64)), pa.array(n.astype(np.int64))], ["shingle", "n"])
    return run


def _probe(shared):
    """Adds the block's exact window occurrences to each document's lists."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, prefixes = shared.value
        lookup = Lookup(prefixes)
        for batch in batches:
            n_words, begins, lengths, found = [], [], [], []
            earlier = zip(*(batch.column(c).to_pylist() for c in ("begins", "lengths", "found")))
            for (b0, l0, f0), (lower, starts, ends, hashes) in zip(earlier, _texts(batch.column("text"))):
                hits: set[tuple[int, int]] = set()
                for width in block.widths:
                    if len(hashes) < width:                      # length bound
                        continue
                    own = sketch.shingles(hashes, width)
                    for p in lookup.positions(own).tolist():
                        for i, at in prefixes[int(own[p])]:
                            begin, size = p - at, block.sizes[i]
                            if begin < 0 or begin + size > len(starts) or (begin, i) in hits:    # positional bound
                                continue
                            if _run(lower, starts[begin:begin + size], ends[begin:begin + size]) == block.windows[i]:
                                hits.add((begin, i))
                ordered = sorted(hits)
                n_words.append(len(starts))
                begins.append(b0 + [b for b, _ in ordered])
                lengths.append(l0 + [block.sizes[i] for _, i in ordered])
                found.append(f0 + list({block.windows[i] for _, i in ordered}))
            now = {
                "n_words": pa.array(n_words, pa.int64()), "begins": pa.array(begins, pa.list_(pa.int64())),
                "lengths": pa.array(lengths, pa.list_(pa.int64())), "found": pa.array(found, pa.list_(pa.binary())),
            }
            names = batch.schema.names
            yield pa.RecordBatch.from_arrays([now.get(c, batch.column(c)) for c in names], names)
    return run


def _union_length(begins: Column, lengths: Column) -> Column:
    """Positions covered by the spans."""
    spans = F.array_sort(F.arrays_zip(begins.alias("b"), lengths.alias("n")))
    zero = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("total"))

    def step(acc: Column, s: Column) -> Column:
        end = F.greatest(acc["end"], s["b"] + s["n"])
        return F.struct(end.alias("end"), (acc["total"] + end - F.greatest(acc["end"], F.least(s["b"], end))).alias("total"))

    return F.aggregate(spans, zero, step, lambda acc: acc["total"])


def _probed(
    docs: DataFrame, benchmark: DataFrame, item_col: str, item_text_col: str, window: int, block_bytes: int,
) -> tuple[DataFrame, DataFrame]:
    """(documents, owners): the columns of ``docs``, one of them ``text``, with ``n_words`` and
    every document's window occurrences (``begins``, ``lengths``, ``found``), and each
    window's items."""
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_col).alias("item"), F.col(item_text_col).alias("text"))
    item_type = items.schema["item"].dataType.simpleString()
    owners = stored(items.mapInArrow(_item_windows(window), f"item {item_type}, win binary"), "bench_windows")
    windows = owners.select("win").distinct()
    size = owners.agg(F.sum(F.octet_length("win"))).first()[0] or 0
    blocks = -(-size // block_bytes)

    nothing = [F.array().cast(f"array<{t}>").alias(c) for c, t in
               (("begins", "bigint"), ("lengths", "bigint"), ("found", "binary"))]
    probed = docs.select("*", F.lit(0).cast("long").alias("n_words"), *nothing)
    for b in range(max(1, blocks)):
        own = windows if blocks < 2 else windows.filter(F.pmod(F.xxhash64("win"), F.lit(blocks)) == b)
        block = Block(sorted(bytes(r["win"]) for r in own.collect()))      # at most about block_bytes
        counted = docs.select("text").mapInArrow(
            _count_shingles(spark.sparkContext.broadcast(block)), "shingle long, n long")
        counts = {r["shingle"] % (1 << 64): r["n"] for r in counted.groupBy("shingle").agg(F.sum("n").alias("n")).collect()}
        probed = probed.mapInArrow(_probe(spark.sparkContext.broadcast((block, block.prefixes(counts)))), probed.schema)
    return probed, owners


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per document: its id, ``text_hash``, ``n_words``, ``n_hit`` (words inside an
    occurrence of a window), ``items`` (ids whose windows occur, sorted as
    strings), ``spans`` (first word and length of each occurrence)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    src = docs.select(F.col(id_col).alias("doc"), text.alias("text"), F.xxhash64(text).alias("text_hash"))
    probed, owners = _probed(src, benchmark, item_col, item_text_col, window, block_bytes)
    found = stored(probed.select(
        "doc", "text_hash", "n_words", _union_length(F.col("begins"), F.col("lengths")).alias("n_hit"),
        F.arrays_zip("begins", "lengths").alias("spans"), "found"), "bench_found")

    hits = found.filter(F.size("found") > 0).select("doc", "text_hash", F.explode("found").alias("win"))
    of_doc = hits.join(owners, "win").groupBy(F.col("doc").alias("d"), F.col("text_hash").alias("h")).agg(
        F.array_sort(F.collect_set(F.col("item").cast("string"))).alias("items"))
    joined = found.join(of_doc, F.col("doc").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("h")), "left")
    return joined.select(
        F.col("doc").alias(id_col), "text_hash", "n_words", "n_hit",
        F.coalesce("items", F.array().cast("array<string>")).alias("items"), "spans",
    )


def without_benchmark_rows(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The rows of ``docs`` without a window of any item, all their columns, in the
    probing pass itself: a verdict on one row needs no join."""
    rows = whole_rows(docs, text_col).withColumnRenamed("apart0", "text")
    probed, _ = _probed(rows, benchmark, item_col, item_text_col, window, block_bytes)
    clean = probed.filter(F.size("found") == 0).withColumnRenamed("text", "apart0")
    return rows_again(clean, docs, text_col)
