"""Collocations by dynamic itemset counting (Brin et al., SIGMOD 1997).

The texts are dealt into ``CYCLE`` shards that are scanned in turn, again and again.
Words are counted from the first scan on.  A longer phrase becomes active in the
scan after the one in which both its subphrases (all words but the last, all but
the first) reached the threshold; it is counted in that shard and the following
ones until it has met every shard once, so phrases of all lengths are counted side
by side and every count is exact.  A phrase that stays under the threshold after
its cycle is dropped; counting ends when nothing new has become active for a cycle.

Which phrases reached the threshold, and when, goes to the tasks as a table of
fixed size, a byte for each value of the phrase's hash: the first scan after which
a phrase of this hash had reached it.  Entries are written once, so all scans
agree on a phrase's start.  Phrases that share a byte can activate a longer one too
early or needlessly: it is still counted over one whole cycle.  A phrase is named by
the 64-bit hashes of its two subphrases; words carry their text, and longer
phrases get theirs from their subphrases at the end.

Every task counts the phrases of a batch first, so a phrase that fills a third of
the text is one row a batch.

Defined cases: a null text is empty, a null language is ``und``; empty tables and
tables without a frequent phrase give an empty table; repeated rows count as
often as they occur; ids and other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pulsemart.llm import sketch
from pulsemart.llm.scratch import Scratch

MIN_COUNT = 100
MAX_WORDS = 5
TOP = 2000
CYCLE = 4                          # shards
ABSORB_PERCENT = 100               # a longer phrase with this share of the count absorbs a candidate
MARK_BITS = 23                     # bytes of the table of starts (8 MB at any size)
NEVER = 255
HELD = 1 << 20                     # counts a task holds before it sends them on
SALTS = 64
UNKNOWN_LANG = "und"

CUTS = np.zeros(256, bool)         # [.,;:!?\x0A-\x0D]
CUTS[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
SEPARATORS = CUTS.copy()
SEPARATORS[[9, 32]] = True

# products of counts pass 64 bits, so they are decimals of 38 digits
SCORE = ("cast((cast(1000 AS decimal(4,0)) * cast(a AS decimal(19,0)) * cast(n AS decimal(15,0)))"
         " div (cast(l AS decimal(19,0)) * cast(r AS decimal(19,0))) AS long)")

_STATE = "k int, a long, b long, lang string, word string, start int, n long"


def phrase_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of a phrase from the hashes of its two subphrases."""
    return sketch.mixed(sketch.mixed(a) + (b << np.uint64(1)))


def _lang_seed(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")


def _tally(parts: list[tuple]) -> tuple:
    """Rows (name, columns..., n) of several slices with equal names added up."""
    name = np.concatenate([p[0] for p in parts])
    _, first, group = np.unique(name, return_index=True, return_inverse=True)
    n = np.bincount(group, weights=np.concatenate([p[-1] for p in parts]), minlength=len(first)).astype(np.int64)
    return first, n


def _scan(batches: Iterator[pa.RecordBatch], step: int, cycle: int, max_words: int, marks) -> Iterator[pa.RecordBatch]:
    """The counts of all phrases active in this step, batch by batch."""
    table = np.frombuffer(marks.value, np.uint8)
    low = np.uint64(len(table) - 1)
    for batch in batches:
        langs = batch.column("lang").dictionary_encode()
        names = langs.dictionary.to_pylist()
        lang_of = langs.indices.to_numpy()
        seeds = np.array([_lang_seed(x) for x in names], np.uint64)
        words, longer, held = [], [[] for _ in range(max_words + 1)], 0
        for row, data, offsets in sketch.slices(batch.column("text")):
            starts, ends = sketch.word_bounds(data, offsets, SEPARATORS)
            if not len(starts):
                continue
            doc = np.searchsorted(offsets, starts, "right") - 1
            lang = lang_of[row + doc]
            name = sketch.mixed(sketch.word_hashes(data, starts, ends) ^ seeds[lang])
            if step < cycle:
                _, first, n = np.unique(name, return_index=True, return_counts=True)
                lower = sketch.LOWER[data]
                text = [lower[s:e].tobytes() for s, e in zip(starts[first].tolist(), ends[first].tolist())]
                words.append((name[first], lang[first], text, n))
                held += len(first)
            cut = np.zeros(len(data) + 1, np.int32)
            np.cumsum(CUTS[data], out=cut[1:])
            joined = (cut[starts[1:]] == cut[ends[:-1]]) & (doc[1:] == doc[:-1])
            mark = table[(name & low).astype(np.int64)]
            for k in range(2, max_words + 1):
                at = np.flatnonzero(joined & (mark[:-1] != NEVER) & (mark[1:] != NEVER))
                if not len(at):
                    break
                a, b = name[at], name[at + 1]
                start = np.maximum(mark[at], mark[at + 1]).astype(np.int32) + 1
                full = phrase_hash(a, b)
                now = (start <= step) & (step < start + cycle)
                if now.any():
                    _, first, n = np.unique(full[now], return_index=True, return_counts=True)
                    longer[k].append((full[now][first], a[now][first], b[now][first], start[now][first], n))
                    held += len(first)
                name = np.zeros_like(name)
                name[at] = full
                mark = np.full(len(mark), NEVER, np.uint8)
                mark[at] = table[(full & low).astype(np.int64)]
            if held > HELD:
                yield from _rows(names, words, longer)
                words, longer, held = [], [[] for _ in range(max_words + 1)], 0
        yield from _rows(names, words, longer)


def _rows(names: list[str], words: list[tuple], longer: list[list[tuple]]) -> Iterator[pa.RecordBatch]:
    """The counts of several slices, equal phrases added up."""
    if words:
        first, n = _tally(words)
        text = [t for w in words for t in w[2]]
        yield _state_batch(
            1, np.concatenate([w[0] for w in words])[first], None, n,
            [names[i] for i in np.concatenate([w[1] for w in words])[first]], [text[i] for i in first], None)
    for k, parts in enumerate(longer):
        if parts:
            first, n = _tally(parts)
            a, b, start = (np.concatenate([p[i] for p in parts])[first] for i in (1, 2, 3))
            yield _state_batch(k, a, b, n, None, None, start)


def _state_batch(k: int, a, b, n, lang, word, start) -> pa.RecordBatch:
    size = len(a)
    return pa.record_batch([
        pa.array(np.full(size, k, np.int32)), pa.array(a.view(np.int64)),
        pa.array(np.zeros(size, np.int64) if b is None else b.view(np.int64)),
        pa.nulls(size, pa.string()) if lang is None else pa.array(lang, pa.string()),
        pa.nulls(size, pa.string()) if word is None else pa.array(word, pa.binary()).cast(pa.string()),
        pa.array(np.zeros(size, np.int32) if start is None else start), pa.array(n),
    ], names=["k", "a", "b", "lang", "word", "start", "n"])


def _with_name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the hash by which longer phrases name these."""
    for batch in batches:
        a, b = (batch.column(c).to_numpy(zero_copy_only=False).view(np.uint64) for c in ("a", "b"))
        one = batch.column("k").to_numpy(zero_copy_only=False) == 1
        yield batch.append_column("name", pa.array(np.where(one, a, phrase_hash(a, b)).view(np.int64)))


def frequent_phrases(
    docs: DataFrame, scratch: Scratch, text_col: str = "text", lang_col: str = "lang",
    min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, cycle: int = CYCLE,
) -> tuple[DataFrame, DataFrame]:
    """(phrases, totals): ``lang``, ``k``, ``phrase``, ``f`` of every phrase found
    ``min_count`` times or more, and the words ``n`` of each language."""
    spark = docs.sparkSession
    shard = F.pmod(F.monotonically_increasing_id(), F.lit(cycle)).cast("int")
    texts = scratch.store(docs.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN_LANG)).alias("lang"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"), shard.alias("shard"),
    ), "texts", partition_by="shard")
    marks = np.full(1 << MARK_BITS, NEVER, np.uint8)
    state, done, totals = None, [], None
    step, last_mark = 0, -1
    while step < cycle or step <= last_mark + cycle:
        sent = spark.sparkContext.broadcast(marks.tobytes())
        counted = texts.filter(F.col("shard") == step % cycle).select("lang", "text").mapInArrow(
            lambda b, step=step, sent=sent: _scan(b, step, cycle, max_words, sent), _STATE)
        counted = counted.withColumn("before", F.lit(0).cast("long"))
        if state is not None:
            open_ = state.filter(F.col("start") + cycle > step)
            counted = counted.unionByName(open_.withColumn("before", F.col("n")))
        merged = counted.groupBy("k", "a", "b", "lang", "word").agg(
            F.min("start").alias("start"), F.sum("n").alias("n"), F.sum("before").alias("before"))
        state = scratch.store(merged, f"state{step}")
        reached = state.filter((F.col("n") >= min_count) & (F.col("before") < min_count) & (F.col("k") < max_words))
        slot = F.col("name").bitwiseAND(F.lit((1 << MARK_BITS) - 1)).cast("int").alias("slot")
        slots = reached.select("k", "a", "b").mapInArrow(_with_name, "k int, a long, b long, name long")
        slots = slots.select(slot).distinct().toArrow().column("slot").to_numpy()
        fresh = slots[marks[slots] == NEVER]
        if len(fresh):
            marks[fresh] = step
            last_mark = step
        over = state.filter((F.col("start") + cycle - 1 == step) & (F.col("n") >= min_count))
        done.append(scratch.store(over.drop("start", "before"), f"done{step}"))
        if step == cycle - 1:
            totals = scratch.store(state.filter("k = 1").groupBy("lang").agg(F.sum("n").alias("n")), "totals")
        scratch.drop(*([f"state{step - 1}"] if step else []))
        sent.destroy()
        step += 1
    scratch.drop(f"state{step - 1}", "texts")
    found = done[0]
    for part in done[1:]:
        found = found.unionByName(part)
    named = scratch.store(
        found.mapInArrow(_with_name, "k int, a long, b long, lang string, word string, n long, name long"), "named")
    scratch.drop(*[f"done{s}" for s in range(step)])
    level = scratch.store(named.filter("k = 1").select("name", "lang", F.col("word").alias("phrase"), F.col("n").alias("f")), "texts1")
    levels = [level]
    for k in range(2, max_words + 1):
        head = levels[-1].select(F.col("name").alias("a"), "lang", F.col("phrase").alias("head"))
        tail = levels[-1].select(F.col("name").alias("b"), F.substring_index("phrase", " ", -1).alias("tail"))
        level = named.filter(F.col("k") == k).select("name", "a", "b", F.col("n").alias("f")).join(head, "a").join(tail, "b")
        levels.append(scratch.store(level.select("name", "lang", F.concat_ws(" ", "head", "tail").alias("phrase"), "f"), f"texts{k}"))
    phrases = None
    for k, level in enumerate(levels, 1):
        level = level.select("lang", F.lit(k).alias("k"), "phrase", "f")
        phrases = level if phrases is None else phrases.unionByName(level)
    return phrases, totals


def _whole(c: Column) -> Column:
    return c.cast("decimal(19,0)")


def _parts(first: Column, size: Column) -> Column:
    words = F.split("phrase", " ")
    return F.array_join(F.slice(words, first, size), " ")


def collocations(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = MIN_COUNT,
    max_words: int = MAX_WORDS, top: int = TOP, absorb_percent: int = ABSORB_PERCENT, cycle: int = CYCLE,
) -> DataFrame:
    """The ``top`` phrases of each language: ``lang``, ``rank``, ``phrase``, ``a`` (its
    count), ``l`` and ``r`` (the counts of the parts of its weakest cut), ``n`` (words of
    the language) and ``score`` = floor(1000 * a * n / (l * r))."""
    scratch = Scratch(docs.sparkSession, "phrases")
    phrases, totals = frequent_phrases(docs, scratch, text_col, lang_col, min_count, max_words, cycle)
    cand = phrases.filter("k >= 2")
    # every cut's parts are at least as frequent as the phrase, so they are among the phrases
    cuts = cand.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("k") - 1))).select(
        "lang", "phrase", "k", F.col("f").alias("a"), "cut",
        _parts(F.lit(1), F.col("cut")).alias("first"), _parts(F.col("cut") + 1, F.col("k") - F.col("cut")).alias("rest"),
    )
    first = phrases.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    rest = phrases.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    both = cuts.join(first, ["lang", "first"]).join(rest, ["lang", "rest"]).join(totals, "lang")
    score = F.expr(SCORE)
    weakest = F.min(F.struct("score", "cut", "l", "r")).alias("w")
    scored = both.withColumn("score", score).groupBy("lang", "phrase", "a", "n").agg(weakest).select(
        "lang", "phrase", "a", "n", "w.l", "w.r", "w.score")
    inner = cand.filter("k >= 3").withColumn("size", F.explode(F.expr("sequence(2, k - 1)"))).withColumn(
        "at", F.explode(F.expr("sequence(1, k - size + 1)")))
    inner = inner.select("lang", _parts(F.col("at"), F.col("size")).alias("phrase"), "f").groupBy("lang", "phrase").agg(
        F.max("f").alias("longer"))
    absorbed = F.coalesce(100 * _whole(F.col("longer")) >= absorb_percent * _whole(F.col("a")), F.lit(False))
    left = scored.join(inner, ["lang", "phrase"], "left").filter(~absorbed).drop("longer")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    # the first of each salt, then the first of all: no language is sorted by one task
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))
    part = F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))
    ahead = left.withColumn("salt", salt).withColumn("nth", part).filter(F.col("nth") <= top)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    return ahead.withColumn("rank", rank).filter(F.col("rank") <= top).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score")
