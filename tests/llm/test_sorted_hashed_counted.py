"""Suffix dedup, Merkle manifest and collocations against brute force on small
tables: nulls, empty and long texts, ties, repeated rows, empty tables, clashing names."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulsemart.llm import merkle, phrases, suffixes

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, grp string, pos long, digit long, "
          "run long, name long, k int, a long, start int, size int, spans string, path string, block long")
CLASH = ("g", -1, -1, -1, -1, 7, -1, 9, 9, "s", "p", -1)
LOWER = {i: chr(i + 32) for i in range(65, 91)}


def _docs(spark, rows):
    return spark.createDataFrame([(d, t, lang, src, None if t is None else len(t), *CLASH) for d, t, lang, src in rows], SCHEMA)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    words = [rng.choice(["Ä", "b", "ç", ""]) + "".join(rng.choice("abcde") for _ in range(rng.randint(1, 8))) for _ in range(60)]

    def prose(n):
        return "".join(rng.choice(words) + rng.choice([" ", " ", " ", ", ", "\n", ".\t", "  ", "; "]) for _ in range(n))
    base = [prose(rng.randint(5, 120)) for _ in range(40)]
    shared = [prose(30) for _ in range(4)]
    texts = list(base)
    for i in range(60):
        t = base[i % 40]
        cut = rng.randint(0, len(t))
        texts.append(t[:cut] + shared[i % 4][: rng.randint(40, 200)] + t[cut:])
    texts += [None, "", " \n\t", "x", "a" * 49, "a" * 50, "a" * 51, "a" * 500, "ab" * 300, "é" * 25, "é" * 25, "é" * 24 + "a",
              base[0], base[0], base[1].upper(), prose(9000)]
    texts.append(texts[-1][:20000] + "!" + texts[-1][20000:])
    out = [(i, t, [None, "en", "de", "und"][i % 4], [None, "a", "b", "ü", ""][i % 5 if i % 3 else 1]) for i, t in enumerate(texts)]
    out += [(7, base[2], "en", "a"), (7, base[3], "en", "a"), (7, base[2], "en", "a"), (None, base[4], None, None),
            (None, base[4], None, None), (None, None, None, None), (-5, shared[0] * 3, "de", "b")]
    return out


@pytest.fixture(scope="module")
def odd(spark, rows):
    return _docs(spark, rows).repartition(5).cache()


def _removed(rows):
    """Per row (bytes, removed bytes, spans, kept), window by window."""
    least = {}
    rank = lambda d: -(1 << 63) if d is None else d
    for d, t, *_ in rows:
        b = (t or "").encode()
        for p in range(len(b) - 49):
            w = b[p:p + 50]
            least[w] = min(least.get(w, rank(d)), rank(d))
    for d, t, *_ in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - 49):
            if least[b[p:p + 50]] < rank(d):
                gone[p:p + 50] = True
        spans = int((gone & ~np.append(False, gone[:-1])).sum()) if len(b) else 0
        yield d, len(b), int(gone.sum()), spans, bytes(np.frombuffer(b, np.uint8)[~gone])


def test_suffix_dedup_is_every_repeated_window(odd, rows):
    got = Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"]))
                  for r in suffixes.suffix_dedup(odd).collect())
    want = Counter(_removed(rows))
    assert got == want
    assert sum(r[2] > 0 for r in want) > 40


def test_runs_cover_every_suffix_once():
    rng = np.random.default_rng(3)
    for _ in range(30):
        sizes = rng.integers(0, 400, 12)
        data = rng.integers(97, 97 + rng.integers(1, 4), sizes.sum()).astype(np.uint8)
        offsets = np.concatenate(([0], np.cumsum(sizes)))
        doc, start, size, _, _ = suffixes.runs(data, offsets)
        seen = [p for s, n in zip(start, size) for p in range(s, s + n)]
        want = [p for a, z in zip(offsets[:-1], offsets[1:]) for p in range(a, z - 49)]
        assert sorted(seen) == want and (size <= suffixes.RUN).all()
        assert all(offsets[d] <= s and s + n - 1 + 50 <= offsets[d + 1] for d, s, n in zip(doc, start, size))


def test_equal_windows_share_their_first_digit():
    rng = np.random.default_rng(4)
    window = rng.integers(97, 101, 50).astype(np.uint8)
    digits = set()
    for _ in range(20):
        left, right = (rng.integers(97, 101, n).astype(np.uint8) for n in rng.integers(0, 90, 2))
        data = np.concatenate([left, window, right])
        _, start, size, digit, _ = suffixes.runs(data, np.array([0, len(data)]))
        digits.update(d for s, n, d in zip(start, size, digit) if s <= len(left) < s + n)
    assert len(digits) == 1


def test_suffix_dedup_of_a_passage_in_every_document(spark):
    passage = "the quick brown fox jumps over the lazy dog and runs far away from here"
    docs = _docs(spark, [(i, f"{i:06d} {passage} {i * 7919 % 1000:05d}", None, None) for i in range(3000)])
    got = suffixes.suffix_dedup(docs).groupBy("n_removed").count().collect()
    assert {r["n_removed"] for r in got} >= {0} and sum(r["count"] for r in got if r["n_removed"] >= len(passage)) == 2999


def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _manifest(rows):
    def code(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    def tree(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            last = levels[-1]
            levels.append([_h(*last[i:i + 16]) for i in range(0, len(last), 16)])
        return levels

    def path(levels, at):
        for level in levels[:-1]:
            run = at // 16 * 16
            yield level[run:at], level[at + 1:run + 16]
            at //= 16
    groups = defaultdict(list)
    for d, t, lang, src in rows:
        head = [code(d), code(src), code(lang), code(None if t is None else len(t))]
        low = d is not None and zlib.crc32(str(d).encode()) % 5 == 0 and t is not None
        leaf = _h(*head, code(t))
        groups[src].append((d, leaf, _h(*head, code(t.translate(LOWER))) if low else leaf))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        groups[s].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[s] = tree([x[1] for x in groups[s]])
    upper = tree([trees[s][-1][0] for s in order])
    for i, s in enumerate(order):
        for at, (d, leaf, seen) in enumerate(groups[s]):
            steps = [*path(trees[s], at), *path(upper, i)]
            node = seen
            for left, right in steps:
                node = _h(*left, node, *right)
            proof = _h(*[x for left, right in steps for x in left + right])
            yield d, leaf, trees[s][-1][0], upper[-1][0], proof, node, node == upper[-1][0]


def _many(rows):
    return rows + [(1000 + i, f"Row {i}", "en", "hot") for i in range(5000)] + [(9000 + i, "x", "en", f"s{i}") for i in range(300)]


def test_merkle_manifest(spark, rows):
    many = _many(rows)
    out = merkle.merkle_manifest(_docs(spark, many).repartition(7))
    got = Counter((r["doc_id"], r["leaf"], r["subroot"], r["root"], r["proof_sha256"], r["folded_root"], r["verified"])
                  for r in out.collect())
    assert got == Counter(_manifest(many))


def test_merkle_of_one_row_and_of_one_block(spark):
    for n in (1, 16, 17, 256, 257):
        few = [(i, f"Text {i}", "en", "only") for i in range(n)]
        got = {r["doc_id"]: (r["proof_sha256"], r["folded_root"]) for r in merkle.merkle_manifest(_docs(spark, few)).collect()}
        assert got == {w[0]: (w[4], w[5]) for w in _manifest(few)}


def test_versions_copy_only_ancestors(spark):
    few = [(i, f"Text {i}", "en", "ab"[i % 2]) for i in range(1200)]
    out = merkle.merkle_manifest(_docs(spark, few)).cache()
    nodes = merkle.versions(out)
    own = nodes.groupBy("source", "version").agg(F.count("*").alias("n"), F.max_by("node", "level").alias("top")).collect()
    changed = [i for i in range(1200) if zlib.crc32(str(i).encode()) % 5 == 0]
    # 600 leaves a source: 38, 3 and 1 nodes above them, then the root over both sources
    assert len(own) == len(changed) and {r["n"] for r in own} == {4}
    folded = {(r["source"], r["pos"]): r["folded_root"] for r in out.collect()}
    assert all(folded[r["source"], r["version"]] == r["top"] for r in own)


def _frequent(rows, least):
    counts, totals = defaultdict(Counter), Counter()
    for _, t, lang, _ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (t or "").translate(LOWER)):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            totals[lang] += len(words)
            for k in range(1, 6):
                counts[lang].update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    return {lang: {p: f for p, f in c.items() if f >= least} for lang, c in counts.items()}, totals


def _collocations(rows, least, top):
    frequent, totals = _frequent(rows, least)
    for lang, found in frequent.items():
        n, out = totals[lang], []
        for p, a in found.items():
            if len(p) < 2:
                continue
            score, k = min((1000 * a * n // (found[p[:k]] * found[p[k:]]), k) for k in range(1, len(p)))
            longer = [f for q, f in found.items() if len(q) > len(p)
                      and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))]
            if not any(f >= a for f in longer):
                out.append((-score, -a, " ".join(p).encode(), found[p[:k]], found[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(out)[:top], 1):
            yield lang, rank, p.decode(), -a, left, right, n, -score


@pytest.mark.parametrize("least, top, cycle", [(3, 2000, 4), (10, 25, 3), (100, 2000, 1)])
def test_collocations(odd, rows, least, top, cycle):
    got = [tuple(r) for r in phrases.collocations(odd, min_count=least, top=top, cycle=cycle).collect()]
    want = list(_collocations(rows, least, top))
    assert sorted(got) == sorted(want)
    assert len(want) >= {3: 41, 10: 26, 100: 0}[least]          # at 100 no phrase is left


def test_exact_scores_past_64_bits(spark):
    """A count, a language and parts whose products pass 64 bits."""
    a, n, left, right = 3_000_000_007, 9_000_000_000_003, 4_000_000_009, 5_000_000_021
    row = spark.createDataFrame([(a, n, left, right)], "a long, n long, l long, r long")
    got = row.select(F.expr(phrases.SCORE)).first()[0]
    assert got == 1000 * a * n // (left * right)


def test_longer_phrases_wait_for_their_subphrases(spark, monkeypatch):
    """No phrase is counted in the scan in which its parts reach the threshold, and
    each is counted in a whole cycle of shards."""
    seen = defaultdict(set)
    docs = _docs(spark, [(i, "alpha beta gamma", "en", None) for i in range(64)]).coalesce(1)
    store = phrases.Scratch.store

    def spy(self, df, name, partition_by=None):
        out = store(self, df, name, partition_by)
        if name.startswith("state"):
            for r in out.collect():
                seen[r["k"], r["a"]].add((int(name[5:]), r["start"], r["n"]))
        return out
    monkeypatch.setattr(phrases.Scratch, "store", spy)
    found, _ = phrases.frequent_phrases(docs, phrases.Scratch(spark, "spy"), min_count=20, cycle=4)
    # 16 texts a shard: words reach 20 in scan 1, pairs start in scan 2 and reach it in 3, the triple starts in 4
    assert {(r["phrase"], r["f"]) for r in found.collect()} == {
        (p, 64) for p in ("alpha", "beta", "gamma", "alpha beta", "beta gamma", "alpha beta gamma")}
    starts = defaultdict(set)
    for (k, _), steps in seen.items():
        starts[k].update(s for _, s, _ in steps)
    assert starts == {1: {0}, 2: {2}, 3: {4}}


def test_empty_tables(spark):
    none = _docs(spark, [])
    assert suffixes.suffix_dedup(none).count() == 0
    assert merkle.merkle_manifest(none).count() == 0
    assert phrases.collocations(none).count() == 0


def test_mixing_prefers_long_documents(spark):
    """Inclusion odds differ inside a source: the shares taken follow the length classes,
    which a plain random order of the documents would not."""
    from pulsemart.llm import mixing

    rng = random.Random(2)
    sizes = [rng.choice([3, 20, 150]) for _ in range(6000)]
    docs = _docs(spark, [(i, " ".join(["w"] * n), None, "one") for i, n in enumerate(sizes)])
    out = mixing.mix_sources(docs, percent=60).collect()
    share = defaultdict(list)
    for r in out:
        share[r["size"]].append(r["copies"])
    rate = {n: sum(c) / len(c) for n, c in share.items()}
    classes = {3: 2, 20: 5, 150: 8}
    factor = 0.6 * sum(sizes) / sum(n * classes[n] for n in sizes)
    assert all(abs(rate[n] - factor * classes[n]) < 0.05 for n in rate)
    assert rate[3] < rate[20] < rate[150]
    total = sum(r["taken"] for r in out)
    assert abs(total - 0.6 * sum(sizes)) <= 150


def test_mixed_rows_repeat_what_the_mix_takes(spark, odd, rows):
    from pulsemart.llm import mixing

    taken = Counter()
    for r in mixing.mix_sources(odd).collect():
        taken[r["doc_id"], r["text_hash"]] = max(taken[r["doc_id"], r["text_hash"]], r["copies"])
    got = mixing.mixed_rows(odd)
    assert got.columns == odd.columns
    counted = Counter((r["doc_id"], r["h"]) for r in got.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect())
    rows_of = Counter((r["doc_id"], r["h"]) for r in odd.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).collect())
    assert counted == Counter({k: n * rows_of[k] for k, n in taken.items() if n})


def test_line_firsts_stream_from_the_sorted_ranges(spark, odd, monkeypatch):
    """The plan that finds the spread lines: one range exchange, its sort, a window over
    it, and no other exchange before the count."""
    from pulsemart.llm import lines

    plans = []
    store = lines.stored

    def spy(df, name):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return store(df, name)
    monkeypatch.setattr(lines, "stored", spy)
    lines.keep_bitmaps(odd, min_chars=5, min_docs=2).collect()
    plan = dict(plans)["line_keys"]
    assert plan.count("rangepartitioning") == 1 and "Window [row_number()" in plan
    assert plan.count("Sort [") == 1 and plan.count("hashpartitioning") == 1


def test_rule_costs_are_the_rules_own(spark):
    """A rule that walks the words costs several times one that compares two counts,
    which job start-up would hide; of equal rejections the cheap one goes first."""
    from pulsemart.llm import quality

    docs = spark.range(400).select(F.concat_ws(" ", *[F.concat(F.lit("w"), F.col("id") * k) for k in range(150)]).alias("text"),
                                   F.col("id").alias("n_words"))
    cheap = quality.Rule("cheap", F.col("n_words") >= 200)
    dear = quality.Rule("dear", (F.size(F.filter(F.split("text", " "), lambda x: x.rlike("q+z$"))) == 0) & (F.col("n_words") >= 200))
    sample = docs.persist()
    sample.count()
    (r1, c1), (r2, c2) = quality.measured(sample, [cheap, dear])
    assert r1 == r2 == 200 and c2 > 3 * c1
    assert [r.name for r in quality.ordered_by_benefit(docs, [dear, cheap])] == ["cheap", "dear"]
