"""Defined cases of every operator on small tables: nulls, empty and long texts,
ties, repeated rows, empty tables and columns with clashing names."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import pytest

from pulsemart.llm import (
    catalog, chat, decontaminate, lines, lm, mixing, neardup, paragraphs, quality, sharding, toxicity,
)

SPACE_WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: chr(i + 32) for i in range(65, 91)}
SCHEMA = "doc_id long, text string, lang string, source string, size long, shard int, n long, cls string, k string"
LONG = " ".join(f"word{i % 977} the" for i in range(30_000))
LINE = "A line that is long enough to count, and common: Émile."


def _row(doc, text, source="a"):
    return (doc, text, None, source, -1, -1, -1, "x", "y")


def _docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def odd(spark):
    """Texts with every defined case; ids repeat, one is null."""
    base = " ".join(f"tok{i}" for i in range(60))
    texts = [
        (1, None), (2, ""), (3, " \t\n\x0b\x0c\r "), (4, "One"), (5, "one two"), (6, LONG), (7, LONG),
        (8, base), (9, base.upper()), (10, base + " more"), (11, "\n\n"), (12, f"{LINE}\nx\n{LINE}"),
        (12, f"{LINE}\nother"), (13, f"  {LINE.upper().replace('É', 'É')} \n"), (14, LINE), (15, LINE), (16, f"y\n{LINE}"),
        (17, f"{LINE}\n{LINE}"), (8, base), (None, base), (None, None), (18, "ÉÉ é “quoted” ß #*$%&|<>"),
        (19, "dup dup dup dup dup dup dup dup " * 10),
    ]
    return _docs(spark, [_row(d, t, [None, "a", "b", "é"][i % 4]) for i, (d, t) in enumerate(texts)]), texts


@pytest.fixture(scope="module")
def empty(spark):
    return _docs(spark, [])


def _words(text):
    return SPACE_WORD.findall(text or "")


def test_line_dedup(odd):
    docs, texts = odd
    def key(x):
        return x.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    holders = defaultdict(set)
    for d, t in texts:
        for x in (t or "").split("\n"):
            if len(key(x)) >= 40:
                holders[key(x)].add(d)
    drop = {k: max((d for d in h if d is not None), default=None) for k, h in holders.items() if len(h) >= 5}
    want = Counter()
    for d, t in texts:
        every = (t or "").split("\n")
        kept = [x for x in every if not (key(x) in drop and drop[key(x)] != d)]
        want[(d, len(every), len(every) - len(kept), "\n".join(kept))] += 1
    got = lines.line_dedup(docs).select("doc_id", "n_lines", "n_dropped", "kept_text").collect()
    assert Counter(map(tuple, got)) == want
    assert any(r["n_dropped"] for r in got)


def test_line_bitmaps_are_runs(odd):
    for r in lines.line_dedup(odd[0]).collect():
        assert sum(x["length"] for x in r["kept"]) == r["n_lines"] - r["n_dropped"]


def test_quality_counts(odd):
    docs, texts = odd
    want = Counter()
    for d, t in texts:
        w = _words(t)
        tri = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
        n = Counter(tri)
        hit = {i + j for i, x in enumerate(tri) if n[x] > 1 for j in range(3)}
        spaced = [x for x in (t or "").split("\n") if _words(x)]
        failed = len(w) < 50 or 100 * len(hit) > 50 * len(w)
        want[(d, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""),
              len(spaced) - len(set(spaced)), len(hit), failed)] += 1
    out = quality.quality_rules(docs)
    got = out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert Counter(map(tuple, got.collect())) == want
    assert not out.filter("base_failed and kept").count()


def test_quality_verdict_is_order_free(odd):
    rules = quality.standard_rules()
    a = quality.quality_rules(odd[0], rules=rules).select("doc_id", "n_words", "kept").collect()
    b = quality.quality_rules(odd[0], rules=rules[::-1]).select("doc_id", "n_words", "kept").collect()
    assert Counter(a) == Counter(b)


def test_repeats_survive_hash_clashes(spark, monkeypatch):
    """With every window under one hash the words themselves decide."""
    monkeypatch.setattr(quality, "HASH_MASK", 0)
    from pyspark.sql import functions as F
    text = "a b c d a b c e f a b c"
    got = spark.createDataFrame([(text,)], "t string").select(quality.repeated_words(F.split("t", " "))).first()[0]
    assert got == 9


def _decontaminated(texts, items):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    wins = defaultdict(set)
    for i, t in items:
        w = word.findall((t or "").translate(LOWER))
        n = min(10, len(w))
        for k in range(len(w) - n + 1 if w else 0):
            wins[tuple(w[k:k + n])].add(i)
    sizes = {len(w) for w in wins}
    out = Counter()
    for d, t in texts:
        w = word.findall((t or "").translate(LOWER))
        hit, found = set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in wins:
                    hit |= set(range(k, k + n))
                    found |= wins[tuple(w[k:k + n])]
        out[(d, len(w), len(hit), tuple(sorted(map(str, found))))] += 1
    return out


ITEMS = [(1, " ".join(f"tok{i}" for i in range(20, 40))), (2, "one, TWO"), (3, None), (4, "..."), (5, "One two"),
         (10, " ".join(f"Tok{i}" for i in range(25, 36))), (11, "é")]


@pytest.mark.parametrize("block_bytes", [1 << 20, 200])
def test_decontamination(spark, odd, block_bytes):
    docs, texts = odd
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    out = decontaminate.decontaminate(docs, bench, block_bytes=block_bytes).collect()
    assert Counter((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"])) for r in out) == _decontaminated(texts, ITEMS)


def _near(texts, width, percent):
    sets = []
    for _, t in texts:
        w = _words((t or "").translate(LOWER))
        n = min(width, len(w))
        sets.append(frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if w else frozenset())
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    out = Counter()
    for i, (d, _) in enumerate(texts):
        ids = [texts[j][0] for j in range(len(texts)) if sets[i] and find(j) == find(i)] if sets[i] else [d]
        low = min((x for x in ids if x is not None), default=None)
        out[(d, len(sets[i]), low, d == low)] += 1
    return out


@pytest.mark.parametrize("width,percent", [(3, 85), (5, 80)])
def test_near_duplicates(odd, width, percent):
    docs, texts = odd
    out = neardup.near_duplicates(docs, width=width, percent=percent).drop("text_hash", "component").collect()
    assert Counter(map(tuple, out)) == _near(texts, width, percent)


def test_near_duplicates_of_a_varied_group(spark):
    """Many variants of one text: similar to some of each other, not to all."""
    import random
    rng = random.Random(4)
    base = [f"w{rng.randrange(10**6)}" for _ in range(120)]
    texts = []
    for i in range(120):
        own = list(base)
        for _ in range(rng.randrange(0, 9)):
            own[rng.randrange(len(own))] = f"x{rng.randrange(10**6)}"
        texts.append((i, " ".join(own)))
    out = neardup.near_duplicates(_docs(spark, [_row(*t) for t in texts]), width=3, percent=85).drop("text_hash", "component").collect()
    assert Counter(map(tuple, out)) == _near(texts, 3, 85)


def test_sharding(odd):
    docs, texts = odd
    out = sharding.shard_by_bytes(docs, 4).select("doc_id", "text", "size", "shard", "slot").collect()
    assert Counter((r["doc_id"], r["text"]) for r in out) == Counter(texts)
    assert all(r["size"] == len((r["text"] or "").encode()) + 8 for r in out)
    slots = defaultdict(list)
    for r in out:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_sharding_cuts_a_group_of_copies(spark):
    rows = [_row(i, "same text") for i in range(600)] + [_row(1000 + i, f"text {i}") for i in range(600)]
    out = sharding.shard_by_bytes(_docs(spark, rows), 8).groupBy("shard").sum("size").collect()
    sums = [r[1] for r in out]
    assert len(sums) == 8 and max(sums) - min(sums) <= 64
    again = sharding.shard_by_bytes(_docs(spark, rows), 8).select("doc_id", "shard", "slot").collect()
    assert Counter(again) == Counter(sharding.shard_by_bytes(_docs(spark, rows[::-1]), 8).select("doc_id", "shard", "slot").collect())


def test_mixing(odd):
    docs, texts = odd
    out = mixing.mix_sources(docs).collect()
    assert len(out) == len(texts)
    size, taken, target = defaultdict(int), defaultdict(int), {}
    for r in out:
        size[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        assert r["taken"] <= 2 * r["size"]
    assert all(target[s] <= 2 * size[s] for s in size)
    assert math.isclose(sum(target.values()), 1.5 * sum(size.values()))
    largest = max(r["size"] for r in out)
    assert all(abs(taken[s] - target[s]) <= largest for s in size)


def test_targets_share_the_excess(spark):
    rows = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 1000), (None, 500)], "source string, size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(rows).collect()}
    # a stops at 20; the other 3745 words go by weights 1, 2 and 3, where the null source stops at 1000
    assert got["a"] == 20 and got[None] == 1000
    assert math.isclose(got["b"], (3765 - 1020) / 3) and math.isclose(got["c"], min(2000, 2 * (3765 - 1020) / 3))


def test_chat(spark):
    rows = [
        (1, 0, "system", "be kind"), (1, 1, "ann", "hi <|im_end|>"), (1, 2, "bob", "hello"), (1, 3, "ann", None),
        (1, 3, "ann", None), (2, 0, None, "x"), (None, None, "", "y"), (3, 0, "system", "alone"),
    ]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = {(r["conv_id"], r["speaker"]): r for r in chat.rotate_perspectives(turns).collect()}
    assert set(out) == {(1, "ann"), (1, "bob"), (2, "unknown"), (None, "unknown")}
    ann = out[(1, "ann")]
    assert ann["rendered"] == (
        "<|im_start|>system\nbe kind<|im_end|>\n<|im_start|>assistant\nhi <​|im_end|><|im_end|>\n"
        "<|im_start|>user name=bob\nhello<|im_end|>\n<|im_start|>assistant\n<|im_end|>\n")
    masked = [ann["rendered"][m["start"]:m["start"] + m["length"]] for m in ann["mask"]]
    assert masked == ["hi <​|im_end|><|im_end|>", "<|im_end|>"]
    bob = out[(1, "bob")]
    assert [bob["rendered"][m["start"]:m["start"] + m["length"]] for m in bob["mask"]] == ["hello<|im_end|>"]


def test_chat_parts_hold_a_long_conversation(spark):
    turns = spark.createDataFrame([(1, i, "ab"[i % 2], f"t{i}") for i in range(1000)], "conv_id long, turn long, role string, text string")
    out = chat.rotate_perspectives(turns, part_turns=64).orderBy("part").collect()
    assert max(r["n_turns"] for r in out) <= 64
    whole = "".join(r["rendered"] for r in out if r["speaker"] == "a")
    assert re.findall(r"\nt(\d+)<", whole) == [str(i) for i in range(1000)]


def test_chat_parts_follow_places_not_turn_numbers(spark):
    """Turns 250 to 261, clock-like and null turn numbers: one part each.  A cut part
    repeats the context turns, and its mask still marks the speaker's text."""
    rows = [(1, t, "system" if t == 250 else "ab"[t % 2], f"t{t}") for t in range(250, 262)]
    rows += [(2, 1_700_000_000 + 977 * i, "ab"[i % 2], f"c{i}") for i in range(6)]
    rows += [(3, None, "ab"[i % 2], f"n{i}") for i in range(5)] + [(3, 9, "a", "first")]
    rows += [(4, i, "system" if i in (0, 1) else "ab"[i % 2], f"p{i}") for i in range(25)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = chat.rotate_perspectives(turns, part_turns=12).collect()
    parts = {c: {r["part"]: r for r in out if r["conv_id"] == c and r["speaker"] == "a"} for c in (1, 2, 3, 4)}
    assert [sorted(parts[c]) for c in (1, 2, 3, 4)] == [[0], [0], [0], [0, 1, 2]]
    assert parts[1][0]["rendered"].startswith("<|im_start|>system\nt250<")
    assert re.findall(r"\n(\w+)<", parts[3][0]["rendered"]) == ["first", "n0", "n2", "n4", "n1", "n3"]
    for part, own in ((0, range(12)), (1, range(12, 24)), (2, range(24, 25))):
        r = parts[4][part]
        again = [] if part == 0 else ["p0", "p1"]
        assert (r["n_turns"], r["n_context"]) == (len(own), len(again))
        assert re.findall(r"\n(\w+)<", r["rendered"]) == again + [f"p{i}" for i in own]
        masked = [r["rendered"][m["start"]:m["start"] + m["length"]] for m in r["mask"]]
        assert masked == [f"p{i}<|im_end|>" for i in own if i > 1 and i % 2 == 0]


def test_paragraphs(spark):
    import random
    rng = random.Random(9)
    def text(n):
        return [f"v{rng.randrange(10**7)}" for _ in range(n)]
    passage = text(120)
    docs = [(i, " ".join(text(200) + passage + text(100))) for i in range(30)] + [(100 + i, " ".join(text(300))) for i in range(30)]
    docs += [(200, None), (201, ""), (202, "few words")]
    out = paragraphs.repeated_paragraphs(_docs(spark, [_row(*d) for d in docs])).collect()
    assert {r["doc_id"] for r in out} == set(range(30))
    assert not any(r["removed"] for r in out if r["doc_id"] == 0)
    inside = set(passage)
    kept = {r["doc_id"]: r["text"] for r in paragraphs.without_paragraphs(
        _docs(spark, [_row(*d) for d in docs]), paragraphs.repeated_paragraphs(_docs(spark, [_row(*d) for d in docs]))).collect()}
    assert len(kept) == len(docs)
    for i, text_ in docs:
        if not 0 < i < 30:
            assert kept[i] == text_
        else:                          # most of the passage goes, the document's own words stay (but for a near edge)
            left = Counter(kept[i].split())
            assert sum(left[w] for w in inside) <= 50
            assert sum(n for w, n in left.items() if w not in inside) >= 290


def test_edited_paragraphs(spark):
    import random
    rng = random.Random(4)
    def text(n):
        return [f"e{rng.randrange(10**7)}" for _ in range(n)]
    def grams(words):
        return {tuple(words[i:i + 5]) for i in range(len(words) - 4)}
    docs, near, far = [], set(), set()
    for i in range(60):
        n, changes = ((55, 1), (60, 1), (100, 2), (60, 5))[i % 4]
        first = text(n)
        other = list(first)
        for at in range(changes):
            other[(at + 1) * n // (changes + 1)] = f"new{i}x{at}"
        a, b = grams(first), grams(other)
        (near if len(a & b) >= 0.8 * len(a | b) else far).add(1000 + i)
        for d, passage in ((i, first), (1000 + i, other)):
            docs.append((d, "\n".join(" ".join(x) for x in (text(40), passage, text(30)))))
    out = paragraphs.repeated_paragraphs(_docs(spark, [_row(*d) for d in docs])).collect()
    texts = {d: t.split("\n") for d, t in docs}
    whole = {r["doc_id"] for r in out if r["removed"]
             and (r["begin"], r["end"]) == (len(texts[r["doc_id"]][0]) + 1, sum(map(len, texts[r["doc_id"]][:2])) + 1)}
    assert len(near) == 45 and len(near - whole) <= 1      # one in a hundred at 0.8 may be missed
    assert not whole & far


def test_short_passages_go_whole(spark):
    import random
    rng = random.Random(12)
    def text(n):
        return [f"s{rng.randrange(10**7)}" for _ in range(n)]
    docs, own = [], {}
    for i in range(100):
        passage = text(50 + i % 11)
        for d in (i, 1000 + i):
            head, tail = text(rng.randrange(0, 90)), text(rng.randrange(0, 90))
            own[d] = (head, passage, tail)
            docs.append((d, " ".join(head + passage + tail)))
    table = _docs(spark, [_row(*d) for d in docs])
    kept = {r["doc_id"]: r["text"] for r in paragraphs.without_paragraphs(table, paragraphs.repeated_paragraphs(table)).collect()}
    for i in range(100):
        assert kept[i].split() == sum(own[i], [])
        head, passage, tail = own[1000 + i]
        left = kept[1000 + i].split()
        assert not set(passage) & set(left)
        assert len(left) >= len(head) + len(tail) - 8      # a near piece may take some words beside the passage along


def test_bands_reach_the_recall():
    for percent, recall in ((80, 0.99), (80, 0.9999), (60, 0.95)):
        bands, rows = paragraphs.tuned_bands(percent, recall)
        assert 1 - (1 - (percent / 100) ** rows) ** bands >= recall
    assert paragraphs.tuned_bands() == (5, 2)              # three bands of one row reach the recall too, with more false pairs
    assert paragraphs.tuned_bands(most_bands=9) == (9, 4)


def test_lm_counts_and_base(odd):
    docs, texts = odd
    def tokens(t):
        return [*_words((t or "").translate(LOWER)), None]
    def held(d):
        return zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2
    counts = Counter(w for d, t in texts if not held(d) for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    out = lm.lm_scores(docs, rounds=1).collect()
    got = Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in out)
    want = Counter((d, held(d), len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), n,
                    round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens(t)), 6)) for d, t in texts)
    assert got == want
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in out)


def test_lm_learns_from_every_training_document(spark, monkeypatch):
    from pyspark.sql import functions as F
    seen, mean = [], lm.averaged
    def averaged(models, tasks):
        seen.append(models.agg(F.sum("seen")).first()[0] or 0)
        return mean(models, tasks)
    monkeypatch.setattr(lm, "averaged", averaged)
    docs = [_row(i, " ".join(f"w{(i * k) % 50}" for k in range(i % 9 + 1))) for i in range(80)]
    out = lm.lm_scores(_docs(spark, docs)).collect()
    assert sum(seen) == out[0]["train_tokens"] == sum(r["n_tokens"] for r in out if not r["held_out"])


def test_lm_probabilities_sum_to_one(spark):
    import numpy as np
    head = np.arange(1, 200, dtype=np.uint64)
    vocab = lm.Vocabulary(head, head, np.arange(200, 1, -1)[:199], (10, 30_000, 400))
    model = lm.new_model(vocab)
    rng = np.random.default_rng(0)
    model["class_w"][:] = rng.standard_normal(model["class_w"].shape)
    model["word_w"][:] = rng.standard_normal(model["word_w"].shape)
    state = rng.standard_normal((1, lm.HIDDEN)).astype(np.float32)
    every = np.arange(0, 201)
    p = np.exp(lm.log_probabilities(model, np.repeat(state, len(every), axis=0), every, 200))
    assert abs(p.sum() - 1) < 1e-3


def test_gradients_of_the_recurrent_layer():
    import numpy as np
    from pulsemart.llm import gru
    rng = np.random.default_rng(1)
    gates, u = rng.standard_normal((4, 3, 6)).astype(np.float32), rng.standard_normal((2, 6)).astype(np.float32)
    weight, zero = rng.standard_normal((4, 3, 2)).astype(np.float32), np.zeros((3, 2), np.float32)
    fresh = np.zeros((4, 3), bool)
    fresh[2, 1] = True
    _, kept = gru.forward(gates, u, zero, fresh, keep=True)
    d_gates, d_u = gru.backward(weight, kept, u, fresh)
    def loss(g, w):
        return float((gru.forward(g, w, zero, fresh) * weight).sum())
    for index in ((0, 0, 1), (1, 1, 4), (3, 2, 5)):
        bumped = gates.copy()
        bumped[index] += 1e-2
        lower = gates.copy()
        lower[index] -= 1e-2
        assert abs((loss(bumped, u) - loss(lower, u)) / 2e-2 - d_gates[index]) < 2e-2
    bumped, lower = u.copy(), u.copy()
    bumped[1, 3] += 1e-2
    lower[1, 3] -= 1e-2
    assert abs((loss(gates, bumped) - loss(gates, lower)) / 2e-2 - d_u[1, 3]) < 2e-2


def test_toxicity(spark, odd):
    docs, texts = odd
    labels = spark.createDataFrame([(4, 1), (4, 0), (5, 0), (8, None), (None, 1), (999, 1), (10, 0)], "doc_id long, toxic int")
    out = toxicity.toxicity(docs, labels, steps=2).collect()
    assert len(out) == len(texts)
    assert all(0 <= r["score"] <= 1 for r in out)
    assert all(r["held_out"] == (zlib.crc32(("" if r["doc_id"] is None else str(r["doc_id"])).encode()) % 4 == 2) for r in out)


def test_toxicity_without_labels(spark, odd):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert {round(r["score"], 3) for r in toxicity.toxicity(odd[0], labels).collect()} == {0.5}


def test_windows_cover_every_word():
    import numpy as np
    texts = [np.arange(n, dtype=np.int32) for n in (0, 1, 23, 24, 25, 48, 49, 72, 73, 500)]
    rows, lengths, owner = toxicity.windows(texts)
    for i, t in enumerate(texts):
        seen = {int(w) for r, n in zip(rows[owner == i], lengths[owner == i]) for w in r[:n]}
        assert seen == set(t.tolist()) and (owner == i).any()


def test_empty_tables(spark, empty):
    bench = spark.createDataFrame([], "item_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    turns = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    for df in (
        lines.line_dedup(empty), quality.quality_rules(empty), decontaminate.decontaminate(empty, bench),
        lm.lm_scores(empty), neardup.near_duplicates(empty), sharding.shard_by_bytes(empty, 24),
        chat.rotate_perspectives(turns), mixing.mix_sources(empty), paragraphs.repeated_paragraphs(empty),
        toxicity.toxicity(empty, labels),
    ):
        assert df.count() == 0


def test_contract_columns(spark):
    got = {name: set(fn(spark, "/root/testdata/sf0.001").columns) for name, fn in catalog.LLM_QUERIES.items()
           if name not in ("op3_lm_scoring", "op10_toxicity")}
    assert got["op1_decontamination"] >= {"doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"}
    assert got["op4_minhash_near_dedup"] >= {"doc_id", "n_shingles", "component_id", "kept"}
    assert got["op5_sharding"] >= {"doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"}
    assert got["op9_line_dedup"] >= {"doc_id", "n_lines", "n_dropped", "kept_sha256"}
    assert hashlib.sha256(b"").hexdigest() in {
        r["items_sha256"] for r in catalog.op1_decontamination(spark, "/root/testdata/sf0.001").collect()}


def test_word_classes_come_from_every_document(spark):
    """Each training document counts in the table that groups words into classes: rows of
    words of the same documents are equal, those of others differ, whatever the ids."""
    import numpy as np

    from pulsemart.llm import sketch

    def word_hash(word):
        data = np.frombuffer(word.encode(), np.uint8)
        return sketch.word_hashes(data, np.array([0]), np.array([len(data)]))[0]

    pairs = [(f"left{i}", f"right{i}") for i in range(40)]
    texts = [f"{a} x{j} {b} {a}" for i, (a, b) in enumerate(pairs) for j in range(i + 1)]
    train = spark.createDataFrame([(None, t) for t in texts], "doc long, text string").repartition(5)
    head = np.array([word_hash(w) for pair in pairs for w in pair], np.uint64)
    table = lm.word_sketch(train, head)
    assert (table[0::2] == table[1::2]).all() and len({tuple(row) for row in table}) == 40
    for i, row in enumerate(table[0::2]):
        assert 1 <= abs(row).sum() <= i + 1 and row.sum() % 2 == (i + 1) % 2      # i + 1 documents, one sign each
    placed = lm.grouped_head(head, table)
    assert sorted(placed) == sorted(head)


def test_word_sketch_is_small_on_the_driver(spark):
    """The sketch and the counts come to the driver in Arrow batches, not as Python rows,
    whatever the session's setting: 256,000 cells and 20,000 counts take a few bytes each."""
    import tracemalloc

    import numpy as np
    from pyspark.sql import functions as F

    from pulsemart.llm import sketch

    words = [f"w{i}" for i in range(1000)]
    data, ends = np.frombuffer("".join(words).encode(), np.uint8), np.cumsum([len(w) for w in words])
    head = sketch.word_hashes(data, ends - [len(w) for w in words], ends)
    train = spark.range(0, 2000, 1, 4).select(F.col("id").alias("doc"), F.lit(" ".join(words)).alias("text"))
    counts = spark.range(1, 20_001, 1, 4).select(F.col("id").alias("h"), F.lit(3).cast("long").alias("c"))
    key = "spark.sql.execution.arrow.pyspark.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    tracemalloc.start()
    try:
        table = lm.word_sketch(train, head)
        hashes, n = lm.most_frequent(counts, 20_000)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
        spark.conf.set(key, before)
    assert (table == table[0]).all() and (table[0] != 0).sum() > 200
    assert sorted(hashes.tolist()) == list(range(1, 20_001)) and (n == 3).all()
    assert peak < 16 << 20


def test_paragraph_tables_are_narrow(spark, monkeypatch):
    """One table alone has a row for each paragraph's class; places, roots and keys are kept
    of the repeated ones only, so the disk does not hold all paragraphs several times."""
    written = {}

    def noted(keep):
        def store(*args):
            out = keep(*args)
            written[args[-1]] = (out.count(), len(out.columns))
            return out
        return store

    monkeypatch.setattr(paragraphs, "stored", noted(paragraphs.stored))
    monkeypatch.setattr(paragraphs.Scratch, "store", noted(paragraphs.Scratch.store))
    texts = [" ".join(f"w{i}x{j}" for j in range(400)) for i in range(20)]
    copy = " ".join(f"copy{j}" for j in range(60))
    docs = [_row(i, f"{t}\n{copy}" if i in (3, 7) else t) for i, t in enumerate(texts)]
    out = paragraphs.repeated_paragraphs(_docs(spark, docs)).collect()
    assert {(r["doc_id"], r["removed"]) for r in out} == {(3, False), (7, True)}
    classes = written.pop("paragraph_classes")[0]
    assert classes > 100
    assert not {name: n for name, (n, _) in written.items() if not name.startswith("passage") and 4 * n > classes}


def test_network_works_in_small_arrays():
    """The layer's states and gradients are those of a plain loop, and neither a window's
    gradients nor a step of Adam makes copies of all they read: op3_lm_scoring's time goes there."""
    import tracemalloc

    import numpy as np

    from pulsemart.llm import gru

    rng = np.random.default_rng(4)
    steps, lanes, width = 40, 64, 16
    gates, u = rng.standard_normal((steps, lanes, 3 * width)).astype(gru.F32), rng.standard_normal((width, 3 * width)).astype(gru.F32) / 4
    zero, fresh = np.zeros((lanes, width), gru.F32), rng.random((steps, lanes)) < 0.03
    d_states = rng.standard_normal((steps, lanes, width)).astype(gru.F32)
    states, kept = gru.forward(gates, u, zero, fresh, keep=True)
    h = zero
    for t in range(steps):
        h = np.where(fresh[t][:, None], 0, h)
        a = h @ u
        z, r = (gru.sigmoid(gates[t, :, k * width:(k + 1) * width] + a[:, k * width:(k + 1) * width]) for k in (0, 1))
        h = h + z * (np.tanh(gates[t, :, 2 * width:] + r * a[:, 2 * width:]) - h)
        assert np.allclose(states[t], h, atol=1e-5)
    assert np.array_equal(states, gru.forward(gates, u, zero, fresh))

    params = {"w": rng.standard_normal((1 << 14, 64)).astype(gru.F32), "b": np.zeros(3, gru.F32)}
    begun, grads = {k: v.copy() for k, v in params.items()}, {k: np.sign(v + 0.5).astype(gru.F32) for k, v in params.items()}
    adam, peaks = gru.Adam(params, 0.01), []
    tracemalloc.start()
    try:
        for run in (lambda: gru.backward(d_states, kept, u, fresh), lambda: adam.step(grads)):
            tracemalloc.reset_peak()
            have = tracemalloc.get_traced_memory()[0]
            run()
            peaks.append(tracemalloc.get_traced_memory()[1] - have)
    finally:
        tracemalloc.stop()
    for k, v in params.items():                            # the first step has the rate's size, against the gradient
        assert np.allclose(begun[k] - v, 0.01 * grads[k], atol=1e-4)
    assert peaks[0] < 11 * states.nbytes and peaks[1] < params["w"].nbytes / 4, (peaks, states.nbytes)
