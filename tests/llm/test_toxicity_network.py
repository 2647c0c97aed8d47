"""The toxicity network against a plain sequential reading of a text, its gradients
against finite differences, and what its labelled sample takes."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulsemart.llm import toxicity

TEXTS = ["you vile vile fool and more", "", "kind words", "one", " ".join(f"w{i % 13}" for i in range(100)),
         "Ünïcode wörds HERE", "a " * 49]


def _read(texts):
    raw = [t.encode() for t in texts]
    return toxicity.read_words(np.frombuffer(b"".join(raw), np.uint8), np.concatenate(([0], np.cumsum([len(r) for r in raw]))))


def _model():
    rng = np.random.default_rng(5)
    model = toxicity.new_model(3)
    return {k: (v + rng.standard_normal(v.shape) * 0.2).astype(np.float32) for k, v in model.items()}


def _sequential(model, words, text):
    """The score of one text, word by word and window by window, in double precision."""
    m = {k: v.astype(np.float64) for k, v in model.items()}
    sig = lambda x: 1 / (1 + np.exp(-x))

    def vector(w):
        runs = words.run[words.run_word == w]
        chars = sum((m["char"][r] for r in runs), np.zeros(toxicity.DIM)) / max(1, len(runs))
        return np.concatenate([m["word"][words.word[w]], chars])

    def states(side, order):
        h, out, width = np.zeros(toxicity.HIDDEN), [], toxicity.HIDDEN
        for w in order:
            gates, a = vector(w) @ m[f"x_{side}"] + m[f"b_{side}"], h @ m[f"u_{side}"]
            z, r = sig(gates[:width] + a[:width]), sig(gates[width:2 * width] + a[width:2 * width])
            n = np.tanh(gates[2 * width:] + r * a[2 * width:])
            h = h + z * (n - h)
            out.append(h)
        return out

    logits = []
    for at in range(0, max(1, len(text) - (toxicity.WINDOW - toxicity.STRIDE)), toxicity.STRIDE):
        part = text[at:at + toxicity.WINDOW]
        both = [np.concatenate(x) for x in zip(states("f", part), states("b", part[::-1])[::-1])]
        if not both:
            logits.append(m["bias"][0])
            continue
        scores = np.array([s @ m["attend"] for s in both])
        share = np.exp(scores - scores.max())
        pooled = sum(w * s for w, s in zip(share / share.sum(), both))
        logits.append(pooled @ m["out"] + m["bias"][0])
    return max(logits)


def test_scores_equal_a_sequential_reading():
    model, words = _model(), _read(TEXTS)
    rows, lengths, owner = toxicity.windows(words.texts)
    logits = toxicity.window_logits(model, words, rows, lengths)
    for i, text in enumerate(words.texts):
        assert math.isclose(max(logits[owner == i]), _sequential(model, words, text), rel_tol=2e-4, abs_tol=2e-4)
    assert len(set(owner)) == len(TEXTS)


def test_every_word_lies_in_a_window_of_its_text():
    for n in (0, 1, 24, 48, 49, 72, 73, 500):
        rows, lengths, owner = toxicity.windows([np.arange(n, dtype=np.int32)])
        seen = {int(w) for row, size in zip(rows, lengths) for w in row[:size]}
        assert seen == set(range(n)) and len(rows) >= 1


@pytest.mark.parametrize("name", ["word", "char", "x_f", "x_b", "b_f", "b_b", "u_f", "u_b", "attend", "out", "bias"])
def test_gradients_equal_finite_differences(name):
    model, words = _model(), _read(TEXTS)
    labels = np.array([1, 0, 0, 1, 0, 1, 0], np.float32)
    present = np.ones((len(words.word), 1), np.float32)
    grads = toxicity._gradients(model, words, labels, present)

    def loss(changed):
        rows, lengths, owner = toxicity.windows(words.texts)
        logits = toxicity.window_logits(changed, words, rows, lengths).astype(np.float64)
        total = 0.0
        for i, y in enumerate(labels):
            own = logits[owner == i]
            share = np.exp(own - own.max())
            doc = float((share / share.sum() * own).sum())        # a document's logit in training
            total += math.log1p(math.exp(-doc)) if y else math.log1p(math.exp(doc))
        return total / len(labels)

    flat = np.abs(grads[name]).ravel()
    for at in np.argsort(-flat)[:4]:
        place, step = np.unravel_index(at, grads[name].shape), 1e-2
        sides = []
        for sign in (1, -1):
            changed = {k: v.copy() for k, v in model.items()}
            changed[name][place] += sign * step
            sides.append(loss(changed))
        assert math.isclose((sides[0] - sides[1]) / (2 * step), float(grads[name][place]), rel_tol=0.05, abs_tol=2e-4)


def test_the_sample_is_drawn_from_usable_labels(spark):
    """Labels of absent documents and of texts over the bound take no place in the sample
    and no share in the prior."""
    docs = spark.createDataFrame(
        [(i, "toxic words" if i % 4 == 0 else "clean words") for i in range(200)] + [(900, "x" * 500)], "doc_id long, text string")
    labels = spark.range(5000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") < 200, (F.col("id") % 4 == 0).cast("int")).otherwise(F.lit(1)).alias("toxic"))
    texts, ys, prior = toxicity.sample_labelled(docs, labels, "doc_id", "text", "toxic", 30, 100)
    assert len(texts) == 60 and sum(ys) == 30
    assert all((t == b"toxic words") == (y == 1) for t, y in zip(texts, ys))
    assert 0.15 < prior < 0.35
