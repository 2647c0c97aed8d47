"""Toxicity by a bidirectional gated recurrent network with attention pooling.

A word's input joins a hashed word embedding with the mean of its hashed
character-run embeddings, so stems are recognised under unseen endings.
Every text is cut into overlapping windows of words; both directions run over a
window, attention pools their states into one logit, and the window with the
highest logit gives the document's score.  Training sees documents, not
windows: a document's logit is the softmax-weighted mean of its windows'.

The network is trained in numpy on a bounded sample of the labelled rows
(``SAMPLE_PER_CLASS`` of each class in hash order, texts up to
``SAMPLE_CHARS``; training steps see random halves of the texts' words and of
the word embeddings, against learning texts by heart), corrected to the class shares of all labelled training
rows, and sent to the tasks (about 4 MB).  All documents are scored, in all
windows.  Labels, language, source and id are no inputs.

Defined cases: a null text or one without words scores as one empty window; a
repeated label counts as toxic if any of its rows is; null labels and labels
of absent documents are ignored; without labelled rows, or with one class
only, the score is the share of toxic rows (one half without any); an empty
table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsemart.llm import gru, sketch
from pulsemart.llm.common import rows_again, stored, text_hash, whole_rows
from pulsemart.llm.decontaminate import SEPARATOR
from pulsemart.llm.gru import F32

SAMPLE_PER_CLASS = 1500
SAMPLE_CHARS = 10000
WINDOW, STRIDE = 48, 24
BUCKETS = 1 << 16
DIM = 8                            # of either embedding
HIDDEN = 8                         # of either direction
RUNS = (3, 4, 5)                   # bytes in a character run, with one boundary byte on either side
STEPS, BATCH, RATE = 300, 32, 0.01
MIN_TEXTS = 8                      # embeddings of words and runs in fewer sample texts stay zero
DROPPED = 0.5                      # of the words lose their word embedding in a training step
THINNED = 0.5                      # of a text's words are left out in a training step
LANES = 2048
THRESHOLD = 0.3
FOLDS, HELD_OUT = 4, 2


@dataclass
class Words:
    """Words of several texts: for each text the numbers of its words in a list of distinct words."""

    texts: list[np.ndarray]
    word: np.ndarray               # bucket of each distinct word
    run: np.ndarray                # buckets of the character runs of the distinct words, one after another
    run_word: np.ndarray           # the distinct word that each run belongs to


def _runs(lower: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all runs of a few bytes of each word with its boundaries, and the word of each."""
    sizes = ends - starts
    padded = sizes + 2
    first = np.concatenate(([0], np.cumsum(padded)))
    chars = np.full(int(first[-1]), 32, dtype=np.uint64)
    owner = np.repeat(np.arange(len(starts)), padded)
    place = np.arange(len(chars)) - first[owner]
    inner = (place > 0) & (place <= sizes[owner])
    chars[inner] = lower[starts[owner[inner]] + place[inner] - 1]
    found, of = [], []
    for n in RUNS:
        ok = np.flatnonzero(place + n <= padded[owner])
        code = np.zeros(len(ok), dtype=np.uint64)
        for k in range(n):
            code = code * np.uint64(257) + chars[ok + k]
        found.append((sketch.mixed(code + np.uint64(n << 56)) >> np.uint64(40)).astype(np.int64) % BUCKETS)
        of.append(owner[ok])
    run, run_word = np.concatenate(found), np.concatenate(of)
    order = np.argsort(run_word, kind="stable")
    return run[order], run_word[order]


def read_words(data: np.ndarray, offsets: np.ndarray) -> Words:
    starts, ends = sketch.word_bounds(data, offsets, SEPARATOR)
    hashes = sketch.word_hashes(data, starts, ends)
    distinct, sample, number = np.unique(hashes, return_index=True, return_inverse=True)
    run, run_word = _runs(sketch.LOWER[data], starts[sample], ends[sample])
    cuts = np.searchsorted(starts, offsets)
    texts = [number[lo:hi].astype(np.int32) for lo, hi in zip(cuts[:-1], cuts[1:])]
    return Words(texts, (distinct >> np.uint64(40)).astype(np.int64) % BUCKETS, run, run_word)


def _supported(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of words and of runs that occur in at least MIN_TEXTS texts."""
    first = np.searchsorted(words.run_word, np.arange(len(words.word) + 1))
    seen = [np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)]
    for text in words.texts:
        own = np.unique(text)
        seen[0][np.unique(words.word[own])] += 1
        seen[1][np.unique(words.run[_spans(first[own], first[own + 1])])] += 1
    return seen[0] >= MIN_TEXTS, seen[1] >= MIN_TEXTS


def _spans(lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """All positions of the spans lo..hi, one span after another."""
    sizes = hi - lo
    ends = np.cumsum(sizes)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(lo - (ends - sizes), sizes)


def _some(words: Words, pick: np.ndarray, first: np.ndarray, rng: np.random.Generator) -> Words:
    """The texts ``pick``, thinned, with their own list of distinct words."""
    own = [words.texts[i] for i in pick]
    own = [t[rng.random(len(t)) >= THINNED] for t in own]
    distinct, number = np.unique(np.concatenate(own), return_inverse=True)
    cuts = np.cumsum([len(t) for t in own])[:-1]
    lo, hi = first[distinct], first[distinct + 1]
    return Words([t.astype(np.int32) for t in np.split(number, cuts)], words.word[distinct],
                 words.run[_spans(lo, hi)], np.repeat(np.arange(len(distinct)), hi - lo))


def windows(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words of each window, its length, its text).  Every text gives at least
    one window; windows overlap by WINDOW - STRIDE words and cover all words."""
    rows, lengths, owner = [], [], []
    for i, words in enumerate(texts):
        for at in range(0, max(1, len(words) - (WINDOW - STRIDE)), STRIDE):
            part = words[at:at + WINDOW]
            rows.append(part)
            lengths.append(len(part))
            owner.append(i)
    out = np.zeros((len(rows), WINDOW), dtype=np.int32)
    for k, part in enumerate(rows):
        out[k, :len(part)] = part
    return out, np.array(lengths), np.array(owner)


def new_model(seed: int = 7) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)

    def normal(*shape: int, scale: float) -> np.ndarray:
        return (rng.standard_normal(shape) * scale).astype(F32)

    return {
        "word": normal(BUCKETS, DIM, scale=0.01), "char": normal(BUCKETS, DIM, scale=0.01),
        "x_f": normal(2 * DIM, 3 * HIDDEN, scale=0.3), "x_b": normal(2 * DIM, 3 * HIDDEN, scale=0.3),
        "b_f": np.zeros(3 * HIDDEN, F32), "b_b": np.zeros(3 * HIDDEN, F32),
        "u_f": normal(HIDDEN, 3 * HIDDEN, scale=0.3), "u_b": normal(HIDDEN, 3 * HIDDEN, scale=0.3),
        "attend": normal(2 * HIDDEN, scale=0.3), "out": normal(2 * HIDDEN, scale=0.3), "bias": np.zeros(1, F32),
    }


def word_inputs(model: dict, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Input vector of each distinct word, and its number of character runs."""
    n = np.maximum(1, np.bincount(words.run_word, minlength=len(words.word))).astype(F32)[:, None]
    chars = gru.scatter_sum(words.run_word, model["char"][words.run], len(words.word)) / n
    return np.concatenate([model["word"][words.word], chars], axis=1), n


def _mirrored(rows: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Each window's words in reverse, padding still at the end."""
    at = lengths[:, None] - 1 - np.arange(rows.shape[1])[None, :]
    return np.where(at >= 0, np.take_along_axis(rows, np.maximum(at, 0), axis=1), 0)


def _window_states(model: dict, gates: dict, rows: np.ndarray, lengths: np.ndarray, keep: bool):
    out, kept = [], []
    for side, order in (("f", rows), ("b", _mirrored(rows, lengths))):
        zero = np.zeros((len(rows), HIDDEN), F32)
        got = gru.forward(gates[side][order.T], model[f"u_{side}"], zero, keep=keep)
        states, cache = got if keep else (got, None)
        if side == "b":                                 # back to the words' own places
            states = np.take_along_axis(states, _places(lengths, rows.shape[1]), axis=0)
        out.append(states)
        kept.append((order, cache))
    return np.concatenate(out, axis=2), kept


def _places(lengths: np.ndarray, steps: int) -> np.ndarray:
    at = lengths[None, :] - 1 - np.arange(steps)[:, None]
    return np.where(at >= 0, at, np.arange(steps)[:, None])[:, :, None]


def _pooled(model: dict, states: np.ndarray, lengths: np.ndarray):
    mask = np.arange(states.shape[0])[:, None] < lengths[None, :]
    scores = np.where(mask, states @ model["attend"], F32(-1e9))
    weights = np.exp(scores - scores.max(axis=0)) * mask
    weights = weights / np.maximum(weights.sum(axis=0), F32(1e-9))
    pooled = np.einsum("tb,tbh->bh", weights, states)
    return pooled @ model["out"] + model["bias"][0], pooled, weights


def window_logits(model: dict, words: Words, rows: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    x, _ = word_inputs(model, words)
    if not len(x):
        x = np.zeros((1, 2 * DIM), F32)
    gates = {s: x @ model[f"x_{s}"] + model[f"b_{s}"] for s in "fb"}
    out = np.empty(len(rows), F32)
    by_length = np.argsort(-lengths, kind="stable")
    for at in range(0, len(rows), LANES):
        part = by_length[at:at + LANES]
        steps = max(1, int(lengths[part[0]]))
        states, _ = _window_states(model, gates, rows[part, :steps], lengths[part], keep=False)
        out[part] = _pooled(model, states, lengths[part])[0]
    return out


def _gradients(model: dict, words: Words, labels: np.ndarray, present: np.ndarray) -> dict[str, np.ndarray]:
    """Gradients of the mean log loss of the documents' logits; words that are
    not ``present`` are read by their characters alone."""
    rows, lengths, owner = windows(words.texts)
    x, n_runs = word_inputs(model, words)
    x[:, :DIM] *= present
    if not len(x):
        x, n_runs = np.zeros((1, 2 * DIM), F32), np.ones((1, 1), F32)
    gates = {s: x @ model[f"x_{s}"] + model[f"b_{s}"] for s in "fb"}
    states, kept = _window_states(model, gates, rows, lengths, keep=True)
    logits, pooled, weights = _pooled(model, states, lengths)

    top = np.full(len(labels), -np.inf, F32)
    np.maximum.at(top, owner, logits)
    share = np.exp(logits - top[owner])
    share /= np.bincount(owner, weights=share, minlength=len(labels)).astype(F32)[owner]
    doc = np.bincount(owner, weights=share * logits, minlength=len(labels)).astype(F32)
    error = (gru.sigmoid(doc) - labels) / len(labels)
    d_logit = (error[owner] * share * (1 + logits - doc[owner])).astype(F32)

    grads = {"out": pooled.T @ d_logit, "bias": np.array([d_logit.sum()], F32)}
    d_pooled = d_logit[:, None] * model["out"][None, :]
    d_weight = np.einsum("bh,tbh->tb", d_pooled, states)
    d_score = weights * (d_weight - (weights * d_weight).sum(axis=0))
    grads["attend"] = np.einsum("tb,tbh->h", d_score, states)
    d_states = weights[:, :, None] * d_pooled[None] + d_score[:, :, None] * model["attend"]
    d_x = np.zeros_like(x)
    for k, side in enumerate("fb"):
        order, cache = kept[k]
        d = d_states[:, :, k * HIDDEN:(k + 1) * HIDDEN]
        if side == "b":
            d = np.take_along_axis(d, _places(lengths, rows.shape[1]), axis=0)
        d_gates, grads[f"u_{side}"] = gru.backward(np.ascontiguousarray(d), cache, model[f"u_{side}"])
        d_words = gru.scatter_sum(order.T.ravel(), d_gates.reshape(-1, 3 * HIDDEN), len(x))
        grads[f"x_{side}"], grads[f"b_{side}"] = x.T @ d_words, d_words.sum(axis=0)
        d_x += d_words @ model[f"x_{side}"].T
    grads["word"], grads["char"] = np.zeros_like(model["word"]), np.zeros_like(model["char"])
    if len(words.word):
        grads["word"] = gru.scatter_sum(words.word, d_x[:, :DIM] * present, BUCKETS)
        grads["char"] = gru.scatter_sum(words.run, (d_x[:, DIM:] / n_runs)[words.run_word], BUCKETS)
    return grads


def train(texts: list[bytes], labels: list[int], prior: float, steps: int = STEPS, seed: int = 7) -> dict[str, np.ndarray]:
    """A model fitted to whole texts; its bias answers to a toxic share of ``prior``."""
    model, rng = new_model(seed), np.random.default_rng(seed)
    y = np.array(labels, F32)
    odds = np.log(max(prior, 1e-6) / max(1 - prior, 1e-6))
    if not 0 < y.sum() < len(y):
        model["out"][:], model["bias"][0] = 0, odds if len(y) else 0
        return model
    offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    words = read_words(np.frombuffer(b"".join(texts), np.uint8), offsets)
    first = np.searchsorted(words.run_word, np.arange(len(words.word) + 1))
    usual = dict(zip(("word", "char"), _supported(words)))
    for k, known in usual.items():
        model[k][~known] = 0
    adam, sides = gru.Adam(model, RATE), [np.flatnonzero(y == k) for k in (0, 1)]
    for _ in range(steps):
        pick = np.concatenate([rng.choice(s, min(len(s), BATCH // 2), replace=False) for s in sides])
        own = _some(words, pick, first, rng)
        present = (rng.random((len(own.word), 1)) >= DROPPED).astype(F32)
        grads = _gradients(model, own, y[pick], present)
        for k, known in usual.items():
            grads[k] *= known[:, None]
        adam.step(grads)
    model["bias"][0] += odds                             # trained on as many of either class
    return model


def _scores(texts: pa.Array, model: dict[str, np.ndarray]) -> np.ndarray:
    scores = np.zeros(len(texts))
    for row, data, offsets in sketch.slices(texts):
        words = read_words(data, offsets)
        rows, lengths, owner = windows(words.texts)
        logits = window_logits(model, words, rows, lengths)
        top = np.full(len(offsets) - 1, -np.inf)
        np.maximum.at(top, owner, logits)
        scores[row:row + len(top)] = 1 / (1 + np.exp(-np.clip(top, -30, 30)))
    return scores


def _scored(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = _scores(batch.column("text"), shared.value)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), batch.column("text_hash"), pa.array(scores)], ["doc", "text_hash", "score"])
    return run


def _below(shared, threshold: float):
    """Whole rows whose text scores under the threshold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = _scores(batch.column("apart0"), shared.value)
            yield batch.filter(pa.array(scores < threshold))
    return run


def fold(id_col: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds`` (a null id as empty text)."""
    return F.crc32(F.encode(F.coalesce(id_col.cast("string"), F.lit("")), "UTF-8")) % folds


def sample_labelled(
    docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, per_class: int, chars: int,
) -> tuple[list[bytes], list[int], float]:
    """Texts and labels of at most ``per_class`` training rows of each class, and
    the toxic share of all such rows.  Documents without a text within the bound, and
    labels without a document, don't count."""
    known = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(
        F.col(id_col).alias("doc")).agg(F.max(label_col).alias("y")).filter(fold(F.col("doc"), FOLDS) != HELD_OUT)
    short = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text")).filter(F.char_length("text") <= chars)
    # labels without a document or with a long one only are dropped before anything is drawn
    known = stored(known.join(short.select("doc").distinct(), "doc", "left_semi"), "toxicity_labels")
    counts = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    prior = counts.get(1, 0) / max(1, sum(counts.values()))
    texts: list[bytes] = []
    ys: list[int] = []
    for y in (0, 1):
        chosen = known.filter(F.col("y") == y).orderBy(F.xxhash64("doc"), "doc").limit(per_class).select("doc")
        rows = short.join(F.broadcast(chosen), "doc").orderBy(F.xxhash64("doc"), "text").limit(per_class).collect()
        texts += [r["text"].encode("utf-8", "surrogatepass") for r in rows]
        ys += [y] * len(rows)
    return texts, ys, prior if counts else 0.5


def fitted(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, per_class: int, chars: int, steps: int):
    """The model fitted to the bounded sample, as the tasks read it."""
    texts, ys, prior = sample_labelled(docs, labels, id_col, text_col, label_col, per_class, chars)
    return docs.sparkSession.sparkContext.broadcast(train(texts, ys, prior, steps))


def toxicity(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    per_class: int = SAMPLE_PER_CLASS, chars: int = SAMPLE_CHARS, steps: int = STEPS,
) -> DataFrame:
    """One row per document: its id, ``text_hash``, ``held_out`` and ``score`` (0 to 1)."""
    model = fitted(docs, labels, id_col, text_col, label_col, per_class, chars, steps)
    src = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"), text_hash(F.col(text_col)))
    id_type = src.schema["doc"].dataType.simpleString()
    out = src.mapInArrow(_scored(model), f"doc {id_type}, text_hash long, score double")
    return out.select(
        F.col("doc").alias(id_col), "text_hash", (fold(F.col("doc"), FOLDS) == HELD_OUT).alias("held_out"), "score")


def without_toxic_rows(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    threshold: float = THRESHOLD, per_class: int = SAMPLE_PER_CLASS, chars: int = SAMPLE_CHARS, steps: int = STEPS,
) -> DataFrame:
    """The rows of ``docs`` that score under ``threshold``, all their columns, in the
    scoring pass itself: a verdict on one row needs no join."""
    model = fitted(docs, labels, id_col, text_col, label_col, per_class, chars, steps)
    rows = whole_rows(docs, text_col)
    return rows_again(rows.mapInArrow(_below(model, threshold), rows.schema), docs, text_col)
