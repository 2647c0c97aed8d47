"""Language-model scores of whole documents by a gated recurrent network.

Word counts are taken over all training documents.  The ``HEAD`` most frequent
words are the network's own vocabulary; its output softmax is factored into a
class and a word within the class, classes being groups of words that occur in
the same documents.  Every other word is a member of one class more, within
which its share follows the counts of all documents, add one (an unseen word
has the share of a count of nought), so every text has a probability.

Training is data-parallel: in each round every task runs truncated
back-propagation through time over its share of the round's documents, an
eighth of all training documents and another one each round, until every
training document was read once, and the tasks' models are averaged in a tree.  Scoring reads whole texts: the state is carried from
window to window until the document's end.

Words are known by 64-bit hashes.  The most frequent ``COMMON`` counts go to the
tasks (about 4 MB, sent once); rarer words are looked up by a shuffled join.  What
the driver collects comes in Arrow batches, whatever the session's settings are:
the same table as Python rows takes some hundred bytes a row.

Defined cases: a null text is empty and has one token, its end; null ids
belong to the fold of an empty id; equal rows are scored alike; without
training documents all counts are nought; an empty table gives an empty
table; other columns are ignored.
"""

from __future__ import annotations

import heapq
import io
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsemart.llm import gru, sketch
from pulsemart.llm.common import stored
from pulsemart.llm.gru import F32

HEAD = 4096
CLASS_SIZE = 64
COMMON = 1 << 18
TAIL_INPUTS = 256                  # hashed input embeddings of words outside the head
DIM = HIDDEN = 16
GROUPS = 16                        # of words by the documents they occur in, before they are cut into classes
SHARES = 8                         # rounds of a pass: each training document is in one
TRAIN_LANES, TRAIN_STEPS = 64, 24
SCORE_LANES, SCORE_STEPS = 512, 32
RATE = 0.01
FAN_IN = 32
SKETCH = 256                       # signed sums of a head word's documents, by which words are grouped into classes
FOLDS, HELD_OUT = 7, 2


def word_lists(column: pa.Array) -> list[np.ndarray]:
    """Word hashes of each text."""
    return [words for _, words in sketch.documents(column)]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = word_lists(batch.column("text"))
        found, n = np.unique(np.concatenate(lists) if lists else np.zeros(0, np.uint64), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n.astype(np.int64))], ["h", "c"])


class Vocabulary:
    """Head words with ids 1.. in class order (0 is the end), and common counts.

    Outputs: class 0 is the end alone, classes 1.. hold CLASS_SIZE head words
    each, and the last class is every other word.
    """

    def __init__(self, head: np.ndarray, common: np.ndarray, counts: np.ndarray, totals: tuple[int, int, int]):
        self.n_docs, self.n_tokens, self.n_types = totals
        self.head = head                                   # hashes in id order
        order = np.argsort(common)
        self.common, self.counts = common[order], counts[order]
        at = np.argsort(head)
        self.head_sorted, self.head_id = head[at], at + 1
        self.n_classes = 2 + -(-len(head) // CLASS_SIZE)

    def ids(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(id, count) of each word: id 0 outside the head, count -1 where not common."""
        return self.head_ids(words), self._find(words, self.common, self.counts, -1)

    def head_ids(self, words: np.ndarray) -> np.ndarray:
        return self._find(words, self.head_sorted, self.head_id, 0)

    @staticmethod
    def _find(words: np.ndarray, keys: np.ndarray, values: np.ndarray, missing: int) -> np.ndarray:
        if not len(keys):
            return np.full(len(words), missing, np.int64)
        at = np.minimum(np.searchsorted(keys, words), len(keys) - 1)
        return np.where(keys[at] == words, values[at], missing)

    def inputs(self, ids: np.ndarray, words: np.ndarray) -> np.ndarray:
        """Input embedding of each word (0 is a document's start)."""
        return np.where(ids > 0, ids, len(self.head) + 1 + (words % np.uint64(TAIL_INPUTS)).astype(np.int64))

    def log_tail(self) -> float:
        """log10 of the tail's total: its tokens, its types, and one for the unseen."""
        of_head = int(self._head_counts().sum())
        return math.log10(max(1, self.n_tokens - self.n_docs - of_head
                              + self.n_types - min(1, self.n_docs) - len(self.head) + 1))

    def _head_counts(self) -> np.ndarray:
        return self.counts[np.searchsorted(self.common, self.head)] if len(self.head) else np.zeros(0, np.int64)


def new_model(vocab: Vocabulary, seed: int = 11) -> dict[str, np.ndarray]:
    """Random weights; output biases that give the counts' own distribution."""
    rng = np.random.default_rng(seed)
    n, k = len(vocab.head), vocab.n_classes

    def normal(*shape: int, scale: float) -> np.ndarray:
        return (rng.standard_normal(shape) * scale).astype(F32)

    counts = vocab._head_counts().astype(float) + 1
    padded = np.full((k - 2) * CLASS_SIZE, 1e-9)
    padded[:n] = counts
    padded = padded.reshape(k - 2, CLASS_SIZE)
    tail = max(1.0, 10 ** vocab.log_tail())
    mass = np.concatenate([[vocab.n_docs + 1.0], padded.sum(axis=1), [tail]])
    return {
        "embed": normal(n + 1 + TAIL_INPUTS, DIM, scale=0.1), "x": normal(DIM, 3 * HIDDEN, scale=0.3),
        "b": np.zeros(3 * HIDDEN, F32), "u": normal(HIDDEN, 3 * HIDDEN, scale=0.3),
        "class_w": np.zeros((HIDDEN, k), F32), "class_b": np.log(mass / mass.sum()).astype(F32),
        "word_w": np.zeros((k - 2, HIDDEN, CLASS_SIZE), F32),
        "word_b": np.log(padded / padded.sum(axis=1, keepdims=True)).astype(F32),
    }


def packed(model: dict[str, np.ndarray]) -> bytes:
    out = io.BytesIO()
    np.savez(out, **model)
    return out.getvalue()


def unpacked(blob: bytes) -> dict[str, np.ndarray]:
    return dict(np.load(io.BytesIO(blob)))


class Lanes:
    """Documents laid end to end in lanes of near-equal length, longest first."""

    def __init__(self, ids: list[np.ndarray], inputs: list[np.ndarray], tail: int, lanes: int):
        sizes = np.array([len(x) + 1 for x in ids])
        lanes = max(1, min(lanes, len(ids)))
        heap = [(0, k) for k in range(lanes)]
        own: list[list[int]] = [[] for _ in range(lanes)]
        for i in np.argsort(-sizes, kind="stable").tolist():
            size, k = heapq.heappop(heap)
            own[k].append(i)
            heapq.heappush(heap, (size + int(sizes[i]), k))
        lengths = np.array([int(sizes[o].sum()) for o in own])
        by_length = np.argsort(-lengths, kind="stable")
        self.lengths = lengths[by_length]
        steps = int(self.lengths[0]) if len(ids) else 0
        shape = (steps, lanes)
        self.inputs, self.targets = np.zeros(shape, np.int32), np.zeros(shape, np.int32)
        self.docs, self.fresh = np.full(shape, -1, np.int32), np.zeros(shape, bool)
        for lane, k in enumerate(by_length):
            at = 0
            for i in own[k]:
                end = at + int(sizes[i])
                self.inputs[at + 1:end, lane] = inputs[i]
                self.targets[at:end - 1, lane] = np.where(ids[i] > 0, ids[i], tail)
                self.docs[at:end, lane] = i
                self.fresh[at, lane] = True
                at = end

    def windows(self, steps: int) -> Iterator[tuple[slice, int]]:
        """Steps of a window and the number of lanes that still run.

        A window grows longer as lanes end, so it holds about the same number of
        words: the end of a long text is not learned in steps of a few words each.
        """
        at = 0
        while at < len(self.inputs):
            n = int((self.lengths > at).sum())
            size = steps * (self.inputs.shape[1] // n)
            yield slice(at, at + size), n
            at += size


def _softmax(x: np.ndarray) -> np.ndarray:
    """The softmax of each row, in place."""
    x -= x.max(axis=1, keepdims=True)
    np.exp(x, out=x)
    x /= (x @ np.ones(x.shape[1], F32))[:, None]
    return x


def _log_share(x: np.ndarray, index: np.ndarray) -> np.ndarray:
    """The log softmax of each row at its index alone."""
    top = x.max(axis=1)
    own = x[np.arange(len(x)), index] - top
    x -= top[:, None]
    return own - np.log(np.exp(x, out=x).sum(axis=1))


def _classes(targets: np.ndarray, n_classes: int, tail: int) -> np.ndarray:
    """Class of each target id: 0 the end, the last the tail."""
    return np.where(targets == tail, n_classes - 1, np.where(targets == 0, 0, 1 + (targets - 1) // CLASS_SIZE))


def _by_class(classes: np.ndarray, n_classes: int) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(classes.astype(np.int16), kind="stable")
    cuts = np.searchsorted(classes[order], np.arange(n_classes + 1))
    for c in range(1, n_classes - 1):
        if cuts[c + 1] > cuts[c]:
            yield c - 1, order[cuts[c]:cuts[c + 1]]


def log_probabilities(model: dict, states: np.ndarray, targets: np.ndarray, tail: int) -> np.ndarray:
    """Natural log probability of each target (a tail word's: of the tail)."""
    k = model["class_w"].shape[1]
    classes = _classes(targets, k, tail)
    x = states @ model["class_w"]
    x += model["class_b"]
    out = _log_share(x, classes)
    for c, rows in _by_class(classes, k):
        out[rows] += _log_share(states[rows] @ model["word_w"][c] + model["word_b"][c], (targets[rows] - 1) % CLASS_SIZE)
    return out


def _window_gradients(model: dict, lanes: Lanes, steps: slice, n: int, h: np.ndarray, tail: int):
    inputs, targets = lanes.inputs[steps, :n], lanes.targets[steps, :n]
    real, fresh = (lanes.docs[steps, :n] >= 0).ravel(), lanes.fresh[steps, :n]
    x = model["embed"][inputs]
    states, kept = gru.forward(x @ model["x"] + model["b"], model["u"], h[:n], fresh, keep=True)
    flat, t = states.reshape(-1, HIDDEN), targets.ravel()
    k, total = model["class_w"].shape[1], max(TRAIN_STEPS * lanes.inputs.shape[1], int(real.sum()))
    classes = _classes(t, k, tail)
    weight = (real / F32(total)).astype(F32)
    d = flat @ model["class_w"]
    d += model["class_b"]
    _softmax(d)
    d[np.arange(len(t)), classes] -= 1
    d *= weight[:, None]
    grads = {"class_w": flat.T @ d, "class_b": d.sum(axis=0),
             "word_w": np.zeros_like(model["word_w"]), "word_b": np.zeros_like(model["word_b"])}
    d_flat = d @ model["class_w"].T
    order = np.argsort(classes.astype(np.int16), kind="stable")    # head words side by side, class by class
    cuts = np.searchsorted(classes[order], np.arange(1, k))
    rows = order[cuts[0]:cuts[-1]]
    cuts = (cuts - cuts[0]).tolist()
    found = [(c, lo, hi) for c, (lo, hi) in enumerate(zip(cuts, cuts[1:])) if hi > lo]
    if found:
        own, own_t = flat[rows], t[rows] - 1
        e, back = np.empty((len(rows), CLASS_SIZE), F32), np.empty_like(own)
        for c, lo, hi in found:
            np.dot(own[lo:hi], model["word_w"][c], out=e[lo:hi])
        e += model["word_b"][own_t // CLASS_SIZE]
        _softmax(e)
        e[np.arange(len(rows)), own_t % CLASS_SIZE] -= 1
        e *= weight[rows, None]
        for c, lo, hi in found:
            np.dot(own[lo:hi].T, e[lo:hi], out=grads["word_w"][c])
            np.dot(e[lo:hi], model["word_w"][c].T, out=back[lo:hi])
        at = [(c, lo) for c, lo, _ in found]
        grads["word_b"][[c for c, _ in at]] = np.add.reduceat(e, [lo for _, lo in at], axis=0)
        d_flat[rows] += back
    d_gates, grads["u"] = gru.backward(d_flat.reshape(states.shape), kept, model["u"], fresh)
    flat_gates = d_gates.reshape(-1, 3 * HIDDEN)
    grads["x"], grads["b"] = x.reshape(-1, DIM).T @ flat_gates, flat_gates.sum(axis=0)
    grads["embed"] = gru.scatter_sum(inputs.ravel(), flat_gates @ model["x"].T, len(model["embed"]))
    return grads, states[-1]


def fit(model: dict, vocab: Vocabulary, lists: list[np.ndarray], adam: gru.Adam) -> None:
    """One pass of truncated back-propagation over whole texts, states carried."""
    if not lists:
        return
    ids = [vocab.head_ids(words) for words in lists]
    tail = len(vocab.head) + 1
    lanes = Lanes(ids, [vocab.inputs(i, w) for i, w in zip(ids, lists)], tail, TRAIN_LANES)
    h = np.zeros((lanes.inputs.shape[1], HIDDEN), F32)
    for steps, n in lanes.windows(TRAIN_STEPS):
        grads, last = _window_gradients(model, lanes, steps, n, h, tail)
        h = last
        adam.step(grads)


def _trained(shared, begun):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, start = shared.value, begun.value
        model = {k: v.copy() for k, v in start.items()}
        adam, seen = gru.Adam(model, RATE), 0
        for batch in batches:
            lists = word_lists(batch.column("text"))
            fit(model, vocab, lists, adam)
            seen += sum(len(x) + 1 for x in lists)
        if seen:
            yield pa.RecordBatch.from_arrays([
                pa.array([TaskContext.get().partitionId()], pa.int64()),
                pa.array([float(seen)]), pa.array([packed(model)], pa.binary())], ["slot", "seen", "model"])
    return run


def _mean(rows: pd.DataFrame) -> pd.DataFrame:
    total, seen = None, float(rows["seen"].sum())
    for weight, blob in zip(rows["seen"], rows["model"]):
        part = {k: v * F32(weight / seen) for k, v in unpacked(blob).items()}
        total = part if total is None else {k: total[k] + v for k, v in part.items()}
    return pd.DataFrame({"slot": [int(rows["slot"].iloc[0]) // FAN_IN], "seen": [seen], "model": [packed(total)]})


def averaged(models: DataFrame, n_tasks: int) -> dict[str, np.ndarray] | None:
    """Token-weighted mean of the tasks' models, FAN_IN at a time."""
    schema = "slot long, seen double, model binary"
    while n_tasks > FAN_IN:
        models = models.groupBy(F.floor(F.col("slot") / FAN_IN).alias("g")).applyInPandas(_mean, schema)
        n_tasks = -(-n_tasks // FAN_IN)
    rows = models.toArrow().to_pandas()                    # at most FAN_IN models
    return unpacked(_mean(rows)["model"].iloc[0]) if len(rows) else None


def _scored(shared, trained):
    """Scores from the network and the common counts, and each text's rarer words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab, model = shared.value, trained.value
        tail = len(vocab.head) + 1
        gates = model["embed"] @ model["x"] + model["b"]
        end = math.log10(vocab.n_docs + 1)
        for batch in batches:
            n_rows = batch.num_rows
            ids, inputs, rare, times = [], [], [], []
            n_known, n_tail, log_base, log_tail = (np.zeros(n_rows) for _ in range(4))
            for i, words in enumerate(word_lists(batch.column("text"))):
                distinct, number, n = np.unique(words, return_inverse=True, return_counts=True)
                d_ids, d_counts = vocab.ids(distinct)
                common, outside = d_counts >= 0, d_ids == 0
                logs = np.log10(np.maximum(d_counts, 0) + 1.0) * n
                n_known[i], log_base[i] = n[common].sum() + (vocab.n_docs > 0), logs[common].sum() + end
                n_tail[i], log_tail[i] = n[outside].sum(), logs[common & outside].sum()
                rare.append(distinct[~common].view(np.int64))
                times.append(n[~common])
                ids.append(d_ids[number])
                inputs.append(vocab.inputs(d_ids, distinct)[number])
            network = np.zeros(n_rows)
            if n_rows:
                lanes = Lanes(ids, inputs, tail, SCORE_LANES)
                h = np.zeros((lanes.inputs.shape[1], HIDDEN), F32)
                for steps, n in lanes.windows(SCORE_STEPS):
                    states = gru.forward(gates[lanes.inputs[steps, :n]], model["u"], h[:n], lanes.fresh[steps, :n])
                    h = states[-1]
                    owner = lanes.docs[steps, :n].ravel()
                    real = np.flatnonzero(owner >= 0)
                    got = log_probabilities(model, states.reshape(-1, HIDDEN)[real], lanes.targets[steps, :n].ravel()[real], tail)
                    network += np.bincount(owner[real], weights=got, minlength=n_rows)
            sizes = np.array([len(x) + 1 for x in ids], dtype=np.int64)
            yield pa.RecordBatch.from_arrays([
                batch.column("doc"), pa.array(sizes), pa.array(n_known.astype(np.int64)),
                pa.array(n_tail.astype(np.int64)), pa.array(log_base), pa.array(log_tail),
                pa.array(network / math.log(10)), pa.array(rare, pa.list_(pa.int64())),
                pa.array(times, pa.list_(pa.int64())),
            ], ["doc", "n_tokens", "n_known", "n_tail", "log_base", "log_tail", "network", "rare", "times"])
    return run


def grouped_head(head: np.ndarray, table: np.ndarray, seed: int = 5) -> np.ndarray:
    """Head words ordered so that neighbours occur in the same documents: k-means over
    a few singular vectors of ``table``, a row of sums (``_sketched``) for each word."""
    if len(head) <= CLASS_SIZE or not table.any():
        return head
    table = table.astype(F32)
    table /= np.maximum(np.linalg.norm(table, axis=1, keepdims=True), 1e-6)
    rng = np.random.default_rng(seed)
    basis = rng.standard_normal((table.shape[1], 32)).astype(F32)
    for _ in range(3):
        basis, _ = np.linalg.qr(table.T @ (table @ basis))
    points = table @ basis[:, :GROUPS]
    centers = points[rng.choice(len(points), GROUPS, replace=False)]
    for _ in range(15):
        near = np.argmax(points @ centers.T - 0.5 * (centers ** 2).sum(axis=1), axis=1)
        centers = np.stack([points[near == g].mean(axis=0) if (near == g).any() else centers[g] for g in range(GROUPS)])
    return head[np.lexsort((np.arange(len(head)), near))]


def most_frequent(counts: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and counts of the most frequent words, at most ``most``, best first.

    Words are counted by 1/16 of the count's binary logarithm first (some
    hundred numbers), which gives the least count to collect: no task sorts them.
    """
    step = F.floor(16 * F.log2("c")).alias("step")
    sizes = {r["step"]: r["n"] for r in counts.groupBy(step).agg(F.count(F.lit(1)).alias("n")).collect()}
    least, total = None, 0
    for at in sorted(sizes, reverse=True):
        total += sizes[at]
        if total > most:
            break
        least = at
    if least is None:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    top = counts.filter(F.floor(16 * F.log2("c")) >= least).select("h", "c").toArrow()
    hashes, n = top.column("h").to_numpy().view(np.uint64), top.column("c").to_numpy()
    order = np.lexsort((hashes, -n))
    return hashes[order], n[order]


def vocabulary(train: DataFrame, counts: DataFrame, n_docs: int) -> Vocabulary:
    sums = counts.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).first()
    common, n = most_frequent(counts, COMMON)
    head = grouped_head(common[:HEAD], word_sketch(train, common[:HEAD]))
    totals = (n_docs, int(sums["n"] or 0) + n_docs, sums["v"] + min(1, n_docs))
    return Vocabulary(head, common, n, totals)


def word_sketch(train: DataFrame, head: np.ndarray) -> np.ndarray:
    """A row of ``SKETCH`` sums for each head word over all training documents: a document
    adds 1 or -1 to one sum of each head word it contains, sum and sign by its hash (a
    count sketch).  Rows keep the words' products, so words of the same documents have
    rows alike; the table has the same size however many documents there are."""
    table = np.zeros((len(head), SKETCH), np.int64)
    if len(head) > CLASS_SIZE:
        shared = train.sparkSession.sparkContext.broadcast(head)
        cells = train.select(F.xxhash64("doc", "text").alias("mark"), "text").mapInArrow(_sketched(shared), "cell int, n long")
        sums = cells.groupBy("cell").agg(F.sum("n").alias("n")).toArrow()         # at most HEAD x SKETCH numbers
        table.reshape(-1)[sums.column("cell").to_numpy()] = sums.column("n").to_numpy()
        shared.unpersist()
    return table


def _sketched(shared):
    """The cells of ``word_sketch`` that are not nought in a task's documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = shared.value
        at = np.argsort(head)
        ordered = head[at]
        table = np.zeros(len(head) * SKETCH, np.int64)
        for batch in batches:
            mark = sketch.mixed(batch.column("mark").to_numpy(zero_copy_only=False).view(np.uint64))
            place, sign = (mark % np.uint64(SKETCH)).astype(np.int64), np.where(mark >> np.uint64(63), 1, -1)
            for row, words in enumerate(word_lists(batch.column("text"))):
                found = np.minimum(np.searchsorted(ordered, words), len(head) - 1)
                own = np.unique(at[found[ordered[found] == words]])
                table[own * SKETCH + place[row]] += sign[row]
        cells = np.flatnonzero(table)
        yield pa.RecordBatch.from_arrays([pa.array(cells.astype(np.int32)), pa.array(table[cells])], ["cell", "n"])
    return run


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = SHARES) -> DataFrame:
    """One row per document: its id, ``held_out``, ``n_tokens``, ``n_known``,
    ``train_tokens``, ``base_score`` and ``score`` (log10 probabilities)."""
    spark = docs.sparkSession
    src = docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text"))
    id_type = src.schema["doc"].dataType.simpleString()
    as_text = F.coalesce(F.col("doc").cast("string"), F.lit(""))
    held_out = F.crc32(F.encode(as_text, "UTF-8")) % FOLDS == HELD_OUT
    train = src.filter(~held_out)
    counts = stored(train.select("text").mapInArrow(_counted, "h long, c long").groupBy("h").agg(F.sum("c").alias("c")), "lm_counts")
    vocab = vocabulary(train, counts, train.count())

    model, shared = new_model(vocab), spark.sparkContext.broadcast(vocab)
    for r in range(rounds):
        share = train.filter(F.pmod(F.xxhash64(as_text), F.lit(SHARES)) == r).select("text")
        begun = spark.sparkContext.broadcast(model)
        trained = stored(share.mapInArrow(_trained(shared, begun), "slot long, seen double, model binary"), "lm_models")
        begun.unpersist()
        tasks = (trained.agg(F.max("slot")).first()[0] or 0) + 1
        model = averaged(trained, tasks) or model

    scored = src.mapInArrow(
        _scored(shared, spark.sparkContext.broadcast(model)),
        f"doc {id_type}, n_tokens long, n_known long, n_tail long, log_base double, log_tail double, network double, "
        "rare array<long>, times array<long>")
    scored = stored(scored.withColumn("row", F.monotonically_increasing_id()), "lm_scores")
    rare = scored.select("row", F.explode(F.arrays_zip("rare", "times")).alias("w")).select("row", "w.rare", "w.times")
    looked = rare.join(counts, F.col("rare") == F.col("h"), "left")
    sums = looked.groupBy("row").agg(
        F.sum(F.when(F.col("c").isNotNull(), F.col("times")).otherwise(0)).alias("more_known"),
        F.sum(F.log10(F.coalesce("c", F.lit(0)) + 1) * F.col("times")).alias("more_log"))
    out = scored.drop("rare", "times").join(sums, "row", "left")
    more = F.coalesce("more_log", F.lit(0.0))
    base = F.col("log_base") + more - F.col("n_tokens") * F.lit(math.log10(vocab.n_tokens + vocab.n_types + 1))
    score = F.col("network") + F.col("log_tail") + more - F.col("n_tail") * F.lit(vocab.log_tail())
    return out.select(
        F.col("doc").alias(id_col), held_out.alias("held_out"), "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(vocab.n_tokens).cast("long").alias("train_tokens"), base.alias("base_score"), score.alias("score"))
