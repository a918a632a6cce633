"""Toxicity: a bidirectional gated recurrent network with attention pooling.

Every window of 24 words of a text is scored, one from each word on.
The input of a word joins a hashed word embedding and the mean of its hashed
character trigram embeddings; a network runs over the window from both ends,
attention weighs the states, and a linear layer gives the window's logit.  A
text scores as its highest window, so one toxic passage in a long text counts.

The first coordinate of an embedding is the shrunken log odds of a toxic
document given the word or trigram, the others are fixed random values.  The
network above them is trained in numpy on a bounded, hash-ordered sample of
labelled documents: one half counts the log odds, the other trains, so that the
network does not learn to trust odds that its own documents have made.  A
document's label says nothing about which window is toxic, so the gradient flows
to its windows in proportion to their weight in a soft maximum.  A training step
looks at windows 12 words apart; where they begin is drawn anew for each text and
round, so that all windows take part in training.
Scoring runs in tasks over all documents with the parameters as a broadcast
value of fixed size.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Collection, Iterable, Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from snapmart.llm.texts import remainder

WINDOW = 24
STRIDE = 1
TRAIN_STRIDE = 12
WORD_ROWS = 1 << 12
ODDS_ROWS = 1 << 20  # words are told apart more finely for their log odds
GRAM_ROWS = 1 << 12
WIDTH = 8  # of each embedding
HIDDEN = 8  # of each direction
ATTENTION = 8
# Bounds of the training sample: documents, and characters of one document (of a longer
# one, so many from a place drawn by the hash of its id).
TRAIN_DOCS = 5000
TRAIN_CHARS = 20_000
EPOCHS = 8
BATCH_DOCS = 16
RATE = 0.01
# Documents that a word's log odds are shrunk by.
SHRINK = 10.0
# Gates are straight lines of this slope between 0 and 1, candidate states between -1 and 1.
SLOPE = np.float32(0.25)
REJECT_AT = 0.7
HELD_OUT = (3, 1)  # divisor and remainder of crc32(doc_id)
# Windows scored together, words encoded together, words remembered by a task.
_BATCH_WINDOWS = 4096
_BATCH_WORDS = 200_000
_CACHE_WORDS = 150_000
_EDGE = b".,;:!?\"'()[]{}*#$%&|<>"

Params = dict[str, np.ndarray]


def tokens(text: bytes | None) -> list[bytes]:
    """Words of a UTF-8 text, ASCII letters in lower case."""
    return (text or b"").lower().split()


def word_features(words: Collection[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of each word, rows of all their trigrams, and where each word's trigrams begin."""
    bare = [w.strip(_EDGE) for w in words]
    rows = np.fromiter(map(zlib.crc32, bare), np.int64, len(bare))
    sizes = np.fromiter(map(len, bare), np.int64, len(bare))
    # One buffer of all words between marks; a trigram begins at all but their last two bytes.
    marked = np.frombuffer(b"^" + b"$^".join(bare) + b"$^", np.uint8).astype(np.int64)
    codes = (marked[:-2] << 16) | (marked[1:-1] << 8) | marked[2:]
    ends = np.cumsum(sizes + 2)
    begins = np.ones(len(marked) - 1, bool)
    begins[ends - 1] = False
    begins[(ends - 2)[sizes > 0]] = False
    grams = ((codes[begins[:-1]] * 2654435761) >> 16) % GRAM_ROWS
    counts = np.maximum(sizes, 1)
    return rows, grams, np.cumsum(counts) - counts


def embed(params: Params, features: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    """Input vectors of words: word embedding beside the mean trigram embedding."""
    rows, grams, starts = features
    sizes = np.diff(np.append(starts, len(grams)))[:, None].astype(np.float32)
    spelled = np.add.reduceat(params["grams"][grams], starts, axis=0) / sizes
    odds = params["odds"][rows % ODDS_ROWS, None]
    return np.concatenate([odds, params["words"][rows % WORD_ROWS], spelled], axis=1)


def window_starts(n_words: int, stride: int = STRIDE) -> range:
    """Starts of the overlapping windows that cover a text; one even for an empty text."""
    return range(0, max(1, n_words - (WINDOW - stride)), stride)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _recur(rows, ids, sizes, weights, bias, keep: bool):
    """Run a gated recurrent layer over projected inputs, given as (step, window) of ``rows``."""
    steps, count = ids.shape
    h = HIDDEN
    states = np.zeros((steps + 1, count, h), np.float32)
    cache = []
    full = bool((sizes >= steps).all())
    for t in range(steps):
        last = states[t]
        inputs = rows[ids[t]]
        gates = last @ weights
        zr = np.clip(SLOPE * (inputs[:, : 2 * h] + gates[:, : 2 * h]) + 0.5, 0, 1)
        inner = gates[:, 2 * h :] + bias
        new = np.clip(inputs[:, 2 * h :] + zr[:, h:] * inner, -1, 1)
        state = new + zr[:, :h] * (last - new)
        if not full:
            state = np.where((t < sizes)[:, None], state, last)
        states[t + 1] = state
        if keep:
            cache.append((zr, inner, new))
    return states, cache


def _recur_back(grads, states, cache, sizes, weights):
    """Gradients of the projected inputs, the recurrent weights and the inner bias."""
    steps, count, h = grads.shape
    d_inputs = np.zeros((steps, count, 3 * h), np.float32)
    d_weights, d_bias = np.zeros_like(weights), np.zeros(h, np.float32)
    carry = np.zeros((count, h), np.float32)
    for t in range(steps - 1, -1, -1):
        zr, inner, new = cache[t]
        z, r, last = zr[:, :h], zr[:, h:], states[t]
        on = (t < sizes)[:, None]
        total = grads[t] + carry
        d_state = np.where(on, total, 0)
        d_new = d_state * (1 - z) * (np.abs(new) < 1)
        d_inner = d_new * r
        d_z = d_state * (last - new) * SLOPE * ((z > 0) & (z < 1))
        d_r = d_new * inner * SLOPE * ((r > 0) & (r < 1))
        d_inputs[t] = np.concatenate([d_z, d_r, d_new], axis=1)
        d_gates = np.concatenate([d_z, d_r, d_inner], axis=1)
        d_weights += last.T @ d_gates
        d_bias += d_inner.sum(axis=0)
        carry = d_gates @ weights.T + d_state * z + np.where(on, 0, total)
    return d_inputs, d_weights, d_bias


def _reversed(sizes: np.ndarray, steps: int) -> np.ndarray:
    """For each window, positions read from its last word back; padding stays behind."""
    at = sizes[None, :] - 1 - np.arange(steps)[:, None]
    return np.where(at >= 0, at, np.arange(steps)[:, None])


def project(params: Params, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word inputs as each direction's gates take them."""
    both = (vectors @ params["in_w"] + params["in_b"]).astype(np.float32)
    return (
        np.ascontiguousarray(both[:, : 3 * HIDDEN]),
        np.ascontiguousarray(both[:, 3 * HIDDEN :]),
    )


def window_logits(params: Params, projected, ids: np.ndarray, sizes: np.ndarray, keep=False):
    """Logits of windows given as (step, window) rows of ``projected`` word inputs."""
    steps, count = ids.shape
    rows_a, rows_b = projected
    turn = _reversed(sizes, steps)
    lanes = np.arange(count)[None, :]
    ahead, cache_a = _recur(rows_a, ids, sizes, params["u_a"], params["c_a"], keep)
    back, cache_b = _recur(rows_b, ids[turn, lanes], sizes, params["u_b"], params["c_b"], keep)
    states = np.concatenate([ahead[1:], back[1:][turn, lanes]], axis=2)
    hidden = np.tanh(states @ params["att_w"] + params["att_b"])
    weight = hidden @ params["att_v"]
    weight = np.where(np.arange(steps)[:, None] < sizes[None, :], weight, -1e30)
    weight = np.exp(weight - weight.max(axis=0)) * (np.arange(steps)[:, None] < sizes[None, :])
    weight /= np.maximum(weight.sum(axis=0), 1e-30)
    pooled = (weight[:, :, None] * states).sum(axis=0)
    logits = pooled @ params["out_w"] + params["out_b"][0]
    return logits, (turn, lanes, ahead, cache_a, back, cache_b, states, hidden, weight, pooled)


def _step(weights, bias, inputs, last, gates, out) -> None:
    """One recurrent step of many windows, features first; z and r come sloped and raised."""
    h = HIDDEN
    np.matmul(weights, last, out=gates)
    zr, new = gates[: 2 * h], gates[2 * h :]
    zr += inputs[: 2 * h]
    np.clip(zr, 0, 1, out=zr)
    new += bias
    new *= zr[h:]
    new += inputs[2 * h :]
    np.clip(new, -1, 1, out=new)
    np.subtract(last, new, out=out)
    out *= zr[:h]
    out += new


def highest_logits(params: Params, projected, ids: list[np.ndarray]) -> np.ndarray:
    """The highest logit of all windows of each text, for texts of ``WINDOW`` words or more.

    One window starts at every word, so the inputs of a step of consecutive
    windows are consecutive words: nothing is gathered for each window.  Sums
    for the attention run along with the second direction.
    """
    h, flat = HIDDEN, np.concatenate(ids)
    lengths = np.array([len(d) for d in ids])
    sloped = np.repeat(np.array([SLOPE, SLOPE, 1], np.float32), h)
    raised = np.repeat(np.array([0.5, 0.5, 0], np.float32), h)
    ahead, back = (np.ascontiguousarray((params[u] * sloped).T) for u in ("u_a", "u_b"))
    bias_a, bias_b = params["c_a"][:, None], params["c_b"][:, None]
    # The last row gives a state's part of the logit.
    seen = np.concatenate([params["att_w"], params["out_w"][:, None]], axis=1).T.astype(np.float32)
    seen_a, seen_b = np.ascontiguousarray(seen[:, :h]), np.ascontiguousarray(seen[:, h:])
    out = np.empty(len(flat) - WINDOW + 1, np.float32)
    for low in range(0, len(out), _BATCH_WINDOWS):
        count = min(_BATCH_WINDOWS, len(out) - low)
        words = flat[low : low + count + WINDOW - 1]
        in_a, in_b = (
            np.ascontiguousarray((rows[words] * sloped + raised).T) for rows in projected
        )
        states = np.zeros((WINDOW + 1, h, count), np.float32)
        gates = np.empty((3 * h, count), np.float32)
        for k in range(WINDOW):
            _step(ahead, bias_a, in_a[:, k : k + count], states[k], gates, states[k + 1])
        last, state = np.zeros((2, h, count), np.float32)
        top, total = np.zeros((2, count), np.float32)
        part, other = np.empty((2, ATTENTION + 1, count), np.float32)
        for k in range(WINDOW - 1, -1, -1):
            _step(back, bias_b, in_b[:, k : k + count], last, gates, state)
            last, state = state, last
            np.matmul(seen_a, states[k + 1], out=part)
            np.matmul(seen_b, last, out=other)
            part += other
            hidden = part[:ATTENTION]
            hidden += params["att_b"][:, None]
            np.tanh(hidden, out=hidden)
            # At most the sum of the weights' sizes, so no maximum is needed.
            weight = np.exp(params["att_v"] @ hidden)
            total += weight
            weight *= part[ATTENTION]
            top += weight
        out[low : low + count] = top / total + params["out_b"][0]
    ends = np.cumsum(lengths)
    # Windows that reach into the next text do not count.
    for end in ends[:-1].tolist():
        out[end - WINDOW + 1 : end] = -np.inf
    return np.maximum.reduceat(out, ends - lengths)


def _gradients(params, vectors, ids, sizes, d_logits, cache):
    """Gradients of all trained parameters for given gradients of the window logits."""
    turn, lanes, ahead, cache_a, back, cache_b, states, hidden, weight, pooled = cache
    h3 = 3 * HIDDEN
    grads = {"out_w": pooled.T @ d_logits, "out_b": np.array([d_logits.sum()], np.float32)}
    d_pooled = d_logits[:, None] * params["out_w"][None, :]
    d_weight = (states * d_pooled[None]).sum(axis=2)
    d_states = weight[:, :, None] * d_pooled[None]
    d_score = weight * (d_weight - (weight * d_weight).sum(axis=0))
    grads["att_v"] = np.einsum("twa,tw->a", hidden, d_score)
    d_hidden = d_score[:, :, None] * params["att_v"] * (1 - hidden * hidden)
    grads["att_w"] = np.einsum("twi,twa->ia", states, d_hidden)
    grads["att_b"] = d_hidden.sum(axis=(0, 1))
    d_states = (d_states + d_hidden @ params["att_w"].T).astype(np.float32)
    d_back = np.zeros_like(d_states[:, :, HIDDEN:])
    np.add.at(d_back, (turn, lanes), d_states[:, :, HIDDEN:])
    d_in_a, grads["u_a"], grads["c_a"] = _recur_back(
        d_states[:, :, :HIDDEN], ahead, cache_a, sizes, params["u_a"]
    )
    d_in_b, grads["u_b"], grads["c_b"] = _recur_back(d_back, back, cache_b, sizes, params["u_b"])
    d_projected = np.zeros((len(vectors), 2 * h3), np.float32)
    np.add.at(d_projected[:, :h3], ids, d_in_a)
    np.add.at(d_projected[:, h3:], ids[turn, lanes], d_in_b)
    grads["in_w"] = vectors.T @ d_projected
    grads["in_b"] = d_projected.sum(axis=0)
    return grads


def _log_odds(rows: list[np.ndarray], labels: np.ndarray, size: int) -> np.ndarray:
    """Shrunken log odds of a toxic document, for each hashed row that occurs in it."""
    ones, all_ = np.zeros(size), np.zeros(size)
    for found, label in zip(rows, labels, strict=True):
        all_[found] += 1
        ones[found] += label
    share = np.clip(labels.mean(), 1e-3, 1 - 1e-3)
    toxic = (ones + SHRINK * share) / (all_ + SHRINK)
    toxic = np.clip(toxic, 1e-3, 1 - 1e-3)
    return np.log(toxic / (1 - toxic)) - np.log(share / (1 - share))


def train(texts: list[bytes], labels: list[int], seed: int = 1) -> Params | None:
    """Parameters fitted to labelled texts; None unless both labels occur."""
    y = np.array(labels, np.float32)
    if not len(y) or y.min() == y.max():
        return None
    rng = np.random.default_rng(seed)
    docs = [tokens(t) for t in texts]
    normal = lambda *shape: rng.normal(0, 0.3, shape).astype(np.float32)
    params: Params = {
        "odds": np.zeros(ODDS_ROWS, np.float32),
        "words": normal(WORD_ROWS, WIDTH - 1),
        "grams": normal(GRAM_ROWS, WIDTH),
        "in_w": normal(2 * WIDTH, 6 * HIDDEN),
        "in_b": np.zeros(6 * HIDDEN, np.float32),
        "u_a": normal(HIDDEN, 3 * HIDDEN),
        "u_b": normal(HIDDEN, 3 * HIDDEN),
        "c_a": np.zeros(HIDDEN, np.float32),
        "c_b": np.zeros(HIDDEN, np.float32),
        "att_w": normal(2 * HIDDEN, ATTENTION),
        "att_b": np.zeros(ATTENTION, np.float32),
        "att_v": normal(ATTENTION),
        "out_w": normal(2 * HIDDEN),
        "out_b": np.array([-2.0], np.float32),
    }
    # The sample is in no order of labels; every other document counts, the rest train.
    features = [word_features(dict.fromkeys(d)) for d in docs[::2]]
    words = [np.unique(f[0] % ODDS_ROWS) for f in features]
    params["odds"] = _log_odds(words, y[::2], ODDS_ROWS).astype(np.float32)
    params["grams"][:, 0] = _log_odds([np.unique(f[1]) for f in features], y[::2], GRAM_ROWS)
    docs, y = docs[1::2] or docs, y[1::2] if len(y) > 1 else y
    fixed = ("odds", "words", "grams")
    moments = {
        k: (np.zeros_like(v), np.zeros_like(v)) for k, v in params.items() if k not in fixed
    }
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(docs))
        for low in range(0, len(order), BATCH_DOCS):
            step += 1
            part = order[low : low + BATCH_DOCS]
            _train_step(params, moments, step, [docs[i] for i in part], y[part], rng)
    return params


def _training_starts(n_words: int, shift: int) -> np.ndarray:
    """Starts of windows that cover a text, ``TRAIN_STRIDE`` apart and shifted."""
    last = max(0, n_words - WINDOW)
    return np.unique(np.clip(np.arange(-shift, last + TRAIN_STRIDE, TRAIN_STRIDE), 0, last))


def _train_step(
    params: Params, moments, step: int, docs: list[list[bytes]], y: np.ndarray, rng: np.random.Generator
) -> None:
    vocabulary: dict[bytes, int] = {b"": 0}
    ids = [np.array([vocabulary.setdefault(w, len(vocabulary)) for w in d], np.int64) for d in docs]
    vectors = embed(params, word_features(vocabulary))
    projected = project(params, vectors)
    starts = [_training_starts(len(d), int(rng.integers(TRAIN_STRIDE))) for d in ids]
    flat, begin, sizes, owner = _windows(ids, starts)
    windows = _window_ids(flat, begin, sizes)
    logits, cache = window_logits(params, projected, windows, sizes, keep=True)
    top = np.full(len(docs), -np.inf)
    np.maximum.at(top, owner, logits)
    weight = np.exp(2 * (logits - top[owner]))
    weight /= np.bincount(owner, weight, len(docs))[owner]
    d_docs = (_sigmoid(top) - y) / len(docs)
    d_logits = (weight * d_docs[owner]).astype(np.float32)
    grads = _gradients(params, vectors, windows, sizes, d_logits, cache)
    for name, g in grads.items():
        m, v = moments[name]
        m += 0.1 * (g - m)
        v += 0.001 * (g * g - v)
        params[name] -= (
            RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-7)
        ).astype(np.float32)


def _windows(ids: list[np.ndarray], starts: list):
    """Word ids of all texts in a row, and where all windows begin, their sizes and documents."""
    owner = np.repeat(np.arange(len(ids)), [len(s) for s in starts])
    offset = np.cumsum([0, *[len(d) for d in ids]])
    begin = np.concatenate([np.array(s, np.int64) + o for s, o in zip(starts, offset, strict=False)])
    sizes = np.minimum(offset[owner + 1] - begin, WINDOW)
    return np.concatenate([*ids, np.zeros(1, np.int64)]), begin, sizes, owner


def _window_ids(flat: np.ndarray, begin: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Word ids of windows as (step, window)."""
    at = begin[None, :] + np.arange(WINDOW)[:, None]
    inside = np.arange(WINDOW)[:, None] < sizes[None, :]
    return np.where(inside, flat[np.minimum(at, len(flat) - 1)], 0)


@dataclass
class Scorer:
    """Scores texts inside a task, remembering the inputs of recent words."""

    params: Params

    def __post_init__(self) -> None:
        self.forget()

    def forget(self) -> None:
        self.vocabulary: defaultdict[bytes, int] = defaultdict()
        # A word that is asked for and missing gets the next number.
        self.vocabulary.default_factory = self.vocabulary.__len__
        empty = np.zeros((0, 3 * HIDDEN), np.float32)
        self.projected = (empty, empty)
        self.vocabulary[b""]
        self._learn()

    def _learn(self) -> None:
        words = list(islice(self.vocabulary, len(self.projected[0]), None))
        if not words:
            return
        vectors = embed(self.params, word_features(words))
        rows = project(self.params, vectors)
        self.projected = tuple(map(np.concatenate, zip(self.projected, rows, strict=True)))

    def scores(self, texts: Iterable[bytes | None]) -> np.ndarray:
        found, docs, held = [], [], 0
        for text in texts:
            docs.append(tokens(text))
            held += len(docs[-1])
            if held >= _BATCH_WORDS:
                found.append(self._score(docs))
                docs, held = [], 0
        if docs:
            found.append(self._score(docs))
        return np.concatenate(found) if found else np.zeros(0)

    def _score(self, docs: list[list[bytes]]) -> np.ndarray:
        if len(self.vocabulary) > _CACHE_WORDS:
            self.forget()
        number = self.vocabulary.__getitem__
        ids = [np.fromiter(map(number, d), np.int64, len(d)) for d in docs]
        self._learn()
        top = np.empty(len(docs))
        long = np.array([len(d) >= WINDOW for d in ids])
        if long.any():
            top[long] = highest_logits(self.params, self.projected, [d for d in ids if len(d) >= WINDOW])
        short = [d for d in ids if len(d) < WINDOW]
        for low in range(0, len(short), _BATCH_WINDOWS):
            part = short[low : low + _BATCH_WINDOWS]
            flat, begin, sizes, _ = _windows(part, [window_starts(len(d)) for d in part])
            windows = _window_ids(flat, begin, sizes)
            logits, _ = window_logits(self.params, self.projected, windows, sizes)
            top[np.flatnonzero(~long)[low : low + _BATCH_WINDOWS]] = logits
        return _sigmoid(top)


def labelled_sample(
    docs: DataFrame, labels: DataFrame, limit: int = TRAIN_DOCS
) -> tuple[list[bytes], list[int]]:
    """Texts and labels of at most ``limit`` documents outside the held-out fold.

    The sample is the first in the order of a hash of the id, so it does not
    depend on how rows are stored.  Texts over ``TRAIN_CHARS`` characters give an
    excerpt for training (they are scored whole, like all others).
    """
    divisor, held = HELD_OUT
    chosen = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
        .where(remainder(F.col("doc_id"), divisor) != held)
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(limit)
    )
    spare = F.greatest(F.length("text") - TRAIN_CHARS, F.lit(0))
    begin = 1 + F.pmod(F.xxhash64("doc_id"), spare + 1).cast("int")
    rows = (
        docs.where(F.col("text").isNotNull())
        .select("doc_id", F.substr("text", begin, F.lit(TRAIN_CHARS)).alias("text"))
        .join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id", "toxic")
        .agg(F.max("text").alias("text"))
        .collect()
    )
    rows.sort(key=lambda r: r["doc_id"])
    return [r["text"].encode() for r in rows], [int(r["toxic"] > 0) for r in rows]


def with_scores(
    docs: DataFrame, params: Params | None, keys: list[str], out: str = "score"
) -> DataFrame:
    """The key columns and ``out`` (0 to 1) for every row; 0 when there is no model.

    Null, empty and blank texts are one window without words and get the score
    of the network's last bias alone.
    """
    if params is None:
        return docs.select(*keys, F.lit(0.0).alias(out))
    shared = docs.sparkSession.sparkContext.broadcast(params)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            texts = batch.column(0).cast(pa.binary())
            scores = scorer.scores(t.as_py() for t in texts)
            columns = [*batch.columns[1:], pa.array(scores.astype(np.float64))]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[1:], out])

    fields = [docs.schema[k] for k in keys]
    named = docs.select(F.col("text").alias("_toxic_text"), *keys)
    return named.mapInArrow(run, T.StructType([*fields, T.StructField(out, T.DoubleType())]))


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Score and prediction of every document by a network trained on the labelled ones.

    Repeated rows are scored each, a null doc_id is never held out, extra
    columns are ignored and an empty table gives no rows.
    """
    divisor, held = HELD_OUT
    params = train(*labelled_sample(docs, labels))
    scored = with_scores(docs.select("doc_id", "text"), params, ["doc_id"])
    return scored.select(
        "doc_id",
        (remainder(F.col("doc_id"), divisor) == held).alias("held_out"),
        "score",
        (F.col("score") >= REJECT_AT).cast("int").alias("predicted"),
    )


def keep_civil(docs: DataFrame, labels: DataFrame, reject_at: float = REJECT_AT) -> DataFrame:
    """The documents that score below the threshold, with all their columns."""
    params = train(*labelled_sample(docs, labels))
    if params is None:
        return docs
    # The text travels through the scoring tasks, so no join is needed.
    scored = with_scores(docs, params, docs.columns, "_toxic_score")
    return scored.where(F.col("_toxic_score") < reject_at).select(*docs.columns)
