"""Scoring texts with a hidden Markov language model.

Tokens are words in lower case, then one end.  Tokens that hold at least
1 / ``FREQUENT`` of all training tokens (and ``LEAST``) are symbols of their own,
at most ``FREQUENT`` of them whatever the corpus; all rarer ones are grouped by their
last letters into ``RARE_CLASSES`` symbols.  The hidden states emit symbols, and
a rare token has a share of its symbol given by its count in the corpus, so

    P(text) = P(symbols) * product over rare tokens of P(token | symbol).

Baum-Welch runs over all training texts: each task collects expected counts of
its blocks of tokens, Spark sums them by symbol, and the driver receives one row
per symbol and state.  The first factor is the exact likelihood of the whole
sequence by the scaled forward recursion, for many texts in step.  The second
needs counts of any token, and so a join of the rare tokens of each text with
the counts of the corpus; a rare token is never a hot key there.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapmart.llm.tables import saved
from snapmart.llm.texts import constant_doubles, remainder

HELD_OUT = (7, 2)  # divisor and remainder of crc32(doc_id)
FREQUENT = 1 << 18
RARE_CLASSES = 256
SUFFIX_BYTES = 3
STATES = 8
ROUNDS = 4
STAY = 0.9  # chance to stay in a state that training starts from
BLOCK = 64  # tokens of a training sequence
PRIOR = 0.1  # weight of the corpus distribution, by the tokens of a state
LEAST = 10  # tokens that a symbol of its own needs in any corpus
END = b" "  # no word has a blank
_BATCH_BLOCKS = 4096
# Bytes of texts, or of symbols, that a task works on at a time: the more rows there are in
# step, the fewer steps; what is made of texts takes many times their size.
_SLICE_BYTES = 1 << 20
_COUNTED_BYTES = 1 << 23
_STEPPED_BYTES = 1 << 24

_NUMBERS = [f"s{k}" for k in range(STATES)]


def tokens(text: bytes | None) -> list[bytes]:
    """Words of a UTF-8 text with ASCII letters in lower case, then the end."""
    words = (text or b"").lower().split()
    words.append(END)
    return words


def rare_class(token: bytes) -> int:
    """The class of a rare token, from its last bytes."""
    return zlib.crc32(token[-SUFFIX_BYTES:]) % RARE_CLASSES


def _slices(
    batches: Iterator[pa.RecordBatch], column: int, most: int = _SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Rows of batches with about ``most`` bytes of a text or list column at a time.

    What a task makes of the rows is held for one slice only.
    """
    for batch in batches:
        values = batch.column(column)
        if pa.types.is_list(values.type):
            sizes = 4 * np.diff(values.offsets.to_numpy(zero_copy_only=False)).astype(np.int64)
        else:
            sizes = pc.fill_null(pc.binary_length(values), 0).to_numpy(zero_copy_only=False)
        ends, low = np.cumsum(sizes), 0
        while low < batch.num_rows:
            before = ends[low - 1] if low else 0
            high = max(low + 1, int(np.searchsorted(ends, before + most, side="right")))
            yield batch.slice(low, high - low)
            low = high


def split_tokens(texts: pa.StringArray) -> tuple[pa.DictionaryArray, np.ndarray]:
    """Tokens of many texts as :func:`tokens` cuts them, and how many each text has."""
    padded = pc.binary_join_element_wise(pc.fill_null(pc.ascii_lower(texts), ""), "", " ")
    lists = pc.ascii_split_whitespace(padded)
    found = lists.flatten().cast(pa.binary())
    owner = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy())
    # Blanks at either end leave an empty piece there; the last one, of the blank added, is the end.
    ends = np.cumsum(np.bincount(owner, minlength=len(lists))) - 1
    last = np.zeros(len(found), bool)
    last[ends] = True
    wanted = last | (pc.binary_length(found).to_numpy() > 0)
    found = pc.if_else(pa.array(last), pa.scalar(END, pa.binary()), found).filter(pa.array(wanted))
    return found.dictionary_encode(), np.bincount(owner[wanted], minlength=len(lists))


def token_counts(docs: DataFrame) -> DataFrame:
    """``token``, ``class`` and ``c`` of every distinct token of the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches, 0, _COUNTED_BYTES):
            found, _ = split_tokens(batch.column(0))
            counts = np.bincount(found.indices.to_numpy(), minlength=len(found.dictionary))
            classes = [rare_class(t) for t in found.dictionary.to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [found.dictionary, pa.array(classes, pa.int32()), pa.array(counts, pa.int64())],
                ["token", "class", "c"],
            )

    return (
        docs.select("text")
        .mapInArrow(run, "token binary, class int, c bigint")
        .groupBy("token")
        .agg(F.first("class").alias("class"), F.sum("c").alias("c"))
    )


@dataclass
class Lexicon:
    """What is known of the corpus's tokens; its size is bounded by ``FREQUENT``."""

    total: int
    distinct: int
    symbols: dict[bytes, int]  # symbol of each frequent token
    counts: np.ndarray  # tokens of each symbol: frequent ones, then the rare classes
    class_total: np.ndarray  # tokens of each rare class
    class_distinct: np.ndarray

    @classmethod
    def of(cls, counts: DataFrame) -> Lexicon:
        whole = counts.agg(
            F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")
        ).first()
        often = (F.col("c") * FREQUENT >= whole["n"]) & (F.col("c") >= LEAST)
        often = often | (F.col("token") == F.lit(bytearray(END)))
        frequent = counts.where(often).select("token", "c").collect()
        frequent = {bytes(r["token"]): r["c"] for r in frequent}
        frequent.setdefault(END, 0)
        names = sorted(frequent, key=lambda t: (-frequent[t], t))
        total, distinct = np.zeros(RARE_CLASSES), np.zeros(RARE_CLASSES)
        rare = counts.where(~often).groupBy("class")
        for r in rare.agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("v")).collect():
            total[r["class"]], distinct[r["class"]] = r["c"], r["v"]
        return cls(
            whole["n"],
            whole["v"],
            {t: i for i, t in enumerate(names)},
            np.concatenate([[float(frequent[t]) for t in names], total]),
            total,
            distinct,
        )

    @property
    def base_divisor(self) -> int:
        return self.total + 1 * (self.distinct + 1)


@dataclass
class Model:
    """Parameters: start and middle distributions, transitions, emissions[symbol, state]."""

    start: np.ndarray
    middle: np.ndarray
    moves: np.ndarray
    emissions: np.ndarray

    @classmethod
    def begin(cls, counts: np.ndarray, seed: int = 3) -> Model:
        """States that stay, with emissions scattered around the corpus distribution."""
        rng = np.random.default_rng(seed)
        moves = np.full((STATES, STATES), (1 - STAY) / (STATES - 1))
        np.fill_diagonal(moves, STAY)
        even = np.full(STATES, 1 / STATES)
        scatter = rng.uniform(0.5, 1.5, (len(counts), STATES)) * _shares(counts)[:, None]
        return cls(even, even.copy(), moves, scatter / scatter.sum(axis=0))

    @classmethod
    def fit(cls, counted: dict[str, np.ndarray], shares: np.ndarray) -> Model:
        """Parameters from expected counts, smoothed so that nothing is impossible."""
        moved = counted["move"] + 1.0
        start, used = counted["start"] + 1.0, counted["emit"].sum(axis=0) + 1.0
        emitted = counted["emit"] + PRIOR * used * shares[:, None]
        return cls(
            start / start.sum(),
            used / used.sum(),
            moved / moved.sum(axis=1, keepdims=True),
            emitted / emitted.sum(axis=0),
        )


def _shares(counts: np.ndarray) -> np.ndarray:
    """The corpus distribution of symbols, none without a chance."""
    return (counts + 0.5) / (counts.sum() + 0.5 * len(counts))


def encoded(docs: DataFrame, lexicon: Broadcast) -> DataFrame:
    """Symbols of each text, what its frequent tokens add to the base score, and its rare tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: Lexicon = lexicon.value
        first = len(known.symbols)
        logs = np.log10((known.counts + 1) / known.base_divisor)
        struct = pa.struct([("token", pa.binary()), ("class", pa.int32()), ("tf", pa.int32())])
        for batch in _slices(batches, 2):
            found, sizes = split_tokens(batch.column(2))
            distinct = found.dictionary.to_pylist()
            own = np.array([known.symbols.get(t, -1) for t in distinct], np.int32)
            unknown = own < 0
            classes = np.zeros(len(distinct), np.int32)
            classes[unknown] = [rare_class(distinct[i]) for i in np.flatnonzero(unknown).tolist()]
            own[unknown] = first + classes[unknown]
            codes, count = found.indices.to_numpy(), len(sizes)
            owner, at = np.repeat(np.arange(count), sizes), own[codes]
            frequent = ~unknown[codes]
            base = np.bincount(owner[frequent], logs[at[frequent]], count)
            known_n = np.bincount(owner[frequent], known.counts[at[frequent]] > 0, count)
            pairs, tf = np.unique(
                owner[~frequent] * len(distinct) + codes[~frequent], return_counts=True
            )
            holder, token = np.divmod(pairs, max(1, len(distinct)))
            rare = np.bincount(holder, minlength=count)
            items = pa.StructArray.from_arrays(
                [
                    found.dictionary.take(pa.array(token)),
                    pa.array(classes[token], pa.int32()),
                    pa.array(tf, pa.int32()),
                ],
                fields=list(struct),
            )
            offsets, rare_offsets = (
                pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32()) for n in (sizes, rare)
            )
            flat = pa.array(at, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.ListArray.from_arrays(offsets, flat),
                    pa.array(base, pa.float64()),
                    pa.array(known_n.astype(np.int64)),
                    pa.ListArray.from_arrays(rare_offsets, items),
                ],
                ["doc_id", "held_out", "symbols", "base", "known", "rare"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "held_out", "text").mapInArrow(
        run,
        f"doc_id {kind}, held_out boolean, symbols array<int>, base double, known bigint, "
        "rare array<struct<token: binary, class: int, tf: int>>",
    )


def block_counts(model: Model, blocks: np.ndarray, sizes: np.ndarray, first: np.ndarray):
    """Expected counts of blocks of symbols (step, block), by the forward-backward recursion.

    ``first`` marks blocks that begin a text.  Returns emissions, moves, starts
    and the log-likelihood of the blocks.
    """
    steps, count = blocks.shape
    ahead = np.zeros((steps, count, STATES))
    scale = np.ones((steps, count))
    full = bool((sizes == steps).all())
    for t in range(steps):
        seen = model.emissions[blocks[t]]
        if t == 0:
            state = np.where(first[:, None], model.start, model.middle) * seen
        else:
            state = (ahead[t - 1] @ model.moves) * seen
        total = state.sum(axis=1)
        if not full:
            on = t < sizes
            total = np.where(on, total, 1.0)
            state = np.where(on[:, None], state, ahead[t - 1] if t else state)
        scale[t] = total
        ahead[t] = state / total[:, None]
    back = np.ones((count, STATES))
    moves = np.zeros((STATES, STATES))
    weights = np.empty_like(ahead)
    for t in range(steps - 1, -1, -1):
        weights[t] = ahead[t] * back
        if t:
            coming = model.emissions[blocks[t]] * back / scale[t][:, None]
            if full:
                moves += ahead[t - 1].T @ coming
                back = coming @ model.moves.T
            else:
                on = (t < sizes)[:, None]
                moves += ahead[t - 1].T @ np.where(on, coming, 0)
                back = np.where(on, coming @ model.moves.T, back)
    if not full:
        weights *= (np.arange(steps)[:, None] < sizes[None, :])[:, :, None]
    flat = blocks.ravel()
    emit = np.stack(
        [
            np.bincount(flat, weights[:, :, k].ravel(), len(model.emissions))
            for k in range(STATES)
        ],
        axis=1,
    )
    return emit, moves * model.moves, weights[0][first].sum(axis=0), float(np.log(scale).sum())


def _blocks(lists: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of tokens of a batch of texts, padded: symbols (step, block), sizes, first."""
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    lengths = np.diff(lists.offsets.to_numpy(zero_copy_only=False)).astype(np.int64)
    per_text = -(-lengths // BLOCK)
    owner = np.repeat(np.arange(len(lengths)), per_text)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
    begin = (np.cumsum(lengths) - lengths)[owner] + number * BLOCK
    sizes = np.minimum(lengths[owner] - number * BLOCK, BLOCK)
    order = np.argsort(-sizes, kind="stable")
    for low in range(0, len(order), _BATCH_BLOCKS):
        part = order[low : low + _BATCH_BLOCKS]
        steps = np.arange(sizes[part].max())[:, None]
        at = np.minimum(begin[part][None, :] + steps, len(flat) - 1)
        yield flat[at], sizes[part], number[part] == 0


def expected_counts(symbols: DataFrame, model: Model) -> tuple[dict[str, np.ndarray], float]:
    """Baum-Welch counts of all texts, summed over partitions, and their log-likelihood."""
    shared = symbols.sparkSession.sparkContext.broadcast(model)
    size = len(model.emissions)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        emit, moves = np.zeros((size, STATES)), np.zeros((STATES, STATES))
        start, log_likelihood = np.zeros(STATES), 0.0
        for batch in _slices(batches, 0, _STEPPED_BYTES):
            for blocks, sizes, first in _blocks(batch.column(0)):
                e, m, s, ll = block_counts(own, blocks, sizes, first)
                emit += e
                moves += m
                start += s
                log_likelihood += ll
        used = np.flatnonzero(emit.any(axis=1))
        extra = np.zeros((2, STATES))
        extra[0], extra[1, 0] = start, log_likelihood
        values = np.concatenate([emit[used], moves, extra])
        index = np.concatenate([used, size + np.arange(STATES + 2)])
        columns = [pa.array(index), *(pa.array(values[:, k]) for k in range(STATES))]
        yield pa.RecordBatch.from_arrays(columns, ["row", *_NUMBERS])

    kinds = ", ".join(["row bigint", *(f"{s} double" for s in _NUMBERS)])
    rows = (
        symbols.select("symbols")
        .mapInArrow(run, kinds)
        .groupBy("row")
        .agg(*(F.sum(s).alias(s) for s in _NUMBERS))
        .collect()  # one row per symbol and state
    )
    values = np.zeros((size + STATES + 2, STATES))
    for r in rows:
        values[r["row"]] = r[1:]
    counted = {
        "emit": values[:size],
        "move": values[size : size + STATES],
        "start": values[size + STATES],
    }
    return counted, float(values[size + STATES + 1, 0])


def train(symbols: DataFrame, counts: np.ndarray, rounds: int = ROUNDS) -> tuple[Model, list[float]]:
    """A model of the texts and the log-likelihood of their blocks before each round."""
    model, shares, history = Model.begin(counts), _shares(counts), []
    if not counts.sum():
        return model, history
    for _ in range(rounds):
        counted, log_likelihood = expected_counts(symbols, model)
        history.append(log_likelihood)
        model = Model.fit(counted, shares)
    return model, history


def log_likelihoods(model: Model, lists: pa.ListArray) -> np.ndarray:
    """Exact natural log-likelihood of each sequence of symbols, all in step."""
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    lengths = np.diff(lists.offsets.to_numpy(zero_copy_only=False)).astype(np.int64)
    order = np.argsort(-lengths, kind="stable")
    begin = (np.cumsum(lengths) - lengths)[order]
    ordered = lengths[order]
    logs = np.zeros(len(lengths))
    state = np.tile(model.start, (len(lengths), 1))
    live = len(lengths)
    for t in range(int(ordered[0]) if len(ordered) else 0):
        while live and ordered[live - 1] <= t:
            live -= 1
        state = state[:live] if t == 0 else state[:live] @ model.moves
        state = state * model.emissions[flat[begin[:live] + t]]
        total = state.sum(axis=1)
        state /= total[:, None]
        logs[:live] += np.log(total)
    out = np.empty(len(lengths))
    out[order] = logs
    return out


def forward_scores(rows: DataFrame, model: Model) -> DataFrame:
    """``row`` and ``forward``: log10 of the probability of each row's symbols."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches, 1, _STEPPED_BYTES):
            found = log_likelihoods(shared.value, batch.column(1)) / np.log(10)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found)], ["row", "forward"])

    return rows.select("row", "symbols").mapInArrow(run, "row bigint, forward double")


def scores(docs: DataFrame, held_out: tuple[int, int] = HELD_OUT) -> DataFrame:
    """Base score and model score (log10) of every text, learned outside the held-out fold.

    Null and empty texts are an end alone.  A null doc_id is never held out,
    repeated rows are scored each, and other columns are ignored.  Without
    training texts every token is unknown.  An empty table gives no rows.
    """
    spark = docs.sparkSession
    divisor, rest = held_out
    folded = docs.select(
        "doc_id", (remainder(F.col("doc_id"), divisor) == rest).alias("held_out"), "text"
    )
    counts = saved(token_counts(folded.where(~F.col("held_out"))), "lm-counts")
    lexicon = Lexicon.of(counts)
    rows = saved(
        encoded(folded, spark.sparkContext.broadcast(lexicon)).withColumn(
            "row", F.monotonically_increasing_id()
        ),
        "lm-symbols",
    )
    model, _ = train(rows.where(~F.col("held_out")), lexicon.counts)

    rare = rows.select("row", F.explode("rare").alias("r")).select("row", "r.*")
    c = F.coalesce("c", F.lit(0))
    of_class = constant_doubles((lexicon.class_total + lexicon.class_distinct + 1).tolist())
    added = (
        rare.join(counts.select("token", "c"), "token", "left")
        .select(
            "row",
            (F.col("tf") * F.log10((c + 1) / F.lit(float(lexicon.base_divisor)))).alias("base"),
            F.when(c > 0, F.col("tf")).otherwise(0).cast("bigint").alias("known"),
            (F.col("tf") * F.log10((c + 1) / F.get(of_class, F.col("class")))).alias("score"),
        )
        .groupBy("row")
        .agg(*(F.sum(n).alias(f"rare_{n}") for n in ("base", "known", "score")))
    )
    own = rows.select(
        "row", "doc_id", "held_out", F.size("symbols").cast("bigint").alias("n_tokens"), "base", "known"
    )
    zero = lambda name: F.coalesce(name, F.lit(0))
    return (
        own.join(forward_scores(rows, model), "row")
        .join(added, "row", "left")
        .select(
            "doc_id",
            "held_out",
            "n_tokens",
            (F.col("known") + zero("rare_known")).alias("n_known"),
            F.lit(lexicon.total).cast("bigint").alias("train_tokens"),
            (F.col("base") + zero("rare_base")).alias("base_score"),
            (F.col("forward") + zero("rare_score")).alias("score"),
        )
    )
