"""A hidden Markov language model: Baum-Welch over partitions, exact likelihoods by the scaled forward recursion.

Words are counted over all training documents. The frequent ones (at most ``HEAD``, by a threshold on the count) are symbols of
their own; every other word, known or not, is a symbol by the hash of its last bytes (``TAILS`` classes), and its share of its class is
(c + 1) / (C + V + 1), with C and V the count and number of training words in the class and one unknown word. So symbols are bounded
whatever the vocabulary, the model is a proper distribution over words, and counts of rare words never come to the driver: they meet
the documents' rare words in a shuffle join.

Baum-Welch runs ``ROUNDS`` times over all training tokens, cut into pieces of ``PIECE`` for speed; each partition sums
its expected counts, those are summed by symbol in a shuffle, and only the bounded sums reach the driver. Scoring takes each whole document, uncut.

Defined results. Null or empty text: the end token alone. Null doc_id: a training document. Repeated rows: each scored, and
counted as often as it is there. Nothing to learn from: counts of zero, every class even. Empty table: empty result. Very long
texts: whole; the recursion keeps one vector a document. Extra columns are dropped.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, arrow_batches

HEAD = 16_384
TAILS = 1024
#: Bytes at a word's end that give the class of a rare word.
ENDING = 3
STATES = 8
ROUNDS = 7
PIECE = 128
#: Tokens that one step of Baum-Welch holds at once.
STEP_TOKENS = 1 << 18
SEED = 20
#: Words that a worker counts before it passes the counts on.
FLUSH_WORDS = 200_000
#: Pseudo-counts: of the symbol frequencies in each state's emissions, and of each transition.
PRIOR_EMISSION, PRIOR_MOVE = 200.0, 1.0


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 7 == 2, F.lit(False))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Word counts, and under null the number of documents."""
    counts: Counter = Counter()

    def flush() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.binary()), pa.array(counts.values(), pa.int64())], names=["word", "c"])
        counts.clear()
        return out

    for batch in batches:
        for text in batch.column(0).to_pylist():
            counts.update((text or b"").lower().split())
        counts[None] += batch.num_rows
        if len(counts) > FLUSH_WORDS:
            yield flush()
    yield flush()


@dataclass
class Vocabulary:
    """Symbols: frequent words 0.., then TAILS classes of rare words, then the end."""

    words: dict[bytes, int]
    counts: np.ndarray  # of each symbol in training: occurrences
    kinds: np.ndarray  # of each symbol: distinct training words in it
    tokens: int  # N
    distinct: int  # V

    @property
    def end(self) -> int:
        return len(self.words) + TAILS

    def symbols(self, words: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
        """Symbols of the words and the end; the rare words."""
        base, get = len(self.words), self.words.get
        out = [get(w, -1) for w in words]
        rare = [w for w, s in zip(words, out) if s < 0]
        symbols = np.array([*out, self.end], np.int32)
        symbols[symbols < 0] = [base + zlib.crc32(w[-ENDING:]) % TAILS for w in rare]
        return symbols, rare

    def mass(self) -> np.ndarray:
        """Occurrences with the pseudo-counts of the add-one estimate: one for each word, and one unknown word in each class."""
        extra = self.kinds.astype(np.float64)
        extra[len(self.words) : self.end] += 1
        return self.counts + extra


def learn_vocabulary(docs: DataFrame, scratch: Scratch, head: int = HEAD) -> tuple[Vocabulary, DataFrame]:
    """The vocabulary, and the table of all training words (word, c)."""
    arrow_batches(docs.sparkSession)
    train = docs.where(~held_out(F.col("doc_id"))).select(F.col("text").cast("binary").alias("text"))
    counts = scratch.put(train.mapInArrow(_counted, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c")))
    known = counts.where("word IS NOT NULL")
    level = F.floor(F.log2("c") * 64).cast("int")
    # At most 64 * 63 levels; the least above which there are no more than ``head`` words is the threshold.
    steps, above = sorted(((r["level"], r["n"]) for r in known.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("n")).collect()), reverse=True), 0
    least = math.inf
    for step, n in steps:
        if above + n > head:
            break
        above, least = above + n, step
    frequent = sorted((bytes(r["word"]), r["c"]) for r in known.where(level >= least).collect()) if least < math.inf else []
    rare = known.where(level < least) if least < math.inf else known
    classes = rare.groupBy((F.crc32(F.when(F.length("word") > ENDING, F.expr(f"substring(word, -{ENDING}, {ENDING})")).otherwise(F.col("word"))) % TAILS).cast("int").alias("cls")).agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("v")).collect()
    docs_seen = counts.where("word IS NULL").agg(F.sum("c")).first()[0] or 0
    size = len(frequent) + TAILS + 1
    c, v = np.zeros(size, np.int64), np.zeros(size, np.int64)
    c[: len(frequent)], v[: len(frequent)] = [x for _, x in frequent], 1
    for r in classes:
        c[len(frequent) + r["cls"]], v[len(frequent) + r["cls"]] = r["c"], r["v"]
    c[-1], v[-1] = docs_seen, docs_seen > 0
    return Vocabulary({w: i for i, (w, _) in enumerate(frequent)}, c, v, int(c.sum()), int(v.sum())), known


ENCODED = "row_id long, doc_id long, held_out boolean, n_tokens long, n_known long, base_head double, share double, symbols binary, rare binary"


def encode(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Per row: its symbols (16-bit), its rare words, and what its frequent words add to the base score and its rare classes to the model's."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = shared.value
        base = len(vocab.words)
        single = np.ones(vocab.end + 1, bool)
        single[base : vocab.end] = False
        log_count = np.where(single, np.log10(vocab.counts + 1.0), 0.0)
        log_class = np.where(single, 0.0, -np.log10(vocab.mass().clip(1)))
        seen = single & (vocab.counts > 0)
        for batch in batches:
            rows = []
            for row_id, doc_id, out, text in zip(*(c.to_pylist() for c in batch.columns)):
                symbols, rare = vocab.symbols((text or b"").lower().split())
                rows.append((row_id, doc_id, out, len(symbols), int(seen[symbols].sum()), float(log_count[symbols].sum()), float(log_class[symbols].sum()), symbols.astype("<u2").tobytes(), b" ".join(rare)))
            columns = list(zip(*rows)) if rows else [[]] * 9
            kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=[f.split()[0] for f in ENCODED.split(", ")])

    arrow_batches(docs.sparkSession)
    asked = docs.select(F.monotonically_increasing_id().alias("row_id"), "doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("binary").alias("text"))
    return asked.mapInArrow(run, ENCODED)


@dataclass
class Model:
    start: np.ndarray  # of a document
    inside: np.ndarray  # of a piece that begins within one
    move: np.ndarray
    emit: np.ndarray  # symbols x states


def begin(vocabulary: Vocabulary, states: int = STATES, seed: int = SEED) -> Model:
    """Sticky states whose emissions are the symbol frequencies, shaken apart."""
    rng = np.random.default_rng(seed)
    mass = vocabulary.mass().clip(1e-3)
    emit = mass[:, None] * rng.uniform(0.6, 1.4, (len(mass), states))
    even = np.full(states, 1 / states)
    return Model(even, even, 0.8 * np.eye(states) + 0.2 / states, emit / emit.sum(0))


def steps_of(sequences: list[np.ndarray], piece: int = PIECE, most: int = STEP_TOKENS) -> Iterator[tuple[list[np.ndarray], np.ndarray]]:
    """The sequences in steps of bounded size, and whether each begins a document; long ones are cut where pieces are cut anyway."""
    held, begins, tokens = [], [], 0
    span = max(piece, most // piece * piece)
    for s in sequences:
        for i in range(0, len(s), span):
            part = s[i : i + span]
            if held and tokens + len(part) > most:
                yield held, np.array(begins)
                held, begins, tokens = [], [], 0
            held.append(part)
            begins.append(i == 0)
            tokens += len(part)
    if held:
        yield held, np.array(begins)


def expected(model: Model, sequences: list[np.ndarray], piece: int = PIECE, begins: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, float]:
    """Expected emissions, moves, document starts and piece starts, and the log likelihood of the pieces. ``begins``: which sequences begin a document (all)."""
    symbols, states = model.emit.shape
    lengths = np.array([len(s) for s in sequences])
    pieces = -(-lengths // piece)
    total = int(pieces.sum())
    x = np.full((total, piece), symbols, np.int64)
    first = np.concatenate([[0], np.cumsum(pieces)[:-1]])
    opening = first if begins is None else first[begins]
    flat = np.concatenate(sequences)
    owner = np.repeat(np.arange(len(sequences)), lengths)
    inner = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    x[first[owner] + inner // piece, inner % piece] = flat
    x = x.T.copy()
    real = x < symbols
    # The padding symbol has probability one everywhere, so it changes nothing.
    emit = np.vstack([model.emit, np.ones(states)]).astype(np.float32)
    move = model.move.astype(np.float32)
    seen = emit[x]
    alpha = np.empty_like(seen)
    scale = np.empty((piece, total), np.float32)
    prior = np.tile(model.inside, (total, 1))
    prior[opening] = model.start
    now = prior.astype(np.float32) * seen[0]
    for t in range(piece):
        if t:
            now = (now @ move) * seen[t]
        scale[t] = now @ np.ones(states, np.float32)
        now = now / scale[t][:, None]
        alpha[t] = now
    moves = np.zeros((states, states))
    beta = np.ones((total, states), np.float32)
    for t in range(piece - 1, 0, -1):
        ahead = seen[t] * beta / scale[t][:, None]
        moves += (alpha[t - 1] * real[t][:, None]).T @ ahead
        alpha[t] *= beta
        beta = ahead @ move.T
    alpha[0] *= beta
    weight = alpha.reshape(-1, states)
    at = x.ravel()
    emissions = np.stack([np.bincount(at, weight[:, k], symbols + 1)[:symbols] for k in range(states)], axis=1)
    begun = np.zeros(total, bool)
    begun[opening] = True
    loglik = float(np.log(scale[real], dtype=np.float64).sum())
    return emissions, moves * model.move, alpha[0][begun].sum(0, dtype=np.float64), alpha[0][~begun].sum(0, dtype=np.float64), loglik


def _sequences(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(b, "<u2").astype(np.int64) for b in column.to_pylist()]


def baum_welch(encoded: DataFrame, vocabulary: Vocabulary, states: int = STATES, rounds: int = ROUNDS) -> tuple[Model, list[float]]:
    """The model after ``rounds``, and the log likelihood of the pieces before each."""
    spark = encoded.sparkSession
    model, trace = begin(vocabulary, states), []
    names = [f"v{k}" for k in range(states)]
    schema = "at int, " + ", ".join(f"{n} double" for n in names)
    train = encoded.where(~F.col("held_out")).select("symbols")
    frequency = vocabulary.mass().clip(1e-3)
    frequency = frequency / frequency.sum()
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(model)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            model, sums = shared.value, None
            for batch in batches:
                if not batch.num_rows:
                    continue
                for sequences, begins in steps_of(_sequences(batch.column(0))):
                    emissions, moves, starts, inside, loglik = expected(model, sequences, begins=begins)
                    rows = np.vstack([emissions, moves, starts, inside, np.full(states, loglik / states)])
                    sums = rows if sums is None else sums + rows
            if sums is not None:
                at = np.flatnonzero(sums.any(1))
                yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), *(pa.array(sums[at, k]) for k in range(states))], names=["at", *names])

        arrow_batches(spark)
        summed = train.mapInArrow(run, schema).groupBy("at").agg(*(F.sum(n).alias(n) for n in names)).toArrow()
        rows = np.zeros((len(frequency) + states + 3, states))
        if summed.num_rows:
            rows[summed.column("at").to_numpy()] = np.stack([summed.column(n).to_numpy() for n in names], axis=1)
        shared.unpersist()
        # Rounded, so that the order in which partitions were summed leaves no trace.
        rows = np.round(rows, 4)
        emissions, moves, starts, inside, loglik = np.split(rows, [len(frequency), len(frequency) + states, len(frequency) + states + 1, len(frequency) + states + 2])
        trace.append(float(loglik.sum()))
        emit = emissions + PRIOR_EMISSION * frequency[:, None]
        model = Model((starts[0] + 1) / (starts[0] + 1).sum(), (inside[0] + 1) / (inside[0] + 1).sum(), (moves + PRIOR_MOVE) / (moves + PRIOR_MOVE).sum(1, keepdims=True), emit / emit.sum(0))
    return model, trace


def log10_likelihoods(model: Model, sequences: list[np.ndarray]) -> np.ndarray:
    """Exact log10 probability of each whole sequence of symbols, by the scaled forward recursion; longest first, so that those at work are a prefix."""
    lengths = np.array([len(s) for s in sequences])
    order = np.argsort(-lengths, kind="stable")
    ends = lengths[order]
    out = np.zeros(len(sequences))
    flat = np.concatenate([sequences[i] for i in order])
    begun = np.cumsum(ends) - ends
    active = len(ends)
    ones = np.ones(model.emit.shape[1])
    now = None
    for t in range(int(ends[0])):
        while ends[active - 1] <= t:
            active -= 1
        seen = model.emit[flat[begun[:active] + t]]
        now = model.start * seen if now is None else (now[:active] @ model.move) * seen
        scale = now @ ones
        now /= scale[:, None]
        out[:active] += np.log10(scale)
    result = np.empty(len(sequences))
    result[order] = out
    return result


def score(docs: DataFrame, scratch: Scratch, states: int = STATES, rounds: int = ROUNDS, head: int = HEAD) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    if head + TAILS + 2 > 1 << 16:
        raise ValueError("symbols are held in 16 bits: head is 64,510 at most")
    vocabulary, known = learn_vocabulary(docs, scratch, head)
    # Rows of like length lie together, so that the recursion's batches have few idle steps.
    encoded = scratch.put(encode(docs, vocabulary).sortWithinPartitions("n_tokens"))
    model, _ = baum_welch(encoded, vocabulary, states, rounds)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                value = log10_likelihoods(shared.value, _sequences(batch.column(1)))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(value)], names=["row_id", "likelihood"])

    arrow_batches(docs.sparkSession)
    likely = encoded.select("row_id", "symbols").mapInArrow(run, "row_id long, likelihood double")
    # Rare words meet their counts; words without one add nothing: log10(0 + 1) = 0.
    rare = encoded.where(F.length("rare") > 0).select("row_id", F.explode(F.split(F.col("rare").cast("string"), " ")).alias("word"))
    met = rare.join(known.select(F.col("word").cast("string").alias("word"), "c"), "word").groupBy("row_id").agg(F.sum(F.log10(F.col("c") + 1.0)).alias("rare_log"), F.count(F.lit(1)).alias("rare_known"))
    rows = encoded.drop("symbols", "rare").join(likely, "row_id").join(met, "row_id", "left")
    rare_log = F.coalesce("rare_log", F.lit(0.0))
    return rows.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(vocabulary.tokens).cast("long").alias("train_tokens"),
        (F.col("base_head") + rare_log - F.col("n_tokens") * math.log10(vocabulary.tokens + vocabulary.distinct + 1)).alias("base_score"),
        (F.col("likelihood") + F.col("share") + rare_log).alias("score"),
    )
