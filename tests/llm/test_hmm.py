import itertools
import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from convmill.llm import hmm, queries
from convmill.llm.common import Scratch

SF = "/root/testdata/sf0.01"


def small(states=3, symbols=5, seed=4):
    rng = np.random.default_rng(seed)
    norm = lambda a: a / a.sum(-1, keepdims=True)
    start, inside, move = norm(rng.random(states)), norm(rng.random(states)), norm(rng.random((states, states)))
    emit = rng.random((symbols, states))
    return hmm.Model(start, inside, move, emit / emit.sum(0))


def by_paths(m, x, start):
    """Probability and posterior sums over every path of states."""
    states = len(m.start)
    total, emissions, moves, first = 0.0, np.zeros(m.emit.shape), np.zeros((states, states)), np.zeros(states)
    for path in itertools.product(range(states), repeat=len(x)):
        p = start[path[0]] * np.prod([m.emit[s, k] for s, k in zip(x, path)]) * np.prod([m.move[a, b] for a, b in zip(path, path[1:])])
        total += p
        first[path[0]] += p
        for s, k in zip(x, path):
            emissions[s, k] += p
        for a, b in zip(path, path[1:]):
            moves[a, b] += p
    return total, emissions / total, moves / total, first / total


def test_forward_and_expected_counts_equal_sums_over_paths():
    m = small()
    xs = [np.array(x) for x in ([0], [1, 2, 4, 0, 3], [3, 3, 1], [2, 0, 0, 4])]
    paths = [by_paths(m, x, m.start) for x in xs]
    assert np.allclose(hmm.log10_likelihoods(m, xs), [math.log10(p[0]) for p in paths])
    emissions, moves, starts, inside, loglik = hmm.expected(m, xs, piece=8)
    assert np.allclose(emissions, sum(p[1] for p in paths), atol=1e-4) and np.allclose(moves, sum(p[2] for p in paths), atol=1e-4)
    assert np.allclose(starts, sum(p[3] for p in paths), atol=1e-4) and np.allclose(inside, 0) and math.isclose(loglik, sum(math.log(p[0]) for p in paths), rel_tol=1e-5)
    cut = [by_paths(m, xs[1][:3], m.start), by_paths(m, xs[1][3:], m.inside)]
    emissions, _, starts, inside, _ = hmm.expected(m, [xs[1]], piece=3)
    assert np.allclose(emissions, cut[0][1] + cut[1][1], atol=1e-4) and np.allclose(inside, cut[1][3], atol=1e-4)


def test_steps_change_nothing():
    m, rng = small(symbols=9), np.random.default_rng(1)
    xs = [rng.integers(0, 9, n) for n in (1, 700, 3, 40, 8, 300)]
    whole = hmm.expected(m, xs, piece=8)
    parts = [hmm.expected(m, s, 8, b) for s, b in hmm.steps_of(xs, 8, 100)]
    assert len(parts) > 5 and all(np.allclose(w, sum(p[i] for p in parts), rtol=1e-4) for i, w in enumerate(whole))


def brute_base(rows):
    words = lambda t: (t or "").encode().lower().split()
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    c = Counter()
    for i, t in rows:
        if not held(i):
            c.update([*words(t), None])
    n, v = sum(c.values()), len(c)
    return n, [(i, held(i), len(words(t)) + 1, sum(c[w] > 0 for w in [*words(t), None]), sum(math.log10((c[w] + 1) / (n + v + 1)) for w in [*words(t), None])) for i, t in rows]


def same(got, rows):
    n, want = brute_base(rows)
    key = lambda x: (x[0] is None, x[0] or 0, x[2], round(x[4], 6))
    for r, w in zip(sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.base_score) for r in got), key=key), sorted(want, key=key), strict=True):
        assert r[:4] == w[:4] and math.isclose(r[4], w[4], rel_tol=1e-9, abs_tol=1e-9)
    assert {r.train_tokens for r in got} == {n} and all(math.isfinite(r.score) and r.score < 0 for r in got)


def test_query_matches_the_base_and_beats_it_on_held_out_documents(spark):
    rows = queries.op10_hmm(spark, SF).collect()
    same(rows, [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()])
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


@pytest.mark.parametrize("head", [0, 2, 1000])
def test_symbols_cover_the_vocabulary_as_a_distribution(spark, head):
    texts = [(i, " ".join(f"w{j}" for j in range(i % 9))) for i in range(60)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    vocab, known = hmm.learn_vocabulary(docs, Scratch(spark), head)
    assert len(vocab.words) <= head
    counts = {bytes(r.word): r.c for r in known.collect()}
    m = hmm.begin(vocab)
    # Every training word, one unknown word of each class, and the end: all emissions of a state sum to one.
    total = np.zeros(hmm.STATES) + m.emit[vocab.end]
    for w, c in counts.items():
        s = vocab.symbols([w])[0][0]
        total += m.emit[s] * (1 if w in vocab.words else (c + 1) / vocab.mass()[s])
    classes = slice(len(vocab.words), vocab.end)
    total += (m.emit[classes] / vocab.mass()[classes][:, None]).sum(0)
    assert np.allclose(total, 1)
    same(hmm.score(docs, Scratch(spark), rounds=2, head=head).collect(), texts)


def test_likelihood_grows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(300)
    s = Scratch(spark)
    vocab, _ = hmm.learn_vocabulary(docs, s)
    _, trace = hmm.baum_welch(s.put(hmm.encode(docs, vocab)), vocab, rounds=4)
    assert trace == sorted(trace) and trace[-1] > trace[0]


def test_odd_rows(spark):
    rows = [(None, None), (None, "A b"), (1, ""), (2, "É é x a"), (2, "É é x a"), (3, "go on " * 40000), (4, " \t\n"), (9, "a B\x0bc")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("x")).withColumn("word", F.lit(1))
    same(hmm.score(docs, Scratch(spark), rounds=2).collect(), rows)
    assert hmm.score(docs.limit(0), Scratch(spark), rounds=1).count() == 0
    only_held = [(i, "x y") for i in range(40) if zlib.crc32(str(i).encode()) % 7 == 2]
    same(hmm.score(spark.createDataFrame(only_held, "doc_id long, text string"), Scratch(spark), rounds=1).collect(), only_held)


def plain_scores(texts, frequent, rounds):
    """Training and scoring by unscaled sums over all states, document by document."""
    words = {i: (t or "").encode().lower().split() for i, t in texts}
    train = [i for i, _ in texts if zlib.crc32(str(i).encode()) % 7 != 2]
    counts = Counter(w for i in train for w in words[i])
    base, size = len(frequent), len(frequent) + hmm.TAILS + 1
    symbol = lambda w: frequent.get(w, base + zlib.crc32(w[-3:]) % hmm.TAILS)
    c, kinds = np.zeros(size, np.int64), np.zeros(size, np.int64)
    for w, n in counts.items():
        c[symbol(w)] += n
        kinds[symbol(w)] += 1
    c[-1], kinds[-1] = len(train), 1
    mass = c + kinds + np.array([base <= s < size - 1 for s in range(size)])
    model = hmm.begin(hmm.Vocabulary(frequent, c, kinds, int(c.sum()), int(kinds.sum())))
    start, move, emit = model.start, model.move, model.emit
    seq = {i: [*map(symbol, ws), size - 1] for i, ws in words.items()}
    k = len(start)

    def forward(x):
        alpha = [start * emit[x[0]]]
        for s in x[1:]:
            alpha.append(np.array([sum(alpha[-1][i] * move[i][j] for i in range(k)) for j in range(k)]) * emit[s])
        return alpha

    for _ in range(rounds):
        starts, moves, emissions = np.zeros(k), np.zeros((k, k)), np.zeros((size, k))
        for i in train:
            x = seq[i]
            alpha, beta = forward(x), [np.ones(k)]
            for s in x[:0:-1]:
                beta.insert(0, np.array([sum(move[i][j] * emit[s][j] * beta[0][j] for j in range(k)) for i in range(k)]))
            whole = alpha[-1].sum()
            starts += alpha[0] * beta[0] / whole
            for t, s in enumerate(x):
                emissions[s] += alpha[t] * beta[t] / whole
                if t:
                    moves += alpha[t - 1][:, None] * move * (emit[s] * beta[t]) / whole
        share = np.where(mass > 0, mass, 1e-3)
        emit = emissions + hmm.PRIOR_EMISSION * (share / share.sum())[:, None]
        emit /= emit.sum(0)
        start, move = (starts + 1) / (starts + 1).sum(), (moves + 1) / (moves + 1).sum(1, keepdims=True)
    rare = lambda w: 0 if w in frequent else math.log10((counts[w] + 1) / mass[symbol(w)])
    return {i: math.log10(forward(seq[i])[-1].sum()) + sum(map(rare, words[i])) for i, _ in texts}


def test_scores_equal_plain_training_and_plain_sums(spark):
    rng = np.random.default_rng(6)
    texts = [(i, " ".join(rng.choice(["a", "b", "cc", "dd", f"word{i}", "Ending", "spending", "É"], int(rng.integers(0, 9))))) for i in range(40)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    vocab, _ = hmm.learn_vocabulary(docs, Scratch(spark), 4)
    assert 0 < len(vocab.words) <= 4
    want = plain_scores(texts, vocab.words, 3)
    for r in hmm.score(docs, Scratch(spark), rounds=3, head=4).collect():
        assert math.isclose(r.score, want[r.doc_id], rel_tol=1e-3, abs_tol=1e-3)
