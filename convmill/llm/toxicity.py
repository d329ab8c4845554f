"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

The features are densities: lexicon hits, hits near a second person, capitals, punctuation,
obfuscated spellings. The lexicon is a short list of insults plus the word stems that the labels
show to mark toxic documents, in whatever language. Words, trees and calibration are all learned from ``SAMPLE``
labelled documents at most (the first by a hash of their id); every document is scored whole.

Defined results. Null or empty text: the score of a text without words. No labels, or labels of
one class: every score is the share of that class. Null labels are not learned from; of a
document labelled twice the higher label counts. Null doc_id: scored, held_out false. Repeated
rows: each scored. Very long texts: whole, one in memory at a time. Extra columns are dropped by ``scored`` and kept by ``keep_clean``.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, arrow_batches, fresh

#: The bound of what is learned from, in labelled documents.
SAMPLE = 20_000
LEARNED_STEMS = 256
#: Least standard score of a stem's log odds to enter the lexicon, and lengths of stems in characters.
STEM_Z = 5.0
STEM_LENGTHS = range(4, 9)
#: Words whose kinds a worker keeps; a cache only.
CACHE_WORDS = 300_000
THRESHOLD = 0.7
NEAR = 5

INSULTS = frozenset(
    b"idiot idiots idiotic moron morons moronic imbecile stupid dumb dumbass fool foolish loser losers scum trash garbage filth filthy vermin worthless pathetic disgusting disgrace clown clowns jerk creep freak pig swine rat coward liar bastard bitch asshole crap damn hell shit fuck fucking hate kill die ugly retard retarded nazi whore slut "
    b"dumm dummkopf trottel depp arsch arschloch schwein abschaum hure wichser "
    b"imb\xc3\xa9cile connard connasse salaud salope ordure merde stupide cr\xc3\xa9tin abruti "
    b"idiota est\xc3\xbapido est\xc3\xbapida imb\xc3\xa9cil pendejo cabr\xc3\xb3n basura mierda puta in\xc3\xbatil asqueroso".split()
)
SECOND_PERSON = frozenset(b"you your yours yourself u ur thou du dein deine dich dir ihr euch tu toi ton ta tes te vous votre vos t\xc3\xba usted ustedes tus su".split())

_KEEP = bytes(c if chr(c).isalnum() or c >= 128 else 32 for c in range(256))
_UPPER, _LETTERS = bytes(range(65, 91)), bytes([*range(65, 91), *range(97, 123)])
_DIGITS = bytes(range(48, 58))
_PUNCTUATION = bytes(c for c in range(33, 127) if not chr(c).isalnum())
_PLAIN = bytes.maketrans(b"013457@$!|", b"oieastasil")
_MIXED = re.compile(rb"[a-z]*(?:[a-z][@$*013457!|._-]|[@$013457!|][a-z])[a-z@$*013457!|._-]*")
_SHOUTED = re.compile(rb"\b[A-Z]{3,}\b")
_DRAWN = re.compile(rb"([a-z])\1\1")
_PILED = re.compile(rb"[!?]{2,}")

FEATURES = ("words", "insults", "insult_rate", "kinds", "marks", "mark_rate", "mark_top", "mark_mean", "second_person", "near_you", "near_rate", "capitals", "shouted", "exclaimed", "asked", "punctuation", "piled", "obfuscated", "mixed", "drawn", "digits", "beyond_ascii")


def words_of(text: bytes) -> list[bytes]:
    return text.lower().translate(_KEEP).split()


class Kinds(dict):
    """word -> None, or (is an insult, log odds of its learned stem or 0, is a second person); filled as words are met."""

    def __init__(self, stems: dict[str, float]) -> None:
        super().__init__()
        self.stems = stems
        self.lengths = sorted({len(x) for x in stems}, reverse=True)

    def __missing__(self, word: bytes) -> tuple[bool, float, bool] | None:
        text = word.decode("utf-8", "replace")
        odds = next((self.stems[text[:n]] for n in self.lengths if text[:n] in self.stems), 0.0)
        kind = (word in INSULTS, odds, word in SECOND_PERSON)
        if len(self) > CACHE_WORDS:
            self.clear()
        self[word] = kind if any(kind) else None
        return self[word]


def features(text: bytes | None, kinds: Kinds) -> list[float]:
    """The values named in FEATURES."""
    raw = text or b""
    low, words = raw.lower(), words_of(raw)
    n, chars = max(1, len(words)), max(1, len(raw))
    hits = [(i, *k) for i, k in enumerate(map(kinds.__getitem__, words)) if k]
    rude = [i for i, insult, odds, _ in hits if insult or odds]
    you = [i for i, _, _, second in hits if second]
    insults, odds = sum(h[1] for h in hits), [h[2] for h in hits if h[2]]
    marked, second = len(odds), len(you)
    near = sum(bisect_left(you, i - NEAR) < bisect_right(you, i + NEAR) for i in rude)
    letters = len(raw) - len(raw.translate(None, _LETTERS))
    odd = _MIXED.findall(low)
    plain = [w for w in odd if {w.translate(_PLAIN, b"*._-"), w.rstrip(b"!.*_-").translate(_PLAIN)} & INSULTS and w.strip(b"!.*_-|") not in INSULTS]
    return [
        math.log1p(len(words)),
        math.log1p(insults),
        insults / n,
        float(len({words[i] for i in rude})),
        math.log1p(marked),
        marked / n,
        max(odds, default=0.0),
        sum(odds) / math.sqrt(n),
        second / n,
        math.log1p(near),
        near / n,
        (len(raw) - len(raw.translate(None, _UPPER))) / max(1, letters),
        len(_SHOUTED.findall(raw)) / n,
        raw.count(b"!") / chars,
        raw.count(b"?") / chars,
        (len(raw) - len(raw.translate(None, _PUNCTUATION))) / chars,
        len(_PILED.findall(raw)) / n,
        len(plain) / math.sqrt(n),
        len(odd) / n,
        len(_DRAWN.findall(low)) / n,
        (len(raw) - len(raw.translate(None, _DIGITS))) / chars,
        0.0 if raw.isascii() else 1 - len(raw.decode("utf-8", "replace").encode("ascii", "ignore")) / chars,
    ]


@dataclass
class Trees:
    """Boosted regression trees of one depth on the logistic loss, grown on binned features."""

    rounds: int = 80
    depth: int = 3
    rate: float = 0.15
    bins: int = 48
    least_hessian: float = 3.0
    ridge: float = 1.0
    start: float = 0.0
    splits: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, self.bins + 1)[1:-1])) for f in range(x.shape[1])]
        # Rare features are zero at nearly every quantile; their own non-zero values get edges too.
        edges = [np.unique(np.concatenate([e, np.quantile(c[c > 0], np.linspace(0, 1, 9)[:-1])])) if (c := x[:, f]).max(initial=0) > 0 and (c > 0).any() else e for f, e in enumerate(edges)]
        codes = np.stack([np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(edges)], axis=1)
        width = max(len(e) for e in edges) + 1
        share = y.mean()
        self.start = math.log(share / (1 - share))
        margin = np.full(len(y), self.start)
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-margin))
            grad, hess = p - y, np.maximum(p * (1 - p), 1e-9)
            node, feats, cuts = np.zeros(len(y), np.int64), np.zeros(2**self.depth - 1, np.int64), np.full(2**self.depth - 1, np.inf)
            for level in range(self.depth):
                count, base = 2**level, 2**level - 1
                best = np.zeros(count)
                for f in range(x.shape[1]):
                    at = node * width + codes[:, f]
                    g = np.bincount(at, grad, count * width).reshape(count, width)
                    h = np.bincount(at, hess, count * width).reshape(count, width)
                    gl, hl = g.cumsum(1), h.cumsum(1)
                    gt, ht = gl[:, -1:], hl[:, -1:]
                    gain = gl**2 / (hl + self.ridge) + (gt - gl) ** 2 / (ht - hl + self.ridge) - gt**2 / (ht + self.ridge)
                    gain[(hl < self.least_hessian) | (ht - hl < self.least_hessian)] = 0
                    gain[:, len(edges[f]) :] = 0
                    k = gain.argmax(1)
                    top = gain[np.arange(count), k]
                    for i in np.flatnonzero(top > best + 1e-9):
                        best[i], feats[base + i], cuts[base + i] = top[i], f, edges[f][k[i]]
                node = 2 * node + (x[np.arange(len(y)), feats[base + node]] >= cuts[base + node])
            leaves = 2**self.depth
            value = -self.rate * np.bincount(node, grad, leaves) / (np.bincount(node, hess, leaves) + self.ridge)
            self.splits.append((feats, cuts, value))
            margin += value[node]
        return self

    def margin(self, x: np.ndarray) -> np.ndarray:
        out, row = np.full(len(x), self.start), np.arange(len(x))
        for feats, cuts, value in self.splits:
            node = np.zeros(len(x), np.int64)
            for level in range(self.depth):
                at = 2**level - 1 + node
                node = 2 * node + (x[row, feats[at]] >= cuts[at])
            out += value[node]
        return out


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the non-decreasing fit of y to x: equal x are one point, then adjacent violators are pooled."""
    points, at, count = np.unique(x, return_inverse=True, return_counts=True)
    pools: list[list[float]] = []
    for a, b, n in zip(points.tolist(), (np.bincount(at, y) / count).tolist(), count.tolist()):
        pools.append([b, float(n), a, a])
        while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
            v, w, _, hi = pools.pop()
            p = pools[-1]
            p[0], p[1], p[3] = (p[0] * p[1] + v * w) / (p[1] + w), p[1] + w, hi
    return np.array([e for p in pools for e in (p[2], p[3])]), np.array([p[0] for p in pools for _ in (0, 1)])


@dataclass
class Model:
    """marks: learned stems; trees and calibration knots; without trees, ``constant`` is every score."""

    marks: dict[str, float]
    trees: Trees | None
    knots: tuple[np.ndarray, np.ndarray] | None
    constant: float = 0.0

    def scores(self, texts: list[bytes | None]) -> np.ndarray:
        if self.trees is None:
            return np.full(len(texts), self.constant)
        kinds = self.__dict__.setdefault("_kinds", Kinds(self.marks))
        margin = self.trees.margin(np.array([features(t, kinds) for t in texts]).reshape(len(texts), len(FEATURES)))
        # The calibration is a step function; a little of the raw score keeps the order within a step.
        return np.clip(0.999 * np.interp(margin, *self.knots) + 0.001 / (1 + np.exp(-margin)), 0.0, 1.0)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, most: int = SAMPLE) -> DataFrame:
    """text, y, fold of up to ``most`` labelled documents that are not held out, one row each (of repeated doc_ids the least text); the ids are few by that bound and so are broadcast."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("y"))
    ids = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).join(F.broadcast(ids), "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text")).select("text", F.col("y").cast("int").alias("y"), F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(5)).cast("int").alias("fold"))


def stems_of(text: bytes) -> set[str]:
    return {w[:n] for w in {w.decode("utf-8", "replace") for w in words_of(text)} for n in STEM_LENGTHS if len(w) >= n}


def _stem_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: tuple[Counter, Counter] = (Counter(), Counter())
        for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            counts[y > 0].update(stems_of(text or b""))
        # A stem that no toxic document here has may still be in one elsewhere, so all are counted.
        stems = list(counts[0].keys() | counts[1].keys())
        yield pa.RecordBatch.from_arrays([pa.array(stems, pa.string()), pa.array([counts[0][w] for w in stems], pa.int64()), pa.array([counts[1][w] for w in stems], pa.int64())], names=["stem", "clean", "toxic"])


def learned_stems(sample: DataFrame) -> dict[str, float]:
    """Up to LEARNED_STEMS word stems by the standard score of their log odds to be in toxic documents.

    Of stems that begin one another the better is kept, the longer of equals.
    """
    totals = sample.agg(F.sum(F.when(F.col("y") > 0, 1).otherwise(0)), F.count(F.lit(1))).first()
    toxic, clean = totals[0] or 0, (totals[1] or 0) - (totals[0] or 0)
    a, b = F.col("toxic") + 0.5, F.col("clean") + 0.5
    odds = F.log(a / F.lit(toxic + 1.0)) - F.log(b / F.lit(clean + 1.0))
    counted = sample.select("text", "y").mapInArrow(_stem_counts, "stem string, clean long, toxic long").groupBy("stem").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    best = counted.select("stem", odds.alias("odds"), (odds / F.sqrt(1 / a + 1 / b)).alias("z")).where(F.col("z") >= STEM_Z).orderBy(F.desc(F.round("z", 6)), F.desc(F.length("stem")), "stem").limit(8 * LEARNED_STEMS)
    out: dict[str, float] = {}
    for r in best.collect():
        if len(out) < LEARNED_STEMS and not any(r["stem"].startswith(x) or x.startswith(r["stem"]) for x in out):
            out[r["stem"]] = r["odds"]
    return out


def fit(docs: DataFrame, labels: DataFrame, scratch: Scratch, most: int = SAMPLE) -> Model:
    arrow_batches(docs.sparkSession)
    sample = scratch.put(training_sample(docs, labels, most))
    marks = learned_stems(sample)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = Kinds(marks)
        for batch in batches:
            x = [features(t, kinds) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), batch.column(1), batch.column(2)], names=["x", "y", "fold"])

    # At most SAMPLE rows of numbers come to the driver; sorted, so that a fit doesn't depend on how they were dealt.
    rows = sorted((tuple(r["x"]), r["y"] > 0, r["fold"]) for r in sample.mapInArrow(extract, "x array<double>, y int, fold int").collect())
    y = np.array([r[1] for r in rows], np.float64)
    if not len(y) or y.min() == y.max():
        return Model(marks, None, None, float(y.mean()) if len(y) else 0.0)
    x, fold = np.array([r[0] for r in rows]), np.array([r[2] for r in rows])
    # Calibrated out of fold: trees grown without a fold score it.
    margin = np.empty(len(y))
    for k in range(5):
        out = fold == k
        rest = y[~out]
        if out.any():
            margin[out] = Trees().fit(x[~out], rest).margin(x[out]) if len(rest) and rest.min() < rest.max() else math.log((y.mean() + 1e-9) / (1 - y.mean() + 1e-9))
    return Model(marks, Trees().fit(x, y), isotonic(margin, y))


def scored(docs: DataFrame, model: Model, keep: bool = False) -> DataFrame:
    """doc_id and score, or all columns of ``docs`` and the score as the last, under a name that none of them has, if ``keep``."""
    (raw,) = fresh(docs, "bytes")
    name = fresh(docs, "score")[0] if keep else "score"
    kept = docs if keep else docs.select("doc_id", "text")
    asked = kept.withColumn(raw, F.col("text").cast("binary"))
    if not keep:
        asked = asked.drop("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(raw)
            score = pa.array(model.scores(batch.column(at).to_pylist()), pa.float64())
            names = [n for n in batch.schema.names if n != raw]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), score], names=[*names, name])

    arrow_batches(docs.sparkSession)
    schema = asked.drop(raw).schema.add(name, "double")
    return asked.mapInArrow(run, schema)


def judged(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    return scored(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` without those scored at THRESHOLD or above."""
    marked = scored(docs, model, keep=True)
    score = marked.columns[-1]
    return marked.where(F.col(score) < THRESHOLD).drop(score)
