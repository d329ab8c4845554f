"""Byte-level BPE by dynamic programming over prefixes.

Every prefix of a byte string has one encoding, and that encoding without its last token is the encoding
of a shorter prefix. So one token a prefix is enough to store: the last one. Token t is the last of a prefix
if it ends there and may follow u, the last token of what is before it. It may if merging the bytes
of u and t gives u and t again. Ids are read off backwards. A longer string keeps its prefix's entries, which makes
appending exact; after an edit the entries are the old ones again once as many in a row agree as the longest token has
bytes, so only the neighbourhood of the edit is worked out anew.

Defined results. Null or empty text: no ids, and the digests of nothing. Bytes that are not UTF-8 count as U+FFFD. Strings of
special tokens are plain text. Repeated rows: one row each. Very long texts and words: time grows in proportion, one text's
entries in memory at a time. Empty table: empty result. Extra columns are dropped.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import cached_property, lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chunks import chunks
from .common import arrow_batches, fresh
from .ragged import Pool, before, picked, spelled

#: Entries that a worker's caches hold before they start anew. Results don't depend on them.
CACHE_WORDS, CACHE_PAIRS = 600_000, 1_000_000
#: Matches of up to so many bytes are worked out many at once, position by position; longer ones one by one.
SHORT = 64
DIGEST = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def read_ranks(path: str) -> dict[bytes, int]:
    """A file of base64 tokens and their ranks."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


@dataclass
class Encoded:
    """A text as its pattern matches, and for each the last token of every byte prefix."""

    matches: list[str] = field(default_factory=list)
    last: list[array] = field(default_factory=list)

    @property
    def text(self) -> str:
        return "".join(self.matches)


class PrefixEncoder:
    """Ids as the ranks give them when the pair of least rank is merged first, leftmost first, in each match of ``pattern``."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.ranks, self.tokens = ranks, {i: t for t, i in ranks.items()}
        self.longest = max(map(len, ranks))
        self.pattern = regex.compile(pattern)
        self.find = ahocorasick.Automaton()
        for token, i in ranks.items():
            self.find.add_word(token.decode("latin-1"), i)
        self.find.make_automaton()
        in_order = [self.tokens.get(i, b"") for i in range(max(self.tokens, default=-1) + 1)]
        self.lengths = np.array(list(map(len, in_order)), np.int64)
        self.starts, self.bytes = before(self.lengths), np.frombuffer(b"".join(in_order), np.uint8)
        self._edges: dict[int, tuple] = {}
        # Pairs that were looked at, and the same as sorted arrays.
        self._pairs: dict[int, bool] = {}
        self._known, self._known_apart = np.zeros(0, np.int64), np.zeros(0, bool)

    def edges(self, token: int) -> tuple[list[tuple[int, int]], list[tuple[int, int]], bool]:
        """What stands at the left and at the right end of a token while its bytes are merged, as (part, when); and whether they end as that token."""
        if token not in self._edges:
            parts = [self.tokens[token][i : i + 1] for i in range(len(self.tokens[token]))]
            left, right, when = [(self.ranks[parts[0]], -1)], [(self.ranks[parts[-1]], -1)], -1
            while len(parts) > 1:
                rank, i = min(((self.ranks.get(a + b, len(self.ranks)), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))))
                if rank == len(self.ranks):
                    break
                when = max(when, rank)
                if i == 0:
                    left.append((rank, when))
                if i == len(parts) - 2:
                    right.append((rank, when))
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
            self._edges[token] = left, right, len(parts) == 1
        return self._edges[token]

    def may_follow(self, u: int, t: int) -> bool:
        """Whether the bytes of ``u`` and ``t`` together are merged to just these: nothing is merged over the border."""
        key = u << 32 | t
        known = self._pairs.get(key)
        if known is not None:
            return known
        if len(self._pairs) >= CACHE_PAIRS:
            self._pairs.clear()
        self._pairs[key] = out = self._apart(u, t)
        return out

    def _apart(self, u: int, t: int) -> bool:
        (_, before, u_whole), (after, _, t_whole) = self.edges(u), self.edges(t)
        if not (u_whole and t_whole):
            return False
        i = j = 0
        while True:
            across = self.ranks.get(self.tokens[before[i][0]] + self.tokens[after[j][0]])
            inner_u = before[i + 1][1] if i + 1 < len(before) else None
            inner_t = after[j + 1][1] if j + 1 < len(after) else None
            # Of equal ranks the one further left is merged first: within u, then over the border, then within t.
            if across is not None and (inner_u is None or across < inner_u) and (inner_t is None or across <= inner_t):
                return False
            if inner_u is None and inner_t is None:
                return True
            if inner_t is None or (inner_u is not None and inner_u <= inner_t):
                i += 1
            else:
                j += 1

    def last_tokens(self, data: bytes, old: bytes = b"", old_last: Sequence[int] = ()) -> array:
        """For each byte the last token of the prefix that ends with it.

        ``old`` with its entries may be a string that shares a beginning or an end with ``data``: what it settles is taken over.
        """
        n, shared = len(data), 0
        if old:
            shared = _common(data, old)
        last = array("i", old_last[:shared]) + array("i", [-1]) * (n - shared)
        if shared == n:
            return last
        # From here on both strings hold the same bytes to their ends.
        tail = n - _common(data[::-1], old[::-1]) if old else n
        tail, shift, agree = max(tail, shared), len(old) - n, 0
        may_follow, done = self.may_follow, shared - 1
        for end, token in self.find.iter(data.decode("latin-1"), max(0, shared - self.longest + 1)):
            if end > done + 1:
                done = end - 1
                # A run of agreeing entries as long as the longest token settles all that follows.
                agree = agree + 1 if done >= tail and last[done] == old_last[done + shift] else 0
                if agree >= self.longest:
                    last[done + 1 :] = array("i", old_last[done + 1 + shift :])
                    return last
            if end < shared or last[end] >= 0:
                continue
            at = end - len(self.tokens[token])
            if (self.edges(token)[2] if at < 0 else may_follow(last[at], token)):
                last[end] = token
        return last

    def ids(self, data: bytes, last: Sequence[int]) -> list[int]:
        """Read off backwards. A match that is a token as a whole is that token."""
        if data in self.ranks:
            return [self.ranks[data]]
        out, at = [], len(data) - 1
        while at >= 0:
            out.append(last[at])
            at -= len(self.tokens[last[at]])
        return out[::-1]

    def ids_of_many(self, words: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of many byte strings, one after the other, and how many each has: the same steps as ``last_tokens`` and ``ids``, for all strings at once."""
        whole = np.fromiter((self.ranks.get(w, -1) for w in words), np.int64, len(words))
        counts, short, long = np.ones(len(words), np.int64), [], []
        for k in np.flatnonzero(whole < 0).tolist():
            (short if len(words[k]) <= SHORT else long).append(k)
        flats = [whole[whole >= 0]]
        starts = before(whole >= 0)
        for some, found in ((short, self._short([words[k] for k in short])), (long, self._long([words[k] for k in long]))):
            counts[some] = found[1]
            starts[some] = sum(map(len, flats)) + before(found[1])
            flats.append(found[0])
        return picked(np.concatenate(flats), starts, counts), counts

    def _long(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        ids = [self.ids(w, self.last_tokens(w)) for w in words]
        return np.array([i for x in ids for i in x], np.int64), np.array(list(map(len, ids)), np.int64)

    def _short(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        if not words:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        data, sizes = b"".join(words), np.array(list(map(len, words)))
        starts = before(sizes)
        first = np.repeat(starts, sizes)
        end, token = self._inside(np.frombuffer(data, np.uint8), np.repeat(starts + sizes, sizes))
        place = (end - first[end]).astype(np.uint8)
        order = np.argsort(place, kind="stable")
        end, token = end[order], token[order]
        at, whole_match = end - self.lengths[token], end - self.lengths[token] < first[end]
        last = np.full(len(data), -1, np.int64)
        stops = np.cumsum(np.bincount(place))
        for a, b in zip([0, *stops], stops):
            e, t, u, whole = end[a:b], token[a:b], at[a:b], whole_match[a:b]
            good = np.empty(b - a, bool)
            single, back = np.unique(t[whole], return_inverse=True)
            good[whole] = np.array([self.edges(x)[2] for x in single.tolist()], bool)[back]
            good[~whole] = self._apart_of(last[u[~whole]] << 32 | t[~whole])
            last[e[good]] = t[good]
        self._settle()
        # Back from the end of each word, a token at a time.
        here, alive, steps = starts + sizes - 1, np.arange(len(words)), []
        while len(alive):
            t = last[here]
            steps.append((alive, t))
            here = here - self.lengths[t]
            more = here >= starts[alive]
            here, alive = here[more], alive[more]
        counts = np.bincount(np.concatenate([w for w, _ in steps]), minlength=len(words))
        flat, ends = np.zeros(int(counts.sum()), np.int64), np.cumsum(counts)
        for k, (w, t) in enumerate(steps):
            flat[ends[w] - 1 - k] = t
        return flat, counts

    def _inside(self, data: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Every token found in ``data`` as (last byte, token), none going on past the stop of the byte that it begins at: all begin at once and go on a byte at a time."""
        nodes, token_of = self.trie
        begin, node, ends, tokens = np.arange(len(data)), np.zeros(len(data), np.int32), [], []
        for k in range(self.longest):
            going = begin + k < stops[begin]
            begin, node = begin[going], node[going]
            node = nodes[node, data[begin + k]]
            going = node != 0
            begin, node = begin[going], node[going]
            if not len(begin):
                break
            token = token_of[node]
            ends.append(begin[token >= 0] + k)
            tokens.append(token[token >= 0])
            going = node < len(nodes)
            begin, node = begin[going], node[going]
        return np.concatenate(ends), np.concatenate(tokens)

    @cached_property
    def trie(self) -> tuple[np.ndarray, np.ndarray]:
        """The next node for each node that goes on and each byte (0: none), and each node's token (-1: none). Nodes that go on come first."""
        prefixes = {t[:k] for t in self.ranks for k in range(1, len(t))}
        number = {p: i for i, p in enumerate([b"", *sorted(prefixes)])}
        inner = len(number)
        for t in self.ranks:
            number.setdefault(t, len(number))
        nodes, token_of = np.zeros((inner, 256), np.int32), np.full(len(number), -1, np.int64)
        for p, i in number.items():
            token_of[i] = self.ranks.get(p, -1)
            if p:
                nodes[number[p[:-1]], p[-1]] = i
        return nodes, token_of

    def _apart_of(self, keys: np.ndarray) -> np.ndarray:
        """``may_follow`` for many pairs: those met before by binary search, the others one by one."""
        at = np.minimum(np.searchsorted(self._known, keys), max(len(self._known) - 1, 0))
        if not len(self._known):
            return np.array([self.may_follow(k >> 32, k & 0xFFFFFFFF) for k in keys.tolist()], bool)
        out, new = self._known_apart[at], self._known[at] != keys
        single, back = np.unique(keys[new], return_inverse=True)
        out[new] = np.array([self.may_follow(k >> 32, k & 0xFFFFFFFF) for k in single.tolist()], bool)[back]
        return out

    def _settle(self) -> None:
        if len(self._pairs) > 1.02 * len(self._known) or len(self._pairs) < len(self._known):
            keys = np.fromiter(self._pairs, np.int64, len(self._pairs))
            order = np.argsort(keys)
            self._known, self._known_apart = keys[order], np.fromiter(self._pairs.values(), bool, len(self._pairs))[order]

    def encode(self, text: str) -> Encoded:
        matches = self.pattern.findall(text)
        return Encoded(matches, [self.last_tokens(m.encode()) for m in matches])

    def all_ids(self, encoded: Encoded) -> list[int]:
        return [i for m, last in zip(encoded.matches, encoded.last) for i in self.ids(m.encode(), last)]

    def decode(self, ids: Sequence[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))

    def decode_flat(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all ids, one after the other, and how many each has."""
        sizes = self.lengths[ids]
        return picked(self.bytes, self.starts[ids], sizes), sizes

    def append(self, encoded: Encoded, more: str) -> Encoded:
        return self.edit(encoded, sum(map(len, encoded.matches)), 0, more)

    def edit(self, encoded: Encoded, at: int, removed: int, inserted: str) -> Encoded:
        """The encoding after ``removed`` code points at ``at`` gave way to ``inserted``: equal to that of the new text.

        A match depends on itself and up to two characters further, so matches that end two or more before the edit stay; those that begin where an
        old one began after the edit are old ones again, with all that follow.
        """
        ends, total = [], 0
        for m in encoded.matches:
            total += len(m)
            ends.append(total)
        at = min(max(at, 0), total)
        removed = min(max(removed, 0), total - at)
        keep = 0
        while keep < len(ends) and ends[keep] + 2 <= at:
            keep += 1
        start = ends[keep - 1] if keep else 0
        old_starts = {e: k + 1 for k, e in enumerate(ends) if e >= at + removed}
        if at + removed == 0:
            old_starts[0] = 0
        rest = "".join(encoded.matches[keep:])
        text = rest[: at - start] + inserted + rest[at - start + removed :]
        grown = len(inserted) - removed
        out, k = Encoded(encoded.matches[:keep], encoded.last[:keep]), keep
        for m in self.pattern.finditer(text):
            before = m.start() + start - grown
            if m.start() + start >= at + len(inserted) and before in old_starts:
                k = old_starts[before]
                return Encoded(out.matches + encoded.matches[k:], out.last + encoded.last[k:])
            # The old match that began at or before this one may share a beginning or an end with it.
            old = encoded.matches[k].encode() if k < len(encoded.matches) else b""
            out.last.append(self.last_tokens(m.group().encode(), old, encoded.last[k] if old else ()))
            out.matches.append(m.group())
            k += 1
        return out


def _common(a: bytes, b: bytes) -> int:
    """Bytes that both begin with, by doubling and halving the compared span."""
    n, at = min(len(a), len(b)), 0
    step = n
    while step:
        if at + step <= n and a[at : at + step] == b[at : at + step]:
            at += step
        else:
            step //= 2
    return at


@lru_cache(maxsize=2)
def _encoder(path: str, pattern: str) -> PrefixEncoder:
    """One a worker, with what it has learnt."""
    return PrefixEncoder(read_ranks(path), pattern)


class _Words:
    """Chunks met by a worker and their ids; chunks go by their text without one space before it."""

    def __init__(self, encoder: PrefixEncoder) -> None:
        self.encoder = encoder
        self.clear()

    def clear(self) -> None:
        self.chunks: dict[str, int] = {}
        self.matches: dict[str, int] = {}
        self.chunk_ids, self.match_ids = Pool("int32"), Pool("int32")

    def learn(self, new: list[str]) -> None:
        # One search over all that end with another character than white space: no match goes from there into the next chunk.
        open_ended = [w for w in new if not w or w[-1].isspace()]
        if open_ended:
            new = [w for w in new if w and not w[-1].isspace()]
        find = self.encoder.pattern.findall
        matches = find(" " + " ".join(new)) if new else []
        for w in open_ended:
            matches += find(" " + w)
        new = new + open_ended
        unknown = list(set(matches).difference(self.matches))
        self.match_ids.add(*self.encoder.ids_of_many([m.encode() for m in unknown]))
        self.matches.update(zip(unknown, range(len(self.matches), len(self.matches) + len(unknown))))
        ids, counts = self.match_ids.of(np.fromiter(map(self.matches.__getitem__, matches), np.int64, len(matches)))
        match_ends = np.cumsum(np.fromiter(map(len, matches), np.int64, len(matches)))
        chunk_ends = np.cumsum(np.fromiter(map(len, new), np.int64, len(new)) + 1)
        ids_before = np.concatenate([[0], np.cumsum(counts)[np.searchsorted(match_ends, chunk_ends)]])
        self.chunk_ids.add(ids, np.diff(ids_before))
        self.chunks.update(zip(new, range(len(self.chunks), len(self.chunks) + len(new))))

    def ids(self, texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and how many each has."""
        cut = [chunks(t.decode("utf-8", "replace")) if t else [] for t in texts]
        # Only the first chunk of a text may stand without a space.
        heads = [c[0] for c in cut if c]
        rest = [w for c in cut for w in c[1:]]
        new = set(rest).difference(self.chunks)
        if len(self.chunks) + len(new) > CACHE_WORDS:
            self.clear()
            new = set(rest)
        if new:
            self.learn(list(new))
        head_matches = [self.encoder.pattern.findall(h) for h in heads]
        head_flat, head_counts = self.encoder.ids_of_many([m.encode() for ms in head_matches for m in ms])
        per_head = np.array([len(ms) for ms in head_matches], np.int64)
        head_ids = np.diff(np.concatenate([[0], np.cumsum(head_counts)])[np.concatenate([[0], np.cumsum(per_head)])])
        rest_flat, rest_counts = self.chunk_ids.of(np.fromiter(map(self.chunks.__getitem__, rest), np.int64, len(rest)))
        # Pieces in order: each text's head, then its other chunks.
        pieces = np.array([len(c) for c in cut], np.int64)
        is_head = np.zeros(int(pieces.sum()), bool)
        is_head[before(pieces)[pieces > 0]] = True
        counts, starts = np.zeros(len(is_head), np.int64), np.zeros(len(is_head), np.int64)
        counts[is_head], counts[~is_head] = head_ids, rest_counts
        starts[is_head], starts[~is_head] = before(head_ids), len(head_flat) + before(rest_counts)
        flat = picked(np.concatenate([head_flat, rest_flat]), starts, counts)
        totals = np.concatenate([[0], np.cumsum(counts)])
        return flat, np.diff(totals[np.concatenate([[0], np.cumsum(pieces)])])


@lru_cache(maxsize=2)
def _words(path: str, pattern: str) -> _Words:
    return _Words(_encoder(path, pattern))


def encoded(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and the ids of its text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _words(path, pattern)
        for batch in batches:
            flat, counts = words.ids(batch.column(1).to_pylist())
            ids = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array(flat, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), ids], names=["doc_id", "ids"])

    return _texts(docs).mapInArrow(run, "doc_id long, ids array<int>")


def decoded(ids: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id`` and the bytes that its ``ids`` stand for; null ids stand for none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path, pattern)
        for batch in batches:
            data = [encoder.decode(x or ()) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(data, pa.binary())], names=["doc_id", "data"])

    return ids.select("doc_id", "ids").mapInArrow(run, "doc_id long, data binary")


def _texts(docs: DataFrame) -> DataFrame:
    arrow_batches(docs.sparkSession)
    return docs.select("doc_id", F.col("text").cast("binary").alias("text"))


def _joined(ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids in decimal with a space after each but the last of a text, and the bytes that each takes."""
    marks = np.full(len(ids), 32, np.uint8)
    marks[np.cumsum(counts)[counts > 0] - 1] = 0
    return spelled(ids, marks)


def _digests(data: np.ndarray, sizes: np.ndarray, counts: np.ndarray) -> list[str]:
    """SHA-256 of each text's share of ``data``: ``sizes`` are bytes per id, ``counts`` ids per text."""
    ends = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(counts)])].tolist()
    return [hashlib.sha256(data[a:b]).hexdigest() for a, b in zip(ends, ends[1:])]


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Digests of every text's ids and of what they decode to, in one pass: ids never leave the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _words(path, pattern)
        for batch in batches:
            ids, counts = words.ids(batch.column(1).to_pylist())
            numbers = _digests(*_joined(ids, counts), counts)
            back = _digests(*words.encoder.decode_flat(ids), counts)
            columns = [batch.column(0).cast(pa.int64()), pa.array(counts, pa.int64()), pa.array(numbers, pa.string()), pa.array(back, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return _texts(docs).mapInArrow(run, DIGEST)


def _stored(e: Encoded) -> dict:
    return {"matches": e.matches, "last": [i for last in e.last for i in last]}


def _restored(matches: Sequence[str], last: Sequence[int]) -> Encoded:
    out, at = Encoded(), 0
    for m in matches:
        n = len(m.encode())
        out.matches.append(m)
        out.last.append(array("i", last[at : at + n]))
        at += n
    return out


STATE = "matches array<string>, last array<int>"


def prefixes(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, the matches of its text, and for each of their bytes the last token of the prefix: what ``edited`` goes on from."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path, pattern)
        for batch in batches:
            rows = [_stored(encoder.encode((x or b"").decode("utf-8", "replace"))) for x in batch.column(1).to_pylist()]
            columns = [batch.column(0).cast(pa.int64()), pa.array([r["matches"] for r in rows], pa.list_(pa.string())), pa.array([r["last"] for r in rows], pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "matches", "last"])

    return _texts(docs).mapInArrow(run, f"doc_id long, {STATE}")


def edited(stored: DataFrame, edits: DataFrame, path: str, pattern: str) -> DataFrame:
    """The stored state after each edit (doc_id, at, removed, inserted, in code points), and its ids; an edit of an unknown document gives no row.

    ``at`` null is the end, so an append is a row with ``inserted`` alone. ``at`` and ``removed`` are held within the text.
    Each row of ``edits`` gives one result, from the state as it is stored.
    """
    state = stored.select("doc_id", "matches", "last")
    key, = fresh(state, "edited", also=edits.columns)
    changes = edits.select(F.col("doc_id").alias(key), F.col("at").cast("long").alias("at"), F.coalesce(F.col("removed").cast("long"), F.lit(0)).alias("removed"), F.coalesce("inserted", F.lit("")).alias("inserted"))
    joined = changes.join(state, F.col(key) == F.col("doc_id")).select("doc_id", "matches", "last", "at", "removed", "inserted")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path, pattern)
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                old = _restored(r["matches"], r["last"])
                at = sum(map(len, old.matches)) if r["at"] is None else r["at"]
                new = encoder.edit(old, at, r["removed"], r["inserted"])
                out.append(_stored(new) | {"ids": encoder.all_ids(new)})
            columns = [batch.column(0), pa.array([r["matches"] for r in out], pa.list_(pa.string())), pa.array([r["last"] for r in out], pa.list_(pa.int32())), pa.array([r["ids"] for r in out], pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "matches", "last", "ids"])

    arrow_batches(stored.sparkSession, rows=128)
    return joined.mapInArrow(run, f"doc_id long, {STATE}, ids array<int>")
