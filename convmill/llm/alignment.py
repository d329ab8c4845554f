"""Cross-tokenizer alignment.

The texts of a whole Arrow batch are laid end to end, and so are their tokens of both vocabularies. The bytes at which tokens
end are counted once for each (bincount): where both end is a cut between groups, and each byte where either ends closes the overlap
of one token of A with one of B. Running sums number the tokens and groups, and their differences at the ends of documents
give each document's results.

How many documents hold an id pair linked is counted in each task first. Counts of the most frequent pairs, HEAD at most, go
to all tasks; the links of rarer pairs are joined to theirs, which are few per pair, since a pair outside the head has at most
1/HEAD of all counts.

Defined results. Texts that are null, empty, or not what their tokens' bytes join to have no tokens: zeros, and '' for the digest. Strings of special tokens are
plain text. Repeated rows count as documents of their own. Very long texts: a batch holds one at least, with all its tokens. Empty table: empty result.
Extra columns are dropped.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chunks import chunks
from .common import Scratch, arrow_batches
from .ragged import Pool, before, spelled

#: Pairs whose counts all tasks hold, at most.
HEAD = 500_000
#: Chunks, and pairs with their counts, that a worker holds before it starts anew or hands them on. Results don't depend on them.
CACHE_CHUNKS, HELD_PAIRS = 400_000, 4_000_000
COUNTS = ("n_a", "n_b", "n_groups", "n_links")


class Vocabularies:
    """Both tokenizers, with the bytes that each id stands for."""

    def __init__(self, path_a: str, path_b: str) -> None:
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_file(path_a), SentencePieceProcessor(model_file=path_b)
        self.a.encode_special_tokens = True
        # Byte-level vocabularies write printable bytes as themselves and the others, in order, as the characters from 256 on.
        printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
        others = [b for b in range(256) if b not in printable]
        byte_of = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}
        in_order = {i: t for t, i in self.a.get_vocab(with_added_tokens=True).items()}
        self.bytes_a = [bytes(byte_of[c] for c in in_order[i]) if i in in_order and all(c in byte_of for c in in_order[i]) else b"" for i in range(max(in_order) + 1)]
        n = self.b.get_piece_size()
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(map(self.b.id_to_piece, range(n)))]
        self.sizes_a, self.sizes_b = (np.array(list(map(len, x)), np.int64) for x in (self.bytes_a, self.bytes_b))
        #: Whether chunks may be encoded apart: no piece goes on into a space.
        self.apart = not any(" " in p.lstrip(b" ").decode("utf-8", "replace") for p in self.bytes_b if p.strip(b" "))
        self.space = self.b.piece_to_id("▁")

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of a space and each text by A, and of each text, before which B puts a space, by B."""
        a = [e.ids for e in self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]
        # A text of nothing has no tokens; as a chunk it is the one space.
        b = [x if t else [self.space] for t, x in zip(texts, self.b.encode(texts, num_threads=1))]
        return a, b

    def joined(self, a: Sequence[int], b: Sequence[int]) -> tuple[bytes, bytes]:
        return b"".join(map(self.bytes_a.__getitem__, a)), b"".join(map(self.bytes_b.__getitem__, b))


class _Chunks:
    """Chunks met by a worker with the ids of both vocabularies, and whether their bytes join to the chunk."""

    def __init__(self, vocabularies: Vocabularies) -> None:
        self.vocabularies = vocabularies
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.a, self.b, self.right = Pool("int32"), Pool("int32"), Pool("bool")

    def learn(self, new: list[str]) -> None:
        for at in range(0, len(new), 4096):
            some = new[at : at + 4096]
            for pool, ids in zip((self.a, self.b), found := self.vocabularies.encode(some)):
                pool.add(np.array([i for x in ids for i in x], np.int32), np.array(list(map(len, ids)), np.int64))
            right = [set(self.vocabularies.joined(a, b)) == {b" " + c.encode()} for c, a, b in zip(some, *found)]
            self.right.add(np.array(right, bool), np.ones(len(some), np.int64))
            self.number.update(zip(some, range(len(self.number), len(self.number) + len(some))))

    def tokens(self, texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of A and B of all texts in turn, how many each text has of them, and the bytes of each with its space; nothing of texts without tokens."""
        cut = [chunks(t.decode("utf-8", "replace")) if t else [] for t in texts]
        if not self.vocabularies.apart:
            cut = [[" ".join(c)] if c else [] for c in cut]
        flat = [w for c in cut for w in c]
        new = set(flat).difference(self.number)
        if len(self.number) + len(new) > CACHE_CHUNKS:
            self.clear()
            new = set(flat)
        self.learn(list(new))
        numbers = np.fromiter(map(self.number.__getitem__, flat), np.int64, len(flat))
        pieces = np.array(list(map(len, cut)), np.int64)
        document = np.repeat(np.arange(len(texts)), pieces)
        wrong = np.bincount(document[~self.right.of(numbers)[0]], minlength=len(texts)) > 0
        # Chunks that are off could only make up for each other in a text as a whole.
        wrong &= [bool(w) and not self._whole(t) for w, t in zip(wrong, texts)]
        kept = ~wrong[document]
        numbers, document = numbers[kept], document[kept]
        out = []
        for pool in (self.a, self.b):
            ids, counts = pool.of(numbers)
            out += [ids, np.bincount(document, weights=counts, minlength=len(texts)).astype(np.int64)]
        sizes = np.bincount(np.repeat(np.arange(len(texts)), out[1]), weights=self.vocabularies.sizes_a[out[0]], minlength=len(texts))
        return out[0], out[2], out[1], out[3], sizes.astype(np.int64)

    def _whole(self, text: bytes) -> bool:
        given = text.decode("utf-8", "replace")
        a, b = self.vocabularies.encode([given])
        return set(self.vocabularies.joined(a[0], b[0])) == {b" " + given.encode()}


@lru_cache(maxsize=2)
def _chunks(path_a: str, path_b: str) -> _Chunks:
    return _Chunks(Vocabularies(path_a, path_b))


class Aligned:
    """The alignment of a batch: see the head of this module. ``links_a`` and ``links_b`` number the tokens of each overlap."""

    def __init__(self, ids_a: np.ndarray, ids_b: np.ndarray, counts_a: np.ndarray, counts_b: np.ndarray, sizes: np.ndarray, sizes_a: np.ndarray, sizes_b: np.ndarray) -> None:
        self.ids_a, self.ids_b = ids_a, ids_b
        self.n_a, self.n_b = counts_a, counts_b
        n, self.ends = int(sizes.sum()), np.cumsum(sizes)
        ends_a, ends_b = np.cumsum(sizes_a[ids_a]), np.cumsum(sizes_b[ids_b])
        at_a, at_b = np.bincount(ends_a, minlength=n + 1), np.bincount(ends_b, minlength=n + 1)
        cut, either = (at_a & at_b).astype(np.int8), at_a | at_b
        stops = np.flatnonzero(either)
        run_a, run_b, groups = (np.cumsum(x[stops]) for x in (at_a, at_b, cut))
        self.links_a, self.links_b = run_a - at_a[stops], run_b - at_b[stops]
        last = np.searchsorted(stops, self.ends, side="right")
        self.n_links, self.n_groups = np.diff(last, prepend=0), np.diff(np.concatenate([[0], groups])[last], prepend=0)
        self.link_document = np.repeat(np.arange(len(sizes)), self.n_links)
        self._cut, self._ends_a, self._ends_b = cut, ends_a, ends_b
        # Tokens of A and B that end within the groups up to each cut.
        self._at_cut = [x[cut[stops] > 0] for x in (run_a, run_b)]

    def digests(self) -> list[str]:
        """SHA-256 of each document's groups: ids of A, a bar, ids of B, and a semicolon between groups."""
        places, marks = [], []
        for side, (ends, counts) in enumerate(((self._ends_a, self.n_a), (self._ends_b, self.n_b))):
            closes = self._cut[ends] > 0
            group = np.cumsum(closes) - closes
            mark = np.where(closes, 124 if side == 0 else 59, 44).astype(np.uint8)
            if side == 1:
                mark[np.cumsum(counts)[counts > 0] - 1] = 0
            # Before a token of A stand the B of earlier groups; before one of B the A of its group as well.
            others = self._at_cut[1 - side]
            earlier = np.concatenate([[0], others])[group] if side == 0 else others[group]
            places.append(np.arange(len(ends)) + earlier)
            marks.append(mark)
        ids, signs = np.zeros(len(self.ids_a) + len(self.ids_b), np.int64), np.zeros(len(self.ids_a) + len(self.ids_b), np.uint8)
        for place, own, mark in zip(places, (self.ids_a, self.ids_b), marks):
            ids[place], signs[place] = own, mark
        data, sizes = spelled(ids, signs)
        stops = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(self.n_a + self.n_b)])].tolist()
        return [hashlib.sha256(data[a:b]).hexdigest() if b > a else "" for a, b in zip(stops, stops[1:])]

    def groups(self) -> list[list[tuple[list[int], list[int]]]]:
        """Each document's groups as ids of A and ids of B."""
        out: list[list[tuple[list[int], list[int]]]] = []
        at_a, at_b = (np.concatenate([[0], x]).tolist() for x in self._at_cut)
        k = 0
        for n in self.n_groups.tolist():
            out.append([(self.ids_a[at_a[g] : at_a[g + 1]].tolist(), self.ids_b[at_b[g] : at_b[g + 1]].tolist()) for g in range(k, k + n)])
            k += n
        return out

    def pairs(self, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The distinct id pairs of each document as (id of A times ``width`` plus id of B), how many links each has, and how many pairs a document has."""
        pair = self.ids_a[self.links_a].astype(np.int64) * width + self.ids_b[self.links_b]
        base = int(pair.max(initial=0)) + 1
        key = np.sort(self.link_document * base + pair)
        first = np.flatnonzero(np.diff(key, prepend=-1))
        document, pair = np.divmod(key[first], base)
        return pair, np.diff(first, append=len(key)), np.bincount(document, minlength=len(self.n_a))


def _aligned(words: _Chunks, texts: Sequence[bytes]) -> Aligned:
    ids_a, ids_b, counts_a, counts_b, sizes = words.tokens(texts)
    return Aligned(ids_a, ids_b, counts_a, counts_b, sizes, words.vocabularies.sizes_a, words.vocabularies.sizes_b)


def _lists(flat: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array(flat, kind))


def _texts(docs: DataFrame) -> DataFrame:
    # What is counted takes some forty times the bytes of a batch.
    arrow_batches(docs.sparkSession, mb=4)
    return docs.select("doc_id", F.col("text").cast("binary").alias("text"))


def grouped(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """doc_id and its groups: the ids of A and of B between one common boundary and the next."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _chunks(path_a, path_b)
        kind = pa.list_(pa.struct([("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))]))
        for batch in batches:
            groups = _aligned(words, batch.column(1).to_pylist()).groups()
            rows = [[{"a": a, "b": b} for a, b in document] for document in groups]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(rows, kind)], names=["doc_id", "groups"])

    return _texts(docs).mapInArrow(run, "doc_id long, groups array<struct<a: array<int>, b: array<int>>>")


def linked(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Each document's counts and digest, its distinct id pairs and how many links each has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _chunks(path_a, path_b)
        width = len(words.vocabularies.bytes_b)
        for batch in batches:
            found = _aligned(words, batch.column(1).to_pylist())
            pair, links, per_document = found.pairs(width)
            columns = [pa.array(getattr(found, c), pa.int64()) for c in COUNTS]
            columns += [pa.array(found.digests(), pa.string()), _lists(pair, per_document, pa.int64()), _lists(links, per_document, pa.int32())]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), *columns], names=["doc_id", *COUNTS, "groups_sha256", "pairs", "links"])

    return _texts(docs).mapInArrow(run, f"doc_id long, {', '.join(f'{c} long' for c in COUNTS)}, groups_sha256 string, pairs array<long>, links array<int>")


def pair_counts(rows: DataFrame, width: int) -> DataFrame:
    """For each id pair how many of ``rows`` hold it, and whether that is the most of all pairs with its id of A."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            # A document's pairs are distinct.
            pairs = np.concatenate([pairs, np.asarray(batch.column(0).flatten())])
            counts = np.concatenate([counts, np.ones(len(pairs) - len(counts), np.int64)])
            if len(pairs) > HELD_PAIRS:
                pairs, counts = _summed(pairs, counts)
                # Only where most are distinct is adding up here of little use.
                if len(pairs) > HELD_PAIRS // 2:
                    yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(counts)], names=["pair", "n"])
                    pairs, counts = pairs[:0], counts[:0]
        pairs, counts = _summed(pairs, counts)
        yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(counts)], names=["pair", "n"])

    counts = rows.select("pairs").mapInArrow(count, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    return counts.withColumn("a", F.expr(f"pair div {width}"))


def _summed(pairs: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    distinct, back = np.unique(pairs, return_inverse=True)
    return distinct, np.bincount(back, weights=counts, minlength=len(distinct)).astype(np.int64)


def head_count(counts: DataFrame, most: int = HEAD) -> int:
    """The least count such that no more than ``most`` pairs have it or a larger one."""
    # Counts in 16 steps to the doubling: some thousand rows at most, whatever the input.
    step = F.floor(F.log2("n") * 16)
    rows = counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("pairs"), F.min("n").alias("n")).orderBy(F.desc("step")).collect()
    least, total = 2**62, 0
    for r in rows:
        total += r.pairs
        if total > most:
            break
        least = r.n
    return least


def align(docs: DataFrame, path_a: str, path_b: str, scratch: Scratch, head: int = HEAD) -> DataFrame:
    """Per document its tokens, groups and links, the links whose count is the highest of their id of A, and the sum of the counts of all links."""
    from sentencepiece import SentencePieceProcessor

    width = SentencePieceProcessor(model_file=path_b).get_piece_size()
    rows = scratch.put(linked(docs, path_a, path_b).withColumn("row", F.monotonically_increasing_id()))
    counts = scratch.put(pair_counts(rows, width))
    # One row for each id of A at most.
    highest = counts.groupBy("a").agg(F.max("n").alias("most"))
    counts = scratch.put(counts.join(F.broadcast(highest), "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best")))
    least = head_count(counts, head)
    frequent = counts.where(F.col("n") >= least).toArrow().sort_by("pair")
    sent = docs.sparkSession.sparkContext.broadcast(tuple(frequent.column(c).to_numpy() for c in ("pair", "n", "best")))
    names = ["row", "doc_id", *COUNTS, "groups_sha256"]

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, n, best = sent.value
        for batch in batches:
            pair, links = (np.asarray(batch.column(c).flatten()).astype(np.int64) for c in ("pairs", "links"))
            document = np.repeat(np.arange(len(batch)), np.asarray(batch.column("pairs").value_lengths()))
            at = np.minimum(np.searchsorted(known, pair), max(len(known) - 1, 0))
            hit = known[at] == pair if len(known) else np.zeros(len(pair), bool)
            best_links, sums = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
            np.add.at(best_links, document[hit], links[hit] * best[at[hit]])
            np.add.at(sums, document[hit], links[hit] * n[at[hit]])
            rare = np.bincount(document[~hit], minlength=len(batch))
            columns = [pa.array(best_links), pa.array(sums), _lists(pair[~hit], rare, pa.int64()), _lists(links[~hit], rare, pa.int64())]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *columns], names=[*names, "n_best", "count_sum", "pairs", "links"])

    schema = f"row long, doc_id long, {', '.join(f'{c} long' for c in COUNTS)}, groups_sha256 string, n_best long, count_sum long, pairs array<long>, links array<long>"
    looked_up = scratch.put(rows.mapInArrow(look_up, schema))
    scratch.drop(rows)
    rare = looked_up.select("row", F.explode(F.arrays_zip("pairs", "links")).alias("z")).select("row", "z.pairs", "z.links")
    added = rare.join(counts.where(F.col("n") < least), F.col("pairs") == F.col("pair")).groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("more_best"), F.sum(F.col("links") * F.col("n")).alias("more"))
    out = looked_up.drop("pairs", "links").join(added, "row", "left")
    return out.select("doc_id", *COUNTS, (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"), (F.col("count_sum") + F.coalesce("more", F.lit(0))).alias("count_sum"), "groups_sha256")
