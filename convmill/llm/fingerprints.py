"""Document fingerprints by prefix polynomial hashes.

``PrefixHash`` holds the modular prefix sums of c[j] * B^j under two bases, so any two spans are compared in
constant time and the longest common extension of two positions, to the right or to the left, is found by binary search.

A fingerprint is the number of code points, the hash of the whole under both bases, and the hashes of spans that cover the text: they end where the
hash of the last WINDOW code points, read from the prefix sums, is 0 modulo SPAN, so equal passages have equal spans wherever they lie.

The likeness of two documents is the share of the longer one in passages that both have, at any offsets. Candidates are both beginnings, both
ends and equal spans; each is extended both ways by the prefix arrays to the last equal code point, and what was counted once in either text isn't again.
``estimate`` reads the share from two stored fingerprints alone, to within the spans at the passages' ends.

Defined results. Null text: as empty. Empty texts are equal to each other: likeness 1. Order of documents:
doc_id ascending, nulls first, then a hash of the text; a lone document is its own next.
Repeated rows: each stays, the next one being its copy. Very long texts: whole; sums are built in blocks of BLOCK code points and held in 16 bytes a code point. Extra columns are dropped.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections import Counter, defaultdict, deque
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_batches

P = (1 << 31) - 1
BASES = (1_046_527_193, 1_734_212_909)
BLOCK = 1 << 20
#: Code points whose hash ends a span, mean length of a span, its least and greatest length, and hex digits kept of its hash.
WINDOW, SPAN, LEAST, MOST, DIGITS = 8, 32, 8, 1024, 6


@cache
def powers(base: int, n: int = BLOCK + 1) -> np.ndarray:
    out = np.ones(1, np.uint64)
    while len(out) < n:
        out = np.concatenate([out, out * np.uint64(pow(base, len(out), P)) % np.uint64(P)])
    return out[:n]


def codes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def block_sums(codes: np.ndarray, base: int) -> np.ndarray:
    """Running sums of c[j] B^j over one block, each term below 2^32 and congruent modulo P."""
    x = (codes + np.uint32(1)) * powers(base)[: len(codes)]
    return np.cumsum((x & np.uint64(P)) + (x >> np.uint64(31)))


def prefix_at(codes: np.ndarray, base: int, lengths: np.ndarray) -> np.ndarray:
    """Hashes of the prefixes of these ascending lengths, block by block."""
    out, total, lead = np.zeros(len(lengths), np.uint64), 0, 1
    for start in range(0, len(codes), BLOCK):
        sums = block_sums(codes[start : start + BLOCK], base)
        a, b = np.searchsorted(lengths, [start, start + len(sums)], side="right")
        if b > a:
            out[a:b] = (np.uint64(total) + sums[lengths[a:b] - start - 1] % np.uint64(P) * np.uint64(lead)) % np.uint64(P)
        total = (total + int(sums[-1]) * lead) % P
        lead = lead * pow(base, BLOCK, P) % P
    return out


def shifts(base: int, at: np.ndarray) -> np.ndarray:
    """B^-i for each i: the factor that moves a span's hash to position 0."""
    inverse = pow(base, P - 2, P)
    low = powers(inverse)[at % BLOCK]
    if len(at) and at.max() >= BLOCK:
        block, which = np.unique(at // BLOCK, return_inverse=True)
        high = np.array([pow(inverse, int(i) * BLOCK, P) for i in block], np.uint64)
        low = low * high[which] % np.uint64(P)
    return low


def power(base: int, i: int) -> int:
    return int(powers(base)[i]) if i <= BLOCK else pow(base, i, P)


class PrefixHash:
    """Modular prefix arrays of one text, for span equality and common extensions."""

    def __init__(self, text: str) -> None:
        self.codes = codes_of(text)
        self.n = len(self.codes)
        every = np.arange(self.n + 1)
        self.sums = [prefix_at(self.codes, b, every) for b in BASES]

    def span(self, i: int, j: int) -> tuple[int, int]:
        """The hash of code points i to j, whatever their position."""
        return tuple((int(s[j]) - int(s[i])) * pow(b, (P - 1 - i % (P - 1)), P) % P for s, b in zip(self.sums, BASES))

    def same(self, i: int, other: PrefixHash, j: int, n: int) -> bool:
        """Whether the spans of n code points from i and j are equal; each is moved to the other's place rather than both to 0."""
        for x, y, b in zip(self.sums, other.sums, BASES):
            if (int(x[i + n]) - int(x[i])) * power(b, j) % P != (int(y[j + n]) - int(y[j])) * power(b, i) % P:
                return False
        return True

    def extension(self, i: int, other: PrefixHash, j: int, most: int | None = None) -> int:
        """How far the texts agree from i and j on, up to ``most``."""
        low, high = 0, min(self.n - i, other.n - j, *([] if most is None else [most]))
        while low < high:
            mid = (low + high + 1) // 2
            low, high = (mid, high) if self.same(i, other, j, mid) else (low, mid - 1)
        return low

    def extension_left(self, i: int, other: PrefixHash, j: int, most: int | None = None) -> int:
        """How far the texts agree before i and j, up to ``most``."""
        low, high = 0, min(i, j, *([] if most is None else [most]))
        while low < high:
            mid = (low + high + 1) // 2
            low, high = (mid, high) if self.same(i - mid, other, j - mid, mid) else (low, mid - 1)
        return low

    def ends(self) -> np.ndarray:
        """Where the spans of the text begin and end: 0, the places where a window's hash is 0 modulo SPAN, and n; LEAST to MOST apart but at the end."""
        found = []
        for start in range(0, self.n - WINDOW + 1, BLOCK):
            at = np.arange(start, min(start + BLOCK, self.n - WINDOW + 1))
            here = (self.sums[0][at + WINDOW] + np.uint64(P) - self.sums[0][at]) % np.uint64(P) * shifts(BASES[0], at) % np.uint64(P)
            found.append(at[here % np.uint64(SPAN) == 0] + WINDOW)
        places = np.concatenate([*found, [self.n]]) if found else np.array([self.n])
        out, now = [0], 0
        while now < self.n:
            k = int(np.searchsorted(places, now + LEAST))
            after = int(places[k]) if k < len(places) else self.n
            now = min(after, now + MOST)
            out.append(now)
        return np.array(out)

    def marks(self) -> tuple[np.ndarray, np.ndarray]:
        """The ends of the spans, and the spans' hashes."""
        ends = self.ends()
        s, at = self.sums[0][ends], ends[:-1]
        return ends, (s[1:] + np.uint64(P) - s[:-1]) % np.uint64(P) * shifts(BASES[0], at) % np.uint64(P)


class Fingerprint:
    """A text's prefix arrays with its spans, and ``mark``: ``n:whole:spans``, the hashes in hex but for n; a span is three digits of its length less 1 and DIGITS of its hash."""

    def __init__(self, text: str) -> None:
        self.hash = PrefixHash(text)
        self.n = self.hash.n
        self.ends, spans = self.hash.marks()
        self.spans = spans.tolist()
        mask = (1 << 4 * DIGITS) - 1
        shown = "".join([f"{n - 1:03x}{x & mask:0{DIGITS}x}" for n, x in zip(np.diff(self.ends).tolist(), self.spans)])
        self.mark = f"{self.n}:{int(self.hash.sums[0][-1]):08x}{int(self.hash.sums[1][-1]):08x}:{shown}"

    def shared(self, other: Fingerprint) -> int:
        """Code points in passages that both texts have; none is counted twice in either.

        The common beginning and end count first. Then, from left to right, each span that the other text has in a free place is extended both ways
        as far as the texts agree and are free: in the place that goes on from the last passage if it is there, else in the first free one.
        """
        a, b = self.hash, other.hash
        if not a.n or not b.n:
            return 0
        head = a.extension(0, b, 0)
        tail = a.extension_left(a.n, b, b.n, min(a.n, b.n) - head)
        total, stop, now = head + tail, a.n - tail, head
        # Taken parts of the other text, in order.
        starts, stops = [0, b.n - tail], [head, b.n]

        def gap(j: int) -> tuple[int, int]:
            """The bounds of the free part around j; j lies outside of them where it is taken."""
            k = bisect_right(starts, j)
            return stops[k - 1], starts[k] if k < len(starts) else b.n

        at: dict[int, deque[int]] = defaultdict(deque)
        begins = dict(zip(other.ends.tolist(), other.spans))
        for j, x in begins.items():
            at[x].append(j)
        shift = 0
        for x, i, end in zip(self.spans, self.ends.tolist(), self.ends[1:].tolist()):
            if i < now or end > stop or x not in at:
                continue
            places, n = at[x], end - i

            def fits(j: int) -> bool:
                low, high = gap(j)
                return low <= j and j + n <= high

            if begins.get(i + shift) == x and fits(i + shift):
                j = i + shift
            else:
                # What is taken stays so: places are looked at until one is free, each once.
                while places and not fits(places[0]):
                    places.popleft()
                if not places:
                    continue
                j = places[0]
            if not a.same(i, b, j, n):
                continue
            low, high = gap(j)
            left = a.extension_left(i, b, j, min(i - now, j - low))
            right = a.extension(i, b, j, min(stop - i, high - j))
            k = bisect_right(starts, j - left)
            starts.insert(k, j - left)
            stops.insert(k, j + right)
            total += left + right
            now, shift = i + right, j - i
        return total

    def likeness(self, other: Fingerprint) -> float:
        """1 for equal texts, else the share of the longer text that is shared, below 1."""
        if self.mark == other.mark:
            return 1.0
        longer = max(self.n, other.n)
        return min(self.shared(other), longer - 1) / longer


def fingerprint(text: str) -> str:
    return Fingerprint(text).mark


def estimate(a: str, b: str) -> float:
    """The share of the longer text in spans that both fingerprints have, below 1 unless they are equal."""
    if a == b:
        return 1.0
    (n, _, x), (m, _, y) = a.split(":"), b.split(":")
    width = 3 + DIGITS
    spans = [Counter(s[i : i + width] for i in range(0, len(s), width)) for s in (x, y)]
    longer = max(int(n), int(m))
    return min(sum(k * (int(s[:3], 16) + 1) for s, k in (spans[0] & spans[1]).items()), longer - 1) / longer


def _rank(value: Column, bounds: list[int]) -> Column:
    """How many of the ascending bounds are at or below the value, by binary search."""
    table, steps = F.array(*(F.lit(b).cast("long") for b in bounds)), max(1, len(bounds).bit_length())
    begin = F.struct(F.lit(0).alias("lo"), F.lit(len(bounds)).alias("hi"))

    def halve(s: Column, _: Column) -> Column:
        mid = F.floor((s["lo"] + s["hi"]) / 2).cast("int")
        right = F.get(table, mid) <= value
        done = s["lo"] >= s["hi"]
        return F.struct(F.when(done | ~right, s["lo"]).otherwise(mid + 1).alias("lo"), F.when(done | right, s["hi"]).otherwise(mid).alias("hi"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), begin, halve, lambda s: s["lo"])


RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def with_next(docs: DataFrame, per_partition: int = 4) -> DataFrame:
    """bucket, doc_id, text, carry: documents dealt by ranges of doc_id, so that the texts move once.

    Within a bucket rows are sorted; the first row of each bucket is repeated at the end of the
    one before (``carry``), and that of the first bucket at the end of the last. Bounds and first
    ids take two passes over doc_id alone; both lists have ``per_partition`` times the shuffle partitions at most.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = F.coalesce("doc_id", F.lit(-(1 << 63)))
    cuts = [i / (parts * per_partition) for i in range(1, parts * per_partition)]
    bounds = docs.agg(F.percentile_approx(key, F.array(*map(F.lit, cuts)), F.lit(10 * len(cuts) + 100)).alias("b")).first()["b"] or []
    bucketed = docs.select("doc_id", "text").withColumn("bucket", _rank(key, sorted(set(bounds))) if bounds else F.lit(0))
    in_turn = Window.orderBy("bucket")
    firsts = bucketed.groupBy("bucket").agg(F.min(key).alias("first_key")).select("first_key", F.coalesce(F.lag("bucket").over(in_turn), F.max("bucket").over(Window.partitionBy())).alias("before"))
    here = F.array(F.struct(F.col("bucket").alias("bucket"), F.lit(False).alias("carry")))
    again = F.array(F.struct(F.col("before").alias("bucket"), F.lit(True).alias("carry")))
    dealt = bucketed.join(F.broadcast(firsts), key == F.col("first_key"), "left").select("doc_id", "text", F.explode(F.when(F.col("before").isNull(), here).otherwise(F.concat(here, again))).alias("at"))
    dealt = dealt.select(F.col("at.bucket").alias("bucket"), "doc_id", F.coalesce("text", F.lit("")).alias("text"), F.col("at.carry").alias("carry"))
    return dealt.repartition(parts, "bucket").sortWithinPartitions("bucket", "carry", F.asc_nulls_first("doc_id"), F.xxhash64("text"), "text")


def compare(docs: DataFrame) -> DataFrame:
    """The columns of RESULT for every document, its edited text and the next document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        names = [f.split()[0] for f in RESULT.split(", ")]
        now, held = None, None
        for batch in batches:
            rows = []
            for bucket, doc_id, text, carry in zip(*(c.to_pylist() for c in batch.columns)):
                if carry and held is None:
                    continue
                mark = held[2] if held and held[1] == text else Fingerprint(text)
                if held is not None and bucket == now:
                    own_id, own, own_mark = held
                    cut = len(own) // 2
                    edited = own[: len(own) - cut] + text[:cut]
                    edited_mark = own_mark if edited == own else mark if edited == text else Fingerprint(edited)
                    rows.append((own_id, len(own), hashlib.sha256(edited.encode()).hexdigest(), own_mark.mark, edited_mark.mark, own_mark.likeness(edited_mark), own_mark.likeness(mark)))
                now, held = bucket, None if carry else (doc_id, text, mark)
            columns = list(zip(*rows)) if rows else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    arrow_batches(docs.sparkSession)
    return with_next(docs).mapInArrow(run, RESULT)
