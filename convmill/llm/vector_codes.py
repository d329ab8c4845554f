"""Vector codes by partial-distance search.

Vectors become integers, are cut into equal consecutive parts, and each part is written as the number of its
nearest entry in that position's codebook. Dimensions are added in descending variance of the codebook, and a mask
drops an entry once its sum so far strictly exceeds the best complete distance, so most entries are given up after
a few dimensions. Rounds of assignment and mean make the codebooks; tasks send sums and counts per entry, the driver
holds the codebooks alone, whose size is a parameter's.

Defined results. Rows whose vector is null or holds null or non-finite components are dropped. Repeated rows: one row each; among equal ids the
lesser vectors start the codebooks first, and null ids come last. Fewer vectors than entries: as many entries as vectors. Vectors of other
lengths than the longest, or of one that the parts don't divide, count as followed by zeros. Components beyond the range of a long are held at its
ends; distances are exact and held at the largest long. Empty table: empty result. Extra columns are dropped.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, arrow_batches, salted_join
from .ragged import before

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Dimensions that are added before entries are dropped again.
STEP = 2
#: Vectors held against a codebook at a time.
ROWS = 1024
_MOST = 2**63 - 1


def integers(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, label and components (floor of ``scale`` times each) of the rows that are kept."""
    finite = "embedding IS NOT NULL AND NOT exists(embedding, x -> x IS NULL OR isnan(x) OR abs(x) = double('inf'))"
    return vectors.where(finite).select("vec_id", "label", F.expr(f"transform(embedding, x -> CAST(floor(CAST(x AS DOUBLE) * {scale}D) AS BIGINT))").alias("components"))


@dataclass
class Codebooks:
    """For each part position an array of entries; ``width`` is the number of components in a part."""

    books: list[np.ndarray]
    width: int

    def sha256(self) -> str:
        return hashlib.sha256(",".join(str(x) for book in self.books for x in book.ravel().tolist()).encode()).hexdigest()


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists as rows, followed by zeros up to ``width``."""
    counts = np.asarray(column.value_lengths())
    out = np.zeros((len(column), width), np.int64)
    out[np.repeat(np.arange(len(counts)), counts), np.arange(int(counts.sum())) - np.repeat(before(counts), counts)] = np.asarray(column.flatten())
    return out


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The number of the nearest entry for each row of ``x``, the lower of two as near, and the squared distance."""
    n, d = x.shape
    reach = max(int(np.abs(a.astype(object) if a.size and (a == -_MOST - 1).any() else a).max(initial=0)) for a in (x, book))
    if 4 * reach * reach * max(d, 1) > _MOST:
        # Python's whole numbers, which have no largest one.
        x, book = x.astype(object), book.astype(object)
    spread = [] if not d else np.argsort(-np.array([float(v) for v in book.astype(float).var(axis=0)]), kind="stable")
    x, book = x[:, spread], book[:, spread]
    # All entries over the dimensions of most variance; the one in front is completed first.
    so_far = np.zeros((n, len(book)), x.dtype)
    for k in range(min(STEP, d)):
        so_far += (x[:, k : k + 1] - book[:, k]) ** 2
    guess = so_far.argmin(axis=1)
    best = ((x - book[guess]) ** 2).sum(axis=1) if d else np.zeros(n, x.dtype)
    row, entry = np.nonzero(so_far <= best[:, None])
    total = so_far[row, entry]
    for k in range(STEP, d, STEP):
        total = total + ((x[row, k : k + STEP] - book[entry, k : k + STEP]) ** 2).sum(axis=1)
        left = (total <= best[row]).astype(bool)
        row, entry, total = row[left], entry[left], total[left]
    # What is left is complete, row by row in the order of entries; each row has one at least, its guess.
    starts = np.searchsorted(row, np.arange(n))
    least = np.minimum.reduceat(total, starts) if n else best
    hits = np.flatnonzero((total == least[row]).astype(bool))
    first = hits[np.searchsorted(row[hits], np.arange(n))]
    return entry[first], least


def _assigned(x: np.ndarray, books: Codebooks) -> tuple[np.ndarray, list[list]]:
    """Entry numbers by row and part, and their distances."""
    codes, distances = np.zeros((len(x), len(books.books)), np.int64), []
    for p, book in enumerate(books.books):
        part, found = x[:, p * books.width : (p + 1) * books.width], []
        for a in range(0, len(x), ROWS):
            codes[a : a + ROWS, p], distance = nearest(part[a : a + ROWS], book)
            found += distance.tolist()
        distances.append(found)
    return codes, distances


def first_books(kept: DataFrame, parts: int = PARTS, entries: int = ENTRIES) -> Codebooks:
    """The parts of the vectors with the least ids."""
    longest = kept.agg(F.max(F.size("components"))).first()[0] or 0
    width = -(-longest // parts)
    rows = kept.orderBy(F.col("vec_id").asc_nulls_last(), "components").limit(entries).collect()
    x = np.zeros((len(rows), width * parts), np.int64)
    for i, r in enumerate(rows):
        x[i, : len(r.components)] = r.components
    return Codebooks([x[:, p * width : (p + 1) * width] for p in range(parts)], width)


def better(kept: DataFrame, books: Codebooks) -> Codebooks:
    """One round: every entry becomes the floor of its parts' mean; unused ones stay."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shape = (len(books.books), len(books.books[0]), books.width)
        total, count = np.zeros(shape, object), np.zeros(shape[:2], np.int64)
        for batch in batches:
            x = _matrix(batch.column(0), shape[0] * shape[2])
            codes, _ = _assigned(x, books)
            # Sums of halves of the bits can't overflow within a batch.
            for p in range(shape[0]):
                part, own = x[:, p * shape[2] : (p + 1) * shape[2]], np.zeros((2, shape[1], shape[2]), np.int64)
                np.add.at(own[0], codes[:, p], part >> 32)
                np.add.at(own[1], codes[:, p], part & 0xFFFFFFFF)
                total[p] += own[0].astype(object) * 2**32 + own[1]
                count[p] += np.bincount(codes[:, p], minlength=shape[1])
        p, e = np.nonzero(count)
        at = np.repeat(np.arange(len(p)), shape[2])
        place = np.tile(np.arange(shape[2]), len(p))
        columns = [pa.array(p[at], pa.int32()), pa.array(e[at], pa.int32()), pa.array(place, pa.int32()), pa.array([str(v) for v in total[p[at], e[at], place]], pa.string()), pa.array(count[p[at], e[at]], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["part", "entry", "place", "total", "n"])

    arrow_batches(kept.sparkSession, rows=8192)
    found = kept.select("components").mapInArrow(sums, "part int, entry int, place int, total string, n long")
    means = found.groupBy("part", "entry", "place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"))
    # As many rows as the codebooks have components.
    out = [book.copy() for book in books.books]
    for r in means.collect():
        out[r.part][r.entry, r.place] = int(r.total) // r.n
    return Codebooks(out, books.width)


def fit(kept: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks:
    books = first_books(kept, parts, entries)
    if len(books.books[0]) and books.width:
        for _ in range(rounds):
            books = better(kept, books)
    return books


def encode(kept: DataFrame, books: Codebooks) -> DataFrame:
    """vec_id, label, code (two hexadecimal digits a part) and error (squared distance to the entries that the code names)."""
    digits = max(2, len(f"{max(len(books.books[0]) - 1, 0):x}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, distances = _assigned(_matrix(batch.column(2), len(books.books) * books.width), books)
            spelled = ["".join(f"{c:0{digits}x}" for c in row) for row in codes.tolist()]
            errors = [min(sum(row), _MOST) for row in zip(*distances)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(spelled, pa.string()), pa.array(errors, pa.int64())], names=["vec_id", "label", "code", "error"])

    arrow_batches(kept.sparkSession, rows=8192)
    kinds = dict(kept.dtypes)
    return kept.select("vec_id", "label", "components").mapInArrow(run, f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long")


def decoded(codes: DataFrame, books: Codebooks) -> DataFrame:
    """``codes`` with the components of the entries that each code names."""
    table = F.array(*[F.array(*[F.array(*[F.lit(int(x)) for x in entry]) for entry in book.tolist()]) for book in books.books])
    digits = max(2, len(f"{max(len(books.books[0]) - 1, 0):x}"))
    number = [F.conv(F.substring("code", 1 + digits * p, digits), 16, 10).cast("int") for p in range(len(books.books))]
    return codes.withColumn("components", F.concat(*[F.element_at(F.element_at(table, p + 1), n + 1) for p, n in enumerate(number)]))


def compress(vectors: DataFrame, scratch: Scratch, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """Codes of all vectors that are kept, the error of each and of all with its label, and the digest of the codebooks."""
    kept = scratch.put(integers(vectors, scale))
    books = fit(kept, parts, entries, rounds)
    codes = scratch.put(encode(kept, books).withColumn("key", F.when(F.col("label").isNull(), "null").otherwise(F.concat(F.lit("="), F.col("label").cast("string")))))
    most = F.lit(_MOST).cast("decimal(38,0)")
    by_label = codes.groupBy("key").agg(F.least(F.sum(F.col("error").cast("decimal(28,0)")), most).cast("long").alias("label_error"))
    out = salted_join(codes, by_label, "key", ["vec_id", "code", "error"])
    return out.select("vec_id", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))
