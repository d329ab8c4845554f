"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints within the radius have a point half way between them, so if each emits every
variant within half the radius, they meet in a shared variant. Over 64 bits and radius 4 that is 2081
variants each. By pigeonhole one half of the bits differs in 2 or fewer, so with ``blocks=2``
(the default) each half emits its ball of radius 1 instead, 66 variants in all; pairs that meet are then verified over all bits. Nothing is lost.

A bucket of over ``PAIRS_MOST`` fingerprints is not paired: its members, once each, emit the
whole ball. All who meet in one variant of that are within twice half the radius of each other, so each is
linked to the least of them: exact, and linear in the members.

Defined results. Null, empty or wordless text: fingerprint 0. Empty table: empty result. Repeated
rows: each stays, in one component. A component without any doc_id: component_id null. Very long texts: whole. Extra columns are dropped.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from .common import Scratch, arrow_batches, salted_join
from .components import components

SEED = 42
WORDS = 4
RADIUS = 4
#: Buckets of more fingerprints than this take the exact way for large groups.
PAIRS_MOST = 64


def simhash(text: bytes | None, words: int = WORDS) -> int:
    """Bits set in over half the shingles' XXH64; 0 without words."""
    found = (text or b"").lower().split()
    if not found:
        return 0
    joined = b" ".join(found)
    if len(found) <= words:
        return xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    count = len(found) - words + 1
    hashes = np.fromiter((xxh64_intdigest(joined[s:e], SEED) for s, e in zip(starts[:count].tolist(), ends[words - 1 :].tolist())), np.uint64, count)
    total = np.zeros(64, np.int64)
    for i in range(0, count, 1 << 16):
        bits = np.unpackbits(hashes[i : i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        whole = len(bits) // 255 * 255
        total += bits[:whole].reshape(-1, 255, 64).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64) + bits[whole:].sum(axis=0, dtype=np.int64)
    return int(np.packbits(total * 2 > count, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, fp (the 64 bits as a signed long) for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = np.array([simhash(t, words) for t in batch.column(1).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(marks)], names=["doc_id", "fp"])

    arrow_batches(docs.sparkSession)
    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(run, "doc_id long, fp long")


def ball(bits: int, radius: int, offset: int = 0) -> list[int]:
    """All masks of up to ``radius`` of the bits from ``offset`` on, as signed 64-bit numbers."""
    masks = [sum(1 << offset + b for b in some) for k in range(radius + 1) for some in combinations(range(bits), k)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def variants(prints: DataFrame, radius: int, blocks: int) -> DataFrame:
    """fp, block, key: for each block of the bits, its value in every variant within half of what that block may differ by."""
    width = 64 // blocks
    half = -(-(radius // blocks) // 2)
    cut = lambda x, i: F.shiftrightunsigned(x, i * width).bitwiseAND(F.lit((1 << width) - 1)) if blocks > 1 else x

    def of(i: int) -> Column:
        masks = F.array(*(F.lit(m).cast("long") for m in ball(width, half, i * width)))
        return F.transform(masks, lambda m: F.struct(F.lit(i).alias("block"), cut(F.col("fp").bitwiseXOR(m), i).alias("key")))

    return prints.select("fp", F.explode(F.flatten(F.array(*(of(i) for i in range(blocks))))).alias("v")).select("fp", "v.*")


def _sorted(v: DataFrame) -> DataFrame:
    parts = int(v.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return v.repartition(parts, "block", "key").sortWithinPartitions("block", "key", "fp").select("block", "key", "fp")


def _unique(pairs: list[np.ndarray]) -> np.ndarray:
    return np.unique(np.concatenate(pairs), axis=0) if pairs else np.empty((0, 2), np.int64)


def _runs(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(run number, fp, too long) of whole runs of equal (block, key); the rows of a run of over ``most`` come as they are read."""
    held = [np.empty(0, np.int64)] * 3
    flooded = None
    for batch in batches:
        block, key, fp = (np.concatenate([h, c.to_numpy(zero_copy_only=False).astype(np.int64)]) for h, c in zip(held, batch.columns))
        if not len(fp):
            continue
        new = np.concatenate([[True], (block[1:] != block[:-1]) | (key[1:] != key[:-1])])
        run = np.cumsum(new) - 1
        size = np.bincount(run)
        long = size[run] > most
        if flooded == (int(block[0]), int(key[0])):
            long |= run == 0
        last = run == run[-1]
        # The last run may go on: it waits, unless it is already known to be too long.
        ready = ~last | long
        flooded = (int(block[-1]), int(key[-1])) if long[-1] else None
        yield run[ready], fp[ready], long[ready]
        held = [x[~ready] for x in (block, key, fp)]
    yield np.zeros(len(held[2]), np.int64), held[2], np.zeros(len(held[2]), bool)


def _pairs(radius: int, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for at, fp, long in _runs(batches, most):
            found = []
            hot = np.unique(fp[long])
            at, fp = at[~long], fp[~long]
            for lag in range(1, most):
                same = at[lag:] == at[:-lag] if lag < len(at) else np.empty(0, bool)
                if not same.any():
                    break
                a, b = fp[:-lag][same], fp[lag:][same]
                near = np.bitwise_count((a ^ b).view(np.uint64)) <= radius
                found.append(np.stack([a[near], b[near]], axis=1))
            pairs = _unique(found)
            a = np.concatenate([pairs[:, 0], hot])
            b = pa.array(np.concatenate([pairs[:, 1], hot]), mask=np.arange(len(a)) >= len(pairs))
            yield pa.RecordBatch.from_arrays([pa.array(a), b], names=["a", "b"])

    return run


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links each fingerprint of a run to the first of it."""
    last = None
    for batch in batches:
        block, key, fp = (c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns)
        if not len(fp):
            continue
        new = np.concatenate([[True], (block[1:] != block[:-1]) | (key[1:] != key[:-1])])
        first = fp[np.flatnonzero(new)][np.cumsum(new) - 1]
        if last and last[:2] == (block[0], key[0]):
            first[np.cumsum(new) == 1] = last[2]
        last = (block[-1], key[-1], first[-1])
        other = first != fp
        pairs = _unique([np.stack([first[other], fp[other]], axis=1)])
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])


def links(prints: DataFrame, scratch: Scratch, radius: int = RADIUS, blocks: int = 2, most: int = PAIRS_MOST) -> DataFrame:
    """a, b: links between distinct fingerprints whose components are those of all pairs within the radius.

    Outside large groups every such pair is there; within one, each member is linked to the least in each shared variant.
    """
    if radius % 2:
        raise ValueError("the radius must be even: members that share a variant are then within it")
    arrow_batches(prints.sparkSession, rows=1 << 17)
    met = scratch.put(_sorted(variants(prints, radius, blocks)).mapInArrow(_pairs(radius, most), "a long, b long"))
    large = met.where("b IS NULL").select(F.col("a").alias("fp")).distinct()
    stars = scratch.put(_sorted(variants(large, radius, 1)).mapInArrow(_stars, "a long, b long"))
    return met.where("b IS NOT NULL").unionAll(stars).distinct()


def near_duplicates(docs: DataFrame, scratch: Scratch, radius: int = RADIUS, words: int = WORDS, blocks: int = 2, most: int = PAIRS_MOST) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (the least doc_id of all documents reachable)."""
    marked = scratch.put(fingerprints(docs, words))
    prints = scratch.put(marked.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(links(prints.select("fp"), scratch, radius, blocks, most), scratch).withColumnRenamed("node", "fp")
    rooted = scratch.put(prints.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp")))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    arrow_batches(docs.sparkSession)
    named = salted_join(rooted.select("fp", "root"), least, "root", ["fp"], "inner").select("fp", "component_id")
    return salted_join(marked, named, "fp", ["doc_id"], "inner").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
