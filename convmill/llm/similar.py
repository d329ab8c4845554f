"""Near duplicates by word-shingle similarity, found by ball hashing of long SimHash fingerprints.

``simhash`` links 64-bit fingerprints within 4 bits, which is far closer than a similarity of 0.8 on five-word shingles: that
leaves about 15 % of the bits different. Here each distinct text gets a fingerprint of several 64-bit words, cut into blocks;
each block emits its ball of radius 1 (every variant within half the block's radius of 2), and entries shuffle on block and variant.
Two texts that meet, and of whose 128 check bits few differ, may be alike. With ``plan`` a pair at 0.8 meets in some block with a
chance of RECALL or more, and blocks widen with the number of texts, so that chance meetings stay few for each.

What may be alike falls into families: the connected components of those meetings. A family is found from a spanning forest of its
meetings, so what is written is linear in the texts, whatever the sizes of the groups; no pair is left out of it.
Within a family every pair is decided by the whole shingle sets: its members are dealt into chunks, each two chunks meet in one task,
which compares sets that share one of their rarest shingles there, and writes a spanning forest of the pairs alike by ``least`` or more.

Fingerprints of a few shingles differ in more bits: sets up to SHORT emit EXTRA further blocks, whose meetings pass with LOOSE_BITS.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from . import simhash
from .common import Scratch, arrow_batches, fresh, running, salted_join
from .components import components

WORDS = 5
LEAST = 0.8
RECALL = 0.99
#: Texts up to which blocks are NARROW bits wide; each doubling adds a bit.
NARROW, TEXTS = 21, 1 << 18
#: Words of 64 bits that check a meeting, and the most bits of them that differ: above 99.9 % of pairs at 0.8, one in 10 million of unrelated ones.
CHECKS, CHECK_BITS = 2, 33
#: Shingles up to which a set emits EXTRA blocks. At 0.8 sets of 4 and 5 shingles meet with 98 % and are passed with 99 %; larger ones do more often.
SHORT, EXTRA, LOOSE_BITS = 80, 10, 36
#: Entries of one variant up to which all its pairs are held against each other at once; larger ones first against MIDDLES.
RUN, MIDDLES = 32, 2
#: Shingles in a chunk of a family, and texts in one: FEW or more, so that a text is in 64 chunk pairs at most up to a family of 64 * MOST.
CHUNK, FEW, MOST = 1 << 21, 256, 1 << 14
#: Slots of the filter that keeps texts of no family from being shuffled: 2 MB, whatever the input.
SLOTS = 1 << 24
_MIX = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)
ENTRY = np.dtype([("key", "<u4"), ("id", "<i8"), *((f"check{i}", "<u8") for i in range(CHECKS))])


def plan(texts: int, least: float = LEAST, recall: float = RECALL) -> tuple[int, int]:
    """(bits a block, blocks): how many blocks of that width meet with the wanted chance at a similarity of ``least``."""
    width = min(60, NARROW + max(0, math.ceil(math.log2(max(1, texts) / TEXTS))))
    cosine = 2 * least / (1 + least)
    p = math.acos(cosine) / math.pi
    meet = sum(math.comb(width, k) * p**k * (1 - p) ** (width - k) for k in range(3))
    return width, math.ceil(math.log(1 - recall) / math.log(1 - meet))


def shingle_set(text: bytes | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles, A-Z lower-cased."""
    found = (text or b"").lower().split()
    if not found:
        return np.empty(0, np.uint64)
    joined = b" ".join(found)
    if len(found) <= words:
        return np.array([xxh64_intdigest(joined, 7)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    count = len(found) - words + 1
    return np.unique(np.fromiter((xxh64_intdigest(joined[s:e], 7) for s, e in zip(starts[:count].tolist(), ends[words - 1 :].tolist())), np.uint64, count))


def mixed(h: np.ndarray, seed: int) -> np.ndarray:
    x = h + np.uint64((seed + 1) * _MIX[0] & (1 << 64) - 1)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(_MIX[1])
    x = (x ^ (x >> np.uint64(27))) * np.uint64(_MIX[2])
    return x ^ (x >> np.uint64(31))


def majority(h: np.ndarray) -> np.uint64:
    """The bits set in over half of the words."""
    total = np.zeros(64, np.int64)
    for i in range(0, len(h), 1 << 16):
        bits = np.unpackbits(h[i : i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        whole = len(bits) // 255 * 255
        total += bits[:whole].reshape(-1, 255, 64).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64) + bits[whole:].sum(axis=0, dtype=np.int64)
    return np.packbits(total * 2 > len(h), bitorder="little").view(np.uint64)[0]


def long_print(shingles: np.ndarray, words: int) -> bytes:
    return b"".join(int(majority(mixed(shingles, k))).to_bytes(8, "little") for k in range(words)) if len(shingles) else bytes(8 * words)


def mark_of(text: Column) -> Column:
    """The 128 bits by which texts are told apart; null counts as empty."""
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def _slot(mark: Column) -> Column:
    return F.conv(F.hex(F.substring(mark, 1, 3)), 16, 10).cast("int")


def prints(docs: DataFrame, words: int, blocks_words: int, extra_words: int) -> DataFrame:
    """doc_id, mark, fp (the 64-bit fingerprint of ``simhash``), n (shingles) and print (``blocks_words`` 64-bit words and CHECKS more; for short sets ``extra_words`` more), in one pass over the texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).to_pylist()
            sets = [shingle_set(t, words) for t in texts]
            short = np.array([simhash.simhash(t) for t in texts], np.uint64).view(np.int64)
            prints = [long_print(s, blocks_words + CHECKS + (extra_words if len(s) <= SHORT else 0)) for s in sets]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(short), pa.array([len(s) for s in sets], pa.int64()), pa.array(prints, pa.binary())], names=["doc_id", "mark", "fp", "n", "print"])

    arrow_batches(docs.sparkSession)
    text = F.coalesce("text", F.lit("")).cast("binary")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), mark_of(F.col("text")).alias("mark"), text.alias("text")).mapInArrow(run, "doc_id long, mark binary, fp long, n long, print binary")


def _entries(width: int, blocks: int, groups: int):
    per_word = 64 // width
    head = -(-blocks // per_word)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flips = np.concatenate([[0], np.uint64(1) << np.arange(width, dtype=np.uint64)]).astype(np.uint64)
        for batch in batches:
            if not batch.num_rows:
                continue
            every, marks = batch.column(0).to_numpy(), batch.column(1).to_pylist()
            whole = 8 * (head + CHECKS)
            few = np.flatnonzero(np.fromiter((len(m) > whole for m in marks), bool, len(marks)))
            base = np.frombuffer(b"".join(m[:whole] for m in marks), "<u8").reshape(len(marks), -1)
            more = np.frombuffer(b"".join(marks[i][whole:] for i in few.tolist()), "<u8").reshape(len(few), -(-EXTRA // per_word))
            # The blocks of one word at a time: what one batch emits stays bounded.
            steps = [(base, np.arange(len(marks)), range(f, min(blocks, f + per_word)), 0) for f in range(0, blocks, per_word)]
            steps += [(more, few, range(f, min(EXTRA, f + per_word)), 1) for f in range(0, EXTRA, per_word) if len(few)]
            for words, rows, some, loose in steps:
                made, groups_of = [], []
                for block in some:
                    value = words[:, block // per_word] >> np.uint64(block % per_word * width) & np.uint64((1 << width) - 1)
                    entry = np.empty((len(rows), len(flips)), ENTRY)
                    name = mixed((value[:, None] ^ flips) * np.uint64(4096) + np.uint64(block + loose * blocks), 9)
                    # The top bit tells the blocks of short sets.
                    entry["key"] = (name >> np.uint64(33)).astype(np.uint32) | np.uint32(loose << 31)
                    entry["id"] = every[rows][:, None]
                    for i in range(CHECKS):
                        entry[f"check{i}"] = base[rows, head + i][:, None]
                    made.append(entry.ravel())
                    groups_of.append((mixed(name, 3) % np.uint64(groups)).astype(np.int64).ravel())
                entry, group = np.concatenate(made), np.concatenate(groups_of)
                order = np.argsort(group, kind="stable")
                entry, group = entry[order], group[order]
                cuts = np.flatnonzero(np.diff(group)) + 1
                starts = np.concatenate([[0], cuts])
                yield pa.RecordBatch.from_arrays([pa.array(group[starts]), pa.array([e.tobytes() for e in np.split(entry, cuts)], pa.binary())], names=["group", "entries"])

    return run


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links each node of these edges to the least of its component; the least themselves are left out."""
    ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    root = np.arange(len(ids))
    while len(x):
        low = np.minimum(root[x], root[y])
        now = root.copy()
        np.minimum.at(now, root[x], low)
        np.minimum.at(now, root[y], low)
        while (step := now[now]).tobytes() != now.tobytes():
            now = step
        if (now == root).all():
            break
        root = now
    other = root != np.arange(len(ids))
    return ids[other], ids[root[other]]


def _apart(checks: list[np.ndarray], a: np.ndarray | int, b: np.ndarray) -> np.ndarray:
    return sum(np.bitwise_count(c[a] ^ c[b]).astype(np.int16) for c in checks)


def _meet_middles(checks: list[np.ndarray], run: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """A forest whose components hold all close pairs of one large run.

    Those close to one of the members nearest to its middle are taken as one; each of the others is held against all.
    """
    far = sum(np.bitwise_count(c[run] ^ majority(np.ascontiguousarray(c[run]))).astype(np.int16) for c in checks)
    pivots = run[np.argsort(far, kind="stable")[:MIDDLES]]
    near = np.zeros(len(run), bool)
    for p in pivots:
        near |= _apart(checks, p, run) <= most
    near[np.isin(run, pivots)] = True
    left, right = [run[near]], [np.full(near.sum(), pivots[0])]
    others = run[~near]
    step = max(1, (1 << 21) // len(run))
    for i in range(0, len(others), step):
        u = others[i : i + step]
        r, c = np.nonzero(sum(np.bitwise_count(x[u][:, None] ^ x[run][None, :]).astype(np.int16) for x in checks) <= most)
        p, q = forest(u[r], run[c])
        left.append(p)
        right.append(q)
    return np.concatenate(left), np.concatenate(right)


def _meetings(entry: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of ids whose components hold all close pairs of the entries of one group."""
    entry = entry[np.lexsort((entry["id"], entry["key"]))]
    key, ids, checks = np.ascontiguousarray(entry["key"]), np.ascontiguousarray(entry["id"]), [np.ascontiguousarray(entry[f"check{i}"]) for i in range(CHECKS)]
    new = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    size = np.diff(np.append(new, len(key)))
    allowed = np.where(key >> np.uint32(31), LOOSE_BITS, CHECK_BITS)
    few, left, right = np.flatnonzero(np.repeat((size > 1) & (size <= RUN), size)), [], []
    for lag in range(1, RUN):
        a, b = few[: len(few) - lag], few[lag:]
        same = key[a] == key[b]
        if not same.any():
            break
        a, b = a[same], b[same]
        ok = _apart(checks, a, b) <= allowed[a]
        left.append(a[ok])
        right.append(b[ok])
    for start, n in zip(new[size > RUN].tolist(), size[size > RUN].tolist()):
        a, b = _meet_middles(checks, np.arange(start, start + n), int(allowed[start]))
        left.append(a)
        right.append(b)
    none = np.empty(0, np.int64)
    a, b = ids[np.concatenate([none, *left])], ids[np.concatenate([none, *right])]
    return a[a != b], b[a != b]


def _met(batches: Iterator[pa.RecordBatch], most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by group; a group's entries are taken together. One forest over all groups of the task, or of each ``most`` links."""
    now, held = None, []
    a = b = np.empty(0, np.int64)

    def done() -> None:
        nonlocal a, b
        x, y = _meetings(np.frombuffer(b"".join(held), ENTRY))
        held.clear()
        a, b = forest(np.concatenate([a, x]), np.concatenate([b, y]))

    for batch in batches:
        for group, entries in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if group != now and held:
                done()
                if len(a) > most:
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])
                    a = b = np.empty(0, np.int64)
            now = group
            held.append(entries)
    if held:
        done()
    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def alike(ids: np.ndarray, sets: list[np.ndarray], side: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """A forest of the pairs whose sets have a Jaccard similarity of ``least`` or more; only pairs across the sides where there are two.

    Two such sets share one of the rarest shingles of each, a share of 1 - ``least`` of the set: only sets that meet there are compared, and those
    of one component are tried from its latest member on until one is alike, since one link is enough. So sets that share only what all
    share are never compared, and a group of sets that are all alike takes one comparison for each.
    """
    n, size = len(sets), np.fromiter(map(len, sets), np.int64, len(sets))
    two = bool(n) and side.min() != side.max()
    none = np.flatnonzero(size == 0)
    # Empty sets are alike.
    a, b = (none[side[none] == side.min()], none[side[none] != side.min()]) if two else (none[:1], none[1:])
    across = bool(len(a) and len(b))
    left = [*a[:1].tolist() * len(b), *a[1:].tolist()] if across else []
    right = [*b.tolist(), *b[:1].tolist() * len(a[1:])] if across else []
    if not size.sum():
        return ids[np.array(left, np.int64)], ids[np.array(right, np.int64)]
    _, inverse, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rank = np.empty(len(count), np.int64)
    rank[np.argsort(count, kind="stable")] = np.arange(len(count))
    # Each set's shingles from the rarest on.
    owner = np.repeat(np.arange(n), size)
    flat = rank[inverse] + owner * len(count)
    flat.sort()
    flat -= owner * len(count)
    shared, start = np.sort(count)[flat] > 1, np.cumsum(size) - size
    first = size - np.ceil(least * size - 1e-9).astype(np.int64) + 1
    # Who has a shingle among its rarest ones.
    early = (np.arange(len(flat)) - start[owner] < first[owner]) & shared
    by_token = np.argsort(flat[early], kind="stable")
    posting, ends = owner[early][by_token], np.cumsum(np.bincount(flat[early], minlength=len(count)))
    label, members, placed, held = np.arange(n), [1] * n, np.zeros(n, bool), np.zeros(len(count), bool)
    postings: tuple[dict, dict] = ({}, {})

    def tried(i: int, some: np.ndarray) -> None:
        """Links ``i`` to each component of which one of these is alike to it."""
        codes = flat[np.repeat(start[some] - (np.cumsum(size[some]) - size[some]), size[some]) + np.arange(int(size[some].sum()))]
        both = np.add.reduceat(held[codes].astype(np.int64), np.cumsum(size[some]) - size[some])
        for j in some[both >= least * (size[i] + size[some] - both)].tolist():
            if label[j] != label[i]:
                left.append(i)
                right.append(j)
                # The larger component keeps its name, so names that lists go by stay current.
                less, more = sorted((int(label[i]), int(label[j])), key=members.__getitem__)
                members[more] += members[less]
                label[label == less] = more

    for i in np.argsort(size, kind="stable").tolist():
        if not size[i]:
            continue
        own = flat[start[i] : start[i] + size[i]]
        rare = own[: first[i]][shared[start[i] : start[i] + first[i]]]
        mine, others = postings[int(side[i]) if two else 0], postings[1 - int(side[i]) if two else 0]
        held[own] = True
        groups: dict[int, list[list[int]]] = {}
        entries = [e for t in rare.tolist() if (e := others.get(t))]
        if sum(map(len, entries)) <= 4 * len(rare) + 64:
            for entry in entries:
                for r, some in entry.items():
                    groups.setdefault(int(label[r]), []).append(some)
            for r, lists in groups.items():
                for some in _in_turn(lists, size, least * size[i] - 1e-9):
                    if label[some[0]] == label[i]:
                        break
                    tried(i, some)
        else:
            # Many components meet here: one of each is tried at once, then the others of those without a link.
            meets = np.zeros(n, bool)
            k = ends[rare] - np.where(rare > 0, ends[rare - 1], 0)
            meets[posting[np.repeat(ends[rare] - np.cumsum(k), k) + np.arange(int(k.sum()))]] = True
            some = np.flatnonzero(meets & placed & (size >= least * size[i] - 1e-9) & ((side != side[i]) if two else True))
            some = some[label[some] != label[i]]
            one = np.unique(label[some], return_index=True)[1]
            if len(one):
                tried(i, some[one])
            for a in range(0, len(some), 4096):
                rest = np.setdiff1d(some[a : a + 4096], some[one])
                rest = rest[label[rest] != label[i]]
                if len(rest):
                    tried(i, rest)
        held[own] = False
        placed[i] = True
        for token in rare.tolist():
            mine.setdefault(token, {}).setdefault(int(label[i]), []).append(i)
    return ids[np.array(left, np.int64)], ids[np.array(right, np.int64)]


def _in_turn(lists: list[list[int]], size: np.ndarray, least: float) -> Iterator[np.ndarray]:
    """The members of these lists large enough to be alike, each once, latest first: one, then ever more at a time."""
    some, most, seen = [], 1, set()
    for members in lists:
        for j in reversed(members):
            # Lists grow by size, so what comes before is smaller still.
            if size[j] < least:
                break
            if j not in seen:
                seen.add(j)
                some.append(j)
                if len(some) == most:
                    yield np.array(some)
                    some, most = [], min(4 * most, 1024)
    if some:
        yield np.array(some)


def _decide(least: float):
    """Rows come sorted by root, i, j; those of one pair of chunks are taken together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids, sides, sets = None, [], [], []

        def done() -> pa.RecordBatch:
            a, b = alike(np.array(ids, np.int64), sets, np.array(sides), least)
            for x in (ids, sides, sets):
                x.clear()
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        for batch in batches:
            for root, i, j, own, id_, raw in zip(*(c.to_pylist() for c in batch.columns)):
                if (root, i, j) != now and ids:
                    yield done()
                now = root, i, j
                ids.append(id_)
                sides.append(int(own > i))
                sets.append(np.frombuffer(raw, "<u8"))
        if ids:
            yield done()

    return run


def whole_sets(docs: DataFrame, members: DataFrame, words: int) -> DataFrame:
    """mark, shingles (all 64-bit hashes, sorted) of the distinct texts with these marks.

    A filter of SLOTS bits lets these texts through and few others, so that the others' shingles are neither made nor moved.
    """
    slots = members.select(_slot(F.col("mark")).alias("slot"))
    filled = slots.select((F.col("slot") / 64).cast("int").alias("w"), F.expr("shiftleft(1L, slot % 64)").alias("bit")).groupBy("w").agg(F.bit_or("bit").alias("bits")).collect()
    table = np.zeros(SLOTS // 64, np.uint64)
    for r in filled:
        table[r["w"]] = np.uint64(r["bits"] & (1 << 64) - 1)
    shared = docs.sparkSession.sparkContext.broadcast(table.tobytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(shared.value, np.uint64)
        for batch in batches:
            at = batch.column(1).to_numpy()
            batch = batch.filter(pa.array((bits[at // 64] >> (at % 64).astype(np.uint64) & np.uint64(1)).astype(bool)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([shingle_set(t, words).tobytes() for t in batch.column(2).to_pylist()], pa.binary())], names=["mark", "shingles"])

    arrow_batches(docs.sparkSession)
    mark = mark_of(F.col("text"))
    made = docs.select(mark.alias("mark"), _slot(mark).alias("slot"), F.coalesce("text", F.lit("")).cast("binary").alias("text")).mapInArrow(run, "mark binary, shingles binary")
    return made.groupBy("mark").agg(F.first("shingles").alias("shingles"))


def distinct_texts(docs: DataFrame, scratch: Scratch, words: int = WORDS, least: float = LEAST) -> tuple[DataFrame, int, int]:
    """id, mark, doc_id (the least), fp, n, print of each distinct text, and the plan. Copies of a text come together by partial aggregation; ids are dealt as the table is written."""
    width, blocks = plan(docs.count(), least)
    made = prints(docs, words, -(-blocks // (64 // width)), -(-EXTRA // (64 // width)))
    one = made.groupBy("mark").agg(F.min(F.struct("doc_id", "fp", "n", "print")).alias("t"))
    return scratch.put(one.select(F.monotonically_increasing_id().alias("id"), "mark", "t.*")), width, blocks


def families(texts: DataFrame, scratch: Scratch, width: int, blocks: int) -> DataFrame:
    """id, root of the texts that may be alike to another: the components of the meetings that the check bits pass."""
    spark = texts.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    some = texts.select("id", "print")
    # A group holds about 40,000 entries, whatever the number of texts.
    total, few = some.agg(F.count(F.lit(1)), F.count(F.when(F.length("print") > 8 * (-(-blocks // (64 // width)) + CHECKS), 1))).first()
    groups = max(4 * parts, (total * blocks + few * EXTRA) * (width + 1) // 40_000)
    arrow_batches(spark, rows=4096, mb=64)
    entries = some.mapInArrow(_entries(width, blocks, groups), "group long, entries binary")
    met = scratch.put(entries.repartition(parts, "group").sortWithinPartitions("group").mapInArrow(_met, "a long, b long"))
    return components(met, scratch).withColumnRenamed("node", "id")


def chunks(members: DataFrame, scratch: Scratch) -> DataFrame:
    """id, mark, root, chunk, chunks of the texts (id, mark, n, root) of families, each dealt into chunks of CHUNK shingles and max(FEW, family / 64) texts, but MOST, at most."""
    stats = members.groupBy("root").agg(F.count(F.lit(1)).alias("texts"), F.sum("n").alias("shingles"))
    share = F.ceil(F.lit(CHUNK) / F.greatest(F.lit(FEW), F.least(F.col("texts") / 64, F.lit(MOST))))
    sized = salted_join(members, stats, "root", ["id"], "inner").withColumn("w", F.greatest("n", share))
    # No sum of weights is above this, so neither is a chunk's number.
    sized = scratch.put(sized.withColumn("chunks", F.floor((F.col("shingles") + F.col("texts") * share) / CHUNK) + 1).drop("texts", "shingles"))
    one = sized.where("chunks = 1").select("id", "mark", "root", F.lit(0).cast("long").alias("chunk"), "chunks")
    many = running(sized.where("chunks > 1"), ["root"], ["id"], "w", "before").select("id", "mark", "root", F.floor(F.col("before") / CHUNK).alias("chunk"), "chunks")
    return one.unionAll(many)


def links(docs: DataFrame, texts: DataFrame, scratch: Scratch, width: int, blocks: int, words: int = WORDS, least: float = LEAST) -> DataFrame:
    """a, b of the texts (id, mark, n, print) of ``docs`` whose shingle sets are alike by ``least`` or more; enough of these for their components."""
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    roots = families(texts, scratch, width, blocks)
    members = scratch.put(texts.select("id", "mark", "n").join(roots, "id"))
    sets = whole_sets(docs, members, words)
    placed = chunks(members, scratch).join(sets, "mark")
    pairs = F.transform(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1), lambda j: F.struct(F.least("chunk", j).alias("i"), F.greatest("chunk", j).alias("j")))
    dealt = placed.select("root", F.explode(pairs).alias("p"), "chunk", "id", "shingles").select("root", "p.i", "p.j", "chunk", "id", "shingles")
    arrow_batches(docs.sparkSession)
    return scratch.put(dealt.repartition(parts, "root", "i", "j").sortWithinPartitions("root", "i", "j").mapInArrow(_decide(least), "a long, b long"))


def print_links(texts: DataFrame, scratch: Scratch) -> DataFrame:
    """a, b of the texts (id, fp) whose 64-bit fingerprints lie within the radius of ``simhash``: texts to the least of their fingerprint, and those to each other."""
    named = scratch.put(texts.groupBy("fp").agg(F.min("id").alias("rep")))
    near = simhash.links(named.select("fp"), scratch)
    a, b = (named.select(F.col("fp").alias(c), F.col("rep").alias(f"rep_{c}")) for c in "ab")
    apart = salted_join(near, a, "a", ["b"], "inner").join(b, "b").select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b"))
    alike_ = salted_join(texts.select("id", "fp"), named, "fp", ["id"], "inner").where("id <> rep").select(F.col("id").alias("a"), F.col("rep").alias("b"))
    return apart.unionAll(alike_)


def keep_one(docs: DataFrame, scratch: Scratch, words: int = WORDS, least: float = LEAST) -> DataFrame:
    """``docs`` less all but one row of each group of near duplicates: the one of the least doc_id, then of the least mark of its text.

    Linked are equal texts, texts alike by ``least`` on shingles of ``words``, and texts whose 64-bit fingerprints lie
    within the radius of ``simhash``. Only marks of the texts are shuffled until the survivors are known.

    Defined results. Null text: as empty; texts without words are one group. Rows without doc_id take part in no group and stay. Equal
    doc_ids with different texts: each row in its text's group. Repeated rows: one stays; of rows equal in doc_id and text
    the first by its other columns as JSON. Empty table: empty result. Very long texts: whole. Extra columns of any name and type are kept.
    """
    key, mark, row, least_id, least_mark = fresh(docs, "key", "mark", "row", "least_id", "least_mark")
    named = docs.where("doc_id IS NOT NULL").select("doc_id", "text")
    texts, width, blocks = distinct_texts(named, scratch, words, least)
    edges = links(named, texts, scratch, width, blocks, words, least).unionAll(print_links(texts, scratch))
    roots = components(edges, scratch).withColumnRenamed("node", "id")
    rooted = scratch.put(texts.select("id", "doc_id", "mark").join(roots, "id", "left").withColumn("root", F.coalesce("root", "id")))
    first = rooted.groupBy("root").agg(F.min(F.struct("doc_id", "mark")).alias("m")).select(F.col("m.doc_id").alias(least_id), F.col("m.mark").alias(least_mark))
    marked = docs.withColumns({key: F.col("doc_id").cast("long"), mark: mark_of(F.col("text"))})
    kept = marked.join(first, (marked[key] == first[least_id]) & (marked[mark] == first[least_mark]), "left_semi")
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    rank = Window.partitionBy(key, mark).orderBy(F.to_json(F.struct(*others)) if others else F.lit(0))
    kept = kept.withColumn(row, F.row_number().over(rank)).where(F.col(row) == 1)
    return kept.select(*(F.col(f"`{c}`") for c in docs.columns)).unionByName(docs.where("doc_id IS NULL"))
