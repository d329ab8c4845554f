import random
from collections import defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from convmill.llm import queries, simhash
from convmill.llm.common import Scratch
from convmill.llm.components import components

SF = "/root/testdata/sf0.001"


def brute_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    sh = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hs = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hs) * 2 > len(hs))


def brute_roots(pairs, nodes):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def brute_components(prints):
    fps = sorted(set(prints))
    pairs = [(a, b) for i, a in enumerate(fps) for b in fps[i + 1 :] if (a ^ b).bit_count() <= 4]
    return brute_roots(pairs, fps)


def test_simhash_query_equals_brute_force(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    prints = {i: brute_print(t) for i, t in texts.items()}
    roots, least = brute_components(prints.values()), {}
    for i in sorted(texts, reverse=True):
        least[roots[prints[i]]] = i
    rows = queries.op6_simhash(spark, SF).collect()
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in rows} == {(i, f"{p:016x}", least[roots[p]]) for i, p in prints.items()}
    assert len(rows) == len(texts)


@pytest.mark.parametrize("blocks,most", [(1, 64), (2, 64), (2, 3)])
def test_links_have_the_components_of_all_near_pairs(spark, blocks, most):
    rng = random.Random(blocks * 100 + most)
    fps = set()
    for size in (1, 2, 5, 40):
        for _ in range(12):
            center = rng.getrandbits(64)
            for _ in range(size):
                x = center
                for _ in range(rng.randrange(5)):
                    x ^= 1 << rng.randrange(64)
                fps.add(x)
                center = x if rng.random() < 0.2 else center
    signed = {x - (1 << 64) if x >> 63 else x for x in fps}
    s = Scratch(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    got = simhash.links(spark.createDataFrame([(x,) for x in signed], "fp long"), s, blocks=blocks, most=most).collect()
    assert all(((r.a ^ r.b) & (1 << 64) - 1).bit_count() <= 4 for r in got)
    want = brute_components(fps)
    mine = brute_roots([(r.a & (1 << 64) - 1, r.b & (1 << 64) - 1) for r in got], fps)
    assert mine == want


def test_runs_across_batches():
    import numpy as np
    import pyarrow as pa

    keys = [1] * 3 + [2] * 9 + [3] + [4] * 2
    rows = [(0, k, i) for i, k in enumerate(keys)]
    for step in (1, 2, 4, 100):
        batches = [pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows[i : i + step])], names=["block", "key", "fp"]) for i in range(0, len(rows), step)]
        short, long = defaultdict(list), set()
        for n, (run, fp, flag) in enumerate(simhash._runs(iter(batches), 4)):
            long |= set(fp[flag].tolist())
            for r, f in zip(run[~flag], fp[~flag]):
                short[n, int(r)].append(int(f))
        assert long == set(range(3, 12))
        assert sorted(short.values()) == [[0, 1, 2], [12], [13, 14]]


def test_components_of_paths_stars_and_nothing(spark):
    rng = random.Random(5)
    names = rng.sample(range(10_000), 400)
    pairs = list(zip(names[:150], names[1:150])) + [(names[200], x) for x in names[201:300]] + [(names[301], names[301]), (names[302], names[303])]
    want = brute_roots(pairs, {x for p in pairs for x in p})
    want.pop(names[301])
    got = components(spark.createDataFrame(pairs, "a long, b long"), Scratch(spark)).collect()
    assert {(r.node, r.root) for r in got} == set(want.items()) and len(got) == len(want)
    assert components(spark.createDataFrame([], "a long, b long"), Scratch(spark)).count() == 0


def test_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(70000))
    rows = [(None, None, "a"), (None, "A b c", "a"), (1, None, "a"), (2, "", "a"), (3, " \t ", "a"), (4, "a B c", "a"), (4, "a b c", "b"), (5, "A b\tc", "a"), (6, long, "a"), (7, long + " end", "a"), (8, "é É", "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string").withColumn("root", F.lit(1))
    got = simhash.near_duplicates(docs, Scratch(spark)).collect()
    prints = [brute_print(t) for _, t, _ in rows]
    roots, least = brute_components(prints), defaultdict(list)
    for (i, _, _), p in zip(rows, prints):
        least[roots[p]] += [i] * (i is not None)
    key = lambda x: tuple(str(v) for v in x)
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in got), key=key) == sorted(((i, f"{p:016x}", min(least[roots[p]])) for (i, _, _), p in zip(rows, prints)), key=key)
    assert simhash.near_duplicates(docs.limit(0), Scratch(spark)).count() == 0
