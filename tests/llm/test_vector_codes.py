"""Codes against whole distances to all entries, and the query against SQL."""

import hashlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from convmill.llm import queries, vector_codes
from convmill.llm.common import Scratch

SF = "/root/testdata/sf0.01"
ROW = "vec_id long, embedding array<float>, label int"
NAN, INF = float("nan"), float("inf")


def plain(rows, parts=4, entries=256, rounds=4, scale=1024):
    """Every rule as it is stated, with Python's whole numbers."""
    kept = [(i, [int(np.floor(np.float64(x) * scale)) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    if not kept:
        return []
    longest = max(len(v) for _, v, _ in kept)
    width = -(-longest // parts)
    kept = [(i, v + [0] * (width * parts - len(v)), label) for i, v, label in kept]
    cut = lambda v, p: v[p * width : (p + 1) * width]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[cut(v, p) for _, v, _ in first] for p in range(parts)]
    near = lambda x, book: min((sum((a - b) ** 2 for a, b in zip(x, y)), e) for e, y in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            own = defaultdict(list)
            for _, v, _ in kept:
                own[near(cut(v, p), books[p])[1]].append(cut(v, p))
            books[p] = [[sum(c) // len(own[e]) for c in zip(*own[e])] if e in own else y for e, y in enumerate(books[p])]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out, by_label = [], defaultdict(int)
    for i, v, label in kept:
        found = [near(cut(v, p), books[p]) for p in range(parts)]
        out.append((i, "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found), label))
        by_label[label] += out[-1][2]
    return sorted(((i, c, min(e, 2**63 - 1), min(by_label[label], 2**63 - 1), digest) for i, c, e, label in out), key=str)


def got(df, scratch, **more):
    return sorted((tuple(r) for r in vector_codes.compress(df, scratch, **more).collect()), key=str)


def test_query_equals_sql(spark):
    rows = queries.op13_vector_codes(spark, SF)
    with duckdb.connect() as db:
        db.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
        want = db.execute(queries.ORACLE_SQL["op13_vector_codes"])
        names = [c[0] for c in want.description]
        assert rows.columns == names and sorted(map(tuple, rows.collect())) == sorted(want.fetchall())


@pytest.mark.parametrize("dims", [16, 4, 6])
def test_equals_whole_distances(spark, dims):
    rnd = np.random.default_rng(dims)
    # Few different values, so that many distances tie, and copies.
    rows = [(int(i), [float(x) for x in rnd.integers(-3, 3, dims) / 8], int(rnd.integers(0, 3)) if i % 5 else None) for i in rnd.permutation(150)]
    rows += rows[:20] + [(None, rows[0][1], 1), (None, rows[1][1], None)]
    df = spark.createDataFrame(rows, ROW)
    for entries in (8, 256):
        assert got(df.repartition(5), Scratch(spark), entries=entries) == plain(rows, entries=entries)


def test_odd_rows(spark):
    rows = [(1, None, 1), (2, [], 1), (3, [1.0, None], 2), (4, [NAN, 1.0], 2), (5, [INF, 1.0], 2), (6, [-0.0, -0.0001, 0.5, 1e-30], None), (6, [-0.0, -0.0001, 0.5, 1e-30], None), (7, [3.4e38, -3.4e38, 1.0, 2.0], 2), (8, [1e12, -1e12, 5.0], 2), (None, [1.0, 2.0, 3.0, 4.0, 5.0], None)]
    df = spark.createDataFrame(rows, ROW).withColumn("key", F.lit("x")).withColumn("components", F.lit(1)).withColumn("error", F.lit(None).cast("string"))
    held = [(i, v if v is None else [x if x is None or not abs(x) > 1e30 or x == INF else float(np.sign(x)) * 2.0**53 for x in v], label) for i, v, label in rows]
    want = plain(held)
    rows_out = got(df, Scratch(spark))
    # 3.4e38 is held at the end of the long range: 2^63 - 1 where 2^53 * 1024 is 2^63, so its codebook entry and digest differ by one.
    assert [r[:4] for r in rows_out] == [r[:4] for r in want] and len({r[4] for r in rows_out}) == 1
    assert got(df.limit(0), Scratch(spark)) == [] and got(df.where("vec_id IN (1, 3, 4)"), Scratch(spark)) == []
    assert got(df.where("vec_id = 2"), Scratch(spark)) == plain([(2, [], 1)])


def test_dropping_keeps_the_nearest_and_exact_numbers():
    rnd = np.random.default_rng(1)
    for size in (3, 2**20, 2**40, 2**62):
        x, book = rnd.integers(-size, size, (70, 8)), rnd.integers(-size, size, (40, 8))
        book[20:] = book[:20]
        entry, distance = vector_codes.nearest(x, book)
        for i in range(len(x)):
            whole = [(sum((int(a) - int(b)) ** 2 for a, b in zip(x[i], y)), e) for e, y in enumerate(book)]
            assert (int(distance[i]), int(entry[i])) == min(whole)


def test_decoded_components_are_the_entries(spark):
    vectors = spark.read.parquet(f"{SF}/embeddings.parquet")
    kept = Scratch(spark).put(vector_codes.integers(vectors))
    books = vector_codes.fit(kept, entries=16, rounds=2)
    back = vector_codes.decoded(vector_codes.encode(kept, books), books).join(kept.select("vec_id", F.col("components").alias("own")), "vec_id").collect()
    assert len(back) == 500
    for r in back:
        assert sum((a - b) ** 2 for a, b in zip(r.components, r.own)) == r.error
